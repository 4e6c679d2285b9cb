"""The master table of inventory and sales."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.specs import Feature


def build_master(
    inventory: DataFrame, transactions: DataFrame, dims: dict[str, tuple[DataFrame, list[str]]], features: dict[str, list[Feature]], keys: list[str],
    qty: str = "qty", inv: str = "inventory", since: date | None = None, derived: list[Feature] = (), override: str | Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """Both sides aggregated to ``keys``, joined in full, with dimensions attached at their own level (E5).

    ``features["inventory"]`` and ``features["transactions"]`` are aggregates; ``dims`` maps a name to rows and their
    keys. Quantity is 0 where nothing was sold; inventory is never below what was sold. With ``since`` only later dates
    are read (E6). ``override`` (SQL or a callable) replaces the whole.
    """
    if override is not None:
        return inventory.sparkSession.sql(override) if isinstance(override, str) else override()
    if since is not None:
        inventory, transactions = (df.where(F.col("date") > F.lit(since)) for df in (inventory, transactions))
    i = inventory.groupBy(*keys).agg(*[F.expr(f.expr).alias(f.name) for f in features["inventory"]])
    t = transactions.groupBy(*keys).agg(*[F.expr(f.expr).alias(f.name) for f in features["transactions"]])
    master = i.join(t, keys, "full_outer")  # a join on names coalesces the keys
    sold, stock = F.col(qty), F.col(inv)
    master = master.withColumn(qty, F.coalesce(sold, F.lit(0.0)))
    master = master.withColumn(inv, F.coalesce(F.when(stock < F.col(qty), F.col(qty)).when(stock < 0, F.lit(0.0)).otherwise(stock), F.col(qty)))
    for rows, on in dims.values():
        master = master.join(rows, on, "left")
    for f in derived:
        master = master.withColumn(f.name, F.expr(f.expr))
    return master
