"""Product hierarchies: columns ``l0_name`` ... ``ln_name`` above ``product_code``."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def levels_of(cols: list[str]) -> list[str]:
    return sorted((c for c in cols if re.fullmatch(r"l\d+_name", c)), key=lambda c: int(c[1:-5]))


def levels_up_to(cols: list[str], level: str) -> list[str]:
    """The levels at or above one, ``product_code`` being below all."""
    every = levels_of(cols)
    return [*every, "product_code"] if level == "product_code" else every[: every.index(level) + 1]


def hierarchy_code(cols: list[str]) -> Column:
    """A code of a prefix: the first 16 hex digits of SHA-256 over its names."""
    return F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, 16)


def flatten_hierarchies(products: DataFrame, levels: list[str]) -> DataFrame:
    """One row per distinct prefix, product level included: ``hierarchy_code, level, active`` and the names (H1).

    A prefix is active if one of its products is. All levels come from one pass of grouping sets.
    """
    every = [*levels, "product_code"]
    active = F.max(F.coalesce("active", F.lit(True))) if "active" in products.columns else F.max(F.lit(True))
    named = reduce(lambda a, b: a + b, [1 - F.grouping(c) for c in every])
    sets = [[F.col(c) for c in every[:n]] for n in range(1, len(every) + 1)]
    rows = products.groupingSets(sets, *[F.col(c) for c in every]).agg(named.cast("int").alias("level"), active.alias("active"))
    # names below a prefix are NULL, and a code leaves NULLs out
    return rows.select(hierarchy_code(every).alias("hierarchy_code"), "level", "active", *every)


def deepest_level(hierarchies: DataFrame) -> DataFrame:
    """The rows of the greatest level."""
    return hierarchies.crossJoin(F.broadcast(hierarchies.agg(F.max("level").alias("__deepest")))).where("level = __deepest").drop("__deepest")
