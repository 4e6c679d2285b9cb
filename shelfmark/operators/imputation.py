"""Lost sales: quantities, prices and discounts that a shelf without stock hid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.joins import if_small, joined_null_safe
from shelfmark.functions.override import Override, replaced
from shelfmark.functions.scratch import staged

def _together(df: DataFrame, level: list[str]) -> list[str]:
    """The columns by which all windows of this step start: rows of a product and week (where it is known) are dealt out
    once, and each window after the first finds its rows in place."""
    return ["product_code", *(c for c in ("fiscal_year_week",) if c in df.columns), *level]


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` by product and week, sorted as the next windows need it."""
    return df.repartition(*[c for c in keys if c in ("product_code", "fiscal_year_week")]).sortWithinPartitions(*keys, *order)


def attach_clusters(master: DataFrame, clusters: DataFrame, level: list[str]) -> DataFrame:
    """Each store's cluster and the number of stores in it."""
    size = clusters.groupBy(*level, "cluster_name").agg(F.countDistinct("store_code").alias("total_stores_cluster"))
    named = clusters.select(*level, "store_code", "cluster_name").distinct().join(size, [*level, "cluster_name"])
    return master.join(if_small(named), [*level, "store_code"], "left")


def attach_figures(df: DataFrame, level: list[str], qty: str, inv: str, prices: list[str], discounts: list[str], signals: bool = True, quantity: bool = True) -> DataFrame:
    """``df`` with the figures that imputation starts from.

    Signals (``active_stores, weekly_qty, max_daily_inventory``) and first estimates of prices, discounts and the quantity
    are aggregates over parts of a product's week: rows are exchanged once, by product and week, and sorted twice there.
    Prices leave out rows that sold nothing, quantities rows without stock.
    """
    values = {c: F.when(F.col(qty) != 0, F.col(c)) for c in prices} | {c: F.col(c) for c in discounts}
    coarser = list(values)
    values |= {qty: F.when(F.col(inv) > 0, F.col(qty))} if quantity else {}
    wide = _together(df, level)
    of_day, of_week, of_all = Window.partitionBy(*wide, "date", "cluster_name"), Window.partitionBy(*wide, "cluster_name"), Window.partitionBy(*wide)
    mean = lambda c, w: F.try_divide(F.sum(values[c]).over(w), F.count(values[c]).over(w))
    out = _dealt(df, wide, ["date", "cluster_name"])
    by_day = {f"__day_{c}": mean(c, of_day) for c in values} | ({"__inv": F.sum(inv).over(of_day)} if signals else {})
    out = out.withColumns({f"__wide_{c}": mean(c, of_all) for c in coarser}).withColumns(by_day)
    by_week = {f"__week_{c}": mean(c, of_week) for c in coarser}
    if signals:
        # a store's first row that sold something
        sold = F.coalesce(F.col(qty) != 0, F.lit(False))
        own = Window.partitionBy(*wide, "cluster_name", "store_code").orderBy(sold.desc())
        out = out.withColumn("__active", (sold & (F.row_number().over(own) == 1)).cast("long"))
        by_week |= {"active_stores": F.sum("__active").over(of_week), "weekly_qty": F.sum(qty).over(of_week), "max_daily_inventory": F.max("__inv").over(of_week)}
    out = out.withColumns(by_week)
    tries = {c: [f"__day_{c}", *([f"__week_{c}", f"__wide_{c}"] if c in coarser else [])] for c in values}
    first = [F.coalesce(*t).alias(f"{c}_first_imputed") for c, t in tries.items()]
    return out.select(*df.columns, *first, *(["active_stores", "weekly_qty", "max_daily_inventory"] if signals else []))


def _signal_columns(df: DataFrame, inv: str) -> DataFrame:
    return (
        df.withColumn("oos_flag", F.when(F.col(inv) == 0, 1).otherwise(0))
        .withColumn("active_stores_ratio", F.coalesce(F.round(F.try_divide("active_stores", "total_stores_cluster"), 2), F.lit(0.0)))
        .withColumn("sell_through_ratio", F.coalesce(F.round(F.try_divide("weekly_qty", "max_daily_inventory"), 2), F.lit(0.0)))
    )


def _mean_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_imputed": F.coalesce(c, F.round(F.round(f"{c}_first_imputed", 9), 2)) for c in cols})


def stock_signals(df: DataFrame, level: list[str], qty: str = "qty", inv: str = "inventory") -> DataFrame:
    """Out-of-stock flag, and the ratios of active stores and of sell-through by cluster, product and week.

    Distinct stores are counted exactly, by a mark on one row of each; no set of stores is gathered.
    """
    return _signal_columns(attach_figures(df, level, qty, inv, [], [], quantity=False), inv)


def impute_price_means(df: DataFrame, level: list[str], qty: str, cols: list[str], price: bool = True) -> DataFrame:
    """``<col>_imputed``: the value, or where it is NULL its first estimate, rounded to 2: the mean by cluster, product and
    day, else by week, else by product and week. ``<col>_first_imputed`` is that estimate (E10).

    Prices leave out rows that sold nothing; other columns take all rows. Means are rounded to 9 digits first, so that the
    order of summing does not decide a half. A date lies in one fiscal week.
    """
    return _mean_columns(attach_figures(df, level, qty, qty, cols if price else [], [] if price else cols, signals=False, quantity=False), cols)


def first_estimates(df: DataFrame, level: list[str], prices: list[str], discounts: list[str], qty: str = "qty", inv: str = "inventory") -> DataFrame:
    """Stock signals and the first estimates of prices, discounts and the quantity, from one exchange."""
    return _mean_columns(_signal_columns(attach_figures(df, level, qty, inv, prices, discounts), inv), [*prices, *discounts])


def impute_quantity(df: DataFrame, level: list[str], qty: str, inv: str, cutoffs: DataFrame) -> DataFrame:
    """Quantities of out-of-stock rows where a channel's cut-offs are met.

    ``cutoffs``: ``level..., active_stores_cutoff, sell_through_cutoff``, one row per channel. Without a row for its
    channel nothing is imputed. The estimate (the mean of rows with stock by cluster, product and day) is taken from
    ``<qty>_first_imputed`` where ``first_estimates`` has made it.
    """
    first = f"{qty}_first_imputed"
    out = df if first in df.columns else attach_figures(df, level, qty, inv, [], [], signals=False)
    out = out.join(F.broadcast(cutoffs), level, "left")
    acts = (F.col("oos_flag") == 1) & (F.col("active_stores_ratio") >= F.col("active_stores_cutoff")) & (F.col("sell_through_ratio") >= F.col("sell_through_cutoff"))
    sold, estimate = F.col(qty), F.col(first)
    imputed = F.when(acts & (sold > estimate), F.round(sold)).when(acts & (sold < estimate), F.round(estimate)).otherwise(sold)
    return (
        out.withColumn(f"{qty}_imputed", imputed)
        .withColumn("imputation_flag", F.when(F.col(f"{qty}_imputed") == sold, 0).otherwise(1))
        .drop(first, "active_stores_cutoff", "sell_through_cutoff")
    )


def _with_product_means(df: DataFrame, hierarchies: list[str], level: list[str], cols: list[str], inv: str) -> DataFrame:
    """The discounts' means by product, by day and then by week, where ``product_code`` is the deepest level; and for the
    levels above it what is summed of each (levels, day): ``__inv, __<col>`` on its row ``__fine = 1``."""
    keys = _together(df, level)
    rest = [h for h in hierarchies if h not in keys] + [c for c in ("fiscal_year_week",) if c not in keys]
    day = Window.partitionBy(*keys, "date")
    fine = Window.partitionBy(*keys, "date", *rest)
    weight = {c: F.col(f"{c}_imputed") * F.col(inv) for c in cols}
    out = df.withColumns({"__fine": F.row_number().over(fine.orderBy("store_code")), "__inv": F.sum(inv).over(fine)} | {f"__{c}": F.sum(w).over(fine) for c, w in weight.items()})
    if hierarchies[:1] != ["product_code"]:
        return out
    known = F.lit(True)
    for c in ["product_code", *level]:
        known = known & F.col(c).isNotNull()
    for grain, w in (("date", day), ("fiscal_year_week", Window.partitionBy(*keys))):
        mean = {c: F.try_divide(F.sum(x).over(w), F.sum(inv).over(w)) for c, x in weight.items()}
        out = out.withColumns({f"__{grain}_{c}": F.when(known & F.col(grain).isNotNull(), m) for c, m in mean.items()})
    return out.withColumns({f"{c}_imputed": F.coalesce(f"{c}_imputed", f"__date_{c}", f"__fiscal_year_week_{c}") for c in cols}).drop(
        *[f"__{grain}_{c}" for grain in ("date", "fiscal_year_week") for c in cols]
    )


def _with_level_means(some: DataFrame, rows: DataFrame, hierarchies: list[str], level: list[str], cols: list[str]) -> DataFrame:
    """``some`` rows of ``rows`` (of ``_with_product_means``) with the means of the levels that are left."""
    fine = rows.where("__fine = 1")
    for h in hierarchies[hierarchies[:1] == ["product_code"] :]:
        for grain in ("date", "fiscal_year_week"):
            on = [h, *level, grain]
            mean = fine.groupBy(*on).agg(*[F.try_divide(F.sum(f"__{c}"), F.sum("__inv")).alias(f"__mean_{c}") for c in cols])
            some = some.join(mean, on, "left")
            some = some.withColumns({f"{c}_imputed": F.coalesce(f"{c}_imputed", f"__mean_{c}") for c in cols}).drop(*[f"__mean_{c}" for c in cols])
    return some


def impute_discounts(df: DataFrame, hierarchies: list[str], level: list[str], cols: list[str], inv: str) -> DataFrame:
    """``<col>_imputed`` where NULL: inventory-weighted means by level, deepest first, by day and then by week.

    A product's means are windows over its week, which exchange nothing where ``df`` comes from the estimates. The levels above
    are sums over one row for each (levels, day), and are joined to the rows that have no discount then. Rows are staged between.
    """
    columns = df.columns
    rows = staged(_with_product_means(df, hierarchies, level, cols, inv), "discount-sums")
    done = F.lit(True)
    for c in cols:
        done = done & F.col(f"{c}_imputed").isNotNull()
    return rows.where(done).select(*columns).unionByName(_with_level_means(rows.where(~done), rows, hierarchies, level, cols).select(*columns))


def _with_segments(df: DataFrame, products: DataFrame, formulas: dict[str, str], level: list[str], order: str) -> DataFrame:
    """Prices by formula, then ``__last_known_<price>``, the last one before in the segment, and on each row its segment's
    first and last; ``__segment = 1`` on one row of a segment."""
    master = products.select("product_code", *[F.expr(x).alias(f"__{c}") for c, x in formulas.items()])
    out = df.join(if_small(master), "product_code", "left")
    out = out.withColumns({f"{c}_imputed": F.coalesce(f"{c}_imputed", f"__{c}") for c in formulas}).drop(*[f"__{c}" for c in formulas])
    # a date lies in one week, so that the week does not cut a segment
    rows = Window.partitionBy(*_together(df, level), order).orderBy("store_code")
    before, every = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow), rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    added = {"__segment": F.row_number().over(rows)}
    for c in formulas:
        value = F.col(f"{c}_imputed")
        added |= {f"__known_{c}": F.last(value, ignorenulls=True).over(before), f"__first_{c}": F.first(value, ignorenulls=True).over(every), f"__last_{c}": F.last(value, ignorenulls=True).over(every)}
    return out.withColumns(added)


def _with_carries(some: DataFrame, rows: DataFrame, formulas: dict[str, str], level: list[str], order: str) -> DataFrame:
    """``some`` rows of ``rows`` (of ``_with_segments``) with the values of the segments before and after theirs."""
    by = ["product_code", *level]
    segments = rows.where("__segment = 1")
    # a value from after is the last one in descending order, so that a row is looked at once
    up, down = (Window.partitionBy(*by).orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col(order).asc(), F.col(order).desc()))
    carries = segments.select(
        *by, order,
        *[F.last(f"__last_{c}", ignorenulls=True).over(up).alias(f"__before_{c}") for c in formulas],
        *[F.last(f"__first_{c}", ignorenulls=True).over(down).alias(f"__after_{c}") for c in formulas],
    )
    out = joined_null_safe(some, carries, [*by, order])
    # where nothing is known up to a row, the next value in its segment is the segment's first
    return out.withColumns({f"{c}_imputed": F.coalesce(f"__known_{c}", f"__before_{c}", f"__first_{c}", f"__after_{c}") for c in formulas})


def fill_prices(df: DataFrame, products: DataFrame, formulas: dict[str, str], level: list[str], order: str = "date") -> DataFrame:
    """``<price>_imputed``: the product's formula where NULL, then the last value before, then the first one after.

    Rows are filled in segments, a product's rows of one ``order`` value, so that a product with very many rows is spread
    over as many tasks as it has days (or weeks, where these are known). Rows are staged with their segment's first and last
    values; these are folded into carries, by windows over one row for each segment, and joined to the rows that have no value.
    """
    columns = df.columns
    rows = staged(_with_segments(df, products, formulas, level, order), "price-segments")
    done = F.lit(True)
    for c in formulas:
        done = done & F.col(f"__known_{c}").isNotNull()
    known = rows.where(done).withColumns({f"{c}_imputed": F.col(f"__known_{c}") for c in formulas})
    return known.select(*columns).unionByName(_with_carries(rows.where(~done), rows, formulas, level, order).select(*columns))


def finalise_lost_sales(df: DataFrame, qty: str = "qty", inv: str = "inventory") -> DataFrame:
    """Inventory at least the imputed quantity, lost sales, and the week's greatest inventory of a store."""
    week = Window.partitionBy("product_code", "fiscal_year_week", "store_code")
    return (
        df.withColumn(inv, F.when(F.col(inv) <= F.col(f"{qty}_imputed"), F.col(f"{qty}_imputed")).otherwise(F.col(inv)))
        .withColumn("lost_sales", F.col(f"{qty}_imputed") - F.col(qty))
        .withColumn("max_week_inventory", F.max(inv).over(week))
    )


def impute_lost_sales(
    master: DataFrame, clusters: DataFrame, cutoffs: DataFrame, products: DataFrame, level: list[str], hierarchies: list[str], prices: dict[str, str], discounts: list[str],
    qty: str = "qty", inv: str = "inventory", override: Override | None = None,
) -> DataFrame:
    """The whole step, E7 to E14: clusters, signals, quantities, first estimates, discounts, prices, lost sales.

    ``override`` replaces all of it by the user's own query over ``master, clusters, cutoffs, products``; its result has the
    columns of ``master`` and those that the step adds for the steps after it (imputed quantity and prices, lost sales).

    ``prices``: each price column and the product's formula for it. Rows are exchanged once, by product and week, and staged
    once; those that then lack a price or a discount are joined with what other days and levels have.
    """
    if override is not None:
        needed = [*master.columns, *[f"{c}_imputed" for c in (qty, *prices, *discounts)], "lost_sales"]
        return replaced(master.sparkSession, override, {"master": master, "clusters": clusters, "cutoffs": cutoffs, "products": products}, needed)
    rows = first_estimates(attach_clusters(master, clusters, level), level, list(prices), discounts, qty, inv)
    rows = impute_quantity(rows, level, qty, inv, cutoffs)
    rows = rows.drop(*[f"{c}_first_imputed" for c in (*prices, *discounts)])
    columns = [*rows.columns, "lost_sales", "max_week_inventory"]
    rows = _with_product_means(_with_segments(rows, products, prices, level, "date"), hierarchies, level, discounts, inv)
    rows = staged(finalise_lost_sales(rows, qty, inv), "imputed")
    done = F.lit(True)
    for c in [*[f"__known_{c}" for c in prices], *[f"{c}_imputed" for c in discounts]]:
        done = done & F.col(c).isNotNull()
    known = rows.where(done).withColumns({f"{c}_imputed": F.col(f"__known_{c}") for c in prices})
    some = _with_level_means(_with_carries(rows.where(~done), rows, prices, level, "date"), rows, hierarchies, level, discounts)
    return known.select(*columns).unionByName(some.select(*columns))
