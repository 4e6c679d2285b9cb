"""How a forecast is split over stores and over days of the week."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.joins import if_small, joined_null_safe
from shelfmark.functions.scratch import staged
from shelfmark.operators.calendar import week_rank
from shelfmark.operators.hierarchy import levels_of, levels_up_to

ZERO_SHARE, TOLERANCE = 0.05, 1e-6


def split_base(stores: DataFrame, products: DataFrame, mapping: DataFrame) -> DataFrame:
    """Active pairs of product and store, with the store's channel and the product's hierarchy."""
    levels = levels_of(products.columns)
    return (
        # dealt out by product, as the join with products and later that with sales need it
        mapping.where("is_active").select("product_code", "store_code").repartition("product_code").distinct()
        .join(if_small(stores.select("store_code", "channel").distinct()), "store_code")
        .join(products.select("product_code", *levels).distinct(), "product_code")
    )


def last_sale(transactions: DataFrame, stores: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """One row: the last day, and with a calendar the last week, on which a known store sold something."""
    sold = transactions.where("qty > 0").join(if_small(stores.select("store_code").distinct()), "store_code", "left_semi")
    last = sold.agg(F.max("date").alias("__last"))
    if calendar is None:
        return last
    # a calendar is small, and so is this
    numbered = calendar.select("date", "fiscal_year_week").join(week_rank(calendar), "fiscal_year_week")
    days = sold.select("date").distinct().join(F.broadcast(numbered), "date")
    return days.agg(F.max("date").alias("__last"), F.max("week_no").alias("__last_week"))


def recent_sales(transactions: DataFrame, stores: DataFrame, days: int = 56) -> DataFrame:
    """Sales of product and store over the last ``days`` days, counted from the last sale of a known store."""
    last = F.broadcast(last_sale(transactions, stores))
    return (
        transactions.where("qty > 0").crossJoin(last).where(F.col("date").between(F.date_sub("__last", days - 1), F.col("__last")))
        .groupBy("product_code", "store_code").agg(F.sum("qty").alias("sales_art"))
    )


def recent_inventory(inventory: DataFrame, transactions: DataFrame, stores: DataFrame, calendar: DataFrame, weeks: int = 8) -> DataFrame:
    """The greatest stock of product and store from ``weeks`` before the last week with sales up to that week."""
    numbered = calendar.select("date", "fiscal_year_week").join(F.broadcast(week_rank(calendar)), "fiscal_year_week")
    rows = inventory.where("oh > 0").join(F.broadcast(numbered), "date").crossJoin(F.broadcast(last_sale(transactions, stores, calendar)))
    within = F.col("week_no").between(F.col("__last_week") - weeks, F.col("__last_week"))
    return rows.where(within).groupBy("product_code", "store_code").agg(F.max("oh").alias("oh"))


def _without_prefix_sales(df: DataFrame, levels: list[str]) -> DataFrame:
    return df.drop(*[f"r_h{n}_store" for n in range(1, len(levels) + 1)])


def prefix_sales(base: DataFrame, levels: list[str]) -> DataFrame:
    """``r_h1_store`` ...: a store's sales of each hierarchy prefix.

    Rows are exchanged by store and sorted once; a store has no more rows than there are products.
    """
    out = _without_prefix_sales(base, levels).repartition("channel", "store_code").sortWithinPartitions("channel", "store_code", *levels)
    for n in range(1, len(levels) + 1):
        out = out.withColumn(f"r_h{n}_store", F.sum("sales_art_store").over(Window.partitionBy("channel", "store_code", *levels[:n])))
    return out


def _filled_prefixes(rows: DataFrame, levels: list[str]) -> DataFrame:
    """``rows`` of ``prefix_sales`` with the cluster's mean of the others where a prefix's sales are 0.

    The means are as many as clusters and prefixes together: sums by the whole prefix, of which those of shorter ones are sums.
    """
    numbers = range(1, len(levels) + 1)
    sold = {n: F.when(F.col(f"r_h{n}_store") != 0, F.col(f"r_h{n}_store")) for n in numbers}
    sums = [f(v).alias(f"__{p}{n}") for n, v in sold.items() for p, f in (("sum", F.sum), ("count", F.count))]
    whole = staged(rows.groupBy("channel", "cluster_name", *levels).agg(*sums), "prefix-sums")
    for n in numbers:
        by = ["channel", "cluster_name", *levels[:n]]
        mean = whole.groupBy(*by).agg(F.try_divide(F.sum(f"__sum{n}"), F.sum(f"__count{n}")).alias(f"__mean{n}"))
        rows = joined_null_safe(rows, if_small(mean), by)
        rows = rows.withColumn(f"r_h{n}_store", F.when(F.col(f"r_h{n}_store") == 0, F.col(f"__mean{n}")).otherwise(F.col(f"r_h{n}_store"))).drop(f"__mean{n}")
    return rows


def fill_zero_sales(base: DataFrame, levels: list[str]) -> DataFrame:
    """``r_h1_store`` ... and the product's sales, where 0 the cluster's mean of the others; then totals over a product's
    stores (E18, E19).

    ``base`` is exchanged by store for the sales of prefixes and staged, since means of all clusters are needed; it is exchanged
    once more, by product, for the product's means and totals. A product has no more rows than there are stores.
    """
    rows = _filled_prefixes(staged(prefix_sales(base, levels), "split-base"), levels)
    of_cluster = ["channel", "product_code", *levels, "cluster_name"]
    rows = rows.repartition("channel", "product_code").sortWithinPartitions(*of_cluster)
    sales, product = F.col("sales_art_store"), Window.partitionBy("channel", "product_code")
    mean = F.avg(F.when(sales != 0, sales)).over(Window.partitionBy(*of_cluster))
    rows = rows.withColumn("__mean", mean).withColumn("sales_art_store", F.when(sales == 0, F.col("__mean")).otherwise(sales)).drop("__mean")
    totals = {f"r_h{n}": F.sum(f"r_h{n}_store").over(product) for n in range(1, len(levels) + 1)}
    return rows.withColumns(totals | {"sales_art": F.sum("sales_art_store").over(product)})


def proportions(df: DataFrame, levels: list[str]) -> DataFrame:
    """A store's share of each total, 0 where there is none."""
    out = df.withColumn("store_split", F.coalesce(F.try_divide("sales_art_store", "sales_art"), F.lit(0.0)))
    for n in range(1, len(levels) + 1):
        out = out.withColumn(f"r_store_split_h{n}", F.coalesce(F.try_divide(f"r_h{n}_store", f"r_h{n}"), F.lit(0.0)))
    return out


def choose_level(df: DataFrame, levels: list[str], level: str) -> DataFrame:
    """``overall_proportion``: the deepest level of which at most 5 % are zero within the split's group, else the top."""
    group = levels_up_to([*levels, "product_code"], level)
    candidates = [*(["store_split"] if level == "product_code" else []), *[f"r_store_split_h{n}" for n in range(min(len(group), len(levels)), 1, -1)]]
    top = F.col("r_store_split_h1")
    if not candidates:
        return df.withColumn("overall_proportion", F.coalesce(top, F.lit(0.0)))
    # the split needs a group's rows in one place too
    by = Window.partitionBy(*group, "channel")
    out = df.withColumns({f"__zero_{c}": F.count_if(F.coalesce(F.col(c), F.lit(0.0)) == 0).over(by) / F.count("*").over(by) for c in candidates})
    chosen = top
    for c in reversed(candidates):
        chosen = F.when(F.col(f"__zero_{c}") <= ZERO_SHARE, F.col(c)).otherwise(chosen)
    return out.withColumn("overall_proportion", F.coalesce(chosen, F.lit(0.0))).drop(*[f"__zero_{c}" for c in candidates])


def final_store_split(df: DataFrame, hierarchies: DataFrame, levels: list[str], level: str) -> DataFrame:
    """Contributions that sum to 1 by hierarchy and channel; a group that does not is split evenly."""
    group = levels_up_to([*levels, "product_code"], level)
    by = Window.partitionBy(*group, "channel")
    sums = df.groupBy(*group, "store_code", "channel").agg(F.sum("overall_proportion").alias("contribution"))
    codes = hierarchies.where(F.col("level") == len(group)).select(*group, "hierarchy_code").distinct()
    normal = sums.withColumn("n", F.try_divide("contribution", F.sum("contribution").over(by))).join(if_small(codes), group)
    total = F.sum("n").over(by)
    even = F.lit(1.0) / F.count("*").over(by)
    bad = total.isNull() | (F.abs(total - 1) > TOLERANCE)
    return normal.withColumn("store_split", F.when(bad, even).otherwise(F.col("n"))).select("store_code", "channel", *group, "hierarchy_code", "store_split")


def store_split(
    stores: DataFrame, products: DataFrame, mapping: DataFrame, transactions: DataFrame, clusters: DataFrame, hierarchies: DataFrame, level: str,
) -> DataFrame:
    """Each store's share of a hierarchy's sales by channel (E15-E22); recent stock (E17) has no part in it."""
    levels = levels_of(products.columns)
    base = (
        split_base(stores, products, mapping)
        .join(recent_sales(transactions, stores), ["product_code", "store_code"], "left")
        .withColumn("sales_art_store", F.coalesce("sales_art", F.lit(0.0)))
        .drop("sales_art")
        .join(if_small(clusters.select("store_code", "channel", "cluster_name").distinct()), ["store_code", "channel"], "left")
    )
    shares = proportions(fill_zero_sales(base, levels), levels)
    return final_store_split(choose_level(shares, levels, level), hierarchies, levels, level)


def day_split(
    master: DataFrame, products: DataFrame, calendar: DataFrame, hierarchies: DataFrame, level: str, events: list[str], qty: str, since: date, until: date,
) -> DataFrame:
    """The share of each day of the week by channel and hierarchy, over days without events.

    Channels, hierarchies and seven days are completed; missing shares are the channel's; shares sum to 1.
    """
    levels = levels_of(products.columns)
    group = levels_up_to([*levels, "product_code"], level)
    plain = master.where((F.col(qty) > 0) & F.col("date").between(F.lit(since), F.lit(until)))
    for e in events:
        plain = plain.where(F.coalesce(F.col(e), F.lit(0)) == 0)
    by_day = plain.groupBy("channel", *group, F.dayofweek("date").alias("dayofweek")).agg(F.sum(qty).alias("day_qty"))
    total = Window.partitionBy("channel", *group)
    by_day = by_day.withColumn("ratio", F.try_divide("day_qty", F.sum("day_qty").over(total)))
    channels = master.where("channel IS NOT NULL").select("channel").distinct()
    days = calendar.select(F.dayofweek("date").alias("dayofweek")).distinct()
    # every combination is wanted: channels and weekdays are few
    grid = products.where(F.col(group[-1]).isNotNull()).select(*group).distinct().crossJoin(F.broadcast(channels)).crossJoin(F.broadcast(days))
    of_channel = by_day.groupBy("channel", "dayofweek").agg(F.sum("day_qty").alias("c"))
    of_channel = of_channel.withColumn("channel_ratio", F.try_divide("c", F.sum("c").over(Window.partitionBy("channel")))).select("channel", "dayofweek", "channel_ratio")
    full = grid.join(by_day, ["channel", *group, "dayofweek"], "left").join(F.broadcast(of_channel), ["channel", "dayofweek"], "left")
    full = full.withColumn("ratio", F.coalesce("ratio", "channel_ratio"))
    full = full.withColumn("day_split", F.try_divide("ratio", F.sum("ratio").over(total)))
    codes = hierarchies.where(F.col("level") == len(group)).select(*group, "hierarchy_code").distinct()
    return full.join(codes, group).select("channel", *group, "hierarchy_code", "dayofweek", "day_split")
