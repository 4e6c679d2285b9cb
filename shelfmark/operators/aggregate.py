"""Feature aggregation, product buckets and derived tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.override import Override, replaced
from shelfmark.functions.scratch import staged
from shelfmark.operators.rules import run_rules
from shelfmark.operators.tables import check_schema_drift, replace_from_week, write_table
from shelfmark.plans.specs import DerivedSpec, Feature, QualityError, Rule

GRAINS = ("date", "fiscal_year_week", "fiscal_year_month", "fiscal_year_quarter", "fiscal_year")
PER_BUCKET = 200


def aggregate_features(df: DataFrame, group_cols: list[str], features: list[Feature], where: str | None = None, override: Override | None = None) -> DataFrame:
    """Features by group (E26). ``override`` replaces them by the user's own query over ``rows``, which gives the groups'
    columns and the features' under their names."""
    if override is not None:
        return replaced(df.sparkSession, override, {"rows": df}, [*group_cols, *[f.name for f in features]])
    rows = df.where(F.expr(where)) if where else df
    return rows.groupBy(*group_cols).agg(*[F.expr(f.expr).alias(f.name) for f in features])


def publish_features(features: DataFrame, table: str, week_col: str = "fiscal_year_week", historic: bool = False, from_week: int | None = None) -> DataFrame:
    """Features as a table (E26): a historic run replaces it; another replaces the weeks from ``from_week`` on, or from the
    first week that it brings. Columns that the table lacks are an error."""
    spark = features.sparkSession
    if historic or not spark.catalog.tableExists(table):
        write_table(features, table, "TRUNCATE")
        return spark.table(table)
    old = spark.table(table)
    check_schema_drift(features.columns, old.columns)
    # staged: the new table is made of the old one, and a changed plan must not change what is judged
    write_table(staged(replace_from_week(old, staged(features, "features"), week_col, from_week), "features"), table, "TRUNCATE")
    return spark.table(table)


def week_window(calendar: DataFrame, last_week: int | None, today: date) -> tuple[int | None, int | None]:
    """The weeks to aggregate: from the last stored one to the last one that is complete."""
    weeks = calendar.groupBy("fiscal_year_week").agg(F.max("date").alias("d")).where(F.col("d") < F.lit(today))
    low, high = weeks.agg(F.min("fiscal_year_week"), F.max("fiscal_year_week")).first()
    return (last_week if last_week is not None else low), high


def aggregate_grid(df: DataFrame, hierarchies: list[str], time_grain: str | list[str], features: list[Feature]) -> DataFrame:
    """Features of every hierarchy prefix at one or more time grains, in one pass of grouping sets.

    Columns: the grains and levels (NULL where a set leaves them out), ``level`` (how many are named) and the features.
    """
    grains = [time_grain] if isinstance(time_grain, str) else list(time_grain)
    sets = [[g, *hierarchies[:n]] for g in grains for n in range(1, len(hierarchies) + 1)]
    cols = [*grains, *hierarchies]
    named = reduce(lambda a, b: a + b, [1 - F.grouping(h) for h in hierarchies])
    grain = F.lit(None).cast("string")
    for g in grains:
        grain = F.when(F.grouping(g) == 0, F.lit(g)).otherwise(grain)
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(
        named.cast("int").alias("level"), grain.alias("time_grain"), *[F.expr(f.expr).alias(f.name) for f in features]
    )


def pseudo_level(levels: list[str]) -> Column:
    """The first five hex digits of SHA-256 of each level's name."""
    return F.concat(*[F.substring(F.sha2(F.coalesce(F.col(c), F.lit("")), 256), 1, 5) for c in levels])


def bucket_products(products: DataFrame, levels: list[str], per_bucket: int = PER_BUCKET) -> DataFrame:
    """``mp_bucket_code``: products of a hierarchy dealt evenly to as many buckets as ``per_bucket`` needs."""
    by = Window.partitionBy(*levels)
    n = F.count("*").over(by)
    bucket = F.ceil(F.row_number().over(by.orderBy("product_code")) * F.ceil(n / per_bucket) / n)
    return products.drop("mp_bucket_code").withColumn("mp_bucket_code", F.concat(pseudo_level(levels), F.lit("_"), bucket.cast("long").cast("string")))


def product_counts(products: DataFrame, levels: list[str]) -> DataFrame:
    """Products of each hierarchy, the lookup that the next run compares with."""
    return products.groupBy(*levels).agg(F.countDistinct("product_code").alias("num_products"))


def rebucket_products(products: DataFrame, lookup: DataFrame, levels: list[str], per_bucket: int = PER_BUCKET) -> DataFrame:
    """New codes only where a hierarchy grew; else each product keeps its old code.

    ``lookup``: ``levels..., num_products, product_code, mp_bucket_code`` of the last run.
    """
    old_counts = lookup.select(*levels, F.col("num_products").alias("__old")).distinct()
    old_codes = lookup.select("product_code", F.col("mp_bucket_code").alias("__code")).distinct()
    grown = product_counts(products, levels).join(old_counts, levels, "left").select(*levels, (F.col("num_products") > F.coalesce("__old", F.lit(0))).alias("__grown"))
    fresh = bucket_products(products, levels, per_bucket).join(grown, levels, "left").join(old_codes, "product_code", "left")
    return fresh.withColumn("mp_bucket_code", F.when(F.col("__grown"), F.col("mp_bucket_code")).otherwise(F.col("__code"))).drop("__grown", "__code")


def run_derived(spark: SparkSession, specs: list[DerivedSpec], historic: bool) -> dict[str, DataFrame]:
    """Derived tables in their order; each is a view for those after it."""
    out = {}
    for spec in sorted(specs, key=lambda s: (s.order, s.name)):
        text = spec.historic if historic or spec.periodic is None else spec.periodic
        df = spark.sql(text) if isinstance(text, str) else text(spark)
        df.createOrReplaceTempView(spec.name)
        out[spec.name] = df
    return out


def publish_derived(
    spark: SparkSession, specs: list[DerivedSpec], historic: bool, rules: dict[str, list[Rule]] | None = None, kpis: dict | None = None, due: set[str] | None = None,
) -> DataFrame:
    """Derived tables as tables: each is staged, checked by its rules, and published (E31); ``due`` picks the ones whose
    turn it is (E32). The result is the checks' summary.

    A periodic run of a table that does not replace appends; all others replace. A failed PAUSE stops before that table is
    published and leaves the staged one for inspection.
    """
    summaries = []
    for spec in sorted((s for s in specs if due is None or s.name in due), key=lambda s: (s.order, s.name)):
        text = spec.historic if historic or spec.periodic is None else spec.periodic
        staging = f"{spec.name}__staged"
        write_table(spark.sql(text) if isinstance(text, str) else text(spark), staging, "TRUNCATE")
        outcome = run_rules({spec.name: spark.table(staging)}, spec.name, (rules or {}).get(spec.name, []), kpis or {})
        summaries.append(outcome.summary)
        if outcome.paused:
            raise QualityError(f"{spec.name} is paused: see {staging}")
        write_table(outcome.clean, spec.name, "TRUNCATE" if historic or spec.replace else "APPEND")
        spark.sql(f"DROP TABLE {staging}")
    if not summaries:
        raise ValueError("no derived table is due")
    return reduce(DataFrame.unionByName, summaries)


def job_cost_summary(log: DataFrame, jobs: DataFrame, rate: float = 0.06) -> DataFrame:
    """Per job: seconds, slot time, bytes, and cost as text (E33). ``log``: ``job_id, start, end, slot_ms, bytes``."""
    used = log.groupBy("job_id").agg(
        F.round(F.max(F.col("end").cast("double")) - F.min(F.col("start").cast("double")), 3).alias("seconds"), F.sum("slot_ms").alias("slot_ms"), F.sum("bytes").alias("bytes")
    )
    cost = F.concat(F.lit("$"), F.format_number(F.col("slot_ms") * rate / 3_600_000, 4))
    return jobs.join(used, "job_id", "left").withColumn("cost", F.coalesce(cost, F.lit("$0.0000")))
