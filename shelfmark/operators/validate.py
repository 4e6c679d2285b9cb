"""Validation: flags, quarantine, summaries and checks."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.joins import joined_null_safe
from shelfmark.functions.scratch import staged
from shelfmark.plans.specs import QualityError


def _any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols], F.lit(False))


def flag_nulls(df: DataFrame, non_nullable: list[str]) -> DataFrame:
    """``null_check``: a required column is NULL."""
    return df.withColumn("null_check", _any_null(non_nullable))


def flag_duplicates(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """``primary_key_check``: not the first row of its key, in the order of all columns (C4).

    The first row of each key is found by partial aggregation, where a number tells equal rows apart, and only keys of
    several rows are joined back: a key with very many rows is no single task's. ``df`` is staged, so that its rows keep
    their numbers.
    """
    rows = staged(df.withColumn("__row", F.monotonically_increasing_id()), "numbered-rows")
    first = rows.groupBy(*keys).agg(F.min(F.struct(*(order_by or df.columns), "__row"))["__row"].alias("__first"), F.count("*").alias("__rows"))
    out = joined_null_safe(rows, first.where("__rows > 1").drop("__rows"), keys)
    return out.withColumn("primary_key_check", F.coalesce(F.col("__row") != F.col("__first"), F.lit(False))).drop("__row", "__first")


def quarantine(df: DataFrame, now: datetime) -> tuple[DataFrame, DataFrame]:
    """Flagged rows to ``(clean, anomaly)``; a row that fails both checks is a null check."""
    bad = F.col("null_check") | F.col("primary_key_check")
    clean = df.where(~bad).drop("null_check", "primary_key_check")
    reason = F.when(F.col("null_check"), F.lit("null_check")).otherwise(F.lit("primary_key_check"))
    anomaly = df.where(bad).withColumns({"QC": reason, "action": F.lit("DELETE"), "insertion_date": F.lit(now)})
    return clean, anomaly.drop("null_check", "primary_key_check")


def validation_summary(flagged: DataFrame, entity: str, now: datetime) -> DataFrame:
    """Two rows, one per check: counts, percent of rows, Pass or Fail (C6). One pass over the rows."""
    counts = flagged.agg(
        F.count("*").alias("no_original_rows"),
        F.count_if("null_check").alias("null_check"),
        F.count_if(F.col("primary_key_check") & ~F.col("null_check")).alias("primary_key_check"),
    )
    long = counts.unpivot("no_original_rows", ["null_check", "primary_key_check"], "rule", "affected_rows")
    return long.select(
        F.lit(entity).alias("table"), F.lit("validation").alias("module"), "rule", F.lit("DELETE").alias("action"), "no_original_rows", "affected_rows",
        F.round(F.coalesce(F.try_divide(F.col("affected_rows") * 100.0, "no_original_rows"), F.lit(0.0)), 4).alias("affected_rows_percent"),
        F.when(F.col("affected_rows") > 0, "Fail").otherwise("Pass").alias("status"), F.lit(now).alias("insertion_date"),
    )


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """One text ``col - n`` per column with NULLs, joined in name order."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "c", "n").where("n > 0")
    return long.agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(" - ", "c", "n"))), " ' ").alias("null_columns"))


def data_loss(summary: DataFrame, clean: DataFrame, threshold: float) -> bool:
    """Whether more than ``threshold`` percent of the rows were lost."""
    original = summary.agg(F.max("no_original_rows")).first()[0] or 0
    return bool(original) and (original - clean.count()) * 100 / original > threshold


def anomaly_metrics(flagged: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """``metric, kind, value``: rows and percent of NULLs by column and of repeated keys; all are there, also as 0."""
    counts = flagged.agg(
        F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols], F.count_if("primary_key_check").alias("__keys")
    )
    long = counts.unpivot("__n", [*cols, "__keys"], "metric", "value")
    name = F.when(F.col("metric") == "__keys", F.lit("duplicate " + ",".join(keys))).otherwise(F.concat(F.lit("null "), "metric"))
    rows = long.select(name.alias("metric"), F.lit("rows").alias("kind"), F.col("value").cast("double").alias("value"))
    share = long.select(name.alias("metric"), F.lit("percent").alias("kind"), F.round(F.coalesce(F.try_divide(F.col("value") * 100.0, "__n"), F.lit(0.0)), 4).alias("value"))
    return rows.unionByName(share)


def missing_references(src: DataFrame, dst: DataFrame, key: str | list[str], reason: str) -> DataFrame:
    """Rows of ``src`` whose key ``dst`` lacks; NULL keys are missing."""
    keys = [key] if isinstance(key, str) else key
    return src.join(dst.select(*keys).distinct(), keys, "left_anti").withColumn("reason", F.lit(reason))


def generic_qc(df: DataFrame, non_nullable: list[str], keys: list[str]) -> None:
    """Raises if a required column has NULLs or a key is repeated (C11)."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in non_nullable]).first() if non_nullable else {}
    bad = [c for c in non_nullable if nulls[c]]
    repeated = bool(keys) and bool(df.groupBy(*keys).count().where("count > 1").head(1))
    if bad or repeated:
        raise QualityError("; ".join([*(f"NULL in {c}" for c in bad), *(["repeated " + ", ".join(keys)] if repeated else [])]))
