"""Watermarks, row counts and the readiness of landing folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def advance_watermark(control: DataFrame, loaded: DataFrame, view: str, col: str | None, before: int, after: int, pull_type: str, now: datetime | None = None) -> DataFrame:
    """``control(view, extraction_sync_dt)`` with the view's mark moved to the newest loaded value, only if rows came.

    An incremental pull brought rows if the table grew, a full one if it is not empty. Without a column the mark is ``now``.
    """
    came = after > before if pull_type == "incremental" else after > 0
    if not came:
        return control
    mark = loaded.agg(F.max(F.col(col).cast("timestamp")).alias("__mark")) if col else loaded.sparkSession.createDataFrame([(now or datetime.now(),)], "__mark timestamp")
    return control.crossJoin(F.broadcast(mark)).withColumn(
        "extraction_sync_dt", F.when(F.col("view") == view, F.coalesce("__mark", "extraction_sync_dt")).otherwise(F.col("extraction_sync_dt"))
    ).drop("__mark")


def reconcile_counts(loaded: DataFrame, manifests: DataFrame) -> DataFrame:
    """Loaded rows against the manifests' (C14).

    ``loaded``: ``view, replace, before, after``; ``manifests``: ``view`` and ``row_count`` in any case of its name.
    """
    lower = manifests.toDF(*[c.lower() for c in manifests.columns])
    stated = lower.groupBy("view").agg(F.sum("row_count").alias("manifest_rows"))
    rows = F.when(F.col("replace"), F.col("after")).otherwise(F.col("after") - F.col("before"))
    return loaded.withColumn("loaded_rows", rows).join(stated, "view", "left").select(
        "view", "loaded_rows", "manifest_rows", F.col("loaded_rows").eqNullSafe(F.col("manifest_rows")).alias("matches")
    )


def landing_readiness(listing: DataFrame, calendar: DataFrame, trigger: str, mandatory: bool) -> DataFrame:
    """``folder_date, has_trigger, ready`` of each expected date.

    ``listing``: ``folder_date, file``; ``calendar``: ``folder_date``. A mandatory view is ready up to its first gap.
    """
    found = listing.where(F.col("file") == trigger).select("folder_date").distinct().withColumn("__t", F.lit(True))
    joined = calendar.select("folder_date").distinct().join(found, "folder_date", "left").select("folder_date", F.coalesce("__t", F.lit(False)).alias("has_trigger"))
    if not mandatory:
        return joined.withColumn("ready", F.col("has_trigger"))
    # one row per expected day
    gap = joined.where(~F.col("has_trigger")).agg(F.min("folder_date").alias("gap"))
    return joined.crossJoin(F.broadcast(gap)).select("folder_date", "has_trigger", (F.col("gap").isNull() | (F.col("folder_date") < F.col("gap"))).alias("ready"))
