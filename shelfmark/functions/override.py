"""Whole steps that a user's own query replaces."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.plans.specs import SchemaDrift

#: SQL in which the step's inputs stand by name in braces (other braces are doubled), or a callable that takes them by name.
Override = str | Callable[..., DataFrame]


def replaced(spark: SparkSession, override: Override, inputs: dict[str, DataFrame], needed: Iterable[str]) -> DataFrame:
    """The user's result in place of a step's; columns that later steps need and it lacks are an error.

    SQL is planned over the inputs themselves, so filters and columns reach their scans, and no view is left behind.
    """
    out = spark.sql(override, **inputs) if isinstance(override, str) else override(**inputs)
    if missing := [c for c in needed if c not in out.columns]:
        raise SchemaDrift(f"the query that replaces the step has no {', '.join(missing)}")
    return out
