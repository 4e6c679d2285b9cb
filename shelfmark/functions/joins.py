"""Joins with tables of groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows up to which a table of stores, products or groups is broadcast.
FEW = 1_000_000


def if_small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast where it has few rows; it is counted, so it should cost little to make."""
    return F.broadcast(df) if df.count() <= FEW else df


def joined_null_safe(df: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """All rows of ``df`` with the further columns of ``groups``, unique by ``by``; NULL keys are equal."""
    named = groups.select([F.col(c).alias(f"__{c}") for c in by] + [F.col(c) for c in groups.columns if c not in by])
    return df.join(named, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by], "left").drop(*[f"__{c}" for c in by])
