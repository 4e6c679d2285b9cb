"""Raw tables to typed entities, driven by column mappings."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.plans.specs import ColumnMapping


def apply_mapping(raw: DataFrame, mapping: list[ColumnMapping] | tuple[ColumnMapping, ...]) -> DataFrame:
    """Formula columns, renamed and cast columns, typed NULLs for the rest, and source columns that no mapping uses.

    Casts are safe: what cannot be cast is NULL. Formulas see the source's names.
    """
    out, used = [], set()
    for m in mapping:
        if m.formula:
            value = F.expr(m.formula)
            used |= {c for c in raw.columns if re.search(rf"(?<!\w){re.escape(c)}(?!\w)", m.formula)}
        elif m.source and m.source in raw.columns:
            value = F.col(m.source)
            used.add(m.source)
        else:
            value = F.lit(None)
        # through text, so that a value of any type is tried
        out.append((value.try_cast(m.dtype) if m.formula or m.source else value.cast(m.dtype)).alias(m.generic))
    taken = {m.generic for m in mapping}
    return raw.select(*out, *[F.col(c) for c in raw.columns if c not in used and c not in taken])


def apply_watermark(raw: DataFrame, col: str | None, value) -> DataFrame:
    """Rows past the mark; all rows without one."""
    return raw if not col or value is None else raw.where(F.col(col) > F.lit(value))


def select_except(df: DataFrame, cols: list[str]) -> DataFrame:
    """All columns but these."""
    return df.drop(*cols)
