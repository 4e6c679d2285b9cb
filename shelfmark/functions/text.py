"""Column names and special characters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters and the numbers of their tokens.
SPECIAL_CHARS = {
    "'": "01", '"': "02", "/": "03", "\\": "04", "`": "05", "~": "06", "!": "07", "@": "08", "#": "09", "$": "10",
    "%": "11", "^": "12", "&": "13", "*": "14", "(": "15", ")": "16", "=": "19", "+": "20", "{": "21", "}": "22",
    "[": "23", "]": "24", "|": "25", ";": "27", "<": "28", ">": "29", ",": "30", "?": "32", "\t": "33",
}
TOKEN = "__ia_char_"


def normalise_names(df: DataFrame, replacement: str = "") -> DataFrame:
    """Names without characters other than letters, digits and ``_`` (A7). Names that become equal get a suffix."""
    seen: dict[str, int] = {}
    out = []
    for name in df.columns:
        new = re.sub(r"[^A-Za-z0-9_]", replacement, name)
        n = seen.get(new, 0)
        seen[new] = n + 1
        out.append(f"{new}_{n}" if n else new)
    return df.toDF(*out)


def _string_columns(df: DataFrame, cols: list[str] | None) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (cols is None or f.name in cols)]


def _fold(column: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        column = F.replace(column, F.lit(old), F.lit(new))
    return column


def encode_special_chars(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Special characters of string columns as tokens (A10). Tokens hold none of them, so the order is free."""
    pairs = [(c, TOKEN + n) for c, n in SPECIAL_CHARS.items()]
    return df.withColumns({c: _fold(F.col(c), pairs) for c in _string_columns(df, cols)})


def decode_special_chars(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The inverse of ``encode_special_chars``."""
    pairs = [(TOKEN + n, c) for c, n in SPECIAL_CHARS.items()]
    return df.withColumns({c: _fold(F.col(c), pairs) for c in _string_columns(df, cols)})
