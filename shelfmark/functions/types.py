"""Types of databases and warehouses as Spark types."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Type names by their Spark type.
_SHARED = {
    T.LongType(): "tinyint smallint mediumint int integer bigint int2 int4 int8 int64 byteint serial bigserial smallserial",
    T.DoubleType(): "float float4 float8 float64 real double",
    T.BooleanType(): "bool boolean bit",
    T.StringType(): "char character varchar nchar nvarchar text tinytext mediumtext longtext string uuid xml time json jsonb variant object struct geography",
    T.BinaryType(): "bytes bytea binary varbinary blob",
    T.DateType(): "date",
    T.TimestampNTZType(): "datetime datetime2 smalldatetime timestamp_ntz",
    T.TimestampType(): "timestamp timestamptz timestamp_tz timestamp_ltz datetimeoffset",
    T.DecimalType(38, 9): "decimal numeric number",
    T.DecimalType(38, 18): "bignumeric bigdecimal money smallmoney",
    T.DayTimeIntervalType(): "interval",
}
_NAMES = {name: dtype for dtype, names in _SHARED.items() for name in names.split()}
#: Names that one system reads otherwise.
_SYSTEMS = {
    "mssql": {"numeric": T.DecimalType(38, 18), "decimal": T.DecimalType(38, 18), "timestamp": T.BinaryType()},
    "oracle": {"date": T.TimestampNTZType(), "varchar2": T.StringType(), "nvarchar2": T.StringType(), "clob": T.StringType(), "raw": T.BinaryType()},
    "postgresql": {"timestamp": T.TimestampNTZType()},
    "mysql": {}, "warehouse": {}, "snowflake": {},
}


def map_type(type_name: str, system: str = "warehouse", overrides: dict[str, T.DataType] | None = None) -> T.DataType:
    """The Spark type of a database type; ``T[]`` and ``array<T>`` give arrays; ``overrides`` win. Unknown: ValueError."""
    name = type_name.strip().lower()
    if overrides and name in overrides:
        return overrides[name]
    if m := re.fullmatch(r"(?:array<(.+)>|(.+)\[\])", name):
        return T.ArrayType(map_type(m[1] or m[2], system, overrides))
    if m := re.fullmatch(r"(?:decimal|numeric|number)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", name):
        return T.DecimalType(min(int(m[1]), 38), int(m[2] or 0))
    base = re.sub(r"\(.*?\)", "", name).strip()
    base = {"double precision": "double", "character varying": "varchar", "timestamp with time zone": "timestamptz", "timestamp without time zone": "timestamp_ntz", "time without time zone": "time"}.get(base, base)
    found = _SYSTEMS.get(system, {}).get(base) or _NAMES.get(base)
    if found is None:
        raise ValueError(f"unknown type {type_name!r} of {system}")
    return found
