"""Sinks and maintenance of tables: writes, upserts, replaced windows, deltas and attribute tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.plans.specs import SchemaDrift

MAX_CLUSTER_COLUMNS = 4


def write_table(df: DataFrame, name: str, disposition: str, create: str = "if_needed") -> None:
    """TRUNCATE replaces the table, APPEND inserts by name; ``create="never"`` fails where it is missing (B1)."""
    spark = df.sparkSession
    if create == "never" and not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    if disposition == "TRUNCATE":
        df.write.mode("overwrite").saveAsTable(name)
    elif disposition == "APPEND":
        if spark.catalog.tableExists(name):
            df = df.select(*spark.table(name).columns)
        df.write.mode("append").saveAsTable(name)
    else:
        raise ValueError(f"unknown disposition {disposition!r}")


def write_partitioned(df: DataFrame, name: str, partition_col: str | list[str] | None = None, cluster_cols: tuple[str, ...] = ()) -> None:
    """Partitioned by a date (timestamps: by day) and sorted by up to four columns within files (B2)."""
    cols = [partition_col] if isinstance(partition_col, str) else list(partition_col or ())
    if len(cols) > 1:
        raise ValueError("at most one partition column")
    if len(cluster_cols) > MAX_CLUSTER_COLUMNS:
        raise ValueError(f"at most {MAX_CLUSTER_COLUMNS} cluster columns")
    if not cols:
        (df.sortWithinPartitions(*cluster_cols) if cluster_cols else df).write.mode("overwrite").saveAsTable(name)
        return
    dtype = df.schema[cols[0]].dataType
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"{cols[0]} is no date")
    by = cols[0] if isinstance(dtype, T.DateType) else f"{cols[0]}_day"
    if by != cols[0]:
        df = df.withColumn(by, F.to_date(cols[0]))
    # rows of a day may be many: spread by the cluster columns too
    df = df.repartition(by, *cluster_cols).sortWithinPartitions(by, *cluster_cols)
    df.write.mode("overwrite").partitionBy(by).saveAsTable(name)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], cols: list[str], unmatched_target: str = "keep", partition_col: str | None = None,
) -> DataFrame:
    """The new snapshot of ``target``: matched rows take the source's ``cols``, unmatched source rows are inserted.

    Rows that only the target has are kept, deleted, or deactivated (``active`` false) (B3-B5). With ``partition_col``
    only the target's partitions that occur in the source are joined; the others pass through (B6). NULL keys match
    NULL keys. The source's keys must be unique.
    """
    if unmatched_target not in ("keep", "delete", "deactivate"):
        raise ValueError(f"unknown choice {unmatched_target!r}")
    untouched = None
    if partition_col and unmatched_target == "keep":
        touched = source.select(F.col(partition_col).alias("__p")).distinct()
        same = F.col(partition_col).eqNullSafe(F.col("__p"))
        untouched = target.join(touched, same, "left_anti")
        target = target.join(touched, same, "left_semi")
    s = source.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*keys, *cols).alias("__s"))
    t = target.select(*keys, F.struct(*target.columns).alias("__t"))
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        on = c if on is None else on & c
    joined = t.join(s, on, "full_outer")
    if unmatched_target == "delete":
        joined = joined.where("__s IS NOT NULL")
    out = []
    for f in target.schema.fields:
        old = F.col("__t")[f.name]
        if f.name in keys or f.name in cols:
            c = F.when(F.col("__s").isNotNull(), F.col("__s")[f.name]).otherwise(old)
        else:
            c = old
        if unmatched_target == "deactivate" and f.name == "active":
            c = F.when(F.col("__s").isNull(), F.lit(False)).otherwise(F.coalesce(c, F.lit(True)))
        out.append(c.cast(f.dataType).alias(f.name))
    merged = joined.select(*out)
    return merged if untouched is None else merged.unionByName(untouched)


def replace_window(target: DataFrame, staged: DataFrame, date_col: str, days: int, today: date) -> DataFrame:
    """``target`` without rows after ``today - days``, and the staged rows."""
    cut = today - timedelta(days=days)
    return target.where(~F.coalesce(F.col(date_col) > F.lit(cut), F.lit(False))).unionByName(staged.select(*target.columns))


def replace_from_week(target: DataFrame, staged: DataFrame, week_col: str = "fiscal_year_week", from_week: int | None = None) -> DataFrame:
    """``target`` before a week (the first staged one unless given), and the staged rows."""
    if from_week is None:
        from_week = staged.agg(F.min(week_col)).first()[0]
        if from_week is None:
            return target
    return target.where(~F.coalesce(F.col(week_col) >= from_week, F.lit(False))).unionByName(staged.select(*target.columns))


def compute_delta(validated: DataFrame, master: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """``__record_type`` 1: new or changed rows; 0: the master's rows whose keys are gone, with their values."""
    wanted = [*keys, *[c for c in cols if c not in keys]]
    changed = validated.select(*wanted).subtract(master.select(*wanted)).withColumn("__record_type", F.lit(1))
    v = validated.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        on = c if on is None else on & c
    gone = master.select(*wanted).join(v, on, "left_anti").withColumn("__record_type", F.lit(0))
    return changed.unionByName(gone)


def check_schema_drift(new_cols: list[str], old_cols: list[str]) -> None:
    """Columns that the target lacks are an error."""
    if missing := sorted(set(new_cols) - set(old_cols)):
        raise SchemaDrift(", ".join(missing))


def attributes_long(df: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """``keys..., attribute_name, attribute_value``: scalars as strings, complex values as JSON, NULL kept."""
    def text(c: str):
        complex_ = isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType))
        return (F.to_json(c) if complex_ else F.col(c).cast("string")).alias(c)

    narrow = df.select(*keys, *[text(c) for c in attrs])
    return narrow.unpivot(keys, attrs, "attribute_name", "attribute_value")


def attributes_delta(delta: DataFrame, existing: DataFrame, keys: list[str], attrs: list[str], refresh: bool = False) -> DataFrame:
    """Attribute rows that the table lacks; all of them when the attribute schema changed."""
    rows = attributes_long(delta, keys, attrs)
    known = existing.select("attribute_name").distinct()
    if refresh or rows.select("attribute_name").distinct().join(known, "attribute_name", "left_anti").head(1):
        return rows.distinct()
    return rows.subtract(existing.select(*rows.columns))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batchsize: int = 1000, column_types: str | None = None, props: dict | None = None) -> None:
    """Batched inserts; ``mode="overwrite"`` replaces the table."""
    writer = df.write.option("batchsize", batchsize)
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    writer.jdbc(url, table, mode=mode, properties=props or {})


def copy_tables(spark: SparkSession, mapping: str | dict[str, str], writer: Callable[[DataFrame, str], None]) -> None:
    """Copies each ``source:target`` of the mapping."""
    if isinstance(mapping, str):
        mapping = dict(p.split(":", 1) for p in mapping.split(",") if p.strip())
    for source, target in mapping.items():
        writer(spark.table(source.strip()), target.strip())


def _flat(df: DataFrame, glue: str) -> DataFrame:
    return df.select(
        *[F.array_join(F.col(f.name).cast("array<string>"), glue).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name) for f in df.schema.fields]
    )


def export_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True) -> None:
    """Delimited files; values are quoted only between commas."""
    writer = df.write.mode("overwrite")
    if sep == ",":
        writer.csv(path, sep=sep, header=header, quoteAll=True)
    else:
        writer.csv(path, sep=sep, header=header, quote="\u0000", escapeQuotes=False, emptyValue="")


def anomaly_rows(df: DataFrame, bookkeeping: tuple[str, ...] = ("QC", "action", "insertion_date")) -> DataFrame:
    """Rejected rows as they came: without bookkeeping columns, arrays joined with `` | ``."""
    return _flat(df.drop(*bookkeeping), " | ")


def anomaly_path(root: str, entity: str, on: date) -> str:
    """The dated folder of an entity's rejected rows."""
    return f"{root.rstrip('/')}/{on:%Y-%m-%d}/{entity}"


def export_anomalies(df: DataFrame, root: str, entity: str, on: date, sep: str = "|") -> str:
    """Writes ``anomaly_rows`` with a header to the day's folder, over what is there; gives the folder."""
    path = anomaly_path(root, entity, on)
    anomaly_rows(df).write.mode("overwrite").csv(path, sep=sep, header=True)
    return path


def backup_table(spark: SparkSession, name: str, on: date) -> str:
    """A dated copy of a table."""
    target = f"{name}__{on:%Y_%m_%d}"
    spark.table(name).write.mode("overwrite").saveAsTable(target)
    return target


def ensure_column(df: DataFrame, name: str, default) -> DataFrame:
    """The column with a default where it is missing."""
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def publish_passthrough(spark: SparkSession, src: str, dst: str) -> None:
    """Publishes a table under another name."""
    spark.table(src).write.mode("overwrite").saveAsTable(dst)


def append_summary(df: DataFrame, rows: list[dict]) -> DataFrame:
    """``df`` with rows appended, typed by its schema."""
    extra = df.sparkSession.createDataFrame([tuple(r.get(f.name) for f in df.schema.fields) for r in rows], df.schema)
    return df.unionByName(extra)
