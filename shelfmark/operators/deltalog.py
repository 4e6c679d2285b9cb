"""A table as a base snapshot and a log of batches: a batch writes what it changes, the newest version wins on reading.

Rows lie in buckets by a hash of their keys. ``<path>/base/gen=<g>/__bucket=<b>`` holds base rows, ``<path>/delta/
__batch=<id>/__bucket=<b>`` what a batch brought, and ``<path>/manifest/<n>`` names the generation that each bucket's base
comes from and the last batch that is folded into it. A batch is known by its number: run again, it writes the same folder
again, and once it is folded it is left out, so it counts once. Compaction rewrites the buckets that batches have touched and
no others; a manifest is published last, so a run that is lost on the way leaves the table as it was.

NULL keys match NULL keys. A batch's keys must be unique, and batches are numbered upward from 0.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_ABOUT = "schema string, keys array<string>, cols array<string>, buckets int"
#: What a row of a batch does: bring values; bring them and make the row active unless it was made inactive; take the row
#: away; make it inactive.
_UPSERT, _REVIVE, _DELETE, _DEACTIVATE = "U", "V", "D", "A"


@dataclass(frozen=True)
class DeltaLog:
    """``cols`` are those that a batch brings; other columns of ``schema`` keep what they had, NULL in new rows."""

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    cols: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def delta_schema(self) -> T.StructType:
        kept = [self.schema[c] for c in (*self.keys, *self.cols)]
        types = [T.StructField(f.name, f.dataType) for f in kept]
        return T.StructType([*types, T.StructField("__op", T.StringType()), T.StructField("__batch", T.LongType()), T.StructField("__bucket", T.IntegerType())])


def key_bucket(keys: list[str] | tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str, prefix: str = "") -> list[int]:
    """The numbered folders below a path that were written to their end."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return []
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    found = [s.getPath() for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith(prefix)]
    return sorted(int(p.getName().removeprefix(prefix)) for p in found if fs.exists(done(p, "_SUCCESS")))


def _manifest(spark: SparkSession, log: DeltaLog) -> tuple[int, dict[int, int], int]:
    """``(its number, generation of each bucket, last folded batch)`` of the newest manifest. A row for each bucket."""
    newest = _numbers(spark, f"{log.path}/manifest")[-1]
    rows = spark.read.schema("bucket int, gen long, folded long").parquet(f"{log.path}/manifest/{newest}").collect()
    return newest, {r["bucket"]: r["gen"] for r in rows}, max(r["folded"] for r in rows)


def _publish(spark: SparkSession, log: DeltaLog, number: int, gens: dict[int, int], folded: int) -> None:
    rows = [(b, g, folded) for b, g in sorted(gens.items())]
    spark.createDataFrame(rows, "bucket int, gen long, folded long").coalesce(1).write.mode("overwrite").parquet(f"{log.path}/manifest/{number}")


def _write_base(df: DataFrame, log: DeltaLog, gen: int) -> None:
    rows = df.withColumn("__bucket", key_bucket(log.keys, log.buckets)).repartition("__bucket")
    rows.write.mode("overwrite").partitionBy("__bucket").parquet(f"{log.path}/base/gen={gen}")


def create_log(df: DataFrame, path: str, keys: list[str], cols: list[str] | None = None, buckets: int = BUCKETS) -> DeltaLog:
    """Writes ``df`` as the base of a new log; ``cols``: all but the keys unless given."""
    given = tuple(cols) if cols is not None else tuple(c for c in df.columns if c not in keys)
    log = DeltaLog(path, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]), tuple(keys), given, buckets)
    spark = df.sparkSession
    about = [(log.schema.json(), list(log.keys), list(log.cols), log.buckets)]
    _write_base(df, log, 0)
    spark.createDataFrame(about, _ABOUT).coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    _publish(spark, log, 0, dict.fromkeys(range(buckets), 0), -1)
    return log


def open_log(spark: SparkSession, path: str) -> DeltaLog | None:
    """The log at a path; None where none was created to its end."""
    if not _numbers(spark, f"{path}/manifest"):
        return None
    r = spark.read.schema(_ABOUT).parquet(f"{path}/about").first()
    return DeltaLog(path, T.StructType.fromJson(json.loads(r["schema"])), tuple(r["keys"]), tuple(r["cols"]), r["buckets"])


def _base(spark: SparkSession, log: DeltaLog, gens: dict[int, int], buckets: list[int] | None = None) -> DataFrame:
    schema = T.StructType([*log.schema.fields, T.StructField("__bucket", T.IntegerType())])
    wanted = gens if buckets is None else {b: gens[b] for b in buckets}
    parts = []
    for gen in sorted(set(wanted.values())) or [0]:
        own = sorted(b for b, g in wanted.items() if g == gen)
        rows = spark.read.schema(schema).parquet(f"{log.path}/base/gen={gen}")
        parts.append(rows if len(own) == log.buckets else rows.where(F.col("__bucket").isin(own)))
    return reduce(DataFrame.unionByName, parts)


def _deltas(spark: SparkSession, log: DeltaLog, folded: int) -> DataFrame | None:
    """What batches have brought that is in no base yet; None where there is nothing."""
    done = [f"{log.path}/delta/__batch={b}" for b in _numbers(spark, f"{log.path}/delta", "__batch=") if b > folded]
    return None if not done else spark.read.schema(log.delta_schema).option("basePath", f"{log.path}/delta").parquet(*done)


def _merged(log: DeltaLog, base: DataFrame, deltas: DataFrame) -> DataFrame:
    """The rows of ``base`` with the newest version of each column, and new rows; ``__bucket`` included.

    Versions of a key are folded by partial aggregation. The base is joined with them once for its own rows; only its keys
    are read again, for the rows that are new.
    """
    upsert, delete = F.col("__op").isin(_UPSERT, _REVIVE), F.col("__op") == _DELETE
    at = lambda c: F.when(c, F.col("__batch"))
    marks = {"__u_at": upsert, "__d_at": delete, "__v_at": F.col("__op") == _REVIVE, "__a_at": F.col("__op") == _DEACTIVATE}
    newest = deltas.groupBy("__bucket", *log.keys).agg(
        F.max_by(F.struct(*log.cols) if log.cols else F.struct(F.lit(1).alias("__none")), at(upsert)).alias("__u"), *[F.max(at(c)).alias(n) for n, c in marks.items()]
    )
    newest = newest.select([F.col(c).alias(f"__n_{c}") for c in ("__bucket", *log.keys)] + ["__u", *marks])
    on = [F.col("__bucket") == F.col("__n___bucket")] + [F.col(k).eqNullSafe(F.col(f"__n_{k}")) for k in log.keys]
    joined = base.join(newest, on, "left").where(F.col("__d_at").isNull() | (F.col("__u_at") > F.col("__d_at")))
    again = F.col("__d_at").isNotNull()  # deleted, then brought anew
    since = F.coalesce("__d_at", F.lit(-1))

    def activity(old: Column) -> Column:
        return F.when(F.col("__a_at") > since, F.lit(False)).when(F.col("__v_at") > since, F.coalesce(old, F.lit(True))).otherwise(old)

    columns = []
    for c in log.schema.names:
        if c in log.keys:
            value = F.col(c)
        elif c in log.cols:
            value = F.when(F.col("__u_at").isNotNull(), F.col("__u")[c]).otherwise(F.col(c))
        else:
            old = F.when(~again, F.col(c))
            value = activity(old) if c == "active" else old
        columns.append(value.alias(c))
    kept = joined.select(*columns, "__bucket")
    fresh = newest.where("__u_at IS NOT NULL AND (__d_at IS NULL OR __u_at > __d_at)").join(base.select("__bucket", *log.keys), on, "left_anti")
    new = []
    for f in log.schema.fields:
        if f.name in log.keys:
            value = F.col(f"__n_{f.name}")
        elif f.name in log.cols:
            value = F.col("__u")[f.name]
        elif f.name == "active":
            value = activity(F.lit(None).cast("boolean"))
        else:
            value = F.lit(None)
        new.append(value.cast(f.dataType).alias(f.name))
    return kept.unionByName(fresh.select(*new, F.col("__n___bucket").alias("__bucket")))


def current(spark: SparkSession, log: DeltaLog) -> DataFrame:
    """The table as all batches have left it."""
    _, gens, folded = _manifest(spark, log)
    base, deltas = _base(spark, log, gens), _deltas(spark, log, folded)
    return (base if deltas is None else _merged(log, base, deltas)).select(*log.schema.names)


def append_batch(log: DeltaLog, source: DataFrame, batch: int, unmatched_target: str = "keep") -> bool:
    """Writes what a batch brings, and nothing else; False where the batch is folded already.

    ``source`` has keys and ``cols``. Rows that only the table has are kept, or written as deleted or deactivated, which
    compares keys alone (B3-B5 as a log).
    """
    if unmatched_target not in ("keep", "delete", "deactivate"):
        raise ValueError(f"unknown choice {unmatched_target!r}")
    spark = source.sparkSession
    _, gens, folded = _manifest(spark, log)
    if batch <= folded:
        return False
    wanted = [*log.keys, *log.cols]
    rows = source.select(*[F.col(c).cast(log.schema[c].dataType).alias(c) for c in wanted]).withColumn("__op", F.lit(_REVIVE if unmatched_target == "deactivate" else _UPSERT))
    if unmatched_target != "keep":
        earlier = _deltas(spark, log, folded)
        base = _base(spark, log, gens)
        if earlier is not None:  # without this batch itself, which may be run again
            base = _merged(log, base, earlier.where(F.col("__batch") < batch))
        named = source.select(*[F.col(k).alias(f"__k_{k}") for k in log.keys])
        gone = base.select(*log.keys).join(named, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in log.keys], "left_anti")
        op = _DELETE if unmatched_target == "delete" else _DEACTIVATE
        none = [F.lit(None).cast(log.schema[c].dataType).alias(c) for c in log.cols]
        rows = rows.unionByName(gone.select(*log.keys, *none, F.lit(op).alias("__op")))
    bucketed = rows.withColumn("__bucket", key_bucket(log.keys, log.buckets)).repartition("__bucket")
    bucketed.write.mode("overwrite").partitionBy("__bucket").parquet(f"{log.path}/delta/__batch={batch}")
    return True


def compact(spark: SparkSession, log: DeltaLog) -> list[int]:
    """Folds all batches into the base of the buckets that they touched; gives these buckets."""
    number, gens, folded = _manifest(spark, log)
    deltas = _deltas(spark, log, folded)
    if deltas is None:
        return []
    last = _numbers(spark, f"{log.path}/delta", "__batch=")[-1]
    touched = sorted(r["__bucket"] for r in deltas.select("__bucket").distinct().collect())
    if touched:
        merged = _merged(log, _base(spark, log, gens, touched), deltas).select(*log.schema.names)
        _write_base(merged, log, number + 1)
        gens = gens | dict.fromkeys(touched, number + 1)
    _publish(spark, log, number + 1, gens, last)
    return touched


def sweep(spark: SparkSession, log: DeltaLog) -> None:
    """Deletes batches that are folded and generations that no bucket uses; no reader may be at work on an older manifest."""
    _, gens, folded = _manifest(spark, log)
    old = [f"{log.path}/delta/__batch={b}" for b in _numbers(spark, f"{log.path}/delta", "__batch=") if b <= folded]
    old += [f"{log.path}/base/gen={g}" for g in _numbers(spark, f"{log.path}/base", "gen=") if g not in set(gens.values())]
    for path in old:
        fs, where = _file_system(spark, path)
        fs.delete(where, True)


def digests(df: DataFrame, keys: list[str], cols: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n, a, b``: an order-free digest of the rows of each key bucket, two sums of independent 64-bit hashes."""
    wanted = [*keys, *[c for c in cols if c not in keys]]
    sums = [F.sum(F.xxhash64(F.lit(seed), *wanted).cast("decimal(38,0)")).alias(name) for seed, name in ((1, "a"), (2, "b"))]
    return df.groupBy(key_bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("n"), *sums)


def write_fingerprinted(df: DataFrame, path: str, keys: list[str], cols: list[str], buckets: int = BUCKETS) -> None:
    """Writes a snapshot by key bucket, and the digests of its buckets beside it."""
    wanted = [*keys, *[c for c in cols if c not in keys]]
    rows = df.select(*wanted).withColumn("__bucket", key_bucket(keys, buckets)).repartition("__bucket")
    rows.write.mode("overwrite").partitionBy("__bucket").parquet(f"{path}/rows")
    spark = df.sparkSession
    digests(spark.read.schema(rows.schema).parquet(f"{path}/rows"), keys, cols, buckets).write.mode("overwrite").parquet(f"{path}/digests")


def changed_buckets(spark: SparkSession, new: str, old: str) -> list[int]:
    """The buckets of two fingerprinted snapshots that differ; only digests are read, a row for each bucket."""
    schema = "bucket int, n long, a decimal(38,0), b decimal(38,0)"
    x, y = (spark.read.schema(schema).parquet(f"{p}/digests") for p in (new, old))
    every = x.unionByName(y).groupBy("bucket", "n", "a", "b").count().where("count <> 2")
    return sorted(r["bucket"] for r in every.select("bucket").distinct().collect())


def fingerprint_delta(spark: SparkSession, new: str, old: str, schema: T.StructType | str, keys: list[str], cols: list[str]) -> DataFrame:
    """``compute_delta`` of two fingerprinted snapshots, which reads the rows of buckets with unequal digests only."""
    from shelfmark.operators.tables import compute_delta

    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = T.StructType([*fields.fields, T.StructField("__bucket", T.IntegerType())])
    differ = changed_buckets(spark, new, old)
    if not differ:
        wanted = [fields[c] for c in [*keys, *[c for c in cols if c not in keys]]]
        return spark.createDataFrame([], T.StructType([*wanted, T.StructField("__record_type", T.IntegerType(), False)]))
    x, y = (spark.read.schema(rows).parquet(f"{p}/rows").where(F.col("__bucket").isin(differ)) for p in (new, old))
    return compute_delta(x, y, keys, cols)
