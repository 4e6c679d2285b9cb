"""Small helpers that the text operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null: empty), so that other columns cannot clash."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset a temporary one, in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shelfmark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on beside later stages, which need it."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """``run`` (for ``mapInArrow``) that frees what the worker's task before left behind, and its own memory at its end.

    Functions that travel by value hold their module's names in a cycle, so that only a collection frees their tables.
    """

    def tidied(batches):
        import gc

        gc.collect()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied


#: Rows with one key beyond which that key is joined by broadcast, and keys up to which this is done.
HOT_ROWS, HOT_KEYS = 50_000, 10_000


def joined_hot(big: DataFrame, small: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Join (``inner`` or ``left``) with ``small``, unique by ``key``, whose ``n`` is the number of rows of ``big`` with the key.

    The keys of more than ``HOT_ROWS`` rows are few; they are broadcast, so that no task gets all rows of one.
    """
    hot = small.where(F.col("n") > HOT_ROWS)
    found = hot.limit(HOT_KEYS + 1).count()
    if not 0 < found <= HOT_KEYS:
        return big.join(small, key, how)
    rest = small.where(F.col("n") <= HOT_ROWS)
    return big.join(F.broadcast(hot), key).unionByName(big.join(F.broadcast(hot.select(*([key] if isinstance(key, str) else key))), key, "left_anti").join(rest, key, how))


#: Ids up to which a list of documents to drop is broadcast (some 200 MB); beyond, the join shuffles.
SMALL_IDS = 1_000_000


def unused(name: str) -> str:
    """A column name that no table has."""
    return f"__{name}_{uuid.uuid4().hex}"


def text_key(text_col: str = "text"):
    """A hash of a row's text (null: empty); with its id it tells which row is meant."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, without the rows whose id and text are those of ``gone(doc_id, key)``.

    Null ids are compared too; rows that share id and text share the decision.
    """
    gone_id, gone_key = unused("gone_id"), unused("gone_key")
    ids = written(gone.select(F.col("doc_id").alias(gone_id), F.col("key").alias(gone_key)).distinct(), "gone")
    side = F.broadcast(ids) if ids.count() <= SMALL_IDS else ids
    same = F.col(id_col).cast("long").eqNullSafe(F.col(gone_id)) & (text_key(text_col) == F.col(gone_key))
    return docs.join(side, same, "left_anti")
