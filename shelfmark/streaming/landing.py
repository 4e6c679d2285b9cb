"""Landing files as a stream, validated and merged batch by batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators import deltalog, mapping, validate
from shelfmark.plans.specs import EntitySpec
from shelfmark.sources.files import with_audit_column


def stream_landing(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", audit: str = "audit", options: dict | None = None) -> DataFrame:
    """New files below ``path``, each once, with the load time of their path."""
    reader = spark.readStream.schema(schema).format(fmt).options(**({"header": "true", "pathGlobFilter": "*"} | (options or {})))
    return with_audit_column(reader.option("recursiveFileLookup", "true").load(path), audit, root=path)


def stream_validate_merge(stream: DataFrame, spec: EntitySpec, target: str, checkpoint: str, log_path: str | None = None, compact_every: int = 16) -> StreamingQuery:
    """Validates each micro-batch, quarantines bad rows and upserts the rest into a table.

    The table is a delta log (below the checkpoint unless given): a batch writes its own rows and no others, a batch that is
    run again after a loss writes the same folder again, so it counts once, and every ``compact_every`` batches the buckets
    that were touched are folded. A temporary view ``target`` shows the newest rows; ``deltalog.open_log`` and ``current``
    read the table from elsewhere. Rejected rows are kept by batch, ``<target>__anomaly<batch>``.
    """
    path, spark = log_path or f"{checkpoint}-table", stream.sparkSession

    def one(batch: DataFrame, batch_id: int) -> None:
        mapped = mapping.apply_mapping(batch, spec.mapping)
        flagged = validate.flag_duplicates(validate.flag_nulls(mapped, spec.required), spec.keys)
        flagged = flagged.persist()
        clean, anomaly = validate.quarantine(flagged, datetime(1970, 1, 1))
        clean = clean.select(*[m.generic for m in spec.mapping])
        log = deltalog.open_log(spark, path) or deltalog.create_log(spark.createDataFrame([], clean.schema), path, spec.keys)
        deltalog.append_batch(log, clean, batch_id)
        anomaly.write.mode("overwrite").saveAsTable(f"{target}__anomaly{batch_id}")
        flagged.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            deltalog.compact(spark, log)
        deltalog.current(spark, log).createOrReplaceTempView(target)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
