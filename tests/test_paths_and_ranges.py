"""Load times in paths whose folders have digits of their own."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shelfmark.sources import databases, files
from shelfmark.streaming import landing


def test_digits_that_are_no_date_hide_none(spark):
    paths = ["in/stream-a99999999b/day=20240105/part-00000.csv", "x/12345678/2024-01-05/99999999.csv", "in/20240105/87654321-c000.csv"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(files.path_timestamp(F.col("p"))).collect()
    assert [r[0] for r in got] == [datetime(2024, 1, 5)] * 3


def test_stream_below_a_dated_folder(spark, tmp_path):
    root, out = tmp_path / "run-20230101-a99999999b", str(tmp_path / "out")
    for day in ("20240105", "20240106"):
        (root / f"day={day}").mkdir(parents=True)
        (root / f"day={day}" / "a.csv").write_text("k\n1\n")
    for i, path in enumerate((str(root), f"file://{root}")):
        stream = landing.stream_landing(spark, path, "k long")
        stream.writeStream.format("parquet").option("path", f"{out}{i}").option("checkpointLocation", str(tmp_path / f"check{i}")).trigger(availableNow=True).start().awaitTermination()
        got = sorted(r["audit"] for r in spark.read.parquet(f"{out}{i}").collect())
        assert got == [datetime(2024, 1, 5), datetime(2024, 1, 6)]


def test_many_chunks(spark):
    """More chunks than one aggregate has room for, of a skewed key with NULLs and repeated values."""
    n = 12_000
    key = F.when(F.col("id") % 50 != 0, F.when(F.col("id") < 300, 7).otherwise(F.col("id") * F.col("id"))).alias("k")
    df = spark.range(n).select(key).repartition(5)
    edges = databases.chunk_edges(df, "k", 10)
    predicates, counts = databases.chunk_predicates(df, "k", 10), databases.range_counts(df, "k", edges)
    assert predicates == databases.range_conditions("k", edges) and 1100 < len(predicates) <= 1200
    got = {r["chunk"]: r["n"] for r in counts.collect()}
    assert sum(got.values()) == n and max(x for c, x in got.items() if c) <= 10 and got[0] == 240 + 294
    for c in (0, 1, 600, len(predicates) - 1):
        assert df.where(predicates[c]).count() == got[c]
    assert databases.chunk_predicates(df.limit(0), "k", 10) == ["1 = 1"] and databases.chunk_edges(df.where("k IS NULL"), "k", 10) == []


def test_ranges_of_keys_beyond_longs(spark):
    wide = F.col("id").cast("decimal(12,0)")
    df = spark.range(1, 3001).select((wide * wide * wide * 10**12).cast("decimal(38,0)").alias("k"))
    low, high = df.agg(F.min("k"), F.max("k")).first()
    assert high > 1 << 63
    predicates = databases.histogram_predicates(lambda cs: list(df.agg(*[F.count_if(F.expr(c)) for c in cs]).first()), "k", low, high, 7)
    held = [df.where(p).count() for p in predicates]
    assert sum(held) == 3000 and max(held) <= 2 * 3000 / 7 and 1 < len(predicates) <= 7
    assert databases._literal(Decimal("1E+20"), "numeric") == "100000000000000000000"
