"""Small frames with NULLs, ties, empty inputs and the reference cases of each operator."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import SPECIAL_CHARS, decode_special_chars, encode_special_chars, normalise_names
from shelfmark.functions.types import map_type
from shelfmark.operators import aggregate, calendar, clustering, control, hierarchy, imputation, mapping, master, prep, rules, splits, tables, validate
from shelfmark.plans.specs import ColumnMapping, DerivedSpec, EmptyPull, Feature, QualityError, Rule, SchemaDrift
from shelfmark.sources import databases, files

NOW = datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_landing_dirs():
    dirs = files.expand_landing_dirs("s/", "yyMMdd", date(2023, 12, 30), date(2024, 1, 1))
    assert dirs == ["s/231231", "s/240101"]
    assert files.pick_dirs(["x/2024-01-02", "x/2024-01-10", "x/2024-01-03"], "full") == ["x/2024-01-10"]
    with pytest.raises(ValueError):
        files.pick_dirs(["x/2024-01-02"], "other")


def test_delimited_and_zip(spark, tmp_path):
    import gzip
    import zipfile

    text = '"a"|"b"|"c"\n"1"|"x "in" y"|"2"\n"3"|"4"\n"5"|"6"|"7"|"8"\n\n'
    with gzip.open(tmp_path / "f.txt.gz", "wt") as f:
        f.write(text)
    got = files.read_delimited(spark, str(tmp_path / "f.txt.gz"), "|", mode="strip_quotes")
    assert got.columns == ["a", "b", "c"]
    assert sorted(tuple(r) for r in got.fillna("-").collect()) == [("1", 'x "in" y', "2"), ("3", "4", "-"), ("5", "6", "7")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("one.csv", "a,b\n1,2\n3,\n")
        z.writestr("two.dat", "a,b\n5,6\n")
        z.writestr("other.pdf", "no")
    got = files.read_zipped_delimited(spark, str(tmp_path / "z.zip")).select("a", "b").fillna("-")
    assert rows(got) == [("1", "2"), ("3", "-"), ("5", "6")]


def test_path_dates(spark):
    paths = ["a/20240102030405/x", "a/202401020304.csv", "a/20240102/x", "a/2024-01-02/x", "a/99999999/2024-01-03", "a/none"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select(files.path_timestamp(F.col("p"))).collect()
    assert [r[0] for r in got] == [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4), datetime(2024, 1, 2), datetime(2024, 1, 2), datetime(2024, 1, 3), None]


def test_special_chars(spark):
    text = "".join(SPECIAL_CHARS)
    assert len(SPECIAL_CHARS) == 29
    df = spark.createDataFrame([(text, 1), (None, 2)], "s string, n int")
    coded = encode_special_chars(df)
    value = coded.first()["s"]
    assert not set(value) & set(SPECIAL_CHARS) and len(value) == 12 * 29
    assert decode_special_chars(coded).first()["s"] == text
    assert normalise_names(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"), "_").columns == ["a_b", "a_b_1"]


def test_types():
    assert map_type("INT4[]") == T.ArrayType(T.LongType())
    assert map_type("numeric(10,2)") == T.DecimalType(10, 2)
    assert map_type("money", "mssql") == T.DecimalType(38, 18)
    assert map_type("timestamp without time zone", "postgresql") == T.TimestampNTZType()
    assert map_type("x", overrides={"x": T.DateType()}) == T.DateType()
    with pytest.raises(ValueError):
        map_type("nosuch")


def test_jdbc_and_predicates(spark, tmp_path):
    assert databases.range_predicates("k", 0, 10, 2) == ["((k >= 0 AND k < 5) OR k IS NULL)", "(k >= 5 AND k <= 10)"]
    assert databases.range_predicates("k", None, None, 3) == ["1 = 1"]
    counts = spark.createDataFrame([("a", 5), ("b", 3), (None, 1), ("c'", 9)], "k string, n long")
    assert databases.pack_key_predicates(counts, "k", 6, 20) == ["k IN ('b') OR k IS NULL", "k IN ('a')", "k IN ('c''')"]
    url, props = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "k int, v string")
    tables.write_jdbc(df, url, "t", "overwrite", props=props, column_types="v VARCHAR(20)")
    got = databases.read_jdbc(spark, url, "t", predicates=databases.range_predicates('"k"', 0, 9, 3), props=props)
    assert got.count() == 10 and got.rdd.getNumPartitions() == 3
    both = databases.read_jdbc(spark, url, queries="select * from t where \"k\" < 3; select * from t where \"k\" > 7;", props=props)
    assert both.count() == 5


def test_unload(spark):
    df = spark.createDataFrame([("x", 1, 2.5), (None, 2, None)], "s string, n int, f float")
    out = databases.normalise_unload(df)
    assert dict(out.dtypes) == {"s": "string", "n": "bigint", "f": "double"} and out.collect()[1]["s"] == "IA_NULL"
    back = databases.decode_unload(out.select("s", F.col("n").cast("string").alias("n")), {"n": "long"})
    assert rows(back.fillna("-")) == [("-", 2), ("x", 1)]
    with pytest.raises(ValueError):
        databases.decode_unload(out, {"s": "blob"})
    with pytest.raises(EmptyPull):
        databases.require_rows(df.limit(0), "v", True)
    assert databases.require_rows(df.limit(0), "v", False) is None
    with pytest.raises(ValueError):
        databases.incremental_filter(df, None, None)


def test_tables(spark):
    df = spark.createDataFrame([(1, "a", date(2024, 1, 1)), (2, "b", date(2024, 1, 2))], "k int, v string, d date")
    with pytest.raises(ValueError):
        tables.write_table(df, "nosuch_t", "APPEND", "never")
    tables.write_table(df, "w_t", "TRUNCATE")
    tables.write_table(df.select("v", "k", "d"), "w_t", "APPEND")
    assert spark.table("w_t").count() == 4
    tables.write_partitioned(df, "p_t", "d", ("k",))
    assert spark.table("p_t").where("d = DATE '2024-01-02'").count() == 1
    for bad in (lambda: tables.write_partitioned(df, "x", ["d", "k"]), lambda: tables.write_partitioned(df, "x", "v"), lambda: tables.write_partitioned(df, "x", "d", tuple("abcde"))):
        with pytest.raises(ValueError):
            bad()
    assert tables.backup_table(spark, "w_t", date(2024, 1, 5)) == "w_t__2024_01_05"
    tables.publish_passthrough(spark, "w_t", "w_copy")
    seen = []
    tables.copy_tables(spark, "w_t:one, w_copy:two", lambda d, n: seen.append((n, d.count())))
    assert seen == [("one", 4), ("two", 4)]
    with pytest.raises(SchemaDrift, match="z"):
        tables.check_schema_drift(["a", "z"], ["a"])
    assert tables.append_summary(df, [{"k": 3}]).where("v IS NULL").count() == 1


def test_merge_nulls_and_empty(spark):
    t = spark.createDataFrame([(1, "a", True), (2, None, True), (None, "n", True)], "k int, v string, active boolean")
    s = spark.createDataFrame([(2, "b"), (None, "m"), (9, None)], "k int, v string")
    got = {r["k"]: (r["v"], r["active"]) for r in tables.merge_upsert(t, s, ["k"], ["v"], "deactivate").collect()}
    assert got == {1: ("a", False), 2: ("b", True), None: ("m", True), 9: (None, True)}
    assert tables.merge_upsert(t, s.limit(0), ["k"], ["v"]).count() == 3
    assert tables.merge_upsert(t, s.limit(0), ["k"], ["v"], "delete").count() == 0
    once = tables.merge_upsert(t, s, ["k"], ["v"])
    assert sorted(map(str, tables.merge_upsert(once, s, ["k"], ["v"]).collect())) == sorted(map(str, once.collect()))


def test_delta_keys(spark):
    old = spark.createDataFrame([("a", "bc", [1]), ("ab", "c", [2])], "x string, y string, v array<int>")
    new = spark.createDataFrame([("a", "bc", [1, 3])], "x string, y string, v array<int>")
    assert sorted((r["x"], r["y"], r["__record_type"]) for r in tables.compute_delta(new, old, ["x", "y"], ["v"]).collect()) == [("a", "bc", 1), ("ab", "c", 0)]


def test_mapping(spark):
    raw = spark.createDataFrame([("1", "x", "7", "p")], "a string, b string, c string, d string")
    got = mapping.apply_mapping(raw, [ColumnMapping("n", "int", formula="a + 1"), ColumnMapping("m", "int", "b"), ColumnMapping("z", "date")])
    assert got.columns == ["n", "m", "z", "c", "d"] and tuple(got.first()) == (2, None, None, "7", "p")


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (None, "d"), (None, "e")], "k int, v string")
    flagged = validate.flag_duplicates(validate.flag_nulls(df, ["k"]), ["k"])
    clean, bad = validate.quarantine(flagged, NOW)
    assert rows(clean) == [(1, "a")] and clean.count() + bad.count() == df.count()
    assert sorted(r["QC"] for r in bad.collect()) == ["null_check", "null_check", "primary_key_check", "primary_key_check"]
    assert not validate.data_loss(validate.validation_summary(flagged.limit(0), "e", NOW), clean.limit(0), 5)
    with pytest.raises(QualityError):
        validate.generic_qc(df, ["k"], ["v"])
    validate.generic_qc(df, ["v"], ["v"])
    assert validate.null_profile(df, ["k", "v"]).first()[0] == "k - 2"


def test_rules(spark):
    assert rules.expand_kpis("KPI_1 + KPI_10", {"KPI_1": "a", "KPI_10": "b"}) == "(a) + (b)"
    assert rules.threshold_met(0.06, ">5%") and not rules.threshold_met(0.04, ">5%") and not rules.threshold_met(1.0, ">5")
    df = spark.createDataFrame([(i, i * 1.0) for i in range(10)], "k int, v double")
    out = rules.run_rules({"t": df}, "t", [Rule("p", "v > 8", "PAUSE", "other"), Rule("d", "v < 2", "DELETE", "other")], {}, now=NOW)
    assert out.paused and out.clean.count() == 8 and out.anomaly.count() == 3
    assert rules.run_rules({"t": df.limit(0)}, "t", [], {}, now=NOW).summary.first()["rule"] == "data_check"
    df.createOrReplaceTempView("rule_t")
    assert rules.run_custom_check(spark, "SELECT 'Pass'", "x")[1] == "Pass"
    assert rules.run_custom_check(spark, "SELECT k, 'x' AS action FROM rule_t WHERE k = 1", "x")[1] == "Fail"


def test_control(spark):
    c = spark.createDataFrame([("v", NOW)], "view string, extraction_sync_dt timestamp")
    data = spark.createDataFrame([(datetime(2024, 2, 1),)], "t timestamp")
    assert control.advance_watermark(c, data, "v", "t", 5, 5, "incremental").first()[1] == NOW
    assert control.advance_watermark(c, data, "v", "t", 5, 5, "full").first()[1] == datetime(2024, 2, 1)


def test_calendar(spark):
    c = calendar.fiscal_calendar(spark, date(2020, 2, 1), "2019-12-01", "2022-03-01")
    got = {r["date"]: r for r in c.collect()}
    assert got[date(2021, 2, 1)]["fiscal_day"] == 1 and got[date(2021, 2, 1)]["fiscal_month"] == 1 and got[date(2021, 2, 1)]["fiscal_year_week"] == 202101
    assert all(len({r["fiscal_month"] for r in got.values() if (r["fiscal_year_week"]) == w}) == 1 for w in {r["fiscal_year_week"] for r in got.values()})
    assert calendar.is_due(c, date(2021, 2, 1), "fiscal_day = 1") and not calendar.is_due(c, date(1999, 1, 1), "true")
    assert hierarchy.levels_up_to(["l0_name", "x", "l10_name", "l2_name"], "l2_name") == ["l0_name", "l2_name"]


def test_master(spark):
    i = spark.createDataFrame([(date(2024, 1, 1), "a", 5.0), (date(2024, 1, 1), "b", -3.0), (date(2024, 1, 1), "d", 1.0)], "date date, product_code string, oh double")
    t = spark.createDataFrame([(date(2024, 1, 1), "a", 9.0), (date(2024, 1, 1), "c", 2.0)], "date date, product_code string, q double")
    got = master.build_master(i, t, {}, {"inventory": [Feature("inventory", "sum(oh)")], "transactions": [Feature("qty", "sum(q)")]}, ["date", "product_code"])
    assert {r["product_code"]: (r["qty"], r["inventory"]) for r in got.collect()} == {"a": (9.0, 9.0), "b": (0.0, 0.0), "c": (2.0, 2.0), "d": (0.0, 1.0)}


def test_own_queries_replace_steps(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), (None, 2, None)], "g string, fiscal_year_week int, v double")
    f = [Feature("total", "sum(v)")]
    by = ["g", "fiscal_year_week"]
    got = aggregate.aggregate_features(df, by, f, override="SELECT g, fiscal_year_week, 2 * sum(v) AS total FROM {rows} GROUP BY 1, 2")
    assert sorted(map(repr, map(tuple, got.collect()))) == ["('a', 1, 4.0)", "('a', 2, 6.0)", "(None, 2, None)"]
    assert rows(aggregate.aggregate_features(df.where("v > 2"), by, f, override=lambda rows: rows.withColumnRenamed("v", "total"))) == [("a", 2, 3.0)]
    with pytest.raises(SchemaDrift, match="total"):
        aggregate.aggregate_features(df, by, f, override="SELECT g, fiscal_year_week FROM {rows}")
    m = spark.createDataFrame([("p", 1.0, 0.0)], "product_code string, qty double, inventory double")
    own = "SELECT m.*, qty + size AS qty_imputed, size AS lost_sales FROM {master} m JOIN {products} USING (product_code)"
    products = spark.createDataFrame([("p", 2.0)], "product_code string, size double")
    args = (m, m, m, products, ["channel"], [], {}, [])
    assert [(r["qty_imputed"], r["lost_sales"]) for r in imputation.impute_lost_sales(*args, override=own).collect()] == [(3.0, 2.0)]
    with pytest.raises(SchemaDrift, match="lost_sales"):
        imputation.impute_lost_sales(*args, override="SELECT *, 1 AS qty_imputed FROM {master}")


def test_published_features(spark):
    of = lambda *rows: spark.createDataFrame(list(rows), "fiscal_year_week int, total double")
    spark.sql("DROP TABLE IF EXISTS weekly_features")
    publish = aggregate.publish_features
    assert rows(publish(of((1, 1.0), (2, 2.0), (3, 3.0)), "weekly_features")) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    # a periodic run replaces the weeks from its first one on, twice as once
    for _ in range(2):
        assert rows(publish(of((2, 5.0)), "weekly_features")) == [(1, 1.0), (2, 5.0)]
    assert rows(publish(of(), "weekly_features")) == [(1, 1.0), (2, 5.0)]
    assert rows(publish(of((3, 9.0)), "weekly_features", from_week=2)) == [(1, 1.0), (3, 9.0)]
    with pytest.raises(SchemaDrift):
        publish(of((4, 1.0)).withColumn("more", F.lit(1)), "weekly_features")
    assert rows(publish(of((7, 7.0)), "weekly_features", historic=True)) == [(7, 7.0)]
    spark.sql("DROP TABLE weekly_features")


def test_parquet_with_old_times_and_fixed_decimals(spark, tmp_path):
    """INT96 times and decimals of fixed length, as other writers make them."""
    from decimal import Decimal

    import pyarrow as pa
    import pyarrow.parquet as pq

    values = {"t": pa.array([datetime(2024, 1, 1, 12), None], pa.timestamp("us")), "d": pa.array([Decimal("12345678901234567890.12"), None], pa.decimal128(25, 2)), "s": pa.array(["x", None])}
    pq.write_table(pa.table(values), tmp_path / "f.parquet", use_deprecated_int96_timestamps=True)
    meta = pq.read_schema(tmp_path / "f.parquet"), pq.ParquetFile(tmp_path / "f.parquet").schema
    assert "INT96" in str(meta[1]) or meta[1].column(0).physical_type == "INT96"
    assert meta[1].column(1).physical_type == "FIXED_LEN_BYTE_ARRAY"
    got = spark.read.parquet(str(tmp_path / "f.parquet"))
    assert isinstance(got.schema["t"].dataType, T.TimestampType) and got.schema["d"].dataType == T.DecimalType(25, 2)
    assert sorted(map(repr, (tuple(r) for r in got.select(F.date_format("t", "yyyy-MM-dd HH:mm").alias("t"), "d", "s").collect()))) == [
        "('2024-01-01 12:00', Decimal('12345678901234567890.12'), 'x')", "(None, None, None)",
    ]


def test_fill_prices(spark):
    df = spark.createDataFrame([("p", "s", "c", date(2024, 1, d), v) for d, v in ((1, None), (2, 5.0), (3, None))] + [("q", "s", "c", date(2024, 1, 1), None)], "product_code string, store_code string, channel string, date date, price_imputed double")
    products = spark.createDataFrame([("p", None), ("q", 7.0)], "product_code string, list double")
    got = {(r["product_code"], r["date"].day): r["price_imputed"] for r in imputation.fill_prices(df, products, {"price": "list"}, ["channel"]).collect()}
    assert got == {("p", 1): 5.0, ("p", 2): 5.0, ("p", 3): 5.0, ("q", 1): 7.0}


def test_splits_sum_to_one(spark):
    from shelfmark.plans import views
    from tests.conftest import SF

    products = views.product_master(spark, SF)
    h = hierarchy.flatten_hierarchies(products, ["l0_name", "l1_name", "l2_name"])
    s = splits.store_split(
        views.store_master(spark, SF), products, views.product_store_mapping(spark, SF), views.transaction_master(spark, SF), views.store_clustering(spark, SF), h,
        "product_code",
    )
    sums = s.groupBy("hierarchy_code", "channel").agg(F.sum("store_split").alias("t")).where(F.abs(F.col("t") - 1) > 1e-6)
    assert sums.count() == 0 and s.count() > 0


def test_buckets(spark):
    for n, buckets in ((1, 1), (200, 1), (201, 2)):
        df = spark.range(n).select(F.format_string("%04d", "id").alias("product_code"), F.lit("x").alias("l0_name"))
        sizes = [r["count"] for r in aggregate.bucket_products(df, ["l0_name"]).groupBy("mp_bucket_code").count().collect()]
        assert len(sizes) == buckets and max(sizes) <= 200 and sum(sizes) == n
    assert aggregate.bucket_products(df.limit(0), ["l0_name"]).count() == 0
    specs = [DerivedSpec("dd_a", 1, "SELECT 1 AS x"), DerivedSpec("dd_b", 2, "SELECT x + 1 AS x FROM dd_a")]
    assert aggregate.run_derived(spark, specs, True)["dd_b"].first()[0] == 2


def test_prep(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), ("a", None, 3.0), ("b", None, 3.0), (None, 4.0, 3.0)], "g string, v double, k double")
    assert [r["v"] for r in prep.impute(df, {"v": "mean"}).orderBy("v").collect()] == [1.0, 2.5, 2.5, 4.0]
    assert sorted(r["v"] for r in prep.impute(df, {"v": ("mean", "g")}).collect()) == [0.0, 1.0, 1.0, 4.0]
    assert prep.drop_constant(df).columns == ["g", "v"] and prep.drop_constant(df, ("k",)).columns == ["g", "v", "k"]
    scaled = prep.transform(df, {"k": "minmax"}).select("k").distinct().collect()
    assert scaled == [(0.0,)]
    assert prep.transform(spark.createDataFrame([(-1.0,)], "x double"), {"x": "log"}).first()[0] is None
    assert prep.encode(df, {"g": "onehot"}).columns == ["v", "k", "g_a", "g_b"]


def test_clustering(spark):
    points = [(float(10 * c + i % 3), float(10 * c + i % 2), c) for c in range(3) for i in range(8)]
    df = clustering.vectors(spark.createDataFrame(points, "x double, y double, planted int"), ["x", "y"])
    grid = clustering.kmeans_grid(df, [2, 3, 4])
    scores = {str(k): clustering.score_clusters(d).first().asDict() for k, d in grid.items()}
    assert clustering.rank_candidates(scores) == "3"
    assert grid[3].groupBy("planted").agg(F.countDistinct("labels").alias("n")).where("n > 1").count() == 0
    named = {("km", k): d for k, d in grid.items()}
    by = {("km", k): scores[str(k)] for k in grid}
    assert list(clustering.select_outputs(named, by, "overall")) == ["3"] and len(clustering.select_outputs(named, by, "per_k")) == 3
    assert [clustering.letter(i) for i in (0, 25, 26, 701)] == ["A", "Z", "AA", "ZZ"]
    few = spark.createDataFrame([("c", str(i), 1.0) for i in range(11)], "channel string, store_code string, q double")
    assert {r["labels"] for r in clustering.store_clusters(few, ["channel"], [Feature("q", "sum(q)")], [2, 3]).collect()} == {0}
