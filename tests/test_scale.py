"""What the operators promise at scale: hot keys, plans that stay small, batches that write little. Each against a plain form."""

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmark.functions.scratch import scratch_path
from shelfmark.operators import deltalog, imputation, rules, splits, tables, validate
from shelfmark.plans import analytics, loading
from shelfmark.plans.specs import Rule
from shelfmark.sources import databases
from tests.oracle import oracle, rows_of

NOW = datetime(2024, 1, 1)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_store_split_reads_its_tables_a_few_times(spark):
    plan = analytics.e22(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") < 20


def sales(spark, n=9000, stores=300):
    """Half of all rows are one product's; a cluster has more stores than a word has bits."""
    rng = random.Random(8)
    rows = {}
    for _ in range(n):
        product = "hot" if rng.random() < 0.5 else rng.choice("abcd")
        day, store = date(2024, 1, 1) + timedelta(days=rng.randrange(14)), f"s{rng.randrange(stores):03d}"
        price = rng.choice([None, None, round(rng.uniform(1, 9), 2)])
        rows[product, day, store] = (rng.choice(["x", "y", None]), product, store, day, 202401 + (day.day - 1) // 7, rng.choice(["c1", "c1", "c2", None]), rng.choice([0.0, 1.0, 5.0]), rng.choice([0.0, 2.0]), price)
    return spark.createDataFrame(list(rows.values()), "channel string, product_code string, store_code string, date date, fiscal_year_week int, cluster_name string, qty double, inventory double, price double").repartition(5)


def test_hot_product_is_filled_as_by_a_window(spark):
    df = sales(spark).withColumn("price_imputed", F.col("price"))
    products = spark.createDataFrame([("a", 4.5), ("b", None)], "product_code string, list double")
    got = imputation.fill_prices(df, products, {"price": "list"}, ["channel"])
    value = F.coalesce("price", F.when(F.col("product_code") == "a", 4.5))
    w = Window.partitionBy("product_code", "channel").orderBy("date", "store_code")
    before, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    want = df.withColumn("price_imputed", F.coalesce(value, F.last(value, True).over(before), F.first(value, True).over(after)))
    assert plain(got.select(want.columns)) == plain(want)


def test_signals_and_estimates_as_by_windows(spark):
    df = sales(spark).withColumn("total_stores_cluster", F.lit(100))
    got = imputation.first_estimates(df, ["channel"], ["price"], ["inventory"])
    week = ["channel", "cluster_name", "product_code", "fiscal_year_week"]
    weekly = df.groupBy(*week).agg(F.count_distinct(F.when(F.col("qty") != 0, F.col("store_code"))).alias("a"), F.sum("qty").alias("q"))
    found = got.select(*week, F.col("active_stores").alias("a"), F.col("weekly_qty").alias("q")).distinct()
    assert plain(found) == plain(weekly)
    assert weekly.agg(F.max("a")).first()[0] > 64  # more than a word
    sold = F.when(F.col("qty") != 0, F.col("price"))
    over = [Window.partitionBy(*week, "date"), Window.partitionBy(*week), Window.partitionBy("channel", "product_code", "fiscal_year_week")]
    want = df.withColumn("e", F.round(F.coalesce(*[F.avg(sold).over(w) for w in over]), 6))
    keys = ["product_code", "date", "store_code"]
    assert plain(got.select(*keys, F.round("price_first_imputed", 6))) == plain(want.select(*keys, "e"))
    quantity = df.withColumn("e", F.avg(F.when(F.col("inventory") > 0, F.col("qty"))).over(over[0]))
    assert plain(got.select(*keys, F.round("qty_first_imputed", 6))) == plain(quantity.select(*keys, F.round("e", 6)))
    alone = imputation.impute_price_means(df, ["channel"], "qty", ["price"]).select(*keys, F.round("price_first_imputed", 6))
    assert plain(alone) == plain(want.select(*keys, "e"))


def test_estimates_exchange_rows_once(spark):
    cutoffs = spark.createDataFrame([("x", 0.1, 0.1)], "channel string, active_stores_cutoff double, sell_through_cutoff double")
    df = sales(spark, 200).withColumn("total_stores_cluster", F.lit(100))
    got = imputation.impute_quantity(imputation.first_estimates(df, ["channel"], ["price"], []), ["channel"], "qty", "inventory", cutoffs)
    assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1


def test_discounts_of_missing_keys_and_upper_levels(spark):
    """A product's mean first, then its level's; a row whose key is NULL has no mean at that level."""
    rows = [("p", "g", 1, 4.0, 1.0), ("p", "g", 1, None, 1.0), ("q", "g", 1, None, 3.0), (None, "g", 1, None, 1.0), (None, None, 1, None, 1.0), ("r", "h", 2, None, 1.0)]
    df = spark.createDataFrame([(p, g, "s", "c", date(2024, 1, d), 202401, v, i) for p, g, d, v, i in rows], "product_code string, l0_name string, store_code string, channel string, date date, fiscal_year_week int, discount_imputed double, inventory double")
    got = imputation.impute_discounts(df, ["product_code", "l0_name"], ["channel"], ["discount"], "inventory")
    assert plain(got.select("product_code", "l0_name", "discount_imputed")) == plain(spark.createDataFrame(
        [("p", "g", 4.0), ("p", "g", 2.0), ("q", "g", 4 / 6), (None, "g", 4 / 6), (None, None, None), ("r", "h", None)], "a string, b string, c double"))


def test_prefixes_exchange_rows_once(spark):
    rows = [("c", "s1", "k", "a", "b", "p", 2.0), ("c", "s1", "k", "a", "d", "q", 0.0), ("c", "s2", "k", "a", "b", "p", 0.0), ("c", "s2", None, "a", "b", "q", 4.0), ("c", "s3", None, "a", "b", "p", 0.0)]
    base = spark.createDataFrame(rows, "channel string, store_code string, cluster_name string, l0_name string, l1_name string, product_code string, sales_art_store double")
    got = splits.prefix_sales(base, ["l0_name", "l1_name"])
    assert got._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") == 1
    assert plain(got.select("store_code", "product_code", "r_h1_store", "r_h2_store")) == plain(spark.createDataFrame(
        [("s1", "p", 2.0, 2.0), ("s1", "q", 2.0, 0.0), ("s2", "p", 4.0, 4.0), ("s2", "q", 4.0, 4.0), ("s3", "p", 0.0, 0.0)], "a string, b string, c double, d double"))
    # a NULL cluster is one, and its mean fills its stores
    filled = splits.fill_zero_sales(base, ["l0_name", "l1_name"]).where("store_code IN ('s2', 's3')")
    assert plain(filled.select("store_code", "product_code", "sales_art_store", "r_h1_store", "r_h1", "sales_art")) == plain(spark.createDataFrame(
        [("s2", "p", 2.0, 4.0, 10.0, 4.0), ("s2", "q", 4.0, 4.0, 6.0, 4.0), ("s3", "p", None, 4.0, 10.0, 4.0)], "a string, b string, c double, d double, e double, f double"))


def test_first_rows_of_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(1 if rng.random() < 0.5 else rng.choice([2, 3, None, rng.randrange(50)]), rng.choice(["a", "b", None]), rng.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, s string, n int").repartition(4)
    got = validate.flag_duplicates(df, ["k"])
    want = df.withColumn("primary_key_check", F.row_number().over(Window.partitionBy("k").orderBy("k", "s", "n")) > 1)
    assert got.columns == want.columns and plain(got) == plain(want)
    last = validate.flag_duplicates(df, ["k"], ["n"]).where("NOT primary_key_check").groupBy("k").agg(F.count("*").alias("c"), F.min("n").alias("n"))
    assert plain(last) == plain(df.groupBy("k").agg(F.lit(1).cast("long").alias("c"), F.min("n").alias("n")))


BASE = "k int, v string, w double, other string, active boolean"


@pytest.mark.parametrize("seed", range(3))
def test_log_is_what_upserts_make(spark, seed):
    """Batches of all kinds, run twice and folded at times, against one snapshot after the other."""
    rng = random.Random(seed)
    rows = [(k if k else None, f"v{k}", float(k), "o", rng.choice([True, False, None])) for k in range(12)]
    snapshot = spark.createDataFrame(rows, BASE)
    log = deltalog.create_log(snapshot, scratch_path(spark, "log"), ["k"], ["v", "w"], buckets=4)
    for batch in range(4):
        keys = rng.sample([None, *range(1, 20)], rng.randrange(0, 9))
        source = spark.createDataFrame([(k, f"b{batch}", rng.choice([None, 1.5])) for k in keys], "k int, v string, w double")
        how = rng.choice(["keep", "keep", "delete", "deactivate"])
        for _ in range(rng.choice([1, 2])):
            assert deltalog.append_batch(log, source, batch, how)
        snapshot = spark.createDataFrame(tables.merge_upsert(snapshot, source, ["k"], ["v", "w"], how).collect(), BASE)
        assert plain(deltalog.current(spark, log)) == plain(snapshot)
        if rng.random() < 0.4:
            deltalog.compact(spark, log)
            deltalog.sweep(spark, log)
            assert not deltalog.append_batch(log, source, batch)
            assert plain(deltalog.current(spark, log)) == plain(snapshot)
    assert deltalog.open_log(spark, log.path) == log


def size_of(path):
    return sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("*.parquet"))


def test_a_small_batch_writes_little(spark, tmp_path):
    rows = spark.range(20000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    log = deltalog.create_log(rows, str(tmp_path / "log"), ["k"], buckets=256)
    few = rows.where("k % 100 = 7").withColumn("v", F.lit("new"))
    deltalog.append_batch(log, few, 0)
    assert size_of(f"{log.path}/delta") < size_of(f"{log.path}/base") / 10
    one = rows.where("k = 7").withColumn("v", F.lit("newer"))
    deltalog.append_batch(log, one, 1)
    deltalog.compact(spark, log)
    deltalog.append_batch(log, one, 2)
    assert len(deltalog.compact(spark, log)) == 1  # the bucket that was touched
    assert deltalog.current(spark, log).where("v = 'new'").count() == 199 and deltalog.current(spark, log).count() == 20000


def test_equal_snapshots_compare_digests_alone(spark, tmp_path):
    rows = spark.range(500).selectExpr("id AS k", "if(id % 7 = 0, NULL, concat('v', id)) AS v")
    paths = [str(tmp_path / n) for n in "abc"]
    for path, df in zip(paths, (rows, rows.repartition(7), rows.where("k <> 3").withColumn("v", F.expr("if(k = 5, 'x', v)"))), strict=True):
        deltalog.write_fingerprinted(df, path, ["k"], ["v"], 32)
    same = deltalog.fingerprint_delta(spark, paths[1], paths[0], rows.schema, ["k"], ["v"])
    assert same.count() == 0 and not same.inputFiles()
    assert same.columns == ["k", "v", "__record_type"]
    differ = deltalog.changed_buckets(spark, paths[2], paths[0])
    assert 0 < len(differ) <= 2
    delta = deltalog.fingerprint_delta(spark, paths[2], paths[0], rows.schema, ["k"], ["v"])
    assert plain(delta) == [(3, "v3", 0), (5, "x", 1)] and delta.dtypes == same.dtypes


def one_by_one(rows, chosen):
    """Rules in plain Python, each on what the ones before it left."""
    summary, bad = [], []
    for r in chosen:
        hits = [x["v"] is not None and eval(r.outer, {}, x) for x in rows]
        share = sum(hits) / len(rows) if rows else 0.0
        acts = rules.threshold_met(share, r.threshold)
        action = r.action if acts else "REPORT"
        summary.append((r.name, action, len(rows), sum(hits)))
        bad += [(x["k"], x["v"], r.name, action) for x, h in zip(rows, hits, strict=True) if h]
        if action == "DELETE":
            rows = [x for x, h in zip(rows, hits, strict=True) if not h]
        elif action == "REPLACE":
            rows = [{**x, "v": int(r.value)} if h else x for x, h in zip(rows, hits, strict=True)]
    return rows, summary, bad


@pytest.mark.parametrize("seed", range(4))
def test_fused_rules_are_what_single_ones_make(spark, seed):
    rng = random.Random(seed)
    rows = [{"k": k, "v": rng.choice([None, *range(30)])} for k in range(120)]
    chosen = []
    for i in range(7):
        action = rng.choice(["DELETE", "DELETE", "REPORT", "REPLACE", "PAUSE"])
        threshold = rng.choice([None, None, ">10%", ">1%"])
        chosen.append(Rule(f"r{i}", f"v > {rng.randrange(30)} and v < {rng.randrange(5, 35)}", action, "cleaning", threshold=threshold, column="v", value=str(rng.randrange(30))))
    df = spark.createDataFrame([(x["k"], x["v"]) for x in rows], "k int, v int").repartition(3)
    out = rules.run_rules({"t": df}, "t", chosen, {}, now=NOW)
    clean, summary, bad = one_by_one(rows, chosen)
    assert plain(out.clean) == sorted(((x["k"], x["v"]) for x in clean), key=repr)
    assert [tuple(r) for r in out.summary.select("rule", "action", "no_original_rows", "affected_rows").collect()] == summary
    assert plain(out.anomaly.select("k", "v", "QC", "action")) == sorted(bad, key=repr)


def test_a_hundred_reports_are_one_job(spark):
    df = spark.range(1000).selectExpr("id AS k").repartition(3).persist()
    df.count()
    many = [Rule(f"q{i}", f"k > {i}", "REPORT", "cleaning") for i in range(100)]
    spark.sparkContext.setJobGroup("rules", "rules")
    try:
        rules.run_rules({"t": df}, "t", many, {}, now=NOW)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("rules")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 6  # is it empty, and one aggregate, whose stages adaptive planning may run as jobs of their own


@pytest.mark.parametrize("dtype", ["numeric", "fraction", "date", "datetime"])
def test_histogram_ranges_of_skewed_keys(spark, dtype):
    """Every row in one range, none with over twice the mean, few queries to the source."""
    rng = random.Random(6)
    draw = {
        "numeric": lambda: int(rng.random() ** 8 * 10**9), "fraction": lambda: rng.expovariate(1) ** 4, "date": lambda: date(2000, 1, 1) + timedelta(days=int(rng.random() ** 5 * 9000)),
        "datetime": lambda: datetime(2000, 1, 1) + timedelta(seconds=int(rng.random() ** 6 * 9e8)),
    }[dtype]
    keys = [draw() for _ in range(2000)]
    df = spark.createDataFrame([(k,) for k in [*keys, None, None]], {"numeric": "k long", "fraction": "k double", "date": "k date", "datetime": "k timestamp"}[dtype]).coalesce(2).persist()
    asked = []

    def count(conditions):
        asked.append(len(conditions))
        return list(df.agg(*[F.count_if(F.expr(c)) for c in conditions]).first())

    predicates = databases.histogram_predicates(count, "k", min(keys), max(keys), 8, "numeric" if dtype == "fraction" else dtype)
    held = [df.where(p).where("k IS NOT NULL").count() for p in predicates]
    assert sum(held) == 2000 and max(held) <= 2 * 2000 / 8 and len(predicates) <= 8
    assert df.where(" OR ".join(predicates)).count() == 2002 and len(asked) <= 1 + databases.ROUNDS
    assert databases.histogram_predicates(count, "k", None, None, 8) == ["1 = 1"]


@pytest.mark.parametrize("name", ["m9_candidates", "e22_store_split", "e14_lost_sales", "b3_delta_log"])
def test_larger_tables(spark, name):
    """Queries that depend on the data, on more of it."""
    sf = "/root/testdata/sf0.01"
    queries, sql = {**loading.QUERIES, **analytics.QUERIES}, {**loading.SQL, **analytics.SQL}
    assert rows_of(queries[name](spark, sf)) == oracle(sql[name], sf)
