"""Registered queries of sources, sinks, mapping, validation, control and rules, with their oracles."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.functions.scratch import scratch_path, staged
from shelfmark.functions.types import map_type
from shelfmark.operators import control, deltalog, mapping, rules, tables, validate
from shelfmark.plans.specs import ColumnMapping, EntitySpec, Kpi, Rule
from shelfmark.plans.views import inventory_master, product_master, store_master, table, transaction_master, with_entities
from shelfmark.sources import databases, files

NOW = datetime(2024, 1, 1)
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


# --- sources

@query("a1_landing_folders", """SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events
  WHERE CAST(ts AS DATE) > DATE '2024-01-04' AND CAST(ts AS DATE) <= DATE '2024-01-08' GROUP BY 1""")
def a1(spark, d):
    events, root = table(spark, d, "events"), scratch_path(spark, "landing")
    days = [date(2024, 1, 3 + i) for i in range(7)]
    for day in days:
        events.where(F.to_date("ts") == F.lit(day)).write.parquet(f"{root}/{day:%Y%m%d}")
    dirs = files.pick_dirs(files.expand_landing_dirs(root, "yyyyMMdd", date(2024, 1, 4), date(2024, 1, 8)), "incremental")
    return files.read_parquet_dirs(spark, dirs).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("a2_newest_folder", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09' GROUP BY 1")
def a2(spark, d):
    events, root = table(spark, d, "events"), scratch_path(spark, "landing")
    for day in (date(2024, 1, 9), date(2024, 1, 7)):
        events.where(F.to_date("ts") == F.lit(day)).write.parquet(f"{root}/{day:%Y-%m-%d}")
    dirs = files.pick_dirs([f"{root}/2024-01-09", f"{root}/2024-01-07"], "full")
    return files.read_parquet_dirs(spark, dirs).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))


@query("a3_read_delimited", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_mktsegment || ', "x"' END AS segment FROM customer""")
def a3(spark, d):
    path = scratch_path(spark, "csv")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") % 5 != 0, F.concat("c_mktsegment", F.lit(', "x"'))).alias("segment"))
    rows.write.csv(path, header=True, quote='"', escape="\\", compression="gzip")
    return files.read_delimited(spark, path)


@query("a4_read_stripped", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' "n" x' AS c_name, CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer""")
def a4(spark, d):
    path = scratch_path(spark, "txt")
    q, c = F.lit('"'), F.col
    full = F.concat_ws("|", F.concat(q, c("c_custkey"), q), F.concat(q, c("c_name"), F.lit(' "n" x'), q), F.concat(q, c("c_mktsegment"), q), F.lit("extra"))
    short = F.concat_ws("|", F.concat(q, c("c_custkey"), q), F.concat(q, c("c_name"), F.lit(' "n" x'), q))
    table(spark, d, "customer").select(F.when(c("c_nationkey") % 7 == 0, short).otherwise(full).alias("value")).write.text(path)
    return files.read_delimited(spark, path, "|", header=False, mode="strip_quotes", columns=["c_custkey", "c_name", "segment"])


@query("a5_zipped", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment, 'part-' || CAST(c_custkey % 3 AS VARCHAR) || '.csv' AS member FROM customer")
def a5(spark, d):
    import io
    import zipfile

    path = scratch_path(spark, "zip")

    def zipped(rows):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            z.writestr(f"part-{rows['m'].iloc[0]}.csv", rows[["c_custkey", "c_mktsegment"]].to_csv(index=False))
            z.writestr("readme.pdf", "no data")
        rows = rows.iloc[:1].assign(content=held.getvalue().hex())
        return rows[["m", "content"]]

    members = table(spark, d, "customer").select("c_custkey", "c_mktsegment", (F.col("c_custkey") % 3).cast("int").alias("m"))
    archives = members.groupBy("m").applyInPandas(zipped, "m int, content string")
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in archives.collect():  # three archives, written as another system would
        target = fs_path(f"{path}/a{r['m']}.zip")
        out = target.getFileSystem(conf).create(target)
        out.write(bytearray.fromhex(r["content"]))
        out.close()
    got = files.read_zipped_delimited(spark, path)
    return got.select("c_custkey", "c_mktsegment", F.element_at(F.split("file", "!"), -1).alias("member"))


@query("a11_b13_jdbc", "SELECT 'table' AS how, count(*) AS n, sum(s_suppkey) AS total, TRUE AS parted FROM supplier UNION ALL SELECT 'keys', count(*), sum(s_suppkey), TRUE FROM supplier UNION ALL SELECT 'queries', count(*), sum(s_suppkey), TRUE FROM supplier WHERE s_suppkey <= 3 OR s_suppkey > 5")
def a11(spark, d):
    import tempfile

    # an embedded database lives in the driver's process, so this query runs in local mode
    url, props = f"jdbc:derby:{tempfile.mkdtemp(prefix='derby-')}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("S_SUPPKEY"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("NATION"))
    tables.write_jdbc(rows, url, "SUPPLIERS", "overwrite", props=props, column_types="NATION VARCHAR(10)")
    tables.write_jdbc(rows.limit(0), url, "SUPPLIERS", "append", props=props)
    whole = databases.read_jdbc_partitioned(spark, url, "SUPPLIERS", '"S_SUPPKEY"', "numeric", props, threshold=5, size=3)
    keys = databases.read_jdbc_partitioned(spark, url, "SUPPLIERS", '"NATION"', "string", props, threshold=5, size=4)
    some = databases.read_jdbc(spark, url, queries='SELECT * FROM SUPPLIERS WHERE "S_SUPPKEY" <= 3; SELECT * FROM SUPPLIERS WHERE "S_SUPPKEY" > 5;', props=props)
    out = []
    for how, df in (("table", whole), ("keys", keys), ("queries", some)):
        out.append(df.agg(F.lit(how).alias("how"), F.count("*").alias("n"), F.sum("S_SUPPKEY").alias("total"), F.lit(df.rdd.getNumPartitions() > 1).alias("parted")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("a16_chunks", "SELECT count(*) AS n, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS chunks, TRUE AS even, 0 AS lost FROM orders")
def a16(spark, d):
    # a skewed key: most values are small
    orders = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderkey") * F.col("o_orderkey")).alias("k"))
    orders = staged(orders, "keys")
    counts = databases.range_counts(orders, "k", databases.chunk_edges(orders, "k", 1000))
    # the first chunk has the NULLs, a fiftieth of the rows, besides
    found = counts.agg(F.count("*").alias("chunks"), F.max(F.when(F.col("chunk") > 0, F.col("n"))).alias("most"), F.sum("n").alias("kept"))
    even = F.coalesce(F.col("most") <= 1100, F.lit(True))
    return orders.agg(F.count("*").alias("n")).crossJoin(F.broadcast(found)).select("n", "chunks", even.alias("even"), (F.col("n") - F.col("kept")).cast("int").alias("lost"))


@query("a20_required_rows", "SELECT 'all' AS name, '' AS error, CAST(count(*) AS VARCHAR) AS message FROM events UNION ALL SELECT 'optional', '', 'None' UNION ALL SELECT 'mandatory', 'EmptyPull', 'events'")
def a20(spark, d):
    e = table(spark, d, "events")
    rows = [("all", "", str(databases.require_rows(e, "events", True).count())), ("optional", "", str(databases.require_rows(e.where("user_id < 0"), "events", False)))]
    return spark.createDataFrame([*rows, _failure(spark, "mandatory", lambda: databases.require_rows(e.where("user_id < 0"), "events", True))], _FAILURE)


@query("a7_normalised_names", "SELECT p_partkey AS partkey, p_name AS p_name, p_size AS size_cm FROM part")
def a7(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("part-key"), "p_name", F.col("p_size").alias("size (_cm)"))
    return text.normalise_names(rows)


@query("a8_audit_from_path", """SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT CASE WHEN event_id % 3 = 0 THEN date_trunc('minute', ts) WHEN event_id % 3 = 1 THEN date_trunc('day', ts)
  ELSE TIMESTAMP '2024-01-01' END) AS stamps FROM events GROUP BY 1""")
def a8(spark, d):
    n = F.col("event_id") % 3
    path = F.when(n == 0, F.concat(F.lit("in/99999999/"), F.date_format("ts", "yyyyMMddHHmm"), F.lit(".csv"))).when(n == 1, F.concat(F.lit("in/"), F.date_format("ts", "yyyy-MM-dd"), F.lit("/a.csv"))).otherwise("in/none.csv")
    return files.with_audit_column(table(spark, d, "events"), "audit", NOW, path).groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.countDistinct("audit").alias("stamps"))


def _encoded_sql(c: str) -> str:
    for ch, n in text.SPECIAL_CHARS.items():
        c = f"replace({c}, '{ch.replace(chr(39), chr(39) * 2)}', '{text.TOKEN}{n}')"
    return c


@query("a10_special_chars", f"SELECT page_id, md5({_encoded_sql('html')}) AS encoded, md5(html) AS decoded FROM pages")
def a10(spark, d):
    encoded = text.encode_special_chars(table(spark, d, "pages").select("page_id", "html"), ["html"])
    both = encoded.withColumn("back", F.col("html"))
    return text.decode_special_chars(both, ["back"]).select("page_id", F.md5("html").alias("encoded"), F.md5("back").alias("decoded"))


@query("a12_range_predicates", "SELECT CAST((o_orderkey >= m // 7)::INT + (o_orderkey >= m * 2 // 7)::INT + (o_orderkey >= m * 3 // 7)::INT + (o_orderkey >= m * 4 // 7)::INT + (o_orderkey >= m * 5 // 7)::INT + (o_orderkey >= m * 6 // 7)::INT AS BIGINT) AS part, count(*) AS n FROM orders, (SELECT max(o_orderkey) AS m FROM orders) GROUP BY 1")
def a12(spark, d):
    orders = table(spark, d, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    part = F.lit(None).cast("long")
    for i, p in reversed(list(enumerate(databases.range_predicates("o_orderkey", low, high, 7)))):
        part = F.when(F.expr(p), F.lit(i).cast("long")).otherwise(part)
    return orders.groupBy(part.alias("part")).agg(F.count("*").alias("n"))


def _cube(c: str):
    # longs hold cubes of keys up to two million only
    wide = F.col(c).cast("decimal(12,0)")
    return (wide * wide * wide).cast("decimal(38,0)")


@query("a12_histogram_ranges", "SELECT count(*) AS n, TRUE AS even, 0 AS lost FROM orders")
def a12h(spark, d):
    # cubes lie far apart at the top; a thirtieth of the keys is missing
    orders = table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 30 != 0, _cube("o_orderkey")).alias("k"))
    low, high = orders.agg(F.min("k"), F.max("k")).first()
    predicates = databases.histogram_predicates(lambda cs: list(orders.agg(*[F.count_if(F.expr(c)) for c in cs]).first()), "k", low, high, 7)
    found = orders.agg(F.count("*").alias("n"), *[F.count_if(F.expr(p) & F.col("k").isNotNull()).alias(f"c{i}") for i, p in enumerate(predicates)], F.count_if(F.expr(" OR ".join(predicates))).alias("all"))
    even = F.greatest(*[F.col(f"c{i}") for i in range(len(predicates))], F.lit(0)) <= 2 * F.col("n") / 7
    return found.select("n", even.alias("even"), (F.col("n") - F.col("all")).cast("int").alias("lost"))


@query("a12b_packed_keys", """SELECT k, n, CASE WHEN k IS NULL THEN 0 ELSE CAST(floor((sum(n) OVER (ORDER BY n, k NULLS FIRST ROWS UNBOUNDED PRECEDING) - 1) / 400) AS BIGINT) % 5 END AS grp
  FROM (SELECT CASE WHEN c_nationkey = 3 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS k, count(*) AS n FROM customer GROUP BY 1)""")
def a12b(spark, d):
    key = F.when(F.col("c_nationkey") != 3, F.col("c_nationkey").cast("string")).alias("k")
    return databases.pack_keys(table(spark, d, "customer").groupBy(key).agg(F.count("*").alias("n")), "k", 400, 5)


@query("a13_jdbc_rows", "SELECT p_partkey, substr('12:30:15.123456789', 1, 15) AS t, split_part(p_name, ' ', 1) || '/' || p_brand AS words FROM part")
def a13(spark, d):
    arr = F.concat(F.lit("{"), F.split_part("p_name", F.lit(" "), F.lit(1)), F.lit(", "), F.col("p_brand"), F.lit("}"))
    rows = table(spark, d, "part").select("p_partkey", F.lit("12:30:15.123456789").alias("t"), arr.alias("words"))
    return databases.map_jdbc_rows(rows, {"t": "time", "words": "text[]"}).withColumn("words", F.array_join("words", "/"))


@query("a14_incremental_filter", "SELECT event_type, count(*) AS n FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1")
def a14(spark, d):
    return databases.incremental_filter(table(spark, d, "events"), "ts", "2024-01-20 00:00:00", "timestamp").groupBy("event_type").agg(F.count("*").alias("n"))


@query("a15_pull_audit", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def a15(spark, d):
    return databases.with_pull_audit(table(spark, d, "events"), "audit", "ts").groupBy(F.to_date("audit").alias("day")).agg(F.count("*").alias("n"))


@query("a17_unload_round_trip", """SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""")
def a17(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")).alias("c_mktsegment"), "c_acctbal", "c_nationkey")
    unloaded = databases.normalise_unload(rows)
    as_text = unloaded.select(*[F.col(c).cast("string").alias(c) for c in unloaded.columns])
    return databases.decode_unload(as_text, {"c_custkey": "long", "c_mktsegment": "string", "c_acctbal": "double", "c_nationkey": "long"})


@query("a19_table_union", "SELECT 'o' AS src, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'l', l_linestatus, count(*) FROM lineitem GROUP BY 2")
def a19(spark, d):
    table(spark, d, "orders").select(F.lit("o").alias("src"), F.col("o_orderstatus").alias("s")).createOrReplaceTempView("a19_o")
    table(spark, d, "lineitem").select(F.lit("l").alias("src"), F.col("l_linestatus").alias("s")).createOrReplaceTempView("a19_l")
    return databases.read_tables(spark, ["a19_o", "a19_l"]).groupBy("src", "s").agg(F.count("*").alias("n"))


@query("a21_dated_files", """WITH f AS (SELECT day, 'in/' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') || CASE WHEN user_id % 10 = 7 THEN '-none' ELSE '-' || strftime(day, '%Y%m%d') END || '.csv' AS path, user_id % 10 = 7 AS bad, n
    FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2))
  SELECT path, CAST(sum(n) AS BIGINT) AS n_rows, max(day) AS file_date FROM f WHERE path < (SELECT min(path) FROM f WHERE bad) GROUP BY 1""")
def a21(spark, d):
    user = F.col("user_id") % 10
    name = F.concat(F.lit("in/"), F.lpad(user.cast("string"), 2, "0"), F.when(user == 7, "-none").otherwise(F.concat(F.lit("-"), F.date_format("ts", "yyyyMMdd"))), F.lit(".csv"))
    listing = table(spark, d, "events").groupBy(name.alias("path")).agg(F.count("*").alias("n_rows"))
    return databases.dated_prefix_files(listing)


# --- tables

def _customers(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey")
    old = c.where(key % 5 != 0).withColumn("active", F.lit(True))
    changed = F.when(key % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    new = c.where(key % 7 != 0).withColumn("c_acctbal", changed)
    return old, new


_OLD = "old AS (SELECT *, TRUE AS active FROM customer WHERE c_custkey % 5 <> 0), new AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 7 <> 0)"
_MERGED = "coalesce(n.c_custkey, o.c_custkey) AS c_custkey, CASE WHEN n.c_custkey IS NULL THEN o.c_name ELSE n.c_name END AS c_name, coalesce(n.c_nationkey, o.c_nationkey) AS c_nationkey, coalesce(n.c_acctbal, o.c_acctbal) AS c_acctbal, coalesce(n.c_mktsegment, o.c_mktsegment) AS c_mktsegment"
_COLS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("b3_merge_keep", f"WITH {_OLD} SELECT {_MERGED}, o.active FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey")
def b3(spark, d):
    old, new = _customers(spark, d)
    return tables.merge_upsert(old, new, ["c_custkey"], _COLS)


@query("b4_merge_delete", f"WITH {_OLD} SELECT {_MERGED}, o.active FROM old o RIGHT JOIN new n ON o.c_custkey = n.c_custkey")
def b4(spark, d):
    old, new = _customers(spark, d)
    return tables.merge_upsert(old, new, ["c_custkey"], _COLS, "delete")


@query("b5_merge_deactivate", f"WITH {_OLD} SELECT {_MERGED}, n.c_custkey IS NOT NULL AS active FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey")
def b5(spark, d):
    old, new = _customers(spark, d)
    return tables.merge_upsert(old, new, ["c_custkey"], _COLS, "deactivate")


@query("b6_merge_pruned", f"WITH {_OLD}, few AS (SELECT * FROM new WHERE c_nationkey < 5) SELECT {_MERGED}, o.active FROM old o FULL JOIN few n ON o.c_custkey = n.c_custkey")
def b6(spark, d):
    old, new = _customers(spark, d)
    return tables.merge_upsert(old, new.where("c_nationkey < 5"), ["c_custkey"], _COLS, partition_col="c_nationkey")


@query("b7_replace_window", """SELECT user_id, CAST(ts AS DATE) AS day, value FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'
  UNION ALL SELECT user_id, CAST(ts AS DATE), value * 2 FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' AND event_type <> 'error'""")
def b7(spark, d):
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("day"), "value", "event_type")
    staged = e.where("day > DATE '2024-01-20' AND event_type <> 'error'").withColumn("value", F.col("value") * 2).drop("event_type")
    return tables.replace_window(e.drop("event_type"), staged, "day", 10, date(2024, 1, 30))


@query("b8_replace_from_week", """WITH w AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS week, count(*) AS n FROM orders GROUP BY 1)
  SELECT week, n FROM w WHERE week < 199801 UNION ALL SELECT week, n + 1 FROM w WHERE week >= 199801 AND week <> 199805""")
def b8(spark, d):
    w = table(spark, d, "orders").groupBy((F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("week")).agg(F.count("*").alias("n"))
    return tables.replace_from_week(w, w.where("week >= 199801 AND week <> 199805").withColumn("n", F.col("n") + 1), "week")


@query("b9_delta", f"""WITH {_OLD} SELECT *, 1 AS __record_type FROM (SELECT c_custkey, c_acctbal, c_mktsegment FROM new EXCEPT SELECT c_custkey, c_acctbal, c_mktsegment FROM old)
  UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, 0 FROM old WHERE c_custkey NOT IN (SELECT c_custkey FROM new)""")
def b9(spark, d):
    old, new = _customers(spark, d)
    return tables.compute_delta(new, old, ["c_custkey"], ["c_acctbal", "c_mktsegment"])


def _log(spark, old):
    return deltalog.create_log(old, scratch_path(spark, "log"), ["c_custkey"], _COLS)


@query("b3_delta_log", f"WITH {_OLD} SELECT {_MERGED}, o.active FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey")
def b3l(spark, d):
    # three batches, of which one brings older values first and one is run twice, and a compaction between them
    old, new = _customers(spark, d)
    log, third = _log(spark, old), F.col("c_custkey") % 3
    deltalog.append_batch(log, new.where(third > 0).withColumn("c_acctbal", F.lit(0.0)), 0)
    deltalog.append_batch(log, new.where(third == 1), 1)
    deltalog.compact(spark, log)
    for _ in range(2):
        deltalog.append_batch(log, new.where(third != 1), 2)
    deltalog.append_batch(log, new.where(third == 1).withColumn("c_acctbal", F.lit(1.0)), 1)
    return deltalog.current(spark, log)


@query("b4_delta_log_delete", f"WITH {_OLD} SELECT {_MERGED}, o.active FROM old o RIGHT JOIN new n ON o.c_custkey = n.c_custkey")
def b4l(spark, d):
    old, new = _customers(spark, d)
    log = _log(spark, old)
    deltalog.append_batch(log, new, 0, "delete")
    return deltalog.current(spark, log)


@query("b5_delta_log_deactivate", f"WITH {_OLD} SELECT {_MERGED}, n.c_custkey IS NOT NULL AS active FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey")
def b5l(spark, d):
    old, new = _customers(spark, d)
    log = _log(spark, old)
    deltalog.append_batch(log, new, 0, "deactivate")
    deltalog.compact(spark, log)
    return deltalog.current(spark, log)


@query("b9_fingerprint_delta", SQL["b9_delta"])
def b9f(spark, d):
    old, new = _customers(spark, d)
    cols, paths = ["c_acctbal", "c_mktsegment"], [scratch_path(spark, n) for n in ("new", "old")]
    for df, path in ((new, paths[0]), (old, paths[1])):
        deltalog.write_fingerprinted(df, path, ["c_custkey"], cols)
    return deltalog.fingerprint_delta(spark, *paths, new.select("c_custkey", *cols).schema, ["c_custkey"], cols)


def _failure(spark, name: str, action) -> tuple[str, str, str]:
    """What a check raises, as a row."""
    try:
        action()
    except Exception as e:  # noqa: BLE001
        return name, type(e).__name__, str(e)
    return name, "", ""


_FAILURE = "name string, error string, message string"


@query("b10_schema_drift", """SELECT 'same' AS name, '' AS error, '' AS message UNION ALL SELECT 'fewer', '', '' UNION ALL SELECT 'more', 'SchemaDrift', string_agg(column_name, ', ' ORDER BY column_name)
  FROM (DESCRIBE SELECT c_custkey AS a_key, c_name AS z_name FROM customer)""")
def b10(spark, d):
    old = table(spark, d, "customer")
    new = old.select("*", F.col("c_name").alias("z_name"), F.col("c_custkey").alias("a_key"))
    cases = {"same": old, "fewer": old.drop("c_name"), "more": new}
    return spark.createDataFrame([_failure(spark, n, lambda x=x: tables.check_schema_drift(x.columns, old.columns)) for n, x in cases.items()], _FAILURE)


def _table_name(spark, name: str) -> str:
    return f"{name}_{scratch_path(spark, 'x').rsplit('-', 1)[-1]}"


@query("b1_write_append", "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey < 20 UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey >= 15")
def b1(spark, d):
    rows, name = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), _table_name(spark, "b1")
    tables.write_table(rows.where("s_nationkey < 3"), name, "TRUNCATE")
    tables.write_table(rows.where("s_nationkey < 20"), name, "TRUNCATE", "never")
    tables.write_table(rows.where("s_nationkey >= 15").select("s_nationkey", "s_name", "s_suppkey"), name, "APPEND")
    return spark.table(name)


@query("b2_partitioned", "SELECT CAST(ts AS DATE) AS ts_day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY 1, 2")
def b2(spark, d):
    name = _table_name(spark, "b2")
    tables.write_partitioned(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), name, "ts", ("event_type", "user_id"))
    days = spark.table(name).where("ts_day BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'")
    return days.groupBy("ts_day", "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("b14_copied_tables", "SELECT 'n' AS src, CAST(n_nationkey AS VARCHAR) AS k, n_name AS v FROM nation UNION ALL SELECT 'r', CAST(r_regionkey AS VARCHAR), r_name FROM region")
def b14(spark, d):
    n, r = _table_name(spark, "b14n"), _table_name(spark, "b14r")
    table(spark, d, "nation").createOrReplaceTempView(f"v_{n}")
    table(spark, d, "region").createOrReplaceTempView(f"v_{r}")
    tables.copy_tables(spark, f"v_{n}:{n}, v_{r}:{r}", lambda df, target: tables.write_table(df, target, "TRUNCATE"))
    return spark.table(n).selectExpr("'n' AS src", "cast(n_nationkey as string) AS k", "n_name AS v").unionByName(spark.table(r).selectExpr("'r' AS src", "cast(r_regionkey as string) AS k", "r_name AS v"))


@query("b17_backup", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def b17(spark, d):
    name = _table_name(spark, "b17")
    tables.write_table(table(spark, d, "orders"), name, "TRUNCATE")
    copy = tables.backup_table(spark, name, date(2024, 1, 5))
    tables.write_table(table(spark, d, "orders").where("o_orderkey < 0"), name, "TRUNCATE")
    return spark.table(copy).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("b19_passthrough", "SELECT p_partkey, p_brand, p_size FROM part")
def b19(spark, d):
    src, dst = _table_name(spark, "b19"), _table_name(spark, "b19p")
    tables.write_table(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), src, "TRUNCATE")
    tables.publish_passthrough(spark, src, dst)
    return spark.table(dst)


@query("b20_types", """SELECT name, kind FROM (VALUES ('customer.c_acctbal', 'double'), ('customer.c_custkey', 'bigint'), ('customer.c_mktsegment', 'string'), ('customer.c_name', 'string'), ('customer.c_nationkey', 'bigint')) t(name, kind)
  WHERE (SELECT count(*) FROM customer) > 0""")
def b20(spark, d):
    customer = table(spark, d, "customer")
    declared = {"c_custkey": "int8", "c_name": "varchar(25)", "c_nationkey": "INT4", "c_acctbal": "double precision", "c_mktsegment": "text"}
    cast = customer.select(*[F.col(c).cast(map_type(t, "postgresql")).alias(c) for c, t in declared.items()])
    return spark.createDataFrame([(f"customer.{c}", t) for c, t in cast.dtypes if not cast.isEmpty()], "name string, kind string")


@query("b21_appended_summary", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'ALL', (SELECT count(*) FROM customer) UNION ALL SELECT NULL, 0")
def b21(spark, d):
    by = table(spark, d, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return tables.append_summary(by, [{"c_mktsegment": "ALL", "n": table(spark, d, "customer").count()}, {"n": 0}])


@query("b11_attributes_long", """SELECT p_partkey, 'p_brand' AS attribute_name, p_brand AS attribute_value FROM part UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'tags', '["' || p_type || '","' || p_brand || '"]' FROM part""")
def b11(spark, d):
    return tables.attributes_long(table(spark, d, "part").withColumn("tags", F.array("p_type", "p_brand")), ["p_partkey"], ["p_brand", "p_size", "tags"])


@query("b12_attributes_delta", """SELECT p_partkey, 'p_size' AS attribute_name, CAST(p_size + 1 AS VARCHAR) AS attribute_value FROM part WHERE p_partkey % 4 = 0
  UNION SELECT p_partkey, 'p_brand', p_brand FROM part WHERE p_partkey % 9 = 0""")
def b12(spark, d):
    part = table(spark, d, "part")
    known = tables.attributes_long(part, ["p_partkey"], ["p_brand", "p_size"]).where("NOT (attribute_name = 'p_brand' AND p_partkey % 9 = 0)")
    changed = part.withColumn("p_size", F.when(F.col("p_partkey") % 4 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return tables.attributes_delta(changed, known, ["p_partkey"], ["p_brand", "p_size"])


@query("b15_export_round_trip", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def b15(spark, d):
    path = scratch_path(spark, "export")
    tables.export_delimited(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), path)
    return files.read_delimited(spark, path, "|")


@query("b16_anomaly_export", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name || ' | ' || CAST(s_nationkey AS VARCHAR) AS names, '2024-01-01/supplier' AS folder FROM supplier WHERE s_nationkey > 10")
def b16(spark, d):
    bad = table(spark, d, "supplier").where("s_nationkey > 10").select("s_suppkey", F.array("s_name", F.col("s_nationkey").cast("string")).alias("names"))
    bad = bad.withColumns({"QC": F.lit("null_check"), "action": F.lit("DELETE"), "insertion_date": F.lit(NOW)})
    path = tables.export_anomalies(bad, scratch_path(spark, "anomalies"), "supplier", NOW.date(), sep=";")
    folder = F.array_join(F.slice(F.split(F.col("_metadata.file_path"), "/"), -3, 2), "/")
    return spark.read.csv(path, sep=";", header=True).select("s_suppkey", "names", folder.alias("folder"))


@query("b18_ensure_column", "SELECT p_partkey, '1' AS mp_bucket_code FROM part")
def b18(spark, d):
    return tables.ensure_column(table(spark, d, "part").select("p_partkey"), "mp_bucket_code", "1")


# --- mapping and validation

LINE = EntitySpec(
    "line", "lineitem", "line_master",
    (
        ColumnMapping("order_code", "bigint", "l_orderkey", unique_by=True, is_null_allowed=False),
        ColumnMapping("line_no", "int", "l_linenumber", unique_by=True, is_null_allowed=False),
        ColumnMapping("net", "double", formula="CAST(l_extendedprice AS DOUBLE) * (1 - CAST(l_discount AS DOUBLE))"),
        ColumnMapping("qty", "int", "l_quantity_text"),
        ColumnMapping("colour", "string"),
    ),
)


def _raw_lines(spark, d):
    n = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string"), F.when(n != 7, n).cast("string").alias("l_linenumber"), F.col("l_extendedprice").cast("string"), F.col("l_discount").cast("string"),
        F.when(F.col("l_suppkey") % 9 == 0, "many").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("l_quantity_text"), "l_returnflag",
    )


_MAPPED = """mapped AS (SELECT l_orderkey AS order_code, CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS INTEGER) END AS line_no, l_extendedprice * (1 - l_discount) AS net,
  CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_quantity AS INTEGER) END AS qty, CAST(NULL AS VARCHAR) AS colour, l_returnflag FROM lineitem)"""
_FLAGGED = _MAPPED + """, flagged AS (SELECT *, order_code IS NULL OR line_no IS NULL AS null_check,
  row_number() OVER (PARTITION BY order_code, line_no ORDER BY order_code NULLS FIRST, line_no NULLS FIRST, net NULLS FIRST, qty NULLS FIRST, colour NULLS FIRST, l_returnflag NULLS FIRST) > 1 AS primary_key_check FROM mapped)"""


def _flagged(spark, d):
    mapped = mapping.apply_mapping(_raw_lines(spark, d), LINE.mapping)
    return validate.flag_duplicates(validate.flag_nulls(mapped, LINE.required), LINE.keys, ["order_code", "line_no", "net", "qty", "colour", "l_returnflag"])


@query("c1_mapping", f"WITH {_MAPPED} SELECT order_code, line_no, round(net, 4) AS net, qty, colour, l_returnflag FROM mapped")
def c1(spark, d):
    return mapping.apply_mapping(_raw_lines(spark, d), LINE.mapping).withColumn("net", F.round("net", 4))


@query("c2_watermark", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01' GROUP BY 1")
def c2(spark, d):
    return mapping.apply_watermark(table(spark, d, "orders"), "o_orderdate", datetime(1998, 1, 1)).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("c3_c4_flags", f"WITH {_FLAGGED} SELECT null_check, primary_key_check, count(*) AS n FROM flagged GROUP BY 1, 2")
def c34(spark, d):
    return _flagged(spark, d).groupBy("null_check", "primary_key_check").agg(F.count("*").alias("n"))


@query("c5_clean", f"WITH {_FLAGGED} SELECT order_code, line_no, round(net, 4) AS net, qty, l_returnflag FROM flagged WHERE NOT (null_check OR primary_key_check)")
def c5(spark, d):
    return validate.quarantine(_flagged(spark, d), NOW)[0].drop("colour").withColumn("net", F.round("net", 4))


@query("c5_anomaly", f"""WITH {_FLAGGED} SELECT order_code, line_no, CASE WHEN null_check THEN 'null_check' ELSE 'primary_key_check' END AS "QC", 'DELETE' AS action, count(*) AS n
  FROM flagged WHERE null_check OR primary_key_check GROUP BY 1, 2, 3""")
def c5a(spark, d):
    return validate.quarantine(_flagged(spark, d), NOW)[1].groupBy("order_code", "line_no", "QC", "action").agg(F.count("*").alias("n"))


@query("c6_validation_summary", f"""WITH {_FLAGGED}, c AS (SELECT count(*) AS n, count(*) FILTER (null_check) AS a, count(*) FILTER (primary_key_check AND NOT null_check) AS b FROM flagged)
  SELECT 'line' AS "table", 'validation' AS module, rule, 'DELETE' AS action, n AS no_original_rows, x AS affected_rows, round(x * 100.0 / n, 4) AS affected_rows_percent, CASE WHEN x > 0 THEN 'Fail' ELSE 'Pass' END AS status
  FROM (SELECT n, 'null_check' AS rule, a AS x FROM c UNION ALL SELECT n, 'primary_key_check', b FROM c)""")
def c6(spark, d):
    return validate.validation_summary(_flagged(spark, d), "line", NOW).drop("insertion_date")


@query("c7_null_profile", f"""WITH {_MAPPED} SELECT string_agg(t, ' '' ' ORDER BY t) AS null_columns FROM (SELECT 'colour - ' || count(*) AS t FROM mapped WHERE colour IS NULL HAVING count(*) > 0
  UNION ALL SELECT 'line_no - ' || count(*) FROM mapped WHERE line_no IS NULL HAVING count(*) > 0 UNION ALL SELECT 'qty - ' || count(*) FROM mapped WHERE qty IS NULL HAVING count(*) > 0)""")
def c7(spark, d):
    return validate.null_profile(mapping.apply_mapping(_raw_lines(spark, d), LINE.mapping), ["order_code", "line_no", "qty", "colour"])


@query("c8_data_loss", f"""WITH {_FLAGGED} SELECT (count(*) - count(*) FILTER (NOT (null_check OR primary_key_check))) * 100.0 / count(*) > 30 AS over_30,
  (count(*) - count(*) FILTER (NOT (null_check OR primary_key_check))) * 100.0 / count(*) > 90 AS over_90 FROM flagged""")
def c8(spark, d):
    flagged = _flagged(spark, d)
    summary, clean = validate.validation_summary(flagged, "line", NOW), validate.quarantine(flagged, NOW)[0]
    return spark.createDataFrame([(validate.data_loss(summary, clean, 30), validate.data_loss(summary, clean, 90))], "over_30 boolean, over_90 boolean")


@query("c9_anomaly_metrics", f"""WITH {_FLAGGED}, c AS (SELECT count(*) AS n, count(*) FILTER (line_no IS NULL) AS a, count(*) FILTER (qty IS NULL) AS b, count(*) FILTER (primary_key_check) AS k FROM flagged),
  m AS (SELECT n, 'null line_no' AS metric, a AS x FROM c UNION ALL SELECT n, 'null qty', b FROM c UNION ALL SELECT n, 'duplicate order_code,line_no', k FROM c)
  SELECT metric, 'rows' AS kind, CAST(x AS DOUBLE) AS value FROM m UNION ALL SELECT metric, 'percent', round(x * 100.0 / n, 4) FROM m""")
def c9(spark, d):
    return validate.anomaly_metrics(_flagged(spark, d), ["line_no", "qty"], LINE.keys)


@query("c10_missing_references", "SELECT o_orderkey, o_custkey, 'no customer' AS reason FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0)")
def c10(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    return validate.missing_references(o, c, "o_custkey", "no customer").select("o_orderkey", "o_custkey", "reason")


@query("c11_generic_check", "SELECT 'clean' AS name, '' AS error, '' AS message WHERE (SELECT count(*) = count(DISTINCT o_orderkey) FROM orders) UNION ALL SELECT 'nulls', 'QualityError', 'NULL in status' WHERE (SELECT count(*) FROM orders WHERE o_orderkey % 5 = 0) > 0 UNION ALL SELECT 'keys', 'QualityError', 'repeated o_orderstatus'")
def c11(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"))
    cases = {"clean": (["o_orderkey"], ["o_orderkey"]), "nulls": (["status"], ["o_orderkey"]), "keys": (["o_orderkey"], ["o_orderstatus"])}
    return spark.createDataFrame([_failure(spark, n, lambda x=x, y=y: validate.generic_qc(o, x, y)) for n, (x, y) in cases.items()], _FAILURE)


@query("c12_select_except", "SELECT c_custkey, c_mktsegment FROM customer")
def c12(spark, d):
    return mapping.select_except(table(spark, d, "customer"), ["c_name", "c_nationkey", "c_acctbal"])


@query("c13_watermark_advance", "SELECT event_type AS view, CAST(CASE WHEN event_type = 'click' THEN (SELECT max(ts) FROM events WHERE event_type = 'click') ELSE min(ts) END AS VARCHAR) AS mark FROM events GROUP BY event_type")
def c13(spark, d):
    e = table(spark, d, "events")
    marks = e.groupBy(F.col("event_type").alias("view")).agg(F.min("ts").cast("timestamp").alias("extraction_sync_dt"))
    moved = control.advance_watermark(marks, e.where("event_type = 'click'"), "click", "ts", 10, 20, "incremental")
    kept = control.advance_watermark(moved, e.where("event_type = 'view'"), "view", "ts", 20, 20, "incremental")
    return kept.select("view", F.col("extraction_sync_dt").cast("string").alias("mark"))


@query("c14_reconciliation", """WITH l AS (SELECT event_type AS view, event_type = 'view' AS r, count(*) AS a, count(*) FILTER (ts < TIMESTAMP '2024-01-10') AS b FROM events GROUP BY 1),
  m AS (SELECT event_type AS view, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_type <> 'error' GROUP BY 1)
  SELECT l.view, CASE WHEN r THEN a ELSE a - b END AS loaded_rows, n AS manifest_rows, (CASE WHEN r THEN a ELSE a - b END) IS NOT DISTINCT FROM n AS matches FROM l LEFT JOIN m USING (view)""")
def c14(spark, d):
    e = table(spark, d, "events")
    early = F.count_if(F.col("ts") < F.lit("2024-01-10").cast("timestamp"))
    loaded = e.groupBy(F.col("event_type").alias("view")).agg((F.first("event_type") == "view").alias("replace"), early.alias("before"), F.count("*").alias("after"))
    manifests = e.where("ts >= TIMESTAMP '2024-01-10' AND event_type <> 'error'").groupBy(F.col("event_type").alias("VIEW"), F.to_date("ts")).agg(F.count("*").alias("Row_Count")).select("VIEW", "Row_Count")
    return control.reconcile_counts(loaded, manifests)


@query("c15_landing_readiness", """WITH l AS (SELECT DISTINCT CAST(ts AS DATE) AS folder_date, event_type AS f FROM events WHERE user_id % 20 = 1), t AS (SELECT DISTINCT folder_date FROM l WHERE f = 'error'),
  c AS (SELECT DISTINCT CAST(ts AS DATE) AS folder_date FROM events), j AS (SELECT c.folder_date, t.folder_date IS NOT NULL AS has_trigger FROM c LEFT JOIN t USING (folder_date)),
  g AS (SELECT min(folder_date) AS gap FROM j WHERE NOT has_trigger) SELECT folder_date, has_trigger, gap IS NULL OR folder_date < gap AS ready FROM j, g""")
def c15(spark, d):
    e = table(spark, d, "events").withColumn("folder_date", F.to_date("ts"))
    return control.landing_readiness(e.where("user_id % 20 = 1").select("folder_date", F.col("event_type").alias("file")), e.select("folder_date"), "error", True)


# --- rules

KPIS = {"KPI_1": Kpi("KPI_1", "l_extendedprice / l_quantity"), "KPI_10": Kpi("KPI_10", "KPI_1 * (1 - l_discount)"), "KPI_2": Kpi("KPI_2", "sum(l_quantity)")}


def _lines(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")


_RULES = [
    Rule("r1", "KPI_1 < 1000", "DELETE", "cleaning"),
    Rule("r2", "KPI_10 > 2000 AND l_discount > 0.08", "REPLACE", "cleaning", column="l_discount", value="0.08"),
    Rule("r3", "l_quantity > 45", "REPORT", "cleaning"),
    Rule("r4", "l_quantity > 49", "DELETE", "cleaning", threshold=">50%"),
    Rule("r5", "KPI_2 > 100", "REPORT", "cleaning", group_by=("l_suppkey",), agg=("KPI_2 AS total",)),
    Rule("r6", "b.s_nationkey < 5", "DELETE", "cleaning", other_table="supplier", on=("l_suppkey",)),
    Rule("r7", "l_returnflag = 'X'", "PAUSE", "cleaning"),
]
_CLEANED = """a AS (SELECT *, l_extendedprice / l_quantity AS k FROM lineitem), b AS (SELECT * FROM a WHERE NOT (k < 1000)),
  c AS (SELECT * REPLACE (CASE WHEN k * (1 - l_discount) > 2000 AND l_discount > 0.08 THEN 0.08 ELSE l_discount END AS l_discount), k * (1 - l_discount) > 2000 AND l_discount > 0.08 AS was FROM b),
  e AS (SELECT * FROM c WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5))"""


def _outcome(spark, d):
    lines = {"lines": _lines(spark, d), "supplier": table(spark, d, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")}
    return rules.run_rules(lines, "lines", _RULES, KPIS, "cleaning", NOW)


@query("d2_rules_clean", f"WITH {_CLEANED} SELECT l_suppkey, count(*) AS n, round(sum(l_discount), 4) AS discount, round(sum(l_quantity), 2) AS qty FROM e GROUP BY 1")
def d2(spark, d):
    return _outcome(spark, d).clean.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_discount"), 4).alias("discount"), F.round(F.sum("l_quantity"), 2).alias("qty"))


_SUMMED = f"""{_CLEANED}, s AS (SELECT 'r1' AS rule, 'DELETE' AS action, (SELECT count(*) FROM a) AS o, (SELECT count(*) FROM a WHERE k < 1000) AS x
  UNION ALL SELECT 'r2', 'REPLACE', (SELECT count(*) FROM b), (SELECT count(*) FROM c WHERE was) UNION ALL SELECT 'r3', 'REPORT', (SELECT count(*) FROM c), (SELECT count(*) FROM c WHERE l_quantity > 45)
  UNION ALL SELECT 'r4', 'REPORT', (SELECT count(*) FROM c), (SELECT count(*) FROM c WHERE l_quantity > 49)
  UNION ALL SELECT 'r5', 'REPORT_AGG', (SELECT count(*) FROM c), (SELECT least(100, count(*)) FROM (SELECT l_suppkey FROM c GROUP BY 1 HAVING sum(l_quantity) > 100))
  UNION ALL SELECT 'r6', 'DELETE', (SELECT count(*) FROM c), (SELECT count(*) FROM c) - (SELECT count(*) FROM e) UNION ALL SELECT 'r7', 'PAUSE', (SELECT count(*) FROM e), 0)"""


@query("d10_rule_summary", f"""WITH {_SUMMED} SELECT rule, action, o AS no_original_rows, x AS affected_rows, round(x * 100.0 / o, 4) AS affected_rows_percent, CASE WHEN x > 0 THEN 'Fail' ELSE 'Pass' END AS status FROM s""")
def d10(spark, d):
    return _outcome(spark, d).summary.select("rule", "action", "no_original_rows", "affected_rows", "affected_rows_percent", "status")


@query("d3_rule_anomalies", f"""WITH {_CLEANED} SELECT 'r1' AS "QC", 'DELETE' AS action, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM a WHERE k < 1000 UNION ALL SELECT 'r2', 'REPLACE', count(*), round(sum(l_quantity), 2) FROM c WHERE was
  UNION ALL SELECT 'r3', 'REPORT', count(*), round(sum(l_quantity), 2) FROM c WHERE l_quantity > 45 UNION ALL SELECT 'r4', 'REPORT', count(*), round(sum(l_quantity), 2) FROM c WHERE l_quantity > 49 HAVING count(*) > 0
  UNION ALL SELECT 'r6', 'DELETE', count(*), round(sum(l_quantity), 2) FROM c WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)""")
def d3(spark, d):
    return _outcome(spark, d).anomaly.groupBy("QC", "action").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("d2_many_rules", """SELECT 'q' || i AS rule, count(*) AS no_original_rows, count(*) FILTER (l_quantity > i / 2.0) AS affected_rows FROM lineitem, (SELECT unnest(range(100)) AS i) GROUP BY i""")
def d2m(spark, d):
    many = [Rule(f"q{i}", f"l_quantity > {i / 2}", "REPORT", "cleaning") for i in range(100)]
    return rules.run_rules({"lines": _lines(spark, d)}, "lines", many, KPIS, "cleaning", NOW).summary.select("rule", "no_original_rows", "affected_rows")


@query("d7_paused", """WITH a AS (SELECT *, l_quantity > 49 AS bad FROM lineitem) SELECT 'p1' AS rule, 'PAUSE' AS action, count(*) AS no_original_rows, count(*) FILTER (bad) AS affected_rows, 'Fail' AS status, TRUE AS paused FROM a
  UNION ALL SELECT 'p2', 'PAUSE', count(*), 0, 'Pass', TRUE FROM a UNION ALL SELECT 'old', 'DELETE', 7, 7, 'Fail', TRUE UNION ALL SELECT 'other', 'PAUSE', 7, 7, 'Fail', TRUE""")
def d7(spark, d):
    stop = [Rule("p1", "l_quantity > 49", "PAUSE", "cleaning"), Rule("p2", "l_quantity < 0", "PAUSE", "cleaning")]
    past = [
        {**rules.rule_summary_row(e, Rule(n, "", a, "cleaning"), 7, 7, NOW)}
        for e, n, a in (("lines", "p1", "PAUSE"), ("lines", "gone", "PAUSE"), ("lines", "old", "DELETE"), ("others", "other", "PAUSE"))
    ]
    earlier = spark.createDataFrame([tuple(r[c.split()[0]] for c in rules.SUMMARY.split(", ")) for r in past], rules.SUMMARY)
    out = rules.run_rules({"lines": _lines(spark, d)}, "lines", stop, KPIS, "cleaning", NOW, earlier)
    return out.summary.select("rule", "action", "no_original_rows", "affected_rows", "status", F.lit(out.paused).alias("paused"))


@query("d11_empty_table", "SELECT 'data_check' AS rule, 'REPORT' AS action, 0 AS no_original_rows, 1 AS affected_rows, 'Fail' AS status UNION ALL SELECT 'r', 'DELETE', 0, 0, 'Pass' UNION ALL SELECT 'full', 'DELETE', count(*), count(*) FILTER (l_quantity > 49), 'Fail' FROM lineitem")
def d11(spark, d):
    lines = _lines(spark, d)
    none = rules.run_rules({"t": lines.where("l_quantity < 0")}, "t", [Rule("r", "l_quantity > 49", "DELETE", "cleaning")], KPIS, now=NOW).summary
    full = rules.run_rules({"t": lines}, "t", [Rule("full", "l_quantity > 49", "DELETE", "cleaning")], KPIS, now=NOW).summary
    return none.unionByName(full).select("rule", "action", "no_original_rows", "affected_rows", "status")


@query("d9_aggregate_rule", "SELECT l_suppkey, sum(l_quantity) AS total, round(avg(l_extendedprice / l_quantity), 4) AS price FROM lineitem WHERE l_extendedprice / l_quantity * (1 - l_discount) > 1500 GROUP BY 1 HAVING sum(l_quantity) > 50 ORDER BY 1 LIMIT 100")
def d9(spark, d):
    return rules.aggregate_rule(_lines(spark, d), KPIS, "KPI_10 > 1500", ["l_suppkey"], ["KPI_2 AS total", "round(avg(KPI_1), 4) AS price"], "total > 50")


@query("d8_threshold", "SELECT count(*) FILTER (l_quantity > 40) * 100.0 / count(*) > 10 AS over_10, count(*) FILTER (l_quantity > 40) * 100.0 / count(*) > 90 AS over_90 FROM lineitem")
def d8(spark, d):
    lines = _lines(spark, d)
    return spark.createDataFrame([(rules.passes_threshold(lines, "l_quantity > 40", ">10%"), rules.passes_threshold(lines, "l_quantity > 40", ">90%"))], "over_10 boolean, over_90 boolean")


@query("d12_custom_check", "SELECT 'Fail' AS status, l_returnflag, count(*) AS n FROM lineitem WHERE l_discount > 0.09 GROUP BY 2")
def d12(spark, d):
    _lines(spark, d).createOrReplaceTempView("d12_lines")
    rows, status = rules.run_custom_check(spark, "SELECT l_returnflag, IF(l_discount > 0.09, 'STOP', 'OK') AS action FROM d12_lines", "STOP")
    return rows.groupBy(F.lit(status).alias("status"), "l_returnflag").agg(F.count("*").alias("n"))


@query("d13_parallel_checks", """SELECT 'negative balance' AS name, count(*) FILTER (c_acctbal < 0) AS bad, count(*) AS n FROM customer UNION ALL SELECT 'no customer', count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)), count(*) FROM orders
  UNION ALL SELECT 'large part', count(*) FILTER (p_size > 40), count(*) FROM part""")
def d13(spark, d):
    o, c = table(spark, d, "orders"), table(spark, d, "customer")

    def counted(df, cond):
        return tuple(df.agg(F.count_if(F.expr(cond)), F.count("*")).first())

    known = o.join(c.select(F.col("c_custkey").alias("o_custkey"), F.lit(True).alias("known")), "o_custkey", "left")
    checks = {
        "negative balance": lambda: counted(c, "c_acctbal < 0"), "no customer": lambda: counted(known, "known IS NULL"),
        "large part": lambda: counted(table(spark, d, "part"), "p_size > 40"),
    }
    found = rules.run_checks_parallel(list(checks.values()))
    return spark.createDataFrame([(n, *r) for n, r in zip(checks, found, strict=True)], "name string, bad long, n long")


@query("d14_rollup", f"""WITH {_SUMMED}, t AS (SELECT *, max(o) OVER () AS m FROM s)
  SELECT 'lines' AS "table", rule AS qc_name, action, m AS original_rows, x AS rows_affected, CAST(CASE WHEN action = 'DELETE' THEN m - sum(CASE WHEN action = 'DELETE' THEN x ELSE 0 END) OVER (ORDER BY o DESC, x, rule ROWS UNBOUNDED PRECEDING) ELSE m END AS BIGINT) AS remaining_rows,
  CASE WHEN x > 0 THEN 'Fail' ELSE 'Pass' END AS status FROM t""")
def d14(spark, d):
    return rules.qc_rollup([_outcome(spark, d).summary]).drop("per_rows_affected", "qc_description")


__all__ = ["QUERIES", "SQL", "inventory_master", "product_master", "store_master", "transaction_master", "with_entities"]
