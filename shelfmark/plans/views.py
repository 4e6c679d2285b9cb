"""The test tables as the entities that the operators work on, in Spark and as SQL for the oracle."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.joins import if_small
from shelfmark.operators.calendar import fiscal_calendar

FISCAL_START, CAL_START, CAL_END = date(2000, 2, 1), "1994-01-01", "2003-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def product_master(spark: SparkSession, d: str) -> DataFrame:
    size = F.when(F.col("p_size") <= 15, "small").when(F.col("p_size") <= 35, "medium").otherwise("large")
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("product_code"), F.col("p_type").alias("l0_name"), F.col("p_brand").alias("l1_name"), size.alias("l2_name"),
        F.col("p_retailprice").alias("price"), (F.col("p_partkey") % 10 != 0).alias("active"),
    )


def store_master(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = table(spark, d, "supplier"), table(spark, d, "nation"), table(spark, d, "region")
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("s_suppkey").cast("string").alias("store_code"), F.col("s_name").alias("store_name"), F.col("n_name").alias("store_type"), F.col("r_name").alias("channel")
    )


def transaction_master(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("date"), F.col("l_partkey").cast("string").alias("product_code"), F.col("l_suppkey").cast("string").alias("store_code"),
        F.col("l_orderkey").cast("string").alias("transaction_code"), F.col("l_quantity").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_discount").alias("discount"),
    )


def inventory_master(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("date"), "l_partkey", "l_suppkey")
    oh = (F.col("l_partkey") + 7 * F.col("l_suppkey") + F.dayofmonth("date")) % 60
    rows = rows.withColumn("oh", oh.cast("double"))
    key = F.col("l_partkey") + F.col("l_suppkey")
    both = rows.where(key % 5 != 0).unionByName(rows.where(key % 7 == 0).withColumn("date", F.date_add("date", 1)))
    return both.groupBy("date", F.col("l_partkey").cast("string").alias("product_code"), F.col("l_suppkey").cast("string").alias("store_code")).agg(F.max("oh").alias("oh"))


def product_store_mapping(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()
    return keys.select(
        F.col("l_partkey").cast("string").alias("product_code"), F.col("l_suppkey").cast("string").alias("store_code"),
        ((F.col("l_partkey") + F.col("l_suppkey")) % 10 != 0).alias("is_active"),
    )


def late(spark: SparkSession, d: str) -> DataFrame:
    """Sales, with returns after the last sale and sales of a store that nobody knows after that."""
    rows = transaction_master(spark, d)
    end = rows.where("date > DATE '2001-06-01' AND cast(product_code as bigint) % 20 = 0")
    back = end.withColumn("date", F.date_add("date", 170)).withColumn("qty", -F.col("qty"))
    unknown = end.withColumn("date", F.date_add("date", 260)).withColumn("store_code", F.lit("closed"))
    return rows.unionByName(back).unionByName(unknown)


def late_stock(spark: SparkSession, d: str) -> DataFrame:
    """Stock, some of it counted long after the last sale."""
    rows = inventory_master(spark, d)
    return rows.unionByName(rows.where("date > DATE '2001-06-01' AND cast(product_code as bigint) % 10 = 0").withColumn("date", F.date_add("date", 150)))


def store_clustering(spark: SparkSession, d: str) -> DataFrame:
    label = F.col("store_code").cast("long") % 3
    return store_master(spark, d).select("store_code", "channel", label.cast("string").alias("labels"), F.concat_ws("-", "channel", label.cast("string")).alias("cluster_name"))


def calendar(spark: SparkSession, d: str) -> DataFrame:
    return fiscal_calendar(spark, FISCAL_START, CAL_START, CAL_END)


def folded(spark: SparkSession, d: str) -> DataFrame:
    """Sales and stock of brand and type, so that windows hold many rows: one row per date, product and store."""
    p = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("product_code"), F.concat_ws(".", "p_brand", "p_type").alias("fold"), F.col("p_type").alias("l0_name"))
    t = transaction_master(spark, d).join(p, "product_code").groupBy("date", F.col("fold").alias("product_code"), "l0_name", "store_code")
    # a price that is missing on some days, a discount likewise
    day = F.dayofmonth("date")
    rows = t.agg(F.sum("qty").alias("qty"), F.round(F.avg("price") + 1e-7, 4).alias("price"), F.round(F.avg("discount") + 1e-7, 4).alias("discount"))
    inv = (F.col("store_code").cast("long") * 7 + day * 3 + F.length("product_code")) % 12
    return (
        rows.withColumn("inventory", F.when(inv < 4, 0.0).otherwise(F.col("qty") + inv))
        .withColumn("qty", F.when(inv == 1, 0.0).otherwise(F.col("qty")))
        .withColumn("price", F.when(day % 4 == 0, None).otherwise(F.col("price")))
        .withColumn("discount", F.when(day % 3 == 0, None).otherwise(F.col("discount")))
        .join(if_small(store_master(spark, d).select("store_code", "channel")), "store_code")
        .join(F.broadcast(calendar(spark, d).select("date", "fiscal_year_week")), "date")
    )


#: The same entities for the oracle: name -> (entities it needs, SQL).
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "product_master": ((), """SELECT CAST(p_partkey AS VARCHAR) AS product_code, p_type AS l0_name, p_brand AS l1_name,
        CASE WHEN p_size <= 15 THEN 'small' WHEN p_size <= 35 THEN 'medium' ELSE 'large' END AS l2_name, p_retailprice AS price, p_partkey % 10 <> 0 AS active FROM part"""),
    "store_master": ((), """SELECT CAST(s_suppkey AS VARCHAR) AS store_code, s_name AS store_name, n_name AS store_type, r_name AS channel
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "transaction_master": ((), """SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_partkey AS VARCHAR) AS product_code, CAST(l_suppkey AS VARCHAR) AS store_code,
        CAST(l_orderkey AS VARCHAR) AS transaction_code, l_quantity AS qty, l_extendedprice / l_quantity AS price, l_discount AS discount FROM lineitem"""),
    "inventory_master": ((), """SELECT date, CAST(p AS VARCHAR) AS product_code, CAST(s AS VARCHAR) AS store_code, max(oh) AS oh FROM (
        SELECT CAST(l_shipdate AS DATE) AS date, l_partkey AS p, l_suppkey AS s, CAST((l_partkey + 7 * l_suppkey + day(l_shipdate)) % 60 AS DOUBLE) AS oh FROM lineitem WHERE (l_partkey + l_suppkey) % 5 <> 0
        UNION ALL SELECT CAST(l_shipdate AS DATE) + 1, l_partkey, l_suppkey, CAST((l_partkey + 7 * l_suppkey + day(l_shipdate)) % 60 AS DOUBLE) FROM lineitem WHERE (l_partkey + l_suppkey) % 7 = 0) GROUP BY 1, 2, 3"""),
    "late": (("transaction_master",), """SELECT * FROM transaction_master UNION ALL SELECT * REPLACE (date + 170 AS date, -qty AS qty) FROM transaction_master WHERE date > DATE '2001-06-01' AND CAST(product_code AS BIGINT) % 20 = 0
        UNION ALL SELECT * REPLACE (date + 260 AS date, 'closed' AS store_code) FROM transaction_master WHERE date > DATE '2001-06-01' AND CAST(product_code AS BIGINT) % 20 = 0"""),
    "late_stock": (("inventory_master",), """SELECT * FROM inventory_master UNION ALL SELECT * REPLACE (date + 150 AS date) FROM inventory_master WHERE date > DATE '2001-06-01' AND CAST(product_code AS BIGINT) % 10 = 0"""),
    "product_store_mapping": ((), """SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS product_code, CAST(l_suppkey AS VARCHAR) AS store_code, (l_partkey + l_suppkey) % 10 <> 0 AS is_active FROM lineitem"""),
    "store_clustering": (("store_master",), """SELECT store_code, channel, CAST(CAST(store_code AS BIGINT) % 3 AS VARCHAR) AS labels, channel || '-' || (CAST(store_code AS BIGINT) % 3) AS cluster_name FROM store_master"""),
    "cal_fields": ((), f"""SELECT CAST(c + INTERVAL 31 DAY AS DATE) AS date, CAST(year(c) AS INTEGER) AS fiscal_year, CAST(quarter(c) AS INTEGER) AS fiscal_quarter, CAST(month(c) AS INTEGER) AS m,
        CAST(strftime(c, '%U') AS INTEGER) + 1 AS fiscal_week, CAST(day(c) AS INTEGER) AS fiscal_day
        FROM (SELECT CAST(unnest(generate_series(DATE '{CAL_START}', DATE '{CAL_END}' - 31, INTERVAL 1 DAY)) AS DATE) AS c)"""),
    "calendar": (("cal_fields",), """SELECT date, fiscal_year, fiscal_quarter, fiscal_month, fiscal_week, fiscal_day, fiscal_year * 100 + fiscal_week AS fiscal_year_week, fiscal_year * 100 + m AS fiscal_year_month,
        fiscal_year * 100 + fiscal_quarter AS fiscal_year_quarter, CASE WHEN fiscal_week <= 50 THEN CAST(ceil(fiscal_week / 2.0) AS INTEGER) ELSE 26 END AS bi_week
        FROM cal_fields JOIN (SELECT fiscal_year, fiscal_week, m AS fiscal_month FROM (SELECT fiscal_year, fiscal_week, m, row_number() OVER (PARTITION BY fiscal_year, fiscal_week ORDER BY count(*) DESC, m DESC) AS rn
        FROM cal_fields GROUP BY 1, 2, 3) WHERE rn = 1) USING (fiscal_year, fiscal_week)"""),
    "folded": (("transaction_master", "store_master", "calendar"), """SELECT date, product_code, l0_name, store_code, CASE WHEN i = 1 THEN 0.0 ELSE q END AS qty,
        CASE WHEN day(date) % 4 = 0 THEN NULL ELSE pr END AS price, CASE WHEN day(date) % 3 = 0 THEN NULL ELSE di END AS discount, CASE WHEN i < 4 THEN 0.0 ELSE q + i END AS inventory, channel, fiscal_year_week
        FROM (SELECT *, (CAST(store_code AS BIGINT) * 7 + day(date) * 3 + length(product_code)) % 12 AS i FROM (
            SELECT t.date, p_brand || '.' || p_type AS product_code, p_type AS l0_name, t.store_code, sum(qty) AS q, round(avg(t.price) + 1e-7, 4) AS pr, round(avg(t.discount) + 1e-7, 4) AS di
            FROM transaction_master t JOIN part ON t.product_code = CAST(p_partkey AS VARCHAR) GROUP BY 1, 2, 3, 4))
        JOIN store_master USING (store_code) JOIN calendar USING (date)"""),
}


def with_entities(names: list[str], body: str, more: dict[str, str] | None = None) -> str:
    """``body`` with the entities it needs as common table expressions."""
    order: list[str] = []

    def need(n: str) -> None:
        for x in SQL[n][0]:
            need(x)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    parts = [f"{n} AS ({SQL[n][1]})" for n in order] + [f"{n} AS ({s})" for n, s in (more or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
