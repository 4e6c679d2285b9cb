"""Registered queries of the calendar, master table, imputation, splits, aggregates, preparation, clusters and streams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from shelfmark.functions.joins import if_small
from shelfmark.functions.scratch import scratch_path, staged
from shelfmark.operators import aggregate, calendar, clustering, hierarchy, imputation, master, prep, splits
from shelfmark.plans import views
from shelfmark.plans.specs import ColumnMapping, DerivedSpec, EntitySpec, Feature, Rule
from shelfmark.plans.views import table, with_entities
from shelfmark.streaming import landing

QUERIES: dict = {}
SQL: dict[str, str] = {}
LEVELS = ["l0_name", "l1_name", "l2_name"]


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return register


# --- calendar and hierarchies

@query("e1_fiscal_calendar", with_entities(["calendar", "transaction_master"], """SELECT c.*, t.n FROM calendar c JOIN (SELECT date, count(*) AS n FROM transaction_master GROUP BY 1) t USING (date)"""))
def e1(spark, d):
    n = views.transaction_master(spark, d).groupBy("date").agg(F.count("*").alias("n"))
    return views.calendar(spark, d).join(n, "date")


@query("e2_week_bounds", with_entities(["calendar", "transaction_master"], """SELECT fiscal_year_week, min_date, max_date, count(*) AS n FROM transaction_master JOIN calendar USING (date)
  JOIN (SELECT fiscal_year_week, min(date) AS min_date, max(date) AS max_date FROM calendar GROUP BY 1) USING (fiscal_year_week) GROUP BY 1, 2, 3"""))
def e2(spark, d):
    c = views.calendar(spark, d)
    weeks = views.transaction_master(spark, d).join(F.broadcast(c.select("date", "fiscal_year_week")), "date")
    return weeks.groupBy("fiscal_year_week").agg(F.count("*").alias("n")).join(calendar.week_bounds(c), "fiscal_year_week")


@query("e3_due_stores", with_entities(["calendar", "transaction_master", "store_master"], "SELECT channel, date, coalesce(fiscal_day % 2 = 0, FALSE) AS due FROM (SELECT channel, max(date) AS date FROM transaction_master JOIN store_master USING (store_code) GROUP BY 1) LEFT JOIN calendar USING (date)"))
def e3(spark, d):
    c = views.calendar(spark, d)
    last = views.transaction_master(spark, d).join(views.store_master(spark, d).select("store_code", "channel"), "store_code").groupBy("channel").agg(F.max("date").alias("date"))
    # a row per channel
    rows = [(r["channel"], r["date"], calendar.is_due(c, r["date"], "fiscal_day % 2 = 0")) for r in last.collect()]
    return spark.createDataFrame(rows, "channel string, date date, due boolean")


@query("e4_levels", with_entities(["product_master"], "SELECT 'l1_name' AS up_to, 'l0_name,l1_name' AS levels, count(*) AS n FROM (SELECT DISTINCT l0_name, l1_name FROM product_master) UNION ALL SELECT 'product_code', 'l0_name,l1_name,l2_name,product_code', count(*) FROM (SELECT DISTINCT l0_name, l1_name, l2_name, product_code FROM product_master)"))
def e4(spark, d):
    products, out = views.product_master(spark, d), []
    for level in ("l1_name", "product_code"):
        cols = hierarchy.levels_up_to(products.columns, level)
        out.append(products.select(*cols).distinct().agg(F.lit(level).alias("up_to"), F.lit(",".join(cols)).alias("levels"), F.count("*").alias("n")))
    return out[0].unionByName(out[1])


@query("h1_hierarchies", with_entities(["product_master"], """SELECT substr(sha256(concat_ws('|', l0_name, l1_name, l2_name, product_code)), 1, 16) AS hierarchy_code, level, active, l0_name, l1_name, l2_name, product_code FROM (
  SELECT 1 AS level, bool_or(active) AS active, l0_name, CAST(NULL AS VARCHAR) AS l1_name, CAST(NULL AS VARCHAR) AS l2_name, CAST(NULL AS VARCHAR) AS product_code FROM product_master GROUP BY l0_name
  UNION ALL SELECT 2, bool_or(active), l0_name, l1_name, NULL, NULL FROM product_master GROUP BY l0_name, l1_name
  UNION ALL SELECT 3, bool_or(active), l0_name, l1_name, l2_name, NULL FROM product_master GROUP BY l0_name, l1_name, l2_name
  UNION ALL SELECT 4, bool_or(active), l0_name, l1_name, l2_name, product_code FROM product_master GROUP BY l0_name, l1_name, l2_name, product_code)"""))
def h1(spark, d):
    return hierarchy.flatten_hierarchies(views.product_master(spark, d), LEVELS)


@query("e30_deepest_level", with_entities(["product_master"], "SELECT substr(sha256(concat_ws('|', l0_name, l1_name, l2_name, product_code)), 1, 16) AS hierarchy_code, product_code FROM product_master"))
def e30(spark, d):
    return hierarchy.deepest_level(hierarchy.flatten_hierarchies(views.product_master(spark, d), LEVELS)).select("hierarchy_code", "product_code")


# --- master

_KEYS = ["date", "product_code", "store_code"]
_FEATURES = {
    "inventory": [Feature("inventory", "max(oh)")],
    "transactions": [Feature("qty", "sum(qty)"), Feature("price", "round(avg(price) + 1e-7, 4)")],
}


def _master(spark, d, since=None):
    c = views.calendar(spark, d).select("date", "fiscal_year_week")
    dims = {
        "store": (views.store_master(spark, d).select("store_code", "channel"), ["store_code"]), "product": (views.product_master(spark, d).select("product_code", *LEVELS), ["product_code"]),
        "calendar": (F.broadcast(c), ["date"]),
    }
    return master.build_master(
        views.inventory_master(spark, d), views.transaction_master(spark, d), dims, _FEATURES, _KEYS, since=since, derived=[Feature("revenue", "round(qty * price, 4)")]
    )


def _master_sql(since: str = "") -> str:
    return f"""SELECT date, product_code, store_code, coalesce(qty, 0.0) AS qty, coalesce(CASE WHEN inv < coalesce(qty, 0.0) THEN coalesce(qty, 0.0) WHEN inv < 0 THEN 0.0 ELSE inv END, coalesce(qty, 0.0)) AS inventory, t.price,
  channel, l0_name, l1_name, l2_name, fiscal_year_week, round(coalesce(qty, 0.0) * t.price, 4) AS revenue
  FROM (SELECT date, product_code, store_code, max(oh) AS inv FROM inventory_master {since} GROUP BY 1, 2, 3)
  FULL JOIN (SELECT date, product_code, store_code, sum(qty) AS qty, round(avg(price) + 1e-7, 4) AS price FROM transaction_master {since} GROUP BY 1, 2, 3) t USING (date, product_code, store_code)
  LEFT JOIN store_master USING (store_code) LEFT JOIN (SELECT product_code, l0_name, l1_name, l2_name FROM product_master) USING (product_code) LEFT JOIN (SELECT date, fiscal_year_week FROM calendar) USING (date)"""


_ENTITIES = ["inventory_master", "transaction_master", "store_master", "product_master", "calendar"]


@query("e5_master", with_entities(_ENTITIES, _master_sql()))
def e5(spark, d):
    return _master(spark, d)


@query("e6_master_periodic", with_entities(_ENTITIES, _master_sql("WHERE date > DATE '2001-01-01'")))
def e6(spark, d):
    return _master(spark, d, date(2001, 1, 1))


# --- imputation

_CUT = {"AFRICA": (0.2, 0.1), "AMERICA": (0.1, 0.5), "ASIA": (0.3, 0.2)}
_CUT_SQL = "cutoffs AS (SELECT * FROM (VALUES ('AFRICA', 0.2, 0.1), ('AMERICA', 0.1, 0.5), ('ASIA', 0.3, 0.2)) v(channel, a_cut, s_cut))"


def _attached(spark, d):
    return imputation.attach_clusters(views.folded(spark, d), views.store_clustering(spark, d), ["channel"])


def _signals(spark, d):
    return imputation.stock_signals(_attached(spark, d), ["channel"])


_SIGNALS = """sized AS (SELECT channel, cluster_name, count(DISTINCT store_code) AS total_stores_cluster FROM store_clustering GROUP BY 1, 2),
  attached AS (SELECT f.*, cluster_name, total_stores_cluster FROM folded f LEFT JOIN (SELECT DISTINCT store_code, channel, cluster_name FROM store_clustering) USING (store_code, channel) LEFT JOIN sized USING (channel, cluster_name)),
  weekly AS (SELECT channel, cluster_name, product_code, fiscal_year_week, count(DISTINCT CASE WHEN qty <> 0 THEN store_code END) AS active_stores, sum(qty) AS weekly_qty FROM attached GROUP BY 1, 2, 3, 4),
  daily AS (SELECT channel, cluster_name, product_code, fiscal_year_week, max(x) AS max_daily_inventory FROM (SELECT channel, cluster_name, product_code, fiscal_year_week, date, sum(inventory) AS x FROM attached GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4),
  signals AS (SELECT *, CASE WHEN inventory = 0 THEN 1 ELSE 0 END AS oos_flag, coalesce(round(active_stores / nullif(total_stores_cluster, 0) + 1e-9, 2), 0.0) AS active_stores_ratio,
    coalesce(round(weekly_qty / nullif(max_daily_inventory, 0) + 1e-9, 2), 0.0) AS sell_through_ratio FROM attached JOIN weekly USING (channel, cluster_name, product_code, fiscal_year_week) JOIN daily USING (channel, cluster_name, product_code, fiscal_year_week))"""


def _with(body: str, *ctes: str) -> str:
    return with_entities(["folded", "store_clustering"], "", None).rstrip() + ",\n" + ",\n".join((_SIGNALS, *ctes)) + "\n" + body


_KEY4 = ["channel", "product_code", "store_code", "date"]


@query("e7_e8_stock_signals", _with("SELECT channel, product_code, store_code, date, cluster_name, total_stores_cluster, oos_flag, active_stores, weekly_qty, active_stores_ratio, sell_through_ratio FROM signals"))
def e78(spark, d):
    return _signals(spark, d).select(*_KEY4, "cluster_name", "total_stores_cluster", "oos_flag", "active_stores", "weekly_qty", "active_stores_ratio", "sell_through_ratio")


def _first(c: str, when: str) -> str:
    v = f"CASE WHEN {when} THEN {c} END"
    return (f"coalesce(avg({v}) OVER (PARTITION BY channel, cluster_name, product_code, date), avg({v}) OVER (PARTITION BY channel, cluster_name, product_code, fiscal_year_week), "
            f"avg({v}) OVER (PARTITION BY channel, product_code, fiscal_year_week))")  # fmt: skip


_PRICED = f"""priced AS (SELECT *, {_first('price', 'qty <> 0')} AS price_first, {_first('discount', 'TRUE')} AS discount_first FROM signals)"""


def _estimated(spark, d):
    return imputation.first_estimates(_attached(spark, d), ["channel"], ["price"], ["discount"])


@query("e10_first_estimates", _with("""SELECT channel, product_code, store_code, date, round(price_first + 1e-7, 4) AS price_first_imputed, coalesce(price, round(price_first + 1e-7, 2)) AS price_imputed,
  coalesce(discount, round(discount_first + 1e-7, 2)) AS discount_imputed FROM priced""", _PRICED))
def e10(spark, d):
    return _estimated(spark, d).select(*_KEY4, F.round(F.col("price_first_imputed") + 1e-7, 4).alias("price_first_imputed"), "price_imputed", "discount_imputed")


def _cutoffs(spark):
    return spark.createDataFrame([(k, *v) for k, v in _CUT.items()], "channel string, active_stores_cutoff double, sell_through_cutoff double")


def _quantities(spark, d):
    return imputation.impute_quantity(_estimated(spark, d), ["channel"], "qty", "inventory", _cutoffs(spark))


_QUANTITIES = _CUT_SQL + ", " + _PRICED + """, est AS (SELECT *, avg(CASE WHEN inventory > 0 THEN qty END) OVER (PARTITION BY channel, cluster_name, product_code, date) AS first FROM priced),
  quantities AS (SELECT *, CASE WHEN imp = qty THEN 0 ELSE 1 END AS imputation_flag FROM (SELECT e.*, coalesce(price, round(price_first + 1e-7, 2)) AS price_imputed, coalesce(discount, round(discount_first + 1e-7, 2)) AS discount_imputed,
    CASE WHEN oos_flag = 1 AND active_stores_ratio >= a_cut AND sell_through_ratio >= s_cut AND qty > first THEN round(qty) WHEN oos_flag = 1 AND active_stores_ratio >= a_cut AND sell_through_ratio >= s_cut AND qty < first THEN round(first) ELSE qty END AS imp
    FROM est e LEFT JOIN cutoffs USING (channel)))"""


@query("e9_e11_quantities", _with("SELECT channel, product_code, store_code, date, imp AS qty_imputed, imputation_flag FROM quantities", _QUANTITIES))
def e911(spark, d):
    return _quantities(spark, d).select(*_KEY4, "qty_imputed", "imputation_flag")


def _mean_sql(h: str, g: str, name: str) -> str:
    return f"m_{name} AS (SELECT {h}, channel, {g}, sum(discount_imputed * inventory) / nullif(sum(inventory), 0) AS v_{name} FROM quantities GROUP BY 1, 2, 3)"


@query("e12_discounts", _with("""SELECT q.channel, q.product_code, q.store_code, q.date, round(coalesce(discount_imputed, v_a, v_b, v_c, v_d) + 1e-9, 6) AS discount_imputed FROM quantities q
  LEFT JOIN m_a USING (product_code, channel, date) LEFT JOIN m_b USING (product_code, channel, fiscal_year_week) LEFT JOIN m_c USING (l0_name, channel, date) LEFT JOIN m_d USING (l0_name, channel, fiscal_year_week)""",
  _QUANTITIES, _mean_sql("product_code", "date", "a"), _mean_sql("product_code", "fiscal_year_week", "b"), _mean_sql("l0_name", "date", "c"), _mean_sql("l0_name", "fiscal_year_week", "d")))
def e12(spark, d):
    rows = imputation.impute_discounts(_quantities(spark, d), ["product_code", "l0_name"], ["channel"], ["discount"], "inventory")
    return rows.select(*_KEY4, F.round(F.col("discount_imputed") + 1e-9, 6).alias("discount_imputed"))


def _fold_products(spark, d):
    part = table(spark, d, "part").groupBy(F.concat_ws(".", "p_brand", "p_type").alias("product_code")).agg(F.min("p_size").alias("size"), F.max("p_retailprice").alias("top"))
    return part


_FILLED = _QUANTITIES + """, products AS (SELECT p_brand || '.' || p_type AS product_code, min(p_size) AS size, max(p_retailprice) AS top FROM part GROUP BY 1),
  formula AS (SELECT q.*, coalesce(price_imputed, CASE WHEN size > 2 THEN NULL ELSE round(top, 2) END) AS p1 FROM quantities q LEFT JOIN products USING (product_code)),
  filled AS (SELECT *, coalesce(p1, last_value(p1 IGNORE NULLS) OVER (PARTITION BY product_code, channel ORDER BY date, store_code ROWS UNBOUNDED PRECEDING),
    first_value(p1 IGNORE NULLS) OVER (PARTITION BY product_code, channel ORDER BY date, store_code ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p2 FROM formula)"""


def _filled(spark, d):
    return imputation.fill_prices(_quantities(spark, d), _fold_products(spark, d), {"price": "if(size > 2, null, round(top, 2))"}, ["channel"])


@query("e13_prices", _with("SELECT channel, product_code, store_code, date, p2 AS price_imputed FROM filled", _FILLED))
def e13(spark, d):
    return _filled(spark, d).select(*_KEY4, "price_imputed")


_MEANS = [_mean_sql("product_code", "date", "a"), _mean_sql("product_code", "fiscal_year_week", "b"), _mean_sql("l0_name", "date", "c"), _mean_sql("l0_name", "fiscal_year_week", "d")]


@query("e14_lost_sales", _with("""SELECT channel, product_code, store_code, date, inventory, lost_sales, max(inventory) OVER (PARTITION BY product_code, store_code, fiscal_year_week) AS max_week_inventory, price_imputed, discount_imputed FROM (
  SELECT f.channel, f.product_code, f.store_code, f.date, f.fiscal_year_week, CASE WHEN inventory <= imp THEN imp ELSE inventory END AS inventory, imp - qty AS lost_sales, p2 AS price_imputed,
    round(coalesce(discount_imputed, v_a, v_b, v_c, v_d) + 1e-9, 6) AS discount_imputed FROM filled f LEFT JOIN m_a ON f.product_code = m_a.product_code AND f.channel = m_a.channel AND f.date = m_a.date
    LEFT JOIN m_b ON f.product_code = m_b.product_code AND f.channel = m_b.channel AND f.fiscal_year_week = m_b.fiscal_year_week LEFT JOIN m_c ON f.l0_name = m_c.l0_name AND f.channel = m_c.channel AND f.date = m_c.date
    LEFT JOIN m_d ON f.l0_name = m_d.l0_name AND f.channel = m_d.channel AND f.fiscal_year_week = m_d.fiscal_year_week)""", _FILLED, *_MEANS))
def e14(spark, d):
    rows = imputation.impute_lost_sales(
        views.folded(spark, d), views.store_clustering(spark, d), _cutoffs(spark), _fold_products(spark, d), ["channel"], ["product_code", "l0_name"],
        {"price": "if(size > 2, null, round(top, 2))"}, ["discount"],
    )
    return rows.select(*_KEY4, "inventory", "lost_sales", "max_week_inventory", "price_imputed", F.round(F.col("discount_imputed") + 1e-9, 6).alias("discount_imputed"))


_OWN_LOST_SALES = """SELECT m.*, if(m.inventory = 0, greatest(m.qty, e.mean_qty), m.qty) AS qty_imputed, if(m.inventory = 0, greatest(m.qty, e.mean_qty), m.qty) - m.qty AS lost_sales,
  coalesce(m.price, e.top_price) AS price_imputed, coalesce(m.discount, 0.0) AS discount_imputed
  FROM {master} m LEFT JOIN (SELECT channel, product_code, round(avg(qty) + 1e-7, 3) AS mean_qty, max(price) AS top_price FROM {master} GROUP BY 1, 2) e USING (channel, product_code)"""


@query("e14_own_query", with_entities(["folded"], """SELECT channel, product_code, store_code, date, CASE WHEN inventory = 0 THEN greatest(qty, mean_qty) ELSE qty END AS qty_imputed,
  CASE WHEN inventory = 0 THEN greatest(qty, mean_qty) ELSE qty END - qty AS lost_sales, coalesce(price, top_price) AS price_imputed
  FROM folded LEFT JOIN (SELECT channel, product_code, round(avg(qty) + 1e-7, 3) AS mean_qty, max(price) AS top_price FROM folded GROUP BY 1, 2) USING (channel, product_code)"""))
def e14o(spark, d):
    rows = imputation.impute_lost_sales(
        staged(views.folded(spark, d), "master"), views.store_clustering(spark, d), _cutoffs(spark), _fold_products(spark, d), ["channel"], ["product_code", "l0_name"], {"price": ""}, ["discount"],
        override=_OWN_LOST_SALES,
    )
    return rows.select(*_KEY4, "qty_imputed", "lost_sales", "price_imputed")


# --- splits

_SPLIT = """base AS (SELECT m.product_code, m.store_code, channel, l0_name, l1_name, l2_name FROM product_store_mapping m JOIN store_master USING (store_code) JOIN product_master USING (product_code) WHERE is_active),
  weeks AS (SELECT date, dense_rank() OVER (ORDER BY fiscal_year_week) AS week_no FROM calendar),
  final_sale AS (SELECT max(date) AS last, max(week_no) AS last_week FROM late JOIN store_master USING (store_code) LEFT JOIN weeks USING (date) WHERE qty > 0),
  sold AS (SELECT product_code, store_code, sum(qty) AS sales_art FROM late, final_sale WHERE qty > 0 AND date BETWEEN last - 55 AND last GROUP BY 1, 2),
  held AS (SELECT product_code, store_code, max(oh) AS oh FROM late_stock JOIN weeks USING (date), final_sale WHERE oh > 0 AND week_no BETWEEN last_week - 8 AND last_week GROUP BY 1, 2),
  s0 AS (SELECT base.*, coalesce(sales_art, 0.0) AS a, cluster_name FROM base LEFT JOIN sold USING (product_code, store_code) LEFT JOIN (SELECT store_code, channel, cluster_name FROM store_clustering) USING (store_code, channel)),
  s1 AS (SELECT *, sum(a) OVER (PARTITION BY channel, store_code, l0_name) AS h1, sum(a) OVER (PARTITION BY channel, store_code, l0_name, l1_name) AS h2, sum(a) OVER (PARTITION BY channel, store_code, l0_name, l1_name, l2_name) AS h3 FROM s0),
  s2 AS (SELECT * REPLACE (CASE WHEN a = 0 THEN avg(nullif(a, 0)) OVER (PARTITION BY channel, l0_name, l1_name, l2_name, product_code, cluster_name) ELSE a END AS a,
    CASE WHEN h1 = 0 THEN avg(nullif(h1, 0)) OVER (PARTITION BY channel, l0_name, cluster_name) ELSE h1 END AS h1, CASE WHEN h2 = 0 THEN avg(nullif(h2, 0)) OVER (PARTITION BY channel, l0_name, l1_name, cluster_name) ELSE h2 END AS h2,
    CASE WHEN h3 = 0 THEN avg(nullif(h3, 0)) OVER (PARTITION BY channel, l0_name, l1_name, l2_name, cluster_name) ELSE h3 END AS h3) FROM s1),
  s3 AS (SELECT product_code, store_code, channel, l0_name, l1_name, l2_name, coalesce(a / nullif(sum(a) OVER w, 0), 0.0) AS store_split, coalesce(h1 / nullif(sum(h1) OVER w, 0), 0.0) AS r1, coalesce(h2 / nullif(sum(h2) OVER w, 0), 0.0) AS r2,
    coalesce(h3 / nullif(sum(h3) OVER w, 0), 0.0) AS r3 FROM s2 WINDOW w AS (PARTITION BY channel, product_code))"""
_SPLIT_ENTITIES = ["product_store_mapping", "store_master", "product_master", "late", "late_stock", "calendar", "store_clustering"]


def _split_sql(body: str, *more: str) -> str:
    return with_entities(_SPLIT_ENTITIES, "").rstrip() + ",\n" + ",\n".join((_SPLIT, *more)) + "\n" + body


def _base(spark, d):
    base = splits.split_base(views.store_master(spark, d), views.product_master(spark, d), views.product_store_mapping(spark, d))
    sold = splits.recent_sales(views.late(spark, d), views.store_master(spark, d))
    named = views.store_clustering(spark, d).select("store_code", "channel", "cluster_name")
    base = base.join(sold, ["product_code", "store_code"], "left").withColumn("sales_art_store", F.coalesce("sales_art", F.lit(0.0))).drop("sales_art")
    return base.join(if_small(named), ["store_code", "channel"], "left")


@query("e15_split_base", _split_sql("SELECT * FROM base"))
def e15(spark, d):
    return splits.split_base(views.store_master(spark, d), views.product_master(spark, d), views.product_store_mapping(spark, d))


@query("e16_recent_sales", _split_sql("SELECT product_code, store_code, sales_art FROM sold"))
def e16(spark, d):
    return splits.recent_sales(views.late(spark, d), views.store_master(spark, d))


@query("e17_recent_inventory", _split_sql("SELECT * FROM held"))
def e17(spark, d):
    return splits.recent_inventory(views.late_stock(spark, d), views.late(spark, d), views.store_master(spark, d), views.calendar(spark, d))


@query("e18_prefix_sales", _split_sql("SELECT product_code, store_code, a AS sales_art_store, h1 AS r_h1_store, h2 AS r_h2_store, h3 AS r_h3_store FROM s1"))
def e18(spark, d):
    return splits.prefix_sales(_base(spark, d), LEVELS).select("product_code", "store_code", "sales_art_store", "r_h1_store", "r_h2_store", "r_h3_store")


@query("e19_e20_proportions", _split_sql("SELECT product_code, store_code, round(store_split, 6) AS store_split, round(r1, 6) AS r_store_split_h1, round(r2, 6) AS r_store_split_h2, round(r3, 6) AS r_store_split_h3 FROM s3"))
def e1920(spark, d):
    shares = splits.proportions(splits.fill_zero_sales(_base(spark, d), LEVELS), LEVELS)
    return shares.select("product_code", "store_code", *[F.round(c, 6).alias(c) for c in ("store_split", "r_store_split_h1", "r_store_split_h2", "r_store_split_h3")])


_CHOSEN = """s4 AS (SELECT *, CASE WHEN sum(CASE WHEN r3 = 0 THEN 1 ELSE 0 END) OVER w / count(*) OVER w <= 0.05 THEN r3 WHEN sum(CASE WHEN r2 = 0 THEN 1 ELSE 0 END) OVER w / count(*) OVER w <= 0.05 THEN r2 ELSE r1 END AS overall
  FROM s3 WINDOW w AS (PARTITION BY l0_name, l1_name, l2_name, channel))"""


@query("e21_chosen_level", _split_sql("SELECT product_code, store_code, round(overall, 6) AS overall_proportion FROM s4", _CHOSEN))
def e21(spark, d):
    shares = splits.proportions(splits.fill_zero_sales(_base(spark, d), LEVELS), LEVELS)
    return splits.choose_level(shares, LEVELS, "l2_name").select("product_code", "store_code", F.round("overall_proportion", 6).alias("overall_proportion"))


@query("e22_store_split", _split_sql("""SELECT store_code, channel, l0_name, l1_name, l2_name, substr(sha256(concat_ws('|', l0_name, l1_name, l2_name)), 1, 16) AS hierarchy_code,
  round(CASE WHEN t IS NULL OR abs(t - 1) > 1e-6 THEN 1.0 / n ELSE x END + 1e-9, 6) AS store_split FROM (SELECT *, sum(x) OVER (PARTITION BY l0_name, l1_name, l2_name, channel) AS t, count(*) OVER (PARTITION BY l0_name, l1_name, l2_name, channel) AS n FROM (
  SELECT l0_name, l1_name, l2_name, store_code, channel, c / nullif(sum(c) OVER (PARTITION BY l0_name, l1_name, l2_name, channel), 0) AS x FROM (SELECT l0_name, l1_name, l2_name, store_code, channel, sum(overall) AS c FROM s4 GROUP BY 1, 2, 3, 4, 5)))""", _CHOSEN))
def e22(spark, d):
    products = views.product_master(spark, d)
    out = splits.store_split(
        views.store_master(spark, d), products, views.product_store_mapping(spark, d), views.late(spark, d), views.store_clustering(spark, d),
        hierarchy.flatten_hierarchies(products, LEVELS), "l2_name",
    )
    return out.withColumn("store_split", F.round(F.col("store_split") + 1e-9, 6))


@query("e23_day_split", with_entities(["transaction_master", "store_master", "product_master", "calendar"], """, rows_ AS (SELECT channel, l0_name, l1_name, dayofweek(date) + 1 AS dayofweek, qty FROM transaction_master JOIN store_master USING (store_code) JOIN product_master USING (product_code)
    WHERE qty > 0 AND date BETWEEN DATE '2000-01-01' AND DATE '2000-12-30' AND NOT (month(date) = 12 AND day(date) <> 1)),
  by_day AS (SELECT channel, l0_name, l1_name, dayofweek, sum(qty) AS q FROM rows_ GROUP BY 1, 2, 3, 4), ratio AS (SELECT *, q / nullif(sum(q) OVER (PARTITION BY channel, l0_name, l1_name), 0) AS r FROM by_day),
  ch AS (SELECT channel, dayofweek, sum(q) / sum(sum(q)) OVER (PARTITION BY channel) AS cr FROM by_day GROUP BY 1, 2),
  grid AS (SELECT * FROM (SELECT DISTINCT l0_name, l1_name FROM product_master), (SELECT DISTINCT channel FROM transaction_master JOIN store_master USING (store_code)), (SELECT DISTINCT dayofweek(date) + 1 AS dayofweek FROM calendar))
  SELECT channel, l0_name, l1_name, CAST(dayofweek AS INTEGER) AS dayofweek, substr(sha256(concat_ws('|', l0_name, l1_name)), 1, 16) AS hierarchy_code, round(x / nullif(sum(x) OVER (PARTITION BY channel, l0_name, l1_name), 0), 6) AS day_split
  FROM (SELECT g.*, coalesce(r, cr) AS x FROM grid g LEFT JOIN ratio USING (channel, l0_name, l1_name, dayofweek) LEFT JOIN ch USING (channel, dayofweek))""").replace("\n, rows_", ",\nrows_"))  # fmt: skip
def e23(spark, d):
    products = views.product_master(spark, d)
    sold = views.transaction_master(spark, d).join(views.store_master(spark, d).select("store_code", "channel"), "store_code").join(products.select("product_code", *LEVELS), "product_code")
    event = F.when(F.dayofmonth("date") == 1, None).when(F.month("date") == 12, 1).otherwise(0)
    out = splits.day_split(
        sold.withColumn("holiday", event), products, views.calendar(spark, d), hierarchy.flatten_hierarchies(products, LEVELS), "l1_name", ["holiday"], "qty", date(2000, 1, 1), date(2000, 12, 30)
    )
    return out.withColumn("day_split", F.round("day_split", 6))


# --- aggregates

@query("e26_features", with_entities(_ENTITIES, f"""SELECT channel, fiscal_year_week, sum(qty) AS qty, round(avg(price) + 1e-7, 3) AS price, count(DISTINCT store_code) AS stores FROM ({_master_sql()}) WHERE qty > 0 GROUP BY 1, 2"""))
def e26(spark, d):
    return aggregate.aggregate_features(
        _master(spark, d), ["channel", "fiscal_year_week"], [Feature("qty", "sum(qty)"), Feature("price", "round(avg(price) + 1e-7, 3)"), Feature("stores", "count(distinct store_code)")], "qty > 0"
    )


@query("e26_own_query", with_entities(_ENTITIES, f"""SELECT channel, fiscal_year_week, max(qty) AS qty, count(*) AS stores FROM ({_master_sql()}) GROUP BY 1, 2"""))
def e26o(spark, d):
    return aggregate.aggregate_features(
        _master(spark, d), ["channel", "fiscal_year_week"], [Feature("qty", ""), Feature("stores", "")],
        override="SELECT channel, fiscal_year_week, max(qty) AS qty, count(*) AS stores FROM {rows} GROUP BY channel, fiscal_year_week",
    )


@query("e26_week_window", with_entities(["calendar", "transaction_master"], """SELECT w.fiscal_year_week, count(*) AS n FROM transaction_master JOIN calendar w USING (date) WHERE w.fiscal_year_week >= 200010 AND w.fiscal_year_week <= (
  SELECT max(fiscal_year_week) FROM (SELECT fiscal_year_week, max(date) AS x FROM calendar GROUP BY 1) WHERE x < DATE '2000-08-10') GROUP BY 1"""))
def e26w(spark, d):
    c = views.calendar(spark, d)
    low, high = aggregate.week_window(c, 200010, date(2000, 8, 10))
    rows = views.transaction_master(spark, d).join(F.broadcast(c.select("date", "fiscal_year_week")), "date")
    return rows.where(F.col("fiscal_year_week").between(low, high)).groupBy("fiscal_year_week").agg(F.count("*").alias("n"))


@query("e27_aggregate_grid", with_entities(["transaction_master", "product_master", "calendar"], """SELECT fiscal_year_month, fiscal_year, l0_name, l1_name, CAST(level AS INTEGER) AS level, time_grain, sum(qty) AS qty, count(*) AS n FROM (
  SELECT fiscal_year_month, NULL::INTEGER AS fiscal_year, l0_name, NULL AS l1_name, 1 AS level, 'fiscal_year_month' AS time_grain, qty FROM j UNION ALL SELECT fiscal_year_month, NULL, l0_name, l1_name, 2, 'fiscal_year_month', qty FROM j
  UNION ALL SELECT NULL, fiscal_year, l0_name, NULL, 1, 'fiscal_year', qty FROM j UNION ALL SELECT NULL, fiscal_year, l0_name, l1_name, 2, 'fiscal_year', qty FROM j) GROUP BY 1, 2, 3, 4, 5, 6""",
  {"j": "SELECT fiscal_year_month, fiscal_year, l0_name, l1_name, qty FROM transaction_master JOIN product_master USING (product_code) JOIN calendar USING (date)"}))
def e27(spark, d):
    c = views.calendar(spark, d).select("date", "fiscal_year_month", "fiscal_year")
    rows = views.transaction_master(spark, d).select("date", "product_code", "qty").join(views.product_master(spark, d).select("product_code", "l0_name", "l1_name"), "product_code").join(F.broadcast(c), "date")
    return aggregate.aggregate_grid(rows, ["l0_name", "l1_name"], ["fiscal_year_month", "fiscal_year"], [Feature("qty", "sum(qty)"), Feature("n", "count(*)")])


_PSEUDO = "substr(sha256(l0_name), 1, 5) || substr(sha256(l1_name), 1, 5)"


def _bucket_sql(src: str) -> str:
    return f"SELECT product_code, l0_name, l1_name, {_PSEUDO} || '_' || CAST(ceil(row_number() OVER (PARTITION BY l0_name, l1_name ORDER BY product_code) * ceil(count(*) OVER (PARTITION BY l0_name, l1_name) / 7.0) / count(*) OVER (PARTITION BY l0_name, l1_name)) AS BIGINT) AS mp_bucket_code FROM {src}"


@query("e28_buckets", with_entities(["product_master"], _bucket_sql("product_master")))
def e28(spark, d):
    return aggregate.bucket_products(views.product_master(spark, d).select("product_code", "l0_name", "l1_name"), ["l0_name", "l1_name"], 7)


@query("e29_rebuckets", with_entities(["product_master"], f"""SELECT n.product_code, n.l0_name, n.l1_name, CASE WHEN n.c > coalesce(o.c, 0) THEN n.code ELSE old.mp_bucket_code END AS mp_bucket_code FROM (
  SELECT product_code, l0_name, l1_name, mp_bucket_code AS code, count(*) OVER (PARTITION BY l0_name, l1_name) AS c FROM ({_bucket_sql('product_master')})) n LEFT JOIN (SELECT l0_name, l1_name, count(*) AS c FROM p GROUP BY 1, 2) o USING (l0_name, l1_name)
  LEFT JOIN ({_bucket_sql('p')}) old USING (product_code)""", {"p": "SELECT * FROM product_master WHERE l0_name <> 'ECONOMY' OR CAST(product_code AS BIGINT) % 3 <> 0"}))  # fmt: skip
def e29(spark, d):
    now = views.product_master(spark, d).select("product_code", "l0_name", "l1_name")
    before = now.where("l0_name <> 'ECONOMY' OR cast(product_code as bigint) % 3 <> 0")
    by = ["l0_name", "l1_name"]
    lookup = aggregate.bucket_products(before, by, 7).join(aggregate.product_counts(before, by), by)
    return aggregate.rebucket_products(now, lookup, by, 7)


@query("e31_derived_tables", "SELECT l_suppkey, round(total, 2) AS total, total > 500 AS big FROM (SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem WHERE l_quantity > 5 GROUP BY 1)")
def e31(spark, d):
    table(spark, d, "lineitem").createOrReplaceTempView("e31_lineitem")
    specs = [
        DerivedSpec("e31_b", 2, "SELECT l_suppkey, round(total, 2) AS total, total > 500 AS big FROM e31_a"),
        DerivedSpec("e31_a", 1, "SELECT l_suppkey, sum(l_quantity) AS total FROM e31_lineitem GROUP BY 1", "SELECT l_suppkey, sum(l_quantity) AS total FROM e31_lineitem WHERE l_quantity > 5 GROUP BY 1"),
    ]
    return aggregate.run_derived(spark, specs, historic=False)["e31_b"]


@query("e32_published_tables", """WITH a AS (SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem GROUP BY 1), p AS (SELECT l_suppkey, sum(l_quantity) AS total FROM lineitem WHERE l_quantity > 5 GROUP BY 1)
  SELECT 'replaced' AS name, l_suppkey, round(total, 2) AS total FROM p WHERE total <= 900 UNION ALL SELECT 'appended', l_suppkey, round(total, 2) FROM a UNION ALL SELECT 'appended', l_suppkey, round(total, 2) FROM p""")
def e32(spark, d):
    mark = scratch_path(spark, "x").rsplit("-", 1)[-1]
    table(spark, d, "lineitem").createOrReplaceTempView(f"e32_lines_{mark}")
    full = f"SELECT l_suppkey, sum(l_quantity) AS total FROM e32_lines_{mark} GROUP BY 1"
    part = f"SELECT l_suppkey, sum(l_quantity) AS total FROM e32_lines_{mark} WHERE l_quantity > 5 GROUP BY 1"
    new, more, idle = f"e32_new_{mark}", f"e32_more_{mark}", f"e32_idle_{mark}"
    specs = [DerivedSpec(new, 1, full, part), DerivedSpec(more, 2, full, part, replace=False), DerivedSpec(idle, 3, "SELECT raise_error('not due')")]
    checks = {new: [Rule("large", "total > 900", "DELETE", "derived")]}
    for historic in (True, False):
        aggregate.publish_derived(spark, specs, historic, checks, due={new, more})
    both = spark.table(new).select(F.lit("replaced").alias("name"), "*").unionByName(spark.table(more).select(F.lit("appended").alias("name"), "*"))
    return both.withColumn("total", F.round("total", 2))


@query("e33_job_costs", """SELECT user_id AS job_id, event_type AS task, round(epoch(max(ts)) - epoch(min(ts)), 3) AS seconds, CAST(sum(event_id * 1000) AS BIGINT) AS slot_ms, CAST(count(*) AS BIGINT) AS bytes,
  '$' || format('{:,.4f}', sum(event_id * 1000) * 0.06 / 3600000) AS cost FROM events GROUP BY 1, 2""")
def e33(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    job = F.concat_ws("/", F.col("user_id").cast("string"), F.col("event_type"))
    log = e.select(job.alias("job_id"), F.col("ts").alias("start"), F.col("ts").alias("end"), (F.col("event_id") * 1000).alias("slot_ms"), F.lit(1).alias("bytes"))
    jobs = e.select(job.alias("job_id"), "user_id", F.col("event_type").alias("task")).distinct()
    return aggregate.job_cost_summary(log, jobs).select(F.col("user_id").alias("job_id"), "task", "seconds", "slot_ms", "bytes", "cost")


# --- preparation and clusters

def _holed(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("bal"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("seg"))


_HOLED = "h AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS bal, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS seg FROM customer)"


@query("m1_types", "SELECT 'numeric' AS kind, 'p_partkey,p_size,p_retailprice,digits' AS cols, count(*) AS n FROM part UNION ALL SELECT 'categorical', 'p_name,p_brand,p_type', count(*) FROM part")
def m1(spark, d):
    rows = table(spark, d, "part").withColumn("digits", F.col("p_size").cast("string"))
    numeric, categorical = prep.split_types(rows)
    return rows.agg(F.count("*").alias("n")).crossJoin(spark.createDataFrame([("numeric", ",".join(numeric)), ("categorical", ",".join(categorical))], "kind string, cols string"))


@query("m2_imputed", f"WITH {_HOLED}, m AS (SELECT median(bal) AS b FROM h), s AS (SELECT seg AS v FROM h WHERE seg IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) SELECT c_custkey, c_nationkey, round(coalesce(bal, b), 4) AS bal, coalesce(seg, v) AS seg FROM h, m, s")
def m2(spark, d):
    return prep.impute(_holed(spark, d), {"bal": "median", "seg": "mode"}).withColumn("bal", F.round("bal", 4)).select("c_custkey", "c_nationkey", "bal", "seg")


@query("m3_imputed_by_group", f"WITH {_HOLED} SELECT c_custkey, c_nationkey, round(coalesce(bal, avg(bal) OVER (PARTITION BY c_nationkey), 0), 4) AS bal, seg FROM h")
def m3(spark, d):
    return prep.impute(_holed(spark, d), {"bal": ("mean", "c_nationkey")}).withColumn("bal", F.round("bal", 4)).select("c_custkey", "c_nationkey", "bal", "seg")


@query("m4_rare_brands", "SELECT p_partkey, CASE WHEN sum(p_retailprice) OVER (PARTITION BY p_brand) / sum(p_retailprice) OVER () < 0.04 THEN 'other' ELSE p_brand END AS p_brand FROM part")
def m4(spark, d):
    return prep.lump_rare(table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice"), "p_retailprice", ["p_brand"], 0.04).select("p_partkey", "p_brand")


@query("m5_encoded", """SELECT l_returnflag_A, l_returnflag_N, l_returnflag_R, l_linestatus, count(*) AS n FROM (SELECT CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag_A, CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N, CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R,
  CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS BIGINT) AS l_linestatus FROM lineitem) GROUP BY 1, 2, 3, 4""")
def m5(spark, d):
    coded = prep.encode(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus"), {"l_returnflag": "onehot", "l_linestatus": "ordinal"})
    return coded.groupBy(*coded.columns).agg(F.count("*").alias("n"))


@query("m6_scaled", """WITH s AS (SELECT min(p_size) AS a, max(p_size) AS b, avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS sd FROM part) SELECT p_partkey, round((p_size - a) / nullif(b - a, 0), 6) AS p_size, round((p_retailprice - m) / sd, 5) AS p_retailprice, round(log2(p_size * 1.0), 6) AS logged FROM part, s""")
def m6(spark, d):
    rows = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", F.col("p_size").cast("double").alias("logged"))
    out = prep.transform(rows, {"p_size": "minmax", "p_retailprice": "standard", "logged": "log2"})
    return out.select("p_partkey", F.round("p_size", 6).alias("p_size"), F.round("p_retailprice", 5).alias("p_retailprice"), F.round("logged", 6).alias("logged"))


@query("m7_without_constants", "SELECT s_suppkey, 1 AS keep_flag FROM supplier")
def m7(spark, d):
    return prep.drop_constant(table(spark, d, "supplier").select("s_suppkey", F.lit(3).alias("three"), F.lit(1).alias("keep_flag")), ("keep_",))


def _supplier_features(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(
        F.sum("l_quantity").alias("qty"), F.avg("l_extendedprice").alias("price"), F.avg("l_discount").alias("discount"), F.count("*").cast("double").alias("n")
    )


@query("m8_components", """WITH f AS (SELECT l_suppkey, sum(l_quantity) AS q, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1),
  z AS (SELECT l_suppkey, (q - avg(q) OVER ()) / stddev_pop(q) OVER () AS a, (n - avg(n) OVER ()) / stddev_pop(n) OVER () AS b FROM f), r AS (SELECT avg(a * b) AS r FROM z)
  SELECT l_suppkey, round(abs(a + CASE WHEN r >= 0 THEN b ELSE -b END) / sqrt(2), 3) AS pc_1 FROM z, r""")
def m8(spark, d):
    # of two standardised columns the first component is their sum or difference over the root of 2; signs are free
    rows = _supplier_features(spark, d).select("l_suppkey", "qty", "n")
    scaled = prep.transform(rows, dict.fromkeys(("qty", "n"), "standard"))
    return prep.pca(scaled, ["qty", "n"], 0.6, digits=6).select("l_suppkey", F.round(F.abs("pc_1"), 3).alias("pc_1"))


_SCORED = """f AS (SELECT l_suppkey, sum(l_quantity) AS a, CAST(count(*) AS DOUBLE) AS b, l_suppkey % 3 AS l FROM lineitem GROUP BY 1), c AS (SELECT l, count(*) AS n, avg(a) AS ca, avg(b) AS cb FROM f GROUP BY 1),
  s AS (SELECT l, n, ca, cb, avg(sqrt((a - ca) ** 2 + (b - cb) ** 2)) AS s, sum((a - ca) ** 2 + (b - cb) ** 2) AS w FROM f JOIN c USING (l) GROUP BY 1, 2, 3, 4),
  db AS (SELECT avg(x) AS davies_bouldin FROM (SELECT p.l, max((p.s + q.s) / sqrt((p.ca - q.ca) ** 2 + (p.cb - q.cb) ** 2)) AS x FROM s p JOIN s q ON p.l <> q.l GROUP BY 1)),
  g AS (SELECT avg(a) AS ga, avg(b) AS gb, count(*) AS t FROM f)"""


@query("m10_cluster_scores", f"WITH {_SCORED} SELECT round(davies_bouldin, 3) AS davies_bouldin, round((sum(n * ((ca - ga) ** 2 + (cb - gb) ** 2)) / (count(*) - 1)) / (sum(w) / (max(t) - count(*))), 4) AS calinski_harabasz, CAST(count(*) AS INTEGER) AS n_labels FROM s, g, db GROUP BY davies_bouldin")
def m10(spark, d):
    rows = _supplier_features(spark, d).select("l_suppkey", F.col("qty").alias("a"), F.col("n").alias("b"), (F.col("l_suppkey") % 3).cast("int").alias("labels"))
    return clustering.score_clusters(clustering.vectors(rows, ["a", "b"])).select(F.round("davies_bouldin", 3).alias("davies_bouldin"), F.round("calinski_harabasz", 4).alias("calinski_harabasz"), "n_labels")


@query("m12_relabelled", "WITH f AS (SELECT l_suppkey, sum(l_quantity) AS q, l_suppkey % 5 AS l FROM lineitem GROUP BY 1), o AS (SELECT l, row_number() OVER (ORDER BY avg(q) DESC, l) AS r FROM f GROUP BY 1) SELECT l_suppkey, chr(CAST(64 + r AS INTEGER)) AS labels FROM f JOIN o USING (l)")
def m12(spark, d):
    rows = _supplier_features(spark, d).select("l_suppkey", "qty", (F.col("l_suppkey") % 5).alias("labels"))
    return clustering.relabel(rows, by="qty", letters=True).select("l_suppkey", "labels")


#: Stores in three groups far apart, by their keys; the sales only move them a little.
_PLANTED = "CAST(store_code AS BIGINT) % 3"


def _planted(spark, d):
    sold = views.transaction_master(spark, d).join(views.store_master(spark, d).select("store_code", "channel"), "store_code")
    sums = sold.groupBy("channel", "store_code").agg(F.sum("qty").alias("q"))
    shift = F.expr(_PLANTED) * 1000.0
    return sums.select("channel", "store_code", (shift + F.col("q") / 1e6).alias("x"), (-2.0 * shift + F.length("store_code")).alias("y"))


@query("m9_candidates", with_entities(["transaction_master", "store_master"], f"SELECT k, a AS algorithm, min_same, n FROM (SELECT count(*) AS n FROM (SELECT DISTINCT store_code FROM transaction_master JOIN store_master USING (store_code))), (VALUES (2, FALSE), (3, TRUE)) v(k, min_same), (VALUES ('bisecting'), ('kmeans'), ('mixture')) w(a)"))
def m9(spark, d):
    grid = clustering.candidate_grid(clustering.vectors(_planted(spark, d), ["x", "y"]), [2, 3], ("bisecting", "kmeans", "mixture"))
    out = None
    for (algorithm, k), df in grid.items():
        # whether the labels are the planted groups
        pairs = df.groupBy(F.expr(_PLANTED).alias("p"), "labels").agg(F.count("*").alias("n"))
        one = pairs.agg(F.lit(k).alias("k"), F.lit(algorithm).alias("algorithm"), ((F.countDistinct("p") == F.count("*")) & (F.countDistinct("labels") == F.count("*"))).alias("min_same"), F.sum("n").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("m11_selected", with_entities(["transaction_master", "store_master"], f"SELECT '3' AS k, {_PLANTED} AS planted, count(DISTINCT store_code) AS n FROM transaction_master JOIN store_master USING (store_code) GROUP BY 1, 2"))
def m11(spark, d):
    grid = clustering.candidate_grid(clustering.vectors(_planted(spark, d), ["x", "y"]), [2, 3], ("bisecting", "kmeans"))
    scores = {c: clustering.score_clusters(df).first().asDict() for c, df in grid.items()}
    chosen = clustering.select_outputs(grid, scores, "overall")
    (k, df), = chosen.items()
    # one row per label: a label that mixes groups would show as two rows or a wrong count
    return df.groupBy("labels", F.expr(_PLANTED).alias("planted")).agg(F.count("*").alias("n")).select(F.lit(k).alias("k"), "planted", "n")


@query("m13_store_clusters", with_entities(["transaction_master", "store_master"], f"""SELECT channel, store_code, CAST(CASE WHEN n <= 11 THEN 0 ELSE dense_rank() OVER (PARTITION BY channel ORDER BY p DESC) - 1 END AS INTEGER) AS labels FROM (
  SELECT channel, store_code, {_PLANTED} AS p, count(*) OVER (PARTITION BY channel) AS n FROM (SELECT DISTINCT channel, store_code FROM transaction_master JOIN store_master USING (store_code)))"""))
def m13(spark, d):
    return clustering.store_clusters(_planted(spark, d), ["channel"], [Feature("x", "max(x)"), Feature("y", "max(y)")], [2, 3]).select("channel", "store_code", F.col("labels").cast("int").alias("labels"))


@query("m14_cluster_summary", with_entities(["transaction_master", "store_clustering", "store_master"], """SELECT channel, cluster_name, count(*) AS n, round(avg(qty), 4) AS qty, (SELECT store_type FROM j i WHERE i.cluster_name = j.cluster_name GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS store_type FROM j GROUP BY 1, 2""",
  {"j": "SELECT c.channel, c.cluster_name, store_type, qty FROM transaction_master JOIN store_clustering c USING (store_code) JOIN store_master USING (store_code)"}))
def m14(spark, d):
    rows = views.transaction_master(spark, d).join(views.store_clustering(spark, d), "store_code").join(views.store_master(spark, d).select("store_code", "store_type"), "store_code")
    return clustering.cluster_summary(rows, ["channel"], ["qty", "store_type"]).withColumn("qty", F.round("qty", 4))


# --- streams

EVENT = EntitySpec(
    "event", "landing", "event_master",
    (ColumnMapping("event_id", "bigint", "event_id", unique_by=True, is_null_allowed=False), ColumnMapping("kind", "string", "event_type", is_null_allowed=False), ColumnMapping("value", "double", "value")),
)


@query("t1_stream_landing", "SELECT event_type, count(*) AS n, CAST(count(DISTINCT CAST(ts AS DATE)) AS BIGINT) AS stamps FROM events GROUP BY 1")
def t1(spark, d):
    path, out = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    table(spark, d, "events").select("event_id", "event_type", "value", F.date_format("ts", "yyyyMMdd").alias("day")).write.partitionBy("day").csv(path, header=True)
    stream = landing.stream_landing(spark, path, "event_id bigint, event_type string, value double")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "stream-checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("audit").alias("stamps"))


@query("t2_stream_merge", "SELECT event_id, event_type AS kind, value FROM events WHERE event_type <> 'error'")
def t2(spark, d):
    path, name = scratch_path(spark, "stream-in"), "t2_" + scratch_path(spark, "x").rsplit("-", 1)[-1]
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    table(spark, d, "events").select("event_id", kind.alias("event_type"), F.col("value").cast("string").alias("value")).write.csv(path, header=True)
    stream = landing.stream_landing(spark, path, "event_id string, event_type string, value string")
    landing.stream_validate_merge(stream, EVENT, name, scratch_path(spark, "stream-checkpoint")).awaitTermination()
    return spark.table(name)
