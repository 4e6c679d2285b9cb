"""Rules over KPI macros: delete, replace, report, pause, aggregate and custom checks."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.scratch import staged
from shelfmark.plans.specs import Kpi, Rule, RuleOutcome

SUMMARY = (
    "table string, module string, rule string, rule_display_name string, rule_description string, action string, no_original_rows long, "
    "affected_rows long, affected_rows_percent double, status string, insertion_date timestamp"
)


def expand_kpis(expr: str, kpis: dict[str, str | Kpi], qualify: str | None = None) -> str:
    """Each KPI code as a whole word is replaced by its expression; expressions may use codes too.

    ``qualify`` puts a table alias before the columns of an expression that names one as ``{t}``.
    """
    texts = {k: (v.query if isinstance(v, Kpi) else v) for k, v in kpis.items()}
    for _ in range(len(texts) + 1):
        new = re.sub(r"\bKPI_\w+\b", lambda m: f"({texts[m[0]]})" if m[0] in texts else m[0], expr)
        if new == expr:
            break
        expr = new
    return expr.replace("{t}", f"{qualify}." if qualify else "")


_OPERATORS: dict[str, Callable[[float, float], bool]] = {
    ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, "=": lambda a, b: a == b, "==": lambda a, b: a == b,
}


def threshold_met(ratio: float, threshold: str | None) -> bool:
    """``>5%`` and the like; no threshold always acts, one without ``%`` never does."""
    if not threshold:
        return True
    m = re.fullmatch(r"\s*(>=|<=|==|=|>|<)?\s*([0-9.]+)\s*%\s*", threshold)
    return bool(m) and _OPERATORS[m[1] or ">"](ratio * 100, float(m[2]))


def passes_threshold(df: DataFrame, cond: str, threshold: str | None) -> bool:
    """Whether the share of rows that meet ``cond`` lets the rule act."""
    n, bad = df.agg(F.count("*"), F.count_if(F.coalesce(F.expr(cond), F.lit(False)))).first()
    return threshold_met(bad / n if n else 0.0, threshold)


def aggregate_rule(df: DataFrame, kpis: dict, inner: str | None, group_by: list[str], agg: list[str], outer: str, limit: int = 100) -> DataFrame:
    """Groups that violate a rule, the first ``limit`` in group order."""
    rows = df.where(F.expr(expand_kpis(inner, kpis))) if inner else df
    aggs = [F.expr(expand_kpis(a, kpis)) for a in agg]
    return rows.groupBy(*group_by).agg(*aggs).where(F.expr(expand_kpis(outer, kpis))).orderBy(*group_by).limit(limit)


def rule_summary_row(entity: str, rule: Rule, original: int, affected: int, now: datetime, action: str | None = None) -> dict:
    """One summary row."""
    return {
        "table": entity, "module": rule.module, "rule": rule.name, "rule_display_name": rule.display_name, "rule_description": rule.description,
        "action": action or rule.action, "no_original_rows": original, "affected_rows": affected,
        "affected_rows_percent": round(affected * 100 / original, 4) if original else 0.0, "status": "Fail" if affected else "Pass", "insertion_date": now,
    }


def empty_check(df: DataFrame, entity: str, now: datetime) -> dict | None:
    """The summary row of an empty table, None otherwise."""
    return rule_summary_row(entity, Rule("data_check", "", "REPORT", "data_check"), 0, 1, now) if df.isEmpty() else None


def _condition(rule: Rule, kpis: dict) -> str:
    cond = expand_kpis(rule.outer, kpis)
    return f"({expand_kpis(rule.inner, kpis)}) AND ({cond})" if rule.inner else cond


def _row_condition(rule: Rule, kpis: dict) -> Column:
    """Whether a row meets a rule's condition; NULL is no."""
    return F.coalesce(F.expr(_condition(rule, kpis)), F.lit(False))


def _flagged(tables: dict[str, DataFrame], rows: DataFrame, rule: Rule, kpis: dict) -> DataFrame:
    """The rows with ``__hit``: whether they meet the rule's condition; across tables by a join on distinct keys."""
    if not rule.other_table:
        return rows.withColumn("__hit", _row_condition(rule, kpis))
    keys, cond = list(rule.on), _condition(rule, kpis)
    other = tables[rule.other_table]
    joined = rows.alias("a").join(other.alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "left")
    bad = joined.where(F.expr(cond)).select(*[F.col(f"a.{k}").alias(f"__k_{k}") for k in keys], F.lit(True).alias("__bad")).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return rows.join(bad, on, "left").withColumn("__hit", F.coalesce("__bad", F.lit(False))).drop("__bad", *[f"__k_{k}" for k in keys])


def without_pauses(summary: DataFrame, entity: str) -> DataFrame:
    """A stored summary without the rows that earlier PAUSE rules left for the table."""
    return summary.where(~((F.col("table") == entity) & (F.col("action") == "PAUSE")))


def _batches(rules: list[Rule]) -> list[list[Rule]]:
    """Rules in order, cut where one has to know what became of another.

    Within a batch all see the same rows but for those that earlier deletes without a threshold, which always act, took
    away. A rule that may or may not act on rows (with a threshold), or changes them, ends its batch; one that looks at
    another table is a batch of its own.
    """
    out: list[list[Rule]] = [[]]
    for rule in rules:
        if rule.other_table:
            out += [[rule], []]
            continue
        out[-1].append(rule)
        if not rule.group_by and (rule.action == "REPLACE" or rule.action == "DELETE" and rule.threshold):
            out.append([])
    return [b for b in out if b]


def _counted(clean: DataFrame, batch: list[Rule], kpis: dict) -> tuple[list[Column], list[Column], list[tuple[int, int]]]:
    """``(alive, hit, (rows, hits))`` of each rule of a batch, all counted by one aggregate."""
    alive, hits, left = [], [], F.lit(True)
    for rule in batch:
        alive.append(left)
        hits.append(F.lit(False) if rule.group_by else left & _row_condition(rule, kpis))
        if rule.action == "DELETE" and not rule.group_by:
            left = left & ~_row_condition(rule, kpis)
    counts = clean.agg(*[F.count_if(c).alias(f"{n}{i}") for i in range(len(batch)) for n, c in (("n", alive[i]), ("h", hits[i]))]).first()
    return alive, hits, [(counts[f"n{i}"], counts[f"h{i}"]) for i in range(len(batch))]


def run_rules(
    tables: dict[str, DataFrame], entity: str, rules: list[Rule], kpis: dict, stage: str | None = None, now: datetime | None = None, earlier: DataFrame | None = None,
) -> RuleOutcome:
    """Runs an entity's rules in order (D2-D7): each sees what the ones before it left.

    A rule below its threshold only reports. A failed PAUSE outside module ``validation`` pauses the table. Rules that need
    not know what became of each other are counted together: a batch is one aggregate with two conditions a rule, however
    many rules it has, and its rejected rows come from one pass. What a batch leaves is staged where another batch follows.
    No rows go to the driver. ``earlier`` summaries come first in the summary, without the table's PAUSE rows if one of the
    rules is a PAUSE.
    """
    now = now or datetime.now()
    clean = tables[entity]
    spark = clean.sparkSession
    anomalies, rows, paused, aggregates = [], [], False, {}
    chosen = [r for r in rules if stage is None or r.module == stage]
    if row := empty_check(clean, entity, now):
        rows.append(row)
    batches = _batches(chosen)
    for number, batch in enumerate(batches):
        if batch[0].other_table:
            rule = batch[0]
            flagged = _flagged(tables, clean, rule, kpis)
            source, alive, hits = flagged, [F.lit(True)], [F.col("__hit")]
            counts = [tuple(flagged.agg(F.count("*"), F.count_if("__hit")).first())]
        else:
            source = clean
            alive, hits, counts = _counted(clean, batch, kpis)
        found, left, replaced = [], F.lit(True), None
        for rule, here, hit, (original, affected) in zip(batch, alive, hits, counts, strict=True):
            if rule.group_by:
                groups = aggregate_rule(source.where(here), kpis, rule.inner, list(rule.group_by), list(rule.agg), rule.outer)
                aggregates[rule.name] = groups
                rows.append(rule_summary_row(entity, rule, original, groups.count(), now, "REPORT_AGG"))
                continue
            acts = threshold_met(affected / original if original else 0.0, rule.threshold)
            action = rule.action if acts else "REPORT"
            found.append(F.when(hit, F.struct(F.lit(rule.name).alias("QC"), F.lit(action).alias("action"))))
            rows.append(rule_summary_row(entity, rule, original, affected, now, action))
            if action == "DELETE":
                left = left & ~hit
            elif action == "REPLACE":
                replaced = rule, hit
            elif action == "PAUSE" and affected and rule.module != "validation":
                paused = True
        if found:
            # a row is rejected once for each rule that it meets
            bad = source.withColumn("__found", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())))
            bad = bad.withColumns({"QC": F.col("__found.QC"), "action": F.col("__found.action"), "insertion_date": F.lit(now)})
            anomalies.append(bad.drop("__found", "__hit"))
        clean = source.where(left)
        if replaced:
            rule, hit = replaced
            value = F.expr(expand_kpis(rule.value, kpis)).cast(clean.schema[rule.column].dataType)
            clean = clean.withColumn(rule.column, F.when(hit, value).otherwise(F.col(rule.column)))
        clean = clean.drop("__hit")
        if number + 1 < len(batches):
            clean = staged(clean, "rules")
    summary = spark.createDataFrame([tuple(r[c.split()[0]] for c in SUMMARY.split(", ")) for r in rows], SUMMARY)
    if earlier is not None:
        summary = (without_pauses(earlier, entity) if any(r.action == "PAUSE" for r in chosen) else earlier).unionByName(summary)
    if anomalies:
        anomaly = reduce(DataFrame.unionByName, anomalies)
    else:
        anomaly = clean.limit(0).withColumns({"QC": F.lit(""), "action": F.lit(""), "insertion_date": F.lit(now)})
    return RuleOutcome(clean, anomaly, summary, paused, aggregates)


def run_custom_check(spark: SparkSession, sql: str, qc_type: str) -> tuple[DataFrame, str]:
    """A 1 x 1 result is the status; of other results the rows with ``action = qc_type`` fail it."""
    found = spark.sql(sql)
    head = found.limit(2).collect()
    if len(found.columns) == 1 and len(head) == 1:
        return found, str(head[0][0])
    rows = found.where(F.col("action") == qc_type) if "action" in found.columns else found
    return rows, "Pass" if rows.isEmpty() else "Fail"


def run_checks_parallel(tasks: list[Callable[[], object]], pool: str = "qc", workers: int = 8) -> list:
    """Independent checks as Spark jobs of one pool, results in order."""
    sc = SparkSession.getActiveSession().sparkContext

    def one(task):
        sc.setLocalProperty("spark.scheduler.pool", pool)
        return task()

    with ThreadPoolExecutor(max_workers=workers) as threads:
        return list(threads.map(one, tasks))


def qc_rollup(summaries: list[DataFrame]) -> DataFrame:
    """All summaries: the table's original rows, rows remaining after the deletes so far, percent as text."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), summaries)
    table = Window.partitionBy("table")
    order = table.orderBy(F.desc("no_original_rows"), "affected_rows", "rule").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    original = F.max("no_original_rows").over(table)
    deleted = F.sum(F.when(F.col("action") == "DELETE", F.col("affected_rows")).otherwise(0)).over(order)
    share = F.coalesce(F.try_divide(F.col("affected_rows") * 100.0, original), F.lit(0.0))
    return every.select(
        "table", F.col("rule").alias("qc_name"), "action", original.alias("original_rows"), F.col("affected_rows").alias("rows_affected"),
        F.when(F.col("action") == "DELETE", original - deleted).otherwise(original).alias("remaining_rows"),
        F.concat(F.round(share, 2).cast("string"), F.lit("%")).alias("per_rows_affected"), "status", F.col("rule_description").alias("qc_description"),
    )
