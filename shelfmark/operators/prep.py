"""Feature preparation: types, imputation, rare categories, encoders, scalers, constant columns and PCA."""

from __future__ import annotations

from itertools import accumulate

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_types(df: DataFrame, numeric: list[str] | None = None, categorical: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns: as listed, as the complement of one list, or numeric if every value casts (M1)."""
    cols = df.columns
    if numeric is not None or categorical is not None:
        numeric = numeric if numeric is not None else [c for c in cols if c not in categorical]
        return list(numeric), list(categorical) if categorical is not None else [c for c in cols if c not in numeric]
    number = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    rest = [c for c in cols if c not in number]
    bad = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("double").isNull()).alias(c) for c in rest]).first() if rest else {}
    number += [c for c in rest if not bad[c]]
    return [c for c in cols if c in number], [c for c in cols if c not in number]


def _statistic(how: str, c: str) -> Column:
    return {
        "zero": F.lit(0.0), "NA": F.lit("NA"), "sum": F.sum(c), "mean": F.avg(c), "median": F.median(c), "mode": F.mode(c, True),
    }[how].alias(c)


def impute(df: DataFrame, plan: dict[str, str | tuple[str, str]]) -> DataFrame:
    """NULLs by plan: ``none``, ``zero``, ``NA``, ``sum``, ``mean``, ``median``, ``mode`` (M2), or ``(statistic, group)`` (M3).

    A group without values gets 0 (``NA`` for text). Ties of a mode go to the least value. One aggregate serves all
    columns, and one more each group column.
    """
    plain = {c: h for c, h in plan.items() if isinstance(h, str) and h != "none"}
    if plain:
        stats = df.agg(*[_statistic(h, c) for c, h in plain.items()])
        named = stats.select(*[F.col(c).alias(f"__{c}") for c in plain])
        df = df.crossJoin(F.broadcast(named)).withColumns({c: F.coalesce(F.col(c), F.col(f"__{c}")) for c in plain}).drop(*[f"__{c}" for c in plain])
    by_group: dict[str, dict[str, str]] = {}
    for c, h in plan.items():
        if not isinstance(h, str):
            by_group.setdefault(h[1], {})[c] = h[0]
    for group, cols in by_group.items():
        stats = df.groupBy(F.col(group).alias("__g")).agg(*[_statistic(h, c).alias(f"__{c}") for c, h in cols.items()])
        df = df.join(stats, F.col(group).eqNullSafe(F.col("__g")), "left").drop("__g")
        for c in cols:
            empty = F.lit("NA") if isinstance(df.schema[c].dataType, T.StringType) else F.lit(0.0)
            df = df.withColumn(c, F.coalesce(F.col(c), F.col(f"__{c}"), empty))
        df = df.drop(*[f"__{c}" for c in cols])
    return df


def lump_rare(df: DataFrame, by: str | None, cols: list[str], threshold: float = 0.05) -> DataFrame:
    """Categories under ``threshold`` of the rows, or of the sum of ``by``, become ``other`` (M4)."""
    for c in cols:
        size = F.sum(by) if by else F.count("*")
        total = df.agg(size.alias("__all"))
        share = df.groupBy(F.col(c).alias("__c")).agg(size.alias("__n")).crossJoin(F.broadcast(total))
        rare = share.where(F.try_divide("__n", "__all") < threshold).select("__c", F.lit(True).alias("__rare"))
        df = df.join(rare, F.col(c).eqNullSafe(F.col("__c")), "left").withColumn(c, F.when(F.col("__rare"), F.lit("other")).otherwise(F.col(c))).drop("__c", "__rare")
    return df


#: Categories beyond which a column is not encoded.
MAX_CATEGORIES = 1000


def encode(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """``onehot``: one 0/1 column per category; ``ordinal``: the category's number in sorted order (M5). NULL: all 0, NULL."""
    for c, how in plan.items():
        # categories are the columns of the result, so they have to be few
        values = sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().limit(MAX_CATEGORIES + 1).collect())
        if len(values) > MAX_CATEGORIES:
            raise ValueError(f"{c} has more than {MAX_CATEGORIES} categories")
        if how == "onehot":
            df = df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for v in values}).drop(c)
        elif how == "ordinal":
            number = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c)) - 1 if values else F.lit(None).cast("long")
            df = df.withColumn(c, number)
        else:
            raise ValueError(f"unknown encoder {how!r}")
    return df


def transform(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """Scalers (``minmax``, ``standard``, ``maxabs``, ``robust``) and functions (``log``, ``log2``, ``log10``, ``square``, ``sqrt``, ``cube``) (M6).

    Statistics of all columns come from one aggregate. Constant columns scale to 0; logs and roots of what has none are NULL.
    """
    stats = {
        "minmax": lambda c: [F.min(c).alias(f"__{c}_0"), F.max(c).alias(f"__{c}_1")],
        "standard": lambda c: [F.avg(c).alias(f"__{c}_0"), F.stddev_pop(c).alias(f"__{c}_1")],
        "maxabs": lambda c: [F.max(F.abs(c)).alias(f"__{c}_0")],
        "robust": lambda c: [F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"__{c}_0")],
    }
    needed = [x for c, how in plan.items() if how in stats for x in stats[how](c)]
    names = []
    if needed:
        found = df.agg(*needed)
        names = found.columns
        df = df.crossJoin(F.broadcast(found))

    def scaled(c: str, how: str) -> Column:
        x, a, b = F.col(c), F.col(f"__{c}_0"), F.col(f"__{c}_1")
        over = lambda u, v: F.coalesce(F.try_divide(u, v), F.when(x.isNotNull(), F.lit(0.0)))
        if how == "minmax":
            return over(x - a, b - a)
        if how == "standard":
            return over(x - a, b)
        if how == "maxabs":
            return over(x, a)
        if how == "robust":
            return over(x - a[1], a[2] - a[0])
        if how in ("log", "log2", "log10"):
            return F.when(x > 0, {"log": F.log, "log2": F.log2, "log10": F.log10}[how](x))
        if how == "sqrt":
            return F.when(x >= 0, F.sqrt(x))
        return {"square": x * x, "cube": x * x * x}[how]

    return df.withColumns({c: scaled(c, how) for c, how in plan.items()}).drop(*names)


def drop_constant(df: DataFrame, immune: tuple[str, ...] = ()) -> DataFrame:
    """Without numeric columns of no variance, but for names that start with an immune prefix (M7)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and not f.name.startswith(tuple(immune) or ("\0",))]
    if not numeric:
        return df
    spread = df.agg(*[F.var_samp(c).alias(c) for c in numeric]).first()
    return df.drop(*[c for c in numeric if not spread[c]])


def pca(df: DataFrame, cols: list[str], variance: float = 0.95, digits: int = 4) -> DataFrame:
    """Centred components ``pc_1`` ... up to the share of variance (one at least), rounded; other columns stay (M8)."""
    means = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in cols])
    centred = df.crossJoin(F.broadcast(means)).withColumns({f"__z_{c}": F.col(c) - F.col(f"__m_{c}") for c in cols})
    vec = VectorAssembler(inputCols=[f"__z_{c}" for c in cols], outputCol="__v").transform(centred)
    model = PCA(k=len(cols), inputCol="__v", outputCol="__p").fit(vec)
    kept = max(1, sum(s <= variance + 1e-12 for s in accumulate(model.explainedVariance.toArray())))
    arr = model.transform(vec).withColumn("__a", vector_to_array("__p"))
    rest = [c for c in df.columns if c not in cols]
    return arr.select(*rest, *[F.round(F.col("__a")[i], digits).alias(f"pc_{i + 1}") for i in range(kept)])
