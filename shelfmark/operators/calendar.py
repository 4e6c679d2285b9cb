"""The fiscal calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def week_of_year(d: Column) -> Column:
    """Weeks that start on Sunday, from 1; days before the first Sunday are in week 1 (0 + 1)."""
    return (F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7) + 1).cast("int")


def fiscal_calendar(spark: SparkSession, fiscal_start: date, start: str = "2010-01-01", end: str = "2050-01-01") -> DataFrame:
    """One row per day: fiscal fields are those of the calendar day as many days earlier as the fiscal year starts late.

    A week that lies in two months belongs to the month with more of its days (the later one if equal).
    """
    gap = (fiscal_start - date(fiscal_start.year, 1, 1)).days
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias("c"))
    # the day `gap` rows ahead in a series without holes is `gap` days ahead
    c = F.col("c")
    days = days.where(F.date_add(c, gap) <= F.to_date(F.lit(end)))
    fields = days.select(
        F.date_add(c, gap).alias("date"), F.year(c).alias("fiscal_year"), F.quarter(c).alias("fiscal_quarter"), F.month(c).alias("m"),
        week_of_year(c).alias("fiscal_week"), F.dayofmonth(c).alias("fiscal_day"),
    )
    overlap = fields.groupBy("fiscal_year", "fiscal_week", "m").agg(F.count("*").alias("n"))
    best = overlap.groupBy("fiscal_year", "fiscal_week").agg(F.max(F.struct("n", "m"))["m"].alias("fiscal_month"))
    return fields.join(F.broadcast(best), ["fiscal_year", "fiscal_week"]).select(
        "date", "fiscal_year", "fiscal_quarter", "fiscal_month", "fiscal_week", "fiscal_day",
        (F.col("fiscal_year") * 100 + F.col("fiscal_week")).alias("fiscal_year_week"), (F.col("fiscal_year") * 100 + F.col("m")).alias("fiscal_year_month"),
        (F.col("fiscal_year") * 100 + F.col("fiscal_quarter")).alias("fiscal_year_quarter"),
        F.when(F.col("fiscal_week") <= 50, F.ceil(F.col("fiscal_week") / 2)).otherwise(26).cast("int").alias("bi_week"),
    )


def week_bounds(calendar: DataFrame) -> DataFrame:
    """First and last date of each fiscal week."""
    return calendar.groupBy("fiscal_year_week").agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def is_due(calendar: DataFrame, today: date, cond: str) -> bool:
    """Whether a condition holds on today's calendar row."""
    row = calendar.where(F.col("date") == F.lit(today)).select(F.coalesce(F.expr(cond), F.lit(False))).head(1)
    return bool(row and row[0][0])


def week_rank(calendar: DataFrame) -> DataFrame:
    """Weeks numbered without holes, so that differences cross the year's end rightly."""
    w = Window.orderBy("fiscal_year_week")  # a calendar has some two thousand weeks
    return calendar.select("fiscal_year_week").distinct().withColumn("week_no", F.row_number().over(w))
