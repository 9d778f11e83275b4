"""SRC-11: generate the calendar between two dates (inclusive).

Built from ``spark.range`` so the rows are produced in parallel rather than by
exploding one array inside a single task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.functions import fixed

# the generated calendar is broadcast into fact joins; keep it provably small
MAX_CALENDAR_DAYS = 200_000


def generate_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    s = dt.date.fromisoformat(start)
    e = dt.date.fromisoformat(end)
    n = (e - s).days + 1
    if n <= 0:
        raise ValueError(f"empty calendar range {start}..{end}")
    if n > MAX_CALENDAR_DAYS:
        raise ValueError(f"calendar of {n} days exceeds the {MAX_CALENDAR_DAYS}-day bound")
    d = F.date_add(F.lit(s), F.col("id").cast("int"))
    months = F.array(*[F.lit(m) for m in fixed.MONTH_NAMES])
    abbr = F.array(*[F.lit(m) for m in fixed.MONTH_ABBR])
    days = F.array(*[F.lit(x) for x in fixed.DAY_NAMES])
    base = spark.range(0, n, 1, numPartitions=max(1, min(64, n // 50_000 + 1))).select(d.alias("d"))
    m = F.month("d")
    wd = F.weekday("d")  # Monday = 0
    return base.select(
        X.date_key("d").alias("DateKey"),
        F.col("d").alias("FullDateAlternateKey"),
        F.year("d").alias("CalendarYear"),
        F.quarter("d").alias("CalendarQuarter"),
        m.alias("CalendarMonth"),
        m.alias("MonthNumberOfYear"),
        F.element_at(months, m).alias("EnglishMonthName"),
        F.element_at(abbr, m).alias("MonthAbbr"),
        F.dayofmonth("d").alias("DayNumberOfMonth"),
        (wd + 1).alias("DayNumberOfWeek"),
        F.element_at(days, wd + 1).alias("EnglishDayNameOfWeek"),
        X.week_of_year_monday("d").alias("WeekNumberOfYear"),
        F.when(m <= 6, 1).otherwise(2).alias("CalendarSemester"),
        F.when(m >= 4, F.year("d")).otherwise(F.year("d") - 1).alias("FiscalYear"),
        (F.floor(F.pmod(m - 4, F.lit(12)) / 3) + 1).cast("int").alias("FiscalQuarter"),
        (wd >= 5).alias("IsWeekend"),
    )
