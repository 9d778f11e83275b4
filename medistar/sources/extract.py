"""Extract phase: raw tables in, date-shifted raw tables plus the generated
calendar out (SRC-11..SRC-14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.operators.conform import with_total
from medistar.params import Params
from medistar.sources.calendar import generate_calendar

SALES_DATE_KEYS = ["OrderDateKey", "ShipDateKey", "DueDateKey"]


def shift_timestamp(c, years: int):
    """SRC-13: add whole years; Feb 29 lands on Feb 28 when the target year is not leap."""
    return X.col(c) + F.make_ym_interval(F.lit(years), F.lit(0))


def extract_all(spark: SparkSession, raw: dict[str, DataFrame], params: Params) -> dict[str, DataFrame]:
    out = dict(raw)
    out["dim_date"] = generate_calendar(spark, params.calendar_start, params.calendar_end)
    fis = raw["fact_internet_sales"]
    for c in SALES_DATE_KEYS:
        fis = fis.withColumn(c, X.shift_key(X.safe_date_key(c, schema=fis.schema), params.shift_years))
    out["fact_internet_sales"] = fis
    inv = raw["fact_product_inventory"]
    inv = inv.withColumn("DateKey", X.shift_key(X.safe_date_key("DateKey", schema=inv.schema), params.shift_years))
    inv = inv.withColumn("MovementDate", shift_timestamp(F.col("MovementDate").cast("timestamp"), params.shift_years))
    out["fact_product_inventory"] = inv
    return out


def extract_summary(raw: dict[str, DataFrame]) -> DataFrame:
    """SRC-14: rows per extracted table plus a total row."""
    return with_total([df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in raw.items()])
