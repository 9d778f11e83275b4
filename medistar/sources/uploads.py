"""SRC-1..SRC-3: read a daily upload file.

CSV only (Excel is a single-machine format and is not supported); every
column is read as a string and cast explicitly later, so no schema inference
pass runs over the file.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medistar.functions import fixed


def normalise_name(c: str) -> str:
    """SRC-2: strip -> lower -> spaces to '_' -> drop characters outside [a-z0-9_]."""
    s = c.strip().lower().replace(" ", "_")
    return re.sub(r"[^a-z0-9_]", "", s)


def normalise(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def detect_type(columns: list[str]) -> str:
    return "inventory" if "units_on_hand" in columns else "sales"


def required_columns(kind: str) -> list[str]:
    return fixed.INVENTORY_UPLOAD_COLUMNS if kind == "inventory" else fixed.SALES_UPLOAD_COLUMNS


@dataclass
class Upload:
    df: DataFrame
    kind: str
    columns: list[str]


def check_columns(columns: list[str]) -> str:
    kind = detect_type(columns)
    missing = [c for c in required_columns(kind) if c not in columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return kind


def read_upload(spark: SparkSession, path: str, multi_line: bool = False) -> Upload:
    """SRC-1 / SRC-3: read a CSV upload (header row), normalise names, detect and validate its type.

    A ``_row`` column keeps the file order (it increases with the byte offset),
    which the keep-last dedupe of inventory uploads relies on.  Quotes inside a
    quoted field are doubled; a field does not hold line breaks unless
    ``multi_line`` (such a file is read by one task).
    """
    low = path.lower().rstrip("/")
    if not (low.endswith(".csv") or low.endswith(".csv.gz")):
        suffix = "." + low.rsplit(".", 1)[-1] if "." in low.rsplit("/", 1)[-1] else ""
        raise ValueError(f"Unsupported file type: {suffix}")
    opts = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**opts).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.options(**opts).option("enforceSchema", True).schema(schema).csv(path)
    df = normalise(df)
    kind = check_columns(df.columns)
    df = df.withColumn("_row", F.monotonically_increasing_id())
    return Upload(df, kind, [c for c in df.columns if c != "_row"])
