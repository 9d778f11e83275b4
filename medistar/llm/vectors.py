"""Vector tables: cleaning, and packing into binary row blocks of bounded size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACK = 2048  # most vectors in a block, about


def clean(table: DataFrame, id_col: str, vec_col: str, nonzero: bool) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part: id and vector not
    null, not empty, every component finite, optionally not all zero.  Equal rows
    are one; rows that share an id but not the vector all stay."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if nonzero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.distinct()


def asked(rows: DataFrame, every: int) -> DataFrame:
    """The queries among cleaned rows: an id with several vectors asks with the least (in array order)."""
    return rows.where(is_query(F.col("vec_id"), every)).groupBy("vec_id").agg(F.min("v").alias("v"))


def is_query(vec_id: Column, every: int = 20) -> Column:
    return F.pmod(vec_id, F.lit(every)) == 0


def matrix(blob: bytes, n: int, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(blob, dtype=dtype).reshape(n, -1) if n else np.zeros((0, 0), dtype)


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    mat = np.array(pdf["v"].tolist(), dtype=np.float64).reshape(len(pdf), -1)
    return pd.DataFrame({"grp": pdf["grp"].iloc[:1], "block": pdf["block"].iloc[:1], "n": [len(pdf)],
                         "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "mat": [mat.tobytes()],
                         "extra": [pdf["extra"].to_numpy(np.float64).tobytes()]})


def blocks(rows: DataFrame, size: int = PACK) -> DataFrame:
    """Rows (grp long, vec_id, v, extra double) as one row per block of about
    ``size`` vectors of a group: (grp, block, n, ids, mat, extra), the last three as
    binary.  A group with any number of rows is split by a hash of the id."""
    per = rows.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(size))).cast("int").alias("parts"))
    return rows.join(per, "grp").withColumn("block", F.pmod(F.xxhash64("vec_id"), "parts").cast("long")) \
        .select("grp", "block", "vec_id", "v", "extra").groupBy("grp", "block") \
        .applyInPandas(_block, "grp long, block long, n int, ids binary, mat binary, extra binary")
