"""Surrogate keys.

Dimensions loaded from the warehouse keep their business key as surrogate key
(unique integers; stable across reloads).  Rows created later (customers first
seen in an upload) get ``max + rank`` keys from ``assign_sequential_keys``,
which ranks rows without gathering them into one partition: range-partition
and sort, number rows inside each partition, add the row count of all earlier
partitions (a table with one row per partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medistar.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def assign_sequential_keys(df: DataFrame, order_cols: list[str], start: int | DataFrame, key_col: str,
                           num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start + 1, start + 2, ... in ``order_cols`` order (must be unique).

    The sorted rows are checkpointed to the shared checkpoint folder so the
    range boundaries, and therefore the numbering, are fixed before the two
    passes (per-partition counts, numbering) read them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    s = s.withColumn("_pid", F.shiftright(F.col("_mid"), 33)).withColumn("_local", F.col("_mid").bitwiseAND(_LOW33))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window over it is tiny by construction
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    out = s.join(F.broadcast(offsets), "_pid", "inner")
    if isinstance(start, DataFrame):
        # ``start`` is a one-row, one-column aggregate: join it on a constant key
        one = start.select(F.col(start.columns[0]).alias("_start")).withColumn("_one", F.lit(1))
        out = out.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one", "inner").drop("_one")
    else:
        out = out.withColumn("_start", F.lit(start))
    return out.withColumn(key_col, (F.col("_start") + F.col("_off") + F.col("_local") + 1).cast("long")) \
              .drop("_mid", "_pid", "_local", "_off", "_start")
