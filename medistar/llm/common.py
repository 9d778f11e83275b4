"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.session import fs_drop, shared_path

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)  # tables that the open scratch deletes

# a word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also if
    it is not installed and the driver was started in another folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    outlives lost executors and is computed once for all its readers.  Inside a
    ``scratch`` the table goes when that ends, unless it is to ``keep``."""
    path = shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    if not keep and (within := _scratch.get()) is not None:
        within.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Tables materialised inside are deleted at the end, also after an error: what
    is read later must have been written by then, with ``keep`` (or inside an outer
    scratch, which then has it)."""
    paths: list[str] = []
    before = _scratch.set(paths)
    try:
        yield
    finally:
        _scratch.reset(before)
        for path in paths:
            fs_drop(spark, path)


@contextmanager
def filtered_scans(spark: SparkSession):
    """Inside, Spark may test a large scan against a Bloom filter (of bounded size)
    of the keys it is joined with, before the shuffle, whatever the scan's size."""
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "0")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), JVM only."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def row_hash(df: DataFrame, seed: str = "") -> Column:
    """A 64-bit hash of a whole row (null-safe: nulls and their positions count)."""
    cols = []
    for c in df.columns:
        cols += [F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast("string")]
    return F.xxhash64(F.lit(seed), *cols)


def components(spark: SparkSession, edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of ``edges`` (src long, dst long), as (id, component)
    with component the smallest id reachable; ids without an edge are left out.

    Alternating large-star / small-star rounds: every round is two grouped
    minima over the current edges, so a hub with a third of all ids is combined
    map-side and no component is gathered anywhere.  Each round is written to
    the shared folder; the loop ends when a round changes nothing.
    """
    e = edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    e = materialize(spark, e, name)
    while True:
        # large star: every neighbour larger than the node points to the smallest of the neighbourhood
        both = e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).withColumn("m", F.least("src", "m"))
        large = (both.join(low, "src").where("dst > src and dst <> m")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())
        # small star: a node and its smaller neighbours point to the smallest of them
        down = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(down, "src").select(F.explode(F.array(
            F.struct(F.col("src").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("dst").alias("a"), F.col("m").alias("b")))).alias("p"))
            .select(F.col("p.a").alias("src"), F.col("p.b").alias("dst")).where("src <> dst").distinct())
        nxt = materialize(spark, small, name)
        sign = [d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
                for d in (e, nxt)]
        if sign[0] == sign[1]:
            return nxt.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(
                nxt.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct())
        e = nxt
