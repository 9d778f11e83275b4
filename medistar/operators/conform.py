"""DIM-9: shared shape of every conforming step: a clean DataFrame plus a report of
removed / fixed rows by reason, both lazily derived from one flagged plan."""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.functions import exprs as X
from medistar.session import fs_drop, shared_path

REPORT_SCHEMA = "table string, kind string, reason string, rows long"


@dataclass
class Conformed:
    clean: DataFrame
    report: DataFrame


def _counts(df: DataFrame, table: str, kind: str, reason: Column, weight: Column | None = None) -> DataFrame:
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    return (df.where(reason.isNotNull())
            .groupBy(reason.alias("reason"))
            .agg(F.sum(w).alias("rows"))
            .select(F.lit(table).alias("table"), F.lit(kind).alias("kind"), "reason", "rows"))


def waterfall_report(flagged: DataFrame, table: str, reason_col: str = "_reason",
                     fixes: dict[str, Column] | None = None) -> list[DataFrame]:
    """Removed-row counts per reason, plus fixed-row counts per fix flag."""
    parts = [_counts(flagged, table, "removed", F.col(reason_col))]
    if fixes:
        kept = flagged.where(F.col(reason_col).isNull())
        aggs = [F.count_if(cond).alias(name) for name, cond in fixes.items()]
        row = kept.agg(*aggs)
        stack = ", ".join(f"'{n}', `{n}`" for n in fixes)
        parts.append(row.select(F.expr(f"stack({len(fixes)}, {stack}) as (reason, rows)"))
                     .select(F.lit(table).alias("table"), F.lit("fixed").alias("kind"),
                             "reason", F.col("rows").cast("long").alias("rows"))
                     .where("rows > 0"))
    return parts


def duplicate_report(deduped: DataFrame, table: str, count_col: str = "_dups",
                     reason: str = "duplicates") -> DataFrame:
    return (deduped.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("long").alias("rows"))
            .select(F.lit(table).alias("table"), F.lit("removed").alias("kind"),
                    F.lit(reason).alias("reason"), "rows")
            .where("rows > 0"))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def with_total(counts: list[DataFrame]) -> DataFrame:
    """(table, rows) of several counts and a TOTAL row by rollup, so that each count is taken once."""
    return union_all(counts).rollup("table").agg(F.sum("rows").cast("long").alias("rows")) \
        .select(F.coalesce("table", F.lit("TOTAL")).alias("table"), F.coalesce("rows", F.lit(0)).alias("rows"))


# ------------------------------------------------------- one-pass reporting

def flag(df: DataFrame, rules: list[tuple[Column, str]], col: str = "_reason") -> tuple[DataFrame, list[str]]:
    """Add the waterfall's reject-reason column; also return the reason names."""
    return df.withColumn(col, X.reject_reason(rules)), [r for _, r in rules]


@dataclass
class _Tracked:
    table: str
    path: str
    flagged: DataFrame
    reasons: list[str]
    fixes: dict[str, Column]
    reason_col: str


@dataclass
class Counted:
    """A conformed table with its counts: the kept rows, and one row per reason and
    task at most for the removed ones (null keys), each with ``_reason``, the further rows it
    stands for (``_dups``) and how many of its rows were fixed (``_fixed_<name>``)."""
    rows: DataFrame
    reasons: list[str]
    fixes: list[str]


@dataclass
class Tracker:
    """The flagged tables of every waterfall built while it is active.

    A flagged table is written once to the shared folder and read by the steps
    after it; the removed / fixed counts are grouped aggregates over what is
    written, so a task that runs again never counts a row twice.

    With ``count_facts`` the facts, the largest tables, are not written a second time: their
    counts go through the dedupe and are written with the rows (``counted``)."""
    items: list[_Tracked] = field(default_factory=list)
    count_facts: bool = False
    counted: dict[str, Counted] = field(default_factory=dict)
    rows: list[tuple] = field(default_factory=list)

    def count(self, table: str, written: DataFrame) -> None:
        """Take the counts of a ``counted`` table from what was written."""
        c = self.counted[table]
        sums = written.groupBy("_reason").agg(F.count(F.lit(1)).alias("n"), F.sum("_dups").alias("dups"),
                                              *[F.sum(f"_fixed_{x}").alias(x) for x in c.fixes])
        by = {r["_reason"]: r for r in sums.collect()}
        self.rows += [(table, "removed", x, by[x]["n"] + by[x]["dups"]) for x in c.reasons if x in by]
        if None in by:
            self.rows += [(table, "fixed", x, by[None][x]) for x in c.fixes if by[None][x]]
            if by[None]["dups"]:
                self.rows.append((table, "removed", DUP_REASON.get(table, "duplicates"), by[None]["dups"]))

    def report(self, spark: SparkSession, written: dict[str, int]) -> DataFrame:
        rows = list(self.rows)
        for t in self.items:
            r = F.col(t.reason_col)
            m = t.flagged.agg(
                F.count_if(r.isNull()).alias("_kept"), *[F.count_if(r == x).alias(f"removed__{x}") for x in t.reasons],
                *[F.count_if(r.isNull() & c).alias(f"fixed__{n}") for n, c in t.fixes.items()]).first()
            rows += [(t.table, "removed", x, int(m[f"removed__{x}"])) for x in t.reasons if m[f"removed__{x}"]]
            rows += [(t.table, "fixed", n, int(m[f"fixed__{n}"])) for n in t.fixes if m[f"fixed__{n}"]]
            dups = int(m["_kept"]) - written.get(t.table, int(m["_kept"]))
            if dups > 0:
                rows.append((t.table, "removed", DUP_REASON.get(t.table, "duplicates"), dups))
        return spark.createDataFrame(rows, REPORT_SCHEMA)

    def drop(self, spark: SparkSession) -> None:
        """Delete the flagged tables; the tables conformed from them must be written by then."""
        for t in self.items:
            fs_drop(spark, t.path)


DUP_REASON = {"fact_drug_sales": "duplicate_order_lines", "fact_inventory": "duplicate_snapshots"}
_ACTIVE: list[Tracker] = []


@contextlib.contextmanager
def tracking(count_facts: bool = False):
    t = Tracker(count_facts=count_facts)
    _ACTIVE.append(t)
    try:
        yield t
    finally:
        _ACTIVE.remove(t)


def fact_tracker() -> Tracker | None:
    """The active tracker, if the counts of a fact go through its dedupe."""
    return _ACTIVE[-1] if _ACTIVE and _ACTIVE[-1].count_facts else None


def track(flagged: DataFrame, table: str, reasons: list[str], fixes: dict[str, Column] | None = None,
          reason_col: str = "_reason") -> DataFrame:
    """``flagged``, written once and counted when a tracker is active (that does not count facts)."""
    if not _ACTIVE or _ACTIVE[-1].count_facts:
        return flagged
    spark = flagged.sparkSession
    path = shared_path(spark, "conform", f"{table}-{uuid.uuid4().hex}")
    flagged.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(flagged.schema).parquet(path)
    _ACTIVE[-1].items.append(_Tracked(table, path, out, list(reasons), dict(fixes or {}), reason_col))
    return out
