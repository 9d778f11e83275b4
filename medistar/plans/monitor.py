"""MON-1..MON-9: monitoring, profiling and guarded ad-hoc SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medistar.functions import fixed
from medistar.operators.conform import union_all, with_total
from medistar.plans.star import Star


def row_counts(star: Star, audit: DataFrame | None = None) -> DataFrame:
    """MON-1: rows per table plus a TOTAL row."""
    tables = dict(star.tables)
    if audit is not None:
        tables["etl_audit_log"] = audit
    return with_total([df.agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("rows")) for t, df in tables.items()])


def recent_etl_runs(audit: DataFrame, n: int = 30) -> DataFrame:
    """MON-2: newest audit rows (top-k with a unique tie-break)."""
    return (audit.select("batch_id", F.col("pipeline_step").alias("step"), F.col("table_name").alias("table"),
                         "rows_read", "rows_inserted", "rows_updated", "rows_rejected", "status", "started_at",
                         F.col("duration_seconds").alias("secs"), "audit_id")
            .orderBy(F.desc("started_at"), F.desc("audit_id")).limit(n).drop("audit_id"))


def source_system_breakdown(star: Star) -> DataFrame:
    """MON-3: per source system rows, revenue, first/last batch, date-key range."""
    return (star["fact_drug_sales"].groupBy("source_system")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("net_revenue").cast("double").alias("revenue"),
                 F.min("etl_batch_id").alias("first_batch"), F.max("etl_batch_id").alias("last_batch"),
                 F.min("order_date_key").alias("min_date"), F.max("order_date_key").alias("max_date"))
            .orderBy(F.desc("rows"), "source_system"))


def etl_timeline(audit: DataFrame, n: int = 30) -> DataFrame:
    """MON-4: per day runs, inserted and rejected rows; newest days first."""
    return (audit.where(F.col("started_at").isNotNull())
            .groupBy(F.to_date("started_at").alias("day"))
            .agg(F.count(F.lit(1)).alias("runs"), F.sum("rows_inserted").cast("long").alias("inserted"),
                 F.sum("rows_rejected").cast("long").alias("rejected"))
            .orderBy(F.desc("day")).limit(n))


def schema_summary(star: Star) -> DataFrame:
    """MON-5: table, column count, row count (column counts come from the schema)."""
    parts = [df.agg(F.lit(t).alias("table"), F.lit(len(df.columns)).alias("columns"),
                    F.count(F.lit(1)).alias("rows")) for t, df in star.tables.items()]
    return union_all(parts).orderBy("table")


def schema_columns(star: Star) -> DataFrame:
    """MON-5 column listing: (table, position, column, type, filled) with the rows in which each
    column is not null; one aggregate per table, unpivoted."""
    parts = []
    for t, df in star.tables.items():
        row = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
        stack = ", ".join(f"{i + 1}, '{f.name}', '{f.dataType.simpleString()}', c{i}" for i, f in enumerate(df.schema.fields))
        parts.append(row.select(F.lit(t).alias("table"),
                                F.expr(f"stack({len(df.columns)}, {stack}) AS (position, column, type, filled)")))
    return union_all(parts)


def financial_metrics(star: Star) -> DataFrame:
    """MON-6: revenue, profit, mean margin, units, rows, distinct drugs / customers."""
    f = star["fact_drug_sales"]
    return f.agg(F.sum("net_revenue").cast("double").alias("revenue"),
                 F.sum("gross_profit").cast("double").alias("profit"),
                 (F.sum("gross_margin_pct").cast("double") / F.count("gross_margin_pct")).alias("avg_margin"),
                 F.sum("units_sold").cast("long").alias("units"), F.count(F.lit(1)).alias("orders"),
                 F.countDistinct("drug_key").alias("drugs"), F.countDistinct("customer_key").alias("customers"))


def sales_date_range(star: Star) -> DataFrame:
    """MON-7: 'min to max' of the sold dates."""
    f = star["fact_drug_sales"].select("order_date_key")
    d = star["dim_date"].select(F.col("date_key").alias("order_date_key"), "full_date")
    return f.join(d, "order_date_key", "inner").agg(
        F.concat(F.min("full_date").cast("string"), F.lit(" to "), F.max("full_date").cast("string")).alias("date_range"))


def critical_drugs(star: Star, n: int = 10) -> DataFrame:
    """MON-8: drug x class x status in (Out of Stock, Critical); by status then name."""
    fi = star["fact_inventory"].where(F.col("stock_status").isin(fixed.STOCK_OUT, fixed.STOCK_CRITICAL))
    dr = star["dim_drug"].select("drug_key", "drug_name", "therapeutic_class_key")
    t = star["dim_therapeutic_class"].select("therapeutic_class_key", "therapeutic_class")
    return (fi.join(dr, "drug_key", "inner").join(t, "therapeutic_class_key", "inner")
            .groupBy("drug_name", "therapeutic_class", "stock_status")
            .agg(F.sum("units_on_hand").cast("long").alias("units"))
            .orderBy("stock_status", "drug_name", "therapeutic_class").limit(n))


# ------------------------------------------------------------ MON-9 ad-hoc SQL

BLOCKED_WORDS = ["insert", "update", "delete", "drop", "alter", "create", "truncate", "grant", "revoke",
                 "merge", "copy", "call", "execute", "refresh", "cache", "uncache", "set", "reset",
                 "load", "msck", "add", "analyze"]
ADHOC_LIMIT = 200


class UnsafeQuery(ValueError):
    pass


# what runs code or reads files by name
BLOCKED_FUNCTIONS = ["reflect", "java_method", "try_reflect"]
FILE_FORMATS = ["parquet", "csv", "json", "text", "orc", "avro", "xml", "binaryfile", "delta", "jdbc"]

# string literals and quoted names first, so that what they hold is no comment and no end of a statement
_PIECES = re.compile(r"""(?P<text>[rR]?'(?:[^'\\]|\\.|'')*'|[rR]?"(?:[^"\\]|\\.|"")*")|(?P<name>`(?:[^`]|``)*`)"""
                     r"|(?P<note>--[^\n]*|/\*.*?\*/)", re.S)


def _bare(s: str) -> str:
    """The text in lower case with its string literals emptied."""
    return _PIECES.sub(lambda m: "''" if m["text"] else m[0], s).lower()


def guard_sql(sql: str) -> str:
    """Read-only guard: strip comments, one statement, SELECT/WITH only, no blocked
    words, no calls into Java, no files as tables."""
    s = _PIECES.sub(lambda m: " " if m["note"] else m[0], sql).strip()
    s = s.rstrip(";").strip()
    if not s:
        raise UnsafeQuery("empty query")
    bare = _bare(s)
    if ";" in bare:
        raise UnsafeQuery("only one statement is allowed")
    if not re.match(r"(select|with)\b", bare):
        raise UnsafeQuery("only SELECT / WITH queries are allowed")
    words = set(re.findall(r"[a-z_]+", bare))
    bad = sorted(words & set(BLOCKED_WORDS + BLOCKED_FUNCTIONS))
    if bad:
        raise UnsafeQuery(f"blocked keyword(s): {', '.join(bad)}")
    if re.search(rf"(\b|`)({'|'.join(FILE_FORMATS)})`?\s*\.\s*`", bare) or re.search(r"`[^`]*[/:\\][^`]*`", bare):
        raise UnsafeQuery("only tables of the star are allowed")
    return s


def _parsed(spark: SparkSession, s: str) -> str:
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(s).toString()


def tables_used(spark: SparkSession, s: str) -> set[str]:
    """The relations that a query names, in lower case (its own WITH names among them)."""
    return {r.strip().lower() for r in re.findall(r"'UnresolvedRelation \[([^\]]*)\]", _parsed(spark, s))}


def check_tables(spark: SparkSession, star: Star, s: str) -> None:
    """Refuse relations besides the star's views and the query's own WITH names."""
    own = {n.strip("`") for n in re.findall(r"(`[^`]+`|\w+)\s*(?:\([^()]*\)\s*)?\bas\s*\(", _bare(s))}
    known = own | {t.lower() for t in star.tables}
    other = sorted(tables_used(spark, s) - known)
    if other or "UnresolvedTableValuedFunction" in _parsed(spark, s):
        raise UnsafeQuery(f"only tables of the star are allowed: {', '.join(other) or 'no table functions'}")


def adhoc_sql(spark: SparkSession, star: Star, sql: str, limit: int = ADHOC_LIMIT) -> DataFrame:
    """MON-9: run guarded SQL on the star views; a LIMIT is added when the text has none."""
    s = guard_sql(sql)
    check_tables(spark, star, s)
    star.register()
    df = spark.sql(s)
    if not re.search(r"\blimit\b", _bare(s)):
        df = df.limit(limit)
    return df
