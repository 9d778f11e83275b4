"""DQ-1..DQ-9: declarative data-quality suite over the star.

A check is (category, name, table, condition) for row rules, an anti join for
referential integrity, or a grouped count for duplicates.  Row rules of one
table are evaluated together in a single ``count_if`` aggregate (one scan per
table); the results are unpivoted with ``stack`` into one DataFrame
``category, check, violations, status``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medistar.functions import fixed
from medistar.operators.conform import union_all
from medistar.plans.star import Star

RESULT_COLS = ["category", "check", "violations", "status"]


@dataclass(frozen=True)
class RowRule:
    category: str
    name: str
    table: str
    sql: str  # boolean condition of a violating row


def _blank(c: str) -> str:
    return f"({c} IS NULL OR {c} = '')"


# DQ-1 null checks
NULL_RULES = [
    RowRule("null", "fact_drug_sales - null drug_key", "fact_drug_sales", "drug_key IS NULL"),
    RowRule("null", "fact_drug_sales - null customer_key", "fact_drug_sales", "customer_key IS NULL"),
    RowRule("null", "fact_drug_sales - null order_date_key", "fact_drug_sales", "order_date_key IS NULL"),
    RowRule("null", "fact_drug_sales - null net_revenue", "fact_drug_sales", "net_revenue IS NULL"),
    RowRule("null", "fact_drug_sales - null units_sold", "fact_drug_sales", "units_sold IS NULL"),
    RowRule("null", "fact_inventory - null drug_key", "fact_inventory", "drug_key IS NULL"),
    RowRule("null", "fact_inventory - null snapshot_date_key", "fact_inventory", "snapshot_date_key IS NULL"),
    RowRule("null", "fact_inventory - null stock_status", "fact_inventory", "stock_status IS NULL"),
    RowRule("null", "dim_drug - null drug_name", "dim_drug", _blank("drug_name")),
    RowRule("null", "dim_customer - null customer_name", "dim_customer", _blank("customer_name")),
]

# DQ-2 business rules
BUSINESS_RULES = [
    RowRule("business", "net_revenue >= 0", "fact_drug_sales", "net_revenue < 0"),
    RowRule("business", "units_sold > 0", "fact_drug_sales", "units_sold <= 0"),
    RowRule("business", "unit_price > 0", "fact_drug_sales", "unit_price <= 0"),
    RowRule("business", "gross_profit <= net_revenue", "fact_drug_sales", "gross_profit > net_revenue + 0.01"),
    RowRule("business", "gross_margin_pct between -100 and 100", "fact_drug_sales",
            "gross_margin_pct < -100 OR gross_margin_pct > 100"),
    RowRule("business", "units_on_hand >= 0", "fact_inventory", "units_on_hand < 0"),
    RowRule("business", "stock_value >= 0", "fact_inventory", "stock_value < 0"),
    RowRule("business", "drug has therapeutic class", "dim_drug", "therapeutic_class_key IS NULL"),
    RowRule("business", "unit_cost <= 1.5 x unit_price", "dim_drug", "unit_cost > unit_price * 1.5"),
    RowRule("business", "customer has a type", "dim_customer", _blank("customer_type")),
]

# DQ-3 referential integrity: (name, child table, child key, parent table, parent key)
FK_RULES = [
    ("fact_drug_sales -> dim_drug", "fact_drug_sales", "drug_key", "dim_drug", "drug_key"),
    ("fact_drug_sales -> dim_customer", "fact_drug_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_drug_sales -> dim_date", "fact_drug_sales", "order_date_key", "dim_date", "date_key"),
    ("fact_inventory -> dim_drug", "fact_inventory", "drug_key", "dim_drug", "drug_key"),
    ("fact_inventory -> dim_date", "fact_inventory", "snapshot_date_key", "dim_date", "date_key"),
    ("dim_drug -> dim_therapeutic_class", "dim_drug", "therapeutic_class_key", "dim_therapeutic_class",
     "therapeutic_class_key"),
]

# DQ-4 duplicates
DUP_RULES = [
    ("duplicate order lines", "fact_drug_sales", ["source_order_number", "source_order_line_num", "source_system"]),
    ("duplicate drug keys", "dim_drug", ["drug_key"]),
    ("duplicate customer keys", "dim_customer", ["customer_key"]),
    ("duplicate date keys", "dim_date", ["date_key"]),
    ("duplicate inventory snapshots", "fact_inventory", ["snapshot_date_key", "drug_key"]),
]


def _status_pass_fail(v: Column) -> Column:
    return F.when(v == 0, "PASS").otherwise("FAIL")


def row_rule_counts(star: Star, rules: list[RowRule]) -> DataFrame:
    """All rules of a table in one aggregate, unpivoted to one row per rule."""
    parts = []
    by_table: dict[str, list[RowRule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    for table, rs in by_table.items():
        aggs = [F.count_if(F.coalesce(F.expr(r.sql), F.lit(False))).alias(f"c{i}") for i, r in enumerate(rs)]
        row = star[table].agg(*aggs)
        stack = ", ".join(f"'{r.category}', '{r.name}', c{i}" for i, r in enumerate(rs))
        parts.append(row.select(F.expr(f"stack({len(rs)}, {stack}) AS (category, check, violations)")))
    return union_all(parts)


def fk_counts(star: Star) -> DataFrame:
    """Orphan counts.  All foreign keys of one child table are checked in one scan
    of it: left joins to the distinct parent keys, then one ``count_if`` per key."""
    parts = []
    by_child: dict[str, list] = {}
    for rule in FK_RULES:
        by_child.setdefault(rule[1], []).append(rule)
    for child, rules in by_child.items():
        df = star[child].select(*dict.fromkeys(r[2] for r in rules))
        aggs = []
        for i, (name, _, ck, parent, pk) in enumerate(rules):
            keys = star[parent].select(F.col(pk).alias(ck)).distinct().withColumn(f"_found{i}", F.lit(True))
            df = df.join(keys, ck, "left")
            aggs.append(F.count_if(F.col(f"_found{i}").isNull()).alias(f"c{i}"))
        row = df.agg(*aggs)
        stack = ", ".join(f"'referential', '{r[0]}', c{i}" for i, r in enumerate(rules))
        parts.append(row.select(F.expr(f"stack({len(rules)}, {stack}) AS (category, check, violations)")))
    return union_all(parts)


def dup_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")


def dup_counts(star: Star) -> DataFrame:
    parts = []
    for name, table, keys in DUP_RULES:
        n = dup_groups(star[table], keys).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(n.select(F.lit("duplicate").alias("category"), F.lit(name).alias("check"), "violations"))
    return union_all(parts)


def dq_checks(star: Star) -> DataFrame:
    """DQ-1..DQ-4: 31 scored checks."""
    u = union_all([row_rule_counts(star, NULL_RULES + BUSINESS_RULES), fk_counts(star), dup_counts(star)])
    return u.select("category", "check", F.col("violations").cast("long").alias("violations"),
                    _status_pass_fail(F.col("violations")).alias("status"))


def dq_score(checks: DataFrame) -> DataFrame:
    """DQ-9: passed / total per category and overall with a grade."""
    g = checks.groupBy("category").agg(F.count_if(F.col("status") == "PASS").alias("passed"),
                                       F.count(F.lit(1)).alias("total"))
    overall = g.agg(F.lit("overall").alias("category"), F.sum("passed").alias("passed"),
                    F.sum("total").alias("total"))
    u = g.unionByName(overall)
    pct = F.col("passed").cast("double") * F.lit(100.0) / F.col("total").cast("double")
    return u.select("category", F.col("passed").cast("long").alias("passed"), F.col("total").cast("long").alias("total"),
                    pct.alias("score_pct"),
                    F.when(pct == 100, "PERFECT").when(pct >= 90, "EXCELLENT").otherwise("NEEDS REVIEW").alias("grade"))


def _unpivot(row: DataFrame, columns: str, rows: list[tuple]) -> DataFrame:
    """One aggregated row as one row per entry of ``rows`` (SQL expressions over it)."""
    return row.select(F.expr(f"stack({len(rows)}, {', '.join(x for r in rows for x in r)}) AS ({columns})"))


def _sales_with_date(star: Star) -> DataFrame:
    """Sales rows with their ``full_date`` (null: outside the calendar)."""
    d = star["dim_date"].select(F.col("date_key").alias("order_date_key"), "full_date")
    return star["fact_drug_sales"].join(d, "order_date_key", "left")


def monitor_checks(star: Star) -> DataFrame:
    """DQ-5: the nine checks of the monitor, two of them informational.  One aggregate per
    table; only the repeated order lines need a grouping, and so a second scan, of their own."""
    f = _sales_with_date(star).agg(F.count_if(F.col("drug_key").isNull()).alias("a"),
                                   F.count_if(F.col("net_revenue") < 0).alias("b"),
                                   F.count_if(F.col("units_sold") <= 0).alias("c"),
                                   F.count_if(F.col("full_date").isNull() & F.col("order_date_key").isNotNull()).alias("d"))
    fi = star["fact_inventory"].agg(
        F.count_if(F.col("drug_key").isNull()).alias("a"),
        F.countDistinct(F.when(F.col("stock_status") == fixed.STOCK_OUT, F.col("drug_key"))).alias("b"))
    drug = star["dim_drug"].agg(F.count_if(F.col("unit_price").isNull() | (F.col("unit_price") == 0)).alias("a"))
    cust = star["dim_customer"].agg(F.count_if(F.col("geography_key").isNull()).alias("a"))
    dups = dup_groups(star["fact_drug_sales"], DUP_RULES[0][2]).agg(F.count(F.lit(1)).alias("a"))
    cols = "check, count, _alert"
    u = union_all([
        _unpivot(f, cols, [("'Null drug_key in sales'", "a", "true"), ("'Negative net_revenue'", "b", "true"),
                           ("'Zero units_sold'", "c", "true"), ("'Orders outside dim_date range'", "d", "true")]),
        _unpivot(fi, cols, [("'Null drug_key in inventory'", "a", "true"), ("'Out of stock items'", "b", "false")]),
        _unpivot(dups, cols, [("'Duplicate sales order lines'", "a", "true")]),
        _unpivot(drug, cols, [("'Drugs with null price'", "a", "true")]),
        _unpivot(cust, cols, [("'Customers without geography'", "a", "false")]),
    ])
    status = (F.when((F.col("count") == 0) & F.col("_alert"), "PASS")
              .when(F.col("count") > 0, "WARN").otherwise("INFO"))
    return u.select("check", F.col("count").cast("long").alias("count"), status.alias("status"))


def post_load_checks(star: Star) -> DataFrame:
    """DQ-6: counts, must-be-zero checks and headline facts after a load; one aggregate per table."""
    n = F.count(F.lit(1)).alias("n")
    info, none = "'INFO'", "CAST(NULL AS STRING)"
    zero = lambda name, c: (f"'{name}'", f"CAST({c} AS DOUBLE)", none, f"IF({c} = 0, 'PASS', 'FAIL')")
    rows = lambda t: (f"'{t} rows'", "CAST(n AS DOUBLE)", none, info)
    f = _sales_with_date(star).agg(
        n, F.count_if(F.col("drug_key").isNull()).alias("a"), F.count_if(F.col("net_revenue") < 0).alias("b"),
        F.min("full_date").alias("lo"), F.max("full_date").alias("hi"),
        F.sum("net_revenue").cast("double").alias("revenue"),
        F.round(F.sum("gross_margin_pct") / F.count("gross_margin_pct"), 2).cast("double").alias("margin"))
    fi = star["fact_inventory"].agg(n, F.count_if(F.col("drug_key").isNull()).alias("a"),
                                    F.count_if(F.col("stock_status") == fixed.STOCK_OUT).alias("b"))
    cols = "check, value, detail, status"
    parts = [_unpivot(star[t].agg(n), cols, [rows(t)]) for t in [
        "dim_date", "dim_drug", "dim_customer", "dim_geography", "dim_therapeutic_class", "dim_sales_territory"]]
    parts.append(_unpivot(f, cols, [
        rows("fact_drug_sales"), zero("Sales null drug_key", "a"), zero("Sales negative revenue", "b"),
        ("'Date range (sales)'", "CAST(NULL AS DOUBLE)", "CONCAT(CAST(lo AS STRING), ' to ', CAST(hi AS STRING))", info),
        ("'Total revenue'", "revenue", none, info), ("'Avg gross margin'", "margin", none, info)]))
    parts.append(_unpivot(fi, cols, [rows("fact_inventory"), zero("Null FK in inventory", "a"),
                                     ("'Out of stock count'", "CAST(b AS DOUBLE)", none, info)]))
    return union_all(parts)


def null_profile(star: Star) -> DataFrame:
    """DQ-7: one row of null counts on the sales fact."""
    f = star["fact_drug_sales"]
    return f.agg(*[F.count_if(F.col(c).isNull()).alias(n) for c, n in [
        ("drug_key", "null_drug"), ("customer_key", "null_cust"), ("order_date_key", "null_date"),
        ("net_revenue", "null_rev"), ("units_sold", "null_units")]], F.count(F.lit(1)).alias("total"))


def reconciliation(star: Star, source_counts: DataFrame) -> DataFrame:
    """DQ-8: expected (extracted) vs loaded rows per table; accuracy = loaded / source.

    ``source_counts`` has ``table, expected`` (from the extract summary), never constants.
    """
    parts = [star[t].agg(F.lit(t).alias("table"), F.count(F.lit(1)).alias("actual")) for t in star.tables]
    actual = union_all(parts)
    j = source_counts.join(actual, "table", "inner")
    return j.select("table", F.col("expected").cast("long").alias("expected"), F.col("actual").cast("long").alias("actual"),
                    F.when(F.col("expected") == F.col("actual"), "PASS").otherwise("NOTE").alias("status"),
                    (F.col("actual").cast("double") * F.lit(100.0) / F.col("expected").cast("double")).alias("accuracy_pct"))


# raw (extracted) table feeding each star table
SOURCE_OF = {
    "dim_date": "dim_date", "dim_geography": "dim_geography", "dim_sales_territory": "dim_sales_territory",
    "dim_therapeutic_class": "dim_product_subcategory", "dim_drug": "dim_product", "dim_customer": "dim_customer",
    "fact_drug_sales": "fact_internet_sales", "fact_inventory": "fact_product_inventory",
}


def source_counts(extract_summary: DataFrame) -> DataFrame:
    """Expected rows per star table from the extract summary (SRC-14)."""
    raw_to_star = {v: k for k, v in SOURCE_OF.items()}
    m = F.create_map(*[F.lit(x) for kv in raw_to_star.items() for x in kv])
    return (extract_summary.where(F.col("table").isin(list(raw_to_star)))
            .select(m[F.col("table")].alias("table"), F.col("rows").alias("expected")))
