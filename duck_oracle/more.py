"""Oracle SQL for conformed tables, reports, data-quality, monitoring and uploads.

Entries that start with ',' continue the CTE list of ``star_ctes``.
"""

from __future__ import annotations

import re

from medistar.functions import fixed
from medistar.params import Params

P = Params()


def _q(s):
    return "'" + str(s).replace("'", "''") + "'"


def _count_row(cat, name, sql_from_where):
    return f"SELECT '{cat}' AS category, {_q(name)} AS \"check\", CAST(COUNT(*) AS BIGINT) AS violations {sql_from_where}"


TABLE_SQL = {t: f"SELECT * FROM {t}" for t in [
    "dim_date", "dim_geography", "dim_sales_territory", "dim_therapeutic_class", "dim_drug", "dim_customer",
    "fact_drug_sales", "fact_inventory"]}

FLAG_CTES = f"""
, o_sales_flag AS (
  SELECT s.*, CASE WHEN s.order_num IS NULL THEN 'null_order_number'
      WHEN dr.drug_key IS NULL THEN 'drug_not_found' WHEN cu.customer_key IS NULL THEN 'customer_not_found'
      WHEN dd.date_key IS NULL THEN 'date_not_found' WHEN s.dk > {P.as_of_key} THEN 'future_date'
      WHEN s.qty <= 0 THEN 'zero_quantity' WHEN s.price <= 0 THEN 'zero_or_null_price'
      WHEN s.net < 0 THEN 'negative_revenue' END AS reason
  FROM o_sales s LEFT JOIN dim_drug dr ON dr.source_product_key = s.pk
       LEFT JOIN dim_customer cu ON cu.source_customer_key = s.ck LEFT JOIN dim_date dd ON dd.date_key = s.dk
),
o_inv_flag AS (
  SELECT i.*, CASE WHEN dr.drug_key IS NULL THEN 'drug_not_found' WHEN dd.date_key IS NULL THEN 'date_not_found'
      WHEN i.dk > {P.as_of_key} THEN 'future_date' END AS reason
  FROM o_inv i LEFT JOIN dim_drug dr ON dr.source_product_key = i.pk LEFT JOIN dim_date dd ON dd.date_key = i.dk
),
o_report AS (
  SELECT 'dim_geography' AS "table", 'removed' AS kind, 'unknown_country' AS reason, COUNT(*) AS rows
    FROM o_geo WHERE country IS NULL
  UNION ALL SELECT 'dim_drug', 'removed', 'null_product_name', COUNT(*) FROM o_prod WHERE pname IS NULL
  UNION ALL SELECT 'dim_drug', 'removed', 'zero_or_null_price', COUNT(*) FROM o_prod
    WHERE pname IS NOT NULL AND NOT (price > 0)
  UNION ALL SELECT 'dim_drug', 'fixed', 'anomalous_cost_fixed', COUNT(*) FROM o_prod
    WHERE pname IS NOT NULL AND price > 0 AND greatest(cost, 0) > price * 3
  UNION ALL SELECT 'dim_customer', 'removed', 'null_name', COUNT(*) FROM o_cust1
    WHERE full_name = '' OR full_name = 'Unknown Unknown'
  UNION ALL SELECT 'dim_customer', 'fixed', 'invalid_email_fixed', COUNT(*) FROM o_cust1
    WHERE NOT (full_name = '' OR full_name = 'Unknown Unknown') AND email IS NOT NULL AND email <> ''
      AND position('@' IN email) = 0
  UNION ALL SELECT 'fact_drug_sales', 'removed', reason, COUNT(*) FROM o_sales_flag WHERE reason IS NOT NULL
    GROUP BY reason
  UNION ALL SELECT 'fact_drug_sales', 'fixed', 'anomalous_cost_fixed', COUNT(*) FROM o_sales_flag
    WHERE reason IS NULL AND net > 0 AND greatest(cost0, 0) > net * 2
  UNION ALL SELECT 'fact_drug_sales', 'removed', 'duplicate_order_lines',
    (SELECT COUNT(*) FROM o_sales_ok) - (SELECT COUNT(*) FROM fact_drug_sales)
  UNION ALL SELECT 'fact_inventory', 'removed', reason, COUNT(*) FROM o_inv_flag WHERE reason IS NOT NULL
    GROUP BY reason
  UNION ALL SELECT 'fact_inventory', 'fixed', 'negative_units_fixed', COUNT(*) FROM o_inv_flag
    WHERE reason IS NULL AND units < 0
  UNION ALL SELECT 'fact_inventory', 'fixed', 'negative_cost_fixed', COUNT(*) FROM o_inv_flag
    WHERE reason IS NULL AND cost < 0
  UNION ALL SELECT 'fact_inventory', 'removed', 'duplicate_snapshots',
    (SELECT COUNT(*) FROM o_inv_flag WHERE reason IS NULL) - (SELECT COUNT(*) FROM fact_inventory)
)
"""

REMOVAL_REPORT = FLAG_CTES + """SELECT "table", kind, reason, CAST(rows AS BIGINT) AS rows FROM o_report WHERE rows > 0"""

EXTRACT_SUMMARY = """
, o_ext AS (
  SELECT 'dim_geography' AS "table", (SELECT COUNT(*) FROM nation) AS rows
  UNION ALL SELECT 'dim_sales_territory', (SELECT COUNT(*) FROM region)
  UNION ALL SELECT 'dim_product_category', (SELECT COUNT(*) FROM o_cat)
  UNION ALL SELECT 'dim_product_subcategory', (SELECT COUNT(*) FROM o_subcat)
  UNION ALL SELECT 'dim_product', (SELECT COUNT(*) FROM part)
  UNION ALL SELECT 'dim_customer', (SELECT COUNT(*) FROM customer)
  UNION ALL SELECT 'fact_internet_sales', (SELECT COUNT(*) FROM o_sales)
  UNION ALL SELECT 'fact_product_inventory', (SELECT COUNT(*) FROM o_inv)
  UNION ALL SELECT 'dim_date', (SELECT COUNT(*) FROM o_cal)
)
SELECT "table", CAST(rows AS BIGINT) AS rows FROM o_ext
UNION ALL SELECT 'TOTAL', CAST(SUM(rows) AS BIGINT) FROM o_ext"""

RECONCILIATION = """
, o_src AS (
  SELECT 'dim_geography' AS "table", (SELECT COUNT(*) FROM nation) AS expected, (SELECT COUNT(*) FROM dim_geography) AS actual
  UNION ALL SELECT 'dim_sales_territory', (SELECT COUNT(*) FROM region), (SELECT COUNT(*) FROM dim_sales_territory)
  UNION ALL SELECT 'dim_therapeutic_class', (SELECT COUNT(*) FROM o_subcat), (SELECT COUNT(*) FROM dim_therapeutic_class)
  UNION ALL SELECT 'dim_drug', (SELECT COUNT(*) FROM part), (SELECT COUNT(*) FROM dim_drug)
  UNION ALL SELECT 'dim_customer', (SELECT COUNT(*) FROM customer), (SELECT COUNT(*) FROM dim_customer)
  UNION ALL SELECT 'fact_drug_sales', (SELECT COUNT(*) FROM o_sales), (SELECT COUNT(*) FROM fact_drug_sales)
  UNION ALL SELECT 'fact_inventory', (SELECT COUNT(*) FROM o_inv), (SELECT COUNT(*) FROM fact_inventory)
  UNION ALL SELECT 'dim_date', (SELECT COUNT(*) FROM o_cal), (SELECT COUNT(*) FROM dim_date)
)
SELECT "table", CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
  CASE WHEN expected = actual THEN 'PASS' ELSE 'NOTE' END AS status,
  CAST(actual AS DOUBLE) * 100.0 / CAST(expected AS DOUBLE) AS accuracy_pct FROM o_src"""

_LOAD_ORDER = ["dim_date", "dim_geography", "dim_sales_territory", "dim_therapeutic_class", "dim_drug",
               "dim_customer", "fact_drug_sales", "fact_inventory"]
_RELOAD_RULES = {  # (updated rows, new rows) of the reload, as the adapter's rules make them
    "dim_geography": ("geography_key % 5 = 0 AND distribution_zone IS DISTINCT FROM 'International Zone'", "FALSE"),
    "dim_sales_territory": ("FALSE", "FALSE"), "dim_therapeutic_class": ("FALSE", "FALSE"),
    "dim_drug": ("drug_key % 7 = 0 AND unit_price IS NOT NULL", "drug_key % 50 = 0"),
    "dim_customer": ("customer_key % 11 = 0 AND customer_segment IS DISTINCT FROM 'Reviewed'", "customer_key % 40 = 0"),
    "fact_inventory": ("drug_key % 5 = 0", "drug_key % 20 = 0"),
}


def _reload(t: str) -> str:
    """rows read, inserted, updated, kept, skipped of one table."""
    if t not in _RELOAD_RULES:  # insert or ignore
        new = "COUNT(*) FILTER (WHERE drug_key % 25 = 0)" if t == "fact_drug_sales" else "0"
        return f"SELECT '{t}' AS t, COUNT(*) + {new} AS r, {new} AS i, 0 AS u, 0 AS k, COUNT(*) AS s FROM {t}"
    upd, new = (f"COUNT(*) FILTER (WHERE {w})" for w in _RELOAD_RULES[t])
    return f"SELECT '{t}' AS t, COUNT(*) + {new} AS r, {new} AS i, {upd} AS u, COUNT(*) - {upd} AS k, 0 AS s FROM {t}"


RELOAD_CTE = ", o_reload AS (" + "\nUNION ALL ".join(_reload(t) for t in _LOAD_ORDER) + ")"
RELOAD_SUMMARY = RELOAD_CTE + """SELECT t AS "table", CAST(r AS BIGINT) AS rows_read, CAST(i AS BIGINT) AS inserted,
  CAST(u AS BIGINT) AS updated, CAST(k AS BIGINT) AS kept, CAST(s AS BIGINT) AS skipped FROM o_reload"""


def _first_load(names) -> str:
    return ("o_audit0 AS (" + "\nUNION ALL ".join(
        f"SELECT {i} AS audit_id, '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS n" for i, t in enumerate(names, start=1)) + ")")


def _audit(cte: str) -> str:
    return cte + """, o_audit AS (
  SELECT CAST(audit_id AS BIGINT) AS audit_id, batch AS batch_id, 'load' AS pipeline_step, table_name, CAST(r AS BIGINT) AS rows_read,
    CAST(i AS BIGINT) AS rows_inserted, CAST(u AS BIGINT) AS rows_updated, CAST(s AS BIGINT) AS rows_rejected,
    'success' AS status, CAST(NULL AS VARCHAR) AS error_message, CAST(ts AS TIMESTAMP) AS started_at,
    CAST(ts AS TIMESTAMP) AS completed_at, CAST(0 AS DECIMAL(10,3)) AS duration_seconds
  FROM o_runs)
"""

_NULL = [
    ("null", "fact_drug_sales - null drug_key", "fact_drug_sales", "drug_key IS NULL"),
    ("null", "fact_drug_sales - null customer_key", "fact_drug_sales", "customer_key IS NULL"),
    ("null", "fact_drug_sales - null order_date_key", "fact_drug_sales", "order_date_key IS NULL"),
    ("null", "fact_drug_sales - null net_revenue", "fact_drug_sales", "net_revenue IS NULL"),
    ("null", "fact_drug_sales - null units_sold", "fact_drug_sales", "units_sold IS NULL"),
    ("null", "fact_inventory - null drug_key", "fact_inventory", "drug_key IS NULL"),
    ("null", "fact_inventory - null snapshot_date_key", "fact_inventory", "snapshot_date_key IS NULL"),
    ("null", "fact_inventory - null stock_status", "fact_inventory", "stock_status IS NULL"),
    ("null", "dim_drug - null drug_name", "dim_drug", "drug_name IS NULL OR drug_name = ''"),
    ("null", "dim_customer - null customer_name", "dim_customer", "customer_name IS NULL OR customer_name = ''"),
    ("business", "net_revenue >= 0", "fact_drug_sales", "net_revenue < 0"),
    ("business", "units_sold > 0", "fact_drug_sales", "units_sold <= 0"),
    ("business", "unit_price > 0", "fact_drug_sales", "unit_price <= 0"),
    ("business", "gross_profit <= net_revenue", "fact_drug_sales", "gross_profit > net_revenue + 0.01"),
    ("business", "gross_margin_pct between -100 and 100", "fact_drug_sales",
     "gross_margin_pct < -100 OR gross_margin_pct > 100"),
    ("business", "units_on_hand >= 0", "fact_inventory", "units_on_hand < 0"),
    ("business", "stock_value >= 0", "fact_inventory", "stock_value < 0"),
    ("business", "drug has therapeutic class", "dim_drug", "therapeutic_class_key IS NULL"),
    ("business", "unit_cost <= 1.5 x unit_price", "dim_drug", "unit_cost > unit_price * 1.5"),
    ("business", "customer has a type", "dim_customer", "customer_type IS NULL OR customer_type = ''"),
]
_FK = [
    ("fact_drug_sales -> dim_drug", "fact_drug_sales", "drug_key", "dim_drug", "drug_key"),
    ("fact_drug_sales -> dim_customer", "fact_drug_sales", "customer_key", "dim_customer", "customer_key"),
    ("fact_drug_sales -> dim_date", "fact_drug_sales", "order_date_key", "dim_date", "date_key"),
    ("fact_inventory -> dim_drug", "fact_inventory", "drug_key", "dim_drug", "drug_key"),
    ("fact_inventory -> dim_date", "fact_inventory", "snapshot_date_key", "dim_date", "date_key"),
    ("dim_drug -> dim_therapeutic_class", "dim_drug", "therapeutic_class_key", "dim_therapeutic_class",
     "therapeutic_class_key"),
]
_DUP = [
    ("duplicate order lines", "fact_drug_sales", "source_order_number, source_order_line_num, source_system"),
    ("duplicate drug keys", "dim_drug", "drug_key"),
    ("duplicate customer keys", "dim_customer", "customer_key"),
    ("duplicate date keys", "dim_date", "date_key"),
    ("duplicate inventory snapshots", "fact_inventory", "snapshot_date_key, drug_key"),
]

_parts = [_count_row(c, n, f"FROM {t} WHERE {w}") for c, n, t, w in _NULL]
_parts += [_count_row("referential", n, f"FROM {c} x WHERE x.{ck} IS NULL OR NOT EXISTS "
                      f"(SELECT 1 FROM {p} y WHERE y.{pk} = x.{ck})") for n, c, ck, p, pk in _FK]
_parts += [_count_row("duplicate", n, f"FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1) x")
           for n, t, k in _DUP]
DQ_UNION = "\nUNION ALL ".join(_parts)
DQ_CHECKS = f"""SELECT category, "check", violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM ({DQ_UNION}) z"""
DQ_SCORE = f""", o_dq AS ({DQ_CHECKS}),
o_g AS (SELECT category, COUNT(*) FILTER (WHERE status = 'PASS') AS passed, COUNT(*) AS total FROM o_dq GROUP BY category
        UNION ALL SELECT 'overall', COUNT(*) FILTER (WHERE status = 'PASS'), COUNT(*) FROM o_dq)
SELECT category, CAST(passed AS BIGINT) AS passed, CAST(total AS BIGINT) AS total,
  CAST(passed AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) AS score_pct,
  CASE WHEN CAST(passed AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) = 100 THEN 'PERFECT'
       WHEN CAST(passed AS DOUBLE) * 100.0 / CAST(total AS DOUBLE) >= 90 THEN 'EXCELLENT' ELSE 'NEEDS REVIEW' END AS grade
FROM o_g"""

MONITOR_CHECKS = """, o_m AS (
  SELECT 'Null drug_key in sales' AS "check", COUNT(*) AS n, TRUE AS alert FROM fact_drug_sales WHERE drug_key IS NULL
  UNION ALL SELECT 'Negative net_revenue', COUNT(*), TRUE FROM fact_drug_sales WHERE net_revenue < 0
  UNION ALL SELECT 'Zero units_sold', COUNT(*), TRUE FROM fact_drug_sales WHERE units_sold <= 0
  UNION ALL SELECT 'Null drug_key in inventory', COUNT(*), TRUE FROM fact_inventory WHERE drug_key IS NULL
  UNION ALL SELECT 'Duplicate sales order lines', COUNT(*), TRUE FROM (SELECT source_order_number,
    source_order_line_num, source_system FROM fact_drug_sales GROUP BY 1, 2, 3 HAVING COUNT(*) > 1) x
  UNION ALL SELECT 'Drugs with null price', COUNT(*), TRUE FROM dim_drug WHERE unit_price IS NULL OR unit_price = 0
  UNION ALL SELECT 'Out of stock items', COUNT(DISTINCT drug_key), FALSE FROM fact_inventory
    WHERE stock_status = 'Out of Stock'
  UNION ALL SELECT 'Customers without geography', COUNT(*), FALSE FROM dim_customer WHERE geography_key IS NULL
  UNION ALL SELECT 'Orders outside dim_date range', COUNT(*), TRUE FROM fact_drug_sales
    WHERE order_date_key NOT IN (SELECT date_key FROM dim_date)
)
SELECT "check", CAST(n AS BIGINT) AS count,
  CASE WHEN n = 0 AND alert THEN 'PASS' WHEN n > 0 THEN 'WARN' ELSE 'INFO' END AS status FROM o_m"""

_TABLES = ["dim_date", "dim_drug", "dim_customer", "dim_geography", "dim_therapeutic_class", "dim_sales_territory",
           "fact_drug_sales", "fact_inventory"]
POST_LOAD = "\nUNION ALL ".join(
    [f"SELECT '{t} rows' AS \"check\", CAST(COUNT(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS detail, "
     f"'INFO' AS status FROM {t}" for t in _TABLES]
    + [f"SELECT '{n}', CAST(COUNT(*) FILTER (WHERE {w}) AS DOUBLE), NULL, "
       f"CASE WHEN COUNT(*) FILTER (WHERE {w}) = 0 THEN 'PASS' ELSE 'FAIL' END FROM {t}"
       for n, t, w in [("Sales null drug_key", "fact_drug_sales", "drug_key IS NULL"),
                       ("Sales negative revenue", "fact_drug_sales", "net_revenue < 0"),
                       ("Null FK in inventory", "fact_inventory", "drug_key IS NULL")]]
    + ["SELECT 'Date range (sales)', NULL, CAST(MIN(d.full_date) AS VARCHAR) || ' to ' || CAST(MAX(d.full_date) AS VARCHAR),"
       " 'INFO' FROM fact_drug_sales f JOIN dim_date d ON f.order_date_key = d.date_key",
       "SELECT 'Total revenue', CAST(SUM(net_revenue) AS DOUBLE), NULL, 'INFO' FROM fact_drug_sales",
       # mean margin rounded half-up to 2 decimals with integer arithmetic
       "SELECT 'Avg gross margin', CAST(CAST(sign(s) * ((2 * abs(s) + c * 100) // (2 * c * 100)) AS DECIMAL(18,0))"
       " * 0.01 AS DOUBLE), NULL, 'INFO' FROM (SELECT CAST(SUM(gross_margin_pct * 10000) AS HUGEINT) AS s,"
       " COUNT(gross_margin_pct) AS c FROM fact_drug_sales) x",
       "SELECT 'Out of stock count', CAST(COUNT(*) FILTER (WHERE stock_status = 'Out of Stock') AS DOUBLE), NULL,"
       " 'INFO' FROM fact_inventory"])

NULL_PROFILE = """SELECT COUNT(*) FILTER (WHERE drug_key IS NULL) AS null_drug,
  COUNT(*) FILTER (WHERE customer_key IS NULL) AS null_cust, COUNT(*) FILTER (WHERE order_date_key IS NULL) AS null_date,
  COUNT(*) FILTER (WHERE net_revenue IS NULL) AS null_rev, COUNT(*) FILTER (WHERE units_sold IS NULL) AS null_units,
  COUNT(*) AS total FROM fact_drug_sales"""

SOURCE_SYSTEM = """SELECT source_system, COUNT(*) AS rows, CAST(SUM(net_revenue) AS DOUBLE) AS revenue,
  MIN(etl_batch_id) AS first_batch, MAX(etl_batch_id) AS last_batch, MIN(order_date_key) AS min_date,
  MAX(order_date_key) AS max_date FROM fact_drug_sales GROUP BY source_system"""

FINANCIAL = """SELECT CAST(SUM(net_revenue) AS DOUBLE) AS revenue, CAST(SUM(gross_profit) AS DOUBLE) AS profit,
  CAST(SUM(gross_margin_pct) AS DOUBLE) / COUNT(gross_margin_pct) AS avg_margin, CAST(SUM(units_sold) AS BIGINT) AS units,
  COUNT(*) AS orders, COUNT(DISTINCT drug_key) AS drugs, COUNT(DISTINCT customer_key) AS customers
  FROM fact_drug_sales"""

DATE_RANGE = """SELECT CAST(MIN(d.full_date) AS VARCHAR) || ' to ' || CAST(MAX(d.full_date) AS VARCHAR) AS date_range
  FROM fact_drug_sales f JOIN dim_date d ON f.order_date_key = d.date_key"""

CRITICAL = """SELECT dr.drug_name, t.therapeutic_class, fi.stock_status, CAST(SUM(fi.units_on_hand) AS BIGINT) AS units
  FROM fact_inventory fi JOIN dim_drug dr ON fi.drug_key = dr.drug_key
  JOIN dim_therapeutic_class t ON dr.therapeutic_class_key = t.therapeutic_class_key
  WHERE fi.stock_status IN ('Out of Stock', 'Critical')
  GROUP BY dr.drug_name, t.therapeutic_class, fi.stock_status
  ORDER BY fi.stock_status, dr.drug_name, t.therapeutic_class LIMIT 10"""

ROW_COUNTS = (", o_rc AS (" + "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS rows FROM {t}" for t in
    ["dim_date", "dim_geography", "dim_sales_territory", "dim_therapeutic_class", "dim_drug", "dim_customer",
     "fact_drug_sales", "fact_inventory"])
    + """)
SELECT "table", CAST(rows AS BIGINT) AS rows FROM o_rc UNION ALL SELECT 'TOTAL', CAST(SUM(rows) AS BIGINT) FROM o_rc""")

_NCOLS = {"dim_date": 17, "dim_geography": 8, "dim_sales_territory": 5, "dim_therapeutic_class": 8, "dim_drug": 13,
          "dim_customer": 11, "fact_drug_sales": 23, "fact_inventory": 12}
SCHEMA_SUMMARY = "\nUNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {n} AS columns, COUNT(*) AS rows FROM {t}" for t, n in _NCOLS.items())

ADHOC_TEXT = ("-- status mix of the drug dimension\n"
              "SELECT drug_status, dosage_form, COUNT(*) AS n FROM dim_drug GROUP BY drug_status, dosage_form;")
ADHOC = "SELECT drug_status, dosage_form, COUNT(*) AS n FROM dim_drug GROUP BY drug_status, dosage_form LIMIT 200"
ADHOC_PAGE = "SELECT drug_key, drug_name FROM dim_drug ORDER BY drug_key LIMIT 500 OFFSET 5"

# ------------------------------------------------------------------- uploads
_types = " ".join(f"WHEN contains(lower(trim(customer_type)), {_q(k)}) THEN {_q(v)}"
                  for k, v in fixed.UPLOAD_CUSTOMER_TYPES)
_zones = " ".join(f"WHEN {_q(k.lower())} THEN {_q(v)}" for k, v in fixed.COUNTRY_TO_ZONE.items())

UPLOAD_CTES = f"""
, o_up AS (
  SELECT
    CASE WHEN l_orderkey % 13 = 0 THEN 'Qx-' || l_partkey || ' Tablet'
         WHEN dr.drug_name IS NULL THEN 'Qx-' || l_partkey
         WHEN l_orderkey % 11 = 0 THEN split_part(dr.drug_name, ' ', 1) || ' xyz'
         WHEN l_orderkey % 7 = 0 THEN upper(dr.drug_name)
         ELSE dr.drug_name END AS drug_name,
    CASE WHEN l_orderkey % 5 = 0 OR cu.customer_name IS NULL THEN 'New Buyer ' || (o_custkey % 50)
         ELSE cu.customer_name END AS customer_name,
    CASE WHEN l_orderkey % 5 = 0 OR cu.customer_name IS NULL THEN 'Government office'
         ELSE lower(cu.customer_type) END AS customer_type,
    CASE WHEN l_orderkey % 23 = 0 THEN 'n/a'
         WHEN l_orderkey % 19 = 0 THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL {P.shift_years} YEAR, '%-m/%-d/%Y')
         WHEN l_orderkey % 17 = 0 THEN strftime(CAST(o_orderdate AS DATE) + INTERVAL {P.shift_years} YEAR, '%Y-%m-%dT10:30:00')
         ELSE strftime(CAST(o_orderdate AS DATE) + INTERVAL {P.shift_years} YEAR, '%Y-%m-%d') END AS order_date,
    CASE WHEN l_orderkey % 29 = 0 THEN '0' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS units_sold,
    CASE WHEN l_orderkey % 31 = 0 THEN '0' ELSE CAST(CAST(CAST(
      (2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT))
      AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
    CAST(CAST(round(CAST(l_discount AS DECIMAL(18,2)) * 100, 2) AS DECIMAL(18,2)) AS VARCHAR) AS unit_price_discount_pct,
    CAST(CAST(round(CASE WHEN l_linenumber % 2 = 0 THEN CAST(p_retailprice AS DECIMAL(18,2)) * 0.6
         ELSE CAST(p_retailprice AS DECIMAL(18,2)) * 0.6 * CAST(l_quantity AS BIGINT) END, 2) AS DECIMAL(18,2)) AS VARCHAR)
      AS total_product_cost,
    CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2)
      AS DECIMAL(18,2)) AS VARCHAR) AS sales_amount,
    CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
      * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS VARCHAR) AS tax_amt,
    CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) * 0.025, 2)
      AS DECIMAL(18,2)) AS VARCHAR) AS freight,
    COALESCE(r_name, '') AS sales_territory_name, COALESCE(g.country_region, 'Brazil') AS country_region,
    COALESCE(g.city, '') AS city, l_orderkey * 8 + l_linenumber AS rowno
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN dim_drug dr ON dr.drug_key = l_partkey + 1
    LEFT JOIN dim_customer cu ON cu.customer_key = o_custkey * 17 + 1
    LEFT JOIN dim_geography g ON g.geography_key = cu.geography_key
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
),
o_up1 AS (
  SELECT *, CAST(try_strptime(trim(order_date), ['%Y-%m-%d', '%m/%d/%Y', '%Y-%m-%dT%H:%M:%S']) AS DATE) AS od,
    COALESCE(TRY_CAST(trim(units_sold) AS DECIMAL(18,4)), 0) AS u,
    COALESCE(TRY_CAST(trim(unit_price) AS DECIMAL(18,4)), 0) AS pr,
    COALESCE(TRY_CAST(trim(unit_price_discount_pct) AS DECIMAL(18,4)), 0) AS pct,
    greatest(COALESCE(TRY_CAST(trim(total_product_cost) AS DECIMAL(18,4)), 0), 0) AS cr,
    COALESCE(TRY_CAST(trim(tax_amt) AS DECIMAL(18,4)), 0) AS tx,
    COALESCE(TRY_CAST(trim(freight) AS DECIMAL(18,4)), 0) AS fr
  FROM o_up
),
o_up2 AS (
  SELECT *, CASE WHEN od IS NULL THEN 'bad_dates' WHEN u <= 0 THEN 'zero_units' WHEN pr <= 0 THEN 'zero_price'
              WHEN COALESCE(trim(drug_name), '') = '' OR COALESCE(trim(customer_name), '') = '' THEN 'null_critical'
              END AS reject_reason,
    CAST(round(pr * u, 4) AS DECIMAL(18,4)) AS g
  FROM o_up1
),
o_up3 AS (
  SELECT *, CAST(round(g * pct * 0.01, 4) AS DECIMAL(18,4)) AS dsc FROM o_up2
),
o_up4 AS (
  SELECT *, CAST(g - dsc AS DECIMAL(18,4)) AS nt,
    CAST(CASE WHEN cr < g * 0.5 THEN cr * u ELSE cr END AS DECIMAL(18,4)) AS cg FROM o_up3
),
upload_sales_clean AS (
  SELECT trim(drug_name) AS drug_name, trim(customer_name) AS customer_name,
    CASE {_types} ELSE {_q(fixed.DEFAULT_UPLOAD_CUSTOMER_TYPE)} END AS customer_type,
    od AS order_date, u AS units_sold, pr AS unit_price, pct AS unit_price_discount_pct,
    g AS gross_revenue, dsc AS discount_amount, nt AS net_revenue, cg AS cost_of_goods,
    CAST(nt - cg AS DECIMAL(18,4)) AS gross_profit,
    CAST(CASE WHEN nt > 0 THEN CAST(sign(CAST((nt - cg) * 10000 AS HUGEINT))
      * ((2 * abs(CAST((nt - cg) * 10000 AS HUGEINT)) * 10000 + CAST(nt * 10000 AS HUGEINT))
         // (2 * CAST(nt * 10000 AS HUGEINT))) AS DECIMAL(18,0)) * 0.01 ELSE 0 END AS DECIMAL(8,4)) AS gross_margin_pct,
    tx AS tax_amount, fr AS freight_cost, trim(sales_territory_name) AS sales_territory_name,
    trim(country_region) AS country_region, trim(city) AS city,
    CASE lower(trim(country_region)) {_zones} ELSE {_q(fixed.DEFAULT_ZONE)} END AS distribution_zone,
    CAST(strftime(od, '%Y%m%d') AS INTEGER) AS date_key, rowno AS _row
  FROM o_up4 WHERE reject_reason IS NULL
),
o_exact AS (SELECT lower(drug_name) AS ln, MIN(drug_key) AS k FROM dim_drug GROUP BY 1),
o_res1 AS (
  SELECT c.*, split_part(trim(c.drug_name), ' ', 1) AS token, e.k AS exact_key
  FROM upload_sales_clean c LEFT JOIN o_exact e ON e.ln = lower(c.drug_name)
),
o_fuzzy AS (
  SELECT t.token, MIN(d.drug_key) AS k FROM (SELECT DISTINCT token FROM o_res1 WHERE exact_key IS NULL) t
  JOIN dim_drug d ON length(t.token) > 0 AND contains(lower(d.drug_name), lower(t.token)) GROUP BY t.token
),
o_res2 AS (
  SELECT r.*, COALESCE(r.exact_key, f.k) AS drug_key, dd.date_key AS dk_ok
  FROM o_res1 r LEFT JOIN o_fuzzy f ON f.token = r.token LEFT JOIN dim_date dd ON dd.date_key = r.date_key
),
o_ok AS (SELECT *, customer_name AS pat FROM o_res2 WHERE drug_key IS NOT NULL AND dk_ok IS NOT NULL),
o_cexact AS (SELECT lower(customer_name) AS ln, MIN(customer_key) AS k FROM dim_customer GROUP BY 1),
o_cmatch AS (
  SELECT p.pat, MIN(c.customer_key) AS k FROM (SELECT DISTINCT pat FROM o_ok) p
  JOIN dim_customer c ON length(p.pat) > 0 AND contains(lower(c.customer_name), lower(p.pat)) GROUP BY p.pat
),
o_ok2 AS (SELECT o.*, COALESCE(e.k, m.k) AS ck FROM o_ok o LEFT JOIN o_cexact e ON e.ln = lower(o.customer_name)
  LEFT JOIN o_cmatch m ON m.pat = o.pat),
o_newc AS (
  SELECT lower(customer_name) AS lname, MIN(customer_name) AS customer_name,
    MIN(customer_type) AS customer_type FROM o_ok2 WHERE ck IS NULL GROUP BY 1
),
upload_new_customers AS (
  SELECT CAST(s.base + row_number() OVER (ORDER BY lname) AS BIGINT) AS customer_key,
    CAST(s.base + row_number() OVER (ORDER BY lname) AS BIGINT) AS source_customer_key,
    printf('ZCU-%06d', s.base + row_number() OVER (ORDER BY lname)) AS customer_code,
    customer_name, customer_type, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS VARCHAR) AS phone,
    'Net30' AS payment_terms, 'Standard' AS customer_segment, 'Active' AS customer_status,
    CAST(NULL AS BIGINT) AS geography_key, lname
  FROM o_newc, (SELECT greatest(COALESCE(MAX(source_customer_key), {P.new_customer_key_floor}),
                {P.new_customer_key_floor}) AS base FROM dim_customer) s
),
o_ok3 AS (
  SELECT o.*, COALESCE(o.ck, n.customer_key) AS customer_key FROM o_ok2 o
  LEFT JOIN upload_new_customers n ON n.lname = lower(o.customer_name)
),
o_geo_l AS (SELECT lower(country_region) AS l, MIN(geography_key) AS k FROM dim_geography GROUP BY 1),
o_ter_l AS (SELECT lower(territory_name) AS l, MIN(territory_key) AS k FROM dim_sales_territory GROUP BY 1),
upload_sales_facts AS (
  SELECT o.date_key AS order_date_key, CAST(NULL AS INTEGER) AS ship_date_key, CAST(NULL AS INTEGER) AS due_date_key,
    o.drug_key, o.customer_key, g.k AS geography_key, t.k AS territory_key,
    'UP-' || upper(substr(sha1(CAST(o.date_key AS VARCHAR) || '|' || CAST(o.drug_key AS VARCHAR) || '|'
      || CAST(o.customer_key AS VARCHAR) || '|' || CAST(CAST(o.units_sold AS BIGINT) AS VARCHAR) || '|'
      || CAST(o.unit_price AS VARCHAR) || '|' || CAST(o.net_revenue AS VARCHAR)), 1, 20)) AS source_order_number,
    1 AS source_order_line_num, {_q(P.upload_source_system)} AS source_system,
    CAST(o.units_sold AS BIGINT) AS units_sold, o.unit_price, CAST(o.unit_price_discount_pct AS DECIMAL(8,4))
      AS unit_price_discount_pct, o.gross_revenue, o.discount_amount, o.net_revenue, o.cost_of_goods,
    o.gross_profit, o.gross_margin_pct, o.tax_amount, o.freight_cost, {_q(P.batch_id)} AS etl_batch_id,
    CAST(o.date_key // 10000 AS INTEGER) AS order_year, o._row
  FROM o_ok3 o LEFT JOIN o_geo_l g ON g.l = lower(o.country_region) LEFT JOIN o_ter_l t ON t.l = lower(o.sales_territory_name)
),
upload_sales_insert AS (
  SELECT * EXCLUDE (rn, _row) FROM (
    SELECT *, row_number() OVER (PARTITION BY source_order_number, source_order_line_num, source_system ORDER BY _row) AS rn
    FROM upload_sales_facts) x
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM fact_drug_sales f WHERE f.source_order_number = x.source_order_number
    AND f.source_order_line_num = x.source_order_line_num AND f.source_system = x.source_system)
)
"""

UPLOAD_REJECTS = UPLOAD_CTES + """SELECT reason, CAST(COUNT(*) AS BIGINT) AS rows FROM (
  SELECT reject_reason AS reason FROM o_up2 WHERE reject_reason IS NOT NULL
  UNION ALL SELECT CASE WHEN drug_key IS NULL THEN 'Drug not found' ELSE 'Date not in dim_date' END
  FROM o_res2 WHERE drug_key IS NULL OR dk_ok IS NULL) x GROUP BY reason"""

INV_CTES = """
, o_latest AS (
  SELECT drug_key, units_on_hand FROM (SELECT drug_key, units_on_hand,
    row_number() OVER (PARTITION BY drug_key ORDER BY snapshot_date_key DESC) AS rn FROM fact_inventory) x WHERE rn = 1
),
o_iu0 AS (
  SELECT d.drug_name, '2025-06-01' AS snapshot_date, CAST(COALESCE(l.units_on_hand, 0) AS VARCHAR) AS units_on_hand,
    CAST(p_size * 10 AS VARCHAR) AS units_ordered, CAST(p_size % 7 AS VARCHAR) AS units_dispatched,
    CAST(d.unit_cost AS VARCHAR) AS unit_cost, d.drug_key * 2 AS rowno, p_partkey
  FROM dim_drug d LEFT JOIN o_latest l ON l.drug_key = d.drug_key JOIN part ON d.drug_key = p_partkey + 1
),
o_iu AS (
  SELECT drug_name, snapshot_date, units_on_hand, units_ordered, units_dispatched, unit_cost, rowno FROM o_iu0
  UNION ALL SELECT drug_name, snapshot_date, CAST(CAST(units_on_hand AS INTEGER) + 5 AS VARCHAR), units_ordered,
    units_dispatched, unit_cost, rowno + 1 FROM o_iu0 WHERE p_partkey % 37 = 0
),
o_iu1 AS (
  SELECT drug_name AS raw_name, trim(drug_name) AS drug_name, CAST(try_strptime(trim(snapshot_date), '%Y-%m-%d') AS DATE) AS sd,
    greatest(COALESCE(TRY_CAST(trim(units_on_hand) AS DECIMAL(18,4)), 0), 0) AS oh,
    greatest(COALESCE(TRY_CAST(trim(units_ordered) AS DECIMAL(18,4)), 0), 0) AS ord,
    greatest(COALESCE(TRY_CAST(trim(units_dispatched) AS DECIMAL(18,4)), 0), 0) AS dsp,
    COALESCE(TRY_CAST(trim(unit_cost) AS DECIMAL(18,4)), 0) AS uc, rowno
  FROM o_iu
),
o_iu2 AS (
  SELECT i.*, SUM(dsp) OVER (PARTITION BY raw_name) AS sd_sum, COUNT(dsp) OVER (PARTITION BY raw_name) AS sd_cnt
  FROM o_iu1 i WHERE sd IS NOT NULL AND COALESCE(trim(drug_name), '') <> ''
),
upload_inventory_clean AS (
  SELECT drug_name, sd AS snapshot_date, CAST(oh AS BIGINT) AS units_on_hand, CAST(ord AS BIGINT) AS units_ordered,
    CAST(dsp AS BIGINT) AS units_dispatched, CAST(round(oh * uc, 4) AS DECIMAL(18,4)) AS stock_value,
    CAST(CASE WHEN sd_sum > 0 THEN CAST((2 * CAST(oh AS HUGEINT) * sd_cnt * 100 + CAST(sd_sum AS HUGEINT))
      // (2 * CAST(sd_sum AS HUGEINT)) AS DECIMAL(18,0)) * 0.01 END AS DECIMAL(10,2)) AS days_of_supply,
    CASE WHEN oh <= 0 THEN 'Out of Stock' WHEN oh < 50 THEN 'Critical' WHEN oh < 150 THEN 'Low Stock'
         WHEN oh > 5000 THEN 'Overstock' ELSE 'In Stock' END AS stock_status,
    CAST(strftime(sd, '%Y%m%d') AS INTEGER) AS date_key, rowno AS _ord
  FROM (SELECT *, row_number() OVER (PARTITION BY trim(drug_name), CAST(strftime(sd, '%Y%m%d') AS INTEGER)
        ORDER BY rowno DESC) AS rn FROM o_iu2 WHERE sd IS NOT NULL) x WHERE rn = 1
),
o_inv_new AS (
  SELECT c.date_key AS snapshot_date_key, e.k AS drug_key, c.units_on_hand, c.units_ordered, c.units_dispatched,
    0 AS safety_stock_level, 0 AS reorder_point, c.stock_value, c.days_of_supply, c.stock_status,
    '""" + P.batch_id + """' AS etl_batch_id, CAST(c.date_key // 10000 AS INTEGER) AS snapshot_year, c._ord
  FROM upload_inventory_clean c JOIN o_exact e ON e.ln = lower(c.drug_name) JOIN dim_date dd ON dd.date_key = c.date_key
),
o_inv_new1 AS (
  SELECT * EXCLUDE (rn, _ord) FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_date_key, drug_key ORDER BY _ord DESC)
    AS rn FROM o_inv_new) x WHERE rn = 1
)
"""

INV_MERGE = UPLOAD_CTES + INV_CTES + """
SELECT COALESCE(t.snapshot_date_key, n.snapshot_date_key) AS snapshot_date_key, COALESCE(t.drug_key, n.drug_key) AS drug_key,
  CASE WHEN n.drug_key IS NOT NULL THEN n.units_on_hand ELSE t.units_on_hand END AS units_on_hand,
  CASE WHEN n.drug_key IS NOT NULL THEN n.units_ordered ELSE t.units_ordered END AS units_ordered,
  CASE WHEN n.drug_key IS NOT NULL THEN n.units_dispatched ELSE t.units_dispatched END AS units_dispatched,
  CASE WHEN t.drug_key IS NOT NULL THEN t.safety_stock_level ELSE n.safety_stock_level END AS safety_stock_level,
  CASE WHEN t.drug_key IS NOT NULL THEN t.reorder_point ELSE n.reorder_point END AS reorder_point,
  CASE WHEN n.drug_key IS NOT NULL THEN n.stock_value ELSE t.stock_value END AS stock_value,
  CASE WHEN n.drug_key IS NOT NULL THEN n.days_of_supply ELSE t.days_of_supply END AS days_of_supply,
  CASE WHEN n.drug_key IS NOT NULL THEN n.stock_status ELSE t.stock_status END AS stock_status,
  CASE WHEN n.drug_key IS NOT NULL THEN n.etl_batch_id ELSE t.etl_batch_id END AS etl_batch_id,
  COALESCE(t.snapshot_year, n.snapshot_year) AS snapshot_year,
  CASE WHEN t.drug_key IS NOT NULL AND n.drug_key IS NOT NULL THEN 'update' WHEN n.drug_key IS NOT NULL THEN 'insert'
       ELSE 'keep' END AS _action
FROM fact_inventory t FULL OUTER JOIN o_inv_new1 n
  ON t.snapshot_date_key = n.snapshot_date_key AND t.drug_key = n.drug_key"""

# what became of the rows of the two uploads (the target's keys are those of the star: the reload adds none of theirs)
OUTCOME_CTES = UPLOAD_CTES + INV_CTES + """
, o_first AS (SELECT *, row_number() OVER (PARTITION BY source_order_number ORDER BY _row) AS nth FROM upload_sales_facts),
o_known AS (SELECT f.*, EXISTS (SELECT 1 FROM fact_drug_sales x WHERE x.source_order_number = f.source_order_number
  AND x.source_order_line_num = f.source_order_line_num AND x.source_system = f.source_system) AS there FROM o_first f),
o_iu3 AS (
  SELECT i.*, COALESCE(e.k, -1) AS dk, CASE WHEN sd IS NULL THEN 'bad_dates' WHEN COALESCE(drug_name, '') = '' THEN 'null_critical' END AS bad,
    dd.date_key AS day_ok, CAST(strftime(sd, '%Y%m%d') AS INTEGER) AS day
  FROM o_iu1 i LEFT JOIN o_exact e ON e.ln = lower(i.drug_name)
    LEFT JOIN dim_date dd ON dd.date_key = CAST(strftime(sd, '%Y%m%d') AS INTEGER)),
o_iu4 AS (SELECT *, CASE WHEN bad IS NULL THEN row_number() OVER (PARTITION BY bad IS NULL, drug_name, day ORDER BY rowno DESC) END AS nth
  FROM o_iu3),
o_iu5 AS (
  SELECT *, CASE WHEN bad IS NOT NULL THEN 'removed' WHEN nth > 1 THEN 'duplicate' WHEN dk < 0 OR day_ok IS NULL THEN 'skipped'
      WHEN EXISTS (SELECT 1 FROM fact_inventory t WHERE t.drug_key = dk AND t.snapshot_date_key = day) THEN 'updated'
      ELSE 'inserted' END AS outcome,
    CASE WHEN bad IS NOT NULL THEN bad WHEN nth > 1 THEN 'repeated drug and date' WHEN dk < 0 THEN 'Drug not found'
      WHEN day_ok IS NULL THEN 'Date not in dim_date' END AS reason FROM o_iu4),
o_outcomes AS (
  SELECT 'sales' AS upload, 'removed' AS outcome, reject_reason AS reason FROM o_up2 WHERE reject_reason IS NOT NULL
  UNION ALL SELECT 'sales', 'skipped', CASE WHEN drug_key IS NULL THEN 'Drug not found' ELSE 'Date not in dim_date' END
    FROM o_res2 WHERE drug_key IS NULL OR dk_ok IS NULL
  UNION ALL SELECT 'sales', CASE WHEN nth > 1 THEN 'duplicate' WHEN there THEN 'known' ELSE 'inserted' END,
    CASE WHEN nth > 1 THEN 'repeated order line' WHEN there THEN 'already loaded' END FROM o_known
  UNION ALL SELECT 'inventory', outcome, reason FROM o_iu5)
"""
UPLOAD_REPORT = OUTCOME_CTES + """SELECT upload, outcome, reason, CAST(COUNT(*) AS BIGINT) AS rows FROM o_outcomes GROUP BY ALL
UNION ALL SELECT upload, 'read', NULL, CAST(COUNT(*) AS BIGINT) FROM o_outcomes GROUP BY upload"""
INVENTORY_REJECTS = OUTCOME_CTES + """SELECT o.outcome, o.reason, i.drug_name, i.snapshot_date, i.units_on_hand, i.units_ordered,
  i.units_dispatched, i.unit_cost FROM o_iu5 o JOIN o_iu i ON i.rowno = o.rowno WHERE o.outcome IN ('removed', 'duplicate', 'skipped')"""

AUDIT_CTE = _audit(OUTCOME_CTES + RELOAD_CTE + ", " + _first_load(_LOAD_ORDER) + """,
o_runs AS (
  SELECT audit_id, 'FIRST_LOAD' AS batch, table_name, n AS r, n AS i, 0 AS u, 0 AS s, '2025-06-28 06:00:00' AS ts FROM o_audit0
  UNION ALL SELECT a.audit_id + 8, 'RELOAD', t, r, i, u, s, '2025-06-29 06:00:00' FROM o_reload JOIN o_audit0 a ON a.table_name = t
  UNION ALL SELECT CASE upload WHEN 'sales' THEN 17 ELSE 18 END, 'UPLOADS', CASE upload WHEN 'sales' THEN 'fact_drug_sales'
      ELSE 'fact_inventory' END, COUNT(*), COUNT(*) FILTER (WHERE outcome = 'inserted'), COUNT(*) FILTER (WHERE outcome = 'updated'),
    COUNT(*) FILTER (WHERE outcome NOT IN ('inserted', 'updated')), '2025-06-30 06:00:00' FROM o_outcomes GROUP BY upload)""")
AUDIT_LOG = AUDIT_CTE + "SELECT * FROM o_audit"
AUDIT_FIRST = AUDIT_CTE + "SELECT * FROM o_audit WHERE batch_id = 'FIRST_LOAD'"
RECENT_RUNS = AUDIT_CTE + """SELECT batch_id, pipeline_step AS step, table_name AS "table", rows_read, rows_inserted,
  rows_updated, rows_rejected, status, started_at, duration_seconds AS secs
  FROM o_audit ORDER BY started_at DESC, audit_id DESC LIMIT 30"""
TIMELINE = AUDIT_CTE + """SELECT CAST(started_at AS DATE) AS day, COUNT(*) AS runs, CAST(SUM(rows_inserted) AS BIGINT) AS inserted,
  CAST(SUM(rows_rejected) AS BIGINT) AS rejected FROM o_audit WHERE started_at IS NOT NULL
  GROUP BY 1 ORDER BY day DESC LIMIT 30"""

_COLUMNS = {
    "dim_date": """date_key int, full_date date, calendar_year int, calendar_quarter int, calendar_month int,
        month_name string, month_abbr string, month_num int, day_of_month int, day_of_week int, day_name
        string, week_of_year int, quarter_num int, quarter_label string, is_weekend boolean, fiscal_year
        int, fiscal_quarter int""",
    "dim_geography": """geography_key bigint, source_geo_key bigint, city string, state_province string, country_region
        string, postal_code string, region_type string, distribution_zone string""",
    "dim_sales_territory": """territory_key bigint, source_territory_key bigint, territory_name string, territory_country string,
        territory_group string""",
    "dim_therapeutic_class": """therapeutic_class_key bigint, source_category_key bigint, source_subcategory_key bigint, class_code
        string, therapeutic_class string, therapeutic_subclass string, regulatory_category string, atc_code
        string""",
    "dim_drug": """drug_key bigint, source_product_key bigint, drug_code string, drug_name string, dosage_form string,
        dosage_strength string, therapeutic_class_key bigint, source_subcat_key bigint, unit_price
        decimal(18,4), unit_cost decimal(18,4), standard_cost decimal(18,4), manufacturer string,
        drug_status string""",
    "dim_customer": """customer_key bigint, source_customer_key bigint, customer_code string, customer_name string,
        customer_type string, email string, phone string, payment_terms string, customer_segment string,
        customer_status string, geography_key bigint""",
    "fact_drug_sales": """order_date_key int, ship_date_key int, due_date_key int, drug_key bigint, customer_key bigint,
        geography_key bigint, territory_key bigint, source_order_number string, source_order_line_num
        bigint, source_system string, units_sold bigint, unit_price decimal(18,4), unit_price_discount_pct
        decimal(8,4), gross_revenue decimal(18,4), discount_amount decimal(18,4), net_revenue decimal(18,4),
        cost_of_goods decimal(18,4), gross_profit decimal(18,4), gross_margin_pct decimal(8,4), tax_amount
        decimal(18,4), freight_cost decimal(18,4), etl_batch_id string, order_year int""",
    "fact_inventory": """snapshot_date_key int, drug_key bigint, units_on_hand bigint, units_ordered bigint, units_dispatched
        bigint, safety_stock_level int, reorder_point int, stock_value decimal(18,4), days_of_supply
        decimal(10,2), stock_status string, etl_batch_id string, snapshot_year int""",
}


def _columns(t: str) -> str:
    cols = [c.split() for c in re.split(r",\s+", _COLUMNS[t])]
    return "\nUNION ALL ".join(f"SELECT '{t}' AS \"table\", {i} AS position, '{c}' AS \"column\", '{k}' AS type, COUNT({c}) AS filled FROM {t}"
                               for i, (c, k) in enumerate(cols, start=1))


SCHEMA_COLUMNS = "\nUNION ALL ".join(_columns(t) for t in _LOAD_ORDER)

# scans of the source layer
SCANS = {
    "scan_geography": """SELECT CAST(gk AS BIGINT) AS "GeographyKey", city AS "City", state AS "StateProvinceName",
  country AS "CountryRegion", postal AS "PostalCode", CAST(n_regionkey + 1 AS BIGINT) AS "SalesTerritoryKey"
  FROM o_geo JOIN nation ON n_nationkey + 1 = gk""",
    "scan_territory": """SELECT CAST(r_regionkey + 1 AS BIGINT) AS "SalesTerritoryKey", r_name AS "TerritoryName",
  r_name AS "TerritoryCountry", 'Group ' || (r_regionkey % 2) AS "TerritoryGroup" FROM region""",
    "scan_categories": """SELECT ck AS "ProductCategoryKey", cname AS "CategoryName", sk AS "ProductSubcategoryKey",
  sname AS "SubcategoryName", COUNT(*) AS products FROM o_subcat JOIN o_cat USING (ck) JOIN o_prod ON sub_key = sk
  WHERE pk % 103 <> 0 GROUP BY ck, cname, sk, sname""",
    "scan_product": """SELECT CAST(pk AS BIGINT) AS "ProductKey", 'PRD-' || p_partkey AS "ProductAlternateKey", pname AS "ProductName",
  color AS "Color", size AS "Size", price AS "ListPrice", cost AS "StandardCost", dealer AS "DealerPrice",
  sub_key AS "ProductSubcategoryKey", status AS "Status", TRUE AS "FinishedGoodsFlag", p_type AS "ProductLine"
  FROM o_prod JOIN part ON p_partkey + 1 = pk WHERE pk % 103 <> 0""",
    "scan_customer": """SELECT CAST(c_custkey * 17 + 1 AS BIGINT) AS "CustomerKey",
  CASE WHEN c_custkey % 101 <> 0 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS "FirstName",
  CASE WHEN c_custkey % 101 <> 0 THEN c_name END AS "LastName",
  CASE WHEN c_custkey % 101 <> 0 THEN upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' ' || c_name ELSE '' END AS "FullName",
  CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN lower(c_name) || 'example.com'
       ELSE lower(c_name) || '@example.com' END AS "EmailAddress",
  CASE WHEN c_custkey % 5 <> 0 THEN '555-' || (c_custkey * 17 + 1) END AS "Phone",
  CAST(c_nationkey + 1 AS BIGINT) AS "GeographyKey" FROM customer""",
    "scan_internet_sales": f"""SELECT order_num AS "SalesOrderNumber", CAST(line AS INTEGER) AS "SalesOrderLineNumber",
  CAST(pk AS BIGINT) AS "ProductKey", CAST(ck AS BIGINT) AS "CustomerKey", CAST(tk AS BIGINT) AS "SalesTerritoryKey",
  dk - {P.shift_years * 10000} AS "OrderDateKey", sdk - {P.shift_years * 10000} AS "ShipDateKey",
  ddk - {P.shift_years * 10000} AS "DueDateKey", qty AS "OrderQuantity", price AS "UnitPrice", disc AS "UnitPriceDiscountPct",
  ext AS "ExtendedAmount", cost0 AS "TotalProductCost", net AS "SalesAmount",
  CAST(net * CAST(l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS "TaxAmt", CAST(net * 0.025 AS DECIMAL(18,4)) AS "Freight" FROM o_sales""",
    "scan_product_inventory": f"""SELECT CAST(pk AS BIGINT) AS "ProductKey", dk - {P.shift_years * 10000} AS "DateKey",
  units AS "UnitsBalance", cost AS "UnitCost", mv - INTERVAL {P.shift_years} YEAR AS "MovementDate" FROM o_inv""",
}

SQL = {
    **TABLE_SQL,
    "removal_report": REMOVAL_REPORT,
    "extract_summary": EXTRACT_SUMMARY,
    "dq_checks": DQ_CHECKS,
    "dq_score": DQ_SCORE,
    "monitor_checks": MONITOR_CHECKS,
    "post_load_checks": POST_LOAD,
    "null_profile": NULL_PROFILE,
    "reconciliation": RECONCILIATION,
    "source_system_breakdown": SOURCE_SYSTEM,
    "financial_metrics": FINANCIAL,
    "sales_date_range": DATE_RANGE,
    "critical_drugs": CRITICAL,
    "row_counts": ROW_COUNTS,
    "schema_summary": SCHEMA_SUMMARY,
    "adhoc_sql": ADHOC,
    "adhoc_sql_limit": ADHOC_PAGE,
    **SCANS,
    "schema_columns": SCHEMA_COLUMNS,
    "load_summary_reload": RELOAD_SUMMARY,
    "etl_audit_log": AUDIT_LOG,
    "etl_audit_first_load": AUDIT_FIRST,
    "upload_report": UPLOAD_REPORT,
    "upload_inventory_rejects": INVENTORY_REJECTS,
    "recent_etl_runs": RECENT_RUNS,
    "etl_timeline": TIMELINE,
    "upload_sales_clean": UPLOAD_CTES + "SELECT * EXCLUDE (_row) FROM upload_sales_clean",
    "upload_sales_rejects": UPLOAD_REJECTS,
    "upload_new_customers": UPLOAD_CTES + "SELECT * EXCLUDE (lname) FROM upload_new_customers",
    "upload_sales_insert": UPLOAD_CTES + "SELECT * FROM upload_sales_insert",
    "upload_inventory_clean": UPLOAD_CTES + INV_CTES + "SELECT * EXCLUDE (_ord) FROM upload_inventory_clean",
    "upload_inventory_merge": INV_MERGE,
}
