"""Star schema rebuilt in plain SQL (DuckDB dialect) from the driver views.

Written independently of the Spark code path: windows (row_number) for
dedupe and naming, CASE chains for the waterfalls, integer arithmetic for the
half-up margin.  Lookup values are rendered from the fixed-value module.
"""

from __future__ import annotations

from medistar.functions import fixed
from medistar.params import Params
from medistar.sources import adapter


def _q(s) -> str:
    return "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"


def _case(expr: str, mapping: dict, default) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {_q(default)} END)"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_q(x) if not isinstance(x, int) else str(x) for x in r) + ")" for r in rows)


def star_ctes(p: Params | None = None) -> str:
    p = p or Params()
    shift = p.shift_years * 10000
    cls_map = {k: v[0] for k, v in fixed.CATEGORY_TO_CLASS.items()}
    code_map = {k: v[1] for k, v in fixed.CATEGORY_TO_CLASS.items()}
    atc_map = {k: v[2] for k, v in fixed.CATEGORY_TO_CLASS.items()}
    names_rows = ", ".join(f"({_q(k)}, [{', '.join(_q(n) for n in v)}])" for k, v in fixed.DRUG_NAMES.items())
    country_case = "CASE n_nationkey % 9 " + " ".join(
        f"WHEN {i} THEN {_q(c)}" for i, c in enumerate(adapter.COUNTRIES) if c is not None) + " ELSE NULL END"
    color_case = "CASE p_partkey % 9 " + " ".join(
        f"WHEN {i} THEN {_q(c)}" for i, c in enumerate(adapter.COLORS)) + " END"
    ranges = " ".join(f"WHEN ck BETWEEN {lo} AND {hi} THEN {_q(a)}" for lo, hi, a, b in fixed.CUSTOMER_KEY_RANGES)
    seg_ranges = " ".join(f"WHEN ck BETWEEN {lo} AND {hi} THEN {_q(b)}" for lo, hi, a, b in fixed.CUSTOMER_KEY_RANGES)
    suffix = _case("ctype", fixed.CUSTOMER_NAME_SUFFIX, fixed.DEFAULT_CUSTOMER_NAME_SUFFIX)
    codes = "[" + ", ".join(_q(c) for c in fixed.NAME_SUFFIX_CODES) + "]"
    return f"""
WITH
o_cal AS (
  SELECT CAST(t.d AS DATE) AS full_date
  FROM range(DATE '{p.calendar_start}', DATE '{p.calendar_end}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)
),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS calendar_year, CAST(quarter(full_date) AS INTEGER) AS calendar_quarter,
         CAST(month(full_date) AS INTEGER) AS calendar_month, strftime(full_date, '%B') AS month_name,
         strftime(full_date, '%b') AS month_abbr, CAST(month(full_date) AS INTEGER) AS month_num,
         CAST(day(full_date) AS INTEGER) AS day_of_month, CAST(isodow(full_date) AS INTEGER) AS day_of_week,
         strftime(full_date, '%A') AS day_name, CAST(strftime(full_date, '%W') AS INTEGER) AS week_of_year,
         CAST(quarter(full_date) AS INTEGER) AS quarter_num,
         'Q' || quarter(full_date) || ' ' || year(full_date) AS quarter_label,
         isodow(full_date) >= 6 AS is_weekend,
         CAST(CASE WHEN month(full_date) >= 4 THEN year(full_date) ELSE year(full_date) - 1 END AS INTEGER)
           AS fiscal_year,
         CAST(((month(full_date) + 8) % 12) // 3 + 1 AS INTEGER) AS fiscal_quarter
  FROM o_cal
),
o_geo AS (
  SELECT n_nationkey + 1 AS gk, n_name AS city, r_name AS state, {country_case} AS country,
         lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS postal
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
),
dim_geography AS (
  SELECT gk AS geography_key, gk AS source_geo_key,
         trim(regexp_replace(trim(city), '[^\\p{{L}}\\p{{N}}_\\s\\-]', '', 'g')) AS city,
         trim(regexp_replace(trim(state), '[^\\p{{L}}\\p{{N}}_\\s\\-]', '', 'g')) AS state_province,
         trim(country) AS country_region, postal AS postal_code, 'Urban' AS region_type,
         {_case('trim(country)', fixed.COUNTRY_TO_ZONE, fixed.DEFAULT_ZONE)} AS distribution_zone
  FROM o_geo WHERE country IS NOT NULL
),
dim_sales_territory AS (
  SELECT r_regionkey + 1 AS territory_key, r_regionkey + 1 AS source_territory_key,
         r_name AS territory_name, r_name AS territory_country, 'Group ' || (r_regionkey % 2) AS territory_group
  FROM region
),
o_cat(ck, cname) AS (VALUES {_values(adapter.CATEGORIES)}),
o_subcat(sk, ck, sname) AS (VALUES {_values(adapter.SUBCATEGORIES)}),
dim_therapeutic_class AS (
  SELECT s.sk AS therapeutic_class_key, s.ck AS source_category_key, s.sk AS source_subcategory_key,
         {_case('c.cname', code_map, fixed.DEFAULT_CLASS[1])} AS class_code,
         {_case('c.cname', cls_map, fixed.DEFAULT_CLASS[0])} AS therapeutic_class,
         COALESCE({_case('s.sname', fixed.SUBCATEGORY_TO_SUBCLASS, None)}, s.sname) AS therapeutic_subclass,
         {_case(_case('c.cname', cls_map, fixed.DEFAULT_CLASS[0]), fixed.CLASS_TO_REGULATORY, fixed.DEFAULT_REGULATORY)}
           AS regulatory_category,
         {_case('c.cname', atc_map, fixed.DEFAULT_CLASS[2])} AS atc_code
  FROM o_subcat s JOIN o_cat c ON s.ck = c.ck
),
o_names(sname, names) AS (VALUES {names_rows}),
o_prod AS (
  SELECT p_partkey + 1 AS pk,
         CASE WHEN p_partkey % 211 = 0 THEN NULL ELSE p_name END AS pname,
         CASE WHEN p_partkey % 97 = 0 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(p_retailprice AS DECIMAL(18,4)) END AS price,
         CAST(CAST(p_retailprice AS DECIMAL(18,4)) * (CASE WHEN p_partkey % 89 = 0 THEN 3.6 ELSE 0.6 END) AS DECIMAL(18,4)) AS cost,
         CASE WHEN p_partkey % 83 = 0 THEN CAST(0 AS DECIMAL(18,4))
              ELSE CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.8 AS DECIMAL(18,4)) END AS dealer,
         {color_case} AS color,
         CASE WHEN p_size <= 10 THEN 'S' WHEN p_size <= 20 THEN 'M' WHEN p_size <= 30 THEN 'L'
              WHEN p_size <= 37 THEN 'XL' ELSE CAST(p_size AS VARCHAR) END AS size,
         CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS sub_key,
         CASE WHEN p_partkey % 10 = 0 THEN '0' ELSE 'Current' END AS status
  FROM part
),
o_drug0 AS (
  SELECT p.pk, p.price, p.cost, p.dealer, p.sub_key, p.status,
         {_case('p.color', fixed.COLOR_TO_FORM, fixed.DEFAULT_FORM)} AS form,
         {_case('p.size', fixed.SIZE_TO_STRENGTH, fixed.DEFAULT_STRENGTH)} AS strength,
         COALESCE(s.sname, 'General') AS sname, COALESCE(c.cname, 'General') AS cname
  FROM o_prod p LEFT JOIN o_subcat s ON p.sub_key = s.sk LEFT JOIN o_cat c ON s.ck = c.ck
  WHERE p.pname IS NOT NULL AND trim(p.pname) <> '' AND p.price > 0
),
o_drug1 AS (
  SELECT d.*, list_extract(COALESCE(n.names, g.names), (d.pk % len(COALESCE(n.names, g.names))) + 1)
              || ' ' || d.strength || ' ' || d.form AS base_name,
         list_extract({codes}, (d.pk % 10) + 1) AS code
  FROM o_drug0 d LEFT JOIN o_names n ON n.sname = d.sname
       CROSS JOIN (SELECT names FROM o_names WHERE sname = 'General') g
),
o_drug2 AS (
  SELECT *, row_number() OVER (PARTITION BY base_name ORDER BY pk) AS rn_base FROM o_drug1
),
o_drug3 AS (
  SELECT *, row_number() OVER (PARTITION BY base_name, code, rn_base = 1 ORDER BY pk) AS rn_code FROM o_drug2
),
dim_drug AS (
  SELECT CAST(d.pk AS BIGINT) AS drug_key, CAST(d.pk AS BIGINT) AS source_product_key,
         substr({_case('d.cname', atc_map, fixed.DEFAULT_CLASS[2])}, 1, 1) || '-' || printf('%04d', d.pk) AS drug_code,
         CASE WHEN rn_base = 1 THEN base_name
              WHEN rn_code = 1 THEN base_name || ' (' || code || ')'
              ELSE base_name || ' [' || d.pk || ']' END AS drug_name,
         form AS dosage_form, strength AS dosage_strength,
         COALESCE(t.therapeutic_class_key, 1) AS therapeutic_class_key, d.sub_key AS source_subcat_key,
         price AS unit_price,
         CAST(CASE WHEN greatest(cost, 0) > price * 3 THEN round(price * 0.70, 4) ELSE greatest(cost, 0) END
              AS DECIMAL(18,4)) AS unit_cost,
         CAST(CASE WHEN dealer IS NULL OR dealer <= 0 THEN price ELSE dealer END AS DECIMAL(18,4)) AS standard_cost,
         {_q(p.manufacturer)} AS manufacturer,
         CASE WHEN status = '0' THEN 'Discontinued' ELSE 'Active' END AS drug_status
  FROM o_drug3 d LEFT JOIN dim_therapeutic_class t ON t.source_subcategory_key = d.sub_key
),
o_cust0 AS (
  SELECT c_custkey * 17 + 1 AS ck,
         CASE WHEN c_custkey % 101 = 0 THEN NULL
              ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS first_name,
         CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE c_name END AS last_name,
         CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN lower(c_name) || 'example.com'
              ELSE lower(c_name) || '@example.com' END AS email,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '555-' || (c_custkey * 17 + 1) END AS phone,
         c_nationkey + 1 AS gk
  FROM customer
),
o_cust1 AS (
  SELECT *, trim(COALESCE(first_name, '') || ' ' || COALESCE(last_name, '')) AS full_name,
         CASE {ranges} ELSE {_q(fixed.DEFAULT_CUSTOMER_TYPE[0])} END AS ctype,
         CASE {seg_ranges} ELSE {_q(fixed.DEFAULT_CUSTOMER_TYPE[1])} END AS seg
  FROM o_cust0
),
dim_customer AS (
  SELECT CAST(ck AS BIGINT) AS customer_key, CAST(ck AS BIGINT) AS source_customer_key, printf('ZCU-%06d', ck) AS customer_code,
         substr(split_part(full_name, ' ', 1) || ' ' || {suffix} || ' #' || ck, 1, 200) AS customer_name,
         ctype AS customer_type,
         CASE WHEN email IS NULL OR email = '' OR position('@' IN email) = 0 THEN NULL ELSE email END AS email,
         phone, 'Net30' AS payment_terms, seg AS customer_segment, 'Active' AS customer_status,
         g.geography_key
  FROM o_cust1 LEFT JOIN dim_geography g ON g.source_geo_key = o_cust1.gk
  WHERE full_name <> '' AND full_name <> 'Unknown Unknown'
),
o_sales AS (
  SELECT CASE WHEN l_orderkey % 499 = 0 THEN NULL ELSE 'SO' || l_orderkey END AS order_num,
         l_linenumber AS line,
         CASE WHEN (l_orderkey + l_linenumber) % 313 = 0 THEN -1 ELSE l_partkey + 1 END AS pk,
         o_custkey * 17 + 1 AS ck, n_regionkey + 1 AS tk,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) + {shift} AS dk,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) + {shift} AS sdk,
         CAST(strftime(o_orderdate + INTERVAL 12 DAY, '%Y%m%d') AS INTEGER) + {shift} AS ddk,
         CASE WHEN (l_orderkey + l_linenumber) % 307 = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS qty,
         CASE WHEN (l_orderkey + l_linenumber) % 311 = 0 THEN CAST(0 AS DECIMAL(18,4))
              ELSE CAST(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) * 100) // CAST(l_quantity AS BIGINT)
                             AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(18,4)) END AS price,
         CAST(l_discount AS DECIMAL(18,4)) AS disc,
         CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END AS ext,
         CAST(CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.6 AS DECIMAL(18,4)) * CAST(l_quantity AS DECIMAL(18,4))
              AS DECIMAL(18,4)) AS cost0,
         CASE WHEN (l_orderkey + l_linenumber) % 317 = 0 THEN CAST(-1 AS DECIMAL(18,4))
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4)))
                        AS DECIMAL(18,4)) END AS net,
         l_tax,
         l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN part ON l_partkey = p_partkey
),
o_sales_ok AS (
  SELECT s.*, dr.drug_key, cu.customer_key, cu.geography_key,
         CASE WHEN s.net > 0 AND greatest(s.cost0, 0) > s.net * 2 THEN CAST(round(s.net * 0.60, 4) AS DECIMAL(18,4))
              ELSE CAST(greatest(s.cost0, 0) AS DECIMAL(18,4)) END AS cost
  FROM o_sales s
       LEFT JOIN dim_drug dr ON dr.source_product_key = s.pk
       LEFT JOIN dim_customer cu ON cu.source_customer_key = s.ck
       LEFT JOIN dim_date dd ON dd.date_key = s.dk
  WHERE s.order_num IS NOT NULL AND dr.drug_key IS NOT NULL AND cu.customer_key IS NOT NULL
    AND dd.date_key IS NOT NULL AND s.dk <= {p.as_of_key} AND s.qty > 0 AND s.price > 0 AND s.net >= 0
),
o_sales_rn AS (
  SELECT *, row_number() OVER (PARTITION BY order_num, line
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax,
                     l_returnflag, l_linestatus) AS rn
  FROM o_sales_ok
),
fact_drug_sales AS (
  SELECT s.dk AS order_date_key, ds.date_key AS ship_date_key, du.date_key AS due_date_key,
         s.drug_key, s.customer_key, s.geography_key, t.territory_key,
         s.order_num AS source_order_number, s.line AS source_order_line_num, {_q(p.source_system)} AS source_system,
         s.qty AS units_sold, s.price AS unit_price,
         CAST(least(greatest(s.disc * 100, 0), 100) AS DECIMAL(8,4)) AS unit_price_discount_pct,
         CAST(COALESCE(s.ext, s.price * s.qty) AS DECIMAL(18,4)) AS gross_revenue,
         CAST(round(COALESCE(s.ext, s.price * s.qty) * s.disc, 4) AS DECIMAL(18,4)) AS discount_amount,
         s.net AS net_revenue, s.cost AS cost_of_goods, CAST(s.net - s.cost AS DECIMAL(18,4)) AS gross_profit,
         CAST(CASE WHEN s.net > 0 THEN
              CAST(sign(CAST((s.net - s.cost) * 10000 AS HUGEINT))
                   * ((2 * abs(CAST((s.net - s.cost) * 10000 AS HUGEINT)) * 1000000 + CAST(s.net * 10000 AS HUGEINT))
                      // (2 * CAST(s.net * 10000 AS HUGEINT))) AS DECIMAL(18,0)) * 0.0001
              ELSE 0 END AS DECIMAL(8,4)) AS gross_margin_pct,
         CAST(s.net * CAST(s.l_tax AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS tax_amount,
         CAST(s.net * 0.025 AS DECIMAL(18,4)) AS freight_cost,
         {_q(p.batch_id)} AS etl_batch_id, CAST(s.dk // 10000 AS INTEGER) AS order_year
  FROM o_sales_rn s
       LEFT JOIN dim_date ds ON ds.date_key = s.sdk
       LEFT JOIN dim_date du ON du.date_key = s.ddk
       LEFT JOIN dim_sales_territory t ON t.source_territory_key = s.tk
  WHERE s.rn = 1
),
o_inv_pm AS (
  SELECT l_partkey, date_trunc('month', l_shipdate) AS m, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2
),
o_inv0 AS (
  SELECT p_partkey + 1 AS pk, CAST(strftime(m, '%Y%m%d') AS INTEGER) + {shift} AS dk,
         CAST(q * p_size * 3 - 30 AS BIGINT) AS units,
         CASE WHEN p_partkey % 79 = 0 THEN -CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.6 AS DECIMAL(18,4))
              ELSE CAST(CAST(p_retailprice AS DECIMAL(18,4)) * 0.6 AS DECIMAL(18,4)) END AS cost,
         CAST(m AS TIMESTAMP) + INTERVAL {p.shift_years} YEAR AS mv, p_partkey
  FROM o_inv_pm JOIN part ON l_partkey = p_partkey
),
o_inv AS (
  SELECT pk, dk, units, cost, mv FROM o_inv0
  UNION ALL
  SELECT pk, dk, units + 1, cost, CAST(mv - INTERVAL {p.shift_years} YEAR + INTERVAL 1 DAY AS TIMESTAMP)
         + INTERVAL {p.shift_years} YEAR FROM o_inv0 WHERE p_partkey % 61 = 0
),
o_inv_rn AS (
  SELECT i.*, dr.drug_key,
         row_number() OVER (PARTITION BY i.dk, dr.drug_key ORDER BY i.mv DESC, i.units DESC, i.cost DESC) AS rn
  FROM o_inv i JOIN dim_drug dr ON dr.source_product_key = i.pk JOIN dim_date dd ON dd.date_key = i.dk
  WHERE i.dk <= {p.as_of_key}
),
fact_inventory AS (
  SELECT dk AS snapshot_date_key, drug_key, CAST(greatest(units, 0) AS BIGINT) AS units_on_hand,
         0 AS units_ordered, 0 AS units_dispatched, 0 AS safety_stock_level, 0 AS reorder_point,
         CAST(greatest(units, 0) * greatest(cost, 0) AS DECIMAL(18,4)) AS stock_value,
         CAST(NULL AS DECIMAL(10,2)) AS days_of_supply,
         CASE WHEN greatest(units, 0) <= 0 THEN 'Out of Stock' WHEN greatest(units, 0) < 50 THEN 'Critical'
              WHEN greatest(units, 0) < 150 THEN 'Low Stock' WHEN greatest(units, 0) > 5000 THEN 'Overstock'
              ELSE 'In Stock' END AS stock_status,
         {_q(p.batch_id)} AS etl_batch_id, CAST(dk // 10000 AS INTEGER) AS snapshot_year
  FROM o_inv_rn WHERE rn = 1
)
"""
