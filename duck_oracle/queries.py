"""Final SELECTs of the oracle, one per registry key, run after ``star_ctes``."""

from __future__ import annotations

WM = ("CASE WHEN SUM(f.net_revenue) = 0 THEN 0.0 ELSE CAST(SUM(f.gross_profit) AS DOUBLE) * 100.0 "
      "/ CAST(SUM(f.net_revenue) AS DOUBLE) END")
SEV = ("CASE stock_status WHEN 'Out of Stock' THEN 1 WHEN 'Critical' THEN 2 ELSE 3 END")
FD = "fact_drug_sales f JOIN dim_date d ON f.order_date_key = d.date_key"
DC = ("dim_drug dr JOIN dim_therapeutic_class t ON dr.therapeutic_class_key = t.therapeutic_class_key")


def _dsum(c):
    return f"CAST(SUM({c}) AS DOUBLE)"


def _lsum(c):
    return f"CAST(SUM({c}) AS BIGINT)"


def _mean(c):
    return f"CAST(SUM({c}) AS DOUBLE) / COUNT({c})"


def _date_where(start=None, end=None):
    w = []
    if start:
        w.append(f"d.full_date >= DATE '{start}'")
    if end:
        w.append(f"d.full_date <= DATE '{end}'")
    return ("WHERE " + " AND ".join(w)) if w else ""


def kpi_summary(start=None, end=None):
    return f"""SELECT {_dsum('f.net_revenue')} AS rev, {_dsum('f.gross_profit')} AS prof, {WM} AS mgn,
      COUNT(*) AS orders, {_lsum('f.units_sold')} AS units, COUNT(DISTINCT f.customer_key) AS custs,
      COUNT(DISTINCT f.drug_key) AS drugs FROM {FD} {_date_where(start, end)}"""


STOCK_RISK = """SELECT COUNT(*) FILTER (WHERE stock_status = 'Out of Stock') AS out_of_stock,
  COUNT(*) FILTER (WHERE stock_status IN ('Low Stock', 'Critical')) AS low_or_critical FROM fact_inventory"""

# FIL-1 as of 2025-06-30
RANGES = {
    "All Time": ("2005-01-01", "2025-06-30"), "Today": ("2025-06-30", "2025-06-30"),
    "Yesterday": ("2025-06-29", "2025-06-29"), "Last 7 Days": ("2025-06-23", "2025-06-30"),
    "Last 30 Days": ("2025-05-31", "2025-06-30"), "Last 90 Days": ("2025-04-01", "2025-06-30"),
    "Last 6 Months": ("2025-01-01", "2025-06-30"), "This Year": ("2025-01-01", "2025-06-30"),
    "Last Year": ("2024-01-01", "2024-12-31"),
}


def _kpis_within(name, start, end):
    return f"""SELECT '{name}' AS preset, {_dsum('f.net_revenue')} AS revenue, {_dsum('f.gross_profit')} AS profit,
      {WM} AS margin_pct, COUNT(*) AS orders, {_lsum('f.units_sold')} AS units,
      COUNT(DISTINCT f.customer_key) AS customers, COUNT(DISTINCT f.drug_key) AS drugs
      FROM {FD} {_date_where(start, end)}"""


SQL = {
    "kpi_by_preset": " UNION ALL ".join(_kpis_within(p, a, b) for p, (a, b) in RANGES.items()),
    "calendar_activity": f"""SELECT d.date_key, d.full_date, d.calendar_year, d.month_num,
      (SELECT COUNT(*) FROM fact_drug_sales f WHERE f.order_date_key = d.date_key) AS sales_lines,
      (SELECT {_dsum('f.net_revenue')} FROM fact_drug_sales f WHERE f.order_date_key = d.date_key) AS revenue,
      (SELECT COUNT(*) FROM fact_inventory i WHERE i.snapshot_date_key = d.date_key) AS stock_rows FROM dim_date d""",
    "class_activity": f"""SELECT t.therapeutic_class_key, t.therapeutic_class,
      (SELECT COUNT(*) FROM dim_drug dr WHERE dr.therapeutic_class_key = t.therapeutic_class_key) AS drugs,
      COUNT(f.drug_key) AS sales_lines, {_dsum('f.net_revenue')} AS revenue
      FROM dim_therapeutic_class t LEFT JOIN (SELECT dr.therapeutic_class_key, f.drug_key, f.net_revenue
        FROM fact_drug_sales f JOIN dim_drug dr ON f.drug_key = dr.drug_key) f
      ON f.therapeutic_class_key = t.therapeutic_class_key GROUP BY t.therapeutic_class_key, t.therapeutic_class""",
    "kpi_summary": kpi_summary(),
    "kpi_summary_last_year": kpi_summary("2024-01-01", "2024-12-31"),
    "kpi_insights": f"""SELECT CASE WHEN k.orders = 0 THEN 0.0 ELSE COALESCE(k.rev, 0.0) / k.orders END AS avg_order_value,
      CASE WHEN COALESCE(k.units, 0) = 0 THEN 0.0 ELSE k.prof / k.units END AS profit_per_unit,
      r.out_of_stock + r.low_or_critical AS inventory_risk
      FROM ({kpi_summary()}) k, ({STOCK_RISK}) r""",
    "stock_risk_counts": STOCK_RISK,
    "monthly_trend": f"""SELECT d.calendar_year || '-' || lpad(CAST(d.month_num AS VARCHAR), 2, '0') AS period,
      d.calendar_year, d.month_num, {_dsum('f.net_revenue')} AS revenue, {_dsum('f.gross_profit')} AS profit,
      {_lsum('f.units_sold')} AS units FROM {FD} GROUP BY d.calendar_year, d.month_num""",
    "top_drugs": f"""SELECT dr.drug_name, {_dsum('f.net_revenue')} AS rev, {_lsum('f.units_sold')} AS units,
      {_mean('f.gross_margin_pct')} AS mgn
      FROM {FD} JOIN dim_drug dr ON f.drug_key = dr.drug_key
      GROUP BY dr.drug_name ORDER BY rev DESC, dr.drug_name LIMIT 5""",
    "top_drugs_dashboard": f"""SELECT dr.drug_name, {_dsum('f.net_revenue')} AS rev, {_lsum('f.units_sold')} AS units,
      {_mean('f.gross_margin_pct')} AS mgn
      FROM {FD} JOIN dim_drug dr ON f.drug_key = dr.drug_key
      GROUP BY dr.drug_name ORDER BY rev DESC, dr.drug_name LIMIT 8""",
    "revenue_by_class_top5": f"""SELECT t.therapeutic_class AS cls, {_dsum('f.net_revenue')} AS rev
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key GROUP BY t.therapeutic_class
      ORDER BY rev DESC, cls LIMIT 5""",
    "drug_matrix_dashboard": f"""SELECT dr.drug_name AS drug, t.therapeutic_class AS cls,
      {_dsum('f.net_revenue')} AS rev, {_dsum('f.gross_profit')} AS prof, {WM} AS mgn, {_lsum('f.units_sold')} AS units
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key
      GROUP BY dr.drug_name, t.therapeutic_class ORDER BY rev DESC, drug, cls LIMIT 40""",
    "monthly_trend_last_6_months": f"""SELECT d.calendar_year || '-' || lpad(CAST(d.month_num AS VARCHAR), 2, '0') AS period,
      d.calendar_year, d.month_num, {_dsum('f.net_revenue')} AS revenue, {_dsum('f.gross_profit')} AS profit,
      {_lsum('f.units_sold')} AS units FROM {FD}
      WHERE d.full_date BETWEEN DATE '2025-01-01' AND DATE '2025-06-30' GROUP BY d.calendar_year, d.month_num""",
    "customer_lookup_text": """SELECT c.customer_code, c.customer_name, c.customer_type, c.customer_segment, c.email,
      c.payment_terms, c.customer_status, g.country_region, g.city
      FROM dim_customer c LEFT JOIN dim_geography g ON c.geography_key = g.geography_key
      WHERE lower(c.customer_name) LIKE '%household%' AND g.country_region = 'France'
      ORDER BY c.customer_name, c.customer_key LIMIT 200""",
    "drug_lookup_filtered": f"""SELECT dr.drug_code, dr.drug_name, dr.dosage_form, dr.dosage_strength,
      t.therapeutic_class AS class, t.regulatory_category AS regulatory, CAST(dr.unit_price AS DOUBLE) AS price,
      CAST(dr.unit_cost AS DOUBLE) AS cost, dr.drug_status AS status, dr.manufacturer
      FROM {DC} WHERE t.therapeutic_class = 'Antibiotics' AND dr.dosage_form = 'Tablet'
      ORDER BY dr.drug_name, dr.drug_key LIMIT 100""",
    "revenue_by_customer_type": f"""SELECT c.customer_type AS type, {_dsum('f.net_revenue')} AS rev,
      COUNT(DISTINCT f.customer_key) AS custs, COUNT(*) AS orders, {_mean('f.net_revenue')} AS aov
      FROM {FD} JOIN dim_customer c ON f.customer_key = c.customer_key GROUP BY c.customer_type""",
    "revenue_by_class": f"""SELECT t.therapeutic_class AS cls, {_dsum('f.net_revenue')} AS rev
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key GROUP BY t.therapeutic_class""",
    "class_share": f"""SELECT therapeutic_class, CAST(r AS DOUBLE) AS rev,
      CAST(r AS DOUBLE) * 100.0 / CAST(SUM(r) OVER () AS DOUBLE) AS pct FROM (
      SELECT t.therapeutic_class, SUM(f.net_revenue) AS r FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key
      GROUP BY t.therapeutic_class) x""",
    "stock_status_summary": f"""SELECT stock_status, COUNT(*) AS records, COUNT(DISTINCT drug_key) AS drugs,
      {_lsum('units_on_hand')} AS units, {_dsum('stock_value')} AS value FROM fact_inventory GROUP BY stock_status""",
    "drug_matrix": f"""SELECT dr.drug_name AS drug, t.therapeutic_class AS cls, dr.dosage_form AS form,
      {_dsum('f.net_revenue')} AS rev, {_dsum('f.gross_profit')} AS prof, {WM} AS mgn, {_lsum('f.units_sold')} AS units
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key
      GROUP BY dr.drug_name, t.therapeutic_class, dr.dosage_form ORDER BY rev DESC, drug, cls, form LIMIT 25""",
    "revenue_by_country": f"""SELECT g.country_region AS country, {_lsum('f.units_sold')} AS units,
      {_dsum('f.net_revenue')} AS rev FROM {FD} JOIN dim_geography g ON f.geography_key = g.geography_key
      GROUP BY g.country_region""",
    "revenue_by_year_yoy": f"""SELECT yr, rev, prof, orders, units,
      COALESCE((rev - lag(rev) OVER (ORDER BY yr)) / lag(rev) OVER (ORDER BY yr) * 100.0, 0.0) AS growth FROM (
      SELECT d.calendar_year AS yr, {_dsum('f.net_revenue')} AS rev, {_dsum('f.gross_profit')} AS prof,
      COUNT(*) AS orders, {_lsum('f.units_sold')} AS units FROM {FD} GROUP BY d.calendar_year) x""",
    "quarterly": f"""SELECT d.quarter_label AS q, d.calendar_year AS yr, {_dsum('f.net_revenue')} AS rev
      FROM {FD} GROUP BY d.calendar_year, d.quarter_num, d.quarter_label""",
    "revenue_by_weekday": f"""SELECT dayname(d.full_date) AS dow, CAST(dayofweek(d.full_date) AS INTEGER) AS dow_num,
      {_mean('f.net_revenue')} AS avg_rev, COUNT(*) AS orders FROM {FD} GROUP BY 1, 2""",
    "inventory_movement": f"""SELECT d.calendar_year || '-' || lpad(CAST(d.month_num AS VARCHAR), 2, '0') AS p,
      {_lsum('fi.units_dispatched')} AS dispatched, {_lsum('fi.units_ordered')} AS ordered,
      {_lsum('fi.units_on_hand')} AS on_hand
      FROM fact_inventory fi JOIN dim_date d ON fi.snapshot_date_key = d.date_key GROUP BY d.calendar_year, d.month_num""",
    "stock_alerts": f"""SELECT dr.drug_name, t.therapeutic_class AS class, fi.stock_status,
      {_lsum('fi.units_on_hand')} AS units, {_dsum('fi.stock_value')} AS value
      FROM fact_inventory fi JOIN {DC} ON fi.drug_key = dr.drug_key
      WHERE fi.stock_status IN ('Out of Stock', 'Critical', 'Low Stock')
      GROUP BY dr.drug_name, t.therapeutic_class, fi.stock_status""",
    "stock_alert_counts": f"""SELECT stock_status, COUNT(*) AS items FROM (
      SELECT dr.drug_name, t.therapeutic_class, fi.stock_status
      FROM fact_inventory fi JOIN {DC} ON fi.drug_key = dr.drug_key
      WHERE fi.stock_status IN ('Out of Stock', 'Critical', 'Low Stock')
      GROUP BY dr.drug_name, t.therapeutic_class, fi.stock_status) x GROUP BY stock_status""",
    "revenue_by_segment": f"""SELECT c.customer_segment AS seg, {_dsum('f.net_revenue')} AS rev
      FROM {FD} JOIN dim_customer c ON f.customer_key = c.customer_key WHERE c.customer_segment IS NOT NULL
      GROUP BY c.customer_segment""",
    "top_customers": f"""SELECT c.customer_name AS name, c.customer_type AS type, {_dsum('f.net_revenue')} AS rev,
      COUNT(*) AS orders, {WM} AS margin FROM {FD} JOIN dim_customer c ON f.customer_key = c.customer_key
      GROUP BY c.customer_name, c.customer_type ORDER BY rev DESC, name, type LIMIT 20""",
    "revenue_by_zone": f"""SELECT g.distribution_zone AS z, {_dsum('f.net_revenue')} AS rev
      FROM {FD} JOIN dim_geography g ON f.geography_key = g.geography_key GROUP BY g.distribution_zone""",
    "drug_lookup": f"""SELECT dr.drug_code, dr.drug_name, dr.dosage_form, dr.dosage_strength,
      t.therapeutic_class AS class, t.regulatory_category AS regulatory, CAST(dr.unit_price AS DOUBLE) AS price,
      CAST(dr.unit_cost AS DOUBLE) AS cost, dr.drug_status AS status, dr.manufacturer
      FROM {DC} WHERE lower(dr.drug_name) LIKE '%cillin%' ORDER BY dr.drug_name, dr.drug_key LIMIT 100""",
    "drug_history": f"""SELECT dr.drug_name, d.calendar_year AS yr, d.month_name AS mo, d.month_num,
      {_lsum('f.units_sold')} AS units, {_dsum('f.net_revenue')} AS rev, {WM} AS margin
      FROM {FD} JOIN dim_drug dr ON f.drug_key = dr.drug_key
      GROUP BY dr.drug_name, d.calendar_year, d.month_name, d.month_num""",
    "drug_history_one": f"""SELECT d.calendar_year AS yr, d.month_name AS mo, d.month_num,
      {_lsum('f.units_sold')} AS units, {_dsum('f.net_revenue')} AS rev, {WM} AS margin
      FROM {FD} JOIN dim_drug dr ON f.drug_key = dr.drug_key
      WHERE dr.drug_name = (SELECT MIN(drug_name) FROM dim_drug)
      GROUP BY d.calendar_year, d.month_name, d.month_num""",
    "drug_stock_one": f"""SELECT fi.stock_status, {_lsum('fi.units_on_hand')} AS on_hand,
      {_dsum('fi.stock_value')} AS value FROM fact_inventory fi JOIN dim_drug dr ON fi.drug_key = dr.drug_key
      WHERE dr.drug_name = (SELECT MIN(drug_name) FROM dim_drug) GROUP BY fi.stock_status""",
    "drug_stock": f"""SELECT dr.drug_name, fi.stock_status, {_lsum('fi.units_on_hand')} AS on_hand,
      {_dsum('fi.stock_value')} AS value FROM fact_inventory fi JOIN dim_drug dr ON fi.drug_key = dr.drug_key
      GROUP BY dr.drug_name, fi.stock_status""",
    "customer_lookup": """SELECT c.customer_code, c.customer_name, c.customer_type, c.customer_segment, c.email,
      c.payment_terms, c.customer_status, g.country_region, g.city
      FROM dim_customer c LEFT JOIN dim_geography g ON c.geography_key = g.geography_key
      WHERE c.customer_type = 'Clinic' ORDER BY c.customer_name, c.customer_key LIMIT 200""",
    "sales_search": f"""SELECT f.source_order_number AS order_no, d.full_date AS date, dr.drug_name, c.customer_name,
      c.customer_type, f.units_sold, CAST(f.unit_price AS DOUBLE) AS price, CAST(f.net_revenue AS DOUBLE) AS revenue,
      CAST(f.gross_margin_pct AS DOUBLE) AS margin, f.source_system
      FROM {FD} JOIN dim_drug dr ON f.drug_key = dr.drug_key JOIN dim_customer c ON f.customer_key = c.customer_key
      WHERE d.calendar_year IN (2022, 2023) AND f.source_system = 'AW_INTERNET'
        AND f.net_revenue BETWEEN 1000 AND 50000
      ORDER BY d.full_date DESC, f.source_order_number, f.source_order_line_num, f.source_system LIMIT 1000""",
    "picklists": """SELECT * FROM (
      SELECT DISTINCT 'class' AS list, therapeutic_class AS value FROM dim_therapeutic_class
      UNION SELECT DISTINCT 'form', dosage_form FROM dim_drug WHERE dosage_form IS NOT NULL
      UNION SELECT DISTINCT 'customer_type', customer_type FROM dim_customer
      UNION SELECT DISTINCT 'country', country_region FROM dim_geography
      UNION SELECT DISTINCT 'year', CAST(calendar_year AS VARCHAR) FROM dim_date) x""",
    "drug_price_list": "SELECT drug_name, CAST(unit_price AS DOUBLE) AS unit_price FROM dim_drug",
    "sales_summary": f"""SELECT d.calendar_year AS year, d.month_name AS month, dr.drug_name AS drug,
      t.therapeutic_class AS class, c.customer_type AS cust_type, {_lsum('f.units_sold')} AS units,
      {_dsum('f.gross_revenue')} AS gross_rev, {_dsum('f.net_revenue')} AS net_rev,
      {_dsum('f.gross_profit')} AS profit, {WM} AS avg_margin
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key JOIN dim_customer c ON f.customer_key = c.customer_key
      GROUP BY d.calendar_year, d.month_name, d.month_num, dr.drug_name, t.therapeutic_class, c.customer_type""",
    "inventory_status": f"""SELECT dr.drug_code, dr.drug_name, dr.dosage_form, t.therapeutic_class AS class,
      fi.stock_status, {_lsum('fi.units_on_hand')} AS on_hand, {_lsum('fi.units_ordered')} AS ordered,
      {_dsum('fi.stock_value')} AS value, {_mean('fi.days_of_supply')} AS days_supply
      FROM fact_inventory fi JOIN {DC} ON fi.drug_key = dr.drug_key
      GROUP BY dr.drug_code, dr.drug_name, dr.dosage_form, t.therapeutic_class, fi.stock_status""",
    "customer_revenue": f"""SELECT c.customer_name, c.customer_type, c.customer_segment, g.country_region AS country,
      g.city, COUNT(*) AS orders, {_lsum('f.units_sold')} AS units, {_dsum('f.net_revenue')} AS revenue,
      {WM} AS avg_margin
      FROM {FD} JOIN dim_customer c ON f.customer_key = c.customer_key
      LEFT JOIN dim_geography g ON c.geography_key = g.geography_key
      GROUP BY c.customer_name, c.customer_type, c.customer_segment, g.country_region, g.city""",
    "monthly_revenue": f"""SELECT d.calendar_year AS year, d.quarter_label AS quarter, d.month_name AS month,
      COUNT(*) AS orders, {_lsum('f.units_sold')} AS units, {_dsum('f.gross_revenue')} AS gross,
      {_dsum('f.net_revenue')} AS net, {_dsum('f.gross_profit')} AS profit, {WM} AS margin
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key JOIN dim_customer c ON f.customer_key = c.customer_key
      GROUP BY d.calendar_year, d.quarter_label, d.month_name, d.month_num""",
    "drug_performance": f"""SELECT dr.drug_name, dr.dosage_form, dr.dosage_strength, t.therapeutic_class AS class,
      {_lsum('f.units_sold')} AS units, {_dsum('f.net_revenue')} AS revenue, {_dsum('f.gross_profit')} AS profit,
      {WM} AS avg_margin, COUNT(DISTINCT f.customer_key) AS customers
      FROM {FD} JOIN {DC} ON f.drug_key = dr.drug_key
      GROUP BY dr.drug_name, dr.dosage_form, dr.dosage_strength, t.therapeutic_class""",
    "sales_mart": """SELECT d.full_date, d.calendar_year, d.month_name, d.quarter_label, dr.drug_name, dr.dosage_form,
      dr.dosage_strength, t.therapeutic_class, t.therapeutic_subclass, c.customer_name, c.customer_type,
      c.customer_segment, g.city, g.country_region, g.distribution_zone, st.territory_name, st.territory_group,
      f.units_sold, f.unit_price, f.gross_revenue, f.discount_amount, f.net_revenue, f.cost_of_goods,
      f.gross_profit, f.gross_margin_pct, f.tax_amount, f.freight_cost, f.source_system
      FROM fact_drug_sales f JOIN dim_date d ON f.order_date_key = d.date_key
      JOIN dim_drug dr ON f.drug_key = dr.drug_key JOIN dim_customer c ON f.customer_key = c.customer_key
      JOIN dim_therapeutic_class t ON dr.therapeutic_class_key = t.therapeutic_class_key
      LEFT JOIN dim_geography g ON f.geography_key = g.geography_key
      LEFT JOIN dim_sales_territory st ON f.territory_key = st.territory_key""",
    "inventory_mart": """SELECT d.full_date, d.calendar_year, d.month_name, d.quarter_label, dr.drug_name,
      dr.dosage_form, dr.dosage_strength, t.therapeutic_class, f.units_on_hand, f.units_ordered,
      f.units_dispatched, f.safety_stock_level, f.reorder_point, f.stock_value, f.days_of_supply, f.stock_status
      FROM fact_inventory f JOIN dim_date d ON f.snapshot_date_key = d.date_key
      JOIN dim_drug dr ON f.drug_key = dr.drug_key
      JOIN dim_therapeutic_class t ON dr.therapeutic_class_key = t.therapeutic_class_key""",
}
