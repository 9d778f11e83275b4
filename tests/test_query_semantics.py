"""Ordering and invariants the value-hash oracle cannot see (it ignores row order)."""
import math

from medistar.plans import queries as Q

SEVERITY = {"Out of Stock": 1, "Critical": 2}


def test_yoy_growth(small_star):
    rows = Q.revenue_by_year_yoy(small_star).collect()
    years = [r.yr for r in rows]
    assert years == sorted(years) and rows[0].growth == 0.0
    for prev, cur in zip(rows, rows[1:]):
        assert math.isclose(cur.growth, (cur.rev - prev.rev) / prev.rev * 100.0, rel_tol=1e-12)


def test_class_share_sums_to_100(small_star):
    rows = Q.class_share(small_star).collect()
    assert math.isclose(sum(r.pct for r in rows), 100.0, rel_tol=1e-9)
    assert [r.rev for r in rows] == sorted((r.rev for r in rows), reverse=True)


def test_stock_alert_order(small_star):
    rows = Q.stock_alerts(small_star).collect()
    keys = [(SEVERITY.get(r.stock_status, 3), r.drug_name) for r in rows]
    assert keys == sorted(keys) and {r.stock_status for r in rows} <= {"Out of Stock", "Critical", "Low Stock"}


def test_sales_search_newest_first(small_star):
    rows = Q.sales_search(small_star, years=[2022, 2023], n=50).collect()
    dates = [r.date for r in rows]
    assert dates == sorted(dates, reverse=True) and len(rows) == 50
    assert all(r.date.year in (2022, 2023) for r in rows)


def test_top_k_ties_break_by_name(small_star):
    rows = Q.top_drugs(small_star, 8).collect()
    keys = [(-r.rev, r.drug_name) for r in rows]
    assert keys == sorted(keys) and len(rows) == 8


def test_quarterly_is_chronological(small_star):
    rows = Q.quarterly(small_star).collect()
    keys = [(r.yr, int(r.q[1])) for r in rows]
    assert keys == sorted(keys)


def test_kpi_insights_consistent(small_star):
    k = Q.kpi_summary(small_star).collect()[0]
    i = Q.kpi_insights(small_star).collect()[0]
    r = Q.stock_risk_counts(small_star).collect()[0]
    assert math.isclose(i.avg_order_value, k.rev / k.orders, rel_tol=1e-12)
    assert math.isclose(i.profit_per_unit, k.prof / k.units, rel_tol=1e-12)
    assert i.inventory_risk == r.out_of_stock + r.low_or_critical
