"""Upload reader and transforms; the two 4-row upload templates are the goldens."""
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from medistar.operators import uploads as U
from medistar.sources.uploads import normalise_name, read_upload

# the sales and inventory upload templates (4 rows each)
SALES_CSV = """Drug Name,Customer Name,customer_type,order_date,units_sold,unit_price,unit_price_discount_pct,total_product_cost,sales_amount,tax_amt,freight,sales_territory_name,country_region,city
Ramipril 250mg Injection,City General Hospital,Hospital,2026-03-22,10,3578.27,0,2171.29,35782.70,286.26,89.46,Northwest,United States,Seattle
Metoprolol 250mg Injection,Apollo Multispeciality Clinic,Clinic,2026-03-22,5,2800.00,5,1680.00,13300.00,106.40,33.25,Northeast,United States,Boston
Losartan 250mg Tablet,MedPlus Pharmacy Chennai,Pharmacy,2026-03-22,20,1499.00,0,899.40,29980.00,239.84,74.95,Southwest,Australia,Sydney
Amlodipine 250mg Cream,Fortis Wholesale Mumbai,Wholesale Distributor,2026-03-22,50,1552.45,2,930.00,76173.00,609.38,190.43,Northwest,United States,New York
"""
INVENTORY_CSV = """drug_name,snapshot_date,units_on_hand,units_ordered,units_dispatched,unit_cost
Ramipril 250mg Injection,2026-03-22,500,100,30,2171.29
Metoprolol 250mg Injection,2026-03-22,0,50,0,1680.00
Losartan 250mg Tablet,2026-03-22,250,0,15,899.40
Amlodipine 250mg Cream,2026-03-22,80,200,25,930.00
"""


def _write(scratch, name, text):
    p = os.path.join(scratch, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_normalise_name():
    assert normalise_name("  Drug Name ") == "drug_name"
    assert normalise_name("Unit Price ($)") == "unit_price_"


def test_read_upload_detects_type(spark, scratch):
    s = read_upload(spark, _write(scratch, "s.csv", SALES_CSV))
    i = read_upload(spark, _write(scratch, "i.csv", INVENTORY_CSV))
    assert s.kind == "sales" and i.kind == "inventory" and "drug_name" in s.columns
    with pytest.raises(ValueError, match="Unsupported file type"):
        read_upload(spark, _write(scratch, "x.txt", SALES_CSV))
    with pytest.raises(ValueError, match="Missing columns"):
        read_upload(spark, _write(scratch, "m.csv", "drug_name,units_sold\nA,1\n"))


def test_sales_template_golden(spark, scratch):
    up = read_upload(spark, _write(scratch, "s.csv", SALES_CSV))
    rows = sorted(U.transform_sales_upload(up.df).clean.collect(), key=lambda r: r.drug_name)
    r = {x.drug_name.split()[0]: x for x in rows}
    ram = r["Ramipril"]
    # 2171.29 < 0.5 x 35782.70: treated as a per-unit cost and multiplied by the units
    assert ram.gross_revenue == D("35782.7000") and ram.cost_of_goods == D("21712.9000")
    assert ram.net_revenue == D("35782.7000") and ram.gross_margin_pct == D("39.3200")
    met = r["Metoprolol"]
    assert met.discount_amount == D("700.0000") and met.net_revenue == D("13300.0000")
    assert met.customer_type == "Clinic" and met.distribution_zone == "North America Zone"
    assert r["Losartan"].distribution_zone == "Asia-Pacific Zone"
    assert r["Amlodipine"].customer_type == "Wholesale Distributor" and ram.date_key == 20260322


def test_sales_upload_rejects(spark):
    cols = ["drug_name", "customer_name", "customer_type", "order_date", "units_sold", "unit_price",
            "unit_price_discount_pct", "total_product_cost", "sales_amount", "tax_amt", "freight",
            "sales_territory_name", "country_region", "city"]
    rows = [("A", "B", "x", "n/a", "1", "1", "0", "0", "0", "0", "0", "", "", ""),
            ("A", "B", "x", "2024-01-01", "0", "1", "0", "0", "0", "0", "0", "", "", ""),
            ("A", "B", "x", "2024-01-01", "1", "abc", "0", "0", "0", "0", "0", "", "", ""),
            ("", "B", "x", "2024-01-01", "1", "1", "0", "0", "0", "0", "0", "", "", ""),
            ("A", "B", "x", "2024-01-01", "1", "1", "0", "0", "0", "0", "0", "", "", "")]
    res = U.transform_sales_upload(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)))
    got = sorted(r.reject_reason for r in res.rejects.collect())
    assert got == ["bad_dates", "null_critical", "zero_price", "zero_units"] and res.clean.count() == 1


def test_inventory_template_golden(spark, scratch):
    up = read_upload(spark, _write(scratch, "i.csv", INVENTORY_CSV + INVENTORY_CSV.splitlines()[1] + "\n"))
    rows = {r.drug_name.split()[0]: r for r in U.transform_inventory_upload(up.df).clean.collect()}
    assert len(rows) == 4
    assert [rows[k].stock_status for k in ["Ramipril", "Metoprolol", "Losartan", "Amlodipine"]] == \
        ["In Stock", "Out of Stock", "In Stock", "Low Stock"]
    # dispatched is 0 for the only Metoprolol row -> no days of supply
    assert rows["Metoprolol"].days_of_supply is None
    # Ramipril appears twice (30 dispatched each): 500 / 30
    assert rows["Ramipril"].days_of_supply == D("16.67")
    assert rows["Losartan"].days_of_supply == D("16.67") and rows["Ramipril"].stock_value == D("1085645.0000")


def test_date_shapes_spare_failing_parses(spark):
    """A text that cannot be of a format is not parsed by it; each format still reads what it reads alone."""
    from medistar.operators.uploads import DATE_FORMATS, _shape, parse_date
    texts = ["2025-1-2", "2025/01/02", "2025-01-02 3:04", "2025-01-02 03:04:05", "2025-01-02T03:04:05.123Z", "2025-01-02T03:04",
             "2025-01-02T03:04:05+05:00", "2025/1/2 3:04:05", "1-2-2025", "13-2-2025", "13/2/2025", "1/2/2025 10:00", "13/2/2025 10:00",
             "2 Jan 2025", "2 January 2025", "2-Jan-2025", "Jan 2, 2025", "january 2, 2025", "20250102", "+12025-1-2", "n/a", "", " ",
             "2025-13-45", "2025-02-30", "0001-01-01", "99-1-2", "2025-1-2x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    s = F.trim("t")
    plain = F.coalesce(*[F.to_date(F.try_to_timestamp(s, F.lit(f))) for f in DATE_FORMATS])
    got = df.select("t", parse_date("t").cast("string").alias("a"), plain.cast("string").alias("b")).collect()
    assert [(r.t, r.a) for r in got] == [(r.t, r.b) for r in got]
    assert sum(r.a is not None for r in got) >= 19
    tried = df.where("t = 'n/a'").select(*[s.rlike(_shape(f)).alias(f"c{i}") for i, f in enumerate(DATE_FORMATS)]).first()
    assert not any(tried)


def test_upload_leaves_no_staged_rows(spark, scratch):
    """What an upload stages is deleted once it is loaded; rejects keep their whole rows."""
    from medistar.operators import outcomes as O
    from medistar.session import fs_names, shared_path
    folder = shared_path(spark, "uploads")
    before = fs_names(spark, folder)
    with O.dropped(spark):
        made = O._written(spark, spark.range(3).toDF("id"), "sales")
        assert made.count() == 3 and len(fs_names(spark, folder)) == len(before) + 1
    assert fs_names(spark, folder) == before
