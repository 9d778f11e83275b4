"""Raw source scans (SRC-4..10), extract summary, date presets, CSV export, table creation."""
import datetime as dt
import io
import contextlib
import os


from medistar.plans import queries as Q
from medistar.plans.warehouse import AUDIT_SCHEMA, Warehouse
from medistar.sources import raw
from medistar.sources.extract import extract_all, extract_summary
from medistar.params import Params
from tests.conftest import SF_SMALL


def test_raw_scans_rename_and_filter(spark, scratch):
    spark.createDataFrame([(1, "Zurich", "ZH", "Switzerland", "8000", 3, "extra")],
                          "GeographyKey int, City string, StateProvinceName string, EnglishCountryRegionName string, "
                          "PostalCode string, SalesTerritoryKey int, Unused string").write.parquet(
        os.path.join(scratch, "DimGeography"))
    spark.createDataFrame([(1, "A1", "Bolt", "Red", "S", 10.0, 5.0, 8.0, 1, "Current", True, "R", "x"),
                           (2, "A2", "Nut", "Red", "S", None, 5.0, 8.0, 1, "Current", True, "R", "x")],
                          "ProductKey int, ProductAlternateKey string, EnglishProductName string, Color string, "
                          "Size string, ListPrice double, StandardCost double, DealerPrice double, "
                          "ProductSubcategoryKey int, Status string, FinishedGoodsFlag boolean, ProductLine string, "
                          "Unused string").write.parquet(os.path.join(scratch, "DimProduct"))
    spark.createDataFrame([(5, "Ann", "Lee", "a@x", "1", 1)],
                          "CustomerKey int, FirstName string, LastName string, EmailAddress string, Phone string, "
                          "GeographyKey int").write.parquet(os.path.join(scratch, "DimCustomer"))
    geo = raw.scan(spark, "dim_geography", fmt="parquet", path=scratch)
    assert geo.columns == ["GeographyKey", "City", "StateProvinceName", "CountryRegion", "PostalCode",
                           "SalesTerritoryKey"]
    prod = raw.scan(spark, "dim_product", fmt="parquet", path=scratch)
    assert [r.ProductName for r in prod.collect()] == ["Bolt"]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        prod.explain()
    assert "IsNotNull(ListPrice)" in buf.getvalue() and "Unused" not in buf.getvalue().split("ReadSchema")[-1]
    cust = raw.scan(spark, "dim_customer", fmt="parquet", path=scratch)
    assert cust.collect()[0].FullName == "Ann Lee"


def test_extract_shift_and_summary(spark):
    rawd = {
        "fact_internet_sales": spark.createDataFrame([(20000229, 19990101, 0)], "OrderDateKey int, ShipDateKey int, "
                                                                                  "DueDateKey int"),
        "fact_product_inventory": spark.createDataFrame([(20000229, dt.datetime(2000, 2, 29, 10, 0))],
                                                        "DateKey int, MovementDate timestamp"),
    }
    ex = extract_all(spark, rawd, Params(shift_years=1, calendar_start="2001-01-01", calendar_end="2001-01-10"))
    s = ex["fact_internet_sales"].collect()[0]
    assert (s.OrderDateKey, s.ShipDateKey, s.DueDateKey) == (20010229, 20000101, 0)
    i = ex["fact_product_inventory"].collect()[0]
    assert i.DateKey == 20010229 and i.MovementDate == dt.datetime(2001, 2, 28, 10, 0)
    summ = {r.table: r.rows for r in extract_summary(ex).collect()}
    assert summ["dim_date"] == 10 and summ["TOTAL"] == 12


def test_presets():
    as_of = dt.date(2025, 6, 30)
    assert Q.preset_range("Last Year", as_of) == ("2024-01-01", "2024-12-31")
    assert Q.preset_range("This Year", as_of) == ("2025-01-01", "2025-06-30")
    assert Q.preset_range("Last 6 Months", as_of) == ("2025-01-01", "2025-06-30")
    assert Q.preset_range("Yesterday", as_of) == ("2025-06-29", "2025-06-29")
    assert Q.preset_range("All Time", as_of)[0] == "2005-01-01"


def test_export_csv_and_create(spark, small_star, scratch):
    out = os.path.join(scratch, "top")
    Q.export_csv(Q.top_drugs(small_star, 5), out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 5 and back.columns == ["drug_name", "rev", "units", "mgn"]
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    schemas = {t: df.schema for t, df in small_star.tables.items()}
    schemas["etl_audit_log"] = AUDIT_SCHEMA
    wh.create(schemas)
    assert all(wh.exists(t) for t in schemas)
    assert wh.read("fact_drug_sales").count() == 0 and wh.audit_log().count() == 0


def test_date_filter_reaches_the_fact_scan(spark, small_star):
    df = Q.kpi_summary(small_star, "2024-01-01", "2024-12-31")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "order_date_key" in buf.getvalue() and "20240101" in buf.getvalue()
    assert df.collect()[0].orders >= 0


def test_scan_writes_only_its_own_table(spark, scratch, monkeypatch):
    import __spark_entry__ as E
    from medistar.session import fs_names
    monkeypatch.setattr(E, "shared_path", lambda spark, *parts: "/".join([scratch, *parts]))
    got = E._scan("dim_customer")(spark, SF_SMALL).collect()
    root = f"{scratch}/registry_source/{E._ident(spark, SF_SMALL)}"
    assert [n for n in fs_names(spark, root) if n[0] != "_"] == ["DimCustomer"]
    assert len(got) == spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    E.scan_categories(spark, SF_SMALL)
    assert len([n for n in fs_names(spark, root) if n[0] != "_"]) == 4
