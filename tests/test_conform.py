"""Per-rule tests of the dimension and fact waterfalls on tiny inputs."""
import datetime as dt
from decimal import Decimal as D


from medistar.operators import dims, facts
from medistar.params import Params
from medistar.sources import adapter
from medistar.sources.calendar import generate_calendar

P = Params()


def _report(c):
    return {(r.kind, r.reason): r.rows for r in c.report.collect()}


def _cats(spark):
    return adapter.category(spark), adapter.subcategory(spark)


def test_drug_rules(spark):
    cat, sub = _cats(spark)
    rows = [
        (None, "x", "Blue", "S", D("10"), D("5"), D("8"), 1, "Current"),      # null key
        (2, "  ", "Blue", "S", D("10"), D("5"), D("8"), 1, "Current"),        # blank name
        (3, "p3", "Blue", "S", D("0"), D("5"), D("8"), 1, "Current"),         # zero price
        (4, "p4", "Blue", "S", None, D("5"), D("8"), 1, "Current"),           # null price
        (5, "p5", "Blue", "S", D("10"), D("31"), D("0"), 1, "0"),             # cost > 3x price, dealer <= 0
        (6, "p6", "Nope", "99", D("10"), D("-1"), None, 99, "Current"),       # defaults everywhere
    ]
    prod = spark.createDataFrame(rows, "ProductKey int, ProductName string, Color string, Size string, "
                                       "ListPrice decimal(18,4), StandardCost decimal(18,4), "
                                       "DealerPrice decimal(18,4), ProductSubcategoryKey int, Status string")
    c = dims.transform_dim_drug(prod, sub, cat, P)
    out = {r.source_product_key: r for r in c.clean.collect()}
    assert set(out) == {5, 6}
    r5, r6 = out[5], out[6]
    assert r5.unit_cost == D("7.0000") and r5.standard_cost == D("10.0000") and r5.drug_status == "Discontinued"
    assert r5.drug_name == "Trandolapril 100mg Capsule"  # Mountain Bikes list, index 5 % 10
    assert r6.unit_cost == D("0.0000") and r6.standard_cost == D("10.0000")
    assert r6.dosage_form == "Tablet" and r6.dosage_strength == "250mg"
    assert r6.drug_name == "Vitamin C 250mg Tablet"  # fallback list, index 6
    assert r5.drug_code == "A-0005"
    rep = _report(c)
    assert rep[("removed", "null_product_key")] == 1 and rep[("removed", "null_product_name")] == 1
    assert rep[("removed", "zero_or_null_price")] == 2 and rep[("fixed", "anomalous_cost_fixed")] == 1


def test_drug_name_collisions(spark):
    cat, sub = _cats(spark)
    # keys 1, 11, 21, 31 share a base name (same list index, form, strength); 11 and 21 share code index 1
    rows = [(k, f"p{k}", "Blue", "S", D("10"), D("5"), D("8"), 1, "Current") for k in [1, 11, 21, 31, 2]]
    prod = spark.createDataFrame(rows, "ProductKey int, ProductName string, Color string, Size string, "
                                       "ListPrice decimal(18,4), StandardCost decimal(18,4), "
                                       "DealerPrice decimal(18,4), ProductSubcategoryKey int, Status string")
    got = {r.source_product_key: r.drug_name for r in dims.transform_dim_drug(prod, sub, cat, P).clean.collect()}
    base = "Lisinopril 100mg Capsule"
    assert got[1] == base
    assert got[11] == base + " (SR)"        # first later row with code SR
    assert got[21] == base + " [21]"        # SR already taken
    assert got[31] == base + " (SR)" or got[31] == base + " [31]"
    assert got[31] == base + " [31]"
    assert got[2] == "Enalapril 100mg Capsule"


def test_customer_rules(spark):
    rows = [(None, "A", "B", "a@x", "1", 1), (2, None, None, "a@x", "1", 1), (3, "nan", "null", "a@x", "1", 1),
            (7, "Household", "Cust#7", "bad-email", " ", 3), (6001, "Building", "X", "b@x", "555", None),
            (120000, "Auto", "Y", None, None, 2)]
    cust = spark.createDataFrame(rows, "CustomerKey int, FirstName string, LastName string, EmailAddress string, "
                                       "Phone string, GeographyKey int")
    c = dims.transform_dim_customer(cust)
    out = {r.source_customer_key: r for r in c.clean.collect()}
    assert set(out) == {7, 6001, 120000}
    assert out[7].customer_name == "Household General Hospital #7" and out[7].email is None and out[7].phone is None
    assert out[7].customer_code == "ZCU-000007"
    assert out[6001].customer_type == "Pharmacy" and out[6001].customer_segment == "Retail"
    assert out[6001].customer_name == "Building Pharmacy #6001"
    assert out[120000].customer_type == "Hospital" and out[120000].customer_segment == "Government"
    rep = _report(c)
    assert rep[("removed", "null_customer_key")] == 1 and rep[("removed", "null_name")] == 2
    assert rep[("fixed", "invalid_email_fixed")] == 1


def test_geography_and_territory(spark):
    geo = spark.createDataFrame([(1, "Zü-rich_#1", "St.ate", "Germany", "1", 1), (2, "X", "Y", None, "2", 1),
                                 (None, "X", "Y", "India", "3", 1), (1, "dup", "dup", "India", "4", 1)],
                                "GeographyKey int, City string, StateProvinceName string, CountryRegion string, "
                                "PostalCode string, SalesTerritoryKey int")
    g = dims.transform_dim_geography(geo)
    rows = {r.source_geo_key: r for r in g.clean.collect()}
    assert set(rows) == {1}
    assert rows[1].city in ("Zü-rich_1", "dup")
    rep = _report(g)
    assert rep[("removed", "unknown_country")] == 1 and rep[("removed", "null_geo_key")] == 1
    assert rep[("removed", "duplicates")] == 1
    ter = spark.createDataFrame([(1, "nan", "", None), (2, "North", "US", "NA"), (None, "a", "b", "c")],
                                "SalesTerritoryKey int, TerritoryName string, TerritoryCountry string, "
                                "TerritoryGroup string")
    t = dims.transform_dim_territory(ter)
    assert [r.source_territory_key for r in t.clean.collect()] == [2]
    rep = _report(t)
    assert rep[("removed", "all_fields_unknown")] == 1 and rep[("removed", "null_territory_key")] == 1


def test_therapeutic_class(spark):
    cat = spark.createDataFrame([(1, "Bikes"), (5, "Other")], "ProductCategoryKey int, CategoryName string")
    sub = spark.createDataFrame([(1, 1, "Mountain Bikes"), (2, 5, "Extras"), (3, 9, "Ghost"), (4, 1, " ")],
                                "ProductSubcategoryKey int, ProductCategoryKey int, SubcategoryName string")
    c = dims.transform_dim_therapeutic_class(cat, sub)
    out = {r.source_subcategory_key: r for r in c.clean.collect()}
    assert out[1].therapeutic_class == "Cardiovascular Drugs" and out[1].therapeutic_subclass == "Beta Blockers"
    assert out[1].regulatory_category == "Schedule H" and out[1].class_code == "C01"
    assert out[2].therapeutic_class == "Pharmaceutical" and out[2].therapeutic_subclass == "Extras"
    assert out[2].atc_code == "ATC-Z"
    rep = _report(c)
    assert rep[("removed", "unknown_category")] == 1 and rep[("removed", "blank_subcategory_name")] == 1


def _dims_for_facts(spark):
    drug = spark.createDataFrame([(10, 10)], "drug_key int, source_product_key int")
    cust = spark.createDataFrame([(20, 20, 7)], "customer_key int, source_customer_key int, geography_key int")
    cal = dims.transform_dim_date(generate_calendar(spark, "2024-01-01", "2024-12-31")).clean
    terr = spark.createDataFrame([(3, 3)], "territory_key int, source_territory_key int")
    return drug, cust, cal, terr


SALES_SCHEMA = ("SalesOrderNumber string, SalesOrderLineNumber int, ProductKey int, CustomerKey int, "
                "SalesTerritoryKey int, OrderDateKey int, ShipDateKey int, DueDateKey int, OrderQuantity int, "
                "UnitPrice decimal(18,4), UnitPriceDiscountPct decimal(18,4), ExtendedAmount decimal(18,4), "
                "TotalProductCost decimal(18,4), SalesAmount decimal(18,4), TaxAmt decimal(18,4), "
                "Freight decimal(18,4), src_order int")


def test_sales_waterfall_and_measures(spark):
    drug, cust, cal, terr = _dims_for_facts(spark)
    ok = ("SO1", 1, 10, 20, 3, 20240105, 20240110, 20991231, 2, D("50"), D("0.1"), None, D("300"), D("90"),
          D("7.2"), D("2.25"), 1)
    rows = [
        (None, 1, 10, 20, 3, 20240105, 0, 0, 1, D("1"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 2),
        ("SO2", 1, 11, 20, 3, 20240105, 0, 0, 1, D("1"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 3),
        ("SO3", 1, 10, 21, 3, 20240105, 0, 0, 1, D("1"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 4),
        ("SO4", 1, 10, 20, 3, 20230105, 0, 0, 1, D("1"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 5),
        ("SO5", 1, 10, 20, 3, 20240705, 0, 0, 1, D("1"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 6),
        ("SO6", 1, 10, 20, 3, 20240105, 0, 0, 0, D("1"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 7),
        ("SO7", 1, 10, 20, 3, 20240105, 0, 0, 1, D("0"), D("0"), D("1"), D("0"), D("1"), D("0"), D("0"), 8),
        ("SO8", 1, 10, 20, 3, 20240105, 0, 0, 1, D("1"), D("0"), D("1"), D("0"), D("-1"), D("0"), D("0"), 9),
        ok,
        ("SO1", 1, 10, 20, 3, 20240105, 20240110, 0, 2, D("50"), D("0.1"), None, D("10"), D("90"), D("0"), D("0"), 0),
    ]
    raw = spark.createDataFrame(rows, SALES_SCHEMA)
    c = facts.transform_fact_sales(raw, drug, cust, cal, terr, P.with_(as_of_key=20240630))
    out = c.clean.collect()
    assert len(out) == 1
    r = out[0]
    # the duplicate order line with the smaller order value (src_order 0) wins
    assert r.cost_of_goods == D("10.0000") and r.gross_revenue == D("100.0000")   # price x qty when amount missing
    assert r.discount_amount == D("10.0000") and r.unit_price_discount_pct == D("10.0000")
    assert r.gross_profit == D("80.0000") and r.gross_margin_pct == D("88.8889")
    assert r.ship_date_key == 20240110 and r.due_date_key is None and r.territory_key == 3 and r.geography_key == 7
    rep = _report(c)
    for reason in ["null_order_number", "drug_not_found", "customer_not_found", "date_not_found", "future_date",
                   "zero_quantity", "zero_or_null_price", "negative_revenue", "duplicate_order_lines"]:
        assert rep[("removed", reason)] == 1, reason


def test_sales_cost_anomaly(spark):
    drug, cust, cal, terr = _dims_for_facts(spark)
    rows = [("SO1", 1, 10, 20, 3, 20240105, 0, 0, 1, D("50"), D("0"), D("50"), D("300"), D("100"), D("0"), D("0"), 1)]
    c = facts.transform_fact_sales(spark.createDataFrame(rows, SALES_SCHEMA), drug, cust, cal, terr,
                                   P.with_(as_of_key=20240630))
    r = c.clean.collect()[0]
    assert r.cost_of_goods == D("60.0000") and r.gross_margin_pct == D("40.0000")
    assert _report(c)[("fixed", "anomalous_cost_fixed")] == 1


def test_inventory_keep_last_and_fixes(spark):
    drug, cust, cal, terr = _dims_for_facts(spark)
    t1, t2 = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)
    rows = [(10, 20240301, 100, D("2"), t1), (10, 20240301, -5, D("-2"), t2), (11, 20240301, 1, D("1"), t1),
            (10, 20250301, 1, D("1"), t1), (10, 20240801, 1, D("1"), t1)]
    raw = spark.createDataFrame(rows, "ProductKey int, DateKey int, UnitsBalance int, UnitCost decimal(18,4), "
                                      "MovementDate timestamp")
    c = facts.transform_fact_inventory(raw, drug, cal, P.with_(as_of_key=20240630))
    out = c.clean.collect()
    assert len(out) == 1 and out[0].units_on_hand == 0 and out[0].stock_status == "Out of Stock"
    assert out[0].stock_value == D("0.0000")
    rep = _report(c)
    assert rep[("removed", "drug_not_found")] == 1 and rep[("removed", "date_not_found")] == 1
    assert rep[("removed", "future_date")] == 1 and rep[("removed", "duplicate_snapshots")] == 1
    assert rep[("fixed", "negative_units_fixed")] == 1 and rep[("fixed", "negative_cost_fixed")] == 1
