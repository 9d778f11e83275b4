"""A fact is written once: its removed and fixed rows are counted through the dedupe."""

import os

from medistar.functions import exprs as X
from medistar.operators import conform
from medistar.params import Params
from medistar.plans.star import build_star, build_star_to, read_star

SALES = ("SalesOrderNumber string, SalesOrderLineNumber int, ProductKey long, CustomerKey long, OrderDateKey int, ShipDateKey int, "
         "DueDateKey int, SalesTerritoryKey long, OrderQuantity long, UnitPrice string, UnitPriceDiscountPct string, "
         "ExtendedAmount string, TotalProductCost string, SalesAmount string, TaxAmt string, Freight string, src_order int")


def sale(order, line, pk=1, ck=1, date=20000105, qty=2, net="20", cost="5", src=0):
    return (order, line, pk, ck, date, 20000106, 0, 1, qty, "10", "0.1", None, cost, net, "1", "1", src)


def tables(spark):
    mk = spark.createDataFrame
    sales = [sale("S1", 1, src=2), sale("S1", 1, src=1, cost="90"), sale("S1", 2, cost="90"), sale("S2", 1), sale("S2", 1),
             sale(None, 1), sale(None, 2), sale("S3", 1, pk=9), sale("S3", 2, pk=9), sale("S3", 2, pk=None), sale("S4", 1, ck=8),
             sale("S5", 1, date=19000101), sale("S6", 1, qty=0), sale("S7", 1, net="-1"), sale("S1", 1, qty=None)]
    stock = [(1, 20000101, 5, "2", "2000-01-01 00:00:00"), (1, 20000101, 7, "2", "2000-01-02 00:00:00"), (2, 20000101, -3, "-1", "2000-01-01 00:00:00"),
             (None, 20000101, 1, "1", "2000-01-01 00:00:00"), (9, 20000101, 1, "1", "2000-01-01 00:00:00"), (9, 20000101, 1, "1", "2000-01-01 00:00:00"),
             (1, None, 1, "1", "2000-01-01 00:00:00")]
    return {
        "dim_geography": mk([(1, "Lyon", "Rhone", "France", "69001")],
                            "GeographyKey long, City string, StateProvinceName string, CountryRegion string, PostalCode string"),
        "dim_sales_territory": mk([(1, "West", "France", "Europe")],
                                  "SalesTerritoryKey long, TerritoryName string, TerritoryCountry string, TerritoryGroup string"),
        "dim_product_category": mk([(1, "Bikes")], "ProductCategoryKey int, CategoryName string"),
        "dim_product_subcategory": mk([(1, 1, "Road Bikes")], "ProductSubcategoryKey int, ProductCategoryKey int, SubcategoryName string"),
        "dim_product": mk([(k, f"p{k}", "10", "5", "8", 1, "Red", "S", "Current") for k in (1, 2)],
                          "ProductKey long, ProductName string, ListPrice string, StandardCost string, DealerPrice string, "
                          "ProductSubcategoryKey int, Color string, Size string, Status string"),
        "dim_customer": mk([(1, "Ann", "Lee", "a@b.c", "1", 1)],
                           "CustomerKey long, FirstName string, LastName string, EmailAddress string, Phone string, GeographyKey long"),
        "fact_internet_sales": mk(sales, SALES),
        "fact_product_inventory": mk(stock, "ProductKey long, DateKey int, UnitsBalance long, UnitCost string, MovementDate string"),
    }


def rows(df):
    return sorted(map(repr, df.collect()))


def test_facts_are_written_once_and_counted(spark, scratch, monkeypatch):
    staged = []
    shared = conform.shared_path
    monkeypatch.setattr(conform, "shared_path", lambda s, *p: staged.append(p[-1]) or shared(s, *p))
    lazy = build_star(spark, tables(spark), Params())
    built = build_star_to(spark, tables(spark), f"{scratch}/star", Params())
    assert staged and not [p for p in staged if p.startswith("fact_")]
    assert rows(built.report) == rows(lazy.report)
    found = {(r.table, r.reason): r.rows for r in built.report.collect()}
    assert found["fact_drug_sales", "null_order_number"] == 2 and found["fact_drug_sales", "drug_not_found"] == 3
    assert found["fact_drug_sales", "duplicate_order_lines"] == 2 and found["fact_drug_sales", "anomalous_cost_fixed"] == 2
    again = read_star(spark, f"{scratch}/star")
    for t in ("fact_drug_sales", "fact_inventory"):
        assert rows(built[t]) == rows(lazy[t]) == rows(again[t])
        assert built[t].columns == lazy[t].columns == again[t].columns
        assert not [d for d in os.listdir(f"{scratch}/star/{t}") if "HIVE_DEFAULT" in d]


def test_integer_keys_are_widened_only(spark):
    df = spark.createDataFrame([(1, 2, "12.0"), (None, None, "x"), (-2 ** 31, -2 ** 63, None)], "i int, l long, s string")
    for c in df.columns:
        assert df.select(X.long_key(c, df.schema).alias("v")).collect() == df.select(X.long_key(c).alias("v")).collect()
    plan = df.select(X.long_key("i", df.schema))._jdf.queryExecution().optimizedPlan().toString()
    assert "double" not in plan
