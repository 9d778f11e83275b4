"""The star's dedupe sorts narrow rows."""

import random
from decimal import Decimal

from medistar.functions import exprs as X
from medistar.operators.upsert import dedupe_batch


def test_dedupe_carries_an_order_column_once(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "c"), (1, 4, "a"), (2, None, "z"), (None, 1, "n"), (None, 2, "m")], "k long, o long, v string")
    got = X.dedupe(df, ["k"], ["o"], "first", count_col="n")
    assert {tuple(r) for r in got.collect()} == {(1, 4, "a", 2), (2, None, "z", 0), (None, 1, "n", 1)}
    assert got.columns == ["k", "o", "v", "n"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_o0, o#") == 1 and "v, v#" in plan and ", o, o#" not in plan
    plan = dedupe_batch(df, ["k"], None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(", v, v#") == 1


def test_sales_fact_sorts_no_derived_measure(spark):
    from medistar.operators import facts
    from medistar.params import Params
    raw = spark.createDataFrame(
        [("S1", 1, 1, 1, 20240101, 20240102, 0, 1, 2, "10", "0.1", None, "5", "18", "1", "1", 1)],
        "SalesOrderNumber string, SalesOrderLineNumber int, ProductKey long, CustomerKey long, OrderDateKey int, ShipDateKey int, "
        "DueDateKey int, SalesTerritoryKey long, OrderQuantity int, UnitPrice string, UnitPriceDiscountPct string, ExtendedAmount string, "
        "TotalProductCost string, SalesAmount string, TaxAmt string, Freight string, src_order int")
    dims = [spark.createDataFrame([(1, 1)], "source_product_key long, drug_key long"),
            spark.createDataFrame([(1, 1, 1)], "source_customer_key long, customer_key long, geography_key long"),
            spark.createDataFrame([(20240101,), (20240102,)], "date_key int"),
            spark.createDataFrame([(1, 1)], "source_territory_key long, territory_key long")]
    clean = facts.transform_fact_sales(raw, *dims, Params()).clean
    row = clean.first()
    assert (row.gross_profit, row.gross_margin_pct, row.order_year) == (Decimal("13.0000"), Decimal("72.2222"), 2024)
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    packed = next(line for line in plan.splitlines() if "Aggregate" in line and "min(struct" in line)
    assert "gross_margin_pct" not in packed and "etl_batch_id" not in packed


def test_exact_pct_within_and_beyond_64_bits(spark):
    rnd = random.Random(5)
    rows = [(Decimal(rnd.randint(-10 ** e, 10 ** e)) / 10000, Decimal(rnd.randint(-10 ** e, 10 ** e)) / 10000) for e in (2, 5, 9, 12, 13, 15, 17) for _ in range(60)]
    edge = [Decimal("399999999.9999"), Decimal("400000000"), Decimal("39999999999.9999"), Decimal("40000000000")]
    rows += [(a, b) for a in edge for b in (Decimal("0.0001"), Decimal(1), Decimal("39999999999999.9999"), Decimal(0))]
    rows += [(None, Decimal(1)), (Decimal(1), None)]
    df = spark.createDataFrame(rows, "a decimal(18,4), b decimal(18,4)")
    for scale in (2, 4):
        for r in df.select("a", "b", X.exact_pct("a", "b", scale).alias("p")).collect():
            if r.a is None or not r.b:
                assert r.p is None
                continue
            top, bottom = abs(int(r.a * 10000)) * 100 * 10 ** scale, abs(int(r.b * 10000))
            q = (2 * top + bottom) // (2 * bottom) * (-1 if (r.a < 0) != (r.b < 0) else 1)
            assert r.p == Decimal(q) / 10 ** scale, (r.a, r.b)
