"""What is shuffled and staged at once is bounded: facts and uploads are written in slices, rows meet one table of names."""

import json

from medistar import session
from medistar.operators import outcomes as O
from medistar.operators import uploads as U
from medistar.params import Params
from medistar.plans import star as S
from medistar.sources import adapter
from tests.test_growth_facts import SALES, rows, sale, tables

COLS = [*U.SALES_UPLOAD_COLS, "sales_amount", "reason"]  # a file may have columns of its own


def upload(spark, n=24):
    def row(i, **kw):
        r = dict(drug_name=["Aspirin", " aspirin", "Ibu x", "none"][i % 4], customer_name=["Ann Lee", "ann", "New One"][i % 3], customer_type="clinic",
                 order_date="2024-01-05", units_sold=str(i % 7), unit_price=str(1 + i % 5), unit_price_discount_pct="10", total_product_cost="1",
                 tax_amt="1", freight=str(i % 2), sales_territory_name="West", country_region="France", city="Lyon", sales_amount="9", reason="gift")
        return tuple({**r, **kw}[c] for c in COLS)
    rows = [row(i) for i in range(n)] + [row(9, order_date="n/a"), row(9, drug_name=None), row(9, unit_price=None), row(9, customer_name=" "),
                                         row(1), row(13), row(13), row(9, order_date="1999-01-01"), tuple([None] * len(COLS))]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in COLS) + ", _row long")


def star(spark):
    mk = spark.createDataFrame
    return {"dim_drug": mk([(2, "Aspirin"), (7, "Ibuprofen Gel")], "drug_key long, drug_name string"),
            "dim_date": mk([(20240105,)], "date_key int"),
            "dim_customer": mk([(5, 5, "Ann Lee"), (6, 6, "Joann Ray")], "customer_key long, source_customer_key long, customer_name string"),
            "dim_geography": mk([(1, "France")], "geography_key long, country_region string"),
            "dim_sales_territory": mk([(1, "West")], "territory_key long, territory_name string"),
            "fact_drug_sales": mk([], "source_order_number string, source_order_line_num long, source_system string, order_year int, order_date_key int")}


def plain(df):
    return sorted((json.dumps({**r.asDict(), "_row": r._row.row}, default=str, sort_keys=True) for r in df.collect()))


def test_sales_in_slices_are_the_whole_sales(spark, scratch):
    raw = tables(spark)
    more = [sale(f"S{k}", 1 + k % 2, src=k) for k in range(10, 30)] + [sale(" S10", 1, src=1), sale("nan", 1), sale(" ", 1)]
    raw["fact_internet_sales"] = raw["fact_internet_sales"].unionByName(spark.createDataFrame(more, SALES))
    one = S.build_star_to(spark, raw, f"{scratch}/one", Params(), slices=1)
    three = S.build_star_to(spark, raw, f"{scratch}/three", Params(), slices=3)
    for t in S.STAR_TABLES:
        assert rows(one[t]) == rows(three[t]) and one[t].columns == three[t].columns
    assert rows(one.report) == rows(three.report)
    again = S.read_star(spark, f"{scratch}/three")
    assert rows(again["fact_drug_sales"]) == rows(one["fact_drug_sales"]) != []


def test_slices_follow_the_input_files(spark, scratch, monkeypatch):
    spark.range(1000).write.parquet(f"{scratch}/a b=1")
    df = spark.read.parquet(f"{scratch}/a b=1")
    assert session.slices_of(df) == 1 and session.slices_of(spark.range(3)) == 1
    monkeypatch.setattr(session, "SLICE_BYTES", 1000)
    assert session.slices_of(df) > 3
    n = session.slices_of(df)
    assert sum(df.where(session.in_slice(i, n, df.id)).count() for i in range(n)) == 1000


def test_an_upload_in_slices_is_the_whole_upload(spark):
    t, p = star(spark), Params()
    whole = O.stage(upload(spark), "sales", t, p, slices=1)
    sliced = O.stage(upload(spark), "sales", t, p, slices=3)
    assert plain(whole) == plain(sliced) and len(plain(whole)) == upload(spark).count()
    a, b = O.judge_sales(whole, t, p), O.judge_sales(sliced, t, p)
    assert plain(a[0].drop("record")) == plain(b[0].drop("record")) and rows(a[1]) == rows(b[1])
    # matched while it is staged or afterwards: the same customers
    c = O.judge_sales(O.stage(upload(spark), "sales", t), t, p)
    assert plain(c[0]) == plain(a[0]) and rows(c[1]) == rows(a[1])
    outcomes = [r.outcome for r in a[0].collect()]
    assert {"inserted", "duplicate", "removed", "skipped"} == set(outcomes) and len(outcomes) == upload(spark).count()
    for r in a[0].where("outcome <> 'inserted'").collect():
        assert json.loads(r.record) == {k: v for k, v in upload(spark).where(f"_row = {r._row.row}").drop("_row").first().asDict().items()}


def test_only_the_files_own_columns_are_staged(spark, scratch, monkeypatch):
    monkeypatch.setattr(O, "shared_path", lambda s, *parts: "/".join([scratch, *parts]))
    O.stage(upload(spark), "sales", star(spark), Params())
    written = spark.read.option("recursiveFileLookup", "true").parquet(f"{scratch}/uploads")
    assert set(written.columns) == {"_raw", "_d", "_row", "drug_key", "_ck", "outcome", "reason"}


def test_rows_meet_one_table_of_names(spark):
    t = star(spark)
    df = U.match_customers(U.resolve_drug(upload(spark), t["dim_drug"]), t["dim_customer"], Params())
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
    got = {(r.drug_name, r.drug_key) for r in df.collect()}
    assert {("Aspirin", 2), ("Ibu x", 7), ("none", None), (None, None)} <= got
    assert {(r.customer_name, r._ck) for r in df.collect()} >= {("Ann Lee", 5), ("ann", 5), ("New One", None), (None, None)}


def test_lines_of_the_sales_upload_meet_two_tables(spark):
    mk = spark.createDataFrame
    t = {"lineitem": mk([(o, p, 1, 2.0, 10.0, 0.1, 0.1) for o, p in [(1, 1), (1, 2), (2, 3), (9, 1), (2, None)]],
                        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
         "orders": mk([(1, 1, "2000-01-05"), (2, 2, "2000-01-05"), (2, None, "2000-01-06")], "o_orderkey long, o_custkey long, o_orderdate string"),
         "part": mk([(1, 5.0), (1, 6.0), (None, 7.0), (3, 8.0)], "p_partkey long, p_retailprice double"),
         "customer": mk([(1, 1), (2, 7)], "c_custkey long, c_nationkey long"),
         "nation": mk([(1, 0)], "n_nationkey long, n_regionkey long"), "region": mk([(0, "West")], "r_regionkey long, r_name string")}
    dims = {"dim_drug": mk([(2, "A b"), (3, "C d"), (3, "E f")], "drug_key long, drug_name string"),
            "dim_customer": mk([(18, "Ann", "Clinic", 1)], "customer_key long, customer_name string, customer_type string, geography_key long"),
            "dim_geography": mk([(1, "France", "Lyon")], "geography_key long, country_region string, city string")}
    up = adapter.sales_upload(t, dims, 24)
    got = [(r._row, r.drug_name, r.total_product_cost is None, r.customer_name, r.city, r.sales_territory_name) for r in up.collect()]
    ann, unknown = ("Ann", "Lyon", "West"), [("New Buyer 2", "", ""), (None, "", "")]
    want = [(9, "A b", False, *ann), (9, "A b", False, *ann), (9, "C d", True, *ann), (9, "E f", True, *ann),
            *[(17, "Qx-3", False, *x) for x in unknown], *[(17, None, True, *x) for x in unknown]]
    assert sorted(got, key=str) == sorted(want, key=str)
    # the lines are the plan's first leaf: what stands above it are the joins that they go through
    plan = up._jdf.queryExecution().optimizedPlan().toString().splitlines()
    leaf = next(i for i, x in enumerate(plan) if "l_partkey" in x and ("LogicalRDD" in x or "LocalRelation" in x))
    assert sum("Join" in x for x in plan[:leaf]) == 2


def test_queries_over_dimensions_build_no_fact(spark, small_star, monkeypatch):
    import __spark_entry__ as E
    from medistar.operators import facts

    sf = "/root/testdata/sf0.001"
    want = rows(small_star["dim_sales_territory"])
    monkeypatch.setattr(E, "_STARS", {})
    monkeypatch.setattr(E, "_DIMENSIONS", {})
    monkeypatch.setattr(E, "_code_digest", lambda: "dimensions-only")
    monkeypatch.setattr(facts, "transform_fact_sales", None)
    assert rows(E.queries()["dim_sales_territory"](spark, sf)) == want
    assert E.queries()["adhoc_sql"](spark, sf).count() > 0 and E.queries()["adhoc_sql_limit"](spark, sf).count() > 0
    assert E._STARS == {}
