"""An upload's names are looked up and its rows judged once."""

from medistar.operators import outcomes as O
from medistar.operators import uploads as U


def test_rows_are_judged_once_for_the_report(spark, scratch):
    rows = spark.createDataFrame([("inserted", None), ("removed", "x"), ("removed", "x")], "outcome string, reason string")
    rows.write.parquet(f"{scratch}/judged")
    report = O.report(spark.read.parquet(f"{scratch}/judged"), "sales")
    assert {tuple(r) for r in report.collect()} == {
        ("sales", "inserted", None, 1), ("sales", "removed", "x", 2), ("sales", "read", None, 3)}
    assert report._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") == 1
    empty = O.report(spark.read.parquet(f"{scratch}/judged").where("false"), "sales")
    assert [tuple(r) for r in empty.collect()] == [("sales", "read", None, 0)]


def test_names_are_looked_up_once_each(spark):
    drugs = spark.createDataFrame([(2, "Aspirin 5mg Tablet"), (1, "ASPIRIN 5mg tablet"), (7, "Ibuprofen Gel")], "drug_key long, drug_name string")
    names = ["aspirin 5MG tablet", "Ibu x", "none here", None, " ", "Gel"] * 3
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, drug_name string")
    want = {n: k for n, k in zip(names, [1, 7, None, None, None, 7])}
    got = U.resolve_drug(rows, drugs)
    assert {(r.i, r.drug_key) for r in got.collect()} == {(i, want[n]) for i, n in enumerate(names)}
    assert got.columns == ["i", "drug_name", "drug_key"]


def test_names_are_met_before_rows_are_cleansed(spark, scratch, monkeypatch):
    met = []
    resolve = U.resolve_drug
    monkeypatch.setattr(U, "resolve_drug", lambda rows, *a: (met.append(rows.columns), resolve(rows, *a))[1])
    monkeypatch.setattr(O, "shared_path", lambda s, *parts: "/".join([scratch, *parts]))
    tables = {"dim_drug": spark.createDataFrame([(2, "Aspirin")], "drug_key long, drug_name string"),
              "dim_date": spark.createDataFrame([(20240105,)], "date_key int")}
    cols = ["drug_name", "snapshot_date", "units_on_hand", "units_ordered", "units_dispatched", "unit_cost"]
    rows = [(" aspirin ", "2024-01-05"), ("Aspirin", "never"), ("none", "2024-01-05"), ("Aspirin", "2024-01-06"), (None, "2024-01-05")]
    up = spark.createDataFrame([(n, d, "1", "2", "3", "4") for n, d in rows], ", ".join(f"{c} string" for c in cols))
    got = {(r.drug_name, r.drug_key, r.outcome, r.reason) for r in O.stage(up, "inventory", tables).collect()}
    assert got == {("aspirin", 2, None, None), ("Aspirin", None, "removed", "bad_dates"), ("none", None, "skipped", "Drug not found"),
                   ("Aspirin", 2, "skipped", "Date not in dim_date"), (None, None, "removed", "null_critical")}
    assert met == [[*cols, "_row", "_name"]]


def test_cleansing_the_sales_upload_builds_no_fact(spark, small_star, monkeypatch):
    """The upload is made of the driver tables and the star's dimensions."""
    import __spark_entry__ as E
    from medistar.operators import facts
    from medistar.sources import adapter

    sf = "/root/testdata/sf0.001"
    up = adapter.sales_upload(adapter.read_driver_tables(spark, sf), small_star.tables, E.PARAMS.shift_years)
    want = U.transform_sales_upload(up).clean.drop("_row")
    monkeypatch.setattr(E, "_STARS", {})
    monkeypatch.setattr(E, "_DIMENSIONS", {})
    monkeypatch.setattr(E, "_code_digest", lambda: "no-fact")  # as if no star were published for this code
    monkeypatch.setattr(facts, "transform_fact_sales", None)
    got = E.upload_sales_clean(spark, sf)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.count() > 0 and E._STARS == {}
