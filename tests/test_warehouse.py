"""Warehouse sinks: full pipeline, idempotent reload, uploads, audit, streaming."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from medistar.params import Params
from medistar.plans import monitor as M
from medistar.plans.pipeline import run_full_etl, run_pipeline
from medistar.plans.warehouse import ConcurrentLoad, Warehouse, load_all
from medistar.sources import adapter
from medistar.streaming.uploads import start_upload_stream

from tests.conftest import SF_SMALL
from tests.test_uploads import INVENTORY_CSV, SALES_CSV

P = Params()


def _counts(wh):
    return {t: wh.read(t).count() for t in ["dim_drug", "dim_customer", "fact_drug_sales", "fact_inventory"]}


def test_pipeline_idempotent_and_uploads(spark, scratch):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    out = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)
    wh = out["warehouse"]
    first = _counts(wh)
    assert first["fact_drug_sales"] > 0 and out["checks"].where("status = 'FAIL'").count() == 0
    # loading the same star again changes nothing
    summary = {r.table: r for r in load_all(wh, out["star"], P).collect()}
    assert summary["fact_drug_sales"].inserted == 0 and summary["dim_drug"].inserted == 0
    assert summary["fact_inventory"].updated == 0 and summary["fact_inventory"].kept == first["fact_inventory"]
    assert _counts(wh) == first
    # the sales template: drug names are not in this star except by fuzzy first token
    up = os.path.join(scratch, "sales.csv")
    with open(up, "w") as f:
        f.write(SALES_CSV)
    rep = run_full_etl(spark, up, wh, P, batch_id="UP1")
    assert rep["type"] == "sales"
    n1 = wh.read("fact_drug_sales").count()
    rep2 = run_full_etl(spark, up, wh, P, batch_id="UP2")
    assert wh.read("fact_drug_sales").count() == n1 and rep2["load"]["inserted"] == 0
    inv = os.path.join(scratch, "inv.csv")
    with open(inv, "w") as f:
        f.write(INVENTORY_CSV.replace("2026-03-22", "2025-06-01"))
    rep3 = run_full_etl(spark, inv, wh, P, batch_id="UP3")
    assert rep3["type"] == "inventory"
    audit = wh.audit_log()
    assert audit.count() == 8 + 8 + 3
    assert M.recent_etl_runs(audit, 5).count() == 5
    assert M.etl_timeline(audit).count() >= 1
    assert M.row_counts(wh.star(), audit).where("table = 'TOTAL'").count() == 1


def test_upload_stream(spark, scratch):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    wh = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)["warehouse"]
    folder = os.path.join(scratch, "incoming")
    os.makedirs(folder)
    name = wh.read("dim_drug").orderBy("drug_key").first().drug_name
    for i, units in enumerate([40, 400]):
        with open(os.path.join(folder, f"inv_{i}.csv"), "w") as f:
            f.write("drug_name,snapshot_date,units_on_hand,units_ordered,units_dispatched,unit_cost\n"
                    f"{name},2025-06-01,{units},1,1,2.5\n")
    reports = []
    q = start_upload_stream(spark, folder, "inventory", wh, P, checkpoint=os.path.join(scratch, "ckpt"),
                            reports=reports)
    q.awaitTermination(300)
    assert len(reports) == 2
    key = wh.read("dim_drug").orderBy("drug_key").first().drug_key
    row = wh.read("fact_inventory").where(f"drug_key = {key} AND snapshot_date_key = 20250601").collect()
    assert len(row) == 1 and row[0].units_on_hand == 400 and row[0].stock_status == "In Stock"
    shutil.rmtree(os.path.join(scratch, "ckpt"), ignore_errors=True)


def test_sales_upload_stream(spark, scratch):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    wh = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)["warehouse"]
    folder = os.path.join(scratch, "incoming_sales")
    os.makedirs(folder)
    d = wh.read("dim_drug").orderBy("drug_key").first().drug_name
    c = wh.read("dim_customer").orderBy("customer_key").first().customer_name
    header = ("drug_name,customer_name,customer_type,order_date,units_sold,unit_price,unit_price_discount_pct,"
              "total_product_cost,sales_amount,tax_amt,freight,sales_territory_name,country_region,city\n")
    for i in range(2):
        with open(os.path.join(folder, f"sales_{i}.csv"), "w") as f:
            f.write(header + f"{d},{c},clinic,2024-03-0{i + 1},3,10.00,0,2.00,30.00,1.00,0.50,,France,Paris\n"
                    + f"{d},New Buyer X,hospital,2024-03-0{i + 1},1,5.00,0,1.00,5.00,0,0,,,\n")
    reports = []
    n0 = wh.read("fact_drug_sales").count()
    q = start_upload_stream(spark, folder, "sales", wh, P, checkpoint=os.path.join(scratch, "ckpt_s"),
                            reports=reports)
    q.awaitTermination(300)
    assert len(reports) == 2 and all(r["load"]["inserted"] == 2 for r in reports)
    assert wh.read("fact_drug_sales").count() == n0 + 4
    # the new buyer was created once and reused by the second micro-batch
    assert wh.read("dim_customer").where("customer_name = 'New Buyer X'").count() == 1


def test_fact_upsert_rewrites_only_touched_years(spark, scratch):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    wh = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)["warehouse"]

    def files(year):
        dirs = [d for d in wh.folders("fact_inventory") if d.endswith(f"snapshot_year={year}")]
        return sorted(os.path.join(d, f) for d in dirs for f in os.listdir(d))

    before = {y: files(y) for y in range(2019, 2026)}
    inv = wh.read("fact_inventory")
    n0 = inv.count()
    batch = (inv.where("snapshot_year = 2025").limit(3)
             .withColumn("units_on_hand", F.lit(7)).withColumn("stock_status", F.lit("Critical")))
    new_row = inv.where("snapshot_year = 2025").limit(1).withColumn("snapshot_date_key", F.lit(20250630))
    res = wh.load("fact_inventory", batch.unionByName(new_row))
    assert (res.inserted, res.updated) == (1, 3)
    after = wh.read("fact_inventory")
    assert after.count() == n0 + 1
    assert after.where("units_on_hand = 7 AND stock_status = 'Critical'").count() == 3
    for y in range(2019, 2025):
        assert files(y) == before[y], y   # untouched years keep exactly their files
    assert files(2025) != before[2025]


def test_pipeline_report_matches_lazy_report(spark, scratch, small_star):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    out = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)
    # the report is a grouped count of written rows: asking again gives the same
    observed = {(r.table, r.kind, r.reason): r.rows for r in out["report"].collect()}
    lazy = {(r.table, r.kind, r.reason): r.rows for r in small_star.report.collect()}
    assert observed == lazy and observed[("fact_drug_sales", "removed", "drug_not_found")] > 0


def test_failed_load_leaves_readers_unchanged(spark, scratch):
    wh = Warehouse(spark, os.path.join(scratch, "wh"))
    inv = "snapshot_date_key int, drug_key long, units_on_hand long, units_ordered int, units_dispatched int, " \
          "safety_stock_level int, reorder_point int, stock_value decimal(18,4), days_of_supply decimal(10,2), " \
          "stock_status string, etl_batch_id string, snapshot_year int"
    row = lambda day, drug, units: (day, drug, units, 0, 0, 0, 0, None, None, "x", "b", day // 10000)
    wh.load("fact_inventory", spark.createDataFrame([row(20240101, 1, 5), row(20250101, 1, 6)], inv))
    before = wh.read("fact_inventory")  # a reader of the old version
    batch = spark.createDataFrame([row(20240101, 1, 50), row(20240201, 2, 7), row(20260101, 1, 8), row(20250101, 1, 6)], inv)
    failing = batch.withColumn("units_on_hand", F.when(F.col("drug_key") == 2, F.raise_error(F.lit("lost")).cast("long"))
                               .otherwise(F.col("units_on_hand")))
    with pytest.raises(Exception, match="lost"):
        wh.load("fact_inventory", failing)
    # one that fails after its rows are written, before the switch
    commit, wh._commit = wh._commit, None
    with pytest.raises(TypeError):
        wh.load("fact_inventory", batch)
    wh._commit = commit
    units = lambda df: sorted((r.snapshot_date_key, r.drug_key, r.units_on_hand) for r in df.collect())
    assert units(wh.read("fact_inventory")) == [(20240101, 1, 5), (20250101, 1, 6)]
    res = wh.load("fact_inventory", batch)
    assert (res.read, res.inserted, res.updated, res.kept) == (4, 2, 1, 1)
    assert units(wh.read("fact_inventory")) == [(20240101, 1, 50), (20240201, 2, 7), (20250101, 1, 6), (20260101, 1, 8)]
    assert units(before) == [(20240101, 1, 5), (20250101, 1, 6)]
    wh.vacuum("fact_inventory")
    assert len(units(wh.read("fact_inventory"))) == 4 and wh.load("fact_inventory", batch).kept == 4


def test_concurrent_loads(spark, scratch):
    a, b = (Warehouse(spark, os.path.join(scratch, "wh")) for _ in range(2))
    a.write_snapshot("t", spark.range(3))
    state, a.state = a.state("t"), lambda t: state
    b.write_snapshot("t", spark.range(5))
    with pytest.raises(ConcurrentLoad):
        a.write_snapshot("t", spark.range(7))
    assert b.read("t").count() == 5


SALES_HEAD = ("drug_name,customer_name,customer_type,order_date,units_sold,unit_price,unit_price_discount_pct,"
              "total_product_cost,sales_amount,tax_amt,freight,sales_territory_name,country_region,city\n")


def test_upload_outcomes_add_up_and_replay(spark, scratch):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    wh = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)["warehouse"]
    d = wh.read("dim_drug").orderBy("drug_key").first().drug_name
    rows = [f"{d},Buyer {i % 3},clinic,{date},{units},10.00,0,2.00,30.00,1.00,0.50,,France,Paris"
            for i, (date, units) in enumerate([("2024-03-01", 3), ("2024-03-01", 3), ("2024-03-01", 3), ("2024-03-01", 3),
                                               ("n/a", 1), ("2024-03-02", 0), ("1999-01-01", 4)])]
    rows.append("Unheard-of,Buyer 1,clinic,2024-03-01,3,10.00,0,2.00,30.00,1.00,0.50,,France,Paris")
    path = os.path.join(scratch, "sales.csv")
    with open(path, "w") as f:
        f.write(SALES_HEAD + "\n".join(rows) + "\n")
    p1 = P.with_(batch_id="S1", once=True, batch_clock="2025-06-28 06:00:00")
    rep = run_full_etl(spark, path, wh, p1)
    want = {("read", None): 8, ("inserted", None): 3, ("duplicate", "repeated order line"): 1, ("removed", "bad_dates"): 1,
            ("removed", "zero_units"): 1, ("skipped", "Date not in dim_date"): 1, ("skipped", "Drug not found"): 1}
    assert rep["rows"] == want and rep["new_customers"] == 3
    kept_out = {r.reason: r.record for r in wh.rejects("S1").collect()}
    assert len(kept_out) == 5 and "Unheard-of" in kept_out["Drug not found"] and "1999-01-01" in kept_out["Date not in dim_date"]
    # the same batch again loads and records nothing; another batch of the same file finds its lines known
    n, entries = wh.read("fact_drug_sales").count(), wh.audit_log().count()
    assert run_full_etl(spark, path, wh, p1)["rows"] == want
    assert (wh.read("fact_drug_sales").count(), wh.audit_log().count()) == (n, entries)
    rep = run_full_etl(spark, path, wh, p1.with_(batch_id="S2"))
    assert rep["rows"][("known", "already loaded")] == 3 and ("inserted", None) not in rep["rows"]
    assert sum(v for k, v in rep["rows"].items() if k[0] != "read") == 8 and wh.audit_log().count() == entries + 1
    inv = os.path.join(scratch, "inv.csv")
    with open(inv, "w") as f:
        f.write("drug_name,snapshot_date,units_on_hand,units_ordered,units_dispatched,unit_cost\n"
                f"{d},2025-06-02,5,1,1,2.5\n{d},2025-06-02,7,1,1,2.5\n{d.upper()},2025-06-02,9,1,1,2.5\n"
                f",2025-06-02,5,1,1,2.5\n{d},bad,5,1,1,2.5\nUnheard-of,2025-06-02,5,1,1,2.5\n")
    rep = run_full_etl(spark, inv, wh, p1.with_(batch_id="I1"))
    assert rep["rows"] == {("read", None): 6, ("inserted", None): 1, ("duplicate", "repeated drug and date"): 2,
                           ("removed", "bad_dates"): 1, ("removed", "null_critical"): 1, ("skipped", "Drug not found"): 1}
    assert wh.read("fact_inventory").where("snapshot_date_key = 20250602").first().units_on_hand == 9
    # an upload of the other kind under the same batch id keeps the first one's rejects
    run_full_etl(spark, inv, wh, p1)
    assert wh.rejects("S1").where("upload = 'sales'").count() == 5 and wh.rejects("S1").where("upload = 'inventory'").count() == 5


def test_replay_after_a_failure_past_the_load(spark, scratch, monkeypatch):
    raw = adapter.load_driver_raw(spark, SF_SMALL)
    wh = run_pipeline(spark, raw, os.path.join(scratch, "wh"), P)["warehouse"]
    name = wh.read("dim_drug").orderBy("drug_key").first().drug_name
    folder = os.path.join(scratch, "incoming")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write(f"drug_name,snapshot_date,units_on_hand,units_ordered,units_dispatched,unit_cost\n{name},2025-06-03,5,1,1,2.5\n")
    audit, calls = Warehouse.audit, []

    def lost(self, rows):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("driver lost after the load")
        audit(self, rows)
    monkeypatch.setattr(Warehouse, "audit", lost)
    entries = wh.audit_log().count()
    run = lambda: start_upload_stream(spark, folder, "inventory", wh, P, checkpoint=os.path.join(scratch, "ck"))
    with pytest.raises(Exception):
        run().awaitTermination(300)
    version = wh.state("fact_inventory")["version"]
    run().awaitTermination(300)
    run().awaitTermination(300)
    assert wh.state("fact_inventory")["version"] == version and wh.audit_log().count() == entries + 1
    last = wh.audit_log().where("batch_id like '%STREAM%'").collect()
    assert [(r.rows_read, r.rows_inserted, r.rows_updated) for r in last] == [(1, 1, 0)]
