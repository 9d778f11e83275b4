"""Real upload files, replays, leftovers and refused queries."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from medistar import session
from medistar.functions import exprs as X
from medistar.operators import uploads as U
from medistar.operators.matching import first_match_key
from medistar.params import Params
from medistar.plans import monitor as M
from medistar.plans.star import Star
from medistar.plans.warehouse import Warehouse
from medistar.sources.uploads import read_upload
from medistar.streaming.uploads import upload_stream

P = Params()
INV = "drug_name,snapshot_date,units_on_hand,units_ordered,units_dispatched,unit_cost"


def test_date_formats(spark):
    want = {
        "2024-1-5": dt.date(2024, 1, 5), "1/5/2024": dt.date(2024, 1, 5), "2024-01-05 10:00": dt.date(2024, 1, 5),
        "2024-01-05T10:00:00": dt.date(2024, 1, 5), "2024-01-05T10:00:00Z": dt.date(2024, 1, 5),
        "5 Jan 2024": dt.date(2024, 1, 5), "Jan 5, 2024": dt.date(2024, 1, 5), "05-01-2024": dt.date(2024, 5, 1),
        "25/01/2024": dt.date(2024, 1, 25), "25-01-2024": dt.date(2024, 1, 25), "20240105": dt.date(2024, 1, 5),
        "2024/01/05": dt.date(2024, 1, 5), "2024-01-05 10:00:30": dt.date(2024, 1, 5),
        "n/a": None, "": None, "2024-13-45": None,
    }
    df = spark.createDataFrame([(s,) for s in want], "s string")
    got = {r.s: r.d for r in df.select("s", U.parse_date("s").alias("d")).collect()}
    assert got == want


def test_quoted_names_and_column_order(spark, scratch):
    path = os.path.join(scratch, "quoted.csv")
    with open(path, "w") as f:
        f.write("Unit Cost,snapshot_date,units_on_hand,units_ordered,units_dispatched,Drug Name\n"
                '2.5,2025-06-01,40,1,1,"Acme ""Blue"" Forte, 5 mg"\n')
    up = read_upload(spark, path)
    row = up.df.first()
    assert up.kind == "inventory"
    assert row["drug_name"] == 'Acme "Blue" Forte, 5 mg' and row["unit_cost"] == "2.5"


def test_stream_lists_files_only(spark, scratch):
    s = upload_stream(spark, scratch)
    assert s.isStreaming and s.columns == ["path"]


def test_replay_resolves_to_the_same_customers(spark):
    dim = spark.createDataFrame([(7, 7, "Old Clinic East")], "customer_key long, source_customer_key long, customer_name string")
    rows = spark.createDataFrame([("Zedbuyer 1", "hospital"), ("A Zedbuyer 1", "clinic"), ("old clinic", "clinic"),
                                  ("x" * 45 + "1", "clinic"), ("x" * 45 + "2", "clinic")],
                                 "customer_name string, customer_type string")
    first, new = U.resolve_customers(rows, dim, P)
    one = {r.customer_name: r.customer_key for r in first.collect()}
    assert one["old clinic"] == 7 and len(set(one.values())) == 5
    dim2 = dim.unionByName(new.select(*dim.columns))
    again, new2 = U.resolve_customers(rows, dim2, P)
    assert {r.customer_name: r.customer_key for r in again.collect()} == one
    assert new2.count() == 0


def test_first_match_of_nothing(spark):
    none = spark.createDataFrame([], "p string")
    texts = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "k long, t string")
    assert first_match_key(none, "p", texts, "t", "k", "out").count() == 0
    some = spark.createDataFrame([("B",), (None,), ("",), ("zz",)], "p string")
    assert [tuple(r) for r in first_match_key(some, "p", texts, "t", "k", "out").collect()] == [("B", 1)]


def test_keys_above_32_bits(spark):
    df = spark.createDataFrame([("3000000001",), ("12.0",), ("x",), ("99999999999999999999",)], "s string")
    assert [r[0] for r in df.select(X.long_key("s")).collect()] == [3000000001, 12, None, None]
    assert [r[0] for r in df.select(X.safe_date_key("s", -1)).collect()] == [-1, 12, -1, -1]


def test_leftover_folder_does_not_block(spark, scratch):
    wh = Warehouse(spark, os.path.join(scratch, "wh_left"))
    os.makedirs(os.path.join(scratch, "wh_left", "t", "load=00001"))
    wh.write_snapshot("t", spark.range(3))
    assert [f.split("/")[-1] for f in wh.folders("t")] == ["load=00002"] and wh.read("t").count() == 3


@pytest.fixture(scope="module")
def mini(spark):
    return Star({"dim_x": spark.range(500).select(F.col("id").alias("k"))})


@pytest.mark.parametrize("sql", [
    "SELECT java_method('java.lang.System', 'currentTimeMillis')",
    "SELECT reflect('java.lang.System', 'currentTimeMillis')",
    "SELECT * FROM text.`/etc/hosts`",
    "SELECT * FROM `parquet`.`/tmp/x`",
    "SELECT * FROM other_table",
    "SELECT k FROM dim_x WHERE k IN (SELECT k FROM hidden)",
    "WITH a AS (SELECT * FROM hidden) SELECT * FROM a",
    "SELECT * FROM range(5)",
])
def test_refused(spark, mini, sql):
    with pytest.raises(M.UnsafeQuery):
        M.adhoc_sql(spark, mini, sql)


def test_literals_limits(spark, mini):
    assert M.adhoc_sql(spark, mini, "SELECT 'a--b;c' AS s, count(*) AS n FROM dim_x -- note").first().s == "a--b;c"
    assert M.adhoc_sql(spark, mini, "SELECT k FROM dim_x").count() == M.ADHOC_LIMIT
    assert M.adhoc_sql(spark, mini, "SELECT k FROM dim_x ORDER BY k LIMIT 400 OFFSET 5").count() == 400
    assert M.adhoc_sql(spark, mini, "WITH a AS (SELECT k FROM dim_x), b AS (SELECT k FROM a) "
                                    "SELECT count(*) AS n FROM b").first().n == 500


def test_session_keeps_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert session.get_spark().conf.get("spark.sql.shuffle.partitions") == "13"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
