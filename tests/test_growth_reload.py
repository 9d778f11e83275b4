"""A reload stages what changes, not what is there already."""

from medistar.plans import warehouse as W


def test_reload_stages_only_rows_with_new_keys(spark, scratch, monkeypatch):
    wh = W.Warehouse(spark, f"{scratch}/wh")
    spec = W.TableSpec(("a", "b"), None)
    schema = "a long, b string, v long"
    wh.load("t", spark.createDataFrame([(k, "x", k) for k in range(50)], schema), spec)
    staged = []
    drop = W.fs_drop
    monkeypatch.setattr(W, "fs_drop", lambda s, p: (
        staged.append([r for r in s.read.option("recursiveFileLookup", "true").parquet(p).collect() if "v" in r and r.v is not None]), drop(s, p)))
    again = [(k, "x", -k) for k in range(50)] + [(50, "x", 7), (50, "x", 6), (None, "x", 9), (None, "x", 8), (3, None, 5)]
    res = wh.load("t", spark.createDataFrame(again, schema), spec)
    assert (res.read, res.inserted, res.updated, res.skipped, res.kept) == (55, 3, 0, 52, 0)
    got = {tuple(r) for r in wh.read("t").collect()}
    assert got == {(k, "x", k) for k in range(50)} | {(50, "x", 6), (None, "x", 8), (3, None, 5)}
    assert len(staged[0]) <= 3


def test_upsert_stages_kept_rows_without_their_columns(spark, scratch, monkeypatch):
    wh = W.Warehouse(spark, f"{scratch}/wh")
    spec = W.TableSpec(("k",), ("v",))
    wh.load("t", spark.createDataFrame([(k, k, "old") for k in range(20)], "k long, v long, w string"), spec)
    staged = []
    drop = W.fs_drop
    monkeypatch.setattr(W, "fs_drop", lambda s, p: (staged.extend(s.read.parquet(p).collect()), drop(s, p)))
    rows = [(k, k + (k == 4), "new") for k in range(21)] + [(4, 3, "new")]
    res = wh.load("t", spark.createDataFrame(rows, "k long, v long, w string"), spec)
    assert (res.read, res.inserted, res.updated, res.skipped, res.kept) == (22, 1, 1, 1, 19)
    assert {tuple(r) for r in wh.read("t").collect()} == {(k, k + (k == 4), "new" if k == 20 else "old") for k in range(21)}
    assert all(r.w is None for r in staged if r["_do"] == "keep")
