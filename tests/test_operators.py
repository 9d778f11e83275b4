"""Custom operators against brute force on small fixtures."""
import random
import string

from pyspark.sql import functions as F

from medistar.operators.keys import assign_sequential_keys
from medistar.operators.matching import contains_join, first_match_key
from medistar.operators.upsert import insert_ignore, merge_upsert
from medistar.plans import monitor as M
import pytest


def test_contains_join_matches_brute_force(spark):
    rnd = random.Random(7)
    alphabet = "abcde "
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(120)]
    pats = sorted({"".join(rnd.choice(alphabet[:-1]) for _ in range(rnd.randint(1, 5))) for _ in range(60)})
    tdf = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    pdf = spark.createDataFrame([(p.upper(),) for p in pats], "p string")
    got = {(r.p, r.k) for r in contains_join(pdf, "p", tdf, "t").collect()}
    want = {(p.upper(), i) for p in pats for i, t in enumerate(texts) if p in t.lower()}
    assert got == want
    first = {r.p: r.out for r in first_match_key(pdf, "p", tdf, "t", "k", "out").collect()}
    assert first == {p.upper(): min(i for i, t in enumerate(texts) if p in t) for p in pats
                     if any(p in t for t in texts)}


def test_sequential_keys(spark):
    names = ["".join(random.Random(i).choice(string.ascii_lowercase) for _ in range(6)) + str(i) for i in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.k for r in assign_sequential_keys(df, ["n"], 99999, "k", num_partitions=7).collect()}
    assert got == {n: 100000 + i for i, n in enumerate(sorted(names))}
    start = spark.createDataFrame([(41,)], "s int")
    got2 = {r.n: r.k for r in assign_sequential_keys(df, ["n"], start, "k").collect()}
    assert min(got2.values()) == 42 and max(got2.values()) == 541


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "a", 10, "keep"), (2, "b", 20, "keep")], "k int, name string, v int, other string")
    new = spark.createDataFrame([(2, "B", 21, "new"), (3, "c", 30, "new"), (3, "c2", 31, "new")],
                                "k int, name string, v int, other string")
    out = {r.k: r for r in merge_upsert(target, new, ["k"], ["name", "v"]).collect()}
    assert out[1].name == "a" and out[1]._action == "keep"
    assert (out[2].name, out[2].v, out[2].other, out[2]._action) == ("B", 21, "keep", "update")
    assert out[3]._action == "insert" and out[3].other == "new"
    ins = insert_ignore(target, new, ["k"], [F.col("v")]).collect()
    assert [(r.k, r.name) for r in ins] == [(3, "c")]


def test_sql_guard():
    assert M.guard_sql("-- hi\nSELECT 1;") == "SELECT 1"
    for bad in ["DELETE FROM x", "SELECT 1; SELECT 2", "select * from t where 1=1 /* */ ; drop table t",
                "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "update t set a=1"]:
        with pytest.raises(M.UnsafeQuery):
            M.guard_sql(bad)
    assert M.guard_sql("SELECT 'drop' AS word") == "SELECT 'drop' AS word"


def test_contains_join_long_patterns_only(spark):
    """Only patterns of 3+ characters: texts emit 3-grams only; still exact."""
    rnd = random.Random(11)
    alphabet = "abcd"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 15))) for _ in range(150)]
    pats = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, 6))) for _ in range(50)})
    tdf = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    pdf = spark.createDataFrame([(p,) for p in pats], "p string")
    got = {(r.p, r.k) for r in contains_join(pdf, "p", tdf, "t").collect()}
    assert got == {(p, i) for p in pats for i, t in enumerate(texts) if p in t}
