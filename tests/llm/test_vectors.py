import math
import random

import numpy as np
from pyspark.sql import functions as F

from medistar.llm import ann, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(n=400, d=12, seed=1, hot=0):
    rnd = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(0, 0.4, d)], 1) for i in range(n)]
    one = rows[7][1]
    rows += [(n + i, one, 0) for i in range(hot)]  # one vector, many times
    nan, inf = float("nan"), float("inf")
    rows += [(10_000, None, 0), (10_020, [0.1, None] + [0.2] * (d - 2), 0), (10_040, [nan] * d, 0), (10_060, [inf] * d, 0),
             (10_080, [0.1] * (d - 1), 0), (None, [0.1] * d, 0), (10_100, [], 0), rows[20], rows[20]]
    # one id with two vectors, and vectors of other lengths
    rows += [(40, rows[3][1], 0), (41, rows[5][1], 0)]
    rows += [(40_000 + 20 * i, [float(np.float32(x)) for x in rnd.normal(0, 1, 3)], 0) for i in range(30)]
    return rows


def taking_part(rows, nonzero):
    """The different (id, vector) that take part."""
    return sorted({(i, tuple(v)) for i, v, _ in rows if i is not None and v
                   and all(x is not None and math.isfinite(x) for x in v) and (any(v) or not nonzero)})


def brute(vec, k):
    """Each query id's k best (id, score) among the vectors of its length under other ids."""
    out = {}
    for i in {i for i, _ in vec if i % 20 == 0}:
        q = min(v for j, v in vec if j == i)
        others = [(j, v) for j, v in vec if j != i and len(v) == len(q)]
        if others:
            s = np.array([v for _, v in others]) @ np.array(q)
            ids = np.array([j for j, _ in others])
            out[i] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s))[:k]]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_topk_is_exact(spark):
    rows = table(hot=250) + [(20_000, [0.0] * 12, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS rank", "2 AS block", "3 AS v")
    got = by_query(topk.search(df, size=64, pack=8).collect())
    vec = sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in taking_part(rows, False)})
    assert got == brute(vec, 20) and len({len(v) for _, v in vec}) == 3


def test_topk_large_values_and_few_candidates(spark):
    rows = [(i, [float(2 ** 24 - i), float(i), -3.0], 0) for i in range(0, 12)]
    got = by_query(topk.search(spark.createDataFrame(rows, SCHEMA), scale=2.0 ** 3).collect())
    vec = {i: [math.floor(8 * x) for x in v] for i, v, _ in rows}
    want = sorted(((j, sum(a * b for a, b in zip(vec[0], vec[j]))) for j in range(1, 12)), key=lambda x: (-x[1], x[0]))
    assert got == {0: want}
    assert topk.search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cutoff_is_safe_with_negative_partials():
    rnd = np.random.default_rng(2)
    q, v = rnd.integers(-50, 50, (6, 10)).astype(float), rnd.integers(-50, 50, (80, 10)).astype(float)
    qi, vi = np.arange(6), np.arange(80)
    low = np.array([x[-1] for x in topk.gather(qi, q, vi, v, 5, 4)], dtype=float)
    a, b, s = topk.resolve(qi, q, low, vi, v, 5, 4)
    for i in qi:
        full = sorted(((-float(q[i] @ v[j]), int(j)) for j in vi if j != i))[:5]
        assert sorted((-float(x), int(j)) for x, j in zip(s[a == i], b[a == i])) == full


def test_ann_recall_and_exact_scores(spark):
    rows = table(n=2000, d=12, seed=4, hot=300) + [(20_000, [0.0] * 12, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).selectExpr("*", "1 AS rank", "2 AS grp", "3 AS v")
    got = by_query(ann.search(df, size=256, pack=16).collect())
    vec = taking_part(rows, True)
    want = brute(vec, 20)
    assert set(got) == set(want)
    assert {q: [i for i, _ in x] for q, x in got.items() if q >= 40_000} == {
        q: [i for i, _ in x] for q, x in want.items() if q >= 40_000}  # vectors of a rare length are scanned whole
    hits = 0
    for q, found in got.items():
        assert len(found) == len(want[q]) and q not in dict(found)
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        mine = min(v for j, v in vec if j == q)
        for i, s in found:
            assert any(abs(s - np.dot(mine, v)) < 1e-12 for j, v in vec if j == i and len(v) == len(mine))
        hits += len({s for _, s in found} & {s for _, s in found}) and sum(s >= want[q][-1][1] - 1e-12 for _, s in found)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_ann_few_rows_and_empty(spark):
    rows = [(i, [1.0 * i + 1, 2.0], 0) for i in range(15)]
    got = by_query(ann.search(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [i for i, _ in got[0]] == list(range(14, 0, -1))
    assert ann.search(spark.createDataFrame([], SCHEMA)).count() == 0


def test_scan_abandons_but_keeps_the_near():
    rnd = np.random.default_rng(6)
    v = rnd.normal(size=(3000, 40))
    q = v[:20] + 0.1 * rnd.normal(size=(20, 40))
    longest = float((v ** 2).sum(1).max())
    rot = ann.rotation(41)
    full = q @ v.T
    cut = np.sort(full, axis=1)[:, -10]
    a, b, s = ann.scan(np.arange(20) + 10 ** 6, q, cut, np.arange(3000), v, longest, rot, 10)
    assert len(a) >= 0.95 * 200 and np.allclose(s, full[a - 10 ** 6, b])


def test_blocks_split_a_hot_group(spark):
    df = spark.range(5000).select(F.lit(3).cast("long").alias("grp"), F.col("id").alias("vec_id"),
                                  F.array(F.col("id").cast("double")).alias("v"), F.lit(0.5).alias("extra"))
    got = vectors.blocks(df, 500).collect()
    assert sum(r.n for r in got) == 5000 and max(r.n for r in got) < 700
    assert sorted(x for r in got for x in np.frombuffer(r.ids, np.int64)) == list(range(5000))
    random.seed(0)


def test_topk_cutoff_spares_scores():
    rnd = np.random.default_rng(7)
    v = rnd.normal(size=(900, 64))
    v[:60] = v[0] + 0.2 * rnd.normal(size=(60, 64))  # near one another: a high cutoff, which few rows come near
    v = np.floor(64 * v / np.linalg.norm(v, axis=1)[:, None])
    vi = np.arange(900) * 3
    q, qi = v[:40], vi[:40]
    full = q @ v.T
    full[np.arange(40), np.arange(40)] = -np.inf
    low = np.sort(full, axis=1)[:, -5]  # the sharpest safe cutoff
    assert all(x[-1] <= y for x, y in zip(topk.gather(qi, q, vi, v, 5, 8), low))
    i, j, _, done = topk.collect(qi, q, low, vi, v, 8)
    assert done < 8 and len(i) < 0.125 * 40 * 900
    a, b, s = topk.resolve(qi, q, low, vi, v, 5, 8)
    for r in range(40):
        full = sorted((-float(q[r] @ v[c]), int(vi[c])) for c in range(900) if vi[c] != qi[r])[:5]
        assert sorted((-float(x), int(y)) for x, y in zip(s[a == qi[r]], b[a == qi[r]])) == full
