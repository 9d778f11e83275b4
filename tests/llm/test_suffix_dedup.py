import random
from collections import Counter

import numpy as np
import pytest

from medistar.llm import suffix_dedup as S

from .helpers import corpus, empty, frame


def brute(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for key, t in texts:
        mask = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mask[i:i + length] = [True] * length
        runs = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        out.append((key, len(t), sum(mask), runs, bytes(c for c, m in zip(t, mask) if not m)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in df.collect()), key=str)


@pytest.mark.parametrize("length,gram,bucket_rows", [(200, 48, 40_000), (200, 48, 20), (24, 8, 7), (9, 8, 5)])
def test_against_brute_force(spark, length, gram, bucket_rows):
    rows = corpus(90, seed=length + bucket_rows)
    rows += [(700, "ha " * 300, None, None, 0), (701, "é" * 500, None, None, 0), (702, "ha " * 120 + "end", None, None, 0),
             (703, "a" * length, None, None, 0), (704, "b" * length + "c" + "b" * (length - 1), None, None, 0)]
    # a passage with a different left and right side in every row, beyond one bucket
    rnd = random.Random(length)
    word = lambda k: "".join(rnd.choice("abcdéfg \n") for _ in range(k))
    passage = word(max(length, 40) * 2)
    for i in range(60):
        a, b = sorted(rnd.sample(range(len(passage)), 2))
        rows.append((800 + i, word(30) + passage[a:b + length] + word(25), None, None, 0))
    docs = frame(spark, rows).selectExpr("*", "1 AS d", "2 AS t", "3 AS pos", "4 AS spans", "5 AS kept")
    assert got(S.dedup(docs, length, gram, 4, bucket_rows)) == brute(rows, length)


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(S, "_CHUNK", 3000)
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice("ab\0") for _ in range(rnd.choice([10, 2000, 9000]))) + "xy" * 4000, "en", "s", 1) for i in range(9)]
    texts = [r[1].encode() for r in rows]
    want = {(i, p) for i, t in enumerate(texts) for p in range(len(t) - 199)}
    have = []
    for run in S.pieces(texts, 200):
        _, (piece, first, n, _w) = S.contexts(run, 200, 48)
        have += [(run[q][0], run[q][1] + f + x) for q, f, k in zip(piece, first, n) for x in range(k)]
    assert len(have) == len(set(have)) and set(have) == want


def test_multikey_sort():
    rnd = np.random.default_rng(3)
    m = rnd.integers(0, 2, (300, 16), dtype=np.uint8)
    order, lcp = S.multikey_sort(m)
    rows = [bytes(x) for x in m[order]]
    assert rows == sorted(rows)
    assert list(lcp[1:]) == [next((i for i in range(16) if a[i] != b[i]), 16) for a, b in zip(rows, rows[1:])]


def test_empty_and_short(spark):
    assert S.dedup(empty(spark)).count() == 0
    rows = [(1, "short", None, None, 0), (2, "short", None, None, 0), (None, None, None, None, None)]
    assert got(S.dedup(frame(spark, rows))) == brute(rows, 200)
