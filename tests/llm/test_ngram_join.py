import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from medistar.llm import ngram_join as J

from .helpers import corpus, empty, frame

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, num, den):
    sets = {}
    for r in rows:
        if r[0] is not None:
            sets[r[0]] = shingles(r[1], k)
    ids, root = sorted(sets), {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def near(seed, sizes, edits):
    """Groups of variants of texts of given sizes."""
    rnd, rows = random.Random(seed), []
    for s in sizes:
        base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(s)]
        for _ in range(5):
            t = list(base)
            for _ in range(rnd.choice(edits)):
                at = rnd.randrange(len(t))
                t[at:at + rnd.choice([0, 1])] = [f"e{rnd.randrange(10 ** 6)}"] * rnd.choice([0, 1])
            rows.append((len(rows), " ".join(t), None, None, 0))
    return rows


@pytest.mark.parametrize("k,num,den", [(4, 85, 100), (5, 80, 100), (1, 60, 100)])
def test_against_brute_force(spark, k, num, den):
    rows = corpus(60) + [(1000 + i, *r[1:]) for i, r in enumerate(near(k, [3, 5, 8, 12, 16, 20, 30, 60, 120, 200], [0, 1, 1, 2, 3]))]
    docs = frame(spark, rows).selectExpr("*", "1 AS s1", "2 AS rep", "3 AS component_id")
    got = J.join_components(docs, k, num, den).where("doc_id is not null").distinct()
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, k, num, den)


def test_blocks_and_hot_keys_lose_nothing(spark):
    rows = near(9, [150] * 6, [0, 1, 2, 3, 4, 6]) + [(500 + i, r[1].upper(), None, None, 0) for i, r in enumerate(near(9, [150], [1, 5, 6]))]
    got = J.join_components(frame(spark, rows), 4, 85, 100, block=400, bucket=2).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 4, 85, 100)


def chain(n, size, step):
    """Texts of which each links with the next ones only."""
    return [" ".join(f"c{j}" for j in range(i * step, i * step + size)) for i in range(n)]


def test_large_groups_of_near_copies_chains_and_ids_with_several_texts(spark):
    rows = near(4, [120], [1, 2]) + near(5, [90] * 3, [0, 1, 2])
    texts = [r[1] for r in rows] + chain(40, 100, 3)
    rnd = random.Random(6)
    base = [f"b{j}" for j in range(80)]
    texts += [" ".join(base[:i] + [f"x{i}"] + base[i + 1:]) for i in range(80)]
    texts += [" ".join([f"p{j}" for j in range(50)] + [f"q{rnd.randrange(10 ** 6)}" for _ in range(9)]) for _ in range(20)]
    rnd.shuffle(texts)
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    want = brute(rows, 4, 85, 100)
    for block, bucket in ((300, 3), (1 << 18, 5)):
        got = J.join_components(frame(spark, rows), 4, 85, 100, block=block, bucket=bucket).collect()
        assert sorted(tuple(r) for r in got) == want, (block, bucket)


def test_what_large_groups_deal_grows_with_their_size(spark):
    """Of a group whose members the first chunk connects, but for a few, hardly more rows are dealt than it has."""
    def dealt(n):
        members = spark.range(n).selectExpr("1L as g", "id", f"{n}L as size")
        first = J.deal(J.first_chunks(members, ["id"], 50))
        comp = spark.range(n - 5).selectExpr("id", "0L as component")
        rest = J.deal(J.rest_chunks(members, "g", "id", ["id"], F.lit(1), 50, comp))
        pairs = rest.groupBy("at").agg(F.collect_set("id").alias("ids")).collect()
        apart = {frozenset((x, y)) for p in pairs for x in p.ids for y in p.ids if x != y}
        assert all(frozenset((x, y)) in apart for x in range(n - 5, n) for y in range(n) if x != y)
        return first.count() + rest.count()

    assert dealt(4000) < 2.5 * dealt(2000) < 2.5 * 6 * 2000


def test_null_id_empty_and_wordless(spark):
    rows = [(None, "a b c d e f", None, None, 0), (1, None, None, None, 0), (2, "", None, None, 0), (3, " \n", None, None, 0),
            (4, "Only Two", None, None, 0), (5, "only two", None, None, 0), (6, "a b c d e f", None, None, 0)]
    got = {r[0]: tuple(r)[1:] for r in J.join_components(frame(spark, rows), 4, 85, 100).collect()}
    assert got == {None: (3, None), 1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (3, 6)}
    assert J.join_components(empty(spark)).count() == 0


def test_keep_one(spark):
    rows = corpus(60)
    docs = frame(spark, rows)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted({c for _, _, c in brute(rows, 5, 80, 100)})
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    assert kept.where("doc_id is null").count() == 1


def test_linking_sets_share_a_key():
    """Any pair that links meets under a key and passes the sketch test."""
    rnd = np.random.default_rng(1)
    for small in (4, 10, 16):
        for _ in range(400):
            n = int(rnd.integers(1, 60))
            x = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
            drop, more = int(rnd.integers(0, 4)), int(rnd.integers(0, 4))
            y = np.unique(np.concatenate([x[drop:], rnd.integers(0, 1 << 63, more).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if both and 100 * both >= 85 * (len(x) + len(y) - both):
                assert np.intersect1d(J.set_keys(x, small, 85, 100), J.set_keys(y, small, 85, 100)).size
                a, b = ((len(s), 8 * len(J.sketch(s)), int.from_bytes(J.sketch(s), "little")) for s in (x, y))
                assert J.may_link(a, b, 85, 100)


def test_sketch_tells_half_alike_sets_apart():
    """Sets with seven tenths in common would chain loose groups together if their sketches left a link open."""
    rng, left = np.random.default_rng(4), 0
    for _ in range(200):
        h = rng.integers(0, 1 << 63, 151, dtype=np.uint64)
        a, b = ((128, 8 * len(J.sketch(x)), int.from_bytes(J.sketch(x), "little")) for x in (np.sort(h[:128]), np.sort(h[23:])))
        left += J.may_link(a, b, 80, 100)
    assert left < 100


def test_bucket_forest_connects_what_may_link():
    rnd = random.Random(2)
    for n in (2, 10, 60):
        sets = []
        for _ in range(n):
            base = set(range(40)) if rnd.random() < 0.6 else {rnd.randrange(10 ** 6) for _ in range(40)}
            for _ in range(rnd.choice([0, 1, 2, 4])):
                base.discard(rnd.randrange(40))
            h = np.sort(J.mix(np.array(sorted(base), dtype=np.uint64)))
            s = J.sketch(h)
            sets.append((len(h), 8 * len(s), int.from_bytes(s, "little")))
        root = list(range(n))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in J.bucket_forest(list(range(n)), sets, 85, 100):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
        for i in range(n):
            for j in range(i):
                if J.may_link(sets[i], sets[j], 85, 100):
                    assert find(i) == find(j)
