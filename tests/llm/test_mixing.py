from collections import defaultdict

from medistar.llm import mixing

from .helpers import corpus, empty, frame


def brute_targets(size, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """Share by weight, stop at the caps, share the excess again until none is above."""
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(size.values())
    while free:
        unit = left / sum(w[s] for s in free)
        over = [s for s in free if unit * w[s] > most * size[s]]
        if not over:
            target.update({s: unit * w[s] for s in free})
            break
        for s in over:
            target[s] = most * size[s]
            left -= target[s]
            free.remove(s)
    return target


def words(t):
    return len((t or "").encode().split())


def test_targets_and_taken(spark):
    rows = corpus(400)
    got = mixing.plan(frame(spark, rows).selectExpr("*", "1 AS size", "2 AS target")).collect()
    assert len(got) == len(rows)
    size, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        size[r[3]] += words(r[1])
    want = brute_targets(size)
    by_id = {r[0]: words(r[1]) for r in rows}
    for r in got:
        assert r["size"] == by_id[r.doc_id] and r.source_size == size[r.source]
        assert abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 1.0


def test_reruns_agree_for_any_partitioning(spark):
    rows = corpus(120)
    key = lambda r: (str(r.doc_id), r._mx_hash, r._mx_ord)
    a = sorted(mixing.plan(frame(spark, rows, 2)).collect(), key=key)
    b = sorted(mixing.plan(frame(spark, rows, 7)).collect(), key=key)
    assert a == b


def test_expectation_is_kept(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 2}", 0) for i in range(60)]
    total = defaultdict(float)
    seeds = 12
    for seed in range(seeds):
        for r in mixing.plan(frame(spark, rows, 1), seed=seed, weights=(1, 1)).collect():
            total[r.doc_id] += r.taken / r["size"] / seeds
    assert abs(sum(total.values()) / 60 - 1.5) < 0.02
    assert all(1.0 <= x <= 2.0 for x in total.values()) and len({round(x, 2) for x in total.values()}) > 3


def test_mix_repeats_rows(spark):
    rows = corpus(80)
    docs = frame(spark, rows)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    plan = mixing.plan(docs).collect()
    assert out.count() == sum(r.copies + (r.part_words > 0) for r in plan)
    assert sum(words(r.text) for r in out.collect()) == sum(r.taken for r in plan)


def test_empty(spark):
    assert mixing.plan(empty(spark)).count() == 0
    assert mixing.mix(empty(spark)).count() == 0
    only_empty = frame(spark, [(1, None, None, None, 0), (2, "", None, "a", 0)])
    assert [r.taken for r in mixing.plan(only_empty).collect()] == [0, 0]


def test_clashing_columns(spark):
    docs = frame(spark, corpus(40)).selectExpr("*", "1 AS copies", "2 AS part_words", "3 AS target")
    got = mixing.mix(docs)
    assert got.columns == docs.columns and got.where("copies = 1 and part_words = 2").count() == got.count() > 0
