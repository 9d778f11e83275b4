import pytest

from medistar.llm import substring_dedup

from .helpers import corpus, empty, frame


def brute(rows, window):
    """Every word under a window that also starts in a document with a smaller id."""
    first, out = {}, []
    for key, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (text or "").encode().split()
        mask = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first.setdefault(tuple(w[i:i + window]), key) < key:
                mask[i:i + window] = [True] * window
        out.append((key, len(w), sum(mask), b" ".join(x for x, m in zip(w, mask) if not m).decode()))
    return out


@pytest.mark.parametrize("window,gram", [(50, 20), (12, 5), (8, 8)])
def test_against_brute_force(spark, window, gram):
    rows = corpus(90, seed=window)
    # runs of one word, and a passage that overlaps itself
    rows += [(700, "ha " * 300, None, None, 0), (701, "x y " * 90, None, None, 0), (702, "ha " * 120 + "end", None, None, 0)]
    docs = frame(spark, rows).selectExpr("*", "1 AS pos", "2 AS crc", "3 AS spans")
    got = sorted(tuple(r) for r in substring_dedup.dedup(docs, window, gram).where("doc_id is not null").collect())
    assert got == sorted(brute(rows, window))


def test_null_id_and_empty(spark):
    got = substring_dedup.dedup(frame(spark, corpus())).where("doc_id is null").collect()
    assert len(got) == 1 and got[0].n_removed == 0 and got[0].n_words == 90
    assert substring_dedup.dedup(empty(spark)).count() == 0


def test_same_id_with_other_text(spark):
    a = " ".join(f"a{i}" for i in range(80))
    b = " ".join(f"b{i}" for i in range(80))
    rows = [(1, a, None, None, 0), (2, "z " + a, None, None, 0), (2, b, None, None, 0), (3, b, None, None, 0)]
    got = sorted(tuple(r)[:3] for r in substring_dedup.dedup(frame(spark, rows)).collect())
    assert got == [(1, 80, 0), (2, 80, 0), (2, 81, 80), (3, 80, 80)]
