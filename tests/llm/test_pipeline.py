import contextlib
import random

import corpus_pipeline as P
from medistar.llm import toxicity
from medistar.llm.common import read_table

from .helpers import frame

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = read_table(spark, SF, "documents")
    columns, n = docs.columns, docs.count()
    assert [name for name, _ in P.STAGES] == ["toxicity", "line dedup", "n-gram join", "mixing", "packing"]
    model = toxicity.learn(docs, read_table(spark, SF, "labels"))
    bad = {r.doc_id for r in toxicity.apply(docs, model).where("predicted = 1").collect()}
    seen = []
    for name, stage in P.STAGES[:-1]:
        docs = P.materialize(spark, stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        seen.append(docs)
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in seen]
    assert set(ids[0]) == set(range(n)) - bad and set(ids[1]) <= set(ids[0])
    assert seen[1].where(~seen[1].text.rlike(r"[^\x20\x09-\x0D]")).count() == 0
    assert len(set(ids[2])) == len(ids[2]) and set(ids[2]) <= set(ids[1])
    assert set(ids[3]) <= set(ids[2]) and max(ids[3].count(i) for i in set(ids[3])) <= 3
    pieces = P.STAGES[-1][1](spark, docs, SF)
    assert pieces.agg({"length": "sum"}).first()[0] == pieces.where("start = 0").agg({"doc_tokens": "sum"}).first()[0]
    assert P.run(spark, SF).count() == pieces.count()


def shingles(text):
    w = text.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})).encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_copies_are_gone_after_line_dedup(spark, tmp_path):
    """Planted copies (exact, and with edited words) leave one document each, held against all pairs of the
    whole texts; documents of another origin are judged by their own text."""
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(900)]
    text = lambda n: "\n".join(" ".join(rnd.choice(words) for _ in range(12)) for _ in range(n))
    texts = [text(9) for _ in range(30)]
    for i in range(12):
        t = texts[i].split(" ")
        if i % 3:
            t[rnd.randrange(len(t))] = f"edit{i}"
        texts.append(" ".join(t))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(90, " \n ", "en", "s0", 3), (91, None, "en", "s0", None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = read_table(spark, str(tmp_path), "documents")
    cut = P.materialize(spark, P.drop_recurring_lines(spark, docs, ""), "test-cut")
    left = {r.doc_id for r in cut.collect()}
    assert 90 not in left and 91 not in left and len(left) > 30  # edited copies survive as remnants
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    alike = {j for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    got = {r.doc_id for r in P.drop_near_copies(spark, cut, str(tmp_path)).collect()}
    assert got == left - alike == set(range(30))
    # the ids of rows that do not stem from documents tell nothing about their texts
    other = frame(spark, [(i, f"{text(3)}", "en", "s", 1) for i in range(42)])
    assert P.drop_near_copies(spark, other, str(tmp_path)).count() == 42


def test_texts_of_the_second_join_are_shuffled_once(spark, tmp_path, monkeypatch):
    """The second join reads written texts, each by its id and hash: rows that lost lines as documents has them,
    unchanged ones, and those of other origin their own."""
    frame(spark, [(1, "a b\nc d", "en", "s", 7), (2, "x y", "en", "s", 3), (4, "p q", "en", "s", 3)]).write.parquet(f"{tmp_path}/documents.parquet")
    docs = frame(spark, [(1, "a b", "en", "s", 3), (2, "x y", "en", "s", 3), (3, "new", "en", "s", 3), (4, "other", "en", "s", 5), (None, "none", "en", "s", 4)])
    seen, join = [], P.ngram_join.join_components
    monkeypatch.setattr(P.ngram_join, "join_components", lambda t, **kw: (seen.append(t), join(t, **kw))[1])
    with P.scratch(spark):
        monkeypatch.setattr(P, "scratch", lambda s: contextlib.nullcontext())  # keep the texts for the test
        assert P.drop_near_copies(spark, docs, str(tmp_path)).count() == 5
        assert {tuple(r) for r in seen[1].collect() if r.doc_id is not None} == {(1, "a b\nc d"), (2, "x y"), (3, "new"), (4, "other")}
        assert "Join" not in seen[1]._jdf.queryExecution().executedPlan().toString()


def test_empty_documents(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_registered():
    import __spark_entry__ as E

    names = [n for n in E.queries() if n.startswith("op") and n[2:3].isdigit()]
    assert sorted({int(n[2:].split("_")[0]) for n in names}) == list(range(1, 14)) and len(names) == 13
    assert "pipeline" in E.queries()


def test_scratch_deletes_what_is_not_kept(spark):
    from medistar.llm.common import materialize, scratch
    from medistar.session import fs_exists
    rows = spark.range(3)
    with scratch(spark):
        gone = materialize(spark, rows, "scratch-gone")
        kept = materialize(spark, gone, "scratch-kept", keep=True)
        gone_at = inner_path(gone)
        with scratch(spark):
            inner = materialize(spark, rows, "scratch-inner")
            at = inner_path(inner)
            assert fs_exists(spark, at)
        assert not fs_exists(spark, at) and gone.count() == 3
    assert not fs_exists(spark, gone_at)
    assert kept.count() == 3
    after = materialize(spark, rows, "scratch-after")
    assert fs_exists(spark, inner_path(after))


def inner_path(table):
    return table.inputFiles()[0].rsplit("/", 1)[0]
