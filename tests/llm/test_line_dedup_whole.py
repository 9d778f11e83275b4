"""The line dedup as op7 and the pipeline call it: what recurs is dropped, whatever its length or template."""

import random
from collections import defaultdict

import corpus_pipeline
from medistar.llm import queries

from .helpers import frame


def op7(spark, rows, scratch):
    frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: r for r in queries.op7_line_dedup(spark, scratch).collect()}
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    staged = {r.doc_id: r for r in corpus_pipeline.drop_recurring_lines(spark, docs, scratch).collect()}
    assert {k: r.text for k, r in got.items()} == {k: r.text for k, r in staged.items()}
    assert all(r.n_chars == len(r.text) for r in staged.values() if got[r.doc_id].n_dropped)
    return {k: r.text for k, r in got.items()}


def first_only(rows):
    """Exact lines: all but the document with the smallest id lose a line of two or more documents."""
    docs = defaultdict(set)
    for key, text, *_ in rows:
        for line in text.split("\n"):
            docs[line].add(key)
    return {key: "\n".join(x for x in text.split("\n") if not x.strip() or min(docs[x]) == key) for key, text, *_ in rows}


def doc(key, lines):
    text = "\n".join(lines)
    return key, text, None, None, len(text)


def test_two_documents_recur(spark, scratch):
    rnd = random.Random(11)
    # first words differ, so that no two lines share a leaf
    lines = [" ".join([f"w{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}", *(rnd.choice("klmnop") * 3 for _ in range(rnd.randint(4, 12)))])
             for i in range(80)]
    rows = [doc(k, [*rnd.sample(lines, rnd.randint(0, 6)), "", f"only here in document {chr(97 + k)} and nowhere else"]) for k in range(25)]
    counts = [sum(x in r[1].split("\n") for r in rows) for x in lines]
    assert 2 in counts and max(counts) > 2 and 1 in counts
    rows = [r[:1] + (r[1].replace("only here in", f"{chr(97 + r[0])} stands in"), *r[2:]) for r in rows]
    rows = [doc(r[0], r[1].split("\n")) for r in rows]
    assert op7(spark, rows, scratch) == first_only(rows)


def test_template_of_two_documents(spark, scratch):
    rows = [doc(1, ["user 17 logged in from host 9 at noon", "once alone in one place"]), doc(2, ["user 18 logged in from host 3 at noon", "b"])]
    assert op7(spark, rows, scratch) == {1: rows[0][1], 2: "b"}


def test_short_lines_recur(spark, scratch):
    rows = [doc(1, ["Les.", "And ornd.", "", "Of, edti oner.", "12", "Page 3 of", "7 8", "a b c d"]),
            doc(2, ["Les.", "   ", "And ornd.", "", "13", " Page  4 of", "7 9", "a b c"]),
            doc(3, ["Of, edti oner.", "", "Les.", "Les", "12", "a b", "only me"])]
    assert op7(spark, rows, scratch) == {1: rows[0][1], 2: "   \n\n13\n7 9\na b c", 3: "\nLes\na b\nonly me"}


def test_short_lines_against_exact_lines(spark, scratch):
    rnd = random.Random(12)
    rows = [doc(k, [" ".join(rnd.choice("abcdef") for _ in range(rnd.randint(0, 3))) for _ in range(rnd.randint(1, 12))]) for k in range(30)]
    assert op7(spark, rows, scratch) == first_only(rows)


def test_several_templates_of_a_leaf(spark, scratch):
    names = ["ann", "bob", "cat", "dan", "eve", "fay", "gus", "hal"]
    forms = ["the order of {} was sent by train to the north today",
             "the order of {} came back with broken glass and some letters",
             "the order of {} waits until all open bills are paid now"]
    rows = [doc(i * 10 + k, [f.format(n), f"{n} {'xyz'[k]} stays"]) for i, n in enumerate(names) for k, f in enumerate(forms)]
    rows.append(doc(900, ["the order of zoe has nothing in common but its first words"]))  # another length
    rows.append(doc(901, ["the order of zoe fell off its cart near seven old mills"]))  # the same leaf, no template
    want = {r[0]: r[1] if r[0] < 3 or r[0] >= 900 else r[1].split("\n")[1] for r in rows}
    assert op7(spark, rows, scratch) == want
