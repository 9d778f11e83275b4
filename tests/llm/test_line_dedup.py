import re
from collections import Counter, defaultdict

from medistar.llm import line_dedup as L

from .helpers import corpus, empty, frame

LEADING, SEGMENTS, SIMILAR, MIN_DOCS, MIN_TOKENS = 3, 8, 0.6, 3, 4


def tokens(line):
    return [("<*>" if re.search("[0-9]", t) else t) for t in re.split(r"[\x20\x09-\x0D]+", line.strip(" \t\n\x0b\x0c\r"))]


def runs(t):
    rest, n = t[LEADING:], min(len(t) - LEADING, SEGMENTS)
    cut = lambda j: j * len(rest) // n
    return [tuple(rest[cut(j):cut(j + 1)]) for j in range(n)]


def brute(rows):
    """doc -> kept lines, by dictionaries of whole tokens (ties are avoided by the fixture)."""
    docs = defaultdict(set)
    for key, text, *_ in rows:
        for line in (text or "").split("\n"):
            t = tokens(line)
            if len(t) >= MIN_TOKENS and text is not None:
                docs[tuple(t)].add(key)
    leaves = defaultdict(list)
    for t in docs:
        leaves[len(t), t[:LEADING]].append(t)
    template = {}
    for leaf, lines in leaves.items():
        votes = [Counter() for _ in range(min(leaf[0] - LEADING, SEGMENTS))]
        for t in lines:
            for c, s in zip(votes, runs(t)):
                c[s] += len(docs[t])
        major = [c.most_common(1)[0][0] for c in votes]
        for t in lines:
            same = sum(a == b for a, b in zip(runs(t), major))
            template[t] = ("leaf", leaf) if len(lines) > 1 and same >= SIMILAR * len(major) else ("line", t)
    members = defaultdict(set)
    for t, x in template.items():
        members[x] |= docs[t]
    keep = {x: min(d, key=lambda k: (k is None, k or 0)) for x, d in members.items() if len(d) >= MIN_DOCS}
    out = []
    for key, text, *_ in rows:
        lines = None if text is None else [line for line in text.split("\n") if not (
            len(tokens(line)) >= MIN_TOKENS and template[tuple(tokens(line))] in keep
            and keep[template[tuple(tokens(line))]] != key)]
        out.append((str(key), None if lines is None else "\n".join(lines)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rows = corpus(50)
    rows += [(300 + i, f"free line number {i} alpha\nuser {i} logged in from host {i}.example.org at noon\nlast words of {i}",
              None, None, 0) for i in range(9)]
    rows += [(400 + i, f"the job has finished with state {w} after all steps were done\nonly here {w} x y z", None, None, 0)
             for i, w in enumerate(["good", "bad", "good", "late", "good"])]
    rows += [(500, "a b c d", None, None, 0), (501, "a b c d\n\n a  b\tc d ", None, None, 0), (502, "a b c d", None, None, 0),
             (503, "x " * 50_000, None, None, 0)]
    docs = frame(spark, rows).selectExpr("*", "1 AS pos", "2 AS leaf", "3 AS keeper")
    got = L.dedup(docs)
    assert got.columns == [*docs.columns, "_ld_lines", "_ld_dropped"]
    assert sorted(((str(r.doc_id), r.text) for r in got.collect()), key=str) == brute(rows)
    text = {r.doc_id: r.text for r in got.collect()}
    assert "logged in" in text[300] and "logged in" not in text[305] and "last words" in text[300]
    assert "last words" not in text[305]  # "last words of *" stands in nine documents
    assert "finished" in text[400] and "finished" not in text[401] and "only here bad" in text[401]


def test_two_documents_are_not_enough_and_empty(spark):
    rows = [(1, "one two three four five", None, None, 0), (2, "one two three four five", None, None, 0), (3, None, None, None, 0)]
    got = {r.doc_id: (r.text, r._ld_dropped) for r in L.dedup(frame(spark, rows)).collect()}
    assert got == {1: (rows[0][1], 0), 2: (rows[1][1], 0), 3: (None, 0)}
    assert L.dedup(empty(spark)).count() == 0
