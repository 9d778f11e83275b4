import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from medistar.llm import merkle, queries

from .helpers import corpus, empty, frame


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[enc(v) for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """Root of a list of nodes and the siblings (side, digest) of each, bottom up."""
    at, proofs = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, a in enumerate(at):
            if a ^ 1 < len(nodes):
                proofs[i].append((a ^ 1 < a, nodes[a ^ 1]))
            else:
                proofs[i].append(None)
            at[i] = a >> 1
        nodes = [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    parts = []
    for g in names:
        mine = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        parts.append((mine, *tree([leaf(*r) for r in mine])))
    root, last = tree([p[1] for p in parts])
    out = []
    for (mine, sub, proofs), end in zip(parts, last):
        for r, p in zip(mine, proofs):
            path = p + end
            node = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                node = leaf(*r[:4], r[4] + 1)
            for s in path:
                node = h(node) if s is None else h(s[1], node) if s[0] else h(node, s[1])
            out.append((r[0], leaf(*r), sub, root, h(*[s[1] for s in path if s]), node, node == root))
    return sorted(out, key=str)


def got(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "read_table", lambda *a: docs)
    return sorted((tuple(r) for r in queries.op11_merkle(spark, "").collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    rows = [(r[0], r[1], ["en", None, "", "é", "z"][i % 7 % 5], r[3], None if i % 11 == 0 else r[4])
            for i, r in enumerate(corpus(90))]
    rows += [(i, "x", "far", None, 1) for i in (-(1 << 63), -70_000, -1, 0, 65_535, 65_536, 1 << 40, (1 << 63) - 1)]
    rows += [(5, f"same id {i % 40}", "en", "s", i % 40) for i in range(90)] + [(None, f"no id {i}", "en", None, i) for i in range(9)]
    rows += [(7, "hot", "hot", "s", 3)] * 40
    docs = frame(spark, rows).selectExpr("*", "1 AS grp", "2 AS id", "3 AS slot", "4 AS other", "5 AS path")
    assert got(spark, docs, monkeypatch) == brute(rows)


def test_more_than_one_block(spark, monkeypatch):
    rows = [(i * 37, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(3500)]
    rows += [(8, "again", "en", "s", 2)] * 1500  # a run of equal rows over block borders
    assert got(spark, frame(spark, rows), monkeypatch) == brute(rows)


def test_empty_one_and_text_ids(spark, monkeypatch):
    assert got(spark, empty(spark), monkeypatch) == []
    one = [(4, None, None, None, None)]
    assert got(spark, frame(spark, one), monkeypatch) == brute(one)
    with pytest.raises(TypeError):
        merkle.manifest(empty(spark).withColumn("doc_id", F.lit("a")))
