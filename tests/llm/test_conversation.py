import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from medistar.llm import conversation as C
from medistar.llm import queries

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def damaged(rows):
    out = {}
    for c, t, r, x in rows:
        mine = out.setdefault(c, [])
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        mine += [(t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def classes(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, out = set(), []
    for _, r, x in rows:
        core = x.strip(" \t\n\v\f\r")
        out.append("blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((r, x))
    return rows, out


def plain(rows, kinds):
    """The best (cost, audit, repaired) by a plain table over suffixes: value of (row, state) from the end."""
    step = {0: "su", 1: "u", 2: "a", 3: "u"}
    to = {"s": 1, "u": 2, "a": 3}
    full = {"u": "user", "a": "assistant"}
    best = {}
    for i in range(len(rows), -1, -1):
        cand = {q: [] for q in range(4)}
        for q in range(4):
            if i == len(rows):
                if q in (0, 3):
                    cand[q].append((0, "", ()))
                continue
            _, role, text = rows[i]
            more = 3 if kinds[i] == "truncated" else 0
            later = lambda q2, c, e, out: (best[i + 1, q2][0] + c, e + best[i + 1, q2][1], out + best[i + 1, q2][2])
            cand[q].append(later(q, 4, "D", ()))
            if kinds[i] not in ("blank", "duplicate"):
                if role[:1] and role[0] in step[q]:
                    cand[q].append(later(to[role[0]], more, "K", (f"{role}:{text}",)))
                for x in "ua":
                    if x in step[q]:
                        cand[q].append(later(to[x], 3 + more, "R", (f"{full[x]}:{text}",)))
        inf = (10 ** 9, "", ())
        now = {q: min(cand[q], key=lambda v: v[:2], default=inf) for q in range(4)}
        for _ in range(4):  # insertions
            for q in range(4):
                for x in "ua":
                    if x in step[q]:
                        v = now[to[x]]
                        now[q] = min(now[q], (v[0] + 3, "I" + v[1], (full[x] + ":",) + v[2]), key=lambda v: v[:2])
        best.update({(i, q): v for q, v in now.items()})
    return best[0, 0]


def brute(rows):
    out = []
    for c, mine in damaged(rows).items():
        mine, kinds = classes(mine)
        turns = [t for t, *_ in mine if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        legal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, text = plain(mine, kinds)
        out.append((c, gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], legal, cost, audit,
                    hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(n, seed):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 14)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Fine.", "Fine?", "cut off", "Ends!  \n", "", " \t", None, f"own {t}.", f"own {t}"])
            rows.append((c, None if rnd.random() < .1 else t + 3 * (rnd.random() < .1), role, text))
    rows += [rows[3]] * 3 + [(None, None, None, None), (None, 1, "user", "Hi."), (9000, None, "user", "x" * 100_000)]
    rows += [(8000, t, "user" if t % 2 else "assistant", f"{rnd.randint(0, 400)}.") for t in range(1500)]
    return rows


@pytest.mark.parametrize("block", [512, 3, 1])
def test_against_a_plain_table(spark, monkeypatch, block):
    rows = conversations(150, block)
    df = spark.createDataFrame(rows, ROWS).repartition(3).selectExpr("*", "1 AS copies", "2 AS first", "3 AS kind", "4 AS print")
    d, copies = C.damage(df)
    got = C.repair(d, copies, block)
    want = brute(rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    if block == 512:
        monkeypatch.setattr(queries, "read_table", lambda *a: df)
        assert sorted((tuple(r) for r in queries.op13_conversation(spark, "").collect()), key=str) == want
        texts = {}
        for r in C.repaired(d, got, copies).orderBy("conv_id", "seq").collect():
            texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert all(hashlib.sha256("\n".join(texts.get(r[0], [])).encode()).hexdigest() == r[-1] for r in want)


def test_every_short_conversation():
    """All sequences of up to four rows against all audits tried out."""
    def tries(rows, kinds):
        best = None
        for n in range(len(rows) + 4):
            for audit in itertools.product("DIKR", repeat=n):
                if sum(e != "I" for e in audit) != len(rows):
                    continue
                state, i, cost = 0, 0, 0
                for e in audit:
                    if e == "I":
                        cost, state = cost + 3, C._NEXT[state][1]
                        continue
                    r, k = rows[i], kinds[i]
                    i += 1
                    if e != "D" and k == C.VOID or e == "K" and (r, state) not in C._KEEP:
                        break
                    cost += {"K": 0, "R": 3, "D": 4}[e] + (3 if e != "D" and k == C.TRUNCATED else 0)
                    state = C._KEEP[r, state] if e == "K" else C._NEXT[state][1] if e == "R" else state
                else:
                    if state in C._GOAL:
                        v = (cost, "".join(audit))
                        best = v if best is None or v < best else best
        return best
    for n in range(4):
        for rows in itertools.product("sua?", repeat=n):
            for kinds in itertools.product("012", repeat=n) if n < 3 else ["000", "010", "200", "102"]:
                (q, cost, _, edits), = C.lightest(((0, 0, ""),), "".join(a + b for a, b in zip(rows, kinds)), True)
                assert (cost, edits) == tries(rows, kinds)


def test_standins_keep_order():
    rnd = random.Random(2)
    for _ in range(2000):
        audits = list({"".join(rnd.choice("DK") for _ in range(rnd.randint(0, 9))) for _ in range(4)})
        short = C.standins(audits)
        for (a, x), (b, y) in itertools.combinations(zip(audits, short), 2):
            for tail in ("", "D", "R", "ID"):
                for tail2 in ("", "K", "DD"):
                    assert (a + tail < b + tail2) == (x + tail < y + tail2)


def test_empty(spark):
    assert C.repair(spark.createDataFrame([], ROWS)).count() == 0
