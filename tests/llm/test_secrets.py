import hashlib
import random
import re

from medistar.llm import queries, secrets as S

from .helpers import corpus, empty, frame

ASSIGN = re.compile(r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
                    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def plain(text):
    """The base spans by the plain rule: match, then drop what is too short."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{S.BASE[k]}:{s}:{e}" for s, k, e in sorted(out))


def random_text(rnd):
    bits = ["password", "PassWd=", "token", "secret:", "api_key = \"", "apiKey'", "=", ":", " ", "\"", "AKIA", "AKIA" + "Z9" * 8, "abc",
            "0123456789abcdef" * 2, "f" * 23, "f" * 24, "ſecret=longvalue", "toKen=abcdef", "user=joe", "joe@example.com",
            "host=db.example.org", "10.0.0.1", "é", "\n", "\n\n", "Zx9+Qw8/Er7=Ty6-Ui5_Op4.As3Df2Gh1"]
    return "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))


def test_base_spans_against_the_plain_rule():
    rnd = random.Random(4)
    for _ in range(4000):
        t = random_text(rnd)
        base, all_spans = S.scan_text(t)
        assert ",".join(f"{k}:{s}:{e}" for k, s, e in base) == plain(t)
        assert [x for x in all_spans if x[0] in S.BASE] == base


def test_weak_parts_need_a_complement():
    assert S.scan_text("mail joe@example.com about it")[1] == []
    assert S.scan_text("see https://example.com/a and 10.0.0.1 and joe@example.com")[1] == []
    kinds = [k for k, _, _ in S.scan_text("user=joe password=hunter22 host=db.example.org")[1]]
    assert kinds == ["identifier", "assign", "endpoint"]
    weak = "pwd: hunter22 for joe@example.com"
    assert [k for k, _, _ in S.scan_text(weak)[1]] == ["weak_secret", "identifier"]
    far = "pwd: hunter22 " + "x " * 200 + "joe@example.com"
    assert S.scan_text(far)[1] == []
    assert S.scan_text("pwd: hunter22\n\njoe@example.com")[1] == []  # another scope
    # dense parts, linear work
    assert len(S.scan_text("joe@example.com pwd=hunter22 " * 3000)[1]) == 6000


def test_link_against_all_pairs():
    rnd = random.Random(8)
    for _ in range(1500):
        t = random_text(rnd)
        base = S.base_spans(t)
        weak = {w for w in S.weak_parts(t, 3.6) if not any(s < w[2] and e > w[1] for _, s, e in base)}
        scope = lambda p: len([m for m in S._BLANK.finditer(t) if m.start() <= p[1]])
        secret = lambda p: p[0] in ("assign", "hex", "weak_secret")
        want = {w for w in weak if any(secret(w) != secret(p) and scope(w) == scope(p) and p[1] <= w[2] + 40 and p[2] >= w[1] - 40
                                       for p in [*base, *weak])}
        assert set(S.link(t, base, weak, 40)) == want


def test_query_columns(spark):
    rows = corpus(12) + [(800, "token=abcdefgh é AKIA" + "A" * 16, None, None, 0), (801, "x" * 200_000 + " secret=abcdef", None, None, 0)]
    docs = frame(spark, rows).selectExpr("*", "1 AS spans", "2 AS n_hex")
    got = S.digest(S.scan(docs)).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [want.count(k + ":") for k in S.BASE]
    assert S.scan(empty(spark)).count() == 0
    assert queries.queries()["op10_secrets"]
