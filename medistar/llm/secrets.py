"""Secret scan with multipart credential linking.

Strong patterns (assignments, access identifiers, long hex runs) are reported
wherever they match.  Weak parts (user names and mail addresses; bare
high-entropy tokens and loosely named values; hosts, addresses and URLs) are
only candidates: an interval join inside each scope (the text between blank
lines) keeps a weak part if a complementary part is at most ``reach`` characters
away (None: anywhere in the scope), and one side of the link is a secret.  The join is a sweep over the sorted
parts of one document, so it is linear in them, and documents never meet: no
shuffle, and whatever holds a third of all rows is split like any other rows.

Results by case: null and empty texts have no spans; ties (equal starts) go in
the order of ``KINDS``; repeated rows are scanned once each; an empty table gives
no rows; other columns are ignored.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "weak_secret", "endpoint")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_MAIL = re.compile(r"[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63})+", re.A)
_USER = re.compile(r"""\b(?:user(?:_?name)?|login|account|client_?id|(?:access_?)?key_?id)["']?\x20*[:=]\x20*["']?([\w.@+-]{3,})""", re.I | re.A)
_LOOSE = re.compile(r"""\b(?:pwd|pass|auth|bearer|credential|private_?key|access_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", re.I | re.A)
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{32,}")
_URL = re.compile(r"\b[a-z][a-z0-9+]{1,15}://[^\s\"'<>]+", re.A)
_HOST = re.compile(r"""\b(?:host(?:name)?|server|endpoint|db_?url)["']?\x20*[:=]\x20*["']?([\w.:/-]{3,})""", re.I | re.A)
_ADDRESS = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])", re.A)
_BLANK = re.compile(r"\n[\x20\t\r]*\n")


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The strong spans, by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= MIN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


def weak_parts(text: str, min_entropy: float) -> list[tuple[str, int, int]]:
    out = []
    if "@" in text:
        out += [("identifier", *m.span()) for m in _MAIL.finditer(text)]
    if "=" in text or ":" in text:
        out += [("identifier", *m.span()) for m in _USER.finditer(text)]
        out += [("weak_secret", *m.span()) for m in _LOOSE.finditer(text)]
        out += [("endpoint", *m.span()) for m in _HOST.finditer(text)]
        if "://" in text:
            out += [("endpoint", *m.span()) for m in _URL.finditer(text)]
    out += [("weak_secret", *m.span()) for m in _TOKEN.finditer(text) if entropy(m.group()) >= min_entropy]
    if "." in text:
        out += [("endpoint", *m.span()) for m in _ADDRESS.finditer(text)]
    return out


class _Near:
    """Sorted intervals of one role: is one of them within reach of [start, end)?"""

    def __init__(self, spans):
        self.starts = [s for _, s, _ in spans]
        self.ends, top = [], -1
        for _, _, e in spans:
            top = max(top, e)
            self.ends.append(top)

    def __call__(self, start, end, reach):
        i = bisect_right(self.starts, end + reach)
        return bool(i) and self.ends[i - 1] >= start - reach

    def overlaps(self, start, end):
        i = bisect_left(self.starts, end)
        return bool(i) and self.ends[i - 1] > start


def link(text: str, base, weak, reach: int) -> list[tuple[str, int, int]]:
    """The weak parts that complement another part of their scope."""
    strong = _Near(base)
    weak = sorted({w for w in weak if not strong.overlaps(w[1], w[2])}, key=lambda s: (s[1], _ORDER[s[0]], s[2]))
    if not weak:
        return []
    borders = [m.start() for m in _BLANK.finditer(text)]
    scopes: dict[int, tuple[list, list]] = {}
    for strong, parts in ((True, base), (False, weak)):
        for p in parts:
            scopes.setdefault(bisect_right(borders, p[1]), ([], []))[0 if strong else 1].append(p)
    kept = []
    for strong, parts in scopes.values():
        def role(*kinds, strong=strong, parts=parts):
            return _Near(sorted((p for p in (*strong, *parts) if p[0] in kinds), key=lambda s: s[1]))

        secret, other = role("assign", "hex", "weak_secret"), role("access", "identifier", "endpoint")
        kept += [p for p in parts if (other if p[0] == "weak_secret" else secret)(p[1], p[2], reach)]
    return kept


def scan_text(text: str | None, reach: int | None = 160, min_entropy: float = 3.6):
    """(strong spans, all spans) of one text, both by start, then kind."""
    if not text:
        return [], []
    base = base_spans(text)
    weak = link(text, base, weak_parts(text, min_entropy), len(text) if reach is None else reach)
    return base, sorted(base + weak, key=lambda s: (s[1], _ORDER[s[0]], s[2]))


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int | None = 160,
         min_entropy: float = 3.6) -> DataFrame:
    """(doc_id, spans array<struct(kind, start, end)>) of every document."""
    from pyspark.sql.pandas.types import to_arrow_schema

    importable(docs.sparkSession)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType),
                           T.StructField("spans", T.ArrayType(_SPAN))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan_text(t.as_py(), reach, min_entropy)[1]]
                     for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, arrow.field("spans").type)], schema=arrow)

    return src.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and joined spans of ``scan``'s rows."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
