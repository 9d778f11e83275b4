"""Substring dedup by seed and extend, exact for windows of ``window`` words.

Seeds: in every window the least hash of its ``gram``-word runs is the anchor
(winnowing); it depends on the window's words alone, so equal windows carry
equal anchors.  Consecutive windows with one anchor form a stretch.  Documents
are joined on anchors that more than one of them has.

Extension: a stretch whose whole word run, anchor extended both ways to the last
window that holds it, already occurs in an earlier document is covered as one.
Where an anchor is repeated but the extension differs (the ends of a repeat),
the match is extended window by window between the first carriers of each
distinct stretch.  Covered windows of a document are united into its maximal
repeats, and their words are removed.

"Earlier" is a smaller id.  Hot anchors (copies, shared passages) are combined
map-side into one minimum per anchor and stretch; only first carriers take part
in the window step; no pairs of documents are made.

Results by case: null, empty and wordless texts have no words; texts shorter
than a window lose nothing; rows that share an id never remove each other's
words (none is smaller); a row with a null id is left whole and covers nothing;
an empty table gives no rows; other columns are ignored.  Windows are judged on
the input, not on what is left.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filtered_scans, importable, materialize
from .textkit import SpanHash, Words, signed, sliding_min, slices

_SPLIT = 64  # most windows in a stretch


def stretches(w: Words, window: int, gram: int):
    """(first word, windows, anchor, signature) of every stretch of a batch of texts."""
    n = len(w.h)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    one, two = SpanHash(w.h, 0), SpanHash(w.h, 1)
    at = np.arange(n - gram + 1)
    low = sliding_min(one(at, at + gram), window - gram + 1)
    at = np.flatnonzero(w.doc[: n - window + 1] == w.doc[window - 1:])
    if not len(at):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    v = low[at]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    inside = np.arange(len(at)) - first[np.cumsum(new) - 1]
    first = np.flatnonzero(inside % _SPLIT == 0)
    count = np.diff(np.concatenate([first, [len(at)]]))
    start = at[first]
    return start, count, v[first], two(start, start + count + window - 1)


def _crc(col) -> np.ndarray:
    """A check value per text: tells rows that share an id apart."""
    return np.array([zlib.crc32(t.as_py()) if t.is_valid else 0 for t in col.cast(pa.large_binary())],
                    dtype=np.uint32).view(np.int32)


def _seeds(window, gram):
    def run(batches):
        for b in (x for batch in batches for x in slices(batch, 1)):
            w = Words(b.column(1))
            start, count, anchor, sig = stretches(w, window, gram)
            if len(start):
                doc = w.doc[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(sig)), b.column(0).take(pa.array(doc)),
                     pa.array(_crc(b.column(1))[doc]), pa.array((start - w.first[doc]).astype(np.int32)),
                     pa.array(count.astype(np.int32))], ["a", "sig", "doc", "crc", "pos", "n"])
    return run


def _windows(window):
    """One row per window of the stretches listed for a document: (a, h, doc, crc, pos)."""
    def run(batches):
        for b in (x for batch in batches for x in slices(batch, 1)):
            w = Words(b.column(1))
            hashes, crc = SpanHash(w.h, 2), _crc(b.column(1))
            lists = b.column(2)
            flat, off = lists.flatten(), lists.offsets.to_numpy()
            off = off - off[0]
            doc = np.repeat(np.arange(len(lists)), np.diff(off))
            get = lambda f: flat.field(f).to_numpy(zero_copy_only=False)
            mine = get("crc") == crc[doc]
            doc, pos, n, a = doc[mine], get("pos")[mine], get("n")[mine], get("a")[mine]
            each = np.repeat(np.arange(len(doc)), n)
            at = pos[each] + (np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n))
            word = w.first[doc[each]] + at
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[each]), pa.array(signed(hashes(word, word + window))), b.column(0).take(pa.array(doc[each])),
                 pa.array(crc[doc[each]]), pa.array(at.astype(np.int32))], ["a", "h", "doc", "crc", "pos"])
    return run


def covered_words(n_words: int, spans, crc: int, window: int) -> np.ndarray:
    """Mask of the words under covered (crc, pos, n) stretches."""
    edge = np.zeros(n_words + 1, dtype=np.int32)
    for s in spans or ():
        if s["crc"] == crc:
            edge[s["pos"]] += 1
            edge[s["pos"] + s["n"] + window - 1] -= 1
    return np.cumsum(edge[:-1]) > 0


def _remove(window):
    def run(batches):
        for b in (x for batch in batches for x in slices(batch, 1)):
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(b.column(1).cast(pa.large_binary()), b.column(2)):
                raw = text.as_py() or b""
                words = raw.split()  # bytes split at exactly the six separators
                mask = covered_words(len(words), spans.as_py(), np.uint32(zlib.crc32(raw)).view(np.int32) if text.is_valid else 0,
                                     window) if spans.is_valid else None
                gone = int(mask.sum()) if mask is not None else 0
                n_words.append(len(words))
                n_removed.append(gone)
                kept.append(b" ".join(x for x, m in zip(words, mask) if not m) if gone else b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])
    return run


def dedup(docs: DataFrame, window: int = 50, gram: int = 20, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: the words outside all
    repeats, joined by one space."""
    spark = docs.sparkSession
    importable(spark)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    known = src.where("doc_id is not null")
    seeds = known.mapInArrow(_seeds(window, gram), "a long, sig long, doc long, crc int, pos int, n int")
    repeated = seeds.groupBy("a").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("sig").alias("s0"),
                                      F.max("sig").alias("s1")).where("lo < hi") \
        .select("a", (F.col("s0") < F.col("s1")).alias("differs"))
    met = materialize(spark, seeds.join(repeated, "a"), "substring-seeds")
    first = met.groupBy("a", "sig").agg(F.min("doc").alias("first"))
    met = materialize(spark, met.join(first, ["a", "sig"]), "substring-stretches")
    whole = met.where("doc > first").select("doc", "crc", "pos", "n")
    ends = met.where("doc = first and differs").groupBy("doc").agg(
        F.collect_list(F.struct("crc", "pos", "n", "a")).alias("parts"))
    ends = materialize(spark, ends, "substring-ends")
    # only the texts of first carriers are needed: their scan is filtered before it is shuffled
    wanted = materialize(spark, ends.select("doc", F.lit(1).alias("wanted")), "substring-wanted").where("wanted > 0")
    with filtered_scans(spark):
        texts = materialize(spark, known.join(wanted, known["doc_id"] == wanted["doc"]).select("doc_id", "text"), "substring-texts")
    windows = texts.join(ends, texts["doc_id"] == ends["doc"]).select("doc_id", "text", "parts") \
        .mapInArrow(_windows(window), "a long, h long, doc long, crc int, pos int")
    # a window that a third of all documents carry is one minimum per task, and a join that Spark can split
    windows = materialize(spark, windows, "substring-windows")
    firsts = windows.groupBy("a", "h").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    single = windows.join(firsts, ["a", "h"]).where("doc > first").select("doc", "crc", "pos", F.lit(1).alias("n"))
    spans = whole.unionByName(single).groupBy(F.col("doc").alias("doc")).agg(
        F.collect_list(F.struct("crc", "pos", "n")).alias("spans"))
    out_schema = "doc_id long, n_words long, n_removed long, kept string"
    done = known.join(spans, known["doc_id"] == spans["doc"], "left").select("doc_id", "text", "spans") \
        .mapInArrow(_remove(window), out_schema)
    unknown = src.where("doc_id is null").select(
        "doc_id", "text", F.lit(None).cast("array<struct<crc:int,pos:int,n:int>>").alias("spans")) \
        .mapInArrow(_remove(window), out_schema)
    return done.unionByName(unknown)
