"""Suffix-array dedup of byte strings, exact for strings of ``length`` bytes.

A sparse suffix array: of each ``length``-byte string, the suffix that starts at
its anchor is taken, the least hash of its ``gram``-byte runs, leftmost first.
The anchor depends on the string's bytes alone, so equal strings meet at equal
anchors.  Consecutive strings with one anchor form a context: the suffix from
the anchor rightward and the bytes to its left, as far as those strings reach.

1. Anchors of one occurrence carry no repeat and go.  Contexts that recur whole
   are settled by their count; one of them goes on.
2. Suffixes of the different contexts left are range-partitioned by their
   leading tokens (bytes) at sampled splitters.  A splitter is a whole suffix
   with its left bytes, so that a hot prefix is cut as often as it needs.
3. Every bucket sorts its suffixes by multikey quicksort, eight bytes a
   character, all open segments at once, and the reversed left bytes likewise.
   The common prefixes of neighbours then tell, for each offset j, which strings
   (j bytes left, the rest right) are equal: same run on both sides.
4. Runs that reach a splitter may go on in another bucket: each bucket sends one
   row per such string, and equal rows of different buckets meet by key.

Tokens are bytes here, as matches are bytes of UTF-8 and may begin inside a
character.  The sample of splitters (``per_bucket`` contexts a bucket, of least
hash) moves borders only, never a result.

Results by case: null and empty texts have no bytes; texts shorter than
``length`` lose nothing; a string that recurs in its own text counts, overlaps
included, as does a repeated row; rows with a null id take part like others; an
empty table gives no rows; other columns are ignored.  Strings are judged on the
input, and matches never cross rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filtered_scans, importable, materialize
from .textkit import SpanHash, mix, signed, sliding_min

_CHUNK = 2 << 20  # bytes hashed at once: the position fits 24 bits, working memory follows this
_LOW24 = np.uint64(0xFFFFFF)


def pieces(texts, length: int):
    """Runs of texts of at most _CHUNK bytes, as lists of (row, offset, bytes); a
    longer text is cut into overlapping pieces, each window in exactly one."""
    run, size = [], 0
    for row, t in enumerate(texts):
        if t is None or len(t) < length:
            continue
        for off in range(0, len(t) - length + 1, _CHUNK):
            part = t[off:off + _CHUNK + length - 1] if len(t) > _CHUNK else t
            if size and size + len(part) > _CHUNK:
                yield run
                run, size = [], 0
            run.append((row, off, part))
            size += len(part)
            if len(t) <= _CHUNK:
                break
    if run:
        yield run


def contexts(run, length: int, gram: int):
    """(piece, first string, strings, anchor's distance from the first, anchor hash, context hash,
    occurrences in the piece) of the contexts of a run of pieces, one row per different context of a piece;
    then, for every context, the index of its row."""
    raw = np.frombuffer(b"".join(p[2] for p in run), dtype=np.uint8)
    end = np.cumsum([len(p[2]) for p in run])
    begin = end - [len(p[2]) for p in run]
    spans = SpanHash(raw.astype(np.uint64), 0)
    at = np.arange(len(raw) - gram + 1)
    g = spans(at, at + gram)
    low = sliding_min((g & ~_LOW24) | at.astype(np.uint64), length - gram + 1)
    at = np.arange(len(low))
    piece = np.searchsorted(end, at, side="right")
    inside = at + length <= end[piece]
    at, piece = at[inside], piece[inside]
    anchor = (low[at] & _LOW24).astype(np.int64)
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])
    head = np.flatnonzero(new)
    n = np.diff(np.concatenate([head, [len(at)]]))
    first, anchor, piece = at[head], anchor[head], piece[head]
    reach = anchor - first
    with np.errstate(over="ignore"):
        whole = mix(SpanHash(raw.astype(np.uint64), 3)(first, first + n + length - 1) + reach.astype(np.uint64), 5)
        own = mix(whole ^ mix(g[anchor], 1) ^ mix(piece.astype(np.uint64), 2), 7)
    _, lead, which, times = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    rows = (piece[lead], (first - begin[piece])[lead], n[lead], reach[lead], g[anchor][lead], whole[lead], times)
    return rows, (piece, first - begin[piece], n, which)


def _texts(col):
    return [t.as_py() if t.is_valid else None for t in col.cast(pa.large_binary())]


def _slices(batch, column, most=4 << 20):
    from .textkit import slices
    return slices(batch, column, most)


_SEED = "a long, cx long, d long, t long, pos int, n int, reach int, times int"


def _seeds(length, gram):
    def go(batches):
        for b in (x for batch in batches for x in _slices(batch, 2)):
            for run in pieces(_texts(b.column(2)), length):
                (piece, pos, n, reach, a, cx, times), _ = contexts(run, length, gram)
                row = pa.array(np.array([p[0] for p in run])[piece])
                off = np.array([p[1] for p in run])[piece]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a)), pa.array(signed(cx)), b.column(0).take(row), b.column(1).take(row)]
                    + [pa.array(x.astype(np.int32)) for x in (pos + off, n, reach, times)],
                    ["a", "cx", "d", "t", "pos", "n", "reach", "times"])
    return go


_CONTEXT = "cx long, d long, t long, pos int, n int, reach int, single boolean, right binary, left binary"


def _cut(length):
    """(d, t, text, list of (pos, n, reach, cx, single)) -> the bytes of each context; equal rows give them once a task."""
    def go(batches):
        seen = set()
        for b in (x for batch in batches for x in _slices(batch, 2)):
            out = []
            for d, t, text, parts in zip(*[b.column(i).to_pylist() for i in (0, 1)], _texts(b.column(2)), b.column(3).to_pylist()):
                if (d, t) in seen:
                    continue
                seen.add((d, t))
                for p in parts:
                    at = p["pos"] + p["reach"]
                    out.append((p["cx"], d, t, p["pos"], p["n"], p["reach"], p["single"],
                                text[at:p["pos"] + p["n"] + length - 1], text[p["pos"]:at][::-1]))
                if len(out) > 20_000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)
    return go


_CONTEXT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
_CONTEXT_NAMES = ["cx", "d", "t", "pos", "n", "reach", "single", "right", "left"]


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*rows), _CONTEXT_TYPES)], _CONTEXT_NAMES)


def _deal(splitters, width):
    """Add the bucket of each context: the number of splitters not above its suffix."""
    def go(batches):
        s = np.array(splitters, dtype=f"S{width}")
        for b in batches:
            keys = np.array(_keys(b.column(7).to_pylist(), b.column(8).to_pylist(), width), dtype=f"S{width}")
            bucket = np.searchsorted(s, keys, side="right") if len(s) else np.zeros(len(keys))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket.astype(np.int32))], [*_CONTEXT_NAMES, "bucket"])
    return go


def _keys(right, left, width):
    """One comparable byte string per context: the suffix, padded, then the reversed left bytes."""
    return [r.ljust(width // 2, b"\0") + x for r, x in zip(right, left)]


def multikey_sort(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix (columns a multiple of 8) and, for each row in that
    order, the length of its common prefix with the row before it (0 for the first).

    Multikey quicksort, breadth first: the rows of every open segment are split by their next
    eight-byte character; rows alone in a segment are done and never looked at again."""
    n, width = rows.shape
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order, head, lcp = np.arange(n), np.zeros(n + 1, dtype=bool), np.full(n, width)
    head[0] = head[n] = True
    lcp[:1] = 0
    for c in range(width // 8):
        at = np.flatnonzero(~(head[:-1] & head[1:]))
        if not len(at):
            break
        seg = np.cumsum(head[:-1])[at]
        key = words[order[at], c]
        perm = np.lexsort((key, seg))
        order[at], key = order[at][perm], key[perm]
        split = at[1:][(seg[1:] == seg[:-1]) & (key[1:] != key[:-1])]
        head[split] = True
        a, b = order[split - 1], order[split]
        lcp[split] = 8 * c + np.argmax(rows[a, 8 * c:8 * c + 8] != rows[b, 8 * c:8 * c + 8], axis=1) if len(split) else 0
    return order, lcp


def _matrix(parts, width):
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(len(parts), width)


_FOUND = "d long, t long, pos int, n int, h binary"


def _bucket(splitters, length, gram):
    """Equal strings among the contexts of one bucket: (d, t, first string, strings, null), and for strings
    that may go on in another bucket (d, t, pos, 1, digest), d null where the bucket has settled it."""
    width = -(-length // 8) * 8

    def go(key, table):
        bucket = key[0].as_py()
        table = table.sort_by([(c, "ascending") for c in ("d", "t", "pos")])
        d, t, pos, n, reach = [table[c].to_numpy() for c in ("d", "t", "pos", "n", "reach")]
        keep = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (pos[1:] != pos[:-1])])
        table = table.filter(pa.array(keep))
        d, t, pos, n, reach = [x[keep] for x in (d, t, pos, n, reach)]
        single = table["single"].to_numpy(zero_copy_only=False)
        rights, lefts = table["right"].to_pylist(), table["left"].to_pylist()
        right, left = _matrix(rights, width), _matrix(lefts, width)
        order_r, lcp_r = multikey_sort(right)
        order_l, lcp_l = multikey_sort(left)
        near = np.zeros(len(d), dtype=np.int64)  # common prefix with the nearest splitter
        for s in splitters[max(bucket - 1, 0):bucket + 1] if bucket else splitters[:1]:
            differs = right != _matrix([s[:width]], width)
            near = np.maximum(near, np.where(differs.any(axis=1), differs.argmax(axis=1), width))
        hits_e, hits_j, sent = [], [], []
        run_r, run_l = np.empty(len(d), dtype=np.int64), np.empty(len(d), dtype=np.int64)
        for j in range(length - gram + 1):
            has = np.flatnonzero((reach >= j) & (reach - n < j))  # strings that start j bytes left of the anchor
            if not len(has):
                continue
            run_r[order_r] = np.cumsum(lcp_r < length - j)
            run_l[order_l] = np.cumsum(lcp_l < j)
            _, lead, which, times = np.unique(run_r[has] * (len(d) + 1) + run_l[has], return_index=True,
                                              return_inverse=True, return_counts=True)
            hit = has[(times[which] > 1) & single[has]]
            hits_e.append(hit)
            hits_j.append(np.full(len(hit), j))
            for i in np.flatnonzero(near[has[lead]] >= length - j):
                e = has[lead[i]]
                h = hashlib.blake2b(lefts[e][:j][::-1] + rights[e][:length - j], digest_size=16).digest()
                ask = times[i] == 1 and single[e]
                sent.append((int(d[e]) if ask else None, int(t[e]) if ask else None, int(pos[e] + reach[e] - j), 1, h))
        e = np.concatenate([np.zeros(0, np.int64), *hits_e])
        p = pos[e] + reach[e] - np.concatenate([np.zeros(0, np.int64), *hits_j])
        by = np.lexsort((p, e))
        e, p = e[by], p[by]
        new = np.concatenate([[True], (e[1:] != e[:-1]) | (p[1:] != p[:-1] + 1)])[:len(e)]
        first = np.flatnonzero(new)
        found = pa.table({"d": d[e[first]], "t": t[e[first]], "pos": p[first].astype(np.int32),
                          "n": np.diff(np.concatenate([first, [len(e)]])).astype(np.int32),
                          "h": pa.nulls(len(first), pa.binary())})
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        if not sent:
            return found
        return pa.concat_tables([found, pa.table({k: pa.array(c, ty) for k, c, ty in zip(
            ("d", "t", "pos", "n", "h"), zip(*sent), types)})])
    return go


def _remove(length, gram):
    """(doc_id, text, spans) -> bytes outside all repeats; a span with n = 0 asks for the text's own repeats."""
    def go(batches):
        for b in (x for batch in batches for x in _slices(batch, 1)):
            texts, lists = _texts(b.column(1)), b.column(2)
            flat, off = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py() if len(lists) else [0]
            pos, n = [flat.field(f).to_numpy(zero_copy_only=False) for f in ("pos", "n")]
            out = [[], [], [], []]
            for i, text in enumerate(texts):
                raw = text or b""
                mine = slice(off[i], off[i + 1]) if lists[i].is_valid else slice(0, 0)
                p, k = pos[mine], n[mine]
                if len(k) and (k == 0).any():
                    own = [_own_repeats(run, length, gram) for run in pieces([raw], length)]
                    p, k = (np.concatenate([x[k > 0], *[o[j] for o in own]]) for j, x in enumerate((p, k)))
                edge = np.zeros(len(raw) + 1, dtype=np.int32) if len(p) else None
                if edge is None:
                    gone, spans, kept = 0, 0, raw
                else:
                    np.add.at(edge, p, 1)
                    np.add.at(edge, p + k + length - 1, -1)
                    mask = np.cumsum(edge[:-1]) > 0
                    gone = int(mask.sum())
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    kept = np.frombuffer(raw, dtype=np.uint8)[~mask].tobytes()
                for c, v in zip(out, (len(raw), gone, spans, kept)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return go


def _own_repeats(run, length, gram):
    (*_, times), (_, first, n, which) = contexts(run, length, gram)
    own = times[which] > 1
    return first[own] + run[0][1], n[own]


def dedup(docs: DataFrame, length: int = 200, gram: int = 48, per_bucket: int = 8, bucket_rows: int = 40_000,
          most_buckets: int = 16_384, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row: the bytes outside all
    ``length``-byte strings that start anywhere else too.

    One bucket for each ``bucket_rows`` different contexts, ``most_buckets`` at most (beyond that,
    buckets grow); the driver sees ``per_bucket`` * buckets sampled contexts of at most 2 * ``length``
    bytes (52 MB at the defaults), the tasks one splitter a bucket.
    """
    spark = docs.sparkSession
    importable(spark)
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    # a row is known by its id and a hash of id and text; equal rows lose the same bytes
    src = docs.select(F.xxhash64(F.lit("id"), id_).alias("d"), F.xxhash64(id_.isNull(), id_, text).alias("t"),
                      text.alias("text"), id_.alias("doc_id"))
    seeds = src.select("d", "t", "text").where(F.octet_length("text") >= length).mapInArrow(_seeds(length, gram), _SEED)
    repeated = seeds.groupBy("a").agg(F.sum("times").alias("all"), F.min("cx").alias("c0"), F.max("cx").alias("c1")) \
        .where("all > 1").select("a", (F.col("c0") < F.col("c1")).alias("differs"))
    met = materialize(spark, seeds.join(repeated, "a"), "suffix-seeds")
    kinds = materialize(spark, met.groupBy("a", "cx").agg(
        F.sum("times").alias("all"), F.min(F.when(F.col("differs"), F.struct("d", "t", "pos", "n", "reach"))).alias("one")),
        "suffix-kinds")
    whole = met.where("times = 1").join(kinds.where("all > 1").select("a", "cx"), ["a", "cx"]).select("d", "t", "pos", "n") \
        .unionByName(met.where("times > 1").select("d", "t", F.lit(0).alias("pos"), F.lit(0).alias("n")).distinct())

    wanted = materialize(spark, kinds.where("one is not null").groupBy("one.d", "one.t").agg(F.collect_list(F.struct(
        "one.pos", "one.n", "one.reach", "cx", (F.col("all") == 1).alias("single"))).alias("parts")), "suffix-wanted")
    with filtered_scans(spark):
        met_texts = src.select("d", "t", "text").join(wanted, ["d", "t"]).select("d", "t", "text", "parts")
        ctx = materialize(spark, met_texts.mapInArrow(_cut(length), _CONTEXT), "suffix-contexts")
    buckets = min(most_buckets, -(-ctx.count() // bucket_rows))
    width = 2 * (-(-length // 8) * 8)
    sample = ctx.orderBy("cx", "d", "t", "pos").limit(buckets * per_bucket).select("right", "left").collect() if buckets > 1 else []
    keys = sorted(_keys([bytes(r[0]) for r in sample], [bytes(r[1]) for r in sample], width))
    splitters = sorted(set(keys[per_bucket::per_bucket]))
    found = ctx.mapInArrow(_deal(splitters, width), _CONTEXT + ", bucket int").groupBy("bucket") \
        .applyInArrow(_bucket(splitters, length, gram), _FOUND)
    found = materialize(spark, found, "suffix-found")
    # strings on both sides of a border: at most one row per bucket and string
    over = found.where("h is not null")
    across = over.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    ends = found.where("h is null").select("d", "t", "pos", "n").unionByName(
        over.where("d is not null").join(across, "h").select("d", "t", "pos", "n"))
    spans = whole.unionByName(ends).groupBy("d", "t").agg(F.collect_list(F.struct("pos", "n")).alias("spans"))
    return src.join(spans, ["d", "t"], "left").select("doc_id", "text", "spans").mapInArrow(
        _remove(length, gram), f"doc_id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary")
