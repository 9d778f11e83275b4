"""N-gram Jaccard join: an exact, size-aware heavy-light set similarity join.

A document is the set of its distinct k-word shingles; two documents link when
``den * intersection >= num * union``.  Equal sets are folded into one
representative first, so copies meet in a grouped minimum and nowhere else.

* Small sets enumerate all subsets of the size their partners must share
  (``subset_keys``): a pair that links shares one, so its key meets.
* Large sets post inverted-list entries on parts of the shingle universe
  (``part_keys``): with one part more than the difference that a linking pair
  can have, one part is untouched in both.  Empty parts are allowed for; a set
  with more of them than that posts them too.
* The boundary between small and large is the size with the least total cost,
  from the corpus' size histogram.

Sets that meet under a key are tested by their parity sketches: the xor of two
has at most as many bits as the sets' difference, so a pair with more than a
linking pair can have is ruled out for certain.  Sets of a key are compared with
its first set, and only what that one rules out with the others; each key leaves
a spanning forest.  The forests' components are loose groups (a superset of all
links).  Inside a loose group the shingles' inverted lists are scanned and
overlaps counted exactly.  A key with more sets than ``bucket``, and a group with
more shingles than ``block``, are cut into chunks that meet in pairs, so no task
holds an unbounded group: the first chunk meets all, then the sets outside the
largest component so far do, which leaves no unconnected pair untested and, in a
group of near copies, far fewer pairs of chunks than all.  Each task returns a spanning forest of its links, and the
components of all forests are the result: no link is lost, copies and near
copies are never expanded into all pairs.

Results by case: null, empty and wordless texts have an empty set, link with
nothing and are their own component; with fewer than k words the whole sequence
is the one shingle; ties need no order (sets are compared exactly); rows that
share an id are one document of the graph; a row with a null id takes no part
(component null); an empty table gives no rows; other columns are ignored.
Texts are read whole, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, filtered_scans, importable, materialize, row_hash
from .textkit import Words, mix, signed, slices

_RATIO = 1.5  # of the largest to the smallest size in a class of large sets
_U = np.uint64


# ------------------------------------------------------------ sizes and keys

def need(a: int, b: int, num: int, den: int) -> int:
    """Least intersection of linking sets of sizes a and b."""
    return -(-num * (a + b) // (num + den))


def partners(s: int, num: int, den: int) -> range:
    """Sizes a set of size s can link with."""
    return range(max(1, -(-num * s // den)), den * s // num + 1)


def subset_sizes(s: int, small: int, num: int, den: int) -> list[int]:
    """Sizes of the subsets a set of size s enumerates, given the largest small size."""
    return sorted({need(s, b, num, den) for b in partners(s, num, den)
                   if min(s, b) <= small and need(s, b, num, den) <= min(s, b)})


def size_class(s: int, small: int) -> tuple[int, int, int]:
    """(class, least size, largest size) of a large set."""
    j, lo = 0, small + 1
    while True:
        hi = max(lo, int(lo * _RATIO))
        if s <= hi:
            return j, lo, hi
        j, lo = j + 1, hi + 1


def part_counts(hi: int, num: int, den: int) -> tuple[int, int]:
    """(number of parts, empty parts allowed) of a class whose largest size is hi."""
    differ = 2 * hi * (den - num) // (den + num)
    spare = 3 + differ // 12
    return differ + 1 + spare, spare


def postings(s: int, small: int, num: int, den: int) -> tuple[int, int]:
    """(subset keys, part keys) a set of size s costs."""
    sub = sum(comb(s, s - c) for c in subset_sizes(s, small, num, den))
    part = 0
    if s > small:
        j, lo, hi = size_class(s, small)
        part = part_counts(hi, num, den)[0]
        if den * s // num > hi:
            part += part_counts(max(hi + 1, int((hi + 1) * _RATIO)), num, den)[0]
    return sub, part


def boundary(histogram: dict[int, int], num: int, den: int, scan_cost: float = 3.0, most: int = 24) -> int:
    """The largest small size with the least cost over a size histogram; an entry of
    an inverted list costs ``scan_cost`` keys, as less selective lists are scanned later."""
    def cost(small):
        total = 0.0
        for s, n in histogram.items():
            sub, part = postings(s, small, num, den)
            total += n * (sub + scan_cost * part)
        return total
    return min(range(1, most + 1), key=lambda x: (cost(x), x))


def set_keys(h: np.ndarray, small: int, num: int, den: int) -> np.ndarray:
    """All keys of one set (sorted distinct shingle hashes)."""
    s, out = len(h), []
    with np.errstate(over="ignore"):
        sizes = subset_sizes(s, small, num, den)
        if sizes:
            v = mix(h, 11)
            total = v.sum(dtype=_U)
            for c in sizes:
                drop = s - c
                if drop == 0:
                    sums = np.array([total], dtype=_U)
                elif drop == 1:
                    sums = total - v
                else:
                    sums = total - np.array([v[list(x)].sum(dtype=_U) for x in combinations(range(s), drop)], dtype=_U)
                out.append(mix(sums, 1000 + c))
        if s > small:
            j, lo, hi = size_class(s, small)
            out.append(_part_keys(h, j, hi, num, den))
            if den * s // num > hi:
                out.append(_part_keys(h, j + 1, max(hi + 1, int((hi + 1) * _RATIO)), num, den))
        return np.concatenate(out) if out else np.zeros(0, _U)


def _part_keys(h, j, hi, num, den):
    m, spare = part_counts(hi, num, den)
    part = ((h >> _U(32)) * _U(m)) >> _U(32)  # ranges of the hash: h is sorted, so parts are runs
    cut = np.searchsorted(part, np.arange(m + 1, dtype=_U))
    sums = np.concatenate([[_U(0)], np.cumsum(mix(h, 12 + j), dtype=_U)])
    sums = sums[cut[1:]] - sums[cut[:-1]]
    keys = mix(sums ^ mix(np.arange(m, dtype=_U), 5000 + j), 12 + j)
    filled = cut[1:] > cut[:-1]
    return keys if m - int(filled.sum()) > spare else keys[filled]


def shingle_sets(texts, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow string column."""
    w = Words(texts, lower=True)
    at, g = w.grams(k, salt=k)
    cut = np.searchsorted(at, w.first)
    sets = []
    for i in range(w.n):
        if cut[i + 1] > cut[i]:
            x = np.sort(g[cut[i]: cut[i + 1]])
            sets.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        else:
            words = w.h[w.first[i]: w.first[i + 1]]
            with np.errstate(over="ignore"):
                sets.append(mix((mix(words, 3) * (2 * np.arange(len(words), dtype=_U) + _U(1))).sum(
                    dtype=_U, keepdims=True), 40 + len(words)) if len(words) else words)
    return sets


def signature(h: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        both = np.array([mix(h, 21).sum(dtype=_U), mix(h, 22).sum(dtype=_U)], dtype=_U)
    return tuple(int(x) for x in signed(both))


def sketch(h: np.ndarray) -> bytes:
    """Parity sketch: one bit per hash range, flipped by each shingle in it; as many bits as
    shingles, or more, tell sets with much in common from linking ones, so that loose groups
    do not chain up with the corpus; a power of two folds."""
    bits = max(64, 1 << (len(h) - 1).bit_length()) if len(h) > 1 else 64
    return np.packbits(np.bincount((mix(h, 31) & _U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


# ------------------------------------------------------------ tasks

def _signatures(k):
    def run(batches):
        for b in (x for batch in batches for x in slices(batch, 1)):
            sets = shingle_sets(b.column(1), k)
            sig = [signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in sig], pa.int64()),
                 pa.array([y for _, y in sig], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())],
                ["doc_id", "n_shingles", "s1", "s2", "sketch"])
    return run


def _postings(k, small, num, den, remember=200_000):
    """(key, s1) of every set; a set already seen by the task is not posted again
    (its node has the same postings), so copies cost nothing; forgetting is harmless."""
    def run(batches):
        seen: set[int] = set()
        for b in (x for batch in batches for x in slices(batch, 0)):
            keys, nodes = [], []
            for h in shingle_sets(b.column(0), k):
                if not len(h):
                    continue
                s1 = signature(h)[0]
                if s1 in seen:
                    continue
                if len(seen) >= remember:
                    seen.clear()
                seen.add(s1)
                x = set_keys(h, small, num, den)
                keys.append(x)
                nodes.append(np.full(len(x), s1, dtype=np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(np.concatenate(keys))), pa.array(np.concatenate(nodes))], ["key", "node"])
    return run


def _shared(batches):
    """Of rows sorted by (key, node): those of keys that two nodes or more have,
    each node once, streamed: one row is held back at a time."""
    held = None  # the last row, whose key may go on
    emitted = False  # whether the held row has gone out
    for b in batches:
        key, node = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(key):
            continue
        if held is not None:
            key, node = np.concatenate([[held[0]], key]), np.concatenate([[held[1]], node])
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        at = np.flatnonzero(new)
        k, v = key[at], node[at]
        same = k[1:] == k[:-1]
        out = np.zeros(len(k), dtype=bool)
        out[1:] |= same
        out[:-1] |= same
        if held is not None and emitted:
            out[0] = False
        emitted = bool(out[-1]) or (len(k) == 1 and emitted and held is not None)
        held = (k[-1], v[-1])
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(k[out]), pa.array(v[out])], ["key", "node"])


def _fold(x: int, bits: int, to: int) -> int:
    while bits > to:
        bits //= 2
        x = (x ^ (x >> bits)) & ((1 << bits) - 1)
    return x


def may_link(a: tuple, b: tuple, num: int, den: int) -> bool:
    """Whether sizes and parity sketches leave a link open; a set here is
    (size, sketch bits, sketch as an integer)."""
    least = need(a[0], b[0], num, den)
    if least > min(a[0], b[0]):
        return False
    width = min(a[1], b[1])
    return (_fold(a[2], a[1], width) ^ _fold(b[2], b[1], width)).bit_count() <= a[0] + b[0] - 2 * least


class _Bucket:
    """May-link tests of one set against all sets of a large bucket at once."""

    def __init__(self, sets, num, den):
        self.sets, self.num, self.den = sets, num, den
        self.sizes = np.array([s[0] for s in sets])
        self.by_width = {}
        for w in {s[1] for s in sets}:
            at = np.array([i for i, s in enumerate(sets) if s[1] == w])
            raw = b"".join(sets[i][2].to_bytes(w // 8, "little") for i in at)
            self.by_width[w] = (at, np.frombuffer(raw, dtype=np.uint64).reshape(len(at), w // 64))

    def open_with(self, i):
        size, width, x = self.sets[i]
        least = -(-self.num * (self.sizes + size) // (self.num + self.den))
        differ = self.sizes + size - 2 * least
        ok = least <= np.minimum(self.sizes, size)
        for w, (at, m) in self.by_width.items():
            to = min(w, width)
            a = np.frombuffer(_fold(x, width, to).to_bytes(to // 8, "little"), dtype=np.uint64)
            while m.shape[1] * 64 > to:
                m = m[:, : m.shape[1] // 2] ^ m[:, m.shape[1] // 2:]
            ok[at] &= np.bitwise_count(m ^ a).sum(axis=1, dtype=np.int64) <= differ[at]
        return np.flatnonzero(ok)


def bucket_forest(nodes: list, sets: list[tuple], num: int, den: int) -> list[tuple[int, int]]:
    """Edges that connect every pair of a bucket that may link: each set is held
    against all others unless it is one with the first set, whose row is full."""
    n = len(nodes)
    if n == 2:
        return [(nodes[0], nodes[1])] if may_link(sets[0], sets[1], num, den) else []
    big = _Bucket(sets, num, den) if n > 24 else None
    label, edges = list(range(n)), []
    first = set()
    for i in range(n):
        if i in first:
            continue
        found = big.open_with(i) if big else [j for j in range(n) if j != i and may_link(sets[i], sets[j], num, den)]
        for j in found:
            j = int(j)
            if label[j] != label[i]:
                edges.append((nodes[i], nodes[j]))
                lo, hi = min(label[i], label[j]), max(label[i], label[j])
                label = [lo if x == hi else x for x in label] if n <= 24 else _relabel(label, hi, lo)
        if i == 0:
            first = {j for j in range(n) if label[j] == 0}
    return edges


def _relabel(label: list, old: int, new: int) -> list:
    a = np.array(label)
    a[a == old] = new
    return a.tolist()


def _compatible(num, den):
    """Edges of each bucket of rows (key, node, n, sketch) that are sorted by key."""
    def flush(rows):
        one = {r[0]: r for r in rows}
        if len(one) > 1:
            sets = [(n, 8 * len(x), int.from_bytes(x, "little")) for _, n, x in one.values()]
            yield from bucket_forest(list(one), sets, num, den)

    def run(batches):
        key, rows, edges = None, [], set()
        for b in batches:
            for k, *row in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    edges.update(flush(rows))
                    key, rows = k, []
                rows.append(row)
            if len(edges) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], ["src", "dst"])
                edges = set()
        edges.update(flush(rows))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*edges)], ["src", "dst"])
    return run


def link_sets(sets: list[np.ndarray], chunk: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets, by scanning inverted lists.
    With two chunks present, only links between the chunks are looked for."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    cross = chunk.min() != chunk.max()
    tok = np.concatenate([sets[i] for i in order])
    own = np.repeat(np.arange(n), size[order])
    by = np.lexsort((own, tok))
    t, o = tok[by], own[by]
    head = np.concatenate([[True], t[1:] != t[:-1]])
    start = np.flatnonzero(head)
    end = np.concatenate([start[1:], [len(t)]])
    shared = (end - start) > 1
    list_of = np.cumsum(head) - 1
    inv = np.empty(len(tok), dtype=np.int64)
    inv[by] = list_of  # list of each (set, token)
    at = np.concatenate([[0], np.cumsum(size[order])])
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sz, ck, edges = size[order], chunk[order], []
    for x in range(1, n):
        lists = inv[at[x]: at[x + 1]]
        lists = lists[shared[lists]]
        if not len(lists):
            continue
        cand = np.concatenate([o[start[i]: end[i]] for i in lists])
        cand = cand[cand < x]
        if not len(cand):
            continue
        counts = np.bincount(cand, minlength=x)
        ok = den * counts >= num * (sz[x] + sz[:x] - counts)
        if cross:
            ok &= ck[:x] != ck[x]
        for y in np.flatnonzero(ok & (counts > 0)):
            rx, ry = root(x), root(int(y))
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                edges.append((int(order[x]), int(order[y])))
    return edges


def _forest(k, num, den):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = shingle_sets(pa.array(pdf["text"].tolist(), pa.large_string()), k)
        keep = [i for i, s in enumerate(sets) if len(s) and signature(s) == (pdf["s1"].iat[i], pdf["s2"].iat[i])]
        ids, seen = [], set()
        for i in keep:  # a repeated row brings the same set again
            if (pdf["rep"].iat[i], pdf["s1"].iat[i]) not in seen:
                seen.add((pdf["rep"].iat[i], pdf["s1"].iat[i]))
                ids.append(i)
        if len(ids) < 2:
            return pd.DataFrame({"src": pd.Series(dtype="int64"), "dst": pd.Series(dtype="int64")})
        rep = pdf["rep"].to_numpy()[ids]
        edges = link_sets([sets[i] for i in ids], pdf["chunk"].to_numpy()[ids], num, den)
        return pd.DataFrame({"src": [rep[a] for a, _ in edges], "dst": [rep[b] for _, b in edges]}, dtype="int64")
    return run


# ------------------------------------------------------------ large groups

def _chunk(spread: list[str], of) -> Column:
    return F.pmod(F.xxhash64(F.lit("chunk"), *spread), F.col(of)).cast("int")


def deal(members: DataFrame) -> DataFrame:
    """Members with the pairs of chunks, ``at`` (a, b), in which they meet others: chunks below ``open`` meet all
    ``chunks`` of their group, the others those below ``open`` only."""
    last = F.when(F.col("chunk") < F.col("open"), F.col("chunks")).otherwise(F.col("open")) - 1
    return members.withColumn("at", F.explode(F.transform(F.sequence(F.lit(0), last), lambda c: F.struct(
        F.least(c, F.col("chunk")).alias("a"), F.greatest(c, F.col("chunk")).alias("b")))))


def first_chunks(members: DataFrame, spread: list[str], per_chunk: int) -> DataFrame:
    """Members, of groups of a ``size``, in chunks of which the first is open."""
    chunks = F.ceil(F.col("size") / F.lit(float(per_chunk))).cast("int")
    return members.withColumn("chunks", chunks).withColumn("open", F.lit(1)).withColumn("chunk", _chunk(spread, "chunks"))


def rest_chunks(members: DataFrame, group: str, node: str, spread: list[str], weight: Column, per_chunk: int,
                found: DataFrame) -> DataFrame:
    """Members of groups that the components ``found`` (id, component) leave apart: a group's largest component is
    connected already, the chunks of all its other members are open."""
    own = members.join(found.select(F.col("id").alias(node), F.col("component").alias("_own")), node, "left") \
        .withColumn("_own", F.coalesce("_own", node)).withColumn("_w", weight)
    part = own.groupBy(group, "_own").agg(F.sum("_w").alias("w"))
    home = part.groupBy(group).agg(F.max(F.struct("w", "_own")).alias("home"), F.sum("w").alias("all")) \
        .where(F.col("all") > F.col("home.w"))
    count = lambda w: F.ceil(w / F.lit(float(per_chunk))).cast("int")
    home = home.select(group, F.col("home._own").alias("_home"), count(F.col("all") - F.col("home.w")).alias("open"),
                       count(F.col("home.w")).alias("_rest"))
    chunk = F.when(F.col("_own") == F.col("_home"), F.col("open") + _chunk(spread, "_rest")).otherwise(_chunk(spread, "open"))
    return own.join(home, group).withColumn("chunk", chunk).withColumn("chunks", F.col("open") + F.col("_rest")) \
        .drop("_own", "_home", "_rest", "_w")


def _linked_in_rounds(spark: SparkSession, members: DataFrame, group: str, node: str, spread: list[str], weight: Column,
                      per_chunk: int, large: DataFrame, name: str, link: Callable[[DataFrame, bool], DataFrame]) -> DataFrame:
    """Components of the links that ``link`` finds among members dealt to pairs of chunks (first round or not).

    A ``large`` group is not held against itself whole: its first chunk meets all of it, which connects most of a
    group of near copies.  Two members that are still apart are not both in the largest component, so what is left is
    to hold the members outside that component against all: every pair that is not connected by then is tested, and
    the work grows with the group, not with its square, as long as few members stay outside."""
    comp = components(spark, link(deal(first_chunks(members, spread, per_chunk)), True), name)
    if not large.head(1):
        return comp
    left = rest_chunks(members.join(large.select(group), group, "left_semi"), group, node, spread, weight, per_chunk, comp)
    more = link(deal(left), False)
    return components(spark, more.unionByName(comp.select(F.col("id").alias("src"), F.col("component").alias("dst"))), name)


# ------------------------------------------------------------ the operator

def join_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text", block: int = 1 << 18, bucket: int = 2048) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document row."""
    spark = docs.sparkSession
    importable(spark)
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    sig = materialize(spark, src.mapInArrow(_signatures(k), "doc_id long, n_shingles long, s1 long, s2 long, sketch binary"), "join-sig")
    full = sig.where("n_shingles > 0 and doc_id is not null")
    histogram = {r[0]: r[1] for r in full.where("n_shingles <= 64").groupBy("n_shingles").count().collect()}
    small = boundary(histogram, num, den)

    keys = src.where("doc_id is not null").select("text").mapInArrow(_postings(k, small, num, den), "key long, node long")
    shared = materialize(spark, keys.repartition(F.col("key")).sortWithinPartitions("key", "node")
                         .mapInArrow(_shared, "key long, node long"), "join-shared")
    reps = materialize(spark, full.groupBy("s1", "s2", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min("sketch").alias("sketch")), "join-reps")
    sketches = reps.select(F.col("s1").alias("node"), F.col("n_shingles").alias("n"), "sketch")

    one = F.lit(1)
    hot = materialize(spark, shared.groupBy("key").agg(F.count(one).alias("size")).where(F.col("size") > bucket), "join-hot")
    few = shared.join(hot, "key", "left_anti").select("node", "key")

    def tested(dealt: DataFrame, first: bool) -> DataFrame:
        dealt = dealt.select("node", F.xxhash64("key", "at.a", "at.b").alias("key"))
        dealt = dealt.unionByName(few) if first else dealt
        return dealt.join(sketches, "node").select("key", "node", "n", "sketch") \
            .repartition(F.col("key")).sortWithinPartitions("key").mapInArrow(_compatible(num, den), "src long, dst long")

    loose = _linked_in_rounds(spark, shared.join(hot, "key"), "key", "node", ["node"], one, bucket, hot, "join-loose", tested) \
        .select(F.col("id").alias("s1"), F.col("component").alias("loose"))

    reps = reps.drop("sketch")
    member = materialize(spark, reps.join(loose, "s1"), "join-members")
    # only the texts of loose groups are needed: their scan is filtered before it is shuffled
    wanted = materialize(spark, member.select("rep", F.lit(1).alias("wanted")).distinct(), "join-wanted").where("wanted > 0")
    with filtered_scans(spark):
        texts = materialize(spark, src.join(wanted, src["doc_id"] == wanted["rep"]).select("rep", "text"), "join-texts")

    def linked(dealt: DataFrame, first: bool) -> DataFrame:
        return texts.join(dealt, "rep").select("loose", "at", "rep", "s1", "s2", "chunk", "text") \
            .groupBy("loose", "at").applyInPandas(_forest(k, num, den), "src long, dst long")

    sizes = member.groupBy("loose").agg(F.sum("n_shingles").alias("size"))
    large = materialize(spark, sizes.where(F.col("size") > block), "join-large")
    # rows that share an id are one document: their sets meet in its node
    comp = _linked_in_rounds(spark, member.join(sizes, "loose"), "loose", "rep", ["rep", "s1"], F.col("n_shingles"), block,
                             large, "join-links", linked).select(F.col("id").alias("rep"), F.col("component"))
    classes = reps.join(comp, "rep", "left").select("s1", "s2", "n_shingles", F.coalesce("component", "rep").alias("c"))
    found = full.drop("sketch").join(classes, ["s1", "s2", "n_shingles"]).select("doc_id", "n_shingles", F.col("c").alias("component_id"))
    alone = sig.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).alias("component_id"))
    return found.unionByName(alone)


def keep_one(docs: DataFrame, **kw) -> DataFrame:
    """docs with one document (the smallest id) of each component; rows without an
    id stay; of rows that share an id the one with the smallest row hash stays."""
    found = join_components(docs, **kw).where("doc_id = component_id").select(
        F.col("doc_id").alias("_keep")).distinct()
    kept = docs.join(found, F.col("doc_id").cast("long") == F.col("_keep"), "left_semi")
    return keep_first(kept).unionByName(docs.where("doc_id is null"))


def keep_first(rows: DataFrame) -> DataFrame:
    """Of rows that share an id, the one with the smallest row hash."""
    one = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("doc_id").orderBy(row_hash(rows))))
    return one.where("_rank = 1").drop("_rank")
