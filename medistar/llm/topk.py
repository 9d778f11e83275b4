"""Exact top-k inner products by a three-phase uniform threshold.

The components are cut into ``lists`` column lists; the score of a query and a
vector is the sum of its partial scores, one per list.  Vectors are stored in
blocks, queries in packs; each pack is met with each block (a stated query set
against all rows, in blocks).

1. Every block gathers each query's ``k`` best entries of the first ``lead``
   lists, resolves the full scores of these alone, and hands over the k best of
   them.  The k-th best over all blocks (merged in a tree of bounded fan-in) is a
   safe cutoff: k vectors reach it.
2. The cutoff goes to all blocks with the queries.  Lists are added up in turn; an
   entry is collected as long as its sum so far and the most that the lists to come
   can add (the product of the remaining norms) reach the cutoff.  The others
   cannot reach it.
3. Once few entries are left, only their remaining partial scores are resolved,
   and the exact score is kept if it reaches the cutoff.  Of ties, each block keeps
   its k smallest ids.

Components are floor(scale * x), integers; scores are exact (they must fit a
long).  Results by case: see ``vectors.clean`` for nulls, non-finite components,
odd lengths and repeated ids; zero vectors take part; ties go to the smaller id;
with fewer than k candidates all are returned; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, materialize
from .vectors import PACK, asked, blocks, clean, matrix

_FAN = 64
_FEW = 0.125  # share of open entries from which their remaining scores are resolved one by one
_CELLS = 1 << 20  # most numbers gathered at once for that


def _exact(q: np.ndarray, v: np.ndarray):
    """The matrices in a type whose products are exact."""
    bound = (np.abs(q).max(initial=0) * np.abs(v).max(initial=0)) * max(1, q.shape[1])
    return (q, v) if bound < 2 ** 53 else (q.astype(np.int64), v.astype(np.int64))


def _cuts(n, lists):
    """Column ranges of the lists."""
    at = np.linspace(0, n, lists + 1).astype(int)
    return list(zip(at, at[1:]))


def _sums(q, v, i, j, a, b):
    """Partial scores of the entries (i, j) over columns a to b, in bounded memory."""
    step = max(1, _CELLS // max(1, b - a))
    out = np.empty(len(i), dtype=q.dtype)
    for s in range(0, len(i), step):
        out[s:s + step] = np.einsum("ij,ij->i", q[i[s:s + step], a:b], v[j[s:s + step], a:b])
    return out


def _norms(m, at):
    """Length of each row from column ``at`` on."""
    return np.sqrt((m[:, at:].astype(np.float64) ** 2).sum(axis=1))


def _rows(batches):
    for b in batches:
        for r in b.to_pylist():
            qi, vi = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
            yield (qi, matrix(r["q_mat"], len(qi)), np.frombuffer(r["q_extra"], np.float64), vi,
                   matrix(r["mat"], len(vi)), r["block"])


def gather(q_ids, q, v_ids, v, k, lists, lead=2):
    """Phase 1 in one block: each query's k best full scores among the best entries
    of each of the first ``lead`` lists; no other full score is computed."""
    q, v = _exact(q, v)
    own = q_ids[:, None] == v_ids[None, :]
    least = -np.inf if q.dtype.kind == "f" else np.iinfo(np.int64).min
    seen = np.zeros(own.shape, dtype=bool)
    n = len(v_ids)
    for a, b in _cuts(q.shape[1], lists)[:lead]:
        p = q[:, a:b] @ v[:, a:b].T
        p[own] = least
        best = np.argpartition(p, n - k, axis=1)[:, n - k:] if n > k else np.broadcast_to(np.arange(n), own.shape)
        np.put_along_axis(seen, best, True, axis=1)
    i, j = np.nonzero(seen & ~own)
    score = _sums(q, v, i, j, 0, q.shape[1]).astype(np.int64)
    score = score[np.lexsort((-score, i))]
    at = np.searchsorted(i, np.arange(len(q_ids) + 1))
    return [score[a:b][:k] for a, b in zip(at, at[1:])]


def collect(q_ids, q, cutoff, v_ids, v, lists):
    """Phase 2 in one block: (i, j, sums so far, column they go to) of the entries
    that may reach the cutoffs."""
    total = np.zeros((len(q_ids), len(v_ids)), dtype=q.dtype)
    most = _norms(q, 0).max(initial=0) * _norms(v, 0).max(initial=0)
    slack = 1e-9 * most + 1  # more than the bounds' rounding
    mine = q_ids[:, None] != v_ids[None, :]
    cuts = _cuts(q.shape[1], lists)
    for l, (a, b) in enumerate(cuts):
        total += q[:, a:b] @ v[:, a:b].T
        # the first half of the lists excludes next to nothing; sums beyond 2^62 bound nothing
        if 2 * l + 2 < lists or l + 1 == lists or most >= 2.0 ** 62:
            continue
        reach = _norms(q, b)[:, None] * _norms(v, b)[None, :]
        reach += total
        open_ = reach >= (cutoff - slack)[:, None]
        open_ &= mine
        if np.count_nonzero(open_) <= _FEW * open_.size:
            i, j = np.nonzero(open_)
            return i, j, total[i, j], l + 1
    i, j = np.nonzero((total >= cutoff[:, None]) & mine)
    return i, j, total[i, j], lists


def resolve(q_ids, q, cutoff, v_ids, v, k, lists):
    """Phases 2 and 3 in one block: (query, vector, score) of what reaches the cutoffs."""
    q, v = _exact(q, v)
    i, j, score, done = collect(q_ids, q, cutoff, v_ids, v, lists)
    for a, b in _cuts(q.shape[1], lists)[done:]:
        score = score + _sums(q, v, i, j, a, b)
    keep = score >= cutoff[i]
    i, j, score = i[keep], j[keep], score[keep].astype(np.int64)
    order = np.lexsort((v_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i, side="left")
    keep = np.arange(len(i)) - first < k
    return q_ids[i[keep]], v_ids[j[keep]], score[keep]


def search(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, scale: float = 64.0,
           every: int = 20, lists: int = 8, lead: int = 2, pack: int = 512, size: int = PACK) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best."""
    spark = table.sparkSession
    importable(spark)
    rows = clean(table, id_col, vec_col, nonzero=False)
    too_large = F.raise_error(F.lit("a component times the scale is beyond 64-bit integers")).cast("double")
    whole = lambda x: F.when(F.abs(x) < 2.0 ** 62, F.floor(x).cast("double")).otherwise(too_large)
    rows = rows.select("vec_id", F.transform("v", lambda x: whole(x * F.lit(scale))).alias("v")).distinct()
    rows = materialize(spark, rows, "topk-rows")
    length = F.size("v").cast("long").alias("grp")  # vectors meet those of their own length
    base = materialize(spark, blocks(rows.select("vec_id", "v", length, F.lit(0.0).alias("extra")), size),
                       "topk-blocks").select("grp", "block", "ids", "mat")
    n_blocks = base.agg(F.max("block")).first()[0]
    queries = asked(rows, every).select("vec_id", "v", length)

    def meet(packed):
        packs = blocks(packed, pack).select("grp", F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat"), F.col("extra").alias("q_extra"))
        at = packs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks or 0).cast("long"))))
        return at.repartition("grp", "block").join(base, ["grp", "block"])

    def phase1(batches):
        for qi, q, _, vi, v, block in _rows(batches):
            best = gather(qi, q, vi, v, k, lists, lead)
            yield pa.RecordBatch.from_arrays([pa.array(qi), pa.array([block] * len(qi), pa.int64()),
                                              pa.array([x.tolist() for x in best], pa.list_(pa.int64()))], ["query_id", "g", "best"])

    def phase2(batches):
        for qi, q, cut, vi, v, _ in _rows(batches):
            a, b, s = resolve(qi, q, cut, vi, v, k, lists)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], ["query_id", "vec_id", "score"])

    local = meet(queries.withColumn("extra", F.lit(0.0))).mapInArrow(phase1, "query_id long, g long, best array<long>")
    groups = n_blocks or 0
    while True:
        groups //= _FAN
        local = local.withColumn("g", F.floor(F.col("g") / F.lit(_FAN)).cast("long")).groupBy("query_id", "g").agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, k).alias("best"))
        if groups == 0:
            break
    cutoff = local.select(F.col("query_id").alias("vec_id"), F.when(F.size("best") >= k, F.element_at("best", -1).cast("double"))
                          .otherwise(F.lit(float("-inf"))).alias("extra"))
    found = meet(queries.join(cutoff, "vec_id")).mapInArrow(phase2, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
