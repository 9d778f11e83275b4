"""Approximate nearest neighbours by inner product: adaptive dimension scan.

Index: vectors get one more component that makes them all as long as the longest
(largest inner product is then least distance), are turned by a seeded random
rotation, and are assigned to inverted lists: the nearest of about
``sqrt(n) / 4`` centroids, fitted by k-means on a bounded sample (the ``sample``
rows of smallest id hash).  Every vector is indexed; a list is stored in blocks
of bounded size, so a list that holds a third of all rows is split.

Search: a query's nearest list is scanned whole and gives it a cutoff.  The other
probed lists are scanned in column blocks of the rotated vectors: a partial
distance over d of D columns, scaled by D / d, estimates the distance, and a
candidate whose estimate exceeds the cutoff by more than the test's error
(1 + eps / sqrt(d)) is abandoned.  Survivors get their exact inner product, in
double precision, from the original vectors.

The number of probed lists is measured, not guessed: the true neighbours of
``probe_queries`` sampled queries, by brute force over all rows, tell how many lists
reach ``recall``.

Results by case: see ``vectors.clean`` for nulls, non-finite components, odd
lengths and repeated ids; zero vectors take no part; ties go to the smaller id;
with fewer than k candidates all are returned; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vectors
from .common import importable, materialize
from .vectors import PACK, blocks, clean, matrix


def rotation(d: int, seed: int = 17) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def turned(x: np.ndarray, longest: float, rot: np.ndarray, query: bool = False) -> np.ndarray:
    """Rotated vectors with the added component (0 for queries)."""
    more = np.zeros(len(x)) if query else np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0.0))
    return np.column_stack([x, more]) @ rot


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * (a @ b.T)


CHUNK_CELLS = 1 << 22  # entries of a (rows x centroids) matrix held at once: 32 MB


def ranked(x: np.ndarray, c: np.ndarray, most: int | None = None) -> np.ndarray:
    """Of each row of x, the ``most`` nearest rows of c (none: all), nearest first, some rows at a time."""
    step = max(1, CHUNK_CELLS // len(c))
    parts = []
    for at in range(0, len(x), step):
        d = distances(x[at:at + step], c)
        parts.append(d.argmin(1)[:, None] if most == 1 else np.argsort(d, axis=1, kind="stable")[:, :most].astype(np.int32))
    return np.concatenate(parts) if parts else np.zeros((0, most or len(c)), np.int32)


def k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = ranked(x, c, 1)[:, 0]
        n = np.bincount(near, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def scan(q_ids, q, cutoff, v_ids, v, longest, rot, k, columns=16, eps=2.1):
    """One pack of queries against one block: (query, vector, score) of up to k
    per query.  An infinite cutoff (-inf) scans whole."""
    own = q_ids[:, None] == v_ids[None, :]
    alive = ~own
    if np.isfinite(cutoff).any():
        a, b = turned(q, longest, rot, True).astype(np.float32), turned(v, longest, rot).astype(np.float32)
        dims = a.shape[1]
        far = np.einsum("ij,ij->i", q, q) + longest - 2.0 * cutoff  # squared distance at the cutoff
        part = np.zeros(alive.shape, dtype=np.float32)
        sparse = None
        for at in range(0, dims, columns):
            to = min(dims, at + columns)
            x, y = a[:, at:to], b[:, at:to]
            slack = 1.0 if to == dims else (1.0 + eps / math.sqrt(to)) ** 2
            limit = np.where(np.isfinite(far), np.maximum(far, 0.0) * slack * to / dims * (1 + 1e-4) + 1e-5 * longest, np.inf)
            if sparse is None:
                part += distances(x, y)
                alive &= part <= limit[:, None]
                if alive.mean() < 0.08:
                    i, j = np.nonzero(alive)
                    sparse = i, j, part[i, j]
            else:
                i, j, p = sparse
                p = p + np.square(x[i] - y[j]).sum(1)
                keep = p <= limit[i]
                sparse = i[keep], j[keep], p[keep]
        i, j = np.nonzero(alive) if sparse is None else sparse[:2]
    else:
        i, j = np.nonzero(alive)
    score = np.empty(len(i))
    for s in range(0, len(i), 65536):
        score[s: s + 65536] = np.einsum("ij,ij->i", q[i[s: s + 65536]], v[j[s: s + 65536]])
    keep = score >= cutoff[i]
    i, j, score = i[keep], j[keep], score[keep]
    order = np.lexsort((v_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
    return q_ids[i[keep]], v_ids[j[keep]], score[keep]


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return rows.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def search(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, every: int = 20,
           recall: float = 0.97, sample: int = 16384, probe_queries: int = 128, pack: int = 128,
           size: int = PACK) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k nearest found."""
    spark = table.sparkSession
    importable(spark)
    rows = materialize(spark, clean(table, id_col, vec_col, nonzero=True), "ann-rows")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n = rows.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out)
    # vectors of the most common length are indexed; those of another one are few lists of their own, scanned whole
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()["d"]
    others = rows.where(F.size("v") != dims).withColumn("grp", -F.size("v").cast("long"))
    everything, rows = rows, rows.where(F.size("v") == dims)
    n, longest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    rot = rotation(dims + 1)
    seeds = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()])
    lists = max(1, min(round(math.sqrt(n) / 4), len(seeds)))
    centroids = k_means(turned(seeds, longest, rot), lists)

    def assign(batches):
        for b in batches:
            v = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
            near = ranked(turned(v, longest, rot), centroids, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(near.astype(np.int64))], ["vec_id", "v", "grp"])

    index = materialize(spark, rows.mapInArrow(assign, "vec_id long, v array<double>, grp long"), "ann-index")
    base = materialize(spark, blocks(index.unionByName(others).withColumn("extra", F.lit(0.0)), size), "ann-blocks") \
        .select("grp", F.col("ids"), F.col("mat"))
    counts = np.zeros(lists, dtype=np.int64)
    for r in index.groupBy("grp").count().collect():
        counts[r["grp"]] = r["count"]
    probes = _probes(index, rows, centroids, longest, rot, k, every, recall, probe_queries)

    def route(batches):
        for b in batches:
            step = max(1, CHUNK_CELLS // lists)
            for b in (b.slice(at, step) for at in range(0, b.num_rows, step)):
                v = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1)
                order = ranked(turned(v, longest, rot, True), centroids)
                # more lists where the probed ones hold too few vectors
                enough = (np.cumsum(counts[order], axis=1) <= 4 * k).sum(1) + 1
                take = np.minimum(np.maximum(probes, enough), lists)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                    [o[:t].tolist() for o, t in zip(order, take)], pa.list_(pa.int64()))], ["vec_id", "v", "lists"])

    queries = vectors.asked(everything, every)
    asked = materialize(spark, queries.where(F.size("v") == dims).mapInArrow(route, "vec_id long, v array<double>, lists array<long>")
                        .unionByName(queries.where(F.size("v") != dims).withColumn("lists", F.array(-F.size("v").cast("long")))),
                        "ann-queries")

    def visit(batches):
        for b in batches:
            for r in b.to_pylist():
                qi, vi = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["ids"], np.int64)
                i, j, s = scan(qi, matrix(r["q_mat"], len(qi)), np.frombuffer(r["q_extra"], np.float64), vi,
                               matrix(r["mat"], len(vi)), longest, rot, k)
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(s)], ["query_id", "vec_id", "score"])

    def meet(queries):
        packs = blocks(queries, pack).select("grp", F.col("ids").alias("q_ids"), F.col("mat").alias("q_mat"),
                                             F.col("extra").alias("q_extra"))
        return packs.join(base, "grp").mapInArrow(visit, "query_id long, vec_id long, score double")

    near = materialize(spark, _best(meet(asked.select(F.get("lists", F.lit(0)).alias("grp"), "vec_id", "v",
                                                     F.lit(float("-inf")).alias("extra"))), k), "ann-nearest")
    cutoff = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.count(F.lit(1)).alias("got"), F.min("score").alias("low"))
    rest = asked.join(cutoff, "vec_id", "left").select(
        F.explode(F.slice("lists", 2, lists)).alias("grp"), "vec_id", "v",
        F.when(F.col("got") >= k, F.col("low")).otherwise(F.lit(float("-inf"))).alias("extra"))
    found = near.select("query_id", "vec_id", "score").unionByName(meet(rest))
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def _probes(index, rows, centroids, longest, rot, k, every, recall, probe_queries) -> int:
    """Lists to probe so that the sampled queries' true neighbours are reached."""
    asked = vectors.asked(rows, every).orderBy(F.xxhash64("vec_id"), "vec_id").limit(probe_queries).collect()
    if not asked:
        return len(centroids)
    ids, q = np.array([r["vec_id"] for r in asked]), np.array([r["v"] for r in asked])

    def brute(batches):
        for b in batches:
            v, vi = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1), b.column(0).to_numpy()
            s = np.where(ids[:, None] == vi[None, :], -np.inf, q @ v.T)
            best = np.argpartition(s, -k, axis=1)[:, -k:] if s.shape[1] > k else np.broadcast_to(np.arange(s.shape[1]), s.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, best.shape[1])), pa.array(vi[best].ravel()),
                 pa.array(np.take_along_axis(s, best, 1).ravel()), b.column(2).take(pa.array(best.ravel()))],
                ["query_id", "vec_id", "score", "grp"])

    true = _best(index.mapInArrow(brute, "query_id long, vec_id long, score double, grp long").where("score > double('-inf')"), k)
    order = np.argsort(distances(turned(q, longest, rot, True), centroids), axis=1, kind="stable")
    place = np.empty_like(order)
    place[np.arange(len(q))[:, None], order] = np.arange(len(centroids))
    row = {int(x): i for i, x in enumerate(ids)}
    at = np.sort([place[row[r["query_id"]], r["grp"]] for r in true.select("query_id", "grp").collect()])
    return int(at[min(len(at) - 1, math.ceil(recall * len(at)) - 1)]) + 1 if len(at) else len(centroids)
