"""Mixing sources to target weights by pivotal dependent rounding, JVM only.

A source's target is its share of ``total_share`` of all words, by weight,
capped at ``max_copies`` times its own words (the excess is shared again by
weight).  A document of a source wants target / source_size copies: the whole
part is certain, the fraction is rounded by pairing documents: words are
transferred from one fractional copy to the other, at random in the direction
that keeps every expectation, until one of the two becomes 0 or 1, so the
source's expected and actual words stay equal at each step.  Documents are
paired inside small groups, the one fractional document a group has left goes
up a reduction tree of ``fan_in`` groups, so no source is ever in one task.  The
last fractional document of a source is taken in part (its first words), which
ends on the target.  Coins are hashes of the seed and the two rows: reruns agree.

Results by case: null or empty text has size 0 and is taken 0 times over; a
null source is a source of its own, last in weight order; a null id is kept;
repeated rows are rows of their own (equal rows are interchangeable); an empty
table gives no rows; further columns pass through ``mix`` untouched, names that
start with ``_mx`` are the operator's own.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, n_words, row_hash

WEIGHTS = (3, 1, 2)


def targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = 1.5, max_copies: float = 2.0) -> DataFrame:
    """(source, source_size, n, target) of rows (source, size); water-filling
    over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
    # sources saturate in the order of cap / weight; level k has the first k at their caps
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (per.withColumn("caps", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
           .withColumn("ws", F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
           .withColumn("all_w", F.sum("w").over(everything))
           .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(total_share))))
    per = per.withColumn("rate", (F.col("total") - F.col("caps")) / (F.col("all_w") - F.col("ws")))
    # the first source that its share does not saturate sets the final rate
    per = per.withColumn("rate", F.min(F.when(F.col("rate") * F.col("w") <= F.col("cap"), F.struct(
        F.col("cap") / F.col("w"), F.col("rate")))).over(everything).getField("rate"))
    target = F.least(F.col("cap"), F.coalesce(F.col("rate") * F.col("w"), F.col("cap")))
    return per.select("source", "source_size", "n", target.cast("double").alias("target"))


def _coin(seed: int, a: Column, b: Column) -> Column:
    """A number in [0, 1) from two row keys."""
    return F.pmod(F.xxhash64(F.lit(seed), a, b), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def _fold(items: Column, item: str, seed: int) -> Column:
    """Pivotal rounding along an array of struct(key, size, p) of type ``item``:
    struct(open, done) with at most one fractional item open and the rest done at p 0 or 1."""
    eps = 1e-12

    def step(acc, x):
        o = acc["open"]
        u = _coin(seed, o["key"], x["key"])
        sa, sb = o["size"].cast("double"), x["size"].cast("double")
        a, b = o["p"], x["p"]
        # words that can go from the open one to x, and from x to the open one
        give = F.least(a * sa, (F.lit(1.0) - b) * sb)
        take = F.least(b * sb, (F.lit(1.0) - a) * sa)
        moved = F.when(u * (give + take) < take, -give).otherwise(take)
        na, nb = a + moved / sa, b - moved / sb
        tidy = lambda p: F.when(p < eps, F.lit(0.0)).when(p > 1 - eps, F.lit(1.0)).otherwise(p)
        na, nb = tidy(na), tidy(nb)
        one = F.struct(o["key"].alias("key"), o["size"].alias("size"), na.alias("p"))
        two = F.struct(x["key"].alias("key"), x["size"].alias("size"), nb.alias("p"))
        whole = lambda p: (p == 0) | (p == 1)
        paired = (F.when(~whole(na), F.struct(one.alias("open"), F.concat(acc["done"], F.array(two)).alias("done")))
                  .when(~whole(nb), F.struct(two.alias("open"), F.concat(acc["done"], F.array(one)).alias("done")))
                  .otherwise(F.struct(F.lit(None).cast(item).alias("open"),
                                      F.concat(acc["done"], F.array(one, two)).alias("done"))))
        return F.when(o.isNull(), F.struct(x.alias("open"), acc["done"].alias("done"))).otherwise(paired)

    start = F.struct(F.lit(None).cast(item).alias("open"), F.array().cast(f"array<{item}>").alias("done"))
    return F.aggregate(items, start, step)


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, total_share: float = 1.5, max_copies: float = 2.0, seed: int = 7,
         fan_in: int = 32) -> DataFrame:
    """One row per document row: doc_id, _mx_hash, _mx_ord (its row key), size,
    source, source_size, target, copies (whole copies), part_words (words of a
    further part copy; 0 but for one document a source), taken."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), row_hash(docs).alias("hash"),
                        F.col(f"`{source_col}`").alias("source"), n_words(F.col(f"`{text_col}`")).alias("size"))
    keyed = keyed.withColumn("ord", F.row_number().over(Window.partitionBy("id", "hash").orderBy("hash")))
    keyed = materialize(spark, keyed, "mix-sizes")
    goals = materialize(spark, targets(keyed, weights, total_share, max_copies), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (keyed.join(goals, keyed["source"].eqNullSafe(goals["source"]))
            .select(F.struct("id", "hash", "ord").alias("key"), keyed["source"], "size", "source_size", "target", "n",
                    rate.alias("rate")))
    rows = rows.withColumn("whole", F.floor(F.col("rate") + 1e-12).cast("long"))
    rows = rows.withColumn("p", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0)))
    loose = rows.where("size > 0 and p > 1e-12")
    # level 0: about fan_in documents a group, by a hash of the row key
    groups = F.ceil(F.col("n") / F.lit(float(fan_in))).cast("long")
    most = goals.agg(F.max(groups)).first()[0] or 1
    level = loose.select("source", F.pmod(F.xxhash64(F.lit(seed), "key"), groups).alias("g"),
                         F.struct("key", "size", "p").alias("item"))
    item = level.schema["item"].dataType.simpleString()
    done = None
    for i in range(1 + max(0, math.ceil(math.log(most, fan_in) - 1e-9) if most > 1 else 0)):
        if i:
            level = level.withColumn("g", F.floor(F.col("g") / F.lit(fan_in)).cast("long"))
        folded = level.groupBy("source", "g").agg(
            _fold(F.sort_array(F.collect_list("item")), item, seed + i).alias("f"))
        folded = materialize(spark, folded, f"mix-level{i}")
        part = folded.select(F.explode("f.done").alias("d")).select("d.*")
        done = part if done is None else done.unionByName(part)
        level = folded.where("f.open is not null").select("source", "g", F.col("f.open").alias("item"))
    done = done.unionByName(level.select("item.*")).select(F.col("key").alias("k"), F.col("p").alias("q"))
    out = rows.join(done, (F.col("key.id").eqNullSafe(F.col("k.id"))) & (F.col("key.hash") == F.col("k.hash"))
                    & (F.col("key.ord") == F.col("k.ord")), "left")
    q = F.coalesce(F.col("q"), F.lit(0.0))
    out = out.withColumn("copies", F.col("whole") + (q == 1).cast("long")) \
        .withColumn("part_words", F.when((q > 0) & (q < 1), F.round(q * F.col("size")).cast("long")).otherwise(F.lit(0).cast("long")))
    return out.select(F.col("key.id").alias("doc_id"), F.col("key.hash").alias("_mx_hash"),
                      F.col("key.ord").alias("_mx_ord"), "source", "size", "source_size", "target", "copies",
                      "part_words", (F.col("copies") * F.col("size") + F.col("part_words")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The mixed corpus itself: each row as often as its copies say, and a part
    copy as the first words of its text (with a smaller n_chars where that column exists)."""
    d = plan(docs, id_col=id_col, text_col=text_col, **kw).select(
        F.col("doc_id").alias("_mx_id"), "_mx_hash", "_mx_ord", F.col("copies").alias("_mx_copies"),
        F.col("part_words").alias("_mx_part"))
    src = docs.withColumn("_mx_h", row_hash(docs))
    src = src.withColumn("_mx_o", F.row_number().over(
        Window.partitionBy(f"`{id_col}`", "_mx_h").orderBy("_mx_h")))
    both = src.join(d, F.col(f"`{id_col}`").eqNullSafe(F.col("_mx_id")) & (F.col("_mx_h") == F.col("_mx_hash"))
                    & (F.col("_mx_o") == F.col("_mx_ord")))
    # a row leaves once per copy; array_repeat of no copies drops the row
    both = both.withColumn("_mx_cut", F.explode(F.concat(
        F.array_repeat(F.lit(0).cast("long"), F.col("_mx_copies").cast("int")),
        F.array_repeat(F.col("_mx_part"), F.when(F.col("_mx_part") > 0, 1).otherwise(0)))))
    words = F.filter(F.split(F.col(f"`{text_col}`"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = F.array_join(F.slice(words, 1, F.col("_mx_cut").cast("int")), " ")
    both = both.withColumn("_mx_text", F.when(F.col("_mx_cut") > 0, cut).otherwise(F.col(f"`{text_col}`")))
    cols = []
    for c in docs.columns:
        col = F.col("_mx_text") if c == text_col else F.col(f"`{c}`")
        if c == "n_chars":
            col = F.when(F.col("_mx_cut") > 0, F.length("_mx_text").cast(docs.schema[c].dataType)).otherwise(F.col(c))
        cols.append(col.alias(c))
    return both.select(*cols)
