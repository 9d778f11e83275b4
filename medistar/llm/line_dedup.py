"""Line dedup by a log-template tree, JVM only.

Every line is parsed down a tree of fixed depth: its token count, then its first
``leading`` tokens, with tokens that hold a digit generalised to a wildcard.  In
a leaf, the template is the majority (by documents) of each of at most
``segments`` runs of the remaining tokens; a line belongs to it if at least
``similar`` of its runs agree, which generalises the fields that vary.  Of the
lines left over, groups that share enough runs give the leaf's further templates,
in rounds until none of them recurs.  Other lines are templates of their own
(their generalised tokens).  Lines of at most ``leading`` tokens have no runs and
are such templates too; if all their tokens hold digits, their tokens stay as
they are.  A template that recurs in ``min_docs`` or more documents is dropped
everywhere but in the document with the smallest id.

Only hashes and counts of lines are shuffled, combined map-side, so a line that
a third of all documents share is one row per task; texts meet their decisions
in one join.

Results by case: null texts stay null, empty texts empty; blank lines and lines
of fewer than ``min_tokens`` tokens are never dropped; ties between majorities
go to the smaller hash; rows that share an id are one document; a null id counts
as a document larger than any other; an empty table gives no rows; other columns pass
through untouched, names that start with ``_ld`` are the operator's own.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_hash

WILDCARD = "<*>"


def _lines(docs: DataFrame, id_col: str, text_col: str, leading: int, segments: int, min_tokens: int) -> DataFrame:
    """(id, h, pos, leaf, line, seg) of every line; leaf is null for lines that are never dropped."""
    one = docs.where(F.col(f"`{text_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), row_hash(docs).alias("h"),
        F.posexplode(F.split(F.col(f"`{text_col}`").cast("string"), "\n")).alias("pos", "line"))
    words = F.split(F.btrim("line", F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    # few lines hold a digit: only those are looked at token by token
    toks = F.when(F.col("line").rlike("[0-9]"), F.transform(
        words, lambda t: F.when(t.rlike("[0-9]"), F.lit(WILDCARD)).otherwise(t))).otherwise(words)
    # a short line of nothing but wildcards would have nothing that recurs: it stands for itself
    bare = (F.size(words) <= F.lit(leading)) & F.forall(toks, lambda t: t == F.lit(WILDCARD))
    one = one.select("id", "h", "pos", F.when(bare, words).otherwise(toks).alias("t"))
    kept = (F.size("t") >= F.lit(min_tokens)) & (F.element_at("t", 1) != F.lit(""))
    long_enough = kept & (F.size("t") > F.lit(leading))
    rest = F.size("t") - F.lit(leading)
    n = F.least(rest, F.lit(segments))
    cut = lambda j: F.floor(j * rest / n).cast("int")
    seg = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.xxhash64(
        F.slice("t", cut(j) + F.lit(leading + 1), cut(j + 1) - cut(j))))
    return one.select("id", "h", "pos",
                      F.when(kept, F.xxhash64(F.size("t"), F.slice("t", 1, leading))).alias("leaf"),
                      F.xxhash64("t").alias("line"), F.when(long_enough, seg).alias("seg"))


def _recurring(lines: DataFrame, members: DataFrame, by: str, min_docs: int) -> DataFrame:
    """(by, weight, kinds, keeper) of the groups of members that stand in ``min_docs`` documents."""
    groups = members.groupBy(by).agg(
        F.sum("docs").alias("weight"), F.count(F.lit(1)).alias("kinds"), F.min("keeper").alias("keeper"),
        F.max("last").alias("last"), F.max("none").alias("none")).where(F.col("weight") >= min_docs)
    if min_docs > 1:  # lines of one document only don't recur
        groups = groups.where((F.col("keeper") != F.col("last")) | (F.col("none") & F.col("keeper").isNotNull()))
    if min_docs > 2:
        # weight counts a document once per line: count the documents themselves
        found = lines.select("leaf", "line", "id").join(members.select(by, "leaf", "line").join(groups.select(by), by), ["leaf", "line"]) \
            .groupBy(by, "id").agg(F.lit(1).alias("one")).groupBy(by).agg(F.count(F.lit(1)).alias("found"))
        groups = groups.join(found.where(F.col("found") >= min_docs).select(by), by)
    return groups.select(by, "weight", "kinds", "keeper")


def _majority(members: DataFrame, by: str, runs: list[str]) -> DataFrame:
    """(by, major) of groups of lines: by position, the run that most documents have."""
    return members.select(by, "docs", F.posexplode(F.array(*runs)).alias("j", "s")).where("s is not null") \
        .groupBy(by, "j", "s").agg(F.sum("docs").alias("docs")) \
        .groupBy(by, "j").agg(F.max_by("s", F.struct(F.col("docs"), -F.col("s").cast("decimal(20,0)"))).alias("s")) \
        .groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("j", "s"))).alias("major"))


def _choices(n, values: list, segments: int, similar: float):
    """The hashes of all choices, among n runs, of as many as must agree; null values are in none."""
    per = []
    for size in range(1, segments + 1):
        need = next(k for k in range(size + 1) if k >= similar * size)
        per.append(F.array(*[F.array(*[F.lit(p) for p in c]).cast("array<int>") for c in combinations(range(size), need)]))
    v = F.array(*values)
    keys = F.transform(F.get(F.array(*per), n - 1), lambda c: F.when(
        F.forall(c, lambda p: F.get(v, p).isNotNull()), F.xxhash64("leaf", c, F.transform(c, lambda p: F.get(v, p)))))
    return F.filter(keys, lambda k: k.isNotNull())


def _further(lines: DataFrame, left: DataFrame, runs: list[str], similar: float, min_docs: int) -> DataFrame | None:
    """(leaf, line, keeper) of further templates among the lines left over, None if there is none.

    Lines that share a choice of enough runs are found by its hash.  Each line
    goes to its choice of most documents; the majorities of those groups are the
    templates, and a line belongs to the largest one it is similar to.  The
    choice of most documents in a leaf always gives a template, so each round
    settles some lines."""
    spark, segments = lines.sparkSession, len(runs)
    size = sum((F.col(c).isNotNull().cast("int") for c in runs), F.lit(0))
    segs = left.select("leaf", "line", F.posexplode(F.array(*runs)).alias("j", "s")).where("s is not null")
    shared = segs.groupBy("leaf", "j", "s").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").drop("kinds")
    have = segs.join(shared, ["leaf", "j", "s"]).groupBy("leaf", "line").agg(
        *[F.max(F.when(F.col("j") == j, F.col("s"))).alias(f"v{j}") for j in range(segments)])
    keys = left.select("leaf", "line", "docs", "keeper", "last", "none", size.alias("n")).join(have, ["leaf", "line"]) \
        .select("leaf", "line", "docs", "keeper", "last", "none",
                F.explode(_choices(F.col("n"), [F.col(f"v{j}") for j in range(segments)], segments, similar)).alias("key"))
    keys = materialize(spark, keys, "lines-keys")
    good = _recurring(lines, keys, "key", min_docs).where("kinds > 1").select("key", "weight")
    pick = keys.select("leaf", "line", "key").join(good, "key").groupBy("leaf", "line").agg(F.max(F.struct("weight", "key"))["key"].alias("grp"))
    members = materialize(spark, left.join(pick, ["leaf", "line"]), "lines-groups")
    if not members.head(1):
        return None
    # groups of one leaf with the same majorities are one template
    tpl = members.select("grp", "leaf").distinct().join(_majority(members, "grp", runs), "grp") \
        .withColumn("tpl", F.xxhash64("leaf", F.array(*[F.col("major")[j] for j in range(segments)])))
    tpl = materialize(spark, tpl, "lines-templates")
    large = _recurring(lines, members.join(tpl.select("grp", "tpl"), "grp"), "tpl", min_docs).select("tpl", "weight")
    asked = tpl.groupBy("tpl", "leaf").agg(F.first("major").alias("major")).join(large, "tpl") \
        .select("tpl", "weight", F.explode(_choices(F.size("major"), [F.col("major")[j] for j in range(segments)], segments, similar)).alias("key"))
    best = keys.select("leaf", "line", "key").join(asked, "key").groupBy("leaf", "line").agg(F.max(F.struct("weight", "tpl"))["tpl"].alias("tpl"))
    members = materialize(spark, left.select("leaf", "line", "docs", "keeper", "last", "none").join(best, ["leaf", "line"]), "lines-members")
    return members.select("leaf", "line", "tpl").join(_recurring(lines, members, "tpl", min_docs), "tpl").select("leaf", "line", "keeper")


def templates(lines: DataFrame, segments: int, similar: float, min_docs: int) -> DataFrame:
    """(leaf, line, keeper) of the lines whose template recurs; keeper is the id of
    the document that keeps it."""
    spark = lines.sparkSession
    # a document counts once per distinct line
    per_doc = lines.where("leaf is not null").groupBy("leaf", "line", "id").agg(F.lit(1).alias("one"))
    kinds = materialize(spark, per_doc.groupBy("leaf", "line").agg(
        F.count(F.lit(1)).alias("docs"), F.min("id").alias("keeper"), F.max("id").alias("last"),
        F.max(F.col("id").isNull()).alias("none")), "lines-kinds")
    # only leaves with several lines, in enough documents, have anything to generalise
    leaves = kinds.groupBy("leaf").agg(F.count(F.lit(1)).alias("kinds"), F.sum("docs").alias("all")) \
        .where((F.col("kinds") > 1) & (F.col("all") >= min_docs)).select("leaf")
    runs = [f"s{j}" for j in range(segments)]
    # one row per distinct line before any join, so a line or leaf that many documents share is not one task's
    each = lines.where("leaf is not null").groupBy("leaf", "line").agg(
        *[F.min(F.get("seg", F.lit(j))).alias(c) for j, c in enumerate(runs)])
    left = materialize(spark, each.join(kinds.join(leaves, "leaf"), ["leaf", "line"]), "lines-mixed")
    agree = sum((F.coalesce((F.col(c) == F.col("major")[j]).cast("int"), F.lit(0)) for j, c in enumerate(runs)), F.lit(0))
    n = sum((F.col(c).isNotNull().cast("int") for c in runs), F.lit(0))
    general = left.join(_majority(left, "leaf", runs), "leaf").where(agree >= F.lit(similar) * n) \
        .select("leaf", "line", "docs", "keeper", "last", "none")
    new = general.select("leaf", "line").join(_recurring(lines, general, "leaf", min_docs), "leaf").select("leaf", "line", "keeper")
    known = None
    while new is not None:
        new = materialize(spark, new, "lines-known")
        known = new if known is None else known.unionByName(new)
        left = materialize(spark, left.join(new, ["leaf", "line"], "left_anti"), "lines-left")
        new = _further(lines, left, runs, similar, min_docs)
    alone = kinds.where(F.col("docs") >= min_docs).join(known, ["leaf", "line"], "left_anti").select("leaf", "line", "keeper")
    return alone.unionByName(known)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leading: int = 3, segments: int = 8,
          similar: float = 0.6, min_docs: int = 3, min_tokens: int = 4) -> DataFrame:
    """docs' columns with the text less its dropped lines, and _ld_lines and
    _ld_dropped, the numbers of its lines and of those dropped."""
    spark = docs.sparkSession
    lines = materialize(spark, _lines(docs, id_col, text_col, leading, segments, min_tokens), "lines")
    known = templates(lines, segments, similar, min_docs)
    drop = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    known = materialize(spark, known, "lines-known")
    flags = lines.select("id", "h", "pos", "leaf", "line").join(known, ["leaf", "line"], "left") \
        .groupBy(F.col("id").alias("_ld_id"), F.col("h").alias("_ld_h")) \
        .agg(F.transform(F.sort_array(F.collect_set(F.struct("pos", drop.alias("drop")))), lambda x: x["drop"]).alias("_ld_drop"))
    flags = flags.where(F.exists("_ld_drop", lambda x: x))
    src = docs.withColumn("_ld_key", row_hash(docs))
    both = src.join(flags, F.col(f"`{id_col}`").eqNullSafe(F.col("_ld_id")) & (F.col("_ld_key") == F.col("_ld_h")), "left")
    text = F.col(f"`{text_col}`").cast("string")
    parts = F.split(text, "\n")
    kept = F.when(F.col("_ld_drop").isNull(), text).otherwise(
        F.array_join(F.filter(parts, lambda x, i: ~F.get("_ld_drop", i)), "\n"))
    dropped = F.coalesce(F.size(F.filter("_ld_drop", lambda x: x)), F.lit(0))
    n_lines = F.coalesce(F.size(parts), F.lit(0))
    return both.select(*[(kept if c == text_col else F.col(f"`{c}`")).alias(c) for c in docs.columns],
                       F.when(text.isNull(), 0).otherwise(n_lines).cast("long").alias("_ld_lines"),
                       F.greatest(dropped, F.lit(0)).cast("long").alias("_ld_dropped"))
