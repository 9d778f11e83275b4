"""Merkle manifest of a dataset by bitmap-rank indexing.

Each row is a leaf; the leaves of a group (``lang``) stand in ascending order of
the id.  No leaf is sorted to find its place.  The ids of a group are set in a
bitmap of 64-id words (only words that hold an id exist), built per task and
merged by OR.  Popcount directories give the rows before each word: running
sums inside a page of 1,024 words, over the pages of a section of 65,536 pages,
over the sections of a region, over the regions of a group; no running sum has
more than 65,537 entries, however many rows there are.  A leaf's coordinate is
its word's base plus the popcount of the bits below its own.

Leaves then meet in keyed slot arrays, 1,024 coordinates to a block, and every
block is reduced to one node by itself; block nodes meet in the next slot
arrays, and so on up to the group's subroot; the subroots, in the order of the
groups, are the leaves of one more tree.  Proofs come back down: a block's path
is its own place in the block above plus that block's path.

A leaf is H(id, source, lang, n_chars, text), each ``-`` if null, else its
number of UTF-8 bytes, ``:`` and the value; H is the hex sha256 of the inputs
concatenated, digests as hex text.  While a level has several nodes, each two
consecutive ones, or a last one alone, become their H.

Results by case: null ids stand before all others; rows that share an id follow
each other in the order of their leaf digests, equal rows in any order (a hot id
is split by digest prefix, equal rows are counted and take a run of slots); a
null group is a group of its own, before the others; empty texts have the length
0; an empty table gives no rows; an id that is no integer raises TypeError;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medistar.operators.keys import assign_sequential_keys

from .common import importable, materialize

BITS = 10  # a block reduces this many levels
_NO_ID_PAGE = -(1 << 47) - 1  # the page of null ids: below that of any 64-bit id
_PATH = "array<string>"


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(id_: Column, source: Column, group: Column, n_chars: Column, text: Column) -> Column:
    """The leaf of a row."""
    return F.sha2(F.concat(*[_field(c) for c in (id_, source, group, n_chars, text)]).cast("binary"), 256)


def _ranked(leaves: DataFrame) -> DataFrame:
    """Distinct leaves (grp, id, leaf, other, n) with ``rank`` of their first copy in the group and its ``size``."""
    spark = leaves.sparkSession
    d = leaves.groupBy("grp", "id", "leaf", "other").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("page", F.coalesce(F.shiftright("id", 16), F.lit(_NO_ID_PAGE))) \
        .withColumn("word", F.coalesce(F.shiftright("id", 6).bitwiseAND(F.lit(1023)), F.lit(0)).cast("int")) \
        .withColumn("low", F.coalesce(F.col("id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int"))
    d = materialize(spark, d, "merkle-leaves")
    at = ["grp", "page", "word", "low"]

    # the bitmap: one long per word, OR-ed per task and then across tasks
    ids = d.groupBy(*at).agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("kinds"))
    words = ids.groupBy("grp", "page", "word").agg(
        F.expr("bit_or(shiftleft(1L, low))").alias("bits"), F.sum("m").alias("rows"),
        F.collect_list(F.when(F.col("m") > 1, F.struct("low", (F.col("m") - 1).alias("more")))).alias("copies"))
    words = materialize(spark, words, "merkle-words")

    # popcount directories: words in a page, pages in a section, sections in a region, regions in a group
    def before(df, parent, order):
        w = Window.partitionBy("grp", *parent).orderBy(order)
        return df.withColumn("before", F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows"))

    sums = lambda df, *k: df.groupBy("grp", *k).agg(F.sum("rows").alias("rows"))
    word_dir = before(words, ["page"], "word").withColumnRenamed("before", "in_page")
    pages = sums(words, "page").withColumn("section", F.shiftright("page", 16)).withColumn("region", F.shiftright("page", 32))
    page_dir = before(pages, ["section"], "page").select("grp", "page", "section", "region", F.col("before").alias("in_section"))
    sections = sums(pages, "section", "region")
    section_dir = before(sections, ["region"], "section").select("grp", "section", F.col("before").alias("in_region"))
    regions = sums(sections, "region")
    region_dir = before(regions, [], "region").withColumn("size", F.sum("rows").over(Window.partitionBy("grp"))) \
        .select("grp", "region", F.col("before").alias("in_group"), "size")
    directory = word_dir.join(page_dir, ["grp", "page"]).join(section_dir, ["grp", "section"]).join(region_dir, ["grp", "region"]) \
        .select("grp", "page", "word", "bits", "copies", "size",
                (F.col("in_page") + F.col("in_section") + F.col("in_region") + F.col("in_group")).alias("base"))

    # ids with several different leaves: their order by digest, a cell of 65,536 at a time
    several = ids.where("kinds > 1").select(*at)
    cells = d.join(several, at).withColumn("cell", F.conv(F.substring("leaf", 1, 4), 16, 10).cast("int"))
    cell_rows = cells.groupBy(*at, "cell").agg(F.sum("n").alias("rows"))
    cell_dir = cell_rows.withColumn("cell_before", F.sum("rows").over(
        Window.partitionBy(*at).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).drop("rows")
    placed = cells.withColumn("in_cell", F.sum("n").over(
        Window.partitionBy(*at, "cell").orderBy("leaf").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")) \
        .join(cell_dir, [*at, "cell"]).select(*at, "leaf", (F.col("cell_before") + F.col("in_cell")).alias("in_id"))

    below = F.when(F.col("low") == 0, F.lit(0)).otherwise(F.expr("shiftrightunsigned(-1L, 64 - low)")).cast("long")
    rank = (F.col("base") + F.bit_count(F.col("bits").bitwiseAND(below))
            + F.expr("aggregate(filter(copies, c -> c.low < low), 0L, (s, c) -> s + c.more)") + F.coalesce("in_id", F.lit(0)))
    return d.join(directory, ["grp", "page", "word"]).join(placed, [*at, "leaf"], "left") \
        .select("grp", "id", "leaf", "other", "n", rank.cast("long").alias("rank"), "size")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


def levels_of(nodes: list[str], m: int) -> list[list[str]]:
    """All levels of one block of ``nodes``, where its whole level has ``m`` nodes."""
    out = [nodes]
    for _ in range(min(BITS, (m - 1).bit_length())):
        a = out[-1]
        out.append([digest(*a[i:i + 2]) for i in range(0, len(a), 2)])
    return out


def path_in(levels: list[list[str]], slot: int) -> list[str]:
    """The siblings of a slot upward, ``L`` or ``R`` by their side, ``-`` where a node stands alone."""
    out = []
    for a in levels[:-1]:
        s = slot ^ 1
        out.append(("L" if s < slot else "R") + a[s] if s < len(a) else "-")
        slot >>= 1
    return out


def fold(node: str, path: list[str]) -> str:
    """The root that a leaf and its path give."""
    for p in path:
        node = digest(node) if p == "-" else digest(p[1:], node) if p[0] == "L" else digest(node, p[1:])
    return node


def _nodes(slots) -> list[str]:
    return [s["h"] for s in slots for _ in range(s["n"])]


def _reduce(batches):
    """(grp, block, m, slots) -> (grp, idx, m, h): the node that a block becomes."""
    for b in batches:
        out = [levels_of(_nodes(s), m)[-1][0] for m, s in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        m = pa.array([-(-x // (1 << BITS)) for x in b.column(2).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), m, pa.array(out, pa.string())], ["grp", "idx", "m", "h"])


def _descend(batches):
    """(grp, block, m, slots, path) -> (grp, idx, path): every slot's path, through its block's."""
    for b in batches:
        for grp, block, m, slots, path in zip(*[b.column(i).to_pylist() for i in range(5)]):
            lv = levels_of(_nodes(slots), m)
            idx = range(block << BITS, (block << BITS) + len(lv[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([grp] * len(idx), pa.string()), pa.array(idx, pa.int64()),
                 pa.array([path_in(lv, i) + path for i in range(len(idx))], pa.list_(pa.string()))], ["grp", "idx", "path"])


def _blocks(nodes: DataFrame) -> DataFrame:
    """Keyed slot arrays of (grp, idx, m, h)."""
    return nodes.groupBy("grp", F.shiftright("idx", BITS).alias("block"), "m").agg(F.sort_array(F.collect_list(
        F.struct(F.col("idx").bitwiseAND(F.lit((1 << BITS) - 1)).alias("slot"), F.lit(1).alias("n"), "h"))).alias("slots"))


_BLOCK_COLS = ["grp", "block", "m", "slots"]


def _climb(nodes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """((grp, h) top nodes, (grp, idx, path) of every node): (grp, idx, m, h) reduced level by level."""
    spark = nodes.sparkSession
    if most <= 1:
        return nodes.select("grp", "h"), nodes.select("grp", "idx", F.expr(f"cast(array() AS {_PATH})").alias("path"))
    blocks = materialize(spark, _blocks(nodes).select(*_BLOCK_COLS), "merkle-blocks")
    up = materialize(spark, blocks.mapInArrow(_reduce, "grp string, idx long, m long, h string"), "merkle-nodes")
    tops, paths = _climb(up, -(-most // (1 << BITS)))
    mine = blocks.join(paths.withColumnRenamed("idx", "block"), ["grp", "block"]).select(*_BLOCK_COLS, "path")
    return tops, mine.mapInArrow(_descend, f"grp string, idx long, path {_PATH}")


def _proofs(batches):
    """(block, m, slots, path, subroot, root) -> one row per leaf of the block."""
    for b in batches:
        for _, m, slots, path, subroot, root in zip(*[b.column(i).to_pylist() for i in range(6)]):
            lv = levels_of(_nodes(slots), m)
            above = {lv[-1][0]: fold(lv[-1][0], path)}  # most leaves fold into their block's own node
            cols = [[], [], [], [], [], []]
            at = 0
            for s in slots:
                for _ in range(s["n"]):
                    own = path_in(lv, at)
                    node = fold(s["other"] or s["h"], own)
                    if node not in above:
                        above[node] = fold(node, path)
                    for c, v in zip(cols, (s["id"], s["h"], subroot, root, own + path, above[node])):
                        c.append(v)
                    at += 1
            types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "leaf", "subroot", "root", "path", "folded_root"])


def manifest(docs: DataFrame, other_n_chars: Column | None = None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root) of every row.

    ``path``: the siblings from the leaf to the root, each with its side first.
    ``folded_root``: the root that the path gives for the leaf; where
    ``other_n_chars`` is not null, for the row's leaf with that count instead.
    """
    spark = docs.sparkSession
    importable(spark)
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} must hold integers")
    id_, cols = F.col(f"`{id_col}`").cast("long"), [F.col(c) for c in ("source", "lang", "n_chars", "text")]
    other = F.lit(None).cast("string") if other_n_chars is None else F.when(
        other_n_chars.isNotNull(), leaf_digest(id_, cols[0], cols[1], other_n_chars, cols[3]))
    # "" for the null group and "=" before a name keep the order of the groups
    grp = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    leaves = docs.select(grp.alias("grp"), id_.alias("id"), leaf_digest(id_, *cols).alias("leaf"), other.alias("other"))
    ranked = _ranked(leaves)
    # n copies take a run of slots, cut at block borders
    parts = ranked.withColumn("block", F.explode(F.expr(f"sequence(shiftright(rank, {BITS}), shiftright(rank + n - 1, {BITS}))"))) \
        .withColumn("slot", F.greatest(F.col("rank"), F.shiftleft("block", BITS))) \
        .withColumn("n", (F.least(F.col("rank") + F.col("n"), F.shiftleft(F.col("block") + 1, BITS)) - F.col("slot")).cast("int"))
    slots = parts.groupBy("grp", "block", F.col("size").alias("m")).agg(F.sort_array(F.collect_list(
        F.struct("slot", "n", F.col("leaf").alias("h"), "id", "other"))).alias("slots"))
    slots = materialize(spark, slots.select(*_BLOCK_COLS), "merkle-slots")
    most = slots.agg(F.max("m")).first()[0] or 0
    nodes = materialize(spark, slots.mapInArrow(_reduce, "grp string, idx long, m long, h string"), "merkle-nodes")
    tops, paths = _climb(nodes, -(-most // (1 << BITS)))
    # the groups' subroots are the leaves of the last tree
    tops = assign_sequential_keys(tops.select(F.col("grp").alias("name"), "h"), ["name"], 0, "key")
    tops = materialize(spark, tops.select("name", "h", (F.col("key") - 1).alias("idx")), "merkle-subroots")
    many = tops.count()
    roots, last = _climb(tops.select(F.lit("").alias("grp"), "idx", F.lit(many).cast("long").alias("m"), "h"), many)
    top = roots.first()  # the one root
    ends = tops.join(last.select("idx", F.col("path").alias("last_path")), "idx").select(
        F.col("name").alias("grp"), F.col("h").alias("subroot"), F.lit(top.h if top else None).alias("root"), "last_path")
    ways = paths.join(ends, "grp").select("grp", F.col("idx").alias("block"), F.concat("path", "last_path").alias("path"),
                                          "subroot", "root")
    whole = slots.join(ways, ["grp", "block"]).select("block", "m", "slots", "path", "subroot", "root")
    return whole.mapInArrow(_proofs, f"doc_id long, leaf string, subroot string, root string, path {_PATH}, folded_root string")


def proof_digest(path: Column) -> Column:
    """H of the siblings of a path."""
    siblings = F.transform(F.filter(path, lambda x: x != F.lit("-")), lambda x: F.substring(x, 2, 64))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)
