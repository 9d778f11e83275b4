"""Conversation structure repair by Knuth's lightest-derivation agenda.

The roles' initials of a repaired conversation read ``(s?(ua)+)?``.  An item
(i, q) says that the first i rows are dealt with and the kept initials have
led to state q; its value is (cost, audit), the edits' initials so far.  Each
edit is a deduction from one item to the next:

    Keep     cost 0, a row whose initial fits             K
    Rerole   cost 3, to the role that fits                R
    Insert   cost 3, an empty text of the role that fits  I
    Delete   cost 4, required for blank and duplicate     D

and a truncated row that is not deleted adds 3.  The agenda pops the item of
least (cost, rows dealt with, audit).  Every deduction adds cost or a row, so
values only rise along it, and appending the same edits keeps two values of one
item in order (of two audits of equal cost for the same rows none begins the
other): the functions are monotone and superior, an item popped is final, and
the goal item's audit is the cheapest, ties ASCII-least.

Rows stream through a task in the order of their turns, ``block`` rows at a
time: the four items after a block are the axioms of the next.  Audits are
compared by short stand-ins that keep their order, and each item carries its own
running digest of the repaired text, so a conversation of any length needs one
block of rows and four audits in memory.  The digest chains over the whole
conversation, which ties one conversation to one task by definition; all else
is spread.

Results by case: nulls read as one space; rows of one turn stand in the order of
role and text, null turns first; a null conv_id is a conversation of its own;
roles with another initial are reroled or deleted; repeated rows are duplicates;
a conversation without rows has zeros, an empty audit and the empty digest; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import importable

_SPACE = " \t\n\v\f\r"
# states: 0 nothing kept, 1 after system, 2 after user, 3 after assistant
_KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_GOAL = (0, 3)
FINE, TRUNCATED, VOID = "012"


@lru_cache(maxsize=1 << 16)
def lightest(axioms: tuple, rows: str, last: bool) -> tuple:
    """Final items after ``rows``: (state, cost, axiom it came from, edits in the block), the goal item
    alone in the ``last`` block.

    ``axioms``: (state, cost, stand-in of the audit); ``rows``: two characters a row, initial and class.
    """
    n = len(rows) // 2
    agenda = [(cost, 0, standin, q, k, 0) for k, (q, cost, standin) in enumerate(axioms)]
    heapq.heapify(agenda)
    done, out = set(), []
    while agenda:
        cost, i, audit, q, axiom, length = heapq.heappop(agenda)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == n and (not last or q in _GOAL):
            out.append((q, cost, axiom, audit[len(audit) - length:] if length else ""))
            if last or len(out) == 4:
                break
        heapq.heappush(agenda, (cost + 3, i, audit + "I", _NEXT[q][1], axiom, length + 1))
        if i < n:
            initial, kind = rows[2 * i], rows[2 * i + 1]
            if kind != VOID:
                more = 3 if kind == TRUNCATED else 0
                if (initial, q) in _KEEP:
                    heapq.heappush(agenda, (cost + more, i + 1, audit + "K", _KEEP[initial, q], axiom, length + 1))
                heapq.heappush(agenda, (cost + more + 3, i + 1, audit + "R", _NEXT[q][1], axiom, length + 1))
            heapq.heappush(agenda, (cost + 4, i + 1, audit + "D", q, axiom, length + 1))
    return tuple(out)


def standins(audits: list[str]) -> list[str]:
    """Short strings in the order of ``audits``, also after any strings are appended to both alike:
    the characters where they part, and what one has beyond another that ends."""
    out = [""] * len(audits)

    def walk(group, at):
        if len(group) < 2:
            return
        at += len(os.path.commonprefix([audits[g][at:] for g in group]))
        if any(len(audits[g]) == at for g in group):
            for g in group:
                out[g] += audits[g][at:]
            return
        for ch in {audits[g][at] for g in group}:
            mine = [g for g in group if audits[g][at] == ch]
            for g in mine:
                out[g] += ch
            walk(mine, at + 1)
    walk(range(len(audits)), 0)
    return out


def edited(edits: str, rows, state: int):
    """The rows (role, text, edit) that ``edits`` make of ``rows`` (role, text) from a state on."""
    rows = iter(rows)
    for e in edits:
        if e == "I":
            role, state = _NEXT[state]
            yield role, "", e
            continue
        role, text = next(rows)
        if e == "K":
            state = _KEEP[role[:1], state]
            yield role, text, e
        elif e == "R":
            role, state = _NEXT[state]
            yield role, text, e


class Conversation:
    """One conversation as its rows stream by."""

    def __init__(self, block: int, block_chars: int):
        self.block, self.block_chars = block, block_chars
        self.rows, self.signs, self.chars = [], [], 0
        self.items = [(0, 0, "", None, hashlib.sha256())]  # state, cost, stand-in, audit as a chain, digest
        self.low = self.high = self.before = self.previous = self.initial = None
        self.turns = self.illegal = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}

    def feed(self, turn, role: str, text: str, earlier: bool) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        core = text.strip(_SPACE)
        kind = VOID
        if not core:
            self.faults["blank"] += 1
        elif earlier or self.previous == (turn, role, text):
            self.faults["duplicate"] += 1
        elif core[-1] not in ".!?":
            self.faults["truncated"] += 1
            kind = TRUNCATED
        else:
            kind = FINE
        self.previous = (turn, role, text)
        self.rows.append((role, text))
        self.signs.append((initial if initial in ("s", "u", "a") else "?") + kind)
        self.chars += len(text)
        if len(self.rows) == self.block or self.chars > self.block_chars:
            self._advance(False)

    def _advance(self, last: bool) -> None:
        least = min(x[1] for x in self.items)
        axioms = tuple((q, cost - least, standin) for q, cost, standin, _, _ in self.items)
        items = []
        for q, cost, axiom, edits in lightest(axioms, "".join(self.signs), last):
            state, _, _, chain, digest = self.items[axiom]
            digest, any_kept = digest.copy(), state != 0
            for role, text, _ in edited(edits, self.rows, state):
                digest.update((("\n" if any_kept else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
                any_kept = True
            items.append((q, cost + least, axioms[axiom][2] + edits, (chain, edits), digest))
        self.items = [(q, cost, s, chain, d) for (q, cost, _, chain, d), s in zip(items, standins([x[2] for x in items]))]
        self.rows, self.signs, self.chars = [], [], 0

    def result(self) -> tuple:
        self._advance(True)
        _, cost, _, chain, digest = self.items[0]
        audit = []
        while chain:
            chain, edits = chain
            audit.append(edits)
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return (gaps, self.faults["blank"], self.faults["duplicate"], self.faults["truncated"], self.illegal, cost,
                "".join(reversed(audit)), digest.hexdigest())


_COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2


def _repair(block, block_chars):
    """Sorted rows (conv_id, turn, role, text, earlier, copies) -> one row a conversation."""
    def go(batches):
        key, now, id_type, out = None, None, None, []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [id_type, *_TYPES])], _COLUMNS)

        for b in batches:
            id_type = b.schema.field(0).type
            for conv, turn, role, text, earlier, copies in zip(*[c.to_pylist() for c in b.columns]):
                if now is None or conv != key:
                    if now is not None:
                        out.append((key, *now.result()))
                    key, now = conv, Conversation(block, block_chars)
                for _ in range(copies):
                    now.feed(turn, role, text, earlier)
            if len(out) > 1000:
                yield flush()
                out.clear()
        if now is not None:
            out.append((key, *now.result()))
            yield flush()
    return go


def _in_order(convs: DataFrame, copies: Column | None) -> DataFrame:
    """(conv_id, turn, role, text, earlier, copies), a conversation in one partition, by turn, role and text.
    ``earlier``: the same role and text stands at an earlier turn."""
    rows = convs.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"),
                        (F.lit(1) if copies is None else copies).cast("int").alias("copies")) \
        .withColumn("print", F.md5("text"))
    # counts meet per task before the shuffle; only what recurs at several turns is joined back
    seen = rows.where("copies > 0").groupBy("conv_id", "role", "print").agg(
        F.min("turn").alias("first"), F.max("turn").alias("final"),
        (F.count("turn") < F.count(F.lit(1))).alias("unturned"))
    seen = seen.where("first < final or (unturned and first is not null)").select(
        F.col("conv_id").alias("c2"), F.col("role").alias("r2"), F.col("print").alias("p2"), "first", "unturned")
    on = (F.col("conv_id").eqNullSafe(F.col("c2"))) & (F.col("role") == F.col("r2")) & (F.col("print") == F.col("p2"))
    earlier = F.coalesce(F.col("unturned") & F.col("turn").isNotNull() | (F.col("turn") > F.col("first")), F.lit(False))
    return rows.join(seen, on, "left").select("conv_id", "turn", "role", "text", earlier.alias("earlier"), "copies") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair(convs: DataFrame, copies: Column | None = None, block: int = 512, block_chars: int = 8 << 20) -> DataFrame:
    """One row per conversation: its faults, the cost and initials of the cheapest edits, the digest of the
    repaired rows (``role:text``, joined by newlines).  ``copies``: how often a row of ``convs`` stands (none: once;
    0: only its conversation is known)."""
    importable(convs.sparkSession)
    id_type = convs.schema["conv_id"].dataType.simpleString()
    return _in_order(convs, copies).mapInArrow(
        _repair(block, block_chars), f"conv_id {id_type}, " + ", ".join(f"{c} long" for c in _COLUMNS[1:7])
        + ", audit string, repaired_sha256 string")


def _apply(batches):
    """Rows in order, each conversation led by its audit (text of a row with copies = -1) -> repaired rows."""
    audit, at, state, seq = "", 0, 0, 0
    for b in batches:
        out = []
        for conv, _, role, text, _, copies in zip(*[c.to_pylist() for c in b.columns]):
            if copies < 0:
                audit, at, state, seq = text, 0, 0, 0
            own = [(role, text)] * max(copies, 0)
            end = at
            while end < len(audit) and (audit[end] == "I" or own):
                if audit[end] != "I":
                    own.pop()
                end += 1
            for r, t, e in edited(audit[at:end], [(role, text)] * max(copies, 0), state):
                state = {"s": 1, "u": 2, "a": 3}[r[0]]
                out.append((conv, seq, r, t, e))
                seq += 1
            at = end
        if out:
            types = [b.schema.field(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["conv_id", "seq", "role", "text", "edit"])


def repaired(convs: DataFrame, repairs: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired rows (conv_id, seq, role, text, edit) that the audits of ``repairs`` make of ``convs``."""
    importable(convs.sparkSession)
    lead = repairs.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                          F.col("audit").alias("text"), F.lit(False).alias("earlier"), F.lit(-1).alias("copies"))
    rows = _in_order(convs, copies).unionByName(lead).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("copies") >= 0, "turn", "role", "text")
    id_type = convs.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(_apply, f"conv_id {id_type}, seq long, role string, text string, edit string")


def damage(convs: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations damaged by crc32(``conv_id:turn``) % 20 (0 drops a row, 1 empties its text, 2 removes
    its stops, 3 repeats it, 4 sets role user; nulls read as one space), and the rows' copies."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    d = convs.select("conv_id", "turn", kind.alias("kind"),
                     F.when(kind == 4, F.lit("user")).otherwise(text("role")).alias("role"),
                     F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text("text"), "[.!?]", ""))
                     .otherwise(text("text")).alias("text"))
    return d, F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
