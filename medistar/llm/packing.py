"""Packing: bounded-space online best-fit of token pieces into windows.

Every partition streams its documents once.  A document is tokenised whole and
ends with id 0; runs of a full window leave as sequences of their own, the tail
is placed into the open window it fits best.  At most ``open_windows`` windows
are open; when none fits, the fullest one is emitted (a gap above ``cut_gap``
ids is first filled by a cut of the incoming piece).  The open windows left at
the end of each partition are merged, ``fan_in`` partitions at a time, in a
tree of grouped tasks: whole pieces best-fit first, then cuts until at most one
window of a group is not full, which goes up the tree.

Results by case: null text is an empty text, i.e. the one id 0; empty tables
give no rows; repeated rows are packed once each; null ids are kept; columns
besides the id and the text are ignored, whatever their names.  Ties between
windows go to the one opened first.  A text that the compiled encoder cannot
take (a million spaces on end) is encoded by the tokenizer of the same
vocabulary; with a ``vocabulary`` of the caller's it is an error.  Texts may be of any length: memory of a
task is one document's ids and the open windows.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, materialize

END_ID = 0
_ENCODERS: dict = {}


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, special: tuple = (("<|endoftext|>", 50256),)):
    """The byte-level BPE as a compiled encoder, once per worker process."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                            special_tokens=dict(special))
    return _ENCODERS[path]


def tokenizer(path: str):
    """The same vocabulary's tokenizer, once per worker process."""
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        _ENCODERS[path] = Tokenizer.from_file(path)
    return _ENCODERS[path]


def encode(enc, text: str | None, whole: str | None = None) -> np.ndarray:
    """All ids of a text (special tokens' strings as special ids), then the end id.

    The encoder's pattern gives up on a very long run of white space; such a
    text is encoded whole by the tokenizer at ``whole``."""
    try:
        ids = np.asarray(enc.encode_to_numpy(text, allowed_special="all"), dtype=np.int32) if text else np.zeros(0, np.int32)
    except ValueError:
        if whole is None:
            raise
        ids = np.asarray(tokenizer(whole).encode(text, add_special_tokens=False).ids, dtype=np.int32)
    return np.append(ids, np.int32(END_ID))


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


class _Window:
    __slots__ = ("fill", "pieces")

    def __init__(self):
        self.fill, self.pieces = 0, []

    def add(self, piece):
        self.pieces.append(piece)
        self.fill += len(piece[2])


class _Online:
    """The open windows of one partition; a piece is (id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, most: int, cut_gap: int):
        self.capacity, self.most, self.cut_gap = capacity, most, cut_gap
        self.open: list[_Window] = []

    def document(self, key, ids):
        """Place one document; yields the windows that are done."""
        n, at = len(ids), 0
        while n - at >= self.capacity:
            w = _Window()
            w.add((key, at, ids[at: at + self.capacity], n))
            at += self.capacity
            yield w
        if at < n:
            yield from self.place((key, at, ids[at:].copy(), n))

    def place(self, piece):
        need, best = len(piece[2]), None
        for w in self.open:
            if w.fill + need <= self.capacity and (best is None or w.fill > best.fill):
                best = w
        if best is None and len(self.open) >= self.most:
            fullest = max(self.open, key=lambda w: w.fill)
            self.open.remove(fullest)
            gap = self.capacity - fullest.fill
            if gap > self.cut_gap:
                key, at, ids, n = piece
                fullest.add((key, at, ids[:gap], n))
                yield fullest
                yield from self.place((key, at + gap, ids[gap:], n))
                return
            yield fullest
        if best is None:
            best = _Window()
            self.open.append(best)
        best.add(piece)
        if best.fill == self.capacity:
            self.open.remove(best)
            yield best


def merge_windows(pieces: list[tuple], capacity: int) -> list[_Window]:
    """Pieces of many open windows into windows that are all full but one (the last)."""
    windows: list[_Window] = []
    by_fill: list[list[_Window]] = [[] for _ in range(capacity + 1)]
    for p in sorted(pieces, key=lambda p: -len(p[2])):
        need = len(p[2])
        w = next((by_fill[f].pop() for f in range(capacity - need, 0, -1) if by_fill[f]), None)
        if w is None:
            w = _Window()
            windows.append(w)
        w.add(p)
        by_fill[w.fill].append(w)
    full = [w for w in windows if w.fill == capacity]
    part = sorted((w for w in windows if w.fill < capacity), key=lambda w: w.fill)
    while len(part) > 1:
        w, source = part[-1], part[0]
        key, at, ids, n = source.pieces.pop()
        source.fill -= len(ids)
        gap = capacity - w.fill
        w.add((key, at, ids[:gap], n))
        if len(ids) > gap:
            source.add((key, at + gap, ids[gap:], n))
        if not source.pieces:
            part.pop(0)
        if w.fill == capacity:
            full.append(w)
            part.remove(w)
    return full + part


def _schema(id_type: T.DataType) -> T.StructType:
    long = T.LongType()
    return T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", long), T.StructField("length", long),
        T.StructField("ids_crc32", long), T.StructField("doc_tokens", long), T.StructField("sequence_id", long),
        T.StructField("offset", long), T.StructField("sequence_length", long), T.StructField("ids", T.BinaryType()),
        T.StructField("_part", long), T.StructField("_open", T.BooleanType())])


class _Rows:
    """Collects output rows and hands them over as Arrow batches."""

    def __init__(self, schema: pa.Schema, emit_ids: bool, per_batch: int = 4000):
        self.schema, self.emit_ids, self.per_batch = schema, emit_ids, per_batch
        self.cols = [[] for _ in schema]

    def window(self, w: _Window, sequence: int, part: int, is_open: bool):
        offset = 0
        for key, at, ids, n in w.pieces:
            raw = np.ascontiguousarray(ids, dtype="<u4").tobytes()
            for c, v in zip(self.cols, (key, at, len(ids), zlib.crc32(raw), n, sequence, offset, w.fill,
                                        raw if self.emit_ids or is_open else None, part, is_open)):
                c.append(v)
            offset += len(ids)

    def batch(self, last: bool = False):
        if self.cols[0] and (last or len(self.cols[0]) >= self.per_batch):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.cols, self.schema)],
                                             schema=self.schema)
            self.cols = [[] for _ in self.schema]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         open_windows: int = 32, cut_gap: int = 8, fan_in: int = 64, vocabulary: str | None = None,
         emit_ids: bool = True) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` ids.

    One row per piece: doc_id, start, length, ids_crc32 (unsigned, over the
    little-endian 32-bit ids), doc_tokens, sequence_id, offset, sequence_length,
    ids (those 32-bit ids as binary; null for closed windows if not ``emit_ids``).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    importable(spark)
    path = vocabulary or vocabulary_path()
    whole = None if vocabulary else vocabulary_path("byte_bpe_50k.json")
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = _schema(src.schema["doc_id"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches):
        enc, part = encoder(path), TaskContext.get().partitionId()
        online, rows, made = _Online(capacity, open_windows, cut_gap), _Rows(arrow, emit_ids), 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                for w in online.document(key, encode(enc, text.as_py(), whole)):
                    rows.window(w, (part << 33) + made, part, False)
                    made += 1
                yield from rows.batch()
        for w in online.open:
            rows.window(w, (part << 33) + made, part, True)
            made += 1
        yield from rows.batch(last=True)

    placed = materialize(spark, src.mapInArrow(run, schema), "pack")
    done, rest, level = placed.where("not _open"), placed.where("_open"), 0
    parts = rest.agg(F.max("_part")).first()[0]
    while parts is not None:
        level += 1
        parts = parts // fan_in
        merged = rest.withColumn("_part", F.floor(F.col("_part") / F.lit(fan_in)).cast("long")).groupBy("_part") \
            .applyInPandas(_merger(schema, capacity, level, parts == 0, emit_ids), schema)
        merged = materialize(spark, merged, "pack-merge")
        done = done.unionByName(merged.where("not _open"))
        rest = merged.where("_open")
        if parts == 0:
            break
    return done.drop("_part", "_open")


def _merger(schema: T.StructType, capacity: int, level: int, top: bool, emit_ids: bool):
    names = schema.names

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["_part"].iloc[0])
        pdf = pdf.sort_values(["sequence_id", "offset"])
        pieces = [(k, int(s), np.frombuffer(b, dtype="<u4"), int(n))
                  for k, s, b, n in zip(pdf["doc_id"], pdf["start"], pdf["ids"], pdf["doc_tokens"])]
        out = []
        for i, w in enumerate(merge_windows(pieces, capacity)):
            is_open, offset = w.fill < capacity and not top, 0
            sequence = (1 << 62) + (level << 56) + (part << 20) + i
            for key, at, ids, n in w.pieces:
                raw = np.ascontiguousarray(ids, dtype="<u4").tobytes()
                out.append((key, at, len(ids), zlib.crc32(raw), n, sequence, offset, w.fill,
                            raw if emit_ids or is_open else None, part, is_open))
                offset += len(ids)
        res = pd.DataFrame(out, columns=names)
        res["doc_id"] = pd.Series([r[0] for r in out], dtype=pdf["doc_id"].dtype if pdf["doc_id"].notna().all() else object)
        return res

    return merge
