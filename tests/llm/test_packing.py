import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from medistar.llm import packing

from .helpers import corpus, empty, frame


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


def test_every_id_in_exactly_one_piece(spark, tokenizer):
    rows = corpus() + [(900, "a <|endoftext|> b <|endoftext|>", None, None, None), (901, "x" * 5000, None, None, None),
                       (902, "é你\U0001f600    it's 12345", None, None, None)]
    docs = frame(spark, rows, 5).selectExpr("*", "'x' AS length", "1 AS sequence_id", "2 AS _open")
    got = packing.pack(docs, capacity=256, open_windows=4, fan_in=2).collect()
    by = {}
    for r in got:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for key in {r[0] for r in rows}:
        texts = [r[1] for r in rows if r[0] == key]
        ids = expected(tokenizer, texts[0])
        pieces = by[key, len(ids)]
        # a repeated row is packed again: each start occurs once per copy
        cover = np.zeros(len(ids), dtype=int)
        for p in pieces:
            part = ids[p.start:p.start + p.length]
            assert zlib.crc32(part.tobytes()) == p.ids_crc32 and bytes(p.ids) == part.tobytes()
            cover[p.start:p.start + p.length] += 1
        assert (cover == len(texts)).all()
    padding = 0
    for s in {r.sequence_id for r in got}:
        at = 0
        for p in sorted((r for r in got if r.sequence_id == s), key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert 0 < at <= 256 and all(r.sequence_length == at for r in got if r.sequence_id == s)
        padding += 0 if at & (at - 1) == 0 else 256 - at
    assert padding < 0.05 * sum(r.length for r in got) + 256


def test_closed_windows_need_not_carry_ids(spark):
    got = packing.pack(frame(spark, corpus()), capacity=128, emit_ids=False)
    assert got.where("ids is not null").count() == 0 and got.count() > 0
    assert packing.pack(empty(spark)).count() == 0


def test_merge_leaves_one_window_open():
    rnd = np.random.default_rng(3)
    pieces = [(i, 0, np.arange(n, dtype="<u4"), n) for i, n in enumerate(rnd.integers(1, 100, 200))]
    windows = packing.merge_windows(pieces, 100)
    assert sum(w.fill < 100 for w in windows) <= 1
    got = {}
    for w in windows:
        assert w.fill == sum(len(p[2]) for p in w.pieces) <= 100
        for k, at, ids, n in w.pieces:
            got.setdefault(k, []).append((at, ids.tolist()))
    for k, at, ids, n in pieces:
        assert [x for _, part in sorted(got[k]) for x in part] == list(range(n))


def test_online_best_fit_and_bound():
    o = packing._Online(100, 2, 8)
    done = []
    for i, n in enumerate([60, 50, 38, 45, 97, 10]):
        done += list(o.document(i, np.zeros(n, dtype=np.int32)))
        assert len(o.open) <= 2
    assert [p[0] for p in done[0].pieces] == [0, 2] and done[0].fill == 98  # gap of 2 is left
