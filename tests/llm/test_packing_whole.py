import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medistar.llm import packing

from .helpers import frame


def test_millions_of_spaces(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {1: "before" + " " * 3_000_000 + "after <|endoftext|>", 2: "\n" * 2_000_000, 3: "short one"}
    docs = frame(spark, [(k, "", None, None, 0) for k in texts])
    text = F.when(F.col("doc_id") == 1, F.concat(F.lit("before"), F.repeat(F.lit(" "), 3_000_000), F.lit("after <|endoftext|>"))) \
        .when(F.col("doc_id") == 2, F.repeat(F.lit("\n"), 2_000_000)).otherwise(F.lit(texts[3]))
    got = packing.pack(docs.withColumn("text", text)).collect()
    for k, t in texts.items():
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in got if r.doc_id == k)
        assert sum(n for _, n, _ in pieces) == len(ids) and pieces[0][0] == 0
        for at, n, crc in pieces:
            assert zlib.crc32(ids[at:at + n].tobytes()) == crc
