"""Small document fixtures with the awkward rows every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def corpus(n=60, seed=5, vocabulary=400):
    """n documents: random ones, exact copies, near copies, shared passages, and
    null, empty, blank, one-word and long texts; a null id and repeated rows."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(vocabulary)]
    text = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passage, out = text(70), []
    for i in range(n):
        t = "\n".join(text(rnd.randint(3, 25)) for _ in range(rnd.randint(1, 9)))
        kind = i % 6
        if kind == 1:
            t = out[rnd.randrange(len(out))]
        elif kind == 2:
            t = out[rnd.randrange(len(out))].split(" ")
            t[rnd.randrange(len(t))] = "edit" + str(i)
            t = " ".join(t)
        elif kind == 3:
            t = text(20) + "\n" + passage + "\t" + text(rnd.randint(1, 30))
        out.append(t)
    out += [None, "", " \n\t ", "one", "one", text(6000)]
    rows = [(i, t, "en", f"src{i % 4}" if i % 9 else None, len(t) if t else 0) for i, t in enumerate(out)]
    rows += [rows[3], rows[3], (None, text(90), None, "src1", 5)]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], DOCS)
