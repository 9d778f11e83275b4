import random
import zlib

import pytest
from pyspark.sql import functions as F

from medistar.llm import toxicity as X

from .helpers import DOCS, empty, frame

LABELS = "doc_id long, quality int, toxic int"


def sample(n=600, seed=3):
    """Random prose; every fifth document has insults of two stems, with many endings."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeilmnorstu") for _ in range(rnd.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rnd.randint(1, 4)):
                w.insert(rnd.randrange(len(w)), rnd.choice(["zwirk", "quavv"]) + rnd.choice(["", "en", "ulo", "ista", "age", str(i)]))
        t = " ".join(x + rnd.choice(["", "", "", ",", "."]) for x in w)
        docs.append((i, t.upper() if i % 11 == 0 else t, "en", "s", len(t)))
        if i % 3:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    docs, labels = sample()
    d = frame(spark, docs + [(None, "zwirkage", None, None, 0), (9000, None, None, None, 0), (9001, "", None, None, 0)])
    model = X.learn(d, spark.createDataFrame(labels, LABELS))
    got = {r.doc_id: r for r in X.apply(d.selectExpr("*", "1 AS y", "2 AS w"), model).collect()}
    right = [got[i].predicted == int(i % 5 == 0) for i, *_ in docs if held(i) or i % 3 == 0]
    assert sum(right) / len(right) > 0.98
    assert got[9000].score == got[9001].score < 0.5 and all(0 <= r.score <= 1 for r in got.values())
    assert got[None].predicted == 1


def test_scores_see_the_text_alone_and_held_out_labels_are_unused(spark):
    docs, labels = sample(300)
    flipped = [(i, q, 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    d = frame(spark, docs)
    a, b = (X.learn(d, spark.createDataFrame(x, LABELS)) for x in (labels, flipped))
    assert a.lexicon.stems == b.lexicon.stems and (a.weights == b.weights).all()
    rows = X.apply(frame(spark, [docs[0], (7, docs[0][1], "fr", None, 3)]), a).collect()
    assert rows[0].score == rows[1].score


def test_held_out_flag(spark):
    ids = [0, 1, 17, 123456789, None]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select(X.held_out(F.col("doc_id")).alias("h")).collect()
    assert [r.h for r in got] == [held("" if i is None else i) for i in ids]


def test_no_labels_and_empty(spark):
    d = frame(spark, sample(20)[0])
    none = spark.createDataFrame([], LABELS)
    assert X.learn(d, none).lexicon.stems == {}
    assert X.learn(empty(spark), none).lexicon.stems == {}
    assert X.apply(empty(spark), X.Model(X.Lexicon())).count() == 0


@pytest.mark.parametrize("text,context", [
    ("what a zwirk", 0), ("you zwirk", 1), ("zwirk that you are", 1), ("this is not a zwirk", 2), ("he said zwirk", 3),
    ("not. a zwirk", 0), ("you said nothing; zwirk", 0)])
def test_contexts(text, context):
    f = X.Scanner(X.Lexicon({"zwirk": 2.0})).features(text)
    assert f[context] == 2.0 and f.sum() == 2.0


def test_threats_and_word_borders():
    s = X.Scanner(X.Lexicon({"zwirk": 2.0}))
    assert s.features("I will kill you")[4 + 1] == 2.0
    assert s.features("azwirk unzwirked").sum() == 0
    assert s.features("x " * 50_000 + "zwirks").sum() == 2.0
    assert s.features("zwirk zwirk!\nzwirk")[0] == 6.0


def test_every_listed_threat():
    s = X.Scanner(X.Lexicon())
    for t in X.THREATS:
        f = s.features(f"they will {t} now")
        assert f[4:].sum() == X.THREAT_PRIOR, t
    assert s.features("i will beat you")[4 + 1] == s.features("they hurts you")[4 + 1] == 2.0
    assert s.features("i beat the drum, it hurt a bit")[4:].sum() == 0
    assert s.features("he said i will beat you")[4 + 3] == 2.0


def test_threat_weights_are_learned(spark):
    docs, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        t = f"plain words {i} here " + ("they will strangle him " if toxic else "stab of the pin " if i % 5 == 0 else "")
        docs.append((i, t + ("zwirk " if toxic else ""), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    w = X.learn(frame(spark, docs), spark.createDataFrame(labels, LABELS)).lexicon.threats
    assert w["strangle"] > 3 and w["stab"] < 0.5 and w["hurt you"] == X.THREAT_PRIOR


def test_clashing_columns(spark):
    d = frame(spark, sample(20)[0]).selectExpr("*", "1 AS score", "2 AS predicted")
    with pytest.raises(ValueError):
        X.apply(d, X.Model(X.Lexicon()))
    assert X.apply(d, X.Model(X.Lexicon()), score_col="s", predicted_col="p").columns == [*d.columns, "s", "p"]


def test_grammar_is_a_closed_automaton():
    states = {s for s, _ in X.GRAMMAR}
    assert all(n in states for n in X.GRAMMAR.values()) and (0, 0, 0) in states
