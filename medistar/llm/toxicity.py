"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexicon transducer maps words to a class (insult, threat, target, negation,
report, clause end, other) with a weight; a threat may be a sequence of words
(``beat you``), read as one match whose further words keep their own classes;
small transducers for negation scope,
reported speech and targets read the class sequence; their composition walks a
clause once and emits each insult or threat under the context it is in.  A
document's score is a logistic function of the weights matched per context, so
it is clauses that count, not isolated words.

The insult lexicon (word stems of up to ``max_stem`` letters), the threats'
weights and the context weights are learned from labelled rows: at most ``max_per_class`` rows of each label (those of smallest
row hash: a bounded sample, the same in every run) give stem counts, aggregated
in Spark over different contexts (copies of one text count once); stems
over-represented in toxic rows by a likelihood-ratio test become insults, and
each listed threat's weight is its smoothed log odds in the sample.  Without
labels the fixed seeds and prior weights alone are used.  The driver holds the
model: stems seen in ``min_contexts`` contexts of the sampled toxic rows.
Scores read the text and nothing else.

Results by case: null and empty texts are scored as empty (the bias alone, not
toxic); repeated rows get equal scores; several labels of one id count as their
maximum; a null id never joins a label; an empty table gives no rows; other
columns are ignored.  Texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import importable, materialize

# Fixed seeds of the closed classes (four languages)
TARGETS = frozenset("you your youre he she they them him her his these those people du ihr sie dich dein "
                    "tu toi vous ton tes il elle tú usted ustedes él ella ellos".split())
NEGATIONS = frozenset("not no never nobody hardly isnt arent wasnt dont nicht kein keine nie ne pas jamais aucun nunca ni".split())
REPORTS = frozenset("said says say told called calls wrote writes claimed reported quoted according sagte schrieb laut "
                    "dit disait écrit selon dijo dice escribió según".split())
# a threat is a sequence of words: the first one with any ending, the others whole
THREATS = ("kill", "murder", "strangle", "stab", "beat you", "hurt you", "töten", "umbringen", "tuer", "matar")
THREAT_PRIOR = 2.0  # weight of a threat that the labelled rows say nothing about
CONTEXTS = ("plain", "targeted", "negated", "reported")
NEGATION_SPAN = 3  # words a negation reaches

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n]")


# ------------------------------------------------------------ transducers
# A transducer: start state, and step(state, class) -> state.

def _negation(state: int, cls: str) -> int:
    return NEGATION_SPAN if cls == "negation" else max(0, state - 1)


def _report(state: int, cls: str) -> int:
    return 1 if cls == "report" else state


def _target(state: int, cls: str) -> int:
    return 1 if cls == "target" else state


def compose(*steps) -> dict:
    """The product automaton of the transducers, over every reachable state:
    {(state, class): next state}."""
    classes = ("insult", "threat", "target", "negation", "report", "other")
    start = (0,) * len(steps)
    table, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for c in classes:
            nxt = tuple(f(s, c) for f, s in zip(steps, state))
            table[state, c] = nxt
            if nxt not in seen:
                seen.add(nxt)
                todo.append(nxt)
    return table


GRAMMAR = compose(_negation, _report, _target)


@dataclass
class Lexicon:
    """stems: prefix -> weight of an insult; threats: words -> weight."""
    stems: dict[str, float] = field(default_factory=dict)
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREATS, THREAT_PRIOR))

    def __post_init__(self):
        self.longest = max(map(len, [*self.stems, *(t.split()[0] for t in self.threats)]), default=0)
        self.sequences: dict[str, list] = {}  # first word -> (further words, weight), the longest first
        for t in sorted(self.threats, key=lambda t: -len(t.split())):
            first, *rest = t.split()
            self.sequences.setdefault(first, []).append((rest, self.threats[t]))

    def threat(self, words: list[str], at: int) -> float | None:
        """Weight of the longest threat whose words stand at ``at``."""
        for n in range(min(len(words[at]), self.longest), 2, -1):
            for rest, w in self.sequences.get(words[at][:n], ()):
                if words[at + 1:at + 1 + len(rest)] == rest:
                    return w
        return None

    def classify(self, words: list[str], at: int) -> tuple[str, float]:
        word = words[at]
        for n in range(min(len(word), self.longest), 2, -1):
            w = self.stems.get(word[:n])
            if w is not None:
                return "insult", w
        w = self.threat(words, at)
        if w is not None:
            return "threat", w
        if word in NEGATIONS:
            return "negation", 0.0
        if word in REPORTS:
            return "report", 0.0
        if word in TARGETS:
            return "target", 0.0
        return "other", 0.0


def clause_features(words: list[str], lex: Lexicon) -> np.ndarray:
    """Weights matched in one clause: insults, then threats, per context."""
    out = np.zeros(2 * len(CONTEXTS))
    state, hits = (0, 0, 0), []
    for at in range(len(words)):
        cls, weight = lex.classify(words, at)
        if weight:
            hits.append((cls, weight, state))
        state = GRAMMAR[state, cls]
    for cls, weight, (neg, rep, _) in hits:  # a target counts wherever it stands in the clause
        ctx = 3 if rep else 2 if neg else 1 if state[2] else 0
        out[ctx + len(CONTEXTS) * (cls == "threat")] += weight
    return out


class Scanner:
    """Finds the clauses with a hit by one pass of a multi-pattern automaton and
    walks only those through the grammar."""

    def __init__(self, lex: Lexicon):
        import ahocorasick

        self.lex, self.auto = lex, None
        terms = {*lex.stems, *lex.sequences}
        if terms:
            self.auto = ahocorasick.Automaton()
            for t in terms:
                self.auto.add_word(t, len(t))
            self.auto.make_automaton()

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(2 * len(CONTEXTS))
        if not text or self.auto is None:
            return out
        low, upto = text.lower(), 0
        for end, n in self.auto.iter(low):
            start = end - n + 1
            if start < upto or (start and low[start - 1].isalpha()):
                continue
            a = start
            while a > upto and not _CLAUSE.match(low[a - 1]):
                a -= 1
            m = _CLAUSE.search(low, end + 1)
            upto = m.start() if m else len(low)
            out += clause_features(_WORD.findall(low, a, upto), self.lex)
        return out


PRIOR = np.array([-3.0, 2.0, 2.5, 1.0, 1.0, 1.5, 2.5, 0.5, 0.5])


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())


def score(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = weights[0] + np.log1p(features) @ weights[1:]
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 30) -> np.ndarray:
    """Logistic weights by Newton steps, drawn to the prior by ``ridge``."""
    x = np.column_stack([np.ones(len(x)), np.log1p(x)])
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (p - y) + ridge * (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w = w - d * min(1.0, 2.0 / (np.abs(d).max() + 1e-9))
        if np.abs(d).max() < 1e-6:
            break
    w[1:] = np.maximum(w[1:], 0.0)
    return w


def held_out(id_col) -> F.Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id: as empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def learn(docs: DataFrame, labels: DataFrame, max_per_class: int = 4000, max_stem: int = 32,
          min_contexts: int = 5, min_precision: float = 0.9) -> Model:
    """A model of the labelled rows that are not held out."""
    spark = docs.sparkSession
    importable(spark)
    lab = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").alias("_id")).agg((F.max("toxic") > 0).cast("int").alias("y")))
    key = F.xxhash64(F.lit("toxicity"), "_id")
    sample = lab.where("y = 1").orderBy(key, "_id").limit(max_per_class).unionByName(
        lab.where("y = 0").orderBy(key, "_id").limit(max_per_class))
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(sample, F.col("doc_id") == F.col("_id")).select("text", "y")
    rows = materialize(spark, rows, "toxicity-sample")
    size = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = size.get(1, 0), size.get(0, 0)
    if not pos or not neg:
        return Model(Lexicon())
    # evidence of a word is the number of different words before it, per label:
    # copies of one text repeat their contexts and so count once
    ws = rows.select("y", F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+").alias("w"))
    pairs = ws.select("y", F.arrays_zip("w", F.concat(F.array(F.lit("")), F.col("w")).alias("before")).alias("c"))
    per = pairs.select("y", F.explode("c").alias("c")).where("length(c.w) > 2") \
        .groupBy("c").agg(F.max("y").alias("p"), F.max(1 - F.col("y")).alias("q")) \
        .groupBy("c.w").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    per = materialize(spark, per, "toxicity-words")
    seen = per.agg(F.sum("p").alias("p"), F.sum("q").alias("q")).first()
    pos, neg = seen["p"] or 0, seen["q"] or 0
    if not pos or not neg:
        return Model(Lexicon())
    stems = per.select(F.explode(F.transform(F.sequence(F.lit(3), F.least(F.length("w"), F.lit(max_stem))),
                                             lambda n: F.substring(F.col("w"), F.lit(1), n))).alias("stem"), "p", "q") \
        .groupBy("stem").agg(F.sum("p").alias("p"), F.sum("q").alias("q")) \
        .where((F.col("p") >= min_contexts) & (F.col("q") <= F.col("p") * (1 - min_precision)))
    share = pos / (pos + neg)
    total = F.col("p") + F.col("q")
    part = lambda n, e: F.when(n > 0, n * F.log(n / (total * e))).otherwise(0.0)
    tested = stems.withColumn("g2", 2 * (part(F.col("p"), share) + part(F.col("q"), 1 - share))) \
        .withColumn("odds", F.log((F.col("p") + 0.5) / (pos + 1)) - F.log((F.col("q") + 0.5) / (neg + 1)))
    best = tested.where((F.col("odds") > math.log(12)) & (F.col("g2") > 24)) \
        .orderBy(F.desc("g2"), F.desc(F.length("stem")), "stem").collect()
    lex = Lexicon()
    covered: set[str] = set()
    for r in best:  # the best of nested stems stands for the others
        s = r["stem"]
        if s in covered or any(s[:n] in lex.stems for n in range(3, len(s))):
            continue
        lex.stems[s] = min(float(r["odds"]), 8.0)
        covered.update(s[:n] for n in range(3, len(s)))
    lex = Lexicon(lex.stems, _threat_weights(rows, size))
    found = rows.mapInArrow(_features(lex), "y int, f array<double>").collect()
    x = np.array([r["f"] for r in found])
    y = np.array([r["y"] for r in found], dtype=float)
    return Model(lex, fit_weights(x, y))


def _threat_weights(rows: DataFrame, size: dict) -> dict[str, float]:
    """The listed threats' weights: log odds of the sampled rows that hold them, drawn to the prior."""
    text = F.concat(F.lit(" "), F.array_join(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), " "), F.lit(" "))
    held = [F.count_if(text.rlike(rf" {t.replace(' ', '[a-z]* ', 1)} " if " " in t else f" {t}")).alias(f"t{i}")
            for i, t in enumerate(THREATS)]
    n = {r["y"]: r for r in rows.groupBy("y").agg(*held).collect()}
    out = {}
    for i, t in enumerate(THREATS):
        p, q = ((n[y][f"t{i}"] if y in n else 0) for y in (1, 0))
        seen = math.log((p + 0.5) / (size[1] + 1)) - math.log((q + 0.5) / (size[0] + 1))
        few = 5.0 / (5.0 + p + q)
        out[t] = min(max(few * THREAT_PRIOR + (1 - few) * seen, 0.0), 8.0)
    return out


def _features(lex: Lexicon):
    def run(batches):
        scanner = Scanner(lex)
        for b in batches:
            f = [scanner.features(t.as_py()).tolist() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1).cast(pa.int32()), pa.array(f, pa.list_(pa.float64()))], ["y", "f"])
    return run


def apply(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5,
          score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """docs' columns with a score (double) and a prediction (int), under names that docs does not have."""
    if clash := {score_col, predicted_col} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are there already: name others by score_col and predicted_col")
    from pyspark.sql.pandas.types import to_arrow_schema

    importable(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType()),
                           T.StructField(predicted_col, T.IntegerType())])
    arrow, at = to_arrow_schema(schema), docs.columns.index(text_col)

    def run(batches):
        scanner = Scanner(model.lexicon)
        for b in batches:
            x = np.array([scanner.features(t.as_py()) for t in b.column(at)]).reshape(-1, 2 * len(CONTEXTS))
            s = score(x, model.weights)
            cols = [c.cast(f.type) for c, f in zip(b.columns, arrow)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s), pa.array((s >= threshold).astype(np.int32))], schema=arrow)

    return docs.mapInArrow(run, schema)
