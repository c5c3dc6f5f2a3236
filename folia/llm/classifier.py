"""Quality classifier: weak labels, expectation-maximisation, hashed scorer.

A document can be bad in two unrelated ways, as junk or as toxic, so each has
labellers, an estimate and a scorer of its own; either rejects it.

1. Overlapping heuristic labellers (and the human labels, where there are any)
   vote good or bad on every document, or abstain. Spark counts how often each
   combination of votes occurs in the whole corpus.
2. Expectation-maximisation over these counts estimates each labeller's
   accuracy on good and on bad documents and the share of bad ones; each
   combination of votes gets a posterior.
3. The posteriors are the training labels of a linear model over hashed words
   and coarse text statistics: logistic regression with an L1 penalty, so that
   words which tell nothing weigh nothing.
4. The model scores every document, labelled or not.
"""

from __future__ import annotations

import math
import re
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_value, documents, own_columns, session, staged

#: Documents the scorer is trained on, at most: those with the smallest hashes of their texts.
TRAIN_ROWS = 12000
#: Labelled documents the lexicon is drawn from, at most, and words in it, at most.
LEXICON_ROWS = 20000
LEXICON_WORDS = 4096
BUCKETS = 1 << 18
THRESHOLD = 0.5
EPOCHS = 100
#: Buckets met in fewer training documents are left out: nothing can be learned from them.
MIN_ROWS = 4
L1 = 1e-5

_WORD = re.compile(r"[^\W\d_]+")
TASKS = {"junk": ("symbols", "shouting", "variety", "loops", "layout", "length", "quality label"),
         "toxic": ("words", "words of the other half", "word stems", "toxic label")}
#: Lengths of the word beginnings that stand for a word's family.
STEMS = (5, 6, 7)
ABSTAIN, GOOD, BAD = 0, 1, 2
by_value(__name__)


_STEM_BITS = 20


def _bucket(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature.encode()) & (BUCKETS - 1)


class _Buckets(dict):
    """Bucket of a word, and above it that of its stem; negative without a
    stem. Words met lately are remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        k = STEMS[-1]
        # a negative number keeps its low bits under "&"
        stem = _bucket("\1" + word[:k]) if len(word) > k else -1
        found = self[word] = (stem << _STEM_BITS) + _bucket(word)
        return found


class _Stems(dict):
    """Whether a word begins with a stem of the lexicon, remembered like buckets."""

    def __init__(self, stems: frozenset):
        super().__init__()
        self.stems = stems

    def __missing__(self, word: str) -> bool:
        if len(self) > 1 << 18:
            self.clear()
        found = self[word] = any(len(word) > k and word[:k] in self.stems for k in STEMS)
        return found


class Text:
    """What labellers and scorer see of a text."""

    def __init__(self, text: str | None):
        t = text or ""
        self.tokens = t.split()
        self.n = len(self.tokens)
        self.words = set(_WORD.findall(t.lower()))
        n, chars = max(1, self.n), max(1, len(t))
        self.symbols = sum(t.count(c) for c in "#*$%&|<>{}[]~^\\") / n
        self.marks = (t.count("!") + t.count("?")) / n
        self.upper = sum(w.isupper() for w in self.tokens if len(w) > 1) / n
        self.variety = len(set(self.tokens)) / n
        self.loops = sum(a == b for a, b in zip(self.tokens, self.tokens[1:])) / n
        self.mean = sum(map(len, self.tokens)) / n
        self.digits = sum(map(t.count, "0123456789")) / chars

    def votes(self, lexicon: list[frozenset], stems: _Stems) -> tuple[list[int], list[int]]:
        """The heuristics' votes of each task; the human labels are voted by ``weak_labels``."""
        say = lambda bad, good: BAD if bad else GOOD if good else ABSTAIN
        hits = [not self.words.isdisjoint(half) for half in lexicon[:2]]
        junk = [
            say(self.symbols > 0.3, self.symbols < 0.05),
            say(self.upper > 0.5 or self.marks > 0.5, self.upper < 0.1 and self.marks < 0.1),
            say(self.n >= 50 and self.variety < 0.08 + 2.5 / math.sqrt(self.n), False),
            say(self.n >= 10 and self.loops > 0.3, self.loops < 0.02),
            say(self.n and (self.mean > 20 or self.mean < 2), 3 <= self.mean <= 12),
            say(self.n < 3, self.n >= 20),
        ]
        return junk, [*(say(h, True) for h in hits), say(any(map(stems.__getitem__, self.words)), True)]

    def features(self, buckets: _Buckets) -> np.ndarray:
        """Distinct hash buckets of the words, their stems and the statistics, in steps."""
        step = lambda name, x, top=12: f"\0{name}:{min(top, int(x))}"
        extra = [step("symbols", self.symbols * 10), step("marks", self.marks * 10), step("upper", self.upper * 10), step("variety", self.variety * 20, 20),
                 step("spread", self.variety * math.sqrt(max(1, self.n)), 20), step("loops", self.loops * 20), step("mean", self.mean, 25), step("digits", self.digits * 50),
                 step("length", math.log2(self.n + 1), 20)]
        words = np.fromiter(map(buckets.__getitem__, self.words), np.int64, len(self.words))
        return np.unique(np.concatenate([words & (BUCKETS - 1), (words >> _STEM_BITS)[words >= 0], [_bucket(x) for x in extra]])).astype(np.int32)


# ---------------------------------------------------------------- weak labels

def lexicon(docs: DataFrame, labels: DataFrame, max_rows: int = LEXICON_ROWS) -> list[frozenset]:
    """Words that mark labelled toxic documents, drawn from either half of
    them (five documents at least), and word stems from all (eight): 95 in a hundred must be
    toxic. Of more than LEXICON_WORDS those in most documents, ties in code
    point order."""
    # at most max_rows rows of 16 bytes: bounded, so safe to broadcast
    some = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0)))
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)).cast("int")
    stems = F.array_distinct(F.flatten(F.array(*[F.transform(F.filter(words, partial(lambda k, w: F.length(w) > k, k)), partial(lambda k, w: F.substring(w, 1, k), k)) for k in STEMS])))
    told = rows.select("toxic", half.alias("part"), F.explode(words).alias("w")).unionByName(rows.select("toxic", F.lit(2).alias("part"), F.explode(stems).alias("w")))
    counts = told.groupBy("part", "w").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).where("bad >= IF(part = 2, 8, 5) AND bad >= 0.95 * n")
    return [frozenset(r.w for r in counts.where(F.col("part") == k).orderBy(F.desc("bad"), "w").limit(LEXICON_WORDS).collect()) for k in range(3)]


def _vote(shared):
    def run(batches):
        lex = shared.value
        stems = _Stems(lex[2])
        for b in batches:
            said = [Text(t.as_py()).votes(lex, stems) for t in b.column(0)]
            votes = [pa.array([",".join(map(str, v[k])) for v in said], pa.string()) for k in range(len(TASKS))]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), *votes], names=["h", "doc_id", *TASKS])
    return run


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[float, np.ndarray, dict[tuple[int, ...], float]]:
    """Expectation-maximisation on (votes, count): the share of bad documents,
    theta[class, labeller, vote] and the posterior of bad for each combination.

    Labellers are taken as independent given the class. Starts from the share
    of bad votes, smoothed by one document a cell, so an empty corpus is fine.
    """
    votes = np.array([p for p, _ in patterns], np.int64).reshape(len(patterns), -1)
    count = np.array([c for _, c in patterns], float)
    n_bad, n_good = (votes == BAD).sum(axis=1), (votes == GOOD).sum(axis=1)
    q = np.clip((n_bad * 3 + 0.2) / (n_bad * 3 + n_good * 0.5 + 0.4), 0.02, 0.98)
    prior, theta = 0.5, np.full((2, votes.shape[1], 3), 1 / 3)
    for _ in range(rounds):
        prior = (count @ q + 1) / (count.sum() + 2)
        for cls, weight in ((0, count * (1 - q)), (1, count * q)):
            for j in range(votes.shape[1]):
                theta[cls, j] = np.bincount(votes[:, j], weight, 3) + (0.5, 2.0 if cls == 0 else 0.5, 2.0 if cls else 0.5)
                theta[cls, j] /= theta[cls, j].sum()
        logit = np.full(len(votes), math.log(prior / (1 - prior)))
        for j in range(votes.shape[1]):
            logit += np.where(votes[:, j] == ABSTAIN, 0.0, np.log(theta[1, j] / theta[0, j])[votes[:, j]])
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - q).max(initial=0.0) < 1e-6:
            break
        q = new
    return float(prior), theta, {p: float(x) for (p, _), x in zip(patterns, q)}


# --------------------------------------------------------------------- scorer

def train(rows: list[np.ndarray], target: np.ndarray, epochs: int = EPOCHS, l1: float = L1) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression on sets of buckets by accelerated
    proximal gradient steps, each feature scaled by how often it occurs.
    Classes weigh the same in total."""
    w, bias = np.zeros(BUCKETS), 0.0
    if not len(rows):
        return w, bias
    met = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    slot = np.cumsum(met >= MIN_ROWS) - 1
    rows = [slot[r[met[r] >= MIN_ROWS]].astype(np.int32) for r in rows]
    n = int((met >= MIN_ROWS).sum())
    at, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    weight = target / share / 2 + (1 - target) / (1 - share) / 2
    weight = weight / weight.sum()
    # diagonal step sizes: the curvature along a feature is at most a quarter of sum(weight * row size)
    curve = np.bincount(at, (weight * np.sqrt(sizes + 1.0))[owner], n) + 1e-5
    step = 2.0 / (curve * math.sqrt(sizes.mean() + 1.0))
    v, prev, k, vb, pb = np.zeros(n), np.zeros(n), 1.0, bias, bias
    for _ in range(epochs):
        z = np.bincount(owner, v[at], len(rows)) + vb
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        u = v - step * np.bincount(at, err[owner], n)
        u = np.sign(u) * np.maximum(np.abs(u) - step * l1, 0)
        bias = vb - err.sum()
        k2 = (1 + math.sqrt(1 + 4 * k * k)) / 2
        v, vb = u + (k - 1) / k2 * (u - prev), bias + (k - 1) / k2 * (bias - pb)
        prev, pb, k = u, bias, k2
    w[met >= MIN_ROWS] = prev
    return w, bias


def _fit(table: pa.Table) -> pa.Table:
    buckets = _Buckets()
    rows = [Text(t.as_py()).features(buckets) for t in table.column("text")]
    out = []
    for k, task in enumerate(TASKS):
        w, bias = train(rows, table.column(task).to_numpy())
        at = np.flatnonzero(w)
        out.append(pa.table({"task": np.full(len(at) + 1, k, np.int32), "bucket": np.append(at, -1).astype(np.int32), "weight": np.append(w[at], bias)}))
    return pa.concat_tables(out)


def _score(shared):
    def run(batches):
        models, buckets = [], _Buckets()
        for at, weights, bias in shared.value:
            w = np.zeros(BUCKETS)
            w[at] = weights
            models.append((w, bias))
        for b in batches:
            z = np.array([[w[f].sum() + bias for w, bias in models] for f in (Text(t.as_py()).features(buckets) for t in b.column(0))]).reshape(-1, len(models))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(pa.array(p[:, k]) for k in range(len(models))), b.column(1)], names=[*(f"p_{t}" for t in TASKS), "row"])
    return run


def weak_labels(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict]:
    """(h, votes for each task) for every document, h a hash of its id and
    text; and for each task (share of bad documents, theta, posteriors)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon(docs, labels))
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("q"), F.max("toxic").cast("int").alias("x"))
    rows = docs.select("text", F.xxhash64("text", "doc_id").alias("h"), F.col("doc_id").cast("long").alias("doc_id"))
    votes = rows.mapInArrow(_vote(shared), "h long, doc_id long, " + ", ".join(f"{t} string" for t in TASKS))
    # only ids and votes are shuffled to the labels
    label = lambda c, good: F.when(F.col(c).isNull(), ABSTAIN).when(F.col(c) == good, GOOD).otherwise(BAD).cast("string")
    votes = votes.join(told, "doc_id", "left").select("h", F.concat_ws(",", "junk", label("q", 1)).alias("junk"), F.concat_ws(",", "toxic", label("x", 0)).alias("toxic"))
    votes = staged(votes)
    found = {}
    for task, names in TASKS.items():
        counts = votes.groupBy(task).count().orderBy(task).collect()  # at most 3 ** labellers rows
        found[task] = estimate([(tuple(map(int, r[0].split(","))), r[1]) for r in counts] or [((ABSTAIN,) * len(names), 0)])
    return votes, found


def model(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> list[tuple]:
    """(buckets, weights, bias) for each task, fitted on the posterior labels
    of at most ``train_rows`` documents."""
    spark = docs.sparkSession
    votes, found = weak_labels(docs, labels)
    some = votes.distinct().orderBy(F.xxhash64("h"), "h", *TASKS).limit(train_rows)
    for task in TASKS:  # no more rows than there are combinations of votes
        post = spark.createDataFrame([(",".join(map(str, k)), p) for k, p in found[task][2].items()], f"{task} string, p double")
        some = some.join(F.broadcast(post), task).drop(task).withColumnRenamed("p", f"p_{task}")
    for task in TASKS:
        some = some.withColumnRenamed(f"p_{task}", task)
    # the sample's bound is the broadcast's: 32 bytes a row
    sample = docs.select("text", F.xxhash64("text", "doc_id").alias("h")).join(F.broadcast(some), "h").dropDuplicates(["h"])
    fitted = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(lambda t: _fit(t.sort_by("h")), "task int, bucket int, weight double").collect()
    fitted.sort()  # here: an orderBy in Spark would fit twice, once to sample its ranges
    models = []
    for k in range(len(TASKS)):
        own = [r for r in fitted if r.task == k] or [None]
        models.append((np.array([r.bucket for r in own[1:]], np.int32), np.array([r.weight for r in own[1:]]), own[0].weight if own[0] else -1.0))  # nothing to learn from: keep all
    return models


def classify(docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(row, p_junk, p_toxic, rejected) for every row; ``row`` is the struct of
    the row's own columns.

    Null and empty texts have no words and are scored by their length alone.
    Rows without doc_id take part, but have no human label; several labels of
    one document count as the worst of them. Repeated rows are judged alike
    and give a row each. Without labels the heuristics vote alone. An empty
    table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model(docs, labels, train_rows))
    row = F.struct(*own_columns(docs)).alias("row")
    scored = docs.select(F.col("text"), row)
    scored = scored.mapInArrow(_score(shared), T.StructType([T.StructField("p_junk", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), scored.schema["row"]]))
    return scored.withColumn("rejected", F.greatest("p_junk", "p_toxic") > threshold)


def op4_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = documents(spark, sf_dir)
    c = classify(docs.select("doc_id", "text"), documents(spark, sf_dir, "labels"))
    return c.select("row.doc_id", "p_junk", "p_toxic", (~F.col("rejected")).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    session(spark)
    return classify(docs, documents(spark, sf_dir, "labels")).where("NOT rejected").select("row.*")
