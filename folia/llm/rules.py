"""Quality rules: base checks and a learned decision list.

Sequential covering on labelled documents: a rule grows by the threshold
condition with the best information gain until it covers no good document of
the growing part, is pruned against the rest, and the documents it covers
leave the set; then the next rule. What the learner sees are counts of
labelled documents by cell of a threshold grid, made by Spark; what it emits is a
list of threshold conjunctions, compiled into one ordered CASE expression.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, let

REPEAT_WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Labelled documents the list is learned from, at most (those with the smallest hashes of their ids).
MAX_LABELLED = 20000
#: Candidate thresholds of a feature, and what a rule must reach on either part.
GRID = 24
MIN_PRECISION = 0.95
#: A rule covers at least this share of the bad documents it was learned from.
MIN_COVER = 0.02
MAX_RULES = 12
MAX_CONDITIONS = 3


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words in windows of 8 that occur twice or more. Window hashes are made
    once; only texts with an equal pair go on to sort them with their places
    and add up the words that the repeated ones cover."""
    k = REPEAT_WINDOW

    def of_hashes(h: Column) -> Column:
        wins = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(k)]))
        return F.when(F.size(h) < k, F.lit(0).cast("long")).otherwise(let(wins, of_windows))

    def of_windows(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(let(placed, covered))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | F.coalesce(x["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"], F.lit(False)) & (i > 0))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.lit(0).cast("long")
        run = F.aggregate(places, F.struct(zero.alias("n"), zero.alias("to")), lambda a, i: F.struct(
            (a["n"] + (i + k) - F.greatest(a["to"], i.cast("long"))).cast("long").alias("n"), (i + k).cast("long").alias("to")))
        return run["n"]

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measures(text: Column) -> Column:
    """A struct of the text's counts; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    without = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    return let(_words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        without("!?").cast("long").alias("n_marks"),
        without("0123456789").cast("long").alias("n_digits"),
        F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
    ))


def features(m: str) -> dict[str, Column]:
    """What the rules test: rates made from the measures ``m``."""
    c = lambda n: F.col(f"{m}.{n}").cast("double")
    per = lambda a, b: F.when(c(b) > 0, c(a) / c(b)).otherwise(0.0)
    return {
        "n_words": c("n_words"), "word_chars_per_word": per("word_chars", "n_words"), "symbols_per_word": per("n_symbols", "n_words"),
        "marks_per_word": per("n_marks", "n_words"), "digits_per_char": per("n_digits", "word_chars"), "upper_per_char": per("n_upper", "word_chars"),
        "repeat_share": per("n_repeat_words", "n_words"), "distinct_share": per("n_distinct", "n_words"), "dup_lines": c("n_dup_lines"),
    }


# ------------------------------------------------------------------- learning

def _gain(p0, n0, p1, n1):
    """Information gain of narrowing (p0, n0) covered documents to (p1, n1)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p1 * (np.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))
    return np.where(p1 > 0, g, -np.inf)


def cover(cells: np.ndarray, bad: np.ndarray, good: np.ndarray, prune: np.ndarray, n_bins: list[int],
          min_precision: float = MIN_PRECISION, min_cover: float = MIN_COVER) -> list[list[tuple[int, str, int]]]:
    """Rules for the bad class from counts by cell. ``cells``: a bin number
    for each feature; ``prune``: which cells' counts belong to the pruning
    part. A condition is (feature, ">=" or "<", bin)."""
    rules, alive = [], np.ones(len(cells), bool)

    def holds(conditions):
        m = alive.copy()
        for f, op, t in conditions:
            m &= cells[:, f] >= t if op == ">=" else cells[:, f] < t
        return m

    def precision(m):
        p, n = bad[m].sum(), good[m].sum()
        return (p + 0.5) / (p + n + 1.0)

    while len(rules) < MAX_RULES:
        conditions: list = []
        m = alive & ~prune
        while len(conditions) < MAX_CONDITIONS and good[m].sum() > 0 and bad[m].sum() > 0:
            p0, n0, best = bad[m].sum(), good[m].sum(), (0.0, None)
            used = {f for f, _, _ in conditions}
            for f, bins in sorted(enumerate(n_bins), key=lambda x: x[0] in used):  # a new feature says more than a used one
                p = np.bincount(cells[m, f], bad[m], bins).cumsum()
                n = np.bincount(cells[m, f], good[m], bins).cumsum()
                for op, gain in (("<", _gain(p0, n0, p, n)), (">=", _gain(p0, n0, p0 - p, n0 - n))):
                    t = int(np.argmax(gain[:-1])) if bins > 1 else 0
                    if bins > 1 and gain[t] > best[0] + 1e-9:
                        best = (float(gain[t]), (f, op, t + 1))
            if best[1] is None:
                break
            conditions.append(best[1])
            m = holds(conditions) & ~prune
        # a condition goes where the pruning part does without it and the rule stays precise
        while len(conditions) > 1 and precision(holds(conditions[:-1]) & prune) >= precision(holds(conditions) & prune) and (
                precision(holds(conditions[:-1])) >= min_precision or precision(holds(conditions)) < min_precision):
            conditions.pop()
        m = holds(conditions) if conditions else np.zeros(len(cells), bool)
        if bad[m].sum() < max(1.0, min_cover * bad.sum()) or precision(m) < min_precision or precision(m & prune) < min_precision - 0.05:
            break
        rules.append(conditions)
        alive &= ~m
    return rules


def learn(labelled: DataFrame, bad: Column) -> list[list[tuple[str, str, float]]]:
    """Labelled rows with measures in ``m`` -> rules as lists of (feature,
    operator, threshold). Thresholds are quantiles; only counts by cell come
    to the driver, no more rows than were labelled (MAX_LABELLED)."""
    feats = features("m")
    rows = labelled.select(*[c.alias(n) for n, c in feats.items()], bad.cast("int").alias("bad"), (F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(3)) == 0).alias("prune"))
    steps = [i / GRID for i in range(1, GRID)]
    quantiles = rows.agg(*[F.percentile_approx(F.when(F.col("bad") == b, F.col(n)), steps, 2000).alias(f"{n}_{b}") for n in feats for b in (0, 1)]).first()
    cuts = {n: sorted({v for b in (0, 1) for v in (quantiles[f"{n}_{b}"] or [])}) for n in feats}
    binned = [F.coalesce(sum((F.col(n) >= v).cast("int") for v in cuts[n]) if cuts[n] else F.lit(0), F.lit(0)).alias(n) for n in feats]
    counts = rows.select("bad", "prune", *binned).groupBy(*feats, "prune").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g")).orderBy(*feats, "prune").collect()
    if not counts:
        return []
    cells = np.array([[r[n] for n in feats] for r in counts])
    found = cover(cells, np.array([r["b"] for r in counts], float), np.array([r["g"] for r in counts], float),
                  np.array([r["prune"] for r in counts], bool), [len(cuts[n]) + 1 for n in feats])
    names = list(feats)
    # bin >= t means value >= cuts[t - 1]
    return [[(names[f], op, cuts[names[f]][t - 1]) for f, op, t in rule] for rule in found]


def rejected_by(rules: list[list[tuple[str, str, float]]], m: str = "m") -> Column:
    """The number (from 1) of the first rule that holds, else null."""
    feats, out = features(m), F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        holds = F.lit(True)
        for name, op, t in rules[k - 1]:
            holds = holds & (feats[name] >= F.lit(float(t)) if op == ">=" else feats[name] < F.lit(float(t)))
        out = F.when(holds, F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, the measures, base_failed, rule, kept) for every row.

    Null and empty texts have no words and fail the base check. Rows without a
    doc_id are judged, but not learned from; a doc_id with contradictory
    labels counts as bad. Ties between conditions go to a feature that the
    rule has not used yet, then to the feature and threshold that come first. Without labels there are no rules. Repeated
    rows give a row each; other columns are not read.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 0).alias("bad"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)  # 16 bytes a row: small enough to broadcast by its bound
    sample = texts.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])
    rules = learn(sample.select("doc_id", "bad", measures(F.col("t")).alias("m")), F.col("bad"))
    out = texts.select("doc_id", measures(F.col("t")).alias("m"))
    base = (F.col("m.n_words") < 20) | (100 * F.col("m.n_repeat_words") > 30 * F.col("m.n_words"))
    out = out.select("doc_id", "m", base.alias("base_failed"), rejected_by(rules).alias("rule"))
    return out.select("doc_id", "m.*", "base_failed", "rule", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, base verdict and learned verdict of every document."""
    docs = documents(spark, sf_dir)
    j = judge(docs, documents(spark, sf_dir, "labels"))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
