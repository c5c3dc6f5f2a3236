"""Substring dedup by recompression.

A document is a string of words. Recompression rounds rename it to ever
shorter strings of symbols: a run of one symbol becomes one symbol, and a
symbol of the left half of the alphabet followed by one of the right half
becomes their pair. Names and halves are taken from content hashes, so every
task gives equal runs and pairs the same name without a shuffle, and equal
passages get equal symbols in their interior; only near the ends do outside
words matter. For each symbol the span of words that fixes it (its context)
is kept. Of the symbols whose context lies within a window of 13 words, the
one of the highest round (then of the largest hash) is the window's anchor:
it depends on the window's words alone, neighbouring windows mostly share it,
and a single word is always there to serve. An anchor is known by its round
and the hash of its whole context, so two places share one only where about
eight words or more are equal.

1. One pass names every document's symbols and keeps its distinct anchors.
   Documents with equal words are one class from here on.
2. Spark groups the anchors: only those in two documents can reveal a repeat.
3. A second pass hashes the windows of shared anchors (96 bits); Spark finds
   each window's smallest document, and which others have it.
4. A last pass over the documents with such windows removes the covered words.

All words, windows and documents take part; nothing is sampled or capped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, staged, written
from .urlfilter import possibly_in

WINDOW = 13
#: Enough for symbols of about four words; more rounds leave more anchors, fewer make them less telling.
ROUNDS = 3
_LOW = np.uint64((1 << 60) - 1)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_BASE = np.uint64(_BASE)
#: Anchors travel as 48 bits: two that agree by chance only add windows to compare.
_SHORT = np.uint64(16)
_SEPARATOR = np.uint64(0xD6E8FEB86659FD93)
by_value(__name__)


class _Hashes(dict):
    """64-bit hashes of words, remembered for a while."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 8)
        return h


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def anchors(word: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> np.ndarray:
    """The anchor of each window of a string of word hashes."""
    n = len(word)
    if n < window:
        return np.zeros(0, np.uint64)
    # by_width[c][p]: best symbol with context exactly [p, p + c); bits 60-63 are its round
    by_width = [np.zeros(n, np.uint64) for _ in range(window + 1)]
    by_width[1] = _stir(word) & _LOW
    sym, lo, hi = word, np.arange(n), np.arange(1, n + 1)
    content = _spans(word)
    for r in range(1, rounds + 1):
        sym, lo, hi = _pairs(*_runs(sym, lo, hi, n), n, r)
        fits = (lo >= 0) & (hi <= n) & (hi - lo <= window)
        if not fits.any():
            break
        width, at = (hi - lo)[fits], lo[fits]
        key = (content(at, width) & _LOW) | np.uint64(r << 60)
        for c in np.unique(width):
            np.maximum.at(by_width[c], at[width == c], key[width == c])
    best = by_width[1]
    for c in range(2, window + 1):  # best with context inside [p, p + c)
        best = np.maximum(np.maximum(best[:-1], best[1:]), by_width[c][: n - c + 1])
    return best


def _spans(word: np.ndarray):
    """A function (starts, widths) -> hashes of these spans of words."""
    powers = np.cumprod(np.full(len(word), _BASE), dtype=np.uint64)
    back = np.cumprod(np.full(len(word) + 1, _BASE_INVERSE), dtype=np.uint64)
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_stir(word) * powers, dtype=np.uint64)))
    return lambda at, width: _stir((upto[at + width] - upto[at]) * back[at] + width.astype(np.uint64))


def _runs(sym, lo, hi, n):
    """Names runs: in a a a a the inner a's, those with equal neighbours on
    both sides, become one symbol; the outer two stay, so that what stands
    beside a run meets a plain a, run or not. The name depends on the run's
    length, so its context takes in the symbols on both sides of the run."""
    inner = np.zeros(len(sym), bool)
    inner[1:-1] = (sym[1:-1] == sym[:-2]) & (sym[1:-1] == sym[2:])
    if not inner.any():
        return sym, lo, hi
    starts = inner & ~np.concatenate(([False], inner[:-1]))
    first = np.flatnonzero(starts)
    last = np.flatnonzero(inner & ~np.append(inner[1:], False))
    lo_out, hi_out = np.concatenate(([-1, -1], lo)), np.append(hi, [n + 1, n + 1])
    sym, lo, hi = sym.copy(), lo.copy(), hi.copy()
    sym[first] = _stir(sym[first] + (last - first + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    lo[first], hi[first] = lo_out[first], hi_out[last + 2]  # two to the left of the first, two to the right of the last
    keep = ~inner | starts
    return sym[keep], lo[keep], hi[keep]


def _pairs(sym, lo, hi, n, r):
    """Names pairs (left half of the alphabet, right half of the alphabet).

    A pair depends on its two symbols alone. A symbol left single depends on
    the neighbour that might have joined it; where that one is equal to it,
    also on what shows that the two are not the ends of a longer run: the
    symbols on both sides of them."""
    half = (_stir(sym ^ np.uint64((0xA0761D6478BD642F * r) & ((1 << 64) - 1))) >> np.uint64(63)).astype(bool)
    opens = np.append(~half[:-1] & half[1:], False)
    closes = np.concatenate(([False], opens[:-1]))
    same = np.append(sym[:-1] == sym[1:], False)  # equal to the next
    same_before = np.concatenate(([False], same[:-1]))
    lo1, lo2 = np.concatenate(([-1], lo))[:-1], np.concatenate(([-1, -1], lo))[:-2]
    hi1, hi2 = np.append(hi, n + 1)[1:], np.append(hi, [n + 1, n + 1])[2:]
    ext_lo = np.where(opens, np.minimum(lo, np.append(lo[1:], n)), np.where(
        half, np.where(same_before, np.minimum(lo1, lo2), lo1), np.where(same, lo1, np.minimum(lo, np.append(lo[1:], n)))))
    ext_hi = np.where(opens, hi1, np.where(
        half, np.where(same_before, hi1, np.maximum(hi, np.concatenate(([0], hi[:-1])))), np.where(same, np.maximum(hi1, hi2), hi1)))
    name = np.where(opens, _stir(_stir(sym) * np.uint64(3) + np.append(sym[1:], np.uint64(0))), sym)
    keep = ~closes
    return name[keep], np.minimum(lo, ext_lo)[keep], np.maximum(hi, ext_hi)[keep]


def window_hashes(word: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit and a 32-bit hash of every window."""
    n = max(0, len(word) - window + 1)
    a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    x, y = _stir(word), _stir(word ^ np.uint64(0xE7037ED1A0B428DB))
    for j in range(window):
        a = _stir(a + x[j : j + n])
        b = b * np.uint64(0x9FB21C651E98DF25) + y[j : j + n]
    return a.view(np.int64), (_stir(b) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _digest(words) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


class _Texts:
    """The texts of a batch as one string of word hashes. A symbol of its own
    follows each text, so no window that lies within a text sees another."""

    def __init__(self, column, seen: _Hashes):
        self.words = [(t.as_py() or b"").split() for t in column]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(self.counts + 1) - self.counts - 1
        self.string = np.empty(int(self.counts.sum()) + len(self.words), np.uint64)
        for k, w in enumerate(self.words):
            a = self.starts[k]
            self.string[a : a + len(w)] = np.fromiter(map(seen.__getitem__, w), np.uint64, len(w))
            self.string[a + len(w)] = _SEPARATOR + np.uint64(k)

    def windows(self, of: np.ndarray, k: int, window: int) -> np.ndarray:
        """The part of ``of``, a value for each window of the string, that belongs to text k."""
        return of[self.starts[k] : self.starts[k] + max(0, self.counts[k] - window + 1)]


def _first_pass(window):
    def run(batches):
        seen = _Hashes()
        for b in batches:
            x = _Texts(b.column(1), seen)
            best = anchors(x.string, window)
            keys = [np.unique(x.windows(best, k, window) >> _SHORT).view(np.int64) for k in range(len(x.words))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x.counts), pa.array([_digest(w) for w in x.words], pa.string()), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["doc_id", "n_words", "whole", "keys"])
    return run


def _second_pass(window):
    def run(batches):
        seen = _Hashes()
        for b in batches:
            x = _Texts(b.column(1), seen)
            best, (ha, hb) = (anchors(x.string, window) >> _SHORT).view(np.int64), window_hashes(x.string, window)
            out = [[], [], []]
            for k, (i, keys) in enumerate(zip(b.column(0), b.column(2))):
                shared = np.isin(x.windows(best, k, window), keys.values.to_numpy())
                h, at = np.unique(x.windows(ha, k, window)[shared], return_index=True)
                for c, v in zip(out, (np.full(len(h), i.as_py(), np.int64), h, x.windows(hb, k, window)[shared][at])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), kind) for c, kind in zip(out, (pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "ha", "hb"])
    return run


def _last_pass(window):
    def run(batches):
        seen = _Hashes()
        for b in batches:
            x = _Texts(b.column(1), seen)
            ha, _ = window_hashes(x.string, window)
            gone, kept = [], []
            for k, (w, hashes) in enumerate(zip(x.words, b.column(2))):
                at = np.flatnonzero(np.isin(x.windows(ha, k, window), hashes.values.to_numpy()))
                step = np.zeros(len(w) + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, at + window, -1)
                covered = np.cumsum(step)[:-1] > 0
                gone.append(int(covered.sum()))
                kept.append(_digest(v for v, c in zip(w, covered) if not c))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_digest(w) for w in x.words], pa.string()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             names=["doc_id", "whole", "n_removed", "kept_sha256"])
    return run


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``.

    A word goes if a window over it has a word sequence that also starts in a
    document with a smaller doc_id. Null and empty texts have no words; texts
    shorter than a window lose none. Rows without a doc_id are neither smaller
    nor larger than others: they lose nothing and cause no removal. Rows with
    one doc_id are parts of one document, which is not smaller than itself;
    repeated rows give a row each. doc_id must be an integer type. An empty
    table gives no rows; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    all_docs = written(texts.mapInArrow(_first_pass(window), "doc_id long, n_words long, whole string, keys array<long>"))
    live = all_docs.where(f"doc_id IS NOT NULL AND n_words >= {window}")
    classes = staged(live.groupBy("whole").agg(F.min("doc_id").alias("doc_id")))
    uses = live.select(F.xxhash64("whole").alias("class"), F.explode("keys").alias("key"))
    shared = uses.groupBy("key").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a < z").select("key")
    shared = staged(shared)
    uses = possibly_in(uses, shared, F.col("key")).where("maybe")
    suspects = uses.join(shared, "key").select("class", "key").distinct().groupBy("class").agg(F.collect_list("key").alias("keys"))  # of one text
    suspects = suspects.join(classes.select("doc_id", F.xxhash64("whole").alias("class")), "class")
    # two texts of one document are looked at with the anchors of both
    suspects = suspects.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("keys"))).alias("keys"))
    # hashing is what costs: made once, and of the second use only what may be in a window of two documents is shuffled
    windows = written(texts.join(suspects, "doc_id").select("doc_id", "t", "keys").mapInArrow(_second_pass(window), "doc_id long, ha long, hb int"))
    first = staged(windows.groupBy("ha", "hb").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("ha", "hb", "a"))
    again = possibly_in(windows, first.select(F.col("ha").alias("key")).distinct(), F.col("ha")).where("maybe")
    later = again.join(first, ["ha", "hb"]).where("doc_id > a").groupBy("doc_id").agg(F.collect_set("ha").alias("hashes"))
    cut = texts.join(later, "doc_id").select("doc_id", "t", "hashes").mapInArrow(_last_pass(window), "doc_id long, whole string, n_removed long, kept_sha256 string")
    return _result(all_docs, classes, cut)


def _result(all_docs: DataFrame, classes: DataFrame, cut: DataFrame) -> DataFrame:
    """Copies of a smaller document go whole; cut documents have their own
    counts; all others stay whole."""
    nothing = hashlib.sha256(b"").hexdigest()
    rows = all_docs.select("doc_id", "n_words", "whole").join(classes.select("whole", F.col("doc_id").alias("first")), "whole", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return rows.join(cut.distinct(), ["doc_id", "whole"], "left").select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat an earlier document's windows."""
    return dedup(documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, unnest(range(1, len(w) - 11)) AS p, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS k
      FROM d WHERE len(w) >= 13 AND doc_id IS NOT NULL),
f AS (SELECT k, min(doc_id) AS first FROM x GROUP BY k),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 13)) AS i FROM x JOIN f USING (k) WHERE first < doc_id),
n AS (SELECT r, count(*) AS n_removed FROM gone GROUP BY r),
word AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS s FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""
