"""Phrase collocations by prefix-free parsing.

Counting every n-gram of a corpus where it stands counts repeated passages
again and again. Instead each piece of text is parsed into chunks: a window of
``max_words - 1`` words whose hash is a multiple of ``modulus`` ends a chunk
and begins the next, so chunks overlap in just that window and equal passages
give equal chunks wherever they stand. Spark groups the chunks into a
dictionary with parse frequencies; n-grams are counted inside the distinct
chunks, weighted by frequency. Every n-gram lies inside some chunk; one that
lies wholly inside an overlap would be met twice and belongs to the earlier
chunk.

Phrases are counted in two passes over the dictionary. The first adds up
2-grams by hash bucket, saturating at ``support``; a table of one bit for each of
``BUCKETS`` buckets (16 MB at any input size) says which reach it. The second
counts words exactly, and 2- to ``max_words``-grams all of whose 2-grams stand
in such buckets. Buckets only overestimate, so no phrase that reaches
``support`` is lost, and counts are sums by the phrase itself, never by hash.
"""

from __future__ import annotations

import itertools
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_value, documents, session, written

SUPPORT = 10
MODULUS = 16
#: Hash buckets of the 2-gram filter: RANGES ranges of 65,536.
RANGES = 1 << 11
BUCKETS = RANGES << 16
#: A task's partial counts are sent on when it has taken this many words.
FLUSH = 1 << 20
#: Rows of (lang, cut parts) are ranked in this many parts of a language before the last ranking.
SALTS = 64

_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if c in _PIECE_ENDS else 32 if c == 9 else c for c in range(256))
by_value(__name__)


class Names(dict):
    """Numbers of words by first sight, and their 64-bit hashes."""

    def __missing__(self, word: bytes) -> int:
        k = self[word] = len(self)
        return k

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        known = getattr(self, "_hashes", np.empty(0, np.uint64))
        if len(known) < len(self):
            new = [xxhash.xxh64_intdigest(w) for w in itertools.islice(self, len(known), None)]
            known = self._hashes = np.concatenate([known, np.array(new, np.uint64)])
        return known


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of ``x`` (uint64) reaches the high bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _rolled(h: np.ndarray, n: int, start=np.uint64(0)) -> np.ndarray:
    """Hash of the n-gram at every position that has n words after it."""
    m = len(h) - n + 1
    out = np.full(max(m, 0), start, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + max(m, 0)]
    return _mixed(out)


def parse(words: list[bytes], numbers: np.ndarray, hashes: np.ndarray, end: int, overlap: int, modulus: int):
    """Chunks of a token list in which the number ``end`` closes each piece:
    (first, past the last, does it continue the chunk before)."""
    n = len(numbers)
    stop = numbers == end
    ends = np.flatnonzero(stop)
    if not len(ends):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    opens = ~stop
    opens[1:] &= stop[:-1]
    # a trigger window has a further word of its piece after it
    inside = np.ones(max(0, n - overlap), bool)
    for j in range(overlap + 1):
        inside &= ~stop[j : j + len(inside)]
    trigger = inside & (_rolled(hashes[numbers], overlap)[: len(inside)] % np.uint64(modulus) == 0)
    goes_on = np.zeros(n, bool)
    goes_on[: len(trigger)] = trigger
    goes_on &= ~opens
    first = np.flatnonzero(opens | goes_on)
    past = ends[np.searchsorted(ends, first)]
    cont = goes_on[first]
    if len(first) > 1:
        past[:-1] = np.where(cont[1:], first[1:] + overlap, past[:-1])
    return first, past, cont


def _chunks(overlap: int, modulus: int, block: int = 4 << 20):
    def of(names, langs, texts):
        words, lengths = [], []
        for t in texts:
            w = list(filter(None, (t.translate(_FOLD) + b"\n").replace(b"\n", b" \n ").split(b" ")))
            words += w
            lengths.append(len(w))
        numbers = names.numbers(words)
        first, past, cont = parse(words, numbers, names.hashes(), names[b"\n"], overlap, modulus)
        doc = np.searchsorted(np.cumsum(lengths), first, side="right")
        joined = [b" ".join(words[a:z]) for a, z in zip(first.tolist(), past.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(doc)), pa.array(cont), pa.array(joined, pa.binary()).cast(pa.string())], names=["lang", "goes_on", "chunk"])

    def run(batches):
        names = Names()
        for batch in batches:
            langs, texts, size = [], [], 0
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                langs.append(lang)
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= block:
                    yield of(names, langs, texts)
                    langs, texts, size = [], [], 0
            if texts:
                yield of(names, langs, texts)
            if len(names) > FLUSH:
                names = Names()
    return run


def dictionary(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, modulus: int = MODULUS) -> DataFrame:
    """(lang, goes_on, chunk, freq): the distinct chunks, words joined by one
    space, and how often the parse has them."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("t"))
    found = rows.mapInArrow(_chunks(max_words - 1, modulus), "lang string, goes_on boolean, chunk string")
    return found.groupBy("lang", "goes_on", "chunk").agg(F.count("*").alias("freq"))


class _Block:
    """Dictionary rows as arrays: word numbers, the place inside the chunk,
    weight and language of every word."""

    def __init__(self):
        self.names, self.langs, self.parts, self.size = Names(), Names(), [], 0

    def add(self, batch, overlap: int) -> None:
        chunks = [c.split(b" ") for c in batch.column("chunk").cast(pa.binary()).to_pylist()]
        length = np.fromiter(map(len, chunks), np.int64, len(chunks))
        total = int(length.sum())
        numbers = self.names.numbers(list(itertools.chain.from_iterable(chunks)))
        begin = np.cumsum(length) - length
        place = np.arange(total) - np.repeat(begin, length)
        # n-grams that end inside the overlap belong to the chunk before
        owned_from = np.repeat(np.where(batch.column("goes_on").to_numpy(zero_copy_only=False), overlap, 0), length)
        lang = self.langs.numbers([x.encode() for x in batch.column("lang").to_pylist()])
        self.parts.append((numbers, np.repeat(length, length) - place, owned_from - place, np.repeat(batch.column("freq").to_numpy(), length), np.repeat(lang, length)))
        self.size += total

    def arrays(self):
        return [np.concatenate(x) for x in zip(*self.parts, strict=True)]


def _grams(left: np.ndarray, owned: np.ndarray, n: int) -> np.ndarray:
    """Is there an n-gram at each position (in its chunk, and its own)?"""
    return (left >= n) & (owned < n)


def _bucket(block: _Block, numbers, langs) -> np.ndarray:
    """Bucket of the 2-gram at every position but the last."""
    seed = block.langs.hashes()[langs[:-1]] if len(langs) else np.empty(0, np.uint64)
    return (_rolled(block.names.hashes()[numbers], 2, start=seed) >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def _blocks(batches, overlap):
    block = _Block()
    for batch in batches:
        if batch.num_rows:
            block.add(batch, overlap)
        if block.size >= FLUSH:
            yield block
            block = _Block()
    if block.size:
        yield block


def _tally(keys: np.ndarray, weights: np.ndarray):
    """Distinct keys, their summed weights, and each key's place among them."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    place = np.empty(len(k), np.int64)
    place[order] = np.cumsum(new) - 1
    return k[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0], place


def _bucket_sums(overlap: int, support: int):
    """Pass 1: for each block of words and range of buckets, the buckets met
    and their sums, held at ``support``: enough to tell which reach it."""
    kind = np.uint8 if support < 256 else np.uint32

    def run(batches):
        for block in _blocks(batches, overlap):
            numbers, left, owned, weight, lang = block.arrays()
            at = np.flatnonzero(_grams(left, owned, 2))
            met, total, _ = _tally(_bucket(block, numbers, lang)[at], weight[at])
            total = np.minimum(total, support).astype(kind)
            low = (met & 0xFFFF).astype(np.uint16)
            span, begin = np.unique(met >> 16, return_index=True)
            ends = [*begin[1:].tolist(), len(met)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(span, pa.int32()), pa.array([low[a:z].tobytes() for a, z in zip(begin.tolist(), ends, strict=True)], pa.binary()),
                 pa.array([total[a:z].tobytes() for a, z in zip(begin.tolist(), ends, strict=True)], pa.binary())], names=["span", "low", "total"])
    return run


def _bits(support: int):
    """Rows sorted by range -> the range's bits: buckets that reach support."""
    kind = np.uint8 if support < 256 else np.uint32

    def out(span, sums):
        return pa.RecordBatch.from_arrays([pa.array([span], pa.int32()), pa.array([np.packbits(sums >= support, bitorder="little").tobytes()], pa.binary())], names=["span", "bits"])

    def run(batches):
        span, sums = None, None
        for batch in batches:
            for s, low, total in zip(*(batch.column(c).to_pylist() for c in ("span", "low", "total")), strict=True):
                if s != span:
                    if span is not None:
                        yield out(span, sums)
                    span, sums = s, np.zeros(1 << 16, np.int64)
                at = np.frombuffer(low, np.uint16)  # each bucket once in a row
                sums[at] = np.minimum(sums[at] + np.frombuffer(total, kind), support)
        if span is not None:
            yield out(span, sums)
    return run


def _counts(shared, overlap: int):
    """Pass 2: partial counts of words, and of n-grams whose 2-grams all stand
    in buckets that reach the support; k = 0 counts all words."""
    def rows(lang, k, phrases, total):
        n = len(total)
        return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(np.full(n, k, np.int32)), phrases, pa.array(total, pa.int64())], names=["lang", "k", "phrase", "f"])

    def run(batches):
        table = np.frombuffer(shared.value, np.uint8)
        for block in _blocks(batches, overlap):
            numbers, left, owned, weight, lang = block.arrays()
            words = pa.array(list(block.names), pa.binary()).cast(pa.string())
            bucket = np.zeros(len(numbers), np.int64)
            bucket[:-1] = _bucket(block, numbers, lang)
            two = (left >= 2) & (table[bucket >> 3] >> (bucket & 7).astype(np.uint8) & 1 > 0)
            names = [x.decode() for x in block.langs]
            order = np.argsort(lang, kind="stable")
            # chunks stay whole: a language's words keep their order
            numbers, left, owned, weight, two = (x[order] for x in (numbers, left, owned, weight, two))
            for code, part in enumerate(np.split(np.arange(len(order)), np.searchsorted(lang[order], np.arange(1, len(names))))):
                if not len(part):
                    continue
                a, z = part[0], part[-1] + 1
                num, lf, ow, wt, tw = numbers[a:z], left[a:z], owned[a:z], weight[a:z], two[a:z]
                own = np.flatnonzero(_grams(lf, ow, 1))
                yield rows(names[code], 0, pa.array([""]), [int(wt[own].sum())])
                met, total, _ = _tally(num[own], wt[own])
                yield rows(names[code], 1, words.take(pa.array(met)), total)
                # n-grams grow word by word: number of the (n-1)-gram, then the next word
                at, gram, text = np.arange(len(num)), num, words
                for n in range(2, overlap + 2):
                    go = np.flatnonzero((lf[at] >= n) & tw[np.minimum(at + n - 2, len(num) - 1)])
                    at, gram = at[go], gram[go]
                    if not len(at):
                        break
                    met, _, gram = _tally(gram * len(words) + num[at + n - 1], wt[at])
                    text = pc.binary_join_element_wise(text.take(pa.array(met // len(words))), words.take(pa.array(met % len(words))), " ")
                    mine = np.flatnonzero(ow[at] < n)
                    total = np.zeros(len(met), np.int64)
                    np.add.at(total, gram[mine], wt[at[mine]])
                    keep = np.flatnonzero(total)
                    yield rows(names[code], n, text.take(pa.array(keep)), total[keep])
    return run


@contextmanager
def _arrow_rows(spark: SparkSession, rows: int):
    """Dictionary rows are narrow: larger Arrow batches while they are read."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def phrase_counts(chunks: DataFrame, *, max_words: int = 3, support: int = SUPPORT) -> DataFrame:
    """(lang, k, phrase, f), written: every phrase of 1 to ``max_words`` words
    with f >= ``support``, and a row of k = 0 with all words of the language."""
    spark = chunks.sparkSession
    with _arrow_rows(spark, 8192):
        sums = chunks.mapInArrow(_bucket_sums(max_words - 1, support), "span int, low binary, total binary")
        bits = sums.repartition("span").sortWithinPartitions("span").mapInArrow(_bits(support), "span int, bits binary")
        table = bytearray(BUCKETS >> 3)
        for r in bits.collect():  # at most RANGES rows of 8 KB
            table[r["span"] << 13 : (r["span"] + 1) << 13] = r["bits"]
        shared = spark.sparkContext.broadcast(bytes(table))
        part = chunks.mapInArrow(_counts(shared, max_words - 1), "lang string, k int, phrase string, f long")
        # already combined in the tasks: the only exchange is that of the sums
        whole = part.repartition("lang", "phrase").groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))
        counts = written(whole.where((F.col("k") == 0) | (F.col("f") >= support)))
        shared.destroy()
    return counts


def scored(counts: DataFrame, *, inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """Candidates of ``phrase_counts`` with their lowest-scoring cut, without
    those that a longer candidate explains, ranked: (lang, rank, phrase, a, l, r, n, score)."""
    grams = counts.where("k >= 1").select("lang", "phrase", "f")
    found = counts.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = found.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "*", F.expr("substring_index(phrase, ' ', cut)").alias("first"), F.expr("substring_index(phrase, ' ', cut - k)").alias("rest"))
    left = grams.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # 16 digits hold any count; a * a * 1000000 and l * r stay within 38
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", F.expr(
        "(cast(a AS decimal(16,0)) * cast(a AS decimal(16,0)) * 1000000BD) div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0)))"))
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    longer = found.where("k > 2").select("lang", "phrase", "k", "a").select(
        "*", F.explode(F.expr("flatten(transform(sequence(2, k - 1), n -> transform(sequence(0, k - n), i -> struct(i AS i, n AS n))))")).alias("s"))
    longer = longer.select("lang", F.array_join(F.slice(F.split("phrase", " "), F.col("s.i") + 1, F.col("s.n")), " ").alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("outer_f"))
    kept = worst.join(longer, ["lang", "phrase"], "left").where(f"outer_f IS NULL OR 100 * outer_f < {int(inside_percent)} * a")
    kept = kept.select("lang", "phrase", "a", "m.l", "m.r", "m.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("part"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]  # strings compare by their UTF-8 bytes
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return kept.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, support: int = SUPPORT,
                 inside_percent: int = 50, top: int = 2000, modulus: int = MODULUS) -> DataFrame:
    """The ``top`` collocations of every language: (lang, rank, phrase, a, l, r, n, score).

    ``a`` is the phrase's count, ``l`` and ``r`` are those of its parts at the
    cut with the lowest score floor(1000000 * a * a / (l * r)) (the earliest
    of equal ones), ``n`` all words of the language. Candidates have 2 to
    ``max_words`` words and a >= ``support``; one that lies inside a longer
    candidate with at least ``inside_percent`` of its count is left out. Equal
    scores rank by count, then by the phrase's bytes.

    Null and empty texts have no words. A null language is "und", together
    with rows of that name. Repeated rows and copies count each time. A very
    long text is parsed like any other, into chunks of its own pieces. Other
    columns are not read. Without a phrase of enough support, as in an empty
    table, there are no rows.
    """
    if not 2 <= max_words <= 8 or modulus < 1 or support < 1:
        raise ValueError("max_words must be 2 to 8, modulus and support at least 1")
    chunks = written(dictionary(docs, text_col=text_col, lang_col=lang_col, max_words=max_words, modulus=modulus))
    return scored(phrase_counts(chunks, max_words=max_words, support=support), inside_percent=inside_percent, top=top)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language of ``documents``."""
    return collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, w FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents))),
x AS (SELECT piece, lang, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM p WHERE len(w) > 0),
y AS (SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM x WINDOW o AS (PARTITION BY piece ORDER BY i)),
g AS (
  SELECT lang, 1 AS k, w AS phrase FROM y UNION ALL SELECT lang, 2, w || ' ' || w2 FROM y WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM y WHERE w3 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.phrase, c.a, v.j, l.f AS l, r.f AS r,
    (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN (VALUES (1), (2)) AS v(j) ON v.j < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:v.j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[v.j + 1:], ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
sub AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS outer_f
  FROM c CROSS JOIN (VALUES (1), (2)) AS v(i) WHERE k = 3 GROUP BY ALL)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT low.*, n.n, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(low.phrase)) AS rank
  FROM low JOIN n USING (lang) LEFT JOIN sub USING (lang, phrase)
  WHERE outer_f IS NULL OR 100 * outer_f < 50 * a)
WHERE rank <= 2000
"""
