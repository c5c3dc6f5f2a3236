"""Benchmark decontamination: Wu-Manber search for word windows.

Patterns are the windows of 10 words of the benchmark items (a shorter item is
one window of its own length); the symbols of the search are words. For each
window length m, a shift table over blocks of B words says how far the search
may jump from a block, a block that ends a pattern selects the bucket of the
patterns that end in it, and comparing the words confirms an occurrence. A
text without benchmark words is scanned in steps of m - B + 1 words.

The tables are built from the benchmark on each executor. Benchmarks are
small beside the corpus; where their texts exceed ``block_bytes``, they are
searched in blocks of that size, one pass over the texts for each, and the
hit ranges of a text are merged by the text's digest.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, session, staged

WINDOW = 10
BLOCK = 3
#: Every byte that is not a digit, letter or part of a non-ASCII character separates words.
_WORDS = bytes((c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32) for c in range(256))
by_value(__name__)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


class WuManber:
    """Search for the windows of benchmark items, given as (id, text)."""

    def __init__(self, items, window: int = WINDOW):
        by_length: dict[int, dict[tuple, set[str]]] = {}
        for item, text in items:
            w = words_of(text)
            m = min(window, len(w))
            for i in range(len(w) - m + 1 if m else 0):
                by_length.setdefault(m, {}).setdefault(tuple(w[i : i + m]), set()).add(item)
        self.tables = []
        for m, patterns in sorted(by_length.items()):
            b = min(BLOCK, m)
            shift: dict[tuple, int] = {}
            buckets: dict[tuple, list] = {}
            for p, owners in patterns.items():
                for end in range(b, m + 1):
                    block = p[end - b : end]
                    shift[block] = min(shift.get(block, m), m - end)
                buckets.setdefault(p[m - b :], []).append((p, owners))
            self.tables.append((m, b, shift, buckets))

    def search(self, w: list[bytes]):
        """Yields (start, length, item ids) of every occurrence."""
        n = len(w)
        for m, b, shift, buckets in self.tables:
            jump, end, get = m - b + 1, m, shift.get
            while end <= n:
                block = tuple(w[end - b : end])
                s = get(block, jump)
                if s:
                    end += s
                    continue
                found = tuple(w[end - m : end])
                for p, owners in buckets[block]:
                    if p == found:
                        yield end - m, m, owners
                end += 1


def _scan(shared, window):
    def run(batches):
        finder = WuManber(shared.value, window)
        for batch in batches:
            out = {"row": [], "n_words": [], "starts": [], "ends": [], "items": []}
            ids, texts = batch.column(0), batch.column(1)
            for text in texts:
                w = words_of(text.as_py())
                ranges, items = [], set()
                for start, m, owners in sorted(finder.search(w), key=lambda x: x[0]):
                    items.update(owners)
                    if ranges and start <= ranges[-1][1]:
                        ranges[-1][1] = max(ranges[-1][1], start + m)
                    else:
                        ranges.append([start, start + m])
                out["n_words"].append(len(w))
                out["starts"].append([a for a, _ in ranges])
                out["ends"].append([z for _, z in ranges])
                out["items"].append(sorted(items))
            out["row"] = ids
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(out["n_words"], pa.int64()), pa.array(out["starts"], pa.list_(pa.int64())),
                 pa.array(out["ends"], pa.list_(pa.int64())), pa.array(out["items"], pa.list_(pa.string()))],
                names=["row", "n_words", "starts", "ends", "items"])
    return run


_FOUND = "row {}, n_words long, starts array<long>, ends array<long>, items array<string>"


def _benchmark_blocks(bench: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Blocks of (item id, text), each of ``block_bytes`` of text at most (or
    one item). At least one block, if an empty one."""
    rows = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).cast("binary").alias("t")).where("t IS NOT NULL")
    block, size = [], 0
    for r in rows.toLocalIterator():  # one partition at a time; a block is all that is held
        if block and size + len(r["t"]) > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], bytes(r["t"])))
        size += len(r["t"])
    yield block


def contamination(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_bytes: int = 2 << 20) -> DataFrame:
    """(doc_id, n_words, n_hit, items) for every row of ``docs``; ``items`` is
    the sorted list of item ids (as strings) with a window in the text.

    Null and empty texts have no words and no hits; null or empty items have
    no windows. An item without an id counts under the id "null". Items with
    one id are one item, with the windows of each text. Repeated rows give a
    row each; other columns are not read. Without benchmark items nothing
    is hit.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("row"), F.col(text_col).cast("binary").alias("t"))
    shared = [spark.sparkContext.broadcast(b) for b in _benchmark_blocks(bench, item_col, item_text_col, block_bytes)]
    if len(shared) > 1:
        return _merged(rows, shared, window)
    found = rows.mapInArrow(_scan(shared[0], window), _FOUND.format(rows.schema["row"].dataType.simpleString()))
    hit = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("long"), lambda a, x: a + x["ends"] - x["starts"])
    return found.select(F.col("row").alias("doc_id"), "n_words", hit.alias("n_hit"), "items")


def _merged(rows: DataFrame, blocks, window) -> DataFrame:
    """Several blocks: hit ranges of each, merged by the text's digest (what
    is hit depends on the text alone), then joined to the rows."""
    keyed = rows.select("row", F.coalesce(F.sha2("t", 256), F.lit("")).alias("digest"), "t")
    one = None
    for shared in blocks:
        f = keyed.select(F.col("digest").alias("row"), "t").mapInArrow(_scan(shared, window), _FOUND.format("string"))
        f = f.where(F.size("items") > 0).select(F.col("row").alias("digest"), F.arrays_zip("starts", "ends").alias("z"), "items")
        one = f if one is None else one.unionByName(f)
    # copies of a text give equal rows: distinct before anything is collected
    hits = one.distinct().groupBy("digest").agg(F.array_sort(F.flatten(F.collect_list("z"))).alias("z"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    zero = F.lit(0).cast("long")
    run = F.aggregate("z", F.struct(zero.alias("n"), zero.alias("to")), lambda a, x: F.struct(
        (a["n"] + F.greatest(zero, x["ends"] - F.greatest(a["to"], x["starts"]))).alias("n"), F.greatest(a["to"], x["ends"]).alias("to")))
    hits = staged(hits.select("digest", run["n"].alias("n_hit"), "items"))
    counts = keyed.mapInArrow(_count, "row {}, digest string, n_words long".format(rows.schema["row"].dataType.simpleString()))
    out = counts.join(hits, "digest", "left")
    return out.select(F.col("row").alias("doc_id"), "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _count(batches):
    for batch in batches:
        n = [len(words_of(t.as_py())) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["row", "digest", "n_words"])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by every benchmark item."""
    c = contamination(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: removes the documents that hold a benchmark window.

    Contamination depends on the text alone, so documents are named by their
    text's digest: ids may be null or repeat."""
    session(spark)
    keyed = docs.select(F.sha2("text", 256).alias("digest"), "text")
    bad = contamination(keyed, documents(spark, sf_dir, "benchmark"), id_col="digest").where("n_hit > 0").select(F.col("doc_id").alias("__dirty")).distinct()
    return docs.join(bad, F.sha2(docs["text"], 256) == F.col("__dirty"), "left_anti")


_RE = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ITEM = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_RE}')"
ORACLE = f"""
WITH it AS (SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, {_ITEM} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT m, CAST(item_id AS VARCHAR) AS item, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS k FROM it),
d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM} AS w FROM documents),
x AS (SELECT r, m, unnest(range(1, len(w) - m + 2)) AS p, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS k
      FROM d CROSS JOIN (SELECT DISTINCT m FROM win) WHERE len(w) >= m),
hit AS (SELECT r, p, m, item FROM x JOIN win USING (m, k)),
words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + m)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.s, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
