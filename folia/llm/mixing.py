"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 48-bit hash. For a source, "all documents whose hash is
below t" is a uniform sample whose token count grows with t, so a token budget
is a threshold. The threshold is found without sorting documents: tokens are
summed by source and the first 12 hash bits, the bucket where the running sum
crosses the budget is the boundary bucket, and only that bucket is split by
the next 12 bits, down to one hash value. Budgets of one source nest: a source with a
target of 2.3 times its size takes every document twice, and the documents
below the threshold for 0.3 a third time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, documents, own_columns, session, staged, written

BITS = 12
LEVELS = 4
MAX_REPEAT = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
            max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(src, source_size) -> the same with ``target`` (double).

    Sources in code point order, null last, take the weights in turn. Targets
    share ``share`` of all sizes by weight; none exceeds ``max_repeat`` times
    its source's size. What a full source cannot take goes to the others by
    weight, which ends at one level L with target = min(max_repeat * size,
    L * weight): sources fill up in the order of max_repeat * size / weight,
    and L is the first level that the next source would not reach. One row per
    source is all this reads.
    """
    order = Window.orderBy(F.col("src").isNull(), F.col("src").cast("binary"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1)
    s = sizes.select("src", "source_size", weight.alias("w")).withColumn("cap", F.col("source_size") * max_repeat)
    s = s.withColumn("full_at", F.col("cap") / F.col("w"))
    fill = Window.orderBy("full_at", F.col("src").isNull(), F.col("src").cast("binary"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    s = (
        s.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") * share - F.col("cap_before")) / F.col("w_left"))
        .withColumn("place", F.row_number().over(fill))
        .withColumn("first_open", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("place", "level"))).over(Window.partitionBy()))
        .withColumn("L", F.col("first_open.level"))
    )
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("L") * F.col("w"), F.col("cap").cast("double")))
    return s.select("src", "source_size", target.alias("target"))


def bucket(h: Column, level: int) -> Column:
    """The ``level``-th group of BITS bits of a 48-bit hash."""
    return F.shiftrightunsigned(h, BITS * (LEVELS - 1 - level)).bitwiseAND((1 << BITS) - 1)


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(src, h, size) and (src, budget) -> (src, threshold): documents with
    h < threshold hold the tokens nearest to the budget.

    Each round sums tokens by source and bucket inside the boundary bucket of
    the round before: one row for each of at most 4,096 buckets and source.
    """
    state = written(budgets.select("src", F.col("budget").alias("need"), F.lit(0).cast("long").alias("prefix")))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - level)
        inside = rows.join(state.withColumnRenamed("src", "s"), F.col("src").eqNullSafe(F.col("s"))).where(
            F.shiftrightunsigned("h", shift) == F.shiftrightunsigned("prefix", shift)
        )
        hist = inside.groupBy("src", bucket(F.col("h"), level).alias("b"), "need", "prefix").agg(F.sum("size").alias("tokens"))
        run = Window.partitionBy("src").orderBy("b")
        cut = (
            hist.withColumn("upto", F.sum("tokens").over(run))
            .withColumn("below", F.col("upto") - F.col("tokens"))
            # the first bucket that reaches the budget; if none does, the last one
            .withColumn("last", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("b"))) == 1)
            .where((F.col("below") < F.col("need")) & ((F.col("upto") >= F.col("need")) | F.col("last")))
        )
        step = F.lit(1 << (BITS * (LEVELS - 1 - level))).cast("long")
        start = F.col("prefix") + F.col("b") * step
        if level < LEVELS - 1:
            state = written(cut.select("src", (F.col("need") - F.col("below")).alias("need"), start.alias("prefix")))
        else:  # a single hash value: take it if that comes nearer
            nearer = (F.col("upto") - F.col("need")) <= (F.col("need") - F.col("below"))
            return cut.select("src", F.when(nearer, start + 1).otherwise(start).alias("threshold"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, seed: int = 0) -> DataFrame:
    """How often the mix takes each document: (doc_id, src, size, source_size,
    target, copies, text_hash, h), a row for each input row.

    Null text: size 0. Null source: a source of its own, last in order. A
    null doc_id counts like any other value. Documents of size 0 are taken
    like their neighbours by hash (they add no words). Rows equal in id and
    text have one hash and are taken together. An empty table gives no rows;
    other columns are not read. The same rows and seed give the same mix.
    """
    size = F.when(F.col("__t").isNull(), 0).otherwise(F.regexp_count("__t", F.lit(WORD))).cast("long")
    text_hash = F.xxhash64("__t")
    h = F.xxhash64(F.lit(seed), "src", "doc_id", "text_hash").bitwiseAND((1 << (BITS * LEVELS)) - 1)
    rows = staged(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("src"), F.col(text_col).alias("__t"))
        .select("doc_id", "src", size.alias("size"), text_hash.alias("text_hash"))
        .withColumn("h", h)
    )
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    goal = written(targets(sizes, weights, share))
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)).cast("long")
    goal = goal.withColumn("whole", F.least(whole, F.lit(MAX_REPEAT)))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    cuts = thresholds(rows, goal.select("src", rest.alias("budget")).where("budget > 0"))
    plan = goal.join(cuts.withColumnRenamed("src", "s"), F.col("src").eqNullSafe(F.col("s")), "left").drop("s")
    # One row per source, in a file whose size tells Spark whether to broadcast it: nothing bounds their number.
    plan = written(plan.withColumnRenamed("src", "s"))
    extra = F.coalesce((F.col("h") < F.col("threshold")).cast("long"), F.lit(0))
    return (
        rows.join(plan, F.col("src").eqNullSafe(F.col("s")), "left")
        .select("doc_id", "src", "size", "source_size", "target", (F.col("whole") + extra).alias("copies"), "text_hash", "h")
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the
    words the mix takes from it (size times copies)."""
    m = mix(documents(spark, sf_dir))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents the mix takes, with the number of times
    each is to be repeated (``copies``) and the words that makes (``taken``).
    Columns of these names that the documents bring along are replaced.
    Documents of size 0, without an id or a source, and repeated rows are
    mixed as ``mix`` says; an empty table gives no rows."""
    session(spark)
    own = [c for c, name in zip(own_columns(docs), docs.columns) if name not in ("copies", "taken")]
    m = mix(docs).where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("src").alias("__src"), F.col("text_hash").alias("__hash"), F.col("copies").alias("__copies"), F.col("size").alias("__size")).distinct()
    on = docs["doc_id"].eqNullSafe(F.col("__id")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("__hash")) & docs["source"].eqNullSafe(F.col("__src"))
    return docs.join(m, on).select(*own, F.col("__copies").alias("copies"), (F.col("__size") * F.col("__copies")).alias("taken"))
