"""SimHash near-duplicates with vantage-point trees.

A vantage-point tree splits fingerprints by their Hamming distance to a
vantage point: those within the radius, those beyond. A ball of radius r
around a query reaches a side only if the triangle bound lets it (d - r <=
radius for the inner, d + r > radius for the outer side). The top of the tree
is fitted on a bounded sample and its leaves are the shards of a Spark
shuffle; a fingerprint lives in one shard and is sent as a query to the others
that its ball overlaps. Inside a shard the tree goes on down to small leaves,
where whole fingerprints are compared exactly.

On 64 random bits, distances crowd around 32 with a deviation of 4, so a ball
of radius 4 reaches both sides of nearly every split. The trees therefore
measure distance on bands of the bits: two fingerprints within 4 bits differ
by at most 1 bit on one of three bands, so three trees, each over one band and
with radius 1, find every pair, and the triangle bounds prune nearly
everything else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_value, documents, own_columns, session, staged, written

SHINGLE = 4
MAX_BITS = 4
#: Fingerprints that fit the top of the trees, and fingerprints aimed at in a shard.
SAMPLE = 16384
SHARD = 8192
LEAF = 64
#: Shingles hashed at a time, which bounds memory on very long texts.
CHUNK = 1 << 16
by_value(__name__)


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles of the lower-cased (A-Z) words; 0 without words."""
    words = text.lower().split() if text else []  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    k = min(shingle, len(words))
    total, n = np.zeros(64, np.int64), len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    for a in range(0, n, CHUNK):
        part = words[a : min(n, a + CHUNK) + k - 1]
        h = np.fromiter((digest(b" ".join(s), 42) for s in zip(*(part[i:] for i in range(k)))), np.uint64)
        total += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), fp as the signed 64-bit value."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("t"))

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# --------------------------------------------------------- vantage-point trees

def bands(max_bits: int) -> list[tuple[int, int]]:
    """(mask, radius) of each band: of two fingerprints within ``max_bits``,
    one band differs by at most its radius. Radius 1, with as few bands as that allows."""
    n = max(1, (max_bits + 2) // 2)  # n * 2 > max_bits
    edges = [64 * i // n for i in range(n + 1)]
    return [(((1 << (b - a)) - 1) << a, max_bits // n) for a, b in zip(edges, edges[1:])]


def _bits(x):
    return np.bitwise_count(x)


def grow(points: np.ndarray, leaf: int) -> list[tuple]:
    """A tree over ``points``: nodes (vantage, radius, inner, outer), children
    as node numbers, leaves as ~leaf number. Stops at ``leaf`` points or when
    no vantage point tells the rest apart."""
    nodes: list = []
    n_leaves = 0
    todo = [(points, None, None)]
    while todo:
        p, parent, side = todo.pop()
        split = None
        if len(p) > leaf:
            for v in (p[0], p[len(p) // 2], ~p[0]):
                d = _bits(p ^ v)
                r = int(np.median(d))
                inner = d <= r
                if inner.all():
                    r -= 1
                    inner = d <= r
                if inner.any() and not inner.all() and (split is None or d.std() > split[3]):
                    split = (v, r, inner, d.std())
        me = len(nodes) if split else ~n_leaves
        if parent is not None:
            nodes[parent][side] = me
        if split:
            v, r, inner, _ = split
            nodes.append([v, r, None, None])
            todo += [(p[inner], me, 2), (p[~inner], me, 3)]
        else:
            n_leaves += 1
    return nodes


def route(nodes: list, q: np.ndarray, r: int):
    """Yields (leaf, indices into q, home) for the leaves that the balls of
    radius r around q reach; ``home`` marks where a point itself belongs."""
    todo = [(0 if nodes else ~0, np.arange(len(q)), np.ones(len(q), bool))]
    while todo:
        node, at, home = todo.pop()
        if not len(at):
            continue
        if node < 0:
            yield ~node, at, home
            continue
        v, radius, inner, outer = nodes[node]
        d = _bits(q[at] ^ v).astype(np.int16)
        i, o = d - r <= radius, d + r > radius
        todo.append((inner, at[i], (home & (d <= radius))[i]))
        todo.append((outer, at[o], (home & (d > radius))[o]))


class _Union:
    """Classes of points under links, as an array of each point's smallest."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def link(self, members: np.ndarray) -> None:
        roots = np.unique(self.of[members])
        if len(roots) > 1:
            self.of[np.isin(self.of, roots[1:])] = roots[0]


def linked(fp: np.ndarray, home: np.ndarray, mask: int, radius: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one shard, as pairs (point, smallest point of its class).

    All pairs of a home point and any other within ``max_bits`` are found;
    given back is a spanning set of them, at most one for each point.
    """
    order = np.argsort(fp)
    fp, home = fp[order], home[order]
    classes = _Union(len(fp))
    at_home, m = np.flatnonzero(home), np.uint64(mask)
    band = fp & m
    nodes = [[v & m, *rest] for v, *rest in grow(band[at_home], LEAF)]
    lives: dict[int, np.ndarray] = {}
    for leaf, at, _ in route(nodes, band[at_home], 0):
        lives[leaf] = at_home[at]
    for leaf, at, _ in route(nodes, band, radius):
        own = lives.get(leaf)
        if own is None:
            continue
        step = max(1, (1 << 22) // len(at))
        for a in range(0, len(own), step):
            rows = own[a : a + step]
            near = _bits(fp[rows][:, None] ^ fp[at][None, :]) <= max_bits
            for k in np.flatnonzero(near.sum(axis=1) > 1):
                classes.link(np.append(at[near[k]], rows[k]))
    away = np.flatnonzero(classes.of != np.arange(len(fp)))
    return fp[away], fp[classes.of[away]]


def _shards(trees):
    """Rows (fp) -> (shard, fp, home), a row for each shard a fingerprint reaches."""
    def emit(fp):
        for b, (mask, radius, nodes) in enumerate(trees):
            band = fp & np.uint64(mask)
            for leaf, at, home in route(nodes, band, radius):
                shard = np.full(len(at), leaf * len(trees) + b, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(fp[at].view(np.int64)), pa.array(home)], names=["shard", "fp", "home"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            n += len(held[-1])
            if n >= 1 << 16:
                yield from emit(np.concatenate(held))
                held, n = [], 0
        if held:
            yield from emit(np.concatenate(held))
    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(fp), distinct -> (a, b): links that span the classes of fingerprints
    within ``max_bits``, found exactly."""
    spark = distinct.sparkSession
    n = distinct.count()
    some = distinct.select("fp").orderBy(F.xxhash64("fp")).limit(sample).collect()
    points = np.array([r.fp for r in some], np.int64).view(np.uint64)
    per_leaf = max(8, len(points) * shard // max(1, n))  # sample points that stand for a shard
    trees = []
    for mask, radius in bands(max_bits):
        m = np.uint64(mask)
        trees.append((mask, radius, [[v & m, *rest] for v, *rest in grow(points & m, per_leaf)]))
    routed = distinct.select("fp").mapInArrow(_shards(trees), "shard long, fp long, home boolean")
    rule = [(mask, radius) for mask, radius, _ in trees]

    def solve(table: pa.Table) -> pa.Table:
        k = table.column("shard")[0].as_py()
        mask, radius = rule[k % len(rule)]
        fp = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        a, b = linked(fp, home, mask, radius, max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return routed.groupBy("shard").applyInArrow(solve, "a long, b long")


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root), for every node with a link; root is the
    smallest node of its component.

    Alternating large-star and small-star rounds: each node's neighbours move
    to its smallest neighbour until nothing changes, in a number of rounds
    that grows with the logarithm of the component size. Joins, not windows,
    spread a node with very many neighbours.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    e = staged(edges.where("a <> b").select(big.alias("a"), small.alias("b")).distinct())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        e = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()  # large star
        low = e.groupBy("a").agg(F.min("b").alias("low"))
        e = e.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("x"))
        e = staged(e.select("x.*").where("a <> b").distinct())  # small star
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select("b", "b").distinct().toDF("node", "root"))
        mark = now


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id, root) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links of ``max_bits``
    or fewer differing bits. Null, empty and blank texts have fingerprint
    zero and are linked like any other. A null doc_id counts for links but
    names no component; a component of null ids only has a null id. root is
    the smallest fingerprint of the component and tells components apart
    where ids repeat or are null. Rows with
    equal texts are one point of the search, however many they are; repeated
    rows give a row each. An empty table gives no rows, and other columns are
    not read.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle))
    return fps.join(_classes(fps, F.col("doc_id"), max_bits), "fp").select("doc_id", "fp", "component_id", "root")


def _classes(fps: DataFrame, doc_id: Column, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id, root) for every fingerprint of ``fps``."""
    distinct = staged(fps.groupBy("fp").agg(F.min(doc_id).alias("first")))
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(smallest, "root").select("fp", "component_id", "root")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    near = near_duplicates(documents(spark, sf_dir))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates one row stays, the one
    with the smallest id, null ids last.

    Rows are judged, not ids: rows with one id and unrelated texts are in
    groups of their own, and rows without an id are like any other. Where
    several rows of a group have its smallest id, the one with the smallest
    values of all columns stays.
    """
    session(spark)
    # a row's number has to be written, or a repeated task could number its rows anew
    rows = written(docs.select(F.monotonically_increasing_id().alias("nr"), F.struct(*own_columns(docs)).alias("x")))
    fps = staged(fingerprints(rows.select(F.struct("nr", "x.doc_id").alias("doc_id"), F.col("x.text").alias("text"))))
    low = fps.join(_classes(fps, F.col("doc_id.doc_id")), "fp").where("doc_id.doc_id <=> component_id").select("doc_id.nr", "root")
    count = staged(low.groupBy("root").agg(F.count("*").alias("rows"), F.min("nr").alias("nr")))
    one = rows.join(count.where("rows = 1").select("nr"), "nr", "left_semi").select("x")
    tied = low.join(count.where("rows > 1").select("root"), "root")
    several = rows.join(tied, "nr").groupBy("root").agg(F.min("x").alias("x")).select("x")
    return one.unionByName(several).select("x.*")
