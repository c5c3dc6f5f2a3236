"""Collocations, whitening and license scans against plain versions."""

import collections
import math

import numpy as np
import pytest

from folia.llm import collocations, common, licenses, whitening

from . import brute
from .conftest import DATA, ODD


@pytest.fixture(autouse=True)
def _settings(spark):
    common.session(spark)


# ---- collocations

COLS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
RANKED = [(r[2], r[1]) for r in ODD]


def _ranked(df):
    return sorted(map(tuple, df.select(*COLS).collect()))


@pytest.mark.parametrize("modulus", [1, 2, 16])
def test_collocations(spark, odd, none, modulus):
    docs = odd.unionByName(odd).unionByName(odd)
    assert _ranked(collocations.collocations(docs, modulus=modulus)) == brute.collocations(RANKED * 3)
    assert _ranked(collocations.collocations(odd, modulus=modulus, support=2, max_words=4, inside_percent=80, top=7)) == brute.collocations(RANKED, words=4, support=2, inside=80, top=7)
    assert collocations.collocations(none).count() == 0


def test_collocations_of_documents(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert _ranked(collocations.op11_collocations(spark, DATA)) == brute.collocations(docs)


def test_collocations_on_random_words(spark):
    rng = np.random.default_rng(5)
    rows = [(["x", "y", None][k % 3], "".join(f"{w}{s}" for w, s in zip(rng.choice(list("abcdeÉ😀"), 300), rng.choice([" ", "  ", "\t", ", ", ".\n"], 300, p=[0.5, 0.2, 0.1, 0.1, 0.1]), strict=True))) for k in range(30)]
    df = spark.createDataFrame(rows, "lang string, text string")
    for modulus in (2, 3, 7):
        assert _ranked(collocations.collocations(df, modulus=modulus)) == brute.collocations(rows)


def test_chunks_hold_each_place_once(spark):
    """Words, 2- and 3-grams counted over the dictionary are those of the text."""
    text = " ".join(np.random.default_rng(1).choice(list("abc"), 400))
    df = spark.createDataFrame([("en", text)], "lang string, text string")
    for modulus in (1, 2, 5):
        rows = collocations.dictionary(df, modulus=modulus).collect()
        assert modulus == 5 or max(r.freq for r in rows) > 1
        for n in (1, 2, 3):
            got = collections.Counter()
            for r in rows:
                w = r.chunk.split(" ")
                for k in range(len(w) - n + 1):
                    if not r.goes_on or k + n > 2:
                        got[tuple(w[k : k + n])] += r.freq
            w = text.split(" ")
            assert got == collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1))


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000
    counts = spark.createDataFrame([("en", 0, "", 9 * big), ("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 7)], "lang string, k int, phrase string, f long")
    (row,) = collocations.scored(counts).collect()
    assert row.score == 1000000 * (big - 7) ** 2 // (big * (big + 1)) and row.rank == 1


# ---- whitening

def _checked(rows, vectors, wanted=32, places=1e-8):
    """Rows of the operator against a dense eigen-decomposition."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    v = c.T @ c / n
    values, _ = np.linalg.eigh(v)
    values = values[::-1]
    k = int((values[:wanted] > 1e-13 * values[0]).sum())
    assert len(rows) == n * k and {r.n for r in rows} == {n}
    y = np.zeros((n, k))
    by = collections.defaultdict(list)
    for r in rows:
        by[r.vec_id].append(r)
    for i in range(n):
        assert {r.deviation for r in by[i]} == {sum(int(a) ** 2 for a in n * x[i] - s)}
        for r in by[i]:
            y[i, r.component - 1] = r.whitened
            assert math.isclose(r.explained, values[r.component - 1] / np.trace(v), rel_tol=1e-8)
    # each column is an eigenvector's projection: V w = e w for w = C'y / (n sqrt(e))
    w = c.T @ y / (n * np.sqrt(values[:k]))
    assert np.abs(v @ w - w * values[:k]).max() < places * values[0]
    assert np.abs(c @ w / np.sqrt(values[:k]) - y).max() < 1e-7
    assert np.abs(y.T @ y / n - np.eye(k)).max() < 1e-8
    assert max(r.identity_error for r in rows) < 1e-8


def test_whitening(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet").orderBy("vec_id").collect()
    got = whitening.op12_whitening(spark, DATA)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert [r.vec_id for r in e] == list(range(len(e)))
    _checked(got.collect(), [r.embedding for r in e])


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 3)) @ rng.standard_normal((3, 6))
    good = [list(map(float, v)) for v in np.repeat(base, 3, axis=0)] + [[0.0] * 6] * 5
    bad = [None, [], [1.0] * 5 + [None], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [1.0, 2.0]]
    df = spark.createDataFrame([(k, v, 1) for k, v in enumerate(good)] + [(1000 + k, v, 2) for k, v in enumerate(bad)], "vec_id long, embedding array<double>, x int")
    _checked(whitening.whiten(df).collect(), good)
    same = spark.createDataFrame([(k, [1.0, 2.0], 1) for k in range(4)] , "vec_id long, embedding array<double>, n int")
    assert whitening.whiten(same).count() == 0 == whitening.whiten(same.where("false")).count()


def test_whitening_with_equal_deviations(spark):
    """Equal eigenvalues end the chain early; it goes on outside of what it found."""
    square = [[float(s) if j == i else 0.0 for j in range(4)] for i in range(4) for s in (-1, 1)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(square)], "vec_id long, embedding array<double>")
    _checked(whitening.whiten(df).collect(), square)


def test_whitening_beyond_64_bits():
    x = np.array([[0], [1 << 40]], np.int64)
    assert whitening._deviation(x, 2, x.sum(axis=0)) == [None, None]
    x = np.array([[0], [1 << 31]], np.int64)
    assert whitening._deviation(x, 2, x.sum(axis=0)) == [1 << 62, 1 << 62]


# ---- licenses

def test_licenses(spark, odd, none, texts):
    key = lambda r: tuple(map(str, r))
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = [(r[0], r[1]) for r in ODD] + [
        (90, "The MIT\nLicense, apache-license MIT LICENSE gnu General  Public\tLicense"), (91, "mit licensé mit  license"), (92, "worK mit-license " * 3000), (93, "license mit"), (93, "license mit")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS words", "2 AS row", "3 AS n_words", "4 AS block")
    got = licenses.scan(df).selectExpr("doc_id", "n_words", "phrases")
    want = brute.phrases(rows, licenses.PHRASES)
    found = [(r.doc_id, r.n_words, sorted((p.label, list(p.places)) for p in r.phrases)) for r in got.collect()]
    merged = []
    for i, n, ps in found:
        by = collections.defaultdict(set)
        for label, places in ps:
            assert not by[label] & set(places)  # a place belongs to one block
            by[label] |= set(places)
        merged.append((i, n, sorted((k, sorted(v)) for k, v in by.items())))
    assert sorted(merged, key=key) == sorted(want, key=key)
    assert licenses.scan(none).count() == 0
    assert licenses.scan(odd, templates=[], phrases=[]).where("size(notices) + size(phrases) > 0").count() == 0
    table = licenses.op13_licenses(spark, DATA).select(*cols).collect()
    plain = brute.phrases(texts, licenses.PHRASES)
    assert sorted(map(tuple, table), key=key) == sorted(((i, n, sum(len(p) for _, p in ps), min((p[0] for _, p in ps), default=None), max((p[-1] for _, p in ps), default=None),
                                                          ",".join(k for k, _ in ps)) for i, n, ps in plain), key=key)


def test_notices_are_those_of_all_pairs(spark):
    """Prefix, length and position filters lose no block that meets a template."""
    rng = np.random.default_rng(8)
    said = [t for _, t, _ in licenses.TEMPLATES]
    rows = []
    for k in range(60):
        w = list(rng.choice(["the", "of", "mit", "by", "nd", "under", "license", "x", "y", "z"], 150))
        for _ in range(3):
            t = licenses.tokens(said[rng.integers(len(said))])
            for _ in range(rng.integers(0, 3)):
                t[rng.integers(len(t))] = "other"
            at = rng.integers(0, 150)
            w[at:at] = t
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, n.block, n.label, round(n.containment, 9)) for r in licenses.scan(df).collect() for n in r.notices}
    want = brute.notices(rows, licenses.TEMPLATES, licenses.PHRASES, licenses.THRESHOLD)
    assert got == want and len(got) > 100


def test_templates_are_bounded(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        licenses.scan(df, templates=[("x", "a " * (licenses.MAX_TEMPLATE_WORDS + 1), "")])
