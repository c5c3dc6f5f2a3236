"""The pipeline, stage by stage, against plain versions of its decisions."""

import collections

import pytest

import corpus_pipeline
from folia.llm import classifier, mixing, pii

from . import brute
from .conftest import DATA


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before and after each stage, written and read as the stages see them."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
    assert steps[-1].columns == [*steps[0].columns, "copies", "taken"]


def test_rejected_documents_go(spark, steps):
    verdict = classifier.classify(steps[0], spark.read.parquet(f"{DATA}/labels.parquet"))
    assert ids(steps[1]) == sorted(r.doc_id for r in verdict.where("NOT rejected").select("row.doc_id").collect())


def test_one_document_of_each_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[1].collect()]
    assert ids(steps[2]) == sorted({c for _, _, c in brute.simhash(rows)})


def test_contaminated_documents_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    clean = [i for i, _, hit, _ in brute.contamination([(r.doc_id, r.text) for r in steps[2].collect()], items) if not hit]
    assert ids(steps[3]) == sorted(clean)


def test_spans_are_cut_out(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    found = {r.doc_id: [(x[1], x[2], pii.KINDS[x[0]]) for x in [*r.base, *r.added]] for r in pii.find(steps[3]).collect()}
    for r in steps[4].collect():
        text, to = "", 0
        for s, e, kind in sorted(found[r.doc_id]):
            if s >= to:
                text += before[r.doc_id][to:s] + f"<{kind}>"
            to = max(to, e)
        assert r.text == text + before[r.doc_id][to:] and r.n_chars == len(r.text)


def test_the_mix_nears_its_targets(spark, steps):
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in steps[4].collect():
        n = len(brute.SPACED.findall(r.text))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in steps[5].collect():
        assert 1 <= r.copies <= mixing.MAX_REPEAT and r.taken == r.copies * len(brute.SPACED.findall(r.text))
        taken[r.source] += r.taken
    for source, goal in brute.targets(dict(sizes)).items():
        assert abs(taken[source] - goal) <= largest[source]


def test_run_gives_the_last_stage(spark, steps):
    got = sorted((r.doc_id, r.copies) for r in corpus_pipeline.run(spark, DATA).select("doc_id", "copies").collect())
    assert got == sorted((r.doc_id, r.copies) for r in steps[-1].select("doc_id", "copies").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_names(spark, odd, none, name):
    """Nulls, empty, long and repeated texts, an empty table, names that clash or hold dots and backticks."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd.selectExpr("*", "7 AS `a.b`", "8 AS `c``d`", "'x' AS `doc_id.x`", "9 AS taken", "10 AS d", "11 AS x", "12 AS nr", "13 AS root")
    got = stage(spark, docs, DATA)
    last = name == corpus_pipeline.STAGES[-1][0]
    names = [c for c in docs.columns if c not in ("copies", "taken")] + ["copies", "taken"] if last else docs.columns
    assert got.columns == names
    rows = got.collect()
    assert {tuple(r.asDict()[c] for c in ("a.b", "c`d", "doc_id.x", "d")) for r in rows} <= {(7, 8, "x", 10)}
    ids = collections.Counter(r.doc_id for r in rows)
    given = collections.Counter(r.doc_id for r in docs.collect())
    assert not ids - given
    if name in ("PII", "benchmark decontamination"):
        assert ids == given
    assert stage(spark, none.selectExpr("*", "7 AS `a.b`"), DATA).count() == 0
