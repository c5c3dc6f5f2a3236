"""Costly expressions stand once in a plan, and jobs carry what they need."""

from folia.operators import assemble as A
from folia.operators import outline as O
from folia.operators import sections as S
from folia.operators.shred import shred
from folia.plans import fixtures
from folia.sources import pagejson as J

HTML = (
    "<html><head><title>T</title><link rel='canonical' href='https://a.example/page/T'></head><article><h1>T</h1><p>i</p>"
    "<dl><dt>k</dt><dd>v</dd></dl><figure><img src='/i.png'><figcaption> c  d </figcaption></figure><h2>S</h2><p>x <a href='/y'>y</a></p>"
    "<h2>References</h2><ol><li>r <a href='/z'>z</a></li></ol></article></html>"
)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def pages(spark):
    return spark.createDataFrame([(1, "https://a.example/page/T", HTML), (1, None, HTML), (2, None, None), (None, "u", "<p>x")], "page_id long, url string, html string")


def test_a_frame_of_some_columns_has_the_whole_frames_values(spark):
    whole = A.corpus_frame(pages(spark))
    for column in ("canonical_url", "infobox", "links", "lead_figure", "payloads", "hits"):
        want = sorted(map(str, whole.select("page_id", column, "quarantine").collect()))
        assert sorted(map(str, A.corpus_frame(pages(spark), column).collect())) == want


def test_titles_need_no_blocks(spark):
    made = plan(A.corpus_frame(pages(spark), "canonical_url").where("quarantine IS NULL"))
    assert "srcset" not in made  # only the figures of blocks read it


def test_outline_sections_and_documents_are_read_once(spark):
    docs = spark.createDataFrame([(1, "{}")], "page_id long, json string")
    accepted = J.page_json_read(docs).where("error IS NULL")
    assert plan(accepted).count("parseJson(json") == 1
    records = A.page_records(A.corpus_frame(pages(spark)))
    for made in (plan(O.outline_rows(accepted)), plan(S.target_rows(records))):
        assert "Filter ((size(" not in made and "Filter (size(" not in made


def test_fixture_rows_are_dealt_into_all_partitions(spark, tmp_path):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(200).selectExpr("id AS c_custkey", "'n' AS c_name").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    made = fixtures.r6_documents(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() == n and made.count() == 200
    assert shred(pages(spark), 3).rdd.getNumPartitions() == 3


def test_text_rules_are_pythons_and_cheap(spark):
    from folia.functions import nodes as N
    from folia.functions import text as T
    from folia.functions import urls as U

    texts = ["", " ", "a", " a  b ", "a b", "\x1c　a\t\tb\x85", "a​b", "a b", "\U0001f600  x ", "\x7f \x00"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", T.ws_normalize("t"), T.py_strip("t")).collect()
    assert [tuple(r) for r in got] == [(t, " ".join(t.split()), t.strip()) for t in texts]
    words = spark.createDataFrame([("KEYWORDS",), ("Keywords",), ("keyword",), ("references",)], "t string")
    for word in ("keywords", "references"):
        assert words.where(f"{N.reads_as('t', word)} <> (lower(t) = '{word}')").count() == 0
    assert "regexp" not in T.py_strip("t")
    assert U.resolve_with("b", "r").count("lower(substring_index(r") == 1


def test_a_sections_fields_are_read_in_one_go(spark):
    assert "'$.subsections', 'array" not in O.faulty_sections("v", "json") + O.outline()
    faults = {
        "{}": False, '{"media":null,"subsections":null,"level":"3"}': False, '{"subsections":[{"subsections":[]}]}': False,
        "7": True, "null": True, "[]": True, '{"media":{}}': True, '{"subsections":7}': True, '{"level":null}': True, '{"level":"x"}': True,
        '{"subsections":[{"subsections":[{"media":1}]}]}': True,
    }
    docs = spark.createDataFrame([(k, f'[{{"subsections":[{doc}]}}]') for k, doc in enumerate(faults)], "k int, json string")
    judged = docs.selectExpr("k", f"{O.faulty_sections('parse_json(json)', 'json')} AS bad").sort("k").collect()
    assert [r.bad for r in judged] == list(faults.values())
