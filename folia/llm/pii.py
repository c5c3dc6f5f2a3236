"""Personal data: four regular expressions, and identifiers found by context.

Base spans (email, ip, card, phone) are leftmost, non-overlapping matches with
their checks. Bootstrapping then looks for identifiers no expression knows.
Seeds are the base matches, tokens of a published key format, and half of the
other key-like values, chosen by their hash; the other half is held back: it
counts neither for nor against a pattern, and how much of it the patterns
find is their recall. A pattern is the word and the punctuation before an
instance ("password=", 'token = "'); a bipartite graph joins patterns and
instances. In each round a pattern is scored by the share of its decided
instances that are believed to be of one kind, patterns with enough instances
and a high share are accepted, and their instances become believed (noisy-or
over their patterns) and vote for further patterns. Seeds are spans, and so
are the identifier-like tokens after an accepted pattern; a held-back token
is one only where a pattern finds it.

Everything is DataFrame expressions. A match's place is the length of all
pieces before it: ``split`` gives the pieces between matches,
``regexp_extract_all`` the matches. The expressions below differ from the
plain ones only in what cannot change a match: possessive repeats and a
look-behind that starts a match at the start of a run, so long runs stay
linear.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, let, own_columns, session, staged

_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: An identifier-like token: ASCII letters and digits, at least six, at least one digit.
TOKEN = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])([A-Za-z0-9]{6,}+)"
# Fixed value: published formats of access keys, seeds of the kind "secret".
FORMATS = r"^(?:AKIA|ASIA)[0-9A-Z]{16}$"
#: Other key-like tokens: every second value is a seed, the rest is held back.
KEY_LIKE = r"^(?=.*[0-9])(?=.*[A-Za-z])(?:[0-9a-f]{16,}|[0-9A-Z]{16,})$"
SEED_PARTS = 2
#: What stands before an instance, read backwards: other characters, then a word.
CONTEXT = r"\A([^\p{L}\p{N}_]++)([\p{L}_]++)"

KINDS = ("email", "ip", "card", "phone", "secret")
#: A pattern needs so many instances, so many of them decided, and this share of believed ones.
MIN_INSTANCES = 5
MIN_DECIDED = 3
MIN_SHARE = 0.8
_BLOCK = 256
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP_OK = rf"^{_PART}(?:\.{_PART}){{3}}$"
_SPAN = "struct<s:bigint,e:bigint,v:string,before:string>"


def _luhn(digits: Column) -> Column:
    rev = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(rev, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _starts(step: Column, first: Column) -> Column:
    """Running sums: ``first`` + all of ``step`` before each place. In blocks,
    so that appending stays cheap for very many matches."""
    n_blocks = F.ceil(F.size(step) / F.lit(_BLOCK)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.slice(step, b * _BLOCK + 1, _BLOCK))
    empty = F.array().cast("array<bigint>")

    def running(values: Column, start: Column) -> Column:
        acc = F.struct(empty.alias("at"), start.cast("bigint").alias("to"))
        return F.aggregate(values, acc, lambda a, x: F.struct(F.concat(a["at"], F.array(a["to"])).alias("at"), (a["to"] + x).alias("to")))["at"]

    zero = F.lit(0).cast("bigint")
    return let(blocks, lambda bs: F.flatten(F.zip_with(
        bs, running(F.transform(bs, lambda b: F.aggregate(b, zero, lambda a, x: a + x)), first), running)))


def matches(text: Column, regex: str, group: int = 0) -> Column:
    """All matches as structs (s, e, v, gap): code points from s, to e; ``v``
    the group's text; ``before``, backwards, the word and the punctuation
    since the match before."""
    def placed(m: Column) -> Column:
        return let(F.split(text, regex, -1), lambda gaps: located(m, gaps))

    def located(m: Column, gaps: Column) -> Column:
        step = F.zip_with(F.transform(m, lambda x: F.length(x).cast("bigint")), F.transform(F.slice(gaps, 2, F.size(m)), lambda g: F.length(g).cast("bigint")), lambda a, b: a + b)
        values = m if group == 0 else F.regexp_extract_all(text, F.lit(regex), F.lit(group))
        at = _starts(step, F.length(F.element_at(gaps, 1)).cast("bigint"))
        return F.zip_with(F.zip_with(m, at, lambda x, s: F.struct(s.alias("s"), (s + F.length(x)).alias("e"))),
                          F.zip_with(values, F.slice(gaps, 1, F.size(m)), lambda v, g: F.struct(v.alias("v"), F.regexp_extract(F.reverse(g), CONTEXT, 0).alias("before"))),
                          lambda a, b: F.struct(a["s"].alias("s"), a["e"].alias("e"), b["v"].alias("v"), b["before"].alias("before")))

    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(placed(m)))


def base(text: Column) -> dict[str, Column]:
    """The base spans of each kind, matches that fail their check dropped."""
    digits = lambda x: F.regexp_replace(x["v"], "[^0-9]", "")
    none = F.array().cast(f"array<{_SPAN}>")
    return {
        "email": F.when(F.contains(text, F.lit("@")), matches(text, EMAIL)).otherwise(none),
        "ip": F.filter(matches(text, IP), lambda x: x["v"].rlike(_IP_OK)),
        "card": F.filter(matches(text, CARD), lambda x: F.when(F.length(x["v"]) > 37, False).otherwise(
            let(digits(x), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False)))),
        "phone": F.when(F.contains(text, F.lit("+")), F.filter(matches(text, PHONE), lambda x: F.length(digits(x)).between(8, 15))).otherwise(none),
    }


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, base, tokens): base spans with their kind and
    identifier-like tokens outside them, each with what stands before it.
    ``row`` numbers the rows; the frame is written once, so it stays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = lambda x, k: F.reverse(F.regexp_extract(x["before"], CONTEXT, k))
    context = lambda x: F.struct(F.lower(part(x, 2)).alias("word"), part(x, 1).alias("mark"))
    span = lambda x, kind: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.xxhash64(F.lower(x["v"])).alias("v"), context(x).alias("c"), F.lit(False).alias("held"))
    found = base(text)
    spans = F.concat(*[F.transform(found[k], partial(lambda kind, x: span(x, kind), n)) for n, k in enumerate(KINDS[:4])])
    tokens = F.filter(matches(text, f"(?:{EMAIL})|{TOKEN}", 1), lambda x: F.length(x["v"]) > 0)  # addresses hold no tokens
    value = lambda x: F.xxhash64(F.lower(x["v"]))
    half = lambda x: F.pmod(value(x), F.lit(SEED_PARTS)) == 0
    seed = lambda x: F.when(x["v"].rlike(FORMATS) | (x["v"].rlike(KEY_LIKE) & half(x)), KINDS.index("secret"))
    tokens = F.transform(tokens, lambda x: F.struct(seed(x).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), value(x).alias("v"), context(x).alias("c"),
                                                    (x["v"].rlike(KEY_LIKE) & ~x["v"].rlike(FORMATS) & ~half(x)).alias("held")))
    return staged(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), spans.alias("base"), tokens.alias("tokens")))


def bootstrap(found: DataFrame, min_instances: int = MIN_INSTANCES, min_share: float = MIN_SHARE) -> DataFrame:
    """Accepted patterns (word, mark, kind, share) of the entities found.

    Edges of the graph are distinct (pattern, instance) pairs, so copies of a
    document add nothing. A pattern's share for a kind is the mean belief, in
    that kind, of its decided instances: all but held-back ones that nothing
    speaks for. Rounds go on until the accepted patterns are those of an
    earlier round.
    """
    both = found.select(F.explode(F.concat("base", "tokens")).alias("x")).where("x.c.word <> ''")
    edges = staged(both.select("x.c.word", "x.c.mark", "x.v", "x.kind", "x.held").groupBy("word", "mark", "v").agg(F.min("kind").alias("kind"), F.min("held").alias("held")))
    seeds = staged(edges.where("kind IS NOT NULL").groupBy("v").agg(F.min("kind").alias("kind")).select("v", "kind", F.lit(1.0).alias("belief")))
    many = edges.groupBy("word", "mark").agg(F.count("*").alias("n"), F.sum((~F.col("held")).cast("int")).alias("told")).where(F.col("n") >= min_instances)
    many, held, edges = staged(many), edges.where("held").select("word", "mark", "v"), edges.select("word", "mark", "v")
    belief, met = seeds, set()
    while True:
        votes = edges.join(belief, "v").groupBy("word", "mark", "kind").agg(F.sum("belief").alias("b"))
        spoken = held.join(belief.select("v").distinct(), "v").groupBy("word", "mark").agg(F.count("*").alias("more"))
        decided = many.join(spoken, ["word", "mark"], "left").select("word", "mark", (F.col("told") + F.coalesce("more", F.lit(0))).alias("decided"))
        accepted = votes.join(decided.where(F.col("decided") >= MIN_DECIDED), ["word", "mark"]).select("word", "mark", "kind", (F.col("b") / F.col("decided")).alias("share"))
        accepted = staged(accepted.where(F.col("share") >= min_share))
        mark = tuple(accepted.agg(F.count("*"), F.sum(F.xxhash64("word", "mark", "kind").cast("decimal(38,0)"))).first())
        if mark in met:
            return accepted
        met.add(mark)
        doubt = edges.join(accepted, ["word", "mark"]).groupBy("v", "kind").agg(F.sum(F.log(F.greatest(1 - F.col("share"), F.lit(1e-6)))).alias("d"))
        told = doubt.select("v", "kind", (1 - F.exp("d")).alias("belief")).join(seeds.select("v"), "v", "left_anti")
        belief = seeds.unionByName(told)


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, base, added): arrays of (kind number, s, e) sorted by kind and start.

    Null and empty texts have no spans. Rows are judged one by one: null and
    repeated ids, and repeated rows, give a row each. Ties between kinds of an
    accepted pattern cannot occur (a share of 0.8 leaves one). Seeds are
    spans wherever they stand; other tokens after an accepted pattern, key-like
    or not. A span added never overlaps a base span. Very long texts are
    matched like any other, in time linear in their length. An empty table
    gives no rows; other columns are not read.
    """
    found = entities(docs, id_col, text_col)
    accepted = bootstrap(found)
    tokens = found.select("row", "base", F.explode("tokens").alias("x")).select("row", "base", "x.s", "x.e", "x.c.word", "x.c.mark", F.col("x.kind").alias("seed"))
    hits = tokens.join(accepted.select("word", "mark", "kind"), ["word", "mark"]).select("row", "base", "s", "e", "kind")
    hits = hits.unionByName(tokens.where("seed IS NOT NULL").select("row", "base", "s", "e", F.col("seed").alias("kind")))
    hits = hits.where(~F.exists("base", lambda b: (b["s"] < F.col("e")) & (b["e"] > F.col("s"))))
    hits = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("kind", "s", "e"))).alias("added"))  # of one document
    plain = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["s"].alias("s"), b["e"].alias("e")))
    none = F.array().cast("array<struct<kind:int,s:bigint,e:bigint>>")
    return found.select("row", "doc_id", F.sort_array(plain).alias("base")).join(hits, "row", "left").withColumn("added", F.coalesce("added", none))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans,
    and all spans."""
    p = find(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return p.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                    _joined(F.sort_array(F.concat("base", "added"))).alias("spans"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span is replaced by its kind in angle brackets.

    Texts without spans stay as they are; ``n_chars`` follows the new text."""
    session(spark)
    columns = docs.columns
    p = find(docs.select(F.struct(*own_columns(docs)).alias("d"), F.col("text").alias("t")), id_col="d", text_col="t")
    spans = F.array_sort(F.transform(F.concat("base", "added"), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    names = F.array(*map(F.lit, KINDS))

    def cut(text: Column, spans: Column) -> Column:
        # spans of different kinds may overlap: a piece starts where all before have ended
        start = F.struct(F.lit(0).cast("bigint").alias("to"), F.array().cast("array<string>").alias("out"))
        run = F.aggregate(spans, start, lambda a, x: F.when(x["s"] < a["to"], F.struct(F.greatest(a["to"], x["e"]).alias("to"), a["out"].alias("out"))).otherwise(
            F.struct(x["e"].alias("to"), F.concat(a["out"], F.array(F.substring(text, (a["to"] + 1).cast("int"), (x["s"] - a["to"]).cast("int")),
                                                                     F.concat(F.lit("<"), F.element_at(names, x["kind"] + 1), F.lit(">")))).alias("out"))))
        return let(run, lambda r: F.concat(F.array_join(r["out"], ""), F.substring(text, (r["to"] + 1).cast("int"), F.length(text))))

    t = F.col("doc_id.text")
    clean = let(spans, lambda s: F.when(F.size(s) == 0, t).otherwise(cut(t, s)))
    out = p.select("doc_id", clean.alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast(docs.schema["n_chars"].dataType)}
    return out.select(*[new.get(c, F.col("doc_id").getField(c)).alias(c) for c in columns])
