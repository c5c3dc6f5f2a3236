"""License scans by an exact set-similarity join.

Templates of license notices are token sets. A stretch of as many words as the
notice meets its template when it holds at least ``ceil(threshold * |T|)`` of
the template's tokens, the required ones among them. Tokens are ordered by their count in the whole
corpus, rarest first, and three filters choose the pairs to verify:

* prefix: such a block shares one of the template's first ``|T| - need + 1``
  tokens, so the join runs on these rare tokens alone;
* length: the block has at least ``need`` tokens of the templates at all;
* position: with the shared token at place i of the template and j of the
  block, no more than 1 + min(what follows i, what follows j) can be shared.

The join's blocks are windows of 2L - 1 words that begin at every L-th word, L
being the words of the longest template: every stretch stands whole in the
block that its first word owns. A block that passes is verified token by token,
then each stretch that begins in its first L words.

Phrases go the same way, as templates that must be contained whole; where a
block holds all their tokens, the places where they stand consecutively are
counted.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, session

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bound of the templates, which are joined as a broadcast.
MAX_TEMPLATE_WORDS = 100_000
THRESHOLD = 0.8

# The phrases of the base scan, (label, phrase).
PHRASES = [
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
]

# Public license notices, (label, notice, words that must be there).
TEMPLATES = [
    ("mit", "released under the mit license", "mit"),
    ("mit", "licensed under the mit license", "mit"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission granted"),
    ("apache", "licensed under the apache license version 2 0", "apache"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "file license"),
    ("gpl", "licensed under the gnu general public license", "gnu"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    ("epl", "made available under the terms of the eclipse public license", "eclipse"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission distribute"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative attribution"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0", "cc by nc sa"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0", "cc by nc nd"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0"),
]


def tokens(text: str) -> list[str]:
    return [w for w in re.split(_SEPARATORS, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)) if w]


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased.

    ``lower`` also folds other letters. That changes no word's bounds, and
    gives an ASCII letter from one sign alone, the Kelvin sign, which is
    put out of its reach.
    """
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(folded, _SEPARATORS), "")


def _notices(templates, phrases, threshold):
    """All patterns as dicts: label, sequence, tokens, need, must, whole."""
    out = []
    for label, text, must in templates:
        t = sorted(set(tokens(text)))
        out.append({"label": label, "seq": tokens(text), "tokens": t, "need": max(1, math.ceil(round(threshold * len(t), 9))), "must": sorted(set(tokens(must))), "whole": False})
    for label, text in phrases:
        t = sorted(set(tokens(text)))
        out.append({"label": label, "seq": tokens(text), "tokens": t, "need": len(t), "must": [], "whole": True})
    out = [n for n in out if n["tokens"]]
    if sum(len(n["seq"]) for n in out) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates and phrases hold more than {MAX_TEMPLATE_WORDS} words")
    return [n | {"template": k} for k, n in enumerate(out)]


_INDEX = "token string, i int, template int, label string, seq array<string>, tokens array<string>, need int, must array<string>, whole boolean"


def license_blocks(rows: DataFrame, templates, phrases, threshold: float) -> tuple[DataFrame, int]:
    """(row, words, ...) -> the rows' columns but ``words``, ``n_words``, and
    one line for each candidate block and template that it meets: ``block``,
    ``label``, ``shared`` (tokens), ``containment``, ``whole``, ``places``
    (word positions of a phrase). A row without any has one line of nulls."""
    spark = rows.sparkSession
    notices = _notices(templates, phrases, threshold)
    span = max((len(n["seq"]) for n in notices), default=1)
    vocabulary = sorted({t for n in notices for t in n["tokens"]})
    one_of = lambda w, some: w.isin(*some) if some else F.lit(False)

    # The global order: rarest token first. One row per token of the templates.
    counted = rows.select(F.explode(F.filter("words", lambda w: one_of(w, vocabulary))).alias("token")).groupBy("token").count()
    count = {r["token"]: r["count"] for r in counted.collect()}
    order = sorted(vocabulary, key=lambda t: (count.get(t, 0), t))
    place = {t: k for k, t in enumerate(order)}
    index = []
    for n in notices:
        t = sorted(n["tokens"], key=place.__getitem__)
        index += [(t[i], i, n["template"], n["label"], n["seq"], t, n["need"], n["must"], n["whole"]) for i in range(len(t) - n["need"] + 1)]
    prefix = sorted({x[0] for x in index})
    index = F.broadcast(spark.createDataFrame(index, _INDEX))  # at most MAX_TEMPLATE_WORDS rows

    # Blocks that hold a prefix token, with their words.
    none = F.array().cast("array<int>")
    at = F.when(F.exists("words", lambda w: one_of(w, prefix)),
                F.filter(F.transform("words", lambda w, k: F.when(one_of(w, prefix), k)), lambda k: k.isNotNull())).otherwise(none)
    of = F.array_distinct(F.flatten(F.transform(at, lambda k: F.filter(
        F.array(F.floor(k / span).cast("int"), F.when(k % span < span - 1, F.floor(k / span).cast("int") - 1)), lambda b: b >= 0))))
    blocks = rows.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "b", F.transform(of, lambda b: F.struct(b.alias("block"), F.slice("words", b * span + 1, 2 * span - 1).alias("text")))).drop("words")
    blocks = blocks.select("*", F.explode_outer("b").alias("x")).drop("b").select("*", F.col("x.block").alias("block"), F.col("x.text").alias("text")).drop("x")
    held = F.array_intersect(F.array(*map(F.lit, order)) if order else F.array().cast("array<string>"), F.col("text"))
    probes = blocks.withColumn("held", held).select("*", F.posexplode_outer("held").alias("j", "token"))
    probes = probes.where(F.col("token").isNull() | (F.col("j") == 0) | one_of(F.col("token"), prefix))

    # Prefix join; length and position filters; verification in the block, then in its stretches.
    pair = probes.join(index, "token", "left")
    may = (F.size("held") >= F.col("need")) & (1 + F.least(F.size("tokens") - F.col("i") - 1, F.size("held") - F.col("j") - 1) >= F.col("need"))
    pair = pair.withColumn("shared", F.when(may, F.array_intersect("tokens", "held")))
    meets = (F.size("shared") >= F.col("need")) & (F.element_at("shared", 1) == F.col("token")) & (F.size(F.array_except("must", "held")) == 0)
    starts = F.sequence(F.lit(0), F.lit(span - 1))
    stretch = lambda o: F.slice("text", o + 1, F.size("seq"))
    good = F.filter(starts, lambda o: (F.size(F.array_intersect("tokens", stretch(o))) >= F.col("need")) & (F.size(F.array_except("must", stretch(o))) == 0))
    first = F.array_max(F.transform(good, lambda o: F.struct(F.size(F.array_intersect("tokens", stretch(o))).alias("n"), (-o).alias("o"))))
    pair = pair.withColumn("best", F.when(meets, first))
    pair = pair.withColumn("hit", F.col("best").isNotNull()).withColumn("shared", F.array_intersect("tokens", F.slice("text", 1 - F.col("best.o"), F.size("seq"))))
    places = F.filter(F.transform(starts, lambda o: F.when(stretch(o) == F.col("seq"), (F.col("block") * span + o).cast("long"))), lambda p: p.isNotNull())
    pair = pair.withColumn("places", F.when(F.col("hit") & F.col("whole"), places))
    kept = [c for c in blocks.columns if c not in ("block", "text")]
    found = [F.when(F.col("hit"), F.col(c)).alias(c) for c in ("block", "template", "label", "shared", "whole", "places")]
    return pair.select(*kept, *found, F.when(F.col("hit"), F.size("shared") / F.size("tokens")).alias("containment")), span


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, phrases=PHRASES,
         threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of ``docs``: (doc_id, n_words, notices, phrases).

    ``notices`` has (block, label, shared, containment) for every text block
    and template that a stretch of it meets, with the best stretch (the first
    of equal ones), but for those that another template explains better there
    (shares all these tokens and more, or just these and is contained in a
    greater part). ``phrases`` has (label, places): first words
    of every place where a phrase stands, words counted from 0; a place in
    two blocks belongs to the one that begins last before it.

    Null and empty texts have no words and nothing found. Repeated rows and
    ids, and a null id, give a row each. Very long texts are cut into blocks
    like any other. Tokens of equal count are ordered by their code points.
    Without templates and phrases nothing is found; an empty table gives no
    rows. Other columns are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("words"))
    lines, _ = license_blocks(rows, templates, phrases, threshold)
    # One exchange, by row; blocks and then rows are put together in it.
    notice = F.struct("block", "label", "shared", "containment")
    block = lines.repartition("row").groupBy("row", "doc_id", "n_words", "block").agg(
        F.collect_list(F.when(~F.col("whole"), notice)).alias("notices"),
        F.collect_list(F.when(F.col("whole") & (F.size("places") > 0), F.struct("label", "places"))).alias("phrases"))
    fewer = lambda a, b: F.size(F.array_except(a["shared"], b["shared"])) == 0
    better = lambda a, b: fewer(a, b) & ((F.size(b["shared"]) > F.size(a["shared"])) | (b["containment"] > a["containment"]))
    best = F.filter("notices", lambda a: ~F.exists("notices", lambda b: better(a, b)))
    return block.withColumn("notices", best).groupBy("row", "doc_id", "n_words").agg(
        F.flatten(F.collect_list("notices")).alias("notices"), F.flatten(F.collect_list("phrases")).alias("phrases")).drop("row")


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    found = scan(documents(spark, sf_dir))
    places = F.flatten(F.col("phrases.places"))
    base = F.array_distinct(F.col("phrases.label"))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    top = F.coalesce(F.array_max(F.col("notices.containment")), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.array_union(base, F.col("notices.label"))).alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(top).alias("score"))


def _sql(templates, phrases, threshold) -> str:
    notices = _notices(templates, phrases, threshold)
    span = max(len(n["seq"]) for n in notices)
    text = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    values = ",\n  ".join(f"({n['template']}, '{n['label']}', {text(n['tokens'])}, {n['need']}, {text(n['must'])}, {len(n['seq'])})" for n in notices if not n["whole"])
    spoken = ",\n  ".join(f"('{n['label']}', '{' '.join(n['seq'])}', {len(n['seq'])})" for n in notices if n["whole"])
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
t(template, label, tokens, need, must, m) AS (VALUES
  {values}),
p(label, phrase, m) AS (VALUES
  {spoken}),
b AS (SELECT r, w, unnest(range(0, CAST(ceil(len(w) / {span}.0) AS BIGINT))) AS block FROM d),
c AS (SELECT r, block, w[block * {span} + 1:block * {span} + 2 * {span} - 1] AS x FROM b),
s AS (SELECT r, block, x, label, template, tokens, need, must, m FROM c JOIN t ON len(list_intersect(must, x)) = len(must) AND len(list_intersect(tokens, x)) >= need),
v AS (SELECT *, x[o + 1:o + m] AS y FROM (SELECT *, unnest(range(0, {span})) AS o FROM s)),
h AS (
  SELECT r, block, label, template, list_intersect(tokens, y) AS shared, len(list_intersect(tokens, y)) / len(tokens)::DOUBLE AS containment FROM v
  WHERE len(list_intersect(must, y)) = len(must) AND len(list_intersect(tokens, y)) >= need
  QUALIFY row_number() OVER (PARTITION BY r, block, template ORDER BY len(list_intersect(tokens, y)) DESC, o) = 1),
best AS (
  SELECT * FROM h WHERE NOT EXISTS (
    SELECT 1 FROM h g WHERE g.r = h.r AND g.block = h.block AND len(list_intersect(g.shared, h.shared)) = len(h.shared)
      AND (len(g.shared) > len(h.shared) OR g.containment > h.containment))),
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM d WHERE len(w) > 0),
runs AS (SELECT r, i, w || ' ' || lead(w, 1) OVER o AS two, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS three FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
places AS (SELECT r, i, label FROM runs JOIN p ON phrase = CASE m WHEN 2 THEN two ELSE three END),
base AS (SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY r),
base_names AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT DISTINCT r, label FROM places) GROUP BY r),
names AS (SELECT r, string_agg(label, ',' ORDER BY label) AS s FROM (SELECT r, label FROM places UNION SELECT r, label FROM best) GROUP BY r),
top AS (SELECT r, max(containment) AS x FROM best GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(base.n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_names.s, '') AS base_labels, coalesce(names.s, '') AS labels, CASE WHEN base.n > 0 THEN 1.0::DOUBLE ELSE coalesce(top.x, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN base_names USING (r) LEFT JOIN names USING (r) LEFT JOIN top USING (r)
"""


ORACLE = _sql(TEMPLATES, PHRASES, THRESHOLD)
