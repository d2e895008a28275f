"""License scans by diagonal voting over word k-grams.

Words are runs of digits, letters and non-ASCII characters, compared after A-Z
became lower case. A *template* is a license phrase or text. Every run of k words
of every document is hashed (k = 2; and 4, from the hashes of its two halves) and
joined to the places at which a template has that hash. A hit at word i of the
document and word j of the template lies on the *diagonal* i - j: hits of one
copy share it. Hits are compared word by word before they vote, so a collision
of hashes gives none.

Votes are the different template places hit on a diagonal. A word that was left
out, put in or changed in number moves the rest of a copy to a neighbouring
diagonal, so diagonals of one template within ``near`` of the next are merged to
one *span*. A span is verified by the share of the template's words that its
k-grams cover: all for a phrase, whose diagonals are never merged and whose
words thus stand consecutively, ``NEED`` for a longer text.

Everything is column functions. The hashes of a document are exploded and meet a
broadcast table of template places within one stage; what goes on from there
are hits, narrow and few, beside one row for each document. Templates are a
parameter, of at most ``MAX_WORDS`` words together, which bounds the broadcast.
Sets that are gathered hold template places or labels, so templates bound them.

Defined results: a null or empty text has no words and no spans; very long texts
are read whole; equal rows get equal results each; null ids are carried along;
other columns, whatever their names, are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermatch.llm.scratch import row_key, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a text template that a span has to cover, and diagonals that are merged.
NEED, NEAR = 0.8, 4
#: Templates of fewer words are phrases.
TEXT_WORDS = 8
MAX_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.lower()) if w]

    @property
    def is_text(self) -> bool:
        return len(self.words) >= TEXT_WORDS


# The contract's phrases and labels.
BASE = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)
# Names of further licenses, and the public notices of common ones.
ADDED = (
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc0", "creative commons zero"),
    Template("bsd", "bsd license"),
    Template("mpl", "mozilla public license"),
    Template("lgpl", "lesser general public license"),
    Template("isc", "isc license"),
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to "
             "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
             "the Software is furnished to do so, subject to the following conditions"),
    Template("apache-notice", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
             "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
             "under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation"),
    Template("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
             "following conditions are met"),
    Template("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies"),
)


def words(text: Column) -> Column:
    """The words, A-Z in lower case. Of the letters beyond ASCII only the Kelvin sign (U+212A) would become an ASCII one."""
    small = F.lower(F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\u212b")))
    return F.filter(F.split(small, SEPARATORS, -1), lambda w: w != "")


def _pairs(values: str, step: int) -> Column:
    """Hashes of the elements of an array with those ``step`` places on."""
    n = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b))


def _grams(df: DataFrame) -> DataFrame:
    """Adds ``pair`` and ``four``: hashes of all runs of 2 and of 4 words in ``words``."""
    return df.withColumn("pair", _pairs("words", 1)).withColumn("four", _pairs("pair", 2))


def template_places(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``hash``, ``t`` (number of the template), ``tpos``, ``gram`` (its words): phrases by pairs, texts by fours."""
    total = sum(len(t.words) for t in templates)
    if total > MAX_WORDS:
        raise ValueError(f"templates of {total} words; their table is broadcast and bounded at {MAX_WORDS}")
    if any(len(t.words) < 2 for t in templates):
        raise ValueError("a template needs two words")
    rows = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(t.text).alias("text"), F.lit(t.is_text).alias("is_text")) for i, t in enumerate(templates)])
    known = spark.range(1).select(F.inline(rows)).select("t", "is_text", words(F.col("text")).alias("words"))
    known = _grams(known).select("t", "words", F.when(F.col("is_text"), 4).otherwise(2).alias("k"),
                                 F.posexplode(F.when(F.col("is_text"), F.col("four")).otherwise(F.col("pair"))).alias("tpos", "hash"))
    return known.select("hash", "t", "tpos", F.slice("words", F.col("tpos") + 1, F.col("k")).alias("gram"))


def hits(docs: DataFrame, templates: Sequence[Template], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified hits (``key``, ``t``, ``diagonal``, ``tpos``), and for each document a row with ``t`` = -1, its id and ``n_words``."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), row_key(F.col(f"`{id_col}`"), text).alias("key"), words(text).alias("words"))
    rows = _grams(rows).withColumn("n_pairs", F.size("pair"))
    # the document's own row goes first; it meets a template of its own
    places = template_places(spark, templates).union(spark.range(1).select(F.lit(0).cast("long"), F.lit(-1), F.lit(0), F.array().cast("array<string>")))
    each = rows.select("id", "key", "words", "n_pairs", F.posexplode(F.concat(F.array(F.lit(0).cast("long")), "pair", "four")).alias("at", "hash"))
    at = F.when(F.col("at") <= F.col("n_pairs"), F.col("at") - 1).otherwise(F.col("at") - F.col("n_pairs") - 1)
    same = F.when(F.col("t") < 0, F.col("at") == 0).otherwise((F.col("at") > 0) & (F.slice("words", F.greatest(at, F.lit(0)) + 1, F.size("gram")) == F.col("gram")))
    met = each.join(F.broadcast(places), "hash").where(same)
    own = F.col("t") < 0
    return met.select("key", "t", (at - F.col("tpos")).alias("diagonal"), "tpos", F.when(own, F.col("id")).alias("id"),
                      F.when(own, F.size("words")).cast("long").alias("n_words"))


def spans(found: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Spans (``key``, ``t``, ``first`` and ``last`` word, ``coverage``) of the hits, verified or not."""
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("t") + 1)
    votes = found.where("t >= 0").groupBy("key", "t", "diagonal").agg(F.collect_set("tpos").alias("places"))
    order = Window.partitionBy("key", "t").orderBy("diagonal")
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > pick([NEAR if t.is_text else 0 for t in templates]), F.lit(True))
    votes = votes.withColumn("new", new.cast("long")).withColumn("span", F.sum("new").over(order))
    each = votes.select("key", "t", "span", "diagonal", F.explode("places").alias("tpos"))
    k = pick([4 if t.is_text else 2 for t in templates])
    merged = each.groupBy("key", "t", "span").agg(
        F.min(F.col("diagonal") + F.col("tpos")).alias("first"), F.max(F.col("diagonal") + F.col("tpos")).alias("last"),
        F.sort_array(F.collect_set("tpos")).alias("places"))
    # a k-gram covers k words, or those up to the next one
    covered = F.aggregate(F.transform("places", lambda p, i: F.least(k, F.coalesce(F.get("places", i + 1), p + k) - p)), F.lit(0), lambda a, x: a + x)
    size = pick([len(t.words) for t in templates])
    return merged.select("key", "t", F.col("first").cast("long"), (F.col("last") + k - 1).cast("long").alias("last"),
                         (covered.cast("double") / size.cast("double")).alias("coverage"))


def scan(docs: DataFrame, templates: Sequence[Template] = BASE + ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, ``n_words``, ``n_base`` places of base phrases, ``first_word`` and ``last_word`` (their least and
    largest start), ``base_labels``, ``labels`` (sorted, comma-joined) and ``score``, the best span's share of its template's words."""
    found = written(hits(docs, templates, id_col, text_col), "licenses")
    named = spans(found, templates)
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("t") + 1)
    good = F.col("coverage") >= pick([NEED if t.is_text else 1.0 for t in templates])
    base = good & pick([t.base for t in templates])
    label = pick([t.label for t in templates])
    joined = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, label))), ",")
    of_doc = named.groupBy("key").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"), joined(base).alias("base_labels"), joined(good).alias("labels"),
        F.max("coverage").alias("score"))
    rows = found.where("t < 0").select("key", "id", "n_words").join(of_doc, "key", "left")
    return rows.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
                       F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                       F.coalesce("score", F.lit(0.0)).alias("score"))


def license_spans(docs: DataFrame, templates: Sequence[Template] = BASE + ADDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The verified spans: id, ``label``, ``first`` and ``last`` word, ``coverage``. Equal rows give them once each."""
    found = written(hits(docs, templates, id_col, text_col), "licenses")
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("t") + 1)
    good = spans(found, templates).where(F.col("coverage") >= pick([NEED if t.is_text else 1.0 for t in templates]))
    return found.where("t < 0").select("key", "id").join(good, "key").select(
        F.col("id").alias(id_col), pick([t.label for t in templates]).alias("label"), "first", "last", "coverage")


def scan_sql(templates: Sequence[Template] = BASE + ADDED) -> str:
    """The same scan in DuckDB SQL: words compared as they are, without hashes."""
    rows = ", ".join(f"({i}, '{t.label}', {t.base}, {len(t.words)}, {4 if t.is_text else 2}, {NEAR if t.is_text else 0}, {NEED if t.is_text else 1.0}, "
                     f"['{"','".join(t.words)}'])" for i, t in enumerate(templates))
    return rf"""
WITH templates(t, label, base, size, k, near, need, twords) AS (VALUES {rows}),
places AS (SELECT t, k, p, array_to_string(twords[p + 1:p + k], ' ') AS gram
           FROM (SELECT *, unnest(range(size - k + 1)) AS p FROM templates)),
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
grams AS (SELECT doc_id, k, i, array_to_string(words[i + 1:i + k], ' ') AS gram
          FROM (SELECT doc_id, words, k, unnest(range(len(words) - k + 1)) AS i FROM docs, (VALUES (2), (4)) ks(k))),
votes AS (SELECT DISTINCT doc_id, t, i - p AS diagonal, p FROM grams JOIN places USING (k, gram)),
lines AS (SELECT DISTINCT doc_id, t, diagonal FROM votes),
marked AS (SELECT doc_id, t, diagonal, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc_id, t ORDER BY diagonal) > near, true)::INT AS fresh
           FROM lines JOIN templates USING (t)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS span FROM marked),
members AS (SELECT doc_id, t, span, p, min(diagonal + p) AS place FROM numbered JOIN votes USING (doc_id, t, diagonal) GROUP BY ALL),
steps AS (SELECT m.*, label, base, size, need, least(k, coalesce(lead(p) OVER (PARTITION BY doc_id, m.t, span ORDER BY p) - p, k)) AS covers
          FROM members m JOIN templates USING (t)),
spans AS (SELECT doc_id, t, span, label, base, need, min(place) AS first, sum(covers)::DOUBLE / size::DOUBLE AS coverage
          FROM steps GROUP BY doc_id, t, span, label, base, need, size),
of_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE base AND coverage >= need) AS n_base, min(first) FILTER (WHERE base AND coverage >= need) AS first_word,
         max(first) FILTER (WHERE base AND coverage >= need) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base AND coverage >= need) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE coverage >= need) AS labels, max(coverage) AS score
  FROM spans GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN of_doc USING (doc_id)
"""
