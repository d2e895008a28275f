"""The operators applied to whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm import (decontaminate, fingerprints, infill, language, licenses, mixing, pii, quality, simhash_near, suffix_dedup, superkmers,
                             token_counts, whitening)
from ledgermatch.llm.scratch import ship_package, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_bytes(_table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.find_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("pii", lambda x: x["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return spans.select("doc_id", *[count(k) for k in pii.BASE_KINDS],
                        F.sha2(pii.span_list(base).cast("binary"), 256).alias("base_sha256"),
                        pii.span_list(F.col("pii")).alias("spans"),
                        F.round(F.array_max(F.transform("pii", lambda x: x["score"])), 3).alias("max_score"))


def op3_simhash_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_near.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmers.dedup_substrings(_table(spark, sf_dir, "documents"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token files go to the shared folder; what is counted is read from them."""
    blocks, end, kind = token_counts.token_blocks(_table(spark, sf_dir, "documents"))
    return token_counts.counts(written(blocks, "tokens"), end, kind)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written first, as the search for near fingerprints reads them again."""
    found = written(fingerprints.edited_likeness(_table(spark, sf_dir, "documents")), "fingerprints")
    near = fingerprints.near_counts(found.select("hi", "lo"))
    text = lambda hi, lo: F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))
    return found.join(near, ["hi", "lo"]).select(
        "doc_id", "n_chars", "edited_sha256", text("hi", "lo").alias("fingerprint"),
        text("hi_edited", "lo_edited").alias("edited_fingerprint"), "near_edited", "near_next", "n_near")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
placed AS (
  SELECT *, length(bin(size)) * 100 + rpad(substr(bin(size), 2, 2), 2, '0')::INT AS class,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
           % greatest(1, ceil((SELECT count(*) FROM docs) / 16384.0)::BIGINT) AS block
  FROM docs),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY class, block, size, doc_id) - 1 AS rnk FROM placed),
sources AS (
  SELECT src, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::DOUBLE AS weight FROM docs GROUP BY src),
limits AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio FROM sources),
levels AS (
  SELECT a.src, a.source_size, a.weight, a.cap, a.ratio,
         ((SELECT sum(source_size) FROM limits)::DOUBLE
            - coalesce((SELECT sum(cap) FROM limits b WHERE (b.ratio, b.src) < (a.ratio, a.src)), 0))
         / ((SELECT sum(weight) FROM limits)
            - coalesce((SELECT sum(weight) FROM limits b WHERE (b.ratio, b.src) < (a.ratio, a.src)), 0)) AS level
  FROM limits a),
targets AS (
  SELECT src, source_size, CASE WHEN ratio <= level THEN cap ELSE
    weight * (SELECT level FROM levels WHERE ratio > level ORDER BY ratio, src LIMIT 1) END AS target FROM levels),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('mix:' || src), 1, 4))::BIGINT / 65536.0::DOUBLE AS off FROM targets)
SELECT doc_id, size, source_size, target,
       ((floor(off + rate * (rnk + 1)) - floor(off + rate * rnk)) * size)::BIGINT AS taken
FROM ranked JOIN rates USING (src)
"""

def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs, _table(spark, sf_dir, "labels"))
    return quality.scores(docs, model).select(
        "doc_id", F.coalesce(~quality.learnable(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), n_components=8)


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units are code points; the text is restored from the output to be hashed again."""
    found = infill.transform(_table(spark, sf_dir, "documents"), unit="code_point", rate=90, spm_rate=20, seed="1")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(infill.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
numbers AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
         ('0x' || substr(h, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS h4 FROM docs),
forms AS (
  SELECT *, least(a, b) AS low, greatest(a, b) AS high,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
pieces AS (
  SELECT *, substr(text, 1, low) AS prefix, substr(text, low + 1, high - low) AS middle, substr(text, high + 1) AS suffix FROM forms)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""


OP4_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS phrase
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY phrase) AS least FROM windows)
  WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, (SELECT unnest(range(13)) AS j)),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT docs.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_pii": op2_pii,
    "op3_simhash_near": op3_simhash_near,
    "op4_superkmers": op4_superkmers,
    "op5_tiling": op5_tiling,
    "op6_token_counts": op6_token_counts,
    "op7_fingerprints": op7_fingerprints,
    "op8_mixing": op8_mixing,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_licenses": op12_licenses,
    "op13_infill": op13_infill,
}

ORACLE: dict[str, str] = {
    "op4_superkmers": OP4_SQL,
    "op8_mixing": OP8_SQL,
    "op12_licenses": licenses.scan_sql(),
    "op13_infill": OP13_SQL,
}
