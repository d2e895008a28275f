"""Language identification by Bayesian fusion of evidence about a page.

For each language l of the training texts a page's score is

    log P(l | host) + w log P(text | l) + log P(declared | l) + log P(suffix | l)

*Text.* Likelihoods of hashed byte trigrams of the visible text, from counts of
all training texts summed by language. Neighbouring trigrams overlap and so
repeat each other's evidence; ``w`` spreads a text's weight so that no text
counts for more than ``TEXT_TRIGRAMS`` independent ones.

*Declared language and address suffix* (the last label of the host) are
categories whose likelihoods are counted over all pages: each page adds its text
posterior to the cell of its value, smoothed towards the value's overall share.

*Host priors* are the same soft counts by host, smoothed towards the counts of
the host's domain (its last two labels), and these towards all pages. A page's
own posterior is taken out of its host's and domain's counts first, so that a
text is not counted twice.

The counts are grouped aggregations; hosts are one row each when they are
joined back, so a host with a third of all pages is a few partial sums and a
skewed join that Spark can split, never one task's work.

Defined results: null, empty and tag-only pages have no text evidence, pages
without a declared language, or with one that is not among the languages, and
addresses without a host contribute nothing from there (their prior is the
overall one); probabilities are the softmax of the scores; ties go to the first
language in order; repeated rows get equal results; texts are read whole; other
columns, whatever their names, are ignored; without training texts the result
has null languages; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import textbytes
from ledgermatch.llm.scratch import written

SLOTS = 1 << 14
TEXT_TRIGRAMS = 60
#: Pseudo-counts towards the level above.
HOST_WEIGHT, DOMAIN_WEIGHT, VALUE_WEIGHT = 2.0, 5.0, 2.0
#: Languages that training takes at most: an error beyond, so the table's size is bounded.
MAX_LANGUAGES = 512


def _slots(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram slots of the texts of a chunk and the text of each, in lower case, spaces as one class."""
    data = np.where(textbytes.SPACE[data], np.uint8(32), textbytes.lower_ascii(data)).astype(np.uint32)
    n = len(data) - 2
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    doc = np.searchsorted(offs, at, "right") - 1
    inside = at + 3 <= offs[doc + 1]
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:])[inside]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64), doc[inside]


def text_model(training: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages in order and log P(trigram | language), from all training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, offs = textbytes.byte_arrays(batch.column(1))
            for i, j in textbytes.chunks(offs):
                slots, doc = _slots(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                names, code = np.unique(np.array(langs[i:j], object).astype(str), return_inverse=True)
                for k, name in enumerate(names.tolist()):
                    if len(sums) >= MAX_LANGUAGES and name not in sums:
                        raise ValueError(f"more than {MAX_LANGUAGES} languages")
                    sums[name] = sums.get(name, 0) + np.bincount(slots[code[doc] == k], minlength=SLOTS)
        for name, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "slot", "n"])

    known = training.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).filter(F.col(lang_col).isNotNull())
    table = known.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    rows = table.toPandas()  # at most MAX_LANGUAGES x SLOTS numbers
    langs = sorted(rows["lang"].unique().tolist())
    counts = np.full((len(langs), SLOTS), 0.5)
    np.add.at(counts, (np.searchsorted(langs, rows["lang"]), rows["slot"].to_numpy()), rows["n"].to_numpy())
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)) if langs else counts


#: What begins and ends text that is not shown.
_HIDDEN = ((r"<script\b", r"</script\s*+>"), (r"<style\b", r"</style\s*+>"), (r"<!--", r"-->"))
#: A private-use code point that marks beginnings without an end.
_MARK = "\ue000"


def _marked(html: Column, begin: str, end: str) -> Column:
    """A mark in every beginning behind the last end. None of them can match, and each try would read on to the text's end."""
    closed = F.regexp_extract(html, f"(?is)^.*{end}", 0)
    rest = F.substring(html, F.length(closed) + 1, F.length(html))
    return F.when(html.rlike(f"(?i){begin}"), F.concat(closed, F.regexp_replace(rest, f"(?i)<(?={begin[1:]})", f"<{_MARK}"))).otherwise(html)


def visible_text(html: Column) -> Column:
    """Without scripts, styles, comments and tags; one left open hides nothing but its own tag. Linear in the text's length."""
    for begin, end in _HIDDEN:
        html = _marked(html, begin, end)
    hidden = r"(?is)<(script|style)\b[^<>]*+>.*?</\1\s*+>|<!--.*?-->"
    shown = F.replace(F.regexp_replace(html, hidden, " "), F.lit(f"<{_MARK}"), F.lit("<"))
    return F.regexp_replace(shown, r"<[^<>]*+>", " ")


def declared_language(html: Column) -> Column:
    """First part of the language in the opening html tag, in lower case; null if none."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^<>]*?\blang\s*=\s*["']?([A-Za-z]+)""", 1))
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(found != "", found)


def _text_scores(rows: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """Adds ``ll``, the tempered log likelihoods, in place of ``body``."""
    sent = rows.sparkSession.sparkContext.broadcast(np.ascontiguousarray(model.T))
    names = [c for c in rows.columns if c != "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(batch.schema.get_field_index("body")))
            out = np.zeros((batch.num_rows, len(langs)))
            for i, j in textbytes.chunks(offs):
                slots, doc = _slots(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                n = np.bincount(doc, minlength=j - i)
                for k in range(len(langs)):
                    out[i:j, k] = np.bincount(doc, weights=table[slots, k], minlength=j - i)
                out[i:j] *= np.minimum(1, TEXT_TRIGRAMS / np.maximum(n, 1))[:, None]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(list(out), pa.list_(pa.float64()))], [*names, "ll"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")
    return rows.mapInArrow(run, f"{shape}, ll array<double>")


def _softmax(scores: Column) -> Column:
    best = F.array_max(scores)
    powers = F.transform(scores, lambda x: F.exp(x - best))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, y: a + y))


def _sums(rows: DataFrame, key: str, n: int, name: str) -> DataFrame:
    """Sum of the posteriors ``p`` of the rows of each key, as an array."""
    return (rows.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(*[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)])
            .select(key, F.array(*[f"s{i}" for i in range(n)]).alias(name)))


def identify(pages: DataFrame, training: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row a page: id, ``lang``, ``probability``, ``text_lang`` (by the text alone), ``declared`` and ``host``."""
    langs, model = text_model(training, lang_col, text_col)
    given = F.col(html_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col).cast("string")).alias("host"),
                        declared_language(given).alias("declared"), F.coalesce(visible_text(given), F.lit("")).alias("body"))
    if not langs:
        return rows.select(F.col("id").alias(id_col), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    n = len(langs)
    names = F.array(*[F.lit(x) for x in langs])
    rows = (_text_scores(rows, langs, model).withColumn("p", _softmax(F.col("ll")))
            .withColumn("declared", F.when(F.col("declared").isin(langs), F.col("declared")))
            .withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
            .withColumn("domain", F.array_join(F.slice(F.reverse(F.split("host", r"\.")), 1, 2), ".")))
    rows = written(rows, "language")  # texts are read once; the rest works on a few numbers a page
    overall = rows.agg(*[F.sum(F.col("p")[i]) for i in range(n)]).first()
    mass = np.array([x or 0.0 for x in overall]) + 1.0
    share = [float(x) for x in mass / mass.sum()]
    out = rows
    for key in ("host", "domain", "declared", "suffix"):
        out = out.join(_sums(rows, key, n, f"n_{key}"), key, "left")
    own = lambda key, i: F.greatest(F.coalesce(F.col(f"n_{key}")[i] - F.col("p")[i], F.lit(0.0)), F.lit(0.0))
    total = lambda key: F.aggregate(F.array(*[own(key, i) for i in range(n)]), F.lit(0.0), lambda a, x: a + x)
    out = out.withColumn("t_host", total("host")).withColumn("t_domain", total("domain"))
    for key in ("declared", "suffix"):
        out = out.withColumn(f"t_{key}", F.aggregate(F.coalesce(F.col(f"n_{key}"), F.array(F.lit(0.0))), F.lit(0.0), lambda a, x: a + x))
    out = out.withColumn("prior", F.array(*[(own("domain", i) + DOMAIN_WEIGHT * share[i]) / (F.col("t_domain") + DOMAIN_WEIGHT) for i in range(n)]))
    out = out.withColumn("prior", F.array(*[(own("host", i) + HOST_WEIGHT * F.col("prior")[i]) / (F.col("t_host") + HOST_WEIGHT) for i in range(n)]))
    everything = float(mass.sum())

    def value(key: str, i: int) -> Column:
        """log P(value | language): soft counts of both, smoothed towards the value's overall share."""
        of_value = F.col(f"t_{key}") / everything
        return F.when(F.col(f"n_{key}").isNull(), F.lit(0.0)).otherwise(
            F.log((F.col(f"n_{key}")[i] + VALUE_WEIGHT * of_value) / (float(mass[i]) + VALUE_WEIGHT)))

    out = out.withColumn("scores", F.array(*[F.log(F.col("prior")[i]) + F.col("ll")[i] + value("declared", i) + value("suffix", i)
                                             for i in range(n)]))
    out = out.withColumn("posterior", _softmax(F.col("scores")))
    pick = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    return out.select(F.col("id").alias(id_col), pick(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"),
                      pick(F.col("p")).alias("text_lang"), "declared", "host")
