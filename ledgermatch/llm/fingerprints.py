"""SimHash document fingerprints and the search for those within a Hamming radius.

*Fingerprint.* The terms of a text are its pairs of neighbouring words in lower
case (A-Z only), or its word if it has just one. A term that occurs n times
weighs 1 + ln n, rounded to quarters. Each of the ``BITS`` bits of its hash votes
with that weight for or against the same bit of the fingerprint; a bit is set if
the votes for it outweigh the others. Likeness is the share of equal bits.

*Search.* Fingerprints are cut into blocks. Two that differ in at most
``radius`` bits agree in all but ``radius`` blocks, so for each way of choosing
that many blocks there is a table in which the chosen ones come first and are
the key. Pairs that meet in a table are verified by the bits of their exclusive
or. More blocks make longer keys and more tables: the least number is taken at
which the key has a few bits more than the fingerprints' number, which changes
the work and never the result.

*Neighbours in id order.* Documents go to ranges of ids. A histogram of the bytes
of text by id is refined where a bin is too full, until every bin is small or a
single id; neighbouring bins then make up ranges of about the same number of bytes.
The first document of each range is sent to the range before as well. A range is
sorted and read in order, with one document held back until its next one comes,
so a task holds a batch and not its range.

Defined results: null and empty texts, and those without words, have the
fingerprint zero; null ids come after all others; rows of equal ids follow one
another by a hash of their texts; the only document of a table is its own next
one; texts are read whole; other columns, whatever their names, are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import textbytes
from ledgermatch.llm.scratch import written
from ledgermatch.llm.simhash_near import _SPREAD

BITS = 128
#: Bytes of text of a range, and its least where ranges are few.
RANGE_BYTES, LEAST_BYTES = 16 << 20, 1 << 16
#: Beyond so many, ranges grow instead: the driver holds one number for each, and for each bin of the histogram.
MAX_RANGES, MAX_BINS = 1 << 15, 1 << 18
_LAST = -(1 << 63)


def weighted_bits(hashes: np.ndarray, weights: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sign bits of the weighted votes of each group of terms; a group's equal weights stand together."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    new = np.zeros(len(hashes), bool)
    new[first[:-1][full]] = True
    new[1:] |= weights[1:] != weights[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(hashes)))
    # one-byte counters hold 255 terms at most
    parts = -(-size // 255)
    begin = np.repeat(at, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    sums = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], begin, axis=0)
    votes = np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64) * weights[begin][:, None]
    group = np.searchsorted(begin, first[:-1][full])
    total = np.add.reduceat(weights, first[:-1][full])
    bits = 2 * np.add.reduceat(votes, group, axis=0) > total[:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").copy().view(np.uint64)[:, 0]
    return out


def text_fingerprints(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """n rows of two 64-bit numbers for the texts of a chunk."""
    data = textbytes.lower_ascii(data)
    starts, ends, first = textbytes.word_bounds(data, offs)
    out = np.zeros((len(offs) - 1, BITS // 64), np.uint64)
    if not len(starts):
        return out
    words = textbytes.span_hash(textbytes.prefix_hash(data), starts, ends)
    prefix = textbytes.run_prefix(words)
    at = textbytes.window_starts(first, 2)
    single = np.flatnonzero(np.diff(first) == 1)
    terms = np.concatenate([textbytes.span_hash(prefix, at, at + 2), textbytes.mix64(words[first[single]])])
    doc = np.concatenate([np.searchsorted(first, at, "right") - 1, single])
    order = np.lexsort((terms, doc))
    terms, doc = terms[order], doc[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    weight = np.rint(4 * (1 + np.log(np.diff(np.append(begin, len(terms)))))).astype(np.int64)
    terms, doc = terms[begin], doc[begin]
    order = np.lexsort((weight, doc))
    terms, doc, weight = terms[order], doc[order], weight[order]
    bounds = np.searchsorted(doc, np.arange(len(offs)))
    for k in range(BITS // 64):
        out[:, k] = weighted_bits(textbytes.mix64(terms + np.uint64(0xD6E8FEB86659FD93 * (k + 1) % (1 << 64))), weight, bounds)
    return out


def _of_column(column: pa.Array) -> np.ndarray:
    data, offs = textbytes.byte_arrays(column)
    found = [text_fingerprints(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]) for i, j in textbytes.chunks(offs)]
    return np.concatenate(found) if found else np.zeros((0, BITS // 64), np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits, row by row."""
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``hi`` and ``lo``: the fingerprint's halves as signed numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = _of_column(batch.column(1)).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp[:, 0]), pa.array(fp[:, 1])], ["id", "hi", "lo"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
            .mapInArrow(run, "id long, hi long, lo long").withColumnRenamed("id", id_col))


def _block(lo_bit: int, hi_bit: int):
    """Bits lo_bit .. hi_bit - 1 of the 128, counted from the top of ``hi``, as a number."""
    parts = []
    for name, base in (("hi", 0), ("lo", 64)):
        a, b = max(lo_bit, base) - base, min(hi_bit, base + 64) - base
        if a < b:
            cut = F.shiftrightunsigned(F.col(name), 64 - b) if b < 64 else F.col(name)
            parts.append((cut if b - a == 64 else cut.bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")), b - a))
    out = parts[0][0]
    for more, width in parts[1:]:
        out = F.shiftleft(out, width).bitwiseOR(more)
    return out


def near_pairs(distinct: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """All pairs of different fingerprints (``hi``, ``lo`` and ``hi2``, ``lo2``, each pair once) within ``radius`` bits."""
    if blocks is None:
        need = math.log2(max(distinct.count(), 1)) + 4
        blocks = next((b for b in range(radius + 1, radius + 5) if (b - radius) * (BITS // b) >= need), radius + 4)
    if blocks <= radius:
        raise ValueError("there must be more blocks than bits may differ")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    tables = [F.struct(F.lit(t).alias("t"), F.xxhash64(*[_block(edges[i], edges[i + 1]) for i in chosen]).alias("key"))
              for t, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius))]
    keyed = distinct.select("hi", "lo", F.explode(F.array(*tables)).alias("x")).select("hi", "lo", "x.t", "x.key")
    other = keyed.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), "t", "key")
    bits = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    first = (F.col("hi") < F.col("hi2")) | ((F.col("hi") == F.col("hi2")) & (F.col("lo") < F.col("lo2")))
    near = bits("hi", "hi2") + bits("lo", "lo2") <= radius
    return keyed.join(other, ["t", "key"]).where(first & near).select("hi", "lo", "hi2", "lo2").distinct()


def near_counts(fps: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """``hi``, ``lo`` and ``n_near``: the rows whose fingerprint is within ``radius`` bits, that one's own included."""
    groups = fps.groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))
    pairs = near_pairs(groups.select("hi", "lo"), radius, blocks)
    both = pairs.union(pairs.select("hi2", "lo2", F.col("hi").alias("h"), F.col("lo").alias("l")))
    more = (both.join(groups.select(F.col("hi").alias("hi2"), F.col("lo").alias("lo2"), "n"), ["hi2", "lo2"])
            .groupBy("hi", "lo").agg(F.sum("n").alias("more")))
    return groups.join(more, ["hi", "lo"], "left").select("hi", "lo", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_near"))


def _range_of(keys: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Number of the interval that holds each key, where ``edges`` are the least keys of all intervals but the first."""
    return np.searchsorted(edges, keys, "right").astype(np.int32)


def _histogram(narrow: DataFrame, edges: np.ndarray) -> np.ndarray:
    """Bytes of text in each interval of keys."""
    place = F.pandas_udf(lambda key: pd.Series(_range_of(key.to_numpy(), edges)), "int")
    out = np.zeros(len(edges) + 1, np.int64)
    for r in narrow.groupBy(place("key").alias("at")).agg(F.sum("bytes").alias("bytes")).collect():  # at most MAX_BINS
        out[r["at"]] = r["bytes"]
    return out


def range_edges(narrow: DataFrame, n_ranges: int) -> np.ndarray:
    """Least keys of all ranges but the first, for about ``n_ranges`` of the same number of ``bytes``.

    ``narrow`` has ``key`` and ``bytes``. Bins over half a range are split into equal intervals, round by round; a bin of one key stays whole.
    """
    span = narrow.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.sum("bytes").alias("bytes")).first()
    none = np.zeros(0, np.int64)
    if span["low"] is None or n_ranges < 2 or not span["bytes"]:
        return none
    bounds, sizes = [(span["low"], span["high"])], np.array([span["bytes"]])
    target = span["bytes"] / n_ranges
    while True:
        full = [i for i, (low, high) in enumerate(bounds) if sizes[i] > target / 2 and high > low]
        room = MAX_BINS - len(bounds)
        if not full or room < len(full):
            break
        each = max(2, min(room // len(full), 4 * n_ranges // len(full) + 64))
        finer = []
        for i, (low, high) in enumerate(bounds):
            step = -(-(high - low + 1) // each) if i in set(full) else high - low + 1
            finer += [(x, min(x + step - 1, high)) for x in range(low, high + 1, step)]
        bounds = finer
        sizes = _histogram(narrow, np.array([low for low, _ in bounds[1:]], np.int64))
        # no key lies in an empty bin; the least one is in the first
        keep = np.flatnonzero(sizes)
        bounds, sizes = [bounds[i] for i in keep], sizes[keep]
    # a range begins where the bytes before it have passed a multiple of the target
    number = ((np.cumsum(sizes) - sizes) // max(target, 1)).astype(np.int64)
    return np.array([bounds[i][0] for i in range(1, len(bounds)) if number[i] != number[i - 1]], np.int64)


_ROW = "id long, n_chars long, edited_sha256 string, hi long, lo long, hi_edited long, lo_edited long, near_edited double, near_next double"


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its text with the second half replaced by the beginning of the next document's, and beside that document.

    Columns: id, ``n_chars``, ``edited_sha256``, both fingerprints, ``near_edited`` and ``near_next``.
    """
    given = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(given.alias("id"), F.coalesce(given, F.lit(_LAST)).alias("key"), F.xxhash64(given, text).alias("rid"), text.alias("text"))
    narrow = written(rows.select("key", "rid", F.octet_length("text").alias("bytes")), "fingerprint-sizes")
    total = narrow.agg(F.sum("bytes")).first()[0] or 0
    few = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = range_edges(narrow, min(max(total // RANGE_BYTES, min(few, total // LEAST_BYTES), 1), MAX_RANGES))
    n = len(edges)
    # ids descend, and so do the numbers of ranges
    place = F.pandas_udf(lambda key: pd.Series(n - _range_of(key.to_numpy(), edges)), "int")
    placed = rows.withColumn("range", place("key"))
    heads = {r["range"]: (r["m"]["key"], r["m"]["rid"]) for r in
             narrow.select("key", "rid").withColumn("range", place("key")).groupBy("range")
             .agg(F.max_by(F.struct("key", "rid"), F.struct("key", -F.col("rid").cast("decimal(20,0)"))).alias("m")).collect()}
    order = sorted(heads)
    before = {heads[r]: order[i - 1] for i, r in enumerate(order)}  # the first one's is sent to the last range
    sent = docs.sparkSession.createDataFrame([(k, h, r) for (k, h), r in before.items()] or [], "key long, rid long, to int")
    extra = rows.join(F.broadcast(sent), ["key", "rid"]).select("id", "key", "rid", "text", F.col("to").alias("range"), F.lit(True).alias("extra"))
    both = placed.select("id", "key", "rid", "text", "range", F.lit(False).alias("extra")).unionByName(extra)

    # a task for each range; the guest comes last in it
    ordered = both.repartitionById(n + 1, "range").sortWithinPartitions("range", "extra", F.desc("key"), "rid").select("id", "text", "range", "extra")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, whose next one is yet to come
        for batch in batches:
            if not batch.num_rows:
                continue
            # in slices of about a chunk; each begins with the row that the one before it held back
            offs = textbytes.byte_arrays(batch.column(1))[1]
            for i, j in textbytes.chunks(offs):
                part = pa.Table.from_batches([batch.slice(i, j - i)])
                part = part if held is None else pa.concat_tables([held, part])
                found = _beside_next(part)
                held = part.slice(part.num_rows - 1)
                if found.num_rows:
                    yield found

    return ordered.mapInArrow(run, _ROW).withColumnRenamed("id", id_col)


def _beside_next(part: pa.Table) -> pa.RecordBatch:
    """What comes of all rows of a sorted part but the last, each beside the row after it; guests and last rows of ranges give none."""
    texts = part["text"].combine_chunks()
    ranges, extra = part["range"].to_numpy(), part["extra"].to_numpy().astype(bool)
    at = np.flatnonzero(~extra[:-1] & (ranges[:-1] == ranges[1:]))
    words = texts.to_pylist()
    edited = [words[i][:len(words[i]) - len(words[i]) // 2] + words[i + 1][:len(words[i]) // 2] for i in at.tolist()]
    fp, changed = _of_column(texts), _of_column(pa.array(edited, pa.large_string()))
    signed, signed_edited = fp.view(np.int64), changed.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [part["id"].combine_chunks().take(pa.array(at)), pa.array([len(words[i]) for i in at.tolist()], pa.int64()),
         pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), pa.array(signed[at, 0]), pa.array(signed[at, 1]),
         pa.array(signed_edited[:, 0]), pa.array(signed_edited[:, 1]), pa.array(likeness(fp[at], changed)), pa.array(likeness(fp[at], fp[at + 1]))],
        [f.split()[0] for f in _ROW.split(", ")])
