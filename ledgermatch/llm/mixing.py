"""Mixing sources to target weights by systematic sampling.

Each source has a weight. Together the mix takes as many words as the corpus
has; a source's target is its weight's share of them, at most ``max_repeat``
times the source's own size, what is cut off being dealt to the others by
weight until no source is above its limit.

Within a source all documents have the same expected number of copies, the
*rate* target / size. Documents are put in order of their size class, the
prefix sum of the rates runs through that order from one offset in [0, 1), and
a document is emitted once for each integer that its step of the prefix sum
crosses: floor(offset + end) - floor(offset + begin) times. Neighbours in that
order have about the same size, so that the words taken come out near the
target and not just the number of documents.

The prefix sum of a constant is rate x rank, so only ranks are summed up, which
is exact whatever the order of summation. They are found in three levels, each
a grouped count: rows of a block, blocks of a size class, size classes of a
source. A block is a hash range of document ids that expects at most
``BLOCK_ROWS`` rows however large its source or class is, so that no task gets
a whole source.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a source of size 0 has target 0 and nothing is taken; repeated
rows are documents of their own (ties in order do not change any count, as
equal rows have equal sizes); null ids are allowed; an empty table gives an
empty result; other columns, whatever their names, are carried along by
``mix`` and ignored by ``plan_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermatch.llm.scratch import written

#: Rows that one block of the prefix sum is expected to hold at most.
BLOCK_ROWS = 16384
#: Whitespace that separates words.
WORD = r"[^\x20\x09-\x0D]+"
_KEY = "__source"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Never null, in code-point order, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _offset(key: Column, seed: str) -> Column:
    """One offset a source, a multiple of 2^-16 in [0, 1): the sum with a rank stays exact."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 4), 16, 10).cast("double") / 65536


def _block(doc_id: Column, row_hash: Column, blocks: Column | int) -> Column:
    """Pseudo-random in [0, blocks) and the same at every run; rows without an id are dealt by what they hold."""
    h = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.hex(row_hash))), 1, 8), 16, 10).cast("long")
    return h % blocks


def _size_class(size: Column) -> Column:
    """Leading three bits and bit length: sizes of a class differ by a quarter at most."""
    bits = F.bin(size)
    return F.length(bits) * 100 + F.rpad(F.substring(bits, 2, 2), 2, "0").cast("int")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: float) -> DataFrame:
    """Targets of (``__source``, ``source_size``): one row a source, far fewer than documents.

    Sources in order get ``weights`` in turn. A source is at its limit exactly if
    those with a lower limit / weight, itself included, leave less than the
    limit asks for; the rest share what is left by weight.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(Window.orderBy(_KEY)) - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    below = Window.orderBy("ratio", _KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = Window.orderBy("ratio", _KEY).rowsBetween(Window.unboundedPreceding, -1)
    s = (sizes.withColumn("weight", w)
         .withColumn("limit", F.lit(float(max_repeat)) * F.col("source_size"))
         .withColumn("ratio", F.col("limit") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(everything))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
         .withColumn("level", F.col("left") / F.col("open"))
         .withColumn("capped", F.col("ratio") <= F.col("level")))
    # the level of the first source that is below its limit holds for all that follow
    level = F.min(F.when(~F.col("capped"), F.struct("ratio", _KEY, "level"))).over(everything)["level"]
    return s.withColumn("target", F.when(F.col("capped"), F.col("limit")).otherwise(F.col("weight") * level)).select(
        _KEY, "source_size", "target")


def _ranked(rows: DataFrame, keys: list[str], n_rows: int) -> DataFrame:
    """``rows`` with ``rank``: the number of rows of the same source that stand before."""
    blocks = max(1, -(-n_rows // BLOCK_ROWS))
    rows = rows.withColumn("__block", _block(F.col("__id"), F.col("row_hash"), blocks))
    counts = rows.groupBy(_KEY, "__class", "__block").agg(F.count(F.lit(1)).alias("n"))
    within = Window.partitionBy(_KEY, "__class").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    classes = counts.groupBy(_KEY, "__class").agg(F.sum("n").alias("n"))
    before = Window.partitionBy(_KEY).orderBy("__class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select(_KEY, "__class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("class_start"))
    starts = (counts.withColumn("block_start", F.coalesce(F.sum("n").over(within), F.lit(0)))
              .join(classes, [_KEY, "__class"])
              .select(_KEY, "__class", "__block", (F.col("block_start") + F.col("class_start")).alias("__start")))
    here = Window.partitionBy(_KEY, "__class", "__block").orderBy("size", "__id", *keys)
    return (rows.withColumn("__in_block", F.row_number().over(here) - 1)
            .join(starts, [_KEY, "__class", "__block"])
            .withColumn("rank", F.col("__start") + F.col("__in_block")))


def plan_mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeat: float = 3.0, seed: str = "mix",
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: id, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` (words).

    ``row_hash`` and ``row_check`` (of id, text and source) tell the rows of equal ids apart.
    """
    rows = docs.select(F.col(id_col).alias("__id"), _source_key(F.col(source_col)).alias(_KEY),
                       n_words(F.col(text_col)).alias("size"), *_row_hashes(id_col, text_col, source_col))
    # narrow and read several times below, so the texts are scanned once
    rows = written(rows.withColumn("__class", _size_class(F.col("size"))), "mix")
    sizes = rows.groupBy(_KEY).agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    ranked = _ranked(rows, ["row_hash", "row_check"], rows.count()).join(targets, _KEY)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _offset(F.col(_KEY), seed)
    copies = F.floor(offset + rate * (F.col("rank") + 1)) - F.floor(offset + rate * F.col("rank"))
    return ranked.withColumn("copies", copies.cast("long")).select(
        F.col("__id").alias(id_col), "row_hash", "row_check", "size", F.col("source_size").cast("long"), "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _row_hashes(*cols: str) -> list[Column]:
    return [F.xxhash64(*cols).alias("row_hash"), F.hash(*cols).alias("row_check")]


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeat: float = 3.0, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        copy_col: str = "copy") -> DataFrame:
    """The mix itself: the documents with all their columns, each repeated as planned, numbered in ``copy_col``.

    A column of the documents that is already called ``copy_col`` is replaced.
    """
    plan = plan_mix(docs, weights, max_repeat, seed, id_col, text_col, source_col)
    keys = ["row_hash", "row_check"]
    plan = (plan.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
            .filter(F.col("copies") > 0))
    carried = [c for c in docs.columns if c.lower() != copy_col.lower()]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), *_row_hashes(id_col, text_col, source_col))
    # equal rows share their copies evenly; the first of them take what is left over (the join has sorted them together)
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    each = F.floor(F.col("copies") / F.col("rows"))
    n = each + (nth <= F.col("copies") - each * F.col("rows")).cast("long")
    out = packed.join(plan, keys).select("row", n.alias("n")).filter("n > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return out.select(*[F.col("row").getField(c).alias(c) for c in carried], F.col("copy").alias(copy_col))
