"""SimHash near-duplicates by a grid range-join over segment popcounts.

*Fingerprints.* A text in lower case (A-Z only) is cut into words, and these into
shingles of ``shingle`` consecutive words joined by one space, repeats
included; a text of fewer words is one shingle. Bit i of the fingerprint is 1
if it is set in more than half of the shingles' XXH64 values.

*Embedding.* Each half of a fingerprint is cut into 16 segments of two bits.
The vector of the segments' bit counts moves by at most 1 in Manhattan distance
for each bit that differs, so that distance is a lower bound of the bit
distance. Of two fingerprints within ``bits`` = 4, one half is within 2.

*Grid range-join.* All vectors within 1 of a fingerprint's own are the cells it
is put into. Any two vectors within 2 share a cell: either is the other's
neighbour, or a vector on the way between them is neighbour of both. Brought
together by (half, cell), pairs are verified exactly by the bits of their
exclusive or. ``max_bits`` up to 5 is covered (both halves beyond 2 would make 6).

*Forests.* Components need no complete list of links, so a cell yields a spanning
forest of its links: from a fingerprint all that it links to, from those all
further ones, until none is left. That is at most one row for each fingerprint of
the cell, however densely its fingerprints lie. A cell of more than ``CELL_ROWS``
fingerprints is split by the cells of the other half's two quarters (of which one
is within 2 as well); what is still larger is dealt to blocks, and each pair of
blocks is searched on its own. So a task holds two blocks at most, and no pair is
left out.

*Groups.* Equal fingerprints are one node from the start, whose smallest id
stands for it. Components of the links are found by alternating large-star and
small-star steps, each of them a grouped join, until nothing changes; after
each step the edges are written to the shared folder.

Defined results: a null or empty text, or one without words, has the fingerprint
zero, which links like any other; repeated rows are equal fingerprints; null
ids belong to their component, but are never its name unless all its ids are
null; long texts are read whole; other columns, whatever their names, are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import components, textbytes
from ledgermatch.llm.scratch import row_key, unused, written

SEED = 42
#: Fingerprints of a cell that are searched as one group.
CELL_ROWS = 16384
#: Byte -> eight one-byte counters, one for each bit.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def majority_bits(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit majority of each group of ``hashes``; ``first`` has the n + 1 bounds. Empty groups give 0."""
    sizes = np.diff(first)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    # one-byte counters hold 255 at most, so longer groups are summed in parts
    parts = -(-sizes[full] // 255)
    begin = np.repeat(first[:-1][full], parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    sums = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], begin, axis=0)
    counts = np.add.reduceat(np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64).astype(np.int64), np.cumsum(parts) - parts, axis=0)
    bits = 2 * counts > sizes[full][:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").copy().view(np.uint64)[:, 0]
    return out


def text_fingerprints(data: np.ndarray, offs: np.ndarray, shingle: int) -> np.ndarray:
    """Fingerprints of the texts of a chunk."""
    data = textbytes.lower_ascii(data)
    starts, ends, first = textbytes.word_bounds(data, offs)
    if not len(starts):
        return np.zeros(len(offs) - 1, np.uint64)
    joined, starts, ends = textbytes.joined_words(data, starts, ends)
    begin = textbytes.window_starts(first, shingle)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    a = np.concatenate([starts[begin], starts[first[short]]])
    b = np.concatenate([ends[begin + shingle - 1], ends[first[short] + counts[short] - 1]])
    owner = np.concatenate([np.searchsorted(first, begin, "right") - 1, short])
    order = np.argsort(owner, kind="stable")
    buf, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(buf[i:j], SEED) for i, j in zip(a.tolist(), b.tolist(), strict=True)), np.uint64, len(a))
    return majority_bits(hashes[order], np.searchsorted(owner[order], np.arange(len(offs))))


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``rid`` (two hashes of id and text) and ``fp``, the fingerprint as a signed 64-bit number."""
    given, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    narrow = docs.select(given.alias("id"), text.alias("text"), row_key(given, text).alias("rid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(1))
            found = [text_fingerprints(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shingle) for i, j in textbytes.chunks(offs)]
            fps = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], ["id", "rid", "fp"])

    return narrow.mapInArrow(run, "id long, rid struct<h: long, g: long>, fp long")


def _cells(fp: Column, low: int, width: int) -> list[Column]:
    """Cells of the ``width`` bits from bit ``low`` on: their packed bit counts by two, and all vectors within 1."""
    mask = (1 << width) - 1
    part = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(mask).cast("long"))
    counts = part - F.shiftright(part, 1).bitwiseAND(F.lit(0x55555555 & mask).cast("long"))
    field = lambda j: F.shiftright(counts, 2 * j).bitwiseAND(F.lit(3).cast("long"))
    one = lambda j: F.lit(1 << (2 * j)).cast("long")
    near = [F.when(field(j) < 2, counts + one(j)) for j in range(width // 2)]
    return [counts, *near, *[F.when(field(j) > 0, counts - one(j)) for j in range(width // 2)]]


def _tagged_cells(fp: Column, low: int, width: int) -> Column:
    """The cells as an array, told apart from those of other bits by ``low``."""
    return F.transform(F.array_compact(F.array(*_cells(fp, low, width))), lambda c: c + F.lit(low << 32).cast("long"))


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the links of a spanning forest of ``fps``, which link at ``max_bits`` different bits or fewer."""
    ends, left = [], fps
    while len(left) > 1:
        reached, left = [left[:1]], left[1:]
        while reached and len(left):
            heads, reached = reached.pop(), reached
            for head in heads:
                near = np.bitwise_count(left ^ head) <= max_bits
                if near.any():
                    ends.append((np.full(int(near.sum()), head), left[near]))
                    reached.append(left[near])
                    left = left[~near]
                    if not len(left):
                        break
    if not ends:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([a for a, _ in ends]), np.concatenate([b for _, b in ends])


def _runs_forest(key: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The forests of all cells of a chunk that is sorted by ``key``; most cells are small and compared together."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    small = np.repeat((size > 1) & (size <= 16), size)
    place, whole = np.arange(len(key)) - np.repeat(first, size), np.repeat(size, size)
    a, b = [], []
    for lag in range(1, 16):
        at = np.flatnonzero(small & (place + lag < whole))
        if not len(at):
            break
        hit = at[np.bitwise_count(fps[at] ^ fps[at + lag]) <= max_bits]
        a.append(hit)
        b.append(hit + lag)
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    run = np.searchsorted(first, a, "right") - 1
    # a cell with as many links as fingerprints has more than a forest
    links = np.bincount(run, minlength=len(first))
    dense = links >= size
    dense |= size > 16
    keep = ~dense[run]
    ends = [(fps[a[keep]], fps[b[keep]])]
    ends += [forest(fps[first[r]:first[r] + size[r]], max_bits) for r in np.flatnonzero(dense & (size > 1)).tolist()]
    return np.concatenate([x for x, _ in ends]), np.concatenate([y for _, y in ends])


def _links_by_key(keyed: DataFrame, max_bits: int, limit: int) -> DataFrame:
    """Links (``a``, ``b``) within each ``key``, or the key and its number ``n`` of rows where that is over ``limit``.

    One pass over rows sorted by key, holding one key's rows at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, over = np.zeros(0, np.int64), np.zeros(0, np.uint64), 0

        def out(a, b, keys=(), counts=()):
            m = len(keys)
            a, b = a.view(np.int64), b.view(np.int64)
            pad = pa.nulls(m, pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(np.minimum(a, b)), pad]), pa.concat_arrays([pa.array(np.maximum(a, b)), pad]),
                 pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(keys, pa.int64())]),
                 pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(counts, pa.int64())])], ["a", "b", "key", "n"])

        none = np.zeros(0, np.uint64)
        for batch in batches:
            key, fps = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(key):
                continue
            if over:
                more = int(np.searchsorted(key, held_key[0], "right")) if key[0] == held_key[0] else 0
                over, key, fps = over + more, key[more:], fps[more:]
                if not len(key):
                    continue
                yield out(none, none, [int(held_key[0])], [over])
                held_key, held, over = held_key[:0], held[:0], 0
            key, fps = np.concatenate([held_key, key]), np.concatenate([held, fps])
            last = int(np.searchsorted(key, key[-1], "left"))
            if last:
                sizes = np.flatnonzero(np.concatenate([[True], key[1:last] != key[:last - 1], [True]]))
                big = np.flatnonzero(np.diff(sizes) > limit)
                fine = np.ones(last, bool)
                for r in big.tolist():
                    fine[sizes[r]:sizes[r + 1]] = False
                a, b = _runs_forest(key[:last][fine], fps[:last][fine], max_bits) if fine.any() else (none, none)
                yield out(a, b, key[sizes[big]], np.diff(sizes)[big])
            held_key, held = key[last:].copy(), fps[last:].copy()
            if len(held) > limit:
                over, held_key, held = len(held), held_key[:1], held[:0]
        if over:
            yield out(none, none, [int(held_key[0])], [over])
        elif len(held) > 1:
            yield out(*_runs_forest(held_key, held, max_bits))

    return keyed.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long, key long, n long")


def spanning_links(distinct: DataFrame, max_bits: int = 4, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (``a`` < ``b``) of the different fingerprints in column ``fp`` that join up all that lie within ``max_bits`` bits.

    Two fingerprints are in one component of these links exactly if they are in one of all links. Keys are hashes of
    cells: two cells under one key are searched together, which can add true links only.
    """
    if not 0 <= max_bits <= 5:
        raise ValueError("two halves of radius 2 cover at most 5 bits")
    both = F.concat(_tagged_cells(F.col("fp"), 0, 32), _tagged_cells(F.col("fp"), 32, 32))
    cells = distinct.select("fp", F.explode(both).alias("cell")).select(
        "fp", F.when(F.col("cell") < F.lit(32 << 32).cast("long"), 0).otherwise(32).alias("low"), F.xxhash64("cell").alias("key"))
    found = written(_links_by_key(cells, max_bits, cell_rows), "simhash-links")
    parts, heavy = [found], found.where("n is not null").select("key", "n")
    if heavy.head(1):
        # the other half, by quarters
        quarters = lambda low: F.concat(_tagged_cells(F.col("fp"), low, 16), _tagged_cells(F.col("fp"), low + 16, 16))
        inner = F.explode(F.when(F.col("low") == 0, quarters(32)).otherwise(quarters(0)))
        split = cells.join(heavy, "key").select("fp", "key", inner.alias("quarter")).select("fp", F.xxhash64("key", "quarter").alias("key"))
        found = written(_links_by_key(split, max_bits, cell_rows), "simhash-links")
        parts, heavy = [*parts, found], found.where("n is not null").select("key", "n")
        if heavy.head(1):
            blocks = F.ceil(F.col("n") / F.lit(cell_rows)).cast("int")
            dealt = split.join(heavy, "key").select("fp", "key", blocks.alias("blocks")).select(
                "*", F.pmod(F.xxhash64(F.col("fp"), F.lit("block")), "blocks").cast("int").alias("own"))
            dealt = dealt.select("fp", "key", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).where("own != other")
            pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
            # two blocks of a hash never come to four times what one expects
            parts.append(_links_by_key(dealt.select("fp", pair.alias("key")), max_bits, 1 << 62))
    return functools.reduce(DataFrame.union, parts).where("a is not null").select("a", "b").distinct()


def _named(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents' fingerprints, and for each different one the least id of its component."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fps")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("node_id")), "simhash-nodes")
    roots = components.connected(spanning_links(nodes.select("fp"), max_bits))
    named = (nodes.join(roots, nodes.fp == roots.node, "left")
             .select("fp", "node_id", F.coalesce("root", "fp").alias("root")))
    names = named.groupBy("root").agg(F.min("node_id").alias("component_id"))
    return fps, named.join(names, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row a document: id, ``fp`` and ``component_id``, the smallest id that links reach from it."""
    fps, by_fp = _named(docs, shingle, max_bits, id_col, text_col)
    return fps.join(by_fp, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that have the least id of their component.

    Of several rows with that id the one with the least hash of its text stays, and of rows equal in both any one.
    """
    fps, by_fp = _named(docs, shingle, max_bits, id_col, text_col)
    first = F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("first")
    stay = fps.join(by_fp, "fp").groupBy("root").agg(first).select("first.rid")
    # two plain columns: of equal rows one stays, and the join has brought them together already
    keys = [unused(docs, "rid_h"), unused(docs, "rid_g")]
    own = row_key(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    tagged = docs.withColumns({k: own.getField(f) for k, f in zip(keys, "hg", strict=True)})
    stay = stay.select(*[F.col(f"rid.{f}").alias(k) for k, f in zip(keys, "hg", strict=True)])
    return tagged.join(stay, keys, "left_semi").dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])
