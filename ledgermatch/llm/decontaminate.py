"""Benchmark decontamination by greedy string tiling.

Texts in lower case are cut into tokens by Unicode category: runs of letters,
marks and numbers, while punctuation, symbols, spaces and control characters
only separate. In scripts written without spaces (Chinese, Japanese, Thai, ...)
each code point is a token. Format characters and variation selectors (soft
hyphens, joiners) are left out. A document and a test item that share a run of ``min_match``
tokens, their *seed*, are a candidate pair. Seeds that follow one another in
both texts grow into maximal matches; the longest is marked as a tile, the
matches that it cuts are cut back, and so on until no unmarked match of
``min_match`` tokens is left. Tiles never overlap in either text, but may come
in any order, so a passage whose sentences were moved still counts. An item is
found in a document if tiles cover at least ``threshold`` of its tokens. An item
of fewer tokens than ``min_match`` is its own seed: it is found where all of it
stands in one run, as one tile.

Seeds are running Karp-Rabin hashes of 64 bits. Tiles are compared byte by byte
before they count, so a collision cannot flag a document.

An index of all items' seeds goes to every task while it has at most
``MAX_INDEX_SEEDS`` seeds (16 bytes each), which is counted first. Beyond that,
documents' different seeds and items' seeds meet in a shuffled join, without the
commonest seeds of each item (as many as a found item can do without), and each
candidate document then meets each of its candidate items in a row of its own.

Defined results: null, empty and token-less texts match nothing; null ids are
carried along; repeated rows give repeated results, repeated items are found one
by one; texts are read whole; ties between equal matches go to the earlier
place in the document, then in the item; other columns, whatever their names,
are ignored by ``matches`` and kept by ``decontaminated``; without documents or
items nothing is found.
"""

from __future__ import annotations

import functools
import heapq
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgermatch.llm import textbytes
from ledgermatch.llm.scratch import row_key, unused, written

MIN_MATCH = 5
THRESHOLD = 0.8
MAX_INDEX_SEEDS = 2_000_000

_SIGN = np.ones(256, bool)
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = _SIGN[128:] = False
#: What a code point is: part of a token, a separator, a token of its own, or nothing.
_PART, _SEPARATOR, _OWN, _NOTHING = range(4)
#: Scripts written without spaces. All take three bytes or more a code point.
_UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF),
    (0x3005, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA980, 0xA9FF),
    (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x17000, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF))
_HIT = "id long, rid struct<h: long, g: long>, item_id long, coverage double, n_tiles int, longest int"


@functools.cache
def _kinds() -> np.ndarray:
    """What each code point is. Those without a category yet are parts of tokens."""
    out = np.full(0x110000, _PART, np.uint8)
    for low, high in _UNSPACED:
        out[low:high + 1] = _OWN
    # no other planes have categories
    for c in (*range(0x20000), *range(0xE0000, 0xE0200)):
        category = unicodedata.category(chr(c))
        if category[0] in "PSZ" or category == "Cc":
            out[c] = _SEPARATOR
        elif category == "Cf":
            out[c] = _NOTHING
    # U+034F joins graphemes, the others select variants
    out[0x034F] = out[0x180B:0x1810] = out[0xFE00:0xFE10] = out[0xE0100:0xE01F0] = _NOTHING
    return out


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of the tokens in them, and the n + 1 indices of each text's first token."""
    spaced = np.where(_SIGN[data], np.uint8(32), data)
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return spaced, *textbytes.word_bounds(spaced, offs)
    head = data[lead].astype(np.int64)
    size = 2 + (head >= 0xE0) + (head >= 0xF0)
    code = head & (0x7F >> size)
    for j in range(1, 4):
        more = size > j
        code[more] = code[more] << 6 | data[np.minimum(lead[more] + j, len(data) - 1)] & 0x3F
    kind = _kinds()[np.minimum(code, 0x10FFFF)]

    def places(which: int) -> np.ndarray:
        at, n = lead[kind == which], size[kind == which]
        at = np.concatenate([(at + j)[n > j] for j in range(4)])
        return at[at < len(data)]

    nothing = places(_NOTHING)
    if len(nothing):
        kept = np.ones(len(data), bool)
        kept[nothing] = False
        return _words(data[kept], np.concatenate([[0], np.cumsum(kept)])[offs])
    spaced[places(_SEPARATOR)] = 32
    own = kind == _OWN
    cuts = np.concatenate([offs, lead[own], np.minimum(lead + size, len(data))[own]])
    starts, ends, _ = textbytes.word_bounds(spaced, cuts)
    return spaced, starts, ends, np.searchsorted(starts, offs)


@dataclass
class Tokens:
    """Tokens of some texts: bytes joined by spaces, bounds, hashes, and each text's first token."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    prefix: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offs: np.ndarray) -> Tokens:
        spaced, starts, ends, first = _words(data, offs)
        text, starts, ends = textbytes.joined_words(spaced, starts, ends)
        hashes = textbytes.span_hash(textbytes.prefix_hash(text), starts, ends)
        return cls(text, starts, ends, first, textbytes.run_prefix(hashes))

    def seeds(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places at which k tokens of a text begin, and their hashes."""
        at = textbytes.window_starts(self.first, k)
        return at, textbytes.span_hash(self.prefix, at, at + k)

    def whole(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Texts of exactly n tokens, and the hashes of all of each."""
        of = np.flatnonzero(np.diff(self.first) == n)
        return of, textbytes.span_hash(self.prefix, self.first[of], self.first[of] + n)

    def bytes(self, at: int, n: int) -> bytes:
        return self.text[self.starts[at]:self.ends[at + n - 1]].tobytes()


def tiles(doc_at: np.ndarray, item_at: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, place in document, place in item) of the seed pairs of one document and item."""
    diagonal = doc_at - item_at
    order = np.lexsort((doc_at, diagonal))
    d, i, g = doc_at[order], item_at[order], diagonal[order]
    new = np.ones(len(d), bool)
    new[1:] = (np.diff(d) != 1) | (np.diff(g) != 0)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(d))) + k - 1
    heap = [(-int(n), int(x), int(y)) for n, x, y in zip(length, d[begin], i[begin], strict=True)]
    heapq.heapify(heap)
    used_doc, used_item, found = set(), set(), []
    while heap:
        n, x, y = heapq.heappop(heap)
        free = [(x + j) not in used_doc and (y + j) not in used_item for j in range(-n)]
        if all(free):
            used_doc.update(range(x, x - n))
            used_item.update(range(y, y - n))
            found.append((-n, x, y))
            continue
        run = 0
        for j, ok in enumerate([*free, False]):
            if ok:
                run += 1
            else:
                if run >= k:
                    heapq.heappush(heap, (-run, x + j - run, y + j - run))
                run = 0
    return found


class Index:
    """Seeds of some items, sorted."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, offs: np.ndarray, k: int) -> None:
        self.k, self.ids = k, ids
        self.tokens = Tokens.of(data, offs)
        at, seed = self.tokens.seeds(k)
        order = np.argsort(seed, kind="stable")
        self.seed, self.at = seed[order], at[order]
        self.item = np.searchsorted(self.tokens.first, self.at, "right") - 1
        self.size = np.diff(self.tokens.first)
        #: Items too short for a seed, by their number of tokens: hashes, and items by their bytes.
        self.short: dict[int, tuple[np.ndarray, dict[bytes, list[int]]]] = {}
        for n in np.unique(self.size[(self.size > 0) & (self.size < k)]).tolist():
            of, whole = self.tokens.whole(n)
            named = defaultdict(list)
            for i in of.tolist():
                named[self.tokens.bytes(self.tokens.first[i], n)].append(i)
            self.short[n] = np.unique(whole), dict(named)

    def find_short(self, t: Tokens, threshold: float) -> list[tuple[int, int, float, int, int]]:
        """``find`` for the items of fewer tokens than a seed, which must be there whole."""
        out = []
        for n, (hashes, named) in self.short.items() if threshold <= 1 + 1e-9 else ():
            at, seed = t.seeds(n)
            at = at[hashes[np.minimum(np.searchsorted(hashes, seed), len(hashes) - 1)] == seed]
            doc = np.searchsorted(t.first, at, "right") - 1
            for d, text in dict.fromkeys((d, t.bytes(x, n)) for d, x in zip(doc.tolist(), at.tolist(), strict=True)):
                out += [(d, i, 1.0, 1, n) for i in named.get(text, ())]
        return out

    def find(self, data: np.ndarray, offs: np.ndarray, threshold: float) -> list[tuple[int, int, float, int, int]]:
        """(document, item, coverage, tiles, longest tile) of the texts of a chunk."""
        k, t = self.k, Tokens.of(data, offs)
        out = self.find_short(t, threshold)
        at, seed = t.seeds(k)
        low = np.searchsorted(self.seed, seed, "left")
        n = np.searchsorted(self.seed, seed, "right") - low
        if not n.any():
            return out
        which = np.repeat(np.arange(len(at)), n)
        post = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low, n)
        doc_at, item_at, item = at[which], self.at[post], self.item[post]
        doc = np.searchsorted(t.first, doc_at, "right") - 1
        order = np.lexsort((item_at, item, doc))
        doc_at, item_at, item, doc = doc_at[order], item_at[order], item[order], doc[order]
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0), [True]]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            need = threshold * self.size[item[a]]
            # tiles cannot cover more than all seeds together
            places = np.unique(item_at[a:b])
            if np.minimum(np.diff(np.append(places, places[-1] + k)), k).sum() < need - 1e-9:
                continue
            found = [x for x in tiles(doc_at[a:b], item_at[a:b], k) if t.bytes(x[1], x[0]) == self.tokens.bytes(x[2], x[0])]
            covered = sum(x[0] for x in found)
            if covered >= need - 1e-9:
                out.append((int(doc[a]), int(item[a]), covered / float(self.size[item[a]]), len(found), max(x[0] for x in found)))
        return out


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    given = F.col(id_col).cast("long")
    text = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return df.select(given.alias("id"), row_key(given, F.col(text_col)).alias("rid"), text.alias("text"))


def _hits(rows: list[tuple], ids: pa.Array, rids: pa.Array, items) -> pa.RecordBatch:
    d = [r[0] for r in rows]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(d, pa.int64())), rids.take(pa.array(d, pa.int64())), pa.array([items[r[1]] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.int32())],
        ["id", "rid", "item_id", "coverage", "n_tiles", "longest"])


def _n_seeds(items: DataFrame, k: int) -> int:
    """An upper bound from the items' lengths: a token has a byte, and another one beside it, or three bytes of its own."""
    return int(items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0)


def _with_index(docs: DataFrame, items: DataFrame, k: int, threshold: float) -> DataFrame:
    known = items.select("id", "text").toArrow()  # at most MAX_INDEX_SEEDS tokens; ids stay whole numbers beside nulls
    ids = known["id"].to_pylist()
    data, offs = textbytes.byte_arrays(known["text"].cast(pa.large_string()).combine_chunks())
    sent = docs.sparkSession.sparkContext.broadcast((ids, Index(np.arange(len(ids)), data, offs, k)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, index = sent.value
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(2))
            for i, j in textbytes.chunks(offs):
                rows = index.find(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], threshold)
                if rows:
                    yield _hits([(r[0] + i, *r[1:]) for r in rows], batch.column(0), batch.column(1), names)

    return docs.mapInArrow(run, _HIT)


def _short_lengths(items: DataFrame, k: int) -> list[int]:
    """Numbers of tokens, less than ``k``, that items have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(0))
            for i, j in textbytes.chunks(offs):
                n = np.unique(np.diff(Tokens.of(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]).first))
                yield pa.RecordBatch.from_arrays([pa.array(n[(n > 0) & (n < k)].astype(np.int32))], ["n"])

    return sorted(r.n for r in items.select("text").mapInArrow(run, "n int").distinct().collect())


def _with_join(docs: DataFrame, items: DataFrame, k: int, threshold: float) -> DataFrame:
    short = _short_lengths(items, k)

    def seeds(whole: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Different seeds of each text and how often it has them; of the short lengths all runs, or ``whole`` texts only."""
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(1))
            for i, j in textbytes.chunks(offs):
                t = Tokens.of(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                size = np.diff(t.first)
                for n in [*short, k]:
                    if whole and n < k:
                        of, seed = t.whole(n)
                    else:
                        at, seed = t.seeds(n)
                        of = np.searchsorted(t.first, at, "right") - 1
                    order = np.lexsort((seed, of))
                    of, seed = of[order], seed[order]
                    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (seed[1:] != seed[:-1])])) if len(of) else np.zeros(0, np.int64)
                    times = np.diff(np.append(new, len(of)))
                    owner = batch.column(0).slice(i, j - i).take(pa.array(of[new]))
                    yield pa.RecordBatch.from_arrays([owner, pa.array(seed[new].view(np.int64)), pa.array(times), pa.array(size[of[new]])],
                                                     ["rid", "seed", "times", "size"])

    shape = "rid struct<h: long, g: long>, seed long, times long, size long"
    of_items = written(items.select("rid", "text").mapInArrow(functools.partial(seeds, True), shape).distinct(), "item-seeds")
    known = of_items.select("seed").distinct()
    hits = written(docs.select("rid", "text").mapInArrow(functools.partial(seeds, False), shape).join(known, "seed", "left_semi").select("rid", "seed"), "seed-hits")
    # tiles cover ``need`` tokens at least, a seed's place k of them; so of an item's places all but that many may be left
    # out of the search and no pair is lost: the commonest seeds are
    common = hits.groupBy("seed").agg(F.count(F.lit(1)).alias("docs"))
    least = F.greatest(F.ceil((threshold * F.col("size") - 1e-9) / k), F.lit(1))
    rarest_first = Window.partitionBy("rid").orderBy("docs", "seed")
    ranked = of_items.join(common, "seed").withColumn("before", F.sum("times").over(rarest_first) - F.col("times"))
    places = F.greatest(F.col("size") - k + 1, F.lit(1))
    sought = ranked.where(F.col("before") <= places - least).select(F.col("rid").alias("item_rid"), "seed")
    pairs = hits.join(sought, "seed").select("rid", "item_rid").distinct()
    texts = items.select(F.col("rid").alias("item_rid"), F.col("id").alias("item_id"), F.col("text").alias("item_text"))
    # one document and one item a row, however many there are of either
    both = docs.join(pairs, "rid").join(texts, "item_rid").select("id", "rid", "text", "item_id", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data, offs = textbytes.byte_arrays(batch.column(4).slice(r, 1))
                index = Index(np.arange(1), data, offs, k)
                data, offs = textbytes.byte_arrays(batch.column(2).slice(r, 1))
                rows = index.find(data, offs, threshold)
                if rows:
                    yield _hits([(r, *x[1:]) for x in rows], batch.column(0), batch.column(1), batch.column(3).slice(r, 1).to_pylist())

    return both.mapInArrow(run, _HIT)


def _found(docs: DataFrame, benchmark: DataFrame, min_match: int, threshold: float, id_col: str, text_col: str,
           item_col: str, item_text_col: str, max_index_seeds: int) -> DataFrame:
    rows, items = _texts(docs, id_col, text_col), _texts(benchmark, item_col, item_text_col)
    small = _n_seeds(items, min_match) <= max_index_seeds
    return (_with_index if small else _with_join)(rows, items, min_match, threshold)


def matches(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
            max_index_seeds: int = MAX_INDEX_SEEDS) -> DataFrame:
    """Documents and the items found in them, with the share of the item's tokens covered and the tiles."""
    found = _found(docs, benchmark, min_match, threshold, id_col, text_col, item_col, item_text_col, max_index_seeds)
    return found.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "coverage", "n_tiles", "longest")


def decontaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   max_index_seeds: int = MAX_INDEX_SEEDS) -> DataFrame:
    """The documents, with all their columns, in which no item is found."""
    found = _found(docs, benchmark, min_match, threshold, id_col, text_col, item_col, item_text_col, max_index_seeds)
    key = unused(docs, "rid")
    bad = found.select(F.col("rid").alias(key)).distinct()
    tagged = docs.withColumn(key, row_key(F.col(id_col).cast("long"), F.col(text_col)))
    return tagged.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
