"""Substring dedup of word windows by super-k-mer partitioning.

A *window* is ``window`` consecutive words of one document. A word is removed if
it lies in a window whose words also begin, in the same order, in a document
with a smaller id; windows are judged on the input.

The minimiser of a window is the least hash among its runs of ``MINIMISER``
words, so equal windows have equal minimisers. Minimisers are counted first:
windows whose minimiser stands in one document only cannot repeat and stay where
they are. Of the others, consecutive windows of one minimiser overlap in all but
one word each and travel together, as one string (a super-k-mer), to the bucket
of their minimiser. There all windows are sorted, equal ones are compared byte by
byte, and each gets the smallest id it occurs in; what is larger is marked.

Skew. Texts are shuffled once, to groups of a few megabytes. Of windows that
repeat within a chunk of a group only those of the chunk's smallest id travel,
the others being marked on the spot; so a passage that a third of all documents
share travels once per chunk. The windows of a minimiser that stands in more than
``heavy`` documents would overfill its bucket; they go to buckets by the hash of
the whole window. The number of buckets follows the bytes of the input.

Defined results: a null, empty or shorter text loses nothing; a null id counts
as larger than any other; rows with equal ids never remove each other's
windows, so repeated rows all stay; texts are read whole, whatever their
length; ids may repeat with different texts; other columns, whatever their
names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import anchors, textbytes

MINIMISER = 6
BUCKET_BYTES = 4 << 20
_PACKED = "bucket int, kind int, id binary, rid binary, start binary, n binary, text binary"


class _Chunk:
    """Words and windows of some texts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, window: int) -> None:
        starts, ends, self.first = textbytes.word_bounds(data, offs)
        self.text, self.starts, self.ends = textbytes.joined_words(data, starts, ends)
        self.begin = textbytes.window_starts(self.first, window)
        self.window = window
        self.doc = np.searchsorted(self.first, self.begin, "right") - 1
        if len(self.begin):
            words = textbytes.span_hash(textbytes.prefix_hash(self.text), self.starts, self.ends)
            self.prefix = textbytes.run_prefix(words)
            self.hash = textbytes.span_hash(self.prefix, self.begin, self.begin + window)

    def minimisers(self) -> np.ndarray:
        n = len(self.starts) - MINIMISER + 1
        at = np.arange(n)
        runs = textbytes.span_hash(self.prefix, at, at + MINIMISER)
        return textbytes.sliding_min(runs, self.window - MINIMISER + 1)[self.begin]

    def groups(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return textbytes.equal_groups(self.hash, self.text, self.starts[self.begin], self.ends[self.begin + self.window - 1])


def _runs(follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of runs, where ``follows[i]`` says that i goes on from i - 1."""
    at = np.flatnonzero(~follows)
    return at, np.diff(np.concatenate([at, [len(follows)]]))


def _least(ids: np.ndarray, order: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each window the smallest id of its group."""
    out = np.empty(len(ids), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(ids[order], at), sizes)
    return out


def _marks(ids: np.ndarray, rids: np.ndarray, begin: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows ``at`` of the same row."""
    ids, rids, begin = ids[at], rids[at], begin[at]
    follows = np.zeros(len(at), bool)
    follows[1:] = (np.diff(begin) == 1) & (ids[1:] == ids[:-1]) & (rids[1:] == rids[:-1])
    first, n = _runs(follows)
    return ids[first], rids[first], begin[first].astype(np.int32), n.astype(np.int32)


def _list(window: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        found = []
        for _, data, offs in anchors.pieces(table):
            c = _Chunk(data, offs, window)
            if len(c.begin):
                # once for each document
                value, doc = c.minimisers(), c.doc
                order = np.lexsort((doc, value))
                value, doc = value[order], doc[order]
                found.append(value[np.append(True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]))])
        return anchors.listing(table["g"][0].as_py(), found, parts)

    return run


def _pack(window: int, buckets: int, parts: int):
    names = [x.split()[0] for x in _PACKED.split(", ")]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]

    def run(texts: pa.Table, repeated: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if texts.num_rows and repeated.num_rows:
            known = anchors.Known(repeated, parts)
            squeeze = zstandard.ZstdCompressor(level=1).compress
            all_ids, all_rids = texts["id"].to_numpy(), texts["rid"].to_numpy()
            for i, data, offs in anchors.pieces(texts):
                c = _Chunk(data, offs, window)
                if not len(c.begin):
                    continue
                ids, rids = all_ids[i:][c.doc], all_rids[i:][c.doc]
                local = c.begin - c.first[c.doc]
                key = c.minimisers()
                maybe = known.of(key)
                if not maybe.any():
                    continue
                later = ids > _least(ids, *c.groups())
                if later.any():
                    m = _marks(ids, rids, local, np.flatnonzero(later))
                    # spread over negative buckets, which only pass them on
                    rows.append((-1 - int(rids[0] % buckets), 1, *[x.tobytes() for x in m], b""))
                go = np.flatnonzero(maybe & ~later)
                key = np.where(known.too_frequent(key[go]), c.hash[go], key[go])
                follows = np.zeros(len(go), bool)
                follows[1:] = (np.diff(c.begin[go]) == 1) & (key[1:] == key[:-1]) & (c.doc[go][1:] == c.doc[go][:-1])
                at, n = _runs(follows)
                bucket = (textbytes.mix64(key[at]) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                at, n, bucket = at[by], n[by], bucket[by]
                word = c.begin[go][at]
                # each string takes along the space after its last word
                text, cut = textbytes.spans(c.text, c.starts[word], c.ends[word + n + window - 2] + 1)
                ids, rids, local, n = ids[go][at], rids[go][at], local[go][at].astype(np.int32), n.astype(np.int32)
                bound = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
                for x, y in zip(bound[:-1], bound[1:], strict=True):
                    rows.append((int(bucket[x]), 0, squeeze(ids[x:y].tobytes()), squeeze(rids[x:y].tobytes()), local[x:y].tobytes(),
                                 n[x:y].tobytes(), squeeze(text[cut[x]:cut[y]].tobytes())))
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.table({name: pa.array(v, k) for name, v, k in zip(names, columns, kinds, strict=True)})

    return run


def _settle(window: int, groups: int):
    def run(table: pa.Table) -> pa.Table:
        wide = zstandard.ZstdDecompressor().decompress
        parts = table.to_pydict()
        out: list[tuple[np.ndarray, ...]] = []
        packed: list[list] = [[], [], [], [], []]
        for k, i, r, s, n, t in zip(*[parts[x] for x in ("kind", "id", "rid", "start", "n", "text")], strict=True):
            if k:
                out.append((np.frombuffer(i, np.int64), np.frombuffer(r, np.int64), np.frombuffer(s, np.int32), np.frombuffer(n, np.int32)))
            else:
                for to, x in zip(packed, (np.frombuffer(wide(i), np.int64), np.frombuffer(wide(r), np.int64), np.frombuffer(s, np.int32),
                                          np.frombuffer(n, np.int32), np.frombuffer(wide(t), np.uint8)), strict=True):
                    to.append(x)
        if packed[0]:
            ids, rids, start, n, text = [np.concatenate(x) for x in packed]
            # a string of n windows has n + window - 1 words, each with a space after it
            ends = np.flatnonzero(textbytes.SPACE[text])
            offs = np.concatenate([[0], ends[np.cumsum(n.astype(np.int64) + window - 1) - 1] + 1])
            c = _Chunk(text, offs, window)
            ids, rids = ids[c.doc], rids[c.doc]
            place = start[c.doc] + (c.begin - c.first[c.doc])
            later = np.flatnonzero(ids > _least(ids, *c.groups()))
            out.append(_marks(ids, rids, place, later))
        return anchors.marks_by_group(out, groups)

    return run


_RESULT = "id long, no_id boolean, n_words long, n_removed long, kept binary"


def _cut(window: int):
    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        parts = [pa.table({"id": pa.array([], pa.int64()), "no_id": pa.array([], pa.bool_()), "n_words": pa.array([], pa.int64()),
                           "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.binary())})]
        ids, rids = texts["id"].to_numpy(), texts["rid"].to_numpy()
        m_id, m_rid, m_start, m_n = anchors.marks_of(marks)
        for i, data, offs in anchors.pieces(texts):
            starts, ends, first = textbytes.word_bounds(data, offs)
            n_docs = len(offs) - 1
            cover = np.zeros(len(starts) + 1, np.int64)
            low = np.searchsorted(m_rid, rids[i:i + n_docs], "left")
            n = np.searchsorted(m_rid, rids[i:i + n_docs], "right") - low
            doc = np.repeat(np.arange(n_docs), n)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - low, n)
            same = m_id[at] == ids[i:][doc]
            doc, at = doc[same], at[same]
            np.add.at(cover, first[doc] + m_start[at], 1)
            np.add.at(cover, first[doc] + m_start[at] + m_n[at] + window - 1, -1)
            stay = np.cumsum(cover[:-1]) == 0
            text, _, to = textbytes.joined_words(data, starts[stay], ends[stay])
            bound = np.concatenate([[0], np.cumsum(stay)])[first]
            cut = np.concatenate([[0], to + 1])[bound]
            kept = [text[x:max(x, y - 1)].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
            n = np.diff(first)
            parts.append(pa.table({"id": pa.array(ids[i:i + n_docs]), "no_id": texts["no_id"].slice(i, n_docs), "n_words": pa.array(n),
                                   "n_removed": pa.array(n - np.diff(bound)), "kept": pa.array(kept, pa.binary())}))
        return pa.concat_tables(parts)

    return run


def dedup_substrings(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text",
                     heavy: int = anchors.HEAVY) -> DataFrame:
    """One row a document: id, ``kept`` (the words that stay, joined by one space), ``n_words`` and ``n_removed``."""
    if window <= MINIMISER:
        raise ValueError(f"windows must be longer than {MINIMISER} words")
    rows, groups, total = anchors.grouped_rows(docs, id_col, text_col)
    by_group = rows.groupBy("g")
    listed = by_group.applyInArrow(_list(window, groups), anchors.LISTED)
    repeated = anchors.repeated(listed, heavy)
    buckets = max(32, -(-2 * total // BUCKET_BYTES))
    packed = by_group.cogroup(repeated.groupBy("g")).applyInArrow(_pack(window, buckets, groups), _PACKED)
    marks = packed.groupBy("bucket").applyInArrow(_settle(window, groups), anchors.MARKS)
    found = by_group.cogroup(marks.groupBy("g")).applyInArrow(_cut(window), _RESULT)
    return found.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_words", "n_removed", "kept")
