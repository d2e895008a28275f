"""Substring dedup of bytes by merging Burrows-Wheeler transforms.

A byte is removed if it lies in a string of ``length`` bytes that also starts
anywhere else, in the same text or another one; strings never cross texts and
are judged on the input.

*Which strings can repeat at all.* Every string has an anchor: the least hash
among its runs of ``ANCHOR`` bytes. Equal strings have equal anchors, so only
strings whose anchor stands in two places go on (about
one anchor in 70 bytes is counted in place of all suffixes). Consecutive strings of one anchor
overlap and go on as one *segment*, to the bucket of their anchor. Anchors in
more than ``heavy`` places would overfill a bucket; their strings go one by one,
to buckets by the hash of the whole string.

*Merging.* In a bucket, equal segments are one: they were found by hash and compared
byte by byte, and their strings repeat if there were several, without a merge.
Segments that share an anchor with another one, or hold it twice,
are dealt to shards of ``SHARD_BYTES``. Each shard's Burrows-Wheeler transform
is built by itself. All shards are then merged by refining their interleave:
rows are blocks of equal first symbols to begin with; a round tells rows of one
block apart by the block of the suffix that starts as many symbols further on,
which the transform's own successor map leads to. So known depth doubles each
round, rows of a shard keep the order they have, and rows that stand alone drop
out. Rows that still share a block at depth ``length`` have a common prefix of
that length: each such block is a repeated interval.

*Groups.* Texts are dealt to groups of a few megabytes by a hash of id and
text, and shuffled once; anchors are counted, segments cut and results put
together by group. Segments that occur more than once in a group are settled
there and travel once, so a passage that a third of all texts share reaches its
bucket once per group.

Defined results: null, empty and shorter texts lose nothing; repeated rows are
texts of their own, so each of them loses what the other has; null ids are
allowed; texts are read whole; other columns, whatever their names, are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import anchors, textbytes

ANCHOR = 64
BUCKET_BYTES = 4 << 20
SHARD_BYTES = 256 << 10
#: Strings of one segment at most; longer runs are cut.
RUN = 4096
_U = np.uint64


# ---- Burrows-Wheeler transforms -------------------------------------------------------------------------------------

def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform and suffix order of strings that each end in their own 0, by prefix doubling.

    The ends count as different and in order, so no two suffixes are equal.
    """
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    rank = symbols.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    order = np.argsort(rank, kind="stable")
    rank, open_rows = _renamed(rank[order], order, np.empty(n, np.int64), np.zeros(n, np.int64))
    h = 1
    while len(open_rows):
        nxt = np.where(open_rows + h < n, rank[np.minimum(open_rows + h, n - 1)], 0)
        by = np.argsort(rank[open_rows] * n + nxt, kind="stable")
        rows = open_rows[by]
        rank, open_rows = _renamed((rank[open_rows] * n + nxt)[by], rows, rank, rank[rows].copy())
        h *= 2
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    before = symbols[suffixes - 1].copy()
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(0, np.int64)
    before[rank[starts]] = 0
    return before, suffixes


def _renamed(keys: np.ndarray, rows: np.ndarray, names: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gives sorted ``rows`` of the blocks named ``base`` new names by their keys: the place of the first equal one.

    A block's name is the place of its first row among all, so names order the rows. Also returns the rows that
    still share a name.
    """
    m = len(rows)
    if not m:
        return names, rows
    new = np.ones(m, bool)
    new[1:] = keys[1:] != keys[:-1]
    block = np.ones(m, bool)
    block[1:] = base[1:] != base[:-1]
    at = np.arange(m)
    first = np.maximum.accumulate(np.where(new, at, 0))
    block_first = np.maximum.accumulate(np.where(block, at, 0))
    names[rows] = base + first - block_first
    alone = new & np.append(new[1:], True)
    return names, rows[~alone]


def repeated_intervals(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges transforms up to ``depth``; rows (counted through all shards) that share a prefix of that length.

    Returns those rows and their blocks' names. Only the transforms are used: the successor of a row (the suffix
    without its first symbol) is its place in the stable order of the transform's symbols.
    """
    offsets = np.cumsum([0, *[len(t) for t in transforms]])
    n = int(offsets[-1])
    step = np.empty(n, np.int64)
    head = np.empty(n, np.uint16)
    for t, a, b in zip(transforms, offsets[:-1], offsets[1:], strict=True):
        order = np.argsort(t, kind="stable")
        step[a:b] = order + a
        head[a:b] = t[order]
    order = np.argsort(head, kind="stable")
    blocks, rows = _renamed(head[order], order, np.empty(n, np.int64), np.zeros(n, np.int64))
    # successors by powers of two; the last round needs a sum of them
    powers, h = [step], 1
    while h < depth and len(rows):
        ahead = min(h, depth - h)
        jump = None
        for bit in range(ahead.bit_length()):
            if ahead >> bit & 1:
                while len(powers) <= bit:
                    powers.append(powers[-1][powers[-1]])
                jump = powers[bit][rows] if jump is None else powers[bit][jump]
        keys = blocks[rows] * n + blocks[jump]
        by = np.argsort(keys, kind="stable")
        rows = rows[by]
        blocks, rows = _renamed(keys[by], rows, blocks, blocks[rows].copy())
        h += ahead
    return rows, blocks[rows]


def repeats_in(data: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES) -> np.ndarray:
    """Places in ``data`` at which strings of ``length`` bytes start, inside the segments, that start elsewhere in them too."""
    at, transforms, places = 0, [], []
    sizes = np.cumsum(end - begin)
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + shard_bytes, "right")))
        text, offs = textbytes.spans(data, begin[at:to], end[at:to])
        size = np.diff(offs)
        # each segment's symbols (bytes + 1) and its end
        symbols = np.zeros(len(text) + len(size), np.uint16)
        place = np.arange(len(text)) + np.repeat(np.arange(len(size)), size)
        symbols[place] = text.astype(np.uint16) + 1
        source = np.full(len(symbols), -1, np.int64)
        source[place] = np.arange(len(text)) + np.repeat(begin[at:to] - offs[:-1], size)
        left = np.zeros(len(symbols), np.int64)
        left[place] = np.repeat(offs[1:], size) - np.arange(len(text))
        bwt, suffixes = transform(symbols)
        transforms.append(bwt)
        places.append(np.where(left[suffixes] >= length, source[suffixes], -1))
        at = to
    if not transforms:
        return np.zeros(0, np.int64)
    rows, _ = repeated_intervals(transforms, length)
    found = np.concatenate(places)[rows]
    # a prefix of full length never reaches its segment's end, so blocks are all in or all out
    return np.sort(found[found >= 0])


# ---- anchors --------------------------------------------------------------------------------------------------------

class _Piece:
    """Anchors and strings of some texts."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, length: int) -> None:
        n, w = len(data), length - ANCHOR + 1
        self.begin = textbytes.window_starts(offs, length)
        self.data, self.length = data, length
        if not len(self.begin):
            return
        self.doc = np.searchsorted(offs, self.begin, "right") - 1
        self.prefix = textbytes.prefix_hash(data)
        at = np.arange(n - ANCHOR + 1)
        self.hash = textbytes.span_hash(self.prefix, at, at + ANCHOR)
        self.least = textbytes.sliding_min(self.hash, w)

    def anchors(self) -> np.ndarray:
        """Hashes at all places that are the least of some string, places of equal hash apart."""
        w = self.length - ANCHOR + 1
        inside = np.zeros(len(self.least), _U)
        inside[self.begin] = self.least[self.begin]
        # the greatest minimum of the strings around a place is its own hash if it is an anchor
        padded = np.concatenate([np.zeros(w - 1, _U), inside, np.zeros(len(self.hash) + w - 1 - len(inside) - (w - 1), _U)])
        most = ~textbytes.sliding_min(~padded, w)[:len(self.hash)]
        return self.hash[(most == self.hash) & (most > 0)]


def _list(length: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        found = []
        for _, data, offs in anchors.pieces(table):
            p = _Piece(data, offs, length)
            if len(p.begin):
                found.append(p.anchors())
        return anchors.listing(table["g"][0].as_py(), found, parts)

    return run


# ---- segments -------------------------------------------------------------------------------------------------------

_SEGMENT = "bucket int, kind int, id binary, rid binary, start binary, n binary, anchor binary, twice binary, text binary"


def _segments(length: int, buckets: int, parts: int):
    names = [x.split()[0] for x in _SEGMENT.split(", ")]
    empty = pa.table({x: pa.array([], pa.int32() if x in ("bucket", "kind") else pa.binary()) for x in names})

    def run(texts: pa.Table, repeated: pa.Table) -> pa.Table:
        if not texts.num_rows or not repeated.num_rows:
            return empty
        known = anchors.Known(repeated, parts)
        data, offs = textbytes.byte_arrays(texts["text"])
        ids, rids = texts["id"].to_numpy(), texts["rid"].to_numpy()
        kept: list[tuple[np.ndarray, ...]] = []
        for i, j in textbytes.chunks(offs):
            p = _Piece(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], length)
            if not len(p.begin):
                continue
            least = p.least[p.begin]
            go = np.flatnonzero(known.of(least))
            if not len(go):
                continue
            begin, doc, key = p.begin[go], p.doc[go], least[go]
            own = np.where(known.too_frequent(key), textbytes.span_hash(p.prefix, begin, begin + length), key)
            new = np.ones(len(go), bool)
            new[1:] = (np.diff(begin) != 1) | (own[1:] != own[:-1]) | (doc[1:] != doc[:-1])
            run_at = np.arange(len(go)) - np.maximum.accumulate(np.where(new, np.arange(len(go)), 0))
            at = np.flatnonzero(new | (run_at % RUN == 0))
            n = np.diff(np.append(at, len(go)))
            a, b = begin[at], begin[at] + n + length - 1
            # places of the anchor's hash in the segment: two may repeat a string inside it
            spots = np.flatnonzero(np.isin(p.hash, np.unique(key[at])))
            order = np.lexsort((spots, p.hash[spots]))
            spots, values = spots[order], p.hash[spots][order]
            twice = _pairs(values, spots, key[at], a, b - ANCHOR + 1)
            kept.append((ids[i + doc[at]], rids[i + doc[at]], a - (offs[i + doc[at]] - offs[i]), n, own[at], twice,
                         textbytes.span_hash(p.prefix, a, b), a + offs[i], b + offs[i]))
        if not kept:
            return empty
        id_, rid, start, n, anchor, twice, hashes, a, b = [np.concatenate(x) for x in zip(*kept, strict=True)]
        order, first, size = textbytes.equal_groups(hashes, data, a, b)
        rows: list[tuple] = []
        several = np.repeat(size > 1, size)
        lead = np.zeros(len(order), bool)
        lead[first] = True
        if several.any():
            at = order[several]
            rows.append((-1 - int(rid[0] % buckets), 1, *[x[at].tobytes() for x in (id_, rid, start, n)], b"", b"", b""))
        go = order[lead]
        bucket = (textbytes.mix64(anchor[go]) % _U(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        go, bucket = go[by], bucket[by]
        cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for x, y in zip(cut[:-1], cut[1:], strict=True):
            # one bucket's text at a time: strings of too frequent anchors, one by one, are many times the text they come from
            part = go[x:y]
            text, _ = textbytes.spans(data, a[part], b[part])
            rows.append((int(bucket[x]), 0, *[v[part].tobytes() for v in (id_, rid, start, n, anchor, twice)], squeeze(text.tobytes())))
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 7]
        return pa.table({name: pa.array(v, k) for name, v, k in zip(names, zip(*rows, strict=True), kinds, strict=True)})

    return run


def _pairs(values: np.ndarray, spots: np.ndarray, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether ``wanted`` stands at two spots or more in [begin, end); ``values`` and ``spots`` are sorted."""
    known = np.unique(values)
    code = np.searchsorted(known, values)
    wide = int(spots.max()) + 2 if len(spots) else 2
    keys = code * wide + spots
    base = np.searchsorted(known, wanted) * wide
    return np.searchsorted(keys, base + np.minimum(end, wide - 1)) - np.searchsorted(keys, base + np.minimum(begin, wide - 1)) > 1


def _settle(length: int, groups: int):
    def run(table: pa.Table) -> pa.Table:
        wide = zstandard.ZstdDecompressor().decompress
        marks: list[tuple[np.ndarray, ...]] = []
        parts: list[tuple[np.ndarray, ...]] = []
        column = {x: table[x].to_pylist() for x in table.column_names}
        whole = [np.int64] * 4
        for k in range(table.num_rows):
            numbers = tuple(np.frombuffer(column[x][k], t) for x, t in zip(("id", "rid", "start", "n"), whole, strict=True))
            if column["kind"][k]:
                marks.append(numbers)
            else:
                parts.append((*numbers, np.frombuffer(column["anchor"][k], _U), np.frombuffer(column["twice"][k], bool),
                              np.frombuffer(wide(column["text"][k]), np.uint8)))
        if parts:
            id_, rid, start, n, anchor, twice, text = [np.concatenate(x) for x in zip(*parts, strict=True)]
            end = np.cumsum(n + length - 1)
            begin = end - n - length + 1
            order, first, size = textbytes.equal_groups(
                textbytes.span_hash(textbytes.prefix_hash(text), begin, end), text, begin, end)
            at = order[np.repeat(size > 1, size)]
            marks.append((id_[at], rid[at], start[at], n[at]))
            # of equal segments one goes on; alone with its anchor it has nothing to meet
            lead = order[first]
            _, code, often = np.unique(anchor[lead], return_inverse=True, return_counts=True)
            go = np.flatnonzero((often[code] > 1) | twice[lead])
            hit = repeats_in(text, begin[lead[go]], end[lead[go]], length)
            if len(hit):
                # runs of places that follow one another, by segment
                by_place = go[np.argsort(begin[lead[go]])]
                seg = by_place[np.searchsorted(begin[lead[by_place]], hit, "right") - 1]
                new = np.ones(len(hit), bool)
                new[1:] = (np.diff(hit) != 1) | (seg[1:] != seg[:-1])
                at = np.flatnonzero(new)
                count = np.diff(np.append(at, len(hit)))
                seg, shift = seg[at], hit[at] - begin[lead[seg[at]]]
                # and for all segments equal to it
                times = size[seg]
                member = order[np.repeat(first[seg], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
                marks.append((id_[member], rid[member], start[member] + np.repeat(shift, times), np.repeat(count, times)))
        return anchors.marks_by_group(marks, groups)

    return run


# ---- operator -------------------------------------------------------------------------------------------------------

_RESULT = "id long, no_id boolean, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(length: int):
    def run(texts: pa.Table, marks: pa.Table) -> pa.Table:
        out: dict[str, list] = {x.split()[0]: [] for x in _RESULT.split(", ")}
        data, offs = textbytes.byte_arrays(texts["text"])
        ids, rids = texts["id"].to_numpy(), texts["rid"].to_numpy()
        m_id, m_rid, m_start, m_n = anchors.marks_of(marks)
        for d in range(texts.num_rows):
            a, b = np.searchsorted(m_rid, rids[d], "left"), np.searchsorted(m_rid, rids[d], "right")
            own = np.arange(a, b)[m_id[a:b] == ids[d]]
            size = int(offs[d + 1] - offs[d])
            spans: list[list[int]] = []
            for s, e in sorted(zip(m_start[own].tolist(), (m_start[own] + m_n[own] + length - 1).tolist(), strict=True)):
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
            text, at, pieces = memoryview(data)[offs[d]:offs[d + 1]], 0, []
            for s, e in spans:
                pieces.append(text[at:s])
                at = e
            pieces.append(text[at:])
            for name, value in zip(out, (int(ids[d]), None, size, sum(e - s for s, e in spans), len(spans), b"".join(pieces)), strict=True):
                out[name].append(value)
        out["no_id"] = texts["no_id"].to_pylist()
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    return run


def dedup_bytes(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                heavy: int = anchors.HEAVY) -> DataFrame:
    """One row a document: id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the bytes that stay)."""
    if length < ANCHOR + 1:
        raise ValueError(f"strings must be longer than {ANCHOR} bytes")
    rows, groups, total = anchors.grouped_rows(docs, id_col, text_col)
    by_group = rows.groupBy("g")
    listed = by_group.applyInArrow(_list(length, groups), anchors.LISTED)
    repeated = anchors.repeated(listed, heavy)
    buckets = max(16, -(-2 * total // BUCKET_BYTES))
    segments = by_group.cogroup(repeated.groupBy("g")).applyInArrow(_segments(length, buckets, groups), _SEGMENT)
    marks = segments.groupBy("bucket").applyInArrow(_settle(length, groups), anchors.MARKS)
    found = by_group.cogroup(marks.groupBy("g")).applyInArrow(_cut(length), _RESULT)
    return found.select(F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
