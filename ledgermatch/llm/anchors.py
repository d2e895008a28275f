"""Which anchors of texts stand in more than one place, counted by group of texts.

An anchor is a 64-bit hash that equal strings have in common. Texts are dealt to
groups by a hash; each group lists its anchors, the lists meet by part of the
hash range, and each group gets back those of its anchors that others have as
well or that it has several times. There are as many parts as groups, so the
upper bits tell the part and 32 lower ones the anchor: at any size about one
anchor in ten thousand passes by an equal code, which costs work and no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import textbytes

GROUP_BYTES = 12 << 20
#: Places from which an anchor counts as too frequent for one bucket.
HEAVY = 1 << 15
#: Of a null id: larger than any other.
NULL_ID = (1 << 63) - 1
_U = np.uint64
LISTED = "part int, g int, codes binary, counts binary"
REPEATED = "g int, part int, codes binary, heavy binary"
MARKS = "g int, id binary, rid binary, start binary, n binary"
_FIELDS = ("id", "rid", "start", "n")


def group_count(total_bytes: int) -> int:
    return max(8, -(-total_bytes // GROUP_BYTES))


def grouped_rows(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int, int]:
    """``g``, ``id``, ``no_id``, ``rid`` and ``text`` of the documents, the number of groups, and the bytes of all texts.

    ``rid`` tells rows of one id by their text; equal rows share it, and their group.
    """
    given = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups, rid = group_count(total), F.xxhash64(given, text)
    rows = docs.select(group_of(rid, groups).alias("g"), F.coalesce(given, F.lit(NULL_ID)).alias("id"),
                       given.isNull().alias("no_id"), rid.alias("rid"), text.cast("binary").alias("text"))
    return rows, groups, total


def group_of(rid: Column, groups: int) -> Column:
    return F.pmod(rid, F.lit(groups)).cast("int")


def _codes(values: np.ndarray, parts: int) -> np.ndarray:
    """Part of the hash range in the upper 32 bits, the value's lower bits in the others."""
    return ((values >> _U(32)) * _U(parts) >> _U(32)) << _U(32) | (values & _U(0xFFFFFFFF))


def listing(g: int, values: list[np.ndarray], parts: int) -> pa.Table:
    """A group's list: ``values`` with repeats, one for each place."""
    codes, n = np.unique(_codes(np.concatenate(values), parts), return_counts=True) if values else (np.zeros(0, _U), np.zeros(0, np.int64))
    n = np.minimum(n, 65535).astype(np.uint16)
    part, low = (codes >> _U(32)).astype(np.int64), codes.astype(np.uint32)
    some, cut = textbytes.runs_of(part)
    bounds = list(zip(cut[:-1], cut[1:], strict=True))
    return pa.table({"part": pa.array(some, pa.int32()), "g": pa.array([g] * len(some), pa.int32()),
                     "codes": pa.array([low[a:b].tobytes() for a, b in bounds], pa.binary()),
                     "counts": pa.array([n[a:b].tobytes() for a, b in bounds], pa.binary())})


def _meet(heavy: int):
    def run(table: pa.Table) -> pa.Table:
        codes = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["codes"]]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint16) for x in table["counts"]])
        _, inverse = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(inverse, weights=counts)[inverse]
        out, at = {"g": [], "part": [], "codes": [], "heavy": []}, 0
        for g, part, own in zip(table["g"].to_pylist(), table["part"].to_pylist(), codes, strict=True):
            times = total[at:at + len(own)]
            at += len(own)
            if (times > 1).any():
                for name, value in zip(out, (g, part, own[times > 1].tobytes(), (times[times > 1] > heavy).tobytes()), strict=True):
                    out[name].append(value)
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    return run


def repeated(listed: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """For each group its anchors that stand in two places or more, those in more than ``heavy`` flagged."""
    return listed.groupBy("part").applyInArrow(_meet(heavy), REPEATED)


class Known:
    """A group's repeated anchors."""

    def __init__(self, rows: pa.Table, parts: int) -> None:
        self.parts = parts
        codes = [np.frombuffer(c.as_buffer(), np.uint32).astype(_U) | _U(p) << _U(32)
                 for p, c in zip(rows["part"].to_pylist(), rows["codes"], strict=True)]
        heavy = [np.frombuffer(x.as_buffer(), bool) for x in rows["heavy"]]
        codes, heavy = np.concatenate(codes), np.concatenate(heavy)
        self.codes, self.heavy = np.sort(codes), np.sort(codes[heavy])

    def of(self, values: np.ndarray) -> np.ndarray:
        return _in(_codes(values, self.parts), self.codes)

    def too_frequent(self, values: np.ndarray) -> np.ndarray:
        return _in(_codes(values, self.parts), self.heavy)


def _in(codes: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(codes), bool)
    return known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] == codes


def marks_by_group(marks: list[tuple[np.ndarray, ...]], groups: int) -> pa.Table:
    """Marks (id, rid, start, n) as one row for each group of texts, as ``group_of`` deals them."""
    cols = [np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in zip(*marks, strict=True)] if marks else [np.zeros(0, np.int64)] * 4
    g = np.mod(cols[1], groups)
    by = np.argsort(g, kind="stable")
    some, cut = textbytes.runs_of(g[by])
    packed = {"g": pa.array(some, pa.int32())}
    for name, values in zip(_FIELDS, cols, strict=True):
        packed[name] = pa.array([values[by[a:b]].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
    return pa.table(packed)


def marks_of(table: pa.Table) -> list[np.ndarray]:
    """A group's marks, sorted by rid: id, rid, start and n."""
    cols = [np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(x.as_buffer(), np.int64) for x in table[name]]]) for name in _FIELDS]
    by = np.argsort(cols[1], kind="stable")
    return [c[by] for c in cols]


def pieces(table: pa.Table):
    """The texts of a group in chunks: first row, bytes and offsets of each."""
    data, offs = textbytes.byte_arrays(table["text"])
    for i, j in textbytes.chunks(offs):
        yield i, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
