"""Fill-in-middle transformation with cut places found in an indexable skip list.

A text is a list of *units*: code points, words with the spaces behind them, or
lines. Two hashes of the document's id choose two cut ranks among the n + 1 places
between units; what stands before the smaller is the prefix, between them the
middle, behind the larger the suffix. A third hash leaves a share of the
documents plain, a fourth decides the order of the pieces:

* psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle

*Skip list.* The base lane has one node a unit. A node of an express lane joins
``FAN`` nodes of the lane below and carries how many units and how many code points
it spans. The search for a rank descends from the top lane: it walks along a lane
while the units passed by stay within the rank, adding up both widths, and then
goes down. At the base the units passed are the rank, and the code points passed
are the place to cut, whatever the units' lengths. The walk takes at most ``FAN``
steps in each lane, and lanes are as many as the logarithm of n.

Texts that hold one of the three markers stay plain, so that ``restore`` can
take an output apart again: a marker begins with ``<`` and cannot begin inside
another one, so none arises where pieces meet.

Every row is worked on by itself; nothing is shuffled.

Defined results: a null or empty text is plain and empty; a null id is hashed as
the empty text; repeated rows give equal results; texts are read whole; columns
other than id and text, whatever their names, are ignored by ``transform`` and
kept by ``transformed``; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nodes of a lane that one node of the lane above joins.
FAN = 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Shares in percent: documents to transform, and of them those in suffix-prefix-middle order.
RATE, SPM_RATE = 90, 20
#: Code points of output that a task holds before it passes them on (one text at least).
PART = 1 << 22
#: Patterns of one unit; together the matches make up the whole text.
UNITS = {"code_point": None, "word": re.compile(r"\s*\S+\s*|\s+"), "line": re.compile(r"[^\n]*\n|[^\n]+")}


class SkipList:
    """Lanes over the units of one text, from the code points of each unit."""

    def __init__(self, code_points: np.ndarray):
        self.n = len(code_points)
        lane = np.ones(self.n, np.uint8), code_points
        self.lanes = [lane]
        while len(lane[0]) > FAN:
            begin = np.arange(0, len(lane[0]), FAN)
            lane = tuple(np.add.reduceat(width, begin, dtype=np.int64) for width in lane)
            self.lanes.append(lane)

    def code_points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        units = places = node = 0
        for level in range(len(self.lanes) - 1, -1, -1):
            widths, lengths = self.lanes[level]
            stop = min(node + FAN, len(widths))
            for width, length in zip(widths[node:stop].tolist(), lengths[node:stop].tolist(), strict=True):
                if units + width > rank:
                    break
                units, places, node = units + width, places + length, node + 1
            node *= FAN
        return places


def skip_list(text: str, unit: str = "code_point") -> SkipList:
    pattern = UNITS[unit]
    if pattern is None:
        return SkipList(np.ones(len(text), np.uint8))
    return SkipList(np.fromiter((m.end() - m.start() for m in pattern.finditer(text)), np.int64))


def _hashes(doc_id: Column, seed: str) -> list[Column]:
    """The first four groups of eight hex digits of the sha256 of ``seed:id``, as whole numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _cut(text: str, h1: int, h2: int, h3: int, h4: int, unit: str, rate: int, spm_rate: int) -> tuple:
    units = skip_list(text, unit)
    if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return units.n, "plain", None, None, text
    low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = units.code_points_before(low), units.code_points_before(high)
    pieces = {PREFIX: text[:a], SUFFIX: text[b:], MIDDLE: text[a:b]}
    spm = h4 % 100 < spm_rate
    order = (SUFFIX, PREFIX, MIDDLE) if spm else (PREFIX, SUFFIX, MIDDLE)
    return units.n, "spm" if spm else "psm", a, b - a, "".join(m + pieces[m] for m in order)


def _applied(docs: DataFrame, carry: Column, unit: str, rate: int, spm_rate: int, seed: str, id_col: str, text_col: str) -> DataFrame:
    """``carry`` of each row beside what its text becomes."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}, not {unit!r}")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"), *_hashes(F.col(f"`{id_col}`"), seed), carry.alias("carry"))
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    names = ["carry", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # given back in parts of some megabytes, however long the texts of a batch are together
            out, held, begin = [], 0, 0
            for i in range(batch.num_rows):
                out.append(_cut(batch.column(0)[i].as_py(), *[batch.column(k)[i].as_py() for k in range(1, 5)], unit, rate, spm_rate))
                held += len(out[-1][-1])
                if held >= PART or i == batch.num_rows - 1:
                    columns = [pa.array([x[k] for x in out], t) for k, t in enumerate(types)]
                    yield pa.RecordBatch.from_arrays([batch.column(5).slice(begin, len(out)), *columns], names)
                    out, held, begin = [], 0, i + 1

    shape = f"carry {rows.schema['carry'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, shape)


def transform(docs: DataFrame, unit: str = "code_point", rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = "1",
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars`` (code points; null if plain), ``output``."""
    found = _applied(docs, F.col(f"`{id_col}`"), unit, rate, spm_rate, seed, id_col, text_col)
    return found.select(F.col("carry").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "output")


def transformed(docs: DataFrame, unit: str = "code_point", rate: int = RATE, spm_rate: int = SPM_RATE, seed: str = "1",
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns, their texts replaced by the outputs; null texts stay null."""
    # fields are numbered, so that no name of a column can matter on the way
    fields = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    row = F.struct(F.col(f"`{text_col}`").isNull().alias("empty"), *fields)
    found = _applied(docs, row, unit, rate, spm_rate, seed, id_col, text_col)
    text = F.when(~F.col("carry.empty"), F.col("output"))
    return found.select(*[(text if c == text_col else F.col(f"carry.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def restore(output: Column, form: Column) -> Column:
    """The exact text again, from an output and its form."""
    pieces = F.split(output, "<[PSM]>", -1)
    first, second, middle = (F.get(pieces, F.lit(i)) for i in (1, 2, 3))
    return (F.when(form == "psm", F.concat(first, middle, second))
            .when(form == "spm", F.concat(second, middle, first)).otherwise(output))
