"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

*Tokens* are runs of letters, digits or other signs. Each stands for two words:
its lower-case content, and its shape (case, length, sign, whether it repeats
the token before). Both are hashed into a fixed number of slots, so that the
vector table has the same size for any corpus.

*Random indexing.* Each slot has a fixed sparse index vector (two entries of +1
or -1 in ``DIM``). A slot's context vector is the sum of the index vectors of
the tokens up to ``REACH`` places away, over all documents: whole-number sums,
partly summed in each map task and then grouped by slot, so a rerun gives the
same. Logarithms, centred and scaled to unit length, are the word vectors.

*Pooling and network.* A document is the mean of its content vectors beside the
mean of its shape vectors. A hidden tanh layer and a sigmoid are fitted in numpy
to at most ``MAX_ROWS`` labelled rows (those with the least hashes of their
ids); a temperature fitted to a part of them kept aside calibrates the scores.

Defined results: null, empty and blank texts pool to the zero vector and get
the network's score for it; labels that are null are ignored, and of several
labels for one id the largest holds; without labels of both kinds every score
is the share of ones (0.5 without any); equal texts get equal scores, so
repeated rows do; an empty table gives an empty result; other columns, whatever
their names, are ignored by ``scores``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm import textbytes

DIM = 32
WORD_SLOTS = 1 << 14
SHAPE_SLOTS = 1 << 8
REACH = 2
HIDDEN = 16
#: Labelled rows that a fit uses at most.
MAX_ROWS = 20_000
EPOCHS = 60
THRESHOLD = 0.3

_CLASS = np.full(256, 3, np.uint8)
_CLASS[textbytes.SPACE] = 0
_CLASS[128:] = _CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[48:58] = 2
_rng = np.random.RandomState(11)
_SLOTS = WORD_SLOTS + SHAPE_SLOTS
_PLACES = np.stack([_rng.randint(0, DIM // 2, _SLOTS), _rng.randint(DIM // 2, DIM, _SLOTS)])
_SIGNS = _rng.choice([-1.0, 1.0], (2, _SLOTS))


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slot and shape slot of each token, and the n + 1 bounds of the texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    kind = _CLASS[data]
    new = np.ones(n + 1, bool)
    new[1:n] = kind[1:] != kind[:-1]
    new[offs] = True
    bounds = np.flatnonzero(new)
    starts, ends = bounds[:-1], bounds[1:]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    first = np.searchsorted(starts, offs)
    lower = textbytes.lower_ascii(data)
    hashes = textbytes.span_hash(textbytes.prefix_hash(lower), starts, ends)
    repeat = np.zeros(len(starts), np.int64)
    repeat[1:] = hashes[1:] == hashes[:-1]
    repeat[first[:-1][first[:-1] < len(starts)]] = 0
    upper = np.concatenate([[0], np.cumsum(lower != data)])
    small = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    n_up, n_low = upper[ends] - upper[starts], small[ends] - small[starts]
    size = np.minimum(ends - starts, 15)
    case = np.where(n_up == 0, 0, np.where(n_low > 0, 1, np.where(n_up > 1, 2, 3)))
    of_kind = kind[starts]
    shape = np.where(of_kind == 1, case * 8 + size // 2 + 32 * repeat,
                     np.where(of_kind == 2, 64 + size + 16 * repeat, 96 + (data[starts].astype(np.int64) * 3 + np.minimum(size, 3)) % 160))
    return (hashes >> np.uint64(50)).astype(np.int64), shape, first


def context_sums(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums of the neighbours' index vectors for each slot, over the texts of a chunk."""
    words, shapes, first = tokens(data, offs)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    out = np.zeros(_SLOTS * DIM)
    for ids in (words, shapes + WORD_SLOTS):
        for k in range(1, REACH + 1):
            same = np.flatnonzero(doc[:-k] == doc[k:]) if len(doc) > k else np.zeros(0, np.int64)
            a, b = ids[same], ids[same + k]
            for row, other in ((a, b), (b, a)):
                for places, signs in zip(_PLACES, _SIGNS, strict=True):
                    out += np.bincount(row * DIM + places[other], weights=signs[other], minlength=len(out))
    return out.reshape(_SLOTS, DIM)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The vector table of all documents: ``WORD_SLOTS + SHAPE_SLOTS`` rows of ``DIM``."""
    names = [f"d{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((_SLOTS, DIM))
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(0))
            for i, j in textbytes.chunks(offs):
                sums += context_sums(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        seen = np.flatnonzero(np.abs(sums).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(seen), *[pa.array(sums[seen, i].astype(np.int64)) for i in range(DIM)]], ["slot", *names])

    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "slot long, " + ", ".join(f"{x} long" for x in names))
    # bounded by the number of slots, whatever the corpus
    table = parts.groupBy("slot").agg(*[F.sum(x).alias(x) for x in names]).toPandas()
    sums = np.zeros((_SLOTS, DIM))
    sums[table["slot"].to_numpy()] = table[names].to_numpy()
    vectors = np.sign(sums) * np.log1p(np.abs(sums))
    for part in (slice(0, WORD_SLOTS), slice(WORD_SLOTS, None)):
        some = np.abs(vectors[part]).sum(axis=1) > 0
        if some.any():
            vectors[part][some] -= vectors[part][some].mean(axis=0)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(data: np.ndarray, offs: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The texts of a chunk as rows of 2 x ``DIM``."""
    words, shapes, first = tokens(data, offs)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * DIM))
    full = np.flatnonzero(n)
    if len(full):
        # in pieces, as a token's vector is much longer than the token
        piece = np.unique(np.concatenate([first[:-1][full], np.arange(0, len(words), 1 << 14)]))
        sums = np.stack([vectors[words[a:b]].sum(axis=0, dtype=np.float64) for a, b in zip(piece, [*piece[1:], len(words)], strict=True)])
        out[full, :DIM] = np.add.reduceat(sums, np.searchsorted(piece, first[:-1][full]), axis=0)
        doc = np.repeat(np.arange(len(n)), n)
        counts = np.bincount(doc * SHAPE_SLOTS + shapes, minlength=len(n) * SHAPE_SLOTS).reshape(len(n), SHAPE_SLOTS)
        out[:, DIM:] = counts @ vectors[WORD_SLOTS:].astype(np.float64)
        out /= np.maximum(n, 1)[:, None]
    return out


@dataclass
class Model:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(vectors: np.ndarray, x: np.ndarray, y: np.ndarray, aside: np.ndarray) -> Model:
    """Adam on the log loss of the rows not kept ``aside``; the temperature has the least log loss on those that are."""
    rng = np.random.RandomState(3)
    share = float(y.mean()) if len(y) else 0.5
    flat = Model(vectors, np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                 np.zeros(HIDDEN), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), 1.0)
    train = ~aside if len(np.unique(y[~aside])) == 2 else np.ones(len(y), bool)
    if len(np.unique(y[train])) < 2:
        return flat
    xs, ys = x[train], y[train].astype(float)
    m = Model(vectors, xs.mean(axis=0), xs.std(axis=0) + 1e-6, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0, 1.0)
    z = (xs - m.mean) / m.scale
    params = [m.w1, m.b1, m.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            rows = order[at:at + 128]
            hidden = np.tanh(z[rows] @ params[0] + params[1])
            miss = (1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3][0], -30, 30))) - ys[rows]) / len(rows)
            back = np.outer(miss, params[2]) * (1 - hidden ** 2)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), hidden.T @ miss + 1e-4 * params[2], np.array([miss.sum()])]
            step += 1
            for p, g, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.005 * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    m.b2 = float(params[3][0])
    held = aside if aside.any() else train
    raw, yes = m.logits(x[held]), y[held] == 1
    loss = lambda t: np.logaddexp(0, np.where(yes, -raw, raw) / t).mean()
    m.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return m


def _pooled_rows(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(1))
            x = [pooled(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], table.value) for i, j in textbytes.chunks(offs)]
            rows = np.concatenate(x) if x else np.zeros((0, 2 * DIM))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(rows), pa.list_(pa.float64()))], ["id", "mark", "x"])

    # the mark tells rows of one id apart, so that a rerun takes the same of them
    return docs.select("id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, "id long, mark long, x array<double>")


def learnable(doc_id) -> object:
    """Rows whose labels may be learnt from: crc32 of the id as text, modulo 5, is not 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality") -> Model:
    """Vectors of all ``docs``, and a network fitted to at most ``max_rows`` learnable labelled ones."""
    vectors = word_vectors(docs, text_col)
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter(F.col("id").isNotNull() & F.col("y").isin(0, 1) & learnable(F.col("id")))
             .groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(max_rows))
    # at most max_rows ids and labels are broadcast
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(known.select("id")), "id", "left_semi"))
    got = _pooled_rows(rows, vectors).join(F.broadcast(known), "id").select(
        "id", "mark", "y", "x", (F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 1).alias("aside")).toPandas()
    got = got.sort_values(["id", "mark"], kind="stable").drop_duplicates("id")
    x = np.array(got["x"].tolist()) if len(got) else np.zeros((0, 2 * DIM))
    return fit_network(vectors, x, got["y"].to_numpy(), got["aside"].to_numpy(dtype=bool))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``score`` in 0 to 1 of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(1))
            s = [m.scores(pooled(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], m.vectors)) for i, j in textbytes.chunks(offs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(s) if s else np.zeros(0))], ["id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that score at least ``threshold``; nothing is shuffled."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            data, offs = textbytes.byte_arrays(batch.column(at))
            s = [m.scores(pooled(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], m.vectors)) for i, j in textbytes.chunks(offs)]
            if s:
                yield batch.filter(pa.array(np.concatenate(s) >= threshold))

    return docs.mapInArrow(run, docs.schema)
