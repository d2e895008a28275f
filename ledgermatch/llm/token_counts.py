"""Token counts by a separator scan over flat token files.

A corpus is stored as flat streams of token ids, an end-of-document id after
each document and no index of where documents begin. A stream is kept as blocks
of equal size (the last one of a shard may be shorter); documents run across
their bounds. Counting takes three steps:

1. each block by itself is searched for separators, vectorised: its tokens
   before the first and after the last one, and the lengths in between;
2. a prefix scan over the blocks of a shard, on a few numbers a block, gives
   the tokens carried in by a document that began before and the number of
   documents that ended before;
3. a block's documents get their lengths, the first one with what was carried.

``token_blocks`` makes such streams of documents with a tokenizer whose files
are a parameter; ids are kept in two bytes where the vocabulary allows.
``blocks_of_files`` reads raw files of token ids from any store Spark can read.

Defined results: null and empty texts have no tokens but their separator, so
they count 0; a stream that does not end with a separator ends with a document
all the same (if it has tokens); null ids are carried along; repeated rows are
documents of their own; other columns, whatever their names, are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokenizer's words begin and end; fixed values of its vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_TOKENS = 1 << 18
_BLOCK = "shard long, seq int, kind string, payload binary"
_SCAN = "shard long, seq int, n long, n_seps long, head long, last long, inner array<int>"


@lru_cache(maxsize=2)
def _encoder(lines: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_blocks(docs: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN, block_tokens: int = BLOCK_TOKENS,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int, str]:
    """Blocks (``shard``, ``seq``, ``kind``, ``payload``), the separator's id and the ids' numpy type.

    Rows of kind ``tokens`` are the stream; rows of kind ``ids`` list the
    documents' ids in the order in which they were written, for naming what the
    scan finds. Write the frame before use: its shards follow the partitions.
    """
    lines = Path(tokenizer).read_bytes()  # the vocabulary: fixed size
    end = max(int(x.split()[1]) for x in lines.splitlines()) + 1
    kind = "<u2" if end < 1 << 16 else "<u4"
    sent = docs.sparkSession.sparkContext.broadcast(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(sent.value, pattern).encode_ordinary
        shard, seq, rest, names = TaskContext.get().partitionId(), 0, np.zeros(0, kind), 0

        def rows(what: str, parts: list[bytes]) -> pa.RecordBatch:
            first = seq if what == "tokens" else names
            return pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(parts), pa.int64()), pa.array(range(first, first + len(parts)), pa.int32()),
                 pa.array([what] * len(parts)), pa.array(parts, pa.binary())], ["shard", "seq", "kind", "payload"])

        for batch in batches:
            if not batch.num_rows:
                continue
            pieces, size = [rest], len(rest)
            for text in batch.column(1):
                ids = encode(text.as_py() or "")
                ids.append(end)
                pieces.append(np.array(ids, kind))
                size += len(ids)
                if size >= 4 * block_tokens:
                    flat = np.concatenate(pieces)
                    whole = len(flat) // block_tokens * block_tokens
                    parts = [flat[i:i + block_tokens].tobytes() for i in range(0, whole, block_tokens)]
                    yield rows("tokens", parts)
                    seq += len(parts)
                    pieces, size = [flat[whole:]], len(flat) - whole
            rest = np.concatenate(pieces)
            # an id is eight bytes after one that says whether it is null
            ids = batch.column(0)
            known = np.zeros(len(ids), [("null", "u1"), ("id", "<i8")])
            known["null"], known["id"] = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
            yield rows("ids", [known.tobytes()])
            names += 1
        parts = [rest[i:i + block_tokens].tobytes() for i in range(0, len(rest), block_tokens)]
        if parts:
            yield rows("tokens", parts)

    made = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, _BLOCK)
    return made, end, kind


def blocks_of_files(spark: SparkSession, path: str, kind: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of raw files of token ids, one shard a file (2 GB at most, Spark's limit for a binary value)."""
    width = block_tokens * np.dtype(kind).itemsize
    files = spark.read.format("binaryFile").load(path)
    cut = F.transform(F.sequence(F.lit(0), F.ceil(F.col("length") / width).cast("int") - 1),
                      lambda i: F.substring(F.col("content"), i * width + 1, F.lit(width)))
    return (files.filter("length > 0").select(F.xxhash64("path").alias("shard"), F.posexplode(cut).alias("seq", "payload"))
            .select("shard", "seq", F.lit("tokens").alias("kind"), "payload"))


def _search(end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, n_seps, head, last, inner = [], [], [], [], []
            for payload in batch.column(2):
                tokens = np.frombuffer(payload.as_buffer(), kind)
                hits = np.flatnonzero(tokens == end)
                n.append(len(tokens))
                n_seps.append(len(hits))
                head.append(int(hits[0]) if len(hits) else None)
                last.append(int(hits[-1]) if len(hits) else None)
                inner.append((np.diff(hits) - 1).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(n_seps, pa.int64()), pa.array(head, pa.int64()),
                 pa.array(last, pa.int64()), pa.array(inner, pa.list_(pa.int32()))], ["shard", "seq", "n", "n_seps", "head", "last", "inner"])

    return run


def document_lengths(blocks: DataFrame, end: int, kind: str = "<u2") -> DataFrame:
    """``shard``, ``ordinal`` and ``n_tokens`` of every document in the streams, separators not counted."""
    found = (blocks.filter("kind = 'tokens'").select("shard", "seq", "payload")
             .mapInArrow(_search(end, kind), _SCAN))
    before = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = (found.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0)))
              .withColumn("ordinal", F.coalesce(F.sum("n_seps").over(before), F.lit(0))))
    # all of the shard's tokens up to the last separator belong to documents that have ended
    ended = F.coalesce(F.max(F.col("begin") + F.col("last") + 1).over(before), F.lit(0))
    placed = placed.withColumn("carry", F.col("begin") - ended)
    lengths = F.concat(F.array(F.col("carry") + F.col("head")), F.transform("inner", lambda x: x.cast("long")))
    closed = (placed.filter("n_seps > 0").select("shard", "ordinal", F.posexplode(lengths).alias("i", "n_tokens"))
              .select("shard", (F.col("ordinal") + F.col("i")).alias("ordinal"), "n_tokens"))
    # what follows a shard's last separator, if anything
    total = found.groupBy("shard").agg(F.sum("n").alias("total"), F.sum("n_seps").alias("ordinal"))
    done = placed.groupBy("shard").agg(F.max(F.col("begin") + F.col("last") + 1).alias("done"))
    open_end = (total.join(done, "shard").select("shard", "ordinal", (F.col("total") - F.coalesce("done", F.lit(0))).alias("n_tokens"))
                .filter("n_tokens > 0"))
    return closed.unionByName(open_end)


def _names(blocks: DataFrame) -> DataFrame:
    """``shard``, ``ordinal`` and ``id`` as listed when the streams were written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x.as_buffer(), [("null", "u1"), ("id", "<i8")]) for x in batch.column(2)]
            ids = [pa.array(x["id"], mask=x["null"] > 0) for x in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.to_pylist() for x in ids], pa.list_(pa.int64()))],
                                             ["shard", "seq", "ids"])

    listed = blocks.filter("kind = 'ids'").select("shard", "seq", "payload").mapInArrow(run, "shard long, seq int, ids array<long>")
    before = Window.partitionBy("shard").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sizes = listed.withColumn("base", F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0)))
    return sizes.select("shard", "base", F.posexplode("ids").alias("i", "id")).select(
        "shard", (F.col("base") + F.col("i")).cast("long").alias("ordinal"), "id")


def counts(blocks: DataFrame, end: int, kind: str = "<u2", id_col: str = "doc_id") -> DataFrame:
    """Id and ``n_tokens`` of every document of blocks made by ``token_blocks`` and written."""
    return _names(blocks).join(document_lengths(blocks, end, kind), ["shard", "ordinal"], "left").select(
        F.col("id").alias(id_col), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
