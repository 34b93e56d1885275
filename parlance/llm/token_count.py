"""Token counts of documents in flat token streams, found by their separators.

A flat stream is token ids in one run, each document closed by an
end-of-document id, without an index. It is read in blocks that begin and end
anywhere. Each block is searched on its own; what a block needs from those
before it (how many documents have ended, how many tokens the open one has) is
an associative sum, computed for all blocks by a prefix scan.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import materialize
from .text import blocks, released

#: Bytes of a block; any multiple of the id's width will do.
BLOCK_BYTES = 1 << 18
#: Blocks that are read from a file in one go, and stores that Arrow reads.
RANGE_BLOCKS = 64
ARROW_STORES = frozenset({"file", "hdfs", "s3", "gs", "abfs", "abfss"})
#: Bytes of text in one stream.
STREAM_BYTES = 1 << 22
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pre-tokenization pattern of the vocabulary, and its free id.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
#: Bytes of an id of that vocabulary.
WIDTH = 2


def bpe(path: str = VOCABULARY) -> Callable[[str], list[int]]:
    """The encoder of a rank file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def write_streams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, separator: int = SEPARATOR, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Tokenize whole texts into flat streams of ids of `width` bytes; return their blocks and the ids' order.

    Blocks: stream, block, data. Order: stream, ordinal, id. Streams hold
    bounded amounts of text; a null text is an empty document.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe(vocabulary)
        stream, size = TaskContext.get().partitionId() << 32, 0
        kept: list[np.ndarray] = []
        ids: list = []

        def close() -> Iterator[pa.RecordBatch]:
            data = np.concatenate(kept).tobytes()
            cuts = range(0, len(data), block_bytes)
            for i, c in enumerate(cuts):
                yield pa.RecordBatch.from_arrays([pa.array([stream], pa.int64()), pa.array([i], pa.int64()), pa.nulls(1, id_type), pa.array([data[c : c + block_bytes]], pa.binary())], ["stream", "at", "id", "data"])
            m = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([stream] * m, pa.int64()), pa.array(range(m), pa.int64()), pa.array(ids, id_type), pa.nulls(m, pa.binary())], ["stream", "at", "id", "data"])

        for batch in batches:
            id_type = batch.column(id_col).type
            for a, b in blocks(batch.column(text_col)):
                part = batch.slice(a, b - a)
                for doc, text in zip(part.column(id_col).to_pylist(), part.column(text_col).to_pylist(), strict=True):
                    tokens = encode(text) if text else []
                    kept.append(np.array([*tokens, separator], dtype=f"<u{width}"))
                    ids.append(doc)
                    size += len(text or "")
                if size >= STREAM_BYTES:
                    yield from close()
                    stream, size, kept, ids = stream + 1, 0, [], []
        if kept:
            yield from close()

    rows = materialize(docs.select(id_col, text_col).mapInArrow(released(run), f"stream long, at long, id {kind}, data binary"), "token-streams")
    return rows.where("data is not null").select("stream", F.col("at").alias("block"), "data"), rows.where("data is null").select("stream", F.col("at").alias("ordinal"), "id")


def read_streams(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Blocks (stream, block, data) of flat token files: one stream a file, named by its path's hash.

    Tasks read ranges of RANGE_BLOCKS blocks from the files, of any size,
    through Arrow's file systems. Files of a store that Arrow doesn't know are
    read whole by Spark, and must be below 2 GB each. Empty files give nothing.
    """
    files = spark.read.format("binaryFile").load(path)
    schemes = [r[0] for r in files.select(F.regexp_extract("path", "^([a-z0-9]+):", 1)).distinct().collect()]
    if not set(schemes) <= ARROW_STORES:
        cuts = F.sequence(F.lit(0), F.ceil(F.length("content") / block_bytes).cast("int") - 1)
        whole = files.where("length > 0").select(F.xxhash64("path").alias("stream"), "content", cuts.alias("cuts"))
        return whole.select("stream", F.posexplode(F.transform("cuts", lambda b: F.substr("content", b * block_bytes + 1, F.lit(block_bytes)))).alias("block", "data")).select("stream", F.col("block").cast("long").alias("block"), "data")
    span = RANGE_BLOCKS * block_bytes
    ranges = files.where("length > 0").select(F.xxhash64("path").alias("stream"), "path", F.explode(F.sequence(F.lit(0), F.ceil(F.col("length") / span) - 1)).alias("range"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stream, name, k in zip(*(batch.column(c).to_pylist() for c in ("stream", "path", "range")), strict=True):
                store, at = fs.FileSystem.from_uri(name)
                with store.open_input_file(at) as f:
                    f.seek(k * span)
                    for i in range(RANGE_BLOCKS):
                        if not (data := f.read(block_bytes)):
                            break
                        yield pa.RecordBatch.from_arrays([pa.array([stream]), pa.array([k * RANGE_BLOCKS + i]), pa.array([data], pa.binary())], ["stream", "block", "data"])

    return ranges.repartition("stream", "range").mapInArrow(released(read), "stream long, block long, data binary")


def count_tokens(blocks_: DataFrame, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """Rows (stream, ordinal, n_tokens), one a document; separators don't count.

    A run without a separator after the last one is a document that a stream
    leaves open, and is returned too. `width` is the bytes of an id, 2 or 4,
    little-endian; blocks must hold whole ids. Empty blocks and streams give
    nothing; an empty table gives no rows.
    """
    kind = np.dtype(f"<u{width}")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, lengths, head, tail = [], [], [], []
            for data in batch.column("data"):
                ids = np.frombuffer(data.as_buffer(), dtype=kind) if data.is_valid else np.zeros(0, dtype=kind)
                at = np.flatnonzero(ids == separator)
                ends.append(len(at))
                head.append(int(at[0]) if len(at) else len(ids))
                tail.append(len(ids) - 1 - int(at[-1]) if len(at) else len(ids))
                lengths.append((np.diff(at) - 1).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("stream"), batch.column("block"), pa.array(ends, pa.int64()), pa.array(head, pa.int64()), pa.array(tail, pa.int64()), pa.array(lengths, pa.list_(pa.int64()))], ["stream", "block", "ends", "head", "tail", "inner"])

    found = materialize(blocks_.select("stream", "block", "data").mapInArrow(released(search), "stream long, block long, ends long, head long, tail long, inner array<long>"), "token-blocks")
    # the scan: documents ended before a block, and open tokens since the last block that has an end
    before = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summary = found.select("stream", "block", "ends", "head", "tail")
    summary = summary.withColumn("run", F.count(F.when(F.col("ends") > 0, 1)).over(before))
    within = Window.partitionBy("stream", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumn("ended", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    carried = carried.withColumn("last", F.max(F.when(F.col("ends") > 0, F.struct("block", "tail"))).over(before)["tail"])
    carried = carried.withColumn("open", F.coalesce("last", F.lit(0)) + F.coalesce(F.sum(F.when(F.col("ends") == 0, F.col("tail"))).over(within), F.lit(0)))
    at = carried.select("stream", "block", "ended", "open")
    joined = found.join(at, ["stream", "block"])
    sizes = F.when(F.col("ends") > 0, F.concat(F.array(F.col("open") + F.col("head")), "inner")).otherwise(F.array().cast("array<bigint>"))
    closed = joined.select("stream", "ended", F.posexplode(sizes).alias("i", "n_tokens")).select("stream", (F.col("ended") + F.col("i")).alias("ordinal"), "n_tokens")
    whole = found.groupBy("stream").agg(F.sum("ends").alias("ordinal"), F.max(F.when(F.col("ends") > 0, F.struct("block", "tail"))).alias("last"))
    rest = found.join(whole, "stream").where("last is null or block > last.block").groupBy("stream", "ordinal").agg(F.sum("tail").alias("more"))
    left = whole.join(rest, ["stream", "ordinal"], "left").select("stream", "ordinal", (F.coalesce("last.tail", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n_tokens")).where("n_tokens > 0")
    return closed.unionByName(left)


def count_document_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """Rows (id, n_tokens, stream, ordinal) for every row of `docs`, through flat streams.

    Null and empty texts have 0 tokens; ids may be null or repeat; an empty
    table gives no rows; other columns are not read.
    """
    data, order = write_streams(docs, id_col, text_col, vocabulary, separator, width)
    return order.join(count_tokens(data, separator, width), ["stream", "ordinal"]).select(F.col("id").alias(id_col), "n_tokens", "stream", "ordinal")
