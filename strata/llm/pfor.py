"""Token-id files: patched frame-of-reference blocks (operator 5).

A file set is a Parquet table whose rows are stripes: whole documents in
ascending id order, about ``STRIPE_IDS`` ids. Parquet is only the container,
so any file system Spark writes to will do and a lost task is committed once.
A stripe holds its documents (ids, lengths), the byte offset of each block
and the blocks themselves. A block covers up to ``BLOCK_IDS`` ids::

    u32 minimum | u8 width | u8 0 | u16 exceptions | u16 ids - 1 | u16 0
    packed low bits of (id - minimum), ``width`` bits each, 32 ids a group
    u16 position and u32 high bits of each exception

The width is that of the ``WIDTH_QUANTILE`` quantile of the block's
differences; larger differences are exceptions.

Defined results: a null text is an empty one (only the end id); rows with a
null id come first; equal ids keep an order by text; repeated rows are
documents of their own; an empty table gives an empty file set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import id_type, ids_and_text, map_arrow, partitions, scratch_path, text_slices
from strata.llm.tokenids import ENCODERS, SLICE_CHARS, default_tokenizer, encoder

BLOCK_IDS = 1024
STRIPE_IDS = 131_072
WIDTH_QUANTILE = 0.98
_HEAD = struct.Struct("<IBBHHH")


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """(k, 32 g) values of ``width`` bits to (k, g * width) 32-bit words."""
    k, n = values.shape
    v = values.reshape(k, n // 32, 32).astype(np.uint64)
    out = np.zeros((k, n // 32, width + 1), np.uint64)
    for i in range(32 if width else 0):
        word, off = divmod(i * width, 32)
        shifted = v[:, :, i] << np.uint64(off)
        out[:, :, word] |= shifted & np.uint64(0xFFFFFFFF)
        if off + width > 32:
            out[:, :, word + 1] |= shifted >> np.uint64(32)
    return out[:, :, :width].astype("<u4").reshape(k, -1)


def unpack(words: np.ndarray, width: int, n: int) -> np.ndarray:
    """The inverse of :func:`pack` for (k, n // 32 * width) words."""
    k = words.shape[0]
    if not width:
        return np.zeros((k, n), np.uint64)
    w = words.reshape(k, n // 32, width).astype(np.uint64)
    out = np.empty((k, n // 32, 32), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(32):
        word, off = divmod(i * width, 32)
        v = w[:, :, word] >> np.uint64(off)
        if off + width > 32:
            v = v | (w[:, :, word + 1] << np.uint64(32 - off))
        out[:, :, i] = v & mask
    return out.reshape(k, n)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, list[int]]:
    """Blocks of ``ids`` (unsigned 32 bit) and the byte offset of each."""
    n = len(ids)
    if not n:
        return b"", []
    nb = -(-n // BLOCK_IDS)
    full = np.empty(nb * BLOCK_IDS, np.int64)
    full[:n] = ids
    full[n:] = ids[(nb - 1) * BLOCK_IDS :].min()
    v = full.reshape(nb, BLOCK_IDS)
    low = v.min(axis=1)
    d = v - low[:, None]
    kth = int(WIDTH_QUANTILE * (BLOCK_IDS - 1))
    top = np.partition(d, kth, axis=1)[:, kth]
    width = np.ceil(np.log2(top + 1)).astype(np.int64)
    high = d >> width[:, None]
    packed: dict[int, bytes] = {}
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        words = pack(d[at] & ((1 << w) - 1), w)
        packed.update((b, words[j].tobytes()) for j, b in enumerate(at.tolist()))
    parts: list[bytes] = []
    starts: list[int] = []
    offset = 0
    for b in range(nb):
        size = min(BLOCK_IDS, n - b * BLOCK_IDS)
        pos = np.flatnonzero(high[b])
        head = _HEAD.pack(int(low[b]), int(width[b]), 0, len(pos), size - 1, 0)
        block = head + packed[b] + pos.astype("<u2").tobytes() + high[b][pos].astype("<u4").tobytes()
        starts.append(offset)
        parts.append(block)
        offset += len(block)
    return b"".join(parts), starts


def decode_blocks(payload: bytes, starts: list[int]) -> np.ndarray:
    """All ids of the blocks that begin at ``starts`` (any choice of them)."""
    heads = [_HEAD.unpack_from(payload, s) for s in starts]
    out = np.zeros((len(starts), BLOCK_IDS), np.int64)
    widths = np.array([h[1] for h in heads], np.int64)
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        words = np.stack(
            [np.frombuffer(payload, "<u4", BLOCK_IDS // 32 * w, starts[b] + _HEAD.size) for b in at.tolist()]
        )
        out[at] = unpack(words, w, BLOCK_IDS).astype(np.int64)
    for b, (low, w, _, exceptions, _, _) in enumerate(heads):
        if exceptions:
            at = starts[b] + _HEAD.size + BLOCK_IDS // 32 * w * 4
            pos = np.frombuffer(payload, "<u2", exceptions, at)
            out[b, pos] |= np.frombuffer(payload, "<u4", exceptions, at + 2 * exceptions).astype(np.int64) << w
        out[b] += low
    if not starts:
        return np.zeros(0, np.uint32)
    flat = out.reshape(-1)
    tail = BLOCK_IDS - (heads[-1][4] + 1)
    return (flat[: len(flat) - tail] if tail else flat).astype(np.uint32)


def write_token_files(
    docs: DataFrame,
    path: str,
    end_id: int,
    tokenizer_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, append ``end_id``, write stripes to ``path``.

    One range shuffle of (id, text) puts documents in id order; encoding and
    packing follow in the same tasks. The text's hash is part of the range
    key, so a repeated id does not gather in one task."""
    spark = docs.sparkSession
    tokenizer_path = tokenizer_path or default_tokenizer()
    kind = id_type(docs, id_col)
    end = np.array([end_id], "<u4").tobytes()

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        shard, enc = TaskContext.get().partitionId(), encoder(tokenizer_path)
        ids: list = []
        parts: list[bytes] = []
        size, stripe, first = 0, 0, 0

        def flush() -> dict:
            payload, starts = encode_blocks(np.frombuffer(b"".join(parts), "<u4"))
            return {
                "shard": [shard],
                "stripe": [stripe],
                "first_id": [first],
                "n_ids": [size],
                "doc_ids": [ids],
                "doc_sizes": [[len(p) // 4 for p in parts]],
                "block_starts": [starts],
                "payload": [payload],
            }

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for lo, hi, texts in text_slices(batch, "text", SLICE_CHARS):
                for key, encoded in zip(keys[lo:hi], enc.encode(texts), strict=True):
                    ids.append(key)
                    parts.append(encoded + end)
                    size += len(encoded) // 4 + 1
                    if size >= STRIPE_IDS:
                        yield flush()
                        stripe, first = stripe + 1, first + size
                        ids, parts, size = [], [], 0
        if ids:
            yield flush()

    ordered = (
        ids_and_text(docs, id_col, text_col)
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("_h", F.xxhash64("text"))
        .repartitionByRange(partitions(spark), "doc_id", "_h")
        .sortWithinPartitions("doc_id", "_h", "text")
        .drop("_h")
    )
    schema = (
        f"shard int, stripe int, first_id long, n_ids long, doc_ids array<{kind}>, doc_sizes array<int>, "
        "block_starts array<int>, payload binary"
    )
    map_arrow(ordered, stripes, schema, uses=ENCODERS).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` over its ids."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    # One row per shard: as many as write tasks, so small enough to send out.
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids")).selectExpr(
        "shard", "sum(ids) over (order by shard rows between unbounded preceding and current row) - ids as base"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_blocks(row["payload"], row["block_starts"])
                ends = np.cumsum(np.array(row["doc_sizes"], np.int64))
                begins = ends - np.array(row["doc_sizes"], np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                yield {
                    "doc_id": row["doc_ids"],
                    "shard": np.full(len(ends), row["shard"], np.int32),
                    "in_shard": begins + row["first_id"],
                    "n_tokens": ends - begins,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)],
                }

    decoded = map_arrow(
        files.select("shard", "first_id", "doc_ids", "doc_sizes", "block_starts", "payload"),
        documents,
        f"doc_id {kind}, shard int, in_shard long, n_tokens long, ids_crc32 long",
    )
    return decoded.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("in_shard") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Each document's ids themselves, from the files."""
    files = spark.read.parquet(path)
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_blocks(row["payload"], row["block_starts"]).astype(np.int64)
                yield {"doc_id": row["doc_ids"], "ids": np.split(ids, np.cumsum(row["doc_sizes"])[:-1])}

    return map_arrow(files.select("doc_ids", "doc_sizes", "block_starts", "payload"), documents, f"doc_id {kind}, ids array<long>")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, end_id=2)
    return read_token_files(spark, path)
