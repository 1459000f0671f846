"""Broadcast joins with a checked size bound.

The small side is measured first. Up to ``limit`` rows and ``max_bytes`` bytes
it is broadcast whole. Above that a join on columns is shuffled like any other.
A join on a condition splits the distinct small rows into hash chunks, each
verified to hold at most that much, and joins the large side with each in turn.
Every broadcast therefore has a proven size, but for a single row longer than
``max_bytes``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 64 << 20

_CHUNK = "__chunk"


def _sizes(df: DataFrame) -> tuple[Column, Column]:
    """Rows, and their bytes written out as text."""
    text = F.octet_length(F.to_json(F.struct(*df.columns)))
    return F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(text), F.lit(0)).alias("bytes")


def _fits(size: Row, limit: int, max_bytes: int) -> bool:
    """Whether a piece may be broadcast; a single row cannot be cut further."""
    return size["rows"] <= limit and (size["bytes"] <= max_bytes or size["rows"] <= 1)


def checked_chunks(
    small: DataFrame, limit: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> list[DataFrame]:
    """``small`` as one piece, or its distinct rows as hash chunks of at most
    ``limit`` rows and ``max_bytes`` bytes (equal rows would stay together in
    every chunking)."""
    if _fits(small.agg(*_sizes(small)).first(), limit, max_bytes):
        return [small]
    small = small.distinct()
    size = small.agg(*_sizes(small)).first()
    if _fits(size, limit, max_bytes):
        return [small]
    chunks = max(2, math.ceil(2 * size["rows"] / limit), math.ceil(2 * size["bytes"] / max_bytes))
    while True:
        keyed = small.withColumn(_CHUNK, F.pmod(F.xxhash64(*small.columns), F.lit(chunks)))
        sizes = keyed.groupBy(_CHUNK).agg(*_sizes(small)).collect()  # one row per chunk
        if all(_fits(s, limit, max_bytes) for s in sizes):
            return [keyed.filter(F.col(_CHUNK) == i).drop(_CHUNK) for i in range(chunks)]
        chunks *= 2


def broadcast_join(
    large: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    limit: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``large.join(broadcast(small), on, how)`` with the size bound enforced.

    Beyond the bound an equi-join is an ordinary shuffled join. A condition is
    joined chunk by chunk of the distinct ``small`` rows (inner only): each
    output row pairs with one of them, which lies in exactly one chunk.
    """
    equi = isinstance(on, (str, list))
    if equi and not _fits(small.agg(*_sizes(small)).first(), limit, max_bytes):
        # An equi-join needs no broadcast: shuffled once, skew split by AQE.
        return large.join(small, on, how)
    if how != "inner":
        raise ValueError(f"chunked broadcast join is exact only for inner joins, not {how!r}")
    pieces = [large.join(F.broadcast(p), on, how) for p in checked_chunks(small, limit, max_bytes)]
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out
