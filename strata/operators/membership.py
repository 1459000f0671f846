"""Membership bitmaps of stored keys, one set per partition day.

Most rows of a batch are new, and shuffling them against the stored keys only
confirms it. A key's hash names a bit of a domain of ``bits`` bits; a day's
bitmaps have the bits of the keys stored on it (built-in bitmap functions: a
domain is cut into buckets of 32,768 bits, and only buckets with a bit exist).
The bitmaps of a batch's days OR together into at most ``bits / 8`` bytes,
which is the proven size of the broadcast. A row whose bit is clear has a key
that is stored on none of those days: it is new and skips the anti-join. The
others, among them those that only share a bit with a stored key, go through
the anti-join as ever, so the result is exact for any domain.

``domain_bits`` picks the domain: eight bits a stored key keep the share of new
rows that join by a chance hit near one in eight, up to the broadcast bound;
beyond it more rows join, none is treated otherwise.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.keys import HASH_COL
from .increment import anti_join_new

#: Bits of one bitmap (fixed by the built-in functions).
BUCKET_BITS = 32_768
#: A merged domain is at most 64 MB, so a broadcast of it is too.
MAX_BITS = 64 * (1 << 20) * 8

_DAY, _BUCKET, _BITMAP, _POSITION = "day", "bucket", "bitmap", "__position"


def domain_bits(keys: int) -> int:
    """Bits of the domain for so many stored keys: a power of two."""
    return min(MAX_BITS, max(BUCKET_BITS, 1 << (8 * max(keys, 1) - 1).bit_length()))


def _place(key: str, bits: int) -> Column:
    """1 to ``bits``: bit positions of the built-in functions start at one."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(bits).cast("bigint")) + F.lit(1).cast("bigint")


def day_bitmaps(stored: DataFrame, part: str, bits: int, key: str = HASH_COL) -> DataFrame:
    """(day, bucket, bitmap) of the stored keys, combined on the map side."""
    place = stored.select(F.col(part).cast("string").alias(_DAY), _place(key, bits).alias(_POSITION))
    return place.groupBy(_DAY, F.bitmap_bucket_number(_POSITION).alias(_BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_POSITION)).alias(_BITMAP)
    )


def merged(bitmaps: DataFrame) -> DataFrame:
    """(bucket, bitmap) over all rows: a day may have been added to often."""
    return bitmaps.groupBy(_BUCKET).agg(F.bitmap_or_agg(_BITMAP).alias(_BITMAP))


def _bit(bitmap: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (at / F.lit(8)).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (at % F.lit(8)).cast("int")).bitwiseAND(F.lit(1))


def with_chance(batch: DataFrame, bitmaps: DataFrame, bits: int, name: str, key: str = HASH_COL) -> DataFrame:
    """``batch`` with a column telling whether its key may be stored.
    ``bitmaps``: those of the batch's days, of the same domain."""
    if bits > MAX_BITS:
        raise ValueError(f"a domain of {bits} bits is beyond the broadcast bound of {MAX_BITS}")
    place = _place(key, bits)
    found = merged(bitmaps).select(F.col(_BUCKET).alias("__bucket"), F.col(_BITMAP).alias("__bits"))
    out = batch.join(F.broadcast(found), F.bitmap_bucket_number(place) == F.col("__bucket"), "left")
    hit = _bit(F.col("__bits"), F.bitmap_bit_position(place)) == 1
    return out.withColumn(name, F.coalesce(hit, F.lit(False))).drop("__bucket", "__bits")


def new_rows_by_bitmap(
    batch: DataFrame,
    stored: DataFrame,
    bitmaps: DataFrame,
    bits: int,
    key: str = HASH_COL,
    hot: list | None = None,
    sure_seen: Observation | None = None,
    may_seen: Observation | None = None,
) -> DataFrame:
    """The rows of ``anti_join_new(batch, stored)``; ``stored`` and ``bitmaps``
    hold the batch's days. The observations count the ``rows`` that were surely
    new and those that had to be looked up (``observed_rows`` reads them)."""
    chance = "__may_be_stored"
    marked = with_chance(batch, bitmaps, bits, chance, key)
    sure, may = marked.filter(~F.col(chance)).drop(chance), marked.filter(F.col(chance)).drop(chance)
    if sure_seen is not None and may_seen is not None:
        rows = F.count(F.lit(1)).alias("rows")
        sure, may = sure.observe(sure_seen, rows), may.observe(may_seen, rows)
    return sure.unionByName(anti_join_new(may, stored, key, hot))


def observed_rows(seen: Observation) -> int:
    """Rows an observation of a run plan counted: none where Spark found the
    branch empty and left it out."""
    try:
        return int(seen.get.get("rows", 0))
    except Py4JJavaError:
        return 0
