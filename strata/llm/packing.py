"""Packing documents into sequences (operator 10).

Lengths are integers up to the sequence length, so the whole instance is a
histogram of at most that many rows, whatever the corpus. On it, Martello and
Toth's dominance criterion fixes sets that some best packing contains; the
rest is packed best fit, longest first. The plan is a list of patterns (so
many sequences of this content). Pieces get their rank among equal lengths in
a distributed sort and read their place off the plan.

Defined results: a null or empty text is one piece (its end id); repeated
rows are documents of their own; a null id is a document like any other; an
empty table gives no row.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import id_type, ids_and_text, map_arrow, map_texts, partitions, stage
from strata.llm.tokenids import ENCODERS, SLICE_CHARS, default_tokenizer, encoder

#: How many sequences, and the (length, count) items that each of them holds.
Pattern = tuple[int, tuple[tuple[int, int], ...]]


def cut_pieces(
    docs: DataFrame,
    seq_len: int,
    end_id: int,
    tokenizer_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``seq_len`` ids; only longer documents are cut, the
    first piece takes what does not fill a sequence."""
    path = tokenizer_path or default_tokenizer()
    end = np.array([end_id], "<u4").tobytes()

    def pieces(rows: pa.RecordBatch, texts: list[str]) -> dict:
        out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        keys = rows.column("doc_id").to_pylist()
        for key, encoded in zip(keys, encoder(path).encode(texts), strict=True):
            raw = memoryview(encoded + end)
            n = len(raw) // 4
            at, stop, piece = 0, (n - 1) % seq_len + 1, 0
            while at < n:
                out["doc_id"].append(key)
                out["piece"].append(piece)
                out["start"].append(at)
                out["length"].append(stop - at)
                out["ids_crc32"].append(zlib.crc32(raw[4 * at : 4 * stop]))
                at, stop, piece = stop, stop + seq_len, piece + 1
        return out

    schema = f"doc_id {id_type(docs, id_col)}, piece int, start long, length long, ids_crc32 long"
    return map_texts(ids_and_text(docs, id_col, text_col), pieces, schema, max_chars=SLICE_CHARS, uses=ENCODERS)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sets that dominate every other set with the same largest item.

    For the largest open item j let x be the largest other item that fits
    beside it. {j} dominates if nothing fits; {j, x} does if x fills the
    sequence, or if no two items fit beside j, or if no three do and no two
    weigh more than x together; {j, x, b} does if no three fit, x + b fills the
    sequence and every other pair has an item of at most b. Fixing such sets
    keeps some best packing within reach. Returns the fixed sets and what is
    left over."""
    left = {s: c for s, c in counts.items() if c}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def take(items: list[int], times: int) -> None:
        content: dict[int, int] = {}
        for s in items:
            content[s] = content.get(s, 0) + 1
        fixed.append((times, tuple(sorted(content.items(), reverse=True))))
        for s, k in content.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    def smallest(n: int, without: int) -> int | None:
        """Weight of the n smallest items, one item ``without`` left out."""
        total, need = 0, n
        for s in sizes:
            k = min(need, left[s] - (s == without))
            total, need = total + k * s, need - k
            if not need:
                return total
        return None

    def largest(room: int, without: tuple[int, ...]) -> int | None:
        at = bisect_right(sizes, room) - 1
        while at >= 0:
            if left[sizes[at]] > without.count(sizes[at]):
                return sizes[at]
            at -= 1
        return None

    def step(j: int) -> bool:
        room = capacity - j
        x = largest(room, (j,))
        if x is None:
            take([j], left[j])
            return True
        times = left[j] // 2 if x == j else min(left[j], left[x])
        two = smallest(2, j)
        if x == room or two is None or two > room:
            take([j, x], times)
            return True
        three = smallest(3, j)
        if three is not None and three <= room:
            return False
        best, pair = 0, (0, 0)
        for a in reversed(sizes[: bisect_right(sizes, room)]):
            if left[a] <= (a == j):
                continue
            b = largest(min(a, room - a), (j, a))
            if b is not None and a + b > best:
                best, pair = a + b, (a, b)
        if x >= best:
            take([j, x], 1)
            return True
        a, b = pair
        above = next((s for s in sizes[bisect_right(sizes, b) :] if left[s] > (s == j)), None)
        if a == x and a + b == room and (above is None or 2 * above > room):
            take([j, a, b], 1)
            return True
        return False

    changed = True
    while changed:
        changed = False
        for j in sorted(sizes, reverse=True):
            while left.get(j) and step(j):
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, on equal sequences at once: an item goes to
    the fullest sequence it fits, and so do its equals until that is full."""
    rooms: list[int] = []  # sorted distinct free room
    open_bins: dict[int, list[tuple[int, tuple]]] = {}

    def put(room: int, times: int, content: tuple) -> None:
        if room not in open_bins:
            insort(rooms, room)
            open_bins[room] = []
        open_bins[room].append((times, content))

    for s in sorted(counts, reverse=True):
        need = counts[s]
        while need:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                times, rest = divmod(need, each)
                if times:
                    put(capacity - each * s, times, ((s, each),))
                if rest:
                    put(capacity - rest * s, 1, ((s, rest),))
                break
            room = rooms[at]
            times, content = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(at)
            each = room // s
            full = min(times, need // each)
            if full:
                put(room - each * s, full, (*content, (s, each)))
                need -= full * each
                times -= full
            if times and need:  # fewer items than fill one more sequence
                put(room - need * s, 1, (*content, (s, need)))
                need, times = 0, times - 1
            if times:
                put(room, times, content)
    return [p for bins in open_bins.values() for p in bins]


def plan_patterns(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, its slots in plan order: the r-th piece of a length
    finds its entry by (length, first slot <= r)."""
    rows, used, sequence = [], {}, 0
    for times, content in patterns:
        offset = 0
        for s, k in content:
            first = used.get(s, 0)
            rows.append((s, first, sequence, k, offset))
            used[s] = first + times * k
            offset += s * k
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "sequence", "each", "offset"), cols, strict=True))


def place(pieces: DataFrame, seq_len: int) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a staged table of pieces."""
    spark = pieces.sparkSession
    order = ["length", "doc_id", "piece", "start", "ids_crc32"]

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        shard, length, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            v = batch.column("length").to_numpy()
            if not len(v):
                continue
            new = np.flatnonzero(np.r_[v[0] != length, v[1:] != v[:-1]])
            start = np.zeros(len(v), np.int64)
            start[new] = new
            rank = np.arange(len(v)) - np.maximum.accumulate(start)
            head = new[0] if len(new) else len(v)
            rank[:head] += seen
            seen, length = int(rank[-1]) + 1, v[-1]
            yield {c: batch.column(c) for c in batch.schema.names} | {"shard": np.full(len(v), shard, np.int32), "rank": rank}

    kind = pieces.schema["doc_id"].dataType.simpleString()
    base = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    # Ranges over the whole order split a length that many pieces share.
    dealt = pieces.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    dealt = stage(map_arrow(dealt, ranked, base + ", shard int, rank long"), "pieces-ranked")

    # At most seq_len + (number of partitions) rows: a partition's lengths are
    # consecutive in the order.
    per = dealt.groupBy("length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).collect()
    counts: dict[int, int] = {}
    for r in per:
        counts[r["length"]] = counts.get(r["length"], 0) + r["n"]
    plan = slots(plan_patterns(counts, seq_len))
    shift = {(r["length"], r["shard"]): r["before"] for r in per}
    shared = spark.sparkContext.broadcast((plan, shift))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        plan, shift = shared.value
        big = np.int64(1) << 44
        keys = plan["length"] * big + plan["first"]
        for batch in batches:
            v = batch.column("length").to_numpy()
            if not len(v):
                continue
            shard = batch.column("shard").to_numpy()
            both, which = np.unique(np.stack([v, shard.astype(np.int64)], 1), axis=0, return_inverse=True)
            base = np.array([shift[a, b] for a, b in both.tolist()], np.int64)[which.reshape(-1)]
            rank = batch.column("rank").to_numpy() + base
            at = np.searchsorted(keys, v * big + rank, side="right") - 1
            nth = rank - plan["first"][at]
            cols = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield cols | {
                "sequence_id": plan["sequence"][at] + nth // plan["each"][at],
                "offset": plan["offset"][at] + nth % plan["each"][at] * v,
            }

    return map_arrow(dealt, placed, base + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, seq_len: int = 2048, end_id: int = 0, tokenizer_path: str | None = None) -> DataFrame:
    """One row per piece with its sequence and place there."""
    return place(stage(cut_pieces(docs, seq_len, end_id, tokenizer_path), "pieces"), seq_len)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"))
