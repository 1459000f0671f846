"""Exact removal of long repeats with a logarithmic family of suffix arrays
(operator 8).

A byte goes if a string of ``LENGTH`` bytes covers it that also starts
anywhere else, in the same document or another, judged on the input.

Sampling. Every window of ``LENGTH`` bytes has an anchor: the leftmost smallest
hash among its grams of ``GRAM`` bytes. Equal windows have their anchors at
equal places, so only suffixes that begin at anchors (about one in 70) are
indexed. A suffix row holds its gram, a hash of the stretch that the windows of
its anchor cover, and where it stands.

Index. Each batch of documents gets a suffix array: its rows sorted by gram.
It is merge-scanned against every level of the index (sort-merge joins on the
gram) for shared ones, becomes a level itself, and levels of equal size are
merged, so a row is rewritten as often as the logarithm of the batch count.

Matches. Anchors whose gram was met once are done. Of the others, those whose
whole stretch was met twice lose it all. The rest lie at the edge of a repeat:
one example of each distinct stretch is compared window by window with the
others of its gram, inside tasks; grams of very many stretches are compared by
counting window hashes in the cluster instead.

Grams, stretches and windows are compared by 64-bit hashes, the last two only
among equals of the former.

Defined results: a null text is an empty one; texts shorter than ``LENGTH``
lose nothing; rows that repeat an id and a text are documents of their own, so
each repeats the other; a null id is an id; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import drop_path, map_arrow, map_texts, partitions, release, runs, scratch_path, stage
from strata.llm.textcore import mix

LENGTH = 200
GRAM = 32
#: Batches that the rows of one call are dealt to.
BATCHES = 4
#: Stretches of one gram that are compared inside one task, at most.
TASK_STRETCHES = 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` bytes in a row, by doubling."""
    if len(data) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h, size, power = mix(data.astype(np.uint64) + np.uint64(1)), 1, _BASE
        out, done = None, 0
        while True:
            if n & size:
                if out is None:
                    out = h
                else:
                    room = len(data) - done - size + 1
                    out = out[:room] * power + h[done : done + room]
                done += size
            if size * 2 > n:
                return mix(out)
            room = len(data) - 2 * size + 1
            h = h[:room] * power + h[size : size + room]
            size, power = size * 2, power * power


def _leftmost_smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Where the leftmost smallest of every ``width`` values in a row is."""
    at = np.arange(len(h), dtype=np.int64)
    size = 1

    def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(h[b] < h[a], b, a)

    while size * 2 <= width:
        at = meet(at[:-size], at[size:])
        size *= 2
    if size < width:
        n = len(h) - width + 1
        at = meet(at[:n], at[width - size : width - size + n])
    return at


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(gram hash, position, first and last window start) of each anchor."""
    h = window_hashes(np.frombuffer(data, np.uint8), gram)
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return h[:0], none, none, none
    at = _leftmost_smallest(h, length - gram + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.append(first[1:], len(at)) - 1
    return h[at[first]], at[first], first, last


def suffix_rows(docs: DataFrame, length: int, batches: int) -> DataFrame:
    """Suffix rows of every document of ``docs`` (``row``, ``text``)."""

    def run(rows: pa.RecordBatch, texts: list[str]) -> dict | None:
        ids = rows.column("row").to_numpy()
        out: list[list[np.ndarray]] = [[], [], [], [], [], []]
        for row, text in zip(ids.tolist(), texts, strict=True):
            data = text.encode()
            gram, at, lo, hi = anchors(data, length)
            if not len(gram):
                continue
            stretch = [
                int.from_bytes(hashlib.blake2b(data[a : b + length], digest_size=8, salt=(p - a).to_bytes(4, "little")).digest(), "little", signed=True)
                for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True)
            ]
            cols = (gram.view(np.int64), np.array(stretch, np.int64), np.full(len(gram), row), at, at - lo, at - hi)
            for have, col in zip(out, cols, strict=True):
                have.append(col)
        if not out[0]:
            return None
        return dict(zip(("gram", "stretch", "row", "at", "before", "until"), map(np.concatenate, out), strict=True))

    made = map_texts(docs, run, "gram long, stretch long, row long, at int, before short, until short")
    return made.withColumn("batch", F.pmod(F.col("row"), F.lit(batches)).cast("int"))


class SuffixIndex:
    """Levels of suffix arrays in the shared folder. ``add`` takes a batch of
    suffix rows; ``repeated`` is the set of grams met more than once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, str]] = []  # (batches in it, path), largest first
        self.met: list[str] = []

    def _sorted(self, rows: DataFrame) -> str:
        path = scratch_path(self.spark, "suffixes")
        # Ranges of the whole order: a frequent gram spreads over several.
        order = ("gram", "stretch", "row")
        rows.repartitionByRange(partitions(self.spark), *order).sortWithinPartitions(*order).write.parquet(path)
        release(self.spark)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def add(self, rows: DataFrame) -> None:
        path = self._sorted(rows)
        own = self._read(path).groupBy("gram").count()
        met = own.filter("count > 1").select("gram")
        for _, level in self.levels:
            # Both sides hold a gram once: a frequent one weighs no more.
            theirs = self._read(level).select("gram").distinct()
            met = met.unionByName(own.select("gram").join(theirs, "gram"))
        found = scratch_path(self.spark, "met")
        met.distinct().write.parquet(found)
        self.met.append(found)
        release(self.spark)
        self.levels.append((1, path))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * n, self._sorted(self._read(a).unionByName(self._read(b)))))
            drop_path(self.spark, a)
            drop_path(self.spark, b)

    def rows(self) -> DataFrame:
        out = self._read(self.levels[0][1])
        for _, path in self.levels[1:]:
            out = out.unionByName(self._read(path))
        return out

    def repeated(self) -> DataFrame:
        return self.spark.read.parquet(*self.met).distinct()

    def drop(self) -> None:
        for path in [p for _, p in self.levels] + self.met:
            drop_path(self.spark, path)


def _covered(starts: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """The union of [s, s + length) over sorted starts."""
    cut = np.flatnonzero(np.diff(starts) > length)
    return starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + length).tolist()


def _windows(contexts: list[bytes], grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, context, offset) of every window of the contexts; the hash is of
    the window and the gram its anchor has."""
    size = np.array([len(c) for c in contexts], np.int64)
    flat = window_hashes(np.frombuffer(b"".join(contexts), np.uint8), length)
    n = size - length + 1
    which = np.repeat(np.arange(len(contexts)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    h = flat[(np.cumsum(size) - size)[which] + offset]
    with np.errstate(over="ignore"):
        return mix(h + mix(grams.view(np.uint64))[which] * _BASE), which, offset


def compare_in_tasks(contexts: DataFrame, length: int) -> DataFrame:
    """Covered parts (from the anchor) of stretches met once, by comparing
    all windows of the contexts of a gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for t in runs(batches, "gram"):
            texts = t.column("context").to_pylist()
            h, which, offset = _windows(texts, t.column("gram").to_numpy(), length)
            _, back, n = np.unique(h, return_inverse=True, return_counts=True)
            once = t.column("n").to_numpy() == 1
            dup = (n[back.reshape(-1)] > 1) & once[which]
            yield _parts(t, which[dup], offset[dup], length)

    near = contexts.repartition(partitions(contexts.sparkSession), "gram").sortWithinPartitions("gram")
    return map_arrow(near, run, "gram long, stretch long, begins array<int>, ends array<int>")


def _parts(t: pa.Table, which: np.ndarray, offset: np.ndarray, length: int) -> dict:
    gram, stretch, before = (t.column(c).to_numpy() for c in ("gram", "stretch", "before"))
    some, first = np.unique(which, return_index=True)
    covered = [_covered(o - int(before[w]), length) for w, o in zip(some.tolist(), np.split(offset, first[1:]), strict=True)] if len(some) else []
    return {"gram": gram[some], "stretch": stretch[some], "begins": [c[0] for c in covered], "ends": [c[1] for c in covered]}


def compare_by_counting(contexts: DataFrame, length: int) -> DataFrame:
    """The same for grams of very many stretches: window hashes are counted
    in the cluster, which combines equal ones before they move."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                t = whole.slice(lo, 2000)
                h, which, offset = _windows(t.column("context").to_pylist(), t.column("gram").to_numpy(), length)
                take = pa.array(which)
                yield {c: t.column(c).take(take) for c in ("gram", "stretch", "before", "n")} | {"h": h.view(np.int64), "offset": offset}

    windows = map_arrow(contexts, explode, "gram long, stretch long, before short, n long, h long, offset int")
    twice = windows.groupBy("h").agg(F.sum("n").alias("times")).filter("times > 1").select("h")
    dup = windows.filter("n = 1").join(twice, "h").groupBy("gram", "stretch", "before").agg(F.sort_array(F.collect_list("offset")).alias("offsets"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for t in batches:
            sizes = pa.compute.list_value_length(t.column("offsets")).to_numpy()
            offsets = t.column("offsets").flatten().to_numpy().astype(np.int64)
            yield _parts(t, np.repeat(np.arange(t.num_rows), sizes), offsets, length)

    return map_arrow(dup, cover, "gram long, stretch long, begins array<int>, ends array<int>")


def covered_stretches(suffixes: DataFrame, docs: DataFrame, length: int, task_stretches: int) -> DataFrame:
    """(gram, stretch) with the parts that go, in bytes from the anchor."""
    pick = [F.first(c).alias(c) for c in ("row", "at", "before", "until")]  # all of one suffix
    distinct = stage(suffixes.groupBy("gram", "stretch").agg(F.count("*").alias("n"), *pick), "stretches")
    whole = distinct.filter("n > 1").select(
        "gram",
        "stretch",
        F.array(-F.col("before").cast("int")).alias("begins"),
        F.array(length - F.col("until").cast("int")).alias("ends"),
    )
    many = distinct.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1")
    edge = distinct.join(many.select("gram", "kinds"), "gram")
    wanted = edge.groupBy("row").agg(F.collect_list(F.struct("gram", "stretch", "n", "kinds", "at", "before", "until")).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                out: dict[str, list] = {c: [] for c in ("gram", "stretch", "n", "kinds", "before", "context")}
                for text, cuts in zip(part.column("text").to_pylist(), part.column("cuts").to_pylist(), strict=True):
                    data = text.encode()
                    for c in cuts:
                        for name in ("gram", "stretch", "n", "kinds", "before"):
                            out[name].append(c[name])
                        out["context"].append(data[c["at"] - c["before"] : c["at"] - c["until"] + length])
                yield out

    # A row number that several equal rows share is looked up once per row;
    # the extra contexts are the same stretch and would count as another.
    contexts = map_arrow(docs.join(wanted, "row").select("text", "cuts"), cut, "gram long, stretch long, n long, kinds long, before short, context binary")
    contexts = stage(contexts.dropDuplicates(["gram", "stretch"]), "contexts")
    inside = compare_in_tasks(contexts.filter(F.col("kinds") <= task_stretches), length)
    across = compare_by_counting(contexts.filter(F.col("kinds") > task_stretches), length)
    return whole.unionByName(inside).unionByName(across)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    batches: int = BATCHES,
    task_stretches: int = TASK_STRETCHES,
) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``begins`` and ``ends`` (the
    maximal removed runs) and ``kept`` (the other bytes)."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    plain = plain.withColumn("row", F.xxhash64("doc_id", F.xxhash64("text")))
    fresh = scratch_path(spark, "new-suffixes")
    suffix_rows(plain.select("row", "text"), length, batches).write.partitionBy("batch").parquet(fresh)
    index = SuffixIndex(spark)
    schema = "gram long, stretch long, row long, at int, before short, until short, batch int"
    for b in range(batches):
        index.add(spark.read.schema(schema).parquet(fresh).filter(F.col("batch") == b).drop("batch"))
    drop_path(spark, fresh)
    suffixes = stage(index.rows().join(index.repeated(), "gram", "left_semi"), "repeated-suffixes")
    index.drop()
    parts = stage(covered_stretches(suffixes, plain.select("row", "text"), length, task_stretches), "covered")
    gone = (
        suffixes.select("gram", "stretch", "row", "at")
        .join(parts, ["gram", "stretch"])
        .select("row", F.explode(F.arrays_zip("begins", "ends")).alias("part"), "at")
        .groupBy("row")
        .agg(F.collect_set(F.struct((F.col("at") + F.col("part.begins")).alias("b"), (F.col("at") + F.col("part.ends")).alias("e"))).alias("gone"))
    )

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                out: dict[str, list] = {c: [] for c in ("n_bytes", "begins", "ends", "kept")}
                for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                    data = text.encode()
                    begins: list[int] = []
                    ends: list[int] = []
                    for b, e in sorted((g["b"], g["e"]) for g in gone or ()):
                        if ends and b <= ends[-1]:
                            ends[-1] = max(ends[-1], e)
                        else:
                            begins.append(b)
                            ends.append(e)
                    bounds = zip([0, *ends], [*begins, len(data)], strict=True)
                    for name, v in (("n_bytes", len(data)), ("begins", begins), ("ends", ends), ("kept", b"".join(data[a:b] for a, b in bounds))):
                        out[name].append(v)
                yield {"doc_id": batch.column("doc_id")} | out

    kind = plain.schema["doc_id"].dataType.simpleString()
    joined = plain.join(gone, "row", "left").select("doc_id", "text", "gone")
    return map_arrow(joined, strip, f"doc_id {kind}, n_bytes long, begins array<int>, ends array<int>, kept binary")


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("ends", "begins", lambda e, b: e - b), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("begins").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
