"""Near-duplicate documents by ProbMinHash (operator 9).

Shingles of five words, weighted by how often they occur. Each shingle is a
Poisson process whose rate is its weight; its arrivals fall on random
components, and a component keeps the earliest arrival. A document stops
drawing for a shingle once its next arrival is later than the latest kept one.
Two documents agree on a component with probability J_P, the probability
Jaccard similarity. Signatures are banded; pairs that share a band are
verified by the exact J_P of their weighted shingles.

Texts with the same words form a class and are never paired with each other:
only one member per class is signed into bands. In a bucket every class meets
its smallest class first (as many pairs as members). Buckets that still hold
several groups of linked classes after that are compared fully, block against
block inside tasks; only links between different groups come out. No bucket is
capped.

Defined results: a text of one to four words has one shingle, all its words;
a text without words (null, empty, signs only) is like no other; rows that
repeat an id and a text are copies; a null id groups like any other (as the
smallest id); an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import fresh, id_type, ids_and_text, map_arrow, map_texts, partitions, runs, stage
from strata.llm.components import components
from strata.llm.textcore import Words, mix, ngrams, words

SHINGLE = 5
SIMILARITY = 0.8
#: 25 bands of 5: a pair at 0.8 shares one but for odds of 5e-5.
BANDS, ROWS = 25, 5
SIZE = BANDS * ROWS
#: Signatures of a pair at 0.8 agree on at least this share but for odds of 3e-5.
AGREE = 0.66
BLOCK = 256


def weighted_shingles(w: Words, n_docs: int, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, shingle) with weights, ordered by text and shingle."""
    h, at = ngrams(w, width)
    doc = np.searchsorted(w.first, at, side="right") - 1
    size = np.diff(w.first)
    short = np.flatnonzero((size > 0) & (size < width))
    if len(short):
        own = np.array([int.from_bytes(hashlib.blake2b(w.hash[w.of(d)].tobytes(), digest_size=8).digest(), "little") for d in short.tolist()], np.uint64)
        h, doc = np.concatenate([h, own]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, np.int64)
    return doc[new], h[new], np.diff(np.append(new, len(h)))


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int, size: int = SIZE) -> np.ndarray:
    """ProbMinHash: for each text and component the low half of the shingle
    that arrives first. All texts draw together, one arrival a round."""
    earliest = np.full(n_docs * size, np.inf)
    winner = np.zeros(n_docs * size, np.uint32)
    time = np.zeros(len(h))
    live = np.arange(len(h))
    latest = np.full(n_docs, np.inf)
    rounds = 0
    while len(live):
        rounds += 1
        with np.errstate(over="ignore"):
            r = mix(h[live] + np.uint64(rounds) * np.uint64(0xD1342543DE82EF95))
            component = ((mix(r ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        gap = -np.log(((r >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53)
        t = time[live] + gap / weight[live]
        time[live] = t
        slot = doc[live] * size + component
        np.minimum.at(earliest, slot, t)
        won = earliest[slot] == t
        winner[slot[won]] = (h[live[won]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        # A stale bound is too late, never too early: refreshing it seldom is safe.
        if rounds <= 4 or rounds % 8 == 0:
            latest = earliest.reshape(n_docs, size).max(axis=1)
        live = live[t < latest[doc[live]]]
    return winner.reshape(n_docs, size)


def probability_jaccard(xh: np.ndarray, xw: np.ndarray, yh: np.ndarray, yw: np.ndarray) -> float:
    """Exact J_P of two sorted weighted sets. Shared shingles with the same
    ratio of weights share their denominator."""
    _, i, j = np.intersect1d(xh, yh, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    a, b = xw[i].astype(float), yw[j].astype(float)
    only_x, only_y = xw.sum() - a.sum(), yw.sum() - b.sum()
    ratio, which = np.unique(b / a, return_inverse=True)
    total = np.bincount(which.reshape(-1), weights=a)
    return float(sum(t / (only_x + only_y / r + np.maximum(a, b / r).sum()) for r, t in zip(ratio, total, strict=True)))


def signed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: class key (two longs; null without words) and signature."""
    rows = ids_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))

    def run(rows: pa.RecordBatch, texts: list[str]) -> dict:
        w = words(texts)
        sig = signatures(*weighted_shingles(w, len(texts)), len(texts))
        c1, c2, out = [], [], []
        for d in range(len(texts)):
            own = w.hash[w.of(d)]
            key = hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None
            c1.append(key and int.from_bytes(key[:8], "little", signed=True))
            c2.append(key and int.from_bytes(key[8:], "little", signed=True))
            out.append(key and sig[d].astype("<u4").tobytes())
        return {"doc_id": rows.column("doc_id"), "text_hash": rows.column("text_hash"), "c1": c1, "c2": c2, "signature": out}

    return map_texts(rows, run, f"doc_id {id_type(docs, id_col)}, text_hash long, c1 long, c2 long, signature binary")


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, SIZE)


def band_rows(classes: DataFrame) -> DataFrame:
    """(bucket, class) for each band of each class's signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("signature")).reshape(-1, BANDS, ROWS).astype(np.uint64)
            key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), sig.shape[:2])
            for i in range(ROWS):
                with np.errstate(over="ignore"):
                    key = mix(key + sig[:, :, i] + np.uint64(0x9E3779B97F4A7C15))
            band = np.tile(np.arange(BANDS, dtype=np.int8), len(sig))
            yield {"bucket": key.reshape(-1).view(np.int64), "band": band, "c1": np.repeat(batch.column("c1").to_numpy(), BANDS)}

    return map_arrow(classes.select("c1", "signature"), run, "bucket long, band byte, c1 long")


def agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose signatures agree on at least ``AGREE`` of the components."""
    sig = classes.select("c1", "signature")
    rows = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if batch.num_rows:
                share = (_matrix(batch.column("sa")) == _matrix(batch.column("sb"))).mean(axis=1)
                keep = pa.array(share >= AGREE)
                yield {c: batch.column(c).filter(keep) for c in ("a", "b")}

    return map_arrow(rows, run, "a long, b long")


def shingle_sets(wanted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The weighted shingles of the ``wanted`` classes (``c1``): sorted hashes
    ``h`` and weights ``w`` (empty: all one). ``docs`` has ``doc_id`` and
    ``text``; a class is looked up by its first member's id and text hash."""
    first = classes.select("c1", F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__hash")).join(wanted, "c1")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))

    def sets(rows: pa.RecordBatch, texts: list[str]) -> dict:
        doc, h, weight = weighted_shingles(words(texts), len(texts))
        cut = np.searchsorted(doc, np.arange(1, len(texts)))
        plain = [b"" if (x == 1).all() else x.astype("<u4").tobytes() for x in np.split(weight, cut)]
        return {"c1": rows.column("c1"), "h": [x.astype("<u8").tobytes() for x in np.split(h, cut)], "w": plain}

    return map_texts(docs.join(first, same).select("c1", "text"), sets, "c1 long, h binary, w binary").dropDuplicates(["c1"])


def _set(h: bytes, w: bytes) -> tuple[np.ndarray, np.ndarray]:
    hashes = np.frombuffer(h, "<u8")
    return hashes, np.frombuffer(w, "<u4") if w else np.ones(len(hashes), np.uint32)


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of classes whose exact similarity reaches the threshold."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c1")).distinct()
    found = stage(shingle_sets(wanted, docs, classes), "shingles")
    rows = pairs.join(found.toDF("a", "ah", "aw"), "a").join(found.toDF("b", "bh", "bw"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("ah", "aw", "bh", "bw")]
            keep = pa.array(
                [probability_jaccard(*_set(ah, aw), *_set(bh, bw)) >= similarity for ah, aw, bh, bw in zip(*columns, strict=True)],
                pa.bool_(),
            )
            yield {c: batch.column(c).filter(keep) for c in ("a", "b")}

    return map_arrow(rows, run, "a long, b long")


def within_buckets(bands: DataFrame, docs: DataFrame, classes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """Links between different groups in buckets that hold several, found by
    comparing each class of the bucket with each other.

    A bucket of n classes is cut into blocks by hash; a task compares one block
    with one block, so no bucket is a single task's. Signatures sort out most
    pairs, the rest are verified on the spot, in the first band that the two
    share only, and pairs that links of the same block already join are left
    out: what comes out is links, fewer than rows went in."""
    rooted = bands.join(roots, "c1", "left").select("bucket", "band", "c1", F.coalesce("root", "c1").alias("root"))
    open_ = rooted.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    open_ = open_.filter("lo <> hi and n > 2").select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = stage(rooted.join(open_, "bucket"), "open-buckets")
    sets = stage(shingle_sets(rows.select("c1").distinct(), docs, classes), "open-shingles")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("c1"), F.col("blocks")).cast("int"))
    rows = rows.join(sets, "c1").join(classes.select("c1", "signature"), "c1")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("meet"),
        F.when(F.col("block") == F.col("other"), F.lit(2)).when(F.col("block") < F.col("other"), F.lit(0)).otherwise(F.lit(1)).alias("side"),
        "band",
        "c1",
        "root",
        "signature",
        "h",
        "w",
    )
    met = rows.repartition(partitions(rows.sparkSession), "meet").sortWithinPartitions("meet")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for t in runs(batches, "meet"):
            sig = _matrix(t.column("signature")).reshape(-1, BANDS, ROWS)
            meet, band, c1, root, side = (t.column(c).to_numpy() for c in ("meet", "band", "c1", "root", "side"))
            h, w = t.column("h"), t.column("w")
            cut = np.flatnonzero(np.r_[True, meet[1:] != meet[:-1]]).tolist()
            out: list[tuple[int, int]] = []
            for lo, hi in zip(cut, [*cut[1:], len(meet)], strict=True):
                group = root[lo:hi].copy()  # links found here merge groups
                held: dict[int, tuple] = {}
                for i in range(lo, hi):
                    may = (group != group[i - lo]) & (c1[lo:hi] > c1[i]) & ((side[lo:hi] == 2) | (side[lo:hi] != side[i]))
                    j = lo + np.flatnonzero(may)
                    if not len(j):
                        continue
                    same = sig[j] == sig[i]
                    first = same.all(axis=2).argmax(axis=1) == band[i]
                    for k in j[first & (same.mean(axis=(1, 2)) >= AGREE)].tolist():
                        if group[k - lo] == group[i - lo]:
                            continue
                        a, b = (held[x] if x in held else held.setdefault(x, _set(h[x].as_py(), w[x].as_py())) for x in (i, k))
                        if probability_jaccard(*a, *b) >= similarity:
                            out.append((int(c1[i]), int(c1[k])))
                            group[group == group[k - lo]] = group[i - lo]
            if out:
                yield {"a": [a for a, _ in out], "b": [b for _, b in out]}

    return map_arrow(met, run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``text_hash`` (xxhash64 of the text),
    ``class_id`` (the smallest id of its group of linked documents),
    ``class_size`` (rows of the group) and ``first``: whether this is the row
    of the group to keep."""
    plain = ids_and_text(docs, id_col, text_col)
    rows = stage(signed(docs, id_col, text_col), "signed")
    # Members of a class have the same words, so the same signature.
    classes = rows.filter("c1 is not null").groupBy("c1", "c2").agg(
        F.first("signature").alias("signature"), F.min(F.struct("doc_id", "text_hash")).alias("first")
    )
    classes = stage(classes, "classes")
    bands = band_rows(classes)
    heads = bands.groupBy("bucket").agg(F.min("c1").alias("a"), F.max("c1").alias("top")).filter("a <> top").select("bucket", "a")
    heads = stage(heads, "bucket-heads")
    pairs = bands.drop("band").join(heads, "bucket").filter("a <> c1").select("a", F.col("c1").alias("b")).distinct()
    pairs = stage(agreeing(pairs, classes), "pairs")
    links = stage(verified(pairs, plain, classes, similarity), "verified")
    roots = components(links).toDF("c1", "root")

    shared = band_rows(classes).join(heads.select("bucket"), "bucket")
    more = stage(within_buckets(shared, plain, classes, roots, similarity), "more-links")
    if not more.isEmpty():
        roots = components(links.unionByName(more)).toDF("c1", "root")

    member = rows.drop("signature").join(roots, "c1", "left")
    member = member.withColumn("root", F.coalesce("root", "c1"))
    groups = member.filter("c1 is not null").groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(F.struct("doc_id", "text_hash")).alias("head")
    )
    alone = F.col("root").isNull()
    return member.join(groups, "root", "left").select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).alias("class_size"),
        (alone | (F.struct("doc_id", "text_hash").eqNullSafe(F.col("head")))).alias("first"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group: the smallest id's. Rows without
    words all stay."""
    found = stage(near_duplicates(docs, id_col, text_col, similarity), "groups")
    key, text_hash, grouped = fresh(docs, "kept_id", "kept_hash", "kept_group")
    keep = found.filter("first").select(
        F.col("doc_id").alias(key), F.col("text_hash").alias(text_hash), (F.col("class_size") > 1).alias(grouped)
    )
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(text_hash))
    kept = docs.join(keep.distinct(), same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Rows that repeat an id and a text are copies too: one of them stays.
    repeats = found.filter("first and class_size > 1").groupBy("doc_id", "text_hash").count().filter("count > 1")
    if repeats.isEmpty():
        return kept.select(*columns)
    lone = kept.filter(F.col(grouped)).dropDuplicates([key, text_hash])
    return kept.filter(~F.col(grouped)).unionByName(lone).select(*columns)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")
