"""Nearest neighbours by a random-projection forest (operator 4).

Trees split a bounded sample at the median of its projection on the difference
of two random members. A query walks all trees through one priority queue: the
leaf whose worst split it misses by least comes first, whichever its tree,
until the leaves taken hold enough rows. How many are enough is learned on the
sample: the share of the rows at which the wanted recall is reached against
brute force. Every row is indexed, and all candidates of a leaf are reranked
by their exact inner product.

Leaves are cut into blocks of about ``BLOCK_ROWS`` rows by a hash of the id
and, for many queries, into ``QUERY_ROWS`` of those; so a leaf that holds a
third of all rows is many tasks' work.

Defined results: vectors that are null, zero, hold a null or non-finite
component, or differ in length from most of the sample take no part; a row
with a null id is no query and no candidate; a repeated id counts once, with
its best score; equal scores go to the smaller id; with fewer than k
candidates all are returned; an empty table gives no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import map_arrow, partitions, stage

K = 20
TREES = 4
DEPTH = 7
#: Rows the forest is fitted and calibrated on, at most, and queries among them.
SAMPLE_ROWS = 20_000
SAMPLE_QUERIES = 200
#: Recall on the sample that fixes the share of the rows to look at.
TARGET_RECALL = 0.96
MIN_LEAF = 8
BLOCK_ROWS = 4096
QUERY_ROWS = 100_000
SEED = 20


@dataclass
class Forest:
    dim: int
    normals: np.ndarray  # one row per inner node of any tree
    offsets: np.ndarray
    children: np.ndarray  # (inner, 2): an inner node, or -1 - leaf
    roots: list[int]
    leaves: int
    share: float = 1.0
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def fit(cls, x: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> Forest:
        rng = np.random.default_rng(seed)
        normals: list[np.ndarray] = []
        offsets: list[float] = []
        children: list[list[int]] = []
        leaves = 0

        def grow(rows: np.ndarray, level: int) -> int:
            nonlocal leaves
            if level < depth and len(rows) >= 2 * MIN_LEAF:
                for _ in range(8):
                    a, b = x[rng.choice(rows, 2, replace=False)]
                    normal = a - b
                    length = np.sqrt((normal * normal).sum())
                    if length > 0:
                        normal = normal / length
                        p = (x[rows] * normal).sum(axis=1)
                        middle = float(np.median(p))
                        right = p >= middle
                        if right.any() and not right.all():
                            me = len(normals)
                            normals.append(normal)
                            offsets.append(middle)
                            children.append([0, 0])
                            children[me] = [grow(rows[~right], level + 1), grow(rows[right], level + 1)]
                            return me
            leaves += 1
            return -leaves

        roots = [grow(np.arange(len(x)), 0) for _ in range(trees)]
        dim = x.shape[1]
        return cls(
            dim, np.array(normals).reshape(-1, dim), np.array(offsets), np.array(children, np.int64).reshape(-1, 2), roots, leaves
        )

    def margins(self, x: np.ndarray) -> np.ndarray:
        return x @ self.normals.T - self.offsets

    def place(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees): each row's leaf in each tree."""
        m = self.margins(x)
        rows = np.arange(len(x))
        out = np.empty((len(x), len(self.roots)), np.int64)
        for t, root in enumerate(self.roots):
            node = np.full(len(x), root)
            while (inner := node >= 0).any():
                r, n = rows[inner], node[inner]
                node[inner] = self.children[n, (m[r, n] >= 0).astype(np.int64)]
            out[:, t] = -1 - node
        return out

    def walk(self, margins: list[float], budget: float) -> list[int]:
        """Leaves by the shared queue until they hold ``budget`` rows."""
        queue = [(-np.inf, n) for n in self.roots]
        heapq.heapify(queue)
        taken, rows = [], 0
        children, sizes = self.child_list, self.size_list
        while queue and rows < budget:
            missed, node = heapq.heappop(queue)
            if node < 0:
                taken.append(-1 - node)
                rows += sizes[-1 - node]
                continue
            m = margins[node]
            left, right = children[node]
            heapq.heappush(queue, (max(missed, m), left))
            heapq.heappush(queue, (max(missed, -m), right))
        return taken

    def freeze(self, sizes: np.ndarray) -> None:
        self.sizes = sizes
        self.size_list, self.child_list = sizes.tolist(), self.children.tolist()

    def calibrate(self, x: np.ndarray, k: int, target: float) -> None:
        """The share of the rows at which ``target`` of the true neighbours of
        some sample rows have been met."""
        place = self.place(x)
        self.freeze(np.bincount(place.reshape(-1), minlength=self.leaves))
        n = min(SAMPLE_QUERIES, len(x))
        margins = self.margins(x[:n])
        seen_at = []
        for q in range(n):
            score = x @ x[q]
            score[q] = -np.inf
            true = np.argsort(-score, kind="stable")[: min(k, len(x) - 1)]
            order = self.walk(margins[q].tolist(), np.inf)
            at = np.empty(self.leaves)
            at[order] = np.cumsum(self.sizes[order])
            seen_at.append(at[place[true]].min(axis=1))
        met = np.concatenate(seen_at) if seen_at else np.zeros(0)
        self.share = float(np.quantile(met, target)) / len(x) if len(met) else float(len(self.roots))


def usable(v: Column) -> Column:
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(v, lambda x: x != 0)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def fit_forest(rows: DataFrame, k: int) -> Forest | None:
    n = rows.count()
    if not n:
        return None
    part = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / n) * (1 << 30)))
    got = part.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).collect() or rows.limit(SAMPLE_ROWS).collect()
    sizes, counts = np.unique([len(r["v"]) for r in got], return_counts=True)
    dim = int(sizes[counts.argmax()])
    x = np.array([r["v"] for r in got if len(r["v"]) == dim], float)
    forest = Forest.fit(x)
    forest.calibrate(x, k, TARGET_RECALL)
    return forest


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found for every row where ``is_query`` (an
    expression over ``vec_id``) holds: ``query_id``, ``rank``, ``vec_id``,
    ``score``."""
    spark = vectors.sparkSession
    out = "query_id long, vec_id long, score double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    forest = fit_forest(rows, k)
    if forest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == forest.dim)
    dim = forest.dim
    shared = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        f = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("v").to_pylist(), float)
            yield {"vec_id": batch.column("vec_id"), "leaves": list(f.place(x)), "x": [r.tobytes() for r in x.astype("<f8")]}

    placed = stage(map_arrow(rows, place, "vec_id long, leaves array<int>, x binary"), "placed")
    # As many rows as the forest has leaves.
    counts = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()
    sizes = np.zeros(forest.leaves, np.int64)
    for r in counts:
        sizes[r["leaf"]] = r["count"]
    total = int(sizes.sum()) // len(forest.roots)
    forest.freeze(sizes)
    # Distinct rows are at least a tree's share of the rows taken.
    budget = max(forest.share * total, len(forest.roots) * (k + 1))
    blocks = np.maximum(-(-sizes // BLOCK_ROWS), 1).tolist()
    queries = placed.filter(is_query)
    splits = max(1, -(-queries.count() // QUERY_ROWS))
    walker = spark.sparkContext.broadcast((forest, budget, blocks))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        f, budget, blocks = walker.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                margins = f.margins(_vectors(batch.column("x"), f.dim))
                ids, x = batch.column("vec_id").to_pylist(), batch.column("x").to_pylist()
                leaf, block, at = [], [], []
                for i in range(len(ids)):
                    for n in f.walk(margins[i].tolist(), budget):
                        for b in range(blocks[n]):
                            leaf.append(n)
                            block.append(b)
                            at.append(i)
                yield {"leaf": leaf, "block": block, "vec_id": [ids[i] for i in at], "x": [x[i] for i in at]}

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = np.array(batch.column("leaves").to_pylist(), np.int64)
            n = np.array(walker.value[2])[leaves]
            h = batch.column("h").to_numpy()
            for t in range(leaves.shape[1]):
                yield {"leaf": leaves[:, t], "block": h % n[:, t], "vec_id": batch.column("vec_id"), "x": batch.column("x")}

    schema = "leaf int, block int, vec_id long, x binary"
    asked = map_arrow(queries.select("vec_id", "x"), visits, schema).withColumn("split", F.pmod(F.xxhash64("vec_id"), F.lit(splits)).cast("int"))
    hashed = placed.withColumn("h", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40)))
    held = map_arrow(hashed, blocked, schema).withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))))
    meet = held.withColumn("query", F.lit(0)).unionByName(asked.withColumn("query", F.lit(1)))
    meet = meet.withColumn("key", F.xxhash64("leaf", "block", "split")).drop("leaf", "block", "split")
    meet = meet.repartition(partitions(spark), "key").sortWithinPartitions("key", "query", "vec_id")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, ids, x = None, [], []
        pending: list[np.ndarray] = []
        waiting = 0

        def best(parts: list[np.ndarray]) -> dict:
            a = np.concatenate(parts)
            a = a[np.lexsort((a["v"], -a["s"], a["q"]))]
            # A row found in several trees has one score.
            new = np.r_[True, (a["q"][1:] != a["q"][:-1]) | (a["v"][1:] != a["v"][:-1])]
            a = a[new]
            first = np.searchsorted(a["q"], a["q"])
            a = a[np.arange(len(a)) - first < k]
            return {"query_id": a["q"], "vec_id": a["v"], "score": a["s"]}

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, kind = batch.column("key").to_numpy(), batch.column("query").to_numpy()
            all_ids, all_x = batch.column("vec_id").to_numpy(), _vectors(batch.column("x"), dim)
            cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (kind[1:] != kind[:-1])]).tolist()
            for a, b in zip(cut, [*cut[1:], len(keys)], strict=True):
                if keys[a] != key:
                    key, ids, x = keys[a], [], []
                if kind[a] == 0:
                    ids.append(all_ids[a:b])
                    x.append(all_x[a:b])
                    continue
                if not ids:
                    continue
                ids, x = [np.concatenate(ids)], [np.concatenate(x)]
                for lo in range(a, b, 512):
                    q = all_ids[lo : min(lo + 512, b)]
                    # einsum: a pair's score does not depend on its neighbours.
                    s = np.einsum("ij,kj->ik", all_x[lo : min(lo + 512, b)], x[0])
                    s[q[:, None] == ids[0][None, :]] = -np.inf
                    n = min(k, s.shape[1])
                    least = np.partition(s, s.shape[1] - n, axis=1)[:, s.shape[1] - n]
                    r, c = np.nonzero((s >= least[:, None]) & (s > -np.inf))
                    got = np.empty(len(r), [("q", "i8"), ("v", "i8"), ("s", "f8")])
                    got["q"], got["v"], got["s"] = q[r], ids[0][c], s[r, c]
                    pending.append(got)
                    waiting += len(got)
                    if waiting > 1_000_000:
                        yield best(pending)
                        pending, waiting = [], 0
        if waiting:
            yield best(pending)

    found = map_arrow(meet, rerank, out).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
