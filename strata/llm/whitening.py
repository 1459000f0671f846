"""Whitening of embeddings by Jacobi-Davidson (operator 13).

The covariance of all vectors is never formed. A product of it with a block of
directions is one Spark job: each task centres its own rows, multiplies them
by the block and adds up ``centred' (centred block)``; the tasks' parts are
summed by a shuffle on the dimension. Only blocks of ``dimensions x BLOCK``
numbers reach the driver, whatever the number of rows.

On the driver, a search space holds Ritz pairs (Rayleigh-Ritz). For the
leading pairs that have not converged, the projected correction equation
``(I - QQ')(V - theta I)(I - QQ') t = -residual`` is solved roughly by a few
MINRES steps, all pairs in step, so one job serves a whole block. Pairs whose
residual is of double precision are locked and projected out; the search ends
when the wanted number is locked and no Ritz value left is larger.

Entries become whole numbers first (see :func:`whole_vectors`), so sums and
deviations are exact and centring is done before anything is rounded.

Defined results: vectors that are null, hold a null or non-finite entry or one
beyond 2**56, or whose length is not the commonest (of equals the longer), take
no part; repeated rows and null ids are rows like any other; components
without variance (eigenvalue of rounding size) are left out, so equal vectors,
one row or an empty table give no row; a deviation beyond 63 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import id_type, map_arrow, stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Pairs corrected at a time, and MINRES steps for a correction at most.
BLOCK = 16
INNER_STEPS = 6
#: The search space is cut back to its best Ritz vectors beyond this many blocks.
SPACE_BLOCKS = 6
MAX_OUTER = 200
_EPS = float(np.finfo(float).eps)
Product = Callable[[np.ndarray], np.ndarray]


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): entries as ``floor(SCALE * entry) + OFFSET``, usable rows only."""
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda c: c * SCALE)
    kept = vectors.select(F.col(id_col).alias("vec_id"), scaled.alias("s")).filter(
        F.col("s").isNotNull() & F.forall("s", lambda c: F.coalesce(F.abs(c) < 2.0**62, F.lit(False)))
    )
    x = F.transform("s", lambda c: F.floor(c) + OFFSET)
    return kept.select("vec_id", x.alias("x"))


@dataclass(frozen=True)
class Fit:
    """Centre of the fit list and its leading covariance eigenpairs."""

    n: int
    base: np.ndarray  # whole part of the mean, long
    rest: np.ndarray  # sum - n * base, long, in [0, n)
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # dimensions x components
    trace: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sum, exactly: longs, or Python integers where they may not fit."""
        d = x - self.base
        if len(d) and int(np.abs(d).max()) >= 2**62 // self.n:
            d = d.astype(object)
        return d * self.n - self.rest

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n


def _rows(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sums(x: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows, and the exact sum of each dimension less OFFSET a row."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, total = 0, [0] * dim
        for batch in batches:
            if batch.num_rows:
                rows = _rows(batch, dim) - OFFSET
                if int(np.abs(rows).max()) >= 2**62 // len(rows):
                    rows = rows.astype(object)
                n += len(rows)
                total = [a + int(b) for a, b in zip(total, rows.sum(axis=0).tolist(), strict=True)]
        if n:
            yield {"pos": np.arange(dim, dtype=np.int32), "n": np.full(dim, n), "s": [Decimal(t) for t in total]}

    parts = map_arrow(x.select("x"), partial, "pos int, n long, s decimal(38,0)")
    got = {r["pos"]: r for r in parts.groupBy("pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    return (got[0]["n"], [int(got[i]["s"]) for i in range(dim)]) if got else (0, [])


def _summed(x: DataFrame, rows_of: Callable[[np.ndarray], np.ndarray], dim: int, shape: tuple[int, int]) -> np.ndarray:
    """Sum over all row blocks of the matrix that ``rows_of`` makes of each."""
    height, width = shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += rows_of(_rows(batch, dim))
        yield {"pos": np.arange(height, dtype=np.int32), "y": list(total)}

    parts = map_arrow(x.select("x"), partial, "pos int, y array<double>")
    sums = parts.groupBy("pos").agg(*[F.sum(F.col("y")[i]).alias(f"y{i}") for i in range(width)])
    out = np.zeros(shape)
    for r in sums.collect():
        out[r["pos"]] = r[1:]
    return out


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns of ``t`` add to the others."""
    kept = np.zeros((t.shape[0], 0))
    for column in t.T:
        size = np.linalg.norm(column)
        if not size or not np.isfinite(size):
            continue
        c = column / size
        for _ in range(3):
            before = np.linalg.norm(c)
            for q in (*against, kept):
                c = c - q @ (q.T @ c)
            size = np.linalg.norm(c)
            if size < 1e-10 * before:
                break
            c /= size
        else:
            kept = np.column_stack([kept, c])
    return kept


def minres(apply: Product, b: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """MINRES on every column of ``b`` in step, from zero: ``apply`` takes all
    columns at once. Ends when every residual fell to ``tol`` of its start."""
    x, w, w2, r1 = (np.zeros_like(b) for _ in range(4))
    r2, y = b.copy(), b.copy()
    first = beta = np.linalg.norm(b, axis=0)
    phibar, old, dbar, epsln = first.copy(), np.zeros_like(first), np.zeros_like(first), np.zeros_like(first)
    cs, sn = -np.ones_like(first), np.zeros_like(first)
    going = first > 0
    for step in range(steps):
        safe = np.where(going, beta, 1.0)
        v = np.where(going, y / safe, 0.0)
        y = apply(v)
        if step:
            y = y - np.where(going, beta / np.where(old > 0, old, 1.0), 0.0) * r1
        alfa = (v * y).sum(axis=0)
        y = y - alfa / safe * r2
        r1, r2, old = r2, y, beta
        beta = np.linalg.norm(y, axis=0)
        oldeps, delta, gbar = epsln, cs * dbar + sn * alfa, sn * dbar - cs * alfa
        epsln, dbar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), _EPS * np.maximum(np.abs(alfa), 1e-300))
        cs, sn = gbar / gamma, beta / gamma
        phi, phibar = cs * phibar, sn * phibar
        w1, w2 = w2, w
        w = (v - oldeps * w1 - delta * w2) / gamma
        x = x + np.where(going, phi * w, 0.0)
        going &= (beta > _EPS * first) & (np.abs(phibar) > tol * first)
        if not going.any():
            break
    return x


def jacobi_davidson(product: Product, dim: int, wanted: int, block: int = BLOCK, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs of a symmetric non-negative operator
    known only by its products with blocks of at most ``block`` columns (the
    first product has twice as many)."""
    rng = np.random.default_rng(seed)
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    space = _orthonormal(rng.standard_normal((dim, min(dim, 2 * block))))
    image = product(space)
    scale = 0.0

    def grow(t: np.ndarray) -> None:
        nonlocal space, image
        new = _orthonormal(t, locked, space)
        room = dim - locked.shape[1] - space.shape[1]
        if not new.shape[1] and room:  # nothing new in the corrections
            new = _orthonormal(rng.standard_normal((dim, min(room, block))), locked, space)
        if new.shape[1]:
            space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])

    for _ in range(MAX_OUTER):
        # Rayleigh-Ritz, largest first, apart from what is locked.
        inner = space.T @ image
        ritz, s = np.linalg.eigh((inner + inner.T) / 2)
        ritz, s = ritz[::-1], s[:, ::-1]
        space, image = space @ s, image @ s
        scale = max(scale, float(ritz[0]) if len(ritz) else 0.0)
        residual = image - space * ritz
        residual -= locked @ (locked.T @ residual)
        tol = 8 * dim * _EPS * scale
        least = np.sort(values)[-wanted] if len(values) >= wanted else -np.inf
        leading = [i for i in range(len(ritz)) if ritz[i] > least + tol][: max(wanted - len(values), block)]
        done = [i for i in leading if np.linalg.norm(residual[:, i]) <= tol]
        open_ = [i for i in leading if i not in set(done)]
        keep = [i for i in range(len(ritz)) if i not in set(done)]
        if done:
            # The space stays orthogonal to what is locked.
            locked = np.column_stack([locked, space[:, done]])
            values = np.r_[values, ritz[done]]
        if not open_ and len(values) >= wanted:
            break
        theta = ritz[open_[:block]]
        u, r = space[:, open_[:block]], residual[:, open_[:block]]
        space, image = space[:, keep], image[:, keep]
        if space.shape[1] + block > SPACE_BLOCKS * block + wanted:
            best = wanted + 2 * block
            space, image = space[:, :best], image[:, :best]
        if dim == locked.shape[1] + space.shape[1]:
            # The space is everything: its images anew, free of old rounding.
            space = _orthonormal(space, locked)
            image = np.column_stack([product(space[:, i : i + block]) for i in range(0, space.shape[1], block)]) if space.shape[1] else space
            continue
        if not len(theta):
            grow(rng.standard_normal((dim, block)))
            continue
        q = locked

        def project(t: np.ndarray, q: np.ndarray = q, u: np.ndarray = u) -> np.ndarray:
            t = t - q @ (q.T @ t)
            return t - u * (u * t).sum(axis=0)

        def corrected(t: np.ndarray, theta: np.ndarray = theta, project: Callable = project) -> np.ndarray:
            t = project(t)
            return project(product(t) - t * theta)

        grow(minres(corrected, -project(r), INNER_STEPS, 0.05))
    else:
        raise ArithmeticError(f"Jacobi-Davidson: {len(values)} of {wanted} pairs after {MAX_OUTER} steps")
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], locked[:, order]


def fit(x: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Centre and leading components of the staged whole vectors ``x``, all of
    one length. None for a table without variance."""
    first = x.select(F.size("x").alias("d")).limit(1).collect()
    if not first or not first[0]["d"]:
        return None
    dim = first[0]["d"]
    n, total = _sums(x, dim)
    base = np.array([OFFSET + t // n for t in total], np.int64)
    rest = np.array([t % n for t in total], np.int64)
    centre = Fit(n, base, rest, np.zeros(0), np.zeros((dim, 0)), 0.0)

    def squares(rows: np.ndarray) -> np.ndarray:
        return (centre.centred(rows) ** 2).sum(axis=0)[:, None]

    trace = float(_summed(x, squares, dim, (dim, 1)).sum()) / n
    if not trace:
        return None

    def product(block: np.ndarray) -> np.ndarray:
        def times(rows: np.ndarray) -> np.ndarray:
            c = centre.centred(rows)
            return c.T @ (c @ block)

        return _summed(x, times, dim, block.shape) / n

    values, vectors = jacobi_davidson(product, dim, min(components, dim))
    some = values > 64 * dim * _EPS * values[0]
    values, vectors = values[some], vectors[:, some]
    top = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[top, np.arange(vectors.shape[1])])
    return Fit(n, base, rest, values, vectors, trace)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """A row per vector and component: vec_id, component (from 1), n,
    deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    kind = id_type(vectors, id_col)
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = stage(whole_vectors(vectors, id_col, vector_col), "whole-vectors")
    length = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    model = fit(x.filter(F.size("x") == length[0]["d"]), components) if length else None
    if model is None:
        return spark.createDataFrame([], schema)
    dim, k = model.vectors.shape
    x = x.filter(F.size("x") == dim)
    scaled = model.vectors / np.sqrt(model.values)

    def gram(rows: np.ndarray) -> np.ndarray:
        w = model.centred(rows) @ scaled
        return np.vstack([w.T @ w, w.sum(axis=0)])

    sums = _summed(x, gram, dim, (k + 1, k)) / model.n
    error = float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())
    explained = model.values / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                rows = _rows(part, dim)
                d = model.deviations(rows)
                if len(d) and float(np.abs(d).max()) >= (2.0**62 / dim) ** 0.5:
                    d = d.astype(object)
                square = (d * d).sum(axis=1)
                if square.dtype == object:
                    square = np.array([s if s < 2**63 else None for s in square], object)
                m = len(rows)
                yield {
                    "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                    "n": np.full(m * k, model.n),
                    "deviation": np.repeat(square, k),
                    "whitened": (model.centred(rows) @ scaled).reshape(-1),
                    "explained": np.tile(explained, m),
                    "identity_error": np.full(m * k, error),
                }

    return map_arrow(x, project, schema)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return whiten(table(spark, sf_dir, "embeddings"))
