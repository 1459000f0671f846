"""Local alignment (Smith-Waterman) of many pairs of word sequences at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MATCH, MISMATCH, GAP = 2, -1, -1
#: Cells of one row over all pairs that are aligned together.
CELLS = 400_000
_BIG = np.int64(1) << 32


@dataclass
class Alignment:
    """Best local alignment of each pair; bounds are word positions, the end
    exclusive. ``matches`` counts equal words on the path."""

    score: np.ndarray
    matches: np.ndarray
    t_begin: np.ndarray
    t_end: np.ndarray
    d_begin: np.ndarray
    d_end: np.ndarray


def padded(seqs: list[np.ndarray], width: int, fill: int) -> np.ndarray:
    out = np.full((len(seqs), width), fill, np.uint64)
    for i, s in enumerate(seqs):
        out[i, : len(s)] = s
    return out


def _align(t: np.ndarray, d: np.ndarray, band: int | None) -> Alignment:
    """``t`` (p, m) against ``d``: (p, n) for the full matrix, or with a band
    (p, m + 2 * band), where word i of ``t`` meets words i to i + 2 * band."""
    p, m = t.shape
    n = d.shape[1] if band is None else 2 * band + 1
    cols = np.arange(n, dtype=np.int64)
    h = np.zeros((p, n), np.int64)
    matches, t_from, d_from = (np.zeros((p, n), np.int64) for _ in range(3))
    best = Alignment(*(np.zeros(p, np.int64) for _ in range(6)))
    rows = np.arange(p)

    def moved(a: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(a)
        if by > 0:
            out[:, by:] = a[:, :-by]
        else:
            out[:, :by] = a[:, -by:]
        return out

    for i in range(m):
        at = 0 if band is None else i
        eq = t[:, i, None] == d[:, at : at + n]
        diag, up = ((h, matches, t_from, d_from) for _ in range(2))
        if band is None:
            diag = tuple(moved(a, 1) for a in diag)
        else:
            up = tuple(moved(a, -1) for a in up)
        fresh = diag[0] <= 0
        from_diag = diag[0] + np.where(eq, MATCH, MISMATCH)
        from_up = np.where(up[0] > 0, up[0] + GAP, 0)
        use_up = from_up > from_diag
        score = np.maximum(np.maximum(from_diag, from_up), 0)
        matches = np.where(use_up, up[1], np.where(fresh, 0, diag[1]) + eq)
        t_from = np.where(use_up, up[2], np.where(fresh, i, diag[2]))
        d_from = np.where(use_up, up[3], np.where(fresh, cols + at, diag[3]))
        # Gaps in t: the best cell to the left, each step at the gap's cost.
        key = np.maximum.accumulate((score - GAP * cols) * _BIG + cols, axis=1)
        src = key % _BIG
        left = key // _BIG + GAP * cols
        h = np.maximum(left, 0)
        gap = src != cols
        if gap.any():
            matches, t_from, d_from = (np.where(gap, np.take_along_axis(a, src, 1), a) for a in (matches, t_from, d_from))
        j = h.argmax(axis=1)
        top = h[rows, j]
        better = top > best.score
        if better.any():
            best.score = np.where(better, top, best.score)
            best.matches = np.where(better, matches[rows, j], best.matches)
            best.t_begin = np.where(better, t_from[rows, j], best.t_begin)
            best.d_begin = np.where(better, d_from[rows, j], best.d_begin)
            best.t_end = np.where(better, i + 1, best.t_end)
            best.d_end = np.where(better, j + at + 1, best.d_end)
    return best


def _scores(t: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The scores of ``_align`` without a band, and nothing else."""
    n = d.shape[1]
    cols = np.arange(n, dtype=np.int32) * np.int32(-GAP)
    h = np.zeros((len(t), n + 1), np.int32)  # one cell to the left of the first word
    best = np.zeros(h.shape, np.int32)
    for i in range(t.shape[1]):
        score = h[:, :-1] + np.where(t[:, i, None] == d, np.int32(MATCH), np.int32(MISMATCH))
        np.maximum(score, h[:, 1:] + np.int32(GAP), out=score)
        np.maximum(score, 0, out=score)
        score += cols
        np.maximum.accumulate(score, axis=1, out=score)
        score -= cols
        h[:, 1:] = score
        np.maximum(best, h, out=best)
    return best.max(axis=1).astype(np.int64)


def align_pairs(ts: list[np.ndarray], ds: list[np.ndarray], band: int | None = None) -> Alignment:
    """Best local alignment of each ``ts[k]`` with ``ds[k]`` (hashes). Pairs of
    similar size run together, so padding and memory stay small. With a band,
    ``ds[k]`` begins ``band`` words before where word 0 of ``ts[k]`` is expected."""
    out = Alignment(*(np.zeros(len(ts), np.int64) for _ in range(6)))
    for some, t, d in _batches(ts, ds, band):
        got = _align(t, d, band)
        for name in out.__dataclass_fields__:
            getattr(out, name)[some] = getattr(got, name)
    return out


def score_pairs(ts: list[np.ndarray], ds: list[np.ndarray]) -> np.ndarray:
    """The scores of ``align_pairs`` alone, several times as fast."""
    out = np.zeros(len(ts), np.int64)
    for some, t, d in _batches(ts, ds, None):
        out[some] = _scores(t, d)
    return out


def _batches(ts: list[np.ndarray], ds: list[np.ndarray], band: int | None) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Pairs of similar size, padded: (which pairs, their ts, their ds)."""
    order = np.lexsort(([len(x) for x in ds], [len(x) for x in ts])).tolist() if ts else []
    lo = 0
    while lo < len(order):
        hi, m, n = lo, 0, 0
        while hi < len(order):
            m, n = max(m, len(ts[order[hi]])), max(n, len(ds[order[hi]]))
            width = n if band is None else 2 * band + 1
            if hi > lo and (hi + 1 - lo) * width > CELLS:
                break
            hi += 1
        some = order[lo:hi]
        m = max(len(ts[k]) for k in some)
        n = max(len(ds[k]) for k in some) if band is None else m + 2 * band
        # Paddings that equal no word and not each other.
        t = padded([ts[k] for k in some], m, 0)
        yield some, t, padded([ds[k][:n] for k in some], max(n, 1), 1)
        lo = hi
