"""Words of many whole texts at once, as flat numpy arrays.

A word is a maximal run of letters and digits (Unicode ``isalnum``), lower
case. Its 64-bit hash depends on its characters alone, so words and word
n-grams compare equal across tasks, runs and machines.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

_GAMMA = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def word_table() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        np.cumprod(np.full(n - 1, _GAMMA), out=out[1:])
    return out


def lower(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join((c.lower() or c)[0] for c in text)


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a line break after each, and where each text
    begins (one entry more than texts)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    flat = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    return flat[: starts[-1]], starts


@dataclass
class Words:
    hash: np.ndarray  # of each word
    begin: np.ndarray  # character positions within the word's own text
    end: np.ndarray
    first: np.ndarray  # index of each text's first word; one entry more than texts

    def of(self, doc: int) -> slice:
        return slice(self.first[doc], self.first[doc + 1])

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(texts: list[str]) -> Words:
    flat, starts = codes([lower(t) for t in texts])
    is_word = word_table()[flat]
    edge = np.diff(np.concatenate([[False], is_word, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.searchsorted(begin, starts)
    if not len(begin):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, first)
    chars = np.flatnonzero(is_word)
    size = end - begin
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    nth = np.arange(len(chars)) - np.repeat(at, size)
    with np.errstate(over="ignore"):
        value = mix(flat[chars].astype(np.uint64)) * _powers(1 << int(size.max()).bit_length())[nth]
        h = mix(np.add.reduceat(value, at))
    base = np.repeat(starts[:-1], np.diff(first))
    return Words(h, begin - base, end - base, first)


def ngrams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words that stay in one text, and the index
    of the first word of each."""
    total = len(w.hash)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        h = np.zeros(total - n + 1, np.uint64)
        for i in range(n):
            h = h * _GAMMA + mix(w.hash[i : total - n + 1 + i] + np.uint64(i + 1))
        h = mix(h)
    room = np.repeat(w.first[1:], np.diff(w.first))[: total - n + 1]
    at = np.flatnonzero(np.arange(total - n + 1) + n <= room)
    return h[at], at
