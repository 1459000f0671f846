"""Token ids of whole texts with a public ``tokenizers`` file.

Text is cut at single spaces after a non-space, between a letter and a mark,
and around a line break between them. A byte-level pre-tokenizer never joins
characters across such places, so the ids of a text are the ids of its pieces
in order. Arrow cuts a slice of texts and finds its distinct pieces; each of
them is looked up once, and all ids are gathered by numpy. A word is learned
once, whatever marks follow it. What a worker keeps is bounded: of two
generations of entries the older is dropped when the younger is full, and
entries used again move to the younger.

Texts with a white-space character before a space, a space at the end, the
string of an added token, or the characters that mark cuts here go to the
tokenizer whole.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from strata.llm.common import kept_in_worker, text_ranges

#: Entries of a generation of a worker's cache.
CACHE_PIECES = 200_000
#: Pieces of more characters are not kept.
CACHE_PIECE_CHARS = 64
#: Fixed value: the byte-level pre-tokenizer's pattern.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Characters of a slice of texts that is encoded at a time.
SLICE_CHARS = 4_000_000
#: Before a piece that follows no space, and for a line break on its own.
BARE, BREAK = "\x01", "\x02"
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: ASCII marks but the apostrophe, which begins pre-tokens with letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Beyond these characters Unicode versions may differ on what a letter is.
_UNSETTLED = regex.compile(r"[^\x00-\u024f]")
#: What workers keep under this name: the encoders.
ENCODERS = "encoders"
_ENCODERS: dict[str, PieceEncoder] = {}
kept_in_worker(ENCODERS, _ENCODERS.clear)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary:
    printable characters for themselves, the rest in order from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = byte_letters()


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def id_bytes(ids: Iterable[int]) -> bytes:
    return array("I", ids).tobytes()


def _large(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


class Recent:
    """A bounded cache: two generations, entries in use stay."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get_all(self, keys: list[str]) -> list[bytes | None]:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        if old:
            again = [i for i, v in enumerate(found) if v is None and keys[i] in old]
            for i in again:
                found[i] = young[keys[i]] = old[keys[i]]
        return found

    def put_all(self, keys: list[str], values: list[bytes]) -> None:
        self.young.update([kv for kv in zip(keys, values, strict=True) if len(kv[0]) <= CACHE_PIECE_CHARS])


class SplitEncoder:
    """Ids of texts from the ids of their pieces.

    ``marks`` are the characters before which a word may be cut, ``breaks``
    says whether line breaks may be. A subclass encodes pieces (``learn``) and
    texts that cannot be cut (``whole``, those with a piece that ``odd``)."""

    def __init__(self, marks: str, breaks: bool, added: list[str]):
        self.added = added
        self.pieces = Recent(CACHE_PIECES)
        either = _LETTER + regex.escape(MARKS, special_only=False)
        self.rules = []
        if marks:
            self.rules.append((f"([{_LETTER}])([{regex.escape(marks, special_only=False)}])", f"\\1 {BARE}\\2"))
        if breaks:
            self.rules.append((f"([{either}])\n([{either}])", f"\\1 {BREAK} {BARE}\\2"))

    def learn(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def odd(self, pieces: list[str]) -> np.ndarray:
        raise NotImplementedError

    def whole(self, text: str) -> bytes:
        raise NotImplementedError

    def _known(self, keys: list[str]) -> list[bytes]:
        found = self.pieces.get_all(keys)
        missing = [i for i, v in enumerate(found) if v is None]
        if missing:
            new = [keys[i] for i in missing]
            values = self.learn(new)
            self.pieces.put_all(new, values)
            for i, v in zip(missing, values, strict=True):
                found[i] = v
        return found

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each of them has."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        source = pa.array(texts, pa.large_string())
        uncut = np.zeros(len(texts), bool)
        for a in (BARE, BREAK, *self.added):
            uncut |= pc.match_substring(source, a).to_numpy(zero_copy_only=False)
        if uncut.any():
            source = pc.if_else(pa.array(uncut), _large(""), source)
        source = pc.binary_join_element_wise(_large(BARE), source, _large(""))
        for pattern, replacement in self.rules:
            source = pc.replace_substring_regex(source, pattern=pattern, replacement=replacement)
        cut = pc.split_pattern(source, " ")
        offsets = cut.offsets.to_numpy()
        coded = cut.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        first = offsets[:-1]

        odd = self.odd(words)
        even = np.flatnonzero(~odd)
        place = np.zeros(len(words), np.int64)
        place[even] = np.arange(len(even)) + 1
        entries = [b"", *self._known([words[i] for i in even.tolist()] if odd.any() else words)]
        at = place[code]
        if odd.any():
            uncut |= np.add.reduceat(odd[code], first, dtype=np.int64) > 0
        for i in np.flatnonzero(uncut).tolist():
            at[offsets[i] : offsets[i + 1]] = 0
            at[offsets[i]] = len(entries)
            entries.append(self.whole(texts[i]))

        size = np.array(list(map(len, entries)), np.int64) // 4
        start = np.cumsum(size) - size
        count = size[at]
        where = np.repeat(start[at] - (np.cumsum(count) - count), count)
        where += np.arange(len(where))
        ids = np.frombuffer(b"".join(entries), np.uint32)[where]
        return ids, np.add.reduceat(count, first)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for lo, hi in text_ranges(texts, SLICE_CHARS):
            ids, counts = self.encode_flat(texts[lo:hi])
            raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            out += [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out


class PieceEncoder(SplitEncoder):
    """A byte-level tokenizer. ``plain``: the strings of added tokens are
    ordinary text."""

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        self.packed = [id_bytes([i]) for i in range(self.tok.get_vocab_size())]
        super().__init__(MARKS, True, [] if plain else [t.content for t in self.tok.get_added_tokens_decoder().values()])

    def whole(self, text: str) -> bytes:
        return id_bytes(self.tok.encode(text, add_special_tokens=False).ids)

    def odd(self, pieces: list[str]) -> np.ndarray:
        return np.array([not p or p[-1].isspace() for p in pieces], bool)

    def learn(self, pieces: list[str]) -> list[bytes]:
        texts = ["\n" if p == BREAK else p[1:] if p[0] == BARE else " " + p for p in pieces]
        settled = not _UNSETTLED.search("".join(texts))
        find, merge, letters, packed = PRE_TOKENS.findall, self.tok.model.tokenize, BYTE_LETTERS, self.packed
        space, out = letters[ord(" ")], []
        for p, t in zip(pieces, texts, strict=True):
            if p.isascii() and p.isalpha():  # one pre-token, its letters stand for themselves
                out.append(b"".join([packed[x.id] for x in merge(space + p)]))
            elif settled or not _UNSETTLED.search(t):
                bytes_of = [c.encode().decode("latin-1").translate(letters) for c in find(t)]
                out.append(b"".join([packed[x.id] for c in bytes_of for x in merge(c)]))
            else:
                out.append(self.whole(t))
        return out


def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
