"""Alignment of two tokenizers' ids over the same texts (operator 11).

Both tokenizers run over whole texts first. A byte offset where a token of
each ends and the next token of each begins with a space is an anchor; anchors
cut a text into windows of token ids. A window's alignment (groups between
shared ends, links between overlapping tokens) depends on its two id tuples
alone, so it is computed once for all windows of a chunk with the same tuples.

The count of an id pair is how many documents hold it linked, over the whole
corpus. Documents are gathered in chunks (slices of whole texts): a chunk sends
each of its distinct pairs once, with the number of its documents, to the sum
over the corpus, and takes the sums back for those pairs. So what is shuffled
grows with distinct pairs per chunk, not with tokens, and no table of all
pairs is held anywhere. A very long text is a chunk of its own.

Defined results: texts that are null or empty, or whose tokens do not spell
the text with a space before it (byte for byte, in either tokenizer), have no
tokens: zeros and an empty ``groups_sha256``. Repeated rows and null ids are
documents of their own; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import id_type, ids_and_text, kept_in_worker, map_arrow, record_batch, ship, stage, text_slices
from strata.llm.tokenids import BARE, BREAK, BYTE_LETTERS, MARKS, PieceEncoder, Recent, SplitEncoder, default_tokenizer, id_bytes

#: Bytes of whole texts in a chunk (a longer text is one of its own).
CHUNK_CHARS = 2_000_000
#: Pieces kept by a worker for each tokenizer, in each of two generations.
CACHE_PIECES = 100_000
#: Pairs in a row of the staged table.
PAIRS_A_ROW = 32_768
_B_IDS = 1 << 31
_SPACE = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class SentenceEncoder(SplitEncoder):
    """A sentencepiece model on texts with a space before them (its own).

    Merges never join two characters that no vocabulary entry has side by
    side, so texts are cut only at places that the vocabulary shows to be
    such; a model with other entries is given whole texts."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()) if not (self.sp.is_byte(i) or self.sp.is_control(i))]
        self.cut = not any(_SPACE in e.lstrip(_SPACE) for e in entries)
        line = self.sp.encode("\n")
        breaks = self.cut and not any("\n" in e for e in entries) and len(line) == 2
        joined = {b for e in entries for a, b in zip(e, e[1:], strict=False) if a.isalpha()}
        super().__init__("".join(m for m in MARKS if m not in joined) if breaks else "", breaks, [])

    def whole(self, text: str) -> bytes:
        return id_bytes(self.sp.encode(text[1:], num_threads=1))

    def odd(self, pieces: list[str]) -> np.ndarray:
        return np.array([not p for p in pieces], bool) if self.cut else np.ones(len(pieces), bool)

    def learn(self, pieces: list[str]) -> list[bytes]:
        # A line break before a bare piece keeps the model's own space off it.
        texts = ["\n" if p == BREAK else "\n" + p[1:] if p[0] == BARE else p for p in pieces]
        found = self.sp.encode(texts, num_threads=1)
        return [
            id_bytes(ids[1:] if p == BREAK else ids[2:] if p[0] == BARE else ids)
            for p, ids in zip(pieces, found, strict=True)
        ]


class Spelling:
    """Bytes of every id of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.spaced = np.array([e[:1] == b" " for e in entries], bool)

    def spell(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        where = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        where += np.arange(len(where))
        return self.data[where].tobytes()


def byte_level_spelling(encoder: PieceEncoder) -> Spelling:
    byte_of = {letter: b for b, letter in BYTE_LETTERS.items()}
    names = [encoder.tok.id_to_token(i) or "" for i in range(encoder.tok.get_vocab_size())]
    return Spelling([bytes(byte_of.get(c, 0) for c in n) for n in names])


def sentence_spelling(encoder: SentenceEncoder) -> Spelling:
    sp = encoder.sp
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return Spelling(
        [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace(_SPACE, " ").encode() for i, n in enumerate(names)]
    )


class Spelled:
    """Alignments of windows, all of them at once: arrays over their links,
    and the groups of each as text (every group ended by a semicolon)."""

    def __init__(self, a: np.ndarray, b: np.ndarray, first_a: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, names: pa.Array):
        end_a, end_b = np.cumsum(size_a[a]), np.cumsum(size_b[b])
        mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] |= 2
        # Between two ends of either lies one overlap of two tokens.
        ends = np.flatnonzero(mark)
        at_a = np.searchsorted(end_a, ends)
        self.links = a[at_a].astype(np.int64) << 32 | b[np.searchsorted(end_b, ends)]
        #: Per window: links and groups up to its end.
        last = np.r_[first_a[1:], len(a)] - 1
        self.link_ends = np.searchsorted(ends, end_a[last], "right")
        shared_a, shared_b = mark[end_a] == 3, mark[end_b] == 3
        self.group_ends = np.cumsum(shared_a)[last]
        # Text: a group's tokens of the first, then of the second tokenizer.
        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        n_a, n_b = np.bincount(group_a), np.bincount(group_b)
        before_a, before_b = np.cumsum(n_a), np.cumsum(n_b) - n_b
        which = np.empty(len(a) + len(b), np.int64)
        which[np.arange(len(a)) + before_b[group_a]] = 2 * a.astype(np.int64) + shared_a
        which[np.arange(len(b)) + before_a[group_b]] = 2 * (len(size_a) + b.astype(np.int64)) + shared_b
        words = names.take(pa.array(which))
        stops = np.frombuffer(words.buffers()[1], np.int64, len(which) + 1)
        tokens = (before_a[self.group_ends - 1] + np.cumsum(n_b)[self.group_ends - 1]).astype(np.int64)
        starts = pa.py_buffer(np.r_[0, stops[tokens]].astype(np.int64))
        self.text = pa.Array.from_buffers(pa.large_binary(), len(last), [None, starts, words.buffers()[2]])


class Aligner:
    """Both tokenizers and the spelling of their ids, one per worker."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PieceEncoder(path_a, plain=True), SentenceEncoder(path_b)
        self.a.pieces, self.b.pieces = Recent(CACHE_PIECES), Recent(CACHE_PIECES)
        self.spell_a, self.spell_b = byte_level_spelling(self.a), sentence_spelling(self.b)
        n_a, n_b = len(self.spell_a.size), len(self.spell_b.size)
        names = [f"{i}{c}".encode() for n, marks in ((n_a, ",|"), (n_b, ",;")) for i in range(n) for c in marks]
        self.names = pa.array(names, pa.large_binary())

    def chunk(self, texts: list[str]) -> tuple[dict, dict]:
        """Of whole texts: what each of them holds, and what they share.

        Of texts: n_a, n_b, n_groups, n_links, groups_sha256, and the distinct
        windows with how often they occur. Shared: distinct ``pairs``, the
        number of texts holding each, and of each window its links (indices
        into ``pairs``), ended by ``ends``."""
        n = len(texts)
        source = [" " + t for t in texts]
        raw = [s.encode() for s in source]
        ids_a, count_a = self.a.encode_flat(source)
        ids_b, count_b = self.b.encode_flat(source)
        good = self._spelled(raw, ids_a, count_a, self.spell_a) & self._spelled(raw, ids_b, count_b, self.spell_b)
        good &= np.array([len(r) > 1 for r in raw], bool)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, count_a)], ids_b[np.repeat(good, count_b)]
            count_a, count_b = count_a * good, count_b * good
        doc_end = np.cumsum(np.array(list(map(len, raw)), np.int64) * good)
        del source, raw
        if not len(ids_a):
            zero = np.zeros(n, np.int64)
            empty = [[] for _ in range(n)]
            own = {"n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero, "groups_sha256": [""] * n, "windows": empty, "times": empty}
            return own, {"pairs": np.zeros(0, np.int64), "docs": np.zeros(0, np.int64), "links": np.zeros(0, np.int32), "ends": np.zeros(0, np.int64)}

        # Anchors: ends of a token of each, before a space-marked one of each.
        end_a, end_b = np.cumsum(self.spell_a.size[ids_a]), np.cumsum(self.spell_b.size[ids_b])
        mark = np.zeros(int(doc_end[-1]) + 1, np.uint8)
        mark[end_a[np.r_[self.spell_a.spaced[ids_a[1:]], True]]] = 1
        mark[end_b[np.r_[self.spell_b.spaced[ids_b[1:]], True]]] |= 2
        cut_a, cut_b = np.flatnonzero(mark[end_a] == 3) + 1, np.flatnonzero(mark[end_b] == 3) + 1
        doc = np.searchsorted(doc_end, end_a[cut_a - 1])
        del end_a, end_b, mark
        # A window's key: its ids of the first, then of the second tokenizer.
        # Equal windows are aligned once.
        per_a, per_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        both = np.empty(len(ids_a) + len(ids_b), np.uint32)
        both[np.arange(len(ids_a)) + np.repeat(cut_b - per_b, per_a)] = ids_a
        both[np.arange(len(ids_b)) + np.repeat(cut_a, per_b)] = ids_b + np.uint32(_B_IDS)
        offsets = np.r_[0, 4 * (cut_a + cut_b)].astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(both)]).dictionary_encode()
        window, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        del both, offsets, coded, ids_a, ids_b
        n_windows = len(distinct)
        ids = np.frombuffer(distinct.buffers()[2], np.uint32)
        starts = np.frombuffer(distinct.buffers()[1], np.int64, n_windows + 1) // 4
        ids = ids[: starts[-1]]
        second = ids >= _B_IDS
        first_a = starts[:-1] - np.r_[0, np.cumsum(second)][starts[:-1]]
        known = Spelled(ids[~second], ids[second] - np.uint32(_B_IDS), first_a, self.spell_a.size, self.spell_b.size, self.names)
        n_links = np.diff(known.link_ends, prepend=0)
        groups = np.diff(known.group_ends, prepend=0)
        pairs, links = np.unique(known.links, return_inverse=True)

        text = known.text.take(pa.array(window))
        stops = np.frombuffer(text.buffers()[1], np.int64, len(window) + 1)
        spelled = memoryview(text.buffers()[2])
        first = np.searchsorted(doc, np.arange(n + 1))
        bounds = stops[first].tolist()
        hashes = [hashlib.sha256(spelled[a : b - 1]).hexdigest() if ok else "" for ok, a, b in zip(good.tolist(), bounds, bounds[1:], strict=False)]
        del text, stops, spelled
        # Distinct windows of each text, then its distinct pairs.
        cell, times = np.unique(doc * n_windows + window, return_counts=True)
        doc_of, window_of = cell // n_windows, cell % n_windows
        at = np.searchsorted(doc_of, np.arange(1, n))
        own = {
            "n_a": count_a,
            "n_b": count_b,
            "n_groups": np.bincount(doc, groups[window], n).astype(np.int64),
            "n_links": np.bincount(doc, n_links[window], n).astype(np.int64),
            "groups_sha256": hashes,
            "windows": np.split(window_of.astype(np.int32), at),
            "times": np.split(times.astype(np.int32), at),
        }
        size = n_links[window_of]
        where = np.repeat(known.link_ends[window_of] - n_links[window_of] - (np.cumsum(size) - size), size)
        where += np.arange(len(where))
        held = np.unique(np.repeat(doc_of, size) * len(pairs) + links[where]) % len(pairs)
        docs = np.bincount(held, minlength=len(pairs))
        return own, {"pairs": pairs, "docs": docs, "links": links.astype(np.int32), "ends": known.link_ends}

    @staticmethod
    def _spelled(raw: list[bytes], ids: np.ndarray, counts: np.ndarray, spelling: Spelling) -> np.ndarray:
        """Which texts their ids spell."""
        spelled = spelling.spell(ids)
        sizes = np.diff(np.r_[0, np.cumsum(spelling.size[ids])][np.r_[0, np.cumsum(counts)]])
        want = np.array(list(map(len, raw)), np.int64)
        if (sizes == want).all() and spelled == b"".join(raw):
            return np.ones(len(raw), bool)
        stop = np.cumsum(sizes).tolist()
        return np.array([spelled[e - s : e] == r for s, e, r in zip(sizes.tolist(), stop, raw, strict=True)], bool)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


#: What workers keep under this name.
ALIGNER = "aligner"
kept_in_worker(ALIGNER, aligner.cache_clear)


def _chunks(docs: DataFrame, path_a: str, path_b: str, kind: str) -> DataFrame:
    """Rows of documents (windows set), of a chunk's windows (links set) and
    of its pairs (pairs set), under the chunk's number."""
    empty = {"doc_id": None, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": None}
    lists = ("windows", "times", "links", "ends", "pairs", "docs")

    def rows(n: int, **columns) -> dict:
        out = {c: [v] * n for c, v in empty.items()} | {c: [None] * n for c in lists} | {"base": [0] * n}
        return out | columns

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        work = aligner(path_a, path_b)
        for batch in batches:
            for lo, hi, texts in text_slices(batch, "text", CHUNK_CHARS):
                own, shared = work.chunk(texts)
                yield rows(hi - lo, chunk=[chunk] * (hi - lo), doc_id=batch.column("doc_id").slice(lo, hi - lo), **own)
                yield rows(1, chunk=[chunk], links=[shared["links"]], ends=[shared["ends"]])
                for at in range(0, len(shared["pairs"]), PAIRS_A_ROW):
                    part = slice(at, at + PAIRS_A_ROW)
                    yield rows(1, chunk=[chunk], base=[at], pairs=[shared["pairs"][part]], docs=[shared["docs"][part]])
                chunk += 1

    schema = (
        f"chunk long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "windows array<int>, times array<int>, links array<int>, ends array<int>, base int, pairs array<long>, docs array<int>"
    )
    return map_arrow(docs, read, schema, uses=ALIGNER)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    return total[ends] - total[np.r_[0, ends[:-1]]] if len(ends) else np.zeros(0, np.int64)


def align_tokenizers(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    spark = docs.sparkSession
    path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
    kind = id_type(docs, id_col)
    chunks = stage(_chunks(ids_and_text(docs, id_col, text_col), path_a, path_b, kind), "token-windows")

    zipped = F.posexplode(F.arrays_zip("pairs", "docs"))
    held = chunks.filter(F.col("pairs").isNotNull()).select("chunk", "base", zipped.alias("pos", "p"))
    held = held.select("chunk", (F.col("base") + F.col("pos")).alias("pos"), F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.shiftright("pair", 32))
    highest = F.max("n").over(Window.partitionBy("a"))
    counts = counts.select("pair", "n", (F.col("n") == highest).alias("best"))
    looked_up = held.drop("docs").join(counts, "pair").select("chunk", "pos", "n", "best")

    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    own = chunks.filter(F.col("pairs").isNull()).drop("base", "pairs", "docs").withColumnRenamed("chunk", "of")
    out_schema = _arrow_schema(schema)

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        pos = right.column("pos").to_numpy()
        n, best = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
        n[pos], best[pos] = right.column("n").to_numpy(), right.column("best").to_numpy()
        of_chunk = left.filter(pc.is_valid(left.column("links")))
        left = left.filter(pc.is_null(left.column("links"))).combine_chunks()
        links = of_chunk.column("links").combine_chunks().flatten().to_numpy()
        ends = of_chunk.column("ends").combine_chunks().flatten().to_numpy().astype(np.int64)
        of_window = _sums(n[links], ends), _sums(best[links], ends)
        windows = left.column("windows").combine_chunks()
        window, times = windows.flatten().to_numpy(), left.column("times").combine_chunks().flatten().to_numpy()
        stop = np.cumsum(windows.value_lengths().to_numpy().astype(np.int64))
        cols = {c: left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        cols |= {"count_sum": _sums(of_window[0][window] * times, stop), "n_best": _sums(of_window[1][window] * times, stop)}
        return pa.Table.from_batches([record_batch(cols, out_schema)])

    ship(spark)
    return own.groupBy("of").cogroup(looked_up.groupBy("chunk")).applyInArrow(add_up, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return align_tokenizers(table(spark, sf_dir, "documents"))
