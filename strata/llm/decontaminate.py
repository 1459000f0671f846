"""Benchmark decontamination (operator 1).

One pass finds word pairs of the test items in every document and aligns the
passages that hold enough of them with the item (Smith-Waterman over words), so
edited and paraphrased copies score by how much of the item they still hold.

No passage that can reach the score is missed. Take an alignment of score
``least`` or more with m equal words. Its mismatches and gaps, one point each,
are at most ``2 m - least``, and they lie between m - 1 pairs of successive
equal words; so at least ``ceil(least / 2) - 1`` of these pairs have one of them
or none between them. Such a pair stands one or two words apart on either side:
pairs at both distances are the seeds, and a passage is aligned when it holds
that many near one diagonal. Where that is 0 (items of one or two words),
every word is a seed.

The corpus never moves: items go out to the tasks in blocks of at most
``BLOCK_CHARS`` characters of item text, each block with a pass of its own, so
what is broadcast is bounded whatever the size of the benchmark. Pairs that
many items of a block share are left out where the others of the item suffice:
without k of its words as first words, k fewer hits are asked for.

Defined results: null or empty texts on either side match nothing; rows that
repeat an item or a document each get their own rows; equal scores keep the
passage that begins first; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.align import MATCH, align_pairs, score_pairs
from strata.llm.common import fresh, id_type, ids_and_text, map_texts
from strata.llm.textcore import Words, mix, words

#: A pair that stands more often than this in a block's items is common.
COMMON = 100
#: Seed hits of one slice of texts that are expanded together.
HITS = 2_000_000
#: Share of the item's own alignment score from which a document counts as
#: contaminated.
MIN_SCORE = 0.5
BLOCK_CHARS = 8_000_000


def _seeds(w: Words, apart: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the pairs of words ``apart`` words apart (0: of single words)
    that stay in one text, and the index of the first word of each."""
    if not apart:
        return w.hash, np.arange(len(w.hash))
    at = np.flatnonzero(np.arange(len(w.hash)) + apart < np.repeat(w.first[1:], np.diff(w.first)))
    with np.errstate(over="ignore"):
        return mix(mix(w.hash[at]) + w.hash[at + apart]), at


class Items:
    """A block of items: their words and the sorted index of their seeds."""

    def __init__(self, ids: list, texts: list[str], min_score: float = MIN_SCORE):
        self.ids = ids
        w = words(texts)
        self.words = [w.hash[w.of(i)] for i in range(len(texts))]
        self.size = np.diff(w.first)
        least = np.maximum(np.ceil(MATCH * self.size * min_score - 1e-9).astype(np.int64), 1)
        #: How far from where it is expected, going by one hit, a passage may
        #: begin or end, and hits of one passage may lie apart: no passage has
        #: more gaps.
        self.slack = np.maximum(MATCH * self.size - least, 0)
        needed = (least + 1) // 2 - 1
        single = needed < 1
        h, item, pos, kind = [], [], [], []
        for apart in (0, 1, 2):
            x, at = _seeds(w, apart)
            of = w.doc[at]
            mine = single[of] == (apart == 0)
            h.append(x[mine])
            item.append(of[mine])
            pos.append((at - w.first[of])[mine])
            kind.append(np.full(mine.sum(), apart > 0))
        h, item, pos, kind = map(np.concatenate, (h, item, pos, kind))
        # The commonest first words of each item go, at most half as many as
        # hits are needed.
        _, which, count = np.unique(h, return_inverse=True, return_counts=True)
        place = w.first[item] + pos
        often = np.zeros(len(w.hash), np.int64)
        np.maximum.at(often, place, count[which])
        order = np.lexsort((-often, w.doc))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.repeat(w.first[:-1], self.size)
        gone = (often > COMMON) & (rank < np.maximum(needed, 0)[w.doc] // 2)
        #: Hits that a passage of each item must hold at least.
        self.needed = np.maximum(needed - np.bincount(w.doc[gone], minlength=len(texts)), 1)
        #: For words and for pairs: sorted hashes, and item and position of each.
        self.seeds = {}
        for pairs in (False, True):
            some = np.flatnonzero((kind == pairs) & ~gone[place])
            some = some[np.argsort(h[some], kind="stable")]
            if len(some):
                self.seeds[pairs] = (h[some], item[some], pos[some])

    def hits(self, w: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, word where the item would begin, word of the item) of
        the seeds' hits, for whole texts with about ``HITS`` of them at a time."""
        at, lo, hi, pairs = [], [], [], []
        for apart in (0, 1, 2):
            if (apart > 0) in self.seeds:
                hashes = self.seeds[apart > 0][0]
                h, a = _seeds(w, apart)
                x = np.searchsorted(hashes, h)
                found = np.flatnonzero(hashes[np.minimum(x, len(hashes) - 1)] == h)
                at.append(a[found])
                lo.append(x[found])
                hi.append(np.searchsorted(hashes, h[found], side="right"))
                pairs.append(np.full(len(found), apart > 0))
        if not sum(map(len, at)):
            return
        at, lo, hi, pairs = map(np.concatenate, (at, lo, hi, pairs))
        order = np.argsort(at, kind="stable")
        at, lo, hi, pairs = at[order], lo[order], hi[order], pairs[order]
        doc = np.searchsorted(w.first, at, side="right") - 1
        total = np.cumsum(hi - lo)
        a = 0
        while a < len(at):
            b = np.searchsorted(total, (total[a - 1] if a else 0) + HITS, side="right")
            if b < len(at):  # back to where a text begins, or on to its end
                b = np.searchsorted(doc, doc[b])
                b = b if b > a else np.searchsorted(doc, doc[a], side="right")
            parts = []
            for kind, (_, item, pos) in self.seeds.items():
                mine = a + np.flatnonzero(pairs[a:b] == kind)
                seed, which = _expand(lo[mine], hi[mine])
                parts.append(np.stack([doc[mine][which], item[seed], at[mine][which] - pos[seed], pos[seed]]))
            yield tuple(np.concatenate(parts, axis=1))
            a = b


def _blocks(items: DataFrame, id_col: str, text_col: str, min_score: float) -> Iterator[Items]:
    """Items in blocks of bounded size, by ranges of a hash of the row."""
    rows = ids_and_text(items, id_col, text_col).filter("text is not null")
    total = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = int(total // BLOCK_CHARS) * 2 + 1
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n))
    for i in range(n):
        got = (rows if n == 1 else rows.filter(bucket == i)).orderBy("doc_id", "text").collect()
        if got:
            yield Items([r["doc_id"] for r in got], [r["text"] for r in got], min_score)


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges lo:hi, and the range each one is of."""
    size = hi - lo
    which = np.repeat(np.arange(len(lo)), size)
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[which], which


def _passages(block: Items, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, first word, end word) of the passages that hold as many
    seed hits as their item asks for; such hits whose items would begin at
    nearly the same word share a passage."""
    parts = [np.zeros((4, 0), np.int64)]
    for found in block.hits(w):
        order = np.lexsort(found[2::-1])
        doc, item, begin = (x[order] for x in found[:3])
        slack, more = block.slack[item], block.needed[item] - 1
        if not len(doc):
            continue
        # One number line: those of different texts and items lie too far apart.
        own = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])
        line = own * (np.ptp(begin) + slack.max() + 1) + begin - begin.min()
        last = np.searchsorted(line, line + slack, side="right") - 1
        full = last - np.arange(len(doc)) >= more
        # Every hit within reach of one that has enough of them.
        depth = np.zeros(len(doc) + 1, np.int64)
        np.add.at(depth, np.flatnonzero(full), 1)
        np.add.at(depth, last[full] + 1, -1)
        held = np.cumsum(depth[:-1]) > 0
        doc, item, begin, slack = doc[held], item[held], begin[held], slack[held]
        if not len(doc):
            continue
        new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > slack[1:])]
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(doc)) - 1
        # Each first word of the item counts once, though it be hit more often.
        group, pos = np.cumsum(new) - 1, found[3][order][held]
        once = np.lexsort((pos, group))
        first = np.r_[True, (group[once][1:] != group[once][:-1]) | (pos[once][1:] != pos[once][:-1])]
        enough = np.bincount(group[once][first]) >= block.needed[item[a]]
        a, b = a[enough], b[enough]
        lo = np.maximum(begin[a] - slack[a], w.first[doc[a]])
        hi = np.minimum(begin[b] + block.size[item[b]] + slack[b], w.first[doc[a] + 1])
        parts.append(np.stack([doc[a], item[a], lo, hi]))
    return tuple(np.concatenate(parts, axis=1))


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """One row per document and item it holds: ``score`` (alignment score as a
    share of the item's own), ``matched_words`` and the characters
    ``begin:end`` of the best passage."""
    spark = docs.sparkSession
    plain = ids_and_text(docs, id_col, text_col)
    item_kind = id_type(items, item_id_col)
    schema = f"doc_id {id_type(docs, id_col)}, item_id {item_kind}, score double, matched_words int, `begin` int, `end` int"

    def search(block: Items) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(rows: pa.RecordBatch, texts: list[str]) -> dict | None:
            block = shared.value
            w = words(texts)
            doc, item, lo, hi = _passages(block, w)
            ts = [block.words[i] for i in item.tolist()]
            ds = [w.hash[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
            some = np.flatnonzero(score_pairs(ts, ds) / (MATCH * block.size[item]) >= min_score)
            if not len(some):
                return None
            doc, item, lo = doc[some], item[some], lo[some]
            ts, ds = ([x[k] for k in some.tolist()] for x in (ts, ds))
            got = align_pairs(ts, ds)
            score = got.score / (MATCH * np.array([len(t) for t in ts]))
            order = np.lexsort((lo, -score, item, doc))
            keep = order[np.r_[True, (doc[order][1:] != doc[order][:-1]) | (item[order][1:] != item[order][:-1])]]
            ids = rows.column("doc_id")
            return {
                "doc_id": ids.take(pa.array(doc[keep])),
                "item_id": [block.ids[i] for i in item[keep].tolist()],
                "score": score[keep],
                "matched_words": got.matches[keep],
                "begin": w.begin[lo[keep] + got.d_begin[keep]],
                "end": w.end[lo[keep] + got.d_end[keep] - 1],
            }

        return map_texts(plain, run, schema)

    parts = [search(b) for b in _blocks(items, item_id_col, item_text_col, min_score)]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a test item. Rows that repeat
    an id are judged each by its own text."""
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.struct(F.col(id_col).alias("i"), F.xxhash64(F.col(text_col)).alias("h")).alias("k"), F.col(text_col).alias("text"))
    key, text_hash = fresh(docs, "hit_id", "hit_hash")
    hits = contaminated(keyed, items, "k", "text").select(F.col("doc_id.i").alias(key), F.col("doc_id.h").alias(text_hash)).distinct()
    assert hits.schema[key].dataType.simpleString() == kind
    same = F.col(id_col).eqNullSafe(F.col(key)) & (F.xxhash64(F.col(text_col)) == F.col(text_hash))
    return docs.join(hits, same, "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
