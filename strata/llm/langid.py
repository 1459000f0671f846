"""Language identification with spans (operator 2).

Every word's script (by code point ranges) narrows the candidate languages;
character trigrams score the word under each candidate; Viterbi with a
penalty for switching labels the words, so mixed text falls into spans.

Defined results: a null text or one without a letter is ``und`` with score 0
and no span; a null language is not learned from; rows with a null id are
labelled but not learned from; with nothing to learn from every row is
``und``; words in a script that no learned language has count for none of them
(a text of such words alone scores 0); repeated rows get equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import begin_task, held_out, ids_and_text, map_texts, ship, text_slices, trim
from strata.llm.textcore import codes, letter_table, lower, mix

#: First code point of the ranges of Unicode scripts, in order.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"),
    (0x3100, "han"), (0xA4D0, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
]
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
_STARTS = np.array([a for a, _ in SCRIPT_RANGES])
_SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES])

BUCKET_BITS = 16
#: Expected number of labelled documents the model is fitted on, at most.
TRAIN_DOCS = 20_000
#: A language is a candidate for a script that holds this share of its letters.
SCRIPT_SHARE = 0.01
SWITCH_PENALTY = 10.0
SMOOTHING = 0.5
SPAN = "array<struct<begin:int,end:int,lang:string>>"


@dataclass
class LanguageModel:
    langs: list[str]
    logp: np.ndarray  # buckets x languages, float32
    allowed: np.ndarray  # scripts x languages


def _letters(texts: list[str]):
    """Letters of all texts, their trigram buckets and word bounds."""
    flat, starts = codes([lower(t) for t in texts])
    letter = letter_table()[flat]
    at = np.flatnonzero(letter)
    padded = np.zeros(len(flat) + 2, np.uint64)
    padded[1:-1] = np.where(letter, flat, 0)
    with np.errstate(over="ignore"):
        tri = padded[at] + (padded[at + 1] << np.uint64(21)) + (padded[at + 2] << np.uint64(42))
    bucket = (mix(tri) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    return flat, starts, at, bucket


def _script(code_points: np.ndarray) -> np.ndarray:
    return _SCRIPT_OF[np.searchsorted(_STARTS, code_points, side="right") - 1]


def fit(docs: DataFrame, lang: Column, usable: Column, id_col: str = "doc_id", text_col: str = "text") -> LanguageModel:
    """Trigram and script counts per language over a sample of the usable
    labelled rows, chosen by a hash of the id: all of them, or about
    ``TRAIN_DOCS``. Counts are summed in Spark; languages times buckets rows
    reach the driver."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), lang.alias("lang"))
    rows = rows.filter(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    n = rows.select("doc_id").count()
    keep = min(1.0, TRAIN_DOCS / max(n, 1))
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(keep * 1_000_000))

    def counts(batch: pa.RecordBatch, texts: list[str]) -> dict | None:
        names, which = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        flat, starts, at, bucket = _letters(texts)
        if not len(at):
            return None
        lang_of = which[np.searchsorted(starts, at, side="right") - 1]
        width = (1 << BUCKET_BITS) + len(SCRIPTS)
        n = np.bincount(lang_of * width + bucket, minlength=len(names) * width)
        n += np.bincount(lang_of * width + (1 << BUCKET_BITS) + _script(flat[at]), minlength=len(names) * width)
        some = np.flatnonzero(n)
        return {"lang": names[some // width].tolist(), "feature": (some % width).astype(np.int32), "n": n[some]}

    got = (
        map_texts(sample.select("lang", "text"), counts, "lang string, feature int, n long")
        .groupBy("lang", "feature")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(got["lang"].unique().tolist())
    size = 1 << BUCKET_BITS
    table = np.zeros((size + len(SCRIPTS), len(langs)))
    table[got["feature"].to_numpy(np.int64), got["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)] = got["n"]
    grams, scripts = table[:size], table[size:]
    logp = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * size))
    return LanguageModel(langs, logp.astype(np.float32), scripts >= SCRIPT_SHARE * scripts.sum(axis=0))


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every row of ``scores`` (words x languages). Texts are
    ``first[d]:first[d + 1]``; all texts advance together, a word at a time."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, longest = first[:-1][order], int(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -np.arange(longest), side="left")
    stay = np.zeros(len(scores), np.int16)  # the best label one word before
    kept = np.zeros(scores.shape, bool)  # whether a label was kept rather than entered
    labels = np.zeros(len(scores), np.int16)
    v = np.zeros((len(order), scores.shape[1]), np.float32)
    v[: active[0] if longest else 0] = scores[begin[: active[0]]] if longest else 0
    for t in range(1, longest):
        k = active[t]
        now, at = v[:k], begin[:k] + t
        best = now.max(axis=1)
        stay[at] = now.argmax(axis=1)
        enter = (best - penalty)[:, None]
        kept[at] = now >= enter
        v[:k] = np.maximum(now, enter) + scores[at]
    last = v.argmax(axis=1).astype(np.int16)
    for t in range(longest - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        labels[at] = last[:k]
        if t:
            last[:k] = np.where(kept[at, last[:k]], last[:k], stay[at])
    return labels


def _label(model: LanguageModel, texts: list[str], penalty: float) -> dict:
    flat, starts, at, bucket = _letters(texts)
    langs, n_docs = model.langs, len(texts)
    out = {"lang_pred": ["und"] * n_docs, "score": np.zeros(n_docs), "spans": [[] for _ in range(n_docs)]}
    if not len(at) or not langs:
        return out
    new = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # words begin after a gap
    size = np.diff(np.append(new, len(at)))
    scores = np.add.reduceat(model.logp[bucket], new, axis=0)
    allowed = model.allowed[_script(flat[at[new]])]
    none = ~allowed.any(axis=1)
    scores = np.where(allowed | none[:, None], scores, np.float32(-1e4))
    scores[none] = 0
    doc = np.searchsorted(starts, at[new], side="right") - 1
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    labels = viterbi(scores, first, penalty)
    # Words in a script that no language has are letters of none of them.
    share = np.bincount(doc * len(langs) + labels, weights=size * ~none, minlength=n_docs * len(langs)).reshape(n_docs, -1)
    total = np.bincount(doc, weights=size, minlength=n_docs)
    top = share.argmax(axis=1)
    for d in np.flatnonzero(total):
        out["lang_pred"][d] = langs[top[d]]
    out["score"] = np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0)
    change = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
    stop = np.append(change[1:], len(doc)) - 1
    begins = at[new][change] - starts[doc[change]]
    ends = at[new][stop] + size[stop] - starts[doc[stop]]
    for d, b, e, x in zip(doc[change].tolist(), begins.tolist(), ends.tolist(), labels[change].tolist(), strict=True):
        out["spans"][d].append({"begin": b, "end": e, "lang": langs[x]})
    return out


def label_languages(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
    keep: dict[str, str] | None = None,
) -> DataFrame:
    """Per row: ``lang_pred`` (most letters), ``score`` (its share of the
    letters) and the spans. ``keep`` names columns of ``docs`` to carry along,
    with their new names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = {"doc_id": "doc_id"} if keep is None else keep
    rows = ids_and_text(docs, id_col, text_col)
    if keep != {"doc_id": "doc_id"}:
        rows = docs.select(*[F.col(c).alias(n) for c, n in keep.items()], F.col(text_col).cast("string").alias("text"))

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {n: batch.column(n) for n in keep.values()} | _label(shared.value, texts, penalty)

    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in keep.values())
    return map_texts(rows, run, f"{kinds}, lang_pred string, score double, spans {SPAN}")


def drop_unidentified(docs: DataFrame, model: LanguageModel, min_score: float, text_col: str = "text") -> DataFrame:
    """``docs``, same columns, without rows that are ``und`` or whose main
    language holds less than ``min_score`` of the letters."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(None)
        for batch in batches:
            for lo, hi, texts in text_slices(batch, text_col, 1_000_000):
                got = _label(shared.value, texts, SWITCH_PENALTY)
                keep = [x != "und" and s >= min_score for x, s in zip(got["lang_pred"], got["score"], strict=True)]
                yield batch.slice(lo, hi - lo).filter(pa.array(keep, pa.bool_()))
        trim()

    return docs.mapInArrow(run, docs.schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, F.col("lang"), ~held_out(F.col("doc_id")))
    labelled = label_languages(docs, model)
    return labelled.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
