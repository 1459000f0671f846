"""Quality classifier: regularised quadratic discriminant (operator 7).

Statistics of the whole text, transformed towards normality, are modelled as
one Gaussian per class. Class covariances are shrunk towards the pooled one
and that towards its diagonal; a document's score is the logistic of the
difference of the two log densities, each a Mahalanobis form through a
Cholesky factor computed once.

Defined results: a null or empty text has all statistics zero and is scored;
labels that are null, repeated or of unknown documents do no harm (repeated
equal labels count once, contradicting ones once each); with no label of a
class the score is the prior (0.5 with no label at all); rows with a null id
are scored and not learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import held_out, id_type, ids_and_text, map_arrow, map_texts, stage
from strata.llm.textcore import codes, word_table, words

FEATURES = [
    "log_chars", "log_words", "word_size", "word_size_spread", "upper", "digit", "symbol", "symbol_kinds", "space",
    "stop_mark", "line_size", "distinct_words", "same_as_before", "top_word", "repeated_pairs", "repeated_lines",
    "bare_symbol_words", "one_letter_words", "letter_entropy",
]
#: Weight of the class covariance against the pooled one, and of that
#: against its diagonal.
CLASS_SHRINKAGE = 0.2
DIAGONAL_SHRINKAGE = 0.05
THRESHOLD = 0.3


def _share(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """A share on the logit scale, held off both ends by half an event."""
    p = (n + 0.5) / (total + 1.0)
    return np.log(p / np.maximum(1.0 - p, 1e-9))


def _per_doc(keys: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each text, and how often its most frequent one is."""
    if not len(keys):
        return np.zeros(n_docs), np.zeros(n_docs)
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    new = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (d[1:] != d[:-1])])
    size = np.diff(np.append(new, len(k)))
    top = np.zeros(n_docs)
    np.maximum.at(top, d[new], size)
    return np.bincount(d[new], minlength=n_docs).astype(float), top


def statistics(texts: list[str]) -> np.ndarray:
    """One row of :data:`FEATURES` per text."""
    n = len(texts)
    flat, starts = codes(texts)
    size = np.diff(starts) - 1.0
    doc = np.repeat(np.arange(n), np.diff(starts))

    def count(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=n).astype(float)

    w = words(texts)
    wdoc = w.doc
    n_words = np.diff(w.first).astype(float)
    long = (w.end - w.begin).astype(float)
    mean = np.bincount(wdoc, long, n) / np.maximum(n_words, 1)
    spread = np.sqrt(np.maximum(np.bincount(wdoc, long * long, n) / np.maximum(n_words, 1) - mean * mean, 0))
    is_word = word_table()[flat]
    inner = np.ones(len(flat), bool)
    inner[starts[1:] - 1] = False  # the break after each text
    space = inner & ((flat == 32) | (flat == 10) | (flat == 9) | (flat == 13))
    symbol = inner & ~is_word & ~space
    upper = is_word & (((flat >= 65) & (flat <= 90)) | ((flat >= 0xC0) & (flat <= 0xDE)))
    lines = count(inner & (flat == 10)) + 1
    kinds, _ = _per_doc(flat[symbol].astype(np.uint64), doc[symbol], n)
    distinct, top = _per_doc(w.hash, wdoc, n)
    same = np.zeros(len(w.hash), bool)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (wdoc[1:] == wdoc[:-1])
    with np.errstate(over="ignore"):
        pair = w.hash[1:] * np.uint64(3) + w.hash[:-1]
    inside = wdoc[1:] == wdoc[:-1]
    pairs, _ = _per_doc(pair[inside], wdoc[1:][inside], n)
    n_pairs = np.maximum(n_words - 1, 0)
    distinct_lines = np.array([len(set(t.split("\n"))) for t in texts], float)
    bare = symbol & np.r_[True, space[:-1] | ~inner[:-1]] & np.r_[space[1:] | ~inner[1:], True]
    letters = np.zeros((n, 64))
    np.add.at(letters, (doc[is_word], flat[is_word] % 64), 1)
    p = letters / np.maximum(letters.sum(axis=1, keepdims=True), 1)
    entropy = -(p * np.log(np.maximum(p, 1e-12))).sum(axis=1)
    out = np.stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            np.log1p(mean),
            np.log1p(spread),
            _share(count(upper), size),
            _share(count(inner & (flat >= 48) & (flat <= 57)), size),
            _share(count(symbol), size),
            np.log1p(kinds),
            _share(count(space), size),
            _share(count(inner & ((flat == 46) | (flat == 33) | (flat == 63))), n_words),
            np.log1p(size / lines),
            # Heaps' law: distinct words against the square root of words.
            np.log1p(distinct) - 0.7 * np.log1p(n_words),
            _share(np.bincount(wdoc[same], minlength=n).astype(float), n_words),
            _share(top, n_words),
            _share(n_pairs - pairs, n_pairs),
            _share(lines - distinct_lines, lines),
            _share(count(bare), n_words),
            _share(np.bincount(wdoc[long == 1], minlength=n).astype(float), n_words),
            entropy,
        ],
        axis=1,
    )
    out[size == 0] = 0.0
    return out


@dataclass
class Discriminant:
    """Per class: log prior, mean, inverse Cholesky factor, log determinant."""

    classes: list[tuple[float, np.ndarray, np.ndarray, float]]
    prior: float

    @classmethod
    def of(cls, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
        """From (count, sum, sum of outer products) of each class."""
        n = {k: moments.get(k, (0.0,))[0] for k in (0, 1)}
        total = n[0] + n[1]
        prior = n[1] / total if total else 0.5
        if not (n[0] and n[1]):
            return cls([], prior)
        means = {k: moments[k][1] / n[k] for k in (0, 1)}
        scatter = {k: moments[k][2] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)}
        pooled = (scatter[0] + scatter[1]) / max(total - 2, 1)
        base = (1 - DIAGONAL_SHRINKAGE) * pooled + DIAGONAL_SHRINKAGE * np.diag(np.diag(pooled))
        base += 1e-6 * np.eye(len(base))
        fitted = []
        for k in (0, 1):
            # A class of few rows leans on the pooled covariance.
            weight = (1 - CLASS_SHRINKAGE) * n[k] / (n[k] + 2 * len(base))
            cov = weight * scatter[k] / max(n[k] - 1, 1) + (1 - weight) * base
            factor = np.linalg.cholesky(cov)
            fitted.append(
                (np.log(n[k] / total), means[k], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum())
            )
        return cls(fitted, prior)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.prior)
        logs = []
        for log_prior, mean, inverse, log_det in self.classes:
            z = (x - mean) @ inverse.T
            logs.append(log_prior - 0.5 * (log_det + (z * z).sum(axis=1)))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and its feature vector for every row."""

    def run(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"doc_id": batch.column("doc_id"), "x": list(statistics(texts))}

    return map_texts(ids_and_text(docs, id_col, text_col), run, f"doc_id {id_type(docs, id_col)}, x array<double>")


def fit(features: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id") -> Discriminant:
    """Class moments over every labelled row; each task sums its own rows, so
    as many rows as tasks and classes are added up."""
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).distinct()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total: dict[int, list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.array(batch.column("x").to_pylist(), float)
            y = batch.column("label").to_numpy()
            for k in np.unique(y).tolist():
                part = x[y == k]
                have = total.setdefault(k, [0.0, 0.0, 0.0])
                for i, v in enumerate((float(len(part)), part.sum(axis=0), part.T @ part)):
                    have[i] = have[i] + v
        for k, (n, s, o) in total.items():
            yield {"label": [k], "n": [n], "s": [s.tolist()], "o": [o.reshape(-1).tolist()]}

    parts = map_arrow(
        features.join(marked, "doc_id").select("x", "label"), sums, "label int, n double, s array<double>, o array<double>"
    )
    d = len(FEATURES)
    summed = (
        parts.select("label", "n", F.posexplode(F.concat("s", "o")).alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
        .collect()
    )
    moments: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}
    for k in {r["label"] for r in summed}:
        v = np.zeros(d + d * d)
        rows = [r for r in summed if r["label"] == k]
        v[[r["i"] for r in rows]] = [r["v"] for r in rows]
        moments[k] = (rows[0]["n"], v[:d], v[d:].reshape(d, d))
    return Discriminant.of(moments)


def score(features: DataFrame, model: Discriminant) -> DataFrame:
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
            p = shared.value.score(x)
            yield {"doc_id": batch.column("doc_id"), "score": p, "predicted": (p >= THRESHOLD).astype(np.int32)}

    return map_arrow(features, run, f"doc_id {id_type(features)}, score double, predicted int")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strata.llm.common import table

    features = stage(document_statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    scored = score(features, fit(features, labels, "quality"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
