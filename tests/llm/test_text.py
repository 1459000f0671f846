"""Operators 1, 2, 3, 6, 7 against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import align, decontaminate, langid, licenses, linededup, quality
from strata.llm.common import held_out
from strata.llm.textcore import words


def smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1][j + 1] = max(0, h[i][j] + (2 if x == y else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
            best = max(best, h[i + 1][j + 1])
    return best


def test_alignment_scores():
    r = random.Random(1)
    pairs = [([r.randint(10, 14) for _ in range(r.randint(1, 12))], [r.randint(10, 14) for _ in range(r.randint(1, 30))]) for _ in range(200)]
    ts, ds = ([np.array(x, np.uint64) for x in side] for side in zip(*pairs, strict=True))
    got = align.align_pairs(ts, ds)
    assert got.score.tolist() == [smith_waterman(a, b) for a, b in pairs]
    for k, (a, b) in enumerate(pairs):  # the reported passage alone has the score
        part = (a[got.t_begin[k] : got.t_end[k]], b[got.d_begin[k] : got.d_end[k]])
        assert smith_waterman(*part) == got.score[k]


def test_words_match_python():
    texts = ["It's 3.5 ÉTÉ—İx", "", "...", "a  b\nc", "straße"]
    w = words(texts)
    for d, t in enumerate(texts):
        spans = [(m[0], m[-1] + 1) for _, g in itertools.groupby(enumerate(t), lambda x: x[1].isalnum()) if (m := [i for i, c in g if c.isalnum()])]
        assert list(zip(w.begin[w.of(d)].tolist(), w.end[w.of(d)].tolist(), strict=True)) == spans
    assert words(["Straße x"]).hash[0] == words(["y straße"]).hash[1]


def test_decontamination(spark, corpus, none):
    text = corpus.filter("doc_id = 5").first().text.split()
    item = text[10:40]
    edited = [*item[:12], "new", "words", *item[14:]]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(edited)), (3, None), (4, "..."), (5, "no such thing at all here")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(corpus, items).collect()}
    assert (5, 1) in got and got[5, 1].score == 1.0 and (5, 2) in got and got[5, 2].score < 1.0
    assert not any(i in (3, 4, 5) for _, i in got)
    whole = corpus.filter("doc_id = 5").first().text
    assert whole[got[5, 1].begin : got[5, 1].end].split() == item
    kept = decontaminate.drop_contaminated(corpus, items)
    assert kept.columns == corpus.columns and kept.filter("doc_id = 5").count() == 0
    assert kept.count() == corpus.count() - len({d for d, _ in got})
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(corpus, items.limit(0)).count() == 0


@pytest.mark.parametrize("copies", [100, 101])
def test_copies_in_many_documents(spark, copies):
    item = [f"w{i}" for i in range(30)]
    edited = [f"new{i}" if i in (6, 12, 18, 24) else x for i, x in enumerate(item)]
    half = [f"h{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(half))], "item_id long, text string")
    texts = [(i, " ".join(edited)) for i in range(copies)] + [(1000 + i, " ".join(half[:15])) for i in range(copies)]
    got = decontaminate.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), items).collect()
    assert sorted(r.doc_id for r in got) == [x for x, _ in texts]
    assert {(r.item_id, r.score) for r in got} == {(1, 0.8), (2, 0.5)}


@pytest.mark.parametrize("common", [100, 0])
def test_no_alignment_is_missed(monkeypatch, common):
    monkeypatch.setattr(decontaminate, "COMMON", common)
    monkeypatch.setattr(decontaminate, "HITS", 500)
    r = random.Random(3)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [[r.choice(vocabulary) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 15, 15, 20, 30)]
    other = lambda n: [f"o{r.randint(0, 999)}" for _ in range(n)]
    docs = []
    for item in items:
        edits = [[*item[:k], "x", *item[k + 1 :]] for k in range(len(item))]
        edits += [["x" if i % n == n - 1 else x for i, x in enumerate(item)] for n in (2, 3, 4)]
        edits += [[y for x in item for y in (x, "x")], [x for i, x in enumerate(item) if i % 4], item[: (len(item) + 1) // 2]]
        for share in (0.2, 0.3, 0.4):
            for _ in range(6):
                edits.append([y for x in item for y in r.choices(([x], ["x"], [], [x, "x"]), (1 - share, share / 2, share / 4, share / 4))[0]])
        docs += [other(r.randint(0, 5)) + e + other(r.randint(0, 5)) for e in edits]
    block = decontaminate.Items(list(range(len(items))), [" ".join(x) for x in items])
    w = words([" ".join(d) for d in docs])
    got = {}
    for doc, item, lo, hi in zip(*(x.tolist() for x in decontaminate._passages(block, w)), strict=True):
        score = align.score_pairs([block.words[item]], [w.hash[lo:hi]])[0]
        got[doc, item] = max(got.get((doc, item), 0), score)
    want = {(d, i): smith_waterman(item, doc) for d, doc in enumerate(docs) for i, item in enumerate(items)}
    want = {k: v for k, v in want.items() if v >= decontaminate.MIN_SCORE * align.MATCH * len(items[k[1]])}
    assert {k: v for k, v in got.items() if v >= decontaminate.MIN_SCORE * align.MATCH * len(items[k[1]])} == want
    assert len(want) > 300


def test_evenly_edited_copy(spark):
    item = [f"w{i}" for i in range(8)]
    edited = ["new" if i % 4 == 3 else x for i, x in enumerate(item)]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = spark.createDataFrame([(7, " ".join(edited))], "doc_id long, text string")
    assert [(r.doc_id, r.score) for r in decontaminate.contaminated(docs, items).collect()] == [(7, 11 / 16)]


def test_scores_alone_are_those_of_the_alignment():
    rng = np.random.default_rng(5)
    ts, ds = ([rng.integers(10, 15, n).astype(np.uint64) for n in rng.integers(1, most, 200)] for most in (12, 40))
    assert align.score_pairs(ts, ds).tolist() == align.align_pairs(ts, ds).score.tolist()


def test_blocks_of_items_give_the_same(spark, corpus, monkeypatch):
    items = corpus.filter("doc_id < 30").selectExpr("doc_id as item_id", "substr(text, 20, 200) as text")
    one = sorted(map(tuple, decontaminate.contaminated(corpus, items).collect()), key=str)
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 1500)
    assert sorted(map(tuple, decontaminate.contaminated(corpus, items).collect()), key=str) == one
    assert len(one) >= 30


def best_path(scores, penalty):
    paths = itertools.product(range(scores.shape[1]), repeat=len(scores))
    return max(sum(scores[i, x] for i, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:], strict=False)) for p in paths)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    sizes = [5, 1, 0, 4, 6]
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=(first[-1], 3)).astype(np.float32)
    labels = langid.viterbi(scores, first, 0.7)
    for d, n in enumerate(sizes):
        s, p = scores[first[d] : first[d + 1]], labels[first[d] : first[d + 1]]
        if n:
            value = s[np.arange(n), p].sum() - 0.7 * (p[1:] != p[:-1]).sum()
            assert value == pytest.approx(best_path(s, 0.7), abs=1e-4)


def test_language_spans(spark, corpus, none):
    model = langid.fit(corpus, F.col("lang"), ~held_out(F.col("doc_id")))
    got = {r.doc_id: r for r in langid.label_languages(corpus, model).collect()}
    truth = {r.doc_id: r.lang for r in corpus.filter("doc_id < 74").collect()}
    assert np.mean([got[d].lang_pred == x for d, x in truth.items()]) > 0.95
    assert all(got[d].lang_pred == "und" and got[d].score == 0 and not got[d].spans for d in (90, 91, 92, 96))
    two = " ".join(["größe schön straße"] * 10) + " " + " ".join(["the other thing"] * 18)
    mixed = langid.label_languages(spark.createDataFrame([(1, two)], "doc_id long, text string"), model).first()
    assert [s.lang for s in mixed.spans] == ["de", "en"] and mixed.lang_pred == "en" and 0 < mixed.score < 1
    kept = langid.drop_unidentified(corpus, model, 0.4)
    assert kept.schema == corpus.schema and kept.filter("doc_id in (90, 91, 92, 96)").count() == 0
    assert langid.label_languages(none, model).count() == 0
    nothing = langid.fit(none, F.col("lang"), F.lit(True))
    assert {r.lang_pred for r in langid.label_languages(corpus, nothing).collect()} == {"und"}


@pytest.mark.parametrize("min_sites", [3, 12])
def test_line_dedup(corpus, none, min_sites):
    rows = [(i, r.doc_id, r.text, r.source) for i, r in enumerate(corpus.select("doc_id", "text", "source").collect())]
    sites, first = {}, {}
    for _, d, t, s in rows:
        for pos, line in enumerate((t or "").split("\n")):
            key = line.strip(" \t\r")
            if key:
                sites.setdefault(key, set()).update({s} - {None})
                first[key] = min(first.get(key, (2, 0, 0)), (d is not None, d or 0, pos))
    want = []
    for _, d, t, _ in rows:
        lines = (t or "").split("\n")
        keep = [x for p, x in enumerate(lines) if len(sites.get(k := x.strip(" \t\r"), ())) < min_sites or first[k] == (d is not None, d or 0, p)]
        want.append((d, None if t is None else "\n".join(keep), len(lines) - len(keep)))
    cleaned = linededup.remove_boilerplate(corpus, min_sites)
    got = [(r.doc_id, r.text, r.lines_removed) for r in cleaned.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert cleaned.columns == [*corpus.columns, "lines_removed"]
    assert linededup.remove_boilerplate(none, min_sites).count() == 0


def test_license_scan(spark, corpus, none):
    mit = dict(licenses.TEMPLATES)["MIT-text"].split()
    edited = " ".join([*mit[:20], "inserted", *mit[20:50], *mit[52:]])
    docs = spark.createDataFrame(
        [(1, f"Head. {edited} Tail"), (2, "All rights reserved. Some text. All Rights Reserved"), (3, " ".join(mit[:20])), (4, None), (5, "permission granted")],
        "doc_id long, text string",
    )
    got = sorted(map(tuple, licenses.license_matches(docs).collect()))
    assert [(d, n) for d, n, *_ in got] == [(1, "MIT-text"), (2, "all-rights-reserved"), (2, "all-rights-reserved")]
    assert 0.95 < got[0][2] < 1 and got[0][3] == 6 and got[0][4] == len(f"Head. {edited}") - 1
    assert [g[3:] for g in got[1:]] == [(0, 19), (32, 51)]
    assert licenses.license_matches(corpus).count() == 0 and licenses.license_matches(none).count() == 0


def test_winnowing_keeps_a_fingerprint_of_every_window():
    h = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    kept = licenses.TemplateIndex.winnow(h)
    assert all(any(i <= k < i + licenses.WINDOW for k in kept) for i in range(len(h) - licenses.WINDOW + 1))


def test_quality(spark, corpus, none):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "word"], 60)) + "." for _ in range(120)]
    bad = [" ".join(["spam!!"] * int(n)) for n in rng.integers(20, 90, 120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)] + [(999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(240)] * 2 + [(3, None), (5000, 1), (None, 0)], "doc_id long, quality int")
    x = quality.document_statistics(docs)
    model = quality.fit(x, labels.filter(~held_out(F.col("doc_id"))), "quality")
    got = {r.doc_id: r for r in quality.score(x, model).collect()}
    assert all((got[i].predicted == 1) == (i < 120) for i in range(240)) and 0 <= got[999].score <= 1
    # Log densities as the plain formula gives them.
    features = np.array([r.x for r in x.filter("doc_id < 240").orderBy("doc_id").collect()])
    for _, mean, inverse, log_det in model.classes:
        cov = np.linalg.inv(inverse.T @ inverse)
        assert np.linalg.slogdet(cov)[1] == pytest.approx(log_det, rel=1e-6)
        z = features[:5] - mean
        assert ((z @ inverse.T) ** 2).sum(axis=1) == pytest.approx(np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z), rel=1e-4)
    odd = quality.score(quality.document_statistics(corpus), model)
    assert odd.count() == corpus.count()
    assert quality.fit(x, labels.limit(0), "quality").score(features).tolist() == [0.5] * 240
    assert quality.score(quality.document_statistics(none), model).count() == 0


def test_letters_of_a_script_that_was_not_learned_belong_to_no_language():
    scripts = np.zeros((len(langid.SCRIPTS), 2), bool)
    latin = langid._script(np.array([ord("a")]))[0]
    scripts[latin] = True
    model = langid.LanguageModel(["de", "en"], np.zeros((1 << langid.BUCKET_BITS, 2), np.float32), scripts)
    got = langid._label(model, ["abc abc", "Ελληνικά γράμματα", "abcd жизнь", "12"], 1.0)
    assert got["lang_pred"][3] == "und" and got["score"].tolist()[3] == 0.0
    assert got["score"].tolist()[:2] == [1.0, 0.0]
    assert abs(got["score"][2] - 4 / 9) < 1e-12
