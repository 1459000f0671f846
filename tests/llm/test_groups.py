"""Operators 4, 8, 9 and the pipeline against brute force."""

import collections
import hashlib
import itertools
import re

import numpy as np
from pyspark.sql import functions as F

from strata.llm import ann, minhash, suffix
from strata.llm.components import components


def shingles(text):
    w = [x for x in re.findall(r"[^\W_]+", (text or "").lower())]
    return tuple(w), collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def j_p(x, y):
    both = set(x) & set(y)
    return sum(1 / sum(max(x[k] / x[d], y[k] / y[d]) for k in set(x) | set(y)) for d in both)


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(3)
    for _ in range(10):
        x, y = ({int(k): int(rng.integers(1, 4)) for k in rng.choice(40, 25, replace=False)} for _ in range(2))
        arrays = [(np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)])) for s in (x, y)]
        exact = minhash.probability_jaccard(*arrays[0], *arrays[1])
        assert abs(exact - j_p(collections.Counter(x), collections.Counter(y))) < 1e-12
        doc = np.repeat([0, 1], [25, 25])
        sig = minhash.signatures(doc, np.concatenate([a[0] for a in arrays]), np.concatenate([a[1] for a in arrays]), 2, 4000)
        assert abs((sig[0] == sig[1]).mean() - exact) < 0.05


def groups_by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i][0] and sets[j][0] and (sets[i][0] == sets[j][0] or j_p(sets[i][1], sets[j][1]) >= 0.8):
            root[find(j)] = find(i)
    out = collections.defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(rows[i][0])
    ids = lambda g: [x for x in g if x is not None]
    return sorted((str(min(ids(g), default=None)), str(x)) for g in out.values() for x in g)


def edited(base, n, every):
    out = []
    for i in range(n):
        w = base.split()
        for k in range(i % every, len(w), every):
            w[k] = f"e{i}x{k}"
        out.append(" ".join(w))
    return out


def test_near_duplicates(spark, corpus, none):
    base = " ".join(f"w{i}" for i in range(300))
    more = [(1000 + i, t) for i, t in enumerate(edited(base, 30, 90) + edited(base, 30, 60) + edited(base, 20, 45))]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [tuple(r) for r in docs.collect()]
    found = minhash.near_duplicates(docs).collect()
    assert sorted((str(r.class_id), str(r.doc_id)) for r in found) == groups_by_brute_force(rows)
    kept = minhash.drop_near_duplicates(corpus)
    assert kept.columns == corpus.columns
    wordless = {90, 91, 92, 96}
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert wordless <= set(ids) and ids.count(80) == 1 and 81 not in ids and len(ids) == len(set(ids))
    assert minhash.near_duplicates(none).count() == 0


def test_full_buckets_in_blocks(spark, monkeypatch):
    """Buckets over several blocks find the links that the first class of a
    bucket does not have."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = " ".join(f"w{i}" for i in range(200))
    rows = list(enumerate(edited(base, 40, 50)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs).collect()
    assert sorted((str(r.class_id), str(r.doc_id)) for r in found) == groups_by_brute_force(rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 50), (60, 50), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys((50, 60, 100), 50)}


def repeats(rows, n):
    seen = collections.Counter(d[i : i + n] for d in rows for i in range(len(d) - n + 1))
    out = []
    for d in rows:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if seen[d[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(spark, corpus, none):
    passage = " ".join(f"passage{i}" for i in range(40))
    rng = np.random.default_rng(5)
    extra = [(2000 + i, "".join(rng.choice(list("abcdé "), 150)) + passage[: 230 + 3 * i] + "".join(rng.choice(list("abc "), 90))) for i in range(30)]
    docs = corpus.select("doc_id", "text").unionByName(spark.createDataFrame([*extra, (3000, "ab" * 400), (3001, "z" * 199)], "doc_id long, text string"))
    rows = docs.collect()
    want = sorted((str(r.doc_id), *x) for r, x in zip(rows, repeats([(r.text or "").encode() for r in rows], suffix.LENGTH), strict=True))
    for limit in (suffix.TASK_STRETCHES, 3):  # the second counts in the cluster
        got = suffix.remove_repeats(docs, task_stretches=limit).collect()
        mine = sorted(
            (str(r.doc_id), r.n_bytes, sum(r.ends) - sum(r.begins), len(r.begins), hashlib.sha256(r.kept).hexdigest()) for r in got
        )
        assert mine == want
    assert suffix.remove_repeats(none).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[100:600] = x[100]  # many equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(4000, None), (4020, [0.0] * 16), (4040, [float("nan")] * 16), (4060, [1.0]), (4080, [None] * 16), (None, [1.0] * 16), rows[7]]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for r in ann.search(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 3000, 20))
    s = x.astype(float) @ x.astype(float).T
    found = 0
    for q, hits in got.items():
        ids = [v for v, _ in hits]
        assert len(hits) == 20 and len(set(ids)) == 20 and q not in ids
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        assert np.allclose([v for _, v in hits], s[q, ids])
        s[q, q] = -np.inf
        found += len(set(np.argsort(-s[q], kind="stable")[:20].tolist()) & set(ids))
    assert found / (20 * len(got)) >= 0.9
    few = ann.search(vectors.filter("vec_id < 12"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == list(range(1, 12))
    assert ann.search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark, corpus, tmp_path):
    import corpus_pipeline

    from strata.llm import packing

    bench = corpus.filter("doc_id = 5").selectExpr("cast(1 as bigint) as item_id", "substr(text, 1, 300) as text")
    sf = str(tmp_path)
    plain = corpus.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{sf}/documents.parquet")
    bench.write.parquet(f"{sf}/benchmark.parquet")
    docs, sizes = spark.read.parquet(f"{sf}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{sf}/stage{i}")
        docs = spark.read.parquet(f"{sf}/stage{i}")
        if i < 4:
            assert docs.columns == plain.columns, name
            sizes.append({r.doc_id for r in docs.select("doc_id").collect()})
            assert docs.filter("n_chars <> length(text)").count() == 0
    assert not sizes[0] & {90, 91, 92, 96}
    assert 60 in sizes[1] and 81 not in sizes[2] and 80 in sizes[2]
    assert 5 in sizes[2] and 5 not in sizes[3]
    assert {r.doc_id for r in docs.collect()} == sizes[3]
    assert corpus_pipeline.run(spark, sf).count() == docs.count()
