"""Operator 11 against a plain alignment of whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import crosstoken, tokenids


def plain_tokens(text):
    """Ids and byte strings of both tokenizers, None where they don't spell the text."""
    import sentencepiece
    from tokenizers import Tokenizer

    if "a" not in KEPT:
        KEPT["a"] = Tokenizer.from_file(tokenids.default_tokenizer())
        KEPT["a"].encode_special_tokens = True
        KEPT["b"] = sentencepiece.SentencePieceProcessor(model_file=crosstoken.default_pieces())
    letters = {v: k for k, v in tokenids.BYTE_LETTERS.items()}
    if not text:
        return None
    a = KEPT["a"].encode(" " + text, add_special_tokens=False)
    spelled_a = [bytes(letters[c] for c in t) for t in a.tokens]
    b = KEPT["b"].encode(text)
    pieces = [KEPT["b"].id_to_piece(i) for i in b]
    spelled_b = [bytes([int(p[3:5], 16)]) if KEPT["b"].is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
    want = (" " + text).encode()
    if b"".join(spelled_a) != want or b"".join(spelled_b) != want:
        return None
    return a.ids, list(map(len, spelled_a)), b, list(map(len, spelled_b))


KEPT = {}


def plain(texts):
    """The contract's row of every text, by byte ranges."""
    found, holds = [], Counter()
    for text in texts:
        tokens = plain_tokens(text)
        if tokens is None:
            found.append(None)
            continue
        a, size_a, b, size_b = tokens
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        links = [
            (a[i], b[j])
            for i in range(len(a))
            for j in range(int(np.searchsorted(end_b, end_a[i] - size_a[i], "right")), len(b))
            if end_b[j] - size_b[j] < end_a[i]
        ]
        groups, i, j = [], 0, 0
        for e in sorted(set(end_a.tolist()) & set(end_b.tolist())):
            p, q = int(np.searchsorted(end_a, e)) + 1, int(np.searchsorted(end_b, e)) + 1
            groups.append(f"{','.join(map(str, a[i:p]))}|{','.join(map(str, b[j:q]))}")
            i, j = p, q
        found.append((len(a), len(b), groups, links))
        holds.update(set(links))
    highest = {}
    for (a, _), n in holds.items():
        highest[a] = max(n, highest.get(a, 0))
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), sum(holds[x] == highest[x[0]] for x in links), sum(holds[x] for x in links), digest))
    return out


PARTS = ["a", "It's", "'s", "  ", " ", " ", " ", "\n", "\n\n", " \n", "\t", "é", "ñ.", ",", "...", "12", "3.5", "word", "words", "<|endoftext|>", "<s>", "</s>", "日本", "ﬁ", "\x1c", "'ll", "A.", "b,\nC", "###", "x_y", "\x01", "\x02", "😀", "naïve", "Straße", "the", "The"]


def texts_of(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(n)] + ["▁", "a▁b", "a ▁", " ", "x " * 50]


def row(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


@pytest.mark.parametrize("chunk_chars", [60, 2_000_000])
def test_alignment_equals_the_plain_way(spark, corpus, none, monkeypatch, chunk_chars):
    monkeypatch.setattr(crosstoken, "CHUNK_CHARS", chunk_chars)
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts_of(150, 8))], "doc_id long, text string")
    docs = corpus.unionByName(odd, allowMissingColumns=True).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = Counter((d, *w) for (d, _), w in zip(rows, plain([t for _, t in rows]), strict=True))
    got = crosstoken.align_tokenizers(docs).collect()
    assert Counter((r.doc_id, *row(r)) for r in got) == want
    if chunk_chars > 60:
        assert crosstoken.align_tokenizers(none).collect() == []


def test_cut_texts_have_the_ids_of_whole_texts():
    texts = texts_of(3000, 5)
    work = crosstoken.Aligner(tokenids.default_tokenizer(), crosstoken.default_pieces())
    for enc in (work.a, work.b):
        for _ in range(2):
            assert enc.encode([" " + t for t in texts]) == [enc.whole(" " + t) for t in texts]
