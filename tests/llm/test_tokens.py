"""Operators 5 and 10: encoder, blocks, files, packing."""

import math
import random
import zlib
from array import array
from collections import Counter
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import packing, pfor, tokenids


def ids_of(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenids.default_tokenizer())
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_library():
    r = random.Random(3)
    parts = ["a", "It's", "'s", "  ", " ", "\n", "\n\n", " \n", "\t", "é", "ñ.", ",", "...", "12", "3.5", "word", "<|endoftext|>", " ", "　", "日本", "\x1c", "'ll", "A.", "b,\nC"]
    texts = ["", " ", "x "] + ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    enc = tokenids.PieceEncoder(tokenids.default_tokenizer())
    for _ in range(2):  # the second time from the cache
        assert enc.encode(texts) == [array("I", x).tobytes() for x in ids_of(texts)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 70), st.integers(0, 2**32 - 1)), max_size=3000))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    payload, starts = pfor.encode_blocks(ids)
    assert (pfor.decode_blocks(payload, starts) == ids).all()
    if len(starts) > 1:  # one block alone
        assert (pfor.decode_blocks(payload, starts[:1]) == ids[: pfor.BLOCK_IDS]).all()


def test_token_files(spark, corpus, none, tmp_path):
    path = f"file://{tmp_path}/tokens"
    pfor.write_token_files(corpus, path, end_id=2)
    rows = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in corpus.select("doc_id", "text").collect())
    want, at = Counter(), 0
    for (has, key, _), ids in zip(rows, ids_of([t for *_, t in rows]), strict=True):
        raw = np.array([*ids, 2], "<u4")
        want[key if has else None, at, len(raw), zlib.crc32(raw.tobytes())] += 1
        at += len(raw)
    got = pfor.read_token_files(spark, path).collect()
    assert Counter(map(tuple, got)) == want
    assert sorted(len(r.ids) for r in pfor.read_ids(spark, path).collect()) == sorted(n for _, _, n, _ in want.elements())
    pfor.write_token_files(none, path + "-empty", end_id=2)
    assert pfor.read_token_files(spark, path + "-empty").count() == 0


def fewest(sizes, capacity):
    """The least number of sequences, by trying all sets with the largest."""
    if not sizes:
        return 0
    first, rest = sizes[0], sizes[1:]
    best = len(sizes)
    for k in range(len(rest) + 1):
        for pick in combinations(range(len(rest)), k):
            if first + sum(rest[i] for i in pick) <= capacity:
                best = min(best, 1 + fewest([s for i, s in enumerate(rest) if i not in pick], capacity))
    return best


def test_dominance_keeps_a_best_packing():
    r = random.Random(5)
    for _ in range(150):
        sizes = sorted((r.randint(1, 20) for _ in range(r.randint(1, 7))), reverse=True)
        fixed, left = packing.reduce_by_dominance(Counter(sizes), 20)
        rest = sorted(Counter(left).elements(), reverse=True)
        assert sum(t for t, _ in fixed) + fewest(rest, 20) == fewest(sizes, 20)
        for times, content in [*fixed, *packing.best_fit(left, 20)]:
            assert times > 0 and sum(s * k for s, k in content) <= 20


def test_packing(corpus, none):
    got = packing.pack_documents(corpus, seq_len=256).collect()
    want = Counter()
    rows = corpus.select("doc_id", "text").collect()
    for r, ids in zip(rows, ids_of([r.text or "" for r in rows]), strict=True):
        raw = np.array([*ids, 0], "<u4")
        at, stop, piece = 0, (len(raw) - 1) % 256 + 1, 0
        while at < len(raw):
            want[r.doc_id, piece, at, stop - at, zlib.crc32(raw[at:stop].tobytes())] += 1
            at, stop, piece = stop, stop + 256, piece + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.1 * math.ceil(sum(r.length for r in got) / 256) + 1
    assert packing.pack_documents(none).count() == 0
