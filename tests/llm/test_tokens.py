"""BPE against the tokenizers library; packing against the library and the rules of a packing."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from surveypulse.llm import packing
from surveypulse.llm.bpe import ByteBpe, bpe_encode
from surveypulse.llm.common import tokenizer_file
from surveypulse.llm.packing import best_fit_packing, best_plan, configurations, packing_plan

BYTES, WORDS = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("word_bpe_49k.json")


def library(file):
    t = Tokenizer.from_str(file)
    t.no_truncation()
    t.no_padding()
    return t


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_on_odd_texts():
    rng = random.Random(1)
    parts = ["a", "aa", "the", "é", "́", " ", "  ", "\n", "\x1c", "\x85", " ", "'s", "'ll", "1", "²", "漢", "😀", "<|endoftext|>", "_", "\t", "S", "\x00"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(1500)] + ["a" * 5000, "aaaab" * 99, "", " " * 500]
    mine, ref = ByteBpe(BYTES), library(BYTES)
    for found, e in zip(mine.block(texts), ref.encode_batch(texts, add_special_tokens=False), strict=True):
        assert mine.ids(found) == e.ids
        assert mine.decode(e.ids) == ref.decode(e.ids, skip_special_tokens=False)
    assert mine.decode([0, 200, 150, 50256]) == ref.decode([0, 200, 150, 50256], skip_special_tokens=False)


def test_bpe_query(stored, nothing, nulls):
    ref, expected = library(BYTES), []
    for r in stored.collect():
        ids = ref.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(ref.decode(ids, skip_special_tokens=False)), tuple(ids)))
    got = Counter((*tuple(r)[:4], tuple(r.ids)) for r in bpe_encode(stored, BYTES, ids_out=True).collect())
    assert got == Counter(expected)
    assert bpe_encode(nothing, BYTES).count() == 0
    assert [tuple(r) for r in bpe_encode(nulls, BYTES).collect()] == [(None, 0, sha(""), sha(""))] * 3


def sound(rows, capacity):
    """No gap, no overlap, no sequence too long; the number of sequences."""
    fill = {}
    for sequence, offset, length in sorted(rows):
        assert offset == fill.get(sequence, 0)
        fill[sequence] = offset + length
        assert fill[sequence] <= capacity
    return len(fill)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(stored, nothing, nulls, capacity):
    ref, expected = library(WORDS), Counter()
    for r in stored.collect():
        ids = np.array([*ref.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k in range(0, len(ids), capacity):
            expected[r.doc_id, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(ids[k : k + capacity].tobytes())] += 1
    got = best_fit_packing(stored, WORDS, capacity=capacity).collect()
    assert Counter(tuple(r)[:5] for r in got) == expected
    n = sound([(r.sequence_id, r.offset, r.length) for r in got], capacity)
    assert n <= 1.06 * sum(r.length for r in got) / capacity + 2
    assert best_fit_packing(nothing, WORDS).count() == 0
    assert sorted(r.offset for r in best_fit_packing(nulls, WORDS).collect()) == [0, 1, 2]


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(3, 300))
    hist = np.zeros(capacity + 1, np.int64)
    np.add.at(hist, rng.integers(1, capacity + 1, rng.integers(0, 2000)), 1)
    p = packing_plan(hist, capacity, small=capacity // 4, groups=6)
    runs = list(zip(*(p[c].tolist() for c in ("length", "rank", "n", "sequence", "offset")), strict=True))
    assert sound([(s + i, o, n) for n, _, k, s, o in runs for i in range(k)], capacity) == p["sequences"]
    for n in range(capacity + 1):
        ranks = sorted((r, k) for m, r, k, *_ in runs if m == n)
        assert sum(k for _, k in ranks) == hist[n]
        assert all(a + k == b for (a, k), (b, _) in zip(ranks, ranks[1:], strict=False)) and (not ranks or ranks[0][0] == 0)


@pytest.mark.parametrize("seed", range(3))
def test_no_worse_than_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(1, 2049, 400), np.minimum(rng.geometric(1 / 300, 3000), 2048)])
    gaps = []
    for n in sorted(lengths.tolist(), reverse=True):
        i = min((i for i, g in enumerate(gaps) if g >= n), key=gaps.__getitem__, default=None)
        if i is None:
            gaps.append(2048 - n)
        else:
            gaps[i] -= n
    hist = np.bincount(lengths, minlength=2049)
    assert best_plan(hist)["sequences"] <= len(gaps)


def test_words_by_parts():
    """Words by themselves, in parts and all at once have the library's ids."""
    words = packing.WordTokens(WORDS)
    assert words.parts is not None
    texts = ["Don't STOP's 12a3 ''re'sx a--b%%% [UNK] </w> ~", "  x\x7f\x01y \x1cz ſt K İ é́ don\u2019t", "", None, "a\u0085b\u2003c 漢字1²", "Don't " * 3]
    ref = library(WORDS)
    for _ in range(2):  # learnt, then known
        flat, at = words.encode(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [ref.encode(t or "", add_special_tokens=False).ids for t in texts]
    words.ends[:] = False  # as if no token marked the end of a part
    words.reset()
    flat, at = words.encode(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [ref.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_configurations_are_best():
    """Halves and thirds fill sequences whole."""
    plan = configurations(np.array([50, 34, 33]), np.array([10, 7, 14]), 100)
    assert sum(t for t, _ in plan) == 12
    assert sum(t * c for t, c in plan).tolist() == [10, 7, 14]
