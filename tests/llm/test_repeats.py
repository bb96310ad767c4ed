"""Substring and suffix-array dedup against counting all windows in dictionaries."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from surveypulse.llm import suffixes
from surveypulse.llm.substring_dedup import smallest, substring_dedup
from surveypulse.llm.suffix_dedup import suffix_dedup


def brute_words(rows, window=13):
    ids = [(float("inf") if r[0] is None else r[0], (r[1] or "").encode().split()) for r in rows]
    least = {}
    for i, w in ids:
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            least[k] = min(i, least.get(k, i))
    out = []
    for (i, w), r in zip(ids, rows, strict=True):
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if least[tuple(w[a : a + window])] < i:
                gone[a : a + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def brute_bytes(rows, length):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    count = Counter(b[a : a + length] for _, b in texts for a in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if count[b[a : a + length]] > 1:
                gone[a : a + length] = b"\1" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("bucket_bytes", [1 << 22, 500])
def test_substring(stored, bucket_bytes):
    rows = [tuple(r) for r in stored.collect()]
    same(substring_dedup(stored, bucket_bytes=bucket_bytes), brute_words(rows))


def test_substring_text(stored):
    rows = [tuple(r) for r in stored.collect()]
    expected = Counter((i, n, gone) for i, n, gone, _ in brute_words(rows))
    out = substring_dedup(stored, keep=True)
    assert out.columns == [*stored.columns, "_n_words", "_n_removed"]
    got = out.collect()
    assert Counter((r.doc_id, r._n_words, r._n_removed) for r in got) == expected
    kept = Counter((i, k) for i, _, _, k in brute_words(rows))
    assert Counter((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in got) == kept
    assert all(r.text == t for r in got for i, t, *_ in rows if r.doc_id == i and not r._n_removed)


@pytest.mark.parametrize(("length", "bucket_bytes"), [(200, 1 << 22), (64, 700)])
def test_suffixes(stored, length, bucket_bytes):
    rows = [tuple(r) for r in stored.collect()]
    same(suffix_dedup(stored, length=length, bucket_bytes=bucket_bytes, chunk_bytes=4000), brute_bytes(rows, length))


def test_empty_and_null(nothing, nulls):
    none = hashlib.sha256(b"").hexdigest()
    assert substring_dedup(nothing).count() == suffix_dedup(nothing).count() == 0
    same(substring_dedup(nulls), [(None, 0, 0, none)] * 3)
    same(suffix_dedup(nulls), [(None, 0, 0, 0, none)] * 3)


def test_windows_with_one_hash(monkeypatch):
    """Different windows whose hashes agree are still told apart."""
    lines = [b"a b c d", b"b c d e", b"a b c d", b"x y z w"]
    expected, _ = smallest(3, np.array([4, 3, 2, 1]), lines)
    monkeypatch.setattr("surveypulse.llm.substring_dedup.Ranges.of", lambda self, s, e: np.zeros(len(s), np.uint64))
    got, _ = smallest(3, np.array([4, 3, 2, 1]), lines)
    assert got.tolist() == expected.tolist() == [2, 2, 2, 3, 2, 2, 1, 1]


@pytest.mark.parametrize("few", [600, 0])
def test_suffix_array(monkeypatch, few):
    monkeypatch.setattr(suffixes, "FEW", few)
    rng = np.random.default_rng(3)
    for k in range(300):
        s = np.append(rng.integers(1, rng.choice([2, 3, 20]), rng.integers(0, 50)), 0)
        if k % 3 == 0:
            s = np.concatenate([s[:-1], s[:-1], s])
        order = suffixes.suffix_array(s, int(s.max()))
        assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        end = np.full(len(s), len(s))
        before, shared = suffixes.common_prefixes(s, order, end)
        for i in range(len(s)):
            j, n = before[i], 0
            while j >= 0 and max(i, j) + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            assert shared[i] == n
