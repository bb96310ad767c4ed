"""LM scoring: the base against plain counting, the model by its sums and on held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from surveypulse.llm.minhash import LOWER
from surveypulse.llm import scoring
from surveypulse.llm.common import written
from surveypulse.llm.exchange import questions
from surveypulse.llm.scoring import lm_scores


def tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), b"\n"]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def test_base(stored, nothing, nulls):
    rows = [(r.doc_id, tokens(r.text)) for r in stored.collect()]
    c = Counter(w for i, ws in rows if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    expected = Counter((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in rows)
    got = lm_scores(stored, least=3, sweeps=2, bucket_bytes=500).collect()
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == expected
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert lm_scores(nothing, sweeps=1).count() == 0
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in lm_scores(nulls, sweeps=1).collect()] == [(1, 1, 3)] * 3


def test_probabilities_sum_to_one(spark):
    """Texts of one word: their probabilities, those of all longer ones left out, are
    P(x | start) P(end | x). Without pairs in training all symbols follow alike, so the sum over all
    words, seen and one unseen, is P(end) * P(any word)."""
    ids = iter(i for i in range(10**6) if held(i))
    words = [f"w{i}" for i in range(25)]
    probes = [(next(ids), w) for w in [*words, "unseen", ""]]
    train_ids = iter(i for i in range(10**6) if not held(i))
    docs = [(next(train_ids), w) for w in words for _ in range(1 + int(w[1:]) % 5)]
    df = spark.createDataFrame(docs + probes, "doc_id long, text string")
    p = {r.doc_id: 10**r.score for r in lm_scores(df, least=5, sweeps=0).collect()}
    end = p[probes[-1][0]]  # no sweeps: all symbols follow alike
    assert sum(p[i] for i, w in probes[:-1]) == pytest.approx(end * (1 - end), rel=0.02)


def walks(seed, n=400):
    rng = random.Random(seed)

    def walk():
        at, out = rng.randrange(30), []
        for _ in range(40):
            at = (at + rng.choice([1, 1, 1, 7])) % 30
            out.append(f"w{at}" if rng.random() < 0.95 else f"rare{rng.randrange(10**6)}")
        return " ".join(out)

    return [(i, walk()) for i in range(n)]


def counted(spark, rows, blocks, held_pairs, monkeypatch):
    monkeypatch.setattr(scoring, "HELD_PAIRS", held_pairs)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = {scoring.END_WORD: scoring.END} | {f"w{i}".encode(): i + 2 for i in range(30)}
    sent = written(questions(df, "text", scoring.asking(3), 20_000))
    return scoring.pair_counts(sent, known, 32, blocks)


def test_pairs_are_counted_whole_and_blocks_do_not_matter(spark, monkeypatch):
    rows = walks(1)
    true = Counter()
    for i, text in rows:
        if not held(i):
            at = [1, *(1 if w == b"\n" else int(w[1:]) + 2 if w[:1] == b"w" else 0 for w in tokens(text))]
            true.update(zip(at, at[1:], strict=False))
    vectors = []
    for blocks, held_pairs in ((1, 1 << 22), (7, 50)):
        tables = counted(spark, rows, blocks, held_pairs, monkeypatch)
        for table, turned in zip(tables, (False, True), strict=True):
            got = Counter()
            for r in table.collect():
                for code, n in zip(*scoring.unpacked(r.pairs, r.n), strict=True):
                    row, column = divmod(int(code), 32)
                    got[(column, row) if turned else (row, column)] += int(n)
            assert got == true
        count = np.array([sum(c for (_, w), c in true.items() if w == k) for k in range(32)])
        vectors.append(scoring.train(*tables, count, size=8, sweeps=3))
    for a, b in zip(*vectors, strict=True):
        assert a == pytest.approx(b, abs=1e-3)
    q, r = vectors[0]
    z = scoring.log_sums(spark, q, r, wide=5)
    every = np.arange(32)
    p = np.array([scoring.log_probabilities(np.full(32, c), every, q, r, z) for c in every])
    assert (10.0**p).sum(1) == pytest.approx(np.ones(32))
    share = np.log10((count + 1) / (count.sum() + 32))
    assert sum(n * p[c, w] for (c, w), n in true.items()) > 0.7 * sum(n * share[w] for (_, w), n in true.items())


def test_noise_is_drawn_by_share():
    found, weight = scoring.drawn(np.array([0, 50.0, 25, 25, 0]), 400, 3)
    assert found.tolist() == [1, 2, 3] and weight == pytest.approx([0.5, 0.25, 0.25], abs=0.01)


def test_long_words_are_symbols_by_digest(spark):
    """A word of any length that is frequent enough has its own symbol: order of such words counts."""
    a, b = "x" * 5000, "y" * 17
    rows = [(i, " ".join([a, b] * 20)) for i in range(40)] + [(1000 + i, t) for i in range(40) for t in (f"{a} {b} {a} {b}", f"{a} {a} {b} {b}")]
    got = lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert max(r.score for r in got if r.n_tokens == 5) > min(r.score for r in got if r.n_tokens == 5) + 0.5


def test_beats_the_base_on_held_out_texts(spark):
    df = spark.createDataFrame(walks(5), "doc_id long, text string")
    got = [r for r in lm_scores(df).collect() if r.held_out]
    assert len(got) > 20 and sum(r.score for r in got) > 0.75 * sum(r.base_score for r in got)
