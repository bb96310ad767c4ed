"""MinHash near-dedup and components against all pairs."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from surveypulse.llm import minhash
from surveypulse.llm.components import components
from surveypulse.llm.minhash import minhash_dedup, shingles


def groups(links):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return find


def brute(rows, size, similar):
    sets = [(r[0], shingles(r[1], size)) for r in rows if r[0] is not None]
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= similar * (len(a) + len(b) - both):
                links.append((i, j))
    find = groups(links)
    out = []
    for r in rows:
        part = None if r[0] is None else find(r[0])
        out.append((r[0], len(shingles(r[1], size)), part, r[0] is None or part == r[0]))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 120)]
    star = [(500, 500 + i) for i in range(1, 200)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    links = [(a, b) for a, b in chain + star + loose if a != b]
    got = dict(map(tuple, components(spark.createDataFrame(links, "u long, v long")).collect()))
    find = groups(links)
    assert got == {x: find(x) for e in links for x in e}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def near_rows():
    """A text with copies that differ from it in few and in many places, and copies of copies."""
    rng = random.Random(9)
    text = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        copy = list(text)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((100 - i, " ".join(copy)))
    last = text
    for i in range(12):  # each near the one before only
        last = last[4:] + [f"y{i}{k}" for k in range(4)]
        rows.append((200 + i, " ".join(last)))
    return rows


@pytest.mark.parametrize("rounds", [1, 2, 3])
def test_near_copies(spark, monkeypatch, rounds):
    monkeypatch.setattr(minhash, "ROUNDS", rounds)
    rows = near_rows()
    got = minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), size=3, similar=85)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, 3, 85))


def test_corpus(stored, nothing, nulls):
    rows = [tuple(r) for r in stored.collect()]
    got = minhash_dedup(stored)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, 5, 80), key=key)
    assert minhash_dedup(nothing).count() == 0
    assert [tuple(r) for r in minhash_dedup(nulls).collect()] == [(None, 0, None, True)] * 3


@pytest.mark.parametrize("similar", [80, 85])
def test_signature_test_drops_next_to_nothing(spark, similar):
    """Of pairs at the asked similarity fewer than one in ten million, by exact fractions; a signature
    with just enough equal minima stays."""
    n, p = minhash.BANDS * minhash.ROWS, Fraction(similar, 100)
    least = minhash.least_agreeing(similar, n)
    miss = [sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k)) for k in (least, least + 1)]
    assert miss[0] < Fraction(1, 10**7) <= miss[1]
    sigs = [np.zeros(n, np.uint32), np.arange(n, dtype=np.uint32) >= least, np.arange(n, dtype=np.uint32) >= least - 1]
    classes = spark.createDataFrame([(i, bytearray(s.astype(np.uint32).tobytes())) for i, s in enumerate(sigs)], "id long, sig binary")
    pairs = spark.createDataFrame([(0, 1), (0, 2)], "a long, b long")
    assert [tuple(r) for r in minhash.agreeing(pairs, classes, least / n).collect()] == [(0, 1)]


def test_an_id_with_several_texts_is_one_document_in_any_row_order(spark):
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words[:200]), " ".join(words[200:])
    rows = [(1, a), (1, b), (5, b + " more"), (6, a + " more"), (9, "alone here with no one near"), (3, None), (3, a)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        got = minhash_dedup(spark.createDataFrame(order, "doc_id long, text string")).collect()
        assert sorted((r.doc_id, r.n_shingles > 0, r.component_id) for r in got) == [
            (1, True, 1), (1, True, 1), (3, False, 3), (3, True, 1), (5, True, 1), (6, True, 1), (9, True, 9)]
