import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex

from surveypulse.llm import divergence
from surveypulse.llm.queries import ORACLE

TERM = regex.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, least, best):
    """docs: (lang, source, text)"""
    groups, langs, held = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        groups[lang, source].update(terms)
        langs[lang].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t in held[lang] if held[lang][t] >= least]

        def prices(counts, kept=kept):
            whole = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // whole for t in kept}

        p, q = {s: prices(groups[lang, s]) for x, s in groups if x == lang}, prices(langs[lang])
        for s in p:
            pair = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in p if o != s]
            term = [(p[s][t] - q[t], t) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, rows, limit in (("pair", pair, len(pair)), ("term", term, best)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, f, i + 1) for i, (f, item) in enumerate(rows[:limit])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(7)
    words = [a + b for a in "kü lo MÄ si Ōr ba" .split() for b in "n re TO é x".split()] + ["it's", "a1b2"]
    rows = [(rng.choice(["en", "en", "de", None, ""]), rng.choice(["hot", "hot", "s1", "s2", None, "é", "z"]),
             " ".join(rng.choices(words, k=rng.randrange(60)))) for _ in range(150)]
    rows += [("fr", "only", "a b"), ("it", "a", None), ("it", "b", ""), ("it", "b", "12 34"), *[rows[0]] * 4]
    return rows


@pytest.mark.parametrize(("least", "best", "shard", "block"), [(30, 50, 1 << 16, 8), (5, 3, 4, 2), (1, 50, 7, 1)])
def test_brute_force(spark, texts, least, best, shard, block):
    df = spark.createDataFrame(texts, "lang string, source string, text string").repartition(4)
    df = df.selectExpr("*", "1 AS term", "2 AS n", "3 AS value", "4 AS index", "5 AS _row")
    assert found(divergence.source_divergence(df, least, best, shard, block)) == brute(texts, least, best)


def test_sql(stored):
    con = duckdb.connect()
    con.register("documents", stored.toArrow())
    names = "lang, source, part, item, value, rank"
    want = con.sql(f"SELECT {names} FROM ({divergence.oracle(3, 4)})").fetchall()
    assert found(divergence.source_divergence(stored, 3, 4)) == sorted(want)
    assert ORACLE["op12_source_divergence"] == divergence.oracle()


def test_partial_counts(spark, texts, monkeypatch):
    whole = found(divergence.source_divergence(spark.createDataFrame(texts, "lang string, source string, text string"), 5))
    assert whole == brute(texts, 5, 50)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({c: [r[i] for r in texts] for i, c in enumerate(("lang", "source", "text"))})
    sums = []
    for held in (10**6, 40):
        monkeypatch.setattr(divergence, "HELD", held)
        total = Counter()
        parts = list(divergence._counted([batch]))
        for part in parts:
            for lang, source, term, n, docs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                total[lang, source, term] += n + 10**6 * docs
        sums.append(total)
    assert len(parts) > 1 and sums[0] == sums[1]


def test_empty_and_null_rows(nothing, nulls):
    assert found(divergence.source_divergence(nothing)) == []
    assert found(divergence.source_divergence(nulls)) == []


def test_prices_are_exact():
    counts = np.array([0, 1, 17, 10**6, 8 * 10**15 - 10], np.int64)
    for whole in (7, 10**6 + 3, 8 * 10**15 + 1):
        small = counts[counts + 5 <= whole]
        assert divergence.price(small, whole).tolist() == [1 + 10**9 * (int(c) + 5) // whole for c in small]


def test_gallop():
    rng = np.random.default_rng(5)
    for _ in range(500):
        a, b = np.unique(rng.integers(0, 300, rng.integers(0, 40))), np.unique(rng.integers(0, 300, rng.integers(0, 200)))
        x, y = divergence.gallop(a, b)
        assert a[x].tolist() == np.intersect1d(a, b).tolist() == b[y].tolist()
