"""Row-order operators against plain Python on random series cut into chunks of every size."""

import random

import pytest
from survey_helpers import rows

from surveypulse.functions.clock import seconds_of_day
from surveypulse.operators import series
from pyspark.sql import functions as F

SETS = {"one": ["a"], "two": ["a", "b"], "dead": ["c"], "mixed": ["b", "c"]}
SCHEMA = "k INT, i BIGINT, t DOUBLE, a DOUBLE, b DOUBLE, c DOUBLE"


def table(seed, n=400):
    """Key 1 holds most rows; key 2 has no value in ``b``; times are missing now and then."""
    rng = random.Random(seed)
    data, a, b = [], False, False
    for i in range(n):
        key = rng.choice([1, 1, 1, 1, 2, 3])
        a, b = (not a if rng.random() < 0.2 else a), (not b if rng.random() < 0.1 else b)
        time = None if rng.random() < 0.05 else i / 10
        data.append((key, i, time, None if a else 1.0, None if b or key == 2 else 2.0, None))
    return data


def expected_gaps(data):
    found = []
    for key in {r[0] for r in data}:
        mine = [r for r in data if r[0] == key]
        for name, channels in SETS.items():
            at = [3 + "abc".index(c) for c in channels]
            live = [c for c in at if any(r[c] is not None for r in mine)]
            if not live:
                continue
            start, count = None, 0
            for r in mine:
                gap = any(r[c] is None for c in live)
                if gap:
                    start, count = (r, 1) if start is None else (start, count + 1)
                elif start is not None:
                    found.append((key, name, start[2], r[2], count))
                    start = None
            if start is not None:
                found.append((key, name, start[2], mine[-1][2], count))
    return sorted(found, key=lambda t: tuple((v is None, str(type(v)), v) for v in t))


@pytest.mark.parametrize("seed,chunk_rows", [(1, 1), (2, 2), (3, 7), (4, 50), (5, 1000)])
def test_gaps(spark, seed, chunk_rows):
    data = table(seed)
    shuffled = data[:]
    random.Random(seed).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, SCHEMA).withColumn("chunk", series.chunk_of("i", chunk_rows))
    found = series.gap_intervals(df, ["k"], "chunk", "i", "t", SETS)
    assert rows(found, "k", "plot_set", "t_start", "t_end", "n_rows") == expected_gaps(data)


@pytest.mark.parametrize("chunk_rows", [1, 9, 1000])
def test_rank_and_first(spark, chunk_rows):
    data = table(9)
    df = spark.createDataFrame(data[::-1], SCHEMA).withColumn("chunk", series.chunk_of("i", chunk_rows))
    expected = []
    for key in (1, 2, 3):
        expected += [(key, r[1], n) for n, r in enumerate((r for r in data if r[0] == key), 1)]
    assert rows(series.ordered_rank(df, ["k"], "chunk", "i"), "k", "i", "rank") == sorted(expected)
    first = [(key, next(r[2] for r in data if r[0] == key and r[2] is not None)) for key in (1, 2, 3)]
    assert rows(series.first_valid(df, ["k"], "chunk", "i", "t"), "k", "first_value") == first
    elapsed = rows(series.with_elapsed(df, ["k"], "chunk", "i", "t"), "i", "time_sec")
    start = dict(first)
    assert elapsed == [(r[1], None if r[2] is None else r[2] - start[r[0]]) for r in data]


def test_gaps_with_many_sessions(spark, monkeypatch):
    """The same when the table of live channels is too long to broadcast."""
    monkeypatch.setattr(series.join_sized, "__defaults__", ("left", (), 0, None))
    data = table(6)
    df = spark.createDataFrame(data, SCHEMA).withColumn("chunk", series.chunk_of("i", 20))
    found = series.gap_intervals(df, ["k"], "chunk", "i", "t", SETS)
    assert "strategy=broadcast" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found, "k", "plot_set", "t_start", "t_end", "n_rows") == expected_gaps(data)


def test_time_of_day(spark):
    values = [143433.6, 0.0, 235959.999, 990000.0, 9999.5, None, -5.0, -123456.5, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "t DOUBLE").select("t", seconds_of_day(F.col("t")).alias("s"))
    for t, s in df.collect():
        assert s == (None if t is None else int(t / 10000) * 3600 + int(t % 10000 / 100) * 60 + t % 100)
