"""Sessions as flown, lines, corrections, grids, export: against plain Python on random series."""

import bisect
import math
import random

import pytest
from pyspark.sql import functions as F
from survey_helpers import rows

from surveypulse.operators import asof, flight, grid, radiometric, series
from surveypulse.sources import survey_text, xyz
from surveypulse.streaming import log_facts


def numbers(rng, n, missing=0.3):
    return [None if rng.random() < missing else round(rng.uniform(0, 360), 2) for _ in range(n)]


def framed(spark, tracks, chunk_rows, name="v", kind="double"):
    """One row per value of each track, with its chunk."""
    data = [(k, i, v) for k, values in tracks.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"k string, i long, {name} {kind}").repartition(3)
    return df.withColumn("chunk", series.chunk_of("i", chunk_rows))


@pytest.fixture(scope="module")
def tracks():
    rng = random.Random(11)
    return {"hot": numbers(rng, 300), "short": numbers(rng, 3, 0), "none": [None] * 7, "late": [None] * 9 + numbers(rng, 20, 0), "one": [5.0]}


@pytest.mark.parametrize("chunk_rows", [1, 2, 7, 1000])
def test_previous_filled_and_counted(spark, tracks, chunk_rows):
    df = framed(spark, tracks, chunk_rows)
    want_previous, want_filled, want_before, want_count = [], [], [], []
    for k, values in tracks.items():
        last, count = None, 0
        for i, v in enumerate(values):
            want_previous.append((k, i, values[i - 1] if i else None))
            want_before.append((k, i, last))
            last = v if v is not None else last
            count += v is not None and v > 180
            want_filled.append((k, i, last))
            want_count.append((k, i, count))
    key = lambda t: t[:2]
    found = lambda d, c: sorted((tuple(r) for r in d.select("k", "i", c).collect()), key=key)
    assert found(series.with_previous(df, ["k"], "chunk", "i", ["v"]), "previous_v") == sorted(want_previous, key=key)
    assert found(series.filled_forward(df, ["k"], "chunk", "i", "v", "f"), "f") == sorted(want_filled, key=key)
    assert found(series.filled_forward(df, ["k"], "chunk", "i", "v", "f", before=True), "f") == sorted(want_before, key=key)
    assert found(series.running_count(df, ["k"], "chunk", "i", F.col("v") > 180, "n"), "n") == sorted(want_count, key=key)


def segments(headings, turn_from, line_below):
    known, turning, number, out = None, False, 0, []
    for h in headings:
        before = turning
        if h is not None and known is not None:
            change = abs((h - known + 180) % 360 - 180)
            turning = True if change >= turn_from else False if change <= line_below else turning
        known = h if h is not None else known
        number += not out or turning != before
        out.append((turning, number))
    return out


@pytest.mark.parametrize("chunk_rows", [1, 3, 10, 1000])
def test_turns_are_the_same_for_any_chunks(spark, tracks, chunk_rows):
    df = framed(spark, tracks, chunk_rows)
    got = flight.with_segments(df, ["k"], "chunk", "i", "v", 100.0, 40.0)
    want = [(k, i, *s) for k, values in tracks.items() for i, s in enumerate(segments(values, 100, 40))]
    assert rows(got, "k", "i", "in_turn", "segment") == sorted(want)
    lines = rows(flight.flight_lines(got, ["k"], "i", "i", "v", least_rows=2).where("line IS NOT NULL"), "k", "line")
    per_key = {}
    for k, line in lines:
        per_key.setdefault(k, []).append(line)
    assert all(v == list(range(1, len(v) + 1)) for v in per_key.values())


@pytest.mark.parametrize("first", [True, False, None])
def test_a_state_that_the_first_row_sets(spark, first):
    steps = [first, None, True, True, None, False, False, True]
    df = framed(spark, {"a": steps}, 2, "s", "boolean")
    state, number, want = False, 0, []
    for i, s in enumerate(steps):
        now = state if s is None else s
        number += i == 0 or now != state
        state = now
        want.append((i, state, number))
    assert rows(series.with_state(df, ["k"], "chunk", "i", "s", F.lit(False), "state", "n"), "i", "state", "n") == want


def test_mean_heading_on_the_circle(spark):
    df = framed(spark, {"a": [350.0, 10.0, 5.0, 355.0]}, 2).withColumns({"in_turn": F.lit(False), "segment": F.lit(1)})
    mean = flight.flight_lines(df, ["k"], "i", "i", "v").first()["mean_heading"]
    assert min(mean, 360 - mean) < 1e-9


def test_course(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 0.0), (1.0, 1.0, 0.0, 0.0), (2.0, 2.0, 2.0, 2.0)], "a double, b double, x double, y double")
    found = [r[0] for r in df.select(flight.course(*map(F.col, "xyab"))).collect()]
    assert found[:3] == [pytest.approx(0), pytest.approx(90), pytest.approx(225)] and found[3] is None


@pytest.mark.parametrize("chunk_rows", [1, 4, 1000])
def test_midnight_and_pauses(spark, chunk_rows):
    seconds = [86398.0, None, 86399.5, 0.5, None, 1.0, 40000.0, 86000.0, 3.0]
    df = framed(spark, {"a": seconds}, chunk_rows)
    days = flight.unwrapped(df, ["k"], "chunk", "i", "v")
    assert [r[1] for r in rows(days, "i", "abs_sec")] == [86398.0, None, 86399.5, 86400.5, None, 86401.0, 126400.0, 172400.0, 172803.0]
    parts = flight.split_sessions(days, ["k"], "chunk", "i", "abs_sec", 10000.0)
    assert [r[1] for r in rows(parts, "i", "part")] == [1, 1, 1, 1, 1, 1, 2, 3, 3]


def test_merge_and_first_source(spark):
    spans = [("a", 1, 0.0, 10.0), ("a", 2, 8.0, 20.0), ("a", 3, 25.0, 30.0), ("a", 4, 26.0, 27.0), ("a", 5, 100.0, 101.0), ("b", 1, 5.0, 6.0), ("b", 2, None, 7.0)]
    df = spark.createDataFrame(spans, "k string, s int, lo double, hi double")
    assert rows(flight.merge_sessions(df, ["k"], "lo", "hi", 5.0), "k", "s", "merged") == [
        ("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("a", 4, 1), ("a", 5, 2), ("b", 1, 1), ("b", 2, None)]
    rng = random.Random(2)
    points = [(rng.choice("ab"), rng.randrange(1, 6), rng.choice([None, rng.uniform(-5, 110)]), i) for i in range(200)]
    at = spark.createDataFrame(points, "k string, s int, t double, i int")
    for width in (3.0, 1000.0):
        kept = rows(flight.first_source(at, df, ["k"], "s", "t", "lo", "hi", width), "i")
        want = [i for k, s, t, i in points if t is None or not any(
            k == c and o < s and lo is not None and lo <= t <= hi for c, o, lo, hi in spans)]
        assert [r[0] for r in kept] == want


@pytest.mark.parametrize(("bucket", "gap", "outside"), [(5.0, None, "missing"), (40.0, 6.0, "missing"), (0.7, 9.0, "nearest"), (1e6, None, "nearest")])
def test_interpolation(spark, bucket, gap, outside):
    rng = random.Random(4)
    base = [("a", round(rng.uniform(0, 100), 1), rng.uniform(-5, 5)) for _ in range(60)] + [("a", 50.0, 1.0), ("a", 50.0, 3.0), ("a", None, 9.0), ("a", 3.0, None)]
    asked = [("a", t, i) for i, t in enumerate([-3.0, 0.0, 50.0, None, 99.9, 130.0, *[round(rng.uniform(0, 100), 1) for _ in range(80)]])] + [("none", 5.0, 500)]
    times = {}
    for _, t, v in base:
        if t is not None and v is not None:
            times.setdefault(t, []).append(v)
    known = sorted((t, sum(v) / len(v)) for t, v in times.items())

    def at(k, t):
        if t is None or k == "none":
            return None
        i = bisect.bisect_right(known, (t, math.inf))
        before, after = known[i - 1] if i else None, known[i] if i < len(known) else None
        if before and before[0] == t:
            return before[1]
        if before and after:
            return before[1] + (after[1] - before[1]) * (t - before[0]) / (after[0] - before[0]) if gap is None or after[0] - before[0] <= gap else None
        near = before or after
        return near[1] if outside == "nearest" and (gap is None or abs(near[0] - t) <= gap) else None

    found = asof.interpolated(spark.createDataFrame(asked, "k string, t double, i int"), spark.createDataFrame(base, "k string, t double, v double"),
                              ["k"], "t", "v", "here", bucket, gap, outside)
    got = {r["i"]: r["here"] for r in found.collect()}
    assert len(got) == len(asked)
    for k, t, i in asked:
        want = at(k, t)
        assert got[i] == (None if want is None else pytest.approx(want, abs=1e-9)), (t, i)


def test_interpolation_in_a_full_bucket(spark):
    """All rows in one bucket, and a bucket for each row: no frame is worked out anew up to the end of its group."""
    n = 20_000
    base = spark.range(0, n, 2).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("t"), (F.col("id") * 3.0).alias("v"))
    readings = spark.range(-1, n).select(F.lit("a").alias("k"), F.col("id").alias("i"), F.col("id").cast("double").alias("t"))
    for bucket in (1e6, 1.0):
        found = asof.interpolated(readings, base, ["k"], "t", "v", "here", bucket)
        assert "unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
        got = {r["i"]: r["here"] for r in found.collect()}
        assert got == {i: i * 3.0 if 0 <= i < n - 1 else None for i in range(-1, n)}


def test_diurnal_datum(spark):
    readings = spark.createDataFrame([("a", 1.0, 100.0), ("a", 3.0, None), ("b", 1.0, 7.0)], "k string, t double, mag double")
    base = spark.createDataFrame([("a", 0.0, 10.0), ("a", 2.0, 14.0), ("a", 4.0, 12.0)], "k string, t double, level double")
    given = asof.diurnal_corrected(readings, base, ["k"], "t", "mag", "level", datum=11.0)
    assert rows(given, "k", "t", "diurnal", "mag_corrected") == [("a", 1.0, 1.0, 99.0), ("a", 3.0, 2.0, None), ("b", 1.0, None, None)]
    mean = asof.diurnal_corrected(readings, base, ["k"], "t", "mag", "level")
    assert rows(mean.where("t = 1.0 AND k = 'a'"), "diurnal") == [(0.0,)]


@pytest.mark.parametrize("by", [-4, -1, 0, 3, 50])
def test_shift(spark, tracks, by, monkeypatch):
    df = framed(spark, tracks, 5)
    monkeypatch.setattr(series.neighbourhood, "__defaults__", (6,))
    got = series.shifted(df, ["k"], "chunk", "i", ["v"], by)
    want = [(k, i, v[i + by] if 0 <= i + by < len(v) else None) for k, v in tracks.items() for i in range(len(v))]
    assert sorted((tuple(r) for r in got.select("k", "i", "v").collect()), key=lambda t: t[:2]) == sorted(want, key=lambda t: t[:2])


def test_lag_is_found(spark, monkeypatch):
    monkeypatch.setattr(series.neighbourhood, "__defaults__", (16,))
    rng = random.Random(8)
    still = [rng.uniform(-1, 1) for _ in range(200)]
    data = [(k, i, still[i], (still[i - d] * 2 + 5 + rng.uniform(-.1, .1)) * s if 0 <= i - d < 200 else None)
            for k, d, s in (("late", 4, 1), ("early", -2, -1), ("flat", 0, 0)) for i in range(200)]
    df = spark.createDataFrame(data, "k string, i long, x double, y double").withColumn("chunk", series.chunk_of("i", 9))
    table = series.lag_correlations(df, ["k"], "chunk", "i", "y", "x", 6)
    assert table.where("k = 'late'").count() == 13
    best = {r["k"]: (r["lag"], round(r["correlation"], 1)) for r in series.best_lag(table, ["k"]).collect()}
    assert best == {"late": (4, 1.0), "early": (-2, -1.0)}


def test_grid(spark):
    rng = random.Random(6)
    points = [(rng.uniform(-20, 20), rng.uniform(-20, 20), rng.uniform(0, 9)) for _ in range(60)] + [(5.0, 5.0, 3.0), (None, 1.0, 1.0), (1.0, 1.0, None)]
    df = spark.createDataFrame(points, "x double, y double, v double")
    got = {(r["col"], r["row"]): (r["value"], r["n"]) for r in grid.gridded(df, [], "x", "y", "v", 10.0, 1, 2.0).collect()}
    sums = {}
    for x, y, v in points:
        if None in (x, y, v):
            continue
        for c in range(math.floor(x / 10) - 1, math.floor(x / 10) + 2):
            for r in range(math.floor(y / 10) - 1, math.floor(y / 10) + 2):
                w = max(math.dist((x, y), ((c + .5) * 10, (r + .5) * 10)), 0.01) ** -2
                a = sums.setdefault((c, r), [0, 0, 0])
                a[0] += w * v
                a[1] += w
                a[2] += 1
    assert got == {k: (pytest.approx(a / b), n) for k, (a, b, n) in sums.items()}


def test_xyz_by_many_files(spark, tmp_path):
    data = [(f"L{i % 3}" if i % 10 else None, i, i * 1.25 if i % 4 else None) for i in range(100)]
    df = spark.createDataFrame(data, "line string, i int, v double").repartition(7)
    path = str(tmp_path / "out")
    xyz.write_xyz(df, path, "line", "i", {"i": 0, "v": 2})
    text = [line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines()]
    want = []
    for name in ("L0", "L1", "L2"):
        want += [f"Line {name}", *[f"{i} {'*' if v is None else f'{v:.2f}'}" for line, i, v in data if line == name]]
    assert text == want
    back = xyz.read_xyz(spark, path, ["i", "v"]).orderBy("place").select("line", "i", "v").collect()
    assert [tuple(r) for r in back] == [(line, float(i), v) for n in ("L0", "L1", "L2") for line, i, v in data if line == n]


PLAN = """a note, not a record
"	!Coord - a point, line, or polyline."
Coord,1,before,1,1,2,3
UTMZone,33N,,,,
RadarHeight, 80 ,,,
Coord,1,20010,2,440927,5715310,0,439755,5713765,0
UTMZone,34S
Coord,2,20020,3,1,2,3,4,x,6
Coord,9,20030,zero
Coord,0
"""


@pytest.mark.parametrize("split", ["16", "100000"])
def test_navigation_plan(spark, tmp_path, split):
    (tmp_path / "plan.csv").write_text(PLAN)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        plan = survey_text.nav_plan(survey_text.text_lines(spark, str(tmp_path)))
        got = rows(plan, "entity", "label", "state", "point", "n_points", "x", "y", "z", "utm_zone", "radar_height")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [
        (1, "before", "flown", 1, 1, 1.0, 2.0, 3.0, None, None),
        (2, "20010", "flown", 1, 2, 440927.0, 5715310.0, 0.0, "33N", 80.0), (2, "20010", "flown", 2, 2, 439755.0, 5713765.0, 0.0, "33N", 80.0),
        (3, "20020", "flying", 1, 3, 1.0, 2.0, 3.0, "34S", 80.0), (3, "20020", "flying", 2, 3, 4.0, None, 6.0, "34S", 80.0)]


@pytest.mark.parametrize("split", ["64", "1000000"])
def test_compensation_model(spark, tmp_path, split):
    rng = random.Random(1)
    text, want = "CMP_0001.cff\n3\n0\n", {}
    for name in ("Mag1", "Mag2", "MagL"):
        values = [round(rng.uniform(-40, 40), 4) for _ in range(98)]
        want[name] = values
        text += f"{name}\n12.9647\n5.6e-005\n-2.49\n98\n" + "".join(f"{1 + (i > 50)},{i},1,-1,-1,{v}\n" for i, v in enumerate(values))
    (tmp_path / "m.cff").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        terms = survey_text.compensation_terms(survey_text.text_lines(spark, str(tmp_path))).cache()
        assert terms.count() == 3 * 98
        got = {r["channel"]: (r["n_terms"], r["coefficients"]) for r in survey_text.compensation_vectors(terms).collect()}
        assert rows(terms.where("channel = 'Mag2' AND ordinal <= 2"), "ordinal", "codes") == [(1, [1, 0, 1, -1, -1]), (2, [1, 1, 1, -1, -1])]
        terms.unpersist()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: (98, v) for k, v in want.items()}


def test_stripping_edges(spark):
    df = spark.createDataFrame([(1, 10.0, 20.0, 30.0, 2.0), (2, 10.0, None, 30.0, 1.0), (3, 1.0, 1.0, 1.0, 0.0), (4, 1.0, 1.0, 1.0, None), (9, 1.0, 1.0, 1.0, 1.0)],
                               "i int, th double, u double, k double, live double").withColumn("c", F.when(F.col("i") < 9, 1).otherwise(2))
    known = spark.createDataFrame([(1, [1.0, 2.0, 3.0], [[], [0.5], [0.25, 2.0]])], "c int, background array<double>, ratios array<array<double>>")
    found = rows(radiometric.stripped(df, known, ["c"], ["th", "u", "k"], "live"), "i", "th_stripped", "u_stripped", "k_stripped")
    assert found == [(1, 4.0, 6.0, -1.0), (2, 9.0, None, None), (3, None, None, None), (4, None, None, None), (9, None, None, None)]


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 1, 2)])
def test_log_facts_in_any_order_of_arrival(spark, tmp_path, order):
    logs = {1: "Log opened at Date:20260324 Time:1434\n14:00:01.0: COM3: Macro A OK - 1\n14:00:03.0: COM3: Macro B OK - 1\n14:00:02.0: COM3: Macro C OK - 1\n",
            2: "14:00:01.0: Character Rate on COM9 is 5.5 chars/second\n14:00:09.0: Character Rate on COM9 is 0.0 chars/second\nno stamp COM1: Macro X OK\n",
            3: "14:10:00.0: Character Rate on COM3 is 7 chars/second\n14:10:00.0: nothing\n"}
    folder = tmp_path / "day"
    folder.mkdir()
    for n in order:  # a batch per file, in this order
        (folder / f"EVT0000{n}.txt").write_text(logs[n])
        log_facts.keep_latest(spark, str(folder), str(tmp_path / "table"), str(tmp_path / "state"), files_per_trigger=1).awaitTermination()
    got = rows(spark.read.parquet(str(tmp_path / "table")), "dataset", "session", "fact", "port", "said")
    assert got == [("day", 1, "sensor", "COM3", "B"), ("day", 2, "rate", "COM9", "0.0"), ("day", 3, "rate", "COM3", "7.0")]
    from surveypulse.sources.lines import log_lines

    assert rows(log_facts.latest(log_facts.told(log_lines(spark, str(folder)))), "dataset", "session", "fact", "port", "said") == got
