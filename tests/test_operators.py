"""Single rules, each on a few rows."""

import pytest
from survey_helpers import rows
from pyspark.sql import functions as F

from surveypulse import reference as ref
from surveypulse.functions.clock import tenths_of_day
from surveypulse.functions.text import numeric, strip, text_value, whole_number
from surveypulse.operators import compare, events, health, profile
from surveypulse.operators.joins import join_sized
from surveypulse.sources import config_xml, files, fixed_width, lines

# Cell text and the number a reader of the survey files gets from it.
NUMBERS = {
    "1.": 1.0, ".5": 0.5, "1e3": 1000.0, "1E5": 100000.0, "+5": 5.0, "-5": -5.0, "-.5": -0.5, "00012": 12.0,
    "1e-400": 0.0, "inf": float("inf"), "-Infinity": float("-inf"), "+INF": float("inf"),
    "99999999999999999999": 1e20,
    **dict.fromkeys(["1e", ".", "1d", "1f", "1F", "2D", "0x1p3", "0x10", "0X1P3", "nan", "NaN", "1_0", "1,0", "1e400", "-1e400",
                     "True", "1 2", "1e+", "--1", "+-1", "", "-", "e5", "0b1", "1.5.2", "+.e1", "infx", "1e5.0", "####",
                     "9" * 400]),
}


def test_number_grammar(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS], "t STRING").select("t", numeric(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == NUMBERS


def test_whole_numbers(spark):
    words = {"5": True, "-12": True, "+7": True, "5.0": False, "1e3": False, "1E3": False, "inf": False}
    df = spark.createDataFrame([(t,) for t in words], "t STRING").select("t", whole_number(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == words


def test_text(spark):
    df = spark.createDataFrame([("#",), ("###",), ("#a",), ("NA",), ("",), ("a0",)], "t STRING")
    assert [r[0] for r in df.select(text_value(F.col("t"))).collect()] == [None, None, "#a", None, None, "a0"]
    df = spark.createDataFrame([(" \t a b\u00a0\u2003",), ("",)], "t STRING")
    assert [r[0] for r in df.select(strip(F.col("t"))).collect()] == ["a b", ""]


def test_stamps(spark):
    words = {"00:00:00.0": 0, "23:59:59.9": 863999, "24:00:00.0": None, "12:60:00.0": None, "12:00:60.0": None}
    df = spark.createDataFrame([(t,) for t in words], "t STRING").select("t", tenths_of_day(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == words


def log(spark, *texts):
    rows_ = [(1, 0, i, t) for i, t in enumerate(texts)]
    return lines.split_log_lines(spark.createDataFrame(rows_, "session INT, block BIGINT, mid BIGINT, value STRING"))


def test_log_rules(spark):
    found = log(
        spark,
        "opened at Date:20260324 Time:14:34",
        "10:00:00.0: COM3: Macro A OK", "10:00:01.0: COM3: Macro B OK",
        "10:00:02.0: Character Rate on COM4 is 1.2.3 chars/second",
        "10:00:03.0: Health Warning:  | and Health Warning: second|",
        "10:00:04.0: Health Warning: no pipe",
        "10:00:05.0: shown10:00:09.9: again",
        "x 10:30:00.0: not at the start !!!!",
        "  File:  D:\\a b.txt  opened\u2028File: c opened",
    )
    facts = events.facts(found, ["session"])
    assert rows(events.ports(facts, ["session"]), "port", "sensor") == [("COM3", "B")]
    assert rows(events.rates(facts, ["session"]), "port", "rate") == [("COM4", None)]
    assert rows(events.warnings(facts, ["session"]), "warning", "n") == [("", 1)]
    assert rows(events.critical_lines(facts, ["session"]), "ts") == [(None,)]
    assert [r.path for r in events.file_opens(facts, ["session"]).orderBy("pos").collect()] == ["D:\\a b.txt", "c"]
    window = events.session_window(events.log_fields(found), ["session"]).collect()[0]
    assert (str(window.start_ts), window.duration_s) == ("2026-03-24 10:00:00", 5.0)


@pytest.mark.parametrize("header,start", [
    ("no date", None), ("Date:20261345 Time:1434", None), ("Date:20260324 Time:0900", "2026-03-24 09:00:00"),
    ("Date:20260324", "2026-03-24 10:00:00"),
])
def test_log_header(spark, header, start):
    found = log(spark, header, "10:00:00.0: a", "11:00:00.0: Date:20200101 Time:0101")
    window = events.session_window(events.log_fields(found), ["session"]).collect()[0]
    assert (None if window.start_ts is None else str(window.start_ts)) == start


def test_one_value_and_empty(spark):
    df = spark.createDataFrame([(1, 5.0, None)], "k INT, a DOUBLE, b DOUBLE")
    stats = profile.channel_stats(df, ["k"], ["a", "b"])
    assert rows(stats, "channel", "n", "n_null", "std", "all_integral") == [("a", 1, 0, None, False), ("b", 1, 1, None, False)]
    limits = spark.createDataFrame([("a", "m", 1.0)], "channel STRING, unit STRING, max_std DOUBLE")
    assert rows(profile.stability(stats, limits), "channel", "status") == [("a", "HIGH_STD"), ("b", "NO_DATA")]
    assert rows(stats.select(profile.is_constant(F.col("std")).alias("c")), "c") == [(False,), (False,)]
    none = profile.channel_stats(df.limit(0), [], ["a"])
    assert rows(profile.classify(none), "channel", "class") == [("a", "fully")]


def test_whole_number_channel_falls_out(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 3)], "k INT, whole INT, gap INT")
    stats = profile.channel_stats(df, ["k"], ["whole", "gap"])
    assert rows(profile.classify(stats), "channel", "class") == [("gap", "partial")]


def test_wide_and_long_statistics_agree(spark):
    names = [f"c{i}" for i in range(15)]
    df = spark.range(50).select(F.col("id") % 3, *[F.when(F.col("id") % (i + 2) > 0, F.rand(i)).alias(n)
                                                   for i, n in enumerate(names)]).toDF("k", *names)
    long = {tuple(r[:2]): r[2:] for r in profile.channel_stats(df, ["k"], names).collect()}
    for part in (names[:8], names[8:]):
        for r in profile.channel_stats(df, ["k"], part).collect():
            assert long[tuple(r[:2])] == pytest.approx(r[2:])
    # Over no rows there is a row per channel without keys, and none with keys, however many channels.
    for some in (names[:1], names[:12], names[:13], names):
        none = profile.channel_stats(df.limit(0), [], some)
        assert rows(profile.classify(none), "channel", "class", "n") == sorted((n, "fully", 0) for n in some)
        assert profile.channel_stats(df.limit(0), ["k"], some).count() == 0


def test_sized_join_beyond_its_bound(spark):
    big, small = spark.range(100).withColumn("k", F.col("id") % 4), spark.range(3).toDF("k").withColumn("v", F.col("k") * 2)
    expected, before = None, spark.sparkContext._jsc.getPersistentRDDs().size()
    for bound, spread in ((1000, []), (1, []), (1, ["id"])):
        for how in ("left", "inner"):
            joined = join_sized(big, small, ["k"], how, spread, bound, 5_000_000)
            plan = joined._jdf.queryExecution().optimizedPlan().toString()
            assert ("strategy=broadcast" in plan) == (bound == 1000)
            found = rows(joined.where("v IS NOT NULL"), "k", "id", "v")
            expected = expected or found
            assert found == expected and len(found) == 75
            assert joined.count() == (100 if how == "left" else 75)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before  # nothing stays cached


def test_unknown_sensor_and_word(spark):
    rates = spark.createDataFrame([(1, "COM3", 5.0), (1, "COM9", 0.0)], "session INT, port STRING, rate DOUBLE")
    ports = spark.createDataFrame([(1, "COM3", "NEW")], "session INT, port STRING, sensor STRING")
    status = health.port_status(rates, ports, ref.sensor_ref(spark), ["session"])
    assert rows(status, "port", "sensor", "full_name", "status") == [
        ("COM3", "NEW", None, "CONNECTED"), ("COM9", None, None, "DISCONNECTED")]


def test_tables_have_the_known_sizes(spark):
    sizes = {ref.sensor_ref: 8, ref.column_desc: 76, ref.thresholds: 14, ref.warn_meaning: 4, ref.sensor_channels: 21}
    assert all(table(spark).count() == n for table, n in sizes.items())
    assert sum(map(len, ref.ANALYSIS_CHANNELS.values())) == 30
    assert sum(map(len, ref.COMPARE_CHANNELS.values())) == 13


def test_single_session_is_not_compared(spark):
    sessions = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "dataset STRING, session INT")
    kept = compare.with_company(sessions, ["dataset", "session"], ["dataset"])
    assert rows(kept) == [("a", 1), ("a", 2)]


def test_layout(spark):
    headers = spark.createDataFrame([(1, "  A\tBin   Cc"), (2, "X"), (3, "   ")], "k INT, header STRING")
    laid_out = fixed_width.layouts(headers)
    assert rows(laid_out, "k", "channels", "edges") == [(1, ["A", "Bin", "Cc"], [3, 7, 12]), (2, ["X"], [1])]
    assert rows(fixed_width.number_channels(laid_out, ["k"])) == [(1, 0, "A", 0), (1, 1, "Cc", 2), (2, 0, "X", 0)]
    # Two layouts: joined per key. A short line, a full one, a long last cell, a blank one.
    body = spark.createDataFrame([(1, "  1"), (1, "-1.\x1f a  7 8"), (1, "  2 xyz é 12345"), (1, "  \t"), (2, "123")],
                                 "k INT, value STRING")
    cut = fixed_width.attach_layout(body, laid_out, ["k"])
    wide = fixed_width.wide_table(cut, ["A", "Bin", "Cc", "X"], keep=["k"])
    assert rows(wide) == [(1, -1.0, "\ufffd a", None, None), (1, 1.0, None, None, None), (1, 2.0, "xyz", None, None),
                          (2, None, None, None, 123.0)]
    cells = fixed_width.number_cells(cut, ["k"])
    assert rows(cells.where("cell = 0"), "k", "value", "whole") == [
        (1, -1.0, False), (1, 1.0, True), (1, 2.0, True), (2, 123.0, True)]


def test_lines_with_a_separator_stay_whole(spark, tmp_path):
    (tmp_path / "MAG00001.txt").write_bytes(" A  B\n\ufdd0 1  2\n \" 3\\\n\n\x00 4\n\x01\x00#\n \t \n".encode())
    found = lines.table_lines(spark, str(tmp_path), "MAG").orderBy("mid")
    assert [r.value for r in found.collect()] == ["\ufdd0 1  2", ' " 3\\', "\x00 4", "\x01\x00#"]


def test_config_of_any_shape(spark):
    deep = "".join(f'<Object Tag="T{i}"><Value>{i}</Value>' for i in range(40)) + "</Object>" * 40
    texts = [
        f"<R>{deep}</R>",
        '<R><Object Tag="A"><Group><Object Tag="B"><Value>1</Value></Object></Group></Object></R>',
        '<R><Object Tag="COM3STATE"><Item Tag="BAUD"><Value>9600</Value></Item></Object></R>',
        '<Object Tag="ROOT"><Value> r </Value></Object>',
        '<R><Object Tag="A"><Value>1</Value>', "no xml", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "session INT, xml STRING")
    parsed = config_xml.parse_config(df, "xml", ["session"])
    tags = rows(config_xml.config_tags(parsed, ["session"]))
    assert [t for t in tags if t[0] == 0] == sorted((0, f"T{i}", str(i)) for i in range(40))
    assert [t for t in tags if t[0] > 0] == [(1, "B", "1"), (3, "ROOT", "r")]
    assert rows(config_xml.config_ports(parsed, ["session"])) == [(2, "COM3", None, "9600", "?")]
    assert rows(config_xml.broken_configs(parsed, ["session"]), "session") == [(4,), (5,), (6,), (7,)]


def test_percent_is_rounded_half_to_even(spark):
    df = spark.createDataFrame([(1, 16), (3, 16), (1, 3), (2, 3), (5, 5), (1, 2000), (3, 2000)], "part BIGINT, n BIGINT")
    found = [r[0] for r in df.select(health.tenths_of_percent(F.col("part"), F.col("n"))).collect()]
    assert found == ["6.2", "18.8", "33.3", "66.7", "100.0", "0.0", "0.2"]


def test_names_beyond_ascii(spark):
    facts = events.facts(log(spark, "10:00:00.0: COM3: Macro Größe OK", "10:00:00.0: M1 latches port COM3 runs macro Größe"), ["session"])
    assert rows(events.ports(facts, ["session"]), "sensor") == [("Größe",)]
    assert [r.sensor for r in events.mux_routes(facts, ["session"]).collect()] == ["Größe"]


def test_one_layout_and_two_keep_the_same_sessions(spark):
    """Lines of a file without a layout leave, however many different headers there are."""
    body = spark.createDataFrame([(1, "1"), (2, "2"), (9, "9")], "k INT, value STRING")
    for second in ("A", "B"):
        laid_out = fixed_width.layouts(spark.createDataFrame([(1, "A"), (2, second)], "k INT, header STRING"))
        assert rows(fixed_width.attach_layout(body, laid_out, ["k"]), "k") == [(1,), (2,)]


def test_header_probe_is_spread(spark, tmp_path):
    sessions = spark.range(1, 2001).select(F.lit("d").alias("dataset"), F.col("id").cast("int").alias("session"), F.lit(str(tmp_path)).alias("folder"))
    probed = files.inventory(sessions)
    assert probed.count() == 10_000
    tasks = [r[0] for r in probed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) > 100
