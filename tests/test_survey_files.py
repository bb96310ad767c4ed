"""Hand-made sessions with every file kind; expected values worked out by hand."""

from pathlib import Path
from urllib.parse import quote

import pytest
from survey_helpers import rows

from surveypulse.plans.report import write_report
from surveypulse.plans.status import StatusRun
from surveypulse.sources import files, lines


@pytest.fixture(scope="module")
def run(spark, survey):
    run = StatusRun(spark, survey)
    yield run
    run.close()


def close(found, expected):
    assert len(found) == len(expected), (found, expected)
    for f, e in zip(found, expected):
        assert len(f) == len(e)
        for a, b in zip(f, e):
            assert a == (pytest.approx(b, abs=1e-6) if isinstance(b, float) else b), (f, e)


def test_sessions_and_selection(spark, survey, run):
    assert rows(run.sessions, "dataset", "session") == [("Ground test 1+2 100%", n) for n in (1, 2, 3)]
    assert rows(StatusRun(spark, survey, [2]).sessions, "session") == [(2,)]
    with pytest.raises(ValueError):
        StatusRun(spark, survey, [77]).sessions.count()
    with pytest.raises(FileNotFoundError):
        files.discover(spark, survey + "/none")


def test_no_session_vanishes(spark, tmp_path):
    """An empty log, numbers asked for that are not there, and headers that give no layout."""
    for name, text in {
        "EVT00001.txt": "Date:20260324\n", "EVT00002.txt": "", "MAG00001.txt": " A  B\n 1  2\n", "MAG00002.txt": " A  A\n 1  2\n",
        "GGA00001.txt": "   \n", "GGA00002.txt": "", "MAG00009.txt": " A  B\n 7  8\n", "Cfg00001.xml": "<R><Object",
    }.items():
        (tmp_path / name).write_text(text)
    run = StatusRun(spark, str(tmp_path), [1, 2, 77])
    assert rows(run.sessions, "session") == [(1,), (2,)]
    assert rows(run.sessions_missing) == [(77,)]
    assert rows(run.files_missing.where("kind <> 'SPC'"), "session", "kind", "state") == [
        (1, "GGA", "BAD_HEADER"), (2, "Cfg", "MISSING"), (2, "EVT", "EMPTY"), (2, "GGA", "EMPTY"), (2, "MAG", "BAD_HEADER")]
    assert rows(run.session_summary, "session", "mag_rows", "gga_rows", "spc_rows") == [(1, 1, None, None), (2, None, 0, None)]
    assert rows(run.series("MAG", ["A"]), "session", "A") == [(1, 1.0)]  # session 9 has no log
    assert rows(run.config_broken, "session") == [(1,)]
    run.close()


def test_a_store_that_only_spark_opens(spark, survey, run):
    """The same files behind a mount table that the header probe does not know."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.survey.link./data", "file://" + quote(str(Path(survey).parent)))
    mounted = StatusRun(spark, f"viewfs://survey/data/{Path(survey).name}")
    probed = files.inventory(mounted.sessions)
    assert {r.state for r in probed.collect()} == {"UNOPENED"}
    shown = ["session", "kind", "state", "header"]
    assert rows(mounted.files, *shown) == rows(run.files, *shown)
    assert rows(mounted.row_counts, "session", "kind", "n_rows") == rows(run.row_counts, "session", "kind", "n_rows")
    mounted.close()


def test_a_file_that_cannot_be_read(tmp_path):
    assert files._first_line(str(tmp_path), True, {}) == ("UNREADABLE", None)
    assert files._first_line(str(tmp_path / "none"), True, {}) == ("MISSING", None)
    assert files._first_line("nosuchstore://host/a", True, {}) == ("UNOPENED", None)


def test_two_folders_of_one_name(spark, tmp_path):
    for parent in ("a", "b"):
        folder = tmp_path / parent / "same"
        folder.mkdir(parents=True)
        (folder / "EVT00001.txt").write_text("x\n")
    with pytest.raises(ValueError, match="same"):
        StatusRun(spark, str(tmp_path / "*/*")).sessions.count()
    two = StatusRun(spark, str(tmp_path / "*/*"), levels=2)
    assert rows(two.sessions, "dataset") == [("a/same",), ("b/same",)]
    assert rows(two.log, "dataset", "value") == [("a/same", "x"), ("b/same", "x")]


def test_missing_and_empty_files(run):
    assert rows(run.files_missing, "session", "kind", "state") == [
        (3, "Cfg", "MISSING"), (3, "GGA", "MISSING"), (3, "MAG", "EMPTY"), (3, "SPC", "MISSING"),
    ]


def test_headers_agree_with_scan(spark, survey, run):
    raw = spark.read.text(survey + "/MAG*.txt")
    scan = raw.select(*lines.scan_columns(1), "value")
    probed = run.files.where("kind = 'MAG' AND header IS NOT NULL")
    headers = files.headers_by_scan(scan)
    assert rows(headers, "session", "header") == rows(probed, "session", "header")
    body = files.without_headers(scan, headers)
    kept = rows(run.table_lines("MAG"), "session", "value")
    assert [r for r in rows(body, "session", "value") if r[1].strip()] == kept


def test_channels_present(run):
    found = rows(run.channels_present.where("kind = 'MAG' AND session = 1"), "ordinal", "channel")
    assert found == list(enumerate(["Xpr", "Time", "Mag1", "Ralt", "Roll", "Bin"]))


def test_wide_series(run):
    first = run.series("MAG", ["Xpr", "Mag1", "Ralt", "Roll", "Bin"]).where("session = 1").orderBy("block", "mid")
    close([tuple(r) for r in first.select("time_sec", "Xpr", "Mag1", "Ralt", "Roll", "Bin").collect()], [
        (0.0, 1.0, 49000.5, 1.2, None, "ff"), (0.1, 2.0, None, 1.3, None, None),
        (0.2, 3.0, 49001.5, None, None, "0a"), (0.3, 4.0, 49002.0, None, None, "0b"),
    ])
    # The first time is missing; the next one is the origin, and midnight is not unwrapped.
    second = run.series("MAG").where("session = 2").orderBy("block", "mid")
    close([tuple(r) for r in second.select("time_sec", "Mag1", "MagL", "Ralt").collect()], [
        (None, None, 10.0, None), (0.0, 49000.0, 10.5, None), (0.25, 49001.0, 11.0, None),
        (-86399.5, 49002.0, 11.5, None), (-86399.25, 49003.0, 12.0, None), (-86399.0, 49004.0, 12.5, None),
    ])


def test_statistics(run):
    found = rows(run.channel_stats.where("kind = 'MAG' AND session = 1"),
                 "channel", "n", "n_null", "mean", "std", "min", "max", "all_integral")
    close(found, [
        ("Mag1", 4, 1, 49001.333333, 0.763763, 49000.5, 49002.0, False),
        ("Ralt", 4, 2, 1.25, 0.0707107, 1.2, 1.3, False),
        ("Roll", 4, 4, None, None, None, None, False),
        ("Time", 4, 0, 143433.75, 0.1290994, 143433.6, 143433.9, False),
        ("Xpr", 4, 0, 2.5, 1.2909944, 1.0, 4.0, True),
    ])
    assert all(r.n >= r.n_null for r in run.channel_stats.collect())


def test_classes(run):
    assert rows(run.column_classes.where("kind = 'MAG'"), "session", "channel", "class", "pct_null") == [
        (1, "Mag1", "partial", 25.0), (1, "Ralt", "partial", 50.0), (1, "Roll", "fully", 100.0),
        (2, "Mag1", "partial", pytest.approx(100 / 6)), (2, "Mag2", "partial", pytest.approx(400 / 6)),
        (2, "MagL", "clean", 0.0), (2, "Roll", "partial", pytest.approx(200 / 6)),
    ]
    # dSNo is whole and complete: in no class. A table without rows has no floating-point column.
    assert rows(run.column_classes.where("kind = 'GGA'"), "session", "channel", "class") == [
        (1, "Xdgps", "clean"), (1, "dHdop", "clean"),
    ]
    assert rows(run.column_classes.where("kind = 'SPC'"), "session", "channel", "class") == [
        (1, "BaroV", "clean"), (1, "Sk", "clean"), (2, "BaroV", "clean"), (2, "Sk", "fully"),
    ]


def test_row_counts(run):
    assert rows(run.row_counts, "session", "kind", "n_rows", "n_columns") == [
        (1, "GGA", 2, 5), (1, "MAG", 4, 7), (1, "SPC", 2, 5), (2, "GGA", 0, 5), (2, "MAG", 6, 6), (2, "SPC", 1, 5),
    ]


def test_gps_and_environment(run):
    close(rows(run.gps_quality, "session", "channel", "label", "mean", "std", "grade"), [
        (1, "dHdop", "HDOP", 0.9, 0.1414214, "EXCELLENT"), (1, "dSNo", "Satellites", 12.5, 0.7071068, None),
    ])
    assert rows(run.position_scatter, "session", "channel", "std") == [(1, "Xdgps", 0.0)]
    found = rows(run.environment, "session", "channel", "mean", "std", "constant")
    close(found, [(1, "BaroV", 1.0, 0.0, True), (1, "Sk", 5.75, 0.7071068, False), (2, "BaroV", 1.0, None, False)])


def test_stability(run):
    one = {r.channel: r.status for r in run.stability.where("session = 1").collect()}
    assert len(one) == 30
    assert (one["Mag1"], one["Roll"], one["Mag2"], one["dHdop"], one["Sk"]) == ("OK", "NO_DATA", "NO_DATA", "OK", None)
    two = {r.channel: r.status for r in run.stability.where("session = 2").collect()}
    assert (two["Mag1"], two["Roll"], two["MagL"], two["dHdop"], two["Sk"]) == ("OK", "OK", None, "NO_DATA", "NO_DATA")


def test_log_tables(run):
    assert rows(run.connected_ports.where("session = 1"), "port", "rate", "status") == [
        ("COM10", 1.0, "CONNECTED"), ("COM3", 130.8, "CONNECTED"), ("COM4", None, "DISCONNECTED"),
        ("COM5", 0.0, "DISCONNECTED"), ("COM6", 0.0, "DISCONNECTED"), ("COM7", 599.3, "CONNECTED"),
    ]
    # Starts from the rates: COM4 is not there, COM9 has no sensor.
    assert rows(run.port_status.where("session = 1"), "port", "sensor") == [
        ("COM10", "GDLas"), ("COM3", "GEMK1"), ("COM5", "GDRAlt"), ("COM6", "GD485"), ("COM7", "XSENS"), ("COM9", None),
    ]
    assert run.sensor_status.count() == 3 * 8
    assert rows(run.warnings.where("session = 1"), "warning", "n") == [("M1 TimeO", 2)]
    assert rows(run.critical.where("session = 1"), "ts", "line") == [(None, "no stamp here !!!!")]
    # Only the header of session 2 has a time that matches; session 3 has no date.
    assert [(r.session, str(r.start_ts), r.duration_s) for r in run.session_window.orderBy("session").collect()] == [
        (1, "2026-03-24 14:34:33.600000", 326.4), (2, "2026-03-24 14:34:00", 360.0), (3, "None", None),
    ]


def test_cross_check(run):
    found = rows(run.cross_check, "session", "port", "channel_states", "verdict")
    assert found == [
        (1, "COM10", None, "OK"),
        (1, "COM3", "Mag1:PARTIAL(25.0%); Mag1D:ABSENT; Mag1C:ABSENT", "OK"),
        (1, "COM4", "Mag2:ABSENT; Mag2D:ABSENT; Mag2C:ABSENT", "OK"),
        (1, "COM5", "Ralt:PARTIAL(50.0%); Raltr:ABSENT", "OK"),
        (1, "COM6", "MagL:ABSENT; MagLC:ABSENT", "OK"),
        (1, "COM7", "Roll:ALL_NaN; Pitch:ABSENT; Yaw:ABSENT", "MISMATCH"),
        (2, "COM10", None, "OK"),
        (2, "COM3", "Mag1:PARTIAL(16.7%); Mag1D:ABSENT; Mag1C:ABSENT", "OK"),
        (2, "COM4", "Mag2:PARTIAL(66.7%); Mag2D:ABSENT; Mag2C:ABSENT", "OK"),
        (2, "COM5", "Ralt:ABSENT; Raltr:ABSENT", "OK"),
        (2, "COM6", "MagL:OK; MagLC:ABSENT", "MISMATCH"),
        (2, "COM7", "Roll:PARTIAL(33.3%); Pitch:ABSENT; Yaw:ABSENT", "OK"),
    ]


def test_gaps(run):
    found = rows(run.gap_intervals, "session", "kind", "plot_set", "t_start", "t_end", "n_rows")
    close(found, [
        (1, "MAG", "mag_raw", 0.1, 0.2, 1),
        (1, "MAG", "radar_alt", 0.2, 0.3, 2),
        (2, "MAG", "attitude", -86399.5, -86399.25, 1),
        (2, "MAG", "attitude", None, 0.0, 1),
        (2, "MAG", "mag_raw", -86399.0, -86399.0, 1),
        (2, "MAG", "mag_raw", 0.25, -86399.25, 2),
        (2, "MAG", "mag_raw", None, 0.0, 1),
    ])


def test_comparison(run):
    found = {(r.session, r.sensor): r.status for r in run.compare_status.collect()}
    assert found[1, "GEMK1"] == "OK  connected" and found[1, "XSENS"] == "NO DATA"
    assert found[1, "GDSpec"] == "OK  connected"  # by Sk, although no VLF channel exists
    assert found[2, "GDSpec"] == "NO DATA"
    assert found[1, "GDLas"] == "OK  connected" and found[1, "GEMK2"] == "DISCONNECTED"
    means = rows(run.compare_means, "channel_ordinal", "channel", "session", "state")
    assert {m[1] for m in means} == {"Mag1", "Mag2", "Roll", "Ralt", "dHdop", "dSNo", "Sk"}
    assert (4, "Roll", 1, "NO DATA") in means and (4, "Roll", 2, "DATA") in means


def test_config(run):
    tags = dict(rows(run.config_tags.where("session = 1"), "tag", "value"))
    assert tags == {"COMPNAME": "CMP_0043", "COM3STATE": "On", "BAUD": "9600", "MACRO": "GEMK2", "LOGLEVEL": "3",
                    "NAVNAME": "", "COM4STATE": "Off", "PORTNUM": "2"}
    assert rows(run.config_ports.where("session = 1"), "com", "state", "baud", "macro") == [
        ("COM3", "On", "115200", "GEMK1"), ("COM4", "Off", "?", "GEMK2"), ("COM5", None, "?", "?"),
    ]
    summary = run.config_summary.where("session = 1").collect()[0]
    assert (summary.compensation, summary.nav_file, summary.clock_port, summary.web_host) == ("CMP_0043", "", "2", None)
    assert run.config_broken.count() == 0


def test_report_is_written(spark, run, tmp_path):
    names = write_report(run, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "channel_stats"))
    assert back.count() == run.channel_stats.count()
    assert {"gap_intervals", "plot_series_mag", "session_summary"} <= set(names)


def test_small_splits_give_the_same(spark, survey, run):
    expected = {t: rows(getattr(run, t)) for t in ("channel_stats", "gap_intervals", "row_counts")}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        again = StatusRun(spark, survey)
        assert again.table_lines("MAG").select("block").distinct().count() > 2
        for table, known in expected.items():
            close(rows(getattr(again, table)), known)
        again.close()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
