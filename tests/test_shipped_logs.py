"""Known facts of two event logs: built ones of the real ones' shape and traps, and the real ones where they are."""

from datetime import datetime

import pytest
from survey_helpers import rows

from surveypulse.plans.status import StatusRun

PORTS = {"COM3": "GEMK1", "COM4": "GEMK2", "COM5": "GDRAlt", "COM6": "GD485", "COM7": "XSENS", "COM8": "GDGPS",
         "COM9": "GDSpec", "COM10": "GDLas"}


@pytest.fixture(scope="module")
def run(spark, shipped):
    run = StatusRun(spark, shipped)
    yield run
    run.close()


def test_sessions_in_order(run):
    assert [r.session for r in run.sessions.orderBy("session").collect()] == [6, 7]


def test_line_counts(run):
    stamped = run.log.where("value rlike '^[0-9]{2}:[0-9]{2}:[0-9]{2}[.][0-9]:'")
    assert rows(run.log.groupBy("session").count()) == [(6, 786), (7, 236)]
    assert rows(stamped.groupBy("session").count()) == [(6, 785), (7, 235)]


def test_window(run):
    assert rows(run.session_window, "session", "start_ts", "end_ts", "duration_s") == [
        (6, datetime(2026, 3, 24, 14, 34, 33, 600000), datetime(2026, 3, 24, 14, 54, 36, 900000), 1203.3),
        (7, datetime(2026, 3, 24, 15, 1, 47), datetime(2026, 3, 24, 15, 17, 1, 700000), 914.7),
    ]


def test_ports_and_rates(run):
    assert rows(run.ports, "session", "port", "sensor") == sorted((s, p, n) for s in (6, 7) for p, n in PORTS.items())
    six = [130.8, 131.3, 89.4, 0.0, 599.3, 326.2, 0.0, 0.0]
    seven = [131.4, 127.2, 86.8, 0.0, 593.7, 350.3, 0.0, 0.0]
    expected = [(6, p, r) for p, r in zip(PORTS, six)] + [(7, p, r) for p, r in zip(PORTS, seven)]
    assert rows(run.rates, "session", "port", "rate") == sorted(expected)


def test_disconnected(run):
    for status in (run.connected_ports, run.port_status, run.sensor_status):
        off = status.where("status = 'DISCONNECTED'")
        assert rows(off, "session", "port") == sorted((s, p) for s in (6, 7) for p in ("COM6", "COM9", "COM10"))
    assert rows(run.spectrometer_status, "session", "status") == [(6, "DISCONNECTED"), (7, "DISCONNECTED")]


def test_mux_in_log_order(run):
    for session in (6, 7):
        found = run.mux.where(f"session = {session}").orderBy("mux", "pos").collect()
        assert [(r.mux, r.port) for r in found] == [
            ("M1", "COM7"), ("M1", "COM5"), ("M1", "COM10"), ("M1", "COM4"), ("M1", "COM3"), ("M1", "COM6"),
            ("M2", "COM9"), ("M3", "COM8"),
        ]


def test_warnings(run):
    assert rows(run.warnings, "session", "warning", "n") == [
        (6, "M1 TimeO", 211), (6, "M2 TimeO", 211), (6, "M3 TimeO", 3), (6, "M3 TimeO_COM8", 1), (6, "Nv WayP", 211),
        (7, "M1 TimeO", 24), (7, "M2 TimeO", 24), (7, "M3 TimeO", 8), (7, "Nv WayP", 24),
    ]
    ordered = run.warnings.where("session = 6").orderBy("n", "first_pos", ascending=[False, True]).collect()
    assert [r.warning for r in ordered] == ["M1 TimeO", "M2 TimeO", "Nv WayP", "M3 TimeO", "M3 TimeO_COM8"]
    assert rows(run.warnings.where("meaning = 'Unknown'"), "warning") == [("M3 TimeO_COM8",)]


def test_critical_and_opened(run):
    assert rows(run.critical, "session", "ts") == [(6, "14:34:54.3"), (7, "15:02:08.0")]
    names = [r.path.split("\\")[-1] for r in run.file_opens.orderBy("session", "pos").collect()]
    assert names == [f"{k}0000{s}.txt" for s in (6, 7) for k in ("GGA", "MAG", "SPC")]


def test_summary_and_missing_files(run):
    assert rows(run.session_summary, "session", "n_critical", "n_warnings", "n_mux_timeouts", "mag_rows") == [
        (6, 1, 637, 425, None), (7, 1, 80, 56, None),
    ]
    assert rows(run.files_missing, "session", "kind") == sorted((s, k) for s in (6, 7) for k in ("MAG", "GGA", "SPC", "Cfg"))


def test_same_facts_from_small_splits(spark, shipped, run):
    """Order of lines across file splits, and any number of shuffle partitions."""
    tables = ["ports", "rates", "mux", "warnings", "session_window"]
    columns = {"mux": ["session", "mux", "port", "sensor"], "warnings": ["session", "warning", "n"]}
    expected = {t: rows(getattr(run, t), *columns.get(t, [])) for t in tables}
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        for partitions in ("1", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            again = StatusRun(spark, shipped)
            assert again.log.select("block").distinct().count() > 1
            for t in tables:
                assert rows(getattr(again, t), *columns.get(t, [])) == expected[t], t
            found = again.mux.where("session = 6").orderBy("mux", "pos").collect()
            assert [r.port for r in found][:6] == ["COM7", "COM5", "COM10", "COM4", "COM3", "COM6"]
            again.close()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
