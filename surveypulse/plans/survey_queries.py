"""Registered queries of the steps after the status check: sessions as flown, lines, corrections, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse.functions.clock import seconds_of_day
from surveypulse.operators import asof, flight, grid, radiometric, series
from surveypulse.plans.queries import _LOG, _log, _query, _round, _series, _table
from surveypulse.plans.report import write_table
from surveypulse.plans.status import StatusRun
from surveypulse.session import shared_path
from surveypulse.sources import survey_text, xyz
from surveypulse.streaming import log_facts

# Rows per chunk: small, so that every series crosses chunks at every scale.
_CHUNK = 500


def _tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings in time: an area, a time in seconds, a heading that errors lack."""
    return _table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", (F.col("user_id") % 10).alias("area"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"),
        F.when(F.col("event_type") != "error", F.col("value") * 7.2).alias("heading"), series.chunk_of("event_id", _CHUNK).alias("chunk"),
    )


_TRACKS = """tracks AS (SELECT event_id, user_id, event_type, value, user_id % 10 AS area, epoch_us(ts) / 1e6 AS t,
  CASE WHEN event_type <> 'error' THEN value * 7.2 END AS heading FROM events)"""

_GAP = 6 * 3600


@_query(f"""WITH {_TRACKS}, b AS (SELECT area, t, avg(value) AS v FROM tracks WHERE event_type = 'view' GROUP BY 1, 2),
d AS (SELECT area, avg(value) AS datum FROM tracks WHERE event_type = 'view' GROUP BY 1),
r AS (SELECT * FROM tracks WHERE event_type = 'click'),
p AS (SELECT r.*, b.t AS t0, b.v AS v0 FROM r ASOF LEFT JOIN b ON r.area = b.area AND r.t >= b.t),
n AS (SELECT p.*, b.t AS t1, b.v AS v1 FROM p ASOF LEFT JOIN b ON p.area = b.area AND p.t <= b.t),
c AS (SELECT event_id, n.area, value, CASE WHEN t0 = t THEN v0 WHEN t1 - t0 <= {_GAP} THEN v0 + (v1 - v0) * (t - t0) / (t1 - t0) END - datum AS diurnal
      FROM n LEFT JOIN d ON d.area = n.area)
SELECT event_id, area, round(diurnal, 6) AS diurnal, round(value - diurnal, 6) AS corrected FROM c""")
def q_diurnal(spark, sf_dir):
    """Readings less the base station's departure from its mean, interpolated to each reading's time."""
    tracks = _tracks(spark, sf_dir).select("event_id", "area", "event_type", "t", "value")
    base = tracks.where("event_type = 'view'").select("area", "t", F.col("value").alias("base"))
    rover = tracks.where("event_type = 'click'")
    found = asof.diurnal_corrected(rover, base, ["area"], "t", "value", "base", bucket_seconds=12 * 3600.0, max_gap=float(_GAP))
    return found.select("event_id", "area", _round("diurnal", 6), F.round("value_corrected", 6).alias("corrected"))


# Off any change of heading that two-digit values give.
_TURN, _LINE = 120.001, 45.001

_SEGMENTS = f"""{_TRACKS}, known AS (SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM tracks),
changed AS (SELECT *, abs(heading - before + 180 - 360 * floor((heading - before + 180) / 360) - 180) AS change FROM known),
stated AS (SELECT *, coalesce(last_value(CASE WHEN change >= {_TURN} THEN TRUE WHEN change <= {_LINE} THEN FALSE END IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), FALSE) AS in_turn FROM changed),
marked AS (SELECT *, CASE WHEN lag(in_turn) OVER (PARTITION BY user_id ORDER BY event_id) IS DISTINCT FROM in_turn THEN 1 ELSE 0 END AS new FROM stated),
segments AS (SELECT *, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS segment FROM marked)"""


def _with_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight.with_segments(_tracks(spark, sf_dir), ["user_id"], "chunk", "event_id", "heading", _TURN, _LINE)


@_query(f"WITH {_SEGMENTS} SELECT event_id, user_id, in_turn, segment FROM segments")
def q_turns(spark, sf_dir):
    """Rows on lines and in turns, by changes of heading with hysteresis."""
    return _with_segments(spark, sf_dir).select("event_id", "user_id", "in_turn", "segment")


@_query(f"""WITH {_SEGMENTS}, grouped AS (SELECT user_id, segment, bool_or(in_turn) AS in_turn, min_by(t, event_id) AS t_start, max_by(t, event_id) AS t_end,
  count(*) AS n_rows, degrees(atan2(sum(sin(radians(heading))), sum(cos(radians(heading))))) AS mean FROM segments GROUP BY 1, 2),
lined AS (SELECT *, NOT in_turn AND n_rows >= 2 AS counts FROM grouped)
SELECT user_id, segment, in_turn, t_start, t_end, n_rows, round(CASE WHEN mean < 0 THEN mean + 360 ELSE mean END, 4) AS mean_heading,
  CASE WHEN counts THEN count(*) FILTER (WHERE counts) OVER (PARTITION BY user_id ORDER BY segment) END AS line FROM lined""")
def q_flight_lines(spark, sf_dir):
    """Lines and turns with their times, mean heading and line number."""
    lines = flight.flight_lines(_with_segments(spark, sf_dir), ["user_id"], "event_id", "t", "heading", least_rows=2)
    return lines.select("user_id", "segment", "in_turn", "t_start", "t_end", "n_rows", _round("mean_heading", 4), "line")


@_query("""WITH clock AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error'
    THEN hour(ts) * 3600 + minute(ts) * 60 + second(ts) + (millisecond(ts) % 1000) / 1000.0 END AS sec FROM events),
known AS (SELECT *, last_value(sec IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM clock)
SELECT event_id, user_id, round(sec + 86400 * sum(CASE WHEN sec - before < -43200 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id), 3) AS abs_sec
FROM known""")
def q_unwrapped_time(spark, sf_dir):
    """Seconds that go on past midnight."""
    rows = _series(spark, sf_dir).select(
        "event_id", "user_id", series.chunk_of("event_id", _CHUNK).alias("chunk"),
        F.when(F.col("event_type") != "error", seconds_of_day(F.col("clock"))).alias("sec"))
    return flight.unwrapped(rows, ["user_id"], "chunk", "event_id", "sec").select("event_id", "user_id", _round("abs_sec", 3))


_PARTS = f"""{_TRACKS}, stepped AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY event_id) AS step FROM tracks),
parts AS (SELECT *, 1 + CAST(sum(CASE WHEN abs(step) > {_GAP} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS part FROM stepped),
pieces AS (SELECT area, user_id, part, min(t) AS t_start, max(t) AS t_end FROM parts GROUP BY 1, 2, 3)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight.split_sessions(_tracks(spark, sf_dir), ["user_id"], "chunk", "event_id", "t", _GAP)


def _pieces(parts: DataFrame) -> DataFrame:
    return parts.groupBy("area", "user_id", "part").agg(F.min("t").alias("t_start"), F.max("t").alias("t_end"))


@_query(f"WITH {_PARTS} SELECT event_id, user_id, part FROM parts")
def q_sessions_split(spark, sf_dir):
    """Parts of sessions between long pauses."""
    return _parts(spark, sf_dir).select("event_id", "user_id", "part")


@_query(f"""WITH {_PARTS}, reached AS (SELECT *, max(t_end) OVER (PARTITION BY area ORDER BY t_start, t_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM pieces)
SELECT area, user_id, part, CAST(sum(CASE WHEN t_start > r + 60 OR r IS NULL THEN 1 ELSE 0 END) OVER (
  PARTITION BY area ORDER BY t_start, t_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS merged FROM reached""")
def q_sessions_merged(spark, sf_dir):
    """Parts that overlap or follow each other closely, under one number."""
    return flight.merge_sessions(_pieces(_parts(spark, sf_dir)), ["area"], "t_start", "t_end", 60.0).select("area", "user_id", "part", "merged")


@_query(f"""WITH {_PARTS} SELECT event_id, user_id, part FROM parts p WHERE NOT EXISTS (
  SELECT 1 FROM pieces i WHERE i.area = p.area AND i.user_id < p.user_id AND p.t BETWEEN i.t_start AND i.t_end)""")
def q_first_source(spark, sf_dir):
    """Rows that no smaller source of the area covers in time."""
    parts = _parts(spark, sf_dir)
    kept = flight.first_source(parts, _pieces(parts), ["area"], "user_id", "t", "t_start", "t_end", spread=["event_id"])
    return kept.select("event_id", "user_id", "part")


_MOST = 5
_SIGNAL = """signal AS (SELECT event_id, event_id % 1000 * 7919 % 1000 / 10.0 + value * 0.1 AS still,
  CASE WHEN event_type <> 'error' THEN (event_id + 997) % 1000 * 7919 % 1000 / 10.0 + value * 0.2 END AS moved FROM events)"""


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series of all events, with a channel that comes three rows late."""
    wave = lambda shift: (F.col("event_id") + shift) % 1000 * 7919 % 1000 / 10.0
    return _table(spark, sf_dir, "events").select(
        F.lit(1).alias("site"), "event_id", series.chunk_of("event_id", _CHUNK).alias("chunk"), (wave(0) + F.col("value") * 0.1).alias("still"),
        F.when(F.col("event_type") != "error", wave(997) + F.col("value") * 0.2).alias("moved"))


def _lead(k: int) -> str:
    return f"{'lead' if k >= 0 else 'lag'}(moved, {abs(k)}) OVER (ORDER BY event_id)"


@_query(f"WITH {_SIGNAL}" + " UNION ALL ".join(
    f"SELECT {k} AS lag, count(*) AS n, round(corr(x, y), 6) AS correlation FROM (SELECT still AS x, {_lead(k)} AS y FROM signal) WHERE x IS NOT NULL AND y IS NOT NULL"
    for k in range(-_MOST, _MOST + 1)))
def q_lag_correlation(spark, sf_dir):
    """Correlation of two channels at each lag."""
    found = series.lag_correlations(_signal(spark, sf_dir), ["site"], "chunk", "event_id", "moved", "still", _MOST)
    return found.select("lag", "n", _round("correlation", 6))


@_query(f"WITH {_SIGNAL} SELECT event_id, round(still, 6) AS still, round({_lead(3)}, 6) AS moved FROM signal")
def q_lag_corrected(spark, sf_dir):
    """The late channel put back by the lag of the strongest correlation."""
    rows = _signal(spark, sf_dir)
    best = series.best_lag(series.lag_correlations(rows, ["site"], "chunk", "event_id", "moved", "still", _MOST), ["site"])
    by = best.first()["lag"]  # one series, one number
    return series.shifted(rows, ["site"], "chunk", "event_id", ["moved"], by).select("event_id", _round("still", 6), _round("moved", 6))


@_query("""WITH points AS (SELECT user_id % 3 AS area, value AS x, event_id % 97 + 0.25 AS y, CASE WHEN event_type <> 'error' THEN value * 2 + 1 END AS v FROM events),
near AS (SELECT area, floor(x / 10) + i AS c, floor(y / 10) + j AS r, x, y, v FROM points, range(-1, 2) a(i), range(-1, 2) b(j) WHERE v IS NOT NULL),
weighed AS (SELECT *, power(greatest(sqrt((x - (c + 0.5) * 10) ** 2 + (y - (r + 0.5) * 10) ** 2), 0.01), -2) AS w FROM near)
SELECT area, CAST(c AS BIGINT) AS col, CAST(r AS BIGINT) AS "row", (c + 0.5) * 10 AS x, (r + 0.5) * 10 AS y, round(sum(w * v) / sum(w), 6) AS value, count(*) AS n
FROM weighed GROUP BY area, c, r""")
def q_grid(spark, sf_dir):
    """Grid nodes by inverse-distance weights of the readings around them."""
    points = _table(spark, sf_dir, "events").select(
        (F.col("user_id") % 3).alias("area"), F.col("value").alias("x"), (F.col("event_id") % 97 + 0.25).alias("y"),
        F.when(F.col("event_type") != "error", F.col("value") * 2 + 1).alias("v"))
    nodes = grid.gridded(points, ["area"], "x", "y", "v", 10.0)
    return nodes.select("area", "col", "row", "x", "y", _round("value", 6), "n")


# -- text written and read back -----------------------------------------------------------


@_query("""SELECT CAST(user_id AS VARCHAR) AS line, row_number() OVER (ORDER BY user_id, event_id) AS place, CAST(event_id AS DOUBLE) AS event_id,
  round(value, 1) AS value, CASE WHEN event_type <> 'error' THEN round(value * 7.2, 3) END AS heading FROM events""")
def q_xyz_export(spark, sf_dir):
    """Rows exported by line and read back, with their place in the whole text."""
    tracks = _table(spark, sf_dir, "events").select(
        "user_id", "event_id", "value", F.when(F.col("event_type") != "error", F.col("value") * 7.2).alias("heading"))
    path = shared_path(spark, "xyz")
    xyz.write_xyz(tracks, path, "user_id", "event_id", {"event_id": 0, "value": 1, "heading": 3})
    back = xyz.read_xyz(spark, path, ["event_id", "value", "heading"]).withColumns(
        {"export": F.lit(1), "piece": F.col("place._piece"), "mid": F.col("place._mid")})
    ranked = series.ordered_rank(back.drop("place"), ["export"], "piece", "mid", "place")
    return ranked.select("line", F.col("place").cast("bigint"), "event_id", "value", "heading")


def _text_of(rows: DataFrame, path: str, place: list[str]) -> str:
    """Lines written in order, in as many files as there are ranges."""
    rows.repartitionByRange(*place).sortWithinPartitions(*place).select("value").write.text(path)
    return path


def _whole_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a folder of part files as one text."""
    found = survey_text.text_lines(spark, path)
    return found.select(F.lit("plan").alias("file"), F.struct(F.col("file").alias("part"), "block").alias("block"), "mid", "value")


@_query("""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS entity FROM orders),
z AS (SELECT *, last_value(CASE WHEN o_orderkey % 50 < 5 THEN (1 + o_custkey % 60) || 'N' END IGNORE NULLS) OVER (ORDER BY o_orderkey) AS zone FROM o)
SELECT entity, CAST(o_custkey AS VARCHAR) AS label, CASE o_orderstatus WHEN 'F' THEN 'flown' WHEN 'O' THEN 'unflown' ELSE 'flying' END AS state,
  CAST(i AS INT) AS point, CAST(o_totalprice * i AS DECIMAL(18,2))::DOUBLE AS x, o_orderkey::DOUBLE AS y, NULL::DOUBLE AS z, zone AS utm_zone, 80.0::DOUBLE AS radar_height
FROM z, range(1, 4) r(i) WHERE i <= 1 + o_orderkey % 3""")
def q_nav_plan(spark, sf_dir):
    """A navigation plan: each order an entity of one to three points; the zone changes between them."""
    orders = _table(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), lambda c: c.cast("string")
    state = F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "0").otherwise("2")
    points = F.transform(F.sequence(F.lit(1).cast("bigint"), 1 + key % 3), lambda i: F.concat_ws(
        ",", text((F.col("o_totalprice") * i).cast("decimal(18,2)")), text(key), F.lit("none")))
    entity = F.concat_ws(",", F.lit("Coord"), state, text(F.col("o_custkey")), text(1 + key % 3), F.concat_ws(",", points))
    zone = F.concat(F.lit("UTMZone,"), text(1 + F.col("o_custkey") % 60), F.lit("N,,"))
    first = spark.range(1).select(F.lit(-1).cast("bigint").alias("at"), F.lit(0).alias("row"), F.lit("RadarHeight, 80 ,,,").alias("value"))
    lines = orders.select(key.alias("at"), F.lit(2).alias("row"), entity.alias("value")).unionByName(
        orders.where(key % 50 < 5).select(key.alias("at"), F.lit(0).alias("row"), zone.alias("value"))).unionByName(
        orders.where(key % 50 < 5).select(key.alias("at"), F.lit(1).alias("row"), F.lit("!UTMZone,99N is not a record").alias("value"))).unionByName(first)
    plan = survey_text.nav_plan(_whole_lines(spark, _text_of(lines, shared_path(spark, "plan"), ["at", "row"])))
    return plan.select("entity", "label", "state", "point", "x", "y", "z", "utm_zone", "radar_height")


@_query("""SELECT 'C' || o_custkey AS channel, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ordinal,
  CAST(o_orderkey % 7 AS INT) AS first_code, CAST(-1 AS INT) AS last_code, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS coefficient FROM orders""")
def q_compensation(spark, sf_dir):
    """A compensation model: a block per customer, a term per order."""
    orders = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    term = F.concat_ws(",", (F.col("o_orderkey") % 7).cast("string"), F.lit("302,1,-1"), F.lit("-1"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
    block = orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    heads = block.select("o_custkey", F.inline(F.array(*[F.struct(F.lit(i - 9).cast("bigint").alias("at"), v.alias("value")) for i, v in enumerate((
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.lit("12.9647"), F.lit("5.6e-005"), F.col("n").cast("string")))])))
    lines = heads.unionByName(orders.select("o_custkey", F.col("o_orderkey").alias("at"), term.alias("value")))
    terms = survey_text.compensation_terms(_whole_lines(spark, _text_of(lines, shared_path(spark, "model"), ["o_custkey", "at"])))
    return terms.select("channel", "ordinal", F.get("codes", F.lit(0)).alias("first_code"), F.get("codes", F.lit(4)).alias("last_code"), "coefficient")


_RATIOS = {0: [[], [0.2533333333], [0.4121212121, 0.7519191919]], 1: [[], [0.3066666667], [0.5171717171, 0.8033333333]]}


@_query("""WITH c(crystal, b0, b1, b2, a, b, g) AS (VALUES
  (0, 1.5::DOUBLE, 2.0::DOUBLE, 8.0::DOUBLE, 0.2533333333::DOUBLE, 0.4121212121::DOUBLE, 0.7519191919::DOUBLE),
  (1, 1.0, 2.5, 9.0, 0.3066666667, 0.5171717171, 0.8033333333)),
r AS (SELECT l_orderkey, l_linenumber, l_quantity / nullif(l_discount * 10, 0) - b0 AS th, l_extendedprice / 1000 / nullif(l_discount * 10, 0) - b1 AS u,
  l_partkey / 10.0 / nullif(l_discount * 10, 0) - b2 AS k, a, b, g FROM lineitem JOIN c ON crystal = l_orderkey % 2)
SELECT l_orderkey, l_linenumber, round(th, 6) AS th_rate, round(th, 6) AS th_stripped, round(u - a * th, 6) AS u_stripped,
  round(k - b * th - g * (u - a * th), 6) AS k_stripped FROM r""")
def q_radiometric(spark, sf_dir):
    """Counts to stripped rates by the coefficients of their crystal."""
    rows = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") % 2).alias("crystal"), F.col("l_quantity").cast("double").alias("th"),
        (F.col("l_extendedprice") / 1000).alias("u"), (F.col("l_partkey") / 10.0).alias("k"), (F.col("l_discount") * 10).alias("live"))
    known = spark.createDataFrame([(0, [1.5, 2.0, 8.0], _RATIOS[0]), (1, [1.0, 2.5, 9.0], _RATIOS[1])],
                                  "crystal BIGINT, background ARRAY<DOUBLE>, ratios ARRAY<ARRAY<DOUBLE>>")
    found = radiometric.stripped(rows, known, ["crystal"], ["th", "u", "k"], "live")
    return found.select("l_orderkey", "l_linenumber", _round("th_rate", 6), _round("th_stripped", 6), _round("u_stripped", 6), _round("k_stripped", 6))


# -- sessions as files, read by a whole run -----------------------------------------------


def _session_files(spark: SparkSession, rows: DataFrame, folder: str, kind: str) -> None:
    """One text file per session from its lines, in order, under the name that sessions' files have."""
    parts = shared_path(spark, "parts")
    rows.repartition("session").sortWithinPartitions("session", "mid").select("session", "value").write.partitionBy("session").text(parts)
    path = spark._jvm.org.apache.hadoop.fs.Path  # only names are moved here, in whatever store it is
    store = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path(folder))
    for place in store.listStatus(path(parts)):
        if place.isDirectory():
            session = int(place.getPath().getName().split("=")[1])
            files = [f.getPath() for f in store.listStatus(place.getPath()) if f.getPath().getName().startswith("part-")]
            store.rename(files[0], path(f"{folder}/{kind}{session:05d}.txt"))


def _survey(spark: SparkSession, sf_dir: str, tables: bool = True) -> StatusRun:
    """A run over the days of events as sessions: event logs, and magnetometer tables of odd days."""
    folder = f"{shared_path(spark, 'files')}/survey"
    log = _log(spark, sf_dir).select((F.col("day") % 100).alias("session"), "mid", "value")
    _session_files(spark, log, folder, "EVT")
    if tables:
        reading = F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise("####")
        shown = F.concat(F.lpad(F.date_format("ts", "HHmmss.SSS"), 12, " "), F.lpad(reading, 10, " "), F.lpad(F.col("user_id").cast("string"), 8, " "))
        days = _table(spark, sf_dir, "events").where("day(ts) % 2 = 1").select(F.dayofmonth("ts").alias("session"), F.col("event_id").alias("mid"), shown.alias("value"))
        head = days.select("session").distinct().select("session", F.lit(-1).cast("bigint").alias("mid"), F.lit("        Time      Mag1     Xpr").alias("value"))
        _session_files(spark, days.unionByName(head), folder, "MAG")
    return StatusRun(spark, folder)


_DAYS = f"{_LOG}, sessions AS (SELECT DISTINCT day % 100 AS session FROM log)"


@_query(f"""WITH {_LOG} SELECT 'survey' AS dataset, day % 100 AS session, CAST(min(tick) AS DATE) AS date,
  CASE WHEN day % 2 = 1 THEN date_trunc('day', min(tick)) ELSE min(tick) END AS start_ts, max(tick) AS end_ts,
  round(epoch(max(tick)) - epoch(CASE WHEN day % 2 = 1 THEN date_trunc('day', min(tick)) ELSE min(tick) END), 1) AS duration_s,
  CASE WHEN day % 2 = 1 THEN count(*) END AS mag_rows, CAST(NULL AS BIGINT) AS gga_rows, CAST(NULL AS BIGINT) AS spc_rows,
  count(*) FILTER (event_type = 'error' AND value < 50) AS n_critical, count(*) FILTER (event_type = 'purchase') AS n_warnings,
  count(*) FILTER (event_type = 'purchase' AND warning <> 'M4 TimeO') AS n_mux_timeouts FROM log GROUP BY day""")
def q_files_summary(spark, sf_dir):
    """The summary of a run over files, written as a report table and read back."""
    out = shared_path(spark, "report")
    write_table(_survey(spark, sf_dir).session_summary, out)
    return spark.read.parquet(out).withColumn("duration_s", F.round("duration_s", 1))


@_query(f"""WITH {_DAYS}, kinds(kind) AS (VALUES ('MAG'), ('GGA'), ('SPC'), ('Cfg'))
SELECT 'survey' AS dataset, session, kind, 'MISSING' AS state FROM sessions, kinds WHERE kind <> 'MAG' OR session % 2 = 0""")
def q_files_missing(spark, sf_dir):
    """Files that sessions lack."""
    return _survey(spark, sf_dir).files_missing.select("dataset", "session", "kind", "state")


@_query(f"""WITH {_LOG}, m AS (SELECT day % 100 AS session, CASE WHEN event_type <> 'error' THEN value END AS v, hour(ts) * 10000 + minute(ts) * 100 + second(ts)
  + (millisecond(ts) % 1000) / 1000.0 AS clock FROM log WHERE day % 2 = 1)
SELECT session, 'Mag1' AS channel, count(*) AS n, count(*) - count(v) AS n_null, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS min, max(v) AS max FROM m GROUP BY 1
UNION ALL SELECT session, 'Time', count(*), 0, round(avg(clock), 6), round(stddev_samp(clock), 6), min(clock), max(clock) FROM m GROUP BY 1""")
def q_files_stats(spark, sf_dir):
    """Statistics of the channels in fixed-width files whose layout their headers give."""
    stats = _survey(spark, sf_dir).stats("MAG").where("channel IN ('Mag1', 'Time')")
    return stats.select("session", "channel", "n", "n_null", _round("mean", 6), _round("std", 6), "min", "max")


@_query(f"""WITH {_DAYS} SELECT 'survey' AS dataset, session, 'COM9' AS port, CASE WHEN coalesce(rate, 0) > 0 THEN 'CONNECTED' ELSE 'DISCONNECTED' END AS status
FROM sessions LEFT JOIN rates ON day % 100 = session AND port = 'COM9'""")
def q_files_spectrometer(spark, sf_dir):
    """Whether the spectrometer's own port reported characters."""
    return _survey(spark, sf_dir, tables=False).spectrometer_status


@_query(f"""WITH {_LOG}, said AS (
  SELECT day % 100 AS session, 'sensor' AS fact, port, sensor AS said, stamp AS ts FROM log WHERE event_type = 'click'
  UNION ALL SELECT day % 100, 'rate', port, CASE WHEN value < 20 THEN '0.0' ELSE CAST(value AS VARCHAR) END, stamp FROM log WHERE event_type = 'view')
SELECT 'survey' AS dataset, CAST(session AS INT) AS session, fact, port, max(ts) AS ts, max_by(said, ts || said) AS said FROM said GROUP BY 2, 3, 4""")
def q_files_stream(spark, sf_dir):
    """Last facts per port from log files as a stream, a few files a batch."""
    folder = _survey(spark, sf_dir, tables=False).folders
    out = shared_path(spark, "facts")
    log_facts.keep_latest(spark, folder, out, shared_path(spark, "state"), files_per_trigger=8).awaitTermination()
    return spark.read.parquet(out)
