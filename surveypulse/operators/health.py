"""Connection status, lookups with a default, and the check of log against data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse import SESSION_KEYS
from surveypulse.operators.profile import has_data
from surveypulse.reference import RADIOMETRIC_CHANNELS, SENSOR_CHANNELS, SENSORS, per_row


def connection(rate: Column) -> Column:
    """Connected means a known rate above 0."""
    return F.when(F.coalesce(rate, F.lit(0.0)) > 0, "CONNECTED").otherwise("DISCONNECTED")


def port_number(port: Column) -> Column:
    """Sort key of a port: COM10 comes after COM9."""
    return F.regexp_extract(port, r"\d+", 0).try_cast("bigint")


def connected_ports(ports: DataFrame, rates: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Every port with a sensor, whether or not it reported a rate."""
    keys = [*keys, "port"]
    joined = ports.join(rates, keys, "left")
    return joined.withColumns({"status": connection(F.col("rate")), "port_number": port_number(F.col("port"))})


def port_status(
    rates: DataFrame, ports: DataFrame, sensors: DataFrame, keys: Iterable[str] = SESSION_KEYS
) -> DataFrame:
    """Every port that reported a rate; its sensor and name may be unknown (NULL)."""
    names = sensors.select("sensor", "full_name")
    joined = rates.join(ports, [*keys, "port"], "left").join(names, "sensor", "left")
    return joined.select(*keys, "port", "sensor", "full_name", "rate", connection(F.col("rate")).alias("status"),
                         port_number(F.col("port")).alias("port_number"))


def sensor_rows(sessions: DataFrame) -> DataFrame:
    """One row per session and known sensor, with the sensor's fixed port."""
    known = [{"sensor_ordinal": i, "sensor": s, "port": p, "full_name": n} for i, (s, p, n) in enumerate(SENSORS)]
    return per_row(sessions, known)


def sensor_status(sessions: DataFrame, rates: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Status of every known sensor by its fixed port; the logged mapping is not consulted."""
    keys = list(keys)
    joined = sensor_rows(sessions.select(*keys)).join(rates, [*keys, "port"], "left")
    return joined.select(
        *keys, "sensor_ordinal", "sensor", "port", "full_name", "rate", connection(F.col("rate")).alias("status")
    )


def with_default(df: DataFrame, lookup: DataFrame, on: str, value: str, default: str) -> DataFrame:
    """Look up ``value`` in a constant table; ``default`` where it has no entry."""
    joined = df.join(lookup, on, "left")
    return joined.withColumn(value, F.coalesce(value, F.lit(default)))


def channel_state() -> Column:
    """State of one channel of a sensor, by its statistics."""
    return (
        F.when(F.col("n").isNull(), "ABSENT")
        .when(F.col("n_null") == F.col("n"), "ALL_NaN")
        .when(F.col("n_null") > 0, "PARTIAL")
        .otherwise("OK")
    )


def tenths_of_percent(part: Column, whole: Column) -> Column:
    """Percent with one decimal as text, rounded half to even on whole numbers."""
    down = F.floor(1000 * part / whole).cast("bigint")
    twice = 2 * (1000 * part - down * whole)
    tenths = down + F.when((twice > whole) | ((twice == whole) & (down % 2 == 1)), 1).otherwise(0)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def cross_check(
    connected: DataFrame, stats: DataFrame, mapping: DataFrame, keys: Iterable[str] = SESSION_KEYS
) -> DataFrame:
    """Logged status of each port against the data of its sensor.

    ``connected`` has ``port, sensor, status``; ``mapping`` the channels per sensor, a
    constant; ``stats`` one row per channel. A disconnected sensor with any complete channel
    is a mismatch, partial data is not. A connected sensor is a mismatch when all of its
    channels are absent or empty. A sensor without mapped channels is always OK.
    """
    keys = list(keys)
    counts = stats.select(*keys, "channel", "n", "n_null")
    expected = connected.select(*keys, "port", "sensor", "status").join(mapping, "sensor", "left")
    seen = expected.join(counts, [*keys, "channel"], "left").withColumn(
        "_state", F.when(F.col("channel").isNotNull(), channel_state())
    )
    share = tenths_of_percent(F.col("n_null"), F.col("n"))
    text = F.concat(
        "channel", F.lit(":"), F.when(F.col("_state") == "PARTIAL", F.concat(F.lit("PARTIAL("), share, F.lit("%)")))
        .otherwise(F.col("_state")),
    )
    # A group is one port: it holds as many rows as its sensor has mapped channels, four at most.
    verdicts = seen.groupBy(*keys, "port", "sensor", "status").agg(
        F.count("channel").alias("n_channels"),
        F.coalesce(F.bool_or(F.col("_state") == "OK"), F.lit(False)).alias("_any_ok"),
        F.coalesce(F.bool_and(F.col("_state").isin("ALL_NaN", "ABSENT")), F.lit(False)).alias("_none"),
        F.array_sort(F.collect_list(F.when(F.col("channel").isNotNull(), F.struct("ordinal", text.alias("text")))))
        .alias("_texts"),
    )
    disconnected = F.col("status") == "DISCONNECTED"
    mismatch = (disconnected & F.col("_any_ok")) | (~disconnected & F.col("_none"))
    return verdicts.select(
        *keys, "port", "sensor", F.col("status").alias("log_status"), "n_channels",
        F.nullif(F.array_join(F.col("_texts.text"), "; "), F.lit("")).alias("channel_states"),
        F.when(mismatch, "MISMATCH").otherwise("OK").alias("verdict"), port_number(F.col("port")).alias("port_number"),
    )


def data_status(
    sensors: DataFrame, mag_stats: DataFrame, spc_stats: DataFrame, keys: Iterable[str] = SESSION_KEYS
) -> DataFrame:
    """Status of every known sensor with presence of its data, for the comparison of sessions.

    ``sensors`` comes from :func:`sensor_status`. A sensor without mapped channels needs no
    data; the spectrometer may show its data in the radiometric channels instead.
    """
    keys = list(keys)
    owners = F.create_map(*[F.lit(x) for c, s in _owners().items() for x in (c, F.array(*map(F.lit, s)))])
    from_mag = mag_stats.where(has_data()).select(*keys, F.explode(F.try_element_at(owners, F.col("channel"))).alias("sensor"))
    from_spc = spc_stats.where(has_data() & F.col("channel").isin(RADIOMETRIC_CHANNELS)).select(
        *keys, F.lit("GDSpec").alias("sensor")
    )
    shown = from_mag.unionByName(from_spc).distinct().withColumn("_data", F.lit(True))
    free = [s[0] for s in SENSORS if s[0] not in SENSOR_CHANNELS]
    joined = sensors.join(shown, [*keys, "sensor"], "left")
    status = (
        F.when(F.col("status") == "DISCONNECTED", "DISCONNECTED")
        .when(F.col("_data") | F.col("sensor").isin(free), "OK  connected")
        .otherwise("NO DATA")
    )
    return joined.select(*keys, "sensor_ordinal", "sensor", "full_name", status.alias("status"))


def _owners() -> dict[str, list[str]]:
    owners: dict[str, list[str]] = {}
    for sensor, channels in SENSOR_CHANNELS.items():
        for channel in channels:
            owners.setdefault(channel, []).append(sensor)
    return owners
