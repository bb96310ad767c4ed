"""Status run: every table about a set of sessions.

All sessions are worked on in one plan, keyed by ``(dataset, session)``. Each file kind is
scanned once for its statistics; these are small, are cached, and answer every question
about completeness, stability and the check against the log. Series are read a second time
only for the plot tables, and then just the channels shown.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse import SESSION_KEYS
from surveypulse import reference as ref
from surveypulse.functions.clock import seconds_of_day
from surveypulse.operators import compare, events, health, profile, series
from surveypulse.sources import config_xml, files, fixed_width, lines

KEYS = list(SESSION_KEYS)


def _ordinal(channels: list[str]) -> Column:
    """Declared place of ``channel``, from 0."""
    return (F.array_position(F.array(*map(F.lit, channels)), F.col("channel")) - 1).cast("int").alias("channel_ordinal")


class StatusRun:
    """Tables of a run, each made on first use. ``close()`` frees the cached ones."""

    def __init__(self, spark: SparkSession, folders: str | list[str], sessions: list[int] | None = None,
                 levels: int = 1):
        self.spark = spark
        self.folders = folders
        self.numbers = sessions
        self.levels = levels
        self._cached: list[DataFrame] = []

    def _keep(self, df: DataFrame) -> DataFrame:
        self._cached.append(df.persist())
        return df

    def close(self) -> None:
        while self._cached:
            self._cached.pop().unpersist()

    # -- which sessions -----------------------------------------------------------------

    @cached_property
    def sessions(self) -> DataFrame:
        found = files.discover(self.spark, self.folders, self.levels)
        return self._keep(files.select_sessions(found, self.numbers))

    @cached_property
    def sessions_missing(self) -> DataFrame:
        found = files.discover(self.spark, self.folders, self.levels)
        return files.sessions_missing(found, self.numbers)

    @cached_property
    def files(self) -> DataFrame:
        found = self._keep(files.inventory(self.sessions))
        if found.where("state = 'UNOPENED'").isEmpty():
            return found
        kinds = {kind: name.rsplit(".", 1)[1] for kind, name in files.FILE_NAMES.items()}
        body = lines.raw_table_lines(self.spark, self.folders, list(files.TABLE_KINDS), self.numbers, self.levels)
        listed = lines.listed_files(self.spark, self.folders, kinds, self.levels)
        return self._keep(files.scanned_states(found, body, listed))

    @cached_property
    def files_missing(self) -> DataFrame:
        return files.files_missing(self.files)

    # -- event log ----------------------------------------------------------------------

    @cached_property
    def log(self) -> DataFrame:
        return lines.log_lines(self.spark, self.folders, self.numbers, self.levels)

    @cached_property
    def facts(self) -> DataFrame:
        return self._keep(events.facts(self.log))

    @cached_property
    def ports(self) -> DataFrame:
        found = events.ports(self.facts)
        return self._keep(found.withColumn("port_number", health.port_number(F.col("port"))))

    @cached_property
    def rates(self) -> DataFrame:
        return self._keep(events.rates(self.facts))

    @cached_property
    def mux(self) -> DataFrame:
        return events.mux_routes(self.facts)

    @cached_property
    def warnings(self) -> DataFrame:
        counted = events.warnings(self.facts)
        return health.with_default(counted, ref.warn_meaning(self.spark), "warning", "meaning", "Unknown")

    @cached_property
    def critical(self) -> DataFrame:
        return events.critical_lines(self.facts)

    @cached_property
    def file_opens(self) -> DataFrame:
        return events.file_opens(self.facts)

    @cached_property
    def session_window(self) -> DataFrame:
        return events.session_window(events.log_fields(self.log))

    @cached_property
    def connected_ports(self) -> DataFrame:
        return health.connected_ports(self.ports.drop("port_number"), self.rates)

    @cached_property
    def port_status(self) -> DataFrame:
        return health.port_status(self.rates, self.ports.drop("port_number"), ref.sensor_ref(self.spark))

    @cached_property
    def sensor_status(self) -> DataFrame:
        return health.sensor_status(self.sessions, self.rates)

    @cached_property
    def spectrometer_status(self) -> DataFrame:
        return self.sensor_status.where("sensor = 'GDSpec'").select(*KEYS, "port", "status")

    # -- configuration ------------------------------------------------------------------

    @cached_property
    def configs(self) -> DataFrame:
        raw = config_xml.read_configs(self.spark, self.folders, self.numbers, self.levels)
        return self._keep(raw.join(self.sessions.select(*KEYS), KEYS, "left_semi"))

    @cached_property
    def config_tags(self) -> DataFrame:
        return config_xml.config_tags(self.configs)

    @cached_property
    def config_ports(self) -> DataFrame:
        return config_xml.config_ports(self.configs)

    @cached_property
    def config_summary(self) -> DataFrame:
        return config_xml.config_summary(self.config_tags)

    @cached_property
    def config_broken(self) -> DataFrame:
        return config_xml.broken_configs(self.configs)

    # -- fixed-width tables -------------------------------------------------------------

    @cached_property
    def layouts(self) -> DataFrame:
        headed = self.files.where("state = 'OK' AND header IS NOT NULL").select(*KEYS, "kind", "header")
        return self._keep(fixed_width.layouts(headed))

    @cached_property
    def channels_present(self) -> DataFrame:
        return fixed_width.channels_present(self.layouts, [*KEYS, "kind"])

    def table_lines(self, kind: str) -> DataFrame:
        """Data lines of a kind with the layout of their file, for the sessions of this run."""
        laid_out = self.layouts.where(F.col("kind") == kind)
        body = lines.table_lines(self.spark, self.folders, kind, self.numbers, self.levels)
        return fixed_width.attach_layout(body, laid_out, spread=["mid"])

    @cached_property
    def _counted(self) -> dict[str, DataFrame]:
        return {
            kind: self._keep(profile.count_cells(fixed_width.number_cells(self.table_lines(kind))))
            for kind in files.TABLE_KINDS
        }

    @cached_property
    def channel_stats(self) -> DataFrame:
        """Statistics of every number channel of every session: the one pass over the tables."""
        named = fixed_width.number_channels(self.layouts, [*KEYS, "kind"])
        counted = None
        for kind, df in self._counted.items():
            tagged = df.withColumn("kind", F.lit(kind))
            counted = tagged if counted is None else counted.unionByName(tagged)
        return self._keep(profile.name_cells(counted, named, [*KEYS, "kind"]))

    def stats(self, kind: str) -> DataFrame:
        return self.channel_stats.where(F.col("kind") == kind)

    @cached_property
    def row_counts(self) -> DataFrame:
        """Rows and columns per file; a file with a time channel has one column more, its time axis."""
        sizes = None
        for kind, df in self._counted.items():
            size = df.where("cell = 0").select(*KEYS, F.lit(kind).alias("kind"), F.col("n").alias("n_rows"))
            sizes = size if sizes is None else sizes.unionByName(size)
        clock = F.create_map(*[F.lit(x) for pair in ref.TIME_CHANNEL.items() for x in pair])
        axis = F.array_contains("channels", F.try_element_at(clock, F.col("kind"))).cast("int")
        width = self.layouts.select(*KEYS, "kind", (F.size("channels") + axis).alias("n_columns"))
        joined = width.join(sizes, [*KEYS, "kind"], "left")
        return joined.withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))

    @cached_property
    def column_classes(self) -> DataFrame:
        return profile.classify(self.channel_stats, ref.skip_channels(self.spark))

    @cached_property
    def gps_quality(self) -> DataFrame:
        names = F.create_map(*[F.lit(x) for pair in ref.GPS_CHANNELS for x in pair])
        shown = profile.gated(self.stats("GGA"), [c for c, _ in ref.GPS_CHANNELS], "dHdop", KEYS)
        grade = F.when(F.col("channel") == "dHdop", profile.quality_grade(F.col("mean")))
        return shown.select(*KEYS, _ordinal([c for c, _ in ref.GPS_CHANNELS]), "channel",
                            F.try_element_at(names, F.col("channel")).alias("label"), "mean", "std", grade.alias("grade"))

    @cached_property
    def position_scatter(self) -> DataFrame:
        shown = profile.gated(self.stats("GGA"), ref.POSITION_CHANNELS, "dHdop", KEYS)
        return shown.select(*KEYS, _ordinal(ref.POSITION_CHANNELS), "channel", "std")

    @cached_property
    def environment(self) -> DataFrame:
        shown = self.stats("SPC").where(F.col("channel").isin(ref.ENVIRONMENT_CHANNELS) & profile.has_data())
        told = shown.join(ref.column_desc(self.spark), "channel", "left")
        return told.select(*KEYS, _ordinal(ref.ENVIRONMENT_CHANNELS), "channel", "description", "mean", "std",
                           profile.is_constant(F.col("std")).alias("constant"))

    @cached_property
    def stability(self) -> DataFrame:
        expected = compare.expand(self.sessions.select(*KEYS), ref.ANALYSIS_CHANNELS)
        measured = self.channel_stats.drop("ordinal")
        joined = expected.join(measured, [*KEYS, "kind", "channel"], "left")
        return profile.stability(joined, ref.thresholds(self.spark), ref.column_desc(self.spark)).select(
            *KEYS, "channel_ordinal", "channel", "kind", "description", "mean", "std", "min", "max",
            "unit", "max_std", "status",
        )

    @cached_property
    def cross_check(self) -> DataFrame:
        return health.cross_check(self.connected_ports, self.stats("MAG"), ref.sensor_channels(self.spark))

    @cached_property
    def magnetometer_gaps(self) -> DataFrame:
        shown = self.stats("MAG").where(F.col("channel").isin("Mag1", "Mag2"))
        return shown.select(*KEYS, "channel", "n", "n_null", profile.percent_missing().alias("pct_null"))

    # -- series and plots ---------------------------------------------------------------

    def series(self, kind: str, channels: list[str] | None = None) -> DataFrame:
        """Typed rows of a kind in wide form, with ``time_sec``; all channels unless some are named."""
        own = self.layouts.where(F.col("kind") == kind)
        names = fixed_width.all_channels(own) if channels is None else channels
        clock = ref.TIME_CHANNEL[kind]
        read = list(dict.fromkeys([*names, clock]))
        rows = fixed_width.wide_table(self.table_lines(kind), read)
        timed = rows.withColumn("_sec", seconds_of_day(F.col(clock)))
        elapsed = series.with_elapsed(timed, KEYS, "block", "mid", "_sec", start=self._starts[kind])
        return elapsed.select(*KEYS, "block", "mid", "time_sec", *names)

    @cached_property
    def _starts(self) -> dict[str, DataFrame]:
        """First valid time per session and kind."""
        found = {}
        for kind, clock in ref.TIME_CHANNEL.items():
            rows = fixed_width.wide_table(self.table_lines(kind), [clock])
            timed = rows.withColumn("_sec", seconds_of_day(F.col(clock)))
            found[kind] = self._keep(series.first_valid(timed, KEYS, "block", "mid", "_sec"))
        return found

    def plot_series(self, kind: str) -> DataFrame:
        return self.series(kind, series.set_channels(ref.PLOT_SETS[kind]))

    def gaps(self, kind: str) -> DataFrame:
        """Missing spans per plot, on the elapsed axis.

        Found on the time of day; the start of the session is taken off the few spans
        afterwards, not off every row before.
        """
        sets = ref.PLOT_SETS[kind]
        clock = ref.TIME_CHANNEL[kind]
        channels = series.set_channels(sets)
        rows = fixed_width.wide_table(self.table_lines(kind), [*channels, clock])
        timed = rows.withColumn("_sec", seconds_of_day(F.col(clock)))
        live = series.live_from_stats(self.stats(kind), KEYS, channels)
        spans = series.gap_intervals(timed, KEYS, "block", "mid", "_sec", sets, live)
        joined = spans.join(self._starts[kind], KEYS, "left")
        return joined.select(
            *KEYS, F.lit(kind).alias("kind"), "plot_set", (F.col("t_start") - F.col("first_value")).alias("t_start"),
            (F.col("t_end") - F.col("first_value")).alias("t_end"), "n_rows",
        )

    @cached_property
    def gap_intervals(self) -> DataFrame:
        found = [self.gaps(kind) for kind in files.TABLE_KINDS]
        return found[0].unionByName(found[1]).unionByName(found[2])

    @cached_property
    def plot_captions(self) -> DataFrame:
        pairs = [(kind, name, c, i) for kind, sets in ref.PLOT_SETS.items() for name, channels in sets.items()
                 for i, c in enumerate(channels)]
        shown = self.spark.createDataFrame(pairs, "kind STRING, plot_set STRING, channel STRING, channel_ordinal INT")
        valid = self.channel_stats.where(profile.has_data()).join(shown, ["kind", "channel"])
        return valid.select(*KEYS, "kind", "plot_set", "channel_ordinal", "channel", "mean", "std")

    # -- summary and comparison ---------------------------------------------------------

    @cached_property
    def session_summary(self) -> DataFrame:
        # A file that is there and has no rows counts 0; of a missing or unreadable one nothing is known.
        states = self.files.select(*KEYS, "kind", "state").join(self.row_counts, [*KEYS, "kind"], "left")
        size = F.when(F.col("state") == "EMPTY", F.lit(0)).otherwise(F.col("n_rows"))
        rows = states.groupBy(*KEYS).agg(
            *[F.max(F.when(F.col("kind") == k, size)).alias(f"{k.lower()}_rows") for k in files.TABLE_KINDS]
        )
        critical = self.critical.groupBy(*KEYS).agg(F.count("*").alias("n_critical"))
        warned = events.warning_totals(self.warnings)
        joined = self.sessions.select(*KEYS)
        for part in (self.session_window, rows, critical, warned):
            joined = joined.join(part, KEYS, "left")
        counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_critical", "n_warnings", "n_mux_timeouts")]
        sizes = [f"{k.lower()}_rows" for k in files.TABLE_KINDS]
        return joined.select(*KEYS, F.to_date("start_ts").alias("date"), "start_ts", "end_ts", "duration_s", *sizes, *counts)

    @cached_property
    def _compared(self) -> DataFrame:
        return compare.with_company(self.sessions, KEYS, ["dataset"])

    @cached_property
    def compare_status(self) -> DataFrame:
        known = health.sensor_status(self._compared, self.rates)
        return health.data_status(known, self.stats("MAG"), self.stats("SPC"))

    @cached_property
    def compare_means(self) -> DataFrame:
        expected = compare.expand(self._compared, ref.COMPARE_CHANNELS)
        return compare.compare_means(expected, self.channel_stats, KEYS, ["dataset"])

    def tables(self, plots: bool = True) -> dict[str, DataFrame]:
        """All result tables by name."""
        names = [
            "sessions", "sessions_missing", "files_missing", "sensor_status", "ports", "rates", "port_status", "mux", "warnings",
            "critical", "file_opens", "session_window", "config_tags", "config_ports", "config_summary",
            "config_broken", "channels_present", "channel_stats", "row_counts", "column_classes", "gps_quality",
            "position_scatter", "spectrometer_status", "environment", "stability", "cross_check",
            "magnetometer_gaps", "session_summary", "compare_status", "compare_means",
        ]
        if plots:
            names += ["gap_intervals", "plot_captions"]
        found = {name: getattr(self, name) for name in names}
        if plots:
            found |= {f"plot_series_{kind.lower()}": self.plot_series(kind) for kind in files.TABLE_KINDS}
        return found
