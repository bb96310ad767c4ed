"""Configuration snapshots: a tree of ``<Object Tag=...><Value>``, flattened.

Parsing and meaning are apart. A task streams each document through an event parser that only notes, in
document order, every tagged element with the place of the element around it: one array per document,
whatever its depth. What tags and ports say is worked out from these arrays by expressions in the same
row, so nothing is shuffled. A document that cannot be parsed is a row with the reason.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from surveypulse import SESSION_KEYS
from surveypulse.functions.text import strip
from surveypulse.reference import CONFIG_SUMMARY_TAGS
from surveypulse.session import ship_package
from surveypulse.sources.lines import file_globs, load, scan_columns, session_files

_PARSED = "state STRING, error STRING, elements ARRAY<STRUCT<at: INT, around: INT, is_object: BOOLEAN, tag: STRING, said: STRING>>"
_ELEMENT = pa.struct([("at", pa.int32()), ("around", pa.int32()), ("is_object", pa.bool_()), ("tag", pa.string()), ("said", pa.string())])


def read_configs(
    spark: SparkSession, folders: str | list[str], sessions: list[int] | None = None, levels: int = 1
) -> DataFrame:
    """Configuration files, parsed: ``dataset, session, state, error, elements``."""
    raw = load(spark.read.format("binaryFile").load, file_globs(folders, "Cfg", "xml"))
    if raw is None:
        return spark.createDataFrame([], f"dataset STRING, session INT, {_PARSED}")
    scan = session_files(raw, "Cfg", sessions, "xml")
    return parse_config(scan.select(*scan_columns(levels)[:2], "content"), "content", SESSION_KEYS)


class _Elements:
    """Columns of the tagged elements of many documents, filled by parse events."""

    def __init__(self) -> None:
        self.around: list[int] = []
        self.is_object: list[bool] = []
        self.tag: list[str] = []
        self.said: list[str | None] = []
        self.starts = [0]
        self.states: list[str] = []
        self.errors: list[str | None] = []

    def add(self, xml: str | bytes | None) -> None:
        first = self.starts[-1]
        # Places of the open elements, -1 for one without a tag; the element whose value is being read.
        open_at: list[int] = []
        reading, depth, pieces = -1, 0, []

        def start(name: str, attributes: dict[str, str]) -> None:
            nonlocal reading, depth
            if reading >= 0:
                keep()  # a value's text ends where an element in it begins
            above = open_at[-1] if open_at else -1
            at = -1
            if attributes.get("Tag"):
                at = len(self.tag)
                self.around.append(above - first if above >= 0 else -1)
                self.is_object.append(name == "Object")
                self.tag.append(attributes["Tag"])
                self.said.append(None)
            if name == "Value" and above >= 0 and self.said[above] is None:
                reading, depth = above, len(open_at)
                self.said[above] = ""
            open_at.append(at)

        def keep() -> None:
            nonlocal reading
            self.said[reading] = "".join(pieces)
            pieces.clear()
            reading = -1

        def end(_: str) -> None:
            open_at.pop()
            if reading >= 0 and len(open_at) == depth:
                keep()

        def text(piece: str) -> None:
            if reading >= 0:
                pieces.append(piece)

        parser = expat.ParserCreate(namespace_separator="}")
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
        try:
            parser.Parse(xml or "", True)
            error = None
        except (expat.ExpatError, ValueError, LookupError) as reason:
            error = str(reason)
            for column in (self.around, self.is_object, self.tag, self.said):
                del column[first:]
        self.starts.append(len(self.tag))
        self.states.append("OK" if error is None else "BROKEN")
        self.errors.append(error)

    def columns(self) -> list[pa.Array]:
        starts = pa.array(self.starts, pa.int32())
        places = pa.array([i - a for a, b in zip(self.starts, self.starts[1:]) for i in range(a, b)], pa.int32())
        values = [places, pa.array(self.around, pa.int32()), pa.array(self.is_object, pa.bool_()),
                  pa.array(self.tag, pa.string()), pa.array(self.said, pa.string())]
        elements = pa.StructArray.from_arrays(values, fields=list(_ELEMENT))
        return [pa.array(self.states, pa.string()), pa.array(self.errors, pa.string()), pa.ListArray.from_arrays(starts, elements)]


def parse_config(df: DataFrame, xml: str, keys: Iterable[str]) -> DataFrame:
    """One row per document of the column ``xml`` (text or bytes) with

    * ``state``, ``OK`` or ``BROKEN``, and ``error``, why;
    * ``elements``: every element with a tag, in document order: its place ``at``, that of the tagged
      element directly ``around`` it (-1: none), whether it is an object, its tag, and what the first
      value in it said (NULL without a value).
    """
    ship_package(df.sparkSession)
    keys = list(keys)
    picked = df.select(*keys, F.col(xml).alias("_xml"))
    fields = StructType([picked.schema[k] for k in keys]).fields
    schema = StructType([*(StructField(f.name, f.dataType) for f in fields), *StructType.fromDDL(_PARSED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Elements()
            for xml in batch.column("_xml").to_pylist():
                found.add(xml)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keys), *found.columns()], [*keys, "state", "error", "elements"])

    return picked.mapInArrow(run, schema)


def broken_configs(parsed: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Configurations that could not be read, with the reason."""
    return parsed.where("state = 'BROKEN'").select(*keys, "error")


def _last_of_each(items: Column, name: str) -> Column:
    """Of structs that begin with ``name`` and a place, sorted: the last of each name."""
    return F.filter(items, lambda x, i: F.coalesce(F.get(items, i + 1)[name] != x[name], F.lit(True)))


def config_tags(parsed: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Flat ``tag, value`` pairs of objects with a value; the last object of a tag in document order wins."""
    valued = F.filter("elements", lambda e: e["is_object"] & e["said"].isNotNull())
    by_tag = F.array_sort(F.transform(valued, lambda e: F.struct(e["tag"].alias("tag"), e["at"].alias("at"), e["said"].alias("said"))))
    # Sorted in a step of its own: the array is used twice below.
    ready = parsed.select(*keys, by_tag.alias("_tags"))
    last = ready.select(*keys, F.inline(_last_of_each(F.col("_tags"), "tag")))
    return last.select(*keys, "tag", strip(F.col("said")).alias("value"))


def config_ports(parsed: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Settings per port: ``com, state, baud, macro``. A port is an object ``COM<n>STATE``, the last one of
    its number; its state is the flat value of that tag, its settings are the first elements ``BAUD`` and
    ``MACRO`` directly in it that say anything but ``?``, and ``?`` if there is none."""
    com = F.regexp_extract("tag", r"^(COM\d+)STATE", 1)
    ports = parsed.select(*keys, "elements", F.inline(F.filter("elements", lambda e: e["is_object"] & e["tag"].rlike(r"^COM\d+STATE"))))

    def setting(tag: str) -> Column:
        inside = F.filter("elements", lambda e: (e["around"] == F.col("at")) & (e["tag"] == tag))
        words = F.transform(inside, lambda e: strip(F.coalesce(e["said"], F.lit(""))))
        return F.coalesce(F.get(F.filter(words, lambda w: w != "?"), F.lit(0)), F.lit("?"))

    same = F.filter("elements", lambda e: e["is_object"] & e["said"].isNotNull() & (e["tag"] == F.col("tag")))
    later = F.exists("elements", lambda e: e["is_object"] & (e["at"] > F.col("at")) & (F.regexp_extract(e["tag"], r"^(COM\d+)STATE", 1) == com))
    return ports.where(~later).select(
        *keys, com.alias("com"), strip(F.try_element_at(same, F.lit(-1))["said"]).alias("state"),
        setting("BAUD").alias("baud"), setting("MACRO").alias("macro"))


def config_summary(tags: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """The six named settings side by side; one that is not set is NULL."""
    wanted = list(CONFIG_SUMMARY_TAGS)
    values = [
        F.max(F.when(F.col("tag") == tag, F.col("value"))).alias(name) for tag, name in CONFIG_SUMMARY_TAGS.items()
    ]
    return tags.where(F.col("tag").isin(wanted)).groupBy(*keys).agg(*values)
