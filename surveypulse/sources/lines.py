"""Scans of text files as lines that keep their order.

``block`` is the byte offset of the file split and ``mid`` the row counter of its task, so
``(block, mid)`` sorts the lines of a file without numbering them in one place. ``block``
also cuts a file of any length into pieces no larger than a split; operators that follow
the order of rows work piece by piece and then join the ends.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse.functions.text import decoded, folder_name
from surveypulse.sources.files import as_list

# Besides line feeds, these characters also end a line of an event log.
_LOG_BREAKS = "[\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"

# Code points that are no characters: the line reader below must see one field and no quotes.
_NO_FIELDS, _NO_QUOTES = "\ufdd0", "\ufdd1"

LINE_SCHEMA = "dataset STRING, session INT, block BIGINT, mid BIGINT"


def file_globs(folders: str | list[str], kind: str, suffix: str = "txt") -> list[str]:
    return [f"{f.rstrip('/')}/{kind}[0-9]*.{suffix}" for f in as_list(folders)]


def load(read: Callable[[list[str]], DataFrame], globs: list[str]) -> DataFrame | None:
    """Read the globs that match any file; None when none does."""
    try:
        return read(globs)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    found = [g for g in globs if len(globs) > 1 and load(read, [g]) is not None]
    return read(found) if found else None


def session_files(df: DataFrame, kind: str, sessions: list[int] | None, suffix: str = "txt") -> DataFrame:
    """Keep files whose name is the one a session number gives.

    The condition uses file metadata only, so Spark drops other files when planning the scan.
    """
    name = F.col("_metadata.file_name")
    wanted = name.rlike(rf"^{kind}(\d{{5}}|[1-9]\d{{5,}})\.{suffix}$")
    if sessions is not None:
        wanted = wanted & name.isin([f"{kind}{s:05d}.{suffix}" for s in sessions])
    return df.where(wanted)


def scan_columns(levels: int) -> list[Column]:
    """Session key and order of a row, from the metadata of its file."""
    name = F.col("_metadata.file_name")
    return [
        folder_name(decoded(F.col("_metadata.file_path")), levels).alias("dataset"),
        F.substring(name, F.lit(4), F.length(name) - 7).cast("int").alias("session"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"),
    ]


def log_lines(
    spark: SparkSession, folders: str | list[str], sessions: list[int] | None = None, levels: int = 1
) -> DataFrame:
    """Lines of event logs: ``dataset, session, block, mid, part, value``."""
    raw = load(spark.read.text, file_globs(folders, "EVT"))
    if raw is None:
        return spark.createDataFrame([], f"{LINE_SCHEMA}, part INT, value STRING")
    scan = session_files(raw, "EVT", sessions)
    return split_log_lines(scan.select(*scan_columns(levels), "value"))


def split_log_lines(lines: DataFrame) -> DataFrame:
    """Cut at the rarer line-ending characters; ``part`` counts the pieces of a line."""
    kept = [c for c in lines.columns if c != "value"]
    whole = F.array(F.col("value"))
    pieces = F.when(F.col("value").rlike(_LOG_BREAKS), F.split("value", _LOG_BREAKS)).otherwise(whole)
    return lines.select(*kept, F.posexplode_outer(pieces).alias("part", "value"))


def raw_table_lines(
    spark: SparkSession, folders: str | list[str], kinds: list[str], sessions: list[int] | None = None, levels: int = 1
) -> DataFrame:
    """All lines of tables with their ``kind``, header included, for stores whose files only Spark opens."""
    found = spark.createDataFrame([], f"{LINE_SCHEMA}, kind STRING, value STRING")
    for kind in kinds:
        raw = load(spark.read.text, file_globs(folders, kind))
        if raw is not None:
            scan = session_files(raw, kind, sessions)
            found = found.unionByName(scan.select(*scan_columns(levels), F.lit(kind).alias("kind"), "value"))
    return found


def listed_files(spark: SparkSession, folders: str | list[str], kinds: dict[str, str], levels: int = 1) -> DataFrame:
    """Session keys, kind and ``filled`` of the files that a listing has; no content is read.

    A scan leaves out files of no bytes, so those only the listing names are empty.
    """
    names, filled = [], spark.createDataFrame([], "path STRING")
    for kind, suffix in kinds.items():
        listing = load(spark.read.format("binaryFile").load, file_globs(folders, kind, suffix))
        if listing is not None:
            names += [(kind, unquote(n)) for n in listing.inputFiles()]
            filled = filled.union(listing.select("path"))
    name = F.substring_index("path", "/", -1)
    number = F.regexp_extract(name, r"^[A-Za-z]{3}(\d{5}|[1-9]\d{5,})\.[a-z]{3}$", 1)
    return (
        spark.createDataFrame(names, "kind STRING, path STRING").where(number != "")
        .join(filled.distinct().withColumn("filled", F.lit(True)), "path", "left")
        .select(folder_name(F.col("path"), levels).alias("dataset"), number.cast("int").alias("session"), "kind",
                F.coalesce("filled", F.lit(False)).alias("filled"))
    )


def table_lines(
    spark: SparkSession, folders: str | list[str], kind: str, sessions: list[int] | None = None, levels: int = 1
) -> DataFrame:
    """Data lines of MAG, GGA or SPC files: header and blank lines are already gone.

    The delimited-text reader is used with a single field per line because it drops the
    first line of each file at the scan, in the task that reads it. With the plain text
    reader the header could only be found by position, at the price of a join with every
    line. A line that holds the separator is still returned whole, by the column for
    malformed records.
    """
    reader = (
        spark.read.schema("value STRING, whole STRING")
        .option("header", True)
        .option("sep", _NO_FIELDS)
        .option("quote", _NO_QUOTES)
        .option("escape", _NO_QUOTES)
        .option("columnNameOfCorruptRecord", "whole")
    )
    raw = load(reader.csv, file_globs(folders, kind))
    if raw is None:
        return spark.createDataFrame([], f"{LINE_SCHEMA}, value STRING")
    scan = session_files(raw, kind, sessions)
    return scan.select(*scan_columns(levels), F.coalesce("whole", "value").alias("value"))
