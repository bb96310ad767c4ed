"""Which sessions exist, and which of their files are there."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveypulse import SESSION_KEYS
from surveypulse.functions.text import bad_header, folder_name
from surveypulse.session import ship_package
from surveypulse.operators.joins import join_sized
from surveypulse.reference import per_row

# The file a session has of each kind.
FILE_NAMES = {"EVT": "EVT%05d.txt", "MAG": "MAG%05d.txt", "GGA": "GGA%05d.txt", "SPC": "SPC%05d.txt",
              "Cfg": "Cfg%05d.xml"}
TABLE_KINDS = ("MAG", "GGA", "SPC")

_SCHEMES = {"s3a": "s3", "s3n": "s3"}
_CHUNK = 1 << 16
# Files a task of the header probe opens, about, and the most tasks.
_FILES_EACH, _MOST_TASKS = 64, 10_000


def as_list(value: str | Iterable[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def discover(spark: SparkSession, folders: str | list[str], levels: int = 1) -> DataFrame:
    """Sessions named by ``EVT<digits>.txt`` files, in file-name order.

    ``folders`` are data folders or globs of them. Only the listing is used, no file is opened.
    It is taken as a list of names, not as a scan, which would leave out files of no bytes.
    """
    paths = [f"{f.rstrip('/')}/EVT*.txt" for f in as_list(folders)]
    try:
        names = spark.read.format("binaryFile").load(paths).inputFiles()
        listing = spark.createDataFrame([(unquote(n),) for n in names], "path STRING")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no EVT*.txt files found in {folders}") from error
        raise
    return named_sessions(listing, levels).orderBy("dataset", "file_name")


def named_sessions(listing: DataFrame, levels: int = 1) -> DataFrame:
    """Dataset, session number and folder of each ``path`` that names a session."""
    name = F.substring_index("path", "/", -1)
    digits = F.regexp_extract(name, r"^EVT(\d+)\.txt", 1)
    return (
        listing.where(digits != "")
        .select(
            folder_name(F.col("path"), levels).alias("dataset"),
            digits.cast("int").alias("session"),
            name.alias("file_name"),
            F.substring(F.col("path"), F.lit(1), F.length("path") - F.length(name) - 1).alias("folder"),
        )
    )


def select_sessions(discovered: DataFrame, sessions: list[int] | None = None) -> DataFrame:
    """One row per session to work on: all that were discovered, or the numbers given.

    Raises when nothing is left, and when two folders would share a dataset name.
    """
    chosen = discovered if sessions is None else discovered.where(F.col("session").isin(list(sessions)))
    chosen = chosen.groupBy(*SESSION_KEYS).agg(
        F.min("folder").alias("folder"), (F.min("folder") != F.max("folder")).alias("_shared")
    )
    checked = chosen.groupBy("_shared").agg(F.min("dataset").alias("dataset")).collect()
    if not checked:
        raise ValueError("no sessions found")
    shared = [r.dataset for r in checked if r._shared]
    if shared:
        raise ValueError(f"several folders are named {shared[0]!r}: raise `levels` to tell them apart")
    return chosen.drop("_shared")


def sessions_missing(discovered: DataFrame, sessions: list[int] | None = None) -> DataFrame:
    """Session numbers that were asked for and that no event log names."""
    spark = discovered.sparkSession
    asked = spark.createDataFrame([(int(s),) for s in dict.fromkeys(sessions or [])], "session INT")
    return asked.join(discovered.select("session").distinct(), "session", "left_anti")


def inventory(sessions: DataFrame) -> DataFrame:
    """State and header line of every file a session should have.

    One row per session and kind: ``OK``, ``EMPTY``, ``BAD_HEADER``, ``MISSING``, ``UNREADABLE`` (there, but
    not to be read) or ``UNOPENED`` (in a store that only Spark reads; see ``scanned_states``), with the first
    line of MAG, GGA and SPC files. Each file is opened for its first line only, so a file of any
    size costs one short read; finding headers by a Spark scan would read all bytes of all files.
    Files are dealt to a stated number of tasks, which adaptive execution does not merge.
    """
    ship_package(sessions.sparkSession)
    names = per_row(sessions, [{"kind": k, "_name": v} for k, v in FILE_NAMES.items()])
    path = F.concat_ws("/", "folder", F.format_string("%s%05d%s", F.substring("_name", 1, 3), "session",
                                                      F.substring("_name", 8, 4)))
    wanted = names.select(*SESSION_KEYS, "kind", path.alias("path"))
    tasks = min(_MOST_TASKS, max(1, -(-sessions.count() * len(FILE_NAMES) // _FILES_EACH)))
    wanted = wanted.repartition(tasks, "path")
    schema = "dataset STRING, session INT, kind STRING, path STRING, state STRING, header STRING"
    return _judged(wanted.mapInPandas(_probe, schema))


def _judged(found: DataFrame) -> DataFrame:
    bad = (F.col("state") == "OK") & F.coalesce(bad_header(F.col("header")), F.lit(False))
    return found.withColumn("state", F.when(bad, "BAD_HEADER").otherwise(F.col("state")))


def scanned_states(files: DataFrame, lines: DataFrame, names: DataFrame) -> DataFrame:
    """State and header of the files that ``inventory`` could not open, from Spark's own readers.

    ``lines`` (session keys, kind, block, mid, value) are all lines of the tables, header included, and
    ``names`` (session keys, kind, filled) the files that a listing has. The header costs a scan of the tables, as the first line of block 0.
    """
    keys = [*SESSION_KEYS, "kind"]
    opened, rest = files.where("state <> 'UNOPENED'"), files.where("state = 'UNOPENED'")
    heads = headers_by_scan(lines, keys).drop("first")
    listed = names.groupBy(*keys).agg(F.max("filled").alias("filled"))
    found = rest.drop("state", "header").join(listed, keys, "left").join(heads, keys, "left")
    state = F.when(F.col("filled").isNull(), "MISSING").when(F.col("filled"), "OK").otherwise("EMPTY")
    return opened.unionByName(_judged(found.withColumn("state", state).select(files.columns)))


def files_missing(files: DataFrame) -> DataFrame:
    """Files that a session lacks, has without content, or has with a header that gives no layout."""
    return files.where(F.col("state") != "OK").select(*SESSION_KEYS, "kind", "path", "state")


def headers_by_scan(lines: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Header line per key, with its ``first`` position, from lines that still hold the headers.

    For lines that do not come from files the probe can open. The first line of a file lies
    in its first block, so later blocks are dropped before grouping.
    """
    return (
        lines.where(F.col("block") == 0)
        .groupBy(*keys)
        .agg(F.min_by("value", "mid").alias("header"), F.min("mid").alias("first"))
    )


def without_headers(lines: DataFrame, headers: DataFrame, keys: Iterable[str] = SESSION_KEYS) -> DataFrame:
    """Lines after the header of their key, for the same kind of lines."""
    keys = list(keys)
    joined = join_sized(lines, headers.select(*keys, "first"), keys, spread=["mid"])
    return joined.where((F.col("block") > 0) | (F.col("mid") > F.col("first"))).drop("first")


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    opened: dict[str, tuple[fs.FileSystem, str]] = {}
    for batch in batches:
        found = [_first_line(path, kind in TABLE_KINDS, opened) for path, kind in zip(batch["path"], batch["kind"])]
        batch["state"] = [state for state, _ in found]
        batch["header"] = [line for _, line in found]
        yield batch


def _first_line(path: str, wanted: bool, opened: dict) -> tuple[str, str | None]:
    try:
        store, inner = _locate(path, opened)
    except (OSError, ValueError, NotImplementedError):
        return "UNOPENED", None
    try:
        with store.open_input_stream(inner) as stream:
            data = stream.read(_CHUNK)
            if not data:
                return "EMPTY", None
            if not wanted:
                return "OK", None
            while not (end := re.search(rb"[\r\n]", data)) and (more := stream.read(_CHUNK)):
                data += more
            return "OK", (data[: end.start()] if end else data).decode("utf-8", "replace")
    except FileNotFoundError:
        return "MISSING", None
    except OSError:
        return "UNREADABLE", None


def _locate(path: str, opened: dict) -> tuple[fs.FileSystem, str]:
    local = re.match(r"file:/*(/.*)", path)
    if local or path.startswith("/"):
        return opened.setdefault("file", (fs.LocalFileSystem(), ""))[0], local.group(1) if local else path
    scheme, host, rest = re.match(r"([^:]+)://([^/]*)/(.*)", path).groups()
    root = f"{_SCHEMES.get(scheme, scheme)}://{quote(host, safe=':@')}/"
    if root not in opened:
        opened[root] = fs.FileSystem.from_uri(root)
    store, base = opened[root]
    return store, f"{base.rstrip('/')}/{rest}"
