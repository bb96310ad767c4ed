"""What the operators of this package share: tables, shared folders, packed bytes and words.

Words are maximal runs of characters other than space and U+0009..U+000D. On UTF-8 bytes that is
``bytes.split()``: no byte of a longer character is one of those.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from surveypulse.session import ship_package as ship  # noqa: F401  used by the operators

#: The same set of characters for Java's and Python's regular expressions.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """The text of a tokenizer's JSON, from ``folder`` or else where the installed package has it."""
    if folder is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    else:
        path = os.path.join(folder, name)
    with open(path, encoding="utf-8") as f:
        return f.read()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = getattr(spark.sparkContext, "_surveypulse_folder", None) or tempfile.mkdtemp(prefix="surveypulse-")
        spark.sparkContext._surveypulse_folder = folder
    return folder


def written(df: DataFrame) -> DataFrame:
    """The frame, computed once and read back from the shared folder: later reads survive lost executors."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    _held(df.sparkSession).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _held(spark: SparkSession) -> list[str]:
    """Paths of the written tables of this application that nobody has removed."""
    context = spark.sparkContext
    if not hasattr(context, "_surveypulse_tables"):
        context._surveypulse_tables = []
    return context._surveypulse_tables


def forget_tables(spark: SparkSession) -> None:
    """Leave the tables written so far to the owner of the folder: :func:`remove_tables` won't touch them."""
    _held(spark).clear()


def remove_tables(spark: SparkSession, needed: DataFrame) -> None:
    """Remove the tables written since :func:`forget_tables`, but for those that ``needed`` reads. For a caller that knows that no
    other frame is still to be computed from them, such as a pipeline between its stages."""
    held, kept = _held(spark), needed.inputFiles()
    jvm = spark._jvm
    for path in [p for p in held if not any(p.rsplit("/", 1)[1] in f for f in kept)]:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        held.remove(path)


def squeeze(data: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def planes(a: np.ndarray) -> bytes:
    """The array's bytes, first bytes first: small or near numbers then pack well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() if len(a) else b""


def from_planes(data: bytes, dtype, n: int, at: int = 0) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
    return np.ascontiguousarray(raw.T).view(dtype).reshape(n)


def to_ipc(batch: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_table(batch)
    return squeeze(sink.getvalue().to_pybytes(), 6)


def from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(expand(data)).read_all()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling; kept for the worker's life."""
    p = _powers.get(base, np.ones(1, np.uint64))
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(pow(base, len(p), 1 << 64))])
    _powers[base] = p
    return p[:n]


class Ranges:
    """Hashes of byte ranges of one buffer, from one running sum."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        back = powers(INVERSE, len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * back[start])


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each run of ``width`` items, by doubling."""
    step = 1
    while step * 2 <= width:
        a = np.minimum(a[:-step], a[step:])
        step *= 2
    rest = width - step
    return np.minimum(a[:-rest], a[rest:]) if rest else a
