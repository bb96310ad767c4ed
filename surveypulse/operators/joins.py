"""Joins with a side that is usually small but has no fixed bound."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Bytes of a per-session table that are safe to send to every executor.
BROADCAST_BYTES = 32 << 20
# What a value that is no text, and a row, count for.
_VALUE, _ROW = 16, 64

# Big rows per part that a key is spread over in the shuffle join, and the most parts.
PART_ROWS, MOST_PARTS = 1_000_000, 4096


def _bytes(df: DataFrame):
    """An estimate of a row's bytes: its texts, written out where nested, and a share per value."""
    size = F.lit(_ROW)
    for f in df.schema.fields:
        size = size + (F.coalesce(F.octet_length(_text(f.name, f.dataType)), F.lit(0)) + _VALUE)
    return size


def _text(name: str, kind: DataType):
    return F.col(name) if isinstance(kind, StringType) else F.col(name).cast("string")


def join_sized(
    big: DataFrame,
    small: DataFrame,
    keys: Iterable[str],
    how: str = "left",
    spread: Iterable[str] = (),
    max_bytes: int = BROADCAST_BYTES,
    most_rows: int | None = None,
) -> DataFrame:
    """Join a table of one row per key (``left`` or ``inner``), broadcast only if it is measured to be small.

    Measuring runs at once: one aggregate over the small side, nothing is cached. With more than
    ``max_bytes`` both sides are shuffled, and the rows of one key are spread over several
    partitions by the columns in ``spread``: the small side is repeated for each part, so a key
    that holds a third of the big side does not end in one task. The number of parts follows the
    rows of the key that has most (``most_rows``; counted here if it is not given). What follows
    the join cannot mistake this partitioning for one by key, either.
    """
    keys, spread = list(keys), list(spread)
    size = small.agg(F.sum(_bytes(small)).alias("n")).first()["n"] or 0
    if size <= max_bytes:
        return big.join(F.broadcast(small), keys, how)
    if not spread:
        return big.join(small, keys, how)
    if most_rows is None:
        most_rows = big.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    parts = min(MOST_PARTS, max(1, -(-most_rows // PART_ROWS)))
    several = small.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    spread_big = big.withColumn("_part", F.pmod(F.xxhash64(*spread), F.lit(parts)).cast("int"))
    return spread_big.join(several, [*keys, "_part"], how).drop("_part")
