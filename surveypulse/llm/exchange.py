"""Chunks ask, buckets answer: the shuffle pattern of the operators that look for repeats.

A chunk is a bounded piece of the table (some megabytes of whole documents). It sends one row per
bucket with everything it asks of that bucket, each different thing once, and one row with its own
documents. A bucket sees at most one row per chunk however often a thing occurs, and sends one row
back to each chunk that it has an answer for. So neither copies nor frequent passages gather in a
task: a chunk receives no more than it asked.

Chunks are numbered by scan partition and place in it. ``docs`` must be a frame that gives the same
rows in the same partitions when a task is repeated, as a scan of files does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from surveypulse.llm.common import from_ipc, ship, to_ipc

ROWS = StructType([StructField("key", LongType()), StructField("chunk", LongType()), StructField("body", BinaryType())])
SENT = pa.schema([("key", pa.int64()), ("chunk", pa.int64()), ("body", pa.binary())])
CHUNK_BYTES = 4 << 20


def rows(triples: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*triples, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, SENT.types, strict=True)], schema=SENT)


def chunked(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """Consecutive rows with ``limit`` bytes of text together, or one longer document."""
    held, size = [], 0
    for batch in batches:
        lengths = batch.column(text)
        lengths = pc.fill_null(pc.binary_length(lengths), 0).to_pylist()
        at = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                if i > at:
                    held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, at = [], 0, i
            size += n + 16
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def questions(docs: DataFrame, text: str, ask: Callable[[pa.Table], Iterator[tuple[int, bytes]]], chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, chunk, body): a row per chunk and bucket asked, and with a negative key the chunk itself."""
    ship(docs.sparkSession)

    def send(batches):
        part = TaskContext.get().partitionId()
        for seq, chunk in enumerate(chunked(batches, text, chunk_bytes)):
            me = part << 32 | seq
            out = [(bucket, me, body) for bucket, body in ask(chunk)]
            yield rows([*out, (-1 - me, me, to_ipc(chunk))])

    return docs.mapInArrow(send, ROWS)


def ask_and_answer(
    sent: DataFrame,
    answer: Callable[[list[bytes]], list[bytes | None]],
    finish: Callable[[pa.Table, dict[int, bytes]], pa.Table],
    schema: StructType,
) -> DataFrame:
    """``sent``: what ``questions`` gives. ``answer(questions)``: an answer or None for each question
    of one bucket; ``finish(chunk, {bucket: answer})``: the chunk's result rows."""

    def reply(group: pa.Table) -> pa.Table:
        key = group.column("key")[0].as_py()
        if key < 0:
            return group
        order = group.sort_by("chunk")  # the same answers whatever order the rows arrived in
        got = answer(order.column("body").to_pylist())
        out = [(key, c, a) for c, a in zip(order.column("chunk").to_pylist(), got, strict=True) if a is not None]
        return pa.Table.from_batches([rows(out)])

    def close(group: pa.Table) -> pa.Table:
        keys, bodies = group.column("key").to_pylist(), group.column("body").to_pylist()
        home = next(b for k, b in zip(keys, bodies, strict=True) if k < 0)
        return finish(from_ipc(home), {k: b for k, b in zip(keys, bodies, strict=True) if k >= 0})

    return sent.groupBy("key").applyInArrow(reply, ROWS).groupBy("chunk").applyInArrow(close, schema)


def bucket_count(docs: DataFrame, text: str, bytes_each: int) -> int:
    """Buckets for so many bytes of text each, from the sum over all documents."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    return max(1, -(-total // bytes_each))
