"""Chat formatting (7): conversations in reply order without their quotes, by quotation linking.

Each message is parsed into its own text and quoted passages with their level (the number of ``>``
before the lines). A passage is a paragraph of one level, and a run of paragraphs as a whole; a line
that introduces a quote ("... wrote:") goes with it. Passages are normalised (lower case, white space
as one space) and hashed. A quoted passage's original is the first message of the conversation that
has the passage in its own text, if it came earlier. A message replies to the original of its least
nested linked passage, of several the latest. Linked passages are taken out of the message, with the
line that introduces them; a passage without an original stays where it is, marks included. Messages linked by replies form a thread, named by the
key and the turn of its first message; messages without links form the conversation's main thread. A
thread's messages stand in the order of turn, role and text, so each reply follows what it quotes,
each between role marks. Of each thread, row ``part`` holds the next ``MOST`` messages of that order.

A message is known by its key, a digest of its conversation, turn, role and text; turns only give the
order, and may be repeated. Where several messages of one turn have a passage, the one with the
smallest key is the original. Nothing is grouped by conversation alone: passages are joined by
conversation and hash, originals are one row each, replies are followed by joining pointers to pointers,
and a part is bounded; ranks in a thread of several parts come from counts of ranges of its messages.

Edge cases: null text is an empty message; null roles are written "unknown"; messages with a null turn
have no links and come first in the main thread; messages of a null conversation have no links. The
same message (all four values) on several rows counts once; null and empty text are the same.
"""

from __future__ import annotations

import functools
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.llm.common import ship, written

MOST = 256
MARK = re.compile(r"^(?:[ \t]*>)+[ \t]?")


def introduces(line: str) -> bool:
    end = line.rstrip()
    return end[-6:].lower() == "wrote:" and not re.match(r"\w", end[-7:-6])


def message_key(conv_id: int | None, turn: int | None, role: str, text: str | None) -> bytes:
    head = f"{conv_id}:{turn}:{len(role)}:{role}:".encode()
    return hashlib.blake2b(head + (text or "").encode(), digest_size=16).digest()


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def digest(text: str) -> bytes:
    return hashlib.blake2b(normalised(text).encode(), digest_size=16).digest()


def runs(text: str | None) -> tuple[list[tuple[int, str, str]], list[bool], list[tuple[int, list[list[int]]]]]:
    """Lines as (level, content, whole), which of them stay when no quote is introduced, and runs of
    paragraphs of one level, each paragraph as the numbers of its lines."""
    lines = []
    for line in (text or "").split("\n"):
        m = MARK.match(line)
        lines.append((m[0].count(">"), line[m.end() :], line) if m else (0, line, line))
    keep = [not (k + 1 < len(lines) and lines[k + 1][0] > level and introduces(line)) for k, (level, line, _) in enumerate(lines)]
    found: list[tuple[int, list[list[int]]]] = []
    last, after_blank = None, True
    for k, (level, line, _) in enumerate(lines):
        if not keep[k]:
            continue
        if level != last:
            found.append((level, []))
            last, after_blank = level, True
        if not line.strip():
            after_blank = True
            continue
        if after_blank:
            found[-1][1].append([])
        found[-1][1][-1].append(k)
        after_blank = False
    return lines, keep, found


def parse(text: str | None) -> tuple[str, list[tuple[int, bytes]]]:
    """The message's own text, and (level, hash) of all its passages, level 0 for its own."""
    lines, keep, parts = runs(text)
    found: dict[tuple[int, bytes], None] = {}
    for level, paras in parts:
        for p in [*paras, *([sum(paras, [])] if len(paras) > 1 else [])]:
            found[(level, digest("\n".join(lines[k][1] for k in p)))] = None
    body = "\n".join(line for (level, line, _), stays in zip(lines, keep, strict=True) if stays and level == 0).strip("\n")
    if any(level for level, _, _ in lines):
        body = re.sub(r"\n{3,}", "\n\n", body)
        if body.strip():
            found[(0, digest(body))] = None
    return body, list(found)


def unquoted(text: str | None, originals: set[bytes]) -> str:
    """The text without the quoted passages whose hash is in ``originals`` and their introductions."""
    lines, keep, parts = runs(text)
    gone: set[int] = set()
    for level, paras in parts:
        if level:
            whole = sum(paras, [])
            hashed = lambda p: digest("\n".join(lines[k][1] for k in p))
            gone.update(whole if len(paras) > 1 and hashed(whole) in originals else [k for p in paras if hashed(p) in originals for k in p])
    for k, (level, line, _) in enumerate(lines):  # an empty quoted line goes with the one before
        if level and not line.strip() and k - 1 in gone:
            gone.add(k)
    for k in range(len(lines) - 2, -1, -1):
        if not keep[k] and k + 1 in gone:
            gone.add(k)
    body = "\n".join(whole for k, (_, _, whole) in enumerate(lines) if k not in gone).strip("\n")
    return re.sub(r"\n{3,}", "\n\n", body) if gone else body


def linked(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """key, conv_id, turn, role, body, n_quotes, parent and parent_turn (null: no link), thread and
    thread_turn (null: main thread), one row per row of ``messages``."""
    ship(messages.sparkSession)
    picked = messages.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("unknown")).alias("role"), F.col(text_col).cast("string").alias("text"))
    unit = pa.list_(pa.struct([("level", pa.int32()), ("h", pa.binary())]))

    def run(batches):
        for batch in batches:
            got = [parse(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(message_key, *(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))), pa.binary()),
                 *(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array([b for b, _ in got], pa.string()),
                 pa.array([[{"level": level, "h": h} for level, h in units] for _, units in got], unit),
                 pa.array([t if any(level for level, _ in units) else None for t, (_, units) in zip(batch.column("text").to_pylist(), got, strict=True)], pa.string())],
                ["key", "conv_id", "turn", "role", "body", "units", "quoting"])

    rows = written(picked.mapInArrow(run, "key binary, conv_id long, turn long, role string, body string, units array<struct<level:int,h:binary>>, quoting string"))
    units = rows.select("conv_id", "turn", "key", F.explode("units").alias("u")).select("conv_id", "turn", "key", "u.level", "u.h")
    first = units.where("level = 0 AND turn IS NOT NULL").groupBy("conv_id", "h").agg(F.min(F.struct("turn", "key")).alias("original"))
    quotes = written(units.where("level > 0").distinct().join(first, ["conv_id", "h"]).where("original.turn < turn"))
    best = quotes.groupBy("key").agg(F.min(F.struct("level", (-F.col("original.turn")).alias("o"), F.col("original.key").alias("parent"))).alias("m"))
    links = written(best.select("key", F.col("m.parent").alias("parent"), (-F.col("m.o")).alias("parent_turn")))
    roots = links.select("key", F.col("parent").alias("top"), F.col("parent_turn").alias("top_turn"))
    while True:  # each pass follows twice as many replies
        up = roots.select(F.col("key").alias("top"), F.col("top").alias("higher"), F.col("top_turn").alias("higher_turn"))
        new = written(roots.join(up, "top", "left").select("key", F.coalesce("higher", "top").alias("top"), F.coalesce("higher_turn", "top_turn").alias("top_turn"), F.col("higher").isNotNull().alias("moved")))
        roots = new.select("key", "top", "top_turn")
        if new.where("moved").isEmpty():
            break
    # Threads hold the replies and the messages at their tops.
    threads = roots.union(roots.select(F.col("top").alias("key"), "top", "top_turn").distinct())
    quoted = F.size(F.filter("units", lambda u: u["level"] > 0)).cast("long")

    def remove(batches):
        for batch in batches:
            texts, hashes = batch.column("quoting").to_pylist(), batch.column("hs").to_pylist()
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "own": pa.array([unquoted(t, set(h or ())) for t, h in zip(texts, hashes, strict=True)], pa.string())})

    hashes = quotes.groupBy("key").agg(F.collect_set("h").alias("hs"))
    own = rows.where("quoting IS NOT NULL").select("key", "quoting").dropDuplicates(["key"]).join(hashes, "key", "left").select("key", "quoting", "hs").mapInArrow(remove, "key binary, own string")
    rows = rows.withColumn("n_quotes", quoted).join(own, "key", "left").withColumn("body", F.coalesce("own", "body"))
    return (rows.drop("units", "quoting", "own").join(links, "key", "left")
            .join(threads.select("key", F.col("top").alias("thread"), F.col("top_turn").alias("thread_turn")), "key", "left"))


def conversations(messages: DataFrame, most: int = MOST, **columns: str) -> DataFrame:
    """conv_id, thread (hex; null: main), thread_turn, part, n_messages, n_links, text: a row per ``most`` messages of a thread."""
    key, order = ["conv_id", "thread", "thread_turn"], ["turn", "role", "body", "parent_turn", "key"]
    rows = linked(messages, **columns).withColumn("thread", F.lower(F.hex("thread")))
    rows = written(rows.select(*key, *order).dropDuplicates(["key"]))
    split = parted(rows, key, order, most)
    text = F.concat_ws("\n", F.transform("all", lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["body"], F.lit("\n<|end|>"))))
    return split.groupBy(*key, "part").agg(F.sort_array(F.collect_list(F.struct(*order))).alias("all")).select(
        *key, "part", F.size("all").cast("long").alias("n_messages"),
        F.size(F.filter("all", lambda m: m["parent_turn"].isNotNull())).cast("long").alias("n_links"), text.alias("text"))


def parted(rows: DataFrame, key: list[str], order: list[str], most: int) -> DataFrame:
    """Different ``rows`` with ``part``: 0, and in groups of more than ``most`` the rank in ``order`` by
    ``most``. Ranges of the whole order are counted, so a group is ranked in as many tasks as it needs."""
    def by(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
        on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
        return left.alias("l").join(right.alias("r"), functools.reduce(lambda a, b: a & b, on), how)

    large = written(rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*key))
    if large.isEmpty():
        return rows.withColumn("part", F.lit(0))
    ranges = by(rows, large, key, "left_semi").repartitionByRange(*key, *order).withColumn("slice", F.spark_partition_id())
    ranges = written(ranges)
    earlier = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy(*key, "slice").agg(F.count("*").alias("n"))
    counts = counts.select(*key, "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    ranked = ranges.withColumn("at", F.row_number().over(Window.partitionBy(*key, "slice").orderBy(*order)) - 1)
    placed = by(ranked, counts, [*key, "slice"], "inner").select("l.*", F.floor((F.col("offset") + F.col("at")) / most).cast("int").alias("part"))
    return by(rows, large, key, "left_anti").withColumn("part", F.lit(0)).unionByName(placed.drop("slice", "at"))
