"""Suffix-array dedup (6): byte strings of some length that start more than once in the corpus.

Suffixes that share a string must meet in one shard. A string of ``length`` bytes has a minimiser
(the smallest hash of its ``seed``-byte parts); consecutive strings with the same minimiser travel as
one stretch of text to the minimiser's bucket, each different stretch of a chunk once, with its
count. A bucket is a shard: its stretches that may share a string with another are joined to one
text, whose suffix array is built by induced sorting (``suffixes.py``); permuted common prefixes tell
which strings start twice. Stretches that occur twice as a whole are repeated throughout. A stretch
goes into the text only if the part around its minimiser that any shared string must contain, to its
left or to its right, stands in another stretch of the bucket too.

Which strings are repeated goes back to the chunks that asked; they cut their documents.

Edge cases: null or empty texts have no bytes; texts shorter than ``length`` lose none. Repeated rows
are each other's repeats, so all their strings go. Doc_ids play no part: rows with null or repeated
ids are treated like others. Removing may cut a character of several bytes; the digest is of bytes.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from surveypulse.llm.common import Ranges, expand, from_planes, mix, planes, sliding_min, squeeze
from surveypulse.llm.exchange import ask_and_answer, bucket_count, questions
from surveypulse.llm.substring_dedup import LOW, dealt, distinct
from surveypulse.llm.suffixes import common_prefixes, suffix_array

LENGTH, SEED = 200, 32


class Stretches:
    """A chunk's bytes and their stretches of consecutive strings with one minimiser."""

    def __init__(self, texts: list, length: int, seed: int):
        raw = [(t or "").encode() for t in texts]
        self.buf = b"".join(raw)
        self.begin = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        data = np.frombuffer(self.buf, np.uint8)
        n = len(data) - length + 1
        self.first, self.size, self.seed_at, self.value = (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
        if n <= 0:
            return
        at = np.arange(n + length - seed)
        hashes = Ranges(data).of(at, at + seed)
        key = hashes & ~LOW
        key |= at.view(np.uint64)
        least = sliding_min(key, length - seed + 1)
        del key
        where = (least & LOW).astype(np.int64)
        ok = np.zeros(n + 1, np.int32)  # strings that lie in one document
        sizes = np.diff(self.begin)
        long_ = sizes >= length
        np.add.at(ok, self.begin[:-1][long_], 1)
        np.subtract.at(ok, self.begin[1:][long_] - length + 1, 1)
        ok = np.cumsum(ok[:-1]) > 0
        new = ok.copy()
        new[1:] &= (where[1:] != where[:-1]) | ~ok[:-1]
        # Neighbouring strings of two documents have different minimisers only if they lie apart.
        new[self.begin[:-1][long_]] = True
        self.first = np.flatnonzero(new)
        stop = np.flatnonzero(ok & ~np.append(ok[1:] & ~new[1:], False))
        self.size = stop - self.first + 1
        self.seed_at = where[self.first] - self.first
        self.value = hashes[where[self.first]]

    def strings(self, length: int) -> list[bytes]:
        a = self.first.tolist()
        b = (self.first + self.size + length - 1).tolist()
        return [self.buf[x:y] for x, y in zip(a, b, strict=True)]


def pack(tags: np.ndarray, count: np.ndarray, seed_at: np.ndarray, strings: list[bytes]) -> bytes:
    head = np.array([len(strings)], np.int64).tobytes()
    size = np.array([len(s) for s in strings], np.uint32)
    return squeeze(b"".join([head, planes(tags), planes(count), planes(seed_at), planes(size), *strings]))


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    data = expand(body)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    tags, count, seed_at, size = (from_planes(data, np.uint32, n, 8 + 4 * n * i) for i in range(4))
    end = 8 + 16 * n + np.cumsum(size.astype(np.int64))
    return tags, count, seed_at, [data[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]


def repeated(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each of these different strings, which of its parts of ``length`` bytes start elsewhere too."""
    size = np.array([len(s) for s in strings], np.int64)
    # Letters: 0 ends the text, 1 ends a string, bytes follow.
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    stop = np.cumsum(size + 1) - 1
    s = np.append(text.astype(np.int64) + 2, 0)
    s[stop] = 1
    order = suffix_array(s, 257)
    end = np.append(np.repeat(stop, size + 1), len(s) - 1)
    before, shared = common_prefixes(s, order, end)
    hit = np.flatnonzero(shared >= length)
    flag = np.zeros(len(s), bool)
    flag[hit] = True
    flag[before[hit]] = True
    return [flag[b - n : b - length + 1] for b, n in zip(stop.tolist(), size.tolist(), strict=True)]


def replies(length: int, seed: int, asked: list[bytes]) -> list[bytes | None]:
    side = (length - seed) // 2
    parts = [unpack(q) for q in asked]
    number, strings, where = distinct([s for p in parts for s in p[3]])
    tags, count, seed_at = (np.concatenate([p[i] for p in parts]) for i in range(3))
    total = np.bincount(number, weights=count, minlength=len(strings))
    tags, seed_at = tags[where], seed_at[where].tolist()
    _, group, many = np.unique(tags, return_inverse=True, return_counts=True)
    some = np.flatnonzero(many[group] > 1).tolist()
    left, right = {}, {}
    for i in some:
        s, p = strings[i], seed_at[i]
        if p >= side:
            left[i] = s[p - side : p + seed]
        if len(s) - p >= seed + side:
            right[i] = s[p : p + seed + side]
    seen = [Counter(k.values()) for k in (left, right)]
    alive = [i for i in some if any(i in k and c[k[i]] > 1 for k, c in zip((left, right), seen, strict=True))]
    flags: dict[int, np.ndarray] = dict(zip(alive, repeated([strings[i] for i in alive], length), strict=True)) if alive else {}
    out, at = [], 0
    for p in parts:
        places, sizes, bits = [], [], []
        for k, i in enumerate(number[at : at + len(p[3])].tolist()):
            if total[i] > 1:
                places.append(k)
                sizes.append(len(strings[i]) - length + 1)
                bits.append(np.ones(sizes[-1], bool))
            elif i in flags and flags[i].any():
                places.append(k)
                sizes.append(len(flags[i]))
                bits.append(flags[i])
        at += len(p[3])
        if places:
            head = np.array([len(places)], np.int64).tobytes()
            packed = np.packbits(np.concatenate(bits)).tobytes()
            out.append(squeeze(head + planes(np.array(places, np.uint32)) + planes(np.array(sizes, np.uint32)) + packed))
        else:
            out.append(None)
    return out


def covered(cut: Stretches, length: int, number: np.ndarray, where: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which bytes of the chunk lie in a repeated string."""
    order, found, begin = dealt(cut.value[where], buckets)
    place = dict(zip(found.tolist(), begin.tolist(), strict=False))
    at, bits, filled = np.full(len(where), -1, np.int64), [], 0
    for bucket, body in answers.items():
        data = expand(body)
        n = int(np.frombuffer(data, np.int64, 1)[0])
        item, size = (from_planes(data, np.uint32, n, 8 + 4 * n * i).astype(np.int64) for i in range(2))
        at[order[place[bucket] + item]] = filled + np.cumsum(size) - size
        bits.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=8 + 8 * n), count=int(size.sum())))
        filled += int(size.sum())
    edge = np.zeros(len(cut.buf) + 1, np.int32)
    hit = np.flatnonzero(at[number] >= 0)
    if len(hit):
        n = cut.size[hit]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = (np.repeat(cut.first[hit], n) + step)[np.concatenate(bits)[np.repeat(at[number[hit]], n) + step] > 0]
        edge[start] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED,
    bucket_bytes: int = 4 << 20, chunk_bytes: int = 2 << 20, bytes_out: bool = False,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``bytes_out`` the kept bytes."""
    if not 0 < seed < length:
        raise ValueError("the seed must be shorter than the strings")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = bucket_count(docs, text_col, bucket_bytes)
    fields = [StructField(n, LongType()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [StructField("kept_sha256", StringType())]
    schema = StructType(fields + [StructField("kept", BinaryType())] * bytes_out)

    def cut_up(chunk: pa.Table):
        cut = Stretches(chunk.column("text").to_pylist(), length, seed)
        return cut, *distinct(cut.strings(length))

    def ask(chunk):
        cut, number, strings, where = cut_up(chunk)
        count = np.bincount(number, minlength=len(where)).astype(np.uint32)
        order, found, begin = dealt(cut.value[where], buckets)
        tags = (mix(cut.value[where]) >> np.uint64(40)).astype(np.uint32)
        seed_at = cut.seed_at[where].astype(np.uint32)
        for bucket, a, b in zip(found.tolist(), begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            o = order[a:b]
            yield bucket, pack(tags[o], count[o], seed_at[o], [strings[i] for i in o.tolist()])

    def finish(chunk, answers):
        cut, number, _, where = cut_up(chunk)
        gone = covered(cut, length, number, where, buckets, answers)
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = cut.begin[(cut.begin > 0) & (cut.begin < len(gone))]
        opens[inner] = gone[inner]
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (gone, opens)]
        removed, spans = (x[cut.begin[1:]] - x[cut.begin[:-1]] for x in sums)
        data = np.frombuffer(cut.buf, np.uint8)
        kept = []
        for a, b, n in zip(cut.begin[:-1].tolist(), cut.begin[1:].tolist(), removed.tolist(), strict=True):
            kept.append(data[a:b][~gone[a:b]].tobytes() if n else cut.buf[a:b])
        columns = {
            "doc_id": chunk.column("doc_id"), "n_bytes": np.diff(cut.begin), "n_removed": removed, "n_spans": spans,
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
        }
        return pa.table(columns | ({"kept": pa.array(kept, pa.binary())} if bytes_out else {}))

    return ask_and_answer(questions(picked, "text", ask, chunk_bytes), lambda q: replies(length, seed, q), finish, schema)
