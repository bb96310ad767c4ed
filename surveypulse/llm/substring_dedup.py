"""Substring dedup (1): windows of consecutive words that an earlier document has too.

Method: super-k-mers. Every window of ``window`` words has a minimiser: of its ``seed``-word runs the
one with the smallest hash, the leftmost of equals. Consecutive windows with the same minimiser make
one packed string, so a string of n windows carries n + window - 1 words instead of n * window.
Equal windows have equal minimisers, so all strings with one minimiser go to one bucket, each
different string of a chunk once, with the smallest and the largest doc_id that has it. In the
bucket, sorting brings equal windows together (by hash, then confirmed word by word), and each
window's smallest doc_id goes back to the chunks whose documents are larger.

Edge cases: null text is a text without words. Documents with fewer words than a window lose
nothing. Of rows with the same doc_id and the same words, all are kept (a window needs a smaller
doc_id). Rows with null doc_id are never the earlier ones; what they share with others is removed
from them. Other columns pass through when asked for.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from surveypulse.llm.common import Ranges, expand, from_planes, mix, planes, sliding_min, squeeze
from surveypulse.llm.exchange import ask_and_answer, bucket_count, questions

WINDOW, SEED = 13, 3
LAST = np.iinfo(np.int64).max
LOW = np.uint64(0x3FFFFFFF)  # bits of a position: chunks hold fewer words than that
WORD_BYTES = regex.compile(rb"[^\x20\x09-\x0D]+")


class Cut:
    """A chunk's documents as one line of words each, and its super-k-mers."""

    def __init__(self, ids: list, texts: list, window: int, seed: int):
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        self.lines = [b" ".join((t or "").encode().split()) for t in texts]
        full = [i for i, line in enumerate(self.lines) if line]
        self.buf = b"\n".join([self.lines[i] for i in full]) + b"\n" if full else b""
        data = np.frombuffer(self.buf, np.uint8)
        self.ends = np.flatnonzero((data == 32) | (data == 10))
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]).astype(np.int64) if len(self.ends) else self.ends
        last = np.flatnonzero(data[self.ends] == 10)  # the last word of each line
        self.n_words = np.zeros(len(self.lines), np.int64)
        self.n_words[full] = np.diff(last, prepend=-1)
        self.word_at = np.concatenate([[0], np.cumsum(self.n_words)])
        self.doc = np.repeat(np.arange(len(self.lines)), self.n_words)
        n = len(self.ends) - window + 1
        self.first, self.windows, self.value = (np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
        if n <= 0:
            return
        hashes = Ranges(data).of(self.starts[: n + window - seed], self.ends[seed - 1 :])
        key = (hashes & ~LOW) | np.arange(len(hashes), dtype=np.uint64)
        at = (sliding_min(key, window - seed + 1) & LOW).astype(np.int64)
        ok = self.doc[:n] == self.doc[window - 1 :]
        new = ok.copy()
        new[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
        self.first = np.flatnonzero(new)
        stop = np.flatnonzero(ok & ~np.append(ok[1:] & ~new[1:], False))
        self.windows = stop - self.first + 1
        self.value = hashes[at[self.first]]

    def strings(self, window: int) -> list[bytes]:
        a, b = self.starts[self.first], self.ends[self.first + self.windows + window - 2]
        return [self.buf[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def distinct(strings: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """For each string its number; the different strings; where each stands first."""
    seen: dict[bytes, int] = {}
    number = np.fromiter((seen.setdefault(s, len(seen)) for s in strings), np.int64, len(strings))
    where = np.empty(len(seen), np.int64)
    where[number[::-1]] = np.arange(len(strings))[::-1]
    return number, list(seen), where


def dealt(value: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order by bucket, the buckets, and where each begins in that order."""
    bucket = (mix(value) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, begin = np.unique(bucket[order], return_index=True)
    return order, found, np.append(begin, len(order))


def smallest(window: int, low: np.ndarray, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every window of every line the smallest of ``low`` over the lines that have that window;
    and where each line's windows begin."""
    buf = b"\n".join(lines) + b"\n"
    data = np.frombuffer(buf, np.uint8)
    ends = np.flatnonzero((data == 32) | (data == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    n_words = np.diff(np.flatnonzero(data[ends] == 10), prepend=-1)
    n_win = n_words - window + 1
    begin = np.concatenate([[0], np.cumsum(n_win)])
    line = np.repeat(np.arange(len(lines)), n_win)
    word = np.arange(begin[-1]) - begin[line] + (np.cumsum(n_words) - n_words)[line]
    hashes = Ranges(data).of(starts[word], ends[word + window - 1])
    order = np.argsort(hashes, kind="stable")
    seen: dict[bytes, int] = {}
    names = np.fromiter((seen.setdefault(w, len(seen)) for w in buf.split()), np.int32, len(ends))

    def joined() -> np.ndarray:
        """Whether each window in the order equals the one before, word by word."""
        same = np.zeros(len(order), bool)
        near = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]]) + 1
        a, b = word[order[near]], word[order[near - 1]]
        good = np.ones(len(near), bool)
        for j in range(window):
            good &= names[a + j] == names[b + j]
        same[near] = good
        return same

    same = joined()
    odd = np.flatnonzero((hashes[order[1:]] == hashes[order[:-1]]) & ~same[1:]) + 1
    if len(odd):  # different windows with one hash: sort those by their words
        for h in np.unique(hashes[order[odd]]):
            run = np.flatnonzero(hashes[order] == h)
            order[run] = sorted(order[run], key=lambda w: (buf[starts[word[w]] : ends[word[w] + window - 1]], w))
        same = joined()
    head = np.flatnonzero(~same)
    out = np.empty(len(order), np.int64)
    if len(order):
        out[order] = np.repeat(np.minimum.reduceat(low[line[order]], head), np.diff(np.append(head, len(order))))
    return out, begin


def pack(tags: np.ndarray, low: np.ndarray, high: np.ndarray, strings: list[bytes]) -> bytes:
    head = np.array([len(strings)], np.int64).tobytes()
    steps = np.diff(low, prepend=0)  # documents come in order: small numbers
    return squeeze(b"".join([head, planes(tags), planes(steps), planes(high - low), b"\n".join(strings)]))


def unpack(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    data = expand(body)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    tags, low = from_planes(data, np.uint32, n, 8), np.cumsum(from_planes(data, np.int64, n, 8 + 4 * n))
    return tags, low, low + from_planes(data, np.int64, n, 8 + 12 * n), data[8 + 20 * n :].split(b"\n")


def replies(window: int, asked: list[bytes]) -> list[bytes | None]:
    parts = [unpack(q) for q in asked]
    tags, low, high = (np.concatenate([p[i] for p in parts]) for i in range(3))
    lines = [s for p in parts for s in p[3]]
    base = np.concatenate([[0], np.cumsum([len(p[3]) for p in parts])])
    # A minimiser with one string of one document has no window twice in different documents.
    _, number, count = np.unique(tags, return_inverse=True, return_counts=True)
    several = (count[number] > 1) | (high > low)
    pick = np.flatnonzero(several)
    out: list[bytes | None] = [None] * len(asked)
    if not len(pick):
        return out
    least, begin = smallest(window, low[pick], [lines[i] for i in pick.tolist()])
    below = np.minimum.reduceat(least, begin[:-1]) < high[pick]
    pick, spans = pick[below], np.stack([begin[:-1], begin[1:]], 1)[below]
    for q in range(len(asked)):
        a, b = np.searchsorted(pick, base[q : q + 2])
        if b > a:
            size = (spans[a:b, 1] - spans[a:b, 0]).astype(np.uint32)
            values = np.concatenate([least[x:y] for x, y in spans[a:b].tolist()])
            head = np.array([b - a, len(values)], np.int64).tobytes()
            place = (pick[a:b] - base[q]).astype(np.uint32)
            out[q] = squeeze(b"".join([head, planes(place), planes(size), planes(values)]))
    return out


def read_reply(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = expand(body)
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    return from_planes(data, np.uint32, n, 16), from_planes(data, np.uint32, n, 16 + 4 * n), from_planes(data, np.int64, m, 16 + 8 * n)


def covered(cut: Cut, window: int, number: np.ndarray, where: np.ndarray, buckets: int, answers: dict[int, bytes]) -> np.ndarray:
    """Which words of the chunk lie in a window that a document with a smaller doc_id has."""
    order, found, begin = dealt(cut.value[where], buckets)
    place = dict(zip(found.tolist(), begin.tolist(), strict=False))
    at, size = np.full(len(where), -1, np.int64), np.zeros(len(where), np.int64)
    values, filled = [], 0
    for bucket, body in answers.items():
        item, n, v = read_reply(body)
        item = order[place[bucket] + item.astype(np.int64)]
        at[item], size[item] = filled + np.cumsum(n) - n, n
        values.append(v)
        filled += len(v)
    hit = np.flatnonzero(at[number] >= 0)
    n = cut.windows[hit]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    win = np.repeat(cut.first[hit], n) + step
    least = np.concatenate(values)[np.repeat(at[number[hit]], n) + step] if values else np.zeros(0, np.int64)
    win = win[least < cut.ids[cut.doc[win]]]
    edge = np.zeros(len(cut.ends) + 1, np.int32)
    edge[win] += 1
    np.subtract.at(edge, win + window, 1)
    return np.cumsum(edge[:-1]) > 0


def without(text: str, gone: np.ndarray) -> str:
    """The text without the marked words; what lies between kept words that were neighbours stays."""
    raw, out, since, last = text.encode(), [], None, -2
    for i, m in enumerate(WORD_BYTES.finditer(raw)):
        if gone[i]:
            continue
        if i != last + 1:
            if since is not None:
                out.append(raw[since:end])
            since = m.start()
        last, end = i, m.end()
    if since is not None:
        out.append(raw[since:end])
    return b" ".join(out).decode()


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED,
    bucket_bytes: int = 4 << 20, keep: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space). With ``keep``, instead all columns of ``docs``, the text without the removed words, and
    ``_n_words``, ``_n_removed``."""
    if not window > seed > 0:
        raise ValueError("the seed must be shorter than the window")
    picked = docs if keep else docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_name, text_name = (id_col, text_col) if keep else ("doc_id", "text")
    buckets = bucket_count(docs, text_col, bucket_bytes)
    counts = [StructField("n_words", LongType()), StructField("n_removed", LongType())]
    if keep:
        schema = StructType([*docs.schema.fields, StructField("_n_words", LongType()), StructField("_n_removed", LongType())])
    else:
        schema = StructType([StructField("doc_id", LongType()), *counts, StructField("kept_sha256", StringType())])

    def cut_up(chunk: pa.Table):
        cut = Cut(chunk.column(id_name).to_pylist(), chunk.column(text_name).to_pylist(), window, seed)
        return cut, *distinct(cut.strings(window))

    def ask(chunk):
        cut, number, strings, where = cut_up(chunk)
        owner = cut.ids[cut.doc[cut.first]]
        low, high = np.full(len(where), LAST), np.full(len(where), np.iinfo(np.int64).min)
        np.minimum.at(low, number, owner)
        np.maximum.at(high, number, owner)
        order, found, begin = dealt(cut.value[where], buckets)
        tags = (mix(cut.value[where]) >> np.uint64(40)).astype(np.uint32)  # enough to tell a bucket's minimisers apart
        for bucket, a, b in zip(found.tolist(), begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            o = order[a:b]
            yield bucket, pack(tags[o], low[o], high[o], [strings[i] for i in o.tolist()])

    def finish(chunk, answers):
        cut, number, _, where = cut_up(chunk)
        gone = covered(cut, window, number, where, buckets, answers)
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[cut.word_at[1:]] - total[cut.word_at[:-1]]
        if keep:
            texts = chunk.column(text_name).to_pylist()
            for i in np.flatnonzero(removed).tolist():
                texts[i] = without(texts[i], gone[cut.word_at[i] : cut.word_at[i + 1]])
            at = chunk.schema.get_field_index(text_name)
            out = chunk.set_column(at, chunk.schema.field(at), pa.array(texts, chunk.schema.field(at).type))
            return out.append_column("_n_words", pa.array(cut.n_words)).append_column("_n_removed", pa.array(removed))
        sums = []
        for i, line in enumerate(cut.lines):
            if removed[i]:
                line = b" ".join(compress(line.split(b" "), (~gone[cut.word_at[i] : cut.word_at[i + 1]]).tolist()))
            sums.append(hashlib.sha256(line).hexdigest())
        return pa.table({"doc_id": chunk.column("doc_id"), "n_words": cut.n_words, "n_removed": removed, "kept_sha256": sums})

    return ask_and_answer(questions(picked, text_name, ask), lambda q: replies(window, q), finish, schema)
