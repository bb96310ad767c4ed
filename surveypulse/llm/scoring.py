"""LM scoring (10): a log-bilinear model by noise-contrastive estimation, and unigram base scores.

Words are counted exactly over all training documents: chunks send their different words, once each
with a count, to the words' buckets. The model's symbols are an end sign (which also stands before a
text's first word), every word with ``LEAST`` training tokens that make up one in ``SHARE`` of all or
more, and one sign for the rarer ones; so there are at most ``SHARE`` of them, however large the corpus
is. A symbol w after c has the score q_c . r_w + b_w.

All that training needs are the counts of the different symbol pairs over all training documents.
They are merged in tasks, dealt by context and, a second time, by target. The model learns to tell each
pair from ``NOISE`` times as many with the second symbol drawn by frequency. For fixed r and b that is
a concave problem for each q_c alone, and for fixed q for each (r_w, b_w) alone: each half of a sweep is
one Spark job that takes Newton steps for its rows. Noise is drawn in equal steps of cumulative
frequency, shared by the rows of a job, so it enters by matrix products. Scores are then normalised over
all symbols, block by block in tasks; as they have one context each, a normaliser belongs to a context.
A rarer word has the probability of their sign times its own smoothed share among them, so the
probabilities of all words, with one place for the unseen, sum to one.

Edge cases: null, blank and empty texts have one token, the end. A null doc_id counts as the empty
text for the split and is for training. Without training documents each symbol is equally likely.
Repeated rows count each time. Of very long texts every token is scored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from surveypulse.llm.bpe import Numbers
from surveypulse.llm.common import expand, from_ipc, from_planes, planes, squeeze, written
from surveypulse.llm.exchange import ask_and_answer, bucket_count, questions
from surveypulse.llm.minhash import LOWER

LEAST, SHARE = 5, 1 << 17
SIZE, NOISE, DRAWN, SWEEPS, RIDGE = 32, 8, 256, 5, 2.0
FOLDS, HELD = 7, 2
RARE, END = 0, 1
#: What no word can be: it stands for the end of a text among the words.
END_WORD = b"\n"
#: Pairs that a task holds before it sends them.
HELD_PAIRS = 4 << 20


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().translate(LOWER).split(), END_WORD]


class Tokens:
    """A chunk's tokens as numbers of its different words."""

    def __init__(self, chunk: pa.Table):
        self.ids = chunk.column("doc_id").to_pylist()
        self.held = np.array([held_out(i) for i in self.ids], bool)
        known = Numbers()
        lists = [np.fromiter(map(known.__getitem__, tokens(t)), np.int32) for t in chunk.column("text").to_pylist()]
        self.words = list(known)
        self.n = np.array([len(x) for x in lists], np.int64)
        self.number = np.concatenate(lists) if lists else np.zeros(0, np.int32)
        self.start = np.cumsum(self.n) - self.n
        self.doc = np.repeat(np.arange(len(lists)), self.n)

    def counts(self) -> np.ndarray:
        """Of each word in training documents."""
        return np.bincount(self.number[~self.held[self.doc]], minlength=len(self.words))

    def dealt(self, buckets: int) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The words' buckets in use, an order of the words by bucket, and where each bucket begins."""
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in self.words), np.int64, len(self.words))
        order = np.argsort(bucket, kind="stable")
        found, begin = np.unique(bucket[order], return_index=True)
        return found.tolist(), order, np.append(begin, len(order))


def asking(buckets: int):
    def ask(chunk: pa.Table):
        t = Tokens(chunk)
        count = t.counts()
        found, order, begin = t.dealt(buckets)
        for bucket, a, b in zip(found, begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            o = order[a:b]
            yield bucket, squeeze(np.array([b - a], np.int64).tobytes() + planes(count[o]) + b" ".join(t.words[i] for i in o.tolist()))

    return ask


def unpack(body: bytes) -> tuple[np.ndarray, list[bytes]]:
    data = expand(body)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    return from_planes(data, np.int64, n, 8), data[8 + 8 * n :].split(b" ")


def summed(asked: list[bytes]) -> tuple[list[list[bytes]], Counter]:
    total: Counter = Counter()
    lists = []
    for body in asked:
        count, words = unpack(body)
        lists.append(words)
        for w, c in zip(words, count.tolist(), strict=True):
            total[w] += c
    return lists, total


def answer(asked: list[bytes]) -> list[bytes]:
    lists, total = summed(asked)
    return [squeeze(planes(np.fromiter(map(total.__getitem__, words), np.int64, len(words)))) for words in lists]


def name(word: bytes) -> bytes:
    """Of bounded length: long words by their digest."""
    return word if len(word) <= 16 else hashlib.blake2b(word, digest_size=17).digest()


def vocabulary(sent: DataFrame, least: int, share: int) -> tuple[int, int, list[tuple[bytes, int]], int]:
    """Training tokens, different ones, names and counts of the words that are symbols, and the ends."""
    def count(group: pa.Table) -> pa.Table:
        _, total = summed(group.column("body").to_pylist())
        ends = total.pop(END_WORD, 0)
        seen = [c for c in total.values() if c]
        top = [(name(w), c) for w, c in total.items() if c >= least]
        return pa.table({
            "word": pa.array([None, *(w for w, _ in top)], pa.binary()), "n": pa.array([ends, *(c for _, c in top)], pa.int64()),
            "all_": pa.array([sum(seen)] + [0] * len(top), pa.int64()), "words": pa.array([len(seen)] + [0] * len(top), pa.int64()),
        })

    parts = written(sent.where("key >= 0").groupBy("key").applyInArrow(count, "word binary, n long, all_ long, words long"))
    sums = parts.agg(F.sum("all_"), F.sum("words"), F.sum(F.when(F.col("word").isNull(), F.col("n")))).first()
    n, words, ends = (x or 0 for x in sums)
    top = parts.where("word IS NOT NULL").where(F.col("n") * share >= n + ends).orderBy(F.desc("n"), "word")
    return n + ends, words + (ends > 0), [(bytes(r["word"]), r["n"]) for r in top.collect()], ends  # at most ``share`` words


def symbols(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    return np.fromiter((known.get(name(w), RARE) for w in words), np.int64, len(words))


def pairs(t: Tokens, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Each token's symbol and the one before it."""
    now = symbols(t.words, known)[t.number]
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[t.start] = END
    return now, before


COUNTED = "block int, pairs binary, n binary"


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, with the sums of their counts."""
    found, which = np.unique(np.concatenate(codes), return_inverse=True)
    return found, np.bincount(which, np.concatenate(counts), len(found)).astype(np.int64)


def packed(blocks: int, v: int, codes: np.ndarray, counts: np.ndarray):
    """Rows of ``COUNTED``: codes (row * v + column, in order) by block of row, as differences."""
    if not len(codes):
        return
    block = codes // v % blocks
    order = np.argsort(block, kind="stable")
    found, begin = np.unique(block[order], return_index=True)
    for k, at in zip(found.tolist(), np.split(order, begin[1:]), strict=True):
        body = [squeeze(planes(np.diff(codes[at], prepend=0))), squeeze(planes(counts[at]))]
        yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "pairs": body[:1], "n": body[1:]})


def unpacked(pairs_: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = expand(pairs_), expand(n)
    return np.cumsum(from_planes(codes, np.int64, len(codes) // 8)), from_planes(counts, np.int64, len(counts) // 8)


def pair_counts(sent: DataFrame, known: dict[bytes, int], v: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """How often symbols follow symbols in training documents, as ``COUNTED`` with the first symbol as
    row, and with the second."""
    shared = sent.sparkSession.sparkContext.broadcast(known)  # at most ``SHARE`` + 1 names

    def count(batches):
        codes, counts, held = [], [], 0
        for batch in batches:
            for body in batch.column("body").to_pylist():
                t = Tokens(from_ipc(body))
                now, before = pairs(t, shared.value)
                use = ~t.held[t.doc]
                code, n = np.unique(before[use] * v + now[use], return_counts=True)
                codes.append(code)
                counts.append(n)
                held += len(code)
            if held > HELD_PAIRS:
                code, n = merged(codes, counts)
                codes, counts, held = [code], [n], len(code)
                if held > HELD_PAIRS // 2:
                    yield from packed(blocks, v, code, n)
                    codes, counts, held = [], [], 0
        if codes:
            yield from packed(blocks, v, *merged(codes, counts))

    def add(group: pa.Table) -> pa.Table:
        found = [unpacked(p, n) for p, n in zip(group.column("pairs").to_pylist(), group.column("n").to_pylist(), strict=True)]
        code, n = merged([c for c, _ in found], [n for _, n in found])
        return pa.Table.from_batches(packed(blocks, v, code, n))

    def turned(batches):
        for batch in batches:
            for p, n in zip(batch.column("pairs").to_pylist(), batch.column("n").to_pylist(), strict=True):
                code, counts = unpacked(p, n)
                yield from packed(blocks, v, *merged([code % v * v + code // v], [counts]))

    by_context = written(sent.where("key < 0").select("body").mapInArrow(count, COUNTED).repartition(blocks, "block").groupBy("block").applyInArrow(add, COUNTED))
    return by_context, written(by_context.mapInArrow(turned, COUNTED).repartition(blocks, "block").groupBy("block").applyInArrow(add, COUNTED))


def drawn(share: np.ndarray, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``most`` symbols in equal steps of cumulative share, as different symbols with their weights."""
    total = np.cumsum(share / share.sum())
    at = (np.arange(most) + np.random.default_rng(seed).random()) / most
    found, times = np.unique(np.minimum(np.searchsorted(total, at, "right"), len(share) - 1), return_counts=True)
    return found, times / most


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def improved(column: np.ndarray, n: np.ndarray, begin: np.ndarray, x: np.ndarray, feature: np.ndarray, offset: np.ndarray,
             own: np.ndarray, fakes: np.ndarray, noise: tuple[np.ndarray, np.ndarray], ridge: float = RIDGE, steps: int = 1) -> np.ndarray:
    """Newton steps for the vectors ``x`` of rows, whose pairs (``column``, ``n``) lie between ``begin``s.
    A pair's logit is x . feature + offset of its column + ``own`` of its row; ``fakes``: noise pairs of a row."""
    size = feature.shape[1]
    drawn_, weight = noise
    noisy = feature[drawn_]
    squares = (noisy[:, :, None] * noisy[:, None, :]).reshape(len(drawn_), -1)
    x = x.astype(np.float64)
    for _ in range(steps):
        s = sigmoid(x @ noisy.T + offset[drawn_] + own[:, None])
        pull = -(s * weight * fakes[:, None]) @ noisy - ridge * x
        bend = ((s * (1 - s) * weight * fakes[:, None]) @ squares).reshape(-1, size, size) + ridge * np.eye(size)
        for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
            f = feature[column[a:b]]
            t = sigmoid(f @ x[i] + offset[column[a:b]] + own[i])
            pull[i] += (n[a:b] * (1 - t)) @ f
            bend[i] += (f * (n[a:b] * t * (1 - t))[:, None]).T @ f
        step = np.linalg.solve(bend, pull[:, :, None])[:, :, 0]
        x += step / np.maximum(1, np.linalg.norm(step, axis=1) / 2)[:, None]
    return x


def half(table: DataFrame, v: int, x: np.ndarray, feature: np.ndarray, offset: np.ndarray, own: np.ndarray, fakes: np.ndarray, noise) -> np.ndarray:
    """``x`` after Newton steps for all its rows that have pairs in ``table``, each block in a task."""
    shared = table.sparkSession.sparkContext.broadcast((x, feature, offset, own, fakes, noise))  # v vectors each

    def run(batches):
        x_, feature_, offset_, own_, fakes_, noise_ = shared.value
        for batch in batches:
            for p, n in zip(batch.column("pairs").to_pylist(), batch.column("n").to_pylist(), strict=True):
                code, counts = unpacked(p, n)
                row, begin = np.unique(code // v, return_index=True)
                begin = np.append(begin, len(code))
                for k in range(0, len(row), 256):
                    at, edge = row[k : k + 256], begin[k : k + 257]
                    inside = slice(edge[0], edge[-1])
                    got = improved(code[inside] % v, counts[inside], edge - edge[0], x_[at], feature_, offset_, own_[at], fakes_[at], noise_)
                    yield pa.RecordBatch.from_pydict({"at": [at.tobytes()], "x": [got.astype(np.float32).tobytes()]})

    out = x.copy()
    for r in table.mapInArrow(run, "at binary, x binary").collect():  # v vectors in all
        out[np.frombuffer(r["at"], np.int64)] = np.frombuffer(r["x"], np.float32).reshape(-1, x.shape[1])
    shared.unpersist()
    return out


def train(by_context: DataFrame, by_target: DataFrame, count: np.ndarray, size: int = SIZE, noise: int = NOISE, sweeps: int = SWEEPS, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(q, r and b side by side): vectors of all symbols, ``count`` of them in training, as context and as target."""
    v = len(count)
    share = (count + 1.0) / (count.sum() + v)
    log_noise = np.log(noise * share)
    q = np.zeros((v, size), np.float32)
    r = np.random.default_rng(seed).normal(0, 0.3, (v, size + 1)).astype(np.float32) * (count > 0)[:, None]
    r[:, size] = np.log(share)
    nothing, one = np.zeros(v), np.ones((v, 1), np.float32)
    for sweep in range(sweeps if count.any() else 0):
        q = half(by_context, v, q, r[:, :size], r[:, size] - log_noise, nothing, noise * count, drawn(share, DRAWN, 2 * sweep))
        r = half(by_target, v, r, np.hstack([q, one]), nothing, -log_noise, noise * share * count.sum(), drawn(count, DRAWN, 2 * sweep + 1))
    return q, r


def log_sums(spark, q: np.ndarray, r: np.ndarray, wide: int = 1024) -> np.ndarray:
    """Of each context, the logarithm of the sum of exp(score) over all symbols."""
    v = len(q)
    shared = spark.sparkContext.broadcast((q, r))

    def run(batches):
        q_, r_ = shared.value
        bias = r_[:, -1].astype(np.float64)
        for batch in batches:
            for k in batch.column("id").to_pylist():
                mine = q_[k * wide : (k + 1) * wide].astype(np.float64)
                total = np.full(len(mine), -np.inf)
                for a in range(0, v, wide):
                    score = mine @ r_[a : a + wide, :-1].T + bias[a : a + wide]
                    top = score.max(1)
                    total = np.logaddexp(total, top + np.log(np.exp(score - top[:, None]).sum(1)))
                yield pa.RecordBatch.from_pydict({"id": pa.array([k], pa.int64()), "z": [total.tobytes()]})

    blocks = -(-v // wide)
    rows = spark.range(0, blocks, 1, min(blocks, 4096)).mapInArrow(run, "id long, z binary").collect()  # v numbers
    shared.unpersist()
    return np.concatenate([np.frombuffer(x["z"]) for x in sorted(rows, key=lambda x: x["id"])])


def log_probabilities(before: np.ndarray, now: np.ndarray, q: np.ndarray, r: np.ndarray, z: np.ndarray, wide: int = 1 << 15) -> np.ndarray:
    """log10 of the normalised probability of each ``now`` after its ``before``."""
    out = np.empty(len(now))
    for a in range(0, len(now), wide):
        i, j = before[a : a + wide], now[a : a + wide]
        out[a : a + wide] = np.einsum("ij,ij->i", q[i].astype(np.float64), r[j, :-1]) + r[j, -1] - z[i]
    return out / np.log(10)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, share: int = SHARE, sweeps: int = SWEEPS, bucket_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per document."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = bucket_count(docs, text_col, bucket_bytes)
    sent = written(questions(picked, "text", asking(buckets)))
    n, kinds, top, ends = vocabulary(sent, least, share)
    known = {END_WORD: END} | {w: i + 2 for i, (w, _) in enumerate(top)}
    rare = n - ends - sum(c for _, c in top)
    counts = np.array([rare, ends, *(c for _, c in top)], np.int64)
    q, r = train(*pair_counts(sent, known, len(counts), max(buckets, 24)), counts, sweeps=sweeps)
    rare_base = np.log10(rare + max(0, kinds - (ends > 0) - len(top)) + 1)
    base = np.log10(n + kinds + 1)
    shared = spark.sparkContext.broadcast((known, q, r, log_sums(spark, q, r)))  # of ``SHARE`` + 2 symbols at most

    def finish(chunk, answers):
        t = Tokens(chunk)
        found, order, begin = t.dealt(buckets)
        count = np.zeros(len(t.words), np.int64)
        for bucket, a, b in zip(found, begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            count[order[a:b]] = from_planes(expand(answers[bucket]), np.int64, b - a)
        known_, q_, r_, z = shared.value
        now, before = pairs(t, known_)
        own = np.log10(count + 1.0)[t.number]
        add = lambda x: np.add.reduceat(x, t.start)
        score = log_probabilities(before, now, q_, r_, z) + np.where(now == RARE, own - rare_base, 0)
        return pa.table({
            "doc_id": chunk.column("doc_id"), "held_out": t.held, "n_tokens": t.n,
            "n_known": add((count > 0)[t.number].astype(np.int64)), "train_tokens": np.full(len(t.n), n),
            "base_score": add(own) - t.n * base, "score": add(score),
        })

    kinds_of = {"held_out": BooleanType(), "base_score": DoubleType(), "score": DoubleType()}
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    schema = StructType([StructField(x, kinds_of.get(x, LongType())) for x in names])
    return ask_and_answer(sent, answer, finish, schema)
