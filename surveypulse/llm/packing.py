"""Best-fit packing (3): token sequences of at most ``capacity`` from whole documents, by linear grouping.

1. Documents become pieces: token ids and an end id, cut only if longer than a sequence. Each piece
   has a rank among the pieces of its length, from counts per partition and length.
2. The plan needs only how many pieces each length has. Pieces longer than a limit are sorted by
   length into ``GROUPS`` groups of equally many, each rounded up to its longest. For these few sizes
   a configuration program is solved by column generation (simplex steps, each new configuration
   from a knapsack over the dual prices); whole multiples are used, what they leave over is filled
   up greedily from the largest.
3. Actual pieces take the places of the rounded ones: a run of ranks of one length goes to a run of
   sequences, so gaps are known exactly. Small pieces then go, longest first, into the smallest gap
   that holds them, and into new sequences when none does. Several limits are tried (``SMALL``), and
   the plan with fewest sequences is kept.

The plan is a table of runs whose size depends on capacity and groups, not on the documents; each
piece finds its run by length and rank. Nothing is sorted or gathered by sequence.

Edge cases: a null or empty text is one piece of the end id alone. Empty tables give no rows.
Repeated rows are packed each.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.llm.bpe import BLOCK_BYTES, PIECES_KEPT, Numbers, blocks
from surveypulse.llm.common import ship, written

CAPACITY, END, GROUPS = 2048, 0, 96
#: Shares of the capacity up to which a piece is small; the plan with fewest sequences is kept.
SMALL = (1 / 4, 1 / 3, 2 / 5, 1 / 2)


#: The split of words into parts that :class:`WordTokens` can do by itself, for printable ASCII in small letters.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
TOGETHER, LEARNT = 500, 200_000


def ascii_by_parts(spec: dict) -> bool:
    """Whether the tokenizer lowers words, splits them by ``SPLIT`` and marks the last token of each part, so that
    a printable ASCII word has the ids of its parts."""
    steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = [(p.get("type"), p.get("pattern", {}).get("Regex"), p.get("invert")) for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    return steps == ["NFC", "Replace", "Lowercase"] and splits == [("Split", SPLIT, True), ("ByteLevel", None, None)] and bool(
        spec["model"].get("end_of_word_suffix"))


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` of those starts and sizes, one after the other."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(size.sum())]


class WordTokens:
    """Ids of a tokenizer that never joins text across white space, by each different word once."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(file)
        self.parts = None
        if ascii_by_parts(spec):
            suffix, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            names = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
            self.added = re.compile("|".join(names) or r"(?!)").search
            self.parts = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
        self.reset()

    def reset(self) -> None:
        self.number = Numbers()
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> None:
        """Ids of new words: of plain ones by their different parts, of the others by the tokenizer."""
        plain = np.fromiter((self.parts is not None and w.isascii() and w.isprintable() and not self.added(w) for w in words), bool, len(words))
        numbers, mine = Numbers(), [ASCII_PARTS.findall(w.lower()) for w in compress(words, plain.tolist())]
        counts = np.fromiter(map(len, mine), np.int64, len(mine))
        of_part = np.fromiter(map(numbers.__getitem__, chain.from_iterable(mine)), np.int64, int(counts.sum()))
        flat, ends = self.part_ids(list(numbers))
        held = np.concatenate([[0], np.cumsum((ends[1:] - ends[:-1])[of_part])])  # ids before each part
        ours = gathered(flat, ends[:-1][of_part], np.diff(held))
        others = [e.ids for e in self.tokenizer.encode_batch_fast(list(compress(words, (~plain).tolist())), add_special_tokens=False)]
        sizes = np.empty(len(words), np.int64)
        cuts = np.concatenate([[0], np.cumsum(counts)])
        sizes[plain] = held[cuts[1:]] - held[cuts[:-1]]
        sizes[~plain] = np.fromiter(map(len, others), np.int64, len(others))
        start = np.empty(len(words), np.int64)
        start[plain] = len(self.flat) + held[cuts[:-1]]
        start[~plain] = len(self.flat) + len(ours) + np.cumsum(sizes[~plain]) - sizes[~plain]
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, ours, np.array(list(chain.from_iterable(others)), np.uint32)])

    def part_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts one after the other, and where each begins, with the end of the last. Many parts
        are one call of the tokenizer, cut where a token ends a part."""
        flat, ends, so_far = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)], 0
        groups = [parts[at : at + TOGETHER] for at in range(0, len(parts), TOGETHER)]
        joined = self.parts.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False) if groups else []
        for group, e in zip(groups, joined, strict=True):
            ids = np.array(e.ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(group):  # a vocabulary without all single letters
                each = [x.ids for x in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
                ids, cuts = np.array(list(chain.from_iterable(each)), np.uint32), np.cumsum([len(x) for x in each])
            flat.append(ids)
            ends.append(so_far + cuts)
            so_far += len(ids)
        return np.concatenate(flat), np.concatenate(ends).astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text begins, with the end of the last."""
        if len(self.number) > PIECES_KEPT:
            self.reset()
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        numbers = np.fromiter(map(self.number.__getitem__, words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        if len(self.number) > len(self.size):
            new = list(islice(self.number, len(self.size), None))
            for at in range(0, len(new), LEARNT):
                self.learn(new[at : at + LEARNT])
        numbers = numbers[words.indices.to_numpy()]
        sizes = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = gathered(self.flat, self.start[numbers], sizes)
        offsets = split.offsets.to_numpy()
        return flat, ends[offsets - offsets[0]]


_known: dict[int, WordTokens] = {}


def loaded(file: str) -> WordTokens:
    key = zlib.crc32(file.encode())
    if key not in _known:
        _known.clear()
        _known[key] = WordTokens(file)
    return _known[key]


def pieces(docs: DataFrame, file: str, capacity: int, ids_out: bool) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, with the partition and the number there among its length."""
    shared = docs.sparkSession.sparkContext.broadcast(file)  # one vocabulary file
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        tokens, part, met = loaded(shared.value), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for block in blocks(batches, "text", BLOCK_BYTES):
            rows = []
            text = block.column("text")
            flat, at = tokens.encode(text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text)
            for doc, a, b in zip(block.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                ids = flat[a:b].tobytes() + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    raw = ids[at : at + 4 * capacity]
                    n = len(raw) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(raw), part, int(met[n]), *([np.frombuffer(raw, "<u4")] if ids_out else [])))
                    met[n] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"] + ["ids"] * ids_out
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * ids_out
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long" + ", ids array<long>" * ids_out
    return docs.mapInArrow(run, schema)


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int, most: np.ndarray | None = None) -> np.ndarray:
    """How many of each size to take for the highest price; at most ``most`` of each where given."""
    if most is None:
        rest = np.arange(capacity + 1)[:, None] - sizes[None, :]
        fits, rest = rest >= 0, np.maximum(rest, 0)
        best, chosen = np.zeros(capacity + 1), []
        for _ in range(capacity // int(sizes.min())):  # with one more piece than before
            value = np.where(fits, best[rest] + prices, 0)
            i = value.argmax(1)
            best, i = value[np.arange(capacity + 1), i], np.where(value.max(1) > 0, i, -1)
            chosen.append(i)
        out, c = np.zeros(len(sizes), np.int64), capacity
        for i in reversed(chosen):
            if i[c] < 0:
                break
            out[i[c]] += 1
            c -= int(sizes[i[c]])
        return out
    best, take = np.zeros(capacity + 1), np.zeros((len(sizes), capacity + 1), np.int64)
    for i, (s, p) in enumerate(zip(sizes.tolist(), prices.tolist(), strict=True)):
        before = best.copy()
        for k in range(1, int(min(most[i], capacity // s)) + 1):
            value = np.full(capacity + 1, -1.0)
            value[k * s :] = before[: capacity + 1 - k * s] + k * p
            better = value > best
            best[better], take[i][better] = value[better], k
    out, c = np.zeros(len(sizes), np.int64), capacity
    for i in range(len(sizes) - 1, -1, -1):
        out[i] = take[i][c]
        c -= int(out[i] * sizes[i])
    return out


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(times, how many of each size), together all ``counts``; ``sizes`` descending and different."""
    n, left, plan = len(sizes), counts.copy(), []
    if not n:
        return plan
    basis = np.diag(capacity // sizes).astype(float)
    x = counts / np.diag(basis)
    for _ in range(20 * n):
        prices = np.linalg.solve(basis.T, np.ones(n))
        column = knapsack(sizes, np.maximum(prices, 0), capacity)
        if prices @ column <= 1 + 1e-9:
            break
        step = np.linalg.solve(basis, column)
        ratio = np.where(step > 1e-12, x / np.where(step > 1e-12, step, 1), np.inf)
        out = int(ratio.argmin())
        x = np.maximum(x - ratio[out] * step, 0)
        x[out] = ratio[out]
        basis[:, out] = column
    for times, column in zip(np.floor(x + 1e-9).astype(np.int64).tolist(), np.rint(basis.T).astype(np.int64), strict=True):
        used = column > 0
        times = int(min(times, (left[used] // column[used]).min())) if used.any() else 0
        if times > 0:
            plan.append((times, column))
            left = left - times * column
    while left.any():
        first = int(np.flatnonzero(left)[0])
        rest = left.copy()
        rest[first] -= 1
        column = knapsack(sizes, sizes.astype(float), capacity - int(sizes[first]), rest)
        column[first] += 1
        used = column > 0
        times = int((left[used] // column[used]).min())
        plan.append((times, column))
        left = left - times * column
    return plan


def best_plan(hist: np.ndarray, capacity: int = CAPACITY, shares: tuple[float, ...] = SMALL, groups: int = GROUPS) -> dict[str, np.ndarray]:
    """The plan with fewest sequences over these limits of small pieces. Mid-sized pieces either shape the
    configurations or fill gaps by best fit: which is better depends on the lengths there are."""
    plans = [packing_plan(hist, capacity, max(1, int(capacity * share)), groups) for share in shares]
    return min(plans, key=lambda p: int(p["sequences"]))


def packing_plan(hist: np.ndarray, capacity: int, small: int, groups: int) -> dict[str, np.ndarray]:
    """``hist[n]``: pieces of length n. Runs (length, rank, n, sequence, offset): the n pieces of that
    length from that rank on go to the n sequences from that one on, each at that offset."""
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: (first sequence, how many)
    sequences = int(hist[capacity])
    if sequences:
        runs.append((capacity, 0, sequences, 0, 0))
    # Large pieces, longest first, in groups of equally many: (length, rank, n) parts.
    lengths = [n for n in range(capacity - 1, small, -1) if hist[n]]
    total = int(sum(hist[n] for n in lengths))
    share = -(-total // groups) if total else 1
    parts: list[list[list[int]]] = [[]]
    room = share
    for n in lengths:
        rank, left = 0, int(hist[n])
        while left:
            k = min(left, room)
            parts[-1].append([n, rank, k])
            rank, left, room = rank + k, left - k, room - k
            if not room:
                parts.append([])
                room = share
    merged: list[list[list[int]]] = []  # groups with the same longest piece are one size
    for p in filter(None, parts):
        if merged and merged[-1][0][0] == p[0][0]:
            merged[-1] += p
        else:
            merged.append(p)
    sizes = np.array([p[0][0] for p in merged], np.int64)
    counts = np.array([sum(k for _, _, k in p) for p in merged], np.int64)
    for times, column in configurations(sizes, counts, capacity):
        # Stretches of these sequences with what is filled so far, split as lengths change.
        filled = [(sequences, times, 0)]
        for g in np.flatnonzero(column).tolist():
            for _ in range(int(column[g])):
                after = []
                for first, k, fill in filled:
                    while k:
                        n, rank, have = merged[g][0]
                        take = min(k, have)
                        runs.append((n, rank, take, first, fill))
                        after.append((first, take, fill + n))
                        first, k = first + take, k - take
                        if take == have:
                            merged[g].pop(0)
                        else:
                            merged[g][0] = [n, rank + take, have - take]
                filled = after
        for first, k, fill in filled:
            gaps[capacity - fill].append((first, k))
        sequences += times
    for n in range(min(small, capacity - 1), 0, -1):
        rank, left, gap = 0, int(hist[n]), n
        while left:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:
                fresh = -(-left // (capacity // n))
                gaps[capacity].append((sequences, fresh))
                sequences += fresh
                gap = capacity
            first, k = gaps[gap].pop()
            take = min(k, left)
            runs.append((n, rank, take, first, capacity - gap))
            rank, left = rank + take, left - take
            gaps[gap - n].append((first, take))
            if k > take:
                gaps[gap].append((first + take, k - take))
            gap = max(n, gap - n)  # the gap just made may be the smallest that fits
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "n", "sequence", "offset"), table.T, strict=True)) | {"sequences": np.array(sequences)}


def best_fit_packing(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, ids_out: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with
    ``ids_out`` its ids. ``file``: the JSON of a tokenizer that splits at white space."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = written(pieces(picked, file, capacity, ids_out))
    counts = written(rows.groupBy("part", "length").agg(F.count("*").alias("n")))
    hist = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # one row per length
        hist[length] = n
    plan = best_plan(hist, capacity)
    span = capacity + 1
    # Runs in order of length, then rank: one search finds a piece's run.
    starts = np.searchsorted(plan["length"], np.arange(span))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_from"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("nth").to_numpy() + batch.column("_from").to_numpy()
            at = np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                mine = length == n
                a, b = starts[n], starts[n + 1] if n + 1 < span else len(plan["length"])
                at[mine] = a + np.searchsorted(plan["rank"][a:b], rank[mine], "right") - 1
            columns = [batch.column(c) for c in names]
            sequence = plan["sequence"][at] + rank - plan["rank"][at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(plan["offset"][at])], [*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids_out
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids_out + ", sequence_id long, offset long"
    return rows.join(offsets, ["part", "length"]).select(*names, "nth", "_from").mapInArrow(place, schema)
