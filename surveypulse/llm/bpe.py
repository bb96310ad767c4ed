"""BPE encoding and decoding (5), byte level, by a pair occurrence index.

A block of documents is split into pieces by the tokenizer's pattern; each different piece that the
worker hasn't met is laid out once as a chain of byte symbols. An index maps the rank of each pair
of neighbours to all positions where it stands. Ranks are applied in ascending order, each to all
its positions at once; the pairs that a merge makes join the lists of their ranks, and positions
that a merge has used up are skipped when their list's turn comes. A pair that contains a merged
symbol was learnt after it, so a list never gets entries after its turn.

Edge cases: null is the empty text, with no ids. Added tokens in a text become their id, as in the
library. Of a very long text all is encoded. Bytes that are no UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveypulse.llm.common import ship

#: The tokenizer's pattern; \s of its regular expressions is the White_Space property.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: A worker that has met more different pieces than this forgets them before its next block.
PIECES_KEPT = 500_000
BLOCK_BYTES = 16 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Numbers(dict):
    """Numbers pieces in the order in which they are met."""

    def __missing__(self, piece):
        self[piece] = n = len(self)
        return n


class ByteBpe:
    def __init__(self, file: str):
        spec = json.loads(file)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        byte_of = {c: i for i, c in enumerate(letters)}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        keys = self.left * self.width + self.right
        self.by_key = np.argsort(keys)
        self.keys = keys[self.by_key]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.added.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        names = sorted(map(regex.escape, self.added), key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(names) + ")") if names else None
        self.find = regex.compile(PATTERN).findall
        self.reset()

    def reset(self) -> None:
        """Forget the pieces met so far."""
        self.number = Numbers()
        self.count: list[int] = []
        self.decimal: list[str] = []
        self.raw: list[bytes] = []

    def pieces(self, text: str) -> list:
        """The numbers of the text's pieces; an added token's piece is a tuple of its id."""
        if self.split is None or not any(t in text for t in self.added):
            return list(map(self.number.__getitem__, self.find(text)))
        out = []
        for part in self.split.split(text):
            if part in self.added:
                out.append(self.number[(self.added[part],)])
            else:
                out += map(self.number.__getitem__, self.find(part))
        return out

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for none."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.by_key[at], -1)

    def encode(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """The ids of all words, and where each word's begin, with the end."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.concatenate([[0], np.cumsum(n)])
        total = int(begin[-1])
        sym = np.append(self.of_byte[np.frombuffer(b"".join(words), np.uint8)], -1)
        after = np.arange(1, total + 2)
        after[begin[1:][n > 0] - 1] = total  # the last place stands for no neighbour
        before = np.arange(-1, total)
        before[begin[:-1][n > 0]] = total
        lists: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(pos: np.ndarray) -> None:
            rank = self.ranks(sym[pos], sym[after[pos]])
            order = np.flatnonzero(rank >= 0)
            order = order[np.argsort(rank[order], kind="stable")]
            rank, pos = rank[order], pos[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.append(0, cuts)].tolist() if len(rank) else [], np.split(pos, cuts), strict=False):
                if r not in lists:
                    lists[r] = []
                    heapq.heappush(active, r)
                lists[r].append(part)

        first = np.flatnonzero(after[:total] < total)
        note(first)
        while active:
            r = heapq.heappop(active)
            held = lists.pop(r)
            pos = held[0] if len(held) == 1 else np.concatenate(held)
            a, b, made = self.left[r], self.right[r], self.made[r]
            pos = pos[(sym[pos] == a) & (sym[after[pos]] == b)]
            if len(held) > 1 or a == b:
                pos = np.unique(pos)
            if a == b and len(pos) > 1:  # in a run of equal symbols each second pair is taken, from the left
                run = np.append(True, after[pos[:-1]] != pos[1:])
                start = np.flatnonzero(run)
                pos = pos[(np.arange(len(pos)) - np.repeat(start, np.diff(np.append(start, len(pos))))) % 2 == 0]
            if not len(pos):
                continue
            gone = after[pos]
            sym[pos] = made
            sym[gone] = -2
            after[pos] = after[gone]
            before[after[pos]] = pos
            sym[total] = -1
            left = before[pos]
            left = left[left < total]
            note(np.concatenate([left, pos[after[pos] < total]]))
        alive = np.flatnonzero(sym[:total] >= 0)
        return sym[alive].tolist(), np.searchsorted(alive, begin).tolist()

    def learn(self) -> None:
        """Encode the pieces met since the last call."""
        new = list(islice(self.number, len(self.count), None))
        ids, begin = self.encode([w.encode() if isinstance(w, str) else b"" for w in new])
        decimal, raw = list(map(self.text_of.__getitem__, ids)), list(map(self.bytes_of.__getitem__, ids))
        spans = list(zip(begin[:-1], begin[1:], strict=True))
        first = len(self.count)
        self.count += [b - a for a, b in spans]
        self.decimal += [",".join(decimal[a:b]) for a, b in spans]
        self.raw += [b"".join(raw[a:b]) for a, b in spans]
        for token in self.added.values():
            at = self.number.get((token,), -1)
            if at >= first:
                self.count[at], self.decimal[at], self.raw[at] = 1, self.text_of[token], self.bytes_of[token]

    def ids(self, numbers: list[int]) -> list[int]:
        text = ",".join(map(self.decimal.__getitem__, numbers))
        return list(map(int, text.split(","))) if text else []

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def block(self, texts: list[str]) -> list[list[int]]:
        """Each text as numbers of known pieces."""
        if len(self.number) > PIECES_KEPT:
            self.reset()
        out = [self.pieces(t) for t in texts]
        self.learn()
        return out


_known: dict[str, ByteBpe] = {}


def loaded(file: str) -> ByteBpe:
    """The tokenizer with what this worker has met, one per worker and file."""
    key = hashlib.sha256(file.encode()).hexdigest()
    if key not in _known:
        _known.clear()
        _known[key] = ByteBpe(file)
    return _known[key]


def blocks(batches, text: str, limit: int):
    """Tables of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(1, batch.column(text).nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            size += part.column(text).nbytes
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def bpe_encode(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text", ids_out: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (of the text that
    the ids decode to), and with ``ids_out`` the ids themselves. ``file``: the tokenizer's JSON."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(file)  # one vocabulary file

    def run(batches):
        bpe = loaded(shared.value)
        sha = hashlib.sha256
        for block in blocks(batches, "text", BLOCK_BYTES):
            found = bpe.block([t or "" for t in block.column("text").to_pylist()])
            columns = {
                "doc_id": block.column("doc_id"),
                "n_tokens": [sum(map(bpe.count.__getitem__, nums)) for nums in found],
                "ids_sha256": [sha(",".join(map(bpe.decimal.__getitem__, nums)).encode()).hexdigest() for nums in found],
                "decoded_sha256": [
                    sha(b"".join(map(bpe.raw.__getitem__, nums)).decode("utf-8", "replace").encode()).hexdigest() for nums in found
                ],
            }
            if ids_out:
                columns["ids"] = pa.array([bpe.ids(nums) for nums in found], pa.list_(pa.int64()))
            yield from pa.table(columns).to_batches()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>" if ids_out else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
