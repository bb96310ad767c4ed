"""Personal data (9): expressions propose spans, checksums confirm them, words nearby adjust the score.

Base spans (email, ip, card, phone) are fixed rules and always stay. Further proposals start with a
score for their shape; a checksum that holds (Luhn for cards, mod-97 for account numbers) adds to it,
one that fails rules the span out; words of the kind's vocabulary within ``NEAR`` characters add,
words that speak against it take away. Proposals with ``ACCEPT`` or more that touch no span already
taken are added.

Edge cases: null is the empty text. Offsets count code points, ends are exclusive. All scans are
linear in the text, also on very long runs of digits or letters without a separator. Rows are
independent; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveypulse.llm.common import ship

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "id", "secret")
ORDER = {k: i for i, k in enumerate(KINDS)}
NEAR, ACCEPT = 48, 0.75

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match begins at the first digit of a run: possessive runs say the same without trying each digit.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: kind, expression, score for the shape, checksum (or None), words that speak for it and against it.
PROPOSALS = (
    ("card", re.compile(r"(?<![0-9])(?:[0-9]{4}([ -]))(?:[0-9]{4}\1){2}[0-9]{1,7}(?![0-9])"), 0.4, "luhn",
     "card credit visa mastercard payment carte tarjeta karte", "isbn order tracking"),
    ("phone", re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"), 0.4, None,
     "phone tel telephone call fax mobile cell telefon teléfono téléphone", "isbn order version"),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), 0.4, "mod97",
     "iban account bank konto compte cuenta", "isbn"),
    ("id", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), 0.4, None,
     "ssn social security taxpayer", "isbn order version"),
    ("secret", re.compile(r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])[A-Za-z0-9_]{32,}+"), 0.4, None,
     "token secret password passwd apikey api_key key", "sha256 md5 checksum commit"),
)
WORDS = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


CHECKS = {"luhn": lambda s: luhn(re.sub("[^0-9]", "", s)), "mod97": mod97}


def emails(text: str):
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their @."""
    floor = 0
    while (at := text.find("@", floor)) >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        floor = m.end() if m else at + 1


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed rules."""
    out = [(a, "email", b) for a, b in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
                out.append((m.start(), "ip", m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), "card", m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), "phone", m.end()))
    return sorted(out, key=lambda s: (s[0], ORDER[s[1]]))


def more_spans(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    """Proposals that reach ``ACCEPT`` and touch nothing taken."""
    if not DIGIT.search(text):
        return []
    starts, ends = merged([(a, b) for a, _, b in taken])
    out: list[tuple[int, str, int]] = []
    for kind, pattern, score, check, good, bad in PROPOSALS:
        mine = len(out)  # a kind's own matches don't overlap
        for m in pattern.finditer(text):
            at = bisect_left(starts, m.end())
            if at and ends[at - 1] > m.start():
                continue
            value = score
            if check:
                if not CHECKS[check](m[0]):
                    continue
                value += 0.5
            near = {w.lower() for w in WORDS.findall(text[max(0, m.start() - NEAR) : m.start()] + " " + text[m.end() : m.end() + NEAR // 2])}
            value += 0.4 * bool(near & set(good.split())) - 0.4 * bool(near & set(bad.split()))
            if value >= ACCEPT:
                out.append((m.start(), kind, m.end()))
        if len(out) > mine:
            starts, ends = merged([*zip(starts, ends, strict=True), *((a, b) for a, _, b in out[mine:])])
    return out


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the spans cover, ascending; spans that only touch stay apart."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with each span's kind in its place; overlapping spans go together."""
    out, at = [], 0
    for a, kind, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans; with ``keep``, instead all
    columns of ``docs``, the spans in the text replaced by their kind."""
    ship(docs.sparkSession)

    def find(text: str):
        base = base_spans(text)
        return base, sorted(base + more_spans(text, base), key=lambda s: (s[0], ORDER[s[1]]))

    def report(batches):
        for batch in batches:
            found = [find(t or "") for t in batch.column("text").to_pylist()]
            columns = {"doc_id": batch.column("doc_id")}
            for kind in BASE:
                columns[f"n_{kind}"] = pa.array([sum(k == kind for _, k, _ in base) for base, _ in found], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found], pa.string())
            columns["spans"] = pa.array([listed(spans) for _, spans in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    def redact(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None else redacted(t, find(t)[1]) for t in batch.column(at).to_pylist()]
            columns = batch.columns
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    if keep:
        return docs.mapInArrow(redact, docs.schema)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(report, schema)
