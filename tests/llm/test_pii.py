"""Personal data: base spans against the plain expressions, proposals on hand-made texts."""

import hashlib
import random
import re
import time
from collections import Counter

from surveypulse.llm.pii import ORDER, base_spans, listed, luhn, mod97, more_spans, personal_data, redacted

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), "email", m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), "card", m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[0], ORDER[s[1]]))


def test_base_spans():
    rng = random.Random(3)
    parts = ["a", "@", ".", "b.c", "1", "25", "0", " ", "-", "+", "(", ")", "_", "4111111111111111", "1.2.3.4", "é"]
    for _ in range(20000):
        text = "".join(rng.choices(parts, k=rng.randrange(40)))
        assert base_spans(text) == plain(text), text


def test_proposals():
    kinds = lambda t: [k for _, k, _ in more_spans(t, base_spans(t))]
    assert mod97("GB82 WEST 1234 5698 7654 32") and not mod97("GB82 WEST 1234 5698 7654 33")
    assert kinds("to GB82 WEST 1234 5698 7654 32 please") == ["iban"]
    assert kinds("to GB82 WEST 1234 5698 7654 33 please") == []
    assert kinds("call me: 202-555-0143") == ["phone"] and kinds("version 202-555-0143") == []
    assert kinds("ssn 078-05-1120") == ["id"] and kinds("order 078-05-1120") == []
    assert kinds('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"') == ["secret"]
    assert kinds("sha256 04dbebab91ab85687d33eeaaf9ac699e1188f962") == []
    # The plain match runs into the next number and fails; the groups of four are a card all the same.
    assert kinds("card 4111-1111-1111-1111 2025 12") == ["card"]


def test_linear_on_long_runs():
    start = time.time()
    for text in ("1" * 300_000, "a" * 300_000, "1.2." * 60_000, "@" * 100_000, "4111 " * 40_000, "a1" * 100_000, "+1(" * 60_000):
        more_spans(text, base_spans(text))
    assert time.time() - start < 20


def test_many_spans_in_one_text():
    """Proposals among many taken spans: none touches one, none is lost, and the time grows with the text."""
    one = "call +1 202 555 0143 now, token a1b2c3d4e5f6a7b8c9d0e1f2a3b4c5d6e7f8, iban DE89370400440532013000. "
    few, many = one * 5, one * 4000
    base = base_spans(many)
    start = time.perf_counter()
    found = more_spans(many, base)
    assert time.perf_counter() - start < 20
    assert len(found) == 800 * len(more_spans(few, base_spans(few))) > 0
    used = sorted((a, b) for a, _, b in [*base, *found])
    by_kind = sorted((a, b) for a, _, b in found)
    assert all(not (a < d and c < b) for (a, b), (c, d) in zip(by_kind, by_kind[1:], strict=False)) and len(used) == len(base) + len(found)


def test_redaction():
    text = "é me@a.bc 1.2.3.4 end"
    assert redacted(text, base_spans(text)) == "é <email> <ip> end"
    assert redacted("abc", [(0, "card", 2), (1, "phone", 3)]) == "<card>"


def test_query(stored, nothing, nulls):
    expected = Counter()
    for r in stored.collect():
        base = plain(r.text or "")
        n = Counter(k for _, k, _ in base)
        expected[r.doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(listed(base).encode()).hexdigest()] += 1
    got = personal_data(stored).collect()
    assert Counter(tuple(r)[:6] for r in got) == expected
    kept = personal_data(stored, keep=True)
    assert kept.schema == stored.schema and kept.count() == stored.count()
    assert kept.where("text LIKE '%<email>%<card>%<ip>%<phone>%'").count() == 1
    assert personal_data(nothing).count() == 0
    assert [tuple(r)[1:5] for r in personal_data(nulls).collect()] == [(0, 0, 0, 0)] * 3
    assert [r.text for r in personal_data(nulls, keep=True).collect()] == [None] * 3


def test_secrets_of_any_length_and_case():
    """Whole runs of 32 letters, digits and '_' or more with a digit; the scan stays linear."""
    keys = ["F3" * 20, "AKIA" + "IOSFODNN7EXAMPLE" * 2, "sk_live_" + "4eC39HqLyjWDarjtT1zdp7dc", "a1b2" * 50, "_" + "a1b2" * 9]
    for key in keys:
        text = f"token: {key}, more"
        assert more_spans(text, []) == [(7, "secret", 7 + len(key))]
    assert more_spans("token: " + "a1" * 15 + " " + "ab" * 20, []) == []
    start = time.process_time()
    for run in ("_" * 300_000, "a_" * 150_000, "A" * 300_000):
        assert more_spans(f"1 token {run}", []) == []
    assert time.process_time() - start < 5
