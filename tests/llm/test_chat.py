"""Quotation linking against hand-made mails and a plain linker on random threads."""

import random

from surveypulse.llm.chat import conversations, introduces, linked, message_key, parse


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_parse_levels():
    body, units = parse("Yes.\n\nAnn wrote:\n> Is it\n> raining?\n>> Bob: go out\n\nBye")
    assert body == "Yes.\n\nBye"
    assert sorted(level for level, _ in units) == [0, 0, 0, 1, 2]
    assert parse(None) == ("", [])
    assert parse("a > b")[0] == "a > b"


def test_links_and_threads(spark):
    rows = [
        (1, 0, "user", "Where is the key?"), (1, 1, "assistant", "On the shelf."), (1, 2, "user", "Other matter."),
        (1, 3, "assistant", "> WHERE  is\n> the key?\nAnn has it."), (1, 4, "user", "> Ann has it.\n>> Where is the key?\nThanks"),
        (1, 5, "user", "> never said\nHm"), (2, 0, "user", "> Where is the key?\nno link across conversations"),
        (1, 2, "user", "Other matter."), (None, 0, None, None), (1, None, "user", "x"),
    ]
    got = {(r.conv_id, r.turn): r for r in linked(frame(spark, rows)).collect()}
    assert got[1, 3].parent_turn == 0 and got[1, 4].parent_turn == 3 and got[1, 5].parent_turn is None
    assert [got[1, t].thread_turn for t in range(6)] == [0, None, None, 0, 0, None]
    assert got[2, 0].parent_turn is None and got[1, 4].body == "Thanks" and got[None, 0].body == ""
    out = {(r.conv_id, r.thread_turn, r.part): r for r in conversations(frame(spark, rows)).collect()}
    assert out[1, 0, 0].text == "<|user|>\nWhere is the key?\n<|end|>\n<|assistant|>\nAnn has it.\n<|end|>\n<|user|>\nThanks\n<|end|>"
    assert out[1, 0, 0].n_links == 2 and out[1, None, 0].n_messages == 4  # the repeated row once
    assert out[1, None, 0].text.startswith("<|user|>\nx\n<|end|>\n<|assistant|>\nOn the shelf.")  # a null turn comes first


def test_large_segment_and_empty(spark):
    rows = [(1, 0, "user", f"m{i}") for i in range(50)] + [(1, 100, "user", "later")]
    out = conversations(frame(spark, rows), most=8).collect()
    assert sum(r.n_messages for r in out) == 51 and len(out) > 5
    assert conversations(frame(spark, [])).count() == 0


def test_clashing_columns(spark):
    df = frame(spark, [(1, 0, "user", "a"), (1, 1, "user", "> a\nb")]).selectExpr("*", "1 AS body", "2 AS top", "3 AS units")
    assert {r.turn: r.parent_turn for r in linked(df).collect()} == {0: None, 1: 0}


def test_parts_are_consecutive_and_copies_count_once(spark):
    """Repeated turn numbers, and every row five times; parts put together are the whole in order."""
    rows = [(c, t, "user", f"m{t:02d}.{k}") for c in (1, None) for t in range(30) for k in range(1 + 20 * (t == 7))]
    out = conversations(frame(spark, rows * 5), most=8).collect()
    for c in (1, None):
        parts = sorted((r for r in out if r.conv_id == c), key=lambda r: r.part)
        assert [r.n_messages for r in parts] == [8] * 6 + [2] and [r.part for r in parts] == list(range(7))
        bodies = [x for r in parts for x in r.text.split("\n") if x.startswith("m")]
        assert bodies == sorted(b for i, _, _, b in rows if i == c)
    whole = conversations(frame(spark, [(1, t, "user", f"m{t}") for t in range(64)] * 5)).collect()
    assert [(r.part, r.n_messages) for r in whole] == [(0, 64)]


def test_passages_without_original_stay(spark):
    rows = [(1, 0, "user", "Run this"), (1, 1, "assistant", "Try:\n>>> x = 1\n>>> x\n1"), (1, 2, "user", "Ann wrote:\n> from outside\nNo"),
            (1, 3, "user", "Bob wrote:\n> Run this\n>\n> not said\n\nOK"), (None, 0, "user", "> a\nb"), (1, 4, "user", "Bob wrote:\n> Run this\n\n\nBye")]
    got = {(r.conv_id, r.turn): r for r in linked(frame(spark, rows)).collect()}
    assert got[1, 1].body == rows[1][3] and got[1, 2].body == rows[2][3] and got[None, 0].body == "> a\nb"
    assert got[1, 3].body == "> not said\n\nOK" and got[1, 3].parent_turn == 0
    assert got[1, 4].body == "Bye" and got[1, 4].n_quotes == 1


def test_repeated_turns_have_their_own_links(spark):
    """A message that quotes nothing gets no link from another one of its turn, and threads that begin in one turn stay apart."""
    rows = [(1, 0, "user", "First"), (1, 0, "user", "Second"), (1, 1, "user", "> First\nyes"), (1, 1, "user", "nothing quoted"), (1, 1, "user", "> Second\nno")]
    got = {r.body: r for r in linked(frame(spark, rows * 2)).collect()}
    assert got["nothing quoted"].parent is None and got["nothing quoted"].thread is None
    assert got["yes"].parent == got["First"].key == got["First"].thread and got["no"].thread == got["Second"].key
    out = conversations(frame(spark, rows * 2)).collect()
    assert sorted((r.n_messages, r.n_links) for r in out) == [(1, 0), (2, 1), (2, 1)]


def test_introductions_of_any_length():
    assert introduces("x" * 5000 + " WROTE: \t") and introduces("wrote:") and not introduces("rewrote:") and not introduces("wrote: a")


def plain(rows):
    """Each message's parent and thread, from the structure that its text was made of: (conv, turn, role, text, own, quoted)."""
    keys = [message_key(c, t, r, x) for c, t, r, x, _, _ in rows]
    parent = {}
    for k, (c, t, _, _, _, quoted) in zip(keys, rows, strict=True):
        best = []
        for level, passage in quoted:
            have = sorted((t2, k2) for k2, (c2, t2, _, _, own, _) in zip(keys, rows, strict=True) if c2 == c and passage in own)
            if have and have[0][0] < t:
                best.append((level, -have[0][0], have[0][1]))
        parent[k] = min(best)[2] if best else None

    def top(k):
        while parent[k] is not None:
            k = parent[k]
        return k

    tops = {k: top(k) for k in keys}
    return {k: (parent[k], tops[k] if parent[k] is not None or k in parent.values() else None) for k in keys}


def test_random_threads_against_a_plain_linker(spark):
    rng = random.Random(8)
    said = [f"passage {i} of {rng.choice('xyz')}" for i in range(14)]
    rows = []
    for _ in range(160):
        quoted = [(rng.randrange(1, 4), p) for p in rng.sample(said, rng.randrange(0, 4))]
        own = rng.sample(said, 1) if rng.random() < 0.4 else [f"own {rng.randrange(10**6)}"]
        lines = [x for level, p in quoted for x in (">" * level + " " + p.upper().replace(" ", rng.choice([" ", "  "])), "")]
        if lines and rng.random() < 0.5:
            lines.insert(0, "Ann wrote:")
        text = "\n".join([*lines, *own])
        rows.append((rng.randrange(3), rng.randrange(25), rng.choice(["user", "assistant"]), text, own, quoted))
    # Consecutive passages of one level are also one passage as a whole, which nobody says here.
    expected = plain(rows)
    got = linked(frame(spark, [r[:4] for r in rows])).collect()
    none = lambda x: None if x is None else bytes(x)
    assert len(got) == len(rows) and sum(p is not None for p, _ in expected.values()) > 40
    assert {bytes(r.key): (none(r.parent), none(r.thread)) for r in got} == expected
