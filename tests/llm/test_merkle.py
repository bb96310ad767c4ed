import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from surveypulse.llm import merkle
from surveypulse.llm.queries import ORACLE

LOWER = {c: c + 32 for c in range(65, 91)}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc):
    encoded = [b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode()) for v in doc]
    return hashlib.sha256(b"".join(encoded)).hexdigest()


def climb(nodes, fan):
    """Root, and for each node its siblings (before, after) level by level."""
    at = list(range(len(nodes)))
    sides = [[] for _ in nodes]
    while len(nodes) > 1:
        runs = [nodes[i:i + fan] for i in range(0, len(nodes), fan)]
        for j, i in enumerate(at):
            run = runs[i // fan]
            sides[j].append(("".join(run[:i % fan]), "".join(run[i % fan + 1:])))
        at = [i // fan for i in at]
        nodes = [digest(*run) for run in runs]
    return nodes[0], sides


def brute(docs, fan):
    """docs: (doc_id, source, lang, n_chars, text)"""
    by_source = defaultdict(list)
    for d in docs:
        by_source[d[1]].append(d)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by_source[s], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d))) for s in order}
    climbed = {s: climb([leaf(d) for d in trees[s]], fan) for s in order}
    root, tops = climb([climbed[s][0] for s in order], fan)
    out = []
    for k, s in enumerate(order):
        for j, d in enumerate(trees[s]):
            sides = climbed[s][1][j] + tops[k]
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            node = leaf((*d[:4], None if d[4] is None else d[4].translate(LOWER))) if hit else leaf(d)
            for before, after in sides:
                node = digest(before, node, after)
            out.append((d[0], leaf(d), climbed[s][0], root, digest(*[x for pair in sides for x in pair]), node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize(("fan", "levels"), [(16, 3), (2, 1), (3, 2)])
def test_brute_force(corpus, fan, levels):
    assert found(merkle.merkle_manifest(corpus, fan, levels)) == brute(plain(corpus), fan)


def test_sql(stored, tmp_path):
    con = duckdb.connect()
    con.register("documents", stored.toArrow())
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLE['op13_merkle_manifest']})").fetchall()
    assert found(merkle.merkle_manifest(stored)) == sorted(want, key=str)


def test_one_source_holds_most_rows_and_repeats(spark):
    docs = [(7, "hot", "en", 1, "Same Text")] * 150 + [(i, "hot" if i % 3 else f"s{i}", "en", i, f"Text {i}") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars int, text string").repartition(5)
    assert found(merkle.merkle_manifest(df, 4, 1)) == brute(docs, 4)


def test_empty_and_null_rows(nothing, nulls):
    assert found(merkle.merkle_manifest(nothing)) == []
    assert found(merkle.merkle_manifest(nulls)) == brute([(None,) * 5] * 3, 16)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300])
@pytest.mark.parametrize("fan", [2, 16])
def test_positions_in_the_log(n, fan):
    top = min(3, merkle.height(n, fan))
    leaves = [hashlib.sha256(b"%d" % i).digest() for i in range(n)]
    log = merkle.appended(leaves, top, fan)
    level, places = leaves, []
    for h in range(top + 1):
        at = merkle.position(h, np.arange(len(level)), n, top, fan)
        assert [log[p] for p in at] == level
        places += at.tolist()
        level = [bytes.fromhex(digest(*[x.hex() for x in level[i:i + fan]])) for i in range(0, len(level), fan)]
    assert sorted(places) == list(range(len(log)))
