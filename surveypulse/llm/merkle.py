"""Merkle manifest of a table: postorder append log written by aligned builders.

Each row is a leaf: the SHA-256 of its fields, each ``-`` if null, else byte count, ``:``, value. The
leaves of a source, ascending by doc_id, and then the sources' roots, ascending by source, are trees of
``FAN`` children; the last run of a level may be shorter.

**Log.** A tree is cut into aligned stretches of FAN**LEVELS nodes. A builder holds one stretch and
appends its nodes in the order in which they are complete: a leaf, then every run that it closes. So no
place has to be looked up: node i of level h ends with leaf e = min((i + 1) * FAN**h, n) - 1, before
which sum(e // FAN**k) nodes were written, and it comes h nodes after that leaf (:func:`position`).
The roots of the stretches are the leaves of the next builders until each tree has one root.

**Proofs.** From the top tree down, each stretch receives the siblings above its own root once, adds
those inside, which it addresses by position, and hands them to the stretches below. A proof is folded
from its leaf with these siblings and compared with the root of all.

**Edge cases.** Nulls are the field ``-``; a null doc_id sorts first and is never altered for the test
of tampering; a null source sorts first and is not the empty one. Equal doc_ids of a source are ordered
by leaf; repeated rows have the same leaf, their results are given in any order. A source with one row
has that leaf as its root; an empty table gives no rows. Other columns are ignored, whatever their names.

**Scale.** Text is read once, in place. A row travels with its id and one or two digests, by ranges of
(source, doc_id), so a source may hold any share of rows and rows may repeat; a builder holds at most
4096 nodes. Nothing is collected but the number of rows of the largest source.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveypulse.llm.common import ship, written
from surveypulse.llm.numbering import numbered

FAN, LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SEGMENT = """tree STRING, block BIGINT, n BIGINT, n_below BIGINT, root BINARY, log BINARY,
items ARRAY<STRUCT<doc_id: BIGINT, label: STRING, other: BINARY>>"""
_PATH = "tree STRING, block BIGINT, root BINARY, subroot BINARY, path ARRAY<STRUCT<before: BINARY, after: BINARY>>"
_PROOF = "doc_id BIGINT, leaf STRING, subroot STRING, root STRING, proof_sha256 STRING, folded_root STRING, verified BOOLEAN"

_ITEM = pa.struct([("doc_id", pa.int64()), ("label", pa.string()), ("other", pa.binary())])
_SEGMENT_ARROW = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("n_below", pa.int64()),
                            ("root", pa.binary()), ("log", pa.binary()), ("items", pa.list_(_ITEM))])
_SIDES = pa.struct([("before", pa.binary()), ("after", pa.binary())])
_PATH_ARROW = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("root", pa.binary()), ("subroot", pa.binary()),
                         ("path", pa.list_(_SIDES))])
_PROOF_ARROW = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                          ("verified", pa.bool_())])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of a row's fields as 32 bytes; ``changed`` fields take the given value."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def height(n: int, fan: int) -> int:
    """Levels above n nodes until one is left."""
    h = 0
    while n > 1:
        n, h = -(-n // fan), h + 1
    return h


def position(level: int, index: np.ndarray, n: int, top: int, fan: int) -> np.ndarray:
    """Places in the completion order of a stretch of ``n`` leaves built up to level ``top``."""
    last = np.minimum((index + 1) * fan**level, n) - 1
    return sum(last // fan**k for k in range(top + 1)) + level


def appended(leaves: list[bytes], top: int, fan: int) -> list[bytes]:
    """The log of a stretch: each node when it is complete, its digest taken over hex texts."""
    log, open_runs, end = [], [[] for _ in range(top + 1)], len(leaves) - 1
    for j, node in enumerate(leaves):
        level = 0
        log.append(node)
        open_runs[0].append(node)
        while level < top and (len(open_runs[level]) == fan or j == end):
            node = sha256("".join(x.hex() for x in open_runs[level]).encode()).digest()
            open_runs[level] = []
            level += 1
            log.append(node)
            open_runs[level].append(node)
    return log


def _top(n_tree: int, fan: int, levels: int) -> int:
    return min(levels, height(n_tree, fan))


def _builder(fan: int, levels: int):
    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        tree, block, n_tree = (group.column(c)[0].as_py() for c in ("tree", "block", "n"))
        top = _top(n_tree, fan, levels)
        log = appended(group.column("hash").to_pylist(), top, fan)
        names = [f.name for f in _ITEM]
        items = pa.StructArray.from_arrays([group.column(c).combine_chunks() for c in names], fields=list(_ITEM))
        row = {"tree": [tree], "block": [block], "n": [n_tree], "n_below": [group.num_rows], "root": [log[-1]], "log": [b"".join(log)]}
        arrays = [pa.array(row[f.name], f.type) for f in _SEGMENT_ARROW if f.name != "items"]
        return pa.Table.from_arrays([*arrays, pa.ListArray.from_arrays([0, len(items)], items)], schema=_SEGMENT_ARROW)

    return build


def _siblings(segment: dict, fan: int, levels: int):
    """For each leaf of a stretch the (before, after) hex texts of its siblings, level by level."""
    n, top = segment["n_below"], _top(segment["n"], fan, levels)
    log = np.frombuffer(segment["log"], np.uint8).reshape(-1, 32)
    found = []
    for level in range(top):
        size = -(-n // fan**level)
        found.append((log[position(level, np.arange(size), n, top, fan)].tobytes().hex().encode(), size))
    for j in range(n):
        sides, i = [], j
        for text, size in found:
            start = i - i % fan
            sides.append((text[64 * start:64 * i], text[64 * (i + 1):64 * min(start + fan, size)]))
            i //= fan
        yield sides


def _opened(segments: pa.Table, paths: pa.Table):
    segment, above = segments.to_pylist()[0], paths.to_pylist()[0]
    return segment, above, [(s["before"], s["after"]) for s in above["path"]]


def _hand_down(fan: int, levels: int):
    """The paths of the stretches below the leaves of a stretch."""

    def run(segments: pa.Table, paths: pa.Table) -> pa.Table:
        if not segments.num_rows or not paths.num_rows:
            return _PATH_ARROW.empty_table()
        segment, above, rest = _opened(segments, paths)
        out = {f.name: [] for f in _PATH_ARROW}
        first = segment["block"] * fan**levels
        leaf_at = position(0, np.arange(segment["n_below"]), segment["n_below"], _top(segment["n"], fan, levels), fan)
        for j, sides in enumerate(_siblings(segment, fan, levels)):
            label = segment["items"][j]["label"]
            own = segment["log"][32 * leaf_at[j]:32 * leaf_at[j] + 32]
            out["tree"].append(segment["tree"] if label is None else label)
            out["block"].append(first + j if label is None else 0)
            out["root"].append(above["root"])
            out["subroot"].append(above["subroot"] if label is None else own)
            out["path"].append([{"before": b, "after": a} for b, a in sides + rest])
        return pa.Table.from_pydict(out, _PATH_ARROW)

    return run


def _prove(fan: int, levels: int):
    """A result row for each leaf of a stretch."""

    def run(segments: pa.Table, paths: pa.Table) -> pa.Table:
        if not segments.num_rows or not paths.num_rows:
            return _PROOF_ARROW.empty_table()
        segment, above, rest = _opened(segments, paths)
        n, top = segment["n_below"], _top(segment["n"], fan, levels)
        leaf_at, log = position(0, np.arange(n), n, top, fan), segment["log"]
        shared = b"".join(b + a for b, a in rest)
        root, subroot = above["root"].hex(), above["subroot"].hex()
        out = {f.name: [] for f in _PROOF_ARROW}
        for j, sides in enumerate(_siblings(segment, fan, levels)):
            leaf = log[32 * leaf_at[j]:32 * leaf_at[j] + 32].hex()
            item = segment["items"][j]
            node = item["other"].hex() if item["other"] is not None else leaf
            for before, after in sides + rest:
                node = sha256(before + node.encode() + after).hexdigest()
            out["doc_id"].append(item["doc_id"])
            out["leaf"].append(leaf)
            out["subroot"].append(subroot)
            out["root"].append(root)
            out["proof_sha256"].append(sha256(b"".join(b + a for b, a in sides) + shared).hexdigest())
            out["folded_root"].append(node)
            out["verified"].append(node == root)
        return pa.Table.from_pydict(out, _PROOF_ARROW)

    return run


def _grown(nodes: DataFrame, fan: int, levels: int) -> list[DataFrame]:
    """Segments by round: each round builds on the roots of the one before, while any tree has several."""
    wide = fan**levels
    rounds = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most:
        cut = nodes.withColumn("block", F.floor(F.col("index") / wide).cast("bigint"))
        rounds.append(written(cut.groupBy("tree", "block").applyInArrow(_builder(fan, levels), _SEGMENT)))
        most = -(-most // wide) if most > wide else 0
        nodes = rounds[-1].where(F.col("n") > wide).select(
            "tree", F.col("block").alias("index"), F.ceil(F.col("n") / wide).cast("bigint").alias("n"), F.col("root").alias("hash"),
            F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("label"), F.lit(None).cast("binary").alias("other"))
    return rounds


def _met(segments: DataFrame, paths: DataFrame, run, schema: str) -> DataFrame:
    return segments.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(run, schema)


def merkle_manifest(docs: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for each row of ``docs``."""
    ship(docs.sparkSession)
    wide = fan**levels
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = written(docs.select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest().alias("hash"), F.when(altered, leaf_digest(text=F.translate("text", UPPER, LOWER))).alias("other"),
        F.lit(None).cast("string").alias("label")))
    # The last order column only splits rows that repeat.
    tied = leaves.withColumn("_tie", F.monotonically_increasing_id())
    rounds = _grown(numbered(tied, "tree", ["doc_id", "hash", "_tie"]).drop("_tie"), fan, levels)
    if not rounds:
        return docs.sparkSession.createDataFrame([], _PROOF)
    finished = [r.where(F.col("n") <= wide).select("tree", F.lit(i).alias("round"), F.col("root").alias("hash")) for i, r in enumerate(rounds)]
    roots = finished[0]
    for more in finished[1:]:
        roots = roots.union(more)
    roots = written(roots)
    tops = _grown(numbered(roots.select(
        F.lit("").alias("tree"), F.lit(None).cast("bigint").alias("doc_id"), "hash", F.lit(None).cast("binary").alias("other"),
        F.col("tree").alias("label")), "tree", ["label"]), fan, levels)
    none = F.array().cast("array<struct<before: binary, after: binary>>")
    paths = written(tops[-1].select("tree", "block", "root", F.col("root").alias("subroot"), none.alias("path")))
    for segments in reversed(tops):
        paths = _met(segments, paths, _hand_down(fan, levels), _PATH)
    by_source = written(paths)
    paths = None
    for i in reversed(range(len(rounds))):
        mine = by_source.join(roots.where(F.col("round") == i).select("tree"), "tree", "left_semi")
        paths = mine if paths is None else mine.unionByName(paths)
        if i:
            paths = written(_met(rounds[i], paths, _hand_down(fan, levels), _PATH))
    return _met(rounds[0], paths, _prove(fan, levels), _PROOF)


def oracle(depth: int = 6, top_depth: int = 3) -> str:
    """SQL for sources of up to 16**depth rows: one level after the other, without a log."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode({0}::VARCHAR)) || ':' || {0} END"
    encoded = lambda text: " || ".join(field.format(f) for f in ("doc_id", "source", "lang", "n_chars", text))
    ctes = [f"""crc_table AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)""",
            f"""d AS MATERIALIZED (SELECT doc_id, source, sha256({encoded("text")}) AS leaf,
  sha256({encoded(f"translate(text, '{UPPER}', '{LOWER}')")}) AS bent,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 5 = 0 AS hit FROM documents, crc_table)""",
            """l0 AS MATERIALIZED (SELECT source AS tree, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY source) AS n, leaf AS h, doc_id, bent, hit
  FROM d WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))"""]

    def climb(name: str, levels: int) -> None:
        for h in range(levels):
            ctes.append(f"""{name}r{h} AS MATERIALIZED (SELECT tree, i // 16 AS i, max(n) AS n, list(h ORDER BY i) AS hs FROM {name}{h} GROUP BY 1, 2)""")
            ctes.append(f"""{name}{h + 1} AS MATERIALIZED (SELECT tree, i, (n + 15) // 16 AS n,
  CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {name}r{h})""")

    climb("l", depth)
    ctes.append(f"""t0 AS MATERIALIZED (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n, h, tree AS source FROM l{depth})""")
    climb("t", top_depth)
    ctes.append("p0 AS (SELECT l0.*, t0.i AS ti, t0.h AS subroot, coalesce(CASE WHEN hit THEN bent END, l0.h) AS fold, '' AS proof "
                "FROM l0 JOIN t0 ON l0.tree IS NOT DISTINCT FROM t0.source)")
    step = 0
    for name, index, levels, on in (("l", "i", depth, "r.tree IS NOT DISTINCT FROM p.tree"), ("t", "ti", top_depth, "true")):
        for h in range(levels):
            at = f"((p.{index} // {16**h}) % 16 + 1)"
            before, after = f"array_to_string(r.hs[1:{at} - 1], '')", f"array_to_string(r.hs[{at} + 1:], '')"
            ctes.append(f"""p{step + 1} AS (SELECT p.* EXCLUDE (fold, proof),
  CASE WHEN r.n > 1 THEN sha256({before} || p.fold || {after}) ELSE p.fold END AS fold,
  CASE WHEN r.n > 1 THEN p.proof || {before} || {after} ELSE p.proof END AS proof
  FROM p{step} p JOIN {name}r{h} r ON {on} AND r.i = p.{index} // {16**(h + 1)})""")
            step += 1
    return f"""WITH {", ".join(ctes)}
SELECT doc_id, p.h AS leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.h AS verified
FROM p{step} p, t{top_depth} t"""
