"""Source divergence audit: how differently the sources of a language use its terms.

A language keeps the terms that at least ``least_docs`` of its documents hold. Each (language, source)
group and each language prices a kept term at p = 1 + floor(10**9 * (count + 5) / (N + 5 * V)), with N
the counts' sum and V the kept terms. Part ``pair`` sums |p - q| over all kept terms for each two
groups of a language; part ``term`` lists a group's terms whose price is furthest above the language's.

**Pair tasks.** Kept terms are numbered by text. A group's counts are arrays sorted by term number, cut
into shards of ``SHARD`` numbers, so that no array grows with the vocabulary. A pair task co-groups a
shard's arrays of two blocks of ``BLOCK`` sources and merges each unordered pair once: the shorter array
gallops through the longer one, terms of both are priced together, terms of one against the other's
price of an absent term, and terms that neither has as their number times one difference. A task returns
partial sums, which hold both ways.

**Exact.** Prices come from whole numbers, nine digits by long division in steps of 1000, so counts up
to 9 * 10**15 do not overflow; the language's come from decimals.

**Edge cases.** Null text, lang and source are the empty text. A group without kept terms is in all
results with counts of 0; a language without kept terms has pair values of 0 and no terms; a language
with one source has no pairs; an empty table gives no rows. Repeated rows count again. Other columns are
ignored, whatever their names. Ties in value go by the item's UTF-8 bytes.

**Scale.** Words are counted in the task that reads them, per language, source and term, with partial
counts handed on when ``HELD`` different ones are held; the rest is sums. Arrays are repeated once per
block of the other sources. The window of part ``term`` keeps the best rows before its shuffle.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.llm.common import ship, written
from surveypulse.llm.numbering import numbered
from surveypulse.operators.joins import join_sized

LEAST_DOCS, BEST = 30, 50
SMOOTH, UNIT = 5, 1_000_000_000
SHARD, BLOCK, HELD = 1 << 16, 8, 400_000

# Bytes that are in no term become spaces, A-Z become small; all bytes of other characters stay.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c <= 64 or 91 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))

_COUNTS = "lang STRING, source STRING, term STRING, n BIGINT, docs BIGINT"
_COUNTS_ARROW = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_SIDE = "lang STRING, source STRING, shard BIGINT, block BIGINT, whole BIGINT, terms BIGINT, ids BINARY, counts BINARY"
_PART = "lang STRING, a STRING, b STRING, f BIGINT"
_PART_ARROW = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("f", pa.int64())])


def _counted(batches):
    """Partial counts of each (lang, source, term): occurrences and documents. A document without terms
    counts its group by an empty term, which no text holds."""
    total: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}
    held = 0

    def out():
        columns = [[], [], [], [], []]
        for group, terms in total.items():
            seen = docs[group]
            columns[0] += [group[0]] * len(terms)
            columns[1] += [group[1]] * len(terms)
            columns[2] += terms.keys()
            columns[3] += terms.values()
            columns[4] += [seen[t] for t in terms]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                                           pa.array(columns[2], pa.binary()).cast(pa.string()),
                                           pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], schema=_COUNTS_ARROW)

    for batch in batches:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
            group = (lang or "", source or "")
            words = Counter((text.as_buffer().to_pybytes() if text.is_valid else b"").translate(_FOLD).split())
            words[b""] = 1
            mine = total.setdefault(group, Counter())
            held -= len(mine)
            mine.update(words)
            held += len(mine)
            docs.setdefault(group, Counter()).update(words.keys())
            if held >= HELD:
                yield out()
                total, docs, held = {}, {}, 0
    yield out()


def price(count: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 5) / whole), exactly."""
    rest = count.astype(np.int64) + SMOOTH
    value = np.zeros(len(count), np.int64)
    for _ in range(3):
        rest = rest * 1000
        value = value * 1000 + rest // whole
        rest %= whole
    return value + 1


def gallop(small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the common entries of two ascending arrays. All entries of ``small`` move through ``large``
    in step: each doubles its stride until it has passed its entry's place, then halves it."""
    if not len(small) or not len(large):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Entries start where an even spread would put them, so that strides stay short.
    base = np.arange(len(small)) * len(large) // len(small)
    ahead = large[base] < small
    stride = np.where(ahead, 1, -1)
    while True:
        to = base + stride
        inside = (to >= 0) & (to < len(large))
        more = inside & ((large[np.clip(to, 0, len(large) - 1)] < small) == ahead)
        if not more.any():
            break
        stride = np.where(more, stride * 2, stride)
    low = np.clip(np.where(ahead, base, base + stride), -1, len(large))
    high = np.clip(np.where(ahead, base + stride, base), -1, len(large))
    while True:  # large[low] < entry <= large[high]
        open_ = high - low > 1
        if not open_.any():
            break
        middle = np.where(open_, (low + high) // 2, high)
        less = open_ & (large[np.clip(middle, 0, len(large) - 1)] < small)
        low, high = np.where(less, middle, low), np.where(less | ~open_, high, middle)
    found = np.flatnonzero((high < len(large)) & (large[np.clip(high, 0, len(large) - 1)] == small))
    return found, high[found]


def merged(a: tuple, b: tuple, terms: int) -> int:
    """Sum of |p - q| over the ``terms`` kept terms of a shard. A group is its ascending term numbers, their
    prices and its price of an absent term."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at, bt = gallop(a[0], b[0])
    only_a, only_b = np.ones(len(a[0]), bool), np.ones(len(b[0]), bool)
    only_a[at] = only_b[bt] = False
    f = np.abs(a[1][at] - b[1][bt]).sum() + np.abs(a[1][only_a] - b[2]).sum() + np.abs(b[1][only_b] - a[2]).sum()
    neither = terms - (len(a[0]) + len(b[0]) - len(at))
    return int(f) + neither * abs(a[2] - b[2])


def _priced(side: pa.Table) -> dict[str, tuple]:
    found = {}
    for row in side.to_pylist():
        whole = max(row["whole"], 1)  # nothing is priced where a language keeps no term
        prices = price(np.frombuffer(row["counts"], "<i8"), whole)
        found[row["source"]] = (np.frombuffer(row["ids"], "<i8"), prices, int(price(np.zeros(1, np.int64), whole)[0]))
    return found


def _merge_blocks(left: pa.Table, right: pa.Table) -> pa.Table:
    out = []
    if left.num_rows and right.num_rows:
        lang, terms = left.column("lang")[0].as_py(), left.column("terms")[0].as_py()
        one, other = _priced(left), _priced(right)
        out = [(lang, a, b, merged(one[a], other[b], terms)) for a in one for b in other if a < b]
    columns = list(zip(*out, strict=True)) or [()] * len(_PART_ARROW)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PART_ARROW, strict=True)], schema=_PART_ARROW)


_ARRAYS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("shard", pa.int64()), ("block", pa.int64()), ("whole", pa.int64()),
                     ("terms", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])


def _pack(group: pa.Table) -> pa.Table:
    """The sorted term numbers and counts of a (lang, source, shard) as bytes; the row without a number only
    makes sure that the group is there."""
    first = [group.column(c)[0].as_py() for c in ("lang", "source", "shard", "block", "whole", "terms")]
    known = group.filter(pc.is_valid(group.column("index"))).sort_by("index")
    arrays = [known.column(c).to_numpy().astype("<i8").tobytes() for c in ("index", "n")]
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip([*first, *arrays], _ARRAYS.types, strict=True)], schema=_ARRAYS)


def _price(count: Column, whole: Column) -> Column:
    """The same price from decimals."""
    top = (count + SMOOTH).cast("decimal(19,0)") * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top, whole.cast("decimal(19,0)")).cast("bigint") + 1


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, best: int = BEST, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank``: see above."""
    ship(docs.sparkSession)
    parts = docs.select("lang", "source", "text").mapInArrow(_counted, _COUNTS)
    counts = written(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    groups = counts.where("term = ''").select("lang", "source")

    # Kept terms of each language with their numbers, and their counts by source.
    every = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    terms = numbered(written(every.where(F.col("docs") >= least_docs).drop("docs")), "lang", ["term"]).withColumnRenamed("n", "v")
    known = written(join_sized(counts.where("term <> ''").drop("docs"), terms, ["lang", "term"], "inner", spread=["source"]))

    # N + 5 * V of each group and its language, and the blocks of sources.
    langs = known.groupBy("lang").agg(F.max("v").alias("v"), F.sum("n").alias("lang_sum"))
    sums = known.groupBy("lang", "source").agg(F.sum("n").alias("sum"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sides = written(groups.join(langs, "lang", "left").join(sums, ["lang", "source"], "left").fillna(0, ["v", "lang_sum", "sum"]).select(
        "lang", "source", "v", (F.col("sum") + SMOOTH * F.col("v")).alias("whole"),
        (F.col("lang_sum") + SMOOTH * F.col("v")).alias("lang_whole"), F.floor(place / block).cast("bigint").alias("block")))
    rows = join_sized(known.select("lang", "source", "term", "n", "lang_n", "index"), sides, ["lang", "source"], "inner", spread=["term"])

    shards = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("v") / shard).cast("bigint") - 1, F.lit(0)))
    present = sides.withColumns({"shard": F.explode(shards), "index": F.lit(None).cast("bigint"), "n": F.lit(0).cast("bigint")})
    columns = ["lang", "source", "shard", "block", "whole", "v", "index", "n"]
    both = rows.withColumn("shard", F.floor(F.col("index") / shard).cast("bigint")).select(*columns).union(present.select(*columns))
    sized = both.withColumn("terms", F.least(F.lit(shard).cast("bigint"), F.col("v") - F.col("shard") * shard)).drop("v")
    arrays = written(sized.groupBy("lang", "source", "shard").applyInArrow(_pack, _SIDE))

    # Block i of the sources meets each block j >= i, in every shard of the vocabulary.
    dealt = join_sized(arrays, sides.groupBy("lang").agg(F.max("block").alias("last")), ["lang"], "inner", spread=["source"]).select(*_ARRAYS.names, "last")
    left = dealt.withColumn("other", F.explode(F.sequence("block", "last"))).drop("last")
    # New names, so that the two sides of one table can be told apart.
    right = dealt.drop("last").toDF(*_ARRAYS.names).withColumnRenamed("block", "other").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), "other")))
    key = ["lang", "shard", "block", "other"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_merge_blocks, _PART)
    pairs = met.groupBy("lang", "a", "b").agg(F.sum("f").alias("value"))
    ways = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = pairs.select("lang", ways, "value")

    above = rows.select("lang", "source", F.col("term").alias("item"), (_price(F.col("n"), F.col("whole")) - _price(F.col("lang_n"), F.col("lang_whole"))).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    shown = ["lang", "source", "part", "item", "value", "rank"]
    first = above.where("value > 0").select("*", rank).where(F.col("rank") <= best).withColumn("part", F.lit("term"))
    return pairs.select("*", rank).withColumn("part", F.lit("pair")).select(*shown).union(first.select(*shown))


def oracle(least_docs: int = LEAST_DOCS, best: int = BEST) -> str:
    """SQL: every group has every kept term of its language, counted or not."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    price = lambda count, whole: f"1 + ({UNIT}::HUGEINT * ({count} + {SMOOTH})) // {whole}"
    return f"""WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS text FROM documents),
w AS MATERIALIZED (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= {least_docs}),
c AS MATERIALIZED (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY 1, 2, 3),
g AS MATERIALIZED (SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(s, 0) + {SMOOTH} * coalesce(v, 0) AS whole, coalesce(t, 0) + {SMOOTH} * coalesce(v, 0) AS lang_whole
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN (SELECT lang, count(*) AS v, sum(n) AS t FROM k GROUP BY 1) l ON l.lang = g.lang
  LEFT JOIN (SELECT lang, source, sum(n) AS s FROM c GROUP BY 1, 2) x ON x.lang = g.lang AND x.source = g.source),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {price("coalesce(c.n, 0)", "whole")} AS p, {price("k.n", "lang_whole")} AS q
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(r AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM o) WHERE part = 'pair' OR r <= {best}"""
