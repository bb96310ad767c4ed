"""MinHash near-dedup (4): texts whose sets of word runs (shingles) are nearly the same.

Each text's signature holds ``BANDS`` * ``ROWS`` minima of universal hashes of its shingles. Texts
with the same set form a class with a number of its own, and one of its texts goes on. Two classes are candidates
if all minima of a band agree: at the asked similarity of 0.85 a pair is missed with a probability
of (1 - 0.85^5)^30 = 2e-8 (0.8: 6e-6).

Candidates of a band bucket are not paired off. In the first round every member is compared with the
bucket's smallest (its hub), signatures first, then full sets. Links are joined to components by
star steps. Buckets that lie within one component are done. What remains gets an exact test of
whether it can have a partner at all: shingles that no other remaining text has, and the size of the
bucket's smallest set, bound the similarity from above. Further rounds take as hub the member with
the most links so far, leaving out hubs that have been compared with all of a bucket. After
``ROUNDS`` rounds all remaining texts of different components that share a rare enough shingle are compared:
each pair that can link does (``sharing``). So each candidate pair is compared, joined by others, or can't link.

A signature test drops a pair before that if so few of its minima agree that a pair at the asked
similarity would be dropped with a probability below ``DROPPED`` (binomial, computed exactly). Full sets are compared as sets of word runs, not hashes.

Edge cases: null, blank or empty texts have an empty set and link with nothing. A text with fewer
words than a shingle has one shingle, all its words. Repeated rows share a class. Rows with a null
doc_id are left out of links and are kept. A doc_id on several rows is one document for the links:
what either of its texts is linked with, and the texts themselves, have one component.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.llm.common import ship, written
from surveypulse.llm.components import components

SHINGLE, SIMILAR = 5, 80
BANDS, ROWS, DROPPED, ROUNDS = 30, 5, 1e-7, 2
PRIME = (1 << 61) - 1
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Of one hub, so many partners are compared in a task's group.
GROUP = 64


def shingles(text: str | None, size: int) -> set[bytes]:
    """Runs of ``size`` words, A-Z in lower case."""
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    return {b" ".join(w) for w in zip(*(words[i:] for i in range(size)), strict=False)}


def hashes(found: set[bytes]) -> np.ndarray:
    """A 64-bit hash for each, sorted."""
    joined = b"".join(hashlib.blake2b(s, digest_size=8).digest() for s in found)
    return np.sort(np.frombuffer(joined, np.uint64))


class Family:
    """Universal hashes a * x + b modulo 2**64, upper halves, a odd and b drawn once."""

    def __init__(self, n: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, np.uint64)

    def minima(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for at in range(0, len(x), 2048):
            part = x[at : at + 2048]
            np.minimum(out, (self.a[:, None] * part[None, :] + self.b[:, None]).min(1), out=out)
        return (out >> np.uint64(32)).astype(np.uint32)


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key (of the text), n_shingles, set_key (of the whole set), sig (minima)."""
    def run(batches):
        family = Family(bands * rows)
        for batch in batches:
            n, keys, sigs, own = [], [], [], []
            for t in batch.column("text").to_pylist():
                found = shingles(t, size)
                n.append(len(found))
                own.append(hashlib.md5((t or "").encode(), usedforsecurity=False).digest())
                x = hashes(found)
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if found else None)
                sigs.append(family.minima(x).tobytes() if found else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_key": pa.array(own, pa.binary()), "n_shingles": pa.array(n, pa.int64()),
                "set_key": pa.array(keys, pa.binary()), "sig": pa.array(sigs, pa.binary()),
            })

    return docs.mapInArrow(run, "doc_id long, text_key binary, n_shingles long, set_key binary, sig binary")


def band_keys(bands: int = BANDS, rows: int = ROWS):
    """The buckets of a signature, one per band."""
    width = 4 * rows
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))),
    )


def least_agreeing(similar: int, minima: int, dropped: float = DROPPED) -> int:
    """The most minima that can be asked to agree if fewer do so with a probability below ``dropped``."""
    p, below = similar / 100, 0.0
    for k in range(minima):
        below += math.comb(minima, k) * p**k * (1 - p) ** (minima - k)
        if below >= dropped:
            return k
    return minima


def agreeing(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree in a share of ``least`` or more."""
    both = (pairs.join(classes.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
            .join(classes.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b"))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if n:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(n, -1) for c in ("sa", "sb"))
                good = pa.array((x == y).mean(1) >= least)
                yield batch.select(["a", "b"]).filter(good)

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, similar: int) -> DataFrame:
    """Pairs (a hub, b) with 100 * intersection >= similar * union, on full sets of word runs.
    A hub's partners are dealt to groups of about ``GROUP``, each with one copy of the hub's text."""
    pairs = written(pairs.distinct())
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    hubs = groups.join(texts, groups["a"] == texts["id"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.lit(None).cast("long").alias("b"), "text")
    members = pairs.join(groups, "a").join(texts.withColumnRenamed("id", "b"), "b").select(
        "a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("g"), "b", "text")

    def compare(group: pa.Table) -> pa.Table:
        a, ids, texts_ = group.column("a")[0].as_py(), group.column("b").to_pylist(), group.column("text").to_pylist()
        hub = shingles(texts_[ids.index(None)], size)
        good = []
        for b, t in zip(ids, texts_, strict=True):
            if b is not None:
                other = shingles(t, size)
                both = len(hub & other)
                if both and 100 * both >= similar * (len(hub) + len(other) - both):
                    good.append(b)
        return pa.table({"a": pa.array([a] * len(good), pa.int64()), "b": pa.array(good, pa.int64())})

    return hubs.union(members).groupBy("a", "g").applyInArrow(compare, "a long, b long")


def open_buckets(rows: DataFrame) -> DataFrame:
    """The rows of buckets that lie in more than one component."""
    several = rows.groupBy("bucket").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("bucket")
    return rows.join(several, "bucket", "left_semi")


def partnered(rows: DataFrame, texts: DataFrame, size: int, similar: int) -> DataFrame:
    """The rows (bucket, id, part) whose id can have a partner among them, with ``n``, its number of
    shingles, and ``s``, how many of them another remaining text has too. A link needs
    100 * i >= similar * (n + m - i) with i <= s, and the partner has m >= the smallest n around."""
    def run(batches):
        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                x = hashes(shingles(t, size)).view(np.int64)
                yield pa.RecordBatch.from_pydict({"id": pa.array([i] * len(x), pa.int64()), "x": pa.array(x)})

    some = written(texts.join(rows.select("id").distinct(), "id", "left_semi"))
    found = some.select("id", "text").mapInArrow(run, "id long, x long")
    own = found.groupBy("x").agg(F.count("*").alias("k"), F.min("id").alias("id")).where("k = 1").groupBy("id").agg(F.count("*").alias("own"))
    facts = some.join(own, "id", "left").select("id", F.col("n_shingles").alias("n"), (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("s"))
    facts = written(facts)
    sized = rows.select("bucket", "id", "part").join(facts, "id")
    least = sized.groupBy("bucket").agg(F.min("n").alias("m"))
    able = sized.join(least, "bucket").where(f"100 * s >= {similar} * n AND {100 + similar} * s >= {similar} * (n + m)")
    return written(open_buckets(able.select("bucket", "id", "part", "n", "s")))


def sharing(rest: DataFrame, texts: DataFrame, size: int, similar: int) -> DataFrame:
    """Pairs (a, b) of the ids in ``rest`` (id, part) that lie in different parts and may link.

    The shingles of each text are put in one order for all, rare ones first. Of a linked pair with n >= m shingles,
    i >= similar * (n + m) / (100 + similar) are common, so the first common one lies among the first
    n - similar * n / 100 + 1 of the larger and the first m - 2 * similar * m / (100 + similar) + 1 of the smaller, with
    i - 1 or more behind it in both. Only texts that share such a shingle are paired: those that differ
    from a common original in more places than links allow have nothing but their own shingles there."""
    def run(batches):
        for batch in batches:
            for i, part, n, t in zip(*(batch.column(c).to_pylist() for c in ("id", "part", "n", "text")), strict=True):
                x = hashes(shingles(t, size)).view(np.int64)
                yield pa.RecordBatch.from_pydict({"id": pa.array([i] * len(x), pa.int64()), "part": pa.array([part] * len(x), pa.int64()),
                                                  "n": pa.array([n] * len(x), pa.int64()), "x": pa.array(x)})

    some = texts.join(rest, "id").select("id", "part", F.col("n_shingles").alias("n"), "text")
    found = some.mapInArrow(run, "id long, part long, n long, x long")
    common = found.groupBy("x").agg(F.count("*").alias("k")).where("k > 1")
    own = Window.partitionBy("id")
    # Shingles of one text alone come first of all; they are left out and counted.
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("k", "x")) - 1
    placed = found.join(common, "x").withColumn("place", place).drop("k")
    placed = written(placed.where(f"{similar} * n <= 100 * (n - place)").withColumn("behind", F.expr("n - place")).drop("place"))
    larger = placed.select("x", F.col("id").alias("a"), F.col("part").alias("part_"), F.col("n").alias("n_"), F.col("behind").alias("behind_"))
    smaller = placed.where(f"{2 * similar} * n <= {100 + similar} * behind")
    fits = f"part_ <> part AND (n_ > n OR n_ = n AND a < id) AND {100 + similar} * least(behind_, behind) >= {similar} * (n_ + n)"
    return smaller.join(larger, "x").where(fits).select("a", F.col("id").alias("b")).distinct()


def same_document(sigs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) between the classes of a doc_id's different texts."""
    several = sigs.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).where("x <> y")
    ends = sigs.join(several.select("doc_id", "x"), "doc_id").where("set_key <> x").select("set_key", "x").distinct()
    of = classes.select("set_key", F.col("id").alias("u"))
    return ends.join(of, "set_key").join(of.select(F.col("set_key").alias("x"), F.col("u").alias("v")), "x").select("u", "v")


def near_components(docs: DataFrame, size: int, similar: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures of all rows, classes (id, set_key, doc_id: the smallest, ...), (node, component) of the classes that have links)."""
    sigs = written(signatures(docs, size))
    classes = sigs.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("m"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    # Numbers that differ with each run; nothing in the result depends on them.
    classes = written(classes.select(F.monotonically_increasing_id().alias("id"), "set_key", "m.doc_id", "m.text_key", "sig", "n_shingles"))
    rows = classes.select("id", F.explode(band_keys()).alias("bucket"))
    full = rows.groupBy("bucket").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    buckets = written(rows.join(full, "bucket").select("bucket", "id", "hub"))
    nodes = buckets.select("id").distinct()
    chosen = classes.join(nodes, "id").select("id", "doc_id", "text_key", "n_shingles")
    texts = docs.withColumn("text_key", F.unhex(F.md5("text"))).join(chosen, ["doc_id", "text_key"])
    texts = written(texts.select("id", "text", "n_shingles"))
    least = least_agreeing(similar, BANDS * ROWS) / (BANDS * ROWS)

    def links(pairs: DataFrame) -> DataFrame:
        return written(confirmed(agreeing(pairs.distinct(), classes, least), texts, size, similar))

    def joined(known: DataFrame, more: DataFrame) -> DataFrame:
        return components(known.union(more.select(F.col("a").alias("u"), F.col("b").alias("v"))))

    edges = links(buckets.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")))
    groups = joined(same_document(sigs, classes), edges)
    done = buckets.select("bucket", F.col("hub").alias("id")).distinct()  # hubs compared with all of their bucket
    left = buckets
    fits = f"{100 + similar} * least(s, s_) >= {similar} * (n + n_)"
    for turn in range(ROUNDS):
        facts = ["n", "s"] if turn else []
        named = left.join(groups, left["id"] == groups["node"], "left").select("bucket", "id", F.coalesce("component", "id").alias("part"), *facts)
        left = written(open_buckets(named))
        if turn == 0:
            rows_left, before = left.count(), 0
            while rows_left and rows_left < 0.95 * before or not before:
                # Each pass leaves fewer texts to share shingles with; it goes on while that helps.
                before = max(1, rows_left)
                left = partnered(left, texts, size, similar)
                rows_left = left.count()
        # A bucket is done if those that were not its hub lie in one component.
        rest = written(open_buckets(left.join(done, ["bucket", "id"], "left_anti")))
        if rest.isEmpty():
            break
        other = rest.select("bucket", F.col("id").alias("a"), F.col("part").alias("part_"), F.col("n").alias("n_"), F.col("s").alias("s_"))
        if turn < ROUNDS - 1:
            degree = edges.select(F.col("a").alias("id")).union(edges.select("b")).groupBy("id").agg(F.count("*").alias("degree"))
            ranked = rest.join(degree, "id", "left").select("bucket", "id", F.coalesce("degree", F.lit(0)).alias("degree"))
            top = ranked.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("id")).alias("id"))).alias("m"))
            hub = written(top.select("bucket", (-F.col("m.id")).alias("id")))
            pairs = rest.join(other.join(hub.withColumnRenamed("id", "a"), ["bucket", "a"]), "bucket").where(f"part <> part_ AND {fits}").select("a", F.col("id").alias("b"))
            done = written(done.union(hub))
        else:
            pairs = sharing(rest.select("id", "part").distinct(), texts, size, similar)
        new = links(pairs)
        edges = written(edges.union(new))
        groups = joined(groups.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v")), new)
    return sigs, classes, groups


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that links reach), kept; one row per row
    of ``docs``. ``similar`` is the asked Jaccard similarity in percent."""
    ship(docs.sparkSession)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sigs, classes, groups = near_components(picked, size, similar)
    named = written(classes.join(groups, classes["id"] == groups["node"], "left").select("set_key", "doc_id", F.coalesce("component", "id").alias("part")))
    least = named.groupBy("part").agg(F.min("doc_id").alias("component"))
    named = named.join(least, "part").select("set_key", "component")
    out = sigs.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    part = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", part.alias("component_id"), F.coalesce(part == F.col("doc_id"), F.lit(True)).alias("kept"))
