"""Approximate nearest neighbours (8): robust-pruned directed graphs, one per shard.

Different vectors are dealt to shards by hash. In a shard, vectors enter the graph in growing
batches: a greedy search proposes neighbours, and relaxed pruning keeps a candidate only if no kept
neighbour is closer to it by the factor ``ALPHA``, so edges point in diverse directions; each edge is
also put in backwards and its target pruned again. Largest inner product becomes smallest distance
by one more coordinate that gives all vectors the length of the longest; queries have 0 there.
Blocks of queries then go through every shard's graph by beam search, many in step as matrix
products, and each shard's best are scored by exact inner products in double precision and merged where
they are found: a task keeps one list a query while the shards pass by.

Equal vectors stand in the graph once, with their smallest ids, as many as a result can hold.

Edge cases: vectors that are null, zero, hold null or non-finite components, or have another length
than most, and rows without an id take no part. Ids on several rows with different vectors count as
several candidates. Shards with no more vectors than the beam are searched whole, so few candidates
are all returned. Repeated query rows have repeated results. An empty table has an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveypulse.llm.common import ship, written

DEGREE, BEAM, ALPHA = 32, 64, 1.2
SHARD, BLOCK, STEP = 8192, 512, 2
#: Inner products that pruning holds at once.
PRUNED = 1 << 20
#: Searches are dealt to ``TASKS`` tasks at least if there are so many, shards to ``PARTS`` parts at least, queries
#: to rows of ``ROW`` blocks at most.
TASKS, PARTS, ROW = 128, 8, 8


def beam_search(graph: np.ndarray, vecs: np.ndarray, start: int, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``width`` nearest nodes met and their squared distances; -1 pads."""
    n, many = len(vecs), len(queries)
    norms, own = np.einsum("ij,ij->i", vecs, vecs), np.einsum("ij,ij->i", queries, queries)
    if n <= width:
        ids = np.full((many, width), -1, np.int64)
        dist = np.full((many, width), np.inf, np.float32)
        ids[:, :n] = np.arange(n)
        dist[:, :n] = norms + own[:, None] - 2 * queries @ vecs.T
        order = np.argsort(dist, 1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)

    def keys(dist: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Distance, node and whether it has been left, in one number that sorts by distance: the bits of floats from 0 on do."""
        return np.maximum(dist, np.float32(0)).astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | nodes.astype(np.uint64) << np.uint64(1)

    left, none = np.uint64(1), np.uint64((1 << 64) - 1)
    beams = np.full((many, width), none, np.uint64)
    beams[:, 0] = keys(norms[start] + own - 2 * queries @ vecs[start], np.full(many, start))
    met = np.zeros(many * n, bool)
    met[np.arange(many) * n + start] = True
    live = np.arange(many)
    while True:
        # The nearest nodes of each beam that have not been left yet.
        beam = beams[live]
        near = np.full((len(live), STEP, graph.shape[1]), -1, np.int32)
        rows = np.arange(len(live))
        for k in range(STEP):
            open_ = (beam & left) == 0
            col = open_.argmax(1)
            has = np.nonzero(open_[rows, col])[0]
            if not k:
                beam, live, near, col = beam[has], live[has], near[: len(has)], col[has]
                rows = has = np.arange(len(live))
            near[has, k] = graph[beam[has, col[has]] >> left & np.uint64(0x7FFFFFFF)]
            beam[has, col[has]] |= left
        if not len(live):
            break
        near = np.sort(near.reshape(len(live), -1), 1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        at = near[r, c]
        cell = live[r] * n + at
        new = ~met[cell]
        r, at = r[new], at[new]
        met[cell[new]] = True
        far = keys(norms[at] + own[live[r]] - 2 * np.einsum("ij,ij->i", np.take(vecs, at, 0), np.take(queries, live[r], 0)), at)
        # Those that come in, at the front of rows as short as the longest.
        better = far < beam[r, -1]
        r, far = r[better], far[better]
        count = np.bincount(r, minlength=len(live))
        if size := int(count.max(initial=0)):
            wide = np.full((len(live), width + size), none, np.uint64)
            wide[:, :width] = beam
            wide[r, width + np.arange(len(r)) - (np.cumsum(count) - count)[r]] = far
            wide.sort(1)
            beam = wide[:, :width]
        beams[live] = beam
    ids = (beams >> left & np.uint64(0x7FFFFFFF)).astype(np.int64)
    dist = np.ascontiguousarray((beams >> np.uint64(32)).astype(np.uint32)).view(np.float32).copy()
    ids[beams == none], dist[beams == none] = -1, np.inf
    return ids, dist


def robust_prune(vecs: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates (-1 pads), nearest first, each not nearer by
    ``alpha`` to one kept before than to the node."""
    if len(nodes) > (some := max(1, PRUNED // candidates.shape[1] ** 2)):
        return np.concatenate([robust_prune(vecs, nodes[a : a + some], candidates[a : a + some], degree, alpha) for a in range(0, len(nodes), some)])
    cand = np.sort(candidates, 1)
    bad = (cand < 0) | (cand == nodes[:, None])
    bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    cand = np.where(bad, 0, cand)
    away = np.take(vecs, cand, 0)
    away -= vecs[nodes][:, None, :]
    dist = np.where(bad, np.inf, np.einsum("bcd,bcd->bc", away, away))
    order = np.argsort(dist, 1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    points = np.take(vecs, cand, 0)
    norms = np.einsum("bcd,bcd->bc", points, points)
    inner = np.matmul(points, points.transpose(0, 2, 1))
    alive = np.isfinite(dist)
    out = np.full((len(nodes), degree), -1, np.int32)
    rows = np.arange(len(nodes))
    for k in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        pick = alive.argmax(1)
        out[has, k] = cand[rows, pick][has]
        between = norms + norms[rows, pick][:, None] - 2 * inner[rows, pick]
        alive &= alpha * alpha * between > dist
        alive[rows, pick] = False
        alive &= has[:, None]
    return out


def build_graph(vecs: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 3) -> tuple[np.ndarray, int]:
    """The graph's out-edges (-1 pads) and the node where searches start."""
    n = len(vecs)
    graph = np.full((n, degree), -1, np.int32)
    middle = vecs - vecs.mean(0)
    start = int(np.einsum("ij,ij->i", middle, middle).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != start]
    at, size = 0, 1
    while at < len(order):
        batch = order[at : at + size]
        at, size = at + size, min(BLOCK, size * 2)
        if at <= beam:  # few so far: all are candidates
            found = np.tile(np.append(order[:at], start), (len(batch), 1))
        else:
            found, _ = beam_search(graph, vecs, start, vecs[batch], beam)
        graph[batch] = robust_prune(vecs, batch, found, degree, alpha)
        # Backward edges: each target takes its new sources, and is pruned if they are too many.
        source, to = np.repeat(batch, degree), graph[batch].ravel()
        source, to = source[to >= 0], to[to >= 0]
        turn = np.argsort(to, kind="stable")
        source, to = source[turn], to[turn]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        turn = np.argsort(count, kind="stable")  # those of like width together
        targets, first, count = targets[turn], first[turn], count[turn]
        for a in range(0, len(targets), BLOCK):
            t, c = targets[a : a + BLOCK], count[a : a + BLOCK]
            wide = np.full((len(t), degree + int(c.max())), -1, np.int64)
            wide[:, :degree] = graph[t]
            row = np.repeat(np.arange(len(t)), c)
            col = np.arange(len(row)) - np.repeat(np.cumsum(c) - c, c)
            wide[row, degree + col] = source[np.repeat(first[a : a + BLOCK], c) + col]
            over = (wide >= 0).sum(1) > degree
            packed = np.take_along_axis(wide, np.argsort(wide < 0, 1, kind="stable"), 1)[:, :degree]
            graph[t] = packed
            if over.any():
                graph[t[over]] = robust_prune(vecs, t[over], wide[over], degree, alpha)
    return graph, start


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part if they have the right length."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<float>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return rows.where(F.forall("v", finite) & F.exists("v", lambda x: x != 0))


def length(rows: DataFrame) -> int:
    """The length that most vectors have."""
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    return sizes[0]["d"] if sizes else 0


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks()
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(-1, dim)


def nearest(
    df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
    shard: int = SHARD, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA,
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` the ``k`` rows of ``df`` with the
    largest inner product, found through the shards' graphs, but not the one with its own id."""
    ship(df.sparkSession)
    rows = vectors(df, id_col, vec_col)
    dim = length(rows)
    rows = rows.where(F.size("v") == dim)
    asked = written(vectors(queries, id_col, vec_col).where(F.size("v") == dim))
    # Each different vector with its k + 1 smallest ids; the limit works before the shuffle too.
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    classes = written(first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    stats = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x)).alias("m")).first()
    shards, longest = max(1, -(-stats["n"] // shard)), stats["m"] or 0.0

    def build(group: pa.Table) -> pa.Table:
        group = group.take(pa.array(np.argsort(group.column("least").to_numpy(), kind="stable")))
        plain = matrix(group.column("v"), dim)
        wide = plain.astype(np.float64)
        more = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", wide, wide), 0)).astype(np.float32)
        graph, start = build_graph(np.concatenate([plain, more[:, None]], 1), degree, beam, alpha)
        ids = group.column("ids").combine_chunks()
        return pa.table({
            "shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "start": pa.array([start], pa.int32()),
            "vecs": [plain.tobytes()], "more": [more.tobytes()], "graph": [graph.tobytes()],
            "offsets": [np.asarray(ids.offsets, np.int64).tobytes()], "ids": [np.asarray(ids.flatten(), np.int64).tobytes()],
        })

    # As many partitions as shards need, for few bytes make long tasks here, but no more than the session's or ``TASKS``.
    dealt = min(2 * shards, max(TASKS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    index = written(
        classes.select((F.pmod(F.xxhash64("v"), F.lit(shards))).cast("int").alias("shard"), F.col("ids")[0].alias("least"), "v", "ids")
        .repartition(dealt, "shard")
        .groupBy("shard").applyInArrow(build, "shard int, start int, vecs binary, more binary, graph binary, offsets binary, ids binary"))
    # Different query vectors, in rows of one to several blocks.
    distinct_q = written(asked.groupBy("v").agg(F.min("id").alias("q")))
    blocks = max(1, -(-distinct_q.count() // BLOCK))
    asking = max(min(blocks, TASKS // PARTS), -(-blocks // ROW))

    def block(group: pa.Table) -> pa.Table:
        return pa.table({"b": group.column("b")[:1], "q": [group.column("q").to_numpy().astype(np.int64).tobytes()], "qv": [matrix(group.column("v"), dim).tobytes()]})

    blocked = written(distinct_q.withColumn("b", F.pmod(F.xxhash64("q"), F.lit(asking))).groupBy("b").applyInArrow(block, "b long, q binary, qv binary"))
    # Each pair of queries and shard, by a product that reads partitions where they are: a task holds one row of
    # queries, and its share of the shards passes by. Nothing is sent for a pair, and the driver has no part in it.
    passing = min(shards, max(PARTS, TASKS // asking))
    pairs = index.coalesce(passing).crossJoin(blocked.repartitionByRange(asking, "b").hint("shuffle_replicate_nl"))

    def search(batches):
        shard, best = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                raw = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)  # noqa: B023, E731
                if batch.column("shard")[i].as_py() != shard:
                    shard, start = batch.column("shard")[i].as_py(), batch.column("start")[i].as_py()
                    vecs = np.concatenate([raw("vecs", np.float32).reshape(-1, dim), raw("more", np.float32)[:, None]], 1)
                    graph = raw("graph", np.int32).reshape(len(vecs), -1).copy()
                    offsets, ids = raw("offsets", np.int64).copy(), raw("ids", np.int64).copy()
                b = batch.column("b")[i].as_py()
                if b not in best:
                    q = raw("q", np.int64).copy()
                    best[b] = q, np.full(len(q), -np.inf), (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
                q, floor, met = best[b]
                every = np.concatenate([raw("qv", np.float32).reshape(-1, dim), np.zeros((len(q), 1), np.float32)], 1)
                for a in range(0, len(q), BLOCK):
                    qv = every[a : a + BLOCK]
                    found, _ = beam_search(graph, vecs, start, qv, beam)
                    score = np.einsum("qd,qnd->qn", qv[:, :dim].astype(np.float64), vecs[np.maximum(found, 0), :dim].astype(np.float64))
                    score[found < 0] = -np.inf
                    # Each node has an id at least, so what is below the last of the best so far, there or here, can't come in.
                    least = floor[a : a + BLOCK]
                    if score.shape[1] > k:
                        least = np.maximum(least, np.partition(score, -k - 1, 1)[:, -k - 1])
                    row, col = np.nonzero((score >= least[:, None]) & (found >= 0))
                    node = found[row, col]
                    many = offsets[node + 1] - offsets[node]
                    at = np.repeat(offsets[node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    met = tuple(map(np.concatenate, zip(met, (np.repeat(row + a, many), np.repeat(score[row, col], many), ids[at]), strict=True)))
                order = np.lexsort((met[2], -met[1], met[0]))
                row, s, v = (x[order] for x in met)
                turn = np.arange(len(row)) - np.searchsorted(row, row)
                floor[row[turn == k]] = s[turn == k]
                best[b] = q, floor, tuple(x[turn <= k] for x in (row, s, v))
        for q, _, (row, s, v) in best.values():
            yield pa.RecordBatch.from_pydict({"q": pa.array(q[row]), "score": pa.array(s), "vec_id": pa.array(v)})

    met = pairs.mapInArrow(search, "q long, score double, vec_id long")
    best = met.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    listed = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))).alias("found"))
    # Files may be far smaller than what they hold, so none of these is left to be broadcast for its size.
    named = asked.join(distinct_q.hint("merge"), "v").select(F.col("id").alias("query_id"), "q").join(listed.hint("merge"), "q")
    mine = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return named.select("query_id", F.posexplode(mine).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
