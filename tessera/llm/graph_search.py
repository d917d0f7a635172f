"""Approximate nearest neighbours over robust-pruned directed graphs."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import store

#: Vectors inserted, and queries searched, at once within a task.
BATCH = 256

INDEX = "shard long, vectors binary, graph binary, sizes array<int>, ids array<long>"
FOUND = "query_id long, vec_id long, score double"


# ----------------------------------------------------------- within a shard ---

def beam_search(unit: np.ndarray, graph: np.ndarray, queries: np.ndarray, width: int) -> np.ndarray:
    """Best-first search of every query along the graph's edges: the ``width``
    nearest nodes met, nearest first, -1 where fewer were.  A search ends when
    the best ``width`` nodes have all been expanded; it starts from the first
    ``width`` nodes at most, which are a random choice."""
    n, rows = len(unit), np.arange(len(queries))[:, None]
    entry = np.arange(min(n, width))
    ids = np.full((len(queries), width), -1)
    near = np.full((len(queries), width), -np.inf, dtype=unit.dtype)
    ids[:, :len(entry)], near[:, :len(entry)] = entry, queries @ unit[entry].T
    done = np.zeros(ids.shape, dtype=bool)
    seen = np.zeros((len(queries), n), dtype=bool)
    seen[:, entry] = True
    while True:
        waiting = np.where(done | (ids < 0), -np.inf, near)
        at = waiting.argmax(axis=1)
        live = np.flatnonzero(waiting[rows[:, 0], at] > -np.inf)
        if not len(live):
            break
        at = at[live]
        done[live, at] = True
        step = graph[ids[live, at]]
        fresh = (step >= 0) & ~seen[live[:, None], step]
        step = np.where(fresh, step, -1)
        r, c = np.nonzero(fresh)
        seen[live[r], step[r, c]] = True
        gain = np.matmul(unit[step], queries[live][:, :, None])[:, :, 0]
        gain[~fresh] = -np.inf
        pool = np.concatenate([near[live], gain], axis=1)
        keep = np.argpartition(-pool, width - 1, axis=1)[:, :width]
        line = np.arange(len(live))[:, None]
        near[live] = pool[line, keep]
        ids[live] = np.concatenate([ids[live], step], axis=1)[line, keep]
        done[live] = np.concatenate([done[live], np.zeros(step.shape, dtype=bool)], axis=1)[line, keep]
    order = np.argsort(-near, axis=1, kind="stable")
    return ids[rows, order]


def robust_prune(unit: np.ndarray, points: np.ndarray, others: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most ``degree`` diverse out-neighbours of each point among ``others``
    (-1: none): the nearest is taken, and every other that it is nearer to than
    the point is, by the factor ``relax``, is dropped; then the next."""
    others = np.sort(others, axis=1)
    valid = (others >= 0) & (others != points[:, None])
    valid[:, 1:] &= others[:, 1:] != others[:, :-1]
    x = unit[others]
    gap = 2 - 2 * np.matmul(x, unit[points][:, :, None])[:, :, 0]
    gap[~valid] = np.inf
    line = np.arange(len(points))
    order = np.argsort(gap, axis=1, kind="stable")
    others, gap, x = (a[line[:, None], order] for a in (others, gap, x))
    alive = np.isfinite(gap)
    between = relax ** 2 * np.maximum(2 - 2 * np.matmul(x, x.transpose(0, 2, 1)), 0)
    out = np.full((len(points), degree), -1, dtype=np.int32)
    for r in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, r] = others[line[some], first[some]]
        alive &= between[line, first] > gap
        alive[line, first] = False
    return out


def _link(unit, graph, points, degree, relax, width, built):
    """Give ``points`` their out-edges, found by searching the first ``built``
    nodes, and every target an edge back, pruned again where it has too many."""
    met = beam_search(unit[:built], graph[:built], unit[points], min(width, built))
    graph[points] = robust_prune(unit, points, np.concatenate([met, graph[points]], axis=1), degree, relax)
    source = np.repeat(points, degree)
    target = graph[points].ravel()
    order = np.argsort(target, kind="stable")
    source, target = source[order][target[order] >= 0], target[order][target[order] >= 0]
    start = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
    place = np.arange(len(target)) - np.repeat(start, np.diff(np.r_[start, len(target)]))
    for turn in range(int(place.max(initial=-1)) // degree + 1):
        mine = place // degree == turn
        nodes, row = np.unique(target[mine], return_inverse=True)
        back = np.full((len(nodes), degree), -1)
        back[row, place[mine] % degree] = source[mine]
        for s in range(0, len(nodes), BATCH):
            some = nodes[s: s + BATCH]
            both = np.concatenate([graph[some], back[s: s + BATCH]], axis=1)
            graph[some] = robust_prune(unit, some, both, degree, relax)


def build_graph(unit: np.ndarray, *, degree: int, width: int, relax: float) -> np.ndarray:
    """Out-edges (n x ``degree``, -1: none) of a graph over unit vectors, which
    come in random order.  Vectors are inserted in growing batches, then all
    edges are renewed once on the whole graph with the relaxed rule."""
    n = len(unit)
    graph = np.full((n, degree), -1, dtype=np.int32)
    first = min(n, BATCH)
    everyone = np.broadcast_to(np.arange(first), (first, first))
    graph[:first] = robust_prune(unit, np.arange(first), everyone, degree, relax)
    at = first
    while at < n:
        end = min(n, at + BATCH)
        _link(unit, graph, np.arange(at, end), degree, 1.0, width, at)
        at = end
    for s in range(0, n, BATCH):
        _link(unit, graph, np.arange(s, min(n, s + BATCH)), degree, relax, width, n)
    return graph


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which changes no cosine: no square of
    theirs overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def _cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of ``q`` with each row, the same for a pair wherever it is met."""
    x, q = _scaled(x), _scaled(q)
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


# ------------------------------------------------------------ Spark stages ---

def _index(degree, width, relax):
    def run(table: pa.Table) -> pa.Table:
        x = np.array(table["vector"].to_pylist(), dtype=np.float64)
        graph = build_graph(_unit(x), degree=degree, width=width, relax=relax)
        ids = table["ids"].to_pylist()
        return pa.table({"shard": table["shard"].slice(0, 1), "vectors": [x.tobytes()], "graph": [graph.tobytes()],
                         "sizes": pa.array([[len(i) for i in ids]], pa.list_(pa.int32())),
                         "ids": pa.array([[v for i in ids for v in i]], pa.list_(pa.int64()))})
    return run


def _search(k, width, dim, degree):
    """Rows of a shard come in order: its index, then the queries.  Queries of
    a shard that no vector fell to find nothing there."""
    def answer(index, queries):
        _, vectors, unit, graph, ids, edge = index
        q = np.array([v for _, v in queries], dtype=np.float64)
        met = beam_search(unit, graph, _unit(q), min(width, len(unit)))
        out = []
        for (own, _), nodes, vector in zip(queries, met, q):
            best: dict[int, float] = {}
            nodes = nodes[nodes >= 0]
            for node, score in zip(nodes, _cosines(vectors[nodes], vector).tolist()):
                for i in ids[edge[node]: edge[node + 1]]:
                    if i != own and score > best.get(i, -2.0):
                        best[i] = score
            out += [(own, i, s) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.float64())], names=["query_id", "vec_id", "score"])

    def run(batches):
        index, queries = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["vectors"] is None:
                    if index is None or row["shard"] != index[0]:
                        continue
                    queries.append((row["query_id"], row["vector"]))
                    if len(queries) == BATCH:
                        yield answer(index, queries)
                        queries = []
                    continue
                if queries:
                    yield answer(index, queries)
                    queries = []
                x = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, dim)
                graph = np.frombuffer(row["graph"], dtype=np.int32).reshape(-1, degree)
                index = row["shard"], x, _unit(x), graph, row["ids"], np.r_[0, np.cumsum(row["sizes"])]
        if queries:
            yield answer(index, queries)
    return run


def graph_index(vectors: DataFrame, *, keep: int, degree: int = 32, width: int = 64, relax: float = 1.2,
                shard_bytes: int = 1 << 22) -> list[tuple[int, int, DataFrame]]:
    """``(dim, shards, index)`` for each length of ``vectors`` (vec_id, vector).

    Equal vectors are one node, with its ``keep`` smallest ids.  Nodes are dealt
    to shards at random, of ``shard_bytes`` at most on average (smaller ones, of
    1,000 nodes at least, while the session has more shuffle partitions than
    shards); a shard's graph is built in one task, its index is one row."""
    spark = vectors.sparkSession
    ids = vectors.groupBy("vector", "vec_id").agg(F.lit(1).alias("one"))
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = store(ids.withColumn("place", smallest).where(F.col("place") <= keep)
                  .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                  .withColumn("dim", F.size("vector")), 5000)
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = []
    for dim, count in sorted(tuple(r) for r in nodes.groupBy("dim").count().collect()):
        shards = max(math.ceil(count * 8 * dim / shard_bytes), min(parallel, math.ceil(count / 1000)))
        own = nodes.where(F.col("dim") == dim).select(
            F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"), "vector", "ids")
        built = own.groupBy("shard").applyInArrow(_index(degree, width, relax), INDEX)
        out.append((dim, shards, store(built)))
    return out


def graph_search(vectors: DataFrame, is_query, *, k: int = 5, degree: int = 32, width: int = 64,
                 search_width: int = 96, relax: float = 1.2, shard_bytes: int = 1 << 22) -> DataFrame:
    """The ``k`` nearest other ids of each query: ``query_id, rank, vec_id, score``.

    ``vectors`` has ``vec_id, embedding``; ``is_query`` is a condition on its
    rows.  Nearness is the cosine in double precision; ties go to the smaller
    id.  Every vector is in one shard's graph (``graph_index``); a beam search
    of ``search_width`` runs on every shard for every query, its nodes are
    scored exactly, and the best over all shards are returned, all candidates
    where there are fewer than ``k`` (a shard of at most ``search_width`` nodes
    is searched whole).  Queries stream past a shard's index, so a task holds
    one shard and ``BATCH`` queries.

    Vectors that are null, empty, zero or hold a null or non-finite component
    take no part, as queries or candidates, nor do rows without an id; vectors
    of different lengths do not meet.  Repeated rows of an id are one item: of
    its vectors the nearest counts, and no query finds its own id.  An empty
    table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    fit = (F.col("vec_id").isNotNull() & (F.size(F.coalesce("vector", F.array())) > 0)
           & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
           & F.exists("vector", lambda x: x != 0))
    rows = rows.where(F.coalesce(fit, F.lit(False)))
    found = spark.createDataFrame([], FOUND)
    queries = rows.where("asks").select("vec_id", "vector").distinct()
    # A node keeps one id more than asked for, as a query's own may be among them.
    for dim, shards, index in graph_index(rows.select("vec_id", "vector"), keep=k + 1, degree=degree, width=width,
                                          relax=relax, shard_bytes=shard_bytes):
        asked = queries.where(F.size("vector") == dim).select(
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
            F.col("vec_id").alias("query_id"), "vector")
        both = index.unionByName(asked, allowMissingColumns=True)
        lined = both.repartition(shards, "shard").sortWithinPartitions("shard", F.col("vectors").isNull(), "query_id")
        found = found.union(lined.mapInArrow(_search(k, search_width, dim, degree), FOUND))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
