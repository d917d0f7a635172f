"""Near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import store
from tessera.llm.components import components

#: Added to every block budget, so rounding of 32-bit coordinates loses no pair.
SLACK = 1e-4
#: Rows and columns of a bound matrix, and pairs confirmed at once, within a task.
ROWS, COLUMNS, PAIRS = 256, 4096, 50_000
#: Axes of a block that enter a bound one by one; the others enter by their norm.
HEAD = 24


def fit_rotation(sample: np.ndarray, blocks: int) -> tuple[np.ndarray, list[slice], np.ndarray]:
    """Rotation, block slices and each block's share of the squared distance.

    The rotation is the sample's principal axes, dealt to the blocks in turn
    (forth and back), so blocks hold like parts of the variance and lead with
    their widest axis.
    """
    dim = sample.shape[1]
    blocks = min(blocks, dim)
    centred = sample - sample.mean(axis=0)
    value, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(dim))
    order = np.argsort(-value)
    deal: list[list[int]] = [[] for _ in range(blocks)]
    for i, axis in enumerate(order):
        turn, at = divmod(i, blocks)
        deal[at if turn % 2 == 0 else blocks - 1 - at].append(axis)
    edges = np.cumsum([0] + [len(d) for d in deal])
    share = np.array([max(value[d].sum(), 1e-9) for d in deal])
    return axes[:, sum(deal, [])], [slice(a, b) for a, b in zip(edges, edges[1:])], share / share.sum()


def fit_blocks(sample: np.ndarray, most: float, blocks: int, k: int) -> tuple:
    """Rotation, block slices, budgets, radii and the borders of ``k`` slices of
    each block's leading axis, for links of at most ``most`` (squared).  Of up
    to ``blocks`` blocks, as many as let a vector meet the fewest slices in all."""
    plans = []
    for n in sorted({min(n, blocks, sample.shape[1]) for n in (1, 2, 4, blocks)}):
        rotation, slices, share = fit_rotation(sample, n)
        budget = share * most
        radius = np.sqrt(budget + SLACK)
        lead = sample @ rotation
        bounds = [np.quantile(lead[:, c.start], np.arange(1, k) / k) if k > 1 else np.zeros(0) for c in slices]
        met = 0.0
        for c, r, edge in zip(slices, radius, bounds):
            low, high = (np.searchsorted(edge, lead[:, c.start] + x, side="right") for x in (-r, r))
            met += (high - low + 1).mean()
        plans.append((met, n, (rotation, slices, budget, radius, bounds)))
    return min(plans, key=lambda p: p[:2])[2]


def _reduced(part: np.ndarray) -> np.ndarray:
    """The leading axes of ``part`` and the norm of the others.  An inner product
    of two such rows is at least that of the whole rows (Cauchy-Schwarz), and
    the norms are the same, so their distance is at most the whole one."""
    if part.shape[1] <= HEAD + 1:
        return part
    return np.column_stack([part[:, :HEAD], np.linalg.norm(part[:, HEAD:], axis=1)])


def _close(part: np.ndarray, left: int, start: int, most: float):
    """Index pairs i < j, some rows i at a time, of the first ``left`` rows i and
    the rows j from ``start`` that may be within ``most`` (squared): one product per tile gives
    ``a.b - a.a/2 - b.b/2``, minus half the distance of the reduced rows."""
    part = _reduced(part)
    half = (part * part).sum(axis=1, keepdims=True) / -2
    one = np.ones_like(half)
    a = np.hstack([part, half, one]).astype(np.float32)
    b = np.ascontiguousarray(np.hstack([part, one, half]).astype(np.float32).T)
    limit = np.float32(-most / 2)
    for at in range(0, left, ROWS):
        found = []
        for to in range(max(start, at), b.shape[1], COLUMNS):
            tile = a[at: min(at + ROWS, left)] @ b[:, to: to + COLUMNS]
            i, j = np.divmod(np.flatnonzero(tile >= limit), tile.shape[1])
            found.append(np.stack([i + at, j + to]))
        if found:
            i, j = np.concatenate(found, axis=1)
            yield i[i < j], j[i < j]


def _roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes."""
    low = np.arange(n)
    while True:
        was = low.copy()
        if len(pairs):
            both = np.minimum(low[pairs[:, 0]], low[pairs[:, 1]])
            np.minimum.at(low, pairs[:, 0], both)
            np.minimum.at(low, pairs[:, 1], both)
        low = low[low]
        if (low == was).all():
            return low


def _emit(rotation, slices, bounds, radius):
    """Rows for the range join: each vector once for every pair of slices, of
    each block's leading axis, that it may have a partner in."""
    schema = pa.schema([("cell", pa.int64()), ("side", pa.int32()), ("id", pa.int64()),
                        ("copies", pa.int64()), ("vector", pa.binary())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            copies = batch.column(1).to_numpy(zero_copy_only=False)
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            raw = pa.array([r.tobytes() for r in x], pa.binary())
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            turned = unit @ rotation
            for b, cut in enumerate(slices):
                lead, edge = turned[:, cut.start], bounds[b]
                own = np.searchsorted(edge, lead, side="right")
                low = np.searchsorted(edge, lead - radius[b], side="right")
                high = np.searchsorted(edge, lead + radius[b], side="right")
                k = len(edge) + 1
                for other in range(k):
                    rows = np.flatnonzero((low <= other) & (other <= high))
                    if not len(rows):
                        continue
                    first, second = np.minimum(own[rows], other), np.maximum(own[rows], other)
                    yield pa.RecordBatch.from_arrays([
                        pa.array((b * k + first) * k + second, pa.int64()),
                        pa.array((own[rows] == second).astype(np.int32) * (first != second), pa.int32()),
                        pa.array(ids[rows], pa.int64()), pa.array(copies[rows], pa.int64()),
                        raw.take(pa.array(rows))], schema=schema)

    return run


def _join(rotation, slices, budget, threshold, per_block):
    """Links of one cell: candidates within the block's budget, confirmed by
    their cosine in double precision.  A link that several blocks find counts
    in the first of these."""
    def run(table: pa.Table) -> pa.Table:
        cell = table["cell"][0].as_py()
        block = cell // per_block
        ids, copies = table["id"].to_numpy(), table["copies"].to_numpy()
        x = np.frombuffer(b"".join(table["vector"].to_pylist()), dtype=np.float64).reshape(len(ids), -1)
        order = np.lexsort((ids, table["side"].to_numpy()))
        ids, copies, x = ids[order], copies[order], x[order]
        left = int((table["side"].to_numpy() == 0).sum())
        norm = np.linalg.norm(x, axis=1)
        turned = (x / norm[:, None]) @ rotation
        start = left if left < len(ids) else 0
        links, low = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        for i, j in _close(turned[:, slices[block]], left, start, budget[block] + SLACK):
            found = []
            for s in range(0, len(i), PAIRS):
                p, q = i[s: s + PAIRS], j[s: s + PAIRS]
                ok = (x[p] * x[q]).sum(axis=1) / (norm[p] * norm[q]) >= threshold
                p, q = p[ok], q[ok]
                gaps = np.stack([((turned[p, c] - turned[q, c]) ** 2).sum(axis=1) for c in slices], axis=1)
                mine = np.argmax(gaps <= budget[None, :] + SLACK / 4, axis=1) == block
                found.append(np.stack([p[mine], q[mine]], axis=1))
            pairs = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
            if len(pairs):
                np.add.at(links, pairs[:, 0], copies[pairs[:, 1]])
                np.add.at(links, pairs[:, 1], copies[pairs[:, 0]])
                forest = np.stack([np.arange(len(ids)), low], axis=1)
                low = _roots(len(ids), np.concatenate([forest, pairs]))
        has = np.flatnonzero(links)
        return pa.table({"id": ids[has], "links": links[has], "low": ids[low[has]]})

    return run


def embedding_dedup(vectors: DataFrame, *, threshold: float = 0.9, blocks: int = 4,
                    slice_rows: int = 8192, sample_rows: int = 8192, seed: int = 11) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors are linked when their cosine, in double precision, is at least
    ``threshold``.  Unit vectors are rotated and split into ``blocks``; linked
    ones are no further apart than 2 - 2 * threshold (squared), so in at least
    one block they are within that block's share of it.  Each block is joined
    by range over slices of its leading axis, and a pair found is confirmed on
    the whole vectors.  The rotation, the slice borders and the number of blocks
    (``blocks``, or fewer where a vector then meets fewer slices in all) are
    fitted on ``sample_rows`` vectors; they decide the work, never the result.
    Within a cell a bound of few axes is computed for all pairs.

    Equal vectors are one class and are counted, not paired.  A task joins two
    slices of about ``slice_rows`` vectors, so its memory does not grow with
    the table.  It passes on, for each vector, a count and one link of a
    spanning forest, not its pairs.  Where a rotation finds no narrow axes
    (vectors spread evenly in all directions) all slices meet: one block is
    used, and the bounds grow with the square of the table.

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, nor do vectors of different lengths.  Repeated rows of
    an id are rows of their own; a null id links with nothing, has component
    null and is kept.  An empty table gives an empty result; other columns are
    ignored.
    """
    spark = vectors.sparkSession
    base = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    usable = (F.col("vec_id").isNotNull() & (F.size(F.coalesce("vector", F.array())) > 0)
              & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
              & F.exists("vector", lambda x: x != 0))
    base = base.withColumn("good", F.coalesce(usable, F.lit(False)))
    good = base.where("good")
    classes = store(good.groupBy("vector").agg(F.min("vec_id").cast("long").alias("id"), F.count("*").alias("copies"))
                    .withColumn("dim", F.size("vector")))
    parts = []
    for dim, count in sorted(tuple(r) for r in classes.groupBy("dim").count().collect()):
        own = classes.where(F.col("dim") == dim)
        picked = own.orderBy(F.xxhash64(F.lit(seed), "id")).limit(sample_rows).select("vector").collect()
        sample = np.array([r.vector for r in picked], dtype=np.float64)
        sample = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        k = math.ceil(count / slice_rows)
        rotation, slices, budget, radius, bounds = fit_blocks(sample, 2 - 2 * threshold, blocks, k)
        cells = own.select("id", "copies", "vector").mapInArrow(
            _emit(rotation, slices, bounds, radius),
            "cell long, side int, id long, copies long, vector binary")
        parts.append(cells.groupBy("cell").applyInArrow(
            _join(rotation, slices, budget, threshold, k * k), "id long, links long, low long"))
    if not parts:
        found = spark.createDataFrame([], "id long, links long, low long")
    else:
        found = parts[0]
        for p in parts[1:]:
            found = found.union(p)
    found = store(found, 5000)
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    label = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    member = (classes.join(counts, "id", "left")
              .join(label.withColumnRenamed("node", "id"), "id", "left")
              .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
                      F.coalesce("component", "id").alias("component")))
    linked = good.select("vec_id", "vector").join(member, "vector").select(
        "vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    rest = base.where("not good").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
