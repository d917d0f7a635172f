"""Work of the vector join: how often a vector is sent, and what its bounds keep."""
import numpy as np
import pyarrow as pa

from tessera.llm import embedding_dedup as vectors


def unit(rng, n, dim):
    x = rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def sent(x, k, blocks=4):
    """How many rows the range join makes of ``x``, with its plan."""
    plan = vectors.fit_blocks(x, 0.2, blocks, k)
    rotation, slices, budget, radius, bounds = plan
    batch = pa.record_batch([pa.array(range(len(x))), pa.array([1] * len(x)), pa.array(x.tolist())],
                            names=["id", "copies", "vector"])
    rows = sum(b.num_rows for b in vectors._emit(rotation, slices, bounds, radius)([batch]))
    return rows, plan


def test_spread_vectors_meet_each_slice_once():
    """Blocks that leave out no slices would only repeat the work."""
    rows, plan = sent(unit(np.random.default_rng(1), 2000, 64), 7)
    assert len(plan[1]) == 1 and rows <= 7 * 2000


def test_narrow_blocks_are_used_where_they_leave_out_slices():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(2000, 4)), 0.01 * rng.normal(size=(2000, 60))], axis=1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows, _ = sent(x, 64)
    assert rows < 64 * 2000


def test_bounds_lose_no_pair():
    rng = np.random.default_rng(3)
    for dim in (3, 25, 26, 64):
        base = unit(rng, 300, dim)
        x = np.concatenate([base, base + 0.4 / np.sqrt(dim) * rng.normal(size=base.shape)])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        gap = ((x[:, None] - x[None]) ** 2).sum(axis=2)
        for left, start in ((600, 0), (350, 350)):
            want = {(i, j) for i, j in zip(*np.nonzero(gap <= 0.2)) if i < j and i < left and j >= start}
            got = [p for i, j in vectors._close(x, left, start, 0.2 + vectors.SLACK) for p in zip(i, j)]
            assert want <= set(got) and len(got) == len(set(got)) and all(i < j for i, j in got)
