"""A shard that is one dense group: every link counted, whichever of the two finds it."""

import numpy as np
import pyarrow as pa

from opslens.llm import neargraph


def test_dense_shard_counts_every_link():
    rng = np.random.default_rng(3)
    n = 700
    x = rng.normal(size=64) + 0.2 * rng.normal(size=(n, 64))
    x[600:] = rng.normal(size=(100, 64))
    rows = pa.table({
        "shard": pa.array(np.zeros(n, np.int64)), "shards": neargraph.rows_of(np.zeros((n, 1), np.int32), pa.int32()),
        "vec_id": pa.array(np.arange(n)), "copies": pa.array(np.ones(n, np.int64)), "v": neargraph.rows_of(x, pa.float64())})
    rows = rows.append_column("near", neargraph._build(rows).column("near"))
    found = neargraph._walk(0.9)(rows).to_pandas().dropna(subset=["vec_id"])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = np.zeros(n, np.int64)
    links[found.vec_id.astype(int)] = found.links
    assert links.tolist() == ((u @ u.T >= 0.9).sum(1) - 1).tolist()


def test_shards_keep_their_size_whatever_the_overlap():
    for total in (3_000, 50_000, 1_000_000):
        for overlap in neargraph.OVERLAPS:
            assert overlap * total / neargraph.centres_for(overlap, total, 1500) <= 1500
    assert neargraph.centres_for(12, 1500, 1500) == 1
