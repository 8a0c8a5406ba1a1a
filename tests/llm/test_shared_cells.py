"""Shared cells of a shard: the right rows, in memory that stays near the packed form."""

import tracemalloc

import numpy as np
import pyarrow as pa

from martkit.llm.jaccard_join import _shared

NODES, EACH = 4096, 256


def _blobs(names: np.ndarray) -> list[pa.RecordBatch]:
    """Two shards of NODES sets with EACH cells."""
    node = np.arange(NODES, dtype=np.uint64).tobytes()
    count, cls = np.full(NODES, EACH, np.uint32).tobytes(), np.full(NODES, 7, np.uint16).tobytes()
    return [pa.RecordBatch.from_arrays(
        [pa.array([s], pa.int32()), *(pa.array([x], pa.binary()) for x in (node, count, cls, cells.tobytes()))],
        names=["shard", "node", "count", "cls", "cell"]) for s, cells in enumerate(names)]


def test_rows_and_memory_of_shared_cells():
    names = np.random.default_rng(5).integers(0, 1 << 32, (2, NODES * EACH), dtype=np.uint32)
    names[:, 5] = names[:, 5000]
    names[0, :2] = 0          # twice in one set, and its own shard's only one
    names[1, 300:302] = 2**32 - 1  # the same cell twice in a set
    names[1, 900] = 2**32 - 1
    batches = _blobs(names)
    tracemalloc.start()
    out = pa.Table.from_batches(list(_shared(iter(batches))))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    owner = np.arange(NODES * EACH) // EACH
    want = set()
    for s in (0, 1):
        name, code, n = np.unique(names[s], return_inverse=True, return_counts=True)
        at = np.flatnonzero(n[code] > 1)
        sets: dict[int, set] = {}
        for x, o in zip(names[s, at].tolist(), owner[at].tolist(), strict=True):
            sets.setdefault(x, set()).add(o)
        want |= {(x | s << 32, o, 7) for x, own in sets.items() if len(own) > 1 for o in own}
    got = list(zip(*(c.to_pylist() for c in out.columns), strict=True))
    assert len(got) == len(set(got)) and set(got) == want
    assert (1 << 33) - 1 in out.column("cell").to_pylist() and 0 not in out.column("cell").to_pylist()
    assert peak < 40 * names.size
