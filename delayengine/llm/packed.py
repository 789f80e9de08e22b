"""Arrays as compressed blocks in rows (shard, kind, block), so that Spark can deal them out by shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard

BLOCKS = "shard int, kind int, block binary"
_HEAD = 256


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in four bytes where they fit."""
    return counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64)


def pack(columns: list[np.ndarray]) -> bytes:
    """Arrays of one length, compressed, with their types in front."""
    head = ",".join([str(len(columns[0])), *(c.dtype.str for c in columns)]).encode().ljust(_HEAD)
    return zstandard.compress(b"".join([head, *(c.tobytes() for c in columns)]), 1)


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(block)
    n, *kinds = raw[:_HEAD].decode().strip().split(",")
    n, at, out = int(n), _HEAD, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def blocks(kind: int, shard: np.ndarray, shards: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per shard that has entries; ``shard`` must be in order."""
    edges = np.searchsorted(shard, np.arange(shards + 1))
    used = np.flatnonzero(np.diff(edges))
    packed = [pack([c[edges[s]:edges[s + 1]] for c in columns]) for s in used]
    return pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(np.full(len(used), kind), pa.int32()), pa.array(packed, pa.binary())],
        ["shard", "kind", "block"],
    )
