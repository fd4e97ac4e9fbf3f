"""Which 64-bit keys do two or more nodes have? Keys cross the shuffle in sorted, delta-coded runs.

A run holds the keys of many nodes of one task, so a key shared by a third of all rows arrives once a task and
node, never as pairs. A task works on one bucket at a time; buckets follow the session's shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from returnsmith.llm.text import mix

RUN_KEYS = 2_000_000


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def planes(values: np.ndarray) -> bytes:
    """64-bit values as eight compressed byte planes: small values and small differences cost what they hold."""
    raw = np.ascontiguousarray(values.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def from_planes(body: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view(np.uint64).ravel()


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(body: bytes) -> np.ndarray:
    return np.cumsum(from_planes(body), dtype=np.uint64)


def bucket_edges(n: int) -> np.ndarray:
    """The first key of each of n equal ranges of keys."""
    return np.array([(i << 64) // n for i in range(n)], dtype=np.uint64)


Emit = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]]


def shared_keys(df: DataFrame, emit: Emit, groups: bool = False) -> DataFrame:
    """(key, node) of every key that at least two nodes have, each pair once.

    ``emit`` turns a task's batches into arrays (keys, nodes), both uint64. Naming a key twice for a node says
    no more than once, so copies may be emitted by several tasks. With ``groups`` a key stands for its set of nodes: keys
    that the same nodes share become one.
    """
    n = shuffle_partitions(df.sparkSession)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        edges = bucket_edges(n)

        def flush() -> pa.RecordBatch:
            keys, nodes = np.concatenate([k for k, _ in held]), np.concatenate([v for _, v in held])
            order = np.lexsort((nodes, keys))
            keys, nodes = keys[order], nodes[order]
            names, index = np.unique(nodes, return_inverse=True)
            cut = np.append(np.searchsorted(keys, edges), len(keys))
            filled = np.flatnonzero(np.diff(cut))
            out = {"bucket": [], "keys": [], "names": [], "nodes": []}
            for b in filled:
                part = slice(cut[b], cut[b + 1])
                own, where = np.unique(index[part], return_inverse=True)
                out["bucket"].append(int(b))
                out["keys"].append(pack(keys[part]))
                out["names"].append(planes(names[own]))
                out["nodes"].append(planes(where))
            return pa.RecordBatch.from_arrays(
                [pa.array(out["bucket"], pa.int32()), *(pa.array(out[c], pa.binary()) for c in ("keys", "names", "nodes"))],
                names=list(out))

        for keys, nodes in emit(batches):
            if len(keys):
                held.append((keys, nodes))
                size += len(keys)
            if size >= RUN_KEYS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def meet(rows: list[tuple]) -> pa.RecordBatch:
        keys = np.concatenate([unpack(k) for k, _, _ in rows])
        nodes = np.concatenate([from_planes(names)[from_planes(at).astype(np.int64)] for _, names, at in rows])
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        once = np.ones(len(keys), bool)
        once[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[once], nodes[once]
        same = keys[1:] == keys[:-1]
        keep = np.zeros(len(keys), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keys, nodes = keys[keep], nodes[keep]
        if groups and len(keys):
            first = np.append(True, keys[1:] != keys[:-1])
            code = mix(np.add.reduceat(mix(nodes, 41), np.flatnonzero(first)), 42)
            pairs = np.unique(np.stack([code[np.cumsum(first) - 1], nodes]), axis=1)
            keys, nodes = pairs[0], pairs[1]
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(nodes.view(np.int64))],
                                          names=["key", "node"])

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "keys", "names", "nodes")]
            for bucket, *row in zip(*columns, strict=True):
                if bucket != now and rows:
                    yield meet(rows)
                    rows = []
                now = bucket
                rows.append(row)
        if rows:
            yield meet(rows)

    found = (df.mapInArrow(runs, "bucket int, keys binary, names binary, nodes binary")
             .repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(by_bucket, "key bigint, node bigint"))
    return found.distinct() if groups else found


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Batches sorted by a column, joined so that no value of it is cut in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(values, values[-1]))  # the last group may go on
        if cut == 0 and held and held[-1].column(column)[-1].as_py() == values[-1]:
            held.append(batch)
            continue
        if held or cut:
            yield pa.Table.from_batches([*held, *([batch.slice(0, cut)] if cut else [])])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
