"""Removal of byte strings of 100 or more that occur earlier in the corpus, by column-wise suffix sorting.

1. Equal texts are one text; later ones are all repeat.
2. Every 100-byte window is named after the smallest hash among its 32-byte strings (leftmost of equals), so equal windows
   have equal names at equal places. Neighbouring windows named after one place form a read. Names that only one text has,
   once, are dropped: they can't repeat. Reads of a name go to one task; equal reads of a map task go as one.
3. In a task, the reads of a block are aligned at the naming place and sorted as a collection, one column a round, from
   the right: a round inserts one symbol of every read before its suffix, sorts the collection's order by the new column
   (the stretch of the Burrows-Wheeler transform that the round adds), and updates the common prefixes of neighbours
   by range minima over the former ones, up to 100. Runs of neighbours with a common prefix of 100 are equal
   windows; all but the first by document and place are repeats.

The construction keeps its order and prefixes in memory for one block; the external files are Spark's sorted shuffle
partitions, read once in sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.keyed import shared_keys, shuffle_partitions, whole_groups
from returnsmith.llm.text import Hasher, doc_ids, mix, raw_bytes
from returnsmith.session import settle

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1  # places of a gram in a window
#: A longer text is worked on in segments that overlap by LENGTH - 1 bytes.
SEGMENT = 1 << 20
RUN_READS = 300_000
BLOCK_READS = 1 << 16
ABSENT = 0xFF  # no byte of UTF-8
_PLACE_BITS = 24
#: 56 bits name a window; equal windows are told by their bytes.
KEY_BITS = np.uint64(0xFFFFFFFFFFFFFF00)


def _segments(texts: pa.Array) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]], np.ndarray]]:
    """Blocks of about SEGMENT bytes: bytes, (row, offset in the text, offset in the block) of segments, segment ends."""
    data, offsets = raw_bytes(texts)
    parts, total = [], 0

    def block():
        joined = np.concatenate([data[a:b] for _, _, a, b in parts])
        ends = np.cumsum([b - a for _, _, a, b in parts])
        begins = ends - [b - a for _, _, a, b in parts]
        return joined, [(row, base, int(at)) for (row, base, _, _), at in zip(parts, begins, strict=True)], ends

    for row in range(len(offsets) - 1):
        low, high = int(offsets[row]), int(offsets[row + 1])
        for base in range(0, max(0, high - low - LENGTH + 1), SEGMENT):
            a, b = low + base, min(high, low + base + SEGMENT + LENGTH - 1)
            if parts and total + b - a > SEGMENT + LENGTH:
                yield block()
                parts, total = [], 0
            parts.append((row, base, a, b))
            total += b - a
    if parts:
        yield block()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[:len(x)] = x
    grid = full.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _reads(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, place, first window, last window, segment) of the reads of a block, and the block's hasher."""
    hasher = Hasher(data, 1)
    place = np.arange(len(data) - GRAM + 1)
    grams = hasher.of(place, place + GRAM)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    best = _sliding_min((grams & ~low) | place.astype(np.uint64), SPAN)
    at = (best & low).astype(np.int64)
    start = np.arange(len(best))
    segment = np.searchsorted(ends, start, "right")
    inside = start + LENGTH <= ends[segment]
    new = np.append(True, (at[1:] != at[:-1]) | (segment[1:] != segment[:-1]) | ~inside[:-1])
    first = np.flatnonzero(new & inside)
    bounds = np.append(np.flatnonzero(new | ~inside), len(start))
    last = bounds[np.searchsorted(bounds, first, "right")] - 1
    return grams[at[first]] & KEY_BITS, at[first], first, last, segment[first], hasher


def _emit(batches):
    seen = set()
    for batch in batches:
        h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
        new = [i for i, name in enumerate(zip(h1.tolist(), h2.tolist(), strict=True)) if name not in seen and not seen.add(name)]
        names = h1[new].view(np.uint64)
        for data, parts, ends in _segments(batch.column("text").take(pa.array(new, pa.int64()))):
            key, _, _, _, segment, _ = _reads(data, ends)
            rows, later = (np.array([p[j] for p in parts]) for j in (0, 1))
            node = names[rows[segment]]
            # a key that a text may hold twice counts as held by two nodes
            order = np.lexsort((node, key))
            again = np.zeros(len(key), bool)
            again[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (node[order[1:]] == node[order[:-1]])
            again |= later[segment] > 0
            yield np.concatenate([key, key[again]]), np.concatenate([node, mix(node[again], 11)])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads with a shared key: (key, doc, place, left, content); equal reads of a run only once, the others as removed
    stretches (content null, place and left as start and end)."""
    held: list[tuple] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        key, code, doc, place, left, length = (np.concatenate([h[j] for h in held]) for j in range(6))
        which = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
        at = np.concatenate([h[6] for h in held])
        order = np.lexsort((place, doc, length, code, key))
        same = np.zeros(len(order), bool)
        a, b = order[:-1], order[1:]
        same[1:] = (key[a] == key[b]) & (code[a] == code[b]) & (length[a] == length[b])
        keep, gone = np.sort(order[~same]), order[same]
        content = [held[which[i]][7][at[i]:at[i] + length[i]].tobytes() for i in keep]
        yield pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(doc[keep]), pa.array(place[keep]),
                                          pa.array(left[keep]), pa.array(content, pa.binary())], names=NAMES)
        start = place[gone] - left[gone]
        yield pa.RecordBatch.from_arrays([pa.array(key[gone].view(np.int64)), pa.array(doc[gone]), pa.array(start),
                                          pa.array(start + length[gone]), pa.nulls(len(gone), pa.binary())], names=NAMES)

    for batch in batches:
        docs = doc_ids(batch.column("doc"))
        wanted = [np.sort(np.array(k or [], np.int64).view(np.uint64)) for k in batch.column("keys").to_pylist()]
        for data, parts, ends in _segments(batch.column("text")):
            key, place, first, last, segment, hasher = _reads(data, ends)
            rows, base, begin = (np.array([p[j] for p in parts]) for j in range(3))
            use = np.zeros(len(key), bool)
            cut = np.searchsorted(segment, np.arange(len(parts) + 1))
            for s in range(len(parts)):
                part, mine = slice(cut[s], cut[s + 1]), wanted[rows[s]]
                if len(mine):
                    found = np.searchsorted(mine, key[part])
                    use[part] = mine[np.minimum(found, len(mine) - 1)] == key[part]
            key, place, first, last, segment = (x[use] for x in (key, place, first, last, segment))
            if len(key):
                end = last + LENGTH
                shift = base[segment] - begin[segment]  # from the block to the text
                held.append((key, hasher.of(first, end), docs[rows[segment]], place + shift, place - first, end - first, first, data))
                size += len(key)
                if size >= RUN_READS:
                    yield from flush()
                    held, size = [], 0
    if size:
        yield from flush()


NAMES = ["key", "doc", "place", "left", "content"]


def repeats(matrix: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which windows of aligned reads repeat an earlier one: flags[column, read].

    ``matrix`` holds a read's bytes in a column of its own, ABSENT outside it; windows start in the first SPAN rows.
    ``rank`` orders the reads by document and place.
    """
    width, n = matrix.shape
    flags = np.zeros((SPAN, n), bool)
    order = np.arange(n)
    prefix = np.zeros(n, np.uint8)  # common prefix with the one before, up to LENGTH
    log2 = np.zeros(n + 1, np.int64)
    for i in range(1, int(n).bit_length()):
        log2[1 << i:] = i
    for column in range(width - 1, -1, -1):
        symbols = matrix[column][order]
        by = np.argsort(symbols, kind="stable")
        table = [prefix]
        for j in range(int(log2[max(1, n - 1)])):
            step = 1 << j
            table.append(np.minimum(table[-1][:-step], table[-1][step:]) if len(table[-1]) > step else table[-1])
        x, y = by[:-1], by[1:]
        same = (symbols[x] == symbols[y]) & (symbols[y] != ABSENT)
        fresh = np.zeros(n, np.uint8)
        at = np.flatnonzero(same)
        x, y = x[at], y[at]
        level = log2[y - x]
        for j in np.unique(level):
            own = level == j
            least = np.minimum(table[j][x[own] + 1], table[j][y[own] - (1 << int(j)) + 1])
            fresh[at[own] + 1] = np.minimum(least, LENGTH - 1) + 1
        order, prefix = order[by], fresh
        if column < SPAN:
            begins = np.flatnonzero(prefix < LENGTH)
            if len(begins) < n:
                ranked = rank[order]
                least = np.minimum.reduceat(ranked, begins)
                flags[column, order] = ranked > np.repeat(least, np.diff(np.append(begins, n)))
    return flags


def _aligned(left: np.ndarray, content: pa.Array) -> np.ndarray:
    body = np.frombuffer(content.buffers()[2], np.uint8)
    offsets = np.frombuffer(content.buffers()[1], np.int32 if content.type == pa.binary() else np.int64)[content.offset:content.offset + len(content) + 1]
    sizes = np.diff(offsets)
    shift = SPAN - 1 - left
    matrix = np.full((int((sizes + shift).max()), len(left)), ABSENT, np.uint8)
    row = np.repeat(np.arange(len(left)), sizes)
    matrix[np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1] - shift, sizes), row] = body[offsets[0]:offsets[-1]]
    return matrix


def _sorted_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed stretches (doc, start, end) of the reads of a partition, a block of whole keys at a time."""
    held, size = [], 0

    def work() -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held)
        gone = table.filter(table.column("content").is_null())
        yield from gone.select(["doc", "place", "left"]).rename_columns(["doc", "start", "end"]).to_batches()
        table = table.filter(table.column("content").is_valid())
        if table.num_rows < 2:
            return
        doc, place, left = (table.column(c).to_numpy() for c in ("doc", "place", "left"))
        rank = np.empty(len(doc), np.int64)
        rank[np.lexsort((place, doc))] = np.arange(len(doc))
        flags = repeats(_aligned(left, table.column("content").combine_chunks()), rank)
        edge = np.diff(np.pad(flags, ((1, 1), (0, 0))).astype(np.int8), axis=0)
        read, low = np.nonzero(edge.T == 1)
        _, high = np.nonzero(edge.T == -1)  # runs of a read in order, so both lists go together
        origin = place[read] - (SPAN - 1)
        yield pa.RecordBatch.from_arrays([pa.array(doc[read]), pa.array(origin + low), pa.array(origin + high - 1 + LENGTH)],
                                         names=["doc", "start", "end"])

    for table in whole_groups(batches, "key"):
        held.append(table)
        size += table.num_rows
        if size >= BLOCK_READS:
            yield from work()
            held, size = [], 0
    if held:
        yield from work()


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans, kept = [], []
        texts, first = batch.column("text"), batch.column("first").to_pylist()
        for text, is_first, found in zip(texts, first, batch.column("found").to_pylist(), strict=True):
            body = text.as_buffer().to_pybytes() if text.is_valid else b""
            if not is_first and len(body) >= LENGTH:
                runs = [[0, len(body)]]
            else:
                runs = []
                for s in sorted((x["start"], x["end"]) for x in found or []):
                    if runs and s[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s[1])
                    else:
                        runs.append(list(s))
            edges = [0, *(x for r in runs for x in r), len(body)]
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"start": a, "end": b} for a, b in runs])
        sizes = [text.as_buffer().size if text.is_valid else 0 for text in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(spans, kind),
                                          pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the maximal removed stretches of UTF-8 bytes, and what remains.

    A byte goes if a 100-byte string over it also starts earlier: in a smaller id, or further left in the same text.
    Strings are judged on the input and never cross texts; overlapping ones count. A null or empty text has no bytes. Rows
    with equal id and text are one document, and each gives its row; an id with several texts is one document per text, and texts under one id stand
    in no order, so neither is the other's repeat unless equal. A null id comes before all others. Other columns
    are not looked at. An empty table gives none.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2"))
    texts = settle(source.select("doc", "h1", "h2", F.octet_length("text").alias("size")).groupBy("h1", "h2").agg(
        F.min(F.coalesce("doc", F.lit(-(1 << 63)))).alias("doc"), F.max("size").alias("size")), "texts")
    shared = shared_keys(source.filter(F.octet_length("text") >= LENGTH).select("h1", "h2", "text"), _emit)
    keys = shared.join(texts.select("h1", "doc"), F.col("node") == F.col("h1")).groupBy("doc", "h1").agg(
        F.collect_list("key").alias("keys"))
    named = source.withColumn("doc", F.coalesce("doc", F.lit(-(1 << 63))))
    reads = named.select("doc", "h1", "text").join(keys, ["doc", "h1"]).select("doc", "text", "keys").mapInArrow(
        _cut, "key bigint, doc bigint, place bigint, left bigint, content binary")
    stretches = settle(reads.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
                       .mapInArrow(_sorted_blocks, "doc bigint, start bigint, end bigint"), "stretches")
    found = stretches.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    firsts = texts.select("h1", "h2", F.col("doc").alias("first_doc"))
    ranked = named.select("doc", "h1", "h2").distinct().join(firsts, ["h1", "h2"]).select(
        "doc", "h1", "h2", (F.col("doc") == F.col("first_doc")).alias("first"))
    ranked = ranked.join(found, "doc", "left")
    return (named.join(ranked, ["doc", "h1", "h2"]).select("doc", "text", "first", "found")
            .mapInArrow(_keep, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
            .withColumn("doc_id", F.nullif("doc_id", F.lit(-(1 << 63)))))
