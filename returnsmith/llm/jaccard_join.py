"""Near duplicates by a parity-sketch join: all pairs of shingle sets with a Jaccard similarity of 0.8 or more.

Sizes fall into bands whose bounds are a factor 1 / 0.8 apart, so that two similar sets lie in one band or in
neighbours; a set takes part in its own band and the next. In a band, at most ``d`` shingles differ. Every shingle
is dealt by its hash to one of K > d segments of a sketch and XORed into it; each shingle changes one segment, so the
number of differing segments is a lower bound of the symmetric difference, and at least K - d segments agree. A set
may therefore leave out its K - d - 1 sparsest segments (empty ones among them) and still share one with every
similar set: the pigeonhole join is on (band, segment, XOR of the segment's 64-bit hashes). Pairs are then
pruned by a bit sketch (each shingle flips one bit, so its Hamming distance is a lower bound too), and verified
on the whole sets.

Equal sets are one node. Nodes that share a segment are first compared with one of them only (a star); most groups of
near copies collapse into one component by that. What is still apart in a shared segment is compared in full, so
no link between different components is lost, and no group is ever expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.components import components
from returnsmith.llm.keyed import shared_keys, shuffle_partitions, whole_groups
from returnsmith.llm.text import BASE, SHINGLE, SPACED, blocks, doc_ids, mix, per_row, shingles, words
from returnsmith.session import settle

#: A similarity of NUM / DEN or more links two documents.
NUM, DEN = 4, 5
STAR_ROUNDS = 2
#: 56 bits of a segment's key are enough to find candidates, and an eighth less to shuffle.
KEY_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
#: The ids of nodes whose sets are needed are broadcast to the texts up to so many (8 bytes each), else joined by a shuffle.
BROADCAST_NODES = 1_000_000


def _band(n: int) -> tuple[int, int]:
    """(number, upper bound) of the size band of a set of n shingles."""
    i, low = 0, 1
    while True:
        high = low * DEN // NUM
        if n <= high:
            return i, high
        i, low = i + 1, high + 1


def _segments(high: int) -> int:
    """Segments for a band: one more than can differ, plus slack for leaving out sparse ones."""
    return _differ(high, high) + 1 + high * 2 // 25 + 3


def _joined(high: int) -> int:
    """In bands of short sets, segments are few and often empty: so many of them make one key."""
    return 3 if high <= 20 else 2 if high <= 60 else 1


def _differ(a: int, b: int) -> int:
    """The largest symmetric difference of similar sets of these sizes: (1 - t) / (1 + t) of their sum."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


class _Bands:
    def __init__(self):
        self.known: dict[int, tuple] = {}

    def of(self, n: int) -> list[tuple[int, int]]:
        """(band, upper bound) of the bands that a set of n shingles takes part in."""
        if n not in self.known:
            i, high = _band(n)
            self.known[n] = [(i, high), (i + 1, (high + 1) * DEN // NUM)]
        return self.known[n]


def _segment_keys(s: np.ndarray, bands: list[tuple[int, int]]) -> np.ndarray:
    out = []
    for band, high in bands:
        together = _joined(high)
        k = _segments(high) if together == 1 else _differ(high, high) + together
        at = ((s >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.uint16 if k < 1 << 16 else np.int64)
        sizes = np.bincount(at, minlength=k)
        filled = np.flatnonzero(sizes)
        sketch = np.zeros(k, np.uint64)
        sketch[filled] = np.bitwise_xor.reduceat(s[np.argsort(at, kind="stable")], (np.cumsum(sizes) - sizes)[filled])
        if together > 1:  # at least ``together`` segments agree: one key for each choice of so many
            chosen = np.array(list(combinations(range(k), together)), np.uint64)
            key = np.full(len(chosen), (band << 32) + together, np.uint64)
            for c in chosen.T:
                key = mix(key + mix(sketch[c.astype(np.int64)] + mix(c, 9), 3), 4)
            out.append(key)
            continue
        spare = k - _differ(high, high) - 1
        least = np.sort(sizes)[spare]  # segments with fewer shingles are at most ``spare``
        kept = np.flatnonzero(sizes >= least)
        out.append(mix(sketch[kept] * np.uint64(BASE) + (kept + (band << 32)).astype(np.uint64), 4))
    return np.concatenate(out) & KEY_BITS


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    return int(s.sum(dtype=np.uint64)), int((s * s).sum(dtype=np.uint64))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Blocks with the sorted distinct shingles of every row."""
    for block in blocks(batches):
        rows, _, hashes = shingles(words(block.column("text"), SPACED), SHINGLE)
        yield block, [_distinct(s) for s in per_row(rows, hashes, block.num_rows)]


def _distinct(s: np.ndarray) -> np.ndarray:
    s = np.sort(s)
    return s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def _as_long(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def profiles(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, fp, fp2, bits): size, 128-bit fingerprint and bit sketch of each document's shingle set."""
    def profile(batches):
        for block, sets in _sets(batches):
            prints = [_fingerprint(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 _as_long([p[0] for p in prints]), _as_long([p[1] for p in prints]),
                 pa.array([_bits(s, _sketch_words(len(s))).tobytes() for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "fp", "fp2", "bits"])

    return docs.select(F.col(id_column).cast("bigint").alias("doc_id"), "text").mapInArrow(
        profile, "doc_id bigint, n_shingles bigint, fp bigint, fp2 bigint, bits binary")


def _emit(batches):
    bands, seen = _Bands(), set()
    for _, sets in _sets(batches):
        keys, nodes = [], []
        for s in sets:
            if len(s) and (name := _fingerprint(s)) not in seen:  # copies within a task once
                seen.add(name)
                own = _segment_keys(s, bands.of(len(s)))
                keys.append(own)
                nodes.append(np.full(len(own), name[0], np.uint64))
        if keys:
            yield np.concatenate(keys), np.concatenate(nodes)


def _bits(s: np.ndarray, words64: int) -> np.ndarray:
    """A parity sketch of 64 * words64 bits."""
    at = ((s & np.uint64(0xFFFFFFFF)) * np.uint64(words64 * 64) >> np.uint64(32)).astype(np.int64)
    odd = np.bincount(at, minlength=words64 * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


#: A sketch's length in 64-bit words, by size: a power of two, so that the longer of two folds onto the shorter.
def _sketch_words(n: int) -> int:
    return 1 << max(2, int(np.ceil(np.log2(max(1, 3 * n) / 64))))


def _fold(bits: np.ndarray, to: int) -> np.ndarray:
    """Shorten by halves: neighbours of a position are its two children, so parities add up."""
    while bits.shape[-1] > to:
        raw = np.unpackbits(bits.view(np.uint8), axis=-1)
        bits = np.packbits(raw[..., ::2] ^ raw[..., 1::2], axis=-1).view(np.uint64)
    return bits


def set_table(docs: DataFrame) -> DataFrame:
    """(node, shingles) of documents (node, text); rows with equal node and set once."""
    def build(batches):
        seen = set()
        for block, sets in _sets(batches):
            names = list(zip(block.column("node").to_pylist(), (_fingerprint(s) for s in sets), strict=True))
            new = [i for i, name in enumerate(names) if name not in seen and not seen.add(name)]
            yield pa.RecordBatch.from_arrays(
                [block.column("node").take(pa.array(new, pa.int64())), _as_long([names[i][1][0] for i in new]),
                 pa.array([sets[i].tobytes() for i in new], pa.binary())], names=["node", "fp", "shingles"])

    return (docs.mapInArrow(build, "node bigint, fp bigint, shingles binary")
            .dropDuplicates(["node", "fp"]).drop("fp"))


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    if NUM * max(len(a), len(b)) > DEN * min(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sizes and bit sketches leave room for the similarity."""
    def prune(batches):
        for batch in batches:
            n, m = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            at = np.arange(len(n))
            apart = _Sketches(pa.concat_arrays([batch.column("ba"), batch.column("bb")])).distance(at, at + len(n))
            near = (np.maximum(n, m) * NUM <= np.minimum(n, m) * DEN) & (apart <= (n + m) * (DEN - NUM) // (DEN + NUM))
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return (pairs.join(bits.toDF("a", "na", "ba"), "a").join(bits.toDF("b", "nb", "bb"), "b")
            .select("a", "b", "na", "nb", "ba", "bb").mapInArrow(prune, "a bigint, b bigint").distinct())


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are similar on their whole sets."""
    def check(batches):
        for batch in batches:
            x, y = batch.column("sa"), batch.column("sb")
            keep = [_similar(np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64))
                    for p, q in zip(x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return (pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
            .mapInArrow(check, "a bigint, b bigint"))


def _stars(members: DataFrame, highest: bool) -> DataFrame:
    """Every node with the lowest (or highest) node of each shared segment that is not yet in its component."""
    pick = F.max if highest else F.min
    hubs = (members.groupBy("key").agg(pick("node").alias("hub"), F.min("label").alias("l1"), F.max("label").alias("l2"))
            .filter("l1 <> l2").select("key", "hub"))
    hub_labels = members.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")).distinct()
    return (members.join(hubs, "key").select("hub", "node", "label").filter("hub <> node").distinct()
            .join(hub_labels, "hub").filter("label <> hub_label")
            .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())


def _apart(members: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs of different components in a shared segment that the bit sketches can't rule out.

    Pairs are looked at as arrays, a distance in the segment's list at a time; a row goes out only for a pair that is
    all but certainly a link.
    """
    def compare(batches):
        for table in whole_groups(batches, "key"):
            key, node, label, n = (table.column(c).to_numpy() for c in ("key", "node", "label", "n"))
            bits = _Sketches(table.column("bits").combine_chunks())
            low, at = np.zeros((2, 0), np.int64), np.arange(len(key))
            for distance in range(1, len(key)):
                at = at[at + distance < len(key)]
                at = at[key[at] == key[at + distance]]
                if not len(at):
                    break
                j = at + distance
                far = (label[at] != label[j]) & (np.maximum(n[at], n[j]) * NUM <= np.minimum(n[at], n[j]) * DEN)
                i, j = at[far], j[far]
                near = bits.distance(i, j) <= (n[i] + n[j]) * (DEN - NUM) // (DEN + NUM)
                ends = np.stack([node[i[near]], node[j[near]]])
                low = np.concatenate([low, np.sort(ends, axis=0)], axis=1)
                if low.shape[1] > 100_000:
                    low = np.unique(low, axis=1)
            low = np.unique(low, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(low[0]), pa.array(low[1])], names=["a", "b"])

    open_keys = members.groupBy("key").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).filter("l1 <> l2")
    return (members.join(open_keys.select("key"), "key").join(bits, "node")
            .repartition(shuffle_partitions(members.sparkSession), "key").sortWithinPartitions("key")
            .mapInArrow(compare, "a bigint, b bigint").distinct())


class _Sketches:
    """Bit sketches of several lengths; the longer of two is folded onto the shorter."""

    def __init__(self, column: pa.Array):
        self.raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in column]
        self.width = np.array([len(x) for x in self.raw], np.int64)
        self.folded: dict[int, np.ndarray] = {}
        self.row: dict[int, np.ndarray] = {}

    def _to(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        if width not in self.folded:
            rows = np.flatnonzero(self.width >= width)
            out = np.zeros((len(rows), width), np.uint64)
            for w in np.unique(self.width[rows]):
                own = np.flatnonzero(self.width[rows] == w)
                out[own] = _fold(np.stack([self.raw[r] for r in rows[own]]), width)
            self.folded[width] = out
            self.row[width] = np.zeros(len(self.raw), np.int64)
            self.row[width][rows] = np.arange(len(rows))
        return self.folded[width], self.row[width]

    def distance(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        width = np.minimum(self.width[i], self.width[j])
        for w in np.unique(width):
            bits, row = self._to(int(w))
            own = np.flatnonzero(width == w)
            for part in np.array_split(own, 1 + len(own) * int(w) // 4_000_000):
                out[part] = np.bitwise_count(bits[row[i[part]]] ^ bits[row[j[part]]]).sum(axis=1)
        return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Words are runs of other bytes than ASCII white space after lowering A-Z, over the whole text; a set holds the
    distinct runs of five words, or the whole sequence if shorter. Two rows link when their sets' Jaccard
    similarity is 0.8 or more; ``component_id`` is the smallest id that links reach. A null or empty text has no
    shingles, links with nothing and is its own component; repeated rows stay, each with the same result. A row with a null id
    belongs to the component of the rows whose set equals its own; where no row with an id has that set, it links with nothing
    and its component is null. Texts under one id are one node. Other columns are not looked at. An empty table gives none.
    """
    profile = settle(profiles(docs, id_column), "profile")
    nodes = settle(profile.filter("n_shingles > 0").groupBy("n_shingles", "fp", "fp2").agg(
        F.min("doc_id").alias("node"), F.min("bits").alias("bits")), "nodes")  # equal sets have equal sketches
    bits = nodes.filter("node is not null").select("node", F.col("n_shingles").alias("n"), "bits")
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), "text")
    shared = settle(shared_keys(source, _emit, groups=True).join(nodes.select("fp", F.col("node").alias("id")),
                                                                 F.col("node") == F.col("fp"))
                    .select("key", F.col("id").alias("node")).filter("node is not null"), "shared")
    links = labels = sets = known = None
    for step in range(STAR_ROUNDS + 1):
        if labels is None:
            members = shared.withColumn("label", F.col("node"))
        else:
            members = shared.join(labels, "node", "left").select(
                "key", "node", F.coalesce("label", "node").alias("label"))
        pairs = settle(possible(_stars(members, step == 1), bits) if step < STAR_ROUNDS else _apart(members, bits), "pairs")
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = settle(wanted if known is None else wanted.join(known, "node", "left_anti"), "wanted")
        count = wanted.count()
        if count:  # the sets of these nodes, from their texts
            side = F.broadcast(wanted) if count <= BROADCAST_NODES else wanted
            texts = source.join(side, F.col("doc_id") == F.col("node"), "left_semi")
            more = settle(set_table(texts.select(F.col("doc_id").alias("node"), "text")), "sets")
            sets, known = (more, wanted) if sets is None else (sets.unionByName(more), known.unionByName(wanted))
        if sets is None or pairs.isEmpty():
            continue
        found = settle(verified(pairs, sets), "links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = settle(components(links), "labels")
    if labels is None:
        labels = bits.select("node", F.col("node").alias("label")).limit(0)
    return (profile.join(nodes.drop("bits"), ["n_shingles", "fp", "fp2"], "left").join(labels, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce("label", "node", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents without all but the first (smallest id) of each component; rows with a null id stay."""
    found = near_duplicates(docs, id_column).filter("doc_id <> component_id").select(
        F.col("doc_id").alias(id_column)).distinct()
    return docs.join(found, id_column, "left_anti")
