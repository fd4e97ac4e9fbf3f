"""Phrase collocations: contiguous phrases whose words occur together far more often than apart.

Every word of a text begins an n-gram of up to four words that ends with its piece. A phrase occurs as often as n-grams
begin with it, so the n-grams alone count all phrases. Some texts at a time (a shard) are sorted into an acyclic
automaton: states are the prefixes, level by level, arcs carry words in byte order, last arcs carry counts. Automata of all shards
are cut at the same n-grams into ranges and meet range by range, where their union sums the weights; a prefix's weight is
the sum below it, and only prefixes at the edge of a range go on in the next one. Words are told by their bytes: every
automaton has its own sorted list of words, and lists are merged when automata are.

Looking up the parts of a phrase composes two transducers, phrase to part and part to count: a join on the part.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from returnsmith.llm.keyed import from_planes, planes, shuffle_partitions
from returnsmith.llm.text import blocks, byte_table, lowered, raw_bytes
from returnsmith.session import settle

ORDER = 4                    # words of the longest phrase
MIN_COUNT = 30
COVERED = 80                 # per cent of a phrase's occurrences inside a longer one that make it redundant
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"
SHARD_BYTES = 8 << 20        # text of a shard; a longer text is a shard of its own
RANGE_ENTRIES = 1_000_000    # n-grams of a range, about
SAMPLES = 48                 # n-grams a range that the cuts are chosen from

#: [^\x20\x09]+ within pieces between [.,;:!?\x0A-\x0D]
BREAKS = [ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))
WORD = byte_table([(b, b) for b in [*BREAKS, 0x20, 0x09]])
BREAK = ~byte_table([(b, b) for b in BREAKS])


class Automaton(NamedTuple):
    """N-grams as levels of arcs. Labels are places in ``words`` plus one; 0 ends an n-gram before the last level."""

    words: pa.Array           # binary, sorted, distinct
    labels: list[np.ndarray]  # of each level's arcs, in the order of the n-grams
    fans: list[np.ndarray]    # arcs that follow each arc, for all levels but the last
    weight: np.ndarray        # occurrences, for each arc of the last level

    def ngrams(self) -> np.ndarray:
        """The n-grams as rows of labels, sorted."""
        rows = [self.labels[0]]
        for labels, fan in zip(self.labels[1:], self.fans, strict=True):
            rows = [np.repeat(r, fan) for r in rows] + [labels]
        return np.stack(rows, axis=1).astype(np.int32)

    def prefixes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(first n-gram, occurrences) of every state at a depth: the weights below it, summed."""
        n = np.ones(len(self.weight), np.int64)
        sums = np.append(0, np.cumsum(self.weight))
        for fan in reversed(self.fans[depth - 1:]):
            n = np.add.reduceat(n, np.cumsum(fan) - fan) if len(fan) else n[:0]
        end = np.cumsum(n)
        return end - n, sums[end] - sums[end - n]


def build(words: pa.Array, ngrams: np.ndarray, weight: np.ndarray) -> Automaton:
    """The automaton of sorted n-grams, equal ones summed: an n-gram adds arcs from where it leaves the one before it."""
    if not len(ngrams):
        empty = np.zeros(0, np.int64)
        return Automaton(words, [empty] * ORDER, [empty] * (ORDER - 1), empty)
    leaves = np.ones(len(ngrams), np.int64) * ORDER  # the first level at which an n-gram differs; ORDER: nowhere
    for level in reversed(range(ORDER)):
        leaves[1:][ngrams[1:, level] != ngrams[:-1, level]] = level
    leaves[0] = 0
    labels, fans, last = [], [], None
    for level in range(ORDER):
        new = np.flatnonzero(leaves <= level)
        labels.append(ngrams[new, level])
        if last is not None:
            fans.append(np.diff(np.append(np.searchsorted(new, last), len(new))))
        last = new
    return Automaton(words, labels, fans, np.add.reduceat(weight, last))


def _sorted(ngrams: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head, tail = ((ngrams[:, k].astype(np.int64) << 32) | ngrams[:, k + 1] for k in (0, 2))
    order = np.lexsort((tail, head))
    return ngrams[order], weight[order]


def _distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words in byte order, and where each word is among them."""
    coded = words.dictionary_encode()
    names, index = coded.dictionary, coded.indices.to_numpy()
    order = pc.sort_indices(names).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return names.take(pa.array(order)), rank[index]


def union(parts: list[Automaton]) -> Automaton:
    """One automaton with the weights of equal n-grams added."""
    words, at = _distinct(pa.concat_arrays([p.words for p in parts]))
    start = np.cumsum([0, *(len(p.words) for p in parts)])
    rows = [np.append(0, at[s:e] + 1).astype(np.int32)[p.ngrams()] for p, s, e in zip(parts, start, start[1:], strict=False)]
    return build(words, *_sorted(np.concatenate(rows), np.concatenate([p.weight for p in parts])))


def _cut(a: Automaton, ngrams: np.ndarray, low: int, high: int) -> Automaton:
    """Some n-grams of an automaton, with their own words only."""
    part = ngrams[low:high]
    used = np.zeros(len(a.words) + 1, bool)
    used[part] = True
    used[0] = False
    label = np.cumsum(used)
    label[0] = 0
    return build(a.words.take(pa.array(np.flatnonzero(used) - 1)), label[part], a.weight[low:high])


def _packed(a: Automaton) -> dict:
    sizes = pc.binary_length(a.words).to_numpy(zero_copy_only=False).astype(np.int64)
    text = zstandard.ZstdCompressor(level=1).compress(b"".join(a.words.to_pylist()))
    return {"words": text, "sizes": planes(sizes), "weight": planes(a.weight),
            "labels": [planes(x) for x in a.labels], "fans": [planes(x) for x in a.fans]}


def _unpacked(row: dict) -> Automaton:
    def numbers(body: bytes) -> np.ndarray:
        return from_planes(body).astype(np.int64)

    text = zstandard.ZstdDecompressor().decompress(row["words"])
    offsets = np.append(0, np.cumsum(numbers(row["sizes"])))
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    return Automaton(words, [numbers(x) for x in row["labels"]], [numbers(x) for x in row["fans"]], numbers(row["weight"]))


PACKED = "words binary, sizes binary, weight binary, labels array<binary>, fans array<binary>"
PACKED_TYPES = [("words", pa.binary()), ("sizes", pa.binary()), ("weight", pa.binary()), ("labels", pa.list_(pa.binary())),
                ("fans", pa.list_(pa.binary()))]


def _record(rows: list[dict], lead: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(lead + PACKED_TYPES))


def shard(texts: pa.Array) -> Automaton:
    """The automaton of some texts; A-Z are lowered."""
    data, offsets = raw_bytes(texts)
    data = lowered(data)
    inside = WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside & np.append(True, ~inside[:-1])[:len(data)] | inside & edge[:-1]
    start = np.flatnonzero(begins)
    word = np.cumsum(begins) - 1
    sizes = np.bincount(word[inside], minlength=len(start))
    spelled = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int64)), pa.py_buffer(data[inside].tobytes())])
    names, rank = _distinct(spelled)
    piece = np.cumsum(BREAK[data] | edge[:-1])[start]
    ngrams = np.zeros((len(start), ORDER), np.int32)
    for k in range(ORDER):
        m = max(0, len(start) - k)
        same = piece[k:] == piece[:m]
        ngrams[:m, k] = np.where(same, rank[k:] + 1, 0)
    return build(names, *_sorted(ngrams, np.ones(len(start), np.int64)))


def _shards(docs: DataFrame) -> DataFrame:
    """(lang, entries, automaton) for each shard and language."""
    lead = [("lang", pa.string()), ("entries", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            made = []
            for lang in pc.unique(table.column("lang")).to_pylist():
                a = shard(table.filter(pc.equal(table.column("lang"), lang)).column("text"))
                if len(a.weight):
                    made.append({"lang": lang, "entries": len(a.weight)} | _packed(a))
            return _record(made, lead)

        for block in blocks(batches, limit=SHARD_BYTES):
            n = len(raw_bytes(block.column("text"))[0])
            if held and size + n > SHARD_BYTES:
                yield flush()
                held, size = [], 0
            held.append(block)
            size += n
        if held:
            yield flush()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, f"lang string, entries bigint, {PACKED}")


def _spelled(a: Automaton, rows: np.ndarray) -> list[tuple[bytes, ...]]:
    """N-grams as the bytes of their words; the end sorts before every word."""
    names = [b"", *a.words.take(pa.array(np.unique(rows[rows > 0]) - 1)).to_pylist()]
    label = np.searchsorted(np.unique(np.append(rows, 0)), rows)
    return [tuple(names[j] for j in r) for r in label.tolist()]


def _cuts(shards: DataFrame, ranges: int) -> list[tuple]:
    """Ascending (lang, words) at which the ranges begin. Only the balance of the ranges depends on the sample."""
    total = shards.agg(F.sum("entries")).first()[0] or 0
    every = max(1, total // (ranges * SAMPLES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = _unpacked(row)
                # a shard smaller than the step still gives its share: the place within the step follows from its words
                rows = a.ngrams()[(len(a.words) * 7919) % every::every]
                yield pa.RecordBatch.from_pylist([{"lang": row["lang"], "words": list(w)} for w in _spelled(a, rows)],
                                                 schema=pa.schema([("lang", pa.string()), ("words", pa.list_(pa.binary()))]))

    rows = shards.mapInArrow(run, "lang string, words array<binary>").collect()  # some SAMPLES a range, whatever the input
    sample = sorted((r["lang"].encode(), *map(bytes, r["words"])) for r in rows)
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []


class _Place:
    """N-grams of an automaton as a sequence of tuples, for bisection."""

    def __init__(self, lang: bytes, a: Automaton, ngrams: np.ndarray):
        self.lang, self.words, self.ngrams = lang, a.words, ngrams

    def __len__(self) -> int:
        return len(self.ngrams)

    def __getitem__(self, i: int) -> tuple:
        return (self.lang, *(self.words[int(x) - 1].as_py() if x else b"" for x in self.ngrams[i]))


def _counted(shards: DataFrame, ranges: int, least: int) -> DataFrame:
    """(lang, phrase, words, count) of phrases with ``least`` occurrences in a range, and of all at a range's edge; words 0: the total."""
    cuts = _cuts(shards, ranges)
    lead = [("part", pa.int32()), ("lang", pa.string())]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = _unpacked(row)
                ngrams = a.ngrams()
                seen = _Place(row["lang"].encode(), a, ngrams)
                at = [0, *(bisect_left(seen, c) for c in cuts), len(ngrams)]
                yield _record([{"part": i, "lang": row["lang"]} | _packed(_cut(a, ngrams, low, high))
                               for i, (low, high) in enumerate(zip(at, at[1:], strict=False)) if high > low], lead)

    def told(lang: str, parts: list[Automaton]) -> pa.RecordBatch:
        a = union(parts)
        ngrams = a.ngrams()
        out = [(lang, "", 0, int(a.weight.sum()))]
        for depth in range(1, ORDER + 1):
            first, count = a.prefixes(depth)
            whole = ngrams[first, depth - 1] > 0
            edge = np.zeros(len(first), bool)
            edge[[0, -1]] = True
            keep = np.flatnonzero(whole & ((count >= least) | edge))
            for row, n in zip(_spelled(a, ngrams[first[keep], :depth]), count[keep].tolist(), strict=True):
                out.append((lang, b" ".join(row).decode(), depth, n))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (
            pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)], names=["lang", "phrase", "words", "count"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if (key := (row["part"], row["lang"])) != now and held:
                    yield told(now[1], held)
                    held = []
                now = key
                held.append(_unpacked(row))
        if held:
            yield told(now[1], held)

    pieces = shards.mapInArrow(deal, f"part int, lang string, {PACKED}")
    return (pieces.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("part", "lang")
            .mapInArrow(meet, "lang string, phrase string, words int, count bigint"))


def count_phrases(docs: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(lang, phrase, words, f) of every phrase of one to four words with ``least`` occurrences; words 0: all word occurrences.

    A phrase's words are joined by a space. Counts are exact. Null languages count as ``und``; null and empty texts have no words.
    """
    shards = settle(_shards(docs), "shards")
    entries = shards.agg(F.sum("entries")).first()[0] or 0
    ranges = max(shuffle_partitions(docs.sparkSession), -(-entries // RANGE_ENTRIES))
    return (_counted(shards, ranges, least).groupBy("lang", "phrase", "words").agg(F.sum("count").alias("f"))
            .filter((F.col("f") >= least) | (F.col("words") == 0)))


def _wide(name: str) -> str:
    """Products of counts may pass 64 bits."""
    return f"cast({name} as decimal(19, 0))"


def collocations(docs: DataFrame, top: int = TOP, least: int = MIN_COUNT, covered: int = COVERED) -> DataFrame:
    """Each language's first phrases: lang, rank, phrase, a, l, r, n, score.

    A candidate is a phrase of two to four words with a >= least occurrences. Cut after k words it has parts that occur l
    and r times and the score floor(2000000 a / (l + r)); the lowest cut counts, ties to the smallest k. A candidate
    inside a longer one that has ``covered`` per cent of its occurrences is dropped, be the longer one dropped or not. Order: score and a
    descending, phrase ascending by its bytes. Other columns are ignored, repeated rows count as often as they stand, empty in gives
    empty out; a language without candidates has no rows.
    """
    counts = settle(count_phrases(docs, least), "phrases")
    known = counts.filter("words > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("n_part"))
    candidates = counts.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = candidates.selectExpr("lang", "phrase", "a", "explode(transform(sequence(1, words - 1), k -> struct(k, "
                                 "array_join(slice(w, 1, k), ' ') as head, array_join(slice(w, k + 1, words - k), ' ') as tail))) as cut")
    cuts = cuts.select("lang", "phrase", "a", "cut.*")
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(known.withColumnsRenamed({"part": side, "n_part": name}), ["lang", side])
    scored = (cuts.withColumn("score", F.expr(f"cast(({SCALE} * {_wide('a')}) div ({_wide('l')} + {_wide('r')}) as bigint)"))
              .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
              .select("lang", "phrase", "a", "best.score", "best.l", "best.r"))
    inside = (candidates.filter("words > 2").selectExpr(
        "lang", "a", "explode(flatten(transform(sequence(2, words - 1), m -> transform(sequence(1, words - m + 1), "
        "i -> array_join(slice(w, i, m), ' '))))) as phrase").groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        f"longer is null or 100 * {_wide('longer')} < {covered} * {_wide('a')}")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return (kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
