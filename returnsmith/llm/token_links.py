"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes (a space and the text). The incidence matrix of a tokenizer has a row per token
and a column per byte; the row product A times B transposed, Gustavson's way, has an entry for every pair of tokens
that overlap, its value the bytes they share. Offsets where tokens of both end cut the tokens into groups; the product of
the group incidences links all tokens that share a group. Matrices are compressed sparse rows made here.

``align`` gives each text its ids, groups and links. ``digests`` adds what the whole corpus says about a link: the number of
links that hold the same pair of ids. Texts are kept as chunks: a chunk holds its distinct pairs and, for each of its
texts, a sparse row over them, so a chunk asks for the count of a pair once, whatever the number of its links.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.keyed import from_planes, planes
from returnsmith.llm.text import blocks, raw_bytes
from returnsmith.session import settle

SPACE = "▁"
BLOCK = 1 << 18          # bytes of text encoded at a time
CHUNK_ITEMS = 1_500_000  # entries of the sparse rows of a chunk; a longer text is a chunk of its own
CHUNK_DOCS = 20_000
ROWS = 256               # aligned texts worked on at a time

ALIGNED = ("doc_id bigint, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>, "
           "link_a array<int>, link_b array<int>")
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_group_links")


class Csr(NamedTuple):
    """Compressed sparse rows: row i has the entries start[i] to start[i + 1]."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray
    width: int


def incidence(cuts: np.ndarray) -> Csr:
    """Row i covers the columns from cuts[i] to cuts[i + 1]."""
    width = int(cuts[-1])
    return Csr(cuts, np.arange(width), np.ones(width, np.int64), width)


def transposed(cuts: np.ndarray) -> Csr:
    """The transpose of ``incidence``: a row per column, with the one row that covers it."""
    width = int(cuts[-1])
    return Csr(np.arange(width + 1), np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), np.ones(width, np.int64), len(cuts) - 1)


def multiply(a: Csr, b: Csr) -> Csr:
    """A times B by rows: row i of the product is the sum of B's rows that row i of A names."""
    n = np.diff(b.start)[a.column]
    row = np.repeat(np.repeat(np.arange(len(a.start) - 1), np.diff(a.start)), n)
    at = np.arange(n.sum()) + np.repeat(b.start[a.column] - np.cumsum(n) + n, n)
    key, value = row * b.width + b.column[at], np.repeat(a.value, n) * b.value[at]
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    key, value = key[first], np.add.reduceat(value, first) if len(first) else value
    start = np.searchsorted(key, np.arange(len(a.start)) * b.width)
    return Csr(start, key % max(b.width, 1), value, b.width)


def overlap_links(a_ends: np.ndarray, b_ends: np.ndarray) -> Csr:
    """Tokens of A by tokens of B: the bytes they share. Ends are byte offsets, ascending."""
    return multiply(incidence(np.append(0, a_ends)), transposed(np.append(0, b_ends)))


def shared_group_links(a_cuts: np.ndarray, b_cuts: np.ndarray, rows: int = 1024) -> Iterator[Csr]:
    """Tokens of A by tokens of B that stand in one group, some rows of the product at a time."""
    groups = incidence(b_cuts)
    group = transposed(a_cuts)
    for low in range(0, len(group.column), rows):
        part = group.column[low:low + rows]
        yield multiply(Csr(np.arange(len(part) + 1), part, np.ones(len(part), np.int64), group.width), groups)


class Vocabulary(NamedTuple):
    """The bytes of every token, one after the other."""

    data: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)]))

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.start[ids + 1] - self.start[ids]

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        n = self.sizes(ids)
        return self.data[np.arange(n.sum()) + np.repeat(self.start[ids] - np.cumsum(n) + n, n)]


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for a byte: itself where it can be seen, else the next one from 256 on."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _byte_encoder(a, a_bytes: list[bytes], pattern: str | None):
    """Texts to arrays of A's ids. A's merges stand in the order of their ids in vocabularies of this kind; then, and where
    ``pattern`` (how A splits a text) is known, ``tiktoken`` makes the same ids in less time. Else A's own library makes them."""
    vocabulary = a.get_vocab(with_added_tokens=False)
    merges = json.loads(a.to_str())["model"]["merges"]
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    if pattern and [vocabulary.get(t) for t in joined] == list(range(256, 256 + len(joined))):
        import tiktoken

        fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={a_bytes[i]: i for i in vocabulary.values() if i < 256 + len(joined)},
                                 special_tokens={})
        return lambda texts: [fast.encode_to_numpy(t, disallowed_special=()) for t in texts]
    return lambda texts: [np.array(e.ids, np.int64) for e in a.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=1)
def _tokenizers(a_file: str, b_file: str, pattern: str | None) -> tuple:
    """Encoders and vocabularies, once a worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_file)
    a.encode_special_tokens = True
    letters = byte_letters()
    names = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
    a_bytes = [bytes(letters[c] for c in names.get(i, "")) for i in range(max(names) + 1)]
    b = sentencepiece.SentencePieceProcessor(model_file=b_file)
    b_bytes = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else
               b"" if b.is_control(i) or b.is_unknown(i) else b.id_to_piece(i).replace(SPACE, " ").encode()
               for i in range(b.get_piece_size())]
    return (_byte_encoder(a, a_bytes, pattern), Vocabulary.of(a_bytes),
            lambda texts: [np.array(x, np.int64) for x in b.encode(texts, num_threads=1)], Vocabulary.of(b_bytes))


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows, and the offsets of the rows."""
    return np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64), np.cumsum([0, *map(len, lists)])


def _faithful(v: Vocabulary, ids: np.ndarray, start: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows' tokens give the row's bytes again."""
    ends = np.append(0, np.cumsum(v.sizes(ids)))[start]
    own = v.bytes_of(ids)
    same = np.diff(ends) == np.diff(offsets)
    if same.all():
        wrong = np.append(0, np.cumsum(own != data))
        return wrong[offsets[1:]] == wrong[offsets[:-1]]
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(own[ends[i]:ends[i + 1]], data[offsets[i]:offsets[i + 1]])
    return same


def _lists(values: np.ndarray, start: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(values.astype(np.int32)))


def _aligned(batch: pa.RecordBatch, a_file: str, b_file: str, pattern: str | None) -> pa.RecordBatch:
    a, a_words, b, b_words = _tokenizers(a_file, b_file, pattern)
    texts = [t or "" for t in batch.column("text").to_pylist()]
    n = len(texts)
    spaced = [" " + t for t in texts]
    sides = [_flat(a(spaced)), _flat(b(texts))]
    data, offsets = raw_bytes(pa.array(spaced, pa.string()))
    good = np.diff(offsets) > 1
    for words, side in zip((a_words, b_words), sides, strict=True):
        good &= _faithful(words, *side, data, offsets)
    (a_ids, a_row), (b_ids, b_row) = ((ids[np.repeat(good, np.diff(row))], np.append(0, np.cumsum(np.diff(row) * good))) for ids, row in sides)
    a_ends, b_ends = np.cumsum(a_words.sizes(a_ids)), np.cumsum(b_words.sizes(b_ids))  # rows end in both, so one matrix holds them all
    links = overlap_links(a_ends, b_ends)
    link_a, link_b = np.repeat(np.arange(len(a_ids)), np.diff(links.start)), links.column
    _, a_last, b_last = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    a_first, b_first = np.append(0, a_last + 1), np.append(0, b_last + 1)  # of each group, and behind the last one
    groups = np.searchsorted(a_first, a_row)                               # the first group of each row
    row = np.repeat(np.arange(n), np.diff(groups) + 1)
    at = np.arange(len(row)) - row                                         # a row's cuts: its groups' begins and its end
    link_row = np.searchsorted(link_a, a_row)
    in_row = np.repeat(np.arange(n), np.diff(link_row))
    cuts = np.append(0, np.cumsum(np.diff(groups) + 1))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").cast(pa.int64()), _lists(a_ids, a_row), _lists(b_ids, b_row),
         _lists(a_first[at] - a_row[row], cuts), _lists(b_first[at] - b_row[row], cuts),
         _lists(link_a - a_row[in_row], link_row), _lists(link_b - b_row[in_row], link_row)],
        names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts", "link_a", "link_b"])


def align(docs: DataFrame, a_file: str, b_file: str, pattern: str | None = None) -> DataFrame:
    """Each text's tokens by A (a byte-level tokenizer file) and B (a SentencePiece model), their groups and links.
    ``pattern`` is how A splits a text, if known.

    Columns: doc_id; a_ids, b_ids; a_cuts, b_cuts (group g holds the tokens cuts[g] to cuts[g + 1], the end excluded); link_a,
    link_b (token positions of every overlapping pair, by A's position, then B's). Special tokens' strings are plain text.
    A null or empty text, and one whose bytes either tokenizer does not give again, has no tokens: empty lists, cuts [0].
    One row out for each row in, repeated and null ids too; other columns are left out. A text of any length is encoded
    whole, in one task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=BLOCK):
            yield _aligned(block, a_file, b_file, pattern)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to n - 1, left-aligned, and their number."""
    names = np.arange(n).astype(bytes)
    return names.view(np.uint8).reshape(n, -1), np.char.str_len(names)


def group_text(a_ids: np.ndarray, b_ids: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray,
               table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;``: the ids of A and B in each group; and where each token's part ends."""
    a_group, b_group = transposed(a_cuts).column, transposed(b_cuts).column
    a_at, b_at = np.arange(len(a_ids)) + b_cuts[a_group], np.arange(len(b_ids)) + a_cuts[b_group + 1]
    n = len(a_ids) + len(b_ids)
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    mark[a_at[a_cuts[1:] - 1]] = ord("|")
    mark[b_at[b_cuts[1:] - 1]] = ord(";")
    digits, sizes = table
    size = sizes[ids]
    end = np.cumsum(size + 1)
    begin = end - size - 1
    out = np.empty(end[-1] if n else 0, np.uint8)
    out[end - 1] = mark
    for k in range(digits.shape[1]):
        has = size > k
        out[begin[has] + k] = digits[ids[has], k]
    return out, end


def _column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the offsets of its rows."""
    lists = batch.column(name)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def _joined_cuts(cuts: np.ndarray, rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The cuts of some rows' groups as cuts of all their tokens in one sequence."""
    whole = cuts + np.repeat(begin[:-1], np.diff(rows))
    whole = np.delete(whole, rows[1:-1]) if len(rows) > 1 else whole  # a row begins where the one before it ends
    return whole if len(whole) else np.zeros(1, np.int64)


def _pairs(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair, times) of the distinct pairs of ids in each row; rows ascend."""
    high, low = int(a.max(initial=0)).bit_length(), int(b.max(initial=0)).bit_length()
    if high + low + int(row.max(initial=0)).bit_length() > 63:
        order = np.lexsort((b, a, row))
        row, a, b = row[order], a[order], b[order]
        first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        return row[first], a[first] << 32 | b[first], np.diff(np.append(first, len(row)))
    key, times = np.unique(row << (high + low) | a << low | b, return_counts=True)
    pair = key & ((1 << (high + low)) - 1)
    return key >> (high + low), (pair >> low) << 32 | (pair & ((1 << low) - 1)), times


CHUNK = ("chunk bigint, doc_id array<bigint>, " + ", ".join(f"{c} array<bigint>" for c in COUNTS)
         + ", groups_sha256 array<string>, pairs array<bigint>, links array<bigint>, row_start array<bigint>, item binary, n binary")


class _Chunk:
    """Texts of one task, as sparse rows over their distinct pairs of ids."""

    def __init__(self):
        self.docs, self.counts, self.sha = [], {c: [] for c in COUNTS}, []
        self.pairs, self.times, self.sizes, self.size = [], [], [], 0

    def add(self, batch: pa.RecordBatch, table: tuple) -> None:
        (a_ids, a_row), (b_ids, b_row), (a_cuts, cut_row), (b_cuts, _), (link_a, link_row), (link_b, _) = (
            _column(batch, c) for c in batch.schema.names[1:])
        n = batch.num_rows
        a_all, b_all = _joined_cuts(a_cuts, cut_row, a_row), _joined_cuts(b_cuts, cut_row, b_row)
        text, end = group_text(a_ids, b_ids, a_all, b_all, table)
        last = np.append(0, end)[a_row + b_row].tolist()
        body = memoryview(text)
        self.sha += [hashlib.sha256(body[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(last, last[1:], strict=False)]
        groups = np.diff(cut_row) - 1
        shared = np.append(0, np.cumsum(np.diff(a_all) * np.diff(b_all)))[np.append(0, np.cumsum(groups))]
        self.docs += batch.column("doc_id").to_pylist()
        sizes = (np.diff(a_row), np.diff(b_row), groups, np.diff(link_row), np.diff(shared))  # the group product's entries are counted, not made
        for c, x in zip(COUNTS, sizes, strict=True):
            self.counts[c] += x.tolist()
        of = np.repeat(np.arange(n), np.diff(link_row))
        row, pair, times = _pairs(of, a_ids[link_a + a_row[of]], b_ids[link_b + b_row[of]])
        self.pairs.append(pair)
        self.times.append(times)
        self.sizes.append(np.bincount(row, minlength=n))
        self.size += len(pair)

    def row(self, name: int) -> pa.RecordBatch:
        pairs, item = np.unique(np.concatenate(self.pairs), return_inverse=True)
        times = np.concatenate(self.times)
        start = np.append(0, np.cumsum(np.concatenate(self.sizes)))
        step = np.diff(item, prepend=0)
        own = start[:-1][np.diff(start) > 0]
        step[own] = item[own]  # differences begin anew in each row
        values = [name, self.docs, *self.counts.values(), self.sha, pairs, np.bincount(item, times, len(pairs)).astype(np.int64), start,
                  planes(step), planes(times)]
        kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int64())] * len(COUNTS), pa.list_(pa.string()),
                 *[pa.list_(pa.int64())] * 3, pa.binary(), pa.binary()]
        names = ["chunk", "doc_id", *COUNTS, "groups_sha256", "pairs", "links", "row_start", "item", "n"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def _chunks(aligned: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, table = TaskContext.get().partitionId(), 0, _Chunk(), _digits(1 << 16)
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                most = max(int(_column(part, c)[0].max(initial=0)) for c in ("a_ids", "b_ids"))
                if most >= len(table[1]):
                    table = _digits(2 * most)
                held.add(part, table)
                if held.size >= CHUNK_ITEMS or len(held.docs) >= CHUNK_DOCS:
                    yield held.row((task << 32) + made)
                    made, held = made + 1, _Chunk()
        if held.docs:
            yield held.row((task << 32) + made)

    return aligned.mapInArrow(run, CHUNK)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, links, best): how many links of the corpus hold a pair of ids, and whether no pair of its B id has more."""
    counts = (chunks.selectExpr("explode(arrays_zip(pairs, links)) as x").groupBy(F.col("x.pairs").alias("pair"))
              .agg(F.sum("x.links").alias("links")).withColumn("b", F.expr("pair & 4294967295")))
    highest = counts.groupBy("b").agg(F.max("links").alias("most"))
    return counts.join(highest, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


ANSWER = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", n_best bigint, count_sum bigint, groups_sha256 string"


def _answered(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """Each text's sparse row times the vectors of counts and of best pairs."""
    out = {c: [] for c in ("doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256")}
    at = counts.column("at").to_numpy()
    links, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    links[at], best[at] = counts.column("links").to_numpy(), counts.column("best").to_numpy()
    for row in chunk.select([*out.keys() - {"n_best", "count_sum"}, "row_start", "item", "n"]).to_pylist():
        start, times, step = np.array(row["row_start"]), from_planes(row["n"]).astype(np.int64), from_planes(row["item"]).astype(np.int64)
        total = np.append(0, np.cumsum(step))
        item = total[1:] - np.repeat(total[start[:-1]], np.diff(start))
        for c, value in (("n_best", best), ("count_sum", links)):
            sums = np.append(0, np.cumsum(times * value[item]))
            out[c] += (sums[start[1:]] - sums[start[:-1]]).tolist()
        for c in out.keys() - {"n_best", "count_sum"}:
            out[c] += row[c]
    kinds = {"groups_sha256": pa.string()}
    return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})


def digests(aligned: DataFrame) -> DataFrame:
    """Per row of ``align``: sizes, the digest of its groups, and its links weighed by the corpus.

    n_best counts the links whose pair of ids is the most frequent one of its B id (ties included), count_sum adds the corpus-wide
    numbers of links of their pairs, n_group_links the pairs of tokens that share a group. Rows without tokens have zeros
    and an empty digest. Empty in, empty out.
    """
    chunks = settle(_chunks(aligned), "links")
    asked = chunks.selectExpr("chunk", "posexplode(pairs) as (at, pair)")
    told = asked.join(pair_counts(chunks), "pair").select(F.col("chunk").alias("asker"), "at", "links", "best")
    rows = chunks.select("chunk", "doc_id", *COUNTS, "groups_sha256", "row_start", "item", "n")
    return rows.groupBy("chunk").cogroup(told.groupBy("asker")).applyInArrow(_answered, ANSWER)
