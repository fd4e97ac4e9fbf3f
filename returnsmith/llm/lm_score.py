"""Stupid-backoff scores of documents under the corpus's own n-gram counts.

Documents are dealt to chunks by a hash of their id. A chunk's n-grams (orders 1 to 3) are exploded and combined to
(hash, count) before anything is shuffled, so that a word pair that a third of all rows hold is one entry a chunk. The
count tables are partitioned by hash: a bucket adds up the counts of all chunks, and joins them back to every
chunk's n-grams. The chunk then sums the scores of its documents' words. Entries travel as sorted runs, an array of
hashes and one of counts a row; both sides of the last join share one shuffle of the texts by chunk.

score(w | u v) = c(u v w) / c(u v) if c(u v w) >= min_count, else 0.4 * score(w | v), down to c(w) / N. N-grams never
cross documents; a document's first words have only the context that there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.keyed import bucket_edges, from_planes, pack, planes, shuffle_partitions, unpack
from returnsmith.llm.text import BASE, SPACED, Words, mix, words

ORDER = 3
BACKOFF = 0.4
#: N-grams of two or more words that the corpus holds less often count as unseen.
MIN_COUNT = 2
CHUNK_BYTES = 8 << 20
BUCKETS_PER_PARTITION = 2
#: N-grams are counted by 56 bits of their hash, which keeps the shuffle of the counts below three times the input; two of
#: them collide with a chance of 1.4e-17.
KEY_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
_TOTAL = np.uint64(0)  # the key whose count is the number of words; a hash of 0 is taken as 256


def _grams(w: Words) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each word, by order; 0 where the document has too few words before."""
    out = [np.maximum(mix(w.hash, 21) & KEY_BITS, np.uint64(256))]
    run = w.hash.copy()
    for order in range(2, ORDER + 1):
        # run of the order-gram ending at i: words i-order+1 .. i
        run = np.concatenate([np.zeros(1, np.uint64), run[:-1]]) * np.uint64(BASE) + w.hash if len(run) else run
        h = np.maximum(mix(run, 20 + order) & KEY_BITS, np.uint64(256))
        fits = np.zeros(len(run), bool)
        fits[order - 1:] = w.doc[order - 1:] == w.doc[:len(w.doc) - order + 1]
        out.append(np.where(fits, h, np.uint64(0)))
    return out


def _entries(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate(grams)
    keys, counts = np.unique(keys[keys != 0], return_counts=True)
    return np.concatenate([[_TOTAL], keys]), np.concatenate([[len(grams[0])], counts]).astype(np.uint64)


def _score(w: Words, keys: np.ndarray, counts: np.ndarray, min_count: int, backoff: float) -> tuple[np.ndarray, ...]:
    grams = _grams(w)
    c = [np.where(g == 0, np.uint64(0), counts[np.searchsorted(keys, g)]).astype(np.float64) for g in grams]
    first = np.concatenate([[True], w.doc[1:] != w.doc[:-1]]) if len(w.doc) else np.zeros(0, bool)
    level = np.zeros(len(first), np.int64)
    log = np.log(c[0] / float(counts[0])) if len(first) else np.zeros(0)
    for order in range(2, ORDER + 1):
        before = np.concatenate([[1.0], c[order - 2][:-1]]) if len(first) else c[0]
        seen = c[order - 1] >= min_count
        fits = grams[order - 1] != 0
        with np.errstate(divide="ignore", invalid="ignore"):
            log = np.where(seen, np.log(c[order - 1] / before), np.where(fits, log + np.log(backoff), log))
        level = np.where(seen, order - 1, level)
    n = len(w.offsets) - 1
    return (np.bincount(w.doc, minlength=n), np.bincount(w.doc, log, minlength=n),
            np.bincount(w.doc, level == ORDER - 1, minlength=n).astype(np.int64))


def score(docs: DataFrame, id_column: str = "doc_id", min_count: int = MIN_COUNT, backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_words, n_trigrams, log_score) of every row: words, words scored by a trigram, summed logarithms.

    Words are runs of other bytes than ASCII white space after lowering A-Z, over whole texts of all rows. A null or empty
    text has no words, adds no counts and scores 0. Repeated rows count each and give a row each; a null id is an id like
    others. Other columns are not looked at. An empty table gives none.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), "text")
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = shuffle_partitions(spark)
    chunks = max(partitions, -(-size // CHUNK_BYTES))
    buckets = partitions * BUCKETS_PER_PARTITION
    dealt = source.withColumn("chunk", F.pmod(F.xxhash64(F.lit("chunk"), "doc_id"), F.lit(chunks)))

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = _entries(_grams(words(table.column("text"), SPACED)))
        cut = np.append(np.searchsorted(keys[1:], bucket_edges(buckets)) + 1, len(keys))
        cut[0] = 1
        rows = [(0, _TOTAL.reshape(1), counts[:1])]  # the number of words goes to the first bucket, as a run of its own
        rows += [(b, keys[cut[b]:cut[b + 1]], counts[cut[b]:cut[b + 1]]) for b in range(buckets) if cut[b] < cut[b + 1]]
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                         pa.array([i for i in range(len(rows))], pa.int32()),
                         pa.array([pack(r[1]) for r in rows], pa.binary()), pa.array([planes(r[2]) for r in rows], pa.binary())],
                        names=["chunk", "bucket", "place", "keys", "counts"])

    def add(table: pa.Table) -> pa.Table:
        runs = [unpack(x) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([from_planes(x) for x in table.column("counts").to_pylist()])
        names, where = np.unique(np.concatenate(runs), return_inverse=True)
        totals = np.zeros(len(names), np.uint64)
        np.add.at(totals, where, counts)
        answers = np.split(totals[where], np.cumsum([len(r) for r in runs])[:-1])
        return pa.table([table.column("chunk"), table.column("place"), pa.array([planes(a) for a in answers], pa.binary())],
                        names=["chunk", "place", "totals"])

    def fill(texts: pa.Table, answers: pa.Table) -> pa.Table:
        w = words(texts.column("text"), SPACED)
        keys, _ = _entries(_grams(w))
        order = np.argsort(answers.column("place").to_numpy())
        parts = answers.column("totals").to_pylist()
        n, log, hits = _score(w, keys, np.concatenate([from_planes(parts[i]) for i in order]), min_count, backoff)
        return pa.table([texts.column("doc_id"), pa.array(n, pa.int64()), pa.array(hits, pa.int64()), pa.array(log, pa.float64())],
                        names=["doc_id", "n_words", "n_trigrams", "log_score"])

    runs = dealt.groupBy("chunk").applyInArrow(ask, "chunk bigint, bucket int, place int, keys binary, counts binary")
    totals = runs.groupBy("bucket").applyInArrow(add, "chunk bigint, place int, totals binary")
    return dealt.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(
        fill, "doc_id bigint, n_words bigint, n_trigrams bigint, log_score double")
