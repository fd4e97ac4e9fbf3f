"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels come by document. On one half of a bounded sample of labelled documents, words and word beginnings get log-odds of
standing in toxic documents. They label the tokens of the other half: a token of a toxic document is toxic if one of its
strings speaks clearly for it, all other tokens are not. A chain with two states is fitted to these labelled tokens by
its conditional likelihood, with the log-odds of a token's strings as features, so that a word never seen is judged by how
it begins. Forward and backward passes over the whole text give each token's marginal; the largest one and the expected
number of toxic tokens give the document's score by a logistic fit, and tokens at or above one half give the spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from returnsmith.llm.text import ALNUM, Hasher, blocks, mix, words

#: The fit reads so many labelled documents at most, chosen by a hash of the id; scoring reads everything.
MAX_LABELLED = 8_000
#: And so many bytes of text, in the order of that hash; a text that would pass the bound ends the sample.
MAX_BYTES = 64 << 20
#: The chain reads so many stretches of STRETCH tokens with a toxic one, and as many others, chosen by a hash.
MAX_STRETCHES = 6_000
STRETCH = 128
#: A document offers so many of either sort.
DOC_STRETCHES = 64
#: Of the stretches without any string of the lists, one of so many is offered, by a hash, and stands for them all.
CLEAN_EVERY = 8
#: Bytes of a word's beginnings that are features, next to the word itself.
BEGINNINGS = (3, 4, 5, 6)
#: Log-odds from which a string labels a token of a toxic document, and toxic documents that must hold it.
CLEAR = 3.0
SUPPORT = 2
STEPS = 200
FOLDS = 5
#: Tokens that one pass of the chain takes together.
PASS_TOKENS = 2_000_000


class Model(NamedTuple):
    strings: np.ndarray    # sorted hashes
    odds: np.ndarray
    emission: np.ndarray   # bias, then a weight for each kind of string
    chain: np.ndarray      # exp of the transition weights, [from, to]
    first: float           # exp of the weight of starting in the toxic state
    score: np.ndarray      # bias, weight of the largest marginal's log-odds, weight of the log of the expected count


def _strings(w) -> list[np.ndarray]:
    """Hashes of every token's word and beginnings; 0 where the word is not longer than the beginning."""
    hasher = Hasher(w.data, 3)
    out = [mix(w.hash, 60)]
    for size in BEGINNINGS:
        longer = w.end - w.start > size
        out.append(np.where(longer, mix(hasher.of(w.start, np.minimum(w.end, w.start + size)), 60 + size), np.uint64(0)))
    return out


def _features(w, strings: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """The log-odds of each token's strings, 0 for unknown ones: an array of kinds by tokens."""
    out = np.zeros((1 + len(BEGINNINGS), len(w.doc)))
    if len(strings):
        for kind, h in enumerate(_strings(w)):
            at = np.minimum(np.searchsorted(strings, h), len(strings) - 1)
            out[kind] = np.where(strings[at] == h, odds[at], 0.0)
    return out


def _chain_odds(e: np.ndarray, begin: np.ndarray, length: np.ndarray, chain: np.ndarray, first: float) -> np.ndarray:
    """Odds of the toxic state of every token, over all texts at once; e holds the tokens' emission odds."""
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    active = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
    ahead, behind = np.empty(len(e)), np.empty(len(e))
    (c00, c01), (c10, c11) = chain
    state = None
    for t, n in enumerate(active):
        at = begin[:n] + t
        state = e[at] * first if t == 0 else e[at] * (c01 + c11 * state[:n]) / (c00 + c10 * state[:n])
        ahead[at] = state
    state = np.ones(len(begin))
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        on = length[:n] - 1 > t
        follow = np.where(on, e[np.minimum(at + 1, len(e) - 1)] * state[:n], 0.0)
        state[:n] = np.where(on, (c10 + c11 * follow) / (c00 + c01 * follow), 1.0)
        behind[at] = state[:n]
    return ahead * behind


def _emissions(w, model: Model) -> np.ndarray:
    return np.exp(np.clip(model.emission[0] + model.emission[1:] @ _features(w, model.strings, model.odds), -30, 30))


def _document_features(odds: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Bias, log-odds of the largest marginal, log of one plus the expected number of toxic tokens among likely ones."""
    largest = np.full(n, np.exp(-12.0))
    np.maximum.at(largest, doc, odds)
    marginal = odds / (1 + odds)
    count = np.bincount(doc, np.where(marginal >= 0.5, marginal, 0.0), minlength=n)
    return np.stack([np.ones(n), np.clip(np.log(np.minimum(largest, 1e12)), -12, 12), np.log1p(count)])


def _code(doc: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mix(mix(doc.astype(np.int64).view(np.uint64), 71) ^ number.astype(np.uint64), 72)


def _stretch_weights(doc: np.ndarray, number: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """How many stretches each one stands for in the fit of the chain, 0 for those left out.

    A document offers DOC_STRETCHES with a toxic token and as many others. Of the toxic ones offered all are taken, or if they are
    more than MAX_STRETCHES, each document's first before any document's second; of the others MAX_STRETCHES. Order is by
    a hash of document and number, and what is taken stands for all that was offered of its sort.
    """
    code = _code(doc, number)
    order = np.lexsort((code, marked, doc))
    new = np.append(True, (doc[order[1:]] != doc[order[:-1]]) | (marked[order[1:]] != marked[order[:-1]]))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.arange(len(doc)) - np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
    weight = np.zeros(len(doc))
    for sort in (True, False):
        own = np.flatnonzero((marked == sort) & (rank < DOC_STRETCHES))
        taken = own[np.lexsort((code[own], rank[own] * sort))][:MAX_STRETCHES]
        weight[taken] = len(own) / max(1, len(taken))
    return weight


def _fit_chain(x: np.ndarray, y: np.ndarray, real: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights by gradient steps on the conditional likelihood of weighted stretches; x [stretch, token, feature] with a bias."""
    n, length, size = x.shape
    share, total = weight[:, None], weight.sum()
    emission = np.zeros(size)
    emission[0] = -4.0
    move, start = np.zeros((2, 2)), 0.0
    theta = np.concatenate([emission, move.ravel(), [start]])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    both = real[:, 1:] & real[:, :-1]
    linked = np.ascontiguousarray((both * share).T)
    seen_move = np.array([[np.sum((both & (y[:, :-1] == a) & (y[:, 1:] == b)) * share) for b in (0, 1)] for a in (0, 1)], float)
    seen_emit = np.einsum("ntk,nt->k", x, y * real * share)
    seen_first = float(np.sum(y[:, 0] * weight))
    for step in range(1, STEPS + 1):
        e = np.ascontiguousarray(np.exp(np.clip(x @ theta[:size], -30, 30)).T)
        (c00, c01), (c10, c11) = np.exp(theta[size:size + 4]).reshape(2, 2)
        ahead, behind = np.empty((length, n)), np.ones((length, n))
        ahead[0] = e[0] * np.exp(theta[-1])
        for t in range(1, length):
            ahead[t] = e[t] * (c01 + c11 * ahead[t - 1]) / (c00 + c10 * ahead[t - 1])
        for t in range(length - 2, -1, -1):
            follow = e[t + 1] * behind[t + 1]
            behind[t] = np.where(real[:, t + 1], (c10 + c11 * follow) / (c00 + c01 * follow), 1.0)
        odds = ahead * behind
        p = (odds / (1 + odds)).T * real * share
        before, follow = ahead[:-1], e[1:] * behind[1:]
        joint = c01 * follow, c10 * before, c11 * before * follow
        scale = linked / (c00 + sum(joint))
        pair = np.array([c00 * scale.sum(), *(np.vdot(j, scale) for j in joint)]).reshape(2, 2)
        slope = np.concatenate([seen_emit - np.einsum("ntk,nt->k", x, p), (seen_move - pair).ravel(),
                                [seen_first - p[:, 0].sum()]]) / total - 0.001 * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return theta[:size], np.exp(theta[size:size + 4]).reshape(2, 2), float(np.exp(theta[-1]))


def _fit_score(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights by damped Newton steps with a weak prior."""
    beta = np.zeros(len(z))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ z, -30, 30)))
        slope = z @ (y - p) - 0.01 * beta
        beta = beta + np.linalg.solve((z * (p * (1 - p))) @ z.T + 0.01 * np.eye(len(z)), slope)
    return beta


def fit(texts: pa.Array, toxic: np.ndarray, ids: np.ndarray | None = None) -> Model:
    """A model from labelled texts; every other one goes to the log-odds, the rest to the chain and the score."""
    ids = np.arange(len(toxic)) if ids is None else ids
    odd = np.arange(len(toxic)) % 2 == 1
    prior = (toxic.sum() + 0.5) / (len(toxic) + 1)
    blank = Model(np.zeros(0, np.uint64), np.zeros(0), np.array([-4.0] + [0.0] * (1 + len(BEGINNINGS))), np.ones((2, 2)), 1.0,
                  np.array([np.log(prior / (1 - prior)), 0.0, 0.0]))
    if min(toxic[odd].sum(), toxic[~odd].sum(), (1 - toxic[odd]).sum(), (1 - toxic[~odd]).sum()) == 0:
        return blank
    table = pa.record_batch([texts, pa.array(toxic)], names=["text", "toxic"])
    counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for block in blocks([table.filter(pa.array(~odd))]):
        w = words(block.column("text"), ALNUM)
        bad = block.column("toxic").to_numpy()[w.doc]
        for h in _strings(w):
            pair = np.unique(np.stack([h[h != 0], w.doc[h != 0].astype(np.uint64) * np.uint64(2) + bad[h != 0].astype(np.uint64)]), axis=1)
            names, at = np.unique(pair[0], return_inverse=True)
            is_bad = (pair[1] & np.uint64(1)).astype(float)
            counts.append((names, np.bincount(at, is_bad), np.bincount(at, 1 - is_bad)))
    strings, at = np.unique(np.concatenate([c[0] for c in counts]), return_inverse=True)
    bad, good = (np.bincount(at, np.concatenate([c[j] for c in counts])) for j in (1, 2))
    n_bad, n_good = toxic[~odd].sum(), (1 - toxic[~odd]).sum()
    odds = np.log((bad + 0.5) / (n_bad + 1)) - np.log((good + 0.5) / (n_good + 1))
    keep = (bad >= SUPPORT) & (odds > 1)
    strings, odds = strings[keep], odds[keep]
    rest = table.filter(pa.array(odd))

    def stretches():
        """Blocks as (features, marks, tokens' places, tokens' stretches, the stretches' documents and numbers)."""
        base = 0
        for block in blocks([rest]):
            w = words(block.column("text"), ALNUM)
            x = _features(w, strings, odds)
            y = (x.max(axis=0) >= CLEAR) & (block.column("toxic").to_numpy()[w.doc] == 1)
            place = np.arange(len(w.doc)) - np.searchsorted(w.doc, w.doc)
            name, at = np.unique(w.doc * (1 << 40) + place // STRETCH, return_inverse=True)
            yield x, y, place, at, base + (name >> 40), name & ((1 << 40) - 1)
            base += block.num_rows

    found = []
    for x, y, _, at, doc, number in stretches():
        spoken = np.bincount(at, (x > 0).any(axis=0), minlength=len(doc)) > 0
        found.append((doc, number, np.bincount(at, y, minlength=len(doc)) > 0, spoken))
    doc, number, marked, spoken = (np.concatenate([f[j] for f in found]) for j in range(4))
    own = ids[odd][doc]
    offered = spoken | (mix(_code(own, number), 73) % np.uint64(CLEAN_EVERY) == 0)
    weight = np.zeros(len(doc))
    weight[offered] = _stretch_weights(own[offered], number[offered], marked[offered])
    weight[~spoken] *= CLEAN_EVERY
    slot = np.where(weight > 0, np.cumsum(weight > 0) - 1, -1)
    weight = weight[weight > 0]
    full = np.zeros((len(weight), STRETCH, 2 + len(BEGINNINGS)))
    mark, real = np.zeros((2, len(weight), STRETCH), bool)
    first = 0
    for x, y, place, at, doc, _ in stretches():
        to = slot[first + at]
        own = np.flatnonzero(to >= 0)
        where = (to[own], place[own] % STRETCH)
        full[(*where, 0)] = 1
        for kind in range(len(x)):
            full[(*where, kind + 1)] = x[kind][own]
        mark[where], real[where] = y[own], True
        first += len(doc)
    model = blank._replace(strings=strings, odds=odds)
    emission, chain, first = _fit_chain(full, mark, real, weight)
    model = model._replace(emission=emission, chain=chain, first=first)
    z = np.concatenate([f for _, f, _ in _measured(blocks([rest]), model)], axis=1)
    return model._replace(score=_fit_score(z, rest.column("toxic").to_numpy().astype(float)))


def _measured(parts: Iterator[pa.RecordBatch], model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list]]:
    """Blocks with their document features and spans (first and end byte of runs of toxic tokens)."""
    held, tokens = [], 0

    def work():
        e = np.concatenate([h[1] for h in held])
        shift = np.cumsum([0, *(len(h[1]) for h in held)])
        rows = np.cumsum([0, *(h[0].num_rows for h in held)])
        doc = np.concatenate([h[2].doc + r for h, r in zip(held, rows, strict=False)])
        begin = np.searchsorted(doc, np.arange(rows[-1]))
        length = np.searchsorted(doc, np.arange(rows[-1]), "right") - begin
        odds = _chain_odds(e, begin[length > 0], length[length > 0], model.chain, model.first)
        z = _document_features(odds, doc, int(rows[-1]))
        for i, (block, _, w) in enumerate(held):
            hot = np.flatnonzero(odds[shift[i]:shift[i + 1]] >= 1)
            runs: list[tuple[int, int, int]] = []
            last = -2
            for t in hot.tolist():
                if t == last + 1 and runs and runs[-1][0] == w.doc[t]:
                    runs[-1] = (*runs[-1][:2], int(w.end[t]))
                else:
                    runs.append((int(w.doc[t]), int(w.start[t]), int(w.end[t])))
                last = t
            yield block, z[:, rows[i]:rows[i + 1]], [(r, s, t, w) for r, s, t in runs]

    for block in parts:
        w = words(block.column("text"), ALNUM)
        held.append((block, _emissions(w, model), w))
        tokens += len(w.doc)
        if tokens >= PASS_TOKENS:
            yield from work()
            held, tokens = [], 0
    if held:
        yield from work()


def learn(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> Model:
    """Fit on the labelled documents outside the held-out fold, MAX_LABELLED and MAX_BYTES at most.

    A label given several times is toxic if one of them is; labels without a document, with a null id or another value than 0
    and 1 say nothing. Of several texts under one id the smallest counts, a null one as the empty text. Texts are read whole.
    """
    order = F.xxhash64(F.lit("sample"), id_column)
    known = (labels.filter(f"{id_column} is not null and toxic in (0, 1)").groupBy(id_column).agg(F.max("toxic").alias("toxic"))
             .filter(F.crc32(F.col(id_column).cast("string")) % FOLDS != 0).orderBy(order, id_column).limit(MAX_LABELLED))
    # sizes first, so that no text moves that does not fit; window and broadcasts hold MAX_LABELLED narrow rows at most
    sizes = (docs.select(id_column, F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).join(F.broadcast(known), id_column)
             .groupBy(id_column, "toxic").agg(F.max("size").alias("size")))
    known = sizes.withColumn("sum", F.sum("size").over(Window.orderBy(order, id_column))).filter(F.col("sum") <= MAX_BYTES).drop("size", "sum")
    sample = (docs.select(id_column, "text").join(F.broadcast(known), id_column).groupBy(id_column, "toxic").agg(F.min("text").alias("text"))
              .select(F.col(id_column).cast("bigint").alias("id"), F.col("toxic").cast("int").alias("toxic"), F.coalesce("text", F.lit("")).alias("text")))
    table = sample.toArrow().combine_chunks().sort_by("id")
    texts = table.column("text")
    texts = texts.combine_chunks() if table.num_rows else pa.array([], pa.string())
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    return fit(texts, table.column("toxic").to_numpy(), table.column("id").to_numpy())


def score(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, score, spans) of every row; spans are toxic stretches in code points.

    Only the text is read. A null or empty text has no tokens and gets the score of a text without any sign, which is low.
    Repeated rows give equal rows; a null id gives a row. An empty table gives none. Without labels of both kinds the
    score is the share of toxic labels, the same for all.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for block, z, runs in _measured(blocks(batches), model):
            spans: list[list] = [[] for _ in range(block.num_rows)]
            if runs:
                w = runs[0][3]
                lead = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
                for row, start, end, _ in runs:
                    spans[row].append({"start": int(lead[start] - lead[w.offsets[row]]), "end": int(lead[end] - lead[w.offsets[row]])})
            p = 1 / (1 + np.exp(-np.clip(model.score @ z, -30, 30)))
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(p), pa.array(spans, kind)], names=["id", "score", "spans"])

    source = docs.select(F.col(id_column).alias("id"), "text")
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, score double, spans array<struct<start:bigint,end:bigint>>").withColumnRenamed("id", id_column)
