"""Quality rules whose cutoffs come with a guarantee: on labelled holdouts, exact binomial bounds limit false rejections.

For each rule and stratum (language) the labelled good documents are a holdout. Cutoffs are tested from the mildest on, in
a fixed sequence: a cutoff is accepted while the chance of seeing so few good documents above it, were the rate of false
rejections as high as allowed, is at most the error level; the first failure ends the sequence. The level is
divided by the number of sequences (Bonferroni), and a stratum's allowed rate by the number of rules, so that with
probability 1 - DELTA no stratum loses more than ALPHA of its good documents to the learnt rules.

The bound is about independent trials, which copies are not. So good documents that are alike, those with the same smallest hash
of five-word shingles, are one trial of their stratum: always equal texts, and near copies with the chance of their
similarity. Documents that share that shingle by chance are one trial too, which makes a holdout smaller, not a bound wrong.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.text import SPACED, blocks, byte_table, mix, raw_bytes, shingles, words
from returnsmith.session import settle

ALPHA = 0.02
DELTA = 0.05
#: Rates are compared in thousandths.
GRID = 1000
#: The thresholds of so many strata are broadcast; beyond that they are joined by a shuffle.
BROADCAST_STRATA = 100_000

# The base rules.
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"

#: Each rule is a rate that is higher in worse texts, in thousandths and at most GRID.
RULES = {
    "symbols": "n_symbols * 1000 div greatest(word_chars, 1)",
    "repeats": "n_repeat_words * 1000 div greatest(n_words, 1)",
    "lines": "n_dup_lines * 1000 div greatest(n_lines, 1)",
    "capitals": "n_capitals * 1000 div greatest(word_chars, 1)",
    "marks": "n_marks * 1000 div greatest(n_words, 1)",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_marks")

_IS_SYMBOL = ~byte_table([(ord(c), ord(c)) for c in SYMBOLS])
_IS_MARK = ~byte_table([(ord(c), ord(c)) for c in "!?"])
_IS_CAPITAL = ~byte_table([(65, 90)])
_WHITE = " \t\n\r\x0b\x0c"


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated_words(w, n: int) -> np.ndarray:
    """Words that lie in a window of three words which the row has twice or more, letter case included."""
    row, at, h = shingles(w, 3)
    full = np.flatnonzero(np.bincount(w.doc, minlength=n)[row] >= 3)
    row, at, h = row[full], at[full], h[full]
    key = mix(h ^ mix(row.astype(np.uint64), 31), 32)
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    hit = np.zeros(len(w.doc), bool)
    for j in range(3):
        hit[at[twice] + j] = True
    return np.bincount(w.doc, hit, minlength=n).astype(np.int64)


def _lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those among them that equal an earlier one."""
    if not text:
        return 0, 0
    filled = [line for line in text.split("\n") if line.strip(_WHITE)]
    return len(filled), len(filled) - len(set(filled))


def metrics(docs: DataFrame, id_column: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """(doc_id, stratum, counts, likeness) of every row; likeness is the smallest hash of the text's five-word shingles."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            texts = block.column("text")
            n = block.num_rows
            w = words(texts, SPACED, lower=False)
            raw, offsets = raw_bytes(texts)
            lines = np.array([_lines(t) for t in texts.to_pylist()], np.int64).reshape(n, 2)
            inside = SPACED[raw] & ((raw & 0xC0) != 0x80)
            columns = [np.bincount(w.doc, minlength=n), _per_row(inside, offsets), _per_row(_IS_SYMBOL[raw], offsets),
                       lines[:, 1], _repeated_words(w, n), lines[:, 0], _per_row(_IS_CAPITAL[raw], offsets),
                       _per_row(_IS_MARK[raw], offsets)]
            row, _, shingle = shingles(w)
            likeness = np.zeros(n, np.uint64)
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
            if len(row):
                likeness[row[first]] = np.minimum.reduceat(shingle, first)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("stratum"),
                                              *(pa.array(c, pa.int64()) for c in columns), pa.array(likeness.view(np.int64))],
                                             names=["doc_id", "stratum", *COUNTS, "likeness"])

    source = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(count, f"doc_id {kind}, stratum string, " + ", ".join(f"{c} bigint" for c in (*COUNTS, "likeness")))


def binomial_at_most(k: int, n: int, p: float) -> float:
    """The chance of at most k successes in n trials."""
    if k >= n:
        return 1.0
    total = 0.0
    for i in range(k + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                          + i * math.log(p) + (n - i) * math.log1p(-p))
        if total >= 1:
            return 1.0
    return total


def certified_cutoff(counts: np.ndarray, alpha: float, level: float) -> int | None:
    """The lowest cutoff that the fixed sequence accepts, or None; ``counts[v]`` good documents have value v."""
    n, above, accepted = int(counts.sum()), 0, None
    for cutoff in range(len(counts) - 1, -1, -1):
        if binomial_at_most(above, n, alpha) > level:
            break
        accepted = cutoff
        above += int(counts[cutoff])
    return accepted


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): documents above a cutoff are rejected. Strata without enough good labels have none.

    Of good documents that are alike, the one whose id has the smallest hash stands for all.
    """
    good = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1")
    held = (measured.join(good.select("doc_id"), "doc_id", "left_semi").groupBy("stratum", "likeness")
            .agg(F.min(F.struct(F.xxhash64("doc_id").alias("h"), *COUNTS)).alias("one")).select("stratum", "one.*"))
    values = F.array(*(F.struct(F.lit(name).alias("rule"), F.least(F.expr(rate), F.lit(GRID)).cast("int").alias("value"))
                       for name, rate in RULES.items()))
    table = settle(held.select("stratum", F.explode(values).alias("v")).select("stratum", "v.*").groupBy(
        "stratum", "rule", "value").agg(F.count(F.lit(1)).alias("n")), "holdout")
    level = delta / max(1, table.select("stratum", "rule").distinct().count())

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(GRID + 1, np.int64)
        np.add.at(counts, pdf["value"].to_numpy(), pdf["n"].to_numpy())
        cutoff = certified_cutoff(counts, alpha / len(RULES), level)
        return pd.DataFrame({"stratum": pdf["stratum"][:1], "rule": pdf["rule"][:1], "cutoff": cutoff}).dropna()

    return table.groupBy("stratum", "rule").applyInPandas(choose, "stratum string, rule string, cutoff int")


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", stratum: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(doc_id, counts, base_failed, failed_rule, kept) of every row.

    A document is rejected if it has fewer than 50 words, if more than half of its words lie in repeated windows
    of three, or if a learnt rule of its stratum rejects it. A null or empty text has no words and is rejected; a null stratum
    is a stratum of its own; a stratum without labels, or with too few, has base rules only. A label given several
    times counts as good if one of them is; labels without a document, or without an id, say nothing. Repeated rows
    and null ids each give a row. An empty table gives none. Other columns are not looked at.
    """
    measured = settle(metrics(docs, id_column, stratum), "metrics")
    rules = settle(cutoffs(measured, labels, alpha, delta).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")), "cutoffs")
    if rules.count() <= BROADCAST_STRATA:
        rules = F.broadcast(rules)
    failed = F.coalesce(*(F.expr(f"case when least({rate}, {GRID}) > cutoffs['{name}'] then '{name}' end")
                          for name, rate in RULES.items()))
    return (measured.join(rules, "stratum", "left")
            .withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"))
            .withColumn("failed_rule", failed).withColumn("kept", F.expr("not base_failed and failed_rule is null"))
            .select("doc_id", *COUNTS, "base_failed", "failed_rule", "kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep. Rows that share an id go or stay together: all stay if one is kept."""
    kept = judge(docs, labels).filter("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")
