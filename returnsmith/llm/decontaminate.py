"""Benchmark passages in documents: a prefix-filtered set join with exact containment, in DataFrame functions only.

A window is 13 consecutive words of an item (or the whole of a shorter item); its tokens are its shingles of five
words. A document contains a window only if it contains all its tokens, so the necessary prefix of a containment
of 1 is a single token: the one that is rarest in the documents. Document positions are joined to windows by that token
alone; its place in the window gives the only possible start (positional bound), the window must fit there (length
bound), and its words are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.session import settle

WINDOW = 13
SHINGLE = 5
#: A table of the benchmark's tokens is broadcast up to so many rows (about 16 bytes each), else shuffled.
BROADCAST_ROWS = 1_000_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A-Z lowered; cut at everything but digits, a-z and what is not ASCII. The first and last piece may be empty.
PIECES = (f"split(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), "
          r"'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


def _token(array: str, at: str, size: int) -> str:
    return "xxhash64(" + ", ".join(f"get({array}, {at} + {j})" for j in range(size)) + ")"


def _lookup(df: DataFrame) -> DataFrame:
    """A settled lookup side, broadcast only if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def windows(bench: DataFrame, item_column: str = "item_id", size: int = WINDOW) -> DataFrame:
    """(item, win): every window of every item, as an array of words. Items without words have none."""
    return (bench.select(F.col(item_column).alias("item"), F.expr(f"array_remove({PIECES}, '')").alias("w"))
            .filter("size(w) > 0")
            .selectExpr("item", "w", f"explode(sequence(0, greatest(0, size(w) - {size}))) i")
            .selectExpr("item", f"slice(w, i + 1, {size}) win"))


def occurrences(docs: DataFrame, bench: DataFrame, id_column: str = "doc_id", item_column: str = "item_id",
                size: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, n_words), occurrences (doc_id, start, win) and windows (win, item), each once."""
    wins = settle(windows(bench, item_column, size).distinct(), "windows")
    each = wins.select("win").distinct().withColumn("m", F.size("win"))
    sizes = sorted({shingle, *(r["m"] for r in each.filter(F.col("m") < shingle).select("m").distinct().collect())})
    tokens = settle(each.selectExpr("win", "m", f"explode(sequence(0, m - least(m, {shingle}))) off").withColumn(
        "tok", F.expr("case least(m, %d) %s end" % (
            shingle, " ".join(f"when {k} then {_token('win', 'off', k)}" for k in range(1, shingle + 1))))), "tokens")
    known = _lookup(settle(tokens.select("tok").distinct().withColumn("known", F.lit(True)), "known"))
    lead = size - min(sizes)  # words before a token that a window may hold
    at = (docs.select(F.col(id_column).alias("doc_id"), F.expr(PIECES).alias("w"))
          .selectExpr("doc_id", "w", f"explode(sequence(0, greatest(0, size(w) - {min(sizes)}))) i"))
    if len(sizes) == 1:
        at = at.withColumn("tok", F.expr(_token("w", "i", shingle)))
    else:
        at = at.withColumn("tok", F.explode(F.array_distinct(F.array(*(F.expr(_token("w", "i", k)) for k in sizes)))))
    # one pass over the texts: positions whose token some window has, and each text's first position for its length
    seen = settle(at.join(known, "tok", "left").filter("known or i = 0").selectExpr(
        "doc_id", "i", "case when known then tok end tok",
        "size(w) - cast(w[0] = '' as int) - cast(size(w) > 1 and element_at(w, -1) = '' as int) n_words",
        f"greatest(0, i - {lead}) a", f"case when known then slice(w, greatest(0, i - {lead}) + 1, {lead} + {size}) end near"),
        "positions")
    counts = seen.filter("tok is not null").groupBy("tok").agg(F.count(F.lit(1)).alias("freq"))
    prefix = _lookup(settle(tokens.join(counts, "tok").groupBy("win", "m").agg(
        F.min_by(F.struct("tok", "off"), F.struct("freq", "tok", "off")).alias("p"),
        F.count(F.lit(1)).alias("present")).filter(f"present = m - least(m, {shingle}) + 1")
        .select("win", "m", "p.tok", "p.off"), "prefix"))
    found = (seen.filter("tok is not null").join(prefix, "tok").withColumn("start", F.expr("i - off"))
             .filter("start >= a and start + m <= a + size(near) and slice(near, start - a + 1, m) = win")
             .select("doc_id", "start", "win").distinct())
    return seen.groupBy("doc_id").agg(F.max("n_words").cast("long").alias("n_words")), settle(found, "occurrences"), wins


def decontaminate(docs: DataFrame, bench: DataFrame, id_column: str = "doc_id", item_column: str = "item_id",
                  size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated), one row per id.

    A word inside any occurrence of a window is hit; ``items`` are the ids, as sorted strings, of the items that have an
    occurring window; contaminated means that a twentieth of the words or more are hit. A null or empty text has no
    words and is clean. Rows that share an id (null is one too) count as one document: its occurrences are united and
    its length is the longest. Items without words find nothing; items without an id find words but are not
    listed. Either table may be empty. Other columns are not looked at.
    """
    lengths, found, wins = occurrences(docs, bench, id_column, item_column, size, shingle)
    hits = (found.selectExpr("doc_id", "explode(sequence(start, start + size(win) - 1)) pos").distinct()
            .groupBy("doc_id").agg(F.count(F.lit(1)).alias("hit")).withColumnRenamed("doc_id", "h_id"))
    items = (found.select("doc_id", "win").distinct().join(wins, "win").select("doc_id", F.col("item").cast("string"))
             .distinct().groupBy("doc_id").agg(F.sort_array(F.collect_set("item")).alias("items"))
             .withColumnRenamed("doc_id", "i_id"))
    return (lengths.join(hits, F.expr("doc_id <=> h_id"), "left").join(items, F.expr("doc_id <=> i_id"), "left")
            .select("doc_id", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words")))


def keep_clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that are not contaminated. Rows that share an id, a null one too, go together if one of them goes."""
    bad = decontaminate(docs, bench).filter("contaminated").select("doc_id")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")
