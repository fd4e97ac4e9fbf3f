"""Rows every operator must take: nulls, empty and very long texts, repeats, columns with clashing names."""

import random
import re

EXTRA = ("node", "key", "label", "ids", "w", "i", "tok", "n_words", "spans", "id", "h1", "chunk", "stratum", "decoded", "bits", "doc")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *EXTRA]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in EXTRA)


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}x" for _ in range(n)]


def frame(spark, rows):
    """Documents (id, text[, lang]) with extra columns whose names the operators use inside."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *(f"x{j}" for j in range(len(EXTRA)))) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def messy():
    a = " ".join(words(120, 1))
    near = a.split()
    near[60] = "changed"
    return [(1, a), (2, None), (3, ""), (4, " \n\t "), (5, a), (6, " ".join(near)), (None, None), (None, a), (7, "É à Ünïcode ß 漢字 🙂 " * 9),
            (8, " ".join(words(30_000, 2))), (9, "z" * 300_000), (10, "a"), (10, "a"), (11, None, None), (12, a.upper(), None), (13, "one two")]


def spaced(text):
    return (text or "").encode().lower().split()


def alnum(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
