import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from returnsmith.llm import collocations
from returnsmith.llm.oracle import ORACLE
from returnsmith.llm.queries import op12_collocations
from tests.llm.cases import frame, messy


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(rows):
    f = Counter()
    for r in rows:
        lang = (r[2] if len(r) > 2 else "en") or "und"
        for w in pieces(r[1]):
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    return f


def brute(rows, least, covered=80, top=2000):
    f, out, n = counted(rows), {}, Counter()
    for (lang, p), c in f.items():
        n[lang] += c * (len(p) == 1)
    cand = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    gone = set()
    for (lang, p), c in cand.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                if 100 * c >= covered * f[lang, p[i:i + m]]:
                    gone.add((lang, p[i:i + m]))
    for (lang, p), a in cand.items():
        if (lang, p) not in gone:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((" ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    return sorted((lang, i + 1, *r) for lang, rows in out.items()
                  for i, r in enumerate(sorted(rows, key=lambda r: (-r[5], -r[1], r[0].encode()))[:top]))


def cases():
    rng = random.Random(8)
    few = ["The", "of", "new", "york", "\x00z", "é", "漢字", "a"]
    rows = [r[:3] for r in messy()]
    for i in range(200):
        text = "".join(rng.choice(few) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(60)))
        rows.append((100 + i, text, rng.choice(["en", "de", None])))
    return rows


def test_phrases_equal_brute_force(spark, monkeypatch):
    rows = cases()
    want = brute(rows, 5)
    assert len(want) > 30
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows).withColumn("phrase", F.lit("x")), least=5).collect())
    assert got == want
    monkeypatch.setattr(collocations, "SHARD_BYTES", 2000)  # many shards and ranges that cut through prefixes
    monkeypatch.setattr(collocations, "RANGE_ENTRIES", 300)
    few = frame(spark, rows).repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(few, least=5, top=40).collect())
    assert got == brute(rows, 5, top=40)
    assert collocations.collocations(frame(spark, [])).count() == 0


def test_counts_of_one_hot_phrase(spark, monkeypatch):
    """A phrase that every range holds: its prefixes are summed over the ranges."""
    monkeypatch.setattr(collocations, "RANGE_ENTRIES", 50)
    rows = [(i, f"very common pair w{i} w{i % 50} tail") for i in range(2000)]
    got = {(r["lang"], tuple(r["phrase"].split())): r["f"] for r in collocations.count_phrases(frame(spark, rows).repartition(3), 30).filter(
        "words > 0").collect()}
    assert got == {k: c for k, c in counted(rows).items() if c >= 30}


def test_automata_add_up():
    texts = [["a b c", "a b d. a b", ""], ["a b c c", None, "b a b c d e"]]
    one = collocations.union([collocations.shard(pa.array(t, pa.string())) for t in texts])
    assert one.words.to_pylist() == sorted(one.words.to_pylist())
    rows = collocations._spelled(one, one.ngrams())
    assert rows == sorted(set(rows))
    f = counted([(0, t, "x") for t in texts[0] + texts[1]])
    for depth in range(1, 5):
        first, count = one.prefixes(depth)
        keep = one.ngrams()[first, depth - 1] > 0
        got = {("x", tuple(w.decode() for w in rows[i][:depth])): n for i, n in zip(first[keep].tolist(), count[keep].tolist())}
        assert got == {k: c for k, c in f.items() if len(k[1]) == depth}
    assert int(np.sum(one.weight)) == sum(c for (_, p), c in f.items() if len(p) == 1)


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{folder}/documents.parquet'")
    want = sorted(db.sql(ORACLE["op12_collocations"]).fetchall())
    got = sorted(tuple(r) for r in op12_collocations(spark, folder).collect())
    assert got == want and got
