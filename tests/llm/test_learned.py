import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from returnsmith.llm import quality_rules, toxicity
from returnsmith.llm.queries import op6_toxicity
from returnsmith.session import settle
from tests.llm.cases import frame, messy, spaced, words

SF = "/root/testdata/sf0.1"


def brute_metrics(text):
    text = text or ""
    w = [x.decode() for x in text.encode().split()]
    grams = Counter(tuple(x.lower() if x.isascii() else x for x in w[i:i + 3]) for i in range(len(w) - 2))
    low = spaced(text)
    grams = Counter(tuple(low[i:i + 3]) for i in range(len(low) - 2))
    hit = {i + j for i in range(len(low) - 2) if grams[tuple(low[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_quality_metrics_equal_brute_force(spark):
    rows = [r[:2] for r in messy()] + [(40, "a b c a b c a\nx\nx\n \n \nx y"), (41, "## | <é> % é漢 字 **"), (42, "a a a"), (43, "a a a a")]
    got = quality_rules.judge(frame(spark, rows), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()
    want = [(i, *brute_metrics(t)) for i, t in rows]
    assert sorted([tuple(r)[:6] for r in got], key=str) == sorted(want, key=str)
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert quality_rules.judge(frame(spark, []), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).count() == 0


def test_repeated_windows_are_compared_with_their_case(spark):
    phrase = words(30, 7, 10**6)
    rows = [(1, " ".join(phrase + [w.upper() for w in phrase])), (2, " ".join(phrase + phrase)), (3, "A b c a b c A b c É é É É é É")]
    got = {r["doc_id"]: r for r in quality_rules.judge(frame(spark, rows), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()}
    for i, text in rows:
        w = text.split()
        grams = Counter(tuple(w[j:j + 3]) for j in range(len(w) - 2))
        assert got[i]["n_repeat_words"] == len({j + k for j in range(len(w) - 2) if grams[tuple(w[j:j + 3])] > 1 for k in range(3)})
    assert got[1]["n_repeat_words"] == 0 and got[1]["kept"] and got[2]["n_repeat_words"] == 60 and got[2]["base_failed"]


def test_binomial_bound_and_sequence():
    assert quality_rules.binomial_at_most(0, 10, 0.1) == pytest.approx(0.9 ** 10)
    assert quality_rules.binomial_at_most(10, 10, 0.1) == 1
    counts = np.zeros(1001, int)
    counts[0] = 5000
    assert quality_rules.certified_cutoff(counts, 0.01, 0.01) == 0  # none above 0, so everything else may go
    counts[500] = 100
    assert quality_rules.certified_cutoff(counts, 0.01, 0.01) == 500
    assert quality_rules.certified_cutoff(np.eye(1, 1001, 0, dtype=int)[0] * 20, 0.01, 0.01) is None  # too few to say


def test_rules_reject_bad_and_spare_good(spark):
    rng, rows, labels = random.Random(2), [], []
    for i in range(4000):
        bad = i % 10 == 0
        text = " ".join(w + ("$$$" if bad else "") for w in words(60, i, 10**6))
        rows.append((i, text, "en" if i % 2 else None))
        if rng.random() < 0.9:
            labels += [(i, int(not bad), 0)] * rng.choice([1, 2])
    labels += [(None, 1, 0), (10**9, 1, 0)]
    judged = quality_rules.judge(frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert all(kept[i] == (i % 10 != 0) for i in range(4000))
    left = quality_rules.keep_good(frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert left.count() == 3600 and left.columns == frame(spark, []).columns


def test_copies_do_not_change_a_cutoff(spark):
    """Good documents that are alike are one trial; the cutoffs are those of a plain search over single documents."""
    rng, rows = random.Random(3), []
    for i in range(2400):
        w = words(80, 5000 + i, 10**6)
        rows.append((i, " ".join(x + ("#" if rng.random() < 0.02 * (i % 5) else "") for x in w), "en" if i % 4 else "de"))
    copies = [(10_000 + i, rows[i % 7][1], rows[i % 7][2]) for i in range(3000)]
    near = [(20_000 + i, rows[i % 7][1] + " tail", rows[i % 7][2]) for i in range(1000)]
    schema = "doc_id bigint, quality int, toxic int"

    def cutoffs(docs):
        labels = spark.createDataFrame([(r[0], 1, 0) for r in docs], schema)
        measured = settle(quality_rules.metrics(frame(spark, docs)), "m")
        return {(r["stratum"], r["rule"]): r["cutoff"] for r in quality_rules.cutoffs(measured, labels).collect()}, measured

    alone, measured = cutoffs(rows)
    assert cutoffs(rows + copies)[0] == alone and alone
    many = cutoffs(rows + copies + near)[0]
    assert all(many.get(k) == v for k, v in alone.items() if k[1] != "symbols") and set(many) == set(alone)
    values = {}
    for r in measured.select("stratum", *[F.expr(f"least({rate}, 1000)").alias(name) for name, rate in quality_rules.RULES.items()]).collect():
        for name in quality_rules.RULES:
            values.setdefault((r["stratum"], name), []).append(r[name])
    level = quality_rules.DELTA / len(values)
    for key, found in values.items():
        want = None
        for cutoff in range(1000, -1, -1):
            above, n, p = sum(v > cutoff for v in found), len(found), quality_rules.ALPHA / len(quality_rules.RULES)
            chance = term = (1 - p) ** n
            for j in range(1, above + 1):
                term *= (n - j + 1) / j * p / (1 - p)
                chance += term
            if chance > level:
                break
            want = cutoff
        assert alone.get(key) == want, key


def test_chain_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    chain, first = np.array([[1.0, 0.2], [0.7, 2.5]]), 0.3
    lengths = [4, 1, 6, 3]
    e = np.exp(rng.normal(size=sum(lengths)))
    begin = np.cumsum([0, *lengths[:-1]])
    got = toxicity._chain_odds(e, begin, np.array(lengths), chain, first)
    for b, n in zip(begin, lengths):
        mass = np.zeros((n, 2))
        for code in range(1 << n):
            y = [(code >> t) & 1 for t in range(n)]
            p = np.prod([e[b + t] if y[t] else 1.0 for t in range(n)]) * (first if y[0] else 1) * np.prod([chain[y[t - 1], y[t]] for t in range(1, n)])
            for t in range(n):
                mass[t, y[t]] += p
        assert np.allclose(got[b:b + n], mass[:, 1] / mass[:, 0])


def test_toxicity_held_out_accuracy_and_folds(spark):
    got = op6_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["predicted"] == r["toxic"] for r in got]) > 0.95


def test_chain_sees_all_documents_when_stretches_are_capped(monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_STRETCHES", 40)
    rng = random.Random(3)
    texts = [" ".join(words(20_000, i)) for i in range(6)]  # clean, long and first
    texts += [" ".join(words(60, i) + ["vileone", "vileish"] * (i % 4 < 2)) for i in range(400)]
    toxic = np.array([int("vile" in t) for t in texts])
    model = toxicity.fit(pa.array(texts), toxic)
    block = pa.record_batch([pa.array([" ".join(words(30, 900) + bad + words(30, 901)) for bad in (["vileone", "vileish"], [])])], names=["text"])
    (_, z, runs), = toxicity._measured(iter([block]), model)
    assert [r[0] for r in runs] == [0]  # one span, in the toxic text
    p = 1 / (1 + np.exp(-model.score @ z))
    assert p[0] > 0.9 and p[1] < 0.1

    doc = np.repeat(np.arange(50) - 25, 200)
    number, marked = np.tile(np.arange(200), 50), np.array([rng.random() < 0.02 for _ in range(10_000)])
    weight = toxicity._stretch_weights(doc, number, marked)
    for sort in (True, False):
        own = (marked == sort)
        offered = sum(min(toxicity.DOC_STRETCHES, n) for n in Counter(doc[own].tolist()).values())
        assert np.sum(weight[own] > 0) == 40 and weight[own].sum() == pytest.approx(offered)
    assert len(set(doc[marked & (weight > 0)])) == 40 and len(set(doc[~marked & (weight > 0)])) > 15
    few = marked & (np.arange(10_000) < 1000)
    assert (toxicity._stretch_weights(doc, number, few)[few] == 1).all()


def test_the_sample_of_labelled_texts_is_bounded_in_bytes(spark, monkeypatch):
    """Very long labelled texts, nulls, repeats and ids without documents: the fit reads no more than its bound."""
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, ids: taken.append((texts.to_pylist(), toxic.tolist(), ids.tolist())))
    rows = [(i, f"{i} " + "x" * 10_000) for i in range(300)] + [(7, "7 shorter"), (301, None), (302, "")]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in [*range(303), 5, 9999]] + [(None, 0, 1), (3, 0, None), (4, 0, 1)],
                                   "doc_id bigint, quality int, toxic int")
    toxicity.learn(frame(spark, rows), labels)
    texts, toxic, ids = taken.pop()
    assert sorted(ids) == ids and all(zlib.crc32(str(i).encode()) % 5 for i in ids) and len(ids) == len(set(ids)) > 200
    assert dict(zip(ids, toxic))[4] == 1 and dict(zip(ids, texts))[301] == "" and dict(zip(ids, texts)).get(7, "7 shorter") in ("7 shorter", rows[7][1])
    monkeypatch.setattr(toxicity, "MAX_BYTES", 500_000)
    toxicity.learn(frame(spark, rows), labels)
    few = taken.pop()
    assert set(few[2]) < set(ids) and 400_000 < sum(map(len, few[0])) <= 500_000


def test_clean_stretches_keep_their_weight(monkeypatch):
    """However few of them are offered, the clean stretches together weigh what there are of them, about."""
    rng = random.Random(5)
    texts = [" ".join(words(1280, i, 10**6) + ["vileone", "vileish"] * (i % 3 == 0)) for i in range(900)]
    rng.shuffle(texts)
    toxic = np.array([int("vile" in t) for t in texts])
    total = []
    monkeypatch.setattr(toxicity, "_fit_chain", lambda x, y, real, weight: total.append(weight.sum()) or (np.zeros(x.shape[2]), np.ones((2, 2)), 1.0))
    for every in (1, 8):
        monkeypatch.setattr(toxicity, "CLEAN_EVERY", every)
        toxicity.fit(pa.array(texts), toxic)
    assert total[1] == pytest.approx(total[0], rel=0.2) and total[0] > 4000


def test_toxicity_spans_and_messy_rows(spark):
    rng = random.Random(1)
    texts = [" ".join(words(60, i) + ([rng.choice(["vileone", "vileish", "nastyfolk"])] * 2 if i % 4 < 2 and i % 8 < 4 else [])) for i in range(400)]
    toxic = np.array([int("vile" in t or "nasty" in t) for t in texts])
    model = toxicity.fit(pa.array(texts), toxic)
    rows = [r[:2] for r in messy()] + [(30, "É fine words then vileones here"), (31, "w1x w2x w3x"), (31, "w1x w2x w3x")]
    got = toxicity.score(frame(spark, rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[30]["score"] > 0.5 and [tuple(s) for s in by[30]["spans"]] == [(18, 26)]  # a word never seen, by its beginning
    assert by[31]["score"] < 0.5 and by[2]["score"] == by[3]["score"] < 0.5
    assert toxicity.score(frame(spark, []), model).count() == 0
    plain = toxicity.fit(pa.array(["a", "b"]), np.array([0, 0]))
    assert toxicity.score(frame(spark, rows), plain).agg(F.count_distinct("score")).first()[0] == 1
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert len(toxicity.learn(frame(spark, rows), empty).strings) == 0
