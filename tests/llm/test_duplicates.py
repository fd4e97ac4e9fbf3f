import itertools
import random

import pytest

from returnsmith.llm import components, jaccard_join, suffix_dedup
from tests.llm.cases import frame, messy, spaced


def shingle_set(text, k=5):
    w = spaced(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        at = rng.randrange(len(out))
        out[at:at + rng.choice([0, 1, 1])] = [f"n{rng.randrange(10**6)}"] * rng.choice([0, 1, 1])
    return out


def test_near_duplicates_equal_brute_force(spark):
    rng, rows = random.Random(5), []
    for size in [1, 3, 5, 6, 7, 8, 9, 10, 12, 14, 17, 20, 25, 30, 40, 60, 61, 90, 150, 400]:
        base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
        for _ in range(14):  # chains of edits: similarities on both sides of the bound
            base = edited(rng, base, rng.choice([0, 1, 1, 2, max(1, size // 60)])) or base
            rows.append((len(rows), " ".join(base)))
    common = [f"p{i}" for i in range(60)]
    rows += [(len(rows) + i, " ".join(common + [f"u{rng.randrange(10**6)}" for _ in range(200)])) for i in range(60)]
    rng.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_of_messy_rows(spark):
    got = jaccard_join.near_duplicates(frame(spark, messy())).collect()
    assert len(got) == len(messy())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    assert by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[4] == [(0, 4)]
    assert {by[i][0][1] for i in (1, 5, 6, 12)} == {1}
    assert sorted(by[None], key=str) == [(0, None), (116, 1)]
    assert by[10] == [(1, 10), (1, 10)]


def test_keep_one_keeps_the_first_of_each_group(spark):
    kept = jaccard_join.keep_one(frame(spark, messy()))
    assert kept.columns == frame(spark, []).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 7, 8, 9, 10, 10, 11, 13] and ids.count(None) == 2


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_sketch_distance_is_a_lower_bound():
    import numpy as np
    rng = np.random.default_rng(1)
    for _ in range(50):
        s = np.unique(rng.integers(0, 2**63, 500, dtype=np.uint64))
        t = np.unique(np.concatenate([s[rng.integers(0, 60):], rng.integers(0, 2**63, 30, dtype=np.uint64)]))
        wide, narrow = jaccard_join._bits(s, 16), jaccard_join._bits(t, 4)
        apart = int(np.bitwise_count(jaccard_join._fold(wide, 4) ^ narrow).sum())
        assert apart <= len(np.setxor1d(s, t))


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 50), (200, 60), (60, 61)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 200: 50, 50: 50, 60: 50, 61: 50}


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for s in range(len(body) - length + 1):
            w = body[s:s + length]
            if w in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(w)
        out[i] = (len(body), bytes(x for x, g in zip(body, gone) if not g), sum(b > a for a, b in zip([0, *gone], gone)))
    return out


@pytest.mark.parametrize("segment", [1 << 20, 700])
def test_remove_repeats_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    monkeypatch.setattr(suffix_dedup, "BLOCK_READS", 50)
    monkeypatch.setattr(suffix_dedup, "RUN_READS", 70)
    rng = random.Random(3)
    passage = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (99, 100, 101, 250, 900)]
    rows = []
    for i in range(80):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.choice([0, 20, 150, 600])))
        rows.append((i, own + rng.choice(passage) + own[::-1] + rng.choice(passage)[:rng.randrange(1, 900)] + rng.choice(["", "xy" * 200])))
    rows += [(100, "q" * 1000), (101, "q" * 99), (102, "q" * 350), (103, rows[7][1]), (104, rows[7][1]), (105, None), (106, ""),
             (107, "🙂" * 60 + "z" + "🙂" * 60)]
    rng.shuffle(rows)
    got = suffix_dedup.remove_repeats(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_bytes"], bytes(r["kept"]), len(r["spans"])) for r in got} == brute_repeats(rows)


def test_remove_repeats_of_messy_rows(spark):
    got = suffix_dedup.remove_repeats(frame(spark, messy())).collect()
    assert len(got) == len(messy())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    text = messy()[0][1]
    assert by[1]["kept"] == b"" and by[5]["kept"] == b""  # the row with a null id comes before
    assert sorted(bytes(r["kept"]) for r in got if r["doc_id"] is None) == [b"", text.encode()]
    assert bytes(by[9]["kept"]) == b"z" and by[2]["n_bytes"] == 0
