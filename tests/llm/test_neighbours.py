import numpy as np
import pytest

from returnsmith.llm import neighbours
from returnsmith.llm.queries import op13_nearest

SCHEMA = "vec_id bigint, embedding array<float>, node string, q string, ids string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "a", "b", "c")
                                  for i, v in rows], SCHEMA)


def exact(rows, asked, k):
    x = np.array([v for _, v in rows], np.float32).astype(float)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in asked:
        s = np.einsum("ij,j->i", x, x[np.flatnonzero(ids == q)[0]])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), s[j]) for j in order]
    return out


def told(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def clustered(n, seed, centres=40, spread=0.5):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, 24))
    x = c[rng.integers(centres, size=n)] + spread * rng.normal(size=(n, 24))
    return x * rng.uniform(0.5, 2, (n, 1))  # norms differ: the largest product is not the smallest angle


@pytest.mark.parametrize("copies", [0, 900])
def test_recall_over_several_blocks(spark, monkeypatch, copies):
    monkeypatch.setattr(neighbours, "BLOCK", 256)
    monkeypatch.setattr(neighbours, "REQUESTS", 40)
    x = clustered(2500, 4)
    if copies:  # a third of all rows are one vector
        x[np.random.default_rng(1).choice(len(x), copies, replace=False)] = x[7]
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32))]
    df = vectors(spark, rows).repartition(6)
    want = exact(rows, range(0, len(rows), 20), 20)
    got = told(neighbours.nearest(df, df.filter("vec_id % 20 = 0")))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    for q, found in got.items():
        assert found == sorted(found, key=lambda r: (-r[1], r[0])) and q not in dict(found)
        for i, s in found[:3]:
            assert abs(s - float(rows[i][1].astype(float) @ rows[q][1].astype(float))) < 1e-12


def test_few_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0, 0]), (2, [0.5, 0.5, 0]), (3, None), (4, []), (5, [0, 0, 0]), (6, [nan, 1, 0]), (7, [inf, 0, 1]), (8, [None, 1, 0]),
            (None, [1, 1, 1]), (9, [1, 0, 0]), (9, [1, 0, 0]), (10, [-1, 0, 0]), (11, [2, 0]), (20, [1, 0, 0]), (20, [-5, 0, 0])]
    df = vectors(spark, rows)
    got = told(neighbours.nearest(df, df, k=3))
    assert set(got) == {1, 2, 9, 10, 11, 20}
    assert got[1] == [(11, 2.0), (9, 1.0), (2, 0.5)] and got[11] == [(1, 2.0), (9, 2.0), (2, 1.0)]
    assert got[20] == [(10, 5.0), (2, -2.5), (1, -5.0)]  # of its two vectors the smaller one
    assert neighbours.nearest(df.limit(0), df).count() == 0 and neighbours.nearest(df, df.limit(0)).count() == 0
    assert told(neighbours.nearest(df.limit(1), df.limit(1))) == {}
    outside = vectors(spark, [(500, [0, 1, 0])])
    assert told(neighbours.nearest(df, outside, k=2)) == {500: [(2, 0.5), (1, 0.0)]}


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r[0], np.array(r[1])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = told(op13_nearest(spark, folder))
    want = exact(rows, [i for i, _ in rows if i % 20 == 0], 20)
    assert recall(got, want) >= 0.99 and set(got) == set(want)
