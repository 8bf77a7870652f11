import numpy as np
import pytest

from runloom.llm import ann as A, range_join as R
from runloom.llm.vectors import components


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) if x is not None else None for x in v] if v is not None else None, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")


def data(n=300, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[50:90] = v[0] + rng.normal(scale=0.05, size=(40, dim))
    v[100:140] = v[1]
    v[150:160] = v[2:12] * 3
    return v


ODD = [(900, None), (901, [0.0] * 8), (902, [1.0, None, *[0.0] * 6]), (903, [float("nan")] + [1.0] * 7), (904, [float("inf")] + [1.0] * 7), (905, []), (None, [1.0] * 8)]


@pytest.mark.parametrize("cell", [40, 8192])
def test_range_join(spark, monkeypatch, cell):
    monkeypatch.setattr(R, "CELL", cell)
    monkeypatch.setattr(R, "BLOCK", cell)
    v = data()
    got = {r["vec_id"]: r for r in R.near_duplicate_vectors(frame(spark, [*enumerate(v), *ODD])).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    label = components(len(v), *np.nonzero(near))
    for i in range(len(v)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (near[i].sum(), label[i], label[i] == i)
    for i, _ in ODD[:-1]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["n_links"] == 0 and len(got) == 307


def test_copies_of_clustered_vectors_stay_flat(spark, monkeypatch):
    monkeypatch.setattr(R, "CELL", 100)
    monkeypatch.setattr(R, "BLOCK", 100)
    rng = np.random.default_rng(5)
    copies = []
    for n in (1000, 5000):
        centres = rng.normal(size=(n // 100, 32))
        v = np.repeat(centres, 100, axis=0) + rng.normal(scale=0.02, size=(n, 32))
        nodes = spark.createDataFrame([(i, 1, [float(x) for x in row], 32) for i, row in enumerate(v)], "rep long, n long, vector array<double>, dim int")
        copies.append(R.replicated(nodes, 0.95).count() / n)
    assert copies[1] < 1.5 * copies[0] + 1 and copies[1] < 10


def test_clashing_names(spark):
    rows = [(i, [1.0, float(i)], i, i, i, 0.5, 1) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep long, n long, cell long, d double, dim int")
    assert R.near_duplicate_vectors(df).count() == 6
    assert A.nearest_neighbours(df.withColumnRenamed("cell", "shard").withColumn("block", df["n"]), df.filter("vec_id = 0 or vec_id is null"), k=3).count() == 3


def test_range_join_dims_repeats_and_empty(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [2.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0])]
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in R.near_duplicate_vectors(frame(spark, rows)).collect())
    assert got == [(1, 3, 1), (2, 0, 2), (3, 3, 1), (4, 3, 1), (4, 3, 1)]
    assert R.near_duplicate_vectors(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("shard", [64, 8192])
def test_nearest(spark, shard):
    v = data()
    df = frame(spark, [*enumerate(v), *ODD])
    rows = A.nearest_neighbours(df, df.filter("vec_id % 10 = 0 or vec_id >= 900"), k=10, shard_rows=shard).collect()
    by = {}
    for r in rows:
        by.setdefault(r["query_id"], []).append(r)
    assert set(by) == set(range(0, 300, 10))
    hits = 0
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(len(v)), d))[:10]
        assert [r["rank"] for r in found] == list(range(1, 11)) and q not in {r["vec_id"] for r in found}
        assert all(abs(r["score"] - d[r["vec_id"]]) < 1e-12 for r in found)
        hits += len({r["vec_id"] for r in found} & set(best.tolist()))
    assert hits / (10 * len(by)) >= 0.97


def test_near_copies_are_told_apart():
    rng = np.random.default_rng(4)
    one = rng.normal(size=64)
    v = np.concatenate([one / np.linalg.norm(one) + 1e-5 * rng.normal(size=(1000, 64)), rng.normal(size=(200, 64)) / 8])
    ids = np.arange(len(v))
    ask = ids[:1000:20]
    q, found, _ = A.Graph(ids, v).nearest(ask, v[ask], 10)
    hits = 0
    for i in ask:
        d = ((v - v[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        hits += len(set(found[q == i].tolist()) & set(np.argsort(d)[:10].tolist()))
    assert hits / (10 * len(ask)) >= 0.9


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in A.op5_ann(spark, "/root/testdata/sf0.1").collect()}
    pdf = df.toPandas()
    v, ids = np.stack(pdf["embedding"].to_numpy()).astype(float), pdf["vec_id"].to_numpy()
    want = set()
    for k in np.flatnonzero(ids % 100 == 0):
        d = ((v - v[k]) ** 2).sum(axis=1)
        d[k] = np.inf
        want |= {(ids[k], ids[j]) for j in np.lexsort((ids, d))[:10]}
    assert len(got & want) / len(want) >= 0.9


def test_few_rows(spark):
    df = frame(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0])])
    got = [(r["rank"], r["vec_id"]) for r in A.nearest_neighbours(df, df.filter("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 1), (3, 2)]
    assert A.nearest_neighbours(df.limit(0), df).count() == 0
    assert A.nearest_neighbours(df, df.limit(0)).count() == 0


def test_components():
    assert components(5, np.array([4, 3]), np.array([3, 1])).tolist() == [0, 1, 2, 1, 1]
