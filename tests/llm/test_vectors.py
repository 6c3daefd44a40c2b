"""Operators over vectors against brute force, and their defined edge cases."""

import numpy as np
import pytest
from pyspark.sql import Row

from quarry.llm import annsearch, rpforest
from quarry.llm.common import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rid string"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((300, 16))
    near = centre[:100] + rng.standard_normal((100, 16)) * 0.08
    rows = [(i, [float(x) for x in r], 0, "v", "r") for i, r in enumerate(np.concatenate([centre, near]).astype(np.float32))]
    rows += [(400, rows[0][1], 1, "v", "r"), (400, rows[0][1], 1, "v", "r"), (None, rows[0][1], 1, None, None), (401, None, 1, None, None),
             (402, [0.0] * 16, 1, None, None), (403, [float("nan")] * 16, 1, None, None), (404, [1.0, 2.0], 1, None, None),
             (405, [], 1, None, None), (406, [None] * 16, 1, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_forest_links_and_components(spark, vectors):
    rows, df = vectors
    good = [r for r in rows if r[1] and len(r[1]) == 16 and r[1][0] is not None and np.isfinite(r[1]).all() and any(r[1])]
    u = np.array([r[1] for r in good], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    with Scratch(spark, "t") as s:
        got = rpforest.near_duplicates(df, s).collect()
        assert len(got) == len(rows)
        assert sum(r["n_links"] for r in got) == link.sum()
        by_id = {r["vec_id"]: r for r in got}
        assert by_id[400]["component_id"] == 0 and by_id[0]["kept"] and not by_id[300]["kept"]
        assert all(by_id[i]["n_links"] == 0 and by_id[i]["component_id"] == i for i in (401, 402, 403, 404, 405, 406))
    with Scratch(spark, "t") as s:
        assert rpforest.near_duplicates(df.where("vec_id = -1"), s).count() == 0


def test_forest_splits_chunks_and_dense_tiles(spark, monkeypatch):
    """3,300 vectors: split leaves led down in several chunks, and a dense group of more than a tile."""
    monkeypatch.setattr(rpforest, "CHUNK", 1000)
    rng = np.random.default_rng(4)
    pairs = np.repeat(rng.standard_normal((1000, 24)), 2, axis=0) + rng.standard_normal((2000, 24)) * 0.15
    dense = rng.standard_normal(24) + rng.standard_normal((1300, 24)) * 0.1
    v = np.concatenate([pairs, dense]).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    with Scratch(spark, "t") as s:
        got = rpforest.near_duplicates(df, s).toPandas().sort_values("vec_id", ignore_index=True)
        assert not {n.split("-")[0] for n in s.names} & {"nodes", "fits", "sizes", "leaves", "listed"}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    want = link.sum(axis=1)
    assert (got["n_links"] <= want).all() and got["n_links"].sum() >= 0.95 * want.sum()  # 0.962: a cut through a dense group loses some
    assert (got["component_id"][2000:] == 2000).all() and (got["n_links"][:2000] == want[:2000]).mean() > 0.99
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()


def test_leaves_of_several_rounds_are_whole(spark):
    """A sample too small for even cuts: some leaves are split on while others are done."""
    v = np.random.default_rng(6).standard_normal((1500, 12))
    df = spark.createDataFrame([(i + 100_000, [float(x) for x in r]) for i, r in enumerate(v)], "rid long, v array<double>")
    with Scratch(spark, "t") as s:
        got = rpforest.leaves(df, s, trees=3, leaf=100, sample=60).toPandas()
    assert set(got["rid"]) == set(range(100_000, 101_500)) and set(got["tree"]) == {36, 37, 38}
    assert not got.duplicated().any() and (got.groupby("rid")["tree"].nunique() == 3).all()
    assert got.groupby(["tree", "node"]).size().max() <= 100


def test_prefix_forest_recall_and_ties(spark, vectors):
    rows, df = vectors
    usable = annsearch.usable(df)
    with Scratch(spark, "t") as s:
        got = annsearch.search(usable, usable.where("vec_id % 50 = 0"), s, trees=16, block=64).toPandas()
    ids = np.array([r[0] for r in rows if r[0] is not None and r[1] and len(r[1]) == 16 and r[1][0] is not None
                    and np.isfinite(r[1]).all() and any(r[1])])
    u = np.array([r[1] for r in rows if r[0] in set(ids) and r[0] is not None], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = all_ = 0
    for q in sorted(set(got["query_id"])):
        own = got[got["query_id"] == q].sort_values("rank")
        near = {}
        for i, x in zip(ids, u @ u[list(ids).index(q)], strict=True):
            if i != q:
                near[i] = max(near.get(i, -2), x)
        true = sorted(near, key=lambda i: (-near[i], i))[:5]
        assert np.all(np.diff(own["score"]) <= 0) and q not in set(own["vec_id"]) and own["vec_id"].is_unique
        assert all(abs(near[i] - x) < 1e-9 for i, x in zip(own["vec_id"], own["score"], strict=True))
        hit, all_ = hit + len(set(true) & set(own["vec_id"])), all_ + len(true)
    assert hit / all_ >= 0.9
    with Scratch(spark, "t") as s:
        assert annsearch.search(usable.where("vec_id = -1"), usable.where("vec_id = -1"), s, trees=4).count() == 0


def exact(ids: np.ndarray, v: np.ndarray, query: int, k: int = 5) -> list[int]:
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    at = int(np.flatnonzero(ids == query)[0])
    near = u @ u[at]
    near[at] = -2
    return list(ids[np.lexsort((ids, -np.round(near, 12)))[:k]])


def recall(got, ids: np.ndarray, v: np.ndarray, queries: np.ndarray) -> float:
    assert set(got["query_id"]) == set(queries) and (got.groupby("query_id").size() == 5).all()
    own = got.groupby("query_id")["vec_id"].agg(set)
    return sum(len(own[q] & set(exact(ids, v, q))) for q in queries) / (5 * len(queries))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall_on_whole_tables(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").toPandas()
    ids, v = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    got = annsearch.op4_ann_search(spark, path).toPandas()
    assert recall(got, ids, v, ids[ids % 50 == 0]) >= 0.9


def test_clustered_vectors_stop_early_with_recall(spark):
    """Clusters of 40 vectors far apart: found at long prefixes, far from all of the table."""
    rng = np.random.default_rng(5)
    v = (np.repeat(rng.standard_normal((100, 32)), 40, axis=0) + rng.standard_normal((4000, 32)) * 0.1).astype(np.float32)
    ids = np.arange(4000)
    df = annsearch.usable(spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "vec_id long, embedding array<float>"))
    with Scratch(spark, "t") as s:
        got = annsearch.search(df, df.where("vec_id % 50 = 0"), s, first=256).toPandas()
        last = [n for n in s.names if n.startswith("after-")][-1]
        stopped = spark.read.parquet(f"{s.root}/{last}").agg({"level": "min"}).first()[0]
    assert stopped >= 4
    assert recall(got, ids, v.astype(float), ids[ids % 50 == 0]) >= 0.9


def test_ties_of_the_fifth_place_go_to_the_smaller_id(spark):
    """300 equal vectors over many blocks: each query gets the five smallest other ids."""
    rows = [Row(vec_id=i, embedding=[1.0, 2.0, -1.0]) for i in range(300)] + [Row(vec_id=900, embedding=[-1.0, 0.5, 3.0])]
    df = annsearch.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    with Scratch(spark, "t") as s:
        got = annsearch.search(df, df.where("vec_id in (0, 3, 250)"), s, trees=8, block=32).toPandas()
    found = got.sort_values("rank").groupby("query_id")["vec_id"].agg(list)
    assert found[0] == [1, 2, 3, 4, 5] and found[3] == [0, 1, 2, 4, 5] and found[250] == [0, 1, 2, 3, 4]


def test_level_needed_falls_with_the_angle(spark):
    row = spark.range(1).select(*[annsearch.level_needed(x, 20, 40, 0.92).alias(n) for n, x in {
        "same": annsearch.F.lit(1.0), "near": annsearch.F.lit(0.9), "far": annsearch.F.lit(0.35), "away": annsearch.F.lit(-1.0),
        "none": annsearch.F.lit(None).cast("double")}.items()]).first()
    assert row["same"] == 20 and 20 >= row["near"] > row["far"] == 5 and row["away"] == 0 and row["none"] == 0
