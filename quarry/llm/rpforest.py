"""Embedding near-dedup by a random-projection tree forest.

Each tree splits the vectors recursively at the median of a random direction; vectors whose rank lies within
``spill`` of the median go to both sides.  Trees are fitted on a bounded sample (``sample`` distinct vectors, by a hash;
medians need no more); every vector is then led down every tree.  A leaf that is still larger than ``leaf`` (the sample
does not grow with the data) is split on, level by level, with medians from a bounded sample of that leaf, until its
vectors fit or nearly all of its sample are links anyway; such dense leaves are compared in tiles of bounded size.

Within a leaf all vectors are compared by cosine in double precision, and links are verified there.  A pair that meets
in several trees is counted in the first of them only, which the vectors' lists of leaves tell, so the number of links
needs no table of pairs; each leaf hands on counts and a spanning forest of its links, which are united.

Equal vectors form a class first and are compared once; their links among each other and to others are multiplied out.

Defined cases: vectors null, empty, zero or with null or non-finite components link with nothing; vectors of different
dimensions never link; repeated rows and ids are vectors of their own; a null id has a null component unless its
component holds other ids, and is never kept; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import Scratch, table
from quarry.llm.graph import components

COSINE = 0.9
TREES, SPILL, LEAF, SAMPLE, TILE = 12, 0.05, 512, 16_384, 1024
CHUNK = 16_384  # vectors of a node led down its cuts by one task
SEED = 11


def direction(tree: int, node: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, tree, node, dim]).standard_normal(dim)


def fit_tree(v: np.ndarray, tree: int, root: int, depth: int, spill: float) -> dict[int, tuple[float, float]]:
    """Cuts of the nodes below ``root`` (children of n: 2n and 2n + 1): those at or below ``high`` go left, those above
    ``low`` right; ``low`` and ``high`` are the ranks around the median."""
    cuts: dict[int, tuple[float, float]] = {}
    todo = [(root, v, 0)]
    while todo:
        node, own, d = todo.pop()
        if d == depth or len(own) < 8:
            continue
        x = own @ direction(tree, node, own.shape[1])
        low, high = np.quantile(x, [0.5 - spill, 0.5 + spill])
        if low == x.min() and high == x.max():
            continue
        cuts[node] = (float(low), float(high))
        todo += [(2 * node, own[x <= high], d + 1), (2 * node + 1, own[x > low], d + 1)]
    return cuts


def lead_down(v: np.ndarray, tree: int, root: int, cuts: dict[int, tuple[float, float]]):
    """(row numbers, leaf) of every leaf below ``root`` that holds rows of ``v``."""
    todo = [(root, np.arange(len(v)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if node not in cuts:
            yield rows, node
            continue
        low, high = cuts[node]
        x = v[rows] @ direction(tree, node, v.shape[1])
        todo += [(2 * node, rows[x <= high]), (2 * node + 1, rows[x > low])]


def _unit(values) -> np.ndarray:
    v = np.stack(values).astype(float)
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def links_in(v1, v2, same: bool):
    """Index pairs of links between two tiles (each pair once if they are the same)."""
    s = v1 @ v2.T
    i, j = np.nonzero(s >= COSINE - 1e-9)
    keep = i < j if same else slice(None)
    i, j = i[keep], j[keep]
    exact = (v1[i] * v2[j]).sum(axis=1) if len(i) else np.zeros(0)
    ok = exact >= COSINE
    return i[ok], j[ok]


def spanning(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """(node, smallest node linked with it) over the links of a leaf: at most one row a node."""
    ids, at = np.unique(np.concatenate([nodes[i], nodes[j]]), return_inverse=True)
    a, b = at[:len(i)], at[len(i):]
    root = np.arange(len(ids))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return [(int(n), int(ids[r])) for n, r in zip(ids, root, strict=True) if n != ids[r]]


def _fits(nodes: DataFrame, vectors: DataFrame, sizes: DataFrame, sample: int, leaf: int, spill: float) -> DataFrame:
    """``(tree, node, n, at, low, high)``: the cuts of oversize nodes, each fitted on about ``sample`` of its vectors."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, node, n = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0]), int(pdf["n"].iloc[0])
        v = _unit(pdf.sort_values("rid")["v"])
        near = v[:512] @ v[:512].T >= COSINE
        if node > 1 and near.mean() > 0.5:  # most of its pairs are links: compared in tiles instead
            cuts = {}
        else:
            depth = max(1, int(np.ceil(np.log(n / leaf) / -np.log(0.5 + spill))))
            cuts = fit_tree(v, tree, node, min(depth, 12), spill)
        keys = sorted(cuts)
        return pd.DataFrame({"tree": [tree], "node": [node], "n": [n], "at": [keys], "low": [[cuts[k][0] for k in keys]],
                             "high": [[cuts[k][1] for k in keys]]})

    few = (nodes.join(sizes, ["tree", "node"])
           .where(F.pmod(F.xxhash64("rid", "node"), F.lit(1 << 30)) < F.lit(sample) / F.col("n") * (1 << 30))
           .join(vectors, "rid"))
    return few.groupBy("tree", "node").applyInPandas(
        run, "tree int, node long, n long, at array<long>, low array<double>, high array<double>")


def _led(nodes: DataFrame, vectors: DataFrame, fits: DataFrame) -> DataFrame:
    """Every (rid, tree, node) with a fit moved on to the leaves below it.  A node's vectors go in chunks of about
    ``CHUNK``, and its cuts go once to each chunk."""
    def run(own: pd.DataFrame, fit: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame({"rid": [], "tree": [], "node": []}, dtype="int64")
        first = fit.iloc[0]
        cuts = {int(k): (a, b) for k, a, b in zip(first["at"], first["low"], first["high"], strict=True)}
        rid, v = own["rid"].to_numpy(), _unit(own["v"])
        found = [(rid[rows], np.full(len(rows), leaf, np.int64))
                 for rows, leaf in lead_down(v, int(first["tree"]), int(first["node"]), cuts)]
        rids = np.concatenate([r for r, _ in found])
        return pd.DataFrame({"rid": rids, "tree": np.full(len(rids), int(first["tree"])),
                             "node": np.concatenate([n for _, n in found])})

    chunks = F.ceil(F.col("n") / CHUNK)
    ways = fits.select("tree", "node", chunks.alias("chunks"))
    key = ["tree", "node", "chunk"]
    rows = (nodes.join(ways, ["tree", "node"]).withColumn("chunk", F.pmod(F.xxhash64("rid", "tree"), F.col("chunks")))
            .select("rid", *key).join(vectors, "rid"))
    cuts = fits.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    return rows.groupBy(*key).cogroup(cuts.groupBy(*key)).applyInPandas(run, "rid long, tree int, node long")


def leaves(vectors: DataFrame, scratch: Scratch, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE,
           spill: float = SPILL, rounds: int = 12) -> DataFrame:
    """``(rid, tree, node)``: the leaves of every vector.  A tree number holds the dimension as well."""
    vectors = vectors.select("rid", "v")
    now = vectors.withColumn("dim", F.size("v")).select("rid", F.explode(F.sequence(F.col("dim") * trees, F.col("dim") * trees + trees - 1)).alias("tree"),
                       F.lit(1).cast("long").alias("node"))
    done: list[DataFrame] = []
    for i in range(rounds):
        sizes = scratch.put(now.groupBy("tree", "node").agg(F.count("*").alias("n")).where(F.col("n") > leaf), f"sizes-{i}")
        if not sizes.head(1):
            break
        fits = scratch.put(_fits(now, vectors, sizes, sample if i == 0 else 2048, leaf, spill), f"fits-{i}")
        split = fits.where(F.size("at") > 0)
        # a node without cuts is a leaf for good
        done.append(now.join(split.select("tree", "node"), ["tree", "node"], "left_anti"))
        if not split.head(1):
            now = None
            break
        now = scratch.put(_led(now, vectors, split), f"nodes-{i}")
    out = now
    for x in done:
        out = x if out is None else out.unionByName(x)
    out = scratch.put(out, "leaves")
    for name in [n for n in scratch.names if n.startswith(("sizes-", "fits-", "nodes-"))]:
        scratch.drop(name)
    return out


def links(vectors: DataFrame, scratch: Scratch, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """From (rid, v, copies): ``(rid, n)``, the linked rows of other classes, and ``(a, b)``, spanning links."""
    where = leaves(vectors, scratch)
    # a leaf's number is a hash: any order of the leaves tells which of them counts a pair
    lists = where.groupBy("rid").agg(F.collect_list(F.xxhash64("tree", "node")).alias("all"))  # few a vector
    rows = scratch.put(vectors.join(lists, "rid"), "listed")
    sizes = where.groupBy("tree", "node").agg(F.count("*").alias("n")).where("n > 1")
    # a leaf of more than a tile is cut into tiles, and every pair of them is a group of its own
    tiles = F.ceil(F.col("n") / tile)
    placed = (where.join(sizes, ["tree", "node"]).withColumn("tiles", tiles)
              .withColumn("mine", F.pmod(F.xxhash64("rid"), F.col("tiles"))))
    spread = placed.select("rid", "tree", "node", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other"))
    spread = spread.select("rid", F.xxhash64("tree", "node").alias("here"), "mine", F.least("mine", "other").alias("x"),
                           F.greatest("mine", "other").alias("y"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid", ignore_index=True)
        x, y = pdf["x"].iloc[0], pdf["y"].iloc[0]
        one, two = np.flatnonzero(pdf["mine"] == x), np.flatnonzero(pdf["mine"] == y)
        counts, edges = np.zeros(len(pdf), np.int64), []
        if len(one) and len(two):
            v, rid, copies = _unit(pdf["v"]), pdf["rid"].to_numpy(), pdf["copies"].to_numpy()
            i, j = links_in(v[one], v[two], x == y)
            i, j = one[i], two[j]
            if len(i):
                edges = spanning(rid, i, j)
                before = {int(p): frozenset(pdf["before"].iloc[p].tolist()) for p in np.unique([i, j])}
                new = np.fromiter((before[p].isdisjoint(before[q]) for p, q in zip(i.tolist(), j.tolist(), strict=True)), bool, len(i))
                np.add.at(counts, i[new], copies[j[new]])
                np.add.at(counts, j[new], copies[i[new]])
        own = np.flatnonzero(counts)
        return pd.DataFrame({"a": [*(pdf["rid"].to_numpy()[own] if len(own) else []), *(e[0] for e in edges)],
                             "b": [*[-1] * len(own), *(e[1] for e in edges)],
                             "n": [*counts[own], *[0] * len(edges)]}, dtype="int64")

    # only the leaves that come before this one can have counted a pair
    sent = spread.join(rows, "rid").withColumn("before", F.filter("all", lambda k: k < F.col("here"))).drop("all")
    found = sent.groupBy("here", "x", "y").applyInPandas(run, "a long, b long, n long")
    found = scratch.put(found, "found")
    scratch.drop("listed")
    scratch.drop("leaves")
    return (found.where("b = -1").groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n")),
            found.where("b >= 0").select("a", "b").distinct())


def near_duplicates(vectors: DataFrame, scratch: Scratch, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row."""
    v = vectors[embedding]
    if not isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType):  # floats travel as they are, half as wide
        v = F.transform(v, lambda x: x.cast("double"))
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), v.alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.coalesce((F.size("v") > 0) & ~odd & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = scratch.put(rows.withColumn("rid", F.monotonically_increasing_id()).withColumn("good", good)
                       .withColumn("v", F.when(F.col("good"), F.col("v"))), "rows", keep=True)
    classes = scratch.put(rows.where("good").groupBy("v").agg(F.min("rid").alias("rid"), F.count("*").alias("copies")), "classes")
    counts, edges = links(classes, scratch)
    roots = components(edges, scratch)
    known = (classes.join(counts, "rid", "left").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
             .select("v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("root", "rid").alias("root")))
    out = (rows.join(known, "v", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                F.coalesce("root", "rid").alias("root")))
    least = out.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    out = out.join(least, "root")
    return out.select("vec_id", "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector: vec_id, n_links, component_id, kept (links: cosine of 0.9 or more)."""
    with Scratch(spark, "rpforest") as scratch:
        return scratch.put(near_duplicates(table(spark, sf_dir, "embeddings"), scratch), "result", keep=True)
