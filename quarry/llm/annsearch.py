"""Approximate nearest neighbours by a hash-prefix forest.

Every tree gives each vector a long hash string: the signs of its products with ``bits`` random orthogonal directions,
first sign first.  A tree is the sorted array of those strings.  Spark sorts all trees' strings at once by (tree,
string), together with the ends of every prefix interval of the queries (its longest match and all shorter ones), and
numbers the strings, so each prefix of a query becomes an interval of places in the array.

Descending and ascending: a query starts at the longest prefixes whose intervals, of all its trees together, hold
``first`` places, and all trees go up together, at most ``STEP`` signs a round.  It stops by what it has found: two vectors at
an angle a share a sign with probability 1 - a / pi, so with its k-th best at that angle, a vector as near as that one
stands in the interval of one tree at least with a probability that is known for each level.  A query goes up until that
probability is ``sure``; its true k-th neighbour is no farther than the one found.  All places of its intervals are its
candidates, and at the root that is every vector.

Scoring: the arrays are cut into blocks of equal size whatever the data looks like, so a dense region is just more
blocks.  Each block holds its vectors once and answers all queries whose interval touches it: products in
double precision, the best k of the block (ties: smaller id), and the best k of all blocks at the end.

Data without structure goes up far (random 64-dimensional vectors: about 0.6 n places with 51,000 of them, 1.25 n with
2,000); clustered data stops early.  Prefixes longer than the logarithm of the number of vectors are not told apart: a
denser interval starts there and is examined whole.

Defined cases: vectors null, empty, zero or with null or non-finite components take no part, neither do null ids; of
other dimensions than the query's, vectors are no candidates; repeated rows are candidates of their own (a query's own
id never); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import Scratch, table

TREES, BITS = 40, 62
SURE, FIRST, STEP = 0.92, 2048, 3
BLOCK, K = 2048, 5
SEED = 20


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the vectors that can have a cosine; ``v`` is an array of doubles."""
    v = F.transform(vectors[embedding], lambda x: x.cast("double"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(vectors[vec_id].cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .where(~odd & F.exists("v", lambda x: x != 0)))


def directions(tree: int, dim: int) -> np.ndarray:
    """``BITS`` directions of a tree: orthonormal as far as the dimension allows, then the next orthonormal set."""
    rng = np.random.default_rng([SEED, tree, dim])
    sets = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-BITS // dim))]
    return np.concatenate(sets, axis=1)[:, :BITS]


def hashes(v: np.ndarray, tree: int) -> np.ndarray:
    signs = (v @ directions(tree, v.shape[1]) > 0).astype(np.int64)
    return signs @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _keys(rows: DataFrame, trees: int) -> DataFrame:
    """``(rid, tree, key)``; trees of another dimension have other numbers."""
    def run(batches):
        for pdf in batches:
            dims = pdf["v"].map(len)
            for dim, part in pdf.groupby(dims, sort=True):
                v = np.stack(part["v"].to_numpy())
                rid = part["rid"].to_numpy()
                for t in range(trees):
                    yield pd.DataFrame({"rid": rid, "tree": t + trees * int(dim), "key": hashes(v, t)})

    return rows.select("rid", "v").mapInPandas(run, "rid long, tree int, key long")


def _placed(entries: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``entries`` sorted by (tree, key, kind, rid) over the cluster, with ``place``: how many index rows (kind 1) stand
    before them.  Parts are counted apart and their starts added: one number for each part reaches the driver."""
    def run(batches):
        seen = 0
        for pdf in batches:
            is_row = (pdf["kind"] == 1).to_numpy()
            yield pdf.assign(part=_part(), at=seen + np.cumsum(is_row) - is_row)
            seen += int(is_row.sum())

    def _part() -> int:
        from pyspark import TaskContext

        return TaskContext.get().partitionId()

    cols = ["tree", "key", "kind", "rid"]
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = entries.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema) + ", part int, at long"
    done = scratch.put(sorted_.mapInPandas(run, schema), name)
    counts = {r["part"]: r["n"] for r in done.where("kind = 1").groupBy("part").agg(F.count("*").alias("n")).collect()}
    parts, start, starts = max(counts, default=-1) + 1, 0, []
    for p in range(max(parts, n)):
        starts.append(start)
        start += counts.get(p, 0)
    begin = F.array(*[F.lit(s).cast("long") for s in starts]) if starts else F.array(F.lit(0).cast("long"))
    return done.withColumn("place", F.col("at") + F.element_at(begin, F.col("part") + 1)).drop("part", "at")


def _best(q: np.ndarray, q_ids: np.ndarray, v: np.ndarray, ids: np.ndarray, low, high, k: int):
    """For each query its best k of rows [low, high): (query number, row number, score)."""
    qn, vn = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    for at in range(0, len(q), 256):
        near = q[at:at + 256] @ v.T / (qn[at:at + 256, None] * vn[None, :])
        for i, scores in enumerate(near, at):
            rows = np.arange(low[i], high[i])
            rows = rows[ids[rows] != q_ids[i]]
            if len(rows) > k:
                s = scores[rows]
                rows = rows[s >= np.partition(s, -k)[-k] - 1e-9]
            # the product again, row by row, so that equal vectors have equal scores wherever they stand
            exact = (q[i] * v[rows]).sum(axis=1) / (qn[i] * vn[rows])
            for j in np.lexsort((ids[rows], -exact))[:k]:
                yield i, rows[j], exact[j]


def level_needed(score: Column, levels: int, trees: int, sure: float) -> Column:
    """The longest prefix at which one of ``trees`` trees shows a vector of that cosine with probability ``sure``."""
    one = 1 - (1 - sure) ** (1 / trees)  # what a single tree must reach
    sign = 1 - F.acos(F.least(F.greatest(score, F.lit(-1.0)), F.lit(1.0))) / np.pi
    return (F.when(score.isNull() | (sign <= 0), 0).when(sign >= 1, levels)
            .otherwise(F.least(F.floor(np.log(one) / F.ln(sign)), F.lit(levels))).cast("int"))


def search(vectors: DataFrame, queries: DataFrame, scratch: Scratch, k: int = K, trees: int = TREES,
           sure: float = SURE, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row of ``queries`` (both as from ``usable``)."""
    rows = scratch.put(vectors.withColumn("rid", F.monotonically_increasing_id()), "rows")
    asked = scratch.put(queries.withColumn("rid", F.monotonically_increasing_id()), "queries")
    levels = min(BITS, int(rows.count()).bit_length() + 1)
    index = _keys(rows, trees).select("tree", "key", F.lit(1).alias("kind"), "rid", F.lit(0).alias("level"))
    # the interval of a query's prefix of x signs: from its first string to the one after its last (kind 0 sorts first)
    ends = (_keys(asked, trees).withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
            .withColumn("low", F.expr(f"shiftleft(shiftright(key, {BITS} - level), {BITS} - level)"))
            .withColumn("high", F.col("low") + F.expr(f"shiftleft(1L, {BITS} - level)")))
    ends = ends.select("tree", F.col("low").alias("key"), F.lit(0).alias("kind"), "rid", "level").union(
        ends.select("tree", F.col("high").alias("key"), F.lit(-1).alias("kind"), "rid", "level"))
    placed = scratch.put(_placed(index.union(ends), scratch, "sorted"), "placed")
    scratch.drop("sorted")

    spans = (placed.where("kind < 1").groupBy("rid", "tree", "level").agg(
        F.max(F.when(F.col("kind") == 0, F.col("place"))).alias("low"),
        F.max(F.when(F.col("kind") == -1, F.col("place"))).alias("high")))
    spans = scratch.put(spans, "spans")
    held = spans.groupBy("rid", "level").agg(F.sum(F.col("high") - F.col("low")).alias("n"))
    now = scratch.put(held.groupBy("rid").agg(F.coalesce(F.max(F.when(F.col("n") >= first, F.col("level"))), F.lit(0))
                                              .alias("level")), "level-0")

    parts = scratch.put(placed.where("kind = 1").join(rows, "rid").select(
        F.floor(F.col("place") / block).alias("block"), (F.col("place") % block).cast("int").alias("at"), "vec_id", "v"), "blocks")
    scratch.drop("placed")
    def answer(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        own = own.sort_values("at", ignore_index=True)
        at, ids = own["at"].to_numpy(), own["vec_id"].to_numpy()
        dims = own["v"].map(len).to_numpy()
        for dim, part in ask.groupby(ask["v"].map(len), sort=True):
            held = np.flatnonzero(dims == dim)  # trees of one dimension stand together
            if not len(held):
                continue
            v, q = np.stack(own["v"].to_numpy()[held]).astype(float), np.stack(part["v"].to_numpy()).astype(float)
            low, high = (np.searchsorted(at[held], part[c].to_numpy()) for c in ("low", "high"))
            q_ids, q_rid = part["vec_id"].to_numpy(), part["rid"].to_numpy()
            out += [(q_rid[i], q_ids[i], ids[held[j]], s) for i, j, s in _best(q, q_ids, v, ids[held], low, high, k)]
        return pd.DataFrame(out, columns=["rid", "query_id", "vec_id", "score"])

    def ascended(level: DataFrame) -> DataFrame:
        """The k best of each query in its intervals at ``level``."""
        visits = (spans.join(level, ["rid", "level"]).where("high > low")
                  .withColumn("block", F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))))
                  .select("rid", "block", F.greatest(F.col("low") - F.col("block") * block, F.lit(0)).cast("int").alias("low"),
                          F.least(F.col("high") - F.col("block") * block, F.lit(block)).cast("int").alias("high"))
                  .join(asked, "rid"))
        met = parts.join(visits.select("block").distinct(), "block", "left_semi")
        found = met.groupBy("block").cogroup(visits.groupBy("block")).applyInPandas(
            answer, "rid long, query_id long, vec_id long, score double").distinct()
        best = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    done: list[DataFrame] = []
    for i in range(1, levels // STEP + 2):
        found = scratch.put(ascended(now), f"found-{i}")
        worst = found.groupBy("rid").agg(F.max(F.when(F.col("rank") == k, F.col("score"))).alias("worst"))
        needed = F.greatest(level_needed(F.col("worst"), levels, trees, sure), F.col("level") - STEP)
        after = (now.join(worst, "rid", "left").select("rid", F.when(F.col("level") > 0, F.least(needed, "level"))
                                                       .otherwise(0).alias("next"), "level"))
        after = scratch.put(after, f"after-{i}")
        done.append(found.join(after.where("next = level"), "rid", "left_semi"))
        now = scratch.put(after.where("next < level").select("rid", F.col("next").alias("level")), f"level-{i}")
        if not now.head(1):
            break
    found = done[0].select("query_id", "vec_id", "score")
    for more in done[1:]:
        found = found.union(more.select("query_id", "vec_id", "score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every vector whose id is divisible by 50: query_id, rank, vec_id, score."""
    vectors = usable(table(spark, sf_dir, "embeddings"))
    with Scratch(spark, "ann") as scratch:
        return scratch.put(search(vectors, vectors.where("vec_id % 50 = 0"), scratch), "result", keep=True)
