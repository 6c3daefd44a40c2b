"""Conversation prefix trie in minimal-perfect-hash node tables.

A node is a distinct sequence of first turns.  Its digest is the sum of the hashes of its turns (each with its place) in two
64-bit words, so the digests of all prefixes of a conversation are running sums and come from one skew-safe ordered scan,
however long a conversation is.  One partial aggregate enumerates the distinct digests; it verifies that all members of
a node agree on its last turn (and so, by induction, on the whole prefix).

What is summed over subtrees: a stretch of nodes with the same members has one way down, so it is one slot of a table,
known by the digest of its last node.  Stretches are dealt to shards by the topmost node above them that has at most
``PART`` members: a subtree stays whole and has at most two stretches a member.  A shard gives its digests collision-verified
slots by a minimal perfect hash, scatters the counts into flat arrays and accumulates them through the
array of parent slots, deepest first.  Tops of shards hand their sums to the next band (up to ``PART * FACTOR`` members),
until the root is done: a node of any number of members or children is never gathered in one task.

``ends_sha256`` is one digest over all ids in order, so the ids of a node have to pass one hash in turn.  They are joined to
blocks in parallel (a node's ids are cut over many tasks); only those blocks stream through one task, with constant memory.

Defined cases: rows without a conv_id take no part; equal turn numbers of a conversation are ordered by a hash of role and
text; repeated rows are turns of their own; null role or text is empty; other columns are ignored; an empty table gives no
nodes; a turn's text of any length is hashed in its own row; remainders of negative ids are those of SQL.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, mix64, table
from quarry.plans.scan import row_index, running_sums

BASE_STEP, MOST_TURNS = 100, 6
PART, FACTOR = 1_000, 1_000
SHARD = 10_000
BLOCK_IDS = 512
_NODE = ["depth", "p1", "p2"]


def _word(sha: Column, at: int) -> Column:
    return F.conv(F.substring(sha, at, 16), 16, -10).cast("long")


def rebuilt_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, d1, d2, chars) of every rebuilt turn, and (conv_id) of every conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = (conversations.where("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", sha.alias("sha"), F.length(text).cast("long").alias("chars"))
             .select("conv_id", "turn", _word(F.col("sha"), 1).alias("d1"), _word(F.col("sha"), 17).alias("d2"), "chars"))
    rows = scratch.put(row_index(turns, ["conv_id"], ["turn", "d1", "d2"], "pos").drop("turn"), "turns")
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TURNS).alias("h")
    convs = sizes.select("conv_id", "n", heads, (F.col("conv_id") - F.col("conv_id") % BASE_STEP).alias("base"))
    convs = (convs.join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("nb")), "base", "left")
             .select("conv_id", "base", "h", F.least("h", F.coalesce("nb", F.lit(0))).alias("taken")))
    convs = scratch.put(convs, "convs")
    own = (rows.join(convs.drop("base"), "conv_id").where("pos > h")
           .select("conv_id", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), "d1", "d2", "chars"))
    first = rows.where(f"pos < {MOST_TURNS} AND conv_id % {BASE_STEP} = 0").withColumnRenamed("conv_id", "base")
    given = (first.join(convs.drop("taken"), "base").where("pos <= h")
             .select("conv_id", F.col("pos").alias("depth"), "d1", "d2", "chars"))
    return own.union(given), convs.select("conv_id")


def members_of(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for every conversation and depth, the root included: digest of the prefix (p1, p2) and of the one
    without its last turn (q1, q2), the turn's own (d1, d2), its characters and those of the whole prefix."""
    mixed = turns.select("*", F.xxhash64(F.lit(1), "depth", "d1", "d2").alias("e1"), F.xxhash64(F.lit(2), "depth", "d1", "d2").alias("e2"))
    rows = running_sums(mixed, ["conv_id"], ["depth"], {"e1": "p1", "e2": "p2", "chars": "total"}, before={"e1": "q1", "e2": "q2"})
    columns = ["conv_id", "depth", "p1", "p2", "q1", "q2", "d1", "d2", "chars", "total"]
    return rows.select(columns).union(convs.select("conv_id", *[F.lit(0).cast("long") for _ in columns[1:]]))


def nodes_of(members: DataFrame) -> DataFrame:
    """The distinct prefixes, collision-verified, with their smallest member and number of members."""
    one = (F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2")) & (F.min("q1") == F.max("q1")) & (F.min("q2") == F.max("q2"))
    checked = F.when(one, F.min("conv_id")).otherwise(F.raise_error(F.lit("two prefixes share a digest")).cast("long"))
    return members.groupBy(*_NODE).agg(checked.alias("conv_id"), F.count("*").alias("k"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
                                       F.min("chars").alias("chars"), F.min("total").alias("total"))


# --------------------------------------------------------------------------- a shard's table


class NodeTable:
    """Minimal perfect hash over distinct digests of two 64-bit words: keys fall into buckets, and each bucket, largest first, takes
    the first displacement that puts all its keys on free slots; buckets of one key take what is left."""

    def __init__(self, a: np.ndarray, b: np.ndarray, per_bucket: int = 4):
        a, b = a.astype(np.int64).view(np.uint64), b.astype(np.int64).view(np.uint64)
        n = self.n = len(a)
        self.buckets = max(1, n // per_bucket)
        self.shift = np.zeros(self.buckets, np.int64)  # of the slots; -1 - slot: the slot itself
        self.a, self.b = np.empty(n, np.uint64), np.empty(n, np.uint64)
        bucket = self._bucket(a)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        free = np.ones(n, bool)
        for k in np.argsort(-sizes, kind="stable"):
            if sizes[k] < 2:
                break
            keys = order[ends[k] - sizes[k]:ends[k]]
            low = 0
            while True:
                slots = self._slots(a[keys], b[keys], np.arange(low, low + 32)[:, None])
                fits = free[slots].all(axis=1)
                for t in np.flatnonzero(fits):
                    if len(set(slots[t].tolist())) == len(keys):
                        break
                else:
                    low += 32
                    if low > 1 << 22:
                        raise ValueError("two nodes have one digest")
                    continue
                break
            self.shift[k] = low + t
            free[slots[t]] = False
        single = np.flatnonzero(sizes == 1)
        self.shift[single] = -1 - np.flatnonzero(free)
        slot = self._raw(a, b)
        self.a[slot], self.b[slot] = a, b
        if (self.a[slot] != a).any() or (self.b[slot] != b).any():
            raise ValueError("two nodes have one digest")

    def _bucket(self, a):
        return (mix64(a) % np.uint64(self.buckets)).astype(np.int64)

    def _slots(self, a, b, shift):
        return (mix64(b ^ mix64(a + shift.astype(np.uint64))) % np.uint64(self.n)).astype(np.int64)

    def _raw(self, a, b):
        shift = self.shift[self._bucket(a)]
        return np.where(shift < 0, -1 - shift, self._slots(a, b, np.maximum(shift, 0)))

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 where the table does not hold it."""
        a, b = a.astype(np.int64).view(np.uint64), b.astype(np.int64).view(np.uint64)
        slot = self._raw(a, b)
        return np.where((self.a[slot] == a) & (self.b[slot] == b), slot, -1)


def accumulate(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums over the subtrees of one shard.  Rows are stretches: ``top`` depth, digest of the last node (b1, b2) and of the
    node above the first (q1, q2), ``own`` saved tokens, and what other shards have handed up (kids, leaves, below)."""
    t = NodeTable(pdf["b1"].to_numpy(), pdf["b2"].to_numpy())
    slot = t.slots(pdf["b1"].to_numpy(), pdf["b2"].to_numpy())

    def scattered(values) -> np.ndarray:
        flat = np.empty(t.n, np.int64)
        flat[slot] = values
        return flat

    parent = scattered(t.slots(pdf["q1"].to_numpy(), pdf["q2"].to_numpy()))
    top, own, kids, leaves, below = (scattered(pdf[c].to_numpy()) for c in ("top", "own", "kids", "leaves", "below"))
    parent[top == 0] = -1
    order = np.argsort(-top, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(top[order])) + 1):
        leaves[level] += kids[level] == 0
        inside = level[parent[level] >= 0]
        up = parent[inside]
        np.add.at(kids, up, 1)
        np.add.at(leaves, up, leaves[inside])
        np.add.at(below, up, below[inside] + own[inside])
    return pdf[["conv_id", "k", "q1", "q2"]].assign(
        kids=kids[slot], leaves=leaves[slot], below=below[slot], total=(below + own)[slot],
        hands_up=(parent[slot] < 0) & (top[slot] > 0))


_DONE = "conv_id long, k long, q1 long, q2 long, kids long, leaves long, below long, total long, hands_up boolean"


def subtree_sums(nodes: DataFrame, members: DataFrame, n_convs: int, scratch: Scratch) -> DataFrame:
    """(conv_id, k) of every stretch with its last depth, the characters up to there, and the sums over its subtree:
    children of its last node, leaves, saved tokens strictly below it."""
    stretches = nodes.groupBy("conv_id", "k").agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.max_by("p1", "depth").alias("b1"),
        F.max_by("p2", "depth").alias("b2"), F.min_by("q1", "depth").alias("q1"), F.min_by("q2", "depth").alias("q2"),
        F.max("total").alias("reach"), F.min(F.col("total") - F.col("chars")).alias("begin"))
    stretches = scratch.put(stretches.withColumn("own", (F.col("k") - 1) * (F.col("reach") - F.col("begin"))), "stretches")
    bounds = [PART]
    while bounds[-1] < n_convs:
        bounds.append(bounds[-1] * FACTOR)
    if len(bounds) > 1:  # the topmost node of each band on every conversation's path; the last band is one subtree
        small = nodes.where(F.col("k") <= bounds[-2]).select(*_NODE, "k")
        tops = [[F.min_by(p, F.when(F.col("k") <= b, F.col("depth"))).alias(f"{p}_{i}") for p in ("p1", "p2")]
                for i, b in enumerate(bounds[:-1])]
        paths = members.where("depth > 0").select("conv_id", *_NODE).join(small, _NODE)
        stretches = scratch.put(stretches.join(paths.groupBy("conv_id").agg(*sum(tops, [])), "conv_id", "left"), "dealt")
    done, handed, shards = None, None, 1 + 2 * n_convs // SHARD
    for i, bound in enumerate(bounds):
        band = stretches.where((F.col("k") <= bound) & (F.col("k") > (bounds[i - 1] if i else 0)))
        if handed is None:
            band = band.withColumns({c: F.lit(0).cast("long") for c in ("kids", "leaves", "below")})
        else:
            band = band.join(handed, ["b1", "b2"], "left").na.fill(0, ["kids", "leaves", "below"])
        root = F.lit(0) if i == len(bounds) - 1 else F.pmod(F.xxhash64(f"p1_{i}", f"p2_{i}"), F.lit(shards))
        band = band.select("conv_id", "k", "top", "b1", "b2", "q1", "q2", "own", "kids", "leaves", "below", root.alias("shard"))
        out = scratch.put(band.groupBy("shard").applyInPandas(accumulate, _DONE), f"band-{i}")
        done = out if done is None else done.union(out)
        # a parent may lie in any later band
        handed = (done.where("hands_up").groupBy(F.col("q1").alias("b1"), F.col("q2").alias("b2"))
                  .agg(F.count("*").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("total").alias("below")))
    return stretches.select("conv_id", "k", "bottom", "reach").join(done.select("conv_id", "k", "kids", "leaves", "below"), ["conv_id", "k"])


# --------------------------------------------------------------------------- members that end at a node


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Row ranges of equal nodes in a sorted batch."""
    columns = [batch.column(c).to_numpy() for c in _NODE]
    new = np.flatnonzero(np.any([x[1:] != x[:-1] for x in columns], axis=0)) + 1
    edges = [0, *new.tolist(), batch.num_rows]
    return list(zip(edges, edges[1:], strict=False))


def end_digests(members: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids that end at a node, for nodes where one does."""
    ends = members.groupBy("conv_id").agg(F.max("depth").alias("depth"), F.max_by("p1", "depth").alias("p1"), F.max_by("p2", "depth").alias("p2"))

    def joined(batches):
        for batch in batches:
            out = []
            for lo, hi in _runs(batch) if batch.num_rows else []:
                for a in range(lo, hi, BLOCK_IDS):
                    ids = batch.column("conv_id").slice(a, min(BLOCK_IDS, hi - a)).to_pylist()
                    out.append((*(batch.column(c)[lo].as_py() for c in _NODE), ids[0], ",".join(map(str, ids))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], [*_NODE, "first", "ids"])

    def hashed(batches):
        node, state = None, None
        for batch in batches:
            out = []
            rows = zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True)
            for *key, ids in rows:
                if key != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], [*_NODE, "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, state.hexdigest())], [*_NODE, "ends_sha256"])

    key = "depth long, p1 long, p2 long, "
    blocks = (ends.select(*_NODE, "conv_id").repartitionByRange("p1", "p2", "depth", "conv_id")
              .sortWithinPartitions("p1", "p2", "depth", "conv_id").mapInArrow(joined, key + "first long, ids string"))
    return (blocks.repartition("p1", "p2", "depth").sortWithinPartitions("p1", "p2", "depth", "first")
            .mapInArrow(hashed, key + "ends_sha256 string"))


# --------------------------------------------------------------------------- the whole trie


def prefix_trie(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node of the trie of the rebuilt conversations; the result reads tables kept in ``scratch``."""
    turns, convs = rebuilt_turns(conversations, scratch)
    members = scratch.put(members_of(turns, convs), "members")
    nodes = scratch.put(nodes_of(members), "nodes")
    sums = subtree_sums(nodes, members, convs.count(), scratch)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"),
                         F.col("conv_id").alias("parent_conv_id"))
    out = (nodes.join(sums, ["conv_id", "k"]).join(above, ["depth", "q1", "q2"], "left")
           .join(end_digests(members), _NODE, "left"))
    unique = F.col("depth") < F.col("bottom")
    return out.select(
        "conv_id", "depth", "parent_conv_id", F.col("k").alias("n_convs"), F.when(unique, 1).otherwise(F.col("kids")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("k") - 1) * (F.col("reach") - F.col("total") + F.col("chars"))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    with Scratch(spark, "trie") as scratch:
        return scratch.put(prefix_trie(table(spark, sf_dir, "conversations"), scratch), "result", keep=True)


OP13_SQL = """
WITH c AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
s AS (SELECT conv_id, count(*) AS n FROM c GROUP BY conv_id),
m AS (
  SELECT s.conv_id, s.conv_id - s.conv_id % 100 AS base, coalesce(b.n, 0) AS nb,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(s.conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda crc, x: list_reduce([xor(crc, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 6 AS h
  FROM s LEFT JOIN s b ON b.conv_id = s.conv_id - s.conv_id % 100),
t AS (
  SELECT m.conv_id, pos AS depth, role, text FROM m JOIN c ON c.conv_id = m.base WHERE pos <= h
  UNION ALL SELECT m.conv_id, least(h, nb) + pos - h, role, text FROM m JOIN c ON c.conv_id = m.conv_id WHERE pos > h),
p AS (
  SELECT conv_id, depth, length(text) AS chars,
         sha256(string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM t
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM m),
q AS (SELECT *, lag(node) OVER w AS above, lead(node) OVER w IS NULL AS ends FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
n AS (
  SELECT node, any_value(depth) AS depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS k, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM q GROUP BY node),
k AS (SELECT above, count(*) AS kids FROM n GROUP BY above),
v AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN k ON k.above = n.node),
u AS (
  SELECT p.node, sum((v.kids = 0)::INT) AS n_leaves, sum((v.k - 1) * v.chars) AS saved
  FROM v JOIN p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.node)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.k AS n_convs, v.kids AS n_children, u.n_leaves::BIGINT AS n_leaves,
       u.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN u USING (node) LEFT JOIN n up ON up.node = v.above
"""
