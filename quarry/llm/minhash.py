"""Near-duplicate documents by BagMinHash over five-word shingles, with exact verification.

A document is the multiset of its five-word shingles (lower-cased ``\\w+`` words; a text of one to four words is one
shingle).  Similarity is weighted Jaccard: sum of smaller counts over sum of larger counts.

Signature.  Every shingle carries one Poisson process in time for each unit of weight.  The units are discretised
into blocks [0,1), [1,2), [2,4), [4,8), ...; a block is one process of rate = its width, whose points fall on a
random unit of the block and on one of ``m`` components, and a point counts if its unit lies below the
shingle's count.  A component's value is the time of its first point, so two documents agree on it with a chance
of exactly their weighted Jaccard similarity.  Only points up to a time by which all components are almost surely
hit are made; documents with a component left are made again up to a later time, so signatures are exact.

Groups.  (1) Documents with equal words form a class (hash of 128 bits).  (2) ``bands`` of ``rows`` components each put
classes into buckets; 24 x 5 miss a pair of similarity 0.8 with a chance of 7e-5.  (3) Every class is verified against
the smallest class that shares a bucket with it; links give components.  (4) In buckets that
still hold several components, another round compares each class with another hub of its bucket.  (5) In buckets that hold
several components even then, all pairs across them (those whose sizes and 240-bit sketches allow 0.8) are verified as well.
Buckets of at most ``LARGE_BUCKET`` classes give these pairs as rows, so a class has a bounded number of them.  The classes of
a larger bucket are dealt to blocks, a cell is two blocks of a bucket, and a cell's task compares its texts in memory and
gives only the links that join two components: no row is made for a pair, a class is sent once to each block of its bucket.
Pairs inside one component are never made, so groups of thousands of copies stay cheap.  A link
between components can be lost where its pair shares no bucket or, one in 200,000 at a similarity of exactly 0.8, where its
sketches differ in more than 36 of 120 fields.

Defined cases: null and empty texts, and texts without a word, are classes of their own; repeated rows and repeated ids
are documents of their own (equal texts form a class); a null id sorts last.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, mix64, table
from quarry.llm.graph import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5
M = BANDS * ROWS
HUB_ROUNDS = 1
SKETCH = ("k0", "k1", "k2", "k3")
CHUNK_CHARS = 2_000_000
REMEMBERED = 100_000  # words whose hashes a worker keeps
#: Shingles of the texts that a block of the verification holds, about.
CELL_SHINGLES = 300_000
#: Classes of a bucket that still give their pairs as rows; texts of a block of a larger bucket, about.
LARGE_BUCKET, CELL_TEXTS = 32, 2048
MOST_DIFFERING = 36  # fields of two sketches
_WORD = re.compile(r"\w+")
_FACTORS = mix64(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)
SIGNATURE = "struct<h1:bigint,h2:bigint,n:int,bands:array<bigint>,k0:bigint,k1:bigint,k2:bigint,k3:bigint>"


class _WordHash(dict):
    """64-bit hash of a word, remembered; emptied when it has grown to ``REMEMBERED`` words."""

    def __missing__(self, word):
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(words: list[str], known: dict) -> np.ndarray:
    """One 64-bit hash a shingle, in order of the text."""
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if 0 < len(h) < SHINGLE:
        h = np.concatenate([h, np.full(SHINGLE - len(h), len(h), np.uint64)])
    n = max(0, len(h) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        out += h[i:i + n] * _FACTORS[i]
    return mix64(out)


def counted(doc: np.ndarray, hashes: np.ndarray):
    """Distinct (document, shingle) with its count, sorted."""
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])])[:len(doc)])
    return doc[first], hashes[first], np.diff(np.append(first, len(doc)))


def bag_min_hash(doc: np.ndarray, hashes: np.ndarray, weight: np.ndarray, n_docs: int, m: int = M) -> np.ndarray:
    """Signatures (n_docs x m arrival times) of the weighted sets given as (document, element, integer weight)."""
    total = np.bincount(doc, weight, n_docs)
    blocks = np.ones(len(weight), np.int64)
    big = weight > 1
    blocks[big] += np.frexp((weight[big] - 1).astype(float))[1]  # bit length of weight - 1
    e = np.repeat(np.arange(len(doc)), blocks)
    k = np.arange(len(e)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(k > 0, np.left_shift(1, np.maximum(k - 1, 0)), 0)
    width = np.maximum(low, 1)
    seed = mix64(hashes[e] + mix64(k.astype(np.uint64)))
    out = np.full((n_docs, m), np.inf)
    todo = np.flatnonzero(total > 0)
    limit = np.zeros(n_docs)
    limit[todo] = m * (np.log(m) + 3) / total[todo]
    rows = np.arange(len(e))
    while len(rows):
        d, s, rate = doc[e[rows]], seed[rows], width[rows].astype(float)
        t = np.zeros(len(rows))
        own, j = rows, 0
        values = out.ravel()
        while len(own):
            j += 1
            r = mix64(s + np.uint64(j * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
            u = (r >> np.uint64(11)).astype(float) * 2.0**-53
            t = t - np.log1p(-u) / rate
            near = t < limit[d]
            if not near.all():
                own, d, s, rate, t, r = own[near], d[near], s[near], rate[near], t[near], r[near]
            part = mix64(r)
            unit = ((part >> np.uint64(32)).astype(float) * 2.0**-32 * rate).astype(np.int64) + low[own]
            hit = unit < weight[e[own]]
            c = (((part & np.uint64(0xFFFFFFFF)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(values, d[hit] * m + c[hit], t[hit])
            if j % 4 == 0:  # later points of a document that has all components are of no use past its last one
                limit = np.minimum(limit, np.where(np.isfinite(last := out.max(axis=1)), last, limit))
        left = np.isinf(out[todo].max(axis=1))
        todo = todo[left]
        limit[todo] *= 4
        out[todo] = np.inf
        again = np.zeros(n_docs, bool)
        again[todo] = True
        rows = np.flatnonzero(again[doc[e]])
    return out


def signatures(texts: list[str]) -> pd.DataFrame:
    """Class hash, number of shingles, band keys and sketch of each text."""
    known = _WordHash()
    found, h1, h2 = [], [], []
    for text in texts:
        words = _WORD.findall(text.lower())
        whole = xxhash.xxh3_128_intdigest(" ".join(words))
        h1.append((whole >> 64) - (1 << 63))
        h2.append((whole & ((1 << 64) - 1)) - (1 << 63))
        found.append(shingles(words, known))
    sizes = np.array([len(x) for x in found], np.int64)
    doc, hashes, weight = counted(np.repeat(np.arange(len(texts)), sizes), np.concatenate([*found, np.zeros(0, np.uint64)]))
    bits = bag_min_hash(doc, hashes, weight, len(texts)).view(np.uint64)
    keys = np.zeros((len(texts), BANDS), np.uint64)
    for i in range(ROWS):
        keys = mix64(keys + bits[:, i::ROWS])
    fields = mix64(bits) & np.uint64(3)
    sketch = {f"k{i}": (fields[:, i * 32:i * 32 + 32] << np.arange(0, 64, 2, dtype=np.uint64)[:min(32, M - i * 32)])
              .sum(axis=1).view(np.int64) for i in range(4)}
    bands = [list(k) if n else [] for k, n in zip(keys.view(np.int64), sizes, strict=True)]
    return pd.DataFrame({"h1": h1, "h2": h2, "n": sizes.astype(np.int32), "bands": bands, **sketch})


def _signature(text: Column) -> Column:
    def run(s: pd.Series) -> pd.DataFrame:
        texts, parts, now, size = list(s), [], [], 0
        for x in texts:  # whole texts, a bounded number of characters at a time
            now.append(x or "")
            size += len(now[-1])
            if size >= CHUNK_CHARS:
                parts.append(signatures(now))
                now, size = [], 0
        if now or not parts:
            parts.append(signatures(now))
        return pd.concat(parts, ignore_index=True)

    return F.pandas_udf(run, SIGNATURE)(text)


def multiset(text: str | None, known: dict):
    """Distinct shingles, sorted, and their counts."""
    return np.unique(shingles(_WORD.findall((text or "").lower()), known), return_counts=True)


def overlap(x, y) -> float:
    """Weighted Jaccard of two multisets; 0 if both are empty."""
    if not len(x[0]) or not len(y[0]):
        return 0.0
    at = np.minimum(np.searchsorted(y[0], x[0]), len(y[0]) - 1)
    both = np.minimum(x[1], np.where(y[0][at] == x[0], y[1][at], 0)).sum()
    return float(both / (x[1].sum() + y[1].sum() - both))


def similarity(a: str | None, b: str | None) -> float:
    known = _WordHash()
    return overlap(multiset(a, known), multiset(b, known))


class _Cell:
    """The multisets of one cell's texts over a common numbering of its shingles, to compare many pairs at once."""

    def __init__(self, rids: list[int], sets: list):
        order = np.argsort(rids)
        self.rids = np.array(rids, np.int64)[order]
        sets = [sets[i] for i in order]
        self.length = np.array([len(h) for h, _ in sets], np.int64)
        self.start = np.cumsum(self.length) - self.length
        known, self.element = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
        self.count = np.concatenate([c for _, c in sets])
        self.total = np.array([c.sum() for _, c in sets], np.int64)
        self.dense = np.zeros(len(known), np.int64)

    def _places(self, at: np.ndarray) -> np.ndarray:
        n = self.length[at]
        return np.repeat(self.start[at] - np.cumsum(n) + n, n) + np.arange(n.sum())

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs reach the similarity; ``a`` is sorted."""
        a, b = np.searchsorted(self.rids, a), np.searchsorted(self.rids, b)
        both = np.zeros(len(a), np.int64)
        # a text has a run of pairs; long runs are cut so that the gathered elements stay bounded
        size = np.cumsum(self.length[b])
        cut = np.concatenate([[True], (a[1:] != a[:-1]) | (size[1:] // CELL_SHINGLES != size[:-1] // CELL_SHINGLES)])
        for x, y in zip(first := np.flatnonzero(cut), np.append(first[1:], len(a)), strict=True):
            own = slice(self.start[a[x]], self.start[a[x]] + self.length[a[x]])
            self.dense[self.element[own]] = self.count[own]
            at = self._places(b[x:y])
            n = self.length[b[x:y]]
            filled = n > 0
            if filled.any():
                both[x:y][filled] = np.add.reduceat(np.minimum(self.dense[self.element[at]], self.count[at]),
                                                    (np.cumsum(n) - n)[filled])
            self.dense[self.element[own]] = 0
        return both / np.maximum(self.total[a] + self.total[b] - both, 1) >= SIMILARITY


def _linked(batches):
    """Rows sorted by cell, its texts before its pairs sorted by ``a``; the pairs whose texts reach the similarity."""
    known, now, rids, sets, cell = _WordHash(), None, [], [], None
    for pdf in batches:
        cells, a, b = pdf["cell"].to_numpy(), pdf["a"].to_numpy(), pdf["b"].to_numpy()
        texts, pair, keep = pdf["text"].to_numpy(), pdf["pair"].to_numpy(), np.zeros(len(pdf), bool)
        new = np.concatenate([[True], (cells[1:] != cells[:-1]) | (pair[1:] != pair[:-1])])[:len(pdf)]
        for x, y in zip(first := np.flatnonzero(new), np.append(first[1:], len(pdf)), strict=True):
            if cells[x] != now:
                now, rids, sets, cell = cells[x], [], [], None
            if not pair[x]:
                rids.extend(a[x:y])
                sets.extend(multiset(t, known) for t in texts[x:y])
            else:
                cell = cell or _Cell(rids, sets)
                keep[x:y] = cell.linked(a[x:y], b[x:y])
        yield pdf.loc[keep, ["a", "b"]]


def _verified(pairs: DataFrame, entries: DataFrame, rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose texts reach the similarity.

    Classes are put into blocks: those that have the same largest bucket, cut by a hash so that a block holds about
    ``CELL_SHINGLES`` shingles.  A pair belongs to the cell of its two blocks, and a text is sent once to each cell that has
    pairs of it, not once a pair."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    size = entries.groupBy("bucket").agg(F.count("*").alias("c"))
    home = (entries.join(wanted, "node", "left_semi").join(size, "bucket")
            .groupBy("node").agg(F.max(F.struct("c", "bucket")).alias("home"))
            .join(rows.select(F.col("rid").alias("node"), "n"), "node").select("node", "home.bucket", "n"))
    parts = home.groupBy("bucket").agg(F.ceil(F.sum("n") / CELL_SHINGLES).alias("parts"))
    blocks = scratch.put(home.join(parts, "bucket").select(
        "node", F.xxhash64("bucket", F.pmod(F.xxhash64("node"), "parts")).alias("block")), f"{name}-blocks")
    placed = scratch.put(
        pairs.join(blocks.select(F.col("node").alias("a"), F.col("block").alias("x")), "a")
        .join(blocks.select(F.col("node").alias("b"), F.col("block").alias("y")), "b")
        .select(F.xxhash64(F.least("x", "y"), F.greatest("x", "y")).alias("cell"), "a", "b"), f"{name}-placed")
    sent = (placed.select("cell", F.col("a").alias("rid")).union(placed.select("cell", F.col("b").alias("rid"))).distinct()
            .join(rows.select("rid", "text"), "rid"))
    both = (sent.select("cell", F.lit(False).alias("pair"), F.col("rid").alias("a"), F.lit(0).cast("long").alias("b"), "text")
            .union(placed.select("cell", F.lit(True), "a", "b", F.lit(None).cast("string"))))
    found = scratch.put(both.repartition("cell").sortWithinPartitions("cell", "pair", "a")
                        .mapInPandas(_linked, "a long, b long"), name)
    scratch.drop(f"{name}-blocks")
    scratch.drop(f"{name}-placed")
    return found


def _joining(two: bool, rids: list[int], sets: list, roots: list[int], sides: list[int], ns: list[int],
             sketches: list) -> pd.DataFrame:
    """Links between texts of one cell, those that join two of its components.  In a cell of two blocks, texts of one are not
    compared; sizes, sketches and the similarity decide as everywhere."""
    order = np.argsort(rids)
    cell = _Cell(rids, sets)
    _, group = np.unique(np.array(roots, np.int64)[order], return_inverse=True)
    side, n, k = np.array(sides)[order], np.array(ns, np.int64)[order], np.array(sketches, np.int64).view(np.uint64)[order]
    found = []
    for i in range(len(order) - 1):
        at = np.flatnonzero((group[i + 1:] != group[i]) & (np.minimum(n[i], n[i + 1:]) >= SIMILARITY * np.maximum(n[i], n[i + 1:]))
                            & ((side[i + 1:] != side[i]) | (not two))) + i + 1
        x = k[at] ^ k[i]
        fields = (x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)
        at = at[np.bitwise_count(fields).sum(axis=1, dtype=np.int64) <= MOST_DIFFERING]
        if not len(at):
            continue
        for j in at[cell.linked(np.full(len(at), cell.rids[i]), cell.rids[at])]:
            if group[j] != group[i]:
                found.append((cell.rids[i], cell.rids[j]))
                group[group == group[j]] = group[i]
    return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])


def _cell_links(batches):
    """Rows sorted by cell; the links of each that join components."""
    known, now, held = _WordHash(), None, None
    for pdf in batches:
        cells = pdf[["bucket", "x", "y"]].to_numpy()
        new = np.concatenate([[True], (cells[1:] != cells[:-1]).any(axis=1)])[:len(pdf)]
        for u, v in zip(first := np.flatnonzero(new), np.append(first[1:], len(pdf)), strict=True):
            if (cell := tuple(cells[u])) != now:
                if now is not None:
                    yield _joining(now[1] != now[2], *held)
                now, held = cell, ([], [], [], [], [], [])
            own = pdf.iloc[u:v]
            for kept, more in zip(held, (own["node"], (multiset(t, known) for t in own["text"]), own["root"], own["part"], own["n"],
                                         own[[*SKETCH]].to_numpy()), strict=True):
                kept.extend(more)
    if now is not None:
        yield _joining(now[1] != now[2], *held)


def _crossing(entries: DataFrame, rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) across the components of buckets: those of small buckets from pairs as rows, those of larger ones from
    cells.  ``entries`` has them with component, size and sketch."""
    size = entries.groupBy("bucket").agg(F.count("*").alias("c"), F.sum("n").alias("shingles")).where(F.col("c") > LARGE_BUCKET)
    size = scratch.put(size.select("bucket", F.greatest(F.ceil(F.col("shingles") / CELL_SHINGLES), F.ceil(F.col("c") / CELL_TEXTS))
                                   .cast("int").alias("parts")), "crossing-large")
    small = scratch.put(entries.join(size, "bucket", "left_anti"), "crossing-small")
    pairs = scratch.put(_candidates(small, small), "crossing-pairs")
    links = _verified(pairs, entries, rows, scratch, "crossing-links")
    scratch.drop_all("crossing-pairs", "crossing-small")
    part = F.pmod(F.xxhash64("node", "bucket"), "parts").cast("int")
    sent = (entries.join(size, "bucket").withColumn("part", part)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("bucket", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "node", "root", "n",
                    *SKETCH)
            .join(rows.select(F.col("rid").alias("node"), "text"), "node"))
    joining = scratch.put(sent.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
                          .mapInPandas(_cell_links, "a long, b long"), "crossing-cells")
    scratch.drop("crossing-large")
    return links.union(joining)


def _still_open(entries: DataFrame, roots: DataFrame, rows: DataFrame) -> DataFrame:
    """Entries of the buckets that hold several components, with component, size and sketch."""
    entries = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = entries.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket")
    return (entries.join(open_, "bucket", "left_semi")
            .join(rows.select(F.col("rid").alias("node"), "n", *SKETCH), "node"))


def _differing() -> Column:
    """In how many of the 120 two-bit fields the sketches of a pair differ."""
    out = F.lit(0)
    for k in SKETCH:
        x = F.col(f"a_{k}").bitwiseXOR(F.col(f"b_{k}"))
        out = out + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return out


def _candidates(some: DataFrame, entries: DataFrame) -> DataFrame:
    """Distinct pairs of different components that share a bucket and whose sizes and sketches allow the similarity."""
    one, two = (e.select("bucket", *[F.col(c).alias(f"{s}_{c}") for c in ("node", "n", *SKETCH, "root")])
                for s, e in (("a", some), ("b", entries)))
    order = F.col("a_root") < F.col("b_root") if some is entries else F.col("a_root") != F.col("b_root")
    # at similarity 0.8 sketches differ in 18 fields on average, with a deviation of 3.9: one pair in 200,000 exactly there
    # differs in more than 36
    return (one.join(two, "bucket").where(order).where(F.least("a_n", "b_n") >= SIMILARITY * F.greatest("a_n", "b_n"))
            .where(_differing() <= MOST_DIFFERING)
            .select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct())


def groups(docs: DataFrame, scratch: Scratch, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(row, class_id, kept)``: ``row`` is the whole input row as a struct; ``class_id`` the smallest id of
    its near-duplicate group; ``kept`` marks one row of each group (smallest id, then first read)."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[doc_id].cast("long").alias("id"),
                       _signature(docs[text]).alias("s"))
    # ids are fixed by writing them; a text without a word gets a class of its own
    rows = scratch.put(rows.select("row", "id", F.monotonically_increasing_id().alias("rid"), "s.*")
                       .withColumns({"h1": F.when(F.col("n") == 0, F.col("rid")).otherwise(F.col("h1")),
                                     "h2": F.when(F.col("n") == 0, F.lit(0)).otherwise(F.col("h2"))}), "rows", keep=True)
    classes = rows.groupBy("h1", "h2", "n").agg(F.min("rid").alias("node"))
    reps = rows.select("rid", "bands").hint("merge").join(classes.select(F.col("node").alias("rid")), "rid", "left_semi")
    entries = scratch.put(reps.select("rid", F.posexplode("bands").alias("band", "key"))
                          .select(F.col("rid").alias("node"), F.xxhash64("band", "key").alias("bucket")), "entries")
    entries = entries.repartition("bucket")
    shared = entries.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1")
    entries = scratch.put(entries.join(shared.drop("c"), "bucket"), "shared")
    scratch.drop("entries")
    # only classes that share a bucket are ever compared; their texts leave the table of all rows once.  No size of
    # either side is bounded, so neither is broadcast
    shares = entries.select(F.col("node").alias("rid")).distinct()
    near = scratch.put(rows.select("rid", "n", F.col("row")[text].alias("text"), *SKETCH).hint("merge").join(shares, "rid", "left_semi"), "near")
    stars = entries.groupBy(F.col("node").alias("b")).agg(F.min("hub").alias("a")).where("a < b").select("a", "b")
    links = _verified(scratch.put(stars, "stars"), entries, near, scratch, "star-links")
    roots = scratch.put(components(links, scratch, "star-components"), "star-roots")
    scratch.drop_all("stars", "star-links", "star-components")  # every table goes once nothing reads it any more
    entries, held, held_roots = entries.drop("hub"), "shared", "star-roots"
    for i in range(HUB_ROUNDS):  # another hub each time; only classes of another component than the hub's are compared
        entries = scratch.put(_still_open(entries, roots, near), f"open-{i}")
        scratch.drop(held)
        held = f"open-{i}"
        hubs = entries.groupBy("bucket").agg(F.min_by("node", F.xxhash64("node", F.lit(i))).alias("node"))
        stars = scratch.put(_candidates(entries.join(hubs, ["bucket", "node"], "left_semi"), entries), f"stars-{i}")
        links = _verified(stars, entries, near, scratch, f"links-{i}")
        old = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = scratch.put(components(old.union(links), scratch, f"components-{i}"), f"roots-{i}")
        scratch.drop_all(f"stars-{i}", f"links-{i}", f"components-{i}", held_roots)
        held_roots = f"roots-{i}"
        entries = entries.select("node", "bucket")
    entries = scratch.put(_still_open(entries, roots, near), "open")
    scratch.drop(held)
    more = _crossing(entries, near, scratch)
    scratch.drop_all("open", "near")
    stars = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    roots = components(stars.union(more), scratch, "all-components")
    scratch.drop_all("crossing-links", "crossing-cells", held_roots)

    nodes = (classes.join(roots, "node", "left").select("h1", "h2", "n", F.coalesce("root", "node").alias("root")))
    placed = scratch.put(rows.select("rid", "id", "h1", "h2", "n").join(nodes, ["h1", "h2", "n"])
                         .select("rid", "id", "root"), "placed")
    scratch.drop_all("all-components")
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "rid")).alias("first"))
    placed = (placed.join(first, "root")
              .select("rid", F.col("first.id").alias("class_id"), (F.col("rid") == F.col("first.rid")).alias("kept")))
    result = scratch.put(placed, "result", keep=True)
    scratch.drop("placed")
    # both sides grow with the input, so neither is broadcast while it happens to be small
    return rows.select("row", "rid").hint("merge").join(result, "rid").select("row", "class_id", "kept")


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, class_id (smallest doc_id of its near-duplicate group), kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with Scratch(spark, "minhash") as scratch:
        return groups(docs, scratch).select("row.doc_id", "class_id", "kept")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: one document of each near-duplicate group stays."""
    with Scratch(spark, "minhash") as scratch:
        kept = scratch.put(groups(docs, scratch).where("kept").select("row.*"), "kept", keep=True)
        scratch.drop_all("rows", "result")
        return kept
