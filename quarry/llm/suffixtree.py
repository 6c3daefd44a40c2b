"""Language-model scores by a probabilistic suffix tree over words.

Tokens: words (everything but ASCII white space, A-Z lower-cased), then one end token a document.  The root is the
distribution of single tokens, (c + 0.1) / (N + 0.1 (V + 1)), from exact counts of every word of the training rows.
A node is a context of preceding words.  Its next symbols are those that follow it at least ``LEAST`` times; their
probabilities are discounted counts, and the rest of the mass goes to its suffix's distribution.  A context is retained if
it diverges from its suffix: if its log-likelihood gain on the training rows exceeds a BIC penalty for its symbols.  All
contexts of one and two words are tried, then, length by length, those whose suffix is retained, until none is.  A
token is scored by the longest retained suffix of what precedes it.

Counting and joining are Spark's: grams, nodes and words are tables by key; tasks hand on distinct keys and counts packed in one
block for each range of keys.  A filter of fixed size only keeps rows that
cannot matter out of a shuffle; what it lets through wrongly, the joins drop.  A gram's key is also that of the context
it makes, and scores are sums: a token's is that of the root plus, for every retained context before it, what the context
changes.  So a document's is the sum of a value for each of its grams.  Keys of at least ``HOT`` of all tokens are looked up
in the tasks (at most 1 / HOT of each length, whatever the input), all others by range of keys: this says where, not whether.

Words are known by 64-bit hashes.  Defined cases: null as empty text (one end token); a null id is learnt from and not
held out; repeated rows count each time; without training rows every token scores log10(0.1 / 0.1) = 0; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Scratch, mix64, remainder, table

HOT, LEAST, DISCOUNT = 2e-6, 4, 0.5
FILTER_BITS, PAGE_BITS = 29, 19  # of a filter (64 MB), at most, and of a page of it; a full one only lets more rows through
STRIDE = 5  # lengths beyond four counted in one reading
FLUSH_TOKENS, CHUNK_BYTES, PART_BYTES = 500_000, 2_000_000, 1 << 24
LONG = 64  # bytes of a word that is hashed on its own
END = np.uint64(xxhash.xxh64_intdigest(b" "))  # no word holds a space
BLOCKS = "length int, part int, context binary, suffix binary, n binary"
GRAMS = "length int, key long, context long, suffix long, n long"
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.arange(256, dtype=np.uint8)  # A-Z lower-cased, white space as spaces
_FOLD[65:91] += 32
_FOLD[9:14] = 32
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
ASKED = "part int, first long, word boolean, doc binary, key binary, own binary"
ANSWERS = "first long, doc binary, base binary, more binary, known binary, own binary"



def tokens(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of the texts that lie one after the other in ``data`` (bytes) and end at ``ends``, and how many each has."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = _FOLD[data]
    word = padded[:len(data)] != 32
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    full = np.diff(ends, prepend=0) > 0  # texts with bytes: a word neither comes from the text before nor goes on in the next
    begin, end = (ends - np.diff(ends, prepend=0))[full], ends[full] - 1
    first[begin], last[end] = word[begin], word[end]
    begin, size = np.flatnonzero(first), np.flatnonzero(last) + 1 - np.flatnonzero(first)
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    h, who, at, left = size.astype(np.uint64), np.arange(len(size)), begin, size
    for _ in range(LONG // 8):
        h[who] = joined(h[who], eight[at] & _LOW[np.minimum(left, 8)])
        more = np.flatnonzero(left > 8)
        if not len(more):
            break
        who, at, left = who[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh64_intdigest(padded[begin[i]:begin[i] + size[i]])
    at = np.searchsorted(begin, ends) + np.arange(len(ends))
    out = np.full(len(begin) + len(ends), END)
    rest = np.ones(len(out), bool)
    rest[at] = False
    out[rest] = h
    return out, np.diff(at, prepend=-1)


def joined(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of a gram from the keys of all but its last token and of all but its first; also that of the context it makes."""
    return mix64(context * _PAIR + suffix)


def longer(keys: np.ndarray) -> np.ndarray:
    """Keys of the grams one token longer at each place (whether inside a document or not)."""
    return joined(keys[:-1], keys[1:])


def inside(doc: np.ndarray, length: int) -> np.ndarray:
    """Places whose gram of that length stays inside its document."""
    return np.flatnonzero(doc[length - 1:] == doc[:max(len(doc) - length + 1, 0)])


def _pieces(texts: pa.Array):
    """Tokens and their numbers for some whole texts at a time."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + CHUNK_BYTES, "right")) - 1)
        yield tokens(data[ends[i]:ends[j]], ends[i + 1:j + 1] - ends[i])
        i = j


def _flushed(batches, use):
    """``use(tokens, number of the document of each)`` for every so many tokens of a partition."""
    held, n = [], 0

    def flush():
        sizes = np.concatenate([x[1] for x in held])
        return use(np.concatenate([x[0] for x in held]), np.repeat(np.arange(len(sizes)), sizes))

    for batch in batches:
        for piece in _pieces(batch.column(0)):
            held.append(piece)
            n += len(piece[0])
            if n >= FLUSH_TOKENS:
                yield from flush()
                held, n = [], 0
    if held:
        yield from flush()


def _held(batches):
    """The first column of a partition, so many rows at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False))
        n += len(held[-1])
        if n >= FLUSH_TOKENS:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys are neighbours, and where in it each run begins."""
    order = np.argsort(key)
    key = key[order]
    return order, np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])


def _stable(x: np.ndarray) -> np.ndarray:
    """Order of numbers from 0, equal ones as they are; short ones are sorted by digits."""
    return np.argsort(x.astype(np.uint16) if len(x) and x.max() < 1 << 16 else x, kind="stable")


def _part(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def _blocks(length: int, key: np.ndarray, context: np.ndarray, suffix: np.ndarray, bits: int) -> pa.RecordBatch:
    """Distinct grams and their counts, in one row for each range of keys; words have neither context nor suffix."""
    order, first = _runs(key)
    n, first = np.diff(np.append(first, len(order))).astype(np.uint32), order[first]
    cut = np.searchsorted(_part(key[first], bits), np.arange((1 << bits) + 1))
    parts = np.flatnonzero(cut[1:] > cut[:-1])
    columns = [[x[cut[p]:cut[p + 1]].tobytes() for p in parts] for x in (context[first], suffix[first], n)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(parts), length), pa.int32()), pa.array(parts, pa.int32()), *(pa.array(x, pa.binary()) for x in columns)],
        ["length", "part", "context", "suffix", "n"])


def _whole(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind)


def _summed(train: DataFrame, use) -> DataFrame:
    """Grams with their context (all but the last token), suffix (all but the first) and exact count: words, and longer ones
    that occur at least ``LEAST`` times.  Tasks hand on packed blocks of their counts, one for each range of keys."""
    def count(blocks: pa.Table) -> pa.Table:
        length = blocks["length"][0].as_py()
        context, suffix, n = (_whole(blocks[c], k) for c, k in (("context", "<u8"), ("suffix", "<u8"), ("n", "<u4")))
        key = context if length == 1 else joined(context, suffix)
        order, first = _runs(key)
        n = np.add.reduceat(n[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        own = n >= (1 if length == 1 else LEAST)
        n, first = n[own], order[first[own]]
        return pa.table({"length": pa.array(np.full(len(n), length), pa.int32())}
                        | {c: x[first].view(np.int64) for c, x in (("key", key), ("context", context), ("suffix", suffix))} | {"n": n})

    return (train.select("text").mapInArrow(lambda it: _flushed(it, use), BLOCKS).groupBy("length", "part").applyInArrow(count, GRAMS))


def _words(train: DataFrame, bits: int) -> DataFrame:
    return _summed(train, lambda w, doc: [_blocks(1, w, w, w, bits)]).select("key", "n")


def _grams(train: DataFrame, bits: int, length: int, frequent: Filter, wanted: Filter | None) -> DataFrame:
    """Grams of ``length`` tokens that hold only grams of ``length`` - 1, at most three, tokens that pass ``frequent`` and whose
    context's suffix passes ``wanted``.  Beyond four also those up to ``STRIDE`` - 1 tokens longer whose context ends in one that
    does (by then more than can be retained), and the contexts themselves."""
    top = length + (STRIDE if length > 4 else 1)

    def use(w, doc):
        keys, i, known = w, np.arange(len(w)), min(length - 1, 3)
        for n in range(2, top):
            short, keys = keys, np.zeros(max(len(w) - n + 1, 0), np.uint64)
            if n <= known:
                keys[:] = longer(short)
                i = inside(doc, n)
            if n == known or n == 2 and known == 1:
                i = i[frequent.has(keys[i])] if known > 1 else np.flatnonzero(frequent.has(w))
            if n > known:  # both shorter ones have passed
                ok = np.zeros(len(w) + 1, bool)
                ok[i] = True
                i = i[ok[i + 1]]
                i = i[doc[i] == doc[i + 1]]
                keys[i] = joined(short[i], short[i + 1])
            if wanted is not None and n == length - 2:
                ends = np.zeros(len(w) + STRIDE, bool)
                at = i if n > 2 else inside(doc, 2)
                ends[at[wanted.has(keys[at])]] = True
            at = i[:0]
            if n >= length:
                at = i if wanted is None else i[ends[i + n - length + 1]]
            if length > 4 and length - 1 <= n < top - 1:
                at = i[ends[i + n - length + 2] | (n >= length) & ends[i + n - length + 1]]
            if len(at):
                yield _blocks(n, keys[at], short[at], short[at + 1], bits)

    return _summed(train, use)


@dataclass
class Filter:
    """Bits of a set of keys: ``has`` is true for all of them, and for some others."""
    words: np.ndarray
    mask: int

    @staticmethod
    def bits(n: int) -> int:
        """8 for each of ``n`` keys, or up to twice that."""
        return min(max((8 * n).bit_length(), 12), FILTER_BITS)

    @staticmethod
    def of(keys: DataFrame) -> Filter:
        bits = Filter.bits(keys.count())
        mask, page = (1 << bits) - 1, min(bits, PAGE_BITS)

        def places(batches):
            for held in _held(batches):
                key = held.view(np.uint64)
                at = np.sort(np.concatenate([key & np.uint64(mask), (key >> np.uint64(32)) & np.uint64(mask)]))
                cut = np.searchsorted(at, np.arange((1 << bits - page) + 1, dtype=np.uint64) << np.uint64(page))
                pages, at = np.flatnonzero(cut[1:] > cut[:-1]), (at & np.uint64((1 << page) - 1)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int32()), pa.array([at[cut[i]:cut[i + 1]].tobytes() for i in pages], pa.binary())],
                                                 ["page", "at"])

        def filled(rows: pa.Table) -> pa.Table:
            bit = np.zeros(1 << page, np.uint8)
            bit[_whole(rows["at"], "<u4")] = 1
            return pa.table({"page": rows["page"].slice(0, 1), "bits": [np.packbits(bit, bitorder="little").tobytes()]})

        got = keys.select("key").mapInArrow(places, "page int, at binary").groupBy("page").applyInArrow(filled, "page int, bits binary").toArrow()
        words = np.zeros((1 << bits - page, 1 << page >> 6), "<u8")
        for i, x in zip(got["page"], got["bits"], strict=True):
            words[i.as_py()] = np.frombuffer(x.as_buffer(), "<u8")
        return Filter(words.reshape(-1), mask)

    def has(self, keys: np.ndarray) -> np.ndarray:
        mask, out = np.uint64(self.mask), np.ones(len(keys), bool)
        for p in (keys & mask, (keys >> np.uint64(32)) & mask):
            out &= (self.words[p >> np.uint64(6)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


class Places:
    """Finds keys in a sorted array by their first bits."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.bits = np.append(keys, np.uint64(0)), max(len(keys).bit_length(), 1)
        begin = np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)
        self.begin = np.append(np.searchsorted(keys, begin), len(keys)).astype(np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 if it is not there."""
        own = _part(keys, self.bits)
        at, end = self.begin[own], self.begin[own + 1]
        found = (at < end) & (self.keys[at] == keys)
        todo = np.flatnonzero(~found & (at + 1 < end))
        while len(todo):
            at[todo] += 1
            hit = self.keys[at[todo]] == keys[todo]
            found[todo[hit]] = True
            todo = todo[~hit & (at[todo] + 1 < end[todo])]
        return np.where(found, at, -1)


@dataclass
class Tree:
    n: int  # training tokens
    v: int  # distinct ones
    longest: int  # tokens of the longest gram with a value
    floor: float  # count from which a key is looked up in the tasks
    bits: int  # first bits of a key that say with which others it is looked up
    words: Places  # frequent words
    counts: np.ndarray
    keys: Places  # frequent grams with a value
    values: np.ndarray
    rare: Filter  # the other grams with a value
    nodes: DataFrame  # (key, n, value) of all grams with a value

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.n + 0.1 * (self.v + 1)))

    def scores(self, w: np.ndarray, sizes: np.ndarray) -> tuple[dict[str, np.ndarray], list]:
        """Sums of some documents, and what is to be looked up for them later (here it counts as 0): the documents and keys of
        rare words and of rare grams."""
        docs, doc = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
        at = self.words.of(w)
        known = at >= 0
        base = np.zeros(len(w))
        base[known] = self.base(self.counts[at[known]])
        more = np.zeros(docs)
        found, keys = [], w
        for length in range(1, self.longest + 1):
            keys = longer(keys) if length > 1 else w
            i = inside(doc, length)
            if length > 3:  # the gram's context or, if it is one, its suffix has a value as well
                i = i[valued[i] | valued[i + 1]]
            at = self.keys.of(keys[i])
            own, at, i = i[at >= 0], at[at >= 0], i[at < 0]
            more += np.bincount(doc[own], self.values[at], docs)
            i = i[(known[i] if length == 1 else True) & self.rare.has(keys[i])]
            found.append((doc[i], keys[i]))
            valued = np.zeros(len(w) + 1, bool)
            valued[own] = valued[i] = True
        sums = {"n_tokens": sizes, "n_known": np.bincount(doc, known, docs).astype(np.int64), "base": np.bincount(doc, base, docs),
                "more": more}
        grams = tuple(np.concatenate([x[j] for x in found]) for j in (0, 1))
        return sums, [(doc[~known], w[~known]), grams]


def _retained(seen: DataFrame) -> DataFrame:
    """``seen`` (key, context, n, total of the context, parent: log10 probability under the context's suffix) with ``rest``
    (log10 of what the suffix's distribution is scaled by; null if the context is not retained), ``logp`` and ``value``."""
    n, parent = F.col("n"), F.col("parent")
    by = seen.groupBy("context").agg(
        F.max("total").alias("t"), F.sum("n").alias("s"), F.count("*").alias("k"), F.sum(F.pow(F.lit(10.0), parent)).alias("q"),
        F.sum(n * (F.log(n - DISCOUNT) - parent * float(np.log(10)))).alias("e"))
    by = by.withColumn("left", F.greatest(1 - (F.col("s") - DISCOUNT * F.col("k")) / F.col("t"), F.lit(1e-12))
                       / F.greatest(1 - F.col("q"), F.lit(1e-12)))
    gain = F.col("e") - F.col("s") * F.log("t") + (F.col("t") - F.col("s")) * F.log("left")
    by = by.where(gain > 0.5 * F.col("k") * F.log("t") + 2).select("context", F.log10("left").alias("rest"))
    own = F.log10((n - DISCOUNT) / F.col("total"))
    return seen.join(by.hint("shuffle_hash"), "context", "left").select(
        "key", "context", "n", "total", "rest", F.when(F.col("rest").isNull(), parent).otherwise(own).alias("logp"),
        F.when(F.col("rest").isNotNull(), own - parent - F.col("rest")).alias("value"))


def _sorted(rows: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order, and the value of each as a double."""
    got = rows.select("key", F.col(value).cast("double")).toArrow()
    key = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], got[value].to_numpy()[order]


def learn(train: DataFrame, scratch: Scratch) -> tuple[Tree, DataFrame]:
    """The tree, and ``(key, n)`` of all words."""
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max((size // PART_BYTES).bit_length(), 1)
    words = scratch.put(_words(train, bits), "words")
    n, v = words.select(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    at_root = F.log10((F.col("n") + 0.1) / F.lit(n + 0.1 * (v + 1)))
    total = lambda x: x.select(F.col("key").alias("context"), F.col("n").alias("total"))
    common = words.where(F.col("n") >= LEAST)
    frequent = Filter.of(common)
    grams = scratch.put(_grams(train, bits, 2, frequent, None), "grams2")
    seen = (grams.drop("length").join(common.select(F.col("key").alias("suffix"), at_root.alias("parent")).hint("shuffle_hash"), "suffix")
            .join(total(common).hint("shuffle_hash"), "context"))
    levels, length = [scratch.put(_retained(seen), "level2")], 2
    while True:
        length += 1
        last, shorter, done = levels[-1], grams, None
        kept = last.where("rest IS NOT NULL")
        wanted = shorter if length == 3 else kept.select(F.col("context").alias("key")).distinct()
        if (shorter if length == 3 else kept).isEmpty():
            break
        if length <= 4 or length >= counted:
            if length <= 4:
                frequent = Filter.of(shorter)
            counted = length + (STRIDE if length > 4 else 1)
            read = scratch.put(_grams(train, bits, length, frequent, Filter.of(wanted) if length > 3 else None), f"grams{length}")
            done = f"grams{length - 1}" if length <= 5 else name
            name = f"grams{length}"
        grams = read.where(F.col("length") == length)
        totals = total(shorter if length <= 4 else read.where(F.col("length") == length - 1))
        parents = (last if length == 3 else kept).select(F.col("key").alias("suffix"), F.col("logp").alias("parent"))
        seen = grams.drop("length").join(parents.hint("shuffle_hash"), "suffix").join(totals.hint("shuffle_hash"), "context")
        levels.append(scratch.put(_retained(seen), f"level{length}"))
        del seen, totals, parents
        if done:  # the shorter ones: the next length has the totals it needs in what was read now, or in these
            scratch.drop(done)
        train.sparkSession.sparkContext._jvm.System.gc()  # Spark then deletes the shuffle files of tables that are written
    parts = []
    for level in levels:
        kept = level.where("rest IS NOT NULL")
        parts += [kept.select("key", "n", "value"), kept.groupBy("context").agg(F.max("total"), F.max("rest"))]
    nodes = scratch.put(reduce(DataFrame.union, parts).groupBy("key").agg(F.max("n").alias("n"), F.sum("value").alias("value")), "nodes")
    floor = max(HOT * n, LEAST)
    frequent, counts = _sorted(words.where(F.col("n") >= floor), "n")  # at most 1 / HOT rows
    hot, values = _sorted(nodes.where(F.col("n") >= floor), "value")  # at most 1 / HOT rows of each length
    tree = Tree(n, v, length - 1, floor, max(bits - 1, 1), Places(frequent), counts, Places(hot), values,
                Filter.of(nodes.where(F.col("n") < floor)), nodes)
    del levels, grams, shorter, last, kept, wanted, level, parts
    scratch.drop_all("level", "grams")
    train.sparkSession.sparkContext._jvm.System.gc()
    return tree, words


def _asked(docs: DataFrame, tree: Tree) -> DataFrame:
    """For some documents at a time, known by the row number of the first: a row with what is known of them already (``own``),
    and their rare words and grams in one row for each range of keys."""
    bits, tree = tree.bits, replace(tree, nodes=None)  # a table does not travel

    def row(first, part, word=None, doc=None, key=None, own=None):
        n = len(part)
        return pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(np.full(n, first), pa.int64()), pa.array([word] * n, pa.bool_()),
             *(pa.array(x or [None] * n, pa.binary()) for x in (doc, key, own))], ["part", "first", "word", "doc", "key", "own"])

    def run(batches):
        for batch in batches:
            at = 0
            for w, sizes in _pieces(batch.column(2)):
                first, doc_id = batch.column(0)[at].as_py(), batch.column(1).slice(at, len(sizes))
                at += len(sizes)
                sums, rare = tree.scores(w, sizes)
                own = pa.table({"doc_id": doc_id} | sums)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as out:
                    out.write_table(own)
                yield row(first, [first % (1 << bits)], own=[sink.getvalue().to_pybytes()])
                for word, (doc, key) in zip((True, False), rare, strict=True):
                    part = _part(key, bits)
                    order = _stable(doc)
                    order = order[_stable(part[order])]
                    key, doc = key[order], doc[order].astype(np.uint32)
                    cut = np.append(0, np.cumsum(np.bincount(part, minlength=1 << bits)))
                    parts = np.flatnonzero(cut[1:] > cut[:-1])
                    yield row(first, parts, word, *([x[cut[p]:cut[p + 1]].tobytes() for p in parts] for x in (doc, key)))

    return docs.select(F.monotonically_increasing_id(), "doc_id", "text").mapInArrow(run, ASKED)


def _answers(asked: DataFrame, values: DataFrame, tree: Tree) -> DataFrame:
    """What the rare words and grams of a row of ``asked`` add to each of its documents; ``values``: part, key and either the
    count n of a word or the value of a gram."""
    tree = replace(tree, words=None, counts=None, keys=None, values=None, rare=None, nodes=None)

    def run(asked: pa.Table, values: pa.Table) -> pa.Table:
        key, n, value = (values[c].to_numpy() for c in ("key", "n", "value"))
        key, gram = key.view(np.uint64), n == 0
        words, grams = (x[np.argsort(key[x])] for x in (np.flatnonzero(~gram), np.flatnonzero(gram)))
        counts, added = np.append(n[words], 0), np.append(value[grams], 0.0)  # a place of -1 gives 0
        words, grams = Places(key[words]), Places(key[grams])
        out = {x: [b""] * len(asked) for x in ("doc", "base", "more", "known")}  # what is known already goes on as it is
        word = asked["word"].to_numpy()
        for of_words in (True, False):
            rows = np.flatnonzero(word == of_words)  # null is neither
            sizes = pc.binary_length(asked["doc"].take(pa.array(rows))).to_numpy() // 4
            for at in np.split(rows, np.flatnonzero(np.diff(np.cumsum(sizes) // FLUSH_TOKENS)) + 1):
                if not len(at):
                    continue
                docs, keys = (asked[c].take(pa.array(at)) for c in ("doc", "key"))
                doc, key = _whole(docs, "<u4"), _whole(keys, "<u8")
                begin = np.cumsum(pc.binary_length(docs).to_numpy() // 4)
                new = np.concatenate([[True], doc[1:] != doc[:-1]])
                new[begin[:-1]] = True  # of a row
                first = np.flatnonzero(new)
                found = {"doc": doc[first], "more": np.add.reduceat(added[grams.of(key)], first)}
                if of_words:
                    c = counts[words.of(key)]
                    found |= {"base": np.add.reduceat(tree.base(c), first), "known": np.add.reduceat(c > 0, first, dtype=np.uint32)}
                cut = np.append(0, np.searchsorted(first, begin))
                for name, x in found.items():
                    for i, row in enumerate(at):
                        out[name][row] = x[cut[i]:cut[i + 1]].tobytes()
        return pa.table({"first": asked["first"]} | {c: pa.array(x, pa.binary()) for c, x in out.items()} | {"own": asked["own"]})

    return asked.groupBy("part").cogroup(values.groupBy("part")).applyInArrow(run, ANSWERS)


def _sums(answers: DataFrame, doc_id: str) -> DataFrame:
    """Every document with what is known of it and what its rare words and grams add."""
    def run(rows: pa.Table) -> pa.Table:
        own = pa.ipc.open_stream(next(x.as_py() for x in rows["own"] if x.is_valid)).read_all()
        word = np.array([len(x.as_py()) > 0 for x in rows["base"]])
        doc, of_words = _whole(rows["doc"], "<u4"), _whole(rows["doc"].filter(pa.array(word)), "<u4")
        base, more, known = (np.bincount(d, _whole(rows[c], k), len(own))
                             for c, d, k in (("base", of_words, "<f8"), ("more", doc, "<f8"), ("known", of_words, "<u4")))
        base = base + own["base"].to_numpy()
        return pa.table({"doc_id": own["doc_id"], "n_tokens": own["n_tokens"], "n_known": own["n_known"].to_numpy() + known.astype(np.int64),
                         "base_score": base, "score": base + own["more"].to_numpy() + more})

    return answers.groupBy("first").applyInArrow(run, f"doc_id {doc_id}, n_tokens long, n_known long, base_score double, score double")


def score_documents(docs: DataFrame, tree: Tree, words: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` (doc_id, text) with n_tokens, n_known, base_score and score."""
    rare = F.col("n") < tree.floor
    values = (words.where(rare).select("key", "n", F.lit(0.0).alias("value"))
              .union(tree.nodes.where(rare).select("key", F.lit(0).cast("long"), "value"))
              .select(F.shiftrightunsigned("key", 64 - tree.bits).cast("int").alias("part"), "key", "n", "value"))
    return _sums(_answers(_asked(docs, tree), values, tree), docs.schema["doc_id"].dataType.simpleString())


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    with Scratch(spark, "suffixtree") as scratch:
        tree, words = learn(docs.where(~held), scratch)
        out = score_documents(docs, tree, words, scratch)
        return scratch.put(out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                                      F.lit(tree.n).cast("long").alias("train_tokens"), "base_score", "score"),
                           "result", keep=True)
