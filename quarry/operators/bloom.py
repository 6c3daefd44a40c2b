"""Bloom filter sharded by key hash, and the Bloom-filtered semi join.

Build (A13): a hash of the key picks its shard, two more the ``k`` bits in it.  Every shard has the same fixed number of bits
and is built by one task from the distinct keys that hash to it, so a filter of any number of keys keeps its rate: more keys are
more shards, not a fuller or a larger array.

Probe (J5): rows of the large side meet their own shard in a left semi join whose condition tests the ``k`` bits.  A filter whose size
(shards times bits, known before it is built) is within ``max_broadcast`` is broadcast, so probing is a narrow filter before any
shuffle; a larger one is joined by shard.  False positives are removed by the exact semi join that follows (``bloom_semi_join``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregate import with_counters
from quarry.operators.joins import DEFAULT_BROADCAST_BYTES, semi_join
from quarry.sources.sinks import stage

# The reference's filter shape.
REFERENCE_BITS = 10_000
REFERENCE_HASHES = 2

SHARD_BITS = 1 << 17  # 16 KiB a shard; some 13,700 keys at 1 %
_SHARD_SEED = 1_000


@dataclass(frozen=True)
class Shape:
    bits: int      # of each shard
    hashes: int
    shards: int = 1

    @property
    def bytes(self) -> int:
        return self.shards * (self.bits + 63) // 64 * 8


def optimal_shape(expected_keys: int, fp_rate: float = 0.01, shard_bits: int = SHARD_BITS) -> Shape:
    """As many shards as ``expected_keys`` need at ``fp_rate``; keys that fit one get a smaller one."""
    n = max(1, expected_keys)
    per_key = -math.log(fp_rate) / math.log(2) ** 2
    shards = math.ceil(n * per_key / shard_bits)
    bits = shard_bits if shards > 1 else max(64, math.ceil(n * per_key))
    return Shape(bits, max(1, min(16, round(per_key * math.log(2)))), shards)


def _places(key: Column, shape: Shape) -> tuple[Column, Column, Column]:
    """Shard, first bit and step of a key: its bits are ``first + i * step`` modulo the bits of a shard."""
    return (F.pmod(F.xxhash64(key, F.lit(_SHARD_SEED)), F.lit(shape.shards)).cast("int"),
            F.pmod(F.xxhash64(key, F.lit(0)), F.lit(shape.bits)).cast("int"),
            (F.pmod(F.xxhash64(key, F.lit(1)), F.lit(max(1, shape.bits // 2))) * 2 + 1).cast("int"))


def build_filter(keys: DataFrame, key: Column | str, m: int = REFERENCE_BITS, k: int = REFERENCE_HASHES,
                 shards: int = 1) -> DataFrame:
    """One row a shard that holds a key, ``shard INT, bits ARRAY<BIGINT>`` (``ceil(m/64)`` words).  Null keys are no keys.
    Equal keys are combined in each task before they are dealt to shards."""
    key = F.col(key) if isinstance(key, str) else key
    shape = Shape(m, k, shards)

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros((m + 63) // 64 * 64, np.uint64)
        first, step = pdf["first"].to_numpy().astype(np.int64), pdf["step"].to_numpy().astype(np.int64)
        for i in range(k):
            bits[(first + i * step) % m] = 1
        words = (bits.reshape(-1, 64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "bits": [words]})

    shard, first, step = _places(key, shape)
    distinct = keys.where(key.isNotNull()).select(shard.alias("shard"), first.alias("first"), step.alias("step")).distinct()
    return distinct.groupBy("shard").applyInPandas(built, "shard int, bits array<bigint>")


def merge_filters(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter of both key sets, from two filters of one shape."""
    left, right = a.withColumnRenamed("bits", "x"), b.withColumnRenamed("bits", "y")
    either = F.zip_with("x", "y", lambda x, y: x.bitwiseOR(y))
    return left.join(right, "shard", "full").select("shard", F.coalesce(either, "x", "y").alias("bits"))


def might_contain(bits: Column, key: Column, shape: Shape) -> Column:
    """True when every bit of ``key`` is set in its shard's ``bits`` (may be a false positive)."""
    _, first, step = _places(key, shape)
    cond = F.lit(True)
    for i in range(shape.hashes):
        p = F.pmod(first.cast("long") + F.lit(i) * step.cast("long"), F.lit(shape.bits))
        bit = F.call_function("getbit", F.element_at(bits, F.shiftright(p, 6).cast("int") + 1), F.pmod(p, F.lit(64)).cast("int"))
        cond = cond & (bit == F.lit(1))
    return cond


def bloom_prefilter(big: DataFrame, big_key: Column | str, filter_df: DataFrame, m: int = REFERENCE_BITS,
                    k: int = REFERENCE_HASHES, shards: int = 1, max_broadcast: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """J5 probe: rows of ``big`` that may have a partner (superset of the
    semi join)."""
    big_key = F.col(big_key) if isinstance(big_key, str) else big_key
    shape = Shape(m, k, shards)
    held = filter_df.select(F.col("shard").alias("_shard"), F.col("bits").alias("_bits"))
    held = F.broadcast(held) if shape.bytes <= max_broadcast else held
    shard = _places(big_key, shape)[0]
    return big.join(held, (shard == F.col("_shard")) & might_contain(F.col("_bits"), big_key, shape), "left_semi")


def bloom_semi_join(big: DataFrame, small: DataFrame, big_key: str, small_key: str,
                    m: int | None = REFERENCE_BITS, k: int | None = REFERENCE_HASHES,
                    expected_keys: int | str | None = None, fp_rate: float = 0.01,
                    verify: bool = True, counters: bool = False, max_broadcast: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Build the filter over ``small``'s keys, drop rows of ``big``
    that cannot match before any shuffle, then (``verify``) make the result
    exact with a semi join.

    ``expected_keys="auto"`` writes the distinct keys of ``small`` once (``stage``), counts them, and builds, verifies and sizes
    the filter for ``fp_rate`` from those; a number sizes it without that.  Without either the filter has the
    reference's fixed 10,000 bits and 2 hashes, which fill up once the key set is large.  ``counters`` observes the
    candidate and verified row counts; after an action ``result.false_positives()`` gives their difference (the reference's
    false-positive counter)."""
    keys, shape = small.select(F.col(small_key).alias(big_key)), Shape(m, k)
    if expected_keys == "auto":
        keys = stage(keys.distinct())
        expected_keys = keys.count()
    if expected_keys is not None:
        shape = optimal_shape(expected_keys, fp_rate)
    filt = build_filter(keys, big_key, shape.bits, shape.hashes, shape.shards)
    candidates = bloom_prefilter(big, big_key, filt, shape.bits, shape.hashes, shape.shards, max_broadcast)
    if counters:  # A16: rows passing the filter, read after an action
        candidates = with_counters(candidates, "bloom_candidates", candidates=F.count(F.lit(1)))
    if not verify:
        return candidates
    out = semi_join(candidates, keys, big_key)
    if counters:
        obs = candidates.observation
        out = with_counters(out, "bloom_verified", verified=F.count(F.lit(1)))
        out.false_positives = lambda: obs.get["candidates"] - out.observation.get["verified"]
    return out
