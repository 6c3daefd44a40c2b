"""The skew-safe ordered scan against plain sequential Python.

One key holds most rows and the scan uses many partitions, so keys span
partition boundaries (and several partitions hold only the hot key)."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.plans.scan import (OrderedScan, RowIndex, Rolling, ValueChange, rolling_mean, row_index, running_sums,
                               value_changes)
from tests.conftest import executed_plan


def _data(seed=7, n_hot=400, n_cold=60):
    rnd = random.Random(seed)
    out = []
    t = 0
    for k, n in [("hot", n_hot)] + [(f"k{i}", rnd.randint(1, 6)) for i in range(n_cold)]:
        v = 1.0
        for _ in range(n):
            t += 1
            step = rnd.choice([0.0, 0.0, 5e-7, -4e-7, 1e-6, 0.25, -0.5, 3.0])
            v = round(v + step, 9)
            out.append((k, t, v))
    rnd.shuffle(out)
    return out


def _brute(data, width, eps=1e-6):
    by = {}
    for k, t, v in sorted(data):
        by.setdefault(k, []).append((t, v))
    rn, ma, ch = {}, {}, {}
    for k, seq in by.items():
        last = 0.0
        for i, (t, v) in enumerate(seq):
            rn[(k, t)] = i + 1
            w = [x for _, x in seq[max(0, i - width + 1): i + 1]]
            ma[(k, t)] = sum(w) / len(w)
            if abs(v - last) > eps:
                ch[(k, t)] = v - last
                last = v
    return rn, ma, ch


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_scan_matches_sequential(spark, parts):
    data = _data()
    df = spark.createDataFrame(data, "k string, t long, v double")
    rn, ma, ch = _brute(data, 4)
    got_rn = {(r["k"], r["t"]): r["rn"] for r in row_index(df, ["k"], ["t"], num_partitions=parts).collect()}
    assert got_rn == rn
    roll = OrderedScan(["k"], ["t"], Rolling("v", 4), parts, ["k", "t", "v"]).apply(df).collect()
    assert {(r["k"], r["t"]): round(r["moving_avg"], 9) for r in roll} == {k: round(v, 9) for k, v in ma.items()}
    fold = OrderedScan(["k"], ["t"], ValueChange("v"), parts, ["k", "t", "v"]).apply(df).collect()
    assert {(r["k"], r["t"]): round(r["change"], 9) for r in fold} == {k: round(v, 9) for k, v in ch.items()}


def test_scan_drift_across_partitions(spark):
    # a single key of sub-threshold steps spanning many partitions
    vals = [1.0 + i * 4e-7 for i in range(300)]
    data = [("d", i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(data, "k string, t long, v double")
    _, _, ch = _brute(data, 1)
    fold = OrderedScan(["k"], ["t"], ValueChange("v"), 13, ["k", "t", "v"]).apply(df).collect()
    assert {(r["k"], r["t"]): round(r["change"], 12) for r in fold} == {k: round(v, 12) for k, v in ch.items()}


def test_scan_plan_uses_range_partitioning(spark):
    df = spark.createDataFrame(_data(n_hot=50, n_cold=5), "k string, t long, v double")
    scan = OrderedScan(["k"], ["t"], RowIndex(), 4, ["k", "t"])
    assert "rangepartitioning" in executed_plan(scan._sorted(df)).lower()
    # both passes read the same slices: no range exchange of their own that could be sampled apart
    assert "rangepartitioning" not in executed_plan(scan.apply(df)).lower()


def test_scan_small_arrow_batches(spark):
    # runs cross Arrow batch boundaries inside a partition as well
    data = _data(seed=3, n_hot=120, n_cold=30)
    df = spark.createDataFrame(data, "k string, t long, v double")
    rn, ma, ch = _brute(data, 3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got_rn = {(r["k"], r["t"]): r["rn"] for r in row_index(df, ["k"], ["t"], num_partitions=4).collect()}
        roll = OrderedScan(["k"], ["t"], Rolling("v", 3), 4, ["k", "t", "v"]).apply(df).collect()
        fold = OrderedScan(["k"], ["t"], ValueChange("v"), 4, ["k", "t", "v"]).apply(df).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got_rn == rn
    assert {(r["k"], r["t"]): round(r["moving_avg"], 9) for r in roll} == {k: round(v, 9) for k, v in ma.items()}
    assert {(r["k"], r["t"]): round(r["change"], 9) for r in fold} == {k: round(v, 9) for k, v in ch.items()}


def test_hot_key_is_split_across_partitions(spark):
    # one key holds a third of all rows: the range cut points split it
    rows_ = [("hot", i, float(i % 7)) for i in range(3000)] + \
            [(f"k{i % 900}", i, float(i % 5)) for i in range(6000)]
    df = spark.createDataFrame(rows_, "k string, t long, v double")
    scan = OrderedScan(["k"], ["t"], RowIndex(), 8, ["k", "t"])
    sizes = scan._sorted(df).groupBy("_pid").count().collect()
    hot_parts = scan._sorted(df).where("k = 'hot'").select("_pid").distinct().count()
    assert max(r["count"] for r in sizes) < 3000          # no task holds the whole hot key
    assert hot_parts >= 2
    got = {r["t"]: r["rn"] for r in scan.apply(df).where("k = 'hot'").collect()}
    assert got == {i: i + 1 for i in range(3000)}


def test_wide_rolling_window_prefix_sums(spark):
    data = _data(seed=9, n_hot=400, n_cold=20)
    df = spark.createDataFrame(data, "k string, t long, v double")
    _, ma, _ = _brute(data, 100)
    roll = OrderedScan(["k"], ["t"], Rolling("v", 100), 5, ["k", "t", "v"]).apply(df).collect()
    got = {(r["k"], r["t"]): r["moving_avg"] for r in roll}
    assert got.keys() == ma.keys()
    assert all(abs(got[key] - ma[key]) < 1e-9 for key in ma)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_scan_with_extra_columns_equals_windows(spark, reuse):
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window

    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(60_000, numPartitions=4).select(
            (F.col("id") % 3).alias("k"), F.xxhash64("id").alias("t"), (F.col("id") % 1000).cast("double").alias("v"),
            F.concat(F.lit("extra"), F.col("id").cast("string")).alias("more"))
        w = Window.partitionBy("k").orderBy("t")
        want = df.withColumn("want", F.row_number().over(w)).withColumn("mean", F.avg("v").over(w.rowsBetween(-3, 0)))
        got = row_index(df, ["k"], ["t"], num_partitions=8)
        assert got.join(want, ["k", "t"]).where("rn <> want").count() == 0
        got = rolling_mean(df, ["k"], ["t"], "v", 4, num_partitions=8).select("k", "t", "rn", "moving_avg")
        both = got.join(want, ["k", "t"])
        assert both.count() == 60_000 and both.where("rn <> want or abs(moving_avg - mean) > 1e-9").count() == 0
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("width", [4, 64, 65, 200])
def test_rolling_mean_mixed_magnitudes_and_nulls(spark, width):
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window

    big = F.when(F.col("id") % 2 == 0, F.lit(1e17)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") / 1000)
    df = spark.range(4000, numPartitions=3).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"), big.alias("v"))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(-(width - 1), 0)
    both = rolling_mean(df, ["k"], ["t"], "v", width, num_partitions=5).join(
        df.select("k", "t", F.avg("v").over(w).alias("want")), ["k", "t"])
    wrong = both.where("not (moving_avg <=> want) and not coalesce(abs(moving_avg - want) <= 1e-9 * abs(want), false)")
    assert both.count() == 4000 and wrong.count() == 0


def _fold(values, eps, last=0.0):
    out = []
    for i, v in enumerate(values):
        if v is not None and v == v and abs(v - last) > eps:
            out.append((i, v - last))
            last = v
    return out, last


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0.0, 0.3, 0.6, 1.0, 1.1, 1.4, 1.9, 2.0, 2.5, 3.1, 7.0]), min_size=1, max_size=40),
       st.lists(st.integers(0, 40), max_size=4), st.sampled_from([-5.0, 0.0, 0.3, 0.9, 1.5, 2.2, 3.0, 9.0]),
       st.sampled_from([0.5, 1.0]))
def test_transfer_function_equals_the_fold(values, cuts, last, eps):
    import json

    fold = ValueChange("v", eps)
    summary, at = fold.blank(), sorted({0, len(values), *(c for c in cuts if c < len(values))})
    for a, b in zip(at, at[1:], strict=False):
        summary = json.loads(json.dumps(fold.extend(summary, {"v": np.array(values[a:b])}, b - a)))
    assert fold.close(summary, {"last": last, "prev": 0.0})["last"] == _fold(values, eps, last)[1]


def test_constant_hot_key_has_summaries_of_constant_size(spark):
    df = spark.range(80_000, numPartitions=4).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.lit(3.5).alias("v"))
    scan = OrderedScan(["k"], ["t"], ValueChange("v"), 8, ["k", "t", "v"])
    rows = scan.summaries(scan._sorted(df).checkpoint()).collect()
    assert len(rows) == 8 and all(r["single"] and len(r["known"]) < 150 for r in rows)
    assert [(r["t"], r["change"]) for r in scan.apply(df).collect()] == [(0, 3.5)]


@pytest.mark.parametrize("max_pieces", [0, 1, 512])
def test_value_change_of_drifts_and_nulls_over_slices(spark, max_pieces):
    rnd = random.Random(max_pieces)
    series = {"drift": [1 + i * 4e-7 for i in range(400)], "saw": [1 + (i % 9) * 4e-7 for i in range(400)],
              "nulls": [1.0, None, 2.0, 2.0, float("nan"), 5.0], None: [None, 0.0, 4.0, None, 4.0],
              "noise": [rnd.choice([1.0, 1.0000004, 1.0000009, None, 1.0000015, 2.0]) for _ in range(300)]}
    rows = [(k, i, v) for k, vs in series.items() for i, v in enumerate(vs)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = value_changes(df, ["k"], ["t"], "v", num_partitions=13, max_pieces=max_pieces).collect()
    want = [(k, i, c) for k, vs in series.items() for i, c in _fold(vs, 1e-6)[0]]
    assert sorted(((r["k"], r["t"], r["change"]) for r in got), key=repr) == sorted(want, key=repr)


def test_long_keys_beside_a_null_key(spark):
    big = [9007199254740992, 9007199254740993, None, 9007199254740995]
    df = spark.createDataFrame([(k, t, float(t)) for k in big for t in range(6)], "k long, t long, v double").repartition(3)
    for parts in (1, 4):
        got = {(r["k"], r["t"]): r["rn"] for r in row_index(df, ["k"], ["t"], num_partitions=parts).collect()}
        assert got == {(k, t): t + 1 for k in big for t in range(6)}
    nan = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (1.0, 1)], "k double, t long")
    assert sorted(r["rn"] for r in row_index(nan, ["k"], ["t"], num_partitions=1).collect()) == [1, 1, 2]


def test_running_sums_wrap_around(spark):
    top = (1 << 63) - 1
    rows = [("a", i, top if i % 3 else -i, i) for i in range(50)] + [("b", i, i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, t long, x long, y long").repartition(3)
    got = {(r["k"], r["t"]): (r["sx"], r["sy"]) for r in running_sums(df, ["k"], ["t"], {"x": "sx", "y": "sy"}, 7).collect()}
    was = {(r["k"], r["t"]): r["by"] for r in running_sums(df, ["k"], ["t"], {"y": "sy"}, 7, {"y": "by"}).collect()}
    for k in "ab":
        sx = sy = 0
        for _, t, x, y in [r for r in rows if r[0] == k]:
            sx, sy = (sx + x + (1 << 63)) % (1 << 64) - (1 << 63), sy + y
            assert got[(k, t)] == (sx, sy) and was[(k, t)] == sy - y


def test_scan_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, t long, v double")
    assert value_changes(df, ["k"], ["t"], "v").count() == row_index(df, ["k"], ["t"]).count() == 0


def test_a_step_that_rounds_just_above_eps_is_an_event():
    fold, values = ValueChange("v", 0.5), [1.1, 0.6, 1.1]  # 1.1 - 0.6 > 0.5, though 0.6 + 0.5 rounds to 1.1
    summary = fold.extend(fold.blank(), {"v": np.array(values)}, 3)
    assert fold.close(summary, {"last": -5.0, "prev": 0.0})["last"] == _fold(values, 0.5, -5.0)[1] == 1.1
