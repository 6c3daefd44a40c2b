"""Remaining small operators: lookups, totals, partitioning, parsing, plans."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as C
from quarry.operators import aggregate, joins, ordering
from quarry.plans.registry import QUERIES
from tests.conftest import executed_plan, rows


def test_lookup_sum_and_total(spark):
    counts = spark.createDataFrame([("the", 4), ("dog", 1)], "word string, count long")
    q = spark.createDataFrame([("cat",), ("the",), ("dog",), ("jumped",)], "word string")
    assert joins.lookup_sum(q, counts).first()[0] == 5
    assert joins.lookup_sum(q.where("word = 'cat'"), counts).first()[0] == 0
    assert aggregate.total_of(counts.where("count > 100"), "count").first()[0] == 0


def test_partitioning_helpers(spark):
    df = spark.createDataFrame([(f"{c}x", i) for i, c in enumerate("ABCDEFG")], "k string, v int")
    placed = ordering.partition_by_first_letter(df, "k", 3, base="A")
    assert placed.rdd.getNumPartitions() == 3
    by_part = placed.select("k", F.spark_partition_id().alias("p")).collect()
    # partition i holds exactly the rows of index i
    assert all(r["p"] == (ord(r["k"][0]) - ord("A")) % 3 for r in by_part) and len(by_part) == 7
    odd = spark.createDataFrame([(None,), ("",), ("zz",)], "k string")
    assert sorted(r[0] for r in ordering.partition_by_first_letter(odd, "k", 3).select(F.spark_partition_id()).collect()) == [0, 0, ord("z") % 3]
    assert ordering.spread(df, 5).rdd.getNumPartitions() == 5
    assert ordering.fixed_outputs(ordering.spread(df, 5), 2).rdd.getNumPartitions() == 2


def test_total_order_and_secondary_sort(spark):
    df = spark.createDataFrame([(k, d) for k in "bca" for d in (3, 1, 2)] * 5, "k string, d int")
    parts = ordering.total_order(df, ["k", "d"], 3).rdd.glom().collect()
    flat = [tuple(r) for p in parts for r in p]
    assert flat == sorted(flat)
    sec = ordering.secondary_sort(df, ["k"], ["d"], 2).rdd.glom().collect()
    assert [tuple(r) for p in sec for r in p] == sorted(flat)


def test_places_of_a_sorted_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(5)
    got = ordering.placed(ordering.total_order(df, ["x"], 7)).collect()
    assert sorted((r["position"], r["x"]) for r in got) == [(i + 1, i) for i in range(1000)]
    unsorted = ordering.placed(df).collect()
    assert sorted(r["position"] for r in unsorted) == list(range(1, 1001))
    assert any(r["position"] != r["x"] + 1 for r in unsorted)  # the places are those of the rows as they lie
    assert ordering.placed(ordering.total_order(df.limit(0), ["x"])).count() == 0


def test_one_repeated_line_is_cut(spark):
    lines = [("hot", "x")] * 3000 + [(f"k{i:03d}", str(i)) for i in range(200)] * 5 + [(None, "n")] * 3
    df = spark.createDataFrame(lines, "k string, line string").repartition(4)
    out = ordering.ordered_copies(df, ["k", "line"], num_partitions=8, piece=10)
    parts = out.rdd.glom().collect()
    flat = [tuple(r) for p in parts for r in p]
    assert flat == sorted(lines, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert sum(any(r["k"] == "hot" for r in p) for p in parts) > 2 and max(map(len, parts)) < 2500
    hits = spark.createDataFrame([("a", 2), ("b", 0), ("a", 1)], "line string, hits int")
    assert [r[0] for r in ordering.ordered_copies(hits, ["line"], "hits").collect()] == ["a"] * 3


def test_parse_helpers(spark):
    df = spark.createDataFrame([(" 42 ", "2009-01-02", "x")], "n string, d string, bad string")
    r = df.select(C.parse_number("n", "long"), C.parse_date("d"), C.parse_number("bad", permissive=True)).first()
    assert r[0] == 42 and str(r[1]) == "2009-01-02" and r[2] is None
    with pytest.raises(Exception):
        df.select(C.parse_number("bad")).collect()
    b = df.select(C.bytes_to_string(C.string_to_bytes("d")).alias("s")).first()[0]
    assert b == "2009-01-02"


def test_composite_key(spark):
    df = spark.createDataFrame([("Doe", "Jo")], "a string, b string")
    assert df.select(C.composite_key("a", "b")).first()[0] == "Doe, Jo"
    assert df.select(C.composite_key("a", "b", sep=",")).first()[0] == "Doe,Jo"


@pytest.mark.parametrize("name", ["value_change", "moving_average", "best_window"])
def test_series_plans_avoid_key_windows(spark, name):
    plan = executed_plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "Window" not in plan
    # range partitioning (one slice when the input is a single split)
    assert "rangepartitioning" in plan.lower() or "singlepartition" in plan.lower()


def test_rows_helper(spark):
    assert rows(spark.createDataFrame([(2,), (1,)], "x int")) == [(1,), (2,)]


def test_mean_uses_wide_sums(spark):
    # partial sums beyond 32 bits (the reference's combiner parsed them as int)
    df = spark.createDataFrame([("CA", 2_000_000_000), ("CA", 2_000_000_000), ("CA", 2_000_000_001)],
                               "state string, income long")
    assert rows(aggregate.mean_by_key(df, "state", "income")) == [("CA", 2_000_000_000 + 1 / 3)]


def test_reformat_typed_dates(spark):
    df = spark.createDataFrame([("2009-01-02 10:00:00",)], "s string").select(F.to_timestamp("s").alias("ts"))
    assert df.select(C.reformat_date("ts", None)).first()[0] == "2009"


def test_double_order_is_the_order_of_doubles(spark):
    import random
    import struct

    rnd = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308,
              float("inf"), float("-inf"), 0.1, 0.30000000000000004, 0.3, 2.0 ** 52, 2.0 ** 53 - 1, 1024.0, 1023.9999999999999]
    values += [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(3000)]
    values += [2.0 ** rnd.randint(-1074, 1023) * s for s in (1, -1) for _ in range(300)]
    values = [v for v in values if v == v]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for v, got in aggregate.with_double_order(df, "v", "o").collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert got == (-bits if v < 0 else bits)
    nan = aggregate.with_double_order(spark.createDataFrame([(float("nan"),)], "v double"), "v", "o").first()["o"]
    assert nan > struct.unpack("<q", struct.pack("<d", float("inf")))[0]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string", "int"])
def test_max_with_first_date(spark, kind):
    import datetime as dt

    rows_ = [("a", 2.5, 5), ("a", 2.5, 3), ("a", 1.0, 1), ("a", None, 0), ("b", -1.0, 2), ("b", -3.0, 1), ("c", None, 4),
             ("d", 7.0, None), ("d", 7.0, 9), ("e", 7.0, None), (None, 1.5, 8), (None, 1.5, 7)]
    day = lambda i: None if i is None else dt.date(1969, 12, 28) + dt.timedelta(days=i)
    df = spark.createDataFrame([(k, v, day(i), i) for k, v, i in rows_], "k string, v double, d date, i int")
    df = df.select("k", "v", (F.col("i") if kind == "int" else F.col("d").cast(kind)).alias("d")).repartition(3)
    out = aggregate.max_with_date(df, "k", "v", "d")
    back = (lambda i: i) if kind == "int" else day
    got = {r["k"]: (r["max_value"], r["max_date"] if kind == "int" or r["max_date"] is None else dt.date.fromisoformat(str(r["max_date"])[:10]))
           for r in out.collect()}
    assert got == {"a": (2.5, back(3)), "b": (-1.0, back(2)), "c": (None, None if kind != "string" else got["c"][1]), "d": (7.0, back(9)),
                   "e": (7.0, None), None: (1.5, back(7))}
    plan = executed_plan(out)
    final = plan.split("Initial Plan")[0]
    assert "SortAggregate" not in final or kind == "string"
    assert final.count("HashAggregate") == 2 or kind == "string"
