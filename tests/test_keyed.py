"""Keyed tables: replace, upsert, lookup and joins without a shuffle."""

import contextlib
import io
import uuid

import pytest
from pyspark.sql import functions as F

from quarry.sources.keyed import KeyedTable
from tests.conftest import executed_plan, rows


@pytest.fixture()
def make(spark):
    made = []

    def new(keys, **kw):
        made.append(KeyedTable(spark, f"quarry_test_{uuid.uuid4().hex}", keys, **kw))
        return made[-1]

    yield new
    for t in made:
        t.drop()


def test_replace_and_upsert(spark, make):
    t = make(["k"], parts=4, buckets=3)
    t.replace(spark.createDataFrame([(i, f"old{i}") for i in range(50)] + [(None, "old")], "k long, v string"))
    want = {i: f"old{i}" for i in range(50)} | {None: "old"}
    assert dict(rows_of(t)) == want
    new = {3: "new", 7: None, 99: "added", None: "nobody"}
    t.upsert(spark.createDataFrame([(v, k) for k, v in new.items()], "v string, k long"))
    assert dict(rows_of(t)) == want | new and len(rows_of(t)) == 52
    t.upsert(spark.createDataFrame([], "k long, v string"))
    assert len(rows_of(t)) == 52
    t.replace(spark.createDataFrame([(1, "only")], "k long, v string"))
    assert rows_of(t) == [(1, "only")]


def rows_of(t):
    return [tuple(r) for r in t.rows().collect()]


def test_an_upsert_leaves_other_parts_alone(spark, make):
    t = make(["k"], parts=8, buckets=2)
    t.replace(spark.range(200).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    files = lambda: {r[0] for r in spark.table(t.name).select(F.input_file_name()).distinct().collect()}
    before = files()
    t.upsert(spark.createDataFrame([(5, "new")], "k long, v string"))
    part = spark.table(t.name).where("k = 5").first()["_part"]
    assert {f for f in before ^ files() if f"_part={part}/" not in f} == set() and before != files()


def test_join_of_two_tables_has_no_exchange(spark, make):
    a, b = make(["k", "d"]), make(["k", "d"])
    a.replace(spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("d"), F.lit(1).alias("x")))
    b.replace(spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("d"), F.lit(2).alias("y")))
    b.upsert(spark.createDataFrame([(1, "1", 3)], "k long, d string, y int"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = a.join(b)
        assert joined.count() == 251 and "Exchange" not in executed_plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(joined.where("k = 1"), "x", "y") == [(1, 3)]


def test_lookup_reads_one_part(spark, make):
    t = make(["k"], parts=4, buckets=8)
    t.replace(spark.range(300).select(F.col("id").alias("k"), F.lit("v").alias("v")))
    one = t.get(k=42)
    assert [tuple(r) for r in one.collect()] == [(42, "v")] and t.get(k=999).count() == 0
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        one.explain()
    assert "PartitionFilters: [isnotnull(_part" in out.getvalue() and "EqualTo(k,42)" in out.getvalue()
