"""Driver contract, the English analysis and the registered queries on sf0.001."""

import os

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as E
from quarry.functions.stemmer import stemmed
from quarry.operators.english import english_word_count
from tests.porter import stem

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "count"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle_smoke(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from quarry.plans.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    df = E.queries()[name](spark, SMOKE)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)

    def norm(v):
        return round(v, 6) if isinstance(v, float) else v

    spark_rows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    oracle_rows = sorted((tuple(norm(v) for v in r) for r in res.fetchall()), key=repr)
    assert spark_rows == oracle_rows


def test_stemmer_examples():
    assert [stem(w) for w in ["caresses", "ponies", "hopping", "relational", "generalizations"]] == [
        "caress", "poni", "hop", "relat", "gener"]


def test_english_word_count(spark):
    df = spark.createDataFrame([("The cats' owner's CATS are running and ran",)], "text string")
    out = {r["word"]: r["count"] for r in english_word_count(df).collect()}
    assert out["cat"] == 2 and out["run"] == 1 and "the" not in out and "and" not in out
    assert out["owner"] == 1


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables absent")
def test_english_word_count_against_python(spark):
    """The query without a SQL oracle, against a plain-Python run of the same
    rules on the whole sf0.001 documents."""
    import collections

    import pyarrow.parquet as pq
    regex = pytest.importorskip("regex")
    from quarry.operators.english import ENGLISH_STOPWORDS, WORD

    docs = pq.read_table(f"{SMOKE}/documents.parquet", columns=["text"]).to_pylist()
    word_re = regex.compile(WORD)
    expected = collections.Counter()
    for d in docs:
        for raw in word_re.findall(d["text"] or ""):
            w = regex.sub("['’][sS]$", "", raw).lower()
            if w and w not in ENGLISH_STOPWORDS:
                expected[stem(w)] += 1
    got = {r["word"]: r["count"] for r in E.queries()["english_word_count"](spark, SMOKE).collect()}
    assert got == dict(expected)
    by_function = {r["word"]: r["count"] for r in E.queries()["stem_function_count"](spark, SMOKE).collect()}
    assert by_function == dict(expected)


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables absent")
def test_stemmer_expressions_against_python(spark):
    """Every distinct word of the largest table here, and made-up words of many y and suffixes."""
    import random

    from quarry.operators.english import english_terms

    sf = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else SMOKE
    words = english_terms(spark.read.parquet(f"{sf}/documents.parquet")).distinct()
    rnd = random.Random(1)
    ends = ["", "s", "ed", "ing", "ational", "ness", "ion", "e", "ll", "y", "eed", "ful", "iviti", "sses", "ement", "logi"]
    made = {"".join(rnd.choice("aeiouybcdlstzx") for _ in range(rnd.randint(0, 9))) + rnd.choice(ends) for _ in range(5000)}
    made |= {"y" * k for k in range(1, 15)} | {"c" + "y" * k for k in range(1, 15)} | {"naïveness", "東京", "🙂ing"}
    df = words.union(spark.createDataFrame([(w,) for w in made], "word string")).withColumn("s", F.lit("kept"))
    got = stemmed(df, "word", "stem").collect()
    assert len(got) > 50_000 or sf == SMOKE
    assert [(r["word"], r["stem"]) for r in got if r["stem"] != stem(r["word"])] == [] and all(r["s"] == "kept" for r in got)
    assert stemmed(spark.createDataFrame([(None,)], "word string"), "word", "word").first()[0] is None


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver tables absent")
def test_value_change_against_sequential_fold(spark):
    """W1 on the whole sf0.001 events table against the sequential fold."""
    import pyarrow.parquet as pq

    ev = pq.read_table(f"{SMOKE}/events.parquet", columns=["user_id", "ts", "event_id", "value"]).to_pylist()
    expected, last = {}, {}
    for e in sorted(ev, key=lambda e: (e["user_id"], e["ts"], e["event_id"])):
        prev = last.get(e["user_id"], 0.0)
        if abs(e["value"] - prev) > 1e-6:
            expected[e["event_id"]] = e["value"] - prev
            last[e["user_id"]] = e["value"]
    got = {r["event_id"]: r["change"] for r in E.queries()["value_change"](spark, SMOKE).collect()}
    assert got == expected
