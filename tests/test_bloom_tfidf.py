"""Bloom semi join properties and the TF-IDF fixture (FIXTURES A8)."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import bloom, joins, tfidf
from tests.conftest import executed_plan, rows


def test_bloom_superset_then_exact(spark):
    big = spark.range(0, 3000).withColumnRenamed("id", "k")
    small = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    filt = bloom.build_filter(small, "k", 10_000, 2)
    cand = bloom.bloom_prefilter(big, "k", filt, 10_000, 2)
    exact = joins.semi_join(big, small, "k")
    cand_keys = {r[0] for r in cand.collect()}
    exact_keys = {r[0] for r in exact.collect()}
    assert exact_keys <= cand_keys                  # no false negatives
    assert len(cand_keys) < 3000                    # it does filter
    verified = bloom.bloom_semi_join(big, small, "k", "k")
    assert {r[0] for r in verified.collect()} == exact_keys


def test_bloom_shape():
    one = bloom.optimal_shape(1000, 0.01)
    assert 9000 < one.bits < 10000 and one.hashes == 7 and one.shards == 1
    for n in (10**6, 10**9, 10**12):  # no cap: bits a key stay the same, a shard never grows
        many = bloom.optimal_shape(n, 0.01)
        assert many.bits == bloom.SHARD_BITS and 9.58 < many.shards * many.bits / n < 9.8


@pytest.mark.parametrize("max_broadcast", [1 << 26, 0])
def test_rate_at_twenty_million_keys(spark, max_broadcast):
    n = 20_000_000 if max_broadcast else 200_000
    shape = bloom.optimal_shape(n, 0.01)
    args = shape.bits, shape.hashes, shape.shards
    filt = bloom.build_filter(spark.range(n), "id", *args).checkpoint()
    assert filt.count() == shape.shards
    probe = lambda df: bloom.bloom_prefilter(df, "id", filt, *args, max_broadcast=max_broadcast).count()
    assert probe(spark.range(0, n, 20)) == n // 20                      # no false negative
    strangers = spark.range(n, n + 1_000_000)
    assert probe(strangers) / 1_000_000 < 0.012


def test_shards_hot_nulls_and_merge(spark):
    shape = bloom.Shape(512, 3, 5)
    args = shape.bits, shape.hashes, shape.shards
    small = spark.createDataFrame([("hot",)] * 2000 + [(None,)] + [(f"k{i}",) for i in range(40)], "k string")
    big = spark.createDataFrame([("hot",)] * 1000 + [(None,), ("no",)] + [(f"k{i}",) for i in range(0, 80, 2)], "k string")
    exact = sorted(r[0] for r in joins.semi_join(big, small, "k").collect())
    for limit in (0, 1 << 20):
        got = bloom.bloom_semi_join(big, small, "k", "k", expected_keys="auto", max_broadcast=limit)
        assert sorted(r[0] for r in got.collect()) == exact
    halves = [small.where(f"xxhash64(k) % 2 {c} 0") for c in ("=", "<>")]
    merged = bloom.merge_filters(*[bloom.build_filter(h, "k", *args) for h in halves])
    whole = bloom.build_filter(small, "k", *args)
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, whole.collect()))
    none = small.limit(0)
    assert bloom.bloom_semi_join(big, none, "k", "k", expected_keys="auto").count() == 0


def test_tfidf_fixture(spark):
    docs = spark.createDataFrame([("d1", "Cat cat dog the"), ("d2", "dog 9x a_b Bird"), ("d3", "the of")],
                                 "filename string, text string")
    out = {(r["word"], r["filename"]): r["tfidf"] for r in tfidf.tfidf(docs, "filename", "text").collect()}
    exp = {("cat", "d1"): 2 / 3 * math.log10(3), ("dog", "d1"): 1 / 3 * math.log10(1.5),
           ("dog", "d2"): 0.5 * math.log10(1.5), ("bird", "d2"): 0.5 * math.log10(3)}
    assert out.keys() == exp.keys()
    for key, v in exp.items():
        assert abs(out[key] - round(v, 8)) < 1e-12
    assert all(v >= 0 for v in out.values())


def test_kept_terms_filter(spark):
    docs = spark.createDataFrame([("d", "I the x1 1x _a a_b Word www")], "doc_id string, text string")
    # "I" is in the stop list but tokens are lower-cased first, so "i" stays
    assert rows(tfidf.kept_terms(docs), "word") == [("i",), ("word",), ("x1",)]


def test_counters(spark):
    from quarry.operators.aggregate import with_counters

    obs_df = with_counters(spark.range(10).where(F.col("id") > 4), "m", kept=F.count(F.lit(1)))
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs_df.observation.get["kept"] == 5


def test_bloom_false_positive_counter(spark):
    big = spark.range(0, 3000).withColumnRenamed("id", "k")
    small = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    out = bloom.bloom_semi_join(big, small, "k", "k", counters=True)
    out.write.format("noop").mode("overwrite").save()
    assert out.observation.get["verified"] == 1000
    assert out.false_positives() >= 0


def test_tfidf_joins_sort_no_postings(spark):
    docs = spark.createDataFrame([(1, "dog cat dog"), (2, "dog"), (1, "cat owl"), (None, "dog"), (3, None)], "doc_id long, text string")
    scored = tfidf.tfidf(docs)
    plan = executed_plan(scored)
    assert plan.count("ShuffledHashJoin") >= 2 and "SortMergeJoin" not in plan
    assert rows(scored, "word", "doc_id", "n", "total_terms", "doc_freq") == [
        ("cat", 1, 2, 5, 1), ("dog", 1, 2, 5, 2), ("dog", 2, 1, 1, 2), ("owl", 1, 1, 5, 1)]


def test_tfidf_postings_stay_in_their_bins(spark):
    """Only one row a word and bin goes by word; ids in several rows, ids that are null and texts without words are as they were."""
    texts = ["Dog cat_x the dog 9x", "owl; CAT, dog\u00e9 cat", "", None, "the of 1a _b", "a1 A1 a_1 zebra I"]
    data = [(f"d{i % 17}" if i % 11 else None, texts[i % len(texts)]) for i in range(120)]
    scored = tfidf.tfidf(spark.createDataFrame(data, "name string, text string"), "name", "text", places=None)
    dealt = set(re.findall(r"hashpartitioning\(([^)]*?), \d+\)", re.sub(r"#\d+L?", "", executed_plan(scored))))
    assert dealt == {"bin", "word"}
    counts = Counter((w, d) for d, t in data if d for w in re.findall(r"[a-z0-9_]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
                     if re.fullmatch("[a-z][a-z0-9]*", w) and w not in tfidf.STOPWORDS)
    totals, dfreq = Counter(), Counter(w for w, _ in counts)
    for (_, d), n in counts.items():
        totals[d] += n
    got = {(r["word"], r["name"]): (r["n"], r["total_terms"], r["doc_freq"], r["tfidf"]) for r in scored.collect()}
    assert got == {(w, d): (n, totals[d], dfreq[w], pytest.approx(n / totals[d] * math.log10(len(data) / dfreq[w]))) for (w, d), n in counts.items()}


def test_packed_tfidf_keeps_one_copy_of_the_documents(spark, tmp_path):
    from pathlib import Path

    from quarry.plans.loads import packed_tfidf
    from quarry.session import checkpoint_root

    scratch = Path(checkpoint_root(spark).removeprefix("file:")) / "quarry-scratch"
    before = set(scratch.glob("doc-*"))
    spark.createDataFrame([(1, "dog cat"), (2, "dog"), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert rows(packed_tfidf(spark, str(tmp_path)), "word", "doc_id", "n") == [("cat", 1, 1), ("dog", 1, 1), ("dog", 2, 1)]
    assert [p.name.rsplit("-", 1)[0] for p in set(scratch.glob("doc-*")) - before] == ["doc-packed"]
