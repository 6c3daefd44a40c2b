"""Streaming word counts on FIXTURES A11 (one file per batch)."""

import pytest
from pyspark.sql import types as T

from quarry.streaming import wordcount as wc

SCHEMA = T.StructType([T.StructField("sentence", T.StringType())])
BATCHES = [["the cow jumped over the moon", "the man went to the store and bought some candy"],
           ["four score and seven years ago"]]


@pytest.fixture()
def source(spark, tmp_path):
    src = tmp_path / "src"
    for i, batch in enumerate(BATCHES):
        spark.createDataFrame([(s,) for s in batch], SCHEMA).coalesce(1).write.mode("append").parquet(str(src))
    return str(src)


def test_running_counts_and_query(spark, source, tmp_path):
    words = wc.split_sentences(wc.file_stream(spark, source, SCHEMA), "sentence", "java")
    wc.start_running_counts(words, str(tmp_path / "ck")).awaitTermination()
    view = wc.CountsView(spark, str(tmp_path / "ck"), str(tmp_path / "view"), buckets=4).refresh()
    counts = {r["word"]: r["count"] for r in view.counts().collect()}
    assert counts["the"] == 4 and counts["and"] == 2 and counts["cow"] == 1
    state = {r["word"]: r["count"] for r in wc.state_store_counts(spark, str(tmp_path / "ck")).collect()}
    assert state == counts
    reqs = spark.createDataFrame([(1, "cat the dog jumped"), (2, "zzz yyy"), (3, "the the"), (4, None)], "id int, args string")
    out = {r["id"]: r["total"] for r in wc.query_counts(reqs, view.counts(), ["id"], "args").collect()}
    assert out == {1: 5, 2: 0, 3: 8, 4: 0}


def _add(spark, path, sentences):
    spark.createDataFrame([(s,) for s in sentences], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_view_follows_the_change_feed(spark, tmp_path):
    src, ck, root = (str(tmp_path / x) for x in ("src", "ck", "view"))
    want, view = {}, None
    for i in range(5):
        said = [f"the word{i} again", "the"]
        _add(spark, src, said)
        for w in " ".join(said).split():
            want[w] = want.get(w, 0) + 1
        words = wc.split_sentences(wc.file_stream(spark, src, SCHEMA), "sentence", "java")
        wc.start_running_counts(words, ck).awaitTermination()
        view = wc.CountsView(spark, ck, root, buckets=3, compact_after=3)  # as after a restart of the driver
        assert view.upto == i - 1
        view.refresh()
        assert {r["word"]: r["count"] for r in view.counts().collect()} == want
        if view.changes:  # only the words of the batches since, not the vocabulary
            assert {r["word"] for r in spark.read.parquet(view.changes[-1]).collect()} == {"the", "again", f"word{i}"}
        assert len(view.changes) == (i if i < 3 else i - 3)  # folded into a new snapshot after three
        assert view.refresh().upto == i
    some = view.counts([1])
    assert {r["word"] for r in some.collect()} == {r["word"] for r in view.counts().where(view.bucket("word") == 1).collect()}


def test_a_stream_of_requests(spark, source, tmp_path):
    ck, asked, out = (str(tmp_path / x) for x in ("ck", "asked", "out"))
    words = wc.split_sentences(wc.file_stream(spark, source, SCHEMA), "sentence", "java")
    wc.start_running_counts(words, ck).awaitTermination()
    view = wc.CountsView(spark, ck, str(tmp_path / "view"))
    for i, args in enumerate(["cat the dog jumped", "zzz yyy", "the the and"]):
        spark.createDataFrame([(i, args)], "id int, args string").coalesce(1).write.mode("append").parquet(asked)
    requests = wc.file_stream(spark, asked, spark.read.parquet(asked).schema)
    wc.start_state_queries(requests, view, ["id"], out, str(tmp_path / "ck2")).awaitTermination()
    assert {r["id"]: r["total"] for r in spark.read.parquet(out).collect()} == {0: 5, 1: 0, 2: 10}


def test_a_batch_of_one_word_reads_one_state_entry(spark, tmp_path):
    src, ck, out = (str(tmp_path / x) for x in ("src", "ck", "out"))
    _add(spark, src, [" ".join(f"w{i}" for i in range(300))])
    for batch in range(2):
        if batch:
            _add(spark, src, ["w7 w7"])
        words = wc.split_sentences(wc.file_stream(spark, src, SCHEMA), "sentence", "java")
        q = wc.start_count_ranges(words, ck, out)
        q.awaitTermination()
        state = [p["stateOperators"][0] for p in q.recentProgress if p["numInputRows"]][-1]
        read = state["customMetrics"]["rocksdbGetCount"]
        assert (state["numRowsTotal"], state["numRowsUpdated"]) == (300, 1 if batch else 300)
        assert read >= 300 if not batch else read <= 4
    assert sorted(r["count"] for r in spark.read.parquet(out).where("word = 'w7'").collect()) == [1, 2, 3]


def test_archive(spark, source, tmp_path):
    stream = wc.file_stream(spark, source, SCHEMA)
    q = wc.start_archive(stream, str(tmp_path / "arch"), str(tmp_path / "ck3"), fmt="csv", sep="|",
                         max_records_per_file=1)
    q.awaitTermination()
    back = spark.read.schema(SCHEMA).option("sep", "|").csv(str(tmp_path / "arch"))
    assert sorted(r[0] for r in back.collect()) == sorted(s for b in BATCHES for s in b)


def test_stream_equals_batch(spark, source, tmp_path):
    words = wc.split_sentences(wc.file_stream(spark, source, SCHEMA), "sentence", "java")
    wc.start_running_counts(words, str(tmp_path / "ck4")).awaitTermination()
    batch = wc.running_counts(wc.split_sentences(spark.read.schema(SCHEMA).parquet(source), "sentence", "java"))
    assert sorted(map(tuple, batch.collect())) == sorted(map(tuple, wc.state_store_counts(spark, str(tmp_path / "ck4")).collect()))


def test_count_ranges_over_chunks_and_batches(spark, source, tmp_path):
    words = wc.split_sentences(wc.file_stream(spark, source, SCHEMA), "sentence", "java")
    q = wc.start_count_ranges(words, str(tmp_path / "ck5"), str(tmp_path / "ranges"), chunk=2)
    q.awaitTermination()
    got = sorted((r["word"], r["count"]) for r in spark.read.parquet(str(tmp_path / "ranges")).collect())
    assert [c for w, c in got if w == "the"] == [1, 2, 3, 4]   # split over chunks of 2
    assert [c for w, c in got if w == "and"] == [1, 2]         # continues across batches
    assert len(got) == 6 + 10 + 6


def test_count_ranges_run_no_python_call_per_word(spark, tmp_path):
    src, ck, out = (str(tmp_path / x) for x in ("src", "ck", "out"))
    expected = {}
    for batch in range(3):
        sentences = [" ".join(f"w{(i * j) % (40 + batch)}" for i in range(60)) for j in range(1, 9)]
        for w in " ".join(sentences).split(" "):
            expected[w] = expected.get(w, 0) + 1
        spark.createDataFrame([(s,) for s in sentences], SCHEMA).repartition(4).write.mode("append").parquet(src)
    q = wc.start_count_ranges(wc.split_sentences(wc.file_stream(spark, src, SCHEMA, "parquet", 4), "sentence", "java"), ck, out)
    q.awaitTermination()
    assert {o["operatorName"] for p in q.recentProgress for o in p["stateOperators"]} == {"stateStoreSave"}
    got = sorted((r["word"], r["count"]) for r in spark.read.parquet(out).collect())
    assert got == sorted((w, i + 1) for w, n in expected.items() for i in range(n))


def test_partition_counts_are_added_to_one_row_a_word(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(wc, "COMBINE_ROWS", 3)
    batches = [pa.RecordBatch.from_pydict({"word": [f"w{i % 7}", "hot"], "n": [1, 2]}) for i in range(20)]
    got = [r for b in wc._one_row_a_word(iter(batches)) for r in b.to_pylist()]
    assert len(got) == 8 and {r["word"]: r["n"] for r in got}["hot"] == 40 and sum(r["n"] for r in got) == 60
    assert list(wc._one_row_a_word(iter([]))) == []
