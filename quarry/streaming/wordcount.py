"""Structured Streaming word counts and queries over their running state.

* T1 ``split_sentences``: stateless split of each sentence into words.
* T3 ``start_running_counts``: ``groupBy(word).count()`` kept in a RocksDB state
  store across micro-batches (checkpointed, so a restart resumes).
* T2 ``start_count_ranges``: ``(word, running count)`` for *every* input
  word: occurrences are combined in each task, a streaming aggregation keeps
  one counter a word and gives each its new range of numbers, and ranges
  are expanded in bounded chunks spread over tasks.
* T4 ``CountsView``, ``start_state_queries``: the running counts published as a
  compacted snapshot and the state store's change feed since, and a stream
  of requests answered from it (J6 + P11 + A12).
* T5 / S19 ``start_archive``: append the stream to rolling files.

Sources are file streams here (``file_stream``); the message-log source is
``quarry.sources.readers.read_message_stream``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.text import token_array
from quarry.session import core_count

# State on disk with incremental checkpoints: executors hold a cache of it, not the whole vocabulary, and a batch
# writes (and the change feed gives) only what it changed.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's own setting is put back."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 second")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int = 1) -> DataFrame:
    """A replayable file source: each trigger takes ``files_per_trigger`` new files."""
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", files_per_trigger).load(path))


def split_sentences(stream: DataFrame, col: str = "sentence", tokenizer="java", per_line: bool = True,
                    keep=()) -> DataFrame:
    """One row per word of each sentence."""
    return stream.select(*keep, F.explode(token_array(col, tokenizer, per_line)).alias("word"))


def running_counts(words: DataFrame) -> DataFrame:
    """Persistent per-word count (a streaming aggregation)."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def start_running_counts(words: DataFrame, checkpoint: str, available_now: bool = True, query_name: str | None = None):
    """Run T3: the counts live in the query's state store (see ``state_store_counts`` and ``CountsView``).
    Returns the ``StreamingQuery``."""
    w = running_counts(words).writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    with rocksdb_state(words.sparkSession):
        return _triggered(w, available_now).start()


def state_store_counts(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The running counts read straight from the query's state store, as of a batch (the latest)."""
    reader = spark.read.format("statestore")
    st = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
    return st.select(F.col("key.word").alias("word"), F.col("value.count").alias("count"))


RANGE_CHUNK = 100_000
COMBINE_ROWS = 1_000_000


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of every Arrow batch: a word holding a third of the rows leaves a task as a few rows."""
    for batch in batches:
        counts = pc.value_counts(batch.column(0))
        yield pa.RecordBatch.from_arrays([counts.field("values"), counts.field("counts")], ["word", "n"])


def _one_row_a_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One (word, n) for each word of a partition; added up whenever twice the words known, or ``COMBINE_ROWS`` rows, wait."""
    waiting, rows, known = [], 0, 0
    added = lambda: (pa.Table.from_batches(waiting).group_by("word").aggregate([("n", "sum")])
                     .rename_columns({"word": "word", "n_sum": "n"}))
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= max(COMBINE_ROWS, 2 * known):
            waiting = added().to_batches()
            rows = known = sum(b.num_rows for b in waiting)
    if rows:
        yield from added().to_batches()


def count_ranges(words: DataFrame) -> DataFrame:
    """T2 as ranges: for every word of a micro-batch the counts ``lo + 1 .. hi`` of its new occurrences.  A batch reads and
    writes the state of the words that it holds, whatever the vocabulary.

    A streaming aggregation (update mode) whose state is, for a word, the sum of its occurrences and what its latest batch brought.
    A batch brings each word as one row, marked with the batch's time, so the greatest mark's row is that batch's whole
    count.  Should the clock ever step back between batches, the query fails rather than number wrongly."""
    now = F.current_timestamp()  # of the micro-batch, kept in its offset log
    brought = (words.select("word").mapInArrow(_combined, "word string, n long").repartition("word")
               .mapInArrow(_one_row_a_word, "word string, n long").withColumn("at", now))
    state = brought.groupBy("word").agg(F.sum("n").alias("hi"), F.max(F.struct("at", "n")).alias("last"))
    n = F.when(F.col("last.at") == now, F.col("last.n")).otherwise(
        F.raise_error(F.lit("the clock stepped back between two micro-batches")).cast("long"))
    return state.select("word", (F.col("hi") - n).alias("lo"), "hi")


def start_count_ranges(words: DataFrame, checkpoint: str, out_path: str, chunk: int = RANGE_CHUNK,
                       available_now: bool = True):
    """``(word, n)`` for the n-th occurrence of every word, to ``out_path/batch_id=N`` (Parquet; overwritten if
    the batch is tried again, so exactly once).

    Every range is cut into chunks of at most ``chunk`` numbers that are
    spread over tasks before they are expanded.  Row order inside a batch is
    not kept (the multiset of ``(word, n)`` is)."""
    last = F.floor((F.col("hi") - F.col("lo") - 1) / F.lit(chunk)).cast("long")
    start = F.col("lo") + F.col("c") * F.lit(chunk) + F.lit(1)
    end = F.least(F.col("hi"), F.col("lo") + (F.col("c") + F.lit(1)) * F.lit(chunk))

    def expand(ranges: DataFrame, batch_id: int) -> None:
        pieces = ranges.select("word", "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("c"))
        out = (pieces.repartition(max(1, core_count(ranges.sparkSession)))
               .select("word", F.explode(F.sequence(start, end)).alias("count")))
        out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = count_ranges(words).writeStream.outputMode("update").foreachBatch(expand).option("checkpointLocation", checkpoint)
    with rocksdb_state(words.sparkSession):
        return _triggered(w, available_now).start()


class CountsView:
    """The running counts of a T3 query as a table that requests read: a compacted snapshot in buckets by word, and the
    changes since.

    ``refresh`` asks the state store for the changes of the batches committed since the last time (its change feed) and
    writes those alone; after ``compact_after`` such pieces they are folded into a new snapshot.  The first refresh, and one
    that comes after the store has dropped the feed of a batch it needs, takes the state as a whole.  ``root`` has a manifest of one row a
    refresh, so a restarted driver goes on where it was.  Files of the last snapshot but one are left for running readers and deleted
    by whoever owns ``root``."""

    _MANIFEST = "seq long, upto long, snapshot string, changes array<string>"

    def __init__(self, spark: SparkSession, checkpoint: str, root: str, buckets: int = 64, compact_after: int = 8):
        self.spark, self.checkpoint, self.root = spark, checkpoint, root.rstrip("/")
        self.buckets, self.compact_after = buckets, compact_after
        self.seq, self.upto, self.snapshot, self.changes = 0, -1, None, []
        try:
            rows = spark.read.schema(self._MANIFEST).parquet(f"{self.root}/manifest")
        except Exception as error:  # no manifest yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
        else:
            last = rows.orderBy(F.col("seq").desc()).first()
            if last:
                self.seq, self.upto, self.snapshot, self.changes = last.seq, last.upto, last.snapshot, list(last.changes)

    def bucket(self, word: Column | str) -> Column:
        return F.pmod(F.xxhash64(word), F.lit(self.buckets)).cast("int")

    def _write(self, counts: DataFrame, kind: str) -> str:
        path = f"{self.root}/{kind}-{uuid.uuid4().hex}"
        (counts.withColumn("bucket", self.bucket("word")).repartition("bucket").write.partitionBy("bucket").parquet(path))
        return path

    def _feed(self, start: int, end: int) -> DataFrame:
        feed = (self.spark.read.format("statestore").option("readChangeFeed", True).option("changeStartBatchId", start)
                .option("changeEndBatchId", end).load(self.checkpoint))
        return feed.groupBy(F.col("key.word").alias("word")).agg(F.max("value.count").alias("count"))  # counts only grow

    def refresh(self) -> CountsView:
        """Take in what the counting query has committed since the last refresh."""
        known = self.spark.read.format("state-metadata").load(self.checkpoint).agg(F.min("minBatchId"), F.max("maxBatchId")).first()
        first, latest = known
        if latest is None or latest <= self.upto:
            return self
        if self.snapshot is None or first > self.upto + 1:
            self.snapshot, self.changes = self._write(state_store_counts(self.spark, self.checkpoint, latest), "snapshot"), []
        else:
            self.changes.append(self._write(self._feed(self.upto + 1, latest), "changes"))
            if len(self.changes) >= self.compact_after:
                self.snapshot, self.changes = self._write(self.counts(), "snapshot"), []
        self.upto, self.seq = latest, self.seq + 1
        row = [(self.seq, self.upto, self.snapshot, self.changes)]
        self.spark.createDataFrame(row, self._MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return self

    def counts(self, buckets: list[int] | None = None) -> DataFrame:
        """(word, count), of these buckets only if given (other files are not read)."""
        if self.snapshot is None:
            return self.spark.createDataFrame([], "word string, count long")
        out = None
        for path in [self.snapshot, *self.changes]:
            part = self.spark.read.schema("word string, count long, bucket int").parquet(path)
            part = part if buckets is None else part.where(F.col("bucket").isin(buckets))
            out = part if out is None else out.union(part)
        out = out.select("word", "count")
        return out.groupBy("word").agg(F.max("count").alias("count")) if self.changes else out


def start_state_queries(requests: DataFrame, view: CountsView, id_cols: list[str], out_path: str, checkpoint: str,
                        text_col: str = "args", tokenizer="java", available_now: bool = True):
    """T4: answer a *stream* of requests from the running counts as of the latest batch that the counting query has
    committed when a micro-batch of requests comes in.  Answers (``id_cols``, ``total``) go to
    ``out_path/batch_id=N``, overwritten if the batch is tried again.  Only the buckets that hold a requested word
    are read (at most ``view.buckets`` numbers come to the driver)."""

    def answer(batch: DataFrame, batch_id: int) -> None:
        view.refresh()
        words = batch.select(F.explode(token_array(text_col, tokenizer)).alias("word"))
        needed = [r[0] for r in words.select(view.bucket("word").alias("b")).distinct().collect()]
        found = query_counts(batch, view.counts(needed), id_cols, text_col, tokenizer)
        found.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = requests.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    return _triggered(w, available_now).start()


def query_counts(requests: DataFrame, counts: DataFrame, id_cols: list[str], text_col: str = "args",
                 tokenizer="java") -> DataFrame:
    """Per request, the sum of the running counts of its
    words; words not counted are dropped; 0 when none is found.  A word that a
    request repeats is looked up once and counted as often as it stands there."""
    words = (requests.select(*id_cols, F.explode(token_array(text_col, tokenizer)).alias("word"))
             .groupBy(*id_cols, "word").agg(F.count(F.lit(1)).alias("times")))
    found = words.join(counts.select("word", "count"), "word", "inner").dropna(subset=["count"])
    sums = found.groupBy(*id_cols).agg(F.sum(F.col("times") * F.col("count")).alias("total"))
    return (requests.select(*id_cols).join(sums, id_cols, "left")
            .select(*id_cols, F.coalesce("total", F.lit(0)).cast("long").alias("total")))


def start_archive(stream: DataFrame, out_path: str, checkpoint: str, fmt: str = "csv", sep: str = "|",
                  max_records_per_file: int | None = 1000, available_now: bool = True):
    """Append every row to files; a new file per trigger and per
    ``max_records_per_file`` rows (rolling by count, not bytes)."""
    w = (stream.writeStream.outputMode("append").format(fmt).option("path", out_path)
         .option("checkpointLocation", checkpoint))
    if fmt == "csv":
        w = w.option("sep", sep)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
