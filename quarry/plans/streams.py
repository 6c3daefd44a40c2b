"""Streaming operators run end to end on the driver tables.

The ``conversations`` table is staged (by Spark) as several Parquet files in
the shared scratch folder and replayed as a file stream, a few files per
micro-batch, with ``trigger(availableNow=True)``.  Each function waits for
the stream to drain and returns a batch DataFrame over what it produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.joins import lookup_sum
from quarry.plans.tables import table
from quarry.session import scratch_path
from quarry.streaming import wordcount as wc

STREAM_FILES = 8          # staged files at least (more with more shuffle partitions)
MICRO_BATCHES = 4         # the replay is cut into this many micro-batches
STREAM_TOKENIZER = "whitespace"


def _staged_conversations(spark: SparkSession, sf: str) -> tuple[str, object, int]:
    """Stage the table as balanced files; returns (path, schema, files per trigger)."""
    src = table(spark, sf, "conversations")
    path = scratch_path(spark, "conversations-stream")
    n = max(STREAM_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src.repartition(n).write.parquet(path)
    return path, src.schema, max(1, n // MICRO_BATCHES)


def _words_stream(spark, sf):
    path, schema, per_trigger = _staged_conversations(spark, sf)
    stream = wc.file_stream(spark, path, schema, "parquet", per_trigger)
    return wc.split_sentences(stream, "text", STREAM_TOKENIZER)


def _running_counts(spark, sf) -> wc.CountsView:
    words = _words_stream(spark, sf)
    ckpt = scratch_path(spark, "wordcount-ckpt")
    wc.start_running_counts(words, ckpt).awaitTermination()
    return wc.CountsView(spark, ckpt, scratch_path(spark, "wordcount-view")).refresh()


def stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """T1 + T3: running word counts after the whole stream, from the published view."""
    return _running_counts(spark, sf).counts()


def stream_state_counts(spark: SparkSession, sf: str) -> DataFrame:
    """T3 read back from the streaming query's own state store."""
    return wc.state_store_counts(spark, _running_counts(spark, sf).checkpoint)


def stream_running_count(spark: SparkSession, sf: str) -> DataFrame:
    """(word, n) for the n-th occurrence of every word."""
    words = _words_stream(spark, sf)
    ckpt = scratch_path(spark, "increments-ckpt")
    out = scratch_path(spark, "increments-out")
    q = wc.start_count_ranges(words, ckpt, out, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(out).select("word", "count")


def state_query(spark: SparkSession, sf: str) -> DataFrame:
    """T4 (J6 + P11 + A12): a stream of requests, one for every turn; the answer is the sum of the running counts of the
    turn's words."""
    view = _running_counts(spark, sf)
    path, schema, per_trigger = _staged_conversations(spark, sf)
    out = scratch_path(spark, "answers")
    q = wc.start_state_queries(wc.file_stream(spark, path, schema, "parquet", per_trigger), view, ["conv_id", "turn"],
                               out, scratch_path(spark, "answers-ckpt"), "text", STREAM_TOKENIZER)
    q.awaitTermination()
    return spark.read.parquet(out).select("conv_id", "turn", "total")


def state_total(spark: SparkSession, sf: str) -> DataFrame:
    """The sum over the running counts of all words of all turns as one request, and of as many words that
    the state does not know (0)."""
    view = _running_counts(spark, sf)
    words = table(spark, sf, "conversations").select(
        F.explode(wc.token_array("text", STREAM_TOKENIZER, per_line=True)).alias("word"))
    unknown = words.select(F.concat("word", F.lit(" ?")).alias("word"))
    one = lambda name, asked: lookup_sum(asked, view.counts(), out="total").select(F.lit(name).alias("request"), "total")
    return one("every turn", words).union(one("unknown words", unknown))


def stream_archive(spark: SparkSession, sf: str) -> DataFrame:
    """The stream appended to rolling JSON-lines files, read back."""
    path, schema, per_trigger = _staged_conversations(spark, sf)
    stream = wc.file_stream(spark, path, schema, "parquet", per_trigger)
    out = scratch_path(spark, "archive")
    q = wc.start_archive(stream, out, scratch_path(spark, "archive-ckpt"), fmt="json",
                         max_records_per_file=1000)
    q.awaitTermination()
    return spark.read.schema(schema).json(out)


STREAM_QUERIES = {
    "stream_word_count": stream_word_count,
    "stream_state_counts": stream_state_counts,
    "stream_running_count": stream_running_count,
    "state_query": state_query,
    "state_total": state_total,
    "stream_archive": stream_archive,
}

_WORDS = ("SELECT unnest(regexp_split_to_array(line, '\\s+')) AS word FROM "
          "(SELECT unnest(string_split(text, chr(10))) AS line FROM conversations)")
_COUNTS = f"SELECT word, count(*) AS count FROM ({_WORDS}) WHERE word <> '' GROUP BY word"

STREAM_ORACLE_SQL = {
    "stream_word_count": _COUNTS,
    "stream_state_counts": _COUNTS,
    "stream_running_count": (f"SELECT word, row_number() OVER (PARTITION BY word) AS count "
                             f"FROM ({_WORDS}) WHERE word <> ''"),
    "state_query": f"""
      WITH c AS ({_COUNTS}),
           r AS (SELECT conv_id, turn, text FROM conversations),
           w AS (SELECT conv_id, turn, unnest(regexp_split_to_array(line, '\\s+')) AS word
                 FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line FROM r))
      SELECT r.conv_id, r.turn, CAST(coalesce(s.total, 0) AS BIGINT) AS total
      FROM r LEFT JOIN (SELECT conv_id, turn, sum(c.count) AS total FROM w JOIN c USING (word)
                        GROUP BY conv_id, turn) s USING (conv_id, turn)""",
    "state_total": f"""
      SELECT 'every turn' AS request, CAST(sum(c.count) AS BIGINT) AS total
      FROM ({_WORDS}) w JOIN ({_COUNTS}) c USING (word)
      UNION ALL SELECT 'unknown words', 0""",
    "stream_archive": "SELECT conv_id, turn, role, text FROM conversations",
}
