"""Registered queries whose rows carry their order: changes and means over keys that span slices, with nulls in keys and
values, places in a total order, and placement in partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import first_char_partition
from quarry.operators import ordering, series, text
from quarry.plans.tables import table

ORDER = ["ts", "event_id"]
CHANGE_EPS = 25.0         # most steps of the table's values are below two of it
WIDE = 200
GREP = "the"
LETTERS = 7
PLACES = 9                # means of up to 200 values of two decimals have no rounding ties there


def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    """A handful of keys, one of them null, so that every key holds many slices; a fifth of the values is null."""
    return table(spark, sf, "events").select(
        F.expr("nullif(event_type, 'error')").alias("kind"), "ts", "event_id",
        F.when(F.col("user_id") % 5 != 0, F.col("value")).alias("value"))


def value_change_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Changes above ``CHANGE_EPS`` from the last value put out, per kind in time order; nulls take no part."""
    return series.dividend_changes(_kinds(spark, sf), "kind", ORDER, "value", CHANGE_EPS)


def moving_average_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Trailing mean of 200 rows per kind, nulls skipped."""
    out = series.moving_average(_kinds(spark, sf), "kind", ORDER, "value", WIDE)
    return out.withColumn("moving_avg", F.round("moving_avg", PLACES))


def _word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return text.word_count(table(spark, sf, "documents"), "text", "collapse")


def word_order_positions(spark: SparkSession, sf: str) -> DataFrame:
    """O1: word counts in the total order of their words, with the place of each."""
    return ordering.placed(ordering.total_order(_word_counts(spark, sf), ["word"]))


def count_order_positions(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the same by count, ascending, with the place of each."""
    return ordering.placed(ordering.sort_by_count(_word_counts(spark, sf)))


def grep_lines_positions(spark: SparkSession, sf: str) -> DataFrame:
    """P10 + A15: every line once for each matching word, in the order of its key, with its place."""
    counted = text.matching_line_counts(table(spark, sf, "documents"), GREP, "text")
    return ordering.placed(ordering.ordered_copies(counted, ["sort_key", "line"], "hits"))


def series_positions(spark: SparkSession, sf: str) -> DataFrame:
    """W2 + W5 + O4: events grouped by user and in time order inside, with the place of each."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return ordering.placed(ordering.secondary_sort(events, ["user_id"], ORDER))


def first_letter_placement(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct words of all documents dealt to partitions by first letter: for every index its rows, the partitions
    that hold them and the smallest of those."""
    dealt = ordering.partition_by_first_letter(_word_counts(spark, sf).select("word"), "word", LETTERS, base="A")
    where = dealt.select(first_char_partition("word", LETTERS, base="A").alias("part"), F.spark_partition_id().alias("held"))
    return where.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("held").alias("partitions"),
                                     F.min("held").alias("held"))


_KINDS = ("SELECT nullif(event_type, 'error') AS kind, ts, event_id, CASE WHEN user_id % 5 <> 0 THEN value END AS value "
          "FROM events")

_COUNTS = "SELECT word, count(*) AS count FROM (SELECT unnest(string_split(line, ' ')) AS word FROM ({lines})) WHERE word <> '' GROUP BY word"
_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"

ORDERED_QUERIES = {
    "value_change_nulls": value_change_nulls, "moving_average_wide": moving_average_wide,
    "word_order_positions": word_order_positions, "count_order_positions": count_order_positions,
    "grep_lines_positions": grep_lines_positions, "series_positions": series_positions,
    "first_letter_placement": first_letter_placement,
}

ORDERED_ORACLE_SQL = {
    "value_change_nulls": f"""
      WITH RECURSIVE e AS (
        SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ts, event_id) AS rn FROM ({_KINDS}) WHERE value IS NOT NULL),
      f AS (
        SELECT kind, ts, event_id, value, rn, value AS change, abs(value) > {CHANGE_EPS} AS moved,
               CASE WHEN abs(value) > {CHANGE_EPS} THEN value ELSE 0.0 END AS last FROM e WHERE rn = 1
        UNION ALL
        SELECT e.kind, e.ts, e.event_id, e.value, e.rn, e.value - f.last, abs(e.value - f.last) > {CHANGE_EPS},
               CASE WHEN abs(e.value - f.last) > {CHANGE_EPS} THEN e.value ELSE f.last END
        FROM f JOIN e ON e.kind IS NOT DISTINCT FROM f.kind AND e.rn = f.rn + 1)
      SELECT kind, ts, event_id, value, change FROM f WHERE moved""",
    "moving_average_wide": f"""
      SELECT kind, ts, event_id, value,
             round(avg(value) OVER (PARTITION BY kind ORDER BY ts, event_id ROWS BETWEEN {WIDE - 1} PRECEDING AND CURRENT ROW), {PLACES})
               AS moving_avg FROM ({_KINDS})""",
    "word_order_positions": f"""
      SELECT row_number() OVER (ORDER BY word) AS position, word, count FROM ({_COUNTS.format(lines=_LINES)})""",
    "count_order_positions": f"""
      SELECT row_number() OVER (ORDER BY count, word) AS position, word, count FROM ({_COUNTS.format(lines=_LINES)})""",
    "grep_lines_positions": f"""
      SELECT row_number() OVER (ORDER BY sort_key, line) AS position, sort_key, line FROM (
        SELECT line, coalesce(string_split(line, ' ')[1], '') || ' ' || coalesce(string_split(line, ' ')[3], '') AS sort_key,
               unnest(list_filter(string_split(line, ' '), lambda w: contains(w, '{GREP}'))) AS hit FROM ({_LINES}))""",
    "series_positions": """
      SELECT row_number() OVER (ORDER BY user_id, ts, event_id) AS position, user_id, ts, event_id, value FROM events""",
    "first_letter_placement": f"""
      SELECT CAST(((ascii(trim(word)) - 65) % {LETTERS} + {LETTERS}) % {LETTERS} AS INTEGER) AS part, count(*) AS rows,
             1::BIGINT AS partitions, part AS held FROM ({_COUNTS.format(lines=_LINES)}) GROUP BY 1""",
}
