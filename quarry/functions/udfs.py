"""User-function surface.

* U1 row -> many rows: column expressions + ``explode`` (``quarry.operators.text.tokens``).
* U2 group -> value with a constructor argument: a Python function of the
  argument returning a DataFrame op (``quarry.operators.series.highest_window_by_group``).
* U3 algebraic aggregates: Spark's own partial aggregation (every ``groupBy`` here).
* U4 external-process function: ``pipe_lines`` runs a command beside every task
  (``SELECT TRANSFORM``), rows in and out as lines.  Where a built-in does the
  same (``split_keep_all``) it is preferred.
* U5 named user functions: ``register_functions`` declares quarry's helpers as
  SQL functions, so they are expressions and need no Python worker.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.stemmer import function_sql

#: A command that puts every word of a line on a line of its own, empty ones included.
SPLIT_COMMAND = 'tr " " "\\n"'


def pipe_lines(df: DataFrame, col: str, command: str = SPLIT_COMMAND, out: str = "word") -> DataFrame:
    """U4: what ``command`` (run by a shell on the executors, once a task)
    writes for the lines of ``col``, one row a line.  Null counts as an empty
    line; values must not hold line breaks."""
    spark, view = df.sparkSession, f"quarry_pipe_{uuid.uuid4().hex}"
    df.select(F.coalesce(F.col(col), F.lit("")).alias("line")).createOrReplaceTempView(view)
    quoted = command.replace("\\", "\\\\").replace("'", "\\'")
    row = "ROW FORMAT DELIMITED FIELDS TERMINATED BY '\\u0001' LINES TERMINATED BY '\\n' NULL DEFINED AS '\\u0002'"
    try:
        return spark.sql(f"SELECT TRANSFORM(line) {row} USING '{quoted}' AS (`{out}` STRING) {row} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


_TRIMMED = "".join(f"{c:02x}" for c in range(33))


def register_functions(spark: SparkSession) -> list[str]:
    """Declare SQL-callable functions; returns their names."""
    spark.sql(function_sql("quarry_stem"))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION quarry_java_trim(s STRING) RETURNS STRING RETURN btrim(s, decode(X'{_TRIMMED}', 'UTF-8'))")
    return ["quarry_stem", "quarry_java_trim"]
