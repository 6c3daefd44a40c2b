"""Readers: text lines, key/value text, typed delimited files, packed small
files, wide-column import, tables, message streams.

Every delimited reader takes an explicit schema (no inference pass over the
data).  Bad numbers fail the query (``FAILFAST``) as the reference's parsers
do, unless ``permissive=True`` (then they become null).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

# Column layouts of the reference's comma-separated inputs
# (field order as declared by its table definitions).
STOCK_SCHEMA = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("stock_symbol", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("stock_price_open", T.DoubleType()),
    T.StructField("stock_price_high", T.DoubleType()),
    T.StructField("stock_price_low", T.DoubleType()),
    T.StructField("stock_price_close", T.DoubleType()),
    T.StructField("stock_volume", T.IntegerType()),
    T.StructField("stock_price_adj_close", T.DoubleType()),
])

DIVIDEND_SCHEMA = T.StructType([
    T.StructField("exchange", T.StringType()),
    T.StructField("stock_symbol", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("dividends", T.DoubleType()),
])


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line (the byte offset key is not kept)."""
    return spark.read.text(path)


def read_key_value(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """``key`` = text before the first ``sep``, ``value`` = the rest (the
    whole line and ``''`` when there is no separator)."""
    line = F.col("value")
    has_sep = F.instr(line, sep) > 0
    return spark.read.text(path).select(
        F.when(has_sep, F.substring_index(line, sep, 1)).otherwise(line).alias("key"),
        F.when(has_sep, F.regexp_extract(line, f"^.*?{re.escape(sep)}([\\s\\S]*)$", 1))
        .otherwise(F.lit("")).alias("value"))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
                   sep: str = ",", escape: str = "\\", permissive: bool = False) -> DataFrame:
    """Typed delimited file.  ``header=True`` skips the first line
    of each file (P7)."""
    return (spark.read.schema(schema)
            .option("header", header).option("sep", sep).option("escape", escape)
            .option("mode", "PERMISSIVE" if permissive else "FAILFAST")
            .csv(path))


def read_positional(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                    permissive: bool = False) -> DataFrame:
    """Load with a positional typed schema of the first ``len(schema)``
    fields; fields beyond it are dropped, missing ones are null."""
    parts = F.split(F.col("value"), re.escape(sep), -1)  # split takes a pattern; the separator is plain text
    cols = []
    for i, f in enumerate(schema.fields):
        raw = F.try_element_at(parts, F.lit(i + 1))
        if isinstance(f.dataType, T.StringType):
            cols.append(raw.alias(f.name))
        else:
            cols.append((raw.try_cast(f.dataType) if permissive else raw.cast(f.dataType)).alias(f.name))
    return spark.read.text(path).select(*cols)


def skip_header(df: DataFrame, col: str, header_value: str) -> DataFrame:
    """P7 for text already read: drop rows whose ``col`` equals the header word."""
    return df.where(F.col(col).isNull() | (F.col(col) != F.lit(header_value)))


def load_table(spark: SparkSession, path: str, schema: T.StructType, table: str, header: bool = False,
               sep: str = ",", location: str | None = None) -> DataFrame:
    """Declare a delimited table and load a file into it, replacing its
    content.  ``location`` defaults to a folder under the checkpoint root."""
    df = read_delimited(spark, path, schema, header=header, sep=sep, permissive=True)
    loc = location or scratch_path(spark, f"table-{table}")
    df.write.mode("overwrite").option("path", loc).saveAsTable(table)
    return spark.table(table)


def pack_small_files(spark: SparkSession, src_dir: str, out_path: str, recursive: bool = False,
                     compression: str = "zstd", num_files: int | None = None) -> int:
    """Pack the files of ``src_dir`` into a container of
    ``(filename, contents)`` rows; returns the record count.

    Each file is read by one task; the container is Parquet (the Avro data
    source is an extra package)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
             .load(src_dir)
             .select(F.regexp_extract("path", "([^/]*)$", 1).alias("filename"),
                     F.col("path").alias("source_path"), F.col("content").alias("contents")))
    if num_files:
        files = files.repartition(num_files)  # a shuffle keeps the file reads parallel
    files.write.mode("overwrite").option("compression", compression).parquet(out_path)
    return spark.read.parquet(out_path).count()


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """The packed documents; the document count is ``count()``."""
    return spark.read.parquet(path)


def wide_rows(df: DataFrame, key_cols: list[str], families: dict[str, list[str]]) -> DataFrame:
    """Rows with one ``STRUCT`` column per column family."""
    return df.select(*key_cols, *[F.struct(*cols).alias(fam) for fam, cols in families.items()])


def import_wide(df: DataFrame, key_cols: list[str], families: dict[str, list[str]], out_path: str,
                num_partitions: int | None = None) -> DataFrame:
    """S16 / S17 sink: write the wide rows sorted by row key (range
    partitioned, so files hold disjoint key ranges) and read them back."""
    wide = wide_rows(df, key_cols, families)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (wide.repartitionByRange(n, *key_cols).sortWithinPartitions(*key_cols)
     .write.mode("overwrite").parquet(out_path))
    return df.sparkSession.read.parquet(out_path)


def read_message_stream(spark: SparkSession, servers: str, topic: str, from_start: bool = True) -> DataFrame:
    """Message-log stream from the beginning, value as ``str``.

    Needs the Kafka connector on the classpath; absent here, so tests use a
    file stream (``quarry.streaming.file_stream``)."""
    try:
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
               .option("subscribe", topic).option("startingOffsets", "earliest" if from_start else "latest")
               .load())
    except Exception as exc:  # connector missing
        raise RuntimeError("the Kafka source is not on the classpath") from exc
    return raw.select(F.col("value").cast("string").alias("str"))
