"""Source and sink operators run as round trips over the driver tables.

Each function writes a driver table (or part of it) in the shape the
reference reads, into the shared scratch folder, reads it back with the
operator under test and returns the result; the oracle reads the original
table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import aggregate, ordering
from quarry.operators.tfidf import tfidf
from quarry.plans.tables import table
from quarry.session import delete_path, scratch_path
from quarry.sources import readers, sinks
from quarry.sources.keyed import KeyedTable

LINEITEM_CSV_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
])

CUSTOMER_PREFIX_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
])


def csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """S11 + S13 + S3: delimited text with header written, read back typed."""
    path = scratch_path(spark, "lineitem-csv")
    src = table(spark, sf, "lineitem").select(*LINEITEM_CSV_SCHEMA.names)
    sinks.write_delimited(src, path, sep=",", header=True, compression="gzip")
    return readers.read_delimited(spark, path, LINEITEM_CSV_SCHEMA, header=True)


def positional_load(spark: SparkSession, sf: str) -> DataFrame:
    """Headerless delimited rows read with a schema of the leading
    fields; the remaining fields are dropped."""
    path = scratch_path(spark, "customer-text")
    src = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    sinks.write_delimited(src, path, sep=",", header=False)
    return readers.read_positional(spark, path, CUSTOMER_PREFIX_SCHEMA, sep=",")


def key_value_total(spark: SparkSession, sf: str) -> DataFrame:
    """S2 + A4 + O1: key before the first tab, field 3 of the rest summed
    per key, output totally ordered over range partitions."""
    path = scratch_path(spark, "customer-kv")
    src = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_nationkey", "c_name", "c_acctbal")
    sinks.write_delimited(src, path, sep="\t", header=False)
    kv = readers.read_key_value(spark, path, "\t")
    amount = F.element_at(F.split("value", "\t", -1), 4).cast("double")
    summed = aggregate.sum_by_key(kv.select("key", amount.alias("amount")), "key", "amount", "total")
    return ordering.total_order(summed.withColumn("total", F.round("total", 2)), ["key"], 3)


def table_load(spark: SparkSession, sf: str) -> DataFrame:
    """S4 + S17: declare a delimited table, load a file replacing its
    content, scan the table."""
    path = scratch_path(spark, "customer-load")
    src = table(spark, sf, "customer").select(*CUSTOMER_PREFIX_SCHEMA.names)
    sinks.write_delimited(src, path, sep=",", header=False)
    return readers.load_table(spark, path, CUSTOMER_PREFIX_SCHEMA, "quarry_customer_loaded", header=False)


def wide_import(spark: SparkSession, sf: str) -> DataFrame:
    """S16 + A10 shape: rows keyed by order with column families
    ``info(date)`` and ``p(close, vol)``, written sorted by key, read back."""
    src = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("close"), F.col("o_custkey").cast("double").alias("vol"))
    wide = readers.import_wide(src, ["o_orderkey"], {"info": ["date"], "p": ["close", "vol"]},
                               scratch_path(spark, "orders-wide"))
    return wide.select("o_orderkey", "info.date", "p.close", "p.vol")


def _keyed(spark: SparkSession, rows: DataFrame, key: str) -> KeyedTable:
    return KeyedTable(spark, f"quarry_{uuid.uuid4().hex}", [key]).replace(rows)


def _result(df: DataFrame, *tables: KeyedTable) -> DataFrame:
    """The rows as a staged result, so that the tables can go."""
    out = sinks.stage(df, "keyed", reliable=False)
    for t in tables:
        t.drop()
    return out


def aggregate_table_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """S17 + A11: the highest price and its first ship date per part as a keyed table, replaced by that of all lines, then
    upserted with that of the returned lines."""
    lines = table(spark, sf, "lineitem")
    best = lambda rows, run: aggregate.max_with_date(rows, "l_partkey", "l_extendedprice", "l_shipdate", ("max_price", "max_date")).withColumn(
        "run", F.lit(run))
    t = _keyed(spark, best(lines, 1), "l_partkey").upsert(best(lines.where("l_returnflag = 'R'"), 2))
    return _result(t.rows(), t)


def keyed_table_join(spark: SparkSession, sf: str) -> DataFrame:
    """S16 + S17: line totals per part and the parts themselves as two keyed tables, joined as they lie."""
    totals = (table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("partkey")).agg(F.count(F.lit(1)).alias("lines"))
              .select("partkey", "lines"))
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("partkey"), "p_name", "p_retailprice")
    a, b = _keyed(spark, totals, "partkey"), _keyed(spark, readers.wide_rows(parts, ["partkey"], {"info": ["p_name"], "p": ["p_retailprice"]}), "partkey")
    return _result(a.join(b).select("partkey", "lines", "info.p_name", "p.p_retailprice"), a, b)


DOCS_PER_FILE = 100


def packed_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    """S7 + S8 + M2: documents written as many small files (JSON lines of at
    most ``DOCS_PER_FILE`` documents each, so the file count grows with the
    data but never reaches one file per document), packed into a
    ``(filename, contents)`` container, unpacked, then tf-idf."""
    files = scratch_path(spark, "doc-files")
    (table(spark, sf, "documents").select("doc_id", "text")
     .write.option("maxRecordsPerFile", DOCS_PER_FILE).json(files))
    packed = scratch_path(spark, "doc-packed")
    readers.pack_small_files(spark, files, packed)
    delete_path(spark, files)  # all of them are in the container now
    doc_schema = "doc_id BIGINT, text STRING"
    lines = readers.read_packed(spark, packed).where(F.col("filename").endswith(".json")).select(
        F.explode(F.split(F.decode("contents", "UTF-8"), "\n")).alias("line"))
    docs = (lines.where(F.col("line") != F.lit(""))
            .select(F.from_json("line", doc_schema).alias("d")).select("d.doc_id", "d.text"))
    return tfidf(docs, "doc_id", "text")


LOAD_QUERIES = {
    "csv_load": csv_load,
    "positional_load": positional_load,
    "key_value_total": key_value_total,
    "table_load": table_load,
    "wide_import": wide_import,
    "aggregate_table_upsert": aggregate_table_upsert,
    "keyed_table_join": keyed_table_join,
    "packed_tfidf": packed_tfidf,
}

LOAD_ORACLE_SQL = {
    "csv_load": ("SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag "
                 "FROM lineitem"),
    "positional_load": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "key_value_total": ("SELECT c_mktsegment AS key, round(sum(c_acctbal), 2) AS total FROM customer "
                        "GROUP BY c_mktsegment"),
    "table_load": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "wide_import": ("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS close, "
                    "CAST(o_custkey AS DOUBLE) AS vol FROM orders"),
    "aggregate_table_upsert": """
      WITH b AS (
        SELECT l_partkey, l_returnflag = 'R' AS returned, l_extendedprice, l_shipdate FROM lineitem),
      a AS (
        SELECT l_partkey, max(l_extendedprice) AS p, max(l_extendedprice) FILTER (WHERE returned) AS r FROM b GROUP BY l_partkey)
      SELECT a.l_partkey, any_value(coalesce(r, p)) AS max_price, min(l_shipdate) AS max_date, CAST(any_value(CASE WHEN r IS NULL THEN 1 ELSE 2 END) AS INTEGER) AS run
      FROM a JOIN b ON a.l_partkey = b.l_partkey AND l_extendedprice = coalesce(r, p) AND (r IS NULL OR returned) GROUP BY a.l_partkey""",
    "keyed_table_join": """
      SELECT p_partkey AS partkey, count(*) AS lines, p_name, p_retailprice FROM part JOIN lineitem ON l_partkey = p_partkey
      GROUP BY p_partkey, p_name, p_retailprice""",
}
