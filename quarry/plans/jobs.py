"""User-level multi-step jobs (M1-M4) as single lazy plans.

Where the reference chained jobs through files with a blocking wait, each
of these is one DataFrame plan; the caller decides where the result goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import coerce_double, reformat_date
from quarry.operators import aggregate, bloom, joins, ordering, text
from quarry.operators.tfidf import tfidf
from quarry.sources import sinks


def stock_analysis(stocks: DataFrame, dividends: DataFrame, per_year: bool = True,
                   dividends_smaller: bool = False) -> DataFrame:
    """M4 (S3 -> P2/P3 -> J1 -> P4/P5 -> A5, or A6 with ``per_year=False``):
    highest high, lowest low and highest dividend per symbol (and year).

    Dividends are reduced to one row per (symbol, date) before the join
    (max of a max), so duplicated dividend rows never multiply stock rows."""
    lhs = stocks.drop("exchange", "stock_price_open", "stock_price_close", "stock_volume",
                      "stock_price_adj_close")
    rhs = (dividends.drop("exchange")
           .withColumnsRenamed({"stock_symbol": "div_symbol", "date": "div_date"})
           .groupBy("div_symbol", "div_date").agg(F.max("dividends").alias("dividends"))
           .withColumnsRenamed({"div_symbol": "stock_symbol", "div_date": "date"}))
    joined = joins.left_join(lhs, rhs, ["stock_symbol", "date"], declared_smaller=dividends_smaller)
    shaped = joined.select("stock_symbol", reformat_date("date").alias("year"),
                           coerce_double("stock_price_high").alias("stock_price_high"),
                           coerce_double("stock_price_low").alias("stock_price_low"),
                           coerce_double("dividends").alias("dividends"))
    keys = ["stock_symbol", "year"] if per_year else ["stock_symbol"]
    return aggregate.extremes(shaped, keys, "stock_price_high", "stock_price_low", "dividends",
                              ("max_high", "min_low", "max_dividend"))


def group_sort(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """M3: word count (StringTokenizer split), swapped to (count, word),
    ascending by count: one plan, two shuffles (aggregate, range sort)."""
    counts = text.word_count(lines, text_col, "tokenizer", per_line=False)
    return ordering.sort_by_count(ordering.swap_count_word(counts))


def tfidf_job(packed_docs: DataFrame, name_col: str = "filename", contents_col: str = "contents") -> DataFrame:
    """M2: tf-idf straight from a packed ``(filename, contents BINARY)`` container."""
    docs = packed_docs.select(F.col(name_col).alias("doc"), F.decode(contents_col, "UTF-8").alias("text"))
    return tfidf(docs, "doc", "text")


def bloom_filter_job(stocks: DataFrame, dividends: DataFrame, symbol: str, out_path: str | None = None,
                     m: int = bloom.REFERENCE_BITS, k: int = bloom.REFERENCE_HASHES) -> DataFrame:
    """M1: closing prices of ``symbol`` on its dividend dates.

    Step 1 builds the Bloom filter over that symbol's dividend keys; step 2
    filters the stock rows with it before any shuffle and verifies exactly
    (semi join).  With ``out_path`` the result is written as tab-separated
    text (a failure raises, which stops the job)."""
    stock_rows = (stocks.where(F.col("stock_symbol") == F.lit(symbol))
                  .select(F.concat_ws(",", "stock_symbol", "date").alias("key"), "stock_price_close"))
    div_keys = (dividends.where(F.col("stock_symbol") == F.lit(symbol))
                .select(F.concat_ws(",", "stock_symbol", "date").alias("key")))
    out = bloom.bloom_semi_join(stock_rows, div_keys, "key", "key", m, k)
    if out_path:
        sinks.write_delimited(out, out_path, sep="\t")
    return out
