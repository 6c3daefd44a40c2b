"""The operators of the inventory run on the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables.  ``ORACLE_SQL`` holds, for most of them, an independent DuckDB
query with the same column names; computed columns are aliased alike in
both, and floating results are rounded alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import composite_key, contains, format_decimals, reformat_date
from quarry.functions.tokenize import head_and_rest
from quarry.functions.udfs import pipe_lines, register_functions
from quarry.operators import aggregate, bloom, joins, ordering, series, text
from quarry.operators.tfidf import STOPWORDS, tfidf
from quarry.plans.tables import table
from quarry.sources.sinks import stage

# Fixed parameters of the registered queries.
GREP_SEARCH = "the"
PRIORITY_NEEDLE = "URGENT"
SEMI_PRIORITY = "1-URGENT"
SEMI_RETURNFLAG = "R"
MOVING_WIDTH = 4
INDEX_BLOCK = 100
EVENT_ORDER = ["ts", "event_id"]


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    """A1 + F1 + S1: words of every line of every document."""
    return text.word_count(table(spark, sf, "documents"), "text", "collapse")


def grep_count(spark, sf):
    """P9 + A2 + F2: count of each word containing the search text."""
    return text.grep_count(table(spark, sf, "documents"), GREP_SEARCH, "text", "escaped")


def grep_lines(spark, sf):
    """P10 + A15 + F3: each line once per matching word, in key order."""
    counted = text.matching_line_counts(table(spark, sf, "documents"), GREP_SEARCH, "text")
    # the total order samples its input in a separate job: checkpoint the
    # matched lines once instead of splitting the text twice
    counted = stage(counted)
    return text.repeat_by_hits(counted.orderBy("sort_key", "line")).select("sort_key", "line")


def avg_by_key(spark, sf):
    """A3: mean account balance per nation key."""
    out = aggregate.mean_by_key(table(spark, sf, "customer"), "c_nationkey", "c_acctbal", "avg_acctbal")
    return out.withColumn("avg_acctbal", F.round("avg_acctbal", 6))


def sum_total_order(spark, sf):
    """A4 + O1: balance total per nation name, output totally ordered."""
    cust = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    joined = joins.map_side_join(cust.select("c_nationkey", "c_acctbal"),
                                 nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
                                 "c_nationkey")
    summed = aggregate.sum_by_key(joined, "n_name", "c_acctbal", "total_acctbal")
    return ordering.total_order(summed.withColumn("total_acctbal", F.round("total_acctbal", 2)), ["n_name"], 5)


def group_sort(spark, sf):
    """M3 (F4 + A1 + P13 + O2): word counts, swapped, sorted by count."""
    counts = text.word_count(table(spark, sf, "documents"), "text", "tokenizer", per_line=False)
    return ordering.sort_by_count(ordering.swap_count_word(counts))


def top50_filtered(spark, sf):
    """P8 (substring filter) + P14 + A14 + O3: top 50 customers by urgent orders."""
    orders = table(spark, sf, "orders").where(contains("o_orderpriority", PRIORITY_NEEDLE))
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    joined = orders.select("o_custkey").join(cust, "o_custkey")
    counts = text.name_count(joined, composite_key("c_name", "c_mktsegment"))
    return ordering.top_k(counts, 50, "count", "name")


def _orders_with_lines(spark, sf, declared_smaller: bool = False):
    """J1 with the dividend side pre-aggregated per order key before the join
    (max of a max), so lineitem ships one row per order instead of one per line.
    ``declared_smaller`` (J2) broadcasts that side when its size is proven."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    per_order = (table(spark, sf, "lineitem")
                 .groupBy(F.col("l_orderkey").alias("o_orderkey"))
                 .agg(F.max("l_extendedprice").alias("dividend")))
    joined = joins.left_join(orders, per_order, "o_orderkey", declared_smaller=declared_smaller)
    return joined.select("o_custkey", reformat_date("o_orderdate", None, "yyyy").alias("year"),
                         "o_totalprice", aggregate.coerce_double("dividend").alias("dividend"))


def left_join_year_extremes(spark, sf):
    """J1 + P4 + P5 + A5: per (customer, year) max/min order price and max line price."""
    return aggregate.extremes(_orders_with_lines(spark, sf), ["o_custkey", "year"], "o_totalprice",
                              "o_totalprice", "dividend", ("max_high", "min_low", "max_dividend"))


def left_join_key_extremes(spark, sf):
    """J2 + A6: the same per customer only."""
    return aggregate.extremes(_orders_with_lines(spark, sf, declared_smaller=True), ["o_custkey"], "o_totalprice",
                              "o_totalprice", "dividend", ("max_high", "min_low", "max_dividend"))


def broadcast_join(spark, sf):
    """Line items with their part's retail price (part held per task when
    its size is proven small, else a shuffle join)."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return joins.map_side_join(li, part, "l_partkey")


def max_by_key(spark, sf):
    """Max price per part and the earliest ship date it occurred on."""
    return aggregate.max_with_date(table(spark, sf, "lineitem"), "l_partkey", "l_extendedprice", "l_shipdate",
                                   ("max_price", "max_date"))


def _events(spark, sf):
    return table(spark, sf, "events").select("user_id", "ts", "event_id", "value")


def value_change(spark, sf):
    """W1 + W5: per user in time order, value changes above 1e-6 (exact fold)."""
    return series.dividend_changes(_events(spark, sf), "user_id", EVENT_ORDER, "value")


def moving_average(spark, sf):
    """Trailing 4-row mean of value per user."""
    out = series.moving_average(_events(spark, sf), "user_id", EVENT_ORDER, "value", MOVING_WIDTH)
    return out.withColumn("moving_avg", F.round("moving_avg", 6))


def best_window(spark, sf):
    """Per user, the 4-row window with the highest mean (first on ties)."""
    return series.best_window(_events(spark, sf), "user_id", EVENT_ORDER, "value", MOVING_WIDTH)


def series_sorted(spark, sf):
    """Value series per user in time order."""
    return series.price_series(_events(spark, sf), "user_id", EVENT_ORDER, "value")


def _semi_sides(spark, sf):
    orders = (table(spark, sf, "orders").where(F.col("o_orderpriority") == F.lit(SEMI_PRIORITY))
              .select("o_orderkey", "o_orderdate", "o_totalprice"))
    lines = (table(spark, sf, "lineitem").where(F.col("l_returnflag") == F.lit(SEMI_RETURNFLAG))
             .select("l_orderkey"))
    return orders, lines


def semi_join_exact(spark, sf):
    """P6 + J4: urgent orders having a returned line, each once."""
    orders, lines = _semi_sides(spark, sf)
    return joins.semi_join(orders, lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


def semi_join_bloom(spark, sf):
    """A13 + J5 + M1: the same through a Bloom pre-filter, verified exact."""
    orders, lines = _semi_sides(spark, sf)
    return bloom.bloom_semi_join(orders, lines, "o_orderkey", "l_orderkey", expected_keys="auto")


def inverted_index(spark, sf):
    """Word -> sorted document ids, in bounded blocks of ids."""
    # doc_id is unique per row, so de-duplicating terms inside each row is the
    # (term, doc) distinct without a shuffle
    terms = F.array_distinct(text.token_array("text", "regex_words", per_line=False))
    docs = table(spark, sf, "documents").select("doc_id", terms.alias("terms"))
    return text.inverted_index(docs, "doc_id", "terms", distinct=False, block_col="doc_id",
                               block_size=INDEX_BLOCK)


def english_word_count(spark, sf):
    """F8: analysed (stemmed) word counts of all documents."""
    from quarry.operators.english import english_word_count as ewc

    return ewc(table(spark, sf, "documents"), "text")


def english_terms_count(spark, sf):
    """F8 before stemming: tokenise, strip possessives, lower-case, drop stop
    words, count (the analysed terms that the stemmer then folds)."""
    from quarry.operators.english import english_terms

    return english_terms(table(spark, sf, "documents"), "text").groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def tfidf_scores(spark, sf):
    """M2 (A8 + A9 + A10, F9, P12): tf-idf of every kept word of every document."""
    return tfidf(table(spark, sf, "documents"), "doc_id", "text")


def report_lines(spark, sf):
    """S20 + F19: the top-50 report printed as fixed-width lines."""
    from quarry.sources.sinks import report_lines as lines

    return lines(top50_filtered(spark, sf), "name", "count")


def tfidf_text(spark, sf):
    """F16: tf-idf as the reference's text (at most 8 decimals, no trailing zeros)."""
    scored = tfidf(table(spark, sf, "documents"), "doc_id", "text", places=None)
    return scored.select("word", "doc_id", format_decimals("tfidf", 8).alias("tfidf_text"))


def python_split_count(spark, sf):
    """U4: words that an external process splits at single spaces (every empty piece kept), counted."""
    lines = text.explode_lines(table(spark, sf, "documents"), "text", line_col="sentence")
    return pipe_lines(lines, "sentence").groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def keep_all_split_count(spark, sf):
    """the same split as a built-in."""
    return text.word_count(table(spark, sf, "documents"), "text", "keep_all")


def stem_function_count(spark, sf):
    """The registered stemmer called from SQL on the words of all documents, counted by stem."""
    register_functions(spark)
    english_terms_count(spark, sf).createOrReplaceTempView("quarry_english_terms")
    return spark.sql("SELECT quarry_stem(word) AS word, sum(count) AS count FROM quarry_english_terms GROUP BY 1")


def mean_by_segment(spark, sf):
    """A3 + F11: mean balance per trimmed market segment (string key)."""
    out = aggregate.mean_by_key(table(spark, sf, "customer"), "c_mktsegment", "c_acctbal", "avg_acctbal")
    return out.withColumn("avg_acctbal", F.round("avg_acctbal", 6))


def semi_join_unmatched(spark, sf):
    """J4's counter (A16) as a query: urgent orders without a returned line."""
    orders, lines = _semi_sides(spark, sf)
    return joins.anti_count(orders, lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


def inverted_index_lines(spark, sf):
    """F7 + A7 on the reference's line shape ``url,term,term,...``: the url
    is text, so blocks are runs of 100 urls in url order (ordered scan)."""
    terms = F.array_distinct(text.token_array("text", "regex_words", per_line=False))
    lines = table(spark, sf, "documents").select(
        F.concat_ws(",", F.col("doc_id").cast("string"), terms).alias("line"))
    url, rest = head_and_rest(F.col("line"))
    parsed = lines.select(url.alias("url"), rest.alias("terms"))
    return text.inverted_index(parsed, "url", "terms", distinct=False, block_size=INDEX_BLOCK)


def first_letter_counts(spark, sf):
    """O5 + F11: customers per first-letter placement index of the trimmed
    segment (``pmod`` keeps the index in range)."""
    from quarry.functions.columns import first_char_partition

    cust = table(spark, sf, "customer")
    return (cust.groupBy(first_char_partition("c_mktsegment", 5, base="A").alias("part"))
            .agg(F.count(F.lit(1)).alias("customers")))


def series_secondary_sort(spark, sf):
    """Rows grouped by user and ordered by time inside each range slice."""
    return ordering.secondary_sort(_events(spark, sf), ["user_id"], EVENT_ORDER)


QUERIES = {
    "word_count": word_count,
    "grep_count": grep_count,
    "grep_lines": grep_lines,
    "avg_by_key": avg_by_key,
    "sum_total_order": sum_total_order,
    "group_sort": group_sort,
    "top50_filtered": top50_filtered,
    "left_join_year_extremes": left_join_year_extremes,
    "left_join_key_extremes": left_join_key_extremes,
    "broadcast_join": broadcast_join,
    "max_by_key": max_by_key,
    "value_change": value_change,
    "moving_average": moving_average,
    "best_window": best_window,
    "series_sorted": series_sorted,
    "semi_join_exact": semi_join_exact,
    "semi_join_bloom": semi_join_bloom,
    "inverted_index": inverted_index,
    "tfidf": tfidf_scores,
    "english_word_count": english_word_count,
    "english_terms_count": english_terms_count,
    "report_lines": report_lines,
    "tfidf_text": tfidf_text,
    "python_split_count": python_split_count,
    "keep_all_split_count": keep_all_split_count,
    "stem_function_count": stem_function_count,
    "mean_by_segment": mean_by_segment,
    "semi_join_unmatched": semi_join_unmatched,
    "inverted_index_lines": inverted_index_lines,
    "first_letter_counts": first_letter_counts,
    "series_secondary_sort": series_secondary_sort,
}


# ----------------------------------------------------------------------------- oracle

_LINES = "SELECT unnest(string_split(text, chr(10))) AS line FROM documents"
_WORDS_SPACE = f"SELECT unnest(string_split(line, ' ')) AS word FROM ({_LINES})"
_STOP = ", ".join(f"'{w}'" for w in STOPWORDS)
_REGEX_WORDS = "list_transform(regexp_extract_all(text, '\\w+'), lambda x: lower(x))"
_SEMI = (f"SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderpriority = '{SEMI_PRIORITY}' "
         f"AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = '{SEMI_RETURNFLAG}')")
_EXTREMES = """
  SELECT o_custkey, strftime(o_orderdate, '%Y') AS year, o_totalprice,
         coalesce(l_extendedprice, 0.0) AS dividend
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"""
_W = "PARTITION BY user_id ORDER BY ts, event_id"

def _en_sql_consts():
    from quarry.operators.english import ENGLISH_STOPWORDS, WORD

    return WORD.replace("'", "''"), ", ".join(f"'{w}'" for w in ENGLISH_STOPWORDS)


_EN_WORD, _EN_STOP = _en_sql_consts()

_TFIDF_SQL = (f"""
      WITH t AS (SELECT doc_id, w AS word FROM (SELECT doc_id, unnest({_REGEX_WORDS}) AS w FROM documents)
                 WHERE regexp_matches(w, '^[a-z][a-z0-9]*$') AND w NOT IN ({_STOP})),
           c AS (SELECT word, doc_id, count(*) AS n FROM t GROUP BY word, doc_id),
           tot AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS total_terms FROM c GROUP BY doc_id),
           df AS (SELECT word, count(*) AS doc_freq FROM c GROUP BY word),
           d AS (SELECT CAST(count(*) AS DOUBLE) AS nd FROM documents),
           s AS (SELECT c.word, c.doc_id, c.n, tot.total_terms, df.doc_freq,
                        (CAST(c.n AS DOUBLE) / CAST(tot.total_terms AS DOUBLE))
                        * log10(d.nd / CAST(df.doc_freq AS DOUBLE)) AS _raw
                 FROM c JOIN tot USING (doc_id) JOIN df USING (word), d)
      SELECT word, doc_id, """ + "{cols}{score} FROM s")

ORACLE_SQL = {
    "word_count": f"SELECT word, count(*) AS count FROM ({_WORDS_SPACE}) WHERE word <> '' GROUP BY word",
    "grep_count": (f"SELECT word, count(*) AS count FROM ({_WORDS_SPACE}) "
                   f"WHERE contains(word, '{GREP_SEARCH}') GROUP BY word"),
    "grep_lines": f"""
      SELECT sort_key, line FROM (
        SELECT line,
               coalesce(string_split(line, ' ')[1], '') || ' ' || coalesce(string_split(line, ' ')[3], '') AS sort_key,
               unnest(list_filter(string_split(line, ' '), lambda w: contains(w, '{GREP_SEARCH}'))) AS hit
        FROM ({_LINES}))""",
    "avg_by_key": ("SELECT c_nationkey, round(avg(c_acctbal), 6) AS avg_acctbal "
                   "FROM customer GROUP BY c_nationkey"),
    "sum_total_order": ("SELECT n_name, round(sum(c_acctbal), 2) AS total_acctbal FROM customer "
                        "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"),
    "group_sort": ("SELECT count(*) AS count, word FROM (SELECT unnest(regexp_split_to_array(text, "
                   "'[ \\t\\n\\r\\f]+')) AS word FROM documents) WHERE word <> '' GROUP BY word"),
    "top50_filtered": f"""
      SELECT c_name || ', ' || c_mktsegment AS name, count(*) AS count
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE contains(o_orderpriority, '{PRIORITY_NEEDLE}')
      GROUP BY 1 ORDER BY count DESC, name ASC LIMIT 50""",
    "left_join_year_extremes": f"""
      SELECT o_custkey, year, max(o_totalprice) AS max_high, min(o_totalprice) AS min_low,
             max(dividend) AS max_dividend FROM ({_EXTREMES}) GROUP BY o_custkey, year""",
    "left_join_key_extremes": f"""
      SELECT o_custkey, max(o_totalprice) AS max_high, min(o_totalprice) AS min_low,
             max(dividend) AS max_dividend FROM ({_EXTREMES}) GROUP BY o_custkey""",
    "broadcast_join": ("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_retailprice "
                       "FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "max_by_key": """
      SELECT l_partkey, max_price, min(l_shipdate) AS max_date FROM (
        SELECT l_partkey, l_extendedprice, l_shipdate,
               max(l_extendedprice) OVER (PARTITION BY l_partkey) AS max_price FROM lineitem)
      WHERE l_extendedprice = max_price GROUP BY l_partkey, max_price""",
    "value_change": f"""
      SELECT user_id, ts, event_id, value, change FROM (
        SELECT user_id, ts, event_id, value,
               value - coalesce(lag(value) OVER ({_W}), 0.0) AS change FROM events)
      WHERE abs(change) > 1e-6""",
    "moving_average": f"""
      SELECT user_id, ts, event_id, value,
             round(avg(value) OVER ({_W} ROWS BETWEEN {MOVING_WIDTH - 1} PRECEDING AND CURRENT ROW), 6)
               AS moving_avg FROM events""",
    "best_window": f"""
      SELECT user_id, ts, event_id, best_avg FROM (
        SELECT user_id, ts, event_id, round(a, 8) AS best_avg,
               row_number() OVER (PARTITION BY user_id ORDER BY round(a, 8) DESC, rn ASC) AS pick
        FROM (SELECT user_id, ts, event_id, avg(value) OVER w AS a, count(*) OVER w AS c,
                     row_number() OVER ({_W}) AS rn
              FROM events WINDOW w AS ({_W} ROWS BETWEEN {MOVING_WIDTH - 1} PRECEDING AND CURRENT ROW))
        WHERE c = {MOVING_WIDTH})
      WHERE pick = 1""",
    "series_sorted": "SELECT user_id, ts, event_id, value FROM events ORDER BY user_id, ts, event_id",
    "semi_join_exact": _SEMI,
    "semi_join_bloom": _SEMI,
    "inverted_index": f"""
      SELECT term, doc_id // {INDEX_BLOCK} AS block,
             string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS urls, count(*) AS n_urls
      FROM (SELECT DISTINCT unnest({_REGEX_WORDS}) AS term, doc_id FROM documents)
      GROUP BY term, block""",
    "tfidf": _TFIDF_SQL.format(score="round(_raw, 8) AS tfidf", cols="n, total_terms, doc_freq, "),
    "tfidf_text": _TFIDF_SQL.format(score="rtrim(rtrim(printf('%.8f', _raw), '0'), '.') AS tfidf_text", cols=""),
    "python_split_count": (f"SELECT word, count(*) AS count FROM ({_WORDS_SPACE}) GROUP BY word"),
    "keep_all_split_count": (f"SELECT word, count(*) AS count FROM ({_WORDS_SPACE}) GROUP BY word"),
    "mean_by_segment": ("SELECT trim(c_mktsegment) AS c_mktsegment, round(avg(c_acctbal), 6) AS avg_acctbal "
                        "FROM customer GROUP BY 1"),
    "semi_join_unmatched": (f"SELECT count(*) AS unmatched FROM orders WHERE o_orderpriority = '{SEMI_PRIORITY}' "
                            f"AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey "
                            f"AND l_returnflag = '{SEMI_RETURNFLAG}')"),
    "inverted_index_lines": f"""
      WITH p AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS url, unnest({_REGEX_WORDS}) AS term FROM documents),
           r AS (SELECT term, url, (row_number() OVER (PARTITION BY term ORDER BY url) - 1) // {INDEX_BLOCK} AS block
                 FROM p)
      SELECT term, block, string_agg(url, ',' ORDER BY url) AS urls, count(*) AS n_urls
      FROM r GROUP BY term, block""",
}

ORACLE_SQL["first_letter_counts"] = ("SELECT CAST(((ascii(trim(c_mktsegment)) - 65) % 5 + 5) % 5 AS INTEGER) AS part, "
                                     "count(*) AS customers FROM customer GROUP BY 1")
ORACLE_SQL["series_secondary_sort"] = ORACLE_SQL["series_sorted"]
ORACLE_SQL["english_terms_count"] = f"""
  SELECT word, count(*) AS count FROM (
    SELECT lower(regexp_replace(raw, '[''’][sS]$', '')) AS word
    FROM (SELECT unnest(regexp_extract_all(text, '{_EN_WORD}')) AS raw FROM documents))
  WHERE word <> '' AND word NOT IN ({_EN_STOP})
  GROUP BY word"""
ORACLE_SQL["report_lines"] = (f"SELECT printf('%-35s%d', name, count) AS line "
                              f"FROM ({ORACLE_SQL['top50_filtered']})")


def _register_streams():
    from quarry.plans.streams import STREAM_ORACLE_SQL, STREAM_QUERIES

    QUERIES.update(STREAM_QUERIES)
    ORACLE_SQL.update(STREAM_ORACLE_SQL)


_register_streams()


def _register_ordered():
    from quarry.plans.ordered import ORDERED_ORACLE_SQL, ORDERED_QUERIES

    QUERIES.update(ORDERED_QUERIES)
    ORACLE_SQL.update(ORDERED_ORACLE_SQL)


_register_ordered()


def _register_loads():
    from quarry.plans.loads import LOAD_ORACLE_SQL, LOAD_QUERIES

    QUERIES.update(LOAD_QUERIES)
    ORACLE_SQL.update(LOAD_ORACLE_SQL)
    ORACLE_SQL["packed_tfidf"] = ORACLE_SQL["tfidf"]


_register_loads()
