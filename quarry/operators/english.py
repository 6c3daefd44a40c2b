"""F8: English word count (tokenise, possessives, lower-case, stop words,
Porter stem), re-aimed as one Spark job.

Tokenising, possessive removal, lower-casing and the stop filter are
built-in expressions, and so is the stemmer (``quarry.functions.stemmer``).
Words are counted first (partial aggregation), so each is stemmed once, and
the counts are summed again per stem.  Parity with the analysis library the
reference calls is not promised (its tokenizer follows full Unicode word
break rules; this one uses letter/digit runs joined by apostrophes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.stemmer import stemmed

# The English stop set of the analysis library.
ENGLISH_STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not",
    "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was",
    "will", "with",
]

WORD = "[\\p{L}\\p{M}\\p{N}_]+(?:['’][\\p{L}\\p{M}\\p{N}_]+)*"


def english_terms(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Analysed terms before stemming, one row per token."""
    # a word never holds a line break, so the whole text is matched at once
    toks = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), 0)
    words = df.select(F.explode(toks).alias("raw"))
    cleaned = F.lower(F.regexp_replace("raw", "['’][sS]$", ""))
    return words.select(cleaned.alias("word")).where(
        (F.col("word") != F.lit("")) & ~F.col("word").isin(ENGLISH_STOPWORDS))


def english_word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(stem, count) over every line of ``text_col``."""
    counts = english_terms(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stemmed(counts, "word", "word").groupBy("word").agg(F.sum("n").alias("count"))
