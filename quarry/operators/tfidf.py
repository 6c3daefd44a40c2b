"""TF-IDF in one plan: term counts per document, document totals, document
frequency, score ``(n / N) * log10(D / df)``.

Postings stay where their documents lie.  Documents are dealt once, as their
kept terms, into bins by the hash of their id; a bin is counted in Arrow
(``term_counts``, ``with_doc_totals``).  What travels by word is one row for
each word and bin: its document frequency is summed, goes back to the bins by
a join that hashes its side, and meets the postings there.  So a word in a
third of all documents is one row a bin, no posting is shuffled or sorted by
word, and a document whose id is in several rows is one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.tokenize import regex_words

# The reference's stop list, as written there (36 entries,
# "the" twice; "I" never matches because tokens are lower-cased first).
REFERENCE_STOPWORDS = [
    "I", "a", "about", "an", "are", "as", "at", "be", "by", "com", "de", "en", "for", "from", "how", "in",
    "is", "it", "la", "of", "on", "or", "that", "the", "this", "to", "was", "what", "when", "where", "who",
    "will", "with", "and", "the", "www",
]

STOPWORDS = sorted(set(REFERENCE_STOPWORDS))


BINS = 4  # for each shuffle partition: even loads, and little to hold at a time


def kept_words(text, stopwords=STOPWORDS) -> Column:
    """F9 + P12 as one array: ASCII word runs, lower-cased; those starting with a letter, without underscore, not in the stop
    list.  Of the characters of a run, digits and the underscore sort before the letters."""
    return F.filter(regex_words(text), lambda w: (w >= F.lit("a")) & ~w.contains(F.lit("_")) & ~w.isin(list(stopwords)))


def kept_terms(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
               stopwords=STOPWORDS) -> DataFrame:
    """F9 + P12: the kept words of every document -> (word, doc)."""
    return (docs.where(F.col(doc_col).isNotNull())
            .select(F.col(doc_col).alias("doc"), F.explode(kept_words(text_col, stopwords)).alias("word")))


def dealt_terms(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", stopwords=STOPWORDS) -> DataFrame:
    """F9 + P12 as they travel: ``(bin, doc, words)``, one row a document with kept words, which are joined by spaces."""
    bins = BINS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (docs.where(F.col(doc_col).isNotNull())
            .select(F.pmod(F.xxhash64(doc_col), F.lit(bins)).cast("int").alias("bin"), F.col(doc_col).alias("doc"),
                    F.array_join(kept_words(text_col, stopwords), " ").alias("words"))
            .where(F.col("words") != ""))


def term_counts(dealt: pa.Table) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """A8 for the documents of a bin: its words, its documents, and for every word and document with it their places there and n."""
    doc = dealt["doc"].combine_chunks().dictionary_encode()
    words = pc.split_pattern(dealt["words"].combine_chunks(), " ")
    word = pc.list_flatten(words).dictionary_encode()
    d = doc.indices.to_numpy()[pc.list_parent_indices(words).to_numpy()]
    key, n = np.unique(word.indices.to_numpy().astype(np.int64) * len(doc.dictionary) + d, return_counts=True)
    w, d = np.divmod(key, len(doc.dictionary))
    return word.dictionary, doc.dictionary, w, d, n


def with_doc_totals(d: np.ndarray, n: np.ndarray) -> np.ndarray:
    """N = kept terms of the document of each (word, doc)."""
    return np.bincount(d, n).astype(np.int64)[d]


def _bin_words(dealt: pa.Table) -> pa.Table:
    """The words of a bin and how many of its documents hold each."""
    word, _, w, _, _ = term_counts(dealt)
    return pa.table({"bin": pa.repeat(dealt["bin"][0], len(word)), "word": word, "docs": np.bincount(w, minlength=len(word))})


def _bin_postings(dealt: pa.Table, freqs: pa.Table) -> pa.Table:
    """The postings of a bin with the totals of their documents and the frequencies of their words."""
    word, doc, w, d, n = term_counts(dealt)
    freq = freqs["doc_freq"].to_numpy()[pc.index_in(word, value_set=freqs["word"].combine_chunks()).to_numpy()]
    return pa.table({"word": word.take(pa.array(w)), "doc": doc.take(pa.array(d)), "n": n, "total_terms": with_doc_totals(d, n), "doc_freq": freq[w]})


def tfidf(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
          stopwords=STOPWORDS, places: int | None = 8) -> DataFrame:
    """``(word, doc_id, n, total_terms, doc_freq, tfidf)``.

    ``D`` counts every document, including those with no kept term; it is
    a scalar subquery of the same plan.  ``places`` rounds the score
    (the reference printed it with at most 8 decimals; see
    ``quarry.functions.format_decimals`` for that text form)."""
    dealt = dealt_terms(docs, doc_col, text_col, stopwords)
    kind = dealt.schema["doc"].dataType.simpleString()
    seen = dealt.groupBy("bin").applyInArrow(_bin_words, "bin int, word string, docs long").repartition("word")
    # both sides read all columns: they stay the same plan below the shuffle, so it is computed once
    dfreq = seen.groupBy("word").agg(F.sum(F.when(F.col("bin").isNotNull(), F.col("docs"))).alias("doc_freq"))
    freqs = seen.join(dfreq.hint("shuffle_hash"), "word").select("bin", "word", "docs", "doc_freq")
    postings = dealt.groupBy("bin").cogroup(freqs.groupBy("bin")).applyInArrow(
        _bin_postings, f"word string, doc {kind}, n long, total_terms long, doc_freq long")
    n_docs = docs.select(F.count(F.lit(1)).cast("double")).scalar()
    scored = postings.withColumn("tfidf", (F.col("n").cast("double") / F.col("total_terms").cast("double"))
                                 * F.log10(n_docs / F.col("doc_freq").cast("double")))
    if places is not None:
        scored = scored.withColumn("tfidf", F.round("tfidf", places))
    return scored.select("word", F.col("doc").alias(doc_col), "n", "total_terms", "doc_freq", "tfidf")
