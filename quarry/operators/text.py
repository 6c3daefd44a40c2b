"""Text operators: word counts, grep, matching lines, inverted index, English
word count.

Every count is a ``groupBy().agg(count)``: Spark plans a partial
``HashAggregate`` before the shuffle (the reference's combiner), so a word
that holds a third of all tokens is reduced map-side and ships one row per
task, not one row per occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import as_col, contains
from quarry.functions.tokenize import get_tokenizer, java_split, split_lines


def explode_lines(df: DataFrame, text_col: str = "text", keep=(), line_col: str = "line") -> DataFrame:
    """S1 shape: one row per line of ``text_col`` (the byte offset is dropped)."""
    return df.select(*keep, F.explode(split_lines(text_col)).alias(line_col))


def token_array(text, tokenizer="collapse", per_line: bool = True) -> Column:
    """All tokens of a text column as one array; lines are split first so no
    token spans a line break (the reference's record is one line).

    Tokenizers that drop empty pieces and never keep a line break inside a
    token give the same tokens on the whole text, so for them the per-line
    split is skipped (one split, no per-line lambda): ``collapse`` on a space
    becomes one split on space and line breaks."""
    if per_line and tokenizer == "collapse":
        return F.array_remove(F.split(as_col(text), "[ \\r\\n]+", -1), "")
    if per_line and tokenizer in ("tokenizer", "whitespace", "regex_words"):
        per_line = False
    tok = get_tokenizer(tokenizer)
    if per_line:
        return F.flatten(F.transform(split_lines(as_col(text)), lambda line: tok(line)))
    return tok(as_col(text))


def tokens(df: DataFrame, text_col: str = "text", tokenizer="collapse", per_line: bool = True,
           keep=(), word_col: str = "word") -> DataFrame:
    """Row -> many rows: one row per token."""
    return df.select(*keep, F.explode(token_array(text_col, tokenizer, per_line)).alias(word_col))


def word_count(df: DataFrame, text_col: str = "text", tokenizer="collapse",
               per_line: bool = True) -> DataFrame:
    """A1: ``(word, count)`` over all tokens of ``text_col``."""
    return (tokens(df, text_col, tokenizer, per_line)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def grep_count(df: DataFrame, search: str, text_col: str = "text",
               tokenizer="escaped") -> DataFrame:
    """P9 + A2: count each word that contains ``search``.

    The filter runs before the aggregation, and the aggregation is partial,
    exactly the mapper/combiner/reducer split of the reference.
    """
    # a word can only contain ``search`` if its document does
    return (tokens(df.where(F.col(text_col).contains(F.lit(search))), text_col, tokenizer)
            .where(contains("word", search))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def matching_line_counts(df: DataFrame, search: str, text_col: str = "text", keep=(),
                         strict: bool = False) -> DataFrame:
    """P10, one row per matching line: ``(sort_key, line, hits)``.

    ``hits`` is the number of words of ``java_split(line, ' ')`` that contain
    ``search`` and ``sort_key = word0 + ' ' + word2``.  A word can only
    contain ``search`` if its line (and document) does, so both are
    filtered with a plain substring test before any splitting.  The
    reference fails on a matching line with fewer than three words;
    ``strict=True`` keeps that (ANSI index error), the default uses an empty
    string for the missing words.
    """
    needle = F.lit(search)
    docs = df.where(F.col(text_col).contains(needle))
    lines = explode_lines(docs, text_col, keep=keep).where(F.col("line").contains(needle))
    staged = lines.select(*keep, "line", java_split(F.col("line"), " ").alias("_w"))
    words = F.col("_w")
    pick = (lambda i: F.element_at(words, i)) if strict else (
        lambda i: F.coalesce(F.try_element_at(words, F.lit(i)), F.lit("")))
    if search == "":
        hits = F.size(words)  # every word contains the empty string
    elif " " in search:
        hits = F.lit(0)  # no word contains a space
    else:
        hits = F.size(F.filter(words, lambda w: w.contains(needle)))
    return (staged.select(*keep, "line", F.concat(pick(1), F.lit(" "), pick(3)).alias("sort_key"),
                          hits.alias("hits"))
            .where(F.col("hits") > 0))


def repeat_by_hits(counted: DataFrame, hits: str = "hits") -> DataFrame:
    """One row per hit (order within a partition is kept)."""
    return (counted.withColumn("_rep", F.explode(F.sequence(F.lit(1), F.col(hits))))
            .drop("_rep", hits))


def matching_lines(df: DataFrame, search: str, text_col: str = "text", keep=(),
                   strict: bool = False) -> DataFrame:
    """P10: one output row per word of a line that contains ``search``,
    carrying the line and its ``sort_key``."""
    return repeat_by_hits(matching_line_counts(df, search, text_col, keep, strict))


def lines_ordered_by_key(matched: DataFrame, key: str = "sort_key", value: str = "line",
                         materialize: bool = False) -> DataFrame:
    """Group by key, pass every row, drop the key: a total order by key.

    ``orderBy`` range-partitions on sampled cut points, so a hot key does not
    land in a single task the way a hash group would.  Given
    ``matching_line_counts`` output, lines are sorted once and repeated
    after the sort.  ``materialize`` checkpoints the input first, so the
    sampling job does not recompute the text splitting.
    """
    if materialize:
        from quarry.sources.sinks import stage

        matched = stage(matched)
    ordered = matched.orderBy(key, value)
    if "hits" in matched.columns:
        ordered = repeat_by_hits(ordered)
    return ordered.select(value)


def _term_lists(parts: list[pa.RecordBatch], block: int | None) -> pa.RecordBatch:
    """``(block, term, r)`` of the rows (rank, terms) of one block: each term with its ranks, ascending."""
    held = pa.concat_batches(parts)
    terms, rank = held.column("terms"), held.column("rank")
    coded = pc.list_flatten(terms).dictionary_encode(null_encoding="encode")
    code, at = coded.indices.to_numpy(zero_copy_only=False), pc.list_parent_indices(terms)
    has = rank.is_valid().take(at).to_numpy(zero_copy_only=False)
    code, r = code[has], rank.fill_null(0).take(at).to_numpy(zero_copy_only=False)[has]
    ends = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))]).astype(np.int32)
    found = pa.ListArray.from_arrays(pa.array(ends), pa.array(r[np.lexsort((r, code))], pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([block] * len(found), pa.int64()), coded.dictionary, found], ["block", "term", "r"])


def _block_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The term lists of rows sorted by block; one block is held at a time."""
    held, now = [], None
    for batch in batches:
        runs, start = pc.run_end_encode(batch.column("block")), 0
        for end, block in zip(runs.run_ends.to_pylist(), runs.values.to_pylist(), strict=True):
            if held and block != now:
                yield _term_lists(held, now)
                held = []
            held.append(batch.slice(start, end - start))
            now, start = block, end
    if held:
        yield _term_lists(held, now)


def posting_blocks(docs: DataFrame, rank_col: str, terms_col: str, block_size: int = 1024) -> DataFrame:
    """A7 as it is stored: ``(term, block, first, last, n, offsets)``, one row
    for a term and ``block_size`` consecutive ranks.

    ``rank_col`` is a unique, non-negative integer for each row, ``terms_col`` its ``ARRAY<STRING>`` of distinct terms.  A block is
    ``rank div block_size``; its header tells which ranks it spans, and the
    postings are offsets from the first of them.  Whole rows are
    shuffled by block, once; terms are collected where the block
    lies, a block at a time in Arrow, so no posting is shuffled on its own and a term found in every row
    has at most ``block_size`` postings in a block."""
    rank = F.col(rank_col).cast("long")
    rows = docs.select(F.floor(rank / F.lit(block_size)).cast("long").alias("block"), rank.alias("rank"),
                       F.col(terms_col).alias("terms")).repartition("block").sortWithinPartitions("block")
    lists = rows.mapInArrow(_block_lists, "block long, term string, r array<long>")
    first = F.element_at("r", 1)
    return lists.select("term", "block", first.alias("first"), F.element_at("r", -1).alias("last"), F.size("r").cast("long").alias("n"),
                        F.transform("r", lambda x: (x - F.element_at("r", 1)).cast("int")).alias("offsets"))


def decode_postings(index: DataFrame) -> DataFrame:
    """``(term, block, n, ranks)`` of posting blocks, ranks ascending."""
    return index.select("term", "block", "n", F.transform("offsets", lambda x: x + F.col("first")).alias("ranks"))


def rank_urls(docs: DataFrame, url_col: str, unique: bool = True) -> DataFrame:
    """``(url, rank)``: place of every url in their order, from 0, by the
    skew-safe ordered scan over the urls alone."""
    from quarry.plans.scan import row_index

    urls = docs.select(F.col(url_col).alias("url"))
    ranked = row_index(urls if unique else urls.distinct(), [], ["url"], "rank")
    return ranked.select("url", (F.col("rank") - 1).alias("rank"))


def inverted_index(df: DataFrame, url_col: str, terms_col: str, distinct: bool = False,
                   block_col: str | None = None, block_size: int = 1000) -> DataFrame:
    """Term -> comma-joined, sorted urls.

    ``terms_col`` is an ``ARRAY<STRING>`` of terms for the row's url.  The
    reference emits one line per term; here every output row holds at most
    ``block_size`` urls: a term found in a third of all documents is spread
    over many bounded rows ``(term, block, urls)`` instead of one unbounded
    string in one task.  Blocks are ``block_col div block_size`` when the url
    has a unique integer id (``block_col``), else consecutive runs of
    ``block_size`` urls in url order.  Concatenating the blocks of a term in
    block order gives the full list.

    ``distinct`` allows a url in several rows and a term twice in a row.
    Both forms decode ``posting_blocks``.  For text urls the documents are
    ranked once and the runs follow from running sums over the headers (term,
    block, n); only those headers pass the ordered scan.
    """
    rows = df.select(F.col(url_col).alias("url"), F.col(terms_col).alias("terms"))
    if distinct:
        rows = (rows.select("url", F.explode("terms").alias("term")).distinct()
                .groupBy("url").agg(F.collect_list("term").alias("terms")))
    if block_col is not None:
        if block_col != url_col:
            raise ValueError("block_col must be the url column itself (a unique integer id)")
        found = decode_postings(posting_blocks(rows, "url", "terms", block_size))
        return found.select("term", "block", F.array_join(F.transform("ranks", lambda u: u.cast("string")), ",").alias("urls"),
                            F.col("n").alias("n_urls"))
    from quarry.sources.sinks import stage

    rows = stage(rows, "index-rows", reliable=False)  # read by the ranking and twice by the index: text is parsed once
    return _pages(rows, rank_urls(rows, "url"), block_size)


def _pages(rows: DataFrame, ranks: DataFrame, page: int) -> DataFrame:
    """Postings of text urls in runs of ``page`` urls of a term."""
    from quarry.plans.scan import running_sums
    from quarry.sources.sinks import stage

    block = 1024
    # the index as it is stored: the headers are read alone, the postings once
    index = stage(posting_blocks(rows.join(ranks.hint("shuffle_hash"), "url"), "rank", "terms", block), "index", reliable=False)
    # the urls of a block, in rank order: the same partitioning as the postings, so they meet without a shuffle
    names = (ranks.select(F.floor(F.col("rank") / block).cast("long").alias("block"), "rank", "url").repartition("block")
             .groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "url"))), lambda x: x["url"]).alias("names")))
    named = decode_postings(index).join(names.hint("shuffle_hash"), "block").select(
        "term", "block", "n", F.transform("ranks", lambda r: F.element_at(F.col("names"), (r % block + 1).cast("int"))).alias("list"))
    placed = running_sums(index.select("term", "block", "n"), ["term"], ["block"], {"n": "upto"}, before={"n": "before"})
    parts = named.drop("n").join(placed.hint("shuffle_hash"), ["term", "block"])
    cut = parts.select("term", "before", "upto", "list", F.explode(F.sequence(
        F.floor(F.col("before") / page).cast("long"), F.floor((F.col("upto") - 1) / page).cast("long"))).alias("page"))
    begin = F.greatest(F.col("page") * page, F.col("before"))
    end = F.least((F.col("page") + 1) * page, F.col("upto"))
    cut = cut.select("term", F.col("page").alias("block"), begin.alias("at"),
                     F.slice("list", (begin - F.col("before") + 1).cast("int"), (end - begin).cast("int")).alias("part"))
    whole = cut.repartition("term", "block").groupBy("term", "block").agg(F.array_sort(F.collect_list(F.struct("at", "part"))).alias("p"))
    urls = F.flatten(F.transform("p", lambda x: x["part"]))
    return whole.select("term", "block", F.array_join(urls, ",").alias("urls"), F.size(urls).cast("long").alias("n_urls"))


def name_count(df: DataFrame, name: Column | str, count_col: str = "count") -> DataFrame:
    """Count rows per name (map to (name, 1) + reduceByKey)."""
    return df.groupBy(as_col(name).alias("name")).agg(F.count(F.lit(1)).alias(count_col))


def width_and_contains(fields, min_fields: int, index: int, needle: str) -> Column:
    """``len(fields) >= min_fields and fields[index].contains(needle)``
    (``index`` zero-based).  The Scala twin used ``>``: pass ``min_fields+1``."""
    arr = as_col(fields)
    return (F.size(arr) >= F.lit(min_fields)) & F.coalesce(
        F.try_element_at(arr, F.lit(index + 1)).contains(F.lit(needle)), F.lit(False))
