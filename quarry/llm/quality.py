"""Quality rules as a bitmask ledger.

``measure`` takes all measurements of a text in one pass, ``ledger`` evaluates every rule once and keeps one row a
document: the measurements and one integer whose bit *i* says that rule *i* failed.  Policies are versioned data (which
failures reject alone, which are counted) and are applied to the bits afterwards, as often as wished, without a
text being read again.  ``ablation`` counts bit patterns (partially in every task) and works on those: what each rule
rejects, what it alone rejects, what would pass without it.

Rules are written in integers, so equal measurements give equal bits everywhere.  New rules are added at the end: bits of
stored ledgers keep their meaning.

Defined cases: a null text has no words and so fails ``few_words``; repeated rows and null ids are rows of their own; other
columns are ignored; an empty table gives an empty ledger and an ablation of zeros; a text of any length is measured whole, by
the task that holds it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table
from quarry.llm.fim import slices

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_distinct_words", "n_digits", "max_word_chars", "n_bullet_lines", "n_open_lines")

#: Name and failure condition of each rule, by bit.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("few_letters", "10 * n_letter_words < 8 * n_words"),
    ("short_words", "word_chars < 3 * n_words"),
    ("long_words", "word_chars > 10 * n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("digits", "4 * n_digits > word_chars"),
    ("bullets", "10 * n_bullet_lines > 9 * n_lines"),
    ("open_lines", "10 * n_open_lines > 3 * n_lines"),
    ("endless_word", "max_word_chars > 1000"),
    ("few_distinct_words", "20 * n_distinct_words < n_words"),
    ("many_words", "n_words > 100000"),
)


def mask(*names: str, rules=RULES) -> int:
    """The bits of the named rules."""
    known = [r[0] for r in rules]
    return sum(1 << known.index(n) for n in set(names))


@dataclass(frozen=True)
class Policy:
    """A document is rejected if it fails a rule of ``hard``, or more than ``allowed`` rules of ``soft`` (masks)."""

    version: str
    hard: int
    soft: int = 0
    allowed: int = 0

    def rejects(self, bits: Column) -> Column:
        out = bits.bitwiseAND(F.lit(self.hard)) != 0
        return out | (F.bit_count(bits.bitwiseAND(F.lit(self.soft))) > self.allowed) if self.soft else out


BASE = mask("few_words", "repeated_windows")
POLICIES = (
    Policy("1", BASE | mask("symbols", "few_letters", "repeated_lines", "digits"),
           mask("short_words", "long_words", "bullets", "open_lines", "endless_word", "few_distinct_words"), 1),
    Policy("1-strict", (1 << len(RULES)) - 1),
)


def repeated_words(codes: np.ndarray, text: np.ndarray, n_texts: int, window: int = WINDOW) -> np.ndarray:
    """For each text, the words that lie in a run of ``window`` words (a power of two) which it holds twice or more.

    ``codes`` numbers the words (equal words alike), ``text`` is the text of each word.  Runs are numbered by doubling: two
    neighbouring runs of k words make one of 2 k, so equal numbers mean equal words and nothing is hashed."""
    if len(codes) < window:
        return np.zeros(n_texts, np.int64)
    runs, k = codes.astype(np.int64), 1
    while k < window:
        _, runs = np.unique(runs[:-k] * (int(runs.max()) + 1) + runs[k:], return_inverse=True)
        k *= 2
    inside = np.flatnonzero(text[:len(runs)] == text[window - 1:])
    if not len(inside):
        return np.zeros(n_texts, np.int64)
    _, key, times = np.unique(text[inside].astype(np.int64) * (int(runs.max()) + 1) + runs[inside], return_inverse=True,
                              return_counts=True)
    begins = inside[times[key] > 1]
    covered = np.zeros(len(codes) + 1, np.int64)
    np.add.at(covered, begins, 1)
    np.add.at(covered, begins + window, -1)
    return np.bincount(text[np.cumsum(covered[:-1]) > 0], minlength=n_texts)


def _parts(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Flattened values of a list column and the row of each."""
    return pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)


def _most(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.maximum.at(out, row, values)
    return out


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """All measurements of a column of texts."""
    n = len(texts)
    texts = pc.fill_null(texts, "")
    words, of = _parts(pc.ascii_split_whitespace(texts))
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    words, of = words.filter(pa.array(real)).dictionary_encode(), of[real]
    code = words.indices.to_numpy(zero_copy_only=False)
    size = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)[code]
    letters = pc.match_substring_regex(words.dictionary, "[A-Za-z\\x{80}-\\x{10FFFF}]").to_numpy(zero_copy_only=False)[code]
    n_words = np.bincount(of, minlength=n)

    lines, at = _parts(pc.split_pattern(texts, "\n"))
    real = pc.match_substring_regex(lines, "[^\\x20\\x09-\\x0D]").to_numpy(zero_copy_only=False)
    lines, at = lines.filter(pa.array(real)).dictionary_encode(), at[real]
    bullet = pc.match_substring_regex(lines.dictionary, "^[\\x20\\x09]*[-*\u2022]").to_numpy(zero_copy_only=False)
    open_ = pc.match_substring_regex(lines.dictionary, "(\\.\\.\\.|\u2026)[\\x20\\x09-\\x0D]*$").to_numpy(zero_copy_only=False)
    line = lines.indices.to_numpy(zero_copy_only=False)
    n_lines = np.bincount(at, minlength=n)
    distinct = lambda row, key: np.bincount(np.unique(row.astype(np.int64) << 32 | key)  >> 32, minlength=n)
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int64)
    return {
        "n_words": n_words,
        "word_chars": np.bincount(of, size, n).astype(np.int64),
        "n_symbols": count("[#*$%&|<>]"),
        "n_dup_lines": n_lines - distinct(at, line),
        "n_repeat_words": repeated_words(code, of, n),
        "n_lines": n_lines,
        "n_letter_words": np.bincount(of[letters], minlength=n),
        "n_distinct_words": distinct(of, code),
        "n_digits": count("[0-9]"),
        "max_word_chars": _most(size, of, n),
        "n_bullet_lines": np.bincount(at[bullet[line]], minlength=n),
        "n_open_lines": np.bincount(at[open_[line]], minlength=n),
    }


def measurements(docs: DataFrame) -> DataFrame:
    """doc_id and all measurements of every document."""

    def run(batches):
        for batch in slices(batches, "text"):
            m = measure(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(m[k].astype(np.int64)) for k in MEASURES)],
                                             ["doc_id", *MEASURES])

    return (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
            .mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in MEASURES)))


def ledger(docs: DataFrame, rules=RULES) -> DataFrame:
    """Measurements and ``bits`` of every document."""
    bits = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs).withColumn("bits", bits)


def ablation(rows: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """For every policy and rule: documents that fail it, are rejected, are rejected by no other rule
    (``n_kept_without``: they pass once the rule is taken out), and would be rejected were it the only rule.

    ``rows`` has ``bits``.  Documents are counted by pattern first; only patterns meet the rules."""
    spark = rows.sparkSession
    patterns = rows.groupBy("bits").agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("bit"), F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("own"))
                               for i, (name, _) in enumerate(rules)]))
    pairs = patterns.select("bits", "n", each.alias("r")).select("bits", "n", "r.*")
    out = None
    for policy in policies:
        rejected = policy.rejects(F.col("bits"))
        without = policy.rejects(F.col("bits").bitwiseAND(F.bitwise_not("own")))
        alone = policy.rejects(F.col("bits").bitwiseAND(F.col("own")))
        total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
        part = pairs.groupBy("bit", "rule").agg(
            total(F.col("bits").bitwiseAND(F.col("own")) != 0).alias("n_failed"), total(rejected).alias("n_rejected"),
            total(rejected & ~without).alias("n_kept_without"), total(alone).alias("n_rejected_alone"))
        part = part.withColumn("policy", F.lit(policy.version))
        out = part if out is None else out.union(part)
    # rules that no document met still have a row
    every = spark.createDataFrame([(p.version, i, r[0]) for p in policies for i, r in enumerate(rules)], "policy string, bit int, rule string")
    return every.join(out, ["policy", "bit", "rule"], "left").na.fill(0)


def decisions(rows: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """``rows`` of a ledger with the names of the failed rules, the rule that alone decides a rejection under the
    first policy, and whether each policy keeps the document (``kept``, then ``kept_<version>``)."""
    first = policies[0]
    bits = F.col("bits")
    names = [F.when(bits.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, (name, _) in enumerate(rules)]
    sole = [F.when(first.rejects(bits) & (bits.bitwiseAND(F.lit(1 << i)) != 0)
                   & ~first.rejects(bits.bitwiseAND(F.lit(~(1 << i)))), F.lit(name)) for i, (name, _) in enumerate(rules)]
    more = {"kept_" + p.version.replace("-", "_"): ~p.rejects(bits) for p in policies[1:]}
    return rows.withColumns({"kept": ~first.rejects(bits), "failed_rules": F.concat_ws(",", *names),
                             "sole_rule": F.concat_ws(",", *sole), **more})


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the current policies."""
    rows = decisions(ledger(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (F.col("bits").bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"), "kept", "bits", "failed_rules",
                       "sole_rule", "kept_1_strict")


OP11_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n FROM rep, (SELECT unnest(range(0, 8)) AS j) GROUP BY rid),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
         coalesce(cov.n, 0) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_letter_words,
         len(list_distinct(w)) AS n_distinct_words, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits,
         coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS max_word_chars,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*\x{2022}]'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$'))) AS n_open_lines
  FROM w LEFT JOIN cov USING (rid)),
r AS (
  SELECT *, [n_words < 20, 100 * n_repeat_words > 30 * n_words, 10 * n_symbols > n_words, 10 * n_letter_words < 8 * n_words,
             word_chars < 3 * n_words, word_chars > 10 * n_words, 2 * n_dup_lines > n_lines, 4 * n_digits > word_chars,
             10 * n_bullet_lines > 9 * n_lines, 10 * n_open_lines > 3 * n_lines, max_word_chars > 1000,
             20 * n_distinct_words < n_words, n_words > 100000] AS f FROM m),
d AS (
  SELECT *, f[1] OR f[2] OR f[3] OR f[4] OR f[7] OR f[8] AS hard, f[5]::INT + f[6]::INT + f[9]::INT + f[10]::INT + f[11]::INT + f[12]::INT AS soft,
         f[1]::INT + f[2]::INT + f[3]::INT + f[4]::INT + f[7]::INT + f[8]::INT AS n_hard,
         ['few_words', 'repeated_windows', 'symbols', 'few_letters', 'short_words', 'long_words', 'repeated_lines', 'digits',
          'bullets', 'open_lines', 'endless_word', 'few_distinct_words', 'many_words'] AS names FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f[1] OR f[2] AS base_failed,
       NOT (hard OR soft > 1) AS kept,
       list_sum(list_transform(f, lambda x, i: CASE WHEN x THEN (1::BIGINT << (i - 1)::BIGINT) ELSE 0 END))::BIGINT AS bits,
       array_to_string(list_filter(names, lambda x, i: f[i]), ',') AS failed_rules,
       CASE WHEN n_hard = 1 AND soft <= 1 THEN array_to_string(list_filter(names, lambda x, i: f[i] AND i IN (1, 2, 3, 4, 7, 8)), ',')
            WHEN n_hard = 0 AND soft = 2 THEN array_to_string(list_filter(names, lambda x, i: f[i] AND i IN (5, 6, 9, 10, 11, 12)), ',')
            ELSE '' END AS sole_rule,
       NOT list_bool_or(f) AS kept_1_strict
FROM d
"""
