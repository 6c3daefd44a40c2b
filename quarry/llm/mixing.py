"""Mixing sources to target weights by Poisson replication.

A source whose share of the characters should be ``w`` gets the mean repetition rate ``w * total / own``.  Each document
draws one uniform number from a keyed hash of its id and inverts the Poisson distribution of its source's rate with it,
is exploded by that count, and the copies are dealt out globally by a hash of id and copy.  The expected
characters of every source are then exactly its target; nothing depends on partitions or task order.

A rate above ``PART_RATE`` is the sum of equal parts of at most that much, each inverted with a uniform number of its own
(a sum of Poisson numbers is one), so a source's table has at most some 830 rows whatever its rate, and exponentials
never underflow.  Copies are exploded in two steps, so no array grows with the rate beyond copies / ``RUN``.

Defined cases: a null source is a source of its own; a null id draws as the text ``null``; repeated rows draw alike; an
empty or null text counts as one character, so a source of empty texts still has a rate; whole texts count, however
long; an empty table stays empty; columns of the input travel in a struct, so no name of theirs clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import table

SEED = "mix-1"
TEMPERATURE = 0.5
PART_RATE, RUN = 512, 65_536
_HEX = 13  # hex digits of the hash: 52 bits


def _bits(*parts: Column) -> Column:
    """52 bits of a hash as a long."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HEX), 16, 10).cast("long")


def source_rates(docs: DataFrame, source: str = "source", text: str = "text", temperature: float = TEMPERATURE,
                 targets: dict[str | None, float] | None = None) -> DataFrame:
    """``(source, size, rate)``: the mean repetitions that bring each source to its target share.  Targets are the
    given weights, or without them size ** ``temperature`` (0: equal shares, 1: as it is)."""
    own = docs.groupBy(docs[source].alias("source")).agg(
        F.sum(F.greatest(F.length(F.coalesce(docs[text], F.lit(""))), F.lit(1))).alias("size"))
    if targets is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, w in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    own = own.withColumn("weight", weight)
    total = own.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))  # one row
    return own.crossJoin(F.broadcast(total)).select(
        "source", "size", (F.col("weight") / F.col("all_weight") * F.col("all_size") / F.col("size")).alias("rate"))


def poisson_tables(rates: DataFrame) -> DataFrame:
    """``(source, rate, parts, cdf)``: the distribution function of ``rate / parts`` at 0, 1, 2, ..., until what is left
    is below 1e-16."""
    by_k = Window.partitionBy("source").orderBy("k")
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("long")
    steps = rates.withColumn("parts", parts).withColumn("own", F.col("rate") / F.col("parts")).withColumn(
        "k", F.explode(F.sequence(F.lit(0), F.ceil(F.col("own") + 12 * F.sqrt("own") + 30).cast("int"))))
    log_factorial = F.sum(F.when(F.col("k") > 0, F.ln("k")).otherwise(0.0)).over(by_k)
    p = F.when(F.col("own") > 0, F.exp(F.col("k") * F.ln("own") - F.col("own") - log_factorial)).otherwise(
        F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    return (steps.withColumn("p", p).withColumn("c", F.sum("p").over(by_k))
            .groupBy("source", "rate", "parts").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))),
                                                       lambda x: x["c"]).alias("cdf")))


def replicate(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: str = SEED,
              temperature: float = TEMPERATURE, targets: dict[str | None, float] | None = None) -> DataFrame:
    """``(row, rate, copies, copy, place)``: every input row as a struct, once for each of its copies; ``place``
    is the hash that a global shuffle sorts by."""
    tables = poisson_tables(source_rates(docs, source, text, temperature, targets))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[source].alias("src"),
                       docs[doc_id].alias("id"))
    out = rows.join(tables, F.col("src").eqNullSafe(F.col("source")))

    def drawn(*more: Column) -> Column:
        u = _bits(F.lit(seed), F.col("id"), *more) / F.lit(float(1 << 4 * _HEX))
        return F.size(F.filter("cdf", lambda c: c <= u)).cast("long")

    others = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("parts") - 1), F.lit(0).cast("long"),
                         lambda n, part: n + drawn(part))
    out = out.withColumn("copies", drawn() + F.when(F.col("parts") > 1, others).otherwise(0))
    out = (out.where("copies > 0").select("row", "rate", "copies", "id", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RUN).cast("long"))).alias("run")))
    return (out.select("row", "rate", "copies", "id", F.explode(F.sequence(
        F.col("run"), F.least(F.col("run") + RUN, F.col("copies")) - 1)).alias("copy"))
            .select("row", "rate", "copies", "copy",
                    _bits(F.lit(f"{seed}-place"), F.col("id"), F.col("copy")).alias("place")))


def shuffled(copies: DataFrame) -> DataFrame:
    """Global shuffle: copies are dealt to partitions by their hash and sorted by it there."""
    return copies.repartition("place").sortWithinPartitions("place")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document: doc_id, source, copy, copies, rate (9 places), place; shuffled by place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return shuffled(replicate(docs).select("row.doc_id", "row.source", "copy", "copies", F.round("rate", 9).alias("rate"),
                                           "place"))


OP7_SQL = f"""
WITH own AS (
  SELECT source, sum(greatest(length(coalesce(text, '')), 1))::BIGINT AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, pow(size::DOUBLE, {TEMPERATURE}) / (SELECT sum(pow(size::DOUBLE, {TEMPERATURE})) FROM own)
         * (SELECT sum(size) FROM own)::DOUBLE / size AS rate FROM own),
split AS (
  SELECT *, rate / parts AS own FROM (SELECT *, greatest(ceil(rate / {PART_RATE}), 1)::BIGINT AS parts FROM rates)),
steps AS (
  SELECT source, rate, parts, own, unnest(generate_series(0, ceil(own + 12 * sqrt(own) + 30)::BIGINT)) AS k FROM split),
masses AS (
  SELECT source, rate, parts, k, exp(k * ln(own) - own - sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END)
         OVER (PARTITION BY source ORDER BY k)) AS p FROM steps),
cdf AS (SELECT source, rate, parts, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM masses),
numbered AS (
  SELECT row_number() OVER () AS r, d.doc_id, d.source, s.rate, unnest(generate_series(0, s.parts - 1)) AS part
  FROM documents d JOIN split s ON d.source IS NOT DISTINCT FROM s.source),
uniform AS (
  SELECT r, doc_id, source, rate, ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')
         || CASE WHEN part > 0 THEN ':' || part ELSE '' END), 1, {_HEX}))::BIGINT / 4503599627370496.0 AS u FROM numbered),
drawn AS (
  SELECT d.doc_id, d.source, d.rate, count(*) FILTER (WHERE c <= u) AS copies
  FROM uniform d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source GROUP BY d.r, d.doc_id, d.source, d.rate)
SELECT doc_id, source, copy, copies, round(rate, 9) AS rate,
       ('0x' || substr(md5('{SEED}-place:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy), 1, {_HEX}))::BIGINT AS place
FROM (SELECT *, unnest(generate_series(0, copies - 1)) AS copy FROM drawn WHERE copies > 0)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: documents replicated to the target weights and shuffled; columns as they were."""
    return shuffled(replicate(docs)).select("row.*")
