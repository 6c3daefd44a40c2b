"""Sort, top-k and partitioning operators.

``orderBy`` / ``repartitionByRange`` sample cut points on the full sort key,
so output partitions are balanced even when one key is very frequent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.columns import first_char_partition
from quarry.sources.sinks import stage

COPIES_IN_A_PIECE = 10_000


def total_order(df: DataFrame, cols: list, num_partitions: int | None = None) -> DataFrame:
    """O1: globally sorted output over ``num_partitions`` files: partition i
    holds keys below partition i+1 (sampled range cut points)."""
    if num_partitions:
        return df.repartitionByRange(num_partitions, *cols).sortWithinPartitions(*cols)
    return df.orderBy(*cols)


def placed(ordered: DataFrame, out: str = "position") -> DataFrame:
    """The place (from 1) of every row of a sorted DataFrame, in the order in
    which its partitions hold them.

    The rows are written once with their partition and place in it; the
    rows before each partition are a running sum over one count a partition
    (a table of that size, broadcast)."""
    rows = stage(ordered.withColumn("_at", F.monotonically_increasing_id()), "positions", reliable=False)
    part = F.shiftright("_at", 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(before), part == F.col("_part")).select(place.alias(out), *ordered.columns)


def ordered_copies(df: DataFrame, cols: list[str], copies: str | None = None, num_partitions: int | None = None,
                   piece: int = COPIES_IN_A_PIECE) -> DataFrame:
    """O1 / A15 for rows that repeat: ``cols`` in total order, every row as
    often as it occurs (or as the column ``copies`` says).

    A range cut cannot fall between equal rows, so one line holding a third of
    all rows would be one task's.  Equal rows are therefore counted first
    (partially in each task), counts are cut into pieces of at most ``piece`` copies,
    the pieces are range-partitioned on ``cols`` and their number, and are
    repeated where they lie."""
    n = F.count(F.lit(1)) if copies is None else F.sum(copies)
    counted = df.groupBy(*cols).agg(n.alias("_n")).where("_n > 0")
    last = F.floor((F.col("_n") - 1) / F.lit(piece)).cast("long")
    pieces = counted.select(*cols, "_n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_p"))
    pieces = pieces.select(*cols, "_p", F.least(F.lit(piece), F.col("_n") - F.col("_p") * piece).alias("_m"))
    pieces = stage(pieces, "pieces", reliable=False)  # sampled for the cuts, then sorted
    by = [*cols, "_p"]
    dealt = pieces.repartitionByRange(num_partitions, *by) if num_partitions else pieces.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by).select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m"))).alias("_i")).drop("_i")


def sort_by_count(df: DataFrame, count: str = "count", tiebreak: str = "word") -> DataFrame:
    """O2: ascending by count; ties broken by ``tiebreak`` for determinism."""
    return df.orderBy(F.col(count).asc(), F.col(tiebreak).asc())


def swap_count_word(df: DataFrame, word: str = "word", count: str = "count") -> DataFrame:
    """(word, count) -> (count, word)."""
    return df.select(count, word)


def top_k(df: DataFrame, k: int, by: str = "count", tiebreak: str = "name") -> DataFrame:
    """O3: the k largest by ``by``; planned as ``TakeOrderedAndProject``
    (per-task top-k, then a k-row merge) instead of a full sort."""
    return df.orderBy(F.col(by).desc(), F.col(tiebreak).asc()).limit(k)


def partition_by_first_letter(df: DataFrame, key: str, n: int, base: str | None = None) -> DataFrame:
    """Place rows by first character of ``key``: partition *i* holds the
    rows whose index ``pmod(code(c0) [- code(base)], n)`` is *i* (``pmod`` keeps
    the index in ``[0, n)`` where the reference could go negative; a row
    without a first character goes to partition 0)."""
    return df.repartitionById(n, F.coalesce(first_char_partition(key, n, base), F.lit(0)))


def spread(df: DataFrame, n: int, by: list | None = None) -> DataFrame:
    """Spread rows evenly (round robin) or by key hash."""
    return df.repartition(n, *by) if by else df.repartition(n)


def fixed_outputs(df: DataFrame, n: int) -> DataFrame:
    """A fixed reducer / output-file count.  A shuffle into ``n``
    partitions, not ``coalesce``: a narrow coalesce to few partitions would
    also run everything upstream of it in only ``n`` tasks."""
    return df.repartition(n)


def secondary_sort(df: DataFrame, group: list, order: list, num_partitions: int | None = None) -> DataFrame:
    """Group on part of a key, ordered by the rest (Pig's nested
    ORDER without building one bag per group).  A range partition on
    ``group + order`` keeps each group's rows contiguous and in order while
    still cutting a very large group across partitions."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = list(group) + list(order)
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
