"""Joins: left outer, broadcast behind a size check, semi, state lookup.

Broadcasting is never unconditional: ``checked_broadcast`` proves a bound
on the small side (row count with an early-stopping ``limit`` and a byte
estimate from the schema) and otherwise leaves the join to the planner,
which shuffles both sides on the key; AQE can still switch to a broadcast
at run time from real shuffle sizes, and splits skewed partitions
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import split_count

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {
    T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8,
    T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def row_width_estimate(schema: T.StructType, var_width: int = 32) -> int:
    """Bytes per row estimated from the schema (variable-width fields count
    ``var_width`` bytes; nested ones a multiple)."""
    total = 8
    for f in schema.fields:
        t = type(f.dataType)
        if t in _FIXED_WIDTH:
            total += _FIXED_WIDTH[t]
        elif isinstance(f.dataType, T.DecimalType):
            total += 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total += 4 * var_width
        else:
            total += var_width
    return total


DEFAULT_MAX_PARTITIONS = 64


def fits_broadcast(small: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                   var_width: int = 32, max_partitions: int = DEFAULT_MAX_PARTITIONS) -> bool:
    """True when ``small`` provably holds at most ``max_bytes / row_width``
    rows.  A side planned over more than ``max_partitions`` splits is
    refused without reading it (a side that small fits in a few splits);
    otherwise its rows are counted (partial counts, no rows move), so the
    check reads at most ``max_partitions`` splits."""
    if split_count(small) > max_partitions:
        return False
    max_rows = max(1, max_bytes // row_width_estimate(small.schema, var_width))
    return small.count() <= max_rows


def _has_shuffle(df: DataFrame) -> bool:
    """Whether ``df``'s physical plan contains an exchange (public explain text)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return "Exchange" in buf.getvalue()


def checked_broadcast(small: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(small)`` when its size is proven under ``max_bytes``,
    else ``small`` unchanged (shuffle join chosen by the planner).

    A side that is itself the output of a shuffle (an aggregate, a join) is
    not counted up front, which would compute it twice: AQE measures it when
    its shuffle stage finishes and switches to a broadcast join only if the
    real size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``."""
    if _has_shuffle(small):
        return small
    return F.broadcast(small) if fits_broadcast(small, max_bytes) else small


def left_join(big: DataFrame, small: DataFrame, on, declared_smaller: bool = False,
              max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """J1 (co-group left join) / J2 (right side declared smaller).

    Unmatched left rows keep nulls on the right columns."""
    right = checked_broadcast(small, max_bytes) if declared_smaller else small
    return big.join(right, on, "left")


def map_side_join(big: DataFrame, small: DataFrame, on,
                  max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Inner equi-join with the small side held by every task (no
    shuffle of ``big``) when its size is proven; shuffle join otherwise."""
    return big.join(checked_broadcast(small, max_bytes), on, "inner")


def _key_set(keys_df: DataFrame, on) -> DataFrame:
    """Distinct join keys: a key repeated in a third of the rows is reduced
    map-side (partial aggregate) instead of piling up in one join task."""
    cols = [on] if isinstance(on, str) else list(on)
    return keys_df.select(*cols).distinct()


def semi_join(rows: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """Rows having at least one match, each emitted once however many
    matches it has (reduce-side tagged join == left semi join)."""
    return rows.join(_key_set(keys_df, on), on, "left_semi")


def anti_count(rows: DataFrame, keys_df: DataFrame, on) -> DataFrame:
    """The reference's counter of keys without a partner, as a query."""
    return rows.join(_key_set(keys_df, on), on, "left_anti").agg(F.count(F.lit(1)).alias("unmatched"))


def lookup_sum(queries: DataFrame, counts: DataFrame, key: str = "word", value: str = "count",
               out: str = "sum") -> DataFrame:
    """J6 + P11 + A12: look each query key up in a count table, drop the
    misses, sum what was found (0 when nothing is found).  Equal keys are
    combined in each task first, so a key that is asked for in a third of
    the rows is joined as one row."""
    asked = queries.groupBy(key).agg(F.count(F.lit(1)).alias("_times"))
    found = asked.join(counts.select(key, value), key, "left").dropna(subset=[value])
    return found.agg(F.coalesce(F.sum(F.col("_times") * F.col(value)), F.lit(0)).cast("long").alias(out))
