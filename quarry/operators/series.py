"""Ordered per-key series: value changes, moving averages, best window.

Per-key order is handled by the skew-safe scan in ``quarry.plans.scan``
(range partition on key + order, carry between partitions), never by a
``Window.partitionBy(key)`` that would put a hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.aggregate import with_packed_key
from quarry.plans.scan import rolling_mean, value_changes


def dividend_changes(df: DataFrame, key: str, order: list[str], value: str, eps: float = 1e-6,
                     change_col: str = "change", num_partitions: int | None = None) -> DataFrame:
    """Per key in order, rows whose value moved by more than ``eps`` from
    the last *emitted* value (start 0.0), with the change.  Exact fold, not
    ``lag``: the reference moves its reference value only on output."""
    return value_changes(df, [key], order, value, eps, change_col, num_partitions,
                         pass_cols=[key, *order, value])


def price_series(df: DataFrame, key: str, order: str | list[str], value: str) -> DataFrame:
    """(key, order, value) in (key, order) order (range-partitioned sort)."""
    order = [order] if isinstance(order, str) else list(order)
    return df.select(key, *order, value).orderBy(key, *order)


def moving_average(df: DataFrame, key: str, order: list[str], value: str, width: int = 4,
                   out: str = "moving_avg", num_partitions: int | None = None) -> DataFrame:
    """Trailing mean over the last ``width`` rows of the key (fewer at the
    start of a key)."""
    return (rolling_mean(df, [key], order, value, width, out, num_partitions,
                         pass_cols=[key, *order, value])
            .drop("rn", "n_in_window"))


def best_window(df: DataFrame, key: str, order: list[str], value: str, width: int = 4,
                out: str = "best_avg", places: int = 8, num_partitions: int | None = None) -> DataFrame:
    """Per key, the full ``width``-row window with the highest mean
    ``value`` (means compared at ``places`` decimals; the first window wins
    ties).  Returns the key, the order columns of the window's last row and
    the mean.  Keys with fewer than ``width`` rows have no full window.

    The per-key arg-max is one hash aggregate with a partial step (mean and
    row number packed into one ordered key), so a hot key is reduced map-side."""
    rolled = rolling_mean(df, [key], order, value, width, "_avg", num_partitions,
                          pass_cols=[key, *order, value])
    full = rolled.where(F.col("n_in_window") == F.lit(width)).withColumn("_a", F.round("_avg", places))
    rows = with_packed_key(full.select(key, "_a", "rn", *order), "_a", "rn", "_k")
    best = rows.groupBy(key).agg(F.max("_a").alias(out), *[F.max_by(c, "_k").alias(c) for c in order])
    return best.select(key, *order, out)


def highest_window_by_group(df: DataFrame, key: str, order: str, value: str, width: int = 4) -> DataFrame:
    """The grouped function ``HighestClosingPriceWindow(width)`` as a
    Python function of its constructor argument."""
    return best_window(df, key, [order], value, width)
