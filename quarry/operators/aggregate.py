"""Keyed aggregations.

All of these are algebraic (sum, count, min, max, avg, max_by), so Spark
plans a partial aggregate before the exchange: a key holding a third of
the rows is reduced inside each map task and never concentrates raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.columns import as_col, coerce_double, java_trim


def mean_by_key(df: DataFrame, key, value, out: str = "mean", trim_key: bool = True,
                key_name: str | None = None) -> DataFrame:
    """A3: mean of ``value`` per ``key`` (partial (sum, count) then divide).

    ``trim_key`` applies ``String.trim`` semantics to string keys, as the
    reference does before grouping.  Sums are 64-bit / double, never 32-bit.
    """
    k = as_col(key)
    name = key_name or (key if isinstance(key, str) else "key")
    if trim_key and isinstance(key, str) and dict(df.dtypes).get(key) == "string":
        k = java_trim(k)
    return df.groupBy(k.alias(name)).agg(F.avg(as_col(value).cast("double")).alias(out))


def sum_by_key(df: DataFrame, key, value, out: str = "total") -> DataFrame:
    """A4: sum per key."""
    k = as_col(key)
    return df.groupBy(k).agg(F.sum(as_col(value)).alias(out))


def extremes(df: DataFrame, keys: list, high: str, low: str, extra_max: str,
             out=("max_high", "min_low", "max_extra")) -> DataFrame:
    """``max(high), min(low), max(extra)`` per key set."""
    return df.groupBy(*keys).agg(F.max(high).alias(out[0]), F.min(low).alias(out[1]),
                                 F.max(extra_max).alias(out[2]))


_LOW_BITS = 59            # of a packed key: dates, times of the years 1 to 9999, row numbers
_YEAR_ONE = -62_135_596_800_000_000  # microseconds


def _half(n: int) -> Column:
    return F.lit(float(2.0 ** n))


def with_double_order(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with a long that orders as the double ``value`` does (the bits of
    its absolute value as an integer, with its sign; NaN above infinity, both
    zeros equal), from exact arithmetic by powers of two.  The steps are
    columns of their own so that none is computed twice."""
    names = [f"_{out}_{x}" for x in ("size", "guess", "power", "scale", "step")]
    size, guess, power, scale, step = map(F.col, names)
    below, above = power > size, size >= power * 2
    steps = [F.abs(F.col(value).cast("double")), F.greatest(F.lit(-1022.0), F.least(F.lit(1023.0), F.floor(F.log2(size)).cast("double"))), F.pow(F.lit(2.0), guess),
             F.when(below, power / 2).when(above, power * 2).otherwise(power),
             F.when(below, -1).when(above, 1).otherwise(0)]
    for name, column in zip(names, steps, strict=True):
        df = df.withColumn(name, column)
    normal = (guess.cast("long") + step + 1022) * F.lit(1 << 52) + (size / scale * _half(52)).cast("long")
    bits = (F.when(F.isnan(size), F.lit((2047 << 52) + 1)).when(size == F.lit(float("inf")), F.lit(2047 << 52))
            .when(size < _half(-1022), (size * _half(537) * _half(537)).cast("long")).otherwise(normal))
    return df.withColumn(out, bits * F.when(F.col(value) < 0, -1).otherwise(1)).drop(*names)


def _wall_micros(f: Column) -> Column:
    """Microseconds of a timestamp without zone, whatever the session's zone."""
    return (F.unix_date(f.cast("date")).cast("long") * 86_400_000_000 + F.hour(f) * F.lit(3_600_000_000) + F.minute(f) * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), f) * 1_000_000).cast("long"))


def with_packed_key(df: DataFrame, value: str, first: str, out: str) -> DataFrame | None:
    """``df`` with one decimal that orders rows by ``value``, then by the
    *smallest* ``first`` (null last), so the row of the largest value is a
    hash aggregate's maximum.  None where a type does not fit (text, decimals)."""
    kinds = dict(df.dtypes)
    v, f = F.col(value), F.col(first)
    place = {"date": lambda: F.unix_date(f).cast("long") + F.lit(1 << 33), "int": lambda: f.cast("long") + F.lit(1 << 33),
             "bigint": lambda: f, "timestamp": lambda: F.unix_micros(f) - F.lit(_YEAR_ONE),
             "timestamp_ntz": lambda: _wall_micros(f) - F.lit(_YEAR_ONE)}.get(kinds[first])
    if place is None or kinds[value] not in ("double", "float", "tinyint", "smallint", "int", "bigint"):
        return None
    high = f"_{out}_high"
    df = with_double_order(df, value, high) if kinds[value] in ("double", "float") else df.withColumn(high, v.cast("long"))
    low = F.coalesce(F.lit((1 << _LOW_BITS) - 1) - place(), F.lit(0))
    key = F.col(high).cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(18,0)") + low.cast("decimal(18,0)")
    return df.withColumn(out, F.when(v.isNotNull(), key)).drop(high)


def max_with_date(df: DataFrame, key: str, value: str, date: str,
                  out=("max_value", "max_date")) -> DataFrame:
    """Per key, the maximum ``value`` and the (earliest) ``date`` it
    occurred on.

    One hash aggregate with a partial step: every task sends at most one row
    a key.  (value, date) are one packed decimal whose maximum is the row
    looked for.  Types that do not fit it (text dates) take two
    aggregates: the earliest date per (key, value), then ``max_by`` over values that are now unique per key."""
    rows = with_packed_key(df.select(key, value, date), value, date, "_k")
    if rows is not None:
        return rows.groupBy(key).agg(F.max(value).alias(out[0]), F.max_by(date, "_k").alias(out[1]))
    per_value = df.groupBy(key, value).agg(F.min(date).alias("_d"))
    return per_value.groupBy(key).agg(F.max(value).alias(out[0]), F.max_by("_d", value).alias(out[1]))


def total_of(df: DataFrame, value: str, out: str = "sum") -> DataFrame:
    """Global sum, 0 on empty input."""
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).alias(out))


def with_counters(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """Job counters as ``observe`` metrics (read back from the
    ``Observation`` after an action); defaults to a row count."""
    from pyspark.sql import Observation

    obs = Observation(name)
    exprs = [m.alias(k) for k, m in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    out = df.observe(obs, *exprs)
    out.observation = obs  # type: ignore[attr-defined]
    return out


def coerce_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """P4 for several columns."""
    return df.withColumns({c: coerce_double(c) for c in cols})
