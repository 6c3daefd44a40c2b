"""Writers: delimited text, discard, staging, report lines, cache."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.functions.columns import fixed_width
from quarry.session import scratch_path


def write_delimited(df: DataFrame, path: str, sep: str = "\t", header: bool = False,
                    replace: bool = True, compression: str | None = None,
                    num_files: int | None = None) -> None:
    """Text output.

    ``replace=True`` overwrites old output (S11); ``False`` fails when the
    output exists (S12).  ``header`` on or off (S13); ``compression`` e.g.
    ``"snappy"``, ``"gzip"`` (S15).  ``num_files`` fixes the file count
    (O7) with a shuffle into that many partitions."""
    # repartition, not coalesce: the work upstream keeps its own parallelism
    out = df.repartition(num_files) if num_files else df
    w = out.write.mode("overwrite" if replace else "errorifexists").option("sep", sep).option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def discard(df: DataFrame) -> None:
    """Run the job, keep nothing (``noop`` sink)."""
    df.write.format("noop").mode("overwrite").save()


def stage(df: DataFrame, name: str = "stage", reliable: bool = True) -> DataFrame:
    """Materialise an intermediate result between steps.

    ``reliable=True`` cuts the lineage with ``checkpoint()`` into the shared
    checkpoint folder (survives executor loss); otherwise it writes Parquet
    under the same folder and reads it back."""
    from quarry.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    if reliable:
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def report_lines(df: DataFrame, name: str = "name", count: str = "count", width: int = 35) -> DataFrame:
    """``"%-35s%d"`` lines, one per row (print with ``show``)."""
    return df.select(fixed_width(name, count, width).alias("line"))


def keep_in_memory(df: DataFrame) -> DataFrame:
    """Cache for reuse across actions."""
    return df.cache()

