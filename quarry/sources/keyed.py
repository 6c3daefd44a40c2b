"""A table keyed by columns, with replace, upsert and key joins without a shuffle.

The table is an ordinary Spark table (Parquet) in the session's catalog: rows are dealt by a hash of the key to ``parts`` partitions, in each
of them to ``buckets`` buckets by key, sorted by key.  The bucketing is part of the table's declaration, so two tables
of the same buckets join on their keys as they lie.  A lookup of one key reads one part, whose sorted files the pushed
filter can skip by their statistics.  An upsert rewrites only the parts that hold a key of the new rows (dynamic partition overwrite).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.sinks import stage

PART = "_part"


@contextmanager
def _only_touched_partitions(spark: SparkSession):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class KeyedTable:
    """``name`` in the catalog, one row a key.  ``keys`` must tell rows apart in what is written (the result of an
    aggregate by key does); null keys are kept as one key.  Equal ``parts`` and ``buckets`` make tables joinable without a shuffle."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str], parts: int = 16, buckets: int = 8):
        self.spark, self.name, self.keys, self.parts, self.buckets = spark, name, list(keys), parts, buckets

    def _part(self, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*(keys or self.keys)), F.lit(self.parts)).cast("int")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """A task writes one bucket: its file in every part, sorted by key."""
        return rows.withColumn(PART, self._part()).repartition(self.buckets, *self.keys).sortWithinPartitions(PART, *self.keys)

    def replace(self, rows: DataFrame) -> KeyedTable:
        """The table holds ``rows`` and nothing else."""
        (self._dealt(rows).write.mode("overwrite").format("parquet").partitionBy(PART).bucketBy(self.buckets, *self.keys)
         .sortBy(*self.keys).saveAsTable(self.name))
        return self

    def upsert(self, rows: DataFrame) -> KeyedTable:
        """Rows replace those of their key, or are added.  Columns are matched by name."""
        new = stage(rows.withColumn(PART, self._part()), "upsert", reliable=False)  # read for the parts, the merge and the write
        touched = [r[0] for r in new.select(PART).distinct().collect()]  # at most ``parts`` numbers
        if not touched:
            return self
        table = self.spark.table(self.name)
        same = F.lit(True)
        for k in self.keys:
            same = same & table[k].eqNullSafe(new[k])
        kept = table.where(F.col(PART).isin(touched)).join(new.select(*self.keys), same, "left_anti")
        merged = kept.unionByName(new.select(*table.columns))
        with _only_touched_partitions(self.spark):
            self._dealt(merged.drop(PART)).select(*table.columns).write.insertInto(self.name, overwrite=True)
        self.spark.catalog.refreshTable(self.name)
        return self

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def get(self, **key) -> DataFrame:
        """The row of one key: one part is read, with the key as a pushed filter."""
        one = self.spark.range(1).select(*[F.lit(key[k]).cast(dict(self.rows().dtypes)[k]).alias(k) for k in self.keys])
        part = one.select(self._part()).first()[0]
        wanted = F.col(PART) == F.lit(part)
        for k in self.keys:
            wanted = wanted & (F.col(k) == F.lit(key[k]) if key[k] is not None else F.col(k).isNull())
        return self.spark.table(self.name).where(wanted).drop(PART)

    def join(self, other: KeyedTable, how: str = "inner") -> DataFrame:
        """Rows of both tables by key (names of the key columns must agree); no exchange if both have the same buckets."""
        return self.rows().join(other.rows(), self.keys, how)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
