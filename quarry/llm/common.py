"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_root

_M64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables of one operator run in the cluster's shared folder (``spark.checkpoint.dir``).

    ``put`` writes a DataFrame as Parquet and reads it back: that cuts the lineage and survives a lost executor.
    Leaving the ``with`` block deletes every table but those named in ``keep``, so that a run leaves only
    what its lazy result still reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
        self.kept: set[str] = set()
        self.names: list[str] = []

    def put(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        self.names.append(name)
        if keep:
            self.kept.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete one table now, when nothing reads it any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self.names.remove(name)

    def drop_all(self, *starts: str) -> None:
        """Delete the tables whose names start like one of these."""
        for name in [n for n in self.names if n.startswith(starts)]:
            self.drop(name)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        for name in [n for n in self.names if exc[0] is not None or n not in self.kept]:
            self.drop(name)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def mix64(x):
    """SplitMix64 finaliser over a numpy uint64 array (wraps around)."""
    import numpy as np

    x = (x + np.uint64(0x9E3779B97F4A7C15)) & np.uint64(_M64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
