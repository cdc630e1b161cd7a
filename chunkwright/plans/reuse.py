"""Stage outputs kept between runs, under what they were made from.

A stage is filed under a digest of the input's snapshot and of every setting that shapes it. A run whose
digest is there reads the table; any other settings make another digest, and with it new tables for that stage and those after.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot(chunks: DataFrame) -> str:
    """Digest of a chunk table, whatever the order of its rows: one pass, no shuffle but of one row a task."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(chunks.columns)])
    # Hashes are summed as decimals, twice with other seeds, so that no sum overflows and chance matches do not occur.
    again = F.xxhash64(F.lit(1), *[F.col(f"`{c}`") for c in sorted(chunks.columns)])
    total = chunks.agg(
        F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("a"), F.sum(again.cast("decimal(38,0)")).alias("b")
    ).first()
    return _digest(sorted(chunks.dtypes), tuple(total))


def _digest(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:24]


class Stages:
    """A folder of stage outputs for one snapshot; ``reused`` says of each stage asked for whether it was there."""

    def __init__(self, spark: SparkSession, folder: str, snapshot: str):
        self.spark, self.folder, self.last = spark, folder.rstrip("/"), snapshot
        self.reused: dict[str, bool] = {}

    def keep(self, name: str, settings: tuple, build: Callable[[], DataFrame]) -> DataFrame:
        """The output of stage ``name``, which follows on the stage asked for before it.

        A table counts once its last file is committed, so a run that broke off leaves nothing to be mistaken for one.
        """
        self.last = _digest(self.last, name, settings)
        path = f"{self.folder}/{name}/{self.last}"
        self.reused[name] = self._complete(path)
        if not self.reused[name]:
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def has(self, name: str, settings: tuple) -> bool:
        """Whether the next stage, if asked for so, would be read."""
        return self._complete(f"{self.folder}/{name}/{_digest(self.last, name, settings)}")

    def _complete(self, path: str) -> bool:
        location = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(location)
