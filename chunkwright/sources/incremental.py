"""Reload of a folder of chunk files that parses only what changed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .chunks import parse_chunks

_MANIFEST = "source string, mtime timestamp, length bigint, batch bigint"


# Suffix of a chunk file, and whether the whole file is one chunk.
CHUNK_FILES = {"jsonl": False, "json": True}


def list_files(spark: SparkSession, folder: str, suffixes: Iterable[str] = CHUNK_FILES) -> DataFrame:
    """(path, source, mtime, length) of the chunk files; contents are not read.

    ``source`` is the file as scans report it, ``path`` as readers take it.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
        .load(folder)
        .select(
            "path",
            F.col("_metadata.file_path").alias("source"),
            F.col("modificationTime").alias("mtime"),
            "length",
        )
    )


def changed_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """New files and files whose time or length differs."""
    return listing.join(manifest, ["source", "mtime", "length"], "left_anti")


#: Paths the driver hands to one read.
PATHS_AT_ONCE = 10_000


def _path_batches(files: DataFrame) -> Iterator[list[str]]:
    rows = (r["path"] for r in files.toLocalIterator())
    while paths := list(islice(rows, PATHS_AT_ONCE)):
        yield paths


def incremental_load(
    spark: SparkSession, folder: str, state: str, version: int, suffixes: Mapping[str, bool] = CHUNK_FILES
) -> DataFrame:
    """Parsed rows of ``folder`` as it is now, reusing what ``state`` holds.

    Parsed rows are appended under their batch number and never rewritten; the
    manifest of ``version`` says which batch of which file is live. Rows of
    changed or vanished files are left behind by the join with the manifest.
    Running a version again gives the same state.
    """
    # Fixed once: files are parsed from the same list that enters the manifest, and a file
    # that changes later differs from its entry and is read again by the next version.
    listing = settle(list_files(spark, folder, suffixes))
    if version > 0:
        manifest = spark.read.schema(_MANIFEST).parquet(f"{state}/manifest/version={version - 1}")
    else:
        manifest = spark.createDataFrame([], _MANIFEST)
    fresh = settle(changed_files(listing, manifest).select("path"))
    target, first = f"{state}/parsed/batch={version}", True
    for suffix, whole in suffixes.items():
        for paths in _path_batches(fresh.filter(F.col("path").endswith("." + suffix))):
            lines = spark.read.text(paths, wholetext=whole).select(
                "value", F.col("_metadata.file_path").alias("source")
            )
            parse_chunks(lines).write.mode("overwrite" if first else "append").parquet(target)
            first = False
    live = listing.join(manifest, ["source", "mtime", "length"], "left").withColumn(
        "batch", F.coalesce("batch", F.lit(version))
    )
    live.select("source", "mtime", "length", "batch").write.mode("overwrite").parquet(
        f"{state}/manifest/version={version}"
    )
    return live_rows(spark, state, version)


def live_rows(spark: SparkSession, state: str, version: int) -> DataFrame:
    manifest = spark.read.schema(_MANIFEST).parquet(f"{state}/manifest/version={version}")
    return (
        spark.read.parquet(f"{state}/parsed")
        .join(manifest.select("source", "batch"), ["source", "batch"], "left_semi")
        .drop("batch")
    )
