"""Chunk readers: JSON lines, single-object JSON files, folders, object stores, tables."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import settle

log = logging.getLogger(__name__)

_END_MARK = "end-of-line-7d1f0c52"
_ORDER = ["path_idx", "file", "block", "line"]


def parse_chunks(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add doc_id, chunk_id, chunk_text, embedding and ``error`` to raw JSON strings.

    VARIANT tells a missing key from an explicit null, which the rules need: a
    present ``chunk_text`` or ``embedding`` wins over its second name even when null.
    """

    def path(key: str) -> str:
        return f"try_variant_get(__object, '$.{key}', 'variant')"

    def pick(first: str, second: str) -> Column:
        return F.expr(f"CASE WHEN {path(first)} IS NOT NULL THEN {path(first)} ELSE {path(second)} END")

    # The JSON parser stops after the first value; the mark behind it is found at
    # its place only when nothing else follows in the line.
    marked = F.concat(F.lit("["), F.col(value), F.lit(f',"{_END_MARK}"]'))
    parsed = (
        lines.withColumn("__json", F.try_parse_json(marked))
        .withColumn(
            "__object",
            F.expr(
                f"IF(try_variant_get(__json, '$[1]', 'string') = '{_END_MARK}', "
                "try_variant_get(__json, '$[0]', 'variant'), NULL)"
            ),
        )
        .withColumn("__text", pick("chunk_text", "chunk"))
        .withColumn("__vector", pick("embedding", "content_vector"))
        .withColumn("embedding", F.expr("try_variant_get(__vector, '$', 'array<double>')"))
    )
    error = (
        F.when(F.col("__object").isNull(), "not JSON")
        .when(~F.coalesce(F.schema_of_variant("__object").startswith("OBJECT"), F.lit(False)), "not an object")
        .when(F.expr(f"{path('doc_id')} IS NULL"), "no doc_id")
        .when(F.expr(f"{path('chunk_id')} IS NULL"), "no chunk_id")
        .when(F.expr("is_variant_null(__text)"), "chunk_text is null")
        .when(F.expr("__vector IS NULL OR is_variant_null(__vector)"), "no embedding")
        .when(F.col("embedding").isNull(), "embedding is not an array of numbers")
        .when(F.exists("embedding", lambda x: x.isNull()), "embedding holds a value that is no number")
    )
    return (
        parsed.withColumn("doc_id", F.expr("try_variant_get(__object, '$.doc_id', 'string')"))
        .withColumn("chunk_id", F.expr("try_variant_get(__object, '$.chunk_id', 'string')"))
        .withColumn(
            "chunk_text",
            F.when(F.col("__text").isNull(), F.lit("")).otherwise(
                F.expr("try_variant_get(__text, '$', 'string')")
            ),
        )
        .withColumn("error", error)
        .drop("__json", "__object", "__text", "__vector")
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error", "value")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The raw text of what could not be used, with the cause."""
    return parsed.filter(F.col("error").isNotNull()).select("value", "error")


def _read_text(
    spark: SparkSession, path: str, glob: str, path_idx: int, whole: bool, recursive: bool = False
) -> DataFrame:
    return (
        spark.read.text(path, wholetext=whole, pathGlobFilter=glob, recursiveFileLookup=recursive)
        .select(
            "value",
            F.lit(path_idx).alias("path_idx"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
    )


def scan_jsonl(spark: SparkSession, path: str, path_idx: int = 0, glob: str = "*.jsonl") -> DataFrame:
    """One chunk per line."""
    return parse_chunks(_read_text(spark, path, glob, path_idx, whole=False))


def scan_json_file(spark: SparkSession, path: str, path_idx: int = 0) -> DataFrame:
    """One chunk per whole ``*.json`` file."""
    return parse_chunks(_read_text(spark, path, "*.json", path_idx, whole=True))


def scan_object_store(spark: SparkSession, uri: str, path_idx: int = 0) -> DataFrame:
    """All ``*.json`` objects below a prefix, nested ones too; tasks are the parallelism."""
    return parse_chunks(_read_text(spark, uri, "*.json", path_idx, whole=True, recursive=True))


def scan_prefixes(spark: SparkSession, uris: Sequence[str]) -> DataFrame:
    """The objects below every prefix, in the order given."""
    if not uris:
        raise ValueError("no readable input paths")
    return reduce(DataFrame.unionByName, (scan_object_store(spark, uri, idx) for idx, uri in enumerate(uris)))


def _is_directory(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(location):
        raise FileNotFoundError(path)
    return files.getFileStatus(location).isDirectory()


def scan_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files and folders, in the order given; folders are not searched recursively."""
    parts = []
    for idx, path in enumerate(paths):
        if _is_directory(spark, path):
            parts += [scan_jsonl(spark, path, idx), scan_json_file(spark, path, idx)]
        elif path.endswith(".jsonl"):
            parts.append(scan_jsonl(spark, path, idx))
        elif path.endswith(".json"):
            parts.append(scan_json_file(spark, path, idx))
        else:
            log.warning("unsupported file type, left out: %s", path)
    if not parts:
        raise ValueError("no readable input paths")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def load_order(chunks: DataFrame, order_by: Sequence[str] = ("doc_id", "chunk_id")) -> DataFrame:
    """Add ``ord`` BIGINT following ``order_by``.

    A range-partitioned sort and the increasing row id give the order without a
    single-task window. The place in the input breaks ties, so a key repeated many
    times is spread too. The result is written down, so the ids stay fixed.
    """
    columns = [c for c in chunks.columns if c not in _ORDER or c in order_by]
    ordered = (
        chunks.select(*columns, F.monotonically_increasing_id().alias("__place"))
        .orderBy(*order_by, "__place")
        .drop("__place")
    )
    return settle(ordered.withColumn("ord", F.monotonically_increasing_id()))


#: Splits of input files whose numbers are sent to all tasks; beyond that they are joined.
_SPLITS_SENT = 1_000_000


def number_lines(parsed: DataFrame) -> DataFrame:
    """Add ``ord`` BIGINT in the order of the input: by path, file, and place in the file.

    Rows are written down where they are and never sorted. A split of a file (``_ORDER``) numbers its own rows; only one
    row for each split is put into order, and their lengths are added up within and between the parts of that order.
    """
    spark = parsed.sparkSession
    rows = settle(parsed)
    split = [c for c in _ORDER if c != "line"]
    sizes = rows.groupBy(*split).agg((F.max("line") - F.min("line") + 1).alias("n"), F.min("line").alias("first"))
    ordered = settle(
        sizes.orderBy(*split).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    )
    base, bases = 0, []
    for r in ordered.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():  # one for each task of a sort
        bases.append((r["part"], base))
        base += r["n"]
    parts = F.broadcast(spark.createDataFrame(bases, "part int, base bigint"))
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    starts = settle(ordered.join(parts, "part").select(*split, start.alias("start")))
    if starts.count() <= _SPLITS_SENT:
        starts = F.broadcast(starts)
    return rows.join(starts, split).withColumn("ord", F.col("line") + F.col("start")).drop(*_ORDER, "start")


def unique_keys(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first row of every (doc_id, chunk_id), later rows of the same key).

    The keys are compared without texts and vectors. The later rows are few as a
    rule and their ``ord`` is written down, so Spark can broadcast it instead of
    shuffling the chunks.
    """
    first = chunks.groupBy("doc_id", "chunk_id").agg(F.min("ord").alias("ord")).select("ord")
    later = settle(chunks.select("ord").join(first, "ord", "left_anti"))
    return chunks.join(later, "ord", "left_anti"), chunks.join(later, "ord", "left_semi")


def check_dims(chunks: DataFrame, expected: int | None = None) -> int | None:
    """Width shared by all vectors; ``ValueError`` when they differ or are not ``expected``.

    Chunks without a vector have no width and are left aside.
    """
    known = dims(chunks).filter(F.col("width").isNotNull()).orderBy(F.desc("rows"), "width")
    widths = [r["width"] for r in known.limit(21).collect()]
    if len(widths) > 1:
        more = " and more" if len(widths) > 20 else ""
        raise ValueError(f"inconsistent embedding widths: {sorted(widths[:20])}{more}")
    if widths and expected is not None and widths[0] != expected:
        raise ValueError(f"embedding width {widths[0]}, expected {expected}")
    return widths[0] if widths else None


def dims(chunks: DataFrame) -> DataFrame:
    """(width, rows); a missing vector has a NULL width."""
    return chunks.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("rows"))


def load_chunks(
    spark: SparkSession, paths: Sequence[str], input_type: str = "chunks", embed_dim: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(chunks with ``ord``, quarantined rows) for an input type."""
    if input_type == "documents":
        raise ValueError("split documents with operators.extensions.chunk_documents and add their vectors first")
    if input_type == "chunks":
        parsed = scan_paths(spark, paths)
    elif input_type == "object_store_chunks":
        parsed = scan_prefixes(spark, paths)
    else:
        raise ValueError(f"unknown input type {input_type!r}")
    # The raw text is kept only for what goes to quarantine.
    parsed = parsed.withColumn("value", F.when(F.col("error").isNotNull(), F.col("value")))
    ordered = number_lines(parsed)
    chunks, repeated = unique_keys(good_rows(ordered))
    check_dims(chunks, embed_dim)
    bad = quarantine(ordered).unionByName(
        repeated.select(
            F.to_json(F.struct("doc_id", "chunk_id", "chunk_text")).alias("value"),
            F.lit("repeated key").alias("error"),
        )
    )
    return chunks, bad
