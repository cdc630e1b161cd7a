"""Files arriving in a folder, as a table with one row per key: later arrivals replace earlier ones.

Rows lie in buckets by the hash of their key. A batch rewrites only the buckets that its keys fall into,
below its own number, and a manifest says which batch holds which bucket; so readers see a batch as a whole or not at
all, and a batch that runs twice writes the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.keys import chunk_key
from ..operators.validation import length_ok, with_token_count
from ..options import Options
from ..sources.chunks import good_rows, parse_chunks, quarantine

_KEY = ["doc_id", "chunk_id"]
_ROW = "doc_id string, chunk_id string, chunk_text string, embedding array<double>"
_MANIFEST = "bucket int, holder bigint, batch bigint"


def _holders(spark: SparkSession, out: str, before: int | None = None) -> dict[int, int]:
    """Bucket -> batch that holds it, as of the last batch (before ``before``); one entry for each bucket at most."""
    if before == 0:
        return {}
    manifest = spark.read.schema(_MANIFEST).parquet(f"{out}/manifest")
    if before is not None:
        manifest = manifest.filter(F.col("batch") < before)
    last = manifest.agg(F.max("batch")).first()[0]
    rows = [] if last is None else manifest.filter(F.col("batch") == last).collect()
    return {r["bucket"]: r["holder"] for r in rows if r["bucket"] is not None}


def _held(spark: SparkSession, out: str, holders: dict[int, int]) -> DataFrame:
    """Rows of the given buckets."""
    if not holders:
        return spark.createDataFrame([], _ROW)
    paths = [f"{out}/chunks/batch={batch}/bucket={bucket}" for bucket, batch in sorted(holders.items())]
    return spark.read.schema(_ROW).parquet(*paths)


def upsert(batch: DataFrame, batch_id: int, out: str, options: Options, buckets: int) -> None:
    """Bring one batch of raw lines (``value``) into the table below ``out``."""
    spark = batch.sparkSession
    parsed = parse_chunks(batch).persist()
    try:
        valid = with_token_count(good_rows(parsed)).filter(length_ok(options)).select(*[c.split()[0] for c in _ROW.split(", ")])
        # Of a key that comes twice in a batch, the row with the greatest text counts: files of a batch have no order.
        place = F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.desc("chunk_text"), F.desc("embedding")))
        bucket = F.pmod(F.xxhash64(*_KEY), F.lit(buckets)).cast("int")
        fresh = valid.withColumn("place", place).filter("place = 1").drop("place").withColumn("bucket", bucket).persist()
        try:
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]
            holders = _holders(spark, out, batch_id)
            old = _held(spark, out, {b: holders[b] for b in touched if b in holders})
            kept = old.join(fresh.select(*_KEY), _KEY, "left_anti").withColumn("bucket", bucket)
            merged = kept.unionByName(fresh)
            merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out}/chunks/batch={batch_id}")
            before = old.select(*_KEY, chunk_key(F.col("chunk_text"), "").alias("replaced"))
            history = fresh.select(*_KEY, chunk_key(F.col("chunk_text"), "").alias("chunk_key")).join(before, _KEY, "left")
            history.write.mode("overwrite").parquet(f"{out}/history/batch={batch_id}")
        finally:
            fresh.unpersist()
        quarantine(parsed).write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
        live = holders | {b: batch_id for b in touched}
        listed = spark.createDataFrame(sorted(live.items()) or [(None, batch_id)], "bucket int, holder bigint")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{out}/manifest/batch={batch_id}")
    finally:
        parsed.unpersist()


def stream_upsert(
    spark: SparkSession, folder: str, out: str, checkpoint: str, options: Options, glob: str = "*.jsonl", buckets: int = 64
) -> StreamingQuery:
    """Read the files not seen yet into the table below ``out`` and stop; ``buckets`` stays the same over all runs."""
    lines = spark.readStream.schema("value string").option("pathGlobFilter", glob).text(folder)
    return (
        lines.writeStream.foreachBatch(lambda batch, number: upsert(batch, number, out, options, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_upserts(spark: SparkSession, out: str) -> DataFrame:
    """The table as it is now: every key once."""
    return _held(spark, out, _holders(spark, out))


def history(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, chunk_id, chunk_key, replaced, batch): every arrival of a key, and the digest of the text it replaced."""
    fields = "doc_id string, chunk_id string, chunk_key string, replaced string, batch bigint"
    return spark.read.schema(fields).parquet(f"{out}/history")
