"""Files arriving in a folder, parsed once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..options import Options
from ..operators.validation import length_ok, with_token_count
from ..sources.chunks import good_rows, parse_chunks, quarantine


def stream_ingest(
    spark: SparkSession, folder: str, out: str, checkpoint: str, options: Options, glob: str = "*.jsonl"
) -> StreamingQuery:
    """Read the files not seen yet and stop.

    Each batch writes its own folder and overwrites it when retried, so a batch
    that is run twice leaves one copy. Rewritten files are not read again; use
    ``incremental_load`` for those, and ``upsert.stream_upsert`` where keys come again.
    """
    lines = (
        spark.readStream.schema("value string").option("pathGlobFilter", glob).text(folder)
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_chunks(batch).persist()
        try:
            chunks = with_token_count(good_rows(parsed)).filter(length_ok(options)).drop("n_tokens")
            chunks.write.mode("overwrite").parquet(f"{out}/chunks/batch={batch_id}")
            quarantine(parsed).write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
        finally:
            parsed.unpersist()

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
