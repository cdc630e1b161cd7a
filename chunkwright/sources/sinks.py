"""JSON-lines writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_ground_truth(rows: DataFrame, path: str) -> None:
    """One accepted query per line; null fields are written."""
    _write(rows, path)


def rejected_rows(rejected: DataFrame) -> DataFrame:
    return rejected.select(
        "doc_id",
        "chunk_id",
        "chunk_text",
        F.coalesce("reject_reason", F.lit("Unknown")).alias("reject_reason"),
    )


def write_rejected(rejected: DataFrame, path: str | None) -> bool:
    """Audit file of rejected chunks; nothing is written without a path or rows."""
    if not path or rejected.isEmpty():
        return False
    _write(rejected_rows(rejected), path)
    return True
