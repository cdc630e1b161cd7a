"""Quality rules: figures of each text, and lines that too many documents of a host share.

Lines are normalised (outer blanks off, lower case) and hashed. A line is frequent in a host when
more distinct documents of the host hold it than both limits allow; documents with equal text
count as one, so copies alone never make a line frequent. Frequent lines are removed, and a
document that has too little left is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import add_columns, as_bytes

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class LineLimits:
    """``max_docs`` and ``max_share`` (of the host's distinct documents): a frequent line is above both.

    ``min_words``: words that must be left; ``min_left``: share of the words that must be left.
    """

    max_docs: int = 20
    max_share: float = 0.01
    min_words: int = 20
    min_left: float = 0.5


def text_figures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (bigint) of ``text``.

    Words are runs without ASCII white space. Null and empty texts have zeros.
    """

    def compute(batch: pa.RecordBatch) -> list:
        rows = [_figures(text) for text in as_bytes(batch.column("text"))]
        return [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return add_columns(docs, ", ".join(f"{n} bigint" for n in names), compute)


def _figures(text: bytes | None) -> tuple[int, ...]:
    if not text:
        return (0, 0, 0, 0, 0)
    words = text.split()
    solid = b"".join(words)
    chars = len(solid) if solid.isascii() else len(solid.decode())
    symbols = len(solid) - len(solid.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words))


def _repeated(words: list[bytes]) -> int:
    """Words inside windows that occur twice or more."""
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    if len(known) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    windows = np.zeros(n, np.uint64)
    for k in range(REPEAT_WINDOW):
        windows *= np.uint64(0xD6E8FEB86659FD93)
        windows += mixed[k : k + n]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, np.flatnonzero(again), 1)
    np.add.at(steps, np.flatnonzero(again) + REPEAT_WINDOW, -1)
    return int((np.cumsum(steps)[:-1] > 0).sum())


def _key(value: Column, name: str) -> list[Column]:
    """128 bits that stand for a string, as two columns."""
    return [F.xxhash64(value).alias(f"{name}_a"), F.xxhash64(F.lit(1), value).alias(f"{name}_b")]


_WORDS = "size(filter(split(line, '[ \\\\t-\\\\r]+'), w -> w != ''))"
TEXT, LINE = ["text_a", "text_b"], ["line_a", "line_b"]


def removed_lines(docs: DataFrame, host: str, limits: LineLimits) -> DataFrame:
    """Per host and distinct text with frequent lines: their positions from 0, and the words in them.

    The text is given as its 128-bit key (``text_a``, ``text_b``). Written down, so that joins with
    it can split the copies of one text.
    """
    lines = (
        docs.filter(F.col("text").isNotNull())
        .select(F.col(host).alias("host"), *_key(F.col("text"), "text"), F.posexplode(F.split("text", "\n")))
        .withColumnRenamed("col", "line")
        .withColumn("line_words", F.expr(_WORDS).cast("bigint"))
        .filter("line_words > 0")
        .select("host", *TEXT, "pos", "line_words", *_key(F.lower(F.trim("line")), "line"))
    )
    holders = lines.select("host", *LINE, *TEXT).distinct().groupBy("host", *LINE).agg(F.count("*").alias("n"))
    sizes = lines.select("host", *TEXT).distinct().groupBy("host").agg(F.count("*").alias("docs"))
    frequent = settle(
        holders.filter(F.col("n") > limits.max_docs)
        .join(sizes, holders["host"].eqNullSafe(sizes["host"]))
        .filter(F.col("n") > limits.max_share * F.col("docs"))
        .select(holders["host"].alias("in_host"), F.col("line_a").alias("a"), F.col("line_b").alias("b"))
    )
    hit = lines.join(
        frequent,
        F.col("host").eqNullSafe(F.col("in_host")) & (F.col("line_a") == F.col("a")) & (F.col("line_b") == F.col("b")),
    )
    return settle(
        hit.select("host", *TEXT, "pos", "line_words")
        .distinct()
        .groupBy("host", *TEXT)
        .agg(F.array_sort(F.collect_list("pos")).alias("gone_lines"), F.sum("line_words").alias("gone_words"))
    )


def apply_line_rules(docs: DataFrame, host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """``docs`` with the figures, ``gone_lines``, ``n_left`` (words left) and ``depleted``.

    ``host`` may be null; such documents form a host of their own. Null and empty texts have no
    lines, nothing is taken from them, and they are depleted, as are texts that are short from the
    start. Repeated rows stay. Input columns named like the new ones are replaced, others kept.
    """
    gone = removed_lines(docs, host, limits).withColumnRenamed("host", "in_host")
    figures = text_figures(docs.drop("gone_lines", "n_left", "depleted", "gone_words"))
    keyed = figures.select("*", *_key(F.col("text"), "text"))
    joined = keyed.join(
        gone.withColumnsRenamed({"text_a": "a", "text_b": "b"}),
        F.col(host).eqNullSafe(F.col("in_host")) & (F.col("text_a") == F.col("a")) & (F.col("text_b") == F.col("b")),
        "left",
    )
    left = F.col("n_words") - F.coalesce("gone_words", F.lit(0))
    return joined.select(
        *figures.columns,
        F.coalesce("gone_lines", F.array().cast("array<int>")).alias("gone_lines"),
        left.alias("n_left"),
        ((left < limits.min_words) | (left < limits.min_left * F.col("n_words"))).alias("depleted"),
    )


def without_lines(docs: DataFrame) -> DataFrame:
    """Result of :func:`apply_line_rules` with the frequent lines cut from ``text``."""
    rest = "array_join(filter(split(text, '\\n'), (x, i) -> NOT array_contains(gone_lines, i)), '\\n')"
    return docs.withColumn("text", F.when(F.size("gone_lines") > 0, F.expr(rest)).otherwise(F.col("text")))
