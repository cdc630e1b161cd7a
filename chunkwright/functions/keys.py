"""Hash keys. Variable-length parts carry a length prefix, lists a count."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(value: Column) -> Column:
    return F.concat(F.length(value).cast("string"), F.lit(":"), value)


def request_key(
    golden_texts: Column,
    distractor_texts: Column,
    query_type: Column,
    temperature: float,
    answer_tokens: int,
    config_hash: str,
) -> Column:
    """First 16 hex digits of SHA-256 over everything that shapes an answer.

    Distractors are sorted first, so their order does not matter.
    """
    golden = _part(F.array_join(golden_texts, " "))
    distractors = F.array_join(F.transform(F.array_sort(distractor_texts), _part), "")
    return F.substring(
        F.sha2(
            F.concat(
                golden,
                F.size(distractor_texts).cast("string"),
                F.lit("|"),
                distractors,
                _part(query_type),
                F.lit(f"{temperature}|{answer_tokens}|{config_hash}"),
            ),
            256,
        ),
        1,
        16,
    )


def chunk_key(text: Column, config_hash: str) -> Column:
    return F.substring(F.sha2(F.concat(text, F.lit(f"|{config_hash}")), 256), 1, 16)


def sample_hash(seed: int, key: Column) -> Column:
    """Hex MD5 of ``seed:key``: a fixed random order of the rows, whatever the partitions."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_share(seed: int, key: Column) -> Column:
    """The leading 32 bits of ``sample_hash`` as a number in [0, 1)."""
    bits = F.conv(F.substring(sample_hash(seed, key), 1, 8), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(4294967296.0)
