"""Bundles with several golden chunks of one document, for queries that compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import sample_hash
from ..options import Options
from ..session import settle
from .bundles import with_distractors
from .sampling import sample_exact, top_k

#: Chunks of a document that are put into order together; a longer document is split by hash.
_ROWS_AT_ONCE = 10_000


def golden_sets(chunks: DataFrame, options: Options) -> DataFrame:
    """(bundle_id, ord): sampled sets of ``golden_chunks`` chunks, each of one document.

    The chunks of a document are laid out in hash order and cut; what is left over goes to its last set, so
    sets hold up to 2 * golden_chunks - 1, and fewer than golden_chunks only where a document does.
    ``bundle_id`` is the first chunk of a set. The sample is one of sets, with an exact size.
    """
    size = options.golden_chunks
    hashed = chunks.select("doc_id", "ord", sample_hash(options.seed, F.col("ord")).alias("hash"))
    rows = hashed.groupBy("doc_id").agg(F.ceil(F.count("*") / _ROWS_AT_ONCE).alias("parts"))
    parted = hashed.join(rows, "doc_id").withColumn("part", F.pmod(F.xxhash64("ord"), F.col("parts")))
    part = Window.partitionBy("doc_id", "part")
    number = F.row_number().over(part.orderBy("hash", "ord")) - 1
    placed = parted.select("doc_id", "part", "ord", number.alias("place"), F.count("*").over(part).alias("n"))
    last = F.greatest(F.floor(F.col("n") / size), F.lit(1)) - 1
    sets = placed.withColumn("number", F.least(F.floor(F.col("place") / size), last))
    first = F.first("ord").over(Window.partitionBy("doc_id", "part", "number").orderBy("place"))
    sets = settle(sets.select(first.alias("bundle_id"), "ord"))
    chosen = sample_exact(sets.filter("ord = bundle_id"), "bundle_id", options.seed, options=options)
    return sets.join(settle(chosen.select("bundle_id")), "bundle_id", "left_semi")


def set_neighbors(
    sets: DataFrame, golden: DataFrame, pool: DataFrame, k: int, options: Options, search: Callable[..., DataFrame]
) -> DataFrame:
    """(golden_ord, ord, sim, rank): per set the k rows outside it that are most similar to any of its members.

    A row among the best k of a set is among the best k outside it of the member it is most similar to,
    so the lists that ``search`` finds for the single members, longer by the size of a set, hold it.
    """
    members = golden.join(sets.select("ord"), "ord", "left_semi")
    found = search(members, pool, k + 2 * options.golden_chunks - 2, options)
    owned = found.join(sets.withColumnRenamed("ord", "golden_ord"), "golden_ord")
    best = owned.join(sets, ["bundle_id", "ord"], "left_anti").groupBy("bundle_id", "ord").agg(F.max("sim").alias("sim"))
    ranked = top_k(best, ["bundle_id"], [F.desc("sim"), F.asc("ord")], k)
    return ranked.withColumnRenamed("bundle_id", "golden_ord")


def build_set_bundles(sets: DataFrame, neighbors: DataFrame, corpus: DataFrame) -> DataFrame:
    """(bundle_id, golden, distractors), golden chunks in the order of ``ord``; texts are fetched here."""
    texts = corpus.select("ord", "doc_id", "chunk_id", "chunk_text")
    listed = F.sort_array(F.collect_list(F.struct("ord", "doc_id", "chunk_id", "chunk_text")))  # a few chunks
    golden = sets.join(texts, "ord").groupBy("bundle_id").agg(listed.alias("golden"))
    plain = F.transform("golden", lambda g: F.struct(g["doc_id"].alias("doc_id"), g["chunk_id"].alias("chunk_id"), g["chunk_text"].alias("chunk_text")))
    return with_distractors(golden.withColumn("golden", plain), neighbors, texts)
