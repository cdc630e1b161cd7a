"""Near duplicates by order MinHash, verified by banded alignment.

Words are lower-cased runs of letters and digits; a k-mer is ``kmer`` of them in a row, labelled
with how often it has occurred before in the text. A sketch takes the k-mers with the smallest
hashes and keeps them in text order, so two texts share it when they hold the same k-mers in the
same order. Texts that share a sketch are candidates.

A candidate is verified by aligning the labelled k-mers of both texts in order, inside the band of
shifts that the required similarity leaves. Similarity is matched k-mers over all k-mers of both.

Texts with the same words are one node from the start. In a small bucket every pair is a candidate.
In a large one all nodes meet its most shared node first, which settles a crowd of near copies in linear work;
then it is cut into blocks of nodes, and inside a block an index of its k-mers finds what can be
alike to a node that is not in the block's main part, and alignment stops as soon as two parts are connected. What lies in
different blocks of one bucket meets by sketches of more k-mers, under which texts that are
merely similar fall apart; only nodes outside the main part of such a bucket are compared with its
blocks. The number of passes is fixed, whatever the data.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .batches import add_columns, lists, mixed, word_hashes

#: Nodes of a bucket up to which all pairs are candidates.
SMALL_BUCKET = 24
#: Nodes of a block, and bytes of their words (four each); larger buckets are cut into several.
BLOCK, BLOCK_BYTES = 1000, 4 << 20
#: Sketches and k-mers of each for nodes of buckets with several blocks; at similarity 0.8 all
#: of them are missed with a chance of one in a million, too.
FINE = (45, 6)
#: Holders of k-mers counted at once.
COUNTED = 1 << 22


@dataclass(frozen=True)
class OrderSettings:
    """At similarity 0.8 a pair misses all of 20 sketches of 3 k-mers with a chance below one in a million."""

    kmer: int = 5
    sketches: int = 20
    depth: int = 3
    similarity: float = 0.8


def kmers(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the k-mers labelled by occurrence; a shorter text is one k-mer, one without words none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mixed(out) + words[k : k + len(out)]
    out = mixed(out)
    order = np.argsort(out, kind="stable")
    run = out[order]
    first = np.concatenate(([True], run[1:] != run[:-1]))
    if first.all():
        return out
    at = np.arange(len(out))
    labels = np.empty(len(out), np.uint64)
    labels[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out + labels * np.uint64(0x9E3779B97F4A7C15)


def sketch(found: np.ndarray, settings: OrderSettings) -> np.ndarray:
    """One number per sketch, from the k-mers with the smallest hashes in text order."""
    factors = _factors(settings.sketches)
    values, rows = found[None, :] * factors[:, None], np.arange(settings.sketches)
    depth = min(settings.depth, len(found))
    places = np.empty((settings.sketches, depth), np.int64)
    for k in range(depth):
        places[:, k] = values.argmin(axis=1)
        values[rows, places[:, k]] = _MOST
    places.sort(axis=1)
    out = factors.copy()
    for k in range(places.shape[1]):
        out = mixed(out + found[places[:, k]])
    return out


_MOST = np.uint64((1 << 64) - 1)


def _factors(count: int) -> np.ndarray:
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Similarity of two texts' k-mers aligned in order, or 0 if it is below ``least``.

    With ``need`` matches required, no matched pair can lie further off the diagonal than the
    longer text has k-mers to spare; that is the band.
    """
    need = int(np.ceil(least / (1 + least) * (len(a) + len(b)) - 1e-9))
    if min(len(a), len(b)) < max(need, 1):
        return 0.0
    _, left, right = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = max(len(a), len(b)) - need
    inside = np.abs(left - right) <= band
    if inside.sum() < need:
        return 0.0
    left, right = left[inside], right[inside]
    ends: list[int] = []  # of the best alignments by their number of matches
    for at in right[np.argsort(left)].tolist():
        if not ends or at > ends[-1]:
            ends.append(at)
        else:
            ends[bisect_left(ends, at)] = at
    share = len(ends) / (len(a) + len(b) - len(ends))
    return share if share >= least - 1e-9 else 0.0


def _rows_with_sketches(docs: DataFrame, settings: OrderSettings) -> DataFrame:
    """(doc_id, node, sketches): the node stands for the sequence of words, null if there is none."""

    def compute(batch: pa.RecordBatch) -> list:
        (one, two), ends = word_hashes(batch.column("text"), 2, normal=True)
        keys = np.zeros((2, batch.num_rows), np.uint64)
        flat, sizes = [np.zeros(0, np.uint64)], np.zeros(batch.num_rows, np.int64)
        for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            if a == b:
                continue
            found = kmers(one[a:b], settings.kmer)
            flat.append(sketch(found, settings))
            sizes[k] = settings.sketches
            powers = _powers(b - a)
            keys[0, k], keys[1, k] = (one[a:b] * powers).sum(), (two[a:b] * powers).sum()
        return [
            pa.array(keys[0].view(np.int64), mask=sizes == 0),
            pa.array(keys[1].view(np.int64), mask=sizes == 0),
            lists(np.concatenate(flat).view(np.int64), sizes, pa.int64()),
        ]

    rows = add_columns(docs.select("doc_id", "text"), "a bigint, b bigint, sketches array<bigint>", compute)
    node = F.when(F.col("a").isNotNull(), F.struct("a", "b"))
    return rows.select("doc_id", node.alias("node"), "sketches")


def _powers(count: int) -> np.ndarray:
    return np.cumprod(np.full(count, 0xD6E8FEB86659FD93, np.uint64))


def _verified(pairs: DataFrame, texts: DataFrame, settings: OrderSettings) -> DataFrame:
    """(left, right): the pairs (node, other) that are alike."""
    left = texts.select("node", F.col("words").alias("node_words"))
    right = texts.select(F.col("node").alias("other"), F.col("words").alias("other_words"))
    both = pairs.join(left, "node").join(right, "other")

    def compute(batch: pa.RecordBatch) -> list:
        known: dict[bytes, np.ndarray] = {}  # of one batch, so bounded in bytes
        found = []
        for one, two in zip(*(batch.column(c).to_pylist() for c in ("node_words", "other_words"))):
            for words in (one, two):
                if words not in known:
                    known[words] = _kmers_of(words, settings)
            found.append(aligned(known[one], known[two], settings.similarity))
        return [pa.array(found, pa.float64())]

    found = add_columns(both, "similarity double", compute).filter("similarity > 0")
    return found.select(F.col("node").alias("left"), F.col("other").alias("right"))


def _kmers_of(words: bytes, settings: OrderSettings) -> np.ndarray:
    return kmers(mixed(np.frombuffer(words, np.uint32).astype(np.uint64)), settings.kmer)


def links_of_block(found: list[np.ndarray], parts: np.ndarray, left: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links (row, row) that connect whatever is alike among the rows of a block, one of the two in ``left``.

    ``found`` holds the k-mers of each row; rows of one part are connected already. A row that is
    like another holds at least ``least`` of its k-mers, so one of its rarest k-mers, too; the
    others need not be counted.
    """
    sizes = np.array([len(f) for f in found])
    _, codes = np.unique(np.concatenate(found), return_inverse=True)
    count = np.bincount(codes)
    holders = np.repeat(np.arange(len(found)), sizes)[np.argsort(codes, kind="stable")]
    starts, ends = np.cumsum(count) - count, np.cumsum(sizes)
    step = max(1, COUNTED // len(found))

    def held(wanted: np.ndarray) -> np.ndarray:
        """How many of the wanted k-mers each row holds."""
        out = np.zeros(len(found), np.int64)
        for first in range(0, len(wanted), step):
            some = wanted[first : first + step]
            lengths = count[some]
            at = np.arange(lengths.sum()) + np.repeat(starts[some] - np.cumsum(lengths) + lengths, lengths)
            out += np.bincount(holders[at], minlength=len(found))
        return out

    parts, links, rows = parts.copy(), [], np.arange(len(found))
    for a in np.flatnonzero(left):
        own = codes[ends[a] - sizes[a] : ends[a]]
        own = own[np.argsort(count[own], kind="stable")]
        open_ = (parts != parts[a]) & ~(left & (rows < a))
        open_ &= (sizes >= least * sizes[a] - 1e-6) & (sizes[a] >= least * sizes - 1e-6)
        if open_.any():
            open_ &= held(own[: int((1 - least) * len(own) + 1e-6) + 1]) > 0
        if not open_.any():
            continue
        open_ &= held(own) * (1 + least) >= least * (sizes + sizes[a]) - 1e-6
        for b in np.flatnonzero(open_):
            if parts[a] != parts[b] and aligned(found[a], found[b], least):
                links.append((a, b))
                parts[parts == parts[b]] = parts[a]
    return links


def _words_of_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, words) with the words as 32-bit hashes, taken from one document of each node."""

    def compute(batch: pa.RecordBatch) -> list:
        (hashes,), ends = word_hashes(batch.column("text"), 1, normal=True)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        return [pa.array([short[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())]

    wanted = nodes.select("doc_id", "node").filter(F.col("doc_id").isNotNull())
    found = docs.select("doc_id", "text").join(wanted, "doc_id")
    return settle(add_columns(found, "words binary", compute).select("node", "words").dropDuplicates(["node"]))


def find_links(docs: DataFrame, nodes: DataFrame, settings: OrderSettings) -> DataFrame:
    """Links (left, right) between nodes (node, doc_id, sketches) that keep all classes connected."""
    posts = nodes.select("node", F.explode("sketches").alias("bucket"))
    sizes = posts.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    listed = F.collect_list(F.struct("bucket", "size")).alias("posts")  # one for each sketch
    shared = posts.join(settle(sizes), "bucket").groupBy("node").agg(F.sum("size").alias("score"), listed)
    shared = settle(shared)
    texts = _words_of_nodes(docs, nodes.select("doc_id", "node").join(shared.select("node"), "node"))
    shared = settle(shared.join(texts.select("node", F.length("words").alias("bytes")), "node"))
    posts = shared.select("node", F.col("node").alias("label"), "score", F.inline("posts"))
    large = posts.filter(F.col("size") > SMALL_BUCKET).select("bucket", "node", "score")
    best = F.max(F.struct("score", "node")).getField("node").alias("other")
    centres = settle(large.groupBy("bucket").agg(best))
    stars = large.join(centres, "bucket").filter("node != other")
    stars = stars.select(F.least("node", "other").alias("node"), F.greatest("node", "other").alias("other"))
    links = settle(_verified(_small_pairs(posts).unionByName(stars).distinct(), texts, settings))
    if centres.isEmpty():
        return links
    # What is like the centre of a bucket is connected; blocks are compared for the rest.
    named = shared.join(connected(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    large = named.select("node", "label", "bytes", F.inline("posts")).filter(F.col("size") > SMALL_BUCKET).drop("size")
    large = settle(_cut(large))
    places = [F.col("block").alias("row"), F.col("block").alias("column")]
    inside = large.select("bucket", "node", "label", *places, (F.col("label") != F.col("main")).alias("wanted"))
    links = links.unionByName(settle(_links_of_blocks(inside, texts, settings).distinct()))
    again = settle(large.filter("blocks > 1").select("node").distinct())
    if again.isEmpty():
        return links
    return links.unionByName(_links_across(again, links, texts, settings))


def _links_across(nodes: DataFrame, links: DataFrame, texts: DataFrame, settings: OrderSettings) -> DataFrame:
    """Links (left, right) among ``nodes`` that ``links`` do not connect, by sketches of more k-mers."""
    fine = replace(settings, sketches=FINE[0], depth=FINE[1])

    def compute(batch: pa.RecordBatch) -> list:
        out = [sketch(_kmers_of(words, fine), fine) for words in batch.column("words").to_pylist()]
        sizes = np.full(len(out), fine.sketches, np.int64)
        return [lists(np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64), sizes, pa.int64())]

    sketched = add_columns(texts.join(nodes, "node"), "sketches array<bigint>", compute)
    sketched = sketched.select("node", F.length("words").alias("bytes"), "sketches")
    named = sketched.join(connected(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    posts = named.select("node", "label", "bytes", F.explode("sketches").alias("bucket"))
    posts = settle(_cut(posts))
    pairs = _small_pairs(posts).distinct()
    large = posts.filter(F.col("size") > SMALL_BUCKET)
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    wanted = large.filter("label != main").select(
        "bucket", "node", "label", F.col("block").alias("row"), all_blocks.alias("column"), F.lit(True).alias("wanted")
    )
    rows = settle(wanted.select("bucket", "row").distinct())
    others = large.join(rows, "bucket").select(
        "bucket", "node", "label", "row", F.col("block").alias("column"), F.lit(False).alias("wanted")
    )
    return settle(
        _verified(pairs, texts, settings).unionByName(_links_of_blocks(wanted.unionByName(others), texts, settings))
    )


def _small_pairs(posts: DataFrame) -> DataFrame:
    """(node, other) of the small buckets, each not yet connected to the other."""
    little = posts.filter(F.col("size") <= SMALL_BUCKET).select("bucket", "node", "label")
    others = little.withColumnsRenamed({"node": "other", "label": "other_label"})
    return little.join(others, "bucket").filter("node < other AND label != other_label").select("node", "other")


def _cut(posts: DataFrame) -> DataFrame:
    """(bucket, node, label, size, main, blocks, block) of the buckets with several labels, in blocks bounded in nodes and bytes.

    ``main`` is the label that most nodes of a bucket have: its main part, whose nodes are connected.
    """
    shares = posts.groupBy("bucket", "label").agg(F.count("*").alias("share"), F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.greatest(F.sum("share") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")
    main = F.max(F.struct("share", "label")).getField("label").alias("main")
    buckets = shares.groupBy("bucket").agg(F.sum("share").alias("size"), main, blocks, F.count("*").alias("labels"))
    buckets = settle(buckets.filter("labels > 1").drop("labels"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    return posts.join(buckets, "bucket").select("bucket", "node", "label", "size", "main", "blocks", block)


def _with_words(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``members`` with the words of their nodes, which are looked up once for all buckets of a node and row."""
    listed = F.collect_list(F.struct("bucket", "column", "wanted", "label")).alias("posts")
    found = members.groupBy("node", "row").agg(listed).join(texts, "node")
    return found.select("node", "row", "words", F.inline("posts"))


def _links_of_blocks(members: DataFrame, texts: DataFrame, settings: OrderSettings) -> DataFrame:
    """Links (left, right) inside each group (bucket, row, column) of members with a wanted one."""

    def compute(group: pd.DataFrame) -> pd.DataFrame:
        if not group["wanted"].any():
            return pd.DataFrame({name: np.zeros(0, np.int64) for name in "abcd"})
        group = group.sort_values("wanted", ascending=False, kind="stable").drop_duplicates(["a", "b"])
        found = [_kmers_of(words, settings) for words in group["words"]]
        parts = group.groupby(["label_a", "label_b"], sort=False).ngroup().to_numpy()
        links = links_of_block(found, parts, group["wanted"].to_numpy(bool), settings.similarity)
        names = group[["a", "b"]].to_numpy()
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pd.DataFrame(np.hstack((names[ends[:, 0]], names[ends[:, 1]])), columns=["a", "b", "c", "d"])

    flat = _with_words(members, texts).select(
        "bucket", "row", "column", "wanted", "words", "node.a", "node.b",
        F.col("label.a").alias("label_a"), F.col("label.b").alias("label_b"),
    )
    # A block's work does not follow its bytes, by which small partitions would be put together.
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flat = flat.repartition(parts, "bucket", "row", "column")
    found = flat.groupBy("bucket", "row", "column").applyInPandas(compute, "a bigint, b bigint, c bigint, d bigint")
    return found.select(
        F.struct("a", "b").alias("left"), F.struct(F.col("c").alias("a"), F.col("d").alias("b")).alias("right")
    )


def connected(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected part of ``links`` (left, right)."""
    edges = settle(
        links.select("left", "right")
        .unionByName(links.select(F.col("right").alias("left"), F.col("left").alias("right")))
        .distinct()
    )
    labels = settle(edges.groupBy("left").agg(F.least(F.min("right"), F.col("left")).alias("label")))
    labels = labels.select(F.col("left").alias("node"), "label")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "right"), "right")
        least = near.groupBy("left").agg(F.min("label").alias("near")).withColumnRenamed("left", "node")
        lower = settle(labels.join(least, "node").select("node", "label", F.least("label", "near").alias("low")))
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("next"))
        new = settle(lower.join(jump, "low", "left").select("node", F.coalesce("next", "low").alias("low"), "label"))
        labels = new.select("node", F.col("low").alias("label"))
        if new.filter("low != label").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, settings: OrderSettings = OrderSettings()) -> DataFrame:
    """(doc_id, class_id) for every row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the documents connected by links. Texts with the same
    words are in one class; texts without words, null or not, are classes of their own. Texts of
    fewer than ``kmer`` words are like none but those with the same words. Rows with equal ids are
    answered one by one; a class of null ids only has a null ``class_id``.
    """
    rows = settle(_rows_with_sketches(docs, settings))
    nodes = settle(
        rows.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("sketches").alias("sketches"))
    )
    labels = connected(find_links(docs, nodes, settings))
    named = nodes.select("node", "doc_id").join(labels, "node", "left")
    named = settle(named.select("node", "doc_id", F.coalesce("label", "node").alias("label")))
    classes = settle(named.groupBy("label").agg(F.min("doc_id").alias("class_id")))
    of_node = settle(named.join(classes, "label").select("node", "class_id"))
    found = rows.select("doc_id", "node").join(of_node, "node", "left")
    return found.select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def keep_one(docs: DataFrame, settings: OrderSettings = OrderSettings()) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest doc_id.

    Rows with a null id all stay, and so do all rows with the id that stays; ids are meant to be unique.
    """
    classes = near_duplicates(docs, settings)
    kept = classes.filter(F.col("doc_id") == F.col("class_id")).select("doc_id").distinct()
    known = docs.filter(F.col("doc_id").isNotNull())
    return known.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(
        docs.filter(F.col("doc_id").isNull())
    )
