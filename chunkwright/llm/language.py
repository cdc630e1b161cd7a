"""Language identification by sparse multinomial logistic regression on character n-grams.

Texts become TF-IDF vectors of hashed n-grams of letters (other characters are blanks). Document
frequencies count every row that may be learnt from; the weights are fitted on a bounded sample per
language, drawn by hash, with follow-the-regularised-leader updates and an elastic net, and the
temperature of the probabilities on a part of that sample which the weights have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import add_columns, bound_batches, lists, small

BITS = 15
ORDERS = 3
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """``max_rows`` bounds the rows of each language in the fit; ``max_languages`` the classes."""

    max_rows: int = 1_000
    max_languages: int = 256
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3


@dataclass
class LanguageModel:
    names: list[str]
    idf: np.ndarray
    weights: np.ndarray  # n-grams x languages, zero for most n-grams
    bias: np.ndarray
    temperature: float = 1.0

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ngrams(text)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        places, counts = counted(grams)
        out = weighted(counts, self.idf[places]) @ self.weights[places] + self.bias
        shares = softmax(out / self.temperature)
        best = int(np.argmax(shares))
        return self.names[best], float(shares[best])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """Hashed n-grams of 1 to ``ORDERS`` characters that hold a letter, in a blank-bounded text; empty without letters."""
    if not text:
        return np.zeros(0, np.int64)
    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[chars]
    if not letter.any():
        return np.zeros(0, np.int64)
    kept = letter | np.concatenate(([True], letter[:-1]))  # one blank for a run of other characters
    chars = np.where(letter, chars, np.uint32(32))[kept]
    letter = letter[kept]
    found = []
    code, some = np.zeros(len(chars), np.uint32), np.zeros(len(chars), bool)
    for order in range(ORDERS):
        n = len(chars) - order
        if n <= 0:
            break
        code = (code[:n] + chars[order:]) * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        some = some[:n] | letter[order:]
        found.append((code[some] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))
    return np.concatenate(found).astype(np.int64)


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(grams, minlength=1 << BITS)
    places = np.flatnonzero(counts)
    return places, counts[places]


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with damped counts and unit length."""
    values = (1 + np.log(counts)) * idf
    return values / max(np.sqrt((values * values).sum()), 1e-12)


def softmax(out: np.ndarray) -> np.ndarray:
    shares = np.exp(out - out.max(axis=-1, keepdims=True))
    return shares / shares.sum(axis=-1, keepdims=True)


class Leader:
    """Weights of follow-the-regularised-leader: sums of gradients, shrunk by the elastic net when read."""

    def __init__(self, classes: int, settings: LanguageSettings):
        self.settings = settings
        self.sums, self.squares = (np.zeros(((1 << BITS) + 1, classes)) for _ in range(2))

    def weights(self, places) -> np.ndarray:
        s, sums = self.settings, self.sums[places]
        pull = (s.beta + np.sqrt(self.squares[places])) / s.alpha + s.l2
        return -np.sign(sums) * np.maximum(np.abs(sums) - s.l1, 0) / pull

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        places, values = np.append(places, 1 << BITS), np.append(values, 1.0)  # the last place is the bias
        weights = self.weights(places)
        error = softmax(values @ weights)
        error[label] -= 1
        grad = values[:, None] * error
        before = self.squares[places]
        after = before + grad * grad
        self.sums[places] += grad - (np.sqrt(after) - np.sqrt(before)) / self.settings.alpha * weights
        self.squares[places] = after


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Rows each hashed n-gram occurs in, over all of ``docs``, and the rows with letters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in small(batches):
            for text in batch.column("text").to_pylist():
                grams = ngrams(text)
                found[counted(grams)[0]] += 1
                rows += len(grams) > 0
        found = np.append(found, rows)
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(found[places])], names=["place", "n"])

    bound_batches(docs.sparkSession)
    totals = docs.select("text").mapInArrow(count, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros((1 << BITS) + 1, np.int64)
    found = totals.toArrow()
    out[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return out[:-1], int(out[-1])


def _sample(rows: DataFrame, settings: LanguageSettings) -> DataFrame:
    """About ``max_rows`` rows of each language, chosen by hash."""
    sizes = rows.groupBy("lang").count().orderBy("lang").limit(settings.max_languages + 1).collect()
    if len(sizes) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages")
    share: Column = F.lit(0.0)
    for name, n in sizes:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, settings.max_rows / n))).otherwise(share)
    draw = F.pmod(F.xxhash64(F.lit(5), "doc_id", "text"), F.lit(1 << 20)) / F.lit(1 << 20)
    return rows.filter(draw < share).withColumn("check", F.pmod(F.xxhash64(F.lit(6), "doc_id", "text"), F.lit(5)) == 0)


def fit(docs: DataFrame, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Model of the languages named in ``docs`` (doc_id, text, lang); rows without one are not learnt from.

    Without any labelled row the model knows no language and answers ``und``.
    """
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    seen, total = document_frequency(rows)
    idf = np.log((1 + total) / (1 + seen)) + 1

    def compute(batch: pa.RecordBatch) -> list:
        pairs = [counted(ngrams(t)) for t in batch.column("text").to_pylist()]
        sizes = np.array([len(p) for p, _ in pairs], np.int64)
        flat = [np.concatenate([np.zeros(0, np.int64), *(p[k] for p in pairs)]) for k in range(2)]
        return [lists(values, sizes, pa.int32()) for values in flat]

    found = add_columns(_sample(rows, settings), "places array<int>, counts array<int>", compute)
    table = found.select("lang", "check", "places", "counts").toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    labels = [names.index(n) for n in table.column("lang").to_pylist()]
    places, counts = (table.column(c).to_numpy() for c in ("places", "counts"))
    leader = Leader(len(names), settings)
    check = np.array(table.column("check").to_pylist(), bool)
    vectors = [weighted(c, idf[p]) if len(p) else np.zeros(0) for p, c in zip(places, counts)]
    order = np.random.default_rng(1).permutation(np.flatnonzero(~check))
    for _ in range(settings.epochs):
        for k in order:
            leader.learn(places[k], vectors[k], labels[k])
    weights = leader.weights(slice(None))
    model = LanguageModel(names, idf, weights[:-1].astype(np.float32), weights[-1])
    held = np.flatnonzero(check)
    if len(held):
        outs = np.array([vectors[k] @ model.weights[places[k]] + model.bias for k in held])
        model.temperature = _temperature(outs, np.array(labels)[held])
    return model


def _temperature(outs: np.ndarray, labels: np.ndarray) -> float:
    """The one of a row of temperatures with the least log loss."""
    tried = np.geomspace(0.05, 20, 121)
    losses = [-np.log(softmax(outs / t)[np.arange(len(labels)), labels] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(losses))])


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (probability of that language, 0 for ``und``).

    Null texts and texts without a letter are ``und``. Input columns of these names are replaced,
    others kept; repeated rows get the same answer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list:
        model = shared.value
        found = [model.predict(t) for t in batch.column("text").to_pylist()]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return add_columns(docs, "lang_pred string, score double", compute)
