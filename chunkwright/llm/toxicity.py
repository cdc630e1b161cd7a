"""Toxicity by non-negative positive-unlabelled learning.

A linear numpy model over hashed words is trained from confirmed toxic examples and unlabelled
text. With ``prior`` the share of toxic text among the unlabelled, the risk of calling clean text
toxic is taken from the unlabelled rows, corrected by what the toxic ones among them add, and never
allowed below zero: where a step would push it there, the step goes the other way.

Only the fit sees a sample, of bounded size and drawn by hash over all rows; every text is scored.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import add_columns, as_bytes
from .decontaminate import words_of

BITS = 18


@dataclass(frozen=True)
class PuSettings:
    """``max_positive`` and ``max_unlabelled`` bound the rows the fit sees."""

    max_positive: int = 8_000
    max_unlabelled: int = 16_000
    min_deviation: float = 5.0  # of a word's rows among toxic ones from what unlabelled rows let expect
    steps: int = 600
    rate: float = 0.05
    decay: float = 1e-4
    limit: float = 0.7  # the score from which on a text counts as toxic


@dataclass
class PuModel:
    weights: np.ndarray
    bias: float

    def score(self, text: bytes | None) -> float:
        """Probability of toxic text; the share that ``bias`` stands for where there is no word."""
        return float(_sigmoid(self.bias + self.weights[features(text)].sum()))


def features(text: bytes | None) -> np.ndarray:
    """Hashed distinct words of a text, sorted."""
    return np.array(sorted({crc32(w) & ((1 << BITS) - 1) for w in set(words_of(text))}), np.int64)


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class _Rows:
    """Sparse binary rows: the column numbers of all rows end to end."""

    def __init__(self, rows: list[np.ndarray]):
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.columns = np.concatenate([np.zeros(0, np.int64), *rows])
        self.ends = np.concatenate(([0], np.cumsum(self.lengths)))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        totals = np.concatenate(([0.0], np.cumsum(weights[self.columns])))
        return totals[self.ends[1:]] - totals[self.ends[:-1]]

    def add(self, per_row: np.ndarray, size: int) -> np.ndarray:
        """Gradient by column of a gradient by row."""
        return np.bincount(self.columns, np.repeat(per_row, self.lengths), size)


def _telling(positive: list, unlabelled: list, size: int, least: float) -> np.ndarray:
    """Words that toxic rows have much more or less often than unlabelled ones; a row repeated counts once."""
    counts, rows = [], []
    for part in (positive, unlabelled):
        distinct = {r.tobytes(): r for r in part}.values()
        counts.append(np.bincount(np.concatenate([np.zeros(0, np.int64), *distinct]), minlength=size))
        rows.append(max(len(distinct), 1))
    share = (counts[1] + 1) / (rows[1] + 2)
    expected = rows[0] * share
    return np.abs(counts[0] - expected) >= least * np.sqrt(expected * (1 - share) + 0.5)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, settings: PuSettings) -> PuModel:
    """Non-negative risk with the bounded sigmoid loss, by Adam over all rows of the sample at once."""
    size = 1 << BITS
    used = _telling(positive, unlabelled, size, settings.min_deviation)
    place = np.cumsum(used) - 1
    pos, unl = (_Rows([place[r[used[r]]] for r in rows]) for rows in (positive, unlabelled))
    size, full = int(used.sum()), np.zeros(size)
    weights, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    if not len(pos.lengths) or not len(unl.lengths):
        return PuModel(full, bias)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    n_u, n_p = len(unl.lengths), len(pos.lengths)
    for step in range(1, settings.steps + 1):
        out_u, out_p = unl.dot(weights) + bias, pos.dot(weights) + bias
        risk_u, risk_p = _sigmoid(out_u), _sigmoid(out_p)
        # Risk of calling clean text toxic: that of the unlabelled rows less the toxic share among them.
        negative = risk_u.mean() - prior * risk_p.mean()
        grad_u, grad_p = risk_u * (1 - risk_u) / n_u, -prior * risk_p * (1 - risk_p) / n_p
        if negative < 0:
            grad_u, grad_p = -grad_u, -grad_p
        else:
            grad_p *= 2  # the risk of missing a toxic row adds as much again
        grad = np.append(unl.add(grad_u, size) + pos.add(grad_p, size), grad_u.sum() + grad_p.sum())
        grad[:-1] += settings.decay * weights
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        pace = settings.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        change = pace * first / (np.sqrt(second) + 1e-10)
        weights, bias = weights - change[:-1], bias - change[-1]
    full[used] = weights
    cut = _cut(pos.dot(weights) + bias, unl.dot(weights) + bias, prior)
    return PuModel(full, bias - cut + float(np.log(settings.limit / (1 - settings.limit))))


def _cut(out_p: np.ndarray, out_u: np.ndarray, prior: float) -> float:
    """Output above which a row counts as toxic: least corrected risk, counting each wrong row as one."""
    values = np.unique(np.concatenate((out_p, out_u)))
    values = np.append(values, values[-1] + 2)  # nothing is toxic
    missed = np.searchsorted(np.sort(out_p), values) / len(out_p)
    called = 1 - np.searchsorted(np.sort(out_u), values) / len(out_u)
    risk = prior * missed + np.maximum(0, called - prior * (1 - missed))
    best = len(values) - 1 - int(np.argmin(risk[::-1]))  # of equal ones the cut that calls fewer rows toxic
    return float((values[best] + values[max(best - 1, 0)]) / 2) if best else float(values[0]) - 1.0


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """Distinct ids of ``rows``, about ``most`` of them, chosen by hash and never more than ``most``."""
    ids = rows.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    count = ids.count()
    if count > most:
        ids = ids.filter(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)) < int(0.95 * most / count * (1 << 20)))
    return ids.limit(most)


def fit(
    docs: DataFrame, toxic: DataFrame, prior: float, learn: DataFrame | None = None, settings: PuSettings = PuSettings()
) -> PuModel:
    """Model from the documents whose ``doc_id`` is in ``toxic`` and from ``learn`` as unlabelled text.

    ``learn`` is by default all of ``docs``. Null ids are never sampled; repeated ids are one in the
    sample, each row of theirs is used. Without a toxic or an unlabelled row the score is ``prior``.
    """
    ids = _sampled(toxic, settings.max_positive).select("doc_id", F.lit(True).alias("is_toxic"))
    others = _sampled(docs if learn is None else learn, settings.max_unlabelled)
    # Both lists are bounded by the settings, so the texts stay where they are.
    chosen = ids.unionByName(others.select("doc_id", F.lit(False).alias("is_toxic")))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "is_toxic")

    def compute(batch: pa.RecordBatch) -> list:
        return [pa.array([features(t) for t in as_bytes(batch.column("text"))], pa.list_(pa.int32()))]

    found = add_columns(rows, "columns array<int>", compute).select("is_toxic", "columns").toArrow()
    marks = found.column("is_toxic").to_pylist()
    lists = [np.asarray(c, np.int64) for c in found.column("columns").to_numpy(zero_copy_only=False)]
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    return train([c for c, m in zip(lists, marks) if m], [c for c, m in zip(lists, marks) if not m], prior, settings)


def score(docs: DataFrame, model: PuModel) -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1, higher: likelier toxic); null texts count as empty ones.

    A column ``score`` of the input is replaced, others are kept, repeated rows get the same score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list:
        model = shared.value
        return [pa.array([model.score(t) for t in as_bytes(batch.column("text"))], pa.float64())]

    return add_columns(docs, "score double", compute)


def fit_from_labels(docs: DataFrame, labels: DataFrame, settings: PuSettings = PuSettings()) -> PuModel:
    """Fit on ``labels`` (doc_id, toxic) without the held-out third of the ids.

    The prior is the share of toxic rows among all labels that may be learnt from. A document with
    several labels is toxic if one of them says so; null labels and ids are ignored.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    learn = docs.select("doc_id").filter(~held_out())
    return fit(docs, known.filter("toxic = 1"), prior, learn, settings)


def held_out(column: str = "doc_id"):
    """Whether a row belongs to the third that nothing is learnt from; null ids do not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))
