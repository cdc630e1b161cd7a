"""BM25 of a query over its own few documents, inside one row.

Every query brings its corpus along (golden text and distractors), so scoring
needs no shuffle at all: the whole computation is array expressions on the row,
built as SQL text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, tokens

# BM25 Okapi with k1 1.5 and b 0.75; a negative inverse document
# frequency is replaced by a quarter of the mean over all terms.
_K1, _B, _NEGATIVE_SHARE = 1.5, 0.75, 0.25

# ``s`` is the struct of token sets; element n of ``more`` tells how many distinct
# terms are found in more than n documents.
_LAYERS = (
    "aggregate(s.doc_terms, array_repeat(cast(array() AS array<string>), size(s.docs)), "
    "(layers, terms) -> transform(layers, (layer, n) -> array_union(layer, "
    "IF(n = 0, terms, array_intersect(get(layers, n - 1), terms)))))"
)


def _idf(holding: str) -> str:
    return f"(ln(size(s.docs) - {holding} + 0.5D) - ln({holding} + 0.5D))"


def _okapi_scores() -> str:
    """One score per document; query tokens count as often as they are repeated."""
    idf_sum = (
        f"aggregate(transform(more, (c, n) -> (c - coalesce(get(more, n + 1), 0)) * {_idf('(n + 1)')}), "
        "0D, (acc, x) -> acc + x)"
    )
    negative = let(
        "more",
        f"transform({_LAYERS}, layer -> size(layer))",
        f"IF(more[0] > 0, {_NEGATIVE_SHARE}D * {idf_sum} / more[0], 0D)",
    )
    found = "transform(s.asked, w -> named_struct('w', w, 'n', size(filter(s.doc_terms, d -> array_contains(d, w)))))"
    weights = let(
        "negative",
        negative,
        f"transform(filter({found}, f -> f.n > 0), f -> "
        f"named_struct('w', f.w, 'idf', IF({_idf('f.n')} < 0, negative, {_idf('f.n')})))",
    )
    average = "aggregate(s.docs, 0, (acc, d) -> acc + size(d)) / size(s.docs)"
    tf = "(size(doc) - size(array_remove(doc, t.w)))"
    norm = f"{_K1}D * ({1 - _B}D + {_B}D * size(doc) / b.average)"
    counted = f"transform(b.weights, t -> named_struct('idf', t.idf, 'tf', {tf}))"
    score = f"aggregate({counted}, 0D, (acc, c) -> acc + c.idf * c.tf * {_K1 + 1}D / (c.tf + {norm}))"
    return let(
        "b",
        f"named_struct('weights', {weights}, 'average', {average})",
        f"transform(s.docs, doc -> {score})",
    )


_OVERLAP_SCORES = (
    "transform(s.doc_terms, terms -> cast(size(array_intersect(s.asked_terms, terms)) AS double))"
)
SCORERS = {"bm25": _okapi_scores(), "overlap": _OVERLAP_SCORES}


def _figures() -> str:
    """STRUCT of the scores ``f`` and what the gate looks at."""

    def share(terms: str) -> str:
        return f"size(array_intersect(s.asked_terms, {terms})) / greatest(size(s.asked_terms), 1)"

    best_terms = "get(s.doc_terms, cast(array_position(g.others, g.best) AS int))"
    return let(
        "g",
        "named_struct('others', slice(f, 2, size(f)), "
        "'best', coalesce(array_max(slice(f, 2, size(f))), 0D))",
        "named_struct('scores', f, 'golden_score', f[0], 'best_distractor_score', g.best, "
        "'golden_rank', 1 + size(filter(g.others, x -> x > f[0])), 'margin', f[0] - g.best, "
        f"'golden_coverage', {share('s.doc_terms[0]')}, "
        f"'best_distractor_coverage', IF(size(g.others) > 0, {share(best_terms)}, 0D))",
    )


def query_figures(
    query: str, golden_texts: str, distractor_texts: str, scorer: str, stop_words: Sequence[str] = ()
) -> Column:
    """Scores (golden document first), rank, margin and coverages of a query as one struct."""
    texts = f"concat(array(array_join({golden_texts}, '\\n')), {distractor_texts})"
    split = (
        f"named_struct('docs', transform({texts}, t -> {tokens('t', stop_words)}), "
        f"'asked', {tokens(query, stop_words)})"
    )
    sets = (
        "named_struct('docs', split.docs, 'asked', split.asked, "
        "'doc_terms', transform(split.docs, d -> array_distinct(d)), "
        "'asked_terms', array_distinct(split.asked))"
    )
    return F.expr(let("split", split, let("s", sets, let("f", SCORERS[scorer], _figures()))))
