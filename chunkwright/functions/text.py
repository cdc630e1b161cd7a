"""Text expressions. All of them stay in the JVM and look at one row only.

They are kept as SQL text: one call builds a whole expression, and expressions
nest by plain substitution. Arguments named ``text`` or ``words`` are SQL too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The splitting rules and stop words the results depend on.
WHITESPACE_TOKEN = r"(?U)[^\s\x1c-\x1f]+"
WORD = r"[\p{L}\p{N}_]+"
ASCII_TOKEN = r"[a-zA-Z0-9]+"
KEY_TERM_STOP_WORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by",
    "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "do", "does",
    "did", "will", "would", "could", "should",
)


def let(name: str, value: str, use: str) -> str:
    """``use`` with ``name`` standing for ``value``, which is computed once.

    A column named inside a lambda may be inlined there by the optimizer and
    then computed per element; a bound lambda variable is not.
    """
    return f"transform(array({value}), {name} -> {use})[0]"


def _array(words: Sequence[str]) -> str:
    quoted = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)
    return f"array({quoted})"


def whitespace_token_count(text: str) -> Column:
    return F.expr(f"regexp_count({text}, r'{WHITESPACE_TOKEN}')")


def tokens(text: str, stop_words: Sequence[str] = ()) -> str:
    """Lower-cased ASCII letter and digit runs, in order, repeats kept."""
    found = f"regexp_extract_all(lower(coalesce({text}, '')), r'{ASCII_TOKEN}', 0)"
    if not stop_words:
        return found
    return f"filter({found}, tok -> NOT array_contains({_array(stop_words)}, tok))"


def letter_words(text: str) -> str:
    """Lower-cased whole words made of ASCII letters only (``v1`` is no such word)."""
    found = f"regexp_extract_all(lower(coalesce({text}, '')), r'{WORD}', 0)"
    return f"filter({found}, word -> word RLIKE '^[a-z]+$')"


def key_words(text: str) -> str:
    """``letter_words`` of three letters or more that are no stop words."""
    stop = _array(KEY_TERM_STOP_WORDS)
    return f"filter({letter_words(text)}, word -> length(word) > 2 AND NOT array_contains({stop}, word))"


def term_counts(words: str) -> str:
    """ARRAY<STRUCT<n, pos, term>>, one element per distinct word.

    Sort-based run lengths inside the row, so a long text costs n log n and no
    word leaves its row. ``pos`` is the place of the first appearance.
    """
    ordered = f"sort_array(transform({words}, (w, i) -> named_struct('term', w, 'pos', i)))"
    starts = "filter(transform(run, (w, i) -> IF(w.term <=> get(run, i - 1).term, -1, i)), i -> i >= 0)"
    counted = (
        "transform(begin, (b, i) -> named_struct('n', coalesce(get(begin, i + 1), size(run)) - b, "
        "'pos', get(run, b).pos, 'term', get(run, b).term))"
    )
    return let("run", ordered, let("begin", starts, counted))


def top_terms(counts: str, max_terms: int) -> str:
    """The most frequent terms, first seen wins a tie, space-joined."""
    ranked = f"sort_array(transform({counts}, c -> named_struct('neg', -c.n, 'pos', c.pos, 'term', c.term)))"
    return f"array_join(slice({ranked}, 1, {max_terms}).term, ' ')"


def key_terms(text: str, max_terms: int = 5) -> str:
    return top_terms(term_counts(key_words(text)), max_terms)


def distinctive_terms(own: str, foreign: str, max_terms: int) -> str:
    """``key_terms`` of one text without the words of another."""
    parts = (
        f"named_struct('words', {key_words(own)}, "
        f"'only', array_except({key_words(own)}, {letter_words(foreign)}))"
    )
    kept = f"filter({term_counts('p.words')}, c -> array_contains(p.only, c.term))"
    return let("p", parts, top_terms(kept, max_terms))
