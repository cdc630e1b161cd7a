"""Texts cut into words that a tokenizer treats alike wherever they stand, and what is known of such words.

A word starts at a blank that follows a character other than white space, and takes the blank along;
a blank that ends a text stays with what is before it.
Byte-level patterns never reach over such a place, nor do pieces that hold the blank marker only at
their start; so the ids of a text are those of its words end to end.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .batches import flat_bytes

_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
#: Characters of words handed to a tokenizer as one text.
JOINED = 1 << 16


def _kinds() -> np.ndarray:
    """Of each byte: white space, a letter, or a mark that ends a run of letters wherever it stands (an apostrophe may not)."""
    kinds = np.zeros(256, np.uint8)
    kinds[[*range(9, 14), 32]] = BLANK
    kinds[[*range(65, 91), *range(97, 123)]] = LETTER
    kinds[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = MARK
    return kinds


BLANK, LETTER, MARK = 1, 2, 3
_KINDS = _kinds()


def cut(
    column: pa.Array, lead: str = "", fine: bool = False, whole: np.ndarray | None = None
) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words end to end, as a dictionary array, and where each row's words start, then the end.

    ``lead`` is put in front of every text. Null counts as an empty text; an empty text has no word.
    With ``fine``, words also end where the patterns of a byte-level tokenizer always do: before a
    mark or white space that follows a letter, and after a lone line end. Rows marked in ``whole`` are one word.
    """
    texts = pc.fill_null(column, "")
    if lead:
        texts = pc.binary_join_element_wise(pa.scalar(lead), texts, "")
    values, starts = flat_bytes(texts)
    first = np.zeros(len(values) + 1, bool)
    at = np.flatnonzero(values == 32)
    at = at[at > 0]
    before = values[at - 1]
    first[at[(before > 32) | ((before < 9) | (before > 13)) & (before < 28)]] = True
    far = at[before >= 128]  # not after white space beyond ASCII: U+0085, U+00A0, and (roughly) U+1680, U+2000 to U+205F, U+3000
    one, two, three = values[far - 1], values[np.maximum(far - 2, 0)], values[np.maximum(far - 3, 0)]
    blank = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    blank |= (three >= 0xE1) & (three <= 0xE3) & ((two == 0x80) | (two == 0x81) | (two == 0x9A))
    first[far[blank]] = False
    first[starts[1:] - 1] = False
    if fine:
        first[1:-1] |= _fine(values)
    for row in np.flatnonzero(whole) if whole is not None else ():
        first[starts[row] : starts[row + 1]] = False
    first[starts] = True
    first[-1] = False
    begins = np.flatnonzero(first)
    offsets = np.append(begins, len(values)).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.string(), len(begins), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())]
    )
    return words.dictionary_encode(), np.searchsorted(begins, starts)


def _fine(values: np.ndarray) -> np.ndarray:
    """Whether a word may start at each byte but the first."""
    kinds = _KINDS[values]
    letter = kinds == LETTER
    # the two-byte letters of Latin and Cyrillic: U+00C0 to U+00FF without two signs, U+0400 to U+047F
    second, head = values[1:], values[:-1]
    letter[1:] |= (head == 0xC3) & (second >= 0x80) & (second != 0x97) & (second != 0xB7)
    letter[1:] |= ((head == 0xD0) | (head == 0xD1)) & (second >= 0x80)
    out = letter[:-1] & ((kinds[1:] == MARK) | (kinds[1:] == BLANK))
    out |= (kinds[:-1] == MARK) & (kinds[1:] == BLANK)
    lone = values[:-1] == 10
    lone[1:] &= letter[:-2] | (kinds[:-2] == MARK)
    if len(lone):
        lone[0] = False
    return out | lone & (kinds[1:] == LETTER)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The integers of all ranges, end to end."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the stretches between ``starts``, the last of which is the end."""
    total = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    return total[starts[1:]] - total[starts[:-1]]


class Known:
    """What ``compute`` says of each word met so far.

    ``compute`` gets new words and returns, for each of its outputs, the values of all words end to
    end and how many each word has. Words get places in the order in which they are met.
    """

    def __init__(self, compute: Callable[[list[str]], list[tuple[np.ndarray, np.ndarray]]]):
        self.compute = compute
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.parts: list[list[tuple[np.ndarray, np.ndarray]]] = []
        self.joined: list[tuple[np.ndarray, np.ndarray]] = []

    def __len__(self) -> int:
        return len(self.place)

    def find(self, words: pa.DictionaryArray) -> np.ndarray:
        """Places of the words; those not met before are worked out."""
        names = words.dictionary.to_pylist()
        known = np.fromiter((self.place.get(w, -1) for w in names), np.int64, len(names))
        new = [names[i] for i in np.flatnonzero(known < 0)]
        if new:
            known[known < 0] = np.arange(len(self.place), len(self.place) + len(new))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            more = self.compute(new)
            self.joined = [
                (np.concatenate((v, w)), np.concatenate((n, m))) for (v, n), (w, m) in zip(self.joined, more)
            ] or more
        return known[words.indices.to_numpy()]

    def counts(self, output: int) -> np.ndarray:
        return self.joined[output][1] if self.joined else np.zeros(0, np.int64)

    def values(self, output: int) -> np.ndarray:
        return self.joined[output][0] if self.joined else np.zeros(0, np.int64)

    def take(self, output: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the words at ``places`` end to end, and their counts."""
        counts = self.counts(output)
        used = counts[places]
        starts = (np.cumsum(counts) - counts)[places]
        return self.values(output)[ranges(starts, used)], used


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary of a byte-level tokenizer."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokens:
    """A byte-level tokenizer and the bytes of its ids."""

    def __init__(self, data: bytes, special: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.encode_special_tokens = not special
        letters = _byte_letters()
        self.special = special
        added = {t["id"]: t["content"].encode() for t in json.loads(data)["added_tokens"]}
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.added = [text.decode() for text in added.values()]
        shown = {i: added[i] if i in added else bytes(letters[c] for c in name) for name, i in names.items()}
        self.bytes = pa.array([shown.get(i, b"") for i in range(max(shown) + 1)], pa.binary())
        self.lengths = pc.binary_length(self.bytes).to_numpy().astype(np.int64)

    def stays_whole(self, column: pa.Array) -> np.ndarray | None:
        """Rows that hold the name of a special token, if such names stand for their tokens: they are not to be cut."""
        if not self.special or not self.added:
            return None
        texts = pc.fill_null(column, "")
        return np.any([pc.match_substring(texts, name).to_numpy(zero_copy_only=False) for name in self.added], axis=0)

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words end to end, and their counts.

        Words that may follow one another in a text are encoded as one, and cut by the bytes of the
        tokens; a call for each costs several times as much.
        """
        groups: list[list[int]] = [[], [], []]  # after a blank; with a letter first, after a line end; alone
        for i, word in enumerate(words):
            joins = not word[-1].isspace()
            groups[0 if joins and word[0] == " " else 1 if joins and word[0] in _LETTERS else 2].append(i)
        texts, items = [], []
        for numbers, between in zip(groups, ([], [-1], None)):
            for part in _parts(words, numbers) if between is not None else ([i] for i in numbers):
                row = [x for i in part for x in (*(between or ()), i)]
                texts.append("".join(words[i] if i >= 0 else "\n" for i in row))
                items += row
        order = np.array(items, np.int64)
        flat = self._flat(texts)
        sizes = np.fromiter((len(words[i].encode()) if i >= 0 else 1 for i in items), np.int64, len(items))
        ends = np.searchsorted(np.cumsum(self.lengths[flat]), np.cumsum(sizes), "right")
        counts = np.diff(ends, prepend=0)
        back = np.empty(len(words), np.int64)
        own = np.flatnonzero(order >= 0)
        back[order[own]] = own
        return flat[ranges((ends - counts)[back], counts[back])], counts[back]

    def _flat(self, texts: list[str]) -> np.ndarray:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(chain.from_iterable(e.ids for e in coded), np.int32)


def _parts(words: list[str], numbers: list[int]) -> Iterator[list[int]]:
    part: list[int] = []
    size = 0
    for i in numbers:
        part.append(i)
        size += len(words[i])
        if size >= JOINED:
            yield part
            part, size = [], 0
    if part:
        yield part


@lru_cache(maxsize=4)
def byte_tokens(data: bytes, special: bool) -> ByteTokens:
    """The tokenizer of a ``tokenizers`` file; with ``special``, the names of special tokens in a text stand for them."""
    return ByteTokens(data, special)
