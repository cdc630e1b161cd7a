"""SentencePiece encoding and decoding with the ``tokenizers`` library as the engine.

The model's protobuf is read field by field and rebuilt: the normaliser from its compiled
character map and white space rules, the blank marker, the pieces with their scores (unigram
scores as they are, BPE merges in the order of the scores), and byte fallback. Texts are encoded
in multithreaded batches; ``parity`` compares ids with the ``sentencepiece`` library.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain, repeat
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .batches import add_columns, lists

#: Model files above this size are refused; the model is the only thing that is broadcast.
MODEL_BYTES = 64 << 20
#: Bytes of rows worked on at once; the more, the fewer words are met again.
BATCH_BYTES = 6 << 20
#: Words a worker keeps at most; beyond that it starts anew.
KNOWN_WORDS = 800_000
#: Bytes of text handed to the encoder at once.
SLICE_BYTES = 1 << 18
MARK = "▁"
# Fixed values of the model format: field numbers and enum values of its protobuf.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, MARK_AS_SUFFIX = 3, 35, 24
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 0x7F) << shift
        at, shift = at + 1, shift + 7
        if byte < 0x80:
            return value, at


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: integers, or the bytes of anything else."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unexpected wire type {kind}")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True

    @classmethod
    def parse(cls, data: bytes) -> "Model":
        model = cls()
        for number, value in fields(data):
            if number == PIECE:
                parts = dict(fields(value))
                score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
                model.pieces.append((parts.get(1, b"").decode(), score, parts.get(3, NORMAL)))
            elif number == TRAINER:
                spec = dict(fields(value))
                model.kind = spec.get(MODEL_TYPE, UNIGRAM)
                model.byte_fallback = bool(spec.get(BYTE_FALLBACK, 0))
                if spec.get(MARK_AS_SUFFIX):
                    raise ValueError("models that mark blanks as suffixes are not supported")
            elif number == NORMALIZER:
                spec = dict(fields(value))
                model.charsmap = spec.get(CHARSMAP, b"")
                model.dummy_prefix = bool(spec.get(DUMMY_PREFIX, 1))
                model.remove_extra = bool(spec.get(REMOVE_EXTRA, 1))
                if not spec.get(ESCAPE, 1):
                    raise ValueError("models without the blank marker are not supported")
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if any(kind == USER_DEFINED for _, _, kind in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        return model

    @cached_property
    def splits_at_blanks(self) -> bool:
        """Whether no piece reaches over the start of a run of blanks, so words can be encoded one by one."""
        return not any(
            a != MARK and b == MARK for p, _, kind in self.pieces if kind == NORMAL for a, b in zip(p, p[1:])
        )

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that form a piece, best score first."""
        rank = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == NORMAL}
        found = []
        for piece, at in rank.items():
            pairs = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
            inside = [(rank[a], rank[b], a, b) for a, b in pairs if a in rank and b in rank]
            found += [(-self.pieces[at][1], at, *pair) for pair in sorted(inside)]
        return [pair[-2:] for pair in sorted(found)]


def rebuild(model: Model):
    """A ``tokenizers.Tokenizer`` that encodes and decodes as the model says."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        # Only normal pieces may be found in a text; byte pieces keep the names that fallback looks for.
        vocab = [(p if kind in (NORMAL, BYTE) else f"\ufffe{i}", s) for i, (p, s, kind) in enumerate(model.pieces)]
        core = models.Unigram(vocab, unk_id=unknown, byte_fallback=model.byte_fallback)
    else:
        core = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)},
            model.merges(),
            unk_token=None if unknown is None else model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            cache_capacity=0,  # words that come again are kept by the worker
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    splits = []
    if model.splits_at_blanks:
        splits.append(pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated"))
    if model.kind == UNIGRAM and model.byte_fallback:  # the name of a byte, written in a text, is no byte
        splits.append(pre_tokenizers.Split(Regex("<(?=0x[0-9A-F]{2}>)"), "isolated"))
    if splits:
        tokenizer.pre_tokenizer = pre_tokenizers.Sequence(splits)
    ends = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *ends]
    )
    return tokenizer


@lru_cache(maxsize=4)
def _model(data: bytes) -> Model:
    return Model.parse(data)


@lru_cache(maxsize=4)
def _tokenizer(data: bytes, threads: int):
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    return rebuild(_model(data))


@lru_cache(maxsize=4)
def _reference(data: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=data)


def share_model(df: DataFrame, path: str) -> Broadcast:
    """The model file, read once by the driver and sent to the executors."""
    with open(path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return df.sparkSession.sparkContext.broadcast(data)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part: list[str] = []
    size = 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


@lru_cache(maxsize=4)
def _piece_bytes(data: bytes) -> pa.Array:
    """What each id stands for in a decoded text."""
    shown = [
        bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() if kind == NORMAL else b""
        for p, _, kind in _model(data).pieces
    ]
    return pa.array(shown, pa.binary())


def _coded(texts: list[str], data: bytes, threads: int, parity: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the texts end to end, their counts, and whether the other library agrees (yes if not asked)."""
    tokenizer = _tokenizer(data, threads)
    flat, sizes, same = [np.zeros(0, np.int32)], [], []
    for part in _slices(texts):
        coded = [e.ids for e in tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        sizes += map(len, coded)
        flat.append(np.fromiter(chain.from_iterable(coded), np.int32))
        same += map(eq, coded, _reference(data).encode(part, num_threads=threads)) if parity else repeat(True, len(part))
    return np.concatenate(flat), np.array(sizes, np.int64), np.array(same, bool)


class _Words:
    """Ids of the words a worker has met, end to end, and whether the other library agrees on them."""

    def __init__(self, data: bytes, threads: int, parity: bool):
        self.settings = (data, threads, parity)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.counts, self.same = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)

    def find(self, words: list[str]) -> np.ndarray:
        """Places of the words; those not met before are encoded."""
        if len(self.place) + len(words) > KNOWN_WORDS:
            self.clear()
        known = self.place.get
        places = np.array([known(w, -1) for w in words], np.int64)
        new = [words[i] for i in np.flatnonzero(places < 0)]
        if new:
            more = _coded(new, *self.settings)
            places[places < 0] = np.arange(len(self.place), len(self.place) + len(new))
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.ids, self.counts, self.same = map(np.concatenate, zip((self.ids, self.counts, self.same), more))
        return places


@lru_cache(maxsize=4)
def _words(data: bytes, threads: int, parity: bool) -> _Words:
    return _Words(data, threads, parity)


def _by_word(texts: pa.Array, data: bytes, threads: int, parity: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_coded`, for texts with single blanks between words: a word is encoded once."""
    split = pc.split_pattern(texts, " ")
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    distinct = split.flatten().dictionary_encode()
    words = _words(data, threads, parity)
    used = words.find(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()]
    lengths = words.counts[used]
    stops = np.cumsum(lengths)
    starts = (np.cumsum(words.counts) - words.counts)[used]
    flat = words.ids[np.repeat(starts - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)]
    totals = np.concatenate(([0], stops))
    wrong = np.concatenate(([0], np.cumsum(~words.same[used])))
    return flat, totals[ends[1:]] - totals[ends[:-1]], wrong[ends[1:]] == wrong[ends[:-1]]


def _agrees(ids: pa.Array, texts: pa.Array, data: bytes, threads: int) -> np.ndarray:
    """Whether the other library gives these ids for the whole texts; ids are compared end to end."""
    starts, values = ids.offsets.to_numpy().astype(np.int64), ids.values.to_numpy()
    same, at = [np.zeros(0, bool)], 0
    for part in _slices(texts.to_pylist()):
        wanted = _reference(data).encode(part, num_threads=threads, return_type="numpy")
        sizes = np.fromiter(map(len, wanted), np.int64, len(part))
        flat = np.concatenate(wanted)
        own = starts[at : at + len(part) + 1]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        if np.array_equal(np.diff(own), sizes):
            wrong = np.concatenate(([0], np.cumsum(flat != values[own[0] : own[-1]])))
            same.append(wrong[ends[1:]] == wrong[ends[:-1]])
        else:
            rows = zip(own[:-1], own[1:], ends[:-1], ends[1:])
            same.append(np.array([np.array_equal(values[i:j], flat[k:n]) for i, j, k, n in rows], bool))
        at += len(part)
    return np.concatenate(same)


def _encoded(column: pa.Array, data: bytes, threads: int, parity: bool) -> tuple[pa.Array, pa.Array]:
    texts, model = pc.fill_null(column, ""), _model(data)
    if model.splits_at_blanks and model.dummy_prefix and not model.charsmap:
        odd = pc.match_substring_regex(texts, rf"  |\A | \z|{MARK}").to_numpy(zero_copy_only=False)
    else:
        odd = np.ones(len(texts), bool)
    parts = [
        _by_word(texts.filter(pa.array(~odd)), data, threads, False),
        _coded(texts.filter(pa.array(odd)).to_pylist(), data, threads, parity),
    ]
    place = np.empty(len(texts), np.int64)
    place[np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))] = np.arange(len(texts))
    ids = pa.concat_arrays([lists(flat, sizes, pa.int32()) for flat, sizes, _ in parts]).take(pa.array(place))
    null = column.is_null()
    agreed = np.concatenate([p[2] for p in parts])[place]
    if parity:  # words put together are compared as whole texts
        agreed[~odd] = _agrees(ids.filter(pa.array(~odd)), texts.filter(pa.array(~odd)), data, threads)
    same = pa.array(agreed)
    return pc.if_else(null, pa.scalar(None, ids.type), ids), pc.if_else(null, None, same)


def _decoded(column: pa.Array, data: bytes, threads: int) -> pa.Array:
    """The pieces laid end to end and cut at the rows.

    Ids whose bytes are no valid UTF-8 go through the library's decoder, which replaces what it cannot read.
    """
    offsets = column.offsets.to_numpy()
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    joined = pc.take(_piece_bytes(data), values)
    starts = np.frombuffer(joined.buffers()[1], np.int32) if len(joined) else np.zeros(1, np.int32)
    ends = starts[offsets - offsets[0]]
    rows = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends.tobytes()), joined.buffers()[2]])
    try:
        texts = rows.cast(pa.string())
        if _model(data).dummy_prefix:
            texts = pc.replace_substring_regex(texts, r"\A ", "")
    except pa.ArrowInvalid:
        ids = [row or [] for row in column.to_pylist()]
        texts = pa.array(_tokenizer(data, threads).decode_batch(ids, skip_special_tokens=False), pa.string())
    return pc.if_else(column.is_null(), None, texts)


def encode(docs: DataFrame, model: Broadcast, threads: int = 2, verify: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<int>), and with ``same_ids`` and ``round_trip`` if ``verify``.

    A null text has null ``ids``, an empty one none. Special pieces in a text are ordinary text.
    ``same_ids``: the ``sentencepiece`` library gives the same ids; ``round_trip``: decoding gives
    the text again. Both are null for a null text. Input columns of these names are replaced,
    others kept; repeated rows are encoded each.
    """

    def compute(batch: pa.RecordBatch) -> list:
        column = batch.column("text")
        ids, same = _encoded(column, model.value, threads, verify)
        if not verify:
            return [ids]
        back = pc.equal(_decoded(ids, model.value, threads), column)
        return [ids, same, back]

    fields = "ids array<int>" + (", same_ids boolean, round_trip boolean" if verify else "")
    return add_columns(docs, fields, compute, BATCH_BYTES)


def decode(coded: DataFrame, model: Broadcast, threads: int = 2) -> DataFrame:
    """``coded`` with ``decoded``, the text of ``ids``; null for null, empty for no ids."""

    def compute(batch: pa.RecordBatch) -> list:
        return [_decoded(batch.column("ids"), model.value, threads)]

    return add_columns(coded, "decoded string", compute)
