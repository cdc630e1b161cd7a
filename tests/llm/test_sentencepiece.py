import struct

import pytest
import sentencepiece
from chunkwright.llm import sentencepiece as own

from chunkwright.llm.queries import MODEL


def message(*parts):
    out = b""
    for number, value in parts:
        if isinstance(value, bytes):
            out += bytes([number << 3 | 2]) + varint(len(value)) + value
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        else:
            out += varint(number << 3) + varint(value)
    return out


def varint(value):
    out = b""
    while value > 0x7F:
        out, value = out + bytes([value & 0x7F | 0x80]), value >> 7
    return out + bytes([value])


@pytest.fixture(scope="module")
def unigram():
    """A model of a few pieces with byte fallback, written field by field."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    words = ["▁", "▁the", "▁th", "e", "t", "h", "he", "▁cat", "ca", "c", "a", "s", "at", "▁▁", "ts"]
    pieces += [(w, -1.0 - 0.37 * k - 0.011 * k * k, 1) for k, w in enumerate(words)]
    body = [(1, message((1, p.encode()), (2, s), (3, kind))) for p, s, kind in pieces]
    trainer = message((3, 1), (35, 1))
    normalizer = message((3, 1), (4, 0), (5, 1))
    return message(*body, (2, trainer), (3, normalizer))


TEXTS = ["the cats", "", " ", "  the  cat ", "that hat é 日本 😀\n\tthe", "▁the", "<s> the </s> <0x41>", "chat tea"]


@pytest.mark.parametrize("kind", ["unigram", "bpe"])
def test_parity_and_round_trip(kind, unigram):
    data = unigram if kind == "unigram" else open(MODEL, "rb").read()
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids, same = own._encoded(own.pa.array([*TEXTS, None]), data, 1, True)
    assert ids.to_pylist() == [*reference.encode(TEXTS), None]
    assert same.to_pylist() == [True] * len(TEXTS) + [None]
    back = own._decoded(ids, data, 1).to_pylist()
    assert back == [*(t.replace("▁", " ") for t in TEXTS), None]


def test_bytes_that_are_no_text():
    data = open(MODEL, "rb").read()
    ids = own.pa.array([[3 + 0xC3], [3 + 0xC3, 3 + 0xA9]], own.pa.list_(own.pa.int32()))
    assert own._decoded(ids, data, 1).to_pylist()[1] == "é"


def test_odd_rows(spark, odd, empty):
    model = own.share_model(odd, MODEL)
    out = own.encode(odd.withColumnRenamed("lang", "IDS"), model, verify=True)
    assert "IDS" not in out.columns and out.count() == odd.count()
    for row in own.decode(out, model).collect():
        assert row.decoded == row.text
        assert (row.ids is None) == (row.text is None)
        assert row.same_ids == row.round_trip == (None if row.text is None else True)
    assert own.encode(empty, model).count() == 0


def test_models_that_are_refused():
    piece = message((1, b"x"), (3, 4))
    with pytest.raises(ValueError):
        own.Model.parse(message((1, piece)))
    with pytest.raises(ValueError):
        own.Model.parse(message((2, message((3, 3)))))


def test_whole_texts_are_compared(monkeypatch):
    data = open(MODEL, "rb").read()
    reference = sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["x▁ 1", "plain words", "", "one"]
    ids, same = own._encoded(own.pa.array([*texts, None]), data, 1, True)
    assert ids.to_pylist() == [*reference.encode(texts), None]
    assert same.to_pylist() == [True] * 4 + [None]
    split = own._by_word

    def faulty(*args):
        flat, sizes, agreed = split(*args)
        return flat[::-1].copy(), sizes, agreed

    monkeypatch.setattr(own, "_by_word", faulty)
    assert not all(own._encoded(own.pa.array(texts[1:]), data, 1, True)[1].to_pylist())


def test_other_ids_do_not_agree():
    import numpy as np
    import pyarrow as pa

    from chunkwright.llm import sentencepiece as sp
    from chunkwright.llm.queries import MODEL

    with open(MODEL, "rb") as file:
        data = file.read()
    texts = pa.array(["one two", "", "three four five", "six"])
    ids = [sp._reference(data).encode(t) for t in texts.to_pylist()]
    assert sp._agrees(pa.array(ids, pa.list_(pa.int32())), texts, data, 1).tolist() == [True] * 4
    other = [ids[0][::-1], ids[1], ids[2], ids[3]]  # as many, but not the same
    assert sp._agrees(pa.array(other, pa.list_(pa.int32())), texts, data, 1).tolist() == [False, True, True, True]
    longer = [ids[0], [5], ids[2], ids[3] + [7]]
    assert sp._agrees(pa.array(longer, pa.list_(pa.int32())), texts, data, 1).tolist() == [True, False, True, False]
    part = pa.array([[9], *ids], pa.list_(pa.int32())).slice(1)
    assert np.all(sp._agrees(part, texts, data, 1))


def test_pieces_are_searched_for_blanks_once():
    looked = []

    class Pieces(list):
        def __iter__(self):
            looked.append(1)
            return super().__iter__()

    model = own.Model(Pieces([("ab", 0.0, own.NORMAL)]))
    assert model.splits_at_blanks and model.splits_at_blanks and len(looked) == 1
