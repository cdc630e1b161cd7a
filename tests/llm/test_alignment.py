import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from chunkwright.llm import alignment, words
from chunkwright.llm.alignment import align, gallop, link_scores
from chunkwright.llm.queries import BYTE_MODEL, MODEL
from chunkwright.llm.sentencepiece import share_model

SAMPLES = [
    None, "", " ", "  two  blanks and three   here ", "a \n b\n\n c\t\td \n", "Tokenisation isn't naïve, it's über-schön.",
    "x▁ 1", "<|endoftext|> <s> </s> <unk> <0x41> is plain", "日本語 のテキスト 😀😀 ok", "no break and   wide　blank",
    "\x00\x01 zero", "12345 67,890.12 $%&&& ***", "same same same", "Привет, мир! Как дела?", "é" * 50, "word " * 30 + "end",
    "a\x1c b\x1f c", "caf\u0085 x", "ﬁne ligature Å Å", "trailing newline\n",
]


def plain(texts):
    """Per text, straight from the libraries: (a ids, b ids, groups, links)."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(BYTE_MODEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    letters = words._byte_letters()
    shown_a = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    out = []
    for text in texts:
        if not text:
            out.append(([], [], [], []))
            continue
        want = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [shown_a[i] for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out.append(([], [], [], []))
            continue
        spans = []
        for parts in (bytes_a, bytes_b):
            ends = np.cumsum([len(p) for p in parts]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        both = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        sides = [list(zip(ids, sp)) for ids, sp in zip((ids_a, ids_b), spans)]
        groups, at = [], [0, 0]
        for end in sorted(both):
            group = []
            for which, side in enumerate(sides):
                start = at[which]
                while at[which] < len(side) and side[at[which]][1][1] <= end:
                    at[which] += 1
                group.append([i for i, _ in side[start : at[which]]])
            groups.append(tuple(group))
        links, first = [], 0
        for i, (s, e) in sides[0]:
            while sides[1][first][1][1] <= s:
                first += 1
            k = first
            while k < len(sides[1]) and sides[1][k][1][0] < e:
                links.append((i, sides[1][k][0]))
                k += 1
        out.append((ids_a, ids_b, groups, links))
    return out


def figures(texts):
    found = plain(texts)
    count = Counter(p for f in found for p in set(f[3]))
    best = {}
    for (i, _), n in count.items():
        best[i] = max(best.get(i, 0), n)
    for a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        yield (
            len(a), len(b), len(groups), len(links), digest,
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
        )


@pytest.fixture(scope="module")
def models(spark):
    docs = spark.range(1)
    return share_model(docs, BYTE_MODEL), share_model(docs, MODEL)


def many(seed, count):
    rng = random.Random(seed)
    letters = "aaeeiioouunnrrsstT  \n\n\t..,-'’é▁日0 1Ж" + " " * 6
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 120))) for _ in range(count)]


def test_tokens_groups_and_links(spark, models):
    texts = SAMPLES + many(1, 300)
    docs = spark.createDataFrame([(i, t, [5]) for i, t in enumerate(texts)], "doc_id int, text string, A_ids array<int>")
    got = {r.doc_id: r for r in align(docs.repartition(3), *models).collect()}
    for i, (a, b, groups, links) in enumerate(plain(texts)):
        r = got[i]
        assert (r.a_ids, r.b_ids, [tuple(x) for x in r.links]) == (a, b, links), texts[i]
        cuts = list(zip([0, *r.a_ends], r.a_ends, [0, *r.b_ends], r.b_ends))
        assert [(a[s:e], b[u:v]) for s, e, u, v in cuts] == groups


@pytest.mark.parametrize("block", [300_000, 40])
def test_figures_against_brute_force(spark, models, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_WORDS", block)
    monkeypatch.setattr(alignment, "small", lambda batches: (b.slice(i, 7) for b in batches for i in range(0, b.num_rows, 7)))
    texts = SAMPLES * 2 + many(2, 200)
    docs = spark.createDataFrame(
        [(i, t, 1, "b", 7) for i, t in enumerate(texts)], "doc_id int, text string, block int, n_best string, at int"
    )
    out = link_scores(docs.repartition(4), *models)
    assert out.columns == ["doc_id", "block", "at", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    got = {r.doc_id: tuple(r)[3:] for r in out.collect()}
    assert got == dict(enumerate(figures(texts)))


def test_odd_rows(spark, models, odd, empty):
    rows = odd.collect()
    got = link_scores(odd.repartition(5), *models).select("doc_id", "n_chars", *alignment.FIGURES, "groups_sha256", "n_best", "count_sum")
    want = figures([r.text for r in rows])
    assert sorted(map(str, got.collect())) == sorted(
        str(_row(got.columns, (r.doc_id, r.n_chars, *w))) for r, w in zip(rows, want)
    )
    assert link_scores(empty, *models).count() == 0


def _row(names, values):
    from pyspark.sql import Row

    return Row(*names)(*values)


def test_gallop_is_a_lower_bound():
    rng = np.random.default_rng(1)
    longer = np.sort(rng.integers(0, 500, 200))
    first, last = np.full(100, 20), np.full(100, 180)
    short = rng.integers(-5, 510, 100)
    assert (gallop(short, longer, first, last) == 20 + np.searchsorted(longer[20:180], short)).all()


@pytest.mark.parametrize("fine", [False, True])
def test_ids_of_words_are_those_of_texts(fine):
    from tokenizers import Tokenizer

    with open(BYTE_MODEL, "rb") as file:
        tokens = words.byte_tokens(file.read(), special=True)
    marks = [".\x1c a", "don't. I'll", "a.\n\nB", "x\nY\n Z", "\nA\n", "é.\né", "×. ÷\n", "Ж.\nж", "a'\nb", "1.\nA", "…\nA", "a. <|endoftext|>.\nB"]
    texts = [t for t in SAMPLES + marks + many(5, 3000) if t]
    known = words.Known(lambda new: [tokens.ids(new)])
    found, starts = words.cut(pa.array(texts), fine=fine, whole=tokens.stays_whole(pa.array(texts)))
    ids, counts = known.take(0, known.find(found))
    ends = np.cumsum(words.sums(counts, starts))
    plain = Tokenizer.from_file(BYTE_MODEL)
    for text, start, end in zip(texts, [0, *ends], ends):
        assert ids[start:end].tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("fine", [False, True])
def test_cut_puts_words_back_together(fine):
    texts = pa.array(SAMPLES)
    found, starts = words.cut(texts, fine=fine)
    parts = found.to_pylist()
    assert ["".join(parts[i:j]) for i, j in zip(starts[:-1], starts[1:])] == [t or "" for t in SAMPLES]
    assert "" not in parts
