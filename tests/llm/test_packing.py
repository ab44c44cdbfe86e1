import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagetrove.llm import packing, word_ids


def whole(texts):
    library = Tokenizer.from_file(word_ids.VOCABULARY)
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, found, capacity=2048):
    pieces = []
    for (i, _), ids in zip(rows, whole([t for _, t in rows])):
        ids = np.array([*ids, 0], "<u4")
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            pieces.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(pieces, key=str) == sorted(
        [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found], key=str)
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(p[3] for p in pieces)


def test_words_have_the_ids_of_whole_texts():
    texts = ["", "a\x0bb\x0cc\td\r\ne", "It's we're I'll x'd", "a\x1cb \x1c \x1c\x1c c", "e\u0301 \u0301x \u00a0y\u2003z",
             "1234 12ab !!?? a.b,c", "\u03a3\u03a3 \u03a3", "x<|endoftext|>y <|startoftext|>", "\u4e2d\u6587 \U0001f600!",
             "long" * 3000, "A a \u0130 \ufb01"]
    random.seed(1)
    texts += ["".join(random.choice("aB'1! \n\x1c\u00e9\u0301<|>") for _ in range(80)) for _ in range(200)]
    found = word_ids.WordIds(word_ids.VOCABULARY).encode([t.encode() for t in texts])
    for text, data, ids in zip(texts, found, whole(texts)):
        assert np.frombuffer(data, "<u4").tolist() == ids, text


def test_store_is_emptied(monkeypatch):
    monkeypatch.setattr(word_ids, "KEPT", 5)
    encoder = word_ids.WordIds(word_ids.VOCABULARY)
    for _ in range(3):
        made = encoder.encode([b"one two three four five six seven"])
        assert np.frombuffer(made[0], "<u4").tolist() == whole(["one two three four five six seven"])[0]


@pytest.mark.parametrize("most_open", [1, 4, 64])
def test_best_fit(most_open):
    random.seed(2)
    sizes = [random.randint(1, 100) for _ in range(3000)]
    fit, bins = packing.BestFit(100, most_open), []
    for n, size in enumerate(sizes):
        closed = fit.add(n, size)
        if closed:
            bins.append(closed)
        assert fit.count <= most_open
    bins += fit.rest()
    assert sorted(n for b in bins for n, _ in b) == list(range(3000))
    for held in bins:
        at = 0
        for n, offset in held:
            assert offset == at
            at += sizes[n]
        assert at <= 100
    if most_open == 64:
        assert len(bins) < 1.06 * sum(sizes) / 100


def test_awkward_rows_and_the_test_table(spark):
    rows = [(1, None), (2, ""), (2, "a b"), (2, "a b"), (None, "x y z"), (3, "word " * 9000), (4, "a " * 2047)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows],
                                 "doc_id long, text string, piece int, length string")
    check(rows, packing.pack(docs).collect())
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bins, total = check([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs).collect())
    assert bins <= 1.03 * total / 2048 + 1


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="wrong"):
        word_ids.WordIds(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("kept", [300_000, 3])
def test_word_ids_are_the_librarys(monkeypatch, kept):
    """Odd characters, white space of all kinds, marks and special tokens among plain words; a tiny store."""
    monkeypatch.setattr(word_ids, "KEPT", kept)
    monkeypatch.setattr(word_ids, "TOGETHER", 3)
    texts = ["", "  ", "Don't I'LL we've 'tis x's", "É é ﬁ ÅÄ İx ß ẞ Å", "a\x1cb \x1c \x00", "12'3 <|endoftext|> x<|startoftext|>y <|z",
             "©®\xad ª²³µºÿÞþ×÷", "\xa0x　y \x85a", "’s 's “q”", "東京 ١٢ Ⅷ ½ 😀", "a\tb\nc\x0bd\x0ce\rf", "#*$%&|<> ###", "é" * 300]
    texts += [" ".join(texts)] * 2
    encoder = word_ids.WordIds(word_ids.VOCABULARY)
    wanted = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert encoder.encode([t.encode() for t in texts]) == wanted
    assert encoder.encode([]) == [] and encoder.encode([b"", b" "]) == [b"", b""]
