import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetrove.operators import chunking as C
from pagetrove.operators.recursive_split import split_recursively


def naive_pieces(text, separator):
    if not separator:
        return list(text)
    first, *others = text.split(separator)
    return [p for p in [first] + [separator + o for o in others] if p]


def naive_pack(pieces, size, overlap):
    """Piece by piece: emit when the next one does not fit, then drop pieces from the front."""
    chunks, held = [], []
    for piece in pieces:
        if held and sum(map(len, held)) + len(piece) > size:
            chunks.append("".join(held))
            while held and (sum(map(len, held)) > overlap
                            or sum(map(len, held)) + len(piece) > size):
                held.pop(0)
        held.append(piece)
    if held:
        chunks.append("".join(held))
    return [c.strip() for c in chunks if c.strip()]


def naive_split(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    for level, separator in enumerate(separators):
        if separator in text:
            break
    chunks, small = [], []
    for piece in naive_pieces(text, separator):
        if len(piece) < size:
            small.append(piece)
            continue
        chunks += naive_pack(small, size, overlap)
        small = []
        finer = separators[level + 1:]
        chunks += naive_split(piece, size, overlap, finer) if finer else [piece]
    return chunks + naive_pack(small, size, overlap)


TEXTS = st.lists(st.sampled_from(["\n\n", "\n", " ", "a", "bcd", "efghij", "klmnopqrstuvwxyz0123"]),
                 max_size=60).map("".join)


@settings(max_examples=600, deadline=None)
@given(TEXTS, st.integers(1, 40), st.integers(0, 39))
def test_recursive_split_agrees_with_piecewise_packing(text, size, overlap):
    overlap = min(overlap, size - 1)
    assert split_recursively(text, size, overlap) == naive_split(text, size, overlap)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(2, 40), st.integers(0, 39))
def test_recursive_split_keeps_size_and_words(text, size, overlap):
    chunks = split_recursively(text, size, min(overlap, size - 1))
    assert all(0 < len(c) <= size for c in chunks)
    assert set("".join(chunks)) == set(text) - {" ", "\n"} or any(len(c) > 1 for c in chunks)


def test_recursive_split_paragraphs():
    text = "para one\n\npara two is longer\n\nx"
    assert split_recursively(text, 20, 5) == ["para one", "para two is longer", "x"]


def pages(spark, texts):
    rows = [("s", i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source string, page int, page_content string")


def chunk_lists(chunks, n):
    found = [[] for _ in range(n)]
    for row in chunks.sort("page", "chunk_idx").collect():
        assert row.chunk_idx == len(found[row.page])
        found[row.page].append(row.page_content)
    return found


def test_recursive_in_spark_with_empty_pages(spark):
    texts = [None, "", "  \n ", "word " * 30, "line one\nline two\n" * 9]
    got = chunk_lists(C.chunk(pages(spark, texts), 40, 10), len(texts))
    assert got == [split_recursively(t, 40, 10) if t else [] for t in texts]
    assert got[:3] == [[], [], []] and len(got[3]) > 1


def windows(words, size, overlap):
    return [" ".join(words[i:i + size]) for i in range(0, len(words), size - overlap)]


def test_token_windows(spark):
    texts = [None, " ", "one", "a b c d e f g", "a  b\nc http://x.y d", " ".join(map(str, range(100)))]
    got = chunk_lists(C.chunk(pages(spark, texts), 3, 1, C.TOKENS), len(texts))
    words = [[], [], ["one"], list("abcdefg"), list("abcd"), list(map(str, range(100)))]
    assert got == [windows(w, 3, 1) for w in words]


class Letters:
    def encode(self, text):
        return list(text)

    def decode(self, ids):
        return "".join(ids)


@pytest.mark.parametrize("splitter", [C.TOKENS, C.MODEL_TOKENS])
def test_tokenizer_windows(spark, splitter):
    got = chunk_lists(C.chunk(pages(spark, ["abcdef", None]), 4, 2, splitter, tokenizer=Letters), 2)
    assert got == [["abcd", "cdef", "ef"], []]


def test_line_packs(spark):
    texts = ["aa\nbb\ncc", "a very long line\nb\n\nc", "", None, "x"]
    got = chunk_lists(C.chunk_lines(pages(spark, texts), 5), len(texts))
    assert got == [["aa\nbb", "cc"], ["a very long line", "b\n\nc"], [], [], ["x"]]


def test_inherited_columns(spark):
    df = pages(spark, ["a b c"]).withColumn("metadata", F.lit("m"))
    assert C.chunk(df, 2, 0, C.TOKENS).columns == ["source", "page", "metadata", "chunk_idx", "page_content"]


@pytest.mark.parametrize("size, overlap, splitter", [
    (0, 0, C.TOKENS), (5, -1, C.TOKENS), (5, 5, C.TOKENS), ("5", 1, C.TOKENS), (5, 1, "Unknown"),
])
def test_bad_parameters(spark, size, overlap, splitter):
    with pytest.raises(ValueError):
        C.chunk(pages(spark, ["a"]), size, overlap, splitter)


def test_model_tokens_need_a_tokenizer(spark):
    with pytest.raises(ValueError):
        C.chunk(pages(spark, ["a"]), 5, 1, C.MODEL_TOKENS)


def test_character_windows_of_blank_and_wide_texts(spark):
    texts = ["\n\n\t\n", "  　", None, "", "ab𝄞déf", " x "]
    pages = spark.createDataFrame(list(enumerate(texts)), "page int, page_content string")
    rows = C.chunk_characters(pages, 4, 1).sort("page", "chunk_idx").collect()
    assert [(r.page, r.page_content) for r in rows] == [(4, "ab𝄞d"), (4, "déf"), (5, " x ")]
