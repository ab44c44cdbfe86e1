import random
import zlib

import pytest
from tokenizers import Tokenizer

from pagetrove.llm import edit_counts, queries
from pagetrove.llm.edit_counts import TokenTree

LIBRARY = Tokenizer.from_file(edit_counts.VOCABULARY)
LIBRARY.encode_special_tokens = True


def whole(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("block", [1, 4, 32])
def test_random_edits_against_whole_texts(monkeypatch, block):
    monkeypatch.setattr(edit_counts, "BLOCK", block)
    counts = edit_counts.PieceCounts(edit_counts.VOCABULARY)
    pick = random.Random(block)
    letters = ["a", "b", " ", "  ", "\n", "\n \n", "'s", "'ll", "7", "!", "\u00e9", "\U0001f600", "\u3000", "<|endoftext|>",
               "word", " the"]

    def some(n):
        return "".join(pick.choice(letters) for _ in range(pick.randint(0, n)))

    for _ in range(25):
        text = some(300)
        tree = TokenTree(text, counts)
        assert tree.text() == text and tree.total == whole(text)
        for _ in range(25):
            start = pick.randint(0, len(text))
            end = min(len(text), start + pick.choice([0, 0, 1, 2, 5, 40, 1000]))
            new = some(pick.choice([0, 1, 3, 60]))
            text = text[:start] + new + text[end:]
            tree.edit(start, end, new)
            assert tree.text() == text and tree.length == len(text) and tree.total == whole(text)


def test_a_small_edit_encodes_little():
    text = "some words of a long text, " * 20_000
    tree = TokenTree(text, edit_counts.PieceCounts(edit_counts.VOCABULARY))
    before = tree.encoded
    tree.edit(250_000, 250_003, "new")
    assert tree.encoded - before < 300 and before > 100_000


def test_awkward_rows(spark):
    rows = [(1, None, None), (2, "", []), (3, "abc", [(None, 1, "x"), (1, None, "y"), (-5, 99, "z")]),
            (3, "abc", None), (3, "abc", None), (None, "a b", [(9, 3, None), (1, 0, "q"), None]),
            (5, " ", [(0, 1, ""), (0, 0, "new text")]), (6, "w " * 50_000, [(5, 6, "xx")])]
    docs = spark.createDataFrame([(i, t, e, 1) for i, t, e in rows],
                                 f"doc_id long, text string, edits {edit_counts.EDITS}, n_tokens int")
    found = sorted([tuple(r)[:5] for r in edit_counts.count_edits(docs).collect()], key=str)
    after = ["", "", "z", "abc", "abc", "aq b", "new text", "w w xxw " + "w " * 49_996]
    after[7] = "w " * 2 + "w" + "xx" + "w " * 49_997
    done = [0, 0, 2, 0, 0, 2, 2, 1]
    assert found == sorted([(i, whole(t or ""), whole(a), n, zlib.crc32(a.encode()))
                            for (i, t, _), a, n in zip(rows, after, done)], key=str)
    empty = spark.createDataFrame([], f"doc_id long, text string, edits {edit_counts.EDITS}")
    assert edit_counts.count_edits(empty).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op5_edit_counts(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        text = texts[r.doc_id]
        size, at = len(text), len(text) // 2
        edited = text[:at] + text[at + 17:]
        at = min(size // 3, len(edited))
        edited = edited[:at] + " ".join(text[:200].split(" ")[:3]) + edited[at:] + text[:30]
        assert (r.n_tokens, r.edited_tokens, r.edited_crc32) == (
            whole(text), whole(edited), zlib.crc32(edited.encode()))
