import hashlib
import random

import pytest

from pagetrove.llm import span_hash
from pagetrove.llm.span_hash import PrefixHash, likeness


def test_spans_and_extensions_against_slices():
    pick = random.Random(3)
    for _ in range(60):
        a = "".join(pick.choice("ab\U0001f600") for _ in range(pick.randint(0, 60)))
        b = a[:20] + "".join(pick.choice("ab") for _ in range(pick.randint(0, 40)))
        one, two = PrefixHash(a), PrefixHash(b)
        i, j = pick.randint(0, len(a)), pick.randint(0, len(b))
        for width in range(min(len(a) - i, len(b) - j) + 1):
            assert one.span_equal(i, two, j, width) == (a[i:i + width] == b[j:j + width])
        ahead = 0
        while i + ahead < len(a) and j + ahead < len(b) and a[i + ahead] == b[j + ahead]:
            ahead += 1
        assert one.extension(i, two, j) == ahead
        back = 0
        while back < min(i, j) and a[i - back - 1] == b[j - back - 1]:
            back += 1
        assert one.extension_back(i, two, j) == back


def test_likeness():
    pick = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz "
    text = "".join(pick.choice(letters) for _ in range(3000))
    other = "".join(pick.choice(letters) for _ in range(2500))
    scattered = text[:700] + "X" + text[701:1500] + text[1510:2400] + "yy" + text[2400:]
    assert likeness(PrefixHash(text), PrefixHash(text)) == 1
    assert likeness(PrefixHash(""), PrefixHash("")) == 1
    assert likeness(PrefixHash(""), PrefixHash("a")) == 0
    assert 0.98 < likeness(PrefixHash(text), PrefixHash(scattered)) < 1
    assert likeness(PrefixHash(text), PrefixHash(other)) < 0.1
    moved = text[2000:] + text[:2000]
    assert likeness(PrefixHash(text), PrefixHash(moved)) > 0.6
    assert len({PrefixHash(t).digest() for t in ("", "\0", "\0\0", "a", "b")}) == 5


def plain(rows):
    rows = sorted(((i, t or "") for i, t in rows),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                    PrefixHash(text).digest(), PrefixHash(edited).digest(),
                    likeness(PrefixHash(text), PrefixHash(edited)),
                    likeness(PrefixHash(text), PrefixHash(after))))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [],
    [(5, "alone")],
    [(None, "x"), (None, "y y y"), (None, None)],
    [(9, "abc" * 50), (2, None), (2, ""), (2, "abcdef"), (None, "no id"), (1 << 60, "\u00e9" * 7),
     (40, "z" * 200_000), (41, "z" * 200_000)],
])
def test_awkward_rows(spark, rows):
    docs = spark.createDataFrame([(i, t, "p") for i, t in rows], "doc_id long, text string, part string")
    found = span_hash.compare_with_next(docs)
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows)


def test_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sorted(map(tuple, span_hash.compare_with_next(docs).collect()), key=str)
    assert found == plain(rows)
    assert all(r[5] >= 0.6 for r in found if r[1] > 3)
