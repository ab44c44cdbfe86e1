import hashlib
import random
import re

import pytest

from pagetrove.llm import decontaminate as dc
from pagetrove.llm import common

# Characters that make words; A-Z are lower-cased before.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, width=10):
    """Every window at every place."""
    found = []
    for doc_id, text in docs:
        words, hit, names = terms(text), set(), set()
        for item_id, item in items:
            own = terms(item)
            size = min(width, len(own))
            for i in range(len(own) - size + 1 if size else 0):
                for at in range(len(words) - size + 1):
                    if words[at:at + size] == own[i:i + size]:
                        hit.update(range(at, at + size))
                        names.add("" if item_id is None else str(item_id))
        joined = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc_id, len(words), len(hit), len(names), joined, bool(hit)))
    return sorted(found, key=str)


def searched(spark, docs, items, **options):
    docs = spark.createDataFrame([(*row, 0, "x") for row in docs], "doc_id long, text string, n_words int, items string")
    items = spark.createDataFrame([(*row, 1, "y") for row in items], "item_id long, text string, doc_id int, name string")
    return sorted(map(tuple, dc.digest(dc.find_items(docs, items, **options)).collect()), key=str)


def test_terms_are_those_of_the_pattern():
    text = "".join(map(chr, range(0x300))) + "Aé-É_0" + "Übung 東京 A.b\x7fc`d{e[f"
    assert [t.decode() for part in common.term_stretches(text.encode()) for t in part] == terms(text)
    text = " ".join(f"w{i}," for i in range(5000))
    parts = list(common.term_stretches(text.encode(), 100))
    assert len(parts) > 100 and [t.decode() for p in parts for t in p] == terms(text)


def test_awkward_rows(spark):
    item = "One two three four five six seven eight nine ten eleven TWELVE"
    items = [(1, item), (10, "short item"), (9, "word"), (2, None), (3, " .,;\x00"), (None, "no name here"),
             (4, "a a a a a a a a a a a a"), (4, "second row of four"), (5, "Éa éa"), (1, item)]
    docs = [(1, None), (2, ""), (3, item), (3, item), (4, item.upper().replace(" ", "--")), (None, "x word short-item"),
            (5, "one two three four five six seven eight nine"), (6, "a " * 40), (7, "second row of four no name here"),
            (8, "éa éa Éa éa"), (9, "x " * 30_000 + item + " y" * 30_000), (10, "words shortitem"),
            (11, "zero " + item + " short"), (12, "a " * 9)]
    expected = plain(docs, items)
    assert searched(spark, docs, items) == expected
    # One item a block, whose findings are merged.
    assert searched(spark, docs, items, block_bytes=1) == expected
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in dc.find_items(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert spans[11] == [(1, 13)] and spans[9] == [(30_000, 30_012)] and spans[8] == [(2, 4)]


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "word")]) == []
    docs = [(1, "a word"), (None, None)]
    for items in ([], [(1, None)], [(2, "  ")]):
        assert searched(spark, docs, items) == plain(docs, items)


@pytest.mark.parametrize("stretch, piece", [(1 << 20, 4096), (7, 3)])
def test_random_texts(monkeypatch, stretch, piece):
    """Few words, so that windows repeat, overlap and share their ends; texts in tiny stretches as well."""
    draw = random.Random(3)
    monkeypatch.setattr(common.term_stretches, "__defaults__", (stretch,))
    for _ in range(60):
        words = "abc"[:draw.randint(1, 3)]
        text = lambda most: " ".join(draw.choice(words) for _ in range(draw.randint(0, most)))
        items = [(i, text(12)) for i in range(draw.randint(0, 6))]
        docs = [(i, text(60)) for i in range(4)]
        search = dc.Searcher([(str(i), [w.encode() for w in terms(t)]) for i, t in items], 4)
        for (doc_id, doc), (_, n_words, n_hit, _, joined, _) in zip(docs, plain(docs, items, 4)):
            total, spans, names = search(doc.encode())
            assert (total, sum(e - b for b, e in spans)) == (n_words, n_hit)
            assert hashlib.sha256(",".join(sorted(names)).encode()).hexdigest() == joined
            assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_long_items_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(dc, "PIECE", 7)
    monkeypatch.setattr(common.term_stretches, "__defaults__", (40,))
    items = [(1, " ".join(f"w{i}" for i in range(200))), (2, "only nine words are in this one as counted"), (3, "x " * 30)]
    docs = [(i, " ".join(f"w{j}" for j in range(i, i + 12))) for i in range(0, 195, 5)] + [(999, items[1][1])]
    assert searched(spark, docs, items, block_bytes=60) == plain(docs, items)


def test_windows_are_skipped():
    """Words of no pattern let the search go on by nearly a window."""
    matcher = dc.Searcher([("1", [b"w%d" % i for i in range(20)])], 10).matchers[0]
    looked = []
    matcher.shifts = type("Counted", (dict,), {"get": lambda self, *a: looked.append(a) or dict.get(self, *a)})(matcher.shifts)
    assert list(matcher.find([b"other"] * 900, 0)) == [] and len(looked) <= 100
