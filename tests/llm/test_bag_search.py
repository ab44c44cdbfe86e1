import math
import random
from collections import Counter

import pytest

from pagetrove.llm import bag_search as bs
from tests.llm.test_decontaminate import terms


def plain(docs, items, top=50):
    """Every document for every item."""
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, bag) for doc_id, bag in counted if bag]
    total, length = len(counted), sum(bag.total() for _, bag in counted)
    df = Counter(term for _, bag in counted for term in bag)
    by_item = {}
    for item_id, text in items:
        by_item.setdefault(item_id, set()).update(terms(text))
    found = []
    for item_id, wanted in by_item.items():
        scored = []
        for doc_id, bag in counted:
            m = 100 - 50 + (50 * bag.total() * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                        * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in wanted if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        found += [(item_id, rank, None if without else doc_id, -score)
                  for rank, (score, without, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return sorted(found, key=str)


def searched(spark, docs, items, **options):
    docs = spark.createDataFrame([(*row, 1, "b") for row in docs], "doc_id long, text string, n int, bag string")
    items = spark.createDataFrame([(*row, 1) for row in items], "item_id long, text string, doc_id int")
    return sorted(map(tuple, bs.search(docs, items, **options).collect()), key=str)


ITEMS = [(1, "alpha beta, gamma"), (2, "Alpha"), (3, None), (4, " .. "), (5, "nowhere"), (None, "beta beta delta"),
         (6, "one"), (6, "two alpha"), (7, "É東 x1")]


def test_awkward_rows(spark):
    docs = [(9, "alpha beta"), (3, "Beta ALPHA"), (3, "beta alpha"), (None, "alpha-beta"), (1, None), (2, ""), (4, ";"),
            (5, "gamma " * 3000), (6, "delta one É東 é東 x1"), (7, "two two other words"), (8, "unknown words only"),
            (10, "alpha " + "filler " * 200_000)]
    expected = plain(docs, ITEMS)
    assert searched(spark, docs, ITEMS) == expected
    assert searched(spark, docs, ITEMS, block_bytes=1) == expected
    assert searched(spark, docs, ITEMS, top=2) == plain(docs, ITEMS, 2)


def test_empty_tables(spark):
    assert searched(spark, [], ITEMS) == [] and searched(spark, [(1, None)], ITEMS) == []
    assert searched(spark, [(1, "alpha")], []) == [] and searched(spark, [(1, "alpha")], [(3, None)]) == []
    assert searched(spark, [(1, "alpha")], ITEMS) == plain([(1, "alpha")], ITEMS)


@pytest.mark.parametrize("cells, parts", [(1 << 17, 1 << 22), (64, 300)])
def test_against_every_document(spark, monkeypatch, cells, parts):
    """Few different bags, one of them in a third of all documents, so that scores tie in and between classes."""
    monkeypatch.setattr(bs, "CELLS", cells)
    monkeypatch.setattr(bs, "PARTS", parts)
    draw = random.Random(7)
    words = [f"w{i}" for i in range(12)]

    def text():
        chosen = words[:3] if draw.random() < 0.35 else draw.choices(words, k=draw.randint(1, 4))
        return " ".join(draw.sample(chosen, len(chosen)))

    docs = [(i, text()) for i in draw.sample(range(5000), 900)]
    items = [(i, " ".join(draw.sample(words, draw.randint(1, 5)))) for i in range(15)]
    assert searched(spark, docs, items, top=20) == plain(docs, items, 20)
    assert searched(spark, docs, items, top=20, block_bytes=3000) == plain(docs, items, 20)
