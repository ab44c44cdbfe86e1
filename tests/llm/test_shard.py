import zlib
from collections import Counter, defaultdict

import numpy as np

from pagetrove.llm import shard


def check(rows, found, shards):
    assert Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), "bytes", None)
                   for i, t in rows) == Counter(
        (r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in found)
    slots = defaultdict(list)
    for r in found:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pack_fills_evenly():
    random = np.random.default_rng(2)
    vectors = random.integers(1, 100, (5000, 3)).astype(float)
    placed = shard.pack(vectors, 40)
    for size in range(3):
        sums = np.bincount(placed, vectors[:, size], 40)
        assert sums.max() / sums.mean() < 1.01 and sums.min() / sums.mean() > 0.99


def test_hot_group_is_split(spark):
    """A third of all rows are copies of one text; shards are near equal all the same."""
    rows = [(i, "hot " * 20) for i in range(1500)] + [(i, f"text {i} " * (i % 37)) for i in range(1500, 4500)]
    rows += [(None, None), (None, ""), (7, "hot " * 20), (7, "hot " * 20)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                                 "doc_id long, text string, shard int, item string")
    found = shard.assign(docs, 8).collect()
    check(rows, found, 8)
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert max(sizes.values()) / min(sizes.values()) < 1.02


def test_empty_and_tiny(spark):
    assert shard.assign(spark.createDataFrame([], "doc_id long, text string"), 40).collect() == []
    rows = [(1, None), (2, "a"), (2, "a")]
    found = shard.assign(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    check(rows, found, 40)


def test_equal_texts_stay_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = shard.assign(docs, 40).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(texts.items(), found, 40)
    total = sum(r.size for r in found)
    places, weight = defaultdict(set), Counter()
    for r in found:
        places[texts[r.doc_id]].add(r.shard)
        weight[texts[r.doc_id]] += r.size
    assert all(len(p) == 1 for t, p in places.items() if weight[t] < total / 40 / 256 / 3)
