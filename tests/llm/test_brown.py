import math
import zlib
from collections import Counter

import numpy as np
import pytest

from pagetrove.llm import brown


def plain_base(rows):
    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    counts = Counter()
    for i, text in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        words = tokens(text)
        out.append((i, zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2, len(words),
                    sum(counts[w] > 0 for w in words), total,
                    sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)))
    return sorted(out, key=str)


def compare(rows, found):
    ours = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found], key=str)
    theirs = plain_base(rows)
    assert len(ours) == len(theirs)
    ours.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    theirs.sort(key=lambda r: (str(r[0]), r[2], r[5]))
    for a, b in zip(ours, theirs):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)


def test_exchange_separates_two_languages():
    """Units 0-9 follow each other, and so do units 10-19."""
    random = np.random.default_rng(3)
    units, classes = 20, np.append(np.arange(20) % 4, 4)
    pairs = np.zeros((21, 21))
    pairs[:10, :10] = random.integers(1, 20, (10, 10))
    pairs[10:20, 10:20] = random.integers(1, 20, (10, 10))
    pairs[20, :20] = pairs[:20, 20] = 1
    values = []
    for _ in range(6):
        member = np.eye(5)[classes]
        values.append(brown.likelihood(member.T @ pairs @ member))
        classes = brown.exchange(classes, pairs.T @ member, pairs @ member)
    assert max(values) > values[0]
    assert not set(classes[:10]) & set(classes[10:units]) and classes[20] == 4


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "One two"), (3, "one  TWO\tthree É"), (3, "one  TWO\tthree É"),
            (20, "never seen " + "x" * 100), (21, "word " * 30_000), (22, "y" * 100 + " " + "y" * 100),
            (23, "y" * 100)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, row int, n string")
    found = brown.score(docs, classes=3, rounds=2).collect()
    compare(rows, found)
    assert all(r.score <= 0 for r in found)
    assert brown.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_probabilities_add_up(spark, monkeypatch):
    """Over all known words and one unknown word after each class, probabilities sum to at most 1."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(30)
    model, words, ends, least = brown.train(docs, classes=5, rounds=3)
    total = np.zeros(6)
    for row in words.collect():
        number = model.known.get(bytes(row.word))
        unit = brown.ending_unit(bytes(row.word)) if number is None else model.units[number]
        kind = model.classes[unit]
        total[kind] += 10 ** (math.log10(row.n + brown.DELTA) - model.scale[kind])
    total[5] = 1
    chances = 10 ** model.transitions @ total
    assert np.allclose((10 ** model.transitions).sum(axis=1), 1)
    assert (chances <= 1).all() and (chances > 0.5).all()


def test_better_than_base_on_held_out_documents(spark, monkeypatch):
    monkeypatch.setattr(brown, "KNOWN", 3000)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = brown.score(docs).collect()
    compare([(r.doc_id, r.text) for r in docs.collect()], found)
    held = [r for r in found if r.held_out]
    print(sum(r.score for r in held), sum(r.base_score for r in held))
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)
