import math

import numpy as np
import pytest

from pagetrove.llm import hard_negatives as hn


def plain(rows, every=50, positives=5, negatives=3):
    """All pairs, one by one."""
    whole = []
    for vec_id, label, vector in rows:
        if None in (vec_id, label) or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole.append((vec_id, label, tuple(math.floor(256 * x) for x in vector)))
    found = []
    for anchor in {row for row in whole if row[0] % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(anchor[2], v)), i, label) for i, label, v in whole if i != anchor[0])
        for positive, i, _ in [row for row in scored if row[2] == anchor[1]][:positives]:
            fit = [row for row in scored if row[2] != anchor[1] and 50 * -positive <= 100 * -row[0] <= 95 * -positive]
            found += [(anchor[0], i, rank, row[1], -positive, -row[0]) for rank, row in enumerate(fit[:negatives], 1)]
    return sorted(found)


def mined(df, **options):
    return sorted(map(tuple, hn.mine(df, **options).collect()))


SCHEMA = "vec_id long, label int, embedding array<float>, rank int, vector string"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 0, "x") for row in rows], SCHEMA)


@pytest.mark.parametrize("shape", [(1, 1, 1), (65, 33, 70), (64, 64, 64), (130, 97, 33), (3, 200, 90), (0, 40, 50)])
def test_strassen(shape, monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 4)
    random = np.random.default_rng(1)
    a, b = (random.integers(-2**27, 2**27, size) for size in (shape[:2], shape[1:]))
    assert (hn.strassen(a, b) == a @ b).all()


def test_strassen_wraps_round_and_back(monkeypatch):
    monkeypatch.setattr(hn, "LEAF", 1)
    a = np.array([[2**62, 0], [0, 2**62]])
    assert (hn.strassen(a, np.eye(2, dtype=np.int64)) == a).all()


@pytest.mark.parametrize("tile, block", [(512, 32 << 20), (3, 2000)])
def test_against_all_pairs(spark, monkeypatch, tile, block):
    """Few values, so that ties abound; one label has half of all rows; tiles and blocks are small."""
    monkeypatch.setattr(hn, "ANCHORS", tile)
    random = np.random.default_rng(2)
    labels = np.where(random.random(400) < 0.5, 3, random.integers(0, 8, 400))
    vectors = random.integers(-2, 4, (400, 40)) / 4
    rows = [(i * 5, int(l), v.tolist()) for i, l, v in zip(range(400), labels, vectors)]
    assert mined(frame(spark, rows), block_bytes=block) == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (50, None, [1.0, 1.0]), (100, 1, None), (150, 1, [1.0, None]),
            (200, 1, [nan, 1.0]), (250, 1, [1.0, inf]), (None, 1, [1.0, 1.0]), (300, 1, []), (3, 1, [1.0]),
            (4, 1, [0.5, 0.5, 9.0]), (5, 2, [0.5, 0.5]), (5, 2, [0.5, 0.5]), (6, 2, [0.7]), (-50, 2, [-1.0, -1.0]),
            (7, 3, [1.0, 0.25]), (8, 3, [0.001, -0.001])]
    assert mined(frame(spark, rows)) == plain(rows)


def test_empty_tables(spark):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    for rows in ([], [(1, 1, [1.0]), (2, 2, [1.0])], [(0, 1, [1.0])], [(0, None, None)]):
        found = hn.mine(frame(spark, rows))
        assert found.columns == columns and found.collect() == []


def test_too_large(spark):
    with pytest.raises(Exception, match="64 bits"):
        mined(frame(spark, [(0, 1, [1e30]), (1, 1, [1.0])]))
    with pytest.raises(Exception, match="64 bits"):
        mined(frame(spark, [(0, 1, [1e7]), (1, 1, [1e7])]))
