"""The best rows of many keys, in tasks and over all of them."""

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEAST, GREATEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Heaps:
    """The best ``size`` entries (score, ids) of each key: greatest scores first, then smallest ids. What
    other heaps hold is merged by taking it in."""

    def __init__(self, keys: int, size: int, ids: int = 1, floor: int = LEAST):
        self.size = size
        self.floor = np.full(keys, floor, np.int64)  # lower scores are of no use
        self.key = self.score = np.zeros(0, np.int64)
        self.ids = [self.key] * ids

    def take(self, key: np.ndarray, score: np.ndarray, *ids: np.ndarray) -> None:
        if not len(key):
            return
        key, score = np.concatenate([self.key, key]), np.concatenate([self.score, score])
        ids = [np.concatenate(pair) for pair in zip(self.ids, ids)]
        order = np.lexsort((*reversed(ids), -score, key))
        key = key[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        place = np.arange(len(key)) - np.repeat(starts, np.diff(np.append(starts, len(key))))
        kept = order[place < self.size]
        last = place == self.size - 1
        self.floor[key[last]] = score[order[last]]
        self.key, self.score = key[place < self.size], score[kept]
        self.ids = [column[kept] for column in ids]


def merged(found: DataFrame, keys: list[str], score: str, row: str, size: int, rank: str) -> DataFrame:
    """The heaps of all tasks as one: the best ``size`` rows of each key, numbered from 1. Rows without an id
    come last among equal scores."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc_nulls_last(row))
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= size)
