"""Substring deduplication with suffix automata of reference shards.

Words that lie in a window of ``WINDOW`` words which a document with a smaller doc_id also has are removed.

The corpus is far too large for one automaton, and most windows occur once, so it is cut into shards that
are small by construction. In every window the run of ``GRAM`` words with the smallest hash is its anchor.
Equal windows have equal anchors, so all occurrences of a window meet in the shard of its anchor, and only
anchors found in two documents matter. A shard's passages come in the order of doc_id: each is streamed
through the automaton of those before it, its matching statistics give the maximal spans of at least a
window, and then it is added, unless it was found whole. An anchor with more than ``SHARD`` occurrences
would make too large a shard; its windows are compared by 128-bit hashes instead, which aggregate before
they are shuffled. Shards and documents are brought together by shuffles, as no bound is known for
what a broadcast would hold.
"""

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh64_intdigest

from pagetrove.llm.common import in_slices, utf8
from pagetrove.session import settled

WINDOW = 50
GRAM = 16
SHARD = 512  # occurrences
# Odd multipliers for polynomials modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class SuffixAutomaton:
    """Automaton of all substrings of the sequences added; equal states are shared among them."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _split(self, state, word, target):
        """A copy of ``target`` for the shorter strings that end there when coming from ``state``."""
        copy = len(self.length)
        self.next.append(self.next[target].copy())
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list) -> None:
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                exact = self.length[known] == self.length[last] + 1
                last = known if exact else self._split(last, word, known)
                continue
            state = last
            last = len(self.length)
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[state] + 1)
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = last
                state = self.link[state]
            if state >= 0:
                target = self.next[state][word]
                exact = self.length[target] == self.length[state] + 1
                self.link[last] = target if exact else self._split(state, word, target)

    def spans(self, words: list, least: int) -> list[tuple[int, int]]:
        """Maximal spans of at least ``least`` words that the automaton knows, from the matching
        statistics; spans may overlap."""
        state = size = 0
        found: list[tuple[int, int]] = []
        for at, word in enumerate(words):
            step = self.next[state].get(word)
            while step is None and state:
                state = self.link[state]
                size = self.length[state]
                step = self.next[state].get(word)
            if step is None:
                continue
            state, size = step, size + 1
            if size >= least:
                begin = at - size + 1
                if found and found[-1][0] == begin:
                    found[-1] = (begin, at + 1)
                else:
                    found.append((begin, at + 1))
        return found


def _powers(base, count):
    out = np.ones(count, dtype=np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


def _span_hashes(hashes, width, base):
    """Polynomial hash of every run of ``width`` words, modulo 2**64."""
    count = len(hashes)
    up, down = _powers(np.uint64(base), count), _powers(np.uint64(pow(base, -1, 1 << 64)), count)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    return (sums[width:] - sums[:-width]) * down[:count - width + 1]


def _mixed(x):
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words, repeat(0)), np.uint64, len(words))


def anchors(hashes: np.ndarray, window: int, gram: int):
    """(anchor hash, first window, last window): which windows have which anchor, as arrays. Windows in a row
    whose anchors are equal are one entry, so that words repeated over and over make no more entries."""
    grams = _mixed(_span_hashes(hashes, gram, _BASES[0]))
    views = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    chosen = grams[views.argmin(axis=1) + np.arange(len(views))]
    first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    last = np.append(first[1:], len(chosen)) - 1
    return chosen[first].view(np.int64), first, last


def _anchor_rows(window, gram):
    def run(batches):
        for ids, keys, texts in in_slices(batches, 256):
            found, doc, key = [], [], []
            for doc_id, text_key, text in zip(ids, keys, texts):
                words = text.split()
                if doc_id is not None and len(words) >= window:
                    names = np.unique(anchors(word_hashes(words), window, gram)[0])
                    found.append(names)
                    doc.append(np.full(len(names), doc_id))
                    key.append(np.full(len(names), text_key))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (found, doc, key)],
                    names=["anchor", "doc_id", "text_key"])

    return run


def _finish_batch(batch, texts, masks, finish, types, names, keep):
    """The kept columns of a batch, and what ``finish`` makes of the texts with a mask."""
    made = [finish(text, mask) if text is not None else None for text, mask in zip(texts, masks)]
    columns = [batch.column(name) for name in keep]
    for at, kind in enumerate(types):
        columns.append(pa.array([row and row[at] for row in made], type=kind))
    return columns, [*keep, *names]


def cut_repeats(docs: DataFrame, finish: Callable[[bytes, np.ndarray | None], tuple], schema: str,
                window: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, any others) without the text, with the columns of ``schema``.

    ``finish`` gets a text and a mask of those of its words that are to go (None if there are none), and
    returns the new values. Windows are judged on the input. A null text has no words; rows without a doc_id
    neither lose words nor make others lose any; rows that share a doc_id don't cut each other, and
    rows that repeat are treated alike. A column of ``docs`` with the name of a new one gives way to it. An empty
    table gives no rows.
    """
    fields = T.StructType.fromDDL(schema)
    names, types = fields.names, [f.type for f in to_arrow_schema(fields)]
    others = [c for c in docs.columns if c == "doc_id" or c not in ("text", *names)]
    keyed = docs.select(*others, F.xxhash64("text").alias("__key"), utf8("text").alias("__text"))
    rows = settled(keyed.select("doc_id", "__key", "__text").mapInArrow(
        _anchor_rows(window, gram), "anchor long, doc_id long, text_key long"), "anchors")
    # Written, so that the join below has two plain shuffles, of which Spark can split crowded parts.
    shared = settled(rows.groupBy("anchor").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")
    ).where("least < most").select("anchor", (F.col("n") > shard).alias("hot")), "anchors-shared")
    hits = rows.join(shared, "anchor").groupBy("doc_id", "text_key").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("anchor"))).alias("__cold"),
        F.collect_set(F.when(F.col("hot"), F.col("anchor"))).alias("__hot"))
    hits = hits.withColumnsRenamed({"doc_id": "__doc_id", "text_key": "__text_key"})
    met = keyed.join(hits, (F.col("doc_id") == F.col("__doc_id")) & (F.col("__key") == F.col("__text_key")),
                     "left").drop("__doc_id", "__text_key")

    def first(batches):
        """Finish the documents without hits; pack the texts of the others."""
        press = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column("__text").to_pylist()
                open_ = batch.column("__cold").is_valid().to_pylist()
                columns, made = _finish_batch(
                    batch, [None if is_open else text for text, is_open in zip(texts, open_)],
                    [None] * len(texts), finish, types, names, [*others, "__key", "__cold", "__hot"])
                columns.append(pa.array([press.compress(text) if is_open else None
                                         for text, is_open in zip(texts, open_)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*made, "__packed"])

    def shape(*more):
        return T.StructType([*docs.select(others).schema.fields, T.StructField("__key", T.LongType()),
                             *more, *fields.fields])

    arrays = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("__cold", "__hot")]
    half = T.StructType([*shape(*arrays).fields, T.StructField("__packed", T.BinaryType())])
    started = settled(met.mapInArrow(first, half), "cut-started")
    waiting = started.where(F.col("__packed").isNotNull())
    spans = _cold_spans(waiting, window, gram).unionByName(_hot_spans(waiting, window, gram))
    spans = spans.groupBy("doc_id", "text_key").agg(
        F.collect_set(F.struct("begin", "end")).alias("__spans")).withColumnsRenamed(
        {"doc_id": "__doc_id", "text_key": "__text_key"})
    found = waiting.select(*others, "__key", "__packed").join(
        spans, (F.col("doc_id") == F.col("__doc_id")) & (F.col("__key") == F.col("__text_key")), "left")

    def last(batches):
        unpress = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = [unpress.decompress(packed) for packed in batch.column("__packed").to_pylist()]
                masks = [_mask(text, cut) for text, cut in zip(texts, batch.column("__spans").to_pylist())]
                columns, made = _finish_batch(batch, texts, masks, finish, types, names, [*others, "__key"])
                yield pa.RecordBatch.from_arrays(columns, names=made)

    ended = found.mapInArrow(last, shape())
    return started.where(F.col("__packed").isNull()).select(ended.columns).unionByName(ended).drop("__key")


def _mask(text, spans):
    if not spans:
        return None
    edges = np.zeros(len(text.split()) + 1, dtype=np.int64)
    for span in spans:
        edges[span["begin"]] += 1
        edges[span["end"]] -= 1
    return np.cumsum(edges)[:-1] > 0


_SPANS = "doc_id long, text_key long, begin long, end long"


def _span_batch(spans):
    columns = zip(*spans) if spans else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns],
                                      names=["doc_id", "text_key", "begin", "end"])


def _cold_spans(waiting, window, gram):
    """Spans found by the automata of the shards."""

    def passages(batches):
        unpress = zstandard.ZstdDecompressor()
        for ids, keys, cold, packed in in_slices(batches, 256):
            out = []
            for doc_id, key, wanted, data in zip(ids, keys, cold, packed):
                words = unpress.decompress(data).split()
                names, first, last = anchors(word_hashes(words), window, gram)
                for at in np.flatnonzero(np.isin(names, wanted)).tolist():
                    begin, end = int(first[at]), int(last[at]) + window
                    out.append((int(names[at]), doc_id, key, begin, b" ".join(words[begin:end])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), kind) for c, kind in zip(
                        zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                    names=["anchor", "doc_id", "text_key", "begin", "words"])

    def match(batches):
        anchor, doc, automaton, seen, new = None, None, None, set(), []
        for columns in in_slices(batches):
            spans = []
            for name, doc_id, key, begin, text in zip(*columns):
                if name != anchor:
                    anchor, doc, automaton, seen, new = name, doc_id, None, set(), []
                if doc_id != doc:
                    # Only now do the passages of the last document become part of the reference.
                    if new:
                        automaton = automaton or SuffixAutomaton()
                        for words in new:
                            automaton.add(words)
                            seen.add(b" ".join(words))
                    doc, new = doc_id, []
                words = text.split()
                if text in seen:
                    cut = [(0, len(words))]
                else:
                    cut = automaton.spans(words, window) if automaton else []
                    if cut != [(0, len(words))]:
                        new.append(words)
                spans += [(doc_id, key, begin + a, begin + b) for a, b in cut]
            yield _span_batch(spans)

    tasks = int(waiting.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        waiting.where(F.size("__cold") > 0).select("doc_id", "__key", "__cold", "__packed")
        .mapInArrow(passages, "anchor long, doc_id long, text_key long, begin long, words binary")
        .repartition(tasks, "anchor").sortWithinPartitions("anchor", "doc_id")
        .mapInArrow(match, _SPANS)
    )


def _hot_spans(waiting, window, gram):
    """Spans of windows whose anchors occur too often for one shard."""

    def windows(batches):
        unpress = zstandard.ZstdDecompressor()
        for ids, keys, hot, packed in in_slices(batches, 64):
            out = [[] for _ in range(5)]
            for doc_id, key, wanted, data in zip(ids, keys, hot, packed):
                hashes = word_hashes(unpress.decompress(data).split())
                names, first, last = anchors(hashes, window, gram)
                chosen = np.isin(names, wanted)
                at = np.repeat(chosen, last - first + 1).nonzero()[0]
                for column, values in zip(out, (
                        *(_span_hashes(hashes, window, base)[at].view(np.int64) for base in _BASES),
                        np.full(len(at), doc_id), np.full(len(at), key), at)):
                    column.append(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64)) for c in out],
                names=["w1", "w2", "doc_id", "text_key", "begin"])

    found = waiting.where(F.size("__hot") > 0).select("doc_id", "__key", "__hot", "__packed").mapInArrow(
        windows, "w1 long, w2 long, doc_id long, text_key long, begin long")
    least = settled(found.groupBy("w1", "w2").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where(
        "least < most").drop("most"), "windows-shared")
    later = found.join(least, ["w1", "w2"]).where(F.col("doc_id") > F.col("least"))
    return later.select("doc_id", "text_key", "begin", (F.col("begin") + window).alias("end"))
