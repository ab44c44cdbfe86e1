"""Token ids in files, coded by a static range asymmetric numeral system.

One table of frequencies, counted over all ids, serves all blocks. A block holds whole documents in
ascending doc_id order and can be decoded on its own: its ids are dealt to lanes in turn, whose coder
states advance together, and all lanes read their words from one stream. A block starts with its
documents' lengths; it has checkpoints, each with the place in the stream and the states of all lanes,
from which decoding may start, and a checksum over everything. Blocks are rows of a Parquet folder, in
which they have their place by part and number; the table lies beside them.
"""

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrove.llm import word_ids
from pagetrove.llm.common import even_cuts, in_slices, part_of, utf8
from pagetrove.session import drop_folder, scratch_path

SCALE = 20  # the frequencies add up to 1 << SCALE
LOW = 31  # states lie in [1 << LOW, 1 << (LOW + 32))
LANES = 1024
BLOCK = 1 << 18  # ids after which a block is closed
CHECKPOINT = 128  # steps of all lanes between checkpoints
_HEAD = struct.Struct("<4sIIIIQ")  # mark, lanes, documents, checkpoints, words, ids
_MARK = b"RNS1"


class Table:
    """Frequencies of all ids of a vocabulary, none of them zero."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = frequencies.astype(np.uint64)
        self.starts = np.cumsum(self.frequencies) - self.frequencies
        self.ids = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        if len(self.ids) != 1 << SCALE:
            raise ValueError("frequencies must add up to the scale")

    @classmethod
    def fitted(cls, counts: np.ndarray) -> "Table":
        """Shares of the counts, each at least 1; what rounding leaves goes to the largest ones."""
        size = 1 << SCALE
        if len(counts) > size:
            raise ValueError("the vocabulary is larger than the scale")
        spare = size - len(counts)
        made = 1 + counts.astype(np.int64) * spare // max(1, int(counts.sum()))
        order = np.argsort(-counts, kind="stable")
        left = size - int(made.sum())
        each, more = divmod(left, len(counts))
        made += each
        made[order[:more]] += 1
        return cls(made)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT):
    """(words, final states, checkpoints) of ids; a checkpoint is (word offset, states)."""
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, 1 << LOW, dtype=np.uint64)
    scale, mask = np.uint64(SCALE), np.uint64(0xFFFFFFFF)
    pushed, saved = [], []
    for step in range(steps - 1, -1, -1):
        now = ids[step * lanes:(step + 1) * lanes]
        x = state[:len(now)]
        of, start = table.frequencies[now], table.starts[now]
        full = x >= of << np.uint64(LOW + 32 - SCALE)
        pushed.append((x[full] & mask).astype("<u4"))
        x = np.where(full, x >> np.uint64(32), x)
        whole = x // of
        state[:len(now)] = (whole << scale) + (x - whole * of) + start
        if step and step % every == 0:
            saved.append((step, state.copy()))
    pushed.reverse()
    sizes = np.cumsum([0] + [len(p) for p in pushed])
    words = np.concatenate(pushed) if pushed else np.zeros(0, "<u4")
    return words, state, [(int(sizes[step]), states) for step, states in reversed(saved)]


def decode(words: np.ndarray, state: np.ndarray, count: int, table: Table, step: int = 0,
           stop: int | None = None) -> np.ndarray:
    """Ids from ``step`` up to step ``stop`` of a stream of ``count`` ids, given the stream from the
    place of the first step and the states there."""
    lanes, state = len(state), state.copy()
    steps = -(-count // lanes)
    stop = steps if stop is None else min(stop, steps)
    out = np.empty(min(count, stop * lanes) - step * lanes, dtype=np.uint32)
    at, mask = 0, np.uint64((1 << SCALE) - 1)
    for now in range(step, stop):
        begin = (now - step) * lanes
        size = min(lanes, len(out) - begin)
        x = state[:size]
        slot = x & mask
        found = table.ids[slot]
        out[begin:begin + size] = found
        x = table.frequencies[found] * (x >> np.uint64(SCALE)) + slot - table.starts[found]
        short = np.flatnonzero(x < np.uint64(1 << LOW))
        x[short] = x[short] << np.uint64(32) | words[at:at + len(short)]
        at += len(short)
        state[:size] = x
    return out


def to_block(lengths: list[int], ids: np.ndarray, table: Table) -> bytes:
    words, state, saved = encode(ids, table)
    body = b"".join([
        _HEAD.pack(_MARK, LANES, len(lengths), len(saved), len(words), len(ids)),
        np.array(lengths, "<u8").tobytes(), state.astype("<u8").tobytes(),
        *(struct.pack("<Q", at) + states.astype("<u8").tobytes() for at, states in saved),
        words.tobytes()])
    return body + struct.pack("<I", zlib.crc32(body))


@dataclass
class Block:
    """One block read back."""

    lengths: np.ndarray
    count: int
    state: np.ndarray
    checkpoints: list[tuple[int, np.ndarray]]
    words: np.ndarray

    @classmethod
    def read(cls, data: bytes) -> "Block":
        if len(data) < _HEAD.size + 4 or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("the block is damaged: its checksum does not fit")
        mark, lanes, documents, saved, words, count = _HEAD.unpack_from(data)
        if mark != _MARK:
            raise ValueError("not a block of token ids")
        at = _HEAD.size
        lengths = np.frombuffer(data, "<u8", documents, at)
        at += 8 * documents
        state = np.frombuffer(data, "<u8", lanes, at)
        at += 8 * lanes
        points = []
        for _ in range(saved):
            points.append((struct.unpack_from("<Q", data, at)[0], np.frombuffer(data, "<u8", lanes, at + 8)))
            at += 8 + 8 * lanes
        return cls(lengths, count, state, points, np.frombuffer(data, "<u4", words, at))

    def ids(self, table: Table) -> np.ndarray:
        return decode(self.words, self.state, self.count, table)

    def stretch(self, number: int, table: Table) -> np.ndarray:
        """The ids from one checkpoint to the next; number 0 starts at the block's start."""
        at, state = self.checkpoints[number - 1] if number else (0, self.state)
        return decode(self.words[at:], state, self.count, table, number * CHECKPOINT,
                      (number + 1) * CHECKPOINT)


_TOKENS = "doc_id long, part int, ids binary"
_BLOCKS = "part int, number int, first long, n_ids long, doc_ids array<long>, block binary"


def _dense(counts):
    """Counts of the ids, as rows, for aggregation."""
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["id", "n"])


def write(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str = word_ids.VOCABULARY) -> None:
    """Encode ``docs`` (doc_id, text, any others) into the folder ``path``, in ascending doc_id order.

    A null text counts as empty; every document ends with ``end_id``. Rows without a doc_id come first,
    rows with equal ids in the order of their tokens. An empty table makes an empty folder that can
    be read. Tokens are written once, because the frequencies have to be known before coding, and are
    shuffled once; this table is deleted afterwards.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = _vocabulary_size(vocabulary)
    end = end_id.to_bytes(4, "little")
    part = part_of(F.col("doc_id"), even_cuts(docs, "doc_id", 4 * tasks))

    def tokens(batches):
        encoder, press = word_ids.loaded(vocabulary), zstandard.ZstdCompressor(level=1)
        for ids, parts, texts in in_slices(batches):
            made = [press.compress(data + end) for data in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(made, pa.binary())],
                names=["doc_id", "part", "ids"])

    def counted(batches):
        unpress, counts = zstandard.ZstdDecompressor(), np.zeros(size, np.int64)
        for (made,) in in_slices(batches):
            data = b"".join(map(unpress.decompress, made))
            counts += np.bincount(np.frombuffer(data, "<u4"), minlength=size)
        yield _dense(counts)

    kept = scratch_path(spark, "token-ids")
    docs.select("doc_id", part.alias("part"), utf8("text").alias("text")).mapInArrow(tokens, _TOKENS).write.option(
        "compression", "none").parquet(kept)
    held = spark.read.schema(_TOKENS).parquet(kept)
    totals = held.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row per id of the vocabulary: bounded by it.
    counts = np.zeros(size, np.int64)
    for row in totals.collect():
        counts[row["id"]] = row["n"]
    frequencies = Table.fitted(counts).frequencies.astype(int).tolist()
    spark.createDataFrame([(frequencies,)], "frequencies array<long>").coalesce(1).write.parquet(f"{path}/table")

    def blocks(batches):
        table, unpress = Table(np.array(frequencies)), zstandard.ZstdDecompressor()
        part, number, first, ids, data, size = None, 0, 0, [], [], 0

        def made():
            lengths = [len(d) // 4 for d in data]
            block = to_block(lengths, np.frombuffer(b"".join(data), "<u4"), table)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([block], pa.binary())],
                names=["part", "number", "first", "n_ids", "doc_ids", "block"])

        for columns in in_slices(batches):
            for doc_id, its_part, packed in zip(*columns):
                if ids and (its_part != part or size >= BLOCK):
                    yield made()
                    number, first = number + 1, first + size
                    ids, data, size = [], [], 0
                if its_part != part:
                    part, number, first = its_part, 0, 0
                ids.append(doc_id)
                data.append(unpress.decompress(packed))
                size += len(data[-1]) // 4
        if ids:
            yield made()

    held.repartition(tasks, "part").sortWithinPartitions("part", "doc_id", "ids").mapInArrow(
        blocks, _BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    drop_folder(spark, kept)


def _vocabulary_size(path):
    return word_ids.loaded(path).tokenizer.get_vocab_size()


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a folder that ``write`` made: its place in the
    whole sequence of ids, and its ids as little-endian unsigned 32-bit integers."""
    frequencies = spark.read.parquet(f"{path}/table").first()["frequencies"]
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")

    def documents(batches):
        table = Table(np.array(frequencies))
        for batch in batches:
            for at in range(batch.num_rows):
                part, first, ids, data = (column[at].as_py() for column in batch.columns)
                block = Block.read(data)
                found = block.ids(table).astype("<u4").tobytes()
                ends = np.cumsum(block.lengths.astype(np.int64))
                starts = ends - block.lengths.astype(np.int64)
                # A block has as many documents as it takes to fill it; long ones make small batches.
                for low in range(0, len(ids), 4096):
                    span = slice(low, low + 4096)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part] * len(ids[span]), pa.int32()), pa.array(ids[span], pa.int64()),
                        pa.array(first + starts[span]), pa.array((ends - starts)[span]),
                        pa.array([found[4 * a:4 * b] for a, b in zip(starts[span].tolist(), ends[span].tolist())],
                                 pa.binary())], names=["part", "doc_id", "at", "n_tokens", "ids"])

    read_back = blocks.select("part", "first", "doc_ids", "block").mapInArrow(
        documents, "part int, doc_id long, at long, n_tokens long, ids binary")
    # One row per part; there are four parts for each shuffle partition of the writer at most.
    sizes = sorted((row["part"], row["n"]) for row in blocks.groupBy("part").agg(
        F.sum("n_ids").alias("n")).collect())
    before, offsets = 0, []
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    offset = F.broadcast(spark.createDataFrame(offsets, "part int, offset long"))
    return read_back.join(offset, "part").select(
        "doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids")

