import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from pagetrove.llm import rans, word_ids
from pagetrove.session import scratch_path


@pytest.mark.parametrize("count", [0, 1, 5, 1023, 1024, 1025, 300_000])
def test_round_trip_with_checkpoints(count):
    random = np.random.default_rng(count)
    ids = np.minimum(random.geometric(0.01, count), 4999).astype("<u4")
    table = rans.Table.fitted(np.bincount(ids, minlength=5000))
    block = rans.Block.read(rans.to_block([count], ids, table))
    assert np.array_equal(block.ids(table), ids)
    stretches = [block.stretch(n, table) for n in range(len(block.checkpoints) + 1)]
    assert np.array_equal(np.concatenate(stretches), ids)
    if count == 300_000:
        assert len(stretches) > 2
        share = np.bincount(ids, minlength=5000) / count
        bits = -(share[share > 0] * np.log2(share[share > 0])).sum() * count
        assert 32 * len(block.words) < 1.05 * bits


def test_ids_that_were_not_counted_and_damage():
    table = rans.Table.fitted(np.zeros(49_408, np.int64))
    ids = np.arange(0, 49_408, 7, dtype="<u4")
    data = rans.to_block([len(ids)], ids, table)
    assert np.array_equal(rans.Block.read(data).ids(table), ids)
    with pytest.raises(ValueError):
        rans.Block.read(data[:500] + bytes([data[500] ^ 1]) + data[501:])


def expected(rows):
    library = Tokenizer.from_file(word_ids.VOCABULARY)
    texts = library.encode_batch([t or "" for _, t in rows], add_special_tokens=False)
    made = [(i, np.array([*e.ids, 2], "<u4").tobytes()) for (i, _), e in zip(rows, texts)]
    made.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for i, data in made:
        out.append((i, start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    return sorted(out, key=str)


def test_files(spark, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", 3000)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, "no id"), (-5, None), (1 << 50, ""), (70, "same"), (70, "same"), (99_999, "long " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows if i != 70 or t == "same"],
                                 "doc_id long, text string, part int, ids string")
    path = scratch_path(spark, "test")
    rans.write(docs, path)
    found = rans.read(spark, path).collect()
    rows = [(i, t) for i, t in rows if i != 70 or t == "same"]
    assert sorted([(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in found], key=str) == expected(rows)


def test_empty_table(spark):
    path = scratch_path(spark, "test")
    rans.write(spark.createDataFrame([], "doc_id long, text string"), path)
    assert rans.read(spark, path).collect() == []
