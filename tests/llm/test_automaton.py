import hashlib
import random
import tracemalloc

import duckdb
import pytest

from pagetrove.llm import automaton, queries
from pagetrove.llm.automaton import SuffixAutomaton


def test_automaton_against_substrings():
    pick = random.Random(1)
    for _ in range(150):
        texts = [[pick.choice("abc") for _ in range(pick.randint(0, 14))] for _ in range(4)]
        known = SuffixAutomaton()
        for text in texts[:3]:
            known.add(text)
        wanted = texts[3]
        inside = {tuple(t[i:j]) for t in texts[:3] for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        covered = {k for i in range(len(wanted) - 2) if tuple(wanted[i:i + 3]) in inside for k in range(i, i + 3)}
        found = known.spans(wanted, 3)
        assert {k for a, b in found for k in range(a, b)} == covered
        assert all(tuple(wanted[a:b]) in inside for a, b in found)


def plain(rows, window):
    first = {}
    for i, text in rows:
        words = (text or "").encode().split()
        for at in range(len(words) - window + 1):
            if i is not None:
                key = tuple(words[at:at + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text in rows:
        words = (text or "").encode().split()
        gone = {k for at in range(len(words) - window + 1)
                if i is not None and first[tuple(words[at:at + window])] < i for k in range(at, at + window)}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [512, 3])
def test_random_overlaps(spark, shard):
    """Documents glued from few passages, with copies, ties, nulls and a hot passage; a small shard
    limit sends most of them by the way of hashes."""
    pick = random.Random(7)
    passages = [[pick.choice("abcdefgh") * pick.randint(1, 3) for _ in range(pick.randint(3, 40))]
                for _ in range(12)]
    rows = []
    for i in range(120):
        words = [w for _ in range(pick.randint(0, 5)) for w in pick.choice(passages)]
        words += [f"own{i}-{k}" for k in range(pick.randint(0, 9))] + passages[0]
        rows.append((i * 3, "\n".join(words)))
    rows += [(5, rows[7][1]), (5, rows[8][1]), (5, rows[8][1]), (None, rows[9][1]), (None, None), (8, None),
             (9, ""), (1000, " ".join(rows[3][1].split() * 300))]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows],
                                 "doc_id long, text string, begin int, anchor string")
    found = automaton.cut_repeats(docs, queries._digest, queries._DIGEST, window=10, gram=4, shard=shard)
    assert found.columns == ["doc_id", "begin", "anchor", "n_words", "n_removed", "kept_sha256"]
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()],
                  key=str) == plain(rows, 10)


def test_words_repeated_over_and_over():
    """One entry, whatever the period, and so one passage instead of one for every word."""
    for period in (1, 2, 7):
        hashes = automaton.word_hashes([b"w%d" % (i % period) for i in range(200_000)])
        tracemalloc.start()
        names, first, last = automaton.anchors(hashes, 50, 16)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert len(names) == 1 and (first[0], last[0]) == (0, 200_000 - 50) and peak < 200 << 20


def test_long_equal_texts(spark):
    rows = [(1, "word " * 20_000), (2, "word " * 20_000), (3, "word " * 70), (4, "x " * 60 + "word " * 49), (5, "a b " * 900),
            (6, "b a " * 30)]
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, n_words int")
    found = automaton.cut_repeats(docs, queries._digest, queries._DIGEST)
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, 50)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert automaton.cut_repeats(docs, queries._digest, queries._DIGEST).collect() == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    twin = duckdb.connect()
    twin.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    theirs = twin.sql(queries.ORACLES["op6_automaton"])
    found = queries.op6_automaton(spark, folder)
    assert found.columns == theirs.columns
    assert sorted(map(tuple, found.collect())) == sorted(theirs.fetchall())
