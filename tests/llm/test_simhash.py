from itertools import combinations

import numpy as np
import pytest
import xxhash

from pagetrove.llm import simhash
from pagetrove.llm.components import connected


def plain_print(text, width=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = text.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def plain_groups(codes, limit):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a, b in combinations(set(codes), 2):
        if (a ^ b).bit_count() <= limit:
            root[find(a)] = find(b)
    return {c: find(c) for c in codes}


def expected(rows, width=3, limit=3):
    prints = [plain_print(text, width) for _, text in rows]
    groups = plain_groups(prints, limit)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[groups[p]] = min(i, least.get(groups[p], i))
    return sorted(((i, f"{p:016x}", least.get(groups[p])) for (i, _), p in zip(rows, prints)), key=str)


def test_awkward_rows(spark):
    words = [f"w{i}" for i in range(300)]
    rows = [(7, "A b c d e"), (3, "a B\tC\nd e"), (9, None), (8, ""), (5, " \x0b "), (1, "one"),
            (2, "one two"), (2, "one two"), (None, "one two"), (None, "alone here now"), (4, "É é\u00a0x"),
            (20, " ".join(words)), (21, " ".join(words[:299] + ["end"])), (22, "x " * 50_000)]
    docs = spark.createDataFrame([(i, t, 0, "r") for i, t in rows],
                                 "doc_id long, text string, code int, root string")
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)
    kept = [r.doc_id for r in simhash.keep_first(docs).collect()]
    assert set(kept) >= {None, 3, 1, 2} and 7 not in kept and 9 not in kept


def test_no_text_is_lost_with_its_doc_id(spark):
    a, b = "one two three four five six", "nothing of this is anywhere else at all"
    rows = [(1, a, 1), (5, a, 2), (5, b, 3), (5, b, 4), (6, None, 5), (7, None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    assert sorted(r.n for r in simhash.keep_first(docs).collect()) == [1, 3, 4, 5]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_first(docs).collect() == []


@pytest.mark.parametrize("pieces, run, leaf", [(4, 4096, 32), (5, 40, 4)])
def test_links_are_complete(spark, monkeypatch, pieces, run, leaf):
    """Clouds of codes around centres, with chains, small runs and leaves, against all pairs."""
    for name, value in (("RUN", run), ("LEAF", leaf), ("QUERIES", 7), ("FANOUT", 3)):
        monkeypatch.setattr(simhash, name, value)
    random = np.random.default_rng(5)
    codes = {int(x) for x in random.integers(0, 2**64, 300, dtype=np.uint64)}
    for centre in list(codes)[:12]:
        for _ in range(40):
            flips = random.choice(64, random.integers(1, 6), replace=False)
            codes.add(centre ^ sum(1 << int(f) for f in flips))
    # One crowded block: equal in the 32 leading bits.
    codes |= {(123 << 32) | int(x) for x in random.integers(0, 1 << 14, 500)}
    signed = np.array(sorted(codes), np.uint64).view(np.int64).tolist()
    written = simhash.settled(spark.createDataFrame([(c,) for c in signed], "code long"), "t")
    links = simhash.code_links(written, 3, pieces)
    for a, b in {(r.a, r.b) for r in links.collect()}:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 64
    roots = {r.node & (2**64 - 1): r.root for r in connected(links).collect()}
    groups = plain_groups(codes, 3)
    by_ours, by_theirs = {}, {}
    for c in codes:
        by_ours.setdefault(roots.get(c, c), set()).add(c)
        by_theirs.setdefault(groups[c], set()).add(c)
    assert {frozenset(v) for v in by_ours.values()} == {frozenset(v) for v in by_theirs.values()}


def test_runs_that_cannot_be_linked_do_not_meet(spark):
    """Runs of one head around distant and near centres, against all pairs of their codes."""
    random = np.random.default_rng(9)
    centres = [0, 0b111, 0b1111 << 20, 0xFFFF << 8, 2**39 - 1]
    runs, rows = {}, []
    for centre in centres:
        codes = [centre ^ int(x) << 3 for x in random.integers(0, 4, 6)]
        codes = np.unique(simhash.gray_rank(np.array(codes, np.uint64)))
        runs[int(codes[0])] = simhash.gray_code(codes)
        rows.append((1, 5, int(codes[0]), *simhash.top_pattern(simhash.gray_code(codes))))
    table = spark.createDataFrame(rows + [(1, 6, -1, 0, -1)], "part int, head long, run long, pattern long, fixed long")
    found = {(r.run_a, r.run_b) for r in simhash.near_runs(table, 3).collect()}
    linked = {(a, b) for a, b in combinations(sorted(runs), 2)
              if any(int(x ^ y).bit_count() <= 3 for x in runs[a] for y in runs[b])}
    assert linked and linked <= found and len(found) < len(runs) * (len(runs) - 1) // 2


def test_index_finds_all(monkeypatch):
    monkeypatch.setattr(simhash, "LEAF", 4)
    random = np.random.default_rng(1)
    codes = random.integers(0, 1 << 12, 700, dtype=np.uint64)
    codes = simhash.gray_code(np.unique(simhash.gray_rank(codes)))
    query, found = simhash.GrayIndex(codes).within(codes[:50], 2)
    ours = set(zip(query.tolist(), found.tolist()))
    assert ours == {(i, j) for i in range(50) for j in range(len(codes))
                    if int(codes[i] ^ codes[j]).bit_count() <= 2}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    roots = {r.node: r.root for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len({roots[i] for i in range(61)}) == 1 and len({roots[i] for i in range(100, 160)}) == 1
    assert roots[0] != roots[100] and len(roots) == 121


def test_test_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == expected(rows)
