from collections import Counter

import corpus_pipeline
from pagetrove.llm import rules
from pagetrove.session import settled
from tests.llm import test_automaton, test_packing, test_simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    """Each stage on what the one before kept, every document checked."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    # Some copies, a null text, and a long passage in two documents.
    first = docs.where("length(text) > 3000").orderBy("doc_id").first()
    more = [(9001, first.text, first.lang, first.source, first.n_chars), (9002, None, "en", "s", 0),
            (9003, "some words of its own come first here and then " + first.text[:2500] + " the end", "en", "s", 0)]
    docs = settled(docs.unionByName(spark.createDataFrame(more, docs.schema)), "t")
    names = docs.columns

    kept = settled(corpus_pipeline.quality_rules(spark, docs, FOLDER), "t")
    assert kept.columns == names
    before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in kept.collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    verdict = {r.doc_id: r.kept for r in rules.judge(docs, labels).collect()}
    assert after == {i: r for i, r in before.items() if verdict[i]} and 9002 not in after
    assert 9001 in after and 9003 in after

    single = settled(corpus_pipeline.near_dedup(spark, kept, FOLDER), "t")
    groups = {i: least for i, _, least in test_simhash.expected([(i, r.text) for i, r in after.items()])}
    assert {r.doc_id: r for r in single.collect()} == {i: r for i, r in after.items() if groups[i] == i}

    cut = settled(corpus_pipeline.substring_dedup(spark, single, FOLDER), "t")
    assert cut.columns == names
    left = {r.doc_id: r for r in single.collect()}
    plain = {i: (n, gone) for i, n, gone, _ in test_automaton.plain([(i, r.text) for i, r in left.items()], 50)}
    rest = {r.doc_id: r for r in cut.collect()}
    assert plain[9003][1] >= 50
    assert set(rest) == {i for i, (n, gone) in plain.items() if gone < n or not gone}
    for i, r in rest.items():
        n, gone = plain[i]
        assert len(r.text.encode().split()) == n - gone and r.n_chars == len(r.text)
        assert gone or r.text == left[i].text

    mixed = settled(corpus_pipeline.mix_sources(spark, cut, FOLDER), "t")
    assert mixed.columns == names
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) == set(rest) and {(r.doc_id, r.text) for r in mixed.collect()} == {
        (i, r.text) for i, r in rest.items()}
    assert mixed.count() < 2 * cut.count()

    packed = corpus_pipeline.pack_sequences(spark, mixed, FOLDER).collect()
    test_packing.check([(r.doc_id, r.text) for r in mixed.collect()], packed)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        assert made.columns == docs.columns or name == "best-fit packing"
        docs = settled(made, "t")
    assert docs.count() == 0


def test_mixing_counts_all_documents(spark, tmp_path, monkeypatch):
    """Labels show as much of one language as of the other; most of the documents are of one."""
    rows = [(i, "one two three four" if i < 90 else "uno dos tres cuatro", "en" if i < 90 else "es", "s", 18)
            for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(80, 100)], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(corpus_pipeline, "TEMPER", 1.0)
    kept = corpus_pipeline.mix_sources(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(100))
    monkeypatch.setattr(corpus_pipeline, "TEMPER", 0.0)
    even = Counter(r.lang for r in corpus_pipeline.mix_sources(spark, docs, str(tmp_path)).collect())
    assert even["en"] <= 95 and 75 <= even["es"] <= 105
