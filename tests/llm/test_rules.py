import random

from pyspark.sql import functions as F

from pagetrove.llm import queries, rules


def plain_counts(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_counts_against_plain_python():
    pick = random.Random(1)
    texts = ["", " \x0b\n", "a", "a b c d e a b c d e", "x y\nx y\n\n \nx y \nx y", "é#ü|  < \U0001f600 %"]
    for size in (3, 12, 60, 200):
        texts += [" ".join(pick.choice(["a", "bé", "c", "d\n", "*e"]) for _ in range(size)) for _ in range(10)]
    for text in texts:
        assert rules.text_counts(text.encode())[:5] == plain_counts(text)


def test_many_distinct_words():
    words = [str(i).encode() for i in range(70_000)]
    assert rules.repeated_words(words + words[10:17]) == (14, 70_000)


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (2, "a b c"), (None, "ok " + " ".join(map(str, range(30)))),
            (4, "same " * 40), (4, "same " * 40), (5, " ".join(map(str, range(30_000))))]
    docs = spark.createDataFrame([(i, t, 3, "k") for i, t in rows],
                                 "doc_id long, text string, n_words int, kept string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = rules.judge(docs, labels)
    assert sorted([(r.doc_id, r.n_words, r.kept) for r in found.collect()], key=str) == sorted(
        [(1, 0, False), (2, 0, False), (2, 3, False), (None, 31, True), (4, 40, False), (4, 40, False),
         (5, 30_000, True)], key=str)
    kept = rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None, 5}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(empty, labels).collect() == []


def test_learns_a_conjunction(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), *[F.lit(100).cast("long").alias(c) for c in rules.COUNTS]
    ).withColumns({"n_words": 20 + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(200)),
                   "n_upper": F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(100))})
    bad = (F.col("n_words") > 120) & (F.col("n_upper") <= 50)
    found = rules.learn(rows.withColumn("bad", bad))
    assert found and {c.feature for c in found[0].conditions} >= {"upper_share"}
    judged = rows.withColumn("kept", rules.decision(found)).withColumn("bad", bad)
    wrong = judged.where(F.col("kept") == F.col("bad")).count()
    assert wrong < 0.05 * 6000
    assert rules.learn(rows.withColumn("bad", F.lit(False))) == []


def test_query_rejects_bad_and_keeps_good(spark):
    found = {r.doc_id: r for r in queries.op10_rules(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(found) == len(docs)
    for row in docs[:200]:
        r = found[row.doc_id]
        assert plain_counts(row.text) == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [found[r.doc_id].kept for r in labels if r.quality == 1]
    bad = [found[r.doc_id].kept for r in labels if r.quality == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)
