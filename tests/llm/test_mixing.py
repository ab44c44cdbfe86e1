from collections import Counter

import numpy as np
import pytest
import regex
from conftest import plan
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from pagetrove.llm import mixing, queries


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "uno dos tres"), (3, "uno dos tres"), (None, "one two"), (5, "one " * 20_000),
            (6, "three"), (7, "\u00e9")]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, row int, p string")
    labelled = spark.createDataFrame([("one two three", "en"), ("uno dos", "es"), (None, "es"), ("x", None)],
                                     "text string, domain string")
    found = mixing.mix(docs, labelled, {"en": 0.5, "es": 0.5, "fr": 1.0})
    got = {(r.doc_id, r.n_tokens): r for r in found.collect()}
    assert found.count() == len(rows) and (5, 20_000) in got and (1, 0) in got
    assert got[3, 3].posteriors[1] > 0.8 and got[6, 1].posteriors[0] > 0.4
    assert abs(sum(got[1, 0].posteriors) - 1) < 1e-12
    back = mixing.repeat_rows(docs, found)
    assert back.columns == docs.columns
    assert back.where("doc_id = 6").count() == got[6, 1].copies
    nothing = mixing.mix(docs, labelled.limit(0), {"en": 1.0}).collect()
    assert len(nothing) == len(rows) and {r.rate for r in nothing} == {1.0}
    assert mixing.mix(docs.limit(0), labelled, {"en": 1.0}).collect() == []


def plain_rates(tokens, p, targets, least, steps=5000):
    """Projected gradient by numpy, with a small step and many rounds."""
    rates = np.full(len(tokens), max(1.0, least))
    mass = (tokens[:, None] * p).sum(axis=0)
    for _ in range(steps):
        gap = (tokens[:, None] * p * rates[:, None]).sum(axis=0) - targets
        rates = np.maximum(least, rates - 0.3 * p @ (gap / mass))
    return rates


def test_rates_meet_targets(spark):
    random = np.random.default_rng(3)
    p = random.dirichlet([0.2, 0.3, 0.5], 400)
    tokens = random.integers(1, 500, 400)
    members = mixing.settled(spark.createDataFrame(
        [(int(t), [float(v) for v in row]) for t, row in zip(tokens, p)], "n_tokens long, p array<double>"), "t")
    for least, targets in ((0.0, [0.5, 0.3, 0.2]), (0.4, [0.2, 0.3, 0.5])):
        steps = mixing.fit_rates(members, targets, least, float(tokens.sum()))
        rated = members.withColumn("rate", mixing.rate(steps, least)).collect()
        rates = np.array([r.rate for r in rated])
        made = sum(r.n_tokens * r.rate * np.array(r.p) for r in rated)
        assert (rates >= least).all()
        assert np.allclose(made / made.sum(), targets, atol=2e-3)
        ordered = {(r.n_tokens, tuple(r.p)): r.rate for r in rated}
        theirs = plain_rates(tokens, p, np.array(targets) * tokens.sum(), least)
        ours = np.array([ordered[int(t), tuple(float(v) for v in row)] for t, row in zip(tokens, p)])
        assert np.abs(ours - theirs).max() < 0.05
    kept = mixing.fit_rates(members, [0.3, 0.3, 0.4], 1.0)
    made = members.withColumn("rate", mixing.rate(kept, 1.0)).agg(F.min("rate")).first()[0]
    assert made >= 1.0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op8_mixing(spark, folder).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in found) == sorted(langs)
    right = [r.domain == langs[r.doc_id] for r in found]
    assert sum(right) > 0.97 * len(right)
    for domain, share in queries.MIX.items():
        mixed = sum(r.n_tokens * r.rate for r in found if r.domain == domain)
        taken = sum(r.n_tokens * r.copies for r in found if r.domain == domain)
        total = sum(r.n_tokens * r.rate for r in found)
        assert abs(mixed / total - share) < 0.01 and abs(taken / total - share) < 0.05


def _members(spark, *rows):
    return mixing.settled(spark.createDataFrame(list(rows), "n_tokens long, p array<double>"), "t")


def test_targets_out_of_reach_are_told(spark):
    members = _members(spark, (100, [0.55, 0.45]), (300, [0.55, 0.45]))
    found, residual, met = mixing.rated(members, [0.9, 0.1], 0.0)
    made = sum(r.n_tokens * r.rate * np.array(r.p) for r in found.collect())
    assert not met and np.allclose(np.abs(made - [360, 40]).max() / 400, residual) and residual > 0.05
    # A domain without tokens cannot be met either.
    _, residual, met = mixing.rated(_members(spark, (100, [1.0, 0.0])), [0.5, 0.5])
    assert not met and residual <= mixing.TOLERANCE
    labelled = spark.createDataFrame([("one two", "en"), ("one dos", "es")], "text string, domain string")
    docs = spark.createDataFrame([(1, "one one"), (2, "one")], "doc_id long, text string")
    assert {r.converged for r in mixing.mix(docs, labelled, {"en": 0.9, "es": 0.1}).collect()} == {False}
    with pytest.raises(ValueError, match="out of reach"):
        mixing.mix(docs, labelled, {"en": 0.9, "es": 0.1}, strict=True)


def test_steps_go_on_while_they_help(spark):
    members = _members(spark, (1000, [0.7, 0.3]), (1000, [0.3, 0.7]))
    assert len(mixing.fit_rates(members, [0.65, 0.35])) == mixing.STEPS
    found, residual, met = mixing.rated(members, [0.65, 0.35])
    rows = found.collect()
    made = sum(r.n_tokens * r.rate * np.array(r.p) for r in rows)
    assert met and residual <= mixing.TOLERANCE and np.allclose(made / made.sum(), [0.65, 0.35], atol=2e-4)
    assert min(r.rate for r in rows) >= 0
    empty, residual, met = mixing.rated(members.limit(0), [0.5, 0.5])
    assert empty.collect() == [] and not met


def test_posteriors_against_numpy(spark):
    """Naive Bayes counted anew, word by word."""
    labelled = [("One two two three", "en"), ("uno dos \u00c9t\u00e9", "es"), ("two dos, x1y", "en"), ("", "fr")]
    texts = ["two two uno", "", None, "\u00c9T\u00c9 one-x", "unseen"]

    def buckets(text):
        words = regex.findall(r"\p{L}+", (text or "").lower())
        return [xxh64_intdigest(word.encode(), seed=42) % mixing.BUCKETS for word in words]

    domains = ["en", "es", "fr"]
    counts = {d: Counter(b for text, name in labelled if name == d for b in buckets(text)) for d in domains}
    priors = np.log([sum(name == d for _, name in labelled) / len(labelled) for d in domains])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = mixing.posteriors(docs, *mixing.fit_classifier(spark.createDataFrame(labelled, "text string, domain string")))
    got = {r.doc_id: r for r in found.collect()}
    for i, text in enumerate(texts):
        logs = priors + [sum(np.log((counts[d][b] + 1) / (counts[d].total() + mixing.BUCKETS)) for b in buckets(text))
                         for d in domains]
        chances = np.exp(logs - logs.max())
        assert got[i].n_tokens == len(buckets(text)) and np.allclose(got[i].p, chances / chances.sum())


def test_all_labelled_documents_teach(spark, tmp_path):
    rows = 260_000
    docs = spark.range(rows).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit("en").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.trusted_languages(spark, str(tmp_path)).count() == rows
    # Ids too many to be broadcast are joined by a shuffle, with the same rows.
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        found = queries.trusted_languages(spark, str(tmp_path))
        assert "BroadcastHashJoin" not in plan(found) and found.count() == rows
    finally:
        spark.conf.set(threshold, before)


def test_labelled_texts_are_not_shuffled(spark, tmp_path):
    """Ids too many to be broadcast, repeated and null ones, rows of several files, some without any
    labelled row near them."""
    rows = 60_000
    docs = spark.range(rows, numPartitions=3).select(
        F.when(F.col("id") % 1000 != 0, F.floor(F.col("id") / 2)).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("en").alias("lang"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(rows).select(
        F.when(F.col("id") % 7 != 0, F.floor(F.col("id") / 2)).alias("doc_id"),
        F.when(F.col("id") % 5 != 0, F.lit(1)).alias("quality"),
        F.when(F.col("id") < 38_000, (F.col("id") % 3 == 0).cast("int")).alias("toxic"),
    ).write.parquet(f"{tmp_path}/labels.parquet")
    good = spark.read.parquet(f"{tmp_path}/labels.parquet").where("quality = 1 AND toxic = 0")
    wanted = sorted(r.text for r in docs.join(good, "doc_id", "left_semi").collect())
    assert 10_000 < len(wanted) < rows
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        for size in ("64k", "-1"):
            spark.conf.set(threshold, size)
            found = queries.trusted_languages(spark, str(tmp_path))
            assert sorted(r.text for r in found.collect()) == wanted
            assert ("SortMergeJoin" in plan(found)) == (size == "-1")
            assert {r.domain for r in found.collect()} == {"en"}
    finally:
        spark.conf.set(threshold, before)


def test_targets_from_all_tokens(spark):
    labelled = spark.createDataFrame([("one two three", "en"), ("uno dos tres", "es")], "text string, domain string")
    docs = spark.createDataFrame([(1, "one two " * 30), (2, "uno dos " * 10), (3, None)], "doc_id long, text string")
    given = []

    def targets(tokens):
        given.append(tokens)
        return {"en": 1.0, "es": 1.0}

    found = {r.doc_id: r for r in mixing.mix(docs, labelled, targets, least=1.0).collect()}
    assert abs(given[0]["en"] - 60) < 0.5 and abs(given[0]["es"] - 20) < 0.5
    assert found[2].rate > 2.5 and found[1].rate < 1.1
    nothing = mixing.mix(docs, labelled.limit(0), targets).collect()
    assert given[1] == {} and {r.rate for r in nothing} == {1.0}
