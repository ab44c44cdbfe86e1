import glob
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pagetrove.plans.steps import DocumentSearch
from pagetrove.sources import collection as store

TEXTS = {
    "glaciers.pdf": "forms of mountain glaciers\fretreat of mountain glaciers\f",
    "cars.pdf": "electric cars and batteries\fold cars\f",
    "bread.PDF": "how to bake bread with yeast",
}


@pytest.fixture(scope="module")
def flow(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("input")
    for name, text in TEXTS.items():
        (folder / name).write_text(text)
    output = str(tmp_path_factory.mktemp("output"))
    made = DocumentSearch(spark, str(tmp_path_factory.mktemp("stored")))
    parsed = made.extract_text(str(folder), "form_feed", output=output)
    chunks = made.generate_chunks(parsed, output=output)
    made.embed_and_store(chunks, nlist=3)
    made.output = output
    return made


def test_ids_are_dense(spark, flow):
    rows = store.read_collection(spark, f"{flow.collection}/rows").sort("id").collect()
    assert [r.id for r in rows] == [1, 2, 3, 4, 5]
    assert sorted(r.page_content for r in rows) == sorted(
        p for t in TEXTS.values() for p in t.split("\f") if p)


@pytest.mark.parametrize("exact", [True, False])
def test_retrieve(flow, exact):
    hits = flow.retrieve("what are the forms of mountain glaciers", threshold=0.1, exact=exact, nprobe=3)
    rows = hits.sort("rank").collect()
    assert rows[0].page_content == "forms of mountain glaciers" and rows[0]["rank"] == 1
    assert all(a.score >= b.score > 0.1 for a, b in zip(rows, rows[1:]))


def test_defaults_and_zero_values(flow):
    query = "forms of mountain glaciers"
    default = flow.retrieve(query, exact=True).collect()
    assert [r.score for r in default] == [pytest.approx(1.0), pytest.approx(0.75)]
    assert len(flow.retrieve(query, threshold=0.0, exact=True).collect()) == 3
    with pytest.raises(ValueError):
        flow.retrieve(query, limit=0)


def test_filter_and_fields(flow):
    hits = flow.retrieve("mountain glaciers", threshold=0.0, expr="page_content like 'retreat%'",
                         output_fields=["metadata"], exact=True)
    assert hits.columns == ["query_id", "rank", "id", "score", "metadata"]
    assert hits.count() == 1


def test_many_queries(spark, flow):
    asked = spark.createDataFrame([("q1", "old cars"), ("q2", "bake bread")], "query_id string, text string")
    hits = flow.retrieve(asked, threshold=0.2, limit=1, exact=True).collect()
    assert {r.query_id: r.page_content for r in hits} == {
        "q1": "old cars", "q2": "how to bake bread with yeast"}


def test_written_output(spark, flow):
    summary = spark.read.csv(f"{flow.output}/doc_summary", header=True).collect()
    assert sorted((r.file_path.rsplit("/", 1)[1], r.page_count, r.chunk_counts) for r in summary) == [
        ("bread.PDF", "1", "1"), ("cars.pdf", "2", "2"), ("glaciers.pdf", "2", "2")]
    lines = [r.value for r in spark.read.text(f"{flow.output}/chunks/report").collect()]
    assert sum(" Chunk 2 " in line for line in lines) == 2
    assert len(spark.read.text(f"{flow.output}/extracted_text/report").collect()) > 5


def pages(spark, *texts):
    rows = [("s", i, t, "{}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source string, page int, page_content string, metadata string")


@pytest.mark.parametrize("kind", ["hash", "tfidf"])
def test_add_and_repair(spark, tmp_path, monkeypatch, kind):
    made = DocumentSearch(spark, str(tmp_path / "s"), kind)
    made.embed_and_store(pages(spark, "red apples", "green pears"), nlist=2)
    # Another object over the same collection, which has to find its weights.
    later = DocumentSearch(spark, str(tmp_path / "s"), kind)
    added = later.add(pages(spark, "blue plums", "red plums"))
    assert sorted(r.id for r in added.collect()) == [3, 4]
    for exact in (True, False):
        hits = later.retrieve("red plums", threshold=0.1, limit=9, nprobe=9, exact=exact).sort("rank").collect()
        assert [r.page_content for r in hits][0] == "red plums" and len(hits) == 3
    # The index is not reached.
    monkeypatch.setattr("pagetrove.operators.index.append_to_index", None)
    with pytest.raises(TypeError):
        later.add(pages(spark, "yellow quinces"))
    monkeypatch.undo()
    assert later.retrieve("quinces", threshold=0.1, nprobe=9).collect() == []
    assert later.repair() == 1 and later.repair() == 0
    assert [r.id for r in later.retrieve("quinces", threshold=0.1, nprobe=9).collect()] == [5]


@pytest.mark.parametrize("kind", ["hash", "tfidf"])
def test_a_collection_may_start_empty(spark, tmp_path, kind):
    made = DocumentSearch(spark, str(tmp_path / "s"), kind)
    made.embed_and_store(pages(spark, "x").limit(0))
    assert made.retrieve("red plums").collect() == [] and made.retrieve("red plums", exact=True).collect() == []
    made.add(pages(spark, "red plums"))
    assert [r.id for r in made.retrieve("red plums").collect()] == [1]


def test_texts_are_stored_once(spark, flow, tmp_path):
    cells = spark.read.parquet(f"{flow.collection}/index/cells")
    assert set(cells.columns) == {"id", "metadata", "embeddings", "cell", "__cosine"}
    made = DocumentSearch(spark, str(tmp_path / "s"))
    before = set(glob.glob(scratch(spark)))
    made.embed_and_store(pages(spark, "red apples", "green pears"), nlist=2)
    assert not [p for p in set(glob.glob(scratch(spark))) - before if os.path.basename(p).startswith("rows-")]


def scratch(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/scratch-{spark.sparkContext.applicationId}/*"


@pytest.mark.parametrize("expr", [None, "page_content like '%mountain%'", "id < 4", "metadata is not null",
                                  "id > 1 and page_content like '%o%'", "id < 0"])
def test_index_without_texts_gives_what_exact_search_gives(flow, expr):
    options = {"threshold": -2.0, "limit": 4, "expr": expr, "output_fields": ["metadata", "page_content"]}
    exact = flow.retrieve("mountain cars", exact=True, **options)
    probed = flow.retrieve("mountain cars", nprobe=9, **options)
    assert probed.columns == exact.columns
    assert sorted(probed.collect()) == sorted(exact.collect())
    assert (exact.count() == 0) == (expr == "id < 0")


def test_a_filter_that_no_table_understands(flow):
    with pytest.raises(AnalysisException):
        flow.retrieve("cars", expr="colour = 'red'")
    with pytest.raises(ValueError, match="may not be named"):
        flow.retrieve("cars", output_fields=["score"])


def picky(content, path):
    if b"cars" in content:
        raise ValueError("no cars")
    return [content.decode()]


def test_bad_files_are_set_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in TEXTS.items():
        (tmp_path / "in" / name).write_text(text)
    made = DocumentSearch(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="1 files could not be parsed"):
        made.extract_text(str(tmp_path / "in"), picky, output=str(tmp_path / "out"))
    parsed = made.extract_text(str(tmp_path / "in"), picky, output=str(tmp_path / "out"), most_failures=1)
    assert sorted(r.source.rsplit("/", 1)[1] for r in parsed.collect()) == ["bread.PDF", "glaciers.pdf"]
    failed = spark.read.parquet(str(tmp_path / "out" / "extracted_text" / "documents" / "failed=true"))
    assert [r.error for r in failed.collect()] == ["ValueError: no cars"]


def test_distinct_texts_and_variant_metadata(spark, tmp_path):
    texts = ["red apples", "green pears", "red apples", "red apples"]
    chunks = pages(spark, *texts).withColumn("metadata", F.format_string('{"page": %d}', "page"))
    plain, other = (DocumentSearch(spark, str(tmp_path / name)) for name in ("plain", "other"))
    plain.embed_and_store(chunks, nlist=2)
    other.embed_and_store(chunks, nlist=2, distinct=True, variant=True)
    for exact in (True, False):
        options = {"threshold": 0.1, "limit": 9, "nprobe": 9, "exact": exact}
        assert sorted(plain.retrieve("red apples", **options).collect()) == sorted(
            other.retrieve("red apples", **options).collect())
        hits = other.retrieve("red apples", expr="variant_get(metadata, '$.page', 'int') > 1", **options)
        assert hits.count() == 2
    other.add(chunks.where("page = 1"))
    assert other.retrieve("green pears", threshold=0.1, limit=9, nprobe=9,
                          expr="variant_get(metadata, '$.page', 'int') = 1").count() == 2
