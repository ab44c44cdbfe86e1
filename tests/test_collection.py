import pytest
from conftest import plan
from pyspark.sql import functions as F

from pagetrove.operators import search as nn
from pagetrove.session import replace_folder
from pagetrove.sources import collection as C
from pagetrove.sources import tables

SCHEMA = "id long, page_content string, metadata string, embeddings array<float>"
ROWS = [(1, "a", '{"page":0}', [1.0, 2.0]), (2, "b", '{"page":1}', [3.0, 4.0])]


@pytest.fixture(params=["path", "table"])
def target(request, spark, tmp_path):
    if request.param == "path":
        yield str(tmp_path / "c")
    else:
        yield "kept_rows"
        spark.sql("DROP TABLE IF EXISTS kept_rows")


def test_create_replace_append(spark, target):
    assert not C.collection_exists(spark, target)
    C.create_collection(spark.createDataFrame(ROWS, SCHEMA), target)
    assert C.collection_exists(spark, target)
    C.insert(spark.createDataFrame([(3, "c", None, [5.0, 6.0])], SCHEMA), target)
    assert sorted(r.id for r in C.read_collection(spark, target).collect()) == [1, 2, 3]
    C.create_collection(spark.createDataFrame(ROWS[:1], SCHEMA), target)
    stored = C.read_collection(spark, target, persist=True)
    assert [tuple(r) for r in stored.collect()] == [(1, "a", '{"page":0}', [1.0, 2.0])]
    assert stored.columns == [f.name for f in C.SCHEMA]
    stored.unpersist()


BROKEN = {
    "null_id": (None, "a", None, [1.0, 2.0]),
    "text_too_long": (4, "é" * 2501, None, [1.0, 2.0]),
    "null_vector": (4, "a", None, None),
    "wrong_dimension": (4, "a", None, [1.0]),
    "null_element": (4, "a", None, [1.0, None]),
}


@pytest.mark.parametrize("rule", BROKEN)
def test_a_broken_row_fails_the_write(spark, tmp_path, rule):
    df = spark.createDataFrame(ROWS + [BROKEN[rule]], SCHEMA).coalesce(1)
    with pytest.raises(Exception, match=rule):
        C.create_collection(df, str(tmp_path / "c"))


def test_text_of_the_greatest_length_is_kept(spark, tmp_path):
    C.create_collection(spark.createDataFrame([(1, "é" * 2500, None, [1.0])], SCHEMA), str(tmp_path / "c"))


def test_insert_keeps_the_dimension(spark, tmp_path):
    path = str(tmp_path / "c")
    C.create_collection(spark.createDataFrame(ROWS, SCHEMA), path)
    with pytest.raises(Exception, match="wrong_dimension"):
        C.insert(spark.createDataFrame([(9, "a", None, [1.0, 2.0, 3.0])], SCHEMA), path)


def test_violations(spark):
    rows = ROWS + list(BROKEN.values()) + [(1, "again", None, [0.0, 0.0]), (None, "n", None, [0.0, 0.0])]
    got = {r.rule: r.violations for r in C.collection_violations(spark.createDataFrame(rows, SCHEMA), 2).collect()}
    assert got == {"null_id": 2, "text_too_long": 1, "null_vector": 1, "wrong_dimension": 1,
                   "null_element": 1, "duplicate_id": 4}


def test_violations_of_an_empty_table(spark):
    got = C.collection_violations(spark.createDataFrame([], SCHEMA), 2).collect()
    assert len(got) == 6 and all(r.violations == 0 for r in got)


def test_dimension(spark):
    assert tuple(C.vector_dimension(spark.createDataFrame(ROWS, SCHEMA)).first()) == (2, 2)


def test_csv_keeps_line_breaks_quotes_and_nulls(spark, tmp_path):
    docs = [{"page_content": 'a "q"\nb, \\n', "metadata": '{"page":0}'}, {"page_content": "", "metadata": "{}"}]
    schema = ("source string, loaded_docs array<struct<page_content: string, metadata: string>>, "
              "page_count int, cleaned_text array<string>")
    df = spark.createDataFrame([("x, y", docs, 2, ["a", ""]), (None, [], 0, [])], schema)
    tables.write_csv(df, str(tmp_path / "csv"))
    flat = "source string, loaded_docs string, page_count int, cleaned_text string"
    back = tables.read_csv(spark, str(tmp_path / "csv"), flat)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert spark.read.text(str(tmp_path / "csv")).where(F.col("value").contains("x, y")).count() == 1


def test_ids_are_a_key(spark, target):
    C.create_collection(spark.createDataFrame(ROWS, SCHEMA), target)
    for batch in ([(2, "again", None, [0.0, 1.0])], [(7, "a", None, [0.0, 1.0]), (7, "b", None, [0.0, 1.0])]):
        with pytest.raises(ValueError, match="ids"):
            C.insert(spark.createDataFrame(batch + [(9, "n", None, [0.0, 1.0])], SCHEMA), target)
        assert sorted(r.id for r in C.read_collection(spark, target).collect()) == [1, 2]
    C.insert(spark.createDataFrame([], SCHEMA), target)
    assert C.read_collection(spark, target).count() == 2


def test_upsert(spark, target):
    C.create_collection(spark.createDataFrame(ROWS, SCHEMA), target)
    C.upsert(spark.createDataFrame([(2, "new", None, [0.0, 1.0]), (3, "more", None, [2.0, 1.0])], SCHEMA), target)
    rows = {r.id: (r.page_content, r.embeddings) for r in C.read_collection(spark, target).collect()}
    assert rows == {1: ("a", [1.0, 2.0]), 2: ("new", [0.0, 1.0]), 3: ("more", [2.0, 1.0])}
    with pytest.raises(ValueError, match="more than once"):
        C.upsert(spark.createDataFrame([(5, "a", None, [0.0, 1.0])] * 2, SCHEMA), target)
    with pytest.raises(Exception, match="wrong_dimension"):
        C.upsert(spark.createDataFrame([(5, "a", None, [0.0])], SCHEMA), target)
    assert C.read_collection(spark, target).count() == 3


def test_many_ids_are_joined_without_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "BROADCAST_IDS", 0)
    path = str(tmp_path / "c")
    C.create_collection(spark.createDataFrame(ROWS, SCHEMA), path)
    with pytest.raises(ValueError, match="stored already"):
        C.insert(spark.createDataFrame(ROWS[:1], SCHEMA), path)


def test_a_failed_switch_keeps_the_old_rows(spark, target, monkeypatch):
    C.create_collection(spark.createDataFrame(ROWS, SCHEMA), target)
    run = type(spark).sql

    def fails(session, query, *args, **kwargs):
        if "_new_" in query and "RENAME" in query:
            raise OSError("broken in the middle")
        return run(session, query, *args, **kwargs)

    def no_folder(session, source, destination):
        replace_folder(session, source + "-not-there", destination)

    monkeypatch.setattr(type(spark), "sql", fails)
    monkeypatch.setattr(C, "replace_folder", no_folder)
    with pytest.raises(Exception, match="not-there|in the middle"):
        C.create_collection(spark.createDataFrame(ROWS[:1], SCHEMA), target)
    monkeypatch.undo()
    assert sorted(r.id for r in C.read_collection(spark, target).collect()) == [1, 2]
    C.create_collection(spark.createDataFrame(ROWS[:1], SCHEMA), target)
    assert C.read_collection(spark, target).count() == 1


def test_nothing_is_left_beside(spark, tmp_path):
    path = str(tmp_path / "c")
    for _ in range(2):
        C.create_collection(spark.createDataFrame(ROWS, SCHEMA), path)
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["c"]


VARIANT_ROWS = [(1, "a", '{"page": 1, "who": {"name": "x"}}', [1.0, 0.0]), (2, "b", '{"page": "2"}', [0.0, 1.0]),
                (3, "c", None, [1.0, 1.0])]


def test_variant_metadata(spark, tmp_path):
    path = str(tmp_path / "c")
    C.create_collection(spark.createDataFrame(VARIANT_ROWS, SCHEMA), path, variant=True)
    C.insert(spark.createDataFrame([(4, "d", '{"page": 7}', [2.0, 0.0])], SCHEMA), path)
    C.upsert(spark.createDataFrame([(2, "b", '{"page": 3}', [0.0, 1.0])], SCHEMA), path)
    stored = C.read_collection(spark, path)
    assert C.has_variant(stored)
    pages = stored.selectExpr("id", "variant_get(metadata, '$.page', 'int') AS page").sort("id").collect()
    assert [tuple(r) for r in pages] == [(1, 1), (2, 3), (3, None), (4, 7)]
    hits = nn.search(stored, spark.createDataFrame([(0, [1.0, 0.1])], "query_id int, embeddings array<float>"), 5,
                     expr="variant_get(metadata, '$.who.name', 'string') = 'x'")
    assert [r.id for r in hits.collect()] == [1]
    # Back to text, in a collection without the option.
    C.create_collection(stored, str(tmp_path / "text"))
    text = C.read_collection(spark, str(tmp_path / "text"))
    assert not C.has_variant(text) and text.where("id = 4").first().metadata == '{"page":7}'


def test_variant_metadata_has_to_be_json(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "no json", [1.0])], SCHEMA)
    with pytest.raises(Exception, match="metadata_not_json"):
        C.create_collection(rows, str(tmp_path / "c"), variant=True)
    assert not C.collection_exists(spark, str(tmp_path / "c"))


def test_variant_filter_reads_the_named_path_only(spark, tmp_path):
    path = str(tmp_path / "c")
    C.create_collection(spark.createDataFrame(VARIANT_ROWS, SCHEMA), path, variant=True)
    spark.conf.set("spark.sql.variant.pushVariantIntoScan", "true")
    try:
        text = plan(C.read_collection(spark, path).where("variant_get(metadata, '$.page', 'int') < 3").select("id"))
    finally:
        spark.conf.unset("spark.sql.variant.pushVariantIntoScan")
    # The scan reads a struct of the wanted paths in the place of the whole value.
    assert "metadata:struct<0:int>" in text
