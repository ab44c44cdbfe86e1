import json
import sys
import types

import pytest
from pyspark.sql import functions as F

from pagetrove.functions import text as X
from pagetrove.operators import report
from pagetrove.sources import files, parsers


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    for name, text in {"a.pdf": "one\ftwo http://x.y \f", "b.PDF": "three", "c.txt": "no", "sub/d.pdf": "deep"}.items():
        (tmp_path / name).write_bytes(text.encode())
    return tmp_path


def names(df):
    return sorted(r.path.rsplit("/", 1)[1] for r in df.select("path").collect())


def test_scan_ignores_case_and_sub_folders(spark, folder):
    assert names(files.scan_files(spark, str(folder))) == ["a.pdf", "b.PDF"]
    assert names(files.scan_files(spark, str(folder), recursive=True)) == ["a.pdf", "b.PDF", "d.pdf"]
    assert names(files.scan_files(spark, str(folder / "a.pdf"))) == ["a.pdf"]


def test_scan_wants_at_least_one_file(spark, folder):
    with pytest.raises(ValueError):
        files.scan_files(spark, str(folder), ".docx")
    with pytest.raises(ValueError):
        files.scan_files(spark, str(folder / "c.txt"))


def test_parse(spark, folder):
    parsed = files.parse_files(files.scan_files(spark, str(folder)), "form_feed")
    rows = {r.source.rsplit("/", 1)[1]: r for r in parsed.collect()}
    assert rows["a.pdf"].page_count == 2 and rows["a.pdf"].cleaned_text == ["one", "two"]
    assert rows["a.pdf"].parse_time >= 0
    pages = files.page_rows(parsed).sort("source", "page").collect()
    assert [(r.page, r.page_content) for r in pages] == [(0, "one"), (1, "two http://x.y "), (0, "three")]
    assert json.loads(pages[1].metadata) == {"source": pages[1].source, "page": 1}


def elements(content, path):
    return [("t", {"category": "Title"}), "plain"]


def test_own_parser_with_metadata(spark, folder):
    pages = files.page_rows(files.parse_files(files.scan_files(spark, str(folder / "a.pdf")), elements))
    assert [json.loads(r.metadata).get("category") for r in pages.sort("page").collect()] == ["Title", None]


def failing(content, path):
    raise RuntimeError("cannot parse")


def test_parser_errors_fail_the_job(spark, folder):
    with pytest.raises(Exception, match="cannot parse"):
        files.parse_files(files.scan_files(spark, str(folder)), failing).collect()


def test_registry():
    with pytest.raises(ValueError):
        parsers.parser("PDFPlumberLoader")
    parsers.register_parser("mine", elements)
    assert parsers.parser("mine") is elements


def test_missing_column(spark):
    with pytest.raises(ValueError, match="loaded_docs"):
        files.page_rows(spark.range(1))


class _Page:
    def extract_text(self):
        return "p"

    def get_text(self):
        return "p"

    def get_textpage(self):
        return types.SimpleNamespace(get_text_range=lambda: "p")


class _Document(list):
    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


def test_pdf_parsers_with_stand_in_packages(monkeypatch):
    def module(name, **parts):
        made = types.ModuleType(name)
        made.__dict__.update(parts)
        monkeypatch.setitem(sys.modules, name, made)

    document = _Document([_Page(), _Page()])
    module("pypdf", PdfReader=lambda stream: types.SimpleNamespace(pages=list(document)))
    module("fitz", open=lambda stream, filetype: document)
    module("pypdfium2", PdfDocument=lambda content: document)
    module("pdfminer")
    module("pdfminer.high_level", extract_text=lambda stream: "all")
    module("unstructured")
    module("unstructured.partition")

    class Element(str):
        category = "Title"

    module("unstructured.partition.auto", partition=lambda file, metadata_filename: [Element("e")])
    for name in ("PyPDFLoader", "PyMuPDFLoader", "PyPDFium2Loader"):
        assert list(parsers.parser(name)(b"", "x.pdf")) == ["p", "p"]
    assert parsers.parser("PDFMinerLoader")(b"", "x.pdf") == ["all"]
    assert parsers.parser("UnstructuredFileLoader")(b"", "x") == [("e", {"category": "Title"})]


def test_page_arrays_split_large_documents(spark):
    pages = spark.range(0, 25).select(
        F.when(F.col("id") < 23, "hot").otherwise("b").alias("source"),
        F.when(F.col("id") < 23, F.col("id")).otherwise(F.col("id") - 23).alias("page"),
        F.col("id").cast("string").alias("page_content"))
    rows = files.page_arrays(pages, per_row=10).sort("source", "part").collect()
    assert [(r.source, r.part, len(r.pages)) for r in rows] == [
        ("b", 0, 2), ("hot", 0, 10), ("hot", 1, 10), ("hot", 2, 3)]
    assert [p for r in rows if r.source == "hot" for p in r.pages] == [str(i) for i in range(23)]


def test_report_files_hold_pages_in_order(spark, tmp_path):
    pages = spark.range(0, 200, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "dir/hot one").otherwise("b").alias("source"),
        F.col("id").cast("int").alias("page"), F.format_string("text %d", "id").alias("page_content"))
    path = str(tmp_path / "report")
    report.write_report(report.page_report(pages), path, "page")
    parts = sorted((tmp_path / "report" / "source=dir%2Fhot one").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert [line for line in text.split("\n") if line.startswith("text")] == [
        f"text {i}" for i in range(200) if i % 10]
    assert f"{'*' * 40} Page 2 {'*' * 40}\ntext 1\n" in text


def test_summaries_agree(spark):
    from pagetrove.operators import chunking

    pages = spark.createDataFrame(
        [("a", 0, "x y z"), ("a", 1, " "), ("b", 0, None), ("c", 0, "q")],
        "source string, page int, page_content string")
    split = chunking.with_splits(pages, 2, 0, chunking.TOKENS)
    one = sorted(report.document_summary(split, "m").collect(), key=str)
    two = sorted(report.summary_of(pages, chunking.explode_chunks(split), "m").collect(), key=str)
    assert one == two == sorted([("a", 2, 2, "m"), (None, 1, 0, "m"), ("c", 1, 1, "m")], key=str)


def reads_some(content, path):
    if b"three" in content:
        raise RuntimeError("cannot parse three")
    yield "page"
    if b"one" in content:
        raise KeyError("second page")


def test_failures_are_set_aside_in_one_pass(spark, folder, tmp_path):
    found = files.scan_files(spark, str(folder), recursive=True)
    path = str(tmp_path / "parsed")
    parsed, failures = files.parse_and_set_aside(found, path, reads_some, most_failures=2)
    assert [r.source.rsplit("/", 1)[1] for r in parsed.collect()] == ["d.pdf"]
    # A file that fails after its first page has failed.
    assert sorted((r.source.rsplit("/", 1)[1], r.error) for r in failures.collect()) == [
        ("a.pdf", "KeyError: 'second page'"), ("b.PDF", "RuntimeError: cannot parse three")]
    assert parsed.columns == files.parse_files(found, reads_some).columns
    with pytest.raises(ValueError, match="2 files could not be parsed"):
        files.parse_and_set_aside(found, path, reads_some, most_failures=1)
    good, none = files.parse_and_set_aside(found, path, "text", most_failures=0)
    assert good.count() == 3 and none.collect() == []
    bad, every = files.parse_and_set_aside(found, path, failing)
    assert bad.collect() == [] and every.count() == 3


def test_reports_of_equal_names_stay_apart(spark, tmp_path):
    pages = spark.createDataFrame(
        [("x/a.pdf", i, f"x {i}") for i in range(40)] + [("y/a.pdf", i, f"y {i}") for i in range(40)],
        "source string, page int, page_content string").repartition(7)
    path = str(tmp_path / "report")
    report.write_report(report.page_report(pages), path, "page", X.report_name(F.col("source")))
    for name in "xy":
        parts = sorted((tmp_path / "report" / "report=a_output" / f"source={name}%2Fa.pdf").glob("part-*"))
        lines = "".join(p.read_text() for p in parts).split("\n")
        assert [line for line in lines if line.startswith(name)] == [f"{name} {i}" for i in range(40)]
