import os
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagetrove.functions import text as X

ODD = [
    "", " ", "\n", " ", "a b", "　x　", "\x1ca\x1fb", "a\r\nb\tc", "  two  blanks ",
    "see http://x.org/a?b=c end", "http", "http ", "xhttp://y z", "https://a.b\nnext", "​kept​",
    "\x85a\x85", "tail http://q", "HTTP://kept",
]


def one_column(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").coalesce(1)
    return [r[0] for r in rows.sort("i").select(column(F.col("v"))).collect()]


def cleaned(text):
    return " ".join(re.sub(r"http\S+", "", text).split())


def test_clean_text_on_odd_white_space(spark):
    assert one_column(spark, ODD, X.clean_text) == [cleaned(v) for v in ODD]


def test_strip_text(spark):
    assert one_column(spark, ODD, X.strip_text) == [v.strip() for v in ODD]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("ahtp:/ \n\t  \x1c\x85b"), max_size=40), min_size=1, max_size=40))
def test_clean_and_strip_agree_with_python(spark, values):
    assert one_column(spark, values, X.clean_text) == [cleaned(v) for v in values]
    assert one_column(spark, values, X.strip_text) == [v.strip() for v in values]


def test_tokens(spark):
    assert one_column(spark, ["a  b\n c", "", " ", None], X.tokens) == [["a", "b", "c"], [], [], None]


def test_names(spark):
    paths = ["/d/a.pdf", "d\\b.PDF", "plain", ".hidden", "a..b", "x.tar.gz", "dir/", "..x", "n.pdf.pdf"]
    parts = [os.path.splitext(re.split(r"[/\\]", p)[-1]) for p in paths]
    assert one_column(spark, paths, X.stem) == [stem for stem, _ in parts]
    assert one_column(spark, paths, X.extension) == [extension for _, extension in parts]
    assert one_column(spark, paths, lambda p: X.swap_extension(p, ".pdf", ".docx")) == [
        "a.docx", "b.docx", "plain", ".hidden", "a..b", "x.tar.gz", "", "..x", "n.pdf.docx"]
    assert one_column(spark, paths, X.report_name)[0] == "a_output"
    assert one_column(spark, paths, X.has_suffix) == [
        True, True, False, False, False, False, False, False, True]


def test_html_text(spark):
    html = ("<html><STYLE>p{}</STYLE><script>var a='</p>';\n</script><!-- <b>no</b>\n-->"
            "<p>One<br>two</p> http://x.y/z three</html>")
    assert one_column(spark, [html], X.html_text) == ["One two three"]


def test_blocks(spark):
    row = spark.range(1).select(
        X.page_block(F.lit(3), F.lit(" t\n")).alias("p"),
        X.chunk_block(F.lit(2), F.lit(0), F.lit("u ")).alias("c"),
    ).first()
    assert row.p == "\n" + "*" * 40 + " Page 3 " + "*" * 40 + "\nt\n"
    assert row.c == "\n" + "*" * 40 + " Chunk 2 " + "*" * 40 + " Page: 0\nu\n"


def test_metadata(spark):
    row = spark.range(1).select(X.page_metadata(F.lit("a/b"), F.lit(4)).alias("m")).select(
        X.metadata_field(F.col("m"), "source").alias("source"),
        X.metadata_field(F.col("m"), "page", "int").alias("page"),
        X.metadata_field(F.col("m"), "none").alias("none"),
    ).first()
    assert (row.source, row.page, row.none) == ("a/b", 4, None)
