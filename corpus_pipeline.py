"""From raw documents to packed sequences: five stages, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All but the last
return the columns of ``documents``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagetrove.llm import automaton, mixing, packing, queries, rules, simhash
from pagetrove.session import scratch_path, settled, ship, table

# How far the shares of the languages are moved towards each other: 1 keeps them, 0 makes them equal.
TEMPER = 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go; null and blank texts are among
    them. The others stay as they are."""
    ship(spark)
    return rules.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays. Documents without a
    doc_id stay."""
    ship(spark)
    return simhash.keep_first(docs, width=3, limit=3)


def _cut_text(text, gone):
    """The text that is left, its length, and whether it is to stay."""
    if gone is not None:
        text = b" ".join(word for word, out in zip(text.split(), gone) if not out)
    kept = text.decode(errors="replace")
    return kept, len(kept), gone is None or bool(kept)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document with a smaller doc_id has, too, are cut out. Texts that
    lose words are joined by single spaces anew, others stay as they are (null as empty). Documents
    that lose all their words go."""
    ship(spark)
    found = automaton.cut_repeats(docs.drop("n_chars"), _cut_text, "text string, n_chars long, __stays boolean")
    return found.where("__stays").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The languages' expected tokens are moved towards each other by repeating documents of the smaller
    ones. No rate is below 1, so no document goes. All labelled documents teach what a language is like, and
    all documents of the stage are counted."""
    ship(spark)
    labelled = settled(queries.trusted_languages(spark, sf_dir), "pipeline-labelled")

    def targets(tokens):
        return {domain: size ** TEMPER for domain, size in tokens.items()}

    return mixing.repeat_rows(docs, mixing.mix(docs, labelled, targets, least=1.0))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 2048 tokens. Repeated documents are packed
    each for itself."""
    ship(spark)
    return packing.pack(docs, capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# SQL has neither the fingerprints nor the tokenizer; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
