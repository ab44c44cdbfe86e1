"""Registered queries of the numbered operators, each over its whole table, and their SQL twins."""

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrove.llm import (
    automaton, bag_search, brown, decontaminate, edit_counts, hard_negatives, mixing, packing, rans, rules, shard, simhash, span_hash,
)
from pagetrove.llm.common import rows_with_ids
from pagetrove.session import scratch_path, table


def _documents(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id", "text", *more)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, folder), width=3, limit=3)


def op2_span_hash(spark: SparkSession, folder: str) -> DataFrame:
    return span_hash.compare_with_next(_documents(spark, folder))


def op3_shard(spark: SparkSession, folder: str) -> DataFrame:
    return shard.assign(_documents(spark, folder), shards=40)


def op4_brown(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score(_documents(spark, folder))


def op5_edit_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with three edits: some characters in the middle are taken out, the document's first
    words are put in at a third, and its first characters are added at the end."""
    docs = _documents(spark, folder)
    size = F.char_length(F.coalesce("text", F.lit(""))).cast("long")

    def edit(begin, end, new):
        return F.struct(F.floor(begin).cast("long").alias("begin"), F.floor(end).cast("long").alias("end"),
                        new.alias("new"))

    edits = F.array(
        edit(size / 2, size / 2 + 17, F.lit("")),
        edit(size / 3, size / 3, F.substring_index(F.substring("text", 1, 200), " ", 3)),
        edit(size + 200, size + 200, F.substring("text", 1, 30)))
    return edit_counts.count_edits(docs.withColumn("edits", edits))


_DIGEST = "n_words long, n_removed long, kept_sha256 string"


def _digest(text, gone):
    words = text.split()
    kept = words if gone is None else [word for word, out in zip(words, gone) if not out]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def op6_automaton(spark: SparkSession, folder: str) -> DataFrame:
    return automaton.cut_repeats(_documents(spark, folder), _digest, _DIGEST, window=50)


def op7_rans(spark: SparkSession, folder: str) -> DataFrame:
    """Written to files, and read back from them."""
    path = scratch_path(spark, "op7")
    rans.write(_documents(spark, folder), path, end_id=2)
    return rans.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


# Shares of tokens that the languages are to have.
MIX = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def trusted_languages(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled table: the texts of all documents that ``labels`` calls good and not toxic, with their
    language. The language of all other documents is not relied on.

    Labels grow with the documents, so their ids are not broadcast; no text is shuffled to meet them, either.
    """
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return rows_with_ids(_documents(spark, folder, "lang"), good).select("text", F.col("lang").alias("domain"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, folder), trusted_languages(spark, folder), MIX)
    best = F.array_max("posteriors")
    return mixed.select(
        "doc_id", "n_tokens", F.element_at("domains", F.array_position("posteriors", best).cast("int")).alias("domain"),
        F.round(best, 9).alias("posterior"), F.round("rate", 9).alias("rate"), "copies", "converged")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), capacity=2048, end_id=0)


def op10_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels", "doc_id", "quality")
    return rules.judge(_documents(spark, folder), labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings", "vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")).alias("label")))


def op12_wu_manber(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_items(_documents(spark, folder), table(spark, folder, "benchmark", "item_id", "text"))
    return decontaminate.digest(found)


def op13_bag_search(spark: SparkSession, folder: str) -> DataFrame:
    return bag_search.search(_documents(spark, folder), table(spark, folder, "benchmark", "item_id", "text"))


QUERIES = [
    op1_simhash, op2_span_hash, op3_shard, op4_brown, op5_edit_counts, op6_automaton, op7_rans, op8_mixing, op9_packing,
    op10_rules, op11_hard_negatives, op12_wu_manber, op13_bag_search,
]

ORACLES: dict[str, str] = {
    "op6_automaton": r"""
        WITH split AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        placed AS (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS place FROM split),
        windows AS (
            SELECT doc_id, place, array_to_string(words[place:place + 49], ' ') AS content
            FROM placed WHERE place + 49 <= len(words)),
        firsts AS (SELECT content, min(doc_id) AS least FROM windows GROUP BY content),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS place
            FROM windows JOIN firsts USING (content) WHERE least < doc_id),
        kept AS (
            SELECT doc_id, string_agg(words[place], ' ' ORDER BY place) AS text, count(*) AS n
            FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM split LEFT JOIN kept USING (doc_id)""",
    "op11_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
                   CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scores USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 3""",
    "op12_wu_manber": r"""
        WITH document_words AS (
            SELECT doc_id, regexp_extract_all(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, width, array_to_string(words[place:place + width - 1], ' ') AS content
            FROM (SELECT item_id, words, least(10, len(words)) AS width,
                         unnest(range(1, len(words) - least(10, len(words)) + 2)) AS place
                  FROM item_words WHERE len(words) > 0)),
        widths AS (SELECT DISTINCT width FROM windows),
        places AS (
            SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS place
            FROM document_words, widths WHERE len(words) >= width),
        found AS (
            SELECT doc_id, place, width, item_id
            FROM (SELECT doc_id, place, width, array_to_string(words[place:place + width - 1], ' ') AS content
                  FROM places) JOIN windows USING (width, content)),
        hits AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(place, place + width)) AS place FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM document_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op13_bag_search": r"""
        WITH document_terms AS (
            SELECT doc_id, regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents WHERE text IS NOT NULL),
        item_terms AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(
                text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        sizes AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM document_terms WHERE len(terms) > 0),
        totals AS (SELECT count(*) AS n_all, CAST(sum(n) AS BIGINT) AS l_all FROM sizes),
        counts AS (
            SELECT doc_id, term, count(*) AS tf
            FROM (SELECT doc_id, unnest(terms) AS term FROM document_terms) GROUP BY doc_id, term),
        weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * n_all + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term, n_all),
        parts AS (
            SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_all) // l_all))) AS part
            FROM counts JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score
            FROM parts JOIN item_terms USING (term) GROUP BY item_id, doc_id)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
               doc_id, score
        FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50""",
}
