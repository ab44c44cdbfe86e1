"""SQL twins of the registered queries, for DuckDB on the same tables."""

STARS = "repeat('*', 40)"


def clean(text):
    return (f"trim(regexp_replace(regexp_replace({text}, 'http\\S+', '', 'g'), '\\s+', ' ', 'g'))")


def strip(text):
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


WORDS = f"""
words AS (
  SELECT doc_id, source, list_filter(string_split({clean('text')}, ' '), lambda w: w <> '') AS tk
  FROM documents),
starts AS (SELECT doc_id, source, tk, unnest(range(0, len(tk), 180)) AS s FROM words),
chunks AS (
  SELECT doc_id, source, (s // 180)::INT AS chunk_idx, tk[s + 1 : s + 200] AS tk,
         array_to_string(tk[s + 1 : s + 200], ' ') AS chunk
  FROM starts)"""

LINES = """
cut AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
walk AS (
  SELECT doc_id, source, lines, 1 AS i, 0 AS chunk_idx, len(lines[1]) AS filled FROM cut
  UNION ALL
  SELECT doc_id, source, lines, i + 1,
         CASE WHEN filled + 1 + len(lines[i + 1]) <= 1000 THEN chunk_idx ELSE chunk_idx + 1 END,
         CASE WHEN filled + 1 + len(lines[i + 1]) <= 1000 THEN filled + 1 + len(lines[i + 1])
              ELSE len(lines[i + 1]) END
  FROM walk WHERE i < len(lines)),
packs AS (
  SELECT doc_id, source, chunk_idx::INT AS chunk_idx, string_agg(lines[i], chr(10) ORDER BY i) AS chunk
  FROM walk GROUP BY ALL)"""

# Two levels suffice on the test tables: lines, and words for lines of 2,500 characters or more.
RECURSIVE = """
top AS (
  SELECT doc_id, text, CASE WHEN contains(text, chr(10)) THEN chr(10) ELSE ' ' END AS sep
  FROM documents),
top_parts AS (
  SELECT doc_id, sep, unnest(string_split(text, sep)) AS part,
         generate_subscripts(string_split(text, sep), 1) AS p FROM top),
top_pieces AS (
  SELECT doc_id, sep, p, CASE WHEN p = 1 THEN part ELSE sep || part END AS piece,
         coalesce(sum(len(part) + 1) OVER (PARTITION BY doc_id ORDER BY p
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, 0) AS a
  FROM top_parts),
sized AS (
  SELECT *, a + len(piece) AS b, len(piece) >= 2500 AS big FROM top_pieces WHERE piece <> ''),
runs AS (
  SELECT *, sum(big::INT) OVER (PARTITION BY doc_id ORDER BY p) AS bigs FROM sized),
sub_parts AS (
  SELECT doc_id, p, a AS base, unnest(string_split(piece, ' ')) AS part,
         generate_subscripts(string_split(piece, ' '), 1) AS q FROM runs WHERE big),
sub_pieces AS (
  SELECT doc_id, p, part, q, base + coalesce(sum(len(part) + 1) OVER (PARTITION BY doc_id, p ORDER BY q
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, 0) AS a
  FROM sub_parts),
pieces AS (
  SELECT doc_id, 's' || bigs AS run, a, b FROM runs WHERE NOT big
  UNION ALL
  SELECT doc_id, 'b' || p, a, a + len(part) + CASE WHEN q = 1 THEN 0 ELSE 1 END FROM sub_pieces),
cuts AS (
  SELECT doc_id, run, list_append(list(a ORDER BY a), max(b)) AS c FROM pieces WHERE b > a GROUP BY ALL),
pack AS (
  SELECT doc_id, run, c, 1::BIGINT AS i, len(list_filter(c, lambda x: x <= c[1] + 2500)) AS j FROM cuts
  UNION ALL
  SELECT doc_id, run, c, k, len(list_filter(c, lambda x: x <= c[k] + 2500))
  FROM (
    SELECT doc_id, run, c, least(j, greatest(
             len(list_filter(c, lambda x: x < c[j] - 100)),
             len(list_filter(c, lambda x: x < c[j + 1] - 2500))) + 1) AS k
    FROM pack WHERE j < len(c))),
recursive_chunks AS (
  SELECT doc_id, c[i] AS a, regexp_replace(substr(text, (c[i] + 1)::BIGINT, (c[j] - c[i])::BIGINT),
         '^\\s+|\\s+$', '', 'g') AS chunk
  FROM pack JOIN documents USING (doc_id))"""

BUCKET = "('0x' || substr(md5({}), 1, 8))::BIGINT % 256"


def hashed(rows, key):
    """Rows (key, bucket, n) and float weights of unit length from rows (key, tk)."""
    return f"""
{rows}_counts AS (
  SELECT {key}, {BUCKET.format('w')} AS bucket, count(*) AS n
  FROM (SELECT {key}, unnest(tk) AS w FROM {rows}) GROUP BY ALL),
{rows}_weights AS (
  SELECT {key}, bucket,
         (n / sqrt(sum(n * n) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS w
  FROM {rows}_counts)"""


def idf(rows):
    """Weight of each bucket, from the counts of ``rows``."""
    return f"""
idf AS (
  SELECT bucket, ln((1 + (SELECT count(*) FROM {rows})) / (1 + count(*))) + 1 AS weight
  FROM {rows}_counts GROUP BY bucket)"""


def weighted(rows, key):
    """``hashed`` with the weights of the buckets; a bucket that the corpus lacks has the greatest weight."""
    counts = hashed(rows, key).partition(f"{rows}_weights AS")[0]
    return f"""{counts}
{rows}_idf AS (
  SELECT {key}, bucket, n * coalesce(weight, (SELECT ln(1 + count(*)) + 1 FROM chunks)) AS x
  FROM {rows}_counts LEFT JOIN idf USING (bucket)),
{rows}_weights AS (
  SELECT {key}, bucket, (x / sqrt(sum(x * x) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS w FROM {rows}_idf)"""


SCORED = """
chunk_norms AS (
  SELECT doc_id, chunk_idx, sqrt(sum(w * w)) AS norm FROM chunks_weights GROUP BY ALL),
asked_norms AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM asked_weights GROUP BY ALL),
dots AS (
  SELECT query_id, doc_id, chunk_idx, sum(a.w * c.w) AS dot
  FROM asked_weights a JOIN chunks_weights c USING (bucket) GROUP BY ALL),
scored AS (
  SELECT query_id, doc_id, chunk_idx, round(dot / (a.norm * c.norm), 6) AS score
  FROM dots JOIN asked_norms a USING (query_id) JOIN chunk_norms c USING (doc_id, chunk_idx))"""

ASKED = f"""
{WORDS},
asked AS (
  SELECT item_id AS query_id, list_filter(string_split({clean('text')}, ' '), lambda w: w <> '') AS tk
  FROM benchmark)"""

TEXT_HITS = f"""
{ASKED},
{hashed('chunks', 'doc_id, chunk_idx')},
{hashed('asked', 'query_id')},
{SCORED}"""

TFIDF_HITS = f"""
{ASKED},
{weighted('chunks', 'doc_id, chunk_idx').replace('chunks_idf AS', idf('chunks').strip() + ',' + chr(10) + 'chunks_idf AS')},
{weighted('asked', 'query_id')},
{SCORED}"""

MEANS = """
parts AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos
  FROM embeddings),
mean_parts AS (SELECT label, pos, round(avg(x), 6) AS x FROM parts GROUP BY ALL),
means AS (SELECT label AS query_id, list(x ORDER BY pos) AS q FROM mean_parts GROUP BY label)"""

SCORES = {
    "COSINE": "list_cosine_similarity(q, embedding::DOUBLE[])",
    "IP": "list_inner_product(q, embedding::DOUBLE[])",
    "L2": "list_sum(list_transform(list_zip(q, embedding::DOUBLE[]), lambda p: (p[1] - p[2]) * (p[1] - p[2])))",
}


SCORES["L2 shifted"] = SCORES["L2"].replace("zip(q,", "zip(list_transform(q, lambda x: x + 1e7),").replace(
    "embedding::DOUBLE[]", "list_transform(embedding::DOUBLE[], lambda x: x + 1e7)")


def knn(k=3, metric="COSINE", where="true", keep="true", extra=""):
    order = "score" if metric.startswith("L2") else "score DESC"
    return f"""
WITH {MEANS},
scored AS (
  SELECT query_id, vec_id, label, round({SCORES[metric]}, 6) AS score
  FROM means, embeddings WHERE {where}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score{extra} FROM ranked WHERE rank <= {k} AND {keep}"""


PAGE_NUMBER = "row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1"
BASE = "regexp_extract(url, '[^/\\\\]*$')"
STEM = f"regexp_replace({BASE}, '(?s)^(.*[^.].*)(\\.[^.]*)$', '\\1')"

ORACLES = {
    "page_table": f"SELECT source, {PAGE_NUMBER} AS page, doc_id, md5(text) AS content_md5 FROM documents",
    "page_count_by_source": "SELECT source, count(*) AS page_count FROM documents GROUP BY source",
    "suffix_filter": "SELECT page_id, url FROM pages WHERE lower(url) LIKE '%.html'",
    "html_pages": f"""
SELECT page_id, md5({clean(
    "regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', ' ', 'g'),"
    " '(?is)<style\\b.*?</style>', ' ', 'g'), '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')"
)}) AS content_md5 FROM pages""",
    "clean_text": f"SELECT doc_id, md5({clean('text')}) AS clean_md5 FROM documents",
    "clean_text_urls": f"""
SELECT page_id, {clean("'  page ' || page_id || chr(10) || ' at ' || url || ' ' || chr(9) || ' (' || url || ') end' || chr(10)")} AS cleaned
FROM pages""",
    "clean_text_array": f"""
SELECT conv_id, turn // 4 AS part, count(*)::INT AS page_count,
       first({clean('text')} ORDER BY turn) AS first_page,
       md5(string_agg({clean('text')}, chr(10) ORDER BY turn)) AS clean_md5
FROM conversations GROUP BY ALL""",
    "file_names": f"""
SELECT page_id, {BASE} AS base_name, {STEM} AS stem,
       regexp_extract({BASE}, '(?s)^(.*[^.].*)(\\.[^.]*)$', 2) AS extension,
       regexp_replace({BASE}, '(?i)\\.html$', '.docx') AS chunk_report_name,
       {STEM} || '_output' AS page_report_name
FROM pages""",
    "metadata_filter": """
SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events
WHERE json_extract_string(props, '$.k')::INT >= 90""",
    "page_report": f"""
SELECT source, page, md5(chr(10) || {STARS} || ' Page ' || (page + 1) || ' ' || {STARS} || chr(10)
       || {strip('text')} || chr(10)) AS block_md5
FROM (SELECT source, text, {PAGE_NUMBER} AS page FROM documents)""",
    "chunk_report": f"""
WITH {WORDS},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, chunk_idx) AS chunk_number FROM chunks)
SELECT source, chunk_number, doc_id AS page,
       md5(chr(10) || {STARS} || ' Chunk ' || chunk_number || ' ' || {STARS} || ' Page: ' || doc_id
       || chr(10) || chunk || chr(10)) AS block_md5
FROM numbered""",
    "report_files": f"""
WITH blocks AS (
  SELECT source, chr(10) || {STARS} || ' Page ' || (doc_id + 1) || ' ' || {STARS} || chr(10)
         || {strip('text')} || chr(10) AS block FROM documents)
SELECT source, md5(line) AS line_md5, count(*) AS n
FROM (SELECT source, unnest(string_split(block, chr(10))) AS line FROM blocks) GROUP BY ALL""",
    "chunk_summary": f"""
WITH {WORDS},
counts AS (SELECT source, count(*) AS chunk_counts FROM chunks GROUP BY source),
sizes AS (SELECT source, count(*) AS page_count FROM documents GROUP BY source)
SELECT CASE WHEN chunk_counts > 0 THEN source END AS file_path, page_count,
       coalesce(chunk_counts, 0) AS chunk_counts, 'TokenTextSplitter' AS chunk_method
FROM sizes LEFT JOIN counts USING (source)""",
    "chunk_summary_join": f"""
WITH RECURSIVE {LINES},
counts AS (SELECT source, count(*) AS chunk_counts FROM packs GROUP BY source),
sizes AS (SELECT source, count(*) AS page_count FROM documents GROUP BY source)
SELECT CASE WHEN chunk_counts > 0 THEN source END AS file_path, page_count,
       coalesce(chunk_counts, 0) AS chunk_counts, 'lines' AS chunk_method
FROM sizes LEFT JOIN counts USING (source)""",
    "chunk_token_window": f"""
WITH {WORDS}
SELECT doc_id, chunk_idx, len(chunk)::INT AS n_chars, md5(chunk) AS chunk_md5 FROM chunks""",
    "chunk_line_pack": f"""
WITH RECURSIVE {LINES}
SELECT doc_id, chunk_idx, len(chunk)::INT AS n_chars, md5(chunk) AS chunk_md5 FROM packs""",
    "chunk_recursive": f"""
WITH RECURSIVE {RECURSIVE}
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY a) - 1)::INT AS chunk_idx,
       len(chunk)::INT AS n_chars, md5(chunk) AS chunk_md5
FROM recursive_chunks WHERE chunk <> ''""",
    "chunk_char_window": """
WITH starts AS (SELECT doc_id, text, unnest(range(0, len(text), 900)) AS s FROM documents WHERE trim(text) <> ''),
cut AS (SELECT doc_id, (s // 900)::INT AS chunk_idx, substr(text, s + 1, 1000) AS chunk FROM starts)
SELECT doc_id, chunk_idx, len(chunk)::INT AS n_chars, md5(chunk) AS chunk_md5 FROM cut""",
    "chunk_summary_files": f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN len(text) < 400 THEN [] ELSE string_split(text, chr(10)) END AS pages
  FROM documents),
page AS (SELECT doc_id, unnest(pages) AS text FROM docs),
counts AS (
  SELECT doc_id, count(*) AS pages,
         sum(ceil(len(list_filter(string_split({clean('text')}, ' '), lambda w: w <> '')) / 180.0)) AS chunks
  FROM page GROUP BY doc_id)
SELECT coalesce(counts.pages, 0) AS page_count, coalesce(chunks, 0)::BIGINT AS chunk_counts,
       count(*) AS documents, count(*) FILTER (coalesce(chunks, 0) > 0) AS with_path
FROM docs LEFT JOIN counts USING (doc_id) GROUP BY 1, 2""",
    "tokenizer_chunks": """
WITH pieces AS (SELECT doc_id, regexp_extract_all(text, ' ?[^ ]+') AS tk FROM documents),
starts AS (SELECT doc_id, tk, unnest(range(0, len(tk), 180)) AS s FROM pieces),
cut AS (SELECT doc_id, (s // 180)::INT AS chunk_idx, array_to_string(tk[s + 1 : s + 200], '') AS chunk
        FROM starts)
SELECT doc_id, chunk_idx, len(chunk)::INT AS n_chars, md5(chunk) AS chunk_md5 FROM cut""",
    "dense_ids": f"""
WITH {WORDS}
SELECT row_number() OVER (ORDER BY source, doc_id, chunk_idx) AS id, source, doc_id AS page, chunk_idx,
       md5(chunk) AS chunk_md5
FROM chunks""",
    "hash_embed": f"""
WITH {WORDS}, {hashed('words', 'doc_id')}
SELECT doc_id, bucket::INT AS bucket, n FROM words_counts""",
    "hash_embed_arrow": f"""
WITH {WORDS}, {hashed('words', 'doc_id')}
SELECT doc_id, bucket::INT AS bucket, round(w, 6) AS weight FROM words_weights""",
    "model_embed": """
SELECT doc_id, len(text)::INT AS n_chars, (len(text) - len(replace(text, ' ', '')))::INT AS n_blanks,
       (len(text) - len(replace(text, 'e', '')))::INT AS n_e
FROM documents""",
    "collection_roundtrip": """
SELECT vec_id AS id, 'label ' || label AS page_content,
       '{"source":"embeddings","page":' || vec_id || '}' AS metadata, len(embedding)::INT AS dim,
       round(list_sum(list_transform(embedding::DOUBLE[], lambda x, i: x * i)), 5) AS total
FROM embeddings""",
    "collection_append": f"""
WITH {MEANS}
SELECT vec_id AS id, 'label ' || label AS page_content,
       '{{"source":"embeddings","page":' || vec_id || '}}' AS metadata, len(embedding)::INT AS dim,
       round(list_sum(list_transform(embedding::DOUBLE[], lambda x, i: x * i)), 5) AS total
FROM embeddings
UNION ALL
SELECT (-1 - query_id)::BIGINT, 'mean', '{{"source":"means","page":' || query_id || '}}', len(q)::INT,
       round(list_sum(list_transform(q::FLOAT[]::DOUBLE[], lambda x, i: x * i)), 5)
FROM means""",
    "collection_violations": """
WITH rows AS (
  SELECT doc_id AS id, text, NULL::FLOAT[] AS v FROM documents
  UNION ALL SELECT vec_id, NULL, embedding FROM embeddings)
SELECT 'null_id' AS rule, count(*) AS violations FROM rows WHERE id IS NULL
UNION ALL SELECT 'text_too_long', count(*) FROM rows WHERE strlen(text) > 5000
UNION ALL SELECT 'null_vector', count(*) FROM rows WHERE v IS NULL
UNION ALL SELECT 'wrong_dimension', count(*) FROM rows WHERE len(v) <> 64
UNION ALL SELECT 'null_element', count(*) FROM rows WHERE len(list_filter(v, lambda x: x IS NULL)) > 0
UNION ALL SELECT 'duplicate_id', count(id) - count(DISTINCT id) FROM rows""",
    "vector_dim": """
SELECT min(len(embedding))::INT AS min_dim, max(len(embedding))::INT AS max_dim FROM embeddings""",
    "csv_roundtrip": f"""
SELECT source || '/' || doc_id || '.pdf' AS source, len(string_split(text, chr(10)))::INT AS page_count,
       (len(string_split(text, chr(10))) - 1)::INT AS last_page, md5(text) AS text_md5,
       md5(array_to_string(list_transform(string_split(text, chr(10)), lambda p: {clean('p')}), chr(10)))
         AS clean_md5
FROM documents""",
    "file_scan": "SELECT md5(text) AS content_md5, count(*) AS n_pages FROM documents GROUP BY ALL",
    "collection_append_search": f"""
WITH {MEANS},
corpus AS (
  SELECT vec_id AS id, 'label ' || label AS page_content, embedding::DOUBLE[] AS v FROM embeddings
  UNION ALL SELECT (-1 - query_id)::BIGINT, 'mean', q::FLOAT[]::DOUBLE[] FROM means),
scored AS (
  SELECT query_id, id, page_content, round(list_cosine_similarity(q, v), 6) AS score FROM means, corpus),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank FROM scored)
SELECT query_id, rank, id, score, page_content FROM ranked WHERE rank <= 3""",
    "knn_cosine": knn(),
    "knn_l2": knn(metric="L2"),
    "knn_l2_shifted": knn(metric="L2 shifted"),
    "knn_ip": knn(metric="IP"),
    "knn_filtered": knn(where="label >= 5"),
    "knn_threshold": knn(k=50, keep="score > 0.3"),
    "knn_l2_threshold": knn(k=50, metric="L2", keep="score < 0.95"),
    "knn_output_fields": knn(extra=", label"),
    "knn_single": """
WITH parts AS (
  SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
mean_parts AS (SELECT pos, round(avg(x), 6) AS x FROM parts GROUP BY pos),
mean AS (SELECT list(x ORDER BY pos) AS q FROM mean_parts)
SELECT vec_id, label, round(list_cosine_similarity(q, embedding::DOUBLE[]), 6) AS score
FROM mean, embeddings ORDER BY score DESC, vec_id LIMIT 10""",
    "ivf_assign": f"""
WITH {MEANS},
ranked AS (
  SELECT vec_id, query_id AS cell, row_number() OVER (PARTITION BY vec_id ORDER BY
         round(list_cosine_similarity(q, embedding::DOUBLE[]), 6) DESC, query_id) AS rank
  FROM means, embeddings)
SELECT vec_id, cell FROM ranked WHERE rank = 1""",
    "ivf_search": f"""
WITH {MEANS},
placed AS (
  SELECT vec_id, query_id AS cell, row_number() OVER (PARTITION BY vec_id ORDER BY
         round(list_cosine_similarity(q, embedding::DOUBLE[]), 6) DESC, query_id) AS rank
  FROM means, embeddings),
peak_parts AS (SELECT label, pos, max(x) AS x FROM parts GROUP BY ALL),
peaks AS (SELECT label AS query_id, list(x ORDER BY pos) AS p FROM peak_parts GROUP BY label),
probes AS (
  SELECT peaks.query_id, p, means.query_id AS cell, row_number() OVER (PARTITION BY peaks.query_id
         ORDER BY round(list_cosine_similarity(p, q), 6) DESC, means.query_id) AS rank
  FROM peaks, means),
scored AS (
  SELECT query_id, vec_id, label, round(list_cosine_similarity(p, embedding::DOUBLE[]), 6) AS score
  FROM probes JOIN placed USING (cell) JOIN embeddings USING (vec_id)
  WHERE probes.rank <= 2 AND placed.rank = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score, label FROM ranked WHERE rank <= 5""",
    "ivf_kmeans": knn(),
    "ivf_tree": knn(),
    "text_search": f"""
WITH {TEXT_HITS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_idx)::INT AS rank
  FROM scored)
SELECT query_id, rank, doc_id, chunk_idx, score, md5(chunk) AS chunk_md5
FROM ranked JOIN chunks USING (doc_id, chunk_idx) WHERE rank <= 3 AND score > 0.5""",
    "tfidf_embed": f"""
WITH {WORDS}, {hashed('words', 'doc_id')}, {idf('words')},
weighted AS (SELECT doc_id, bucket, n * weight AS x FROM words_counts JOIN idf USING (bucket))
SELECT doc_id, bucket::INT AS bucket,
       round((x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE, 6) AS weight
FROM weighted""",
    "tfidf_search": f"""
WITH {TFIDF_HITS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_idx)::INT AS rank
  FROM scored)
SELECT query_id, rank, doc_id, chunk_idx, score, md5(chunk) AS chunk_md5
FROM ranked JOIN chunks USING (doc_id, chunk_idx) WHERE rank <= 3 AND score > 0.3""",
    "collection_upsert": f"""
WITH {MEANS},
batch AS (
  SELECT (CASE WHEN query_id % 2 = 0 THEN query_id ELSE -1 - query_id END)::BIGINT AS id, 'mean' AS page_content,
         '{{"source":"means","page":' || query_id || '}}' AS metadata, len(q)::INT AS dim,
         round(list_sum(list_transform(q::FLOAT[]::DOUBLE[], lambda x, i: x * i)), 5) AS total
  FROM means)
SELECT vec_id AS id, 'label ' || label AS page_content,
       '{{"source":"embeddings","page":' || vec_id || '}}' AS metadata, len(embedding)::INT AS dim,
       round(list_sum(list_transform(embedding::DOUBLE[], lambda x, i: x * i)), 5) AS total
FROM embeddings WHERE vec_id NOT IN (SELECT id FROM batch)
UNION ALL SELECT * FROM batch""",
    "ivf_join": f"""
WITH {MEANS},
placed AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, query_id AS cell, row_number() OVER (PARTITION BY vec_id ORDER BY
         round(list_cosine_similarity(q, embedding::DOUBLE[]), 6) DESC, query_id) AS rank
  FROM means, embeddings),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, round(list_cosine_similarity(a.v, b.v), 6) AS score
  FROM placed a JOIN placed b USING (cell) WHERE a.rank <= 2 AND b.rank = 1),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 4""",
    "range_search": """
WITH peak_parts AS (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
peaks AS (
  SELECT label AS query_id, list(x::DOUBLE ORDER BY pos) AS p
  FROM (SELECT label, pos, max(x) AS x FROM peak_parts GROUP BY ALL) GROUP BY label)
SELECT query_id, vec_id, round(list_cosine_similarity(p, embedding::DOUBLE[]), 6) AS score, label
FROM peaks, embeddings WHERE round(list_cosine_similarity(p, embedding::DOUBLE[]), 6) > 0.3""",
    "file_scan_errors": """
WITH found AS (
  SELECT source, regexp_extract(source, '\\d+')::INT AS number, md5(text) AS content_md5 FROM documents)
SELECT source, NULL::VARCHAR AS error, content_md5, count(*) AS n FROM found WHERE number % 2 = 0 GROUP BY ALL
UNION ALL
SELECT DISTINCT source, 'ValueError: source ' || number || ' cannot be read', NULL::VARCHAR, 1::BIGINT
FROM found WHERE number % 2 = 1""",
    "variant_filter": knn(where="label >= 5", extra=", vec_id AS number"),
    "embed_distinct": """
SELECT doc_id, (line - 1)::INT AS line, len(t)::INT AS n_chars, (len(t) - len(replace(t, ' ', '')))::INT AS n_blanks,
       (len(t) - len(replace(t, 'e', '')))::INT AS n_e
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS t,
             generate_subscripts(string_split(text, chr(10)), 1) AS line FROM documents)""",
    "knn_deep": knn(k=1000),
    "report_names": f"""
WITH {WORDS},
numbered AS (
  SELECT source, doc_id, chunk, row_number() OVER (PARTITION BY source ORDER BY doc_id, chunk_idx) AS chunk_number
  FROM chunks),
lines AS (
  SELECT source, unnest(string_split(chr(10) || {STARS} || ' Chunk ' || chunk_number || ' ' || {STARS} || ' Page: '
         || doc_id || chr(10) || chunk || chr(10), chr(10))) AS line FROM numbered)
SELECT source || '.docx' AS report, 'in/' || source || '.PDF' AS source, count(*) AS n_lines,
       sum(len(line))::BIGINT AS n_chars
FROM lines GROUP BY ALL""",
    "stored_search": f"""
WITH {TEXT_HITS},
numbered AS (
  SELECT doc_id, chunk_idx, chunk, row_number() OVER (ORDER BY source, doc_id, chunk_idx) AS id
  FROM chunks),
ranked AS (
  SELECT query_id, id, score, md5(chunk) AS chunk_md5, doc_id,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank
  FROM scored JOIN numbered USING (doc_id, chunk_idx))
SELECT query_id, rank, id, score, chunk_md5, doc_id FROM ranked WHERE rank <= 3 AND score > 0.5""",
}
ORACLES["summary_csv"] = ORACLES["chunk_summary"]
