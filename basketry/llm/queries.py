"""The operators as queries over the sample tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (byte_bpe, decontaminate, fill_in_middle, html_extract, language_id, lexical_search, ngram_join, quality,
                          repeated_runs, substring_dedup, token_counts, token_files, voronoi_knn, warc)
from basketry.llm.common import ship, stored, table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_rows(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve(warc.read(warc.archive(table(spark, sf_dir, "pages"))))


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.train(documents.where(~held_out()))
    found = language_id.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return quality.classify(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), trusted)


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among whole lines, and runs of words repeated word for word wherever they stand."""
    documents = table(spark, sf_dir, "documents")
    lines = substring_dedup.repeated(documents).withColumns({"first_word": F.lit(None).cast("int"), "class_first_word": F.lit(None).cast("int")})
    runs = repeated_runs.find(documents).withColumns({
        "paragraph": F.lit(None).cast("int"), "class_paragraph": F.lit(None).cast("int"), "n_links": F.lit(None).cast("long")})
    return stored(lines.unionByName(runs), "repeated-passages").drop("text_key")


def op7_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.round_trip(documents))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.checksums(token_files.write(table(spark, sf_dir, "documents")))


def _shipped(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_ngram_jaccard, op2_warc, op3_language_id, op4_quality_classifier, op5_html_extraction, op6_substring_dedup, op7_top_k_search,
    op8_byte_bpe, op9_token_counts, op10_decontamination, op11_fill_in_middle, op12_lexical_search, op13_token_files,
)}

# Words and 5-word shingle sets of op1: lower-cased A-Z, words between 0x20 and 0x09 to 0x0D.
_WORDS = """list_filter(string_split_regex(translate(coalesce({text}, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"""
_SHINGLES = """CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END"""

ORACLE_SQL = {
    "op1_ngram_jaccard": f"""
WITH RECURSIVE word AS (
    SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents
), sets AS (
    SELECT doc_id, {_SHINGLES} AS s FROM word
), member AS (
    SELECT DISTINCT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), pair AS (
    SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) + any_value(b.n) AS total, count(*) AS shared
    FROM member a JOIN member b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM pair WHERE 100 * shared >= 80 * (total - shared)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), class AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
), different AS (
    SELECT l.x, count(DISTINCT list_sort(s.s)) AS n_links
    FROM link l JOIN sets s ON l.y = s.doc_id JOIN sets o ON l.x = o.doc_id
    WHERE list_sort(s.s) <> list_sort(o.s) GROUP BY l.x
)
SELECT doc_id, len(s) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM sets JOIN class ON doc_id = class.x LEFT JOIN different ON doc_id = different.x
""",
    "op2_warc": """
WITH record AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), ranked AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS response_id FROM record
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > response_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > response_id THEN response_id END AS refers_to
FROM ranked
""",
    "op7_top_k_search": """
WITH vector AS (
    SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v, e.v)::BIGINT AS score
    FROM vector q JOIN vector e ON q.vec_id <> e.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
""",
    # Valid for the sample pages, whose only template marks the article with one <article> element.
    "op5_html_extraction": """
WITH part AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS body FROM pages
), plain AS (
    SELECT page_id, url, regexp_replace(regexp_replace(body, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS body FROM part
), decoded AS (
    SELECT page_id, url, trim(regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(body,
        '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&#39;', chr(39)), '&amp;?', '&', 'g'), '\\s+', ' ', 'g')) AS text FROM plain
)
SELECT page_id, url, text, length(text) AS n_chars FROM decoded
""",
    "op11_fill_in_middle": r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           sha256('1:' || doc_id::VARCHAR) AS h
    FROM documents
), numbers AS (
    SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
           ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM drawn
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), cut AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
""",
    "op12_lexical_search": r"""
WITH word AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), total AS (
    SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM word WHERE len(w) > 0
), document AS (
    SELECT doc_id, w, 10 + (90 * len(w) * n_docs) // length AS m FROM word, total WHERE len(w) > 0
), term AS (
    SELECT doc_id, m, unnest(w) AS term FROM document
), posting AS (
    SELECT doc_id, term, any_value(m) AS m, count(*) AS tf FROM term GROUP BY ALL
), weight AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posting, total GROUP BY term
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weight USING (term) JOIN posting USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10
""",
}
