"""Registered queries of the thirteen operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeep.llm import fill_middle, hamming_search, hard_negatives, html_main, language, line_blooms, mixing, packing, passages, quality_cnn, quality_rules, setsketch, warc
from stallkeep.session import tune

#: Names of the public tokenizers' files.
RANKS, VOCABULARY, PIECES = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Bytes of a batch given to Python, which stands in the executor and in its worker at once. A longer row is a batch.
BATCH_BYTES = "8m"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tune(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_file(RANKS), tokenizer_file(VOCABULARY))


def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cnn.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's domain posteriors, rate and copies."""
    found = mixing.mixed(table(spark, folder, "documents"), table(spark, folder, "labels"))
    p = [F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return found.select("doc_id", "tokens", *p, "rate", "copies")


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_main.main_text(table(spark, folder, "pages"))


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest rows of every vector whose id is divisible by 50, by sign bits."""
    codes = hamming_search.sign_codes(table(spark, folder, "embeddings"))
    return hamming_search.top_k(codes, codes.where(F.col("id") % 50 == 0))


OP5_SQL = """
WITH d AS (
  SELECT q.vec_id AS query_id, e.vec_id AS neighbour_id,
         CAST(sum(CASE WHEN (q.embedding[i] > 0) <> (e.embedding[i] > 0) THEN 1 ELSE 0 END) AS INTEGER) AS distance
  FROM embeddings q, embeddings e, range(1, 65) AS bits(i)
  WHERE q.vec_id % 50 = 0
  GROUP BY q.vec_id, e.vec_id
),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank, neighbour_id, distance FROM d)
SELECT query_id, rank, neighbour_id, distance FROM r WHERE rank <= 10
"""


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, folder, "documents"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_id(table(spark, folder, "documents"), tokenizer_file(PIECES))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


# One record per page; of equal payloads of 1000 bytes or more the largest id's is the response.
OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
k AS (SELECT d, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.d = k.d
"""


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of documents that a document of smaller id holds, overlapping ones merged."""
    spans = passages.merged_spans(passages.repeated_passages(table(spark, folder, "documents")))
    return spans.select("doc_id", "start_word", "n_words", "keeper", "similarity")


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the lines that a document of smaller id holds; of the text kept, its hash."""
    found = line_blooms.without_repeated_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# White space, and the letters that are lower-cased.
OP11_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
k AS (SELECT doc_id, line, place, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT doc_id, line, place, first IS NOT NULL AND doc_id <> first AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Up to 10 hard negatives for each of 5 positives of every vector whose id is divisible by 100."""
    return hard_negatives.mined(table(spark, folder, "embeddings"))


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS id, a.label = e.label AS alike,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * e.v[i])) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0
),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its middle last, and the text rebuilt from that, as hashes."""
    found = fill_middle.restored_rows(fill_middle.infill_rows(table(spark, folder, "documents")))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS UBIGINT) % (len(u) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS UBIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
),
f AS (
  SELECT *, array_to_string(u[:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_packing, op2_quality_classifier, op3_mixing, op4_html_extraction, op5_exact_top_k, op6_quality_rules, op7_near_duplicates, op8_language_id, op9_warc, op10_substring_dedup, op11_line_dedup, op12_hard_negatives, op13_fill_in_middle)
}
CHECKS = {"op5_exact_top_k": OP5_SQL, "op9_warc": OP9_SQL, "op11_line_dedup": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
