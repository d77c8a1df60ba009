"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .dac import token_output
from .langid import languages
from .lsh import near_duplicate_vectors
from .packing import pack_documents
from .partenum import jaccard_classes
from .pii import personal_data
from .quality import quality_report
from .resample import importance_resample
from .runs import periodic_runs, run_report
from .sharding import shard_documents
from .spm import encode_documents
from .toxicity import toxicity_scores
from .wrapper import main_texts

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTILINGUAL = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), PIECES)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"), width=5, num=3, den=4)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2, capacity=1024)


def op9_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, seed="2024", orders=(1, 1), buckets=10_000, least_words=20)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"), MULTILINGUAL, folds=4, fold=2)


def tail_repeats(doc_id: int | None, words: list[str]) -> list[str]:
    """In every tenth document (by a hash of its id) the words from some place on repeat; a null id changes nothing."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(periodic_runs(table(spark, sf_dir, "documents"), shortest=6, repeats=4, rewrite=tail_repeats))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_sentencepiece,
            op2_token_files,
            op3_toxicity,
            op4_differencing_shards,
            op5_ngram_jaccard_join,
            op6_personal_data,
            op7_main_text,
            op8_best_fit_packing,
            op9_embedding_near_duplicates,
            op10_quality_rules,
            op11_importance_resampling,
            op12_language_id,
            op13_periodic_runs,
        )
    }


#: Operators whose whole result plain SQL can say; the others' tests hold them against brute force.
JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y WHERE 100 * k >= 75 * (len(a.s) + len(b.s) - k)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS c FROM sets UNION SELECT l.y, r.c FROM reach r JOIN both_ways l ON l.x = r.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, c AS component_id FROM sets JOIN (SELECT x, min(c) AS c FROM reach GROUP BY x) ON x = doc_id
"""

VECTOR_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v)) / sqrt(list_dot_product(b.v, b.v)) >= 0.93),
reach AS (SELECT vec_id AS x, vec_id AS c FROM embeddings UNION SELECT l.y, r.c FROM reach r JOIN links l ON l.x = r.x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN (SELECT x, min(c) AS c FROM reach GROUP BY x) ON x = vec_id LEFT JOIN (SELECT x AS i, count(*) AS n FROM links GROUP BY x) ON i = vec_id
"""


RESAMPLING_SQL = r"""
WITH crc AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS t),
words AS (
  SELECT o, i, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT 's' AS o, doc_id AS i, text FROM documents UNION ALL SELECT 't', 0, text FROM benchmark)),
bytes AS (SELECT w, list_transform(range(strlen(w)), lambda k: CAST('0x' || hex(w)[2 * k + 1:2 * k + 2] AS BIGINT)) AS b FROM (SELECT DISTINCT w FROM words)),
buckets AS (SELECT w, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) % 10000 AS b FROM bytes, crc),
counts AS (SELECT b, count(*) FILTER (o = 's') AS s, count(*) FILTER (o = 't') AS t FROM words JOIN buckets USING (w) GROUP BY b),
gains AS (SELECT b, floor(1000 * ln((t + 1.0::DOUBLE) * (a.s_all + 10000) / ((s + 1.0::DOUBLE) * (a.t_all + 10000)))) AS g FROM counts, (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts) a),
means AS (SELECT i, count(*) AS n, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM words JOIN buckets USING (w) JOIN gains USING (b) WHERE o = 's' GROUP BY i),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN means ON i = doc_id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN r <= (SELECT count(*) FROM ranked) * 10 // 100 THEN r END AS rank FROM scored s LEFT JOIN ranked USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_importance_resampling": RESAMPLING_SQL, "op5_ngram_jaccard_join": JACCARD_SQL, "op9_embedding_near_duplicates": VECTOR_SQL}
