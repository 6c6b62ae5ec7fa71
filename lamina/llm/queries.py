"""The registered queries of the thirteen operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import (
    alignment,
    class_lm,
    divergence,
    exact_dedup,
    id_files,
    line_quality,
    near_dedup,
    packing,
    sentence_pieces,
    substring_dedup,
    token_counts,
    toxicity,
    trie_bpe,
)
from lamina.llm.common import read_documents, tokenizer_path
from lamina.session import Staging

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(spark, f"{sf_dir}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_documents(spark, sf_dir), tokenizer_path(BYTE_BPE))


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_texts(read_documents(spark, sf_dir))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    field = line_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return line_quality.judge_texts(docs, field)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_texts(docs, model)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_digests(read_documents(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read_documents(spark, sf_dir))


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = id_files.output_folder(spark, "id-files")
    files = id_files.write_ids(read_documents(spark, sf_dir), tokenizer_path(BYTE_BPE), folder)
    return id_files.id_digests(files)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_documents(spark, sf_dir), tokenizer_path(WORD_BPE))


def op10_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.round_trip_digests(read_documents(spark, sf_dir), tokenizer_path(BYTE_BPE))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return alignment.link_counts(
        docs, tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE), Staging(spark)
    )


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trip_digests(
        read_documents(spark, sf_dir), tokenizer_path(PIECE_BPE)
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_documents(spark, sf_dir), Staging(spark))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_token_counts,
        op3_class_lm,
        op4_line_quality,
        op5_toxicity,
        op6_substring_dedup,
        op7_near_dedup,
        op8_id_files,
        op9_packing,
        op10_trie_bpe,
        op11_alignment,
        op12_sentence_pieces,
        op13_divergence,
    )
}
SQL = {
    "op1_exact_dedup": """
        WITH t AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256)""",
    "op13_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang,
                coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        words AS (
            SELECT d, lang, source,
                unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM docs),
        kept AS (
            SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term
            HAVING count(DISTINCT d) >= 3),
        langs AS (SELECT lang, sum(n) + count(*) AS total, count(*) AS v FROM kept GROUP BY lang),
        counts AS (
            SELECT w.lang, w.source, w.term, count(*) AS n
            FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term
            GROUP BY w.lang, w.source, w.term),
        sources AS (
            SELECT g.lang, g.source, l.total AS lang_total,
                coalesce(s.n, 0) + l.v AS total
            FROM (SELECT DISTINCT lang, source FROM docs) g
            LEFT JOIN langs l ON g.lang = l.lang
            LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source) s
                ON g.lang = s.lang AND g.source = s.source),
        shares AS (
            SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // s.total::HUGEINT AS p,
                1 + (1000000000::HUGEINT * (k.n + 1)) // s.lang_total::HUGEINT AS q
            FROM sources s JOIN kept k ON s.lang = k.lang
            LEFT JOIN counts c ON s.lang = c.lang AND s.source = c.source AND k.term = c.term),
        sums AS (
            SELECT a.lang, a.source, b.source AS item,
                sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
            FROM shares a JOIN shares b
                ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s
                ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (
            SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
            FROM shares WHERE n > 0 AND p > q)
        SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (
            PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
        FROM pairs
        UNION ALL
        SELECT lang, source, 'term' AS part, item, value, (row_number() OVER (
            PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank
        FROM terms QUALIFY rank <= 200""",
}
