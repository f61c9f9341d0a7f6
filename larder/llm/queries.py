"""Registered queries of this package, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import (
    boosted_trees,
    exact_dedup,
    filter_audit,
    hyperminhash,
    line_dedup,
    multi_index,
    packing,
    personal_data,
    sentencepiece_scan,
    sharding,
    toxicity,
    warc,
    whitening,
)
from larder.sources.storage import Scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_maxplus_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    merged = sentencepiece_scan.MergedVocabulary
    return sentencepiece_scan.round_trips(table(spark, folder, "documents"), model, Scratch(spark), kind=merged)


def op2_inverted_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.neighbours(table(spark, folder, "embeddings"), 50, Scratch(spark))


def op3_dictionary_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"), Scratch(spark))


def op4_fuzzy_lexicon_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_hyperminhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, folder, "documents"), Scratch(spark), percent=85)


def op6_perfect_hash_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with an even id are the earlier ones; all rows of both halves are returned."""
    docs = table(spark, folder, "documents")
    earlier = F.coalesce(F.pmod("doc_id", F.lit(2)) == 0, F.lit(False))
    return exact_dedup.exact_duplicates(docs.filter(earlier), docs.filter(~earlier), Scratch(spark))


def op7_boosted_trees_quality(spark: SparkSession, folder: str) -> DataFrame:
    return boosted_trees.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_minimax_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"), Scratch(spark))


def op9_first_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), Scratch(spark))


def op10_fuzzy_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    lines = F.when(F.length("text") > 0, F.size(F.split("text", "\n"))).otherwise(0)
    kept = line_dedup.deduplicated(docs, Scratch(spark), "n_removed")
    return kept.select(
        "doc_id",
        lines.cast("long").alias("n_lines"),
        F.col("n_removed").cast("long"),
        F.octet_length("text").cast("long").alias("text_bytes"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op11_bilstm_crf_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "documents"))


def op12_bit_sliced_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


def op13_filter_interaction_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_maxplus_sentencepiece": op1_maxplus_sentencepiece,
    "op2_inverted_multi_index": op2_inverted_multi_index,
    "op3_dictionary_warc": op3_dictionary_warc,
    "op4_fuzzy_lexicon_toxicity": op4_fuzzy_lexicon_toxicity,
    "op5_hyperminhash_near_dedup": op5_hyperminhash_near_dedup,
    "op6_perfect_hash_exact_dedup": op6_perfect_hash_exact_dedup,
    "op7_boosted_trees_quality": op7_boosted_trees_quality,
    "op8_minimax_sharding": op8_minimax_sharding,
    "op9_first_fit_packing": op9_first_fit_packing,
    "op10_fuzzy_line_dedup": op10_fuzzy_line_dedup,
    "op11_bilstm_crf_personal_data": op11_bilstm_crf_personal_data,
    "op12_bit_sliced_whitening": op12_bit_sliced_whitening,
    "op13_filter_interaction_audit": op13_filter_interaction_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op3_dictionary_warc": """
        SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest,
            CASE WHEN strlen(html) >= 1000 AND page_id <> winner THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN strlen(html) >= 1000 AND page_id <> winner THEN winner END AS refers_to
        FROM (
            SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner
            FROM pages
        )
    """,
    "op5_hyperminhash_near_dedup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), sets AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
        ), edges AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, p.n, q.n
            HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM documents
            UNION
            SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
        ), least AS (
            SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
        )
        SELECT l.doc_id, coalesce(n, 0) AS n_shingles, component_id, l.doc_id = component_id AS kept
        FROM least l LEFT JOIN sizes USING (doc_id)
    """,
    "op6_perfect_hash_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (
            SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
                max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
        )
    """,
    "op13_filter_interaction_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), failures AS (
            SELECT doc_id, part,
                CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
                || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS failed
            FROM words
        ), marked AS (
            SELECT f.*, l.good, l.toxic
            FROM failures f LEFT JOIN (
                SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
            ) l USING (doc_id)
        ), letters AS (
            SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
        ), orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
        ), steps AS (
            SELECT filter_order, step, filter_order[step] AS letter,
                filter_order[1 : step - 1] AS earlier, filter_order[1 : step] AS so_far
            FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step)
        ), seen AS (
            SELECT m.part, s.filter_order, s.step, s.letter, m.failed, m.good, m.toxic,
                translate(earlier, failed, '') = earlier AS came,
                translate(so_far, failed, '') = so_far AS stays,
                contains(failed, letter) AS fails
            FROM marked m, steps s
        ), report AS (
            SELECT part, filter_order, step, letter,
                count(*) FILTER (stays) AS kept,
                count(*) FILTER (came AND fails) AS removed,
                count(*) FILTER (fails AND NOT came) AS redundant,
                count(*) FILTER (failed = letter) AS unique_fails,
                count(*) FILTER (came AND fails AND good = 1) AS good_lost,
                count(*) FILTER (came AND fails AND toxic = 1) AS toxic_lost
            FROM seen GROUP BY ALL
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
        FROM report
    """,
}
