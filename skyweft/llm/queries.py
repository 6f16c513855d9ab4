"""The operators' queries over the whole driver tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, exact_dedup, html_text, packing, quality_rules, sentence_pieces, shards, simhash, token_counts, warc
from .shared import fresh_path
from .tokenizing import tokenizer_path

CONTROL_TEXT = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = _table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.windows(talks.unionByName(probe), tokenizer_path("byte_bpe_50k.json")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(_table(spark, sf_dir, "pages"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text's number of ids, an order-sensitive digest of them, and the length of what they decode to."""
    return sentence_pieces.digests(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(_table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.measured(_table(spark, sf_dir, "documents"))


ARRIVALS = 8


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive in ARRIVALS appends, with a compaction behind each; the rows are read back through the last version."""
    docs = _table(spark, sf_dir, "documents")
    store = shards.compacted(docs, fresh_path(spark, "shards"), F.pmod("doc_id", F.lit(ARRIVALS)), ARRIVALS)
    return store.read().select("doc_id", "source", "n_chars", F.sha2("text", 256).alias("text_sha256"))


def op10_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, and a second replica in which every 97th page's record has a wrong byte and every 389th is lost, its places counted
    from what it has: each record's length, digest and what the audit found."""
    first = warc.records(_table(spark, sf_dir, "pages"))
    wrong = F.when(F.pmod("page_id", F.lit(97)) == 5, F.overlay("record", F.encode(F.lit("X"), "UTF-8"), F.lit(1))).otherwise(F.col("record"))
    second = first.where(F.coalesce(F.pmod("page_id", F.lit(389)) != 11, F.lit(True))).select("file", "place", wrong.alias("record"))
    leaves = warc.index(first)
    found = warc.audit(warc.tree(leaves), warc.tree(warc.index(second, renumber=True)))
    pages = first.select("page_id", "file", "place").join(leaves, warc.KEY)
    return pages.join(found.select(*warc.KEY, "status"), warc.KEY, "left").select("page_id", "length", F.col("hash").alias("record_sha256"), F.coalesce("status", F.lit("intact")).alias("status"))


QUERIES = {f.__name__: f for f in (op1_chat_formatting, op2_token_counts, op3_html_extraction, op4_sentencepiece, op5_simhash, op6_exact_dedup, op7_packing, op8_quality_rules, op9_sharding, op10_warc_audit)}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality_rules.STOP_WORDS))

ORACLES = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op8_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]'), lambda x: x <> '') AS words,
                     list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
        t AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
        s AS (SELECT doc_id, p, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
        n AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, word, w2, w3) AS times FROM s WHERE w3 IS NOT NULL),
        r AS (SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM n, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY doc_id),
        m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                     (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                     (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                     len(lines) AS n_lines, len(list_filter(words, lambda x: lower(x) IN ({_STOP}))) AS n_stop
              FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
        b AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND 100 * n_symbols <= 30 * n_words
               AND 100 * n_dup_lines <= 60 * n_lines AND 1000 * n_stop >= 20 * n_words AS kept
        FROM b""",
    "op9_sharding": "SELECT doc_id, source, n_chars, sha256(text) AS text_sha256 FROM documents",
    "op10_warc_audit": r"""
        WITH p AS (SELECT page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS url, coalesce(html, '') AS html FROM pages),
        q AS (SELECT *, md5(coalesce(CAST(page_id AS VARCHAR), '') || ' ' || url || ' ' || html) AS m FROM p),
        r AS (SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:uuid:' || m[1:8] || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32]
                   || '>' || chr(13) || chr(10) || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
                   || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(html)
                   || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM q)
        SELECT page_id, strlen(record)::BIGINT AS length, sha256(record) AS record_sha256,
               CASE WHEN page_id % 389 = 11 THEN 'missing' WHEN page_id % 97 = 5 THEN 'damaged' ELSE 'intact' END AS status
        FROM r""",
}
