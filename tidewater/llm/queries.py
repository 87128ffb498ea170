"""The registered queries of the operators, with DuckDB SQL where SQL can say it.

Each query applies its operator to a whole table with production parameters and
derives the columns it returns from the operator's output.
"""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, cross_tokens, decontaminate, exact_dedup, line_dedup, mixing, packing, sharding, simhash, suffix_dedup, suffix_tree_lm, toxicity, warc

#: Bytes of text in a shard.
SHARD_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = toxicity.fold(F.col("doc_id")) == 1
    found = suffix_tree_lm.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "states")


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table of domains: the language of the documents in ``labels``."""
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("lang").alias("domain")).join(labels.select("doc_id"), "doc_id", "left_semi")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), domain_labels(spark, sf_dir), temper=0.7)
    rounded = F.transform("mixture.posterior", lambda p: F.round(p, 6))
    return found.select("doc_id", "mixture.n_tokens", "mixture.domain", rounded.alias("posterior"), F.round("mixture.rate", 6).alias("rate"), "mixture.copies")


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.ToxicityModel:
    """Fitted on labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(toxicity.fold(F.col("doc_id")) != 0)
    return toxicity.fit(docs, labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score_texts(docs, toxicity_model(spark, sf_dir, docs))
    score = F.col("toxicity.score")
    return found.select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
        (F.size("toxicity.passages") / 2).cast("int").alias("n_passages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrival = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3))
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), arrival)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"), length=200).drop("spans")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("contamination.item_ids") > 0).alias("contaminated"), "contamination.item_ids", F.round("contamination.best_score", 6).alias("best_score"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read_archive(warc.write_archive(table(spark, sf_dir, "pages")), payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digests(groups: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups.to_pylist()], pa.string())

    found = cross_tokens.align_tokenizers(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), keep=digests)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack_documents(table(spark, sf_dir, "documents"), 4096, tokenizer_path("word_bpe_49k.json"), end_id=2)

    @F.pandas_udf("long")
    def crc32(ids: pd.Series) -> pd.Series:
        return ids.map(lambda own: zlib.crc32(own.astype("<u4").tobytes()))

    return found.select("doc_id", "start", "length", crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"), block=100, most=6)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_suffix_tree_lm, op3_mixing, op4_toxicity, op5_exact_dedup, op6_simhash, op7_suffix_dedup,
        op8_decontaminate, op9_warc, op10_sharding, op11_cross_tokens, op12_packing, op13_conversation_trie,
    )
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (SELECT *, {_ASCII_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM lines),
        frequent AS (
            SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
            GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        judged AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id < f.last_doc AS dropped FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op5_exact_dedup": r"""
        WITH normal AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        grouped AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM normal n JOIN grouped g ON n.t = g.t""",
    "op9_warc": """
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
        digits AS (
            SELECT *, list_aggregate(list_transform(range(40), lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i + 1, 1)) - 1), 4, '0')), 'string_agg', '') AS bits FROM hashed),
        coded AS (
            SELECT *, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (list_sum(list_transform(range(5), lambda j: substr(bits, (5 * i + j + 1)::INT, 1)::INT * (16 >> j)::INT)) + 1)::INT, 1)), 'string_agg', '') AS digest FROM digits),
        best AS (SELECT html, max(page_id) AS response_id FROM coded GROUP BY html)
        SELECT c.page_id, octet_length(encode(c.html))::BIGINT AS payload_bytes, c.digest AS payload_digest,
               CASE WHEN c.page_id = b.response_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN c.page_id = b.response_id THEN NULL ELSE b.response_id END AS refers_to
        FROM coded c JOIN best b ON c.html = b.html""",
    "op10_sharding": f"""
        WITH hashed AS (
            SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes, md5(doc_id::VARCHAR) AS hex FROM documents),
        bits AS (
            SELECT doc_id, n_bytes, list_aggregate(list_transform(range(32), lambda i: lpad(bin(strpos('0123456789abcdef', substr(hex, i + 1, 1)) - 1), 4, '0')), 'string_agg', '') AS bits FROM hashed),
        prefixes AS (SELECT b.*, d.depth::INT AS depth, substr(bits, 1, d.depth::INT) AS prefix FROM bits b, range(0, 33) d(depth)),
        fits AS (SELECT depth, prefix FROM prefixes GROUP BY depth, prefix HAVING sum(n_bytes) <= {SHARD_BYTES})
        SELECT p.doc_id, min_by(p.prefix, p.depth) AS shard, min(p.depth) AS depth, any_value(p.n_bytes) AS n_bytes, false AS oversize
        FROM prefixes p JOIN fits f ON p.depth = f.depth AND p.prefix = f.prefix GROUP BY p.doc_id""",
}
