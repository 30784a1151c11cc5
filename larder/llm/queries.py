"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import alignment, chat, chunk_bpe, classifier, licenses, nn_descent, packing, quality, sharding, simhash, substrings, variants, warc
from larder.llm.common import table
from larder.plans.registry import query
from larder.session import scratch_path


@query("op1_mixture_packing")
def mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@query("op2_nn_descent")
def nn_descent_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op3_quality_ratio")
def quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_simhash_blocks")
def simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_fm_index_substrings")
def fm_index_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query("op7_ftrl_classifier")
def ftrl_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("hits")


@query("op8_chunk_reuse_bpe")
def chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.digests(table(spark, sf_dir, "documents"))


@query("op9_sampled_splitters")
def sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.document_shards(table(spark, sf_dir, "documents")).drop("group")


CHAT_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *,
        length(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')) + 23 AS chars,
        row_number() OVER w AS k, count(*) OVER (PARTITION BY conv_id) AS n
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), running AS (
    SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM sized
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(upto) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM running GROUP BY conv_id
"""


@query("op10_prefix_target_chat", CHAT_SQL)
def prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(control).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digest(chat.expand_prefix_targets(turns))


WARC_SQL = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hexadecimal,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
    FROM pages
), parts AS (
    SELECT *, list_transform([1, 11, 21, 31], lambda k: ('0x' || substr(hexadecimal, k, 10))::BIGINT) AS forty FROM payloads
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
    array_to_string(list_transform(forty, lambda v: array_to_string(
        list_transform(range(8), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> (35 - 5 * k)::INT) & 31)::INT + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM parts
"""


@query("op11_warc_archive", WARC_SQL)
def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.written_and_read(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


@query("op12_spelling_variants")
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


@query("op13_tokenizer_alignment")
def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), with_groups=False)
