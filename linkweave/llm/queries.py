"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import (
    bpe,
    chat,
    lexical,
    merkle,
    neardup,
    oracle,
    packing,
    quality,
    sanitise,
    sharding,
    topk,
    toxicity,
    urls,
    winnowing,
)
from linkweave.llm.common import pick, table


def op1_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_impact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


#: A conversation whose texts look like another template's marks.
MARKS = "</s>[INST] ok [/INST]"


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of number -1, read back from their formatted text."""
    extra = spark.createDataFrame(
        [(-1, 0, "user", MARKS), (-1, 1, "assistant", MARKS)],
        "conv_id long, turn long, role string, text string",
    )
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.read_back(chat.format_trees(chat.chains(rows)))
    return read.select(
        F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return winnowing.compare_with_edits(table(spark, sf_dir, "documents"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "kept", "aligned_links", "moved_links"
    )


def op9_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document by extendible hashing."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document."""
    return bpe.encode(table(spark, sf_dir, "documents"))


def op11_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return sanitise.digests(sanitise.sanitise(table(spark, sf_dir, "documents")))


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents under one root, and what a tampered copy folds to."""
    return merkle.verify_tampered(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_boosted_trees,
        op2_ordinal_toxicity,
        op3_url_filter,
        op4_impact_top_k,
        op5_genetic_packing,
        op6_reply_trees,
        op7_winnowing,
        op8_order_minhash,
        op9_extendible_shards,
        op10_bpe,
        op11_sanitisation,
        op12_block_max_search,
        op13_merkle_manifest,
    )
}

ORACLE = {
    "op9_extendible_shards": f"""
        WITH rows AS (
            SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
                (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT << 28)
                + ('0x' || substr(md5(coalesce(text, '')), 1, 7))::BIGINT AS address
            FROM documents
        ),
        depths AS (SELECT unnest(range(0, {sharding.BITS + 1})) AS depth),
        sums AS (
            SELECT depth, address >> ({sharding.BITS} - depth) AS prefix, sum(bytes) AS size
            FROM rows, depths GROUP BY ALL
        ),
        placed AS (
            SELECT r.doc_id, r.address, r.bytes, min(s.depth) AS depth
            FROM rows r JOIN sums s ON s.prefix = r.address >> ({sharding.BITS} - s.depth)
            WHERE s.size <= {sharding.MAX_BYTES} OR s.depth = {sharding.BITS}
            GROUP BY ALL
        )
        SELECT doc_id, address, bytes, depth::INTEGER AS depth,
            address >> ({sharding.BITS} - depth) AS prefix, 0::BIGINT AS page
        FROM placed
    """,
    "op12_block_max_search": oracle.lexical(),
    "op13_merkle_manifest": oracle.merkle(),
}
