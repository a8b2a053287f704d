"""Blocking keys and the candidate space they span.

A block is one letter, so a block may hold a third of all records and the number
of pairs in it grows with the square. The candidate space is therefore kept
factored, as block rows, and is counted, filtered and ranked (``matching``) in
that form; no operator here writes out the pairs of a block.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import text
from linkweave.operators.lookup import lookup_join

LETTERS = list(string.ascii_lowercase)


def block_rows(records: DataFrame) -> DataFrame:
    """One row per record and block key. ``records`` has one row per record.

    The outer form of explode keeps Spark from computing the keys a second time
    in a filter of its own on non-empty arrays.
    """
    return records.select(*S.RECORD_KEY, F.explode_outer(text.block_keys()).alias("block")).where(
        "block IS NOT NULL"
    )


def block_stats(records: DataFrame) -> DataFrame:
    """Rows in and block rows out, in one pass over the records."""
    return records.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.sum(F.size(text.block_keys()).cast("bigint")).alias("n_block_rows"),
    )


def in_blocks(blocking_key: str | None = None) -> Column:
    """Filter on one block, or on a to z when none is named."""
    return F.col("block").isin([blocking_key] if blocking_key else LETTERS)


def record_block_sets(blocks: DataFrame, record_type: str) -> DataFrame:
    """Per record the sorted array of its block keys."""
    return (
        blocks.where(F.col("record_type") == record_type)
        .groupBy("record_id")
        .agg(F.array_sort(F.collect_set("block")).alias("blocks"))
    )


def candidate_counts(
    blocks: DataFrame, source_type: str = "gpo", target_type: str = "pm"
) -> DataFrame:
    """Number of distinct targets that share a block with each source.

    Counted on sets of block keys: a record has at most three of the 28 possible
    keys, so there are at most 3,682 sets on either side however many records
    there are, and the pairing below is bounded by that.
    """
    sources = record_block_sets(blocks, source_type)
    target_sets = (
        record_block_sets(blocks, target_type)
        .groupBy("blocks")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    meeting = (
        sources.select("blocks").distinct()
        .withColumn("block", F.explode("blocks"))
        .join(
            target_sets.select(
                F.col("blocks").alias("target_blocks"), "n", F.explode("blocks").alias("block")
            ),
            "block",
        )
        .select("blocks", "target_blocks", "n")
        .distinct()
    )
    counts = meeting.groupBy("blocks").agg(F.sum("n").alias("n_candidates"))
    return sources.join(F.broadcast(counts), "blocks").select(
        F.col("record_id").alias("source_id"), "n_candidates"
    )


def pairs_in_blocks(pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """Of the given pairs, those whose records share a block, with the shared blocks.

    ``blocks`` has one row per record and block.
    """
    keyed = pairs
    for side in ("source", "target"):
        sets = blocks.groupBy("record_type", "record_id").agg(
            F.collect_set("block").alias(f"_{side}_blocks")
        )
        names = {"record_type": f"{side}_type", "record_id": f"{side}_id"}
        keyed = lookup_join(keyed, sets.withColumnsRenamed(names), list(names.values()))
    shared = F.array_intersect("_source_blocks", "_target_blocks")
    return keyed.select(*pairs.columns, F.explode(shared).alias("block"))
