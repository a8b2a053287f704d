"""Best targets per source inside the blocks, without writing out the pairs.

The score of a pair is the cosine of the two sets of name parts, each part weighted
by its rarity. It depends on the shared parts and the length of both vectors only.
For a source and a set X of its parts, the best target that has X is the one with
the shortest vector, whatever the source. So it is enough to keep, for every block
and every set of name parts, the k shortest targets: a target left out of the list
of X = (parts shared with the source) has k better ones in that list. A record has
three name parts, hence at most eight sets, and the work is linear in the records.
The empty set stands for targets that share nothing and score 0.

Weights are held as whole numbers, so sums do not depend on their order and equal
scores compare as equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import text
from linkweave.operators.lookup import lookup_join
from linkweave.session import stored

_WEIGHTED = "array<struct<term:string,weight:bigint>>"
_SUBSETS = "array<struct<terms:array<string>,dot:bigint>>"
_SCALE = 1_000_000


def linkable(records: DataFrame) -> DataFrame:
    """What the ranked join reads of a record: key, block keys, name parts.

    The join passes over this several times, so store it first.
    """
    return records.select(
        *S.RECORD_KEY, text.block_keys().alias("blocks"), text.name_terms().alias("terms")
    )


def weighted_terms(linked: DataFrame) -> DataFrame:
    """Distinct sets of name parts with the weight of each part and of the whole.

    The weight is the squared rarity, the smooth inverse document frequency over
    all records given. Copies of a name are folded before anything else moves.
    """
    sets = linked.groupBy("terms").agg(F.count(F.lit(1)).alias("n"))
    total = linked.agg(F.count(F.lit(1))).scalar().cast("double")
    rarity = F.log((1.0 + total) / (1.0 + F.sum("n"))) + 1.0
    parts = sets.select("terms", "n", F.explode("terms").alias("term"))
    weights = parts.groupBy("term").agg(
        F.round(rarity * rarity * _SCALE).cast("bigint").alias("weight")
    )
    weighted = (
        lookup_join(parts, weights, ["term"])
        .groupBy("terms")
        .agg(
            F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("parts"),
            F.sum("weight").alias("length"),
        )
    )
    empty = sets.where(F.size("terms") == 0).select(
        "terms",
        F.array().cast(_WEIGHTED).alias("parts"),
        F.lit(0).cast("bigint").alias("length"),
    )
    return weighted.unionByName(empty)


def _subsets(parts: Column) -> Column:
    """All sets of the weighted parts, each with the sum of its weights."""
    start = F.array(
        F.struct(
            F.array().cast("array<string>").alias("terms"),
            F.lit(0).cast("bigint").alias("dot"),
        )
    ).cast(_SUBSETS)

    def grow(sets: Column, part: Column) -> Column:
        larger = F.transform(
            sets,
            lambda s: F.struct(
                F.array_append(s["terms"], part["term"]).alias("terms"),
                (s["dot"] + part["weight"]).alias("dot"),
            ),
        )
        return F.concat(sets, larger).cast(_SUBSETS)

    return F.aggregate(parts, start, grow)


def _top(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= k)


def best_targets(
    linked: DataFrame,
    source_type: str = "gpo",
    target_type: str = "pm",
    k: int = S.TOP_K,
    min_score: float = S.MIN_MATCH_SCORE,
) -> DataFrame:
    """Per source the k best targets with a sufficient score, or else the best one.

    ``linked`` has one row per record, as ``linkable`` makes it. The result equals
    scoring every pair of every block and ranking by score, then target id. Sources
    whose blocks hold no target have no row.
    """
    linked = linked.where(F.col("record_type").isin(source_type, target_type))
    sources = linked.where(F.col("record_type") == source_type)
    targets = linked.where(F.col("record_type") == target_type)
    weighted = weighted_terms(linked)

    # Copies of a name need no more than their k smallest ids.
    named = _top(
        targets.select("record_id", "terms", F.explode("blocks").alias("block")),
        ["block", "terms"],
        [F.col("record_id")],
        k,
    ).drop("_rank")
    by_set = (
        named.join(weighted, "terms")
        .select("block", "record_id", "length", F.explode(_subsets(F.col("parts"))).alias("s"))
        .select("block", F.col("s.terms").alias("shared"), "record_id", "length")
    )
    shortest = _top(
        by_set.where(F.size("shared") > 0),
        ["block", "shared"],
        [F.col("length"), F.col("record_id")],
        k,
    ).select("block", "shared", F.col("record_id").alias("target_id"), "length")

    wanted = (
        sources.select("blocks", "terms")
        .distinct()
        .join(weighted, "terms")
        .select(
            "blocks", "terms", F.col("length").alias("own"), "parts",
            F.explode("blocks").alias("block"),
        )
    )
    score = F.col("dot") / F.sqrt(F.col("own").cast("double") * F.col("length").cast("double"))
    asked = wanted.select(
        "blocks", "terms", "own", "block", F.explode(_subsets(F.col("parts"))).alias("s")
    ).select("blocks", "terms", "own", "block", F.col("s.terms").alias("shared"), "s.dot")
    sharing = lookup_join(asked, shortest, ["block", "shared"]).select(
        "blocks", "terms", "target_id", score.alias("score")
    )
    # At most k rows for each of the 28 possible block keys.
    first_ids = _top(
        targets.select("record_id", F.explode("blocks").alias("block")),
        ["block"],
        [F.col("record_id")],
        k,
    ).select("block", F.col("record_id").alias("target_id"))
    strangers = (
        sources.select("blocks", "terms")
        .distinct()
        .select("blocks", "terms", F.explode("blocks").alias("block"))
        .join(F.broadcast(first_ids), "block")
        .select("blocks", "terms", "target_id", F.lit(0.0).alias("score"))
    )

    # One exchange serves both the folding of repeated finds and the ranking.
    found = (
        sharing.unionByName(strangers)
        .repartition("blocks", "terms")
        .groupBy("blocks", "terms", "target_id")
        .agg(F.max("score").alias("score"))
    )
    ranked = _top(
        found, ["blocks", "terms"], [F.col("score").desc(), F.col("target_id")], k
    ).where((F.col("score") >= min_score) | (F.col("_rank") == 1))
    return lookup_join(sources, ranked, ["blocks", "terms"]).select(
        F.lit(source_type).alias("source_type"),
        F.col("record_id").alias("source_id"),
        F.lit(target_type).alias("target_type"),
        "target_id",
        "score",
    )


def agreeing(records: DataFrame, attributes: list[str]) -> DataFrame:
    """What ranking by agreement reads of a record: key, block keys, prepared values.

    Values stand in the order of ``attributes``; a missing one is NULL and agrees with none.
    """
    values = [
        text.prep_text(a) if a in records.columns else F.lit(None).cast("string")
        for a in attributes
    ]
    return records.select(
        *S.RECORD_KEY, text.block_keys().alias("blocks"), F.array(*values).alias("values")
    )


def _agreements(n: int) -> Column:
    """Every non-empty set of present values, as a mask and the values (others NULL)."""
    def chosen(mask: Column) -> Column:
        return F.transform(
            "values", lambda v, i: F.when(F.getbit(mask, i) == 1, v)
        )

    present = F.aggregate(
        F.transform("values", lambda v, i: F.when(v.isNotNull(), F.lit(1)).otherwise(0) * F.pow(F.lit(2), i).cast("int")),
        F.lit(0), lambda a, b: a + b,
    )
    masks = F.filter(
        F.sequence(F.lit(1), F.lit((1 << n) - 1)), lambda m: m.bitwiseAND(present) == m
    )
    return F.transform(masks, lambda m: F.struct(m.alias("mask"), chosen(m).alias("shared")))


def _by_agreement(rows: DataFrame, n: int, kept: str) -> DataFrame:
    """(kept, mask, key): a row for each block and set of present values.

    The key is a 128-bit digest of block, mask and values, which all rows of a set share: it is
    far shorter than they are.
    """
    return (
        rows.select(kept, F.explode("blocks").alias("block"), F.transform("values", lambda v: F.md5(v)).alias("values"))
        .select(kept, "block", F.explode(_agreements(n)).alias("s"))
        .select(
            kept, "s.mask",
            F.unhex(F.md5(F.concat_ws(",", "block", F.col("s.mask").cast("string"), "s.shared"))).alias("key"),
        )
    )


def agreement_lists(
    linked: DataFrame, n: int, source_type: str = "gpo", target_type: str = "pm", k: int = S.TOP_K
) -> tuple[DataFrame, DataFrame]:
    """(record_id, class_id) of the sources, and (class_id, mask, ids): k targets per set of agreements.

    Sources alike are one class. For each block and each set of agreeing values the k smallest
    target ids are kept, and for no agreement (mask 0) those of the block. A target whose
    agreement with a source is exactly a set, but that is not in the set's list, has k others
    before it that agree in at least as much; so the lists hold the k best by any score that
    rises with agreement, ties by id. Records alike in all values are folded, so the work is
    linear in the records: at most 2**n sets each. A list stays one row.
    """
    sources = linked.where(F.col("record_type") == source_type)
    targets = linked.where(F.col("record_type") == target_type).select("record_id", "blocks", "values")
    ids = F.collect_list(F.struct("record_id")).alias("ids")
    folded = _top(targets, ["blocks", "values"], [F.col("record_id")], k).drop("_rank")
    lists = _top(_by_agreement(folded, n, "record_id"), ["key"], [F.col("record_id")], k).groupBy("key").agg(ids)
    classes = stored(
        sources.select("blocks", "values").distinct().withColumn("class_id", F.monotonically_increasing_id())
    )
    sharing = lookup_join(_by_agreement(classes, n, "class_id"), lists, ["key"]).select("class_id", "mask", "ids")
    # At most k rows for each of the 28 possible block keys.
    first_ids = _top(
        targets.select("record_id", F.explode("blocks").alias("block")), ["block"], [F.col("record_id")], k
    ).groupBy("block").agg(ids)
    strangers = (
        classes.select("class_id", F.explode("blocks").alias("block"))
        .join(F.broadcast(first_ids), "block").select("class_id", F.lit(0).alias("mask"), "ids")
    )
    # Values may be NULL inside, but the arrays themselves are not, so they join.
    members = lookup_join(sources.select("record_id", "blocks", "values"), classes, ["blocks", "values"])
    return members.select("record_id", "class_id"), sharing.unionByName(strangers)


def classified_targets(
    linked: DataFrame,
    weights: dict[str, float],
    intercept: float,
    source_type: str = "gpo",
    target_type: str = "pm",
    k: int = S.TOP_K,
    min_score: float = S.MIN_MATCH_SCORE,
) -> DataFrame:
    """Per source the k best targets by a logistic model of agreements, or else the best one.

    ``linked`` has one row per record, as ``agreeing`` makes it for the weights' attributes;
    weights are not negative. The result equals scoring every pair of every block.
    """
    if min(weights.values()) < 0:
        raise ValueError("weights must not be negative")
    odds = F.lit(intercept)
    for i, weight in enumerate(weights.values()):
        odds = odds + F.getbit("mask", F.lit(i)).cast("double") * F.lit(weight)
    members, lists = agreement_lists(linked, len(weights), source_type, target_type, k)
    # Where a list is full, k targets have its odds or better: lists of lower odds add none.
    full = F.max(F.when(F.size(F.array_distinct("ids")) >= k, F.col("odds"))).over(Window.partitionBy("class_id"))
    found = (
        lists.select("class_id", odds.alias("odds"), "ids")
        .withColumn("full", full)
        .where(F.col("full").isNull() | (F.col("odds") >= F.col("full")))
        .select("class_id", "odds", F.explode("ids").alias("t"))
        .groupBy("class_id", F.col("t.record_id").alias("target_id"))
        .agg(F.max("odds").alias("odds"))
        .withColumn("score", 1.0 / (1.0 + F.exp(-F.col("odds"))))
    )
    ranked = _top(found, ["class_id"], [F.col("odds").desc(), F.col("target_id")], k).where(
        (F.col("score") >= min_score) | (F.col("_rank") == 1)
    )
    return lookup_join(members, ranked, ["class_id"]).select(
        F.lit(source_type).alias("source_type"),
        F.col("record_id").alias("source_id"),
        F.lit(target_type).alias("target_type"),
        "target_id",
        "score",
    )


def proposed_pairs(
    linked: DataFrame, n: int, source_type: str = "gpo", target_type: str = "pm", k: int = S.TOP_K
) -> DataFrame:
    """Pairs for a classifier to score: k targets per source and set of agreements."""
    members, lists = agreement_lists(linked, n, source_type, target_type, k)
    pairs = lists.select("class_id", F.explode("ids").alias("t")).select(
        "class_id", F.col("t.record_id").alias("target_id")
    ).distinct()
    return lookup_join(members, pairs, ["class_id"]).select(
        F.lit(source_type).alias("source_type"),
        F.col("record_id").alias("source_id"),
        F.lit(target_type).alias("target_type"),
        "target_id",
    )
