"""One row per key, top-k per key, and other rankings.

Every ranking here is ``row_number() <= k`` straight above its window, the form
for which Spark plans a partial limit before the shuffle: each task sends at most
k rows of a key, so a hot key stays small. All orders are total: whatever the
caller's order leaves open is settled by the remaining columns, or for stored tables by
the order of the imports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave import schemas as S

_RANK = "_rank"


def _remaining(df: DataFrame, used: list[str]) -> list[Column]:
    unordered = (T.MapType, T.VariantType)
    return [
        F.expr(f"`{field.name}`").asc_nulls_last()
        for field in df.schema.fields
        if field.name not in used and not isinstance(field.dataType, unordered)
    ]


#: Number that every row of an import gets when it is stored.
SEQUENCE = "sequence"
#: What settles equal times of a stored table: the later import wins, and in one import the
#: later row.
IMPORT_ORDER = ("imported_at", "import_process_id", SEQUENCE)


def first_per_key(
    df: DataFrame, keys: list[str], newest: str | None = None, then: list[Column] | None = None
) -> DataFrame:
    """One row per key: the newest by ``newest``, then the first by ``then``.

    Without ``then`` the remaining columns settle ties, the smallest first. That makes the
    order total but lets no column be pruned; large stored tables give a narrow order.
    """
    order = [F.col(newest).desc_nulls_last()] if newest else []
    order += _remaining(df, keys + ([newest] if newest else [])) if then is None else then
    window = Window.partitionBy(*keys).orderBy(*(order or keys))
    return df.withColumn(_RANK, F.row_number().over(window)).where(f"{_RANK} = 1").drop(_RANK)


def import_order(df: DataFrame) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in IMPORT_ORDER if c in df.columns]


def latest_version(df: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """Newest row per key of a change log; of equal times, the later import's.

    Only the keys and the order's own columns enter the order, so a reader of few columns
    scans and shuffles few.
    """
    return first_per_key(df, keys, newest, import_order(df))


def latest_records(records: DataFrame) -> DataFrame:
    return latest_version(records, S.RECORD_KEY, "tess_modified_at")


def merged(held: DataFrame, new: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """Current rows and newer ones, one row per key on either side, as current rows.

    A join on the key: where the current rows lie in buckets by it, they are read as they lie.
    Each column is chosen by itself, so a reader of few columns scans few.
    """
    order = [newest, *[c for c in IMPORT_ORDER if c in held.columns]]
    a, b = held.alias("held"), new.alias("new")
    both = a.join(b, [F.col(f"held.{k}") == F.col(f"new.{k}") for k in keys], "full")
    first, second = (F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in ("held", "new"))
    is_new = F.col(f"held.{keys[0]}").isNull() | (F.col(f"new.{keys[0]}").isNotNull() & (second >= first))
    return both.select([F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"held.{c}")).alias(c) for c in held.columns])


def latest_feedback(feedback: DataFrame) -> DataFrame:
    """Newest label per pair; rows of a stored log carry what settles equal times."""
    if SEQUENCE in feedback.columns:
        return latest_version(feedback, S.PAIR_KEY, "tess_modified_at")
    return first_per_key(feedback, S.PAIR_KEY, "tess_modified_at")


def latest_features(features: DataFrame, run_id: str | None = None) -> DataFrame:
    """Newest feature row per pair, of one run where a run is given.

    A stage writes a pair once in a run's part, so run, process and part settle equal times.
    """
    rows = features if run_id is None else features.where(F.col("run_id") == run_id)
    written = [F.col(c).desc_nulls_last() for c in ("run_id", "process_id", "part") if c in rows.columns]
    return first_per_key(rows, S.PAIR_KEY, "created_at", written or None)


def latest_scores(scores: DataFrame) -> DataFrame:
    """Newest score per pair: a pair may be scored in several blocks, and again.

    Of equal times the best score stands.
    """
    better = [real_score("score").desc_nulls_last()]
    return first_per_key(scores, S.PAIR_KEY, "created_at", better)


def dedup_records(records: DataFrame) -> DataFrame:
    """One row per record where no version order is known."""
    return first_per_key(records, S.RECORD_KEY)


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    newest = "created_at" if "created_at" in pairs.columns else None
    return first_per_key(pairs, S.PAIR_KEY, newest)


def upsert(
    current: DataFrame, changes: DataFrame, keys: list[str], precombine: str
) -> DataFrame:
    """Rows of both, latest version per key; of equal times the change wins."""
    side = "_side"
    both = current.withColumn(side, F.lit(0)).unionByName(
        changes.withColumn(side, F.lit(1)), allowMissingColumns=True
    )
    order = [F.col(side).desc(), *import_order(both)]
    return first_per_key(both, keys, precombine, order).drop(side)


def real_score(column: str) -> Column:
    """A score with NaN as NULL; Spark would sort and compare NaN as the largest."""
    return F.when(~F.isnan(column), F.col(column))


def top_k_with_fallback(
    scores: DataFrame,
    partition: list[str],
    k: int = S.TOP_K,
    min_score: float = S.MIN_MATCH_SCORE,
    score: str = "score",
) -> DataFrame:
    """Best k rows with a sufficient score, or else the best row whatever its score."""
    clean = scores.withColumn(score, real_score(score))
    window = Window.partitionBy(*partition).orderBy(
        F.col(score).desc_nulls_last(), *_remaining(clean, partition + [score])
    )
    ranked = clean.withColumn(_RANK, F.row_number().over(window))
    # "rank <= k AND (enough OR rank = 1)" keeps the rows of the form
    # "(rank <= k AND enough) OR rank = 1" but lets the limit reach the window.
    keep = (F.col(_RANK) <= k) & ((F.col(score) >= min_score) | (F.col(_RANK) == 1))
    return ranked.where(keep).drop(_RANK)


def run_scores(
    scores: DataFrame,
    run_id: str,
    post_train_model_id: str,
    source_type: str,
    target_type: str,
) -> DataFrame:
    """Scores of one run, model and pair of record types."""
    return scores.where(
        (F.col("run_id") == run_id)
        & (F.col("post_train_model_id") == post_train_model_id)
        & (F.col("source_type") == source_type)
        & (F.col("target_type") == target_type)
    )


def best_above(
    proposals: DataFrame,
    threshold: float = S.AUTO_APPROVE_SCORE,
    partition: str = "source_id",
    score: str = "score",
) -> DataFrame:
    """Best proposal per source among those that reach the threshold."""
    passing = proposals.withColumn(score, real_score(score)).where(F.col(score) >= threshold)
    return first_per_key(passing, [partition], score)


def latest_batch(batch_sources: DataFrame) -> DataFrame:
    return first_per_key(batch_sources, ["CollectionSourceId"], "BatchId")
