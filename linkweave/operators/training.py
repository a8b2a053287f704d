"""Training and scoring sets, sampling, model registry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import naming, text
from linkweave.operators import blocking, latest


def _with_groups(
    pairs: DataFrame, groups: dict[str, DataFrame], features: list[str], how: str
) -> DataFrame:
    """Join one feature row per pair from each group; columns named group_feature.

    Every join is on the four pair keys, so the pairs are exchanged once.
    """

    def attach(left: DataFrame, item: tuple[str, list[str]]) -> DataFrame:
        group, names = item
        columns = [F.col(n).alias(naming.feature_column(group, n)) for n in names]
        return left.join(groups[group].select(*S.PAIR_KEY, *columns), S.PAIR_KEY, how)

    return reduce(attach, naming.features_by_group(features).items(), pairs)


def training_set(
    feedback: DataFrame,
    groups: dict[str, DataFrame],
    features: list[str],
    label: str = "is_match",
) -> DataFrame:
    """Latest labelled feedback with the features of every group.

    A pair seen in several runs takes its newest feature row.
    """
    labelled = (
        latest.latest_feedback(feedback)
        .where(F.col(label).isNotNull())
        .select(*S.PAIR_KEY, label)
    )
    newest = {name: latest.latest_features(df) for name, df in groups.items()}
    return _with_groups(labelled, newest, features, "inner")


def scoring_set(
    run_pairs: DataFrame,
    groups: dict[str, DataFrame],
    features: list[str],
    run_id: str,
    blocking_key: str | None = None,
) -> DataFrame:
    """Pairs of a run with the run's features, one row per pair, complete rows only."""
    pairs = (
        run_pairs.where((F.col("run_id") == run_id) & blocking.in_blocks(blocking_key))
        .select(*S.PAIR_KEY)
        .distinct()
    )
    of_run = {name: latest.latest_features(df, run_id) for name, df in groups.items()}
    return drop_incomplete(_with_groups(pairs, of_run, features, "inner"))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without a NULL or NaN in any column."""
    return df.na.drop("any")


def class_counts(training: DataFrame, label: str = "is_match") -> DataFrame:
    return training.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def _sample_order(keys: list[str], seed: int) -> Column:
    return F.expr(f"md5(concat_ws('|', '{seed}', {', '.join(keys)}))")


def undersample(
    training: DataFrame,
    label: str = "is_match",
    keys: list[str] = S.PAIR_KEY,
    seed: int = S.SAMPLE_SEED,
) -> DataFrame:
    """Every class cut down to the size of the smallest, exactly and repeatably.

    Rows are taken in the order of a hash of their keys. Instead of ordering a
    whole class in one task, rows are counted by the first four hex digits of the
    hash; only rows up to the bucket in which the quota runs out are ranked, and
    ranked inside their bucket. The rows are read twice, so store a costly
    training set first.
    """
    rows = training.withColumn("_order", _sample_order(keys, seed)).withColumn(
        "_bucket", F.substring("_order", 1, 4)
    )
    counts = rows.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # At most 65,536 buckets per class.
    running = Window.partitionBy(label).orderBy("_bucket")
    before = counts.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
    quota = counts.groupBy(label).agg(F.sum("_n").alias("n")).agg(F.min("n")).scalar()
    wanted = before.where(F.col("_before") < quota).select(label, "_bucket", "_before")
    inside = Window.partitionBy(label, "_bucket").orderBy("_order", *keys)
    return (
        rows.join(wanted, [label, "_bucket"])
        .withColumn("_rank", F.row_number().over(inside))
        .where(F.col("_before") + F.col("_rank") <= quota)
        .select(*training.columns)
    )


SAMPLERS = {"RandomUnderSampler": undersample}


def resampled(training: DataFrame, method: str | None, label: str = "is_match") -> DataFrame:
    if not method:
        return training
    if method not in SAMPLERS:
        raise ValueError(f"unknown sampling method {method!r}")
    return SAMPLERS[method](training, label)


def append_pre_train(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """Registry with those rows whose id it does not hold yet."""
    new = rows.join(registry.select("pre_train_model_id"), "pre_train_model_id", "left_anti")
    return registry.unionByName(new.select(*registry.columns))


def append_post_train(registry: DataFrame, rows: DataFrame) -> DataFrame:
    return registry.unionByName(rows.select(*registry.columns))


def run_models(run_inference: DataFrame, run_id: str, pre_train_model_id: str) -> DataFrame:
    """Trained models that a run uses for one untrained model."""
    return run_inference.where(
        (F.col("run_id") == run_id) & (F.col("pre_train_model_id") == pre_train_model_id)
    )


def primary_models(run_inference: DataFrame, pre_train: DataFrame) -> DataFrame:
    """Primary model of every run, its feature list as an array."""
    return (
        run_inference.where(F.col("is_primary"))
        .select("run_id", "pre_train_model_id", "post_train_model_id")
        .join(pre_train, "pre_train_model_id")
        .withColumn("input_features", text.split_list("input_features"))
    )


def only_row(df: DataFrame, what: str):
    """The single row of a small result; anything but one row is an error."""
    rows = df.limit(2).collect()
    if not rows:
        raise LookupError(f"no {what} found")
    if len(rows) > 1:
        raise LookupError(f"more than one {what} found")
    return rows[0]
