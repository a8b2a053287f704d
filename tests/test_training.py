import datetime as dt
import math

import pytest

from linkweave.operators import features, model, numbering, training
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)


def feedback(spark, rows):
    schema = "source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, is_match BOOLEAN, tess_modified_at TIMESTAMP"
    return spark.createDataFrame([("gpo", s, "pm", t, y, at) for s, t, y, at in rows], schema)


def group(spark, rows):
    schema = "run_id STRING, source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, x DOUBLE, created_at TIMESTAMP"
    return spark.createDataFrame([(r, "gpo", s, "pm", t, x, at) for r, s, t, x, at in rows], schema)


def test_training_set_takes_newest_label_and_newest_features(spark):
    day = dt.timedelta(days=1)
    fb = feedback(spark, [(1, 1, True, T0), (1, 1, False, T0 + day), (2, 1, None, T0 + day), (2, 1, True, T0), (3, 1, True, T0)])
    fg = group(spark, [("a", 1, 1, 0.1, T0), ("b", 1, 1, 0.9, T0 + day), ("a", 2, 1, 0.5, T0)])
    rows = training.training_set(fb, {"fg_one": fg}, ["fg_one.x"]).collect()
    assert [(r.source_id, r.is_match, r.fg_one_x) for r in rows] == [(1, False, 0.9)]


def test_scoring_set_is_of_one_run_and_complete(spark):
    schema = "run_id STRING, block STRING, source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT"
    pairs = spark.createDataFrame(
        [("r", "a", "gpo", 1, "pm", 1), ("r", "b", "gpo", 1, "pm", 1), ("r", " ", "gpo", 2, "pm", 1), ("r", "c", "gpo", 3, "pm", 1), ("q", "a", "gpo", 4, "pm", 1)],
        schema,
    )
    fg = group(spark, [("r", 1, 1, 0.5, T0), ("q", 1, 1, 0.1, T0), ("r", 2, 1, 0.5, T0), ("r", 3, 1, float("nan"), T0), ("r", 4, 1, 0.5, T0)])
    rows = training.scoring_set(pairs, {"g": fg}, ["g.x"], "r").collect()
    assert [(r.source_id, r.g_x) for r in rows] == [(1, 0.5)]
    assert training.scoring_set(pairs, {"g": fg}, ["g.x"], "r", "c").count() == 0


def labelled(spark, n=4000):
    """Nine in ten rows in one class."""
    return spark.range(n).selectExpr(
        "'gpo' AS source_type", "id AS source_id", "'pm' AS target_type", "id * 7 AS target_id",
        "id % 10 = 0 AS is_match", "if(id % 10 = 0, 0.9D, 0.1D) AS g_x", "CAST(id % 13 AS DOUBLE) AS g_y",
    )


def test_undersample_is_exact_and_repeatable(spark):
    df = labelled(spark)
    first = training.undersample(df)
    counts = {r.is_match: r.n for r in training.class_counts(first).collect()}
    assert counts == {True: 400, False: 400}
    again = training.undersample(df.repartition(5, "g_y"))
    assert {r.source_id for r in first.collect()} == {r.source_id for r in again.collect()}
    other = {r.source_id for r in training.undersample(df, seed=1).collect()}
    assert other != {r.source_id for r in first.collect()}


def test_resampled_by_name(spark):
    df = labelled(spark, 100)
    assert training.resampled(df, None) is df
    assert training.resampled(df, "RandomUnderSampler").count() == 20
    with pytest.raises(ValueError):
        training.resampled(df, "Other")


def test_model_roundtrip(spark, tmp_path):
    names = ["g.x", "g.y"]
    df = labelled(spark, 600).cache()
    fitted = model.fit(df, names)
    again = model.fit(df, names)
    post = model.post_train_model_id(fitted)
    assert post == model.post_train_model_id(again)
    assert model.accuracy(fitted, df).first().accuracy == 1.0
    unfitted = model.MODELS["random_forest"](model.feature_columns(names))
    pre = model.pre_train_model_id(unfitted, names)
    assert pre != model.pre_train_model_id(unfitted, names[::-1])
    model.save(fitted, str(tmp_path), pre, post)
    loaded = model.load(str(tmp_path), pre, post)
    one = {r.source_id: r.score for r in model.pair_scores(fitted, df).collect()}
    two = {r.source_id: r.score for r in model.pair_scores(loaded, df).collect()}
    assert one == two and model.post_train_model_id(loaded) == post
    assert all((score > 0.5) == (i % 10 == 0) for i, score in one.items())


def test_model_of_fixed_weights(spark, tmp_path):
    df = spark.createDataFrame(
        [("gpo", 1, "pm", 2, 1.0, 1.0, True), ("gpo", 3, "pm", 4, 0.0, 0.0, False), ("gpo", 5, "pm", 6, 0.5, 0.0, True)],
        "source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, g_name_match_score DOUBLE, g_npi_match DOUBLE, is_match BOOLEAN",
    )
    names = ["g.name_match_score", "g.npi_match"]
    fitted = model.fit(df, names, model="fixed_logistic")
    scores = {r.source_id: r.score for r in model.pair_scores(fitted, df).collect()}
    assert scores == pytest.approx({1: 1 / (1 + math.exp(-4)), 3: 1 / (1 + math.exp(2)), 5: 1 / (1 + math.exp(1))})
    assert model.accuracy(fitted, df).first().accuracy == pytest.approx(2 / 3)
    post = model.post_train_model_id(fitted)
    model.save(fitted, str(tmp_path), "pre", post)
    loaded = model.load(str(tmp_path), "pre", post)
    assert {r.source_id: r.score for r in model.pair_scores(loaded, df).collect()} == scores
    assert post != model.post_train_model_id(model.fit(df, names[:1], model="fixed_logistic"))
    with pytest.raises(ValueError):
        model.fit(df, ["g.unknown"], model="fixed_logistic")


def test_only_row(spark):
    df = spark.range(3)
    assert training.only_row(df.where("id = 1"), "row").id == 1
    with pytest.raises(LookupError, match="no row"):
        training.only_row(df.where("id > 9"), "row")
    with pytest.raises(LookupError, match="more than one"):
        training.only_row(df, "row")


def test_backfill_takes_labelled_pairs_without_features(spark):
    fb = feedback(spark, [(1, 1, True, T0), (2, 1, None, T0), (3, 1, False, T0), (3, 1, True, T0)])
    fg = group(spark, [("a", 1, 1, 0.1, T0)])
    assert [r.source_id for r in features.backfill_pairs(fb, fg).collect()] == [3]


def test_numbering_over_several_key_blocks(spark):
    keys = [-70000, -1, 0, 5, 65535, 65536, 200000, 2**31 - 1]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k INT")
    rows = numbering.numbered(df, "k", F.lit(100).cast("bigint"), "n").collect()
    assert {r.k: r.n for r in rows} == {k: 101 + i for i, k in enumerate(keys)}


def test_complete_pairs_only(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "i INT, x DOUBLE")
    assert [r.i for r in training.drop_incomplete(df).collect()] == [1]
