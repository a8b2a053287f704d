"""The forest's best targets against scoring every pair; near names against all pairs of names."""

import random

import pytest
from conftest import TESTDATA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_skew import final_plan

from linkweave.operators import features, lattice, model, spelling
from linkweave.plans import fixtures as fx
from linkweave.plans.queries import QUERIES, forest
from linkweave.session import stored

FOLDER = str(TESTDATA / "sf0.001")


def all_pairs(sources, targets, fitted):
    """Every pair of every block, scored and ranked."""
    inputs = lattice.Inputs(fitted)
    a = lattice.comparable(sources, inputs.attributes).withColumnsRenamed(
        {"values": "own_values", "name": "own_name", "blocks": "own_blocks", "record_id": "source_id"}
    ).drop("record_type")
    b = lattice.comparable(targets, inputs.attributes).withColumnRenamed("record_id", "target_id").drop("record_type")
    pairs = a.join(b, F.arrays_overlap("own_blocks", "blocks")).select("source_id", "target_id", *inputs.pair_columns())
    scored = fitted.transform(pairs).select("source_id", "target_id", F.get(vector_to_array("_probability"), 1).alias("score"))
    window = Window.partitionBy("source_id").orderBy(F.desc("score"), "target_id")
    ranked = scored.withColumn("rank", F.row_number().over(window))
    kept = ranked.where("(rank <= 5 AND score >= 0.2) OR rank = 1")
    return {(r.source_id, r.target_id, round(r.score, 9)) for r in kept.collect()}, pairs.count()


def found(df):
    return {(r.source_id, r.target_id, round(r.score, 9)) for r in df.collect()}


def test_forest_targets_on_the_tables(spark):
    known = fx.record(spark, FOLDER)
    sources, targets = known.where("record_type = 'gpo'"), known.where("record_type = 'pm'")
    fitted = forest(spark, FOLDER)
    wanted, n = all_pairs(sources, targets, fitted)
    assert n == 2748
    assert found(lattice.forest_targets(sources, targets, fitted)) == wanted
    assert len({r.source_id for r in QUERIES["forest_targets"](spark, FOLDER).collect()}) == len({s for s, _, _ in wanted})


def people(spark, kind, n, seed):
    rng = random.Random(seed)
    first = ["ann", "bob", "carla", None, "jon", "john"]
    last = [f"sm{a}th{b}" for a in "aiyeou" for b in ("", "e", "son")] + [None]
    rows = [
        (kind, i, rng.choice(first), None, rng.choice(last), rng.choice("ab") * rng.randrange(2) or None, f"n{rng.randrange(n)}")
        for i in range(n)
    ]
    rows += [(kind, n + i, "hot", None, "name", "a", "n0") for i in range(n // 2)]
    return spark.createDataFrame(rows, "record_type string, record_id long, first_name string, middle_name string, last_name string, country string, npi string")


@pytest.mark.parametrize("columns", [
    ["name_match_score", "first_name_match", "last_name_match", "npi_match"],
    ["name_match_score", "country_match"], ["country_match", "npi_match"], ["name_match_score"],
    ["name_match_score", "last_name_match", "f_name_freq_src"],
])
def test_forests_that_do_not_rise_with_agreement(spark, columns):
    """Labels at random: the forest's scores follow no order, and names near in spelling matter."""
    sources, targets = people(spark, "gpo", 60, 1), people(spark, "pm", 90, 2)
    sources = features.name_frequency(sources, "first_name", "f_name_freq")
    rng = random.Random(3)
    named = [f"fg_legacy.{c}" for c in columns]
    rows = [
        (*[round(rng.random(), 2) if "score" in c else float(rng.randrange(30)) if "freq" in c else float(rng.random() < 0.5) for c in columns], rng.random() < 0.4)
        for _ in range(300)
    ]
    training = spark.createDataFrame(rows, ", ".join(f"fg_legacy_{c} double" for c in columns) + ", is_match boolean")
    fitted = model.fit(training, named)
    wanted, _ = all_pairs(sources, targets, fitted)
    assert found(lattice.forest_targets(sources, targets, fitted)) == wanted


def test_near_spelling_beats_five_smaller_ids(spark):
    """A pair nearer in spelling is proposed, however many others agree in as much."""
    columns = "record_type string, record_id long, first_name string, middle_name string, last_name string, country string"
    sources = spark.createDataFrame([("gpo", 1, "Jon", None, "Smyth", "us")], columns)
    others = [("pm", 10 + i, "Jack", None, f"Other{'abcdef'[i]}", "us") for i in range(6)]
    targets = spark.createDataFrame([*others, ("pm", 100, "John", None, "Smith", "us")], columns)
    linked = lattice.comparable(sources, ["country"]).unionByName(lattice.comparable(targets, ["country"]))
    assert [(r.source_id, r.target_id) for r in spelling.near_pairs(linked).collect()] == [(1, 100)]


def test_near_names_against_all_pairs(spark):
    rng = random.Random(1)

    def edited(name):
        letters = list(name)
        for _ in range(rng.randrange(6)):
            at, kind = rng.randrange(len(letters) + 1), rng.randrange(3)
            letters[at:at + (kind > 0)] = [rng.choice("abc ")] * (kind < 2)
        return "".join(letters)

    base = ["".join(rng.choice("abc ") for _ in range(rng.randrange(28))) for _ in range(60)]
    names = sorted({edited(b) for b in base for _ in range(20)})
    df = stored(spark.createDataFrame([(x, [rng.choice("ab")]) for x in names], "name string, blocks array<string>"))
    got = spelling.near_names(df, df).select("source_name", "target_name", "edits")
    edits = "levenshtein(x.name, y.name)"
    longest = "greatest(length(x.name), length(y.name))"
    wanted = df.alias("x").join(df.alias("y"), F.expr(f"x.blocks = y.blocks AND {longest} > 0 AND {edits} * 100 <= 20 * {longest}"))
    wanted = wanted.selectExpr("x.name AS source_name", "y.name AS target_name", f"{edits} AS edits")
    assert got.count() == wanted.count() > 1000
    assert wanted.exceptAll(got).count() == 0


def test_hot_segment_is_split(spark):
    """A third of all names share one segment; its rows do not go to one task."""
    names = spark.range(6000).repartition(8).selectExpr(
        "if(id % 3 = 0, concat('qq', substr(md5(string(id)), 1, 6)), substr(md5(string(id)), 1, 8)) AS name", "array('a') AS blocks"
    )
    plan = final_plan(spark, lambda: spelling.near_names(names, names))
    assert "skew=true" in plan


def test_model_id_follows_the_nodes(spark):
    columns = ["name_match_score", "npi_match"]
    rows = [(i / 50, float(i % 3 == 0), i % 4 == 0) for i in range(50)]
    training = spark.createDataFrame(rows, "fg_legacy_name_match_score double, fg_legacy_npi_match double, is_match boolean")
    named = [f"fg_legacy.{c}" for c in columns]
    first, again = model.fit(training, named), model.fit(training, named)
    assert model.post_train_model_id(first) == model.post_train_model_id(again)
    nodes = stored(model.tree_nodes(first))
    moved = nodes.withColumn("nodeData", F.expr("""if(treeID = 7 AND nodeData.id = 0,
        named_struct('id', nodeData.id, 'prediction', nodeData.prediction, 'impurity', nodeData.impurity, 'impurityStats', nodeData.impurityStats,
            'rawCount', nodeData.rawCount, 'gain', nodeData.gain, 'leftChild', nodeData.leftChild, 'rightChild', nodeData.rightChild,
            'split', named_struct('featureIndex', nodeData.split.featureIndex, 'leftCategoriesOrThreshold', array(0.123D), 'numCategories', nodeData.split.numCategories)),
        nodeData)"""))
    assert model.nodes_digest(nodes) == model.nodes_digest(nodes.orderBy(F.rand()))
    assert model.nodes_digest(nodes) != model.nodes_digest(moved)


def test_forest_scores_each_set_of_features_once(spark):
    """Six pairs with two sets of features: the forest reads two rows, and both have its scores."""
    columns = ["fg_legacy_name_match_score", "fg_legacy_country_match"]
    training = spark.createDataFrame(
        [(i / 10, float(i % 2), i > 4) for i in range(10)], ", ".join(f"{c} double" for c in columns) + ", is_match boolean"
    )
    fitted = model.fit(training, ["fg_legacy.name_match_score", "fg_legacy.country_match"])
    rows = stored(spark.createDataFrame([(i, 0.9 if i % 2 else 0.1, 1.0) for i in range(6)], f"class_id long, {columns[0]} double, {columns[1]} double"))
    scores = {r[0]: r.score for r in lattice.distinct_scores(fitted, rows, lattice.Inputs(fitted)).collect()}
    each = fitted.transform(rows).select(columns[0], F.get(vector_to_array("_probability"), 1).alias("score")).collect()
    assert len(scores) == 2 and all(scores[r[0]] == r.score for r in each)


def fitted_by(spark, rows, columns):
    training = spark.createDataFrame(rows, ", ".join(f"fg_legacy_{c} double" for c in columns) + ", is_match boolean")
    return model.fit(training, [f"fg_legacy.{c}" for c in columns])


def test_near_names_follow_a_split_point_below_their_limit(spark, monkeypatch):
    """Names above 0.77 score high, and none here is: one round proves it, lists do not grow."""
    fitted = fitted_by(spark, [(0.54, 0.0, False), (1.0, 0.0, True)] * 20, ["name_match_score", "country_match"])
    columns = "record_type string, record_id long, first_name string, middle_name string, last_name string, country string"
    sources = spark.createDataFrame([("gpo", 1, "aaaa", None, "bbbbbbbb", "us")], columns)
    others = [("pm", 10 + i, f"a{c}{c}{c}", None, c * 9, "fr") for i, c in enumerate("cdefghijklmnopqrstuv")]
    depths, lists = [], lattice._lists
    monkeypatch.setattr(lattice, "_lists", lambda targets, n, depth: depths.append(depth) or lists(targets, n, depth))
    for far in ([], [("pm", 99, "aaaa", None, "bbbbbbccc", "de")]):
        targets = spark.createDataFrame(others + far, columns)
        wanted, _ = all_pairs(sources, targets, fitted)
        assert found(lattice.forest_targets(sources, targets, fitted)) == wanted
        assert {t for _, t, _ in wanted} == ({99} if far else {10})
    assert depths == [lattice.FIRST] * 2


def test_a_hot_name_does_not_meet_itself_in_pairs(spark, monkeypatch):
    """Forty sources and forty targets of one name, half of them with a number in common: lists, not 1,600 pairs."""
    rng = random.Random(4)
    rows = [(rng.random(), float(rng.random() < 0.5), rng.random() < 0.4) for _ in range(200)]
    fitted = fitted_by(spark, rows, ["name_match_score", "npi_match"])
    columns = "record_type string, record_id long, first_name string, middle_name string, last_name string, npi string"
    people = [[(kind, i, "ann", None, "smith", f"n{i}" if i % 2 else f"{kind}{i}") for i in range(40)] for kind in ("gpo", "pm")]
    sources, targets = (spark.createDataFrame(rows, columns) for rows in people)
    scored, scores = [], lattice.distinct_scores
    monkeypatch.setattr(lattice, "distinct_scores", lambda f, rows, inputs: scored.append(rows.count()) or scores(f, rows, inputs))
    wanted, _ = all_pairs(sources, targets, fitted)
    assert found(lattice.forest_targets(sources, targets, fitted)) == wanted
    assert sum(scored) < 800
