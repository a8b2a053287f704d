"""The match classifier: definition, fitting, scoring, identity."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import naming
from linkweave.session import new_path

LABEL = "_label"


def random_forest(features: list[str]) -> Pipeline:
    """Random forest on the given feature columns, with a fixed seed."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="_features"),
            RandomForestClassifier(
                featuresCol="_features",
                labelCol=LABEL,
                probabilityCol="_probability",
                rawPredictionCol="_raw",
                predictionCol="_prediction",
                numTrees=100,
                maxDepth=30,
                seed=S.MODEL_SEED,
            ),
        ]
    )


# A documented model with fixed weights: log odds by agreeing attribute. The weights are
# sums of powers of two, so equal agreements have exactly equal scores in any order.
FIXED_INTERCEPT = -2.0
FIXED_WEIGHTS = {
    "first_name": 1.0,
    "middle_name": 0.5,
    "last_name": 1.5,
    "country": 0.25,
    "npi": 4.0,
    "organization_name": 0.75,
}
#: Log odds of a name that agrees letter by letter; a near one has its share.
FIXED_SCORE_WEIGHT = 2.0


def _fixed_weight(column: str) -> float:
    if column.endswith("name_match_score"):
        return FIXED_SCORE_WEIGHT
    for attribute, weight in FIXED_WEIGHTS.items():
        if column.endswith(f"_{attribute}_match"):
            return weight
    raise ValueError(f"the model of fixed weights has none for {column!r}")


def fixed_logistic(features: list[str]) -> Pipeline:
    """Logistic model with the fixed weights: learns nothing, and scores alike everywhere."""
    odds = " + ".join([f"{FIXED_INTERCEPT}D", *(f"{_fixed_weight(c)}D * `{c}`" for c in features)])
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {odds} AS _odds FROM __THIS__"),
            SQLTransformer(
                statement="SELECT *, CAST(_odds > 0 AS DOUBLE) AS _prediction, 1 / (1 + exp(_odds)) AS _p0, "
                "1 / (1 + exp(-_odds)) AS _p1 FROM __THIS__"
            ),
            VectorAssembler(inputCols=["_p0", "_p1"], outputCol="_probability"),
        ]
    )


# A model is a function from feature columns to an unfitted pipeline.
MODELS: dict[str, Callable[[list[str]], Pipeline]] = {
    "random_forest": random_forest,
    "fixed_logistic": fixed_logistic,
}


def feature_columns(features: list[str]) -> list[str]:
    return [naming.feature_column(*naming.split_feature(name)) for name in features]


def _labelled(training: DataFrame, label: str) -> DataFrame:
    return training.withColumn(LABEL, F.col(label).cast("double"))


def fit(
    training: DataFrame, features: list[str], label: str = "is_match", model: str = "random_forest"
) -> PipelineModel:
    fitted = MODELS[model](feature_columns(features)).fit(_labelled(training, label))
    # The copy leaves the training summary behind. It holds the session, which cannot go into
    # tasks once rows were observed in it.
    return fitted.copy()


def accuracy(fitted: PipelineModel, training: DataFrame, label: str = "is_match") -> DataFrame:
    """Share of training rows the model gets right; an overestimate by nature."""
    predicted = fitted.transform(_labelled(training, label))
    right = (F.col("_prediction") == F.col(LABEL)).cast("double")
    return predicted.agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"))


def pair_scores(fitted: PipelineModel, scoring: DataFrame, **metadata) -> DataFrame:
    """Probability of a match per pair. The label True is class 1.0."""
    scored = fitted.transform(scoring).select(
        *S.PAIR_KEY, F.get(vector_to_array("_probability"), 1).alias("score")
    )
    return scored.withColumns({k: F.lit(v) for k, v in metadata.items()})


def _digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def _stages_hash(stages: list) -> str:
    """Hash of stages and their explicit parameters."""
    named = [
        [type(stage).__name__, {p.name: repr(v) for p, v in stage._paramMap.items()}] for stage in stages
    ]
    return _digest(json.dumps(named, sort_keys=True))


def model_code_hash(pipeline: Pipeline) -> str:
    return _stages_hash(pipeline.getStages())


def pre_train_model_id(pipeline: Pipeline, features: list[str], label: str = "is_match") -> str:
    return _digest(json.dumps([model_code_hash(pipeline), list(features), label]))


#: What of a saved tree node decides its predictions.
_NODE = "nodeData.id, nodeData.prediction, nodeData.impurityStats, nodeData.leftChild, nodeData.rightChild, nodeData.split"
#: 15 hex digits of a digest as a number: sums of them do not depend on the order.
_PART = "CAST(conv(substr({digest}, {at}, 15), 16, 10) AS DECIMAL(38, 0))"


def tree_nodes(fitted: PipelineModel) -> DataFrame:
    """The nodes of all trees, as Spark saves them: treeID and nodeData."""
    spark = SparkSession.active()
    path = new_path(spark)
    fitted.write().save(path)
    return spark.read.parquet(f"{path}/stages/1_*/data")


def _combined(rows: DataFrame, digest: str, *keys: str) -> DataFrame:
    """One digest for the rows of each key, whatever their order."""
    parts = [F.sum(F.expr(_PART.format(digest=digest, at=at))).alias(f"_{at}") for at in (1, 16, 31, 46)]
    sums = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *parts)
    return sums.select(*keys, F.sha2(F.concat_ws(",", "_n", "_1", "_16", "_31", "_46"), 256).alias("digest"))


def nodes_digest(nodes: DataFrame) -> str:
    """Digest of the nodes of a forest: of each node, put together by tree, then over the trees."""
    each = nodes.select("treeID", F.sha2(F.to_json(F.expr(f"struct({_NODE})")), 256).alias("node"))
    trees = _combined(each, "node", "treeID")
    whole = _combined(trees.select(F.sha2(F.concat_ws(",", "treeID", "digest"), 256).alias("tree")), "tree")
    return whole.first()["digest"]


def post_train_model_id(fitted: PipelineModel) -> str:
    """Hash of the fitted trees, their weights and the order of their inputs.

    The nodes are read as Spark saves them and hashed by Spark: no tree passes the driver.
    A model without trees is what its stages' parameters say.
    """
    forest = fitted.stages[-1]
    if not isinstance(forest, RandomForestClassificationModel):
        return _stages_hash(fitted.stages)
    assembler = fitted.stages[0]
    shape = [assembler.getInputCols(), list(forest.treeWeights), nodes_digest(tree_nodes(fitted))]
    return _digest(json.dumps(shape))


def model_path(base: str, pre_id: str, post_id: str) -> str:
    return f"{base}/{pre_id}/{post_id}"


def save(fitted: PipelineModel, base: str, pre_id: str, post_id: str) -> str:
    path = model_path(base, pre_id, post_id)
    fitted.write().overwrite().save(path)
    return path


def load(base: str, pre_id: str, post_id: str) -> PipelineModel:
    return PipelineModel.load(model_path(base, pre_id, post_id))
