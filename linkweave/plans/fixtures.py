"""Linkage tables derived from the test tables (see FIXTURES.md).

The size of each follows its input. Records, feedback and features are stored
tables in a run as well; they are written once per session, so that the document
texts are not read again for every use.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.operators import blocking, export, features, importing, latest, matching
from linkweave.operators.lookup import lookup_join
from linkweave.session import stored

RUN = "run_1"
MODEL = "post_1"
NOW = "2024-03-01 00:00:00"
EPOCH_2024 = 1_704_067_200
EPOCH_FEBRUARY = 1_706_745_600
MODEL_FEATURES = [
    "fg_legacy.name_match_score",
    "fg_legacy.first_name_match",
    "fg_legacy.last_name_match",
    "fg_legacy.npi_match",
]


_kept: dict[tuple, DataFrame] = {}


def kept(build):
    """Build a table once per session and folder, as a stored table."""

    @functools.wraps(build)
    def lookup(spark: SparkSession, sf: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf, build.__name__)
        if key not in _kept:
            _kept[key] = stored(build(spark, sf))
        return _kept[key]

    return lookup


def forget() -> None:
    """Build all tables anew at their next use, so that queries can be timed by themselves."""
    _kept.clear()


# Given, so that no job has to read the footers first.
SCHEMAS = {
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


@kept
def record_version(spark: SparkSession, sf: str) -> DataFrame:
    """Person-like records cut from documents; every tenth has a second version."""
    return (
        documents(spark, sf)
        .selectExpr(
            "doc_id", "split(text, '[ \\n]', 4) AS words", "lang", "source", "md5(text) AS npi", "n_chars",
            "explode(if(doc_id % 10 = 0, array(0, 1), array(0))) AS ver",
        )
        .selectExpr(
            "if(doc_id % 2 = 0, 'gpo', 'pm') AS record_type",
            "doc_id AS record_id",
            "nullif(get(words, 0), '') AS first_name",
            "nullif(get(words, 1), '') AS middle_name",
            "if(ver = 0 AND doc_id % 10 = 0, 'null', nullif(get(words, 2), '')) AS last_name",
            "lang AS country",
            "source AS organization_name",
            "npi",
            "n_chars AS publication_count",
            """CASE WHEN doc_id % 50 = 0 THEN 0 WHEN doc_id % 50 = 2 THEN NULL
                    ELSE CAST(11 + doc_id % 7 AS INT) END AS collection_source_id""",
            f"timestamp_seconds({EPOCH_2024} + 60 * (doc_id + ver * 100000)) AS tess_modified_at",
        )
    )


def record(spark: SparkSession, sf: str) -> DataFrame:
    return latest.latest_records(record_version(spark, sf))


@kept
def feedback(spark: SparkSession, sf: str) -> DataFrame:
    """Labels: the first exact copy of a source is a match, the next document is none.

    Every third source has an older, opposite label.
    """
    hashed = documents(spark, sf).selectExpr("doc_id", "md5(text) AS h")
    sources = hashed.where("doc_id % 2 = 0").withColumnRenamed("doc_id", "source_id")
    targets = hashed.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "target_id")
    copies = targets.groupBy("h").agg(F.min("target_id").alias("target_id"))
    match = lookup_join(sources, copies, ["h"]).selectExpr("source_id", "target_id", "true AS y")
    other = (
        sources.withColumn("target_id", F.expr("source_id + 1"))
        .join(targets.withColumnRenamed("h", "next_h"), "target_id")
        .where("h <> next_h")
        .selectExpr("source_id", "target_id", "false AS y")
    )
    return (
        match.unionByName(other)
        .selectExpr("*", "explode(if(source_id % 3 = 0, array(0, 1), array(1))) AS ver")
        .selectExpr(
            "'gpo' AS source_type",
            "source_id",
            "'pm' AS target_type",
            "target_id",
            "if(ver = 0, NOT y, y) AS is_match",
            f"timestamp_seconds({EPOCH_FEBRUARY} + 60 * (source_id + ver * 100000)) AS tess_modified_at",
        )
    )


def block_record(spark: SparkSession, sf: str) -> DataFrame:
    return importing.with_metadata(
        blocking.block_rows(record(spark, sf)),
        run_id=RUN,
        created_at=F.lit(NOW).cast("timestamp"),
    )


def match_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Stored scores: each source with the next seven odd ids, in two runs.

    Scores repeat on purpose; a quarter of the sources has low scores only.
    """
    ids = table(spark, sf, "documents").select("doc_id")
    return (
        ids.where("doc_id % 2 = 0")
        .selectExpr("doc_id AS source_id", "explode(sequence(doc_id + 1, doc_id + 13, 2L)) AS target_id")
        .join(ids.withColumnRenamed("doc_id", "target_id"), "target_id", "left_semi")
        .selectExpr(
            "source_id", "target_id", "explode(array('run_0', 'run_1')) AS run_id",
            "((source_id * 31 + target_id * 17) % 1000) / 1000.0D AS base",
        )
        .selectExpr(
            "run_id",
            "'gpo' AS source_type",
            "source_id",
            "'pm' AS target_type",
            "target_id",
            """CASE WHEN run_id = 'run_0' THEN 0.99D
                    WHEN (source_id + target_id) % 97 = 0 THEN NULL
                    WHEN source_id % 8 = 2 THEN round(base * 0.15D, 6)
                    ELSE base END AS score""",
            "'pre_1' AS pre_train_model_id",
            f"'{MODEL}' AS post_train_model_id",
            f"""timestampadd(HOUR, -CAST(if(run_id = 'run_0', target_id, source_id) % 3 AS INT),
                timestamp '{NOW}') AS created_at""",
        )
    )


def current_scores(spark: SparkSession, sf: str) -> DataFrame:
    return latest.run_scores(match_scores(spark, sf), RUN, MODEL, "gpo", "pm")


@kept
def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Stored features of all labelled pairs, each with an older, stale row."""
    records = record(spark, sf)
    pairs = feedback(spark, sf).select(*S.PAIR_KEY).distinct()
    rows = features.FgLegacy().run(
        pairs,
        records.where("record_type = 'gpo'"),
        records.where("record_type = 'pm'"),
        run_id=RUN,
        process_id="process_1",
    )
    times = f"array(timestamp '2024-02-28 00:00:00', timestamp '{NOW}')"
    return rows.withColumn("created_at", F.expr(f"explode({times})")).withColumn(
        "name_match_score", F.expr(f"if(created_at < timestamp '{NOW}', 0.0D, name_match_score)")
    )


def run_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled pairs that share a block, one row per shared block."""
    pairs = feedback(spark, sf).select(*S.PAIR_KEY).distinct()
    shared = blocking.pairs_in_blocks(pairs, block_record(spark, sf))
    return shared.withColumn("run_id", F.lit(RUN))


def proposals(spark: SparkSession, sf: str) -> DataFrame:
    """Best targets by name, the output of the ranked join."""
    return matching.best_targets(stored(matching.linkable(record(spark, sf))))


def assembly(spark: SparkSession, sf: str, scores: DataFrame | None = None) -> DataFrame:
    return export.export_assembly(
        block_record(spark, sf),
        match_scores(spark, sf) if scores is None else scores,
        record_version(spark, sf),
        {"fg_legacy": feature_table(spark, sf)},
        [f"fg_legacy.{c}" for c in features.FgLegacy.columns],
        RUN,
        MODEL,
    )


def decided(spark: SparkSession, sf: str) -> DataFrame:
    return (
        current_scores(spark, sf)
        .where((F.col("source_id") + F.col("target_id")) % 5 == 0)
        .select(F.col("source_id").alias("SourceID"), F.col("target_id").alias("TargetID"))
    )


def import_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(
        "event_type AS record_type", "event_id AS record_id", "user_id",
        "ts AS tess_modified_at", "value",
    )


def stored_log(spark: SparkSession, sf: str) -> DataFrame:
    """What an earlier import has stored of the log."""
    return import_log(spark, sf).where("tess_modified_at < timestamp_ntz '2024-01-10 00:00:00'")


def lookup_source(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").selectExpr(
        "n_nationkey AS LookupID", "n_name AS LookupValue",
        "if(n_nationkey % 5 = 0, 0, 1) AS IsActive",
    )


def batch_collection_source(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS BatchId", "s_nationkey AS CollectionSourceId",
        "if(s_suppkey % 4 = 0, 0, 1) AS IsActive",
    )


def batch(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS BatchId", "s_suppkey % 7 AS ConfigurationId",
        "if(s_suppkey % 6 = 0, 2, 1) AS Status",
    )


def matching_result(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey + 1000 AS MatchingResultId", "s_suppkey AS BatchId",
        f"if(s_suppkey % 9 = 0, 'other_rule', '{S.RULE_NAME}') AS RuleName",
    )


def configuration(spark: SparkSession, sf: str) -> DataFrame:
    """Configurations with a stored schema text; its keys come in either order."""
    return table(spark, sf, "part").selectExpr(
        "p_partkey AS ConfigurationId",
        "concat('cfg ', p_name) AS ConfigurationName",
        """CASE p_partkey % 3 WHEN 0 THEN '{"b": [1, 2], "a": "x"}'
                WHEN 1 THEN '{"a": "x", "b": [1, 2]}' ELSE '{"a": "y"}' END AS ColumnSchema""",
    )


def batch_tables(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [
        f(spark, sf)
        for f in (lookup_source, batch_collection_source, batch, matching_result, configuration)
    ]


def pre_train_model(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").selectExpr(
        "concat('pre_', n_nationkey) AS pre_train_model_id",
        "'is_match' AS dependent_variable",
        "concat('fg_legacy.name_match_score|fg_legacy.', lower(n_name)) AS input_features",
        "md5(n_name) AS model_code_hash",
    )


def run_model_inference(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").selectExpr(
        "concat('run_', s_suppkey % 4) AS run_id",
        "concat('pre_', s_nationkey) AS pre_train_model_id",
        "concat('post_', s_suppkey) AS post_train_model_id",
        "s_suppkey % 3 = 0 AS is_primary",
    )
