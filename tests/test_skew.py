"""Hot keys: nothing may gather a third of the rows in one task."""

from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.operators import blocking, features, latest, matching, vectors

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16384",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def final_plan(spark, build):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        query = build()._jdf.queryExecution()
        query.toRdd().count()
        return query.executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_record_in_pairs_is_split(spark):
    pairs = spark.range(60000).repartition(8).selectExpr(
        "'gpo' AS source_type", "if(id % 3 = 0, 7L, id) AS source_id",
        "'pm' AS target_type", "id AS target_id",
    )
    records = spark.range(60000).selectExpr("'gpo' AS record_type", "id AS record_id", "md5(string(id)) AS npi")
    targets = records.withColumn("record_type", F.lit("pm"))
    plan = final_plan(spark, lambda: features.pair_attributes(pairs, records, targets))
    assert "skew=true" in plan


def test_hot_name_in_frequency_is_split(spark):
    records = spark.range(60000).repartition(8).selectExpr(
        "'gpo' AS record_type", "id AS record_id", "if(id % 3 = 0, 'hot', md5(string(id))) AS first_name"
    )
    plan = final_plan(spark, lambda: features.name_frequency(records, "first_name", "n"))
    assert "skew=true" in plan


def names(spark, n):
    """A third of the records are copies of one name; all lie in one block."""
    return spark.range(n).selectExpr(
        "if(id % 2 = 0, 'gpo', 'pm') AS record_type", "id AS record_id",
        "'a' AS first_name", "if(id % 3 = 0, 'b', concat('m', id DIV 4)) AS middle_name",
        "'c' AS last_name",
    ).select(
        *S.RECORD_KEY, "first_name",
        # digits are no part of a name: spell them as letters
        F.translate("middle_name", "0123456789", "ghijklnopq").alias("middle_name"), "last_name",
    )


def test_ranked_join_forms_few_rows_in_one_hot_block(spark):
    """15,000 sources and as many targets in one block: 225 million pairs, never formed."""
    linked = matching.linkable(names(spark, 30000)).cache()
    best = matching.best_targets(linked).cache()
    assert best.select("source_id").distinct().count() == 15000
    assert best.groupBy("source_id").count().where("count > 5").count() == 0
    hot = {r.target_id for r in best.where("source_id = 6").collect()}
    assert hot == {3, 9, 15, 21, 27}
    best.unpersist()
    linked.unpersist()


def test_candidate_counts_of_one_hot_block(spark):
    blocks = blocking.block_rows(names(spark, 30000))
    counts = blocking.candidate_counts(blocks).select("n_candidates").distinct().collect()
    assert [r.n_candidates for r in counts] == [15000]


def test_hot_target_after_latest_records_is_split(spark):
    """Records come out of a window on the very key of the join."""
    pairs = spark.range(60000).repartition(8).selectExpr(
        "'gpo' AS source_type", "id AS source_id",
        "'pm' AS target_type", "if(id % 3 = 0, 7L, id) AS target_id",
    )
    versions = spark.range(60000).selectExpr(
        "'pm' AS record_type", "id AS record_id", "md5(string(id)) AS npi",
        "timestamp '2024-01-01 00:00:00' AS tess_modified_at",
    )
    sources = versions.withColumn("record_type", F.lit("gpo")).drop("tess_modified_at")
    plan = final_plan(
        spark, lambda: features.pair_attributes(pairs, sources, latest.latest_records(versions))
    )
    assert "skew=true" in plan


def test_hot_term_is_split(spark):
    texts = spark.range(30000).repartition(8).selectExpr(
        "id", "concat('hot ', md5(string(id))) AS t"
    )
    plan = final_plan(spark, lambda: vectors.tfidf(texts, "id", "t"))
    assert "skew=true" in plan


def test_hot_name_of_sources_is_split(spark):
    linked = matching.linkable(names(spark, 60000)).cache()
    plan = final_plan(spark, lambda: matching.best_targets(linked))
    assert "skew=true" in plan
    linked.unpersist()
