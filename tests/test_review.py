import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from linkweave.operators import export, review

NOW = dt.datetime(2024, 3, 1)
FIELDS = T.StructType(
    [
        T.StructField("full_name_tgt", T.StringType()),
        T.StructField("full_name_src", T.StringType()),
        T.StructField("ds_combined_score", T.DoubleType()),
        T.StructField("source_id", T.LongType()),
        T.StructField("collection_source_id_src", T.IntegerType()),
        T.StructField("target_id", T.LongType()),
        T.StructField("is_npi_deactivated_tgt", T.BooleanType()),
        T.StructField("fg_legacy_name_match_score", T.DoubleType()),
    ]
)


def test_export_schema():
    schema = review.export_schema(FIELDS)["schema"]
    assert list(schema["source"]) == ["sourceid", "Match", "TargetCount", "full_name_src", "collection_source_id_src"]
    assert schema["source"]["full_name_src"] == {"title": "Source Full Name", "type": "string"}
    assert schema["source"]["collection_source_id_src"]["type"] == "number"
    assert list(schema["target"]) == ["targetid", "full_name_tgt", "ds_combined_score", "is_npi_deactivated_tgt", "fg_legacy_name_match_score"]
    assert schema["target"]["is_npi_deactivated_tgt"]["type"] == "string"
    assert schema["action"]["Approve"] == {"title": "Approve", "type": "boolean"}
    assert json.loads(review.schema_text(FIELDS)) == review.export_schema(FIELDS)


def test_column_config(spark):
    rows = review.column_config(spark, FIELDS, NOW).collect()
    assert [(r.PrimaryColumnName, r.MappingColumnName, r.FieldOrder, r.Datatype) for r in rows] == [
        ("sourceid", "sourceid", 0, "bigint"),
        ("targetid", "targetid", 0, "bigint"),
        ("full_name_tgt", "fieldvalue1", 1, "nvarchar(max)"),
        ("full_name_src", "fieldvalue2", 2, "nvarchar(max)"),
        ("ds_combined_score", "fieldvalue3", 3, "float"),
        ("collection_source_id_src", "fieldvalue4", 4, "bigint"),
        ("is_npi_deactivated_tgt", "fieldvalue5", 5, None),
        ("fg_legacy_name_match_score", "fieldvalue6", 6, "float"),
    ]
    assert review.column_map(FIELDS)["ds_combined_score"] == "fieldvalue3"


def test_stored_column_map_equals_the_one_it_was_made_from(spark):
    config = review.column_config(spark, FIELDS, NOW).selectExpr("*", "7 AS BatchId")
    stored = review.stored_fields(config).first()
    made = {v: k for k, v in review.column_map(FIELDS).items() if v.startswith("fieldvalue")}
    assert stored.BatchId == 7 and stored.fields == made


def test_existing_batch_keeps_its_own_fields(spark):
    """A new export with its columns in another order writes into the batch's fields."""
    matches = spark.createDataFrame([(1, 2, 0.5, "x", 11), (3, 4, 0.25, "y", 12), (5, 6, 0.75, "z", 99)], "source_id BIGINT, target_id BIGINT, a DOUBLE, b STRING, collection_source_id_src INT")
    assigned = spark.createDataFrame([(11, 1, 7, 70), (12, 0, 8, 80), (13, 1, 9, 90)], "CollectionSourceId INT, append_mode INT, BatchId BIGINT, MatchingResultId BIGINT")
    config = spark.createDataFrame([(7, "b", "fieldvalue1"), (7, "a", "fieldvalue2"), (7, "sourceid", "sourceid")], "BatchId BIGINT, PrimaryColumnName STRING, MappingColumnName STRING")
    names = {"source_id": "sourceid", "target_id": "targetid", "a": "fieldvalue1", "b": "fieldvalue2"}
    rows = review.detail_rows(matches, assigned, names, NOW, config=config).collect()
    assert {(r.sourceid, r.fieldvalue1, r.fieldvalue2, r.MatchingResultId) for r in rows} == {(1, "x", "0.5", 70), (3, "0.25", "y", 80)}


@pytest.mark.parametrize("stored_columns", [False, True])
def test_values_are_cut_before_rows_meet_their_batches(spark, stored_columns):
    """What is exchanged with the rows is cut text; rows may repeat, have no source, values or known batch."""
    long = "x" * 1500
    matches = spark.createDataFrame(
        [(1, 2, 0.5, long, 11), (1, 2, 0.5, long, 11), (3, 4, None, None, 12), (5, 6, 0.75, "z", None), (7, 8, 1.0, "", 99)],
        "source_id BIGINT, target_id BIGINT, a DOUBLE, b STRING, collection_source_id_src INT",
    )
    assigned = spark.createDataFrame(
        [(11, 1, 7, 70), (12, 0, 8, 80), (None, 0, 9, 90)],
        "CollectionSourceId INT, append_mode INT, BatchId BIGINT, MatchingResultId BIGINT",
    )
    config = None
    if stored_columns:
        config = spark.createDataFrame(
            [(7, "b", "fieldvalue1")], "BatchId BIGINT, PrimaryColumnName STRING, MappingColumnName STRING"
        )
    names = {"source_id": "sourceid", "target_id": "targetid", "a": "fieldvalue1", "b": "fieldvalue2"}
    details = review.detail_rows(matches, assigned, names, NOW, config=config)
    assert details.columns == ["sourceid", "targetid", "fieldvalue1", "fieldvalue2", "CreatedBy", "CreatedDate", "MatchingResultId"]
    found = sorted((r.sourceid, r.fieldvalue1, r.fieldvalue2, r.MatchingResultId) for r in details.collect())
    # The stored batch has one column only, the text.
    hot = (1, long[:1000], None, 70) if stored_columns else (1, "0.5", long[:1000], 70)
    assert found == [hot, hot, (3, None, None, 80)]
    above, _, below = details._jdf.queryExecution().optimizedPlan().toString().partition("Join Inner")
    assert "substring" in below and "substring" not in above


def test_rows_of_unknown_sources_are_kept_whole(spark):
    matches = spark.createDataFrame([(1, 11), (2, 12), (3, None)], "source_id BIGINT, collection_source_id_src INT")
    config = spark.createDataFrame([(11, "one")], "CollectionSourceId INT, collectionSourceName STRING")
    assert sorted(r.source_id for r in review.rejected(matches, config).collect()) == [2, 3]
    assert review.rejected(matches, config).columns == matches.columns


def test_earlier_details_are_ranked_with_new_proposals(spark):
    details = spark.createDataFrame([(1, 2, "0.99", "q", 70), (1, 3, "r", "0.5", 80), (2, 3, "no number", "s", 70)], "sourceid BIGINT, targetid BIGINT, fieldvalue1 STRING, fieldvalue2 STRING, MatchingResultId BIGINT")
    results = spark.createDataFrame([(70, 7), (80, 8)], "MatchingResultId BIGINT, BatchId BIGINT")
    config = spark.createDataFrame([(7, "score", "fieldvalue1"), (8, "score", "fieldvalue2")], "BatchId BIGINT, PrimaryColumnName STRING, MappingColumnName STRING")
    held = review.earlier_proposals(details, results, config, "score")
    assert {tuple(r) for r in held.collect()} == {(1, 2, 0.99, 7), (1, 3, 0.5, 8), (2, 3, None, 7)}


def config_tables(spark):
    lookup = spark.createDataFrame([(1, "one", 1), (2, "two", 1), (3, "three", 0), (4, "four", 1), (5, "five", 1)], "LookupID INT, LookupValue STRING, IsActive INT")
    links = spark.createDataFrame([(10, 1, 1), (11, 1, 1), (12, 2, 1), (13, 4, 0), (14, 5, 1)], "BatchId BIGINT, CollectionSourceId INT, IsActive INT")
    batches = spark.createDataFrame([(10, 1, 1), (11, 2, 1), (12, 3, 1), (13, 1, 1), (14, 1, 2)], "BatchId BIGINT, ConfigurationId BIGINT, Status INT")
    results = spark.createDataFrame([(100 + b, b, "people_generic_rule") for b in range(10, 15)], "MatchingResultId BIGINT, BatchId BIGINT, RuleName STRING")
    configs = spark.createDataFrame([(1, "c1", "{}"), (2, "c2", '{"b":1,"a":2}'), (3, "c3", None)], "ConfigurationId BIGINT, ConfigurationName STRING, ColumnSchema STRING")
    return lookup, links, batches, results, configs


def test_batch_decisions_and_ids(spark):
    tables = config_tables(spark)
    config = review.batch_config(*tables)
    matched = spark.createDataFrame([(1,), (1,), (2,), (3,), (5,), (None,)], "collection_source_id_src INT")
    decided = review.batch_decision(matched, config, '{"a": 2, "b": 1}')
    modes = {r.CollectionSourceId: (r.append_mode, r.BatchId) for r in decided.collect()}
    # 1: latest batch 11, same schema; 2: no stored schema; 5: batch closed
    assert modes == {1: (1, 11), 2: (0, None), 5: (0, None)}
    unknown = {r.CollectionSourceId for r in review.unknown_sources(matched, config).collect()}
    assert unknown == {3, None}
    assigned = review.assign_ids(decided, tables[2], tables[3], tables[4])
    ids = {r.CollectionSourceId: (r.ConfigurationId, r.BatchId, r.MatchingResultId) for r in assigned.collect()}
    assert ids == {1: (2, 11, 111), 2: (4, 15, 115), 5: (5, 16, 116)}
    headers = review.batch_headers(assigned, "{}", NOW)
    names = {r.ConfigurationName for r in headers["em.Configuration"].collect()}
    assert names == {"CollectionSourceId 2 - 2024-03-01", "CollectionSourceId 5 - 2024-03-01"}
    assert all(r.IsPremastertoMaster for r in headers["em.Batch"].collect())
    config_rows = review.column_config_rows(assigned, review.column_config(spark, FIELDS, NOW))
    assert config_rows.groupBy("BatchId").count().collect() and config_rows.count() == 16


def test_first_ids_of_empty_tables(spark):
    lookup, links, batches, results, configs = config_tables(spark)
    config = review.batch_config(lookup, links, batches, results, configs)
    matched = spark.createDataFrame([(2,)], "collection_source_id_src INT")
    none = [t.where("false") for t in (batches, results, configs)]
    row = review.assign_ids(review.batch_decision(matched, config, "{}"), *none).first()
    assert (row.ConfigurationId, row.BatchId, row.MatchingResultId) == (1, 1, 1)


def test_auto_approval(spark):
    schema = "source_id BIGINT, target_id BIGINT, score DOUBLE, BatchId BIGINT"
    proposals = spark.createDataFrame([(1, 1, 0.95, 1), (1, 2, 0.97, 1), (2, 1, 0.9, 1), (3, 1, 0.899, 1), (4, 1, 0.99, 1)], schema)
    decided = spark.createDataFrame([(4, 1)], "SourceID BIGINT, TargetID BIGINT")
    rows = review.auto_approvals(proposals, decided).collect()
    assert {(r.SourceID, r.TargetID) for r in rows} == {(1, 2), (2, 1)}
    assert {(r.CurrentStageID, r.PreviousStageID, r.UndoStageID, r.BatchID) for r in rows} == {(2, 1, 1, 1)}


def assembled(spark):
    schema = "ds_combined_score DOUBLE, source_id BIGINT, collection_source_id_src INT, target_id BIGINT"
    nan = float("nan")
    rows = [(0.2, 1, 5, 1), (0.19, 2, 17, 1), (None, 3, None, None), (nan, 4, 5, 1), (0.9, 5, 0, 1), (0.1, 6, 5, 1)]
    return spark.createDataFrame(rows, schema)


def test_every_source_is_on_exactly_one_side(spark):
    rows = assembled(spark)
    kept = export.drop_missing_source(rows)
    match = {r.source_id for r in export.matches(kept).collect()}
    no_match = {r.source_id for r in export.no_matches(kept).collect()}
    missing = {r.source_id for r in export.missing_source_ids(rows).collect()}
    assert (match, no_match, missing) == ({1}, {2, 3, 4, 6}, {5})
    allowed = {r.source_id for r in export.allowed_no_matches(export.no_matches(kept)).collect()}
    assert allowed == {3, 4, 6}


def test_no_match_columns_follow_the_table():
    names = export.no_match_columns()
    assert len(names) == 20
    assert names["npi_tgt"] == "TargetNpi" and names["specialty_tgt"] == "TargetSpeciality"
    assert names["fg_legacy_country_match"] == "TargetCountryMatch"
    assert names["fg_legacy_organization_name_match"] == "TargetOrganizationNameMatch"


def test_target_counts(spark):
    counts = {r.source_id: r.target_count for r in export.target_counts(assembled(spark)).collect()}
    assert counts[3] == 0 and counts[1] == 1


@pytest.mark.parametrize("blocked", [(5,), ()])
def test_blocked_sources_are_a_parameter(spark, blocked):
    rows = export.allowed_no_matches(assembled(spark), blocked or (999,))
    assert rows.count() == (3 if blocked else 6)
