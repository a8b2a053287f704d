"""A whole run over stored tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.operators import features, review
from linkweave.plans import stages
from linkweave.sources import tables

NOW = dt.datetime(2024, 3, 1)
COLUMNS = "record_id STRING, first_name STRING, middle_name STRING, last_name STRING, npi STRING, country STRING, organization_name STRING, collection_source_id STRING, publication_count STRING, tess_modified_at TIMESTAMP"


def people(n, seed):
    rng = random.Random(seed)
    first = ["Anna", "Élodie", "Bob", "Carl", "null"]
    last = [f"L{chr(97 + i)}na" for i in range(15)]
    rows = []
    for i in range(n):
        source = "0" if i == 3 else "null" if i == 4 else "17" if i % 9 == 5 else str(1 + i % 3)
        rows.append((str(i), rng.choice(first), None, rng.choice(last), f"n{i % 40}", "fr", "org", source, "null", NOW))
    return rows


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    run = stages.Run(str(tmp_path_factory.mktemp("run")), "r1", "p1", now=NOW, sample_method="RandomUnderSampler", auto_approve=True, auto_approve_score=0.5)
    sources = spark.createDataFrame(people(60, 1), COLUMNS)
    targets = spark.createDataFrame(people(90, 2), COLUMNS).drop("tess_modified_at").withColumn("tess_modified_at", F.lit(None).cast("timestamp"))
    assert stages.import_records(spark, run, targets, "pm")
    for _ in range(2):  # the import of sources is run again
        assert stages.import_records(spark, run, sources, "gpo")
    assert not stages.import_records(spark, run, sources.where("false"), "gpo")
    stages.pair_records(spark, run)
    pairs = tables.read(spark, run.path("run_pairs")).select(*S.PAIR_KEY).distinct()
    labels = pairs.withColumn("is_match", F.expr("if(source_id % 40 = target_id % 40, 'true', 'false')"))
    extra = spark.createDataFrame([("gpo", i, "pm", i, "true") for i in range(60)], "source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, is_match STRING")
    fb = labels.unionByName(extra).withColumn("tess_modified_at", F.lit(NOW))
    assert not stages.import_feedback(spark, run, fb, "pm")
    assert stages.import_feedback(spark, run, fb, "gpo")
    group = features.FgLegacy()
    assert stages.build_features(spark, run, group)
    stages.backfill_features(spark, run, group)
    pre_id, post_id = stages.train(spark, run)
    stages.use_model(spark, run, pre_id, post_id)
    stages.pair_by_model(spark, run, pre_id)
    assert stages.build_features(spark, run, group)
    assert stages.score(spark, run, pre_id)
    return run, pre_id, post_id


def review_tables(spark):
    return {
        "LookupSource": spark.createDataFrame([(1, "one", 1), (2, "two", 1), (3, "three", 1), (17, "x", 1)], "LookupID INT, LookupValue STRING, IsActive INT"),
        "em.BatchCollectionSource": spark.createDataFrame([(10, 1, 1)], "BatchId BIGINT, CollectionSourceId INT, IsActive INT"),
        "em.Batch": spark.createDataFrame([(10, 5, 1)], "BatchId BIGINT, ConfigurationId BIGINT, Status INT"),
        "em.MatchingResult": spark.createDataFrame([(20, 10, S.RULE_NAME)], "MatchingResultId BIGINT, BatchId BIGINT, RuleName STRING"),
        "em.Configuration": spark.createDataFrame([(5, "c", "{}")], "ConfigurationId BIGINT, ConfigurationName STRING, ColumnSchema STRING"),
        "gpov1.ApproveRejectData": spark.createDataFrame([], "SourceID BIGINT, TargetID BIGINT"),
    }


def test_stored_tables(spark, finished):
    run, pre_id, post_id = finished
    assert tables.read(spark, run.path("record")).count() == 150
    blocks = tables.read(spark, run.path("block_record"))
    assert blocks.count() == blocks.select("run_id", *S.RECORD_KEY, "block").distinct().count()
    known = stages.records(spark, run)
    assert known.where("first_name = 'null' OR npi = 'null'").count() == 0
    assert known.where("record_type = 'pm' AND tess_modified_at IS NULL").count() == 0
    assert dict(known.dtypes)["record_id"] == "bigint"
    assert tables.read_current(spark, run.path("pre_train_model")).count() == 1
    assert tables.read_current(spark, run.path("post_train_model")).first().post_train_model_id == post_id
    assert spark.read.json(run.path("models_metadata")).first().pre_train_model_id == pre_id
    scores = tables.read(spark, run.path("record_pair_match_score"))
    assert scores.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert scores.count() == scores.select(*S.PAIR_KEY).distinct().count() > 0


def test_pairs_share_their_block(spark, finished):
    run = finished[0]
    pairs = tables.read(spark, run.path("run_pairs"))
    blocks = tables.read(spark, run.path("block_record")).select(*S.RECORD_KEY, "block").distinct()
    for side in ("source", "target"):
        keys = blocks.withColumnsRenamed({"record_type": f"{side}_type", "record_id": f"{side}_id"})
        assert pairs.join(keys, [f"{side}_type", f"{side}_id", "block"], "left_anti").count() == 0


def test_export(spark, finished):
    run = finished[0]
    output = stages.export_run(spark, run, review_tables(spark))
    stages.write_export(run, output)
    sources = {r.source_id for r in tables.read(spark, run.path("block_record")).where("record_type = 'gpo'").selectExpr("record_id AS source_id").distinct().collect()}
    rows = stages.assemble(spark, run)
    assert {r.source_id for r in rows.collect()} == sources
    assert rows.groupBy("source_id").count().where("count > 5").count() == 0

    def written(name):
        return spark.read.parquet(run.path(f"export/{name}"))

    detail = written("em.MatchingResultDetail")
    assert detail.count() > 0
    assert detail.columns[:2] == ["fieldvalue1", "fieldvalue2"] or "sourceid" in detail.columns
    results = {r.MatchingResultId for r in written("em.MatchingResult").collect()}
    assert {r.MatchingResultId for r in detail.select("MatchingResultId").distinct().collect()} == results
    assert min(results) == 21
    batches = written("em.Batch")
    configs = written("em.Configuration")
    assert batches.join(configs, "ConfigurationId").count() == batches.count() == len(results)
    schema = review.export_schema(detail.schema)
    assert schema["schema"]["source"]
    no_match = written("gpov1.DSNonMatches")
    assert "TargetSpeciality" in no_match.columns
    assert {r.source_id for r in output["missing_sources"].collect()} <= {3}
    assert stages.log_counts(output)["missing_sources"] <= 1
    # Written again, nothing is doubled.
    counts = {name: written(name).count() for name in output if name not in stages.LOGGED}
    stages.write_export(run, stages.export_run(spark, run, review_tables(spark)))
    assert counts == {name: written(name).count() for name in counts}
    approved = written("gpov1.ApproveRejectData")
    assert approved.count() == approved.select("BatchID", "SourceID").distinct().count()
    columns = written("em.BatchColumnConfiguration")
    assert columns.groupBy("BatchId").count().select("count").distinct().count() == 1


def test_second_export_appends_to_its_batches(spark, finished):
    """With what the first export wrote as the current tables, nothing new is opened."""
    run = finished[0]
    first = stages.export_run(spark, run, review_tables(spark))
    current = review_tables(spark)
    for name in ("em.Configuration", "em.Batch", "em.BatchCollectionSource", "em.MatchingResult"):
        columns = current[name].columns
        current[name] = current[name].unionByName(first[name].select(*columns))
    second = stages.export_run(spark, run, current)
    assert second["em.Batch"].count() == 0
    ids = first["em.MatchingResult"].select("MatchingResultId")
    assert second["em.MatchingResultDetail"].join(ids, "MatchingResultId", "left_anti").count() == 0


def test_run_without_model_is_an_error(spark, finished):
    run, pre_id, _ = finished
    with pytest.raises(LookupError):
        stages.score(spark, run, "unknown")


def test_import_stage_moves_on_over_empty_ranges(spark, tmp_path):
    run = stages.Run(str(tmp_path), "r1", "p1", now=NOW)
    early = NOW - dt.timedelta(days=60)
    times = [early + dt.timedelta(days=d) for d in (1, 40, 41)]
    rows = spark.createDataFrame(
        [("gpo", i, "Anna", "Lee", t) for i, t in enumerate(times)],
        "record_type STRING, record_id BIGINT, first_name STRING, last_name STRING, tess_modified_at TIMESTAMP",
    )
    asked = []

    def source(start, end):
        asked.append((start, end))
        return rows

    with pytest.raises(ValueError):
        stages.run_import(spark, run, "gpo", source)
    counts = []
    for i in range(5):
        step = stages.Run(run.base, "r1", f"p{i}", now=NOW)
        counts.append(stages.run_import(spark, step, "gpo", source, early)["records"])
    assert counts[:3] == [1, 0, 0] and sum(counts) == 3
    assert all(a[0] < b[0] for a, b in zip(asked, asked[1:]))
    assert {r.record_id for r in stages.records(spark, run).collect()} == {0, 1, 2}
    for i in range(5, 8):
        stages.run_import(spark, stages.Run(run.base, "r1", f"p{i}", now=NOW), "gpo", source, early)
    assert max(start for start, _ in asked) <= NOW


def test_a_gap_in_the_ids_is_crossed(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame(
        [(i, "a", NOW) for i in (2, 3, 10_000_500, 10_000_900)], "record_id BIGINT, first_name STRING, tess_modified_at TIMESTAMP"
    )

    def next_key(bound):
        return rows.where(F.col("record_id") > bound).agg(F.min("record_id")).first()[0]

    counts = []
    for i in range(4):
        run = stages.Run(base, "r1", f"p{i}", now=NOW)
        counts.append(stages.run_import(spark, run, "pm", lambda start, end: rows, next_key=next_key)["records"])
    assert counts == [2, 2, 0, 0]
    assert {r.record_id for r in stages.records(spark, run).collect()} == {2, 3, 10_000_500, 10_000_900}


def test_backfill_without_a_group_table(spark, tmp_path):
    run = stages.Run(str(tmp_path), "r1", "p1", now=NOW)
    for kind, seed in (("gpo", 1), ("pm", 2)):
        stages.import_records(spark, run, spark.createDataFrame(people(10, seed), COLUMNS), kind)
    label = spark.createDataFrame([("gpo", 1, "pm", 2, "true")], "source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, is_match STRING").withColumn("tess_modified_at", F.lit(NOW))
    stages.import_feedback(spark, run, label, "gpo")
    group = features.FgLegacy()
    for _ in range(2):
        stages.backfill_features(spark, run, group)
    assert tables.read(spark, run.path(group.table)).count() == 1


def test_feedback_import_moves_by_its_own_mark(spark, tmp_path):
    base = str(tmp_path)
    times = [dt.datetime(2021, 1, 5), dt.datetime(2021, 1, 20), dt.datetime(2021, 4, 10), dt.datetime(2023, 6, 1)]
    rows = spark.createDataFrame(
        [("gpo", i, "pm", 7, "true", t) for i, t in enumerate(times)],
        "source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, is_match STRING, tess_modified_at TIMESTAMP",
    )

    def later(bound):
        return rows.where(F.col("tess_modified_at") > F.lit(bound)).agg(F.min("tess_modified_at")).first()[0]

    asked = []

    def source(start, end):
        asked.append((start, end))
        return rows

    def step(i, next_time=None):
        run = stages.Run(base, "r1", f"p{i}", now=NOW)
        return stages.run_feedback_import(spark, run, "gpo", source, next_time)

    assert step(0) == 2
    assert asked[0] == (dt.datetime(2021, 1, 1), dt.datetime(2021, 1, 31))
    # An empty range moves the mark by 30 days; a later one holds a row.
    assert [step(1), step(2)] == [0, 0]
    assert asked[1][0] == times[1] and asked[2][0] == asked[1][1]
    assert step(3) == 1
    # A gap of years is led over.
    assert [step(i, later) for i in (4, 5)] == [1, 0]
    assert stages.run_feedback_import(spark, stages.Run(base, "r1", "p9", now=NOW), "pm", source) == 0
    log = tables.read_log(spark, f"{base}/feedback", S.FEEDBACK)
    assert log.where("is_match AND input_type = 'gpo'").count() == 4


def test_counts_of_a_run_are_those_of_its_tables(spark, finished):
    run = finished[0]
    counts = {(r.stage, r.name): r.n for r in tables.read(spark, run.path("run_counts")).collect()}
    records, blocks = tables.read(spark, run.path("record")), tables.read(spark, run.path("block_record"))
    for kind in ("gpo", "pm"):
        assert counts[f"import-p1-{kind}", "records"] == records.where(F.col("record_type") == kind).count()
        assert counts[f"import-p1-{kind}", "blocks"] == blocks.where(F.col("record_type") == kind).count()
    assert counts["feedback-p1-gpo", "feedback"] == tables.read_log(spark, run.path("feedback")).count()
    pairs = {k: n for k, n in counts.items() if k[1] == "run_pairs"}
    assert len(pairs) == 2
    assert sum(pairs.values()) == tables.read(spark, run.path("run_pairs")).count()


def test_an_export_is_sent_once(spark, finished):
    run = finished[0]
    stages.write_export(run, stages.export_run(spark, run, review_tables(spark)))
    sent, broken = {}, {"em.MatchingResult"}

    def sink(rows, name):
        if name in broken:
            raise OSError("no database")
        sent[name] = sent.get(name, 0) + rows.count()

    with pytest.raises(OSError):
        stages.send_export(spark, run, sink)
    before = set(sent)
    broken.clear()
    rest = stages.send_export(spark, run, sink)
    assert before and not before & set(rest) and before | set(rest) == set(sent)
    assert "rejected" not in sent and "em.MatchingResultDetail" in sent
    assert sent == {n: spark.read.parquet(run.path(f"export/{n}")).count() for n in sent}
    assert stages.send_export(spark, run, sink) == []
