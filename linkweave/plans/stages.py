"""The stages of a run, in order. Stages talk through stored tables only.

Each stage builds one lazy plan per table it writes. What passes through the driver
is bounded: import marks, model ids, column names and the fitted model.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import naming
from linkweave.operators import (
    blocking,
    export,
    features,
    importing,
    latest,
    lattice,
    matching,
    model,
    review,
    spelling,
    training,
)
from linkweave.operators.lookup import lookup_join
from linkweave.session import stored
from linkweave.sources import tables


@dataclass(frozen=True)
class Run:
    """What identifies a run, where its tables lie, and its choices."""

    base: str
    run_id: str
    process_id: str
    source_type: str = "gpo"
    target_type: str = "pm"
    model: str = "random_forest"
    label: str = "is_match"
    blocking_key: str | None = None
    sample_method: str | None = None
    auto_approve: bool = False
    auto_approve_score: float = S.AUTO_APPROVE_SCORE
    drop_incomplete: bool = True
    user: str = S.REVIEW_USER
    now: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.UTC).replace(tzinfo=None))
    features: tuple[str, ...] = (
        "fg_legacy.name_match_score",
        "fg_legacy.first_name_match",
        "fg_legacy.last_name_match",
        "fg_legacy.npi_match",
    )

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and how many of them the next action takes, which needs no job of its own."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), seen


COUNTS = "stage STRING, name STRING, n BIGINT, counted_at TIMESTAMP"


def _record_counts(spark: SparkSession, run: Run, stage: str, counts: dict[str, int]) -> None:
    """Numbers of rows that a stage stored, in the run's record; a stage run again states them anew."""
    rows = spark.createDataFrame([(stage, name, n, run.now) for name, n in counts.items()], COUNTS)
    tables.replace_part(rows, run.path("run_counts"), run.run_id, stage)


def import_records(spark: SparkSession, run: Run, new: DataFrame, record_type: str) -> bool:
    """Store new records of a type and their blocks. False when there are none.

    Records go to a change log, one folder per import, so an import that is run
    again replaces its own rows and nothing else is rewritten.
    """
    return bool(_store_records(spark, run, new, record_type))


def _store_records(spark: SparkSession, run: Run, new: DataFrame, record_type: str) -> dict[str, int]:
    """Numbers of records and blocks stored; nothing where there are no new records."""
    if new.isEmpty():
        return {}
    shaped = importing.with_metadata(new, record_type=record_type, imported_at=run.now)
    shaped = importing.cast_columns(importing.fill_modified_at(shaped))
    text_columns = [
        f.name for f in shaped.schema.fields
        if f.dataType.simpleString() == "string" and f.name not in ("record_type", "import_process_id")
    ]
    shaped = importing.drop_sentinels(shaped, text_columns)
    batch = f"{run.process_id}-{record_type}"
    # Blocks come from the stored rows, so the source is read once.
    shaped, n_records = _counted(shaped)
    kept = tables.append_changes(shaped, run.path("record"), batch, schema=S.RECORD)
    blocks = blocking.block_rows(latest.latest_records(kept))
    blocks = importing.with_metadata(blocks, run_id=run.run_id, created_at=run.now)
    blocks, n_blocks = _counted(blocks)
    tables.append_changes(blocks, run.path("block_record"), batch, ("run_id",))
    counts = {"records": n_records.get["n"], "blocks": n_blocks.get["n"]}
    _record_counts(spark, run, f"import-{batch}", counts)
    return counts


MARKS = "record_type STRING, passed_id BIGINT, passed_at TIMESTAMP"


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """Ends of ranges that were looked through, one row per record type at most."""
    try:
        return tables.read_current(spark, path)
    except FileNotFoundError:
        return spark.createDataFrame([], MARKS)


def _move_mark(marks: DataFrame, path: str, record_type: str, passed_at: dt.datetime) -> None:
    others = marks.where(F.col("record_type") != record_type)
    row = marks.sparkSession.createDataFrame([(record_type, None, passed_at)], MARKS)
    tables.replace(others.unionByName(row), path)


def _before(key: object) -> object:
    """The bound just below a key: the range above it begins with the key."""
    return key - dt.timedelta(microseconds=1) if isinstance(key, dt.datetime) else int(key) - 1


def run_import(
    spark: SparkSession,
    run: Run,
    record_type: str,
    source: Callable[[object, object], DataFrame],
    initial: dt.datetime | None = None,
    next_key: Callable[[object], object] | None = None,
) -> dict[str, int]:
    """Import the next range of a type: mark, range, bounded read, records and blocks.

    ``source`` gives the rows between two bounds, such as ``tables.read_database_range``
    or a filter on a folder. Returns the numbers of records and blocks stored, 0 where the
    range is empty; also an empty range moves the mark, but never beyond the time of the run.

    ``next_key`` gives the smallest key above a bound, or None. Where a range is empty it
    is asked once, and the range that begins with that key is read instead: no gap stops the
    import. Ids that are not there yet move no mark.
    """
    key = S.IMPORT_KEYS[record_type]
    column = "passed_id" if key == "record_id" else "passed_at"
    marks = _marks(spark, run.path("import_mark"))
    passed = marks.where(F.col("record_type") == record_type).agg(F.max(column)).first()[0]
    held = spark.createDataFrame([], S.RECORD)
    if tables.exists(spark, run.path("record")):
        held = tables.read_log(spark, run.path("record"), S.RECORD)
    start, end = importing.import_range(held, record_type, initial, passed)

    def taken_in(start, end) -> dict[str, int]:
        rows = source(start, end)
        return _store_records(spark, run, rows.where(importing.between(rows, key, start, end)), record_type)

    counts = taken_in(start, end)
    if not counts and next_key is not None and (beyond := next_key(end)) is not None:
        counts = taken_in(_before(beyond), _before(beyond) + (end - start))
    if not counts and key != "record_id":
        # Rows with larger ids may come later, but no rows of a time that is over.
        _move_mark(marks, run.path("import_mark"), record_type, min(end, run.now))
    return counts or {"records": 0, "blocks": 0}


def run_feedback_import(
    spark: SparkSession,
    run: Run,
    input_type: str,
    source: Callable[[object, object], DataFrame],
    next_time: Callable[[object], object] | None = None,
) -> int:
    """Import the next 30 days of feedback on a record type; returns the number of rows stored.

    The mark is the last time of the stored feedback on pairs of this type with master
    records; with none stored the range starts in 2021. ``source`` gives the rows between two
    bounds. An empty range moves the mark, but never beyond the time of the run; ``next_time``
    leads over gaps, as in ``run_import``. Feedback on master records is not taken in.
    """
    if input_type in S.MASTER_RECORD_TYPES:
        return 0
    key = "tess_modified_at"
    marks = _marks(spark, run.path("feedback_mark"))
    passed = marks.where(F.col("record_type") == input_type).agg(F.max("passed_at")).first()[0]
    held = spark.createDataFrame([], S.FEEDBACK)
    if tables.exists(spark, run.path("feedback")):
        held = tables.read_log(spark, run.path("feedback"), S.FEEDBACK)
    start, end = importing.feedback_range(held, input_type, run.target_type, passed)

    def taken_in(start, end) -> int:
        rows = source(start, end)
        return _store_feedback(spark, run, rows.where(importing.between(rows, key, start, end)), input_type)

    n = taken_in(start, end)
    if not n and next_time is not None and (beyond := next_time(end)) is not None:
        n = taken_in(_before(beyond), _before(beyond) + (end - start))
    if not n:
        _move_mark(marks, run.path("feedback_mark"), input_type, min(end, run.now))
    return n


def import_feedback(spark: SparkSession, run: Run, new: DataFrame, source_type: str) -> bool:
    """Store new feedback. Feedback on master records is not taken in."""
    return _store_feedback(spark, run, new, source_type) > 0


def _store_feedback(spark: SparkSession, run: Run, new: DataFrame, source_type: str) -> int:
    if source_type in S.MASTER_RECORD_TYPES or new.isEmpty():
        return 0
    shaped = importing.with_metadata(
        importing.label_to_boolean(new, run.label), input_type=source_type, imported_at=run.now
    )
    shaped, seen = _counted(shaped)
    batch = f"{run.process_id}-{source_type}"
    tables.append_changes(shaped, run.path("feedback"), batch, schema=S.FEEDBACK)
    _record_counts(spark, run, f"feedback-{batch}", {"feedback": seen.get["n"]})
    return seen.get["n"]


def records(spark: SparkSession, run: Run) -> DataFrame:
    return tables.read_latest(
        spark, run.path("record"), S.RECORD_KEY, "tess_modified_at", S.RECORD
    )


def compact_records(spark: SparkSession, run: Run) -> int:
    """Write the current records as a snapshot, so that readers rank later imports only."""
    return tables.compact(spark, run.path("record"), S.RECORD_KEY, "tess_modified_at", S.RECORD)


def pair_records(spark: SparkSession, run: Run) -> None:
    """Store the first pairs that a classifier is to score, with their blocks.

    For each source the best targets by name, the first ones of each set of attributes that
    agree, and all whose names are near in spelling. From these a model is trained;
    ``pair_by_model`` then adds the pairs that it puts first among all pairs of the blocks.
    """
    sources, targets = _run_sides(spark, run)
    linked = stored(
        matching.linkable(sources).unionByName(matching.linkable(targets))
    )
    best = matching.best_targets(linked, run.source_type, run.target_type)
    attributes = list(features.MATCH_ATTRIBUTES)
    values = stored(
        matching.agreeing(sources, attributes).unionByName(matching.agreeing(targets, attributes))
    )
    alike = matching.proposed_pairs(values, len(attributes), run.source_type, run.target_type)
    named = stored(
        lattice.comparable(sources, attributes).unionByName(lattice.comparable(targets, attributes))
    )
    near = spelling.near_pairs(named, run.source_type, run.target_type)
    proposed = best.select(*S.PAIR_KEY).unionByName(alike.select(*S.PAIR_KEY)).unionByName(near)
    _write_pairs(run, proposed.distinct(), linked, "pairs")


def pair_by_model(spark: SparkSession, run: Run, pre_id: str) -> None:
    """Add the pairs that the run's model ranks first, over all pairs of each source's blocks.

    With their features built and scored, no pair that the export could name is missing.
    """
    post_id = _model_of(spark, run, pre_id)
    fitted = model.load(run.path("models"), pre_id, post_id)
    sources, targets = _run_sides(spark, run)
    # Frequencies count all records of the type, as the features do.
    whole, _ = _sides(spark, run)
    for column, alias in (("first_name", "f_name_freq"), ("last_name", "l_name_freq")):
        whole = features.name_frequency(whole, column, alias)
    sources = whole.join(sources.select("record_id"), "record_id", "left_semi")
    best = lattice.forest_targets(sources, targets, fitted, run.source_type, run.target_type)
    linked = matching.linkable(sources).unionByName(matching.linkable(targets))
    _write_pairs(run, best.select(*S.PAIR_KEY), linked, f"model-{post_id}")


def _run_sides(spark: SparkSession, run: Run) -> tuple[DataFrame, DataFrame]:
    """Source records of the run, and all targets."""
    blocks = tables.read(spark, run.path("block_record"))
    of_run = export.all_sources(blocks, run.run_id, run.source_type).withColumnRenamed(
        "source_id", "record_id"
    )
    sources, targets = _sides(spark, run)
    return sources.join(of_run, "record_id", "left_semi"), targets


def _write_pairs(run: Run, pairs: DataFrame, linked: DataFrame, part: str) -> None:
    keys = linked.select(*S.RECORD_KEY, F.explode("blocks").alias("block"))
    rows, seen = _counted(blocking.pairs_in_blocks(pairs, keys))
    tables.replace_part(rows, run.path("run_pairs"), run.run_id, part)
    _record_counts(pairs.sparkSession, run, f"pairs-{part}", {"run_pairs": seen.get["n"]})


def _sides(spark: SparkSession, run: Run) -> tuple[DataFrame, DataFrame]:
    known = records(spark, run)
    return (
        known.where(F.col("record_type") == run.source_type),
        known.where(F.col("record_type") == run.target_type),
    )


def build_features(spark: SparkSession, run: Run, group: features.FeatureGroup) -> bool:
    """Features of the run's pairs. False when the run has no pairs."""
    pairs = tables.read(spark, run.path("run_pairs")).where(
        (F.col("run_id") == run.run_id) & blocking.in_blocks(run.blocking_key)
    )
    part = f"pairs-{run.blocking_key or 'all'}"
    if pairs.isEmpty():
        tables.empty_part(spark, run.path(group.table), run.run_id, part)
        return False
    pairs = pairs.select(*S.PAIR_KEY).distinct()
    _write_features(run, group, pairs, *_sides(spark, run), part)
    return True


def backfill_features(spark: SparkSession, run: Run, group: features.FeatureGroup) -> None:
    """Features of labelled pairs that the group has no row for: all, where it has no table."""
    feedback = tables.read_log(spark, run.path("feedback"), S.FEEDBACK)
    part = "backfill"
    held = None
    if tables.exists(spark, run.path(group.table)):
        # What this run's backfill wrote before is written anew.
        held = tables.read(spark, run.path(group.table)).where(
            (F.col("run_id") != run.run_id) | (F.col("part") != part)
        )
    pairs = stored(features.backfill_pairs(feedback, held, run.label))
    sources, targets = _sides(spark, run)
    _write_features(
        run, group, pairs,
        features.backfill_records(sources, pairs, "source"),
        features.backfill_records(targets, pairs, "target"), part,
    )


def _write_features(run, group, pairs, sources, targets, part) -> None:
    rows = group.run(
        pairs, sources, targets,
        run_id=run.run_id, process_id=run.process_id, created_at=run.now,
    )
    tables.replace_part(rows, run.path(group.table), run.run_id, part)


def _groups(spark: SparkSession, run: Run) -> dict[str, DataFrame]:
    names = naming.features_by_group(list(run.features))
    return {name: tables.read(spark, run.path(name)) for name in names}


def train(spark: SparkSession, run: Run) -> tuple[str, str]:
    """Fit the model on all labelled pairs and record it; returns both model ids."""
    names = list(run.features)
    rows = training.training_set(
        tables.read_log(spark, run.path("feedback"), S.FEEDBACK), _groups(spark, run), names, run.label
    )
    if run.drop_incomplete:
        rows = training.drop_incomplete(rows)
    rows = stored(rows)
    if run.sample_method:
        rows = stored(training.resampled(rows, run.sample_method, run.label))
    unfitted = model.MODELS[run.model](model.feature_columns(names))
    pre_id = model.pre_train_model_id(unfitted, names, run.label)
    fitted = model.fit(rows, names, run.label, run.model)
    post_id = model.post_train_model_id(fitted)
    model.save(fitted, run.path("models"), pre_id, post_id)

    accuracy = model.accuracy(fitted, rows, run.label)
    details = importing.with_metadata(
        accuracy,
        pre_train_model_id=pre_id,
        post_train_model_id=post_id,
        model_code_hash=model.model_code_hash(unfitted),
        dependent_variable=run.label,
        input_features="|".join(names),
        process_id=run.process_id,
        run_id=run.run_id,
        created_at=run.now,
    )
    details = stored(details)
    tables.append_json_lines(details, run.path("models_metadata"))
    _register(
        spark, run, "pre_train_model",
        details.select("pre_train_model_id", "dependent_variable", "input_features", "model_code_hash"),
        training.append_pre_train,
    )
    _register(
        spark, run, "post_train_model",
        details.select("post_train_model_id", "pre_train_model_id", "process_id", "created_at", "run_id"),
        training.append_post_train,
    )
    return pre_id, post_id


def _register(spark, run, name, rows, combine) -> None:
    path = run.path(name)
    try:
        rows = combine(tables.read_current(spark, path), rows)
    except FileNotFoundError:
        pass
    tables.replace(rows, path)


def _model_of(spark: SparkSession, run: Run, pre_id: str) -> str:
    """The fitted model that the run uses."""
    held = tables.read_current(spark, run.path("run_model_inference"))
    chosen = training.only_row(
        training.run_models(held, run.run_id, pre_id), f"model {pre_id} for run {run.run_id}"
    )
    return chosen["post_train_model_id"]


def score(spark: SparkSession, run: Run, pre_id: str) -> bool:
    """Score the run's pairs with the model the run uses. False when there are none."""
    post_id = _model_of(spark, run, pre_id)
    rows = training.scoring_set(
        tables.read(spark, run.path("run_pairs")),
        _groups(spark, run),
        list(run.features),
        run.run_id,
        run.blocking_key,
    )
    # One model's scores of one block, or of all; scored again, they replace themselves.
    path, part = run.path("record_pair_match_score"), f"{run.blocking_key or 'all'}-{post_id}"
    if rows.isEmpty():
        tables.empty_part(spark, path, run.run_id, part)
        return False
    fitted = model.load(run.path("models"), pre_id, post_id)
    scores = model.pair_scores(
        fitted, rows,
        run_id=run.run_id, pre_train_model_id=pre_id, post_train_model_id=post_id,
        created_at=run.now,
    )
    tables.replace_part(scores, path, run.run_id, part)
    return True


def use_model(spark: SparkSession, run: Run, pre_id: str, post_id: str, primary: bool = True) -> None:
    """Name the model a run is to use."""
    row = spark.createDataFrame(
        [(run.run_id, pre_id, post_id, primary)],
        "run_id STRING, pre_train_model_id STRING, post_train_model_id STRING, is_primary BOOLEAN",
    )
    _register(spark, run, "run_model_inference", row, training.append_post_train)


def assemble(spark: SparkSession, run: Run) -> DataFrame:
    primary = training.only_row(
        training.primary_models(
            tables.read_current(spark, run.path("run_model_inference")),
            tables.read_current(spark, run.path("pre_train_model")),
        ).where(F.col("run_id") == run.run_id),
        f"primary model for run {run.run_id}",
    )
    # The no-match table wants columns beyond the model's own inputs.
    names = list(dict.fromkeys(primary["input_features"] + [
        f"fg_legacy.{c}" for c in features.FgLegacy.columns
    ]))
    groups = {
        name: tables.read(spark, run.path(name)) for name in naming.features_by_group(names)
    }
    known = tables.read_log(spark, run.path("record"), S.RECORD)
    return export.export_assembly(
        tables.read(spark, run.path("block_record")),
        tables.read(spark, run.path("record_pair_match_score")),
        known,
        groups,
        names,
        run.run_id,
        primary["post_train_model_id"],
        run.source_type,
        run.target_type,
    )


def export_run(spark: SparkSession, run: Run, review_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Everything an export appends, one DataFrame per review table.

    ``review_tables`` holds the current LookupSource, em.BatchCollectionSource,
    em.Batch, em.MatchingResult, em.Configuration, em.BatchColumnConfiguration,
    em.MatchingResultDetail and gpov1.ApproveRejectData; those two before the last may be
    absent where nothing was exported yet. Besides the tables to append, the result has
    the match rows that no batch takes, whole (``rejected``), and for the log sources
    without a collection source (``missing_sources``) and collection sources that are not
    active (``unknown_sources``).
    """
    rows = stored(assemble(spark, run))
    kept = export.drop_missing_source(rows)
    matched = export.with_full_names(export.matches(kept))
    schema_json = review.schema_text(matched.schema)
    names = review.column_map(matched.schema)

    current = review_tables
    config = review.batch_config(
        current["LookupSource"],
        current["em.BatchCollectionSource"],
        current["em.Batch"],
        current["em.MatchingResult"],
        current["em.Configuration"],
    )
    # The ids of new batches must be the same in every table written.
    assigned = stored(
        review.assign_ids(
            review.batch_decision(matched, config, schema_json),
            current["em.Batch"],
            current["em.MatchingResult"],
            current["em.Configuration"],
        )
    )
    output = review.batch_headers(
        assigned, schema_json, run.now, run.source_type, run.target_type, run.user
    )
    output["em.BatchColumnConfiguration"] = review.column_config_rows(
        assigned, review.column_config(spark, matched.schema, run.now, run.user)
    )
    columns = current.get("em.BatchColumnConfiguration")
    output["em.MatchingResultDetail"] = review.detail_rows(
        matched, assigned, names, run.now, run.user, columns
    )
    output["rejected"] = review.rejected(matched, config)
    output["gpov1.DSNonMatches"] = export.no_match_output(export.no_matches(kept))
    if run.auto_approve:
        batches = assigned.select(
            F.col("CollectionSourceId").alias("collection_source_id_src"), "BatchId"
        )
        proposals = lookup_join(matched, batches, ["collection_source_id_src"]).select(
            "source_id", "target_id", F.col(export.SCORE).alias("score"), "BatchId"
        )
        details = current.get("em.MatchingResultDetail")
        if details is not None and columns is not None:
            # A batch's sources are ranked over all its rows, those of earlier exports too.
            held = review.earlier_proposals(
                details, current["em.MatchingResult"], columns, export.SCORE
            )
            touched = batches.select("BatchId").distinct()
            proposals = proposals.unionByName(held.join(touched, "BatchId", "left_semi"))
        output["gpov1.ApproveRejectData"] = review.auto_approvals(
            proposals, current["gpov1.ApproveRejectData"], run.auto_approve_score, run.user
        )
    output["missing_sources"] = export.missing_source_ids(rows)
    output["unknown_sources"] = review.unknown_sources(matched, config)
    return output


LOGGED = ("missing_sources", "unknown_sources")


def write_export(run: Run, output: dict[str, DataFrame]) -> None:
    """Write every output into its table's folder of the run; written again, it replaces itself.

    What is for the log is no table. ``log_counts`` reports it.
    """
    for name, rows in output.items():
        if name not in LOGGED:
            rows.write.mode("overwrite").parquet(run.path(f"export/{name}/run_id={run.run_id}"))


def send_export(spark: SparkSession, run: Run, sink: Callable[[DataFrame, str], None]) -> list[str]:
    """Append what the run's export wrote to the review database; returns the tables sent.

    ``sink`` appends rows to a table of a name, such as
    ``lambda rows, name: tables.append_database(rows, url, name)``. What was sent is recorded
    table by table, so a run that stopped half way goes on with the tables still to send. A sink
    that fails within a table must leave none of its rows.
    """
    folder = run.path("export")
    sent = []
    for name in tables.folders(spark, folder):
        written = f"{folder}/{name}/run_id={run.run_id}"
        done = run.path(f"export_sent/{name}/run_id={run.run_id}")
        if name == "rejected" or not tables.exists(spark, f"{written}/_SUCCESS") or tables.exists(spark, f"{done}/_SUCCESS"):
            continue
        sink(spark.read.parquet(written), name)
        spark.createDataFrame([(name, run.now)], "name STRING, sent_at TIMESTAMP").write.mode("overwrite").parquet(done)
        sent.append(name)
    return sent


def log_counts(output: dict[str, DataFrame]) -> dict[str, int]:
    """Numbers of sources that an export leaves out, by reason."""
    return {name: output[name].count() for name in LOGGED}
