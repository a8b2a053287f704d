"""Registered queries: one per operator, each over the whole tables of a folder.

Every query is a function of a session and a folder of parquet tables. Doubles are
rounded to six places so that engines can be compared.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import text
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
    vectors,
)
from linkweave.plans import fixtures as fx
from linkweave.plans import stages
from linkweave.session import new_path, stored
from linkweave.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NEW_SCHEMA = '{"a":"x","b":[1,2]}'
CREATED = dt.datetime(2024, 3, 1)
IMPORTED = dt.datetime(2030, 1, 1)


def query(function):
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- incremental import ----------------------------------------------------


@query
def watermark_max(spark, sf):
    return importing.import_marks(fx.stored_log(spark, sf))


def _marks(spark, sf) -> dict:
    """Marks per record type; as many rows as there are record types."""
    rows = importing.import_marks(fx.stored_log(spark, sf)).toLocalIterator()
    return {r.record_type: r for r in rows}


@query
def import_range_ts(spark, sf):
    log = fx.import_log(spark, sf)
    span = dt.timedelta(days=S.IMPORT_DAY_SPAN)
    ranges = {
        kind: (mark.last_modified_at, mark.last_modified_at + span)
        for kind, mark in _marks(spark, sf).items()
    }
    return log.where(importing.any_type_between(log, "tess_modified_at", ranges)).select(
        "record_type", "record_id", "tess_modified_at"
    )


@query
def import_range_id(spark, sf):
    log = fx.import_log(spark, sf)
    ranges = {
        kind: (mark.last_record_id, mark.last_record_id + S.IMPORT_ID_SPAN)
        for kind, mark in _marks(spark, sf).items()
    }
    return log.where(importing.any_type_between(log, "record_id", ranges)).select(
        "record_type", "record_id"
    )


@query
def feedback_range(spark, sf):
    """Next feedback range of every record type; types never imported start in 2021."""
    types = fx.import_log(spark, sf).select("record_type").distinct()
    stored = fx.import_log(spark, sf).where("value > 0 AND record_type <> 'view'")
    marks = stored.groupBy("record_type").agg(
        F.max("tess_modified_at").cast("timestamp").alias("mark")
    )
    mark = F.col("mark")
    return types.join(marks, "record_type", "left").select(
        "record_type",
        text.range_text(importing.feedback_range_start(mark)).alias("range_start"),
        text.range_text(importing.feedback_range_end(mark)).alias("range_end"),
    )


@query
def ts_format_ms(spark, sf):
    return fx.import_log(spark, sf).select(
        "record_id", text.range_text("tess_modified_at").alias("modified_text")
    )


@query
def pm_modified_fill(spark, sf):
    records = fx.record_version(spark, sf).withColumn("imported_at", F.lit(CREATED))
    return importing.fill_modified_at(records).select(
        *S.RECORD_KEY, "publication_count", "tess_modified_at"
    )


@query
def upsert_latest_wins(spark, sf):
    versions = fx.record_version(spark, sf)
    changes = versions.where("last_name IS NULL OR last_name <> 'null'")
    stored = versions.where("last_name = 'null'")
    return latest.upsert(stored, changes, S.RECORD_KEY, "tess_modified_at").select(
        *S.RECORD_KEY, "last_name", "tess_modified_at"
    )


@query
def upsert_ties(spark, sf):
    """Changes of the stored time win; older changes do not."""
    held = fx.record(spark, sf).select(*S.RECORD_KEY, "last_name", "tess_modified_at")
    changed = held.withColumn("last_name", F.lit("changed"))
    changes = changed.where("record_id % 3 = 0").unionByName(
        changed.where("record_id % 3 = 1").withColumn(
            "tess_modified_at", F.expr("tess_modified_at - INTERVAL 1 HOUR")
        )
    )
    return latest.upsert(held, changes, S.RECORD_KEY, "tess_modified_at")


@query
def mixed_import_columns(spark, sf):
    """Two imports with different columns in one change log; none is lost."""
    path = new_path(spark)
    shaped = importing.cast_columns(fx.record(spark, sf))
    for kind, absent in (("gpo", "npi"), ("pm", "country")):
        rows = shaped.where(F.col("record_type") == kind).drop(absent)
        tables.append_changes(rows, path, f"{kind}-import", schema=S.RECORD)
    return tables.read_log(spark, path, S.RECORD).select(
        *S.RECORD_KEY, "first_name", "npi", "country", "import_process_id"
    )


@query
def ties_within_import(spark, sf):
    """Rows of one key and time in one import: the row that came later stands, for every reader."""
    path = new_path(spark)
    first = importing.cast_columns(fx.record(spark, sf))
    second = first.where("record_id % 3 = 0").withColumn("last_name", F.lit("second"))
    tables.append_changes(first.unionByName(second), path, "one import", schema=S.RECORD)
    log = tables.read_latest(spark, path, S.RECORD_KEY, "tess_modified_at", S.RECORD)
    return log.select(*S.RECORD_KEY, "last_name")


@query
def compacted_records(spark, sf):
    """Current records from a snapshot of the first import and the one after it."""
    path = new_path(spark)
    versions = importing.cast_columns(fx.record_version(spark, sf))
    changed = versions.where("record_id % 4 <> 1").withColumns(
        {"last_name": F.lit("changed"), "tess_modified_at": F.expr("tess_modified_at + INTERVAL 1 DAY")}
    )
    args = (spark, path, S.RECORD_KEY, "tess_modified_at", S.RECORD)
    tables.append_changes(versions.where("record_id % 5 <> 2"), path, "first", schema=S.RECORD)
    tables.compact(*args)
    tables.append_changes(changed, path, "second", schema=S.RECORD)
    return tables.read_latest(*args).select(*S.RECORD_KEY, "last_name", "tess_modified_at")


@query
def rerun_empty(spark, sf):
    """Parts of a run after a stage was run again: one with fewer rows, one with none."""
    path = new_path(spark)
    rows = fx.record(spark, sf).select(*S.RECORD_KEY, "last_name")
    for part, again in (("a", "record_id % 2 = 0"), ("b", "false"), ("c", "true")):
        tables.replace_part(rows, path, fx.RUN, part)
        tables.replace_part(rows.where(again), path, fx.RUN, part)
    tables.empty_part(spark, path, fx.RUN, "c")
    return tables.read(spark, path)


# --- projections and filters -------------------------------------------------


@query
def add_metadata(spark, sf):
    rows = fx.record_version(spark, sf).select(*S.RECORD_KEY, "tess_modified_at")
    return importing.with_metadata(
        rows, run_id=fx.RUN, process_id="process_1", imported_at=CREATED
    )


@query
def cast_map(spark, sf):
    """Numbers and ids held as text, some of them the text 'null'."""
    rows = fx.record_version(spark, sf).select(
        "record_type",
        F.col("record_id").cast("string").alias("record_id"),
        text.fill_sentinel("collection_source_id").alias("collection_source_id"),
        F.col("last_name").alias("clinical_trial_count"),
        text.fill_sentinel("publication_count").alias("publication_count"),
        "tess_modified_at",
    )
    return importing.cast_columns(rows)


@query
def label_to_bool(spark, sf):
    rows = fx.feedback(spark, sf).withColumn(
        "is_match",
        F.when(F.col("source_id") % 7 == 0, "null").otherwise(F.col("is_match").cast("string")),
    )
    return importing.label_to_boolean(rows).select("source_id", "target_id", "is_match", "tess_modified_at")


@query
def null_sentinel(spark, sf):
    columns = ["middle_name", "last_name"]
    rows = fx.record_version(spark, sf).select(*S.RECORD_KEY, "tess_modified_at", *columns)
    filled = importing.fill_sentinels(rows.withColumnsRenamed({c: f"{c}_filled" for c in columns}), [f"{c}_filled" for c in columns])
    both = filled.withColumns({c: F.col(f"{c}_filled") for c in columns})
    return importing.drop_sentinels(both, columns)


@query
def suffix_columns(spark, sf):
    return features.suffixed(
        fx.record(spark, sf).select(*S.RECORD_KEY, "first_name", "country"), "src"
    )


@query
def pair_key_roundtrip(spark, sf):
    pairs = fx.feedback(spark, sf).select(*S.PAIR_KEY).distinct()
    keyed = pairs.select(
        text.composite_key("source_type", "source_id").alias("pk_src"),
        text.composite_key("target_type", "target_id").alias("pk_tgt"),
    )
    return keyed.select(
        "pk_src",
        "pk_tgt",
        text.key_type("pk_src").alias("source_type"),
        text.key_id("pk_src").alias("source_id"),
        text.key_type("pk_tgt").alias("target_type"),
        text.key_id("pk_tgt").alias("target_id"),
    )


@query
def drop_incomplete(spark, sf):
    rows = fx.current_scores(spark, sf).select(
        "source_id",
        "target_id",
        "score",
        F.when(F.col("target_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("weight"),
    )
    return training.drop_incomplete(rows)


@query
def block_filter(spark, sf):
    return fx.block_record(spark, sf).where(blocking.in_blocks()).select(*S.RECORD_KEY, "block")


def _assembled(spark, sf) -> DataFrame:
    return fx.assembly(spark, sf).select(
        export.SCORE, "source_id", "target_id", "collection_source_id_src"
    )


@query
def drop_missing_source(spark, sf):
    return export.drop_missing_source(_assembled(spark, sf))


@query
def missing_source_ids(spark, sf):
    return export.missing_source_ids(_assembled(spark, sf))


@query
def match_split(spark, sf):
    return export.matches(_assembled(spark, sf))


@query
def no_match_split(spark, sf):
    return export.no_matches(_assembled(spark, sf))


@query
def no_match_blocklist(spark, sf):
    return export.allowed_no_matches(export.no_matches(_assembled(spark, sf)))


@query
def feature_projection(spark, sf):
    joined = fx.feature_table(spark, sf).alias("fg_legacy")
    rows = features.feature_projection(
        joined, [f"fg_legacy.{c}" for c in features.FgLegacy.columns], [*S.PAIR_KEY, "created_at"]
    )
    return _rounded(rows, "fg_legacy_name_match_score")


@query
def no_match_export(spark, sf):
    """All columns of the no-match table."""
    rows = fx.assembly(spark, sf)
    # The test records have no such attributes.
    rows = rows.withColumns(
        {c: F.lit(None).cast("string") for c in ("specialty_tgt", "other_ids_tgt")}
    )
    result = export.no_match_output(export.no_matches(export.drop_missing_source(rows)))
    return _rounded(result, "DSNameMatchScore")


@query
def full_names(spark, sf):
    rows = export.with_full_names(export.matches(fx.assembly(spark, sf)))
    return rows.select("full_name_tgt", "full_name_src", "source_id", "target_id", export.SCORE)


@query
def premaster_flag(spark, sf):
    records = fx.record(spark, sf)
    return records.select(
        *S.RECORD_KEY,
        review.premaster_flag(F.col("record_type"), F.lit("pm")).alias("to_master"),
        review.premaster_flag(F.lit("gpo"), F.col("record_type")).alias("from_gpo"),
    )


# --- duplicates, rankings ---------------------------------------------------


@query
def dedup_records(spark, sf):
    return latest.dedup_records(
        fx.record_version(spark, sf).select(*S.RECORD_KEY, "last_name", "tess_modified_at")
    )


@query
def dedup_pairs(spark, sf):
    rows = fx.match_scores(spark, sf).select(*S.PAIR_KEY, "run_id", "score", "created_at")
    return latest.dedup_pairs(rows)


@query
def all_sources(spark, sf):
    return export.all_sources(fx.block_record(spark, sf), fx.RUN, "gpo")


@query
def latest_records(spark, sf):
    return fx.record(spark, sf)


@query
def latest_feedback(spark, sf):
    return latest.latest_feedback(fx.feedback(spark, sf))


@query
def latest_features(spark, sf):
    rows = latest.latest_features(fx.feature_table(spark, sf), fx.RUN)
    return _rounded(rows.select(*S.PAIR_KEY, "created_at", "name_match_score"), "name_match_score")


@query
def top_k_with_fallback(spark, sf):
    rows = fx.current_scores(spark, sf).select("run_id", *S.PAIR_KEY, "score")
    return latest.top_k_with_fallback(rows, ["run_id", "source_id"])


@query
def auto_approve_best(spark, sf):
    return latest.best_above(fx.current_scores(spark, sf).select("source_id", "target_id", "score"))


@query
def latest_batch(spark, sf):
    return latest.latest_batch(fx.batch_collection_source(spark, sf))


# --- blocks, pairs, joins ---------------------------------------------------


@query
def block_key(spark, sf):
    return fx.record_version(spark, sf).select(
        *S.RECORD_KEY,
        "tess_modified_at",
        *[text.block_key(c).alias(f"{c}_block") for c in S.NAME_PARTS],
    )


#: Letters, and those of other scripts that sound so.
SCRIPTS = {
    "greek": ("abgdezklmnxoprst", "αβγδεζκλμνξοπρστ"),
    "cyrillic": ("abvgdezklmnoprstuf", "абвгдезклмнопрстуф"),
    "hebrew": ("abgdhvzklmnpqrst", "אבגדהוזכלמנפקרשת"),
    "arabic": ("abtjhkdrzsfqlmnwy", "ابتجحخدرزسفقلمنوي"),
    "katakana": ("akstnhmyrw", "アカサタナハマヤラワ"),
    "hangul": ("kntrmpschaou", "가나다라마바사자하아오우"),
}


@query
def block_key_scripts(spark, sf):
    """Keys of first names whose first letter stands in another script: those of the names in Latin."""
    latin = fx.record(spark, sf).select(*S.RECORD_KEY, text.block_key("first_name").alias("latin"))
    written = F.array(*[
        F.struct(F.lit(name).alias("script"), F.translate("latin", plain, letters).alias("name"))
        for name, (plain, letters) in SCRIPTS.items()
    ])
    return latin.select(*S.RECORD_KEY, F.explode(written).alias("w")).select(
        *S.RECORD_KEY, "w.script", F.col("w.name").alias("name")
    ).select(*S.RECORD_KEY, "script", text.block_key("name").alias("block"))


@query
def blocks(spark, sf):
    return fx.block_record(spark, sf)


@query
def block_stats(spark, sf):
    return blocking.block_stats(fx.record(spark, sf))


@query
def candidate_pairs(spark, sf):
    """The candidate space, counted per source without forming a pair."""
    return blocking.candidate_counts(fx.block_record(spark, sf))


@query
def best_targets(spark, sf):
    """Best five targets of each source by name, or the best one: the ranked pairs."""
    return _rounded(fx.proposals(spark, sf), "score")


@query
def classified_targets(spark, sf):
    """Best five targets by a fixed logistic model, over all pairs of a source's blocks."""
    linked = stored(matching.agreeing(fx.record(spark, sf), list(model.FIXED_WEIGHTS)))
    return _rounded(
        matching.classified_targets(linked, model.FIXED_WEIGHTS, model.FIXED_INTERCEPT), "score"
    )


@query
def near_names(spark, sf):
    """Pairs of names near in spelling, of sources and targets that share a block.

    A third of the targets lack a letter of their names, as a typing error has it.
    """
    known = spelling.named(fx.record(spark, sf))
    typed = "if(record_type = 'pm' AND record_id % 3 = 1, concat(left(name, 2), substr(name, 4)), name)"
    known = stored(known.withColumn("name", F.expr(typed)))
    found = spelling.near_names(known.where("record_type = 'gpo'"), known.where("record_type = 'pm'"))
    return found.select("source_name", "target_name", "edits").distinct()


def forest(spark, sf):
    """The forest of a run, fitted on the labelled pairs."""
    return model.fit(stored(_sample(spark, sf)), fx.MODEL_FEATURES)


@query
def forest_targets(spark, sf):
    """Best five targets by the forest, over all pairs of a source's blocks."""
    known = fx.record(spark, sf)
    found = lattice.forest_targets(
        known.where("record_type = 'gpo'"), known.where("record_type = 'pm'"), forest(spark, sf)
    )
    return _rounded(found, "score")


@query
def pairs_in_blocks(spark, sf):
    return fx.run_pairs(spark, sf)


@query
def pair_attributes(spark, sf):
    records = fx.record(spark, sf).select(*S.RECORD_KEY, "first_name", "npi", "country")
    return features.pair_attributes(
        fx.feedback(spark, sf).select(*S.PAIR_KEY).distinct(),
        records.where("record_type = 'gpo'"),
        records.where("record_type = 'pm'"),
    )


def _training_set(spark, sf) -> DataFrame:
    groups = {"fg_legacy": fx.feature_table(spark, sf)}
    return training.training_set(fx.feedback(spark, sf), groups, fx.MODEL_FEATURES)


@query
def training_set(spark, sf):
    return _rounded(_training_set(spark, sf), "fg_legacy_name_match_score")


def _scoring_set(spark, sf) -> DataFrame:
    return training.scoring_set(
        fx.run_pairs(spark, sf),
        {"fg_legacy": fx.feature_table(spark, sf)},
        fx.MODEL_FEATURES,
        fx.RUN,
    )


@query
def scoring_set(spark, sf):
    return _rounded(_scoring_set(spark, sf), "fg_legacy_name_match_score")


@query
def export_assembly(spark, sf):
    return _rounded(fx.assembly(spark, sf), "fg_legacy_name_match_score")


@query
def export_after_rescoring(spark, sf):
    """Scores written twice, and older ones beside them, change nothing."""
    scores = fx.match_scores(spark, sf)
    older = scores.withColumn("score", F.lit(1.0)).withColumn(
        "created_at", F.expr("created_at - INTERVAL 1 DAY")
    )
    rows = fx.assembly(spark, sf, scores.unionByName(scores).unionByName(older))
    return rows.select(export.SCORE, "source_id", "target_id", "collection_source_id_src")


@query
def undecided_pairs(spark, sf):
    proposals = fx.current_scores(spark, sf).select("source_id", "target_id", "score")
    return review.undecided(proposals, fx.decided(spark, sf))


@query
def batch_config(spark, sf):
    return review.batch_config(*fx.batch_tables(spark, sf))


@query
def primary_model(spark, sf):
    rows = training.primary_models(fx.run_model_inference(spark, sf), fx.pre_train_model(spark, sf))
    return rows.withColumn("input_features", text.join_list("input_features"))


@query
def run_model(spark, sf):
    return training.run_models(fx.run_model_inference(spark, sf), "run_1", "pre_20")


@query
def backfill_pairs(spark, sf):
    return features.backfill_pairs(fx.feedback(spark, sf), fx.match_scores(spark, sf))


@query
def backfill_src(spark, sf):
    pairs = features.backfill_pairs(fx.feedback(spark, sf), fx.match_scores(spark, sf))
    return features.backfill_records(fx.record(spark, sf), pairs, "source").select(
        *S.RECORD_KEY, "npi"
    )


@query
def backfill_tgt(spark, sf):
    pairs = features.backfill_pairs(fx.feedback(spark, sf), fx.match_scores(spark, sf))
    return features.backfill_records(fx.record(spark, sf), pairs, "target").select(
        *S.RECORD_KEY, "npi"
    )


# --- aggregates, registry ---------------------------------------------------


@query
def target_count(spark, sf):
    return export.target_counts(export.matches(_assembled(spark, sf)))


@query
def class_counts(spark, sf):
    return training.class_counts(_training_set(spark, sf))


@query
def name_frequency(spark, sf):
    records = fx.record(spark, sf).where("record_type = 'gpo'").select(*S.RECORD_KEY, *S.NAME_PARTS)
    first = features.name_frequency(records, "first_name", "f_name_freq")
    return features.name_frequency(first, "last_name", "l_name_freq").select(
        *S.RECORD_KEY, "f_name_freq", "l_name_freq"
    )


@query
def registry_append(spark, sf):
    models = fx.pre_train_model(spark, sf)
    held = fx.run_model_inference(spark, sf).where("is_primary").select("pre_train_model_id")
    stored = models.join(held, "pre_train_model_id", "left_semi").select(*models.columns)
    # Of models held already the registry keeps its own rows.
    changed = models.withColumn("model_code_hash", F.concat("model_code_hash", F.lit("-new")))
    return training.append_pre_train(stored, changed)


@query
def split_counts(spark, sf):
    return export.source_counts(export.matches(export.drop_missing_source(_assembled(spark, sf))))


# --- text and vectors -------------------------------------------------------


@query
def prep_text(spark, sf):
    """Whole document texts, with blanks put around them."""
    padded = F.concat(F.lit(" \t\u00a0"), F.col("text"), F.lit("\n  ")).alias("padded")
    prepared = text.prep_text("padded").alias("prepared")
    return (
        fx.documents(spark, sf)
        .select("doc_id", padded)
        .select("doc_id", prepared)
        .select(
            "doc_id",
            F.md5("prepared").alias("text_md5"),
            F.length("prepared").alias("n_chars_prepared"),
        )
    )


@query
def field_values(spark, sf):
    """Match details with every field as text, long texts cut to the field's size."""
    documents = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("target_id"), "text")
    rows = export.matches(_assembled(spark, sf)).join(documents, "target_id")
    assigned = _assigned(spark, sf)
    names = {
        "source_id": "sourceid",
        "target_id": "targetid",
        export.SCORE: "fieldvalue1",
        "collection_source_id_src": "fieldvalue2",
        "text": "fieldvalue3",
    }
    return review.detail_rows(rows, assigned, names, CREATED)


@query
def detail_rows_appended(spark, sf):
    """Details for new batches, and for existing ones in the order of their own columns."""
    columns = [export.SCORE, "collection_source_id_src"]
    names = {"source_id": "sourceid", "target_id": "targetid"}
    names |= {c: f"fieldvalue{i}" for i, c in enumerate(columns, 1)}
    batches = fx.batch(spark, sf).select("BatchId", F.explode(F.array(F.lit(1), F.lit(2))).alias("i"))
    # Every other batch was set up with the columns the other way round.
    at = F.when(F.col("BatchId") % 2 == 1, 3 - F.col("i")).otherwise(F.col("i"))
    config = batches.select(
        "BatchId",
        F.element_at(F.array(*map(F.lit, columns)), at).alias("PrimaryColumnName"),
        F.concat(F.lit("fieldvalue"), F.col("i").cast("string")).alias("MappingColumnName"),
    )
    rows = export.matches(_assembled(spark, sf))
    return review.detail_rows(rows, _assigned(spark, sf), names, CREATED, config=config)


@query
def rejected_matches(spark, sf):
    config = review.batch_config(*fx.batch_tables(spark, sf))
    return review.rejected(export.matches(_assembled(spark, sf)), config)


@query
def list_codec(spark, sf):
    models = fx.pre_train_model(spark, sf)
    return models.withColumn("parts", text.split_list("input_features")).select(
        "pre_train_model_id",
        F.size("parts").alias("n_features"),
        F.get("parts", 1).alias("second_feature"),
        text.join_list("parts").alias("joined"),
    )


@query
def term_counts(spark, sf):
    return vectors.term_counts(fx.documents(spark, sf), "doc_id", "text", min_df=2)


@query
def char_counts(spark, sf):
    return vectors.term_counts(
        fx.documents(spark, sf), "doc_id", "text", analyzer="char", min_df=0.01
    )


@query
def tfidf_terms(spark, sf):
    return _rounded(vectors.tfidf(fx.documents(spark, sf), "doc_id", "text"), "weight")


@query
def pair_cosine(spark, sf):
    pairs = fx.feedback(spark, sf).select(*S.PAIR_KEY).distinct()
    named = pairs.select(F.explode(F.array("source_id", "target_id")).alias("doc_id")).distinct()
    weights = vectors.tfidf(fx.documents(spark, sf), "doc_id", "text", only=named, numbered=True)
    return _rounded(vectors.pair_cosine(pairs, weights, "doc_id"), "cosine")


# --- features, sampling, model ----------------------------------------------


def _pair_features(spark, sf) -> DataFrame:
    records = fx.record(spark, sf)
    return features.FgLegacy().run(
        fx.feedback(spark, sf).select(*S.PAIR_KEY).distinct(),
        records.where("record_type = 'gpo'"),
        records.where("record_type = 'pm'"),
    )


@query
def match_flags(spark, sf):
    return _pair_features(spark, sf).select(*S.PAIR_KEY, *features.MATCH_ATTRIBUTES.values())


@query
def name_match_score(spark, sf):
    rows = _pair_features(spark, sf).select(*S.PAIR_KEY, "name_match_score")
    return _rounded(rows, "name_match_score")


def _sample(spark, sf) -> DataFrame:
    return training.undersample(stored(_training_set(spark, sf)))


@query
def undersample(spark, sf):
    return _sample(spark, sf).select(*S.PAIR_KEY, "is_match")


@query
def undersample_counts(spark, sf):
    return training.class_counts(_sample(spark, sf))


@query
def train_accuracy(spark, sf):
    rows = stored(_sample(spark, sf))
    return model.accuracy(model.fit(rows, fx.MODEL_FEATURES), rows)


@query
def pair_scores(spark, sf):
    rows = stored(_sample(spark, sf))
    fitted = model.fit(rows, fx.MODEL_FEATURES)
    return model.pair_scores(
        fitted,
        _scoring_set(spark, sf),
        run_id=fx.RUN,
        post_train_model_id=model.post_train_model_id(fitted),
    )


@query
def train_accuracy_bounds(spark, sf):
    """The forest learns: it is right more often than chance on the rows it was fitted on."""
    rows = stored(_sample(spark, sf))
    found = model.accuracy(model.fit(rows, fx.MODEL_FEATURES), rows)
    return found.select("n", F.col("accuracy").between(0.5, 1.0).alias("beats_chance"))


@query
def forest_score_keys(spark, sf):
    """Every pair of the scoring set has one probability and the model's id."""
    scores = pair_scores(spark, sf)
    return scores.select(
        *S.PAIR_KEY, "run_id",
        F.col("score").between(0.0, 1.0).alias("is_probability"),
        F.col("post_train_model_id").isNotNull().alias("has_model"),
    )


@query
def fixed_accuracy(spark, sf):
    """The model of fixed weights on the sampled training rows."""
    rows = stored(_sample(spark, sf))
    fitted = model.fit(rows, fx.MODEL_FEATURES, model="fixed_logistic")
    return _rounded(model.accuracy(fitted, rows), "accuracy")


@query
def fixed_scores(spark, sf):
    """Probability of every pair of the scoring set under the model of fixed weights."""
    fitted = model.fit(_training_set(spark, sf), fx.MODEL_FEATURES, model="fixed_logistic")
    return _rounded(model.pair_scores(fitted, _scoring_set(spark, sf), run_id=fx.RUN), "score")


# --- import stages ----------------------------------------------------------


def _next_value(rows, key):
    return lambda bound: rows.where(F.col(key) > F.lit(bound)).agg(F.min(key)).first()[0]


def _imported(spark, step) -> str:
    """Run a stage until it finds nothing; returns the folder of its tables."""
    base = new_path(spark)
    i = 0
    while step(stages.Run(base, fx.RUN, f"p{i}", now=IMPORTED)):
        i += 1
    return base


@query
def import_stage_rows(spark, sf):
    """Every version of every record, taken in range by range from each type's own mark."""
    columns = ["record_type", "record_id", "first_name", "last_name", "tess_modified_at"]
    rows = fx.record_version(spark, sf).select(*columns)
    found = None
    for kind, key in (("gpo", "tess_modified_at"), ("pm", "record_id")):
        of_kind = rows.where(F.col("record_type") == kind)
        base = _imported(spark, lambda run: stages.run_import(
            spark, run, kind, lambda start, end: of_kind, dt.datetime(2023, 12, 31), _next_value(of_kind, key)
        )["records"])
        log = tables.read_log(spark, f"{base}/record", S.RECORD).select(*columns)
        found = log if found is None else found.unionByName(log)
    return found


@query
def feedback_stage_rows(spark, sf):
    """All feedback, taken in month by month from its own mark."""
    columns = [*S.PAIR_KEY, "is_match", "tess_modified_at"]
    rows = fx.feedback(spark, sf).select(*columns)
    base = _imported(spark, lambda run: stages.run_feedback_import(
        spark, run, "gpo", lambda start, end: rows, _next_value(rows, "tess_modified_at")
    ))
    return tables.read_log(spark, f"{base}/feedback", S.FEEDBACK).select(*columns, "input_type")


@query
def stage_counts(spark, sf):
    """What an import states about itself: the numbers of rows it stored, by observation."""
    rows = fx.record(spark, sf).select(*S.RECORD_KEY, *S.NAME_PARTS, "tess_modified_at")
    run = stages.Run(new_path(spark), fx.RUN, "p1", now=IMPORTED)
    for kind in ("gpo", "pm"):
        stages.import_records(spark, run, rows.where(F.col("record_type") == kind), kind)
    feedback = fx.feedback(spark, sf).select(*S.PAIR_KEY, "is_match", "tess_modified_at")
    stages.import_feedback(spark, run, feedback, "gpo")
    return tables.read(spark, run.path("run_counts")).select("stage", "name", "n")


# --- review batches ---------------------------------------------------------


def _decisions(spark, sf) -> DataFrame:
    config = review.batch_config(*fx.batch_tables(spark, sf))
    sources = fx.lookup_source(spark, sf).select(
        F.col("LookupID").alias("collection_source_id_src")
    )
    return review.batch_decision(sources, config, NEW_SCHEMA)


def _assigned(spark, sf) -> DataFrame:
    _, _, batches, results, configurations = fx.batch_tables(spark, sf)
    return review.assign_ids(_decisions(spark, sf), batches, results, configurations)


@query
def batch_decision(spark, sf):
    return _decisions(spark, sf)


@query
def assign_ids(spark, sf):
    return _assigned(spark, sf)


@query
def batch_headers(spark, sf):
    """The four header tables side by side, one row per new batch."""
    tables = review.batch_headers(_assigned(spark, sf), NEW_SCHEMA, CREATED)
    kept = ["CreatedBy", "CreatedDate"]
    return (
        tables["em.Batch"]
        .join(tables["em.Configuration"], "ConfigurationId")
        .join(tables["em.BatchCollectionSource"].drop(*kept), "BatchId")
        .join(tables["em.MatchingResult"].drop(*kept), "BatchId")
    )


@query
def auto_approve(spark, sf):
    proposals = fx.current_scores(spark, sf).select(
        "source_id", "target_id", "score", (F.col("source_id") % 3).alias("BatchId")
    )
    return review.auto_approvals(proposals, fx.decided(spark, sf))
