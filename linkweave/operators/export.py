"""Export: assemble proposals, split matches from non-matches, shape the outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import naming, text
from linkweave.operators import latest
from linkweave.operators.lookup import lookup_join

SCORE = "ds_combined_score"


def all_sources(blocks: DataFrame, run_id: str, record_type: str) -> DataFrame:
    """Distinct source ids that a run has blocks for."""
    return (
        blocks.where((F.col("run_id") == run_id) & (F.col("record_type") == record_type))
        .select(F.col("record_id").alias("source_id"))
        .distinct()
    )


def _side(records: DataFrame, record_type: str, key: str, suffix: str, attributes: list[str]):
    rows = latest.latest_records(records.where(F.col("record_type") == record_type))
    columns = [F.col(a).alias(f"{a}_{suffix}") for a in attributes]
    if suffix == "src":
        columns.insert(0, F.col("collection_source_id").alias("collection_source_id_src"))
    return rows.select(F.col("record_id").alias(key), *columns)


def export_assembly(
    blocks: DataFrame,
    scores: DataFrame,
    records: DataFrame,
    groups: dict[str, DataFrame],
    features: list[str],
    run_id: str,
    post_train_model_id: str,
    source_type: str = "gpo",
    target_type: str = "pm",
    attributes: list[str] | None = None,
    k: int = S.TOP_K,
    min_score: float = S.MIN_MATCH_SCORE,
) -> DataFrame:
    """All sources of a run with their best proposals, both records and the features.

    Sources without a proposal stay, with an empty target side.
    """
    wanted = S.EXPORT_ATTRIBUTES if attributes is None else attributes
    attributes = [a for a in wanted if a in records.columns]
    of_run = latest.run_scores(scores, run_id, post_train_model_id, source_type, target_type)
    best = latest.top_k_with_fallback(
        latest.latest_scores(of_run.select("run_id", *S.PAIR_KEY, "score", "created_at"))
        .drop("created_at"),
        ["run_id", "source_id"],
        k,
        min_score,
    ).drop("run_id")
    rows = (
        all_sources(blocks, run_id, source_type)
        .join(best, "source_id", "left")
        .join(_side(records, source_type, "source_id", "src", attributes), "source_id")
    )
    # Sources with no proposal share the NULL target, and a block's sources may
    # share one fallback target.
    targets = _side(records, target_type, "target_id", "tgt", attributes)
    rows = lookup_join(rows, targets, ["target_id"], "left")
    names = []
    for group, of_group in naming.features_by_group(features).items():
        renamed = {f: naming.feature_column(group, f) for f in of_group}
        names += renamed.values()
        newest = latest.latest_features(groups[group], run_id).select(
            *S.PAIR_KEY, *[F.col(f).alias(a) for f, a in renamed.items()]
        )
        rows = lookup_join(rows, newest, S.PAIR_KEY, "left")
    return rows.select(
        F.col("score").alias(SCORE),
        "source_id",
        "collection_source_id_src",
        *[f"{a}_src" for a in attributes],
        "target_id",
        *[f"{a}_tgt" for a in attributes],
        *names,
    )


def _missing_source() -> Column:
    return F.col("collection_source_id_src").eqNullSafe(0)


def drop_missing_source(rows: DataFrame) -> DataFrame:
    """Rows whose collection source is not 0; an unknown source is kept."""
    return rows.where(~_missing_source())


def missing_source_ids(rows: DataFrame) -> DataFrame:
    return rows.where(_missing_source()).select("source_id").distinct()


def _is_match(min_score: float) -> Column:
    score = latest.real_score(SCORE)
    return F.coalesce(score >= min_score, F.lit(False))


def matches(rows: DataFrame, min_score: float = S.MIN_MATCH_SCORE) -> DataFrame:
    return rows.where(_is_match(min_score))


def no_matches(rows: DataFrame, min_score: float = S.MIN_MATCH_SCORE) -> DataFrame:
    """The rest, rows without a score among them."""
    return rows.where(~_is_match(min_score))


def with_full_names(rows: DataFrame) -> DataFrame:
    """Full names of both sides in front; the name parts go."""
    parts = {side: [f"{p}_{side}" for p in S.NAME_PARTS] for side in ("tgt", "src")}
    gone = set(parts["src"] + parts["tgt"])
    return rows.select(
        *[text.full_name(*names).alias(f"full_name_{side}") for side, names in parts.items()],
        *[c for c in rows.columns if c not in gone],
    )


def allowed_no_matches(
    rows: DataFrame, blocked: tuple[int, ...] = S.NO_MATCH_BLOCKED_SOURCES
) -> DataFrame:
    """Rows outside the blocked collection sources; an unknown source is kept."""
    is_blocked = F.coalesce(F.col("collection_source_id_src").isin(*blocked), F.lit(False))
    return rows.where(~is_blocked)


# Names of the existing no-match table; a star stands for the feature group.
NO_MATCH_COLUMNS = {
    "first_name_tgt": "TargetFirstName",
    "middle_name_tgt": "TargetMiddleName",
    "last_name_tgt": "TargetLastName",
    "npi_tgt": "TargetNpi",
    "specialty_tgt": "TargetSpeciality",
    "organization_name_tgt": "TargetOrganizationName",
    "other_ids_tgt": "TargetOtherIds",
    "*_country_match": "TargetCountryMatch",
    "*_npi_match": "TargetNpiMatch",
    "*_organization_name_match": "TargetOrganizationNameMatch",
    "*_specialty_match": "TargetSpecialityMatch",
    "source_id": "SourceID",
    "target_id": "TargetID",
    "*_name_match_score": "DSNameMatchScore",
    "*_f_name_freq_src": "FirstNameFrequency",
    "*_l_name_freq_src": "LastNameFrequency",
    "*_first_name_match": "FirstNameMatch",
    "*_middle_name_match": "MiddleNameMatch",
    "*_last_name_match": "LastNameMatch",
    "*_other_ids_match": "OtherIdsMatch",
}


def no_match_columns(group: str = "fg_legacy") -> dict[str, str]:
    return {c.replace("*", group): n for c, n in NO_MATCH_COLUMNS.items()}


def no_match_output(rows: DataFrame, group: str = "fg_legacy") -> DataFrame:
    """Allowed non-matches under the names of the no-match table."""
    names = no_match_columns(group)
    return allowed_no_matches(rows).select([F.col(c).alias(n) for c, n in names.items()])


def target_counts(rows: DataFrame) -> DataFrame:
    """Proposals per source."""
    return rows.groupBy("source_id").agg(F.count("target_id").alias("target_count"))


def source_counts(rows: DataFrame) -> DataFrame:
    """Proposals and sources per collection source."""
    return rows.groupBy("collection_source_id_src").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source_id").alias("n_sources")
    )
