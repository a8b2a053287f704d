"""Feature groups: similarity features of given source/target pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import naming, text
from linkweave.operators.lookup import lookup_join

MATCH_ATTRIBUTES = {
    "first_name": "first_name_match",
    "middle_name": "middle_name_match",
    "last_name": "last_name_match",
    "specialty": "specialty_match",
    "country": "country_match",
    "npi": "npi_match",
    "organization_name": "organization_name_match",
    "other_ids": "other_ids_match",
}


def suffixed(df: DataFrame, suffix: str) -> DataFrame:
    """Every column renamed with the suffix of its side."""
    return df.select([F.col(c).alias(f"{c}_{suffix}") for c in df.columns])


def pair_attributes(pairs: DataFrame, sources: DataFrame, targets: DataFrame) -> DataFrame:
    """Pairs with the attributes of both records.

    One row per record on either side, so the pairs do not multiply.
    """
    for rows, kind, number, suffix in (
        (sources, "source_type", "source_id", "src"),
        (targets, "target_type", "target_id", "tgt"),
    ):
        side = suffixed(rows, suffix).withColumnsRenamed(
            {f"record_type_{suffix}": kind, f"record_id_{suffix}": number}
        )
        pairs = lookup_join(pairs, side, [kind, number])
    return pairs


def match_flag(left: str, right: str) -> Column:
    """1.0 where both prepared values are present and equal."""
    return F.expr(f"CASE WHEN {left} = {right} THEN 1.0D ELSE 0.0D END")


def name_match_score(left: str, right: str) -> Column:
    """1 - edit distance / longer length, on ASCII names; 0.0 when both are empty."""
    longest = f"greatest(length({left}), length({right}))"
    score = f"1.0D - levenshtein({left}, {right}) / {longest}"
    return F.expr(f"coalesce(CASE WHEN {longest} > 0 THEN {score} END, 0.0D)")


def name_frequency(records: DataFrame, column: str, alias: str) -> DataFrame:
    """Number of records with the same value, joined back to each record.

    Counted before the shuffle and joined on the counted value; a window over the
    name would put all bearers of a common name into one task.
    """
    counts = records.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias(alias)
    )
    return lookup_join(records, counts, [column], "left").withColumn(
        alias, F.coalesce(F.col(alias), F.lit(0).cast("bigint"))
    )


class FeatureGroup:
    """Contract of a feature group: preprocess records, then compute pair features.

    A subclass gives ``compute`` and may override ``preprocess``. Records are
    prepared once each, before they meet their pairs.
    """

    @property
    def table(self) -> str:
        return naming.table_name(type(self).__name__)

    def preprocess(
        self, sources: DataFrame, targets: DataFrame
    ) -> tuple[DataFrame, DataFrame]:
        return sources, targets

    def compute(self, pairs: DataFrame) -> DataFrame:
        raise NotImplementedError(f"{type(self).__name__} gives no compute()")

    def run(
        self, pairs: DataFrame, sources: DataFrame, targets: DataFrame, **metadata
    ) -> DataFrame:
        """Feature rows of the pairs, with run id, process id and time as given."""
        sources, targets = self.preprocess(sources, targets)
        features = self.compute(pair_attributes(pairs.select(*S.PAIR_KEY), sources, targets))
        return features.withColumns({k: F.lit(v) for k, v in metadata.items()})


class FgLegacy(FeatureGroup):
    """Name similarity, agreement flags and name frequencies of person records."""

    columns = [
        "name_match_score",
        *MATCH_ATTRIBUTES.values(),
        "f_name_freq_src",
        "l_name_freq_src",
    ]

    def _prepared(self, records: DataFrame, *kept: str) -> DataFrame:
        """Attributes ready for comparison, prepared once per record."""
        values = {
            c: text.prep_text(c) if c in records.columns else F.lit(None).cast("string")
            for c in MATCH_ATTRIBUTES
        }
        return records.select(
            *S.RECORD_KEY,
            *kept,
            text.ascii_full_name().alias("ascii_name"),
            *[value.alias(c) for c, value in values.items()],
        )

    def preprocess(self, sources, targets):
        sources = name_frequency(sources, "first_name", "f_name_freq")
        sources = name_frequency(sources, "last_name", "l_name_freq")
        return self._prepared(sources, "f_name_freq", "l_name_freq"), self._prepared(targets)

    def compute(self, pairs):
        flags = [
            match_flag(f"{attribute}_src", f"{attribute}_tgt").alias(flag)
            for attribute, flag in MATCH_ATTRIBUTES.items()
        ]
        return pairs.select(
            *S.PAIR_KEY,
            name_match_score("ascii_name_src", "ascii_name_tgt").alias("name_match_score"),
            *flags,
            "f_name_freq_src",
            "l_name_freq_src",
        )


def feature_projection(joined: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """``group.feature`` selected as ``group_feature``, for groups aliased by name."""
    named = [
        F.col(name).alias(naming.feature_column(*naming.split_feature(name)))
        for name in features
    ]
    return joined.select(*keep, *named)


def backfill_pairs(
    feedback: DataFrame, features: DataFrame | None, label: str = "is_match"
) -> DataFrame:
    """Labelled pairs that have no row in a feature group yet; None: the group has no table."""
    labelled = feedback.where(F.col(label).isNotNull()).select(*S.PAIR_KEY).distinct()
    if features is None:
        return labelled
    return labelled.join(features.select(*S.PAIR_KEY), S.PAIR_KEY, "left_anti")


def backfill_records(records: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """Records that the pairs to be backfilled name on one side."""
    keys = pairs.select(
        F.col(f"{side}_type").alias("record_type"), F.col(f"{side}_id").alias("record_id")
    ).distinct()
    return records.join(keys, S.RECORD_KEY, "left_semi")
