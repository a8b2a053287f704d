"""Review batches: output schema, batch decisions, header and detail rows.

All collection sources go through one plan; nothing loops over them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave import schemas as S
from linkweave.functions import naming, text
from linkweave.operators import latest, numbering
from linkweave.operators.lookup import lookup_join

# Fixed values in this module: names and texts of the existing review tables.
_KEYS = ("source_type", "target_type", "source_id", "target_id")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REAL = (T.FloatType, T.DoubleType)


def _review_fields(schema: T.StructType) -> list[T.StructField]:
    return [field for field in schema.fields if field.name not in _KEYS]


def export_schema(schema: T.StructType) -> dict:
    """Description of the review screen for the columns of the match output."""

    def entry(title: str, kind: str) -> dict:
        return {"title": title, "type": kind}

    sides = {
        "source": {
            "sourceid": entry("Source Id", "number"),
            "Match": entry("Match", "string"),
            "TargetCount": entry("TargetCount", "number"),
        },
        "target": {"targetid": entry("Target Id", "number")},
    }
    for field in _review_fields(schema):
        kind = "number" if isinstance(field.dataType, _WHOLE + _REAL) else "string"
        sides[naming.column_side(field.name)][field.name] = entry(
            naming.column_title(field.name), kind
        )
    return {
        "schema": {
            **sides,
            "tags": {"tag": entry("tag", "string")},
            "action type": {"action": entry("ActionType", "string")},
            "action": {
                name: entry(name, "boolean") for name in ("Approve", "Reject")
            },
        }
    }


def schema_text(schema: T.StructType) -> str:
    return json.dumps(export_schema(schema), sort_keys=True, separators=(",", ":"))


def column_map(schema: T.StructType) -> dict[str, str]:
    """Review column of each match column: the two ids, then fieldvalue1 onward."""
    numbered = enumerate(_review_fields(schema), start=1)
    return {"source_id": "sourceid", "target_id": "targetid"} | {
        field.name: f"fieldvalue{i}" for i, field in numbered
    }


def _database_type(data_type: T.DataType) -> str | None:
    if isinstance(data_type, _REAL):
        return "float"
    if isinstance(data_type, _WHOLE):
        return "bigint"
    return "nvarchar(max)" if isinstance(data_type, T.StringType) else None


CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("RuleName", T.StringType()),
        T.StructField("PrimaryColumnName", T.StringType()),
        T.StructField("MappingColumnName", T.StringType()),
        T.StructField("FieldOrder", T.IntegerType()),
        T.StructField("Datatype", T.StringType()),
    ]
)


def column_config(spark, schema: T.StructType, created_at, user: str = S.REVIEW_USER) -> DataFrame:
    """Column configuration of a new batch: one row per column of the match output."""
    rows = [(S.RULE_NAME, name, name, 0, "bigint") for name in ("sourceid", "targetid")]
    rows += [
        (S.RULE_NAME, f.name, f"fieldvalue{i}", i, _database_type(f.dataType))
        for i, f in enumerate(_review_fields(schema), start=1)
    ]
    return spark.createDataFrame(rows, CONFIG_SCHEMA).withColumns(
        {"CreatedDate": F.lit(created_at), "CreatedBy": F.lit(user)}
    )


_FIELD = "fieldvalue"


def stored_fields(config: DataFrame) -> DataFrame:
    """(BatchId, fields): what each numbered field of an existing batch holds.

    ``fields`` maps a field's name to the match column it was set up for. It has as many
    entries as the batch has columns.
    """
    numbered = config.where(F.col("MappingColumnName").startswith(_FIELD))
    # A column configured twice counts once.
    once = numbered.groupBy("BatchId", "MappingColumnName").agg(
        F.max("PrimaryColumnName").alias("PrimaryColumnName")
    )
    entry = F.struct("MappingColumnName", "PrimaryColumnName")
    return once.groupBy("BatchId").agg(F.map_from_entries(F.collect_list(entry)).alias("fields"))


def batch_config(
    lookup: DataFrame,
    batch_sources: DataFrame,
    batches: DataFrame,
    results: DataFrame,
    configurations: DataFrame,
) -> DataFrame:
    """Active collection sources with their latest open batch, if they have one."""
    open_batches = (
        latest.latest_batch(batch_sources)
        .where(F.col("IsActive") == 1)
        .select("CollectionSourceId", "BatchId")
        .join(batches.where(F.col("Status") == S.BATCH_STATUS_NEW).select("BatchId", "ConfigurationId"), "BatchId")
        .join(results.where(F.col("RuleName") == S.RULE_NAME).select("BatchId", "MatchingResultId"), "BatchId")
        .join(configurations, "ConfigurationId")
    )
    active = lookup.where(F.col("IsActive") == 1).select(
        F.col("LookupID").alias("CollectionSourceId"),
        F.col("LookupValue").alias("collectionSourceName"),
    )
    return active.join(open_batches, "CollectionSourceId", "left")


def batch_decision(sources: DataFrame, config: DataFrame, schema_json: str) -> DataFrame:
    """Per collection source of the matches, append to its batch (1) or open a new one (0).

    A batch is appended to when it exists and its stored schema equals the new one,
    whatever the order of the keys. A source outside the active ones has no name to
    put on a batch and gets no row here; ``rejected`` has its matches.
    """
    known = sources.select(F.col("collection_source_id_src").alias("CollectionSourceId")).distinct()
    same = text.canonical_json("ColumnSchema") == text.canonical_json(F.lit(schema_json))
    append = F.col("BatchId").isNotNull() & F.coalesce(same, F.lit(False))
    kept = ["BatchId", "ConfigurationId", "MatchingResultId"]
    return (
        known.join(config, "CollectionSourceId")
        .withColumn("append_mode", append.cast("int"))
        .select(
            "CollectionSourceId",
            "collectionSourceName",
            "append_mode",
            *[F.when(F.col("append_mode") == 1, F.col(c)).alias(c) for c in kept],
        )
    )


def unknown_sources(sources: DataFrame, config: DataFrame) -> DataFrame:
    """Collection sources of the matches that are not active; an error in the data."""
    known = sources.select(F.col("collection_source_id_src").alias("CollectionSourceId")).distinct()
    return known.join(config, "CollectionSourceId", "left_anti")


def rejected(matches: DataFrame, config: DataFrame) -> DataFrame:
    """Whole match rows that no batch takes: their collection source is not active or NULL."""
    active = config.select(
        F.col("CollectionSourceId").alias("collection_source_id_src"), F.lit(True).alias("_active")
    ).distinct()
    joined = lookup_join(matches, active, ["collection_source_id_src"], "left")
    return joined.where("_active IS NULL").select(*matches.columns)


def premaster_flag(source_type: Column, target_type: Column) -> Column:
    """A source that is no master record against a target that is one."""
    masters = S.MASTER_RECORD_TYPES
    return ~source_type.isin(*masters) & target_type.isin(*masters)


def _max_id(table: DataFrame, column: str) -> Column:
    return F.coalesce(table.agg(F.max(column)).scalar(), F.lit(0)).cast("bigint")


def assign_ids(
    decisions: DataFrame, batches: DataFrame, results: DataFrame, configurations: DataFrame
) -> DataFrame:
    """Decisions with all three ids: stored ones, or the next free ones for new batches."""
    new = decisions.where(F.col("append_mode") == 0)
    ids = [
        ("ConfigurationId", configurations),
        ("BatchId", batches),
        ("MatchingResultId", results),
    ]
    kept = ["CollectionSourceId", "collectionSourceName", "append_mode"]
    counted = numbering.numbered(
        new.select(*kept), "CollectionSourceId", F.lit(0).cast("bigint"), "_number"
    )
    assigned = counted.select(
        *kept, *[(_max_id(table, name) + F.col("_number")).alias(name) for name, table in ids]
    )
    stored = decisions.where(F.col("append_mode") == 1).select(
        *kept, *[F.col(name).cast("bigint").alias(name) for name, _ in ids]
    )
    return assigned.unionByName(stored)


def batch_headers(
    assigned: DataFrame,
    schema_json: str,
    created_at,
    source_type: str = "gpo",
    target_type: str = "pm",
    user: str = S.REVIEW_USER,
) -> dict[str, DataFrame]:
    """Header rows of all new batches, one DataFrame per review table."""
    new = assigned.where(F.col("append_mode") == 0)
    made = {"CreatedBy": F.lit(user), "CreatedDate": F.lit(created_at)}
    day = F.date_format(F.lit(created_at), "yyyy-MM-dd")

    def rows(*columns, **extra) -> DataFrame:
        return new.select(*columns, *[v.alias(k) for k, v in extra.items()])

    return {
        "em.Configuration": rows(
            "ConfigurationId",
            ConfigurationName=F.concat(
                F.lit("CollectionSourceId "), F.col("CollectionSourceId").cast("string"),
                F.lit(" - "), day,
            ),
            SourceProjectId=F.lit(S.PROJECT_IDS[source_type]),
            TargetProjectId=F.lit(S.PROJECT_IDS[target_type]),
            ColumnSchema=F.lit(schema_json),
        ),
        "em.Batch": rows(
            "BatchId",
            "ConfigurationId",
            **made,
            Description=F.concat(F.lit("EM - "), F.col("collectionSourceName")),
            Status=F.lit(S.BATCH_STATUS_NEW),
            IsPremastertoMaster=premaster_flag(F.lit(source_type), F.lit(target_type)),
        ),
        "em.BatchCollectionSource": rows(
            "BatchId", "CollectionSourceId", **made, IsActive=F.lit(1)
        ),
        "em.MatchingResult": rows(
            "MatchingResultId",
            "BatchId",
            RuleName=F.lit(S.RULE_NAME),
            **made,
            IsSuccessFul=F.lit(1),
            SourceIndexName=F.lit("XXXXXXXX-XXXXXXX"),
            TargetIndexName=F.lit("finalmaster"),
        ),
    }


def column_config_rows(assigned: DataFrame, config: DataFrame) -> DataFrame:
    """The column configuration once per new batch.

    The configuration has one row per output column, so it is held as an array
    and unfolded beside each batch.
    """
    fields = config.columns
    folded = config.agg(F.collect_list(F.struct(*fields))).scalar()
    return (
        assigned.where(F.col("append_mode") == 0)
        .select("BatchId", F.explode(folded).alias("c"))
        .select("BatchId", *[F.col(f"c.{f}").alias(f) for f in fields])
    )


def detail_rows(
    matches: DataFrame,
    assigned: DataFrame,
    names: dict[str, str],
    created_at,
    user: str = S.REVIEW_USER,
    config: DataFrame | None = None,
) -> DataFrame:
    """Detail rows of all sources: ids, field values as text, result id and user.

    ``names`` is the column map of new batches. Rows for a batch that exists take the
    fields that ``config``, the stored column configuration, set up for it, whatever their
    order there; a batch without stored columns takes the new map. The values of a row are
    a map from column to text, so one plan serves batches of any order.
    """
    fields = {n: c for c, n in names.items() if n.startswith(_FIELD)}
    ids = [F.col(c).alias(n) for c, n in names.items() if n not in fields]
    results = assigned.select(
        F.col("CollectionSourceId").alias("collection_source_id_src"), "MatchingResultId",
        "BatchId", "append_mode",
    )
    by_source = ["collection_source_id_src"]
    # Values are cut before the join: where its rows are exchanged, whole texts stay behind.
    if config is None:
        rows = matches.select(*ids, *[text.field_text(c).alias(n) for n, c in fields.items()], *by_source)
        values = [F.col(n) for n in fields]
    else:
        existing = results.where(F.col("append_mode") == 1)
        held = lookup_join(existing, stored_fields(config), ["BatchId"], "left")
        results = results.where(F.col("append_mode") != 1).withColumn(
            "fields", F.lit(None).cast("map<string,string>")
        ).unionByName(held)
        of_row = F.create_map(*[x for c in fields.values() for x in (F.lit(c), text.field_text(c))])
        rows = matches.select(*ids, of_row.alias("_values"), *by_source)
        set_up = {
            n: F.when(F.col("fields").isNull(), F.lit(c)).otherwise(F.try_element_at("fields", F.lit(n)))
            for n, c in fields.items()
        }
        values = [F.try_element_at(F.col("_values"), column).alias(n) for n, column in set_up.items()]
    joined = lookup_join(rows, results.drop("BatchId", "append_mode"), by_source)
    return joined.select(
        *[n for n in names.values() if n not in fields], *values,
        F.lit(user).alias("CreatedBy"),
        F.lit(created_at).alias("CreatedDate"),
        "MatchingResultId",
    )


def earlier_proposals(
    details: DataFrame, results: DataFrame, config: DataFrame, score: str
) -> DataFrame:
    """source_id, target_id, score and BatchId of the detail rows that batches already hold.

    The field that holds the score is the one the batch's stored columns name.
    """
    fields = stored_fields(config).select("BatchId", F.try_element_at(
        F.map_keys(F.map_filter("fields", lambda _, column: column == score)), F.lit(1)
    ).alias("_field"))
    of_batch = results.select("MatchingResultId", "BatchId").join(fields, "BatchId")
    numbered = [c for c in details.columns if c.startswith(_FIELD)]
    values = F.create_map(*[x for c in numbered for x in (F.lit(c), F.col(c))])
    return lookup_join(details, of_batch, ["MatchingResultId"]).select(
        F.col("sourceid").alias("source_id"),
        F.col("targetid").alias("target_id"),
        F.try_element_at(values, F.col("_field")).try_cast("double").alias("score"),
        "BatchId",
    )


def undecided(proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """Proposals on which nobody has decided yet."""
    decided = decisions.select(
        F.col("SourceID").alias("source_id"), F.col("TargetID").alias("target_id")
    )
    return proposals.join(decided, ["source_id", "target_id"], "left_anti")


def auto_approvals(
    proposals: DataFrame,
    decisions: DataFrame,
    threshold: float = S.AUTO_APPROVE_SCORE,
    user: str = S.REVIEW_USER,
) -> DataFrame:
    """First-stage approvals: best proposal of a source, if good enough and undecided.

    ``proposals`` hold source_id, target_id, score and BatchId; sources are ranked
    inside their batch.
    """
    passing = proposals.withColumn("score", latest.real_score("score")).where(
        F.col("score") >= threshold
    )
    best = latest.first_per_key(passing, ["BatchId", "source_id"], "score")
    return undecided(best, decisions).select(
        F.col("source_id").alias("SourceID"),
        F.col("target_id").alias("TargetID"),
        F.lit(2).alias("CurrentStageID"),
        F.lit(1).alias("PreviousStageID"),
        F.lit(1).alias("UndoStageID"),
        "BatchId",
        F.lit("EM - Auto QA Approved").alias("Comments"),
        F.lit(user).alias("CreatedBy"),
        F.lit("ApprovedQAPending").alias("ActionType"),
    ).withColumnRenamed("BatchId", "BatchID")
