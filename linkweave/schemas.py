"""Table schemas, key lists and the fixed values of the domain."""

from __future__ import annotations

from pyspark.sql import types as T

RECORD_KEY = ["record_type", "record_id"]
SOURCE_KEY = ["source_type", "source_id"]
TARGET_KEY = ["target_type", "target_id"]
PAIR_KEY = SOURCE_KEY + TARGET_KEY

# What the review database and the source systems expect.
RECORD_TYPES = ("gpo", "npi", "pm", "op")
MASTER_RECORD_TYPES = ("pm",)
PROJECT_IDS = {"pm": 251, "gpo": 300, "npi": 268, "op": 277}
IMPORT_KEYS = {
    "pm": "record_id",
    "gpo": "tess_modified_at",
    "npi": "tess_modified_at",
    "op": "tess_modified_at",
}
BLOCK_COLUMNS = {
    "pm": ["first_name"],
    "gpo": ["first_name", "middle_name", "last_name"],
    "npi": ["first_name"],
    "op": ["first_name"],
}
EXPORT_ATTRIBUTES = [
    "first_name", "middle_name", "last_name", "designation", "full_name_oth",
    "address", "city", "state", "country", "city_oth", "state_oth",
    "country_oth", "npi", "orcid", "specialty", "title", "role_name", "email",
    "specialty_oth", "organization_name", "organization_name_oth",
    "social_urls", "person_listing_url", "other_ids", "is_npi_deactivated",
]
NAME_PARTS = ["first_name", "middle_name", "last_name"]
MIN_MATCH_SCORE = 0.2
AUTO_APPROVE_SCORE = 0.9
TOP_K = 5
NO_MATCH_BLOCKED_SOURCES = (17, 42, 44, 66, 108, 120, 122)
RULE_NAME = "people_generic_rule"
REVIEW_USER = "EMUser"
BATCH_STATUS_NEW = 1
IMPORT_ID_SPAN = 500_000
IMPORT_DAY_SPAN = 14
FEEDBACK_DAY_SPAN = 30
FEEDBACK_START = "2021-01-01 00:00:00"
SAMPLE_SEED = 42
MODEL_SEED = 0

RECORD = T.StructType(
    [
        T.StructField("record_type", T.StringType(), False),
        T.StructField("record_id", T.LongType(), False),
        T.StructField("collection_source_id", T.IntegerType()),
        T.StructField("publication_count", T.IntegerType()),
        T.StructField("clinical_trial_count", T.IntegerType()),
        T.StructField("tess_modified_at", T.TimestampType()),
        T.StructField("import_process_id", T.StringType()),
        T.StructField("imported_at", T.TimestampType()),
        T.StructField("sequence", T.LongType()),
    ]
    + [T.StructField(name, T.StringType()) for name in EXPORT_ATTRIBUTES]
)

PAIR = T.StructType(
    [
        T.StructField("source_type", T.StringType(), False),
        T.StructField("source_id", T.LongType(), False),
        T.StructField("target_type", T.StringType(), False),
        T.StructField("target_id", T.LongType(), False),
    ]
)

FEEDBACK = T.StructType(
    PAIR.fields
    + [
        T.StructField("is_match", T.BooleanType()),
        T.StructField("tess_modified_at", T.TimestampType()),
        T.StructField("input_type", T.StringType()),
        T.StructField("import_process_id", T.StringType()),
        T.StructField("imported_at", T.TimestampType()),
        T.StructField("sequence", T.LongType()),
    ]
)

BLOCK_RECORD = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.LongType()),
        T.StructField("block", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

PAIR_SCORE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        *PAIR.fields,
        T.StructField("score", T.DoubleType()),
        T.StructField("pre_train_model_id", T.StringType()),
        T.StructField("post_train_model_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

# Types set by name on import; everything else keeps the type it came with.
IMPORT_CASTS = {
    "publication_count": "int",
    "clinical_trial_count": "int",
    "collection_source_id": "int",
    "record_id": "bigint",
}
