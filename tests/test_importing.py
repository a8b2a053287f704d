import datetime as dt

import pytest

from linkweave.operators import importing
from linkweave.sources import tables

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP"


def stored(spark):
    return spark.createDataFrame([("gpo", 5, T0), ("gpo", 3, T0 - dt.timedelta(days=1)), ("pm", 9, None)], SCHEMA)


def test_ranges(spark):
    assert importing.import_range(stored(spark), "gpo") == (T0, T0 + dt.timedelta(days=14))
    assert importing.import_range(stored(spark), "pm") == (9, 500009)


def test_first_import(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert importing.import_range(empty, "pm") == (1, 500001)
    with pytest.raises(ValueError, match="initial"):
        importing.import_range(empty, "npi")
    assert importing.import_range(empty, "npi", T0)[0] == T0


def test_feedback_range(spark):
    schema = "input_type STRING, target_type STRING, tess_modified_at TIMESTAMP"
    rows = spark.createDataFrame([("gpo", "pm", T0)], schema)
    assert importing.feedback_range(rows, "gpo") == (T0, T0 + dt.timedelta(days=30))
    start = dt.datetime(2021, 1, 1)
    assert importing.feedback_range(rows, "npi") == (start, start + dt.timedelta(days=30))


def test_range_is_open_at_the_mark_and_closed_at_the_end(spark):
    rows = spark.createDataFrame([("pm", i, None) for i in (9, 10, 20, 21)], SCHEMA)
    found = tables.read_range(rows, "pm", "record_id", 9, 20)
    assert sorted(r.record_id for r in found.collect()) == [10, 20]


def test_range_filter_reaches_the_scan(spark, tmp_path):
    stored(spark).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    ranges = {"gpo": (T0, T0 + dt.timedelta(days=1))}
    plan = df.where(importing.any_type_between(df, "tess_modified_at", ranges))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(tess_" in text.split("PushedFilters")[1]


def test_casts_of_sentinel_text_give_null(spark):
    df = spark.createDataFrame([("12", "null"), ("null", "3")], "record_id STRING, publication_count STRING")
    rows = importing.cast_columns(df).collect()
    assert [tuple(r) for r in rows] == [(12, None), (None, 3)]


def test_range_predicates_cover_the_range_once():
    parts = tables.range_predicates("id", 1, 500001, 4)
    assert parts[0] == "id > 1 AND id <= 125001" and parts[-1] == "id > 375001 AND id <= 500001"
    assert len(tables.range_predicates("id", 1, 3, 8)) == 2
    days = tables.range_predicates("t", T0, T0 + dt.timedelta(days=2), 2)
    assert days == [
        "t > '2024-01-01 00:00:00.000' AND t <= '2024-01-02 00:00:00.000'",
        "t > '2024-01-02 00:00:00.000' AND t <= '2024-01-03 00:00:00.000'",
    ]


def test_cuts_follow_the_rows(spark):
    """99 % of the ids lie in 1 % of the span; parts still hold like numbers, each id once."""
    keys = spark.range(20000).selectExpr("if(id % 100 = 0, id * 50, 500000 + id % 10000) AS record_id")
    cuts = tables.quantile_cuts(keys, "record_id", 1, 1_000_000, 8)
    parts = [keys.where(p).count() for p in tables.range_predicates("record_id", 1, 1_000_000, 8, cuts)]
    assert len(parts) == 8 and sum(parts) == keys.where("record_id > 1 AND record_id <= 1000000").count()
    assert max(parts) <= 2 * min(parts)
    assert tables.quantile_cuts(keys.limit(0), "record_id", 1, 10, 4) == []
    assert len(tables.range_predicates("record_id", 1, 10, 4, [])) == 1


def test_cuts_of_times(spark):
    times = spark.range(1000).selectExpr("timestamp_seconds(1704067200 + if(id < 990, id, id * 1000)) AS t")
    end = T0 + dt.timedelta(days=14)
    cuts = tables.quantile_cuts(times, "t", T0, end, 4)
    parts = [times.where(p).count() for p in tables.range_predicates("t", T0, end, 4, cuts)]
    assert sum(parts) == 999 and max(parts) <= 2 * min(parts)
