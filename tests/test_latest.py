import datetime as dt

from linkweave import schemas as S
from linkweave.operators import latest

T0 = dt.datetime(2024, 1, 1)


def scores(spark, rows):
    return spark.createDataFrame(rows, "run_id STRING, source_id BIGINT, target_id BIGINT, score DOUBLE")


def test_top_k_with_fallback_edges(spark):
    nan = float("nan")
    rows = [("r", 1, t, 0.5) for t in (6, 5, 4, 3, 2, 1)]  # six equal scores
    rows += [("r", 2, 1, 0.1), ("r", 2, 2, 0.15)]  # low scores only
    rows += [("r", 3, 1, 0.2), ("r", 3, 2, 0.19)]  # exactly the least score
    rows += [("r", 4, 1, None), ("r", 4, 2, None)]  # no score at all
    rows += [("r", 5, 1, nan), ("r", 5, 2, 0.3)]  # NaN is no score
    kept = latest.top_k_with_fallback(scores(spark, rows), ["run_id", "source_id"])
    found = sorted((r.source_id, r.target_id) for r in kept.collect())
    assert found == [(1, t) for t in range(1, 6)] + [(2, 2), (3, 1), (4, 1), (5, 2)]


def test_top_k_form_equals_the_plain_form(spark):
    rows = [("r", s, t, ((s * 31 + t * 17) % 97) / 97) for s in range(40) for t in range(12)]
    df = scores(spark, rows)
    kept = {(r.source_id, r.target_id) for r in latest.top_k_with_fallback(df, ["run_id", "source_id"]).collect()}
    expected = set()
    for s in range(40):
        ranked = sorted((r for r in rows if r[1] == s), key=lambda r: (-r[3], r[2]))
        expected |= {(r[1], r[2]) for i, r in enumerate(ranked) if (i < 5 and r[3] >= 0.2) or i == 0}
    assert kept == expected


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = latest.top_k_with_fallback(scores(spark, [("r", 1, 1, 0.5)]), ["run_id", "source_id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    partial, exchange, final = text.index("Partial"), text.index("Exchange hash"), text.index("Final")
    assert final < exchange < partial and text.count("WindowGroupLimit") == 2


def test_best_above_filters_before_ranking(spark):
    rows = [("r", 1, 1, 0.9), ("r", 1, 2, 0.95), ("r", 2, 1, 0.89), ("r", 3, 1, float("nan"))]
    best = latest.best_above(scores(spark, rows)).collect()
    assert [(r.source_id, r.target_id) for r in best] == [(1, 2)]


def test_upsert_twice_changes_nothing(spark):
    schema = "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP, v STRING"
    old = spark.createDataFrame([("pm", 1, T0, "a"), ("pm", 2, T0, "b")], schema)
    later = T0 + dt.timedelta(days=1)
    new = spark.createDataFrame([("pm", 1, later, "c"), ("pm", 3, T0, "d"), ("pm", 2, T0 - dt.timedelta(days=1), "z")], schema)
    once = latest.upsert(old, new, S.RECORD_KEY, "tess_modified_at")
    twice = latest.upsert(once, new, S.RECORD_KEY, "tess_modified_at")
    expected = {(1, "c"), (2, "b"), (3, "d")}
    assert {(r.record_id, r.v) for r in once.collect()} == expected
    assert {(r.record_id, r.v) for r in twice.collect()} == expected


def test_first_per_key_is_the_same_however_rows_lie(spark):
    rows = [("pm", i % 7, T0, str(i), f"p{i:02}") for i in range(70)]
    schema = "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP, v STRING, import_process_id STRING"
    df = spark.createDataFrame(rows, schema)
    for found in (latest.latest_records, latest.dedup_records):
        results = [sorted(map(tuple, found(df.repartition(n, "v")).collect())) for n in (1, 3, 8)]
        assert results[0] == results[1] == results[2]
    # Of equal times the later import's row stands.
    assert {r.v for r in latest.latest_records(df).collect()} == {str(i) for i in range(63, 70)}


def test_incoming_row_wins_at_the_same_time(spark):
    schema = "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP, v STRING"
    old = spark.createDataFrame([("pm", 1, T0, "a_old")], schema)
    new = spark.createDataFrame([("pm", 1, T0, "b_new")], schema)
    assert [r.v for r in latest.upsert(old, new, S.RECORD_KEY, "tess_modified_at").collect()] == ["b_new"]
    assert [r.v for r in latest.upsert(new, old, S.RECORD_KEY, "tess_modified_at").collect()] == ["a_old"]


def test_latest_records_read_only_what_is_asked_for(spark, tmp_path):
    schema = "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP, imported_at TIMESTAMP, first_name STRING, city STRING"
    spark.createDataFrame([("pm", 1, T0, T0, "a", "b")], schema).write.parquet(f"{tmp_path}/r")
    plan = latest.latest_records(spark.read.parquet(f"{tmp_path}/r")).select("record_id", "first_name")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "city" not in text
    assert "first_name" in text and "imported_at" in text


def test_pair_scored_often_takes_one_place(spark):
    schema = "source_type STRING, source_id BIGINT, target_type STRING, target_id BIGINT, score DOUBLE, created_at TIMESTAMP"
    later = T0 + dt.timedelta(hours=1)
    rows = [("gpo", 1, "pm", 1, 0.9, T0)] * 5 + [("gpo", 1, "pm", 1, 0.4, later), ("gpo", 1, "pm", 1, 0.6, later), ("gpo", 1, "pm", 2, 0.3, T0)]
    found = latest.latest_scores(spark.createDataFrame(rows, schema)).collect()
    assert {(r.target_id, r.score) for r in found} == {(1, 0.6), (2, 0.3)}
