import datetime as dt
import json
from pathlib import Path

import pytest

from linkweave import schemas as S
from linkweave.operators import latest
from linkweave.sources import tables

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP, v STRING"


def rows(spark, *values):
    return spark.createDataFrame([("pm", i, T0 + dt.timedelta(days=d), v) for i, d, v in values], SCHEMA)


def found(df):
    return {(r.record_id, r.v) for r in df.collect()}


def test_csv_roundtrip(spark, tmp_path):
    df = rows(spark, (1, 0, 'say "x", y'), (2, 1, "two\nlines"), (3, 2, None))
    path = f"{tmp_path}/t"
    tables.write_csv(df, path)
    assert found(tables.read_csv(spark, path, df.schema)) == found(df)


def test_read_by_query_path_and_name(spark, tmp_path):
    df = rows(spark, (1, 0, "a"), (2, 0, "b"))
    tables.append(df, f"{tmp_path}/t")
    df.createOrReplaceTempView("some_rows")
    assert found(tables.read(spark, f"{tmp_path}/t")) == {(1, "a"), (2, "b")}
    assert tables.read(spark, "some_rows").count() == 2
    query = tables.read(spark, "SELECT * FROM some_rows WHERE record_id = :id", id=2)
    assert found(query) == {(2, "b")}


def test_append_run_makes_a_folder_per_run(spark, tmp_path):
    path = f"{tmp_path}/t"
    for run in ("r1", "r2"):
        tables.append_run(rows(spark, (1, 0, run), (2, 0, run)).selectExpr("*", f"'{run}' AS run_id"), path)
    assert sorted(p.name for p in Path(path).glob("run_id=*")) == ["run_id=r1", "run_id=r2"]
    df = tables.read(spark, path).where("run_id = 'r2'")
    assert found(df) == {(1, "r2"), (2, "r2")}
    assert "run_id#" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_large_folder_is_cut_into_several_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        df = spark.range(60000).selectExpr("id", "if(id % 3 = 0, 'other', 'hot') AS run_id")
        tables.append_run(df.repartition(8), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(Path(path).glob("run_id=hot/*.parquet"))) > 1
    assert spark.read.parquet(path).count() == 60000


def test_replace_may_read_what_it_replaces(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, path)
    tables.replace(rows(spark, (1, 0, "a")), path)
    tables.replace(tables.read_current(spark, path).unionByName(rows(spark, (2, 0, "b"))), path)
    assert found(tables.read_current(spark, path)) == {(1, "a"), (2, "b")}


def test_unfinished_version_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace(rows(spark, (1, 0, "a")), path)
    (Path(path) / "v=2").mkdir()  # a write that died before its success marker
    assert found(tables.read_current(spark, path)) == {(1, "a")}
    tables.replace(rows(spark, (3, 0, "c")), path)
    assert found(tables.read_current(spark, path)) == {(3, "c")}


def test_change_log_and_repeated_import(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.append_changes(rows(spark, (1, 0, "a"), (2, 0, "b")), path, "p1")
    for _ in range(2):  # the second import runs twice
        tables.append_changes(rows(spark, (1, 1, "c"), (3, 0, "d")), path, "p2")
    assert spark.read.parquet(path).count() == 4
    current = tables.read_latest(spark, path, S.RECORD_KEY, "tess_modified_at")
    assert found(current) == {(1, "c"), (2, "b"), (3, "d")}


def test_upsert_of_a_stored_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    change = rows(spark, (1, 1, "c"), (3, 0, "d"))
    tables.upsert(rows(spark, (1, 0, "a"), (2, 0, "b")), path, S.RECORD_KEY, "tess_modified_at")
    for _ in range(2):
        tables.upsert(change, path, S.RECORD_KEY, "tess_modified_at")
    assert found(tables.read_current(spark, path)) == {(1, "c"), (2, "b"), (3, "d")}


def test_json_lines(spark, tmp_path):
    path = f"{tmp_path}/t"
    for i in (1, 2):
        tables.append_json_lines(rows(spark, (i, 0, "a")), path)
    lines = [json.loads(l) for p in Path(path).glob("*.json") for l in p.read_text().splitlines()]
    assert sorted(l["record_id"] for l in lines) == [1, 2]
    assert lines[0]["tess_modified_at"] == "2024-01-01T00:00:00.000000"


def test_imports_with_different_columns_lose_none(spark, tmp_path):
    path = f"{tmp_path}/log"
    one = spark.sql("SELECT 'gpo' AS record_type, 1L AS record_id, 'a' AS first_name")
    two = spark.sql("SELECT 'pm' AS record_type, 2L AS record_id, 'o-1' AS orcid, 'p' AS npi")
    tables.append_changes(one, path, "p1", schema=S.RECORD)
    kept = tables.append_changes(two, path, "p2", schema=S.RECORD)
    assert kept.count() == 1
    rows = {r.record_id: r for r in tables.read_log(spark, path, S.RECORD).collect()}
    assert rows[2].orcid == "o-1" and rows[1].orcid is None and rows[1].first_name == "a"


def test_conform_refuses_unknown_columns_and_other_types(spark):
    with pytest.raises(ValueError, match="colour"):
        tables.conform(spark.sql("SELECT 'x' AS colour"), S.RECORD)
    with pytest.raises(TypeError, match="record_id"):
        tables.conform(spark.sql("SELECT 'x' AS record_id"), S.RECORD)
    assert tables.conform(spark.sql("SELECT NULL AS city"), S.RECORD).schema["city"].dataType.simpleString() == "string"


def counts(spark, path):
    return {(r.run_id, r.part): r["count"] for r in tables.read(spark, path).groupBy("run_id", "part").count().collect()}


def test_a_stage_replaces_its_own_part_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    for run, part, n in (("r1", "a", 3), ("r1", "b", 2), ("r2", "a", 1), ("r1", "a", 4)):
        tables.replace_part(spark.range(n), path, run, part)
    assert counts(spark, path) == {("r1", "a"): 4, ("r1", "b"): 2, ("r2", "a"): 1}


def test_a_stage_that_finds_nothing_empties_its_part(spark, tmp_path):
    path = f"{tmp_path}/t"
    for run, part, n in (("r1", "a", 3), ("r/1 %", "b=c", 2)):
        tables.replace_part(spark.range(n), path, run, part)
    assert counts(spark, path) == {("r1", "a"): 3, ("r/1 %", "b=c"): 2}
    tables.empty_part(spark, path, "r1", "a")
    tables.empty_part(spark, path, "r1", "never written")
    assert counts(spark, path) == {("r/1 %", "b=c"): 2}
    tables.replace_part(spark.range(0), path, "r/1 %", "b=c")
    assert counts(spark, path) == {} and tables.read(spark, path).columns == ["id", "run_id", "part"]


def test_a_part_that_is_half_written_is_not_seen(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_part(spark.range(3), path, "r1", "a")
    half = Path(path) / "run_id=r1" / "part=a" / "v=2"
    half.mkdir()
    whole = next((Path(path) / "run_id=r1" / "part=a" / "v=1").glob("*.parquet"))
    (half / "part-0.parquet").write_bytes(whole.read_bytes())
    new = Path(path) / "run_id=r2" / "part=a" / "v=1"
    new.mkdir(parents=True)
    (new / "part-0.parquet").write_bytes(whole.read_bytes())
    assert counts(spark, path) == {("r1", "a"): 3}
    with pytest.raises(FileNotFoundError):
        half_only = f"{tmp_path}/u"
        (Path(half_only) / "run_id=r1" / "part=a" / "v=1").mkdir(parents=True)
        tables.read(spark, half_only)


def records(spark, *values):
    return spark.createDataFrame(
        [("pm", i, T0 + dt.timedelta(days=d), v) for i, d, v in values],
        "record_type STRING, record_id BIGINT, tess_modified_at TIMESTAMP, first_name STRING",
    )


def test_ties_within_one_import_have_one_winner(spark, tmp_path):
    path = f"{tmp_path}/t"
    many = records(spark, *[(i % 50, 0, f"v{i}") for i in range(1000)]).repartition(8)
    tables.append_changes(many, path, "p1", schema=S.RECORD)
    log = tables.read_log(spark, path, S.RECORD)
    assert log.select("sequence").distinct().count() == 1000
    winners = {r.record_id: r.first_name for r in tables.read_latest(spark, path, S.RECORD_KEY, "tess_modified_at", S.RECORD).collect()}
    by_sequence = {}
    for r in sorted(log.collect(), key=lambda r: r.sequence):
        by_sequence[r.record_id] = r.first_name
    assert winners == by_sequence
    narrow = tables.read_latest(spark, path, S.RECORD_KEY, "tess_modified_at", S.RECORD).select(*S.RECORD_KEY, "first_name")
    for _ in range(2):
        assert {r.record_id: r.first_name for r in narrow.repartition(3).collect()} == winners
    scan = narrow._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "last_name" not in scan and "imported_at:timestamp,seque" in scan


def test_snapshot_and_later_imports(spark, tmp_path):
    path = f"{tmp_path}/t"
    args = (path, S.RECORD_KEY, "tess_modified_at", S.RECORD)

    def current():
        return {(r.record_id, r.first_name) for r in tables.read_latest(spark, *args).collect()}

    def whole():
        log = tables.read_log(spark, path, S.RECORD)
        return {(r.record_id, r.first_name) for r in latest.latest_version(log, S.RECORD_KEY, "tess_modified_at").collect()}

    tables.append_changes(records(spark, (1, 0, "a"), (2, 5, "b"), (3, 0, "c"), (3, 0, "d")), path, "p1", schema=S.RECORD)
    assert tables.compact(spark, *args, buckets=4) == 1
    assert tables.compact(spark, *args, buckets=4) == 1
    assert current() == whole()
    tables.append_changes(records(spark, (1, 1, "newer"), (2, 4, "older"), (3, 0, "later"), (4, 0, "e")), path, "p2", schema=S.RECORD)
    assert current() == whole() == {(1, "newer"), (2, "b"), (3, "later"), (4, "e")}
    plan = tables.read_latest(spark, *args)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "FileScan" in line and "Bucketed: true" in line)
    depth, above = plan[at].index("FileScan"), []
    for line in reversed(plan[:at]):
        here = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if here < depth:
            depth = here
            above.append(line)
    assert not any("Exchange" in line for line in above) and any("SortMergeJoin" in line for line in above)
    # The catalogue of another session does not know the snapshot.
    spark.sql(f"DROP TABLE {tables._snapshot_name(tables._snapshot_path(path, 1))}")
    assert current() == whole()
    # An import that is run again replaces files that the snapshot holds: it is passed over.
    tables.append_changes(records(spark, (1, 9, "again")), path, "p1", schema=S.RECORD)
    assert current() == whole() == {(1, "again"), (2, "older"), (3, "later"), (4, "e")}
    assert tables.compact(spark, *args, buckets=4) == 2
    assert current() == whole()
    # A snapshot that died half way is not seen.
    (Path(f"{path}_snapshot") / "rows" / "v=3").mkdir()
    assert current() == whole()
