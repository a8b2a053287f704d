"""Reading and writing the stored tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave.operators import importing, latest


def read(spark: SparkSession, name_or_path: str, **params) -> DataFrame:
    """A query with parameters, a parquet folder or one of committed parts, or a catalogued table."""
    head = name_or_path.lstrip().split(None, 1)[0].lower()
    if head in ("select", "with"):
        return spark.sql(name_or_path, args=params or None)
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    parts = _parts(spark, name_or_path)
    return spark.read.parquet(name_or_path) if parts is None else read_parts(spark, name_or_path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .options(header=True, escape='"', multiLine=True, mode="FAILFAST")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).options(header=True, escape='"').csv(path)


def read_range(df: DataFrame, record_type: str, key: str, start, end) -> DataFrame:
    """Rows of one type with ``start < key <= end``, as a filter on the scan."""
    return df.where((F.col("record_type") == record_type) & importing.between(df, key, start, end))


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"'{value:%Y-%m-%d %H:%M:%S}.{value.microsecond // 1000:03d}'"
    return str(int(value))


def range_predicates(key: str, start, end, parts: int, cuts: list | None = None) -> list[str]:
    """``(start, end]`` cut into WHERE clauses, one per parallel database read.

    ``cuts`` are the bounds between the parts, as ``quantile_cuts`` finds them; without them
    the parts are of equal width.
    """
    if cuts is None:
        step = (end - start) / parts
        cuts = [start + step * i for i in range(1, parts)]
    bounds = [start, *cuts, end]
    if not isinstance(start, dt.datetime):
        bounds = [int(b) for b in bounds]
    return [
        f"{key} > {_literal(low)} AND {key} <= {_literal(high)}"
        for low, high in zip(bounds, bounds[1:])
        if low < high
    ]


def quantile_cuts(keys: DataFrame, key: str, start, end, parts: int, accuracy: int = 10_000) -> list:
    """Bounds that cut the rows in ``(start, end]`` into parts of nearly equal numbers.

    ``keys`` may be the source's key column alone: one pass over it, a sketch of bounded size.
    """
    is_time = isinstance(start, dt.datetime)
    inside = keys.where(importing.between(keys, key, start, end))
    number = F.unix_micros(F.col(key).cast("timestamp")) if is_time else F.col(key)
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = inside.agg(F.percentile_approx(number, shares, accuracy)).first()[0] or []
    if is_time:
        return [dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=n) for n in sorted(set(found))]
    return sorted(set(found))


def read_database_range(
    spark: SparkSession, url: str, table: str, key: str, start, end, parts: int = 32,
    keys: DataFrame | None = None, **options
) -> DataFrame:
    """Range of a database table, read in parallel by range predicates.

    ``keys`` is the table's key column, where parts are to hold equal numbers of rows.
    """
    cuts = None if keys is None else quantile_cuts(keys, key, start, end, parts)
    predicates = range_predicates(key, start, end, parts, cuts)
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def append_database(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.jdbc(url, table, mode="append", properties=options)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append, in partition folders where columns are given.

    Rows are first brought together by folder. The rebalance keeps files near the
    advised size: it joins small pieces and cuts a folder that holds most rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, Path = _filesystem(spark, path)
    return fs.exists(Path(path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under a path, in order."""
    fs, Path = _filesystem(spark, path)
    if not fs.exists(Path(path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(Path(path)) if s.isDirectory())


def append_run(df: DataFrame, path: str) -> None:
    append(df, path, ["run_id"])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows in a declared form: its columns, in its order and types.

    A column that is not there becomes typed NULLs. A column that the form does not know,
    or that has another type, is an error: it would be lost, or change the table's type.
    """
    given = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name: f.dataType for f in schema.fields}
    unknown = sorted(given.keys() - declared.keys())
    if unknown:
        raise ValueError(f"columns unknown to the table: {unknown}")
    void = T.NullType()
    wrong = sorted(c for c, t in given.items() if t not in (declared[c], void))
    if wrong:
        raise TypeError(
            "columns of another type: " + ", ".join(
                f"{c} is {given[c].simpleString()}, not {declared[c].simpleString()}" for c in wrong
            )
        )
    return df.select([
        (F.col(c) if c in given else F.lit(None)).cast(t).alias(c) for c, t in declared.items()
    ])


def append_changes(
    df: DataFrame,
    path: str,
    batch_id: str,
    partition_by: tuple[str, ...] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Add one import to a change log; returns its rows as stored.

    Writing the same import again replaces its folder. With a declared schema, imports with
    different columns lie in one log and none is lost.
    """
    rows = df.withColumn("import_process_id", F.lit(batch_id))
    if schema is not None and latest.SEQUENCE in schema.fieldNames():
        # Stored with the rows: what an order by it says does not change from reader to reader.
        rows = rows.withColumn(latest.SEQUENCE, F.monotonically_increasing_id())
    if schema is not None:
        rows = conform(rows, schema)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by, "import_process_id")
        .parquet(path)
    )
    return read_log(df.sparkSession, path, schema).where(F.col("import_process_id") == batch_id)


def read_log(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All versions of a change log, in the declared form where one is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _part_path(path: str, run_id: str, part: str) -> str:
    return f"{path}/run_id={quote(run_id, safe='')}/part={quote(part, safe='')}"


def _parts(spark: SparkSession, path: str) -> list[str] | None:
    """Folder of the last complete version of each part; None where a path holds no parts."""
    fs, Path = _filesystem(spark, path)
    if not fs.globStatus(Path(f"{path}/run_id=*/part=*/v=*")):
        return None
    last: dict[str, int] = {}
    for status in fs.globStatus(Path(f"{path}/run_id=*/part=*/v=*/_SUCCESS")) or []:
        version = status.getPath().getParent()
        part = version.getParent()
        name = f"{path}/{part.getParent().getName()}/{part.getName()}"
        last[name] = max(last.get(name, 0), int(version.getName()[2:]))
    return [f"{name}/v={n}" for name, n in sorted(last.items())]


def replace_part(df: DataFrame, path: str, run_id: str, part: str) -> None:
    """Write what a stage made for a run; the same stage again replaces it, also by no rows.

    ``part`` tells apart what different calls of a stage write for one run. Each write is a new
    version beside the old one, and counts when its success marker is there: a write that dies half
    way is not seen, and ``df`` may read the table.
    """
    replace(df.drop("run_id", "part").hint("rebalance"), _part_path(path, run_id, part))


def empty_part(spark: SparkSession, path: str, run_id: str, part: str) -> None:
    """What a stage that found nothing leaves: no rows, also where it wrote some before."""
    if _versions(spark, _part_path(path, run_id, part)):
        replace_part(read_parts(spark, path).limit(0), path, run_id, part)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed parts, with run_id and part."""
    folders = _parts(spark, path)
    if not folders:
        raise FileNotFoundError(f"no complete part under {path}")
    return spark.read.option("basePath", path).parquet(*folders).drop("v")


#: Buckets of a snapshot, unless the writer names another number.
BUCKETS = 64


def read_latest(
    spark: SparkSession, path: str, keys: list[str], precombine: str, schema: T.StructType | None = None
) -> DataFrame:
    """Latest version per key of a change log; the later import wins a tie.

    Where a snapshot is there, only imports that came after it are ranked and exchanged, and
    merged into its buckets. A snapshot of files that an import has replaced since is passed over.
    """
    log = _log_files(spark, path)
    snapshot = _snapshot(spark, path, log)
    if snapshot is None:
        return latest.latest_version(read_log(spark, path, schema), keys, precombine)
    version, inside = snapshot
    details = spark.read.json(f"{path}_snapshot/form/v={version}").first()
    held = spark.table(_registered(spark, _snapshot_path(path, version), keys, details))
    later = sorted(log - inside)
    if not later:
        return held
    reader = (spark.read if schema is None else spark.read.schema(schema)).option("basePath", path)
    new = latest.latest_version(reader.parquet(*later), keys, precombine)
    # Dealt as the snapshot lies; else Spark would deal the side anew that has fewer parts.
    return latest.merged(held, new.repartition(details["buckets"], *keys), keys, precombine)


def compact(
    spark: SparkSession,
    path: str,
    keys: list[str],
    precombine: str,
    schema: T.StructType | None = None,
    buckets: int = BUCKETS,
) -> int:
    """Write the current rows of a change log as its next snapshot, in buckets by key.

    The snapshot counts when its success marker is there. With nothing new since the last one
    nothing is written. Returns the number of the snapshot. One writer at a time.
    """
    log = _log_files(spark, path)
    snapshot = _snapshot(spark, path, log)
    if snapshot and snapshot[1] == log:
        return snapshot[0]
    root = f"{path}_snapshot"
    version = max([0, *_versions(spark, f"{root}/files"), *_versions(spark, f"{root}/rows")]) + 1
    rows = read_latest(spark, path, keys, precombine, schema)
    spark.createDataFrame([(f,) for f in sorted(log)], "file STRING").write.mode("overwrite").parquet(f"{root}/files/v={version}")
    target = _snapshot_path(path, version)
    (
        rows.repartition(buckets, *keys)
        .write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", target)
        .saveAsTable(_snapshot_name(target))
    )
    details = spark.createDataFrame([(buckets, rows.schema.json())], "buckets INT, form STRING")
    details.write.mode("overwrite").json(f"{root}/form/v={version}")
    return version


def _snapshot_path(path: str, version: int) -> str:
    return f"{path}_snapshot/rows/v={version}"


def _snapshot_name(target: str) -> str:
    return f"snapshot_{hashlib.md5(target.encode()).hexdigest()}"


def _registered(spark: SparkSession, target: str, keys: list[str], details) -> str:
    """The snapshot's name in the catalogue, which knows its buckets; entered where it is missing."""
    name = _snapshot_name(target)
    if not spark.catalog.tableExists(name):
        form = T.StructType.fromJson(json.loads(details["form"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in form.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({', '.join(keys)}) "
            f"SORTED BY ({', '.join(keys)}) INTO {details['buckets']} BUCKETS LOCATION '{target}'"
        )
    return name


def _log_files(spark: SparkSession, path: str) -> set[str]:
    """The files of a change log; one per import and task, so their number follows the imports."""
    fs, Path = _filesystem(spark, path)
    files, found = fs.listFiles(Path(path), True), set()
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(".parquet") and "/_temporary/" not in name:
            found.add(name)
    return found


def _snapshot(spark: SparkSession, path: str, log: set[str]) -> tuple[int, set[str]] | None:
    """Number and files of the last complete snapshot, if all its files are still in the log."""
    versions = set(_versions(spark, f"{path}_snapshot/rows")) & set(_versions(spark, f"{path}_snapshot/form"))
    if not versions:
        return None
    inside = {r.file for r in spark.read.parquet(f"{path}_snapshot/files/v={max(versions)}").collect()}
    return (max(versions), inside) if inside <= log else None


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(path)
    return base.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions under a path, in order."""
    fs, Path = _filesystem(spark, path)
    if not fs.exists(Path(path)):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(Path(path))]
    return sorted(
        int(name[2:])
        for name in names
        if name.startswith("v=") and fs.exists(Path(f"{path}/{name}/_SUCCESS"))
    )


def replace(df: DataFrame, path: str) -> str:
    """Write a new version beside the old one; readers move over when it is complete.

    The old version stays in place, so ``df`` may read from it, and a write that
    dies half way leaves no visible version. One writer at a time.
    """
    versions = _versions(df.sparkSession, path)
    target = f"{path}/v={versions[-1] + 1 if versions else 1}"
    df.write.mode("overwrite").parquet(target)
    return target


def read_current(spark: SparkSession, path: str) -> DataFrame:
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete version under {path}")
    return spark.read.parquet(f"{path}/v={versions[-1]}")


def upsert(changes: DataFrame, path: str, keys: list[str], precombine: str) -> str:
    """Merge rows into a versioned table; the latest version of a key wins."""
    spark = changes.sparkSession
    if not _versions(spark, path):
        return replace(latest.first_per_key(changes, keys, precombine), path)
    return replace(latest.upsert(read_current(spark, path), changes, keys, precombine), path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Append as JSON lines, times in ISO form."""
    times = {
        f.name: F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    df.withColumns(times).write.mode("append").json(path)
