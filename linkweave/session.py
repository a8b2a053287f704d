"""Session settings that the plans are written for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot record ids, names and terms are split at run time, even where the
    # split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.broadcastTimeout": "1800",
}


def build_session(app: str = "linkweave", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, which driver and executors share.

    The one the cluster names in spark.checkpoint.dir, else one in the warehouse, where
    the session's tables lie. Never a folder of one machine's own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(
            "set spark.checkpoint.dir to a folder that driver and executors share: "
            f"the warehouse {warehouse} is a folder of one machine"
        )
    return warehouse.rstrip("/") + "/_intermediate"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """A path for an intermediate table that nothing else uses."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame, codec: str | None = None) -> DataFrame:
    """The rows written out as an intermediate table and read back.

    Cuts the lineage where several plans read the same costly rows. The table
    survives the loss of executors, and readers take only the columns they need.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Delete the application's intermediate tables, at its end: readers need them before."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
