"""Consecutive numbers for new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, key: str, start: Column, alias: str) -> DataFrame:
    """Rows numbered upward from ``start`` in the order of a distinct INT key.

    The key is cut into blocks of 65,536 values, so neither the list of blocks nor
    the rows of one block can exceed that number: the running total over the
    blocks is small and the ranking itself is spread out.
    """
    rows = df.withColumn("_bucket", F.shiftright(F.col(key).cast("int"), 16))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_bucket")
    offsets = counts.select(
        "_bucket", (F.sum("_n").over(running) - F.col("_n")).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        rows.join(offsets, "_bucket")
        .withColumn(alias, (start + F.col("_before") + inside).cast("bigint"))
        .drop("_bucket", "_before")
    )
