"""Extendible hashing: shards by a directory of hash-prefix bits.

A row's address has 60 bits: 32 from the hash of its id, then 28 from the hash of
its text, so rows that repeat an id can still be told apart. The directory begins
with one bucket of depth 0; only a bucket over the byte limit is split on the next
bit, again and again. Rows with one address (equal id and text) cannot be split on
bits: their bucket, at full depth, goes on in pages of as many copies as fit.

A text is counted in UTF-8 bytes. Null ids hash as the empty string, null and empty
texts have 0 bytes. A single row above the limit has a page of its own. An empty
table has no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import pick, stored

BITS = 60
#: Splitting works on sums by this many bits first: at most 2**24 rows, whatever the input.
CELL_BITS = 24
MAX_BYTES = 1 << 20


def _address():
    def bits(name: str, digits: int):
        value = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")

    return F.shiftleft(bits("doc_id", 8), 28) + bits("text", 7)


def _addresses(documents: DataFrame) -> DataFrame:
    """One row per id and address with the bytes of a copy and the number of copies."""
    return (
        pick(documents, "doc_id", "text")
        .select(
            "doc_id",
            _address().alias("address"),
            F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
        )
        .groupBy("doc_id", "address", "bytes")
        .agg(F.count("*").alias("copies"))
    )


def _split(sums: DataFrame, bits: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Depths of the cells, by splitting oversized buckets; and the cells never small enough.

    ``sums`` has (cell, total), a cell being an address's first ``bits`` bits.
    """
    spark = sums.sparkSession
    left = stored(sums)
    done = None
    while True:
        bucket = F.shiftright("cell", bits - depth)
        sizes = left.groupBy(bucket.alias("bucket")).agg(F.sum("total").alias("size"))
        large = sizes.where(F.col("size") > limit).select("bucket")
        keyed = left.withColumn("bucket", bucket)
        closed = keyed.join(large, "bucket", "left_anti").select(
            "cell", F.lit(depth).alias("depth")
        )
        done = closed if done is None else done.unionByName(closed)
        open_cells = keyed.join(large, "bucket", "left_semi").select("cell", "total")
        if depth == bits:
            return done, open_cells
        left = stored(open_cells)
        if left.isEmpty():
            return done, spark.createDataFrame([], sums.schema)
        depth += 1


def assign_shards(documents: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Shard of every row: doc_id, address, bytes, depth, prefix (its first ``depth`` bits), page.

    A shard is a (depth, prefix, page); its rows have at most ``max_bytes`` bytes
    together, unless it is a single row. Pages are 0 but for repeated rows.
    """
    rows = stored(_addresses(documents))
    total = F.sum(F.col("bytes") * F.col("copies")).alias("total")
    cell = F.shiftright("address", BITS - CELL_BITS)
    done, rest = _split(rows.groupBy(cell.alias("cell")).agg(total), CELL_BITS, 0, max_bytes)
    placed = rows.withColumn("cell", cell).join(done, "cell").drop("cell")
    if not rest.isEmpty():
        deep = rows.withColumn("cell", cell).join(rest.select("cell"), "cell", "left_semi")
        sums = deep.groupBy(F.col("address").alias("cell")).agg(total)
        fine, full = _split(sums, BITS, CELL_BITS + 1, max_bytes)
        fine = fine.unionByName(full.select("cell", F.lit(BITS).alias("depth")))
        placed = placed.unionByName(
            deep.drop("cell").join(fine.withColumnRenamed("cell", "address"), "address"),
        )
    fits = F.greatest(F.floor(F.lit(max_bytes) / F.greatest("bytes", F.lit(1))), F.lit(1))
    one_address = F.col("depth") == BITS
    return placed.select(
        "doc_id",
        "address",
        "bytes",
        F.col("depth").cast("int").alias("depth"),
        # A shift by 64 is none, but a depth of 0 shifts by 60 only.
        F.expr(f"shiftright(address, {BITS} - depth)").alias("prefix"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"),
        fits.alias("fits"),
        one_address.alias("one_address"),
    ).select(
        "doc_id", "address", "bytes", "depth", "prefix",
        F.when(F.col("one_address"), F.floor(F.col("copy") / F.col("fits")))
        .otherwise(0).cast("long").alias("page"),
    )


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard with its rows and bytes."""
    return assigned.groupBy("depth", "prefix", "page").agg(
        F.count("*").alias("documents"), F.sum("bytes").alias("bytes")
    )


def write_shards(documents: DataFrame, path: str, max_bytes: int = MAX_BYTES) -> None:
    """Every document row in the folder of its shard."""
    shards = (
        assign_shards(documents, max_bytes)
        .groupBy("doc_id", "address", "depth", "prefix", "page")
        .agg(F.count("*").alias("copies"))
    )
    distinct = pick(documents, "doc_id", "text").distinct()
    joined = (
        distinct.withColumn("address", _address()).alias("d")
        .join(
            shards.alias("s"),
            (F.col("d.address") == F.col("s.address")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")),
        )
        .selectExpr("d.doc_id", "d.text", "s.depth", "s.prefix", "s.page",
                    "explode(sequence(1L, s.copies)) AS copy")
        .drop("copy")
    )
    joined.hint("rebalance", "depth", "prefix", "page").write.partitionBy(
        "depth", "prefix", "page"
    ).parquet(path)
