"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave.session import shared_folder, stored  # noqa: F401

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, found by their exact names.

    Further columns, also those whose names differ in case only, never meet the
    names that an operator uses inside.
    """
    at: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{at[name]}").alias(name) for name in names])


def chunks(
    batches: Iterable[pa.RecordBatch], chars: int = 1 << 24, rows: int = 8192
) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (null: empty) of some rows at a time: until they have so many characters."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        names, values = batch.column("doc_id").to_pylist(), batch.column("text")
        for start in range(0, batch.num_rows, 256):
            part = [t or "" for t in values.slice(start, 256).to_pylist()]
            ids += names[start:start + 256]
            texts += part
            size += sum(map(len, part))
            if size >= chars or len(texts) >= rows:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def held_out(doc_id: str = "doc_id"):
    """Rows that no model may learn from: one in five, by the id's checksum."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def where_score(
    documents: DataFrame, score: Callable[[list[str]], np.ndarray], keep: Callable[[Column], Column]
) -> DataFrame:
    """The documents, all columns, whose own text (null: empty) has a score to keep.

    Rows stay where they are: nothing is stored, and no join has to find a row's score again.
    """
    # Longer than the name of any column.
    name = "score" + "_" * max(map(len, documents.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(texts) for _, texts in chunks([batch], chars=1 << 21, rows=2048)]
            if found:
                yield batch.append_column(name, pa.array(np.concatenate(found), pa.float64()))

    scored = T.StructType([*documents.schema, T.StructField(name, T.DoubleType())])
    return documents.mapInArrow(run, scored).where(keep(F.col(name))).drop(name)
