"""Incremental import: marks, ranges, shaping of the imported rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave import schemas as S
from linkweave.functions import text


def import_marks(stored: DataFrame) -> DataFrame:
    """Per record type, the last modified time and the largest id already stored."""
    return stored.groupBy("record_type").agg(
        F.max("tess_modified_at").alias("last_modified_at"),
        F.max("record_id").alias("last_record_id"),
    )


def day_range_end(start: Column, days: int = S.IMPORT_DAY_SPAN) -> Column:
    return start + F.make_dt_interval(days=F.lit(days))


def id_range_start(mark: Column) -> Column:
    """A type with nothing stored starts at 1."""
    return F.coalesce(mark, F.lit(1).cast("bigint"))


def id_range_end(mark: Column, span: int = S.IMPORT_ID_SPAN) -> Column:
    return id_range_start(mark) + F.lit(span)


def feedback_range_start(mark: Column) -> Column:
    return F.coalesce(mark, F.lit(S.FEEDBACK_START).cast("timestamp"))


def feedback_range_end(mark: Column) -> Column:
    return day_range_end(feedback_range_start(mark), S.FEEDBACK_DAY_SPAN)


def import_range(
    stored: DataFrame, record_type: str, initial: dt.datetime | None = None, passed=None
) -> tuple:
    """Start and end of the next import of a type, as two driver-side values.

    ``initial`` is the start for a dated type with nothing stored yet; without it
    such a type is an error. ``passed`` is the end of ranges already looked through:
    one without rows leaves no other trace.
    """
    key = S.IMPORT_KEYS[record_type]
    mark = stored.where(F.col("record_type") == record_type).agg(F.max(key)).first()[0]
    mark = max((m for m in (mark, passed) if m is not None), default=None)
    if key == "record_id":
        start = 1 if mark is None else int(mark)
        return start, start + S.IMPORT_ID_SPAN
    start = mark if mark is not None else initial
    if start is None:
        raise ValueError(f"nothing stored for {record_type!r}: give an initial time")
    return start, start + dt.timedelta(days=S.IMPORT_DAY_SPAN)


def feedback_range(
    stored: DataFrame, input_type: str, target_type: str = "pm", passed: dt.datetime | None = None
) -> tuple:
    """Start and end of the next feedback import; ``passed`` as in ``import_range``."""
    mark = (
        stored.where(
            (F.col("input_type") == input_type) & (F.col("target_type") == target_type)
        )
        .agg(F.max("tess_modified_at"))
        .first()[0]
    )
    marks = [m for m in (mark, passed) if m is not None]
    start = max(marks, default=dt.datetime.fromisoformat(S.FEEDBACK_START))
    return start, start + dt.timedelta(days=S.FEEDBACK_DAY_SPAN)


def between(df: DataFrame, key: str, start, end) -> Column:
    """``(start, end]``: the mark itself is already stored.

    The bounds take the type of the column. A cast of the column instead would
    keep the filter out of the scan.
    """
    kind = df.schema[key].dataType
    return (F.col(key) > F.lit(start).cast(kind)) & (F.col(key) <= F.lit(end).cast(kind))


def any_type_between(df: DataFrame, key: str, ranges: dict[str, tuple]) -> Column:
    """Rows of several record types, each inside its own range."""
    condition = F.lit(False)
    for record_type, (start, end) in sorted(ranges.items()):
        condition = condition | (
            (F.col("record_type") == record_type) & between(df, key, start, end)
        )
    return condition


def with_metadata(df: DataFrame, **values) -> DataFrame:
    """Constant columns such as run_id, process_id or a time of writing."""
    return df.withColumns(
        {
            name: value if isinstance(value, Column) else F.lit(value)
            for name, value in values.items()
        }
    )


def fill_modified_at(records: DataFrame) -> DataFrame:
    """Master records carry no modified time; the import time stands in."""
    return records.withColumn(
        "tess_modified_at",
        F.when(F.col("record_type") == "pm", F.col("imported_at")).otherwise(
            F.col("tess_modified_at")
        ),
    )


def cast_columns(df: DataFrame, types: dict[str, str] = S.IMPORT_CASTS) -> DataFrame:
    """Cast columns by name; text that does not parse becomes NULL."""
    present = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present)


def label_to_boolean(df: DataFrame, label: str = "is_match") -> DataFrame:
    return df.withColumn(label, F.col(label).try_cast("boolean"))


def fill_sentinels(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text.fill_sentinel(c) for c in columns})


def drop_sentinels(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text.drop_sentinel(c) for c in columns})
