"""Joins that look rows up in a table with one or few rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "_spread"


def lookup_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner", dealt: bool = False) -> DataFrame:
    """Equi-join of ``rows`` with a table, safe against hot keys in ``rows``.

    Adaptive execution cuts a skewed key into pieces, but only where both sides
    come straight out of an exchange. A table that is fresh from a groupBy or a
    window on the key is already partitioned by it; the join would take it as it
    is, and a key with a third of the rows, or the NULL key, would go to one task.
    The second key, a function of the first, makes Spark exchange both sides anew.

    Rows that are ``dealt`` lie by ``on`` already, and ``on`` has a part that spreads hot
    keys. They stay where they are, unsorted: a task holds its share of the table only.
    """
    if dealt:
        return rows.join(table.hint("shuffle_hash"), on, how)
    spread = F.expr(f"CAST(pmod(xxhash64({', '.join(on)}), 1024) AS INT)")
    left = rows.withColumn(_SPREAD, spread)
    right = table.withColumn(_SPREAD, spread)
    return left.join(right, [*on, _SPREAD], how).drop(_SPREAD)
