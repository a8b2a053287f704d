"""Small tables with the cases that every operator must take."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
TEXTS = [
    (1, "one two three four five six seven eight nine ten"),
    (1, "one two three four five six seven eight nine ten"),
    (2, ""), (3, None), (None, "text without an id at all"), (4, LONG),
    (5, "One two three four five six seven eight nine ten"), (6, "***"), (7, "\n\n  \t"),
    (8, "ends with a space "), (9, "a<|endoftext|>b <|startoftext|> c"),
    (10, "ΣΑΣ İstanbul é 日本語 👩‍👩‍👧"),
]


def documents(spark, rows=TEXTS):
    """Nulls, empty and very long texts, ties, repeated rows, columns with clashing names.

    The last three columns have names that operators use inside, or that differ from
    ``text`` in case only.
    """
    return spark.createDataFrame(
        [(i, t, None, "s", None, 0.5, 7, "x") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, score double, uid int, c8 string",
    ).withColumnRenamed("c8", "TEXT")


def labels(spark, rows=((1, 1, 0), (2, 0, 0), (4, 1, 1), (None, 1, 0), (5, None, None), (5, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
