"""Names of tables, features and review columns.

These rules work on column names, which are few; no rows pass through here.
"""

from __future__ import annotations

import re

_GROUP_PREFIX = re.compile(r"fg_[a-z]*_")


def table_name(class_name: str) -> str:
    """CamelCase class name to snake_case table name."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", class_name).lower()


def feature_column(group: str, feature: str) -> str:
    return f"{group}_{feature}"


def split_feature(name: str) -> tuple[str, str]:
    """``group.feature`` in its two parts."""
    group, _, feature = name.partition(".")
    if not group or not feature or "." in feature:
        raise ValueError(f"expected 'group.feature', got {name!r}")
    return group, feature


def features_by_group(names: list[str]) -> dict[str, list[str]]:
    """Feature names under their group, in the order given."""
    groups: dict[str, list[str]] = {}
    for name in names:
        group, feature = split_feature(name)
        groups.setdefault(group, []).append(feature)
    return groups


def without_group(column: str) -> str:
    match = _GROUP_PREFIX.match(column)
    return column[match.end():] if match else column


def column_side(column: str) -> str:
    """Side of the review screen a column belongs to."""
    return "source" if column.endswith("_src") else "target"


# Words of the headings.
SIDES = {"src": "source", "tgt": "target"}
ABBREVIATIONS = {"f": "first", "l": "last"}


def column_title(column: str) -> str:
    """Heading shown for a column: its side, then its words.

    An abbreviation is spelled out between two other words only.
    """
    words = without_group(column).split("_")
    inner = [ABBREVIATIONS.get(word, word) for word in words[1:-1]]
    words = [words[0], *inner, *words[1:][-1:]]
    if len(words) > 1 and words[-1] in SIDES:
        words = [SIDES[words[-1]], *words[:-1]]
    return " ".join(words).title()
