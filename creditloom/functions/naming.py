"""Column-name rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def quoted(name: str) -> str:
    """A column name inside an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(value: object) -> str:
    """A text, number or NULL inside an SQL expression."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def clean_name(name: str) -> str:
    """Only ASCII letters, digits and underscore survive."""
    return re.sub("[^A-Za-z0-9_]+", "", name)


def clean_names(df: DataFrame) -> DataFrame:
    """Apply `clean_name` to every column; two columns falling on one name is an error."""
    cleaned = [clean_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, cleaned):
        if new.lower() in seen:
            raise ValueError(f"columns {seen[new.lower()]!r} and {old!r} both clean to {new!r}")
        seen[new.lower()] = old
    return df.toDF(*cleaned)


def search_names(names: list[str], pattern: str, case_sensitive: bool = False) -> list[str]:
    """Names in which the regular expression is found."""
    found = re.compile(pattern, 0 if case_sensitive else re.IGNORECASE)
    return [n for n in names if isinstance(n, str) and found.search(n)]
