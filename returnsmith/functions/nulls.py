"""Null rules of the returns, spelled once.

The returns treat a missing amount as "not equal to anything", a missing measure as
zero inside an existing group, and a blank lookup value as "no value".
"""

from __future__ import annotations


def text(value: str) -> str:
    """A text literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def texts(values) -> str:
    """A list of text literals."""
    return ", ".join(text(v) for v in values)


def one_of(col: str, values) -> str:
    """Membership that is false, never null, for a missing value."""
    return f"coalesce({col} IN ({texts(values)}), false)"


def not_zero(col: str) -> str:
    """True for a missing amount as well."""
    return f"NOT ({col} <=> 0)"


def sum_present(*cols: str) -> str:
    """Row-wise sum that skips missing terms (0 if all are missing)."""
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def all_present(*cols: str) -> str:
    """True where none of the columns is null: the rows a grouped report keeps."""
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def tokens_to_null(col: str, tokens) -> str:
    return f"CASE WHEN {col} NOT IN ({texts(tokens)}) THEN {col} END"
