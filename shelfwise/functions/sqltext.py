"""Values and names from the data as parts of SQL expressions."""

from __future__ import annotations


def quoted(value: str) -> str:
    """String literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ticked(name: str) -> str:
    """Column name."""
    return "`" + name.replace("`", "``") + "`"
