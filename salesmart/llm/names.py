"""Names for columns that an operator adds to a table for a while."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(columns: Iterable[str], base: str) -> str:
    """``base``, with as many underscores behind it as it takes to differ from all columns, whatever their case."""
    taken = {column.lower() for column in columns}
    while base.lower() in taken:
        base += "_"
    return base
