"""Names for columns that operators add for a while."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores behind it until no column is called so in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
