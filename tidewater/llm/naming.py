"""Names for columns of an operator's own that no column of the user's can have."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted``, each with as many underscores before it as make it differ, whatever the case, from all of ``taken``."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out
