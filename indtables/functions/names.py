"""Column references for names that come from the data (wide labels)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column called exactly ``name`` (dots, spaces, backticks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def unique_names(values: list[str], taken: tuple[str, ...] = (), empty: str = "unlabelled") -> list[str]:
    """A column name for each value, in order, unique without regard to case.
    A value is its own name where it can be; the empty text is ``empty``; a
    name that is taken gets the first free suffix ``_2``, ``_3``, ..."""
    used = {t.lower() for t in taken}
    own = {v.lower() for v in values}
    out = []
    for value in values:
        base = value or empty
        name, n = base, 1
        while name.lower() in used or (name != value and name.lower() in own):
            n += 1
            name = f"{base}_{n}"
        used.add(name.lower())
        out.append(name)
    return out
