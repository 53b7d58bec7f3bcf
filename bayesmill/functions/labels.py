"""Label-line parsing: comma list of codes -> set of allowed classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_set(line: Column | str, allowed: Sequence[str]) -> Column:
    """Split a comma list, keep codes in ``allowed``, drop duplicates, sort.

    ``array_intersect`` removes duplicates; sorting makes the set canonical.
    A null line gives an empty set.
    """
    c = F.col(line) if isinstance(line, str) else line
    allowed_arr = F.array(*[F.lit(a) for a in allowed]).cast("array<string>")
    parts = F.split(F.coalesce(c, F.lit("")), ",")
    return F.array_sort(F.array_intersect(parts, allowed_arr))
