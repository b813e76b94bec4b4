"""Joins of a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 200_000


def keyed_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    bound: int | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join on `keys` that starts no job when it is built.

    The lookup side is broadcast when `bound`, a row limit known from how it was built,
    is small. Otherwise Spark chooses by bytes: from the statistics of the plan, or, once the
    lookup side is shuffled, from its real size. Where both sides stay shuffled, adaptive
    execution splits the part of a hot key over tasks and copies only the lookup rows of that part.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    small = bound is not None and bound <= max_rows
    return big.join(F.broadcast(lookup) if small else lookup, keys, how)
