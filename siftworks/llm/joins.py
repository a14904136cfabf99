"""Equi-joins whose frequent keys don't meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is frequent from this many rows, or from one part in KEYS of all: so KEYS keys at most are.
ROWS, KEYS = 100_000, 20_000


def hub_join(rows: DataFrame, per_key: DataFrame, on: list[str], n: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined (inner or left) with ``per_key``, one row for each key, whose column ``n`` tells how many of the ``total`` rows have it.

    Rows of frequent keys stay where they are and get their row of ``per_key``, of which there
    are KEYS at most, by broadcast; all others meet by shuffle. ``n`` is dropped.
    """
    least = max(ROWS, -(-total // KEYS))
    hot = F.broadcast(per_key.where(F.col(n) >= least))
    if total < ROWS:
        return rows.join(per_key.drop(n), on, how)
    few = rows.join(hot.select(*on), on, "left_anti").join(per_key.where(F.col(n) < least).drop(n), on, how)
    return rows.join(hot.drop(n), on).unionByName(few)
