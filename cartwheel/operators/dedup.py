"""Deterministic "keep the first row per key", expressed as an aggregation.

``row_number() OVER (PARTITION BY key ORDER BY …) = 1`` would send every
copy of a key to one task. Expressed as ``min(struct(rank…, payload…))``
grouped by the key, Spark combines copies map-side (partial aggregate)
before the shuffle, so a key repeated a billion times costs one row per
map task, not one task holding a billion rows. Struct comparison is
lexicographic, so the rank columns decide and the payload only breaks
exact ties (which then carry equal rank, i.e. no defined "first" anyway).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_PACK = "_first"


def keep_first(df: DataFrame, keys: Sequence[str], rank: Sequence[str],
               keep: Sequence[str]) -> DataFrame:
    """One row per ``keys`` (NULLs compare equal): the one smallest by ``rank``.

    ``keep`` are the payload columns carried over from the chosen row.

    * One rank column (a row position, unique within a key): one
      ``min_by(column, rank)`` per payload column. All of them pick the same
      row, Catalyst drops the ones a query does not use (and whatever
      computed them), and fixed-width columns aggregate in a hash map.
    * Several rank columns, or none: ``min(struct(rank…, payload…))``; with no
      rank the smallest payload wins, which is still deterministic.
    """
    if not keep:
        return df.select(*keys).distinct()
    if len(rank) == 1:
        order = F.col(rank[0])
        return df.groupBy(*keys).agg(*[F.min_by(F.col(c), order).alias(c) for c in keep])
    ranked = [F.col(c).alias(f"_r{i}") for i, c in enumerate(rank)]
    packed = F.struct(*ranked, *[F.col(c) for c in keep])
    return (
        df.groupBy(*keys)
        .agg(F.min(packed).alias(_PACK))
        .select(*keys, *[F.col(f"{_PACK}.{c}").alias(c) for c in keep])
    )
