"""Joins against a side that is usually small, decided by measuring it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
HOT_ROWS = 1_000_000


def is_small(frame: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame is within both bounds. Every task adds up its own rows, so one short row of each meets in the end."""
    size = F.octet_length(F.to_json(F.struct(*[f"`{name}`" for name in frame.columns])))
    rows, total = frame.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def join_measured(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_ROWS,
    skewed: bool = True,
) -> DataFrame:
    """Join ``big`` to ``small`` on keys that may be very skewed in ``big``.

    Up to ``max_rows`` (and ``BROADCAST_BYTES``) the small side is broadcast and the big
    side does not move. Beyond that the sides are sorted and merged, except for hot keys:
    those with more than ``hot_rows`` big rows. Such keys are few by definition, so their
    small rows are broadcast, after a check of their size, to the big rows, which stay where
    they are. A small side that is too large to broadcast is not kept. ``skewed=False``
    says that no key repeats much. ``how`` must keep the big side (inner, left,
    left_semi or left_anti), and a key should appear once in ``small``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), keys, how)
    small.unpersist()
    merged = small.hint("merge")
    if not skewed:
        return big.join(merged, keys, how)
    hot = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows).select(*keys).persist()
    if hot.isEmpty() or not is_small(hot, max_rows):
        return big.join(merged, keys, how)
    hot_small = small.join(F.broadcast(hot), keys, "left_semi")
    if not is_small(hot_small, max_rows):
        return big.join(merged, keys, how)
    in_place = big.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_small), keys, how)
    moved = big.join(F.broadcast(hot), keys, "left_anti").join(merged, keys, how)
    return in_place.unionByName(moved)
