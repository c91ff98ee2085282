"""Streaming operators with bounded state: windows, deduplication, stream-stream joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.metrics import window_counts


def windowed_counts(rows: DataFrame, time: str, delay: str, length: str, *groups: str) -> DataFrame:
    """Tumbling counts that accept events up to ``delay`` late and forget closed windows."""
    return window_counts(rows.withWatermark(time, delay), time, length, *groups)


def deduplicated(rows: DataFrame, time: str, delay: str, keys: list[str]) -> DataFrame:
    """First arrival per key; state is kept only for ``delay``."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: tuple[str, str],
    times: tuple[str, str],
    within: str,
    delay: str | None = None,
) -> DataFrame:
    """Rows of both sides with equal keys, the right one at most ``within`` after the left one.

    With ``delay`` both sides are watermarked, and the time range lets Spark drop
    join state. Without it the same condition joins two batch tables.
    """
    left_time, right_time = times
    if delay is not None:
        left = left.withWatermark(left_time, delay)
        right = right.withWatermark(right_time, delay)
    in_range = (F.col(right_time) >= F.col(left_time)) & (
        F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}")
    )
    return left.join(right, (F.col(key[0]) == F.col(key[1])) & in_range)
