"""Gap filling of bucketed series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import with_neighbours

FILL_TYPES = ("none", "null", "previous", "linear", "value")

# Buckets per exploded block and per ordered cell; bounds the arrays and the sorts.
BLOCK = 10_000


def fill(
    df: DataFrame,
    kind: str,
    period_ms: int,
    start: int,
    end: int,
    origin_ms: int | None = None,
    keys: Sequence[str] = ("series_name",),
    value: str = "value",
    fill_value: float | None = None,
) -> DataFrame:
    """Rows for the empty buckets of each key between ``start`` and ``end``.

    Each non-empty bucket emits itself and the gap up to the next one, so no grid of all
    buckets is built or joined. ``previous`` carries the value on, ``linear`` interpolates
    between neighbours (open ends stay NULL), ``value`` writes ``fill_value``, ``null`` writes
    NULL. A key without any point in the range yields no rows.
    """
    if kind not in FILL_TYPES:
        raise ValueError(f"unknown fill type: {kind}")
    if kind == "none":
        return df
    if kind == "value" and fill_value is None:
        raise ValueError("fill type 'value' needs a fill value")
    origin = start if origin_ms is None else origin_ms
    first_bucket = start - (start - origin) % period_ms

    linked = with_neighbours(
        df, ["ts_ms", value], keys, chunk_ms=period_ms * BLOCK, previous="__prev", following="__next"
    )
    own, amount = F.col("ts_ms"), F.col(value)
    next_ts, next_value = F.col("__next.ts_ms"), F.col(f"__next.{value}")
    span_from = F.when(F.col("__prev").isNull(), F.lit(first_bucket)).otherwise(own)
    span_to = F.coalesce(next_ts, F.lit(end))
    width = F.lit(period_ms * BLOCK)

    blocks = linked.withColumn("__to", span_to).withColumn(
        "__block", F.explode(F.sequence(span_from.cast("bigint"), span_to - 1, width))
    )
    # a long gap is one row until here: its blocks are dealt over tasks before they become rows
    dealt = blocks.repartition(*keys, "__block")
    rows = dealt.withColumn(
        "__at",
        F.explode(
            F.sequence(
                F.col("__block"), F.least(F.col("__block") + width, F.col("__to")) - 1, F.lit(period_ms)
            )
        ),
    )
    at = F.col("__at")
    gap = F.lit(None).cast("double")
    if kind == "previous":
        gap = F.when(at > own, amount)
    elif kind == "linear":
        share = (at - own).cast("double") / (next_ts - own).cast("double")
        gap = F.when((at > own) & next_ts.isNotNull(), amount + (next_value - amount) * share)
    elif kind == "value":
        gap = F.lit(float(fill_value))
    filled = rows.withColumn("__value", F.when(at == own, amount).otherwise(gap))
    names = [c for c in df.columns if c not in ("ts_ms", value)]
    return filled.select(*names, at.alias("ts_ms"), F.col("__value").alias(value)).select(df.columns)
