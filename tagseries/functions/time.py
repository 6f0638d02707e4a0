"""Milliseconds, periods and buckets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import ColumnLike, col

# The period used when none or a non-positive one is asked for.
DEFAULT_PERIOD = "1m"
DEFAULT_PERIOD_MS = 60_000

_PERIOD = re.compile(r"(?:(\d+)h)?(?:(\d+)m)?(?:(\d+)s)?")


def to_millis(ts: ColumnLike) -> Column:
    """Epoch milliseconds, rounded down. Zone-less timestamps are read as UTC."""
    return F.unix_millis(col(ts).cast("timestamp"))


def bucket_start(ts_ms: ColumnLike, period_ms: int, origin_ms: int = 0) -> Column:
    """Start of the bucket of ``period_ms`` that holds ``ts_ms``, counted from the origin."""
    return col(ts_ms) - F.pmod(col(ts_ms) - F.lit(origin_ms), F.lit(period_ms))


def arrival_order(ts_ms: ColumnLike = "ts_ms", seq: ColumnLike = "seq") -> Column:
    """(ts_ms, seq) as one DECIMAL, so min_by / max_by keep a fixed-width buffer and the
    aggregate stays a HashAggregate (a struct or string buffer would make it sort). A point
    without ``seq`` comes before those of its instant that have one."""
    shift = F.lit(str(10**19)).cast("decimal(20,0)")
    return (col(ts_ms).cast("decimal(18,0)") * shift + F.coalesce(col(seq), F.lit(-1)).cast("decimal(19,0)")).cast("decimal(38,0)")


def period_ms(period: int | str | None) -> int:
    """Period in whole-second milliseconds from milliseconds or text such as ``2h30m``.

    Non-positive and sub-second periods become one minute.
    """
    if period is None:
        return DEFAULT_PERIOD_MS
    if isinstance(period, str):
        match = _PERIOD.fullmatch(period.strip())
        if not period.strip() or match is None:
            raise ValueError(f"not a period: {period!r}")
        hours, minutes, seconds = (int(g or 0) for g in match.groups())
        total = hours * 3600 + minutes * 60 + seconds
    else:
        total = int(period) // 1000
    return total * 1000 if total > 0 else DEFAULT_PERIOD_MS


def period_for_buckets(start: int, end: int, buckets: int) -> int:
    """Whole-second period that cuts ``[start, end)`` into at most ``buckets`` buckets."""
    if buckets <= 0:
        raise ValueError("at least one bucket is needed")
    span = max(end - start, 0)
    return period_ms(-(-span // (buckets * 1000)) * 1000)


def format_period(seconds: ColumnLike) -> Column:
    """``9000`` -> ``2h30m``; non-positive -> ``1m``."""
    s = col(seconds).cast("bigint")
    hours, minutes, rest = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))

    def part(amount: Column, unit: str) -> Column:
        return F.when(amount > 0, F.concat(amount.cast("bigint").cast("string"), F.lit(unit))).otherwise("")

    return F.when(s <= 0, DEFAULT_PERIOD).otherwise(
        F.concat(part(hours, "h"), part(minutes, "m"), part(rest, "s"))
    )


def parse_period(text: ColumnLike) -> Column:
    """``2h30m`` -> ``9000`` seconds; NULL when the text is no period."""

    def part(unit: str) -> Column:
        found = F.regexp_extract(col(text), rf"(\d+){unit}", 1)
        return F.when(found == "", F.lit(0)).otherwise(found.cast("bigint")).cast("bigint")

    valid = col(text).rlike(r"\A(?=.)(?:\d+h)?(?:\d+m)?(?:\d+s)?\z")
    return F.when(valid, part("h") * 3600 + part("m") * 60 + part("s"))


def relative_range(now_ms: int, minutes: int = 0, hours: int = 0) -> tuple[int, int]:
    """``[now - minutes - hours, now)`` in milliseconds."""
    return now_ms - (minutes * 60 + hours * 3600) * 1000, now_ms


def check_range(start: int | None, end: int | None) -> None:
    if start is not None and end is not None and end < start:
        raise ValueError(f"inverted time range: end {end} lies before start {start}")


def part_bounds(start: int | None = None, end: int | None = None, part: str = "part") -> Column:
    """Predicate on the date partition that holds for every point in ``[start, end)``, whether the
    table was written by day, month or year."""
    keep = F.lit(True)
    if start is not None:
        at = F.timestamp_millis(F.lit(start))
        coarse = [F.date_trunc(g, at).cast("date") for g in ("month", "year")]
        keep = (F.col(part) >= at.cast("date")) | (F.col(part) == coarse[0]) | (F.col(part) == coarse[1])
    if end is not None:
        keep = keep & (F.col(part) <= F.timestamp_millis(F.lit(end)).cast("date"))
    return keep
