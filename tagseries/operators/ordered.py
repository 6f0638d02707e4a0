"""Order-dependent building blocks that never put a whole series into one task.

A series may hold a large share of all rows, so no window here is partitioned by the series
alone. Work is cut into (series, time chunk) cells. After ``dedupe_last_write`` a series has
at most one row per millisecond, so a cell of ``chunk_ms`` holds at most ``chunk_ms`` rows,
whatever the data look like. What crosses a chunk border travels through a summary with one
row per cell, built with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import arrival_order, bucket_start

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
SERIES_KEYS = ("series_name",)

# Width of a cell. Wider cells make the summary smaller, narrower ones bound the sorts: at one
# point per millisecond a cell of six hours holds 21.6 million rows.
CHUNK_MS = 6 * HOUR_MS

_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)

_CHUNK = "__chunk"


def dedupe_last_write(
    df: DataFrame, keys: Sequence[str] = SERIES_KEYS, order: str = "ts_ms", seq: str = "seq"
) -> DataFrame:
    """One row per (series, instant): the write with the highest arrival number.

    Either form cuts a heap of copies to one row per map task before the shuffle: rows of
    fixed-width columns go through a hash aggregate, rows with texts or maps through
    ``row_number() = 1``, which is planned with a group limit below the shuffle.
    """
    rest = [f for f in df.schema.fields if f.name not in (*keys, order, seq)]
    if all(isinstance(f.dataType, _FIXED_WIDTH) for f in rest):
        kept = [F.max_by(f.name, F.coalesce(F.col(seq), F.lit(-1))).alias(f.name) for f in rest]
        return df.groupBy(*keys, order).agg(*kept, F.max(seq).alias(seq)).select(df.columns)
    w = Window.partitionBy(*keys, order).orderBy(F.col(seq).desc_nulls_last())
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def last_writes(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by the columns ``by``; where they tie, by the value, so that a
    repeated task takes the same. Copies are cut to one per map task before the shuffle."""
    ties = [c for c in ("value_num", "value_bool", "value_str", "quality_code") if c in df.columns]
    order = [F.col(c).desc_nulls_last() for c in (*by, *ties)] or [F.lit(0)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _cells(df: DataFrame, order: str, chunk_ms: int) -> DataFrame:
    """Rows with the start of their cell. It is never NULL: a null check inferred from the join
    with the summary would reach below one input only and keep Spark from sharing its shuffle."""
    return df.withColumn(_CHUNK, F.coalesce(bucket_start(order, chunk_ms), F.lit(0)))


def _key_window(keys: Sequence[str]):
    """Window over cell summaries: one row per (series, chunk)."""
    return Window.partitionBy(*keys).orderBy(_CHUNK)


def with_neighbours(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "ts_ms",
    chunk_ms: int = CHUNK_MS,
    previous: str | None = "previous",
    following: str | None = None,
    seq: str | None = None,
) -> DataFrame:
    """Add the previous / following row of the series as a struct of ``columns``.

    With ``seq`` the rows are first reduced to the last write per instant, else (keys, order)
    must be unique. The neighbours inside a cell come from lag / lead over the cell; border
    rows read the neighbouring cell's end from the summary. The summary takes the raw rows:
    ordering them by instant and arrival finds the same ends without a dedupe shuffle.
    """
    unique = df if seq is None else dedupe_last_write(df, keys, order, seq)
    cells = _cells(unique, order, chunk_ms)
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(order)
    across = _key_window(keys)

    def end_of_cell(pick, by: Column) -> Column:
        # one aggregate per column keeps numeric buffers fixed-width (HashAggregate)
        return F.struct(*[pick(F.col(c), by).alias(c) for c in columns])

    latest = F.col(order) if seq is None else arrival_order(order, seq)
    earliest = F.col(order) if seq is None else arrival_order(order, -F.col(seq))
    row = F.struct(*columns)
    ends, carried, out = [], [], cells
    if previous:
        out = out.withColumn(previous, F.lag(row).over(inside))
        ends.append(end_of_cell(F.max_by, latest).alias("__last"))
        carried.append(F.lag("__last").over(across).alias("__before"))
    if following:
        out = out.withColumn(following, F.lead(row).over(inside))
        ends.append(end_of_cell(F.min_by, earliest).alias("__first"))
        carried.append(F.lead("__first").over(across).alias("__after"))

    border = _cells(df, order, chunk_ms).groupBy(*keys, _CHUNK).agg(*ends).select(*keys, _CHUNK, *carried)
    out = out.join(border, [*keys, _CHUNK])
    if previous:
        out = out.withColumn(previous, F.coalesce(previous, "__before")).drop("__before")
    if following:
        out = out.withColumn(following, F.coalesce(following, "__after")).drop("__after")
    return out.drop(_CHUNK)


def with_rank(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "ts_ms",
    desc: bool = False,
    chunk_ms: int = CHUNK_MS,
    name: str = "rank",
    after: int = 0,
    upto: int | None = None,
) -> DataFrame:
    """1-based position of each row in its series; needs unique (keys, order).

    Position = rows in the cells before + row number inside the cell. Only positions in
    ``after + 1 .. upto`` are returned; cells outside drop out in the join with the summary,
    before their rows are sorted.
    """
    direction = (lambda c: F.col(c).desc()) if desc else (lambda c: F.col(c).asc())
    cells = _cells(df, order, chunk_ms)
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(direction(order))
    before = (
        Window.partitionBy(*keys).orderBy(direction(_CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cells.groupBy(*keys, _CHUNK)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__skip", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .filter(F.col("__skip") + F.col("__n") > after)
    )
    if upto is not None:
        offsets = offsets.filter(F.col("__skip") < upto)
    ranked = cells.join(offsets.drop("__n"), [*keys, _CHUNK]).withColumn(
        name, (F.row_number().over(inside) + F.col("__skip")).cast("bigint")
    )
    if after:
        ranked = ranked.filter(F.col(name) > after)
    if upto is not None:
        ranked = ranked.filter(F.col(name) <= upto)
    return ranked.drop("__skip", _CHUNK)


def running_totals(
    df: DataFrame,
    totals: dict[str, str],
    keys: Sequence[str] = (),
    order: str = "ts_ms",
    chunk_ms: int = DAY_MS,
) -> DataFrame:
    """Running sums (``{output: input}``) per key in time order, cell by cell."""
    cells = _cells(df, order, chunk_ms)
    inside = (
        Window.partitionBy(*keys, _CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = _key_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    sums = cells.groupBy(*keys, _CHUNK).agg(*[F.sum(i).alias(f"__t_{o}") for o, i in totals.items()])
    carried = sums.select(
        *keys, _CHUNK, *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__t_{o}") for o in totals]
    )
    out = cells
    for o, i in totals.items():
        out = out.withColumn(f"__r_{o}", F.sum(i).over(inside))
    out = out.join(carried, [*keys, _CHUNK])
    for o in totals:
        out = out.withColumn(o, F.col(f"__r_{o}") + F.col(f"__t_{o}"))
    return out.drop(_CHUNK, *[f"__r_{o}" for o in totals], *[f"__t_{o}" for o in totals])


def changed(current: Column, previous: Column) -> Column:
    """Null-safe inequality."""
    return ~current.eqNullSafe(previous)


def only_changes(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    values: Sequence[str] = ("value_num", "value_bool", "value_str"),
    chunk_ms: int = CHUNK_MS,
    deduped: bool = False,
) -> DataFrame:
    """Points whose value differs from the one before in the series; the first is kept.

    An instant holds one value (the last write); pass ``deduped=True`` if that is given.
    """
    values = [v for v in values if v in df.columns]
    linked = with_neighbours(
        df, values, keys, chunk_ms=chunk_ms, previous="__previous", seq=None if deduped else "seq"
    )
    differs = F.lit(False)
    for v in values:
        differs = differs | changed(F.col(v), F.col(f"__previous.{v}"))
    return linked.filter(F.col("__previous").isNull() | differs).drop("__previous")


def with_position(
    df: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    desc: bool = False,
    chunk_ms: int = CHUNK_MS,
    name: str = "position",
    after: int = 0,
    upto: int | None = None,
    seq: str = "seq",
) -> DataFrame:
    """1-based position of each row in its series by (ts_ms, seq); copies of an instant are rows too.

    The instants with their numbers of rows take the place of the rows, so the cells stay bounded
    by their width; only the rows of one instant are put in order together. Only positions in
    ``after + 1 .. upto`` are returned, and instants outside drop out before any row is sorted.
    """
    direction = (lambda c: F.col(c).desc_nulls_last()) if desc else (lambda c: F.col(c).asc_nulls_first())
    instants = _cells(df.groupBy(*keys, "ts_ms").agg(F.count(F.lit(1)).alias("__n")), "ts_ms", chunk_ms)
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, _CHUNK).orderBy(direction("ts_ms")).rowsBetween(*earlier)
    across = Window.partitionBy(*keys).orderBy(direction(_CHUNK)).rowsBetween(*earlier)
    cells = instants.groupBy(*keys, _CHUNK).agg(F.sum("__n").alias("__rows"))
    cells = cells.withColumn("__skip", F.coalesce(F.sum("__rows").over(across), F.lit(0)))
    cells = cells.filter(F.col("__skip") + F.col("__rows") > after)
    if upto is not None:
        cells = cells.filter(F.col("__skip") < upto)
    placed = instants.join(cells.drop("__rows"), [*keys, _CHUNK]).withColumn(
        "__before", F.coalesce(F.sum("__n").over(inside), F.lit(0)) + F.col("__skip")
    )
    placed = placed.filter(F.col("__before") + F.col("__n") > after)
    if upto is not None:
        placed = placed.filter(F.col("__before") < upto)
    copies = Window.partitionBy(*keys, "ts_ms").orderBy(direction(seq))
    ranked = df.join(placed.select(*keys, "ts_ms", "__before"), [*keys, "ts_ms"])
    ranked = ranked.withColumn("__nth", F.row_number().over(copies))
    if upto is not None:
        ranked = ranked.filter(F.col("__nth") <= upto)  # cuts a heap of copies before the shuffle
    ranked = ranked.withColumn(name, (F.col("__before") + F.col("__nth")).cast("bigint")).filter(F.col(name) > after)
    if upto is not None:
        ranked = ranked.filter(F.col(name) <= upto)
    return ranked.drop("__before", "__nth")


def limit_per_series(
    df: DataFrame,
    n: int | None,
    offset: int = 0,
    desc: bool = False,
    keys: Sequence[str] = SERIES_KEYS,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Rows ``offset + 1 .. offset + n`` of each series by time and arrival; copies count as rows."""
    upto = None if n is None else n + offset
    out = with_position(df, keys, desc, chunk_ms, name="__position", after=offset, upto=upto)
    return out.select(df.columns)
