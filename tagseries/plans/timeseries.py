"""One request, one plan: all options of a time-series query composed in order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import VALUE_COLUMN, tag_value
from ..operators.aggregate import aggregate_series, aggregate_with_arguments
from ..operators.ordered import only_changes
from ..operators.raw import by_tags, limited, ordered, time_range, value_filter
from ..operators.registry import measurements
from ..operators.shape import align


@dataclass
class Aggregation:
    """Function by its own name (``mean``, ``min`` ... or ``percentile`` with one argument)."""

    name: str
    period: int | str | None = None
    fill: str = "none"
    arguments: Sequence[float] = ()
    fill_value: float | None = None


@dataclass
class TimeseriesRequest:
    """Options of a time-series query; everything left unset does not restrict the answer.

    Series are chosen by measurement uuid, by asset property uuid and by (database, name); the
    selections add up. ``join`` lists the series to align on equal instants, each with values of its own type.
    """

    measurement_uuids: Sequence[str] = ()
    asset_property_uuids: Sequence[str] = ()
    measurements: Sequence[tuple[str, str]] = ()
    start: int | None = None
    end: int | None = None
    tags: dict[str, str] = field(default_factory=dict)
    group_by: Sequence[str] = ()
    aggregation: Aggregation | None = None
    value_filters: Sequence[tuple] = ()
    only_changes: bool = False
    limit: int | None = None
    offset: int = 0
    desc: bool = False
    limit_scope: str = "series"
    join: Sequence[str] | None = None


def _selected(request: TimeseriesRequest, meas: DataFrame, props: DataFrame | None) -> DataFrame | None:
    """(series_name, measurement_uuid) of the chosen series, or None for all."""
    active = measurements(meas).select(
        F.col("name").alias("series_name"), F.col("uuid").alias("measurement_uuid"), "database"
    )
    chosen = F.lit(False)
    asked = False
    if request.measurement_uuids:
        chosen, asked = chosen | F.col("measurement_uuid").isin(list(request.measurement_uuids)), True
    for database, name in request.measurements:
        chosen, asked = chosen | ((F.col("database") == database) & (F.col("series_name") == name)), True
    picked = active.filter(chosen)
    if request.asset_property_uuids:
        if props is None:
            raise ValueError("a selection by asset property needs the asset properties")
        bound = props.filter(F.col("uuid").isin(list(request.asset_property_uuids))).select("measurement_uuid")
        picked = picked.unionByName(active.join(bound, "measurement_uuid", "left_semi").select(active.columns))
        asked = True
    return picked.select("series_name", "measurement_uuid").distinct() if asked else None


def query_timeseries(
    request: TimeseriesRequest, points: DataFrame, meas: DataFrame, props: DataFrame | None = None
) -> DataFrame:
    """Answer of a request as tall rows, or as one row per instant with ``join``.

    Order of work: series and time selection, tags, value filters, changes, aggregation, then
    limit and layout. Without aggregation the points come back as stored.
    """
    out = time_range(points, request.start, request.end)
    chosen = _selected(request, meas, props)
    if chosen is not None:
        out = out.join(chosen.select("series_name"), "series_name", "left_semi")
    if request.tags:
        out = by_tags(out, request.tags)
    if request.value_filters:
        out = value_filter(out, request.value_filters)
    if request.only_changes:
        out = only_changes(out)

    keys = ["series_name"]
    if request.aggregation is not None:
        if request.group_by:
            keys = list(request.group_by)
            for tag in keys:
                out = out.withColumn(tag, tag_value("tags", tag))
        out = _aggregated(out, request, keys)
    elif request.group_by:
        raise ValueError("grouping by tags needs an aggregation")

    if request.join is not None:
        typed = "value" if "value" in out.columns else _value_columns(request.join, meas)
        joined = align(out, request.join, value=typed)
        return _page(joined, request)  # one row per instant: limit and offset count instants
    if request.limit is not None or request.offset:
        if request.aggregation is not None:
            out = out.withColumn("seq", F.lit(0)).withColumn("series_name", F.concat_ws("/", *keys))
        out = limited(out, request.limit, request.offset, request.desc, request.limit_scope)
        if request.aggregation is not None:
            out = out.select(*keys, "ts_ms", "value")
    if request.desc:
        return ordered(out, desc=True, keys=keys)
    return out


def _value_columns(names: Sequence[str], meas: DataFrame) -> dict[str, str]:
    """The value column of each series of a request, by its datatype."""
    known = measurements(meas).filter(F.col("name").isin(list(names))).select("name", "datatype")
    return {r["name"]: VALUE_COLUMN[r["datatype"]] for r in known.collect() if r["datatype"] in VALUE_COLUMN}


def _page(joined: DataFrame, request: TimeseriesRequest) -> DataFrame:
    if request.limit is None and not request.offset and not request.desc:
        return joined
    out = joined.orderBy(F.desc("ts_ms") if request.desc else F.asc("ts_ms"))
    out = out.offset(request.offset) if request.offset else out
    return out if request.limit is None else out.limit(request.limit)


def _aggregated(out: DataFrame, request: TimeseriesRequest, keys: Iterable[str]) -> DataFrame:
    agg = request.aggregation
    if agg.arguments:
        return aggregate_with_arguments(
            out, agg.name, agg.arguments, agg.period, request.start, request.end, keys=list(keys)
        )
    return aggregate_series(
        out,
        agg.name,
        agg.period,
        request.start,
        request.end,
        keys=list(keys),
        fill=agg.fill,
        fill_value=agg.fill_value,
    )
