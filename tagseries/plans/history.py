"""The scripting interface: paths and epoch milliseconds in, DataFrames out."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.aggregates import supported_aggregates
from ..functions.ids import name_uuid
from ..functions.paths import folder_prefix, stored_path
from ..functions.time import period_for_buckets, relative_range
from ..functions.values import BOOLEAN, GOOD_CODE, NUMBER, STRING, VALUE_COLUMN, has_value
from ..operators.aggregate import aggregate, last_values
from ..operators.browse import browse
from ..operators.metadata import merge_metadata
from ..operators.raw import assume_good, by_uuid, concat_series, first_from, latest, raw_points, restrict
from ..operators.registry import DELETED, EVICTED, created_series, infer_datatype, met_series, onboard
from ..operators.resolve import (
    lookup_nodes,
    missing_keys,
    named_keys,
    query_metadata,
    resolve_keys,
    with_asset_series,
)
from ..operators.shape import check_format, wide
from ..operators.storage import (
    compact_points,
    named_points,
    path_names,
    read_points,
    write_by_path,
    write_points,
    write_requested,
)
from ..schema import ASSETS
from ..session import written
from ..sources.ingest import from_parallel_arrays, from_tag_matrix
from ..sources.tables import (
    compact_registry,
    consume_metadata,
    metadata_reader,
    registry_reader,
    retire_stored,
    write_metadata,
    write_registry,
)

# Gap treatment by fill mode name; DERIVED leaves empty buckets out.
FILL_MODES = {"DERIVED": "none", "NONE": "none", "NULL": "null", "PREVIOUS": "previous", "LINEAR": "linear"}
#: Paths of a batch up to which their names and series are broadcast, some 150 MB.
FEW_PATHS = 1_000_000
DEFAULT_AGGREGATE, LAST_VALUE = "Average", "LastValue"


def _fill_type(mode: str) -> str:
    if mode.upper() not in FILL_MODES:
        raise ValueError(f"unknown fill mode: {mode}")
    return FILL_MODES[mode.upper()]


class TagHistory:
    """Tag history over a point table, a registry and an asset catalogue.

    The request (paths, aggregates, aliases) is a list of the caller's; resolving it brings back
    one row per path. Everything that grows with the data stays a DataFrame. With ``stored`` the
    points carry their measurement uuid, as the point table does, and the resolved uuids are
    pushed into its files. With the asset properties ``props`` the path of an asset answers with the
    series behind its properties; without them it names no points.

    Values keep the type of their series: a wide column has it, a tall row holds its value in
    ``value`` (number), ``value_bool`` or ``value_str``.
    """

    def __init__(
        self,
        points: DataFrame,
        meas: DataFrame,
        assets: DataFrame,
        collector: str,
        stored: bool = False,
        props: DataFrame | None = None,
    ):
        self.points = points
        self.stored = stored
        self.props = props
        self.meas = meas
        self.assets = assets
        self.collector = collector
        self.spark: SparkSession = points.sparkSession

    def _keys(self, paths: Sequence[str]) -> DataFrame:
        distinct = [(p,) for p in dict.fromkeys(paths)]
        return self.spark.createDataFrame(distinct, "qpath string")

    def _resolved(self, paths: Sequence[str]) -> DataFrame:
        """Known paths with series, uuid, datatype and property, as a local table of one row per path or,
        for an asset, per property."""
        found = resolve_keys(self._keys(paths), self.meas, self.assets, self.collector)
        if self.props is not None:
            found = with_asset_series(found, self.props, self.meas)
        else:
            found = found.withColumn("property", F.lit(None).cast("string"))
        known = found.filter(F.col("measurement_uuid").isNotNull()).select(
            "qpath", "series_name", "measurement_uuid", "datatype", "property"
        )
        return self.spark.createDataFrame(known.collect(), known.schema)

    def _columns(self, keys: DataFrame, paths: Sequence[str], shown: Sequence[str]) -> list[tuple]:
        """(path, series, column, value column, number of the path) of a wide answer: one per path, and one per
        property, named ``column/property``, for an asset with several."""
        if len(shown) != len(paths):
            raise ValueError("one column name per path is needed")
        series: dict[str, list] = {}
        for r in keys.collect():
            series.setdefault(r["qpath"], []).append((r["property"] or "", r["series_name"], r["datatype"]))
        out = []
        for i, (path, name) in enumerate(zip(paths, shown)):
            own = sorted(series.get(path, [("", "", None)]))
            for prop, stored, datatype in own:
                column = name if len(own) == 1 else f"{name}/{prop}"
                out.append((path, stored, column, VALUE_COLUMN.get(datatype, "value_num"), i))
        return out

    def _scope(self, keys: DataFrame) -> DataFrame:
        """Points the keys may need: the files' own uuid filter for a stored table."""
        if not self.stored:
            return self.points
        return by_uuid(self.points, sorted({r["measurement_uuid"] for r in keys.collect()}))

    def query_raw_points(
        self,
        paths: Sequence[str],
        start: int | None = None,
        end: int | None = None,
        column_names: Sequence[str] | None = None,
        return_format: str = "WIDE",
        return_size: int | None = None,
        include_bounds: bool = False,
        exclude_observations: bool = False,
    ) -> DataFrame:
        """Raw points of the paths, wide (``t_stamp`` and a column per path) or tall.

        ``return_size`` keeps the first rows in time order. Unknown paths give an empty column
        in the wide form; ``missing`` lists them.
        """
        layout = check_format(return_format)
        if exclude_observations:
            raise ValueError("points carry no sample origin, so observations cannot be excluded")
        keys = self._resolved(paths)
        columns = self._columns(keys, paths, column_names or paths)
        pts = self._scope(keys)
        rows = raw_points(pts, keys, start, end)
        if include_bounds:
            if start is None or end is None:
                raise ValueError("bounding values need a start and an end")
            every = assume_good(restrict(pts, keys))
            by_path = ("qpath", "series_name", "measurement_uuid")
            rows = concat_series(rows, latest(every, start, by_path), first_from(every, end, by_path))
        if layout == "TALL":
            value = F.col("value_num").alias("value")
            out = rows.select("qpath", "series_name", "ts_ms", value, "value_bool", "value_str", "seq")
            order = ("ts_ms", "qpath", "series_name", "seq")
        else:
            keyed = rows.withColumn("__column", F.concat_ws("\n", "qpath", "series_name"))
            names = [f"{path}\n{series}" for path, series, *_ in columns]
            types = {name: c[3] for name, c in zip(names, columns)}
            out = wide(keyed, names, [c[2] for c in columns], value=types, key="__column")
            order = ("t_stamp",)
        return out if return_size is None else out.orderBy(*order).limit(return_size)

    def query_aggregated_points(
        self,
        paths: Sequence[str],
        start: int,
        end: int,
        aggregates: Sequence[str] | None = None,
        fill_modes: Sequence[str] | None = None,
        column_names: Sequence[str] | None = None,
        return_format: str = "WIDE",
        return_size: int = 100,
        period: int | str | None = None,
        include_bounds: bool = False,
        exclude_observations: bool = False,
    ) -> DataFrame:
        """One aggregate per path in ``return_size`` buckets over the range (or by ``period``).

        A single aggregate or fill mode counts for all paths. Paths of one fill mode share a scan.
        LastValue answers boolean and text series too; their gaps are left out in every fill mode.
        """
        layout = check_format(return_format)
        if include_bounds or exclude_observations:
            raise ValueError("buckets have no bounding values, and points carry no sample origin")
        names = self._per_path(paths, aggregates, DEFAULT_AGGREGATE)
        modes = [_fill_type(m) for m in self._per_path(paths, fill_modes, "DERIVED")]
        width = period if period is not None else period_for_buckets(start, end, return_size)
        keys = self._resolved(paths)
        pts = self._scope(keys)
        parts = []
        for mode in dict.fromkeys(modes):
            asked = [(p, n) for p, n, m in zip(paths, names, modes) if m == mode]
            requests = self.spark.createDataFrame(list(dict.fromkeys(asked)), "qpath string, aggregate string")
            requests = requests.join(keys.select("qpath", "series_name"), "qpath")
            parts.append(
                aggregate(pts, requests, width, start, end, fill=mode, aggregates={n for _, n in asked})
            )
        shown = column_names or [p if paths.count(p) == 1 else f"{p}/{n}" for p, n in zip(paths, names)]
        columns = self._columns(keys, paths, shown)
        rows = concat_series(*parts).withColumns(
            {c: F.lit(None).cast(t) for c, t in (("value_bool", "boolean"), ("value_str", "string"))}
        )
        other = [(p, s) for p, s, _, value, i in columns if names[i] == LAST_VALUE and value != "value_num"]
        if other:
            typed = self.spark.createDataFrame(list(dict.fromkeys(other)), "qpath string, series_name string")
            typed = typed.withColumn("aggregate", F.lit(LAST_VALUE))
            rows = rows.unionByName(last_values(pts, typed, width, start, end).select(rows.columns))
        if layout == "TALL":
            return rows
        keyed = rows.withColumn("__column", F.concat_ws("\n", "qpath", "series_name", "aggregate"))
        wanted = [f"{path}\n{series}\n{names[i]}" for path, series, _, _, i in columns]
        types = {
            w: value if names[i] == LAST_VALUE and value != "value_num" else "value"
            for w, (_, _, _, value, i) in zip(wanted, columns)
        }
        return wide(keyed, wanted, [c[2] for c in columns], value=types, key="__column")

    def _per_path(self, paths: Sequence[str], given: Sequence[str] | None, default: str) -> list[str]:
        values = list(given) if given else [default]
        if len(values) == 1:
            values = values * len(paths)
        if len(values) != len(paths):
            raise ValueError("one entry per path is needed")
        return values

    def query_last(self, paths: Sequence[str], now: int, minutes: int = 0, hours: int = 0, **options) -> DataFrame:
        """Raw points of the last minutes / hours before ``now``."""
        start, end = relative_range(now, minutes, hours)
        return self.query_raw_points(paths, start, end, **options)

    def query_metadata(self, paths: Sequence[str]) -> DataFrame:
        return query_metadata(self._keys(paths), self.meas, self.collector)

    def nodes(self, paths: Sequence[str]) -> DataFrame:
        return lookup_nodes(self._keys(paths), self.meas, self.assets, self.collector)

    def missing(self, paths: Sequence[str]) -> DataFrame:
        return missing_keys(self._keys(paths), self.meas, self.assets, self.collector)

    def browse(self, root_path: str = "", name_filters: Sequence[str] | None = None) -> DataFrame:
        """Nodes below a qualified path with ``folder:`` components."""
        one = self.spark.range(1).select(folder_prefix(F.lit(root_path)).alias("prefix"))
        return browse(self.meas, self.assets, one.first()["prefix"], name_filters)

    def aggregates(self) -> DataFrame:
        return supported_aggregates(self.spark)


class TagStore:
    """Registry, point table and pending metadata below one folder, written from scripts.

    Each call is one batch; a caller that repeats a call after a failure passes the same
    ``batch`` again and stores nothing twice.
    """

    def __init__(self, spark: SparkSession, folder: str, collector: str, grain: str = "day"):
        self.spark = spark
        self.collector = collector
        self.grain = grain
        self.registry, self.points, self.metadata = (f"{folder}/{x}" for x in ("registry", "points", "metadata"))
        # creates the folder; rows already there stay
        self._append_metadata([], "base")

    def store_data_points(
        self,
        paths: Sequence[str],
        values: Sequence,
        timestamps: Sequence[int],
        qualities: Sequence[int] | None = None,
        batch: str | None = None,
    ) -> None:
        """One point per entry of the parallel lists; values are booleans, numbers or texts."""
        codes = qualities if qualities is not None else [None] * len(paths)
        if not len(paths) == len(values) == len(timestamps) == len(codes):
            raise ValueError("paths, values, timestamps and qualities need the same length")
        arrival = time.time_ns() // 1000
        rows = [
            (p, int(t), *_typed(v), q, arrival + i)
            for i, (p, v, t, q) in enumerate(zip(paths, values, timestamps, codes))
        ]
        self.store(self.spark.createDataFrame(rows, _POINT_ROWS), batch)

    def store_tag_history(
        self,
        paths: Sequence[str],
        values: Sequence[Sequence],
        timestamps: Sequence[int],
        qualities: Sequence[int] | None = None,
        tag_provider: str = "default",
        batch: str | None = None,
    ) -> None:
        """Tag-major values (``values[tag][instant]``) of bare tag paths; qualities per instant."""
        codes = list(qualities) if qualities is not None else [GOOD_CODE] * len(timestamps)
        cells = [
            (f"prov:{tag_provider}:/tag:{p}", v, t, q)
            for p, series in zip(paths, values, strict=True)
            for v, t, q in zip(series, timestamps, codes, strict=True)
        ]
        self.store_data_points(*(list(x) for x in zip(*cells)), batch=batch)

    def store(self, points: DataFrame, batch: str | None = None) -> None:
        """Points of a DataFrame with ``qpath``, ``ts_ms``, value columns, ``quality_code`` and ``seq``."""
        name = batch or uuid.uuid4().hex
        named = named_points(points, self.collector, path_names(points, self.collector))
        store_points(named, self.registry, self.points, name, grain=self.grain, metadata=self.metadata)

    def store_metadata(
        self, paths: Sequence[str], properties: dict | Sequence[dict], batch: str | None = None
    ) -> None:
        """Properties for all paths, kept until their series are created. A list of maps is merged,
        later ones win; NULL values are dropped."""
        maps = [properties] if isinstance(properties, dict) else [p for p in properties if isinstance(p, dict)]
        merged = {k: str(v) for p in maps for k, v in p.items() if v is not None}
        arrival = time.time_ns() // 1000
        self._append_metadata([(p, merged, arrival) for p in paths], batch or uuid.uuid4().hex)

    def _append_metadata(self, rows: list, batch: str) -> None:
        df = self.spark.createDataFrame(rows, "qpath string, properties map<string,string>, seq bigint")
        named = named_keys(df, self.collector).withColumn("tag_path", F.col("series_name"))
        write_metadata(named, self.metadata, batch)

    def pending(self) -> DataFrame:
        """Property maps that no series has taken yet, by stored name."""
        return metadata_reader(self.spark, self.metadata)

    def evict(self, uuids: Sequence[str], batch: str | None = None) -> None:
        """Forget series that the store rejected; their next points create them anew."""
        self._retire(uuids, EVICTED, batch)

    def delete(self, uuids: Sequence[str], batch: str | None = None) -> None:
        """Mark series as deleted; their points stay."""
        self._retire(uuids, DELETED, batch)

    def _retire(self, uuids: Sequence[str], status: str, batch: str | None) -> None:
        rejected = self.spark.createDataFrame([(u,) for u in uuids], "uuid string")
        retire_stored(self.spark, self.registry, rejected, batch or uuid.uuid4().hex, status)

    def compact(self, before: str | None = None) -> list[str]:
        """Merge the batches of every day before a date and those of the registry; readers go on as if
        nothing had happened."""
        compact_registry(self.spark, self.registry)
        return compact_points(self.spark, self.points, before)

    def history(self, assets: DataFrame | None = None, props: DataFrame | None = None) -> TagHistory:
        """Reader of what is stored now, one value per series and instant."""
        things = assets if assets is not None else self.spark.createDataFrame([], ASSETS)
        points = read_points(self.spark, self.points)
        meas = registry_reader(self.spark, self.registry)
        return TagHistory(points, meas, things, self.collector, stored=True, props=props)


_POINT_ROWS = (
    "qpath string, ts_ms bigint, value_num double, value_bool boolean, value_str string, quality_code int, seq bigint"
)


def _typed(value) -> tuple[float | None, bool | None, str | None]:
    """Value in the column of its type."""
    if isinstance(value, bool):
        return None, value, None
    if isinstance(value, (int, float)):
        return float(value), None, None
    return None, None, None if value is None else str(value)


def store_points(
    points: DataFrame,
    registry: str,
    path: str,
    batch: str,
    meta: DataFrame | None = None,
    grain: str = "day",
    every_write: bool = False,
    metadata: str | None = None,
) -> None:
    """Create the missing series of named points, then append the points, one per instant unless ``every_write``.

    New series take the pending properties in ``meta``, or those that wait in the folder ``metadata`` and then
    no longer do.
    """
    spark = points.sparkSession
    if metadata is not None:
        meta = metadata_reader(spark, metadata, skip_batch=batch)
    created = onboard(points, registry_reader(spark, registry, skip_batch=batch), meta)
    write_registry(created, registry, batch)
    if metadata is not None:
        consume_metadata(spark, metadata, registry, batch)
    write_points(points, registry_reader(spark, registry), path, batch, grain, every_write=every_write)


def _ids_taken(met: DataFrame, before: DataFrame) -> bool:
    """Whether a new series gets the id that a series of another name has."""
    others = before.filter(F.col("uuid") != F.coalesce(name_uuid("name"), F.lit(""))).select("uuid").distinct()
    new = met.filter("known IS NULL").select(name_uuid("series_name").alias("uuid"))
    return not others.isEmpty() and not new.join(others, "uuid", "left_semi").isEmpty()


def store_requests(
    requests: DataFrame,
    form: str,
    registry: str,
    path: str,
    batch: str,
    collector: str,
    meta: DataFrame | None = None,
    grain: str = "day",
    every_write: bool = False,
) -> None:
    """Store a DataFrame of requests (``matrix`` or ``arrays`` form) into the point table.

    New series are created first; pending metadata is applied to them. Of the points of one instant the
    one of the highest ``seq`` stays, in a request the last; ``every_write`` keeps all.
    """
    forms = {"matrix": from_tag_matrix, "arrays": from_parallel_arrays}
    if form not in forms:
        raise ValueError(f"unknown request form: {form}")
    rows = forms[form](requests)
    rows = rows.withColumn("seq", F.col("seq") if "seq" in requests.columns else F.lit(0))
    if "variant" in requests.schema["values"].dataType.simpleString():  # a series may get values of several types
        points = named_points(rows, collector, path_names(rows, collector))
        return store_points(points, registry, path, batch, meta, grain, every_write)
    spark, rows = requests.sparkSession, rows.filter(has_value())  # nothing else is stored or refused
    before = registry_reader(spark, registry, skip_batch=batch)
    paths, few = None, rows.agg(F.approx_count_distinct("qpath")).first()[0] <= FEW_PATHS
    if few:  # requests are taken apart once, and what depends on a path is worked out once per path
        rows = written(rows)
        paths = written(_paths(rows, collector))
        of = paths.groupBy("series_name")
        inferred = of.agg(F.max("datatype").alias("datatype"), F.min("first_ms").alias("first_ms"))
    else:  # a table of paths would be as long as the points
        inferred = infer_datatype(named_points(rows, collector))
    met = written(met_series(inferred, before))
    write_registry(created_series(met, meta), registry, batch)
    if _ids_taken(met, before):
        points = named_points(rows, collector)
        write_points(points, registry_reader(spark, registry), path, batch, grain, every_write=every_write)
    elif few:
        ids = F.when(F.col("known"), F.col("uuid")).otherwise(name_uuid("series_name")).alias("uuid")
        listed = paths.join(met.select("series_name", ids, "known_type"), "series_name", "left")
        odd = F.col("uuid").isNull() | (F.col("points") > F.col("timed")) | (F.col("kind") != F.col("known_type"))
        refused = not listed.filter(odd).isEmpty()
        largest = paths.groupBy("series_name").agg(F.sum("points").alias("n")).agg(F.max("n")).first()[0] or 0
        listed = listed.select("qpath", "series_name", "uuid", "known_type")
        write_by_path(rows, listed, path, batch, grain, every_write, largest, refused)
    else:
        known = written(met.filter("known").select("series_name", "uuid", "known_type"))
        write_requested(named_points(rows, collector), known, path, batch, grain, every_write)


def _paths(rows: DataFrame, collector: str) -> DataFrame:
    """The paths of points of one datatype: ``series_name``, numbers of all ``points`` and of those ``timed``, their
    ``kind`` and, as ``infer_datatype`` has them, ``datatype`` and ``first_ms``."""
    found = rows.groupBy("qpath").agg(
        F.count("*").alias("points"),
        F.count("ts_ms").alias("timed"),
        F.min("ts_ms").alias("first_ms"),
        F.count("value_bool").alias("__bool"),
        F.count("value_num").alias("__num"),
    )
    kind = F.when(F.col("__bool") > 0, BOOLEAN).when(F.col("__num") > 0, NUMBER).otherwise(STRING)
    name = F.coalesce(stored_path("qpath", collector), F.lit("")).alias("series_name")
    datatype = F.when(F.col("timed") > 0, kind).alias("datatype")
    return found.select("qpath", name, "points", "timed", kind.alias("kind"), datatype, "first_ms")


def pending_metadata(requests: DataFrame, collector: str) -> DataFrame:
    """Pending property maps of (qpath, properties, seq) requests by stored name."""
    named = named_keys(requests, collector)
    return merge_metadata(named.select(F.col("series_name").alias("tag_path"), "properties", "seq"))
