"""Tag-history views over the star-schema test tables.

Every view is a plan over the whole table; nothing is collected or cached.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.ids import name_uuid
from ..functions.time import check_range, to_millis
from ..functions.values import quality_to_status
from ..operators.storage import conform
from ..schema import LOG_LEVELS
from ..session import use_utc
from .tables import point_stream

COLLECTOR = "Plant"
DAY_MS = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01, first day of the events
T1 = T0 + 30 * DAY_MS


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table. Files are listed anew on every call, but the schema is read from the
    footers only once per folder, which saves a job per use."""
    path = f"{sf_dir}/{name}.parquet"
    reader = use_utc(spark).read
    if path not in _SCHEMAS:
        _SCHEMAS[path] = reader.parquet(path).schema
    return reader.schema(_SCHEMAS[path]).parquet(path)


def _within(df: DataFrame, column: str, start: int | None, end: int | None) -> DataFrame:
    """Time range on the source's own timestamp column, where the file filter can use it."""
    check_range(start, end)
    for bound, keep in ((start, Column.__ge__), (end, Column.__lt__)):
        if bound is not None:
            at = F.lit(bound * 1000).cast("bigint")
            limit = F.timestamp_micros(at).cast("timestamp_ntz")
            df = df.filter(keep(F.col(column), limit))
    return df


def event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def quality_from_k() -> Column:
    k = event_k()
    return F.when(k < 10, 0).when(k < 25, 64).otherwise(192)


def event_points(df: DataFrame, name: Column) -> DataFrame:
    """Canonical points of event rows (batch or stream)."""
    code = quality_from_k()
    tags = F.create_map(
        F.lit("type"), F.col("event_type"), F.lit("k10"), F.floor(event_k() / 10).cast("string")
    )
    return df.select(
        F.concat(F.lit("histprov:h:/sys:gw:/prov:default:/tag:"), "event_type", F.lit("/u"), "user_id").alias("qpath"),
        name.alias("series_name"),
        to_millis("ts").alias("ts_ms"),
        F.col("value").alias("value_num"),
        F.lit(None).cast("boolean").alias("value_bool"),
        F.lit(None).cast("string").alias("value_str"),
        code.alias("quality_code"),
        quality_to_status(code).alias("status"),
        tags.alias("tags"),
        F.col("event_id").alias("seq"),
    )


def user_series() -> Column:
    return F.concat(F.lit(f"{COLLECTOR}/default/"), "event_type", F.lit("/u"), "user_id")


def points(spark, sf_dir, start: int | None = None, end: int | None = None) -> DataFrame:
    """One series per (event type, user)."""
    return event_points(_within(table(spark, sf_dir, "events"), "ts", start, end), user_series())


def points_by_type(spark, sf_dir, start: int | None = None, end: int | None = None) -> DataFrame:
    """Five heavy series, one per event type."""
    name = F.concat(F.lit(f"{COLLECTOR}/type/"), "event_type")
    return event_points(_within(table(spark, sf_dir, "events"), "ts", start, end), name)


def typed(events: DataFrame, name: Column) -> DataFrame:
    """Points of event rows with values of three types: sign-ups are booleans, views texts, all else numbers."""
    rows = event_points(events.withColumn("value", event_k().cast("double")), name)
    kind, k = F.element_at("tags", "type"), F.col("value_num")
    return rows.withColumns(
        {
            "value_bool": F.when(kind == "signup", k >= 50),
            "value_str": F.when(kind == "view", F.col("status")),
            "value_num": F.when(~kind.isin("signup", "view"), k),
        }
    )


def type_series() -> Column:
    return F.concat(F.lit(f"{COLLECTOR}/type/"), "event_type")


def typed_points(spark, sf_dir) -> DataFrame:
    """The heavy series with values of three types."""
    return typed(table(spark, sf_dir, "events"), type_series())


def type_paths() -> list[str]:
    """The request path of each heavy series."""
    return [f"histprov:h:/sys:gw:/prov:type:/tag:{t}" for t in EVENT_TYPES]


def _line_points(spark, sf_dir, name: Column) -> DataFrame:
    seq = ((F.col("l_orderkey") * 16 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey")) * 10_000 + F.col(
        "l_suppkey"
    )
    return table(spark, sf_dir, "lineitem").select(
        name.alias("series_name"),
        to_millis("l_shipdate").alias("ts_ms"),
        F.col("l_extendedprice").alias("value_num"),
        seq.alias("seq"),
    )


def points_ship(spark, sf_dir) -> DataFrame:
    """Daily instants with many writes each, one series per supplier."""
    return _line_points(spark, sf_dir, F.concat(F.lit(f"{COLLECTOR}/ship/s"), "l_suppkey"))


def points_lines(spark, sf_dir) -> DataFrame:
    """Daily instants with very many writes each, one series per return flag and line status."""
    return _line_points(spark, sf_dir, F.concat(F.lit(f"{COLLECTOR}/line/"), "l_returnflag", "l_linestatus"))


def measurements_view(spark, sf_dir) -> DataFrame:
    """Registry over the (event type, user) series; the user's customer row gives the rest."""
    ev = table(spark, sf_dir, "events")
    series = ev.groupBy("event_type", "user_id").agg(
        F.min("ts").cast("timestamp").alias("created_at"),
        F.max("ts").cast("timestamp").alias("updated_at"),
        F.max_by(event_k(), "event_id").alias("last_k"),
    )
    owner = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    df = series.join(owner, series.user_id == owner.c_custkey)
    name = user_series()
    kind = F.col("event_type")
    other = lambda t: F.concat(F.lit(f"{COLLECTOR}/default/{t}/u"), "user_id")
    return df.select(
        name_uuid(name).alias("uuid"),
        name.alias("name"),
        F.when(F.col("c_acctbal") < 0, "deleted")
        .when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"), "Active")
        .otherwise("active")
        .alias("status"),
        F.lit("number").alias("datatype"),
        F.concat(F.lit("db_"), F.lower("c_mktsegment")).alias("database"),
        F.concat(F.lit("collector-"), "c_nationkey").alias("collector_uuid"),
        F.array("c_mktsegment", "event_type").alias("labels"),
        quality_to_status(F.when(F.col("last_k") < 10, 0).when(F.col("last_k") < 25, 64).otherwise(192)).alias(
            "quality"
        ),
        "created_at",
        "updated_at",
        F.lit(None).cast("string").alias("description"),
        F.create_map(F.lit("segment"), "c_mktsegment").alias("attributes"),
        F.lit(None).cast("map<string,string>").alias("settings"),
        (kind == "purchase").alias("is_calculation"),
        F.when(kind == "purchase", F.array(other("click"), other("view"))).alias("depends_on"),
        F.struct(
            F.when(kind == "click", "count").when(kind == "view", "s").when(kind == "purchase", "EUR").alias("uom"),
            F.when(kind != "error", F.lit(0.0)).alias("value_min"),
            F.when(kind == "purchase", F.lit(1000.0)).alias("value_max"),
            F.when(kind == "view", F.lit(0.5)).alias("limit_lo"),
            F.when(kind.isin("view", "purchase"), F.lit(250.0)).alias("limit_hi"),
        ).alias("specs"),
    )


def measurement_keys(spark, sf_dir) -> DataFrame:
    """One request path per event series, storage form, active or not."""
    return (
        table(spark, sf_dir, "events")
        .select(
            F.concat(F.lit("histprov:h:/sys:gw:/prov:default:/tag:"), "event_type", F.lit("/u"), "user_id").alias(
                "qpath"
            )
        )
        .distinct()
    )


def asset_keys(spark, sf_dir) -> DataFrame:
    """One browse-form request path per supplier asset."""
    a = assets_view(spark, sf_dir).filter(F.col("uuid").startswith("s"))
    return a.select(F.concat(F.lit("histprov:h:/tag:Assets/"), "name").alias("qpath"))


def assets_view(spark, sf_dir) -> DataFrame:
    """Regions, their nations and the nations' suppliers as one tree."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    placed = nation.join(region, nation.n_regionkey == region.r_regionkey)
    bound = supplier.join(placed, supplier.s_nationkey == placed.n_nationkey)

    def rows(df, uuid, name, parent):
        return df.select(
            uuid.alias("uuid"),
            name.alias("name"),
            F.lit("").alias("description"),
            parent.alias("parent_uuid"),
            name.alias("asset_path"),
            F.lit(None).cast("map<string,string>").alias("attributes"),
            F.lit(None).cast("map<string,string>").alias("metadata"),
            F.lit(None).cast("timestamp").alias("created_at"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )

    r_id = F.concat(F.lit("r"), F.col("r_regionkey"))
    n_id = F.concat(F.lit("n"), F.col("n_nationkey"))
    s_id = F.concat(F.lit("s"), F.col("s_suppkey"))
    top = rows(region, r_id, F.col("r_name"), F.lit(None).cast("string"))
    middle = rows(placed, n_id, F.concat_ws("/", "r_name", "n_name"), r_id)
    leaf = rows(bound, s_id, F.concat_ws("/", "r_name", "n_name", "s_name"), n_id)
    return top.unionByName(middle).unionByName(leaf)


def properties_view(spark, sf_dir) -> DataFrame:
    """Each supplier asset bound to the event series of the user with the same number."""
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    name = F.concat(F.lit(f"{COLLECTOR}/default/"), "t", F.lit("/u"), "s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", F.explode(types).alias("t"))
        .select(
            F.concat(F.lit("p"), "s_suppkey", F.lit("-"), "t").alias("uuid"),
            F.concat(F.lit("s"), "s_suppkey").alias("asset_uuid"),
            name_uuid(name).alias("measurement_uuid"),
            name.alias("series_name"),
            F.col("t").alias("name"),
            F.lit("number").alias("datatype"),
        )
    )


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def collectors_view(spark, sf_dir) -> DataFrame:
    """Suppliers as collectors."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("uuid"),
        F.lit("gateway").alias("type"),
        F.col("s_name").alias("description"),
        F.when(F.col("s_acctbal") < 0, "inactive").otherwise("active").alias("status"),
    )


def databases_view(spark, sf_dir) -> DataFrame:
    """Regions as time-series databases."""
    return table(spark, sf_dir, "region").select(
        F.concat(F.lit("db"), "r_regionkey").alias("uuid"), F.col("r_name").alias("name")
    )


def event_operations(df: DataFrame) -> DataFrame:
    """Operation log rows of event rows (batch or stream)."""
    kind = F.col("event_type")
    return df.select(
        to_millis("ts").alias("ts_ms"),
        F.when(kind == "view", "raw").when(kind == "purchase", "agg").otherwise("store").alias("op"),
        event_k().cast("bigint").alias("row_count"),
        F.round(F.col("value") * 100).cast("bigint").alias("elapsed_ms"),
        (kind == "error").alias("is_error"),
    )


def op_log(spark, sf_dir) -> DataFrame:
    return event_operations(table(spark, sf_dir, "events"))


def statistics_view(spark, sf_dir) -> DataFrame:
    """Running counters, one collector per event type."""
    n = F.col("event_id")
    bad = F.floor(n / 10).cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("c-"), "event_type").alias("collector_uuid"),
        to_millis("ts").alias("ts_ms"),
        (n * 3).alias("points_sent"),
        (n * 3 - bad).alias("good_points"),
        bad.alias("bad_points"),
        event_k().cast("bigint").alias("buffer_size"),
        F.floor(n / 50).cast("bigint").alias("buffer_disk_flushes"),
        F.floor(n / 500).cast("bigint").alias("buffer_error_files"),
    )


def event_logs(df: DataFrame) -> DataFrame:
    """One log entry per event row (batch or stream); the level follows the event's k."""
    levels = F.array(*[F.lit(x) for x in LOG_LEVELS])
    return df.select(
        F.concat(F.lit("c-"), "event_type").alias("collector_uuid"),
        to_millis("ts").alias("ts_ms"),
        F.get(levels, F.pmod(event_k(), F.lit(len(LOG_LEVELS)))).alias("level"),
        F.lit(None).cast("string").alias("measurement_uuid"),
        F.col("props").alias("message"),
    )


def logs_view(spark, sf_dir) -> DataFrame:
    return event_logs(table(spark, sf_dir, "events"))


def event_stream(spark, sf_dir) -> DataFrame:
    """The events table as a stream. A stream source wants a folder or a pattern; the pattern
    serves a single file as well as a folder of that name."""
    schema = table(spark, sf_dir, "events").schema
    return point_stream(spark, f"{sf_dir}/events.parque[t]", schema)


def stream_user_points(spark, sf_dir) -> DataFrame:
    return conform(event_points(event_stream(spark, sf_dir), user_series()))
