"""Registered queries: scalars, registry, metadata, browse and assets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, paths, time, values
from ..functions.aggregates import aggregate_function, supported_aggregates
from ..operators import assets as asset_ops
from ..operators import browse as tree
from ..operators import registry as reg
from ..operators import resolve
from ..operators.metadata import merge_metadata
from ..sources import testbed as tb
from .registered import ASSETS, K, MEASUREMENTS, POINTS, PROPERTIES, register, sql_uuid


def event_paths(spark, sf):
    """One path per event; the form depends on the event type."""
    kind, user = F.col("event_type"), F.concat(F.lit("u"), "user_id")
    path = (
        F.when(kind == "click", F.concat(F.lit("histprov:h:/sys:gw:/prov:default:/tag:click/"), user))
        .when(kind == "view", F.concat(F.lit("histprov:h:/folder:Measurements:/folder:Plant:/folder:view:/tag:"), user))
        .when(kind == "error", F.concat(F.lit("histprov:h:/tag:Assets/Line/"), user))
        .when(kind == "purchase", F.concat(F.lit("histprov:h:/folder:MeasurementsX/P:/tag:"), user))
        .otherwise(F.concat(F.lit("folder:A/folder:"), user, F.lit(":/tag:x")))
    )
    return tb.table(spark, sf, "events").select("event_id", path.alias("qpath"))


_PATH = """CASE event_type WHEN 'click' THEN concat('histprov:h:/sys:gw:/prov:default:/tag:click/u', user_id)
  WHEN 'view' THEN concat('histprov:h:/folder:Measurements:/folder:Plant:/folder:view:/tag:u', user_id)
  WHEN 'error' THEN concat('histprov:h:/tag:Assets/Line/u', user_id)
  WHEN 'purchase' THEN concat('histprov:h:/folder:MeasurementsX/P:/tag:u', user_id)
  ELSE concat('folder:A/folder:u', user_id, ':/tag:x') END"""


@register(
    "path_normalize",
    f"""SELECT event_id, {_PATH} AS qpath, CASE event_type WHEN 'click' THEN concat('Plant/default/click/u', user_id)
    WHEN 'view' THEN concat('Plant/view/u', user_id) WHEN 'error' THEN concat('Line/u', user_id)
    WHEN 'purchase' THEN concat('MeasurementsX/P/u', user_id)
    ELSE concat('A/folder:u', user_id, '/u', user_id, '/x') END AS stored FROM events""",
)
def path_normalize(spark, sf):
    return event_paths(spark, sf).withColumn("stored", paths.stored_path("qpath", tb.COLLECTOR))


@register(
    "path_components",
    f"""SELECT event_id, CASE WHEN event_type = 'click' THEN 'gw' END AS sys,
    CASE WHEN event_type = 'click' THEN 'default' END AS prov,
    CASE event_type WHEN 'click' THEN concat('click/u', user_id) WHEN 'error' THEN concat('Assets/Line/u', user_id)
      WHEN 'signup' THEN 'x' ELSE concat('u', user_id) END AS tag,
    CASE event_type WHEN 'view' THEN 'Measurements/Plant/view/' WHEN 'purchase' THEN 'MeasurementsX/P/'
      WHEN 'signup' THEN concat('A/folder:u', user_id, '/u', user_id, '/') ELSE '' END AS folders
    FROM events""",
)
def path_components(spark, sf):
    return event_paths(spark, sf).select(
        "event_id",
        paths.extract_component("qpath", "sys:").alias("sys"),
        paths.extract_component("qpath", "prov:").alias("prov"),
        paths.extract_component("qpath", "tag:").alias("tag"),
        paths.folder_prefix("qpath").alias("folders"),
    )


@register(
    "path_category",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'Measurements' WHEN 'error' THEN 'Assets' END AS category,
    CASE event_type WHEN 'view' THEN 'Plant/view/' WHEN 'error' THEN concat('Line/u', user_id)
      WHEN 'click' THEN concat('click/u', user_id) WHEN 'purchase' THEN 'MeasurementsX/P/'
      ELSE concat('A/folder:u', user_id, '/u', user_id, '/') END AS stripped FROM events""",
)
def path_category(spark, sf):
    folders = paths.folder_prefix("qpath")
    shown = F.when(folders != "", folders).otherwise(paths.extract_component("qpath", "tag:"))
    return event_paths(spark, sf).select(
        "event_id", paths.extract_category(shown).alias("category"), paths.strip_category(shown).alias("stripped")
    )


@register(
    "quality_map",
    f"""SELECT event_id, {K} * 3 AS code, CASE WHEN {K} * 3 >= 192 THEN 'Good' WHEN {K} * 3 >= 64 THEN 'Uncertain'
    ELSE 'Bad' END AS status, CASE WHEN {K} * 3 >= 192 THEN 192 WHEN {K} * 3 >= 64 THEN 64 ELSE 0 END AS back
    FROM events""",
)
def quality_map(spark, sf):
    code = tb.event_k() * 3
    status = values.quality_to_status(code)
    return tb.table(spark, sf, "events").select(
        "event_id", code.alias("code"), status.alias("status"), values.status_to_quality(status).alias("back")
    )


@register(
    "datatype_map",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN 'boolean' WHEN 'view' THEN 'string' WHEN 'error' THEN NULL
    ELSE 'number' END AS datatype, CASE event_type WHEN 'signup' THEN 'Boolean' WHEN 'view' THEN 'String'
    ELSE 'Float8' END AS shown FROM events""",
)
def datatype_map(spark, sf):
    kind = F.col("event_type")
    typed = tb.table(spark, sf, "events").select(
        "event_id",
        F.when(kind.isin("click", "purchase"), F.col("value")).alias("value_num"),
        F.when(kind == "signup", F.col("value") > 10).alias("value_bool"),
        F.when(kind == "view", F.col("props")).alias("value_str"),
    )
    datatype = values.datatype_of()
    return typed.select("event_id", datatype.alias("datatype"), values.value_type(datatype).alias("shown"))


@register(
    "period_format",
    """WITH s AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) - 100 AS s FROM events)
    SELECT event_id, CASE WHEN s <= 0 THEN '1m' ELSE concat(
      CASE WHEN s // 3600 > 0 THEN concat(s // 3600, 'h') ELSE '' END,
      CASE WHEN s % 3600 // 60 > 0 THEN concat(s % 3600 // 60, 'm') ELSE '' END,
      CASE WHEN s % 60 > 0 THEN concat(s % 60, 's') ELSE '' END) END AS period,
      CASE WHEN s <= 0 THEN 60 ELSE s END AS seconds FROM s""",
)
def period_format(spark, sf):
    seconds = F.round(F.col("value") * 100).cast("bigint") - 100
    text = time.format_period(seconds)
    return tb.table(spark, sf, "events").select(
        "event_id", text.alias("period"), time.parse_period(text).alias("seconds")
    )


@register(
    "node_id",
    f"""SELECT event_id, {sql_uuid("concat('Plant/', event_type, '/', event_id)")} AS node_id FROM events""",
)
def node_id(spark, sf):
    name = F.concat(F.lit("Plant/"), "event_type", F.lit("/"), "event_id")
    return tb.table(spark, sf, "events").select("event_id", ids.node_id(name).alias("node_id"))


@register(
    "aggregate_names",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'Average' WHEN 'view' THEN 'Range' WHEN 'purchase' THEN 'StdDev'
    WHEN 'signup' THEN 'LastValue' ELSE 'error' END AS aggregate,
    CASE event_type WHEN 'view' THEN 'spread' WHEN 'purchase' THEN 'stddev' WHEN 'signup' THEN 'last'
    ELSE 'mean' END AS function, event_type <> 'error' AS supported FROM events""",
)
def aggregate_names(spark, sf):
    kind = F.col("event_type")
    name = (
        F.when(kind == "click", "Average")
        .when(kind == "view", "Range")
        .when(kind == "purchase", "StdDev")
        .when(kind == "signup", "LastValue")
        .otherwise(kind)
    )
    asked = tb.table(spark, sf, "events").select("event_id", name.alias("aggregate"))
    listed = supported_aggregates(spark).select("aggregate", F.lit(True).alias("supported"))
    return asked.join(listed, "aggregate", "left").select(
        "event_id",
        "aggregate",
        aggregate_function("aggregate").alias("function"),
        F.coalesce("supported", F.lit(False)).alias("supported"),
    )


@register(
    "registry_active",
    f"""WITH {MEASUREMENTS} SELECT uuid, name, status, datatype, epoch_us(created_at) // 1000 AS created_ms,
    epoch_us(updated_at) // 1000 AS updated_ms FROM active""",
)
def registry_active(spark, sf):
    return reg.measurements(tb.measurements_view(spark, sf)).select(
        "uuid",
        "name",
        "status",
        "datatype",
        F.unix_millis("created_at").alias("created_ms"),
        F.unix_millis("updated_at").alias("updated_ms"),
    )


SINCE = "2024-01-29 00:00:00"


@register(
    "registry_since",
    f"""WITH {MEASUREMENTS} SELECT uuid, name, collector_uuid FROM active
    WHERE updated_at >= TIMESTAMP '{SINCE}' AND collector_uuid = 'collector-7'""",
)
def registry_since(spark, sf):
    since = F.lit(SINCE).cast("timestamp")
    found = reg.measurements(tb.measurements_view(spark, sf), since=since, collector="collector-7")
    return found.select("uuid", "name", "collector_uuid")


@register(
    "registry_summary",
    f"""WITH {MEASUREMENTS} SELECT count(*) AS total, count(*) FILTER (lower(status) = 'active') AS active,
    count(DISTINCT name) FILTER (lower(status) = 'active') AS cached FROM measurements""",
)
def registry_summary(spark, sf):
    return reg.registry_summary(tb.measurements_view(spark, sf))


@register(
    "registry_diff",
    f"""WITH {MEASUREMENTS}, old AS (SELECT uuid, name FROM active WHERE quality <> 'Good'),
    new AS (SELECT uuid, name FROM active WHERE quality <> 'Bad')
    SELECT coalesce(new.uuid, old.uuid) AS uuid, coalesce(new.name, old.name) AS name,
    CASE WHEN old.uuid IS NULL THEN 'added' WHEN new.uuid IS NULL THEN 'removed' ELSE 'unchanged' END AS change
    FROM old FULL JOIN new ON old.uuid = new.uuid""",
)
def registry_diff(spark, sf):
    active = reg.measurements(tb.measurements_view(spark, sf))
    return reg.registry_diff(active.filter("quality <> 'Good'"), active.filter("quality <> 'Bad'"))


@register(
    "find_measurements",
    f"""WITH {MEASUREMENTS}, kept AS (SELECT * FROM measurements WHERE name LIKE '%/u1%' AND status IN ('Active', 'active')
      AND quality <> 'x' AND (c_mktsegment = 'BUILDING' OR event_type = 'purchase')
      AND database IN ('db_building', 'db_machinery', 'db_furniture')),
    wanted AS (SELECT concat('Plant/default/', t, '/u', user_id) AS name FROM kept, (VALUES ('click'), ('view')) v(t)
      WHERE event_type = 'purchase')
    SELECT uuid, name, status FROM kept WHERE event_type <> 'purchase'
    UNION SELECT uuid, name, status FROM measurements WHERE name IN (SELECT name FROM wanted)""",
)
def find_measurements(spark, sf):
    found = reg.find_measurements(
        tb.measurements_view(spark, sf),
        keyword="/U1",
        statuses=["Active", "active"],
        labels=["BUILDING", "purchase"],
        databases=["db_building", "db_machinery", "db_furniture"],
        exclude_calculations=True,
        include_dependencies=True,
    )
    return found.select("uuid", "name", "status")


@register(
    "find_by_asset",
    f"""WITH {MEASUREMENTS}, {PROPERTIES} SELECT uuid, name, quality FROM measurements
    WHERE uuid IN (SELECT measurement_uuid FROM props WHERE asset_uuid = 's3') AND datatype = 'number'""",
)
def find_by_asset(spark, sf):
    return reg.find_measurements(
        tb.measurements_view(spark, sf), asset="s3", props=tb.properties_view(spark, sf), datatypes=["number"]
    ).select("uuid", "name", "quality")


def pending(spark, sf):
    """Property maps per event path: several writes per path, some values missing."""
    k = tb.event_k()
    props = F.create_map(
        F.lit("last_k"),
        k.cast("string"),
        F.lit("grade"),
        F.when(k >= 50, "high"),
        F.lit("description"),
        F.when(k < 40, F.concat(F.lit("series of "), "event_type")),
    )
    return tb.table(spark, sf, "events").select(
        tb.user_series().alias("tag_path"), props.alias("properties"), F.col("event_id").alias("seq")
    )


_PENDING = f"""pending AS (
  SELECT concat('Plant/default/', event_type, '/u', user_id) AS tag_path, event_type,
         arg_max({K}, event_id) AS last_k, count(*) FILTER ({K} >= 50) AS high, count(*) FILTER ({K} < 40) AS low
  FROM events GROUP BY ALL)"""


@register(
    "metadata_merge",
    f"""WITH {_PENDING} SELECT tag_path, concat(CASE WHEN low > 0 THEN concat('description=series of ', event_type, ';')
    ELSE '' END, CASE WHEN high > 0 THEN 'grade=high;' ELSE '' END, 'last_k=', last_k) AS properties FROM pending""",
)
def metadata_merge(spark, sf):
    merged = merge_metadata(pending(spark, sf))
    return merged.select("tag_path", values.map_text("properties").alias("properties"))


@register(
    "onboard_new",
    f"""WITH {MEASUREMENTS}, {POINTS}, {_PENDING}, first AS (
      SELECT series_name, min(ts_ms) AS first_ms FROM points GROUP BY series_name)
    SELECT {sql_uuid("series_name")} AS uuid, series_name AS name, 'number' AS datatype, first_ms AS created_ms,
      CASE WHEN low > 0 THEN concat('series of ', event_type) END AS description,
      concat(CASE WHEN high > 0 THEN 'grade=high;' ELSE '' END, 'last_k=', last_k) AS attributes
    FROM first JOIN pending ON tag_path = series_name WHERE series_name NOT IN (SELECT name FROM active)""",
)
def onboard_new(spark, sf):
    created = reg.onboard(
        tb.points(spark, sf), tb.measurements_view(spark, sf), merge_metadata(pending(spark, sf))
    )
    return created.select(
        "uuid",
        "name",
        "datatype",
        F.unix_millis("created_at").alias("created_ms"),
        "description",
        values.map_text("attributes").alias("attributes"),
    )


@register(
    "infer_datatype",
    """WITH typed AS (
      SELECT concat('Plant/mixed/u', user_id) AS series_name, event_id, epoch_us(ts) // 1000 AS ts_ms, CASE event_type WHEN 'click' THEN 'number'
        WHEN 'purchase' THEN 'number' WHEN 'signup' THEN 'boolean' WHEN 'view' THEN 'string' END AS t FROM events)
    SELECT series_name, arg_min(t, event_id) AS datatype, min(ts_ms) AS first_ms FROM typed WHERE t IS NOT NULL
    GROUP BY series_name""",
)
def infer_datatype(spark, sf):
    kind = F.col("event_type")
    mixed = tb.table(spark, sf, "events").select(
        F.concat(F.lit("Plant/mixed/u"), "user_id").alias("series_name"),
        time.to_millis("ts").alias("ts_ms"),
        F.col("event_id").alias("seq"),
        F.when(kind.isin("click", "purchase"), F.col("value")).alias("value_num"),
        F.when(kind == "signup", F.col("value") > 10).alias("value_bool"),
        F.when(kind == "view", F.col("props")).alias("value_str"),
    )
    return reg.infer_datatype(mixed)


@register(
    "evict_and_recreate",
    f"""WITH {MEASUREMENTS} SELECT uuid, name, CASE WHEN quality = 'Bad' OR lower(status) <> 'active' THEN 'created'
    ELSE 'kept' END AS origin FROM measurements""",
)
def evict_and_recreate(spark, sf):
    meas = reg.measurements(tb.measurements_view(spark, sf))
    left = reg.evict(meas, meas.filter("quality = 'Bad'"))
    created = reg.onboard(tb.points(spark, sf), left)
    kept = left.select("uuid", "name", F.lit("kept").alias("origin"))
    return kept.unionByName(created.select("uuid", "name", F.lit("created").alias("origin")))


@register(
    "metadata_lookup",
    f"""WITH {MEASUREMENTS} SELECT concat('histprov:h:/sys:gw:/prov:default:/tag:', event_type, '/u', user_id) AS qpath,
    concat('datatype=number', CASE WHEN event_type = 'purchase' THEN ';engHigh=1000.0' ELSE '' END,
      CASE WHEN event_type <> 'error' THEN ';engLow=0.0' ELSE '' END,
      CASE event_type WHEN 'click' THEN ';engUnit=count' WHEN 'view' THEN ';engUnit=s' WHEN 'purchase' THEN ';engUnit=EUR' ELSE '' END,
      CASE WHEN event_type IN ('view', 'purchase') THEN ';limitHigh=250.0' ELSE '' END,
      CASE WHEN event_type = 'view' THEN ';limitLow=0.5' ELSE '' END, ';name=', name, ';status=', status) AS properties
    FROM active""",
)
def metadata_lookup(spark, sf):
    keys = tb.measurement_keys(spark, sf).unionByName(tb.asset_keys(spark, sf))
    found = resolve.query_metadata(keys, tb.measurements_view(spark, sf), tb.COLLECTOR)
    return found.select("qpath", values.map_text("properties").alias("properties"))


@register(
    "metadata_missing",
    f"""WITH {MEASUREMENTS}, {ASSETS} SELECT concat('histprov:h:/sys:gw:/prov:default:/tag:', event_type, '/u', user_id) AS qpath,
      name AS series_name, 'Bad_NotFound' AS status FROM measurements WHERE lower(status) <> 'active'
    UNION ALL SELECT concat('histprov:h:/tag:Assets/', name), name, 'Bad_NotFound' FROM assets WHERE uuid LIKE 's%'""",
)
def metadata_missing(spark, sf):
    keys = tb.measurement_keys(spark, sf).unionByName(tb.asset_keys(spark, sf))
    return resolve.missing_metadata(keys, tb.measurements_view(spark, sf), tb.COLLECTOR)


@register(
    "node_lookup",
    f"""WITH {MEASUREMENTS}, {ASSETS}, n AS (
      SELECT concat('histprov:h:/sys:gw:/prov:default:/tag:', event_type, '/u', user_id) AS qpath, uuid,
             epoch_us(created_at) // 1000 AS created_ms FROM active
      UNION ALL SELECT concat('histprov:h:/tag:Assets/', name), uuid, 0 FROM assets WHERE uuid LIKE 's%')
    SELECT qpath, uuid, {sql_uuid("uuid")} AS node_id, 'Float8' AS data_type, created_ms FROM n""",
)
def node_lookup(spark, sf):
    keys = tb.measurement_keys(spark, sf).unionByName(tb.asset_keys(spark, sf))
    found = resolve.lookup_nodes(keys, tb.measurements_view(spark, sf), tb.assets_view(spark, sf), tb.COLLECTOR)
    return found.select("qpath", "uuid", "node_id", "data_type", "created_ms")


@register(
    "namespace",
    f"""WITH {MEASUREMENTS}, {ASSETS} SELECT name, uuid, 'measurement' AS kind FROM active
    UNION ALL SELECT name, uuid, 'asset' FROM assets WHERE name NOT IN (SELECT name FROM active)""",
)
def namespace(spark, sf):
    return reg.namespace(tb.measurements_view(spark, sf), tb.assets_view(spark, sf)).select("name", "uuid", "kind")


@register(
    "point_header",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT series_name, ts_ms, value_num, uuid AS header_uuid, datatype, database
    FROM points JOIN active ON name = series_name""",
)
def point_header(spark, sf):
    return resolve.with_header(tb.points(spark, sf), tb.measurements_view(spark, sf)).select(
        "series_name", "ts_ms", "value_num", "header_uuid", "datatype", "database"
    )


@register(
    "browse_categories",
    f"""WITH {MEASUREMENTS}, {ASSETS}, c AS (
      SELECT 'Measurements' AS name, count(*) AS names FROM active UNION ALL SELECT 'Assets', count(*) FROM assets)
    SELECT 'folder' AS node_type, name, name AS path, true AS has_children, names FROM c""",
)
def browse_categories(spark, sf):
    meas, assets = tb.measurements_view(spark, sf), tb.assets_view(spark, sf)
    sizes = (
        reg.measurements(meas)
        .select(F.lit(paths.MEASUREMENTS).alias("name"))
        .unionByName(assets.select(F.lit(paths.ASSETS).alias("name")))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("names"))
    )
    return tree.browse(meas, assets, "").join(sizes, "name")


@register(
    "browse_children",
    f"""WITH {MEASUREMENTS} SELECT DISTINCT 'folder' AS node_type, event_type AS name,
    concat('Plant/default/', event_type) AS path, true AS has_children FROM active""",
)
def browse_children(spark, sf):
    return tree.browse(tb.measurements_view(spark, sf), tb.assets_view(spark, sf), "Measurements/Plant/default")


@register(
    "browse_leaves",
    f"""WITH {MEASUREMENTS} SELECT 'tag' AS node_type, concat('u', user_id) AS name, name AS path, false AS has_children
    FROM active WHERE event_type = 'click'""",
)
def browse_leaves(spark, sf):
    return tree.browse(tb.measurements_view(spark, sf), tb.assets_view(spark, sf), "Plant/default/click/")


@register(
    "browse_assets",
    f"""WITH {ASSETS} SELECT 'tag' AS node_type, name, name AS path, false AS has_children FROM assets WHERE uuid LIKE 'r%'
    UNION ALL SELECT DISTINCT 'folder', split_part(name, '/', 1), split_part(name, '/', 1), true FROM assets
    WHERE contains(name, '/')""",
)
def browse_assets(spark, sf):
    return tree.browse(tb.measurements_view(spark, sf), tb.assets_view(spark, sf), "Assets")


@register(
    "browse_filtered",
    f"""WITH {MEASUREMENTS} SELECT 'tag' AS node_type, concat('u', user_id) AS name, name AS path, false AS has_children
    FROM active WHERE event_type = 'view' AND (concat('u', user_id) LIKE 'u1%' OR concat('u', user_id) LIKE 'u_')""",
)
def browse_filtered(spark, sf):
    return tree.browse(
        tb.measurements_view(spark, sf), tb.assets_view(spark, sf), "Measurements/Plant/default/view", ["u1*", "u?"]
    )


@register(
    "folder_counts",
    f"""WITH {MEASUREMENTS}, {ASSETS}, n AS (SELECT name FROM active UNION ALL SELECT name FROM assets),
    p AS (SELECT string_split(name, '/') AS parts FROM n),
    e AS (SELECT array_to_string(parts[1:i], '/') AS folder, i FROM (SELECT parts, unnest(range(1, len(parts))) AS i FROM p))
    SELECT folder, count(*) AS names, CAST(max(i) AS INTEGER) AS depth FROM e GROUP BY folder""",
)
def folder_counts(spark, sf):
    names = reg.measurements(tb.measurements_view(spark, sf)).select("name")
    return tree.folder_counts(names.unionByName(tb.assets_view(spark, sf).select("name")))


@register(
    "asset_closure",
    f"""WITH RECURSIVE {ASSETS}, tree AS (
      SELECT uuid, 0 AS depth FROM assets WHERE uuid IN ('r0', 'r2', 'n3')
      UNION ALL SELECT assets.uuid, depth + 1 FROM assets JOIN tree ON parent_uuid = tree.uuid)
    SELECT uuid, CAST(min(depth) AS INTEGER) AS depth FROM tree GROUP BY uuid""",
)
def asset_closure(spark, sf):
    return asset_ops.asset_closure(tb.assets_view(spark, sf), ["r0", "r2", "n3"])


@register(
    "asset_points",
    f"""WITH {POINTS}, {PROPERTIES}, {ASSETS} SELECT assets.name AS asset, props.name AS property, ts_ms, value_num
    FROM points JOIN props USING (series_name) JOIN assets ON asset_uuid = assets.uuid""",
)
def asset_points(spark, sf):
    props = tb.properties_view(spark, sf).withColumn("measurement_uuid", F.col("series_name"))
    out = asset_ops.asset_points(tb.assets_view(spark, sf), props, tb.points(spark, sf), key="series_name")
    return out.select("asset", "property", "ts_ms", "value_num")


@register(
    "find_assets",
    f"""WITH {ASSETS} SELECT uuid, name FROM assets WHERE lower(name) LIKE '%nation_1%' AND name LIKE 'A%'
    AND parent_uuid IN (SELECT concat('n', n_nationkey) FROM nation)""",
)
def find_assets(spark, sf):
    parents = tb.table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("uuid"))
    return reg.find_assets(tb.assets_view(spark, sf), keyword="NATION_1", path="A", parents=parents).select(
        "uuid", "name"
    )


@register(
    "find_properties",
    f"""WITH RECURSIVE {ASSETS}, {PROPERTIES}, tree AS (
      SELECT uuid FROM assets WHERE uuid = 'r1'
      UNION ALL SELECT assets.uuid FROM assets JOIN tree ON parent_uuid = tree.uuid)
    SELECT uuid, asset_uuid, name FROM props WHERE asset_uuid IN (SELECT uuid FROM tree) AND name LIKE '%i%'""",
)
def find_properties(spark, sf):
    return reg.find_properties(
        tb.properties_view(spark, sf),
        tb.assets_view(spark, sf),
        asset_uuids=["r1"],
        recursive=True,
        keyword="I",
        datatypes=["number"],
    ).select("uuid", "asset_uuid", "name")


@register(
    "find_collectors",
    """SELECT concat('s', s_suppkey) AS uuid, s_name AS description,
    CASE WHEN s_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status FROM supplier
    WHERE s_acctbal < 0 AND lower(s_name) LIKE '%supplier#%'""",
)
def find_collectors(spark, sf):
    return reg.find_collectors(tb.collectors_view(spark, sf), keyword="SUPPLIER#", statuses=["inactive"]).select(
        "uuid", "description", "status"
    )


@register(
    "find_databases", "SELECT concat('db', r_regionkey) AS uuid, r_name AS name FROM region WHERE r_name LIKE '%A%'"
)
def find_databases(spark, sf):
    return reg.find_databases(tb.databases_view(spark, sf), keyword="a")


@register(
    "registry_deleted",
    f"""WITH {MEASUREMENTS} SELECT name, uuid FROM active WHERE event_type <> 'error'""",
)
def registry_deleted(spark, sf):
    """A later row with another status takes a measurement off the registry."""
    meas = tb.measurements_view(spark, sf)
    gone = meas.filter(F.col("name").contains("/error/")).withColumn("status", F.lit("deleted"))
    gone = gone.withColumn("updated_at", F.expr("updated_at + INTERVAL 1 DAY"))
    return reg.measurements(meas.unionByName(gone)).select("name", "uuid")
