"""Small point sets used by several tests."""

from tagseries.schema import ASSETS, MEASUREMENTS, POINTS

BASE = 1_700_030_000_000


def point(name, ts, value, seq=None, code=192, tags=None):
    num = float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
    boolean = value if isinstance(value, bool) else None
    text = value if isinstance(value, str) else None
    status = "Good" if code >= 192 else "Uncertain" if code >= 64 else "Bad"
    return (name, None, ts, num, boolean, text, code, status, tags or {}, ts if seq is None else seq)


def points(spark, rows):
    return spark.createDataFrame(rows, POINTS)


def ramp(spark, name="Plant/default/ramp"):
    return points(spark, [point(name, BASE + i * 1000, i) for i in range(100)])


def measurement(name, uuid=None, status="Active", datatype="number", **more):
    row = {f.name: None for f in MEASUREMENTS.fields}
    row.update(uuid=uuid or f"id-{name}", name=name, status=status, datatype=datatype, **more)
    return tuple(row[f.name] for f in MEASUREMENTS.fields)


def measurements(spark, rows):
    return spark.createDataFrame(rows, MEASUREMENTS)


def asset(uuid, name, parent=None, created_at=None):
    return (uuid, name, "", parent, name, None, None, created_at, None)


def assets(spark, rows):
    return spark.createDataFrame(rows, ASSETS)


def values(df, *columns, sort=True):
    out = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(out, key=repr) if sort else out
