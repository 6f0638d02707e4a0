"""Tag history on Spark: points, registry, assets, aggregation and streams."""

from .plans.history import TagHistory, TagStore
from .plans.timeseries import Aggregation, TimeseriesRequest, query_timeseries

__all__ = ["Aggregation", "TagHistory", "TagStore", "TimeseriesRequest", "query_timeseries"]
