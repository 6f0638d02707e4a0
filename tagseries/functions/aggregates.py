"""Catalogue of aggregates: requested name -> function -> Spark expression."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._columns import ColumnLike, col
from .time import arrival_order

# Aggregate names a caller may ask for and the function each one runs.
# Any other name runs the mean. MinMax is a pair and has no single function.
AGGREGATES = {
    "Average": "mean",
    "SimpleAverage": "mean",
    "Minimum": "min",
    "Maximum": "max",
    "Sum": "sum",
    "Count": "count",
    "LastValue": "last",
    "Range": "spread",
    "Variance": "variance",
    "StdDev": "stddev",
}
MINMAX = "MinMax"
DEFAULT_FUNCTION = "mean"
FUNCTIONS = ["mean", "min", "max", "sum", "count", "last", "spread", "variance", "stddev"]


def supported_aggregates(spark: SparkSession) -> DataFrame:
    """(aggregate, function) rows of the catalogue; MinMax runs ``min`` and ``max``."""
    rows = [*AGGREGATES.items(), (MINMAX, "min,max")]
    return spark.createDataFrame(rows, "aggregate string, function string")


def aggregate_function(name: ColumnLike) -> Column:
    """Function of a requested aggregate; unknown names run the mean."""
    pairs = [F.lit(x) for item in AGGREGATES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(name)), F.lit(DEFAULT_FUNCTION))


def functions_of(names: Iterable[str]) -> list[str]:
    """Functions needed to answer the given aggregate names, in catalogue order."""
    wanted = set()
    for name in names:
        wanted |= {"min", "max"} if name == MINMAX else {AGGREGATES.get(name, DEFAULT_FUNCTION)}
    return [f for f in FUNCTIONS if f in wanted]


def function_expr(function: str, value: str = "value_num", order: Column | None = None) -> Column:
    """Spark aggregate of one function over a numeric column.

    ``count`` is built by the caller, who knows all value columns; ``last`` takes the latest write of the latest
    instant, ``variance`` and ``stddev`` are the sample forms (NULL for one point).
    """
    v = F.col(value)
    if function == "mean":
        return F.avg(v)
    if function == "min":
        return F.min(v)
    if function == "max":
        return F.max(v)
    if function == "sum":
        return F.sum(v)
    if function == "last":
        return F.max_by(v, F.when(v.isNotNull(), arrival_order() if order is None else order))
    if function == "spread":
        return F.max(v) - F.min(v)
    if function == "variance":
        return F.var_samp(v)
    if function == "stddev":
        return F.stddev_samp(v)
    raise ValueError(f"unknown aggregate function: {function}")
