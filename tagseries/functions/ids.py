"""Name-based identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import ColumnLike, col


def name_uuid(name: ColumnLike) -> Column:
    """Name-based UUID (version 3 layout) of the text's UTF-8 bytes.

    The same name always gets the same id, so a repeated run creates no second series.
    """
    digest = F.md5(F.encode(col(name), "UTF-8"))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.instr(F.lit("0123456789abcdef"), digest.substr(17, 1)), F.lit(1))
    return F.concat_ws(
        "-",
        digest.substr(1, 8),
        digest.substr(9, 4),
        F.concat(F.lit("3"), digest.substr(14, 3)),
        F.concat(variant, digest.substr(18, 3)),
        digest.substr(21, 12),
    )


def node_id(uuid: ColumnLike) -> Column:
    """Identifier of a browse node, derived from the series or asset uuid."""
    return name_uuid(uuid)
