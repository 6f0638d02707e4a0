"""Tag-path grammar as native column expressions.

A qualified path is a chain of ``key:value`` components separated by ``:/``, for instance
``histprov:h:/sys:gw:/prov:default:/tag:Line/Temp``. All functions stay inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import ColumnLike, col

# The two browse categories, the provider used when none is named, the separator
# between components and the pattern of folder components.
MEASUREMENTS = "Measurements"
ASSETS = "Assets"
DEFAULT_PROVIDER = "default"
SEPARATOR = ":/"
FOLDER_PATTERN = r"(?s)(?<![^/])folder:(?=(.*?)(?::/|\z))"


def extract_component(path: ColumnLike, key: str) -> Column:
    """Value of the first ``key`` component (``"prov:"``, ``"tag:"`` ...), NULL if absent.

    A key only counts at the start of the path or after a slash, so ``prov:`` is not found
    inside ``histprov:``.
    """
    rooted, marker = F.concat(F.lit("/"), col(path)), "/" + key
    found = F.instr(rooted, marker)
    rest = F.substr(rooted, found + len(marker))
    return F.when(found > 0, F.substring_index(rest, SEPARATOR, 1))


def build_stored_path(collector: ColumnLike, provider: ColumnLike, tag: ColumnLike) -> Column:
    """``collector/provider/tag``; a missing provider becomes ``default``."""
    return F.concat(
        col(collector), F.lit("/"), F.coalesce(col(provider), F.lit(DEFAULT_PROVIDER)), F.lit("/"), col(tag)
    )


def extract_category(path: ColumnLike) -> Column:
    """``Measurements`` or ``Assets`` when that is the whole first segment, else NULL."""
    head = F.substring_index(col(path), "/", 1)
    return F.when(head.isin(MEASUREMENTS, ASSETS), head)


def strip_category(path: ColumnLike) -> Column:
    """Path without its leading category segment."""
    p, category = col(path), extract_category(path)
    return F.when(category.isNull(), p).otherwise(F.substr(p, F.length(category) + 2))


def folder_prefix(path: ColumnLike) -> Column:
    """All ``folder:`` values joined to ``a/b/``, or the empty string.

    The look-ahead keeps each value unconsumed, so a ``folder:`` that begins inside another
    folder's value is found as well. Empty leading names add no slash.
    """
    names = F.regexp_extract_all(F.coalesce(col(path), F.lit("")), F.lit(FOLDER_PATTERN), 1)
    joined = F.aggregate(
        names,
        F.lit(""),
        lambda done, name: F.when(done == "", name).otherwise(F.concat(done, F.lit("/"), name)),
    )
    return F.when(joined == "", F.lit("")).otherwise(F.concat(joined, F.lit("/")))


def stored_path(path: ColumnLike, collector: ColumnLike) -> Column:
    """Name under which the path's series is stored.

    * provider and tag present: ``collector/provider/tag``;
    * folders and tag: folder chain without category, then the tag;
    * tag alone: the tag without category;
    * no tag: the path itself.

    ``collector`` is a column, or the collector's name given as ``F.lit(name)`` or a plain string.
    """
    name = F.lit(collector) if isinstance(collector, str) else collector
    p = col(path)
    provider = extract_component(p, "prov:")
    tag = extract_component(p, "tag:")
    # the lambda binds the folder chain, so that it is computed once per path
    in_folders = F.transform(
        F.array(folder_prefix(p)),
        lambda chain: F.when(chain == "", strip_category(tag)).otherwise(F.concat(strip_category(chain), tag)),
    )
    return (
        F.when(tag.isNull(), p)
        .when(provider.isNotNull(), build_stored_path(name, provider, tag))
        .when(p.contains("folder:"), F.get(in_folders, F.lit(0)))
        .otherwise(strip_category(tag))
    )


def glob_to_regex(pattern: str) -> str:
    """Regular expression of a name filter with ``*`` and ``?`` wildcards."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch.isalnum() or ch in "_ /":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return r"(?s)\A" + "".join(out) + r"\z"
