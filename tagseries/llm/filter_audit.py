"""Interaction of filters: what each one removes, keeps and repeats at every step of every order of applying them.

A document's failures are a mask of five bits. For an order of the filters and a step in it, the mask alone says
whether the document is still kept, is removed there, fails there after an earlier removal, or fails that filter only.
So every mask maps to wide integers, one per such counter, whose 600 fields of 64 bits (120 orders of five steps) hold
that document's outcomes as 0 or 1. A part's counts are the sum of the integers of its documents, read field by field:
one addition counts all 600 outcomes, and a field cannot run over into the next, as no part has 2**64 rows.

Rows of one part, mask and label are counted by the JVM before the sums, so an integer is multiplied by their number
instead of added so often; a part of any size reaches its Python task as at most 32 masks times four labels.

Filters (words are runs of ``[^\\x20\\x09-\\x0D]``, case-sensitive; a null text is empty):
A under 50 words; B 100 * distinct words < 65 * words; C 100 * capitals A-Z > 5 * code points; D any of ``#$%&*|``;
E equal to the text of any smaller doc_id of the whole table, removed or not.

Copies never meet in one task: rows of one text and doc_id shrink to one, the least doc_id of each text is a minimum
taken on the map side, and it is joined back by (text, doc_id). Texts are compared by SHA-256.

Null doc_ids are no one's smaller id, never fail E and have no labels. Repeated rows count each; those of the least
doc_id of a text do not fail E. A doc_id labelled several times counts as labelled if any of its labels says so. A
null part is the empty string. No documents: no rows. Other columns are not looked at.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
FIELDS = len(ORDERS) * len(FILTERS)
#: Bits of a field: no count of rows needs more.
WIDTH = 64
MEASURES = ("kept", "removed", "redundant", "unique_fails")

_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _failures(text: Column, words: Column) -> Column:
    """Mask of the filters A to D that a text fails."""
    n = F.size(words).cast("long")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = [
        n < 50,
        F.size(F.array_distinct(words)).cast("long") * 100 < n * 65,
        capitals.cast("long") * 100 > F.length(text).cast("long") * 5,
        text.rlike("[#$%&*|]"),
    ]
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << bit).otherwise(0)
    return mask


def failures(docs: DataFrame, part: str = "source", text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, part, mask, n): the failed filters of every document, rows alike in all of it counted once."""
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("words", words).select(
        F.unhex(F.sha2("text", 256)).alias("h"),
        "doc_id",
        "part",
        _failures(F.col("text"), F.col("words")).alias("mask"),
    )
    rows = stored(rows.groupBy("h", "doc_id", "part", "mask").agg(F.count("*").alias("n")))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    return rows.join(first, ["h", "doc_id"], "left").select("doc_id", "part", mask.alias("mask"), "n")


@lru_cache(maxsize=None)
def wide(mask: int) -> tuple[int, ...]:
    """The counters of a mask, one integer per measure; field 5 * order + step, lowest first."""
    out = [0] * len(MEASURES)
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            one = 1 << WIDTH * (o * len(FILTERS) + s)
            failed = bool(mask >> FILTERS.index(letter) & 1)
            if failed and gone:
                out[2] |= one
            elif failed:
                out[1] |= one
                gone = True
            if not gone:
                out[0] |= one
            if mask == 1 << FILTERS.index(letter):
                out[3] |= one
    return tuple(out)


def fields(total: int) -> np.ndarray:
    """The 600 counts of a sum of wide integers."""
    return np.frombuffer(total.to_bytes(FIELDS * WIDTH // 8, "little"), "<u8").astype(np.int64)


def _part(rows: pd.DataFrame) -> pd.DataFrame:
    """All steps of all orders of one part."""
    totals, good, toxic = [0] * len(MEASURES), 0, 0
    for mask, q, t, n in rows[["mask", "quality", "toxic", "n"]].itertuples(index=False):
        counters, n = wide(int(mask)), int(n)
        totals = [total + n * c for total, c in zip(totals, counters, strict=True)]
        good += n * counters[1] if q else 0
        toxic += n * counters[1] if t else 0
    out = pd.DataFrame({name: fields(total) for name, total in zip(MEASURES, totals, strict=True)})
    out["good_lost"], out["toxic_lost"] = fields(good), fields(toxic)
    out.insert(0, "part", rows["part"].iloc[0])
    out.insert(1, "filter_order", np.repeat(ORDERS, len(FILTERS)))
    out.insert(2, "step", np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)))
    letter = [order[s - 1] for order, s in zip(out["filter_order"], out["step"], strict=True)]
    out["shapley"] = out.groupby(letter)["removed"].transform("sum")
    return out


def audit(
    docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """600 rows per part: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley of each step."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("quality") == 1).alias("quality"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    found = failures(docs, part, text, key).join(marks, "doc_id", "left")
    sure = [F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic")]
    counted = found.groupBy("part", "mask", *sure).agg(F.sum("n").alias("n"))
    return counted.groupBy("part").applyInPandas(_part, _AUDIT)


#: The same rows from DuckDB.
AUDIT_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), fails AS (
    SELECT doc_id, part,
           CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS f
    FROM words
), marks AS (
    SELECT doc_id, max(quality = 1) AS q, max(toxic = 1) AS x FROM labels GROUP BY doc_id
), counted AS (
    SELECT part, f, coalesce(q, false) AS q, coalesce(x, false) AS x, count(*) AS n
    FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, s AS step, filter_order[s] AS l, left(filter_order, s - 1) AS earlier
    FROM orders, range(1, 6) r(s)
), outcomes AS (
    SELECT *, contains(f, l) AS failed, translate(earlier, f, '') <> earlier AS gone FROM counted, steps
), summed AS (
    SELECT part, filter_order, step, l,
           sum(n) FILTER (NOT failed AND NOT gone) AS kept, sum(n) FILTER (failed AND NOT gone) AS removed,
           sum(n) FILTER (failed AND gone) AS redundant, sum(n) FILTER (f = l) AS unique_fails,
           sum(n) FILTER (failed AND NOT gone AND q) AS good_lost,
           sum(n) FILTER (failed AND NOT gone AND x) AS toxic_lost
    FROM outcomes GROUP BY ALL
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, l), 0)::BIGINT AS shapley
FROM summed
"""
