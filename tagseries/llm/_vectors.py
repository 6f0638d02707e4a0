"""Vectors of a table in blocks, and block-wise search of a stated query set against all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Different lengths that a table's vectors may have.
LENGTHS = 64


def clean(df: DataFrame, vector: str, key: str, zero: bool = True) -> DataFrame:
    """(vec_id long, v array<double>) of the vectors that take part.

    Left out: null vectors or ids, empty vectors, null or non-finite components, and zero vectors unless ``zero``.
    """
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~odd)
    return rows if zero else rows.filter(F.exists("v", lambda x: x != 0))


def per_length(rows: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A search run for each length of vectors by itself: an inner product needs two of one length.

    A query of a length few vectors have gets as many neighbours as there are. A table with more than ``LENGTHS``
    lengths is refused.
    """
    sizes = rows.select(F.size("v").alias("n")).distinct().orderBy("n").limit(LENGTHS + 1).collect()
    if len(sizes) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    if len(sizes) < 2:
        return search(rows)
    found = [search(rows.filter(F.size("v") == r["n"])) for r in sizes]
    return reduce(DataFrame.unionAll, found)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def first_blocks(rows: DataFrame, cells: int, per_block: int) -> np.ndarray:
    """Number of the first block of each cell of ``rows`` (column ``cell``), and the number of all blocks.

    A cell has as many blocks as its rows need, so the answer has ``cells`` + 1 numbers at any size.
    """
    count = np.zeros(cells, np.int64)
    for row in rows.groupBy("cell").count().collect():  # one row per cell
        count[row["cell"]] = row["count"]
    return np.concatenate(([0], np.cumsum(-(-count // per_block))))


_SENT = ["block", "asks", "pivot", "far", "vec_id", "v"]
SENT = "block long, pivot long, far double, vec_id long, v array<double>"


def dealt(rows: DataFrame, first: np.ndarray) -> DataFrame:
    """``rows`` with their block: each cell's rows are dealt over its blocks by a hash of id and vector."""
    of = F.array(*[F.lit(int(x)) for x in first])
    begin, end = F.element_at(of, F.col("cell") + 1), F.element_at(of, F.col("cell") + 2)
    return rows.withColumn("block", begin + F.pmod(F.xxhash64("vec_id", "v"), end - begin))


def meet(data: DataFrame, asked: DataFrame, n: int, build: Callable, answer: Callable) -> DataFrame:
    """(query_id, vec_id, score) of queries that each visit the blocks they name.

    ``data`` and ``asked`` have the columns of ``SENT``, a query one row per block it visits. Data are shuffled once
    and never copied; a block's rows come first, by (pivot, far), and are built to ``build(table)``; its queries stream
    past that, some at a time, as ``answer(built, batch)``. So a task holds one block, however many queries there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, built = None, [], None
        for batch in batches:
            at, asks = batch.column("block").to_numpy(), batch.column("asks").to_numpy()
            edge = np.flatnonzero((np.diff(at) != 0) | (np.diff(asks) != 0)) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
                if a == b:
                    continue
                if at[a] != block:
                    block, held, built = at[a], [], None
                if not asks[a]:
                    held.append(batch.slice(a, b - a))
                elif held or built is not None:
                    if built is None:
                        built, held = build(pa.Table.from_batches(held)), []
                    yield answer(built, batch.slice(a, b - a))

    marked = [df.withColumn("asks", F.lit(i)).select(_SENT) for i, df in enumerate((data, asked))]
    tasks = min(max(n, 1), 10_000)
    both = marked[0].unionAll(marked[1]).repartitionById(tasks, F.pmod("block", F.lit(tasks)).cast("int"))
    sent = both.sortWithinPartitions("block", "asks", "pivot", "far", "vec_id")
    return sent.mapInArrow(run, "query_id long, vec_id long, score double")


def vectors(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, matrix) of rows with vec_id and v."""
    v = rows.column("v")
    return rows.column("vec_id").to_numpy(), matrix(v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v)


def best(found: DataFrame, k: int, kind: str) -> DataFrame:
    """The k best ids of each query over all blocks, each once with its highest score; ties to the smaller id."""
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.col("score").cast(kind))


def top(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best ids, each where its score is highest, highest score first, ties to the smaller id."""
    wanted = k
    while True:
        keep = np.arange(len(score))
        if len(score) > 4 * wanted:
            keep = np.flatnonzero(score >= np.partition(score, len(score) - wanted)[len(score) - wanted])
        order = keep[np.lexsort((ids[keep], -score[keep]))]
        first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
        if len(first) == k or len(keep) == len(score):
            return order[first]
        wanted *= 4  # rows of one id took the places of others


def results(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Rows (query_id, vec_id, score) of (query, ids, scores)."""
    q = np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]).astype(np.int64)
    ids = np.concatenate([*(p[1] for p in parts), np.zeros(0, np.int64)]).astype(np.int64)
    score = np.concatenate([*(p[2] for p in parts), np.zeros(0)]).astype(np.float64)
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])
