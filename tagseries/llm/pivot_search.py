"""Exact top-k inner products by a pivot-distance index.

Vectors become points of a metric space: each is given one more component so that all have the same length M, queries
get a zero there, and the squared distance is |q|^2 + M^2 - 2 <q, x>. Points are keyed by their nearest pivot and
their distance to it and dealt in that order, so a block holds sorted rings around one or a few pivots. Rings with more
rows than a block holds have several; which ranges of distance a ring really has is measured.

A query expands rings outward from its own distance to each pivot. By the triangle inequality a point whose distance
to the pivot differs by more than R from the query's lies farther than R away, where R belongs to the k-th best score
known; that bound comes from a bounded sample at first and tightens with every ring. A query is sent only to blocks
that have a ring within it; rings outside it are never looked at, and a block ends when none is left. Rounding is
allowed for, so no point that counts is cut off.

Scores are integer inner products, exact below 2**53. Fewer than k candidates give all of them; a row is no neighbour
of itself; ties go to the smaller id. Empty tables give no rows.

Rows that repeat id and integer vector count once, as queries and as candidates. An id with several vectors asks with
each of them and is found by each; a query names every neighbour once, with the highest score. Null ids, null or empty
vectors and those with null or non-finite components take no part; vectors of different lengths are no neighbours.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import stored
from ._vectors import best, clean, dealt, first_blocks, matrix, meet, per_length, results, top, vectors

PIVOTS, SAMPLE = 32, 4_096
#: Rows of a block, about, and cells of (pivot, distance) that blocks are cut from, at most.
ROWS, CELLS = 8_192, 256
#: Points of a ring that are compared at a time.
RING = 1_024
_SLACK = 1e-6
#: Whole numbers below it are exact in double precision.
EXACT = 2.0**53


def pivots(sample: np.ndarray, n: int = PIVOTS, turns: int = 8) -> np.ndarray:
    """Centres of the sample by a few turns of k-means, from evenly spaced members."""
    if not len(sample):
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 1))
    centre = sample[np.linspace(0, len(sample) - 1, min(n, len(sample))).astype(int)]
    for _ in range(turns):
        near = distances(sample, centre).argmin(1)
        size = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, sample)
        centre = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centre)
    return centre


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def nearest(vectors: np.ndarray, centres: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest pivot, distance to it) of each vector."""
    far = distances(lifted(vectors, length), centres)
    near = far.argmin(1)
    return near, far[np.arange(len(near)), near]


def place(pivot: np.ndarray, far: np.ndarray, length: float) -> np.ndarray:
    """One number in the order of (pivot, distance); no distance exceeds twice the length."""
    return pivot * (4.0 * length + 1) + far


def lifted(vectors: np.ndarray, length: float) -> np.ndarray:
    """The vectors with the component that brings them to one length."""
    rest = np.sqrt(np.maximum(length * length - (vectors * vectors).sum(1), 0))
    return np.column_stack([vectors, rest])


def _reach(square: np.ndarray | float, score: np.ndarray | float, length: float) -> np.ndarray | float:
    """Distance within which all points of that score or a better one lie."""
    return np.sqrt(np.maximum(square - 2 * score, 0.0)) * (1 + _SLACK) + _SLACK * (length + 1)


def expand(
    query: np.ndarray, own: int, to_pivots: np.ndarray, ids: np.ndarray, vectors: np.ndarray, cells: list, length: float, bound: float, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of one block that can still count, given the k-th best score known elsewhere.

    ``cells``: (pivot, distances in ascending order, where its points begin in the block).
    """
    square = float(query @ query) + length * length
    kept_ids, kept = np.zeros(0, np.int64), np.zeros(0)

    def reach(score: float) -> float:
        return _reach(square, score, length)

    rings = []
    for pivot, far, begin in cells:
        middle = to_pivots[pivot]
        r = reach(bound)
        a, b = np.searchsorted(far, middle - r, "left"), np.searchsorted(far, middle + r, "right")
        for at in range(a, b, RING):
            end = min(at + RING, b)
            gap = max(far[at] - middle, middle - far[end - 1], 0.0)  # least distance any of them can have
            rings.append((gap, begin + at, begin + end))
    rings.sort()
    for gap, a, b in rings:
        if gap > reach(bound):
            break  # all later rings lie farther out
        score = vectors[a:b] @ query
        good = np.flatnonzero((score >= bound) & (ids[a:b] != own))
        if len(good):
            kept_ids, kept = np.append(kept_ids, ids[a:b][good]), np.append(kept, score[good])
            order = top(kept_ids, kept, k)
            kept_ids, kept = kept_ids[order], kept[order]
            if len(kept) == k:
                bound = max(bound, float(kept[-1]))
    return kept_ids, kept


def search(df: DataFrame, every: int, k: int, scale: int = 256, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The k highest integer inner products of each row whose id is divisible by ``every``.

    A query is searched among the vectors of its own length. A table whose longest vector has a square of 2**53 or
    more is refused: doubles would not hold all scores exactly.
    """

    def whole(x: Column) -> Column:
        scaled = x * scale  # from 2**53 on, doubles are whole numbers
        return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)

    rows = clean(df, vector, key).withColumn("v", F.transform("v", whole))
    return per_length(rows, lambda some: _search(some, every, k))


def _search(rows: DataFrame, every: int, k: int) -> DataFrame:
    rows = stored(rows.dropDuplicates(["vec_id", "v"]))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    most = rows.agg(F.max(square)).first()[0] or 0.0
    if most >= EXACT:
        raise ValueError("scores of 2**53 and more are not exact; use a lower scale")
    length = np.sqrt(most)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).toPandas()  # a bounded sample for the driver
    drawn = drawn.drop_duplicates("vec_id")  # as many ids as rows, for the first bound
    sample_ids = drawn["vec_id"].to_numpy(np.int64)
    sample = np.array(drawn["v"].tolist(), np.float64)
    if not len(sample):
        sample = sample.reshape(0, 1)
    centres = pivots(lifted(sample, length))
    own, far = nearest(sample, centres, length)
    places = np.sort(place(own, far, length))
    cells = min(max(1, -(-rows.count() // ROWS)), CELLS, max(1, len(places)))
    border = places[np.arange(1, cells) * len(places) // cells]
    sent = rows.sparkSession.sparkContext.broadcast((sample_ids, sample, centres))

    def key_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                pivot, far = nearest(matrix(batch.column("v")), sent.value[2], length)
                cell = np.searchsorted(border, place(pivot, far, length), "right")
                columns = [*batch.select(["vec_id", "v"]).columns, *map(pa.array, (cell, pivot, far))]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "cell", "pivot", "far"])

    keyed = stored(rows.mapInArrow(key_of, "vec_id long, v array<double>, cell long, pivot long, far double"))
    first = first_blocks(keyed, cells, ROWS)
    ends = [F.min("far").alias("low"), F.max("far").alias("high")]
    extents = keyed.groupBy("cell", "pivot").agg(*ends).collect()  # cells and pivots are bounded
    rings = np.array([(r["cell"], r["pivot"], r["low"], r["high"]) for r in extents]).reshape(-1, 4)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample_ids, sample, centres = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = vectors(batch)
            known = v @ sample.T
            known[ids[:, None] == sample_ids] = -np.inf
            bound = -length * np.sqrt((v * v).sum(1)) - 1  # no score is less
            if len(sample) > k:
                bound = np.maximum(bound, -np.partition(-known, k - 1, axis=1)[:, k - 1])
            reach = _reach((v * v).sum(1) + length * length, bound, length)[:, None]
            middle = distances(np.column_stack([v, np.zeros(len(v))]), centres)[:, rings[:, 1].astype(np.int64)]
            near = (middle - reach <= rings[:, 2:].T[1]) & (middle + reach >= rings[:, 2:].T[0])
            visits = np.zeros((len(v), cells), bool)
            q, ring = np.nonzero(near)
            visits[q, rings[ring, 0].astype(np.int64)] = True
            q, cell = np.nonzero(visits)
            columns = [pa.array(cell), pa.array(bound[q]), *(batch.column(c).take(pa.array(q)) for c in ("vec_id", "v"))]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "far", "vec_id", "v"])

    def build(block: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
        pivot, far = block.column("pivot").to_numpy(), block.column("far").to_numpy()
        edge = [0, *(np.flatnonzero(np.diff(pivot)) + 1).tolist(), len(pivot)]
        return *vectors(block), [(int(pivot[a]), far[a:b], a) for a, b in zip(edge[:-1], edge[1:], strict=True)]

    def answer(block: tuple[np.ndarray, np.ndarray, list], asked: pa.RecordBatch) -> pa.RecordBatch:
        (ids, v, rings), (q_ids, queries) = block, vectors(asked)
        to_pivots = distances(np.column_stack([queries, np.zeros(len(queries))]), sent.value[2])
        bound = asked.column("far").to_numpy()
        found = []
        for q in range(len(queries)):
            got = expand(queries[q], int(q_ids[q]), to_pivots[q], ids, v, rings, length, float(bound[q]), k)
            found.append((int(q_ids[q]), *got))
        return results(found)

    asked = keyed.filter(F.col("vec_id") % every == 0).mapInArrow(ask, "cell long, far double, vec_id long, v array<double>")
    of = F.array(*[F.lit(int(x)) for x in first])
    blocks = F.sequence(F.element_at(of, F.col("cell").cast("int") + 1), F.element_at(of, F.col("cell").cast("int") + 2) - 1)
    asked = asked.select(F.explode(blocks).alias("block"), F.lit(0).cast("long").alias("pivot"), "far", "vec_id", "v")
    data = dealt(keyed.withColumn("cell", F.col("cell").cast("int")), first).select("block", "pivot", "far", "vec_id", "v")
    return best(meet(data, asked, int(first[-1]), build, answer), k, "long")


#: The same for DuckDB, every 50th id and 5 of each.
TOP_SQL = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, max(list_inner_product(q.v, c.v)) AS score
    FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
    WHERE q.vec_id % 50 = 0 GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score::BIGINT AS score FROM ranked WHERE rank <= 5
"""
