"""Approximate nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes: ``ROTATIONS`` rotations are learned on a bounded sample (``SAMPLE`` distinct vectors of least hash), each by turning
the sample's principal axes until the signs lose least (iterative quantization); a vector's code is the signs of all
its rotated components. The code is split into 16-bit substrings, each indexed by value.

Search: for a Hamming radius r, pigeonhole says that a code within r has some substring within its share of r (the
shares plus one add up to r + 1). All values in that share of the query's substring are probed, the hits' whole codes
are compared, and what lies within r is reranked by the inner product of the original vectors in double precision.
The radius of a query is the one at which its own neighbours in the sample, ``KEEP`` of them by inner product, lie,
plus ``SLACK`` for what the code loses; copies of a vector are one neighbour there, so that no group of them sets the
radius by the code of one vector. Where fewer than k codes are found it is raised until there are.

Every vector is indexed, in blocks of about ``ROWS``; a block's index is built once, and every query, sent with its
radius, passes by. Of a substring's values the probes are enumerated, or where the block has fewer distinct values than
there are probes, those values are. The best of all blocks are merged. Fewer than k candidates give all of them; a
vector is no neighbour of itself; ties go to the smaller id. Empty tables give no rows.

Rows that repeat id and vector count once, as queries and as candidates. An id with several vectors asks with each of
them and is found by each; a query names every neighbour once, with the highest score. Null ids, null, empty or zero
vectors and those with null or non-finite components take no part; vectors of different lengths are no neighbours.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import ragged
from ._tables import stored
from ._vectors import best, clean, dealt, first_blocks, matrix, meet, per_length, results, top, vectors

SAMPLE = 8_192
ROTATIONS = 2
TURNS = 25
#: Share of a query's true neighbours in the sample that its radius must hold.
KEEP = 0.93
#: Share of the code's bits that is added to every radius.
SLACK = 1 / 64
#: Rows of a block, about.
ROWS = 8_192
_SUB = 16


class Coder:
    """Learned rotations."""

    def __init__(self, sample: np.ndarray, rotations: int = ROTATIONS, turns: int = TURNS):
        self.mean = sample.mean(0)
        x = sample - self.mean
        _, axes = np.linalg.eigh(x.T @ x + 1e-9 * np.eye(x.shape[1]))
        self.turned = []
        for seed in range(rotations):
            r = np.linalg.qr(np.random.default_rng(seed).normal(size=axes.shape))[0]
            flat = x @ axes
            for _ in range(turns):
                u, _, v = np.linalg.svd(np.where(flat @ r >= 0, 1.0, -1.0).T @ flat)
                r = (u @ v).T
            self.turned.append(axes @ r)
        self.axes = np.concatenate(self.turned, 1)
        self.width = -(-self.axes.shape[1] // _SUB) * _SUB

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, substrings) of uint16."""
        bits = np.zeros((len(vectors), self.width), np.uint8)
        bits[:, : self.axes.shape[1]] = (vectors - self.mean) @ self.axes >= 0
        return np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.uint16)


def shares(radius: int, parts: int) -> list[int]:
    """Radius of each substring: each plus one, they add up to radius + 1."""
    return [(radius + 1) // parts + (i < (radius + 1) % parts) - 1 for i in range(parts)]


_MASKS = [np.flatnonzero(np.bitwise_count(np.arange(1 << _SUB, dtype=np.uint32)) == d).astype(np.uint16) for d in range(_SUB + 1)]
_WITHIN = [np.concatenate(_MASKS[: d + 1]) for d in range(_SUB + 1)]


class Index:
    """Substring values of one block of codes, each with the rows that have it."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.whole = self._packed(codes)
        self.values, self.begin, self.rows, self.value_of = [], [], [], []
        for part in codes.T:
            values, number = np.unique(part, return_inverse=True)
            self.values.append(values)
            self.value_of.append(number)
            self.rows.append(np.argsort(number, kind="stable"))
            self.begin.append(np.concatenate(([0], np.cumsum(np.bincount(number, minlength=len(values))))))

    @staticmethod
    def _packed(codes: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(codes), -(-codes.shape[1] // 4) * 4), np.uint16)
        wide[:, : codes.shape[1]] = codes
        return wide.view(np.uint64)

    def _probed(self, s: int, value: np.uint16, share: int) -> np.ndarray:
        """Places, in the values of substring s, of all within the share of one value."""
        values, probes = self.values[s], _WITHIN[min(share, _SUB)]
        if len(values) <= len(probes):
            return np.flatnonzero(np.bitwise_count(values ^ value) <= share)
        probes = np.sort(probes ^ value)
        at = np.minimum(np.searchsorted(values, probes), len(values) - 1)
        return at[values[at] == probes]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code lies within the radius, all of them."""
        n = len(self.codes)
        if radius >= self.codes.shape[1] * _SUB:
            return np.arange(n)
        hit = np.zeros(n, bool)
        for s, share in enumerate(shares(radius, self.codes.shape[1])):
            if share < 0:
                continue
            found = self._probed(s, code[s], share)
            size = self.begin[s][found + 1] - self.begin[s][found]
            if size.sum() * 8 < n:
                hit[self.rows[s][np.repeat(self.begin[s][found], size) + ragged(size)]] = True
            else:
                chosen = np.zeros(len(self.values[s]), bool)
                chosen[found] = True
                hit |= chosen[self.value_of[s]]
        rows = np.flatnonzero(hit)
        far = np.bitwise_count(self.whole[rows] ^ self._packed(code[None])).sum(1)
        return rows[far <= radius]


def radii(coder: Coder, sample: np.ndarray, queries: np.ndarray, k: int, keep: float = KEEP) -> np.ndarray:
    """Hamming radius for each query, from its neighbours in the sample, whose vectors are distinct.

    The fewer rows the sample has of a table, the nearer the table's neighbours are: what holds the sample's k
    nearest holds them too, up to what the code loses, which the quantile over the sample's neighbours and the slack
    cover.
    """
    slack = int(np.ceil(SLACK * coder.width))
    codes, own = coder.codes(sample), coder.codes(queries)
    k = min(k + 1, len(sample))
    out = np.zeros(len(queries), np.int64)
    for a in range(0, len(queries), 256):
        score = queries[a : a + 256] @ sample.T
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        far = np.sort(np.bitwise_count(codes[near] ^ own[a : a + 256, None, :]).sum(2), axis=1)
        out[a : a + 256] = far[:, min(k - 1, int(np.ceil(keep * k)) - 1)] + slack
    return out


def search(df: DataFrame, every: int, k: int, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The k nearest found of each row whose id is divisible by ``every``: query_id, rank, vec_id, score.

    A query is searched among the vectors of its own length.
    """
    return per_length(clean(df, vector, key, zero=False), lambda rows: _search(rows, every, k))


def _search(rows: DataFrame, every: int, k: int) -> DataFrame:
    rows = stored(rows.dropDuplicates(["vec_id", "v"]).withColumn("cell", F.lit(0)))
    drawn = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()["v"]  # bounded, for the driver
    sample = np.array(drawn.tolist(), np.float64)
    coder = Coder(sample) if len(sample) else None
    sent = rows.sparkSession.sparkContext.broadcast((coder, sample))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                radius = radii(*sent.value, matrix(batch.column("v")), k).astype(np.float64)
                columns = [*batch.select(["vec_id", "v"]).columns, pa.array(radius)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "far"])

    def build(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, Index]:
        ids, v = vectors(rows)
        return ids, v, Index(sent.value[0].codes(v))

    def answer(block: tuple[np.ndarray, np.ndarray, Index], asked: pa.RecordBatch) -> pa.RecordBatch:
        (ids, v, index), (q_ids, queries) = block, vectors(asked)
        coder, found = sent.value[0], []
        codes = coder.codes(queries)
        for q, radius in enumerate(asked.column("far").to_numpy().astype(np.int64).tolist()):
            near = index.within(codes[q], radius)
            near = near[ids[near] != q_ids[q]]
            while len(near) < len(ids) and len(np.unique(ids[near])) < k and radius < coder.width:
                radius += 4
                near = index.within(codes[q], radius)
                near = near[ids[near] != q_ids[q]]
            score = (v[near] * queries[q]).sum(1)
            order = top(ids[near], score, k)
            found.append((int(q_ids[q]), ids[near][order], score[order]))
        return results(found)

    first = first_blocks(rows, 1, ROWS)
    n = int(first[-1])
    none = [F.lit(0).cast("long").alias("pivot"), F.lit(0.0).alias("far")]
    data = dealt(rows, first).select("block", *none, "vec_id", "v")
    asked = rows.filter(F.col("vec_id") % every == 0).mapInArrow(ask, "vec_id long, v array<double>, far double")
    visits = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n, 1) - 1).cast("long"))).alias("block")
    asked = asked.select(visits, none[0], "far", "vec_id", "v")
    return best(meet(data, asked, n, build, answer), k, "double")
