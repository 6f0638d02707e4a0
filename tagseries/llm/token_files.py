"""Token-id files of patched frame-of-reference blocks.

Ids are written in ascending document order (null ids first, equal ones by a hash of the text), an end id after each document, as a
sequence of shards. A shard is a self-contained file image of whole documents::

    magic "PFOR", version, documents, ids, blocks                                  5 x uint32
    document ids int64 (and a null mark uint8), starts of the documents' ids       n + 1 x uint32
    per block: minimum uint32, width uint8, exceptions uint16, begin of its bytes  b + 1 x uint32
    bytes of the blocks

A block holds 256 ids (the last one fewer, filled with its minimum): the block's minimum is subtracted, the rest is
packed at the width that a percentile of the block fits in, and for those that do not fit, place and high bits stand
in an exception list behind the packed words. The block index makes any range of ids readable without the rest.

Images are stored as a binary column of Parquet files, one row per shard, so that Spark's commit protocol and any
file system Spark reaches serve them; ``part`` and ``shard`` order them. Starts of documents in the whole corpus come
from the parts' totals: one number per part, never per document, is gathered.

Null text is empty: only the end id. A document longer than a shard is a shard of its own. No documents: no shards.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._batch import binary, ragged
from ._subwords import library_ids, with_end

BLOCK = 256
#: Share of a block's ids that the packed width must hold.
PERCENTILE = 0.9
#: Ids after which a shard ends with the document at hand.
SHARD = 1 << 20
#: Distinct pre-tokens a worker remembers.
MEMO = 1_200_000
_MAGIC = b"PFOR"
_U = np.uint64


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits each number needs."""
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))) + 1, 0).astype(np.int64)


def _words(width: int) -> int:
    """64-bit words a packed block takes."""
    return BLOCK * width // 64


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Blocks (m, 256) of numbers below 2**width as (m, words)."""
    out = np.zeros((len(values), _words(width)), _U)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        out[:, word] |= values[:, j] << _U(shift)
        if shift + width > 64:
            out[:, word + 1] |= values[:, j] >> _U(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(words), BLOCK), _U)
    if width:
        mask = _U((1 << width) - 1)
        for j in range(BLOCK):
            word, shift = divmod(j * width, 64)
            v = words[:, word] >> _U(shift)
            if shift + width > 64:
                v = v | (words[:, word + 1] << _U(64 - shift))
            out[:, j] = v & mask
    return out


def write_image(ids: np.ndarray, docs: list[int | None], starts: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One shard. ``starts`` has one entry more than documents; the last is the number of ids."""
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    full = np.zeros(blocks * BLOCK, np.int64)
    full[:n] = ids
    if n % BLOCK:
        full[n:] = full[(blocks - 1) * BLOCK : n].min()
    full = full.reshape(blocks, BLOCK)
    low = full.min(1)
    rest = full - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _bits(np.partition(rest, rank, axis=1)[:, rank])
    high = rest >> width[:, None]
    odd = high > 0
    count = odd.sum(1)
    at_block, at_place = np.nonzero(odd)
    place, above = at_place.astype(np.uint8), high[odd].astype("<u4")
    first = np.concatenate(([0], np.cumsum(count)))
    size = width * (BLOCK // 8) + 5 * count
    begin = np.concatenate(([0], np.cumsum(size)))
    body = np.zeros(begin[-1], np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        packed = _pack((rest[which] & ((1 << w) - 1)).astype(_U), w).astype("<u8").view(np.uint8)
        body[begin[which][:, None] + np.arange(packed.shape[1])] = packed
    if len(place):
        tail = (begin[:-1] + width * (BLOCK // 8))[at_block]
        nth = np.arange(len(place)) - first[at_block]
        body[tail + nth] = place
        spot = tail + count[at_block] + 4 * nth
        body[spot[:, None] + np.arange(4)] = above.view(np.uint8).reshape(-1, 4)
    null = np.array([d is None for d in docs], np.uint8)
    key = np.array([0 if d is None else d for d in docs], "<i8")
    parts = [_MAGIC, struct.pack("<4I", 1, len(docs), n, blocks), key, null, np.asarray(starts).astype("<u4")]
    parts += [low.astype("<u4"), width.astype(np.uint8), count.astype("<u2"), begin.astype("<u4"), body]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


class Image:
    """Reader of one shard."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a token file")
        _, n, self.n_ids, b = struct.unpack_from("<4I", data, 4)
        at = 20

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        key, null = take("<i8", n), take("u1", n)
        self.docs = [None if z else k for k, z in zip(key.tolist(), null.tolist(), strict=True)]
        self.starts = take("<u4", n + 1).astype(np.int64)
        self.low, self.width = take("<u4", b).astype(np.int64), take("u1", b).astype(np.int64)
        self.count, self.begin = take("<u2", b).astype(np.int64), take("<u4", b + 1).astype(np.int64)
        self.body = np.frombuffer(data, np.uint8, offset=at)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids start..end; only the blocks that hold them are decoded."""
        end = self.n_ids if end is None else min(end, self.n_ids)
        if start >= end:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-end // BLOCK)
        out = np.zeros((b - a, BLOCK), np.int64)
        width = self.width[a:b]
        for w in np.unique(width).tolist():
            which = np.flatnonzero(width == w)
            raw = self.body[self.begin[a + which][:, None] + np.arange(w * BLOCK // 8)]
            out[which] = _unpack(raw.view("<u8") if w else raw, w).astype(np.int64)
        count = self.count[a:b]
        if count.any():
            block = np.repeat(np.arange(b - a), count)
            nth = ragged(count)
            tail = (self.begin[a:b] + width * (BLOCK // 8))[block]
            place = self.body[tail + nth]
            above = self.body[(tail + count[block] + 4 * nth)[:, None] + np.arange(4)].view("<u4").ravel()
            out[block, place] |= above.astype(np.int64) << width[block]
        out += self.low[a:b, None]
        return out.ravel()[start - a * BLOCK : end - a * BLOCK].astype(np.uint32)


_STORED = "part int, shard int, first long, n_ids long, image binary"


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, text: str = "text", key: str = "doc_id"
) -> None:
    """Encode all documents and write their ids below ``path``. ``tokenizer`` is a tokenizers file the driver reads.

    One shuffle: the texts, by range of the key. Two passes over the key column find the ranges.
    """
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        ids, keys, held = [], [], 0
        starts = [0]

        def image() -> pa.RecordBatch:
            body = write_image(np.concatenate(ids), keys, np.array(starts))
            row = [[part], [shard], [first], [held], [body]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "shard", "first", "n_ids", "image"]
            )

        for batch, found, at in library_ids(batches, "text", sent.value, MEMO):
            found, at = with_end(found, at, end_id)
            names = batch.column("doc_id").to_pylist()
            row = 0
            while row < len(names):
                stop = int(np.searchsorted(at, at[row] + SHARD - held, side="left"))
                stop = min(max(stop, row + 1), len(names))
                ids.append(found[at[row] : at[stop]])
                keys += names[row:stop]
                starts += (at[row + 1 : stop + 1] - at[row] + held).tolist()
                held += int(at[stop] - at[row])
                row = stop
                if held >= SHARD:
                    yield image()
                    shard, first = shard + 1, first + held
                    ids, keys, held, starts = [], [], 0, [0]
        if keys:
            yield image()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]  # an id of many texts is dealt over tasks
    (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .mapInArrow(run, _STORED)
        .write.mode("overwrite")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit) of every document."""
    stored = spark.read.schema(_STORED).parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per written part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                image = Image(batch.column("image")[i].as_py())
                at = image.starts
                start = at[:-1] + batch.column("first")[i].as_py() + batch.column("base")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(image.docs, pa.int64()), pa.array(start), binary(image.ids().astype("<u4"), at * 4)],
                    ["doc_id", "start", "ids"],
                )

    return stored.join(base, "part").select("first", "base", "image").mapInArrow(
        run, "doc_id long, start long, ids binary"
    )


def digests(stored: DataFrame) -> DataFrame:
    """Place, length and checksum of every document's ids, as read back."""
    return stored.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
