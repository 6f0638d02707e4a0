"""Packing of documents into sequences: best fit, longest first, over a segment tree of remaining capacities.

Every document's ids (with an end id) are cut into full windows and a rest. A full window is a sequence of its own;
the rests, longest first, each go to the open window with the least room that still holds them, or open a new one.
The tree has a leaf per remaining capacity and answers "least capacity of at least r" by one walk up and one down.

Documents are dealt into groups by a hash of the row; a group is packed by one task with one integer pair per open
window, so its size is bounded by ``GROUP`` rows on average and a corpus of any size is packed in parallel. Equal rows
are numbered within their task, whatever their order, and every ``RUN`` of them go to another group, so a row that is
repeated however often is no skew. Each group leaves a few windows with room. Numbers of sequences are unique: the
group's number times 2**32 plus a count.

Null text is empty: one piece with the end id. Repeated rows are packed each. Ties go by doc_id, then checksum. No
documents: no rows. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import mix
from ._subwords import library_ids, with_end

CAPACITY = 1024
#: Mean number of documents that are packed together.
GROUP = 20_000
#: Equal rows of one task that go to the same group.
RUN = 64

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, pack_group long"
_PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Open windows by remaining capacity."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.leaves)  # 1: some window below this node
        self.stacks: dict[int, list[int]] = {}

    def put(self, window: int, room: int) -> None:
        if room <= 0:
            return
        self.stacks.setdefault(room, []).append(window)
        node = self.leaves + room
        while node and not self.tree[node]:
            self.tree[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, room) with the least room of at least ``need``, removed; None if there is none."""
        tree, node = self.tree, self.leaves + need
        while not tree[node]:
            while node & 1:  # a right child: what is larger lies further up
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        stack = self.stacks[room]
        window = stack.pop()
        if not stack:
            tree[node] = 0
            node >>= 1
            while node and not (tree[2 * node] or tree[2 * node + 1]):
                tree[node] = 0
                node >>= 1
        return window, room


def best_fit(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(window, offset) of each piece, given longest first; no piece may be longer than the capacity."""
    windows, out, count = OpenWindows(capacity), [], 0
    for need in lengths:
        found = windows.take(need) if need < capacity else None
        window, room = found or (count, capacity)
        count += found is None
        out.append((window, capacity - room))
        windows.put(window, room - need)
    return out


def group_of(row_hash: np.ndarray, copies: dict[int, int], groups: int) -> np.ndarray:
    """Group of each row; ``copies`` counts the equal rows met so far."""
    nth = np.empty(len(row_hash), np.uint64)
    for i, h in enumerate(row_hash.tolist()):
        nth[i] = copies[h] = copies.get(h, -1) + 1
    return (mix(row_hash.view(np.uint64) ^ mix(nth // np.uint64(RUN))) % np.uint64(groups)).astype(np.int64)


def cut(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Pieces of every document with the checksum of their ids, and the group they are packed in."""
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    groups = max(1, -(-docs.count() // GROUP))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("row_hash", F.xxhash64("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copies: dict[int, int] = {}
        for batch, ids, at in library_ids(batches, "text", sent.value):
            group = pa.array(group_of(batch.column("row_hash").to_numpy(), copies, groups))
            ids, at = with_end(ids, at, end_id)
            total = np.diff(at)
            number = -(-total // capacity)
            row = np.repeat(np.arange(len(total)), number)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * capacity
            length = np.minimum(total[row] - start, capacity)
            raw, begin = memoryview(ids.astype("<u4").tobytes()), at[row] + start
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    pa.array(start),
                    pa.array(length),
                    pa.array(crc, pa.int64()),
                    pa.array(total[row]),
                    group.take(take),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "pack_group"],
            )

    return rows.mapInArrow(run, _PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Sequence and offset of every piece. One shuffle of the pieces' numbers, none of their ids."""

    def place(group: int, tables: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(tables).combine_chunks()
        spots = np.array(best_fit(table.column("length").to_pylist(), capacity), np.int64).reshape(-1, 2)
        table = table.drop_columns(["pack_group"])
        table = table.append_column("sequence_id", pa.array(spots[:, 0] + (group << 32)))
        return table.append_column("offset", pa.array(spots[:, 1])).to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:  # sorted by group
            keys = batch.column("pack_group").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if held and keys[a] != group:
                    yield place(group, held)
                    held = []
                group = int(keys[a])
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
        if held:
            yield place(group, held)

    order = ["pack_group", F.col("length").desc(), F.col("doc_id").asc_nulls_first(), "start", "ids_crc32"]
    return pieces.repartition("pack_group").sortWithinPartitions(*order).mapInArrow(run, _PACKED)
