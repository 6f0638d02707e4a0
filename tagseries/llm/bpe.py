"""Byte-level BPE encoding and decoding with two tiers.

Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are words of it. Tier two: what the
hash does not confirm is merged byte by byte, a heap giving the lowest rank and linked parts giving the neighbours.

A text is split by the byte-level pattern; nothing is treated as a special token. Null text is empty; an empty text
has no ids; repeated rows are encoded each; other columns are kept unless one is called ``ids`` (it is replaced).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ._batch import binary, buffer, mix, pieces, prefix_hash, ragged, span_hash
from ._subwords import Memo, encoded

_U = np.uint64


def read_ranks(path: str) -> list[bytes]:
    """Words of a rank file, by rank. Ranks must be 0..n-1 and hold every single byte."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    words: list[bytes] = [b""] * len(pairs)
    for word, rank in pairs:
        words[int(rank)] = base64.b64decode(word)
    if not all(words) or not {bytes([b]) for b in range(256)} <= set(words):
        raise ValueError("the rank file has gaps or lacks single bytes")
    return words


class PerfectHash:
    """Minimal perfect hash: buckets displaced one after another, largest first, so that n words fill n slots.

    ``find`` gives a slot for any hash; only the caller's comparison tells whether the word is the one stored there.
    """

    def __init__(self, hashes: np.ndarray, per_bucket: int = 2):
        n = len(hashes)
        self.n, self.buckets = n, max(1, -(-n // per_bucket))
        bucket = (hashes % _U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        size = np.bincount(bucket, minlength=self.buckets)
        begin = np.cumsum(size) - size
        self.shift = np.zeros(self.buckets, np.int64)
        self.slot = np.full(n, -1, np.int64)  # word in each slot
        taken = np.zeros(n, bool)
        for k in range(int(size.max(initial=0)), 1, -1):  # all buckets of one size try the same shift at a time
            left, shift = np.flatnonzero(size == k), 0
            words = order[begin[left][:, None] + np.arange(k)]
            while len(left):
                places = self._place(hashes[words], np.full((len(left), 1), shift))
                claims = np.bincount(places.ravel(), minlength=n)
                ok = ((claims[places] == 1) & ~taken[places]).all(1)
                self.shift[left[ok]], self.slot[places[ok]] = shift, words[ok]
                taken[places[ok]] = True
                left, words, shift = left[~ok], words[~ok], shift + 1
        alone, free = np.flatnonzero(size == 1), np.flatnonzero(~taken)  # as many slots as lone words
        self.slot[free], self.shift[alone] = order[begin[alone]], -free - 1

    def _place(self, hashes: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(hashes ^ (shift.astype(_U) * _U(0xD6E8FEB86659FD93))) % _U(self.n)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the only word that can have each hash."""
        shift = self.shift[(hashes % _U(self.buckets)).astype(np.int64)]
        return self.slot[np.where(shift < 0, -shift - 1, self._place(hashes, np.maximum(shift, 0)))]


def merge(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always the pair of lowest rank, the leftmost of equal ones, until none is a word.

    Parts are linked by their ends; a heap entry is stale if a part it names has since grown or gone.
    """
    n = len(piece)
    end = list(range(1, n + 1))  # end of the part that begins here; 0 once it is part of another
    before = list(range(-1, n))  # begin of the part that ends where this one begins
    heap = []
    for i in range(n - 1):
        r = rank.get(piece[i : i + 2])
        if r is not None:
            heap.append((r, i, i + 1, i + 2))
    heapq.heapify(heap)
    while heap:
        _, a, b, c = heapq.heappop(heap)
        if end[a] != b or b >= n or end[b] != c:
            continue
        end[a], end[b] = c, 0
        if c < n:
            before[c] = a
            r = rank.get(piece[a : end[c]])
            if r is not None:
                heapq.heappush(heap, (r, a, c, end[c]))
        if a:
            p = before[a]
            r = rank.get(piece[p:c])
            if r is not None:
                heapq.heappush(heap, (r, p, a, c))
    out, i = [], 0
    while i < n:
        out.append(rank[piece[i : end[i]]])
        i = end[i]
    return out


def words_hash(words: list[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return span_hash(prefix_hash(data), np.append(0, ends[:-1]), ends)


class Vocabulary:
    """Words by rank, with both tiers; small enough to send to every executor once."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.hash = PerfectHash(words_hash(words))
        self.key = f"{len(words)}-{int(np.bitwise_xor.reduce(mix(words_hash(words) + np.arange(len(words), dtype=_U))))}"

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return _loaded(path)

    def memo(self) -> Memo:
        if self.key not in _memos:
            _memos[self.key] = Memo(_Tiers(self))
        return _memos[self.key]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all rows, offsets of each row's bytes) for the ids of all rows."""
        size = np.array([len(w) for w in self.words], np.int64)
        data = np.frombuffer(b"".join(self.words), np.uint8)
        begin = np.cumsum(size) - size
        count = size[ids]
        total = np.concatenate(([0], np.cumsum(count)))
        return data[np.repeat(begin[ids], count) + ragged(count)].tobytes(), total[at]


_memos: dict[str, Memo] = {}


@lru_cache(maxsize=4)
def _loaded(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


class _Tiers:
    def __init__(self, vocabulary: Vocabulary):
        self.words, self.hash = vocabulary.words, vocabulary.hash
        self.rank = {w: i for i, w in enumerate(vocabulary.words)}

    def __call__(self, parts: list[bytes], hashes: np.ndarray) -> list[list[int]]:
        words, rank = self.words, self.rank
        slots = self.hash.find(hashes).tolist()
        return [[s] if words[s] == p else merge(p, rank) for p, s in zip(parts, slots, strict=True)]


def _schema(df: DataFrame, name: str) -> StructType:
    return StructType([f for f in df.schema.fields if f.name != name] + [StructField(name, BinaryType())])


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in keep] + [column], [batch.schema.names[i] for i in keep] + [name]
    )


def encode(df: DataFrame, ranks: str, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Each row's ids as little-endian unsigned 32-bit integers in column ``ids``.

    ``ranks`` is a file the driver reads. No shuffle: every row is encoded where it is read.
    """
    sent = df.sparkSession.sparkContext.broadcast(Vocabulary.load(ranks))
    schema = _schema(df, "ids")
    if not keep_text:
        schema = StructType([f for f in schema.fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids, at in encoded(batches, text, sent.value.memo()):
            out = _with(batch, "ids", binary(ids.astype("<u4"), at * 4))
            yield out if keep_text else out.select([n for n in out.schema.names if n != text])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ranks: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Each row's bytes in column ``to``, from ids as ``encode`` writes them. Null ids give no bytes."""
    sent = df.sparkSession.sparkContext.broadcast(Vocabulary.load(ranks))
    schema = _schema(df, to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ids):
            data, at = buffer(batch.column(ids))
            yield _with(batch, to, binary(*sent.value.decode(np.frombuffer(data.tobytes(), "<u4"), at // 4)))

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks: str) -> DataFrame:
    """Number of ids and digests of ids and decoded bytes per document."""
    coded = encode(docs.select("doc_id", "text"), ranks)
    return decode(coded, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
