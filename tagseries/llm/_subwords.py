"""Token ids of whole batches of texts, with a memo of the pre-tokens a worker has met."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa

from ._batch import CHUNK, buffer, pieces, ragged
from ._pretokens import hashes, pretokens

#: Distinct pre-tokens a worker remembers; beyond, it starts again with those of the batch at hand.
MEMO = 600_000

Encode = Callable[[list[bytes], np.ndarray], list[list[int]]]


class Memo:
    """Ids by the 64-bit hash of a pre-token, kept flat. It saves work and changes no result."""

    def __init__(self, encode: Encode, limit: int = MEMO):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.index, self.recent, self.indexed = pd.Index(self.keys), pd.Index(self.keys), 0
        self.at, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def ids(self, data: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pre-tokens, ids per pre-token)."""
        code, distinct = pd.factorize(hashes(data, begin, ends))
        if len(self.keys) + len(distinct) > self.limit:
            self._clear()
        known = self._known(distinct)
        new = np.flatnonzero(known < 0)
        if len(new):
            seen = np.empty(len(distinct), np.int64)
            seen[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            raw, spans = data.tobytes(), seen[new]
            parts = [raw[a:b] for a, b in zip(begin[spans].tolist(), ends[spans].tolist(), strict=True)]
            flat, count = self.encoded(parts, distinct[new])
            known[new] = len(self.keys) + np.arange(len(new))
            self.at = np.append(self.at, len(self.flat) + np.cumsum(count) - count)
            self.count = np.append(self.count, count)
            self.flat = np.append(self.flat, flat)
            self.keys = np.append(self.keys, distinct[new])
            if len(self.keys) - self.indexed > self.indexed // 4:  # the large index is built seldom
                self.index, self.indexed = pd.Index(self.keys), len(self.keys)
            self.recent = pd.Index(self.keys[self.indexed :])
        entry = known[code]
        counts = self.count[entry]
        return self.flat[np.repeat(self.at[entry], counts) + ragged(counts)], counts

    def encoded(self, parts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, ids per part)."""
        found = self.encode(parts, keys)
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(count.sum())), count

    def _known(self, distinct: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        known = self.index.get_indexer(pd.Index(distinct))
        left = np.flatnonzero(known < 0)
        if len(left) and len(self.recent):
            later = self.recent.get_indexer(pd.Index(distinct[left]))
            known[left] = np.where(later < 0, -1, later + self.indexed)
        return known


def encoded(
    batches: Iterator[pa.RecordBatch], text: str, memo: Memo
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, ids of all rows, offsets of each row's ids), piece by piece."""
    for batch in pieces(batches, text, 2 * CHUNK):
        data, begin, ends, first = pretokens(*buffer(batch.column(text)))
        if not len(begin):
            yield batch, np.zeros(0, np.uint32), np.zeros(batch.num_rows + 1, np.int64)
            continue
        ids, counts = memo.ids(data, begin, ends)
        total = np.concatenate(([0], np.cumsum(counts)))
        yield batch, ids, total[first]


@lru_cache(maxsize=4)
def library_memo(spec: str, limit: int = MEMO) -> tuple[object, list[str], Memo]:
    """(tokenizer, its added strings, memo) of a tokenizers file, given by its content; one per worker."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(parts: list[bytes], _: np.ndarray) -> list[list[int]]:
        texts = [p.decode("utf-8") for p in parts]
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return tokenizer, added, Memo(encode, limit)


def library_ids(
    batches: Iterator[pa.RecordBatch], text: str, spec: str, limit: int = MEMO
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """As ``encoded``, with the ids the tokenizers library gives a whole text (a byte-level vocabulary).

    The library encodes each distinct pre-token once per worker. A text that holds one of its added strings, which
    are cut out before the split, is encoded by the library as a whole.
    """
    tokenizer, added, memo = library_memo(spec, limit)
    marks = [a.encode() for a in added if a]
    for batch, ids, at in encoded(batches, text, memo):
        raw = buffer(batch.column(text))[0].tobytes()
        if any(m in raw for m in marks):
            rows = [x or "" for x in batch.column(text).to_pylist()]
            parts = [ids[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
            for i, row in enumerate(rows):
                if any(a in row for a in added if a):
                    parts[i] = np.array(tokenizer.encode(row, add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate(parts).astype(np.uint32)
            at = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        yield batch, ids, at


def with_end(ids: np.ndarray, at: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each row."""
    n = len(at) - 1
    after = at + np.arange(n + 1)
    out = np.full(after[-1], end, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(at))] = ids
    return out, after
