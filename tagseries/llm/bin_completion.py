"""Packing of documents into as few sequences as possible: bin completion, branch and bound over lengths.

Documents of one length are interchangeable, so the search works on the histogram of piece lengths: at most
``CAPACITY`` numbers, whatever the size of the corpus. A step takes the largest length left and completes one bin
around it with an undominated filling; the pattern is used as often as the histogram and the bound on waste allow, or
once. A branch ends when its waste, or the lower bound on the bins its rest needs, leaves no room for fewer bins than
the incumbent. Incumbents are best-fit-decreasing packings, of the whole and of what is left at nodes on the way. The
search ends when the incumbent meets the lower bound, all branches are closed, or after ``NODES`` nodes: then the
incumbent stands, a valid packing that is at least as good as best fit.

A filling dominates another if the other's pieces fit into the places of its own. A piece that fills the room exactly
dominates all; a filling that leaves room for a further piece is dominated by the one with it.

The result is a plan: patterns with the number of sequences of each. It has a few entries per distinct length, so its
size has a bound that does not depend on the corpus, and it is sent to all tasks. Pieces find their places by their
number among those of their length: each writing task numbers its own, and counts of (task, length) say how many come
before. So the whole corpus is packed as one, no group of documents meets in one task and copies are no skew.

Longer documents are cut into windows of the capacity and a rest. Null or empty text: one piece with the end id.
Repeated rows and null doc_ids are packed each like any other. No documents: no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._batch import CHUNK, buffer, pieces, ragged
from ._chunks import flat_ids, words
from ._subwords import Memo, with_end
from ._tables import stored

CAPACITY = 2048
#: Nodes after which the search rests with its incumbent.
NODES = 3000
#: Fillings that a node keeps, and steps it looks for them.
WIDTH, STEPS = 12, 600
#: Nodes between two incumbents.
EVERY = 50
#: Distinct strings a worker remembers.
MEMO = 1_500_000

Pattern = tuple[tuple[int, int], ...]  # (length, pieces of it), longest first
Plan = list[tuple[Pattern, int]]  # with the number of bins


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit decreasing on a histogram of lengths: bins of one pattern stay together."""
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[Pattern, int]]] = {}
    full: Plan = []

    def put(pattern: Pattern, room: int, n: int) -> None:
        if room == 0:
            full.append((pattern, n))
            return
        if not open_bins.get(room):
            insort(rooms, room)
        open_bins.setdefault(room, []).append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                pattern, room, n = (), capacity, -(-left // (capacity // length))
            else:
                room = rooms[at]
                pattern, n = open_bins[room].pop()
                if not open_bins[room]:
                    del rooms[at]
            each = room // length
            whole, rest = divmod(left, each)
            whole = min(whole, n)
            rest = rest if whole < n and whole * each < left else 0
            if whole:
                put((*pattern, (length, each)), room - each * length, whole)
            if rest:
                put((*pattern, (length, rest)), room - rest * length, 1)
            if n > whole + bool(rest):
                put(pattern, room, n - whole - bool(rest))
            left -= whole * each + rest
    return full + [x for room in rooms for x in open_bins[room]]


def bins(plan: Plan) -> int:
    return sum(n for _, n in plan)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: pieces over half the capacity share none, and large ones leave no room for others."""
    if not counts:
        return 0
    number = np.zeros(capacity + 2, np.int64)
    number[list(counts)] = list(counts.values())
    many = np.concatenate(([0], np.cumsum(number)))  # many[x]: pieces shorter than x
    size = np.concatenate(([0], np.cumsum(number * np.arange(capacity + 2))))
    half = capacity // 2
    k = np.arange(1, half + 1)
    top = many[-1] - many[capacity - k + 1]  # longer than capacity - k
    mid = many[capacity - k + 1] - many[half + 1]
    mid_size = size[capacity - k + 1] - size[half + 1]
    low_size = size[half + 1] - size[k]
    more = np.maximum(0, -(-(low_size - (mid * capacity - mid_size)) // capacity))
    return int(max((top + mid + more).max() if half else 0, -(-size[-1] // capacity)))


def _fits(small: list[int], places: list[int]) -> bool:
    """Whether pieces, longest first, can be dealt into places."""
    if not small:
        return True
    tried = set()
    for i, place in enumerate(places):
        if place >= small[0] and place not in tried:
            tried.add(place)
            if _fits(small[1:], [*places[:i], place - small[0], *places[i + 1 :]]):
                return True
    return False


def _dominates(a: list[int], b: list[int]) -> bool:
    if len(a) + len(b) <= 10:
        return _fits(b, a)
    return len(b) <= len(a) and all(x >= y for x, y in zip(a, b, strict=False))


def fillings(
    counts: dict[int, int], room: int, waste: int, width: int = WIDTH, steps: int = STEPS
) -> tuple[list[Pattern], bool]:
    """(undominated fillings of a room that waste at most so much, least waste first; whether these are all).

    ``counts`` has what is left for it. The longest pieces are tried first; a piece that fills the rest exactly ends a
    branch, as it dominates what else would.
    """
    if counts.get(room):
        return [((room, 1),)], True
    lengths = sorted((x for x, n in counts.items() if n and x <= room), reverse=True)
    below = [0] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        below[i] = below[i + 1] + lengths[i] * counts[lengths[i]]
    found: list[list[int]] = []
    left, whole = steps, True

    def look(first: int, rest: int, taken: list[int]) -> None:
        nonlocal left, whole
        left -= 1
        if left <= 0 or len(found) >= width:
            whole = False
            return
        used = taken.count(rest)
        if counts.get(rest, 0) > used and (not taken or rest <= taken[-1]):
            found.append([*taken, rest])
            return
        alone = True
        for i in range(first, len(lengths)):
            x = lengths[i]
            if x > rest or counts[x] <= taken.count(x):
                continue
            alone = False
            if below[i] < rest - waste:
                break
            look(i, rest - x, [*taken, x])
            if left <= 0 or len(found) >= width:
                whole = False
                return
        if alone and rest <= waste:
            found.append(taken)

    look(0, room, [])
    kept: list[list[int]] = []
    for f in sorted(found, key=lambda f: (room - sum(f), len(f), [-x for x in f])):
        if not any(_dominates(g, f) for g in kept):
            kept.append(f)
    out = []
    for f in kept:
        out.append(tuple((x, f.count(x)) for x in sorted(set(f), reverse=True)))
    return out, whole


class _Search:
    def __init__(self, counts: dict[int, int], capacity: int, nodes: int):
        self.counts = {x: n for x, n in counts.items() if n}
        self.capacity, self.left = capacity, nodes
        self.total = sum(x * n for x, n in self.counts.items())
        self.best = best_fit(self.counts, capacity)
        self.bins = bins(self.best)
        self.bound = lower_bound(self.counts, capacity)
        self.proven = True

    def steps(self, used: int, waste: int, path: Plan) -> Iterator[tuple[Pattern, int, int]]:
        """(pattern, times, waste of one) of each branch of a node."""
        self.left -= 1
        if self.left % EVERY == 0:
            rest = best_fit(self.counts, self.capacity)
            if used + bins(rest) < self.bins:
                self.best, self.bins = [*path, *rest], used + bins(rest)
        slack = (self.bins - 1) * self.capacity - self.total - waste
        if slack < 0 or used + lower_bound(self.counts, self.capacity) >= self.bins:
            return
        largest = max(self.counts)
        rest = dict(self.counts)
        rest[largest] -= 1
        found, whole = fillings(rest, self.capacity - largest, slack)
        self.proven &= whole
        for filling in found:
            need = dict(filling)
            need[largest] = need.get(largest, 0) + 1
            lost = self.capacity - sum(x * n for x, n in need.items())
            times = min(self.counts[x] // n for x, n in need.items())
            if lost:
                times = min(times, slack // lost)
            pattern = tuple(sorted(need.items(), reverse=True))
            for t in (times, 1) if times > 1 else (times,):
                if t and (self.bins - 1) * self.capacity - self.total - waste >= t * lost:
                    yield pattern, t, lost

    def change(self, pattern: Pattern, times: int) -> None:
        for x, n in pattern:
            now = self.counts.get(x, 0) + n * times
            if now:
                self.counts[x] = now
            else:
                del self.counts[x]

    def run(self) -> Plan:
        path: Plan = []
        used, waste, stack = 0, 0, []
        if self.counts and self.bins > self.bound:
            stack.append(self.steps(0, 0, path))
        lost_of: list[int] = []
        while stack and self.bins > self.bound:
            if self.left <= 0:
                self.proven = False
                break
            step = next(stack[-1], None)
            if step is None:
                stack.pop()
                if path:
                    pattern, times = path.pop()
                    self.change(pattern, times)
                    used, waste = used - times, waste - times * lost_of.pop()
                continue
            pattern, times, lost = step
            self.change(pattern, -times)
            path.append((pattern, times))
            lost_of.append(lost)
            used, waste = used + times, waste + times * lost
            if not self.counts:
                if used < self.bins:
                    self.best, self.bins = list(path), used
                stack.append(iter(()))
            else:
                stack.append(self.steps(used, waste, path))
        return self.best


def solve(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Patterns and their numbers of bins for a histogram of lengths; none may exceed the capacity."""
    return _Search(counts, capacity, nodes).run()


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class WordMemo(Memo):
    """Ids of words of a vocabulary that marks the last token of each; plain words are encoded many to a text."""

    def __init__(self, tokenizer, limit: int):
        super().__init__(self._each, limit)
        self.tokenizer = tokenizer
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _each(self, parts: list[bytes], _: np.ndarray) -> list[list[int]]:
        texts = [p.decode("utf-8", "replace") for p in parts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(self, parts: list[bytes], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain = np.fromiter(map(bytes.isalpha, parts), bool, len(parts))  # ASCII letters: one word, one last token
        words = [p for p, one in zip(parts, plain.tolist(), strict=True) if one]
        texts = [b" ".join(words[k : k + 500]).decode() for k in range(0, len(words), 500)]
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([*found, np.zeros(0, np.uint32)])
        rest, rest_count = super().encoded([p for p, one in zip(parts, plain.tolist(), strict=True) if not one], keys)
        count = np.empty(len(parts), np.int64)
        count[plain] = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        count[~plain] = rest_count
        begin = np.empty(len(parts), np.int64)
        for which, first in ((plain, 0), (~plain, len(ids))):
            begin[which] = first + np.cumsum(count[which]) - count[which]
        return np.append(ids, rest)[np.repeat(begin, count) + ragged(count)], count


@lru_cache(maxsize=2)
def _memo(spec: str) -> Memo:
    from tokenizers import Tokenizer

    return WordMemo(Tokenizer.from_str(spec), MEMO)


def cut(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Pieces of every document with the checksum of their ids, numbered within task and length.

    ``tokenizer`` is a tokenizers file of lower-case words whose split lets no token hold white space, or a letter and a
    mark: such runs are encoded each on its own, and a worker remembers those it has met.
    """
    with open(tokenizer, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in pieces(batches, "text", 2 * CHUNK):
            ids, at = with_end(*flat_ids(words(*buffer(batch.column("text"))), _memo(sent.value)), end_id)
            total = np.diff(at)
            number = -(-total // capacity)
            row = np.repeat(np.arange(len(total)), number)
            piece = ragged(number)
            start = piece * capacity
            length = np.minimum(total[row] - start, capacity)
            raw, begin = memoryview(ids.astype("<u4").tobytes()), at[row] + start
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            order = np.argsort(length, kind="stable")
            distinct, count = np.unique(length, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = ragged(count) + np.repeat(seen[distinct], count)
            seen[distinct] += count
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(piece, pa.int32()),
                pa.array(start),
                pa.array(length),
                pa.array(crc, pa.int64()),
                pa.array(np.full(len(row), part, np.int32)),
                pa.array(nth),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return rows.mapInArrow(run, _PIECES)


def places(plan: Plan) -> tuple[np.ndarray, ...]:
    """Where the pieces of each length go: key (length, first number), pieces per bin, first sequence, first offset."""
    rows, taken, base = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for length, need in pattern:
            first = taken.get(length, 0)
            rows.append(((length << 48) + first, need, base, offset))
            taken[length] = first + need * times
            offset += need * length
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return tuple(np.ascontiguousarray(table[:, c]) for c in range(4))


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Sequence and offset of every piece of ``cut``, whose rows are written once so that their numbers stay."""
    held = stored(pieces)
    counted = held.groupBy("part", "length").agg(F.count("*").alias("n"))
    lengths = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most one row per length
    plan = solve({r["length"]: r["n"] for r in lengths}, capacity, nodes)
    sent = held.sparkSession.sparkContext.broadcast(places(plan))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, need, base, offset = sent.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("before").to_numpy() + batch.column("nth").to_numpy()
            at = np.searchsorted(key, (length << 48) + number, side="right") - 1
            bin_, place = np.divmod(number - (key[at] & ((1 << 48) - 1)), need[at])
            columns = [*batch.columns[:5], pa.array(base[at] + bin_), pa.array(offset[at] + place * length)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:5], "sequence_id", "offset"])

    order = ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "before"]
    return held.join(before, ["part", "length"]).select(order).mapInArrow(run, _PACKED)
