"""Spans of whole batches of texts that a tokenizer may encode one by one."""

from __future__ import annotations

import numpy as np

from ._subwords import Memo

Spans = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _spans(data: np.ndarray, at: np.ndarray, start: np.ndarray, inside: np.ndarray) -> Spans:
    """(bytes, starts, ends, first) of the runs of ``inside`` bytes that begin at ``start`` ones."""
    begin = np.flatnonzero(start & inside)
    stop = np.append(start | ~inside, True)
    stop[at] = True
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, begin, side="right")]
    return data, begin, ends, np.searchsorted(begin, at)


def chunks(data: np.ndarray, at: np.ndarray) -> Spans:
    """Runs of bytes other than white space."""
    inside = ~_BLANK[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edge = at[at < len(data)]
    start[edge] = True
    return _spans(data, at, start, inside)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: ASCII marks other than the apostrophe, which may open a contraction.
_MARK = np.zeros(256, bool)
_MARK[0x21:0x7F] = True
_MARK[[*range(0x30, 0x3A), 0x27]] = False
_MARK &= ~_LETTER


def _holding(found: np.ndarray, at: np.ndarray) -> np.ndarray | None:
    """Per byte, whether its text holds any of the places found; None if there are no such texts."""
    place = np.flatnonzero(found)
    if not len(place):
        return None
    holds = np.zeros(len(at) - 1, bool)
    holds[np.searchsorted(at, place, side="right") - 1] = True
    return np.repeat(holds, np.diff(at))


def words(data: np.ndarray, at: np.ndarray) -> Spans:
    """As ``chunks``, finer and in lower case, for a vocabulary of lower-case words that ends a token between an ASCII
    letter and a mark. Fewer of them are distinct.

    Kept as they are: texts with a ``<|``, which may open a special token, and the case of texts with combining
    marks, as some letters have a composed form in lower case only.
    """
    special = np.zeros(len(data), bool)
    special[:-1] = (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    special = _holding(special, at)
    marked = _holding((data == 0xCC) | (data == 0xCD), at)
    lower = _LOWER[data]
    for keep in (special, marked):
        if keep is not None:
            lower = np.where(keep, data, lower)
    inside, letter, mark = ~_BLANK[data], _LETTER[data], _MARK[data]
    cut = (letter[1:] & mark[:-1]) | (mark[1:] & letter[:-1])
    if special is not None:
        cut &= ~special[1:]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut
    start[at[at < len(data)]] = True
    return _spans(lower, at, start, inside)


def spaced(data: np.ndarray, at: np.ndarray) -> Spans:
    """The whole texts, cut before each run of spaces."""
    space = data == 0x20
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[at[at < len(data)]] = True
    return _spans(data, at, start, np.ones(len(data), bool))


def flat_ids(spans: Spans, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets of each text's ids)."""
    data, begin, ends, first = spans
    if not len(begin):
        return np.zeros(0, np.uint32), np.zeros(len(first), np.int64)
    ids, counts = memo.ids(data, begin, ends)
    return ids, np.concatenate(([0], np.cumsum(counts)))[first]
