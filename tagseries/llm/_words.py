"""Words of whole batches: runs of digits, ASCII letters in lower case, and bytes of other letters."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, starts, ends, first): all words and, per text, the number of its first one (n + 1)."""
    data = _LOWER[data]
    n = len(data)
    word = _WORD[data]
    border = np.zeros(n + 1, bool)
    border[at] = True
    start, stop = word.copy(), np.ones(n + 1, bool)
    start[1:] &= ~word[:-1] | border[1:n]
    stop[1:n] = ~word[1:] | border[1:n]
    begin = np.flatnonzero(start)
    return data, begin, np.flatnonzero(stop[1:] & word) + 1, np.searchsorted(begin, at)
