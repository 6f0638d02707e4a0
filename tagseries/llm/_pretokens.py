"""Byte-level pre-tokens of whole batches: the split before the merges, without a regular expression per text.

The rules are those of the split pattern of byte-level vocabularies (``public_tokenizers.PATTERN``): contractions,
runs of letters, digits or other characters with one leading space, and white space, whose last character goes to
what follows. ``tests/llm`` compares them with the pattern itself and with two tokenizer libraries.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import tiktoken

from ._batch import prefix_hash, span_hash

SPACE, LETTER, DIGIT, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, as the installed libraries' Unicode tables have it."""
    table = np.full(0x110000, OTHER, np.uint8)
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    for value, kind in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (SPACE, r"\s")):
        only = tiktoken.Encoding(f"class{value}", pat_str=kind, mergeable_ranks=single, special_tokens={})
        found = only.decode(only.encode_ordinary(text))  # what the pattern does not match is left out
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = value
    return table


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first): spans of all pre-tokens and, per text, the number of its first one (n + 1)."""
    raw = data.tobytes()
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:  # what is no UTF-8 is read as the replacement character
        fixed = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in fixed]))).astype(np.int64)
        raw = b"".join(fixed)
        data, text = np.frombuffer(raw, np.uint8), raw.decode("utf-8")
    n = len(text)
    if n == 0:
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(len(offsets), np.int64)
    if n == len(raw):
        code, place, doc = data, None, offsets
    else:
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        place = np.zeros(n + 1, np.int64)
        np.cumsum(1 + (code > 0x7F).astype(np.uint8) + (code > 0x7FF) + (code > 0xFFFF), out=place[1:])
        doc = np.searchsorted(place, offsets)
    kind = _classes()[code]
    border = np.zeros(n + 1, bool)  # a text starts here, or the buffer ends
    border[doc] = True
    change = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    change |= border
    start = change[:n].copy()
    space = kind == SPACE
    last = np.zeros(n, bool)  # last white space before something else of the same text
    last[:-1] = space[:-1] & ~space[1:] & ~border[1:n]
    start |= last
    taken = last & (code == 0x20)  # this space goes to what follows
    start[1:] &= ~taken[:-1]
    quote = np.flatnonzero((code == 0x27) & start)
    if len(quote):
        end = doc[np.searchsorted(doc, quote, side="right")]  # of the text it stands in
        one = code[np.minimum(quote + 1, n - 1)]
        two = code[np.minimum(quote + 2, n - 1)]
        short = (quote + 1 < end) & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        pair = one.astype(np.int64) * 256 + two
        long = (quote + 2 < end) & np.isin(pair, [0x7265, 0x7665, 0x6C6C])  # re ve ll
        hit = short | long
        after = quote[hit] + np.where(long[hit], 3, 2)
        start[quote[hit] + 1] = False
        start[after[after < n]] = True
    begin = np.flatnonzero(start)
    first = np.searchsorted(begin, doc)
    if place is not None:
        begin = place[begin]
    ends = np.append(begin[1:], len(raw))
    return data, begin, ends, first


def hashes(data: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), begin, ends)
