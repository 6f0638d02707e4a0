"""Alignment of two tokenizers: which tokens of one cover which of the other, in groups that both end together.

Both tokenizers cut the same bytes, a space and the text, so tokens have byte ranges in one numbering. Per batch, one
``pandas.merge_asof`` keyed by document finds for each token's start the other side's covering token, in both
directions; their union is every overlapping pair. Overlapping tokens with equal ends close a group: the tokens of both
sides since the last common end. Links are all pairs of a group.

How many documents hold an id pair linked is counted over the corpus. Documents are worked on in blocks of at most
``BLOCK`` bytes; a block keeps a dictionary of its distinct pairs, and only dictionaries are shuffled: one row per block
and pair, never one per document and link. A frequent pair has one row per block. Counts come back to the blocks, which
were written once with the tokens' links, and each block is finished by itself.

A text takes no part (zeros, empty digest) if it is null or empty, or if either side's joined token bytes are not the
space and the text. Special tokens' strings are plain text. Every row counts as a document, also rows with the same
or no doc_id. Texts of any length are whole: a long one is a block of its own, its links are reduced in slices. Equal
counts of an id's partners all are best. No documents: no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import CHUNK, buffer, pieces, ragged, release
from ._chunks import flat_ids, spaced
from ._pretokens import pretokens
from ._subwords import Memo
from ._tables import stored

#: Bytes of text that share a dictionary of pairs.
BLOCK = 8 << 20
#: Links that are spread out at once.
SLICE = 2_000_000
#: Distinct strings a worker remembers per tokenizer.
MEMO = 600_000


class Side:
    """A tokenizer: ids of a batch, and the bytes of every id."""

    def __init__(self, entries: list[bytes], memo: Memo, cut):
        self.memo, self.cut, self.size = memo, cut, len(entries)
        self.length = np.array([len(e) for e in entries], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.names = pa.array([str(i) for i in range(len(entries))])

    def tokens(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first: offsets of each text's ids, fits: whether a text's token bytes are its bytes)."""
        ids, first = flat_ids(self.cut(data, at), self.memo)
        length = self.length[ids]
        ends = np.concatenate(([0], np.cumsum(length)))
        fits = np.diff(ends[first]) == np.diff(at)
        if not fits.all():  # elsewhere the bytes cannot be compared place by place
            keep = np.repeat(fits, np.diff(first))
            same = self._same(ids[keep], data[np.repeat(fits, np.diff(at))])
            size = np.diff(at)[fits]
        else:
            same, size = self._same(ids, data), np.diff(at)
        wrong = np.concatenate(([0], np.cumsum(~same)))
        edge = np.concatenate(([0], np.cumsum(size)))
        fits[fits] = wrong[edge[1:]] == wrong[edge[:-1]]
        return ids.astype(np.int64), first, fits

    def _same(self, ids: np.ndarray, data: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        return self.bytes[np.repeat(self.begin[ids], length) + ragged(length)] == data


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows 255."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(moved)}


@lru_cache(maxsize=2)
def byte_side(spec: str) -> Side:
    """A byte-level vocabulary of the tokenizers library, given by its file's content."""
    from tokenizers import Tokenizer

    tokenizer, byte = Tokenizer.from_str(spec), _byte_of()
    tokenizer.encode_special_tokens = True
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    added = {t["content"] for t in json.loads(spec)["added_tokens"]}
    entries = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        entries[i] = token.encode() if token in added else bytes(byte[c] for c in token)

    def encode(parts: list[bytes], _: np.ndarray) -> list[list[int]]:
        texts = [p.decode("utf-8", "replace") for p in parts]
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return Side(entries, Memo(encode, MEMO), pretokens)


@lru_cache(maxsize=2)
def piece_side(model: bytes) -> Side:
    """A sentencepiece model without normalization, given by its file's content.

    No piece of it goes on with a space after another character, so a text may be encoded run by run, each run with
    the spaces before it; the model adds the first space of what it is given.
    """
    import sentencepiece

    pieces_of = sentencepiece.SentencePieceProcessor(model_proto=model)
    entries = []
    for i in range(pieces_of.get_piece_size()):
        piece = pieces_of.id_to_piece(i)
        if "▁" in piece.lstrip("▁"):
            raise ValueError("a piece holds a space behind another character")
        entries.append(bytes([int(piece[3:5], 16)]) if pieces_of.is_byte(i) else piece.replace("▁", " ").encode())
    blank = pieces_of.piece_to_id("▁")

    def encode(parts: list[bytes], _: np.ndarray) -> list[list[int]]:
        found = pieces_of.encode([p[1:].decode("utf-8", "replace") for p in parts], num_threads=1)
        return [ids if len(p) > 1 else [blank] for p, ids in zip(parts, found, strict=True)]

    return Side(entries, Memo(encode, MEMO), spaced)


def overlaps(start_a, end_a, doc_a, start_b, end_b, doc_b) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of A tokens, numbers of B tokens) of all overlapping pairs of one numbering of bytes."""
    a = pd.DataFrame({"at": start_a, "doc": doc_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "doc": doc_b, "b": np.arange(len(start_b))})
    over = pd.merge_asof(a, b, on="at", by="doc")
    back = pd.merge_asof(b, a, on="at", by="doc")
    i = np.concatenate([over["a"].to_numpy(), back["a"].to_numpy(np.int64)])
    j = np.concatenate([over["b"].to_numpy(np.int64), back["b"].to_numpy()])
    once = np.ones(len(i), bool)  # tokens that start together were found from both sides
    once[len(a) :] = start_a[i[len(a) :]] != start_b[j[len(a) :]]
    return i[once], j[once]


def _edges(tokens: int, closing: np.ndarray) -> np.ndarray:
    """First token of each group, and their number, given the tokens that close a group (in any order, repeated)."""
    closes = np.zeros(tokens, bool)
    closes[closing] = True
    return np.concatenate(([0], np.flatnonzero(closes) + 1))


def _joined(names: pa.Array, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Decimal ids of each group, comma-joined."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), names.take(pa.array(ids))), ",")


class Block:
    """What the documents of a block leave behind."""

    def __init__(self):
        self.bytes, self.rows, self.parts, self.number = 0, [], [], 0

    def add(self, batch: pa.RecordBatch, a: Side, b: Side) -> None:
        text = batch.column("text")
        empty = pc.equal(pc.fill_null(pc.binary_length(text), 0), 0)
        text = pc.if_else(empty, "", pc.binary_join_element_wise(" ", pc.fill_null(text, ""), ""))
        data, at = buffer(text)
        ids_a, first_a, fits = a.tokens(data, at)
        ids_b, first_b, fits_b = b.tokens(data, at)
        fits &= fits_b & (np.diff(at) > 0)
        n = batch.num_rows
        row = np.flatnonzero(fits)

        def side(s: Side, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
            count = np.where(fits, np.diff(first), 0)
            ids = ids[np.repeat(fits, np.diff(first))]
            doc = np.repeat(np.arange(n), count)
            length = s.length[ids]
            end = np.cumsum(length)  # bytes of the texts that take part, one after another
            return ids, doc, end - length, end, count

        ids_a, doc_a, start_a, end_a, n_a = side(a, ids_a, first_a)
        ids_b, doc_b, start_b, end_b, n_b = side(b, ids_b, first_b)
        i, j = overlaps(start_a, end_a, doc_a, start_b, end_b, doc_b)
        both = end_a[i] == end_b[j]
        edges_a, edges_b = _edges(len(ids_a), i[both]), _edges(len(ids_b), j[both])
        text_of = pc.binary_join_element_wise(_joined(a.names, ids_a, edges_a), _joined(b.names, ids_b, edges_b), "|")
        doc_of = doc_b[edges_b[:-1]]
        n_groups = np.bincount(doc_of, minlength=n)
        edges = np.concatenate(([0], np.cumsum(n_groups[row]))).astype(np.int32)
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), text_of), ";")
        sha = [""] * n
        for r, s in zip(row.tolist(), whole.to_pylist(), strict=True):
            sha[r] = hashlib.sha256(s.encode()).hexdigest()
        own = np.diff(edges_a)
        partners, first_of = np.repeat(np.diff(edges_b), own), np.repeat(edges_b[:-1], own)
        n_links = np.bincount(doc_a, weights=partners, minlength=n).astype(np.int64)
        n_overlaps = np.bincount(doc_a[i], minlength=n)
        self.rows.append((batch.column("doc_id"), n_a, n_b, n_groups, n_links, n_overlaps, sha))
        self._links(doc_a + self.number, ids_a * b.size, partners, first_of, ids_b, a.size * b.size)
        self.bytes += int(at[-1])
        self.number += n

    def _links(self, doc, ids_a, partners, first_b, ids_b, pairs: int) -> None:
        """Distinct (document, pair) of all links with their number, a slice of A tokens at a time."""
        done, total = 0, np.concatenate(([0], np.cumsum(partners)))
        while done < len(doc):
            stop = max(done + 1, int(np.searchsorted(total, total[done] + SLICE, side="right")) - 1)
            part = slice(done, stop)
            own = np.repeat(np.arange(done, stop), partners[part])
            pair = ids_a[own] + ids_b[first_b[own] + ragged(partners[part])]
            self.parts.append(_counted(doc[own], pair, pairs))
            done = stop

    def row(self, name: int) -> pa.RecordBatch:
        doc = np.concatenate([p[0] for p in self.parts] or [np.zeros(0, np.int64)])
        pair = np.concatenate([p[1] for p in self.parts] or [np.zeros(0, np.int64)])
        n = np.concatenate([p[2] for p in self.parts] or [np.zeros(0, np.int64)])
        distinct, index = np.unique(pair, return_inverse=True)
        order = np.lexsort((index, doc))
        doc, index, n = doc[order], index[order], n[order]
        if len(doc):  # a document whose links came in several slices
            new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(index) != 0)))
            n = np.add.reduceat(n, np.flatnonzero(new))
            doc, index = doc[new], index[new]
        edges = np.searchsorted(doc, np.arange(self.number + 1))
        held = np.bincount(index, minlength=len(distinct))
        ids = pa.chunked_array([r[0] for r in self.rows]).combine_chunks()
        counts = [np.concatenate([r[c] for r in self.rows]).astype(np.int64) for c in range(1, 6)]
        digests = [s for r in self.rows for s in r[6]]

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        columns = [pa.array([name], pa.int64()), one(ids), *(one(pa.array(c)) for c in counts)]
        columns += [one(pa.array(digests, pa.string())), one(pa.array(distinct)), one(pa.array(held.astype(np.int64)))]
        columns += [pa.array([_squeezed(x)], pa.binary()) for x in (edges, index, n)]
        return pa.RecordBatch.from_arrays(columns, _BLOCK_NAMES)


_ROW = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256"]
_BLOCK_NAMES = ["block", *_ROW, "pair", "held", "edges", "entry", "times"]
_BLOCKS = "block long, doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in _ROW[1:6])
_BLOCKS += ", groups_sha256 array<string>, pair array<long>, held array<long>, edges binary, entry binary, times binary"
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, "
    "n_best long, count_sum long"
)


def _counted(doc: np.ndarray, pair: np.ndarray, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair), ascending, with their numbers; a pair is a number below ``pairs``."""
    key = np.sort(doc * pairs + pair)  # a block's documents times two vocabularies stay far below 2**63
    at = np.flatnonzero(np.append(True, np.diff(key) != 0)[: len(key)])
    doc, pair = np.divmod(key[at], pairs)
    return doc, pair, np.diff(np.append(at, len(key)))


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers as differences, byte planes apart, compressed."""
    planes = np.diff(x.astype(np.int64), prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T
    raw = np.ascontiguousarray(planes).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _spread(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view("<i8").ravel())


def blocks(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per block: its documents' numbers, its dictionary of id pairs and each document's links in it."""
    with open(byte_file, encoding="utf-8") as f, open(piece_file, "rb") as g:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_side(sent.value[0]), piece_side(sent.value[1])
        name, block = TaskContext.get().partitionId() << 32, Block()
        for batch in pieces(batches, "text", CHUNK):
            block.add(batch, a, b)
            if block.bytes >= BLOCK:
                yield block.row(name)
                name, block = name + 1, Block()
        if block.number:
            yield block.row(name)
        release()

    return rows.mapInArrow(run, _BLOCKS)


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): documents that hold each id pair, and whether no other pair of its A id has more.

    ``pair`` is the A id times the size of B's vocabulary plus the B id.
    """
    each = blocks.select(F.explode(F.arrays_zip("pair", "held")).alias("p")).select("p.pair", "p.held")
    counted = each.groupBy("pair").agg(F.sum("held").alias("count")).withColumn("a", F.expr(f"pair div {size_b}"))
    most = counted.groupBy("a").agg(F.max("count").alias("most"))
    return counted.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _finished(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Rows of one block's documents, given the counts of its pairs."""
    row = block.to_batches()[0]
    edges, entry, times = (_spread(row.column(c)[0].as_py()) for c in ("edges", "entry", "times"))
    at = counts.column("at").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at], best[at] = counts.column("count").to_numpy(), counts.column("best").to_numpy()
    sums = [np.concatenate(([0], np.cumsum(times * x[entry])))[edges] for x in (best, count)]
    columns = [row.column(c).flatten() for c in _ROW] + [pa.array(np.diff(s)) for s in sums]
    return pa.Table.from_arrays(columns, [*_ROW, "n_best", "count_sum"])


def align(docs: DataFrame, byte_file: str, piece_file: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every document's tokens, groups, links and digest, and how usual its links are in the corpus."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    held = stored(blocks(docs, byte_file, piece_file, text, key))
    used = held.select(F.col("block").alias("of"), F.posexplode("pair").alias("at", "pair"))
    used = used.join(pair_counts(held, size_b), "pair").select("of", "at", "count", "best")
    body = held.select("block", *_ROW, "edges", "entry", "times")
    return body.groupBy("block").cogroup(used.groupBy("of")).applyInArrow(_finished, _RESULT)


def aligned(batch: pa.RecordBatch, a: Side, b: Side) -> list[list[tuple[list[int], list[int]]]]:
    """Groups of each text of a small batch as ids of both sides; empty for texts that take no part."""
    out = []
    for text in batch.column("text").to_pylist():
        data, at = buffer(pa.array([f" {text}" if text else ""]))
        ids_a, _, fits_a = a.tokens(data, at)
        ids_b, _, fits_b = b.tokens(data, at)
        if not text or not (fits_a[0] and fits_b[0]):
            out.append([])
            continue
        end_a, end_b = np.cumsum(a.length[ids_a]), np.cumsum(b.length[ids_b])
        zero_a, zero_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        i, j = overlaps(end_a - a.length[ids_a], end_a, zero_a, end_b - b.length[ids_b], end_b, zero_b)
        common = np.unique(end_a[i[end_a[i] == end_b[j]]])
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        out.append([(ids_a[group_a == g].tolist(), ids_b[group_b == g].tolist()) for g in range(len(common))])
    return out
