"""License scan: exact containment join of text blocks with license templates.

Words are runs of digits, letters a-z (A-Z in lower case) and characters beyond ASCII. Text blocks follow the length of a
template, w words: windows of w words and a quarter, one beginning every quarter of w, so any w words in a row lie in
some block and little else does. A block meets a template of its length if it holds at least the share ``CONTAINED``
of the template's distinct words.

The words of all templates are ordered by the number of documents of the whole corpus that hold them, rarest first.
With o = ceil(CONTAINED * |T|), a block that meets T must hold one of T's first |T| - o + 1 words (prefix filter), at
least o words of any template (length filter), and behind the first word it shares enough words must be left in both
(positional filter). What passes is compared word by word, so the result is exact. Templates are a bounded parameter
and are sent to every task with their order; documents are read twice (order, then join) and never shuffled.

``blocks`` returns the join: one row per document, block and template met. ``scan`` sums it up by document.

Base places are where the words of a base phrase stand consecutively. The labels of a document are those of its base
places and of the templates met. Score: the largest containment of any template met, at least ``PHRASE`` if there is
a base place, else 0. Null text is empty: no words, no labels, score 0. Repeated rows are scanned each. Words equally
frequent go by their hash, which changes no result. No documents: no rows. Other columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._batch import buffer, pieces, prefix_hash, span_hash
from ._words import word_spans

CONTAINED = 0.9
PHRASE = 0.75

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Sentences of public licenses and notices, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("proprietary", "All rights reserved. No part of this work may be reproduced"),
)

_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of each text's first word)."""
    data, at = buffer(column)
    data, begin, ends, first = word_spans(data, at)
    return span_hash(prefix_hash(data), begin, ends), first


def _text_words(text: str) -> list[int]:
    return [int(h) for h in _spans(pa.array([text]))[0]]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[int, ...]  # ranks in the global order, rarest first
    need: int
    length: int  # of the whole text, in words


def window(length: int) -> tuple[int, int]:
    """(words from block to block, words of a block) for templates of a length."""
    step = max(1, length // 4)
    return step, length + step


class Templates:
    """Words of all templates, and the templates once the order of the words is known."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, contained: float = CONTAINED):
        self.texts = tuple(templates)
        self.sets = [(label, sorted(set(_text_words(text))), len(_text_words(text))) for label, text in templates]
        self.contained = contained
        self.phrases = [(_text_words(text), label) for text, label in phrases]
        every = {w for _, words, _ in self.sets for w in words} | {w for words, _ in self.phrases for w in words}
        self.words = np.array(sorted(every), np.uint64)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of template words, their numbers)."""
        at = np.flatnonzero(self.maybe[(words >> np.uint64(48)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.words, words[at]), len(self.words) - 1)
        hit = self.words[number] == words[at]
        return at[hit], number[hit]

    def order(self, frequency: dict[int, int]) -> None:
        """Rank the words, rarest first; ties go by hash."""
        by = sorted(range(len(self.words)), key=lambda i: (frequency.get(i, 0), int(self.words[i])))
        self.rank = np.zeros(len(by), np.int64)
        self.rank[by] = np.arange(len(by))
        number = {int(w): i for i, w in enumerate(self.words)}
        self.templates = []
        self.postings: dict[int, dict[int, list[tuple[int, int]]]] = {}  # by length of template, then by word
        for label, words, length in self.sets:
            ranks = tuple(sorted(int(self.rank[number[w]]) for w in words))
            need = max(1, math.ceil(self.contained * len(ranks) - 1e-9))
            postings = self.postings.setdefault(length, {})
            for place, word in enumerate(ranks[: len(ranks) - need + 1]):
                postings.setdefault(word, []).append((len(self.templates), place))
            self.templates.append(Template(label, ranks, need, length))
        self.prefix = {length: np.zeros(len(by) + 1, bool) for length in self.postings}
        for length, postings in self.postings.items():
            self.prefix[length][list(postings)] = True

    def met(self, block: np.ndarray, length: int) -> list[tuple[int, float]]:
        """Templates of a length that a block meets, and their containment. ``block``: its distinct ranks, rarest first."""
        out, held = [], set(block.tolist())
        tried: set[int] = set()
        for j, word in enumerate(block.tolist()):
            for t, i in self.postings[length].get(word, ()):
                template = self.templates[t]
                if t in tried:
                    continue
                tried.add(t)
                n = len(template.words)
                if len(block) < template.need or 1 + min(n - i - 1, len(block) - j - 1) < template.need:
                    continue
                share = sum(w in held for w in template.words)
                if share >= template.need:
                    out.append((t, share / n))
        return out

    def join(self, words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, first word and end of the block in it, template, containment) of all blocks that meet a template."""
        at, number = self.places(words)
        rank = self.rank[number]
        doc = np.searchsorted(first, at, side="right") - 1
        out = []
        for length in self.postings:
            step, size = window(length)
            hit = self.prefix[length][rank]
            last = (at[hit] - first[doc[hit]]) // step  # the last block a word lies in; those before reach it too
            back = np.arange(-(-size // step))
            pairs = np.stack([np.repeat(doc[hit], len(back)), (last[:, None] - back).ravel()], 1)
            pairs = np.unique(pairs[pairs[:, 1] >= 0], axis=0)
            low = first[pairs[:, 0]] + pairs[:, 1] * step
            high = np.minimum(low + size, first[pairs[:, 0] + 1])
            for d, a, b, i, j in zip(pairs[:, 0].tolist(), low.tolist(), high.tolist(), *np.searchsorted(at, [low, high]).tolist(), strict=True):
                found = self.met(np.unique(rank[i:j]), length)
                out += [(d, a - int(first[d]), b - int(first[d]), t, share) for t, share in found]
        return out


def word_frequencies(docs: DataFrame, templates: Templates) -> dict[int, int]:
    """Number of documents that hold each template word, over the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(templates.words), np.int64)
        for batch in pieces(batches, "text"):
            words, first = _spans(batch.column("text"))
            at, number = templates.places(words)
            doc = np.searchsorted(first, at, side="right")
            total += np.bincount(np.unique(doc * len(total) + number) % len(total), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {row["word"]: row["n"] for row in counts.collect()}  # one row per template word


def _prepared(
    docs: DataFrame, templates: Templates | None, text: str, key: str
) -> tuple[DataFrame, Broadcast[Templates]]:
    """(doc_id and text, the templates in the corpus's order of words, sent to all tasks)."""
    templates = templates or Templates()
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    templates.order(word_frequencies(rows, templates))
    return rows, docs.sparkSession.sparkContext.broadcast(templates)


def blocks(
    docs: DataFrame, templates: Templates | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, begin_word, end_word (exclusive), label, template (its text) and containment of every block and template
    that meet."""
    rows, sent = _prepared(docs, templates, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = sent.value.join(*_spans(batch.column("text")))
            d, begin, end, t, share = zip(*found, strict=True) if found else ([],) * 5
            texts = [sent.value.texts[i] for i in t]
            columns = [batch.column("doc_id").take(pa.array(d, pa.int64())), pa.array(begin, pa.int64())]
            columns += [pa.array(end, pa.int64()), *(pa.array([x[i] for x in texts], pa.string()) for i in (0, 1))]
            names = ["doc_id", "begin_word", "end_word", "label", "template", "containment"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(share, pa.float64())], names)

    schema = "doc_id long, begin_word long, end_word long, label string, template string, containment double"
    return rows.mapInArrow(run, schema)


def scan(
    docs: DataFrame, templates: Templates | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Base places, labels and score of every document."""
    rows, sent = _prepared(docs, templates, text, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            yield _scan(batch, sent.value)

    return rows.mapInArrow(run, _SCHEMA)


def _scan(batch: pa.RecordBatch, templates: Templates) -> pa.RecordBatch:
    words, first = _spans(batch.column("text"))
    docs = batch.num_rows
    n_words = np.diff(first)
    base: list[list[tuple[int, str]]] = [[] for _ in range(docs)]
    for phrase, label in templates.phrases:
        at = np.flatnonzero(words[: len(words) - len(phrase) + 1] == np.uint64(phrase[0]))
        for i, w in enumerate(phrase):
            at = at[words[at + i] == np.uint64(w)]
        doc = np.searchsorted(first, at, side="right") - 1
        inside = at + len(phrase) <= first[doc + 1]
        for d, a in zip(doc[inside].tolist(), (at - first[doc])[inside].tolist(), strict=True):
            base[d].append((a, label))
    met: list[dict[int, float]] = [{} for _ in range(docs)]
    for d, _, _, t, share in templates.join(words, first):
        met[d][t] = max(share, met[d].get(t, 0.0))
    label = lambda names: ",".join(sorted(set(names)))
    own = [label(x for _, x in b) for b in base]
    every = [label([x for _, x in b] + [templates.templates[t].label for t in m]) for b, m in zip(base, met, strict=True)]
    score = [max([PHRASE if b else 0.0, *m.values()]) for b, m in zip(base, met, strict=True)]
    columns = [
        batch.column("doc_id"),
        pa.array(n_words),
        pa.array([len(b) for b in base], pa.int64()),
        pa.array([min(b)[0] if b else None for b in base], pa.int64()),
        pa.array([max(b)[0] if b else None for b in base], pa.int64()),
        pa.array(own, pa.string()),
        pa.array(every, pa.string()),
        pa.array(score, pa.float64()),
    ]
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return pa.RecordBatch.from_arrays(columns, names)
