"""Toxicity by a classifier chain of linear models over word and word-beginning features.

Categories are predicted one after another: each model sees the text's features and the probabilities of all earlier
categories. For training, those are out-of-fold: every labelled row gets them from models fitted without its fold, so
a later model learns to use probabilities of the quality it will meet. A text's features are its distinct words and
the beginnings of 3 to 6 bytes of its longer words (words of invented or inflected endings share a beginning), hashed
to 64 bits. For each model the ``FEATURES`` ones that tell the category best on its training rows are kept.

The fit uses at most ``SAMPLE`` labelled rows per value of the main label (least hash of doc_id first; the bound keeps
the fit in one task). Everything else covers all rows. No labelled rows, or only one value of a label, give a constant
probability: 0 without positives, 1 without negatives. Null or empty text has no features and gets the models' bias.
Labels are per doc_id: repeated rows count once, before the sample is drawn, rows without doc_id or label not at all.
Where rows of one doc_id differ, any that says low quality or toxic counts, and of the texts the greatest. No documents:
no rows. A document column named like a new one is no obstacle to ``accepted``, in whatever case; ``annotate`` refuses it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ._batch import buffer, pieces, prefix_hash, span_hash
from ._words import word_spans

#: Labelled rows per value of the main label that the fit may use.
SAMPLE = 4_000
#: Features per model.
FEATURES = 1_500
FOLDS = 4
STEPS, RIDGE = 80, 1e-4
#: Sample rows that must hold a feature, and least deviation of its positives from chance, in standard deviations.
SUPPORT, WORTH = 4, 5.0
BEGINNINGS = (3, 4, 5, 6)
#: Probability from which a category holds.
THRESHOLD = 0.5

_U = np.uint64


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash) of every word and word beginning; repeats are not removed."""
    lower = pa.array([None if t is None else t.lower() for t in column.to_pylist()], pa.string())
    data, at = buffer(lower)
    data, begin, ends, first = word_spans(data, at)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(first))
    prefix = prefix_hash(data)
    docs, found = [doc], [span_hash(prefix, begin, ends)]
    for k in BEGINNINGS:
        long = np.flatnonzero(ends - begin > k)
        docs.append(doc[long])
        found.append(span_hash(prefix, begin[long], begin[long] + k) ^ _U(k))
    return np.concatenate(docs), np.concatenate(found)


@dataclass
class Link:
    """One model of the chain."""

    keys: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float
    earlier: np.ndarray  # weights of the earlier categories' log odds


@dataclass
class Chain:
    categories: tuple[str, ...]
    links: list[Link]

    def __post_init__(self) -> None:
        self.keys = np.unique(np.concatenate([l.keys for l in self.links] + [np.zeros(0, _U)]))
        self.weights = np.zeros((len(self.keys), len(self.links)))
        for c, link in enumerate(self.links):
            self.weights[np.searchsorted(self.keys, link.keys), c] = link.weights
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> _U(44)).astype(np.int64)] = True

    def probabilities(self, column: pa.Array) -> np.ndarray:
        """(texts, categories)."""
        doc, found = features(column)
        margin = np.zeros((len(column), len(self.links)))
        at = np.flatnonzero(self.maybe[(found >> _U(44)).astype(np.int64)])
        if len(at) and len(self.keys):
            number = np.minimum(np.searchsorted(self.keys, found[at]), len(self.keys) - 1)
            hit = self.keys[number] == found[at]
            pair = np.unique(doc[at[hit]] * len(self.keys) + number[hit])
            row, feature = np.divmod(pair, len(self.keys))
            for c in range(len(self.links)):
                margin[:, c] = np.bincount(row, weights=self.weights[feature, c], minlength=len(column))
        odds = np.zeros_like(margin)
        for c, link in enumerate(self.links):
            odds[:, c] = np.clip(margin[:, c] + link.bias + odds[:, :c] @ link.earlier, -30, 30)
        return 1 / (1 + np.exp(-odds))


def _blocks(n: int) -> list[slice]:
    """Parts of a long array that are worked on one after another, for numpy's temporaries."""
    return [slice(a, a + (1 << 19)) for a in range(0, n, 1 << 19)]


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_link(
    row: np.ndarray, feature: np.ndarray, n_features: int, y: np.ndarray, earlier: np.ndarray, use: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """(features chosen, weights, bias, weights of earlier log odds) of one logistic model.

    (row, feature): distinct pairs, by row. ``use`` marks the rows to fit on.
    """
    none = np.zeros(0, np.int64), np.zeros(0)
    positive, rows = y[use].sum(), int(use.sum())
    if positive in (0, rows):
        return *none, 30.0 if rows and positive else -30.0, np.zeros(earlier.shape[1])
    with_it, positives = np.zeros(n_features, np.int64), np.zeros(n_features)
    for part in _blocks(len(row)):
        mine = use[row[part]]
        f = feature[part][mine]
        with_it += np.bincount(f, minlength=n_features)
        positives += np.bincount(f, weights=y[row[part][mine]], minlength=n_features)
    rate_in, rate = (positives + 0.5) / (with_it + 1), positive / rows
    worth = np.abs(positives - with_it * rate) / np.sqrt(with_it * rate * (1 - rate) + 1)
    worth[with_it < SUPPORT] = 0
    order = np.argsort(-worth, kind="stable")[:FEATURES]
    chosen = np.sort(order[worth[order] > WORTH])
    place = np.full(n_features, -1)
    place[chosen] = np.arange(len(chosen))
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for part in _blocks(len(row)):
        keep = use[row[part]] & (place[feature[part]] >= 0)
        pairs.append((row[part][keep].astype(np.int64), place[feature[part][keep]]))
    r, c = (np.concatenate(x) for x in zip(*pairs, strict=True))
    scale = np.abs(_log_odds(rate_in[chosen]) - _log_odds(np.array([rate])))  # a clear feature weighs more
    value, m = scale[c], len(chosen)
    weight = np.where(y > 0, 0.5 / positive, 0.5 / (rows - positive)) * use  # both values count the same
    size = m + 1 + earlier.shape[1]

    def margins(w: np.ndarray) -> np.ndarray:
        return np.bincount(r, weights=w[c] * value, minlength=len(y)) + w[m] + earlier @ w[m + 1 :]

    def gather(x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(c, weights=x[r] * value, minlength=m), [x.sum()], earlier.T @ x])

    top = np.ones(size)  # largest curvature, by power iteration: the step that cannot overshoot
    for _ in range(8):
        top = gather(weight * margins(top / np.linalg.norm(top)))
    step = 1 / (0.3 * np.linalg.norm(top) + RIDGE)
    w, ahead, t = np.zeros(size), np.zeros(size), 1.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(margins(ahead), -30, 30)))
        new = ahead + step * (gather(weight * (y - p)) - RIDGE * ahead)
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / later * (new - w), new, later
    return chosen, w[:m] * scale, float(w[m]), w[m + 1 :]


def fit(texts: pa.Array, labels: np.ndarray, categories: tuple[str, ...], folds: np.ndarray) -> Chain:
    """The chain for (rows, label columns), a category for each column and in their order."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct (row, feature hash), piece by piece."""
        done = 0
        for piece in pieces([batch], "text"):
            doc, h = features(piece.column(0))
            pair = pd.DataFrame({"d": (doc + done).astype(np.int32), "h": h}).drop_duplicates()
            yield pair["d"].to_numpy(), pair["h"].to_numpy()
            done += piece.num_rows

    bucket = np.zeros(1 << 22, np.int32)  # rows per hash bucket: at least as many as hold any feature in it
    for _, h in pairs():
        bucket += np.bincount((h >> _U(42)).astype(np.int64), minlength=len(bucket)).astype(np.int32)
    often = bucket >= SUPPORT  # most features are rare and can tell nothing
    names = np.zeros(0, _U)
    for _, h in pairs():
        names = np.union1d(names, h[often[(h >> _U(42)).astype(np.int64)]])
    rows, codes, n = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], len(labels)
    for d, h in pairs():
        kept = often[(h >> _U(42)).astype(np.int64)]
        rows.append(d[kept])
        codes.append(np.searchsorted(names, h[kept]).astype(np.int32))
    row, feature = np.concatenate(rows), np.concatenate(codes)
    del rows, codes
    odds, links = np.zeros((n, 0)), []
    for c in range(len(categories)):
        y = labels[:, c].astype(float)
        out = np.zeros(n)
        for k in [*range(FOLDS), -1]:  # the last is fitted on all rows and kept
            chosen, weights, bias, other = fit_link(row, feature, len(names), y, odds, folds != k)
            if k < 0:
                order = np.argsort(names[chosen])
                links.append(Link(names[chosen][order], weights[order], bias, other))
                continue
            weight = np.zeros(len(names))
            weight[chosen] = weights
            margin = bias + odds @ other
            for part in _blocks(len(row)):
                margin += np.bincount(row[part], weights=weight[feature[part]], minlength=n)
            out[folds == k] = margin[folds == k]
        odds = np.column_stack([odds, np.clip(out, -30, 30)])
    return Chain(categories, links)


#: The chain follows the columns of ``labels``; what is rejected is toxic.
CATEGORIES = ("low_quality", "toxic")


def one_text(rows: DataFrame) -> DataFrame:
    """One row per (doc_id, low, toxic), with the greatest of its texts: null and empty ones come last."""
    return rows.groupBy("doc_id", "low", "toxic").agg(F.max("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """Fit on a bounded sample of ``labels`` (doc_id, quality, toxic) and the texts of ``docs``.

    The sample has at most twice ``sample`` doc_ids with two numbers, which Spark sees and broadcasts to find its texts; each doc_id's copies
    shrink to one by partial aggregation before they meet. The fit is one task over one row per doc_id.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
    known = known.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(
        "doc_id", (F.col("quality") == 0).cast("int").alias("low"), (F.col("toxic") == 1).cast("int").alias("toxic")
    )
    known = known.groupBy("doc_id").agg(F.max("low").alias("low"), F.max("toxic").alias("toxic"))
    parts = [known.filter(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for v in (0, 1)]
    chosen = parts[0].unionAll(parts[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = one_text(texts.join(chosen, "doc_id")).repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        if not found:
            return
        table = pa.Table.from_batches(found).to_pandas().sort_values("doc_id")
        folds = (pd.util.hash_array(table["doc_id"].to_numpy()) % FOLDS).astype(np.int64)
        chain = fit(pa.array(table["text"], pa.string()), table[["low", "toxic"]].to_numpy(), CATEGORIES, folds)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(chain)], pa.binary())], ["chain"])

    found = rows.mapInArrow(run, "chain binary").collect()
    return pickle.loads(found[0]["chain"]) if found else _constant()


def _constant() -> Chain:
    none = np.zeros(0, _U), np.zeros(0)
    return Chain(CATEGORIES, [Link(*none, -30.0, np.zeros(c)) for c in range(len(CATEGORIES))])


def annotate(df: DataFrame, chain: Chain, names: tuple[str, ...], text: str = "text") -> DataFrame:
    """The rows with a probability per category, in new columns ``names``. No shuffle."""
    if {n.lower() for n in names} & {c.lower() for c in df.columns}:
        raise ValueError("a column of that name is there already")
    sent = df.sparkSession.sparkContext.broadcast(chain)
    schema = StructType([*df.schema.fields, *(StructField(n, DoubleType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            p = sent.value.probabilities(batch.column(text))
            columns = [*batch.columns, *(pa.array(p[:, c]) for c in range(p.shape[1]))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    return df.mapInArrow(run, schema)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the probability of each category, ``categories`` ("toxic" or empty), and whether to reject."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    names = tuple(f"p_{c}" for c in CATEGORIES)
    out = annotate(rows, train(docs, labels), names).drop("text")
    hold = F.concat_ws(",", *(F.when(F.col(f"p_{c}") >= THRESHOLD, c) for c in CATEGORIES[1:]))
    return out.select("*", hold.alias("categories"), (hold != "").alias("rejected"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents without those that are toxic."""
    used, names = {c.lower() for c in docs.columns}, []
    for c in CATEGORIES:
        name = f"p_{c}"
        while name.lower() in used:
            name += "_"
        names.append(name)
    out = annotate(docs, train(docs, labels), tuple(names))
    return out.filter(F.col(names[1]) < THRESHOLD).select(docs.columns)
