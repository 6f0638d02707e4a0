"""N-gram Jaccard join by PartEnum signatures, and the groups its links form.

A document's set holds its distinct shingles of ``words`` words (lower-cased A-Z, split at ASCII white space); with
fewer words the whole sequence is one; without words or text the set is empty and links with nothing. Two documents
link when |A and B| / |A or B| >= ``similarity`` (a fraction of integers, compared exactly).

1. *Signatures.* Sizes fall into bands. Two similar sets whose larger one lies in a band of sizes up to ``u`` differ in
   at most k = 2 u (1 - s) / (1 + s) features. The feature domain is cut into n1 parts of n2 = 3 cells; with
   n1 = (k + 1) / 2 some part holds at most one difference, so one of its three subsets of two cells is equal in both
   sets. Each subset's content is a signature; a set emits those of every band that a similar, not smaller set can lie
   in. A subset without features says nothing and is no signature. ``SPARE`` more parts than needed make up for it: of
   a similar pair's parts, at least that many and one more hold at most one difference. A set in which more parts than
   that have a subset without features also emits the signatures of another cutting of the domain.
2. *Candidates.* Sets that share a signature are tied to the least of all that have it, not paired with each other. That
   set and the sets tied to it are a group: any two that share a signature are tied to the same set by it, or one to the
   other, so the groups hold all candidates. Ties are not followed further, so chance ties chain no groups, and groups
   are formed alike in tables of any size. Most documents share no signature and take no further part.
3. *Links.* Inside a group the sets are compared exactly. Features of one set alone bound what it can share; what is
   linked to the most common set needs no comparison with each other. A large group is cut into segments, each pair of
   which is compared by one task, so memory is bounded whatever the group's size. Only links that join something are
   returned, never all pairs.

Equal sets are one set throughout: copies meet by partial aggregation of a 128-bit hash and are never paired.
Rows with the same doc_id count as one document with all their sets: what links with any of them is reachable from it.
Rows without a doc_id and null texts link with nothing. Long texts are whole. No documents: no rows. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._batch import CHUNK, binary, buffer, mix, pieces, prefix_hash, ragged, span_hash
from ._graph import components
from ._tables import stored

#: Sizes of one band differ by at most this factor.
BAND = 1.35
#: Parts more than needed, as a share of those needed (one at least).
SPARE = 0.15
#: Cuttings of the domain tried before a subset without features is emitted after all.
CUTTINGS = 5
#: Features of the sets that one task compares with each other, about.
SEGMENT = 2_000_000
#: Features of the documents whose signatures meet in one slot, about, and slots of a task.
SLOT, SLOTS = 500_000, 8
#: Signatures that a task holds before it sends them.
HELD = 1_000_000

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEPS = mix(np.arange(1, 65, dtype=_U)) | _U(1)


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    data, at = buffer(column)
    n = len(data)
    if n == 0:
        return [np.zeros(0, _U) for _ in range(len(at) - 1)]
    data = _LOWER[data]
    word = ~_SPACE[data]
    inside = np.zeros(n + 1, bool)  # a word goes on from the byte before
    inside[1:n] = word[:-1]
    inside[at] = False
    begin = np.flatnonzero(word & ~inside[:n])
    stop = np.zeros(n + 1, bool)
    stop[1:n] = ~word[1:]
    stop[at] = True
    ends = np.flatnonzero(stop[1:] & word) + 1
    h = span_hash(prefix_hash(data), begin, ends)
    first = np.searchsorted(begin, at)
    m = len(h)
    whole = np.zeros(max(m - words + 1, 0), _U)
    for i in range(words):
        whole += h[i : i + len(whole)] * _STEPS[i]
    whole = mix(whole)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            s = np.sort(whole[a : b - words + 1])
            out.append(s[np.append(True, s[1:] != s[:-1])])
        elif b > a:
            few = (h[a:b] * _STEPS[words : words + b - a]).sum(dtype=_U) + _U(b - a)
            out.append(mix(np.array([few])))
        else:
            out.append(np.zeros(0, _U))
    return out


class Signatures:
    """PartEnum signatures of sets for one similarity, given as ``num`` / ``den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.tops = [1]  # largest size of each band

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * BAND)))
        return int(np.searchsorted(self.tops, size))

    def bands(self, size: int) -> range:
        """Bands in which the larger set of a similar pair can lie, if this one is the other."""
        return range(self.band(size), self.band(size * self.den // self.num) + 1)

    def parts(self, band: int) -> tuple[int, int]:
        """(parts, those of them that may lack a signature)."""
        differ = 2 * self.tops[band] * (self.den - self.num) // (self.den + self.num)
        needed = (differ + 2) // 2 if differ else 0
        spare = int(needed * SPARE) + 1 if needed > 1 else 0
        return needed + spare, spare

    @lru_cache(maxsize=4096)
    def cutting(self, band: int, nth: int) -> tuple[int, np.ndarray, np.ndarray]:
        """(parts that may lack a signature, inner borders of the cells, label of each subset)."""
        parts, spare = self.parts(band)
        cells = 3 * parts
        bounds = np.array([(c << 64) // cells for c in range(1, cells)], _U)
        label = np.arange(cells, dtype=_U) + _U(nth << 40) + _U(band << 48)
        return spare, bounds, mix(label).reshape(parts, 3)

    def of(self, features: np.ndarray) -> np.ndarray:
        """All signatures of one set, given sorted."""
        out, base = [], mix(features)
        for band in self.bands(len(features)):
            if not self.parts(band)[0]:  # such sets must be equal
                out.append(mix(np.array([base.sum(dtype=_U) + _U(band)])))
                continue
            current, values = features, base
            for nth in range(CUTTINGS):
                spare, bounds, label = self.cutting(band, nth)
                total = np.zeros(len(current) + 1, _U)
                np.cumsum(values, out=total[1:])
                edge = np.concatenate(([0], np.searchsorted(current, bounds), [len(current)]))
                held = np.diff(edge).reshape(-1, 3)
                sums = np.diff(total[edge]).reshape(-1, 3)
                bare = held.sum(1, keepdims=True) == held  # no feature in the two other cells
                signature = mix((sums.sum(1, keepdims=True, dtype=_U) - sums) ^ label)
                last = nth == CUTTINGS - 1
                out.append(signature.ravel() if last else signature[~bare])
                if last or bare.any(1).sum() <= spare:
                    break
                current = np.sort(mix(features ^ _U(nth + 1)))
                values = mix(current)
        return np.concatenate(out)


def _input(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def set_hashes(docs: DataFrame, words: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles and a 128-bit hash (h1, h2) of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), words)
            size = np.array([len(s) for s in sets], np.int64)
            pair = [_fingerprint(sets, size, _U(salt)) for salt in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), *(pa.array(p.view(np.int64)) for p in pair)],
                ["doc_id", "n_shingles", "h1", "h2"],
            )

    return _input(docs, text, key).mapInArrow(run, "doc_id long, n_shingles long, h1 long, h2 long")


def _fingerprint(sets: list[np.ndarray], size: np.ndarray, salt: np.uint64) -> np.ndarray:
    flat = np.concatenate([*sets, np.zeros(1, _U)])
    total = np.zeros(len(flat) + 1, _U)
    np.cumsum(mix(flat * (_U(2) * salt + _U(1)) + salt), out=total[1:])
    end = np.cumsum(size)
    return mix((total[end] - total[end - size]) ^ size.astype(_U))


def _distinct(signatures: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows without repeated ones, by signature."""
    order = np.lexsort((owners, signatures))
    sig, own = signatures[order], owners[order]
    new = np.append(True, (sig[1:] != sig[:-1]) | (own[1:] != own[:-1]))[: len(sig)]
    return sig[new], own[new]


def least_of(signatures: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of signature and its least owner, by signature; distinct rows of another owner and that least one)."""
    order = np.argsort(signatures)
    sig, own = signatures[order], owners[order].view(np.int64)  # the order that the tied numbers have in a table
    first = np.flatnonzero(np.append(True, sig[1:] != sig[:-1])[: len(sig)])
    if not len(first):
        return np.zeros((0, 2), _U), np.zeros((0, 2), _U)
    least = np.minimum.reduceat(own, first)
    of = np.repeat(least, np.diff(np.append(first, len(sig))))
    other = own != of
    found = pd.DataFrame({"a": own[other], "b": of[other]}).drop_duplicates().to_numpy(np.int64)
    return np.stack([sig[first], least.view(_U)], 1), found.view(_U)


def ties(
    docs: DataFrame, words: int, num: int, den: int, features: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(a, b): sets, by h1, that share a signature, each tied to the least set of all that have that signature.

    Signatures travel as packed numbers, one blob per slot and some megabytes of input, and a task handles one slot
    at a time. There are as many slots as the ``features`` of all documents need, each a range of signatures. Of the sets
    of one signature a blob holds the least only, so a signature that a third of all sets share has one entry per blob.
    Its other sets wait under the number of their ``source``, the input that blob comes from, until the slot has told
    that source the least set of all: no two sets of a signature are ever tied to different ones.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = max(4 * parts, -(-features // SLOT))
    tasks = max(parts, -(-slots // SLOTS))
    several = _U(1)  # lowest bit of a signature in a slot: its source has more sets of it

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, seen, signatures, owners, held = Signatures(num, den), set(), [], [], 0
        source = TaskContext.get().partitionId() << 32

        def blobs() -> pa.RecordBatch:
            least, waiting = shared(np.concatenate(signatures) & ~several, np.concatenate(owners))
            slot = ((least[:, 0] >> _U(32)) * _U(slots) >> _U(32)).astype(np.int64)  # in ascending order
            some, first = np.unique(slot, return_index=True)
            if len(waiting):
                some = np.append(some, slots + source % slots)
                first = np.append(first, len(least))
            at = np.append(first, len(least) + len(waiting)) * 16
            data = binary(np.concatenate([least, waiting]).view(np.uint8), at)
            return pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(np.full(len(some), source)), data], ["slot", "source", "data"]
            )

        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), words)
            size = np.array([len(s) for s in sets], np.int64)
            for s, h in zip(sets, _fingerprint(sets, size, _U(1)), strict=True):
                if len(s) and int(h) not in seen:
                    if len(seen) >= 1_000_000:  # only saves repeated signatures of copies
                        seen.clear()
                    seen.add(int(h))
                    found = signer.of(s)
                    signatures.append(found)
                    owners.append(np.full(len(found), h, _U))
                    held += len(found)
            if held > HELD:
                yield blobs()
                signatures, owners, held = [], [], 0
                source += 1
        if held:
            yield blobs()

    def shared(sig: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(signature, marked if several sets have it, and its least set; all rows of the signatures of several)."""
        least, _ = least_of(sig, own)
        sig, own = _distinct(sig, own)
        many = np.diff(np.append(np.searchsorted(sig, least[:, 0]), len(sig))) > 1
        rows = np.stack([sig, own], 1)[many[np.searchsorted(least[:, 0], sig)]]
        least[many, 0] |= several
        return least, rows

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, origin = None, [], []

        def packed(source: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
            """One row per source, given in ascending order."""
            some, first = np.unique(source, return_index=True)
            data = binary(np.ascontiguousarray(rows).view(np.uint8), np.append(first, len(rows)) * 16)
            return pa.RecordBatch.from_arrays([pa.array(some), data], ["source", "data"])

        def tied() -> Iterator[pa.RecordBatch]:
            rows = np.frombuffer(b"".join(held), _U).reshape(-1, 2)
            source = np.repeat(np.array(origin, np.int64), [len(h) // 16 for h in held])
            mark, sig = (rows[:, 0] & several).astype(bool), rows[:, 0] & ~several
            least, pairs = least_of(sig, rows[:, 1])
            if len(pairs):
                yield packed(np.full(len(pairs), -1 - slot), pairs)
            of = least[np.searchsorted(least[:, 0], sig), 1]
            told = np.flatnonzero(mark & (of != rows[:, 1]))
            told = told[np.argsort(source[told], kind="stable")]
            if len(told):
                yield packed(source[told], np.stack([sig[told], of[told]], 1))

        for batch in batches:  # sorted by slot
            for i, (s, source) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("slot", "source")), strict=True)):
                if s != slot and held:
                    yield from tied()
                    held, origin = [], []
                if s < slots:
                    held.append(batch.column("data")[i].as_py())
                    origin.append(source)
                else:
                    one = batch.slice(i, 1)
                    yield pa.RecordBatch.from_arrays([one.column("source"), one.column("data")], ["source", "data"])
                slot = s
        if held:
            yield from tied()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, held = None, []

        def tied() -> pa.RecordBatch:
            pairs = np.frombuffer(b"".join(held), _U).reshape(-1, 2)
            if source >= 0:  # signatures and sets of one source, and the least sets it was told
                _, pairs = least_of(pairs[:, 0], pairs[:, 1])
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, i].astype(np.int64)) for i in (0, 1)], ["a", "b"])

        for batch in batches:  # sorted by source
            for i, s in enumerate(batch.column("source").to_pylist()):
                if held and s != source:
                    yield tied()
                    held = []
                source = s
                held.append(batch.column("data")[i].as_py())
        if held:
            yield tied()

    blobs = _input(docs, text, key).filter("doc_id IS NOT NULL").mapInArrow(emit, "slot long, source long, data binary")
    blobs = blobs.repartition(tasks, "slot").sortWithinPartitions("slot")
    told = blobs.mapInArrow(tie, "source long, data binary").repartition(tasks, "source")
    return told.sortWithinPartitions("source").mapInArrow(resolve, "a long, b long")


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def local_links(sets: list[np.ndarray], num: int, den: int, budget: int = 4_000_000) -> list[tuple[int, int]]:
    """Links that join all similar sets of one group, found exactly; few more than needed, never all pairs."""
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    feature, _ = pd.factorize(np.concatenate(sets)) if len(owner) else (np.zeros(0, np.int64), None)
    share = size  # features that other sets have too bound what a set can share
    while len(owner):
        common = np.bincount(feature)[feature] > 1
        share = np.bincount(owner[common], minlength=len(sets))
        keep = common & (share * den >= size * num)[owner]
        if keep.all():
            break
        owner, feature = owner[keep], feature[keep]
    if not len(owner):
        return []
    feature, _ = pd.factorize(feature)
    by = np.argsort(feature, kind="stable")
    posting = owner[by]
    count = np.bincount(feature)
    begin = np.cumsum(count) - count
    forest, links = Forest(len(sets)), []
    row_at = np.searchsorted(owner, np.arange(len(sets) + 1))

    def compare(rows: np.ndarray) -> None:
        own = np.repeat(np.arange(len(rows)), row_at[rows + 1] - row_at[rows])
        mine = feature[np.repeat(row_at[rows], row_at[rows + 1] - row_at[rows]) + ragged(row_at[rows + 1] - row_at[rows])]
        times = count[mine]
        cell = np.repeat(own, times) * len(sets) + posting[np.repeat(begin[mine], times) + ragged(times)]
        if len(rows) * len(sets) <= 4 * len(cell) + 1000:
            shared = np.bincount(cell, minlength=len(rows) * len(sets))
            at = np.flatnonzero(shared)
            shared = shared[at]
        else:
            at, shared = np.unique(cell, return_counts=True)
        i, j = rows[at // len(sets)], at % len(sets)
        ok = (i != j) & (shared * (num + den) >= num * (size[i] + size[j]))
        for x, y in zip(i[ok].tolist(), j[ok].tolist(), strict=True):
            if forest.join(x, y):
                links.append((x, y))

    alive = np.flatnonzero(np.diff(row_at))
    work = np.bincount(owner, weights=count[feature], minlength=len(sets)).astype(np.int64)
    hub = int(alive[np.argmax(work[alive])])
    compare(np.array([hub]))
    main = forest.root(hub)
    rest = np.array([i for i in alive.tolist() if forest.root(i) != main], np.int64)
    a = 0
    while a < len(rest):
        total = np.cumsum(work[rest[a:]])
        b = a + max(1, int(np.searchsorted(total, budget, side="right")))
        compare(rest[a:b])
        a = b
    return links


def links(docs: DataFrame, words: int, num: int, den: int, groups: DataFrame) -> DataFrame:
    """(a, b): document a and the least document b that links join it to, of each block of sets compared by one task.

    ``groups``: doc_id, n_shingles and the candidate group ``cluster`` of one document per distinct set.
    """
    sizes = groups.groupBy("cluster").agg(F.sum("n_shingles").alias("features"))
    cut = F.ceil(F.col("features") / F.lit(SEGMENT)).cast("int")
    rows = groups.join(sizes, "cluster").withColumn("cuts", cut)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    block = [F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j")]
    rows = rows.select("doc_id", "cluster", *block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, sets = None, [], []

        def found() -> pa.RecordBatch:
            key, forest = np.array(ids, np.int64), Forest(len(ids))
            for i, j in local_links(sets, num, den):
                forest.join(i, j)
            root = np.array([forest.root(i) for i in range(len(ids))])
            least = key.copy()
            np.minimum.at(least, root, key)
            tied = key != least[root]
            return pa.RecordBatch.from_arrays([pa.array(key[tied]), pa.array(least[root][tied])], ["a", "b"])

        unpacker = zstandard.ZstdDecompressor()
        for batch in pieces(batches, "packed", CHUNK // 4):  # sorted by block
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j")), strict=True))
            own = batch.column("doc_id").to_pylist()
            text = pa.array([unpacker.decompress(p) for p in batch.column("packed").to_pylist()], pa.binary())
            for key, doc, features in zip(keys, own, shingle_sets(text, words), strict=True):
                if key != block and block is not None:
                    if len(ids) > 1:
                        yield found()
                    ids, sets = [], []
                block = key
                ids.append(doc)
                sets.append(features)
        if len(ids) > 1:
            yield found()

    keys = ["cluster", "i", "j"]
    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, at = buffer(batch.column("text"))
            raw = memoryview(data)
            body = [packer.compress(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(body, pa.binary())], ["doc_id", "packed"])

    packed = _input(docs, "text", "doc_id").mapInArrow(shrink, "doc_id long, packed binary")
    texts = packed.join(rows.hint("merge"), "doc_id")  # one plan at every size
    return texts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def candidate_groups(classes: DataFrame, tied: DataFrame) -> DataFrame:
    """doc_id, n_shingles, cluster: one document per distinct set and candidate group.

    A group is a set that others are tied to, and those, whatever its size. All sets of a signature are tied to one of
    them, so any two sets that share a signature are in a group together.
    """
    star = tied.unionAll(tied.select("b", "b").distinct()).toDF("node", "cluster")
    own = classes.join(star, classes["h1"] == star["node"])
    return own.select(F.col("first").alias("doc_id"), "n_shingles", "cluster")


def shared_ids(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): a doc_id that repeats with several sets, tied to the first document of each of them."""
    differs = (F.min("h1") != F.max("h1")) | (F.min("h2") != F.max("h2"))
    several = sets.groupBy("doc_id").agg(differs.alias("several")).filter("several").select("doc_id")
    own = sets.select("doc_id", "h1", "h2").join(several, "doc_id", "left_semi").distinct()
    return own.join(classes.select("h1", "h2", "first"), ["h1", "h2"]).select(
        F.col("doc_id").alias("a"), F.col("first").alias("b")
    )


def near_groups(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) of every row of ``docs``."""
    rows = _input(docs, text, key)
    own = stored(set_hashes(rows, words))
    sets = own.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = sets.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.min("n_shingles").alias("n_shingles"))
    features = sets.agg(F.sum("n_shingles")).first()[0] or 0
    tied = stored(ties(rows, words, num, den, features).distinct())
    groups = stored(candidate_groups(classes, tied))
    found = links(rows, words, num, den, groups).select("a", "b")
    joined = components(found.unionAll(shared_ids(sets, classes)))
    roots = classes.join(joined, classes["first"] == joined["node"], "left")
    roots = roots.select("h1", "h2", F.coalesce("root", "first").alias("component_id"))
    same = own.join(roots, ["h1", "h2"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull() | F.col("component_id").isNull()
    return same.select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def first_of_group(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents with one of each group left, the one of the least doc_id; of its repeated rows the one whose
    text has the least hash, so that a repeated task keeps the same. Rows without a doc_id stay."""
    found = near_groups(docs, words, num, den).filter("doc_id = component_id").select("doc_id").distinct()
    mark = "__nth"
    while mark in docs.columns:
        mark += "_"
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    kept = docs.join(found, "doc_id", "left_semi").withColumn(mark, F.row_number().over(first)).filter(F.col(mark) == 1)
    kept = kept.drop(mark)
    return kept.unionByName(docs.filter("doc_id IS NULL")).select(docs.columns)


#: ``near_groups`` of four words and 0.85 for DuckDB.
GROUPS_SQL = """
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
    FROM docs
), features AS (SELECT doc_id, len(s) AS n, unnest(s) AS f FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM features a JOIN features b ON a.f = b.f AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id, doc_id AS r FROM sets
    UNION
    SELECT l.a, reached.r FROM reached JOIN links l ON l.b = reached.doc_id
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.r) AS component_id
FROM sets s JOIN reached r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.s
"""
