"""Transcript parsing by a hidden Markov model, and rendering of canonical turns.

A transcript is a sequence of lines by (turn, line). A line may begin with a speaker marker ("User:", "### Assistant",
"Q:" ...); a segment begins where a message of the table begins or where a line carries a marker. The hidden state is
the speaker's role. It can change only where a segment begins; lines emit features: the role its marker names, whether
it is the first line, its length, a question, code or list marks, and whether the message has more lines.

Probabilities are counted over all labelled lines of the table, with add-one smoothing; markers, which training rows
may lack, also have a prior count for the role they name. Roles beyond ``system``, ``user`` and ``assistant`` (and
null) count as unlabelled. Without labelled rows all probabilities are even but for the markers.

Decoding is Viterbi, cut anywhere: rows are dealt by ranges of (conversation, turn, text), and each task keeps of a
conversation the best log probability from any role to any role through its part (a 3 x 3 table). Where a conversation
spans parts those tables, one per part and cut, give the best roles at the cuts, and each part is decoded between
them. So one conversation may hold any share of all rows.

Null text is empty and keeps its turn. Equal turns of a conversation are ordered by text. A null turn comes first.
Rows without conv_id form one conversation. Ties between roles go to the first in the order above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import stored

ROLES = ("system", "user", "assistant")
# What speakers are called, by role.
MARKERS = (
    r"system|instructions?|context",
    r"user|human|customer|question|client|q|me",
    r"assistant|ai|bot|agent|answer|model|a",
)
MARK = r"^\s{0,3}(?:#{1,4}\s*|\*{1,2}|<\|?|\[)?(?i:(%s))(?:\*{1,2}|\|?>|\])?\s*(?::|$|(?<=[>\]*]))\s*(?:\*{1,2})?"
#: Count with which a marker speaks for the role it names, beside the counts of the table.
PRIOR = 50
_SIZES = {"mark": 4, "first": 2, "length": 6, "question": 2, "listing": 2, "several": 2}


def lines(conversations: DataFrame) -> DataFrame:
    """One row per line with its features and whether a segment begins there. Equal messages of a turn are one."""
    role = F.lit(None).cast("int")
    for i, name in enumerate(ROLES):
        role = F.when(F.lower(F.col("role").cast("string")) == name, i).otherwise(role)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("message"),
        role.alias("label"),
    )
    rows = rows.groupBy("conv_id", "turn", "message").agg(F.min("label").alias("label"))
    rows = rows.withColumn("parts", F.split("message", "\n"))
    rows = rows.select("*", F.posexplode("parts").alias("line", "text"))
    mark = F.lit(0)
    for i, names in reversed(list(enumerate(MARKERS))):
        mark = F.when(F.col("text").rlike(MARK % names), i + 1).otherwise(mark)
    size = F.length("text")
    length = sum((F.when(size > bound, 1).otherwise(0) for bound in (20, 80, 200, 500, 1200)), F.lit(0))
    flag = lambda c: c.cast("int")
    return rows.select(
        "conv_id",
        "turn",
        F.xxhash64("message").alias("message"),
        F.col("line").cast("long").alias("line"),
        "text",
        "label",
        mark.cast("int").alias("mark"),
        flag(F.col("line") == 0).alias("first"),
        length.cast("int").alias("length"),
        flag(F.col("text").contains("?")).alias("question"),
        flag(F.col("text").rlike(r"^\s*(?:[-*•]|[0-9]+[.)]|```)\s?")).alias("listing"),
        flag(F.size("parts") > 1).alias("several"),
        flag((F.col("line") == 0) | (mark > 0)).alias("begins"),
    )


class Model:
    """Log probabilities: ``start`` (role), ``step`` (role, role) between segments, ``emit`` feature (role, value)."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: dict[str, np.ndarray]):
        log = lambda x: np.log(x / x.sum(-1, keepdims=True))
        self.start, self.step = log(start), log(step)
        self.emit = {name: log(x) for name, x in emit.items()}

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        """(lines, roles)."""
        return sum(table[:, batch.column(name).to_numpy()].T for name, table in self.emit.items())


def train(marked: DataFrame) -> Model:
    """Counts over all labelled lines: per feature, of first roles and of steps from message to message."""
    known = marked.filter("label IS NOT NULL")
    emit = {name: np.ones((len(ROLES), n)) for name, n in _SIZES.items()}
    for r in range(len(ROLES)):
        emit["mark"][r, r + 1] += PRIOR
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in _SIZES)))
    for row in known.select("label", pairs.alias("p")).groupBy("label", "p.name", "p.value").count().collect():
        emit[row["name"]][row["label"], row["value"]] += row["count"]
    heads = known.filter("first = 1").groupBy("conv_id", "turn").agg(F.min("label").alias("label"))
    start, step = np.ones(len(ROLES)), np.ones((len(ROLES), len(ROLES)))
    after = heads.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("label").alias("before"))
    both = heads.join(after, ["conv_id", "turn"], "left")  # the turn before, if there is one
    for row in both.groupBy("before", "label").count().collect():
        if row["before"] is None:
            start[row["label"]] += row["count"]
        else:
            step[row["before"], row["label"]] += row["count"]
    return Model(start, step, emit)


def _best(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two tables of log probabilities where the best path counts."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def through(scores: np.ndarray, begins: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best log probability from the role before these lines to the role of the last one."""
    table = np.where(np.eye(len(ROLES)) > 0, 0.0, -np.inf)
    for at, own in _segments(scores, begins):
        table = (_best(table, step) if begins[at] else table) + own
    return table


def _segments(scores: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first line, summed scores) of each run of lines that share a role."""
    heads = np.flatnonzero(np.append(True, begins[1:] > 0)) if len(begins) else np.zeros(0, np.int64)
    yield from zip(heads.tolist(), np.add.reduceat(scores, heads, axis=0) if len(heads) else [], strict=True)


def viterbi(scores: np.ndarray, begins: np.ndarray, step: np.ndarray, entry: np.ndarray, last: int | None) -> np.ndarray:
    """Role of every line. ``entry``: log probability of each role before the first line, or of the first one itself
    where ``begins[0]`` is 0. ``last``: the role of the last line, if a later part has fixed it."""
    parts = list(_segments(scores, begins))
    value, back = entry, []
    for at, own in parts:
        if begins[at]:
            ways = value[:, None] + step
            back.append(ways.argmax(0))
            value = ways.max(0) + own
        else:
            back.append(np.arange(len(ROLES)))
            value = value + own
    role = int(value.argmax()) if last is None else last
    roles = []
    for choice in reversed(back):
        roles.append(role)
        role = int(choice[role])
    count = np.diff([at for at, _ in parts] + [len(begins)])
    return np.repeat(roles[::-1], count).astype(np.int32)


_KEEP = ["conv_id", "turn", "message", "line", "text", "begins"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Lines of one conversation in one part, all together; the batches come sorted by (part, conversation)."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        part, conv = (batch.column(c).fill_null(-(1 << 62)).to_numpy() for c in ("part", "conv_id"))
        edge = np.flatnonzero((np.diff(part) != 0) | (np.diff(conv) != 0)) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
            if a == b:
                continue
            own = (int(part[a]), int(conv[a]))
            if held and own != key:
                yield pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def recover(marked: DataFrame, model: Model) -> DataFrame:
    """The lines with the role that Viterbi recovers: conv_id, turn, message, line, text, begins, role."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "message", "line")]
    dealt = marked.repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("long"))
    parts = stored(dealt)  # written once: what a part holds must not change between the two passes
    sent = marked.sparkSession.sparkContext.broadcast(model)
    by = [F.col(c).asc_nulls_first() for c in ("part", "conv_id", "turn", "message", "line")]
    many = parts.groupBy("conv_id").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    many = many.filter("low < high").select(F.col("conv_id").alias("cut_id"), F.lit(1).alias("cut"), "low", "high")
    placed = parts.join(many, F.col("conv_id").eqNullSafe(F.col("cut_id")), "left").drop("cut_id")
    head = F.coalesce(F.col("part") == F.col("low"), F.lit(True))  # the conversation begins in this part
    placed = placed.withColumn("cut", F.coalesce("cut", F.lit(0))).withColumn("head", head).drop("low", "high")
    cut = placed.filter("cut = 1").repartition("part", "conv_id").sortWithinPartitions(*by)

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            batch = group.combine_chunks().to_batches()[0]
            value = through(sent.value.scores(batch), _begins(batch), sent.value.step)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id")[:1], batch.column("part")[:1], pa.array([value.ravel().tolist()])],
                ["conv_id", "part", "value"],
            )

    # one row for each conversation and part it is cut by: at most one more than there are parts
    found = cut.mapInArrow(table, "conv_id long, part long, value array<double>").collect()
    fixed = _ends(model, sorted(found, key=lambda r: (r["conv_id"] is not None, r["conv_id"], r["part"])))
    ends = marked.sparkSession.sparkContext.broadcast(fixed)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            batch = group.combine_chunks().to_batches()[0]
            key = batch.column("conv_id")[0].as_py(), batch.column("part")[0].as_py()
            entry, last = ends.value.get(key, (None, None))
            model = sent.value
            entry = model.start if entry is None else entry
            roles = viterbi(model.scores(batch), _begins(batch), model.step, entry, last)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in _KEEP), pa.array(roles)], [*_KEEP, "role"])

    placed = placed.repartition("part", "conv_id").sortWithinPartitions(*by)
    kinds = "conv_id long, turn long, message long, line long, text string, begins int, role int"
    return placed.mapInArrow(decode, kinds)


def _begins(batch: pa.RecordBatch) -> np.ndarray:
    """Whether a step to another role can lie before each line; there is none before a conversation's first line."""
    out = batch.column("begins").to_numpy().copy()
    if batch.column("head")[0].as_py():
        out[0] = 0
    return out


def _ends(model: Model, tables: list) -> dict:
    """(entry, last role) of each part of the conversations that are cut. Entry: only the role before it counts."""
    out: dict = {}
    at = 0
    while at < len(tables):
        end = at
        while end < len(tables) and tables[end]["conv_id"] == tables[at]["conv_id"]:
            end += 1
        parts = [(t["part"], np.array(t["value"]).reshape(len(ROLES), -1)) for t in tables[at:end]]
        value, choices = (model.start[:, None] + parts[0][1]).max(0), []
        for _, step in parts[1:]:
            ways = value[:, None] + step
            choices.append(ways.argmax(0))
            value = ways.max(0)
        role = int(value.argmax())
        for i in range(len(parts) - 1, -1, -1):
            before = int(choices[i - 1][role]) if i else None
            entry = None if before is None else np.where(np.arange(len(ROLES)) == before, 0.0, -np.inf)
            out[tables[at]["conv_id"], parts[i][0]] = (entry, role)
            role = before if before is not None else role
        at = end
    return out


def render(role: Column, text: Column) -> Column:
    """One canonical turn."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("\n<|end|>"))


def turns(recovered: DataFrame) -> DataFrame:
    """Canonical turns: the lines of each segment, markers cut off, under the role recovered.

    conv_id, turn, segment (number of its first line in the message), role, rendered.
    """
    from pyspark.sql import Window

    message = Window.partitionBy("conv_id", "turn", "message").orderBy("line")
    every = "|".join(MARKERS)
    plain = F.regexp_replace("text", MARK % every, "")
    rows = recovered.withColumn("segment", F.max(F.when(F.col("begins") == 1, F.col("line"))).over(message))
    rows = rows.withColumn("plain", F.when(F.col("line") == F.col("segment"), plain).otherwise(F.col("text")))
    grouped = rows.groupBy("conv_id", "turn", "message", "segment").agg(
        F.max("role").alias("role"), F.array_sort(F.collect_list(F.struct("line", "plain"))).alias("lines")
    )
    name = F.element_at(F.array(*(F.lit(r) for r in ROLES)), F.col("role") + 1)
    text = F.array_join(F.transform("lines", lambda x: x["plain"]), "\n")
    return grouped.select("conv_id", "turn", "message", "segment", name.alias("role"), render(name, text).alias("rendered"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Train on the labelled rows, recover all roles and render all turns."""
    marked = lines(conversations)
    return turns(recover(marked, train(marked)))
