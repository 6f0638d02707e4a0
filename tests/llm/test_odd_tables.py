"""Repeated ids, odd vectors and clashing names in the corpus operators."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tagseries.llm import hashing_search, packing, pivot_search, queries, shingles, token_files, toxicity

X, Y, Z = ("one two three four five six seven", "a b c d e f g h", "red green blue white black pink grey")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, h1 string, __nth string")


def test_an_id_with_several_sets_is_one_document(spark):
    rows = [(1, X), (5, X), (5, Y), (9, Y), (7, Z), (8, "no one is like me at all here"), (8, None), (9, Z)]
    got = shingles.near_groups(docs(spark, rows), 4, 85, 100).collect()
    found = defaultdict(set)
    for r in got:
        if r["n_shingles"]:
            found[r["doc_id"]].add(r["component_id"])
    assert dict(found) == {1: {1}, 5: {1}, 9: {1}, 7: {1}, 8: {8}} and len(got) == len(rows)
    left = shingles.first_of_group(docs(spark, rows), words=4, num=85, den=100)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 8] and left.columns == ["doc_id", "text", "h1", "__nth"]


def test_repeated_rows_of_an_id_leave_the_same_text(spark):
    rows = [(3, t) for t in (X, Y, Z, None)]
    kept = {shingles.first_of_group(docs(spark, r)).first()["text"] for r in (rows, rows[::-1], rows[2:] + rows[:2])}
    assert len(kept) == 1


@pytest.mark.parametrize(("search", "scale"), [(hashing_search.search, 1), (pivot_search.search, 256)])
def test_vectors_of_two_lengths(spark, search, scale):
    rng = np.random.default_rng(2)
    values = [rng.normal(size=8 if i % 3 else 5) for i in range(150)]
    rows = [(i, v.tolist()) for i, v in enumerate(values)] + [(200, []), (201, None), (202, [1.0, None]), (203, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in search(df, every=10, k=4).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 150, 10))
    hits = 0
    for q, found in got.items():
        other = [i for i in range(150) if i != q and len(values[i]) == len(values[q])]
        whole = [np.floor(v * scale) if scale > 1 else v for v in values]
        want = sorted(((i, float(whole[i] @ whole[q])) for i in other), key=lambda x: (-x[1], x[0]))[:4]
        hits += len({i for i, _ in want} & {i for i, _ in found})
        assert len(found) == 4
    assert hits == 60 if scale > 1 else hits >= 54
    many = spark.createDataFrame([(i, [1.0] * (i + 1)) for i in range(70)], df.schema)
    with pytest.raises(ValueError, match="lengths"):
        search(many, every=10, k=4)


def test_large_components(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [3e5, 1.0]), (1, [-2e5, 0.5]), (2, [1e5, 7.0]), (50, [0.0, -1.0])]
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in pivot_search.search(spark.createDataFrame(rows, schema), 50, 5).collect()}
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    assert got == {(q, i): sum(a * b for a, b in zip(whole[q], whole[i], strict=True)) for q in (0, 50) for i in whole if i != q}
    with pytest.raises(ValueError, match="exact"):
        pivot_search.search(spark.createDataFrame([(0, [1e20, 1.0]), (1, [1.0, 1.0])], schema), 50, 5)


def test_column_names_clash_whatever_their_case(spark):
    rows = [(i, "some text " * 5, 0.5) for i in range(4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, P_TOXIC double")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.accepted(table, labels).columns == table.columns


def test_a_row_with_most_copies_is_packed_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 100)
    rows = docs(spark, [(7, "a b c")]).crossJoin(spark.range(3000).select()).unionAll(docs(spark, [(i, "x y") for i in range(200)]))
    pieces = packing.cut(rows.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    sizes = [r["count"] for r in pieces.groupBy("pack_group").count().collect()]
    assert sum(sizes) == 3200 and max(sizes) < 800
    packed = packing.pack(pieces).toPandas()
    assert len(packed) == 3200 and packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_an_id_of_most_rows_is_written_by_many_tasks(spark, tmp_path):
    rows = docs(spark, [(7, f"text {i}") for i in range(2000)] + [(i, "x y") for i in range(200)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many tasks as a large table has
    try:
        token_files.write_tokens(rows, str(tmp_path / "t"), public_tokenizers.path("byte_bpe_50k.json"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    written = spark.read.parquet(str(tmp_path / "t")).groupBy("part").agg(F.sum("n_ids").alias("n")).toPandas()
    assert written["n"].max() < 0.6 * written["n"].sum()
    back = token_files.read_tokens(spark, str(tmp_path / "t")).toPandas().sort_values("start")
    assert len(back) == 2200 and (back["doc_id"].diff().dropna() >= 0).all()
    assert (back["start"].diff().dropna().to_numpy() == back["ids"].map(len).to_numpy()[:-1] // 4).all()


def test_equal_signatures_shrink_before_the_shuffle(spark, monkeypatch):
    base = [f"w{i}" for i in range(400)]
    near = [(i, " ".join(base[:200] + [f"x{i}"] + base[201:])) for i in range(300)]
    far = [(1000 + i, " ".join(f"y{i}z{j}" for j in range(30))) for i in range(20)]
    for held, slot in ((shingles.HELD, shingles.SLOT), (500, 1000)):
        monkeypatch.setattr(shingles, "HELD", held)
        monkeypatch.setattr(shingles, "SLOT", slot)
        got = shingles.near_groups(docs(spark, near + far), 4, 85, 100).toPandas().set_index("doc_id")["component_id"]
        assert (got[got.index < 1000] == 0).all() and all(got[i] == i for i, _ in far)


@pytest.mark.parametrize("name", ["op6_pivot_top_k", "op8_ngram_jaccard"])
def test_queries_against_duckdb(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = duck.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, queries.QUERIES[name](spark, sf_dir).select(names).collect())) == sorted(want.fetchall())


def test_links_do_not_depend_on_how_sets_are_dealt(spark, monkeypatch):
    """Sets of one signature meet, whichever parts of the input they lie in and however large their group is."""
    rng, words = random.Random(8), [f"w{i}" for i in range(120)]

    def edited(text, edits):
        at = rng.sample(range(4, len(text) - 4, 4), edits)
        return [f"x{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(text)]

    texts = [edited(words, 2) for _ in range(500)]  # alike, but few are linked
    texts += [edited(t, 1) for t in texts[::10]]  # linked with one of them
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [{tuple(t[i : i + 4]) for i in range(len(t) - 3)} for t in texts]
    want = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= 85 * len(a | b) and want[i] != want[j]:
                old, new = max(want[i], want[j]), min(want[i], want[j])
                want = [new if r == old else r for r in want]
    assert 200 < len(set(want)) <= 500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for segment, parts in ((shingles.SEGMENT, 2), (20_000, 2)):
            monkeypatch.setattr(shingles, "SEGMENT", segment)
            got = shingles.near_groups(docs(spark, rows).repartition(parts, "doc_id"), 4, 85, 100).toPandas()
            assert got.set_index("doc_id")["component_id"].sort_index().tolist() == want
        left = shingles.first_of_group(docs(spark, rows).repartition(2, "doc_id"), 4, 85, 100).collect()  # of the pipeline
        assert sorted(r["doc_id"] for r in left) == sorted(set(want))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_candidate_groups_are_formed_alike_at_every_size(spark, monkeypatch):
    """Which sets are compared in one group depends on their ties alone, not on how much a task may hold."""
    rng, words = random.Random(3), [f"w{i}" for i in range(60)]
    texts = [[w if rng.random() > 0.06 else f"x{rng.randrange(10**9)}" for w in words] for _ in range(120)]
    rows = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    links, seen = shingles.links, []

    def recorded(*args):
        groups = defaultdict(set)
        for r in args[-1].collect():
            groups[r["cluster"]].add(r["doc_id"])
        seen.append(groups)
        return links(*args)

    monkeypatch.setattr(shingles, "links", recorded)
    left = []
    for segment in (shingles.SEGMENT, 500):  # all 120 sets hold some thousand features
        monkeypatch.setattr(shingles, "SEGMENT", segment)
        left.append(sorted(r["doc_id"] for r in shingles.first_of_group(rows, words=5, num=80, den=100).collect()))
    assert seen[0] == seen[1] and max(map(len, seen[0].values())) > 20
    assert left[0] == left[1]
