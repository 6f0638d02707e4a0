"""Corpus operators against plain versions, libraries and round trips, on small odd tables and on the test tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tagseries.llm import (
    _batch,
    _graph,
    _pretokens,
    bpe,
    chat,
    hashing_search,
    licenses,
    packing,
    pii,
    pivot_search,
    queries,
    shingles,
    token_files,
    toxicity,
)

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
LONG = "Zwölf große Wörter, it's 42 o'clock…  \n" * 3000
ODD = [None, "", " ", "\n\n", "a", "same text here", "same text here", "'s'll<|endoftext|>'", "é😀 中文 ٣", "x" * 4000, LONG]
SCHEMA = "doc_id long, text string, start string, sequence_id string, ids string, lang string, n_chars long"


def table(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "clash", "clash", "clash", "en", len(t or "")) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    ranks = {w: i for i, w in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 3


def test_pretokens_follow_the_pattern(library):
    rng = random.Random(1)
    alphabet = " \n\t'strevlmd1²ÀaZ!.  　 é中"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    data, begin, ends, first = _pretokens.pretokens(*_batch.buffer(pa.array(texts)))
    raw = data.tobytes()
    for k, text in enumerate(texts):
        got = [raw[begin[i] : ends[i]].decode() for i in range(first[k], first[k + 1])]
        assert got == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 3000).astype(np.uint64))
    assert sorted(bpe.PerfectHash(keys).find(keys).tolist()) == list(range(len(keys)))


def test_encode_and_decode(spark, odd, none, tik):
    got = by_id(bpe.digests(odd, RANKS))
    for i, text in enumerate(ODD):
        ids = np.array(tik.encode_ordinary(text or ""), "<u4")
        want = (len(ids), hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want
    assert bpe.digests(none, RANKS).count() == 0
    kept = bpe.encode(odd, RANKS)
    assert kept.columns == [c for c in odd.columns if c not in ("text", "ids")] + ["ids"]


# --- 4


def test_image_round_trip():
    rng = np.random.default_rng(0)
    for n in (1, 255, 256, 257, 4000):
        ids = rng.integers(0, 1 << 17, n)
        ids[rng.random(n) < 0.8] %= 300
        image = token_files.Image(token_files.write_image(ids, [None, 7], np.array([0, 1, n])))
        assert image.docs == [None, 7] and (image.ids() == ids).all()
        assert (image.ids(n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def test_token_files(spark, odd, none, library, tmp_path):
    docs = odd.unionAll(table(spark, ["no id"], [None])).orderBy(F.desc("doc_id"))
    token_files.write_tokens(docs, f"{tmp_path}/a", JSON)
    got = by_id(token_files.digests(token_files.read_tokens(spark, f"{tmp_path}/a")))
    at = 0
    for i, text in [(None, "no id"), *enumerate(ODD)]:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert tuple(got[i])[1:] == (at, len(ids), zlib.crc32(ids))
        at += len(ids)
    token_files.write_tokens(none, f"{tmp_path}/b", JSON)
    assert token_files.read_tokens(spark, f"{tmp_path}/b").count() == 0


# --- 10


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(0)
    lengths = sorted((rng.randint(1, 40) for _ in range(500)), reverse=True)
    room, want = [], []
    for need in lengths:
        fit = min((r for r in room if r >= need), default=None)
        want.append(fit)
        if fit is not None:
            room.remove(fit)
        room.append((fit or 40) - need)
    got = [None if offset == 0 else 40 - offset for _, offset in packing.best_fit(lengths, 40)]
    assert got == want


def test_packing(spark, odd, none, library):
    docs = odd.unionAll(table(spark, ["again", "again", "no id"], [3, 3, None]))
    rows = packing.pack(packing.cut(docs, JSON)).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for i, text in enumerate(ODD):
        if i != 3:
            ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
            at = 0
            for r in sorted(pieces[i], key=lambda r: r["start"]):
                part = ids[at : at + r["length"]]
                assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part), len(ids))
                at += r["length"]
            assert at == len(ids)
    assert len(pieces[3]) == 3 and len(pieces[None]) == 1
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.pack(packing.cut(none, JSON)).count() == 0


# --- 5


def plain_places(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    out = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), out


def test_licenses(spark, none):
    texts = [*ODD, "MIT license, mit\nLicense", "mit", "license mit", "the GNU general  PUBLIC-license é", "a " * 500]
    texts += ["x " * 70 + "Licensed, under CC BY NC 4.0 " + "y " * 70, "Licensed under the Apache License, Version 2.0."]
    got = by_id(licenses.scan(table(spark, texts)))
    for i, text in enumerate(texts):
        n, found = plain_places(text)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (n, len(found))
        places = [p for p, _ in found]
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[len(texts) - 2]["labels"] == "cc-by-nc" and got[len(texts) - 1]["score"] == 1
    assert licenses.scan(none).count() == 0


def test_license_blocks_against_plain_containment(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    templates = licenses.Templates()
    got = by_id(licenses.scan(docs, templates))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = [(label, word.findall(t.lower())) for label, t in licenses.TEMPLATES]
    known, want = [(label, set(t), len(t)) for label, t in split], []
    for r in docs.collect():
        words = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or ""))
        met = {x for _, x in plain_places(r["text"])[1]}
        for label, t, n in known:
            step = max(1, n // 4)
            for b in range(0, len(words), step):
                share = len(t & set(words[b : b + n + step]))
                if share >= np.ceil(licenses.CONTAINED * len(t) - 1e-9):
                    met.add(label)
                    want.append((r["doc_id"], b, min(b + n + step, len(words)), label, share / len(t)))
        assert got[r["doc_id"]]["labels"] == ",".join(sorted(met))
    found = licenses.blocks(docs, templates).drop("template").collect()
    assert sorted(map(tuple, found)) == sorted(want) and want


def test_scattered_words_are_no_license(spark, none):
    texts = ["the report was released today under pressure while noise and other license fees at mit rose"]
    texts += ["no commercial use. all rights reserved. no part of this work may be reproduced, they said", None, ""]
    texts += ["released today under protest: the license that mit gave up"]
    found = licenses.blocks(table(spark, texts)).collect()
    assert {(r["doc_id"], r["label"]) for r in found} == {(1, "proprietary")} and max(r["containment"] for r in found) == 1
    assert licenses.blocks(none).count() == 0


# --- 8


def plain_groups(texts, k, num, den):
    sets = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", low) if x]
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def near_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    texts = [*ODD, "A b C d", "a B c D", "one two", "One\ttwo", "two one"]
    for size in (6, 7, 8, 12, 30, 60, 200, 600):
        base = [rng.choice(words) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, size // 60, size // 40, size // 25, size // 10):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy[: len(copy) - rng.randint(0, 1)]))
    return texts


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 80, 100)])
def test_near_groups(spark, none, k, num, den, monkeypatch):
    texts = near_texts()
    for segment in (shingles.SEGMENT, 500):
        monkeypatch.setattr(shingles, "SEGMENT", segment)
        got = by_id(shingles.near_groups(table(spark, texts), k, num, den))
        assert [tuple(got[i])[1:] for i in range(len(texts))] == plain_groups(texts, k, num, den)
    assert shingles.near_groups(none, k, num, den).count() == 0


def test_one_of_each_group_stays(spark):
    docs = table(spark, ["a b c d e f", "x", "a b c d e f", "x", None, None], [5, 1, 4, 1, None, 9])
    left = shingles.first_of_group(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in left) == [(False, 1), (False, 4), (False, 9), (True, None)]


def test_signatures_meet_for_all_similar_sets():
    rng = np.random.default_rng(3)
    for num in (80, 85, 95):
        signer = shingles.Signatures(num, 100)
        for size in [*range(1, 40), 77, 150, 400, 1500]:
            for _ in range(8):
                a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
                for drop in range(0, size, max(1, size // 12)):
                    b = np.sort(np.append(a[drop:], rng.integers(0, 1 << 63, drop // 3).astype(np.uint64)))
                    shared = len(np.intersect1d(a, b))
                    if 100 * shared >= num * (len(a) + len(b) - shared):
                        assert np.intersect1d(signer.of(a), signer.of(b)).size


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 3), (9, 8), (8, 9), (None, 4), (7, 3), (5, 6)], "a long, b long")
    got = {(r["node"], r["root"]) for r in _graph.components(edges).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 1), (8, 8), (9, 8), (5, 5), (6, 5)}
    path = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert _graph.components(path).filter("root <> 0").count() == 0


# --- 9

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for rank, (name, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if ok:
                out.append((m.start(), rank, m.end(), name))
    return sorted(out)


def test_personal_data(spark, none):
    rng = random.Random(3)
    parts = ["4111111111111111", "4111 1111 1111 1111", " ", "é", "😀", "1.2.3.4", "256.1.1.1", "+1 (555) 123-4567"]
    parts += ["a@b.co", "@", "x.y", "-", "\n", ".", "a_b%c@d-e.f.g", "+", "0", "00", "7", "5500 0000 0000 0004"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += [*ODD, "1 " * 50000, "a.b" * 20000 + "@c" + ".d" * 20000, "x1.2.3.4 " * 300]
    got = by_id(pii.digests(pii.find(table(spark, texts))))
    for i, text in enumerate(texts):
        want = plain_spans(text)
        listed = ",".join(f"{name}:{a}:{b}" for a, _, b, name in want)
        assert got[i]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest(), text[:200]
        counts = [sum(w[3] == n for w in want) for n in PLAIN]
        assert [got[i][f"n_{n}"] for n in PLAIN] == counts
        assert set(filter(None, listed.split(","))) <= set(got[i]["spans"].split(","))
    assert pii.digests(pii.find(none)).count() == 0


def test_added_kinds_and_redaction(spark):
    texts = ["IBAN DE89370400440532013000 ok", "IBAN DE89370400440532013001 no", "my ssn 123-45-6789", "123-45-6789", None]
    texts += ["write to a@b.co or +1 (555) 123-4567, card 4111 1111 1111 1111 from 10.0.0.1"]
    docs = table(spark, texts)
    assert [r["spans"] for r in pii.digests(pii.find(docs)).orderBy("doc_id").collect()][:5] == [
        "iban:5:27", "", "ssn:7:18", "", "",
    ]
    clean = by_id(pii.redact(docs))
    assert clean[5]["text"] == "write to [EMAIL] or [PHONE], card [CARD] from [IP]" and clean[4]["text"] is None
    assert clean[5]["n_chars"] == len(clean[5]["text"]) and pii.redact(docs).columns == docs.columns


def test_cards_beside_each_other(spark):
    texts = ["4111-1111-1111-1111 5500000000000004", "5500 0000 0000 0004 12", "378282246310005 371449635398431"]
    texts += ["4111 1111 1111 1111", "4111-1111-1111-1112 5500000000000005", "order 4111111111111111 5500000000000004"]
    docs = table(spark, texts)
    spans = [r["spans"] for r in pii.digests(pii.find(docs)).orderBy("doc_id").collect()]
    assert spans == ["pan:0:19,pan:20:36", "pan:0:19", "pan:0:15,pan:16:31", "card:0:19", "", ""]
    clean = [r["text"] for r in pii.redact(docs).orderBy("doc_id").collect()]
    assert clean[:4] == ["[PAN] [PAN]", "[PAN] 12", "[PAN] [PAN]", "[CARD]"] and clean[4:] == texts[4:]


def test_account_numbers_before_capitals_and_digits(spark):
    plain, grouped = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    british, french = "GB29 NWBK 6016 1331 9268 19", "FR1420041010050500013M02606"
    numbers = [plain, grouped, british, french, "NO9386011117947", "LC55HEMM000100010012001200023015", "XX46370400440532013000"]
    after = [" Thanks", " OK", " 12", " 1234 5678", " A", ".", "", " é"]
    texts = [(f"IBAN {n}{a}", [n]) for n in numbers for a in after]
    texts += [(f"{a} {b}", [a, b]) for a in numbers for b in numbers]
    texts += [(f"Ref AB12 {grouped} X", [grouped]), (f"{plain}x", []), (f"x{plain}", []), (plain[:-1] + "1 OK", [])]
    texts += [(f"DE8937040044053201300 {british}", [british]), ("AB12 " * 20000 + plain, [plain])]
    docs = table(spark, [t for t, _ in texts])
    got, clean = by_id(pii.find(docs)), by_id(pii.redact(docs, kinds=("iban",)))
    for i, (text, want) in enumerate(texts):
        spans = [text[s["start"] : s["end"]] for s in got[i]["spans"] if s["kind"] == "iban"]
        assert spans == want, text[:100]
        for number in want:
            text = text.replace(number, "[IBAN]", 1)
        assert clean[i]["text"] == text


def test_words_count_as_near_across_other_matches(spark):
    one, two = "123-45-6789", "987-65-4321"
    texts = [f"SSN {one}, {two}", f"{one}, {two} SSN", f"release {one}, {two} ssn", f"ssn {'é' * 43} {one}", f"ssn {'é' * 44} {one}"]
    texts += [f"SSN {one} {two} {one} {two} {one} {two} {one}", f"{one}\n{two}", f"{one} {'😀' * 19} ssn", f"{one} {'x' * 21} ssn"]
    texts += ["ssn " + f"{one}, " * 3000]
    want = [2, 2, 0, 1, 0, 4, 0, 1, 0, 4]
    docs = table(spark, texts)
    got, clean = by_id(pii.find(docs)), by_id(pii.redact(docs, kinds=("ssn",)))
    for i, (text, n) in enumerate(zip(texts, want, strict=True)):
        spans = [(s["start"], s["end"]) for s in got[i]["spans"] if s["kind"] == "ssn"]
        assert len(spans) == n and all(text[a:b] in (one, two) for a, b in spans), text[:80]
        for a, b in reversed(spans):
            text = text[:a] + "[SSN]" + text[b:]
        assert clean[i]["text"] == text


# --- 1


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = toxicity.scores(docs, labels.filter("doc_id % 4 <> 0")).join(labels.filter("doc_id % 4 = 0"), "doc_id")
    rates = {r["toxic"]: r["rate"] for r in got.groupBy("toxic").agg(F.avg(F.col("rejected").cast("int")).alias("rate")).collect()}
    assert rates[1] > 0.95 and rates[0] < 0.03


def test_toxicity_without_labels_or_texts(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not any(r["rejected"] for r in toxicity.scores(odd, labels).collect())
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 1), (2, None, 1), (4, 0, 0)], labels.schema)
    assert toxicity.accepted(odd, one).count() == len(ODD)
    assert toxicity.scores(none, one).count() == 0


def test_toxicity_sample_counts_repeated_rows_once(spark):
    rng = random.Random(5)
    fill = [f"w{i}" for i in range(40)]
    texts = [" ".join([*rng.choices(fill, k=8), *(["vile", "curse"] if i % 2 else ["kind", "thanks"])]) for i in range(120)]
    ids = spark.range(120).select("id", F.xxhash64("id").alias("h")).orderBy("h").toPandas()["id"]
    hot = [next(int(i) for i in ids if i % 2 == v) for v in (0, 1)]  # the first that the sample takes of each value
    rows = [(i, 1, i % 2) for i in range(120)] + [(i, 1, i % 2) for i in hot for _ in range(100)]
    labels = spark.createDataFrame([*rows, (hot[1], 0, 0)], "doc_id long, quality int, toxic int")
    docs = table(spark, texts + [texts[i] for i in hot for _ in range(300)], [*range(120), *(i for i in hot for _ in range(300))])
    p = toxicity.train(docs, labels, sample=40).probabilities(pa.array(texts))[:, 1]
    assert [bool(x >= toxicity.THRESHOLD) for x in p] == [bool(i % 2) for i in range(120)]
    joined = docs.select("doc_id", "text", F.lit(0).alias("low"), (F.col("doc_id") % 2).alias("toxic"))
    assert toxicity.one_text(joined.union(joined.withColumn("text", F.lit(None)))).filter("text > ''").count() == 120


# --- 2 and 6


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string, score string")


def odd_vectors(spark, n=300, dims=16):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(n, dims)).astype(np.float32) / 4
    values[40:90] = values[0]  # one vector many times
    values[7] = 0
    rows = [(i, v.tolist(), "clash", "clash") for i, v in enumerate(values)]
    bad = [None, [], [1.0], [float("nan")] * dims, [None] + [1.0] * (dims - 1), [float("inf")] * dims]
    return vectors(spark, rows + [(1000 + i, v, "", "") for i, v in enumerate(bad)] + [(None, rows[0][1], "", "")]), values


def test_pivot_search_is_exact(spark, monkeypatch):
    df, values = odd_vectors(spark)
    whole = np.floor(256 * values.astype(np.float64))
    monkeypatch.setattr(pivot_search, "ROWS", 64)
    monkeypatch.setattr(pivot_search, "RING", 16)
    got = defaultdict(list)
    for r in pivot_search.search(df, every=10, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    ids = np.arange(len(values))
    assert sorted(got) == list(range(0, len(values), 10))
    for q, found in got.items():
        score = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:5]
        assert found == [(i, int(score[i])) for i in order]
    assert pivot_search.search(df.filter("vec_id = 0"), every=10, k=5).count() == 0
    assert pivot_search.search(df.filter("false"), every=10, k=5).count() == 0


def test_hashing_search_recall(spark, sf_dir):
    df = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.1") + "/embeddings.parquet")
    rows = df.orderBy("vec_id").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), np.float64)
    got = defaultdict(list)
    for r in hashing_search.search(df, every=20, k=20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        want = {int(i) for i in ids[[i for i in np.lexsort((ids, -score)) if i != q][:20]]}
        found = got[ids[q]]
        assert len(found) == len(want) and [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        hits, total = hits + len(want & {i for i, _ in found}), total + len(want)
    assert hits / total >= 0.9


def test_hashing_search_odd_rows(spark):
    df, _ = odd_vectors(spark)
    rows = hashing_search.search(df, every=50, k=20).collect()
    assert {r["query_id"] for r in rows} == set(range(0, 300, 50)) and not any(r["vec_id"] in (7, None) for r in rows)
    assert hashing_search.search(df.filter("vec_id < 3"), every=2, k=20).count() == 4
    assert hashing_search.search(df.filter("false"), every=20, k=20).count() == 0


def copied_vectors(queries=8, dims=32, near=15, copies=600, others=1000):
    """Each query has some near vectors, and a little farther off a large group of copies of one vector."""
    rng = np.random.default_rng(4)

    def at(v, cosine):
        side = rng.normal(size=dims)
        side -= (side @ v) * v
        return cosine * v + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side)

    asked = rng.normal(size=(queries, dims))
    asked /= np.linalg.norm(asked, axis=1)[:, None]
    rest = []
    for v in asked:
        rest += [at(v, 0.5) for _ in range(near)] + [at(v, 0.45)] * copies
    rest += [v / np.linalg.norm(v) for v in rng.normal(size=(others, dims))]
    ids = [i for i in range(1, 2 * len(rest)) if i % 20][: len(rest)]
    return np.array([20 * i for i in range(1, queries + 1)] + ids), np.concatenate([asked, rest])


def test_hashing_search_recall_among_copies(spark, monkeypatch):
    ids, x = copied_vectors()
    df = spark.createDataFrame(list(zip(ids.tolist(), x.tolist(), strict=True)), "vec_id long, embedding array<double>")
    monkeypatch.setattr(hashing_search, "SAMPLE", 512)
    got = defaultdict(list)
    for r in hashing_search.search(df, every=20, k=20).collect():
        got[r["query_id"]].append(r["score"])
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = np.sort(np.delete(x @ x[q], q))[::-1]
        assert len(got[ids[q]]) == 20
        hits += sum(s >= score[19] - 1e-9 for s in got[ids[q]])
    assert hits / 160 >= 0.95


@pytest.mark.parametrize(("search", "every", "k"), [(hashing_search.search, 20, 20), (pivot_search.search, 50, 5)])
def test_searches_count_repeated_rows_once(spark, search, every, k):
    df, _ = odd_vectors(spark)
    hot = df.filter("vec_id IN (0, 3, 100)").crossJoin(spark.range(40).select())
    want = sorted(map(tuple, search(df, every=every, k=k).collect()))
    got = sorted(map(tuple, search(df.union(df).union(hot), every=every, k=k).collect()))
    assert got == want and len(got) == len({(q, i) for q, _, i, _ in got}) == len({q for q, *_ in got}) * k


def test_ids_with_several_vectors(spark, monkeypatch):
    df, values = odd_vectors(spark)
    more = [(i, values[j].tolist(), "", "") for i, j in ((0, 5), (10, 3), (11, 4), (11, 6), (12, 200), (12, 201), (0, 201))]
    ids = np.array([*range(300), *(r[0] for r in more)])
    whole = np.floor(256 * np.concatenate([values, [r[1] for r in more]]).astype(np.float64))
    monkeypatch.setattr(pivot_search, "ROWS", 64)
    got = defaultdict(list)
    for r in pivot_search.search(df.union(vectors(spark, more)), every=10, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in range(0, 300, 10):
        score = defaultdict(lambda: -np.inf)
        for i, s in zip(np.tile(ids, (ids == q).sum()), np.concatenate([whole @ v for v in whole[ids == q]]), strict=True):
            score[int(i)] = max(score[int(i)], s)
        assert got[q] == sorted(((i, s) for i, s in score.items() if i != q), key=lambda x: (-x[1], x[0]))[:5]


def test_pigeonhole_probing_finds_every_code():
    codes = np.random.default_rng(0).integers(0, 1 << 16, (400, 4)).astype(np.uint16)
    index = hashing_search.Index(codes)
    for radius in (0, 9, 20, 25, 64):
        far = np.bitwise_count(codes ^ codes[5]).sum(1)
        assert index.within(codes[5], radius).tolist() == np.flatnonzero(far <= radius).tolist()


# --- 7


def test_chat_recovers_hidden_roles(spark, sf_dir):
    talks = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/conversations.parquet")
    hidden = talks.withColumn("role", F.when(F.col("conv_id") % 4 != 0, F.col("role")))
    got = chat.format_chats(hidden).join(talks.select("conv_id", "turn", F.col("role").alias("known")), ["conv_id", "turn"])
    right = got.filter("conv_id % 4 = 0").agg(F.avg((F.col("role") == F.col("known")).cast("int"))).first()[0]
    assert right > 0.85


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "User: hi\nthere\nAssistant: yes?"), (1, 1, None, None), (1, 1, None, ""), (None, None, "x", "### Human: q")]
    rows += [(2, 0, "user", "same")] * 3
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = sorted((str(r["conv_id"]), r["segment"], r["role"], r["rendered"]) for r in chat.format_chats(df).collect())
    assert ("1", 0, "user", "<|user|>\nhi\nthere\n<|end|>") in got and ("1", 2, "assistant", "<|assistant|>\nyes?\n<|end|>") in got
    assert ("None", 0, "user", "<|user|>\nq\n<|end|>") in got and len(got) == 5
    assert chat.format_chats(df.filter("false")).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_viterbi_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    n, roles = 6, len(chat.ROLES)
    scores, step, entry = rng.normal(size=(n, roles)), rng.normal(size=(roles, roles)), rng.normal(size=roles)
    begins = (rng.random(n) < 0.6).astype(np.int64)
    last = None if seed % 2 else int(rng.integers(roles))

    def worth(path):
        ways = [entry[path[0]] if not begins[0] else max(entry[r] + step[r, path[0]] for r in range(roles))]
        ways += [step[a, b] if own else 0.0 if a == b else -np.inf for a, b, own in zip(path, path[1:], begins[1:])]
        return sum(ways) + sum(scores[i, r] for i, r in enumerate(path))

    paths = [p for p in itertools.product(range(roles), repeat=n) if last in (None, p[-1])]
    got = tuple(chat.viterbi(scores, begins, step, entry, last).tolist())
    assert got in paths and worth(got) == pytest.approx(max(map(worth, paths)))


def test_long_conversation_is_cut_without_a_trace(spark):
    rows = [(1, i, "user" if i % 2 else None, f"sure, {i}\nAssistant: and {i}") for i in range(600)]
    marked = chat.lines(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    model = chat.train(marked)
    got = chat.recover(marked, model).toPandas().sort_values(["turn", "line"])
    plain = marked.toPandas().sort_values(["turn", "line"])
    begins = plain["begins"].to_numpy().copy()
    begins[0] = 0
    scores = model.scores(pa.RecordBatch.from_pandas(plain[list(chat._SIZES)]))
    assert got["role"].tolist() == chat.viterbi(scores, begins, model.step, model.start, None).tolist()


# --- all together


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = toxicity.scores(docs, labels).filter("NOT rejected").select("doc_id").toPandas()["doc_id"]
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    left = sorted(i for i in texts if i in set(kept))
    roots = plain_groups([texts[i] for i in left], 5, 80, 100)
    want = {i for n, (i, (_, root)) in enumerate(zip(left, roots, strict=True)) if root == n}
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(got["doc_id"]) == want
    assert (got.groupby("doc_id")["length"].sum() == got.groupby("doc_id")["doc_tokens"].first()).all()


def test_stages_return_the_columns_of_documents(spark, odd, sf_dir):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns, name
        assert stage(spark, odd.filter("false"), sf_dir).count() == 0


def test_one_query_of_each_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
