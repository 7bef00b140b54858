"""Corpus operators against brute force, with nulls, empty texts, ties, repeats and empty tables."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
import corpus_pipeline
from lodgestar.llm import (
    ann,
    embedding_dedup,
    licenses,
    line_dedup,
    mixing,
    packing,
    secrets,
    simhash,
    substring_dedup,
    toxicity,
)
from lodgestar.llm.graph import connected_components
from validation.compare import connect, normalised

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int"
PASSAGE = " ".join(f"w{i}" for i in range(40))
ROWS = [
    (1, PASSAGE + " alpha", "en", "b", 1, 9),
    (2, "x y z " + PASSAGE, "en", None, 1, 9),
    (3, None, "en", "a", None, None),
    (4, "", None, "a", 0, 1),
    (5, "a\nb\nc\nd\na\nb\nc", "en", "a", 1, 1),
    (6, "q\na\nb\nc", "en", "a", 1, 1),
    (7, "w " * 30_000, "en", "b", 1, 1),
    (7, "w " * 30_000, "en", "b", 1, 1),
    (None, PASSAGE, "en", "b", 1, 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["op1_mixing", "op3_line_dedup"])
def test_query_equals_sql(spark, name):
    frame = entry_module.queries()[name](spark, FOLDER)
    actual = normalised(frame.columns, frame.collect())
    result = connect(FOLDER).execute(entry_module.oracle_sql()[name])
    assert actual == normalised([c[0] for c in result.description], result.fetchall())


def test_mix_takes_targets(docs, empty):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(ROWS)
    taken = {}
    for row in rows:
        assert row.taken <= 3 * row.size
        taken.setdefault(row.source, [0, row.target])[0] += row.taken
    assert all(abs(words - target) <= 2 for words, target in taken.values())
    assert mixing.mix_sources(empty).count() == 0


def test_targets_are_capped_and_reshared(spark):
    docs = spark.createDataFrame([(1, "a " * 10, "a"), (2, "b " * 80, "b"), (3, "c c", "c")],
                                 "doc_id long, text string, source string")
    targets = {r.source: r.target for r in mixing.source_targets(mixing.with_draws(docs)).collect()}
    assert targets["c"] == 6 and targets["a"] == pytest.approx(86 / 3) and sum(targets.values()) == pytest.approx(92)


@pytest.mark.parametrize("weight", [1.0, 0.25, 0.01, 1e-12, 1e9])
def test_key_ranges_are_small_at_any_weight(spark, weight):
    rows = spark.range(200_000).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit("x y z").alias("text")
    )
    drawn = mixing.with_draws(rows, quality=F.lit(weight))
    span = F.floor(F.log2("mix_.place.draw") * mixing.RANGES)
    largest = drawn.groupBy(span.alias("span")).count().agg(F.max("count")).first()[0]
    assert largest <= 200_000 * 0.0003  # 0.007 % expected, and chance
    mixed = mixing.mix_drawn(drawn, (1,), 3)
    assert mixed.agg(F.sum("taken")).first()[0] == 600_000


def test_line_dedup_keeps_first_windows(docs, empty):
    kept = {(r.doc_id, r.n_lines): (r.n_removed, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()}
    assert kept[5, 7] == (3, "a\nb\nc\nd")
    assert kept[6, 4] == (3, "q")
    assert kept[3, 0] == (0, "") and kept[4, 0] == (0, "")
    assert line_dedup.dedup_lines(empty).count() == 0


def _brute_substrings(rows):
    firsts = {}
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        for at in range(len(words) - 12):
            if doc is not None:
                key = tuple(words[at : at + 13])
                firsts[key] = min(doc, firsts.get(key, doc))
    out = []
    for doc, text, *_ in rows:
        words = (text or "").encode().split()
        gone = set()
        for at in range(len(words) - 12):
            if doc is not None and firsts.get(tuple(words[at : at + 13]), doc) < doc:
                gone.update(range(at, at + 13))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_substrings_equal_brute_force(spark, docs, empty):
    found = sorted(map(tuple, substring_dedup.dedup_substrings(docs).collect()), key=str)
    assert found == _brute_substrings(ROWS)
    assert substring_dedup.dedup_substrings(empty).count() == 0
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    found = sorted(map(tuple, substring_dedup.dedup_substrings(frame).collect()), key=str)
    assert found == _brute_substrings(rows)


def test_automata_decide_what_is_repeated(monkeypatch):
    passage = " ".join(f"w{i}" for i in range(30))
    group = pd.DataFrame({
        "owner": [1, 1, 1, 1], "id": [1, 2, 3, 1], "content": [0, 0, 0, 0], "at": [5, 7, 0, 90],
        "piece": [passage, "x " + passage, "y " * 14 + "z", "y " * 14 + "y"],
    })
    found = substring_dedup._search(group)
    ranges = found[found["h"].isna()][["id", "starts", "ends"]].values.tolist()
    assert ranges == [[2, 8, 38], [3, 0, 14]]
    assert sorted(found[found["h"].notna()][["id", "starts"]].values.tolist()) == [[2, 7], [3, 2]]
    monkeypatch.setattr(substring_dedup, "SIGNS", 8)  # two signs a word
    assert substring_dedup._search(group).equals(found)

    class Empty(substring_dedup.Phrases):
        def __init__(self, passages, holders):
            super().__init__([], [])

    monkeypatch.setattr(substring_dedup, "Phrases", Empty)
    assert substring_dedup._search(group)["h"].notna().all()


def test_windows_that_the_owner_lacks_are_found(spark):
    """Documents share an anchor with the smallest one, but whole windows only with each other."""
    generator = np.random.default_rng(11)
    pool = [" ".join(f"v{generator.integers(9)}" for _ in range(6)) for _ in range(6)]
    rows = [(i, " ".join(generator.choice(pool, 12))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, substring_dedup.dedup_substrings(frame).collect()), key=str)
    assert found == _brute_substrings(rows)


def _brute_components(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def _brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, empty):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    frame = frame.union(spark.createDataFrame([(10_001, None), (10_002, "")], frame.schema))
    prints = {r.doc_id: _brute_fingerprint(r.text) for r in frame.collect()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    expected = _brute_components(links, prints)
    found = simhash.simhash_components(frame).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        d: (f"{p:016x}", expected[d]) for d, p in prints.items()
    }
    assert simhash.simhash_components(empty).count() == 0


def test_masks_cover_every_difference():
    generator = np.random.default_rng(1)
    for positions in (range(64), range(3, 34)):
        masks = simhash.covering_masks(list(positions))
        for _ in range(500):
            bits = generator.choice(list(positions), 4, replace=False)
            assert any(not any(m >> int(b) & 1 for b in bits) for m in masks)


def test_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE_BUCKET", 3)
    generator = np.random.default_rng(2)
    base = generator.integers(0, 1 << 62, 5)
    points = sorted({int(b) ^ sum(1 << int(i) for i in generator.choice(62, k, replace=False))
                     for b in base for k in (0, 1, 2, 3, 5, 6) for _ in range(4)})
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    links = [(a, b) for a in points for b in points if a < b and (a ^ b).bit_count() <= 4]
    expected = _brute_components(links, points)
    found = connected_components(simhash.fingerprint_links(frame)).collect()
    assert {r.node: r.component for r in found} == {
        n: c for n, c in expected.items() if n != c or c in {expected[m] for m in points if m != n}
    }


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (None, 3)], "a long, b long")
    found = {r.node: r.component for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(31)}, 50: 40, 40: 40}


@pytest.fixture(scope="module")
def vectors(spark):
    generator = np.random.default_rng(3)
    points = generator.normal(size=(300, 16))
    points[100:140] = points[0] + generator.normal(scale=0.05, size=(40, 16))
    points[200:210] = points[1]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(400, None), (401, [0.0] * 16), (402, [float("nan")] * 16), (403, [None] + [1.0] * 15)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>"), points


def test_embedding_links_equal_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 64)
    frame, points = vectors
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    nodes = list(range(300))
    expected = _brute_components([(i, j) for i in nodes for j in nodes if i < j and close[i, j]], nodes)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame).collect()}
    assert len(found) == 304
    for i in nodes:
        assert (found[i].n_links, found[i].component_id) == (close[i].sum() - 1, expected[i])
    assert all(found[i].n_links == 0 and found[i].kept for i in (400, 401, 402, 403))
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_of_other_lengths_meet_only_their_like(vectors):
    frame, points = vectors
    rows = [(500, [1.0, 2.0]), (550, [1.0, 2.0]), (501, [1.0, 2.1]), (600, []), (601, [])]
    more = frame.union(frame.sparkSession.createDataFrame(rows, frame.schema))
    plain = {tuple(r) for r in embedding_dedup.near_duplicates(frame).collect()}
    found = {tuple(r) for r in embedding_dedup.near_duplicates(more).collect()}
    assert found - plain == {(500, 1, 500, True), (550, 1, 500, False), (501, 0, 501, True),
                             (600, 0, 600, True), (601, 0, 601, True)}
    near = {tuple(r) for r in ann.search(more.where("vec_id >= 500"), more).collect()}
    assert {(q, rank, v) for q, rank, v, _ in near} == {
        (500, 1, 550), (500, 2, 501), (550, 1, 500), (550, 2, 501), (501, 1, 500), (501, 2, 550)
    }


def test_search_with_clashing_columns_and_repeated_rows(vectors):
    frame, _ = vectors
    few = frame.where("vec_id < 4 OR vec_id >= 400")
    few = few.union(few.where("vec_id = 2")).union(few.where("vec_id = 2"))
    wide = few.select("*", *[F.lit("x").alias(n) for n in ("id", "vector", "shard", "block", "size", "member")])
    for method in (embedding_dedup.near_duplicates, lambda f: ann.search(f.where("vec_id < 3"), f)):
        assert sorted(map(tuple, method(wide).collect())) == sorted(map(tuple, method(few).collect()))
    near = ann.search(few.where("vec_id = 0"), few).collect()
    assert sorted(r.vec_id for r in near) == [1, 2, 2, 2, 3] and [r.rank for r in near] == [1, 2, 3, 4, 5]


def test_line_dedup_takes_any_column_names(docs):
    names = ("starts", "id_", "content_", "own", "doc", "id", "content", "STARTS_")
    wide = docs.select("*", *[F.lit(n).alias(n) for n in names])
    plain = line_dedup.dedup_lines(docs)
    found = line_dedup.dedup_lines(wide)
    assert found.columns == [*wide.columns, "n_lines", "n_removed", "kept_text"]
    assert all(r[n] == n for r in found.collect() for n in names)
    key = lambda rows: sorted(map(str, rows))
    assert key(found.select(*plain.columns).collect()) == key(plain.collect())


def test_exact_search_equals_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 8)
    frame, points = vectors
    found = ann.search(frame.where("vec_id % 50 = 0"), frame).collect()
    for query in range(0, 300, 50):
        distance = np.sqrt(((points - points[query]) ** 2).sum(axis=1))
        distance[query] = np.inf
        order = np.lexsort((np.arange(300), distance))[:10].tolist()
        mine = sorted((r.rank, r.vec_id) for r in found if r.query_id == query)
        assert [v for _, v in mine] == order
    assert ann.search(frame.limit(0), frame).count() == 0
    # Many shards, several blocks of queries, each vector dealt once.
    monkeypatch.setattr(ann, "SHARD", 2)
    monkeypatch.setattr(ann, "QUERIES", 2)
    again = ann.search(frame.where("vec_id % 50 = 0"), frame).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found)) and len(found) == 60
    monkeypatch.setattr(ann, "SHARD_VALUES", 160)
    again = ann.search(frame.where("vec_id % 50 = 0"), frame).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_equal_vectors_spread_over_shards(spark, monkeypatch):
    """Every vector is dealt once, every query once a shard, and copies do not meet in one."""
    monkeypatch.setattr(ann, "SHARD", 1)
    seen = []
    deal = ann._dealt
    monkeypatch.setattr(ann, "_dealt", lambda *given: seen.append(deal(*given)) or seen[-1])
    point = F.array(F.lit(1.0), F.lit(2.0)).alias("embedding")
    for n, shards in ((400, 20), (1_600, 40)):
        frame = spark.range(n).select(F.col("id").alias("vec_id"), point)
        found = ann.search(frame.where("vec_id % 100 = 0"), frame).collect()
        assert len(found) == n // 100 * 10 and {r.score for r in found} == {0.0}
        assert sorted(r.vec_id for r in found if r.query_id == 0) == list(range(1, 11))
        sizes = [r["count"] for r in seen[-1].groupBy("shard").count().collect()]
        assert len(sizes) == shards and sum(sizes) == n + n // 100 * shards
        assert max(sizes) <= 3 * (n // shards) + n // 100


def test_packing_round_trip(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    texts = [t for s in special for t in (s, f"hello {s} world", f"日本 {s}{s}x", s[:-1], f" {s.upper()} ")]
    more = [(100 + n, text, "en", "b", 1, 1) for n, text in enumerate(texts)]
    assert len(special) > 0
    docs = docs.union(docs.sparkSession.createDataFrame(more, docs.schema))
    rows = packing.pack_documents(docs, path).collect()
    expected = []
    for doc, text, *_ in ROWS + more:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 1024):
            piece = np.array(ids[start : start + 1024], "<u4")
            expected.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(expected, key=str)
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in sequences.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    assert packing.pack_documents(empty, path).count() == 0


def test_fast_ids_are_those_of_the_tokenizer():
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    generator = np.random.default_rng(4)
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xC0, 0x180)] if chr(c) not in "×÷"]
    for _ in range(2_000):
        text = "".join(generator.choice(letters, generator.integers(1, 40)))
        assert encoder.plain.fullmatch(text)
        ids = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder(text).tolist() == ids
    assert len(encoder("漢字\x1c 1")) > 0


def test_histogram_packs_all_pieces():
    histogram = {1024: 3, 700: 5, 300: 9, 24: 4, 1: 2}
    patterns = packing.pack_histogram(histogram)
    placed = {}
    for pattern in patterns:
        assert sum(size * times for size, times in pattern.parts) <= 1024
        for size, times in pattern.parts:
            placed[size] = placed.get(size, 0) + times * pattern.count
    assert placed == histogram


def test_toxicity_finds_spoilt_insults():
    # The same frames, so that only the insults set the classes apart.
    names = ("gardener", "river", "teacher", "window", "mountain", "sailor")
    calm = [
        f"you are such a {names[i % 6]} {i} again." if i % 2 else f"what a {names[i % 6]} {i}."
        for i in range(60)
    ]
    rude = [f"you are such a blockhead {i} again." if i % 2 else f"what a nitwit {i}." for i in range(60)]
    model = toxicity.train(calm + rude, [0] * 60 + [1] * 60)
    features = toxicity.featurizer(model.landmarks)

    def score(text):
        values = features.pooled(toxicity.sentences(text) or [[]])
        return float(model.probability((values @ model.weights + model.bias).max()))

    assert score("a blockhead here") > 0.5 and score("b-l-o-c-k-h-e-a-d") > 0.5
    assert score("n i t w i t") > 0.5
    assert score("gardens and rivers") < 0.5 and score("") < 0.5


def test_toxicity_held_out(spark, docs, empty):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = entry_module.queries()["op4_toxicity"](spark, folder).join(labels, "doc_id")
    clean = found.where("held_out AND toxic = 0").agg(F.avg("predicted")).first()[0]
    caught = found.where("held_out AND toxic = 1").agg(F.avg("predicted")).first()[0]
    assert clean < 0.03 and caught > 0.6
    model = toxicity.train([], [])
    assert toxicity.score(docs, model).count() == len(ROWS)
    assert toxicity.score(empty, model).count() == 0


def test_license_spans(spark, empty):
    texts = [(1, "x y Released under the MIT License. z"), (2, "released under the very MIT license"),
             (3, None), (4, "under the hood")]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    spans = {(r.doc_id, r.license): (r.first_word, r.last_word, r.coverage) for r in found}
    assert spans == {(1, "MIT"): (2, 7, 1.0), (2, "MIT"): (0, 6, 1.0)}
    assert licenses.scan(empty).count() == 0


def test_secrets_without_python(spark, empty):
    frame = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = secrets.scan(frame)
    assert "Python" not in found._jdf.queryExecution().toString()
    hashes = {r.sha256 for r in found.collect()}
    planted = frame.select(
        F.explode(F.regexp_extract_all("text", F.lit(r'token = "([0-9a-f]{40})"'), 1)).alias("s")
    )
    planted = {hashlib.sha256(r.s.encode()).hexdigest() for r in planted.collect()}
    assert planted and planted <= hashes and len(hashes) <= 1.5 * len(planted) + 20
    assert secrets.scan(empty).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, folder).cache()
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] == counts[2] > counts[3] and counts[4] > 0
    assert corpus_pipeline.run(spark, folder).count() > counts[4]
