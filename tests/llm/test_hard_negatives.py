"""Hard negatives against a brute-force search, with ties, copies and several shards."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from lodgestar.llm import hard_negatives as hard
from validation.compare import connect, normalised

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q int, shard int, kind int"


def brute(rows, every=50):
    """Results by the definition, over ``(vec_id, vector, label)``."""
    used = [
        (i, [int(np.floor(256 * float(x))) for x in v], label)
        for i, v, label, *_ in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and np.isfinite(x) for x in v)
    ]
    out, done = [], set()
    for own, a, label in used:
        if own % every or (own, tuple(a), label) in done:
            continue
        done.add((own, tuple(a), label))
        scored = [
            (-sum(x * y for x, y in zip(a, b)), other, k)
            for other, b, k in used
            if other != own and len(a) == len(b)
        ]
        scored.sort()
        for p, positive, k in [s for s in scored if s[2] == label][:5]:
            band = [s for s in scored if s[2] != label and -50 * p <= -100 * s[0] <= -95 * p]
            for rank, (n, negative, _) in enumerate(band[:3], 1):
                out.append((own, positive, rank, negative, -p, -n))
    return sorted(out)


def found(spark, rows, every=50):
    frame = spark.createDataFrame(rows, SCHEMA)
    result = hard.hard_negatives(frame, F.col("vec_id") % every == 0)
    return sorted(tuple(row) for row in result.collect())


def random_rows(count, dimension, seed):
    """Clusters, copies and vectors of different lengths; a third of the rows are one vector."""
    random = np.random.default_rng(seed)
    centres = random.normal(size=(6, dimension))
    rows = []
    for i in range(count):
        v = centres[i % 6] + random.normal(size=dimension) * 0.3
        v = v * random.choice([0.1, 0.5, 1.0, 1.02])
        if i % 3 == 0:
            v = centres[0]
        rows.append((i, [float(np.float32(x)) for x in v], i % 4, "x", 1, 2, 3))
    return rows


@pytest.mark.parametrize("shards", [1, 5])
@pytest.mark.parametrize("dimension", [1, 6])
def test_equals_brute_force(spark, monkeypatch, shards, dimension):
    rows = random_rows(400, dimension, seed=dimension)
    monkeypatch.setattr(hard, "SHARD_VALUES", 400 * dimension // shards)
    monkeypatch.setattr(hard, "SHARD", 100)
    monkeypatch.setattr(hard, "BUCKET", 32)
    assert found(spark, rows, every=20) == brute(rows, every=20)


def test_awkward_rows(spark):
    rows = random_rows(60, 3, seed=3)
    nan, inf = float("nan"), float("inf")
    rest = ("x", 1, 2, 3)
    rows += [
        (100, None, 1, *rest),
        (150, [1.0, nan, 1.0], 1, *rest),
        (200, [1.0, None, 1.0], 1, *rest),
        (250, [1.0, inf, 1.0], 1, *rest),
        (300, [1.0, 1.0, 1.0], None, *rest),
        (None, [1.0, 1.0, 1.0], 1, *rest),
        (350, [0.0, 0.0, 0.0], 1, *rest),
        (400, [], 1, *rest),
        (450, [], 1, *rest),
        (451, [], 2, *rest),
        (500, [1.0, 2.0], 0, *rest),
        (501, [1.0, 2.0], 0, *rest),
        (502, [1.0, 1.0], 1, *rest),
        (550, [1.0, 1.5, 1.0], 1, *rest),
        (550, [1.0, 1.5, 1.0], 1, *rest),
        (550, [0.5, 1.5, 1.0], 2, *rest),
        (551, [0.9, 1.0, 1.0], 1, *rest),
        (551, [0.9, 1.0, 1.0], 1, *rest),
    ]
    assert found(spark, rows) == brute(rows)
    far = [*rows, (600, [3e38, 0.0, 0.0], 1, *rest)]  # its scores fit no long
    assert found(spark, far) == brute(rows)
    assert found(spark, []) == []


def test_large_scores_are_exact(spark):
    rows = [(i, [2.0**21 + i, 2.0**20 + i], i % 2, "x", 1, 2, 3) for i in range(40)]
    assert found(spark, rows, every=10) == brute(rows, every=10)


def test_coordinates_prune_and_lose_nothing():
    random = np.random.default_rng(5)
    rows = np.concatenate([random.normal(size=(4_000, 16)) * 100, random.normal(size=(96, 16)) * 2])
    rows[::40] = np.abs(rows[::40, ::-1]) + 150
    shard = hard.buckets(np.arange(len(rows)), np.zeros(len(rows)), np.floor(rows))
    assert sum(len(b.ids) for b in shard) == len(rows) and len(shard) > 4
    assert all(len(b.ids) <= hard.BUCKET for b in shard)
    anchor = hard.Anchor(-1, 0, np.floor(rows[40]))
    every = np.floor(rows) @ anchor.row
    least = float(np.quantile(every, 0.99))
    met, reached = 0, set()
    for bucket in shard:
        some = bucket.candidates(anchor.unit, anchor.focus, anchor.length, least)
        ids = bucket.ids[some]
        met += len(ids)
        reached |= set(ids[bucket.rows[some] @ anchor.row >= least].tolist())
    assert reached == set(np.flatnonzero(every >= least).tolist())
    assert met < len(rows) / 4


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    frame = entry_module.queries()["op11_hard_negatives"](spark, folder)
    actual = normalised(frame.columns, frame.collect())
    result = connect(folder).execute(entry_module.oracle_sql()["op11_hard_negatives"])
    assert actual == normalised([c[0] for c in result.description], result.fetchall())
    assert len(actual[1]) > 0
