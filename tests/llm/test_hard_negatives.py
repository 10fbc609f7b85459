"""Hard negatives against brute force, and the pruning of coordinate lists."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assay.llm import hard_negatives as mining
from assay.llm.shared import ship_package

SCHEMA = "vec_id long, embedding array<float>, label int, part string, score string, slot int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "p", "s", 1) for row in rows], SCHEMA)


def brute_force(rows, anchors, positives=5, negatives=10):
    usable = {}
    for i, vector, label in rows:
        if i is None or label is None or not vector:
            continue
        if any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector)
        usable[i, label, whole] = None
    listed = list(usable)
    found = []
    for a, label, q in listed:
        if not anchors(a):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, v)), i, other)
            for i, other, v in listed if i != a and len(v) == len(q)
        )
        for minus, positive, _ in [s for s in scored if s[2] == label][:positives]:
            score = -minus
            fits = [
                (i, -m) for m, i, other in scored
                if other != label and 30 * score <= -100 * m <= 90 * score
            ]
            found += [
                (a, positive, rank, i, score, s)
                for rank, (i, s) in enumerate(fits[:negatives], 1)
            ]
    return sorted(found)


def odd_rows():
    random = np.random.default_rng(4)
    rows = [
        (i, [float(x) for x in random.normal(size=6) * random.choice([0.01, 1, 30])],
         int(random.integers(0, 4)))
        for i in range(200)
    ]
    rows += [(300 + i, [0.5, -0.25, 0.125, 0.0, 1.0, 0.75], i % 3) for i in range(60)]  # ties
    rows += [rows[40], rows[210]]  # repeated rows
    rows += [(10, rows[3][1], 2)]  # an id with two vectors
    rows += [
        (400, None, 1), (401, [], 1), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
        (403, [float("nan")] * 6, 1), (404, [float("inf")] * 6, 1), (405, [0.0] * 6, 1),
        (410, [0.0] * 6, 2), (406, [1.0] * 6, None), (None, [1.0] * 6, 1), (420, [1.0, 2.0], 1),
        (421, [1.0, 1.0], 1), (422, [0.5, 0.25], 3),
    ]
    return rows


@pytest.mark.parametrize("bucket", [8192, 9])
def test_equals_brute_force(spark, bucket):
    rows = odd_rows()
    found = mining.mine_hard_negatives(
        vectors(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"),
        rows_a_bucket=bucket, queries_a_block=8,
    )
    assert sorted(map(tuple, found.collect())) == brute_force(rows, lambda i: i % 10 == 0)


def test_without_rows_anchors_or_partners(spark):
    def mined(rows):
        return mining.mine_hard_negatives(
            vectors(spark, rows), F.col("vec_id") == 0, F.col("label")
        ).count()

    assert mined([]) == 0
    assert mined([(1, [1.0, 2.0], 1)]) == 0
    assert mined([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1)]) == 0
    assert mined([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2)]) == 0


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.integers(-50, 50), min_size=5, max_size=5), min_size=1, max_size=40),
    st.lists(st.integers(-50, 50), min_size=5, max_size=5),
    st.integers(-9000, 9000),
)
def test_no_row_that_reaches_the_threshold_is_cut(rows, query, threshold):
    values, asked = np.array(rows), np.array(query)
    bucket = mining.Bucket(np.arange(len(rows)), np.zeros(len(rows)), values)
    kept = set(bucket.candidates(asked, threshold).tolist())
    assert kept >= set(np.flatnonzero(values @ asked >= threshold).tolist())


def test_most_rows_below_a_high_threshold_are_cut():
    random = np.random.default_rng(6)
    spread = random.normal(size=(4000, 8))
    values = np.round(256 * spread / np.linalg.norm(spread, axis=1, keepdims=True)).astype(np.int64)
    query = values[0]
    scores = values @ query
    bucket = mining.Bucket(np.arange(4000), np.zeros(4000), values)
    kept = bucket.candidates(query, int(np.sort(scores)[-20]))
    assert 20 <= len(kept) < 1000
