"""Neighbour searches against brute force, and their odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import ann, topk
from assay.llm.shared import ship_package

SCHEMA = "vec_id long, embedding array<float>, rank string, score string, cell int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "r", "s", 1) for i, v in rows], SCHEMA)


def odd_rows():
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in random.normal(size=6)]) for i in range(120)]
    rows += [(200 + i, [0.5, -0.25, 0.125, 0.0, 1.0, 0.75]) for i in range(60)]
    rows += [(40, rows[40][1])]  # a repeated row
    rows += [
        (300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (303, [float("nan")] * 6), (304, [float("inf")] * 6), (305, [0.0] * 6),
        (None, [1.0] * 6),
    ]
    return rows


def usable(rows, zeros):
    return {
        i: v for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
        and (zeros or any(v))
    }


def by_query(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    return {q: [(v, s) for _, v, s in sorted(r)] for q, r in found.items()}


@pytest.mark.parametrize("block", [8192, 16])
def test_exact_search_equals_brute_force(spark, block):
    rows = odd_rows()
    found = by_query(topk.exact_top_k(
        vectors(spark, rows), F.col("vec_id") % 10 == 0, k=7, row_block=block, query_block=4
    ))
    whole = {
        i: np.floor(1024 * np.array(np.float32(v), dtype=np.float64)).astype(int)
        for i, v in usable(rows, zeros=True).items()
    }
    expected = {
        q: sorted(((i, int(v @ whole[q])) for i, v in whole.items() if i != q),
                  key=lambda x: (-x[1], x[0]))[:7]
        for q in whole if q % 10 == 0
    }
    assert found == expected


def test_bounds_cut_most_rows_without_losing_any():
    random = np.random.default_rng(2)
    rows = random.integers(-50, 50, (2000, 64))
    rows[:20] *= 40
    vertical = np.ascontiguousarray(rows.T).astype(float)
    masses = np.add.reduceat(np.square(vertical), np.arange(0, 64, 8), axis=0)
    query = rows[3].astype(float)
    ids = np.arange(2000)
    best, scores = topk.best_in_block(vertical, ids, query, 3, 5, masses)
    every = rows @ rows[3]
    order = [i for i in np.lexsort((ids, -every)) if i != 3][:5]
    assert best.tolist() == order and scores.tolist() == every[order].tolist()


def test_searches_of_empty_tables_and_without_queries(spark):
    empty, one = vectors(spark, []), vectors(spark, [(1, [1.0, 2.0])])
    for search in (topk.exact_top_k, ann.search_neighbours):
        assert search(empty, F.col("vec_id") % 10 == 0).collect() == []
        assert search(one, F.col("vec_id") % 10 == 0).collect() == []
        assert search(one, F.col("vec_id") == 1).collect() == []


@pytest.mark.parametrize("block", [8192, 16])
def test_index_with_full_recall_equals_brute_force(spark, block):
    rows = odd_rows()
    found = by_query(ann.search_neighbours(
        vectors(spark, rows), F.col("vec_id") % 10 == 0, k=7, target_recall=1.0,
        row_block=block, query_block=4,
    ))
    whole = {
        i: np.array(np.float32(v), dtype=np.float64) for i, v in usable(rows, zeros=False).items()
    }
    hits = total = 0
    for q in (i for i in whole if i % 10 == 0):
        expected = sorted(
            ((i, float(np.add.accumulate(v * whole[q])[-1])) for i, v in whole.items() if i != q),
            key=lambda x: (-x[1], x[0]),
        )[:7]
        assert len(found[q]) == 7
        assert all(s == dict(
            (i, float(np.add.accumulate(v * whole[q])[-1])) for i, v in whole.items()
        )[v_id] for v_id, s in found[q])
        hits += len(set(found[q]) & set(expected))
        total += 7
    assert hits / total > 0.97


def test_recall_on_the_given_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = by_query(ann.search_neighbours(table, F.col("vec_id") % 20 == 0, k=20))
    rows = table.collect()
    ids = np.array([r["vec_id"] for r in rows])
    matrix = np.array([r["embedding"] for r in rows], dtype=float)
    hits = 0
    for q, results in found.items():
        scores = matrix @ matrix[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len({v for v, _ in results} & set(ids[np.argsort(-scores)[:20]].tolist()))
    assert hits / (20 * len(found)) >= 0.9


def test_heap_pops_cells_best_first():
    random = np.random.default_rng(3)
    books = ann.Codebooks(random.normal(size=(6, 3)), random.normal(size=(5, 2)))
    query = random.normal(size=5)
    counts = random.integers(0, 3, books.cells)
    popped = [cell for cell, _ in ann.traverse(books, counts, query)]
    value = (books.first @ query[:3])[:, None] + (books.second @ query[3:])[None, :]
    values = value.ravel()[popped]
    assert sorted(popped) == np.flatnonzero(counts).tolist()
    assert (np.diff(values) <= 1e-12).all()
