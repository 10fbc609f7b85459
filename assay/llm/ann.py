"""Approximate nearest neighbours: an inverted multi-index over two vector halves.

Each half has its own codebook; a cell is a pair of centroids. The inner product of a query with
a pair is the sum of two numbers, so a heap pops the pairs best first, until the popped cells
hold enough rows. Only rows in popped cells are scored, on the original vectors. How many rows
are enough is measured: a few queries are answered exactly, and the smallest number that would
have reached the target recall is taken.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import block_numbers, blocks_for, finite, stored, tasks_for

FIT_ROWS = 20_000
TUNING_QUERIES = 96
TARGET_RECALL = 0.96
ROW_BLOCK = 8192
QUERY_BLOCK = 1024
QUERIES_A_TASK = 1024
MOST_CENTROIDS = 256


@dataclass(frozen=True)
class Codebooks:
    """Centroids of the two halves; a cell's number is ``first * len(second) + second``."""

    first: np.ndarray
    second: np.ndarray

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def halves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return vectors[:, :cut], vectors[:, cut:]

    def cell_of(self, vectors: np.ndarray) -> np.ndarray:
        left, right = self.halves(vectors)
        return nearest(left, self.first) * len(self.second) + nearest(right, self.second)


def nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    apart = np.square(centroids).sum(axis=1) - 2.0 * points @ centroids.T
    return np.argmin(apart, axis=1)


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's rounds from distinct starting rows; a centroid that loses its rows stays."""
    distinct = np.unique(points, axis=0)
    start = np.random.default_rng(seed).permutation(len(distinct))[:k]
    centroids = distinct[start]
    for _ in range(rounds):
        home = nearest(points, centroids)
        counts = np.bincount(home, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, points)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return centroids


def centroids_for(rows: int) -> int:
    """Power of two near twice the fourth root, so a cell holds about root(rows) / 4 rows."""
    return int(min(MOST_CENTROIDS, 2 ** max(1, round(np.log2(2.0 * max(rows, 1) ** 0.25)))))


def fit(vectors: DataFrame, rows: int, fit_rows: int = FIT_ROWS) -> Codebooks:
    """Codebooks from the ``fit_rows`` vectors with the smallest hashes."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).select("values")
    points = np.array([row["values"] for row in sample.collect()], dtype=np.float64)
    cut = max(1, points.shape[1] // 2)
    k = centroids_for(rows)
    right = points[:, cut:] if points.shape[1] > 1 else np.zeros((len(points), 0))
    return Codebooks(k_means(points[:, :cut], k), k_means(right, k))


def traverse(books: Codebooks, counts: np.ndarray, query: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cells that hold rows, best pair sum first, each with the rows popped up to its end."""
    left, right = books.halves(query[None, :])
    first, second = (left @ books.first.T)[0], (right @ books.second.T)[0]
    by_first, by_second = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    first, second = first[by_first].tolist(), second[by_second].tolist()
    heap = [(-(first[0] + second[0]), 0, 0)]
    held = 0
    while heap:
        _, i, j = heapq.heappop(heap)
        cell = int(by_first[i]) * len(second) + int(by_second[j])
        if counts[cell]:
            held += int(counts[cell])
            yield cell, held
        if j + 1 < len(second):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))


def in_order(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products added up from the first component to the last, in double precision, so
    equal vectors get equal scores wherever they lie."""
    return np.add.accumulate(queries * rows, axis=1)[:, -1]


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def exact_neighbours(rows: DataFrame, queries: list, k: int) -> DataFrame:
    """Best ``k`` of all rows for a few queries: one pass, the queries travel with the code."""
    names = np.array([q["vec_id"] for q in queries], dtype=np.int64)
    asked = np.array([q["values"] for q in queries], dtype=np.float64)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            ids, cells = batch["vec_id"].to_numpy(), batch["cell"].to_numpy()
            scores = asked @ stacked(batch["values"]).T
            for i, name in enumerate(names):
                scores[i, ids == name] = -np.inf
                best = top(ids, scores[i], k)
                best = best[np.isfinite(scores[i, best])]
                yield pd.DataFrame({
                    "query_id": name, "cell": cells[best], "score": scores[i, best],
                    "vec_id": ids[best],
                })

    found = rows.mapInPandas(scan, "query_id long, cell long, score double, vec_id long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def rows_to_reach(
    rows: DataFrame, queries: list, books: Codebooks, counts: np.ndarray, k: int, recall: float
) -> int:
    """Smallest number of rows to pop that finds ``recall`` of the exact neighbours."""
    wanted: dict[int, list[int]] = {}
    for row in exact_neighbours(rows, queries, k).collect():
        wanted.setdefault(row["query_id"], []).append(row["cell"])
    needed: list[int] = []
    for query in queries:
        reached = dict(traverse(books, counts, np.array(query["values"], dtype=np.float64)))
        needed += [reached[cell] for cell in wanted.get(query["vec_id"], [])]
    if not needed:
        return int(counts.sum())
    return int(sorted(needed)[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def block_plan(counts: np.ndarray, row_block: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First block and number of blocks of every cell. Neighbouring cells share a block until it
    is full; a cell larger than a block has blocks of its own."""
    first, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    block, filled = 0, 0
    for cell in np.flatnonzero(counts):
        if filled and filled + counts[cell] > row_block:
            block, filled = block + 1, 0
        first[cell], parts[cell] = block, blocks_for(int(counts[cell]), row_block)
        filled += int(counts[cell])
        if parts[cell] > 1:
            block, filled = block + int(parts[cell]), 0
    return first, parts, block + (1 if filled else 0)


def search_tile(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(rows):
            asked, matrix = stacked(queries["values"]), stacked(rows["values"])
            ids, cells = rows["vec_id"].to_numpy(), rows["cell"].to_numpy()
            visitors: dict[int, list[int]] = {}
            for i, popped in enumerate(queries["cells"]):
                for cell in popped:
                    visitors.setdefault(int(cell), []).append(i)
            scores = np.full((len(asked), len(matrix)), -np.inf)
            for cell, who in visitors.items():
                members = np.flatnonzero(cells == cell)
                if len(members):
                    scores[np.ix_(who, members)] = asked[who] @ matrix[members].T
            # Twice as many as wanted, so that rounding cannot part the copies of a vector.
            take = min(2 * k, len(matrix))
            for i, name in enumerate(queries["query_id"]):
                some = np.argpartition(-scores[i], take - 1)[:take]
                some = some[np.isfinite(scores[i, some])]
                exact = in_order(asked[i][None, :], matrix[some])
                best = top(ids[some], exact, k)
                found.append(pd.DataFrame({
                    "query_id": name, "vec_id": ids[some][best], "score": exact[best],
                }))
        empty = pd.DataFrame({
            "query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64),
            "score": np.empty(0, np.float64),
        })
        return pd.concat(found, ignore_index=True) if found else empty

    return search


def usable_vectors(vectors: DataFrame, is_query: Column, id_column: str, vector_column: str) -> DataFrame:
    vector = F.col(vector_column)
    return vectors.where(
        F.col(id_column).isNotNull() & finite(vector) & F.exists(vector, lambda x: x != 0)
    ).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: x.cast("double")).alias("values"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).distinct()


def search_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    target_recall: float = TARGET_RECALL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest rows found, best first.

    Every row is indexed; the codebooks are fitted on ``FIT_ROWS`` rows and the number of rows to
    pop is tuned on ``TUNING_QUERIES`` queries. Vectors that are NULL, empty, all zero or hold a
    NULL or non-finite component take no part, nor do rows without id. Rows equal in id and vector
    count once, and a row never finds a row of its own id. Of equal vectors only the ``k + 1``
    smallest ids are searched, since no other can be among ``k``. All vectors must have one
    dimension. Ties go to the smaller id; fewer rows than ``k`` give fewer results. Other columns
    are not read.
    """
    spark = vectors.sparkSession
    usable = stored(usable_vectors(vectors, is_query, id_column, vector_column), "ann-vectors")
    copies = Window.partitionBy("values").orderBy("vec_id")
    rows = usable.select("vec_id", "values").distinct().withColumn(
        "copy", F.row_number().over(copies)
    ).where(F.col("copy") <= k + 1).drop("copy")
    size = usable.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asked").alias("asked"),
        F.min(F.size("values")).alias("low"), F.max(F.size("values")).alias("high"),
    ).first()
    if not size["asked"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if size["low"] != size["high"]:
        raise ValueError(f"vectors have from {size['low']} to {size['high']} components")
    books = fit(usable, size["rows"])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=books.cell_of(stacked(batch["values"])))

    indexed = stored(
        rows.mapInPandas(assign, "vec_id long, values array<double>, cell long"), "ann-index"
    )
    counts = np.zeros(books.cells, np.int64)
    for row in indexed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS squared
        counts[row["cell"]] = row["count"]
    asked = usable.where("asked")
    tuning = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TUNING_QUERIES).collect()
    enough = max(rows_to_reach(indexed, tuning, books, counts, k, target_recall), k + 1)
    first, parts, blocks = block_plan(counts, row_block)
    leaders = asked.groupBy("values").agg(F.min("vec_id").alias("leader"))
    query_blocks = blocks_for(size["asked"], query_block)

    def pop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, values in zip(batch["leader"], batch["values"], strict=True):
                by_block: dict[int, list[int]] = {}
                for cell, held in traverse(books, counts, np.array(values, dtype=np.float64)):
                    for part in range(parts[cell]):
                        by_block.setdefault(int(first[cell]) + part, []).append(cell)
                    if held >= enough:
                        break
                yield pd.DataFrame({
                    "query_id": name, "values": [values] * len(by_block),
                    "row_block": list(by_block), "cells": list(by_block.values()),
                })

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = batch["cell"].to_numpy()
            yield batch.assign(row_block=first[cells] + batch["spread"] % parts[cells]).drop(
                columns="spread"
            )

    tasks = tasks_for(spark, size["asked"], QUERIES_A_TASK)
    queries = leaders.repartition(tasks, "leader").mapInPandas(
        pop, "query_id long, values array<double>, row_block long, cells array<long>"
    ).withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("long"))
    placed = indexed.withColumn(
        "spread", F.xxhash64("vec_id").bitwiseAND(F.lit((1 << 40) - 1))
    ).mapInPandas(
        place, "vec_id long, values array<double>, cell long, row_block long"
    ).withColumn("query_block", F.explode(block_numbers(query_blocks)))
    tile = ("row_block", "query_block")
    found = queries.groupBy(*tile).cogroup(placed.groupBy(*tile)).applyInPandas(
        search_tile(k + 1), "query_id long, vec_id long, score double"
    )
    nearest_first = (F.desc("score"), F.asc("vec_id"))
    of_leader = Window.partitionBy("query_id").orderBy(*nearest_first)
    lists = found.withColumn("place", F.row_number().over(of_leader)).where(
        F.col("place") <= k + 1
    ).select(F.col("query_id").alias("leader"), "vec_id", "score")
    names = asked.join(leaders, "values").select(
        F.col("vec_id").alias("query_id"), "leader", F.xxhash64("values").alias("query_key")
    )
    of_query = Window.partitionBy("query_id", "query_key").orderBy(*nearest_first)
    return (
        names.join(lists, "leader")
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(of_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
