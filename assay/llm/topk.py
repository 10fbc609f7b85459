"""Exact top-k search by inner product: columnar branch and bound.

Rows are dealt into blocks and queries into blocks; a tile pairs one of each. Inside a tile the
rows lie dimension by dimension. A query adds up one block of dimensions after the other, the
blocks in which it has most mass first. What the unread dimensions can still add lies between
plus and minus the root of (remaining mass of the query * remaining mass of the row), so rows
whose upper bound is below the k-th largest lower bound are compacted away. What is left at the
end has exact scores.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import block_numbers, blocks_for, finite, stored

ROW_BLOCK = 8192
QUERY_BLOCK = 512
DIMENSIONS_A_STEP = 8
EXACT_FLOAT = 2.0 ** 53


def fixed_point(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def best_in_block(
    rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int, masses: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best of ``rows`` (dimension by row), own id left out.

    ``masses`` holds the squared length of every row in every block of dimensions.
    """
    starts = range(0, len(query), DIMENSIONS_A_STEP)
    spans = [slice(s, min(s + DIMENSIONS_A_STEP, len(query))) for s in starts]
    weight = np.array([float(np.square(query[s].astype(np.float64)).sum()) for s in spans])
    alive = np.flatnonzero(ids != own)
    score = np.zeros(len(alive), rows.dtype)
    rest = masses.sum(axis=0)[alive]
    rest_query = weight.sum()
    for step in np.argsort(-weight, kind="stable"):
        score = score + query[spans[step]] @ rows[spans[step]][:, alive]
        rest = np.maximum(rest - masses[step][alive], 0.0)
        rest_query = max(rest_query - weight[step], 0.0)
        if len(alive) > k:
            # One whole unit of slack covers the rounding of the bounds; scores are integers.
            reach = np.sqrt(rest * rest_query) * (1 + 1e-9) + 1.0
            floor = np.partition(score - reach, len(alive) - k)[len(alive) - k]
            kept = score + reach >= floor
            if not kept.all():
                alive, score, rest = alive[kept], score[kept], rest[kept]
    order = np.lexsort((ids[alive], -score))[:k]
    return ids[alive][order], score[order]


def search_tile(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(queries) and len(rows):
        matrix = np.stack(rows["values"].to_numpy())
        asked = np.stack(queries["values"].to_numpy())
        largest = float(np.abs(matrix).max()) * float(np.abs(asked).max()) * matrix.shape[1]
        kind = np.float64 if largest < EXACT_FLOAT else np.int64
        vertical = np.ascontiguousarray(matrix.T).astype(kind)
        asked = asked.astype(kind)
        ids = rows["vec_id"].to_numpy()
        squares = np.square(vertical.astype(np.float64))
        masses = np.add.reduceat(squares, np.arange(0, matrix.shape[1], DIMENSIONS_A_STEP), axis=0)
        for name, copy, query in zip(queries["query_id"], queries["query_key"], asked, strict=True):
            best, scores = best_in_block(vertical, ids, query, name, k, masses)
            found.append(pd.DataFrame({
                "query_id": name, "query_key": copy, "vec_id": best,
                "score": scores.astype(np.int64),
            }))
    empty = pd.DataFrame({n: np.empty(0, np.int64) for n in TILE_COLUMNS})
    return pd.concat(found, ignore_index=True) if found else empty


TILE_COLUMNS = ("query_id", "query_key", "vec_id", "score")
TILE_SCHEMA = ", ".join(f"{name} long" for name in TILE_COLUMNS)


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    row_block: int = ROW_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best rows by integer inner product.

    Components become floor(scale * x). Rows whose id is NULL and vectors that are NULL, empty or
    hold a NULL or non-finite component take no part. Rows equal in id and vector count once; a
    row never finds a row of its own id. A query meets rows of its own dimension only. Ties go to
    the smaller id. No rows or no queries: no result. Other columns are not read.
    """
    usable = vectors.where(F.col(id_column).isNotNull() & finite(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        fixed_point(F.col(vector_column), scale).alias("values"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    rows = stored(usable.distinct(), "topk-rows")
    size = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asked").alias("asked")
    ).first()
    row_blocks = blocks_for(size["rows"], row_block)
    query_blocks = blocks_for(size["asked"], query_block)
    dealt = rows.select(
        "vec_id", "values", F.size("values").alias("dim"),
        F.pmod(F.xxhash64("vec_id", "values"), F.lit(row_blocks)).cast("long").alias("row_block"),
        F.explode(block_numbers(query_blocks)).alias("query_block"),
    )
    queries = rows.where("asked").select(
        F.col("vec_id").alias("query_id"), F.xxhash64("values").alias("query_key"), "values",
        F.size("values").alias("dim"),
        F.explode(block_numbers(row_blocks)).alias("row_block"),
        F.pmod(F.xxhash64("vec_id", "values"), F.lit(query_blocks)).cast("long").alias("query_block"),
    )
    tile = ("dim", "row_block", "query_block")
    found = queries.groupBy(*tile).cogroup(dealt.groupBy(*tile)).applyInPandas(
        lambda asked, block: search_tile(asked, block, k), TILE_SCHEMA
    )
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
