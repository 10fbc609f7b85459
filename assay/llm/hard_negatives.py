"""Hard negatives by exact inner product, with pruned coordinate lists.

Rows are dealt into buckets of nearly equal length: a class on a geometric grid of lengths, and a
class of many rows is split by hash. Inside a bucket every coordinate has its list of rows, sorted
by value. For a query that asks for scores from a threshold on, a bucket is left out when the
product of the lengths does not reach it. Otherwise the largest coordinates of the query are its
focus. The rest of the query and of a row of length l add at most |query rest| * sqrt(l^2 - x^2) to
the product at coordinate x, so only values x in a certain range can reach the threshold. The
ranges are read off the sorted lists, the row sets of all focus coordinates are intersected, and
what is left is verified by its exact integer score. Thresholds start at the scores found in the
bucket of the longest rows and rise with every query's results in a bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import block_numbers, blocks_for, finite, stored

ROWS_A_BUCKET = 8192
QUERIES_A_BLOCK = 2048
CLASSES_A_DOUBLING = 32
FOCUS = 4
EXACT_FLOAT = 2.0 ** 53
LOWEST, HIGHEST = -(2 ** 63), 2 ** 63 - 1

FOUND_COLUMNS = ("anchor_id", "anchor_key", "slot", "vec_id", "score")
FOUND = ", ".join(f"{name} long" for name in FOUND_COLUMNS)


@dataclass
class Wanted:
    """One list of results: at most ``k`` rows with scores from ``low`` to ``high``, the best
    first, of the anchor's label (``same``) or of others."""

    slot: int
    same: bool
    low: int
    high: int


class Bucket:
    """Rows of nearly equal length with a sorted list for every coordinate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        self.ids, self.labels, self.values = ids, labels, values
        floats = values.astype(np.float64)
        self.longest_square = float(np.square(floats).sum(axis=1).max())
        self.order = np.argsort(floats, axis=0)
        self.sorted = np.ascontiguousarray(np.take_along_axis(floats, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)
        self.columns = np.ascontiguousarray(floats.T)

    def candidates(self, query: np.ndarray, threshold: int) -> np.ndarray:
        """Rows that can reach the threshold, by the ranges of the focus coordinates."""
        every = np.arange(len(self.ids))
        floats = query.astype(np.float64)
        square, limit = float(floats @ floats), self.longest_square
        # A unit of slack and a relative one cover the rounding of the bounds; scores are whole.
        theta = float(threshold) - 1.0 - abs(float(threshold)) * 1e-9
        if theta <= -np.sqrt(square * limit):
            return every
        if theta > np.sqrt(square * limit):
            return every[:0]
        low, high = feasible(floats, square, limit, theta)
        focus = np.argsort(-np.abs(floats), kind="stable")[:FOCUS]
        places = [
            (np.searchsorted(self.sorted[f], low[f]), np.searchsorted(self.sorted[f], high[f], "right"))
            for f in focus
        ]
        widths = [last - first for first, last in places]
        least = int(np.argmin(widths))
        rows = self.order[focus[least], slice(*places[least])]
        for place, f in enumerate(focus):
            if place != least and widths[place] < len(every):
                value = self.columns[f, rows]
                rows = rows[(value >= low[f]) & (value <= high[f])]
        return rows


def feasible(
    query: np.ndarray, square: float, limit: float, theta: float
) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of every coordinate that a vector of squared length up to ``limit``
    can have if its product with the query is at least ``theta``.

    The vectors x with query . x >= theta and x . x <= limit form a cap of a ball. Along
    coordinate f the cap reaches to query_f * theta / square plus or minus
    sqrt((1 - query_f^2 / square) * (limit - theta^2 / square)), and to the ball's own pole where
    that lies inside the cap.
    """
    centre = query * (theta / square)
    spread = np.sqrt(np.maximum((1 - query * query / square) * (limit - theta * theta / square), 0))
    pole, slack = np.sqrt(limit), 1e-9 * np.sqrt(limit) + 1e-6
    low = np.where(-query * pole >= theta, -pole, centre - spread)
    high = np.where(query * pole >= theta, pole, centre + spread)
    return low - slack, high + slack


def search_bucket(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best rows of one bucket for every list that every anchor wants."""
    found: list[list[np.ndarray | int]] = []
    if len(queries) and len(rows):
        values, anchors = np.stack(rows["values"].to_numpy()), np.stack(queries["values"].to_numpy())
        reach = float(np.abs(values).max()) * float(np.abs(anchors).max()) * values.shape[1]
        kind = np.float64 if reach < EXACT_FLOAT else np.int64
        bucket = Bucket(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), values.astype(kind))
        for anchor, query in zip(queries.itertuples(), anchors.astype(kind), strict=True):
            lists = [Wanted(*each) for each in zip(
                anchor.slots, anchor.same, anchor.lows, anchor.highs, strict=True
            )]
            near = bucket.candidates(query, min(each.low for each in lists))
            near = near[bucket.ids[near] != anchor.anchor_id]
            scores = (bucket.values[near] @ query).astype(np.int64)
            ids, alike = bucket.ids[near], bucket.labels[near] == anchor.label
            for each in lists:
                chosen = np.flatnonzero(
                    (alike == each.same) & (scores >= each.low) & (scores <= each.high)
                )
                if len(chosen) > 4 * k:
                    least = np.partition(scores[chosen], len(chosen) - k)[len(chosen) - k]
                    chosen = chosen[scores[chosen] >= least]
                chosen = chosen[np.lexsort((ids[chosen], -scores[chosen]))[:k]]
                found.append([anchor.anchor_id, anchor.anchor_key, each.slot,
                              ids[chosen], scores[chosen]])
    sizes = [len(part[3]) for part in found]
    return pd.DataFrame({
        **{name: np.repeat(np.array([part[i] for part in found], np.int64), sizes)
           for i, name in enumerate(FOUND_COLUMNS[:3])},
        **{name: np.concatenate([np.empty(0, np.int64), *[part[i] for part in found]])
           for i, name in ((3, "vec_id"), (4, "score"))},
    })


class Buckets:
    """Usable rows, written once with their bucket."""

    def __init__(self, rows: DataFrame, rows_a_bucket: int):
        square = F.aggregate(
            "values", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
        )
        classed = stored(rows.withColumns({
            "dim": F.size("values"),
            "length_class": F.floor(F.log2(square + 1) * CLASSES_A_DOUBLING / 2).cast("int"),
        }), "negatives-rows")
        # Squares range over at most 2,048 doublings, so a dimension has a bounded number of
        # classes; their sizes are all that is broadcast.
        sizes = classed.groupBy("dim", "length_class").agg(F.count(F.lit(1)).alias("size"))
        last = Window.partitionBy("dim").orderBy(F.desc("length_class"))
        self.classes = stored(sizes.select(
            "dim", "length_class", F.ceil(F.col("size") / rows_a_bucket).alias("parts"),
            (F.row_number().over(last) == 1).alias("is_longest"),
        ), "negatives-classes")
        self.rows = placed(classed.join(F.broadcast(self.classes), ["dim", "length_class"]).withColumn(
            "part", F.pmod(F.xxhash64("vec_id", "label", "values"), F.col("parts"))
        ))

    def search(self, queries: DataFrame, k: int, query_blocks: int, first: bool) -> DataFrame:
        """Results of the queries in the first part of the longest class, or in all the others."""
        block = F.pmod(F.xxhash64("anchor_id", "anchor_key"), F.lit(query_blocks)).cast("long")
        asked = placed(queries.join(F.broadcast(self.classes), "dim").withColumns({
            "query_block": block,
            "part": F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)),
        }))
        dealt = self.rows.withColumn("query_block", F.explode(block_numbers(query_blocks)))
        chosen = F.col("is_first") == first
        tile = ("dim", "length_class", "part", "query_block")
        return asked.where(chosen).groupBy(*tile).cogroup(
            dealt.where(chosen).groupBy(*tile)
        ).applyInPandas(lambda anchors, rows: search_bucket(anchors, rows, k), FOUND)


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their part, marked where that is the first of the longest class."""
    return rows.withColumn("is_first", F.col("is_longest") & (F.col("part") == 0)).drop(
        "is_longest", "parts"
    )


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "anchor_key", "slot").orderBy(
        F.desc("score"), F.asc("vec_id")
    )
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def asking(anchors: DataFrame, lists: DataFrame) -> DataFrame:
    """Anchors with all the lists they want as arrays."""
    wanted = lists.groupBy("anchor_id", "anchor_key").agg(
        F.sort_array(F.collect_list(F.struct("slot", "same", "low", "high"))).alias("wanted")
    )
    return anchors.join(wanted, ["anchor_id", "anchor_key"]).select(
        "anchor_id", "anchor_key", "label", "values", "dim",
        F.col("wanted.slot").alias("slots"), F.col("wanted.same").alias("same"),
        F.col("wanted.low").alias("lows"), F.col("wanted.high").alias("highs"),
    )


def search(
    buckets: Buckets, anchors: DataFrame, lists: DataFrame, k: int, query_blocks: int, name: str
) -> DataFrame:
    """The ``k`` best of every list, by way of the thresholds found among the longest rows."""
    start = stored(
        best(buckets.search(asking(anchors, lists), k, query_blocks, first=True), k), f"{name}-start"
    )
    reached = start.where(F.col("place") == k).select(
        "anchor_id", "anchor_key", "slot", F.col("score").alias("reached")
    )
    raised = lists.join(reached, ["anchor_id", "anchor_key", "slot"], "left").withColumn(
        "low", F.greatest("low", "reached")
    ).drop("reached")
    rest = buckets.search(asking(anchors, raised), k, query_blocks, first=False)
    return stored(best(start.drop("place").unionByName(rest), k), name)


def floor_of_percent(number: str, percent: int) -> str:
    """SQL for the largest whole number up to so many percent of a whole number."""
    product = f"({number}) * {percent}L"
    return f"({product} - pmod({product}, 100L)) div 100L"


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    scale: int = 256,
    low_percent: int = 30,
    high_percent: int = 90,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    rows_a_bucket: int = ROWS_A_BUCKET,
    queries_a_block: int = QUERIES_A_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(scale * x) and a score is the integer inner product. An anchor's
    positives are its ``positives`` best other rows of the same label. For each, the ``negatives``
    best rows of another label are returned whose score lies between ``low_percent`` and
    ``high_percent`` of the positive's. Ties go to the smaller id.

    Rows with a NULL id or label, and vectors that are NULL, empty or hold a NULL or non-finite
    component take no part. Rows equal in id, label and vector count once; a row never finds a row
    of its own id. An anchor meets rows of its own dimension only. Scores must fit 64 bits. A
    positive without such negatives, and an anchor without positives, gives no row; no rows or no
    anchors: no result. Other columns are not read.
    """
    fixed = F.transform(
        F.col(vector_column), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")
    )
    usable = vectors.where(
        F.col(id_column).isNotNull() & label.isNotNull() & finite(F.col(vector_column))
    ).select(
        F.col(id_column).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        fixed.alias("values"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    ).distinct()
    buckets = Buckets(usable, rows_a_bucket)
    anchors = stored(buckets.rows.where("asked").select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "values").alias("anchor_key"),
        "label", "values", "dim",
    ), "negatives-anchors")
    query_blocks = blocks_for(anchors.count(), queries_a_block)

    def wanting(rows: DataFrame, slot: Column, same: bool, low: Column, high: Column) -> DataFrame:
        return rows.select(
            "anchor_id", "anchor_key", slot.cast("long").alias("slot"), F.lit(same).alias("same"),
            low.cast("long").alias("low"), high.cast("long").alias("high"),
        )

    every = wanting(anchors, F.lit(0), True, F.lit(LOWEST), F.lit(HIGHEST))
    near = search(buckets, anchors, every, positives, query_blocks, "negatives-positives")
    low = F.expr(f"-({floor_of_percent('-score', low_percent)})")
    high = F.expr(floor_of_percent("score", high_percent))
    lists = wanting(near, F.col("place"), False, low, high).where("low <= high")
    far = search(buckets, anchors, lists, negatives, query_blocks, "negatives-found")
    return far.withColumnRenamed("place", "rank").withColumnsRenamed(
        {"vec_id": "negative_id", "score": "negative_score"}
    ).join(
        near.select(
            "anchor_id", "anchor_key", F.col("place").cast("long").alias("slot"),
            F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        ),
        ["anchor_id", "anchor_key", "slot"],
    ).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
