"""Packing token sequences by non-negative least squares.

Documents are cut at multiples of the window; every piece falls into a bin of lengths. Shallow
combinations of at most three bins that fill a window are enumerated, how often each is used is
the non-negative least-squares solution against the histogram of bins, rounded, and what is left
over is packed greedily, longest first. The plan depends on the histogram alone, so it is made
once on the driver; the pieces are ranked within their bin and look their place up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import blocks_for, stored
from assay.llm.tokens import encoder

WINDOW = 2048
QUANTUM = 8
END_ID = 1
RANK_BUCKETS = 256
PIECES_A_BUCKET = 1 << 20
DOCUMENTS_A_STEP = 512

PIECE_FIELDS = [
    pa.field("doc_id", pa.int64()), pa.field("start", pa.int64()), pa.field("length", pa.int64()),
    pa.field("ids_crc32", pa.int64()), pa.field("doc_tokens", pa.int64()),
]
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(
    documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, window: int = WINDOW,
    with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Every document as pieces of at most ``window`` ids, its last id being ``end_id``.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens and, with ``with_ids``, the
    ids as little-endian unsigned 32-bit bytes. A NULL text is empty: one piece, the end id.
    """
    fields = PIECE_FIELDS + ([pa.field("ids", pa.binary())] if with_ids else [])
    schema = pa.schema(fields)
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path, "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_A_STEP):
                part = batch.slice(at, DOCUMENTS_A_STEP)
                columns: list[list] = [[] for _ in fields]
                names, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                encoded = words.encode([text or "" for text in texts])
                for name, ids in zip(names, encoded, strict=True):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start: 4 * (start + window)]
                        row = (name, start, len(piece) // 4, zlib.crc32(piece), total, piece)
                        for column, value in zip(columns, row, strict=False):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)],
                    schema=schema,
                )

    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(cut, PIECE_SCHEMA + (", ids binary" if with_ids else ""))


def combinations(full: int) -> np.ndarray:
    """All ways to write ``full`` as a sum of one to three positive numbers, largest first;
    zeros stand for absent numbers."""
    rows = [
        (a, b, full - a - b)
        for a in range(1, full + 1)
        for b in range(min(a, full - a) + 1)
        if 0 <= full - a - b <= b
    ]
    return np.array(rows, dtype=np.int64)


def non_negative_least_squares(
    combos: np.ndarray, histogram: np.ndarray, weight: np.ndarray
) -> np.ndarray:
    """Active-set solution of min ||weight * (counts of the combinations - histogram)||, x >= 0.

    ``histogram`` and ``weight`` start at bin 0, which stands for an absent number.
    """
    bins = len(histogram)
    x = np.zeros(len(combos))
    chosen: list[int] = []

    def columns(which: list[int]) -> np.ndarray:
        table = np.zeros((bins, len(which)))
        for slot in range(combos.shape[1]):
            np.add.at(table, (combos[which, slot], np.arange(len(which))), 1.0)
        table[0] = 0.0
        return table * weight[:, None]

    target = histogram * weight
    target[0] = 0.0
    small = 1e-7 * max(1.0, float(target.max(initial=0.0)))
    for _ in range(4 * bins):
        rest = target - columns(chosen) @ x[chosen] if chosen else target
        pull = (rest * weight)[combos]
        pull[combos == 0] = 0.0
        gain = pull.sum(axis=1)
        gain[chosen] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= small:
            break
        chosen.append(best)
        while chosen:
            table = columns(chosen)
            gram = table.T @ table + 1e-10 * np.eye(len(chosen))
            z = np.linalg.solve(gram, table.T @ target)
            if (z > 0).all():
                x[chosen] = z
                break
            now = x[chosen]
            falling = z <= 0
            step = np.min(now[falling] / np.maximum(now[falling] - z[falling], 1e-300))
            x[chosen] = np.maximum(now + step * (z - now), 0.0)
            gone = [c for c, low in zip(chosen, falling, strict=True) if low and x[c] <= 1e-12]
            if not gone:
                gone = [chosen[int(np.argmin(np.where(falling, x[chosen], np.inf)))]]
            x[gone] = 0.0
            chosen = [c for c in chosen if c not in set(gone)]
    return x


@dataclass(frozen=True)
class Pattern:
    """Bins that share a window, longest first, and how many windows are packed so."""

    bins: tuple[int, ...]
    windows: int


def greedy(left: np.ndarray, full: int) -> list[Pattern]:
    """Longest first, then always the longest bin that still fits; a pattern is repeated until
    one of its bins runs short, so there are about as many patterns as bins."""
    left = left.copy()
    patterns = []
    while left.any():
        taken = np.zeros_like(left)
        bins: list[int] = []
        space = full
        while space:
            fitting = np.flatnonzero(left[: space + 1] > taken[: space + 1])
            if not len(fitting):
                break
            bins.append(int(fitting[-1]))
            taken[bins[-1]] += 1
            space -= bins[-1]
        used = taken > 0
        windows = int((left[used] // taken[used]).min())
        left -= windows * taken
        patterns.append(Pattern(tuple(bins), windows))
    return patterns


def packing_plan(histogram: np.ndarray) -> list[Pattern]:
    """Patterns that use every piece once. ``histogram[b]`` counts the pieces of bin ``b``; the
    last bin fills a window."""
    full = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(full)
    # A long piece left over wastes more of a window than a short one.
    weight = (np.arange(full + 1) + full / 8) / full
    x = non_negative_least_squares(combos, left.astype(float), weight)
    patterns = []
    for i in np.argsort(-x, kind="stable"):
        if x[i] < 0.5:
            break
        bins = combos[i][combos[i] > 0]
        need = np.bincount(bins, minlength=full + 1)
        used = need > 0
        windows = min(int(np.floor(x[i] + 0.5)), int((left[used] // need[used]).min()))
        if windows:
            left -= windows * need
            patterns.append(Pattern(tuple(int(b) for b in bins), windows))
    return patterns + greedy(left, full)


@dataclass(frozen=True)
class Places:
    """Where the pieces of one bin go: from rank ``first[i]`` on to windows from ``window[i]``."""

    first: np.ndarray
    window: np.ndarray
    slot: np.ndarray


def places(patterns: list[Pattern]) -> dict[int, Places]:
    used: dict[int, int] = {}
    found: dict[int, list[tuple[int, int, int]]] = {}
    window = 0
    for pattern in patterns:
        for slot, b in enumerate(pattern.bins):
            found.setdefault(b, []).append((used.get(b, 0), window, slot))
            used[b] = used.get(b, 0) + pattern.windows
        window += pattern.windows
    return {
        b: Places(*(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)))
        for b, rows in found.items()
    }


def pack_pieces(
    pieces: DataFrame, window: int = WINDOW, quantum: int = QUANTUM,
    rank_buckets: int | None = None,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of 1 to ``window`` ids.

    ``pieces`` must be a written table, as it is read three times. Pieces are ranked within their
    bin in two steps, by counts of hashed buckets and then inside a bucket, so that a length which
    very many pieces have is never ordered in one task. There are buckets enough that one holds
    about ``PIECES_A_BUCKET`` pieces if all have one length. Equal rows are interchangeable.
    """
    if rank_buckets is None:
        rank_buckets = max(RANK_BUCKETS, blocks_for(pieces.count(), PIECES_A_BUCKET))
    full = -(-window // quantum)
    keys = ("doc_id", "start", "ids_crc32", "doc_tokens", "length")
    binned = pieces.withColumn(
        "bin", F.ceil(F.col("length") / F.lit(quantum)).cast("int")
    ).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(rank_buckets)).cast("int"))
    counts = stored(binned.groupBy("bin", "bucket").count(), "packing-counts")
    histogram = np.zeros(full + 1, np.int64)
    for row in counts.groupBy("bin").agg(F.sum("count").alias("count")).collect():
        histogram[row["bin"]] = row["count"]
    where = places(packing_plan(histogram))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, slot = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int32)
            bins, ranks = batch["bin"].to_numpy(), batch["rank"].to_numpy()
            for b in np.unique(bins):
                mine, of_bin = bins == b, where[int(b)]
                at = np.searchsorted(of_bin.first, ranks[mine], side="right") - 1
                sequence[mine] = of_bin.window[at] + ranks[mine] - of_bin.first[at]
                slot[mine] = of_bin.slot[at]
            yield batch.drop(columns=["bin", "rank"]).assign(sequence_id=sequence, slot=slot)

    before = Window.partitionBy("bin").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = counts.select(
        "bin", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier")
    )
    inside = Window.partitionBy("bin", "bucket").orderBy(*keys)
    ranked = (
        binned.withColumn("inside", F.row_number().over(inside))
        .join(earlier, ["bin", "bucket"])
        .select(*pieces.columns, "bin", (F.col("earlier") + F.col("inside") - 1).alias("rank"))
    )
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    placed = ranked.mapInPandas(place, f"{kinds}, sequence_id long, slot int")
    ahead = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return placed.withColumn(
        "offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))
    ).drop("slot")


def pack_documents(
    documents: DataFrame, tokenizer_path: str, end_id: int = END_ID, window: int = WINDOW,
    with_ids: bool = False, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """All documents packed into sequences of at most ``window`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens, [ids,] sequence_id, offset.
    NULL and empty texts are the end id alone; long texts are cut into pieces, none is shortened;
    repeated rows and rows without id are packed like any other; an empty table gives no rows.
    Other columns are not read. A sequence shorter than ``window`` is to be padded to it, unless
    its length is a power of two.
    """
    pieces = token_pieces(
        documents, tokenizer_path, end_id, window, with_ids, id_column, text_column
    )
    return pack_pieces(stored(pieces, "packing-pieces"), window)
