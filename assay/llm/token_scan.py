"""Token counts of documents in flat token files that have no index.

A file is a run of unsigned 16-bit ids; an end-of-document id closes each document. Blocks of a
file are searched on their own for that id, and a prefix scan over the blocks' summaries says how
many documents closed before a block and where the last of them ended, which stitches the
documents that cross blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.shared import file_system, stored, tasks_for
from assay.llm.tokens import encoder

END_OF_DOCUMENT = 50_256
BLOCK_TOKENS = 1 << 21
SCAN_BLOCKS = 1024
BLOCKS_A_TASK = 32
ID_BYTES = 2
DOCUMENTS_A_STEP = 512


def write_token_files(
    documents: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_OF_DOCUMENT,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Every partition's documents as one flat file of 16-bit ids, closed by ``end_id`` each.

    Returns the written list ``file, ordinal, doc_id, file_bytes``: a row per document, and one
    with a NULL ordinal per file that carries its size. Files have names of their own per attempt
    and only those of finished attempts are listed, so a lost executor leaves no wrong file behind.
    """
    schema = pa.schema([
        ("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64()),
        ("file_bytes", pa.int64()),
    ])
    end = np.array([end_id], dtype="<u2").tobytes()

    def listed(file: str, names: list, first: int) -> pa.RecordBatch:
        count = len(names)
        return pa.RecordBatch.from_arrays([
            pa.array([file] * count, pa.string()),
            pa.array(np.arange(first, first + count)),
            pa.array(names, pa.int64()),
            pa.array([None] * count, pa.int64()),
        ], schema=schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path, "<u2")
        file = f"{folder}/tokens-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        system, path = file_system(file)
        stream, size, ordinal = None, 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS_A_STEP):
                part = batch.slice(at, DOCUMENTS_A_STEP)
                if stream is None:
                    system.create_dir(path.rpartition("/")[0], recursive=True)
                    stream = system.open_output_stream(path)
                texts = [text or "" for text in part.column(1).to_pylist()]
                data = b"".join(ids + end for ids in words.encode(texts))
                stream.write(data)
                size += len(data)
                yield listed(file, part.column(0).to_pylist(), ordinal)
                ordinal += part.num_rows
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_arrays([
                pa.array([file], pa.string()), pa.array([None], pa.int64()),
                pa.array([None], pa.int64()), pa.array([size], pa.int64()),
            ], schema=schema)

    chosen = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return stored(
        chosen.mapInArrow(write, "file string, ordinal long, doc_id long, file_bytes long"),
        "token-files",
    )


def scan_blocks(files: DataFrame, end_id: int, block_tokens: int) -> DataFrame:
    """A row per block: ``file, block, tokens``, how many separators, tokens up to the first one,
    tokens after the last one, and the lengths of the documents that lie wholly inside."""
    block_bytes = block_tokens * ID_BYTES

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, size, block in zip(
                batch["file"], batch["file_bytes"], batch["block"], strict=True
            ):
                system, path = file_system(file)
                with system.open_input_file(path) as stream:
                    start = block * block_bytes
                    held = stream.read_at(min(block_bytes, size - start), start)
                at = np.flatnonzero(np.frombuffer(held, dtype="<u2") == end_id)
                tokens = len(held) // ID_BYTES
                yield pd.DataFrame({
                    "file": [file], "block": [block], "tokens": [tokens],
                    "separators": [len(at)],
                    "head": [int(at[0]) if len(at) else tokens],
                    "tail": [tokens - int(at[-1]) - 1 if len(at) else tokens],
                    "inner": [np.diff(at) - 1],
                })

    blocks = files.where("file_bytes > 0").select(
        "file", "file_bytes",
        F.explode(F.sequence(
            F.lit(0).cast("long"),
            F.floor((F.col("file_bytes") - 1) / F.lit(block_bytes)).cast("long"),
        )).alias("block"),
    )
    tasks = tasks_for(files.sparkSession, blocks.count(), BLOCKS_A_TASK)
    return blocks.repartition(tasks, F.xxhash64("file", "block")).mapInPandas(
        scan,
        "file string, block long, tokens long, separators long, head long, tail long, "
        "inner array<long>",
    )


def stitched(blocks: DataFrame, block_tokens: int, scan_width: int) -> DataFrame:
    """Adds to each block how many documents ``closed`` before it and where the last one
    ``ended``: a prefix scan in two steps, inside runs of ``scan_width`` blocks and over the runs,
    so that no task orders all blocks of a huge file."""
    at = F.col("block") * F.lit(block_tokens)
    marked = blocks.withColumn("run", F.floor(F.col("block") / F.lit(scan_width))).withColumn(
        "last_end",
        F.when(F.col("separators") > 0, at + F.col("tokens") - F.col("tail")).otherwise(F.lit(0)),
    )
    earlier_runs = Window.partitionBy("file").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1
    )
    runs = marked.groupBy("file", "run").agg(
        F.sum("separators").alias("run_separators"), F.max("last_end").alias("run_end")
    ).select(
        "file", "run",
        F.coalesce(F.sum("run_separators").over(earlier_runs), F.lit(0)).alias("closed_runs"),
        F.coalesce(F.max("run_end").over(earlier_runs), F.lit(0)).alias("ended_runs"),
    )
    earlier = Window.partitionBy("file", "run").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        marked.withColumn("closed_here", F.coalesce(F.sum("separators").over(earlier), F.lit(0)))
        .withColumn("ended_here", F.coalesce(F.max("last_end").over(earlier), F.lit(0)))
        .join(runs, ["file", "run"])
        .withColumn("closed", F.col("closed_here") + F.col("closed_runs"))
        .withColumn("ended", F.greatest("ended_here", "ended_runs"))
    )


def count_tokens(
    files: DataFrame, end_id: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS,
    scan_width: int = SCAN_BLOCKS,
) -> DataFrame:
    """``file, ordinal, start, tokens``: every document of the files, by its place.

    ``files`` holds ``file, file_bytes``. ``tokens`` leaves the separator out, so an empty document
    has 0. Ids after the last separator are one more document; an empty file has none. Repeated
    documents are counted each; a file listed twice is read once. Other columns of ``files``
    are not read.
    """
    blocks = stored(
        scan_blocks(files.select("file", "file_bytes").distinct(), end_id, block_tokens), "token-blocks"
    )
    known = stitched(blocks, block_tokens, scan_width)
    at = F.col("block") * F.lit(block_tokens)
    closing = known.where("separators > 0").select(
        "file", "closed", "ended",
        F.concat(F.array(at + F.col("head") - F.col("ended")), F.col("inner")).alias("lengths"),
    )
    documents = closing.select(
        "file", "closed", "ended", F.posexplode("lengths").alias("place", "tokens")
    )
    in_block = Window.partitionBy("file", "closed").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = documents.select(
        "file", (F.col("closed") + F.col("place")).alias("ordinal"),
        (
            F.col("ended") + F.coalesce(F.sum("tokens").over(in_block), F.lit(0)) + F.col("place")
        ).alias("start"),
        "tokens",
    )
    ends = known.groupBy("file").agg(
        F.sum("separators").alias("ordinal"), F.max("last_end").alias("start"),
        F.sum("tokens").alias("all_tokens"),
    ).where(F.col("all_tokens") > F.col("start")).select(
        "file", "ordinal", "start", (F.col("all_tokens") - F.col("start")).alias("tokens")
    )
    return placed.unionByName(ends)
