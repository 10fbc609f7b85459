"""Alignment of two tokenizers over the same bytes, by skipping along diagonals.

Both tokenizers cut the same bytes, so a text is two ascending arrays of end offsets. Wherever a
token of each ends at the same offset, a group closes. Most groups are one token to one token: in
such a stretch both arrays are equal at the current index shift, and the stretch is jumped over by
comparing runs of 1, 2, 4, ... ends, then halving the last run to the first difference. The group
at the difference is walked token by token, which gives the shift of the next stretch.

How many documents link a pair of ids is counted in two steps. A task lays the documents of a few
megabytes into one block, with the list of the block's pairs, each once, and every document holds
places in that list. Pairs are summed over all blocks, joined back to the blocks' lists, and a
block's documents look their pairs up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.pieces import PieceEncoder, byte_level_tokens
from assay.llm.shared import stored
from assay.llm.tokens import encoder

BLOCK_LINKS = 2_000_000
TEXTS_A_CALL = 256
TOKENS_A_STEP = 1 << 18
END_BYTES = 4

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
LISTED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "places binary, repeats binary, a array<int>, b array<int>, documents array<int>"
)
LISTED_ARROW = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), *[(name, pa.int64()) for name in COUNTS],
    ("groups", pa.string()), ("places", pa.binary()), ("repeats", pa.binary()),
    ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("documents", pa.list_(pa.int32())),
])
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups string"
)


def equal_run(a: bytes, b: bytes, start: int, shift: int, end: int) -> int:
    """How many bytes of ends from ``start`` on are the same in ``b`` at this shift; the first end
    is. Runs are doubled until one differs, and the run that differs is halved."""
    at, size = start + END_BYTES, END_BYTES
    while at < end and a[at: at + size] == b[at + shift: at + shift + size]:
        at += size
        size += size
    if at >= end:
        return end - start
    while size > END_BYTES:
        size >>= 1
        if a[at: at + size] == b[at + shift: at + shift + size]:
            at += size
    return at - start


@dataclass
class Alignment:
    """Links of tokens of A with tokens of B whose bytes overlap, as positions: those of one-to-one
    stretches (first token of A, first of B, length), and those of the other groups one by one."""

    starts_a: list[int]
    starts_b: list[int]
    lengths: list[int]
    irregular_a: list[int]
    irregular_b: list[int]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Every link, in no order."""
        lengths = np.array(self.lengths, np.int64)
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return tuple(
            np.concatenate([np.repeat(np.array(starts, np.int64), lengths) + inside,
                            np.array(irregular, np.int64)])
            for starts, irregular in (
                (self.starts_a, self.irregular_a), (self.starts_b, self.irregular_b)
            )
        )


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Align two ascending arrays of ends with the same last end."""
    a, b = ends_a.astype("<u4").tobytes(), ends_b.astype("<u4").tobytes()
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    found = Alignment([], [], [], [], [])
    start_a, start_b = found.starts_a.append, found.starts_b.append
    length, other_a, other_b = found.lengths.append, found.irregular_a.append, found.irregular_b.append
    i, j, size_a, size_b = 0, 0, len(list_a), len(list_b)
    while i < size_a:
        x, y = list_a[i], list_b[j]
        if x == y:
            end = END_BYTES * (i + min(size_a - i, size_b - j))
            run = equal_run(a, b, END_BYTES * i, END_BYTES * (j - i), end) // END_BYTES
            start_a(i)
            start_b(j)
            length(run)
            i += run
            j += run
            continue
        other_a(i)
        other_b(j)
        while x != y:
            if x < y:
                i += 1
                x = list_a[i]
            else:
                j += 1
                y = list_b[j]
            other_a(i)
            other_b(j)
        i += 1
        j += 1
    return found


class Names:
    """Decimal ids with what follows them: a comma inside a group, a bar after its last A, a
    semicolon after its last B."""

    def __init__(self, size_a: int, size_b: int):
        self.last_a, self.inner_b = size_a, 2 * size_a
        self.last_b = self.inner_b + size_b
        # Shorter names are filled up with zero bytes, which are taken out of the whole.
        self.table = np.array([
            f"{i}{mark}" for size, marks in ((size_a, ",|"), (size_b, ",;")) for mark in marks
            for i in range(size)
        ], dtype=np.bytes_)

    def described(
        self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
    ) -> bytes:
        """The groups as ``a1,a2|b1;a3|b2,b3``, from which tokens are the last of their group."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        before_b = np.concatenate([[0], ends_b[:-1]])
        codes[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + last_a * self.last_a
        codes[np.arange(len(ids_b)) + ends_a[group_b]] = (
            ids_b + np.where(last_b, self.last_b, self.inner_b)
        )
        return self.table[codes].tobytes().translate(None, b"\0")[:-1]


class Spelling:
    """Bytes of a vocabulary's tokens, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(token) for token in tokens])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        if self.lengths[ids].sum() != len(text):
            return False
        done = 0
        for at in range(0, len(ids), TOKENS_A_STEP):
            part = ids[at: at + TOKENS_A_STEP]
            lengths = self.lengths[part]
            ends = np.cumsum(lengths)
            places = np.repeat(self.starts[part] - ends + lengths, lengths) + np.arange(ends[-1])
            if self.bytes[places].tobytes() != text[done: done + ends[-1]]:
                return False
            done += ends[-1]
        return True


class Aligner:
    """Aligns texts in a worker; made once for a pair of vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, "<u4"), PieceEncoder(path_b)
        self.spelling_a = Spelling(byte_level_tokens(path_a))
        self.spelling_b = Spelling(self.b.id_bytes)
        self.radix = len(self.b.id_bytes)
        self.names = Names(len(self.spelling_a.lengths), self.radix)

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """Ids by both; None where the tokens do not spell out the text."""
        blank = [" " + text for text in texts]
        for text, a, b in zip(blank, self.a.encode(blank), self.b.encode(texts), strict=True):
            ids_a, ids_b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
            whole = text.encode()
            spelt = len(whole) > 1 and all(
                spelling.spells(ids, whole)
                for spelling, ids in ((self.spelling_a, ids_a), (self.spelling_b, ids_b))
            )
            yield (ids_a, ids_b) if spelt else None

    def described(
        self, ids_a: np.ndarray, ids_b: np.ndarray
    ) -> tuple[int, int, bytes, np.ndarray, np.ndarray]:
        """Groups, links, the groups' text, the linked pairs of ids, and the links of each."""
        ends_a, ends_b = (
            np.cumsum(spelling.lengths[ids])
            for spelling, ids in ((self.spelling_a, ids_a), (self.spelling_b, ids_b))
        )
        link_a, link_b = align(ends_a, ends_b).links()
        closing = ends_a[link_a] == ends_b[link_b]
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[link_a[closing]] = True
        last_b[link_b[closing]] = True
        text = self.names.described(ids_a, ids_b, last_a, last_b)
        pairs = ids_a[link_a].astype(np.int64) * self.radix + ids_b[link_b]
        return int(closing.sum()), len(pairs), text, *np.unique(pairs, return_counts=True)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


class Block:
    """The documents of a few megabytes of one task."""

    def __init__(self, number: int, radix: int):
        self.number, self.radix = number, radix
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.repeats: list[np.ndarray] = []
        self.links = 0

    def add(self, row: tuple, pairs: np.ndarray, repeats: np.ndarray) -> None:
        self.rows.append(row)
        self.pairs.append(pairs)
        self.repeats.append(repeats)
        self.links += int(repeats.sum())

    def listed(self) -> pa.RecordBatch:
        """A row per document, then one with the block's pairs and in how many rows each is."""
        every = np.concatenate([np.empty(0, np.int64), *self.pairs])
        pairs, places, held = np.unique(every, return_inverse=True, return_counts=True)
        cuts = np.cumsum([len(part) for part in self.pairs])[:-1]
        columns = [list(column) for column in zip(*self.rows, strict=True)]
        last = [None] * 6
        return pa.RecordBatch.from_arrays([
            pa.array([self.number] * (len(self.rows) + 1), pa.int64()),
            *[pa.array([*column, none], field.type)
              for column, none, field in zip(columns, last, list(LISTED_ARROW)[1:7], strict=True)],
            pa.array([*[part.astype("<u4").tobytes() for part in np.split(places, cuts)], None],
                     pa.binary()),
            pa.array([*[part.astype("<u4").tobytes() for part in self.repeats], None], pa.binary()),
            *[pa.array([*[None] * len(self.rows), values.astype(np.int32)], pa.list_(pa.int32()))
              for values in (pairs // self.radix, pairs % self.radix, held)],
        ], schema=LISTED_ARROW)


def align_blocks(
    batches: Iterable[pa.RecordBatch], path_a: str, path_b: str, digest: bool, block_links: int
) -> Iterator[pa.RecordBatch]:
    worker = aligner(path_a, path_b)
    radix, none = worker.radix, np.empty(0, np.int64)
    number = TaskContext.get().partitionId() << 32
    block = Block(number, radix)
    for batch in batches:
        names = batch.column(0).to_pylist()
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for at in range(0, len(texts), TEXTS_A_CALL):
            part = slice(at, at + TEXTS_A_CALL)
            for name, found in zip(names[part], worker.tokens(texts[part]), strict=True):
                if found is None:
                    block.add((name, 0, 0, 0, 0, ""), none, none)
                else:
                    groups, links, text, pairs, repeats = worker.described(*found)
                    text = hashlib.sha256(text).hexdigest() if digest else text.decode()
                    sizes = (len(found[0]), len(found[1]))
                    block.add((name, *sizes, groups, links, text), pairs, repeats)
                if block.links >= block_links:
                    yield block.listed()
                    number += 1
                    block = Block(number, radix)
    if block.rows:
        yield block.listed()


def look_up(documents: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    """Sums over the links of a block's documents."""
    size = int(pairs["place"].max()) + 1 if len(pairs) else 0
    counts, best = np.zeros(size, np.int64), np.zeros(size, bool)
    counts[pairs["place"]] = pairs["count"]
    best[pairs["place"]] = pairs["is_best"]
    n_best, count_sum = [], []
    for places, repeats in zip(documents["places"], documents["repeats"], strict=True):
        where = np.frombuffer(places, "<u4")
        times = np.frombuffer(repeats, "<u4").astype(np.int64)
        n_best.append(int(times[best[where]].sum()))
        count_sum.append(int(times @ counts[where]))
    return documents[["doc_id", *COUNTS]].assign(
        n_best=n_best, count_sum=count_sum, groups=documents["groups"]
    )


def align_tokenizers(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: bool = False,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``, a row per document.

    ``path_a`` is a byte-level vocabulary file, ``path_b`` a SentencePiece model. A text is encoded
    with a blank before it; strings of special tokens are plain text. ``n_links`` counts the pairs
    of tokens whose bytes overlap. A pair of ids counts as many documents (rows) as link it;
    ``count_sum`` adds that over the links, and ``n_best`` counts the links whose count no other
    pair of the same A id exceeds. ``groups`` lists the ids of the groups as
    ``a1,a2|b1;a3|b2,b3``, or with ``digest`` is the SHA-256 of that in lower-case hex.

    A text that is NULL or empty, or that the tokens of A or B do not spell out byte for byte, has
    no tokens: zeros and an empty ``groups``. Every row gives one row, repeated rows and rows with
    a NULL id too. A single text must be under 4 GiB. No rows: no result. Other columns are not
    read.
    """
    texts = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    listed = stored(
        texts.mapInArrow(
            lambda batches: align_blocks(batches, path_a, path_b, digest, block_links), LISTED
        ),
        "alignment",
    )
    pairs = listed.where(F.col("a").isNotNull()).select(
        "block", F.posexplode(F.arrays_zip("a", "b", "documents")).alias("place", "pair")
    ).select("block", "place", "pair.*")
    # An A id has at most as many pairs as B has ids.
    counted = pairs.groupBy("a", "b").agg(F.sum("documents").alias("count")).withColumn(
        "is_best", F.col("count") == F.max("count").over(Window.partitionBy("a"))
    )
    scored = pairs.join(counted, ["a", "b"]).select(
        F.col("block").alias("of_block"), "place", "count", "is_best"
    )
    rows = listed.where(F.col("a").isNull()).select(
        "block", "doc_id", *COUNTS, "groups", "places", "repeats"
    )
    return rows.groupBy("block").cogroup(scored.groupBy("of_block")).applyInPandas(look_up, RESULT)
