"""BPE encoding by content-defined chunks, and decoding.

A rolling hash over the last bytes cuts texts where their content says so, so passages that
documents share become equal chunks wherever they stand. A worker remembers the ids of chunks and
encodes an equal one once for all its documents, batches and tasks. A chunk's ids near its ends may
differ from those that the whole text has there. So a join between chunks is encoded anew over a
window that grows, to both sides, to the nearest points that the encoder cannot look across (a
single blank between characters that are not blank), over whole chunks where a chunk has no such
point. From these points on, the chunks' own ids and those of the window agree with the ids of the
whole text.

Nothing is shuffled: a chunk that documents of several workers share is encoded by each of them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm.pieces import byte_level_tokens
from assay.llm.tokens import WordEncoder

WINDOW_STEPS = 5  # the hash covers 2 ** 5 bytes
SHORTEST = 256
LONGEST = 4096
MEAN_BEYOND_SHORTEST = 512
REMEMBERED_BYTES = 32 << 20
TEXTS_A_CALL = 256
SURE_POINT = re.compile(r"(?<=\S) (?=\S)")
MULTIPLIER = 0x9E3779B1

ENCODED = "doc_id long, n_tokens long, ids binary"
ENCODED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())
])


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``2 ** WINDOW_STEPS`` bytes up to and with each byte (fewer at the start): a
    polynomial modulo 2 ** 32, doubled in length step by step."""
    mixed = np.arange(256, dtype=np.uint64) * MULTIPLIER
    hashes = ((mixed ^ (mixed >> 15)) & 0xFFFFFFFF).astype(np.uint32)[data]
    factor = MULTIPLIER
    for step in range(WINDOW_STEPS):
        reach = 1 << step
        longer = hashes.copy()
        longer[reach:] += hashes[:-reach] * np.uint32(factor)
        hashes, factor = longer, factor * factor & 0xFFFFFFFF
    return hashes


def cut_points(data: bytes, ends: list[int]) -> list[list[int]]:
    """Ends of the chunks of every text; the texts lie end to end in ``data``, up to ``ends``.

    A chunk ends where the hash says so, at least ``SHORTEST`` bytes after the last cut, and after
    ``LONGEST`` bytes in any case; never inside a character.
    """
    array = np.frombuffer(data, np.uint8)
    hashes = rolling_hashes(array)
    mark = (hashes * np.uint32(MULTIPLIER)) >> np.uint32(8)
    follows = np.append((array[1:] & 0xC0) != 0x80, True)
    places = (np.flatnonzero((mark % MEAN_BEYOND_SHORTEST == 0) & follows) + 1).tolist()
    found, start = [], 0
    for end in ends:
        cuts, at = [], start
        while end - at > SHORTEST:
            place = bisect_left(places, at + SHORTEST)
            cut = min(places[place] if place < len(places) else end, end)
            if cut - at > LONGEST:
                cut = at + LONGEST
                while data[cut] & 0xC0 == 0x80:
                    cut -= 1
            cuts.append(cut)
            at = cut
        if at < end:
            cuts.append(end)
        found.append(cuts)
        start = end
    return found


class LibraryEncoder(WordEncoder):
    """Encodes words as the tokenizer does by default: a special token's text is that token."""

    def __init__(self, path: str, kind: str):
        super().__init__(path, kind)
        self.tokenizer.encode_special_tokens = False


@dataclass(slots=True)
class Chunk:
    """Ids of a chunk, and the ids before its first and from its last sure point on: those are
    only right if the chunk stands alone. ``head`` is None where there is no sure point."""

    ids: np.ndarray
    head: int | None
    tail: int


class ChunkEncoder:
    """``encode`` gives the ids of each text, as the tokenizer gives them for the whole text."""

    def __init__(self, path: str):
        self.words = LibraryEncoder(path, "<u4")
        self.id_bytes = byte_level_tokens(path)
        self.lengths = np.array([len(token) for token in self.id_bytes])
        self.known: dict[bytes, Chunk] = {}
        self.older: dict[bytes, Chunk] = {}
        self.known_bytes = 0
        self.chunks_encoded = 0

    def arrays(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4") for ids in self.words.encode(texts)]

    def measured(self, text: str, ids: np.ndarray) -> Chunk:
        first = SURE_POINT.search(text)
        if first is None:
            return Chunk(ids, None, 0)
        last = first.start()
        at = len(text)
        while (at := text.rfind(" ", last + 1, at)) >= 0:
            if SURE_POINT.match(text, at):
                last = at
                break
        reached = np.cumsum(self.lengths[ids])
        cuts = np.searchsorted(reached, [len(text[:first.start()].encode()), len(text[:last].encode())])
        return Chunk(ids, int(cuts[0]) + 1, int(cuts[1]) + 1)

    def learn(self, chunks: list[bytes]) -> None:
        """Make sure that all these chunks are remembered."""
        fresh = [chunk for chunk in dict.fromkeys(chunks) if chunk not in self.known]
        size = sum(map(len, fresh))
        if self.known_bytes + size > REMEMBERED_BYTES:
            # Chunks that are still in use come back from the older half one by one.
            self.older, self.known = self.known, {}
            fresh = list(dict.fromkeys(chunks))
            self.known_bytes, size = 0, sum(map(len, fresh))
        self.known_bytes += size
        self.known.update({chunk: self.older[chunk] for chunk in fresh if chunk in self.older})
        fresh = [chunk for chunk in fresh if chunk not in self.known]
        texts = [chunk.decode() for chunk in fresh]
        self.chunks_encoded += len(fresh)
        for chunk, text, ids in zip(fresh, texts, self.arrays(texts), strict=True):
            self.known[chunk] = self.measured(text, ids)

    def spelt(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.id_bytes.__getitem__, ids.tolist()))

    def joined(self, chunks: list[Chunk]) -> list[np.ndarray | bytes]:
        """A text as ids that stand, and bytes of joins that are to be encoded anew."""
        if len(chunks) < 2:
            return [chunk.ids for chunk in chunks]
        parts: list[np.ndarray | bytes] = []
        window: list[np.ndarray] = []
        for place, chunk in enumerate(chunks):
            if chunk.head is None:
                window.append(chunk.ids)
                continue
            if place == 0:
                parts.append(chunk.ids[:chunk.tail])
            else:
                window.append(chunk.ids[:chunk.head])
                parts.append(self.spelt(np.concatenate(window)))
                parts.append(chunk.ids[chunk.head: chunk.tail])
            window = [chunk.ids[chunk.tail:]]
        if len(window) == 1 and chunks[-1].head is not None:
            parts.append(window[0])
        else:
            parts.append(self.spelt(np.concatenate(window)))
        return parts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        coded = [text.encode() for text in texts]
        data, ends = b"".join(coded), np.cumsum([len(text) for text in coded]).tolist()
        cut, start = [], 0
        for points in cut_points(data, ends) if data else [[] for _ in texts]:
            cut.append([data[a:b] for a, b in zip([start, *points], points)])
            start = points[-1] if points else start
        self.learn([chunk for chunks in cut for chunk in chunks])
        parts = [self.joined([self.known[chunk] for chunk in chunks]) for chunks in cut]
        windows = list({part for found in parts for part in found if isinstance(part, bytes)})
        repaired = dict(zip(windows, self.arrays([w.decode() for w in windows]), strict=True))
        nothing = np.empty(0, "<u4")
        return [
            np.concatenate([nothing, *[
                repaired[part] if isinstance(part, bytes) else part for part in found
            ]])
            for found in parts
        ]


_encoders: dict[str, ChunkEncoder] = {}


def chunk_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file; made once."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def encode_batches(batches: Iterable[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    worker = chunk_encoder(path)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_A_CALL):
            part = batch.slice(at, TEXTS_A_CALL)
            found = worker.encode([text or "" for text in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([
                part.column(0),
                pa.array([len(ids) for ids in found], pa.int64()),
                pa.array([ids.tobytes() for ids in found], pa.binary()),
            ], schema=ENCODED_ARROW)


def encode_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids``: ids of every whole text as little-endian unsigned 32-bit numbers.

    The ids are those of the tokenizers library for a byte-level vocabulary file, without special
    tokens around the text; the text of a special token inside it is that token. NULL and empty
    texts have no ids. Every row gives one row, repeated rows and rows with a NULL id too. No rows:
    no result. Other columns are not read.
    """
    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(
        lambda batches: encode_batches(batches, path), ENCODED
    )


def decoded(ids: Column, path: str) -> Column:
    """Text of a column of ids as ``encode_documents`` gives them, special tokens written out.

    Bytes that are no UTF-8 become the replacement character, as in the tokenizers library. NULL
    ids give NULL.
    """

    @F.pandas_udf("string")
    def texts(column: pd.Series) -> pd.Series:
        table = chunk_encoder(path).id_bytes
        return pd.Series([
            None if data is None else b"".join(
                map(table.__getitem__, np.frombuffer(data, "<u4").tolist())
            ).decode("utf-8", "replace")
            for data in column
        ], dtype=object)

    return texts(ids)
