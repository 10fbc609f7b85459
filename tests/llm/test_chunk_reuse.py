"""Chunk-wise encoding against the library on whole texts, and decoding back."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assay.llm import chunk_reuse
from assay.llm.queries import op12_bpe_codec
from assay.llm.shared import ship_package

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", " ", "  ", "\n", "é", "漢", "'s", "12", "<|endoftext|>", "<|endof", "text|>", " the", "　",
    ".", "🙂", "\x1c", "\t",
]
LONG = [
    "x" * 20_000, "漢字" * 5_000, " " * 9_000, "a\n \n" * 4_000, "<|endoftext|>" * 900,
    "word <|endoftext|>x " * 900, "\x1c a \x1c" * 2_500, "é " * 5_000, "🙂" * 3_000,
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def made_up(count):
    dice = random.Random(3)
    return ["".join(dice.choice(PARTS) for _ in range(dice.randrange(2_500))) for _ in range(count)]


@pytest.mark.parametrize("a_call", [1, 7, 500])
def test_chunks_give_the_ids_of_whole_texts(tokenizer, a_call):
    texts = ["", "a", *LONG, *made_up(60), "same words " * 200, "same words " * 200]
    worker = chunk_reuse.ChunkEncoder(PATH)
    found = [
        ids.tolist() for at in range(0, len(texts), a_call)
        for ids in worker.encode(texts[at: at + a_call])
    ]
    assert found == ids_of(tokenizer, texts)


def test_small_chunks_and_a_small_memory_change_nothing(tokenizer, monkeypatch):
    for name, value in (
        ("SHORTEST", 40), ("LONGEST", 90), ("MEAN_BEYOND_SHORTEST", 16), ("REMEMBERED_BYTES", 5_000)
    ):
        monkeypatch.setattr(chunk_reuse, name, value)
    texts = [*LONG, *made_up(60), *made_up(60)]
    worker = chunk_reuse.ChunkEncoder(PATH)
    found = [ids.tolist() for text in texts for ids in worker.encode([text])]
    assert found == ids_of(tokenizer, texts)


def test_shared_passages_are_encoded_once():
    dice = random.Random(5)
    passage = " ".join(f"word{dice.randrange(10 ** 6)}" for _ in range(5_000))
    worker = chunk_reuse.ChunkEncoder(PATH)
    worker.encode([passage])
    first = worker.chunks_encoded
    worker.encode([f"{'intro ' * k}{passage} outro {k}" for k in range(1, 11)])
    assert first > 50 and worker.chunks_encoded - first < 60


def test_words_of_new_chunks_are_merged_once_whatever_marks_follow():
    dice = random.Random(15)
    words = ["".join(dice.choice("abcdeéñ") for _ in range(12)) for _ in range(500)]
    worker = chunk_reuse.ChunkEncoder(PATH)
    worker.encode([" ".join(words)])
    chunks, before = worker.chunks_encoded, len(worker.words.known)
    worker.encode([" ".join(f"{word}{dice.choice(['.', ',', '!?', ';'])}" for word in words)])
    assert worker.chunks_encoded - chunks > 5 and len(worker.words.known) - before < 100


def test_cuts_follow_the_content_and_their_bounds():
    dice = random.Random(7)
    text = "".join(dice.choice("abcdé漢 \n") for _ in range(60_000)).encode()
    (alone,) = chunk_reuse.cut_points(text, [len(text)])
    moved = chunk_reuse.cut_points(b"q" * 1_000 + text, [1_000, 1_000 + len(text)])[1]
    assert alone == [cut - 1_000 for cut in moved]
    sizes = np.diff([0, *alone])
    assert sizes[:-1].min() >= chunk_reuse.SHORTEST and sizes.max() <= chunk_reuse.LONGEST
    assert b"".join(text[a:b] for a, b in zip([0, *alone], alone)) == text
    for a, b in zip([0, *alone], alone):
        text[a:b].decode()


def test_documents_and_odd_rows(spark, tokenizer):
    texts = [None, "", "a", "<|endoftext|>", *LONG[:4], "twice", "twice"]
    rows = [(None if i == 2 else i, text, b"ids", 3) for i, text in enumerate(texts)] + [(5, LONG[1], b"", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, n_tokens int")
    coded = chunk_reuse.encode_documents(docs, PATH)
    found = coded.withColumn("text", chunk_reuse.decoded(F.col("ids"), PATH)).collect()
    wanted = [
        (row[0], len(ids), np.array(ids, "<u4").tobytes(), row[1] or "")
        for row, ids in zip(rows, ids_of(tokenizer, [row[1] or "" for row in rows]), strict=True)
    ]
    key = lambda row: (row[0] is None, row[0] or 0)
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    assert chunk_reuse.encode_documents(docs.limit(0), PATH).count() == 0


def test_decoding_equals_the_library(spark, tokenizer):
    dice = random.Random(9)
    lists = [[dice.randrange(50_257) for _ in range(40)] for _ in range(200)]
    rows = [(i, np.array(ids, "<u4").tobytes()) for i, ids in enumerate(lists)] + [(999, None)]
    found = spark.createDataFrame(rows, "i int, ids binary").select(
        "i", chunk_reuse.decoded(F.col("ids"), PATH).alias("text")
    ).collect()
    texts = {row["i"]: row["text"] for row in found}
    assert texts.pop(999) is None
    assert [texts[i] for i in range(200)] == [
        tokenizer.decode(ids, skip_special_tokens=False) for ids in lists
    ]


def test_query_equals_the_library(spark, sf_dir, tokenizer):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for row, ids in zip(rows, ids_of(tokenizer, [row["text"] or "" for row in rows]), strict=True):
        text = tokenizer.decode(ids, skip_special_tokens=False)
        wanted.append((
            row["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        ))
    assert sorted(map(tuple, op12_bpe_codec(spark, sf_dir).collect())) == sorted(wanted)
