"""Packing and token scan: every id in one place, counts as brute force counts them."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assay.llm import packing, token_scan
from assay.llm.shared import ship_package
from assay.llm.tokens import WordEncoder, byte_kinds, cut_pieces
from assay.session import new_run_root

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "a", "two  blanks", "end  ", "line \n \n next", "tab\t x\n\n  y ", "Ünï çödé 漢字 🙂",
    "it's we'll 123 4.5", "word " * 9000, "<|endoftext|> inside", "x" * 5000, "same text", "same text",
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def documents(spark, texts):
    rows = [(None if i == 3 else i, t, 1, "b") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int, bin string")


def test_word_by_word_equals_whole_texts(tokenizer, spark, sf_dir):
    given = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    fast = WordEncoder(PATH)
    texts = given + [t for t in TEXTS if t]
    for size in (1, 7, len(texts)):
        for at in range(0, len(texts), size):
            part = texts[at: at + size]
            for text, ids in zip(part, fast.encode(part), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text)


PARTS = [
    "a", "Words", "é", "ſ", "ß", "×", "÷", "ª", "²", "7", "2024", ".", ",", "--", "_", "'", "'s", "’", "<",
    "<|endoftext|>", "漢", "🙂", "e\u0301", "\x1c", "\x85", "\u3000", "\u0660", "\t", "\r\n", "\n", "\n",
    " ", " ", " ", " ", " ",
]


@pytest.mark.parametrize("special", [True, False])
def test_pieces_of_made_up_texts_equal_whole_texts(special):
    dice = random.Random(11)
    texts = [
        "".join(dice.choice(PARTS) for _ in range(dice.randrange(1, 60))) for _ in range(6_000)
    ]
    library = Tokenizer.from_file(PATH)
    fast = WordEncoder(PATH)
    library.encode_special_tokens = fast.tokenizer.encode_special_tokens = special
    for at in range(0, len(texts), 500):
        part = texts[at: at + 500]
        for text, ids in zip(part, fast.encode(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(library, text), repr(text)


def test_words_are_cut_as_the_library_cuts_them(tokenizer):
    texts = ["It is 2024, (or so).\nNew line: 3.5 élan_vital -- ok", "x", "a\n b!?c", "two  blanks"]
    data = "".join(texts).encode()
    starts = np.cumsum([0, *[len(text.encode()) for text in texts[:-1]]])
    places, odd = cut_pieces(np.frombuffer(data, np.uint8), starts, byte_kinds(PATH))
    found = [data[a:b].decode() for a, b in zip(places, [*places[1:], len(data)])]
    wanted = [
        text[a:b] for text in texts
        for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)
    ]
    assert found == wanted and not odd.any()


def test_words_with_other_marks_are_no_new_words():
    dice = random.Random(13)
    words = ["".join(dice.choice("abcdeéñ") for _ in range(12)) for _ in range(2_000)]
    fast = WordEncoder(PATH)
    fast.encode([" " + " ".join(words)])
    before = len(fast.known)
    fast.encode([" " + " ".join(f"{word}{dice.choice(['.', ',', '!?', ';'])}" for word in words)])
    assert len(fast.known) - before < 10


def check_packed(rows, expected):
    """Pieces cover every document once and sequences without gaps or overlap."""
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], []).append(row)
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    assert by_doc.keys() == expected.keys()
    for name, ids in expected.items():
        at = 0
        for row in sorted(by_doc[name], key=lambda r: r["start"]):
            piece = np.array(ids[at: at + row["length"]], "<u4").tobytes()
            assert (row["start"], row["doc_tokens"]) == (at, len(ids))
            assert row["ids_crc32"] == zlib.crc32(piece)
            at += row["length"]
        assert at == len(ids)
    for rows in by_sequence.values():
        at = 0
        for row in sorted(rows, key=lambda r: r["offset"]):
            assert row["offset"] == at
            at += row["length"]
        assert 0 < at <= 2048
    return sum(sum(r["length"] for r in rows) for rows in by_sequence.values()), len(by_sequence)


def test_packing_keeps_every_id(spark, tokenizer):
    rows = packing.pack_documents(documents(spark, TEXTS), PATH, with_ids=True).collect()
    expected = {
        None if i == 3 else i: ids_of(tokenizer, t) + [1] for i, t in enumerate(TEXTS)
    }
    check_packed(rows, expected)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)


def test_packing_repeated_rows(spark):
    rows = packing.pack_documents(
        spark.createDataFrame([(7, "again and again")] * 50, "doc_id long, text string"), PATH
    ).collect()
    assert len(rows) == 50
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 50


def test_packing_of_the_given_documents_wastes_little(spark, sf_dir, tokenizer):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack_documents(table, PATH).collect()
    expected = {r["doc_id"]: ids_of(tokenizer, r["text"]) + [1] for r in table.collect()}
    used, sequences = check_packed(rows, expected)
    assert used / (2048 * sequences) > 0.97


def test_packing_of_nothing(spark):
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


def test_plan_uses_every_piece_once():
    random = np.random.default_rng(4)
    histogram = np.zeros(65, np.int64)
    histogram[1:] = random.integers(0, 400, 64)
    plan = packing.packing_plan(histogram)
    used = np.zeros(65, np.int64)
    for pattern in plan:
        assert sum(pattern.bins) <= 64
        for b in pattern.bins:
            used[b] += pattern.windows
    assert (used == histogram).all()
    space = 64 * sum(p.windows for p in plan)
    assert (np.arange(65) * histogram).sum() / space > 0.98


def test_least_squares_meets_its_conditions():
    random = np.random.default_rng(5)
    combos = packing.combinations(16)
    histogram = np.concatenate([[0], random.integers(0, 50, 16)]).astype(float)
    weight = np.ones(17)
    x = packing.non_negative_least_squares(combos, histogram, weight)
    table = np.zeros((17, len(combos)))
    for slot in range(3):
        np.add.at(table, (combos[:, slot], np.arange(len(combos))), 1.0)
    table[0] = 0
    gradient = table.T @ (table @ x - histogram)
    assert (x >= 0).all()
    assert (gradient > -1e-4).all() and np.abs(gradient[x > 1e-9]).max() < 1e-4


@pytest.mark.parametrize("block,width", [(1 << 21, 1024), (7, 3), (1, 2)])
def test_scan_stitches_documents_across_blocks(spark, tokenizer, block, width):
    texts = TEXTS[:10] + ["word " * 40, "", ""]
    listed = token_scan.write_token_files(
        documents(spark, texts).repartition(3), new_run_root(spark, "test"), PATH
    )
    counted = token_scan.count_tokens(
        listed.where("ordinal IS NULL"), block_tokens=block, scan_width=width
    )
    names = listed.where("ordinal IS NOT NULL").select("file", "ordinal", "doc_id")
    rows = counted.join(names, ["file", "ordinal"]).collect()
    found = {r["doc_id"]: r["tokens"] for r in rows}
    assert found == {
        None if i == 3 else i: len(ids_of(tokenizer, t)) for i, t in enumerate(texts)
    }
    for file in {r["file"] for r in rows}:
        at = 0
        for row in sorted((r for r in rows if r["file"] == file), key=lambda r: r["ordinal"]):
            assert row["start"] == at
            at += row["tokens"] + 1


def test_scan_counts_an_open_end_and_no_files(spark, folder):
    path = f"{folder}/open.bin"
    np.array([5, 6, 50256, 7, 8, 9], "<u2").tofile(path)
    open(f"{folder}/empty.bin", "w").close()
    files = spark.createDataFrame(
        [(path, 12, "x"), (f"{folder}/empty.bin", 0, "x")], "file string, file_bytes long, block string"
    )
    for block in (1, 2, 4, 100):
        rows = token_scan.count_tokens(files, block_tokens=block).orderBy("ordinal").collect()
        assert [(r["ordinal"], r["start"], r["tokens"]) for r in rows] == [(0, 0, 2), (1, 3, 3)]
    assert token_scan.count_tokens(files.limit(0)).collect() == []
    nothing = token_scan.write_token_files(
        documents(spark, []), new_run_root(spark, "test"), PATH
    )
    assert nothing.collect() == []
