"""Token alignment against a walk over single bytes, corpus counts included."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assay.llm import alignment, pieces
from assay.llm.shared import ship_package

PATH_A = public_tokenizers.path("byte_bpe_50k.json")
PATH_B = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "a  b", " leading", "trailing ", "tab\tx\n\ny", "Ünï çödé 漢字 🙂 naïve",
    "holds ▁ the mark", "<s> <|endoftext|> </s> <0x41>", "it's we'll 123 4.5", "word " * 3000,
    "unbelievably" * 400, "the same text", "the same text", "nul \0 byte", "　wide blank",
]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def token_bytes(tokenizers):
    a, b = tokenizers
    byte_of = pieces.byte_of_character()
    names = {i: token for token, i in a.get_vocab().items()}
    in_b = [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
        else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())
    ]
    return lambda i: bytes(byte_of[c] for c in names[i]), in_b.__getitem__


def walked(tokenizers, text):
    """Groups and linked pairs, from the token that covers each single byte."""
    spelt_a, spelt_b = token_bytes(tokenizers)
    a = tokenizers[0].encode(" " + (text or ""), add_special_tokens=False).ids if text else []
    b = tokenizers[1].encode(text) if text else []
    whole = f" {text}".encode()
    if not text or b"".join(map(spelt_a, a)) != whole or b"".join(map(spelt_b, b)) != whole:
        return 0, 0, [], []
    owner_a = [k for k, i in enumerate(a) for _ in spelt_a(i)]
    owner_b = [k for k, i in enumerate(b) for _ in spelt_b(i)]
    links = sorted(set(zip(owner_a, owner_b)))
    ends = [
        at for at in range(len(whole))
        if at + 1 == len(whole)
        or (owner_a[at] != owner_a[at + 1] and owner_b[at] != owner_b[at + 1])
    ]
    groups, start = [], 0
    for end in ends:
        span = range(start, end + 1)
        groups.append((
            [a[k] for k in sorted({owner_a[at] for at in span})],
            [b[k] for k in sorted({owner_b[at] for at in span})],
        ))
        start = end + 1
    return len(a), len(b), groups, [(a[i], b[j]) for i, j in links]


def expected(tokenizers, texts):
    found = [walked(tokenizers, text) for text in texts]
    count = Counter(pair for *_, links in found for pair in set(links))
    best = {}
    for (a, _), held in count.items():
        best[a] = max(best.get(a, 0), held)
    rows = []
    for n_a, n_b, groups, links in found:
        text = ";".join(
            f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups
        )
        rows.append((
            n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
            sum(count[p] for p in links), text,
        ))
    return rows


@pytest.mark.parametrize("block_links", [5, 2_000_000])
def test_counts_and_groups_equal_a_walk_over_bytes(spark, tokenizers, block_links):
    rows = [(None if i == 3 else i, t, "x", 7, None) for i, t in enumerate(TEXTS)]
    rows += [rows[6], rows[12]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string, a int, groups string")
    wanted = expected(tokenizers, [row[1] for row in rows])
    found = alignment.align_tokenizers(docs, PATH_A, PATH_B, block_links=block_links).collect()
    key = lambda row: (row[0] is None, row[0] or 0, row[1:])
    assert sorted(map(tuple, found), key=key) == sorted(
        [(row[0], *want) for row, want in zip(rows, wanted, strict=True)], key=key
    )


def test_given_documents_equal_a_walk_over_bytes(spark, sf_dir, tokenizers):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = alignment.align_tokenizers(docs, PATH_A, PATH_B, digest=True).collect()
    wanted = expected(tokenizers, [row["text"] for row in rows])
    digests = [
        (*want[:-1], hashlib.sha256(want[-1].encode()).hexdigest() if want[0] else "")
        for want in wanted
    ]
    assert sorted(map(tuple, found)) == sorted(
        (row["doc_id"], *want) for row, want in zip(rows, digests, strict=True)
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(docs, PATH_A, PATH_B).count() == 0


def lengths():
    return st.lists(st.integers(1, 4), min_size=1, max_size=60)


@settings(max_examples=200, deadline=None)
@given(lengths(), lengths())
def test_stretches_and_groups_partition_the_tokens(a, b):
    gap = sum(a) - sum(b)
    (b if gap > 0 else a).extend([1] * abs(gap))
    ends_a, ends_b = np.cumsum(a), np.cumsum(b)
    aligned = alignment.align(ends_a, ends_b)
    shared = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
    text = alignment.Names(len(a), len(b)).described(
        np.arange(len(a)), np.arange(len(b)), np.isin(ends_a, shared), np.isin(ends_b, shared)
    ).decode()
    assert text.count(";") + 1 == len(shared)
    parts = [part.split("|") for part in text.split(";")]
    assert [int(x.split(",")[-1]) for x, _ in parts] == np.searchsorted(ends_a, shared).tolist()
    assert [int(y.split(",")[-1]) for _, y in parts] == np.searchsorted(ends_b, shared).tolist()
    assert [int(i) for x, _ in parts for i in x.split(",")] == list(range(len(a)))
    assert [int(i) for _, y in parts for i in y.split(",")] == list(range(len(b)))
    start_a, start_b = ends_a - a, ends_b - b
    overlap = {
        (i, j) for i in range(len(a)) for j in range(len(b))
        if start_a[i] < ends_b[j] and start_b[j] < ends_a[i]
    }
    links = list(zip(*(part.tolist() for part in aligned.links())))
    assert len(links) == len(overlap) and set(links) == overlap


def test_long_stretches_are_jumped_over(monkeypatch):
    """A stretch of 2 ** 16 groups takes some forty comparisons, not one for each."""
    calls = 0

    class Counted(bytes):
        def __getitem__(self, key):
            nonlocal calls
            calls += 1
            return bytes.__getitem__(self, key)

    ends = np.arange(1, 65_537).astype("<u4").tobytes()
    other = bytearray(ends)
    other[-4:] = b"\0\0\0\1"
    run = alignment.equal_run(Counted(ends), bytes(other), 0, 0, len(ends))
    assert run == len(ends) - 4 and calls < 50
