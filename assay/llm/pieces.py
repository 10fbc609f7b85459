"""Ids of whole texts by a SentencePiece model, and the bytes that the ids of both kinds of
vocabulary stand for.

A piece never holds the blank mark behind another character, so merges do not reach over a single
blank: a text is encoded word by word, and words are remembered. Texts with blanks side by side or
at an end, or with the blank mark itself, are encoded whole, and so is everything by a model with
other pieces.
"""

from __future__ import annotations

import json

import numpy as np
from sentencepiece import SentencePieceProcessor

BLANK_MARK = "▁"
REMEMBERED = 350_000
LONGEST_REMEMBERED = 64


def byte_of_character() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte, turned round: printable
    bytes of Latin-1 stand for themselves, the others follow from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    found = {chr(byte): byte for byte in shown}
    rest = [byte for byte in range(256) if byte not in shown]
    return found | {chr(256 + place): byte for place, byte in enumerate(rest)}


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary file; added tokens are their own text."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    byte_of, vocabulary = byte_of_character(), content["model"]["vocab"]
    added = {token["id"]: token["content"].encode() for token in content["added_tokens"]}
    found = [b""] * (max([*vocabulary.values(), *added]) + 1)
    for token, number in vocabulary.items():
        if number not in added:
            found[number] = bytes(byte_of[character] for character in token)
    for number, text in added.items():
        found[number] = text
    return found


class PieceEncoder:
    """``encode`` gives the ids of each text as little-endian bytes of ``kind``."""

    def __init__(self, path: str, kind: str = "<u4"):
        self.model = SentencePieceProcessor(model_file=path)
        self.kind = np.dtype(kind)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.id_bytes = [
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
            else piece.replace(BLANK_MARK, " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.by_word = not any(BLANK_MARK in piece.lstrip(BLANK_MARK) for piece in pieces)
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, self.kind).tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def words(self, text: str) -> list[str] | None:
        plain = "  " not in text and not text.startswith(" ") and not text.endswith(" ")
        return text.split(" ") if self.by_word and plain and BLANK_MARK not in text else None

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self.words(text) for text in texts]
        wanted = {word for words in parts if words is not None for word in words}
        fresh = wanted.difference(self.known)
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known, fresh = {}, wanted
        listed = list(fresh)
        self.known.update(zip(listed, self.ids(listed), strict=True))
        known = self.known
        found = [
            self.ids([text])[0] if words is None else b"".join(map(known.__getitem__, words))
            for text, words in zip(texts, parts, strict=True)
        ]
        for word in [word for word in listed if len(word) > LONGEST_REMEMBERED]:
            del known[word]
        return found
