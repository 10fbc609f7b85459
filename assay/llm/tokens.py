"""Token ids of whole texts, quickly: pieces of words are merged once per worker and remembered.

The byte-level pattern never joins characters across the point before a single blank that is
followed by a non-blank, so a text may be encoded blank by blank and the ids put together. Texts
where a blank stands between or after other white space are encoded whole. A word of Latin letters,
digits, marks and line ends is cut where the pattern cuts it, at changes of the kind of character,
so that a word with other marks around it is no new word, and the library's model merges each piece.
Other words are laid end to end and encoded together; the bytes that each id stands for tell them
apart again. Cutting, telling the pieces of a step apart and putting their ids together is done by
numpy and Arrow.
"""

from __future__ import annotations

import json
import os
import re
import string

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from assay.llm.pieces import byte_of_character

ODD_BLANKS = re.compile(r" (?<=\s )(?:\s|\Z)")
REMEMBERED = 350_000
LONGEST_REMEMBERED = 64
WORDS_A_CALL = 4096
# The apostrophe starts English endings, for which the pattern has a rule of its own.
MARKS = string.punctuation.replace("'", "")
BLANK, LINE_END, LETTER, DIGIT, MARK, ODD = range(6)
SPELT = {byte: character for character, byte in byte_of_character().items()}


def byte_kinds(path: str) -> np.ndarray:
    """The kind of every byte of a text in UTF-8. A word with an odd one is left to the tokenizer.

    Odd are what the byte-level pattern needs more than kinds for, and the first character of an
    added token, which the tokenizer looks for before it cuts. With other settings than the
    pattern alone, all bytes but the blank are odd.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    kinds = np.full(256, ODD, np.uint8)
    kinds[ord(" ")] = BLANK
    before, model, added = content["pre_tokenizer"] or {}, content["model"], content["added_tokens"]
    usual = (
        before.get("type") == "ByteLevel" and before.get("use_regex", True)
        and not before.get("add_prefix_space") and not content["normalizer"]
        and not content["truncation"] and model.get("type", "BPE") == "BPE"
        and not model.get("dropout")
        and all(token["content"][:1] in string.punctuation for token in added)
        and not any(token["lstrip"] or token["single_word"] for token in added)
    )
    if usual:
        for kind, characters in (
            (LINE_END, "\n"), (LETTER, string.ascii_letters), (DIGIT, string.digits), (MARK, MARKS)
        ):
            kinds[list(characters.encode())] = kind
        # First bytes of U+00C0 to U+017F, and the bytes that follow a first one.
        kinds[0xC3:0xC6] = LETTER
        kinds[0x80:0xC0] = LETTER
        kinds[[ord(token["content"][0]) for token in added]] = ODD
    return kinds


def cut_pieces(
    data: np.ndarray, starts: np.ndarray, kinds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of the texts begin that lie end to end in ``data`` from ``starts`` on, and
    which pieces are whole words with something odd. A blank belongs to what follows it."""
    kind = kinds[data]
    blank, line_end, odd = kind == BLANK, kind == LINE_END, kind == ODD
    word = blank.copy()
    word[starts] = True
    # A line end next to white space, and the two signs between the letters of Latin-1.
    odd[1:] |= line_end[1:] & (line_end[:-1] | blank[:-1])
    odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    begins = word.copy()
    begins[1:] |= (kind[1:] != kind[:-1]) & ~blank[:-1]
    if odd.any():
        number = np.cumsum(word)
        is_odd = np.zeros(number[-1] + 1, bool)
        is_odd[number[odd]] = True
        odd = is_odd[number]
        begins &= word | ~odd
    places = np.flatnonzero(begins)
    return places, odd[places]


class WordEncoder:
    """``encode`` gives the ids of each text as little-endian bytes of ``kind``."""

    def __init__(self, path: str, kind: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text inside a document.
        self.tokenizer.encode_special_tokens = True
        self.kind = np.dtype(kind)
        vocabulary = self.tokenizer.get_vocab()
        # A token of the vocabulary file is written with one character per byte.
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.id_bytes[number] = len(token)
        self.model = self.tokenizer.model
        self.kinds = byte_kinds(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, dtype=self.kind).tobytes()

    def together(self, words: list[str]) -> list[bytes]:
        """Ids of every word with a blank before it; words begin and end with non-blanks."""
        chunks = [" " + word for word in words]
        found = self.tokenizer.encode_batch_fast(["".join(chunks)], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype=self.kind)
        ends = np.cumsum([len(chunk.encode()) for chunk in chunks])
        reached = np.cumsum(self.id_bytes[ids])
        cuts = np.searchsorted(reached, ends) + 1
        if not np.array_equal(reached[cuts - 1], ends):
            return [self.whole(chunk) for chunk in chunks]
        data, size = ids.tobytes(), self.kind.itemsize
        cuts = (cuts * size).tolist()
        return [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that the pattern keeps whole."""
        merge, numbers, cuts = self.model.tokenize, [], [0]
        for piece in pieces:
            if piece.isascii() and piece != "\n":
                piece = piece.replace(" ", SPELT[ord(" ")])
            else:
                piece = piece.encode().decode("latin-1").translate(SPELT)
            numbers += [token.id for token in merge(piece)]
            cuts.append(len(numbers) * self.kind.itemsize)
        data = np.array(numbers, self.kind).tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def learned(self, pieces: list[str], odd: set[str]) -> dict[str, bytes]:
        """Ids of pieces; the odd ones are words that the tokenizer cuts."""
        found, plain = {}, []
        for piece in odd.intersection(pieces):
            word = piece[1:]
            if piece[0] == " " and word and word == word.strip():
                plain.append(word)
            else:
                found[piece] = self.whole(piece)
        for at in range(0, len(plain), WORDS_A_CALL):
            part = plain[at: at + WORDS_A_CALL]
            found.update(zip([" " + word for word in part], self.together(part), strict=True))
        usual = [piece for piece in pieces if piece not in odd] if odd else pieces
        found.update(zip(usual, self.merged(usual), strict=True))
        return found

    def ids_of(self, pieces: list[str], odd: set[str]) -> list[bytes]:
        """Ids of different pieces, remembered ones or learned."""
        ids = list(map(self.known.get, pieces))
        missing = [place for place, found in enumerate(ids) if found is None]
        if len(self.known) + len(missing) > REMEMBERED:
            # Pieces that are still in use come back from the older half one by one.
            self.older = self.known
            self.known = {
                piece: found for piece, found in zip(pieces, ids, strict=True) if found is not None
            }
        known, older = self.known, self.older
        fresh = []
        for place in missing:
            if (found := older.get(piece := pieces[place])) is None:
                fresh.append(piece)
            else:
                known[piece] = found
        known.update(self.learned(fresh, odd))
        for place in missing:
            ids[place] = known[pieces[place]]
        if max(map(len, fresh), default=0) > LONGEST_REMEMBERED:
            for piece in [piece for piece in fresh if len(piece) > LONGEST_REMEMBERED]:
                del known[piece]
        return ids

    def laid(self, ids: list[bytes], which: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The ids numbered ``which``, laid end to end between each two of the ``bounds``."""
        data, size = np.frombuffer(b"".join(ids), self.kind), self.kind.itemsize
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // size
        starts, each = np.cumsum(lengths) - lengths, lengths[which]
        ends = np.concatenate([[0], np.cumsum(each)])
        places = np.repeat(starts[which] - ends[:-1], each) + np.arange(ends[-1])
        row, cuts = data[places].tobytes(), (ends[bounds] * size).tolist()
        return [row[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        found = [self.whole(text) if ODD_BLANKS.search(text) else b"" for text in texts]
        usual = [
            place for place, (text, ids) in enumerate(zip(texts, found, strict=True))
            if text and not ids
        ]
        if not usual:
            return found
        coded = [texts[place].encode() for place in usual]
        data = np.frombuffer(b"".join(coded), np.uint8)
        starts = np.cumsum([0, *map(len, coded)])
        places, odd = cut_pieces(data, starts[:-1], self.kinds)
        cut = pa.LargeStringArray.from_buffers(
            len(places), pa.py_buffer(np.append(places, len(data))), pa.py_buffer(data)
        ).dictionary_encode()
        which = cut.indices.to_numpy()
        pieces = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self.ids_of(pieces, {pieces[number] for number in np.unique(which[odd]).tolist()})
        rows = self.laid(ids, which, np.searchsorted(places, starts))
        for place, row in zip(usual, rows, strict=True):
            found[place] = row
        return found


_encoders: dict[tuple[str, str], WordEncoder] = {}


def encoder(path: str, kind: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; made once."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = WordEncoder(path, kind)
    return _encoders[path, kind]
