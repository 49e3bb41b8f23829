"""Byte-level BPE vocabulary files, and texts cut into the pieces that are merged on their own.

The cut is the usual one of byte-level BPE: contractions, letters, digits and other
signs with one space before them, and white space. It is computed for many texts at
once, from runs of equal character classes. Letters and digits are Unicode's; code
points that Python's tables do not know are looked up in the tokenizer itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from lodeworks.llm.arrays import row_starts, tiles

LETTER, DIGIT, SIGN, SPACE, UNKNOWN = range(5)
# The white space that separates pieces.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What an apostrophe at the start of a piece takes along.
SHORT_TAILS = ("s", "t", "m", "d")
LONG_TAILS = ("re", "ve", "ll")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in vocabulary files."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict:
    """``tokens`` (bytes by id), ``ids`` (by bytes), ``merges`` (pairs of ids in order), ``added`` (ids by bytes)."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    plain = content["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if model["type"] != "BPE" or content["normalizer"] or not plain or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    back = {letter: byte for byte, letter in enumerate(byte_letters())}
    ids = {bytes(back[c] for c in token): i for token, i in model["vocab"].items()}
    split = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [tuple(ids[bytes(back[c] for c in part)] for part in pair) for pair in split]
    added = {t["content"].encode(): t["id"] for t in content["added_tokens"]}
    size = max([*ids.values(), *added.values()]) + 1
    tokens = [b""] * size
    for token, i in [*ids.items(), *added.items()]:
        tokens[i] = token
    return {"tokens": tokens, "ids": ids, "merges": merges, "added": added}


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """The file opened by the tokenizers library, without truncation and padding."""
    opened = Tokenizer.from_file(path)
    opened.no_truncation()
    opened.no_padding()
    return opened


def library_ids(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """Encodes pieces with the tokenizers library's own model."""
    model, added = tokenizer(path).model, vocabulary(path)["added"]
    shown = {byte: letter for byte, letter in enumerate(byte_letters())}

    def ids(piece: bytes) -> list[int]:
        if piece in added:
            return [added[piece]]
        return [token.id for token in model.tokenize(piece.decode("latin-1").translate(shown))]

    return lambda pieces: [np.array(ids(p), "<u4").tobytes() for p in pieces]


class Cutter:
    """Cuts UTF-8 texts into pieces, for one vocabulary file."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        added = sorted(vocabulary(path)["added"], key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        for c in range(0x80):
            self.classes[c] = {"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(c))[0], SIGN)
        self.classes[WHITE] = SPACE

    def _learn(self, points: np.ndarray) -> None:
        for c in points.tolist():
            category = unicodedata.category(chr(c))
            kind = {"L": LETTER, "N": DIGIT}.get(category[0], SIGN)
            if category == "Cn":  # perhaps newer than Python's tables
                parts = len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f"x{chr(c)}1"))
                starts = {start for _, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(f"x{chr(c)}1")}
                kind = SIGN if parts == 3 else LETTER if 1 not in starts else DIGIT
            self.classes[c] = kind

    def _characters(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first byte of each character, and its code point."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        leads = data[at]
        points = leads.astype(np.uint32)
        for low, high, length, bits in ((0xC0, 0xDF, 2, 0x1F), (0xE0, 0xEF, 3, 0x0F), (0xF0, 0xF7, 4, 0x07)):
            which = np.flatnonzero((leads >= low) & (leads <= high))
            lead = at[which]
            value = data[lead].astype(np.uint32) & bits
            for step in range(1, length):
                value = (value << 6) | (data[lead + step] & 0x3F)
            points[which] = value
        return at, points

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The places in ``data`` where pieces start; no piece crosses a text's end."""
        if not len(data):
            return np.zeros(0, np.int64)
        at, points = self._characters(data)
        kinds = self.classes[points]
        if (kinds == UNKNOWN).any():
            self._learn(np.unique(points[kinds == UNKNOWN]))
            kinds = self.classes[points]
        first = row_starts(len(data), offsets)
        whole = [m.span() for m in self.added.finditer(data.tobytes())] if self.added else []
        inner = np.searchsorted(offsets, [a for a, _ in whole], "right") == np.searchsorted(offsets, [b - 1 for _, b in whole], "right")
        whole = [span for span, same in zip(whole, inner, strict=True) if same]
        for a, b in whole:
            first[a] = True
            if b < len(data):
                first[b] = True
        new_row = first[at]
        n = len(at)
        run = np.empty(n, bool)  # a run of one class starts here
        run[0] = True
        run[1:] = new_row[1:] | (kinds[1:] != kinds[:-1])
        ends_row = np.empty(n, bool)  # the row ends after this character
        ends_row[-1] = True
        ends_row[:-1] = new_row[1:]
        space = kinds == SPACE
        blank = points == 0x20
        before_other = np.zeros(n, bool)  # last white space before other characters of the row
        before_other[:-1] = space[:-1] & ~space[1:] & ~new_row[1:]
        after_blank = np.zeros(n, bool)  # the space before belongs to this run's piece
        after_blank[1:] = blank[:-1] & ~new_row[1:]
        starts = np.where(space, run | before_other, run & ~after_blank)
        quote = np.flatnonzero((points[:-1] == 0x27) & starts[:-1] & (kinds[1:] == LETTER) & ~new_row[1:])
        for tails, length in ((SHORT_TAILS, 1), (LONG_TAILS, 2)):
            for tail in tails:
                fits = quote[quote + length < n]
                for i, c in enumerate(tail, 1):
                    fits = fits[(points[fits + i] == ord(c)) & ~new_row[fits + i]]
                starts[fits + 1] = False
                beyond = fits + length + 1
                inside = beyond[beyond < n]
                starts[inside[(kinds[inside] == LETTER) & ~new_row[inside]]] = True
        places = at[starts]
        for a, b in whole:
            places = places[(places <= a) | (places >= b)]
        return places


class Memo:
    """Ids of pieces, for the pieces that come again.

    Two generations of at most ``limit`` pieces each (or those of one slice): when the
    younger is full it becomes the older one, so frequent pieces stay.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], limit: int = 300_000):
        self.encode, self.limit, self.young, self.old = encode, limit, {}, {}

    def of(self, pieces: list[bytes]) -> list[bytes]:
        """For each piece its ids as little-endian 32-bit numbers."""
        found = [self.young.get(p) or self.old.get(p) for p in pieces]
        missing = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        made = iter(self.encode(missing))
        found = [next(made) if ids is None else ids for ids in found]
        if len(self.young) + len(pieces) > self.limit:
            self.young, self.old = {}, self.young
        self.young.update(zip(pieces, found, strict=True))
        return found


def encode_texts(cutter: Cutter, memo: Memo, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another (uint32), and the places between the texts."""
    starts = cutter.cut(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    distinct = tiles(data, starts).dictionary_encode()
    known = memo.of(distinct.dictionary.to_pylist())
    pool = np.frombuffer(b"".join(known), "<u4")
    lengths = np.fromiter((len(k) // 4 for k in known), np.int64, len(known))
    begins = np.cumsum(lengths) - lengths
    which = distinct.indices.to_numpy(zero_copy_only=False)
    counts = lengths[which]
    places = np.zeros(len(which) + 1, np.int64)
    np.cumsum(counts, out=places[1:])
    ids = pool[np.repeat(begins[which] - places[:-1], counts) + np.arange(places[-1])]
    return ids, places[np.searchsorted(starts, offsets)]


def id_lists(ids: np.ndarray, places: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), pa.array(ids.view(np.int32)))
