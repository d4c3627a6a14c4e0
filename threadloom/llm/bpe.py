"""Byte-level BPE: encoding with a priority queue of merge ranks, decoding from vocabulary strings.

The input is any table with a text column; its other columns, whatever their names, are not read. A null text counts as
empty and gives no ids. Repeated rows give repeated results; an empty table gives an empty one. Texts of any length are
encoded whole: cost grows with n log n in the length of one pre-token and linearly in the number of pre-tokens.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import map_rows

# Fixed value: the pre-token pattern of the byte-level vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Encoded words that a Python worker remembers (about 200 bytes each); the store is emptied when it is full, which
# changes no result.
REMEMBERED = 600_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary's strings."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    symbols = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [symbols[b] for b in range(256)]


class ByteBpe:
    """A byte-level BPE vocabulary: ids of strings, merge ranks, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        symbols = byte_symbols()
        self.byte_ids = [vocab[s] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self._pre = regex.compile(PRE_TOKEN)
        to_byte = {s: b for b, s in enumerate(symbols)}
        strings = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        strings |= {i: s.encode() for s, i in self.special.items()}
        self.strings = [strings.get(i, b"") for i in range(max(strings) + 1)]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        Symbols form a doubly linked list. The queue holds (rank, position of the left symbol, both ids); an entry is
        stale when either symbol has changed since it was pushed, and is skipped when it comes up.
        """
        ids = [self.byte_ids[b] for b in piece]
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        merges = self.merges
        queue = [(merges[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(queue)
        while queue:
            _, left, a, b = heapq.heappop(queue)
            right = after[left]
            if ids[left] != a or right < 0 or ids[right] != b:
                continue
            ids[left], ids[right] = merges[a, b][1], -1
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
                _push(queue, merges, left, ids[left], ids[after[left]])
            if before[left] >= 0:
                _push(queue, merges, before[left], ids[before[left]], ids[left])
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> list[int]:
        """Ids of text; special strings in it are taken as special tokens."""
        out: list[int] = []
        for part in self._split.split(text) if self._split else [text]:
            if part in self.special:
                out.append(self.special[part])
            else:
                for piece in self._pre.findall(part):
                    out += self.merge(piece.encode())
        return out

    def decode(self, ids) -> str:
        """The vocabulary strings of ids, put together; bytes that form no character become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", errors="replace")


def _push(queue, merges, left, a, b) -> None:
    if (found := merges.get((a, b))) is not None:
        heapq.heappush(queue, (found[0], left, a, b))


_MARKS = ".,;:!?|#*$%&"


def _packed(ids) -> bytes:
    return array("I", ids).tobytes()


class _Tails(dict):
    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, tail: str) -> bytes:
        if len(self) >= 10_000:
            self.clear()
        found = self[tail] = _packed(self.encode(tail))
        return found


class _Remembered(dict):
    def __init__(self, encode, letters, tails: _Tails, lead: str, limit: int):
        super().__init__()
        self.encode, self.letters, self.tails, self.lead, self.limit = encode, letters, tails, lead, limit

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        core = word.rstrip(_MARKS)
        if core.isalpha():  # letters and the marks after them are pre-tokens of their own
            found = self.letters(self.lead + core) if core is word else self[core] + self.tails[word[len(core) :]]
        else:
            found = _packed(self.encode(self.lead + word))
        self[word] = found
        return found


class WordCache:
    """Encodes whole texts word by word, remembering the ids of words.

    No pre-token spans a single space or a single newline between two other characters: the space belongs to what
    follows, the newline stands alone. So a text whose lines are words with single spaces between them can be encoded
    by words. Any other text goes to `encode` as it is. `letters` encodes one pre-token of letters, with or without a
    space before them.
    """

    def __init__(self, encode: Callable[[str], list[int]], letters: Callable[[str], list[int]], special: tuple[str, ...], limit: int = REMEMBERED):
        self.encode, self.special = encode, special
        tails, packed = _Tails(encode), lambda piece: _packed(letters(piece))
        self.first, self.rest = (_Remembered(encode, packed, tails, lead, limit) for lead in ("", " "))
        self.newline = _packed(encode("\n"))

    def encode_bytes(self, text: str) -> bytes:
        """Ids of text as unsigned little-endian 32-bit integers."""
        if not self._plain(text):
            return _packed(self.encode(text))
        rest = self.rest.__getitem__
        lines = [line.split(" ") for line in text.split("\n")]
        return self.newline.join([self.first[words[0]] + b"".join(map(rest, words[1:])) for words in lines])

    def _plain(self, text: str) -> bool:
        """Words with one space or newline between them, no other white space, no special string."""
        if not text or text[0].isspace() or text[-1].isspace() or any(s in text for s in self.special):
            return False
        # White space other than the space is not printable.
        return text.replace("\n", "").isprintable() and not any(s in text for s in ("  ", "\n\n", " \n", "\n "))


@lru_cache(maxsize=2)
def own_cache(path: str) -> tuple[ByteBpe, WordCache]:
    bpe = ByteBpe(path)
    return bpe, WordCache(bpe.encode, lambda piece: bpe.merge(piece.encode()), tuple(bpe.special))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>) of every whole text with the vocabulary file at path."""

    def run(rows):
        cache = own_cache(path)[1]
        for key, text in rows:
            yield key, np.frombuffer(cache.encode_bytes(text or ""), dtype="<u4").astype("i4")

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>", rows=200)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text) for arrays of ids; null ids give an empty text."""

    def run(rows):
        bpe = own_cache(path)[0]
        for key, ids in rows:
            yield key, bpe.decode(ids or ())

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_rows(encoded.select(id_col, ids_col), run, f"`{id_col}` {kind}, text string", rows=200)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each text in one pass: (id, n_tokens, ids_sha256, decoded_sha256, same boolean).

    The ids themselves are several times the input and are not kept; use encode_texts for them.
    """

    def run(rows):
        bpe, cache = own_cache(path)
        for key, text in rows:
            ids = np.frombuffer(cache.encode_bytes(text or ""), dtype="<u4").tolist()
            back = bpe.decode(ids)
            yield key, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, F.col(text_col)), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")
