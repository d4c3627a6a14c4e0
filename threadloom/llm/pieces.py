"""SentencePiece models of the merge type: exact encoding by backtracking, and decoding.

The longest vocabulary match at a position comes from an Aho-Corasick automaton. A token may follow another when merging
the symbols of both again, by the merge order (greater score first, then further left), gives just these two; a sequence
in which all neighbours pass is the encoding, and each prefix of a text has one such sequence at most. So the search goes
on with the longest match that fits the last token, takes the next shorter one where it does not, and steps back where
none is left; a position that was left so is marked in a bitfield and never entered again.

Where no piece holds two characters side by side, no merge crosses between them, and a text may be cut there. Spaces and
newlines are such places in the usual vocabularies; this is read from the vocabulary, not assumed.

The input is any table with a text column; its other columns, whatever their names, are not read. A null text counts as
empty and gives the end id only. Repeated rows give repeated results; an empty table gives an empty one. Texts of any
length are encoded whole.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from operator import add

import ahocorasick
from pyspark.sql import DataFrame

from threadloom.llm.common import map_rows

SPACE = "▁"
# Encoded words, and verdicts on pairs, that a Python worker remembers; a full store is emptied, which changes no result.
REMEMBERED = 600_000
LONGEST_REMEMBERED = 64

NONE = float("-inf")
START = (1 << 31) - 1

# Kinds of pieces and numbers of fields in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALISER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, SPACE_AS_SUFFIX, END_ID, UNKNOWN_SURFACE = 3, 35, 24, 42, 44
NORMALISER_NAME, CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 1, 2, 3, 4, 5
MERGE_TYPE = 2


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message: integers, or bytes of all else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, message[at : at + size]
            at += size


class _Remembered(dict):
    """Joined ids of strings; a full store is emptied, and very long strings are not kept."""

    def __init__(self, pieces: MergePieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, text: str) -> str:
        found = self.find(text)
        if len(text) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = found
        return found


class _Parts(_Remembered):
    """Of strings as they stand."""

    def find(self, text: str) -> str:
        parts = self.pieces.parts(text)
        return " ".join(map(str, self.pieces.part_ids(text))) if len(parts) == 1 else " ".join([self[p] for p in parts])


class _Words(_Remembered):
    """Of words with a space before them."""

    def find(self, word: str) -> str:
        parts = self.pieces.parts(SPACE + word)
        return " ".join(map(str, self.pieces.part_ids(parts[0]))) if len(parts) == 1 else " ".join([self.head(parts[0]), *[self.pieces.bare[p] for p in parts[1:]]])

    def head(self, part: str) -> str:
        return self[part[1:]] if len(part) > 1 else self.pieces.bare[part]


class MergePieces:
    """A merge-type model: ids and scores of pieces, the matching automaton, and remembered verdicts."""

    def __init__(self, path: str):
        with open(path, "rb") as handle:
            parts = list(_fields(handle.read()))
        trainer = dict(f for n, v in parts if n == TRAINER for f in _fields(v))
        normaliser = dict(f for n, v in parts if n == NORMALISER for f in _fields(v))
        rows = [dict(_fields(v)) for n, v in parts if n == PIECES]
        kinds = [r.get(3, NORMAL) for r in rows]
        usual = trainer.get(MODEL_TYPE) == MERGE_TYPE and not trainer.get(SPACE_AS_SUFFIX) and USER_DEFINED not in kinds and UNUSED not in kinds
        plain = not normaliser.get(CHARACTER_MAP) and not normaliser.get(REMOVE_SPACES, 1) and normaliser.get(ESCAPE_SPACES, 1)
        if not (usual and plain and trainer.get(BYTE_FALLBACK)):
            raise ValueError("only merge-type models with byte fallback, without a character map and without own symbols, are read")
        self.prefix = SPACE if normaliser.get(DUMMY_PREFIX, 1) else ""
        self.end = trainer.get(END_ID, 2)
        self.strings = [r[1].decode() for r in rows]
        self.scores = [struct.unpack("<f", r[2])[0] if 2 in r else 0.0 for r in rows]
        self.ids = {s: i for i, (s, kind) in enumerate(zip(self.strings, kinds)) if kind == NORMAL}
        self.score = {s: self.scores[i] for s, i in self.ids.items()}.get
        self.lengths = [len(s) for s in self.strings]
        self.byte_ids = [i for i, kind in enumerate(kinds) if kind == BYTE]
        self.byte_ids.sort(key=lambda i: int(self.strings[i][3:5], 16))
        # Per piece the longest piece that is a proper prefix of it.
        self.shorter = {i: next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ids), None) for s, i in self.ids.items()}
        self.reach = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.inside = {s[j : j + 2] for s in self.ids for j in range(len(s) - 1)}
        self.cut_words = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.inside)
        self.cut_lines = not any("\n" in pair for pair in self.inside)
        self.pairs: dict[int, bool] = {}
        self.bare = _Parts(self)
        self.spaced = _Words(self)
        self.newline = " ".join(map(str, self.part_ids("\n")))
        special = str(trainer.get(UNKNOWN_SURFACE, b" \xe2\x81\x87 "), "utf-8").encode()
        surfaces = {NORMAL: lambda s: s.replace(SPACE, " ").encode(), BYTE: lambda s: bytes([int(s[3:5], 16)]), UNKNOWN: lambda s: special, CONTROL: lambda s: b""}
        self.surfaces = {str(i): surfaces[kind](s) for i, (s, kind) in enumerate(zip(self.strings, kinds))}
        self.silent = {str(i) for i, kind in enumerate(kinds) if kind == CONTROL}
        self.bytes = {str(i) for i in self.byte_ids}
        self.opening = {str(i) for s, i in self.ids.items() if s.startswith(SPACE)}

    def merge(self, text: str) -> list[str]:
        """Symbols left when the best neighbours, greatest score and then furthest left, are merged until none is a piece."""
        symbols, score = list(text), self.score
        gains = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while gains and (best := max(gains)) != NONE:
            at = gains.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            del gains[at]
            if at:
                gains[at - 1] = score(symbols[at - 1] + symbols[at], NONE)
            if at < len(gains):
                gains[at] = score(symbols[at] + symbols[at + 1], NONE)
        return symbols

    def fits(self, last: int, token: int) -> bool:
        """True when token may stand after `last` (START: at the start)."""
        key = last << 32 | token
        if (found := self.pairs.get(key)) is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            wanted = [self.strings[i] for i in (last, token) if i != START]
            found = self.pairs[key] = self.merge("".join(wanted)) == wanted
        return found

    def longest(self, text: str, at: int) -> int:
        """The longest piece at a position; every character of text is a piece."""
        return next(self.automaton.iter_long(text[at : at + self.reach]))[1]

    def search(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        fits, lengths = self.fits, self.lengths
        # Longest matches one after the other, as far as each fits the one before it.
        out: list[int] = []
        at, last = 0, START
        for end, token in self.automaton.iter_long(text):
            if not fits(last, token):
                break
            out.append(token)
            at, last = end + 1, token
        if at == len(text):
            return out
        failed = bytearray(len(text) // 8 + 1)
        while True:
            last = out[-1] if out else START
            while token is not None:
                end = at + lengths[token]
                if not failed[end >> 3] >> (end & 7) & 1 and fits(last, token):
                    break
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                if end == len(text):
                    return out
                at, token = end, self.longest(text, end)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= lengths[token]
                token = self.shorter[token]

    def part_ids(self, text: str) -> list[int]:
        """Ids of a part across which pieces may span, or of one character; one that is no piece becomes its bytes."""
        return self.search(text) if text[0] in self.ids else [self.byte_ids[b] for b in text.encode()]

    def parts(self, text: str) -> list[str]:
        """text cut wherever no piece spans two characters."""
        inside = self.inside
        cuts = [i for i, pair in enumerate(map(add, text, text[1:]), 1) if pair not in inside]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])] if text else []

    def encode_joined(self, text: str, end: bool = True) -> str:
        """Decimal ids of text, joined by spaces, with the end id if asked for."""
        out: list[str] = []
        if text and self.cut_lines and self.cut_words and self.prefix and SPACE not in text:
            for i, line in enumerate(text.split("\n")):
                words = line.split(" ")
                if i:
                    out.append(self.newline)
                if "" in words:  # spaces side by side, or at an end
                    out += [self.bare[part] for part in self.parts((SPACE if not i else "") + line.replace(" ", SPACE))]
                else:
                    out.append(self.bare[words[0]] if i else self.spaced[words[0]])
                    out += map(self.spaced.__getitem__, words[1:])
        elif text:
            out = [self.bare[part] for part in self.parts(self.prefix + text.replace(" ", SPACE))]
        return " ".join([*out, str(self.end)] if end else out)

    def encode(self, text: str, end: bool = False) -> list[int]:
        return [int(i) for i in self.encode_joined(text, end).split()]

    def decode(self, ids: list[str]) -> str:
        """Text of decimal ids: spaces for their marks but for the one put before the text; bytes that form no character become U+FFFD."""
        first = next((i for i in ids if i not in self.silent), None)
        try:
            text = b"".join(map(self.surfaces.__getitem__, ids)).decode() if self.silent.isdisjoint(ids[:-1]) else self._decode_runs(ids)
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        return text[1:] if self.prefix and first in self.opening else text

    def _decode_runs(self, ids: list[str]) -> str:
        """As decode, where a run of byte ids is no whole text: each byte that is no part of a character stands alone."""
        out, run = [], b""
        for i in [*ids, None]:
            if i in self.bytes:
                run += self.surfaces[i]
                continue
            while run:
                size = next((n for n in range(1, 5) if _is_character(run[:n])), 0)
                out.append(run[:size].decode() if size else "�")
                run = run[max(size, 1) :]
            if i is not None:
                out.append(self.surfaces[i].decode())
        return "".join(out)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def own_pieces(path: str) -> MergePieces:
    return MergePieces(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """Rows (id, ids array<int>) of every whole text with the model file at path."""

    def run(rows):
        pieces = own_pieces(path)
        for key, text in rows:
            yield key, pieces.encode(text or "", end)

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, ids array<int>", rows=200)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows (id, text) for arrays of ids; null ids give an empty text."""

    def run(rows):
        pieces = own_pieces(path)
        for key, ids in rows:
            yield key, pieces.decode([str(i) for i in ids or ()])

    kind = encoded.schema[id_col].dataType.simpleString()
    return map_rows(encoded.select(id_col, ids_col), run, f"`{id_col}` {kind}, text string", rows=200)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode with an end id and decode each text in one pass: (id, n_tokens, ids_sha256, decoded_sha256, same boolean)."""

    def run(rows):
        pieces = own_pieces(path)
        for key, text in rows:
            joined = pieces.encode_joined(text or "")
            ids = joined.split(" ")
            back = pieces.decode(ids)
            yield key, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean")
