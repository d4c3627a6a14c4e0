"""Hierarchical best-fit packing of token sequences.

Each task packs its own pieces best-fit. Bins that are nearly full leave, and so do those into which not even the
smallest bin fits; the others become items, are dealt anew to fewer tasks and packed again, until one task held what
was left or a round merged nothing. A task packs at most PER_TASK items at once, so its memory is bounded whatever the
input.

Defined results: a null or empty text is one piece that holds the end token only; a text of more than `limit` tokens is
cut into pieces of `limit`, the first of which takes the remainder; repeated rows are packed as often as they occur;
null ids are packed like others; an empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import math
import os
import zlib
from functools import lru_cache

from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.bpe import WordCache, byte_symbols
from threadloom.llm.common import map_rows, store

LIMIT = 1024
# A bin with at most this many free places is emitted as it is.
NEARLY_FULL = 8
# Items that one task packs together.
PER_TASK = 100_000


def best_fit(items: list[tuple[int, int]], limit: int) -> list[tuple[int, int, int, int]]:
    """(item, bin, offset, fill of the bin) for items (id, length), the longest first, each into the fullest bin it fits."""
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r is set when a bin has r free places
    fills: list[int] = []
    placed = []
    for item, length in sorted(items, key=lambda x: (-x[1], x[0])):
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            where = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            where, room = len(fills), limit
            fills.append(0)
        placed.append((item, where, fills[where]))
        fills[where] += length
        if left := room - length:
            by_room[left].append(where)
            rooms |= 1 << left
    return [(item, where, offset, fills[where]) for item, where, offset in placed]


def pack_round(items: DataFrame, limit: int, level: int, per_task: int = PER_TASK) -> DataFrame:
    """Best-fit within each task: (item, bin, offset, fill). Ids of bins are unique over tasks and levels."""

    def run(rows):
        base, count = (level << 56) | (TaskContext.get().partitionId() << 32), 0
        held: list[tuple[int, int]] = []

        def pack():
            nonlocal count
            most = -1
            for item, where, offset, fill in best_fit(held, limit):
                yield item, base + count + where, offset, fill
                most = max(most, where)
            count += most + 1
            held.clear()

        for row in rows:
            held.append(row)
            if len(held) >= per_task:
                yield from pack()
        yield from pack()

    return map_rows(items, run, "item long, bin long, offset long, fill long", rows=20_000)


def pack_items(items: DataFrame, limit: int = LIMIT, nearly_full: int = NEARLY_FULL, per_task: int = PER_TASK) -> DataFrame:
    """(item, sequence_id, offset) for items (item long, length long up to limit)."""
    placed = store(pack_round(items.select("item", "length"), limit, 1, per_task), "packing-1")
    result = placed.select("item", F.col("bin").alias("sequence_id"), "offset")
    under = _mergeable(_underfull(placed, limit - nearly_full), limit)
    left, level = under.count(), 1
    while left > 1:
        level += 1
        tasks = math.ceil(left / per_task)
        # Another deal in each round, so bins that never shared a task get to meet.
        dealt = under.repartition(tasks, F.xxhash64("item", F.lit(level))) if tasks > 1 else under.coalesce(1)
        placed = store(pack_round(dealt, limit, level, per_task), f"packing-{level}")
        moved = placed.select(F.col("item").alias("_bin"), F.col("bin").alias("_to"), F.col("offset").alias("_by"))
        result = result.join(moved, result.sequence_id == moved["_bin"], "left").select(
            "item",
            F.coalesce("_to", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("_by", F.lit(0))).alias("offset"),
        )
        if level % 4 == 0:  # the plan must not grow with the rounds
            result = store(result, f"packing-so-far-{level}")
        merged = placed.where("offset > 0").limit(1).count()
        if tasks == 1 or not merged:
            break
        under = _mergeable(_underfull(placed, limit - nearly_full), limit)
        left = under.count()
    return result


def _mergeable(under: DataFrame, limit: int) -> DataFrame:
    """Bins into which the smallest other bin still fits; the rest can merge with nothing and are final."""
    least = [r.length for r in under.select("length").orderBy("length").limit(2).collect()]
    if len(least) < 2:
        return under.limit(0)
    # The smallest bin itself needs the second smallest.
    return under.where((F.col("length") + least[0] <= limit) & F.lit(sum(least) <= limit))


def _underfull(placed: DataFrame, enough: int) -> DataFrame:
    """One item for each bin that is not nearly full."""
    first = placed.where((F.col("offset") == 0) & (F.col("fill") < enough))
    return first.select(F.col("bin").alias("item"), F.col("fill").alias("length"))


@lru_cache(maxsize=2)
def _library_cache(path: str) -> WordCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
    model, symbols = tokenizer.model, dict(enumerate(byte_symbols()))

    def letters(piece: str) -> list[int]:
        """Ids of a pre-token by the library's BPE model, which reads one symbol per byte."""
        return [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(symbols))]

    return WordCache(lambda text: tokenizer.encode(text, add_special_tokens=False).ids, letters, special)


def token_pieces(docs: DataFrame, path: str, end_id: int, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every whole text followed by end_id."""

    def run(rows):
        cache = _library_cache(path)
        end = end_id.to_bytes(4, "little")
        for key, text in rows:
            ids = cache.encode_bytes(text or "") + end
            n = len(ids) // 4
            start, length = 0, n % limit or limit
            piece = 0
            while start < n:
                yield key, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
                piece, start, length = piece + 1, start + length, limit

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 2, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text",
    nearly_full: int = NEARLY_FULL, per_task: int = PER_TASK,
) -> DataFrame:
    """Pieces of documents with their sequence: (id, piece, start, length, ids_crc32, sequence_id, offset)."""
    pieces = token_pieces(docs, path, end_id, limit, id_col, text_col)
    pieces = store(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    places = pack_items(pieces.select("item", "length"), limit, nearly_full, per_task)
    return pieces.join(places, "item").select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
