"""The most frequent runs of tokens of a text, counted for the texts of an Arrow batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from threadloom.functions.batches import joined, parts_of

TOKENS = 200_000  # counted together: the tokens of whole texts, as many as fit
KIND = pa.list_(pa.string())


def _plain(tokens: list[str | None] | None, sizes: tuple[int, ...], k: int) -> list[str] | None:
    """The same for one text of any tokens: two different runs may read the same."""
    if tokens is None:
        return None
    counts: dict[str, int] = {}
    for size in sizes:
        for i in range(len(tokens) - size + 1):
            run = [t for t in tokens[i : i + size] if t is not None]
            if run or size > 1:
                counts[" ".join(run)] = counts.get(" ".join(run), 0) + 1
    return sorted(counts, key=lambda run: -counts[run])[:k]


def top_of(batch: pa.Array, sizes: tuple[int, ...], k: int) -> pa.Array:
    flat = batch.flatten()
    if flat.null_count or pc.any(pc.match_substring(flat, " ")).as_py():
        return pa.array([_plain(tokens, sizes, k) for tokens in batch.to_pylist()], KIND)
    encoded = flat.dictionary_encode()
    codes, n_codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), max(len(encoded.dictionary), 1)
    lengths = pc.fill_null(batch.value_lengths(), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(batch)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(row))  # tokens from here to the end of the text

    rows, starts, counts, kinds = [], [], [], []
    for kind, size in enumerate(sizes):
        start = np.flatnonzero(left >= size)
        number, most = np.zeros(len(start), dtype=np.int64), 1
        for step in range(size):
            if most > 2**62 // n_codes:  # a very long text: number its runs anew, before they leave the type's range
                number = np.unique(number, return_inverse=True)[1].astype(np.int64)
                most = len(number)
            number, most = number * n_codes + codes[start + step], most * n_codes
        order = np.lexsort((number, row[start]))  # stable: equal runs of a text stay in their order
        r, g = row[start][order], number[order]
        first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (g[1:] != g[:-1]))) if len(r) else np.zeros(0, dtype=np.int64)
        rows.append(r[first])
        starts.append(start[order][first])
        counts.append(np.diff(np.append(first, len(r))))
        kinds.append(np.full(len(first), kind))
    r, start, count, kind = map(np.concatenate, (rows, starts, counts, kinds))
    order = np.lexsort((start, kind, -count, r))
    found = np.bincount(r, minlength=len(batch))
    rank = np.arange(len(r)) - np.repeat(np.cumsum(found) - found, found)
    best = order[rank < k]
    start, kind = start[best], kind[best]

    texts = pa.nulls(len(best), pa.string())
    for number, size in enumerate(sizes):
        own = kind == number
        words = [flat.take(pa.array(start[own] + step)) for step in range(size)]
        texts = pc.replace_with_mask(texts, pa.array(own), pc.binary_join_element_wise(*words, " ") if size > 1 else words[0])
    offsets = np.append(0, np.cumsum(np.minimum(found, max(k, 0)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), texts, mask=batch.is_null())


def top_runs(tokens: Column, sizes: tuple[int, ...], k: int = 10) -> Column:
    """The k most frequent runs of each of these numbers of tokens, joined by a space; NULL for NULL.

    Ties go to the smaller place in `sizes`, then to the run seen first. The same as text.top_counted over text.ngrams of each
    size in turn, which builds and sorts the text of every run; here runs are numbers, and only the k best become text.
    """

    @F.arrow_udf("array<string>")
    def top(batch: pa.Array) -> pa.Array:
        lengths = pc.fill_null(batch.value_lengths(), 0).to_numpy(zero_copy_only=False)
        return joined([top_of(batch.slice(start, n), sizes, k) for start, n in parts_of(lengths, TOKENS)], KIND)

    # Declared non-deterministic so that filters are not pushed below it with a second copy of the counting.
    return top.asNondeterministic()(tokens)
