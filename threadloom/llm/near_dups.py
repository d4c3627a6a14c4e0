"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

1. Each document becomes the set of its word shingles (64-bit hashes) and a signature of COORDINATES minima. Documents
   with equal sets are one node from here on, so groups of copies of any size cost one row.
2. Nodes are posted under their coordinate-value pairs. Two nodes with at least MATCHES equal coordinates share one of
   any COORDINATES - MATCHES + 1 of them; each node keeps that many of its rarest pairs (prefix merging). The long
   lists of frequent pairs are skipped: their collisions are counted on the signatures of the nodes that met before.
3. Nodes that met, directly or over others, form a cluster. A cluster is dealt into blocks of bounded weight and each
   pair of blocks is one group. A task counts collisions between its two blocks, takes pairs above the threshold whose
   set sizes allow the similarity, and confirms them on the full sets. It gives back only links that connect what was
   not connected within the task, so no list of pairs is ever formed, however large a group of near copies is.
4. Connected components of the links.

A pair of exactly the least similarity has fewer than MATCHES equal coordinates with a probability of about 3e-5.

Defined results: a null or empty text, or one of white space only, has no shingle and no link; a text of fewer words
than a shingle is one shingle; rows of equal sets are linked; repeated ids keep one row each, every row with the class of
its own text; a null id is a document like others but can't be a class id unless the whole class has none; an empty
table gives an empty result. Other columns are not read. Texts are used whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import keys_hint, lower_words, map_rows, store
from threadloom.llm.components import components

SHINGLE = 5
SIMILARITY = 75  # percent
COORDINATES = 48
MATCHES = 24
# Shingles that the documents of one block have together, about; 8 bytes each.
BLOCK_WEIGHT = 400_000
# Word hashes that a Python worker remembers.
REMEMBERED = 500_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


@lru_cache(maxsize=1)
def _hashes() -> _WordHashes:
    return _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words."""
    words = lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    hashed = np.array(list(map(_hashes().__getitem__, words)), np.uint64)
    n = len(words) - size + 1
    found = hashed[:n].copy()
    for i in range(1, size):
        found = _mixed(found) + hashed[i : i + n]
    return np.unique(_mixed(found))


@lru_cache(maxsize=4)
def _multipliers(coordinates: int) -> np.ndarray:
    return np.random.default_rng(10).integers(1, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The least value of each of `coordinates` hash functions over the set.

    All 64 bits are kept: the minima of a large set lie close to 0, so fewer bits would be equal by chance between
    unlike documents, and ever more often as the table grows.
    """
    factors = _multipliers(coordinates)
    least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[start : start + 2048, None] * factors).min(axis=0), out=least)
    return least.view(np.int64)


def _node(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) >> 1


def signed(docs: DataFrame, id_col: str, text_col: str, coordinates: int = COORDINATES) -> DataFrame:
    """(id, row, node, n_shingles, sig): node stands for the set, and is null when the set is empty; row hashes the text."""

    def run(rows):
        for key, row, text in rows:
            found = shingle_set(text)
            if len(found):
                yield key, row, _node(found), len(found), signature(found, coordinates)
            else:
                yield key, row, None, 0, None

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), text_col)
    return map_rows(source, run, f"id {kind}, row long, node long, n_shingles long, sig array<long>")


def prefix_postings(nodes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(token, node): each node under the rarest of its coordinate-value pairs that others have too."""
    tokens = nodes.select("node", F.posexplode("sig").alias("c", "v")).select("node", F.xxhash64("c", "v").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("freq")).where("freq > 1")
    own = Window.partitionBy("node")
    ranked = tokens.join(shared, "token").select(
        "node", "token",
        F.row_number().over(own.orderBy("freq", "token")).alias("place"),
        F.count("*").over(own).alias("n"),
    )
    # The pairs that no other node has come first in the prefix; they post nothing.
    return ranked.where(F.col("place") <= coordinates - matches + 1 - (coordinates - F.col("n"))).select("token", "node")


def clusters(postings: DataFrame) -> DataFrame:
    """(node, root) of nodes that met under a token, directly or over others."""
    least = postings.groupBy("token").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    links = postings.join(least.select("token", "first"), "token").where("node <> first")
    return components(links.select(F.col("node").alias("a"), F.col("first").alias("b")).distinct())


def block_pairs(members: DataFrame, weight: int = BLOCK_WEIGHT) -> DataFrame:
    """(node, n_shingles, root, one, two, block): each member once for every pair of blocks it takes part in."""
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n_shingles") / weight).cast("int").alias("blocks"))
    dealt = members.join(sizes, "root").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    other = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return other.select("node", "root", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block")


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def confirm_block(nodes, first, sigs, sets, matches: int, similarity: int) -> list[tuple[int, int]]:
    """Links (node, node) that connect what is similar within one group.

    first: whether a node is of the first block (both blocks are one when all are). Signatures are compared with all
    others at once; set sizes are exact, and intersections are counted on the whole sets.
    """
    n = len(nodes)
    size = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)])
    marked = np.zeros(flat.max() + 1, np.bool_)
    union, links = _Union(n), []
    same_block = bool(first.all())
    for i in np.flatnonzero(first):
        others = np.arange(i + 1, n) if same_block else np.flatnonzero(~first)
        if not len(others):
            continue
        small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        others = others[100 * small >= similarity * large]
        others = others[(sigs[others] == sigs[i]).sum(axis=1) >= matches]
        own = union.root(i)
        others = np.array([j for j in others if union.root(j) != own], np.int64)
        if not len(others):
            continue
        marked[flat[starts[i] : starts[i + 1]]] = True
        lengths = size[others]
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        places = np.repeat(starts[others] - offsets, lengths) + np.arange(lengths.sum())
        common = np.add.reduceat(marked[flat[places]].astype(np.int64), offsets)
        marked[flat[starts[i] : starts[i + 1]]] = False
        for j in others[100 * common >= similarity * (size[i] + lengths - common)]:
            if (a := union.root(i)) != (b := union.root(j)):
                union.up[max(a, b)] = min(a, b)
                links.append((int(nodes[i]), int(nodes[j])))
    return links


def confirmed_links(pairs: DataFrame, matches: int, similarity: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes = table.column("node").to_numpy()
        first = table.column("block").to_numpy() == table.column("one").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
        sigs = np.array(table.column("sig").to_pylist())
        links = confirm_block(nodes, first, sigs, sets, matches, similarity)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return pairs.groupBy("root", "one", "two").applyInArrow(run, "a long, b long")


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: int = SIMILARITY,
    coordinates: int = COORDINATES, matches: int = MATCHES, block_weight: int = BLOCK_WEIGHT,
) -> DataFrame:
    """(id, row, n_shingles, component_id, kept) per row; component_id is the smallest id that can be reached, row the
    hash of the text."""
    rows = store(signed(docs, id_col, text_col, coordinates), "signed")
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("least_id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"),
    )
    nodes = store(nodes, "nodes")
    met = clusters(store(prefix_postings(nodes, coordinates, matches), "postings"))
    members = store(nodes.join(met, "node").select("node", "n_shingles", "sig", "root", "least_id"), "members")

    wanted = members.select(F.col("least_id").alias("_wanted")).distinct()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = texts.join(keys_hint(wanted, members.count()), texts["_id"].eqNullSafe(F.col("_wanted")), "left_semi")

    def sets(found):
        for _, text in found:
            shingles = shingle_set(text)
            if len(shingles):
                yield _node(shingles), shingles.tobytes()

    full = map_rows(texts, sets, "node long, shingles binary", rows=200)
    full = full.groupBy("node").agg(F.first("shingles").alias("shingles"))
    full = store(members.select("node", "sig").join(full, "node"), "sets")
    pairs = block_pairs(members, block_weight).join(full, "node")
    links = store(confirmed_links(pairs, matches, similarity), "links")

    roots = components(links).select(F.col("node").alias("_node"), "root")
    classed = nodes.select("node", "least_id").join(roots, F.col("node") == F.col("_node"), "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    names = classed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = classed.join(names, "root").select("node", "component_id")
    result = rows.select("id", "row", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return result.select("id", "row", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row."""
    return classify(docs, id_col, text_col, **parameters).select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """One row of docs per class, the one of the smallest id, all columns as they are; of repeated rows one stays."""
    judged = store(classify(docs, id_col, text_col, **parameters), "classes")
    hashed = F.xxhash64(docs[text_col])

    def same(keys: DataFrame):
        return docs[id_col].eqNullSafe(keys["_id"]) & (hashed == keys["_row"])

    def keys(df: DataFrame) -> tuple[DataFrame, int]:
        df = store(df.select(F.col("id").alias("_id"), F.col("row").alias("_row")), "keys")
        return df, df.count()

    gone, n_gone = keys(judged.where("not kept").select("id", "row").distinct())
    again, n_again = keys(judged.where("kept and n_shingles > 0").groupBy("id", "row").agg(F.count("*").alias("n")).where("n > 1"))
    left = docs.join(keys_hint(gone, n_gone), same(gone), "left_anti")
    if not n_again:
        return left
    repeated = docs.join(keys_hint(again, n_again), same(again), "left_semi")
    once = repeated.withColumn("_once", F.xxhash64(text_col)).dropDuplicates([id_col, "_once"]).drop("_once")
    return left.join(keys_hint(again, n_again), same(again), "left_anti").unionByName(once)
