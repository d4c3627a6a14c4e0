"""Hard negatives by exact integer products of many candidates at once.

Components become integers, floor(scale * x). The candidates of a block are biased to be non-negative, and for each
component one wide integer holds those of all candidates in separated fields. An anchor multiplies each wide integer by
its own component once and adds up; the fields of the sum, wide enough for every partial sum, are the inner products of
the anchor with all candidates, plus known offsets. Nothing is rounded, whatever the size of the components.

Positives are found among rows of the anchor's label, negatives among all others, each by blocks of anchors against
blocks of rows: blocks give their best, the best of all blocks are returned. A negative is taken only while
low * positive_score <= 100 * negative_score <= high * positive_score. Rows of one label are dealt by their ids, so a
label of any size spreads over as many blocks as it needs.

Defined results: rows with a null id, a null label, a null vector, or any null or non-finite component take no part. Of
rows with one id, the one of least (label, vector) takes part. Vectors of different lengths are never compared. Ties go to
the smaller id. An anchor without positives, or a positive without negatives, gives no row; an empty table an empty result.
Integers beyond the range of a long count as its nearest end. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadloom.llm.common import store
from threadloom.sizing import broadcast_if_small

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
# Rows and anchors of a block, and candidates of one wide integer.
ROWS = 16_384
ANCHORS = 4_096
FIELDS = 2_048

_LONG = 2**63 - 1


class Packed:
    """Candidate vectors (rows of integers) as one wide integer per component and group of FIELDS candidates."""

    def __init__(self, rows: list[list[int]], reach: int, fields: int = FIELDS):
        """reach: the greatest absolute component of any anchor to come."""
        dim = len(rows[0])
        top = max((abs(x) for row in rows for x in row), default=0)
        self.n, self.bias = len(rows), top
        # A field holds sums from 0 to 2 * shift, shift being the greatest sum of biased products.
        self.shift = dim * 2 * top * reach
        self.width = next(w for w in (1, 2, 4, 8, (2 * self.shift).bit_length() // 8 + 1) if 2 * self.shift < 1 << (8 * w))
        self.groups = []
        for start in range(0, self.n, fields):
            part = rows[start : start + fields]
            wide = [int.from_bytes(self._bytes(column), "little") for column in zip(*part)]
            ones = int.from_bytes((1).to_bytes(self.width, "little") * len(part), "little")
            self.groups.append((len(part), wide, ones * self.shift))

    def _bytes(self, column: tuple[int, ...]) -> bytes:
        if self.width <= 8:
            return (np.array(column, dtype=np.int64) + self.bias).astype(f"<u{self.width}").tobytes()
        return b"".join((x + self.bias).to_bytes(self.width, "little") for x in column)

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Exact inner products of anchor with all candidates; beyond the range of a long, its nearest end."""
        offset = self.shift + self.bias * sum(anchor)
        found = []
        for size, wide, total in self.groups:
            for x, fields in zip(anchor, wide):
                if x:
                    total += x * fields
            raw = total.to_bytes(size * self.width, "little")
            if self.width <= 8 and 2 * self.shift <= _LONG:
                found.append(np.frombuffer(raw, f"<u{self.width}").astype(np.int64) - offset)
            else:
                exact = [int.from_bytes(raw[i : i + self.width], "little") - offset for i in range(0, len(raw), self.width)]
                found.append(np.array([max(-_LONG, min(_LONG, v)) for v in exact], dtype=np.int64))
        return np.concatenate(found)


def best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest allowed scores, ties by the smaller id."""
    places = np.flatnonzero(allowed)
    if len(places) > k:
        part = scores[places]
        places = places[part >= np.partition(part, -k)[-k]]
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _reach(rows: list[list[int]]) -> int:
    return max((abs(x) for row in rows for x in row), default=0)


def _pairs(table: DataFrame, asked: DataFrame, keys: list[str], every: int, rows: int, anchors: int) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors, each dealt into the pairs of blocks (rb, qb) of their keys; keys without anchors are left out."""
    counts = table.groupBy(*keys).agg(
        F.ceil(F.count("*") / rows).cast("int").alias("rbs"), F.ceil(F.count_if(F.col("id") % every == 0) / anchors).cast("int").alias("qbs")
    )
    counts = broadcast_if_small(store(counts.where("qbs > 0"), "blocks"))

    def own(n: str, salt: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    near = table.join(counts, keys).withColumn("rb", own("rbs", 1)).withColumn("qb", each("qbs"))
    # Aliased, since both sides come from one table.
    around = asked.select(*[F.col(c).alias(c) for c in asked.columns]).join(counts, keys).withColumn("qb", own("qbs", 2)).withColumn("rb", each("rbs"))
    return near.drop("rbs", "qbs"), around.drop("rbs", "qbs")


def _columns(table: pa.Table, *names: str) -> list[list]:
    return [table.column(n).to_pylist() for n in names]


def _sorted(table: pa.Table, *names: str) -> list[tuple]:
    return sorted(zip(*_columns(table, *names)), key=lambda r: r[0])


def valid_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, dim, label, x array<long>) of the rows that take part, one per id."""
    v = F.col("v")
    picked = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).alias("label"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    picked = picked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite)
    top = float(2**63)
    scaled = F.transform(v, lambda c: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), c * scale))).cast("long"))
    one = picked.groupBy("id").agg(F.min(F.struct("label", scaled.alias("x"))).alias("row"))
    return one.select("id", F.size("row.x").alias("dim"), "row.label", "row.x")


def mine(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100, scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, rows: int = ROWS, anchors: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each row whose id is divisible by `every`."""
    table = store(valid_rows(vectors, id_col, vector_col, label_col, scale), "vectors")
    asked = table.where(F.col("id") % every == 0)

    def same_label(_, left: pa.Table, right: pa.Table) -> pa.Table:
        candidates, wanted = _sorted(left, "id", "x"), _sorted(right, "id", "x")
        out = []
        if candidates and wanted:
            ids = np.array([r[0] for r in candidates])
            packed = Packed([r[1] for r in candidates], _reach([r[1] for r in wanted]))
            for anchor, x in wanted:
                scores = packed.scores(x)
                out += [(anchor, int(ids[p]), int(scores[p])) for p in best(scores, ids, ids != anchor, positives)]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["anchor_id", "positive_id", "positive_score"])

    near, around = _pairs(table, asked, ["dim", "label"], every, rows, anchors)
    keys = ["dim", "label", "rb", "qb"]
    found = near.groupBy(*keys).cogroup(around.groupBy(*keys)).applyInArrow(same_label, "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    chosen = store(found.withColumn("place", place).where(F.col("place") <= positives).drop("place"), "positives")

    limits = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_set("positive_score")).alias("limits"))
    bounded = store(asked.join(limits, "id"), "anchors")

    def other_labels(_, left: pa.Table, right: pa.Table) -> pa.Table:
        candidates, wanted = _sorted(left, "id", "label", "x"), _sorted(right, "id", "label", "x", "limits")
        out = []
        if candidates and wanted:
            ids, labels = np.array([r[0] for r in candidates]), np.array([r[1] for r in candidates])
            packed = Packed([r[2] for r in candidates], _reach([r[2] for r in wanted]))
            for anchor, label, x, limits in wanted:
                scores = packed.scores(x)
                other = labels != label
                for limit in limits:
                    # 100 * score is never formed, so nothing overflows.
                    allowed = other & (scores >= -(-low * limit // 100)) & (scores <= high * limit // 100)
                    out += [(anchor, limit, int(ids[p]), int(scores[p])) for p in best(scores, ids, allowed, negatives)]
        return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["anchor_id", "positive_score", "negative_id", "negative_score"])

    near, around = _pairs(table, bounded, ["dim"], every, rows, anchors)
    keys = ["dim", "rb", "qb"]
    found = near.groupBy(*keys).cogroup(around.groupBy(*keys)).applyInArrow(other_labels, "anchor_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    taken = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return chosen.join(taken, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
