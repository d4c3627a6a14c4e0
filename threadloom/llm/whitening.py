"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the count, the mean and the spectrum (eigenvalues and eigenvectors) of the scatter of its vectors,
and takes in one vector after the other as a centred rank-one update: the new eigenvalues are the roots of a secular
equation, one between each two old ones, after entries that cannot move are deflated. Spectra of partitions are combined
in a tree, one update per eigenvector of the smaller side and one for the distance of the means. At the end one pass
over all vectors projects their exact covariance onto the combined eigenvectors, and the small projected problem is
solved (Rayleigh-Ritz), so the result is that of the whole covariance to double precision.

Components are numbered by falling eigenvalue. Only spectra, d * d numbers for each length d of vectors, reach the driver.

Defined results: rows whose vector is null, empty or holds null or non-finite entries are dropped; vectors of each length are
fitted apart. Rows with equal or null ids all count and are all returned. A component whose eigenvalue is zero but for
rounding has a null `whitened`, and no part in `identity_error`, which is null where no component is left; `explained` is
null where all vectors are equal. A `deviation` beyond the range of a long is null; integers beyond 2^62 count as that.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.llm.common import store

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
# Spectra combined by one task of a round.
FAN = 8
# Roots of the secular equation need no more: the vectors stay orthogonal at any precision, and the last pass refines.
TOLERANCE = 1e-11
STEPS = 40

_EPS = np.finfo(float).eps
_STATE = "dim int, part int, n long, sums array<decimal(38,0)>, a array<double>, b array<double>"
_ARROW = pa.schema([
    ("dim", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))),
    ("a", pa.list_(pa.float64())), ("b", pa.list_(pa.float64())),
])


def _rotate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, active: list[int], least: float) -> list[int]:
    """Turn pairs of nearly equal eigenvalues so that one of the two has no share in the update; the indexes left."""
    left, held = [], active[0]
    for j in active[1:]:
        r = np.hypot(z[held], z[j])
        c, s = z[j] / r, z[held] / r
        if (values[j] - values[held]) * abs(c * s) > least:
            left.append(held)
        else:
            one, two = vectors[:, held].copy(), vectors[:, j].copy()
            vectors[:, held], vectors[:, j] = c * one - s * two, s * one + c * two
            low, high = values[held], values[j]
            values[held], values[j] = low * c * c + high * s * s, low * s * s + high * c * c
            z[held], z[j] = 0.0, r
        held = j
    return [*left, held]


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - root)) = 0, one above each of the rising poles.

    Returns (pole the root is counted from, distance to it), since distances to poles are needed to full precision.
    """
    k = len(poles)
    rows = np.arange(k)
    if k == 1:
        return rows, weights.copy()
    gaps = np.append(np.diff(poles), weights.sum())
    # The other pole of the model: the one above, and for the last root the one below.
    other = np.append(rows[1:], k - 2)
    middle = poles + gaps / 2
    terms = weights / (poles - middle[:, None])
    at_middle = 1 + terms.sum(axis=1)
    lower_side = at_middle > 0
    lower_side[-1] = True
    base = np.where(lower_side, rows, other)
    apart = poles - poles[base][:, None]  # one row per root
    inner = lower_side[:-1]
    low, high = np.where(lower_side, 0.0, -gaps / 2), np.where(lower_side, gaps / 2, 0.0)
    if at_middle[-1] < 0:
        low[-1], high[-1] = gaps[-1] / 2, gaps[-1]
    with np.errstate(all="ignore"):
        # Start from the two poles around each root, all others as they are in the middle.
        rest = (at_middle - terms[rows, rows] - terms[rows, other])[:-1]
        own, above, gap = weights[:-1], weights[1:], gaps[:-1]
        a = np.where(inner, rest * gap + own + above, rest * gap - own - above)
        b = np.where(inner, own, above) * gap
        root = np.sqrt(np.maximum(a * a - np.where(inner, 4, -4) * b * rest, 0))
        up = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * rest))
        down = np.where(a < 0, 2 * b / (a - root), -(a + root) / (2 * rest))
        t = np.append(np.where(inner, up, down), low[-1])
    t = np.where((t > low) & (t < high), t, (low + high) / 2)
    for _ in range(STEPS):
        to_poles = apart - t[:, None]
        terms = weights / to_poles
        value = 1 + terms.sum(axis=1)
        positive = value > 0
        high, low = np.where(positive, t, high), np.where(positive, low, t)
        done = np.abs(value) <= TOLERANCE * (1 + np.abs(terms).sum(axis=1))
        if done.all():
            break
        slopes = terms / to_poles
        total = slopes.sum(axis=1)
        # The nearer pole keeps its weight, the other one takes the slope of all the rest.
        near, far = to_poles[rows, rows], to_poles[rows, other]
        kept = np.where(lower_side, slopes[rows, rows], slopes[rows, other])
        one, two = np.where(lower_side, near, far), np.where(lower_side, far, near)
        c = value - two * total - (one - two) * kept
        a = (near + far) * value - near * far * total
        b = near * far * value
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        with np.errstate(all="ignore"):
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = (a[-1] + root[-1]) / (2 * c[-1]) if a[-1] >= 0 else 2 * b[-1] / (a[-1] - root[-1])
        new = t + step
        t = np.where(done, t, np.where((new >= low) & (new <= high), new, (low + high) / 2))
    return base, t


def rank_one(values: np.ndarray, vectors: np.ndarray, u: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of vectors * diag(values) * vectors' + rho * u * u', for rho >= 0 and rising values."""
    z = vectors.T @ u
    size = float(np.sqrt(z @ z))
    strength = rho * size * size
    if not strength > 0:
        return values, vectors
    z /= size
    least = 8 * _EPS * max(values[-1], strength)
    active = np.flatnonzero(strength * np.abs(z) > least)
    if not len(active):
        return values, vectors
    gaps, near = np.diff(values[active]), z[active]
    squares = near * near
    if (gaps * np.abs(near[:-1] * near[1:]) <= least * (squares[:-1] + squares[1:])).any():
        values, vectors = values.copy(), vectors.copy()
        active = np.array(_rotate_equal(values, vectors, z, active.tolist(), least))
        order = np.argsort(values[active], kind="stable")
        active = active[order]
    poles, near = values[active], z[active]
    base, t = secular_roots(poles, strength * near * near)
    over = t - (poles[:, None] - poles[base])  # root minus pole, one column per root
    apart = poles - poles[:, None]
    np.fill_diagonal(apart, 1.0)
    # The update for which these roots are exact: its vectors are orthogonal however precise the roots are.
    exact = np.sqrt(np.abs((over / apart).prod(axis=1))) * np.sign(near)
    turned = exact[:, None] / over
    turned /= np.sqrt((turned * turned).sum(axis=0))
    values, vectors = values.copy(), vectors.copy()
    values[active] = poles[base] + t
    vectors[:, active] = vectors[:, active] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums and spectrum of the scatter about the mean of integer vectors."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
        self.n, self.sums, self.values, self.vectors = n, sums, values, vectors

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, [0] * dim, np.zeros(dim), np.eye(dim))

    def take(self, block: np.ndarray) -> Spectrum:
        """Takes in the rows of a block of integers, one by one; the mean is kept relative to its first row."""
        top = int(np.abs(block).max(initial=0))
        origin = block[0]
        mean = np.array([(s - self.n * o) / self.n if self.n else 0.0 for s, o in zip(self.sums, origin.tolist())])
        rows = (block - origin).astype(float) if top < 2**62 else block.astype(float) - origin.astype(float)
        for x in rows:
            off = x - mean
            self.values, self.vectors = rank_one(self.values, self.vectors, off, self.n / (self.n + 1))
            self.n += 1
            mean = mean + off / self.n
        kind = np.int64 if top * len(block) < 2**62 else object
        self.sums = [a + int(b) for a, b in zip(self.sums, block.sum(axis=0, dtype=kind))]
        return self

    def combined(self, other: Spectrum) -> Spectrum:
        """With the vectors of other taken in by rank-one updates along its eigenvectors and between the means."""
        big, small = (self, other) if self.n >= other.n else (other, self)
        values, vectors = big.values, big.vectors
        for value, vector in zip(small.values, small.vectors.T):
            if value > 0:
                values, vectors = rank_one(values, vectors, vector, float(value))
        n = big.n + small.n
        off = np.array([(small.n * a - big.n * b) / (big.n * small.n) for a, b in zip(big.sums, small.sums)])
        values, vectors = rank_one(values, vectors, off, big.n * small.n / n)
        return Spectrum(n, [a + b for a, b in zip(big.sums, small.sums)], values, vectors)

    def numerators(self, block: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: longs, or Python integers where they need more."""
        top = max([int(np.abs(block).max(initial=0)) * self.n, *map(abs, self.sums)])
        kind = np.int64 if top < 2**61 else object
        return block.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, block: np.ndarray) -> np.ndarray:
        return (self.numerators(block) / self.n).astype(float)

    def deviations(self, block: np.ndarray) -> list[int | None]:
        parts = self.numerators(block)
        if parts.dtype == object or int(np.abs(parts).max(initial=0)) ** 2 * parts.shape[1] >= 2**63:
            return [v if v < 2**63 else None for v in (sum(int(c) ** 2 for c in row) for row in parts)]
        return (parts * parts).sum(axis=1).tolist()


def _integers(lists: pa.Array, scale: int, shift: int) -> np.ndarray:
    """Rows of one length as integers: floor(scale * c) + shift."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    return np.floor(np.clip(flat * scale, -(2.0**62), 2.0**62)).astype(np.int64) + shift


def _by_length(batch: pa.RecordBatch) -> Iterable[tuple[int, pa.RecordBatch]]:
    lengths = batch.column("dim").to_numpy()
    if len(lengths) and (lengths == lengths[0]).all():
        yield int(lengths[0]), batch
        return
    for dim in np.unique(lengths).tolist():
        yield dim, batch.take(pa.array(np.flatnonzero(lengths == dim)))


def _state(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _payload(s: Spectrum) -> tuple:
    return s.n, [Decimal(v) for v in s.sums], s.values.tolist(), s.vectors.ravel().tolist()


def _spectrum(row) -> Spectrum:
    values = np.array(row["a"])
    return Spectrum(row["n"], [int(v) for v in row["sums"]], values, np.array(row["b"]).reshape(len(values), -1))


def _merge_spectra(rows: list[dict]) -> tuple:
    whole = _spectrum(rows[0])
    for row in rows[1:]:
        whole = whole.combined(_spectrum(row))
    return _payload(whole)


def _merge_sums(rows: list[dict]) -> tuple:
    return sum(r["n"] for r in rows), [], [], np.sum([r["b"] for r in rows], axis=0).tolist()


def _moments(n: int, mean: np.ndarray, products: np.ndarray, m: int, other_mean: np.ndarray, other: np.ndarray) -> tuple:
    """Count, mean and centred products of two sets together."""
    off = other_mean - mean
    return n + m, mean + off * (m / (n + m)), products + other + np.outer(off, off) * (n * m / (n + m))


def _merge_moments(rows: list[dict]) -> tuple:
    n, mean, products = 0, None, None
    for r in rows:
        a = np.array(r["a"])
        b = np.array(r["b"]).reshape(len(a), len(a))
        n, mean, products = (r["n"], a, b) if mean is None else _moments(n, mean, products, r["n"], a, b)
    return n, [], mean.tolist(), products.ravel().tolist()


def _combined(spark: SparkSession, parts: DataFrame, label: str, merge: Callable[[list[dict]], tuple]) -> list[dict]:
    """One state per length, from the states of partitions, merged FAN at a time."""
    parts = store(parts, label)
    last = parts.agg(F.max("part")).first()[0] or 0

    def together(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        return pa.Table.from_batches([_state([(rows[0]["dim"], key[1].as_py(), *merge(rows))])])

    while last:
        last //= FAN
        parts = parts.withColumn("up", F.floor(F.col("part") / FAN).cast("int")).groupBy("dim", "up").applyInArrow(together, _STATE)
    return [r.asDict() for r in parts.collect()]


def _fold(valid: DataFrame, scale: int, shift: int, begin: Callable, take: Callable, end: Callable) -> DataFrame:
    """A state per partition and length: state = take(dim, begin or state, integers) over all blocks, then end(dim, state)."""

    def run(batches):
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            for dim, rows in _by_length(batch):
                held[dim] = take(dim, held[dim] if dim in held else begin(dim), _integers(rows.column("v"), scale, shift))
        if held:
            yield _state([(dim, part, *end(dim, s)) for dim, s in held.items()])

    return valid.select("dim", "v").mapInArrow(run, _STATE)


def fit_spectra(valid: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> dict[int, Spectrum]:
    """The refined spectrum of the covariance of all vectors of each length, by falling eigenvalue."""
    spark = valid.sparkSession

    fitted = _fold(valid, scale, shift, Spectrum.empty, lambda dim, held, block: held.take(block), lambda dim, s: _payload(s))
    spectra = {r["dim"]: _spectrum(r) for r in _combined(spark, fitted, "spectra", _merge_spectra)}
    for s in spectra.values():
        s.vectors = np.linalg.qr(s.vectors)[0]

    def add(dim, held, block):
        turned = spectra[dim].centred(block) @ spectra[dim].vectors
        return held + turned.T @ turned

    projected = _fold(valid, scale, shift, lambda dim: np.zeros((dim, dim)), add, lambda dim, h: (0, [], [], h.ravel().tolist()))
    for r in _combined(spark, projected, "projected", _merge_sums):
        s = spectra[r["dim"]]
        square = np.array(r["b"]).reshape(r["dim"], -1) / s.n
        values, turn = np.linalg.eigh((square + square.T) / 2)
        s.values, s.vectors = np.maximum(values[::-1], 0), (s.vectors @ turn)[:, ::-1]
    return spectra


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, v array<double>) of rows with a vector of finite entries."""
    v = F.col("v")
    picked = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return picked.where(v.isNotNull() & (F.size(v) > 0) & finite).select("id", F.size("v").alias("dim"), "v")


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each vector and leading component."""
    spark = vectors.sparkSession
    valid = valid_vectors(vectors, id_col, vector_col)
    spectra = fit_spectra(valid, scale, shift)
    tools = {}
    for dim, s in spectra.items():
        k = min(components, dim)
        values = s.values[:k]
        real = values > dim * _EPS * s.values[0]
        weights = np.where(real, 1 / np.sqrt(np.where(real, values, 1.0)), 0.0)
        trace = s.values.sum()
        tools[dim] = (s, s.vectors[:, :k] * weights, real, (values / trace).tolist() if trace > 0 else [None] * k)

    def add(dim, held, block):
        s, matrix, real, _ = tools[dim]
        white = (s.centred(block) @ matrix)[:, real]
        mean = white.mean(axis=0)
        off = white - mean
        found = len(white), mean, off.T @ off
        return found if held is None else _moments(*held, *found)

    moments = _fold(valid, scale, shift, lambda dim: None, add, lambda dim, h: (h[0], [], h[1].tolist(), h[2].ravel().tolist()))
    errors = {}
    for r in _combined(spark, moments, "moments", _merge_moments):
        k = len(r["a"])
        errors[r["dim"]] = float(np.abs(np.array(r["b"]).reshape(k, k) / r["n"] - np.eye(k)).max()) if k else None

    kind = valid.schema["id"].dataType.simpleString()

    def emit(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                for dim, rows in _by_length(batch.slice(start, 2000)):
                    s, matrix, real, explained = tools[dim]
                    block = _integers(rows.column("v"), scale, shift)
                    n, k = len(block), len(real)
                    white = pa.array((s.centred(block) @ matrix).ravel(), mask=np.tile(~real, n))
                    place = pa.array(np.repeat(np.arange(n), k))
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("id").take(place), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, s.n)),
                            pa.array(s.deviations(block), pa.int64()).take(place), white, pa.array(explained * n, pa.float64()),
                            pa.array([errors[dim]] * (n * k), pa.float64()),
                        ],
                        names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                    )

    return valid.mapInArrow(emit, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
