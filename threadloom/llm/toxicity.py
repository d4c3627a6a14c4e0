"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes, distance-weighted votes.

Fitting. Terms are words of letters in lower case, and word starts of 4 to 6 letters, marked with *, which catch
compounds. Over all labelled rows, the documents of either label that hold a term are counted; terms whose counts
differ from chance by a G statistic of LEAST_G or more, in favour of either label, enter the vocabulary. All
labelled rows become vectors of tf-idf weights, (1 + ln tf) * ln((1 + N) / (1 + df)) with df over the labelled rows,
of unit length. Equal vectors become one example with the counts of both labels. The index holds at most MAX_EXAMPLES
distinct examples, the smallest by hash: the documented bound of the sample that is searched; counts and terms cover
all labelled rows. A held-out quarter of the labelled rows, by hash of the id, calibrates: votes are binned and the
share of label 1 per bin, made monotone, is the score.

Scoring. Examples are cut into blocks of BLOCK and the greatest weight of each term per block is kept. The sum over a
text's terms of weight times block maximum bounds the cosine of every example in a block. The blocks of the greatest
bounds are opened first, then all others whose bound reaches the K-th best cosine found, so the K nearest are exact. Votes weigh
neighbours by their cosine and by how many rows they stand for. A text without a term of the vocabulary has the share of label 1 among
such labelled rows as its score.

Defined results: null and empty texts are texts without terms; labels of null, other than 0 and 1, or without a
document count as missing; documents with contradicting labels count for both; without any label every score is 0;
repeated rows get equal scores; an empty table gives an empty result. Other columns are not read, and are carried by
`drop_toxic` whatever their names. Texts are used whole.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import keys_hint, map_rows, store

LEAST_G = 30.0
MAX_EXAMPLES = 5_000
BLOCK = 64
FIRST_BLOCKS = 3
K = 15
BINS = 20
THRESHOLD = 0.3
REMEMBERED = 20_000  # scores a worker keeps for texts of equal vectors
STARTS = (4, 5, 6)

_WORD = re.compile(r"[^\W\d_]+")


def terms_of(text: str | None) -> Counter:
    """Words and marked word starts of a whole text, with their counts."""
    words = Counter(_WORD.findall((text or "").lower()))
    found = Counter(words)
    for word, n in words.items():
        for size in STARTS:
            if len(word) > size:
                found[word[:size] + "*"] += n
    return found


def _known_terms(text: str | None, vocabulary: dict[str, int]) -> dict[int, int]:
    words = Counter(_WORD.findall((text or "").lower()))
    found: dict[int, int] = {}
    for word, n in words.items():
        if (i := vocabulary.get(word)) is not None:
            found[i] = found.get(i, 0) + n
        for size in STARTS:
            if len(word) > size and (i := vocabulary.get(word[:size] + "*")) is not None:
                found[i] = found.get(i, 0) + n
    return found


class ToxicModel:
    """Vocabulary, block-max index and calibration; the examples are bounded by MAX_EXAMPLES."""

    def __init__(self, terms: list[str], idf: list[float]):
        self.terms, self.idf = terms, np.array(idf)
        self.vocabulary = {t: i for i, t in enumerate(terms)}
        self.edges, self.shares, self.bare_share = np.array([]), np.array([0.0]), 0.0
        self.memory: dict[bytes, tuple] = {}
        self.index([], [], [], [])

    def __getstate__(self):
        return self.__dict__ | {"memory": {}}

    def vector(self, text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
        """Terms in order and their weights, of unit length; weights are rounded so that equal texts agree."""
        found = _known_terms(text, self.vocabulary)
        ids = sorted(found)
        weights = [(1 + math.log(found[i])) * float(self.idf[i]) for i in ids]
        norm = math.sqrt(sum(w * w for w in weights))
        return tuple(ids), tuple(round(w / norm, 6) for w in weights)

    def index(self, names, vectors, zeros, ones) -> None:
        """Build the block index over examples, in the order given."""
        self.names, self.zeros, self.ones = list(names), np.array(zeros, float), np.array(ones, float)
        n, t = len(self.names), len(self.terms)
        self.blocks = -(-n // BLOCK)
        sizes = [len(ids) for ids, _ in vectors]
        # Entries of all examples in a row: example, term and weight; a block is one stretch of them.
        self.example = np.repeat(np.arange(n), sizes)
        self.term = np.array([i for ids, _ in vectors for i in ids], np.int64)
        self.weight = np.array([w for _, weights in vectors for w in weights], float)
        self.starts = np.searchsorted(self.example, np.arange(self.blocks + 1) * BLOCK)
        # Greatest weight of a term in each block, rounded up to 32 bits.
        self.most = np.zeros((t, self.blocks), np.float32)
        up = np.nextafter(self.weight.astype(np.float32), np.float32(np.inf))
        np.maximum.at(self.most, (self.term, self.example // BLOCK), up)
        self.query = np.zeros(t)

    def nearest(self, ids, weights, k: int = K) -> list[tuple[int, float]]:
        """The k examples of greatest cosine above 0, exact, ties to the earlier example: (example, cosine)."""
        if not self.blocks:
            return []
        ids, weights = np.array(ids, np.int64), np.array(weights, float)
        bounds = weights @ self.most[ids]
        order = np.argsort(-bounds, kind="stable")
        self.query[ids] = weights
        best = self._best(self._open(np.sort(order[:FIRST_BLOCKS])), k)
        worst = best[-1][1] if len(best) == k else 0.0
        rest = order[FIRST_BLOCKS:]
        rest = rest[(bounds[rest] > 0) & (bounds[rest] >= worst - 1e-9)]
        if len(rest):
            best = self._best([*self._open(np.sort(rest)), (np.array([e for e, _ in best], np.int64), np.array([s for _, s in best]))], k)
        self.query[ids] = 0.0
        return best

    def _open(self, blocks) -> list[tuple[np.ndarray, np.ndarray]]:
        """(examples, cosines) of blocks in order, one pair for each run of neighbouring blocks."""
        found = []
        for run in np.split(blocks, np.flatnonzero(np.diff(blocks) > 1) + 1):
            part = slice(self.starts[run[0]], self.starts[run[-1] + 1])
            first = run[0] * BLOCK
            scores = np.bincount(self.example[part] - first, self.query[self.term[part]] * self.weight[part])
            found.append((np.arange(first, first + len(scores)), scores))
        return found

    @staticmethod
    def _best(found, k: int) -> list[tuple[int, float]]:
        examples, scores = (np.concatenate(x) for x in zip(*found))
        hits = scores > 0
        if len(scores) > k:
            hits &= scores >= np.partition(scores, -k)[-k] - 1e-8
        best = sorted(((round(s, 9), e) for s, e in zip(scores[hits].tolist(), examples[hits].tolist())), key=lambda x: (-x[0], x[1]))[:k]
        return [(e, s) for s, e in best]

    def vote(self, ids, weights, k: int = K) -> tuple[float, list[tuple[int, float]]]:
        """Share of label 1 among the nearest examples, weighted by cosine to the fourth power and the log of their rows."""
        near = self.nearest(ids, weights, k)
        total = positive = 0.0
        for e, cosine in near:
            rows = self.zeros[e] + self.ones[e]
            weight = cosine**4 * math.log1p(rows)
            total += weight
            positive += weight * self.ones[e] / rows
        return (positive / total if total else 0.0), near

    def calibrate(self, edges, shares, bare_share: float) -> None:
        self.edges, self.shares, self.bare_share = np.array(edges), np.array(shares), bare_share

    def score(self, text: str | None) -> tuple[float, list[tuple[object, float, float]]]:
        """Calibrated score, and the evidence: (name of the example, cosine, share of label 1) of up to five neighbours."""
        ids, weights = self.vector(text)
        if not ids:
            return self.bare_share, []
        # A digest, since the vectors of long texts take kilobytes each.
        key = hashlib.blake2b(array("q", ids).tobytes() + array("d", weights).tobytes(), digest_size=16).digest()
        found = self.memory.get(key)
        if found is None:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            vote, near = self.vote(ids, weights)
            score = float(self.shares[np.searchsorted(self.edges, vote, side="right")])
            evidence = [(self.names[e], s, float(self.ones[e] / (self.ones[e] + self.zeros[e]))) for e, s in near[:5]]
            found = self.memory[key] = (score, evidence)
        return found


def held_out(id_text: Column) -> Column:
    return F.crc32(id_text) % 4 == 2


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, text, label) of the documents with a label of 0 or 1; each row of docs once per distinct label."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).where("_id is not null and label in (0, 1)").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(keys_hint(marks, marks.count()), texts["id"] == marks["_id"]).select("id", "text", "label")


def _g(ones: int, zeros: int) -> Column:
    """G statistic of a term in columns `ones` and `zeros` of so many documents with and without label 1."""
    total = float(ones + zeros)

    def part(found: Column, row: Column, of: int) -> Column:
        return F.when(found > 0, 2 * found * F.log(found * total / (row * of))).otherwise(0.0)

    a, b = F.col("ones").cast("double"), F.col("zeros").cast("double")
    rest = F.lit(total) - a - b
    return part(a, a + b, ones) + part(b, a + b, zeros) + part(ones - a, rest, ones) + part(zeros - b, rest, zeros)


def fit(train: DataFrame) -> ToxicModel:
    """Model of labelled rows (id, text, label). Counts are summed per task and then over terms by shuffle; only the
    vocabulary, the bounded examples and bins come to the driver."""
    train = store(train, "labelled")

    def counts(rows):
        # Partial counts leave when there are too many terms for one task.
        zeros: Counter = Counter()
        ones: Counter = Counter()
        for _, text, label in rows:
            (ones if label else zeros).update(terms_of(text).keys())
            if len(zeros) + len(ones) > 400_000:
                yield from _both(zeros, ones)
                zeros.clear()
                ones.clear()
        yield from _both(zeros, ones)

    n = dict(train.groupBy("label").count().collect())
    n_zero, n_one = n.get(0, 0), n.get(1, 0)
    if not n_zero + n_one:
        return ToxicModel([], [])
    found = map_rows(train, counts, "term string, zeros long, ones long", rows=20_000).groupBy("term").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    top = found.withColumn("g", _g(n_one, n_zero)).where(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "term").collect()
    model = ToxicModel([r.term for r in top], [math.log((1 + n_one + n_zero) / (1 + r.ones + r.zeros)) for r in top])

    shared = train.sparkSession.sparkContext.broadcast(model)

    def vectors(rows):
        model = shared.value
        for key, text, label in rows:
            ids, weights = model.vector(text)
            yield str(key), label, zlib.crc32(str(key).encode()) % 4 == 1, list(ids), list(weights)

    seen = store(map_rows(train, vectors, "id string, label int, calibrates boolean, ids array<int>, weights array<double>"), "vectors")
    examples = seen.where("not calibrates and size(ids) > 0").groupBy("ids", "weights").agg(
        F.min("id").alias("id"), F.sum(1 - F.col("label")).alias("zeros"), F.sum("label").alias("ones")
    )
    examples = examples.orderBy(F.crc32("id"), "id").limit(MAX_EXAMPLES).collect()
    examples.sort(key=lambda r: (r.ids, r.weights))  # like examples share blocks, which keeps the bounds tight
    model.index([r.id for r in examples], [(r.ids, r.weights) for r in examples], [r.zeros for r in examples], [r.ones for r in examples])

    bare = seen.where("size(ids) = 0").agg(F.avg("label")).first()[0]
    indexed = train.sparkSession.sparkContext.broadcast(model)

    def votes(rows):
        model = indexed.value
        for ids, weights, label in rows:
            yield min(int(model.vote(ids, weights)[0] * BINS), BINS - 1), label

    binned = map_rows(seen.where("calibrates and size(ids) > 0").select("ids", "weights", "label"), votes, "bin int, label int")
    rows = {r.bin: (r.n, r.ones) for r in binned.groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    model.calibrate([b / BINS for b in range(1, BINS)], monotone([rows.get(b, (0, 0)) for b in range(BINS)]), float(bare or 0.0))
    return model


def _both(zeros: Counter, ones: Counter):
    for term in zeros.keys() | ones.keys():
        yield term, zeros[term], ones[term]


def monotone(bins: list[tuple[int, int]]) -> list[float]:
    """Shares of label 1 per bin that never fall (pooled neighbours), each pulled to the bin's middle by two rows."""
    pools: list[list[float]] = []
    for b, (n, ones) in enumerate(bins):
        pools.append([n + 2, ones + 2 * (b + 0.5) / len(bins), 1])
        while len(pools) > 1 and pools[-2][1] / pools[-2][0] > pools[-1][1] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return [ones / n for n, ones, width in pools for _ in range(int(width))]


def score_documents(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence) per row; evidence: array of (example, cosine, share of label 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        model = shared.value
        for key, text in rows:
            score, evidence = model.score(text)
            yield key, score, [{"example": e, "cosine": c, "share": s} for e, c, s in evidence]

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, score double, evidence array<struct<example:string,cosine:double,share:double>>"
    return map_rows(docs.select(id_col, text_col), run, schema)


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs with a score below threshold, all columns as they are. Only texts go to Python, and only scores back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array([model.score(t.as_py())[0] for t in texts], pa.float64())

    return docs.where(score.asNondeterministic()(F.col(f"`{text_col}`")) < threshold)
