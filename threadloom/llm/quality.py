"""Quality rules: fixed base rules, then robust multivariate outliers, in DataFrame operations.

For each group of language and source, the minimum-covariance-determinant estimate of location and scatter is found by
concentration steps from a start at medians and median deviations: keep the share SUBSET of rows with the least
Mahalanobis distance, estimate again, repeat. Rows whose distance to the final estimate exceeds CUTOFF are rejected.

The vector holds logarithms of rates, in steps of 1/256. Sums of steps and of their products are whole numbers, so the
estimates do not depend on the order in which tasks finish. The least distances are found by counting rows per
logarithmic distance step, so no group is sorted or gathered and a group of any size only sends counts. Each variance
has a floor, FLOORS squared: statistics that are constant in a group (no symbols, no repeated lines) give no infinite distances.

Defined results: a null or empty text has no word and fails the base rules; languages and sources may be null and form
groups like others; groups of one row keep it; repeated rows count as often as they occur and share one verdict; an
empty table gives an empty result; other columns are carried by `keep_documents`, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions.binding import let
from threadloom.llm.common import keys_hint, store

MIN_WORDS = 50
MAX_REPEATED = 0.5
SUBSET = 0.75
STEPS = 3
# Squared Mahalanobis distance; the 0.999999 quantile for five normal statistics is 36.
CUTOFF = 45.0
# Least standard deviations, in the order of FEATURES: one repeated line in a short text stays within the cutoff.
FLOORS = (0.06, 0.5, 0.8, 0.8, 0.35)
FEATURES = ("length", "symbols", "lines", "repeats", "capitals")
GRID = 256
# Groups whose estimates (160 bytes each) may be copied to every executor.
BROADCAST_GROUPS = 50_000

_SPACE = r"[ \t\n\x0B\f\r]+"


def _repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more."""

    def count(hashes: Column) -> Column:
        some = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(some, let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered)).otherwise(0)

    def covered(order: Column) -> Column:
        twice = F.filter(
            order,
            lambda x, k: (F.get(order, k - 1)["h"] == x["h"]) | (F.get(order, k + 1)["h"] == x["h"]),
        )
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))), F.lit(0), lambda a, b: a + b
        ))

    windows = F.transform(F.slice(words, F.lit(1), F.size(words) - 2), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, let(windows, count)).otherwise(0)


def statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """keep columns and the statistics of each whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines (with a word), n_capitals."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]"))
    without = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(kept: Column) -> Column:
        return F.struct(F.size(kept).cast("long").alias("n_lines"), (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"))

    found = docs.select(
        *[F.col(c) for c in keep],
        let(F.filter(F.split(text, _SPACE), lambda w: w != ""), of_words).alias("_w"),
        let(lines, of_lines).alias("_l"),
        without(r"[#*$%&|<>]+").cast("long").alias("n_symbols"),
        without(r"\p{Lu}+").cast("long").alias("n_capitals"),
    )
    return found.select(
        *[F.col(c) for c in keep], "_w.n_words", "_w.word_chars", "n_symbols", "_l.n_dup_lines", "_w.n_repeat_words", "_l.n_lines", "n_capitals"
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _vector() -> list[Column]:
    rate = lambda n, of: F.log1p(100 * F.col(n) / F.greatest(F.col(of), F.lit(1)))
    values = [
        F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))),
        rate("n_symbols", "n_words"), rate("n_dup_lines", "n_lines"), rate("n_repeat_words", "n_words"), rate("n_capitals", "word_chars"),
    ]
    return [F.round(v * GRID).cast("long").alias(f) for v, f in zip(values, FEATURES)]


def chi2_cdf(p: int, x: float) -> float:
    """Distribution function of chi-squared with p degrees, by the series of the incomplete gamma function."""
    a, half = p / 2, x / 2
    term = total = math.exp(a * math.log(half) - half - math.lgamma(a + 1))
    for k in range(1, 500):
        term *= half / (a + k)
        total += term
    return total


def consistency(p: int, share: float) -> float:
    """Factor that makes the scatter of the nearest `share` of normal rows estimate that of all."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if middle == 0 or chi2_cdf(p, middle) < share else (low, middle)
    return share / chi2_cdf(p + 2, high)


def _cholesky(moments: DataFrame, keys: list[str], scale: float) -> DataFrame:
    """keys, mean `m_i` and lower factor `l_i_j` of the scatter, from n, sums `s_i` and products `p_i_j`, all in grid steps."""
    p = len(FEATURES)
    means = {f"m_{i}": F.col(f"s_{i}") / F.col("n") / GRID for i in range(p)}
    df = moments.select("*", *[v.alias(k) for k, v in means.items()])
    scatter = {}
    for i in range(p):
        for j in range(i + 1):
            value = (F.col(f"p_{i}_{j}") / F.col("n") / (GRID * GRID) - F.col(f"m_{i}") * F.col(f"m_{j}")) * scale
            scatter[f"c_{i}_{j}"] = value + FLOORS[i] ** 2 if i == j else value
    df = df.select(*keys, *means, *[v.alias(k) for k, v in scatter.items()])
    for j in range(p):
        done = lambda i, j=j: sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        df = df.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"c_{j}_{j}") - done(j), F.lit(FLOORS[j] ** 2 / 4))))
        df = df.withColumns({f"l_{i}_{j}": (F.col(f"c_{i}_{j}") - done(i)) / F.col(f"l_{j}_{j}") for i in range(j + 1, p)})
    return df.select(*keys, *means, *[f"l_{i}_{j}" for i in range(p) for j in range(i + 1)])


def _distance(rows: DataFrame) -> DataFrame:
    """rows with `d2`, the squared Mahalanobis distance, by forward substitution; the estimate's columns go."""
    p = len(FEATURES)
    df = rows
    for i in range(p):
        known = sum((F.col(f"l_{i}_{k}") * F.col(f"z_{k}") for k in range(i)), F.lit(0.0))
        df = df.withColumn(f"z_{i}", (F.col(FEATURES[i]) / GRID - F.col(f"m_{i}") - known) / F.col(f"l_{i}_{i}"))
    df = df.withColumn("d2", reduce(lambda a, b: a + b, [F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(p)]))
    extra = [f"m_{i}" for i in range(p)] + [f"z_{i}" for i in range(p)] + [f"l_{i}_{j}" for i in range(p) for j in range(i + 1)]
    return df.drop(*extra)


def _with_estimates(rows: DataFrame, estimates: DataFrame, groups: tuple[str, ...], n_groups: int) -> DataFrame:
    side = estimates.select(*[F.col(g).alias("_" + g) for g in groups], *[c for c in estimates.columns if c not in groups])
    side = F.broadcast(side) if n_groups <= BROADCAST_GROUPS else side
    same = reduce(lambda a, b: a & b, [rows[g].eqNullSafe(F.col("_" + g)) for g in groups])
    return rows.join(side, same, "left").drop(*["_" + g for g in groups])


def _moments(rows: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    p = len(FEATURES)
    sums = [F.sum(FEATURES[i]).alias(f"s_{i}") for i in range(p)]
    products = [F.sum((F.col(FEATURES[i]) * F.col(FEATURES[j])).cast("decimal(20,0)")).alias(f"p_{i}_{j}") for i in range(p) for j in range(i + 1)]
    found = rows.groupBy(*groups).agg(F.count("*").alias("n"), *sums, *products)
    return found.select(*groups, F.col("n").cast("double").alias("n"), *[F.col(c).cast("double").alias(c) for c in found.columns if c[:2] in ("s_", "p_")])


def estimates(rows: DataFrame, groups: tuple[str, ...], subset: float = SUBSET, steps: int = STEPS) -> tuple[DataFrame, int]:
    """Robust location and scatter per group, and the number of groups. rows: groups and FEATURES in grid steps.

    Values are whole steps within a bounded range, so the exact medians of the start hold a bounded number of values.
    """
    medians = rows.groupBy(*groups).agg(*[F.median(f).alias(f"c_{i}") for i, f in enumerate(FEATURES)])
    medians = store(medians, "medians")
    n_groups = medians.count()
    off = _with_estimates(rows, medians, groups, n_groups)
    deviations = off.groupBy(*groups).agg(
        *[F.first(f"c_{i}").alias(f"c_{i}") for i in range(len(FEATURES))],
        *[F.median(F.abs(F.col(f) - F.col(f"c_{i}"))).alias(f"d_{i}") for i, f in enumerate(FEATURES)],
    )
    spread = lambda i: F.col(f"d_{i}") * 1.4826 / GRID
    found = deviations.select(
        *groups, *[(F.col(f"c_{i}") / GRID).alias(f"m_{i}") for i in range(len(FEATURES))],
        *[(F.sqrt(spread(i) * spread(i) + FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i in range(len(FEATURES)) for j in range(i + 1)],
    )
    found = store(found, "estimates-0")
    scale = consistency(len(FEATURES), subset)
    for step in range(steps):
        placed = _distance(_with_estimates(rows, found, groups, n_groups)).withColumn("bin", F.floor(F.log1p("d2") * 64).cast("int"))
        counts = placed.groupBy(*groups, "bin").agg(F.count("*").alias("k"))
        group = Window.partitionBy(*groups)
        upto = counts.withColumns({"upto": F.sum("k").over(group.orderBy("bin")), "all": F.sum("k").over(group)})
        limits = upto.where(F.col("upto") >= subset * F.col("all")).groupBy(*groups).agg(F.min("bin").alias("limit"))
        limits = store(limits, f"limits-{step}")
        near = _with_estimates(placed, limits, groups, n_groups).where("bin <= limit")
        found = store(_cholesky(_moments(near, groups), list(groups), scale), f"estimates-{step + 1}")
    return found, n_groups


def judge_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF,
) -> DataFrame:
    """(id, row, groups, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept) per row.

    row is the hash of the text, for ids that occur more than once; distance is the squared Mahalanobis distance, null
    where the base rules fail. The group columns are returned as g_0, g_1 and so on.
    """
    names = tuple(f"g_{i}" for i in range(len(groups)))
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.col(text_col).alias("text"), *[F.col(g).alias(n) for g, n in zip(groups, names)])
    found = statistics(source, "text", ("id", "row", *names)).withColumn("base_failed", base_failed())
    found = store(found.select("*", *_vector()), "statistics")
    fit, n_groups = estimates(found.where("not base_failed").select(*names, *FEATURES), names)
    judged = _distance(_with_estimates(found, fit, names, n_groups))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    return judged.select(
        "id", "row", *names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", distance.alias("distance"),
        (~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= cutoff)).alias("kept"),
    )


def keep_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, ...] = ("lang", "source"), cutoff: float = CUTOFF,
) -> DataFrame:
    """The rows of docs that judge_quality keeps, all columns as they are."""
    judged = judge_quality(docs, id_col, text_col, groups, cutoff)
    names = [c for c in judged.columns if c.startswith("g_")]
    rejected = store(judged.where("not kept").select(*[F.col(c).alias("_" + c) for c in ("id", "row", *names)]).distinct(), "rejected")
    same = [docs[c].eqNullSafe(F.col(k)) for c, k in ((id_col, "_id"), *zip(groups, ["_" + n for n in names]))]
    same = reduce(lambda a, b: a & b, same, F.xxhash64(docs[text_col]) == F.col("_row"))
    return docs.join(keys_hint(rejected, 4 * rejected.count()), same, "left_anti")
