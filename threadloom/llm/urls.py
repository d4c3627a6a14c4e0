"""URL filters: fixed rules first, then an empirical-Bayes reputation of hosts, in DataFrame operations.

Outcomes of labelled pages (bad 1 or 0) are counted by host, hosts add up to registered domains, these to suffixes.
From the top down, the share of bad pages of a unit is drawn from a beta distribution around the posterior mean of the
unit above it. How far units stray from it gives the strength of the prior, by moments, once per level. A host is
blocked when the lower bound of its posterior share, mean minus Z standard deviations, exceeds BLOCK_ABOVE; hosts
without labelled pages have the posterior of their domain, unknown domains that of their suffix, and so on up.

Rules are a list of (action, host/path prefix): a rule fits its host and all subdomains if the path starts as it says;
of those that fit, the longest decides (of equally long ones, the first by text).

Defined results: a null url, or one without "://", has an empty host and path and the verdict of the overall prior;
labels with a null key or outcome count as missing; rows that repeat are counted and judged as often as they occur; an empty
table gives an empty result, without labels nothing is blocked by the method; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import store

BLOCK_ABOVE = 0.5
Z = 1.645
# Prior strengths are kept within these bounds, in pages.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0

# Public suffixes of two labels that registrations are made under; a longer list may be given.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")

_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOW)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*two_label), F.substring_index(host, ".", -3)).otherwise(two)


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, action) of the rule that decides, nulls if none fits. The list is configuration, not data."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def _strength(units: DataFrame) -> float:
    """Strength of the prior of a level, from n, bad and prior mean m of its units.

    Moments: the squared distance of a unit's share from m is m(1-m)(1/n + (n-1)/n / (strength+1)) on average.
    """
    n, m = F.col("n"), F.col("m")
    spread = F.pow(F.col("bad") / n - m, 2) * n
    sums = units.where("n > 0").agg(F.sum(spread), F.sum(m * (1 - m)), F.sum(m * (1 - m) * (n - 1)))
    seen, chance, most = (x or 0.0 for x in sums.first())
    rho = (seen - chance) / most if most > 0 else 0.0
    return round(min(max(1 / rho - 1, LEAST_STRENGTH), MOST_STRENGTH), 6) if rho > 0 else MOST_STRENGTH


LEVELS = ("suffix", "domain", "host")


def reputation(outcomes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """Posterior (a, b) of every suffix, domain and host of outcomes (host, bad 0/1), and overall.

    Counts are summed by host before anything else, so one host may own any share of the pages.
    """
    hosts = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = store(hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "bad"), "hosts")
    n, bad = (x or 0 for x in hosts.agg(F.sum("n"), F.sum("bad")).first())
    overall = (bad + 0.5, n - bad + 0.5)
    above, found = None, []
    for level, upper in zip(LEVELS, (None, "suffix", "domain")):
        units = hosts.groupBy(level, *([upper] if upper else [])).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if upper:
            units = units.join(above.select(upper, F.col("mean").alias("m")), upper)
        else:
            units = units.withColumn("m", F.lit(overall[0] / sum(overall)))
        k = F.lit(_strength(units))
        units = units.select(level, (F.col("bad") + k * F.col("m")).alias("a"), (F.col("n") - F.col("bad") + k * (1 - F.col("m"))).alias("b"))
        above = store(units.select(level, "a", "b", (F.col("a") / (F.col("a") + F.col("b"))).alias("mean")), f"reputation-{level}")
        found.append(above)
    return (*found, overall)


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    """Lower bound of a beta posterior's share, by its mean and standard deviation."""
    return a / (a + b) - z * F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...], id_col: str = "page_id", url_col: str = "url",
    label_id: str = "doc_id", bad: Column | None = None, block_above: float = BLOCK_ABOVE,
) -> DataFrame:
    """(id, host, path, rule, verdict, bound) per page. bad: a 0/1 expression over labels; 1 - quality if not given."""
    source = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    marks = labels.select(F.col(label_id).alias("_id"), (1 - F.col("quality") if bad is None else bad).cast("long").alias("bad")).where("_id is not null and bad in (0, 1)")
    # Pages without a host say nothing about any host; they get the overall prior.
    named_pages = source.where("host != ''").select("id", "host")
    outcomes = named_pages.join(marks, F.col("id") == F.col("_id")).select("host", "bad")
    suffixes, domains, hosts, overall = reputation(outcomes)
    bound = F.round(lower_bound(F.col("a"), F.col("b")), 9)
    levels = zip(LEVELS, (suffixes, domains, hosts))
    # Judged once per distinct host; pages then meet one short row each.
    named = source.select("host").distinct().select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    for level, table in levels:
        named = named.join(table.select(level, bound.alias(f"bound_{level}")), level, "left")
    bound_all = F.round(lower_bound(F.lit(overall[0]), F.lit(overall[1])), 9)
    judged = named.select(F.col("host").alias("_host"), F.coalesce("bound_host", "bound_domain", "bound_suffix", bound_all).alias("bound"))
    judged = judged.withColumn("bound", F.when(F.col("_host") == "", bound_all).otherwise(F.col("bound")))
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(action, F.when(F.col("bound") > block_above, "block").otherwise("allow"))
    joined = source.join(store(judged, "host-bounds"), F.col("host") == F.col("_host"), "left")
    return joined.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"), "bound")
