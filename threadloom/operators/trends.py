"""Mention trends, growth, co-occurrence and correlation."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from threadloom.functions.text import period_start
from threadloom.operators.merge import merge_columns
from threadloom.schemas import struct
from threadloom.sizing import broadcast_if_small
from threadloom.sources.buckets import BucketTable

# Words that mark a post as about work.
JOB_WORDS = ["hiring", "job", "career", "looking for", "position"]
EDGE_THRESHOLD = 0.05
# What the trends read of posts and of their analysis.
POST_COLUMNS = ["subreddit_id", "title", "score", "num_comments", "created_date"]
NAME_COLUMNS = ["tech_mentioned", "skills_mentioned"]


def as_date(day: str | datetime.date | Column) -> Column:
    return day if isinstance(day, Column) else F.lit(str(day)).cast("date")


def mentions(posts: DataFrame, analysis: DataFrame, names: str = "tech_mentioned", *columns: str) -> DataFrame:
    """One row per post and mentioned name, as tech_name, with the given columns. Posts without names drop out."""
    pruned = analysis.where(F.size(names) > 0)
    joined = pruned.join(posts, "post_id")
    return joined.select(F.explode(names).alias("tech_name"), *columns)


def analysed_posts(posts: DataFrame, analysis: DataFrame) -> DataFrame:
    """Posts that name anything, joined with their analysis: the columns of both that the trends below read, if there.

    The functions of (posts, analysis) that ask `_mentions` take such rows, stored once for all of them, as posts with
    None as analysis.
    """
    named = [F.size(c) > 0 for c in NAME_COLUMNS if c in analysis.columns]
    own = analysis.select("post_id", *[c for c in (*NAME_COLUMNS, "sentiment_score") if c in analysis.columns])
    if named:
        own = own.where(F.coalesce(*[F.when(n, True) for n in named]))
    return own.join(posts.select("post_id", *[c for c in POST_COLUMNS if c in posts.columns]), "post_id")


def _mentions(posts: DataFrame, analysis: DataFrame | None, names: str, of_posts: list[str | Column], *of_analysis: str) -> DataFrame:
    """mentions with columns of the posts and of the analysis; without analysis, posts are analysed_posts."""
    if analysis is not None:
        dated = posts.select("post_id", *of_posts)
        return mentions(dated, analysis.select("post_id", names, *of_analysis), names, *dated.columns[1:], *of_analysis)
    rows = posts.where(F.size(names) > 0).select(names, *of_posts, *of_analysis)
    return rows.select(F.explode(names).alias("tech_name"), *rows.columns[1:])


def _weekly(posts: DataFrame, analysis: DataFrame | None, *extra: str) -> DataFrame:
    week = period_start("week", F.col("created_date")).alias("week_start")
    return _mentions(posts, analysis, "tech_mentioned", [week, "subreddit_id"], *extra)


def weekly_mentions_full(posts: DataFrame, analysis: DataFrame) -> DataFrame:
    return _weekly(posts, analysis).groupBy("tech_name", "week_start", "subreddit_id").agg(
        F.count("*").alias("mention_count")
    )


def weekly_mentions_incremental(
    trends: DataFrame, posts: DataFrame, analysis: DataFrame, last_run: Column
) -> DataFrame:
    """Recount the range of weeks touched by posts analysed after last_run; weeks outside it keep their rows.

    Inside the range old rows go, so a week that lost all its mentions vanishes. An empty range changes nothing.
    """
    week = period_start("week", F.col("created_date"))
    fresh = analysis.where((F.col("processed_date") > last_run) & F.col("tech_mentioned").isNotNull()).select("post_id")
    weeks = posts.select("post_id", week.alias("week_start")).join(fresh, "post_id")
    # Two dates come to the driver, so that both scans below get them as literals and can skip files and partitions.
    span = weeks.agg(F.min("week_start").cast("string").alias("lo"), F.max("week_start").cast("string").alias("hi")).first()
    old = trends.select("tech_name", "week_start", "subreddit_id", "mention_count")
    if span["lo"] is None:
        return old
    lo, hi = F.lit(span["lo"]).cast("date"), F.lit(span["hi"]).cast("date")
    start = F.col("week_start")
    kept = old.where(start.isNull() | (start < lo) | (start > hi))
    day = F.col("created_date")
    recent = posts.where((day >= lo.cast("timestamp")) & (day < F.date_add(hi, 7).cast("timestamp")))
    return kept.unionByName(weekly_mentions_full(recent, analysis))


def week_number(week_start: str | Column = "week_start") -> Column:
    """Weeks since the first Monday after the epoch."""
    return ((F.unix_date(week_start) - 4) / 7).cast("int")


WEEKLY_MENTIONS = struct("tech_name string, week_start date, subreddit_id int, mention_count bigint")


def weekly_table(path: str) -> BucketTable:
    """Stored weekly mentions with one bucket per week."""
    keys = ("tech_name", "week_start", "subreddit_id")
    return BucketTable(path, WEEKLY_MENTIONS, keys, lambda rows, order: rows.dropDuplicates(list(keys)), bucket=week_number(), filtered=False)


def refresh_weekly_table(
    table: BucketTable, posts: DataFrame, analysis: DataFrame, last_run: Column, version: int, previous: int | None = None
) -> set[int]:
    """weekly_mentions_incremental on a stored table: makes `version` of it, and returns the numbers of the weeks recounted.

    Only the files of these weeks are written; all others stay as they are.
    """
    week = week_number(period_start("week", F.col("created_date")))
    fresh = analysis.where((F.col("processed_date") > last_run) & F.col("tech_mentioned").isNotNull()).select("post_id")
    span = posts.select("post_id", week.alias("week")).join(fresh, "post_id").agg(F.min("week").alias("lo"), F.max("week").alias("hi")).first()
    weeks = set() if span["lo"] is None else set(range(span["lo"], span["hi"] + 1))
    # The bounds as dates, so that the scan of the posts can skip files.
    first, end = (F.date_from_unix_date(F.lit(7 * (n or 0) + 4)).cast("timestamp") for n in (span["lo"], (span["hi"] or 0) + 1))
    recent = posts.where((F.col("created_date") >= first) & (F.col("created_date") < end)) if weeks else posts.limit(0)
    table.replace(weekly_mentions_full(recent, analysis), version, previous, weeks)
    return weeks


def weekly_tech_trends(posts: DataFrame, analysis: DataFrame | None) -> DataFrame:
    return _weekly(posts, analysis, "sentiment_score").groupBy("tech_name", "week_start", "subreddit_id").agg(
        F.count("*").alias("mention_count"), F.avg("sentiment_score").alias("sentiment_avg")
    )


def tech_growth(trends: DataFrame, period_weeks: int = 4, min_mentions: int = 5) -> DataFrame:
    """Mentions of the last period against the one before, counted back from the latest week, in one pass.

    The current period includes both its ends and so has one week start more. No previous mentions: growth is NULL.
    """
    latest = trends.agg(F.max("week_start")).scalar()
    current_from = F.date_sub(latest, 7 * period_weeks)
    previous_from = F.date_sub(latest, 14 * period_weeks)
    is_current = F.col("week_start") >= current_from
    sums = (
        trends.where(F.col("week_start") >= previous_from)
        .groupBy("tech_name")
        .agg(
            F.sum(F.when(is_current, F.col("mention_count"))).alias("current_mentions"),
            F.coalesce(F.sum(F.when(~is_current, F.col("mention_count"))), F.lit(0)).alias("previous_mentions"),
        )
        .where(F.col("current_mentions") >= min_mentions)
    )
    change = (F.col("current_mentions") - F.col("previous_mentions")).cast("double")
    growth = F.try_divide(change, F.col("previous_mentions")) * 100
    return sums.withColumn("growth_percent", growth).orderBy(F.desc_nulls_last("growth_percent"), "tech_name")


def emerging_tech(
    trends: DataFrame, min_mentions: int = 5, growth_threshold: float = 50, period_weeks: int = 4
) -> DataFrame:
    """Names whose growth reaches the threshold, with the mean of their weekly sentiment."""
    grown = tech_growth(trends, period_weeks).where(
        (F.col("current_mentions") >= min_mentions) & (F.col("growth_percent") >= growth_threshold)
    )
    sentiment = trends.groupBy("tech_name").agg(F.avg("sentiment_avg").alias("avg_sentiment"))
    return grown.join(sentiment, "tech_name", "left")


def save_emerging(stored: DataFrame, emerging: DataFrame, as_of: str | datetime.date) -> DataFrame:
    """Merge the report into the correlation table, keyed by name and day."""
    rows = emerging.select(
        "tech_name",
        F.date_sub(as_date(as_of), 30).alias("period_start"),
        as_date(as_of).alias("period_end"),
        F.col("current_mentions").alias("mention_count"),
        F.col("avg_sentiment").alias("sentiment_avg"),
        "growth_percent",
        F.lit(None).cast("double").alias("correlation_score"),
    )
    return _keep_other_columns(stored, rows)


def save_popularity_corr(stored: DataFrame, corr: DataFrame, as_of: str | datetime.date) -> DataFrame:
    rows = corr.select(
        "tech_name",
        F.date_sub(as_date(as_of), 90).alias("period_start"),
        as_date(as_of).alias("period_end"),
        "mention_count",
        F.col("avg_sentiment").alias("sentiment_avg"),
        F.col("avg_score").alias("upvote_avg"),
        F.col("avg_comments").alias("comment_count_avg"),
        F.col("avg_correlation").alias("correlation_score"),
    )
    return _keep_other_columns(stored, rows)


def _keep_other_columns(stored: DataFrame, rows: DataFrame) -> DataFrame:
    """Overwrite the columns that `rows` has, per (tech_name, period_end); the others keep their stored value."""
    keys = ["tech_name", "period_end"]
    return merge_columns(stored, rows, keys, [c for c in rows.columns if c not in keys])


def popular_tech(trends: DataFrame, min_mentions: int = 3) -> DataFrame:
    totals = trends.groupBy("tech_name").agg(F.sum("mention_count").alias("total_mentions"))
    return totals.where(F.col("total_mentions") >= min_mentions)


def cooccurrence(analysis: DataFrame, popular: DataFrame, diagonal: bool = False) -> DataFrame:
    """How many posts mention both names of a pair, names in order; with `diagonal` also each name with itself.

    Equal sets of names are counted first. Pairs are then formed once per distinct set, not once per post, and a set
    is no larger than the dictionary it came from.
    """
    sets = (
        analysis.where(F.size("tech_mentioned") > 0)
        .groupBy(F.sort_array(F.array_distinct("tech_mentioned")).alias("names"))
        .agg(F.count("*").alias("posts"))
    )
    here = lambda names, first, i: F.transform(
        F.slice(names, i + (1 if diagonal else 2), F.size(names)),
        lambda second: F.struct(first.alias("tech_name_1"), second.alias("tech_name_2")),
    )
    names = F.col("names")
    kept = broadcast_if_small(popular.select(F.col("tech_name").alias("_kept")))
    # Only popular names are paired.
    sets = (
        sets.select("names", "posts", F.explode("names").alias("_kept"))
        .join(kept, "_kept", "left_semi")
        .groupBy("names", "posts")
        .agg(F.sort_array(F.collect_set("_kept")).alias("_popular"))
        .select(F.col("_popular").alias("names"), "posts")
    )
    pairs = sets.select(
        "posts", F.explode(F.flatten(F.transform(names, lambda first, i: here(names, first, i)))).alias("pair")
    )
    return pairs.groupBy("pair.tech_name_1", "pair.tech_name_2").agg(F.sum("posts").alias("together"))


def jaccard(pairs: DataFrame, popular: DataFrame) -> DataFrame:
    """Score of each pair: common posts over the sum of both totals less the common ones; pairs that never meet
    score 0 and are not listed."""
    totals = broadcast_if_small(popular)
    first = totals.select(F.col("tech_name").alias("tech_name_1"), F.col("total_mentions").alias("_first"))
    second = totals.select(F.col("tech_name").alias("tech_name_2"), F.col("total_mentions").alias("_second"))
    union = F.col("_first") + F.col("_second") - F.col("together")
    score = F.when(union > 0, F.col("together") / F.nullif(union, F.lit(0))).otherwise(0.0)
    return (
        pairs.where("tech_name_1 < tech_name_2")
        .join(first, "tech_name_1")
        .join(second, "tech_name_2")
        .select("tech_name_1", "tech_name_2", score.alias("correlation_score"))
    )


def correlation_edges(scores: DataFrame, as_of: str | datetime.date, threshold: float = EDGE_THRESHOLD) -> DataFrame:
    return scores.where(F.col("correlation_score") > threshold).withColumn("analyzed_date", as_date(as_of))


def tech_correlation(
    trends: DataFrame, analysis: DataFrame, as_of: str | datetime.date, min_mentions: int = 3
) -> DataFrame:
    popular = popular_tech(trends, min_mentions)
    return correlation_edges(jaccard(cooccurrence(analysis, popular), popular), as_of)


def skill_demand(posts: DataFrame, analysis: DataFrame | None) -> DataFrame:
    """Skills per month over posts whose title is about work."""
    about_work = posts.where(F.lower("title").rlike("|".join(JOB_WORDS)) & F.col("created_date").isNotNull())
    rows = _mentions(about_work, analysis, "skills_mentioned", [period_start("month", F.col("created_date")).alias("month")])
    return rows.groupBy("month", F.col("tech_name").alias("skill")).agg(F.count("*").alias("mention_count"))


def subreddit_tech_trends(
    posts: DataFrame, analysis: DataFrame | None, subreddits: DataFrame, min_mentions: int = 3
) -> DataFrame:
    """Per subreddit, name, week and month; a week that crosses a month's end gives two rows."""
    periods = [period_start(unit, F.col("created_date")).alias(f"{unit}_start") for unit in ("week", "month")]
    rows = _mentions(posts, analysis, "tech_mentioned", ["subreddit_id", *periods], "sentiment_score")
    counted = (
        rows.groupBy("subreddit_id", "tech_name", "week_start", "month_start")
        .agg(F.count("*").alias("mention_count"), F.avg("sentiment_score").alias("sentiment_avg"))
        .where(F.col("mention_count") >= min_mentions)
    )
    # Joined after counting: only known subreddits stay, and each brings its name.
    names = broadcast_if_small(subreddits.select("subreddit_id", F.col("name").alias("subreddit_name")))
    return counted.join(names, "subreddit_id")


def sentiment_popularity_monthly(posts: DataFrame, analysis: DataFrame | None, min_mentions: int = 10) -> DataFrame:
    month = period_start("month", F.col("created_date")).alias("month")
    rows = _mentions(posts, analysis, "tech_mentioned", [month, "score", "num_comments"], "sentiment_score")
    return (
        rows.where(F.col("sentiment_score").isNotNull())
        .groupBy("tech_name", "month")
        .agg(
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.avg("score").alias("avg_score"),
            F.avg("num_comments").alias("avg_comments"),
            F.count("*").alias("mention_count"),
        )
        .where(F.col("mention_count") >= min_mentions)
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the pairs without NULL; NULL for a constant side instead of a division error."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def sentiment_popularity_corr(monthly: DataFrame) -> DataFrame:
    """Per name with at least two months: correlation of sentiment with score and with comments, their mean (of the
    one there is, if only one), total mentions and monthly means."""
    sentiment = F.col("avg_sentiment")
    corr = (
        monthly.groupBy("tech_name")
        .agg(
            F.count("*").alias("_months"),
            pearson(sentiment, F.col("avg_score")).alias("sentiment_score_corr"),
            pearson(sentiment, F.col("avg_comments")).alias("sentiment_comments_corr"),
            F.sum("mention_count").alias("mention_count"),
            F.avg("avg_sentiment").alias("avg_sentiment"),
            F.avg("avg_score").alias("avg_score"),
            F.avg("avg_comments").alias("avg_comments"),
        )
        .where("_months >= 2")
    )
    a, b = F.col("sentiment_score_corr"), F.col("sentiment_comments_corr")
    mean = F.coalesce((a + b) / 2, a, b)
    return corr.withColumn("avg_correlation", mean).drop("_months")


def tech_trends_by_time(
    posts: DataFrame, analysis: DataFrame | None, time_unit: str = "week", min_mentions: int = 5
) -> DataFrame:
    period = period_start(time_unit, F.col("created_date")).alias("time_period")
    rows = _mentions(posts, analysis, "tech_mentioned", [period], "sentiment_score")
    return (
        rows.groupBy("tech_name", "time_period")
        .agg(F.count("*").alias("mention_count"), F.avg("sentiment_score").alias("avg_sentiment"))
        .where(F.col("mention_count") >= min_mentions)
    )


def sentiment_trend_slope(
    posts: DataFrame,
    analysis: DataFrame,
    as_of: str | datetime.date,
    period_days: int = 30,
    min_mentions: int = 5,
) -> DataFrame:
    """Weekly mean sentiment over the last days and the least-squares slope over week positions, for names with at
    least two weeks. A name has one row per week by then, so the window is as long as the calendar."""
    recent = posts.where(F.col("created_date") >= F.date_sub(as_date(as_of), period_days))
    scored = analysis.where(F.col("sentiment_score").isNotNull())
    weekly = tech_trends_by_time(recent, scored, "week", min_mentions)
    place = F.row_number().over(Window.partitionBy("tech_name").orderBy("time_period")) - 1
    sums = (
        weekly.withColumn("_x", place.cast("double"))
        .groupBy("tech_name")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(F.col("time_period").alias("week_start"), "avg_sentiment", "mention_count")
                )
            ).alias("points"),
            F.regr_slope("avg_sentiment", "_x").alias("trend_slope"),
            F.max_by("avg_sentiment", "time_period").alias("current_sentiment"),
            F.sum("mention_count").alias("total_mentions"),
            F.count("*").alias("_weeks"),
        )
        .where("_weeks >= 2")
        .drop("_weeks")
    )
    slope = F.col("trend_slope")
    kind = F.when(slope > 0.05, "increasing").when(slope < -0.05, "decreasing").otherwise("stable")
    return sums.withColumn("trend_type", kind)
