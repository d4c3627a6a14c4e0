"""Read-side reports. Dates are inclusive days; a range on timestamps therefore ends at 00:00 of its last day.

An empty list of subreddits, or ["all"], means no filter. Every report that ends in a limit breaks ties by name or id.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from threadloom.functions import text as X
from threadloom.operators.trends import as_date
from threadloom.sizing import broadcast_if_small, broadcast_known

Day = str | datetime.date

# Names offered when there is no data.
FALLBACK_SUBREDDIT = "dataengineering"
FALLBACK_TECHS = ["hadoop", "spark", "postgresql", "airflow", "kafka"]


def _filters(names: list[str] | None) -> bool:
    return bool(names) and names != ["all"]


def _selected(subreddits: DataFrame, names: list[str] | None) -> DataFrame:
    chosen = subreddits.where(F.col("name").isin(names)) if _filters(names) else subreddits
    return broadcast_if_small(chosen.select("subreddit_id", F.col("name").alias("subreddit_name")))


def _between(column: str, start: Day, end: Day) -> Column:
    return F.col(column).between(as_date(start), as_date(end))


def posts_in(posts: DataFrame, subreddits: DataFrame, start: Day, end: Day, names: list[str] | None = None) -> DataFrame:
    """Posts of the range in known (and chosen) subreddits, with subreddit_name."""
    return posts.where(_between("created_date", start, end)).join(_selected(subreddits, names), "subreddit_id")


def trends_in(
    trends: DataFrame, start: Day, end: Day, subreddits: DataFrame | None = None, names: list[str] | None = None
) -> DataFrame:
    rows = trends.where(_between("week_start", start, end))
    if _filters(names):
        rows = rows.join(_selected(subreddits, names), "subreddit_id", "left_semi")
    return rows


def _or_default(rows: DataFrame, column: str, names: list[str]) -> DataFrame:
    """The rows, or the given names when there are none."""
    spark = rows.sparkSession
    default = spark.createDataFrame([(name,) for name in names], f"{column} string")
    is_empty = rows.agg(F.count("*")).scalar() == 0
    return rows.unionByName(default.where(is_empty), allowMissingColumns=True)


def list_subreddits(subreddits: DataFrame) -> DataFrame:
    return _or_default(subreddits.select("name"), "name", [FALLBACK_SUBREDDIT]).orderBy("name")


def _totals(trends: DataFrame, *extra: Column) -> DataFrame:
    return trends.groupBy("tech_name").agg(F.sum("mention_count").alias("total_mentions"), *extra)


def _top(rows: DataFrame, by: str, name: str, n: int) -> DataFrame:
    return rows.orderBy(F.desc(by), name).limit(n)


def tech_options(trends: DataFrame, n: int = 100) -> DataFrame:
    top = _or_default(_top(_totals(trends), "total_mentions", "tech_name", n), "tech_name", FALLBACK_TECHS[:n])
    return top.orderBy(F.desc_nulls_last("total_mentions"), "tech_name")


def default_techs(trends: DataFrame, n: int = 5) -> DataFrame:
    return tech_options(trends, n).select("tech_name")


def overview_counts(
    posts: DataFrame, comments: DataFrame, analysis: DataFrame, trends: DataFrame, subreddits: DataFrame,
    start: Day, end: Day, names: list[str] | None = None,
) -> DataFrame:
    """Distinct posts, comments (dated by their post), topics and technologies, in one row."""
    chosen = posts_in(posts.select("post_id", "created_date", "subreddit_id"), subreddits, start, end, names)
    ids = chosen.select("post_id")
    topics = analysis.where(F.size("topics") > 0).select("post_id", "topics").join(ids, "post_id", "left_semi")
    known = trends.where(_between("week_start", start, end)).join(
        _selected(subreddits, names), "subreddit_id", "left_semi"
    )
    parts = {
        "posts": ids.select("post_id"),
        "comments": comments.select("post_id", "comment_id").join(ids, "post_id", "left_semi").select("comment_id"),
        "topics": topics.select(F.explode("topics")),
        "techs": known.select("tech_name"),
    }
    counted = None
    for name, rows in parts.items():
        one = rows.toDF("item").agg(F.countDistinct("item").alias("n")).select(F.lit(name).alias("part"), "n")
        counted = one if counted is None else counted.unionByName(one)
    return counted.agg(*[F.max(F.when(F.col("part") == p, F.col("n"))).alias(f"total_{p}") for p in parts])


def activity_trend(
    posts: DataFrame, subreddits: DataFrame, start: Day, end: Day, names: list[str] | None = None
) -> DataFrame:
    """Posts per day, week or month, whichever suits the span, with the label of the period."""
    days = (datetime.date.fromisoformat(str(end)) - datetime.date.fromisoformat(str(start))).days
    unit = X.activity_unit(days)
    rows = posts_in(posts.select("post_id", "created_date", "subreddit_id"), subreddits, start, end, names)
    counted = rows.groupBy(X.period_start(unit, F.col("created_date")).alias("time_period")).agg(
        F.count("*").alias("post_count")
    )
    return counted.withColumn("time_label", X.period_label(unit, F.col("time_period"))).orderBy("time_period")


def top_subreddits(posts: DataFrame, subreddits: DataFrame, start: Day, end: Day, n: int = 10, shown: int = 5) -> DataFrame:
    counts = posts.where(_between("created_date", start, end)).groupBy("subreddit_id").agg(
        F.count("*").alias("post_count")
    )
    named = counts.join(_selected(subreddits, None), "subreddit_id").select("subreddit_name", "post_count")
    return _top(named, "post_count", "subreddit_name", min(n, shown))


def sentiment_distribution(
    posts: DataFrame, analysis: DataFrame, subreddits: DataFrame, start: Day, end: Day, names: list[str] | None = None
) -> DataFrame:
    rows = posts_in(posts.select("post_id", "created_date", "subreddit_id"), subreddits, start, end, names)
    scored = analysis.where(F.col("sentiment_score").isNotNull()).select("post_id", "sentiment_score")
    score = F.col("sentiment_score")
    return (
        scored.join(rows, "post_id")
        .groupBy(X.sentiment_band_order(score).alias("band_order"), X.sentiment_band(score).alias("sentiment_band"))
        .agg(F.count("*").alias("post_count"))
        .orderBy("band_order")
    )


def top_techs_overview(
    trends: DataFrame, subreddits: DataFrame, start: Day, end: Day, names: list[str] | None = None, n: int = 10
) -> DataFrame:
    rows = trends_in(trends, start, end, subreddits, names)
    return _top(_totals(rows, F.avg("sentiment_avg").alias("avg_sentiment")), "total_mentions", "tech_name", n)


def topic_counts(
    posts: DataFrame, analysis: DataFrame, subreddits: DataFrame, start: Day, end: Day,
    names: list[str] | None = None, n: int | None = None, questions_only: bool = False,
) -> DataFrame:
    """Posts per topic, all of them or the first n."""
    rows = posts_in(posts.select("post_id", "created_date", "subreddit_id"), subreddits, start, end, names)
    wanted = analysis.where(F.size("topics") > 0)
    if questions_only:
        wanted = wanted.where("is_question")
    counted = (
        wanted.select("post_id", "topics")
        .join(rows.select("post_id"), "post_id", "left_semi")
        .select(F.explode("topics").alias("topic"))
        .groupBy("topic")
        .agg(F.count("*").alias("post_count"))
    )
    return counted if n is None else _top(counted, "post_count", "topic", n)


def question_topics(
    posts: DataFrame, analysis: DataFrame, subreddits: DataFrame, start: Day, end: Day,
    names: list[str] | None = None, n: int | None = None,
) -> DataFrame:
    return topic_counts(posts, analysis, subreddits, start, end, names, n, questions_only=True)


def topic_details(
    posts: DataFrame, analysis: DataFrame, subreddits: DataFrame, topic: str, start: Day, end: Day,
    names: list[str] | None = None, n: int = 10,
) -> DataFrame:
    """The n best-rated posts of a topic with preview and link."""
    having = analysis.where(F.array_contains("topics", topic)).select("post_id")
    rows = posts_in(posts, subreddits, start, end, names).join(having, "post_id", "left_semi")
    best = rows.orderBy(F.desc("score"), "post_id").limit(n)
    return best.select(
        "post_id",
        "title",
        X.preview(F.col("text"), 200).alias("preview"),
        "score",
        "num_comments",
        "created_date",
        F.col("subreddit_name").alias("subreddit"),
        X.permalink_url(F.col("permalink")).alias("link"),
    )


def table_columns(rows: DataFrame) -> DataFrame:
    cells = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    return rows.sparkSession.createDataFrame(cells, "column_name string, data_type string")


def trend_table_profile(trends: DataFrame) -> DataFrame:
    return trends.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("tech_name").alias("unique_techs"),
        F.min("week_start").alias("earliest_date"),
        F.max("week_start").alias("latest_date"),
    )


def trend_table_months(trends: DataFrame) -> DataFrame:
    return trends.groupBy(X.period_start("month", F.col("week_start")).alias("month")).agg(
        F.count("*").alias("record_count")
    )


def growth_by_window(trends: DataFrame, end: Day, min_mentions: int = 5, period_weeks: int = 4) -> DataFrame:
    """Mentions of the window up to `end` against the window before it, in one pass; both windows include their first
    and last day. No previous mentions: growth counts as 100."""
    last, days = as_date(end), 7 * period_weeks
    week = F.col("week_start")
    current = week.between(F.date_sub(last, days), last)
    previous = week.between(F.date_sub(last, 2 * days + 1), F.date_sub(last, days + 1))
    sums = (
        trends.where(current | previous)
        .groupBy("tech_name")
        .agg(
            F.sum(F.when(current, F.col("mention_count"))).alias("current_mentions"),
            F.coalesce(F.sum(F.when(previous, F.col("mention_count"))), F.lit(0)).alias("previous_mentions"),
        )
        .where(F.col("current_mentions") >= min_mentions)
    )
    change = (F.col("current_mentions") - F.col("previous_mentions")).cast("double")
    growth = F.coalesce(F.try_divide(change, F.col("previous_mentions")) * 100, F.lit(100.0))
    return sums.withColumn("growth_percent", growth).orderBy(F.desc("growth_percent"), "tech_name")


def growth_view(
    trends: DataFrame, end: Day, min_mentions: int = 5, threshold: float = 50, period_weeks: int = 4, n: int = 20
) -> DataFrame:
    grown = growth_by_window(trends, end, min_mentions, period_weeks)
    return _top(grown.where(F.col("growth_percent") >= threshold), "growth_percent", "tech_name", n)


def emerging_view(trends: DataFrame, end: Day, min_mentions: int = 5, threshold: float = 50) -> DataFrame:
    return growth_view(trends, end, min_mentions, threshold, n=20)


def growth_hint(trends: DataFrame, end: Day, min_mentions: int = 5, period_weeks: int = 4) -> DataFrame:
    """The highest positive growth: a threshold to suggest when a growth view is empty. NULL when nothing grew."""
    growth = F.col("growth_percent")
    return growth_by_window(trends, end, min_mentions, period_weeks).agg(
        F.max(F.when(growth > 0, growth)).alias("highest_growth")
    )


def top_techs(
    trends: DataFrame, subreddits: DataFrame, start: Day, end: Day, names: list[str] | None = None, n: int = 10
) -> DataFrame:
    return _top(_totals(trends_in(trends, start, end, subreddits, names)), "total_mentions", "tech_name", n)


def tech_trend_series(
    trends: DataFrame, start: Day, end: Day, technologies: list[str] | None = None, time_unit: str = "week"
) -> DataFrame:
    rows = trends_in(trends, start, end)
    if technologies:
        rows = rows.where(F.col("tech_name").isin(technologies))
    return rows.groupBy("tech_name", X.period_start(time_unit, F.col("week_start")).alias("time_period")).agg(
        F.sum("mention_count").alias("mentions"), F.avg("sentiment_avg").alias("avg_sentiment")
    )


def subreddit_trend_table(
    subreddit_trends: DataFrame, subreddits: DataFrame, start: Day, end: Day, names: list[str] | None = None,
    technologies: list[str] | None = None,
) -> DataFrame:
    rows = subreddit_trends.where(_between("week_start", start, end))
    if technologies:
        rows = rows.where(F.col("tech_name").isin(technologies))
    counted = rows.groupBy("subreddit_id", "tech_name").agg(
        F.sum("mention_count").alias("mentions"), F.avg("sentiment_avg").alias("avg_sentiment")
    )
    return counted.join(_selected(subreddits, names), "subreddit_id").select(
        "subreddit_name", "tech_name", "mentions", "avg_sentiment"
    )


def correlation_threshold(edges: DataFrame, threshold: float = 0.05) -> DataFrame:
    kept = edges.where(F.col("correlation_score") >= threshold)
    return kept.select("tech_name_1", "tech_name_2", "correlation_score").orderBy(
        F.desc("correlation_score"), "tech_name_1", "tech_name_2"
    )


def _degrees(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.explode(F.array("tech_name_1", "tech_name_2")).alias("tech_name"))
    return ends.groupBy("tech_name").agg(F.count("*").alias("degree"))


def network_degree(edges: DataFrame, threshold: float = 0.05, n: int = 30) -> DataFrame:
    """Degree and degree centrality in the graph of the n best-connected names and the edges among them.

    A name whose partners are all cut off stays with degree 0; a graph of one name has centrality 1.
    """
    kept = edges.where(F.col("correlation_score") >= threshold).select("tech_name_1", "tech_name_2")
    nodes = _top(_degrees(kept), "degree", "tech_name", n).select("tech_name")
    chosen = broadcast_known(nodes, n)
    inner = kept.join(chosen.withColumnRenamed("tech_name", "tech_name_1"), "tech_name_1", "left_semi").join(
        chosen.withColumnRenamed("tech_name", "tech_name_2"), "tech_name_2", "left_semi"
    )
    size = nodes.agg(F.count("*")).scalar()
    degree = F.coalesce("degree", F.lit(0))
    return nodes.join(_degrees(inner), "tech_name", "left").select(
        "tech_name",
        degree.alias("degree"),
        F.when(size == 1, 1.0).otherwise(F.try_divide(degree.cast("double"), size - 1)).alias("centrality"),
    )


def correlation_neighbours(edges: DataFrame, tech_name: str, n: int = 10) -> DataFrame:
    first, second = F.col("tech_name_1"), F.col("tech_name_2")
    related = F.when(first == tech_name, second).otherwise(first).alias("related_tech")
    rows = edges.where((first == tech_name) | (second == tech_name)).select(related, "correlation_score")
    return _top(rows, "correlation_score", "related_tech", n)


def _skills(
    posts: DataFrame, analysis: DataFrame, start: Day, end: Day, terms: DataFrame | None, skill_type: str
) -> DataFrame:
    dated = posts.where(_between("created_date", start, end)).select(
        "post_id", X.period_start("month", F.col("created_date")).alias("month")
    )
    named = analysis.where(F.size("skills_mentioned") > 0).select("post_id", "skills_mentioned").join(dated, "post_id")
    skills = named.select("month", F.explode("skills_mentioned").alias("skill"))
    if skill_type != "all":
        of_type = terms.where(F.col("category") == skill_type).select(F.col("name").alias("skill")).distinct()
        skills = skills.join(broadcast_if_small(of_type), "skill", "left_semi")
    return skills


def skill_counts(
    posts: DataFrame, analysis: DataFrame, start: Day, end: Day, n: int | None = None,
    terms: DataFrame | None = None, skill_type: str = "all",
) -> DataFrame:
    """Posts per skill; a skill_type other than "all" keeps the names of that dictionary category."""
    skills = _skills(posts, analysis, start, end, terms, skill_type)
    counted = skills.groupBy("skill").agg(F.count("*").alias("post_count"))
    return counted if n is None else _top(counted, "post_count", "skill", n)


def skill_trends(
    posts: DataFrame, analysis: DataFrame, start: Day, end: Day, n: int = 10,
    terms: DataFrame | None = None, skill_type: str = "all",
) -> DataFrame:
    """Monthly posts of the n skills with the largest total."""
    skills = _skills(posts, analysis, start, end, terms, skill_type)
    monthly = skills.groupBy("month", "skill").agg(F.count("*").alias("post_count"))
    totals = monthly.groupBy("skill").agg(F.sum("post_count").alias("total"))
    best = broadcast_known(_top(totals, "total", "skill", n).select("skill"), n)
    return monthly.join(best, "skill", "left_semi").select("month", "skill", "post_count")


def sentiment_by_tech(
    trends: DataFrame, start: Day, end: Day, min_mentions: int = 5, sort_by: str = "sentiment", n: int | None = None
) -> DataFrame:
    rows = trends_in(trends, start, end).groupBy("tech_name").agg(
        F.avg("sentiment_avg").alias("avg_sentiment"), F.sum("mention_count").alias("mentions")
    )
    kept = rows.where(F.col("mentions") >= min_mentions)
    ordered = kept.orderBy(F.desc("avg_sentiment" if sort_by == "sentiment" else "mentions"), "tech_name")
    return ordered if n is None else ordered.limit(n)


def sentiment_examples(
    posts: DataFrame, analysis: DataFrame, tech_name: str, start: Day, end: Day, n: int = 10, shown: int = 5
) -> DataFrame:
    """Of the n posts with the highest score that mention the name, the first `shown` positive and negative ones."""
    having = analysis.where(F.array_contains("tech_mentioned", tech_name)).select("post_id", "sentiment_score")
    rows = posts.where(_between("created_date", start, end)).join(having, "post_id")
    # A descending sort puts rows without a score first.
    top = rows.orderBy(F.desc_nulls_first("sentiment_score"), "post_id").limit(n)
    kind = F.when(F.col("sentiment_score") > 0, "positive").when(F.col("sentiment_score") < 0, "negative")
    place = F.row_number().over(
        Window.partitionBy("kind").orderBy(F.desc_nulls_first("sentiment_score"), "post_id")
    )
    return (
        top.withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .withColumn("place", place)
        .where(F.col("place") <= shown)
        .select(
            "kind",
            "place",
            "post_id",
            "title",
            X.preview(F.col("text"), 150).alias("preview"),
            "sentiment_score",
            "created_date",
            X.permalink_url(F.col("permalink")).alias("link"),
        )
    )
