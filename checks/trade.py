"""Trends, correlations, user activity, reports and the pipeline over the trade tables (topic reports: documents)."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import adapters as A
from checks.sql import BANDS, POPULAR, TEXT_RECORDS, TEXT_SUBREDDITS, TRADE, grams, r6, stamp, tokens, top_counted
from threadloom.operators import features as F1, reports as D, trends as T, users as U
from threadloom.plans import analyses as P
from threadloom.schemas import SENTIMENT_POPULARITY
from threadloom.sizing import cut_lineage, work_dir
from threadloom.sources import tables

AS_OF = "2001-08-01"
START, END = "1997-03-01", "1999-02-15"


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return A.trade_posts(spark, sf)


def analysis(spark: SparkSession, sf: str) -> DataFrame:
    return A.trade_analysis(spark, sf)


def trends(spark: SparkSession, sf: str) -> DataFrame:
    """The stored trend table: written once per session and data set, as the reports read it."""
    return _stored_trends(spark, sf)


@functools.lru_cache(maxsize=8)
def _stored_trends(spark: SparkSession, sf: str) -> DataFrame:
    return cut_lineage(T.weekly_tech_trends(posts(spark, sf), analysis(spark, sf)), "weekly_tech_trends")


def dims(spark: SparkSession, sf: str) -> DataFrame:
    return A.trade_subreddits(spark, sf)


def _trend_out(rows: DataFrame) -> DataFrame:
    return rows.withColumn("sentiment_avg", A.rounded("sentiment_avg"))


def weekly_mentions_full(spark, sf):
    return T.weekly_mentions_full(posts(spark, sf), analysis(spark, sf))


WEEKLY_FULL = f"WITH {TRADE} SELECT tech_name, week_start, subreddit_id, count(*) AS mention_count FROM mentions GROUP BY 1, 2, 3"


def weekly_mentions_incremental(spark, sf):
    """Analyses of returned goods are new; stored counts are all one too high, so only the new range is right."""
    stored = weekly_mentions_full(spark, sf).withColumn("mention_count", F.col("mention_count") + 1)
    since = F.lit("2000-06-01").cast("timestamp")
    return T.weekly_mentions_incremental(stored, posts(spark, sf), analysis(spark, sf), since)


def weekly_mentions_stored(spark, sf):
    """As weekly_mentions_incremental, on a table stored by week."""
    table = T.weekly_table(work_dir(spark, "weekly"))
    stored = weekly_mentions_full(spark, sf).withColumn("mention_count", F.col("mention_count") + 1)
    table.apply(stored, 0, [])
    T.refresh_weekly_table(table, posts(spark, sf), analysis(spark, sf), F.lit("2000-06-01").cast("timestamp"), 1, 0)
    return table.read(spark, 1)


INCREMENTAL = f"""WITH {TRADE}, touched AS (SELECT min(week_start) AS lo, max(week_start) AS hi FROM mentions
  WHERE processed_date > TIMESTAMP '2000-06-01')
SELECT tech_name, week_start, subreddit_id, count(*) + CASE WHEN week_start BETWEEN (SELECT lo FROM touched) AND
  (SELECT hi FROM touched) THEN 0 ELSE 1 END AS mention_count FROM mentions GROUP BY 1, 2, 3"""


def weekly_tech_trends(spark, sf):
    return _trend_out(T.weekly_tech_trends(posts(spark, sf), analysis(spark, sf)))


WEEKLY = f"""WITH {TRADE} SELECT tech_name, week_start, subreddit_id, mention_count, {r6('sentiment_avg')} AS sentiment_avg FROM trends"""

GROWTH_CTE = """top_week AS (SELECT max(week_start) AS w FROM trends),
growth AS (SELECT tech_name, CAST(current_mentions AS BIGINT) AS current_mentions,
    CAST(coalesce(previous_mentions, 0) AS BIGINT) AS previous_mentions,
    CASE WHEN coalesce(previous_mentions, 0) = 0 THEN NULL
      ELSE CAST(current_mentions - previous_mentions AS DOUBLE) / previous_mentions * 100 END AS growth_percent
  FROM (SELECT tech_name, sum(mention_count) AS current_mentions FROM trends, top_week
      WHERE week_start >= w - INTERVAL 28 DAYS GROUP BY 1)
    LEFT JOIN (SELECT tech_name, sum(mention_count) AS previous_mentions FROM trends, top_week
      WHERE week_start >= w - INTERVAL 56 DAYS AND week_start < w - INTERVAL 28 DAYS GROUP BY 1) USING (tech_name)
  WHERE current_mentions >= 5)"""


def tech_growth(spark, sf):
    return T.tech_growth(trends(spark, sf)).withColumn("growth_percent", A.rounded("growth_percent"))


GROWTH = f"""WITH {TRADE}, {GROWTH_CTE}
SELECT tech_name, current_mentions, previous_mentions, {r6('growth_percent')} AS growth_percent FROM growth"""

THRESHOLD = -40


def _emerging(spark, sf) -> DataFrame:
    return T.emerging_tech(trends(spark, sf), 5, THRESHOLD)


def emerging_tech(spark, sf):
    rows = _emerging(spark, sf)
    return rows.withColumns({c: A.rounded(c) for c in ("growth_percent", "avg_sentiment")})


EMERGING_CTE = f"""{GROWTH_CTE}, emerging AS (SELECT g.*, s.avg_sentiment FROM growth g
  LEFT JOIN (SELECT tech_name, avg(sentiment_avg) AS avg_sentiment FROM trends GROUP BY 1) s USING (tech_name)
  WHERE growth_percent >= {THRESHOLD})"""
EMERGING = f"""WITH {TRADE}, {EMERGING_CTE} SELECT tech_name, current_mentions, previous_mentions,
  {r6('growth_percent')} AS growth_percent, {r6('avg_sentiment')} AS avg_sentiment FROM emerging"""


def _popularity_store(spark, sf) -> DataFrame:
    """A stored report of the day for every technology, all values 0."""
    names = trends(spark, sf).select("tech_name").distinct()
    zero = names.select(
        "tech_name", F.lit("2001-05-01").cast("date").alias("period_start"), F.lit(AS_OF).cast("date").alias("period_end"),
        F.lit(0).cast("bigint").alias("mention_count"), F.lit(0.0).alias("growth_percent"), F.lit(0.0).alias("upvote_avg"),
    )
    return tables.evolve_schema(zero, SENTIMENT_POPULARITY)


def save_emerging(spark, sf):
    rows = T.save_emerging(_popularity_store(spark, sf), _emerging(spark, sf), AS_OF)
    return rows.select(
        "tech_name", "period_start", "period_end", "mention_count", A.rounded("sentiment_avg").alias("sentiment_avg"),
        A.rounded("growth_percent").alias("growth_percent"), A.rounded("upvote_avg").alias("upvote_avg"),
    )


SAVE_EMERGING = f"""WITH {TRADE}, {EMERGING_CTE}, names AS (SELECT DISTINCT tech_name FROM trends)
SELECT n.tech_name, CASE WHEN e.tech_name IS NULL THEN DATE '2001-05-01' ELSE CAST(DATE '{AS_OF}' - INTERVAL 30 DAYS AS DATE) END AS period_start,
  DATE '{AS_OF}' AS period_end, coalesce(current_mentions, 0) AS mention_count, {r6('avg_sentiment')} AS sentiment_avg,
  {r6('CASE WHEN e.tech_name IS NULL THEN CAST(0.0 AS DOUBLE) ELSE growth_percent END')} AS growth_percent,
  {r6('CAST(0.0 AS DOUBLE)')} AS upvote_avg
FROM names n LEFT JOIN emerging e ON e.tech_name = n.tech_name"""


def popular_tech(spark, sf):
    return T.popular_tech(trends(spark, sf), 2000)


POPULAR_TECH = f"WITH {TRADE} SELECT tech_name, CAST(sum(mention_count) AS BIGINT) AS total_mentions FROM trends GROUP BY 1 HAVING sum(mention_count) >= 2000"


def _pairs(spark, sf, diagonal: bool = False) -> tuple[DataFrame, DataFrame]:
    popular = T.popular_tech(trends(spark, sf), 3)
    return T.cooccurrence(analysis(spark, sf), popular, diagonal), popular


def cooccurrence(spark, sf):
    return _pairs(spark, sf, diagonal=True)[0]


COOCCURRENCE = f"""WITH {TRADE}, {POPULAR}
SELECT tech_name_1, tech_name_2, CAST(together AS BIGINT) AS together FROM pairs
UNION ALL SELECT tech_name, tech_name, count(*) FROM mentions JOIN popular USING (tech_name) GROUP BY 1"""


def _scores(spark, sf) -> DataFrame:
    return T.jaccard(*_pairs(spark, sf))


def jaccard(spark, sf):
    return _scores(spark, sf).withColumn("correlation_score", A.rounded("correlation_score"))


JACCARD = f"WITH {TRADE}, {POPULAR} SELECT tech_name_1, tech_name_2, {r6('correlation_score')} AS correlation_score FROM scores"


def _edges(spark, sf) -> DataFrame:
    return T.correlation_edges(_scores(spark, sf), AS_OF)


def correlation_edges(spark, sf):
    return _edges(spark, sf).withColumn("correlation_score", A.rounded("correlation_score"))


EDGES = f"""WITH {TRADE}, {POPULAR} SELECT tech_name_1, tech_name_2, {r6('correlation_score')} AS correlation_score,
  DATE '{AS_OF}' AS analyzed_date FROM edges"""


def skill_demand(spark, sf):
    return T.skill_demand(posts(spark, sf), analysis(spark, sf))


SKILL_DEMAND = f"""WITH {TRADE} SELECT month, skill, count(*) AS mention_count FROM (
  SELECT CAST(date_trunc('month', created_date) AS DATE) AS month, unnest(skills_mentioned) AS skill
  FROM analysis JOIN posts USING (post_id) WHERE regexp_matches(lower(title), 'hiring|job|career|looking for|position'))
GROUP BY 1, 2"""


def _subreddit_trends(spark, sf) -> DataFrame:
    return T.subreddit_tech_trends(posts(spark, sf), analysis(spark, sf), dims(spark, sf), 2)


def subreddit_tech_trends(spark, sf):
    return _trend_out(_subreddit_trends(spark, sf))


SUB_CTE = """sub_trends AS (SELECT m.subreddit_id, s.name AS subreddit_name, tech_name, week_start, month_start,
  count(*) AS mention_count, avg(sentiment_score) AS sentiment_avg
  FROM mentions m JOIN subreddits s USING (subreddit_id) GROUP BY ALL HAVING count(*) >= 2)"""
SUB_TRENDS = f"WITH {TRADE}, {SUB_CTE} SELECT * REPLACE ({r6('sentiment_avg')} AS sentiment_avg) FROM sub_trends"


def _monthly(spark, sf) -> DataFrame:
    return T.sentiment_popularity_monthly(A.trade_posts(spark, sf, True), analysis(spark, sf), 10)


def sentiment_popularity_monthly(spark, sf):
    means = ("avg_sentiment", "avg_score", "avg_comments")
    return _monthly(spark, sf).withColumns({c: A.rounded(c) for c in means})


MONTHLY_CTE = """monthly AS (SELECT tech_name, month_start AS month, avg(sentiment_score) AS avg_sentiment,
  avg(score) AS avg_score, avg(num_comments) AS avg_comments, count(*) AS mention_count
  FROM mentions WHERE sentiment_score IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 10)"""
MONTHLY = f"""WITH {TRADE}, {MONTHLY_CTE} SELECT tech_name, month, {r6('avg_sentiment')} AS avg_sentiment,
  {r6('avg_score')} AS avg_score, {r6('avg_comments')} AS avg_comments, mention_count FROM monthly"""


def sentiment_popularity_corr(spark, sf):
    rows = T.sentiment_popularity_corr(_monthly(spark, sf))
    return rows.withColumns({c: A.rounded(c) for c in rows.columns if c not in ("tech_name", "mention_count")})


CORR_CTE = """corr AS (SELECT tech_name, corr(avg_sentiment, avg_score) AS a, corr(avg_sentiment, avg_comments) AS b,
  CAST(sum(mention_count) AS BIGINT) AS mention_count, avg(avg_sentiment) AS avg_sentiment, avg(avg_score) AS avg_score,
  avg(avg_comments) AS avg_comments FROM monthly GROUP BY 1 HAVING count(*) >= 2)"""
CORR = f"""WITH {TRADE}, {MONTHLY_CTE}, {CORR_CTE}
SELECT tech_name, mention_count, {r6('a')} AS sentiment_score_corr, {r6('b')} AS sentiment_comments_corr,
  {r6('(a + b) / 2')} AS avg_correlation, {r6('avg_sentiment')} AS avg_sentiment, {r6('avg_score')} AS avg_score,
  {r6('avg_comments')} AS avg_comments FROM corr"""


def save_popularity_corr(spark, sf):
    saved = T.save_popularity_corr(
        _popularity_store(spark, sf), T.sentiment_popularity_corr(_monthly(spark, sf)), AS_OF
    )
    return saved.select(
        "tech_name", "period_start", "period_end", "mention_count",
        *[A.rounded(c).alias(c) for c in ("sentiment_avg", "growth_percent", "upvote_avg", "comment_count_avg", "correlation_score")],
    )


SAVE_CORR = f"""WITH {TRADE}, {MONTHLY_CTE}, {CORR_CTE}, names AS (SELECT DISTINCT tech_name FROM trends)
SELECT n.tech_name, CASE WHEN c.tech_name IS NULL THEN DATE '2001-05-01' ELSE CAST(DATE '{AS_OF}' - INTERVAL 90 DAYS AS DATE) END AS period_start,
  DATE '{AS_OF}' AS period_end, coalesce(mention_count, 0) AS mention_count, {r6('avg_sentiment')} AS sentiment_avg,
  {r6('CAST(0.0 AS DOUBLE)')} AS growth_percent,
  {r6('CASE WHEN c.tech_name IS NULL THEN CAST(0.0 AS DOUBLE) ELSE avg_score END')} AS upvote_avg,
  {r6('avg_comments')} AS comment_count_avg, {r6('(a + b) / 2')} AS correlation_score
FROM names n LEFT JOIN corr c ON c.tech_name = n.tech_name"""


def tech_trends_by_time(spark, sf):
    parts = None
    for unit in ("day", "week", "month", "quarter"):
        rows = T.tech_trends_by_time(posts(spark, sf), analysis(spark, sf), unit, 5).withColumn("unit", F.lit(unit))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.withColumn("avg_sentiment", A.rounded("avg_sentiment"))


BY_TIME = f"WITH {TRADE} " + " UNION ALL ".join(
    f"""SELECT tech_name, CAST(date_trunc('{u}', created_date) AS DATE) AS time_period, count(*) AS mention_count,
  {r6('avg(sentiment_score)')} AS avg_sentiment, '{u}' AS unit FROM mentions GROUP BY 1, 2 HAVING count(*) >= 5"""
    for u in ("day", "week", "month", "quarter")
)


def sentiment_trend_slope(spark, sf):
    rows = T.sentiment_trend_slope(posts(spark, sf), analysis(spark, sf), AS_OF, 120, 2)
    points = F.transform("points", lambda p: F.concat_ws(":", p["week_start"].cast("string"), p["mention_count"].cast("string")))
    return rows.select(
        "tech_name", A.rounded("trend_slope").alias("trend_slope"), "trend_type",
        A.rounded("current_sentiment").alias("current_sentiment"), "total_mentions", A.joined(points).alias("points"),
    )


SLOPE = f"""WITH {TRADE}, weekly AS (SELECT tech_name, week_start, avg(sentiment_score) AS s, count(*) AS n FROM mentions
  WHERE created_date >= DATE '{AS_OF}' - INTERVAL 120 DAYS AND sentiment_score IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2),
x AS (SELECT *, row_number() OVER (PARTITION BY tech_name ORDER BY week_start) - 1 AS i FROM weekly),
slopes AS (SELECT tech_name, regr_slope(s, i) AS b, max_by(s, week_start) AS last_s, CAST(sum(n) AS BIGINT) AS total,
  string_agg(strftime(week_start, '%Y-%m-%d') || ':' || n, '|' ORDER BY week_start) AS points FROM x GROUP BY 1 HAVING count(*) >= 2)
SELECT tech_name, {r6('b')} AS trend_slope, CASE WHEN b > 0.05 THEN 'increasing' WHEN b < -0.05 THEN 'decreasing' ELSE 'stable' END AS trend_type,
  {r6('last_s')} AS current_sentiment, total AS total_mentions, points FROM slopes"""


def _activity_out(rows: DataFrame) -> DataFrame:
    return rows.select(
        "username", "post_count", "comment_count", A.rounded("avg_post_score").alias("avg_post_score"),
        A.rounded("avg_comment_score").alias("avg_comment_score"), A.stamp("first_seen").alias("first_seen"),
        A.stamp("last_seen").alias("last_seen"), A.joined("active_subreddits").alias("active_subreddits"),
    )


def user_activity_union(spark, sf):
    return _activity_out(U.user_activity_union(posts(spark, sf), A.trade_comments(spark, sf), dims(spark, sf)))


def user_activity_merge(spark, sf):
    return _activity_out(U.user_activity_merge(posts(spark, sf), A.trade_comments(spark, sf), dims(spark, sf)))


def _activity_sql(count: str) -> str:
    return f"""WITH {TRADE}, everything AS (
  SELECT post_id AS id, author, score, created_date, name, true AS is_post FROM posts JOIN subreddits USING (subreddit_id)
  UNION ALL SELECT comment_id, c.author, c.score, c.created_date, name, false
  FROM comments c JOIN posts p USING (post_id) JOIN subreddits USING (subreddit_id))
SELECT author AS username, count({count} id) FILTER (is_post) AS post_count, count({count} id) FILTER (NOT is_post) AS comment_count,
  {r6('coalesce(avg(score) FILTER (is_post), 0)')} AS avg_post_score,
  {r6('coalesce(avg(score) FILTER (NOT is_post), 0)')} AS avg_comment_score,
  {stamp('min(created_date)')} AS first_seen, {stamp('max(created_date)')} AS last_seen,
  array_to_string(list_sort(list(DISTINCT name)), '|') AS active_subreddits
FROM everything WHERE author <> '[deleted]' GROUP BY 1"""


def list_subreddits(spark, sf):
    return D.list_subreddits(A.text_subreddits(spark, sf))


LIST_SUBS = "SELECT DISTINCT source AS name FROM documents"


def tech_options(spark, sf):
    return D.tech_options(trends(spark, sf))


OPTIONS = f"WITH {TRADE} SELECT tech_name, CAST(sum(mention_count) AS BIGINT) AS total_mentions FROM trends GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100"


def default_techs(spark, sf):
    return D.default_techs(trends(spark, sf))


DEFAULTS = f"WITH {TRADE} SELECT tech_name FROM trends GROUP BY 1 ORDER BY sum(mention_count) DESC, 1 LIMIT 5"

NAMES = ["NATION_3", "NATION_7", "NATION_11"]
NAME_LIST = ", ".join(f"'{n}'" for n in NAMES)
IN_RANGE = f"BETWEEN DATE '{START}' AND DATE '{END}'"
CHOSEN = f"chosen AS (SELECT p.*, s.name FROM posts p JOIN subreddits s USING (subreddit_id) WHERE created_date {IN_RANGE})"


def overview_counts(spark, sf):
    with_topics = analysis(spark, sf).withColumn("topics", F.col("skills_mentioned"))
    args = (posts(spark, sf), A.trade_comments(spark, sf), with_topics, trends(spark, sf), dims(spark, sf), START, END)
    everywhere = D.overview_counts(*args).withColumn("filter", F.lit("all"))
    return everywhere.unionByName(D.overview_counts(*args, NAMES).withColumn("filter", F.lit("some")))


def _overview(label: str, cond: str) -> str:
    return f"""SELECT (SELECT count(DISTINCT post_id) FROM chosen WHERE {cond}) AS total_posts,
  (SELECT count(DISTINCT comment_id) FROM comments WHERE post_id IN (SELECT post_id FROM chosen WHERE {cond})) AS total_comments,
  (SELECT count(DISTINCT topic) FROM (SELECT unnest(skills_mentioned) AS topic FROM analysis
    WHERE post_id IN (SELECT post_id FROM chosen WHERE {cond}))) AS total_topics,
  (SELECT count(DISTINCT tech_name) FROM trends JOIN subreddits USING (subreddit_id) WHERE week_start {IN_RANGE} AND {cond}) AS total_techs,
  '{label}' AS filter"""


OVERVIEW = f"WITH {TRADE}, {CHOSEN} {_overview('all', 'true')} UNION ALL {_overview('some', f'name IN ({NAME_LIST})')}"

SPANS = [("1998-03-01", "1998-03-12"), ("1998-03-01", "1998-05-20"), (START, END)]


def activity_trend(spark, sf):
    parts = None
    for start, end in SPANS:
        rows = D.activity_trend(posts(spark, sf), dims(spark, sf), start, end, NAMES if start == START else ["all"])
        rows = rows.withColumn("span", F.lit(f"{start}/{end}"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


ACTIVITY = f"WITH {TRADE} " + " UNION ALL ".join(
    f"""SELECT CAST(date_trunc('{u}', created_date) AS DATE) AS time_period, count(*) AS post_count,
  strftime(date_trunc('{u}', created_date), '{fmt}') AS time_label, '{a}/{b}' AS span
FROM posts JOIN subreddits USING (subreddit_id) WHERE created_date BETWEEN DATE '{a}' AND DATE '{b}'
  AND {f"name IN ({NAME_LIST})" if a == START else 'true'} GROUP BY 1, 3"""
    for (a, b), u, fmt in zip(SPANS, ("day", "week", "month"), ("%d/%m", "%U/%Y", "%m/%Y"))
)


def top_subreddits(spark, sf):
    return D.top_subreddits(posts(spark, sf), dims(spark, sf), START, END)


TOP_SUBS = f"WITH {TRADE}, {CHOSEN} SELECT name AS subreddit_name, count(*) AS post_count FROM chosen GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"


def sentiment_distribution(spark, sf):
    return D.sentiment_distribution(posts(spark, sf), analysis(spark, sf), dims(spark, sf), START, END, NAMES)


DISTRIBUTION = f"""WITH {TRADE}, {CHOSEN}, b AS (SELECT CASE WHEN sentiment_score < -0.5 THEN 1 WHEN sentiment_score < -0.1 THEN 2
  WHEN sentiment_score < 0.1 THEN 3 WHEN sentiment_score < 0.5 THEN 4 ELSE 5 END AS o
  FROM chosen JOIN analysis USING (post_id) WHERE sentiment_score IS NOT NULL AND name IN ({NAME_LIST}))
SELECT CAST(o AS INTEGER) AS band_order, {BANDS}[o] AS sentiment_band,
  count(*) AS post_count FROM b GROUP BY o"""


def top_techs_overview(spark, sf):
    rows = D.top_techs_overview(trends(spark, sf), dims(spark, sf), START, END, NAMES)
    return rows.withColumn("avg_sentiment", A.rounded("avg_sentiment"))


_NAMED_TRENDS = f"""FROM trends t WHERE week_start {IN_RANGE} AND EXISTS (SELECT 1 FROM subreddits s
  WHERE s.subreddit_id = t.subreddit_id AND s.name IN ({NAME_LIST}))"""
TECHS_OVERVIEW = f"""WITH {TRADE} SELECT tech_name, CAST(sum(mention_count) AS BIGINT) AS total_mentions,
  {r6('avg(sentiment_avg)')} AS avg_sentiment {_NAMED_TRENDS} GROUP BY 1 ORDER BY sum(mention_count) DESC, 1 LIMIT 10"""


def top_techs(spark, sf):
    return D.top_techs(trends(spark, sf), dims(spark, sf), START, END, NAMES, 7)


TOP_TECHS = f"""WITH {TRADE} SELECT tech_name, CAST(sum(mention_count) AS BIGINT) AS total_mentions {_NAMED_TRENDS}
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7"""

TEXT_START, TEXT_END = "2024-01-03", "2024-01-20"


def _topic_inputs(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their topics; those of clicked events count as questions."""
    rows = A.text_posts(spark, sf)
    full = rows.select("post_id", "text", F.coalesce(F.col("permalink") == "", F.lit(False)).alias("is_question"))
    topics = F1.doc_topics(F1.with_tokens(full, "post_id", "text")).select("post_id", "topics", "is_question")
    # The reports read the stored analysis table.
    return rows, cut_lineage(topics, "post_analysis"), A.text_subreddits(spark, sf)


TOPIC_CTE = f"""{TEXT_RECORDS}, {TEXT_SUBREDDITS},
words AS (SELECT id AS post_id, {tokens('text')} AS t FROM text_records),
grammed AS (SELECT post_id, {grams('t', 2)} || {grams('t', 3)} AS items FROM words),
topped AS ({top_counted('grammed', 'post_id', 'items')}),
topics AS (SELECT post_id, unnest(string_split(top, '|')) AS topic FROM topped),
posts AS (SELECT id AS post_id, title, text, score, num_comments, created_date, subreddit, permalink,
  event_type = 'click' AS is_question FROM text_records WHERE created_date BETWEEN DATE '{TEXT_START}' AND DATE '{TEXT_END}')"""
SOURCES = ["src1", "src4", "src9", "src16"]
SOURCE_LIST = ", ".join(f"'{s}'" for s in SOURCES)


def topic_counts(spark, sf):
    return D.topic_counts(*_topic_inputs(spark, sf), TEXT_START, TEXT_END, SOURCES)


TOPIC_COUNTS = f"""WITH {TOPIC_CTE} SELECT topic, count(*) AS post_count FROM topics JOIN posts USING (post_id)
WHERE subreddit IN ({SOURCE_LIST}) GROUP BY 1"""


def question_topics(spark, sf):
    return D.question_topics(*_topic_inputs(spark, sf), TEXT_START, TEXT_END, ["all"], 20)


QUESTION_TOPICS = f"""WITH {TOPIC_CTE} SELECT topic, count(*) AS post_count FROM topics JOIN posts USING (post_id)
WHERE is_question GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""

TOPIC = "anea eriner"


def topic_details(spark, sf):
    rows = D.topic_details(*_topic_inputs(spark, sf), TOPIC, TEXT_START, TEXT_END)
    return rows.withColumn("created_date", A.stamp("created_date"))


TOPIC_DETAILS = f"""WITH {TOPIC_CTE} SELECT post_id, title,
  CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview, score, num_comments,
  {stamp('created_date')} AS created_date, subreddit, CASE WHEN permalink <> '' THEN 'https://www.reddit.com' || permalink END AS link
FROM topics JOIN posts USING (post_id) WHERE topic = '{TOPIC}' ORDER BY posts.score DESC, post_id LIMIT 10"""


def trend_table_profile(spark, sf):
    return D.trend_table_profile(trends(spark, sf))


PROFILE = f"""WITH {TRADE} SELECT count(*) AS total_records, count(DISTINCT tech_name) AS unique_techs,
  min(week_start) AS earliest_date, max(week_start) AS latest_date FROM trends"""


def trend_table_months(spark, sf):
    return D.trend_table_months(trends(spark, sf))


MONTHS = f"WITH {TRADE} SELECT CAST(date_trunc('month', week_start) AS DATE) AS month, count(*) AS record_count FROM trends GROUP BY 1"

GROWTH_END = "1999-06-14"
WINDOW_CTE = f"""windows AS (SELECT tech_name, CAST(c AS BIGINT) AS current_mentions, CAST(coalesce(p, 0) AS BIGINT) AS previous_mentions,
    CASE WHEN coalesce(p, 0) = 0 THEN CAST(100 AS DOUBLE) ELSE CAST(c - p AS DOUBLE) / p * 100 END AS growth_percent
  FROM (SELECT tech_name, sum(mention_count) AS c FROM trends
      WHERE week_start BETWEEN DATE '{GROWTH_END}' - INTERVAL 28 DAYS AND DATE '{GROWTH_END}' GROUP BY 1 HAVING sum(mention_count) >= 5)
    LEFT JOIN (SELECT tech_name, sum(mention_count) AS p FROM trends
      WHERE week_start BETWEEN DATE '{GROWTH_END}' - INTERVAL 57 DAYS AND DATE '{GROWTH_END}' - INTERVAL 29 DAYS GROUP BY 1) USING (tech_name))"""
_GROWTH_COLUMNS = f"tech_name, current_mentions, previous_mentions, {r6('growth_percent')} AS growth_percent"


def _growth_out(rows: DataFrame) -> DataFrame:
    return rows.withColumn("growth_percent", A.rounded("growth_percent"))


def growth_by_window(spark, sf):
    return _growth_out(D.growth_by_window(trends(spark, sf), GROWTH_END))


def growth_view(spark, sf):
    return _growth_out(D.growth_view(trends(spark, sf), GROWTH_END, threshold=0, n=6))


def emerging_view(spark, sf):
    return _growth_out(D.emerging_view(trends(spark, sf), GROWTH_END, threshold=-10))


def growth_hint(spark, sf):
    return D.growth_hint(trends(spark, sf), GROWTH_END).select(A.rounded("highest_growth").alias("highest_growth"))


def tech_trend_series(spark, sf):
    rows = D.tech_trend_series(trends(spark, sf), START, END, ["Brand#1", "Brand#7", "Brand#25"], "month")
    every = D.tech_trend_series(trends(spark, sf), START, END, None, "week")
    both = rows.withColumn("unit", F.lit("month")).unionByName(every.withColumn("unit", F.lit("week")))
    return both.withColumn("avg_sentiment", A.rounded("avg_sentiment"))


SERIES = f"WITH {TRADE} " + " UNION ALL ".join(
    f"""SELECT tech_name, CAST(date_trunc('{u}', week_start) AS DATE) AS time_period, CAST(sum(mention_count) AS BIGINT) AS mentions,
  {r6('avg(sentiment_avg)')} AS avg_sentiment, '{u}' AS unit FROM trends WHERE week_start {IN_RANGE} AND {c} GROUP BY 1, 2"""
    for u, c in (("month", "tech_name IN ('Brand#1', 'Brand#7', 'Brand#25')"), ("week", "true"))
)


def subreddit_trend_table(spark, sf):
    rows = D.subreddit_trend_table(_subreddit_trends(spark, sf), dims(spark, sf), START, END, NAMES)
    return rows.withColumn("avg_sentiment", A.rounded("avg_sentiment"))


SUB_TABLE = f"""WITH {TRADE}, {SUB_CTE} SELECT subreddit_name, tech_name, CAST(sum(mention_count) AS BIGINT) AS mentions,
  {r6('avg(sentiment_avg)')} AS avg_sentiment FROM sub_trends WHERE week_start {IN_RANGE} AND subreddit_name IN ({NAME_LIST}) GROUP BY 1, 2"""


def correlation_threshold(spark, sf):
    rows = D.correlation_threshold(_edges(spark, sf), 0.07)
    return rows.withColumn("correlation_score", A.rounded("correlation_score"))


CORR_THRESHOLD = f"WITH {TRADE}, {POPULAR} SELECT tech_name_1, tech_name_2, {r6('correlation_score')} AS correlation_score FROM edges WHERE correlation_score >= 0.07"


def network_degree(spark, sf):
    rows = D.network_degree(_edges(spark, sf), 0.07, 12)
    return rows.withColumn("centrality", A.rounded("centrality"))


NETWORK = f"""WITH {TRADE}, {POPULAR}, kept AS (SELECT * FROM edges WHERE correlation_score >= 0.07),
ends AS (SELECT tech_name_1 AS tech_name FROM kept UNION ALL SELECT tech_name_2 FROM kept),
nodes AS (SELECT tech_name FROM ends GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 12),
inside AS (SELECT * FROM kept WHERE tech_name_1 IN (SELECT * FROM nodes) AND tech_name_2 IN (SELECT * FROM nodes)),
deg AS (SELECT tech_name, count(*) AS degree FROM (SELECT tech_name_1 AS tech_name FROM inside UNION ALL SELECT tech_name_2 FROM inside) GROUP BY 1)
SELECT tech_name, coalesce(degree, 0) AS degree, {r6('CAST(coalesce(degree, 0) AS DOUBLE) / ((SELECT count(*) FROM nodes) - 1)')} AS centrality
FROM nodes LEFT JOIN deg USING (tech_name)"""


def correlation_neighbours(spark, sf):
    rows = D.correlation_neighbours(_edges(spark, sf), "Brand#13")
    return rows.withColumn("correlation_score", A.rounded("correlation_score"))


NEIGHBOURS = f"""WITH {TRADE}, {POPULAR} SELECT CASE WHEN tech_name_1 = 'Brand#13' THEN tech_name_2 ELSE tech_name_1 END AS related_tech,
  {r6('correlation_score')} AS correlation_score FROM edges WHERE 'Brand#13' IN (tech_name_1, tech_name_2)
ORDER BY edges.correlation_score DESC, related_tech LIMIT 10"""

SKILL_CATEGORIES = [("bulk", "ECONOMY"), ("bulk", "STANDARD"), ("rare", "PROMO")]
_SKILL_ROWS = f"""skills AS (SELECT CAST(date_trunc('month', created_date) AS DATE) AS month, unnest(skills_mentioned) AS skill
  FROM analysis JOIN posts USING (post_id) WHERE created_date {IN_RANGE})"""


def skill_counts(spark, sf):
    terms = spark.createDataFrame(SKILL_CATEGORIES, "category string, name string")
    args = (posts(spark, sf), analysis(spark, sf), START, END)
    every = D.skill_counts(*args).withColumn("skill_type", F.lit("all"))
    bulk = D.skill_counts(*args, terms=terms, skill_type="bulk").withColumn("skill_type", F.lit("bulk"))
    return every.unionByName(bulk)


SKILL_COUNTS = f"""WITH {TRADE}, {_SKILL_ROWS} SELECT skill, count(*) AS post_count, 'all' AS skill_type FROM skills GROUP BY 1
UNION ALL SELECT skill, count(*), 'bulk' FROM skills WHERE skill IN ('ECONOMY', 'STANDARD') GROUP BY 1"""


def skill_trends(spark, sf):
    return D.skill_trends(posts(spark, sf), analysis(spark, sf), START, END, 3)


SKILL_TRENDS = f"""WITH {TRADE}, {_SKILL_ROWS} SELECT month, skill, count(*) AS post_count FROM skills
WHERE skill IN (SELECT skill FROM skills GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) GROUP BY 1, 2"""


def sentiment_by_tech(spark, sf):
    rows = D.sentiment_by_tech(trends(spark, sf), START, END, 5)
    top = D.sentiment_by_tech(trends(spark, sf), START, END, 5, "mentions", 4).withColumn("part", F.lit("top"))
    both = rows.withColumn("part", F.lit("all")).unionByName(top)
    return both.withColumn("avg_sentiment", A.rounded("avg_sentiment"))


_BY_TECH = f"""SELECT tech_name, {r6('avg(sentiment_avg)')} AS avg_sentiment, CAST(sum(mention_count) AS BIGINT) AS mentions"""
SENTIMENT_BY_TECH = f"""WITH {TRADE} {_BY_TECH}, 'all' AS part FROM trends WHERE week_start {IN_RANGE} GROUP BY 1 HAVING sum(mention_count) >= 5
UNION ALL SELECT * FROM ({_BY_TECH}, 'top' FROM trends WHERE week_start {IN_RANGE} GROUP BY 1 ORDER BY sum(mention_count) DESC, 1 LIMIT 4)"""


def sentiment_examples(spark, sf):
    rows = D.sentiment_examples(posts(spark, sf), analysis(spark, sf), "Brand#13", "1997-03-01", "1997-03-10")
    return rows.withColumns({"created_date": A.stamp("created_date"), "sentiment_score": A.rounded("sentiment_score")})


EXAMPLES = f"""WITH {TRADE}, top10 AS (SELECT p.*, sentiment_score FROM posts p JOIN analysis a USING (post_id)
  WHERE list_contains(tech_mentioned, 'Brand#13') AND created_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-10'
  ORDER BY sentiment_score DESC, post_id LIMIT 10),
k AS (SELECT *, CASE WHEN sentiment_score > 0 THEN 'positive' WHEN sentiment_score < 0 THEN 'negative' END AS kind FROM top10)
SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY sentiment_score DESC, post_id) AS INTEGER) AS place, post_id, title,
  CASE WHEN length(text) > 150 THEN substring(text, 1, 150) || '...' ELSE text END AS preview, {r6('sentiment_score')} AS sentiment_score,
  {stamp('created_date')} AS created_date, CASE WHEN permalink <> '' THEN 'https://www.reddit.com' || permalink END AS link
FROM k WHERE kind IS NOT NULL QUALIFY place <= 5"""


def run_all_analyses(spark, sf):
    out = work_dir(spark, "analyses")
    # The analysis is a stored table; as a plan, the correlation would look for its names again.
    analysed = cut_lineage(analysis(spark, sf), "analysis")
    run = P.run_all_analyses(A.trade_posts(spark, sf, True), analysed, dims(spark, sf), out, AS_OF)
    if run.errors:
        raise next(iter(run.errors.values()))
    counts = None
    for name, path in run.tables.items():
        one = spark.read.parquet(path).agg(F.count("*").alias("records")).select(F.lit(name).alias("analysis"), "records")
        counts = one if counts is None else counts.unionByName(one)
    return counts


_ANALYSES = {
    "weekly_tech_trends": "trends",
    "tech_growth": "growth",
    "emerging_tech": "(SELECT * FROM growth WHERE growth_percent >= 50)",
    "tech_correlation": "edges",
    "skill_demand": f"({SKILL_DEMAND.split(TRADE, 1)[1]})",
    "subreddit_tech_trends": "(SELECT 1 FROM mentions JOIN subreddits USING (subreddit_id) GROUP BY subreddit_id, tech_name, week_start, month_start HAVING count(*) >= 3)",
    "sentiment_popularity": "corr",
    "tech_trends_weekly": "(SELECT 1 FROM mentions GROUP BY tech_name, week_start HAVING count(*) >= 5)",
    "tech_trends_monthly": "(SELECT 1 FROM mentions GROUP BY tech_name, month_start HAVING count(*) >= 5)",
}
ALL_ANALYSES = f"WITH {TRADE}, {POPULAR}, {GROWTH_CTE}, {MONTHLY_CTE}, {CORR_CTE} " + " UNION ALL ".join(
    f"SELECT '{name}' AS analysis, count(*) AS records FROM {source}" for name, source in _ANALYSES.items()
)

QUERIES = {
    "weekly_mentions_full": (weekly_mentions_full, WEEKLY_FULL),
    "weekly_mentions_incremental": (weekly_mentions_incremental, INCREMENTAL),
    "weekly_mentions_stored": (weekly_mentions_stored, INCREMENTAL),
    "weekly_tech_trends": (weekly_tech_trends, WEEKLY),
    "tech_growth": (tech_growth, GROWTH),
    "emerging_tech": (emerging_tech, EMERGING),
    "save_emerging": (save_emerging, SAVE_EMERGING),
    "popular_tech": (popular_tech, POPULAR_TECH),
    "cooccurrence": (cooccurrence, COOCCURRENCE),
    "jaccard": (jaccard, JACCARD),
    "correlation_edges": (correlation_edges, EDGES),
    "skill_demand": (skill_demand, SKILL_DEMAND),
    "subreddit_tech_trends": (subreddit_tech_trends, SUB_TRENDS),
    "sentiment_popularity_monthly": (sentiment_popularity_monthly, MONTHLY),
    "sentiment_popularity_corr": (sentiment_popularity_corr, CORR),
    "save_popularity_corr": (save_popularity_corr, SAVE_CORR),
    "tech_trends_by_time": (tech_trends_by_time, BY_TIME),
    "sentiment_trend_slope": (sentiment_trend_slope, SLOPE),
    "user_activity_union": (user_activity_union, _activity_sql("DISTINCT")),
    "user_activity_merge": (user_activity_merge, _activity_sql("")),
    "list_subreddits": (list_subreddits, LIST_SUBS),
    "tech_options": (tech_options, OPTIONS),
    "default_techs": (default_techs, DEFAULTS),
    "overview_counts": (overview_counts, OVERVIEW),
    "activity_trend": (activity_trend, ACTIVITY),
    "top_subreddits": (top_subreddits, TOP_SUBS),
    "sentiment_distribution": (sentiment_distribution, DISTRIBUTION),
    "top_techs_overview": (top_techs_overview, TECHS_OVERVIEW),
    "topic_counts": (topic_counts, TOPIC_COUNTS),
    "question_topics": (question_topics, QUESTION_TOPICS),
    "topic_details": (topic_details, TOPIC_DETAILS),
    "trend_table_profile": (trend_table_profile, PROFILE),
    "trend_table_months": (trend_table_months, MONTHS),
    "growth_by_window": (growth_by_window, f"WITH {TRADE}, {WINDOW_CTE} SELECT {_GROWTH_COLUMNS} FROM windows"),
    "growth_view": (
        growth_view,
        f"WITH {TRADE}, {WINDOW_CTE} SELECT {_GROWTH_COLUMNS} FROM windows WHERE growth_percent >= 0 "
        "ORDER BY windows.growth_percent DESC, tech_name LIMIT 6",
    ),
    "emerging_view": (
        emerging_view,
        f"WITH {TRADE}, {WINDOW_CTE} SELECT {_GROWTH_COLUMNS} FROM windows WHERE growth_percent >= -10 "
        "ORDER BY windows.growth_percent DESC, tech_name LIMIT 20",
    ),
    "growth_hint": (
        growth_hint,
        f"WITH {TRADE}, {WINDOW_CTE} SELECT {r6('max(growth_percent) FILTER (growth_percent > 0)')} AS highest_growth FROM windows",
    ),
    "top_techs": (top_techs, TOP_TECHS),
    "tech_trend_series": (tech_trend_series, SERIES),
    "subreddit_trend_table": (subreddit_trend_table, SUB_TABLE),
    "correlation_threshold": (correlation_threshold, CORR_THRESHOLD),
    "network_degree": (network_degree, NETWORK),
    "correlation_neighbours": (correlation_neighbours, NEIGHBOURS),
    "skill_counts": (skill_counts, SKILL_COUNTS),
    "skill_trends": (skill_trends, SKILL_TRENDS),
    "sentiment_by_tech": (sentiment_by_tech, SENTIMENT_BY_TECH),
    "sentiment_examples": (sentiment_examples, EXAMPLES),
    "run_all_analyses": (run_all_analyses, ALL_ANALYSES),
}
