"""Table and record schemas. Nothing in the package infers a schema."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct(columns: str) -> T.StructType:
    """Schema of "name type, name type" that needs no running session, unlike StructType.fromDDL."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (c.split() for c in columns.split(","))])


POST_RECORD = struct(
    "id string, title string, text string, url string, author string, score int, upvote_ratio double, "
    "num_comments int, created_utc double, created_date string, subreddit string, permalink string, "
    "is_self boolean, is_video boolean, over_18 boolean, spoiler boolean, link_flair_text string, "
    "sort_type string, collected_utc bigint"
)

COMMENT_RECORD = struct(
    "id string, post_id string, parent_id string, body string, author string, score int, created_utc double, "
    "created_date string, is_submitter boolean, subreddit string, collected_utc bigint"
)

STREAM_ENVELOPE = struct("topic string, key string, value string, timestamp timestamp")

TERM_FILE = "map<string, array<struct<name: string, aliases: array<string>, weight: double>>>"
TERMS = struct("category string, name string, term string, weight double, term_order int")
VALENCES = struct("term string, valence double")
POLARITIES = struct("term string, polarity double, subjectivity double")
LEMMAS = struct("form string, lemma string")

SUBREDDITS = struct(
    "subreddit_id int, name string, description string, subscribers int, created_utc bigint, "
    "created_date timestamp, last_updated timestamp"
)

POSTS = struct(
    "post_id string, subreddit_id int, title string, text string, url string, author string, score int, "
    "upvote_ratio double, num_comments int, created_utc bigint, created_date timestamp, is_self boolean, "
    "is_video boolean, over_18 boolean, permalink string, link_flair_text string, collected_utc bigint, "
    "processed_date timestamp"
)

COMMENTS = struct(
    "comment_id string, post_id string, parent_id string, body string, author string, score int, "
    "created_utc bigint, created_date timestamp, is_submitter boolean, collected_utc bigint, "
    "processed_date timestamp"
)

POST_ANALYSIS = struct(
    "post_id string, sentiment_score double, word_count int, unique_words int, tech_mentioned array<string>, "
    "companies_mentioned array<string>, skills_mentioned array<string>, topics array<string>, "
    "is_question boolean, processed_date timestamp"
)

COMMENT_ANALYSIS = struct(
    "comment_id string, sentiment_score double, word_count int, tech_mentioned array<string>, "
    "is_answer boolean, processed_date timestamp"
)

TECH_TRENDS = struct(
    "tech_name string, mention_count bigint, week_start date, sentiment_avg double, subreddit_id int, "
    "processed_date timestamp"
)

USER_ACTIVITY = struct(
    "username string, post_count bigint, comment_count bigint, avg_post_score double, avg_comment_score double, "
    "first_seen timestamp, last_seen timestamp, active_subreddits array<string>, tech_expertise array<string>, "
    "processed_date timestamp"
)

TECH_CORRELATION = struct(
    "tech_name_1 string, tech_name_2 string, correlation_score double, analyzed_date date, processed_date timestamp"
)

SUBREDDIT_TECH_TRENDS = struct(
    "subreddit_id int, tech_name string, mention_count bigint, sentiment_avg double, week_start date, "
    "month_start date, processed_date timestamp"
)

SENTIMENT_POPULARITY = struct(
    "tech_name string, period_start date, period_end date, mention_count bigint, sentiment_avg double, "
    "growth_percent double, upvote_avg double, comment_count_avg double, correlation_score double, "
    "processed_date timestamp"
)
