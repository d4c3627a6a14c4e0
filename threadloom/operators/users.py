"""Per-author activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.operators.normalise import known_authors
from threadloom.sizing import broadcast_if_small


def _authored(
    posts: DataFrame, comments: DataFrame, subreddits: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Posts and comments as (id, username, score, created_date, subreddit); a comment has its post's subreddit."""
    names = broadcast_if_small(subreddits.select("subreddit_id", F.col("name").alias("subreddit")))
    own = known_authors(posts).join(names, "subreddit_id")
    placed = posts.select("post_id", "subreddit_id")
    replies = known_authors(comments).join(placed, "post_id").join(names, "subreddit_id")
    columns = [F.col("author").alias("username"), "score", "created_date", "subreddit"]
    return (
        own.select(F.col("post_id").alias("id"), *columns),
        replies.select(F.col("comment_id").alias("id"), *columns),
    )


def _mean(total: Column, n: Column) -> Column:
    return F.coalesce(F.try_divide(F.sum(total), F.sum(n)), F.lit(0.0))


def user_activity_union(posts: DataFrame, comments: DataFrame, subreddits: DataFrame) -> DataFrame:
    """Counts of distinct posts and comments, mean scores, first and last seen, subreddits in order.

    Rows are reduced per id first: copies of an id fold together, and an author who wrote a large share of all rows
    is spread over tasks by id before being summed up.
    """
    own, replies = _authored(posts, comments, subreddits)
    both = own.withColumn("is_post", F.lit(True)).unionByName(replies.withColumn("is_post", F.lit(False)))
    per_id = both.groupBy("username", "is_post", "id").agg(
        F.sum(F.col("score").cast("double")).alias("_total"),
        F.count("score").alias("_n"),
        F.min("created_date").alias("_first"),
        F.max("created_date").alias("_last"),
        F.collect_set("subreddit").alias("_where"),
    )
    post, comment = F.col("is_post"), ~F.col("is_post")
    return per_id.groupBy("username").agg(
        F.count_if(post).alias("post_count"),
        F.count_if(comment).alias("comment_count"),
        _mean(F.when(post, F.col("_total")), F.when(post, F.col("_n"))).alias("avg_post_score"),
        _mean(F.when(comment, F.col("_total")), F.when(comment, F.col("_n"))).alias("avg_comment_score"),
        F.min("_first").alias("first_seen"),
        F.max("_last").alias("last_seen"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("_where")))).alias("active_subreddits"),
    )


def user_activity_merge(posts: DataFrame, comments: DataFrame, subreddits: DataFrame) -> DataFrame:
    """The same table from one aggregate per side; counts rows, not distinct ids."""
    own, replies = _authored(posts, comments, subreddits)

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("username").agg(
            F.count("id").alias(f"{name}_count"),
            F.avg("score").alias(f"avg_{name}_score"),
            F.min("created_date").alias(f"_{name}_first"),
            F.max("created_date").alias(f"_{name}_last"),
            F.collect_set("subreddit").alias(f"_{name}_where"),
        )

    none = F.array().cast("array<string>")
    merged = side(own, "post").join(side(replies, "comment"), "username", "full_outer")
    subs = F.array_union(F.coalesce("_post_where", none), F.coalesce("_comment_where", none))
    return merged.select(
        "username",
        F.coalesce("post_count", F.lit(0)).alias("post_count"),
        F.coalesce("comment_count", F.lit(0)).alias("comment_count"),
        # A user found on one side only gets 0 for the other; a side whose scores are all NULL stays NULL.
        F.when(F.col("post_count").isNull(), 0.0).otherwise(F.col("avg_post_score")).alias("avg_post_score"),
        F.when(F.col("comment_count").isNull(), 0.0).otherwise(F.col("avg_comment_score")).alias("avg_comment_score"),
        F.least("_post_first", "_comment_first").alias("first_seen"),
        F.greatest("_post_last", "_comment_last").alias("last_seen"),
        F.sort_array(subs).alias("active_subreddits"),
    )
