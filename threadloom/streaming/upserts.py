"""Streams of posts and comments into keyed tables.

Posts, comments, subreddits and author counts are bucketed tables (sources.buckets) whose version is the number of the
micro-batch: batch N makes version N out of version N - 1. A batch that runs again replaces its own version, so redelivery
after a failure changes nothing; it writes only what it holds, and a bucket with many changes is rewritten by the batch
that finds it so. A table belongs to one checkpoint. Comments are let through by the posts' filters, so a batch opens
only the buckets of posts that its comments may belong to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructType

from threadloom.operators.merge import COMMENT_UPDATES, POST_UPDATES, full_table, lookup_dimension, partial_table, upsert_dimension
from threadloom.operators.normalise import comment_rows, known_authors, post_rows
from threadloom.operators.trends import week_number
from threadloom.schemas import COMMENT_RECORD, POST_RECORD, struct
from threadloom.sources.buckets import BucketTable
from threadloom.sources.records import dead_letters, decode_messages, well_formed

POSTS_TOPIC, COMMENTS_TOPIC = "posts", "comments"
DIMENSION = struct("subreddit_id int, name string")
ACTIVITY = struct("username string, post_count bigint, comment_count bigint, first_seen timestamp, last_seen timestamp")


def post_table(spark: SparkSession, root: str, **options) -> BucketTable:
    rows = post_rows(spark.createDataFrame([], POST_RECORD)).drop("subreddit")
    schema = StructType(list(rows.schema)).add("subreddit_id", IntegerType())
    return partial_table(f"{root}/posts", schema, ["post_id"], POST_UPDATES, **options)


def comment_table(spark: SparkSession, root: str, **options) -> BucketTable:
    schema = comment_rows(spark.createDataFrame([], COMMENT_RECORD)).schema
    return partial_table(f"{root}/comments", schema, ["comment_id"], COMMENT_UPDATES, **options)


def subreddit_table(root: str) -> BucketTable:
    return full_table(f"{root}/subreddits", DIMENSION, ["name"], buckets=4, filtered=False)


def _sum_activity(rows: DataFrame, order: list[str]) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("post_count", "comment_count")]
    return rows.groupBy("username").agg(*sums, F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def activity_table(root: str, **options) -> BucketTable:
    return BucketTable(f"{root}/activity", ACTIVITY, ("username",), _sum_activity, filtered=False, **options)


def version_before(spark: SparkSession, table: BucketTable, batch_id: int) -> int | None:
    """The version that batch_id goes on from."""
    if batch_id == 0:
        last = table.latest(spark)
        if last:
            raise ValueError(f"{table.path} was written by another checkpoint, up to batch {last}")
        return None
    if not table.complete(spark, batch_id - 1):
        raise ValueError(f"{table.path} has no batch {batch_id - 1}, which the checkpoint has")
    return batch_id - 1


def _advance(table: BucketTable, rows: DataFrame, batch_id: int, order: list[str]) -> None:
    table.apply(rows, batch_id, order, version_before(rows.sparkSession, table, batch_id))


def write_rejects(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch's rejects; the same batch again replaces what it wrote before."""
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


@contextmanager
def _kept(rows: DataFrame) -> Iterator[DataFrame]:
    """rows, persisted while they are read several times."""
    rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def stored_posts(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    return post_table(spark, root).read(spark, columns=columns)


def stored_comments(spark: SparkSession, root: str) -> DataFrame:
    return comment_table(spark, root).read(spark)


def stored_subreddits(spark: SparkSession, root: str) -> DataFrame:
    return subreddit_table(root).read(spark)


def stored_activity(spark: SparkSession, root: str) -> DataFrame:
    return activity_table(root).read(spark)


def apply_posts(envelopes: DataFrame, batch_id: int, root: str, topic: str = POSTS_TOPIC) -> None:
    spark = envelopes.sparkSession
    names, posts = subreddit_table(root), post_table(spark, root)
    # A batch run again must not see the ids it gave the first time.
    before, posts_before = version_before(spark, names, batch_id), version_before(spark, posts, batch_id)
    # Kept as records: names, rows and rejects each parsed the batch's JSON again when its messages were kept.
    with _kept(decode_messages(envelopes, topic, POST_RECORD)) as decoded:
        # The rejects are one pass, which fills what is kept; the names are two at a time, which would each decode the batch.
        write_rejects(dead_letters(decoded), f"{root}/rejected_posts", batch_id)
        rows = post_rows(well_formed(decoded), ["id"], "received")
        known = names.read(spark, before) if before is not None else spark.createDataFrame([], DIMENSION)
        fresh = upsert_dimension(known, rows.select(F.col("subreddit").alias("name"))).join(known, "subreddit_id", "left_anti")
        names.apply(fresh.select("subreddit_id", "name"), batch_id, [], before)
        posts.apply(lookup_dimension(rows, names.read(spark, batch_id)), batch_id, ["received"], posts_before, persisted=True)


def apply_comments(envelopes: DataFrame, batch_id: int, root: str, topic: str = COMMENTS_TOPIC) -> None:
    """Comments of posts that are not stored yet are dropped."""
    spark = envelopes.sparkSession
    with _kept(decode_messages(envelopes, topic, COMMENT_RECORD)) as decoded:
        rows = comment_rows(well_formed(decoded), ["id"], "received")
        _advance(comment_table(spark, root), post_table(spark, root).known(rows), batch_id, ["received"])
        write_rejects(dead_letters(decoded), f"{root}/rejected_comments", batch_id)


def apply_activity(envelopes: DataFrame, batch_id: int, root: str) -> None:
    """Add the posts and comments of both topics to the counts of their authors.

    A comment counts when its post is stored, or came in the same batch. Authors that are null, empty or deleted have no
    counts. A message that comes again in a later batch counts again; a batch that runs again does not.
    """
    spark = envelopes.sparkSession
    posts = post_rows(well_formed(decode_messages(envelopes, POSTS_TOPIC, POST_RECORD)), None, "received")
    comments = comment_rows(well_formed(decode_messages(envelopes, COMMENTS_TOPIC, COMMENT_RECORD)), None, "received")
    table = post_table(spark, root)
    fresh = posts.select("post_id").distinct()
    known = table.known(comments.join(fresh, "post_id", "left_anti")).unionByName(comments.join(fresh, "post_id", "left_semi"))
    both = posts.select("author", "received", F.lit(True).alias("is_post")).unionByName(known.select("author", "received", F.lit(False).alias("is_post")))
    _advance(activity_table(root), user_activity_counts(both), batch_id, [])


def _on_kept(apply: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """apply, on batches that are persisted as they came."""

    def run(batch: DataFrame, batch_id: int) -> None:
        with _kept(batch):
            apply(batch, batch_id)

    return run


def _start(
    envelopes: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    writer = envelopes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_upsert_posts(
    envelopes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, topic: str = POSTS_TOPIC
) -> StreamingQuery:
    """Start the post stream; without a trigger it takes all available data and stops."""
    return _start(envelopes, partial(apply_posts, root=root, topic=topic), checkpoint, trigger)


def stream_upsert_comments(
    envelopes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, topic: str = COMMENTS_TOPIC
) -> StreamingQuery:
    return _start(envelopes, partial(apply_comments, root=root, topic=topic), checkpoint, trigger)


def stream_activity_table(envelopes: DataFrame, root: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start the counts of authors over both topics, behind the posts stored in root."""
    return _start(envelopes, _on_kept(partial(apply_activity, root=root)), checkpoint, trigger)


def user_activity_counts(messages: DataFrame) -> DataFrame:
    """Running counts per author over (author, is_post, received): every message counts, also a repeated one.

    Works on a stream (update or complete mode) and on a batch frame alike.
    """
    return (
        known_authors(messages.where(F.coalesce("author", F.lit("")) != ""))
        .groupBy(F.col("author").alias("username"))
        .agg(
            F.count_if("is_post").alias("post_count"),
            F.count_if(~F.col("is_post")).alias("comment_count"),
            F.min("received").alias("first_seen"),
            F.max("received").alias("last_seen"),
        )
    )


def distinct_messages(messages: DataFrame, key: str = "id", delay: str = "1 day") -> DataFrame:
    """Optional step before counting: drop redelivered messages that arrive within the delay."""
    return messages.withWatermark("received", delay).dropDuplicatesWithinWatermark([key, "is_post"])


def weekly_mentions(rows: DataFrame, delay: str = "14 days") -> DataFrame:
    """Mentions per week, name and subreddit of a stream of (created_date, tech_mentioned, subreddit_id).

    Weeks start on Monday: the epoch was a Thursday, hence the offset of four days.
    """
    dated = rows.withWatermark("created_date", delay) if rows.isStreaming else rows
    exploded = dated.select("created_date", F.explode("tech_mentioned").alias("tech_name"), "subreddit_id")
    week = F.window("created_date", "7 days", startTime="4 days")
    return (
        exploded.groupBy(week.alias("week"), "tech_name", "subreddit_id")
        .agg(F.count("*").alias("mention_count"))
        .select("tech_name", F.col("week.start").cast("date").alias("week_start"), "subreddit_id", "mention_count")
    )


PENDING = struct("week_start date, tech_name string, subreddit_id int, mention_count bigint")


def _sum_mentions(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.groupBy("week_start", "tech_name", "subreddit_id").agg(F.sum("mention_count").alias("mention_count"))


def pending_weeks(root: str, **options) -> BucketTable:
    """Counts of weeks that may still grow, one bucket a week."""
    return BucketTable(
        f"{root}/pending", PENDING, ("week_start", "tech_name", "subreddit_id"), _sum_mentions, bucket=week_number(), filtered=False, **options
    )


CLOCK = struct("watermark timestamp")


def _watermark(spark: SparkSession, root: str, version: int | None) -> int | None:
    """Microseconds since the epoch."""
    return None if version is None else spark.read.schema(CLOCK).parquet(f"{root}/clock/version={version}").select(F.unix_micros("watermark")).first()[0]


def _over(mark: int | None) -> Column:
    """True for weeks whose end the watermark has reached."""
    if mark is None:
        return F.lit(False)
    return F.coalesce(F.date_add("week_start", 7).cast("timestamp") <= F.timestamp_micros(F.lit(mark)), F.lit(False))


def apply_weeks(rows: DataFrame, batch_id: int, root: str, delay: str = "14 days") -> None:
    """Count the mentions of a batch of (created_date, tech_mentioned, subreddit_id) and close the weeks that are over.

    The watermark is the latest created_date of all batches so far, less the delay. A week closes with the first batch
    whose watermark reaches its end: its counts go to `weeks` once, and leave the pending counts. Rows of weeks closed by
    an earlier batch, and rows without a date, go to `late` as they came.
    """
    spark = rows.sparkSession
    table = pending_weeks(root)
    before = version_before(spark, table, batch_id)
    mark = _watermark(spark, root, before)
    dated = rows.withColumn("week_start", F.date_trunc("week", "created_date").cast("date"))
    late = F.col("week_start").isNull() | _over(mark)
    write_rejects(dated.where(late).drop("week_start"), f"{root}/late", batch_id)

    newest = rows.agg(F.unix_micros(F.max("created_date") - F.expr(f"INTERVAL {delay}"))).first()[0]
    mark = max((m for m in (mark, newest) if m is not None), default=None)
    open_rows = dated.where(~late).select("week_start", F.explode("tech_mentioned").alias("tech_name"), "subreddit_id")
    counts = open_rows.withColumn("mention_count", F.lit(1).cast("long"))
    stored = [(e.bucket,) for e in table.entries(spark, before)]
    weeks = spark.createDataFrame(stored, "number int").distinct().withColumn("week_start", F.date_from_unix_date(F.col("number") * 7 + 4))
    closed = {r.number for r in weeks.where(_over(mark)).toLocalIterator()}
    final = counts.where(_over(mark)).unionByName(table.read(spark, before, closed)) if closed else counts.where(_over(mark))
    write_rejects(_sum_mentions(final, []), f"{root}/weeks", batch_id)
    table.apply(counts.where(~_over(mark)), batch_id, [], before, closed)
    clock = spark.createDataFrame([(mark,)], "mark bigint").select(F.timestamp_micros("mark").alias("watermark"))
    clock.coalesce(1).write.mode("overwrite").parquet(f"{root}/clock/version={batch_id}")


def closed_weeks(spark: SparkSession, root: str) -> DataFrame:
    """Counts that are final."""
    return spark.read.schema(PENDING).parquet(f"{root}/weeks").select(*PENDING.names)


def late_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Rows that came after their week was closed, or without a date."""
    return spark.read.schema(schema).parquet(f"{root}/late").select(*schema.names)


def stream_closed_weeks(rows: DataFrame, root: str, checkpoint: str, delay: str = "14 days", trigger: dict | None = None) -> StreamingQuery:
    """Start the weekly counts that are final: each week is written once."""
    return _start(rows, _on_kept(partial(apply_weeks, root=root, delay=delay)), checkpoint, trigger)
