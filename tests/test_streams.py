"""Streams over three micro-batches: lookups by filter, counts behind the posts, weeks that close."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from threadloom.streaming import upserts as S

ENVELOPE = "topic string, key string, value string, timestamp timestamp"


def post(i, author="ann", score=1, title="t", sub="s1"):
    body = {"id": f"p{i}", "title": title, "author": author, "score": score, "subreddit": sub, "created_utc": 1.0, "created_date": "2024-01-01 00:00:00"}
    return ("posts", f"p{i}", json.dumps(body))


def comment(i, on, author="bob", score=1):
    body = {"id": f"c{i}", "post_id": on, "body": "text", "author": author, "score": score, "created_utc": 1.0}
    return ("comments", f"c{i}", json.dumps(body))


def envelopes(spark, messages, day):
    return spark.createDataFrame([(*m, dt.datetime(2024, 2, day)) for m in messages], ENVELOPE)


def test_posts_and_comments_over_three_batches(spark, tmp_path):
    root = str(tmp_path / "store")
    batches = [
        [post(1), post(2, sub="s2"), post(1, score=5), ("posts", "x", "{bad"), comment(1, "p1"), comment(2, "p9")],
        [post(3, sub="s3"), post(1, score=7, title="new"), comment(1, "p1", score=4), comment(3, "p3"), comment(4, "p2", author=None)],
        [post(4, sub="s1"), comment(5, "p4"), comment(6, None), comment(7, "nowhere")],
    ]
    for n, batch in enumerate(batches):
        sent = envelopes(spark, batch, n + 1)
        for _ in range(2 if n == 1 else 1):  # the second batch is delivered twice
            S.apply_posts(sent, n, root)
            S.apply_comments(sent, n, root)
    posts = S.stored_posts(spark, root).join(S.stored_subreddits(spark, root), "subreddit_id")
    assert rows(posts, "post_id", "title", "score", "name") == [("p1", "t", 7, "s1"), ("p2", "t", 1, "s2"), ("p3", "t", 1, "s3"), ("p4", "t", 1, "s1")]
    assert rows(S.stored_comments(spark, root), "comment_id", "author", "score") == [
        ("c1", "bob", 4), ("c3", "bob", 1), ("c4", "[deleted]", 1), ("c5", "bob", 1),
    ]
    assert sorted(r.subreddit_id for r in S.stored_subreddits(spark, root).collect()) == [1, 2, 3]
    assert spark.read.parquet(f"{root}/rejected_posts").count() == 1
    with pytest.raises(ValueError):  # another checkpoint, or one that is ahead
        S.apply_posts(envelopes(spark, batches[0], 4), 0, root)
    with pytest.raises(ValueError):
        S.apply_posts(envelopes(spark, batches[0], 4), 9, root)


def test_activity_counts_known_posts_only_and_batches_once(spark, tmp_path):
    root = str(tmp_path / "store")
    S.apply_posts(envelopes(spark, [post(1), post(2)], 1), 0, root)
    batches = [
        [post(1), post(2, author="cy"), comment(1, "p1"), comment(2, "unknown")],
        [comment(3, "p2", author="ann"), comment(3, "p2", author="ann"), post(8, author="[deleted]"), comment(4, "p8", author="")],
        [post(9, author="dan"), comment(5, "p9", author="dan"), ("comments", "bad", "{")],
    ]
    for n, batch in enumerate(batches):
        for _ in range(2):
            S.apply_activity(envelopes(spark, batch, n + 1), n, root)
    found = rows(S.stored_activity(spark, root).withColumns({c: F.day(c) for c in ("first_seen", "last_seen")}))
    assert found == [("ann", 1, 2, 1, 2), ("bob", 0, 1, 1, 1), ("cy", 1, 0, 1, 1), ("dan", 1, 1, 3, 3)]


def test_weeks_close_once_and_late_rows_go_aside(spark, tmp_path):
    root, source, checkpoint = (str(tmp_path / n) for n in ("store", "source", "checkpoint"))
    schema = "created_date timestamp, tech_mentioned array<string>, subreddit_id int"
    monday = dt.datetime(2024, 1, 1)

    def day(n):
        return monday + dt.timedelta(days=n)

    batches = [
        [(day(0), ["a", "b"], 1), (day(1), ["a"], 1), (day(6), ["a"], 2), (day(7), ["b"], 1), (None, ["a"], 1), (day(3), None, 1)],
        [(day(2), ["a"], 1), (day(22), ["a"], 1), (day(13), ["b"], 1)],  # watermark day 8: the first week closes
        [(day(3), ["a"], 1), (day(8), ["b"], 1), (day(40), ["c"], 1)],  # day 3 is late; watermark day 26
    ]
    pending = []
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        S.stream_closed_weeks(stream, root, checkpoint).awaitTermination()
        table = S.pending_weeks(root)
        pending.append(table.read(spark).count())
    week = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * n) for n in range(6)]
    assert rows(S.closed_weeks(spark, root)) == sorted([
        (week[0], "a", 1, 3), (week[0], "a", 2, 1), (week[0], "b", 1, 1), (week[1], "b", 1, 3),
    ], key=repr)
    assert rows(S.pending_weeks(root).read(spark)) == [(week[3], "a", 1, 1), (week[5], "c", 1, 1)]
    late = S.late_rows(spark, root, spark.createDataFrame([], schema).schema)
    assert rows(late, "created_date") == [(None,), (day(3),)]
    assert pending == [4, 2, 2]  # closed weeks leave what is kept
    # The last batch again changes nothing.
    S.apply_weeks(spark.createDataFrame(batches[2], schema), 2, root)
    assert S.closed_weeks(spark, root).count() == 4 and S.late_rows(spark, root, late.schema).count() == 2


def test_a_batch_is_read_and_decoded_once(spark, tmp_path):
    root = str(tmp_path / "store")
    sent = [
        post(1), post(2, sub=None), post(2, author=None, score=None), post(None), ("posts", "x", "{bad"), ("posts", "n", None),
        comment(1, "p1"), comment(1, "p1", score=4), comment(2, None), ("comments", "y", "{bad"),
    ]
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    batch = envelopes(spark, sent, 1).withColumn("value", F.udf(seen, "string")("value"))
    for apply, topic in ((S.apply_posts, "posts"), (S.apply_comments, "comments")):
        before = read.value
        apply(batch, 0, root)
        assert read.value - before == sum(m[0] == topic for m in sent)
    names = S.stored_subreddits(spark, root)
    posts = S.stored_posts(spark, root).join(names, "subreddit_id", "left")
    found = rows(posts, "post_id", "author", "score", "name")
    assert [r for r in found if r[0] != "p2"] == [("p1", "ann", 1, "s1"), ("pNone", "ann", 1, "s1")]
    assert [r[0] for r in found] == ["p1", "p2", "pNone"] and rows(names, "name") == [("s1",)]
    assert rows(S.stored_comments(spark, root), "comment_id", "post_id", "score") in ([("c1", "p1", 1)], [("c1", "p1", 4)])
    assert rows(spark.read.parquet(f"{root}/rejected_posts"), "_corrupt") == [("{bad",)]
    assert rows(spark.read.parquet(f"{root}/rejected_comments"), "_corrupt") == [("{bad",)]
