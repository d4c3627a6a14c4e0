"""Views of the given tables as the engine's inputs.

Text: documents are posts, dated and authored by events; conversations are comments; pages are posts with markup.
Trade: orders are posts, lineitem gives their analysis and their comments, nations are subreddits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.sizing import spread
from threadloom.sources.tables import table_scan

# Dictionaries for the invented prose of the given texts: its frequent words play technologies and skills.
TEXT_TERMS = {
    "english": [("the", ["thing"], 0.9), ("with", ["than"], 0.8), ("from", [], 0.5)],
    "romance": [("les", ["des"], 0.7), ("que", ["qui", "pour"], 0.6)],
    "german": [("und", ["mit", "nicht"], 0.9), ("der", ["die", "das"], 0.4)],
}
TEXT_SKILLS = {
    "english": [("this", ["that"], 0.9), ("here", [], 0.5)],
    "others": [("los", ["las"], 0.7), ("sich", ["auf"], 0.6)],
}
TEXT_VALENCES = {
    "the": 0.3, "and": -0.2, "that": 1.1, "this": -1.4, "with": 0.8, "from": -0.9, "des": 0.5, "und": -0.6,
    "que": 0.7, "die": -0.4, "les": 1.2, "los": -1.0, "thing": 2.0, "is": 0.4,
}
TEXT_BOOSTERS = {"of": 0.293, "la": -0.293, "den": 0.293}
TEXT_NEGATIONS = ["in", "en", "zu", "not"]
TEXT_IDIOMS = {"the and": 1.7, "to the": -1.3, "of and": 0.6, "que de": -2.1, "is the is": 2.4, "the anea eriner": -0.8}
TEXT_PHRASE_BOOSTERS = {"a the": -0.293, "and and": 0.293, "to thanedble the": 0.293}
TEXT_POLARITIES = {"it": (0.5, 0.6), "les": (-0.4, 0.3), "von": (0.2, 0.9), "la": (-0.1, 0.1)}
TEXT_INTENSITIES = {"it": 1.3, "la": 0.7}
LEMMAS = {"thing": "the", "things": "the", "ther": "there", "then": "than", "unes": "une", "thnd": "and"}


TEXT_TABLES = ("documents", "pages", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a given table. Text tables, of which much is computed per row, are spread over the cores."""
    rows = table_scan(spark, f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in TEXT_TABLES else rows


def text_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw post records, with the fields the feeds have."""
    docs = load(spark, sf_dir, "documents")
    events = load(spark, sf_dir, "events").select(
        (F.col("event_id") / 5).cast("bigint").alias("doc_id"), F.col("event_id").alias("_event"), "ts", "user_id",
        "event_type", "value",
    ).where(F.col("doc_id") * 5 == F.col("_event"))
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    return docs.join(events, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.substring("text", 1, 80).alias("title"),
        "text",
        F.concat(F.lit("http://example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(kind != "error", F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("author"),
        F.floor("value").cast("int").alias("score"),
        F.lit(0.5).alias("upvote_ratio"),
        F.col("n_chars").cast("int").alias("num_comments"),
        (F.unix_micros(ts) / 1e6).alias("created_utc"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("created_date"),
        F.col("source").alias("subreddit"),
        F.when(kind == "click", F.lit("")).otherwise(F.concat(F.lit("/c/"), F.col("doc_id").cast("string"))).alias(
            "permalink"
        ),
        F.when(kind == "click", F.lit(True)).alias("is_self"),
        F.lit(None).cast("boolean").alias("is_video"),
        F.when(kind == "view", F.lit(False)).alias("over_18"),
        F.lit(False).alias("spoiler"),
        F.col("lang").alias("link_flair_text"),
        F.unix_seconds(ts).alias("collected_utc"),
        (kind == "error").alias("stickied"),
        F.col("doc_id").cast("int").alias("feed_pos"),
        "lang",
    )


def text_subreddits(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = load(spark, sf_dir, "documents").select(F.col("source").alias("name")).distinct()
    return names.select(F.substring("name", 4, 9).cast("int").alias("subreddit_id"), "name")


def text_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = text_records(spark, sf_dir)
    return r.select(
        F.col("id").alias("post_id"),
        F.substring("subreddit", 4, 9).cast("int").alias("subreddit_id"),
        *["title", "text", "author", "score", "num_comments", "permalink"],
        F.to_timestamp("created_date").alias("created_date"),
    )


def page_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("post_id"), F.col("url").alias("title"), F.col("html").alias("text")
    )


def comment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as raw comment records; system turns lack a post."""
    turns = load(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("int")
    return turns.select(
        F.concat_ws("_", conv, turn.cast("string")).alias("id"),
        F.when(F.col("role") != "system", conv).otherwise("").alias("post_id"),
        F.when(turn == 0, F.concat(F.lit("t3_"), conv))
        .otherwise(F.concat_ws("_", conv, (turn - 1).cast("string")))
        .alias("parent_id"),
        F.col("text").alias("body"),
        F.col("role").alias("author"),
        turn.alias("score"),
        F.col("conv_id").cast("double").alias("created_utc"),
        F.date_format(F.timestamp_seconds(F.col("conv_id") * 60 + turn), "yyyy-MM-dd HH:mm:ss").alias("created_date"),
        F.lit(None).cast("boolean").alias("is_submitter"),
        F.lit("talk").alias("subreddit"),
        F.col("turn").cast("bigint").alias("collected_utc"),
    )


def text_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    return r.select(F.concat_ws("_", conv, turn).alias("comment_id"), conv.alias("post_id"), F.col("text").alias("body"))


def trade_subreddits(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    return nation.select((F.col("n_nationkey") + 1).cast("int").alias("subreddit_id"), F.col("n_name").alias("name"))


def trade_posts(spark: SparkSession, sf_dir: str, with_comment_counts: bool = False) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal"
    )
    priority = F.col("o_orderpriority")
    title = (
        F.when(priority == "1-URGENT", "HIRING: urgent job")
        .when(priority == "2-HIGH", "Looking for a career?")
        .when(priority == "3-MEDIUM", "Weekly question?")
        .otherwise(priority)
    )
    key = F.col("o_orderkey").cast("string")
    rows = orders.join(customers, "o_custkey", "left").select(
        "o_orderkey",
        key.alias("post_id"),
        (F.col("c_nationkey") + 1).cast("int").alias("subreddit_id"),
        title.alias("title"),
        F.expr("repeat(concat(o_orderstatus, ' ', o_orderpriority, ' '), cast(1 + floor(o_totalprice / 20000) as int))").alias(
            "text"
        ),
        F.when(F.col("c_acctbal") < 0, "[deleted]").otherwise(
            F.concat(F.lit("u"), F.col("o_custkey").cast("string"))
        ).alias("author"),
        F.floor("o_totalprice").cast("int").alias("score"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.concat(F.lit("/comments/"), key)).alias("permalink"),
        F.col("o_orderdate").cast("timestamp").alias("created_date"),
    )
    if with_comment_counts:
        lines = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.count("*").cast("int").alias("_n")
        )
        rows = rows.join(lines, "o_orderkey", "left").withColumn("num_comments", F.coalesce("_n", F.lit(0))).drop("_n")
    return rows.drop("o_orderkey")


def trade_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: brands as technologies, types as skills; orders without lines have NULL arrays."""
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    percent: Column = F.round(F.col("l_discount") * 100).cast("bigint")
    per_order = (
        load(spark, sf_dir, "lineitem")
        .join(parts, "l_partkey")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sort_array(F.collect_set("p_brand")).alias("tech_mentioned"),
            F.sort_array(F.collect_set("p_type")).alias("skills_mentioned"),
            (F.sum(percent) / (5.0 * F.count("*")) - 1.0).alias("sentiment_score"),
        )
    )
    orders = load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("processed_date"))
    return orders.join(per_order, "o_orderkey", "left").select(
        F.col("o_orderkey").cast("string").alias("post_id"),
        "tech_mentioned",
        "skills_mentioned",
        "sentiment_score",
        "processed_date",
    )


def trade_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("comment_id"),
        F.col("l_orderkey").cast("string").alias("post_id"),
        F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("author"),
        F.col("l_quantity").cast("int").alias("score"),
        F.col("l_shipdate").cast("timestamp").alias("created_date"),
    )


def rounded(c: str | Column) -> Column:
    """Six places. The nudge moves exact halves off the edge, so that both engines round sums the same way."""
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column + 1e-9, 6)


def joined(c: str | Column) -> Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|")


def stamp(c: str | Column) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def digest(c: str | Column) -> Column:
    return F.md5((F.col(c) if isinstance(c, str) else c).cast("binary"))
