"""Raw records to clean rows: checks, defaults, feed union and cap, reply trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType
from pyspark.sql.window import Window

from threadloom.functions.binding import let
from threadloom.sizing import cut_lineage

DELETED = "[deleted]"
POST_REQUIRED = ["id", "subreddit"]
COMMENT_REQUIRED = ["id", "post_id"]
FLAGS = ["is_self", "is_video", "over_18", "is_submitter"]

# The ranked feeds of a community.
FEEDS = ["hot", "new", "top", "controversial"]


def has_required(columns: list[str]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & (F.coalesce(F.col(name), F.lit("")) != "")
    return present


def validate_required(records: DataFrame, columns: list[str]) -> DataFrame:
    return records.where(has_required(columns))


def rejected(records: DataFrame, columns: list[str]) -> DataFrame:
    return records.where(~has_required(columns))


def drop_stickied(records: DataFrame) -> DataFrame:
    return records.where(~F.coalesce("stickied", F.lit(False)))


def normalise_author(records: DataFrame) -> DataFrame:
    return records.withColumn("author", F.coalesce("author", F.lit(DELETED)))


def known_authors(rows: DataFrame) -> DataFrame:
    """Rows with an author that still exists."""
    return rows.where(F.col("author") != DELETED)


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds with a fraction to a timestamp of whole seconds."""
    return F.timestamp_seconds(F.floor(seconds))


def default_flags(records: DataFrame) -> DataFrame:
    return records.withColumns(
        {name: F.coalesce(name, F.lit(False)) for name in FLAGS if name in records.columns}
    )


def post_rows(records: DataFrame, required: list[str] | None = None, *keep: str) -> DataFrame:
    """Valid post records with the table's names and types; the subreddit is still a name. `keep` adds columns."""
    clean = default_flags(normalise_author(validate_required(records, required or POST_REQUIRED)))
    return clean.select(
        F.col("id").alias("post_id"),
        *["subreddit", "title", "text", "url", "author", "score", "upvote_ratio", "num_comments"],
        F.col("created_utc").cast("bigint").alias("created_utc"),
        F.to_timestamp("created_date").alias("created_date"),
        *["is_self", "is_video", "over_18", "permalink", "link_flair_text", "collected_utc"],
        *keep,
    )


def comment_rows(records: DataFrame, required: list[str] | None = None, *keep: str) -> DataFrame:
    clean = default_flags(normalise_author(validate_required(records, required or COMMENT_REQUIRED)))
    return clean.select(
        F.col("id").alias("comment_id"),
        *["post_id", "parent_id", "body", "author", "score"],
        F.col("created_utc").cast("bigint").alias("created_utc"),
        F.to_timestamp("created_date").alias("created_date"),
        *["is_submitter", "collected_utc"],
        *keep,
    )


def feed_union(feeds: dict[str, DataFrame]) -> DataFrame:
    """All feeds in one frame with their sort_type; a feed of unknown name counts as hot."""
    parts = [
        frame.withColumn("sort_type", F.lit(name if name in FEEDS else "hot")) for name, frame in feeds.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def feed_cap(records: DataFrame, per_feed: int) -> DataFrame:
    """The first per_feed posts that are not pinned, of every subreddit and feed, in feed order.

    A hot feed is cut in 64 salted parts first, so that no task ever sorts all of it.
    """
    order = [F.col("feed_pos"), F.col("id")]
    kept = drop_stickied(records)
    salt = F.pmod(F.xxhash64("id"), F.lit(64))
    parts = Window.partitionBy("subreddit", "sort_type", salt).orderBy(*order)
    kept = kept.withColumn("_rank", F.row_number().over(parts)).where(F.col("_rank") <= per_feed).drop("_rank")
    feed = Window.partitionBy("subreddit", "sort_type").orderBy(*order)
    return kept.withColumn("_rank", F.row_number().over(feed)).where(F.col("_rank") <= per_feed).drop("_rank")


def _tree_type(fields: StructType, levels: int) -> ArrayType:
    """Comments with their replies parsed `levels` deep; deeper replies stay JSON text."""
    replies = StringType() if levels == 1 else _tree_type(fields, levels - 1)
    return ArrayType(StructType([*fields.fields, StructField("replies", replies)]))


def flatten_replies(trees: DataFrame, fields: StructType, levels_at_once: int = 4) -> DataFrame:
    """The rows of reply_tables without its rejects."""
    return reply_tables(trees, fields, levels_at_once)[0]


def reply_tables(trees: DataFrame, fields: StructType, levels_at_once: int = 4) -> tuple[DataFrame, DataFrame]:
    """Comment trees to flat rows, and the texts that do not parse: (post_id, parent, comments).

    `trees` has post_id and `comments`, the JSON array of top-level comments; a comment has `fields` (with id and
    parent_id) and an optional array `replies`. A reply's parent_id is the enclosing comment's id, a top-level
    comment keeps its own. Each round parses the JSON once and takes several levels inside the row; what lies deeper
    is the input of the next round, stored so that no round repeats an earlier one. Rounds go on until no deeper text
    is left. A null, blank or `null` text has no comments; any other that is no array of comments is a reject, with the
    comment it hangs under as `parent`.
    """
    names = [f.name for f in fields if f.name != "parent_id"]
    own = lambda node: [node[name].alias(name) for name in names]

    def below(node: Column) -> Column:
        return F.transform(
            node["replies"],
            lambda r: F.struct(node["id"].alias("parent_id"), *own(r), r["replies"].alias("replies")),
        )

    def flat_levels(roots: Column) -> Column:
        """Struct of all nodes found in this round and of the deeper JSON with its parents."""

        def collect(level: Column, found: Column, left: int) -> Column:
            here = F.transform(level, lambda n: F.struct(n["parent_id"].alias("parent_id"), *own(n)))
            found = here if found is None else F.concat(found, here)
            if left == 1:
                deeper = F.filter(level, lambda n: n["replies"].isNotNull())
                rest = F.transform(
                    deeper, lambda n: F.struct(n["id"].alias("parent"), n["replies"].alias("comments"))
                )
                return F.struct(found.alias("nodes"), rest.alias("rest"))
            children = F.filter(F.transform(level, below), lambda c: c.isNotNull())
            return let(F.flatten(children), lambda next_level: collect(next_level, found, left - 1))

        return let(roots, lambda level: collect(level, None, levels_at_once))

    spec = _tree_type(fields, levels_at_once)
    pending = trees.select("post_id", F.lit(None).cast("string").alias("parent"), "comments")
    pieces = rejects = None
    while True:
        roots = F.transform(
            F.from_json("comments", spec),
            lambda n: F.struct(
                F.coalesce("parent", n["parent_id"]).alias("parent_id"), *own(n), n["replies"].alias("replies")
            ),
        )
        flat = pending.select("post_id", "parent", "comments", flat_levels(roots).alias("found"))
        blank = F.trim(F.coalesce("comments", F.lit(""))).isin("", "null")
        unparsed = F.when(F.col("found.nodes").isNull() & ~blank, F.col("comments"))
        stored = cut_lineage(flat.select("post_id", "parent", unparsed.alias("comments"), "found"), "replies")
        piece = stored.select("post_id", F.explode("found.nodes").alias("node")).select("post_id", "node.*")
        reject = stored.where("comments is not null").select("post_id", "parent", "comments")
        pieces = piece if pieces is None else pieces.unionByName(piece)
        rejects = reject if rejects is None else rejects.unionByName(reject)
        pending = stored.select("post_id", F.explode("found.rest").alias("rest")).select("post_id", "rest.*")
        if pending.isEmpty():
            return pieces, rejects
