"""Dimensions, gates and keyed merges. A merge is one aggregation over old and new rows, so that copies of a key are
reduced in each task before the shuffle and a key with very many copies stays cheap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from threadloom.operators.normalise import has_required
from threadloom.sizing import broadcast_if_small
from threadloom.sources.buckets import BucketTable

POST_UPDATES = ["score", "upvote_ratio", "num_comments", "collected_utc"]
COMMENT_UPDATES = ["score", "collected_utc"]


def upsert_dimension(dim: DataFrame, names: DataFrame, key: str = "subreddit_id", name: str = "name") -> DataFrame:
    """The dimension plus a new id for every new name; existing ids stay.

    Ids follow the order of the names' md5. Its first three digits split the new names into at most 4096 even
    buckets: bucket sizes give the offsets and each bucket is numbered on its own, so no task sees all names.
    """
    fresh = (
        names.select(name)
        .where(F.coalesce(name, F.lit("")) != "")
        .distinct()
        .join(dim.select(name), name, "left_anti")
        .withColumn("_digest", F.md5(F.col(name).cast("binary")))
        .withColumn("_bucket", F.substring("_digest", 1, 3))
    )
    sizes = fresh.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_digest", name))
    last = dim.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    numbered = fresh.join(F.broadcast(offsets), "_bucket").select(
        (last + F.col("_offset") + inside).cast("int").alias(key), name
    )
    return dim.unionByName(numbered, allowMissingColumns=True)


def lookup_dimension(
    rows: DataFrame, dim: DataFrame, source: str = "subreddit", key: str = "subreddit_id", keep_unknown: bool = True
) -> DataFrame:
    """Replace the name in `source` by the id; an unknown name gives NULL, or drops the row."""
    ids = broadcast_if_small(dim.select(F.col("name").alias(source), key))
    return rows.join(ids, source, "left" if keep_unknown else "inner").drop(source)


def referential_gate(comments: DataFrame, posts: DataFrame) -> DataFrame:
    return comments.join(posts.select("post_id"), "post_id", "left_semi")


def unknown_posts(comments: DataFrame, posts: DataFrame) -> DataFrame:
    return comments.join(posts.select("post_id"), "post_id", "left_anti")


def _stacked(old: DataFrame, new: DataFrame, order: list[str | Column]) -> DataFrame:
    """Old and new rows with `_age`: old rows first, then new rows by `order`."""
    exprs = [F.col(o) if isinstance(o, str) else o for o in order]
    tie = [F.col(c) for c in sorted(new.columns)]
    ranked = new.withColumn("_order", F.struct(*[e.alias(f"o{i}") for i, e in enumerate(exprs)]))
    ranked = ranked.withColumn("_tie", F.xxhash64(*tie))
    merged = old.unionByName(ranked, allowMissingColumns=True)
    return merged.select(
        *[c for c in merged.columns if c not in ("_order", "_tie")],
        F.struct(F.col("_tie").isNotNull().alias("fresh"), "_order", "_tie").alias("_age"),
    )


def upsert_partial(
    old: DataFrame, new: DataFrame, keys: list[str], updates: list[str], order: list[str | Column]
) -> DataFrame:
    """Per key the columns in `updates` of its latest row and all others of its first row."""
    both = _stacked(old, new, order)
    kept = [c for c in both.columns if c not in [*keys, *updates, "_age"]]
    merged = both.groupBy(*keys).agg(
        F.min_by(F.struct(*kept), "_age").alias("_first"), F.max_by(F.struct(*updates), "_age").alias("_last")
    )
    source = {**{c: f"_first.{c}" for c in kept}, **{c: f"_last.{c}" for c in updates}}
    columns = [c for c in both.columns if c != "_age"]
    return merged.select(*[F.col(source.get(c, c)).alias(c) for c in columns])


def upsert_full(old: DataFrame, new: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """Per key the whole latest row."""
    both = _stacked(old, new, order)
    rest = [c for c in both.columns if c not in [*keys, "_age"]]
    merged = both.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_age").alias("_last"))
    columns = [c for c in both.columns if c != "_age"]
    return merged.select(*[F.col(c if c in keys else f"_last.{c}").alias(c) for c in columns])


def _age(rows: DataFrame, order: list[str]) -> Column:
    """Order of copies of a key; equal ones are told apart by all their columns."""
    return F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.xxhash64(*sorted(rows.columns)).alias("tie"))


def first_and_last(rows: DataFrame, keys: list[str], updates: list[str], order: list[str]) -> DataFrame:
    """Per key the columns in `updates`, if they are there, of its latest row and all others of its first row."""
    kept = [c for c in rows.columns if c not in [*keys, *updates]]
    updates = [c for c in updates if c in rows.columns]
    age = _age(rows, order)
    # Without a column on one side its struct would be empty; the keys stand in.
    first, last = F.struct(*(kept or keys)), F.struct(*(updates or keys))
    both = rows.groupBy(*keys).agg(F.min_by(first, age).alias("_first"), F.max_by(last, age).alias("_last"))
    return both.select(*keys, *[f"_first.{c}" for c in kept], *[f"_last.{c}" for c in updates])


def latest_rows(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key its whole latest row."""
    rest = [c for c in rows.columns if c not in keys]
    found = rows.groupBy(*keys).agg(F.max_by(F.struct(*(rest or keys)), _age(rows, order)).alias("_last"))
    return found.select(*keys, *[f"_last.{c}" for c in rest])


def _sides(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Both sides, one row per key each, as structs `_old` and `_new`; rows without a partner pass through the join alone."""
    old = base.select(F.struct(*base.columns).alias("_old"))
    new = changes.select(F.struct(*base.columns).alias("_new"))
    same = [F.col(f"_old.{k}").eqNullSafe(F.col(f"_new.{k}")) for k in keys]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return old.join(new, condition, "full_outer")


def join_partial(base: DataFrame, changes: DataFrame, keys: list[str], updates: list[str]) -> DataFrame:
    """base with the `updates` columns of changes and the keys it lacks."""

    def pick(c: str) -> Column:
        wins, other = ("_new", "_old") if c in updates else ("_old", "_new")
        return F.when(F.col(wins).isNotNull(), F.col(f"{wins}.{c}")).otherwise(F.col(f"{other}.{c}")).alias(c)

    return _sides(base, changes, keys).select(*[pick(c) for c in base.columns])


def join_full(base: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """base with the rows of changes in the place of its own and the keys it lacks."""
    return _sides(base, changes, keys).select(F.coalesce("_new", "_old").alias("_row")).select("_row.*")


def partial_table(path: str, schema: StructType, keys: list[str], updates: list[str], **options) -> BucketTable:
    """A stored table whose rows keep their first version but for the columns in `updates`."""
    return BucketTable(
        path, schema, tuple(keys), lambda rows, order: first_and_last(rows, keys, updates, order),
        lambda base, changes: join_partial(base, changes, keys, updates), **options,
    )


def full_table(path: str, schema: StructType, keys: list[str], **options) -> BucketTable:
    """A stored table whose rows are those that came last."""
    return BucketTable(
        path, schema, tuple(keys), lambda rows, order: latest_rows(rows, keys, order), lambda base, changes: join_full(base, changes, keys), **options
    )


def merge_columns(old: DataFrame, new: DataFrame, keys: list[str], updates: list[str]) -> DataFrame:
    """Write the `updates` columns of `new` (one row per key) over `old`, adding the keys it lacks."""
    fresh = new.select(*keys, F.struct(*updates).alias("_new"))
    joined = old.join(fresh, keys, "full_outer")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in updates else c
            for c in old.columns
        ]
    )


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def load_outcomes(
    records: DataFrame, stored: DataFrame, id_column: str, required: list[str], known: DataFrame | None = None
) -> DataFrame:
    """Outcome of every raw record: error, skipped, inserted or updated.

    Per id the first usable record inserts when the id is not stored yet, all further ones update. `known` holds the
    ids of posts for comments; comments of other posts are skipped. `_corrupt` marks records that failed to parse.
    """
    corrupt = F.col("_corrupt").isNotNull() if "_corrupt" in records.columns else F.lit(False)
    usable = has_required(required)
    tagged = records.withColumn("_error", corrupt).withColumn("_usable", usable & ~corrupt)
    if known is not None:
        gate = known.select("post_id").distinct().withColumn("_known", F.lit(True))
        tagged = tagged.join(gate, "post_id", "left").withColumn(
            "_usable", F.col("_usable") & F.coalesce("_known", F.lit(False))
        )
    bad = tagged.where(~F.col("_usable")).groupBy("_error").agg(F.count("*").alias("records"))
    bad = bad.select(F.when(F.col("_error"), "error").otherwise("skipped").alias("outcome"), "records")
    per_id = tagged.where("_usable").groupBy(F.col("id").alias(id_column)).agg(F.count("*").alias("n"))
    stored_ids = stored.select(id_column).distinct().withColumn("_stored", F.lit(True))
    split = per_id.join(stored_ids, id_column, "left").select(
        F.when(F.col("_stored"), F.lit(0)).otherwise(F.lit(1)).alias("inserted"), "n"
    )
    good = split.agg(F.sum("inserted").alias("inserted"), F.sum(F.col("n") - F.col("inserted")).alias("updated"))
    good = good.select(
        F.explode(
            F.array(
                F.struct(F.lit("inserted").alias("outcome"), F.col("inserted").alias("records")),
                F.struct(F.lit("updated").alias("outcome"), F.col("updated").alias("records")),
            )
        ).alias("cell")
    ).select("cell.*")
    return bad.unionByName(good).where("records > 0")


def load_stats(outcomes: DataFrame) -> DataFrame:
    """One row: processed, inserted, updated, skipped, errors."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("outcome") == name, F.col("records"))), F.lit(0))

    return outcomes.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("processed"),
        total("inserted").alias("inserted"),
        total("updated").alias("updated"),
        total("skipped").alias("skipped"),
        total("error").alias("errors"),
    )
