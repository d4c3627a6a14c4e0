"""Sources, normalisation, merges and streams over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import adapters as A
from checks.sql import COMMENT_RECORDS, TEXT_RECORDS, TRADE, r6, stamp, values
from threadloom.functions import text as X
from threadloom.operators import merge as M
from threadloom.operators import normalise as N
from threadloom.schemas import COMMENT_RECORD, POST_ANALYSIS, POST_RECORD, struct
from threadloom.sizing import work_dir
from threadloom.sources import dictionaries as D
from threadloom.sources import logs, records as R, tables
from threadloom.streaming import upserts as U


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return A.text_records(spark, sf).select(*POST_RECORD.fieldNames()[:17], F.lit("hot").alias("sort_type"), "collected_utc")


def _landed(rows: DataFrame, label: str) -> str:
    path = work_dir(rows.sparkSession, label)
    R.sink_raw_json(rows, path)
    return path




def scan_posts_json(spark, sf):
    found = R.scan_posts_json(spark, _landed(_records(spark, sf), "posts"), multi_line=False)
    return N.post_rows(R.well_formed(found)).select(
        "post_id", "subreddit", "title", A.digest("text").alias("text_md5"), "author", "score", "created_utc",
        A.stamp("created_date").alias("created_date"), "is_self", "is_video", "over_18", "permalink",
    )


SCAN_POSTS = f"""WITH {TEXT_RECORDS}
SELECT id AS post_id, subreddit, title, md5(text) AS text_md5, coalesce(author, '[deleted]') AS author, score, created_utc,
  {stamp('created_date')} AS created_date, event_type = 'click' AS is_self, false AS is_video, false AS over_18, permalink
FROM text_records"""


def scan_comments_json(spark, sf):
    rows = A.comment_records(spark, sf)
    found = R.well_formed(R.scan_comments_json(spark, _landed(rows, "comments"), multi_line=False))
    return N.comment_rows(found).select(
        "comment_id", "post_id", "parent_id", A.digest("body").alias("body_md5"), "author", "score",
        A.stamp("created_date").alias("created_date"), "is_submitter",
    )


SCAN_COMMENTS = f"""WITH {COMMENT_RECORDS}
SELECT id AS comment_id, post_id, parent_id, md5(body) AS body_md5, author, score, {stamp('created_date')} AS created_date,
  false AS is_submitter FROM comment_records WHERE post_id <> ''"""


def _post_envelopes(spark, sf) -> DataFrame:
    rows = _records(spark, sf)
    return R.keyed_json(rows).withColumns(
        {"topic": F.lit(U.POSTS_TOPIC), "timestamp": F.lit("2024-02-01").cast("timestamp")}
    ).select("topic", "key", "value", "timestamp")


def _comment_envelopes(spark, sf) -> DataFrame:
    return R.keyed_json(A.comment_records(spark, sf)).withColumns(
        {"topic": F.lit(U.COMMENTS_TOPIC), "timestamp": F.lit("2024-02-01").cast("timestamp")}
    ).select("topic", "key", "value", "timestamp")


def _stream(spark: SparkSession, rows: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Rows written to a new folder, and the stream that reads it."""
    path = work_dir(spark, label)
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path), path


def _run_to_table(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run a stream over all available data; complete mode keeps the latest result only."""
    spark = stream.sparkSession
    out, checkpoint = work_dir(spark, label), work_dir(spark, f"{label}-checkpoint")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    writer.foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(out)).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def stream_source(spark, sf):
    both = _post_envelopes(spark, sf).unionByName(_comment_envelopes(spark, sf))
    stream, _ = _stream(spark, both, "topics")
    posts = R.well_formed(R.decode_messages(stream, U.POSTS_TOPIC, POST_RECORD)).select(
        F.lit("post").alias("kind"), "id", "author", "score"
    )
    comments = R.well_formed(R.decode_messages(stream, U.COMMENTS_TOPIC, COMMENT_RECORD)).select(
        F.lit("comment").alias("kind"), "id", "author", "score"
    )
    return _run_to_table(posts.unionByName(comments), "routed")


STREAM_SOURCE = f"""WITH {TEXT_RECORDS}, {COMMENT_RECORDS}
SELECT 'post' AS kind, id, author, score FROM text_records
UNION ALL SELECT 'comment', id, author, score FROM comment_records"""


def stream_sink_keyed_json(spark, sf):
    stream, _ = _stream(spark, _records(spark, sf), "records")
    sent = _run_to_table(R.keyed_json(stream), "sent")
    field = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return sent.select("key", field("id"), field("title"), field("score"), field("author"), field("subreddit"))


STREAM_SINK = f"""WITH {TEXT_RECORDS}
SELECT id AS key, id, title, CAST(score AS VARCHAR) AS score, author, subreddit FROM text_records"""


def sink_raw_json(spark, sf):
    path = _landed(_records(spark, sf), "landed")
    return spark.read.schema("id string, score int, subreddit string").json(path).groupBy("subreddit").agg(
        F.count("*").alias("records"), F.sum("score").alias("total_score")
    )


SINK_RAW = f"""WITH {TEXT_RECORDS}
SELECT subreddit, count(*) AS records, CAST(sum(score) AS BIGINT) AS total_score FROM text_records GROUP BY 1"""


def table_scan(spark, sf):
    sql = """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice) + 1e-9, 2) AS total
      FROM {orders} WHERE o_orderdate >= :start AND o_orderdate < :until GROUP BY o_orderpriority"""
    return tables.query(
        spark, sql, {"orders": A.load(spark, sf, "orders")}, start="1996-01-01", until="2000-01-01"
    )


TABLE_SCAN = """SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice) + 1e-9, 2) AS total FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1"""


def text_terms(spark: SparkSession, lower: bool = True) -> DataFrame:
    return D.load_term_dictionary(spark, None, A.TEXT_TERMS, lower)


def _tokens(spark, sf) -> DataFrame:
    docs = A.load(spark, sf, "documents")
    return docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("token"))


def _term_uses(spark, sf, terms: DataFrame) -> DataFrame:
    """Uses of each dictionary term as a word; tokens are counted before they meet the dictionary."""
    counted = _tokens(spark, sf).groupBy("token").agg(F.count("*").alias("uses"))
    return counted.join(F.broadcast(terms), counted.token == terms.term).select("category", "name", "term", "uses")


def load_term_dictionary(spark, sf):
    return _term_uses(spark, sf, text_terms(spark))


def _term_rows(extra: list[tuple] = ()) -> str:
    rows = [(c, n, t) for c, items in A.TEXT_TERMS.items() for n, al, _ in items for t in [n, *al]]
    again = {t for _, _, t in extra}
    return values([r for r in rows if r[2] not in again] + list(extra), "category, name, term")


TOKENS = r"""tokens AS (SELECT unnest(string_split_regex(lower(text), '[^\p{L}]+')) AS token FROM documents)"""

TERM_DICTIONARY = f"""WITH {TOKENS}
SELECT category, name, term, count(*) AS uses FROM tokens JOIN {_term_rows()} d ON d.term = token GROUP BY 1, 2, 3"""


def add_term(spark, sf):
    return _term_uses(spark, sf, D.add_term(text_terms(spark), "von", "custom", ["den", "mit"]))


ADD_TERM = f"""WITH {TOKENS}
SELECT category, name, term, count(*) AS uses FROM tokens
JOIN {_term_rows([('custom', 'von', 'von'), ('custom', 'von', 'den'), ('custom', 'von', 'mit')])} d ON d.term = token
GROUP BY 1, 2, 3"""


def load_valence_dictionary(spark, sf):
    valences = D.load_valences(spark)
    own = spark.createDataFrame(list(A.TEXT_VALENCES.items()), "term string, valence double")
    merged = D.update_valences(valences, own)
    counted = _tokens(spark, sf).groupBy("token").agg(F.count("*").alias("uses"))
    return counted.join(F.broadcast(merged), counted.token == merged.term).select(
        "term", "uses", A.rounded(F.col("valence") * F.col("uses")).alias("total_valence")
    )


VALENCE_DICTIONARY = f"""WITH {TOKENS}
SELECT term, count(*) AS uses, {r6('CAST(valence AS DOUBLE) * count(*)')} AS total_valence
FROM tokens JOIN {values(list({**D.TECH_VALENCES, **A.TEXT_VALENCES}.items()), 'term, valence')} d ON d.term = token
GROUP BY term, valence"""


def evolve_schema(spark, sf):
    old = A.trade_analysis(spark, sf).select("post_id", "sentiment_score", "processed_date")
    now = tables.evolve_schema(old, POST_ANALYSIS)
    return now.select(
        "post_id", A.rounded("sentiment_score").alias("sentiment_score"), "word_count", "unique_words",
        A.joined("topics").alias("topics"), "is_question", A.stamp("processed_date").alias("processed_date"),
    )


EVOLVE = f"""WITH {TRADE}
SELECT post_id, {r6('sentiment_score')} AS sentiment_score, CAST(NULL AS INTEGER) AS word_count,
  CAST(NULL AS INTEGER) AS unique_words, CAST(NULL AS VARCHAR) AS topics, CAST(NULL AS BOOLEAN) AS is_question,
  {stamp('processed_date')} AS processed_date FROM analysis"""


def duplicate_keys(spark, sf):
    lines = A.load(spark, sf, "lineitem")
    return M.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


DUPLICATE_KEYS = """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""


def _log_lines(spark, sf) -> DataFrame:
    events = A.load(spark, sf, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO")
    ts = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss,SSS")
    line = F.concat_ws(" - ", ts, F.concat(F.lit("job"), F.col("user_id").cast("string")), level, "props")
    return events.select(line.alias("value"), F.col("event_type"))


def log_error_scan(spark, sf):
    path = work_dir(spark, "logs")
    _log_lines(spark, sf).select("value").write.text(path)
    found = logs.log_errors(spark, path, F.lit("2024-01-31").cast("timestamp"), 24 * 7, pattern="*.txt")
    return found.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss,SSS").alias("ts"), "message")


LOG_SCAN = """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S,%g') AS ts, props AS message FROM events
WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS"""


def validate_required(spark, sf):
    rows = A.comment_records(spark, sf)
    good = N.validate_required(rows, N.COMMENT_REQUIRED).select("id", F.lit(True).alias("valid"))
    return good.unionByName(N.rejected(rows, N.COMMENT_REQUIRED).select("id", F.lit(False).alias("valid")))


VALIDATE = f"WITH {COMMENT_RECORDS} SELECT id, post_id <> '' AS valid FROM comment_records"


def drop_stickied(spark, sf):
    return N.drop_stickied(A.text_records(spark, sf)).select("id", "subreddit")


STICKIED = f"WITH {TEXT_RECORDS} SELECT id, subreddit FROM text_records WHERE event_type <> 'error'"


def normalise_author(spark, sf):
    rows = N.normalise_author(A.text_records(spark, sf))
    known = N.known_authors(rows).groupBy("author").agg(F.count("*").alias("records"))
    return known.unionByName(rows.groupBy(F.concat(F.lit("all:"), "author").alias("author")).agg(F.count("*").alias("records")))


AUTHORS = f"""WITH {TEXT_RECORDS}, a AS (SELECT coalesce(author, '[deleted]') AS author FROM text_records)
SELECT author, count(*) AS records FROM a WHERE author <> '[deleted]' GROUP BY 1
UNION ALL SELECT 'all:' || author, count(*) FROM a GROUP BY 1"""


def epoch_to_timestamp(spark, sf):
    rows = A.text_records(spark, sf)
    return rows.select("id", A.stamp(N.epoch_to_timestamp(F.col("created_utc"))).alias("created_date"))


EPOCH = f"WITH {TEXT_RECORDS} SELECT id, {stamp('created_date')} AS created_date FROM text_records"


def default_flags(spark, sf):
    return N.default_flags(A.text_records(spark, sf)).select("id", "is_self", "is_video", "over_18")


FLAGS = f"""WITH {TEXT_RECORDS}
SELECT id, event_type = 'click' AS is_self, false AS is_video, false AS over_18 FROM text_records"""

FEEDS = {"en": "hot", "fr": "new", "de": "top", "es": "rising"}


def _feeds(spark, sf) -> DataFrame:
    rows = A.text_records(spark, sf)
    return N.feed_union({feed: rows.where(F.col("lang") == lang) for lang, feed in FEEDS.items()})


def feed_union(spark, sf):
    return _feeds(spark, sf).select("id", "subreddit", "sort_type")


SORT_TYPE = "CASE lang WHEN 'fr' THEN 'new' WHEN 'de' THEN 'top' ELSE 'hot' END"
FEED_UNION = f"WITH {TEXT_RECORDS} SELECT id, subreddit, {SORT_TYPE} AS sort_type FROM text_records"


def feed_cap(spark, sf):
    return N.feed_cap(_feeds(spark, sf), 5).select("id", "subreddit", "sort_type")


FEED_CAP = f"""WITH {TEXT_RECORDS}
SELECT id, subreddit, sort_type FROM (SELECT *, {SORT_TYPE} AS sort_type FROM text_records WHERE event_type <> 'error')
QUALIFY row_number() OVER (PARTITION BY subreddit, sort_type ORDER BY doc_id, id) <= 5"""


def _trees(spark, sf) -> DataFrame:
    """Documents as comment trees: each line is a comment and its sentences are the replies."""
    docs = A.load(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("post_id"), "text")

    def reply(line_id):
        return lambda body, i: F.struct(
            F.concat_ws("_", line_id, i.cast("string")).alias("id"), body.alias("body"), F.lit(None).alias("parent_id")
        )

    def comment(line, i):
        line_id = F.concat_ws("_", "post_id", i.cast("string"))
        return F.struct(
            line_id.alias("id"),
            line.alias("body"),
            F.concat(F.lit("t3_"), F.col("post_id")).alias("parent_id"),
            F.transform(X.sentences(line), reply(line_id)).alias("replies"),
        )

    return docs.select("post_id", F.to_json(F.transform(F.split("text", "\n"), comment)).alias("comments"))


def flatten_replies(spark, sf):
    fields = struct("id string, body string, parent_id string")
    flat = N.flatten_replies(_trees(spark, sf), fields)
    return flat.select("post_id", "id", "parent_id", A.digest("body").alias("body_md5"))


REPLIES = r"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents),
sents AS (SELECT doc_id, i, string_split(regexp_replace(line, '([.!?])[\s\p{Z}]+', '\1' || chr(1), 'g'), chr(1)) AS ss FROM lines)
SELECT CAST(doc_id AS VARCHAR) AS post_id, doc_id || '_' || i AS id, 't3_' || doc_id AS parent_id, md5(line) AS body_md5 FROM lines
UNION ALL
SELECT CAST(doc_id AS VARCHAR), doc_id || '_' || i || '_' || j, doc_id || '_' || i, md5(s)
FROM (SELECT doc_id, i, unnest(ss) AS s, unnest(range(0, len(ss))) AS j FROM sents)"""


def _known_dim(spark, sf) -> DataFrame:
    """Nations of one region have an id already."""
    region = A.load(spark, sf, "region").where("r_regionkey = 0")
    nation = A.load(spark, sf, "nation").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return nation.select((F.col("n_nationkey") + 1).cast("int").alias("subreddit_id"), F.col("n_name").alias("name"))


def _all_names(spark, sf) -> DataFrame:
    sources = A.load(spark, sf, "documents").select(F.col("source").alias("name"))
    return sources.unionByName(A.load(spark, sf, "nation").select(F.col("n_name").alias("name")))


def upsert_dimension(spark, sf):
    return M.upsert_dimension(_known_dim(spark, sf), _all_names(spark, sf)).select("subreddit_id", "name")


DIM = """dim AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS subreddit_id, n_name AS name FROM nation WHERE n_regionkey = 0)"""
UPSERT_DIM = f"""WITH {DIM}, fresh AS (SELECT name FROM (SELECT DISTINCT source AS name FROM documents UNION SELECT n_name FROM nation)
  WHERE name NOT IN (SELECT name FROM dim))
SELECT * FROM dim UNION ALL
SELECT CAST((SELECT max(subreddit_id) FROM dim) + row_number() OVER (ORDER BY md5(name)) AS INTEGER), name FROM fresh"""


def lookup_dimension(spark, sf):
    dim = A.text_subreddits(spark, sf).where("name != 'src0'")
    rows = A.text_records(spark, sf).select("id", "subreddit")
    loose = M.lookup_dimension(rows, dim).withColumn("variant", F.lit("keep"))
    strict = M.lookup_dimension(rows, dim, keep_unknown=False).withColumn("variant", F.lit("drop"))
    return loose.unionByName(strict).select("variant", "id", "subreddit_id")


LOOKUP_DIM = f"""WITH {TEXT_RECORDS}
SELECT 'keep' AS variant, id, CASE WHEN subreddit <> 'src0' THEN subreddit_id END AS subreddit_id FROM text_records
UNION ALL SELECT 'drop', id, subreddit_id FROM text_records WHERE subreddit <> 'src0'"""


def referential_gate(spark, sf):
    posts = A.load(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("post_id"))
    comments = A.text_comments(spark, sf)
    kept = M.referential_gate(comments, posts).select("comment_id", F.lit(True).alias("kept"))
    return kept.unionByName(M.unknown_posts(comments, posts).select("comment_id", F.lit(False).alias("kept")))


GATE = """SELECT conv_id || '_' || turn AS comment_id, conv_id IN (SELECT doc_id FROM labels) AS kept FROM conversations"""

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
LINE_UPDATES = ["l_quantity", "l_discount"]


def _line_versions(spark, sf) -> tuple[DataFrame, DataFrame]:
    lines = A.load(spark, sf, "lineitem").select(*LINE_KEY, *LINE_ORDER, "l_linestatus")
    return lines.where("l_linestatus = 'F'"), lines.where("l_linestatus <> 'F'")


def _line_out(rows: DataFrame) -> DataFrame:
    return rows.select(
        *LINE_KEY, A.stamp("l_shipdate").alias("l_shipdate"), "l_partkey", "l_suppkey", "l_quantity", "l_discount",
        "l_linestatus",
    )


def upsert_partial(spark, sf):
    old, new = _line_versions(spark, sf)
    stored = M.upsert_partial(old.limit(0), old, LINE_KEY, LINE_UPDATES, LINE_ORDER)
    return _line_out(M.upsert_partial(stored, new, LINE_KEY, LINE_UPDATES, LINE_ORDER))


def upsert_full(spark, sf):
    old, new = _line_versions(spark, sf)
    stored = M.upsert_full(old.limit(0), old, LINE_KEY, LINE_ORDER)
    return _line_out(M.upsert_full(stored, new, LINE_KEY, LINE_ORDER))


def _stored_lines(spark, sf, make) -> DataFrame:
    """Both sets of versions taken into a stored table, one after the other."""
    old, new = _line_versions(spark, sf)
    table = make(work_dir(spark, "lines"), old.schema)
    table.apply(old, 0, LINE_ORDER)
    table.apply(new, 1, LINE_ORDER, 0)
    return _line_out(table.read(spark, 1))


def upsert_partial_stored(spark, sf):
    return _stored_lines(spark, sf, lambda path, schema: M.partial_table(path, schema, LINE_KEY, LINE_UPDATES, buckets=8))


def upsert_full_stored(spark, sf):
    return _stored_lines(spark, sf, lambda path, schema: M.full_table(path, schema, LINE_KEY, buckets=8, most_changes=0))


_ORDER = ", ".join(["l_linestatus <> 'F'", *LINE_ORDER])
_DESC = ", ".join(f"{c} DESC" for c in ["l_linestatus <> 'F'", *LINE_ORDER])
_RANKED = f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS up,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_DESC}) AS down FROM lineitem)"""
UPSERT_PARTIAL = f"""WITH {_RANKED}
SELECT f.l_orderkey, f.l_linenumber, {stamp('f.l_shipdate')} AS l_shipdate, f.l_partkey, f.l_suppkey, x.l_quantity, x.l_discount,
  f.l_linestatus
FROM ranked f JOIN ranked x ON x.l_orderkey = f.l_orderkey AND x.l_linenumber = f.l_linenumber AND x.down = 1 WHERE f.up = 1"""
UPSERT_FULL = f"""WITH {_RANKED}
SELECT l_orderkey, l_linenumber, {stamp('l_shipdate')} AS l_shipdate, l_partkey, l_suppkey, l_quantity, l_discount, l_linestatus
FROM ranked WHERE down = 1"""


def load_stats(spark, sf):
    rows = A.comment_records(spark, sf)
    twice = rows.unionByName(rows.where("author = 'user'"))
    stored = rows.where("score = 0").select(F.col("id").alias("comment_id"))
    posts = A.load(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("post_id"))
    return M.load_stats(M.load_outcomes(twice, stored, "comment_id", N.COMMENT_REQUIRED, posts))


LOAD_STATS = f"""WITH {COMMENT_RECORDS},
twice AS (SELECT * FROM comment_records UNION ALL SELECT * FROM comment_records WHERE author = 'user'),
good AS (SELECT id, max(turn) AS turn, count(*) AS n FROM twice
  WHERE post_id <> '' AND post_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels) GROUP BY 1)
SELECT (SELECT count(*) FROM twice) AS processed, (SELECT count(*) FROM good WHERE turn <> 0) AS inserted,
  CAST((SELECT sum(CASE WHEN turn = 0 THEN n ELSE n - 1 END) FROM good) AS BIGINT) AS updated,
  CAST((SELECT count(*) FROM twice) - (SELECT sum(n) FROM good) AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS errors"""


def dead_letter(spark, sf):
    turns = A.load(spark, sf, "conversations")
    plain = turns.where("role = 'system'").select(F.col("conv_id").cast("string").alias("key"), F.col("text").alias("value"))
    good = _comment_envelopes(spark, sf)
    bad = plain.withColumns({"topic": F.lit(U.COMMENTS_TOPIC), "timestamp": F.lit(None).cast("timestamp")})
    both = good.unionByName(bad.select("topic", "key", "value", "timestamp"))
    letters = R.dead_letters(R.decode_messages(both, U.COMMENTS_TOPIC, COMMENT_RECORD))
    return letters.select(A.digest(R.CORRUPT).alias("text_md5"))


DEAD_LETTER = "SELECT md5(text) AS text_md5 FROM conversations WHERE role = 'system'"


def _streamed_posts(spark, sf) -> str:
    """All documents sent once, then again with other scores and titles, through the post stream."""
    root, checkpoint, source = (work_dir(spark, n) for n in ("store", "store-checkpoint", "post-topic"))
    first = _records(spark, sf)
    second = first.withColumn("score", F.col("score") + 1).withColumn("title", F.lit("changed"))
    for day, rows in (("2024-02-01", first), ("2024-02-02", second)):
        sent = R.keyed_json(rows).select(
            F.lit(U.POSTS_TOPIC).alias("topic"), "key", "value", F.lit(day).cast("timestamp").alias("timestamp")
        )
        sent.write.mode("append").parquet(source)
        stream = spark.readStream.schema(sent.schema).parquet(source)
        U.stream_upsert_posts(stream, root, checkpoint).awaitTermination()
    return root


def stream_upsert_posts(spark, sf):
    root = _streamed_posts(spark, sf)
    names = U.stored_subreddits(spark, root)
    posts = U.stored_posts(spark, root, ["post_id", "subreddit_id", "title", "author", "score"])
    return posts.join(F.broadcast(names), "subreddit_id").select(
        "post_id", F.col("name").alias("subreddit"), "title", "author", "score"
    )


STREAM_POSTS = f"""WITH {TEXT_RECORDS}
SELECT id AS post_id, subreddit, title, coalesce(author, '[deleted]') AS author, CAST(score + 1 AS INTEGER) AS score FROM text_records"""


def stream_upsert_comments(spark, sf):
    root, checkpoint = work_dir(spark, "store"), work_dir(spark, "store-checkpoint")
    labelled = _records(spark, sf).join(
        A.load(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id")), "id", "left_semi"
    )
    envelopes = R.keyed_json(labelled).select(
        F.lit(U.POSTS_TOPIC).alias("topic"), "key", "value", F.lit("2024-02-01").cast("timestamp").alias("timestamp")
    )
    posts, _ = _stream(spark, envelopes, "post-topic")
    U.stream_upsert_posts(posts, root, f"{checkpoint}-posts").awaitTermination()
    comments, _ = _stream(spark, _comment_envelopes(spark, sf), "comment-topic")
    U.stream_upsert_comments(comments, root, checkpoint).awaitTermination()
    return U.stored_comments(spark, root).select(
        "comment_id", "post_id", "parent_id", A.digest("body").alias("body_md5"), "score"
    )


STREAM_COMMENTS = f"""WITH {COMMENT_RECORDS}
SELECT id AS comment_id, post_id, parent_id, md5(body) AS body_md5, score FROM comment_records
WHERE post_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)"""


def _labelled(spark, sf) -> DataFrame:
    return A.load(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id")).distinct()


def gate_by_filter(spark, sf):
    """Comments whose post is stored, by the filters of the stored posts first."""
    table = M.full_table(work_dir(spark, "posts"), struct("post_id string, note string"), ["post_id"])
    posts = _labelled(spark, sf).select(F.col("id").alias("post_id"), F.lit("").alias("note"))
    table.apply(posts, 0, [])
    return table.known(A.text_comments(spark, sf)).select("comment_id", "post_id")


GATE_BY_FILTER = """SELECT conv_id || '_' || turn AS comment_id, CAST(conv_id AS VARCHAR) AS post_id FROM conversations
WHERE conv_id IN (SELECT doc_id FROM labels)"""


def stream_activity_table(spark, sf):
    """Labelled posts first, then all comments, then those of one role again."""
    root, source, checkpoint = (work_dir(spark, n) for n in ("store", "activity-topic", "store-checkpoint"))
    posts = R.keyed_json(_records(spark, sf).join(_labelled(spark, sf), "id", "left_semi"))
    posts = posts.select(F.lit(U.POSTS_TOPIC).alias("topic"), "key", "value")
    comments = _comment_envelopes(spark, sf).drop("timestamp")
    again = comments.where(F.get_json_object("value", "$.author") == "user")
    for day, rows in (("2024-02-01", posts), ("2024-02-02", comments), ("2024-02-03", again)):
        sent = rows.withColumn("timestamp", F.lit(day).cast("timestamp"))
        sent.write.mode("append").parquet(source)
        if rows is posts:
            # Stored from the messages as sent: the batch is read several times, and its joins ran each time.
            U.apply_posts(spark.read.schema(sent.schema).parquet(source), 0, root)
        stream = spark.readStream.schema(sent.schema).parquet(source)
        U.stream_activity_table(stream, root, checkpoint).awaitTermination()
    return U.stored_activity(spark, root).select(
        "username", "post_count", "comment_count", A.stamp("first_seen").alias("first_seen"), A.stamp("last_seen").alias("last_seen")
    )


STREAM_ACTIVITY_TABLE = f"""WITH {TEXT_RECORDS}, {COMMENT_RECORDS}, known AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels),
sent AS (
  SELECT author, true AS is_post, TIMESTAMP '2024-02-01' AS received FROM text_records WHERE id IN (FROM known) AND author IS NOT NULL
  UNION ALL SELECT author, false, TIMESTAMP '2024-02-02' FROM comment_records WHERE post_id IN (FROM known)
  UNION ALL SELECT author, false, TIMESTAMP '2024-02-03' FROM comment_records WHERE post_id IN (FROM known) AND author = 'user')
SELECT author AS username, count(*) FILTER (is_post) AS post_count, count(*) FILTER (NOT is_post) AS comment_count,
  {stamp('min(received)')} AS first_seen, {stamp('max(received)')} AS last_seen FROM sent GROUP BY author"""

_SPLIT = "1995-01-01"


def stream_closed_weeks(spark, sf):
    """Two thirds of the orders before 1995, then the other third, then all later ones."""
    root, source, checkpoint = (work_dir(spark, n) for n in ("weeks", "mention-rows", "weeks-checkpoint"))
    posts = A.trade_posts(spark, sf).select("post_id", "created_date", "subreddit_id")
    rows = posts.join(A.trade_analysis(spark, sf).where("tech_mentioned IS NOT NULL").select("post_id", "tech_mentioned"), "post_id")
    early, third = F.col("created_date") < F.lit(_SPLIT).cast("timestamp"), F.col("post_id").cast("bigint") % 3 == 0
    for part in (early & ~third, early & third, ~early):
        sent = rows.where(part).drop("post_id")
        sent.write.mode("append").parquet(source)
        U.stream_closed_weeks(spark.readStream.schema(sent.schema).parquet(source), root, checkpoint).awaitTermination()
    late = U.late_rows(spark, root, sent.schema).select(
        F.date_trunc("week", "created_date").cast("date").alias("week_start"), F.explode("tech_mentioned").alias("tech_name"), "subreddit_id"
    )
    late = late.groupBy("week_start", "tech_name", "subreddit_id").agg(F.count("*").alias("mention_count"))
    parts = {"final": U.closed_weeks(spark, root), "late": late, "pending": U.pending_weeks(root).read(spark)}
    out = [f.select(F.lit(kind).alias("kind"), "tech_name", "week_start", "subreddit_id", "mention_count") for kind, f in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


STREAM_CLOSED_WEEKS = f"""WITH {TRADE}, rows AS (
  SELECT p.created_date, p.subreddit_id, a.tech_mentioned, p.created_date >= TIMESTAMP '{_SPLIT}' AS third,
    CAST(p.post_id AS BIGINT) % 3 = 0 AS second FROM posts p JOIN analysis a USING (post_id) WHERE a.tech_mentioned IS NOT NULL),
marks AS (SELECT max(created_date) FILTER (NOT third AND NOT second) - INTERVAL 14 DAYS AS one, max(created_date) - INTERVAL 14 DAYS AS last FROM rows),
kinds AS (
  SELECT unnest(tech_mentioned) AS tech_name, CAST(date_trunc('week', created_date) AS DATE) AS week_start, subreddit_id,
    CASE WHEN NOT third AND second AND date_trunc('week', created_date) + INTERVAL 7 DAYS <= one THEN 'late'
      WHEN date_trunc('week', created_date) + INTERVAL 7 DAYS <= last THEN 'final' ELSE 'pending' END AS kind FROM rows, marks)
SELECT kind, tech_name, week_start, subreddit_id, count(*) AS mention_count FROM kinds GROUP BY ALL"""


def _messages(spark, sf) -> DataFrame:
    events = A.load(spark, sf, "events")
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("event_type") == "signup", "[deleted]")
        .otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
        .alias("author"),
        F.col("event_type").isin("view", "purchase").alias("is_post"),
        F.col("ts").cast("timestamp").alias("received"),
    )


def stream_user_activity(spark, sf):
    stream, _ = _stream(spark, _messages(spark, sf), "activity")
    out = _run_to_table(U.user_activity_counts(stream), "activity-counts", "complete")
    return out.select(
        "username", "post_count", "comment_count", A.stamp("first_seen").alias("first_seen"),
        A.stamp("last_seen").alias("last_seen"),
    )


STREAM_ACTIVITY = f"""SELECT 'u' || user_id AS username, count(*) FILTER (event_type IN ('view', 'purchase')) AS post_count,
  count(*) FILTER (event_type NOT IN ('view', 'purchase')) AS comment_count,
  {stamp('min(ts)')} AS first_seen, {stamp('max(ts)')} AS last_seen
FROM events WHERE event_type <> 'signup' GROUP BY user_id"""


def stream_weekly_mentions(spark, sf):
    posts = A.trade_posts(spark, sf).select("post_id", "created_date", "subreddit_id")
    rows = A.trade_analysis(spark, sf).where("tech_mentioned IS NOT NULL").select("post_id", "tech_mentioned")
    stream, _ = _stream(spark, posts.join(rows, "post_id").drop("post_id"), "mention-rows")
    return _run_to_table(U.weekly_mentions(stream), "weekly-mentions", "complete")


STREAM_WEEKLY = f"""WITH {TRADE}
SELECT tech_name, week_start, subreddit_id, count(*) AS mention_count FROM mentions GROUP BY 1, 2, 3"""

QUERIES = {
    "scan_posts_json": (scan_posts_json, SCAN_POSTS),
    "scan_comments_json": (scan_comments_json, SCAN_COMMENTS),
    "stream_source": (stream_source, STREAM_SOURCE),
    "stream_sink_keyed_json": (stream_sink_keyed_json, STREAM_SINK),
    "sink_raw_json": (sink_raw_json, SINK_RAW),
    "table_scan": (table_scan, TABLE_SCAN),
    "load_term_dictionary": (load_term_dictionary, TERM_DICTIONARY),
    "load_valence_dictionary": (load_valence_dictionary, VALENCE_DICTIONARY),
    "add_term": (add_term, ADD_TERM),
    "evolve_schema": (evolve_schema, EVOLVE),
    "duplicate_keys": (duplicate_keys, DUPLICATE_KEYS),
    "log_error_scan": (log_error_scan, LOG_SCAN),
    "validate_required": (validate_required, VALIDATE),
    "drop_stickied": (drop_stickied, STICKIED),
    "normalise_author": (normalise_author, AUTHORS),
    "epoch_to_timestamp": (epoch_to_timestamp, EPOCH),
    "default_flags": (default_flags, FLAGS),
    "feed_union": (feed_union, FEED_UNION),
    "feed_cap": (feed_cap, FEED_CAP),
    "flatten_replies": (flatten_replies, REPLIES),
    "upsert_dimension": (upsert_dimension, UPSERT_DIM),
    "lookup_dimension": (lookup_dimension, LOOKUP_DIM),
    "referential_gate": (referential_gate, GATE),
    "upsert_partial": (upsert_partial, UPSERT_PARTIAL),
    "upsert_full": (upsert_full, UPSERT_FULL),
    "upsert_partial_stored": (upsert_partial_stored, UPSERT_PARTIAL),
    "upsert_full_stored": (upsert_full_stored, UPSERT_FULL),
    "gate_by_filter": (gate_by_filter, GATE_BY_FILTER),
    "load_stats": (load_stats, LOAD_STATS),
    "dead_letter": (dead_letter, DEAD_LETTER),
    "stream_upsert_posts": (stream_upsert_posts, STREAM_POSTS),
    "stream_upsert_comments": (stream_upsert_comments, STREAM_COMMENTS),
    "stream_user_activity": (stream_user_activity, STREAM_ACTIVITY),
    "stream_activity_table": (stream_activity_table, STREAM_ACTIVITY_TABLE),
    "stream_closed_weeks": (stream_closed_weeks, STREAM_CLOSED_WEEKS),
    "stream_weekly_mentions": (stream_weekly_mentions, STREAM_WEEKLY),
}
