import itertools
import json

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from threadloom.operators import merge as M, normalise as N, reports as D, trends as T, users as U
from threadloom.schemas import COMMENT_RECORD, POST_ANALYSIS, POST_RECORD, struct
from threadloom.sources import dictionaries as Dict, logs, records as R, tables
from threadloom.streaming import upserts as S


def day(text):
    return F.to_timestamp(F.lit(text))


def test_scan_json_keeps_broken_files_apart(spark, tmp_path):
    (tmp_path / "a_1.json").write_text(json.dumps({"id": "1", "subreddit": "a", "score": 3}, indent=2))
    (tmp_path / "a_2.json").write_text('{"id": "2", "subr')
    (tmp_path / "note.txt").write_text("{}")
    found = R.scan_posts_json(spark, str(tmp_path))
    assert rows(R.well_formed(found), "id", "score") == [("1", 3)]
    assert R.dead_letters(found).count() == 1


def test_landed_records_read_back_whole(spark, tmp_path):
    posts = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, subreddit string")
    R.sink_raw_json(posts, str(tmp_path / "raw"))
    found = R.scan_posts_json(spark, str(tmp_path / "raw"), multi_line=False)
    assert rows(found, "id", "subreddit") == [("1", "a"), ("2", "b")]


def test_required_fields(spark):
    df = spark.createDataFrame([("1", "a"), ("", "a"), ("2", None), (None, "b")], "id string, subreddit string")
    assert N.validate_required(df, N.POST_REQUIRED).count() == 1
    assert N.rejected(df, N.POST_REQUIRED).count() == 3


def test_feed_cap_matches_beyond_the_rank_limit(spark):
    df = spark.createDataFrame(
        [(str(i), "hot" if i % 3 else "new", "a", i % 7 == 0, i) for i in range(400)],
        "id string, sort_type string, subreddit string, stickied boolean, feed_pos int",
    )
    plain = rows(N.feed_cap(df, 50), "id")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    try:
        assert rows(N.feed_cap(df, 50), "id") == plain
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert len(plain) == 100


def test_flatten_replies_goes_as_deep_as_the_tree(spark):
    def node(depth, name):
        below = [node(depth - 1, f"{name}{i}") for i in range(2 if depth % 3 == 0 else 1)] if depth else []
        return {"id": name, "parent_id": f"t3_{name}", "body": name.upper(), "replies": below}

    def flat(tree, parent=None):
        yield tree["id"], parent or tree["parent_id"], tree["body"]
        for child in tree["replies"]:
            yield from flat(child, tree["id"])

    forest = [node(10, "x"), node(0, "y")]
    df = spark.createDataFrame([("p", json.dumps(forest)), ("q", None), ("r", "[]")], "post_id string, comments string")
    found = N.flatten_replies(df, struct("id string, parent_id string, body string"))
    expected = sorted(itertools.chain.from_iterable(map(flat, forest)))
    assert rows(found, "id", "parent_id", "body") == expected


def test_broken_reply_trees_are_rejects(spark):
    good = json.dumps([{"id": "a", "parent_id": "t3_p", "replies": [{"id": "b", "replies": ""}]}])
    trees = [("p", good), ("q", '[{"id": "c", "rep'), ("r", " "), ("s", "null"), ("t", None)]
    df = spark.createDataFrame(trees, "post_id string, comments string")
    for levels in (1, 4):
        found, rejects = N.reply_tables(df, struct("id string, parent_id string"), levels)
        assert rows(found, "id", "parent_id") == [("a", "t3_p"), ("b", "a")]
        assert rows(rejects, "post_id", "parent", "comments") == [("q", None, trees[1][1])]


def test_large_dictionaries_keep_their_order(spark):
    from threadloom.sources.dictionaries import flatten_terms, term_pairs

    entries = [{"name": f"n{i}", "aliases": [f"a{i}_{j}" for j in range(1500 if i == 3 else 1)], "weight": 1.0} for i in range(1500)]
    file = spark.createDataFrame([(json.dumps({"x": entries, "y": None, "z": entries[:1]}),)], "value string")
    terms = flatten_terms(file)
    assert terms.count() == terms.select("term_order").distinct().count() == 1500 + 1499 + 1500 + 2
    expected = [(t, e["name"]) for e in entries for t in (e["name"], *e["aliases"])]
    assert term_pairs(terms) == expected


def test_emerging_report_is_saved_with_the_analyses(spark, tmp_path):
    from threadloom.plans.analyses import run_all_analyses

    posts, analysis = forum(spark, [("1", ["a"], 0.1, "2024-01-01", 1, "2024-01-01")])
    subs = spark.createDataFrame([(1, "s")], "subreddit_id int, name string")
    stored = spark.createDataFrame(
        [], "tech_name string, period_start date, period_end date, mention_count bigint, sentiment_avg double, growth_percent double, correlation_score double"
    )
    run = run_all_analyses(posts, analysis, subs, str(tmp_path / "out"), "2024-01-02", stored)
    assert spark.read.parquet(run.tables["emerging_saved"]).count() == spark.read.parquet(run.tables["emerging_tech"]).count()


VERSIONS = "id string, title string, score int, seen int"


def test_partial_and_full_merge(spark):
    old = spark.createDataFrame([("a", "old", 1, 0)], VERSIONS)
    new = spark.createDataFrame([("a", "n1", 5, 1), ("a", "n2", None, 2), ("b", "x", 7, 4), ("b", "y", 8, 3)], VERSIONS)
    partial = M.upsert_partial(old, new, ["id"], ["score"], ["seen"])
    assert rows(partial, "id", "title", "score") == [("a", "old", None), ("b", "y", 7)]
    full = M.upsert_full(old, new, ["id"], ["seen"])
    assert rows(full, "id", "title", "score") == [("a", "n2", None), ("b", "x", 7)]
    assert rows(M.upsert_full(full, new, ["id"], ["seen"])) == rows(full)


def test_dimension_keeps_ids_and_numbers_without_gaps(spark):
    dim = spark.createDataFrame([(7, "a")], "subreddit_id int, name string")
    names = spark.createDataFrame([(n,) for n in ["a", "b", "b", None, ""] + [f"s{i}" for i in range(300)]], "name string")
    grown = M.upsert_dimension(dim, names)
    ids = dict((n, i) for i, n in rows(grown, "subreddit_id", "name"))
    assert ids["a"] == 7 and sorted(ids.values()) == list(range(7, 7 + 302))
    again = M.upsert_dimension(grown, names)
    assert rows(again, "subreddit_id", "name") == rows(grown, "subreddit_id", "name")


def test_load_stats(spark):
    records = spark.createDataFrame(
        [("1", "p", None), ("1", "p", None), ("2", "p", None), ("3", "q", None), ("", "p", None), (None, None, "{bad")],
        "id string, post_id string, _corrupt string",
    )
    stored = spark.createDataFrame([("2",)], "comment_id string")
    known = spark.createDataFrame([("p",)], "post_id string")
    found = M.load_stats(M.load_outcomes(records, stored, "comment_id", N.COMMENT_REQUIRED, known)).first()
    assert found.asDict() == {"processed": 6, "inserted": 1, "updated": 2, "skipped": 2, "errors": 1}


def test_evolved_rows_have_the_schema(spark):
    df = spark.createDataFrame([("1", 0.5)], "post_id string, sentiment_score double")
    assert tables.evolve_schema(df, POST_ANALYSIS).schema.names == POST_ANALYSIS.names


def test_dictionaries(spark, tmp_path):
    terms = Dict.load_term_dictionary(spark, None, Dict.TECHNOLOGIES)
    pairs = Dict.term_pairs(terms)
    assert len(pairs) == 21 and pairs[:3] == [("hadoop", "hadoop"), ("hdp", "hadoop"), ("apache hadoop", "hadoop")]
    assert Dict.term_pairs(Dict.load_term_dictionary(spark, str(tmp_path / "none.json"), Dict.TECHNOLOGIES)) == pairs
    (tmp_path / "bad.json").write_text("{oops")
    assert Dict.term_pairs(Dict.load_term_dictionary(spark, str(tmp_path / "bad.json"), Dict.TECHNOLOGIES)) == pairs
    (tmp_path / "own.json").write_text('{"c": [{"name": "Kafka", "aliases": ["", "AK"], "weight": 1.0}]}')
    own = Dict.load_term_dictionary(spark, str(tmp_path / "own.json"), Dict.TECHNOLOGIES, lower=True)
    assert Dict.term_pairs(own) == [("kafka", "kafka"), ("ak", "kafka")]
    grown = Dict.term_pairs(Dict.add_term(terms, "duckdb", aliases=["duck", "hdp"]))
    assert grown[-3:] == [("duckdb", "duckdb"), ("duck", "duckdb"), ("hdp", "duckdb")] and len(grown) == 23
    updates = spark.createDataFrame([("bug", -3.0), ("new", 1.0)], "term string, valence double")
    valences = dict(rows(Dict.update_valences(Dict.load_valences(spark), updates)))
    assert (valences["bug"], valences["new"], len(valences)) == (-3.0, 1.0, 44)


def test_log_errors(spark, tmp_path):
    lines = [
        "2024-01-02 10:00:00,123 - job - ERROR - late - one",
        "2024-01-01 09:59:59,999 - job - ERROR - too old",
        "2024-01-02 10:00:00,123 - job - INFO - fine",
        "2024-13-45 10:00:00,123 - job - ERROR - odd time",
    ]
    (tmp_path / "a.log").write_text("\n".join(lines))
    as_of = F.lit("2024-01-02 10:00:00").cast("timestamp")
    found = logs.log_errors(spark, str(tmp_path), as_of, 24)
    assert [r[1] for r in rows(found, "file", "message")] == ["late - one", "odd time"]
    assert rows(logs.errors_per_file(found), "file", "errors") == [("a.log", 2)]


ANALYSIS = "post_id string, tech_mentioned array<string>, sentiment_score double, processed string, subreddit_id int, created string"


def forum(spark, data):
    df = spark.createDataFrame(data, ANALYSIS)
    posts = df.select("post_id", "subreddit_id", F.to_timestamp("created").alias("created_date"))
    return posts, df.select("post_id", "tech_mentioned", "sentiment_score", F.to_timestamp("processed").alias("processed_date"))


def test_incremental_equals_full_after_every_batch(spark):
    """Including a week that loses all mentions, an untouched week, and a run without news."""
    first = [("1", ["a", "b"], 0.1, "2024-02-01", 1, "2024-01-01"), ("2", ["a"], 0.1, "2024-02-01", 1, "2024-01-09")]
    posts, analysis = forum(spark, first)
    stored = T.weekly_mentions_full(posts, analysis)
    since = F.lit("2024-02-01").cast("timestamp")
    assert rows(T.weekly_mentions_incremental(stored, posts, analysis, since)) == rows(stored)
    changed = [
        ("1", ["c"], 0.1, "2024-02-02", 1, "2024-01-02"),
        ("2", None, 0.1, "2024-02-02", 1, "2024-01-09"),
        ("3", ["a"], 0.1, "2024-02-02", 1, "2024-01-16"),
    ]
    posts, analysis = forum(spark, changed)
    found = T.weekly_mentions_incremental(stored, posts, analysis, since)
    assert rows(found) == rows(T.weekly_mentions_full(posts, analysis))


def weekly(spark, data):
    spec = "tech_name string, week string, mention_count int, sentiment_avg double, subreddit_id int"
    return spark.createDataFrame(data, spec).withColumn("week_start", F.to_date("week"))


def test_growth_edges(spark):
    trends = weekly(
        spark,
        [
            ("a", "2024-03-04", 6, 0.1, 1), ("a", "2024-02-05", 4, 0.1, 1), ("a", "2024-01-29", 5, 0.3, 1),
            ("a", "2024-01-08", 5, 0.1, 1), ("a", "2024-01-01", 90, 0.1, 1), ("new", "2024-03-04", 5, 0.2, 1),
            ("rare", "2024-03-04", 4, 0.2, 1),
        ],
    )
    found = {r["tech_name"]: (r["current_mentions"], r["previous_mentions"], r["growth_percent"]) for r in T.tech_growth(trends).collect()}
    assert found == {"a": (10, 10, 0.0), "new": (5, 0, None)}
    view = {r["tech_name"]: r["growth_percent"] for r in D.growth_by_window(trends, "2024-03-04").collect()}
    assert view == {"a": 0.0, "new": 100.0}
    assert [r["tech_name"] for r in D.emerging_view(trends, "2024-03-04", threshold=50).collect()] == ["new"]
    assert D.growth_hint(trends, "2024-03-04").first()[0] == 100.0


def test_cooccurrence_and_jaccard_properties(spark):
    data = [["a", "b"], ["b", "a"], ["a"], ["a", "b", "c"], ["c"], None, []]
    posts, analysis = forum(spark, [(str(i), t, 0.0, "2024-01-01", 1, "2024-01-01") for i, t in enumerate(data)])
    popular = T.popular_tech(T.weekly_mentions_full(posts, analysis), 3)
    pairs = T.cooccurrence(analysis, popular, diagonal=True)
    assert rows(pairs) == [("a", "a", 4), ("a", "b", 3), ("b", "b", 3)]
    scores = T.jaccard(pairs, popular)
    assert rows(scores) == [("a", "b", 3 / 4)]
    exact = scores.withColumn("correlation_score", F.lit(0.05))
    assert T.correlation_edges(exact, "2024-01-01").count() == 0


def test_week_across_a_month_end_gives_two_rows(spark):
    data = [(str(i), ["a"], 0.5, "2024-03-01", 1, d) for i, d in enumerate(["2024-01-30", "2024-01-31", "2024-02-01"])]
    posts, analysis = forum(spark, data)
    subs = spark.createDataFrame([(1, "s")], "subreddit_id int, name string")
    found = T.subreddit_tech_trends(posts, analysis, subs, 1)
    assert sorted(r["mention_count"] for r in found.collect()) == [1, 2]


def test_correlation_of_a_constant_series_is_null(spark):
    data = [("flat", 0.5, 1.0, 2.0, 10), ("flat", 0.5, 2.0, 3.0, 10), ("one", 0.1, 1.0, 1.0, 10), ("up", 0.1, 1.0, 4.0, 10), ("up", 0.2, 2.0, 4.0, 10)]
    monthly = spark.createDataFrame(
        data, "tech_name string, avg_sentiment double, avg_score double, avg_comments double, mention_count int"
    )
    found = {r["tech_name"]: r for r in T.sentiment_popularity_corr(monthly).collect()}
    assert set(found) == {"flat", "up"} and found["flat"]["avg_correlation"] is None
    assert found["up"]["sentiment_comments_corr"] is None
    assert found["up"]["avg_correlation"] == pytest.approx(1.0)


def test_slope_of_exactly_the_bound_is_stable(spark):
    data = [("1", ["a"], 0.0, "2024-01-01", 1, "2024-01-01"), ("2", ["a"], 0.05, "2024-01-01", 1, "2024-01-08"),
            ("3", ["b"], 0.1, "2024-01-01", 1, "2024-01-08")]
    posts, analysis = forum(spark, data)
    found = T.sentiment_trend_slope(posts, analysis, "2024-01-10", min_mentions=1).collect()
    assert [(r["tech_name"], r["trend_type"], r["total_mentions"]) for r in found] == [("a", "stable", 2)]


def test_user_activity_both_ways(spark):
    posts = spark.createDataFrame(
        [("1", 1, "ann", 10), ("2", 2, "ann", 20), ("3", 1, "[deleted]", 5), ("4", 1, None, 5), ("5", 1, "bob", 1)],
        "post_id string, subreddit_id int, author string, score int",
    ).withColumn("created_date", day("2024-01-02"))
    comments = spark.createDataFrame(
        [("c1", "1", "ann", 4), ("c2", "2", "cy", 6), ("c3", "9", "cy", 6)],
        "comment_id string, post_id string, author string, score int",
    ).withColumn("created_date", day("2024-01-05"))
    subs = spark.createDataFrame([(1, "x"), (2, "y")], "subreddit_id int, name string")
    union, merged = (f(posts, comments, subs) for f in (U.user_activity_union, U.user_activity_merge))
    assert rows(union) == rows(merged)
    found = {r["username"]: r for r in union.collect()}
    assert set(found) == {"ann", "bob", "cy"}
    assert (found["ann"]["post_count"], found["ann"]["comment_count"], found["ann"]["avg_post_score"]) == (2, 1, 15.0)
    assert found["cy"]["active_subreddits"] == ["y"] and found["bob"]["avg_comment_score"] == 0.0


def test_network_and_neighbours(spark):
    edges = spark.createDataFrame(
        [("a", "b", 0.9), ("a", "c", 0.8), ("a", "d", 0.2), ("c", "d", 0.06)], "tech_name_1 string, tech_name_2 string, correlation_score double"
    )
    assert rows(D.network_degree(edges, n=3)) == [("a", 2, 1.0), ("c", 2, 1.0), ("d", 2, 1.0)]
    assert rows(D.network_degree(edges, threshold=0.85)) == [("a", 1, 1.0), ("b", 1, 1.0)]
    assert [r[0] for r in D.correlation_neighbours(edges, "d").collect()] == ["a", "c"]


def envelopes(spark, topic, schema, records, received):
    data = [(topic, r.get("id"), json.dumps(r), received) for r in records]
    return spark.createDataFrame(data, "topic string, key string, value string, t string").select(
        "topic", "key", "value", F.to_timestamp("t").alias("timestamp")
    )


def test_batches_fold_and_repeat_without_effect(spark, tmp_path):
    root = str(tmp_path / "store")
    first = [{"id": "1", "subreddit": "a", "title": "t", "score": 1}, {"id": "2", "subreddit": "b", "title": "u", "score": 1}]
    second = [{"id": "1", "subreddit": "a", "title": "changed", "score": 9}, {"id": "3", "title": "no sub"}]
    one = envelopes(spark, S.POSTS_TOPIC, POST_RECORD, first, "2024-01-01")
    broken = spark.createDataFrame([(S.POSTS_TOPIC, "x", "{broken")], "topic string, key string, value string")
    two = envelopes(spark, S.POSTS_TOPIC, POST_RECORD, second, "2024-01-02").unionByName(
        broken.withColumn("timestamp", day("2024-01-02"))
    )
    S.apply_posts(one, 0, root)
    for _ in range(2):
        S.apply_posts(two, 1, root)
    posts = {r["post_id"]: r for r in S.stored_posts(spark, root).collect()}
    assert {k: (r["title"], r["score"]) for k, r in posts.items()} == {"1": ("t", 9), "2": ("u", 1), "3": ("no sub", None)}
    assert posts["3"]["subreddit_id"] is None and posts["1"]["author"] == "[deleted]"
    assert sorted(n for _, n in rows(S.stored_subreddits(spark, root))) == ["a", "b"]
    assert spark.read.parquet(f"{root}/rejected_posts").count() == 1
    comments = [{"id": "c1", "post_id": "1", "body": "x", "score": 1}, {"id": "c2", "post_id": "unknown", "body": "y"}]
    S.apply_comments(envelopes(spark, S.COMMENTS_TOPIC, COMMENT_RECORD, comments, "2024-01-03"), 0, root)
    assert rows(S.stored_comments(spark, root), "comment_id") == [("c1",)]
    # The fold of all changes, written as a table of bases only, is the same table.
    compact = S.post_table(spark, str(tmp_path / "compact"), most_changes=0)
    compact.apply(S.stored_posts(spark, root), 0, [])
    assert {e.kind for e in compact.entries(spark, 0)} == {"base"}
    assert rows(compact.read(spark)) == rows(S.stored_posts(spark, root))


def test_redelivered_messages_can_be_dropped(spark, tmp_path):
    data = [("1", "ann", True, "2024-01-01 00:00:00"), ("1", "ann", True, "2024-01-01 00:00:05"), ("2", "[deleted]", True, "2024-01-01 00:00:06")]
    messages = spark.createDataFrame(data, "id string, author string, is_post boolean, t string").select(
        "id", "author", "is_post", F.to_timestamp("t").alias("received")
    )
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages.write.parquet(source)
    stream = S.distinct_messages(spark.readStream.schema(messages.schema).parquet(source))
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(
        availableNow=True
    ).start().awaitTermination()
    distinct = spark.read.parquet(out)
    assert rows(S.user_activity_counts(messages), "username", "post_count") == [("ann", 2)]
    assert rows(S.user_activity_counts(distinct), "username", "post_count") == [("ann", 1)]


def test_reports_without_data_offer_defaults(spark):
    empty = weekly(spark, [])
    assert [r[0] for r in D.default_techs(empty, 3).collect()] == sorted(D.FALLBACK_TECHS[:3])
    none = spark.createDataFrame([], "subreddit_id int, name string")
    assert rows(D.list_subreddits(none)) == [(D.FALLBACK_SUBREDDIT,)]


def test_one_failed_analysis_does_not_stop_the_others(spark, tmp_path):
    from threadloom.plans.analyses import run_all_analyses

    posts, analysis = forum(spark, [("1", ["a"], 0.1, "2024-01-01", 1, "2024-01-01")])
    subs = spark.createDataFrame([(1, "s")], "subreddit_id int, name string")
    # These posts have no title, score or comments, and the analysis no skills.
    run = run_all_analyses(posts, analysis, subs, str(tmp_path / "out"), "2024-01-02")
    assert set(run.errors) == {"skill_demand", "sentiment_popularity"}
    assert spark.read.parquet(run.tables["weekly_tech_trends"]).count() == 1


def test_lookup_ways_agree_on_repeated_terms_and_keys(spark):
    from threadloom.functions.lookup import lookup_tokens

    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["a", "b"]), (1, ["b"]), (2, None), (3, [])], "id long, tokens array<string>")
    table = spark.createDataFrame([("a", "y"), ("a", "x"), ("c", "z")], "term string, lemma string")
    ways = [
        sorted((r.id, str(r.tokens), str([c and c.lemma for c in r.out] if r.out is not None else None)) for r in lookup_tokens(df, "id", "tokens", table, "term", "out", n).collect())
        for n in (10, 0)
    ]
    assert ways[0] == ways[1] and (1, "['a', 'b']", "['x', None]") in ways[0]


def test_thirds_keep_names_with_undated_posts(spark):
    from datetime import datetime

    from threadloom.operators.sentiment import tech_sentiment_thirds

    dated = [datetime(2024, 1, d) for d in (1, 2)]
    rows = [("n", f"p{i}", float(i), d) for i, d in enumerate([None, None, *dated])]
    scored = spark.createDataFrame(rows, "tech_name string, post_id string, score double, created_date timestamp")
    found = tech_sentiment_thirds(scored).collect()
    assert len(found) == 1 and found[0].recent == 2.5 and found[0].early + found[0].mid == 1.0


def test_all_analyses_join_posts_and_analysis_once(spark, tmp_path):
    from threadloom.plans.analyses import run_all_analyses

    seen = spark.sparkContext.accumulator(0)
    mark = F.udf(lambda x: seen.add(1) or x, "string").asNondeterministic()
    data = [(p, n, ["sql"] if i % 2 else None, s, d, i % 2, "job?", i, 2 * i) for i, (p, n, s, d) in enumerate([
        ("1", ["a", "b"], 0.1, "2024-01-01"), ("1", ["a"], 0.3, "2024-01-01"), ("2", None, 0.2, "2024-02-09"), ("3", ["a", "a"], None, None),
        (None, ["b"], 0.5, "2024-01-02"), ("4", [], 0.4, "2024-01-31"), *[(f"x{i}", ["a", "c"], i / 20, f"2024-0{1 + i % 3}-1{i % 9}") for i in range(60)],
    ])]
    df = spark.createDataFrame(data, "post_id string, tech_mentioned array<string>, skills_mentioned array<string>, sentiment_score double, day string, subreddit_id int, title string, score int, num_comments int")
    posts = df.select("post_id", "subreddit_id", "title", "score", "num_comments", F.to_timestamp("day").alias("created_date"))
    analysis = df.select("post_id", "tech_mentioned", "skills_mentioned", "sentiment_score")
    subs = spark.createDataFrame([(0, "s"), (1, "t")], "subreddit_id int, name string")
    run = run_all_analyses(posts.withColumn("title", mark("title")), analysis, subs, str(tmp_path / "out"), "2024-05-01")
    assert not run.errors and seen.value == len(data)
    apart = {
        "weekly_tech_trends": T.weekly_tech_trends(posts, analysis), "skill_demand": T.skill_demand(posts, analysis),
        "subreddit_tech_trends": T.subreddit_tech_trends(posts, analysis, subs), "tech_trends_weekly": T.tech_trends_by_time(posts, analysis, "week"),
        "tech_trends_monthly": T.tech_trends_by_time(posts, analysis, "month"),
        "sentiment_popularity": T.sentiment_popularity_corr(T.sentiment_popularity_monthly(posts, analysis)),
    }
    for name, expected in apart.items():
        near = lambda df: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)]
        assert near(spark.read.parquet(run.tables[name])) == near(expected) != [], name


def test_a_file_of_one_row_group_is_spread_over_the_cores(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from checks.adapters import load

    folder = tmp_path / "data"
    folder.mkdir()
    pq.write_table(pa.table({"doc_id": list(range(4000)), "text": [str(i) * 20 for i in range(4000)]}), folder / "documents.parquet", row_group_size=4000, compression="none", use_dictionary=False)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "1k")
        found = load(spark, str(folder), "documents")
        held = found.groupBy(F.spark_partition_id().alias("split")).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(held) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in held) < 1000
    assert sorted(rows(found, "doc_id")) == [(i,) for i in range(4000)]
