"""Bucketed tables: versions, failed and repeated steps, untouched files, lookups."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from threadloom.operators import merge as M
from threadloom.schemas import struct
from threadloom.sources import buckets as B

SCHEMA = struct("key string, note string, score int")


def frame(spark, data):
    return spark.createDataFrame(data, "key string, note string, score int, at int")


def files(table, spark, version):
    """Files that make up each bucket of a version."""
    out = {}
    for e in table.entries(spark, version):
        folder = f"{table.path}/{e.kind}/version={e.version}/bucket={e.bucket}"
        out.setdefault(e.bucket, set()).update(f"{folder}/{n}" for n in os.listdir(folder) if n.endswith(".parquet"))
    return out


def plain(batches, updates):
    """Rows by key, as a plain loop merges them; updates None: whole rows."""
    held = {}
    for batch in batches:
        for key, note, score, _ in sorted(batch, key=lambda r: r[3]):
            if key in held and updates == ["score"]:
                held[key] = (key, held[key][1], score)
            else:
                held[key] = (key, note, score)
    return sorted(held.values(), key=repr)


BATCHES = [
    [(f"k{i}", "first", i, i) for i in range(40)] + [("k1", "again", 99, 50)],
    [("k1", "second", 7, 1), ("k2", "second", None, 1), ("new", "second", 1, 1)],
    [("k1", "third", 8, 1), ("k3", "third", 3, 1), ("k3", "later", 4, 2)],
    [("k1", "fourth", 9, 1)],
]


@pytest.mark.parametrize("updates, most", [(["score"], 1), (["score"], 8), (None, 0)])
def test_merges_equal_a_plain_loop(spark, tmp_path, updates, most):
    make = (lambda p, **o: M.partial_table(p, SCHEMA, ["key"], updates, **o)) if updates else (lambda p, **o: M.full_table(p, SCHEMA, ["key"], **o))
    table = make(str(tmp_path / "t"), buckets=4, most_changes=most)
    assert table.latest(spark) is None and table.read(spark).count() == 0
    for version, batch in enumerate(BATCHES):
        for _ in range(2 if most == 1 else 1):  # a batch that runs again changes nothing
            table.apply(frame(spark, batch), version, ["at"], version - 1 if version else None)
        assert rows(table.read(spark)) == plain(BATCHES[: version + 1], updates)
    assert rows(table.read(spark, 0)) == plain(BATCHES[:1], updates)  # earlier versions stay readable
    most_folders = max(len([e for e in table.entries(spark, 3) if e.bucket == b]) for b in range(4))
    assert most_folders <= most + 1
    table.vacuum(spark, keep=1)
    assert table.latest(spark) == 3 and rows(table.read(spark)) == plain(BATCHES, updates)
    assert not os.path.exists(f"{table.path}/manifest/version=0")


def test_untouched_buckets_keep_their_files_and_are_not_sorted(spark, tmp_path):
    table = M.partial_table(str(tmp_path / "t"), SCHEMA, ["key"], ["score"], buckets=8, most_changes=0)
    table.apply(frame(spark, BATCHES[0]), 0, ["at"])
    before = files(table, spark, 0)
    touched = table.apply(frame(spark, [("k1", "x", 1, 1)]), 1, ["at"], 0)
    after = files(table, spark, 1)
    assert len(touched) == 1 and all(after[b] == before[b] for b in before if b not in touched)
    assert all(not (after[b] & before[b]) for b in touched)
    plan = table.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def test_a_failed_swap_changes_nothing(spark, tmp_path, monkeypatch):
    table = M.full_table(str(tmp_path / "t"), SCHEMA, ["key"], buckets=4, most_changes=0)
    table.apply(frame(spark, BATCHES[0]), 0, ["at"])
    want = rows(table.read(spark))
    with monkeypatch.context() as broken:
        broken.setattr(B.BucketTable, "_swap", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.apply(frame(spark, BATCHES[1]), 1, ["at"], 0)
    os.makedirs(f"{table.path}/manifest/version=1/_temporary")  # what a write that did not end leaves
    assert table.latest(spark) == 0 and rows(table.read(spark)) == want
    table.apply(frame(spark, BATCHES[1]), 1, ["at"], 0)
    assert rows(table.read(spark)) == plain(BATCHES[:2], None)


def test_lookups_open_only_buckets_that_may_hold_the_keys(spark, tmp_path):
    table = M.full_table(str(tmp_path / "t"), SCHEMA, ["key"], buckets=16)
    for version, part in enumerate((range(0, 300), range(300, 500))):
        table.apply(frame(spark, [(f"k{i}", "n", i, 0) for i in part]), version, ["at"], version - 1 if version else None)
    asked = spark.createDataFrame([(f"k{i}", i) for i in (5, 5, 450)] + [(f"absent{i}", i) for i in range(2000)] + [(None, 1)], "key string, extra int")
    maybe = table.may_hold(asked)
    assert maybe.where("key like 'k%'").count() == 3 and maybe.count() < 3 + 200
    assert rows(table.known(asked)) == [("k450", 450), ("k5", 5), ("k5", 5)]
    few = spark.createDataFrame([("k5", 1)], "key string, extra int")
    opened = {re.search(r"bucket=(\d+)", f)[1] for f in table.known(few).inputFiles()}
    want = few.select(table.bucket_of().alias("b")).first().b
    assert opened == {str(want)}
    assert table.known(spark.createDataFrame([], "key string, extra int")).count() == 0


def test_replace_and_drop(spark, tmp_path):
    table = M.full_table(str(tmp_path / "t"), SCHEMA, ["key"], bucket=F.col("score"), filtered=False)
    table.apply(frame(spark, [("a", "x", 1, 0), ("b", "x", 2, 0), ("c", "x", 3, 0)]), 0, ["at"])
    before = files(table, spark, 0)
    table.replace(frame(spark, [("d", "y", 2, 0)]), 1, 0, {2, 3})
    assert rows(table.read(spark)) == [("a", "x", 1), ("d", "y", 2)] and files(table, spark, 1)[1] == before[1]
    with pytest.raises(ValueError):
        table.replace(frame(spark, [("d", "y", 1, 0)]), 2, 1, {2})
    table.apply(frame(spark, [("e", "z", 2, 0)]), 2, ["at"], 1, drop={1})
    assert rows(table.read(spark)) == [("d", "y", 2), ("e", "z", 2)]


def test_weeks_without_new_posts_keep_their_files(spark, tmp_path):
    from threadloom.operators import trends as T

    posts = spark.createDataFrame([(f"p{i}", f"2024-01-{day:02d}", 1) for i, day in enumerate((1, 3, 9, 16, 23))], "post_id string, day string, subreddit_id int")
    posts = posts.withColumn("created_date", F.to_timestamp("day"))
    analysis = spark.createDataFrame([(f"p{i}", ["a"], f"2024-02-0{1 if i < 3 else 3}") for i in range(5)], "post_id string, tech_mentioned array<string>, at string")
    analysis = analysis.withColumn("processed_date", F.to_timestamp("at"))
    table = T.weekly_table(str(tmp_path / "weekly"))
    everything = T.refresh_weekly_table(table, posts, analysis, F.lit("2024-01-01").cast("timestamp"), 0)
    before = files(table, spark, 0)
    recounted = T.refresh_weekly_table(table, posts, analysis, F.lit("2024-02-02").cast("timestamp"), 1, 0)
    after = files(table, spark, 1)
    assert len(everything) == 4 and len(recounted) == 2 and recounted < everything
    assert all((after[w] == before[w]) == (w not in recounted) for w in before)
    assert rows(table.read(spark)) == rows(T.weekly_mentions_full(posts, analysis))
    assert T.refresh_weekly_table(table, posts, analysis, F.lit("2025-01-01").cast("timestamp"), 2, 1) == set()
    assert files(table, spark, 2) == after


def test_some_columns_are_read_and_folded_alone(spark, tmp_path):
    for name, table in (
        ("partial", M.partial_table(str(tmp_path / "p"), SCHEMA, ["key"], ["score"], buckets=2)),
        ("full", M.full_table(str(tmp_path / "f"), SCHEMA, ["key"], buckets=2)),
    ):
        for version, batch in enumerate(BATCHES[:2]):
            table.apply(frame(spark, batch), version, ["at"], version - 1 if version else None)
        everything = plain(BATCHES[:2], None if name == "full" else ["score"])
        assert rows(table.read(spark, columns=["note", "key"])) == sorted(((n, k) for k, n, _ in everything), key=repr)
        assert rows(table.read(spark, columns=["score"])) == sorted(((s,) for _, _, s in everything), key=repr)
        assert rows(table.read(spark, columns=["key"])) == sorted(((k,) for k, _, _ in everything), key=repr)
        plan = table.read(spark, columns=["key", "score"])._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan and "struct(score" in plan and "note" not in re.sub(r"Relation \[.*", "", plan)


def test_first_rows_of_a_bucket_are_written_once(spark, tmp_path):
    table = M.full_table(str(tmp_path / "t"), SCHEMA, ["key"], buckets=4, most_changes=0)
    table.apply(frame(spark, BATCHES[0]), 0, ["at"])
    assert {e.kind for e in table.entries(spark, 0)} == {B.CHANGES} and not os.path.exists(f"{table.path}/base")
    table.apply(frame(spark, BATCHES[1]), 1, ["at"], 0)
    assert rows(table.read(spark)) == plain(BATCHES[:2], None)


def test_a_new_base_has_the_filters_of_its_folders(spark, tmp_path):
    batches = [
        [("a", "x", 1, 0), ("b", "x", 1, 0), (None, "x", 1, 0), ("", "x", 1, 0)] + [(f"k{i}", "x", i, 0) for i in range(60)],
        [("a", "y", 2, 0), ("a", "z", 3, 1), (None, "y", 2, 0), ("c", "y", None, 0)],
        [("k7", "w", 4, 0), ("d", "w", 4, 0), (None, "w", 4, 0)],
    ]
    for most in (0, 1):
        table = M.full_table(str(tmp_path / f"t{most}"), SCHEMA, ["key"], buckets=4, most_changes=most)
        read = []
        with pytest.MonkeyPatch.context() as patch:
            plain_rows = B.BucketTable._rows

            def noted(self, session, entries, schema, suffix=""):
                found = plain_rows(self, session, entries, schema, suffix)
                read.extend((e, suffix) for e in entries)
                return found

            patch.setattr(B.BucketTable, "_rows", noted)
            for version, batch in enumerate(batches):
                table.apply(frame(spark, batch), version, ["at"], version - 1 if version else None)
        # A folder is opened for its keys when it is new and for its rows when it is merged, never for the keys of a base just written.
        bases = [e for e in table.entries(spark, 2) if e.kind == B.BASE]
        assert bases and all((e, "") not in read for e in bases if e.version == 2)
        for version in range(3):
            for e in table.entries(spark, version):
                folder = f"{table.path}/{e.kind}_filter/version={e.version}/bucket={e.bucket}"
                keys = spark.read.schema(SCHEMA).parquet(f"{table.path}/{e.kind}/version={e.version}/bucket={e.bucket}")
                want = keys.groupBy(table._word().alias("word")).agg(F.bit_or(table._mask()).alias("bits"))
                assert rows(spark.read.parquet(folder), "word", "bits") == rows(want)
        # Changes that are merged at once need none.
        named = {(e.kind, e.version, e.bucket) for v in range(3) for e in table.entries(spark, v)}
        for version in range(3):
            folder = f"{table.path}/changes_filter/version={version}"
            made = {int(n.removeprefix("bucket=")) for n in os.listdir(folder) if n.startswith("bucket=")} if os.path.exists(folder) else set()
            assert made == {b for kind, v, b in named if kind == B.CHANGES and v == version}
        asked = spark.createDataFrame([(k,) for k in ("a", "c", "d", "k59", "", "absent")], "key string")
        assert rows(table.known(asked)) == [("",), ("a",), ("c",), ("d",), ("k59",)]


def test_persisted_rows_are_shuffled_where_their_key_comes_again_only(spark, tmp_path):
    few = [(f"k{i}", "once", i, 0) for i in range(30)] + [("k1", "again", 70, 2), ("k1", "later", 71, 3), (None, "x", 1, 0), (None, "y", 2, 1), ("", "e", 1, 0)]
    batches = [few, [("k1", "second", 7, 1), (None, "second", None, 1), ("new", "second", 1, 1)], [("k2", "n", 5, 1), ("k2", "m", 6, 0), ("k2", "o", 7, 2)], []]
    for name, updates, most in (("partial", ["score"], 1), ("full", None, 0)):
        make = (lambda p, **o: M.partial_table(p, SCHEMA, ["key"], ["score"], **o)) if updates else (lambda p, **o: M.full_table(p, SCHEMA, ["key"], **o))
        table = make(str(tmp_path / name), buckets=4, most_changes=most)
        for version, batch in enumerate(batches):
            table.apply(frame(spark, batch), version, ["at"], version - 1 if version else None, persisted=True)
        assert rows(table.read(spark)) == plain(batches, updates)
        asked = spark.createDataFrame([(k,) for k in ("k1", "k29", "new", "", "absent")], "key string")
        assert rows(table.known(asked)) == [("",), ("k1",), ("k29",), ("new",)]

    def steps(batch):
        return table._folded(frame(spark, batch), ["at"], True)._jdf.queryExecution().optimizedPlan().toString()

    assert "LeftAnti" in steps(few) and "LeftSemi" in steps(few)
    alone = steps([("a", "n", 1, 0), ("b", "n", 1, 0), (None, "n", 1, 0)])
    assert "Aggregate" not in alone and "Join" not in alone
    assert "Aggregate" in steps(batches[2]) and "Join" not in steps(batches[2])
