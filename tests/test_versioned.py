import json
import os

import pytest
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import quality as Q
from eventlake.operators import upsert as U
from eventlake.plans import tables as X
from eventlake.sources.versioned import VersionedTable

ROW = S.row(k=S.STRING, t=S.LONG, v=S.STRING)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable.create(spark, str(tmp_path / "t"), ROW, ["k"], buckets=4)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def merge(table, spark, *rows, **options):
    return table.merge(frame(spark, *rows), guard=U.newer("t"), **options)


def test_empty_table_reads_as_empty(table):
    assert table.read().count() == 0 and table.versions() == []
    assert table.changes(0).count() == 0


def test_versions_changes_and_time_travel(spark, table):
    merge(table, spark, ("a", 1, "x"), ("b", 1, "x"))
    merge(table, spark, ("a", 2, "y"), ("b", 0, "late"), ("c", 1, "x"))
    assert rows_of(table.read()) == [("a", 2, "y"), ("b", 1, "x"), ("c", 1, "x")]
    assert rows_of(table.read(version=1)) == [("a", 1, "x"), ("b", 1, "x")]
    assert rows_of(table.changes(after=1)) == [
        ("insert", "c", 1, "x", 2),
        ("update_postimage", "a", 2, "y", 2),
        ("update_preimage", "a", 1, "x", 2),
    ]
    assert table.changes(0, upto=1).count() == 2
    with pytest.raises(ValueError):
        table.read(version=9)


def test_only_touched_buckets_are_rewritten(spark, table):
    merge(table, spark, *[(f"k{n}", 1, "x") for n in range(40)])
    before = table.commit()
    merge(table, spark, ("k7", 2, "y"))
    after = table.commit()
    moved = [b for b in after.buckets if after.buckets[b] != before.buckets[b]]
    assert len(moved) == 1 and len(after.buckets) == 4
    assert table.read().count() == 40
    assert len(table.read(only=moved).inputFiles()) < len(table.read().inputFiles())


def test_replayed_batch_is_skipped(spark, table):
    merge(table, spark, ("a", 1, "x"), stream="s", batch_id=0)
    merge(table, spark, ("a", 9, "never"), stream="s", batch_id=0)
    merge(table, spark, ("b", 1, "x"), stream="other", batch_id=0)
    assert rows_of(table.read()) == [("a", 1, "x"), ("b", 1, "x")]
    assert table.versions() == [1, 2]
    assert table.already_applied("s", 0) and not table.already_applied("s", 1)


def test_files_without_commit_are_ignored_and_replaced(spark, table, monkeypatch):
    merge(table, spark, ("a", 1, "x"))

    def crash(self, commit):
        raise RuntimeError("died before the commit")

    with monkeypatch.context() as patched:
        patched.setattr(VersionedTable, "_publish", crash)
        with pytest.raises(RuntimeError):
            merge(table, spark, ("a", 2, "half"), ("z", 1, "half"))
    assert rows_of(table.read()) == [("a", 1, "x")]
    assert table.changes(1).count() == 0
    merge(table, spark, ("a", 3, "whole"))
    assert rows_of(table.read()) == [("a", 3, "whole")]
    assert rows_of(table.changes(1).select("v")) == [("whole",), ("x",)]


def test_deletes_can_empty_a_bucket(spark, table):
    merge(table, spark, ("a", 1, "x"), ("b", 1, "x"))
    table.merge(frame(spark), all_buckets=True, delete_missing=lambda old: F.lit(True))
    assert table.read().count() == 0
    assert {r[0] for r in rows_of(table.changes(1))} == {"delete"}
    merge(table, spark, ("a", 1, "again"))
    assert rows_of(table.read()) == [("a", 1, "again")]


def test_duplicate_keys_stop_the_merge(spark, table):
    with pytest.raises(U.DuplicateSourceKey):
        merge(table, spark, ("a", 1, "x"), ("a", 2, "y"))
    assert table.versions() == []


def test_compaction_keeps_rows_and_sorts_files(spark, table):
    for n in range(3):
        merge(table, spark, *[(f"k{i}", n, "x") for i in range(20)])
    before = rows_of(table.read())
    table.compact()
    assert rows_of(table.read()) == before
    assert table.changes(3).count() == 0
    for file in table.read().inputFiles():
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_expiry_writes_the_next_version(spark, table):
    merge(table, spark, ("old", 1, "x"), ("new", 9, "x"))
    table.replace(table.read().filter("t > 5"))
    assert rows_of(table.read()) == [("new", 9, "x")]
    assert table.read(version=1).count() == 2


def test_reopening_keeps_the_description(spark, table):
    again = VersionedTable.create(spark, table.path, S.row(other=S.STRING), ["other"], buckets=99)
    assert (again.schema, again.keys, again.buckets) == (ROW, ("k",), 4)


def test_lookup_reads_one_bucket(spark, table):
    merge(table, spark, *[(f"k{n}", 1, "x") for n in range(40)])
    found = table.lookup(k="k3")
    assert rows_of(found) == [("k3", 1, "x")]
    assert all("_bucket=" in f for f in found.inputFiles())
    assert len({f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1


def test_following_delivers_each_version_once(spark, table, tmp_path):
    seen = []

    def apply(changes, batch_id):
        seen.append(sorted({r._commit_version for r in changes.collect()}))

    checkpoint = str(tmp_path / "cp")
    table.follow(apply, checkpoint)
    merge(table, spark, ("a", 1, "x"))
    merge(table, spark, ("a", 2, "y"))
    table.follow(apply, checkpoint, max_commits_per_batch=1)
    assert seen == [[1], [2]]
    table.follow(apply, checkpoint)
    assert seen == [[1], [2]]
    merge(table, spark, ("b", 1, "x"))
    table.follow(apply, checkpoint)
    assert seen == [[1], [2], [3]]


def test_pending_spans_follow_the_targets_own_progress(spark, table, tmp_path):
    target = VersionedTable.create(spark, str(tmp_path / "target"), ROW, ["k"], buckets=2)
    for n in range(5):
        merge(table, spark, (f"k{n}", 1, "x"))
    spans = []
    for after, upto in table.pending(target, "t", max_versions=2):
        spans.append((after, upto))
        target.merge(
            table.changes(after, upto).filter("_change_type IN ('insert', 'update_postimage')").select(*ROW.fieldNames()),
            stream="t",
            batch_id=upto,
        )
    assert spans == [(0, 2), (2, 4), (4, 5)]
    assert list(table.pending(target, "t")) == []
    assert rows_of(target.read()) == rows_of(table.read())


def test_current_rows_and_missing_keys(spark, table):
    merge(table, spark, ("a", 1, "x"), ("b", 1, "x"), (None, 1, "x"))
    keys = spark.createDataFrame([("a",), (None,), ("z",)], "k string")
    assert rows_of(table.current_rows(keys)) == [("a", 1, "x"), (None, 1, "x")]
    assert rows_of(table.missing_keys(keys)) == [("z",)]


def test_commit_file_is_small_and_plain(table, spark):
    merge(table, spark, ("a", 1, "x"))
    with open(os.path.join(table.path, "commits", "000000000001.json")) as handle:
        body = json.loads(handle.read())
    assert body["version"] == 1 and set(body["buckets"].values()) == {1}
    with pytest.raises(FileExistsError):
        table._files.put_new(table._commit_path(1), "{}")


def test_shuffled_batches_of_the_event_log(spark, sf, tmp_path):
    """Four batches out of order, one replayed: the result is the newest row per key."""
    items = X.items(spark, sf)
    table = VersionedTable.create(spark, str(tmp_path / "s"), S.STATE, S.STATE_KEY, ["client_id"], 4)
    master = X.client_master(spark, sf)
    for part in (3, 0, 2, 1, 3):
        batch = X.state_of(items.filter(F.col("offset") % 4 == part), master)
        table.merge(batch, guard=U.newer("event_time", "offset"), unique_source=True)
    assert Q.differences(table.read(), X.state(spark, sf)).isEmpty()
    assert table.changes(4).isEmpty()


def test_a_bucket_is_merged_by_several_tasks(spark, tmp_path, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    row = S.row(k=S.LONG, v=S.LONG)
    table = VersionedTable.create(spark, str(tmp_path / "t"), row, ["k"], buckets=1)
    for turn in (1, 2):
        table.merge(spark.range(500 * turn).select(F.col("id").alias("k"), F.lit(turn).cast("long").alias("v")))
    assert len(table.read().inputFiles()) > 1
    assert {(r.v, r["count"]) for r in table.read().groupBy("v").count().collect()} == {(2, 1000)}
    assert table.changes(1).groupBy(U.CHANGE_TYPE).count().collect() and table.read().select("k").distinct().count() == 1000
