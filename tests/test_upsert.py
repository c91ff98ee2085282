import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake import schemas as S
from eventlake.operators import upsert as U

ROW = S.row(k=S.STRING, t=S.LONG, o=S.LONG, v=S.STRING)
GUARD = U.newer("t", "o")


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def apply(state, source, **options):
    return U.merge(state, source, ["k"], **options)


def test_guarded_merge_and_change_rows(spark):
    state = frame(spark, [("a", 5, 1, "old"), ("b", 5, 2, "old"), ("c", 5, 3, "old")])
    source = frame(spark, [("a", 6, 4, "new"), ("b", 4, 5, "late"), ("d", 1, 6, "first")])
    verdicts = apply(state, source, guard=U.newer("t"))
    assert rows_of(U.merged_state(verdicts)) == [
        ("a", 6, 4, "new"),
        ("b", 5, 2, "old"),
        ("c", 5, 3, "old"),
        ("d", 1, 6, "first"),
    ]
    assert rows_of(U.change_rows(verdicts, 7)) == [
        ("insert", "d", 1, 6, "first", 7),
        ("update_postimage", "a", 6, 4, "new", 7),
        ("update_preimage", "a", 5, 1, "old", 7),
    ]


def test_equal_time_changes_nothing(spark):
    state, source = frame(spark, [("a", 5, 1, "old")]), frame(spark, [("a", 5, 9, "same time")])
    assert rows_of(U.merged_state(apply(state, source, guard=U.newer("t")))) == [("a", 5, 1, "old")]


def test_null_keys_match_each_other(spark):
    state, source = frame(spark, [(None, 1, 1, "old")]), frame(spark, [(None, 2, 2, "new")])
    assert rows_of(U.merged_state(apply(state, source))) == [(None, 2, 2, "new")]


def test_null_guard_is_no_update(spark):
    state, source = frame(spark, [("a", None, 1, "old")]), frame(spark, [("a", 2, 2, "new")])
    assert rows_of(U.merged_state(apply(state, source, guard=U.newer("t")))) == [("a", None, 1, "old")]


def test_duplicate_source_key_is_an_error(spark):
    twice = frame(spark, [("a", 1, 1, "x"), ("a", 2, 2, "y")])
    with pytest.raises(U.DuplicateSourceKey, match="2 source rows"):
        apply(frame(spark, []), twice)


def test_soft_delete_marks_missing_rows_once(spark):
    state = frame(spark, [("a", 1, 1, "active"), ("b", 1, 2, "active"), ("c", 1, 3, "inactive")])
    source = frame(spark, [("a", 1, 1, "active")])
    verdicts = apply(state, source, when_missing_set={"v": F.lit("inactive")}, guard=lambda s, t: F.lit(False))
    assert rows_of(U.merged_state(verdicts)) == [
        ("a", 1, 1, "active"),
        ("b", 1, 2, "inactive"),
        ("c", 1, 3, "inactive"),
    ]
    assert {r[1] for r in rows_of(U.change_rows(verdicts))} == {"b"}


def test_delete_missing(spark):
    state, source = frame(spark, [("a", 1, 1, "x"), ("b", 1, 2, "y")]), frame(spark, [("a", 1, 1, "x")])
    verdicts = apply(state, source, delete_missing=lambda old: old["v"] == "y")
    assert rows_of(U.merged_state(verdicts)) == [("a", 1, 1, "x")]
    assert ("delete", "b", 1, 2, "y") in rows_of(U.change_rows(verdicts))


def test_update_of_selected_columns(spark):
    state = frame(spark, [("a", 1, 1, "x"), ("b", 1, 1, "x")])
    source = frame(spark, [("a", 9, 9, "cancel"), ("b", 9, 9, "other"), ("c", 9, 9, "cancel")])
    verdicts = apply(
        state,
        source,
        guard=lambda s, t: s["v"] == "cancel",
        update_set={"v": lambda s, t: s["v"]},
        insert=False,
    )
    assert rows_of(U.merged_state(verdicts)) == [("a", 1, 1, "cancel"), ("b", 1, 1, "x")]


def test_prefer_known_keeps_old_value(spark):
    state, source = frame(spark, [("a", 1, 1, "name")]), frame(spark, [("a", 2, 2, None)])
    assert rows_of(U.merged_state(apply(state, source))) == [("a", 2, 2, None)]
    assert rows_of(U.merged_state(apply(state, source, prefer_known=["v"]))) == [("a", 2, 2, "name")]


def test_ties_inside_a_batch(spark):
    when = dt.datetime(2026, 1, 1)
    schema = S.row(client_id=S.STRING, consent_type=S.STRING, event_time=S.TIME, topic=S.STRING, offset=S.LONG, item_no=S.INT, v=S.STRING)
    rows = [("c", "a", when, "s", 9, 0, "w")] + [("c", "a", when, "t", o, i, v) for o, i, v in ((1, 0, "x"), (2, 0, "y"), (2, 1, "z"))]
    for order in (rows, rows[::-1]):
        assert U.newest_items(spark.createDataFrame(order, schema)).first()["v"] == "z"


def test_merge_decisions(spark):
    schema = S.row(k=S.STRING, at=S.STRING)
    state = spark.createDataFrame([("a", "2026-07-20T10:00:00"), ("b", "2026-07-20T10:00:00")], schema)
    source = spark.createDataFrame(
        [("a", "2026-07-20T09:30:00"), ("b", "2026-07-20T10:00:01"), ("c", "2026-07-20"), ("a", "soon")], schema
    )
    found = sorted((r.k, r.decision) for r in U.merge_decisions(state, source, ["k"], "at").collect())
    assert found == [("a", "ignore"), ("a", "invalid_time"), ("b", "update"), ("c", "insert")]


def test_decisions_are_those_of_the_merge_at_equal_times(spark):
    schema = S.row(k=S.STRING, at=S.STRING, o=S.LONG)
    state = spark.createDataFrame([("a", "2026-07-20T10:00:00", 5), ("b", "2026-07-20T10:00:00", 5)], schema)
    source = spark.createDataFrame([("a", "2026-07-20T10:00:00", 6), ("b", "2026-07-20T10:00:00", 5)], schema)
    found = {r.k: r.decision for r in U.merge_decisions(state, source, ["k"], "at", ("o",)).collect()}
    assert found == {"a": "update", "b": "ignore"}


events = st.lists(
    st.tuples(st.sampled_from("abc"), st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=12,
    unique_by=lambda e: e[2],
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.randoms())
def test_any_batching_gives_the_newest_row_per_key(spark, history, rng):
    rows = [(k, t, o, f"{k}{t}{o}") for k, t, o in history]
    expected = {}
    for row in rows:
        if row[0] not in expected or (row[1], row[2]) > (expected[row[0]][1], expected[row[0]][2]):
            expected[row[0]] = row
    shuffled = rows[:]
    rng.shuffle(shuffled)
    cut = rng.randint(0, len(shuffled))
    state = frame(spark, [])
    # Two batches in any order, the first of them replayed at the end.
    for part in (shuffled[:cut], shuffled[cut:], shuffled[:cut]):
        newest = U.latest_per_key(frame(spark, part), ["k"], [F.desc("t"), F.desc("o")])
        state = frame(spark, [tuple(r) for r in U.merged_state(apply(state, newest, guard=GUARD)).collect()])
    assert rows_of(state) == sorted(expected.values(), key=repr)
