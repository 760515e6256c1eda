"""Change capture by hand-made rows, by brute force and by law: any order, any split, any plan."""

import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from tierflow.operators.cdc import (
    ChangeOptions,
    apply_changes,
    history_schema,
    rejected_changes,
)
from tierflow.streaming.changes import ChangeTarget, open_changes

DDL = "k int, seq int, op string, a int, b int"
DEL = "op = 'D'"
SPLIT = {"hot_key_rows": 3}


def frame(spark, events):
    return spark.createDataFrame(events, DDL)


def brute_type1(events, keep_nulls=(), truncate=False):
    cut = max((e[1] for e in events if e[2] == "T"), default=None) if truncate else None
    out = []
    for key in {e[0] for e in events}:
        mine = [e for e in events if e[0] == key and e[2] != "T" and e[1] is not None]
        if cut is not None:
            mine = [e for e in mine if e[1] >= cut]
        gone = max((e[1] for e in mine if e[2] == "D"), default=None)
        live = [e for e in mine if e[2] != "D" and (gone is None or e[1] > gone)]
        if not live:
            continue
        # Equal sequence: the larger row in column order; NULL is smaller than any value.
        order = lambda e: (e[1], [(x is not None, x) for x in (e[2], e[3], e[4])])
        best = list(max(live, key=order))
        for i in keep_nulls:
            filled = [e for e in live if e[i] is not None]
            best[i] = max(filled, key=lambda e: (e[1], e[i]))[i] if filled else None
        out.append((best[0], best[1], best[3], best[4]))
    return sorted(out, key=lambda t: t[0])


def brute_type2(events, tracked=(3, 4), keep_nulls=()):
    """Versions as (k, a, b, start, end); sequences are unique per key here."""
    out = []
    for key in {e[0] for e in events}:
        current, held = None, {}
        for e in sorted((e for e in events if e[0] == key), key=lambda e: e[1]):
            if e[2] == "D":
                if current:
                    out.append((*current, e[1]))
                current, held = None, {}
                continue
            row = list(e)
            for i in keep_nulls:
                row[i] = held[i] = row[i] if row[i] is not None else held.get(i)
            if current and all(row[i] == current[{3: 1, 4: 2}[i]] for i in tracked):
                current = (key, row[3], row[4], current[3])
                continue
            if current:
                out.append((*current, e[1]))
            current = (key, row[3], row[4], e[1])
        if current:
            out.append((*current, None))
    return sorted(out, key=lambda t: (t[0], t[3]))


def unique_events(draw_rows):
    """One event per (key, sequence)."""
    return list({(e[0], e[1]): e for e in draw_rows}.values())


small = st.integers(0, 3)
event = st.tuples(small, st.integers(0, 12), st.sampled_from(["U", "U", "U", "D"]), st.none() | small, st.none() | small)
many = st.lists(event, min_size=1, max_size=40)
law = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)


def type1(df, **options):
    out = apply_changes(df, ["k"], "seq", 1, apply_as_deletes=DEL, except_column_list=["op"], **options)
    return sorted(tuple(r) for r in out.select("k", "seq", "a", "b").collect())


def type2(df, limits=None, **options):
    out = apply_changes(
        df, ["k"], "seq", 2, apply_as_deletes=DEL, column_list=["a", "b"], **options, **(limits or {})
    )
    got = [tuple(r) for r in out.select("k", "a", "b", "__START_AT", "__END_AT").collect()]
    return sorted(got, key=lambda t: (t[0], t[3]))


@law
@given(many)
def test_type1_equals_brute_force(spark, events):
    got = apply_changes(frame(spark, events), ["k"], "seq", 1, apply_as_deletes=DEL)
    assert sorted(tuple(r) for r in got.select("k", "seq", "a", "b").collect()) == brute_type1(events)


@law
@given(many)
def test_type1_null_updates_equal_brute_force(spark, events):
    events = unique_events(events)
    got = type1(frame(spark, events), ignore_null_updates_column_list=["a"])
    assert got == brute_type1(events, keep_nulls=(3,))


@law
@given(many)
def test_type2_equals_brute_force_on_both_plans(spark, events):
    events = unique_events(events)
    want = brute_type2(events)
    assert type2(frame(spark, events)) == want
    assert type2(frame(spark, events), SPLIT) == want


@law
@given(many)
def test_type2_tracked_columns_on_both_plans(spark, events):
    events = unique_events(events)
    want = brute_type2(events, tracked=(3,))
    options = {"track_history_column_list": ["a"]}
    assert type2(frame(spark, events), **options) == want
    assert type2(frame(spark, events), SPLIT, **options) == want


@law
@given(many)
def test_type2_null_updates_on_both_plans(spark, events):
    events = unique_events(events)
    want = brute_type2(events, keep_nulls=(3, 4))
    options = {"ignore_null_updates": True}
    assert type2(frame(spark, events), **options) == want
    assert type2(frame(spark, events), SPLIT, **options) == want


@pytest.mark.parametrize("scd", ["1", "2"])
@pytest.mark.parametrize("nulls", [None, ("a",)])
def test_any_batch_split_gives_the_batch_result(spark, tmp_path, scd, nulls):
    rng = random.Random(7)
    events = unique_events(
        [(rng.randrange(4), rng.randrange(30), rng.choice("UUUD"), rng.choice([None, 1, 2]), rng.randrange(3)) for _ in range(60)]
    )
    opts = ChangeOptions(
        ("k",), "seq", scd, apply_as_deletes=DEL, except_column_list=("op",), ignore_null_updates_column_list=nulls
    )
    want = rows(apply_changes(frame(spark, events), opts))
    target = ChangeTarget(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), opts, buckets=3)
    target.describe()
    rng.shuffle(events)
    # Three batches out of order, one of them replayed under a new number, one under its old number.
    batches = [events[:20], events[20:45], events[45:], events[10:30]]
    for i, batch in enumerate(batches):
        target.absorb(frame(spark, batch), i)
        if i != 1:
            target.publish()
    target.absorb(frame(spark, batches[-1]), len(batches) - 1)
    target.publish()
    assert rows(target.read()) == want
    assert rows(open_changes(spark, str(tmp_path / "t")).read()) == want


def test_truncate_removes_earlier_events(spark, tmp_path):
    events = [(1, 1, "U", 1, 1), (2, 2, "U", 1, 1), (0, 3, "T", None, None), (2, 3, "U", 2, 2), (3, 5, "U", 3, 3)]
    opts = ChangeOptions(("k",), "seq", apply_as_deletes=DEL, apply_as_truncates="op = 'T'")
    want = [(2, 3, "U", 2, 2), (3, 5, "U", 3, 3)]
    assert rows(apply_changes(frame(spark, events), opts)) == want
    target = ChangeTarget(spark, str(tmp_path / "t"), T.StructType.fromDDL(DDL), opts, buckets=2)
    for i, e in enumerate([events[3:], events[:2], events[2:3]]):
        target.absorb(frame(spark, e), i)
        target.publish()
    assert rows(target.read()) == want


def test_null_sequence_is_rejected(spark):
    df = frame(spark, [(1, None, "U", 1, 1), (1, 1, "U", 2, 2)])
    opts = ChangeOptions(("k",), "seq")
    assert rows(apply_changes(df, opts), "a") == [(2,)]
    assert rows(rejected_changes(df, opts), "a") == [(1,)]


def test_null_keys_are_a_key(spark):
    df = frame(spark, [(None, 1, "U", 1, 1), (None, 2, "U", 2, 2), (1, 1, "U", 3, 3)])
    assert rows(apply_changes(df, ["k"], "seq", 1), "k", "a") == [(None, 2), (1, 3)]
    plain = rows(apply_changes(df, ["k"], "seq", 2))
    assert rows(apply_changes(df, ["k"], "seq", 2, hot_key_rows=1)) == plain


def test_struct_sequence_sorts_nulls_first(spark):
    df = spark.createDataFrame([(1, None, 9, "x"), (1, 1, 1, "y")], "k int, s1 int, s2 int, v string")
    assert rows(apply_changes(df, ["k"], "struct(s1, s2)", 1), "v") == [("y",)]


def test_unorderable_columns_still_break_ties(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS s, map('x', i) AS m FROM VALUES (1), (3), (2) t(i)")
    assert rows(apply_changes(df, ["k"], "s", 1).selectExpr("m['x']")) == [(3,)]
    assert rows(apply_changes(df, ["k"], "s", 2).selectExpr("m['x']")) == [(3,)]
    feed = spark.sql(
        """SELECT 1 AS k, i AS s, CASE WHEN i < 3 THEN map('x', 1, 'y', 2) WHEN i = 3 THEN map('y', 2, 'x', 1) END AS m,
        parse_json('{"a":1}') AS v FROM VALUES (1), (2), (3), (4) t(i)"""
    )
    options = {"column_list": ["m", "v"], "ignore_null_updates": True}
    assert rows(apply_changes(feed, ["k"], "s", 2, **options).selectExpr("m['y']", "to_json(v)", "__START_AT")) == [(2, '{"a":1}', 1)]
    assert rows(apply_changes(feed, ["k"], "s", 1, **options).selectExpr("m['x']")) == [(1,)]


def test_hot_key_is_cut_into_runs(spark):
    """One key holds most rows; the split plan must not put them into one window group."""
    events = [(0 if i % 3 else i, i, "D" if i % 50 == 0 else "U", i // 7, i % 2) for i in range(600)]
    df = frame(spark, events)
    assert type2(df, {"hot_key_rows": 40}) == brute_type2(events)


def test_option_checks():
    with pytest.raises(ValueError, match="mandatory"):
        ChangeOptions.of({"keys": ["k"], "scd_type": "1"})
    with pytest.raises(ValueError, match="scd_type"):
        ChangeOptions(("k",), "s", "3")
    with pytest.raises(ValueError, match="truncates"):
        ChangeOptions(("k",), "s", "2", apply_as_truncates="true")
    with pytest.raises(ValueError, match="exclude"):
        ChangeOptions(("k",), "s", column_list=("a",), except_column_list=("b",))
    told = ChangeOptions.of({"keys": ["k"], "sequence_by": "s", "scd_type": "1", "apply_as_deletes": "", "once": "true"})
    assert told.apply_as_deletes is None and told.once is True


def test_history_schema_has_typed_bounds():
    schema = T.StructType(
        [T.StructField("id", T.IntegerType()), T.StructField("op", T.StringType()), T.StructField("ts", T.TimestampType())]
    )
    out = history_schema(schema, T.TimestampType(), ["op"])
    assert out.fieldNames() == ["id", "ts", "__START_AT", "__END_AT"]
    assert out["__END_AT"].dataType == T.TimestampType()


def test_names_ignore_case(spark):
    df = frame(spark, [(1, 1, "U", 1, 1), (1, 2, "U", 2, 2)])
    assert apply_changes(df, ["K"], "SEQ", 1, except_column_list=["OP"]).columns == ["k", "seq", "a", "b"]



def test_streams_are_refused(spark):
    with pytest.raises(ValueError, match="apply_changes_stream"):
        apply_changes(spark.readStream.format("rate").load(), ["value"], "timestamp", 1)
