import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tierflow.operators.snapshots import (
    apply_snapshots,
    empty_history,
    snapshot_changes,
    snapshot_options,
    snapshot_step_type1,
    snapshot_step_type2,
)
from tierflow.sources.tables import snapshot_series

SERIES = {
    1: [(1, "a"), (2, "b"), (3, "c"), (4, None)],
    2: [(1, "a2"), (2, "b"), (4, None)],
    3: [(1, "a2"), (5, "e"), (3, "c")],
}
HISTORY = [
    (1, "a", 1, 2),
    (1, "a2", 2, None),
    (2, "b", 1, 3),
    (3, "c", 1, 2),
    (3, "c", 3, None),
    (4, None, 1, 3),
    (5, "e", 3, None),
]


def snapshots(spark, series=SERIES):
    return [(spark.createDataFrame(r, "id int, v string"), v) for v, r in series.items()]


def in_order(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0], t[2]))


def test_history_of_three_snapshots(spark):
    assert in_order(apply_snapshots(snapshots(spark), ["id"], 2)) == HISTORY
    opts = snapshot_options(["id"], 2)
    state = empty_history(snapshots(spark)[0][0])
    for df, version in snapshots(spark):
        state = snapshot_step_type2(state, df, version, opts)
    assert in_order(state) == HISTORY


def test_untracked_columns_take_the_latest_value(spark):
    series = {1: [(1, "a", 1)], 2: [(1, "a", 2)], 5: [(1, "b", 3)]}
    frames = [(spark.createDataFrame(r, "id int, v string, n int"), v) for v, r in series.items()]
    want = [(1, "a", 2, 1, 5), (1, "b", 3, 5, None)]
    assert rows(apply_snapshots(frames, ["id"], 2, track_history_except_column_list=["n"])) == want
    opts = snapshot_options(["id"], 2, ["v"])
    state = empty_history(frames[0][0])
    for df, version in frames:
        state = snapshot_step_type2(state, df, version, opts)
    assert rows(state) == want


def test_type1_is_the_last_snapshot(spark):
    assert rows(apply_snapshots(snapshots(spark), ["id"], 1)) == sorted(SERIES[3])
    (first, _), (second, _), _ = snapshots(spark)
    assert rows(snapshot_step_type1(first, second, ["id"])) == sorted(SERIES[2])
    assert rows(snapshot_changes(first, second, ["id"])) == [("delete", 3, "c"), ("update", 1, "a2")]


def test_bad_snapshots_are_errors(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string")
    for scd in (1, 2):
        with pytest.raises(PySparkException, match="twice"):
            apply_snapshots([(twice, 1)], ["id"], scd).collect()
    with pytest.raises(ValueError, match="rise"):
        apply_snapshots([(twice, 2), (twice, 2)], ["id"], 2)
    with pytest.raises(ValueError, match="no snapshot"):
        apply_snapshots([], ["id"])
    with pytest.raises(ValueError, match="does not follow"):
        list(snapshot_series(lambda latest: (twice, 1)))
