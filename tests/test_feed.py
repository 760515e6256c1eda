"""Change targets as merged runs, and change feeds over published tables."""

import json
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.cdc import ChangeOptions, apply_changes
from tierflow.operators.snapshots import apply_snapshots, snapshot_options
from tierflow.plans.medallion import MedallionRun
from tierflow.plans.specs import BronzeSpec, SilverSpec
from tierflow.sources.storage import children, publish
from tierflow.streaming.changes import ChangeTarget, open_changes
from tierflow.streaming.feed import CHANGE, COMMIT, keyed_changes, published_feed, row_changes
from tierflow.streaming.runs import FAN, Run, RunStore
from tierflow.streaming.snapshots import SnapshotTarget, open_snapshots

DDL = "k int, seq int, op string, a int, b int"
DEL = "op = 'D'"


def frame(spark, events):
    return spark.createDataFrame(events, DDL)


def target(spark, path, scd, **more):
    opts = ChangeOptions(("k",), "seq", scd, apply_as_deletes=DEL, except_column_list=("op",))
    made = ChangeTarget(spark, str(path), T.StructType.fromDDL(DDL), opts, buckets=2, **more)
    made.describe()
    return made


def files(path):
    return [p for p in path.rglob("*.parquet")]


@pytest.mark.parametrize("scd", ["1", "2"])
def test_many_publications_give_the_batch_result(spark, tmp_path, scd):
    """Mostly new changes, some late ones, some keys deleted; compaction runs on the way."""
    draw, made = random.Random(3), target(spark, tmp_path / "t", scd)
    seen = []
    for n in range(9):
        late = n in (4, 7)
        batch = [(draw.randrange(8), (draw.randrange(20) if late else 100 * n + 7 * i), draw.choice("UUUUD"), draw.choice([None, 1, 2]), draw.randrange(3)) for i in range(6)]
        batch = list({(e[0], e[1]): e for e in batch if (e[0], e[1]) not in {(x[0], x[1]) for x in seen}}.values())
        seen += batch
        made.absorb(frame(spark, batch), n)
        made.publish()
    assert rows(made.read()) == rows(apply_changes(frame(spark, seen), made.opts))
    runs = made.manifest()
    assert all(Counter(r.tier for r in getattr(runs, k)).most_common(1)[0][1] < FAN for k in ("log", "versions") if getattr(runs, k))


def test_publishing_few_keys_writes_little(spark, tmp_path):
    made = target(spark, tmp_path / "t", "2")
    made.absorb(spark.range(20_000).selectExpr("cast(id as int) AS k", "1 AS seq", "'U' AS op", "cast(id as int) AS a", "1 AS b"), 0)
    made.publish()
    for n in range(1, 4):
        made.absorb(spark.range(200).selectExpr("cast(id * 7 as int) AS k", f"{n + 1} AS seq", "'U' AS op", f"{-n} AS a", "1 AS b"), n)
        made.publish()
    sizes = {r.name: r.rows for r in made.manifest().versions}
    assert sizes["b0"] == 20_000 and sizes["b3"] == 400
    assert made.read().where("__END_AT IS NULL").count() == 20_000 and made.read().count() == 20_600


def test_keys_in_order_do_not_read_the_log(spark, tmp_path, monkeypatch):
    made = target(spark, tmp_path / "t", "2")
    asked = []
    late = ChangeTarget._late_history
    monkeypatch.setattr(ChangeTarget, "_late_history", lambda self, *a: asked.append(1) or late(self, *a))
    for n, batch in enumerate([[(1, 5, "U", 1, 1), (2, 5, "U", 1, 1)], [(1, 6, "U", 1, 2), (2, 9, "D", None, None)], [(2, 12, "U", 3, 3)], [(1, 5, "U", 9, 9), (3, 1, "U", 0, 0)]]):
        made.absorb(frame(spark, batch), n)
        made.publish()
        assert bool(asked) == (n == 3)
    got = rows(made.read(), "k", "a", "__START_AT", "__END_AT")
    assert got == sorted([(1, 9, 5, 6), (1, 1, 6, None), (2, 1, 5, 9), (2, 3, 12, None), (3, 0, 1, None)], key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_final_changes_leave_the_log_and_late_ones_are_set_apart(spark, tmp_path):
    made = target(spark, tmp_path / "t", "2", final_after="10")
    seen = []
    for n in range(12):
        batch = [(k, 5 * n + k, "U", (n + k) % 4, n) for k in range(4)]
        if n == 8:
            batch += [(1, 5 * n - 3, "D", None, None)]  # late, not yet final
        seen += batch
        made.absorb(frame(spark, batch), n)
        made.publish()
    made.absorb(frame(spark, [(0, 2, "U", 77, 77)]), 12)  # behind the mark
    made.publish()
    assert rows(made.read()) == rows(apply_changes(frame(spark, seen), made.opts))
    assert rows(made.rejects(), "k", "seq") == [(0, 2)]
    left = made.log.read(made.manifest().log)
    assert left.count() < len(seen) and made.manifest().mark == str(5 * 11 + 3 - 10)
    again = open_changes(spark, str(tmp_path / "t"))
    assert again.final_after == "10" and rows(again.read()) == rows(made.read())
    with pytest.raises(ValueError, match="final_after"):
        target(spark, tmp_path / "u", "1", final_after="10")


def test_a_batch_of_another_checkpoint_is_refused(spark, tmp_path):
    made = target(spark, tmp_path / "t", "1")
    for n in range(2):
        made.absorb(frame(spark, [(1, n, "U", n, n)]), n)
        made.publish()
    made.absorb(frame(spark, [(1, 1, "U", 1, 1)]), 1)  # the last one again
    with pytest.raises(ValueError, match="another checkpoint"):
        made.absorb(frame(spark, [(9, 9, "U", 9, 9)]), 0)


def test_tiers_bound_the_runs(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, v int")
    store = RunStore(spark, str(tmp_path), "s", schema, ["k"], ["k"], 2, lambda rows: rows.groupBy("k").agg(F.max("v").alias("v")))
    runs, want = [], {}
    for n in range(10):
        runs.append(store.write(spark.createDataFrame([(n % 3, n), (n, n)], schema).distinct(), f"b{n}"))
        want |= {n % 3: n, n: n}
        runs = store.compacted(runs, f"m{n}")
        assert len(runs) < FAN + 2
    assert {r["k"]: r["v"] for r in store.merged(runs).collect()} == want
    store.sweep({r.name for r in runs}, lambda name: True)
    assert set(store.names()) == {r.name for r in runs} and Run("x", 0).tier == 0


# --- feeds ---


def drained(stream, tmp_path, name="sink"):
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).start(str(tmp_path / name)).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(str(tmp_path / name))


def test_rows_count_in_a_table_without_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "a int, m map<string,int>, version int"
    publish(spark.createDataFrame([(1, {"x": 1}, 0), (1, {"x": 1}, 0), (2, None, 0)], ddl), path)
    first = drained(published_feed(spark, path).stream({"readChangeFeed": "true"}), tmp_path)
    assert sorted(first.selectExpr("a", CHANGE).collect()) == [(1, "insert"), (1, "insert"), (2, "insert")]
    publish(spark.createDataFrame([(1, {"x": 1}, 0), (3, {"y": 2}, 0)], ddl), path)
    publish(spark.createDataFrame([(1, {"x": 1}, 0), (3, {"y": 2}, 0), (3, {"y": 2}, 0)], ddl), path)
    second = drained(published_feed(spark, path).stream({"readChangeFeed": "true"}), tmp_path)
    assert sorted(second.where(f"{COMMIT} > 1").selectExpr("a", CHANGE, COMMIT, "m['y']").collect(), key=str) == [(1, "delete", 3, None), (2, "delete", 3, None), (3, "insert", 3, 2), (3, "insert", 3, 2)]
    # Nothing new: nothing comes, whoever asks.
    assert drained(published_feed(spark, path).stream({"readChangeFeed": "true"}), tmp_path).count() == 7
    assert sorted(r["a"] for r in drained(published_feed(spark, path).stream(), tmp_path, "other").collect()) == [1, 1, 2, 3, 3]


def test_keyed_changes_treat_null_keys_as_a_key(spark):
    before = spark.createDataFrame([(None, 1), (1, 1), (2, 2)], "k int, v int")
    after = spark.createDataFrame([(None, 5), (1, 1), (3, None)], "k int, v int")
    assert set(rows(keyed_changes(before, after, ["k"]))) == {(None, 5, "update"), (2, 2, "delete"), (3, None, "insert")}
    assert row_changes(before, before).count() == 0


@pytest.mark.parametrize("scd", ["1", "2"])
def test_a_feed_replays_to_the_target(spark, tmp_path, scd):
    """The feed's changes, applied in order, are the table, whatever publications lay between two reads."""
    draw, made = random.Random(11), target(spark, tmp_path / "t", scd)
    identity = (0,) if scd == "1" else (0, -2)
    state, seen = {}, 0
    for n in range(7):
        made.absorb(frame(spark, [(draw.randrange(5), 10 * draw.randrange(12) + draw.randrange(3), draw.choice("UUD"), draw.randrange(3), n) for _ in range(4)]), n)
        made.publish()
        if n in (0, 1, 4, 6):
            feed = drained(made.feed().stream({"readChangeFeed": "true"}), tmp_path)
            assert feed.count() >= seen
            seen = feed.count()
            for r in feed.where(f"{COMMIT} = {n}").collect():
                row, kind = tuple(r)[:-2], r[CHANGE]
                key = tuple(row[i] for i in identity)
                assert (key in state) == (kind != "insert")
                if kind == "delete":
                    assert state.pop(key) == row
                else:
                    assert state.get(key) != row
                    state[key] = row
            assert sorted(state.values(), key=str) == sorted(map(tuple, made.read().collect()), key=str)


def test_streaming_silver_over_change_capture_bronze(spark, tmp_path):
    source = str(tmp_path / "in")
    ddl = "id int, v string, s int, op string"
    bronze = BronzeSpec(
        "1", "g", targetDetails={"database": "raw", "table": "c"}, sourceFormat="parquet", sourceDetails={"path": source}, readerConfigOptions={},
        schema=T.StructType.fromDDL(ddl).json(),
        cdcApplyChanges=json.dumps({"keys": ["id"], "sequence_by": "s", "scd_type": "1", "apply_as_deletes": "op = 'D'", "except_column_list": ["op"]}),
    )
    silver = SilverSpec("1", "g", targetDetails={"database": "fine", "table": "c"}, sourceDetails={"database": "raw", "table": "c"}, selectExp=["id", "upper(v) AS v", "s"])
    whole = SilverSpec(
        "2", "g", targetDetails={"database": "fine", "table": "d"}, sourceDetails={"database": "raw", "table": "c"}, readerConfigOptions={"readChangeFeed": "true"},
        selectExp=["id", "v", "s", f"{CHANGE} AS kind", f"{COMMIT} AS at"],
        cdcApplyChanges=json.dumps({"keys": ["id"], "sequence_by": "at", "scd_type": "1", "apply_as_deletes": "kind = 'delete'", "except_column_list": ["kind", "at"]}),
    )
    arrived = []
    for batch in ([(1, "a", 1, "U"), (2, "b", 1, "U")], [(1, "a", 0, "U"), (3, "c", 1, "U")], [(2, None, 4, "D"), (1, "z", 5, "U")]):
        spark.createDataFrame(batch, ddl).write.mode("append").parquet(source)
        MedallionRun(spark, str(tmp_path / "lake"), buckets=2).run("bronze_silver", {"bronze": [bronze], "silver": [silver, whole]})
        run = MedallionRun(spark, str(tmp_path / "lake"), buckets=2)
        arrived.append(rows(run.read(silver)))
    assert arrived == [[(1, "A", 1), (2, "B", 1)], [(1, "A", 1), (2, "B", 1), (3, "C", 1)], [(1, "A", 1), (1, "Z", 5), (2, "B", 1), (3, "C", 1)]]
    assert rows(run.read(whole)) == rows(run.read(bronze)) == [(1, "z", 5), (3, "c", 1)]
    assert children(spark, str(tmp_path / "lake/raw/c/feed"))


# --- snapshots ---


def snapshot_frame(spark, rows_of):
    return spark.createDataFrame(rows_of, "k int, a string, m map<string,int>, b int")


@pytest.mark.parametrize("scd, tracked", [("1", None), ("2", None), ("2", ["a", "m"])])
@pytest.mark.parametrize("digests", [3, 1 << 16])
def test_snapshots_by_changes_give_the_series_result(spark, tmp_path, scd, tracked, digests):
    draw = random.Random(digests)
    series = []
    for version in (0, 2, 3, 7, 8, 9):
        keys = [k for k in [None, *range(9)] if draw.random() < 0.8]
        series.append((snapshot_frame(spark, [(k, draw.choice("xy"), {"p": draw.randrange(2)} if draw.random() < 0.8 else None, draw.randrange(2)) for k in keys]), version))
    opts = snapshot_options(["k"], scd, tracked)
    made = SnapshotTarget(spark, str(tmp_path / "t"), series[0][0].schema, opts, buckets=2, digests=digests)
    made.describe()
    state, seen = {}, 0
    shown = ["k", "a", "m['p']", "b"] + (["__START_AT", "__END_AT"] if scd == "2" else [])
    for n, (df, version) in enumerate(series):
        made.apply(df, version)
        want = apply_snapshots(series[: n + 1], ["k"], scd, tracked)
        assert rows(open_snapshots(spark, str(tmp_path / "t")).read().selectExpr(*shown)) == rows(want.selectExpr(*shown))
        if n in (1, 2, 5):
            feed = drained(made.feed().stream({"readChangeFeed": "true"}), tmp_path)
            for r in feed.where(f"{COMMIT} = {version}").selectExpr(*[f"{c} AS c{i}" for i, c in enumerate(shown)], CHANGE).collect():
                row, kind = tuple(r)[:-1], r[CHANGE]
                key = (row[0], row[4]) if scd == "2" else row[0]
                assert (key in state) == (kind != "insert")
                state.pop(key) if kind == "delete" else state.update({key: row})
            assert sorted(state.values(), key=str) == sorted((tuple(r) for r in made.read().selectExpr(*shown).collect()), key=str)
    with pytest.raises(ValueError, match="does not follow"):
        made.apply(series[0][0], 9)


def test_a_snapshot_with_few_changes_writes_few_rows(spark, tmp_path):
    base = spark.range(20_000).selectExpr("id AS k", "id % 7 AS v")
    made = SnapshotTarget(spark, str(tmp_path / "t"), base.schema, snapshot_options(["k"], "2"), buckets=2)
    made.describe()
    made.apply(base, 1)
    made.apply(base.selectExpr("k", "if(k % 100 = 0, -1, v) AS v"), 2)
    assert [r.rows for r in made._runs(2)] == [20_000, 200] and made._closed(2).count() == 200
    assert made.read().count() == 20_200 and made.read(1).count() == 20_000
    with pytest.raises(PySparkException, match="twice"):
        made.apply(base.union(base.limit(1)), 3)
    assert made.version() == 2
