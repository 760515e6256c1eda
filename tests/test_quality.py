import pytest
from conftest import rows
from pyspark.errors import PySparkException

from tierflow.operators.keyed import duplicate_keys, keyed_merge, latest_per_key, natural_order, reconcile_counts
from tierflow.operators.quality import (
    apply_quality,
    expect,
    expect_or_drop,
    expect_or_fail,
    quarantine,
    require_not_null,
    resolve_rules,
    rule_report,
)
from tierflow.sources.storage import current_version, publish
from tierflow.streaming.sinks import read_route, write_checked


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, 10), (2, None), (3, -5), (None, 7)], "id int, age int")


def test_null_is_a_violation(people):
    assert rows(expect_or_drop(people, {"adult": "age > 0"}), "age") == [(10,), (7,)]
    assert rows(quarantine(people, {"odd": "age < 0 OR age IS NULL"}), "id") == [(2,), (3,)]


def test_quarantine_takes_rows_meeting_all_its_rules(people):
    assert rows(quarantine(people, {"a": "age > 0", "b": "id IS NOT NULL"}), "id") == [(1,)]
    assert quarantine(people, {}).count() == 0


def test_singular_name_wins():
    rules = resolve_rules({"expect": {"a": "x"}, "expect_all": {"b": "y"}, "expect_all_or_drop": {"c": "z"}})
    assert rules.warn == {"a": "x"} and rules.drop == {"c": "z"} and not rules.fail
    assert not resolve_rules(None) and not resolve_rules("{}")


def test_counts_are_observed_while_rows_pass(people):
    kept, seen = expect(people, {"adult": "age > 0", "has_id": "id IS NOT NULL"})
    assert kept.count() == 4
    assert seen.get == {"rows": 4, "adult": 2, "has_id": 1}
    assert rows(rule_report(people, {"adult": "age > 0"})) == [("adult", 2, 2)]


def test_fail_stops_the_update_and_names_the_rule(people):
    with pytest.raises(PySparkException, match="rules violated: positive, named"):
        expect_or_fail(people.where("id IS NULL OR id = 3"), {"positive": "age > 8", "named": "id < 3"}).collect()
    with pytest.raises(PySparkException, match="id is missing"):
        require_not_null(people, ["id"]).count()


def test_fail_is_not_hidden_by_pruning_or_later_filters(spark, tmp_path):
    # The violating row lies in a row group that a pushed-down filter would skip.
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 1).selectExpr("id", "IF(id = 150000, -1, 1) AS v").write.option("parquet.block.size", 64 * 1024).parquet(path)
    checked = expect_or_fail(spark.read.parquet(path), {"positive": "v > 0"})
    with pytest.raises(PySparkException, match="positive"):
        checked.where("id < 10").select("id").count()


def test_failed_write_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1, 1), (2, 5)], "id int, v int")
    rules = resolve_rules(
        {"expect_or_fail": {"small": "v < 10"}, "expect_or_drop": {"odd": "v = 1"}, "expect_or_quarantine": {"big": "v > 2"}}
    )
    assert write_checked(good, rules, path) == {"rows": 2, "odd": 1, "small": 0}
    assert rows(read_route(spark, path, "main"), "id") == [(1,)]
    assert rows(read_route(spark, path, "quarantine"), "id") == [(2,)]
    with pytest.raises(PySparkException):
        write_checked(good.selectExpr("id", "v + 8 AS v"), rules, path)
    assert current_version(spark, path) == 1
    assert publish(good, path) == 2


def test_every_rule_sees_the_incoming_rows(people):
    rules = resolve_rules({"expect_or_fail": {"age_known": "age IS NOT NULL"}, "expect_or_drop": {"first": "id = 1"}})
    with pytest.raises(PySparkException):
        apply_quality(people, rules).main.collect()
    done = apply_quality(people.where("age IS NOT NULL"), rules)
    assert rows(done.main, "id") == [(1,)] and done.metrics.get["first"] == 2


def test_merge_updates_inserts_and_protects(spark):
    target = spark.createDataFrame([(1, "a", "ann"), (2, "b", "ann"), (None, "n", "ann")], "k int, v string, by string")
    source = spark.createDataFrame([(2, None, "bob"), (3, "c", "bob"), (None, "m", "bob")], "k int, v string, by string")
    got = rows(keyed_merge(target, source, ["k"], protected=("by",)))
    assert got == [(None, "m", "bob"), (None, "n", "ann"), (1, "a", "ann"), (2, None, "ann"), (3, "c", "bob")]
    with pytest.raises(PySparkException, match="several upserts"):
        keyed_merge(target, source.union(source).where("k = 2"), ["k"]).collect()


def test_merge_with_two_keys_and_maps(spark):
    target = spark.sql("SELECT 1 AS a, 'x' AS b, map('p', 1) AS m UNION ALL SELECT 1, 'y', map('p', 2)")
    source = spark.sql("SELECT 1 AS a, 'y' AS b, map('p', 9) AS m UNION ALL SELECT 2, 'x', map('p', 3)")
    got = rows(keyed_merge(target, source, ["a", "b"]).selectExpr("a", "b", "m['p']"))
    assert got == [(1, "x", 1), (1, "y", 9), (2, "x", 3)]


def test_natural_version_order(spark):
    df = spark.createDataFrame([("f", v) for v in ("v2", "v10", "v9", "v9.3")], "f string, version string")
    assert rows(latest_per_key(df, ["f"], [natural_order(df["version"]).desc()]), "version") == [("v10",)]


def test_duplicates_and_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2)]
    expected = spark.createDataFrame([("t", 3), ("gone", 1)], "table_name string, expected bigint")
    assert rows(reconcile_counts({"t": df}, expected)) == [("gone", 1, None, False), ("t", 3, 3, True)]
    with pytest.raises(ValueError):
        reconcile_counts({"t": df}, expected, "about")
