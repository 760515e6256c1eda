"""Names in SQL texts, the order of targets, and gold runs of both kinds."""

import datetime
import decimal
import re

import pytest
from conftest import rows

from __spark_entry__ import queries
from tierflow.plans import gold as gold_frames
from tierflow.plans.medallion import Hooks, MedallionRun
from tierflow.plans.relations import ordered, relations, renamed
from tierflow.plans.specs import BronzeSpec, GoldSpec
from tierflow.plans.views import ViewRegistry, build_targets, plain_name, view_chain


def names(spark, sql):
    return [".".join(r.parts) for r in relations(spark, sql)]


def test_relations_come_from_the_plan(spark):
    sql = """WITH c AS (SELECT * FROM live.a WHERE note = 'FROM t'), d AS (SELECT * FROM c)
      SELECT x.v, u.b, (SELECT max(z) FROM `m n`.q) FROM d JOIN db.t AS x ON x.k IN (SELECT k FROM u)
      WHERE EXISTS (SELECT 1 FROM STREAM(st) s) -- JOIN nothing"""
    assert names(spark, sql) == ["live.a", "m n.q", "db.t", "u", "st"]
    assert names(spark, "SELECT 1") == [] and names(spark, "SELECT * FROM c, (WITH c AS (SELECT 1 FROM z) SELECT * FROM c)") == ["c", "z"]


def test_renaming_touches_tables_only(spark):
    sql = "SELECT '🙂 FROM t' AS t, t.t FROM t JOIN `t` AS o ON o.t = t.t JOIN STREAM (live.t) z"
    mine = {"t": "v1", "live.t": "v2"}
    assert renamed(spark, sql, lambda parts: mine.get(".".join(parts))) == "SELECT '🙂 FROM t' AS t, t.t FROM v1 AS `t` JOIN v1 AS o ON o.t = t.t JOIN STREAM (v2) z"


def test_order_and_cycles():
    assert ordered(["a", "b", "c", "d"], {"a": ["c"], "c": ["d"], "b": []}) == ["d", "c", "a", "b"]
    with pytest.raises(ValueError, match="wait for each other: b -> c -> b"):
        ordered(["a", "b", "c"], {"a": ["b"], "b": ["c"], "c": ["b"]})


def test_a_column_named_like_a_view(spark):
    registry = ViewRegistry(spark)
    registry.register("base", spark.range(4).selectExpr("id", "id * 2 AS totals"))
    targets = [
        {"target": "first", "views": [{"name": "one_vw", "sql": "SELECT id, totals, 'totals' AS label FROM live.base"}]},
        {"target": "totals", "views": [{"name": "totals_vw", "sql": "SELECT sum(one_vw.totals) AS n FROM live.one_vw"}]},
    ]
    out = build_targets(registry, targets)
    assert rows(out["totals"]) == [(12,)] and out["first"].columns == ["id", "totals", "label"]
    assert not [t for t in spark.catalog.listTables() if t.name in ("base", "one_vw", "totals", "totals_vw", "first")]


def test_runs_do_not_see_each_other(spark):
    one, two = ViewRegistry(spark), ViewRegistry(spark)
    one.register("x", spark.range(1))
    two.register("X", spark.range(2))
    assert view_chain(one, [("v", "SELECT * FROM live.x")]).count() == 1 and view_chain(two, [("v", "SELECT * FROM x")]).count() == 2
    assert plain_name("LIVE.`b c`") == "b c" and plain_name("`a.b as stream`") == "a.b as stream" and plain_name("Lake.fine.T") == "lake.fine.t"


def gold(name, sources, sql, streaming="false", **more):
    return GoldSpec(
        name, "g", targetDetails={"database": "mart", "table": name}, isStreaming=streaming, env="dev",
        sources=[{"reference_name": f"{name}_{i}_src", "source_table": t, "filter_condition": "", "is_streaming": s, "pii_fields": {}} for i, (t, s) in enumerate(sources)],
        views=[{"reference_name": f"{name}_vw", "sql_condition": sql}], **more,
    )


def test_targets_of_both_kinds_in_one_order(spark, tmp_path):
    """batch -> stream over it -> batch over that, and a batch target that reads a sibling by its name."""
    source = str(tmp_path / "in")
    bronze = BronzeSpec("1", "g", targetDetails={"database": "raw", "table": "n"}, sourceFormat="parquet", sourceDetails={"path": source}, readerConfigOptions={}, schema=spark.range(1).schema.json())
    specs = [
        gold("last", [("mart.followed", "false")], "SELECT count(*) AS n, sum(mart) AS s FROM (SELECT id AS mart FROM live.last_0_src)"),
        gold("followed", [("mart.evens", "true")], "SELECT id FROM live.followed_0_src", "true"),
        gold("beside", [], "SELECT max(n) AS top FROM mart.last JOIN mart.evens ON true"),
        gold("evens", [("raw.n", "false")], "SELECT id FROM live.evens_0_src WHERE id % 2 = 0"),
    ]
    seen = []
    for low, high in ((0, 6), (6, 9)):
        spark.range(low, high).write.mode("append").parquet(source)
        run = MedallionRun(spark, str(tmp_path / "lake"))
        assert run.run("bronze_gold", {"bronze": [bronze], "gold": specs})[1:] == ["mart.evens", "mart.followed", "mart.last", "mart.beside"]
        seen.append([rows(run.read(s)) for s in specs])
    assert seen[0] == [[(3, 6)], [(0,), (2,), (4,)], [(3,)], [(0,), (2,), (4,)]]
    assert seen[1] == [[(5, 20)], [(0,), (2,), (4,), (6,), (8,)], [(5,)], [(0,), (2,), (4,), (6,), (8,)]]


def test_waiting_targets_are_told(spark, tmp_path):
    specs = [gold("a", [], "SELECT * FROM mart.b"), gold("b", [("mart.a", "false")], "SELECT * FROM live.b_0_src")]
    with pytest.raises(ValueError, match="mart.a -> mart.b -> mart.a"):
        MedallionRun(spark, str(tmp_path)).run("gold", {"gold": specs})


def test_reconciliation_makes_no_groups_of_the_other_targets(spark):
    plan = queries()["meeting_reconciliation"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    # No table of groups told apart by target is read: the bets are, once for each target's places.
    assert "which" not in plan and "meeting_location" in plan


def test_targets_read_their_siblings_as_written_and_group_by_all_keys(spark, tmp_path):
    """A semi join on a few places must not deal the rows out by place; siblings are not made again."""
    seen = {}

    def look(df, spec):
        seen[spec.table] = (df.inputFiles(), df._jdf.queryExecution().executedPlan().toString())
        return df

    spark.range(50).selectExpr("id % 2 AS place", "id % 5 AS day", "id AS ticket").createOrReplaceTempView("bets_of_test")
    specs = [
        gold("told", [], "SELECT place, day, count(DISTINCT ticket) AS n FROM bets_of_test WHERE place IN (SELECT place FROM mart.places) GROUP BY place, day"),
        gold("places", [], "SELECT DISTINCT place FROM bets_of_test WHERE place = 1"),
    ]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.requireAllClusterKeysForDistribution")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = MedallionRun(spark, str(tmp_path), hooks=Hooks(transforms={"gold": look}))
        run.run("gold", {"gold": specs})
        assert spark.conf.get("spark.sql.requireAllClusterKeysForDistribution") == before["spark.sql.requireAllClusterKeysForDistribution"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before["spark.sql.autoBroadcastJoinThreshold"])
        spark.catalog.dropTempView("bets_of_test")
    assert rows(run.read(specs[0])) == [(1, day, 5) for day in range(5)]
    files, plan = seen["mart.told"]
    assert files and all("/mart/places/" in f for f in files)
    assert re.search(r"hashpartitioning\(place#\d+L?, day#\d+L?, ticket#\d+L?,", plan)


def test_places_of_the_reconciliation_are_of_known_size(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        plan = queries()["meeting_reconciliation"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"hashpartitioning\(meeting_location#\d+, \d+\)", plan) and "BroadcastHashJoin" in plan


def test_groups_of_bets_without_an_id_are_not_gathered(spark):
    """They count for nothing and only bring their groups; gathered, a meeting's dimensions were compared pair by pair."""
    columns = "meeting_location string, meeting_date timestamp, race_no int, last_race_no int, seg_team_cge_transformed string, channel string, bet_type string, fo_flag boolean, customer_id bigint, ticketid bigint, ttl_cost decimal(22,2), sell_time timestamp"
    day = datetime.datetime(2024, 1, 1)
    many = [("ST", day, i, i % 3, None, f"c{i % 50}", "WIN", False, None, None, decimal.Decimal(1), day) for i in range(300)]
    few = [("ST", day, race, None, None, "c0", kind, True, who, ticket, None, None) for race, kind, who, ticket in ((1, "WIN", 7, 1), (2, "WIN", 7, 1), (2, None, 7, 2), (1, "WIN", 8, 2))]
    groups = gold_frames.meeting_groups(spark.createDataFrame(many + few, columns))
    assert "array_distinct(concat" not in groups._jdf.queryExecution().optimizedPlan().toString()
    found = {}
    for r in groups.collect():
        found.setdefault(r["which"], []).append((r["n"], r["cost"], r["latest"]))
    assert {k: (len(v), sum(n for n, _, _ in v)) for k, v in found.items()} == {
        "by_meeting_segment": (1, 2), "by_meeting_channel": (50, 2), "by_meeting_bet_type": (2, 2), "by_race_segment": (300, 3),
        "by_race_channel": (302, 3), "by_race_bet_type": (303, 4), "meeting_totals": (303, 4), "reconciliation": (4, 2),
    }
    assert all(cost is None and latest is None for which, v in found.items() if which.startswith("by_") for _, cost, latest in v)
    assert sum(cost or 0 for _, cost, _ in found["meeting_totals"]) == 300 == sum(cost or 0 for _, cost, _ in found["reconciliation"])
    assert {latest for _, _, latest in found["reconciliation"]} == {day, None}
