"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.catalogue.shared import load, query, work_dir
from tierflow.functions.decode import json_validity
from tierflow.operators.cdc import apply_changes
from tierflow.operators.keyed import duplicate_keys, reconcile_counts
from tierflow.operators.quality import (
    apply_quality,
    expect_or_drop,
    expect_or_fail,
    quarantine,
    require_not_null,
    resolve_rules,
    rule_report,
)
from tierflow.streaming.sinks import read_route, write_checked

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

EVENT_RULES = resolve_rules(
    {
        "expect_all": {"never used": "false"},
        "expect": {"valid_type": "event_type IN ('click', 'view', 'purchase')", "has_value": "value > 10"},
        "expect_or_drop": {"known_user": "user_id % 10 <> 3"},
        "expect_or_quarantine": {"strange": "user_id % 10 = 3 OR value > 100"},
    }
)


@query(
    "dq_expect_metrics",
    """
    SELECT 'valid_type' AS rule, count(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase')) AS passed,
      count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS failed FROM events
    UNION ALL SELECT 'has_value', count(*) FILTER (WHERE value > 10), count(*) FILTER (WHERE NOT value > 10) FROM events""",
)
def dq_expect_metrics(spark, sf):
    return rule_report(load(spark, sf, "events"), EVENT_RULES.warn)


@query(
    "dq_observed_metrics",
    " UNION ALL ".join(
        [f"SELECT 'rows' AS rule, count(*)::BIGINT AS n FROM events"]
        + [f"SELECT '{n}', count(*)::BIGINT FROM events WHERE ({r}) IS NOT TRUE" for n, r in EVENT_RULES.counted.items()]
    ),
)
def dq_observed_metrics(spark, sf):
    """What the pass that wrote the main rows counted on its way."""
    checked = apply_quality(load(spark, sf, "events"), EVENT_RULES, "dq_observed_metrics")
    checked.main.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(checked.metrics.get.items()), "rule string, n long")


@query("dq_drop", "SELECT * FROM lineitem WHERE l_quantity > 5 AND l_discount < 0.08 AND l_returnflag IN ('A', 'R')")
def dq_drop(spark, sf):
    rules = {"quantity": "l_quantity > 5", "discount": "l_discount < 0.08", "flag": "l_returnflag IN ('A', 'R')"}
    return expect_or_drop(load(spark, sf, "lineitem"), rules)


@query("dq_quarantine", "SELECT * FROM lineitem WHERE l_quantity < 3 OR l_tax > 0.07")
def dq_quarantine(spark, sf):
    return quarantine(load(spark, sf, "lineitem"), {"odd": "l_quantity < 3 OR l_tax > 0.07"})


@query("dq_fail_passes", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000")
def dq_fail_passes(spark, sf):
    checked = expect_or_fail(load(spark, sf, "orders"), {"has_key": "o_orderkey IS NOT NULL", "price": "o_totalprice >= 0"})
    return checked.where("o_totalprice > 1000").select("o_orderkey", "o_totalprice")


@query("required_fields", "SELECT c_custkey, c_mktsegment FROM customer")
def required_fields(spark, sf):
    return require_not_null(load(spark, sf, "customer"), ["c_custkey", "c_name"]).select("c_custkey", "c_mktsegment")


@query(
    "dq_composed",
    """
    SELECT 'main' AS route, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events WHERE user_id % 10 <> 3
    UNION ALL SELECT 'quarantine', count(*), CAST(sum(event_id) AS BIGINT) FROM events WHERE user_id % 10 = 3 OR value > 100""",
)
def dq_composed(spark, sf):
    path = work_dir(spark, "dq-composed")
    write_checked(load(spark, sf, "events"), EVENT_RULES, path)
    sides = [
        read_route(spark, path, r).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids")).select(F.lit(r).alias("route"), "n", "ids")
        for r in ("main", "quarantine")
    ]
    return sides[0].unionByName(sides[1])


# props of some events are broken or missing.
PAYLOAD = "CASE WHEN event_id % 13 = 0 THEN left(props, length(props) - 1) WHEN event_id % 29 = 0 THEN NULL ELSE props END"


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    texts = load(spark, sf, "events").select("event_id", "user_id", F.expr(PAYLOAD).alias("payload"))
    return texts.withColumn("valid", json_validity(F.col("payload"))).select("event_id", "user_id", "valid.*")


@query(
    "dq_json_validity",
    f"""
    SELECT event_id, NOT coalesce(json_valid(p), false) AS is_error, p IS NULL AS missing
    FROM (SELECT event_id, {PAYLOAD} AS p FROM events)""",
)
def dq_json_validity(spark, sf):
    return _validated(spark, sf).select(
        "event_id", "is_error", F.coalesce(F.col("error_details") == "JSON string is null", F.lit(False)).alias("missing")
    )


JSON_RULES = resolve_rules(
    {
        "expect_or_drop": {"valid_json": "is_error = false"},
        "expect_or_quarantine": {"quarantine_rule": "is_error = true and error_details IS NOT NULL"},
    }
)


@query(
    "dq_json_quarantine",
    f"""
    SELECT event_id, CASE WHEN coalesce(json_valid(p), false) THEN 'main' ELSE 'quarantine' END AS route
    FROM (SELECT event_id, {PAYLOAD} AS p FROM events)""",
)
def dq_json_quarantine(spark, sf):
    checked = apply_quality(_validated(spark, sf), JSON_RULES, "dq_json_quarantine")
    good = checked.main.select("event_id", F.lit("main").alias("route"))
    return good.unionByName(checked.quarantine.select("event_id", F.lit("quarantine").alias("route")))


@query(
    "dq_code_range",
    f"""
    SELECT event_id FROM (SELECT event_id, user_id % 10 AS code, {PAYLOAD} AS p FROM events)
    WHERE NOT coalesce(json_valid(p), false) OR code NOT IN (6, 8)""",
)
def dq_code_range(spark, sf):
    rows = _validated(spark, sf).withColumn("headerMessageCode", F.col("user_id") % 10)
    rule = "(is_error = true and error_details IS NOT NULL) or headerMessageCode not in (6,8)"
    return quarantine(rows, {"quarantine_rule": rule}).select("event_id")


@query("dq_nested_rule", "SELECT event_id, user_id FROM events WHERE event_id % 17 = 0")
def dq_nested_rule(spark, sf):
    rows = load(spark, sf, "events").selectExpr(
        "event_id",
        "user_id",
        "named_struct('device_id', CASE WHEN event_id % 17 <> 0 THEN user_id END, 'reading', value) AS parsed_records",
    )
    return quarantine(rows, {"no_device": "parsed_records.device_id IS NULL"}).select("event_id", "user_id")


@query(
    "dq_then_cdc",
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE user_id % 10 <> 3
    ) WHERE rn = 1""",
)
def dq_then_cdc(spark, sf):
    checked = apply_quality(load(spark, sf, "events"), EVENT_RULES, "dq_then_cdc")
    return apply_changes(checked.main, ["user_id"], "ts")


@query(
    "row_count_reconcile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({n} AS BIGINT) AS expected, (SELECT count(*) FROM {t}) AS actual, (SELECT count(*) FROM {t}) >= {n} AS ok"
        for n, t in enumerate(TABLES, start=1)
    ),
)
def row_count_reconcile(spark, sf):
    expected = spark.createDataFrame([(t, n) for n, t in enumerate(TABLES, start=1)], "table_name string, expected bigint")
    return reconcile_counts({t: load(spark, sf, t) for t in TABLES}, expected, "minimum")


@query(
    "row_count_reconcile_exact",
    """
    SELECT 'nation' AS table_name, CAST(25 AS BIGINT) AS expected, (SELECT count(*) FROM nation) AS actual, (SELECT count(*) = 25 FROM nation) AS ok
    UNION ALL SELECT 'events', 12345, (SELECT count(*) FROM events), (SELECT count(*) = 12345 FROM events)""",
)
def row_count_reconcile_exact(spark, sf):
    expected = spark.createDataFrame([("nation", 25), ("events", 12345)], "table_name string, expected bigint")
    return reconcile_counts({t: load(spark, sf, t) for t in ("nation", "events")}, expected)


@query("duplicate_keys", "SELECT text_hash, count(*) AS count FROM (SELECT md5(text) AS text_hash FROM documents) GROUP BY text_hash HAVING count(*) > 1")
def duplicate_texts(spark, sf):
    return duplicate_keys(load(spark, sf, "documents").select(F.md5("text").alias("text_hash")), ["text_hash"])
