"""Change capture and snapshot queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.catalogue.shared import load, query, work_dir
from tierflow.operators.cdc import ChangeOptions, apply_changes, rejected_changes
from tierflow.operators.keyed import keyed_merge, latest_per_key
from tierflow.operators.snapshots import (
    apply_snapshots,
    empty_history,
    snapshot_changes,
    snapshot_options,
    snapshot_step_type2,
)
from tierflow.plans.medallion import MedallionRun
from tierflow.plans.specs import BronzeSpec, SilverSpec
from tierflow.streaming.changes import apply_changes_stream
from tierflow.streaming.sinks import append_stream

IS_DELETE = "event_type = 'error'"
# Every third event brings no value, every seventh no props.
SPARSE = {
    "value": "CASE WHEN event_id % 3 <> 0 THEN value END",
    "props": "CASE WHEN event_id % 7 <> 0 THEN props END",
}
SPARSE_SQL = "SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 3 <> 0 THEN value END AS value, CASE WHEN event_id % 7 <> 0 THEN props END AS props FROM events"

LATEST_SQL = """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE rn = 1"""


def _sparse(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").withColumns({c: F.expr(e) for c, e in SPARSE.items()})


@query("cdc_scd1", LATEST_SQL)
def cdc_scd1(spark, sf):
    return apply_changes(load(spark, sf, "events"), ["user_id"], "struct(ts, event_id)")


@query("cdc_scd1_delete", LATEST_SQL + " AND event_type <> 'error'")
def cdc_scd1_delete(spark, sf):
    return apply_changes(load(spark, sf, "events"), ["user_id"], "struct(ts, event_id)", apply_as_deletes=IS_DELETE)


@query(
    "cdc_scd1_truncate",
    """
    WITH cut AS (SELECT max(ts) AS at FROM events WHERE event_id % 4999 = 997)
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
      FROM events e, cut WHERE event_id % 4999 <> 997 AND (cut.at IS NULL OR ts >= cut.at)
    ) WHERE rn = 1""",
)
def cdc_scd1_truncate(spark, sf):
    return apply_changes(
        load(spark, sf, "events"), ["user_id"], "ts", apply_as_truncates="event_id % 4999 = 997"
    )


@query(
    "cdc_composite_key",
    """
    SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate, arg_max(l_quantity, (l_shipdate, l_partkey, l_suppkey, l_quantity)) AS l_quantity,
      arg_max(l_partkey, (l_shipdate, l_partkey, l_suppkey, l_quantity)) AS l_partkey, arg_max(l_suppkey, (l_shipdate, l_partkey, l_suppkey, l_quantity)) AS l_suppkey
    FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def cdc_composite_key(spark, sf):
    return apply_changes(
        load(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        "struct(l_shipdate, l_partkey, l_suppkey, l_quantity)",
        column_list=["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"],
    )


_LIFE_SQL = f"""
    WITH e AS ({SPARSE_SQL}),
    last_delete AS (SELECT user_id, max(event_id) AS gone FROM e WHERE event_type = 'error' GROUP BY user_id),
    life AS (SELECT e.* FROM e LEFT JOIN last_delete d USING (user_id) WHERE e.event_type <> 'error' AND (gone IS NULL OR event_id > gone))"""


@query(
    "cdc_ignore_null_updates",
    _LIFE_SQL
    + """
    SELECT user_id, max(event_id) AS event_id, arg_max(ts, event_id) AS ts, arg_max(event_type, event_id) AS event_type,
      arg_max(value, event_id) FILTER (WHERE value IS NOT NULL) AS value,
      arg_max(props, event_id) FILTER (WHERE props IS NOT NULL) AS props
    FROM life GROUP BY user_id""",
)
def cdc_ignore_null_updates(spark, sf):
    return apply_changes(
        _sparse(spark, sf), ["user_id"], "event_id", apply_as_deletes=IS_DELETE, ignore_null_updates=True
    )


@query(
    "cdc_ignore_null_column_list",
    _LIFE_SQL
    + """
    SELECT a.user_id, a.event_id, a.ts, a.event_type, b.value, a.props FROM life a
    JOIN (SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) FILTER (WHERE value IS NOT NULL) AS value
          FROM life GROUP BY user_id) b ON a.user_id = b.user_id AND a.event_id = b.event_id""",
)
def cdc_ignore_null_column_list(spark, sf):
    return apply_changes(
        _sparse(spark, sf), ["user_id"], "event_id", apply_as_deletes=IS_DELETE, ignore_null_updates_column_list=["value"]
    )


@query(
    "cdc_ignore_null_except_list",
    _LIFE_SQL
    + """
    SELECT a.user_id, a.event_id, a.ts, a.event_type, a.value, b.props FROM life a
    JOIN (SELECT user_id, max(event_id) AS event_id, arg_max(props, event_id) FILTER (WHERE props IS NOT NULL) AS props
          FROM life GROUP BY user_id) b ON a.user_id = b.user_id AND a.event_id = b.event_id""",
)
def cdc_ignore_null_except_list(spark, sf):
    return apply_changes(
        _sparse(spark, sf), ["user_id"], "event_id", apply_as_deletes=IS_DELETE,
        ignore_null_updates_except_column_list=["value"],
    )


@query("cdc_column_list", f"SELECT user_id, event_type, value FROM ({LATEST_SQL})")
def cdc_column_list(spark, sf):
    return apply_changes(
        load(spark, sf, "events"), ["user_id"], "struct(ts, event_id)", column_list=["event_type", "value"]
    )


@query("cdc_except_columns", f"SELECT user_id, event_type, value FROM ({LATEST_SQL})")
def cdc_except_columns(spark, sf):
    return apply_changes(
        load(spark, sf, "events"), ["user_id"], "struct(ts, event_id)", except_column_list=["ts", "event_id", "props"]
    )


@query("cdc_where", LATEST_SQL.replace("FROM events", "FROM events WHERE value > 20 AND event_type <> 'view'"))
def cdc_where(spark, sf):
    return apply_changes(
        load(spark, sf, "events"), ["user_id"], "struct(ts, event_id)", where="value > 20 AND event_type <> 'view'"
    )


@query(
    "cdc_scd2",
    """
    SELECT event_id, ts, user_id, event_type, value, props, ts AS "__START_AT", nxt AS "__END_AT" FROM (
      SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events
    ) WHERE event_type <> 'error'""",
)
def cdc_scd2(spark, sf):
    return apply_changes(load(spark, sf, "events"), ["user_id"], "ts", 2, apply_as_deletes=IS_DELETE)


_HOT = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"


@query(
    "cdc_scd2_hot_key",
    f"""
    SELECT event_id, ts, user_id, event_type, value, props, ts AS "__START_AT", nxt AS "__END_AT" FROM (
      SELECT * REPLACE ({_HOT} AS user_id), lead(ts) OVER (PARTITION BY {_HOT} ORDER BY ts) AS nxt FROM events
    ) WHERE event_type <> 'error'""",
)
def cdc_scd2_hot_key(spark, sf):
    """A key owns a third of all rows: it is cut into runs, and what crosses their edges comes from a summary of the runs."""
    events = load(spark, sf, "events").withColumn("user_id", F.expr(f"CAST({_HOT} AS BIGINT)"))
    return apply_changes(events, ["user_id"], "ts", 2, apply_as_deletes=IS_DELETE, hot_key_rows=max(1, events.count() // 8))


def _history_sql(tracked: str, stored: str) -> str:
    """Versions by lag / lead over ``feed(user_id, seq, del, tracked and stored columns)``."""
    return f"""
    , marked AS (
      SELECT *, CASE WHEN del THEN CASE WHEN lag(del) OVER w = false THEN 'close' END
                     WHEN lag(del) OVER w = false AND lag({tracked}) OVER w IS NOT DISTINCT FROM {tracked} THEN NULL
                     ELSE 'open' END AS edge
      FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
    numbered AS (
      SELECT *, count(edge) OVER (PARTITION BY user_id ORDER BY seq) AS nr FROM marked),
    grouped AS (
      SELECT user_id, nr, min(seq) FILTER (WHERE edge IS NOT NULL) AS "__START_AT", any_value(edge) AS edge, {stored}
      FROM numbered WHERE nr > 0 AND (edge IS NOT NULL OR NOT del) GROUP BY user_id, nr),
    ended AS (SELECT *, lead("__START_AT") OVER (PARTITION BY user_id ORDER BY nr) AS "__END_AT" FROM grouped)
    SELECT * EXCLUDE (nr, edge) FROM ended WHERE edge = 'open'"""


@query(
    "cdc_scd2_track_history",
    "WITH feed AS (SELECT user_id, ts AS seq, event_type = 'error' AS del, event_type, value, event_id FROM events)"
    + _history_sql(
        "event_type",
        "arg_max(event_type, seq) AS event_type, arg_max(value, seq) AS value, arg_max(event_id, seq) AS event_id",
    ),
)
def cdc_scd2_track_history(spark, sf):
    return apply_changes(
        load(spark, sf, "events"), ["user_id"], "ts", 2, apply_as_deletes=IS_DELETE,
        column_list=["event_type", "value", "event_id"], track_history_column_list=["event_type"],
    )


@query(
    "cdc_scd2_track_except",
    "WITH feed AS (SELECT user_id, ts AS seq, false AS del, event_type, event_id FROM events)"
    + _history_sql("event_type", "arg_max(event_type, seq) AS event_type, arg_max(event_id, seq) AS event_id"),
)
def cdc_scd2_track_except(spark, sf):
    return apply_changes(
        load(spark, sf, "events"), ["user_id"], "ts", 2,
        except_column_list=["ts", "value", "props"], track_history_except_column_list=["event_id"],
    )


@query(
    "cdc_scd2_ignore_nulls",
    f"""
    WITH e AS ({SPARSE_SQL}),
    lives AS (SELECT *, count(CASE WHEN event_type = 'error' THEN 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS life FROM e),
    filled AS (SELECT user_id, event_id, event_type,
        last_value(CASE WHEN event_type <> 'error' THEN floor(value / 100) END IGNORE NULLS) OVER (PARTITION BY user_id, life ORDER BY event_id) AS band
      FROM lives),
    feed AS (SELECT user_id, event_id AS seq, event_type = 'error' AS del, band FROM filled)"""
    + _history_sql("band", "arg_max(band, seq) FILTER (WHERE NOT del) AS band").replace(
        "SELECT * EXCLUDE (nr, edge)", 'SELECT user_id, CAST(band AS BIGINT) AS band, "__START_AT", "__END_AT"'
    ),
    nullable=("__END_AT", "band"),
)
def cdc_scd2_ignore_nulls(spark, sf):
    feed = _sparse(spark, sf).withColumn("band", F.floor(F.col("value") / 100))
    return apply_changes(
        feed, ["user_id"], "event_id", 2, apply_as_deletes=IS_DELETE, column_list=["band"],
        ignore_null_updates=True,
    )


# --- streams ------------------------------------------------------------------------------------


def _late_batches(spark: SparkSession, sf: str, name: str) -> tuple[DataFrame, str]:
    """The events as a stream of files that are not in time order, every file replayed once.

    The files are cut by a hash of the event, so each micro-batch holds early and late events.
    """
    folder = work_dir(spark, name)
    events = load(spark, sf, "events")
    cut = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    cut.write.partitionBy("part").parquet(f"{folder}/in")
    cut.write.partitionBy("part").mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(f"{folder}/in/part=*"), folder


def _run_changes(spark, sf, name: str, opts: ChangeOptions, publish_every: int) -> DataFrame:
    feed, folder = _late_batches(spark, sf, name)
    running, target = apply_changes_stream(
        feed, f"{folder}/out", f"{folder}/checkpoint", opts, buckets=8, publish_every=publish_every
    )
    running.awaitTermination()
    target.publish()
    return target.read()


@query("stream_cdc", LATEST_SQL + " AND event_type <> 'error'")
def stream_cdc(spark, sf):
    opts = ChangeOptions(("user_id",), "struct(ts, event_id)", apply_as_deletes=IS_DELETE)
    return _run_changes(spark, sf, "stream-cdc", opts, publish_every=2)


@query(
    "stream_cdc_scd2",
    """
    SELECT event_id, ts, user_id, event_type, value, props, ts AS "__START_AT", nxt AS "__END_AT" FROM (
      SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events
    ) WHERE event_type <> 'error'""",
)
def stream_cdc_scd2(spark, sf):
    opts = ChangeOptions(("user_id",), "ts", "2", apply_as_deletes=IS_DELETE)
    return _run_changes(spark, sf, "stream-cdc2", opts, publish_every=1_000)


# --- change feeds ---------------------------------------------------------------------------------

# Two deliveries of the events; the state after each is the latest event of a user, unless that is a deletion.
_FEED_SQL = """
    WITH a AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_id % 3 <> 0) WHERE rn = 1 AND event_type <> 'error'),
      b AS (SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'),
      feed AS (
        SELECT a.*, 'insert' AS _change_type, 0::BIGINT AS _commit_version FROM a
        UNION ALL SELECT b.*, CASE WHEN a.user_id IS NULL THEN 'insert' ELSE 'update' END, 1 FROM b LEFT JOIN a ON b.user_id = a.user_id WHERE a.event_id IS DISTINCT FROM b.event_id
        UNION ALL SELECT a.*, 'delete', 1 FROM a ANTI JOIN b ON a.user_id = b.user_id)
    """
_DELIVERIES = ("event_id % 3 <> 0", "event_id % 3 = 0")


@query("change_feed", _FEED_SQL + "SELECT * FROM feed")
def change_feed(spark, sf):
    """The row-level changes of a change target, read by one stream that is started again after the second publication."""
    folder, events = work_dir(spark, "feed"), load(spark, sf, "events")
    opts = ChangeOptions(("user_id",), "struct(ts, event_id)", apply_as_deletes=IS_DELETE)
    for part in _DELIVERIES:
        events.where(part).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        running, target = apply_changes_stream(source, f"{folder}/bronze", f"{folder}/checkpoint", opts, buckets=8)
        running.awaitTermination()
        changes = target.feed().stream({"readChangeFeed": "true"})
        append_stream(changes, f"{folder}/changes", f"{folder}/checkpoint-changes").awaitTermination()
    return spark.read.schema(changes.schema).parquet(f"{folder}/changes")


@query(
    "silver_over_bronze_changes",
    _FEED_SQL + "SELECT event_id, user_id, upper(event_type) AS kind, value FROM feed WHERE _change_type <> 'delete'",
)
def silver_over_bronze_changes(spark, sf):
    """Two runs of bronze change capture with a streaming silver flow over it."""
    folder, events = work_dir(spark, "silver-feed"), load(spark, sf, "events")
    options = {"keys": ["user_id"], "sequence_by": "struct(ts, event_id)", "scd_type": "1", "apply_as_deletes": IS_DELETE}
    bronze = BronzeSpec(
        "1", "g", targetDetails={"database": "raw", "table": "users"}, sourceFormat="parquet", sourceDetails={"path": f"{folder}/in"},
        readerConfigOptions={}, schema=events.schema.json(), cdcApplyChanges=json.dumps(options),
    )
    silver = SilverSpec(
        "1", "g", targetDetails={"database": "fine", "table": "users"}, sourceDetails={"database": "raw", "table": "users"},
        selectExp=["event_id", "user_id", "upper(event_type) AS kind", "value"],
    )
    for part in _DELIVERIES:
        events.where(part).write.mode("append").parquet(f"{folder}/in")
        run = MedallionRun(spark, f"{folder}/lake", buckets=8)
        run.run("bronze_silver", {"bronze": [bronze], "silver": [silver]})
    return run.read(silver)


@query(
    "stream_cdc_final",
    """
    SELECT event_id, ts, user_id, event_type, value, props, event_id AS "__START_AT", nxt AS "__END_AT" FROM (
      SELECT *, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt FROM events
    ) WHERE event_type <> 'error'""",
    nullable=("__END_AT",),
)
def stream_cdc_final(spark, sf):
    """Type 2 with a finality mark: changes come in ranges of their sequence, so none is behind it and the log stays short."""
    folder, events = work_dir(spark, "stream-final"), load(spark, sf, "events")
    parts = 5
    last = events.agg(F.max("event_id")).first()[0]
    opts = ChangeOptions(("user_id",), "event_id", "2", apply_as_deletes=IS_DELETE)
    for part in range(parts):
        events.where(F.expr(f"event_id * {parts} div {last + 1}") == part).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        running, target = apply_changes_stream(source, f"{folder}/out", f"{folder}/checkpoint", opts, buckets=8, final_after="10")
        running.awaitTermination()
    return target.read()


# --- changes without a sequence ------------------------------------------------------------------

_UNORDERED = "nullif(event_id % 7, 0)"
_REJECTED_SQL = "SELECT event_id, user_id, event_type FROM events WHERE event_id % 7 = 0"


@query("cdc_rejected_rows", _REJECTED_SQL)
def cdc_rejected_rows(spark, sf):
    """What a batch target cannot order lies beside it."""
    return rejected_changes(load(spark, sf, "events"), ChangeOptions(("user_id",), _UNORDERED)).select("event_id", "user_id", "event_type")


@query("stream_cdc_rejected_rows", _REJECTED_SQL)
def stream_cdc_rejected_rows(spark, sf):
    folder = work_dir(spark, "stream-rejects")
    events = load(spark, sf, "events")
    events.repartition(4).write.parquet(f"{folder}/in")
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    running, target = apply_changes_stream(feed, f"{folder}/out", f"{folder}/checkpoint", ChangeOptions(("user_id",), _UNORDERED), buckets=4, publish_every=4)
    running.awaitTermination()
    return target.rejects().select("event_id", "user_id", "event_type")


# --- snapshots ----------------------------------------------------------------------------------

# Three snapshots of the orders: each misses one priority, later ones edit some statuses and prices.
SNAPSHOT_RULES = {
    1: ("o_orderpriority <> '5-LOW'", "o_orderstatus", "o_totalprice"),
    2: (
        "o_orderpriority <> '1-URGENT'",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END",
        "o_totalprice",
    ),
    4: (
        "o_orderpriority <> '3-MEDIUM'",
        "CASE WHEN o_orderkey % 6 = 0 THEN 'Y' WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END",
        "o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END",
    ),
}


def _snapshots(spark: SparkSession, sf: str) -> list[tuple[DataFrame, int]]:
    orders = load(spark, sf, "orders")
    return [
        (
            orders.where(keep).selectExpr("o_orderkey", "o_custkey", f"{status} AS o_orderstatus", f"{price} AS o_totalprice"),
            version,
        )
        for version, (keep, status, price) in SNAPSHOT_RULES.items()
    ]


def _snapshot_sql(version: int) -> str:
    keep, status, price = SNAPSHOT_RULES[version]
    return f"SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, {price} AS o_totalprice, {version} AS v FROM orders WHERE {keep}"


_SERIES_SQL = "WITH s AS (" + " UNION ALL ".join(_snapshot_sql(v) for v in SNAPSHOT_RULES) + ")"


_LAST_SNAPSHOT = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (" + _snapshot_sql(4) + ")"


@query("snapshot_scd1", _LAST_SNAPSHOT)
def snapshot_scd1(spark, sf):
    return apply_snapshots(_snapshots(spark, sf), ["o_orderkey"], 1)


@query(
    "snapshot_changes",
    f"""
    WITH a AS ({_snapshot_sql(1)}), b AS ({_snapshot_sql(2)})
    SELECT CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change,
      coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
      CASE WHEN b.o_orderkey IS NULL THEN a.o_custkey ELSE b.o_custkey END AS o_custkey,
      CASE WHEN b.o_orderkey IS NULL THEN a.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
      CASE WHEN b.o_orderkey IS NULL THEN a.o_totalprice ELSE b.o_totalprice END AS o_totalprice
    FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
    WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey <> b.o_custkey
      OR a.o_orderstatus <> b.o_orderstatus OR a.o_totalprice <> b.o_totalprice""",
)
def snapshot_diff(spark, sf):
    (first, _), (second, _), _ = _snapshots(spark, sf)
    return snapshot_changes(first, second, ["o_orderkey"])


def _end_sql(tracked: list[str]) -> str:
    """History by comparing each snapshot with the one before and the one after it."""
    same = lambda a, b: " AND ".join([f"{a}.o_orderkey = {b}.o_orderkey"] + [f"{a}.{c} = {b}.{c}" for c in tracked])
    return (
        _SERIES_SQL
        + f""",
    n AS (SELECT *, CASE v WHEN 1 THEN 2 WHEN 2 THEN 4 END AS nv FROM s),
    starts AS (SELECT c.* FROM n c WHERE NOT EXISTS (SELECT 1 FROM n p WHERE p.nv = c.v AND {same('p', 'c')})),
    ends AS (SELECT c.* FROM n c WHERE NOT EXISTS (SELECT 1 FROM n f WHERE c.nv = f.v AND {same('c', 'f')})),
    runs AS (SELECT a.o_orderkey, a.v AS sv, min(e.v) AS ev FROM starts a JOIN ends e ON a.o_orderkey = e.o_orderkey AND e.v >= a.v GROUP BY ALL)
    SELECT r.o_orderkey, n.o_custkey, n.o_orderstatus, n.o_totalprice, CAST(r.sv AS BIGINT) AS "__START_AT", CAST(n.nv AS BIGINT) AS "__END_AT"
    FROM runs r JOIN n ON n.o_orderkey = r.o_orderkey AND n.v = r.ev"""
    )


_ALL = ["o_custkey", "o_orderstatus", "o_totalprice"]


@query("snapshot_scd2", _end_sql(_ALL), nullable=("__END_AT",))
def snapshot_scd2(spark, sf):
    return apply_snapshots(_snapshots(spark, sf), ["o_orderkey"], 2)


@query("snapshot_scd2_track_history", _end_sql(["o_orderstatus"]), nullable=("__END_AT",))
def snapshot_scd2_track_history(spark, sf):
    return apply_snapshots(
        _snapshots(spark, sf), ["o_orderkey"], 2, track_history_column_list=["o_orderstatus"]
    )


@query("snapshot_scd2_stepwise", _end_sql(["o_orderstatus"]), nullable=("__END_AT",))
def snapshot_scd2_stepwise(spark, sf):
    series = _snapshots(spark, sf)
    opts = snapshot_options(["o_orderkey"], 2, ["o_orderstatus"])
    state = empty_history(series[0][0])
    for snapshot, version in series:
        state = snapshot_step_type2(state, snapshot, version, opts)
    return state


# --- keyed tables -------------------------------------------------------------------------------


@query(
    "keyed_merge",
    """
    WITH up AS (SELECT CASE WHEN c_nationkey < 12 THEN c_custkey ELSE -1 - c_custkey END AS c_custkey, c_name || ' new' AS c_name,
                  c_nationkey, c_acctbal + 1 AS c_acctbal, 'MERGED' AS c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD'))
    SELECT coalesce(c.c_custkey, up.c_custkey) AS c_custkey, coalesce(up.c_name, c.c_name) AS c_name,
      coalesce(up.c_nationkey, c.c_nationkey) AS c_nationkey, coalesce(up.c_acctbal, c.c_acctbal) AS c_acctbal,
      coalesce(c.c_mktsegment, up.c_mktsegment) AS c_mktsegment
    FROM customer c FULL JOIN up ON c.c_custkey = up.c_custkey""",
)
def merge_customers(spark, sf):
    target = load(spark, sf, "customer")
    upserts = target.where("c_mktsegment IN ('BUILDING', 'HOUSEHOLD')").selectExpr(
        "CASE WHEN c_nationkey < 12 THEN c_custkey ELSE -1 - c_custkey END AS c_custkey",
        "c_name || ' new' AS c_name",
        "c_nationkey",
        "c_acctbal + 1 AS c_acctbal",
        "'MERGED' AS c_mktsegment",
    )
    return keyed_merge(target, upserts, ["c_custkey"], protected=("c_mktsegment",))


@query(
    "latest_version",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
    ) WHERE rn = 1""",
)
def latest_version(spark, sf):
    orders = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
