"""Gold queries: the wagering flows over bets derived from orders and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.catalogue.shared import ORACLES, load, query, work_dir
from tierflow.functions import channels as ch
from tierflow.functions.crypto import Cipher, decrypt_columns, encrypt_columns
from tierflow.operators.cdc import apply_changes
from tierflow.operators.project import calendar_gate
from tierflow.plans import gold
from tierflow.plans.medallion import MedallionRun
from tierflow.plans.specs import GoldSpec
from tierflow.plans.views import ViewRegistry, build_targets, view_chain
from tierflow.session import materialize
from tierflow.sources.storage import publish

# --- derived inputs, once for Spark and once for DuckDB ------------------------------------------

_BET_LINE = """CASE WHEN o_orderkey % 97 = 0 THEN 'garbage' ELSE concat('BET ', CASE o_orderkey % 3 WHEN 0 THEN 'WIN' WHEN 1 THEN 'PLA' ELSE 'ALUP' END,
    ' ', CASE o_custkey % 2 WHEN 0 THEN 'ST' ELSE 'HV' END, ' ', {day}, ' MORE') END"""
_CENTRE = "CASE o_orderkey % 4 WHEN 0 THEN concat(o_orderkey % 10, '01') WHEN 1 THEN 'A12' END"
_TERMINAL = """CASE l_orderkey % 8 WHEN 0 THEN 'IBT' WHEN 1 THEN 'IOSBS' WHEN 2 THEN 'JCBWEKBA' WHEN 3 THEN 'JCBW' WHEN 4 THEN 'IBUT'
    WHEN 5 THEN 'MASBAI' WHEN 6 THEN 'OTHER' END"""
_SYSTEM = """CASE l_linenumber % 7 WHEN 0 THEN 'ACP01' WHEN 1 THEN 'ACP02' WHEN 2 THEN 'AGP01' WHEN 3 THEN 'AGP02' WHEN 4 THEN 'AGP03' ELSE 'AGP04' END"""
_POOL_TYPE = "CASE l_linenumber % 4 WHEN 0 THEN 'ALUP' WHEN 1 THEN 'WIN' WHEN 2 THEN '' END"


def _accounts(spark: SparkSession, sf: str) -> DataFrame:
    """One segment has no accounts, so that some bets find none."""
    return load(spark, sf, "customer").where("c_mktsegment <> 'MACHINERY'").selectExpr(
        "CAST(c_custkey AS STRING) AS account_no", "c_custkey * 10 AS customer_id"
    )


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "customer").selectExpr(
        "c_custkey * 10 AS customer_id", "'C1' AS company_id", "c_mktsegment AS seg_team_cge",
        "lower(c_mktsegment) AS seg_team_cge_transformed", "left(c_mktsegment, 3) AS sub_segment",
        "CASE WHEN c_acctbal > 0 THEN 'TRUE' ELSE 'FALSE' END AS active_flag",
    )


def _fixed_odds(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    bets = orders.where("o_orderstatus <> 'P'").selectExpr(
        _BET_LINE.format(day="date_format(o_orderdate, 'dd/MM/yyyy')") + " AS header__betline",
        "CAST(o_custkey AS STRING) AS header__accountNo",
        "o_orderkey % 19 AS header__sourceType",
        f"{_CENTRE} AS header__processingLocation__cbLocation__centreNo",
        "o_orderkey % 33 AS header__processingLocation__directInputLocation__citType",
        "CAST(round(o_totalprice * 100) AS BIGINT) AS header__sellRequest__betVar__totalAmount",
        "o_orderkey AS ticket__ticketId",
        "o_orderkey % 3 AS header__systemId",
        "CAST(o_orderdate AS TIMESTAMP) AS ticket__sellingDateTime",
    )
    cancels = orders.where("o_orderstatus = 'P'").selectExpr(
        "CAST(round(o_totalprice * 100) AS BIGINT) AS ticket__betVar__totalRefund",
        "o_orderkey AS ticket__ticketId",
        "o_orderkey % 3 AS header__systemId",
        "CAST(o_orderdate AS TIMESTAMP) AS ticket__sellingDateTime",
    )
    return gold.fixed_odds_events(bets, cancels, _accounts(spark, sf), gold.segment_snapshot(_segments(spark, sf)))


def _pool(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem")
    bets = lines.where("l_returnflag <> 'R'").selectExpr(
        "CAST(l_shipdate AS TIMESTAMP) AS meeting_date",
        "1 + l_suppkey % 11 AS meeting_loc",
        "CASE l_linenumber % 3 WHEN 0 THEN concat(l_partkey % 10, '7') END AS cbbt_centre_no",
        "concat(l_suppkey % 10, '9') AS old_cb_centre_no",
        "l_partkey % 20 AS source_type",
        f"{_TERMINAL} AS cit_type",
        "CASE WHEN l_orderkey % 13 = 0 THEN 'TBAS01' ELSE 'X' END AS v_term_no",
        f"{_POOL_TYPE} AS bet_type",
        "l_linenumber AS race_no",
        *[f"l_linenumber + {n} AS allup_race_no{n}" for n in range(1, 7)],
        "l_orderkey % 8 AS allup_event_no",
        "l_partkey AS acct_no",
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS ttl_cost",
        "CAST(l_shipdate AS TIMESTAMP) AS selling_date",
        f"{_SYSTEM} AS oltp_id",
        "l_orderkey * 10 + l_linenumber AS headerActivityID",
        "l_partkey AS ac_tran_no",
        "CAST(l_shipdate AS TIMESTAMP) AS time_stamp",
    )
    cancels = lines.where("l_returnflag = 'R'").selectExpr(
        "l_partkey AS acct_no", "CAST(round(l_extendedprice * 100) AS BIGINT) AS meet_ttl_cost",
        "CAST(l_shipdate AS TIMESTAMP) AS selling_date", "l_partkey AS ac_tran_no", "CAST(l_shipdate AS TIMESTAMP) AS time_stamp",
    )
    return gold.pool_events(bets, cancels, _accounts(spark, sf))


def _bets(spark: SparkSession, sf: str) -> DataFrame:
    return gold.bet_rows(_pool(spark, sf), _fixed_odds(spark, sf))


_ACCOUNTS_SQL = "acc AS (SELECT CAST(c_custkey AS VARCHAR) AS account_no, c_custkey * 10 AS customer_id FROM customer WHERE c_mktsegment <> 'MACHINERY'), seg AS (SELECT c_custkey * 10 AS customer_id, lower(c_mktsegment) AS seg_team FROM customer WHERE c_acctbal > 0)"
_FO_SQL = f"""
    fo_in AS (SELECT *, {_BET_LINE.format(day="strftime(o_orderdate, '%d/%m/%Y')")} AS line, {_CENTRE} AS centre, o_orderkey % 19 AS src, o_orderkey % 33 AS cit FROM orders),
    fo AS (
      SELECT CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_custkey % 2 = 0 THEN 'ST' ELSE 'HV' END AS meeting_location,
        CASE WHEN o_orderkey % 97 <> 0 THEN date_trunc('day', o_orderdate) END AS meeting_date, seg.seg_team AS seg_team_cge_transformed,
        CASE WHEN left(centre, 1) IN ('3','6','9') THEN 'RC ESC/EWallet' WHEN left(centre, 1) IN ('1','2','4','5','7','8') THEN 'OCB ESC/Ewallet'
          WHEN src = 17 THEN 'TBAS' WHEN src = 1 THEN 'TB Voice' WHEN cit IN (20, 23) THEN 'Classic 3-in-1' WHEN cit = 17 THEN 'eWin' WHEN cit = 11 THEN 'eWin(New)'
          WHEN cit IN (26, 28) THEN 'Racing Touch' WHEN cit IN (30, 31) THEN 'GoalX' ELSE 'NA' END AS channel,
        CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE regexp_extract(line, '^[A-Z]+ ([A-Z]+)', 1) END AS bet_type,
        CAST(NULL AS INT) AS race_no, CAST(NULL AS INT) AS first_race_no, CAST(NULL AS INT) AS last_race_no, true AS fo_flag,
        CAST(o_custkey AS VARCHAR) AS account_no, acc.customer_id, round(o_totalprice * 100) / 100.0 AS ttl_cost, false AS cancelled, 0.0 AS cancelled_amount,
        o_orderkey AS ticketid, o_orderkey % 3 AS systemcode, o_orderdate AS sell_time
      FROM fo_in LEFT JOIN acc ON acc.account_no = CAST(o_custkey AS VARCHAR) LEFT JOIN seg ON seg.customer_id = acc.customer_id WHERE o_orderstatus <> 'P'
      UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true, NULL, 9999999, 999999.99, true, round(o_totalprice * 100) / 100.0, o_orderkey, o_orderkey % 3, o_orderdate
      FROM orders WHERE o_orderstatus = 'P')"""
_POOL_SQL = f"""
    pin AS (SELECT *, 1 + l_suppkey % 11 AS loc, CASE l_linenumber % 3 WHEN 0 THEN concat(l_partkey % 10, '7') END AS cb, concat(l_suppkey % 10, '9') AS old_cb,
      l_partkey % 20 AS src, {_TERMINAL} AS cit, CASE WHEN l_orderkey % 13 = 0 THEN 'TBAS01' ELSE 'X' END AS term, {_POOL_TYPE} AS bet_type,
      {_SYSTEM} AS sys, l_orderkey % 8 AS legs FROM lineitem),
    pmid AS (SELECT *, left(CASE WHEN src IN (4, 19) OR cit = 'IBT' THEN coalesce(cb, old_cb) ELSE cb END, 1) AS digit FROM pin),
    pmu AS (
      SELECT CASE loc WHEN 1 THEN 'ST' WHEN 2 THEN 'HV' WHEN 3 THEN 'X1' WHEN 4 THEN 'X2' WHEN 5 THEN 'S1' WHEN 6 THEN 'S2' WHEN 7 THEN 'S3' WHEN 8 THEN 'S4' WHEN 9 THEN 'S5' WHEN 10 THEN 'CH' END AS meeting_location,
        l_shipdate AS meeting_date, CAST(NULL AS VARCHAR) AS seg_team_cge_transformed,
        CASE WHEN digit IN ('3','6','9') THEN 'RC ESC/EWallet' WHEN digit IN ('1','2','4','5','7','8') THEN 'OCB ESC/Ewallet' WHEN left(term, 4) = 'TBAS' OR src = 17 THEN 'TBAS'
          WHEN src <> 17 AND cit = 'IOSBS' THEN 'Classic 3-in-1' WHEN src <> 17 AND cit = 'JCBWEKBA' THEN 'eWin' WHEN src <> 17 AND cit = 'JCBW' THEN 'eWin(New)'
          WHEN src <> 17 AND cit = 'IBUT' THEN 'Racing Touch' WHEN src <> 17 AND cit = 'MASBAI' THEN 'GoalX'
          WHEN src <> 17 AND coalesce(cit, '') IN ('IBT', 'OTHER', '') THEN 'TB Voice' ELSE 'NA' END AS channel,
        bet_type, l_linenumber AS race_no, CASE WHEN bet_type = 'ALUP' THEN l_linenumber + 1 END AS first_race_no,
        CASE WHEN legs BETWEEN 2 AND 6 THEN CAST(l_linenumber + legs AS INT) END AS last_race_no, false AS fo_flag, CAST(l_partkey AS VARCHAR) AS account_no, acc.customer_id,
        round(l_extendedprice * 100) / 100.0 AS ttl_cost, false AS cancelled, 0.0 AS cancelled_amount,
        CAST(date_diff('day', DATE '1900-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 1000000000000
          + CASE sys WHEN 'ACP01' THEN 20 WHEN 'ACP02' THEN 21 WHEN 'AGP01' THEN 17 WHEN 'AGP02' THEN 18 WHEN 'AGP03' THEN 19 WHEN 'AGP04' THEN 1 END * CAST(1000000000 AS BIGINT)
          + l_orderkey * 10 + l_linenumber AS ticketid,
        l_shipdate AS selling_date, l_partkey AS ac_tran_no, l_shipdate AS time_stamp
      FROM pmid LEFT JOIN acc ON acc.account_no = CAST(l_partkey AS VARCHAR) WHERE l_returnflag <> 'R'
      UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(l_partkey AS VARCHAR), 9999999, NULL, true, round(l_extendedprice * 100) / 100.0, 9999999, l_shipdate, l_partkey, l_shipdate
      FROM lineitem WHERE l_returnflag = 'R')"""
_COLUMNS = "meeting_location, meeting_date, seg_team_cge_transformed, channel, bet_type, race_no, first_race_no, last_race_no, fo_flag, account_no, customer_id, ttl_cost, cancelled, cancelled_amount, ticketid"
_BETS_SQL = f"""WITH {_ACCOUNTS_SQL}, {_FO_SQL}, {_POOL_SQL},
    bets AS (SELECT {_COLUMNS}, time_stamp AS sell_time FROM pmu WHERE NOT cancelled UNION ALL SELECT {_COLUMNS}, sell_time FROM fo WHERE NOT cancelled)
    """


def _plain(df: DataFrame) -> DataFrame:
    """Amounts as doubles, dates as texts and instants without a zone, for comparison with other engines."""
    out = []
    for f in df.schema.fields:
        plain = {"decimal": "double", "timestamp": "timestamp_ntz", "date": "string", "short": "int"}.get(f.dataType.typeName())
        out.append(F.col(f.name).cast(plain).alias(f.name) if plain else F.col(f.name))
    return df.select(*out)


# --- level one ----------------------------------------------------------------------------------


@query(
    "segment_snapshot",
    """
    SELECT c_custkey * 10 AS customer_id, 'C1' AS company_id, c_mktsegment AS seg_team_cge, lower(c_mktsegment) AS seg_team_cge_transformed,
      left(c_mktsegment, 3) AS sub_segment FROM customer WHERE c_acctbal > 0""",
)
def segment_snapshot(spark, sf):
    return gold.segment_snapshot(_segments(spark, sf))


@query("fixed_odds_events", f"WITH {_ACCOUNTS_SQL}, {_FO_SQL} SELECT * FROM fo", nullable=("customer_id", "first_race_no", "last_race_no", "race_no"))
def fixed_odds_events(spark, sf):
    return _plain(_fixed_odds(spark, sf))


@query(
    "fixed_odds_target",
    f"""
    WITH {_ACCOUNTS_SQL}, {_FO_SQL}
    SELECT ticketid, systemcode, channel, ttl_cost, cancelled, sell_time FROM fo""",
)
def fixed_odds_target(spark, sf):
    """The fact as a type-1 target keyed by ticket and system."""
    target = apply_changes(_fixed_odds(spark, sf), ["TicketId", "systemCode"], "sell_time", 1)
    return _plain(target.select("ticketid", "systemcode", "channel", "ttl_cost", "cancelled", "sell_time"))


@query("pool_events", f"WITH {_ACCOUNTS_SQL}, {_POOL_SQL} SELECT * FROM pmu", nullable=("customer_id", "first_race_no", "fo_flag", "last_race_no", "race_no"))
def pool_events(spark, sf):
    return _plain(_pool(spark, sf))


@query(
    "channel_case_map",
    """
    SELECT p_partkey, CASE WHEN left(CAST(p_size AS VARCHAR), 1) IN ('3','6','9') THEN 'RC ESC/EWallet' WHEN left(CAST(p_size AS VARCHAR), 1) IN ('1','2','4','5','7','8') THEN 'OCB ESC/Ewallet' ELSE 'NA' END AS channel,
      CASE p_size WHEN 1 THEN 'ST' WHEN 2 THEN 'HV' WHEN 3 THEN 'X1' WHEN 4 THEN 'X2' WHEN 5 THEN 'S1' WHEN 6 THEN 'S2' WHEN 7 THEN 'S3' WHEN 8 THEN 'S4' WHEN 9 THEN 'S5' WHEN 10 THEN 'CH' END AS place
    FROM part""",
)
def channel_case_map(spark, sf):
    nothing = F.lit(None).cast("int")
    return load(spark, sf, "part").select(
        "p_partkey", ch.fixed_odds_channel(F.col("p_size"), nothing, nothing).alias("channel"),
        ch.lookup(F.col("p_size"), ch.PLACES).alias("place"),
    )


# --- customer counts, totals, reconciliation -----------------------------------------------------


_DAY = "strftime(bets.meeting_date, '%Y-%m-%d') AS meeting_date"


# Count names of the configured views.
_COUNT_NAMES = {"by_meeting_channel": "cust_count_distinct", "by_meeting_bet_type": "cust_count_distinct"}


def _count_sql(which: str) -> str:
    keys = ", ".join(gold.CUSTOMER_COUNTS[which])
    shown = keys.replace("meeting_date", _DAY) if which in gold.COUNTS_BY_DATE else keys
    return f"{_BETS_SQL} SELECT {shown}, count(DISTINCT customer_id) AS {_COUNT_NAMES.get(which, 'cnt_dstnct_customer_id')} FROM bets " + (
        "WHERE bet_type IS NOT NULL OR bet_type <> '' " if which == "by_meeting_bet_type" else ""
    ) + "GROUP BY " + keys.replace("meeting_date", "bets.meeting_date")


def _register_counts() -> None:
    for which in gold.CUSTOMER_COUNTS:

        def run(spark, sf, which=which):
            return _plain(gold.customer_count(_bets(spark, sf), which))

        gaps = ("race_no",) if "race_no" in gold.CUSTOMER_COUNTS[which] else ()
        query(f"customers_{which}", _count_sql(which), gaps)(run)


_register_counts()


@query(
    "customers_by_meeting_day",
    f"""{_BETS_SQL} SELECT meeting_location, strftime(meeting_date, '%Y-%m-%d') AS meeting_day, channel, count(DISTINCT customer_id) AS cust_count_distinct
    FROM bets GROUP BY ALL""",
)
def customers_by_meeting_day(spark, sf):
    """By calendar date, where the configured count groups by the full timestamp."""
    bets = _bets(spark, sf).withColumn("meeting_day", F.col("meeting_date").cast("date"))
    return _plain(gold.distinct_customers(bets, ["meeting_location", "meeting_day", "channel"], "cust_count_distinct"))


@query(
    "meeting_totals",
    f"""{_BETS_SQL} SELECT meeting_location, {_DAY}, race_no, seg_team_cge_transformed, channel, bet_type, fo_flag,
      sum(CAST(ttl_cost AS DECIMAL(22,2)))::DOUBLE AS total_investment, CAST(count(DISTINCT ticketid) AS INT) AS total_ticket
    FROM bets GROUP BY meeting_location, bets.meeting_date, race_no, seg_team_cge_transformed, channel, bet_type, fo_flag""",
    nullable=("race_no",),
)
def meeting_totals(spark, sf):
    return _plain(gold.meeting_totals(_bets(spark, sf)))


@query(
    "meeting_reconciliation",
    f"""{_BETS_SQL}, known AS (
      SELECT meeting_location FROM (SELECT meeting_location, meeting_date, seg_team_cge_transformed FROM bets GROUP BY ALL)
      UNION SELECT meeting_location FROM (SELECT meeting_location, meeting_date, seg_team_cge_transformed, channel FROM bets GROUP BY ALL)
      UNION SELECT meeting_location FROM (SELECT meeting_location, meeting_date, bet_type, fo_flag FROM bets WHERE bet_type IS NOT NULL OR bet_type <> '' GROUP BY ALL)
      UNION SELECT meeting_location FROM (SELECT meeting_location, meeting_date, race_no, seg_team_cge_transformed FROM bets GROUP BY ALL)
      UNION SELECT meeting_location FROM (SELECT meeting_location, meeting_date, race_no, channel FROM bets GROUP BY ALL)
      UNION SELECT meeting_location FROM (SELECT meeting_location, meeting_date, race_no, bet_type, fo_flag FROM bets GROUP BY ALL)
      UNION SELECT meeting_location FROM (SELECT meeting_location, meeting_date, race_no, seg_team_cge_transformed, channel, bet_type, fo_flag FROM bets GROUP BY ALL))
    SELECT meeting_location, {_DAY}, last_race_no AS race_no, sum(CAST(ttl_cost AS DECIMAL(22,2)))::DOUBLE AS total_investment,
      CAST(count(DISTINCT ticketid) AS INT) AS total_ticket, max(sell_time) AS latest_sell_time
    FROM bets WHERE meeting_location IN (SELECT meeting_location FROM known WHERE meeting_location IS NOT NULL) GROUP BY meeting_location, bets.meeting_date, last_race_no""",
    nullable=("race_no",),
)
def meeting_reconciliation(spark, sf):
    """The bets are written once; of the seven other targets only the places are made."""
    bets = materialize(_bets(spark, sf))
    others = [*(gold.customer_count(bets, which) for which in gold.CUSTOMER_COUNTS), gold.meeting_totals(bets)]
    return _plain(gold.reconciliation(bets, others))


def _long(which: str, columns: str) -> str:
    """Rows of one target under the columns that all targets have together."""
    own = [c.strip() for c in columns.split(",")]
    shown = [f"{c} AS {c}" if c in own else f"NULL AS {c}" for c in _GROUP_COLUMNS]
    return f"SELECT '{which}' AS which, {', '.join(shown)}"


_GROUP_COLUMNS = ["meeting_location", "meeting_date", *gold.DIMENSIONS]


def _groups_sql() -> str:
    parts = []
    for which, own in gold.GROUPS.items():
        listed = ", ".join(["meeting_location", "meeting_date", *own])
        counted = "customer_id" if which in gold.CUSTOMER_COUNTS else "ticketid"
        amounts = "NULL, NULL" if which in gold.CUSTOMER_COUNTS else "sum(CAST(ttl_cost AS DECIMAL(22,2)))::DOUBLE, max(sell_time)"
        where = " WHERE bet_type IS NOT NULL" if which == "by_meeting_bet_type" else ""
        parts.append(f"{_long(which, listed)}, count(DISTINCT {counted}) AS n, {amounts.replace(', ', ' AS cost, ', 1)} AS latest FROM bets{where} GROUP BY {listed}")
    return f"{_BETS_SQL} " + " UNION ALL ".join(parts)


@query("gold_counts_run", _groups_sql(), nullable=("race_no", "last_race_no"))
def gold_counts_run(spark, sf):
    """The groups of all eight targets from one pass over the bets."""
    return _plain(gold.meeting_groups(_bets(spark, sf)))


def _gold_specs() -> list[GoldSpec]:
    """Eight gold targets over one shared view, as metadata: SQL texts only, in no order that would help."""
    columns = ", ".join(c for c in gold.BET_COLUMNS if c != "sell_time")
    sources = [
        {"reference_name": f"{t}_vw", "source_table": f"facts.{t}", "filter_condition": "cancelled = false", "is_streaming": "false", "pii_fields": {}}
        for t in ("pool", "fixed_odds")
    ]
    shared = f"SELECT {columns}, time_stamp AS sell_time FROM live.pool_vw UNION ALL SELECT {columns}, sell_time FROM live.fixed_odds_vw"
    texts = {}
    for which, keys in gold.CUSTOMER_COUNTS.items():
        listed = ", ".join(keys)
        where = " WHERE bet_type IS NOT NULL OR bet_type <> ''" if which == "by_meeting_bet_type" else ""
        texts[which] = f"SELECT {listed}, count(DISTINCT customer_id) AS customers FROM live.bet_raw_vw{where} GROUP BY {listed}"
    amounts = "sum(ttl_cost) AS total_investment, CAST(count(DISTINCT ticketid) AS INT) AS total_ticket"
    keys = "meeting_location, meeting_date, race_no, seg_team_cge_transformed, channel, bet_type, fo_flag"
    texts["totals"] = f"SELECT {keys}, {amounts} FROM live.bet_raw_vw GROUP BY {keys}"
    known = " UNION ".join(f"SELECT meeting_location FROM mart.{which}" for which in texts)
    texts["recon"] = f"""SELECT meeting_location, CAST(meeting_date AS DATE) AS meeting_date, CAST(last_race_no AS SMALLINT) AS race_no, {amounts}, max(sell_time) AS latest_sell_time
      FROM live.bet_raw_vw WHERE meeting_location IN ({known}) GROUP BY meeting_location, bet_raw_vw.meeting_date, last_race_no"""
    specs = []
    for which in reversed(texts):
        first = which == "by_meeting_segment"
        views = [{"reference_name": "bet_raw_vw", "sql_condition": shared}] if first else []
        views.append({"reference_name": f"{which}_vw", "sql_condition": texts[which]})
        specs.append(GoldSpec(which, "g", targetDetails={"database": "mart", "table": which}, isStreaming="false", env="dev", sources=sources if first else [], views=views))
    return specs


@query(
    "gold_recon_run",
    ORACLES["meeting_reconciliation"],
)
def gold_recon_run(spark, sf):
    """A run of the eight targets from their metadata: the shared view is made once, the reconciliation waits for its siblings."""
    lake = work_dir(spark, "gold-run")
    for table, facts in (("pool", _pool(spark, sf)), ("fixed_odds", _fixed_odds(spark, sf))):
        publish(facts, f"{lake}/facts/{table}")
    specs = _gold_specs()
    run = MedallionRun(spark, lake)
    run.run("gold", {"gold": specs})
    return _plain(run.read(specs[0])).withColumn("race_no", F.col("race_no").cast("double"))


@query(
    "distinct_union",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey FROM nation",
)
def distinct_union(spark, sf):
    frames = [
        load(spark, sf, t).select(F.col(c).alias("nation"))
        for t, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))
    ]
    return frames[0].union(frames[1]).union(frames[2]).distinct()


# --- SQL view chains ----------------------------------------------------------------------------


def _sources(spark: SparkSession, sf: str) -> ViewRegistry:
    registry = ViewRegistry(spark)
    for table in ("orders", "customer", "lineitem"):
        registry.register(f"src_{table}", load(spark, sf, table))
    return registry


@query(
    "view_chain_totals",
    """
    SELECT c_mktsegment, CAST(sum(CAST(amount AS DECIMAL(22,2))) AS DOUBLE) AS total, count(DISTINCT id) AS n FROM (
      SELECT o_custkey AS cust, o_totalprice AS amount, o_orderkey AS id FROM orders
      UNION ALL SELECT c_custkey, c_acctbal, -c_custkey FROM customer) a JOIN customer ON cust = c_custkey GROUP BY c_mktsegment""",
)
def view_chain_totals(spark, sf):
    registry = _sources(spark, sf)
    return view_chain(
        registry,
        [
            (
                "all_amounts",
                """SELECT o_custkey AS cust, o_totalprice AS amount, o_orderkey AS id FROM live.src_orders
                UNION ALL SELECT c_custkey, c_acctbal, -c_custkey FROM live.src_customer""",
            ),
            ("with_segment", "SELECT a.*, c.c_mktsegment FROM live.all_amounts a JOIN live.src_customer c ON a.cust = c.c_custkey"),
            (
                "totals",
                """SELECT c_mktsegment, CAST(sum(CAST(amount AS DECIMAL(22,2))) AS DOUBLE) AS total, count(DISTINCT id) AS n
                FROM live.with_segment GROUP BY c_mktsegment""",
            ),
        ],
    )


@query(
    "shared_view_targets",
    """
    WITH raw AS (SELECT c_mktsegment AS seg, o_orderstatus AS status, o_custkey AS cust FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 50000)
    SELECT 'by_segment' AS target, seg AS part, count(DISTINCT cust) AS n FROM raw GROUP BY seg
    UNION ALL SELECT 'by_status', status, count(DISTINCT cust) FROM raw GROUP BY status
    UNION ALL SELECT 'known', seg, count(*) FROM raw WHERE seg IN (SELECT seg FROM raw) GROUP BY seg""",
)
def shared_view_targets(spark, sf):
    """Three targets over one shared view; the last also reads the first, which stands after it."""
    registry = _sources(spark, sf)
    targets = [
        {
            "target": "known",
            "views": [
                {
                    "name": "known_vw",
                    "sql": "SELECT seg AS part, count(*) AS n FROM live.raw_vw WHERE seg IN (SELECT part FROM live.segments_out) GROUP BY seg",
                }
            ],
        },
        {
            "target": "by_segment",
            "alias": "segments_out",
            "sources": [
                {
                    "reference_name": "orders_vw", "source_table_dev": "src_orders", "filter_condition": "o_totalprice > 50000",
                    "is_streaming": "false", "pii_fields": {},
                },
                {"reference_name": "customer_vw", "source_table_dev": "src_customer", "filter_condition": "", "pii_fields": {}},
            ],
            "views": [
                {
                    "name": "raw_vw",
                    "sql": """SELECT c.c_mktsegment AS seg, o.o_orderstatus AS status, o.o_custkey AS cust
                    FROM live.orders_vw o LEFT JOIN live.customer_vw c ON o.o_custkey = c.c_custkey""",
                },
                {"name": "seg_vw", "sql": "SELECT seg AS part, count(DISTINCT cust) AS n FROM live.raw_vw GROUP BY seg"},
            ],
        },
        {
            "target": "by_status",
            "views": [{"name": "status_vw", "sql": "SELECT status AS part, count(DISTINCT cust) AS n FROM live.raw_vw GROUP BY status"}],
        },
    ]
    frames = build_targets(registry, targets)
    parts = [frames[t["target"]].select(F.lit(t["target"]).alias("target"), "part", "n") for t in targets]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "gold_encrypted_chain",
    "SELECT c_custkey, c_name, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'",
)
def gold_encrypted_chain(spark, sf):
    """Sources are decrypted each by its own list, only the last view is encrypted; opened here for the check."""
    cipher = Cipher("0123456789abcdef")
    registry = ViewRegistry(spark)
    registry.register("sealed", encrypt_columns(load(spark, sf, "customer"), {"c_name": "string"}, cipher))
    registry.register("plain", load(spark, sf, "orders"))
    target = {
        "target": "t",
        "sources": [
            {"reference_name": "people", "source_table": "sealed", "filter_condition": "", "pii_fields": {"c_name": "string"}},
            {"reference_name": "bought", "source_table": "plain", "filter_condition": "o_orderstatus = 'F'", "pii_fields": {}},
        ],
        "views": [{"name": "joined", "sql": "SELECT c_custkey, c_name, o_orderkey FROM live.bought JOIN live.people ON o_custkey = c_custkey"}],
        "pii": {"c_name": "string"},
    }
    return decrypt_columns(build_targets(registry, [target], cipher=cipher)["t"], {"c_name": "string"}, cipher)


@query(
    "calendar_gate",
    "SELECT count(*) > 0 AS is_open FROM orders WHERE o_orderstatus = 'O' AND CAST(o_orderdate AS DATE) = DATE '1998-10-03' AND o_orderpriority IN ('1-URGENT', '5-LOW')",
)
def open_day(spark, sf):
    return calendar_gate(
        load(spark, sf, "orders"), F.lit("1998-10-03").cast("date"), ["1-URGENT", "5-LOW"], current="o_orderstatus = 'O'",
        date_column="o_orderdate", place_column="o_orderpriority",
    )


# --- product offers -----------------------------------------------------------------------------

_OFFER = """concat('{"body":{"entyGrps":[{"entys":[{"id":"', user_id, '","status":"', event_type, '","prvStatus":"none","mtgId":"m', event_id % 9,
    CASE WHEN event_id % 6 = 0 THEN '"' ELSE '","mtgDate":"2024-01-1' || CAST(event_id % 9 AS STRING) || '"' END,
    ',"raceId":"r', event_id, '","raceSeq":', event_id % 12, ',"pdtId":"p', user_id, '","crtAt":"c', event_id, '","crtBy":"me","updAt":"', 100000000 + event_id, '"}]}]}}')"""


def _offers(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "events").select(
        F.encode(F.expr(_OFFER), "UTF-8").alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )


@query(
    "product_offers",
    """
    SELECT CAST(user_id AS VARCHAR) AS product_offer_id, event_type AS product_offer_status, 'none' AS product_offer_previous_status, 'm' || (event_id % 9) AS meeting_id,
      '2024-01-1' || (event_id % 9) AS meeting_date, 'r' || event_id AS race_id, CAST(event_id % 12 AS VARCHAR) AS race_sequence, 'p' || user_id AS product_id,
      'c' || event_id AS created_at, 'me' AS created_by, CAST(100000000 + event_id AS VARCHAR) AS updated_at, CAST(NULL AS VARCHAR) AS updated_by, ts AS kfk_operation_datetime
    FROM events WHERE event_id % 6 <> 0""",
)
def product_offers(spark, sf):
    out = gold.product_offers(_offers(spark, sf)).drop("etl_created_datetime", "etl_last_update_datetime", "etl_remark")
    return _plain(out.withColumn("meeting_date", F.col("meeting_date").cast("string")))


@query(
    "product_offers_target",
    """
    SELECT CAST(user_id AS VARCHAR) AS product_offer_id, arg_max(event_type, event_id) AS product_offer_status, CAST(user_id AS VARCHAR) AS race_id
    FROM events WHERE event_id % 6 <> 0 GROUP BY user_id""",
)
def product_offers_target(spark, sf):
    """The configured column list, as a type-1 target ordered by a struct."""
    clock = F.lit("2024-06-01 00:00:00").cast("timestamp")
    rows = gold.product_offers(_offers(spark, sf), gold.OFFER_COLUMNS_AS_CONFIGURED, clock)
    rows = rows.withColumn("updated_at", F.col("kfk_operation_datetime").cast("string"))
    target = apply_changes(
        rows, ["product_offer_id"], "struct(updated_at, kfk_operation_datetime, etl_last_update_datetime)", 1
    )
    return target.select("product_offer_id", "product_offer_status", "race_id")
