"""Gold frames of the wagering flows.

Where the source of a column is missing it is a typed NULL, so that the union branches have one type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions import channels as ch
from tierflow.functions.decode import nested_item, parse_json_as, paths_present, payload_text
from tierflow.operators.project import pinned
from tierflow.session import materialize

# Placeholders in cancelled rows.
NO_CUSTOMER, NO_COST, NO_TICKET = 9999999, "999999.99", 9999999

# Columns of the bet facts.
BET_COLUMNS = [
    "meeting_location", "meeting_date", "seg_team_cge_transformed", "channel", "bet_type", "race_no", "first_race_no",
    "last_race_no", "fo_flag", "account_no", "customer_id", "ttl_cost", "cancelled", "cancelled_amount", "ticketid",
    "sell_time",
]
_AMOUNT = "decimal(22,2)"


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def segment_snapshot(segments: DataFrame) -> DataFrame:
    """Current rows of the segment list."""
    return segments.where("active_flag = 'TRUE'").select(
        "customer_id", "company_id", "seg_team_cge", "seg_team_cge_transformed", "sub_segment"
    )


def fixed_odds_events(bets: DataFrame, cancels: DataFrame, accounts: DataFrame, segments: DataFrame) -> DataFrame:
    """Fixed-odds bets with account and segment, and the cancellations under them."""
    place = "header__processingLocation"
    line = F.col("header__betline")
    sold = bets.join(accounts, bets["header__accountNo"] == accounts["account_no"], "left").join(
        segments.select(F.col("customer_id").alias("__seg"), "seg_team_cge_transformed"),
        accounts["customer_id"] == F.col("__seg"),
        "left",
    )
    live = sold.select(
        F.regexp_extract(line, ch.PLACE_PATTERN, 1).alias("meeting_location"),
        F.try_to_timestamp(F.regexp_extract(line, ch.DATE_PATTERN, 1), F.lit(ch.DATE_FORMAT)).alias("meeting_date"),
        "seg_team_cge_transformed",
        ch.fixed_odds_channel(
            F.col(f"{place}__cbLocation__centreNo"),
            F.col("header__sourceType"),
            F.col(f"{place}__directInputLocation__citType"),
        ).alias("channel"),
        F.regexp_extract(line, ch.TYPE_PATTERN, 1).alias("bet_type"),
        *[_null("int").alias(c) for c in ("race_no", "first_race_no", "last_race_no")],
        F.lit(True).alias("fo_flag"),
        F.col("header__accountNo").cast("string").alias("account_no"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        ch.money(F.col("header__sellRequest__betVar__totalAmount")).alias("ttl_cost"),
        F.lit(False).alias("cancelled"),
        F.lit("0.00").cast(_AMOUNT).alias("cancelled_amount"),
        F.col("ticket__ticketId").alias("ticketid"),
        F.col("header__systemId").alias("systemcode"),
        F.col("ticket__sellingDateTime").alias("sell_time"),
    )
    gone = cancels.select(
        _null("string").alias("meeting_location"),
        _null("timestamp").alias("meeting_date"),
        *[_null("string").alias(c) for c in ("seg_team_cge_transformed", "channel", "bet_type")],
        *[_null("int").alias(c) for c in ("race_no", "first_race_no", "last_race_no")],
        F.lit(True).alias("fo_flag"),
        _null("string").alias("account_no"),
        F.lit(NO_CUSTOMER).cast("bigint").alias("customer_id"),
        F.lit(NO_COST).cast(_AMOUNT).alias("ttl_cost"),
        F.lit(True).alias("cancelled"),
        ch.money(F.col("ticket__betVar__totalRefund")).alias("cancelled_amount"),
        F.col("ticket__ticketId").alias("ticketid"),
        F.col("header__systemId").alias("systemcode"),
        F.col("ticket__sellingDateTime").alias("sell_time"),
    )
    return live.unionByName(gone)


def pool_events(bets: DataFrame, cancels: DataFrame, accounts: DataFrame) -> DataFrame:
    """Pool bets with their account, and the cancellations under them."""
    legs = range(2, 7)
    last_leg = reduce(
        lambda acc, n: acc.when(F.col("allup_event_no") == n, F.col(f"allup_race_no{n}")),
        legs,
        F.when(F.lit(False), _null("int")),
    )
    sold = bets.join(accounts, bets["acct_no"] == accounts["account_no"], "left")
    live = sold.select(
        "meeting_date",
        ch.lookup(F.col("meeting_loc"), ch.PLACES).alias("meeting_location"),
        _null("string").alias("seg_team_cge_transformed"),
        ch.pool_channel(
            F.col("cbbt_centre_no"), F.col("old_cb_centre_no"), F.col("source_type"), F.col("cit_type"), F.col("v_term_no")
        ).alias("channel"),
        "bet_type",
        F.col("race_no").cast("int").alias("race_no"),
        F.when(F.col("bet_type") == "ALUP", F.col("allup_race_no1")).cast("int").alias("first_race_no"),
        last_leg.cast("int").alias("last_race_no"),
        F.lit(False).alias("fo_flag"),
        F.col("acct_no").cast("string").alias("account_no"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        ch.money(F.col("ttl_cost")).alias("ttl_cost"),
        F.lit(False).alias("cancelled"),
        F.lit("0.00").cast(_AMOUNT).alias("cancelled_amount"),
        ch.ticket_number(F.col("selling_date"), F.col("oltp_id"), F.col("headerActivityID")).alias("ticketid"),
        "selling_date",
        "ac_tran_no",
        "time_stamp",
    )
    gone = cancels.select(
        _null("timestamp").alias("meeting_date"),
        *[_null("string").alias(c) for c in ("meeting_location", "seg_team_cge_transformed", "channel", "bet_type")],
        *[_null("int").alias(c) for c in ("race_no", "first_race_no", "last_race_no")],
        _null("boolean").alias("fo_flag"),
        F.col("acct_no").cast("string").alias("account_no"),
        F.lit(NO_CUSTOMER).cast("bigint").alias("customer_id"),
        _null(_AMOUNT).alias("ttl_cost"),
        F.lit(True).alias("cancelled"),
        ch.money(F.col("meet_ttl_cost")).alias("cancelled_amount"),
        F.lit(NO_TICKET).cast("bigint").alias("ticketid"),
        "selling_date",
        "ac_tran_no",
        "time_stamp",
    )
    return live.unionByName(gone)


def bet_rows(pool: DataFrame, fixed_odds: DataFrame) -> DataFrame:
    """Live bets of both kinds in one layout."""
    pool = pool.where("cancelled = false").withColumnRenamed("time_stamp", "sell_time").select(*BET_COLUMNS)
    return pool.unionByName(fixed_odds.where("cancelled = false").select(*BET_COLUMNS))


def distinct_customers(bets: DataFrame, keys: list[str], name: str = "cnt_dstnct_customer_id") -> DataFrame:
    """Spark counts distinct values in two steps, keys and customer first, so a large group is spread."""
    return bets.groupBy(*keys).agg(F.count_distinct("customer_id").alias(name))


# Grouping columns of the six customer counts.
CUSTOMER_COUNTS = {
    "by_meeting_segment": ["meeting_location", "meeting_date", "seg_team_cge_transformed"],
    "by_meeting_channel": ["meeting_location", "meeting_date", "seg_team_cge_transformed", "channel"],
    "by_meeting_bet_type": ["meeting_location", "meeting_date", "bet_type", "fo_flag"],
    "by_race_segment": ["meeting_location", "meeting_date", "race_no", "seg_team_cge_transformed"],
    "by_race_channel": ["meeting_location", "meeting_date", "race_no", "channel"],
    "by_race_bet_type": ["meeting_location", "meeting_date", "race_no", "bet_type", "fo_flag"],
}


# The name of the count where it is not the usual one.
COUNT_NAMES = {"by_meeting_channel": "cust_count_distinct", "by_meeting_bet_type": "cust_count_distinct"}

# Counts that show the meeting date as a date. They still group by the full timestamp, as configured.
COUNTS_BY_DATE = ("by_meeting_channel", "by_meeting_bet_type", "by_race_bet_type")


def customer_count(bets: DataFrame, which: str) -> DataFrame:
    # As configured: this keeps empty bet types, too.
    source = bets.where("bet_type IS NOT NULL OR bet_type <> ''") if which == "by_meeting_bet_type" else bets
    counted = distinct_customers(source, CUSTOMER_COUNTS[which], COUNT_NAMES.get(which, "cnt_dstnct_customer_id"))
    if which in COUNTS_BY_DATE:
        counted = counted.withColumn("meeting_date", F.col("meeting_date").cast("date"))
    if which == "by_race_bet_type":
        counted = counted.withColumn("race_no", F.col("race_no").try_cast("smallint"))
    return counted


def _shown(totals: DataFrame) -> DataFrame:
    return totals.withColumns(
        {"meeting_date": F.col("meeting_date").cast("date"), "race_no": F.col("race_no").try_cast("smallint")}
    )


def meeting_totals(bets: DataFrame) -> DataFrame:
    keys = ["meeting_location", "meeting_date", "race_no", "seg_team_cge_transformed", "channel", "bet_type", "fo_flag"]
    return _shown(
        bets.groupBy(*keys).agg(
            F.sum("ttl_cost").alias("total_investment"), F.count_distinct("ticketid").cast("int").alias("total_ticket")
        )
    )


def reconciliation(bets: DataFrame, others: list[DataFrame]) -> DataFrame:
    """Totals and latest sale of the places that any of the other tables knows.

    The places are written first: of a known small size they are broadcast. Otherwise the bets would be dealt out by place,
    and grouped in as many tasks as there are places.
    """
    known = materialize(reduce(DataFrame.union, (t.select("meeting_location").distinct() for t in others)).distinct())
    return _shown(
        bets.join(known, "meeting_location", "left_semi")
        .groupBy("meeting_location", "meeting_date", F.col("last_race_no").alias("race_no"))
        .agg(
            F.sum("ttl_cost").alias("total_investment"),
            F.count_distinct("ticketid").cast("int").alias("total_ticket"),
            F.max("sell_time").alias("latest_sell_time"),
        )
    )


# All eight targets in one pass. Each has the place and the date in its keys, and these dimensions beside them.
DIMENSIONS = ["race_no", "last_race_no", "seg_team_cge_transformed", "channel", "bet_type", "fo_flag"]
TOTALS, RECONCILIATION = "meeting_totals", "reconciliation"
GROUPS = {which: keys[2:] for which, keys in CUSTOMER_COUNTS.items()} | {
    TOTALS: ["race_no", "seg_team_cge_transformed", "channel", "bet_type", "fo_flag"],
    RECONCILIATION: ["last_race_no"],
}
_CUSTOMER, _TICKET, _AMOUNTS = 0, 1, 2


def meeting_groups(bets: DataFrame) -> DataFrame:
    """The groups of all eight targets (``which``) with ``n`` distinct customers or tickets, ``cost`` and ``latest`` sale.

    A bet counts as a customer, as a ticket and as an amount. One shuffle brings together what is known of a customer (a
    ticket) in a meeting: the different dimensions it has there, combined before the shuffle. These are all that the
    distinct counts of the meeting's groups need, and each customer is in one place, so counts of places only add up: exact
    without a second look at the bets. Amounts are added by dimensions on the way, and they bring every group, those that
    nobody counts in, too. What is shuffled after that are group sums, combined by task. A meeting with a third of all bets is
    spread over its customers and tickets.

    Nearly all customers and tickets have one place in a meeting, whose groups differ by target: plain structs. Only for the
    others a target's repeated groups must be found.
    """
    dimensions = F.struct(*DIMENSIONS)
    kind = bets.select(*DIMENSIONS, "meeting_location", "meeting_date", "customer_id", "ticketid", "ttl_cost", "sell_time").withColumn(
        "kind", F.explode(F.array(F.lit(_CUSTOMER), F.lit(_TICKET), F.lit(_AMOUNTS)))
    )
    here = lambda which, column: F.when(F.col("kind") == which, column)
    known = (F.col("kind") == _AMOUNTS) | here(_CUSTOMER, F.col("customer_id").isNotNull()) | here(_TICKET, F.col("ticketid").isNotNull())
    keyed = kind.where(known).select(
        "kind", "meeting_location", "meeting_date",
        here(_CUSTOMER, F.col("customer_id")).alias("customer"), here(_TICKET, F.col("ticketid")).alias("ticket"), here(_AMOUNTS, dimensions).alias("group"),
        F.when(F.col("kind") != _AMOUNTS, dimensions).alias("seen"), here(_AMOUNTS, F.col("ttl_cost")).alias("cost"), here(_AMOUNTS, F.col("sell_time")).alias("latest"),
    )
    met = keyed.groupBy("kind", "meeting_location", "meeting_date", "customer", "ticket", "group").agg(
        F.collect_set("seen").alias("seen"), F.sum("cost").alias("cost"), F.max("latest").alias("latest")
    )
    types = {f.name: f.dataType for f in bets.schema.fields}
    amounts = (TOTALS, RECONCILIATION)

    def group(which: str, s: Column) -> Column:
        return F.struct(F.lit(which).alias("which"), *[(s[d] if d in GROUPS[which] else F.lit(None).cast(types[d])).alias(d) for d in DIMENSIONS])

    def of_one(names) -> Column:
        return F.array(*[group(which, F.col("only")) for which in names])

    def of_many(names) -> Column:
        each_of = lambda which: F.transform("seen", lambda s: group(which, s))
        return F.concat(*[F.array_distinct(each_of(which)) for which in names])

    def groups(names) -> Column:
        return F.when(F.size("seen") == 1, of_one(names)).otherwise(of_many(names))

    each = (
        F.when(F.col("kind") == _AMOUNTS, of_one(GROUPS))
        .when(F.col("kind") == _CUSTOMER, groups(CUSTOMER_COUNTS))
        .otherwise(groups(amounts))
    )
    counts = (F.col("kind") != _AMOUNTS).cast("long")
    only = F.coalesce("group", F.get("seen", F.lit(0)))
    spread = met.withColumn("only", only).select("meeting_location", "meeting_date", counts.alias("n"), "cost", "latest", F.explode(each).alias("g")).select("*", "g.*")
    # As configured: this count leaves out bets without a type.
    spread = spread.where("which <> 'by_meeting_bet_type' OR bet_type IS NOT NULL")
    told = F.col("which").isin(*amounts)
    return spread.groupBy("which", "meeting_location", "meeting_date", *DIMENSIONS).agg(
        F.sum("n").alias("n"), F.sum(F.when(told, F.col("cost"))).cast("decimal(32,2)").alias("cost"), F.max(F.when(told, F.col("latest"))).alias("latest")
    )


def target_of_groups(groups: DataFrame, which: str) -> DataFrame:
    """One of the eight targets, as its own query would give it."""
    rows = groups.where(F.col("which") == which)
    keys = ["meeting_location", "meeting_date", *GROUPS[which]]
    if which in CUSTOMER_COUNTS:
        keys = CUSTOMER_COUNTS[which]
        out = rows.select(*keys, F.col("n").alias(COUNT_NAMES.get(which, "cnt_dstnct_customer_id")))
        if which in COUNTS_BY_DATE:
            out = out.withColumn("meeting_date", F.col("meeting_date").cast("date"))
        return out.withColumn("race_no", F.col("race_no").try_cast("smallint")) if which == "by_race_bet_type" else out
    amounts = [F.col("cost").alias("total_investment"), F.col("n").cast("int").alias("total_ticket")]
    if which == TOTALS:
        return _shown(rows.select(*keys, *amounts))
    known = groups.where(F.col("which") != RECONCILIATION).select("meeting_location").distinct()
    told = rows.join(known, "meeting_location", "left_semi")
    return _shown(told.select("meeting_location", "meeting_date", F.col("last_race_no").alias("race_no"), *amounts, F.col("latest").alias("latest_sell_time")))


# Layout of a product-offer message and the paths that must hold a value.
OFFER_FIELDS = [
    "crtAt", "crtBy", "id", "mtgDate", "mtgId", "pdtId", "prvStatus", "raceId", "raceSeq", "status", "updAt",
    "updBy",
]
OFFER_DDL = (
    "body struct<entyGrps: array<struct<entys: array<struct<"
    + ", ".join(f"{f}: {'bigint' if f == 'raceSeq' else 'string'}" for f in OFFER_FIELDS)
    + ">>>>>"
)
OFFER_REQUIRED = [
    "id", "status", "mtgId", "mtgDate", "raceId", "raceSeq", "pdtId", "crtAt", "crtBy",
]
OFFER_COLUMNS = {
    "product_offer_id": "id",
    "product_offer_status": "status",
    "product_offer_previous_status": "prvStatus",
    "meeting_id": "mtgId",
    "meeting_date": "mtgDate",
    "race_id": "raceId",
    "race_sequence": "raceSeq",
    "product_id": "pdtId",
    "created_at": "crtAt",
    "created_by": "crtBy",
    "updated_at": "updAt",
    "updated_by": "updBy",
}


# The published configuration fills all but the two status columns from ``id``; kept for those who rely on it.
OFFER_COLUMNS_AS_CONFIGURED = {
    out: field if field in ("id", "status", "prvStatus") else "id" for out, field in OFFER_COLUMNS.items()
}


def product_offers(
    messages: DataFrame, columns: dict[str, str] = OFFER_COLUMNS, now: Column | None = None
) -> DataFrame:
    """First entity of each complete product-offer message, decoded once."""
    now = F.current_timestamp() if now is None else now
    staged = messages.withColumn("__text", payload_text(F.col("value")))
    path = "$.body.entyGrps[0].entys[0]."
    staged = staged.where(paths_present(F.col("__text"), [path + f for f in OFFER_REQUIRED]))
    document = parse_json_as(F.col("__text"), OFFER_DDL)
    staged = pinned(staged, __e=nested_item(document, "body", "entyGrps", 0, "entys", 0))
    shaped = []
    for out, field in columns.items():
        value = F.col("__e")[field]
        shaped.append((value.try_cast("date") if out == "meeting_date" else value.cast("string")).alias(out))
    return staged.select(
        *shaped,
        F.col("timestamp").alias("kfk_operation_datetime"),
        now.alias("etl_created_datetime"),
        now.alias("etl_last_update_datetime"),
        _null("string").alias("etl_remark"),
    )
