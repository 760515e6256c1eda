"""Lookups of the wagering flows: sales channel, meeting place, ticket number."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
# First digit of a betting centre's number.
CENTRE_CHANNELS = {"RC ESC/EWallet": ("3", "6", "9"), "OCB ESC/Ewallet": ("1", "2", "4", "5", "7", "8")}
# Source types and terminal types of fixed-odds bets.
SOURCE_CHANNELS = {"TBAS": (17,), "TB Voice": (1,)}
TERMINAL_CHANNELS = {
    "Classic 3-in-1": (20, 23),
    "eWin": (17,),
    "eWin(New)": (11,),
    "Racing Touch": (26, 28),
    "GoalX": (30, 31),
}
# Terminal codes of pool bets.
POOL_TERMINALS = {
    "Classic 3-in-1": ("IOSBS", "AOSBS"),
    "eWin": ("JCBWEKBA",),
    "eWin(New)": ("JCBW",),
    "Racing Touch": ("IBUT", "IBUA"),
    "GoalX": ("MASBAI", "MASBAA"),
}
TBAS_SOURCE, TBAS_TERMINAL = 17, "TBAS"
OLD_CENTRE_SOURCES, OLD_CENTRE_TERMINAL = (4, 19), "IBT"
# Terminal codes that are not a telephone bet.
KNOWN_TERMINALS = [
    "AMBS", "CIT-3", "CIT3", "CIT-3A", "CIT3A", "CIT-5", "CIT5", "CIT6", "CIT-8", "CIT8", "CIT-PDA", "CITPDA",
    "PDA", "EWIN", "E-WIN", "JCBW", "MANGO", "JCBWEKBA", "MANGOCOMBO", "MANGODELUXE", "MPB", "TWM", "WLPDA",
    "ITV", "ITVBS", "IP-PHONE", "IPPHONE", "IPPBS", "APINOW", "IOSBS", "JCMOW", "AOSBS", "APISMC", "APITD",
    "IBUT", "APIWC", "IBUA", "WOSBS", "MASBAI", "MASBAA",
]
VOICE, OTHER = "TB Voice", "NA"
PLACES = {1: "ST", 2: "HV", 3: "X1", 4: "X2", 5: "S1", 6: "S2", 7: "S3", 8: "S4", 9: "S5", 10: "CH"}
SYSTEMS = {"ACP01": 20, "ACP02": 21, "AGP01": 17, "AGP02": 18, "AGP03": 19, "AGP04": 1}
TICKET_EPOCH = "1900-01-01"
TICKET_DAY, TICKET_SYSTEM = 1_000_000_000_000, 1_000_000_000
PLACE_PATTERN = r"^\w+\s\w+\s(\w+)"
TYPE_PATTERN = r"^\w+\s(\w+)"
DATE_PATTERN, DATE_FORMAT = r"\w+\s\w+\s\w+\s(\d{2}/\d{2}/\d{4}+)", "dd/MM/yyyy"


def first_match(value: Column | list[tuple[Column, str]], default: Column | None = None) -> Column:
    """Label of the first condition that holds."""
    (cond, label), *rest = value
    chain = reduce(lambda acc, cl: acc.when(cl[0], F.lit(cl[1])), rest, F.when(cond, F.lit(label)))
    return chain.otherwise(default) if default is not None else chain


def lookup(value: Column, table: dict) -> Column:
    """Value of a small fixed table; NULL when the key is not in it."""
    return first_match([(value == F.lit(k), v) for k, v in table.items()])


def _centre(number: Column) -> list[tuple[Column, str]]:
    # Compared as text: a number's first character need not be a digit.
    first = F.left(number.cast("string"), F.lit(1))
    return [(first.isin(*digits), label) for label, digits in CENTRE_CHANNELS.items()]


def fixed_odds_channel(centre: Column, source_type: Column, terminal: Column) -> Column:
    rules = _centre(centre)
    rules += [(source_type.isin(*codes), label) for label, codes in SOURCE_CHANNELS.items()]
    rules += [(terminal.isin(*codes), label) for label, codes in TERMINAL_CHANNELS.items()]
    return first_match(rules, F.lit(OTHER))


def pool_channel(
    centre: Column, old_centre: Column, source_type: Column, terminal: Column, voice_terminal: Column
) -> Column:
    uses_old = source_type.isin(*OLD_CENTRE_SOURCES) | (terminal == OLD_CENTRE_TERMINAL)
    rules = _centre(F.when(uses_old, F.nvl(centre, old_centre)).otherwise(centre))
    rules.append(((F.substring(voice_terminal, 1, 4) == TBAS_TERMINAL) | (source_type == TBAS_SOURCE), TBAS_TERMINAL))
    elsewhere = source_type != TBAS_SOURCE
    rules += [(elsewhere & terminal.isin(*codes), label) for label, codes in POOL_TERMINALS.items()]
    rules.append((elsewhere & ~F.nvl(terminal, F.lit("")).isin(*KNOWN_TERMINALS), VOICE))
    return first_match(rules, F.lit(OTHER))


def money(cents: Column) -> Column:
    """Amount in currency from an amount in cents."""
    return (cents.cast("decimal(22,2)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")


def ticket_number(sold_on: Column, system: Column, activity: Column) -> Column:
    """Days since 1900, system code and activity number packed into one long."""
    days = F.datediff(sold_on.cast("date"), F.lit(TICKET_EPOCH).cast("date")).cast("bigint")
    return days * TICKET_DAY + lookup(system, SYSTEMS).cast("bigint") * TICKET_SYSTEM + activity.cast("bigint")
