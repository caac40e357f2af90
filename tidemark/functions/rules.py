"""Business rules on single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.compare import null_default

# Client types (dppaidin) by charge mode, statuses and document type.
CARD_TYPES = (1, 3, 6, 7, 8, 9)
PACK_TYPE = 2
NO_CARD_TYPES = (4, 5)
TOKEN_TYPE = 10
LINK_TYPE = 11
NET_STATUSES = (1, 2, 3)
NET_DOCUMENT = "PA"
LOCAL_CURRENCY = "MXN"


def charge_mode(dppaidin: Column, with_card: Column, clientid: Column) -> Column:
    """0-5, first rule that holds: card, pack, no card, token, link, none."""
    return (
        F.when((with_card == 1) & dppaidin.isin(*CARD_TYPES), 1)
        .when(dppaidin == PACK_TYPE, 2)
        .when(dppaidin.isin(*NO_CARD_TYPES) | (clientid < 0), 3)
        .when(dppaidin == TOKEN_TYPE, 4)
        .when(dppaidin == LINK_TYPE, 5)
        .otherwise(0)
    )


def pack_flag(dppaidin: Column) -> Column:
    return F.when(dppaidin == PACK_TYPE, 1).otherwise(0)


def net_amount(
    gross: Column, *, statusc: Column | None = None, tipodoc: Column | None = None
) -> Column:
    """Gross if the row counts as net, else 0.

    Rows that are not packed count by status, packed rows by document type.
    """
    counts = statusc.isin(*NET_STATUSES) if tipodoc is None else tipodoc == NET_DOCUMENT
    return F.when(counts, gross).otherwise(F.lit(0).cast("decimal(18,6)"))


def to_usd(amount: Column, currency: Column, rate: Column) -> Column:
    """Local currency divided by its rate, every other currency unchanged.

    No rate, or a rate of 0, gives null rather than an error. A null currency
    is not local currency.
    """
    local = null_default(currency, "") == LOCAL_CURRENCY
    return F.when(local, F.try_divide(amount, rate)).otherwise(amount)
