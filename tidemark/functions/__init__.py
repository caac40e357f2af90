from tidemark.functions.compare import changed, null_default
from tidemark.functions.dates import (
    MONTH_NAMES,
    as_ntz,
    date_parts,
    iso_week,
    month_bounds,
    month_name,
    month_start,
    name_of_month,
    previous_month,
    previous_period,
    year_month,
    year_start,
)
from tidemark.functions.rules import charge_mode, net_amount, pack_flag, to_usd

__all__ = [
    "MONTH_NAMES",
    "as_ntz",
    "changed",
    "charge_mode",
    "date_parts",
    "iso_week",
    "month_bounds",
    "month_name",
    "month_start",
    "name_of_month",
    "net_amount",
    "null_default",
    "pack_flag",
    "previous_month",
    "previous_period",
    "to_usd",
    "year_month",
    "year_start",
]
