"""Calendar rules. Everything takes the date it works from; nothing reads a clock."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names the reports print, January first.
MONTH_NAMES = (
    "Enero",
    "Febrero",
    "Marzo",
    "Abril",
    "Mayo",
    "Junio",
    "Julio",
    "Agosto",
    "Septiembre",
    "Octubre",
    "Noviembre",
    "Diciembre",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ntz(value: datetime | str) -> Column:
    """A literal TIMESTAMP_NTZ: the same wall clock whatever the session zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def year_month(d: Column | str) -> Column:
    """YYYYMM as an int."""
    return F.year(_col(d)) * 100 + F.month(_col(d))


def name_of_month(n: Column | str) -> Column:
    """The name of month number 1-12."""
    return F.elt(_col(n), *[F.lit(name) for name in MONTH_NAMES])


def month_name(d: Column | str) -> Column:
    return name_of_month(F.month(_col(d)))


def date_parts(d: Column | str) -> list[Column]:
    """The six date columns every event fact carries."""
    d = _col(d)
    return [
        F.to_date(d).alias("fecha"),
        F.day(d).alias("dia"),
        F.month(d).alias("mes"),
        F.year(d).alias("anio"),
        year_month(d).alias("aniomes"),
        month_name(d).alias("nommes"),
    ]


def previous_month(asof: Column | str) -> Column:
    """YYYYMM of the month before ``asof``."""
    return year_month(F.add_months(_col(asof), -1))


def previous_period(asof: date) -> int:
    """The same on the driver, for a job that is started without a period."""
    return (asof.year - 1) * 100 + 12 if asof.month == 1 else asof.year * 100 + asof.month - 1


def year_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "YEAR")


def month_start(ym: int) -> date:
    year, month = divmod(ym, 100)
    return date(year, month, 1)


def month_bounds(ym_from: int, ym_to: int | None = None) -> tuple[date, date]:
    """Half-open range of dates from the first month to the end of the last."""
    last = month_start(ym_to or ym_from)
    end = date(last.year + last.month // 12, last.month % 12 + 1, 1)
    return month_start(ym_from), end


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(_col(d))
