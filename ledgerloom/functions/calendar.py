"""Calendar features of a monthly series."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dip months, the year-end months and the lunar new-year month.
DIP_YEAR, DIP_MONTHS = 2021, (7, 8, 9)
YEAR_END_MONTHS = (11, 12)
NEW_YEAR_MONTH = 2


def seasonal(month_number: Column, period: int = 12) -> tuple[Column, Column]:
    """sin and cos of 2*pi*m/period."""
    angle = month_number * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def calendar_columns(
    date: Column,
    dip_year: int = DIP_YEAR,
    dip_months=DIP_MONTHS,
    year_end_months=YEAR_END_MONTHS,
    new_year_month: int = NEW_YEAR_MONTH,
) -> dict[str, Column]:
    """Month number, three harmonics and three 0/1 flags, by name."""
    number = F.month(date)
    sin12, cos12 = seasonal(number, 12)
    sin6, _ = seasonal(number, 6)
    dip = (F.year(date) == dip_year) & number.isin(*dip_months)
    return {
        "month_num": number,
        "sin_12": sin12,
        "cos_12": cos12,
        "sin_6": sin6,
        "covid_dip": dip.cast("int"),
        "yearend": number.isin(*year_end_months).cast("int"),
        "tet_feb": (number == new_year_month).cast("int"),
    }


def log_floor(col: Column, floor: float) -> Column:
    """Natural log of the value, not below the floor; NULL stays NULL."""
    return F.when(col.isNotNull(), F.ln(F.greatest(col, F.lit(floor))))
