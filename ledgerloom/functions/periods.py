"""Month strings and dates. Months are text: 'yyyy.MM' in the loan tables, 'yyyy-MM' in the sales series."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOT, DASH = ".", "-"


def month_text(date: Column, sep: str = DASH) -> Column:
    return F.date_format(date, f"yyyy{sep}MM")


def month_start(month: Column, sep: str = DASH) -> Column:
    """First day of a month string."""
    return F.to_date(F.concat(month, F.lit(f"{sep}01")), f"yyyy{sep}MM{sep}dd")


def shift_month(month: Column, n: int | Column, sep: str = DASH) -> Column:
    """Month string moved by `n` months, through a date so that year ends are right."""
    return month_text(F.add_months(month_start(month, sep), n), sep)


def month_label(date: Column) -> Column:
    """'MM-yy' label of a batch start date."""
    return F.date_format(date, "MM-yy")


def parse_mm_yy(period: Column) -> Column:
    """'m-yy' or 'mm-yy' to '20yy-mm'; anything without exactly two parts gives NULL."""
    parts = F.split(F.trim(period), "-")
    return F.when(
        F.size(parts) == 2, F.concat(F.lit("20"), parts[1], F.lit("-"), F.lpad(parts[0], 2, "0"))
    )


def month_index(month: Column, sep: str = DASH) -> Column:
    """Months since year 0, so that neighbouring months differ by one across year ends."""
    parts = F.split(month, f"[{sep}]")
    return parts[0].cast("int") * 12 + parts[1].cast("int")


def _index(month: str, sep: str) -> int:
    year, number = month.split(sep)
    return int(year) * 12 + int(number) - 1


def shift_literal(month: str, n: int, sep: str = DOT) -> str:
    """Driver-side month arithmetic for run parameters."""
    index = _index(month, sep) + n
    return f"{index // 12:04d}{sep}{index % 12 + 1:02d}"


def trailing_months(month: str, n: int, sep: str = DOT) -> list[str]:
    """The `n` months ending in `month`, latest first."""
    return [shift_literal(month, -i, sep) for i in range(n)]


def month_end(month: str, sep: str = DOT) -> Column:
    return F.last_day(month_start(F.lit(month), sep))


def previous_month_end(month: str, sep: str = DOT) -> Column:
    return F.date_sub(month_start(F.lit(month), sep), 1)
