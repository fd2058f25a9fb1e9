"""NULL defaults and tolerant casts (ANSI mode raises on a bad cast or a zero divisor)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nz(col: Column, default=0) -> Column:
    return F.coalesce(col, F.lit(default))


def concat_blank(*cols: Column) -> Column:
    """Concatenation in which a NULL part counts as an empty string."""
    return F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def nan_to_null(col: Column) -> Column:
    return F.when(~F.isnan(col), col)


def presence_flag(key: Column, present: str = "Y", absent: str = "N") -> Column:
    """Y/N from the key of an outer-joined side."""
    return F.when(key.isNull(), absent).otherwise(present)


def tolerant(col: Column, type_name: str) -> Column:
    """Cast, NULL where the text does not fit."""
    return col.try_cast(type_name)


def strip_thousands(col: Column, type_name: str = "double") -> Column:
    """Number from text with thousands separators and outer blanks."""
    return tolerant(F.regexp_replace(F.trim(col), ",", ""), type_name)


def tolerant_timestamp(col: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def not_prefixed(col: Column, prefix: str) -> Column:
    """True unless the text starts with `prefix`; NULL counts as not prefixed."""
    return ~F.coalesce(F.startswith(col, F.lit(prefix)), F.lit(False))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, NULL on a zero or NULL divisor."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def safe_pct(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100
