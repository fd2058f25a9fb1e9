"""Loan-book expressions: buckets, stages, balances, provisions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import concat_blank, nz
from ledgerloom.functions.text import after_marker

# Products left out of the reports and contract statuses left out of the load.
EXCLUDED_PRODUCTS = ("CLXMCSC2NI", "CLXSSC2NI", "CLXSSC1NI", "CLXMCSC1NI")
EXCLUDED_STATUSES = (3, 4, 201)
ACQUISITION_CODE, NON_ACQUISITION_CODE = 5, 2

RATE = "decimal(18,8)"


def bucket_suffix(dpd: Column) -> Column:
    """Days-past-due band: aboc up to 0, b001, b016, then 30-day bands b031 ... b1051, b1081 above 1080."""
    low = (F.ceil(dpd / F.lit(30)) - 1) * 30 + 1
    width = F.when(low < 1000, 3).otherwise(4)
    return (
        F.when(dpd <= 0, "aboc")
        .when(dpd <= 15, "b001")
        .when(dpd <= 30, "b016")
        .when(dpd <= 1080, F.concat(F.lit("b"), F.lpad(low.cast("string"), width, F.lit("0"))))
        .when(dpd > 1080, "b1081")
    )


def dpd_bucket(method: Column, dpd: Column) -> Column:
    """Accounting method and band, e.g. 'CD-b031'; a NULL part counts as empty text."""
    return concat_blank(method, F.lit("-"), bucket_suffix(dpd))


def bucket_rank(code: Column) -> Column:
    """Report order of a bucket: abnc 1, aboc 2, else the number after the first 'b'."""
    return (
        F.when(code.rlike("abnc"), 1)
        .when(code.rlike("aboc"), 2)
        .otherwise(after_marker(code, "b").try_cast("int"))
    )


def stage(dpd: Column, covid: Column, given: Column) -> Column:
    """Stage waterfall; a NULL `dpd` falls through to the later rules."""
    return (
        F.when(dpd > 90, "stage 3")
        .when(dpd > 30, "stage 2")
        .when(covid, "stage 2")
        .when(given.isNull(), "stage 1")
        .otherwise(given)
    )


def deterioration_stage(flag: Column) -> Column:
    return F.when(flag == 1, "stage 2").when(flag == 0, "stage 1")


def card_type(type_product: Column) -> Column:
    """CC_CLX stays, everything else (NULL too) is CC_CD."""
    return F.when(type_product == "CC_CLX", "CC_CLX").otherwise("CC_CD")


def product_type(method: Column, type_product: Column) -> Column:
    return F.when(method == "REL", card_type(type_product)).otherwise(type_product)


def rate_key(method: Column, type_product: Column, code_cross: Column) -> Column:
    """Bucket code under which the provisioning rate is stored."""
    remapped = concat_blank(card_type(type_product), F.replace(code_cross, F.lit("REL"), F.lit("")))
    return F.when(method == "REL", remapped).otherwise(code_cross)


def movement_class(pre_code: Column, pre_provision: Column, cur_provision: Column) -> Column:
    change = nz(cur_provision) - nz(pre_provision)
    return (
        F.when(pre_code.isNull(), "New_WD")
        .when(change < 0, "Recovery")
        .when(change > 0, "Additional WO")
        .otherwise("No adj")
    )


def acquisition_segment(code: Column) -> Column:
    return F.when(code == ACQUISITION_CODE, "Acquisition").when(code == NON_ACQUISITION_CODE, "Non-Acquisition")


def moved_principal(prefix: str = "amt_move_") -> Column:
    c = lambda n: F.col(f"{prefix}{n}")
    return c(481) + c(483) - c(625) + c(701) + c(716) + c(801) + c(816)


def moved_interest(prefix: str = "amt_move_") -> Column:
    return F.col(f"{prefix}702") + F.col(f"{prefix}802")


def net_balance(source: Column, added: Column, *removed: Column) -> Column:
    """source + added - removed; NULL movements count as 0, a NULL source stays NULL."""
    out = source + nz(added)
    for amount in removed:
        out = out - nz(amount)
    return out


def exposure(principal: Column, interest: Column, penalty: Column) -> Column:
    """Total exposure; NULL when any part is NULL."""
    return principal + interest + penalty


def provision(rate: Column, amount: Column) -> Column:
    return rate.cast(RATE) * amount
