"""Customer profile from ship-to and bill-to sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as txt
from ledgerloom.functions.nulls import tolerant
from ledgerloom.operators.relational import first_value_per_key
from ledgerloom.plans.forms import account_label

KEY = "customer_number"

# Client type codes, profile words, place patterns.
CLIENT_TYPES = (
    "CQXX", "CQCD", "BVXX", "BVCD", "GKCF", "KSNH", "SATH", "SACN", "AUNH", "CBTP", "GTVC", "THSA", "THHD", "B2BL",
    "B2KM",
)
PROFILES = (
    ("BENH", "HOSPITAL"), ("VIEN", "HOSPITAL"), ("TRUONG", "SCHOOL"), ("HOC", "SCHOOL"), ("KHACH SAN", "HOTEL"),
    ("DOC HAI", "INDUSTRIAL"), ("KINH DOANH", "COMMERCIAL"),
)
PROFILE_GROUPS = ("UNKNOWN", "HOSPITAL", "SCHOOL", "HOTEL", "INDUSTRIAL", "COMMERCIAL", "OTHER")
PLACES = {
    "is_hcm": ("bill_city", "051|HỒ CHÍ MINH"),
    "is_hanoi": ("bill_city", "001|HÀ NỘI"),
    "is_south": ("bill_region", "MN|MY|MH"),
    "is_north": ("bill_region", "HN|MB"),
    "is_central": ("bill_region", "MT|MD"),
}
PAYMENT_DAYS = r"(\d+)D"


def client_type(code: Column) -> Column:
    found = txt.first_label(code, [(c, c) for c in CLIENT_TYPES], "OTHER")
    return F.when(code.isNull(), "UNKNOWN").otherwise(found)


def profile_group(profile: Column) -> Column:
    return F.when(profile.isNull(), "UNKNOWN").otherwise(txt.first_label(F.upper(profile), PROFILES, "OTHER"))


def ship_to_summary(sites: DataFrame) -> DataFrame:
    """Distinct sites, cities, districts and regions per customer, and its active sites.

    Distinct values are removed in a first aggregate keyed by customer and value, so a customer with very many
    sites is counted by many tasks.
    """
    rows = sites.filter((F.col("site_use_code") == "SHIP_TO") & F.col(KEY).isNotNull())
    return rows.groupBy(KEY).agg(
        F.countDistinct("site_use_id").alias("num_ship_to"),
        F.countDistinct("city_ter").alias("cities"),
        F.countDistinct("district_ter").alias("districts"),
        F.countDistinct("mien").alias("regions"),
        F.count_if(F.col("cust_site_status") == "A").alias("active_sites"),
    )


def bill_to_summary(sites: DataFrame, order: str = "site_use_id") -> DataFrame:
    """First non-NULL attributes (by `order`) and the largest credit limit per customer."""
    rows = sites.filter((F.col("site_use_code") == "BILL_TO") & F.col(KEY).isNotNull())
    first = {
        "bill_city": "city_ter", "bill_region": "mien", "payment_term": "payment_term", "profile_class": "profile_class",
        "category_code": "category_code",
    }
    return rows.groupBy(KEY).agg(
        *[first_value_per_key(c, order).alias(n) for n, c in first.items()],
        F.max(tolerant(F.col("credit_limit_cust_vnd"), "double")).alias("credit_limit"),
    )


def customer_profile(sites: DataFrame, channel: str = "KA") -> DataFrame:
    rows = sites.filter(F.col("sales_channel_code") == channel)
    both = ship_to_summary(rows).join(bill_to_summary(rows), KEY, "full_outer")
    places = {n: txt.matches_any(F.col(c), p).cast("int") for n, (c, p) in PLACES.items()}
    return both.withColumns(
        {
            "label": account_label(F.col("category_code")),
            "client_type": client_type(F.col("category_code")),
            "profile_grp": profile_group(F.col("profile_class")),
            **places,
            "is_national": F.coalesce((F.col("regions") >= 3).cast("int"), F.lit(0)),
            "log_credit": F.log1p(F.coalesce("credit_limit", F.lit(0.0))),
            "payment_days": tolerant(txt.first_group(F.col("payment_term"), PAYMENT_DAYS), "int"),
        }
    )


def cluster_features(profile: DataFrame) -> tuple[DataFrame, list[str]]:
    """Numeric and 0/1 columns for clustering, with the defaults for missing sides."""
    count = lambda c: F.coalesce(F.col(c), F.lit(1)).cast("double")
    rows = profile.withColumns(
        {
            "log_ship_to": F.log1p(count("num_ship_to")),
            "num_cities": count("cities"),
            "num_districts": count("districts"),
            "num_regions": count("regions"),
            "pay_days": F.coalesce("payment_days", F.lit(30)).cast("double"),
        }
    )
    rows = txt.one_hot(rows, "profile_grp", PROFILE_GROUPS, "pg")
    types = ["UNKNOWN", *CLIENT_TYPES, "OTHER"]
    rows = txt.one_hot(rows, "client_type", types, "ct")
    features = [
        "log_ship_to", "num_cities", "num_districts", "num_regions", "log_credit", "pay_days", "is_hcm", "is_hanoi",
        "is_national", "is_south", "is_north", "is_central", *[f"pg_{v}" for v in PROFILE_GROUPS], *[f"ct_{v}" for v in types],
    ]
    return rows, features
