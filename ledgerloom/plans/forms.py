"""Fields of free-text contract forms, and the feature frame built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as txt
from ledgerloom.functions.nulls import strip_thousands, tolerant
from ledgerloom.operators.profile import fill_medians

# Patterns of the form fields. (?U) gives \d, \s and \w their Unicode meaning, (?m) anchors at every line,
# (?iu) ignores case beyond ASCII. A run of characters that cannot end in the middle is taken whole (`++`, begun at its first
# character), so no text makes a pattern try it again from each of its characters.
CODE, SHIP, PERIOD, DATED = "Mã LH", "Số lượng Ship-to", "Thời hạn", "Ngày hiệu lực"
CHANNEL = rf"(?U){CODE}[:\s]*([A-Z]{{2}}\d{{2}})"
CLIENT_TYPE = rf"(?U){CODE}[:\s]*[A-Z]{{2}}\d{{2}}\s*[-–]\s*([A-Z]{{4}})"
CLIENT_TYPE_FALLBACK = r"(?U)KA0[01]\s*[-–]\s*([A-Z]{4,6})"
SHIP_TO = rf"(?U){SHIP}[:\s]*(\d+)"
TERM = rf"(?U){PERIOD}[:\s:]*(\d+)\s*tháng"
RENEWAL = r"(?iuU)Tự gia hạn[:\s]*(CÓ|KHÔNG)"
TARGETS = r"(?U)(?<![\d,])([\d,]++)\s++([\d,]++)\s++[\d.]++%"
SUPPORT, SUPPORT_SHARE = "Tổng tỷ lệ hỗ trợ", r"(?U)(?<![\d.])([\d.]++)%"
HISTORY, HISTORY_SALES = "DS lịch sử 12 tháng", r"(?U)([\d,]+)"
CATEGORY = r"(?mU)^\s++([A-Z])\s++"
PER_MONTH = "lần/tháng"
FREQUENCY = rf"(?U)(?<!\d)(\d++)\s*+{PER_MONTH}"
FORM = "GV-KD-02-F1"
NUMBER = rf"(?U)Số[:\s]*([\w/]+{FORM}[\w/]+)"
EFFECTIVE = rf"(?U){DATED}[:\s]*([\d/]+)"

# Product keywords, coverage cascade, channel labels, client groups.
PRODUCTS = (
    "STTT", "SDD", "SCA", "SCU", "Sữa bột", "Flex", "Organic", "Green Farm", "Tổ Yến", "Kem", "Kombucha",
    "Nước dừa", "Twincows",
)
COVERAGE = (("Toàn quốc", "National"), ("TP. HCM", "HCM"), ("Hà Nội", "HN"))
COVERAGE_DEFAULT = "Regional"
LABELS = (("KA01", "KAC"), ("KA00", "KAM"))
CLIENT_GROUPS = {
    "HOSPITAL": ("BVXX", "BVCD"),
    "OFFICE": ("CQXX", "CQCD"),
    "SCHOOL": ("THXX", "VCXX", "VCDB", "VCSA"),
    "FOOD_MFG": ("CBTP", "GKCF"),
    "SERVICE": ("SATH", "SACN", "GTVC", "KSNH", "AUNH", "AUCH", "AUCD"),
}
NUMERIC = (
    "num_ship_to", "contract_months", "revenue_target_year", "revenue_target_month", "total_support_pct",
    "hist_sales_12m", "num_categories", "num_product_groups", "order_freq_month",
)
LOGGED = ("revenue_target_year", "revenue_target_month", "hist_sales_12m")


def account_label(code: Column) -> Column:
    """KAC, KAM or OTHER from a channel code, NULL without one."""
    return F.when(code.isNotNull(), txt.first_label(code, LABELS, "OTHER"))


def client_type(text: Column) -> Column:
    return F.coalesce(txt.first_group(text, CLIENT_TYPE), txt.gated_group(text, "KA0", CLIENT_TYPE_FALLBACK))


def revenue_targets(text: Column) -> tuple[Column, Column]:
    """Year and month target of the first 'year month percent' line; both NULL when either is unreadable."""
    line = F.when(F.contains(text, F.lit("%")), F.regexp_extract(text, TARGETS, 0))
    year, month = (strip_thousands(c, "bigint") for c in txt.first_pair(line, TARGETS))
    both = year.isNotNull() & month.isNotNull()
    return F.when(both, year), F.when(both, month)


def extract_fields(docs: DataFrame, text: str = "text", name: str = "filename") -> DataFrame:
    """Eighteen columns per form: one projection of built-in expressions, no shuffle."""
    body = F.col(text)
    code = txt.first_group(body, CHANNEL)
    year, month = revenue_targets(body)
    products = txt.keywords_in(body, PRODUCTS)
    number = lambda found: tolerant(found, "int")
    return docs.select(
        F.col(name).alias("filename"),
        code.alias("ma_lh"),
        account_label(code).alias("label"),
        client_type(body).alias("loai_hinh_code"),
        number(txt.first_group(body, SHIP_TO)).alias("num_ship_to"),
        number(txt.first_group(body, TERM)).alias("contract_months"),
        F.upper(txt.first_group(body, RENEWAL)).alias("auto_renew"),
        year.alias("revenue_target_year"),
        month.alias("revenue_target_month"),
        tolerant(txt.group_behind(body, SUPPORT, SUPPORT_SHARE), "double").alias("total_support_pct"),
        strip_thousands(txt.group_behind(body, HISTORY, HISTORY_SALES), "bigint").alias("hist_sales_12m"),
        txt.distinct_matches(body, CATEGORY).alias("num_categories"),
        F.when(F.size(products) > 0, F.array_join(products, "|")).alias("product_groups"),
        F.size(products).alias("num_product_groups"),
        txt.first_label(body, COVERAGE, COVERAGE_DEFAULT).alias("geo_coverage"),
        number(txt.gated_group(body, PER_MONTH, FREQUENCY)).alias("order_freq_month"),
        txt.gated_group(body, FORM, NUMBER).alias("f1_number"),
        txt.first_group(body, EFFECTIVE).alias("effective_date"),
    )


def labelled(forms: DataFrame, labels: Sequence[str] = ("KAC", "KAM")) -> DataFrame:
    return forms.filter(F.col("label").isin(*labels))


def client_group(code: Column) -> Column:
    return txt.code_group(F.coalesce(code, F.lit("UNKNOWN")), CLIENT_GROUPS)


def feature_frame(
    forms: DataFrame, medians_from: DataFrame | None = None, key: str = "filename", keep: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """(key, target, kept columns, features) of the labelled forms and the list of feature columns.

    Medians come from `medians_from` (the training rows), or from all labelled rows when none are given.
    """
    rows = labelled(forms)
    source = rows if medians_from is None else labelled(medians_from)
    rows = fill_medians(rows, NUMERIC, source)
    rows = rows.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in LOGGED})
    rows = rows.withColumn("client_group", client_group(F.col("loai_hinh_code")))
    levels = [*CLIENT_GROUPS, "OTHER"]
    rows = txt.one_hot(rows, "client_group", levels, "cg")
    rows = rows.withColumns(
        {
            "is_national": (F.col("geo_coverage") == "National").cast("int"),
            "is_hcm": (F.col("geo_coverage") == "HCM").cast("int"),
            "auto_renew_bin": F.coalesce((F.col("auto_renew") == "CÓ").cast("int"), F.lit(0)),
        }
    )
    features = [*NUMERIC, *[f"log_{c}" for c in LOGGED], *[f"cg_{v}" for v in levels], "is_national", "is_hcm", "auto_renew_bin"]
    target = (F.col("label") == "KAC").cast("int").alias("target")
    return rows.select(key, target, *keep, *[F.col(c).cast("double").alias(c) for c in features]), features
