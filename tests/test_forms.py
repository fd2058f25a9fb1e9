"""Form fields with gates and possessive runs against plain patterns over the whole text."""

import random
import time

from pyspark.sql import functions as F

from ledgerloom.functions import text as txt
from ledgerloom.functions.nulls import strip_thousands, tolerant
from ledgerloom.plans import forms as fm

# The fields as plain first matches (fixed values of the forms, without gates and possessive runs).
PLAIN = {
    "ma_lh": r"(?U)Mã LH[:\s]*([A-Z]{2}\d{2})",
    "num_ship_to": r"(?U)Số lượng Ship-to[:\s]*(\d+)",
    "contract_months": r"(?U)Thời hạn[:\s:]*(\d+)\s*tháng",
    "total_support_pct": r"(?sU)Tổng tỷ lệ hỗ trợ.*?([\d.]+)%",
    "hist_sales_12m": r"(?sU)DS lịch sử 12 tháng.*?([\d,]+)",
    "order_freq_month": r"(?U)(\d+)\s*lần/tháng",
    "f1_number": r"(?U)Số[:\s]*([\w/]+GV-KD-02-F1[\w/]+)",
    "effective_date": r"(?U)Ngày hiệu lực[:\s]*([\d/]+)",
}
PLAIN_TYPE = (r"(?U)Mã LH[:\s]*[A-Z]{2}\d{2}\s*[-–]\s*([A-Z]{4})", r"(?U)KA0[01]\s*[-–]\s*([A-Z]{4,6})")
PLAIN_TARGETS = r"(?U)([\d,]+)\s+([\d,]+)\s+[\d.]+%"
PLAIN_CATEGORY = r"(?mU)^\s+([A-Z])\s+"


def plain_fields(docs):
    body = F.col("text")
    first = {n: txt.first_group(body, p) for n, p in PLAIN.items()}
    year, month = (strip_thousands(c, "bigint") for c in txt.first_pair(body, PLAIN_TARGETS))
    both = year.isNotNull() & month.isNotNull()
    return docs.select(
        "filename",
        first["ma_lh"].alias("ma_lh"),
        F.coalesce(*[txt.first_group(body, p) for p in PLAIN_TYPE]).alias("loai_hinh_code"),
        *[tolerant(first[n], "int").alias(n) for n in ("num_ship_to", "contract_months", "order_freq_month")],
        F.when(both, year).alias("revenue_target_year"),
        F.when(both, month).alias("revenue_target_month"),
        tolerant(first["total_support_pct"], "double").alias("total_support_pct"),
        strip_thousands(first["hist_sales_12m"], "bigint").alias("hist_sales_12m"),
        txt.distinct_matches(body, PLAIN_CATEGORY).alias("num_categories"),
        first["f1_number"].alias("f1_number"),
        first["effective_date"].alias("effective_date"),
    )


FRAGMENTS = [
    "Mã LH", ": ", "KA01", "KA00", " - ", "–", "BVXX", "MT09", "Số lượng Ship-to", "Số", "12", "007", "Thời hạn", " tháng", "tháng", "\n", "\n\n  ",
    "1,200,000", ",", "3.5%", "%", ".", "Tổng tỷ lệ hỗ trợ", "DS lịch sử 12 tháng", "A", "  B  ", "Z\n", "lần/tháng", "4 lần/tháng", "GV-KD-02-F1", "/",
    "07/GV-KD-02-F1/2025", "Mã LH: KA01 - BVXX", "KA00 - THXX", "Thời hạn: 24 tháng", "1,200  100 3.5%", "Tổng tỷ lệ hỗ trợ 4%", "Ngày hiệu lực", "01/02/2025", "x", "ữ", "🙂", " ", "   ", "\t", "9", "٣", "Tự gia hạn", "có",
]


def test_fields_are_those_of_plain_patterns(spark):
    rng = random.Random(8)
    docs = [(f"d{i}", "".join(rng.choices(FRAGMENTS, k=rng.randint(0, 60)))) for i in range(1500)]
    far = ["Mã LH" + " " * n + "KA01 - BVXX" for n in (200, 250, 251, 252, 300)] + ["Số lượng Ship-to: " + "7" * n for n in (5, 238, 240, 500)]
    far += ["Tổng tỷ lệ hỗ trợ" + "a" * n + "12.5%" for n in (0, 250, 252, 253, 255, 256, 400)] + ["DS lịch sử 12 tháng" + "b" * n + "1,234,567 8" for n in (0, 246, 250, 255, 256, 900)]
    far += ["Số " + "a/" * n + "GV-KD-02-F1/" + "b/GV-KD-02-F1/" * 30 for n in (1, 130)] + ["Ngày hiệu lực" + ":" * 240 + "01/02/2025", "Thời hạn 9 năm. Thời hạn: 24 tháng"]
    docs += [(f"f{i}", t) for i, t in enumerate(far)] + [("none", None), ("empty", "")]
    frame = spark.createDataFrame(docs, "filename string, text string").repartition(8)
    want = {r.filename: r.asDict() for r in plain_fields(frame).collect()}
    got = {r.filename: r.asDict() for r in fm.extract_fields(frame).select(*next(iter(want.values()))).collect()}
    different = [(n, {c: (got[n][c], v) for c, v in row.items() if got[n][c] != v}) for n, row in want.items() if got[n] != row]
    assert len(want) == len(docs) and not different, different[:3]
    filled = {c: sum(r[c] is not None for r in want.values()) for c in next(iter(want.values()))}
    assert min(filled.values()) >= 10, filled


def test_long_texts_without_an_end(spark):
    """A megabyte of digits, blanks or open markers is not searched again from each of its characters."""
    texts = ["9" * 1_000_000 + " %", "1,2 " * 250_000, "Tổng tỷ lệ hỗ trợ " * 50_000, "DS lịch sử 12 tháng " * 50_000 + "x", "1.2.3." * 200_000]
    start = time.time()
    rows = fm.extract_fields(spark.createDataFrame([(f"t{i}", t) for i, t in enumerate(texts)], "filename string, text string")).collect()
    assert len(rows) == 5 and time.time() - start < 60
    got = {r.filename: r for r in rows}
    assert got["t2"].total_support_pct is None and got["t3"].hist_sales_12m == 12 and got["t4"].total_support_pct is None
