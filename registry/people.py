"""Form, customer, profile, classification and clustering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import nulls
from ledgerloom.functions import text as txt
from ledgerloom.operators import classify as cl
from ledgerloom.operators import cluster as km
from ledgerloom.operators import profile as pf
from ledgerloom.operators.ranks import level_quantiles
from ledgerloom.operators.series import standardise
from ledgerloom.plans import bakeoff
from ledgerloom.plans import customers as cu
from ledgerloom.plans import forms as fm
from ledgerloom.session import cut_lineage
from ledgerloom.sources import sinks
from ledgerloom.sources.tables import split_empty_documents
from registry.analogues import Tables
from registry.common import query, r, scratch
from registry.model_sql import logistic, t_tail

FORM_COLS = """filename, ma_lh, label, loai_hinh_code, num_ship_to::BIGINT AS num_ship_to, contract_months::BIGINT AS contract_months, auto_renew, revenue_target_year, revenue_target_month,
  total_support_pct, hist_sales_12m, num_categories::BIGINT AS num_categories, product_groups, num_product_groups::BIGINT AS num_product_groups, geo_coverage, order_freq_month::BIGINT AS order_freq_month, f1_number, effective_date"""
POST_MEASURES = ["view_count", "like_count", "share_count", "download_count"]
STAFF = ["last_evaluation", "number_project", "average_monthly_hours", "satisfaction_level", "tenure", "work_accident", "promotion"]


def forms(t: Tables):
    readable, _ = split_empty_documents(t.form_text())
    return fm.extract_fields(readable)


def saved_forms(t: Tables):
    """The extracted fields, written once and read back."""
    return sinks.reuse_or_build(t.spark, f"{scratch(t.spark)}/forms", lambda: forms(t))


# --- documents --------------------------------------------------------------------------------------------------


@query(
    "src05_document_scan",
    "SELECT 'readable' AS state, count(*) AS n FROM customer WHERE c_custkey % 100 <> 99 UNION ALL SELECT 'failed', count(*) FROM customer WHERE c_custkey % 100 = 99",
)
def _(t: Tables):
    readable, failed = split_empty_documents(t.form_text())
    side = lambda df, name: df.agg(F.lit(name).alias("state"), F.count("*").alias("n"))
    return side(readable, "readable").unionByName(side(failed, "failed"))


@query("src06_reuse_saved_result", "SELECT label, count(*) AS n FROM form_fields GROUP BY 1")
def _(t: Tables):
    path = f"{scratch(t.spark)}/forms"

    def never():
        raise AssertionError("the saved result was not used")

    inputs, parameters = [f"{t.folder}/customer.parquet", f"{t.folder}/orders.parquet"], {"fields": list(fm.NUMERIC)}
    sinks.reuse_or_build(t.spark, path, lambda: forms(t), inputs, parameters)
    return pf.frequencies(sinks.reuse_or_build(t.spark, path, never, inputs, parameters), "label")


@query("src06_rebuilt_when_stale", "SELECT label, count(*) AS n FROM form_fields WHERE label IS NOT NULL GROUP BY 1")
def _(t: Tables):
    path, inputs = f"{scratch(t.spark)}/forms", [f"{t.folder}/customer.parquet", f"{t.folder}/orders.parquet"]
    sinks.reuse_or_build(t.spark, path, lambda: forms(t), inputs, {"labelled": False})
    kept = sinks.reuse_or_build(t.spark, path, lambda: forms(t).filter("label IS NOT NULL"), inputs, {"labelled": True})
    return pf.frequencies(kept, "label")


@query("snk02_review_extract", "SELECT filename, f1_number, effective_date, loai_hinh_code, '' AS ma_lh_input, '' AS label_input FROM form_fields WHERE label IS NULL")
def _(t: Tables):
    return sinks.review_extract(forms(t), "label", ["filename", "f1_number", "effective_date", "loai_hinh_code"], ["ma_lh_input", "label_input"])


@query("flt13_label_split", "SELECT CASE WHEN label IN ('KAC', 'KAM') THEN 'labelled' WHEN label IS NULL THEN 'unlabelled' ELSE 'other' END AS part, count(*) AS n FROM form_fields GROUP BY 1")
def _(t: Tables):
    rows = forms(t)
    part = F.when(F.col("label").isin("KAC", "KAM"), "labelled").when(F.col("label").isNull(), "unlabelled").otherwise("other")
    return rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))


@query("sc03_replace_and_strip", "SELECT period, round(CAST(amount AS DOUBLE), 4) AS amount FROM mkt_ledger")
def _(t: Tables):
    return t.mkt_ledger().select("period", nulls.strip_thousands(F.col("value"), "decimal(18,2)").alias("amount"))


@query("sc04_regex_contains", "SELECT doc_id, regexp_matches(upper(text), 'THE|QUE|DER') AS hit, contains(upper(text), 'ION') AS has_ion FROM documents")
def _(t: Tables):
    return t("documents").select(
        "doc_id", txt.matches_any(F.col("text"), "THE|QUE|DER").alias("hit"), F.contains(F.upper("text"), F.lit("ION")).alias("has_ion")
    )


@query("sc05_first_capture", r"SELECT doc_id, nullif(regexp_extract(text, '([A-Z][a-z]+)\. ([A-Z][a-z]+)', 1), '') AS before_stop, nullif(regexp_extract(text, '(?i)\b(th[a-z]+)', 1), '') AS first_th FROM documents")
def _(t: Tables):
    text = F.col("text")
    return t("documents").select(
        "doc_id", txt.first_group(text, r"([A-Z][a-z]+)\. ([A-Z][a-z]+)").alias("before_stop"), txt.first_group(text, r"(?i)\b(th[a-z]+)").alias("first_th")
    )


@query("sc06_find_all_first_pair", "SELECT filename, revenue_target_year AS year_target, revenue_target_month AS month_target FROM form_fields")
def _(t: Tables):
    readable, _ = split_empty_documents(t.form_text())
    year, month = fm.revenue_targets(F.col("text"))
    return readable.select("filename", year.alias("year_target"), month.alias("month_target"))


WORDS = ("the", "and", "ion", "que", "der", "zzz")


@query("sc07_keyword_membership", f"SELECT doc_id, array_to_string(hits, '|') AS words, len(hits) AS n_words FROM (SELECT doc_id, list_filter({list(WORDS)}, lambda w: contains(text, w)) AS hits FROM documents)")
def _(t: Tables):
    hits = txt.keywords_in(F.col("text"), WORDS)
    return t("documents").select("doc_id", F.array_join(hits, "|").alias("words"), F.size(hits).alias("n_words"))


@query("sc17_one_hot", "SELECT doc_id, " + ", ".join(f"CAST(coalesce(lang = '{v}', false) AS BIGINT) AS lang_{v}" for v in ("en", "fr", "de", "es")) + " FROM documents")
def _(t: Tables):
    return txt.one_hot(t("documents").select("doc_id", "lang"), "lang", ["en", "fr", "de", "es"], "lang").drop("lang")


@query("sc18_text_length", "SELECT doc_id, length(text) AS text_length FROM documents")
def _(t: Tables):
    return t("documents").select("doc_id", F.length("text").alias("text_length"))


@query("sc19_coverage_cascade", "SELECT filename, geo_coverage FROM form_fields")
def _(t: Tables):
    readable, _ = split_empty_documents(t.form_text())
    return readable.select("filename", txt.first_label(F.col("text"), fm.COVERAGE, fm.COVERAGE_DEFAULT).alias("geo_coverage"))


@query("st04_distinct_inside_document", "SELECT doc_id, nullif(len(list_distinct(regexp_extract_all(text, '([A-Z])[a-z]', 1))), 0) AS n_letters FROM documents")
def _(t: Tables):
    return t("documents").select("doc_id", txt.distinct_matches(F.col("text"), "([A-Z])[a-z]").alias("n_letters"))


@query("dp11_form_fields", f"SELECT {FORM_COLS} FROM form_fields")
def _(t: Tables):
    return forms(t)


# --- customers --------------------------------------------------------------------------------------------------

SITES = {
    "ka": "SELECT * FROM ar_site WHERE sales_channel_code = 'KA'",
    "ship": """SELECT customer_number, count(DISTINCT site_use_id) AS num_ship_to, count(DISTINCT city_ter) AS cities, count(DISTINCT district_ter) AS districts, count(DISTINCT mien) AS regions,
  count(*) FILTER (cust_site_status = 'A') AS active_sites FROM ka WHERE site_use_code = 'SHIP_TO' GROUP BY 1""",
    "bill": """SELECT customer_number, arg_min(city_ter, site_use_id) FILTER (city_ter IS NOT NULL) AS bill_city, arg_min(mien, site_use_id) FILTER (mien IS NOT NULL) AS bill_region, max(credit_limit_cust_vnd)::DOUBLE AS credit_limit,
  arg_min(payment_term, site_use_id) FILTER (payment_term IS NOT NULL) AS payment_term, arg_min(profile_class, site_use_id) FILTER (profile_class IS NOT NULL) AS profile_class,
  arg_min(category_code, site_use_id) FILTER (category_code IS NOT NULL) AS category_code FROM ka WHERE site_use_code = 'BILL_TO' GROUP BY 1""",
    "both_sides": "SELECT * FROM ship FULL JOIN bill USING (customer_number)",
    "profile": """SELECT *, CASE WHEN category_code IS NULL THEN NULL WHEN contains(category_code, 'KA01') THEN 'KAC' WHEN contains(category_code, 'KA00') THEN 'KAM' ELSE 'OTHER' END AS label,
  CASE WHEN category_code IS NULL THEN 'UNKNOWN' WHEN contains(category_code, 'CQXX') THEN 'CQXX' WHEN contains(category_code, 'BVXX') THEN 'BVXX' WHEN contains(category_code, 'GKCF') THEN 'GKCF' WHEN contains(category_code, 'B2BL') THEN 'B2BL' ELSE 'OTHER' END AS client_type,
  CASE WHEN profile_class IS NULL THEN 'UNKNOWN' WHEN upper(profile_class) LIKE '%BENH%' OR upper(profile_class) LIKE '%VIEN%' THEN 'HOSPITAL' WHEN upper(profile_class) LIKE '%TRUONG%' OR upper(profile_class) LIKE '%HOC%' THEN 'SCHOOL'
    WHEN upper(profile_class) LIKE '%KHACH SAN%' THEN 'HOTEL' WHEN upper(profile_class) LIKE '%DOC HAI%' THEN 'INDUSTRIAL' WHEN upper(profile_class) LIKE '%KINH DOANH%' THEN 'COMMERCIAL' ELSE 'OTHER' END AS profile_grp,
  coalesce(regexp_matches(bill_city, '051|HỒ CHÍ MINH'), false)::BIGINT AS is_hcm, coalesce(regexp_matches(bill_city, '001|HÀ NỘI'), false)::BIGINT AS is_hanoi,
  coalesce(regexp_matches(bill_region, 'MN|MY|MH'), false)::BIGINT AS is_south, coalesce(regexp_matches(bill_region, 'HN|MB'), false)::BIGINT AS is_north, coalesce(regexp_matches(bill_region, 'MT|MD'), false)::BIGINT AS is_central,
  coalesce(regions >= 3, false)::BIGINT AS is_national, ln(1 + coalesce(credit_limit, 0)) AS log_credit,
  CAST(nullif(regexp_extract(payment_term, '(\\d+)D', 1), '') AS BIGINT) AS payment_days FROM both_sides""".replace("\\\\", "\\"),
}


@query("ag04_distinct_counts", "SELECT customer_number, num_ship_to, cities, districts, regions FROM ship", SITES)
def _(t: Tables):
    return cu.ship_to_summary(t.ar_site().filter("sales_channel_code = 'KA'")).drop("active_sites")


@query("ag05_conditional_count", "SELECT customer_number, active_sites FROM ship", SITES)
def _(t: Tables):
    return cu.ship_to_summary(t.ar_site().filter("sales_channel_code = 'KA'")).select("customer_number", "active_sites")


@query("ag06_first_and_max", f"SELECT customer_number, bill_city, bill_region, {r('credit_limit', 'credit_limit')}, payment_term, profile_class, category_code FROM bill", SITES)
def _(t: Tables):
    return cu.bill_to_summary(t.ar_site().filter("sales_channel_code = 'KA'"))


@query("jn06_full_outer_merge", "SELECT customer_number, num_ship_to, bill_city FROM both_sides", SITES)
def _(t: Tables):
    rows = t.ar_site().filter("sales_channel_code = 'KA'")
    return cu.ship_to_summary(rows).join(cu.bill_to_summary(rows), "customer_number", "full_outer").select("customer_number", "num_ship_to", "bill_city")


@query(
    "dp12_customer_profile",
    f"SELECT customer_number, num_ship_to, cities, districts, regions, active_sites, bill_city, bill_region, {r('credit_limit', 'credit_limit')}, payment_term, profile_class, category_code, label, client_type, profile_grp, is_hcm, is_hanoi, is_south, is_north, is_central, is_national, {r('log_credit', 'log_credit')}, payment_days FROM profile",
    SITES,
)
def _(t: Tables):
    return cu.customer_profile(t.ar_site())


# --- profiles ---------------------------------------------------------------------------------------------------


@query("ag10_frequency_and_mode", "SELECT label, count(*) AS n, (SELECT arg_max(label, n) FROM (SELECT label, count(*) AS n FROM form_fields WHERE label IS NOT NULL GROUP BY 1)) AS mode_label FROM form_fields GROUP BY 1")
def _(t: Tables):
    rows = forms(t)
    return pf.frequencies(rows, "label").withColumn("mode_label", pf.modes(rows, [], "label", "m").scalar())


@query(
    "ag11_median",
    f"SELECT 'all' AS level, {r('median(l_extendedprice)', 'median_price')} FROM lineitem UNION ALL SELECT l_returnflag, {r('median(l_extendedprice)', 'median_price')} FROM lineitem GROUP BY 1",
)
def _(t: Tables):
    rows = t("lineitem")
    found = level_quantiles(rows, {"all": [], "flag": ["l_returnflag"]}, "l_extendedprice", {"median_price": 0.5})
    return found.select(F.coalesce("l_returnflag", "level").alias("level"), "median_price")


@query("ag16_group_means", "SELECT claim_status, verified_status, count(*) AS n, " + ", ".join(r(f"avg({c})", f"avg_{c}") for c in POST_MEASURES) + " FROM video_post GROUP BY 1, 2")
def _(t: Tables):
    return pf.group_means(t.video_post(), ["claim_status", "verified_status"], POST_MEASURES)


@query("ag17_binned_shares", f"SELECT claim_status, CAST(floor(duration_sec / 15) * 15 AS BIGINT) AS bin_start, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY claim_status)', 'share_pct')} FROM video_post GROUP BY 1, 2")
def _(t: Tables):
    return pf.binned_shares(t.video_post(), "claim_status", "duration_sec", 15)


@query("ag18_event_rate", f"SELECT number_project, count(*) AS n, {r('avg(left_company) * 100', 'rate_pct')} FROM employee GROUP BY 1")
def _(t: Tables):
    return pf.event_rate(t.employee(), "number_project", "left_company")


@query("ag19_pairwise_correlation", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM post_measures" for i, a in enumerate(POST_MEASURES) for b in POST_MEASURES[i + 1:]))
def _(t: Tables):
    return pf.correlations(t.post_measures(), POST_MEASURES)


@query(
    "ag20_missing_and_outliers",
    f"""SELECT s."column", n, missing, {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')}, {r('q1 - 1.5 * (q3 - q1)', 'low')}, {r('q3 + 1.5 * (q3 - q1)', 'high')},
  (SELECT count(*) FROM post_cells c WHERE c."column" = s."column" AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))) AS outliers FROM post_stats s""",
    {
        "post_cells": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM post_measures" for c in POST_MEASURES),
        "post_stats": 'SELECT "column", count(*) AS n, count(*) - count(v) AS missing, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3 FROM post_cells GROUP BY 1',
    },
)
def _(t: Tables):
    return pf.missing_profile(t.post_measures(), POST_MEASURES)


@query("so04_top_10_by_magnitude", f"SELECT c_custkey, {r('c_acctbal - 4000', 'gap', 2)} FROM customer ORDER BY abs(c_acctbal - 4000) DESC, c_custkey LIMIT 10", digits=2)
def _(t: Tables):
    gap = F.col("c_acctbal") - 4000
    return t("customer").select("c_custkey", gap.alias("gap")).orderBy(F.abs("gap").desc(), "c_custkey").limit(10)


# --- features, splits -------------------------------------------------------------------------------------------

LABELLED = {
    "lab": "SELECT * FROM form_fields WHERE label IN ('KAC', 'KAM')",
    "med": "SELECT " + ", ".join(f"median({c}) AS {c}" for c in fm.NUMERIC) + " FROM lab",
}


@query("ml14_median_imputation", "SELECT l.filename, " + ", ".join(r(f"coalesce(l.{c}, m.{c})", c) for c in fm.NUMERIC) + " FROM lab l, med m", LABELLED)
def _(t: Tables):
    return pf.fill_medians(fm.labelled(saved_forms(t)), fm.NUMERIC).select("filename", *fm.NUMERIC)


@query("ml15_standardise", "SELECT emp_id, " + ", ".join(r(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", f"{c}_z") for c in STAFF[:4]) + " FROM employee")
def _(t: Tables):
    return standardise(t.employee(), STAFF[:4]).select("emp_id", *[f"{c}_z" for c in STAFF[:4]])


GROUP_SQL = "CASE WHEN loai_hinh_code IN ('BVXX', 'BVCD') THEN 'HOSPITAL' WHEN loai_hinh_code IN ('CQXX', 'CQCD') THEN 'OFFICE' WHEN loai_hinh_code IN ('THXX', 'VCXX', 'VCDB', 'VCSA') THEN 'SCHOOL' WHEN loai_hinh_code IN ('CBTP', 'GKCF') THEN 'FOOD_MFG' WHEN loai_hinh_code IN ('SATH', 'SACN', 'GTVC', 'KSNH', 'AUNH', 'AUCH', 'AUCD') THEN 'SERVICE' ELSE 'OTHER' END"


@query(
    "ml16_feature_frame",
    "SELECT l.filename, CAST(label = 'KAC' AS BIGINT) AS target, "
    + ", ".join(r(f"coalesce(l.{c}, m.{c})", c) for c in fm.NUMERIC) + ", "
    + ", ".join(r(f"ln(1 + coalesce(l.{c}, m.{c}))", f"log_{c}") for c in fm.LOGGED) + ", "
    + ", ".join(f"CAST({GROUP_SQL} = '{g}' AS DOUBLE) AS cg_{g}" for g in [*fm.CLIENT_GROUPS, "OTHER"])
    + ", CAST(geo_coverage = 'National' AS DOUBLE) AS is_national, CAST(geo_coverage = 'HCM' AS DOUBLE) AS is_hcm, CAST(auto_renew = 'CÓ' AS DOUBLE) AS auto_renew_bin FROM lab l, med m",
    LABELLED,
)
def _(t: Tables):
    return fm.feature_frame(saved_forms(t))[0]


RANKED = {
    "ranked": "SELECT *, row_number() OVER (PARTITION BY left_company ORDER BY md5('42|' || emp_id), emp_id) AS rk, count(*) OVER (PARTITION BY left_company) AS size FROM employee",
}


@query("ml17_stratified_split", "SELECT emp_id, left_company, rk <= floor(size * 0.2::DOUBLE + 0.5) AS is_test FROM ranked", RANKED)
def _(t: Tables):
    return cl.stratified_split(t.employee(), "left_company", "emp_id").select("emp_id", "left_company", "is_test")


@query("ml18_stratified_folds", "SELECT emp_id, left_company, (rk - 1) % 5 AS fold FROM ranked", RANKED)
def _(t: Tables):
    return cl.stratified_folds(t.employee(), "left_company", "emp_id").select("emp_id", "left_company", "fold")


def staff_split(t: Tables):
    keep = t.employee().select("emp_id", "left_company", *[F.col(c).cast("double").alias(c) for c in STAFF])
    rows = cut_lineage(cl.stratified_split(keep, "left_company", "emp_id"))
    return rows.filter("NOT is_test"), rows.filter("is_test")


KEEP = ["emp_id", "left_company"]


Z = [f"z_{c}" for c in STAFF]
LOGIT = {
    **RANKED,
    "staff": "SELECT *, rk <= floor(size * 0.2::DOUBLE + 0.5) AS is_test FROM ranked",
    "staff_stats": "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in STAFF) + " FROM staff WHERE NOT is_test",
    "staff_z": "SELECT emp_id, left_company, is_test, " + ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in STAFF) + " FROM staff, staff_stats",
    "staff_train": "SELECT left_company, " + ", ".join(Z) + " FROM staff_z WHERE NOT is_test",
    **logistic("logit", "staff_train", "left_company", Z),
    "logit_scores": "SELECT emp_id, left_company, 1 / (1 + exp(-(b0 + " + " + ".join(f"w[{i + 1}] * {z}" for i, z in enumerate(Z)) + "))) AS score FROM staff_z, logit WHERE is_test",
}


CV = {
    **{n: LOGIT[n] for n in ("ranked", "staff")},
    "cv_rows": "SELECT *, (row_number() OVER (PARTITION BY left_company ORDER BY md5('42|' || emp_id), emp_id) - 1) % 5 AS fold FROM staff WHERE NOT is_test",
}
for _i in range(5):
    CV[f"cv{_i}_stats"] = "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in STAFF) + f" FROM cv_rows WHERE fold <> {_i}"
    CV[f"cv{_i}_z"] = "SELECT left_company, fold, " + ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in STAFF) + f" FROM cv_rows JOIN cv{_i}_stats ON true"
    CV[f"cv{_i}_train"] = "SELECT left_company, " + ", ".join(Z) + f" FROM cv{_i}_z WHERE fold <> {_i}"
    CV.update(logistic(f"cv{_i}_fit", f"cv{_i}_train", "left_company", Z))
    CV[f"cv{_i}_scores"] = "SELECT left_company AS y, 1 / (1 + exp(-(b0 + " + " + ".join(f"w[{j + 1}] * {z}" for j, z in enumerate(Z)) + f"))) AS score FROM cv{_i}_z JOIN cv{_i}_fit ON true WHERE fold = {_i}"
    CV[f"cv{_i}_ranks"] = f"SELECT y, score, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM cv{_i}_scores"
CV["cv_folds"] = " UNION ALL ".join(
    f"SELECT '{i}' AS fold, (sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) AS auc, avg(CAST((score > 0.5) = (y = 1) AS DOUBLE)) AS accuracy FROM cv{i}_ranks"
    for i in range(5)
)


@query(
    "ml18_cross_validation",
    f"SELECT fold, {r('auc', 'auc', 3)}, {r('accuracy', 'accuracy', 3)} FROM (SELECT * FROM cv_folds UNION ALL SELECT 'mean', avg(auc), avg(accuracy) FROM cv_folds UNION ALL SELECT 'std', stddev_pop(auc), stddev_pop(accuracy) FROM cv_folds)",
    CV,
    digits=3,
)
def _(t: Tables):
    train, _ = staff_split(t)
    return cl.cross_validate(train, STAFF, "left_company", "emp_id")


@query("ml19_logistic_regression", f"SELECT emp_id, left_company, CAST(score > 0.5 AS BIGINT) AS prediction, {r('score', 'score', 3)} FROM logit_scores", LOGIT, digits=3)
def _(t: Tables):
    train, test = staff_split(t)
    model, scaler = cl.logistic(train, STAFF, "left_company")
    return cl.predict(model, test, STAFF, KEEP, scaler)


# A fixed rule stands in for a model where the report itself is checked.
RULE = {
    "rule": """SELECT emp_id, left_company AS y, CASE WHEN number_project >= 6 OR tenure <= 4 THEN 1 ELSE 0 END AS prediction, CASE WHEN average_monthly_hours > 175 THEN 1 ELSE 0 END AS other,
  number_project * 10 - tenure AS score FROM employee""",
    "ranks": "SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM rule",
}


def auc_sql() -> str:
    return "(SELECT (sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)) FROM ranks)"


def report_sql(pred: str, head: str = "") -> str:
    cells = f"SELECT count(*) FILTER (y = 1 AND {pred} = 1) AS tp, count(*) FILTER (y = 0 AND {pred} = 1) AS fp, count(*) FILTER (y = 1 AND {pred} = 0) AS fn, count(*) FILTER (y = 0 AND {pred} = 0) AS tn FROM rule"
    return f"""SELECT {head} tp, fp, fn, tn, {r('tp / (tp + fp)', 'precision_1')}, {r('tp / (tp + fn)', 'recall_1')}, {r('2 * tp / (2 * tp + fp + fn)', 'f1_1')}, tp + fn AS support_1,
  {r('tn / (tn + fn)', 'precision_0')}, {r('tn / (tn + fp)', 'recall_0')}, {r('2 * tn / (2 * tn + fp + fn)', 'f1_0')}, tn + fp AS support_0, {r('(tp + tn) / (tp + fp + fn + tn)', 'accuracy')}"""  + "{auc} FROM (" + cells + ")"


def rule_rows(t: Tables):
    flag = lambda c: c.cast("int")
    return t.employee().select(
        "emp_id", "left_company",
        flag((F.col("number_project") >= 6) | (F.col("tenure") <= 4)).alias("prediction"),
        flag(F.col("average_monthly_hours") > 175).alias("other"),
        (F.col("number_project") * 10 - F.col("tenure")).cast("double").alias("score"),
    )


@query("ml20_binary_report", report_sql("prediction").replace("{auc}", f", {r(auc_sql(), 'auc')}"), RULE)
def _(t: Tables):
    return cl.binary_report(rule_rows(t), "left_company", score="score")


@query("ml21_coefficient_table", " UNION ALL ".join(f"SELECT '{c}' AS feature, {r(f'w[{i + 1}]', 'coefficient', 3)} FROM logit" for i, c in enumerate(STAFF)), LOGIT, digits=3)
def _(t: Tables):
    train, _ = staff_split(t)
    model, _ = cl.logistic(train, STAFF, "left_company")
    return cl.coefficient_table(train, model, STAFF).limit(10)


@query("ml22_random_forest")
def _(t: Tables):
    train, test = staff_split(t)
    return cl.predict(cl.forest(train, STAFF, "left_company"), test, STAFF, KEEP)


@query("ml23_model_agreement", f"SELECT count(*) AS n, {r('avg(CAST(prediction = other AS DOUBLE))', 'agreement')} FROM rule", RULE)
def _(t: Tables):
    rows = rule_rows(t)
    return cl.agreement(rows, rows.select("emp_id", F.col("other").alias("prediction")), "emp_id")


@query("ml24_decision_tree")
def _(t: Tables):
    train, test = staff_split(t)
    return cl.predict(cl.tree(train, STAFF, "left_company"), test, STAFF, KEEP)


@query("ml25_boosted_trees")
def _(t: Tables):
    train, test = staff_split(t)
    return cl.predict(cl.boosted(train, STAFF, "left_company"), test, STAFF, KEEP)


@query("ml26_grid_search")
def _(t: Tables):
    train, _ = staff_split(t)
    return cl.grid_search(train, STAFF, "left_company", "emp_id")


@query("ml27_feature_importance")
def _(t: Tables):
    train, _ = staff_split(t)
    return cl.importance_table(train, cl.forest(train, STAFF, "left_company"), STAFF)


@query(
    "ml28_two_sample_t_test",
    f"""SELECT n1, n2, {r('m1', 'mean1')}, {r('m2', 'mean2')}, {r('tp', 't_pooled')}, {r('dp', 'dof_pooled')}, {r('tw', 't_welch')}, {r('dw', 'dof_welch')}, {r(t_tail('tp', 'dp'), 'p_pooled')}, {r(t_tail('tw', 'dw'), 'p_welch')}, {t_tail('tw', 'dw')} < 0.05 AS significant FROM tt""",
    {
        "ts": "SELECT " + ", ".join(f"count(view_count) FILTER (verified_status = '{g}') AS n{i}, avg(view_count) FILTER (verified_status = '{g}') AS m{i}, var_samp(view_count) FILTER (verified_status = '{g}') AS v{i}" for i, g in ((1, "verified"), (2, "not verified"))) + " FROM video_post",
        "tt": """SELECT *, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0 / n1 + 1.0 / n2)) AS tp, CAST(n1 + n2 - 2 AS DOUBLE) AS dp, (m1 - m2) / sqrt(v1 / n1 + v2 / n2) AS tw,
  pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)) AS dw FROM ts""",
    },
)
def _(t: Tables):
    return pf.t_test(t.video_post(), "verified_status", "verified", "not verified", "view_count")


@query(
    "ml29_upsample_minority",
    """SELECT emp_id, left_company, c AS copy FROM (SELECT *, (SELECT max(size) FROM ranked) AS target FROM ranked) , LATERAL (SELECT unnest(range(1, target // size + CASE WHEN rk <= target % size THEN 2 ELSE 1 END)) AS c)""",
    RANKED,
)
def _(t: Tables):
    return cl.upsample_minority(t.employee(), "left_company", "emp_id").select("emp_id", "left_company", "copy")


COLLINEAR = ["view_count", "like_count", "share_count", "duration_sec"]


@query(
    "ml30_drop_collinear",
    """SELECT f AS feature FROM (SELECT true AS k1, abs(vl) <= 0.8 AS k2, abs(vs) <= 0.8 AND (abs(vl) > 0.8 OR abs(ls) <= 0.8) AS k3, vd, ld, sd FROM c4), LATERAL (SELECT unnest(['view_count', 'like_count', 'share_count', 'duration_sec']) AS f)
  WHERE CASE f WHEN 'view_count' THEN k1 WHEN 'like_count' THEN k2 WHEN 'share_count' THEN k3 ELSE abs(vd) <= 0.8 AND (NOT k2 OR abs(ld) <= 0.8) AND (NOT k3 OR abs(sd) <= 0.8) END""",
    {"c4": "SELECT corr(view_count, like_count) AS vl, corr(view_count, share_count) AS vs, corr(like_count, share_count) AS ls, corr(view_count, duration_sec) AS vd, corr(like_count, duration_sec) AS ld, corr(share_count, duration_sec) AS sd FROM post_measures"},
)
def _(t: Tables):
    kept = pf.without_collinear(t.post_measures(), COLLINEAR, 0.8)
    return t.spark.createDataFrame([(c,) for c in kept], "feature string")


@query("ml31_workload_and_tenure", "SELECT emp_id, CAST(average_monthly_hours > 175 AS BIGINT) AS overworked, CASE WHEN tenure < 2 THEN '<2' WHEN tenure < 4 THEN '2-3' WHEN tenure < 6 THEN '4-5' ELSE '6+' END AS tenure_bucket FROM employee")
def _(t: Tables):
    return t.employee().select("emp_id", pf.workload_flag(F.col("average_monthly_hours")).alias("overworked"), pf.tenure_bucket(F.col("tenure")).alias("tenure_bucket"))


@query("ml32_kmeans_sweep")
def _(t: Tables):
    rows, features = cu.cluster_features(cu.customer_profile(t.ar_site()))
    return km.sweep(rows, features, ["customer_number"])[0]


@query(
    "ml33_cluster_profile",
    f"""SELECT cluster, n, {r('pct_kac', 'pct_kac')}, {r('pct_kam', 'pct_kam')}, {r('median_num_ship_to', 'median_num_ship_to')}, {r('median_cities', 'median_cities')}, mode_profile_grp FROM
  (SELECT customer_number % 4 AS cluster, count(*) AS n, avg(CAST(coalesce(label = 'KAC', false) AS DOUBLE)) * 100 AS pct_kac, avg(CAST(coalesce(label = 'KAM', false) AS DOUBLE)) * 100 AS pct_kam, median(num_ship_to) AS median_num_ship_to, median(cities) AS median_cities FROM profile GROUP BY 1)
  JOIN (SELECT customer_number % 4 AS cluster, profile_grp AS mode_profile_grp FROM profile GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY customer_number % 4 ORDER BY count(*) DESC, profile_grp) = 1) USING (cluster)""",
    SITES,
)
def _(t: Tables):
    rows = cu.customer_profile(t.ar_site()).withColumn("cluster", F.col("customer_number") % 4)
    return km.cluster_profile(rows, "cluster", "label", ["KAC", "KAM"], ["num_ship_to", "cities"], "profile_grp")


@query(
    "ml34_model_comparison",
    report_sql("prediction", "'projects' AS model,").replace("{auc}", "") + " UNION ALL " + report_sql("other", "'hours' AS model,").replace("{auc}", ""),
    RULE,
)
def _(t: Tables):
    rows = rule_rows(t)
    return cl.model_comparison({"projects": cl.binary_report(rows, "left_company"), "hours": cl.binary_report(rows, "left_company", "other")})


@query("dp18_classifier_comparison")
def _(t: Tables):
    rows = t.employee().select("emp_id", "left_company", *[F.col(c).cast("double").alias(c) for c in STAFF])
    return bakeoff.compare_classifiers(rows, STAFF, "left_company", "emp_id")


@query("dp18_form_classifier")
def _(t: Tables):
    return bakeoff.classify_forms(saved_forms(t))["report"]
