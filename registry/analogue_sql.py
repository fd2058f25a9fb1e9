"""The same input tables in SQL, written as named WITH entries that `with_tables` puts in front of a query."""

from __future__ import annotations

import re

BUCKET = """CASE WHEN {d} <= 0 THEN 'aboc' WHEN {d} <= 15 THEN 'b001' WHEN {d} <= 30 THEN 'b016'
  WHEN {d} > 1080 THEN 'b1081' WHEN {d} IS NULL THEN NULL
  ELSE 'b' || CASE WHEN (({d} - 1) // 30) * 30 + 1 < 1000
    THEN lpad(CAST((({d} - 1) // 30) * 30 + 1 AS VARCHAR), 3, '0') ELSE CAST((({d} - 1) // 30) * 30 + 1 AS VARCHAR) END END"""


def bucket(d: str) -> str:
    return BUCKET.format(d=d)


CARD = "CASE WHEN {t} = 'CC_CLX' THEN 'CC_CLX' ELSE 'CC_CD' END"


def month(c: str, sep: str = "-") -> str:
    return f"strftime({c}, '%Y{sep}%m')"


CTES: dict[str, str] = {
    "contract": """SELECT c_custkey AS skp_credit_case, 'C' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS text_contract_number,
  CASE WHEN c_nationkey = 0 THEN 'RM' WHEN c_mktsegment = 'BUILDING' THEN 'CD' WHEN c_mktsegment = 'FURNITURE' THEN 'CL'
    WHEN c_mktsegment = 'HOUSEHOLD' THEN 'CLW' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'TW' WHEN c_mktsegment = 'MACHINERY' THEN 'REL' END AS code_accounting_method,
  CASE WHEN c_nationkey % 7 = 6 THEN NULL WHEN c_nationkey % 3 = 0 THEN 'CC_CLX' WHEN c_nationkey % 3 = 1 THEN 'CC_CD' ELSE 'CASH' END AS type_product,
  CASE WHEN c_custkey % 50 = 0 THEN 'CLXMCSC2NI' ELSE 'STD' || CAST(c_custkey % 4 AS VARCHAR) END AS code_product, c_name AS name_product
  FROM customer""",
    "acc_monthly": f"""SELECT o_custkey AS skp_credit_case, {month('o_orderdate', '.')} AS mo,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS p, max(o_orderstatus) AS s,
  CAST((o_custkey * 7 + (year(min(o_orderdate)) * 12 + month(min(o_orderdate))) * 31) % 1230 - 30 AS INT) AS dpd
  FROM orders GROUP BY 1, 2""",
    "acc_source": f"""SELECT mo, skp_credit_case, code_accounting_method || '-' || CASE WHEN dpd <= -15 THEN 'abnc' ELSE {bucket('dpd')} END AS code_cross,
  CAST(p AS DECIMAL(18,4)) AS amt_principal, CAST(p * 0.10 AS DECIMAL(18,4)) AS amt_interest, CAST(p * 0.01 AS DECIMAL(18,4)) AS amt_penalty,
  dpd, greatest(dpd, 0) AS dpd_original,
  CASE WHEN skp_credit_case % 41 = 0 THEN NULL WHEN s = 'P' AND skp_credit_case % 5 = 0 THEN 3 ELSE 1 END AS skp_credit_status
  FROM acc_monthly JOIN contract USING (skp_credit_case)""",
    "overview": f"""SELECT mo, skp_credit_case, code_cross,
  CASE WHEN code_accounting_method = 'REL' THEN {CARD.format(t='type_product')} ELSE type_product END AS type_product,
  amt_principal AS amt_principal_outstanding, amt_interest,
  CASE WHEN skp_credit_case % 97 = 0 THEN NULL ELSE amt_penalty END AS amt_penalty, dpd,
  CASE WHEN skp_credit_case % 6 = 0 THEN NULL ELSE code_accounting_method || '-' || {bucket('(dpd - 31)')} END AS code_cross_previous,
  skp_credit_status, CASE WHEN skp_credit_case % 37 = 0 THEN 'N' ELSE 'Y' END AS code_status,
  CASE WHEN dpd > 90 THEN 'stage 3' WHEN dpd > 30 THEN 'stage 2' ELSE 'stage 1' END AS stage_split,
  CASE WHEN skp_credit_case % 10 = 0 THEN 'Y' ELSE 'N' END AS flag_covid
  FROM acc_source JOIN contract USING (skp_credit_case)""",
    "writeoff": f"""SELECT o_custkey AS skp_credit_case, {month('min(l_shipdate)', '.')} AS mo
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' GROUP BY 1""",
    "application": """SELECT user_id AS skp_credit_case, CASE WHEN event_type IN ('signup','purchase') THEN 5 WHEN event_type = 'view' THEN NULL ELSE 2 END AS skp_class_status_acquisition,
  ts AS dtime_proposal, CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS flag_deleted, event_id FROM events""",
    "taxonomy": """SELECT skp_credit_case, last['c'] AS skp_class_status_acquisition FROM (
  SELECT skp_credit_case, arg_max({'c': skp_class_status_acquisition}, {'d': dtime_proposal, 'e': event_id}) AS last
  FROM application WHERE flag_deleted = 'N' GROUP BY 1)""",
    "rate_grid": """SELECT DISTINCT split_part(code_cross, '-', 2) AS suffix, mo FROM acc_source WHERE code_cross IS NOT NULL""",
    "provisioning_rate": """SELECT prefix || '-' || suffix AS code_cross, mo,
  CAST(coalesce(try_cast(substr(suffix, 2) AS INT), 0) * CAST(0.0008 AS DECIMAL(9,6)) + 0.0010 AS DECIMAL(9,6)) AS rate_provisioning_stage_2_3
  FROM rate_grid, unnest(['CD','CL','CLW','TW','RM','CC_CLX','CC_CD']) AS u(prefix)
  WHERE (coalesce(try_cast(substr(suffix, 2) AS INT), 0) + CAST(substr(mo, 6, 2) AS INT)) % 7 <> 0""",
    "contract_deter": """SELECT c_custkey AS skp_credit_case, c_nationkey % 2 AS skp_credit_type,
  CASE WHEN c_custkey % 13 = 0 THEN TIMESTAMP '1997-05-31 08:00:00' ELSE TIMESTAMP '1997-06-30 14:30:00' END AS date_balance,
  CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS flag_deterioration FROM customer""",
    "contract_stage": """SELECT skp_credit_case, skp_credit_type, CAST(date_balance AS DATE) AS date_balance,
  CASE flag_deterioration WHEN 1 THEN 'stage 2' WHEN 0 THEN 'stage 1' END AS stage_split
  FROM contract_deter WHERE CAST(date_balance AS DATE) = DATE '1997-07-01' - 1""",
    "covid_flag": """SELECT c_custkey AS skp_credit_case, CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS flag_covid,
  CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '1997-07-31 11:00:00' ELSE TIMESTAMP '1997-07-10 00:00:00' END AS date_application
  FROM customer""",
    "industry_covid": """SELECT c_custkey AS skp_credit_case, TIMESTAMP '1997-07-31 09:00:00' AS date_balance,
  CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS impact_by_covid FROM customer""",
    "line_amounts": f"""SELECT o_custkey AS skp_credit_case, {month('l_shipdate', '.')} AS mo, l_linenumber, l_returnflag,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "writeoff_acc": """SELECT 'C' || lpad(CAST(skp_credit_case AS VARCHAR), 10, '0') AS text_contract_number, mo,
  CAST(a * 0.10 AS DECIMAL(18,4)) AS amt_principal, CAST(a * 0.01 AS DECIMAL(18,4)) AS amt_interest,
  CAST(a * 0.001 AS DECIMAL(18,5))::DECIMAL(18,4) AS amt_penalty
  FROM (SELECT skp_credit_case, mo, CAST(sum(amount) AS DECIMAL(18,2)) AS a FROM line_amounts WHERE l_returnflag = 'R' GROUP BY 1, 2)""",
    "writeoff_acc_dd": """SELECT 'C' || lpad(CAST(skp_credit_case AS VARCHAR), 10, '0') AS text_contract_number, mo,
  CAST(a * 0.10 AS DECIMAL(18,4)) AS sum_176, CAST(a * 0.01 AS DECIMAL(18,4)) AS sum_177,
  CAST(a * 0.001 AS DECIMAL(18,5))::DECIMAL(18,4) AS sum_178
  FROM (SELECT skp_credit_case, mo, CAST(sum(amount) AS DECIMAL(18,2)) AS a FROM line_amounts WHERE l_returnflag = 'A' GROUP BY 1, 2)""",
    "cre_adjustment": "SELECT mo, skp_credit_case, "
    + ", ".join(
        f"CAST(CAST(coalesce(sum(amount) FILTER (l_linenumber = {i + 1}), 0) AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,4)) AS amt_move_{m}"
        for i, m in enumerate((481, 483, 625, 701, 702, 716, 801))
    )
    + ", "
    + ", ".join(
        f"CAST(CAST(CAST(coalesce(sum(amount) FILTER (l_linenumber = {n}), 0) AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,5)) AS DECIMAL(18,4)) AS amt_move_{m}"
        for n, m in ((2, 802), (3, 816))
    )
    + " FROM line_amounts GROUP BY 1, 2",
    "batch_usage": """SELECT CASE WHEN l_suppkey % 25 <> 3 THEN 'F' || CAST(s_nationkey % 4 AS VARCHAR) END AS factory, 'Factory ' || substr('ABCD', s_nationkey % 4 + 1, 1) AS factory_name,
  CAST(l_orderkey AS VARCHAR) AS batch,
  CASE WHEN p_size = 50 THEN NULL WHEN p_size % 10 = 9 THEN '99' || p_brand ELSE p_brand END AS product_1, p_type AS product_1_description,
  CAST(l_partkey AS VARCHAR) AS ingredient, l_shipdate AS start_date,
  CAST(l_quantity AS DECIMAL(12,2)) AS plan_qty,
  CAST(l_quantity AS DECIMAL(12,2)) + CAST(l_quantity AS DECIMAL(12,2)) * (CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS actual_qty,
  CAST(l_quantity AS DECIMAL(12,2)) * (CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS diff_qty,
  CAST(l_tax AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)) AS diff_percent
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""",
    "item_cost": """SELECT CAST(p_partkey AS VARCHAR) AS item_no, CASE WHEN i = 2 AND p_partkey % 6 = 1 THEN NULL WHEN i < 2 THEN p_name ELSE p_name || ' v2' END AS description,
  CASE WHEN p_size % 3 = 0 THEN 'RM' WHEN p_size % 3 = 1 THEN 'SM' ELSE 'PM' END AS item_type, 'kg' AS uom,
  '0' || CAST(i + 1 AS VARCHAR) || '-25' AS period_name,
  CASE WHEN i = 3 AND p_partkey % 40 = 1 THEN 'n/a' ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) + i * 0.50 AS DECIMAL(12,2)) AS VARCHAR) END AS pmac
  FROM part, range(0, 4) AS r(i) WHERE p_size <> 13""",
    "unit_cost": """SELECT item_no, description, item_type, avg(coalesce(try_cast(pmac AS DOUBLE), 0)) AS avg_pmac FROM item_cost
  WHERE item_no IS NOT NULL AND description IS NOT NULL AND item_type IS NOT NULL GROUP BY 1, 2, 3""",
    "cost_map": """SELECT item_no AS ingredient, avg(avg_pmac) AS unit_cost, arg_min(item_type, description) AS ingredient_type FROM unit_cost GROUP BY 1""",
    "valued": """SELECT b.*, unit_cost, ingredient_type, plan_qty::DOUBLE * unit_cost AS plan_value, actual_qty::DOUBLE * unit_cost AS actual_value, diff_qty::DOUBLE * unit_cost AS diff_value
  FROM batch_usage b JOIN cost_map USING (ingredient) WHERE unit_cost >= 910""",
    "sales_txn": """SELECT o_orderdate AS trx_date, CAST(o_totalprice AS DECIMAL(18,2)) AS sale, o_orderpriority, o_custkey
  FROM orders""",
    "monthly_sales": f"""SELECT {month('trx_date')} AS year_month, CAST(sum(sale) AS DOUBLE) AS total_sale FROM sales_txn GROUP BY 1""",
    "group_sales": f"""SELECT {month('trx_date')} AS year_month, o_orderpriority AS grp, CAST(sum(sale) AS DOUBLE) AS qty FROM sales_txn GROUP BY 1, 2""",
    "channel_sales": f"""SELECT {month('trx_date')} AS year_month, c_mktsegment AS channel, CAST(sum(sale) AS DOUBLE) AS qty,
  CAST(sum(sale) AS DOUBLE) / count(*) AS asp FROM sales_txn JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""",
    "macro": f"""SELECT {month('l_shipdate')} AS year_month, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100 AS cpi,
  CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 100 AS rate, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS gdp,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS asp,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_returnflag = 'R') AS DOUBLE) / 1e6 AS mkt_old,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (l_linestatus = 'O') AS DOUBLE) / 1e6 AS mkt_new
  FROM lineitem GROUP BY 1""",
    "mkt_ledger": """SELECT l_returnflag AS account, CASE WHEN l_suppkey % 20 = 0 THEN 'total' ELSE CAST(month(l_shipdate) AS VARCHAR) || '-' || lpad(CAST(year(l_shipdate) % 100 + 20 AS VARCHAR), 2, '0') END AS period,
  CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount
  FROM lineitem""",
    "customer_orders": """SELECT c.*, n_orders, sales, n_f, n_prio, first_order, last_order FROM customer c LEFT JOIN (
  SELECT o_custkey, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sales,
    count(*) FILTER (o_orderstatus = 'F') AS n_f, count(DISTINCT o_orderpriority) AS n_prio, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
  FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "form_fields": """SELECT 'form-' || k || '.txt' AS filename, CASE WHEN k % 10 <> 7 THEN channel END AS ma_lh,
  CASE WHEN k % 10 <> 7 THEN CASE channel WHEN 'KA01' THEN 'KAC' WHEN 'KA00' THEN 'KAM' ELSE 'OTHER' END END AS label,
  CASE WHEN k % 10 <> 7 AND k % 4 <> 0 THEN ['CQXX','BVXX','GKCF','THXX','SATH','ZZZZ'][k % 6 + 1] END AS loai_hinh_code,
  CAST(CASE WHEN k % 5 <> 3 THEN n END AS INT) AS num_ship_to, CAST(CASE WHEN k % 8 <> 5 THEN k % 24 + 1 END AS INT) AS contract_months,
  CASE WHEN k % 3 = 0 THEN 'CÓ' ELSE 'KHÔNG' END AS auto_renew,
  CASE WHEN k % 11 <> 2 THEN sales END AS revenue_target_year, CASE WHEN k % 11 <> 2 THEN sales // 12 END AS revenue_target_month,
  CAST(CASE WHEN k % 7 <> 6 THEN CAST(k % 9 AS VARCHAR) || '.' || CAST(k % 10 AS VARCHAR) END AS DOUBLE) AS total_support_pct,
  CASE WHEN k % 6 <> 1 THEN sales END AS hist_sales_12m,
  CAST(CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN 2 ELSE 3 END AS INT) AS num_categories,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN 'STTT|Flex|Kem' ELSE 'STTT|Organic|Kem' END AS product_groups,
  CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE 3 END AS INT) AS num_product_groups,
  CASE k % 4 WHEN 1 THEN 'National' WHEN 2 THEN 'HCM' WHEN 3 THEN 'HN' ELSE 'Regional' END AS geo_coverage,
  CAST(CASE WHEN k % 9 <> 8 THEN k % 8 + 1 END AS INT) AS order_freq_month,
  '12/GV-KD-02-F1/' || k AS f1_number, strftime(coalesce(first_order, TIMESTAMP '1995-01-01'), '%d/%m/%Y') AS effective_date
  FROM (SELECT c_custkey AS k, coalesce(n_orders, 0) AS n, first_order, CAST(CAST(coalesce(sales, 0) AS DECIMAL(18,0)) AS BIGINT) AS sales,
    CASE WHEN coalesce(n_orders, 0) % 2 = 0 THEN 'KA01' WHEN c_custkey % 9 = 4 THEN 'MT02' ELSE 'KA00' END AS channel FROM customer_orders) WHERE k % 100 <> 99""",
    "ar_base": """SELECT o.*, c_nationkey, c_mktsegment, c_acctbal, (o_orderkey % 7 + c_nationkey) % 25 AS city FROM orders o JOIN customer ON o_custkey = c_custkey""",
    "ar_site": """SELECT o_custkey AS customer_number, CASE WHEN c_mktsegment = 'BUILDING' THEN 'MT' ELSE 'KA' END AS sales_channel_code,
  CASE WHEN o_orderstatus = 'F' THEN 'BILL_TO' ELSE 'SHIP_TO' END AS site_use_code, o_orderkey AS site_use_id,
  CASE city WHEN 1 THEN '051 HCM' WHEN 2 THEN '001 HN' ELSE 'T' || city END AS city_ter, 'D' || (o_orderkey % 40) AS district_ter,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE ['MN','MB','MT','HN','MY'][city % 5 + 1] END AS mien,
  CASE WHEN o_orderkey % 3 = 0 THEN 'I' ELSE 'A' END AS cust_site_status,
  CASE WHEN c_acctbal > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 1000 AS BIGINT) END AS credit_limit_cust_vnd,
  CASE WHEN o_custkey % 8 = 0 THEN NULL ELSE 'NET ' || (o_custkey % 60) || 'D' END AS payment_term,
  CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE ['Benh vien','Truong hoc','KHACH SAN','Doc hai','Kinh doanh','Khac'][o_custkey % 6 + 1] END AS profile_class,
  CASE WHEN o_custkey % 23 = 0 THEN NULL ELSE CASE WHEN o_custkey % 2 = 0 THEN 'KA01-' ELSE 'KA00-' END || ['CQXX','BVXX','GKCF','B2BL','YYYY'][o_custkey % 5 + 1] END AS category_code
  FROM ar_base""",
    "video_post": """SELECT p.*, CASE WHEN quality = 1 THEN 'claim' ELSE 'opinion' END AS claim_status,
  CASE WHEN toxic = 1 THEN 'not verified' ELSE 'verified' END AS verified_status FROM post_measures p JOIN labels USING (doc_id)""",
    "post_measures": r"""SELECT doc_id, n_chars AS view_count,
  len(regexp_split_to_array(text, '\s+')) AS like_count, len(string_split(text, chr(10))) AS share_count,
  CASE WHEN doc_id % 13 = 0 THEN NULL ELSE len(regexp_split_to_array(text, '\s+')) + doc_id % 50 END AS download_count,
  doc_id * 7 % 60 AS duration_sec, text FROM documents""",
    "employee_base": """SELECT *, CAST(coalesce(n_orders, 0) % 6 + 2 AS BIGINT) AS number_project,
  CAST(floor(CAST(coalesce(sales, 0) AS DOUBLE) / greatest(coalesce(n_orders, 0), 1) / 2000) AS BIGINT) % 150 + 120 AS average_monthly_hours,
  coalesce(date_diff('day', CAST(first_order AS DATE), CAST(last_order AS DATE)), 0) AS days FROM customer_orders""",
    "employee": """SELECT c_custkey AS emp_id, (c_custkey * 37 % 100) / 100 AS satisfaction_level, floor(c_acctbal % 100) / 100 AS last_evaluation,
  number_project, average_monthly_hours, CAST(floor(days / 365) AS BIGINT) AS tenure, CAST(c_custkey % 7 = 0 AS BIGINT) AS work_accident,
  CAST(coalesce(last_order < TIMESTAMP '2000-10-01', true) OR (number_project >= 6 AND average_monthly_hours > 175) AS BIGINT) AS left_company,
  CAST(c_custkey % 29 = 0 AS BIGINT) AS promotion, c_mktsegment AS department,
  CASE WHEN c_acctbal < 2000 THEN 'low' WHEN c_acctbal < 7000 THEN 'medium' ELSE 'high' END AS salary FROM employee_base""",
    "gl_entries": """SELECT n_name AS unit, p_type AS item_group, 'MH' || l_linenumber AS segment5, l_returnflag AS category, l_returnflag || '-' || l_linenumber AS reason,
  CAST(l_shipdate AS DATE) AS day, CAST(l_extendedprice AS DECIMAL(18,2)) AS dr, CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS cr,
  CAST(l_quantity AS DECIMAL(12,2)) AS qty_kg, CAST(l_extendedprice AS DECIMAL(18,2)) * 1.50 AS revenue, year(l_shipdate) AS y, month(l_shipdate) AS m
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN part ON p_partkey = l_partkey""",
}


def with_tables(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a query with the WITH entries it names, dependencies first."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(text: str, inside: str | None) -> None:
        for name in known:
            if name != inside and name not in order and re.search(rf"\b(FROM|JOIN|UNPIVOT|,)\s+{name}\b", text):
                visit(known[name], name)
                if name not in order:
                    order.append(name)

    visit(body, None)
    if not order:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + body
