"""Batch-variance and ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import nulls, periods
from ledgerloom.operators import relational as rel
from ledgerloom.operators import sketches
from ledgerloom.plans import batch_variance as bv
from ledgerloom.plans import ledger
from ledgerloom.sources.sinks import replace_months
from ledgerloom.sources.tables import concat_frames, csv_checked, csv_folder, csv_table, tagged_union
from registry.analogues import Tables
from registry.common import query, r, scratch

# Threshold of the driver tables: item costs run from 900 to 1001.
THRESHOLD = 910
MIN_PLAN, MIN_BATCHES = 1_000_000, 3
ITEMS = "item_no string, description string, item_type string, uom string, period_name string, pmac string"

PRODUCTS = {
    "products": """SELECT factory, product_1, product_1_description, sum(plan_value) AS plan_val, sum(actual_value) AS actual_val, sum(diff_value) AS diff_val, count(DISTINCT batch) AS batches,
  CASE WHEN sum(plan_value) <> 0 THEN sum(diff_value) / sum(plan_value) * 100 END AS variance_pct
  FROM valued WHERE ingredient_type IN ('RM', 'SM') AND product_1 NOT LIKE '99%'
  AND factory IS NOT NULL AND product_1_description IS NOT NULL GROUP BY 1, 2, 3""",
    "material": "SELECT *, abs(variance_pct) AS abs_var_pct FROM products WHERE plan_val > 1000000 AND batches >= 3",
}
PRODUCT_COLS = f"factory, product_1, product_1_description, {r('plan_val', 'plan_val', 5)}, {r('actual_val', 'actual_val', 5)}, {r('diff_val', 'diff_val', 5)}, batches, {r('variance_pct', 'variance_pct', 5)}"


def valued(t: Tables):
    return bv.valued_usage(t.batch_usage(), bv.item_attributes(bv.unit_cost(t.item_cost())), THRESHOLD)


def material(t: Tables):
    return bv.material_products(bv.product_variance(valued(t)), MIN_PLAN, MIN_BATCHES)


# --- sources ----------------------------------------------------------------------------------------------------


@query(
    "src02_csv_scan",
    f"SELECT item_type, count(*) AS n, {r('sum(try_cast(pmac AS DECIMAL(12,2)))', 'total', 2)} FROM item_cost GROUP BY 1",
    digits=2,
)
def _(t: Tables):
    path = scratch(t.spark)
    t.item_cost().write.option("header", True).mode("overwrite").csv(path)
    rows = csv_table(t.spark, path, ITEMS)
    return rows.groupBy("item_type").agg(F.count("*").alias("n"), F.sum(F.col("pmac").try_cast("decimal(12,2)")).alias("total"))


CHECKED = "item_no string, item_type string, period_name string, pmac decimal(12,2)"


@query(
    "src02_rejected_lines",
    f"""SELECT CASE WHEN bad THEN 'rejected' ELSE 'good' END AS side, count(*) AS n, {r('sum(CASE WHEN NOT bad THEN try_cast(pmac AS DECIMAL(12,2)) END)', 'total', 2)},
  CAST(sum(CASE WHEN bad THEN length(item_no) + length(item_type) + length(period_name) + 3 + length(rest) END) AS BIGINT) AS chars FROM
  (SELECT *, item_no::BIGINT % 10 IN (3, 7) OR pmac = 'n/a' AS bad, CASE item_no::BIGINT % 10 WHEN 3 THEN '' WHEN 7 THEN pmac || ',extra' ELSE pmac END AS rest FROM item_cost) GROUP BY 1""",
    digits=2,
)
def _(t: Tables):
    # lines of items ending in 3 lack the cost's comma, those ending in 7 have a field too many, some costs are unreadable
    path, key = scratch(t.spark), F.col("item_no").cast("bigint") % 10
    rest = F.when(key == 3, "").when(key == 7, F.concat(F.lit(","), "pmac", F.lit(",extra"))).otherwise(F.concat(F.lit(","), "pmac"))
    lines = t.item_cost().select(F.concat(F.concat_ws(",", "item_no", "item_type", "period_name"), rest).alias("value"))
    lines.write.text(path)
    good, bad = csv_checked(t.spark, path, CHECKED, header=False)
    side = lambda df, name, total, chars: df.agg(F.lit(name).alias("side"), F.count("*").alias("n"), total.alias("total"), chars.alias("chars"))
    none = F.lit(None)
    return side(good, "good", F.sum("pmac"), none.cast("bigint")).unionByName(
        side(bad, "rejected", none.cast("decimal(22,2)"), F.sum(F.length("line") + (F.col("item_no").cast("bigint") % 10 == 3).cast("int")))
    )


@query(
    "src03_csv_folder_scan",
    "SELECT item_no, period_name, pmac FROM item_cost",
)
def _(t: Tables):
    path = scratch(t.spark)
    rows = t.item_cost()
    # the folder also holds the same rows as JSON, which the name pattern leaves out; only kept columns are parsed
    rows.write.option("header", True).mode("overwrite").csv(f"{path}/2025")
    rows.write.mode("append").json(f"{path}/2025")
    return csv_folder(t.spark, f"{path}/2025", "part-*.csv", ITEMS, ["item_no", "period_name", "pmac"])


@query(
    "src04_tagged_sources",
    "SELECT CASE o_orderstatus WHEN 'F' THEN 'FA' ELSE 'FB' END AS factory, CASE o_orderstatus WHEN 'F' THEN 'Factory A' ELSE 'Factory B' END AS factory_name, o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS note FROM orders",
)
def _(t: Tables):
    rows = t("orders")
    parts = {
        "FA": rows.filter("o_orderstatus = 'F'").select("o_orderkey"),
        "FB": rows.filter("o_orderstatus <> 'F'").select("o_orderkey", F.col("o_orderpriority").alias("note")),
    }
    return tagged_union(parts, "factory", {"FA": "Factory A", "FB": "Factory B"})


# --- projections and filters ------------------------------------------------------------------------------------


@query(
    "prj15_valued_quantity",
    f"SELECT batch, ingredient, factory, {r('plan_value', 'plan_value', 5)}, {r('actual_value', 'actual_value', 5)}, {r('diff_value', 'diff_value', 5)} FROM valued",
    digits=5,
)
def _(t: Tables):
    return valued(t).select("batch", "ingredient", "factory", "plan_value", "actual_value", "diff_value")


@query(
    "prj16_variance_direction",
    """SELECT factory, product_1, product_1_description, CASE WHEN diff_val / 1e6 > 0.1 THEN 'OVER' WHEN diff_val / 1e6 < -0.1 THEN 'UNDER' ELSE 'ON PLAN' END AS direction,
  round(CASE WHEN abs(variance_pct) < 0.01 THEN 0.0::DOUBLE ELSE variance_pct END, 4) AS shown_pct FROM products""",
    PRODUCTS,
)
def _(t: Tables):
    return bv.product_variance(valued(t)).select(
        "factory",
        "product_1",
        "product_1_description",
        bv.direction(F.col("diff_val") / 1e6).alias("direction"),
        bv.shown_pct(F.col("variance_pct")).alias("shown_pct"),
    )


@query("flt04_in_list", "SELECT item_no, period_name, item_type FROM item_cost WHERE item_type IN ('RM', 'SM')")
def _(t: Tables):
    return t.item_cost().filter(F.col("item_type").isin("RM", "SM")).select("item_no", "period_name", "item_type")


@query("flt05_not_prefixed", "SELECT batch, ingredient, product_1 FROM batch_usage WHERE product_1 IS NULL OR NOT starts_with(product_1, '99')")
def _(t: Tables):
    return t.batch_usage().filter(nulls.not_prefixed(F.col("product_1"), "99")).select("batch", "ingredient", "product_1")


@query(
    "flt06_drop_null_rows",
    "SELECT count(*) AS n, count(DISTINCT product_1) AS products FROM batch_usage WHERE product_1 IS NOT NULL AND factory IS NOT NULL",
)
def _(t: Tables):
    rows = t.batch_usage().dropna(subset=["product_1", "factory"])
    return rows.agg(F.count("*").alias("n"), F.countDistinct("product_1").alias("products"))


@query("flt07_low_value_items", f"SELECT ingredient, {r('unit_cost', 'unit_cost')} FROM cost_map WHERE unit_cost >= 910")
def _(t: Tables):
    return bv.item_attributes(bv.unit_cost(t.item_cost())).filter(F.col("unit_cost") >= THRESHOLD).select("ingredient", "unit_cost")


@query("flt08_materiality", f"SELECT {PRODUCT_COLS} FROM material", PRODUCTS, digits=5)
def _(t: Tables):
    return material(t).drop("abs_var_pct")


# --- joins ------------------------------------------------------------------------------------------------------


@query(
    "jn11_dictionary_lookup",
    f"SELECT batch, ingredient, {r('unit_cost', 'unit_cost')}, ingredient_type FROM batch_usage LEFT JOIN cost_map USING (ingredient)",
)
def _(t: Tables):
    costs = bv.item_attributes(bv.unit_cost(t.item_cost()))
    return rel.lookup(t.batch_usage(), "ingredient", costs, "ingredient", ["unit_cost", "ingredient_type"]).select(
        "batch", "ingredient", "unit_cost", "ingredient_type"
    )


@query(
    "jn12_star_join",
    f"""SELECT n_name AS unit, p_type AS item_group, r_name AS area, {r('sum(CAST(l_extendedprice AS DECIMAL(18,2)))', 'amount', 2)}
  FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
    digits=2,
)
def _(t: Tables):
    units = t("supplier").join(t("nation").join(t("region"), F.col("r_regionkey") == F.col("n_regionkey")), F.col("n_nationkey") == F.col("s_nationkey"))
    units = units.select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("unit"), F.col("r_name").alias("area"))
    groups = t("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("item_group"))
    # postings are summed per key pair before they meet the dimensions
    facts = t("lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"))
    joined = ledger.star_join(facts, [(units, "l_suppkey"), (groups, "l_partkey")])
    return joined.groupBy("unit", "item_group", "area").agg(F.sum("amount").alias("amount"))


# --- aggregates -------------------------------------------------------------------------------------------------


# seven digits: at four or five, sums and percentages of the smallest tables lie on the edge of two roundings (2.703125), where the
# order of a sum decides
@query("ag03_sums_and_distinct_count", f"SELECT {PRODUCT_COLS.replace(', 5)', ', 7)')} FROM products", PRODUCTS, digits=7)
def _(t: Tables):
    return bv.product_variance(valued(t)).drop("abs_var_pct")


@query("ag03_mergeable_distinct_count", "SELECT factory, count(DISTINCT batch) AS batches, true AS within_error FROM batch_usage GROUP BY 1")
def _(t: Tables):
    # sketches per (month, factory) stored by month; the count over all months unites them and is held against the exact one
    path, rows = scratch(t.spark), t.batch_usage().withColumn("_period", F.date_format("start_date", "yyyy.MM"))
    sketches.reload_sketches(rows, "_period", ["factory"], ["batch"], lambda new: replace_months(new, path, "_period"))
    stored = t.spark.read.schema("factory string, sketch_batch binary, _period string").parquet(path)
    merged = sketches.merged_counts(stored, ["factory"], ["batch"]).withColumnRenamed("factory", "f")
    exact = rows.groupBy("factory").agg(F.count_distinct("batch").alias("batches"))
    gap = F.abs(F.col("approx_batch") - F.col("batches")) <= F.greatest(F.col("batches") * sketches.error_bound(), F.lit(1))
    return exact.join(merged, F.col("factory").eqNullSafe(F.col("f"))).select("factory", "batches", gap.alias("within_error"))


@query("ag07_two_level_mean", f"SELECT ingredient AS item_no, {r('unit_cost', 'unit_cost')}, ingredient_type FROM cost_map")
def _(t: Tables):
    return bv.item_attributes(bv.unit_cost(t.item_cost())).withColumnRenamed("ingredient", "item_no")


@query(
    "ag12_ratio_of_sums",
    f"SELECT factory, {r('sum(diff_qty)::DOUBLE / sum(plan_qty)::DOUBLE * 100', 'variance_pct')}, {r('abs(sum(diff_qty)::DOUBLE / sum(plan_qty)::DOUBLE * 100)', 'abs_var_pct')} FROM batch_usage GROUP BY 1",
)
def _(t: Tables):
    pct = nulls.safe_pct(F.sum("diff_qty").cast("double"), F.sum("plan_qty").cast("double"))
    return t.batch_usage().groupBy("factory").agg(pct.alias("variance_pct"), F.abs(pct).alias("abs_var_pct"))


@query(
    "ag15_factory_summary",
    f"SELECT factory, count(DISTINCT batch) AS batches, count(DISTINCT product_1) AS products, {r('sum(diff_qty)', 'net_diff')}, {r('avg(diff_percent::DOUBLE) * 100', 'avg_diff_pct')} FROM batch_usage WHERE factory IS NOT NULL GROUP BY 1",
)
def _(t: Tables):
    return bv.factory_summary(t.batch_usage().withColumn("diff_percent", F.col("diff_percent").cast("double")))


@query(
    "ag21_hierarchy_subtotals",
    f"SELECT unit, category, reason, {r('sum(dr) - sum(cr)', 'net_cost')}, CAST(grouping_id(unit, category, reason) AS BIGINT) AS level_id FROM gl_entries GROUP BY ROLLUP (unit, category, reason)",
)
def _(t: Tables):
    rows = t.gl_entries().withColumn("net_cost", F.col("accounted_dr") - F.col("accounted_cr"))
    return ledger.subtotals(rows, ["unit", "category", "reason"], "net_cost")


@query(
    "ag22_cost_per_kg",
    f"SELECT unit, {r('sum(dr) - sum(cr)', 'net_cost')}, {r('sum(qty_kg)', 'qty_kg')}, {r('(sum(dr) - sum(cr))::DOUBLE / sum(qty_kg)::DOUBLE', 'cost_per_kg')} FROM gl_entries GROUP BY 1",
)
def _(t: Tables):
    rows = t.gl_entries()
    costs = ledger.net_cost(["unit"], rows).withColumn("net_cost", F.col("net_cost").cast("double"))
    return ledger.unit_ratio(costs, rows.withColumn("qty_kg", F.col("qty_kg").cast("double")), ["unit"], "net_cost", "qty_kg", "cost_per_kg")


@query(
    "ag23_cost_pct_revenue",
    f"SELECT unit, item_group, {r('sum(dr) - sum(cr)', 'net_cost')}, {r('sum(revenue)', 'revenue')}, {r('(sum(dr) - sum(cr))::DOUBLE / sum(revenue)::DOUBLE * 100', 'cost_pct')} FROM gl_entries GROUP BY 1, 2",
)
def _(t: Tables):
    rows = t.gl_entries()
    keys = ["unit", "item_group"]
    costs = ledger.net_cost(keys, rows).withColumn("net_cost", F.col("net_cost").cast("double"))
    return ledger.unit_ratio(costs, rows.groupBy(*keys).agg(F.sum("revenue").cast("double").alias("revenue")), keys, "net_cost", "revenue", "cost_pct", percent=True)


@query(
    "ag23_material_pct_revenue",
    f"SELECT unit, {r('sum(dr) FILTER (category = ' + chr(39) + 'A' + chr(39) + ')', 'material')}, {r('sum(revenue)', 'revenue')}, {r('(sum(dr) FILTER (category = ' + chr(39) + 'A' + chr(39) + '))::DOUBLE / sum(revenue)::DOUBLE * 100', 'material_pct')} FROM gl_entries GROUP BY 1",
)
def _(t: Tables):
    rows = t.gl_entries()
    material = rows.filter("category = 'A'").groupBy("unit").agg(F.sum("accounted_dr").cast("double").alias("material"))
    revenue = rows.groupBy("unit").agg(F.sum("revenue").cast("double").alias("revenue"))
    return ledger.unit_ratio(material, revenue, ["unit"], "material", "revenue", "material_pct", percent=True)


@query(
    "ag24_ledger_net_by_month",
    f"SELECT segment5, strftime(day, '%Y-%m') AS year_month, {r('sum(dr) - sum(cr)', 'net_cost')} FROM gl_entries GROUP BY 1, 2",
)
def _(t: Tables):
    return ledger.monthly_net_cost(t.gl_entries())


# --- windows ----------------------------------------------------------------------------------------------------

MONTHLY = {
    "monthly": "SELECT unit, strftime(day, '%Y-%m') AS year_month, y, m, sum(dr) - sum(cr) AS net_cost, sum(qty_kg) AS qty_kg, sum(revenue) AS revenue FROM gl_entries GROUP BY ALL",
    "unit_years": "SELECT unit, coalesce(sum(net_cost) FILTER (y = 1999), 0) AS prior, coalesce(sum(net_cost) FILTER (y = 2000), 0) AS current FROM monthly GROUP BY 1",
}


@query(
    "wn07_year_to_date",
    f"SELECT unit, year_month, {r('net_cost', 'net_cost')}, {r('sum(net_cost) OVER (PARTITION BY unit, y ORDER BY m)', 'ytd')} FROM monthly",
    MONTHLY,
)
def _(t: Tables):
    return ledger.year_to_date(ledger.monthly_net_cost(t.gl_entries(), ["unit"]), ["unit"], "net_cost")


@query(
    "wn08_year_on_year",
    f"""SELECT c.unit, c.year_month, {r('c.net_cost', 'net_cost')}, {r('p.net_cost', 'prior_year')}, {r('c.net_cost - p.net_cost', 'yoy')},
  {r('(c.net_cost - p.net_cost)::DOUBLE / p.net_cost::DOUBLE * 100', 'yoy_pct')} FROM monthly c LEFT JOIN monthly p ON p.unit = c.unit AND p.m = c.m AND p.y = c.y - 1""",
    MONTHLY,
)
def _(t: Tables):
    rows = ledger.monthly_net_cost(t.gl_entries(), ["unit"])
    out = ledger.year_on_year(rows.withColumn("net_cost", F.col("net_cost").cast("double")), ["unit"], "net_cost")
    return out


@query(
    "wn09_share_of_total",
    f"SELECT unit, {r('sum(net_cost)', 'net_cost')}, {r('sum(net_cost)::DOUBLE / (sum(sum(net_cost)) OVER ())::DOUBLE * 100', 'share_pct')} FROM monthly GROUP BY 1",
    MONTHLY,
)
def _(t: Tables):
    rows = ledger.net_cost(["unit"], t.gl_entries()).withColumn("net_cost", F.col("net_cost").cast("double"))
    return ledger.share_of_total(rows, "net_cost")


@query(
    "wn11_variance_bridge",
    f"""SELECT 0::BIGINT AS step, 'prior' AS label, {r('sum(prior)', 'delta')}, {r('sum(prior)', 'level')} FROM unit_years
  UNION ALL SELECT 1, unit, {r('current - prior', 'delta')}, {r('(SELECT sum(prior) FROM unit_years) + sum(current - prior) OVER (ORDER BY unit)', 'level')} FROM unit_years
  UNION ALL SELECT 2, 'current', 0, {r('sum(current)', 'level')} FROM unit_years""",
    MONTHLY,
)
def _(t: Tables):
    rows = t.gl_entries().withColumn("y", F.substring("effective_date", 7, 4).cast("int"))
    net = F.col("accounted_dr") - F.col("accounted_cr")
    totals = rows.groupBy("unit").agg(
        F.sum(F.when(F.col("y") == 1999, net)).alias("prior"), F.sum(F.when(F.col("y") == 2000, net)).alias("current")
    )
    return ledger.variance_bridge(totals, "unit", "prior", "current")


# --- top-k ------------------------------------------------------------------------------------------------------


@query(
    "so03_best_and_worst_products",
    f"""SELECT {PRODUCT_COLS}, {r('abs_var_pct', 'abs_var_pct', 5)}, rank, 'best' AS side FROM
  (SELECT *, row_number() OVER (PARTITION BY factory ORDER BY abs_var_pct, product_1, product_1_description) AS rank FROM material) WHERE rank <= 3
  UNION ALL SELECT {PRODUCT_COLS}, {r('abs_var_pct', 'abs_var_pct', 5)}, rank, 'worst' FROM
  (SELECT *, row_number() OVER (PARTITION BY factory ORDER BY abs_var_pct DESC, product_1, product_1_description) AS rank FROM material) WHERE rank <= 3""",
    PRODUCTS,
    digits=5,
)
def _(t: Tables):
    return bv.best_and_worst(material(t))


PACK = f"SELECT factory, ingredient, {r('sum(plan_value)', 'plan_val', 5)}, {r('sum(diff_value)', 'diff_val', 5)}, {r('sum(diff_value) / sum(plan_value) * 100', 'var_pct', 5)} FROM valued WHERE ingredient_type = 'PM' AND factory IS NOT NULL GROUP BY 1, 2"


@query("so05_worst_packaging_items", f"{PACK} ORDER BY sum(diff_value), factory, ingredient LIMIT 10", digits=5)
def _(t: Tables):
    return bv.worst_packaging_items(valued(t))


@query(
    "so07_key_driver",
    f"""SELECT factory, product_1, {r('sum(part)', 'diff_val', 5)}, count(*) AS ingredients,
  CASE WHEN sum(part) >= 0 THEN arg_max(ingredient, part) ELSE arg_min(ingredient, part) END AS driver,
  {r('CASE WHEN sum(part) >= 0 THEN max(part) ELSE min(part) END', 'driver_val', 5)} FROM parts GROUP BY 1, 2""",
    {"parts": "SELECT factory, product_1, ingredient, sum(diff_value) AS part FROM valued WHERE product_1 IS NOT NULL AND factory IS NOT NULL GROUP BY 1, 2, 3"},
    digits=5,
)
def _(t: Tables):
    return bv.key_drivers(valued(t))


# --- sets and scalars -------------------------------------------------------------------------------------------


@query(
    "st02_concat_periods",
    "SELECT 'F' AS src, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderstatus, o_orderkey, NULL FROM orders WHERE o_orderstatus <> 'F'",
)
def _(t: Tables):
    first = t("orders").filter("o_orderstatus = 'F'").select(F.lit("F").alias("src"), "o_orderkey", "o_totalprice")
    second = t("orders").filter("o_orderstatus <> 'F'").select(F.col("o_orderstatus").alias("src"), "o_orderkey")
    return concat_frames([first, second])


@query("st03_key_difference", "SELECT batch, ingredient FROM batch_usage WHERE ingredient NOT IN (SELECT ingredient FROM cost_map WHERE unit_cost < 910)")
def _(t: Tables):
    low = bv.item_attributes(bv.unit_cost(t.item_cost())).filter(F.col("unit_cost") < THRESHOLD)
    return rel.rows_sharing_no_key(t.batch_usage(), "ingredient", low).select("batch", "ingredient")


@query("sc08_period_parsing", """SELECT period, CASE WHEN period LIKE '%-%' THEN '20' || split_part(period, '-', 2) || '-' || lpad(split_part(period, '-', 1), 2, '0') END AS year_month, left(period, 1) AS head FROM mkt_ledger""")
def _(t: Tables):
    return t.mkt_ledger().select("period", periods.parse_mm_yy(F.col("period")).alias("year_month"), F.substring("period", 1, 1).alias("head"))


@query(
    "sc10_month_parts",
    "SELECT batch, ingredient, strftime(start_date, '%m-%y') AS month_label, month(start_date) AS month_number, year(start_date) AS year_number FROM batch_usage",
)
def _(t: Tables):
    d = F.col("start_date")
    return t.batch_usage().select("batch", "ingredient", periods.month_label(d).alias("month_label"), F.month(d).alias("month_number"), F.year(d).alias("year_number"))


@query("sc15_tolerant_cast", f"SELECT item_no, period_name, {r('try_cast(pmac AS DOUBLE)', 'cost')}, CAST(try_cast(period_name AS TIMESTAMP) AS VARCHAR) AS at FROM item_cost")
def _(t: Tables):
    return t.item_cost().select(
        "item_no",
        "period_name",
        nulls.tolerant(F.col("pmac"), "double").alias("cost"),
        nulls.tolerant_timestamp(F.concat(F.col("period_name"), F.lit("?"))).alias("at"),
    )


# --- plans ------------------------------------------------------------------------------------------------------


@query(
    "dp08_material_variance",
    f"""SELECT {PRODUCT_COLS}, {r('abs_var_pct', 'abs_var_pct', 5)}, row_number() OVER (PARTITION BY factory ORDER BY abs_var_pct, product_1, product_1_description) AS best_rank FROM material""",
    PRODUCTS,
    digits=5,
)
def _(t: Tables):
    return bv.material_variance(t.batch_usage(), t.item_cost(), THRESHOLD, MIN_PLAN, MIN_BATCHES)


@query(
    "dp09_packaging_variance",
    f"""SELECT factory, {r('sum(plan_value)', 'plan_val', 2)}, {r('sum(diff_value)', 'diff_val', 2)}, {r('sum(diff_value) / sum(plan_value) * 100', 'var_pct', 2)}, min(factory_name) AS name
  FROM valued WHERE ingredient_type = 'PM' AND factory IS NOT NULL GROUP BY 1""",
    digits=2,
)
def _(t: Tables):
    return bv.packaging_variance(t.batch_usage(), t.item_cost(), THRESHOLD)


@query("dp10_unit_cost_table", f"SELECT item_no, description, item_type, {r('avg_pmac', 'avg_pmac')} FROM unit_cost")
def _(t: Tables):
    return bv.unit_cost(t.item_cost())


@query(
    "dp14_cost_pack",
    f"""SELECT c.unit, c.year_month, {r('c.net_cost', 'net_cost')}, {r('sum(c.net_cost) OVER (PARTITION BY c.unit, c.y ORDER BY c.m)', 'ytd')}, {r('c.net_cost - p.net_cost', 'yoy')},
  {r('(c.net_cost - p.net_cost)::DOUBLE / p.net_cost::DOUBLE * 100', 'yoy_pct')}, {r('c.net_cost::DOUBLE / (sum(c.net_cost) OVER (PARTITION BY c.year_month))::DOUBLE * 100', 'share_pct')},
  {r('c.net_cost::DOUBLE / c.qty_kg::DOUBLE', 'cost_per_kg')}, {r('c.net_cost::DOUBLE / c.revenue::DOUBLE * 100', 'cost_pct_revenue')}
  FROM monthly c LEFT JOIN monthly p ON p.unit = c.unit AND p.m = c.m AND p.y = c.y - 1""",
    MONTHLY,
)
def _(t: Tables):
    return ledger.cost_pack(t.gl_entries())
