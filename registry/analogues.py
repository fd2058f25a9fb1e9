"""Input tables of the plans, derived with Spark from the driver tables (see FIXTURES.md, part B)."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import credit
from ledgerloom.functions.periods import DASH, DOT, month_text
from ledgerloom.sources.tables import warehouse_table

# Report months of the loan analogue; write-downs count from the cutoff on.
CURRENT, PRIOR = "1997.07", "1997.06"
WRITE_DOWN_FROM, WRITE_DOWN_AFTER = "1995.07", "1995.06"

METHODS = {"BUILDING": "CD", "FURNITURE": "CL", "HOUSEHOLD": "CLW", "AUTOMOBILE": "TW", "MACHINERY": "REL"}
MOVES = (481, 483, 625, 701, 702, 716, 801)
RATE_PREFIXES = ("CD", "CL", "CLW", "TW", "RM", "CC_CLX", "CC_CD")


def money(col: str | Column, precision: int = 18, scale: int = 2) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal({precision},{scale})")


def dec(text: str) -> Column:
    """Exact decimal literal."""
    scale = len(text.split(".")[1])
    return F.lit(text).cast(f"decimal({scale + 2},{scale})")


def contract_number(key: Column) -> Column:
    return F.concat(F.lit("C"), F.lpad(key.cast("string"), 10, "0"))


def once(method):
    """Build the frame of a derived table once per `Tables`, so that a query analyses it only once."""

    @wraps(method)
    def built(self):
        if method.__name__ not in self._built:
            self._built[method.__name__] = method(self)
        return self._built[method.__name__]

    return built


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._built = spark, folder, {}

    def __call__(self, name: str) -> DataFrame:
        return warehouse_table(self.spark, self.folder, name)

    # --- loan book -------------------------------------------------------------------------------------------

    @once
    def contract(self) -> DataFrame:
        nation, key = F.col("c_nationkey"), F.col("c_custkey")
        method = None
        for segment, name in METHODS.items():
            rule = F.col("c_mktsegment") == segment
            method = F.when(rule, name) if method is None else method.when(rule, name)
        return self("customer").select(
            key.alias("skp_credit_case"),
            contract_number(key).alias("text_contract_number"),
            F.when(nation == 0, "RM").otherwise(method).alias("code_accounting_method"),
            F.when(nation % 7 == 6, None).when(nation % 3 == 0, "CC_CLX").when(nation % 3 == 1, "CC_CD").otherwise("CASH").alias("type_product"),
            F.when(key % 50 == 0, "CLXMCSC2NI").otherwise(F.concat(F.lit("STD"), (key % 4).cast("string"))).alias("code_product"),
            F.col("c_name").alias("name_product"),
        )

    @once
    def _accounts(self) -> DataFrame:
        """Order totals per contract and month with the contract's attributes."""
        key = F.col("skp_credit_case")
        monthly = (
            self("orders")
            .groupBy(F.col("o_custkey").alias("skp_credit_case"), month_text(F.col("o_orderdate"), DOT).alias("mo"))
            .agg(F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("p"), F.max("o_orderstatus").alias("s"))
        )
        index = F.substring("mo", 1, 4).cast("int") * 12 + F.substring("mo", 6, 2).cast("int")
        dpd = ((key * 7 + index * 31) % 1230 - 30).cast("int")
        contracts = self.contract().select("skp_credit_case", "code_accounting_method", "type_product")
        suffix = F.when(F.col("dpd") <= -15, "abnc").otherwise(credit.bucket_suffix(F.col("dpd")))
        return monthly.join(contracts, "skp_credit_case").withColumn("dpd", dpd).withColumns(
            {
                "code_cross": F.concat("code_accounting_method", F.lit("-"), suffix),
                "amt_principal": money("p", 18, 4),
                "amt_interest": money(F.col("p") * dec("0.10"), 18, 4),
                "amt_penalty": money(F.col("p") * dec("0.01"), 18, 4),
                "skp_credit_status": F.when(key % 41 == 0, None).when((F.col("s") == "P") & (key % 5 == 0), 3).otherwise(1).cast("int"),
            }
        )

    @once
    def acc_source(self) -> DataFrame:
        return self._accounts().select(
            "mo", "skp_credit_case", "code_cross", "amt_principal", "amt_interest", "amt_penalty", "dpd",
            F.greatest("dpd", F.lit(0)).alias("dpd_original"), "skp_credit_status",
        )

    @once
    def overview(self) -> DataFrame:
        key = F.col("skp_credit_case")
        pre = credit.bucket_suffix(F.col("dpd") - 31)
        return self._accounts().select(
            "mo",
            "skp_credit_case",
            "code_cross",
            credit.product_type(F.col("code_accounting_method"), F.col("type_product")).alias("type_product"),
            F.col("amt_principal").alias("amt_principal_outstanding"),
            "amt_interest",
            F.when(key % 97 == 0, None).otherwise(F.col("amt_penalty")).alias("amt_penalty"),
            "dpd",
            F.when(key % 6 == 0, None).otherwise(F.concat("code_accounting_method", F.lit("-"), pre)).alias("code_cross_previous"),
            "skp_credit_status",
            F.when(key % 37 == 0, "N").otherwise("Y").alias("code_status"),
            F.when(F.col("dpd") > 90, "stage 3").when(F.col("dpd") > 30, "stage 2").otherwise("stage 1").alias("stage_split"),
            F.when(key % 10 == 0, "Y").otherwise("N").alias("flag_covid"),
        )

    @once
    def writeoff(self) -> DataFrame:
        """First ship month of a returned line per customer; lines are reduced to orders before the join."""
        first = self("lineitem").filter("l_returnflag = 'R'").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("d"))
        return (
            first.join(self("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("o_custkey").alias("skp_credit_case"))
            .agg(month_text(F.min("d"), DOT).alias("mo"))
        )

    @once
    def application(self) -> DataFrame:
        kind = F.col("event_type")
        return self("events").select(
            F.col("user_id").alias("skp_credit_case"),
            F.when(kind.isin("signup", "purchase"), 5).when(kind == "view", None).otherwise(2).cast("int").alias("skp_class_status_acquisition"),
            F.col("ts").alias("dtime_proposal"),
            F.when(kind == "error", "Y").otherwise("N").alias("flag_deleted"),
            "event_id",
        )

    @once
    def provisioning_rate(self) -> DataFrame:
        """Rate per bucket code and month, for the buckets and months that occur; some are left out."""
        number = F.coalesce(F.expr("try_cast(substring(suffix, 2) AS int)"), F.lit(0))
        grid = self.acc_source().select(F.split("code_cross", "-")[1].alias("suffix"), "mo").distinct()
        kept = grid.filter((number + F.substring("mo", 6, 2).cast("int")) % 7 != 0)
        prefix = F.explode(F.array(*[F.lit(p) for p in RATE_PREFIXES]))
        return kept.select("suffix", "mo", prefix.alias("prefix")).select(
            F.concat("prefix", F.lit("-"), "suffix").alias("code_cross"),
            "mo",
            (number * dec("0.0008") + dec("0.0010")).cast("decimal(9,6)").alias("rate_provisioning_stage_2_3"),
        )

    @once
    def contract_deter(self) -> DataFrame:
        key = F.col("c_custkey")
        at = lambda text: F.lit(text).cast("timestamp")
        return self("customer").select(
            key.alias("skp_credit_case"),
            (F.col("c_nationkey") % 2).alias("skp_credit_type"),
            F.when(key % 13 == 0, at("1997-05-31 08:00:00")).otherwise(at("1997-06-30 14:30:00")).alias("date_balance"),
            F.when(key % 11 == 0, None).when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("flag_deterioration"),
        )

    @once
    def covid_flag(self) -> DataFrame:
        key = F.col("c_custkey")
        at = lambda text: F.lit(text).cast("timestamp")
        return self("customer").select(
            key.alias("skp_credit_case"),
            F.when(key % 6 == 0, 1).otherwise(0).alias("flag_covid"),
            F.when(key % 4 == 0, at("1997-07-31 11:00:00")).otherwise(at("1997-07-10 00:00:00")).alias("date_application"),
        )

    @once
    def industry_covid(self) -> DataFrame:
        key = F.col("c_custkey")
        return self("customer").select(
            key.alias("skp_credit_case"),
            F.lit("1997-07-31 09:00:00").cast("timestamp").alias("date_balance"),
            F.when(key % 4 == 0, 1).otherwise(0).alias("impact_by_covid"),
        )

    @once
    def _line_amounts(self) -> DataFrame:
        owner = self("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("skp_credit_case"))
        lines = self("lineitem").select(
            "l_orderkey",
            month_text(F.col("l_shipdate"), DOT).alias("mo"),
            "l_linenumber",
            "l_returnflag",
            money("l_extendedprice").alias("amount"),
        )
        return lines.join(owner, "l_orderkey")

    @once
    def writeoff_acc(self) -> DataFrame:
        rows = self._line_amounts().filter("l_returnflag = 'R'").groupBy("skp_credit_case", "mo").agg(
            F.sum("amount").cast("decimal(18,2)").alias("a")
        )
        return rows.select(
            contract_number(F.col("skp_credit_case")).alias("text_contract_number"),
            "mo",
            money(F.col("a") * dec("0.10"), 18, 4).alias("amt_principal"),
            money(F.col("a") * dec("0.01"), 18, 4).alias("amt_interest"),
            money(F.col("a") * dec("0.001"), 18, 4).alias("amt_penalty"),
        )

    @once
    def writeoff_acc_dd(self) -> DataFrame:
        rows = self._line_amounts().filter("l_returnflag = 'A'").groupBy("skp_credit_case", "mo").agg(
            F.sum("amount").cast("decimal(18,2)").alias("a")
        )
        return rows.select(
            contract_number(F.col("skp_credit_case")).alias("text_contract_number"),
            "mo",
            *[money(F.col("a") * dec(f), 18, 4).alias(n) for n, f in (("sum_176", "0.10"), ("sum_177", "0.01"), ("sum_178", "0.001"))],
        )

    @once
    def cre_adjustment(self) -> DataFrame:
        line = lambda n: F.coalesce(F.sum(F.when(F.col("l_linenumber") == n, F.col("amount"))), F.lit(0))
        sums = [(line(i + 1).cast("decimal(18,2)") * dec("0.01")).cast("decimal(18,4)").alias(f"amt_move_{m}") for i, m in enumerate(MOVES)]
        more = [(line(n).cast("decimal(18,2)") * dec("0.001")).cast("decimal(18,4)").alias(f"amt_move_{m}") for n, m in ((2, 802), (3, 816))]
        return self._line_amounts().groupBy("mo", "skp_credit_case").agg(*sums, *more)

    # --- batches ---------------------------------------------------------------------------------------------

    @once
    def batch_usage(self) -> DataFrame:
        parts = self("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size")
        sites = self("supplier").select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") % 4).alias("f"))
        plan = money("l_quantity", 12, 2)
        change = money("l_tax", 4, 2) - money("l_discount", 4, 2)
        return self("lineitem").join(parts, "l_partkey").join(sites, "l_suppkey").select(
            F.when(F.col("l_suppkey") % 25 != 3, F.concat(F.lit("F"), F.col("f").cast("string"))).alias("factory"),
            F.concat(F.lit("Factory "), F.substring(F.lit("ABCD"), F.col("f") + 1, F.lit(1))).alias("factory_name"),
            F.col("l_orderkey").cast("string").alias("batch"),
            F.when(F.col("p_size") == 50, None).when(F.col("p_size") % 10 == 9, F.concat(F.lit("99"), "p_brand")).otherwise(F.col("p_brand")).alias("product_1"),
            F.col("p_type").alias("product_1_description"),
            F.col("l_partkey").cast("string").alias("ingredient"),
            F.col("l_shipdate").alias("start_date"),
            plan.alias("plan_qty"),
            (plan + plan * change).alias("actual_qty"),
            (plan * change).alias("diff_qty"),
            change.alias("diff_percent"),
        )

    @once
    def item_cost(self) -> DataFrame:
        """Four cost rows per part: two periods, then a renamed item (some without a description), then one with an
        unreadable cost. Parts of size 13 have no cost."""
        price = money("p_retailprice", 12, 2)
        step = F.explode(F.sequence(F.lit(0), F.lit(3)))
        rows = self("part").filter("p_size <> 13").select("*", step.alias("i"))
        kind = F.when(F.col("p_size") % 3 == 0, "RM").when(F.col("p_size") % 3 == 1, "SM").otherwise("PM")
        cost = (price + F.col("i") * dec("0.50")).cast("decimal(12,2)").cast("string")
        return rows.select(
            F.col("p_partkey").cast("string").alias("item_no"),
            F.when((F.col("i") == 2) & (F.col("p_partkey") % 6 == 1), None).when(F.col("i") < 2, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" v2"))).alias("description"),
            kind.alias("item_type"),
            F.lit("kg").alias("uom"),
            F.concat(F.lit("0"), (F.col("i") + 1).cast("string"), F.lit("-25")).alias("period_name"),
            F.when((F.col("i") == 3) & (F.col("p_partkey") % 40 == 1), "n/a").otherwise(cost).alias("pmac"),
        )

    # --- sales series ----------------------------------------------------------------------------------------

    @once
    def sales_txn(self) -> DataFrame:
        """Order totals, priorities and customers."""
        return self("orders").select(
            F.col("o_orderdate").alias("trx_date"),
            money("o_totalprice").alias("sale"),
            "o_orderpriority",
            "o_custkey",
        )

    @once
    def monthly_sales(self) -> DataFrame:
        return self.sales_txn().groupBy(month_text(F.col("trx_date")).alias("year_month")).agg(
            F.sum("sale").cast("double").alias("total_sale")
        )

    @once
    def group_sales(self) -> DataFrame:
        """Month x group totals, group = order priority."""
        return self.sales_txn().groupBy(
            month_text(F.col("trx_date")).alias("year_month"), F.col("o_orderpriority").alias("grp")
        ).agg(F.sum("sale").cast("double").alias("qty"))

    @once
    def channel_sales(self) -> DataFrame:
        """Month x channel: sales and average price, channel = market segment of the customer."""
        channel = self("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("channel"))
        return self.sales_txn().join(channel, "o_custkey").groupBy(
            month_text(F.col("trx_date")).alias("year_month"), "channel"
        ).agg(
            F.sum("sale").cast("double").alias("qty"),
            (F.sum("sale").cast("double") / F.count("*")).alias("asp"),
        )

    @once
    def macro(self) -> DataFrame:
        """Monthly regressors from the ship month: three rates, a price and two spend series."""
        month = month_text(F.col("l_shipdate"), DASH).alias("year_month")
        s = lambda c, p=18, k=2: F.sum(money(c, p, k)).cast("double")
        n = F.count("*")
        return self("lineitem").groupBy(month).agg(
            (s("l_discount") / n * 100).alias("cpi"),
            (s("l_tax") / n * 100).alias("rate"),
            (s("l_quantity") / n).alias("gdp"),
            (s("l_extendedprice") / s("l_quantity")).alias("asp"),
            (F.sum(F.when(F.col("l_returnflag") == "R", money("l_extendedprice"))).cast("double") / 1e6).alias("mkt_old"),
            (F.sum(F.when(F.col("l_linestatus") == "O", money("l_extendedprice"))).cast("double") / 1e6).alias("mkt_new"),
        )

    @once
    def mkt_ledger(self) -> DataFrame:
        """Ledger lines with their account: period 'm-yy' and amount with thousands separators, both as text."""
        day = F.col("l_shipdate")
        yy = F.lpad((F.year(day) % 100 + 20).cast("string"), 2, "0")
        number = F.when(F.col("l_linenumber") == 7, -money("l_extendedprice")).otherwise(money("l_extendedprice"))
        value = F.when(F.col("l_partkey") % 50 == 0, "-").otherwise(F.concat(F.lit(" "), F.format_number(number, 2), F.lit(" ")))
        period = F.when(F.col("l_suppkey") % 20 == 0, "total").otherwise(F.concat(F.month(day).cast("string"), F.lit("-"), yy))
        return self("lineitem").select(F.col("l_returnflag").alias("account"), period.alias("period"), value.alias("value"))

    # --- forms and customers ---------------------------------------------------------------------------------

    @once
    def customer_orders(self) -> DataFrame:
        """Order figures per customer; orders are aggregated before the join."""
        per = self("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count("*").alias("n_orders"),
            F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("sales"),
            F.count_if(F.col("o_orderstatus") == "F").alias("n_f"),
            F.countDistinct("o_orderpriority").alias("n_prio"),
            F.min("o_orderdate").alias("first_order"),
            F.max("o_orderdate").alias("last_order"),
        )
        return self("customer").join(per, "c_custkey", "left")

    @once
    def form_text(self) -> DataFrame:
        """One form per customer, its fields set from the customer's orders; fields are missing for some."""
        key, n = F.col("c_custkey"), F.coalesce("n_orders", F.lit(0))
        sales = F.coalesce(F.col("sales"), F.lit(0).cast("decimal(18,2)")).cast("decimal(18,0)").cast("bigint")
        grouped = F.format_number(sales, 0)
        codes = F.array(*[F.lit(c) for c in ("CQXX", "BVXX", "GKCF", "THXX", "SATH", "ZZZZ")])
        code = F.element_at(codes, (key % 6 + 1).cast("int"))
        channel = F.when(n % 2 == 0, "KA01").when(key % 9 == 4, "MT02").otherwise("KA00")
        part = lambda rule, *pieces: F.when(rule, F.concat(*pieces)).otherwise(F.lit(""))
        s = lambda c: c.cast("string")
        text = F.concat(
            F.lit("Số: 12/GV-KD-02-F1/"), s(key), F.lit("\n"),
            part(key % 10 != 7, F.lit("Mã LH: "), channel, F.when(key % 4 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" - "), code)), F.lit("\n")),
            part(key % 5 != 3, F.lit("Số lượng Ship-to: "), s(n), F.lit("\n")),
            part(key % 8 != 5, F.lit("Thời hạn: "), s(key % 24 + 1), F.lit(" tháng\n")),
            F.lit("Tự gia hạn: "), F.when(key % 3 == 0, "có").otherwise("KHÔNG"), F.lit("\n"),
            part(key % 11 != 2, F.lit("Doanh thu "), grouped, F.lit("  "), F.format_number((sales / 12).cast("bigint"), 0), F.lit(" 3.5%\n")),
            part(key % 7 != 6, F.lit("Tổng tỷ lệ hỗ trợ\n tối đa "), s(key % 9), F.lit("."), s(key % 10), F.lit("%\n")),
            part(key % 6 != 1, F.lit("DS lịch sử 12 tháng (VND)\n "), grouped, F.lit("\n")),
            part(key % 5 != 0, F.lit("  A  STTT\n  B  Kem\n"), F.when(key % 2 == 0, "  A  Flex\n").otherwise("  C  Organic\n")),
            F.when(key % 4 == 1, "Toàn quốc\n").when(key % 4 == 2, "TP. HCM\n").when(key % 4 == 3, "Hà Nội\n").otherwise("Cần Thơ\n"),
            part(key % 9 != 8, s(key % 8 + 1), F.lit(" lần/tháng\n")),
            F.lit("Ngày hiệu lực: "), F.date_format(F.coalesce("first_order", F.lit("1995-01-01").cast("timestamp")), "dd/MM/yyyy"), F.lit("\n"),
        )
        return self.customer_orders().select(
            F.concat(F.lit("form-"), s(key), F.lit(".txt")).alias("filename"),
            F.when(key % 100 == 99, F.lit(" \n")).otherwise(text).alias("text"),
        )

    @once
    def ar_site(self) -> DataFrame:
        """One site per order: half the orders ship, the rest bill."""
        key, cust, nation = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
        owner = self("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal")
        city = (key % 7 + nation) % 25
        site_region = F.element_at(F.array(*[F.lit(r) for r in ("MN", "MB", "MT", "HN", "MY")]), (city % 5 + 1).cast("int"))
        profile = F.element_at(F.array(*[F.lit(r) for r in ("Benh vien", "Truong hoc", "KHACH SAN", "Doc hai", "Kinh doanh", "Khac")]), (cust % 6 + 1).cast("int"))
        category = F.concat(F.when(cust % 2 == 0, "KA01-").otherwise("KA00-"), F.element_at(F.array(*[F.lit(r) for r in ("CQXX", "BVXX", "GKCF", "B2BL", "YYYY")]), (cust % 5 + 1).cast("int")))
        return self("orders").join(owner, "o_custkey").select(
            cust.alias("customer_number"),
            F.when(F.col("c_mktsegment") == "BUILDING", "MT").otherwise("KA").alias("sales_channel_code"),
            F.when(F.col("o_orderstatus") == "F", "BILL_TO").otherwise("SHIP_TO").alias("site_use_code"),
            key.alias("site_use_id"),
            F.when(city == 1, "051 HCM").when(city == 2, "001 HN").otherwise(F.concat(F.lit("T"), city.cast("string"))).alias("city_ter"),
            F.concat(F.lit("D"), (key % 40).cast("string")).alias("district_ter"),
            F.when(key % 17 == 0, None).otherwise(site_region).alias("mien"),
            F.when(key % 3 == 0, "I").otherwise("A").alias("cust_site_status"),
            F.when(F.col("c_acctbal") > 0, (money("c_acctbal") * 1000).cast("bigint")).alias("credit_limit_cust_vnd"),
            F.when(cust % 8 == 0, None).otherwise(F.concat(F.lit("NET "), (cust % 60).cast("string"), F.lit("D"))).alias("payment_term"),
            F.when(cust % 19 == 0, None).otherwise(profile).alias("profile_class"),
            F.when(cust % 23 == 0, None).otherwise(category).alias("category_code"),
        )

    @once
    def video_post(self) -> DataFrame:
        """Labelled documents: claim/opinion from the quality label, verified from the toxic label."""
        status = self("labels").select(
            "doc_id",
            F.when(F.col("quality") == 1, "claim").otherwise("opinion").alias("claim_status"),
            F.when(F.col("toxic") == 1, "not verified").otherwise("verified").alias("verified_status"),
        )
        return status.join(self.post_measures(), "doc_id")

    @once
    def post_measures(self) -> DataFrame:
        """Counts of every document."""
        words = F.size(F.split("text", r"\s+"))
        lines = F.size(F.split("text", "\n"))
        return self("documents").select(
            "doc_id",
            F.col("n_chars").alias("view_count"),
            words.cast("bigint").alias("like_count"),
            lines.cast("bigint").alias("share_count"),
            F.when(F.col("doc_id") % 13 == 0, None).otherwise(words + F.col("doc_id") % 50).cast("bigint").alias("download_count"),
            (F.col("doc_id") * 7 % 60).cast("bigint").alias("duration_sec"),
            "text",
        )

    @once
    def employee(self) -> DataFrame:
        """Customers as staff: projects from order counts, hours from order values, tenure from order dates."""
        key = F.col("c_custkey")
        n = F.coalesce("n_orders", F.lit(0)).cast("bigint")
        average = F.coalesce(F.col("sales"), F.lit(0)).cast("double") / F.greatest(n, F.lit(1))
        tenure = F.coalesce(F.datediff("last_order", "first_order"), F.lit(0))
        projects = (n % 6 + 2).cast("bigint")
        hours = (F.floor(average / 2000) % 150 + 120).cast("bigint")
        quiet = F.coalesce(F.col("last_order") < F.lit("2000-10-01").cast("timestamp"), F.lit(True))
        left = (quiet | ((projects >= 6) & (hours > 175))).cast("bigint")
        return self.customer_orders().select(
            key.alias("emp_id"),
            ((key * 37 % 100) / 100).alias("satisfaction_level"),
            (F.floor(F.col("c_acctbal") % 100) / 100).alias("last_evaluation"),
            projects.alias("number_project"),
            hours.alias("average_monthly_hours"),
            F.floor(tenure / 365).cast("bigint").alias("tenure"),
            (key % 7 == 0).cast("bigint").alias("work_accident"),
            left.alias("left_company"),
            (key % 29 == 0).cast("bigint").alias("promotion"),
            F.col("c_mktsegment").alias("department"),
            F.when(F.col("c_acctbal") < 2000, "low").when(F.col("c_acctbal") < 7000, "medium").otherwise("high").alias("salary"),
        )

    # --- ledger ----------------------------------------------------------------------------------------------

    @once
    def gl_entries(self) -> DataFrame:
        """Cost postings: unit = nation of the supplier, account segment and reason from the line, group = part type."""
        units = self("supplier").join(self("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("unit")
        )
        groups = self("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("item_group"))
        debit = money("l_extendedprice")
        return self("lineitem").join(units, "l_suppkey").join(groups, "l_partkey").select(
            "unit",
            "item_group",
            F.concat(F.lit("MH"), F.col("l_linenumber").cast("string")).alias("segment5"),
            F.col("l_returnflag").alias("category"),
            F.concat("l_returnflag", F.lit("-"), F.col("l_linenumber").cast("string")).alias("reason"),
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("effective_date"),
            debit.alias("accounted_dr"),
            (debit * money("l_discount", 4, 2)).alias("accounted_cr"),
            money("l_quantity", 12, 2).alias("qty_kg"),
            (debit * dec("1.50")).alias("revenue"),
        )
