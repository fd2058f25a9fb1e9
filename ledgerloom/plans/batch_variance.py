"""Material batch variance: valued usage, product ranking, packaging, drivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import not_prefixed, nz, safe_pct, tolerant
from ledgerloom.operators.relational import first_value_per_key, top_and_bottom

# Unit cost below which an item is left out, materiality of a product, excluded product prefix.
LOW_VALUE_THRESHOLD = 10000
MIN_PLAN_VALUE, MIN_BATCHES = 1e9, 3
EXCLUDED_PREFIX = "99"
MATERIAL_TYPES, PACKAGING_TYPE = ("RM", "SM"), "PM"


def unit_cost(items: DataFrame) -> DataFrame:
    """Mean cost per item, description and type over all periods; an unreadable cost counts as 0, a row without a key not."""
    cost = nz(tolerant(F.col("pmac"), "double"), 0.0)
    keys = ["item_no", "description", "item_type"]
    return items.dropna(subset=keys).groupBy(*keys).agg(F.avg(cost).alias("avg_pmac"))


def item_attributes(costs: DataFrame) -> DataFrame:
    """One row per item: mean of the means, and the type under the first description."""
    return costs.groupBy(F.col("item_no").alias("ingredient")).agg(
        F.avg("avg_pmac").alias("unit_cost"), first_value_per_key("item_type", "description").alias("ingredient_type")
    )


def valued_usage(usage: DataFrame, attributes: DataFrame, threshold: float = LOW_VALUE_THRESHOLD) -> DataFrame:
    """Usage of items that have a cost of at least the threshold, with plan, actual and difference values.

    Dropping items without a cost and items below the threshold makes the lookup an inner join with the kept items.
    A hot ingredient is on the usage side only; its sort-merge partition is split by AQE.
    """
    kept = attributes.filter(F.col("unit_cost") >= threshold)
    values = [(F.col(f"{n}_qty") * F.col("unit_cost")).alias(f"{n}_value") for n in ("plan", "actual", "diff")]
    return usage.join(kept, "ingredient").select("*", *values)


def factory_summary(usage: DataFrame) -> DataFrame:
    return usage.dropna(subset=["factory"]).groupBy("factory").agg(
        F.countDistinct("batch").alias("batches"),
        F.countDistinct("product_1").alias("products"),
        nz(F.sum("diff_qty")).alias("net_diff"),
        (F.avg("diff_percent") * 100).alias("avg_diff_pct"),
    )


def product_variance(valued: DataFrame) -> DataFrame:
    """Raw and semi-finished material by factory and product; a product needs both its code and description."""
    keys = ["factory", "product_1", "product_1_description"]
    rows = valued.filter(
        F.col("ingredient_type").isin(*MATERIAL_TYPES) & not_prefixed(F.col("product_1"), EXCLUDED_PREFIX)
    ).dropna(subset=keys)
    out = rows.groupBy(*keys).agg(
        nz(F.sum("plan_value"), 0.0).alias("plan_val"),
        nz(F.sum("actual_value"), 0.0).alias("actual_val"),
        nz(F.sum("diff_value"), 0.0).alias("diff_val"),
        F.countDistinct("batch").alias("batches"),
    )
    pct = safe_pct(F.col("diff_val"), F.col("plan_val"))
    return out.withColumn("variance_pct", pct).withColumn("abs_var_pct", F.abs("variance_pct"))


def material_products(
    products: DataFrame, min_plan: float = MIN_PLAN_VALUE, min_batches: int = MIN_BATCHES
) -> DataFrame:
    return products.filter((F.col("plan_val") > min_plan) & (F.col("batches") >= min_batches))


def best_and_worst(products: DataFrame, n: int = 3) -> DataFrame:
    """Smallest and largest absolute variance per factory, ties by product code and description."""
    tied = products.withColumn("_tie", F.struct("product_1", "product_1_description"))
    return top_and_bottom(tied, "factory", "abs_var_pct", "_tie", n).drop("_tie")


def packaging_summary(valued: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Packaging variance per factory, worst (most negative) first, with the display name where given."""
    out = valued.filter(F.col("ingredient_type") == PACKAGING_TYPE).dropna(subset=["factory"]).groupBy("factory").agg(
        nz(F.sum("plan_value"), 0.0).alias("plan_val"), nz(F.sum("diff_value"), 0.0).alias("diff_val")
    )
    out = out.withColumn("var_pct", safe_pct(F.col("diff_val"), F.col("plan_val")))
    if names is not None:
        out = out.join(names, "factory", "left")
    return out.orderBy("var_pct")


def worst_packaging_items(valued: DataFrame, n: int = 10) -> DataFrame:
    """The n packaging items of all factories with the lowest variance value."""
    packaging = valued.filter(F.col("ingredient_type") == PACKAGING_TYPE).dropna(subset=["factory", "ingredient"])
    out = packaging.groupBy("factory", "ingredient").agg(
        F.sum("plan_value").alias("plan_val"), F.sum("diff_value").alias("diff_val")
    )
    out = out.withColumn("var_pct", safe_pct(F.col("diff_val"), F.col("plan_val")))
    return out.orderBy("diff_val", "factory", "ingredient").limit(n)


def key_drivers(valued: DataFrame) -> DataFrame:
    """Per product: number of ingredients, and the one that moves the value furthest in the product's direction.

    Ingredients are summed first, so the second aggregate sees one row per ingredient of a product.
    """
    keys = ["factory", "product_1"]
    parts = valued.dropna(subset=keys).groupBy(*keys, "ingredient").agg(F.sum("diff_value").alias("part"))
    per = parts.groupBy(*keys).agg(
        F.sum("part").alias("diff_val"),
        F.count("*").alias("ingredients"),
        F.max_by(F.struct("ingredient", "part"), F.struct("part", "ingredient")).alias("top"),
        F.min_by(F.struct("ingredient", "part"), F.struct("part", "ingredient")).alias("bottom"),
    )
    driver = F.when(F.col("diff_val") >= 0, F.col("top")).otherwise(F.col("bottom"))
    return per.select(
        *keys, "diff_val", "ingredients", driver["ingredient"].alias("driver"), driver["part"].alias("driver_val")
    )


def direction(diff_millions: Column) -> Column:
    """OVER above 0.1 million, UNDER below -0.1 million, else ON PLAN."""
    return F.when(diff_millions > 0.1, "OVER").when(diff_millions < -0.1, "UNDER").otherwise("ON PLAN")


def shown_pct(variance_pct: Column) -> Column:
    """A variance below 0.01 % in absolute terms is shown as zero."""
    return F.when(F.abs(variance_pct) < 0.01, 0.0).otherwise(variance_pct)


def material_variance(
    usage: DataFrame,
    items: DataFrame,
    threshold: float = LOW_VALUE_THRESHOLD,
    min_plan: float = MIN_PLAN_VALUE,
    min_batches: int = MIN_BATCHES,
) -> DataFrame:
    """Material products with their rank by absolute variance inside the factory (1 = closest to plan)."""
    valued = valued_usage(usage, item_attributes(unit_cost(items)), threshold)
    order = Window.partitionBy("factory").orderBy("abs_var_pct", "product_1", "product_1_description")
    products = material_products(product_variance(valued), min_plan, min_batches)
    return products.withColumn("best_rank", F.row_number().over(order))


def packaging_variance(usage: DataFrame, items: DataFrame, threshold: float = LOW_VALUE_THRESHOLD) -> DataFrame:
    """Packaging variance per factory with its display name, worst first."""
    valued = valued_usage(usage, item_attributes(unit_cost(items)), threshold)
    names = usage.groupBy("factory").agg(F.min("factory_name").alias("name"))
    return packaging_summary(valued, names)
