"""Actual prices derived from transactions, and their use."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.scalar import discount_rate, plausible_sale, ratio
from shelfwise.operators.stats import with_group_value

PRICE_KEYS = ["item_code", "area_idnt", "day_dt"]


def price_points(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Quantity sold per item, area, day and price (payment per unit, two digits)."""
    areas = stores.select(F.col("store_id").cast("string").alias("loc_idnt"), "area_idnt")
    lines = transactions.where(plausible_sale("quantity", "amt_payment")).withColumn(
        "loc_idnt", F.col("loc_idnt").cast("string")
    )
    return (
        lines.join(areas, "loc_idnt")
        .groupBy(
            F.col("prd_id").alias("item_code"),
            "area_idnt",
            F.col("work_date").alias("day_dt"),
            F.round(ratio("amt_payment", "quantity"), 2).alias("unit_price2"),
        )
        .agg(F.sum("quantity").alias("ttl_qty"))
    )


def modal_price(points: DataFrame) -> DataFrame:
    """The price most units were sold at, per item, area and day; the lower price wins a tie."""
    return points.groupBy(*PRICE_KEYS).agg(
        F.min_by("unit_price2", F.struct(-F.col("ttl_qty"), F.col("unit_price2"))).alias("unit_price2")
    )


def mean_area_price(prices: DataFrame) -> DataFrame:
    """Mean over areas, per item and day."""
    return prices.groupBy("item_code", "day_dt").agg(F.avg("unit_price2").alias("unit_price"))


def actual_prices(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Modal price per area, averaged per item and day."""
    return mean_area_price(modal_price(price_points(transactions, stores)))


def override_price(df: DataFrame, actual: DataFrame) -> DataFrame:
    """The actual price where one is known, else the planned one."""
    joined = df.join(actual.select(*PRICE_KEYS, "unit_price2"), PRICE_KEYS, "left")
    return joined.withColumn("unit_price", F.coalesce("unit_price2", "unit_price")).drop("unit_price2")


def with_actual_price(df: DataFrame, actual: DataFrame) -> DataFrame:
    """Keeps the planned price and adds the actual one with its own discount rate."""
    joined = df.join(actual.select(*PRICE_KEYS, "unit_price2"), PRICE_KEYS, "left")
    return joined.withColumn("unit_price2", F.coalesce("unit_price2", "unit_price")).withColumn(
        "p_rate2", discount_rate("unit_price2", "retail_price")
    )


def fill_with_max_price(df: DataFrame) -> DataFrame:
    """Days without a price take the item's highest one."""
    return (
        df.transform(with_group_value, ["item_code"], F.max("unit_price"), "_max")
        .withColumn("unit_price", F.coalesce("unit_price", "_max"))
        .drop("_max")
    )
