"""Sales tables: transactions to days, outlier repair, low-sales series."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.constants import LOW_SALES_START, OUTLIER_DAYS, OUTLIER_QUANTITY
from shelfwise.functions.scalar import plausible_sale, ratio, store_key
from shelfwise.operators.calendar import day_spans, dense
from shelfwise.operators.lookup import allowed_only


def daily_sales(transactions: DataFrame, channels: DataFrame, stores: DataFrame) -> DataFrame:
    """Plausible transactions of allowed channels and stores, summed per item, day and store."""
    lines = transactions.where(plausible_sale("quantity", "amt_payment")).select(
        F.col("prd_id").alias("item_code"),
        F.to_date("transaction_date").alias("day_dt"),
        store_key("deliver_storeid", "order_store", "loc_idnt").alias("store_id"),
        "channel",
        "quantity",
        "amountofsales",
        "amt_payment",
    )
    kept = lines.transform(allowed_only, channels, ["channel"]).transform(allowed_only, stores, ["store_id"])
    return kept.groupBy("item_code", "day_dt", "store_id").agg(
        F.sum("quantity").alias("ttl_quantity"),
        ratio(F.sum("amountofsales"), F.sum("quantity")).alias("avg_amountofsales"),
        F.sum("amt_payment").alias("ttl_amt_payment"),
    )


def item_daily_sales(sales: DataFrame) -> DataFrame:
    """All stores together: quantity per item and day."""
    return sales.groupBy("item_code", "day_dt").agg(F.sum("ttl_quantity").alias("ttl_quantity"))


def low_sales_series(sales: DataFrame, end: str, not_before: str = LOW_SALES_START) -> DataFrame:
    """Gap-free daily series of every item from its first sale (or `not_before`) to `end`."""
    daily = item_daily_sales(sales)
    return dense(day_spans(daily, end, not_before), daily)


def repair_outliers(
    sales: DataFrame,
    threshold: float = OUTLIER_QUANTITY,
    days: int = OUTLIER_DAYS,
    quantity: str = "ttl_quantity",
) -> DataFrame:
    """Replaces implausibly large quantities by the mean of the days around them.

    A quantity of at least `threshold` is compared with the sum of the quantities up to the threshold
    that the same item and store has within `days` days; above that sum it becomes their mean, or 0
    without any, rounded up. The table has one row per item, store and day, so a window partition is
    never longer than the calendar.
    """
    around = (
        Window.partitionBy("store_id", "item_code")
        .orderBy(F.unix_date("day_dt"))
        .rangeBetween(-days, days)
    )
    usual = F.when(F.col(quantity) <= threshold, F.col(quantity))
    total = F.coalesce(F.sum(usual).over(around), F.lit(0.0))
    replaced = F.coalesce(ratio(total, F.count(usual).over(around)), F.lit(0.0))
    exceeds = (total == 0) | ((total > 0) & (F.col(quantity) > total))
    repaired = F.when(
        F.col(quantity) >= threshold, F.ceil(F.when(exceeds, replaced).otherwise(F.col(quantity))).cast("double")
    ).otherwise(F.col(quantity))
    return sales.withColumn(quantity, repaired)
