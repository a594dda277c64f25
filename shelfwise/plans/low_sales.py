"""Items with few sales: a gap-free series with price and calendar columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.constants import LOW_SALES_FEATURES, LOW_SALES_START, TARGET
from shelfwise.functions.dates import weekday
from shelfwise.operators.clean import drop_span
from shelfwise.operators.calendar import day_spans, dense
from shelfwise.operators.prices import actual_prices
from shelfwise.operators.sales import daily_sales, item_daily_sales
from shelfwise.session import stage_table


def low_sales_table(
    transactions: DataFrame,
    channels: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    end: str,
    not_before: str = LOW_SALES_START,
) -> DataFrame:
    """Daily quantity per item with unit price, weekday and day kind; empty days count 0.

    Sales and prices of a day are put together, and the item's highest price is found, before the days
    are filled in: the dense rows, by far the most, are joined once. The days with sales or prices are
    stored, being read for the spans, the highest price and the fill.
    """
    sold = item_daily_sales(daily_sales(transactions, channels, stores))
    priced = actual_prices(transactions, stores)
    facts = stage_table(
        sold.unionByName(priced, allowMissingColumns=True)
        .groupBy("item_code", "day_dt")
        .agg(F.max(TARGET).alias(TARGET), F.max("unit_price").alias("unit_price")),
        "item-days",
    )
    spans = day_spans(facts.where(F.col(TARGET).isNotNull()), end, not_before)
    highest = (
        facts.join(spans, "item_code")
        .where(F.col("day_dt").between(F.col("_first"), F.col("_last")))
        .groupBy("item_code")
        .agg(F.max("unit_price").alias("_highest"))
    )
    return (
        dense(spans.join(highest, "item_code", "left"), facts)
        .withColumn("unit_price", F.coalesce("unit_price", "_highest"))
        .withColumn("weekday", weekday("day_dt"))
        .transform(drop_span)
        .join(calendar.select("day_dt", "day_type", "is_5th"), "day_dt", "left")
        .na.fill({"day_type": 0, "is_5th": 0})
        .select("item_code", "day_dt", *LOW_SALES_FEATURES, TARGET)
    )
