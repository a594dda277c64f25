"""Pooled training sets: the items of a subclass that share a promotion kind."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.dates import day
from shelfwise.operators.offers import same_offer_items
from shelfwise.plans.settings import ForecastSettings
from shelfwise.plans.training_set import model_table
from shelfwise.sources.readers import subclass_of_items


def pooled_items(
    offers: DataFrame, products: DataFrame, sbclass: str, kind: str, settings: ForecastSettings
) -> DataFrame:
    """Items of the subclass with the promotion kind both before and in the test period."""
    members = subclass_of_items(products).where(F.col("sbclass_desc") == sbclass).withColumnRenamed("item_code", "item")
    history = (settings.splits.history_start, settings.splits.history_end)
    return same_offer_items(offers, kind, settings.splits.test, history, members)


def pooled_table(
    rows: DataFrame,
    items: DataFrame,
    offers: DataFrame,
    lunar: DataFrame,
    actual_prices: DataFrame,
    settings: ForecastSettings,
    schedule: DataFrame | None = None,
) -> DataFrame:
    """Model table of the pooled items, the item being a feature."""
    pooled = rows.join(items.withColumnRenamed("item", "item_code"), "item_code", "left_semi")
    return model_table(pooled, offers, lunar, actual_prices, settings, schedule)


def pooled_sets(offers: DataFrame, products: DataFrame, kinds: Sequence[str], settings: ForecastSettings) -> DataFrame:
    """(sbclass_desc, kind, item_code) of the pooled sets of all subclasses and promotion kinds at once.

    An item's kinds in the history and in the test period are bit masks, combined over its offers in one aggregation;
    what both have in common are the sets it belongs to.
    """
    def mask(period: tuple[str, str]) -> Column:
        inside = (F.col("offer_start_date") >= day(period[0])) & (F.col("offer_end_date") <= day(period[1]))
        bits = sum((F.when(F.col(k) == 1, F.lit(1 << i)).otherwise(F.lit(0)) for i, k in enumerate(kinds)), F.lit(0))
        return F.bit_or(F.when(inside, bits).otherwise(F.lit(0)))

    splits = settings.splits
    masks = offers.groupBy(F.col("item").alias("item_code")).agg(mask(splits.test).alias("_ahead"), mask((splits.history_start, splits.history_end)).alias("_past"))
    both = masks.withColumn("_both", F.col("_ahead").bitwiseAND(F.col("_past"))).where("_both <> 0")
    carried = F.array_compact(F.array(*[F.when(F.col("_both").bitwiseAND(F.lit(1 << i)) != 0, F.lit(k)) for i, k in enumerate(kinds)]))
    return both.select("item_code", F.explode(carried).alias("kind")).join(subclass_of_items(products), "item_code").select("sbclass_desc", "kind", "item_code")


def pooled_rows(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of a model table with the pooled sets that they belong to, once for each: adds sbclass_desc and kind."""
    return rows.join(sets, "item_code")
