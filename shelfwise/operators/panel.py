"""The item x store x day panel: planned history plus the future sample."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.dates import day, days_from
from shelfwise.operators.calendar import weeks_to_days
from shelfwise.operators.lookup import every_pair, placed_by_item
from shelfwise.session import stage_table

PANEL_KEYS = ["item_code", "store_id", "day_dt"]


def shelf_plan_days(shelf_plan: DataFrame, calendar: DataFrame, placed: bool = False) -> DataFrame:
    """Panel keys of the weeks in which an item is planned for a store.

    Weeks are placed by item before they become days, unless they are `placed` already, so that the days are never shuffled.
    """
    weeks = shelf_plan if placed else placed_by_item(shelf_plan, "item_idnt")
    days = weeks_to_days(weeks, calendar.select("wk_idnt", "day_dt"))
    return days.select(
        F.col("item_idnt").cast("string").alias("item_code"), F.col("loc_idnt").cast("string").alias("store_id"), "day_dt"
    )


def future_days_given(items: DataFrame, sample: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Every item on every (day, store) of a given future sample.

    Items meet stores, whose days lie in an array beside them, so a pair is made once and not once per day. Columns in
    `carried`, of one value per item, come along with the keys.
    """
    days = F.collect_list(F.struct("day_dt")).alias("_days")
    stores = sample.select("day_dt", "store_id").distinct().groupBy("store_id").agg(days)
    pairs = every_pair(items.select("item_code", *carried).distinct(), stores, "store_id")
    return pairs.select("item_code", "store_id", F.explode("_days").alias("_day"), *carried).select(
        "item_code", "store_id", F.col("_day.day_dt").alias("day_dt"), *carried
    )


def open_store_days(stores: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """The future days of each store after its opening day; stores without one are left out."""
    first = F.greatest(F.date_add("loc_start_dt", 1), day(start))
    return (
        stores.where(F.col("loc_start_dt") < day(end))
        .select("store_id", F.explode(days_from(first, day(end))).alias("day_dt"))
        .distinct()
    )


def future_days_of_open_stores(
    items: DataFrame, stores: DataFrame, start: str | date, end: str | date, carried: Sequence[str] = ()
) -> DataFrame:
    """Every item on every future day of every open store.

    Items meet stores first and days are expanded afterwards, so a pair is shuffled once, not once per day. Columns in
    `carried`, of one value per item, come along with the keys.
    """
    first = F.greatest(F.date_add("loc_start_dt", 1), day(start))
    open_stores = (
        stores.where(F.col("loc_start_dt") < day(end))
        .groupBy("store_id")
        .agg(F.min(first).alias("_first"))
    )
    pairs = every_pair(items.select("item_code", *carried).distinct(), open_stores, "store_id")
    return pairs.select("item_code", "store_id", F.explode(days_from(F.col("_first"), day(end))).alias("day_dt"), *carried)


def future_days_of_assortment(
    pairs: DataFrame, stores: DataFrame, start: str | date, end: str | date, placed: bool = False
) -> DataFrame:
    """Every future day of every (item_code, store_id) of an assortment, from the day after the store's opening.

    The default future: pairs that are planned or were sold lately. Pairs are placed by item before they become days, unless
    they are `placed` already; then the stores' opening days are stored, so that Spark knows their size and leaves the
    pairs where they are if it is small. Its size follows the assortment;
    `future_days_of_open_stores` has every item in every store, whose number grows with the product of both.
    """
    first = F.greatest(F.date_add("loc_start_dt", 1), day(start))
    open_stores = stores.where(F.col("loc_start_dt") < day(end)).groupBy("store_id").agg(F.min(first).alias("_first"))
    if placed:
        open_stores = stage_table(open_stores, "open-stores")
    known = pairs.select("item_code", "store_id").distinct().join(open_stores, "store_id")
    return (known if placed else placed_by_item(known)).select("item_code", "store_id", F.explode(days_from(F.col("_first"), day(end))).alias("day_dt"))


def panel_keys(history: DataFrame, future: DataFrame, future_from: str | date) -> DataFrame:
    """History and future keys without repeats.

    Planned days and those of an assortment lie by item in as many parts, so repeats, also those on or after
    `future_from` where both meet, are found where they are and no days are shuffled.
    """
    return history.select(*PANEL_KEYS).unionByName(future.select(*PANEL_KEYS)).distinct()


def base_panel(history: DataFrame, future: DataFrame, calendar: DataFrame, future_from: str | date) -> DataFrame:
    """Panel keys with the calendar's columns, which depend on the day alone."""
    return panel_keys(history, future, future_from).join(calendar.drop("wk_idnt"), "day_dt", "left")


def stack_rows(history: DataFrame, future: DataFrame) -> DataFrame:
    """History and future one below the other; columns only one side has become null, repeats go."""
    return history.unionByName(future, allowMissingColumns=True).dropDuplicates()


def shared_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns the table has, in the wanted order."""
    return [c for c in wanted if c in df.columns]
