"""Promotion offers: ingest, daily expansion, best offer, age and size."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.constants import (
    MISSING_DAY_OF_PROM,
    MISSING_OFFER_SIZE,
    OFFER_COLUMNS,
    OFFER_PRICES,
    PROMOTION_FLAGS,
    PROMOTION_LABELS,
)
from shelfwise.functions.dates import day, days_from
from shelfwise.functions.scalar import date_or_null, discount_rate, id_text, number_or_null
from shelfwise.operators.lookup import DAY_PARTS, fully_spread, item_parts, placed_by_item, spread_join
from shelfwise.session import salts, stage_by_item, stage_table

#: An item of more offers than this is spread over several tasks while its offers are cut into stretches.
HOT_OFFERS = 50_000

VALIDITY = ["offer_start_date", "offer_end_date"]
SEGMENT = ["segment_start", "segment_end"]


def ingest_offers(raw: DataFrame) -> DataFrame:
    """Renames promotion kinds, coerces prices and dates, rejects rows without item or validity."""
    named = raw.withColumnsRenamed(PROMOTION_LABELS).select(*OFFER_COLUMNS)
    typed = named.withColumns(
        {c: number_or_null(c) for c in [*PROMOTION_FLAGS, *OFFER_PRICES]} | {c: date_or_null(c) for c in VALIDITY}
    )
    return typed.na.drop(subset=["item", *VALIDITY]).withColumns(
        {"offer_code": id_text("offer_code"), "item": id_text("item")}
    )


Horizon = tuple[str | date, str | date]


def _clip(offers: DataFrame, horizon: Horizon | None) -> DataFrame:
    """Offers that are valid inside the horizon, with their first and last day there."""
    first, last = F.col("offer_start_date"), F.col("offer_end_date")
    valid = offers.where(first <= last)
    if horizon is None:
        return valid.withColumns({"_first": first, "_last": last})
    start, end = day(horizon[0]), day(horizon[1])
    return valid.where((first <= end) & (last >= start)).withColumns(
        {"_first": F.greatest(first, start), "_last": F.least(last, end)}
    )


def expand_offers(offers: DataFrame, start: str | date, end: str | date) -> DataFrame:
    """One row per offer and valid day inside the horizon, both ends included.

    The validity is clipped to the horizon before it is expanded, so an open-ended offer costs no more
    rows than the horizon has days and no interval comparison is left for the join. Offers are placed by item and code
    before they are expanded, so that a count of their days shuffles offers and not days.
    """
    clipped = fully_spread(_clip(offers, (start, end)), "item", "offer_code", times=DAY_PARTS)
    return clipped.withColumn("day_dt", F.explode(days_from(F.col("_first"), F.col("_last")))).drop("_first", "_last")


def stored_by_item(offers: DataFrame) -> DataFrame:
    """Offers that lie by item, stored in buckets by item: what reads them as `placed` shuffles none of them.

    They often come out of long joins, which are made once here; later readers take only their columns.
    """
    return offers.sparkSession.table(stage_by_item(offers, item_parts(offers.sparkSession), "offers", "item", ["item", "offer_start_date"]))


def offer_segments(offers: DataFrame, horizon: Horizon | None = None, placed: bool = False) -> DataFrame:
    """One row per offer and stretch of days on which the item's set of offers does not change.

    Stretches begin and end where any offer of the item does (`segment_start`, `segment_end`, both
    included). An offer of three weeks that meets no other is one row instead of 21. The list of edges of
    an item is never longer than the horizon has days. The lists are stored with each item's number of offers: the rows
    are placed by item, once, and what is grouped by item and stretch next stays there. Only where an item
    has more than `HOT_OFFERS` offers is that item spread. Offers that are `placed` lie by item, as `stored_by_item` gives
    them; they and the lists stay there.
    """
    spark = offers.sparkSession
    clipped = _clip(offers, horizon)
    edges = (
        clipped.select("item", F.explode(F.array("_first", F.date_add("_last", 1))).alias("_edge"))
        .groupBy("item")
        .agg(F.sort_array(F.collect_set("_edge")).alias("_edges"), (F.count(F.lit(1)) / 2).alias("_offers"))
    )
    edges = spark.table(stage_by_item(edges, item_parts(spark), "edges", "item")) if placed else stage_table(edges, "edges")
    hot = stage_table(edges.where(F.col("_offers") > HOT_OFFERS).select("item"), "hot-items")
    edges = edges.drop("_offers")
    if hot.isEmpty():
        listed = (clipped if placed else placed_by_item(clipped, "item")).join(edges.hint("merge") if placed else edges, "item")
    else:
        listed = spread_join(clipped, edges, "item", ["offer_code"], hot=hot)
    begin = F.array_position("_edges", F.col("_first")).cast("int")
    length = (F.array_position("_edges", F.date_add("_last", 1)) - F.array_position("_edges", F.col("_first"))).cast("int")
    stretches = F.arrays_zip(F.slice("_edges", begin, length).alias("a"), F.slice("_edges", begin + 1, length).alias("b"))
    return (
        listed.withColumn("_stretch", F.explode(stretches))
        .withColumns(
            {"segment_start": F.col("_stretch")["a"], "segment_end": F.date_sub(F.col("_stretch")["b"], 1)}
        )
        .drop("_first", "_last", "_edges", "_stretch")
    )


def _price_order() -> list[Column]:
    """Cheapest first, a missing price last, then the offer code and validity to break ties."""
    price = F.coalesce(F.col("unit_price"), F.lit(float("inf")))
    return [price.alias("price"), F.col("offer_code"), *[F.col(c) for c in VALIDITY]]


def best_offer(rows: DataFrame, keys: Sequence[str], whole_row: bool = False) -> DataFrame:
    """The cheapest offer of each group.

    By default each column holds the first non-null value in price order, so a column the cheapest offer
    leaves empty is filled from the next one. `whole_row=True` keeps the cheapest offer as it is.
    Both are one aggregation with a map-side combine, so only one candidate per group and task is shuffled.
    """
    keys = list(keys)
    values = [c for c in rows.columns if c not in keys]
    if whole_row:
        others = [c for c in values if c not in ("offer_code", *VALIDITY)]
        picked = rows.groupBy(*keys).agg(F.min(F.struct(*_price_order(), *others)).alias("_best"))
        return picked.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in values])
    order = F.struct(*_price_order())
    firsts = [F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v")))).alias(c) for c in values]
    picked = rows.groupBy(*keys).agg(*firsts)
    return picked.select(*keys, *[F.col(f"{c}.v").alias(c) for c in values])


def promotion_calendar(
    offers: DataFrame, start: str | date, end: str | date, whole_row: bool = False, placed: bool = False
) -> DataFrame:
    """The best offer of every item and day, with its discount rate.

    The choice is made once per stretch of days with the same offers and expanded to days afterwards. Offers that are `placed`
    lie by item, as `stored_by_item` gives them, and so do the days then.
    """
    return segment_days(promotion_stretches(offers, start, end, whole_row, placed))


def promotion_stretches(
    offers: DataFrame, start: str | date, end: str | date, whole_row: bool = False, placed: bool = False
) -> DataFrame:
    """The best offer of every item and stretch of days with the same offers, with its discount rate."""
    rated = offers.withColumn("p_rate", discount_rate_or_null())
    return best_offer(offer_segments(rated, (start, end), placed), ["item", *SEGMENT], whole_row)


def with_stretch_of_day(days: DataFrame, stretches: DataFrame) -> DataFrame:
    """Left join of item-days (`item_code`, `day_dt`) with the stretch that holds the day, without expanding stretches.

    An item's stretches don't overlap, so the last one that begins on or before a day is the only one that can hold
    it. Days and stretches of an item are put in order together: as many rows as the calendar has days, twice. Where both
    lie by item, they stay there; the item has a name of its own until then, or Spark would not see that a stored
    table and other rows lie alike.
    """
    values = [c for c in stretches.columns if c not in ("item", *SEGMENT)]
    found = F.struct("segment_end", *values)
    begun = stretches.where(F.col("item").isNotNull()).select(F.col("item").alias("_item"), F.col("segment_start").alias("day_dt"), F.lit(0).alias("_kind"), found.alias("_found"))
    asked = days.withColumnRenamed("item_code", "_item").withColumns({"_kind": F.lit(1), "_found": F.lit(None).cast(begun.schema["_found"].dataType)})
    so_far = Window.partitionBy("_item").orderBy("day_dt", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = asked.unionByName(begun, allowMissingColumns=True).withColumn("_found", F.last("_found", ignorenulls=True).over(so_far))
    held = F.when(F.col("day_dt") <= F.col("_found.segment_end"), F.col("_found"))
    return last.where("_kind = 1").withColumn("_found", held).withColumnRenamed("_item", "item_code").select(*days.columns, *[F.col(f"_found.{c}").alias(c) for c in values])


def segment_days(segments: DataFrame) -> DataFrame:
    """Stretches of days as one row per day."""
    days = days_from(F.col("segment_start"), F.col("segment_end"))
    return segments.withColumn("day_dt", F.explode(days)).drop(*SEGMENT)


def discount_rate_or_null() -> Column:
    """Discount rate that stays null where a price is missing, so the next offer may fill it."""
    known = F.col("unit_price").isNotNull() & F.col("retail_price").isNotNull()
    return F.when(known, discount_rate("unit_price", "retail_price"))


def promotion_age(offers: DataFrame, overlap: str = "latest_start", horizon: Horizon | None = None, placed: bool = False) -> DataFrame:
    """Days since the start of each offer (0 on its first day), per item and day.

    Where offers overlap, `latest_start` keeps the youngest; `all` keeps a row for every offer. Offers that are `placed` lie by item.
    """
    validity = offers.select("item", "offer_code", *VALIDITY)
    age = F.datediff("day_dt", "offer_start_date").alias("day_of_prom")
    if overlap == "all":
        clipped = fully_spread(_clip(validity, horizon).drop("offer_code"), "item", times=DAY_PARTS)
        days = clipped.select("item", "offer_start_date", F.explode(days_from(F.col("_first"), F.col("_last"))).alias("day_dt"))
        return days.select("item", "day_dt", age)
    if overlap != "latest_start":
        raise ValueError(f"overlap must be 'latest_start' or 'all', not {overlap!r}")
    youngest = (
        offer_segments(validity, horizon, placed)
        .groupBy("item", *SEGMENT)
        .agg(F.max("offer_start_date").alias("offer_start_date"))
    )
    return segment_days(youngest).select("item", "day_dt", age)


def offer_size(offers: DataFrame, distinct: bool = False) -> DataFrame:
    """Items per offer: rows with an item, or distinct items."""
    if distinct:
        offers = offers.select("offer_code", "item").distinct()
    return offers.groupBy("offer_code").agg(F.count("item").alias("num_items_in_offer"))


def with_offer_size(df: DataFrame, sizes: DataFrame, missing: int = MISSING_OFFER_SIZE) -> DataFrame:
    """Adds the offer's size. Most rows have no offer: their join key is spread, so they share no task."""
    no_offer = F.concat(F.lit("no offer "), F.pmod(F.xxhash64("item_code", "day_dt"), F.lit(64 * salts(df.sparkSession))))
    sizes = sizes.select(F.col("offer_code").alias("_offer"), "num_items_in_offer")
    keyed = df.withColumn("_offer", F.coalesce("offer_code", no_offer))
    return keyed.join(sizes, "_offer", "left").drop("_offer").na.fill({"num_items_in_offer": missing})


def with_offer_size_of_item(df: DataFrame, sizes: DataFrame, asked: DataFrame, missing: int = MISSING_OFFER_SIZE) -> DataFrame:
    """`with_offer_size` for rows that lie by item: only items and their offers are shuffled, and the rows stay where they are.

    `asked` holds the items and offers (`item_code`, `offer_code`) of the rows. Rows of an unknown item are looked up by offer alone.
    """
    pairs = asked.where("item_code IS NOT NULL AND offer_code IS NOT NULL").select(F.col("item_code").alias("_item"), F.col("offer_code").alias("_offer")).distinct()
    found = pairs.join(sizes, F.col("_offer") == sizes["offer_code"]).select("_item", "_offer", "num_items_in_offer")
    known = df.where("item_code IS NOT NULL")
    sized = known.join(found.hint("merge"), (known["item_code"] == found["_item"]) & (known["offer_code"] == found["_offer"]), "left").drop("_item", "_offer")
    return sized.na.fill({"num_items_in_offer": missing}).unionByName(with_offer_size(df.where("item_code IS NULL"), sizes, missing))


def with_promotion_age(df: DataFrame, ages: DataFrame, missing: int = MISSING_DAY_OF_PROM) -> DataFrame:
    ages = ages.withColumnRenamed("item", "item_code")
    return df.join(ages, ["item_code", "day_dt"], "left").na.fill({"day_of_prom": missing})


def same_offer_items(
    offers: DataFrame,
    kind: str,
    test: tuple[str, str],
    history: tuple[str, str],
    subclass_items: DataFrame,
) -> DataFrame:
    """Items of a subclass that carry the promotion kind both in the test period and before it."""

    def carriers(period: tuple[str, str]) -> DataFrame:
        inside = (F.col("offer_start_date") >= day(period[0])) & (F.col("offer_end_date") <= day(period[1]))
        return offers.where(inside & (F.col(kind) == 1)).select("item").distinct()

    return (
        carriers(test)
        .join(carriers(history), "item", "left_semi")
        .join(subclass_items.select("item"), "item", "left_semi")
    )


def offers_by_split(rows: DataFrame, offers: DataFrame, details: Sequence[str]) -> DataFrame:
    """The offers each item meets in each split (`split` column), with their text and price columns."""
    seen = rows.where(F.col("offer_code").isNotNull()).select("split", "item_code", "offer_code").distinct()
    listed = offers.select(F.col("item").alias("item_code"), "offer_code", *details)
    return seen.join(listed, ["item_code", "offer_code"])
