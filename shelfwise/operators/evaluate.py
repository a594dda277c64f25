"""Validation and forecast reports over scored rows (`ttl_quantity` against `y_pred`)."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.constants import LOW_VOLUME, PASS_BAND
from shelfwise.functions.dates import between_days
from shelfwise.functions.scalar import ratio

Windows = Mapping[str, tuple[str, str]]


def in_windows(df: DataFrame, windows: Windows, name: str = "window") -> DataFrame:
    """One row per window that holds the day (both ends included). Other days are filtered at the scan."""
    spans = windows.values()
    covered = between_days("day_dt", min(a for a, _ in spans), max(b for _, b in spans))
    labels = F.array(*[F.when(between_days("day_dt", *span), F.lit(label)) for label, span in windows.items()])
    return df.where(covered).withColumn(name, F.explode(F.array_compact(labels)))


def sell_through(scored: DataFrame, windows: Windows, digits: int = 4) -> DataFrame:
    """Actual against predicted sales per item, warehouse and window, with the item's mean price there.

    One pass over the rows; the item's mean price is put together from the warehouses' sums.
    """
    by_warehouse = (
        in_windows(scored, windows)
        .groupBy("item_code", "window", "loc_wh")
        .agg(
            F.sum("ttl_quantity").alias("ttl_quantity"),
            F.sum("y_pred").alias("y_pred"),
            F.sum("unit_price").alias("_price"),
            F.count("unit_price").alias("_priced"),
        )
    )
    by_item = by_warehouse.groupBy("item_code", "window").agg(
        ratio(F.sum("_price"), F.sum("_priced")).alias("unit_price")
    )
    return by_warehouse.join(by_item, ["item_code", "window"]).select(
        "item_code",
        "window",
        "loc_wh",
        "ttl_quantity",
        F.round("y_pred", digits).alias("y_pred"),
        F.round(ratio("ttl_quantity", "y_pred"), digits).alias("ratio"),
        "unit_price",
    )


def _share(condition: Column) -> Column:
    """Share of rows that satisfy the condition; an unknown ratio does not."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def ratio_bands(results: DataFrame, keys: Sequence[str] = ("item_code",)) -> DataFrame:
    """Shares of warehouses per sell-through band; a value on a shared edge counts in both bands."""
    r = F.col("ratio")
    return results.groupBy(*keys).agg(
        _share(r <= 0.5).alias("upto_50"),
        _share(r.between(0.5, 0.8)).alias("from_50_to_80"),
        _share(r.between(0.8, 1.0)).alias("from_80_to_100"),
        _share(r.between(1.0, 1.2)).alias("from_100_to_120"),
        _share(r >= 1.2).alias("from_120"),
        _share(r.between(*PASS_BAND)).alias("from_65_to_120"),
    )


def pass_gate(results: DataFrame, threshold: float, keys: Sequence[str] = ("item_code",)) -> DataFrame:
    """Per item the share of warehouses inside the acceptance band and whether that is enough."""
    share = results.groupBy(*keys).agg(_share(F.col("ratio").between(*PASS_BAND)).alias("share_in_band"))
    return share.withColumn("passed", (F.col("share_in_band") >= threshold).cast("int"))


def store_accuracy(scored: DataFrame, keys: Sequence[str] = ("item_code", "window")) -> DataFrame:
    """Share of rows within the tolerance of their store, per item and window.

    The tolerance follows a quarter of the store's sales in the window: from -max(1, half of it) to
    max(1, all of it).
    """
    keys = list(keys)
    by_store = [*keys, "store_id"]
    totals = scored.groupBy(*by_store).agg((F.sum("ttl_quantity") / 4).alias("_quarter"))
    off = F.coalesce("ttl_quantity", F.lit(0.0)) - F.col("y_pred")
    quarter = F.coalesce("_quarter", F.lit(0.0))
    inside = off.between(F.least(F.lit(-1.0), quarter * -0.5), F.greatest(F.lit(1.0), quarter))
    return (
        scored.select(*by_store, "ttl_quantity", "y_pred")
        .join(totals, by_store)
        .groupBy(*keys)
        .agg(_share(inside).alias("accuracy"))
    )


def overall_sell_through(scored: DataFrame, keys: Sequence[str] = ("item_code", "window")) -> DataFrame:
    return scored.groupBy(*keys).agg(ratio(F.sum("ttl_quantity"), F.sum("y_pred")).alias("sell_thru"))


def daily_report(scored: DataFrame) -> DataFrame:
    """Forecast against sales per item and day, with the mean price."""
    return (
        scored.groupBy("item_code", "day_dt")
        .agg(
            F.sum("ttl_quantity").alias("ttl_quantity"),
            F.sum("y_pred").alias("y_pred"),
            F.avg("unit_price").alias("unit_price"),
        )
        .withColumn("ratio", ratio("ttl_quantity", "y_pred"))
    )


def split_series(scored: DataFrame) -> DataFrame:
    """The daily series of a result chart, per item and split."""
    return scored.groupBy("split", "item_code", "day_dt").agg(
        F.sum("ttl_quantity").alias("ttl_quantity"),
        F.sum("y_pred").alias("y_pred"),
        F.avg("unit_price").alias("unit_price"),
        F.count_distinct("store_id").alias("store_cnt"),
    )


def low_volume_warehouses(test: DataFrame, minimum: float = LOW_VOLUME) -> DataFrame:
    """Per item how many warehouses get a forecast below the minimum."""
    by_warehouse = test.groupBy("item_code", "loc_wh").agg(F.sum("y_pred").alias("_total"))
    return by_warehouse.groupBy("item_code").agg(F.count_if(F.col("_total") < minimum).alias("n_low"))


def test_stores(test: DataFrame, validation: DataFrame) -> DataFrame:
    """Test rows of stores that also occur in validation."""
    return test.join(validation.select("item_code", "store_id"), ["item_code", "store_id"], "left_semi")


def store_check(test: DataFrame) -> DataFrame:
    """Per item the number of stores and of (item, store, day) keys that occur more than once.

    The keys are grouped once; stores and items are counted from what that leaves.
    """
    keys = test.groupBy("item_code", "store_id", "day_dt").agg(F.count(F.lit(1)).alias("_n"))
    stores = keys.groupBy("item_code", "store_id").agg(F.count_if(F.col("_n") > 1).alias("_repeated"))
    return stores.groupBy("item_code").agg(F.count("store_id").alias("test_store_cnt"), F.sum("_repeated").alias("n_repeated"))


def window_totals(scored: DataFrame, windows: Windows) -> DataFrame:
    """Sales and forecast per item and window, side by side."""
    totals = []
    for label, span in windows.items():
        inside = between_days("day_dt", *span)
        for column in ("ttl_quantity", "y_pred"):
            total = F.coalesce(F.sum(F.when(inside, F.col(column))), F.lit(0.0))
            totals.append(total.alias(f"{label}_{column}"))
    return scored.groupBy("item_code").agg(*totals)


def with_residual(scored: DataFrame) -> DataFrame:
    return scored.withColumn("residual", F.col("ttl_quantity") - F.col("y_pred"))
