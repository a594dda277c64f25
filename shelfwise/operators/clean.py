"""Cleaning and imputation of the feature table."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.constants import (
    MISSING_MEETING_TYPE,
    MISSING_REQUIRED_NUM,
    MISSING_TEXT,
    PANDEMIC_MONTHS,
    PANDEMIC_SPAN,
    PROMOTION_FLAGS,
    STORE_AREAS,
    STORE_ATTRIBUTES,
    TEXT_COLUMNS,
    VALUE_MAPS,
)
from shelfwise.functions.dates import between_days, in_months
from shelfwise.functions.scalar import price_ratio
from shelfwise.operators.stats import fill_with_median


def map_values(df: DataFrame, maps: Mapping[str, Mapping[str, str]] = VALUE_MAPS) -> DataFrame:
    """Replaces listed values per column, all at once: a replacement is never replaced again."""
    for column, values in maps.items():
        if column in df.columns:
            df = df.replace(dict(values), subset=[column])
    return df


def drop_months(df: DataFrame, months: Iterable[str] = PANDEMIC_MONTHS) -> DataFrame:
    return df.where(~in_months("day_dt", months))


def drop_span(df: DataFrame, span: tuple[str, str] = PANDEMIC_SPAN) -> DataFrame:
    """Leaves out the days of the span, both ends included."""
    return df.where(~between_days("day_dt", *span))


def physical_stores(organisation: DataFrame, areas: Iterable[str] = STORE_AREAS) -> DataFrame:
    """Open physical stores of the given areas."""
    return organisation.where(
        (F.col("is_e_store") == "N")
        & (F.col("loc_type_cde") == "S")
        & F.col("loc_end_dt").isNull()
        & F.col("area_idnt").isin(list(areas))
    )


def store_dimension(organisation: DataFrame) -> DataFrame:
    """Open physical stores under this library's column names."""
    return physical_stores(organisation).select(F.col("loc_idnt").cast("string").alias("store_id"), *STORE_ATTRIBUTES)


def product_dimension(products: DataFrame) -> DataFrame:
    return products.select(F.col("item_idnt").cast("string").alias("item_code"), "item_desc", "sbclass_desc", "item_brand")


def stores_with_warehouse(stores: DataFrame) -> DataFrame:
    return stores.where(F.col("loc_wh").isNotNull())


def fill_promotion_gaps(df: DataFrame) -> DataFrame:
    """Days without an offer: no promotion kind, one required unit, no discount."""
    gaps = {c: 0 for c in PROMOTION_FLAGS} | {"required_num": MISSING_REQUIRED_NUM, "p_rate": 0}
    return df.na.fill({c: v for c, v in gaps.items() if c in df.columns})


def fill_price_chain(df: DataFrame) -> DataFrame:
    """Amount and promotion price fall back to the retail price, the unit price to the promotion price."""
    promotion = F.coalesce("prom_price", "retail_price")
    return df.withColumns(
        {
            "amount": F.coalesce("amount", "retail_price"),
            "prom_price": promotion,
            "unit_price": F.coalesce(F.col("unit_price"), promotion),
        }
    )


def fill_promotion_columns(df: DataFrame, key: str = "item_code", weight: str | None = None) -> DataFrame:
    """Retail price by the item's median, then promotion gaps and the price chain."""
    return (
        df.transform(fill_with_median, [key], "retail_price", weight)
        .transform(fill_promotion_gaps)
        .transform(fill_price_chain)
    )


def fill_constants(df: DataFrame, text: str = MISSING_TEXT) -> DataFrame:
    """Missing attribute texts, meeting type and sales."""
    gaps = {c: text for c in TEXT_COLUMNS} | {"pds_mtg_type": MISSING_MEETING_TYPE, "ttl_quantity": 0.0}
    return df.na.fill({c: v for c, v in gaps.items() if c in df.columns})


def fill_selling_area(df: DataFrame, keys: Sequence[str] = ("item_code", "store_type")) -> DataFrame:
    """A missing selling area is the median of the item's rows of that store type."""
    area = F.col("loc_selling_area").cast("double")
    return df.withColumn("loc_selling_area", area).transform(fill_with_median, list(keys), "loc_selling_area")


def with_price_ratio(df: DataFrame) -> DataFrame:
    """`p_rate` as unit price over retail price, to be taken after any price override."""
    return df.withColumn("p_rate", price_ratio("unit_price", "retail_price"))
