"""Scalar column expressions: prices, clamps and casts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.constants import MAX_PAYMENT, MAX_QUANTITY


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, null on a zero denominator (never an ANSI error)."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def at_least_zero(value: str | Column) -> Column:
    """Negative values become 0; null stays null."""
    value = as_column(value)
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def discount_rate(unit_price: str | Column, retail_price: str | Column) -> Column:
    """Share taken off the retail price, in [0, 1]; 0 where either price is missing."""
    return F.coalesce(at_least_zero(1 - ratio(unit_price, retail_price)), F.lit(0.0))


def price_ratio(unit_price: str | Column, retail_price: str | Column) -> Column:
    """Unit price as a share of the retail price (the models' `p_rate`)."""
    return ratio(unit_price, retail_price)


def deal_price(payment: str | Column, quantity: str | Column) -> Column:
    """Paid amount per unit; 0 where nothing was sold."""
    return F.coalesce(ratio(payment, quantity), F.lit(0.0))


def fold_year(year: str | Column, last_known: int = 2020) -> Column:
    """The year after the last one seen in training counts as that year."""
    year = as_column(year)
    return F.when(year == last_known + 1, F.lit(last_known)).otherwise(year)


def missing_to_null(value: str | Column) -> Column:
    """NaN and infinities become null, so every later rule sees one kind of missing value."""
    value = as_column(value)
    usable = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.when(usable, value)


def number_or_null(value: str | Column) -> Column:
    """Coercing numeric cast: text that is no finite number becomes null."""
    return missing_to_null(as_column(value).try_cast("double"))


def date_or_null(value: str | Column) -> Column:
    """Coercing date cast: text that is no date becomes null."""
    return as_column(value).try_cast("date")


def id_text(value: str | Column) -> Column:
    """Ids that arrived as 12.0, 12 or '12' all become '12'; other text stays as it is, as in all other tables.

    Leading zeros and fractions are kept, and text that is no number stops nothing.
    """
    text = F.trim(as_column(value).cast("string"))
    plain = F.when(text.rlike(r"^-?[0-9.]+E[0-9]+$"), text.try_cast("decimal(38, 4)").cast("string")).otherwise(text)
    return F.regexp_replace(plain, r"^(-?[0-9]+)\.0+$", "$1")


def plausible_sale(quantity: str | Column, payment: str | Column) -> Column:
    """Sanity bounds on one transaction line."""
    quantity, payment = as_column(quantity), as_column(payment)
    return (quantity > 0) & (quantity < MAX_QUANTITY) & (payment < MAX_PAYMENT)


def store_key(*candidates: str | Column) -> Column:
    """First non-null store id of several columns, as text."""
    return F.coalesce(*[as_column(c).cast("string") for c in candidates])
