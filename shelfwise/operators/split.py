"""Time splits, sample weights and eligibility."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.dates import between_days, day, position_between
from shelfwise.functions.scalar import as_column


@dataclass(frozen=True)
class Splits:
    """Training history, two validation windows and the forecast period (ISO dates, ends included)."""

    history_start: str
    v1: tuple[str, str]
    v2: tuple[str, str]
    test: tuple[str, str]

    @property
    def history_end(self) -> str:
        return self.v2[1]

    @property
    def windows(self) -> dict[str, tuple[str, str]]:
        return {"v1": self.v1, "v2": self.v2}


def with_split(df: DataFrame, splits: Splits, inclusive: bool = False, column: str = "day_dt") -> DataFrame:
    """Adds `split` (train, v1, v2 or test); days outside all of them are dropped.

    By default each day belongs to one split and training ends the day before validation starts. With
    `inclusive=True` a boundary day gets one row for every split whose closed range holds it.
    """
    d = as_column(column)
    before_v1 = d <= day(splits.v1[0]) if inclusive else d < day(splits.v1[0])
    members = {
        "train": (d >= day(splits.history_start)) & before_v1,
        "v1": between_days(d, *splits.v1),
        "v2": between_days(d, *splits.v2),
        "test": between_days(d, *splits.test),
    }
    covered = df.where(between_days(d, splits.history_start, splits.test[1]))
    if inclusive:
        labels = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in members.items()]))
        return covered.withColumn("split", F.explode(labels))
    label = F.coalesce(*[F.when(c, F.lit(k)) for k, c in members.items()])
    return covered.withColumn("split", label).where(F.col("split").isNotNull())


def day_weight(start: str, end: str, power: float = 4, column: str | Column = "day_dt") -> Column:
    """Recency weight by calendar day: 0 at `start`, 1 at `end`."""
    return F.pow(position_between(column, start, end), F.lit(float(power)))


def with_row_weight(
    df: DataFrame,
    power: float,
    key: str = "item_code",
    order: Sequence[str] = ("day_dt", "store_id"),
    name: str = "weight",
) -> DataFrame:
    """Recency weight by row position within the item: first row 0, last row 1.

    The position is the number of rows on earlier days plus the position within the day, so rows are
    only ever sorted within one item and day; the running sum is over days.
    """
    by_day, *rest = order
    upto = Window.partitionBy(key).orderBy(by_day).rowsBetween(Window.unboundedPreceding, 0)
    days = (
        df.groupBy(key, by_day)
        .agg(F.count(F.lit(1)).alias("_day_n"))
        .withColumn("_before", F.sum("_day_n").over(upto) - F.col("_day_n"))
        .withColumn("_all", F.sum("_day_n").over(Window.partitionBy(key)))
        .drop("_day_n")
    )
    within = F.row_number().over(Window.partitionBy(key, by_day).orderBy(*rest)) - 1
    placed = df.withColumn("_within", within).join(days, [key, by_day])
    position = F.try_divide(F.col("_before") + F.col("_within"), F.col("_all") - 1)
    return placed.withColumn(name, F.pow(position, F.lit(float(power)))).drop("_within", "_before", "_all")


def eligibility(
    rows: DataFrame,
    offers: DataFrame,
    splits: Splits,
    latest_history: str = "2020-01-01",
) -> DataFrame:
    """Per item why it cannot be forecast, or null: (item_code, reason)."""
    past = F.col("day_dt") < day(splits.v1[0])
    train = past & (F.col("day_dt") >= day(splits.history_start))
    history = between_days("day_dt", splits.history_start, splits.history_end)
    facts = rows.groupBy("item_code").agg(
        F.count_if(train).alias("n_train"),
        F.count_if(between_days("day_dt", *splits.test)).alias("n_test"),
        F.min(F.when(history, F.col("day_dt"))).alias("first_day"),
        F.min(F.when(train, F.col("ttl_quantity"))).alias("low"),
        F.max(F.when(train, F.col("ttl_quantity"))).alias("high"),
    )
    known = offers.select(F.col("item").alias("item_code"), F.lit(1).alias("_offered")).distinct()
    reason = (
        F.when(F.col("n_train") == 0, "no_training_rows")
        .when(F.col("n_test") == 0, "no_test_rows")
        .when(F.col("first_day") >= day(latest_history), "history_too_short")
        .when(F.col("low").eqNullSafe(F.col("high")), "constant_target")
        .when(F.col("_offered").isNull(), "no_offers")
    )
    return facts.join(known, "item_code", "left").select("item_code", reason.alias("reason"))


def eligible_items(reasons: DataFrame) -> DataFrame:
    return reasons.where(F.col("reason").isNull()).select("item_code")
