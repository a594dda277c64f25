"""Calendars and day-level expansion."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.dates import day, days_from, is_weekend, week_start, weekday
from shelfwise.operators.lookup import DAY_PARTS, fully_spread


def calendar_days(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """One row per day with its week key and date parts."""
    return (
        spark.range(1)
        .select(F.explode(days_from(day(start), day(end))).alias("day_dt"))
        .transform(with_day_features)
    )


def with_day_features(df: DataFrame, column: str = "day_dt") -> DataFrame:
    """Adds week key, weekday (0 = Monday), weekend flag and date parts."""
    return df.withColumns(
        {
            "wk_idnt": week_start(column),
            "weekday": weekday(column),
            "is_weekend": is_weekend(column),
            "year": F.year(column),
            "month": F.month(column),
            "mday": F.dayofmonth(column),
            "yday": F.dayofyear(column),
        }
    )


def weeks_to_days(shelf_plan: DataFrame, calendar: DataFrame, key: str = "wk_idnt") -> DataFrame:
    """Each planned week becomes its calendar days; unknown weeks keep one row with null days."""
    return shelf_plan.join(calendar, key, "left")


def day_spans(series: DataFrame, end: str | date, not_before: str | date, key: str = "item_code") -> DataFrame:
    """Per key the days its dense series covers: from max(first day, `not_before`) to `end`."""
    return series.groupBy(key).agg(F.greatest(F.min("day_dt"), day(not_before)).alias("_first"), day(end).alias("_last"))


def own_spans(series: DataFrame, key: str = "item_code") -> DataFrame:
    """Per key its own first and last day."""
    return series.groupBy(key).agg(F.min("day_dt").alias("_first"), F.max("day_dt").alias("_last"))


def dense(spans: DataFrame, facts: DataFrame, value: str = "ttl_quantity", key: str = "item_code") -> DataFrame:
    """One row per key and day of its span with the facts of that day; a missing value counts 0.

    The facts of a key, one per day, are an array beside its span: those inside it and its other days are
    listed in place, so only spans and facts are shuffled and never the dense rows.
    """
    names = [c for c in facts.columns if c not in (key, "day_dt")]
    kind = T.ArrayType(T.StructType([T.StructField(c, facts.schema[c].dataType) for c in ["day_dt", *names]]))
    own = facts.where(F.col("day_dt").isNotNull()).groupBy(key).agg(F.collect_list(F.struct("day_dt", *names)).cast(kind).alias("_facts"))
    known = F.filter(F.coalesce("_facts", F.array().cast(kind)), lambda f: f["day_dt"].between(F.col("_first"), F.col("_last")))
    missing = F.array_except(days_from(F.col("_first"), F.col("_last")), F.transform("_known", lambda f: f["day_dt"]))
    empty = F.transform("_missing", lambda d: F.struct(d.alias("day_dt"), *[F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in names]))
    placed = fully_spread(spans, key, times=DAY_PARTS).join(own, key, "left").withColumn("_known", known).withColumn("_missing", missing)
    listed = placed.withColumn("_day", F.explode(F.concat("_known", empty.cast(kind))))
    rest = [c for c in spans.columns if c not in (key, "_first", "_last")]
    found = [F.col("_day")[c].alias(c) for c in names]
    days = listed.select(key, F.col("_day")["day_dt"].alias("day_dt"), *rest, *found)
    return days.withColumn(value, F.coalesce(value, F.lit(0.0)))
