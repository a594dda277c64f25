"""Group statistics and data-quality reports.

A statistic of a whole group is aggregated (with a map-side combine) and joined back instead of being
computed over an unordered window, so a group that holds much of the table never lands in one task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.scalar import missing_to_null, ratio
from shelfwise.session import stage_table

RANGES_PER_MAGNITUDE = 64
PARTS_PER_RANGE = 4096


def with_group_value(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Adds an aggregate of the row's group; null keys form a group of their own."""
    groups = df.groupBy(*keys).agg(value.alias(name))
    return join_on_keys(df, groups, keys)


def join_on_keys(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of per-group values in which null keys match."""
    renamed = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    same = [df[k].eqNullSafe(renamed[f"_g_{k}"]) for k in keys]
    return df.join(renamed, same, "left").drop(*[f"_g_{k}" for k in keys])


def exact_median(df: DataFrame, keys: Sequence[str], column: str, weight: str | None = None) -> DataFrame:
    """Exact median per group without holding a group's values in one task.

    `weight` is an optional column of whole numbers: how many rows a row stands for.
    Values are counted per (group, value) and stored, and the counts summed per order-preserving range of values.
    Only the ranges that hold the middle ranks are looked at again, cut evenly into parts; only the
    values of the parts that hold the middle ranks are ranked one by one.
    """
    keys = list(keys)
    v = F.col("_v")
    counts = stage_table(
        df.select(
            *keys,
            missing_to_null(F.col(column).cast("double")).alias("_v"),
            (F.col(weight) if weight else F.lit(1)).cast("long").alias("_w"),
        )
        .where(v.isNotNull())
        .groupBy(*keys, "_v")
        .agg(F.sum("_w").alias("_n"))
        .withColumn("_range", F.floor(F.signum(v) * F.log1p(F.abs(v)) * RANGES_PER_MAGNITUDE)),
        "counts",
    )
    total = F.sum("_n").over(Window.partitionBy(*keys))
    ranges = (
        counts.groupBy(*keys, "_range")
        .agg(F.sum("_n").alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        .withColumns({"_low": F.floor((total + 1) / 2), "_high": F.floor(total / 2) + 1, "_start": F.lit(0)})
    )
    middle = _holding_middle(ranges, keys, "_range")

    part = F.floor(F.coalesce(ratio(v - F.col("_from"), F.col("_to") - F.col("_from")), F.lit(0.0)) * PARTS_PER_RANGE)
    candidates = join_on_keys(middle, counts, [*keys, "_range"]).withColumn("_part", part)
    place = [*keys, "_range", "_part"]
    parts = candidates.groupBy(*place).agg(
        F.sum("_n").alias("_n"), *[F.max(c).alias(c) for c in ("_low", "_high", "_start")]
    )
    narrow = _holding_middle(parts, [*keys, "_range"], "_part")
    last = join_on_keys(narrow, candidates.select(*place, "_v", "_n"), place)

    ranked = _with_ranks(last, place, "_v")

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_start") < F.col(rank)) & (F.col(rank) <= F.col("_start") + F.col("_n")), v))

    return ranked.groupBy(*keys).agg(((at("_low") + at("_high")) / 2).alias("median"))


def _with_ranks(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Moves `_start`, the number of values before the group, on to the number before each of its rows."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_start", F.col("_start") + F.sum("_n").over(upto) - F.col("_n"))


def _holding_middle(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The rows of a group, in order, whose values hold the wanted ranks; without their counts."""
    start = F.col("_start")
    holds = (start < F.col("_high")) & (start + F.col("_n") >= F.col("_low"))
    return _with_ranks(df, keys, order).where(holds).drop("_n")


def fill_with_median(df: DataFrame, keys: Sequence[str], column: str, weight: str | None = None) -> DataFrame:
    """Missing values take the exact median of their group. The medians are stored, so that their size is known
    when they are joined. Rows that lie by a single key stay there: its null group is looked up beside the join, since
    Spark joins keys that may be null by other expressions than the key."""
    medians = stage_table(exact_median(df, keys, column, weight), "medians")
    if len(keys) > 1:
        return join_on_keys(df, medians, keys).withColumn(column, F.coalesce(column, "median")).drop("median")
    groups = medians.withColumnRenamed(keys[0], "_g")
    without_key = F.when(F.col(keys[0]).isNull(), groups.where("_g IS NULL").select("median").scalar())
    joined = df.join(groups, df[keys[0]] == groups["_g"], "left")
    return joined.withColumn(column, F.coalesce(column, "median", without_key)).drop("_g", "median")


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of missing entries per column, all columns in one pass: (column_name, null_share)."""
    columns = list(columns or df.columns)
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    return shares.unpivot([], columns, "column_name", "null_share")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), column)


def nonzero_share(df: DataFrame, key: str = "item_code", quantity: str = "ttl_quantity") -> DataFrame:
    """Share of rows with a sale, per item."""
    return df.groupBy(key).agg(F.avg(F.when(F.col(quantity) > 0, 1.0).otherwise(0.0)).alias("nonzero_share"))


def shard_of(key: str | Column, shards: int) -> Column:
    """Stable shard of a key, for spreading items over workers."""
    key = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
