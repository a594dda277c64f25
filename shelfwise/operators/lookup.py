"""Joins against smaller tables. None hints a broadcast: Spark's size threshold decides."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import salts as session_salts
from shelfwise.session import stage_table


#: Rows that are expanded to days are spread over so many times the session's shuffle partitions.
DAY_PARTS = 4

#: What lies by item lies in so many times the session's shuffle partitions, days and all.
ITEM_PARTS = 8


def fully_spread(df: DataFrame, *keys: str, times: int = 1) -> DataFrame:
    """Hash-partitioned over the session's full number of shuffle partitions, or so many `times` that.

    For rows that are about to be multiplied: run-time coalescing goes by their size before that and
    would leave the many rows to a few tasks, but it keeps a number of partitions that was asked for. What is
    grouped by the same keys and more afterwards stays where it is.
    """
    partitions = times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys)


def item_parts(spark: SparkSession) -> int:
    """In how many partitions rows lie by item."""
    return ITEM_PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def placed_by_item(df: DataFrame, key: str = "item_code") -> DataFrame:
    """Rows placed by item alone, as all tables of a feature build are: they are grouped, put in order and united where
    they lie, and joined there in a `readers.colocated_session`."""
    return df.repartition(item_parts(df.sparkSession), key)


def every_pair(left: DataFrame, right: DataFrame, right_key: str, left_key: str = "item_code") -> DataFrame:
    """Each left row with each right row, as an equi-join over a grid of slots.

    A left row belongs to one grid line and is copied along it, a right row belongs to one grid column
    and is copied along that; they meet in exactly one cell. The work spreads evenly over the cells
    whatever the sizes, and neither side has to fit in one executor. The grid has four cells for each
    shuffle partition of the session.
    """

    def slot(key: str, slots: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")

    def all_slots(slots: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))

    cells = 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_columns = max(1, math.isqrt(cells) // 2)
    n_lines = -(-cells // n_columns)
    lines = left.withColumn("_line", slot(left_key, n_lines)).withColumn("_column", all_slots(n_columns))
    columns = right.withColumn("_column", slot(right_key, n_columns)).withColumn("_line", all_slots(n_lines))
    cell = ["_line", "_column"]
    return fully_spread(lines, *cell).join(fully_spread(columns, *cell), cell).drop(*cell)


def spread_join(
    df: DataFrame, groups: DataFrame, key: str, spread_by: Sequence[str], salts: int | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """Inner join of rows with one row per key, for a key that may hold much of the table.

    The rows of a key are spread over `salts` sub-keys (the session's number) by other columns and the groups are copied to each
    of them. An aggregation by the key that follows then has to shuffle partial results instead of
    staying in the one task that holds the key. With `hot`, a stored list of keys, only those are spread and copied.
    """
    salts = salts or session_salts(df.sparkSession)
    wanted = F.lit(salts)
    if hot is not None:
        marks = hot.select(key, F.lit(salts).alias("_salts"))
        df, groups = df.join(marks, key, "left"), groups.join(marks, key, "left")
        wanted = F.coalesce(F.col("_salts"), F.lit(1))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), wanted).cast("int")).drop("_salts")
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), wanted - 1))).drop("_salts")
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def with_match_flag(df: DataFrame, right: DataFrame, on: Sequence[str], flag: str = "matched") -> DataFrame:
    """Left join that tells whether a row found a partner (1) or not (0)."""
    marked = right.withColumn(flag, F.lit(1))
    return df.join(marked, list(on), "left").withColumn(flag, F.coalesce(flag, F.lit(0)))


def match_report(flagged: DataFrame, flag: str = "matched") -> DataFrame:
    """One row: rows, matched rows, and whether nothing matched at all."""
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(flag), F.lit(0)).cast("long").alias("n_matched"),
    ).withColumn("nothing_matched", (F.col("n_matched") == 0).cast("int"))


def allowed_only(df: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in `allowed`."""
    return df.join(allowed.select(*on), list(on), "left_semi")


def not_yet_exported(items: DataFrame, exported: DataFrame, key: str = "item_code") -> DataFrame:
    """Items still to be exported, for a run that resumes."""
    return items.join(exported.select(key), key, "left_anti")


def dictionary_encode(df: DataFrame, code_map: DataFrame, features: Sequence[str]) -> DataFrame:
    """Replaces each listed column by `<name>_new`, looked up in the long-form code map.

    Columns the table lacks are skipped; values without a code become null.
    """
    for feature in [f for f in features if f in df.columns]:
        codes = code_map.where(F.col("code_type") == feature).select(
            F.col("value_id").alias(feature), F.col("key_id").alias(f"{feature}_new")
        )
        df = df.withColumn(feature, F.col(feature).cast("string")).join(codes, feature, "left").drop(feature)
    return df


#: Codes of a type that fit in a map that every row is looked up in; Spark searches a map entry by entry.
MAP_ENTRIES = 256


def dictionary_encode_by_maps(df: DataFrame, code_map: DataFrame, features: Sequence[str], most: int = MAP_ENTRIES) -> DataFrame:
    """`dictionary_encode` without a join for each column whose codes are few.

    The code map is stored and its types are counted. A type of at most `most` values, each with one code, becomes a
    map from a scalar subquery, so the rows are projected and not joined; the others are joined.
    """
    present = [f for f in features if f in df.columns]
    stored = stage_table(code_map.where(F.col("code_type").isin(present)).select("code_type", "value_id", "key_id"), "codes")
    known = F.col("value_id").isNotNull()
    sizes = stored.groupBy("code_type").agg(F.count_if(known).alias("n"), F.count_distinct("value_id").alias("values")).collect()
    small = [r["code_type"] for r in sizes if r["n"] == r["values"] <= most]
    absent = set(present) - {r["code_type"] for r in sizes}

    def code(feature: str) -> Column:
        if feature in absent:
            return F.lit(None).cast(stored.schema["key_id"].dataType)
        entries = F.collect_list(F.struct(F.col("value_id").cast("string"), "key_id"))
        lookup = stored.where((F.col("code_type") == feature) & known).agg(F.map_from_entries(entries)).scalar()
        return F.try_element_at(lookup, F.col(feature).cast("string"))

    mapped = [f for f in present if f in small or f in absent]
    df = df.select(*[F.col(c) for c in df.columns if c not in mapped], *[code(f).alias(f"{f}_new") for f in mapped])
    return dictionary_encode(df, stored, [f for f in present if f not in mapped])
