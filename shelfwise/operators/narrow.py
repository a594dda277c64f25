"""Smallest column types that hold a table's values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
# Signed ranges.
INTEGER_RANGES = {"tinyint": 2**7, "smallint": 2**15, "int": 2**31, "bigint": 2**63}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def type_profile(df: DataFrame) -> DataFrame:
    """Per numeric column its bounds, the number of fractional values and the narrowest type.

    One aggregation for all columns: (column_name, low, high, n_fractional, narrow_type).
    """
    columns = numeric_columns(df)
    facts = []
    for c in columns:
        v = F.col(c).cast("double")
        v = F.when(~F.isnan(v), v)
        facts += [
            F.struct(
                F.min(v).alias("low"),
                F.max(v).alias("high"),
                F.count_if(v != F.floor(v)).alias("n_fractional"),
            ).alias(c)
        ]
    wide = df.agg(*facts)
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("fact")) for c in columns])
    long = wide.select(F.explode(entries).alias("e")).select("e.column_name", "e.fact.*")
    narrow = F.lit("double")
    for kind, bound in reversed(INTEGER_RANGES.items()):
        narrow = F.when((F.col("low") >= -float(bound)) & (F.col("high") < float(bound)), kind).otherwise(narrow)
    return long.withColumn("narrow_type", F.when(F.col("n_fractional") > 0, "float").otherwise(narrow))


def narrow_types(df: DataFrame) -> DataFrame:
    """Casts whole-number columns to the smallest integer and the others to float; nulls stay null."""
    kinds = {row["column_name"]: row["narrow_type"] for row in type_profile(df).collect()}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in df.columns])
