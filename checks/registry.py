"""Queries over the given tables, each with the SQL that has to give the same rows."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import TABLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, needs: tuple[str, ...] = ()):
    """Registers a query under its function's name; `needs` are the derived tables its SQL names."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(function(spark, sf_dir))

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = with_tables(sql, needs)
        return function

    return register


def with_tables(sql: str, needs: tuple[str, ...]) -> str:
    """The SQL with its derived tables, and those they are built on, in front."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in ordered:
            parents, text = TABLES[name]
            for parent in parents:
                add(parent)
            ordered[name] = text

    for name in needs:
        add(name)
    if not ordered:
        return sql
    head = ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in ordered.items())
    return f"WITH {head}\n{sql}"


def tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, other numbers as double, so both engines report the same types."""
    small = (T.ByteType, T.ShortType, T.IntegerType)
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, small):
            columns.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, T.FloatType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def near(value: str | Column, digits: int = 4) -> Column:
    """Rounds with ties nudged upwards, so the order of a sum cannot flip the last digit."""
    value = F.col(value) if isinstance(value, str) else value
    scale = float(10**digits)
    return F.floor(value.cast("double") * scale + 0.500001) / scale


def near_sql(value: str, digits: int = 4) -> str:
    scale = 10**digits
    return f"floor(CAST({value} AS DOUBLE) * {scale}.0 + 0.500001) / {scale}.0"


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: near(c, digits) for c in columns})
