"""Table sources. Schemas are given, never inferred."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def warehouse_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Runs SQL over catalog tables; keyword tables can be named as `{table}` in the text."""
    return spark.sql(sql, **tables)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel over ranges of `partition_column` when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def csv_table(spark: SparkSession, path: str | list[str], schema: T.StructType, columns: Sequence[str] = ()) -> DataFrame:
    """CSV with a header row (gzip by file name), optionally only some columns."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*columns) if columns else df


def positional_csv_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType, separator: str = ","
) -> DataFrame:
    """CSV without header; the schema names the columns by position."""
    return spark.read.schema(schema).option("header", False).option("sep", separator).csv(path)


def parquet_table(spark: SparkSession, path: str | list[str], columns: Sequence[str] = ()) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def parquet_items(spark: SparkSession, path: str, items: Sequence[str]) -> DataFrame:
    """Several items of a table partitioned by item; the filter prunes partitions."""
    df = spark.read.schema(_with_text_key(spark, path)).parquet(path)
    return df.where(F.col("item_code").isin(list(items)))


def _with_text_key(spark: SparkSession, path: str) -> T.StructType:
    """Partition values are read as text, so ids keep leading zeros."""
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != "item_code"]
    return T.StructType([*fields, T.StructField("item_code", T.StringType())])


def parquet_items_of(spark: SparkSession, path: str, items: DataFrame) -> DataFrame:
    """The rows of the items of another table, from a table partitioned by item.

    No list of items reaches the driver: where Spark broadcasts the item table, it prunes the partitions at run time.
    """
    df = spark.read.schema(_with_text_key(spark, path)).parquet(path)
    return df.join(items.select("item_code").distinct(), "item_code", "left_semi")


def colocated_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings in which tables bucketed by some of a join's keys are joined in place."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith(("spark.sql.", "shelfwise.")) and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return session


def item_list(df: DataFrame, key: str = "item_code") -> DataFrame:
    return df.select(key).distinct()


def item_slice(items: DataFrame, count: int, start: int = 0, key: str = "item_code") -> DataFrame:
    """`count` items from position `start` on, in id order."""
    return items.orderBy(key).offset(start).limit(count)


def items_of_subclass(products: DataFrame, class_desc: str, sbclass_desc: str) -> DataFrame:
    """Items of one class and subclass."""
    return products.where((F.col("class_desc") == class_desc) & (F.col("sbclass_desc") == sbclass_desc)).select("item_code")


def subclass_of_items(products: DataFrame) -> DataFrame:
    """One subclass per item (the first in text order)."""
    return products.groupBy("item_code").agg(F.min("sbclass_desc").alias("sbclass_desc"))
