"""Row identity, stored stages and table reading shared by the operators of this subpackage."""

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import stage_table

#: Writes a table to the shared folder and reads it back: `stage(df, name)`.
stage = stage_table
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; clusters install it or pass --py-files."""
    own, path = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if own not in path.get("PYTHONPATH", "").split(os.pathsep):
        path["PYTHONPATH"] = os.pathsep.join(p for p in (own, path.get("PYTHONPATH", "")) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def row_id(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """`doc_id`; a row without one gets a negative number made from its text, so null ids are not one hot key."""
    made = -F.lit(1) - F.xxhash64(F.lit("no id"), whole_text(text_column)).bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col(id_column).cast("long"), made)


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(column, UPPER, LOWER)


def aside(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`df` with those columns renamed that look like the operators' own (they begin or end with two underscores), and
    a function that gives such columns of a result their names back."""
    taken = [c for c in df.columns if c.startswith("__") or c.endswith("__")]
    new = {c: f"aside_{i}_{c.strip('_')}" for i, c in enumerate(taken)}
    new = {c: n if n not in df.columns else f"{n}_{uuid.uuid4().hex}" for c, n in new.items()}
    return df.withColumnsRenamed(new), lambda out: out.withColumnsRenamed({n: c for c, n in new.items()})


def with_text(df: DataFrame, changed: Column, text: Column, columns: list[str]) -> DataFrame:
    """`columns` of `df` with a new text where `changed`, and with n_chars following it."""
    df = df.withColumn("__changed", changed).withColumn("__text", F.when(F.col("__changed"), text).otherwise(F.col("text")))
    new = {"text": F.col("__text")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col("__changed"), F.char_length("__text").cast("long")).otherwise(F.col("n_chars"))
    return df.select(*(new[c].alias(c) if c in new else F.col(c) for c in columns))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
