"""Session settings and the shared folder for checkpoints and hand-over tables."""

import atexit
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def spark_session(app_name: str = "shelfwise", master: str | None = None, **conf: str) -> SparkSession:
    """A session tuned for large joins: runtime re-planning, skew splitting, checked broadcasts.

    No operator in this library hints a broadcast. Spark's own threshold compares the size of a
    join side with `autoBroadcastJoinThreshold` (at planning and, with AQE, at run time) and falls
    back to a shuffled join beyond it.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, else the session's checkpoint folder.

    Where neither is set, as in tests, it lies in the warehouse, which a cluster shares too; never in a folder
    of one machine's own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
        spark.sparkContext.setCheckpointDir(configured)
    return configured


_stages: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def temporary_path(spark: SparkSession, name: str = "stage") -> str:
    """A new folder in the shared folder, deleted when the program ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _stages.append((spark, path))
    return path


def temporary_table(spark: SparkSession, name: str = "stage") -> str:
    """The name of a new table of the catalog, dropped when the program ends."""
    table = f"{name}_{uuid.uuid4().hex}"
    _tables.append((spark, table))
    return table


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: lineage is cut, columns are pruned when read,
    and the planner knows the table's real size. Stages are deleted when the program ends."""
    spark = df.sparkSession
    path = temporary_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by_item(df: DataFrame, parts: int, name: str = "stage", key: str = "item_code", order: Sequence[str] = ()) -> str:
    """`df` written as a table of the catalog in so many buckets by item; gives its name. It is read back where it lies,
    so rows that lie by item are neither shuffled before nor after. Rows put in `order` within their bucket take less room.
    Dropped when the program ends."""
    table = temporary_table(df.sparkSession, name)
    writer = df.write.bucketBy(parts, key).format("parquet").option("compression", "zstd")
    (writer.sortBy(*order) if order else writer).saveAsTable(table)
    return table


@atexit.register
def delete_stages() -> None:
    """Deletes the stages and tables of sessions that still run."""
    while _tables:
        spark, table = _tables.pop()
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # the session has ended and its catalog with it
            continue
    while _stages:
        spark, path = _stages.pop()
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has ended and its folder's owner clears it
            continue


def salts(spark: SparkSession) -> int:
    """Sub-keys over which a hot key is spread: `shelfwise.salts`, else a quarter of the shuffle partitions."""
    return int(spark.conf.get("shelfwise.salts", None) or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4))


#: Bytes of files that one task reads at most from a table that is dealt out.
DEALT_BYTES = 16 * 1024 * 1024


def dealt(df: DataFrame) -> DataFrame:
    """A table of fewer input splits than `shelfwise.input.partitions` (default: the cluster's cores) is dealt out.

    A Parquet file is never split below its row groups, so a table of one file would be one task. Large tables are dealt
    over more tasks, one for each 16 MB of their files, so that what a task holds does not grow with the table. Tables
    of many files are read as they are.
    """
    wanted = dealt_parts(df)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def dealt_parts(df: DataFrame) -> int:
    """Over how many tasks at least a table is read."""
    spark = df.sparkSession
    return int(spark.conf.get("shelfwise.input.partitions", None) or max(spark.sparkContext.defaultParallelism, -(-_file_bytes(df) // DEALT_BYTES)))


def _file_bytes(df: DataFrame) -> int:
    """Bytes of the files that a table is read from."""
    spark = df.sparkSession
    places = [spark._jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles()]
    return sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).getLen() for p in places)
