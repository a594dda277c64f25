"""Incremental ingest of arriving sales files into a daily table."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

DAILY_KEYS = ["item_code", "store_id", "day_dt"]
PERIOD = "period_start"
RUN = [PERIOD, "level", "first_batch", "last_batch"]


@dataclass(frozen=True)
class Run:
    """Stored sums of the batches `first` to `last` for one period (its folder's text)."""

    period: str
    level: int
    first: int
    last: int

    @property
    def folder(self) -> str:
        return "/".join(f"{c}={v}" for c, v in zip(RUN, (self.period, self.level, self.first, self.last), strict=True))

    def covers(self, other: "Run") -> bool:
        return self.period == other.period and self.level > other.level and self.first <= other.first and other.last <= self.last


class DailySalesIngest:
    """Takes every arriving sales file once and keeps daily sums of them, at a cost that follows what arrives.

    A batch sums its own rows and stores the sums as a run of each period that it touches. Once a period
    has `fan_in` runs of a level, these are summed into one run of the next level, so a row is rewritten once a
    level, of which there are as many as the logarithm of the batches; no batch reads a period as a whole.

    A run is a partition named by period, level and its first and last batch, and partitions are replaced as
    a whole. A batch that is repeated after a failure therefore replaces its own run, or, if a wider run holds the
    batch already, leaves one that the wider run covers: covered runs are not read, and the next merge deletes
    them. `prepare` turns the files' columns into item, store, day and `ttl_quantity`. A period is a
    month, or any unit `trunc` knows; rows without a day are a period of their own.
    """

    def __init__(
        self,
        spark: SparkSession,
        incoming: str,
        schema: T.StructType,
        base: str,
        files_per_batch: int = 1000,
        period: str = "month",
        prepare: Callable[[DataFrame], DataFrame] = lambda arrived: arrived,
        fan_in: int = 4,
    ):
        self.spark = spark
        self.period = period
        self.prepare = prepare
        self.incoming = incoming
        self.schema = schema
        self.store = f"{base}/runs"
        self.checkpoint = f"{base}/checkpoint"
        self.files_per_batch = files_per_batch
        self.fan_in = fan_in

    def run(self) -> None:
        """Processes all files that have arrived, then stops."""
        self.start().awaitTermination()

    def start(self) -> StreamingQuery:
        arriving = (
            self.spark.readStream.schema(self.schema)
            .option("maxFilesPerTrigger", self.files_per_batch)
            .parquet(self.incoming)
        )
        return (
            arriving.writeStream.option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(self._take_batch)
            .start()
        )

    def _take_batch(self, batch: DataFrame, batch_id: int) -> None:
        sums = self.prepare(batch).groupBy(*DAILY_KEYS).agg(F.sum("ttl_quantity").cast("double").alias("ttl_quantity"))
        number = F.lit(batch_id).cast("long")
        placed = sums.withColumns({PERIOD: F.trunc("day_dt", self.period), "level": F.lit(0), "first_batch": number, "last_batch": number})
        self._store(placed)
        touched = {r.period for r in self.runs() if r.level == 0 and r.last == batch_id}
        if touched:
            self._merge(self._without_covered(self.runs(touched)))

    def _merge(self, runs: Iterable[Run], least: int | None = None) -> None:
        """Sums the runs of a level where a period has `least` of them, level by level."""
        least, runs = least or self.fan_in, list(runs)
        level = 0
        while level <= max((r.level for r in runs), default=-1):
            of_period: dict[str, list[Run]] = {}
            for r in _live(runs):
                if r.level == level:
                    of_period.setdefault(r.period, []).append(r)
            ready = {p: own for p, own in of_period.items() if len(own) >= least}
            if ready:
                merged = {p: Run(p, level + 1, min(r.first for r in own), max(r.last for r in own)) for p, own in ready.items()}
                span = F.create_map(*[x for p, m in merged.items() for x in (F.lit(p), F.struct(F.lit(m.first).alias("first"), F.lit(m.last).alias("last")))])
                rows = self._read([r for own in ready.values() for r in own]).groupBy(PERIOD, *DAILY_KEYS).agg(F.sum("ttl_quantity").alias("ttl_quantity"))
                own = F.element_at(span, _period_text())
                self._store(rows.withColumns({"level": F.lit(level + 1), "first_batch": own["first"].cast("long"), "last_batch": own["last"].cast("long")}))
                self._delete([r for r in runs if any(m.covers(r) for m in merged.values())])
                runs = [r for r in runs if not any(m.covers(r) for m in merged.values())] + list(merged.values())
            level += 1

    def _without_covered(self, runs: list[Run]) -> list[Run]:
        """The runs that no wider one covers; the others are deleted."""
        live = _live(runs)
        self._delete([r for r in runs if r not in live])
        return live

    def compact(self) -> None:
        """Sums each period's runs into one, level by level."""
        self._merge(self._without_covered(self.runs()), least=2)
        runs = _live(self.runs())
        while len(runs) > len({r.period for r in runs}):
            top = max(r.level for r in runs)
            for period in {r.period for r in runs}:
                own = [r for r in runs if r.period == period]
                if len(own) > 1:
                    number = [F.lit(v).cast("long") for v in (min(r.first for r in own), max(r.last for r in own))]
                    rows = self._read(own).groupBy(PERIOD, *DAILY_KEYS).agg(F.sum("ttl_quantity").alias("ttl_quantity"))
                    self._store(rows.withColumns({"level": F.lit(top + 1), "first_batch": number[0], "last_batch": number[1]}))
                    self._delete(own)
            runs = _live(self.runs())

    def runs(self, periods: Iterable[str] | None = None) -> list[Run]:
        """The stored runs, of all periods or of some: names of folders, no data."""
        chosen = "*" if periods is None else "{" + ",".join(periods) + "}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.store}/{PERIOD}={chosen}/level=*/first_batch=*/last_batch=*")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        names = [str(f.getPath().toString()).split("/")[-4:] for f in found]
        values = [[n.split("=", 1)[1] for n in own] for own in names]
        return [Run(p, int(level), int(first), int(last)) for p, level, first, last in values]

    def table(self) -> DataFrame:
        """The daily table as it is now."""
        return self._read(_live(self.runs())).groupBy(*DAILY_KEYS).agg(F.sum("ttl_quantity").alias("ttl_quantity"))

    def _read(self, runs: list[Run]) -> DataFrame:
        schema = T.StructType.fromDDL("item_code string, store_id string, day_dt date, ttl_quantity double, period_start date, level int, first_batch long, last_batch long")
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.store).parquet(*[f"{self.store}/{r.folder}" for r in runs])

    def _store(self, rows: DataFrame) -> None:
        (
            rows.hint("rebalance", PERIOD)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*RUN)
            .parquet(self.store)
        )

    def _delete(self, runs: list[Run]) -> None:
        for r in runs:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.store}/{r.folder}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)


def _period_text():
    """A period as its folder's name has it."""
    return F.coalesce(F.col(PERIOD).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))


def _live(runs: list[Run]) -> list[Run]:
    """Runs that no wider run covers."""
    return [r for r in runs if not any(other.covers(r) for other in runs)]
