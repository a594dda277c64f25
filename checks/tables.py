"""The given star schema seen as retail tables: Spark frames, and the same as SQL for the oracle."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.constants import PROMOTION_KINDS
from shelfwise.operators.calendar import calendar_days
from shelfwise.operators.lookup import placed_by_item
from shelfwise.operators.split import Splits, with_split
from shelfwise.session import dealt

SPLITS = Splits("1996-01-01", ("2000-07-01", "2000-07-28"), ("2000-07-29", "2000-08-18"), ("2000-10-01", "2000-12-31"))
WINDOWS = SPLITS.windows
OFFER_SPAN = ("1995-01-01", "2001-12-31")
FUTURE = ("2001-01-01", "2001-01-14")
EVERY_STORE_FUTURE = FUTURE
CALENDAR_SPAN = ("1994-12-26", "2001-12-31")
BRAND_OUTLIER = 100

TABLES: dict[str, tuple[tuple[str, ...], str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str, deal: bool = True) -> DataFrame:
    """A given table; one of few row groups is dealt out over the session's cores, unless its rows are placed next anyway."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(df) if deal and name in ("lineitem", "orders") else df


# --- calendar ---------------------------------------------------------------------------------------

TABLES["calendar"] = (
    (),
    f"""SELECT d AS day_dt, CAST(date_trunc('week', d) AS DATE) AS wk_idnt,
           CAST(isodow(d) - 1 AS BIGINT) AS weekday, CAST(CASE WHEN isodow(d) > 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
           CAST(year(d) AS BIGINT) AS year, CAST(month(d) AS BIGINT) AS month,
           CAST(day(d) AS BIGINT) AS mday, CAST(dayofyear(d) AS BIGINT) AS yday,
           CAST(day(d) % 3 AS BIGINT) AS day_type, CAST(CASE WHEN day(d) = 5 THEN 1 ELSE 0 END AS BIGINT) AS is_5th,
           CASE WHEN month(d) IN (6, 11) THEN 'festival' WHEN month(d) = 1 THEN 'new year' END AS activity_desc
    FROM (SELECT CAST(unnest(generate_series(DATE '{CALENDAR_SPAN[0]}', DATE '{CALENDAR_SPAN[1]}', INTERVAL 1 DAY)) AS DATE) AS d)""",
)


def calendar(spark: SparkSession) -> DataFrame:
    month = F.col("month")
    return calendar_days(spark, *CALENDAR_SPAN).withColumns(
        {
            "day_type": F.col("mday") % 3,
            "is_5th": (F.col("mday") == 5).cast("int"),
            "activity_desc": F.when(month.isin(6, 11), "festival").when(month == 1, "new year"),
        }
    )


# --- stores and products ----------------------------------------------------------------------------

TABLES["store"] = (
    (),
    """SELECT CAST(s_suppkey AS VARCHAR) AS store_id, CAST(n_regionkey AS VARCHAR) AS area_idnt, n_name AS loc_wh,
           r_name AS store_type, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS loc_selling_area,
           CASE s_suppkey % 4 WHEN 0 THEN 'Inmall' WHEN 1 THEN 'Inline+Inmall' WHEN 2 THEN 'inline' END AS pds_location_type_en,
           CASE s_suppkey % 5 WHEN 0 THEN 'B1/F' WHEN 1 THEN 'B1' WHEN 2 THEN 'G/F+B/2' WHEN 3 THEN '1/F' END AS pds_floor_type,
           CASE s_suppkey % 3 WHEN 0 THEN '高级' WHEN 1 THEN '标准' END AS pds_grace,
           CASE WHEN s_suppkey % 10 <> 9 THEN DATE '2000-12-20' + CAST(s_suppkey % 25 AS INTEGER) END AS loc_start_dt
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.cast("string").alias("store_id"),
            F.col("n_regionkey").cast("string").alias("area_idnt"),
            F.col("n_name").alias("loc_wh"),
            F.col("r_name").alias("store_type"),
            F.when(k % 7 != 0, F.col("s_acctbal")).alias("loc_selling_area"),
            F.when(k % 4 == 0, "Inmall").when(k % 4 == 1, "Inline+Inmall").when(k % 4 == 2, "inline").alias("pds_location_type_en"),
            F.when(k % 5 == 0, "B1/F").when(k % 5 == 1, "B1").when(k % 5 == 2, "G/F+B/2").when(k % 5 == 3, "1/F").alias("pds_floor_type"),
            F.when(k % 3 == 0, "高级").when(k % 3 == 1, "标准").alias("pds_grace"),
            F.when(k % 10 != 9, F.date_add(F.lit("2000-12-20").cast("date"), (k % 25).cast("int"))).alias("loc_start_dt"),
        )
    )


TABLES["product"] = (
    (),
    """SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_name AS item_desc, p_type AS sbclass_desc, p_brand AS item_brand,
           p_retailprice AS list_price FROM part""",
)


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item_code"),
        F.col("p_name").alias("item_desc"),
        F.col("p_type").alias("sbclass_desc"),
        F.col("p_brand").alias("item_brand"),
        F.col("p_retailprice").alias("list_price"),
    )


# --- sales ------------------------------------------------------------------------------------------

PAID_SQL = "sum(CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(100 * (1 - l_discount)) AS BIGINT)) / 10000.0"


def _paid_parts():
    """Payment of a line in whole hundredths of hundredths."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    share = F.round(100 * (1 - F.col("l_discount"))).cast("long")
    return cents * share


def paid():
    """Payment from whole hundredths, so the sum is exact in any order."""
    return (F.sum(_paid_parts()) / 10000.0).cast("double")


def _sold(lines: DataFrame) -> DataFrame:
    """Lines with their item, store and day."""
    return lines.select(
        F.col("l_partkey").cast("string").alias("item_code"),
        F.col("l_suppkey").cast("string").alias("store_id"),
        F.to_date("l_shipdate").alias("day_dt"),
        F.col("l_quantity").alias("_quantity"),
        _paid_parts().alias("_cents"),
    )


TABLES["sales"] = (
    (),
    f"""SELECT CAST(l_partkey AS VARCHAR) AS item_code, CAST(l_suppkey AS VARCHAR) AS store_id,
           CAST(l_shipdate AS DATE) AS day_dt, sum(l_quantity) AS ttl_quantity, CAST({PAID_SQL} AS DOUBLE) AS ttl_amt_payment
    FROM lineitem GROUP BY ALL""",
)


def sales(spark: SparkSession, sf_dir: str, by_item: bool = False) -> DataFrame:
    """Sums of item, store and day. With `by_item` the lines are placed by item, once, and summed where they lie."""
    if by_item:
        keys = ["item_code", "store_id", "day_dt"]
        return placed_by_item(_sold(table(spark, sf_dir, "lineitem", deal=False))).groupBy(*keys).agg(
            F.sum("_quantity").alias("ttl_quantity"), (F.sum("_cents") / 10000.0).cast("double").alias("ttl_amt_payment")
        )
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_partkey").cast("string").alias("item_code"),
            F.col("l_suppkey").cast("string").alias("store_id"),
            F.to_date("l_shipdate").alias("day_dt"),
        )
        .agg(F.sum("l_quantity").alias("ttl_quantity"), paid().alias("ttl_amt_payment"))
    )


TABLES["brand_daily"] = (
    (),
    """SELECT p_brand AS item_code, 'all' AS store_id, CAST(l_shipdate AS DATE) AS day_dt, sum(l_quantity) AS ttl_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)


def brand_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("item_code"), F.lit("all").alias("store_id"), F.to_date("l_shipdate").alias("day_dt"))
        .agg(F.sum("l_quantity").alias("ttl_quantity"))
    )


TABLES["transactions"] = (
    (),
    """SELECT CAST(l_partkey AS VARCHAR) AS prd_id, l_shipdate AS transaction_date, CAST(l_shipdate AS DATE) AS work_date,
           CASE WHEN l_linenumber % 3 = 0 THEN CAST(l_suppkey AS VARCHAR) END AS deliver_storeid,
           CASE WHEN l_linenumber % 3 = 1 THEN l_suppkey END AS order_store, l_suppkey AS loc_idnt, l_returnflag AS channel,
           l_quantity AS quantity, l_extendedprice AS amountofsales, l_extendedprice * (1 - l_discount) / 40 AS amt_payment
    FROM lineitem""",
)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("prd_id"),
        F.col("l_shipdate").alias("transaction_date"),
        F.to_date("l_shipdate").alias("work_date"),
        F.when(line % 3 == 0, F.col("l_suppkey").cast("string")).alias("deliver_storeid"),
        F.when(line % 3 == 1, F.col("l_suppkey")).alias("order_store"),
        F.col("l_suppkey").alias("loc_idnt"),
        F.col("l_returnflag").alias("channel"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amountofsales"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) / 40).alias("amt_payment"),
    )


TABLES["channels"] = ((), "SELECT DISTINCT l_returnflag AS channel FROM lineitem WHERE l_returnflag <> 'N'")


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'N'")
    return flags.select(F.col("l_returnflag").alias("channel")).distinct()


TABLES["area_stores"] = (("store",), "SELECT store_id, area_idnt FROM store WHERE area_idnt IN ('1', '2', '3', '4')")


def area_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(spark, sf_dir).where(F.col("area_idnt").isin("1", "2", "3", "4")).select("store_id", "area_idnt")


TABLES["type_transactions"] = (
    (),
    """SELECT p_type AS prd_id, CAST(date_trunc('week', l_shipdate) AS DATE) AS work_date, l_suppkey AS loc_idnt,
           l_quantity AS quantity, l_quantity * round(100 * (1 - l_discount)) AS amt_payment
    FROM lineitem JOIN part ON l_partkey = p_partkey""",
)


def type_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("p_type").alias("prd_id"),
            F.to_date(F.date_trunc("week", "l_shipdate")).alias("work_date"),
            F.col("l_suppkey").alias("loc_idnt"),
            F.col("l_quantity").alias("quantity"),
            (F.col("l_quantity") * F.round(100 * (1 - F.col("l_discount")))).alias("amt_payment"),
        )
    )


# --- offers -----------------------------------------------------------------------------------------

_KINDS_SQL = ", ".join(
    f"CASE WHEN l_linenumber = {i + 1} THEN 1.0::DOUBLE WHEN o_orderkey % 17 <> {i} THEN 0.0::DOUBLE END AS {kind}"
    for i, kind in enumerate(PROMOTION_KINDS)
)
TABLES["offers"] = (
    (),
    f"""SELECT CAST(l_partkey AS VARCHAR) AS item, CAST(o_orderkey AS VARCHAR) AS offer_code,
           CAST(o_orderdate AS DATE) AS offer_start_date,
           CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 11 = 0 THEN -3 ELSE 7 + o_orderkey % 21 END AS INTEGER) AS offer_end_date,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS osd_type, l_linestatus AS outputs, {_KINDS_SQL},
           CAST(o_orderkey % 2 AS DOUBLE) AS is_vip, CASE WHEN l_linenumber % 3 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS free_gift,
           CASE WHEN l_linenumber <> 4 THEN l_extendedprice / l_quantity / 5 END AS unit_price,
           CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_linenumber AS DOUBLE) END AS required_num,
           CASE WHEN l_partkey % 3 <> 0 THEN l_extendedprice END AS amount,
           CASE WHEN l_partkey % 4 <> 0 THEN p_retailprice * 0.9::DOUBLE END AS prom_price,
           CASE WHEN l_linenumber <> 6 THEN p_retailprice END AS retail_price, l_returnflag AS flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)


def offer_lines(spark: SparkSession, sf_dir: str, by_item: bool = False) -> DataFrame:
    """Lines with their order and part. With `by_item` they are placed by item (`item`) when they have their order."""
    if by_item:
        orders, part = table(spark, sf_dir, "orders", deal=False), table(spark, sf_dir, "part")
        lines = table(spark, sf_dir, "lineitem", deal=False).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        placed = placed_by_item(lines.withColumn("item", F.col("l_partkey").cast("string")), "item")
        parts = placed_by_item(part.withColumn("item", F.col("p_partkey").cast("string")), "item")
        return placed.join(parts, "item")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )


def offers(spark: SparkSession, sf_dir: str, by_item: bool = False) -> DataFrame:
    """A row per line. With `by_item` they lie by item, placed before their columns are made of the narrow lines."""
    key, line, part = F.col("o_orderkey"), F.col("l_linenumber"), F.col("p_partkey")
    start = F.to_date("o_orderdate")
    length = F.when(key % 11 == 0, F.lit(-3)).otherwise(7 + key % 21).cast("int")
    kinds = [
        F.when(line == i + 1, 1.0).when(key % 17 != i, 0.0).alias(kind) for i, kind in enumerate(PROMOTION_KINDS)
    ]
    return offer_lines(spark, sf_dir, by_item).select(
        F.col("item") if by_item else part.cast("string").alias("item"),
        key.cast("string").alias("offer_code"),
        start.alias("offer_start_date"),
        F.date_add(start, length).alias("offer_end_date"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("osd_type"),
        F.col("l_linestatus").alias("outputs"),
        *kinds,
        (key % 2).cast("double").alias("is_vip"),
        F.when(line % 3 == 0, 1.0).otherwise(0.0).alias("free_gift"),
        F.when(line != 4, F.col("l_extendedprice") / F.col("l_quantity") / 5).alias("unit_price"),
        F.when(line % 2 == 1, line.cast("double")).alias("required_num"),
        F.when(part % 3 != 0, F.col("l_extendedprice")).alias("amount"),
        F.when(part % 4 != 0, F.col("p_retailprice") * 0.9).alias("prom_price"),
        F.when(line != 6, F.col("p_retailprice")).alias("retail_price"),
        F.col("l_returnflag").alias("flag"),
    )


TABLES["expanded"] = (
    ("offers",),
    f"""SELECT *, CAST(unnest(generate_series(greatest(offer_start_date, DATE '{OFFER_SPAN[0]}'),
                     least(offer_end_date, DATE '{OFFER_SPAN[1]}'), INTERVAL 1 DAY)) AS DATE) AS day_dt
    FROM (SELECT *, CASE WHEN unit_price IS NOT NULL AND retail_price IS NOT NULL
                         THEN greatest(coalesce(1 - unit_price / nullif(retail_price, 0), 0), 0) END AS p_rate FROM offers)
    WHERE offer_start_date <= offer_end_date AND offer_start_date <= DATE '{OFFER_SPAN[1]}' AND offer_end_date >= DATE '{OFFER_SPAN[0]}'""",
)

BEST_COLUMNS = [
    "offer_code", "osd_type", *PROMOTION_KINDS, "is_vip", "free_gift", "unit_price", "required_num", "amount",
    "prom_price", "retail_price", "flag", "p_rate",
]
ORDER_SQL = "coalesce(unit_price, 'infinity'::DOUBLE), offer_code, offer_start_date, offer_end_date"
TABLES["best"] = (
    ("expanded",),
    "SELECT item, day_dt, "
    + ", ".join(f"first({c} ORDER BY {ORDER_SQL}, {c}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in BEST_COLUMNS)
    + " FROM expanded GROUP BY item, day_dt",
)

# --- shelf plan and scored rows ---------------------------------------------------------------------

TABLES["shelf_plan"] = (
    (),
    """SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS item_idnt, CAST(date_trunc('week', l_shipdate) AS DATE) AS wk_idnt,
           CAST(l_suppkey AS VARCHAR) AS loc_idnt FROM lineitem""",
)


def shelf_plan(spark: SparkSession, sf_dir: str, by_item: bool = False, place: str | None = None) -> DataFrame:
    """Weeks of items in stores. With `by_item` they are placed by item, or by the column `place`, once, and made distinct where they lie."""
    place = "item_idnt" if by_item else place
    weeks = table(spark, sf_dir, "lineitem", deal=place is None).select(
        F.col("l_partkey").cast("string").alias("item_idnt"),
        F.to_date(F.date_trunc("week", "l_shipdate")).alias("wk_idnt"),
        F.col("l_suppkey").cast("string").alias("loc_idnt"),
    )
    return (placed_by_item(weeks, place) if place else weeks).distinct()


def split_sql(splits: Splits) -> str:
    return f"""CASE WHEN day_dt >= DATE '{splits.history_start}' AND day_dt < DATE '{splits.v1[0]}' THEN 'train'
    WHEN day_dt BETWEEN DATE '{splits.v1[0]}' AND DATE '{splits.v1[1]}' THEN 'v1'
    WHEN day_dt BETWEEN DATE '{splits.v2[0]}' AND DATE '{splits.v2[1]}' THEN 'v2'
    WHEN day_dt BETWEEN DATE '{splits.test[0]}' AND DATE '{splits.test[1]}' THEN 'test' END"""


_SPLIT_SQL = split_sql(SPLITS)

TABLES["brand_store_daily"] = (
    ("store",),
    f"""SELECT p_brand AS item_code, CAST(l_suppkey AS VARCHAR) AS store_id, loc_wh, CAST(l_shipdate AS DATE) AS day_dt,
           sum(l_quantity) AS ttl_quantity, CAST({PAID_SQL} AS DOUBLE) / sum(l_quantity) AS unit_price
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN store ON store_id = CAST(l_suppkey AS VARCHAR) GROUP BY ALL""",
)
TABLES["scored"] = (
    ("brand_store_daily",),
    f"""SELECT b.*, {_SPLIT_SQL} AS split, floor(coalesce(m.mean_qty, 0) * 10000.0 + 0.5) / 10000.0 AS y_pred
    FROM brand_store_daily b LEFT JOIN (
        SELECT item_code, isodow(day_dt) AS wd, sum(ttl_quantity) / count(*) AS mean_qty FROM brand_store_daily
        WHERE day_dt >= DATE '{SPLITS.history_start}' AND day_dt < DATE '{SPLITS.v1[0]}' GROUP BY ALL
    ) m ON b.item_code = m.item_code AND isodow(b.day_dt) = m.wd WHERE {_SPLIT_SQL} IS NOT NULL""",
)
TABLES["scored_windows"] = (
    ("scored",),
    "SELECT *, split AS \"window\" FROM scored WHERE split IN ('v1', 'v2')",
)


def brand_store_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("store_id", F.col("l_suppkey").cast("string"))
        .join(store(spark, sf_dir).select("store_id", "loc_wh"), "store_id")
        .groupBy(F.col("p_brand").alias("item_code"), "store_id", "loc_wh", F.to_date("l_shipdate").alias("day_dt"))
        .agg(F.sum("l_quantity").alias("ttl_quantity"), (paid() / F.sum("l_quantity")).alias("unit_price"))
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per brand and store with a stand-in forecast: the training mean of the weekday."""
    daily = with_split(brand_store_daily(spark, sf_dir), SPLITS).withColumn("_wd", F.weekday("day_dt"))
    means = (
        daily.where(F.col("split") == "train")
        .groupBy("item_code", "_wd")
        .agg((F.sum("ttl_quantity") / F.count(F.lit(1))).alias("_mean"))
    )
    predicted = F.floor(F.coalesce("_mean", F.lit(0.0)) * 10000.0 + 0.5) / 10000.0
    return daily.join(means, ["item_code", "_wd"], "left").withColumn("y_pred", predicted).drop("_wd", "_mean")


def scored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where(F.col("split").isin("v1", "v2"))
