"""Cleaning, imputation, encoding, splits and quality reports."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.registry import near, near_sql, query, rounded
from checks.tables import OFFER_SPAN, SPLITS
from shelfwise.constants import FLOOR_TYPE_MAP, GRADE_MAP, LOCATION_TYPE_MAP, OFFER_COLUMNS, STORE_ATTRIBUTES
from shelfwise.functions.dates import is_weekend, weekday
from shelfwise.functions.scalar import fold_year
from shelfwise.operators import clean as K
from shelfwise.operators import encode as E
from shelfwise.operators import narrow as R
from shelfwise.operators import split as T
from shelfwise.operators import stats as Q
from shelfwise.operators.lookup import dictionary_encode, not_yet_exported
from shelfwise.operators.offers import promotion_calendar
from shelfwise.session import shared_dir
from shelfwise.sources import readers, writers

# --- imputation -------------------------------------------------------------------------------------


def _best_rows(spark: SparkSession, d: str) -> DataFrame:
    return promotion_calendar(t.offers(spark, d), *OFFER_SPAN).withColumnRenamed("item", "item_code")


def _sales_with_store(spark: SparkSession, d: str) -> DataFrame:
    return t.sales(spark, d).join(t.store(spark, d), "store_id")


@query(
    """SELECT store_id, coalesce(pds_grace, 'None') AS pds_grace, coalesce(pds_floor_type, 'None') AS pds_floor_type,
        coalesce(pds_location_type_en, 'None') AS pds_location_type_en, store_type, 'Others(其它' AS pds_mtg_type,
        coalesce(ttl_quantity, 0) AS ttl_quantity
    FROM store LEFT JOIN (SELECT CAST(l_suppkey AS VARCHAR) AS store_id, sum(CASE WHEN l_discount > 0.09 AND l_tax > 0.07 AND l_linenumber = 7 THEN l_quantity END) AS ttl_quantity FROM lineitem GROUP BY 1) USING (store_id)""",
    ("store",),
)
def impute_constants(spark: SparkSession, d: str) -> DataFrame:
    counted = F.expr("CASE WHEN l_discount > 0.09D AND l_tax > 0.07D AND l_linenumber = 7 THEN l_quantity END")
    rare = (
        t.table(spark, d, "lineitem")
        .groupBy(F.col("l_suppkey").cast("string").alias("store_id"))
        .agg(F.sum(counted).alias("ttl_quantity"))
    )
    rows = t.store(spark, d).join(rare, "store_id", "left").withColumn("pds_mtg_type", F.lit(None).cast("string"))
    return K.fill_constants(rows).select(
        "store_id", "pds_grace", "pds_floor_type", "pds_location_type_en", "store_type", "pds_mtg_type", "ttl_quantity"
    )


@query(
    f"""SELECT item AS item_code, day_dt, {near_sql('coalesce(amount, retail_price)')} AS amount,
        {near_sql('coalesce(prom_price, retail_price)')} AS prom_price, {near_sql('coalesce(unit_price, prom_price, retail_price)')} AS unit_price FROM best""",
    ("best",),
)
def impute_price_chain(spark: SparkSession, d: str) -> DataFrame:
    filled = K.fill_price_chain(_best_rows(spark, d))
    return rounded(filled.select("item_code", "day_dt", "amount", "prom_price", "unit_price"), "amount", "prom_price", "unit_price")


@query(
    f"""SELECT o.item AS item_code, o.offer_code, {near_sql('coalesce(o.amount, m.med)')} AS amount, count(*) AS n
    FROM (SELECT item, offer_code, CASE WHEN flag <> 'A' THEN unit_price END AS amount FROM offers) o
    JOIN (SELECT item, median(CASE WHEN flag <> 'A' THEN unit_price END) AS med FROM offers GROUP BY item) m USING (item) GROUP BY ALL""",
    ("offers",),
)
def median_by_item(spark: SparkSession, d: str) -> DataFrame:
    priced = t.offers(spark, d).select(
        F.col("item").alias("item_code"), "offer_code", F.when(F.col("flag") != "A", F.col("unit_price")).alias("amount")
    )
    filled = rounded(Q.fill_with_median(priced, ["item_code"], "amount"), "amount")
    return filled.groupBy("item_code", "offer_code", "amount").agg(F.count(F.lit(1)).alias("n"))


@query(
    f""", placed AS MATERIALIZED (SELECT item_code, store_id, day_dt, store_type, loc_selling_area FROM sales JOIN store USING (store_id)),
    medians AS MATERIALIZED (SELECT item_code, store_type, median(loc_selling_area) AS med FROM placed GROUP BY item_code, store_type)
    SELECT item_code, store_id, day_dt, {near_sql('coalesce(loc_selling_area, med)')} AS loc_selling_area FROM placed JOIN medians USING (item_code, store_type)""",
    ("sales", "store"),
)
def median_by_store_type(spark: SparkSession, d: str) -> DataFrame:
    filled = K.fill_selling_area(_sales_with_store(spark, d))
    return rounded(filled.select("item_code", "store_id", "day_dt", "loc_selling_area"), "loc_selling_area")


@query(
    f"SELECT p_type AS sbclass_desc, {near_sql('median(l_extendedprice)')} AS median FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"
)
def exact_median(spark: SparkSession, d: str) -> DataFrame:
    """Few, very large groups: 6 of them hold the whole table."""
    rows = t.table(spark, d, "lineitem").join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    medians = Q.exact_median(rows.withColumnRenamed("p_type", "sbclass_desc"), ["sbclass_desc"], "l_extendedprice")
    return rounded(medians, "median")


def _map_sql(column: str, values: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in values.items())
    return f"CASE {column} {cases} ELSE {column} END AS {column}"


@query(
    f"""SELECT item_code, store_id, day_dt, {_map_sql('pds_location_type_en', LOCATION_TYPE_MAP)}, {_map_sql('pds_floor_type', FLOOR_TYPE_MAP)},
        {_map_sql('pds_grace', GRADE_MAP)} FROM sales JOIN store USING (store_id)""",
    ("sales", "store"),
)
def value_map_clean(spark: SparkSession, d: str) -> DataFrame:
    mapped = K.map_values(_sales_with_store(spark, d))
    return mapped.select("item_code", "store_id", "day_dt", "pds_location_type_en", "pds_floor_type", "pds_grace")


@query(
    "SELECT item_code, store_id, day_dt, ttl_quantity FROM sales WHERE strftime(day_dt, '%Y-%m') NOT IN ('1998-01', '1998-02', '1999-12')",
    ("sales",),
)
def month_exclusion(spark: SparkSession, d: str) -> DataFrame:
    return K.drop_months(t.sales(spark, d), ["1998-01", "1998-02", "1999-12"]).drop("ttl_amt_payment")


@query(
    "SELECT item_code, store_id, day_dt, ttl_quantity FROM sales WHERE day_dt NOT BETWEEN DATE '1998-01-01' AND DATE '1998-04-01'",
    ("sales",),
)
def span_exclusion(spark: SparkSession, d: str) -> DataFrame:
    return K.drop_span(t.sales(spark, d), ("1998-01-01", "1998-04-01")).drop("ttl_amt_payment")


@query(
    """SELECT store_id, area_idnt FROM (SELECT store_id, area_idnt, CASE WHEN CAST(store_id AS BIGINT) % 3 = 0 THEN 'Y' ELSE 'N' END AS is_e_store,
        CASE WHEN CAST(store_id AS BIGINT) % 5 = 0 THEN 'W' ELSE 'S' END AS loc_type_cde, loc_start_dt AS loc_end_dt FROM store)
    WHERE is_e_store = 'N' AND loc_type_cde = 'S' AND loc_end_dt IS NULL AND area_idnt IN ('1', '2', '3', '4')""",
    ("store",),
)
def valid_store_filter(spark: SparkSession, d: str) -> DataFrame:
    number = F.col("store_id").cast("long")
    organisation = t.store(spark, d).withColumns(
        {
            "is_e_store": F.when(number % 3 == 0, "Y").otherwise("N"),
            "loc_type_cde": F.when(number % 5 == 0, "W").otherwise("S"),
            "loc_end_dt": F.col("loc_start_dt"),
        }
    )
    return K.physical_stores(organisation).select("store_id", "area_idnt")


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS store_id, CAST(n_regionkey AS VARCHAR) AS area_idnt, n_name AS loc_wh, r_name AS store_type, s_acctbal AS loc_selling_area
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey BETWEEN 1 AND 4 AND s_acctbal > 0"""
)
def store_dimension(spark: SparkSession, d: str) -> DataFrame:
    organisation = (
        t.table(spark, d, "supplier")
        .join(t.table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("loc_idnt"), F.col("n_regionkey").cast("string").alias("area_idnt"), F.col("n_name").alias("loc_wh"),
            F.col("r_name").alias("store_type"), F.col("s_acctbal").alias("loc_selling_area"), F.lit("N").alias("is_e_store"), F.lit("S").alias("loc_type_cde"),
            F.when(F.col("s_acctbal") <= 0, F.lit("2000-01-01").cast("date")).alias("loc_end_dt"),
        )
    )
    unknown = [c for c in STORE_ATTRIBUTES if c not in organisation.columns]
    stores = K.store_dimension(organisation.withColumns({c: F.lit(None).cast("string") for c in unknown}))
    return stores.select("store_id", "area_idnt", "loc_wh", "store_type", "loc_selling_area")


@query("SELECT CAST(p_partkey AS VARCHAR) AS item_code, p_name AS item_desc, p_type AS sbclass_desc, p_brand AS item_brand FROM part")
def product_dimension(spark: SparkSession, d: str) -> DataFrame:
    named = {"p_partkey": "item_idnt", "p_name": "item_desc", "p_type": "sbclass_desc", "p_brand": "item_brand"}
    return K.product_dimension(t.table(spark, d, "part").withColumnsRenamed(named))


# --- encoding ---------------------------------------------------------------------------------------


@query(
    """SELECT day_dt, ttl_quantity, 'S' || lpad(s.store_id, 9, '0') AS store_id_new, CASE WHEN store_type <> 'ASIA' THEN 'T' || store_type END AS store_type_new, count(*) AS n
    FROM sales s JOIN store USING (store_id) GROUP BY ALL""",
    ("sales", "store"),
)
def dictionary_encoding(spark: SparkSession, d: str) -> DataFrame:
    stores = t.store(spark, d)
    ids = stores.select(F.lit("store_id").alias("code_type"), F.concat(F.lit("S"), F.lpad("store_id", 9, "0")).alias("key_id"), F.col("store_id").alias("value_id"))
    types = (
        stores.where("store_type <> 'ASIA'")
        .select(F.lit("store_type").alias("code_type"), F.concat(F.lit("T"), "store_type").alias("key_id"), F.col("store_type").alias("value_id"))
        .distinct()
    )
    rows = _sales_with_store(spark, d).select("day_dt", "ttl_quantity", "store_id", "store_type")
    coded = dictionary_encode(rows, ids.unionByName(types), ["store_id", "store_type", "zone_id"])
    return coded.groupBy(*coded.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH codes AS (SELECT store_type, row_number() OVER (ORDER BY store_type) - 1 AS code FROM (SELECT DISTINCT store_type FROM store WHERE store_type <> 'ASIA')),
    items AS (SELECT p_partkey, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1 AS code FROM part)
    SELECT day_dt, store_id, CAST(items.code AS BIGINT) AS item_code, CAST(coalesce(codes.code, (SELECT count(*) FROM codes)) AS BIGINT) AS store_type
    FROM sales JOIN store USING (store_id) LEFT JOIN codes USING (store_type) JOIN items ON CAST(p_partkey AS VARCHAR) = sales.item_code""".replace(
        "WITH codes AS", ", codes AS"
    ),
    ("sales", "store"),
)
def label_encode(spark: SparkSession, d: str) -> DataFrame:
    """Codes fitted on the stores outside Asia and on all products; small ranges exercise the cut path."""
    train = t.store(spark, d).where("store_type <> 'ASIA'")
    type_codes = E.ordinal_codes(train, "store_type")
    item_codes = E.ordinal_codes(t.product(spark, d), "item_code")
    rows = _sales_with_store(spark, d).select("day_dt", "store_id", "item_code", "store_type")
    return E.apply_codes(E.apply_codes(rows, type_codes, "store_type"), item_codes, "item_code")


_YEARS = list(range(1995, 2002))


@query(
    f"SELECT day_dt, item_code, {', '.join(f'CAST(CASE WHEN year(day_dt) = {y} THEN 1 ELSE 0 END AS BIGINT) AS year_{y}' for y in _YEARS)} FROM brand_daily",
    ("brand_daily",),
)
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    rows = t.brand_daily(spark, d).select("day_dt", "item_code", F.year("day_dt").alias("year"))
    return E.one_hot(rows, "year", _YEARS)


@query(
    """SELECT item_code, day_dt, CAST(isodow(day_dt) - 1 AS BIGINT) AS weekday, CAST(CASE WHEN isodow(day_dt) > 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
        CAST(CASE WHEN year(day_dt) = 2001 THEN 2000 ELSE year(day_dt) END AS BIGINT) AS year FROM brand_daily""",
    ("brand_daily",),
)
def weekday_features(spark: SparkSession, d: str) -> DataFrame:
    return t.brand_daily(spark, d).select(
        "item_code", "day_dt", weekday("day_dt").alias("weekday"), is_weekend("day_dt").alias("is_weekend"),
        fold_year(F.year("day_dt"), 2000).alias("year"),
    )


# --- quality reports --------------------------------------------------------------------------------

_PROFILED = OFFER_COLUMNS


@query(
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, {near_sql(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)')} AS null_share FROM offers" for c in _PROFILED
    ),
    ("offers",),
)
def null_profile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Q.null_shares(t.offers(spark, d), _PROFILED), "null_share")


_TYPED = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]


@query(
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high, count(*) FILTER (WHERE {c} <> floor({c})) AS n_fractional,
        CASE WHEN count(*) FILTER (WHERE {c} <> floor({c})) > 0 THEN 'float' WHEN max({c}) < 128 THEN 'tinyint' WHEN max({c}) < 32768 THEN 'smallint'
             WHEN max({c}) < 2147483648 THEN 'int' ELSE 'bigint' END AS narrow_type FROM lineitem"""
        for c in _TYPED
    )
)
def type_profile(spark: SparkSession, d: str) -> DataFrame:
    return R.type_profile(t.table(spark, d, "lineitem").select(*_TYPED))


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS l_tax,
        CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber END AS odd_line, count(*) AS n,
        (SELECT 'l_orderkey:' || CASE WHEN max(l_orderkey) < 128 THEN 'tinyint' WHEN max(l_orderkey) < 32768 THEN 'smallint' ELSE 'int' END FROM lineitem)
        || ',l_linenumber:tinyint,l_quantity:tinyint,l_tax:float,odd_line:tinyint' AS types FROM lineitem GROUP BY ALL"""
)
def narrow_columns(spark: SparkSession, d: str) -> DataFrame:
    """The narrowed rows with the names of the chosen types, a float and a column with nulls among them."""
    odd = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_linenumber")).alias("odd_line")
    narrow = R.narrow_types(t.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", odd))
    types = ",".join(f"{name}:{kind}" for name, kind in narrow.dtypes)
    return narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("types", F.lit(types))


@query("SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return Q.duplicate_keys(t.table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT o_orderpriority, count(*) AS n_rows FROM orders GROUP BY ALL")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.value_counts(t.table(spark, d, "orders"), "o_orderpriority")


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS item_code, count(*) AS n_rows, 1::BIGINT AS n_shards, 1::BIGINT AS in_range, 1::BIGINT AS fair
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL"""
)
def shard_balance(spark: SparkSession, d: str) -> DataFrame:
    """Per item its rows, the number of shards they are in, and whether that is in range and not overfull.

    The hash itself is no other engine's; a shard may hold three times its fair share of the items.
    """
    lines = t.table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("item_code"))
    own = lines.withColumn("shard", Q.shard_of("item_code", 18))
    items = own.groupBy("item_code").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("shard").alias("n_shards"), F.min("shard").alias("shard"))
    sizes = items.groupBy("shard").agg(F.count(F.lit(1)).alias("n_items"))
    total = items.count()
    return items.join(sizes, "shard").select(
        "item_code", "n_rows", "n_shards", F.col("shard").between(0, 17).cast("long").alias("in_range"),
        (F.col("n_items") <= 3 * total / 18 + 5).cast("long").alias("fair"),
    )


@query(f"SELECT item_code, {near_sql('avg(CASE WHEN q > 0 THEN 1.0 ELSE 0.0 END)')} AS nonzero_share FROM (SELECT p_brand AS item_code, CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_quantity END AS q FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY ALL")
def nonzero_share(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "lineitem").join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sold = F.when(F.col("l_returnflag") == "A", 0.0).otherwise(F.col("l_quantity")).alias("ttl_quantity")
    return rounded(Q.nonzero_share(rows.select(F.col("p_brand").alias("item_code"), sold)), "nonzero_share")


# --- splits and weights -----------------------------------------------------------------------------


@query(
    f"SELECT split, item_code, day_dt, ttl_quantity FROM (SELECT *, {t._SPLIT_SQL} AS split FROM brand_daily) WHERE split IS NOT NULL",
    ("brand_daily",),
)
def split_labels(spark: SparkSession, d: str) -> DataFrame:
    return T.with_split(t.brand_daily(spark, d), SPLITS).select("split", "item_code", "day_dt", "ttl_quantity")


@query(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS split, item_code, day_dt FROM brand_daily WHERE day_dt BETWEEN DATE '{a}' AND DATE '{b}'"
        for name, (a, b) in {"train": (SPLITS.history_start, SPLITS.v1[0]), "v1": SPLITS.v1, "v2": SPLITS.v2, "test": SPLITS.test}.items()
    ),
    ("brand_daily",),
)
def split_labels_inclusive(spark: SparkSession, d: str) -> DataFrame:
    return T.with_split(t.brand_daily(spark, d), SPLITS, inclusive=True).select("split", "item_code", "day_dt")


@query(
    f"""SELECT item_code, day_dt, {near_sql("pow((day_dt - DATE '1996-01-01') / (DATE '2000-07-01' - DATE '1996-01-01'), 4.0)", 8)} AS weight
    FROM brand_daily WHERE day_dt BETWEEN DATE '1996-01-01' AND DATE '2000-07-01'""",
    ("brand_daily",),
)
def weight_by_day(spark: SparkSession, d: str) -> DataFrame:
    span = (SPLITS.history_start, SPLITS.v1[0])
    rows = t.brand_daily(spark, d).where(F.col("day_dt").between(*span))
    return rows.select("item_code", "day_dt", near(T.day_weight(*span), 8).alias("weight"))


@query(
    f"""SELECT item_code, store_id, day_dt, {near_sql('pow((rn - 1) / nullif(n - 1, 0), 2.0)', 8)} AS weight FROM (
        SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY day_dt, store_id) AS rn, count(*) OVER (PARTITION BY item_code) AS n FROM brand_store_daily)""",
    ("brand_store_daily",),
)
def weight_by_row(spark: SparkSession, d: str) -> DataFrame:
    weighted = T.with_row_weight(t.brand_store_daily(spark, d), 2)
    return weighted.select("item_code", "store_id", "day_dt", near("weight", 8).alias("weight"))


@query(
    f"""SELECT r.item_code, CASE WHEN n_train = 0 THEN 'no_training_rows' WHEN n_test = 0 THEN 'no_test_rows' WHEN first_day >= DATE '1996-03-01' THEN 'history_too_short'
        WHEN low = high THEN 'constant_target' WHEN o.item IS NULL THEN 'no_offers' END AS reason
    FROM (SELECT item_code, count(*) FILTER (WHERE day_dt < DATE '{SPLITS.v1[0]}' AND day_dt >= DATE '{SPLITS.history_start}') AS n_train,
                 count(*) FILTER (WHERE day_dt BETWEEN DATE '{SPLITS.test[0]}' AND DATE '{SPLITS.test[1]}') AS n_test,
                 min(day_dt) FILTER (WHERE day_dt BETWEEN DATE '{SPLITS.history_start}' AND DATE '{SPLITS.history_end}') AS first_day,
                 min(ttl_quantity) FILTER (WHERE day_dt < DATE '{SPLITS.v1[0]}' AND day_dt >= DATE '{SPLITS.history_start}') AS low,
                 max(ttl_quantity) FILTER (WHERE day_dt < DATE '{SPLITS.v1[0]}' AND day_dt >= DATE '{SPLITS.history_start}') AS high
          FROM sales GROUP BY item_code) r
    LEFT JOIN (SELECT DISTINCT item FROM offers WHERE flag = 'A' AND prom3 = 1) o ON o.item = r.item_code""",
    ("sales", "offers"),
)
def eligibility(spark: SparkSession, d: str) -> DataFrame:
    offers = t.offers(spark, d).where("flag = 'A' AND prom3 = 1")
    return T.eligibility(t.sales(spark, d), offers, SPLITS, latest_history="1996-03-01")


# --- sources and sinks ------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{name}"


@query("SELECT item_code FROM product WHERE item_brand <> 'Brand#1'", ("product",))
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    items = t.product(spark, d)
    return not_yet_exported(readers.item_list(items), writers.exported_items(items.where("item_brand = 'Brand#1'")))


@query("SELECT item_code, store_id, day_dt, ttl_quantity FROM brand_daily", ("brand_daily",))
def pipe_text_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written headerless with '|' between fields, read back by position."""
    path = _folder(spark, "pipe")
    rows = t.brand_daily(spark, d).select("item_code", "store_id", "day_dt", "ttl_quantity")
    writers.write_pipe_text(rows, path)
    return readers.positional_csv_table(spark, path, rows.schema, "|")


@query("SELECT item_code, store_id, day_dt, ttl_quantity FROM brand_daily WHERE item_code IN ('Brand#1', 'Brand#12')", ("brand_daily",))
def partitioned_item_read(spark: SparkSession, d: str) -> DataFrame:
    """Written with one directory per item; some items are read back through partition pruning."""
    path = _folder(spark, "items")
    writers.write_by_item(t.brand_daily(spark, d), path)
    return readers.parquet_items(spark, path, ["Brand#1", "Brand#12"]).select("item_code", "store_id", "day_dt", "ttl_quantity")


@query("SELECT day_dt, item_code, ttl_quantity FROM brand_daily", ("brand_daily",))
def csv_column_pruning(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark, "csv")
    rows = t.brand_daily(spark, d).select("item_code", "store_id", "day_dt", "ttl_quantity")
    writers.write_csv(rows, path)
    return readers.csv_table(spark, path, rows.schema, ["day_dt", "item_code", "ttl_quantity"])


@query(
    "SELECT item_code, min(sbclass_desc) AS sbclass_desc FROM product GROUP BY item_code", ("product",)
)
def item_subclass(spark: SparkSession, d: str) -> DataFrame:
    return readers.subclass_of_items(t.product(spark, d))


@query("SELECT item_code FROM product ORDER BY item_code LIMIT 100 OFFSET 2", ("product",))
def item_slice(spark: SparkSession, d: str) -> DataFrame:
    return readers.item_slice(readers.item_list(t.product(spark, d)), 100, 2)


@query(
    "SELECT item_code FROM product WHERE sbclass_desc = 'PROMO' AND item_brand = 'Brand#3'", ("product",)
)
def subclass_filter(spark: SparkSession, d: str) -> DataFrame:
    products = t.product(spark, d).withColumnRenamed("item_brand", "class_desc")
    return readers.items_of_subclass(products, "Brand#3", "PROMO")


@query("SELECT store_id, area_idnt, count(*) AS n_items, sum(ttl_quantity) AS ttl_quantity FROM sales JOIN store USING (store_id) GROUP BY ALL", ("sales", "store"))
def warehouse_sql(spark: SparkSession, d: str) -> DataFrame:
    sql = "SELECT store_id, area_idnt, count(*) AS n_items, sum(ttl_quantity) AS ttl_quantity FROM {sales} JOIN {store} USING (store_id) GROUP BY store_id, area_idnt"
    return readers.warehouse_query(spark, sql, sales=t.sales(spark, d), store=t.store(spark, d))
