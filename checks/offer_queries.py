"""Promotion offers and prices."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.registry import near, near_sql, query, rounded
from checks.tables import BEST_COLUMNS, OFFER_SPAN, ORDER_SQL, SPLITS
from shelfwise.constants import OFFER_PRICES, PROMOTION_KINDS, PROMOTION_LABELS
from shelfwise.functions.period_text import parse_period
from shelfwise.functions.scalar import deal_price, discount_rate, price_ratio
from shelfwise.operators import offers as O
from shelfwise.operators import prices as P
from shelfwise.operators.lookup import match_report, with_match_flag
from shelfwise.operators.split import with_split
from shelfwise.sources.readers import subclass_of_items

MONEY = ["unit_price", "amount", "prom_price", "retail_price", "p_rate"]


def _near_list(columns: list[str]) -> str:
    return ", ".join(f"{near_sql(c)} AS {c}" if c in MONEY else c for c in columns)


@query(
    "SELECT item, offer_code, day_dt, CAST(count(*) AS BIGINT) AS n FROM expanded GROUP BY item, offer_code, day_dt",
    ("expanded",),
)
def promo_interval_expand(spark: SparkSession, d: str) -> DataFrame:
    expanded = O.expand_offers(t.offers(spark, d), *OFFER_SPAN)
    return expanded.groupBy("item", "offer_code", "day_dt").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT item, day_dt, {_near_list(BEST_COLUMNS)} FROM best", ("best",))
def best_offer_per_day(spark: SparkSession, d: str) -> DataFrame:
    best = O.promotion_calendar(t.offers(spark, d), *OFFER_SPAN)
    return rounded(best.select("item", "day_dt", *BEST_COLUMNS), *MONEY)


_ROW_ORDER = ", ".join([ORDER_SQL, *[f"{c} NULLS FIRST" for c in ["osd_type", "outputs", *PROMOTION_KINDS, "is_vip", "free_gift", *OFFER_PRICES, "flag"]]])


@query(
    f"""SELECT item, day_dt, {_near_list(BEST_COLUMNS)} FROM (
        SELECT *, row_number() OVER (PARTITION BY item, day_dt ORDER BY {_ROW_ORDER}) AS rn FROM expanded) WHERE rn = 1""",
    ("expanded",),
)
def best_offer_whole_row(spark: SparkSession, d: str) -> DataFrame:
    best = O.promotion_calendar(t.offers(spark, d), *OFFER_SPAN, whole_row=True)
    return rounded(best.select("item", "day_dt", *BEST_COLUMNS), *MONEY)


_AGE_SQL = """SELECT item, CAST(offer_start_date + CAST(i AS INTEGER) AS DATE) AS day_dt, i AS day_of_prom FROM (
    SELECT item, offer_start_date, unnest(range(0, offer_end_date - offer_start_date + 1)) AS i FROM offers
    WHERE offer_start_date <= offer_end_date)"""


@query(f"SELECT item, day_dt, CAST(day_of_prom AS BIGINT) AS day_of_prom, count(*) AS n FROM ({_AGE_SQL}) GROUP BY ALL", ("offers",))
def promo_age(spark: SparkSession, d: str) -> DataFrame:
    ages = O.promotion_age(t.offers(spark, d), overlap="all")
    return ages.groupBy("item", "day_dt", "day_of_prom").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT item, day_dt, CAST(min(day_of_prom) AS BIGINT) AS day_of_prom FROM ({_AGE_SQL}) GROUP BY ALL", ("offers",))
def promo_age_latest(spark: SparkSession, d: str) -> DataFrame:
    return O.promotion_age(t.offers(spark, d))


@query("SELECT offer_code, count(item) AS num_items_in_offer FROM offers GROUP BY offer_code", ("offers",))
def offer_size_count(spark: SparkSession, d: str) -> DataFrame:
    return O.offer_size(t.offers(spark, d))


@query("SELECT offer_code, count(DISTINCT item) AS num_items_in_offer FROM offers GROUP BY offer_code", ("offers",))
def offer_size_distinct(spark: SparkSession, d: str) -> DataFrame:
    return O.offer_size(t.offers(spark, d), distinct=True)


_TEST, _PAST = ("2000-10-01", "2001-06-30"), ("1996-01-01", "2000-08-18")


@query(
    f"""SELECT item FROM offers WHERE prom1 = 1 AND offer_start_date >= DATE '{_TEST[0]}' AND offer_end_date <= DATE '{_TEST[1]}'
    INTERSECT SELECT item FROM offers WHERE prom1 = 1 AND offer_start_date >= DATE '{_PAST[0]}' AND offer_end_date <= DATE '{_PAST[1]}'
    INTERSECT SELECT item_code FROM product WHERE sbclass_desc = 'ECONOMY'""",
    ("offers", "product"),
)
def same_offer_items(spark: SparkSession, d: str) -> DataFrame:
    members = subclass_of_items(t.product(spark, d)).where("sbclass_desc = 'ECONOMY'")
    members = members.withColumnRenamed("item_code", "item")
    return O.same_offer_items(t.offers(spark, d), "prom1", _TEST, _PAST, members)


@query(
    f"""SELECT s.split, s.item_code, s.offer_code, o.offer_start_date, o.offer_end_date, {near_sql('o.retail_price')} AS retail_price,
           {near_sql('o.unit_price')} AS unit_price, count(*) AS n
    FROM (SELECT DISTINCT CASE WHEN day_dt < DATE '{SPLITS.v1[0]}' THEN 'train' WHEN day_dt <= DATE '{SPLITS.v1[1]}' THEN 'v1'
                 WHEN day_dt <= DATE '{SPLITS.v2[1]}' THEN 'v2' ELSE 'test' END AS split, item AS item_code, offer_code
          FROM best WHERE day_dt BETWEEN DATE '{SPLITS.history_start}' AND DATE '{SPLITS.v2[1]}' OR day_dt BETWEEN DATE '{SPLITS.test[0]}' AND DATE '{SPLITS.test[1]}') s
    JOIN offers o ON o.item = s.item_code AND o.offer_code = s.offer_code GROUP BY ALL""",
    ("best", "offers"),
)
def offers_by_split(spark: SparkSession, d: str) -> DataFrame:
    offers = t.offers(spark, d)
    rows = O.promotion_calendar(offers, *OFFER_SPAN).select(F.col("item").alias("item_code"), "day_dt", "offer_code")
    listed = O.offers_by_split(
        with_split(rows, SPLITS), offers, ["offer_start_date", "offer_end_date", "retail_price", "unit_price"]
    )
    return rounded(listed, "retail_price", "unit_price").groupBy(*listed.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT item, offer_code, {near_sql('coalesce(greatest(1 - unit_price / nullif(retail_price, 0), 0), 0)')} AS p_rate, count(*) AS n
    FROM offers GROUP BY ALL""",
    ("offers",),
)
def discount_rates(spark: SparkSession, d: str) -> DataFrame:
    rated = t.offers(spark, d).select("item", "offer_code", near(discount_rate("unit_price", "retail_price")).alias("p_rate"))
    return rated.groupBy(*rated.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"SELECT item, offer_code, {near_sql('unit_price / nullif(retail_price, 0)')} AS price_ratio, count(*) AS n FROM offers GROUP BY ALL",
    ("offers",),
)
def price_ratios(spark: SparkSession, d: str) -> DataFrame:
    rated = t.offers(spark, d).select("item", "offer_code", near(price_ratio("unit_price", "retail_price")).alias("price_ratio"))
    return rated.groupBy(*rated.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    f"SELECT item_code, store_id, day_dt, {near_sql('coalesce(ttl_amt_payment / nullif(ttl_quantity, 0), 0)')} AS deal_price FROM sales",
    ("sales",),
)
def deal_prices(spark: SparkSession, d: str) -> DataFrame:
    return t.sales(spark, d).select(
        "item_code", "store_id", "day_dt", near(deal_price("ttl_amt_payment", "ttl_quantity")).alias("deal_price")
    )


_POINTS = """SELECT work_date AS day_dt, prd_id AS item_code, area_idnt, floor(amt_payment / quantity * 100 + 0.5) / 100 AS unit_price2,
        sum(quantity) AS ttl_qty
    FROM type_transactions JOIN area_stores ON CAST(loc_idnt AS VARCHAR) = store_id
    WHERE amt_payment < 3000 AND quantity < 50 AND quantity > 0 GROUP BY ALL"""
_MODAL = f"""SELECT day_dt, item_code, area_idnt, unit_price2 FROM (
    SELECT *, row_number() OVER (PARTITION BY day_dt, item_code, area_idnt ORDER BY ttl_qty DESC, unit_price2) AS rn FROM ({_POINTS})) WHERE rn = 1"""


@query(_POINTS, ("type_transactions", "area_stores"))
def price_points(spark: SparkSession, d: str) -> DataFrame:
    return P.price_points(t.type_transactions(spark, d), t.area_stores(spark, d))


@query(_MODAL, ("type_transactions", "area_stores"))
def modal_price(spark: SparkSession, d: str) -> DataFrame:
    return P.modal_price(P.price_points(t.type_transactions(spark, d), t.area_stores(spark, d)))


@query(
    f"SELECT item_code, day_dt, {near_sql('avg(unit_price2)')} AS unit_price FROM ({_MODAL}) GROUP BY item_code, day_dt",
    ("type_transactions", "area_stores"),
)
def mean_area_price(spark: SparkSession, d: str) -> DataFrame:
    return rounded(P.actual_prices(t.type_transactions(spark, d), t.area_stores(spark, d)), "unit_price")


_PLAN = """SELECT p_type AS item_code, area_idnt, CAST(date_trunc('week', l_shipdate) AS DATE) AS day_dt,
        CAST(sum(CAST(l_linenumber AS BIGINT)) AS DOUBLE) AS unit_price, 10.0::DOUBLE AS retail_price
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN store ON store_id = CAST(l_suppkey AS VARCHAR) GROUP BY ALL"""


def _planned(spark: SparkSession, d: str) -> DataFrame:
    return (
        t.table(spark, d, "lineitem")
        .join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("store_id", F.col("l_suppkey").cast("string"))
        .join(t.store(spark, d).select("store_id", "area_idnt"), "store_id")
        .groupBy(F.col("p_type").alias("item_code"), "area_idnt", F.to_date(F.date_trunc("week", "l_shipdate")).alias("day_dt"))
        .agg(F.sum("l_linenumber").cast("double").alias("unit_price"))
        .withColumn("retail_price", F.lit(10.0))
    )


@query(
    f"""SELECT p.item_code, p.area_idnt, p.day_dt, p.retail_price, coalesce(m.unit_price2, p.unit_price) AS unit_price
    FROM ({_PLAN}) p LEFT JOIN ({_MODAL}) m ON p.item_code = m.item_code AND p.area_idnt = m.area_idnt AND p.day_dt = m.day_dt""",
    ("type_transactions", "area_stores", "store"),
)
def price_override(spark: SparkSession, d: str) -> DataFrame:
    return P.override_price(_planned(spark, d), modal_price(spark, d))


@query(
    f"""SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(m.unit_price2) AS BIGINT) AS n_matched,
           CAST(CASE WHEN count(m.unit_price2) = 0 THEN 1 ELSE 0 END AS BIGINT) AS nothing_matched
    FROM ({_PLAN}) p LEFT JOIN ({_MODAL}) m ON p.item_code = m.item_code AND p.area_idnt = m.area_idnt AND p.day_dt = m.day_dt""",
    ("type_transactions", "area_stores", "store"),
)
def match_flag_report(spark: SparkSession, d: str) -> DataFrame:
    return match_report(with_match_flag(_planned(spark, d), modal_price(spark, d), P.PRICE_KEYS))


@query(
    f"""SELECT b.item_code, b.day_dt, coalesce({near_sql('p.unit_price')}, {near_sql('max(p.unit_price) OVER (PARTITION BY b.item_code)')}) AS unit_price
    FROM (SELECT DISTINCT p_type AS item_code, CAST(l_shipdate AS DATE) AS day_dt FROM lineitem JOIN part ON l_partkey = p_partkey) b
    LEFT JOIN (SELECT item_code, day_dt, avg(unit_price2) AS unit_price FROM ({_MODAL}) GROUP BY item_code, day_dt) p
    ON b.item_code = p.item_code AND b.day_dt = p.day_dt""",
    ("type_transactions", "area_stores"),
)
def max_price_fill(spark: SparkSession, d: str) -> DataFrame:
    days = (
        t.table(spark, d, "lineitem")
        .join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("p_type").alias("item_code"), F.to_date("l_shipdate").alias("day_dt"))
        .distinct()
    )
    prices = P.actual_prices(t.type_transactions(spark, d), t.area_stores(spark, d))
    return rounded(P.fill_with_max_price(days.join(prices, ["item_code", "day_dt"], "left")), "unit_price")


# --- ingest of raw offers and period texts ----------------------------------------------------------


def _raw_offers(spark: SparkSession, d: str) -> DataFrame:
    """Offers as they arrive: all text, some of it unusable."""
    line, key = F.col("l_linenumber"), F.col("o_orderkey")
    kinds = [
        F.when(line == i + 1, "1").otherwise("x").alias(label) for i, label in enumerate(PROMOTION_LABELS)
    ]
    return t.offer_lines(spark, d).select(
        F.when(line != 7, F.col("l_partkey").cast("string")).alias("item"),
        F.concat(key.cast("string"), F.lit(".0")).alias("offer_code"),
        F.when(key % 13 == 0, "not a date").otherwise(F.to_date("o_orderdate").cast("string")).alias("offer_start_date"),
        F.to_date("l_shipdate").cast("string").alias("offer_end_date"),
        F.col("o_orderpriority").alias("osd_type"),
        F.col("l_linestatus").alias("outputs"),
        *kinds,
        (key % 2).cast("string").alias("is_vip"),
        F.lit(None).cast("string").alias("free_gift"),
        F.when(line == 4, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("unit_price"),
        line.cast("string").alias("required_num"),
        F.when(line == 5, "NaN").otherwise(F.col("p_size").cast("string")).alias("amount"),
        F.lit("").alias("prom_price"),
        F.col("p_retailprice").cast("string").alias("retail_price"),
        F.col("l_returnflag").alias("flag"),
    )


_KIND_SQL = ", ".join(f"CASE WHEN l_linenumber = {i + 1} THEN 1.0::DOUBLE END AS {k}" for i, k in enumerate(PROMOTION_KINDS))


@query(
    f"""SELECT *, count(*) AS n FROM (SELECT CAST(l_partkey AS VARCHAR) AS item, CAST(o_orderkey AS VARCHAR) AS offer_code, CAST(o_orderdate AS DATE) AS offer_start_date,
           CAST(l_shipdate AS DATE) AS offer_end_date, o_orderpriority AS osd_type, l_linestatus AS outputs, {_KIND_SQL},
           CAST(o_orderkey % 2 AS DOUBLE) AS is_vip, CAST(NULL AS DOUBLE) AS free_gift,
           CASE WHEN l_linenumber <> 4 THEN l_quantity END AS unit_price, CAST(l_linenumber AS DOUBLE) AS required_num,
           CASE WHEN l_linenumber <> 5 THEN CAST(p_size AS DOUBLE) END AS amount, CAST(NULL AS DOUBLE) AS prom_price,
           p_retailprice AS retail_price, l_returnflag AS flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE l_linenumber <> 7 AND o_orderkey % 13 <> 0) GROUP BY ALL"""
)
def coerce_cast(spark: SparkSession, d: str) -> DataFrame:
    """Offers ingest: coercing casts, null-key reject, key normalisation."""
    offers = O.ingest_offers(_raw_offers(spark, d))
    return offers.groupBy(*offers.columns).agg(F.count(F.lit(1)).alias("n"))


_FORM_SQL = {
    "mmdd-mmdd": r"^(\d{2})(\d{2})-(\d{2})(\d{2})$",
    "mdd-mdd": r"^(\d)(\d{2})-(\d)(\d{2})$",
    "yyyymmdd-yyyymmdd": r"^\d{4}(\d{2})(\d{2})-\d{4}(\d{2})(\d{2})$",
    "mm.dd-mm.dd": r"^(\d{2})[./](\d{2})-(\d{2})[./](\d{2})$",
    "m.dd-m.dd": r"^(\d)\.(\d{2})-(\d)\.(\d{2})$",
    "m.dd-mm.d": r"^(\d)\.(\d{2})-(\d{2})\.(\d)$",
    "mm.d-m.dd": r"^(\d{2})\.(\d)-(\d)\.(\d{2})$",
}
_FORM_CASES = " ".join(f"WHEN regexp_matches(txt, '{p}') THEN '{n}'" for n, p in _FORM_SQL.items())


def _part_sql(group: int) -> str:
    cases = " ".join(f"WHEN '{n}' THEN regexp_extract(txt, '{p}', {group})" for n, p in _FORM_SQL.items())
    return f"CASE period_form {cases} END"


def _date_sql(month: int, dom: int) -> str:
    return f"TRY_CAST(yr || '-' || lpad({_part_sql(month)}, 2, '0') || '-' || lpad({_part_sql(dom)}, 2, '0') AS DATE)"


_TEXT_SQL = """SELECT o_orderkey, strftime(o_orderdate, '%Y') AS yr, CASE o_orderkey % 10
    WHEN 0 THEN strftime(a, '%m%d-') || strftime(b, '%m%d')
    WHEN 1 THEN CAST(month(a) AS VARCHAR) || strftime(a, '%d-') || CAST(month(b) AS VARCHAR) || strftime(b, '%d')
    WHEN 2 THEN strftime(a, '%Y%m%d-') || strftime(b, '%Y%m%d')
    WHEN 3 THEN strftime(a, '%m.%d-') || strftime(b, '%m/%d')
    WHEN 4 THEN CAST(month(a) AS VARCHAR) || strftime(a, '.%d-') || CAST(month(b) AS VARCHAR) || strftime(b, '.%d')
    WHEN 5 THEN CAST(month(a) AS VARCHAR) || strftime(a, '.%d-') || strftime(b, '%m.') || CAST(day(b) AS VARCHAR)
    WHEN 6 THEN strftime(a, '%m.') || CAST(day(a) AS VARCHAR) || '-' || CAST(month(b) AS VARCHAR) || strftime(b, '.%d')
    WHEN 7 THEN strftime(a, '%m30-') || strftime(b, '%m31') WHEN 8 THEN 'all year' ELSE strftime(a, '%m%d-') || strftime(b, '%m%d') || ' vip' END AS txt
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS b FROM orders)"""


@query(
    f"""SELECT o_orderkey, txt, period_form, CASE WHEN s IS NOT NULL AND e IS NOT NULL THEN s END AS start_date,
           CASE WHEN s IS NOT NULL AND e IS NOT NULL THEN e END AS end_date,
           CASE WHEN period_form IS NULL THEN 'unknown_form' WHEN s IS NULL OR e IS NULL THEN 'bad_date'
                WHEN e < s THEN 'end_before_start' ELSE 'ok' END AS period_status
    FROM (SELECT *, {_date_sql(1, 2)} AS s, {_date_sql(3, 4)} AS e
          FROM (SELECT *, CASE {_FORM_CASES} END AS period_form FROM ({_TEXT_SQL})))"""
)
def period_text_parse(spark: SparkSession, d: str) -> DataFrame:
    a, key = F.col("a"), F.col("o_orderkey")
    b = F.date_add("a", (key % 60).cast("int"))

    def text(form: str, day=a):
        return F.date_format(day, form)

    case = key % 10
    texts = (
        F.when(case == 0, F.concat(text("MMdd-"), text("MMdd", b)))
        .when(case == 1, F.concat(text("Mdd-"), text("Mdd", b)))
        .when(case == 2, F.concat(text("yyyyMMdd-"), text("yyyyMMdd", b)))
        .when(case == 3, F.concat(text("MM.dd-"), text("MM/dd", b)))
        .when(case == 4, F.concat(text("M.dd-"), text("M.dd", b)))
        .when(case == 5, F.concat(text("M.dd-"), text("MM.d", b)))
        .when(case == 6, F.concat(text("MM.d-"), text("M.dd", b)))
        .when(case == 7, F.concat(text("MM'30-'"), text("MM'31'", b)))
        .when(case == 8, "all year")
        .otherwise(F.concat(text("MMdd-"), text("MMdd' vip'", b)))
    )
    rows = t.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"))
    parsed = parse_period(rows.withColumn("txt", texts), "txt", F.year("a"))
    return parsed.select("o_orderkey", "txt", "period_form", "start_date", "end_date", "period_status")
