"""Sales, panel and feature table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.registry import near, near_sql, query, rounded
from checks.tables import BRAND_OUTLIER, EVERY_STORE_FUTURE, FUTURE, OFFER_SPAN
from shelfwise.operators import calendar as C
from shelfwise.operators import lookup as L
from shelfwise.operators import panel as N
from shelfwise.operators import sales as S
from shelfwise.operators.encode import ordinal_codes
from shelfwise.operators.offers import promotion_calendar, stored_by_item
from shelfwise.plans.features import FeatureInputs, add_offer_features, build_features, promotion_days
from shelfwise.session import stage_by_item, stage_table
from shelfwise.sources.readers import colocated_session

_DAILY = """SELECT prd_id AS item_code, CAST(transaction_date AS DATE) AS day_dt,
        coalesce(deliver_storeid, CAST(order_store AS VARCHAR), CAST(loc_idnt AS VARCHAR)) AS store_id,
        sum(quantity) AS ttl_quantity, sum(amountofsales) / nullif(sum(quantity), 0) AS avg_amountofsales, sum(amt_payment) AS ttl_amt_payment
    FROM transactions WHERE quantity < 50 AND amt_payment < 3000 AND quantity > 0 AND channel IN (SELECT channel FROM channels)
      AND coalesce(deliver_storeid, CAST(order_store AS VARCHAR), CAST(loc_idnt AS VARCHAR)) IN (SELECT store_id FROM area_stores)
    GROUP BY 1, 2, 3"""
_DAILY_NEEDS = ("transactions", "channels", "area_stores")


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return S.daily_sales(t.transactions(spark, d), t.channels(spark, d), t.area_stores(spark, d))


@query(
    f"SELECT item_code, day_dt, store_id, ttl_quantity, {near_sql('avg_amountofsales')} AS avg_amountofsales, {near_sql('ttl_amt_payment')} AS ttl_amt_payment FROM ({_DAILY})",
    _DAILY_NEEDS,
)
def daily_sales_agg(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_daily(spark, d), "avg_amountofsales", "ttl_amt_payment")


@query(f"SELECT item_code, day_dt, sum(ttl_quantity) AS ttl_quantity FROM ({_DAILY}) GROUP BY ALL", _DAILY_NEEDS)
def item_daily(spark: SparkSession, d: str) -> DataFrame:
    return S.item_daily_sales(_daily(spark, d))


@query(
    """SELECT channel, count(*) AS n, sum(quantity) AS quantity FROM transactions
    WHERE channel IN (SELECT channel FROM channels) AND CAST(loc_idnt AS VARCHAR) IN (SELECT store_id FROM area_stores) GROUP BY channel""",
    _DAILY_NEEDS,
)
def semi_join_sales(spark: SparkSession, d: str) -> DataFrame:
    lines = t.transactions(spark, d).withColumn("store_id", F.col("loc_idnt").cast("string"))
    kept = L.allowed_only(L.allowed_only(lines, t.channels(spark, d), ["channel"]), t.area_stores(spark, d), ["store_id"])
    return kept.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


@query(
    """SELECT coalesce(deliver_storeid, CAST(order_store AS VARCHAR), CAST(loc_idnt AS VARCHAR)) AS store_id, count(*) AS n,
           count(deliver_storeid) AS n_delivered FROM transactions GROUP BY 1""",
    ("transactions",),
)
def coalesce_store_key(spark: SparkSession, d: str) -> DataFrame:
    key = S.store_key("deliver_storeid", "order_store", "loc_idnt").alias("store_id")
    return t.transactions(spark, d).groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.count("deliver_storeid").alias("n_delivered")
    )


_AROUND = "(PARTITION BY store_id, item_code ORDER BY day_dt RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 7 DAYS FOLLOWING)"
_REPAIRED = f"""SELECT item_code, store_id, day_dt, CASE WHEN ttl_quantity >= {BRAND_OUTLIER} THEN
        ceil(CASE WHEN s = 0 THEN 0 WHEN s > 0 AND ttl_quantity > s THEN s / n ELSE ttl_quantity END) ELSE ttl_quantity END AS ttl_quantity
    FROM (SELECT *, coalesce(sum(CASE WHEN ttl_quantity <= {BRAND_OUTLIER} THEN ttl_quantity END) OVER {_AROUND}, 0) AS s,
                 count(CASE WHEN ttl_quantity <= {BRAND_OUTLIER} THEN 1 END) OVER {_AROUND} AS n FROM brand_daily)"""


@query(_REPAIRED, ("brand_daily",))
def outlier_repair(spark: SparkSession, d: str) -> DataFrame:
    return S.repair_outliers(t.brand_daily(spark, d), threshold=BRAND_OUTLIER)


_EVENT_DAILY = """SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS item_code, CAST(ts AS DATE) AS day_dt,
    CAST(count(*) AS DOUBLE) AS ttl_quantity FROM events GROUP BY ALL"""


def _event_daily(spark: SparkSession, d: str) -> DataFrame:
    entity = F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("item_code")
    daily = t.table(spark, d, "events").groupBy(entity, F.to_date("ts").alias("day_dt"))
    return daily.agg(F.count(F.lit(1)).cast("double").alias("ttl_quantity"))


@query(
    f"""SELECT c.item_code, c.day_dt, coalesce(s.ttl_quantity, 0) AS ttl_quantity
    FROM (SELECT item_code, CAST(unnest(generate_series(greatest(min(day_dt), DATE '2024-01-05'), DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS day_dt
          FROM ({_EVENT_DAILY}) GROUP BY item_code) c
    LEFT JOIN ({_EVENT_DAILY}) s ON c.item_code = s.item_code AND c.day_dt = s.day_dt"""
)
def densify_zero_fill(spark: SparkSession, d: str) -> DataFrame:
    daily = _event_daily(spark, d)
    return C.dense(C.day_spans(daily, "2024-02-02", "2024-01-05"), daily)


@query(
    f"""SELECT c.item_code, c.day_dt, coalesce(s.ttl_quantity, 0) AS ttl_quantity
    FROM (SELECT item_code, CAST(unnest(generate_series(min(day_dt), max(day_dt), INTERVAL 1 DAY)) AS DATE) AS day_dt
          FROM ({_EVENT_DAILY}) GROUP BY item_code) c
    LEFT JOIN ({_EVENT_DAILY}) s ON c.item_code = s.item_code AND c.day_dt = s.day_dt"""
)
def dense_own_range(spark: SparkSession, d: str) -> DataFrame:
    daily = _event_daily(spark, d)
    return C.dense(C.own_spans(daily), daily)


_HISTORY = "SELECT item_idnt AS item_code, loc_idnt AS store_id, day_dt FROM shelf_plan LEFT JOIN calendar USING (wk_idnt)"
_EVERY_STORE = f"""SELECT item_code, store_id, day_dt FROM (SELECT DISTINCT item_idnt AS item_code FROM shelf_plan),
    (SELECT DISTINCT store_id, day_dt FROM calendar, store WHERE day_dt BETWEEN DATE '{EVERY_STORE_FUTURE[0]}' AND DATE '{EVERY_STORE_FUTURE[1]}' AND day_dt > loc_start_dt)"""
_FUTURE = f"""SELECT item_code, p.store_id, day_dt FROM (SELECT DISTINCT item_idnt AS item_code, loc_idnt AS store_id FROM shelf_plan) p JOIN store USING (store_id), calendar
    WHERE day_dt BETWEEN DATE '{FUTURE[0]}' AND DATE '{FUTURE[1]}' AND day_dt > loc_start_dt"""
_PANEL = f"SELECT DISTINCT * FROM ({_HISTORY} UNION ALL {_FUTURE})"
_PANEL_NEEDS = ("shelf_plan", "calendar", "store")


def _history(spark: SparkSession, d: str) -> DataFrame:
    return N.shelf_plan_days(t.shelf_plan(spark, d), t.calendar(spark))


def _items(spark: SparkSession, d: str) -> DataFrame:
    return t.shelf_plan(spark, d).select(F.col("item_idnt").alias("item_code")).distinct()


def _future(spark: SparkSession, d: str) -> DataFrame:
    pairs = t.shelf_plan(spark, d).select(F.col("item_idnt").alias("item_code"), F.col("loc_idnt").alias("store_id"))
    return N.future_days_of_assortment(pairs, t.store(spark, d), *FUTURE)


def _panel_keys(spark: SparkSession, d: str) -> DataFrame:
    """The plan is stored by item; history and future read it where it lies."""
    order = ["item_idnt", "loc_idnt", "wk_idnt"]
    plan = spark.table(stage_by_item(t.shelf_plan(spark, d, by_item=True), L.item_parts(spark), "shelf_plan", "item_idnt", order))
    pairs = plan.select(F.col("item_idnt").alias("item_code"), F.col("loc_idnt").alias("store_id"))
    future = N.future_days_of_assortment(pairs, t.store(spark, d), *FUTURE, placed=True)
    return N.panel_keys(N.shelf_plan_days(plan, t.calendar(spark), placed=True), future, FUTURE[0])


def panel_rows(spark: SparkSession, d: str) -> DataFrame:
    """Panel keys of known stores. The stores are stored first, so that Spark knows their size and leaves the days where they are."""
    stores = stage_table(t.store(spark, d).select("store_id"), "stores")
    return _panel_keys(spark, d).join(stores, "store_id", "left_semi").where("day_dt IS NOT NULL")


def stored_offers(spark: SparkSession, d: str) -> DataFrame:
    """The offers' long join, made once for all that reads it in a query."""
    return stored_by_item(t.offers(spark, d, by_item=True).drop("outputs"))


def _panel(spark: SparkSession, d: str) -> DataFrame:
    """The panel for reports of stores: the plan is stored by store, its days are made, compared and grouped by store where they lie."""
    order = ["loc_idnt", "item_idnt", "wk_idnt"]
    plan = spark.table(stage_by_item(t.shelf_plan(spark, d, place="loc_idnt"), L.item_parts(spark), "shelf_plan", "loc_idnt", order))
    pairs = plan.select(F.col("item_idnt").alias("item_code"), F.col("loc_idnt").alias("store_id"))
    future = N.future_days_of_assortment(pairs, t.store(spark, d), *FUTURE, placed=True)
    return N.base_panel(N.shelf_plan_days(plan, t.calendar(spark), placed=True), future, t.calendar(spark), FUTURE[0])


def _by_store_day(items: DataFrame, future: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows and first item of each store and day of the future that `future` makes of the items.

    The least text of a group would sort all rows of the product; items carry their place in order, whose least is a number.
    """
    items = stage_table(items, "items")
    codes = stage_table(ordinal_codes(items, "item_code"), "item-codes")
    report = future(items.join(codes, "item_code", "left")).groupBy("store_id", "day_dt").agg(F.count(F.lit(1)).alias("n_items"), F.min("code").alias("code"))
    return report.join(codes.withColumnRenamed("item_code", "first_item"), "code", "left").select("store_id", "day_dt", "n_items", "first_item")


@query(f"SELECT * FROM ({_HISTORY})", _PANEL_NEEDS)
def panel_history_week(spark: SparkSession, d: str) -> DataFrame:
    return _history(spark, d)


@query(f"SELECT store_id, day_dt, count(*) AS n_items, min(item_code) AS first_item FROM ({_EVERY_STORE}) GROUP BY ALL", _PANEL_NEEDS)
def panel_future_theta(spark: SparkSession, d: str) -> DataFrame:
    return _by_store_day(_items(spark, d), lambda items: N.future_days_of_open_stores(items, t.store(spark, d), *EVERY_STORE_FUTURE, carried=["code"]))


@query(f"SELECT store_id, day_dt, count(*) AS n_items, min(item_code) AS first_item FROM ({_EVERY_STORE}) GROUP BY ALL", _PANEL_NEEDS)
def panel_future_sample(spark: SparkSession, d: str) -> DataFrame:
    sample = N.open_store_days(t.store(spark, d), *EVERY_STORE_FUTURE)
    return _by_store_day(_items(spark, d), lambda items: N.future_days_given(items, sample, carried=["code"]))


@query(f"SELECT store_id, day_dt, count(*) AS n_items, min(item_code) AS first_item FROM ({_FUTURE}) GROUP BY ALL", _PANEL_NEEDS)
def panel_future_assortment(spark: SparkSession, d: str) -> DataFrame:
    return _future(spark, d).groupBy("store_id", "day_dt").agg(F.count(F.lit(1)).alias("n_items"), F.min("item_code").alias("first_item"))


@query(
    f"""SELECT store_id, day_dt, weekday, day_type, is_5th, activity_desc, count(*) AS n_items, min(item_code) AS first_item
    FROM ({_PANEL}) LEFT JOIN calendar USING (day_dt) GROUP BY ALL""",
    _PANEL_NEEDS,
)
def panel_union_distinct(spark: SparkSession, d: str) -> DataFrame:
    return _panel(spark, d).groupBy("store_id", "day_dt", "weekday", "day_type", "is_5th", "activity_desc").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("item_code").alias("first_item")
    )


@query(
    f"""SELECT DISTINCT * FROM (SELECT item_code, day_dt, ttl_quantity FROM brand_daily
        UNION ALL SELECT item_code, day_dt, NULL FROM (SELECT DISTINCT item_code FROM brand_daily), calendar WHERE day_dt BETWEEN DATE '{FUTURE[0]}' AND DATE '{FUTURE[1]}')""",
    ("brand_daily", "calendar"),
)
def union_missing_columns(spark: SparkSession, d: str) -> DataFrame:
    daily = t.brand_daily(spark, d).select("item_code", "day_dt", "ttl_quantity")
    brands = daily.select("item_code").distinct()
    future = brands.select("item_code", F.explode(C.days_from(C.day(FUTURE[0]), C.day(FUTURE[1]))).alias("day_dt"))
    return N.stack_rows(daily, future)


_FLAGS = [*(f"prom{i}" for i in range(8)), "is_vip", "free_gift"]
_PROMO_DAYS = f"""SELECT p.item_code, p.day_dt, offer_code, osd_type, flag, {", ".join(f"coalesce({c}, 0) AS {c}" for c in [*_FLAGS, "p_rate"])},
        coalesce(required_num, 1) AS required_num, coalesce(retail_price, med) AS retail_price,
        coalesce(amount, retail_price, med) AS amount, coalesce(prom_price, retail_price, med) AS prom_price,
        coalesce(unit_price, prom_price, retail_price, med) AS unit_price
    FROM (SELECT DISTINCT item_code, day_dt FROM panel) p LEFT JOIN best b ON p.item_code = b.item AND p.day_dt = b.day_dt
    LEFT JOIN (SELECT panel.item_code, median(retail_price) AS med FROM panel LEFT JOIN best ON panel.item_code = item AND panel.day_dt = best.day_dt GROUP BY 1) m
      ON p.item_code = m.item_code"""
_FEATURES = f"""SELECT panel.item_code, panel.store_id, panel.day_dt, area_idnt, loc_wh, store_type, loc_selling_area, pds_grace, year, month, weekday, day_type, is_5th, activity_desc,
        s.ttl_quantity, item_desc, sbclass_desc, item_brand, {", ".join(f"f.{c}" for c in ["offer_code", "osd_type", "flag", *_FLAGS, "required_num", "retail_price", "amount", "prom_price", "unit_price", "p_rate"])}
    FROM (SELECT * FROM ({_PANEL}) LEFT JOIN calendar USING (day_dt)) panel JOIN store USING (store_id)
    LEFT JOIN sales_capped s ON s.item_code = panel.item_code AND s.store_id = panel.store_id AND s.day_dt = panel.day_dt
    LEFT JOIN product ON product.item_code = panel.item_code
    JOIN promo_days f ON f.item_code = panel.item_code AND f.day_dt = panel.day_dt WHERE panel.day_dt >= DATE '1996-01-01'"""
t.TABLES["panel"] = (_PANEL_NEEDS, f"SELECT pp.* FROM ({_PANEL}) pp JOIN store USING (store_id) WHERE day_dt IS NOT NULL")
t.TABLES["promo_days"] = (("panel", "best"), _PROMO_DAYS)
t.TABLES["sales_capped"] = (
    ("sales",),
    f"""SELECT item_code, store_id, day_dt, CASE WHEN ttl_quantity >= 40 THEN
        ceil(CASE WHEN s = 0 THEN 0 WHEN s > 0 AND ttl_quantity > s THEN s / n ELSE ttl_quantity END) ELSE ttl_quantity END AS ttl_quantity
    FROM (SELECT *, coalesce(sum(CASE WHEN ttl_quantity <= 40 THEN ttl_quantity END) OVER {_AROUND}, 0) AS s,
                 count(CASE WHEN ttl_quantity <= 40 THEN 1 END) OVER {_AROUND} AS n FROM sales)""",
)
_MONEY = ["retail_price", "amount", "prom_price", "unit_price", "p_rate"]


def feature_rows(
    spark: SparkSession, d: str, encode: tuple[str, ...] = (), code_map: DataFrame | None = None, offers: DataFrame | None = None, **more
) -> DataFrame:
    stores = t.store(spark, d).select("store_id", "area_idnt", "loc_wh", "store_type", "loc_selling_area", "pds_grace")
    inputs = FeatureInputs(
        panel=_panel_keys(spark, d),
        store=stores,
        sales=t.sales(spark, d, by_item=True).drop("ttl_amt_payment"),
        product=t.product(spark, d).drop("list_price"),
        offers=offers or stored_offers(spark, d),
        code_map=code_map,
        placed=True,
        calendar=t.calendar(spark).select("day_dt", "year", "month", "weekday", "day_type", "is_5th", "activity_desc"),
    )
    return build_features(inputs, *OFFER_SPAN, encode=encode, outlier_quantity=40, min_day="1996-01-01", **more)


t.TABLES["features"] = ((*_PANEL_NEEDS, "promo_days", "sales_capped", "product"), _FEATURES)


@query(
    f"""SELECT item_code, store_id, area_idnt, loc_wh, store_type, sbclass_desc, item_brand, count(*) AS n, sum(ttl_quantity) AS ttl_quantity,
        min(day_dt) AS first_day, count(offer_code) AS n_offer, max(offer_code) AS top_offer, min(osd_type) AS osd_type, max(flag) AS flag,
        {", ".join(f"sum({c}) AS {c}" for c in [*_FLAGS, "required_num"])}, {", ".join(f"{near_sql(f'avg({c})')} AS {c}" for c in _MONEY)}
    FROM features GROUP BY ALL""",
    ("features",),
)
def feature_table(spark: SparkSession, d: str) -> DataFrame:
    """The whole feature table, reported per item and store."""
    return (
        feature_rows(spark, d)
        .groupBy("item_code", "store_id", "area_idnt", "loc_wh", "store_type", "sbclass_desc", "item_brand")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("ttl_quantity").alias("ttl_quantity"),
            F.min("day_dt").alias("first_day"),
            F.count("offer_code").alias("n_offer"),
            F.max("offer_code").alias("top_offer"),
            F.min("osd_type").alias("osd_type"),
            F.max("flag").alias("flag"),
            *[F.sum(c).alias(c) for c in [*_FLAGS, "required_num"]],
            *[near(F.avg(c)).alias(c) for c in _MONEY],
        )
    )


@query(
    f"""SELECT f.item_code, f.day_dt, coalesce(n.num_items_in_offer, 100) AS num_items_in_offer, coalesce(a.day_of_prom, -1) AS day_of_prom,
        {near_sql('coalesce(u.unit_price2, f.unit_price)')} AS unit_price2,
        {near_sql('coalesce(greatest(1 - coalesce(u.unit_price2, f.unit_price) / nullif(f.retail_price, 0), 0), 0)')} AS p_rate2
    FROM promo_days f
    LEFT JOIN (SELECT offer_code, count(DISTINCT item) AS num_items_in_offer FROM offers GROUP BY offer_code) n USING (offer_code)
    LEFT JOIN (SELECT item, day_dt, min(day_dt - offer_start_date) AS day_of_prom FROM expanded GROUP BY ALL) a ON a.item = f.item_code AND a.day_dt = f.day_dt
    LEFT JOIN (SELECT item_code, day_dt, '1' AS area_idnt, max(ttl_amt_payment / ttl_quantity) AS unit_price2 FROM sales GROUP BY ALL) u
      ON u.item_code = f.item_code AND u.day_dt = f.day_dt""",
    ("promo_days", "offers", "expanded", "sales"),
)
def extra_features(spark: SparkSession, d: str) -> DataFrame:
    offers = stored_offers(spark, d)
    days = promotion_days(panel_rows(spark, d), offers, *OFFER_SPAN, placed=True).withColumn("area_idnt", F.lit("1"))
    actual = (
        t.sales(spark, d, by_item=True)
        .groupBy("item_code", "day_dt")
        .agg(F.max(F.col("ttl_amt_payment") / F.col("ttl_quantity")).alias("unit_price2"))
        .withColumn("area_idnt", F.lit("1"))
    )
    rows = add_offer_features(days, offers, actual, *OFFER_SPAN, placed=True)
    return rounded(
        rows.select("item_code", "day_dt", "num_items_in_offer", "day_of_prom", "unit_price2", "p_rate2"), "unit_price2", "p_rate2"
    )


@query(
    f"""SELECT p.item_code, p.day_dt, sum(s.ttl_quantity) AS ttl_quantity, {near_sql('avg(p.unit_price)')} AS unit_price,
        {near_sql('avg(p.p_rate)')} AS p_rate, count(s.store_id) AS n_sold
    FROM (SELECT item AS item_code, day_dt, unit_price, p_rate FROM best) p
    LEFT JOIN sales s ON s.item_code = p.item_code AND s.day_dt = p.day_dt GROUP BY ALL""",
    ("best", "sales"),
)
def promotion_sales_report(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: daily best offer of every item, joined to its sales, as a daily report.

    Offers and sales are placed by item while they are lines; days, sales and report stay there.
    """
    session = colocated_session(spark)
    best = promotion_calendar(stored_offers(session, d), *OFFER_SPAN, placed=True).select(F.col("item").alias("item_code"), "day_dt", "unit_price", "p_rate")
    joined = best.join(t.sales(session, d, by_item=True).hint("merge"), ["item_code", "day_dt"], "left")
    report = joined.groupBy("item_code", "day_dt").agg(
        F.sum("ttl_quantity").alias("ttl_quantity"),
        F.avg("unit_price").alias("unit_price"),
        F.avg("p_rate").alias("p_rate"),
        F.count("store_id").alias("n_sold"),
    )
    return rounded(report, "unit_price", "p_rate")
