import math
import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from shelfwise.operators import calendar as C
from shelfwise.operators import prices as P
from shelfwise.operators import sales as S
from shelfwise.plans.low_sales import low_sales_table
from tests.conftest import rows

DAY = date(2020, 5, 1)


def sales(spark, data):
    return spark.createDataFrame([(i, s, DAY + timedelta(days=n - 1), float(q) if q is not None else None) for i, s, n, q in data], "item_code string, store_id string, day_dt date, ttl_quantity double")


def test_outlier_repair_cases(spark):
    data = sales(spark, [("1", "1", 1, 300), ("1", "1", 3, 10), ("1", "1", 8, 20), ("1", "1", 9, 30), ("1", "2", 1, 500), ("1", "3", 1, 200), ("1", "4", 1, None)])
    repaired = {(r["store_id"], r["day_dt"].day): r["ttl_quantity"] for r in S.repair_outliers(data).collect()}
    assert repaired == {("1", 1): 15, ("1", 3): 10, ("1", 8): 20, ("1", 9): 30, ("2", 1): 0, ("3", 1): 200, ("4", 1): None}


def test_outlier_repair_against_brute_force(spark):
    pick = random.Random(5)
    data = [(i, s, n, pick.choice([0, 3, 40.5, 199, 200, 201, 900])) for i in "ab" for s in "xyz" for n in range(1, 60) if pick.random() < 0.5]
    expected = {}
    for i, s, n, q in data:
        near = [p for j, u, m, p in data if (j, u) == (i, s) and abs(m - n) <= 7 and p <= 200]
        value = q
        if q >= 200:
            if sum(near) == 0 or q > sum(near):
                value = sum(near) / len(near) if near else 0
            value = math.ceil(value)
        expected[(i, s, n)] = value
    got = {(r[0], r[1], (r[2] - DAY).days + 1): r[3] for r in S.repair_outliers(sales(spark, data)).select("item_code", "store_id", "day_dt", "ttl_quantity").collect()}
    assert got == expected


def transactions(spark, data):
    return spark.createDataFrame(
        [("1", datetime(2020, 5, n, 13), date(2020, 5, n), *keys, channel, q, a, p) for n, keys, channel, q, a, p in data],
        "prd_id string, transaction_date timestamp_ntz, work_date date, deliver_storeid string, order_store long, loc_idnt long, channel string, quantity double, amountofsales double, amt_payment double",
    )


def lookups(spark):
    channels = spark.createDataFrame([("web",)], "channel string")
    stores = spark.createDataFrame([("5", "1"), ("6", "1"), ("7", "2")], "store_id string, area_idnt string")
    return channels, stores


def test_daily_sales(spark):
    data = transactions(
        spark,
        [
            (1, ("5", 6, 7), "web", 2.0, 10.0, 8.0),
            (1, (None, 5, 7), "web", 1.0, 7.0, 4.0),
            (1, (None, None, 7), "web", 1.0, 7.0, 4.0),
            (1, ("5", None, None), "shop", 2.0, 10.0, 8.0),
            (1, ("9", None, None), "web", 2.0, 10.0, 8.0),
            (1, ("5", None, None), "web", 50.0, 10.0, 8.0),
            (1, ("5", None, None), "web", 0.0, 10.0, 8.0),
            (1, ("5", None, None), "web", 1.0, 10.0, 3000.0),
        ],
    )
    got = rows(S.daily_sales(data, *lookups(spark)), "store_id", "ttl_quantity", "avg_amountofsales", "ttl_amt_payment")
    assert got == [("5", 3.0, 17.0 / 3, 12.0), ("7", 1.0, 7.0, 4.0)]


def test_modal_price_and_mean(spark):
    loc = (None, None, 5)
    data = transactions(
        spark,
        [(1, loc, "web", 2.0, 0.0, 6.0), (1, loc, "web", 1.0, 0.0, 3.0), (1, loc, "web", 3.0, 0.0, 6.0), (1, (None, None, 7), "web", 1.0, 0.0, 5.004)],
    )
    _, stores = lookups(spark)
    points = P.price_points(data, stores)
    assert rows(P.modal_price(points), "area_idnt", "unit_price2") == [("1", 2.0), ("2", 5.0)]
    assert rows(P.actual_prices(data, stores), "unit_price") == [3.5]


def test_actual_price_overrides(spark):
    plan = spark.createDataFrame([("1", "1", DAY, 5.0, 10.0), ("2", "1", DAY, 6.0, 0.0)], "item_code string, area_idnt string, day_dt date, unit_price double, retail_price double")
    actual = spark.createDataFrame([("1", "1", DAY, 4.0)], "item_code string, area_idnt string, day_dt date, unit_price2 double")
    assert rows(P.override_price(plan, actual), "item_code", "unit_price") == [("1", 4.0), ("2", 6.0)]
    both = rows(P.with_actual_price(plan, actual), "item_code", "unit_price", "unit_price2", "p_rate2")
    assert both == [("1", 5.0, 4.0, 0.6), ("2", 6.0, 6.0, 0.0)]


def test_max_price_fill(spark):
    data = spark.createDataFrame([("1", 1.0), ("1", 3.0), ("1", None), ("2", None)], "item_code string, unit_price double")
    assert rows(P.fill_with_max_price(data)) == [("1", 1.0), ("1", 3.0), ("1", 3.0), ("2", None)]


def test_low_sales_table(spark):
    data = transactions(spark, [(1, ("5", None, 5), "web", 2.0, 10.0, 8.0), (4, ("5", None, 5), "web", 1.0, 10.0, 6.0)])
    calendar = spark.createDataFrame([(date(2020, 5, 2), 3, 1)], "day_dt date, day_type int, is_5th int")
    table = low_sales_table(data, *lookups(spark), calendar, "2020-05-05", "2020-04-01")
    got = rows(table, "day_dt", "ttl_quantity", "unit_price", "weekday", "day_type", "is_5th")
    assert [(r[0].day, *r[1:]) for r in got] == [(1, 2.0, 4.0, 4, 0, 0), (2, 0.0, 6.0, 5, 3, 1), (3, 0.0, 6.0, 6, 0, 0), (4, 1.0, 6.0, 0, 0, 0), (5, 0.0, 6.0, 1, 0, 0)]


def test_span_after_its_end_is_empty(spark):
    series = spark.createDataFrame([("1", date(2020, 5, 1), 1.0), ("2", date(2020, 6, 1), 1.0)], "item_code string, day_dt date, ttl_quantity double")
    dense = C.dense(C.day_spans(series, "2020-05-03", "2020-01-01"), series)
    assert rows(dense, "item_code").count("1") == 3
    assert rows(dense, "item_code").count("2") == 0


def test_dense_days_are_made_beside_their_facts(spark):
    facts = spark.createDataFrame(
        [("a", "2020-01-02", 2.0, 5.0), ("a", "2020-01-04", None, 6.0), ("a", "2020-02-01", 9.0, None), ("b", None, 1.0, 1.0), (None, "2020-01-02", 3.0, 1.0)],
        "item_code string, day_dt string, ttl_quantity double, unit_price double",
    ).withColumn("day_dt", F.col("day_dt").cast("date"))
    spans = spark.createDataFrame(
        [("a", "2020-01-01", "2020-01-04", 7), ("b", "2020-01-01", "2020-01-01", 8), (None, "2020-01-02", "2020-01-02", 9), ("c", "2020-01-03", "2020-01-02", 1)],
        "item_code string, _first string, _last string, n int",
    ).withColumns({c: F.col(c).cast("date") for c in ("_first", "_last")})
    dense = C.dense(spans, facts)
    assert rows(dense.withColumn("day_dt", F.col("day_dt").cast("string"))) == [
        (None, "2020-01-02", 9, 0.0, None),
        ("a", "2020-01-01", 7, 0.0, None),
        ("a", "2020-01-02", 7, 2.0, 5.0),
        ("a", "2020-01-03", 7, 0.0, None),
        ("a", "2020-01-04", 7, 0.0, 6.0),
        ("b", "2020-01-01", 8, 0.0, None),
    ]
    plan = dense.groupBy("item_code", "day_dt").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Generate explode")[0]
