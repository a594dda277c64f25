import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfwise.constants import OFFER_COLUMNS, PROMOTION_FLAGS, PROMOTION_LABELS
from shelfwise.operators import offers as O
from tests.conftest import rows

SCHEMA = "item string, offer_code string, offer_start_date date, offer_end_date date, unit_price double, retail_price double, label string, z int"


def d(text):
    return date.fromisoformat(text)


def offers(spark, *data):
    return spark.createDataFrame([(i, c, d(a), d(b), u, r, lab, z) for i, c, a, b, u, r, lab, z in data], SCHEMA)


def test_first_non_null_per_column(spark):
    two = offers(
        spark,
        ("1", "10", "2020-01-01", "2020-01-01", 1.0, 4.0, None, 7),
        ("1", "11", "2020-01-01", "2020-01-01", 2.0, 4.0, "b", 8),
    )
    best = O.promotion_calendar(two, "2020-01-01", "2020-01-31")
    assert rows(best, "unit_price", "label", "z", "p_rate") == [(1.0, "b", 7, 0.75)]
    whole = O.promotion_calendar(two, "2020-01-01", "2020-01-31", whole_row=True)
    assert rows(whole, "unit_price", "label", "z") == [(1.0, None, 7)]


def test_missing_price_never_wins_and_ties_go_by_code(spark):
    data = offers(
        spark,
        ("1", "9", "2020-01-01", "2020-01-02", None, 4.0, "no price", 1),
        ("1", "b", "2020-01-01", "2020-01-02", 3.0, 4.0, "later code", 2),
        ("1", "a", "2020-01-01", "2020-01-02", 3.0, 4.0, "first code", 3),
    )
    best = O.promotion_calendar(data, "2020-01-01", "2020-01-01")
    assert rows(best, "day_dt", "offer_code", "label", "z") == [(d("2020-01-01"), "a", "first code", 3)]


def test_discount_is_clamped(spark):
    data = offers(spark, ("1", "1", "2020-01-01", "2020-01-01", 5.0, 4.0, "x", 1), ("2", "2", "2020-01-01", "2020-01-01", 5.0, 0.0, "x", 1))
    assert rows(O.promotion_calendar(data, "2020-01-01", "2020-01-01"), "p_rate") == [0.0, 0.0]


def test_horizon_clips_and_reversed_offers_vanish(spark):
    data = offers(
        spark,
        ("1", "1", "2019-12-30", "2020-01-02", 1.0, 2.0, "x", 1),
        ("1", "2", "2020-01-05", "2020-01-03", 1.0, 2.0, "x", 1),
        ("1", "3", "2020-01-09", "2030-01-01", 1.0, 2.0, "x", 1),
    )
    days = rows(O.expand_offers(data, "2020-01-01", "2020-01-10"), "offer_code", "day_dt")
    assert days == [("1", d("2020-01-01")), ("1", d("2020-01-02")), ("3", d("2020-01-09")), ("3", d("2020-01-10"))]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("whole_row", [False, True])
def test_stretches_give_the_same_days_as_expanding_every_offer(spark, seed, whole_row):
    pick = random.Random(seed)
    data = []
    for code in range(120):
        start = d("2020-01-01") + timedelta(days=pick.randrange(60))
        end = start + timedelta(days=pick.randrange(-2, 15))
        price = pick.choice([None, 1.0, 2.0, 3.0])
        data.append((pick.choice(["hot", "hot", "a", "b"]), str(code), str(start), str(end), price, 4.0, pick.choice([None, "x", "y"]), code))
    table = offers(spark, *data).withColumn("p_rate", O.discount_rate_or_null())
    horizon = ("2020-01-05", "2020-02-20")
    expected = O.best_offer(O.expand_offers(table, *horizon), ["item", "day_dt"], whole_row)
    got = O.promotion_calendar(offers(spark, *data), *horizon, whole_row=whole_row)
    columns = ["item", "day_dt", "offer_code", "unit_price", "label", "z", "offer_start_date", "p_rate"]
    assert rows(got, *columns) == rows(expected, *columns)
    assert got.count() == got.select("item", "day_dt").distinct().count()


def test_promotion_age(spark):
    data = offers(
        spark,
        ("1", "1", "2020-01-01", "2020-01-04", 1.0, 2.0, "x", 1),
        ("1", "2", "2020-01-03", "2020-01-05", 1.0, 2.0, "x", 1),
    )
    everything = rows(O.promotion_age(data, overlap="all"), "day_dt", "day_of_prom")
    assert len(everything) == 7
    latest = dict(rows(O.promotion_age(data), "day_dt", "day_of_prom"))
    assert [latest[d(f"2020-01-0{i}")] for i in range(1, 6)] == [0, 1, 0, 1, 2]
    clipped = dict(rows(O.promotion_age(data, horizon=("2020-01-02", "2020-01-03")), "day_dt", "day_of_prom"))
    assert clipped == {d("2020-01-02"): 1, d("2020-01-03"): 0}
    with pytest.raises(ValueError):
        O.promotion_age(data, overlap="first")


def test_offer_size_and_fill(spark):
    data = offers(
        spark,
        ("1", "7", "2020-01-01", "2020-01-01", 1.0, 2.0, "x", 1),
        ("1", "7", "2020-02-01", "2020-02-01", 1.0, 2.0, "x", 1),
        ("2", "7", "2020-01-01", "2020-01-01", 1.0, 2.0, "x", 1),
    )
    assert rows(O.offer_size(data)) == [("7", 3)]
    assert rows(O.offer_size(data, distinct=True)) == [("7", 2)]
    panel = spark.createDataFrame([("1", d("2020-01-01"), "7"), ("1", d("2020-01-02"), None), ("1", d("2020-01-03"), "8")], "item_code string, day_dt date, offer_code string")
    sized = O.with_offer_size(panel, O.offer_size(data))
    assert rows(sized, "offer_code", "num_items_in_offer") == [(None, 100), ("7", 3), ("8", 100)]


def test_ingest_coerces_and_rejects(spark):
    wide = {c: "x" for c in [*PROMOTION_LABELS, "is_vip", "free_gift", "osd_type", "outputs", "flag", "unit_price", "required_num", "amount", "prom_price", "retail_price"]}
    good = wide | {"item": "12.0", "offer_code": "7.0", "offer_start_date": "2020-01-01", "offer_end_date": "2020-01-02", "label_003": "1", "unit_price": "2.5", "amount": "inf"}
    bad_date = good | {"offer_end_date": "soon"}
    no_item = good | {"item": None}
    raw = spark.createDataFrame([good, bad_date, no_item], ", ".join(f"{c} string" for c in good))
    offers_ = O.ingest_offers(raw)
    assert offers_.columns == OFFER_COLUMNS
    row = offers_.collect()
    assert len(row) == 1
    assert (row[0]["item"], row[0]["offer_code"], row[0]["prom2"], row[0]["unit_price"], row[0]["amount"], row[0]["prom0"]) == ("12", "7", 1.0, 2.5, None, None)
    assert set(PROMOTION_FLAGS) <= set(offers_.columns)


def test_same_offer_items(spark):
    data = spark.createDataFrame(
        [("1", d("2020-01-01"), d("2020-01-05"), 1), ("1", d("2021-01-01"), d("2021-01-05"), 1), ("2", d("2021-01-01"), d("2021-01-05"), 1), ("3", d("2020-01-01"), d("2020-01-05"), 1), ("3", d("2021-01-01"), d("2021-01-05"), 0)],
        "item string, offer_start_date date, offer_end_date date, prom1 int",
    )
    members = spark.createDataFrame([("1",), ("2",), ("3",)], "item string")
    found = O.same_offer_items(data, "prom1", ("2021-01-01", "2021-02-01"), ("2020-01-01", "2020-12-31"), members)
    assert rows(found) == ["1"]
    assert rows(O.same_offer_items(data, "prom1", ("2021-01-01", "2021-02-01"), ("2020-01-01", "2020-12-31"), members.where(F.col("item") == "2"))) == []


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _many_offers(spark):
    return spark.range(400).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 20 as string)) AS item", "cast(id % 50 as string) AS offer_code",
        "date_add(date'2020-01-01', cast(id * 7 % 60 as int)) AS offer_start_date", "date_add(date'2020-01-01', cast(id * 7 % 60 + id % 9 as int)) AS offer_end_date",
        "if(id % 4 = 0, null, cast(id % 13 as double)) AS unit_price", "if(id % 5 = 0, null, 20.0D) AS retail_price", "if(id % 6 = 0, null, cast(id as string)) AS flag",
    )


def test_stretches_are_placed_once_by_item(spark):
    table = _many_offers(spark)
    with_edges = O.offer_segments(table)
    assert _exchanges(O.best_offer(with_edges, ["item", *O.SEGMENT])) == _exchanges(with_edges)


def test_a_hot_item_gives_the_same_best_offers(spark, monkeypatch):
    table = _many_offers(spark)
    plain = rows(O.promotion_calendar(table, "2020-01-01", "2020-03-31"))
    ages = rows(O.promotion_age(table))
    monkeypatch.setattr(O, "HOT_OFFERS", 50)
    assert rows(O.promotion_calendar(table, "2020-01-01", "2020-03-31")) == plain
    assert rows(O.promotion_age(table)) == ages


def test_days_of_offers_are_counted_where_they_are_made(spark):
    table = _many_offers(spark)
    expanded = O.expand_offers(table, "2020-01-01", "2020-03-31")
    assert _exchanges(expanded.groupBy("item", "offer_code", "day_dt").count()) == 1
    assert _exchanges(O.promotion_age(table, overlap="all").groupBy("item", "day_dt", "day_of_prom").count()) == 1


def test_a_day_takes_the_stretch_that_holds_it(spark):
    table = _many_offers(spark).unionByName(_many_offers(spark).limit(1).withColumn("item", F.lit(None).cast("string")))
    days = spark.range(0, 110).selectExpr("date_add(date'2019-12-20', cast(id as int)) AS day_dt").crossJoin(
        spark.createDataFrame([("hot",), ("1",), ("none",), (None,)], "item_code string")
    ).select("item_code", "day_dt")
    days = days.unionByName(spark.sql("SELECT '1' AS item_code, CAST(NULL AS date) AS day_dt"))
    span = ("2020-01-01", "2020-03-31")
    expected = days.join(O.promotion_calendar(table, *span).withColumnRenamed("item", "item_code"), ["item_code", "day_dt"], "left")
    got = O.with_stretch_of_day(days, O.promotion_stretches(table, *span))
    assert rows(got, *expected.columns) == rows(expected)
