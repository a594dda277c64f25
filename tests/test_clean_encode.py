import random
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.functions import scalar as X
from shelfwise.functions.dates import in_months
from shelfwise.functions.period_text import date_in_text, parse_period
from shelfwise.operators import clean as K
from shelfwise.operators import encode as E
from shelfwise.operators import narrow as R
from shelfwise.operators import stats as Q
from tests.conftest import rows


def d(text):
    return date.fromisoformat(text)


PERIODS = [
    ("0101-0228", "mmdd-mmdd", "2019-01-01", "2019-02-28", "ok"),
    ("02.02-03.30", "mm.dd-mm.dd", "2019-02-02", "2019-03-30", "ok"),
    ("20190102-20190807", "yyyymmdd-yyyymmdd", "2019-01-02", "2019-08-07", "ok"),
    ("228-528", "mdd-mdd", "2019-02-28", "2019-05-28", "ok"),
    ("2.28-3.12", "m.dd-m.dd", "2019-02-28", "2019-03-12", "ok"),
    ("2.28-12.1", "m.dd-mm.d", "2019-02-28", "2019-12-01", "ok"),
    ("12.1-1.12", "mm.d-m.dd", "2019-12-01", "2019-01-12", "end_before_start"),
    ("0230-0301", "mmdd-mmdd", None, None, "bad_date"),
    ("02/02-03.30", "mm.dd-mm.dd", "2019-02-02", "2019-03-30", "ok"),
    ("0101-0228 vip", None, None, None, "unknown_form"),
    ("", None, None, None, "unknown_form"),
    (None, None, None, None, "unknown_form"),
]


def test_period_texts(spark):
    table = spark.createDataFrame([(t,) for t, *_ in PERIODS], "txt string")
    parsed = parse_period(table, "txt", 2019)
    got = {r["txt"]: (r["period_form"], r["start_date"], r["end_date"], r["period_status"]) for r in parsed.collect()}
    assert got == {t: (f, a and d(a), b and d(b), s) for t, f, a, b, s in PERIODS}


def test_period_prefix_and_year_column(spark):
    table = spark.createDataFrame([("0101-0228 vip", 2021)], "txt string, y int")
    parsed = parse_period(table, "txt", F.col("y"), prefix=True)
    assert rows(parsed, "start_date", "end_date", "period_status") == [(d("2021-01-01"), d("2021-02-28"), "ok")]


def test_date_in_text(spark):
    table = spark.createDataFrame([("log 2020-01-02 a",), ("2020-13-01",), ("none",)], "txt string")
    assert rows(table.select(date_in_text("txt").alias("day")), "day") == [None, None, d("2020-01-02")]


def test_scalars(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c).first()[0]

    assert value(X.discount_rate(F.lit(3.0), F.lit(4.0))) == 0.25
    assert value(X.discount_rate(F.lit(5.0), F.lit(4.0))) == 0.0
    assert value(X.discount_rate(F.lit(None).cast("double"), F.lit(4.0))) == 0.0
    assert value(X.discount_rate(F.lit(1.0), F.lit(0.0))) == 0.0
    assert value(X.price_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert value(X.deal_price(F.lit(1.0), F.lit(0.0))) == 0.0
    assert value(X.at_least_zero(F.lit(-1.0))) == 0.0
    assert value(X.at_least_zero(F.lit(None).cast("double"))) is None
    assert [value(X.fold_year(F.lit(y))) for y in (2019, 2020, 2021, 2022)] == [2019, 2020, 2020, 2022]
    assert [value(X.id_text(F.lit(v))) for v in (12.0, 12, "12", "12.0", " 12 ")] == ["12"] * 5
    assert [value(X.id_text(F.lit(v))) for v in ("012", "12.7", "A-7", 1.5e10, None)] == ["012", "12.7", "A-7", "15000000000", None]
    assert [value(X.number_or_null(F.lit(v))) for v in ("1.5", "x", "NaN", "inf", "")] == [1.5, None, None, None, None]
    assert [value(X.date_or_null(F.lit(v))) for v in ("2020-02-29", "2021-02-29", "soon")] == [d("2020-02-29"), None, None]
    assert value(X.store_key(F.lit(None).cast("string"), F.lit(7), F.lit(8))) == "7"


def test_months(spark):
    days = spark.createDataFrame([(d("2019-12-31"),), (d("2020-01-01"),), (d("2020-03-31"),), (d("2020-04-01"),)], "day_dt date")
    assert rows(K.drop_months(days)) == [d("2019-12-31"), d("2020-04-01")]
    assert rows(K.drop_span(days)) == [d("2019-12-31")]
    assert rows(days.where(in_months("day_dt", ["2019-12"]))) == [d("2019-12-31")]


def test_month_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.createDataFrame([(d("2020-02-01"), 1)], "day_dt date, v int").write.parquet(path)
    plan = K.drop_months(spark.read.parquet(path)).select("v")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "2020-01-01" in plan.split("PushedFilters")[1]


def test_value_maps_do_not_chain(spark):
    data = spark.createDataFrame([("B1/F", " Inline+inmall", "高级"), ("B1", "Inmall", "other"), (None, None, None)], "pds_floor_type string, pds_location_type_en string, pds_grace string")
    assert rows(K.map_values(data)) == [(None, None, None), ("B/1", "inmall", "other"), ("B1", "inline+inmall", "Premium")]


def test_physical_stores(spark):
    data = spark.createDataFrame(
        [("1", "N", "S", None, "1"), ("2", "Y", "S", None, "1"), ("3", "N", "W", None, "1"), ("4", "N", "S", d("2020-01-01"), "1"), ("5", "N", "S", None, "5"), ("6", None, "S", None, "1")],
        "store_id string, is_e_store string, loc_type_cde string, loc_end_dt date, area_idnt string",
    )
    assert rows(K.physical_stores(data), "store_id") == ["1"]
    houses = spark.createDataFrame([("1", None), ("2", "w")], "store_id string, loc_wh string")
    assert rows(K.stores_with_warehouse(houses), "store_id") == ["2"]


def test_constants_and_area(spark):
    data = spark.createDataFrame(
        [("1", "mall", 10.0, None), ("1", "mall", None, 2.0), ("1", "mall", 30.0, 1.0), ("2", "mall", None, 1.0), ("1", None, None, 1.0), ("1", None, 8.0, 1.0)],
        "item_code string, store_type string, loc_selling_area double, ttl_quantity double",
    )
    filled = K.fill_selling_area(data)
    assert rows(filled, "item_code", "store_type", "loc_selling_area") == [("1", None, 8.0), ("1", None, 8.0), ("1", "mall", 10.0), ("1", "mall", 20.0), ("1", "mall", 30.0), ("2", "mall", None)]
    constant = K.fill_constants(data, "No_data")
    assert rows(constant, "store_type").count("No_data") == 2
    assert 0.0 in rows(constant, "ttl_quantity")


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_median_against_pandas(spark, seed):
    pick = random.Random(seed)
    data = [(pick.choice(["hot", "hot", "hot", "a", None]), pick.choice([None, float("nan"), pick.uniform(-5, 5), pick.uniform(0, 1e6), 7.0, -0.0]), pick.randrange(1, 4)) for _ in range(600)] + [("empty", None, 1)]
    table = spark.createDataFrame(data, "k string, v double, w int")
    frame = pd.DataFrame(data, columns=["k", "v", "w"])
    expected = frame.groupby("k", dropna=False).v.median().dropna()
    got = {r["k"]: r["median"] for r in Q.exact_median(table, ["k"], "v").collect()}
    assert {k if isinstance(k, str) else None: v for k, v in expected.items()} == pytest.approx(got)
    heavy = frame.loc[frame.index.repeat(frame.w)].groupby("k", dropna=False).v.median().dropna()
    got = {r["k"]: r["median"] for r in Q.exact_median(table, ["k"], "v", "w").collect()}
    assert {k if isinstance(k, str) else None: v for k, v in heavy.items()} == pytest.approx(got)


@pytest.mark.parametrize("partitions", ["1", "8", "300"])
def test_ordinal_codes(spark, partitions):
    words = sorted({f"{random.Random(i).randrange(10**6)}" for i in range(700)})
    table = spark.createDataFrame([(w,) for w in [*words, *words[:50]]] + [(None,)], "w string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        codes = {r["w"]: r["code"] for r in E.ordinal_codes(table, "w").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert codes == {w: i for i, w in enumerate(words)}


def test_label_encode_is_fitted_on_training(spark):
    train = spark.createDataFrame([("b", 1), ("a", 2), ("c", 3)], "w string, n int")
    test = spark.createDataFrame([("c", 1), ("zz", 2), (None, 3)], "w string, n int")
    one, two = E.label_encode(train, ["w"], test)
    assert rows(one, "n", "w") == [(1, 1), (2, 0), (3, 2)]
    assert rows(two, "n", "w") == [(1, 2), (2, 3), (3, 3)]


def test_one_hot(spark):
    table = spark.createDataFrame([(2019,), (2021,)], "year int")
    assert rows(E.one_hot(table, "year", [2019, 2020])) == [(0, 0), (1, 0)]


def test_narrow_types_keep_nulls(spark):
    table = spark.createDataFrame([(1, 300.0, 0.5, None, "x"), (-128, None, -0.5, 2**40, "y"), (127, 2.0, None, 1, "z")], "a long, b double, c double, e long, s string")
    narrow = R.narrow_types(table)
    assert narrow.dtypes == [("a", "tinyint"), ("b", "smallint"), ("c", "float"), ("e", "bigint"), ("s", "string")]
    assert rows(narrow, "b").count(None) == 1
    # fractions of opposite sign must not cancel
    assert {r["column_name"]: r["n_fractional"] for r in R.type_profile(table).collect()}["c"] == 2


def test_quality_reports(spark):
    table = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    assert rows(Q.duplicate_keys(table, ["k", "v"])) == [("a", 1, 2)]
    assert dict(rows(Q.null_shares(table))) == pytest.approx({"k": 0.0, "v": 1 / 3})
    assert [tuple(r) for r in Q.value_counts(table, "k").collect()] == [("a", 2), ("b", 1)]
    shares = Q.nonzero_share(spark.createDataFrame([("a", 0.0), ("a", 2.0), ("b", None)], "item_code string, ttl_quantity double"))
    assert rows(shares) == [("a", 0.5), ("b", 0.0)]
    shards = spark.range(1000).select(Q.shard_of(F.col("id").cast("string"), 18).alias("shard")).groupBy("shard").count()
    assert shards.count() == 18 and shards.agg(F.max("count")).first()[0] < 100
