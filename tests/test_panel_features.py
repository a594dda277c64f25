import itertools
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfwise.operators import calendar as C
from shelfwise.operators import lookup as L
from shelfwise.operators import panel as N
from shelfwise.operators.offers import (
    promotion_age,
    promotion_calendar,
    promotion_stretches,
    stored_by_item,
    with_offer_size,
    with_offer_size_of_item,
    with_stretch_of_day,
)
from shelfwise.operators.split import Splits
from shelfwise.operators.stats import fill_with_median
from shelfwise.plans.alerts import alert_rows, feature_checks, write_with_alerts
from shelfwise.plans.features import FeatureInputs, add_offer_features, build_features, promotion_days
from shelfwise.plans.pooled import pooled_items, pooled_rows, pooled_sets
from shelfwise.plans.settings import ForecastSettings
from shelfwise.session import stage_by_item
from shelfwise.sources.readers import colocated_session
from tests.conftest import rows


def d(text):
    return date.fromisoformat(text)


def test_every_pair_is_the_whole_product(spark):
    items = spark.createDataFrame([(str(i),) for i in range(40)], "item_code string")
    stores = spark.createDataFrame([(str(s),) for s in range(30)], "store_id string")
    pairs = L.every_pair(items, stores, "store_id")
    assert rows(pairs, "item_code", "store_id") == sorted(itertools.product(map(str, range(40)), map(str, range(30))))


def test_spread_join_keeps_each_row_once(spark):
    left = spark.createDataFrame([("hot", i) for i in range(500)] + [("cold", 1), ("alone", 2)], "k string, v int")
    right = spark.createDataFrame([("hot", "h"), ("cold", "c")], "k string, w string")
    joined = L.spread_join(left, right, "k", ["v"])
    assert joined.count() == 501
    assert joined.where("k = 'hot'").select("v").distinct().count() == 500


def test_panel(spark):
    calendar = C.calendar_days(spark, "2020-01-06", "2020-01-19").drop("year")
    plan = spark.createDataFrame([("1", d("2020-01-06"), "5"), ("1", d("2020-01-06"), "5"), ("1", d("2020-01-13"), "6")], "item_idnt string, wk_idnt date, loc_idnt string")
    stores = spark.createDataFrame([("5", d("2020-01-10")), ("6", d("2020-01-18")), ("7", None), ("8", d("2020-01-30"))], "store_id string, loc_start_dt date")
    items = spark.createDataFrame([("1",), ("2",)], "item_code string")
    open_days = N.open_store_days(stores, "2020-01-18", "2020-01-19")
    assert rows(open_days) == [("5", d("2020-01-18")), ("5", d("2020-01-19")), ("6", d("2020-01-19"))]
    future = N.future_days_of_open_stores(items, stores, "2020-01-18", "2020-01-19")
    assert rows(future) == rows(N.future_days_given(items, open_days))
    panel = N.base_panel(N.shelf_plan_days(plan, calendar), future, calendar, "2020-01-18")
    # two planned weeks and six future rows, one of which (item 1, store 6, the 19th) was planned already
    assert panel.count() == 7 + 7 + 6 - 1
    assert panel.select(*N.PANEL_KEYS).distinct().count() == panel.count()
    assert rows(panel.where("day_dt = '2020-01-18' AND item_code = '2'"), "store_id", "weekday", "is_weekend") == [("5", 5, 1)]


def test_stack_rows(spark):
    a = spark.createDataFrame([("1", 2.0), ("1", 2.0)], "item_code string, q double")
    b = spark.createDataFrame([("1",)], "item_code string")
    assert rows(N.stack_rows(a, b)) == [("1", None), ("1", 2.0)]
    assert N.shared_columns(a, ["q", "zone", "item_code"]) == ["q", "item_code"]


def test_dictionary_encode(spark):
    codes = spark.createDataFrame([("store_id", "S1", "1"), ("store_type", "T", "mall")], "code_type string, key_id string, value_id string")
    data = spark.createDataFrame([(1, "mall"), (2, "street")], "store_id int, store_type string")
    coded = L.dictionary_encode(data, codes, ["store_id", "store_type", "missing"])
    assert coded.columns == ["store_id_new", "store_type_new"]
    assert rows(coded) == [(None, None), ("S1", "T")]


def test_dictionary_maps_are_the_joins(spark):
    codes = spark.createDataFrame(
        [("store_id", "S1", "1"), ("store_type", "T", "mall"), ("twice", "A", "x"), ("twice", "B", "x"), ("many", "M7", "7"), *[("many", f"M{i}", str(100 + i)) for i in range(300)], ("store_type", "N", None)],
        "code_type string, key_id string, value_id string",
    )
    data = spark.createDataFrame([(1, "mall", "x", 7, "q", 3), (2, "street", None, 399, None, 4), (None, None, "y", 5, "q", 5)], "store_id int, store_type string, twice string, many int, uncoded string, n int")
    features = ["store_id", "store_type", "twice", "many", "uncoded", "missing"]
    mapped = L.dictionary_encode_by_maps(data, codes, features)
    assert rows(mapped, *sorted(mapped.columns)) == rows(L.dictionary_encode(data, codes, features), *sorted(mapped.columns))
    # few codes with one value each need no join; a value with two codes and a long list of codes do
    few = L.dictionary_encode_by_maps(data, codes, ["store_id", "store_type", "uncoded"])
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan.split("Subquery")[0] and few.count() == 3
    assert L.dictionary_encode_by_maps(data, codes, features)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2


def test_alerts_come_with_the_write(spark, tmp_path):
    table = spark.createDataFrame([("1", 2.0, None), ("2", None, None), ("3", None, "x")], "item_code string, ttl_quantity double, offer_code string")
    checks = feature_checks(["item_code", "offer_code"])
    got = write_with_alerts(table, str(tmp_path / "t"), checks, ["offer_code", "zone_id"])
    assert got == {"n_rows": 3, "n_matched": 1, "nothing_matched": 0, "missing_item_code": 0, "missing_offer_code": 2, "absent_columns": 1}
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == rows(table)
    assert dict(rows(alert_rows(spark, got)))["n_matched"] == 1
    none = write_with_alerts(table.limit(0), str(tmp_path / "none"), checks)
    assert (none["n_rows"], none["nothing_matched"], none["absent_columns"]) == (0, 1, 0)


def test_all_pooled_sets_are_those_of_each_subclass(spark):
    kinds = ["prom0", "prom1"]
    offers = [("a", 1, 0, "2020-02-01"), ("a", 1, 1, "2020-04-02"), ("b", 0, 1, "2020-02-01"), ("b", 0, 1, "2020-04-02"), ("c", 1, None, "2020-04-02"), ("c", 1, 1, "2020-04-02")]
    table = spark.createDataFrame([(i, float(x), None if y is None else float(y), d(t), d(t)) for i, x, y, t in offers], "item string, prom0 double, prom1 double, offer_start_date date, offer_end_date date")
    products = spark.createDataFrame([("a", "cream"), ("b", "cream"), ("b", "soap"), ("c", "soap")], "item_code string, sbclass_desc string")
    settings = ForecastSettings(splits=Splits("2020-01-01", ("2020-03-01", "2020-03-10"), ("2020-03-11", "2020-03-20"), ("2020-04-01", "2020-04-10")))
    sets = pooled_sets(table, products, kinds, settings)
    assert rows(sets) == [("cream", "prom0", "a"), ("cream", "prom1", "b")]
    for sbclass in ("cream", "soap"):
        for kind in kinds:
            assert rows(pooled_items(table, products, sbclass, kind, settings)) == rows(sets.where((F.col("sbclass_desc") == sbclass) & (F.col("kind") == kind)), "item_code")
    assert rows(pooled_rows(spark.createDataFrame([("a", 1), ("z", 2)], "item_code string, v int"), sets), "kind", "v") == [("prom0", 1)]


def test_match_flag(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,)], "k int")
    flagged = L.with_match_flag(left, right, ["k"])
    assert rows(flagged) == [(1, 1), (2, 0)]
    assert rows(L.match_report(flagged)) == [(2, 1, 0)]
    assert rows(L.match_report(L.with_match_flag(left, right.where("k > 5"), ["k"]))) == [(2, 0, 1)]


def feature_inputs(spark):
    days = [d("2020-01-01") + timedelta(days=i) for i in range(6)]
    panel = spark.createDataFrame([("1", s, day) for s in ("5", "6") for day in days] + [("1", "9", days[0])], "item_code string, store_id string, day_dt date")
    store = spark.createDataFrame([("5", "1", "north"), ("6", "2", "south")], "store_id string, area_idnt string, loc_wh string")
    sales = spark.createDataFrame([("1", "5", days[0], 300.0), ("1", "5", days[1], 4.0)], "item_code string, store_id string, day_dt date, ttl_quantity double")
    product = spark.createDataFrame([("1", "soap")], "item_code string, item_desc string")
    flags = {f"prom{i}": 0.0 for i in range(8)} | {"is_vip": 0.0, "free_gift": 0.0}
    base = {"item": "1", "osd_type": None, "outputs": None, "required_num": None, "amount": None, "prom_price": None, "flag": None} | flags
    offers = spark.createDataFrame(
        [
            base | {"offer_code": "7", "offer_start_date": days[1], "offer_end_date": days[3], "unit_price": 8.0, "retail_price": 10.0, "prom1": 1.0},
            base | {"offer_code": "8", "offer_start_date": days[3], "offer_end_date": days[4], "unit_price": 6.0, "retail_price": 12.0},
        ],
        "item string, offer_code string, offer_start_date date, offer_end_date date, osd_type string, outputs string, flag string, unit_price double, retail_price double, required_num double, amount double, prom_price double, "
        + ", ".join(f"{f} double" for f in flags),
    )
    return FeatureInputs(panel, store, sales, product, offers)


def test_feature_table(spark):
    inputs = feature_inputs(spark)
    table = build_features(inputs, "2020-01-01", "2020-01-31", min_day="2020-01-01").cache()
    # store 9 is unknown; every left join keeps the number of rows
    assert table.count() == 12
    north = {r["day_dt"].day: r for r in table.where("store_id = '5'").collect()}
    assert north[1]["ttl_quantity"] == 4.0
    assert north[3]["ttl_quantity"] is None
    # retail price: offer 7 on the 2nd and 3rd, offer 8 (cheaper) on the 4th and 5th; the median fills the rest
    assert [north[i]["retail_price"] for i in range(1, 7)] == [11.0, 10.0, 10.0, 12.0, 12.0, 11.0]
    assert [north[i]["unit_price"] for i in range(1, 7)] == [11.0, 8.0, 8.0, 6.0, 6.0, 11.0]
    assert [round(north[i]["p_rate"], 9) for i in range(1, 7)] == [0.0, 0.2, 0.2, 0.5, 0.5, 0.0]
    assert [north[i]["prom1"] for i in range(1, 7)] == [0.0, 1.0, 1.0, 0.0, 0.0, 0.0]
    assert {north[i]["required_num"] for i in range(1, 7)} == {1.0}
    later = build_features(inputs, "2020-01-01", "2020-01-31", min_day="2020-01-04")
    assert later.count() == 6
    assert rows(later.where("day_dt = '2020-01-06'").select("retail_price").distinct()) == [11.0]


def test_panel_is_not_shuffled_by_store(spark):
    table = build_features(feature_inputs(spark), "2020-01-01", "2020-01-31", min_day="2020-01-01")
    plan = table._jdf.queryExecution().executedPlan().toString()
    # sales are dealt by store and item for the outlier window; nothing is dealt by store alone
    assert not re.search(r"hashpartitioning\(store_id#\d+, \d+\)", plan) and plan.count("BroadcastHashJoin") >= 2


def _shuffles(df):
    """The exchanges of rows in a plan, without the copies of small tables."""
    return [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if " Exchange " in x]


def _panel_by_item(spark):
    calendar = C.calendar_days(spark, "2020-01-06", "2020-01-26")
    plan = spark.createDataFrame([("1", d("2020-01-06"), "5"), ("1", d("2020-01-13"), "5"), ("2", d("2020-01-06"), "6"), ("1", None, "6")], "item_idnt string, wk_idnt date, loc_idnt string")
    stores = spark.createDataFrame([("5", d("2019-01-01")), ("6", d("2019-01-01"))], "store_id string, loc_start_dt date")
    pairs = plan.select(F.col("item_idnt").alias("item_code"), F.col("loc_idnt").alias("store_id"))
    return N.panel_keys(N.shelf_plan_days(plan, calendar), N.future_days_of_assortment(pairs, stores, "2020-01-18", "2020-01-20"), "2020-01-18")


def test_panel_days_are_not_shuffled(spark):
    panel = _panel_by_item(spark)
    # planned days, among them two of the future, those of the future and one of an unknown week
    assert panel.count() == 14 + 7 + 3 * 3 - 2 + 1
    assert rows(panel.where("day_dt IS NULL"), "item_code", "store_id") == [("1", "6")]
    # weeks and pairs are placed by item and pairs made distinct; a distinct or a comparison of days would be further ones
    by_day = [x for x in _shuffles(panel) if "day_dt" in x]
    assert not by_day and panel.select(*N.PANEL_KEYS).distinct().count() == panel.count()


def _features_by_item(spark):
    inputs = feature_inputs(spark)
    placed = FeatureInputs(_panel_by_item(spark), inputs.store, inputs.sales, inputs.product, inputs.offers)
    return build_features(placed, "2020-01-01", "2020-01-31", min_day="2020-01-01"), inputs


def test_feature_rows_are_grouped_in_place(spark):
    table, _ = _features_by_item(spark)
    grouped = table.groupBy("item_code", "store_id", "loc_wh").agg(F.count(F.lit(1)).alias("n"))
    # sales and products are placed before they are joined; neither a join nor the groups shuffle the panel's days
    assert len(_shuffles(grouped)) == len(_shuffles(table))
    assert not any("store_id" in x for x in _shuffles(grouped))
    assert rows(grouped) == [("1", "5", "north", 15), ("1", "6", "south", 3), ("2", "6", "south", 10)]


def test_coded_feature_rows_are_grouped_by_item_in_place(spark):
    table, _ = _features_by_item(spark)
    codes = spark.createDataFrame([("loc_wh", "N", "north"), ("osd_type", "O", "x")], "code_type string, key_id string, value_id string")
    coded = L.dictionary_encode_by_maps(table, codes, ["loc_wh", "osd_type"]).groupBy("item_code").agg(F.count("loc_wh_new").alias("n"))
    # the report adds no exchange of rows; the maps of codes are subqueries
    dealt, before = ([x for x in _shuffles(df) if "hashpartitioning" in x] for df in (coded, table))
    assert len(dealt) <= len(before)
    assert rows(coded) == [("1", 15), ("2", 0)]


def test_extra_features_are_found_by_item_in_place(spark):
    _, inputs = _features_by_item(spark)
    days = promotion_days(_panel_by_item(spark).where("day_dt IS NOT NULL"), inputs.offers, "2020-01-01", "2020-01-31").withColumn("area_idnt", F.lit("1"))
    actual = spark.createDataFrame([("1", "1", d("2020-01-06"), 5.0)], "item_code string, area_idnt string, day_dt date, unit_price2 double")
    extra = add_offer_features(days, inputs.offers, actual, "2020-01-01", "2020-01-31")
    assert not [x for x in _shuffles(extra) if re.search(r"hashpartitioning\(item_code#\d+, day_dt#\d+, \d", x)]
    shuffled = [x for x in _shuffles(extra) if "_offer#" in x]
    plan = extra._jdf.queryExecution().optimizedPlan().toString()
    # the join by offer is the last one: it is the first in the plan
    assert plan.index("_offer#") < plan.index("offer_start_date#") and len(shuffled) <= 2
    assert rows(extra.where("item_code = '1' AND day_dt = '2020-01-06'"), "num_items_in_offer", "day_of_prom", "unit_price2") == [(100, -1, 5.0)]


def test_stored_item_days_find_their_stretches_in_place(spark):
    inputs = feature_inputs(spark)
    stored = spark.table(stage_by_item(inputs.panel, L.item_parts(spark), "panel"))
    days = stored.groupBy("item_code", "day_dt").agg(F.count(F.lit(1)).alias("_rows"))
    stretches = promotion_stretches(inputs.offers, "2020-01-01", "2020-01-31")
    found = with_stretch_of_day(days, stretches)
    # the offers are placed by item; their stretches, the stored days and both together are not shuffled
    assert len(_shuffles(found)) == 1 and "REPARTITION_BY_NUM" in _shuffles(found)[0]
    assert rows(found, "day_dt", "_rows", "offer_code") == [(d(f"2020-01-0{i}"), 3 if i == 1 else 2, c) for i, c in enumerate([None, "7", "7", "8", "8", None], 1)]


def test_stored_offers_are_not_shuffled_again(spark):
    offers = feature_inputs(spark).offers
    stored = stored_by_item(L.placed_by_item(offers, "item"))
    for made, want in (
        (promotion_stretches(stored, "2020-01-01", "2020-01-31", placed=True), promotion_stretches(offers, "2020-01-01", "2020-01-31")),
        (promotion_age(stored, horizon=("2020-01-01", "2020-01-31"), placed=True), promotion_age(offers, horizon=("2020-01-01", "2020-01-31"))),
    ):
        assert _shuffles(made) == [] and rows(made, *sorted(made.columns)) == rows(want, *sorted(want.columns))


def test_days_of_the_best_offer_meet_sales_in_place(spark):
    session = colocated_session(spark)
    offers = feature_inputs(spark).offers
    own = session.createDataFrame(offers.collect(), offers.schema)
    best = promotion_calendar(stored_by_item(L.placed_by_item(own, "item")), "2020-01-01", "2020-01-31", placed=True).withColumnRenamed("item", "item_code")
    sold = session.createDataFrame([("1", "5", d("2020-01-02"), 3.0), ("1", "6", d("2020-01-02"), 4.0), ("9", "6", d("2020-01-02"), 4.0)], "item_code string, store_id string, day_dt date, ttl_quantity double")
    sales = L.placed_by_item(sold).groupBy(*N.PANEL_KEYS).agg(F.sum("ttl_quantity").alias("ttl_quantity"))
    report = best.join(sales.hint("merge"), ["item_code", "day_dt"], "left").groupBy("item_code", "day_dt").agg(F.sum("ttl_quantity").alias("q"), F.max("offer_code").alias("offer_code"))
    # only the sales' lines are placed; no day, sum or report is shuffled
    assert len(_shuffles(report)) == 1 and "REPARTITION_BY_NUM" in _shuffles(report)[0]
    usual = promotion_calendar(offers, "2020-01-01", "2020-01-31")
    assert rows(report, "item_code", "day_dt", "offer_code") == rows(usual, "item", "day_dt", "offer_code")
    assert rows(report.where("q IS NOT NULL"), "item_code", "day_dt", "q") == [("1", d("2020-01-02"), 7.0)]


def test_medians_of_one_key_leave_the_rows_where_they_lie(spark):
    data = spark.createDataFrame([("1", 1.0), ("1", 3.0), ("1", None), ("2", None), (None, 5.0), (None, None)], "item_code string, v double")
    stored = spark.table(stage_by_item(data, L.item_parts(spark), "rows", order=["item_code"]))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = fill_with_median(stored, ["item_code"], "v")
        # the medians are placed by item; the rows are not, and rows without a key get the median of those
        assert len(_shuffles(filled)) == 1 and "isnull" not in _shuffles(filled)[0]
        assert filled.columns == ["item_code", "v"]
        assert rows(filled) == [(None, 5.0), (None, 5.0), ("1", 1.0), ("1", 2.0), ("1", 3.0), ("2", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_given_tables_are_placed_by_item_once(spark, tmp_path):
    from checks import tables as t

    lines = [(o, p, s, n, q, 7.5 * q, 0.1, d(f"1998-03-{day:02d}"), "N", "O") for o, p, s, n, q, day in [(1, 1, 5, 1, 2.0, 2), (1, 1, 5, 1, 2.0, 2), (2, 1, 5, 2, 3.0, 3), (2, 2, 6, 4, 4.0, 9), (3, None, 5, 6, 1.0, 9), (4, 2, None, 7, 1.0, 9), (None, 2, 5, 3, 2.0, 9), (9, 3, 5, 3, 2.0, 9)]]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate date, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(k, d("1998-02-01"), "1-URGENT") for k in (1, 2, 3, 4, 5, 11)], "o_orderkey long, o_orderdate date, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 9.0), (2, 8.0), (7, 1.0)], "p_partkey long, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    for made, key in ((t.offers, "item"), (t.sales, "item_code"), (t.shelf_plan, "item_idnt")):
        placed, want = made(spark, str(tmp_path), by_item=True), made(spark, str(tmp_path))
        assert rows(placed, *placed.columns) == rows(want, *placed.columns) and placed.columns == want.columns and want.count() > 3
        # they lie by item: what groups them by item shuffles nothing more
        assert len(_shuffles(placed.groupBy(key).agg(F.count(F.lit(1))))) == len(_shuffles(placed))


def test_panel_of_a_stored_plan_is_made_in_place(spark):
    calendar = C.calendar_days(spark, "2020-01-06", "2020-01-26")
    plan = spark.createDataFrame([("1", d("2020-01-06"), "5"), ("1", d("2020-01-13"), "5"), ("2", d("2020-01-06"), "6"), ("1", None, "6"), (None, d("2020-01-06"), "6")], "item_idnt string, wk_idnt date, loc_idnt string")
    stores = spark.createDataFrame([("5", d("2019-01-01")), ("6", d("2019-01-01"))], "store_id string, loc_start_dt date")

    def panel(weeks, placed):
        pairs = weeks.select(F.col("item_idnt").alias("item_code"), F.col("loc_idnt").alias("store_id"))
        future = N.future_days_of_assortment(pairs, stores, "2020-01-18", "2020-01-20", placed=placed)
        return N.panel_keys(N.shelf_plan_days(weeks, calendar, placed=placed), future, "2020-01-18")

    stored = spark.table(stage_by_item(L.placed_by_item(plan, "item_idnt"), L.item_parts(spark), "plan", "item_idnt"))
    made = panel(stored, True)
    assert not _shuffles(made) and rows(made) == rows(panel(plan, False))


def test_offer_sizes_are_found_without_a_shuffle_of_the_rows(spark):
    days = [("1", d("2020-01-01"), "7"), ("1", d("2020-01-02"), "7"), ("1", d("2020-01-03"), None), ("2", d("2020-01-01"), "8"), ("2", d("2020-01-01"), "8"), (None, d("2020-01-01"), "7"), (None, d("2020-01-02"), None), ("3", d("2020-01-01"), "9")]
    data = spark.createDataFrame(days, "item_code string, day_dt date, offer_code string")
    sizes = spark.createDataFrame([("7", 4), ("8", 2), ("0", 1), (None, 6)], "offer_code string, num_items_in_offer long")
    stored = colocated_session(spark).table(stage_by_item(data, L.item_parts(spark), "rows"))
    sized = with_offer_size_of_item(stored, sizes, stored)
    assert rows(sized) == rows(with_offer_size(data, sizes)) and sized.columns == with_offer_size(data, sizes).columns
    plan = sized._jdf.queryExecution().executedPlan().toString().splitlines()
    joined = next(i for i, x in enumerate(plan) if "SortMergeJoin [item_code#" in x)
    assert "Sort [item_code#" in plan[joined + 1] and "Exchange" not in plan[joined + 2]


def test_feature_rows_of_placed_inputs_are_the_same(spark):
    inputs = feature_inputs(spark)
    placed = FeatureInputs(inputs.panel, inputs.store, L.placed_by_item(inputs.sales), inputs.product, stored_by_item(L.placed_by_item(inputs.offers, "item")), placed=True)
    made, want = (build_features(x, "2020-01-01", "2020-01-31", min_day="2020-01-01", offer_features=(100, -1)) for x in (placed, inputs))
    columns = sorted(made.drop("outputs").columns)
    assert rows(made, *columns) == rows(want, *columns) and made.count() == 12


def test_what_is_written_takes_little_room(spark, tmp_path):
    table = feature_inputs(spark).sales
    write_with_alerts(table, str(tmp_path / "t"), feature_checks(["item_code"]))
    name = stage_by_item(table, 2, "rows", order=["item_code", "day_dt"])
    for files in ([x.name for x in (tmp_path / "t").iterdir()], spark.table(name).inputFiles()):
        parts = [x for x in files if x.endswith(".parquet")]
        assert parts and all("zstd" in x for x in parts)
    assert rows(spark.table(name)) == rows(table)


def test_future_of_the_assortment(spark):
    pairs = spark.createDataFrame([("1", "5"), ("1", "5"), ("2", "6"), ("2", "7"), ("3", "8")], "item_code string, store_id string")
    stores = spark.createDataFrame([("5", d("2019-01-01")), ("6", d("2020-01-02")), ("7", None), ("8", d("2020-01-04"))], "store_id string, loc_start_dt date")
    got = N.future_days_of_assortment(pairs, stores, "2020-01-01", "2020-01-04")
    days = [d(f"2020-01-0{i}") for i in range(1, 5)]
    assert rows(got, *N.PANEL_KEYS) == [("1", "5", x) for x in days] + [("2", "6", x) for x in days[2:]]


def test_extra_features(spark):
    inputs = feature_inputs(spark)
    table = build_features(inputs, "2020-01-01", "2020-01-31", min_day="2020-01-01")
    actual = spark.createDataFrame([("1", "1", d("2020-01-02"), 5.0)], "item_code string, area_idnt string, day_dt date, unit_price2 double")
    extra = add_offer_features(table, inputs.offers, actual, "2020-01-01", "2020-01-31")
    assert extra.count() == 12
    north = {r["day_dt"].day: r for r in extra.where("store_id = '5'").collect()}
    assert [north[i]["day_of_prom"] for i in range(1, 7)] == [-1, 0, 1, 0, 1, -1]
    assert [north[i]["num_items_in_offer"] for i in range(1, 7)] == [100, 1, 1, 1, 1, 100]
    assert (north[2]["unit_price2"], north[2]["p_rate2"], north[3]["unit_price2"]) == (5.0, 0.5, 8.0)


def test_encoded_features(spark):
    inputs = feature_inputs(spark)
    codes = spark.createDataFrame([("store_id", "S5", "5"), ("item_code", "I1", "1")], "code_type string, key_id string, value_id string")
    coded = build_features(FeatureInputs(inputs.panel, inputs.store, inputs.sales, inputs.product, inputs.offers, codes), "2020-01-01", "2020-01-31", encode=["store_id", "item_code"], min_day="2020-01-01")
    assert "store_id" not in coded.columns
    assert coded.groupBy("item_code_new", "store_id_new").count().where(F.col("store_id_new") == "S5").first()["count"] == 6


def test_a_report_of_every_store_sorts_no_rows_of_the_product(spark):
    from checks.sales_queries import _by_store_day

    items = spark.createDataFrame([("10",), ("9",), (None,), ("9",)], "item_code string")
    stores = spark.createDataFrame([("5", d("2020-01-01")), ("6", d("2020-01-18"))], "store_id string, loc_start_dt date")
    sample = N.open_store_days(stores, "2020-01-18", "2020-01-19").unionByName(spark.createDataFrame([(None, "5")], "day_dt date, store_id string"))
    given = _by_store_day(items, lambda own: N.future_days_given(own, sample, carried=["code"]))
    assert rows(given) == [("5", None, 3, "10"), ("5", d("2020-01-18"), 3, "10"), ("5", d("2020-01-19"), 3, "10"), ("6", d("2020-01-19"), 3, "10")]
    made = _by_store_day(items, lambda own: N.future_days_of_open_stores(own, stores, "2020-01-18", "2020-01-19", carried=["code"]))
    assert rows(made) == rows(given.where("day_dt IS NOT NULL"))
    for report in (given, made):
        assert "SortAggregate" not in report._jdf.queryExecution().executedPlan().toString()


def test_panel_of_stores_is_made_and_reported_in_place(spark, tmp_path):
    from checks import QUERIES

    tables = {
        "lineitem": "SELECT * FROM VALUES (1L, 5L, TIMESTAMP '2000-12-05 00:00:00'), (1L, 5L, TIMESTAMP '2000-12-06 00:00:00'), (2L, 5L, TIMESTAMP '2001-01-02 00:00:00'), (3L, 10L, null) AS t(l_partkey, l_suppkey, l_shipdate)",
        "supplier": "SELECT * FROM VALUES (5L, 1L, 2.0D), (10L, 1L, 3.0D) AS t(s_suppkey, s_nationkey, s_acctbal)",
        "nation": "SELECT 1L AS n_nationkey, 'N' AS n_name, 1L AS n_regionkey",
        "region": "SELECT 1L AS r_regionkey, 'R' AS r_name",
    }
    for name, sql in tables.items():
        spark.sql(sql).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    report = QUERIES["panel_union_distinct"](spark, str(tmp_path))
    # weeks are placed by store when they are stored; days are not shuffled, neither for repeats nor for the report
    assert not [x for x in _shuffles(report) if "day_dt" in x or "item_code" in x]
    found = rows(report, "store_id", "day_dt", "n_items", "first_item")
    # a week of December, a week of January whose days the future of both items has as well, from the 26th of December on store 5 is open
    assert [r[2:] for r in found if r[1] and r[0] == "5" and r[1] < d("2000-12-20")] == [(1, "1")] * 7
    assert [(r[1].day, *r[2:]) for r in found if r[0] == "5" and r[1] and r[1] >= d("2001-01-01")] == [(i, 2, "1") for i in range(1, 15)]
    assert [r for r in found if r[1] is None] == [("10", None, 1, "3")]
