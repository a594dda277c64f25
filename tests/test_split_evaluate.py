import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import correlate as Y
from shelfwise.operators import evaluate as V
from shelfwise.operators import split as T
from shelfwise.plans import export as X
from shelfwise.plans.settings import MAY, SETTINGS
from tests.conftest import rows

SPLITS = T.Splits("2020-01-01", ("2020-01-11", "2020-01-15"), ("2020-01-15", "2020-01-20"), ("2020-02-01", "2020-02-05"))
START = date(2020, 1, 1)


def days(spark, n=40):
    return spark.createDataFrame([(START + timedelta(days=i),) for i in range(-1, n)], "day_dt date")


def test_splits(spark):
    counts = dict(rows(T.with_split(days(spark), SPLITS).groupBy("split").count()))
    assert counts == {"train": 10, "v1": 5, "v2": 5, "test": 5}
    both = dict(rows(T.with_split(days(spark), SPLITS, inclusive=True).groupBy("split").count()))
    assert both == {"train": 11, "v1": 5, "v2": 6, "test": 5}


def test_settings_are_consistent():
    assert len(SETTINGS) == 13
    for name, setting in SETTINGS.items():
        s = setting.splits
        assert s.history_start < s.v1[0] <= s.v1[1] <= s.v2[0] <= s.v2[1] < s.test[0] <= s.test[1], name
        if setting.horizons:
            assert setting.horizons[0][0] >= s.test[0], name
    assert len(MAY.features) == 25 and MAY.splits.history_end == "2021-03-17"


def test_day_weight(spark):
    weights = days(spark, 11).where("day_dt >= '2020-01-01'").select(T.day_weight("2020-01-01", "2020-01-11").alias("w"))
    assert sorted(rows(weights, "w")) == pytest.approx(list(np.linspace(0, 1, 11) ** 4))


def test_row_weight(spark):
    data = [("hot", START + timedelta(days=i % 3), str(s)) for i in range(3) for s in range(5 + i)] + [("one", START, "1")]
    weighted = T.with_row_weight(spark.createDataFrame(data, "item_code string, day_dt date, store_id string"), 2)
    frame = weighted.toPandas().sort_values(["item_code", "day_dt", "store_id"])
    hot = frame[frame.item_code == "hot"].weight
    assert list(hot) == pytest.approx(list(np.linspace(0, 1, len(hot)) ** 2))
    assert frame[frame.item_code == "one"].weight.isna().all()


def test_eligibility(spark):
    def item(name, *spans):
        return [(name, START + timedelta(days=i), float(q)) for first, last, q in spans for i in range(first, last)]

    data = (
        item("fine", (0, 3, 1), (3, 6, 2), (31, 33, 0)) + item("no train", (12, 14, 1), (31, 33, 0)) + item("no test", (0, 5, 1))
        + item("short", (5, 6, 1), (6, 7, 2), (31, 33, 0)) + item("flat", (0, 5, 3), (31, 33, 0)) + item("unoffered", (0, 3, 1), (3, 6, 2), (31, 33, 0))
    )
    table = spark.createDataFrame(data, "item_code string, day_dt date, ttl_quantity double")
    offers = spark.createDataFrame([("fine",), ("fine",), ("short",)], "item string")
    reasons = T.eligibility(table, offers, SPLITS, latest_history="2020-01-04")
    assert dict(rows(reasons)) == {
        "fine": None, "no train": "no_training_rows", "no test": "no_test_rows", "short": "history_too_short",
        "flat": "constant_target", "unoffered": "no_offers",
    }
    assert rows(T.eligible_items(reasons)) == ["fine"]


WINDOWS = SPLITS.windows


def scored(spark):
    data = []
    for i in range(10, 20):
        for store, house, q, p in (("1", "n", 10.0, 9.0), ("2", "n", 0.0, 3.0), ("3", "s", 4.0, 0.0)):
            data.append(("a", store, house, START + timedelta(days=i), q, p, 2.0 + i % 2))
    return spark.createDataFrame(data, "item_code string, store_id string, loc_wh string, day_dt date, ttl_quantity double, y_pred double, unit_price double")


def test_sell_through(spark):
    got = {(r["window"], r["loc_wh"]): r for r in V.sell_through(scored(spark), WINDOWS).collect()}
    # the closed windows share the 15th
    assert got["v1", "n"]["ttl_quantity"] == 50.0 and got["v2", "n"]["ttl_quantity"] == 60.0
    assert got["v1", "n"]["ratio"] == round(50 / 60, 4)
    assert got["v1", "s"]["ratio"] is None
    assert got["v1", "n"]["unit_price"] == pytest.approx(np.mean([2, 3, 2, 3, 2]))
    bands = V.ratio_bands(V.sell_through(scored(spark), WINDOWS)).first()
    assert (bands["from_80_to_100"], bands["from_65_to_120"], bands["from_120"]) == (0.5, 0.5, 0.0)
    assert rows(V.pass_gate(V.sell_through(scored(spark), WINDOWS), 0.5), "share_in_band", "passed") == [(0.5, 1)]


def test_bands_count_shared_edges_twice(spark):
    ratios = spark.createDataFrame([("a", 0.5), ("a", 1.0), ("a", 1.2), ("a", None)], "item_code string, ratio double")
    r = V.ratio_bands(ratios).first()
    assert (r["upto_50"], r["from_50_to_80"], r["from_80_to_100"], r["from_100_to_120"], r["from_120"], r["from_65_to_120"]) == (0.25, 0.25, 0.25, 0.5, 0.25, 0.5)


def test_store_accuracy_against_pandas(spark):
    pick = random.Random(3)
    data = [(pick.choice("ab"), pick.choice(["v1", "v2"]), str(pick.randrange(6)), pick.choice([None, float(pick.randrange(8))]), pick.uniform(0, 6)) for _ in range(400)]
    columns = ["item_code", "window", "store_id", "ttl_quantity", "y_pred"]
    frame = pd.DataFrame(data, columns=columns)
    quarter = frame.groupby(columns[:3]).ttl_quantity.transform("sum") / 4
    off = frame.ttl_quantity.fillna(0) - frame.y_pred
    frame["inside"] = (off >= np.minimum(-1, quarter * -0.5)) & (off <= np.maximum(1, quarter))
    expected = frame.groupby(["item_code", "window"]).inside.mean().to_dict()
    table = spark.createDataFrame(data, "item_code string, window string, store_id string, ttl_quantity double, y_pred double")
    got = {(r[0], r[1]): r[2] for r in V.store_accuracy(table).select("item_code", "window", "accuracy").collect()}
    assert got == pytest.approx(expected)


def test_reports(spark):
    table = scored(spark)
    day = V.daily_report(table).where("day_dt = '2020-01-11'").first()
    assert (day["ttl_quantity"], day["y_pred"], day["unit_price"], day["ratio"]) == (14.0, 12.0, 2.0, 14 / 12)
    series = V.split_series(table.withColumn("split", F.lit("v1"))).where("day_dt = '2020-01-11'").first()
    assert series["store_cnt"] == 3
    assert rows(V.low_volume_warehouses(table, 100)) == [("a", 1)]
    assert rows(V.store_check(table.unionAll(table.limit(1))), "test_store_cnt", "n_repeated") == [(3, 1)]
    totals = V.window_totals(table, WINDOWS).first()
    assert (totals["v1_ttl_quantity"], totals["v1_y_pred"], totals["v2_ttl_quantity"]) == (70.0, 60.0, 84.0)
    assert rows(V.test_stores(table, table.where("store_id = '2'")).select("store_id").distinct()) == ["2"]
    assert V.overall_sell_through(V.in_windows(table, WINDOWS)).where("window = 'v1'").first()["sell_thru"] == 70 / 60


def test_export(spark):
    table = scored(spark)
    test = table.withColumn("y_pred", F.col("y_pred") - 3.5)
    results = X.result_table(table, test)
    assert results.columns == X.RESULT_COLUMNS
    assert results.count() == 60
    assert rows(X.test_result(results).select("y_pred").distinct()) == [0.0, 5.5]
    summary = X.validation_summary(table, WINDOWS)
    horizons = (("2020-02-01", "2020-02-02"), ("2020-02-03", "2020-02-05"))
    meta = X.metadata_table(summary, test, horizons, "now")
    assert meta.columns == X.METADATA_COLUMNS
    assert rows(meta, "test_start_time", "test_store_cnt", "v1_start_time", "v2_end_time") == [("2020-02-01", 3, "2020-01-11", "2020-01-20"), ("2020-02-03", 3, "2020-01-11", "2020-01-20")]
    report = X.validation_report(table, test, WINDOWS, 0.9).first()
    assert (report["passed"], report["n_low"]) == (0, 2)
    gate = V.pass_gate(V.sell_through(table, WINDOWS), 0.9)
    assert X.passed_only(table, gate).count() == 0


def test_constant_column_correlation(spark):
    table = spark.createDataFrame([("i", 1.0, 2.0), ("i", 2.0, 2.0), ("i", 4.0, 2.0)], "item_code string, a double, b double")
    long = dict(rows(Y.target_correlations(table, "a", ["b"]), "feature", "corr"))
    assert long == {"a": pytest.approx(1.0), "b": None}
    matrix = Y.top_matrix(table, "a", ["b"]).first()
    assert (matrix["col_name"], matrix["data"]) == (["a", "b"], [[1.0, 0.0], [0.0, 0.0]])


def test_top_matrix_against_pandas(spark):
    rng = np.random.default_rng(4)
    n = 300
    frame = pd.DataFrame({"item_code": rng.choice(["hot", "hot", "hot", "b"], n), "y": rng.normal(size=n)})
    for i in range(14):
        frame[f"f{i:02d}"] = frame.y * rng.uniform(-1, 1) + rng.normal(size=n) + 1000 * (i % 3)
    frame.loc[frame.item_code == "b", "f03"] = 7.1
    features = [c for c in frame.columns if c.startswith("f")]
    got = {r["item_code"]: r for r in Y.top_matrix(spark.createDataFrame(frame), "y", features).collect()}
    for item, part in frame.groupby("item_code"):
        corr = part[["y", *features]].corr()
        top = list(corr["y"].abs().sort_values(ascending=False)[:10].index)
        assert got[item]["col_name"] == top
        assert np.array(got[item]["data"]) == pytest.approx(corr.loc[top, top].fillna(0).to_numpy(), abs=1e-9)
    text = Y.matrix_json(Y.top_matrix(spark.createDataFrame(frame), "y", features)).first()["corr_json"]
    assert text.startswith('{"col_name":["y"')


def test_constant_columns_stay_constant_over_many_partitions(spark):
    """Merging partial variances of a constant can leave a rest; it must not become a correlation."""
    table = spark.range(0, 3307, 1, 37).select(
        F.concat(F.lit("i"), F.pmod(F.xxhash64("id"), F.lit(40))).alias("item_code"),
        F.rand(1).alias("y"),
        F.lit(1.1).alias("c"),
        F.rand(2).alias("x"),
    )
    long = Y.target_correlations(table, "y", ["c", "x"])
    assert rows(long.where("feature = 'c'").select("corr").distinct()) == [None]
    cells = Y.top_matrix(table, "y", ["c", "x"]).select(F.flatten("data").alias("v"), "col_name")
    assert rows(cells.select(F.get("col_name", F.lit(2))).distinct()) == ["c"]
    assert rows(cells.select(F.slice("v", 7, 3).alias("v")).distinct()) == [[0.0, 0.0, 0.0]]
