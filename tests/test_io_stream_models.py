from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators.split import Splits, eligibility, with_split
from shelfwise.plans import forecast as M
from shelfwise.plans.export import result_table
from shelfwise.plans.features import colocated_features
from shelfwise.plans.forecast_round import forecast_round, low_sales_round
from shelfwise.plans.pooled import pooled_items, pooled_table
from shelfwise.plans.settings import SUBCLASS_FEATURES, ForecastSettings
from shelfwise.plans.training_set import model_table, with_sample_weight
from shelfwise.sources import readers as S
from shelfwise.sources import writers as W
from shelfwise.streaming.ingest import DailySalesIngest
from tests.conftest import rows

DAY = date(2020, 1, 1)


def sales(spark, *data):
    return spark.createDataFrame([(i, s, DAY + timedelta(days=n), q, None, None) for i, s, n, q in data], schemas.SALES)


def test_csv_sources_and_sinks(spark, tmp_path):
    table = sales(spark, ("001", "5", 0, 1.5), ("2", "6", 1, None))
    W.write_csv(table, str(tmp_path / "head"))
    assert rows(S.csv_table(spark, str(tmp_path / "head"), schemas.SALES)) == rows(table)
    pruned = S.csv_table(spark, str(tmp_path / "head"), schemas.SALES, ["day_dt", "item_code"])
    assert pruned.columns == ["day_dt", "item_code"]
    W.write_pipe_text(table, str(tmp_path / "pipe"))
    assert rows(S.positional_csv_table(spark, str(tmp_path / "pipe"), schemas.SALES, "|")) == rows(table)
    table.write.option("compression", "gzip").csv(str(tmp_path / "packed"))
    assert rows(S.positional_csv_table(spark, str(tmp_path / "packed"), schemas.SALES)) == rows(table)


def test_items_keep_leading_zeros(spark, tmp_path):
    path = str(tmp_path / "items")
    table = sales(spark, ("001", "5", 0, 1.5), ("002", "6", 1, 2.0), ("1", "6", 1, 2.0))
    W.write_by_item(table, path)
    got = S.parquet_items(spark, path, ["001", "1"]).select(*table.columns)
    assert rows(got) == rows(table.where("item_code <> '002'"))
    plan = S.parquet_items(spark, path, ["001"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "item_code" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_bucketed_table_joins_without_shuffle(spark):
    W.write_bucketed_by_item(sales(spark, ("1", "5", 0, 1.0), ("2", "5", 0, 1.0)), "bucketed_sales", 4)
    table = spark.table("bucketed_sales")
    plan = table.groupBy("item_code").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert table.count() == 2


def test_warehouse_query_and_lists(spark):
    table = sales(spark, ("3", "5", 0, 1.0), ("1", "5", 0, 1.0), ("2", "5", 0, 1.0), ("2", "6", 0, 1.0))
    assert rows(S.warehouse_query(spark, "SELECT sum(ttl_quantity) AS q FROM {s}", s=table)) == [4.0]
    assert rows(S.item_list(table)) == ["1", "2", "3"]
    assert rows(S.item_slice(S.item_list(table), 2, 1)) == ["2", "3"]
    products = spark.createDataFrame([("1", "x", "hair"), ("1", "a", "hair"), ("2", "x", "skin")], "item_code string, sbclass_desc string, class_desc string")
    assert rows(S.items_of_subclass(products, "hair", "x")) == ["1"]
    assert rows(S.subclass_of_items(products)) == [("1", "a"), ("2", "x")]


def test_ingest_takes_files_once_and_repeats_safely(spark, tmp_path):
    incoming = str(tmp_path / "incoming")
    columns = ["item_code", "store_id", "day_dt", "ttl_quantity"]
    ingest = DailySalesIngest(spark, incoming, schemas.SALES, str(tmp_path / "base"), files_per_batch=1)
    sales(spark, ("1", "5", 0, 1.0), ("1", "5", 40, 2.0)).coalesce(1).write.mode("append").parquet(incoming)
    ingest.run()
    first = [("1", "5", DAY, 1.0), ("1", "5", DAY + timedelta(days=40), 2.0)]
    assert rows(ingest.table(), *columns) == first
    ingest.run()
    assert rows(ingest.table(), *columns) == first
    late = sales(spark, ("1", "5", 0, 5.0), ("2", "5", 1, 3.0)).coalesce(1)
    late.write.mode("append").parquet(incoming)
    ingest.run()
    expected = sorted([("1", "5", DAY, 6.0), first[1], ("2", "5", DAY + timedelta(days=1), 3.0)])
    assert sorted(rows(ingest.table(), *columns)) == expected
    # a batch that is run again, as after a failure, changes nothing
    ingest._take_batch(late, 1)
    assert sorted(rows(ingest.table(), *columns)) == expected


def test_work_of_a_batch_follows_the_batch(spark, tmp_path):
    """Ten batches of equal size into one month: what a batch stores stays bounded, a replay after a merge changes nothing."""
    incoming, data = str(tmp_path / "incoming"), {}
    ingest = DailySalesIngest(spark, incoming, schemas.SALES, str(tmp_path / "base"), fan_in=2)
    stored, before = [], set()
    for k in range(10):
        batch = [(f"{k}-{i}", "5", i % 28, 1.0 + k) for i in range(50)] + [("all", "5", 3, 1.0)]
        for i, _, n, q in batch:
            data[i, n] = data.get((i, n), 0) + q
        frame = sales(spark, *batch)
        ingest._take_batch(frame, k)
        if k in (3, 7):
            ingest._take_batch(frame, k)  # its run is merged already
        runs = ingest.runs()
        new = [r for r in runs if r not in before]
        stored.append(sum(ingest._read([r]).count() for r in new))
        before = set(runs)
        assert len({r.level for r in runs}) <= 5
        assert {(r["item_code"], (r["day_dt"] - DAY).days): r["ttl_quantity"] for r in ingest.table().collect()} == data
    # rows rewritten over all batches: a logarithm of them, not their square (51 * 55 = 2805)
    assert sum(stored) <= 51 * 10 * 3 and stored[8] <= 2 * 51
    ingest.compact()
    assert len(ingest.runs()) == 1
    assert {(r["item_code"], (r["day_dt"] - DAY).days): r["ttl_quantity"] for r in ingest.table().collect()} == data


def test_periods_of_their_own_and_rows_without_a_day(spark, tmp_path):
    ingest = DailySalesIngest(spark, str(tmp_path / "in"), schemas.SALES, str(tmp_path / "base"), fan_in=2)
    none = spark.createDataFrame([("1", "5", None, 2.0, None, None)], schemas.SALES)
    assert rows(ingest.table()) == []
    for k in range(4):
        ingest._take_batch(sales(spark, ("1", "5", 31 * (k % 2), 1.0)).unionByName(none), k)
    assert rows(ingest.table()) == [("1", "5", None, 8.0), ("1", "5", DAY, 2.0), ("1", "5", DAY + timedelta(days=31), 2.0)]


def test_covered_runs_are_not_read(spark, tmp_path):
    """A failure between storing a merged run and deleting its parts."""
    ingest = DailySalesIngest(spark, str(tmp_path / "in"), schemas.SALES, str(tmp_path / "base"), fan_in=2)
    ingest._delete = lambda runs: None
    for k in range(4):
        ingest._take_batch(sales(spark, ("1", "5", 0, 1.0)), k)
    assert len(ingest.runs()) > 1
    assert rows(ingest.table()) == [("1", "5", DAY, 4.0)]


def test_export_goes_on_where_it_broke_off(spark, tmp_path):
    table = sales(spark, *[(f"i{k}", "5", n, float(n)) for k in range(40) for n in range(3)])
    export = W.ResumableExport(spark, str(tmp_path / "export"), shards=5)
    assert rows(export.exported(table.schema)) == []
    assert export.run(table, stop_before_record=2) == 2
    half = export.exported(table.schema)
    # what was written without a record doesn't count
    assert rows(half.select("item_code").distinct()) == rows(export.manifest(), "item_code") and 0 < half.count() < table.count()
    assert export.run(table) == 3
    assert rows(export.exported(table.schema)) == rows(table)
    assert export.run(table) == 0
    more = table.unionByName(sales(spark, ("late", "5", 0, 1.0)))
    assert export.run(more) == 1 and rows(export.exported(table.schema)) == rows(more)
    assert rows(export.manifest().groupBy("item_code").count().where("count > 1")) == []
    assert dict(rows(export.manifest(), "item_code", "n_rows"))["i7"] == 3


def test_partitions_are_pruned_by_another_table(spark, tmp_path):
    path = str(tmp_path / "items")
    W.write_by_item(sales(spark, *[(f"{k:03d}", "5", 0, 1.0) for k in range(30)]), path)
    spark.createDataFrame([(f"{k:03d}", k % 10) for k in range(30)], "item_code string, kind int").write.parquet(str(tmp_path / "kinds"))
    chosen = spark.read.parquet(str(tmp_path / "kinds")).where("kind = 3").select("item_code")
    found = S.parquet_items_of(spark, path, chosen)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found, "item_code") == ["003", "013", "023"]


def test_tables_of_equal_buckets_join_in_place(spark):
    table = sales(spark, *[(str(i), str(s), n, 1.0) for i in range(9) for s in range(3) for n in range(4)])
    keys = ["item_code", "day_dt"]
    W.write_colocated(table.select("item_code", "store_id", "day_dt"), "own_panel", keys, 6)
    W.write_colocated(table.where("store_id = '1'").select("item_code", "store_id", "day_dt", "ttl_quantity"), "own_sales", keys, 6)
    W.write_colocated(table.select(*keys).distinct().withColumn("offer_code", F.lit("x")), "own_days", keys, 6)
    joined = colocated_features(S.colocated_session(spark), "own_panel", "own_sales", "own_days")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2
    assert joined.count() == 108 and joined.where("ttl_quantity = 1").count() == 36
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


SPLITS = Splits("2020-01-01", ("2020-03-01", "2020-03-10"), ("2020-03-11", "2020-03-20"), ("2020-04-01", "2020-04-10"))


def training_rows(spark):
    n = F.col("id")
    return spark.range(3000).select(
        F.date_add(F.lit(DAY), (n % 101).cast("int")).alias("day_dt"),
        (n % 7).cast("string").alias("store_id"),
        F.lit("1").alias("item_code"),
        F.when(n % 2 == 0, "mall").otherwise("street").alias("store_type"),
        (n % 5).cast("double").alias("unit_price"),
        ((n % 5) * 3 + F.when(n % 2 == 0, 20.0).otherwise(0.0)).alias("ttl_quantity"),
        F.lit(1.0).alias("weight"),
    )


FEATURES = ["store_type", "unit_price"]
LIMITS = M.TreeLimits(trees=8, step=0.5, depth=4)


def test_boosted_trees_learn_and_refit(spark):
    table = training_rows(spark)
    past, later = table.where("day_dt < '2020-03-01'"), table.where("day_dt >= '2020-03-01'")
    model = M.train_model(past, later, FEATURES, LIMITS)
    assert 1 <= model.trees.getNumTrees <= 8
    scored = M.score(model, later)
    assert scored.columns == [*later.columns, "y_pred"]
    error = scored.agg(F.avg(F.abs(F.col("ttl_quantity") - F.col("y_pred")))).first()[0]
    assert error < 1.0
    refitted = M.retrain_model(model, table, FEATURES, 2, LIMITS)
    assert refitted.trees.getNumTrees == model.trees.getNumTrees + 2
    importance = M.feature_importance(model, spark).collect()
    assert sum(r["importance"] for r in importance) == pytest.approx(1.0)
    assert [r["feature"] for r in M.loss_importance(model, past).where("loss_change > 1").collect()] == ["store_type", "unit_price"]


def test_any_number_of_categories(spark):
    table = training_rows(spark).withColumn("item_code", (F.monotonically_increasing_id() % 3000).cast("string"))
    model = M.train_model(table, None, ["item_code", "store_type"], M.TreeLimits(trees=3, depth=3))
    assert model.means["item_code"].count() == table.select("item_code").distinct().count() > 1000
    unknown = table.limit(1).withColumn("item_code", F.lit("never seen"))
    assert M.score(model, unknown).first()["y_pred"] is not None


def test_only_exported_forecasts_are_clamped(spark):
    rows_ = [("i", "s", DAY, 1.0, -2.123456)]
    scored = spark.createDataFrame(rows_, "item_code string, store_id string, day_dt date, ttl_quantity double, y_pred double")
    got = {r["istest"]: r["y_pred"] for r in result_table(scored, scored).collect()}
    assert got == {0: -2.123456, 1: 0.0}


def test_linear_fits(spark):
    table = spark.createDataFrame([("a", 1.0, 5.0), ("a", 2.0, 7.0), ("a", None, 9.0), ("b", 1.0, 2.0)], "item_code string, unit_price double, ttl_quantity double")
    assert rows(M.linear_fits(table, "unit_price")) == [("a", 2.0, 3.0), ("b", None, None)]


def model_inputs(spark):
    days = [date(2020, 2, 27), date(2020, 3, 5), date(2020, 4, 2)]
    base = {f"prom{i}": 0.0 for i in range(8)} | {"is_vip": 0.0, "free_gift": 0.0, "required_num": 1.0, "day_type": 1, "is_5th": 0}
    data = [
        base | {"item_code": i, "store_id": s, "day_dt": day, "area_idnt": "1", "loc_wh": "n", "store_type": "mall", "activity_desc": None, "pds_grace": "高级",
                "unit_price": 8.0, "retail_price": 10.0, "ttl_quantity": None, "offer_code": None, "loc_selling_area": 5.0 if s == "1" else None,
                "year": 2020, "month": day.month, "weekday": day.weekday()}
        for i in ("1", "2") for s in ("1", "2") for day in days
    ]
    flags = ", ".join(f"{k} {'double' if isinstance(v, float) else 'int'}" for k, v in base.items())
    table = spark.createDataFrame(data, flags + ", item_code string, store_id string, day_dt date, area_idnt string, loc_wh string, store_type string, activity_desc string, pds_grace string, unit_price double, retail_price double, ttl_quantity double, offer_code string, loc_selling_area double, year int, month int, weekday int")
    offers = spark.createDataFrame([("1", "7", date(2020, 3, 1), date(2020, 4, 30), "x", 1.0), ("2", "8", date(2020, 1, 1), date(2020, 1, 2), "x", 1.0)], "item string, offer_code string, offer_start_date date, offer_end_date date, label string, prom1 double")
    lunar = spark.createDataFrame([(days[0], 3)], "day_dt date, dis_spring int")
    actual = spark.createDataFrame([("1", "1", day, 4.0) for day in days], schemas.UNIT_PRICE)
    return table, offers, lunar, actual


def test_model_table(spark):
    settings = ForecastSettings(splits=SPLITS, features=("year", "month", "day_of_prom", "activity_desc", "unit_price", "p_rate", "dis_spring", "num_items_in_offer", "loc_selling_area", "pds_grace"))
    rows_, offers, lunar, actual = model_inputs(spark)
    # the pandemic months 2020-01..03 are left out, so only the forecast rows of April remain
    table = model_table(rows_, offers, lunar, actual, settings)
    assert rows(table.select("split").distinct()) == ["test"]
    later = Splits("2021-01-01", ("2021-03-01", "2021-03-10"), ("2021-03-11", "2021-03-20"), ("2021-04-01", "2021-04-10"))
    moved = rows_.withColumns({"day_dt": F.add_months("day_dt", 12), "year": F.lit(2021)})
    moved_offers = offers.withColumns({"offer_start_date": F.add_months("offer_start_date", 12), "offer_end_date": F.add_months("offer_end_date", 12)})
    moved_prices = actual.withColumn("day_dt", F.add_months("day_dt", 12))
    table = model_table(moved, moved_offers, lunar, moved_prices, ForecastSettings(splits=later, features=settings.features)).cache()
    assert table.count() == 12
    assert table.columns == ["day_dt", "store_id", "item_code", "loc_wh", "unit_price", "year", "month", "day_of_prom", "activity_desc", "p_rate", "dis_spring", "num_items_in_offer", "loc_selling_area", "pds_grace", "ttl_quantity", "split"]
    one = {r["split"]: r for r in table.where("item_code = '1' AND store_id = '2'").collect()}
    # history takes the actual price, the forecast keeps the planned one
    assert [one[s]["unit_price"] for s in ("train", "v1", "test")] == [4.0, 4.0, 8.0]
    assert [one[s]["p_rate"] for s in ("train", "v1", "test")] == [0.4, 0.4, 0.8]
    assert [one[s]["day_of_prom"] for s in ("train", "v1", "test")] == [-1, 4, 32]
    assert {r["loc_selling_area"] for r in one.values()} == {5.0}
    assert (one["v1"]["activity_desc"], one["v1"]["pds_grace"], one["v1"]["ttl_quantity"], one["v1"]["year"], one["v1"]["num_items_in_offer"]) == ("None", "Premium", 0.0, 2020, 100)
    weights = with_sample_weight(table.where("split = 'train'"), ForecastSettings(splits=later))
    assert rows(weights.select("weight").distinct()) == [pytest.approx((57 / 59) ** 4)]
    assert rows(with_sample_weight(table, ForecastSettings(splits=later, weighting="none")).select("weight").distinct()) == [1.0]


def test_pooled_set(spark):
    rows_, offers, lunar, actual = model_inputs(spark)
    more = offers.unionByName(spark.createDataFrame([("1", "9", date(2020, 4, 1), date(2020, 4, 5), "x", 1.0), ("1", "6", date(2020, 1, 5), date(2020, 1, 6), "x", 1.0)], offers.schema))
    settings = ForecastSettings(splits=SPLITS, weighting="none", features=SUBCLASS_FEATURES)
    products = spark.createDataFrame([("1", "cream"), ("2", "cream")], "item_code string, sbclass_desc string")
    items = pooled_items(more, products, "cream", "prom1", settings)
    assert rows(items) == ["1"]
    schedule = spark.createDataFrame([(date(2020, 4, 2), 6)], "day_dt date, schedule_ix int")
    table = pooled_table(rows_, items, more, lunar, actual, settings, schedule)
    assert rows(table.select("item_code", "schedule_ix").distinct()) == [("1", 6)]


def round_table(spark):
    n = F.col("id")
    return spark.range(8000).select(
        F.date_add(F.lit(DAY), (n % 101).cast("int")).alias("day_dt"),
        (n % 7).cast("string").alias("store_id"),
        F.concat(F.lit("i"), (n % 3).cast("string")).alias("item_code"),
        F.when(n % 7 < 3, "north").otherwise("south").alias("loc_wh"),
        (n % 5).cast("double").alias("unit_price"),
        # item i2 jumps in validation, so its forecast misses the gate
        ((n % 3) * 10 + 5 + (n % 5) * 0.1 + F.when((n % 3 == 2) & (n % 101 >= 60), 500.0).otherwise(0.0)).alias("ttl_quantity"),
    )


def test_forecast_round(spark):
    horizons = (("2020-04-01", "2020-04-05"), ("2020-04-06", "2020-04-10"))
    settings = ForecastSettings(splits=SPLITS, features=("unit_price",), pass_share=0.75, extra_trees=3, horizons=horizons, latest_history="2020-02-01")
    table = with_split(round_table(spark), SPLITS)
    offers = spark.createDataFrame([("i0",), ("i1",), ("i2",)], "item string")
    unoffered = table.where("item_code = 'i0'").withColumn("item_code", F.lit("i3"))
    table = table.unionByName(unoffered)
    done = forecast_round(table, settings, "2020-05-01 00:00:00", offers, M.TreeLimits(trees=8, step=0.5, depth=3))
    assert dict(rows(done.gate, "item_code", "passed")) == {"i0": 1, "i1": 1, "i2": 0}
    assert rows(done.results.select("item_code", "istest").distinct()) == [("i0", 1), ("i1", 1)]
    means = dict(rows(done.results.groupBy("item_code").agg(F.avg("y_pred"))))
    assert means["i0"] == pytest.approx(5, abs=2) and means["i1"] == pytest.approx(15, abs=2)
    assert rows(done.metadata, "item_code", "test_start_time") == [("i0", "2020-04-01"), ("i0", "2020-04-06"), ("i1", "2020-04-01"), ("i1", "2020-04-06")]


def test_low_sales_round(spark):
    table = round_table(spark).groupBy("item_code", "day_dt").agg(F.sum("ttl_quantity").alias("ttl_quantity"), F.avg("unit_price").alias("unit_price"))
    flat = spark.createDataFrame([("flat", DAY + timedelta(days=i), 1.0, 1.0) for i in range(101)], table.schema)
    table = table.unionByName(flat).withColumns({"weekday": F.weekday("day_dt"), "day_type": F.lit(0), "is_5th": F.lit(0)})
    totals = low_sales_round(table, "2020-03-01", {"v1": ("2020-03-01", "2020-03-10"), "v2": ("2020-03-10", "2020-03-20")}, M.TreeLimits(trees=3, depth=3))
    assert totals.columns == ["item_code", "v1_ttl_quantity", "v1_y_pred", "v2_ttl_quantity", "v2_y_pred"]
    assert rows(totals, "item_code") == ["i0", "i1", "i2"]


def test_a_table_is_dealt_by_the_size_of_its_files(spark, tmp_path, monkeypatch):
    from shelfwise import session

    spark.range(50_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    df = spark.read.parquet(str(tmp_path / "one"))
    monkeypatch.setattr(session, "DEALT_BYTES", 4_000)
    parts = session.dealt(df).rdd.getNumPartitions()
    assert parts == -(-session._file_bytes(df) // 4_000) > spark.sparkContext.defaultParallelism
    assert session.dealt(df).count() == 50_000


def test_low_sales_days_alike_are_trained_on_once(spark, monkeypatch):
    from shelfwise.plans import forecast_round as R

    days = [("a", DAY + timedelta(days=i), 9.0 if i % 10 == 0 else 0.0, 4.0, i % 2, 0, 0) for i in range(60)]
    days += [("b", DAY + timedelta(days=i), 5.0, 2.0 + i % 3, 0, 0, 0) for i in range(60)] + [("b", DAY, None, 7.0, 0, 0, 0)]
    table = spark.createDataFrame(days, "item_code string, day_dt date, ttl_quantity double, unit_price double, weekday int, day_type int, is_5th int")
    features = ["unit_price", "weekday", "day_type", "is_5th", "item_code"]
    merged = M.merge_alike(table.withColumn("weight", F.lit(1.0)), features)
    assert rows(merged, "item_code", "unit_price", "weekday", "weight", "ttl_quantity", "low", "high") == [
        ("a", 4.0, 0, 30.0, 1.8, 0.0, 9.0), ("a", 4.0, 1, 30.0, 0.0, 0.0, 0.0),
        ("b", 2.0, 0, 20.0, 5.0, 5.0, 5.0), ("b", 3.0, 0, 20.0, 5.0, 5.0, 5.0), ("b", 4.0, 0, 20.0, 5.0, 5.0, 5.0), ("b", 7.0, 0, 1.0, None, None, None),
    ]
    full, limits = table.where("ttl_quantity IS NOT NULL").withColumn("weight", F.lit(1.0)), M.TreeLimits(trees=4, depth=3)
    single, alike = (M.train_model(t, full, features, limits) for t in (full, M.merge_alike(full, features)))
    assert alike.overall == pytest.approx(single.overall) and alike.curve == pytest.approx(single.curve)
    assert rows(M.score(alike, full), "item_code", "weekday", "y_pred") == [
        (i, w, pytest.approx(y)) for i, w, y in rows(M.score(single, full), "item_code", "weekday", "y_pred")
    ]
    seen = []
    monkeypatch.setattr(R, "train_model", lambda train, *rest: seen.append(train.count()) or M.train_model(train, *rest))
    R.low_sales_round(full.drop("weight"), "2020-02-10", {"v1": ("2020-02-11", "2020-02-20"), "v2": ("2020-02-21", "2020-02-28")}, limits)
    assert seen == [2]


def test_a_batch_of_a_large_table_arrives_as_several_files(spark, tmp_path, monkeypatch):
    from checks import table_queries as Q
    from shelfwise import session

    lines = spark.range(3000).selectExpr("id AS l_orderkey", "id % 7 AS l_partkey", "id % 3 AS l_suppkey", "TIMESTAMP '1998-01-01 00:00:00' AS l_shipdate", "1.0D AS l_quantity")
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    made = []
    monkeypatch.setattr(Q, "DailySalesIngest", lambda *a, **k: made.append((a[1], k["files_per_batch"])) or DailySalesIngest(*a, **k))
    monkeypatch.setattr(session, "DEALT_BYTES", max(1, session._file_bytes(spark.read.parquet(str(tmp_path / "lineitem.parquet"))) // 18))
    got = Q.stream_merged_ingest(spark, str(tmp_path))
    (incoming, files), = made
    assert files >= 2 and len(spark.read.parquet(incoming).inputFiles()) == 9 * files
    assert got.count() == 21 and got.agg(F.sum("ttl_quantity")).first()[0] == 3000.0


def test_the_last_batch_is_taken_twice_with_its_rows(spark, tmp_path, monkeypatch):
    from checks import table_queries as Q

    lines = spark.range(900).selectExpr("nullif(id, 5) AS l_orderkey", "id % 7 AS l_partkey", "id % 3 AS l_suppkey", "TIMESTAMP '1998-01-01 00:00:00' AS l_shipdate", "1.0D AS l_quantity")
    lines.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    taken, take = [], DailySalesIngest._take_batch
    monkeypatch.setattr(DailySalesIngest, "_take_batch", lambda self, batch, k: taken.append((k, batch.count())) or take(self, batch, k))
    got = Q.stream_merged_ingest(spark, str(tmp_path))
    again = [n for k, n in taken if k == 9]
    assert len(again) == 2 and again[0] == again[1] > 0
    assert sum(n for _, n in taken) - again[0] == 900 == got.agg(F.sum("ttl_quantity")).first()[0]


def test_the_rows_of_a_round_are_made_once(spark, monkeypatch):
    from shelfwise.plans import forecast_round as R

    features = ("unit_price", "p_rate", "dis_spring", "loc_selling_area")
    rows_, offers, lunar, actual = model_inputs(spark)
    made = model_table(rows_, offers, lunar, actual, ForecastSettings(splits=SPLITS, features=features))
    assert any("/wanted-" in f for f in made.inputFiles())
    read = []
    monkeypatch.setattr(R, "eligibility", lambda table, *rest: read.extend(table.inputFiles()) or eligibility(table, *rest))
    horizons = (("2020-04-01", "2020-04-05"), ("2020-04-06", "2020-04-10"))
    settings = ForecastSettings(splits=SPLITS, features=("unit_price",), pass_share=0.75, horizons=horizons, latest_history="2020-02-01")
    offered = spark.createDataFrame([("i0",), ("i1",), ("i2",)], "item string")
    R.forecast_round(with_split(round_table(spark), SPLITS), settings, "now", offered, M.TreeLimits(trees=2, depth=2))
    assert read and all("/model-table-" in f for f in read)
