"""Validation, forecast reports, export and correlation."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables as t
from checks.registry import near, near_sql, query, rounded
from checks.sales_queries import feature_rows
from checks.tables import WINDOWS
from shelfwise.constants import CORRELATION_FEATURES
from shelfwise.operators import correlate as Y
from shelfwise.operators import evaluate as V
from shelfwise.plans import correlation as P
from shelfwise.plans import export as X
from shelfwise.session import shared_dir

_SELL = """SELECT item_code, "window", loc_wh, sum(ttl_quantity) AS ttl_quantity, sum(y_pred) AS y_pred, sum(ttl_quantity) / nullif(sum(y_pred), 0) AS ratio
    FROM scored_windows GROUP BY ALL"""


def _share(condition: str) -> str:
    return near_sql(f"avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)")


@query(
    f"""SELECT item_code, "window", loc_wh, ttl_quantity, {near_sql('y_pred', 2)} AS y_pred, {near_sql('ratio', 3)} AS ratio, {near_sql('price')} AS unit_price
    FROM ({_SELL}) JOIN (SELECT item_code, "window", avg(unit_price) AS price FROM scored_windows GROUP BY ALL) USING (item_code, "window")""",
    ("scored_windows",),
)
def sell_through_by_warehouse(spark: SparkSession, d: str) -> DataFrame:
    results = V.sell_through(t.scored(spark, d), WINDOWS, digits=10)
    return results.withColumns({"y_pred": near("y_pred", 2), "ratio": near("ratio", 3), "unit_price": near("unit_price")})


@query(
    f"""SELECT item_code, {_share('ratio <= 0.5')} AS upto_50, {_share('ratio BETWEEN 0.5 AND 0.8')} AS from_50_to_80, {_share('ratio BETWEEN 0.8 AND 1')} AS from_80_to_100,
        {_share('ratio BETWEEN 1 AND 1.2')} AS from_100_to_120, {_share('ratio >= 1.2')} AS from_120, {_share('ratio BETWEEN 0.65 AND 1.2')} AS from_65_to_120
    FROM (SELECT item_code, round(ratio, 4) AS ratio FROM ({_SELL})) GROUP BY item_code""",
    ("scored_windows",),
)
def ratio_buckets(spark: SparkSession, d: str) -> DataFrame:
    bands = V.ratio_bands(V.sell_through(t.scored(spark, d), WINDOWS))
    return rounded(bands, *[c for c in bands.columns if c != "item_code"])


@query(
    f"""SELECT item_code, {near_sql('share')} AS share_in_band, CAST(CASE WHEN share >= 0.3 THEN 1 ELSE 0 END AS BIGINT) AS passed
    FROM (SELECT item_code, avg(CASE WHEN round(ratio, 4) BETWEEN 0.65 AND 1.2 THEN 1.0 ELSE 0.0 END) AS share FROM ({_SELL}) GROUP BY item_code)""",
    ("scored_windows",),
)
def pass_gate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.pass_gate(V.sell_through(t.scored(spark, d), WINDOWS), 0.3), "share_in_band")


_ACCURACY = """SELECT item_code, "window", avg(CASE WHEN ttl_quantity - y_pred BETWEEN least(-1.0, -0.5 * a) AND greatest(1.0, a) THEN 1.0 ELSE 0.0 END) AS accuracy
    FROM (SELECT *, sum(ttl_quantity) OVER (PARTITION BY item_code, "window", store_id) / 4 AS a FROM scored_windows) GROUP BY ALL"""
_OVERALL = 'SELECT item_code, "window", sum(ttl_quantity) / nullif(sum(y_pred), 0) AS sell_thru FROM scored_windows GROUP BY ALL'


@query(f'SELECT item_code, "window", {near_sql("accuracy")} AS accuracy FROM ({_ACCURACY})', ("scored_windows",))
def store_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.store_accuracy(V.in_windows(t.scored(spark, d), WINDOWS)), "accuracy")


@query(f'SELECT item_code, "window", {near_sql("sell_thru")} AS sell_thru FROM ({_OVERALL})', ("scored_windows",))
def overall_sell_through(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.overall_sell_through(V.in_windows(t.scored(spark, d), WINDOWS)), "sell_thru")


@query(
    f"""SELECT item_code, day_dt, sum(ttl_quantity) AS ttl_quantity, {near_sql('sum(y_pred)', 2)} AS y_pred, {near_sql('avg(unit_price)')} AS unit_price,
        {near_sql('sum(ttl_quantity) / nullif(sum(y_pred), 0)')} AS ratio FROM scored GROUP BY ALL""",
    ("scored",),
)
def daily_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.daily_report(t.scored(spark, d)), "unit_price", "ratio").withColumn("y_pred", near("y_pred", 2))


@query(
    f"""SELECT split, item_code, day_dt, sum(ttl_quantity) AS ttl_quantity, {near_sql('sum(y_pred)', 2)} AS y_pred, {near_sql('avg(unit_price)')} AS unit_price,
        count(DISTINCT store_id) AS store_cnt FROM scored GROUP BY ALL""",
    ("scored",),
)
def split_series(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.split_series(t.scored(spark, d)), "unit_price").withColumn("y_pred", near("y_pred", 2))


@query(
    """SELECT item_code, count(*) FILTER (WHERE total < 100) AS n_low FROM (SELECT item_code, loc_wh, sum(y_pred) AS total FROM scored WHERE split = 'test' GROUP BY ALL) GROUP BY ALL""",
    ("scored",),
)
def low_volume_warehouses(spark: SparkSession, d: str) -> DataFrame:
    return V.low_volume_warehouses(t.scored(spark, d).where("split = 'test'"))


@query(
    """SELECT item_code, store_id, day_dt, ttl_quantity FROM scored s WHERE split = 'test'
        AND EXISTS (SELECT 1 FROM scored_windows w WHERE w.item_code = s.item_code AND w.store_id = s.store_id)""",
    ("scored", "scored_windows"),
)
def validated_test_stores(spark: SparkSession, d: str) -> DataFrame:
    rows = t.scored(spark, d)
    kept = V.test_stores(rows.where("split = 'test'"), rows.where("split IN ('v1', 'v2')"))
    return kept.select("item_code", "store_id", "day_dt", "ttl_quantity")


@query(
    """SELECT item_code, test_store_cnt, coalesce(n_repeated, 0) AS n_repeated
    FROM (SELECT p_brand AS item_code, count(DISTINCT l_suppkey) AS test_store_cnt FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
    LEFT JOIN (SELECT item_code, count(*) AS n_repeated FROM (SELECT p_brand AS item_code, l_suppkey, l_shipdate FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY ALL HAVING count(*) > 1) GROUP BY item_code) USING (item_code)"""
)
def store_check(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "lineitem").join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return V.store_check(
        rows.select(F.col("p_brand").alias("item_code"), F.col("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("day_dt"))
    )


@query(
    f"""SELECT item_code, {", ".join(f"coalesce(sum(CASE WHEN day_dt BETWEEN DATE '{a}' AND DATE '{b}' THEN ttl_quantity END), 0) AS {w}_ttl_quantity" for w, (a, b) in WINDOWS.items())},
        {", ".join(near_sql(f"coalesce(sum(CASE WHEN day_dt BETWEEN DATE '{a}' AND DATE '{b}' THEN y_pred END), 0)", 2) + f" AS {w}_y_pred" for w, (a, b) in WINDOWS.items())}
    FROM scored GROUP BY item_code""",
    ("scored",),
)
def two_window_totals(spark: SparkSession, d: str) -> DataFrame:
    totals = V.window_totals(t.scored(spark, d), WINDOWS)
    return totals.withColumns({"v1_y_pred": near("v1_y_pred", 2), "v2_y_pred": near("v2_y_pred", 2)})


@query("SELECT item_code, store_id, day_dt, " + near_sql("ttl_quantity - y_pred") + " AS residual FROM scored", ("scored",))
def residuals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(V.with_residual(t.scored(spark, d)).select("item_code", "store_id", "day_dt", "residual"), "residual")


@query(
    """SELECT 'SC_A5_LGBM_V1' AS model_id, item_code, store_id, day_dt, ttl_quantity, CASE WHEN y_pred - 20 < 0 THEN 0 ELSE round(y_pred - 20, 4) END AS y_pred, CAST(1 AS BIGINT) AS istest
    FROM scored WHERE split = 'test'""",
    ("scored",),
)
def result_export(spark: SparkSession, d: str) -> DataFrame:
    rows = t.scored(spark, d).withColumn("y_pred", F.col("y_pred") - 20)
    return X.test_result(X.result_table(rows.where("split <> 'test'"), rows.where("split = 'test'")))


_HORIZONS = (("2000-10-01", "2000-10-31"), ("2000-11-01", "2000-11-30"), ("2000-12-01", "2000-12-15"), ("2000-12-16", "2000-12-31"))
_SUMMARY = f"""SELECT item_code, {", ".join(
    f"strftime(max(first) FILTER (WHERE w = '{w}'), '%Y-%m-%d') AS {w}_start_time, strftime(max(last) FILTER (WHERE w = '{w}'), '%Y-%m-%d') AS {w}_end_time, "
    f"{near_sql(f'max(accuracy) FILTER (WHERE w = {chr(39)}{w}{chr(39)})', 3)} AS {w}_accuracy, {near_sql(f'max(sell_thru) FILTER (WHERE w = {chr(39)}{w}{chr(39)})', 3)} AS {w}_sell_thru"
    for w in WINDOWS)}
    FROM (SELECT item_code, "window" AS w, min(day_dt) AS first, max(day_dt) AS last FROM scored_windows GROUP BY ALL)
    JOIN (SELECT item_code, "window" AS w, accuracy FROM ({_ACCURACY})) USING (item_code, w)
    JOIN (SELECT item_code, "window" AS w, sell_thru FROM ({_OVERALL})) USING (item_code, w) GROUP BY item_code"""
_SUMMARY_ROUNDED = ["v1_accuracy", "v1_sell_thru", "v2_accuracy", "v2_sell_thru"]


@query(_SUMMARY, ("scored_windows",))
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    summary = X.validation_summary(t.scored(spark, d), WINDOWS, digits=10)
    return rounded(summary, *_SUMMARY_ROUNDED, digits=3)


@query(
    f"""SELECT 'SC_A5_LGBM_V1' AS model_id, 'TopSales' AS scenario, 'A5' AS aid, 'now' AS model_time, '' AS log_path, '' AS result_path, '' AS img_path,
        s.*, CAST(NULL AS VARCHAR) AS package, test_store_cnt, test_start_time, test_end_time
    FROM ({_SUMMARY}) s JOIN (SELECT item_code, count(DISTINCT store_id) AS test_store_cnt FROM scored WHERE split = 'test' GROUP BY ALL) USING (item_code),
    (VALUES {", ".join(str(h) for h in _HORIZONS)}) h(test_start_time, test_end_time)""",
    ("scored_windows", "scored"),
)
def metadata_horizons(spark: SparkSession, d: str) -> DataFrame:
    rows = t.scored(spark, d)
    summary = rounded(X.validation_summary(rows, WINDOWS, digits=10), *_SUMMARY_ROUNDED, digits=3)
    return X.metadata_table(summary, rows.where("split = 'test'"), _HORIZONS, "now")


_BANDS = {
    "upto_50": "ratio <= 0.5", "from_50_to_80": "ratio BETWEEN 0.5 AND 0.8", "from_80_to_100": "ratio BETWEEN 0.8 AND 1.0",
    "from_100_to_120": "ratio BETWEEN 1.0 AND 1.2", "from_120": "ratio >= 1.2", "from_65_to_120": "ratio BETWEEN 0.65 AND 1.2",
    "share_in_band": "ratio BETWEEN 0.65 AND 1.2",
}


@query(
    f"""SELECT r.*, v.* EXCLUDE (item_code), s.test_store_cnt, s.n_repeated, l.n_low
    FROM (SELECT item_code, {", ".join(f"{_share(c)} AS {n}" for n, c in _BANDS.items())},
              CAST(CASE WHEN avg(CASE WHEN ratio BETWEEN 0.65 AND 1.2 THEN 1.0 ELSE 0.0 END) >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS passed
          FROM (SELECT item_code, round(ratio, 4) AS ratio FROM ({_SELL})) GROUP BY item_code) r
    JOIN ({_SUMMARY}) v ON r.item_code = v.item_code
    JOIN (SELECT item_code, count(DISTINCT store_id) AS test_store_cnt, CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_repeated
          FROM (SELECT item_code, store_id, day_dt, count(*) AS n FROM scored WHERE split = 'test' GROUP BY ALL) GROUP BY ALL) s ON r.item_code = s.item_code
    JOIN (SELECT item_code, count(*) FILTER (WHERE total < 100) AS n_low FROM (SELECT item_code, loc_wh, sum(y_pred) AS total FROM scored WHERE split = 'test' GROUP BY ALL) GROUP BY ALL) l
      ON r.item_code = l.item_code""",
    ("scored_windows", "scored"),
)
def validation_report(spark: SparkSession, d: str) -> DataFrame:
    """Every column of the report; the summary's shares to three digits, as in `validation_summary`."""
    rows = t.scored(spark, d)
    report = X.validation_report(rows, rows.where("split = 'test'"), WINDOWS, 0.5, digits=10)
    return rounded(rounded(report, *_BANDS), *_SUMMARY_ROUNDED, digits=3)


# --- correlation ------------------------------------------------------------------------------------

_YEARS = list(range(1995, 2002))
_BASE = ["deal_price", "discount", "tax", "retail", "size", "weekday", "is_weekend", "constant"]
_FEATURES = [*_BASE, *[f"year_{y}" for y in _YEARS], *[f"month_{m}" for m in range(1, 13)]]
t.TABLES["measured"] = (
    (),
    f"""SELECT item_code, ttl_quantity, deal_price, discount, tax, retail, size, CAST(isodow(d) - 1 AS DOUBLE) AS weekday, CASE WHEN isodow(d) > 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend, 1.0::DOUBLE AS constant,
        {", ".join(f"CASE WHEN year(d) = {y} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS year_{y}" for y in _YEARS)}, {", ".join(f"CASE WHEN month(d) = {m} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS month_{m}" for m in range(1, 13))}
    FROM (SELECT p_brand AS item_code, l_quantity AS ttl_quantity, coalesce(CASE WHEN l_linenumber <> 4 THEN l_extendedprice / l_quantity END, 0) AS deal_price, l_discount AS discount, l_tax AS tax,
                 p_retailprice AS retail, CAST(p_size AS DOUBLE) AS size, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN part ON l_partkey = p_partkey)""",
)


def measured(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "lineitem").join(t.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    day = F.to_date("l_shipdate")
    base = rows.select(
        F.col("p_brand").alias("item_code"),
        F.col("l_quantity").alias("ttl_quantity"),
        F.when(F.col("l_linenumber") != 4, F.col("l_extendedprice") / F.col("l_quantity")).alias("deal_price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("p_retailprice").alias("retail"),
        F.col("p_size").alias("size"),
        F.weekday(day).alias("weekday"),
        (F.weekday(day) >= 5).cast("int").alias("is_weekend"),
        F.lit(1).alias("constant"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )
    return Y.with_calendar_dummies(base, _YEARS)


_LONG = "\nUNION ALL ".join(
    f"""SELECT item_code, '{f}' AS feature, CASE WHEN min({f}) < max({f}) AND min(ttl_quantity) < max(ttl_quantity) THEN covar_pop({f}, ttl_quantity) / (stddev_pop({f}) * stddev_pop(ttl_quantity)) END AS corr FROM measured GROUP BY item_code"""
    for f in ["ttl_quantity", *_FEATURES]
)
_TOP = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY round(abs(corr), 9) DESC NULLS LAST, feature) AS rank FROM ({_LONG})) WHERE rank <= 10"""


@query(f"SELECT item_code, feature, {near_sql('corr', 6)} AS corr FROM ({_LONG})", ("measured",))
def corr_long(spark: SparkSession, d: str) -> DataFrame:
    return rounded(Y.target_correlations(measured(spark, d), "ttl_quantity", _FEATURES), "corr", digits=6)


@query(f"SELECT item_code, feature, rank, {near_sql('corr', 6)} AS corr FROM ({_TOP})", ("measured",))
def corr_top10(spark: SparkSession, d: str) -> DataFrame:
    top = Y.top_correlated(Y.target_correlations(measured(spark, d), "ttl_quantity", _FEATURES))
    return rounded(top, "corr", digits=6)


_VALUE = "CASE feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in ["ttl_quantity", *_FEATURES]) + " END"


t.TABLES["numbered"] = (("measured",), "SELECT *, row_number() OVER () AS rn FROM measured")
t.TABLES["top_values"] = (
    ("numbered",),
    f"SELECT rn, m.item_code, rank, {_VALUE} AS v FROM numbered m JOIN ({_TOP}) tp ON m.item_code = tp.item_code",
)


@query(
    f"""SELECT item_code, i, j, {near_sql('coalesce(CASE WHEN min(a) < max(a) AND min(b) < max(b) THEN covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) END, 0)', 6)} AS corr
    FROM (SELECT x.item_code, x.rank - 1 AS i, y.rank - 1 AS j, x.v AS a, y.v AS b FROM top_values x JOIN top_values y USING (rn))
    GROUP BY item_code, i, j""",
    ("top_values",),
)
def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Cells of each item's top-10 matrix: row i, column j."""
    matrix = Y.top_matrix(measured(spark, d), "ttl_quantity", _FEATURES)
    rows = matrix.select("item_code", F.posexplode("data").alias("i", "line"))
    return rounded(rows.select("item_code", "i", F.posexplode("line").alias("j", "corr")), "corr", digits=6)


@query(
    f"""SELECT item_code AS item, i, j, max(a_name) AS row_name, max(b_name) AS col_name,
        {near_sql('coalesce(CASE WHEN min(a) < max(a) AND min(b) < max(b) THEN covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) END, 0)', 5)} AS corr
    FROM (SELECT x.item_code, x.rank - 1 AS i, y.rank - 1 AS j, x.v AS a, y.v AS b, xn.feature AS a_name, yn.feature AS b_name
          FROM top_values x JOIN top_values y USING (rn)
          JOIN ({_TOP}) xn ON xn.item_code = x.item_code AND xn.rank = x.rank JOIN ({_TOP}) yn ON yn.item_code = y.item_code AND yn.rank = y.rank)
    GROUP BY item_code, i, j""",
    ("top_values",),
)
def corr_json(spark: SparkSession, d: str) -> DataFrame:
    """The exported text, read back as JSON: the names in order and every number."""
    text = Y.matrix_json(Y.top_matrix(measured(spark, d), "ttl_quantity", _FEATURES))
    back = text.select("item", F.from_json("corr_json", "col_name array<string>, data array<array<double>>").alias("b"))
    rows = back.select("item", "b.col_name", F.posexplode("b.data").alias("i", "line"))
    cells = rows.select("item", "i", "col_name", F.posexplode("line").alias("j", "corr"))
    named = cells.select("item", "i", "j", F.get("col_name", F.col("i")).alias("row_name"), F.get("col_name", F.col("j")).alias("col_name"), "corr")
    return rounded(named, "corr", digits=5)


_REPORT_YEARS = list(range(1996, 2002))
_REPORT_FEATURES = [*CORRELATION_FEATURES, *[f"year_{y}" for y in _REPORT_YEARS], *[f"month_{m}" for m in range(1, 13)]]
t.TABLES["report_rows"] = (
    ("features", "sales"),
    f"""SELECT f.item_code, coalesce(f.ttl_quantity, 0) AS ttl_quantity, coalesce(s.ttl_amt_payment / nullif(f.ttl_quantity, 0), 0) AS deal_price,
        {", ".join(f"coalesce(CAST(f.{c} AS DOUBLE), 0) AS {c}" for c in CORRELATION_FEATURES if c != "deal_price")},
        {", ".join(f"CASE WHEN f.year = {y} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS year_{y}" for y in _REPORT_YEARS)}, {", ".join(f"CASE WHEN f.month = {m} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS month_{m}" for m in range(1, 13))}
    FROM features f LEFT JOIN sales s ON s.item_code = f.item_code AND s.store_id = f.store_id AND s.day_dt = f.day_dt""",
)
_FACTS = ", ".join(
    f"{{'feature': '{c}', 'corr': CASE WHEN min({c}) < max({c}) AND min(ttl_quantity) < max(ttl_quantity) THEN covar_pop({c}, ttl_quantity) / (stddev_pop({c}) * stddev_pop(ttl_quantity)) END}}"
    for c in ["ttl_quantity", *_REPORT_FEATURES]
)


@query(
    f"""SELECT item_code AS item, rank - 1 AS place, feature, {near_sql('coalesce(corr, 0)', 5)} AS corr FROM (
        SELECT *, row_number() OVER (PARTITION BY item_code ORDER BY round(abs(corr), 9) DESC NULLS LAST, feature) AS rank FROM (
            SELECT item_code, unnest(facts, recursive := true) FROM (SELECT item_code, [{_FACTS}] AS facts FROM report_rows GROUP BY item_code)))
    WHERE rank <= 10 QUALIFY bool_or(feature = 'ttl_quantity') OVER (PARTITION BY item_code)""",
    ("report_rows",),
)
def correlation_report(spark: SparkSession, d: str) -> DataFrame:
    """Feature rows to the exported text and back: each item's top features in order, and their correlation with sales."""
    paid = t.sales(spark, d).select("item_code", "store_id", "day_dt", "ttl_amt_payment")
    rows = feature_rows(spark, d).join(paid, ["item_code", "store_id", "day_dt"], "left")
    path = f"{shared_dir(spark).rstrip('/')}/correlations-{uuid.uuid4().hex}"
    P.export_correlations(P.correlation_report(rows, _REPORT_YEARS), path)
    back = P.read_correlations(spark, path).withColumn("b", F.from_json("corr_json", "col_name array<string>, data array<array<double>>"))
    line = F.get("b.data", F.array_position("b.col_name", F.lit("ttl_quantity")).cast("int") - 1)
    named = back.select("item", "b.col_name", line.alias("line")).where("array_contains(col_name, 'ttl_quantity')")
    cells = named.select("item", "col_name", F.posexplode("line").alias("place", "corr"))
    return rounded(cells.select("item", "place", F.get("col_name", F.col("place")).alias("feature"), "corr"), "corr", digits=5)
