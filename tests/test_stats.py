"""Medians, fills, histograms, scaling."""

import random
import statistics

import pytest

from daystrata.operators import features as FE, stats


def test_median_of_the_fixture(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "x int")
    assert stats.exact_medians(df, ["x"]).first().median == 2.5
    assert sorted(r.x for r in FE.median_fill(df.selectExpr("double(x) x"), ["x"]).collect()) == [1, 2, 2.5, 3, 10]


@pytest.mark.parametrize("bins,accuracy", [(1, 5), (8, 50), (1024, 10000)])
def test_exact_medians_against_python(spark, bins, accuracy):
    random.seed(bins)
    rows = []
    for i in range(3000):
        key = ["hot", "hot", "b", "c", None][i % 5] if i < 2998 else "single"
        rows.append((key, random.choice([0.5, random.gauss(0, 1), random.expovariate(0.01)]), random.randrange(7) if i % 3 else None))
    df = spark.createDataFrame(rows, "k string, x double, y int")
    got = {(r.k, r.column): r.median for r in stats.exact_medians(df, ["x", "y"], keys=["k"], bins=bins, accuracy=accuracy).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        for i, name in ((1, "x"), (2, "y")):
            values = [r[i] for r in rows if r[0] == key and r[i] is not None]
            if values:
                want[key, name] = statistics.median(values)
    assert got == pytest.approx(want)


def test_median_fill_by_key_and_all_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", None), ("b", None)], "k string, x double")
    got = {(r.k, r.x) for r in FE.median_fill(df, ["x"], keys=["k"]).collect()}
    assert got == {("a", 1.0), ("a", 4.0), ("a", 2.5), ("b", None)}


def test_more_than_half_missing_is_strict(spark):
    rows = [(None if i < 50 else i, None if i < 51 else i, i) for i in range(100)]
    df = spark.createDataFrame(rows, "half int, more int, full int")
    assert FE.sparse_columns(df) == ["more"]
    assert FE.drop_sparse_columns(df).columns == ["half", "full"]
    assert [r.column for r in stats.sparse_profile(df).collect()] == ["more"]


def test_min_rows_guard_is_strict(spark):
    assert FE.min_rows_guard(spark.range(20)).count() == 0
    assert FE.min_rows_guard(spark.range(21)).count() == 21
    keyed = spark.range(41).selectExpr("id", "id % 2 as k")
    assert {r.k for r in FE.min_rows_guard(keyed, keys=["k"]).collect()} == {0}


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(0, 41)] + [(None,)], "x double")
    counts = [r.days for r in stats.histogram(df, "x").orderBy("bin").collect()]
    assert counts == [2] * 19 + [3]
    flat = stats.histogram(spark.createDataFrame([(5.0,), (5.0,)], "x double"), "x").orderBy("bin").collect()
    assert [r.days for r in flat] == [2] + [0] * 19


def test_standardize_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    assert sorted(tuple(r) for r in FE.standardize(df, ["x", "c"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_ranges_and_columns(spark):
    import datetime as dt

    df = spark.range(5).selectExpr("date_add(date'2025-01-01', cast(id as int)) as date", "id", "'t' as t")
    assert FE.date_range_filter(df, dt.date(2025, 1, 2), dt.date(2025, 1, 4)).count() == 3
    assert FE.date_range_filter(df, dt.date(2025, 1, 2), None).count() == 5
    assert FE.numeric_columns(df) == ["id"]
    assert FE.existing_columns(df, ["zz", "t", "date"]) == ["t", "date"]


def test_direction_and_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, 6.5, 1.0)], "x double, y double, c double")
    rows = {r.feature: (r.corr, r.direction) for r in stats.pearson_corr(df, ["x", "c"], "y").collect()}
    assert rows["x"][1] == "increases" and rows["c"] == (None, "decreases")
    line = {r.x: (r.n, r.slope) for r in stats.ols_trend(df, [("x", "y"), ("c", "y")]).collect()}
    assert line["x"] == (3, pytest.approx(2.25)) and line["c"] == (3, None)
    m = stats.regression_metrics(df, "x", "y").first()
    assert m.mae == pytest.approx((1 + 2 + 3.5) / 3) and m.rmse == pytest.approx(((1 + 4 + 12.25) / 3) ** 0.5)
    assert stats.max_in_group(df, "y").select("group_max").distinct().collect()[0][0] == 6.5


def test_medians_scan_the_source_twice(spark, tmp_path):
    rows = [(i, float(i * 7919 % 1013), None if i % 5 else float(i % 3)) for i in range(4000)]
    spark.createDataFrame(rows, "id bigint, x double, y double").write.parquet(f"{tmp_path}/m")
    medians = stats.exact_medians(spark.read.parquet(f"{tmp_path}/m"), ["x", "y"])
    found = {r["column"]: r["median"] for r in medians.collect()}
    assert found == {"x": statistics.median(r[1] for r in rows), "y": statistics.median(r[2] for r in rows if r[2] is not None)}
    final = medians._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and "ReusedExchange" in final
