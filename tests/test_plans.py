"""Shapes of the plans that matter at scale, and independence of partitioning."""

import pytest
from pyspark.sql import functions as F

from daystrata.operators import daily as parse, merge, rollup, temporal
from daystrata.plans import sample as X
from daystrata.plans.views import build_views
from daystrata.sources import raw as RAW


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark, folder, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "docs")
    X.raw_documents(spark, folder).write.parquet(path)
    return spark.read.parquet(path)


def test_one_pass_merge_has_one_exchange_and_one_parse_per_shape(landed):
    text = plan(merge.daily_metrics(landed, keys=X.KEYS))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
    assert text.count("from_json") == 2
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_the_chain_needs_more_exchanges(spark, landed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = {n: getattr(parse, f"{n}_daily")(landed, keys=X.KEYS) for n in ("steps", "body_battery", "heart_rate", "stress", "sleep")}
        chain, grouped = plan(merge.merge_daily(sides, keys=X.KEYS, form="chain")), plan(merge.merge_daily(sides, keys=X.KEYS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert chain.count("SortMergeJoin") == 4 and chain.count("Exchange") >= 8
    assert "Join" not in grouped and grouped.count("Exchange") == 2  # steps totals, then the merge


def test_windows_share_one_sort(landed):
    text = plan(temporal.dashboard_trends(merge.daily_metrics(landed, keys=X.KEYS), keys=X.KEYS))
    assert text.count("Exchange") == 2 and text.count("Sort [") == 1


def test_filters_on_key_and_day_reach_the_scan(spark, folder, tmp_path):
    RAW.write_raw(X.raw_documents(spark, folder), str(tmp_path / "lake"))
    days = merge.daily_metrics(spark.read.parquet(str(tmp_path / "lake")), keys=X.KEYS)
    some = days.filter("user_id = 3 and date between date'2024-01-05' and date'2024-01-09'")
    scan = [line for line in plan(some).splitlines() if "FileScan" in line][0]
    pushed = scan[scan.index("PushedFilters"):]
    assert "EqualTo(user_id,3)" in pushed and "GreaterThanOrEqual(date" in pushed
    assert lines(some) == lines(X.daily(spark, folder).filter("user_id = 3 and date between date'2024-01-05' and date'2024-01-09'"))


def test_unused_columns_are_not_read(landed):
    text = plan(merge.duplicate_documents(landed, keys=X.KEYS))
    assert "raw_json" not in text


def test_last_rows_are_limited_before_the_shuffle(landed):
    text = plan(temporal.recent_means(merge.daily_metrics(landed, keys=X.KEYS), keys=X.KEYS))
    assert text.count("WindowGroupLimit") == 2


def test_rollups_aggregate_before_the_shuffle(landed):
    text = plan(rollup.dashboard_monthly(merge.daily_metrics(landed, keys=X.KEYS), keys=X.KEYS))
    assert text.count("Exchange") == 2 and text.count("HashAggregate") == 4


def lines(df):
    return sorted(map(str, df.collect()))


def test_results_do_not_depend_on_partitioning(landed):
    one, other = build_views(landed.coalesce(1), keys=X.KEYS), build_views(landed.repartition(13, F.rand(3)), keys=X.KEYS)
    for name in ("v_steps_daily", "v_daily_metrics", "v_dashboard_weekly", "v_dashboard_monthly", "v_dashboard_correlations", "v_dashboard_trends"):
        assert lines(one[name]) == lines(other[name]), name


def test_keyless_form_equals_the_keyed_form_of_one_user(landed):
    user = landed.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").first().user_id
    mine = landed.filter(F.col("user_id") == user)
    keyed, plain = build_views(mine, keys=X.KEYS), build_views(mine.drop("user_id"))
    for name, df in plain.items():
        assert lines(df) == lines(keyed[name].drop("user_id")), name
    split = temporal.dashboard_trends(plain["v_daily_metrics"], split=8)
    assert lines(split) == lines(plain["v_dashboard_trends"])
