"""Hand-computed expectations for documents, categories and the merge."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from daystrata.functions import categories as C, dates as D, documents as J, text as TX
from daystrata.operators import daily as parse, merge, rollup, temporal
from daystrata.sources import history as H


def raw(spark, *documents):
    return spark.createDataFrame([(n, t if isinstance(t, str) else json.dumps(t)) for n, t in documents], "filename string, raw_json string")



def apply(spark, function, items, kind):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]


def test_stress_null_is_high(spark):
    assert apply(spark, C.stress_category, [None, -1, 25, 26, 50, 75, 76], "bigint") == [
        "HIGH", "RESTING", "RESTING", "LOW", "LOW", "MEDIUM", "HIGH"]
    assert apply(spark, C.stress_level_number, [None, 25, 50, 75, 76], "bigint") == [4, 1, 2, 3, 4]


def test_recovery(spark):
    assert apply(spark, C.recovery_status, [None, -20, -19, 0, 1, 20, 21], "bigint") == [
        "Heavy Drain", "Heavy Drain", "Slight Drain", "Slight Drain", "Good Recovery", "Good Recovery", "Great Recovery"]


def test_activity_level(spark):
    assert apply(spark, C.activity_level, [None, 4999, 5000, 7499, 7500, 9999, 10000], "bigint") == [
        "No Data", "Sedentary", "Low Active", "Low Active", "Moderate", "Moderate", "Active"]


def test_steps_documents(spark):
    docs = raw(
        spark,
        ("steps_2025-01-01.json", []),
        ("steps_2025-01-02.json", [{"steps": None}, {"primaryActivityLevel": "active"}]),
        ("steps_2025-01-03.json", [{"steps": 0, "primaryActivityLevel": "sedentary"}, {"steps": 0, "primaryActivityLevel": "highlyActive"}]),
        ("steps_2025-01-04.json", [{"steps": 999, "primaryActivityLevel": "active"}]),
        ("steps_2025-01-05.json", [{"steps": 400}, {"steps": "600", "primaryActivityLevel": "active"}]),
        ("steps_2025-01-06.json", {"steps": 5}),
    )
    rows = {r.date.day: r for r in parse.steps_daily(docs).collect()}
    assert sorted(rows) == [2, 3, 4, 5]
    assert (rows[2].steps, rows[2].data_quality) == (None, "OK")
    assert (rows[3].steps, rows[3].steps_raw, rows[3].data_quality, rows[3].max_activity_level) == (None, 0, "NO_DATA", "sedentary")
    assert (rows[4].steps, rows[4].data_quality) == (999, "LOW")
    assert (rows[5].steps, rows[5].data_quality) == (1000, "OK")
    one_pass = {r.date.day: (r.steps, r.steps_quality) for r in merge.daily_metrics(docs).collect()}
    assert one_pass == {d: (r.steps, r.data_quality) for d, r in rows.items()}


def test_other_documents(spark):
    docs = raw(
        spark,
        ("body_battery_2025-01-01.json", []),
        ("body_battery_2025-01-02.json", '\n [{"charged": 50, "drained": "70"}, {"charged": 1}]'),
        ("body_battery_2025-01-03.json", {"charged": 50}),
        ("heart_rate_2025-01-01.json", {"restingHeartRate": {"a": 1}, "maxHeartRate": 150}),
        ("sleep_2025-01-01.json", {"dailySleepDTO": {"sleepTimeSeconds": 5400}, "avgOvernightHrv": 41.5}),
        ("stress_undated.json", {"avgStressLevel": 30}),
    )
    battery = {r.date.day: (r.charged, r.drained, r.net_battery) for r in parse.body_battery_daily(docs).collect()}
    assert battery == {1: (None, None, None), 2: (50, 70, -20), 3: (None, None, None)}
    heart = parse.heart_rate_daily(docs).first()
    assert (heart.resting_hr, heart.max_hr) == (None, 150)
    assert parse.sleep_daily(docs).first().sleep_hours == 1.5
    assert parse.stress_daily(docs).first().date is None


def _five(day, stress=30):
    return [
        (f"steps_{day}.json", [{"steps": 10}]), (f"body_battery_{day}.json", [{"charged": 5, "drained": 1}]),
        (f"heart_rate_{day}.json", {"restingHeartRate": 50}), (f"stress_{day}.json", {"avgStressLevel": stress}),
        (f"sleep_{day}.json", {"dailySleepDTO": {"sleepTimeSeconds": 3600}}),
    ]


def _sides(docs):
    return {
        "steps": parse.steps_daily(docs), "body_battery": parse.body_battery_daily(docs), "heart_rate": parse.heart_rate_daily(docs),
        "stress": parse.stress_daily(docs), "sleep": parse.sleep_daily(docs),
    }


def ordered(df):
    return sorted(map(str, df.collect()))


def test_merge_forms_agree_and_keep_undated_rows_apart(spark):
    docs = raw(spark, *_five("2025-01-01"), *_five("2025-01-03")[:3], *_five("nodate"), ("stress_2025-01-09.json", {"avgStressLevel": 7}))
    chain = ordered(merge.merge_daily(_sides(docs), form="chain"))
    assert len(chain) == 3 + 5
    assert ordered(merge.merge_daily(_sides(docs))) == chain
    assert ordered(merge.merge_daily(_sides(docs), form="lists")) == chain
    assert merge.merge_daily(_sides(docs.filter("false")), form="lists").count() == 0
    assert ordered(merge.daily_metrics(docs)) == chain


def test_duplicates_multiply_in_chain_and_lists_and_raise_in_the_group(spark):
    docs = raw(spark, *_five("2025-01-01"), *_five("2025-01-01", 60)[1:4], *_five("2025-01-03")[:3], *_five("nodate"), *_five("nodate", 60)[2:3])
    chain = ordered(merge.merge_daily(_sides(docs), form="chain"))
    assert len(chain) == 8 + 1 + 6 and ordered(merge.merge_daily(_sides(docs), form="lists")) == chain
    docs = raw(spark, *_five("2025-01-01"), *_five("2025-01-01", 60)[1:4])
    assert merge.duplicate_documents(docs).count() == 3
    for run in (lambda: merge.merge_daily(_sides(docs)), lambda: merge.daily_metrics(docs)):
        with pytest.raises(Exception, match="more than one document"):
            run().collect()


def test_missing_stress_side(spark):
    docs = raw(spark, ("body_battery_2025-01-01.json", [{"charged": 5, "drained": 1}]))
    row = rollup.dashboard_daily(merge.daily_metrics(docs)).first()
    assert (row.stress_category, row.stress_level_num, row.has_steps_data) == (None, 4, False)


def test_strict_cast_raises(spark):
    docs = raw(spark, ("stress_2025-01-01.json", {"avgStressLevel": "many"}))
    assert parse.stress_daily(docs).first().avg_stress is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse.stress_daily(docs, strict=True).collect()


def test_new_year_week_splits(spark):
    days = [dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2025, 1, 1)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select(
        D.week_start(F.col("d")).alias("s"), D.week_label(F.col("d")).alias("w")).distinct().collect()
    assert {(r.s, r.w) for r in rows} == {(days[0], "2024-W01"), (days[0], "2025-W01")}


def test_names_and_dates(spark):
    assert apply(spark, D.date_of_name, ["steps_2025-02-03.json", "steps.json", "x_2025-13-99.json"], "string") == [
        dt.date(2025, 2, 3), None, None]


def test_json_scalar(spark):
    docs = ['{"a": 1}', '{"a": "t"}', '{"a": null}', '{}', '{"a": {"b": 1}}', '{"a": [1]}', "oops"]
    assert apply(spark, lambda c: J.json_scalar(c, "$.a"), docs, "string") == ["1", "t", None, None, None, None, None]


def test_valid_payload(spark):
    cases = {
        "[]": False, "{}": False, '{"a": 0}': False, '{"a": false}': False, '{"a": 0.0}': False, '{"a": 0e0}': False, '{"a": "null"}': False,
        '{"a": null, "b": "", "c": [], "d": {}}': False, "5": False, '"text"': False, "broken": False,
        "[0]": True, '{"a": "0"}': True, '{"a": true}': True, '{"a": 0, "b": 2}': True, '{"a": {"b": null}}': True, '[{"a": 1}, [2]]': True,
    }
    assert apply(spark, J.valid_payload, list(cases), "string") == list(cases.values())


def test_reply_rows(spark):
    song = '[{"title": "T", "artist": "A", "reason": "R"}]'
    replies = [f"```json\n{song}\n``` bye", f"```\n{song}```", f"  {song}\n", "no list", "", None]
    got = apply(spark, J.reply_rows, replies, "string")
    assert [[r.title for r in rows] for rows in got] == [["T"], ["T"], ["T"], ["Parsing Error"], ["Error"], ["Error"]]


def test_fixed_equals_python_format(spark):
    numbers = [0.5, 1.5, 2.5, -0.4, -0.5, 0.25, 0.35, 0.15, 0.45, 1.005, 2.675, 0.125, 0.375, 8.345, 0.465, 1234567.85, 0.0, -2.25, 99.995, 1e-9, 72.0]
    numbers += [i / 40 for i in range(-90, 400)] + [i / 1000 for i in range(0, 3000, 5)]
    for digits in (0, 1, 2):
        assert apply(spark, lambda c: TX.fixed(c, digits), numbers, "double") == [f"{x:.{digits}f}" for x in numbers]
    assert apply(spark, lambda c: TX.fixed(c, 0, thousands=True), [1234567.5, None], "double") == ["1,234,568", None]


def test_street_names(spark):
    rows = spark.createDataFrame([(1, "Main Street 12A, City"), (2, "Main Street 12a"), (3, ""), (4, None), (5, " Elm 7 "), (6, "12")], "n int, a string")
    got = [r.s for r in rows.select("n", TX.street_name(F.col("a"), F.col("n")).alias("s")).orderBy("n").collect()]
    assert got == ["Main Street", "Main Street 12a", "Location3", "Location4", "Elm 7", "12"]


def test_reason_text_lowers_the_tail(spark):
    row = spark.createDataFrame(
        [(70.4, 6.04, -16.0, "cozy_indoor", 4.0, 6.0, 3, 4, 0.45, 25)],
        "s double, h double, n double, m string, t double, p double, parks int, bars int, v double, l int")
    args = [F.col(c) for c in row.columns]
    assert row.select(TX.reason_text(*args).alias("r")).first().r == (
        'Your high stress level (70/100) + limited sleep (6.0hr) + drained energy (battery: -16). today\'s cold (4.0°c) & rainy (6.0mm) '
        'weather. suggest a "cozy indoor" mood (need for warmth and comfort). Location has: 3 parks within 1km, 4 bars nearby. '
        'Matching conditions: NDVI: 0.45, nightlight: 25.')
    args[6] = F.lit(None).cast("int")
    assert row.select(TX.reason_text(*args).alias("r")).first().r.endswith(". This café matches your preferred environment.")


def test_history_with_comments(spark):
    docs = spark.createDataFrame([
        ('{"_comment": "text", "_rules": {"a": "b"}, "X": ["2025-01-02", "2025-01-01"], "Y": []}',), ("not json",)], "raw_json string")
    got = {(r.name, r.visit_date) for r in H.history_rows(docs).collect()}
    assert got == {("X", "2025-01-02"), ("X", "2025-01-01")}
    assert H.last_visits(H.history_rows(docs)).first().last_visit == "2025-01-02"


def test_history_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("X", "2025-01-01")], "name string, visit_date string")
    new = spark.createDataFrame([("X", "2025-01-01"), ("Y", None), ("Y", None)], "name string, visit_date string")
    once = H.history_upsert(old, new, as_of=dt.date(2025, 2, 1))
    assert {tuple(r) for r in once.collect()} == {("X", "2025-01-01"), ("Y", "2025-02-01")}
    assert H.history_upsert(once, new, as_of=dt.date(2025, 2, 1)).count() == 2


def test_windows_count_rows_not_days(spark):
    days = [1, 2, 5, 9, 20]
    rows = spark.createDataFrame([(dt.date(2025, 1, d), float(d)) for d in days], "date date, avg_stress double").selectExpr(
        "*", "1D resting_hr", "2D sleep_hours", "3D deep_sleep_hours", "4L charged", "5D net_battery", "if(avg_stress = 5, null, 6L) steps", "7D avg_overnight_hrv")
    got = temporal.dashboard_correlations(rows.withColumn("avg_stress", F.expr("if(avg_stress = 2, null, avg_stress)"))).orderBy("date").collect()
    assert [r.next_day_stress for r in got] == [5.0, 9.0, 20.0, None]
    assert [r.prev_day_steps for r in got] == [None, 6, None, 6]
