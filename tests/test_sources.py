"""Files in, files out."""

import datetime as dt
import json

from pyspark.sql import functions as F

from daystrata.schemas import METRICS
from daystrata.sources import activities as A, places as P, raw as RAW, spine
from daystrata.streaming import landing


def docs(spark, n=6):
    return spark.range(n).select(
        F.concat(F.lit("stress_2025-01-0"), (F.col("id") + 1).cast("string"), F.lit(".json")).alias("filename"),
        F.to_json(F.struct(F.col("id").alias("avgStressLevel"))).alias("raw_json"))


def test_scan_reads_whole_files_of_one_folder(spark, tmp_path):
    (tmp_path / "activities").mkdir()
    (tmp_path / "activities" / "x.json").write_text("{}")
    (tmp_path / "stress_2025-01-01.json").write_text(json.dumps({"avgStressLevel": 5}, indent=2))
    (tmp_path / "steps_2025-01-01.json").write_text("[1,\n2]")
    (tmp_path / "broken.json").write_text("{oops")
    (tmp_path / "notes.txt").write_text("{}")
    rows = RAW.scan_raw_documents(spark, str(tmp_path))
    assert sorted(r.filename for r in rows.collect()) == ["steps_2025-01-01.json", "stress_2025-01-01.json"]
    assert sorted(r.raw_json for r in RAW.canonical_documents(rows).collect()) == ["[1,2]", '{"avgStressLevel":5}']


def test_canonical_text_is_equal_for_equal_content(spark):
    df = spark.createDataFrame([('{"b": 1, "a": [1.50, null]}',), ('{"a":[1.5,null],\n"b":1}',)], "raw_json string")
    assert RAW.canonical_documents(df).distinct().count() == 1


def test_reset_append_and_guard(spark, tmp_path):
    path = str(tmp_path / "raw")
    RAW.write_raw(docs(spark), path)
    RAW.write_raw(docs(spark), path)
    assert spark.read.parquet(path).count() == 6
    RAW.write_raw(docs(spark), path, reset=False)
    assert spark.read.parquet(path).count() == 12
    other = str(tmp_path / "other")
    docs(spark).withColumnRenamed("raw_json", "body").write.parquet(other)
    RAW.write_raw(docs(spark), other, reset=False)
    assert spark.read.parquet(other).columns == ["filename", "raw_json", "date", "metric"]
    assert RAW.missing_columns(docs(spark).drop("raw_json")) == ["raw_json"]


def test_partitioned_scan_prunes(spark, tmp_path):
    path = str(tmp_path / "raw")
    RAW.write_raw(docs(spark), path)
    plan = RAW.scan_metric(spark.read.parquet(path), "stress")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(metric" in plan


def test_landing_takes_every_file_once(spark, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "filename string, raw_json string"
    docs(spark, 3).write.json(source)
    landing.land_new_files(spark, source, target, mark, schema)
    landing.land_new_files(spark, source, target, mark, schema)
    assert landing.landed(spark, target).count() == 3
    docs(spark, 2).write.mode("append").json(source)
    landing.land_new_files(spark, source, target, mark, schema, max_files=1)
    assert landing.landed(spark, target).count() == 5


def test_spine_and_missing(spark):
    expected = spine.expected_documents(dt.date(2025, 1, 1), dt.date(2025, 1, 6), spark=spark)
    assert expected.count() == 6 * len(METRICS)
    missing = spine.missing_documents(expected, docs(spark, 4))
    assert missing.filter("metric = 'stress'").count() == 2 and missing.count() == 26
    assert spine.expected_documents(dt.date(2025, 1, 2), dt.date(2025, 1, 1), spark=spark).count() == 0


def test_spine_needs_no_shuffle(spark):
    owners = spark.range(3).withColumnRenamed("id", "user_id")
    expected = spine.expected_documents(dt.date(2025, 1, 1), dt.date(2025, 1, 6), owners=owners)
    assert "Exchange" not in expected._jdf.queryExecution().executedPlan().toString()


def test_activities(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({
        "activityId": 1, "activityTypeDTO": {"typeKey": "running"}, "summaryDTO": {"startTimeLocal": "2025-01-01T10:00:00.0", "distance": 5.5},
        "splitSummaries": [{"splitType": "RWD_RUN", "distance": 2.5}, {"splitType": "RWD_WALK"}]}, indent=1))
    (tmp_path / "list.json").write_text(json.dumps([
        {"activityId": 2, "activityName": "Tempo", "activityType": {"typeKey": "cycling"}, "startTimeLocal": "2025-01-02 10:00:00"}, {"activityId": 3}]))
    read = A.scan_activities(spark, str(tmp_path))
    assert read.filter("activityId = 1").select(F.size("splitSummaries"), "summaryDTO.distance").first()[:] == (2, 5.5)
    read = A.scan_activity_variants(spark, str(tmp_path))
    heads = {r.activity_id: tuple(r)[1:] for r in A.activity_headers(read).collect()}
    assert heads == {
        1: ("Unnamed", "running", "2025-01-01T10:00:00.0"), 2: ("Tempo", "cycling", "2025-01-02 10:00:00"), 3: ("Unnamed", "unknown", "unknown")}
    assert [r.activity_id for r in A.latest_activities(A.activity_headers(read), 3).collect()] == [2, 1, 3]


def test_place_lookups_take_the_first_match_or_zero(spark):
    base = spark.createDataFrame(
        [(1, "Elm 4, X", 1.0, 2.0, None, None), (2, "Oak 9b, X", 1.0, 2.0, 4.0, 7), (3, "", 0.0, 0.0, 1.0, 1)],
        "place_id bigint, address string, lat double, lon double, rating double, user_ratings_total int")
    parks = spark.createDataFrame([("Elm 4, X", 9, 1), ("Elm 4, X", 5, 0)], "address string, parks_count_1km int, ord int")
    bars = spark.createDataFrame([("Oak 9b, X", 3, 0)], "address string, open_bars_count_500m int, ord int")
    rows = P.place_table(base, parks, bars, position=F.col("place_id"), prefix="N_", label="N - ", default_address="Town").orderBy("place_id").collect()
    assert [tuple(r) for r in rows] == [
        (1, "N_Elm", "N - Elm", "Elm 4, X", 1.0, 2.0, None, None, 5, 0), (2, "N_Oak 9b", "N - Oak 9b", "Oak 9b, X", 1.0, 2.0, 4.0, 7, 0, 3),
        (3, "N_Location3", "N - Location3", "Town", 0.0, 0.0, 1.0, 1, 0, 0)]
    bare = P.place_table(base.drop("rating", "user_ratings_total"), parks, bars, position=F.col("place_id"), prefix="N_", label="N - ", default_address="Town")
    assert {(r.rating, r.user_ratings_total) for r in bare.collect()} == {(4.5, 0)}
