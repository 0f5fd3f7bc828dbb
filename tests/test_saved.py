"""Raw folders with faulty files, header presence, saved history, shared views, repeated documents, classifier chances."""

from pyspark.sql import Observation, functions as F

from daystrata import session
from daystrata.functions import documents as J
from daystrata.operators import merge, recommend as REC
from daystrata.plans import models as M, queries as Q, sample as X, views
from daystrata.sources import activities, history as H, places as PL, raw as RAW


def test_is_json(spark):
    texts = ['{"a":1}', '{"a":1,"a":2}', "[]", "5", '"x"', "null", " {}\n", "", "  ", "{", '{"a":1} x', "[1,]", "{'a':1}", '{"a":{"b":1,"b":2}}', "1,2", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r["ok"] for r in rows.orderBy("i").select(J.is_json(F.col("t")).alias("ok")).collect()] == [True] * 7 + [False] * 6 + [True, False, False]


def test_raw_folder_lists_rejected_files(spark):
    path = session.new_folder(spark, "raw")
    spark.range(3).select("id").coalesce(1).write.option("maxRecordsPerFile", 1).json(path)
    session.put_texts(spark, path, {"bad.json": "{", "empty.json": " ", "twice.json": '{"a":1,"a":2}', "other.txt": "{"})
    counted = Observation("raw")
    read = RAW.scan_raw_documents(spark, path, counted)
    assert len(read.collect()) == 4 and counted.get == {"files": 6, "rejected": 2}
    assert {(r["filename"], r["size"], r["reason"]) for r in RAW.rejected_documents(spark, path).collect()} == {("bad.json", 1, "not JSON"), ("empty.json", 1, "empty")}
    assert RAW.canonical_documents(read.filter("filename = 'twice.json'")).first()["raw_json"] == '{"a":1,"a":2}'


def test_headers_tell_absent_from_null(spark):
    path = session.new_folder(spark, "activities")
    lines = ['{"activityId":1}', '{"activityId":2,"activityName":null,"activityType":{"typeKey":null},"startTimeLocal":null}',
             '{"activityId":3,"activityName":"x","activityTypeDTO":{"typeKey":"run"},"summaryDTO":{"startTimeLocal":"t"}}', '{"activityId":4,"activityType":null}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    rows = {tuple(r) for r in activities.activity_headers(activities.scan_activity_variants(spark, path, multiline=False)).collect()}
    assert rows == {(1, "Unnamed", "unknown", "unknown"), (2, None, None, None), (3, "x", "run", "t"), (4, "Unnamed", "unknown", "unknown")}


def test_history_rewrites_only_touched_folders(spark):
    path = session.new_folder(spark, "visits")
    rows = spark.createDataFrame([(i % 7, f"p{i % 3}", f"2024-01-{i % 5 + 1:02d}") for i in range(60)] + [(None, "p", None)], "user_id bigint, name string, visit_date string")
    for _ in range(2):
        H.save_visits(spark, path, rows, keys=["user_id"], as_of="2024-02-01", buckets=8)
    whole = {tuple(r) for r in rows.fillna("2024-02-01", ["visit_date"]).collect()}
    saved = [tuple(r) for r in H.saved_visits(spark, path).select("user_id", "name", "visit_date").collect()]
    assert len(saved) == len(whole) and set(saved) == whole
    files = lambda: {r[0] for r in spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().collect()}
    before = files()
    H.save_visits(spark, path, spark.createDataFrame([(1, "new", "2024-03-01")], rows.schema), keys=["user_id"], buckets=8)
    after = files()
    assert H.saved_visits(spark, path).count() == len(whole) + 1
    assert len(before & after) == len(before) - 1
    H.save_visits(spark, path, rows.limit(0), keys=["user_id"], buckets=8)
    assert files() == after


def test_shared_views_expire_and_are_released(spark, folder):
    now, reads = [0.0], []

    def source():
        reads.append(1)
        return X.raw_documents(spark, folder)

    with views.SharedViews(spark, source, keys=["user_id"], seconds=100, clock=lambda: now[0]) as shared:
        first = shared.views()["v_dashboard_daily"]
        now[0] = 99.0
        assert shared.views()["v_dashboard_daily"] is first and shared.derived == 1
        assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
        now[0] = 100.0
        assert shared.views()["v_dashboard_daily"] is not first and shared.derived == 2 and len(reads) == 2
        assert spark.catalog.tableExists("v_dashboard_trends")
    assert not spark.catalog.tableExists("v_dashboard_trends")


def test_repeated_raw_documents_multiply_in_one_exchange(spark, folder):
    raw = X.raw_documents(spark, folder)
    path = session.new_folder(spark, "landed")
    RAW.write_raw(raw.unionByName(raw.filter("filename like 'stress_%'")), path)
    landed = spark.read.parquet(path)
    wide = merge.daily_metrics(landed, keys=["user_id"], form="lists")
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    single = merge.daily_metrics(raw, keys=["user_id"])
    with_stress = single.filter("stress_category is not null").count()
    assert wide.count() == single.count() + with_stress


def test_lookup_spreads_rows_without_key(spark):
    left = spark.createDataFrame([(i, "" if i % 3 else "a") for i in range(9)] + [(9, None), (10, "b")], "id int, address string")
    right = spark.createDataFrame([("a", 4, 1), ("a", 5, 0), ("", 7, 0)], "address string, n int, ord int")
    rows = {r["id"]: r["n"] for r in PL.lookup_first_default(left, right, key="address", value="n", order="ord").collect()}
    assert rows == {i: 5 if i in (0, 3, 6) else 0 for i in range(11)}


def test_classifier_chances_reach_the_recommendation(spark, folder):
    users, spots = X.people(spark, folder), X.places(spark, folder)
    model = M.fit_place_classifier(Q._observations(spark, folder), REC.FEATURE_ORDER, trees=5, depth=4)
    known = session.checkpointed(M.with_chances(users, model, keys=["user_id"]))
    # Straight from the model, user by user.
    contexts = REC.mood_features(REC.with_weather_defaults(users), keys=["user_id"])
    plain = {}
    for r in M.class_probabilities(model, contexts, keys=["user_id"]).collect():
        plain.setdefault(r["user_id"], {})[r["name"]] = r["probability"]
    assert {r["user_id"]: r["chances"] for r in known.collect()} == plain
    scored = REC.scored_candidates(known, spots, None, X.history(spark, folder, spots), as_of=X.AS_OF, keys=["user_id"], max_distance_km=None, top_n=3, jitter=False)
    rows = scored.select("user_id", "name", "confidence").collect()
    assert rows and all(abs(r["confidence"] - 100 * plain[r["user_id"]].get(r["name"], 0.0)) < 1e-9 for r in rows) and any(r["confidence"] > 0 for r in rows)
