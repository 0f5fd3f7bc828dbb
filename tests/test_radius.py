"""Distances and distance joins against brute force, including date line, poles and co-located places."""

import math
import random

import pytest
from pyspark.sql import functions as F

from daystrata.functions import geo
from daystrata.operators import radius as R


def vincenty(lat1, lon1, lat2, lon2):
    a, f = 6378.137, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    span = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        sin_s = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if sin_s == 0:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2a = 1 - sin_a**2
        cos_m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2a if cos2a else 0.0
        c = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
        new = span + (1 - c) * f * sin_a * (s + c * sin_s * (cos_m + c * cos_s * (-1 + 2 * cos_m**2)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    u = cos2a * (a * a - b * b) / (b * b)
    k1 = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    k2 = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    d = k2 * sin_s * (cos_m + k2 / 4 * (cos_s * (-1 + 2 * cos_m**2) - k2 / 6 * cos_m * (-3 + 4 * sin_s**2) * (-3 + 4 * cos_m**2)))
    return b * k1 * (s - d)


POINTS = "home_lat double, home_lon double, lat double, lon double"


def distances(spark, rows):
    df = spark.createDataFrame(rows, POINTS)
    both = df.select(
        geo.distance_km(*[F.col(c) for c in df.columns]).alias("d"),
        *[c.alias(n) for n, c in {**geo.unit_vector("home_lat", "home_lon", "_u"), **geo.unit_vector("lat", "lon", "_v")}.items()],
    ).withColumn("e", geo.vector_distance_km("_u", "_v"))
    return [(r.d, r.e) for r in both.collect()]


def test_distance_close_to_the_geodesic(spark):
    random.seed(3)
    near = [(52 + random.random(), 13 + random.random() / 2, 52 + random.random(), 13 + random.random() / 2) for _ in range(60)]
    far = [(random.uniform(-80, 80), random.uniform(-90, 0), random.uniform(-80, 80), random.uniform(-90, 0)) for _ in range(60)]
    for rows, tolerance in ((near, 0.0003), (far, 0.05)):
        for row, (d, e) in zip(rows, distances(spark, rows)):
            assert d == pytest.approx(vincenty(*row), abs=tolerance)
            assert e == pytest.approx(d, abs=1e-5)


def test_identical_points_null_and_antipode(spark):
    got = distances(spark, [(52.5, 13.4, 52.5, 13.4), (0.0, 0.0, 0.0, 180.0), (None, 1.0, 2.0, 3.0)])
    assert got[0] == (0.0, 0.0) and got[2] == (None, None)
    assert got[1][0] == pytest.approx(20037.5, abs=60)


def _clouds(seed, n):
    random.seed(seed)
    centres = [(52.5, 13.4), (0.0, 179.95), (0.02, -179.96), (89.9, 20.0), (-89.95, -120.0), (60.0, -0.02), (-45.0, 100.0)]
    points = []
    for i in range(n):
        lat, lon = centres[i % len(centres)] if i % 3 else centres[0]
        lat, lon = lat + random.uniform(-0.3, 0.3), lon + random.uniform(-0.6, 0.6)
        points.append((max(-89.99, min(89.99, lat)), (lon + 180) % 360 - 180))
    return points


def _frames(spark, users, places):
    u = spark.createDataFrame([(i, *p) for i, p in enumerate(users)], "user_id bigint, home_lat double, home_lon double")
    p = spark.createDataFrame([(i, f"p{i}", *q) for i, q in enumerate(places)], "place_id bigint, name string, lat double, lon double")
    return u, p


def _all_pairs(spark, u, p):
    pairs = u.crossJoin(p).withColumn("d", geo.distance_km(F.col("home_lat"), F.col("home_lon"), F.col("lat"), F.col("lon")))
    return [(r.user_id, r.place_id, r.d) for r in pairs.collect()]


@pytest.mark.parametrize("radius,sizes,hot", [
    (0.5, R.CELL_SIZES_KM, 4), (9.7, (10, 25), 1), (25.0, (25,), 3), (40.0, R.CELL_SIZES_KM, 4), (700.0, R.CELL_SIZES_KM, 2),
    (9000.0, (5,), 4), (19500.0, R.CELL_SIZES_KM, 4), (1e6, (10,), 1),
])
def test_radius_join_equals_brute_force(spark, radius, sizes, hot):
    u, p = _frames(spark, _clouds(1, 80), _clouds(2, 90))
    want = {(a, b) for a, b, d in _all_pairs(spark, u, p) if d <= radius}
    got = [(r.user_id, r.place_id) for r in R.radius_join(u, p, F.lit(radius), keys=["user_id"], sizes_km=sizes, hot_users=hot).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    lonely = {r.user_id for r in R.without_place(u, p, F.lit(radius), keys=["user_id"], sizes_km=sizes, hot_users=hot).collect()}
    assert lonely == set(range(80)) - {a for a, _ in want}


def test_places_are_copied_for_hot_cells_only(spark):
    u, p = _frames(spark, [(52.5, 13.4)] * 50 + [(10.0, 10.0)], [(52.5, 13.4), (10.0, 10.0)])
    for hot, parts in ((50, 1), (20, 3)):
        left, right, _ = R._gridded(u, p, F.lit(9.0), ["user_id"], (10,), hot)
        copies = {r["place_id"]: r["n"] for r in right.groupBy("place_id").agg(F.count("*").alias("n")).collect()}
        # Nine cells around a place; the one hot cell takes a copy for each of its parts.
        assert copies == {0: 8 + parts, 1: 9}
        if parts > 1:
            assert {r["_salt"] for r in left.collect()} == set(range(parts))
        else:
            assert "_salt" not in left.columns and left.columns.count("_h_cell") == 0


def test_radius_is_inclusive(spark):
    u, p = _frames(spark, [(10.0, 10.0)], [(10.05, 10.0)])
    exact = R.radius_join(u, p, F.lit(30.0), keys=["user_id"]).first().distance_km
    assert R.radius_join(u, p, F.lit(exact), keys=["user_id"]).count() == 1
    assert R.radius_join(u, p, F.lit(exact - 1e-9), keys=["user_id"]).count() == 0
    for nothing in (F.lit(None).cast("double"), F.lit(float("nan")), F.lit(-1.0)):
        assert R.radius_join(u, p, nothing, keys=["user_id"]).count() == 0
        assert R.radius_or_nearest(u, p, nothing, 2, keys=["user_id"]).count() == 1
    assert R.radius_join(u.limit(0), p, F.lit(9.0)).count() == 0


@pytest.mark.parametrize("radius", [0.001, 30.0, 3000.0])
def test_one_home_without_keys(spark, radius):
    u, p = _frames(spark, [(52.4, 13.3)], _clouds(2, 90))
    pairs = sorted((d, b) for _, b, d in _all_pairs(spark, u, p))
    want = {b for d, b in pairs if d <= radius} or {b for _, b in pairs[:3]}
    assert {r.place_id for r in R.radius_or_nearest(u.drop("user_id"), p, F.lit(radius), 3).collect()} == want


@pytest.mark.parametrize("n,depth,stride", [(1, 12, 3), (3, 12, 3), (5, 6, 2)])
def test_nearest_places_equal_brute_force(spark, n, depth, stride):
    places = _clouds(5, 60) + [(10.0, 10.0)] * 30  # a third of the places share one spot
    u, p = _frames(spark, _clouds(4, 30) + [(10.0, 10.0), (-5.0, -150.0), (75.0, 60.0)], places)
    best = {}
    for a, b, d in _all_pairs(spark, u, p):
        best.setdefault(a, []).append((round(d, 6), b))
    want = {a: [b for _, b in sorted(items)[:n]] for a, items in best.items()}
    got = {}
    for r in sorted(R.nearest_places(u, p, n, keys=["user_id"], depth=depth, stride=stride).collect(), key=lambda r: (r.user_id, round(r.distance_km, 6), r.place_id)):
        got.setdefault(r.user_id, []).append(r.place_id)
    assert got == want


def test_fewer_places_than_asked_for(spark):
    u, p = _frames(spark, [(10.0, 10.0), (None, 1.0)], [(50.0, 50.0), (-10.0, 100.0)])
    assert [(r.user_id, r.place_id) for r in R.radius_or_nearest(u, p, F.lit(5.0), 3, keys=["user_id"]).orderBy("distance_km").collect()] == [(0, 0), (0, 1)]


def _tasks(df):
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def test_users_descend_in_tasks_by_their_number(spark, monkeypatch, tmp_path):
    """Rows of users are so short that adaptive execution would put them all into one task."""
    monkeypatch.setattr(R, "DESCENT_USERS", 10, raising=False)
    u, p = _frames(spark, _clouds(4, 80), _clouds(5, 60))
    for name, df in (("u", u), ("p", p)):
        df.write.parquet(f"{tmp_path}/{name}")  # files have a known size, so places are broadcast
    u, p = spark.read.parquet(f"{tmp_path}/u").repartition("user_id"), spark.read.parquet(f"{tmp_path}/p")
    whole = R.nearest_places(u, p, 3, keys=["user_id"])
    assert _tasks(whole) >= 6 and whole.count() == 240


def test_users_without_place_descend_in_tasks_by_the_number_of_users(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(R, "DESCENT_USERS", 10, raising=False)
    u, p = _frames(spark, _clouds(4, 80), _clouds(5, 60))
    for name, df in (("u", u), ("p", p)):
        df.write.parquet(f"{tmp_path}/{name}")
    u, p = spark.read.parquet(f"{tmp_path}/u"), spark.read.parquet(f"{tmp_path}/p")
    far = R.radius_or_nearest(u, p, F.lit(None).cast("double"), 3, keys=["user_id"])  # a null radius reaches nothing
    assert _tasks(far) >= 6 and far.count() == 240
    assert R._counted_grid(u, p, F.lit(None).cast("double"), ["user_id"], (5,), 9)[3] == 80


def test_users_descend_without_a_shuffle_by_cell(spark, monkeypatch, tmp_path):
    """Where joins aren't broadcast, all users met in the few cells of the upper levels, each with all cells inside."""
    monkeypatch.setattr(R, "DESCENT_USERS", 10)
    u, p = _frames(spark, _clouds(4, 80), _clouds(5, 60))
    best = {}
    for a, b, d in sorted(_all_pairs(spark, u, p), key=lambda x: (x[0], round(x[2], 6), x[1])):
        best.setdefault(a, []).append(b)
    for name, df in (("u", u), ("p", p)):
        df.write.parquet(f"{tmp_path}/{name}")
    u, p = spark.read.parquet(f"{tmp_path}/u"), spark.read.parquet(f"{tmp_path}/p")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        whole = R.nearest_places(u, p, 3, keys=["user_id"])
        plan = whole._jdf.queryExecution().executedPlan().toString()
        # Three levels have few cells (before, all five joins met by cell); the fourth and the places themselves are joined by a shuffle, then users are dealt again.
        assert plan.count("SortMergeJoin [") == 2
        assert _tasks(whole) >= 6
        got = {a: set() for a in best}
        for r in whole.collect():
            got[r.user_id].add(r.place_id)
        assert got == {a: set(b[:3]) for a, b in best.items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
