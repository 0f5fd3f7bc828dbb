"""Relations derived from the sample tables: daily documents from ``events``, a long series from
``orders``, places from ``supplier``, a catalog from ``part``.

Every derivation is a formula over whole tables, so its size grows with them, and the same formulas
can be written in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from daystrata.operators import temporal
from daystrata.operators.merge import daily_metrics
from daystrata.sources.places import place_table

AS_OF = date(2024, 1, 31)
KEYS = ("user_id",)
# Steps documents cover this many event ids at most, so a busy user's day becomes several documents.
IDS_PER_DOCUMENT = 4096
USERS_PER_CITY, PLACES_PER_CITY = 60, 40
MOODS = ("cozy_indoor", "green_nature", "buzz_urban", "rainy_retreat", "cozy_recharge", "balanced")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("date"), "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.floor("value").alias("v"), F.floor(F.col("value") * 100).alias("c"),
    )


def raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, filename, raw_json): per user and day one document for each metric that has events, made of all of them."""
    events = event_values(spark, folder)
    view = F.col("event_type") == "view"
    k, v, c = F.col("k"), F.col("v"), F.col("c")
    interval = F.struct(
        F.when(k % 10 == 1, F.lit(None).cast("bigint")).when(k % 10 == 0, F.lit(0)).otherwise(c).alias("steps"),
        F.element_at(F.array(F.lit("sedentary"), F.lit("active"), F.lit("highlyActive")), (k % 3 + 1).cast("int")).alias(
            "primaryActivityLevel"),
    )
    part = F.when(view, F.floor(F.col("event_id") / IDS_PER_DOCUMENT)).otherwise(F.lit(0))
    grouped = events.groupBy("user_id", "date", "event_type", part.alias("part")).agg(
        F.collect_list(F.when(view, interval)).alias("intervals"),
        F.struct((F.sum("k") % 100).alias("k"), F.sum("v").alias("v"), F.sum("c").alias("c")).alias("f"),
    )
    k, v, c = F.col("f.k"), F.col("f.v"), F.col("f.c")
    keep_null = {"ignoreNullFields": "false"}

    def json(*columns):
        return F.to_json(F.struct(*columns), keep_null)

    battery = F.to_json(F.array(F.struct((v % 101).alias("charged"), k.alias("drained"))), keep_null)
    heart = json(
        (v % 40 + 40).alias("restingHeartRate"), (k % 60 + 120).alias("maxHeartRate"), (k % 20 + 35).alias("minHeartRate"),
        (k % 40 + 40).alias("lastSevenDaysAvgRestingHeartRate"),
    )
    stress = json(
        F.when(k % 20 != 0, v % 101).alias("avgStressLevel"),
        F.least(F.lit(100).cast("bigint"), v % 101 + k % 30).alias("maxStressLevel"),
    )
    seconds = F.lit(14400) + c % 21600
    deep, rem = F.floor(seconds * k / 400), F.floor(seconds * (99 - k) / 400)
    night = F.struct(
        seconds.alias("sleepTimeSeconds"), deep.alias("deepSleepSeconds"), (seconds - deep - rem).alias("lightSleepSeconds"),
        rem.alias("remSleepSeconds"), (k * 30).alias("awakeSleepSeconds"),
    )
    sleep = json(
        night.alias("dailySleepDTO"), (k - 30).alias("bodyBatteryChange"), (v % 40 + 40).alias("restingHeartRate"),
        (k * 0.5 + 20).alias("avgOvernightHrv"),
    )
    kind = F.col("event_type")
    metric = (
        F.when(kind == "view", F.lit("steps")).when(kind == "click", F.lit("body_battery"))
        .when(kind == "purchase", F.lit("heart_rate")).when(kind == "error", F.lit("stress"))
        .when(kind == "signup", F.lit("sleep"))
    )
    document = (
        F.when(kind == "view", F.to_json("intervals", keep_null)).when(kind == "click", battery)
        .when(kind == "purchase", heart).when(kind == "error", stress).otherwise(sleep)
    )
    return grouped.filter(metric.isNotNull()).select(
        "user_id", F.concat(metric, F.lit("_"), F.col("date").cast("string"), F.lit(".json")).alias("filename"),
        document.alias("raw_json"),
    )


def daily(spark: SparkSession, folder: str) -> DataFrame:
    return daily_metrics(raw_documents(spark, folder), keys=KEYS)


def order_days(spark: SparkSession, folder: str) -> DataFrame:
    """One long unkeyed series with all columns of the daily relation: a day of orders is a day."""
    price = F.floor("o_totalprice")
    days = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.min("o_orderkey").alias("k"), F.count(F.lit(1)).alias("n"), F.min(price).alias("low"), F.max(price).alias("high")
    )
    k, n, low, high = (F.col(c) for c in ("k", "n", "low", "high"))
    stress = F.when(k % 11 != 0, low % 101)
    steps = F.when(k % 4 != 0, high % 15000)
    hours = (F.lit(14400) + high % 21600) / F.lit(3600.0)
    wide = days.select(
        "date", steps.alias("steps"), F.when(k % 4 != 0, F.lit("OK")).alias("steps_quality"),
        (low % 97).alias("charged"), (high % 89).alias("drained"), (low % 97 - high % 89).alias("net_battery"),
        F.when(n % 7 != 0, high % 40 + 40).alias("resting_hr"), (high % 60 + 120).alias("max_hr"), (low % 20 + 35).alias("min_hr"),
        (k % 40 + 40).alias("avg_resting_hr_7d"), stress.alias("avg_stress"), (low % 101 + k % 30).alias("max_stress"),
        F.when(k % 11 != 0, F.lit("LOW")).alias("stress_category"), F.when(k % 5 != 0, hours).alias("sleep_hours"),
        F.when(k % 5 != 0, hours / 4).alias("deep_sleep_hours"), F.when(k % 5 != 0, hours / 5).alias("rem_sleep_hours"),
        (k % 61 - 30).alias("sleep_body_battery_change"), (k % 90 * 0.5 + 20).alias("avg_overnight_hrv"),
    )
    return wide.withColumn("has_steps_data", F.col("steps").isNotNull())


def order_series(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: a single series as long as the table, with many rows per day."""
    price = F.floor("o_totalprice")
    return table(spark, folder, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.col("o_orderkey").alias("id"), (price % 101).alias("avg_stress"),
        (price % 40 + 40).alias("resting_hr"), (price % 12).cast("double").alias("sleep_hours"),
        (price % 77 - 38).alias("net_battery"),
    )


def _city_point(city, number, lat_step: int, lon_step: int):
    """City centres are spread over the globe by formula; points lie within about 20 km of a centre."""
    lat = F.lit(-55.0) + (city * 7919 % 110001) / 1000 + (number * lat_step % 400) / 1000 - 0.2
    lon = F.lit(-179.0) + (city * 104729 % 358007) / 1000 + (number * lon_step % 600) / 1000 - 0.3
    return lat, lon


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Place table from suppliers; the two counts come through the address lookups."""
    key = F.col("s_suppkey")
    lat, lon = _city_point(F.floor(key / PLACES_PER_CITY), key, 37, 53)
    number = F.concat(F.lit(" "), (key % 90 + 1).cast("string"), F.when(key % 3 == 0, F.lit("A")).otherwise(F.lit("")))
    address = F.when(key % 17 == 16, F.lit("")).otherwise(F.concat("s_name", number, F.lit(", Town")))
    base = table(spark, folder, "supplier").select(
        key.alias("place_id"), address.alias("address"), lat.alias("lat"), lon.alias("lon"),
        F.when(key % 7 != 0, F.lit(3.0) + key % 20 / 10).alias("rating"),
        F.when(key % 6 != 0, key * 13 % 500).alias("user_ratings_total"),
    )
    parks, bars = count_lookups(base)
    return place_table(base, parks, bars, position=F.col("place_id") + 1, prefix="Cafe_", label="Cafe - ", default_address="Town")


def count_lookups(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(address, count, ord) lookups with gaps and repeated addresses."""
    def lookup(name: str, gap: int, first: int, span: int) -> DataFrame:
        twice = base.filter((F.col("place_id") % gap != 0) & (F.col("address") != ""))
        row = F.explode(F.array(F.lit(0), F.lit(1)))
        return twice.withColumn("ord", row).select(
            "address", ((F.col("place_id") * first + F.col("ord")) % span).alias(name), "ord"
        )
    return lookup("parks_count_1km", 5, 3, 21), lookup("open_bars_count_500m", 8, 7, 26)


def class_scores(place_rows: DataFrame) -> DataFrame:
    """(mood, name, probability) for the places a classifier would know."""
    rows = place_rows.filter(F.col("place_id") % 4 != 0).select("place_id", "name", F.posexplode(F.array(*map(F.lit, MOODS))).alias("m", "mood"))
    return rows.select("mood", "name", ((F.col("place_id") * 31 + F.col("m") * 17) % 100 / 100.0).alias("probability"))


def people(spark: SparkSession, folder: str, daily_rows: DataFrame | None = None) -> DataFrame:
    """Seven-row means of every user with home and weather.  Every tenth home is far from any city."""
    rows = daily_rows if daily_rows is not None else daily(spark, folder)
    recent = temporal.recent_means(rows, keys=KEYS)
    user = F.col("user_id")
    lat, lon = _city_point(F.floor(user / USERS_PER_CITY), user, 41, 59)
    return recent.select(
        "user_id", "stress", "sleep_hours", "net_battery", "resting_hr", (lat + F.when(user % 10 == 7, 3.0).otherwise(0.0)).alias("home_lat"),
        lon.alias("home_lon"), F.when(user % 9 != 0, (user * 7 % 35 - 5).cast("double")).alias("temperature"),
        F.when(user % 9 != 0, (user * 3 % 11).cast("double")).alias("precipitation"),
    )


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as visits to a place in the user's city: (user_id, place_id, visit_date)."""
    place = F.floor(F.col("user_id") / USERS_PER_CITY) * PLACES_PER_CITY + F.col("event_id") % PLACES_PER_CITY
    return event_values(spark, folder).filter(F.col("event_type") == "purchase").select(
        "user_id", "event_id", place.alias("place_id"), F.col("date").cast("string").alias("visit_date")
    )


def history_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(user_id, raw_json): maps from place to dates beside a comment entry.

    A document covers at most ``IDS_PER_DOCUMENT`` event ids, so a busy user has several.
    """
    part = F.floor(F.col("event_id") / IDS_PER_DOCUMENT).alias("part")
    lists = visits(spark, folder).groupBy("user_id", part, "place_id").agg(F.collect_set("visit_date").alias("dates"))
    entry = F.struct(F.concat(F.lit("place "), F.col("place_id").cast("string")), F.col("dates"))
    maps = lists.groupBy("user_id", "part").agg(F.map_from_entries(F.collect_list(entry)).alias("m"))
    body = F.to_json("m")
    text = F.concat(F.lit('{"_comment":"visits by place","_rules":{"0-3":"30%"},'), body.substr(F.lit(2), F.length(body)))
    return maps.select("user_id", text.alias("raw_json"))


def history(spark: SparkSession, folder: str, place_rows: DataFrame) -> DataFrame:
    """(user_id, name, visit_date) of the visits whose place exists."""
    return visits(spark, folder).join(place_rows.select("place_id", "name"), "place_id").select("user_id", "name", "visit_date")


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """(mood, title, artist, reason) from all parts; five of the six moods, so one mood falls back."""
    names = F.array(*[F.lit(m) for m in MOODS if m != "cozy_recharge"])
    index = F.col("p_size") % 5
    title = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    return table(spark, folder, "part").select(
        F.element_at(names, (index + 1).cast("int")).alias("mood"), title.alias("title"), F.col("p_brand").alias("artist"),
        F.concat(F.lit("Made of "), F.col("p_type")).alias("reason"),
    )


def activity_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON activity document per order, in the list shape or the detail shape; some name or type keys are absent,
    some hold a null."""
    key = F.col("o_orderkey")
    kinds = F.array(*[F.lit(x) for x in ("running", "walking", "cycling", "pilates")])
    kind = F.struct(F.element_at(kinds, (key % 4 + 1).cast("int")).alias("typeKey"))
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.S")
    listed, typed = key % 2 == 0, key % 7 != 0
    summary = F.struct(F.when(~listed, start).alias("startTimeLocal"), (F.col("o_totalprice") / 10).alias("duration"))
    body = F.to_json(F.struct(
        key.alias("activityId"), F.when(key % 5 != 0, F.concat(F.lit("Session "), key.cast("string"))).alias("activityName"),
        F.when(listed & typed, kind).alias("activityType"), F.when(~listed & typed, kind).alias("activityTypeDTO"),
        summary.alias("summaryDTO"), F.when(listed, start).alias("startTimeLocal"),
    ))
    nulls = F.concat(
        F.when(key % 15 == 0, F.lit('"activityName":null,')).otherwise(F.lit("")),
        F.when(key % 21 == 0, F.lit('"activityType":{"typeKey":null},')).otherwise(F.lit("")),
    )
    return table(spark, folder, "orders").select(F.concat(F.lit("{"), nulls, F.substr(body, F.lit(2))).alias("value"))
