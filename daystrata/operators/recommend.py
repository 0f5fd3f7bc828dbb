"""Mood rules, scores and the top-n place recommendation per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from daystrata.functions import dates as D
from daystrata.functions.categories import half_up
from daystrata.functions.text import COLD, RAIN, prompt_text, reason_text, weather_text
from daystrata.operators.radius import nsmallest, radius_or_nearest
from daystrata.sources.history import last_visits

# Environment wanted per mood (parks, bars, nightlight, ndvi).
MOOD_PROFILES = {
    "cozy_indoor": (8, 2, 25, 0.45),
    "green_nature": (15, 3, 20, 0.70),
    "rainy_retreat": (8, 6, 35, 0.50),
    "buzz_urban": (3, 20, 65, 0.30),
    "cozy_recharge": (10, 4, 28, 0.55),
    "balanced": (8, 10, 40, 0.50),
}
# Thresholds of the rules in km; those of the weather stand with its words.
NEAR_KM, FAR_KM = 10.0, 25.0
# Weather used when none is known.
DEFAULT_TEMPERATURE, DEFAULT_PRECIPITATION = 10.0, 0.0
# Order of the classifier's features.
FEATURE_ORDER = (
    "parks_count_1km", "open_bars_count_500m", "lst_celsius_1km", "temp_max", "temp_min", "precip_mm", "ndvi", "nightlight",
)


def known(value: Column) -> Column:
    """NaN as NULL: both make every comparison false."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def with_weather_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "temperature": F.coalesce("temperature", F.lit(DEFAULT_TEMPERATURE)),
        "precipitation": F.coalesce("precipitation", F.lit(DEFAULT_PRECIPITATION)),
    })


def mood(stress: Column, sleep_hours: Column, net_battery: Column, temperature: Column, precipitation: Column) -> Column:
    """First rule that applies."""
    stress, sleep_hours, net_battery = known(stress), known(sleep_hours), known(net_battery)
    temperature, precipitation = known(temperature), known(precipitation)
    cold = temperature < COLD
    strained = (stress > 60) & (sleep_hours < 7)
    rested = (stress < 40) & (sleep_hours > 8) & (net_battery > 0)
    return (
        F.when(strained & cold, F.lit("cozy_indoor"))
        .when(strained, F.lit("green_nature"))
        .when(precipitation > RAIN, F.lit("rainy_retreat"))
        .when(cold, F.lit("cozy_indoor"))
        .when(rested, F.lit("buzz_urban"))
        .when(net_battery < -20, F.lit("cozy_recharge"))
        .otherwise(F.lit("balanced"))
    )


def mood_profile_table(spark: SparkSession) -> DataFrame:
    rows = [(name, *values) for name, values in MOOD_PROFILES.items()]
    return spark.createDataFrame(rows, "mood string, parks bigint, bars bigint, nightlight bigint, ndvi double")


def profile_join(df: DataFrame) -> DataFrame:
    """Add the wanted environment; the six-row table is fixed, so it is always broadcast."""
    return df.join(F.broadcast(mood_profile_table(df.sparkSession)), "mood", "left")


def mood_features(df: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Mood and the eight classifier features from health values and weather."""
    named = df.withColumn(
        "mood", mood(*[F.col(c) for c in ("stress", "sleep_hours", "net_battery", "temperature", "precipitation")])
    )
    t = F.col("temperature")
    values = {
        "parks_count_1km": F.col("parks"), "open_bars_count_500m": F.col("bars"), "lst_celsius_1km": t,
        "temp_max": t + 2, "temp_min": t - 3, "precip_mm": F.col("precipitation"), "ndvi": F.col("ndvi"),
        "nightlight": F.col("nightlight"),
    }
    return profile_join(named).select(*keys, "mood", *[values[c].cast("double").alias(c) for c in FEATURE_ORDER])


def dynamic_radius(radius: Column, stress: Column, precipitation: Column) -> Column:
    """Given radius, or a short one when stressed or in rain, else a long one."""
    near = (known(stress) > 60) | (known(precipitation) > RAIN)
    return F.coalesce(radius, F.when(near, F.lit(NEAR_KM)).otherwise(F.lit(FAR_KM)))


def score_lookup(df: DataFrame, scores: DataFrame, *, on: Sequence[str]) -> DataFrame:
    """Add ``confidence``: the class probability in percent, 0 for a name the classifier does not know."""
    percent = scores.select(*on, (F.col("probability") * 100).alias("confidence"))
    joined = df.join(percent, list(on), "left")
    return joined.withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))


def with_chances(places: DataFrame, scores: DataFrame) -> DataFrame:
    """Add ``chances``: mood to class probability of the place, at most one entry per mood.

    Attached to the places, the probabilities ride along with the radius join and the many candidate
    rows need no join of their own.
    """
    # Of several scores for one mood and name the highest counts.
    single = scores.groupBy("name", "mood").agg(F.max("probability").alias("probability"))
    per_name = single.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("mood", "probability"))).alias("chances"))
    return places.join(per_name, "name", "left")


def confidence(chances: Column, key: Column) -> Column:
    return F.coalesce(F.try_element_at(chances, key) * 100, F.lit(0.0))


def recent_visits(history: DataFrame, as_of: Column, *, keys: Sequence[str] = ()) -> DataFrame:
    """Latest visit per name, kept only where it still costs something."""
    latest = last_visits(history, keys=keys).withColumn("history_penalty", history_penalty(F.col("last_visit"), as_of))
    return latest.filter(F.col("history_penalty") > 0).select(*keys, "name", "history_penalty")


def history_penalty(last_visit: Column, as_of: Column) -> Column:
    """Percent taken off for a recent visit; unreadable and future dates take nothing off."""
    # A date alone or with a time behind it; other text can't be read.
    readable = F.when(last_visit.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:.*)?$"), F.substring(last_visit, 1, 10))
    age = D.days_ago(D.parse_date(readable), as_of)
    return F.when(age.between(0, 3), F.lit(30.0)).when(age.between(4, 7), F.lit(15.0)).otherwise(F.lit(0.0))


def history_join(df: DataFrame, history: DataFrame, *, as_of: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``history_penalty`` from the latest visit to each name."""
    joined = df.join(last_visits(history, keys=keys), [*keys, "name"], "left")
    return joined.withColumn("history_penalty", history_penalty(F.col("last_visit"), as_of))


def distance_score(distance: Column, farthest: Column) -> Column:
    """100 at the door, 0 for the farthest candidate; NULL when all are at distance 0."""
    return (F.lit(1.0) - F.try_divide(distance, farthest)) * 100


def balanced_score(confidence: Column, nearness: Column) -> Column:
    return confidence * 0.6 + nearness * 0.4


def daily_jitter(as_of: Column, *identity: Column) -> Column:
    """Uniform in [-10, 10), the same all day for the same user and place."""
    return D.uniform_of_hash(D.day_hash(as_of, *identity), -10.0, 10.0)


def final_score(balanced: Column, penalty: Column, jitter: Column) -> Column:
    """The jitter is not penalised."""
    return balanced * (F.lit(1.0) - penalty / 100) + jitter


def scored_candidates(users: DataFrame, places: DataFrame, scores: DataFrame | None, history: DataFrame, *, as_of,
                      keys: Sequence[str], max_distance_km: float | None, top_n: int, jitter: bool) -> DataFrame:
    """All candidate places of every user with their partial and final scores.

    The probability of a place comes from ``scores`` (mood, name, probability), or, without them, from the map
    ``chances`` of the user (place name to probability), as a classifier gives it for the user's context.
    """
    day = F.lit(as_of).cast("date")
    people = with_weather_defaults(users)
    people = people.withColumn("mood", mood(*[
        F.col(c) for c in ("stress", "sleep_hours", "net_battery", "temperature", "precipitation")
    ]))
    given = F.lit(max_distance_km).cast("double")
    radius = dynamic_radius(given, F.col("stress"), F.col("precipitation"))
    located, carried, chance = places.select("place_id", "name", "lat", "lon"), ["mood"], confidence(F.col("chances"), F.col("mood"))
    if scores is None:
        carried, chance = ["chances"], confidence(F.col("chances"), F.col("name"))
    else:
        located = with_chances(located, scores)
    candidates = radius_or_nearest(
        people.select(*keys, "home_lat", "home_lon", "stress", "precipitation", *carried), located, radius, top_n,
        keys=keys, sizes_km=(max_distance_km,) if max_distance_km else (NEAR_KM, FAR_KM),
    ).select(*keys, "place_id", "name", "distance_km", chance.alias("confidence"))
    visited = candidates.join(recent_visits(history, day, keys=keys), [*keys, "name"], "left")
    candidates = visited.withColumn("history_penalty", F.coalesce("history_penalty", F.lit(0.0)))
    # One user's candidates are bounded by the places around one home.
    farthest = F.max("distance_km").over(Window.partitionBy(*keys))
    noise = daily_jitter(day, *[F.col(k) for k in keys], F.col("name")) if jitter else F.lit(0.0)
    scored = candidates.withColumn("distance_score", distance_score(F.col("distance_km"), farthest))
    scored = scored.withColumn("balanced_score", balanced_score(F.col("confidence"), F.col("distance_score")))
    return scored.withColumn("final_score", final_score(F.col("balanced_score"), F.col("history_penalty"), noise))


def topn_by_score(scored: DataFrame, n: int = 3, *, keys: Sequence[str] = ()) -> DataFrame:
    """Best n per key, ties by name; adds ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("final_score"), "name", "place_id")
    return scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= n)


def recommend_topn(users: DataFrame, places: DataFrame, scores: DataFrame | None, history: DataFrame, *, as_of,
                   keys: Sequence[str] = ("user_id",), max_distance_km: float | None = None, top_n: int = 3,
                   jitter: bool = True) -> DataFrame:
    """Top-n places for every user with an explanation.

    ``users``: keys, stress, sleep_hours, net_battery, temperature, precipitation, home_lat, home_lon.
    ``places``: see ``place_table``.  ``scores``: mood, name, probability; None where the users have ``chances``
    (see :func:`scored_candidates`).  ``history``: keys, name, visit_date.  Candidates carry only what the ranking needs; names, addresses and health values are
    joined to the few winners.  Without any place each user gets one explaining row.  With ``keys=()``
    ``users`` is the one row of a single person and ``history`` theirs.
    """
    best = topn_by_score(
        scored_candidates(users, places, scores, history, as_of=as_of, keys=keys, max_distance_km=max_distance_km,
                          top_n=top_n, jitter=jitter),
        top_n, keys=keys,
    ).select(*keys, "place_id", "rank", "distance_km", "confidence", "final_score")
    details = places.select(
        "place_id", "display_name", "address", "rating", F.col("parks_count_1km").alias("_parks"),
        F.col("open_bars_count_500m").alias("_bars"),
    )
    people = with_weather_defaults(users).withColumn("mood", mood(*[
        F.col(c) for c in ("stress", "sleep_hours", "net_battery", "temperature", "precipitation")
    ]))
    # Without keys there is one row of ``users``; it meets its own n winners.
    full = profile_join(people).join(best.join(details, "place_id"), list(keys) or F.lit(True), "left")
    empty = F.col("place_id").isNull()
    reason = reason_text(
        F.col("stress"), F.col("sleep_hours"), F.col("net_battery"), F.col("mood"), F.col("temperature"),
        F.col("precipitation"), F.col("_parks"), F.col("_bars"), F.col("ndvi"), F.col("nightlight"),
    )
    def unless_empty(default, value):
        return F.when(empty, F.lit(default)).otherwise(value)

    return full.select(
        *keys, unless_empty(1, F.col("rank")).cast("bigint").alias("rank"),
        unless_empty("No cafés available", F.col("display_name")).alias("place_name"),
        unless_empty("N/A", F.col("address")).alias("address"),
        unless_empty(0.0, half_up(F.col("distance_km"), 1)).alias("distance_km"),
        unless_empty(0.0, half_up(F.col("confidence"), 1)).alias("confidence"),
        "mood", unless_empty("Could not load café data", reason).alias("reason"), "rating",
        F.col("temperature").alias("weather_temp"), F.col("precipitation").alias("weather_precip"),
    )


def song_prompts(users: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Prompt text per user; nothing is sent anywhere."""
    return users.select(
        *keys, "mood", weather_text(F.col("temperature"), F.col("precipitation")).alias("weather_text"),
        prompt_text(*[F.col(c) for c in ("mood", "stress", "sleep_hours", "temperature", "precipitation")]).alias("prompt"),
    )


def daily_sample(catalog: DataFrame, *, as_of, n: int = 3, group: str = "mood", item: str = "title") -> DataFrame:
    """n items per group, the same all day; a task keeps n items per group before the shuffle."""
    hashed = catalog.withColumn("_hash", D.day_hash(F.lit(as_of).cast("date"), F.col(group), F.col(item)))
    return nsmallest(hashed, n, [F.col("_hash"), F.col(item)], keys=[group]).drop("_hash")


def catalog_recommend(users: DataFrame, catalog: DataFrame, *, as_of, keys: Sequence[str] = (), n: int = 3,
                      default_mood: str = "balanced") -> DataFrame:
    """n catalog items for each user's mood; a mood without items takes the default mood's items.

    The sample is at most n rows per mood, gathered into one row per mood before the join.
    """
    sample = daily_sample(catalog, as_of=as_of, n=n)
    lists = sample.groupBy("mood").agg(F.sort_array(F.collect_list(F.struct("title", "artist", "reason"))).alias("_items"))
    fallback = lists.filter(F.col("mood") == default_mood).select("_items")
    joined = users.join(lists, "mood", "left")
    items = F.coalesce(F.col("_items"), fallback.scalar())
    return joined.select(*keys, "mood", F.inline(items))
