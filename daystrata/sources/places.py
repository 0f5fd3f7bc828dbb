"""Candidate places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from daystrata.functions.text import street_name


def named_places(places: DataFrame, *, position: Column, prefix: str, label: str, default_address: str) -> DataFrame:
    """Add ``name`` and ``display_name`` from the address; ``position`` numbers places without street."""
    street = street_name(F.col("address"), position)
    shown = F.when(F.coalesce(F.col("address"), F.lit("")) == "", F.lit(default_address)).otherwise(F.col("address"))
    return places.withColumns(
        {"name": F.concat(F.lit(prefix), street), "display_name": F.concat(F.lit(label), street), "shown_address": shown}
    )


def first_match(lookup: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value that comes first in ``order``."""
    return lookup.groupBy(key).agg(F.min_by(value, order).alias(value))


def lookup_first_default(left: DataFrame, lookup: DataFrame, *, key: str, value: str, order: str, default: int = 0) -> DataFrame:
    """Left lookup on an equal key, first match only, default when there is none.

    The right side is reduced to one row per key before the join, so rows of the left side are
    never multiplied, and a hot key on the left can be split by the adaptive skew join.  An empty or null key
    matches nothing; such rows are spread by a hash of the row instead of meeting in one task.
    """
    right = first_match(lookup.filter(F.col(key) != ""), key, value, order).select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    # A key never begins with this mark, so spread rows find no partner.
    spread = F.concat(F.lit("\0"), F.xxhash64(*[F.col(c) for c in left.columns]).cast("string"))
    keyed = left.drop(value).withColumn("_own", F.when(F.col(key) != "", F.col(key)).otherwise(spread))
    joined = keyed.join(right, F.col("_own") == F.col("_key"), "left")
    return joined.withColumn(value, F.coalesce(F.col("_value"), F.lit(default)).cast("bigint")).drop("_own", "_key", "_value")


def place_table(places: DataFrame, parks: DataFrame, bars: DataFrame, *, position: Column, prefix: str, label: str,
                default_address: str, default_rating: float = 4.5) -> DataFrame:
    """Flat place relation with both counts.

    ``parks`` and ``bars`` have columns address, count and ``ord`` (file order of the lookup).  Rating and number
    of ratings have a default only where the column is absent; a null stays null.
    """
    named = named_places(places, position=position, prefix=prefix, label=label, default_address=default_address)
    counted = lookup_first_default(named, parks, key="address", value="parks_count_1km", order="ord")
    counted = lookup_first_default(counted, bars, key="address", value="open_bars_count_500m", order="ord")
    return counted.select(
        "place_id", "name", "display_name", F.col("shown_address").alias("address"), "lat", "lon",
        F.col("rating") if "rating" in places.columns else F.lit(default_rating).alias("rating"),
        (F.col("user_ratings_total") if "user_ratings_total" in places.columns else F.lit(0)).cast("bigint").alias("user_ratings_total"),
        "parks_count_1km", "open_bars_count_500m",
    )
