"""Distance joins between points without comparing all pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from daystrata.functions.geo import unit_vector, vector_distance_km, vector_sphere_km

# A degree of latitude is never shorter than this, nor a degree of arc longer than the second value.
_MIN_DEGREE_KM = 110.5
_MAX_DEGREE_KM = 111.7
# Cell sizes for radii not known in advance; larger ones double from the last up to half a turn of the globe.
CELL_SIZES_KM = (5.0, 10.0, 20.0, 40.0)
_HALF_TURN_KM = 20_100.0
#: Users of a cell beyond which it is split.
HOT_USERS = 50_000
#: Users that descend the quad grid in one task; each meets some hundred cells on the way.
DESCENT_USERS = 1_000
#: So many cells at most, each with a list of the 64 or fewer inside it, go to every task; the globe has no more at their level.
SENT_CELLS = 4_096
# Without keys every home is its own key.
_HOME = ("home_lat", "home_lon")


def radius_filter(df: DataFrame, distance: Column, limit: Column) -> DataFrame:
    """Inclusive: a point exactly at the limit stays."""
    return df.filter(distance <= limit)


def _band_sql(lat: str, size: str) -> str:
    """Latitude band at least as high as the cell size."""
    return f"floor(({lat} + 90) / ({size} / {_MIN_DEGREE_KM!r}D))"


def _around_sql(band: str, size: str) -> str:
    """How many cells go around the globe in a band, wide enough for the band and both neighbours."""
    edge = f"{size} / {_MIN_DEGREE_KM!r}D"
    worst = f"least(90D, greatest(abs(({band} - 1) * ({edge}) - 90), abs(({band} + 2) * ({edge}) - 90)))"
    ratio = f"sin(least(pi() / 2, {size} * 1.01D / 12712D)) / greatest(cos(radians({worst})), 1e-9D)"
    return f"cast(greatest(1, floor(360D / (2 * degrees(asin(least(1D, {ratio})))))) as bigint)"


def _gridded(users: DataFrame, places: DataFrame, radius: Column, keys, sizes_km: Sequence[float], hot_users: int):
    """The two sides and the condition of :func:`_counted_grid`."""
    return _counted_grid(users, places, radius, keys, sizes_km, hot_users)[:3]


def _counted_grid(users: DataFrame, places: DataFrame, radius: Column, keys, sizes_km: Sequence[float], hot_users: int):
    """Both sides with their grid columns, the join condition (cells equal, then exact distance) and the number of users.

    A user takes the smallest cell size that covers the radius; the last size covers the globe, so it holds
    any larger radius too.  A radius that is null or NaN reaches nothing.  A cell is that size, a latitude
    band and a longitude cell of the band.

    The users of every cell are counted first; one row comes back, with the sizes in use, the fullest cell and the sum.  Only
    where a cell holds more than ``hot_users`` do both sides join the hot cells: its users are dealt into so many parts
    as the count asks for, and the places around it are copied to each of them.
    """
    sizes = sorted({float(s) for s in sizes_km})
    while sizes[-1] < _HALF_TURN_KM:
        sizes.append(sizes[-1] * 2)
    reach = F.nanvl(radius.cast("double"), F.lit(None).cast("double"))
    size = F
    for value in sizes[:-1]:
        size = size.when(reach <= value, F.lit(value))
    size = size.when(reach.isNotNull(), F.lit(sizes[-1]))
    left = users.select(
        "*", reach.alias("_radius"), size.alias("_size"), *[c.alias(n) for n, c in unit_vector("home_lat", "home_lon", "_u").items()],
    )
    left = left.selectExpr("*", f"{_band_sql('home_lat', '_size')} as _band")
    left = left.selectExpr("*", f"{_around_sql('_band', '_size')} as _around")
    left = left.selectExpr("*", "pmod(floor((home_lon + 180) / 360 * _around), _around) as _cell")
    every = left.groupBy("_size", "_band", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    placed = F.col("_cell").isNotNull()
    counts = every.filter(placed)
    found = every.agg(
        F.collect_set(F.when(placed, F.col("_size"))).alias("sizes"), F.max(F.when(placed, F.col("_n"))).alias("most"), F.sum("_n").alias("users"),
    ).head()

    # Places are copied for the sizes that users have.
    used = F.array(*[F.lit(float(x)) for x in sorted(found["sizes"])]).cast("array<double>")
    right = places.select("*", *[c.alias(n) for n, c in unit_vector("lat", "lon", "_v").items()], F.explode(used).alias("_p_size"))
    right = right.selectExpr("*", f"explode(transform(array(-1, 0, 1), i -> {_band_sql('lat', '_p_size')} + i)) as _p_band")
    right = right.selectExpr("*", f"{_around_sql('_p_band', '_p_size')} as _p_around")
    near = "array_distinct(transform(array(-1, 0, 1), i -> pmod(floor((lon + 180) / 360 * _p_around) + i, _p_around)))"
    right = right.selectExpr("*", f"explode({near}) as _p_cell")
    names = ["size", "band", "cell"]
    if (found["most"] or 0) > hot_users:
        hot = counts.filter(F.col("_n") > hot_users).select(*[F.col(f"_{n}").alias(f"_h_{n}") for n in names], F.ceil(F.col("_n") / hot_users).cast("int").alias("_parts"))
        on_left, on_right = (F.expr(" and ".join(f"{side}{n} = _h_{n}" for n in names)) for side in ("_", "_p_"))
        dealt = f"cast(pmod(xxhash64({', '.join(keys or _HOME)}), coalesce(_parts, 1)) as int)"
        left = left.join(hot, on_left, "left").withColumn("_salt", F.expr(dealt)).drop("_parts", *[f"_h_{n}" for n in names])
        right = right.join(hot, on_right, "left").withColumn("_p_salt", F.explode(F.expr("sequence(0, coalesce(_parts, 1) - 1)")))
        right = right.drop("_parts", *[f"_h_{n}" for n in names])
        names = [*names, "salt"]
    cells = " and ".join(f"_{name} = _p_{name}" for name in names)
    return left, right, F.expr(cells) & (vector_distance_km("_u", "_v") <= F.col("_radius")), found["users"] or 0


def _pairs(left: DataFrame, right: DataFrame, condition: Column, users: DataFrame, places: DataFrame) -> DataFrame:
    return left.join(right, condition).withColumn("distance_km", vector_distance_km("_u", "_v")).select(*users.columns, *places.columns, "distance_km")


def radius_join(users: DataFrame, places: DataFrame, radius: Column, *, keys: Sequence[str] = (),
                sizes_km: Sequence[float] = CELL_SIZES_KM, hot_users: int = HOT_USERS) -> DataFrame:
    """All user x place pairs within the user's radius (inclusive), with ``distance_km``.

    ``users`` has keys, home_lat, home_lon; ``places`` has lat, lon and no column of the same name as
    one of ``users``.  An equi-join on grid cells finds candidates: a user sits in one cell, a place is
    copied to the nine cells around it for each size that some user needs; when the radii are known, pass
    them as sizes.  Larger radii get doubled sizes, up to the whole globe.  A cell with more than ``hot_users``
    users, as of a city that holds a third of them, is split by its count; places elsewhere are not copied for it.
    Counting the cells reads one aggregated row.  Without keys the rows of ``users`` are homes of one series.
    """
    return _pairs(*_gridded(users, places, radius, keys, sizes_km, hot_users), users, places)


def without_place(users: DataFrame, places: DataFrame, radius: Column, *, keys: Sequence[str] = (),
                  sizes_km: Sequence[float] = CELL_SIZES_KM, hot_users: int = HOT_USERS) -> DataFrame:
    """Users who have no place within their radius: an anti-join that stops at the first match."""
    left, right, condition = _gridded(users, places, radius, keys, sizes_km, hot_users)
    return left.join(right, condition, "left_anti").select(*users.columns)


def nsmallest(df: DataFrame, n: int, order: Sequence[Column], *, keys: Sequence[str] = ()) -> DataFrame:
    """First n rows by order per key; each task keeps only n rows per key before the shuffle."""
    if not keys:
        return df.orderBy(*order).limit(n)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def nearest_places(users: DataFrame, places: DataFrame, n: int, *, keys: Sequence[str] = (), place_id: str = "place_id",
                   depth: int = 12, stride: int = 3, most: int | None = None) -> DataFrame:
    """The n nearest places of every user, however far, ties by ``place_id``; without keys, of every home.

    Descends a latitude/longitude quad grid: per user only cells that can still hold one of the n
    nearest places survive a level (their lower distance bound must not exceed the smallest upper
    bound that already covers n places).  Of places at one spot, n are enough for any user.

    A row of ``users`` is short, but turns into hundreds here, so that tasks cut by bytes would get far too many.  They
    are dealt by their number, ``most`` where the caller knows that there are no more; else they are counted.
    The upper levels have so few cells that all of them go to every task; a shuffle by cell would bring all users
    to a few tasks.  Below, a cell comes with the list of those inside it, so that users are shuffled before
    they multiply, and are dealt by their number again.
    """
    spot = places.filter("lat is not null and lon is not null")
    spot = nsmallest(spot, n, [F.col(place_id)], keys=["lat", "lon"])
    keys = list(keys) or list(_HOME)
    size, top = 1 << depth, (1 << depth) - 1
    leaf = spot.select(
        "*", F.expr(f"least(floor((lat + 90) / 180 * {size}), {top})").alias("_y"),
        F.expr(f"least(floor((lon + 180) / 360 * {size}), {top})").alias("_x"),
        *[c.alias(name) for name, c in unit_vector("lat", "lon", "_v").items()],
    )
    counts = leaf.groupBy("_y", "_x").agg(F.count(F.lit(1)).alias("_n"))
    vectors = {**unit_vector("home_lat", "home_lon", "_u"), **unit_vector("home_lat", "home_lon", "_s", reduced=False)}
    homes = users.filter("home_lat is not null and home_lon is not null")
    tasks = -(-(homes.count() if most is None else most) // DESCENT_USERS) or 1
    frontier = homes.repartition(tasks, *keys).select(
        "*", *[c.alias(name) for name, c in vectors.items()], F.expr("0L").alias("_y"), F.expr("0L").alias("_x")
    )
    carried = [*users.columns, *vectors]
    by_user = ", ".join(keys)
    for z in range(stride, depth + 1, stride):
        cells = counts.groupBy(F.expr(f"shiftright(_y, {depth - z}) as _y"), F.expr(f"shiftright(_x, {depth - z}) as _x")).agg(
            F.sum("_n").alias("_n")
        )
        inside = cells.groupBy(F.expr(f"shiftright(_y, {stride}) as _y"), F.expr(f"shiftright(_x, {stride}) as _x")).agg(
            F.collect_list(F.struct("_y", "_x", "_n")).alias("_inside")
        )
        few = 4 ** (z - stride) <= SENT_CELLS
        joined = frontier.select(*carried, "_y", "_x").join(F.broadcast(inside) if few else inside, ["_y", "_x"]).selectExpr(*carried, "inline(_inside)")
        height, width = 180.0 / (1 << z), 360.0 / (1 << z)
        lat, lon = f"((_y + 0.5D) * {height!r}D - 90)", f"((_x + 0.5D) * {width!r}D - 180)"
        # No point of a cell is farther from its centre than along the meridian, then the parallel.
        reach = f"{_MAX_DEGREE_KM / 2!r}D * ({height!r}D + {width!r}D * cos(radians(greatest(0D, abs({lat}) - {height / 2!r}D))))"
        found = (joined if few else joined.repartition(tasks, *keys)).select(
            *carried, "_y", "_x", "_n", F.expr(reach).alias("_reach"),
            *[c.alias(name) for name, c in unit_vector(lat, lon, "_m", reduced=False).items()],
        )
        # The sphere is within 0.6 % of the ellipsoid, so the bounds hold for the exact distance.
        bounded = found.select(*carried, "_y", "_x", "_n", "_reach", vector_sphere_km("_s", "_m").alias("_middle")).selectExpr(
            *carried, "_y", "_x", "_n", "_middle * 0.994D - _reach - 0.1D as _low", "_middle * 1.006D + _reach + 0.1D as _high"
        )
        covered = bounded.selectExpr(
            "*", f"sum(_n) over (partition by {by_user} order by _high, _y, _x rows unbounded preceding) as _covered"
        )
        enough = f"min(case when _covered >= {n} then _high end) over (partition by {by_user})"
        frontier = covered.selectExpr(*carried, "_y", "_x", "_low", f"coalesce({enough}, double('infinity')) as _bound").filter(
            "_low <= _bound"
        )
    found = frontier.select(*carried, "_y", "_x").join(leaf, ["_y", "_x"])
    found = found.select(*users.columns, *places.columns, vector_distance_km("_u", "_v").alias("distance_km"))
    return nsmallest(found.repartition(tasks, *keys), n, [F.col("distance_km"), F.col(place_id)], keys=keys)


def radius_or_nearest(users: DataFrame, places: DataFrame, radius: Column, n: int, *, keys: Sequence[str] = (),
                      sizes_km: Sequence[float] = CELL_SIZES_KM, place_id: str = "place_id") -> DataFrame:
    """Places within the radius; for users who have none, the n nearest of all."""
    left, right, condition, most = _counted_grid(users, places, radius, keys, sizes_km, HOT_USERS)
    near = _pairs(left, right, condition, users, places)
    lonely = left.join(right, condition, "left_anti").select(*users.columns)
    far = nearest_places(lonely, places, n, keys=keys, place_id=place_id, most=most)
    return near.unionByName(far.select(near.columns))
