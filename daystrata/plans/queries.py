"""Registered queries: one per operator, each over whole sample tables.

A query is ``f(spark, folder) -> DataFrame``.  Names follow the operator inventory.  Doubles that are
not rounded by the operator itself are rounded to six digits for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from daystrata import session
from daystrata.functions import categories as C, dates as D, documents as J, geo, text as TX
from daystrata.operators import daily as parse, features as FE, merge, radius as R, recommend as REC
from daystrata.operators import rollup, series, stats, temporal
from daystrata.plans import models as M, sample as X, views
from daystrata.schemas import METRICS
from daystrata.sources import activities, history as H, places as PL, raw as RAW, spine
from daystrata.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
K = X.KEYS


def today():
    return F.lit(X.AS_OF).cast("date")


def query(name: str):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function
    return add


def r6(column, name: str | None = None):
    column = F.col(column) if isinstance(column, str) else column
    rounded = C.half_up(column, 6)
    return rounded.alias(name) if name else rounded


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})


# ------------------------------------------------------------------ scans, sources, sinks
def raw_per_metric(df: DataFrame) -> DataFrame:
    named = RAW.with_partition_columns(df) if "metric" not in df.columns else df
    return named.groupBy("metric", D.date_of_name(F.col("filename")).alias("date")).agg(F.count(F.lit(1)).alias("documents"))


def _raw_folder(spark, folder):
    """Documents of one day and 65,536 event ids as ``*.json`` files in one folder, and beside them one that repeats a
    key, an empty one, one that isn't JSON and a file of another kind."""
    docs = X.event_values(spark, folder)
    bundle = F.floor(F.col("event_id") / 65536).alias("bundle")
    element = F.struct((F.col("v") % 101).alias("charged"), F.col("k").alias("drained"))
    path = session.new_folder(spark, "raw")
    bundles = docs.groupBy("date", bundle).agg(F.collect_list(element).alias("elements"))
    bundles.select(F.col("date").cast("string"), "bundle", "elements").write.option("maxRecordsPerFile", 1).json(path)
    session.put_texts(spark, path, {
        "repeated.json": '{"date": "2023-12-31", "bundle": 1, "bundle": 2, "elements": [1, 2, 3]}', "empty.json": " \n", "broken.json": '{"date": "2023-12-30", ', "notes.txt": "{}",
    })
    return path


@query("scan_raw_documents")
def scan_raw_documents(spark, folder):
    """Of equal keys the last counts, as in a document read by name."""
    read = RAW.scan_raw_documents(spark, _raw_folder(spark, folder))
    document = F.from_json("raw_json", "struct<date:date,bundle:bigint,elements:array<string>>").alias("d")
    return read.select(document).select("d.date", "d.bundle", F.size("d.elements").cast("bigint").alias("elements"))


@query("canonical_json")
def canonical_json(spark, folder):
    return RAW.canonical_documents(X.raw_documents(spark, folder))


@query("raw_sink_overwrite")
def raw_sink_overwrite(spark, folder):
    """Written twice with reset: the rerun leaves no duplicates."""
    path = session.new_folder(spark, "sink")
    for _ in range(2):
        RAW.write_raw(X.raw_documents(spark, folder), path, reset=True)
    return raw_per_metric(spark.read.parquet(path))


@query("raw_sink_append")
def raw_sink_append(spark, folder):
    """The same newline-delimited rows appended twice count double."""
    source, path = session.new_folder(spark, "ndjson"), session.new_folder(spark, "sink")
    X.raw_documents(spark, folder).write.json(source)
    for _ in range(2):
        RAW.append_ndjson(spark, source, path, keys="user_id bigint")
    return raw_per_metric(spark.read.parquet(path))


@query("schema_guard")
def schema_guard(spark, folder):
    """A table without the required columns is rebuilt instead of appended to."""
    path = session.new_folder(spark, "guard")
    raw = X.raw_documents(spark, folder)
    raw.withColumnRenamed("raw_json", "payload").write.parquet(path)
    RAW.write_raw(raw, path, reset=False)
    return raw_per_metric(spark.read.parquet(path))


def _scan_metric(metric):
    def run(spark, folder):
        rows = RAW.scan_metric(X.raw_documents(spark, folder), metric)
        return rows.select("user_id", D.date_of_name(F.col("filename")).alias("date")).distinct()
    return run


for _metric in METRICS:
    QUERIES[f"scan_metric_{_metric}"] = _scan_metric(_metric)


def _activity_headers(spark, folder):
    path = session.new_folder(spark, "activities")
    X.activity_lines(spark, folder).write.text(path)
    return activities.activity_headers(activities.scan_activity_variants(spark, path, multiline=False))


@query("scan_activities")
def scan_activities(spark, folder):
    path = session.new_folder(spark, "activities")
    X.activity_lines(spark, folder).write.text(path)
    docs = activities.scan_activities(spark, path, multiline=False)
    return docs.select("activityId", F.col("summaryDTO.duration").alias("duration"), F.col("activityTypeDTO.typeKey").alias("type_key"))


QUERIES["activity_headers"] = _activity_headers


@query("latest_activities")
def latest_activities(spark, folder):
    return activities.latest_activities(_activity_headers(spark, folder))


def _owners(spark, folder):
    return X.table(spark, folder, "events").select("user_id").distinct()


@query("expected_documents")
def expected_documents(spark, folder):
    return spine.expected_documents(date(2024, 1, 1), X.AS_OF, owners=_owners(spark, folder))


@query("missing_documents")
def missing_documents(spark, folder):
    expected = spine.expected_documents(date(2024, 1, 1), X.AS_OF, owners=_owners(spark, folder))
    return spine.missing_documents(expected, X.raw_documents(spark, folder), keys=K)


@query("incremental_landing")
def incremental_landing(spark, folder):
    """The first half of the month lands, then the rest, then a run with nothing new."""
    source, target, mark = (session.new_folder(spark, n) for n in ("incoming", "landed", "checkpoint"))
    raw = X.raw_documents(spark, folder)
    early = D.date_of_name(F.col("filename")) < F.lit("2024-01-16").cast("date")
    for part in (early, ~early, None):
        if part is not None:
            raw.filter(part).write.mode("append").json(source)
        landing.land_new_files(spark, source, target, mark, "user_id bigint, filename string, raw_json string")
    return raw_per_metric(landing.landed(spark, target))


@query("valid_payload")
def valid_payload(spark, folder):
    raw = X.raw_documents(spark, folder)
    kept = raw.filter(J.valid_payload(F.col("raw_json")))
    return raw_per_metric(kept)


@query("history_rows")
def history_rows(spark, folder):
    return H.history_rows(X.history_documents(spark, folder), keys=K).distinct()


@query("history_upsert")
def history_upsert(spark, folder):
    """Visits up to the middle of the month are on record; all visits come in again, some without date."""
    rows = X.visits(spark, folder).withColumn("name", F.concat(F.lit("place "), F.col("place_id").cast("string")))
    old = rows.filter("visit_date < '2024-01-16'").select("user_id", "name", "visit_date").distinct()
    new = rows.withColumn("visit_date", F.when(F.col("event_id") % 7 != 0, F.col("visit_date")))
    return H.history_upsert(old, new, keys=K, as_of=X.AS_OF)


@query("history_saved")
def history_saved(spark, folder):
    """A stored history: the first half of the month, then all visits, sent twice as after a failure."""
    rows = X.visits(spark, folder).withColumn("name", F.concat(F.lit("place "), F.col("place_id").cast("string")))
    rows = rows.withColumn("visit_date", F.when(F.col("event_id") % 7 != 0, F.col("visit_date")))
    path = session.new_folder(spark, "visits")
    for part in (rows.filter("visit_date < '2024-01-16'"), rows, rows):
        H.save_visits(spark, path, part, keys=K, as_of=X.AS_OF)
    return H.saved_visits(spark, path)


@query("place_table")
def place_table(spark, folder):
    return rounded(X.places(spark, folder), "lat", "lon", "rating")


@query("view_registry")
def view_registry(spark, folder):
    """Rows per registered view, read through SQL.  The documents land once; the views share one stored merge, and are
    dropped once their few rows are stored."""
    path = session.new_folder(spark, "landed")
    RAW.write_raw(X.raw_documents(spark, folder), path)
    with views.SharedViews(spark, lambda: spark.read.parquet(path), keys=K) as shared:
        shared.views()
        return session.checkpointed(spark.sql(" UNION ALL ".join(
            f"SELECT '{name}' AS view_name, count(*) AS row_count FROM {name}" for name in views.VIEW_ORDER
        )))


@query("ordered_view_read")
def ordered_view_read(spark, folder):
    return views.ordered_view(rollup.dashboard_daily(X.daily(spark, folder), keys=K), ["date", "user_id"])


@query("cached_view")
def cached_view(spark, folder):
    """One stored relation feeds two reports."""
    with views.SharedViews(spark, lambda: X.raw_documents(spark, folder), keys=K) as shared:
        held = shared.views()
        months = held["v_data_quality_summary"].select("user_id", "total_days")
        weeks = held["v_dashboard_weekly"].groupBy("user_id").agg(F.sum("days_in_week").alias("week_days"))
        return months.join(weeks, "user_id")


# ------------------------------------------------------------------ JSON functions
def _named(spark, folder, metric):
    raw = RAW.scan_metric(X.raw_documents(spark, folder), metric)
    return raw.withColumn("date", D.date_of_name(F.col("filename")))


@query("json_scalar")
def json_scalar(spark, folder):
    doc = F.col("raw_json")
    return _named(spark, folder, "sleep").select(
        "user_id", "date", J.json_scalar(doc, "$.bodyBatteryChange").alias("change_text"),
        J.json_scalar(doc, "$.dailySleepDTO").alias("nested_text"), J.json_scalar(doc, "$.absent").alias("absent_text"),
    )


@query("json_root_index")
def json_root_index(spark, folder):
    doc = F.col("raw_json")
    return _named(spark, folder, "body_battery").select(
        "user_id", "date", J.json_scalar(doc, "$[0].charged").alias("charged_text"), J.json_scalar(doc, "$[1].charged").alias("second_text")
    )


@query("json_nested_path")
def json_nested_path(spark, folder):
    return _named(spark, folder, "sleep").select(
        "user_id", "date", J.json_scalar(F.col("raw_json"), "$.dailySleepDTO.sleepTimeSeconds").alias("seconds_text")
    )


@query("json_array")
def json_array(spark, folder):
    items = J.json_array(F.col("raw_json"))
    return _named(spark, folder, "steps").groupBy("user_id", "date").agg(F.sum(F.size(items)).alias("elements"))


@query("unnest_intervals")
def unnest_intervals(spark, folder):
    return parse.unnest_intervals(X.raw_documents(spark, folder), keys=K)


def _replies(spark, folder):
    """Model replies made from parts: fenced, bare fence, plain, garbage, empty."""
    song = F.struct(
        F.col("p_name").alias("title"), F.col("p_brand").alias("artist"), F.col("p_type").alias("reason")
    )
    other = F.struct(F.col("p_type").alias("title"), F.col("p_name").alias("artist"), F.lit("second").alias("reason"))
    body = F.to_json(F.array(song, other))
    shape = F.col("p_partkey") % 5
    reply = (
        F.when(shape == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\nEnjoy")))
        .when(shape == 1, F.concat(F.lit("```\n"), body, F.lit("\n```")))
        .when(shape == 2, body).when(shape == 3, F.concat(F.lit("Sorry, no list: "), body)).otherwise(F.lit(""))
    )
    return X.table(spark, folder, "part").select("p_partkey", reply.alias("reply"))


@query("json_reply_rows")
def json_reply_rows(spark, folder):
    return _replies(spark, folder).select("p_partkey", F.inline(J.reply_rows(F.col("reply"))))


def _part_mood(index):
    names = F.array(*[F.lit(m) for m in (*X.MOODS, "unheard_of")])
    return F.element_at(names, (index % 7 + 1).cast("int"))


@query("map_lookup_default")
def map_lookup_default(spark, folder):
    named = X.table(spark, folder, "part").select("p_partkey", _part_mood(F.col("p_size")).alias("mood"))
    return named.select(
        "p_partkey", "mood", J.lookup(TX.MOOD_TITLES, F.col("mood"), "Standard").alias("title"),
        J.lookup(TX.MOOD_REASONS, F.col("mood"), "General recommendation").alias("reason"),
        J.lookup(TX.MOOD_PROMPTS, F.col("mood"), "in a neutral mood").alias("prompt_words"),
    )


@query("map_explode_latest")
def map_explode_latest(spark, folder):
    return H.last_visits(H.history_rows(X.history_documents(spark, folder), keys=K), keys=K)


# ------------------------------------------------------------------ text functions
@query("like_prefix")
def like_prefix(spark, folder):
    """Names whose underscore is replaced still match: the pattern's underscore is a wildcard."""
    raw = X.raw_documents(spark, folder).select(F.concat(F.translate("filename", "_", "-")).alias("filename"), "user_id")
    named = raw.withColumn("metric", RAW.metric_of_name(F.col("filename")))
    return named.select("metric", "user_id", D.date_of_name(F.col("filename")).alias("date")).distinct().groupBy("metric").agg(
        F.count(F.lit(1)).alias("user_days"))


@query("regex_date")
def regex_date(spark, folder):
    name = F.col("filename")
    return X.raw_documents(spark, folder).select(
        "user_id", "filename", D.date_text_in_name(name).alias("date_text"),
        D.date_text_in_name(F.substring_index(name, "-", 1)).alias("none_text"),
    ).distinct()


@query("street_name")
def street_name(spark, folder):
    rows = X.table(spark, folder, "supplier")
    key = F.col("s_suppkey")
    tail = F.element_at(F.array(F.lit(" 12A, City"), F.lit(" 12a"), F.lit(" 7"), F.lit(", City")), (key % 4 + 1).cast("int"))
    address = F.when(key % 6 == 5, F.lit("")).otherwise(F.concat("s_name", tail))
    return rows.select("s_suppkey", address.alias("address")).withColumn("street", TX.street_name(F.col("address"), F.col("s_suppkey") + 1))


@query("label_prettify")
def label_prettify(spark, folder):
    return X.table(spark, folder, "part").select("p_partkey", TX.prettify(_part_mood(F.col("p_size"))).alias("label"))


@query("number_format")
def number_format(spark, folder):
    value = F.col("value")
    return X.table(spark, folder, "events").select(
        "event_id", TX.fixed(value, 0).alias("whole"), TX.fixed(value, 1).alias("one"), TX.fixed(value / 8, 2).alias("two"),
        TX.fixed(F.floor(value) / 4 - 3, 1).alias("quarters"), TX.fixed(value * 1000, 0, thousands=True).alias("grouped"),
        TX.fixed(F.floor(value) / 2, 0, plus=True).alias("signed"),
    )


@query("sentence_case")
def sentence_case(spark, folder):
    return X.table(spark, folder, "part").select(
        "p_partkey", TX.sentence_case(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("sentence")
    )


def _people(spark, folder):
    return REC.with_weather_defaults(X.people(spark, folder))


def _with_mood(df):
    return df.withColumn("mood", REC.mood(*[
        F.col(c) for c in ("stress", "sleep_hours", "net_battery", "temperature", "precipitation")
    ]))


@query("reason_text")
def reason_text(spark, folder):
    user = F.col("user_id")
    rows = REC.profile_join(_with_mood(_people(spark, folder))).withColumns({
        "p": F.when(user % 5 != 0, user % 22), "b": user % 26,
    })
    return rows.select("user_id", TX.reason_text(*[F.col(c) for c in (
        "stress", "sleep_hours", "net_battery", "mood", "temperature", "precipitation", "p", "b", "ndvi", "nightlight"
    )]).alias("reason"))


@query("prompt_text")
def prompt_text(spark, folder):
    return REC.song_prompts(_with_mood(_people(spark, folder)), keys=K).select("user_id", "prompt")


@query("weather_text")
def weather_text(spark, folder):
    return _people(spark, folder).select("user_id", TX.weather_text(F.col("temperature"), F.col("precipitation")).alias("weather_text"))


@query("relative_day_label")
def relative_day_label(spark, folder):
    rows = X.event_values(spark, folder)
    return rows.select("event_id", TX.relative_day_label(D.days_ago(F.col("date"), F.lit(date(2024, 1, 30)))).alias("label"))


# ------------------------------------------------------------------ date functions
def _order_date(name, function):
    def run(spark, folder):
        return X.table(spark, folder, "orders").select("o_orderkey", function(F.to_date("o_orderdate")).alias(name))
    QUERIES[name] = run


for _name, _function in {
    "month_label": D.month_label, "weekday_name": D.weekday_name, "weekday_num": D.weekday_number,
    "week_start": D.week_start, "week_label": D.week_label, "month_start": D.month_start, "month_name": D.month_name,
    "long_date": D.long_date, "days_ago": lambda d: D.days_ago(d, today()),
}.items():
    _order_date(_name, _function)


@query("parse_date")
def parse_date(spark, folder):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    broken = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.substring(text, 1, 5), F.lit("13-01"))).otherwise(text)
    return X.table(spark, folder, "orders").select("o_orderkey", D.parse_date(text, strict=True).alias("day"), D.parse_date(broken).alias("checked_day"))


@query("date_sequence")
def date_sequence(spark, folder):
    spans = X.event_values(spark, folder).groupBy("user_id").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return spans.select("user_id", F.explode(D.date_series(F.col("a"), F.col("b"))).alias("date"))


@query("day_seed")
def day_seed(spark, folder):
    return _owners(spark, folder).select("user_id", D.day_hash(today(), F.col("user_id")).alias("seed"))


# ------------------------------------------------------------------ math and conditions
@query("cast_numeric")
def cast_numeric(spark, folder):
    text = F.col("o_orderpriority")
    return X.table(spark, folder, "orders").select(
        "o_orderkey", C.to_number(text).alias("bad"), C.to_number(F.substring(text, 1, 1), strict=True).alias("good"),
        C.to_number(F.col("o_totalprice").cast("string"), "double").alias("price"),
    )


# Columns are built when a query runs, as they need a session; modules can be imported without one.
def _on_daily(name, **columns):
    def run(spark, folder):
        return X.daily(spark, folder).select("user_id", "date", *[c().alias(n) for n, c in columns.items()])
    QUERIES[name] = run


def _on_steps(name, **columns):
    def run(spark, folder):
        totals = parse.steps_daily(X.raw_documents(spark, folder), keys=K)
        return totals.select("user_id", "date", *[c().alias(n) for n, c in columns.items()])
    QUERIES[name] = run


_on_daily("stress_level_num", stress_level_num=lambda: C.stress_level_number(F.col("avg_stress")))
_on_daily("recovery_status", recovery_status=lambda: C.recovery_status(F.col("net_battery")))
_on_daily("activity_level", activity_level=lambda: C.activity_level(F.col("steps")))
_on_daily("presence_flag", has_steps_data=lambda: F.col("steps").isNotNull())
_on_daily("binary_label", high_stress=lambda: C.high_stress_label(F.col("avg_stress")))
_on_daily("net_difference", net_battery=lambda: F.col("charged") - F.col("drained"))
_on_daily("round_n", one=lambda: C.half_up(F.col("sleep_hours"), 1), two=lambda: C.half_up(F.col("sleep_hours"), 2), whole=lambda: C.half_up(F.col("net_battery") / 2, 0))
_on_daily("coalesce_key", any_value=lambda: F.coalesce("steps", "charged", "resting_hr", "avg_stress"))
_on_daily("axis_scaling", drained_down=lambda: -F.col("drained"), sleep_scaled=lambda: r6(F.col("sleep_hours") * 5))
_on_steps("zero_to_null", steps=lambda: C.zero_to_null(F.col("steps_raw")))
_on_steps("steps_quality", data_quality=lambda: C.steps_quality(F.col("steps_raw")))


@query("seconds_to_hours")
def seconds_to_hours(spark, folder):
    return rounded(parse.sleep_daily(X.raw_documents(spark, folder), keys=K).select("user_id", "date", "sleep_hours", "awake_hours"), "sleep_hours", "awake_hours")


@query("stress_category")
def stress_category(spark, folder):
    rows = parse.stress_daily(X.raw_documents(spark, folder), keys=K)
    return rows.select("user_id", "date", C.stress_category(F.col("avg_stress")).alias("stress_category"))


# Example weights for the logit of the order-day series.
WEIGHTS, INTERCEPT = {"resting_hr": 0.08, "charged": -0.03, "drained": 0.02}, -4.0


def _logits(spark, folder):
    days = FE.dropna_subset(X.order_days(spark, folder), list(WEIGHTS))
    return days.select("date", C.linear_logit(WEIGHTS, INTERCEPT).alias("logit")).withColumn("probability", C.sigmoid(F.col("logit")))


@query("sigmoid_logit")
def sigmoid_logit(spark, folder):
    return rounded(_logits(spark, folder), "logit", "probability")


@query("sigmoid_curve")
def sigmoid_curve(spark, folder):
    return rounded(M.logit_curve(_logits(spark, folder)), "logit", "probability")


@query("sort_logit")
def sort_logit(spark, folder):
    return rounded(_logits(spark, folder).orderBy("logit", "date"), "logit", "probability")


def _visit_points(spark, folder):
    """Visits with home and place coordinates."""
    spots = X.places(spark, folder).select("place_id", "lat", "lon")
    user = F.col("user_id")
    lat, lon = X._city_point(F.floor(user / X.USERS_PER_CITY), user, 41, 59)
    return X.visits(spark, folder).join(spots, "place_id").withColumns({"home_lat": lat, "home_lon": lon})


@query("geo_distance_km")
def geo_distance_km(spark, folder):
    d = geo.distance_km(*[F.col(c) for c in ("home_lat", "home_lon", "lat", "lon")])
    return _visit_points(spark, folder).select("event_id", "place_id", C.half_up(d, 5).alias("distance_km"))


@query("radius_filter")
def radius_filter(spark, folder):
    d = geo.distance_km(*[F.col(c) for c in ("home_lat", "home_lon", "lat", "lon")])
    near = R.radius_filter(_visit_points(spark, folder).withColumn("distance_km", d), F.col("distance_km"), F.lit(10.0))
    return near.select("event_id", C.half_up(F.col("distance_km"), 5).alias("distance_km"))


# ------------------------------------------------------------------ projections and filters
@query("dashboard_daily")
def dashboard_daily(spark, folder):
    return rollup.dashboard_daily(X.daily(spark, folder), keys=K)


@query("rename")
def rename(spark, folder):
    return FE.rename(X.daily(spark, folder).select("user_id", "date", *FE.ANALYSIS_NAMES), FE.ANALYSIS_NAMES)


@query("not_null_filter")
def not_null_filter(spark, folder):
    return FE.dropna_subset(X.daily(spark, folder), ["avg_stress"]).select("user_id", "date", "avg_stress")


@query("date_range_filter")
def date_range_filter(spark, folder):
    return FE.date_range_filter(X.daily(spark, folder), date(2024, 1, 5), date(2024, 1, 12)).select("user_id", "date", "steps")


@query("dropna_subset")
def dropna_subset(spark, folder):
    return FE.dropna_subset(X.daily(spark, folder), ["net_battery", "avg_stress"]).select("user_id", "date", "net_battery", "avg_stress")


@query("numeric_columns")
def numeric_columns(spark, folder):
    rows = X.order_days(spark, folder)
    return rounded(rows.select("date", *FE.numeric_columns(rows, exclude=["avg_stress"])), "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


@query("existing_columns")
def existing_columns(spark, folder):
    rows = X.daily(spark, folder)
    return rows.select("user_id", "date", *FE.existing_columns(rows, ["resting_hr", "heartRateValues_mean", "charged", "avgOvernightHrv", "drained"]))


@query("drop_sparse_columns")
def drop_sparse_columns(spark, folder):
    """On the user-day relation nearly every metric is sparse; has_steps_data and the keys stay."""
    rows = X.daily(spark, folder).select("user_id", "date", "steps", "charged", "avg_stress", "has_steps_data")
    return FE.drop_sparse_columns(rows)


@query("min_rows_guard")
def min_rows_guard(spark, folder):
    return FE.min_rows_guard(X.daily(spark, folder), 20, keys=K).select("user_id", "date")


@query("min_rows_guard_global")
def min_rows_guard_global(spark, folder):
    return FE.min_rows_guard(X.order_days(spark, folder), 20).select("date", "avg_stress")


@query("scatter_projection")
def scatter_projection(spark, folder):
    rows = FE.rename(X.daily(spark, folder), FE.ANALYSIS_NAMES)
    wanted = ["sleepHeartRate_mean", "steps", "bodyBatteryChange", "restingHeartRate", "maxStressLevel"]
    return FE.scatter_projection(rows, wanted, "avgStressLevel", keys=["user_id", "date"])


# ------------------------------------------------------------------ joins
@query("daily_metrics")
def daily_metrics(spark, folder):
    return rounded(X.daily(spark, folder), "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


def _sides(spark, folder):
    raw = X.raw_documents(spark, folder)
    return {
        "steps": parse.steps_daily(raw, keys=K), "body_battery": parse.body_battery_daily(raw, keys=K),
        "heart_rate": parse.heart_rate_daily(raw, keys=K), "stress": parse.stress_daily(raw, keys=K),
        "sleep": parse.sleep_daily(raw, keys=K),
    }


@query("daily_metrics_chain")
def daily_metrics_chain(spark, folder):
    return rounded(merge.merge_daily(_sides(spark, folder), keys=K, form="chain"), "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


@query("daily_metrics_sides")
def daily_metrics_sides(spark, folder):
    return rounded(merge.merge_daily(_sides(spark, folder), keys=K), "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


@query("daily_metrics_repeated")
def daily_metrics_repeated(spark, folder):
    """Some days with two raw documents of a metric or of two metrics: the rows multiply."""
    raw = X.raw_documents(spark, folder)
    name, rest = F.col("filename"), F.col("user_id") % 3
    again = raw.filter(((name.startswith("body_battery_") | name.startswith("sleep_")) & (rest == 0)) | (name.startswith("stress_") & (rest == 1)))
    return rounded(merge.daily_metrics(raw.unionByName(again), keys=K, form="lists"), "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


@query("daily_metrics_repeated_sides")
def daily_metrics_repeated_sides(spark, folder):
    """The same from parsed relations."""
    sides = _sides(spark, folder)
    for side, rest in (("body_battery", 0), ("sleep", 0), ("stress", 1)):
        sides[side] = sides[side].unionByName(sides[side].filter(F.col("user_id") % 3 == rest))
    return rounded(merge.merge_daily(sides, keys=K, form="lists"), "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


@query("unnest_cross")
def unnest_cross(spark, folder):
    rows = parse.unnest_intervals(X.raw_documents(spark, folder), keys=K)
    return rows.groupBy("user_id", "date").agg(F.count(F.lit(1)).alias("interval_count"))


def _supplier_addresses(spark, folder):
    return X.places(spark, folder).select("place_id", "address")


@query("lookup_first_default")
def lookup_first_default(spark, folder):
    base = _supplier_addresses(spark, folder)
    parks, _ = X.count_lookups(base.withColumn("address", F.when(F.col("address") == "Town", F.lit("")).otherwise(F.col("address"))))
    return PL.lookup_first_default(base, parks, key="address", value="parks_count_1km", order="ord")


@query("score_lookup")
def score_lookup(spark, folder):
    spots = X.places(spark, folder)
    wide = spots.select("place_id", "name", F.explode(F.array(*[F.lit(m) for m in X.MOODS])).alias("mood"))
    scored = REC.score_lookup(wide, X.class_scores(spots), on=["mood", "name"])
    return scored.select("place_id", "mood", r6("confidence", "confidence"))


@query("history_join")
def history_join(spark, folder):
    """Penalty of every place in the user's city that the user has ever visited, and some not visited."""
    spots = X.places(spark, folder)
    log = X.history(spark, folder, spots)
    pairs = X.visits(spark, folder).withColumn("place_id", F.col("place_id") + F.col("event_id") % 2).select("user_id", "place_id").distinct()
    named = pairs.join(spots.select("place_id", "name"), "place_id")
    return REC.history_join(named, log, as_of=today(), keys=K).select("user_id", "place_id", "last_visit", "history_penalty")


def _homes(spark, folder):
    user = F.col("user_id")
    lat, lon = X._city_point(F.floor(user / X.USERS_PER_CITY), user, 41, 59)
    return _owners(spark, folder).select("user_id", (lat + F.when(user % 10 == 7, 3.0).otherwise(0.0)).alias("home_lat"), lon.alias("home_lon"))


def _spots(spark, folder):
    return X.places(spark, folder).select("place_id", "name", "lat", "lon")


@query("radius_join")
def radius_join(spark, folder):
    pairs = R.radius_join(_homes(spark, folder), _spots(spark, folder), F.lit(10.0), keys=K, sizes_km=[10.0])
    return pairs.select("user_id", "place_id", C.half_up(F.col("distance_km"), 5).alias("distance_km"))


@query("radius_fallback")
def radius_fallback(spark, folder):
    pairs = R.radius_or_nearest(_homes(spark, folder), _spots(spark, folder), F.lit(4.0), 3, keys=K, sizes_km=[4.0])
    return pairs.select("user_id", "place_id", C.half_up(F.col("distance_km"), 4).alias("distance_km"))


@query("radius_or_nearest_single")
def radius_or_nearest_single(spark, folder):
    """One home at the south-west corner of all, without keys: places within 400 km, else the three nearest."""
    home = _homes(spark, folder).agg(F.min("home_lat").alias("home_lat"), F.min("home_lon").alias("home_lon"))
    pairs = R.radius_or_nearest(home, _spots(spark, folder), F.lit(400.0), 3)
    return pairs.select("place_id", C.half_up(F.col("distance_km"), 4).alias("distance_km"))


@query("nsmallest")
def nsmallest(spark, folder):
    """The five nearest places of every user."""
    near = R.nearest_places(_homes(spark, folder), _spots(spark, folder), 5, keys=K)
    return near.select("user_id", "place_id", C.half_up(F.col("distance_km"), 4).alias("distance_km"))


@query("spine_cross")
def spine_cross(spark, folder):
    span = X.event_values(spark, folder).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select(F.explode(D.date_series(F.col("a"), F.col("b"))).alias("date"))
    return days.withColumn("metric", F.explode(F.array(*[F.lit(m) for m in METRICS])))


@query("anti_existing")
def anti_existing(spark, folder):
    """User-days with activity but without a stress document."""
    days = X.event_values(spark, folder).select("user_id", "date").distinct()
    have = parse.stress_daily(X.raw_documents(spark, folder), keys=K).select("user_id", "date")
    return days.join(have, ["user_id", "date"], "left_anti")


@query("profile_join")
def profile_join(spark, folder):
    rows = X.table(spark, folder, "part").select("p_partkey", _part_mood(F.col("p_size")).alias("mood"))
    return REC.profile_join(rows)


# ------------------------------------------------------------------ aggregations
@query("steps_daily")
def steps_daily(spark, folder):
    return parse.steps_daily(X.raw_documents(spark, folder), keys=K)


@query("body_battery_daily")
def body_battery_daily(spark, folder):
    return parse.body_battery_daily(X.raw_documents(spark, folder), keys=K)


@query("heart_rate_daily")
def heart_rate_daily(spark, folder):
    return parse.heart_rate_daily(X.raw_documents(spark, folder), keys=K)


@query("stress_daily")
def stress_daily(spark, folder):
    return parse.stress_daily(X.raw_documents(spark, folder), keys=K)


@query("sleep_daily")
def sleep_daily(spark, folder):
    rows = parse.sleep_daily(X.raw_documents(spark, folder), keys=K)
    return rounded(rows, *[c for c in rows.columns if c.endswith("_hours")])


@query("data_quality_summary")
def data_quality_summary(spark, folder):
    return rollup.data_quality_summary(X.daily(spark, folder), keys=K)


@query("data_quality_orders")
def data_quality_orders(spark, folder):
    return rollup.data_quality_summary(X.order_days(spark, folder))


@query("dashboard_weekly")
def dashboard_weekly(spark, folder):
    return rollup.dashboard_weekly(X.daily(spark, folder), keys=K)


@query("dashboard_weekly_orders")
def dashboard_weekly_orders(spark, folder):
    return rollup.dashboard_weekly(X.order_days(spark, folder))


@query("dashboard_monthly")
def dashboard_monthly(spark, folder):
    return rollup.dashboard_monthly(X.daily(spark, folder), keys=K)


@query("dashboard_monthly_orders")
def dashboard_monthly_orders(spark, folder):
    return rollup.dashboard_monthly(X.order_days(spark, folder))


def _user_agg(name, columns):
    def run(spark, folder):
        return X.daily(spark, folder).groupBy(*K).agg(*columns())
    QUERIES[name] = run


_user_agg("count_if", lambda: [
    rollup.count_if(F.col("avg_stress") > 50, "high_days"), rollup.count_if(F.col("steps").isNotNull(), "step_days")
])
_user_agg("conditional_avg", lambda: [r6(F.avg(F.when(F.col("has_steps_data"), F.col("steps"))), "avg_steps")])
_user_agg("ratio_pct", lambda: [rollup.share(F.col("has_steps_data"), "coverage_pct")])


@query("category_distribution")
def category_distribution(spark, folder):
    return rollup.category_distribution(X.daily(spark, folder), "stress_category")


@query("flag_distribution")
def flag_distribution(spark, folder):
    return rollup.category_distribution(X.daily(spark, folder), "has_steps_data")


@query("table_extent")
def table_extent(spark, folder):
    return rollup.table_extent(X.daily(spark, folder))


@query("mean_std")
def mean_std(spark, folder):
    rows = FE.rename(X.daily(spark, folder), FE.ANALYSIS_NAMES)
    wanted = ["avgStressLevel", "restingHeartRate", "steps", "bodyBatteryChange", "avgOvernightHrv", "heartRateValues_mean"]
    return rounded(stats.mean_std(rows, wanted), "mean", "std")


@query("missing_profile")
def missing_profile(spark, folder):
    rows = X.daily(spark, folder).select("steps", "charged", "avg_stress", "sleep_hours", "stress_category", "has_steps_data")
    return stats.missing_profile(rows)


@query("sparse_profile")
def sparse_profile(spark, folder):
    rows = X.daily(spark, folder).select("steps", "charged", "avg_stress", "has_steps_data")
    return stats.sparse_profile(rows)


@query("median_fill")
def median_fill(spark, folder):
    filled = FE.median_fill(X.order_days(spark, folder), ["avg_stress", "resting_hr", "sleep_hours", "steps"])
    return rounded(filled.select("date", "avg_stress", "resting_hr", "sleep_hours", "steps"), "sleep_hours")


@query("median_fill_users")
def median_fill_users(spark, folder):
    """Medians per user."""
    filled = FE.median_fill(X.daily(spark, folder), ["avg_stress", "sleep_hours"], keys=K)
    return rounded(filled.select("user_id", "date", "avg_stress", "sleep_hours"), "avg_stress", "sleep_hours")


@query("exact_medians")
def exact_medians(spark, folder):
    """Medians of row-level columns of the largest table."""
    lines = X.table(spark, folder, "lineitem")
    return rounded(stats.exact_medians(lines, ["l_extendedprice", "l_quantity", "l_discount"]), "median")


@query("pearson_corr")
def pearson_corr(spark, folder):
    return rounded(stats.pearson_corr(X.order_days(spark, folder), ["resting_hr", "charged", "sleep_hours"], "avg_stress"), "corr")


@query("pearson_corr_lineitem")
def pearson_corr_lineitem(spark, folder):
    lines = X.table(spark, folder, "lineitem")
    return rounded(stats.pearson_corr(lines, ["l_quantity", "l_discount"], "l_extendedprice"), "corr")


@query("ols_trend")
def ols_trend(spark, folder):
    pairs = [("sleep_hours", "avg_stress"), ("net_battery", "avg_stress")]
    return rounded(stats.ols_trend(X.order_days(spark, folder), pairs), "slope", "intercept", "r2")


@query("kpi_vs_mean")
def kpi_vs_mean(spark, folder):
    return rounded(temporal.kpi_vs_mean(X.daily(spark, folder), keys=K), "mean", "delta")


@query("kpi_cards")
def kpi_cards(spark, folder):
    return temporal.kpi_cards(X.daily(spark, folder), as_of=X.AS_OF, keys=K)


@query("latest_complete_row")
def latest_complete_row(spark, folder):
    rows = X.daily(spark, folder).select("user_id", "date", "avg_stress", "steps", "charged", "resting_hr")
    return temporal.latest_complete_row(rows, keys=K)


@query("recent_means")
def recent_means(spark, folder):
    return rounded(temporal.recent_means(X.daily(spark, folder), keys=K), "stress", "sleep_hours", "net_battery", "resting_hr")


@query("histogram20")
def histogram20(spark, folder):
    return rounded(stats.histogram(X.daily(spark, folder), "avg_stress"), "low", "high")


@query("positive_rate")
def positive_rate(spark, folder):
    rows = X.order_days(spark, folder).select(F.coalesce(C.high_stress_label(F.col("avg_stress")), F.lit(0)).alias("label"))
    return rounded(stats.positive_rate(rows, "label"), "rate")


@query("regression_metrics")
def regression_metrics(spark, folder):
    """Quantity x mean price as a naive prediction of the line price."""
    lines = X.table(spark, folder, "lineitem").withColumn("guess", F.col("l_quantity") * 1500.0)
    return stats.regression_metrics(lines, "guess", "l_extendedprice").select(r6("r2", "r2"), C.half_up(F.col("rmse"), 3).alias("rmse"), C.half_up(F.col("mae"), 3).alias("mae"))


@query("accuracy")
def accuracy(spark, folder):
    lines = X.table(spark, folder, "lineitem").select(
        (F.col("l_quantity") > 25).cast("int").alias("guess"), (F.col("l_extendedprice") > 40000).cast("int").alias("truth")
    )
    return rounded(stats.accuracy(lines, "guess", "truth"), "accuracy")


# ------------------------------------------------------------------ windows
def _user_window(name, build):
    def run(spark, folder):
        rows = X.daily(spark, folder)
        window = Window.partitionBy(*K).orderBy("date")
        return rows.select("user_id", "date", *[c.alias(n) for n, c in build(window).items()])
    QUERIES[name] = run


_user_window("next_day_lead", lambda w: {k: v for k, v in temporal.lag_columns(w).items() if k.startswith("next")})
_user_window("prev_day_lag", lambda w: {
    "prev_day_sleep": r6(temporal.lag_columns(w)["prev_day_sleep"]), "prev_day_steps": temporal.lag_columns(w)["prev_day_steps"]
})
_user_window("rolling_7row_avg", temporal.rolling_columns)
_user_window("wow_change", temporal.change_columns)


@query("dashboard_correlations")
def dashboard_correlations(spark, folder):
    rows = temporal.dashboard_correlations(X.daily(spark, folder), keys=K)
    return rounded(rows, "sleep_hours", "deep_sleep_hours", "prev_day_sleep")


@query("dashboard_correlations_orders")
def dashboard_correlations_orders(spark, folder):
    """One unkeyed series, windowed in chunks."""
    rows = temporal.dashboard_correlations(X.order_days(spark, folder), split=256)
    return rounded(rows, "sleep_hours", "deep_sleep_hours", "prev_day_sleep")


@query("dashboard_trends")
def dashboard_trends(spark, folder):
    return rounded(temporal.dashboard_trends(X.daily(spark, folder), keys=K), "sleep_hours")


@query("dashboard_trends_split")
def dashboard_trends_split(spark, folder):
    """The keyed trends in the chunked form, for series too long for one task."""
    return rounded(temporal.dashboard_trends(X.daily(spark, folder), keys=K, split=16), "sleep_hours")


@query("dashboard_trends_orders")
def dashboard_trends_orders(spark, folder):
    return rounded(temporal.dashboard_trends(X.order_days(spark, folder), split=256), "sleep_hours")


@query("long_series_trends")
def long_series_trends(spark, folder):
    """Rolling means over a single series with one row per order."""
    return series.split_windows(
        X.order_series(spark, folder), lambda w: {**temporal.rolling_columns(w), **temporal.change_columns(w)},
        [F.col("date"), F.col("id")], buckets=[F.col("date"), F.floor(F.col("id") / 100000)], before=7, after=0,
    )


@query("long_series_position")
def long_series_position(spark, folder):
    return series.with_position(
        X.order_series(spark, folder).select("date", "id"), [F.col("date"), F.col("id")],
        buckets=[F.col("date"), F.floor(F.col("id") / 100000)], total="total",
    )


@query("last_n_rows")
def last_n_rows(spark, folder):
    return temporal.last_n_rows(X.daily(spark, folder).select("user_id", "date", "steps"), 7, keys=K)


@query("last_n_rows_orders")
def last_n_rows_orders(spark, folder):
    return temporal.last_n_rows(X.order_days(spark, folder), 30).select("date", "charged", "drained")


@query("cumulative_ratio")
def cumulative_ratio(spark, folder):
    kinds = X.table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return rounded(stats.cumulative_ratio(kinds, "n", "event_type"), "ratio", "cumulative")


@query("max_in_group")
def max_in_group(spark, folder):
    rows = X.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return stats.max_in_group(rows, "l_extendedprice", keys=["l_orderkey"])


@query("chronological_split")
def chronological_split(spark, folder):
    rows = X.daily(spark, folder).select("user_id", "date")
    return FE.chronological_split(rows, ties=["user_id"])


@query("chronological_split_users")
def chronological_split_users(spark, folder):
    return FE.chronological_split(X.daily(spark, folder).select("user_id", "date"), keys=K)


@query("stratified_split")
def stratified_split(spark, folder):
    """Sizes per label and part are exact; which rows go where depends on the hash."""
    rows = X.daily(spark, folder).filter("avg_stress is not null").select(
        "user_id", "date", C.high_stress_label(F.col("avg_stress")).alias("label"))
    parts = FE.stratified_split(rows, "label", ["user_id", "date"])
    return parts.groupBy("label", "split").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------ sorts and limits
@query("order_by_key")
def order_by_key(spark, folder):
    return views.ordered_view(rollup.data_quality_summary(X.order_days(spark, folder)), ["month"])


def _inputs(spark, folder):
    """Users, places, class scores and history.  Users and places are read many times by the recommender,
    so their derivation is cut off with a checkpoint; stored tables would need none."""
    spots = session.checkpointed(X.places(spark, folder))
    users = session.checkpointed(X.people(spark, folder))
    return users, spots, X.class_scores(spots), X.history(spark, folder, spots)


def _scored(spark, folder):
    return REC.scored_candidates(
        *_inputs(spark, folder), as_of=X.AS_OF, keys=K, max_distance_km=None, top_n=3, jitter=False
    )


@query("topn_by_score")
def topn_by_score(spark, folder):
    best = REC.topn_by_score(_scored(spark, folder), 3, keys=K)
    return best.select("user_id", "rank", "place_id", C.half_up(F.col("final_score"), 4).alias("final_score"))


@query("daily_sample")
def daily_sample(spark, folder):
    return REC.daily_sample(X.catalog(spark, folder), as_of=X.AS_OF)


# ------------------------------------------------------------------ feature preparation and models
@query("analysis_frame")
def analysis_frame(spark, folder):
    frame = FE.analysis_frame(X.order_days(spark, folder))
    return rounded(frame, "sleep_hours", "deep_sleep_hours", "rem_sleep_hours")


@query("standardize")
def standardize(spark, folder):
    rows = X.order_days(spark, folder).select("date", "charged", "drained", "net_battery", F.lit(3).alias("constant"))
    return rounded(FE.standardize(rows, ["charged", "drained", "net_battery", "constant"]), "charged", "drained", "net_battery", "constant")


@query("fit_on_train_only")
def fit_on_train_only(spark, folder):
    """Scaler statistics from the first 80 % of the days, applied to all days."""
    days = FE.chronological_split(X.order_days(spark, folder).select("date", "charged", "drained"))
    return rounded(FE.standardize(days, ["charged", "drained"], fit_on=days.filter("split = 'train'")), "charged", "drained")


def _analysis(spark, folder):
    return FE.analysis_frame(X.order_days(spark, folder))


def _pca(spark, folder):
    return M.pca_fit(_analysis(spark, folder), target="avgStressLevel", carry=["date"])


@query("pca_fit")
def pca_fit(spark, folder):
    fit = _pca(spark, folder)
    return rounded(fit.loading_table(len(fit.features)), "pc1")


@query("explained_variance")
def explained_variance(spark, folder):
    return rounded(_pca(spark, folder).explained_variance().filter("component <= 5"), "ratio", "cumulative")


@query("pca_loadings")
def pca_loadings(spark, folder):
    return _pca(spark, folder).loading_table(2)


QUERIES["sort_loadings"] = pca_loadings


@query("pca_scores")
def pca_scores(spark, folder):
    return rounded(_pca(spark, folder).scores(["date", "avgStressLevel"]), "pc1", "pc2")


@query("rf_grid")
def rf_grid(spark, folder):
    search = M.rf_grid(_analysis(spark, folder), target="avgStressLevel")
    return rounded(search.metrics, "r2", "rmse", "mae").withColumns({k: F.lit(v) for k, v in search.params.items()})


def _importance(spark, folder):
    return M.rf_importance(X.order_days(spark, folder))


@query("rf_importance")
def rf_importance(spark, folder):
    return rounded(_importance(spark, folder), "importance", "corr")


@query("top_importances")
def top_importances(spark, folder):
    return rounded(M.top_importances(_importance(spark, folder)), "importance", "corr")


def _logistic(spark, folder):
    return M.logistic_scaled(_analysis(spark, folder), identity=["date"])


@query("logistic_scaled")
def logistic_scaled(spark, folder):
    return rounded(_logistic(spark, folder).accuracy(), "accuracy")


@query("logistic_full")
def logistic_full(spark, folder):
    return rounded(M.logistic_full(_analysis(spark, folder)).accuracy(), "accuracy")


@query("coef_table")
def coef_table(spark, folder):
    return rounded(_logistic(spark, folder).coefficients(), "coefficient", "odds_ratio")


QUERIES["sort_by_abs"] = coef_table


@query("odds_ratio")
def odds_ratio(spark, folder):
    table = M.logistic_full(_analysis(spark, folder)).coefficients()
    return rounded(table.select("feature", "odds_ratio"), "odds_ratio")


def _observations(spark, folder):
    """Feature rows labelled with one of 15 places, from all events: the place sets the surroundings,
    the event adds noise and weather."""
    place, k, v = F.col("place"), F.col("k"), F.col("v")
    known = X.places(spark, folder).filter("place_id between 1 and 15").select((F.col("place_id") - 1).alias("place"), "name")
    rows = X.event_values(spark, folder).withColumn("place", F.col("event_id") % 15).join(known, "place")
    temperature = (k % 35 - 5).cast("double")
    return rows.select(
        "name",
        (place + k % 3).cast("double").alias("parks_count_1km"), (place * 2 % 23 + v % 2).cast("double").alias("open_bars_count_500m"),
        temperature.alias("lst_celsius_1km"), (temperature + 2).alias("temp_max"), (temperature - 3).alias("temp_min"),
        (k % 11).cast("double").alias("precip_mm"), (F.lit(0.3) + place / 40.0).alias("ndvi"), (F.lit(65.0) - place * 3).alias("nightlight"),
    )


@query("class_probabilities")
def class_probabilities(spark, folder):
    model = M.fit_place_classifier(_observations(spark, folder), REC.FEATURE_ORDER)
    contexts = REC.mood_features(_people(spark, folder), keys=K)
    return rounded(M.class_probabilities(model, contexts, keys=K), "probability")


# ------------------------------------------------------------------ recommender
@query("mood_rules")
def mood_rules(spark, folder):
    return _with_mood(_people(spark, folder)).select("user_id", "mood")


@query("mood_features")
def mood_features(spark, folder):
    return REC.mood_features(_people(spark, folder), keys=K)


@query("dynamic_radius")
def dynamic_radius(spark, folder):
    given = F.when(F.col("user_id") % 4 == 0, F.lit(5.0))
    return _people(spark, folder).select("user_id", REC.dynamic_radius(given, F.col("stress"), F.col("precipitation")).alias("radius_km"))


def _score_column(name, digits=4):
    def run(spark, folder):
        return _scored(spark, folder).select("user_id", "place_id", C.half_up(F.col(name), digits).alias(name))
    QUERIES[name] = run


for _name in ("distance_score", "balanced_score", "history_penalty", "final_score"):
    _score_column(_name)


@query("daily_jitter")
def daily_jitter(spark, folder):
    rows = X.visits(spark, folder).select("user_id", "place_id").distinct()
    return rows.select("user_id", "place_id", r6(REC.daily_jitter(today(), F.col("user_id"), F.col("place_id")), "jitter"))


def _recommend(spark, folder, **options):
    return REC.recommend_topn(*_inputs(spark, folder), as_of=X.AS_OF, keys=K, **options)


@query("recommend_topn")
def recommend_topn(spark, folder):
    return _recommend(spark, folder, jitter=False)


@query("recommend_topn_model")
def recommend_topn_model(spark, folder):
    """With the probabilities of the fitted classifier, one scoring for each mood and weather that occurs."""
    users, spots, _, history = _inputs(spark, folder)
    model = M.fit_place_classifier(_observations(spark, folder), REC.FEATURE_ORDER)
    known = session.checkpointed(M.with_chances(users, model, keys=K))
    return REC.recommend_topn(known, spots, None, history, as_of=X.AS_OF, keys=K, jitter=False)


@query("recommend_topn_jitter")
def recommend_topn_jitter(spark, folder):
    """As the dashboard calls it: 10 km, three places, daily variety."""
    return _recommend(spark, folder, jitter=True, max_distance_km=10.0)


@query("catalog_recommend")
def catalog_recommend(spark, folder):
    users = _with_mood(_people(spark, folder)).select("user_id", "mood")
    return REC.catalog_recommend(users, X.catalog(spark, folder), as_of=X.AS_OF, keys=K)
