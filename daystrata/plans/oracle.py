"""The same results in plain SQL over the sample tables, written independently of the Spark code.

The SQL starts from the tables, not from JSON documents.  ``rnd`` rounds a decimal, because rounding a
double takes its binary value and would differ on decimal ties.
"""

from __future__ import annotations

# Words, names and numbers that the results must hold, written out here so that the SQL checks the library's own.
MOOD_TITLES = {
    "cozy_indoor": "Cozy Indoor",
    "green_nature": "Green Nature",
    "buzz_urban": "Buzz Urban",
    "rainy_retreat": "Rainy Retreat",
    "cozy_recharge": "Cozy Recharge",
    "balanced": "Balanced",
}
MOOD_REASONS = {
    "cozy_indoor": "Need for warmth and comfort",
    "green_nature": "Seeking natural, restorative environment",
    "buzz_urban": "Ready for social, energetic atmosphere",
    "rainy_retreat": "Sheltered comfort during bad weather",
    "cozy_recharge": "Recovery and energy restoration",
    "balanced": "Moderate, all-around suitable environment",
}
MOOD_PROMPTS = {
    "cozy_indoor": "cozy and warm, seeking comfort and relaxation indoors",
    "green_nature": "seeking natural, peaceful, and restorative vibes",
    "buzz_urban": "energetic, social, and ready for vibrant activity",
    "rainy_retreat": "sheltered and calm, embracing cozy ambiance during bad weather",
    "cozy_recharge": "in recovery mode, needing quiet and restorative energy",
    "balanced": "in a balanced state, open to moderate activity",
}
PROMPT_TEMPLATE = """You are a music recommendation expert. Based on the following context, recommend exactly 3 songs that would perfectly match this moment.

Context:
- Current mood: %s
- Stress level: %s/100
- Sleep quality: %s hours (average)
- Weather: %s

Please recommend 3 songs that would be perfect for this situation. For each song, provide:
1. Song title
2. Artist name
3. A brief reason (1 sentence) why this song fits the mood and weather

Format your response as a JSON array like this:
[
  {"title": "Song Name", "artist": "Artist Name", "reason": "Brief reason why it fits"},
  {"title": "Song Name 2", "artist": "Artist Name 2", "reason": "Brief reason why it fits"},
  {"title": "Song Name 3", "artist": "Artist Name 3", "reason": "Brief reason why it fits"}
]

Only return the JSON array, no other text."""
MOOD_PROFILES = {
    "cozy_indoor": (8, 2, 25, 0.45),
    "green_nature": (15, 3, 20, 0.7),
    "rainy_retreat": (8, 6, 35, 0.5),
    "buzz_urban": (3, 20, 65, 0.3),
    "cozy_recharge": (10, 4, 28, 0.55),
    "balanced": (8, 10, 40, 0.5),
}
MOODS = ("cozy_indoor", "green_nature", "buzz_urban", "rainy_retreat", "cozy_recharge", "balanced")
METRICS = ("steps", "sleep", "stress", "body_battery", "heart_rate")

ORACLE: dict[str, str] = {}


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38, 9)), {n}) AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


STRESS_CASE = "CASE WHEN {0} <= 25 THEN 'RESTING' WHEN {0} <= 50 THEN 'LOW' WHEN {0} <= 75 THEN 'MEDIUM' ELSE 'HIGH' END"

# Events with derived integers, then one CTE per metric and the merged relation.
BASE = f"""
ev AS (SELECT event_id, user_id, CAST(ts AS DATE) AS date, event_type,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
  CAST(floor(value) AS BIGINT) AS v, CAST(floor(value * 100) AS BIGINT) AS c, value FROM events),
fi AS (SELECT user_id, date, event_type, {big('SUM(k) % 100')} AS k, {big('SUM(v)')} AS v, {big('SUM(c)')} AS c
  FROM ev GROUP BY user_id, date, event_type),
iv AS (SELECT event_id, user_id, date, CASE WHEN k % 10 = 1 THEN NULL WHEN k % 10 = 0 THEN 0 ELSE c END AS steps,
  CASE k % 3 WHEN 0 THEN 'sedentary' WHEN 1 THEN 'active' ELSE 'highlyActive' END AS activity_level
  FROM ev WHERE event_type = 'view'),
st0 AS (SELECT user_id, date, {big('SUM(steps)')} AS steps_raw, MAX(activity_level) AS max_activity_level FROM iv GROUP BY 1, 2),
steps_d AS (SELECT user_id, date, NULLIF(steps_raw, 0) AS steps, steps_raw, max_activity_level,
  CASE WHEN steps_raw = 0 THEN 'NO_DATA' WHEN steps_raw < 1000 THEN 'LOW' ELSE 'OK' END AS data_quality FROM st0),
bb_d AS (SELECT user_id, date, v % 101 AS charged, k AS drained, v % 101 - k AS net_battery FROM fi WHERE event_type = 'click'),
hr_d AS (SELECT user_id, date, 40 + v % 40 AS resting_hr, 120 + k % 60 AS max_hr, 35 + k % 20 AS min_hr,
  40 + k % 40 AS avg_resting_hr_7d FROM fi WHERE event_type = 'purchase'),
ss0 AS (SELECT user_id, date, CASE WHEN k % 20 = 0 THEN NULL ELSE v % 101 END AS avg_stress,
  least(100, v % 101 + k % 30) AS max_stress FROM fi WHERE event_type = 'error'),
ss_d AS (SELECT *, {STRESS_CASE.format('avg_stress')} AS stress_category FROM ss0),
sl0 AS (SELECT user_id, date, k, v, 14400 + c % 21600 AS s FROM fi WHERE event_type = 'signup'),
sl1 AS (SELECT *, s * k // 400 AS deep, s * (99 - k) // 400 AS rem FROM sl0),
sl_d AS (SELECT user_id, date, CAST(s AS DOUBLE) / 3600 AS sleep_hours, CAST(deep AS DOUBLE) / 3600 AS deep_sleep_hours,
  CAST(s - deep - rem AS DOUBLE) / 3600 AS light_sleep_hours, CAST(rem AS DOUBLE) / 3600 AS rem_sleep_hours,
  CAST(k * 30 AS DOUBLE) / 3600 AS awake_hours, k - 30 AS sleep_body_battery_change, 40 + v % 40 AS sleep_resting_hr,
  20 + CAST(k AS DOUBLE) * 0.5 AS avg_overnight_hrv FROM sl1),
daily AS (SELECT user_id, date, steps, data_quality AS steps_quality, charged, drained, net_battery, resting_hr, max_hr, min_hr,
  avg_resting_hr_7d, avg_stress, max_stress, stress_category, sleep_hours, deep_sleep_hours, rem_sleep_hours,
  sleep_body_battery_change, avg_overnight_hrv, steps IS NOT NULL AS has_steps_data
  FROM steps_d FULL JOIN bb_d USING (user_id, date) FULL JOIN hr_d USING (user_id, date)
  FULL JOIN ss_d USING (user_id, date) FULL JOIN sl_d USING (user_id, date)),
docs AS (SELECT user_id, date, CASE event_type WHEN 'view' THEN 'steps' WHEN 'click' THEN 'body_battery'
  WHEN 'purchase' THEN 'heart_rate' WHEN 'error' THEN 'stress' ELSE 'sleep' END AS metric,
  CASE WHEN event_type = 'view' THEN event_id // 4096 ELSE 0 END AS part FROM ev GROUP BY ALL)"""

_O = "CAST(floor({0}(o_totalprice)) AS BIGINT)"
ORDERS = f"""
od0 AS (SELECT CAST(o_orderdate AS DATE) AS date, MIN(o_orderkey) AS k, COUNT(*) AS n, {_O.format('MIN')} AS low,
  {_O.format('MAX')} AS high FROM orders GROUP BY 1),
od1 AS (SELECT *, CAST(14400 + high % 21600 AS DOUBLE) / 3600 AS h FROM od0),
od AS (SELECT date, CASE WHEN k % 4 <> 0 THEN high % 15000 END AS steps, CASE WHEN k % 4 <> 0 THEN 'OK' END AS steps_quality,
  low % 97 AS charged, high % 89 AS drained, low % 97 - high % 89 AS net_battery,
  CASE WHEN n % 7 <> 0 THEN 40 + high % 40 END AS resting_hr, 120 + high % 60 AS max_hr, 35 + low % 20 AS min_hr,
  40 + k % 40 AS avg_resting_hr_7d, CASE WHEN k % 11 <> 0 THEN low % 101 END AS avg_stress,
  low % 101 + k % 30 AS max_stress, CASE WHEN k % 11 <> 0 THEN 'LOW' END AS stress_category,
  CASE WHEN k % 5 <> 0 THEN h END AS sleep_hours, CASE WHEN k % 5 <> 0 THEN h / 4 END AS deep_sleep_hours,
  CASE WHEN k % 5 <> 0 THEN h / 5 END AS rem_sleep_hours, k % 61 - 30 AS sleep_body_battery_change,
  20 + CAST(k % 90 AS DOUBLE) * 0.5 AS avg_overnight_hrv, k % 4 <> 0 AS has_steps_data FROM od1),
os AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, p % 101 AS avg_stress, 40 + p % 40 AS resting_hr,
  CAST(p % 12 AS DOUBLE) AS sleep_hours, p % 77 - 38 AS net_battery
  FROM (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS p FROM orders))"""


def point(city: str, number: str, a: int, b: int) -> tuple[str, str]:
    lat = f"(-55.0::DOUBLE + ({city} * 7919 % 110001)::DOUBLE / 1000 + ({number} * {a} % 400)::DOUBLE / 1000 - 0.2::DOUBLE)"
    lon = f"(-179.0::DOUBLE + ({city} * 104729 % 358007)::DOUBLE / 1000 + ({number} * {b} % 600)::DOUBLE / 1000 - 0.3::DOUBLE)"
    return lat, lon


_PLAT, _PLON = point("(s_suppkey // 40)", "s_suppkey", 37, 53)
_ULAT, _ULON = point("(user_id // 60)", "user_id", 41, 59)
PLACES = f"""
pl0 AS (SELECT s_suppkey AS place_id, CASE WHEN s_suppkey % 17 = 16 THEN '' ELSE s_name || ' ' || (s_suppkey % 90 + 1)
  || CASE WHEN s_suppkey % 3 = 0 THEN 'A' ELSE '' END || ', Town' END AS a0,
  CASE WHEN s_suppkey % 17 = 16 THEN 'Location' || (s_suppkey + 1) ELSE s_name END AS street, {_PLAT} AS lat, {_PLON} AS lon
  FROM supplier),
pl AS (SELECT place_id, 'Cafe_' || street AS name, 'Cafe - ' || street AS display_name,
  CASE WHEN a0 = '' THEN 'Town' ELSE a0 END AS address, lat, lon,
  CASE WHEN place_id % 7 <> 0 THEN 3.0::DOUBLE + (place_id % 20)::DOUBLE / 10 END AS rating,
  CASE WHEN place_id % 6 <> 0 THEN place_id * 13 % 500 END AS user_ratings_total,
  CASE WHEN place_id % 5 <> 0 AND a0 <> '' THEN place_id * 3 % 21 ELSE 0 END AS parks_count_1km,
  CASE WHEN place_id % 8 <> 0 AND a0 <> '' THEN place_id * 7 % 26 ELSE 0 END AS open_bars_count_500m FROM pl0),
moods AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{m}')" for i, m in enumerate(MOODS))}) t(m, mood)),
cs AS (SELECT mood, place_id, name, (place_id * 31 + m * 17) % 100 / 100.0::DOUBLE AS probability FROM pl, moods WHERE place_id % 4 <> 0),
vi AS (SELECT user_id, event_id, user_id // 60 * 40 + event_id % 40 AS place_id, CAST(date AS VARCHAR) AS visit_date
  FROM ev WHERE event_type = 'purchase'),
hist AS (SELECT user_id, place_id, MAX(visit_date) AS last_visit FROM vi JOIN pl USING (place_id) GROUP BY 1, 2),
homes AS (SELECT user_id, {_ULAT} + CASE WHEN user_id % 10 = 7 THEN 3.0 ELSE 0.0 END AS home_lat, {_ULON} AS home_lon
  FROM (SELECT DISTINCT user_id FROM ev))"""

_MOOD = """CASE WHEN stress > 60 AND sleep_hours < 7 AND temperature < 5 THEN 'cozy_indoor'
  WHEN stress > 60 AND sleep_hours < 7 THEN 'green_nature' WHEN precipitation > 5 THEN 'rainy_retreat'
  WHEN temperature < 5 THEN 'cozy_indoor' WHEN stress < 40 AND sleep_hours > 8 AND net_battery > 0 THEN 'buzz_urban'
  WHEN net_battery < -20 THEN 'cozy_recharge' ELSE 'balanced' END"""
PEOPLE = f"""
last7 AS (SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date DESC) <= 7),
pe0 AS (SELECT user_id, AVG(avg_stress) AS stress, AVG(sleep_hours) AS sleep_hours, AVG(net_battery) AS net_battery,
  AVG(resting_hr) AS resting_hr, COUNT(avg_stress) AS days_used FROM last7 GROUP BY user_id),
pe1 AS (SELECT *, CASE WHEN user_id % 9 <> 0 THEN CAST(user_id * 7 % 35 - 5 AS DOUBLE) ELSE 10.0::DOUBLE END AS temperature,
  CASE WHEN user_id % 9 <> 0 THEN CAST(user_id * 3 % 11 AS DOUBLE) ELSE 0.0::DOUBLE END AS precipitation FROM pe0 JOIN homes USING (user_id)),
prof AS (SELECT * FROM (VALUES {', '.join(f"('{m}', {p}, {b}, {l}, {n}::DOUBLE)" for m, (p, b, l, n) in MOOD_PROFILES.items())})
  t(mood, parks, bars, nightlight, ndvi)),
pe AS (SELECT *, {_MOOD} AS mood FROM pe1)"""


def geo(source: str, name: str) -> str:
    """CTEs that add distance_km (Lambert) to a relation with home_lat, home_lon, lat, lon."""
    f = "(1 / 298.257223563::DOUBLE)"
    return f"""
{name}1 AS (SELECT *, atan((1 - {f}) * tan(radians(home_lat))) AS b1, atan((1 - {f}) * tan(radians(lat))) AS b2,
  radians(home_lon) AS l1, radians(lon) AS l2 FROM {source}),
{name}2 AS (SELECT *, 2 * asin(least(1.0::DOUBLE, sqrt(power(sin((b2 - b1) / 2), 2) + cos(b1) * cos(b2) * power(sin((l2 - l1) / 2), 2)))) AS g,
  (b1 + b2) / 2 AS p, (b2 - b1) / 2 AS q FROM {name}1),
{name} AS (SELECT *, CASE WHEN g = 0 THEN 0.0 WHEN g < radians(175) THEN 6378.137::DOUBLE * (g - {f} / 2 * (
  (g - sin(g)) * power(sin(p) * cos(q) / cos(g / 2), 2) + (g + sin(g)) * power(cos(p) * sin(q) / sin(g / 2), 2)))
  ELSE 6378.137::DOUBLE * g END AS distance_km FROM {name}2)"""


SCORED = f"""
pairs AS (SELECT pe.*, pl.place_id, pl.name, pl.lat, pl.lon FROM pe, pl),
{geo('pairs', 'pg')},
pr AS (SELECT *, CASE WHEN stress > 60 OR precipitation > 5 THEN 10 ELSE 25 END AS radius_km FROM pg),
near AS (SELECT * FROM pr WHERE distance_km <= radius_km),
far AS (SELECT * FROM pr WHERE user_id NOT IN (SELECT user_id FROM near)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY distance_km, place_id) <= 3),
cand AS (SELECT * FROM near UNION ALL SELECT * FROM far),
sc0 AS (SELECT cand.*, coalesce(cs.probability * 100, 0) AS confidence, last_visit,
  CASE WHEN DATE '2024-01-31' - CAST(last_visit AS DATE) BETWEEN 0 AND 3 THEN 30.0::DOUBLE
       WHEN DATE '2024-01-31' - CAST(last_visit AS DATE) BETWEEN 4 AND 7 THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END AS history_penalty
  FROM cand LEFT JOIN cs USING (mood, place_id) LEFT JOIN hist USING (user_id, place_id)),
sc1 AS (SELECT *, (1 - distance_km / nullif(MAX(distance_km) OVER (PARTITION BY user_id), 0)) * 100 AS distance_score FROM sc0),
sc2 AS (SELECT *, 0.6::DOUBLE * confidence + 0.4::DOUBLE * distance_score AS balanced_score FROM sc1),
sc AS (SELECT *, balanced_score * (1 - history_penalty / 100) AS final_score FROM sc2),
best AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC NULLS LAST, name, place_id) AS rank FROM sc
  QUALIFY rank <= 3)"""

ALL = {"base": BASE, "orders": ORDERS, "places": PLACES, "people": PEOPLE, "scored": SCORED}


def add(name: str, body: str, *parts: str, extra: str = "") -> None:
    ctes = [ALL[p] for p in (parts or ("base",))] + ([extra] if extra else [])
    ORACLE[name] = "WITH " + ",".join(ctes) + "\n" + body


def case_of(mapping: dict[str, str], key: str, default: str) -> str:
    quote = lambda s: s.replace("'", "''")
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN '{quote(v)}'" for k, v in mapping.items()) + f" ELSE '{default}' END"


# ------------------------------------------------------------------ scans
_PER_METRIC = "SELECT metric, date, {0} AS documents FROM docs {1} GROUP BY metric, date"
add("scan_raw_documents", """SELECT date, event_id // 65536 AS bundle, COUNT(*) AS elements FROM ev GROUP BY ALL
  UNION ALL SELECT DATE '2023-12-31', 2, 3""")
for _name in ("raw_sink_overwrite", "schema_guard", "incremental_landing"):
    add(_name, _PER_METRIC.format("COUNT(*)", ""))
add("raw_sink_append", _PER_METRIC.format("2 * COUNT(*)", ""))
for _metric in METRICS:
    add(f"scan_metric_{_metric}", f"SELECT DISTINCT user_id, date FROM docs WHERE metric = '{_metric}'")
add("valid_payload", _PER_METRIC.format("COUNT(*)", """WHERE NOT (metric = 'stress' AND EXISTS (SELECT 1 FROM ss0
  WHERE ss0.user_id = docs.user_id AND ss0.date = docs.date AND coalesce(avg_stress, 0) = 0 AND max_stress = 0))"""))
_START = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.0')"
_KIND = "CASE o_orderkey % 4 WHEN 0 THEN 'running' WHEN 1 THEN 'walking' WHEN 2 THEN 'cycling' ELSE 'pilates' END"
_HEADERS = f"""SELECT o_orderkey AS activity_id, CASE WHEN o_orderkey % 5 <> 0 THEN 'Session ' || o_orderkey
  WHEN o_orderkey % 15 <> 0 THEN 'Unnamed' END AS activity_name, CASE WHEN o_orderkey % 21 = 0 THEN NULL WHEN o_orderkey % 7 <> 0 THEN {_KIND} ELSE 'unknown' END AS activity_type, {_START} AS start_time FROM orders"""
ORACLE["scan_activities"] = f"""SELECT o_orderkey AS "activityId", o_totalprice / 10 AS duration,
  CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 7 <> 0 THEN {_KIND} END AS type_key FROM orders"""
ORACLE["activity_headers"] = _HEADERS
ORACLE["latest_activities"] = _HEADERS + """ ORDER BY TRY_CAST(replace(left(start_time, 19), 'T', ' ') AS TIMESTAMP) DESC NULLS LAST,
  activity_id DESC LIMIT 100"""
_SPINE = f"""spine AS (SELECT user_id, CAST(d AS DATE) AS date, metric, metric || '_' || CAST(CAST(d AS DATE) AS VARCHAR) || '.json' AS filename
  FROM (SELECT DISTINCT user_id FROM ev), generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) g(d),
  (VALUES {', '.join(f"('{m}')" for m in METRICS)}) m(metric))"""
add("expected_documents", "SELECT * FROM spine", extra=_SPINE)
add("missing_documents", """SELECT * FROM spine WHERE NOT EXISTS (SELECT 1 FROM docs WHERE docs.user_id = spine.user_id
  AND docs.date = spine.date AND docs.metric = spine.metric)""", extra=_SPINE)
_VISITS = """vis AS (SELECT user_id, 'place ' || (user_id // 60 * 40 + event_id % 40) AS name, CAST(date AS VARCHAR) AS visit_date, event_id
  FROM ev WHERE event_type = 'purchase')"""
add("history_rows", "SELECT DISTINCT user_id, name, visit_date FROM vis", extra=_VISITS)
add("history_upsert", """SELECT user_id, name, visit_date FROM vis WHERE visit_date < '2024-01-16' UNION
  SELECT user_id, name, CASE WHEN event_id % 7 <> 0 THEN visit_date ELSE '2024-01-31' END FROM vis""", extra=_VISITS)
add("history_saved", """SELECT DISTINCT user_id, name, CASE WHEN event_id % 7 <> 0 THEN visit_date ELSE '2024-01-31' END AS visit_date FROM vis""", extra=_VISITS)
add("place_table", f"""SELECT place_id, name, display_name, address, {rnd('lat', 6)} AS lat, {rnd('lon', 6)} AS lon, {rnd('rating', 6)} AS rating,
  user_ratings_total, parks_count_1km, open_bars_count_500m FROM pl""", "base", "places")
_ROWS = {
    "v_steps_daily": "steps_d", "v_body_battery_daily": "bb_d", "v_heart_rate_daily": "hr_d", "v_stress_daily": "ss_d",
    "v_sleep_daily": "sl_d", "v_daily_metrics": "daily", "v_dashboard_daily": "daily", "v_dashboard_trends": "daily",
    "v_dashboard_correlations": "(SELECT * FROM daily WHERE avg_stress IS NOT NULL)",
    "v_data_quality_summary": "(SELECT DISTINCT user_id, strftime(date, '%Y-%m') FROM daily)",
    "v_dashboard_monthly": "(SELECT DISTINCT user_id, strftime(date, '%Y-%m') FROM daily)",
    "v_dashboard_weekly": "(SELECT DISTINCT user_id, strftime(date, '%Y-W%V') FROM daily)",
}
add("view_registry", " UNION ALL ".join(f"SELECT '{v}' AS view_name, COUNT(*) AS row_count FROM {t}" for v, t in _ROWS.items()))
add("cached_view", "SELECT user_id, COUNT(*) AS total_days, COUNT(*) AS week_days FROM daily GROUP BY user_id")

# ------------------------------------------------------------------ JSON
add("json_scalar", """SELECT user_id, date, CAST(sleep_body_battery_change AS VARCHAR) AS change_text, CAST(NULL AS VARCHAR) AS nested_text,
  CAST(NULL AS VARCHAR) AS absent_text FROM sl_d""")
add("json_root_index", "SELECT user_id, date, CAST(charged AS VARCHAR) AS charged_text, CAST(NULL AS VARCHAR) AS second_text FROM bb_d")
add("json_nested_path", "SELECT user_id, date, CAST(s AS VARCHAR) AS seconds_text FROM sl0")
add("json_array", "SELECT user_id, date, COUNT(*) AS elements FROM iv GROUP BY 1, 2")
add("unnest_intervals", "SELECT user_id, date, steps, activity_level FROM iv")
ORACLE["json_reply_rows"] = """SELECT p_partkey, p_name AS title, p_brand AS artist, p_type AS reason FROM part WHERE p_partkey % 5 < 3
UNION ALL SELECT p_partkey, p_type, p_name, 'second' FROM part WHERE p_partkey % 5 < 3
UNION ALL SELECT p_partkey, 'Parsing Error', 'N/A', 'Could not parse response' FROM part WHERE p_partkey % 5 = 3
UNION ALL SELECT p_partkey, 'Error', 'N/A', 'No response' FROM part WHERE p_partkey % 5 = 4"""
_PART_MOOD = "CASE p_size % 7 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MOODS)) + " ELSE 'unheard_of' END"
ORACLE["map_lookup_default"] = f"""SELECT p_partkey, mood, {case_of(MOOD_TITLES, 'mood', 'Standard')} AS title,
  {case_of(MOOD_REASONS, 'mood', 'General recommendation')} AS reason, {case_of(MOOD_PROMPTS, 'mood', 'in a neutral mood')} AS prompt_words
  FROM (SELECT p_partkey, {_PART_MOOD} AS mood FROM part)"""
add("map_explode_latest", "SELECT user_id, name, MAX(visit_date) AS last_visit FROM vis GROUP BY 1, 2", extra=_VISITS)

# ------------------------------------------------------------------ text
add("like_prefix", "SELECT metric, COUNT(*) AS user_days FROM (SELECT DISTINCT metric, user_id, date FROM docs) GROUP BY metric")
add("regex_date", """SELECT DISTINCT user_id, metric || '_' || CAST(date AS VARCHAR) || '.json' AS filename, CAST(date AS VARCHAR) AS date_text,
  CAST(NULL AS VARCHAR) AS none_text FROM docs""")
ORACLE["street_name"] = """SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 5 THEN '' ELSE s_name || t END AS address,
  CASE WHEN s_suppkey % 6 = 5 THEN 'Location' || (s_suppkey + 1) WHEN s_suppkey % 4 = 1 THEN s_name || ' 12a' ELSE s_name END AS street
  FROM (SELECT *, CASE s_suppkey % 4 WHEN 0 THEN ' 12A, City' WHEN 1 THEN ' 12a' WHEN 2 THEN ' 7' ELSE ', City' END AS t FROM supplier)"""
ORACLE["label_prettify"] = f"SELECT p_partkey, replace({_PART_MOOD}, '_', ' ') AS label FROM part"
ORACLE["number_format"] = """SELECT event_id, printf('%.0f', value) AS whole, printf('%.1f', value) AS one, printf('%.2f', value / 8) AS two,
  printf('%.1f', floor(value) / 4 - 3) AS quarters, format('{:,}', CAST(printf('%.0f', value * 1000) AS BIGINT)) AS grouped,
  printf('%+.0f', floor(value) / 2) AS signed FROM events"""
ORACLE["sentence_case"] = """SELECT p_partkey, upper(substr(t, 1, 1)) || lower(substr(t, 2)) AS sentence
  FROM (SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS t FROM part)"""
_WEATHER = """CASE WHEN temperature < 5 THEN 'cold' WHEN temperature > 20 THEN 'warm' ELSE 'mild' END || ' weather (' || printf('%.1f', temperature)
  || '°C)' || CASE WHEN precipitation > 5 THEN ' with rain (' || printf('%.1f', precipitation) || 'mm)' ELSE '' END"""
add("weather_text", f"SELECT user_id, {_WEATHER} AS weather_text FROM pe", "base", "places", "people")
_PARTS = PROMPT_TEMPLATE.replace("'", "''").split("%s")
_FILL = [case_of(MOOD_PROMPTS, "mood", "in a neutral mood"), "coalesce(printf('%.1f', stress), 'nan')",
         "coalesce(printf('%.1f', sleep_hours), 'nan')", _WEATHER]
add("prompt_text", "SELECT user_id, " + " || ".join(f"'{p}' || {f}" for p, f in zip(_PARTS, _FILL)) + f" || '{_PARTS[4]}' AS prompt FROM pe",
    "base", "places", "people")
add("relative_day_label", """SELECT event_id, CASE DATE '2024-01-30' - date WHEN 0 THEN 'Today''s data' WHEN 1 THEN 'Yesterday''s data'
  ELSE (DATE '2024-01-30' - date) || ' days old' END AS label FROM ev""")


def reason(parks: str, bars: str) -> str:
    """SQL text of the explanation; expects the columns of pe joined with prof."""
    body = """nullif(concat_ws(' + ', CASE WHEN stress > 60 THEN 'high stress level (' || printf('%.0f', stress) || '/100)'
      WHEN stress < 40 THEN 'low stress (' || printf('%.0f', stress) || '/100)' END,
      CASE WHEN sleep_hours < 7 THEN 'limited sleep (' || printf('%.1f', sleep_hours) || 'hr)'
      WHEN sleep_hours > 8 THEN 'well-rested (' || printf('%.1f', sleep_hours) || 'hr)' END,
      CASE WHEN net_battery < -15 THEN 'drained energy (battery: ' || printf('%.0f', net_battery) || ')'
      WHEN net_battery > 10 THEN 'energized (battery: +' || printf('%.0f', net_battery) || ')' END), '')"""
    sky = """nullif(concat_ws(' & ', CASE WHEN temperature < 5 THEN 'cold (' || printf('%.1f', temperature) || '°C)'
      WHEN temperature > 20 THEN 'warm (' || printf('%.1f', temperature) || '°C)' END,
      CASE WHEN precipitation > 5 THEN 'rainy (' || printf('%.1f', precipitation) || 'mm)' END), '')"""
    opening = f"""concat_ws('. ', 'Your ' || {body}, 'today''s ' || {sky} || ' weather', 'suggest a "' || {case_of(MOOD_TITLES, 'mood', 'Standard')}
      || '" mood (' || {case_of(MOOD_REASONS, 'mood', 'General recommendation')} || ')')"""
    first = f"upper(substr({opening}, 1, 1)) || lower(substr({opening}, 2))"
    return f"""{first} || CASE WHEN {parks} IS NOT NULL AND {bars} IS NOT NULL THEN '. Location has: ' || {parks} || ' parks within 1km, '
      || {bars} || ' bars nearby. Matching conditions: NDVI: ' || printf('%.2f', ndvi) || ', nightlight: ' || nightlight || '.'
      ELSE '. This café matches your preferred environment.' END"""


add("reason_text", f"""SELECT user_id, {reason('p', 'b')} AS reason FROM (SELECT *, CASE WHEN user_id % 5 <> 0 THEN user_id % 22 END AS p,
  user_id % 26 AS b FROM pe JOIN prof USING (mood))""", "base", "places", "people")

# ------------------------------------------------------------------ dates
_D = "CAST(o_orderdate AS DATE)"
for _name, _sql in {
    "month_label": f"strftime({_D}, '%Y-%m')", "weekday_name": f"strftime({_D}, '%A')", "weekday_num": f"dayofweek({_D}) + 1",
    "week_start": f"CAST(date_trunc('week', {_D}) AS DATE)", "week_label": f"strftime({_D}, '%Y-W') || lpad(CAST(weekofyear({_D}) AS VARCHAR), 2, '0')",
    "month_start": f"CAST(date_trunc('month', {_D}) AS DATE)", "month_name": f"strftime({_D}, '%B %Y')",
    "long_date": f"strftime({_D}, '%B %d, %Y')", "days_ago": f"DATE '2024-01-31' - {_D}",
}.items():
    ORACLE[_name] = f"SELECT o_orderkey, {_sql} AS {_name} FROM orders"
ORACLE["parse_date"] = f"SELECT o_orderkey, {_D} AS day, CASE WHEN o_orderkey % 3 <> 0 THEN {_D} END AS checked_day FROM orders"
add("date_sequence", "SELECT user_id, CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE) AS date FROM ev GROUP BY user_id")

# ------------------------------------------------------------------ math and conditions
ORACLE["cast_numeric"] = """SELECT o_orderkey, TRY_CAST(o_orderpriority AS BIGINT) AS bad, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS good,
  o_totalprice AS price FROM orders"""
_DAILY = {
    "stress_level_num": "CAST(CASE WHEN avg_stress <= 25 THEN 1 WHEN avg_stress <= 50 THEN 2 WHEN avg_stress <= 75 THEN 3 ELSE 4 END AS BIGINT) AS stress_level_num",
    "recovery_status": """CASE WHEN net_battery > 20 THEN 'Great Recovery' WHEN net_battery > 0 THEN 'Good Recovery'
      WHEN net_battery > -20 THEN 'Slight Drain' ELSE 'Heavy Drain' END AS recovery_status""",
    "activity_level": """CASE WHEN steps IS NULL THEN 'No Data' WHEN steps < 5000 THEN 'Sedentary' WHEN steps < 7500 THEN 'Low Active'
      WHEN steps < 10000 THEN 'Moderate' ELSE 'Active' END AS activity_level""",
    "presence_flag": "has_steps_data", "binary_label": "CAST(avg_stress > 50 AS INTEGER) AS high_stress",
    "net_difference": "net_battery",
    "round_n": f"{rnd('sleep_hours', 1)} AS one, {rnd('sleep_hours', 2)} AS two, {rnd('net_battery / 2', 0)} AS whole",
    "coalesce_key": "coalesce(steps, charged, resting_hr, avg_stress) AS any_value",
    "axis_scaling": f"-drained AS drained_down, {rnd('sleep_hours * 5', 6)} AS sleep_scaled",
}
for _name, _sql in _DAILY.items():
    add(_name, f"SELECT user_id, date, {_sql} FROM daily")
add("zero_to_null", "SELECT user_id, date, steps FROM steps_d")
add("steps_quality", "SELECT user_id, date, data_quality FROM steps_d")
add("seconds_to_hours", f"SELECT user_id, date, {rnd('sleep_hours', 6)} AS sleep_hours, {rnd('awake_hours', 6)} AS awake_hours FROM sl_d")
add("stress_category", "SELECT user_id, date, stress_category FROM ss_d")
_LOGIT = """lg AS (SELECT date, -4.0::DOUBLE + resting_hr * 0.08::DOUBLE - charged * 0.03::DOUBLE + drained * 0.02::DOUBLE AS x FROM od
  WHERE resting_hr IS NOT NULL)"""
for _name in ("sigmoid_logit", "sort_logit"):
    add(_name, f"SELECT date, {rnd('x', 6)} AS logit, {rnd('1 / (1 + exp(-x))', 6)} AS probability FROM lg", "orders", extra=_LOGIT)
add("sigmoid_curve", f"""SELECT point, {rnd('x', 6)} AS logit, {rnd('1 / (1 + exp(-x))', 6)} AS probability FROM (SELECT CAST(i AS BIGINT) AS point,
  (SELECT MIN(x) FROM lg) + (SELECT MAX(x) - MIN(x) FROM lg) * i / 499 AS x FROM range(500) r(i))""", "orders", extra=_LOGIT)
_POINTS = "vp AS (SELECT vi.event_id, place_id, home_lat, home_lon, lat, lon FROM vi JOIN pl USING (place_id) JOIN homes0 USING (user_id))"
_HOMES0 = f"homes0 AS (SELECT user_id, {_ULAT} AS home_lat, {_ULON} AS home_lon FROM (SELECT DISTINCT user_id FROM ev))"
_VG = ",".join([_HOMES0, _POINTS, geo("vp", "vg")])
add("geo_distance_km", f"SELECT event_id, place_id, {rnd('distance_km', 5)} AS distance_km FROM vg", "base", "places", extra=_VG)
add("radius_filter", f"SELECT event_id, {rnd('distance_km', 5)} AS distance_km FROM vg WHERE distance_km <= 10", "base", "places", extra=_VG)

# ------------------------------------------------------------------ projections and filters
_H6 = ", ".join(f"{rnd(c, 6)} AS {c}" for c in ("sleep_hours", "deep_sleep_hours", "rem_sleep_hours"))
_DASH = f"""SELECT user_id, date, strftime(date, '%Y-%m') AS month, strftime(date, '%A') AS day_of_week, dayofweek(date) + 1 AS day_num,
  avg_stress, max_stress, stress_category, {_DAILY['stress_level_num']}, charged, drained, net_battery, {_DAILY['recovery_status']},
  resting_hr, avg_resting_hr_7d, {rnd('sleep_hours', 1)} AS sleep_hours, {rnd('deep_sleep_hours', 1)} AS deep_sleep_hours,
  {rnd('rem_sleep_hours', 1)} AS rem_sleep_hours, sleep_body_battery_change, avg_overnight_hrv, steps, has_steps_data,
  {_DAILY['activity_level']} FROM daily"""
add("dashboard_daily", _DASH)
add("ordered_view_read", _DASH + " ORDER BY date NULLS FIRST, user_id NULLS FIRST")
add("rename", """SELECT user_id, date, avg_stress AS "avgStressLevel", max_stress AS "maxStressLevel", resting_hr AS "restingHeartRate",
  sleep_body_battery_change AS "bodyBatteryChange" FROM daily""")
add("not_null_filter", "SELECT user_id, date, avg_stress FROM daily WHERE avg_stress IS NOT NULL")
add("date_range_filter", "SELECT user_id, date, steps FROM daily WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12'")
add("dropna_subset", "SELECT user_id, date, net_battery, avg_stress FROM daily WHERE net_battery IS NOT NULL AND avg_stress IS NOT NULL")
add("numeric_columns", f"""SELECT date, steps, charged, drained, net_battery, resting_hr, max_hr, min_hr, avg_resting_hr_7d, max_stress,
  {_H6}, sleep_body_battery_change, avg_overnight_hrv FROM od""", "orders")
add("existing_columns", "SELECT user_id, date, resting_hr, charged, drained FROM daily")
add("drop_sparse_columns", "SELECT user_id, date, has_steps_data FROM daily")
add("min_rows_guard", "SELECT user_id, date FROM daily WHERE user_id IN (SELECT user_id FROM daily GROUP BY 1 HAVING COUNT(*) > 20)")
add("min_rows_guard_global", "SELECT date, avg_stress FROM od WHERE (SELECT COUNT(*) FROM od) > 20", "orders")
add("scatter_projection", " UNION ALL ".join(
    f"SELECT user_id, date, avg_stress AS \"avgStressLevel\", '{n}' AS feature, CAST({c} AS DOUBLE) AS x FROM daily"
    for n, c in (("steps", "steps"), ("bodyBatteryChange", "sleep_body_battery_change"), ("restingHeartRate", "resting_hr"), ("maxStressLevel", "max_stress"))))

# ------------------------------------------------------------------ joins
_WIDE = f"""SELECT user_id, date, steps, steps_quality, charged, drained, net_battery, resting_hr, max_hr, min_hr, avg_resting_hr_7d, avg_stress,
  max_stress, stress_category, {_H6}, sleep_body_battery_change, avg_overnight_hrv, has_steps_data FROM daily"""
for _name in ("daily_metrics", "daily_metrics_chain", "daily_metrics_sides"):
    add(_name, _WIDE)
add("daily_metrics_repeated", _WIDE.replace("FROM daily", "FROM daily_r"), extra="""
bb_r AS (SELECT * FROM bb_d UNION ALL SELECT * FROM bb_d WHERE user_id % 3 = 0),
sl_r AS (SELECT * FROM sl_d UNION ALL SELECT * FROM sl_d WHERE user_id % 3 = 0),
ss_r AS (SELECT * FROM ss_d UNION ALL SELECT * FROM ss_d WHERE user_id % 3 = 1),
daily_r AS (SELECT *, data_quality AS steps_quality, steps IS NOT NULL AS has_steps_data
  FROM steps_d FULL JOIN bb_r USING (user_id, date) FULL JOIN hr_d USING (user_id, date)
  FULL JOIN ss_r USING (user_id, date) FULL JOIN sl_r USING (user_id, date))""")
ORACLE["daily_metrics_repeated_sides"] = ORACLE["daily_metrics_repeated"]
add("unnest_cross", "SELECT user_id, date, COUNT(*) AS interval_count FROM iv GROUP BY 1, 2")
add("lookup_first_default", "SELECT place_id, address, parks_count_1km FROM pl", "base", "places")
add("score_lookup", f"""SELECT pl.place_id, moods.mood, {rnd('coalesce(probability * 100, 0)', 6)} AS confidence FROM pl CROSS JOIN moods
  LEFT JOIN cs ON cs.place_id = pl.place_id AND cs.mood = moods.mood""", "base", "places")
add("history_join", """SELECT user_id, place_id, last_visit, CASE WHEN DATE '2024-01-31' - CAST(last_visit AS DATE) BETWEEN 0 AND 3 THEN 30.0::DOUBLE
  WHEN DATE '2024-01-31' - CAST(last_visit AS DATE) BETWEEN 4 AND 7 THEN 15.0::DOUBLE ELSE 0.0::DOUBLE END AS history_penalty
  FROM (SELECT DISTINCT user_id, place_id + event_id % 2 AS place_id FROM vi) JOIN pl USING (place_id) LEFT JOIN hist USING (user_id, place_id)""",
    "base", "places")
_HG = "hp AS (SELECT homes.*, place_id, lat, lon FROM homes, pl)," + geo("hp", "hg")
add("radius_join", f"SELECT user_id, place_id, {rnd('distance_km', 5)} AS distance_km FROM hg WHERE distance_km <= 10", "base", "places", extra=_HG)
add("radius_fallback", f"""SELECT user_id, place_id, {rnd('distance_km', 4)} AS distance_km FROM hg WHERE distance_km <= 4 UNION ALL
  SELECT user_id, place_id, {rnd('distance_km', 4)} FROM (SELECT * FROM hg WHERE user_id NOT IN (SELECT user_id FROM hg WHERE distance_km <= 4)
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY distance_km, place_id) <= 3)""", "base", "places", extra=_HG)
add("radius_or_nearest_single", f"""SELECT place_id, {rnd('distance_km', 4)} AS distance_km FROM hg
  QUALIFY distance_km <= 400 OR (MIN(distance_km) OVER () > 400 AND row_number() OVER (ORDER BY distance_km, place_id) <= 3)""",
    "base", "places", extra="hm AS (SELECT MIN(home_lat) AS home_lat, MIN(home_lon) AS home_lon FROM homes), hp AS (SELECT hm.*, place_id, lat, lon FROM hm, pl),"
    + geo("hp", "hg"))
add("nsmallest", f"""SELECT user_id, place_id, {rnd('distance_km', 4)} AS distance_km FROM (SELECT * FROM hg
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY distance_km, place_id) <= 5)""", "base", "places", extra=_HG)
add("spine_cross", f"""SELECT CAST(d AS DATE) AS date, metric FROM (SELECT unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS d FROM ev),
  (VALUES {', '.join(f"('{m}')" for m in METRICS)}) m(metric)""")
add("anti_existing", "SELECT DISTINCT user_id, date FROM ev EXCEPT SELECT user_id, date FROM ss_d")
ORACLE["profile_join"] = f"""WITH prof AS (SELECT * FROM (VALUES {', '.join(f"('{m}', {p}, {b}, {l}, {n}::DOUBLE)" for m, (p, b, l, n) in MOOD_PROFILES.items())})
  t(mood, parks, bars, nightlight, ndvi)) SELECT mood, p_partkey, parks::BIGINT AS parks, bars::BIGINT AS bars, nightlight::BIGINT AS nightlight, ndvi
  FROM (SELECT p_partkey, {_PART_MOOD} AS mood FROM part) LEFT JOIN prof USING (mood)"""

# ------------------------------------------------------------------ aggregations
add("steps_daily", "SELECT user_id, date, steps, steps_raw, max_activity_level, data_quality FROM steps_d")
add("body_battery_daily", "SELECT * FROM bb_d")
add("heart_rate_daily", "SELECT * FROM hr_d")
add("stress_daily", "SELECT user_id, date, avg_stress, max_stress, stress_category FROM ss_d")
add("sleep_daily", f"""SELECT user_id, date, {_H6}, {rnd('light_sleep_hours', 6)} AS light_sleep_hours, {rnd('awake_hours', 6)} AS awake_hours,
  sleep_body_battery_change, sleep_resting_hr, avg_overnight_hrv FROM sl_d""")


def share(condition: str) -> str:
    return rnd(f"CAST(COUNT(*) FILTER (WHERE {condition}) AS DOUBLE) / COUNT(*) * 100", 1)


def quality(table: str, key: str) -> str:
    return f"""SELECT {key} strftime(date, '%Y-%m') AS month, COUNT(*) AS total_days, COUNT(*) FILTER (WHERE has_steps_data) AS days_with_steps,
  COUNT(*) FILTER (WHERE NOT has_steps_data) AS days_without_steps, {share('has_steps_data')} AS steps_coverage_pct,
  {rnd('AVG(steps)', 0)} AS avg_steps_when_available, {rnd('AVG(avg_stress)', 1)} AS avg_stress FROM {table} GROUP BY ALL"""


def weekly(table: str, key: str) -> str:
    return f"""SELECT {key} CAST(date_trunc('week', date) AS DATE) AS week_start,
  strftime(date, '%Y-W') || lpad(CAST(weekofyear(date) AS VARCHAR), 2, '0') AS week_label, COUNT(*) AS days_in_week,
  {rnd('AVG(avg_stress)', 1)} AS avg_stress, MAX(max_stress) AS max_stress, COUNT(*) FILTER (WHERE avg_stress > 50) AS high_stress_days,
  {rnd('AVG(charged)', 1)} AS avg_charged, {rnd('AVG(drained)', 1)} AS avg_drained, {rnd('AVG(net_battery)', 1)} AS avg_net_battery,
  {rnd('AVG(resting_hr)', 0)} AS avg_resting_hr, {rnd('AVG(sleep_hours)', 1)} AS avg_sleep_hours,
  {rnd('AVG(deep_sleep_hours)', 1)} AS avg_deep_sleep, {rnd('AVG(steps)', 0)} AS avg_steps, COUNT(steps) AS days_with_steps
  FROM {table} GROUP BY ALL"""


def monthly(table: str, key: str) -> str:
    return f"""SELECT {key} CAST(date_trunc('month', date) AS DATE) AS month_start, strftime(date, '%Y-%m') AS month_label,
  strftime(date, '%B %Y') AS month_name, COUNT(*) AS days_in_month, {rnd('AVG(avg_stress)', 1)} AS avg_stress,
  {rnd('STDDEV_SAMP(avg_stress)', 1)} AS stress_stddev, MAX(max_stress) AS max_stress_peak,
  COUNT(*) FILTER (WHERE avg_stress > 50) AS high_stress_days, {share('avg_stress > 50')} AS high_stress_pct,
  {rnd('AVG(charged)', 1)} AS avg_charged, {rnd('AVG(net_battery)', 1)} AS avg_net_battery, {rnd('AVG(resting_hr)', 0)} AS avg_resting_hr,
  MIN(resting_hr) AS min_resting_hr, MAX(resting_hr) AS max_resting_hr, {rnd('AVG(sleep_hours)', 1)} AS avg_sleep_hours,
  {rnd('AVG(deep_sleep_hours)', 1)} AS avg_deep_sleep, COUNT(*) FILTER (WHERE sleep_hours < 6) AS poor_sleep_days,
  {rnd('AVG(steps)', 0)} AS avg_steps, COUNT(steps) AS days_with_steps, {share('steps IS NOT NULL')} AS steps_coverage_pct
  FROM {table} GROUP BY ALL"""


for _name, _build in (("data_quality_summary", quality), ("dashboard_weekly", weekly), ("dashboard_monthly", monthly)):
    add(_name, _build("daily", "user_id,"))
add("data_quality_orders", quality("od", ""), "orders")
add("order_by_key", quality("od", "") + " ORDER BY month NULLS FIRST", "orders")
add("dashboard_weekly_orders", weekly("od", ""), "orders")
add("dashboard_monthly_orders", monthly("od", ""), "orders")
add("count_if", """SELECT user_id, COUNT(*) FILTER (WHERE avg_stress > 50) AS high_days, COUNT(*) FILTER (WHERE steps IS NOT NULL) AS step_days
  FROM daily GROUP BY 1""")
add("conditional_avg", f"SELECT user_id, {rnd('AVG(CASE WHEN has_steps_data THEN steps END)', 6)} AS avg_steps FROM daily GROUP BY 1")
add("ratio_pct", f"SELECT user_id, {share('has_steps_data')} AS coverage_pct FROM daily GROUP BY 1")
add("category_distribution", "SELECT stress_category, COUNT(*) AS days FROM daily WHERE stress_category IS NOT NULL GROUP BY 1")
add("flag_distribution", "SELECT has_steps_data, COUNT(*) AS days FROM daily GROUP BY 1")
add("table_extent", "SELECT COUNT(*) AS days, MIN(date) AS first_day, MAX(date) AS last_day FROM daily")
add("mean_std", " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", {rnd(f'AVG({c})', 6)} AS mean, {rnd(f'STDDEV_SAMP({c})', 6)} AS std FROM daily"
    for n, c in (("avgStressLevel", "avg_stress"), ("restingHeartRate", "resting_hr"), ("steps", "steps"), ("bodyBatteryChange", "sleep_body_battery_change"))))
add("missing_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, COUNT(*) - COUNT({c}) AS missing, {share(f'{c} IS NULL')} AS missing_pct, COUNT({c}) AS non_null FROM daily"
    for c, t in (("steps", "bigint"), ("charged", "bigint"), ("avg_stress", "bigint"), ("sleep_hours", "double"), ("stress_category", "string"), ("has_steps_data", "boolean"))))
add("sparse_profile", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'bigint' AS dtype, COUNT(*) - COUNT({c}) AS missing, {share(f'{c} IS NULL')} AS missing_pct, COUNT({c}) AS non_null FROM daily"
    for c in ("steps", "charged", "avg_stress")) + ") WHERE missing > non_null")
_MED = "coalesce(CAST({0} AS DOUBLE), (SELECT median(CAST({0} AS DOUBLE)) FROM od))"
add("median_fill", f"""SELECT date, {_MED.format('avg_stress')} AS avg_stress, {_MED.format('resting_hr')} AS resting_hr,
  {rnd(_MED.format('sleep_hours'), 6)} AS sleep_hours, {_MED.format('steps')} AS steps FROM od""", "orders")
_MEDU = "coalesce(CAST({0} AS DOUBLE), median(CAST({0} AS DOUBLE)) OVER (PARTITION BY user_id))"
add("median_fill_users", f"""SELECT user_id, date, {rnd(_MEDU.format('avg_stress'), 6)} AS avg_stress, {rnd(_MEDU.format('sleep_hours'), 6)} AS sleep_hours
  FROM daily""")
ORACLE["exact_medians"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rnd(f'median(CAST({c} AS DOUBLE))', 6)} AS median FROM lineitem" for c in ("l_extendedprice", "l_quantity", "l_discount"))


def corr(table: str, y: str, xs) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {rnd(f'corr({y}, {x})', 6)} AS corr, CASE WHEN corr({y}, {x}) > 0 THEN 'increases' ELSE 'decreases' END AS direction FROM {table}"
        for x in xs)


add("pearson_corr", corr("od", "avg_stress", ("resting_hr", "charged", "sleep_hours")), "orders")
ORACLE["pearson_corr_lineitem"] = corr("lineitem", "l_extendedprice", ("l_quantity", "l_discount"))
add("ols_trend", " UNION ALL ".join(
    f"""SELECT '{x}' AS x, 'avg_stress' AS y, {big(f'regr_count(avg_stress, {x})')} AS n, {rnd(f'regr_slope(avg_stress, {x})', 6)} AS slope,
    {rnd(f'regr_intercept(avg_stress, {x})', 6)} AS intercept, {rnd(f'regr_r2(avg_stress, {x})', 6)} AS r2 FROM od""" for x in ("sleep_hours", "net_battery")), "orders")
add("kpi_vs_mean", f"""SELECT user_id, arg_max(avg_stress, date) FILTER (WHERE avg_stress IS NOT NULL) AS latest, {rnd('AVG(avg_stress)', 6)} AS mean,
  {rnd('arg_max(avg_stress, date) FILTER (WHERE avg_stress IS NOT NULL) - AVG(avg_stress)', 6)} AS delta FROM daily GROUP BY user_id""")
_LATEST = "lt AS (SELECT * FROM daily WHERE avg_stress IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date DESC) = 1)"
_CARDS = _LATEST + """,
av AS (SELECT user_id, AVG(avg_stress) AS mean FROM daily GROUP BY user_id),
cd AS (SELECT av.user_id, mean, lt.* EXCLUDE (user_id), strftime(date, '%B %d, %Y') || ' (' || CASE DATE '2024-01-31' - date
  WHEN 0 THEN 'Today''s data' WHEN 1 THEN 'Yesterday''s data' ELSE (DATE '2024-01-31' - date) || ' days old' END || ')' AS heading
  FROM av LEFT JOIN lt ON av.user_id = lt.user_id)"""
add("kpi_cards", """SELECT user_id, heading, 'Avg Stress' AS kpi, coalesce(CAST(avg_stress AS VARCHAR), 'N/A') AS value,
  printf('%.1f', avg_stress - mean) || ' vs avg' AS note FROM cd
UNION ALL SELECT user_id, heading, 'Resting HR', coalesce(resting_hr || ' bpm', 'N/A'), NULL FROM cd
UNION ALL SELECT user_id, heading, 'Sleep', coalesce(printf('%.1f', sleep_hours) || ' hrs', 'N/A'), NULL FROM cd
UNION ALL SELECT user_id, heading, 'Net Battery', coalesce(CAST(net_battery AS VARCHAR), 'N/A'),
  CASE WHEN net_battery > 0 THEN 'Recovery' WHEN net_battery IS NOT NULL THEN 'Drain' END FROM cd
UNION ALL SELECT user_id, heading, 'Steps', coalesce(format('{:,}', steps), 'No data'), NULL FROM cd""", extra=_CARDS)
add("latest_complete_row", "SELECT user_id, date, avg_stress, steps, charged, resting_hr FROM lt", extra=_LATEST)
add("recent_means", f"""SELECT user_id, {rnd('stress', 6)} AS stress, {rnd('sleep_hours', 6)} AS sleep_hours, {rnd('net_battery', 6)} AS net_battery,
  {rnd('resting_hr', 6)} AS resting_hr, days_used FROM pe0""", "base", "places", "people")
add("histogram20", f"""SELECT CAST(i AS INTEGER) AS bin, {rnd('lo + i * w', 6)} AS low, {rnd('lo + (i + 1) * w', 6)} AS high, coalesce(days, 0) AS days
  FROM range(20) r(i) CROSS JOIN b LEFT JOIN (SELECT least(CAST(floor((avg_stress - lo) / w) AS BIGINT), 19) AS i, COUNT(*) AS days
  FROM daily, b WHERE avg_stress IS NOT NULL GROUP BY 1) USING (i)""",
    extra="b AS (SELECT MIN(avg_stress)::DOUBLE AS lo, (MAX(avg_stress) - MIN(avg_stress))::DOUBLE / 20 AS w FROM daily)")
add("positive_rate", f"""SELECT {big('SUM(l)')} AS positives, COUNT(*) AS rows, {rnd('AVG(l)', 6)} AS rate
  FROM (SELECT CASE WHEN avg_stress > 50 THEN 1 ELSE 0 END AS l FROM od)""", "orders")
ORACLE["regression_metrics"] = f"""SELECT {rnd('1 - SUM(power(y - p, 2)) / SUM(power(y - m, 2))', 6)} AS r2, {rnd('sqrt(AVG(power(y - p, 2)))', 3)} AS rmse,
  {rnd('AVG(abs(y - p))', 3)} AS mae FROM (SELECT l_extendedprice AS y, l_quantity * 1500.0::DOUBLE AS p, AVG(l_extendedprice) OVER () AS m FROM lineitem)"""
ORACLE["accuracy"] = f"SELECT {rnd('AVG(CASE WHEN (l_quantity > 25) = (l_extendedprice > 40000) THEN 1.0 ELSE 0.0 END)', 6)} AS accuracy FROM lineitem"

# ------------------------------------------------------------------ windows
_W = "OVER (PARTITION BY user_id ORDER BY date)"
_LEADS = "LEAD(avg_stress) {0} AS next_day_stress, LEAD(resting_hr) {0} AS next_day_resting_hr"


def lags(over: str) -> str:
    return f"{rnd(f'LAG(sleep_hours) {over}', 6)} AS prev_day_sleep, LAG(steps) {over} AS prev_day_steps"


def rolling(partition: str, order: str = "date") -> str:
    over = f"OVER ({partition} ORDER BY {order} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
    return ", ".join(f"{rnd(f'AVG({c}) {over}', n)} AS {name}" for c, name, n in (
        ("avg_stress", "stress_7d_avg", 1), ("resting_hr", "resting_hr_7d_avg", 0), ("sleep_hours", "sleep_7d_avg", 1), ("net_battery", "net_battery_7d_avg", 1)))


def change(over: str) -> str:
    return f"avg_stress - LAG(avg_stress, 7) {over} AS stress_wow_change, resting_hr - LAG(resting_hr, 7) {over} AS resting_hr_wow_change"


add("next_day_lead", f"SELECT user_id, date, {_LEADS.format(_W)} FROM daily")
add("prev_day_lag", f"SELECT user_id, date, {lags(_W)} FROM daily")
add("rolling_7row_avg", f"SELECT user_id, date, {rolling('PARTITION BY user_id')} FROM daily")
add("wow_change", f"SELECT user_id, date, {change(_W)} FROM daily")
_CORR = """date, avg_stress, resting_hr, {1} AS sleep_hours, {2} AS deep_sleep_hours, charged AS body_battery_charged, net_battery, steps, avg_overnight_hrv,
  {0} WHERE avg_stress IS NOT NULL"""
_TWO = (rnd("sleep_hours", 6), rnd("deep_sleep_hours", 6))
add("dashboard_correlations", "SELECT user_id, " + _CORR.format(_LEADS.format(_W) + ", " + lags(_W) + " FROM daily", *_TWO))
_N = "OVER (ORDER BY date)"
add("dashboard_correlations_orders", "SELECT " + _CORR.format(_LEADS.format(_N) + ", " + lags(_N) + " FROM od", *_TWO), "orders")
_TREND = f"date, avg_stress, resting_hr, {rnd('sleep_hours', 6)} AS sleep_hours, net_battery, steps, "
for _name in ("dashboard_trends", "dashboard_trends_split"):
    add(_name, f"SELECT user_id, {_TREND} {rolling('PARTITION BY user_id')}, {change(_W)} FROM daily")
add("dashboard_trends_orders", f"SELECT {_TREND} {rolling('')}, {change(_N)} FROM od", "orders")
add("long_series_trends", f"SELECT date, id, avg_stress, resting_hr, sleep_hours, net_battery, {rolling('', 'date, id')}, {change('OVER (ORDER BY date, id)')} FROM os", "orders")
add("long_series_position", "SELECT date, id, row_number() OVER (ORDER BY date, id) - 1 AS position, COUNT(*) OVER () AS total FROM os", "orders")
add("last_n_rows", "SELECT user_id, date, steps FROM daily QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date DESC) <= 7")
add("last_n_rows_orders", "SELECT date, charged, drained FROM od ORDER BY date DESC LIMIT 30", "orders")
ORACLE["cumulative_ratio"] = f"""SELECT event_type, n, {rnd('n / SUM(n) OVER ()', 6)} AS ratio, {rnd('SUM(n) OVER (ORDER BY event_type) / SUM(n) OVER ()', 6)} AS cumulative
  FROM (SELECT event_type, COUNT(*)::DOUBLE AS nd, COUNT(*) AS n FROM events GROUP BY 1)"""
ORACLE["max_in_group"] = "SELECT l_orderkey, l_linenumber, l_extendedprice, MAX(l_extendedprice) OVER (PARTITION BY l_orderkey) AS group_max FROM lineitem"
add("chronological_split", """SELECT user_id, date, CASE WHEN row_number() OVER (ORDER BY date, user_id) > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split
  FROM daily, (SELECT COUNT(*) AS n FROM daily)""")
add("chronological_split_users", """SELECT user_id, date, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY date) >
  COUNT(*) OVER (PARTITION BY user_id) - ceil(COUNT(*) OVER (PARTITION BY user_id) * 0.2) THEN 'test' ELSE 'train' END AS split FROM daily""")
add("stratified_split", """SELECT label, split, rows FROM (SELECT CAST(avg_stress > 50 AS INTEGER) AS label, CAST(ceil(COUNT(*) * 0.2) AS BIGINT) AS t, COUNT(*) AS n
  FROM daily WHERE avg_stress IS NOT NULL GROUP BY 1), LATERAL (SELECT 'test' AS split, t AS rows UNION ALL SELECT 'train', n - t)""")

# ------------------------------------------------------------------ feature preparation
_AF = "median(CAST({0} AS DOUBLE))"
_RATE = "(SELECT COUNT(*) - 2 * COUNT({0}) FROM od) <= 0"
_AFC = {
    "charged": "charged", "drained": "drained", "net_battery": "net_battery", "restingHeartRate": "resting_hr",
    "avg_resting_hr_7d": "avg_resting_hr_7d", "avgStressLevel": "avg_stress", "maxStressLevel": "max_stress",
    "sleep_hours": "sleep_hours", "deep_sleep_hours": "deep_sleep_hours", "rem_sleep_hours": "rem_sleep_hours",
    "bodyBatteryChange": "sleep_body_battery_change", "avg_overnight_hrv": "avg_overnight_hrv", "steps": "steps",
}
add("analysis_frame", "SELECT date, " + ", ".join(
    (rnd(_MED.format(c), 6) if c.endswith("hours") else _MED.format(c)) + f' AS "{n}"' for n, c in _AFC.items()) + ", has_steps_data FROM od", "orders")


def zscore(c: str, table: str) -> str:
    return rnd(f"({c} - (SELECT AVG({c}) FROM {table})) / (SELECT STDDEV_POP({c}) FROM {table})", 6)


add("standardize", f"""SELECT date, {zscore('charged', 'od')} AS charged, {zscore('drained', 'od')} AS drained, {zscore('net_battery', 'od')} AS net_battery,
  0.0::DOUBLE AS constant FROM od""", "orders")
add("fit_on_train_only", f"SELECT date, split, {zscore('charged', 'tr')} AS charged, {zscore('drained', 'tr')} AS drained FROM ods", "orders",
    extra="""ods AS (SELECT date, charged, drained, CASE WHEN row_number() OVER (ORDER BY date) > n - ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split
  FROM od, (SELECT COUNT(*) AS n FROM od)), tr AS (SELECT * FROM ods WHERE split = 'train')""")

# ------------------------------------------------------------------ recommender
_P = ("base", "places", "people")
_S = (*_P, "scored")
add("mood_rules", "SELECT user_id, mood FROM pe", *_P)
add("mood_features", """SELECT user_id, mood, parks::DOUBLE AS parks_count_1km, bars::DOUBLE AS open_bars_count_500m, temperature AS lst_celsius_1km,
  temperature + 2 AS temp_max, temperature - 3 AS temp_min, precipitation AS precip_mm, ndvi, nightlight::DOUBLE AS nightlight FROM pe JOIN prof USING (mood)""", *_P)
add("dynamic_radius", """SELECT user_id, CASE WHEN user_id % 4 = 0 THEN 5.0::DOUBLE WHEN stress > 60 OR precipitation > 5 THEN 10.0::DOUBLE ELSE 25.0::DOUBLE END
  AS radius_km FROM pe""", *_P)
for _name in ("distance_score", "balanced_score", "history_penalty", "final_score"):
    add(_name, f"SELECT user_id, place_id, {rnd(_name, 4)} AS {_name} FROM sc", *_S)
add("topn_by_score", f"SELECT user_id, rank, place_id, {rnd('final_score', 4)} AS final_score FROM best", *_S)
add("recommend_topn", f"""SELECT user_id, rank, display_name AS place_name, address, {rnd('distance_km', 1)} AS distance_km, {rnd('confidence', 1)} AS confidence, mood,
  {reason('parks_count_1km', 'open_bars_count_500m')} AS reason, rating, temperature AS weather_temp, precipitation AS weather_precip
  FROM (SELECT best.user_id, best.rank, best.distance_km, best.confidence, pe.mood, pe.stress, pe.sleep_hours, pe.net_battery, pe.temperature, pe.precipitation,
  pl.display_name, pl.address, pl.rating, pl.parks_count_1km, pl.open_bars_count_500m, prof.ndvi, prof.nightlight
  FROM best JOIN pe USING (user_id) JOIN pl USING (place_id) JOIN prof ON prof.mood = pe.mood)""", *_S)
