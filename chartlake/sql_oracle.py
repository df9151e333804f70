"""Reference SQL (DuckDB dialect) for the registered queries.

``FIXTURE`` derives the star schema from the raw test views with the same
rules as :mod:`chartlake.sources.testdata`; each query string appends its own
SELECT, written in the naive form (BETWEEN joins, one aggregate per period)
rather than as a transcript of the DataFrame plan.  Doubles are rounded to 6
places and DuckDB ``sum`` results cast to BIGINT, to match Spark's types.
"""

from __future__ import annotations

FIXTURE = r"""
WITH
li AS (SELECT l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem),
bounds AS (
  SELECT CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship FROM li
),
days AS (
  SELECT CAST(g.d AS DATE) AS d
  FROM bounds, unnest(generate_series(CAST(first_ship AS TIMESTAMP), CAST(last_ship + 28 AS TIMESTAMP), INTERVAL 1 DAY)) AS g(d)
),
dim_time AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id,
         d AS date,
         CAST(month(d) AS INTEGER) AS month,
         CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter'
              WHEN month(d) IN (3, 4, 5) THEN 'Spring'
              WHEN month(d) IN (6, 7, 8) THEN 'Summer'
              ELSE 'Autumn' END AS season
  FROM days
),
weather_raw AS (
  SELECT t.date, n.n_name AS location,
         24 - 4 * abs(t.month - 7) + CAST((t.date_id * 7 + n.n_nationkey * 13) % 50 AS DOUBLE) / 10 AS temperature_2m_mean,
         CAST((CASE WHEN datediff('day', DATE '1995-01-01', t.date) % 70 < 14 THEN 60 ELSE 5 END)
              + (t.date_id + n.n_nationkey * 5) % 20 AS DOUBLE) / 10 AS precipitation_sum,
         CAST((t.date_id * 3 + n.n_nationkey * 7) % 400 AS DOUBLE) / 10 AS windspeed_10m_max,
         CAST(greatest(0, 3600 * (14 - 3 * abs(t.month - 6)) + (t.date_id * 31 + n.n_nationkey * 17) % 1800) AS DOUBLE)
           AS sunshine_duration
  FROM dim_time t
  JOIN nation n ON TRUE
  JOIN bounds b ON t.date <= b.last_ship
  WHERE day(t.date) < 30
),
daily_weather AS (
  SELECT date,
         avg(temperature_2m_mean) AS temperature_avg,
         avg(precipitation_sum) AS precipitation_mm,
         avg(windspeed_10m_max) AS wind_speed_kmh,
         avg(nullif(sunshine_duration, 0) / 3600.0) AS sunshine_hours
  FROM weather_raw GROUP BY date
),
dim_weather AS (
  SELECT t.date_id AS weather_id, t.date_id, w.temperature_avg, w.precipitation_mm, w.wind_speed_kmh, w.sunshine_hours
  FROM daily_weather w JOIN dim_time t ON t.date = w.date
),
chart_totals AS (
  SELECT CAST(l_shipdate AS DATE) + CAST((7 - isodow(l_shipdate)) % 7 AS INTEGER) AS chart_date,
         CASE WHEN l_suppkey % 4 = 0 THEN 'at' ELSE 'de' END AS country,
         CAST(l_partkey AS VARCHAR) AS song_uuid,
         CAST(sum(l_quantity) * 1000 AS BIGINT) AS streams
  FROM li GROUP BY 1, 2, 3
),
chart_raw AS (
  SELECT chart_date, country, song_uuid, streams,
         CAST(row_number() OVER (PARTITION BY country, chart_date ORDER BY streams DESC, song_uuid) AS INTEGER) AS position
  FROM chart_totals
),
fact_track_chart AS (
  SELECT CAST(t.date_id AS VARCHAR) || '|' || c.country || '|' || c.song_uuid AS fact_id,
         c.song_uuid AS track_id, t.date_id, w.weather_id, c.country,
         c.streams AS stream_count, c.position AS chart_position
  FROM chart_raw c
  JOIN dim_time t ON t.date = c.chart_date
  LEFT JOIN dim_weather w ON w.date_id = t.date_id
),
dim_track AS (
  SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_name AS track_name, p_brand AS artist_names, p_type AS genre,
         CAST(p_size * 10000 AS INTEGER) AS duration_ms, CAST(NULL AS VARCHAR) AS release_date,
         CASE WHEN p_partkey % 3 = 0 THEN 'de' ELSE 'en' END AS language_code,
         'cover/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
         CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE CAST((p_partkey * 37) % 1000 AS DOUBLE) / 1000 END AS danceability,
         CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE CAST((p_partkey * 53) % 1000 AS DOUBLE) / 1000 END AS energy,
         CASE WHEN p_partkey % 25 = 0 THEN NULL ELSE CAST((p_partkey * 91) % 1000 AS DOUBLE) / 1000 END AS valence,
         CAST(60 + (p_partkey * 7) % 140 AS DOUBLE) AS tempo,
         CAST(0 - (p_partkey * 11) % 600 AS DOUBLE) / 10 AS loudness,
         CAST((p_partkey * 19) % 1000 AS DOUBLE) / 1000 AS speechiness,
         CASE WHEN p_partkey % 30 = 0 THEN NULL ELSE CAST((p_partkey * 71) % 1000 AS DOUBLE) / 1000 END AS acousticness,
         CAST((p_partkey * 17) % 1000 AS DOUBLE) / 1000 AS instrumentalness,
         CAST((p_partkey * 13) % 1000 AS DOUBLE) / 1000 AS liveness,
         CAST(CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_partkey % 13 END AS INTEGER) AS key,
         CAST(CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey % 2 END AS INTEGER) AS mode,
         CAST(3 + p_partkey % 2 AS INTEGER) AS time_signature
  FROM part
),
features_all AS (
  SELECT CAST(p_partkey AS VARCHAR) AS song_uuid,
         CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_name || ' v2' END AS song_name,
         p_brand AS artist_name,
         CAST(NULL AS VARCHAR) AS isrc, CAST(NULL AS VARCHAR) AS release_date,
         CAST(p_size * 1.5 AS DOUBLE) AS duration,
         p_partkey % 2 = 0 AS explicit,
         'de' AS language_code,
         CAST((p_partkey * 23) % 1000 AS DOUBLE) / 1000 AS acousticness,
         CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST((p_partkey * 29) % 1000 AS DOUBLE) / 1000 END AS danceability,
         CAST((p_partkey * 31) % 1000 AS DOUBLE) / 1000 AS energy,
         CAST((p_partkey * 41) % 1000 AS DOUBLE) / 1000 AS instrumentalness,
         CAST(p_partkey % 12 AS INTEGER) AS key,
         CAST((p_partkey * 43) % 1000 AS DOUBLE) / 1000 AS liveness,
         CAST(0 - (p_partkey * 7) % 600 AS DOUBLE) / 10 AS loudness,
         CAST((p_partkey + 1) % 2 AS INTEGER) AS mode,
         CAST((p_partkey * 47) % 1000 AS DOUBLE) / 1000 AS speechiness,
         CAST(70 + (p_partkey * 3) % 120 AS DOUBLE) AS tempo,
         4 AS time_signature,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST((p_partkey * 59) % 1000 AS DOUBLE) / 1000 END AS valence,
         CAST(NULL AS VARCHAR) AS image_url,
         CASE p_partkey % 4 WHEN 0 THEN '[{"root":"' || p_type || '"}]' WHEN 1 THEN '[]' WHEN 2 THEN 'not json' END AS genres,
         CAST(NULL AS VARCHAR) AS copyright
  FROM part
),
features_staged AS (SELECT * REPLACE (CASE WHEN CAST(song_uuid AS BIGINT) % 7 = 0 THEN 'x' || song_uuid ELSE song_uuid END AS song_uuid) FROM features_all)
"""


def stable_round(sql: str, digits: int = 6) -> str:
    """Rewrite every ``round(x, 6)`` as a two-step decimal rounding: first to
    10 places (absorbs last-bit differences of float summation order), then
    half away from zero to 6 places -- the same rule as the Spark side."""
    out, i, token = [], 0, "round("
    while True:
        j = sql.find(token, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(token)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(token):k - 1]
        arg, _, nd = inner.rpartition(",")
        out.append(sql[i:j])
        if nd.strip() == str(digits):
            arg = stable_round(arg, digits)
            out.append(f"CAST(round(CAST({arg} AS DECIMAL(38, 10)), {digits}) AS DOUBLE)")
        else:
            out.append(token + stable_round(inner, digits) + ")")
        i = k


def with_fixture(select: str) -> str:
    return FIXTURE + stable_round(select)


# Event periods and baseline year of the fixture (same as testdata.PERIODS).
PERIOD_PRED = (
    "(t.date BETWEEN DATE '1993-06-01' AND DATE '1993-09-30' OR "
    "t.date BETWEEN DATE '1995-01-15' AND DATE '1995-04-10' OR "
    "t.date BETWEEN DATE '1995-04-01' AND DATE '1995-07-31')"
)
BASELINE_PRED = "t.date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"


def _ctry(alias: str, country: str | None) -> str:
    return f"AND {alias}.country = '{country}'" if country else ""


def kpis(country: str | None = "de") -> str:
    return with_fixture(f"""
, f AS (SELECT * FROM fact_track_chart f WHERE 1=1 {_ctry('f', country)})
SELECT CAST(coalesce((SELECT sum(stream_count) FROM f), 0) AS BIGINT) AS total_streams,
       CASE WHEN coalesce((SELECT sum(stream_count) FROM f), 0) > 1000000
            THEN CAST(CAST(trunc(coalesce((SELECT sum(stream_count) FROM f), 0) / 1000000.0) AS BIGINT) AS VARCHAR) || '.0M'
            ELSE CAST(CAST(trunc(coalesce((SELECT sum(stream_count) FROM f), 0) / 1000.0) AS BIGINT) AS VARCHAR) || '.0K' END
         AS total_streams_label,
       (SELECT count(DISTINCT track_id) FROM f) AS unique_tracks,
       round(coalesce((SELECT avg(temperature_avg) FROM dim_weather), 0), 6) AS avg_temp,
       (SELECT count(DISTINCT k.track_id) FROM dim_track k JOIN f ON f.track_id = k.track_id
         WHERE k.danceability IS NOT NULL) AS tracks_with_features,
       round(CASE WHEN (SELECT count(DISTINCT track_id) FROM f) > 0
            THEN (SELECT count(DISTINCT k.track_id) FROM dim_track k JOIN f ON f.track_id = k.track_id
                  WHERE k.danceability IS NOT NULL) * 100.0 / (SELECT count(DISTINCT track_id) FROM f)
            ELSE 0 END, 6) AS feature_coverage_pct,
       (SELECT min(t.date) FROM dim_time t JOIN fact_track_chart x ON x.date_id = t.date_id) AS first_chart_date,
       (SELECT max(t.date) FROM dim_time t JOIN fact_track_chart x ON x.date_id = t.date_id) AS last_chart_date,
       coalesce(strftime((SELECT min(t.date) FROM dim_time t JOIN fact_track_chart x ON x.date_id = t.date_id), '%Y-%m-%d')
                || ' - ' ||
                strftime((SELECT max(t.date) FROM dim_time t JOIN fact_track_chart x ON x.date_id = t.date_id), '%Y-%m-%d'),
                'N/A') AS date_range
""")


def current_top_tracks(country: str = "de", limit: int = 3) -> str:
    return with_fixture(f"""
, latest AS (
  SELECT max(t.date) AS d FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id WHERE f.country = '{country}')
SELECT k.track_name, k.artist_names, k.image_url, f.stream_count AS streams, f.chart_position AS position,
       t.date AS chart_date
FROM dim_track k
JOIN fact_track_chart f ON k.track_id = f.track_id
JOIN dim_time t ON f.date_id = t.date_id
WHERE t.date = (SELECT d FROM latest) AND f.country = '{country}'
ORDER BY f.chart_position NULLS FIRST, k.track_id
LIMIT {limit}
""")


def latest_chart_tops(limit: int) -> str:
    return with_fixture(f"""
, charted AS (SELECT f.*, t.date FROM fact_track_chart f JOIN dim_time t ON f.date_id = t.date_id WHERE f.country <> 'at' OR f.date_id < 20010901),
placed AS (SELECT c.*, CAST(row_number() OVER (PARTITION BY c.country ORDER BY c.chart_position NULLS FIRST, c.track_id) AS INTEGER) AS place
           FROM charted c JOIN (SELECT country, max(date) AS d FROM charted GROUP BY country) l ON c.country = l.country AND c.date = l.d)
SELECT p.country, p.place, k.track_name, k.artist_names, k.image_url, p.stream_count AS streams, p.chart_position AS position, p.date AS chart_date
FROM placed p JOIN dim_track k ON k.track_id = p.track_id WHERE p.place <= {limit}
""")


def weekly_feature_changes(country: str = "de") -> str:
    feats = ["valence", "danceability", "energy", "tempo", "acousticness"]
    weather = [("temperature", "temperature_avg"), ("sunshine", "sunshine_hours"), ("precipitation", "precipitation_mm")]

    def audio(alias: str, day: str) -> str:
        cols = ", ".join(f"avg(k.{c}) AS {c}" for c in feats)
        return f"""{alias} AS (
  SELECT {cols} FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id
  JOIN dim_time t ON f.date_id = t.date_id
  WHERE t.date = {day} AND f.country = '{country}' AND k.valence IS NOT NULL)"""

    def wx(alias: str, lo: str, hi: str) -> str:
        cols = ", ".join(f"avg(w.{src}) AS {m}" for m, src in weather)
        return f"""{alias} AS (
  SELECT {cols} FROM dim_weather w JOIN dim_time t ON w.date_id = t.date_id
  WHERE t.date BETWEEN {lo} AND {hi})"""

    feat_rows = "\nUNION ALL\n".join(
        f"SELECT 'feature' AS metric_kind, '{c}' AS metric, ca.{c} AS current, pa.{c} AS previous, "
        f"CASE WHEN coalesce(pa.{c}, 0) = 0 THEN 0.0 ELSE (ca.{c} - pa.{c}) / pa.{c} * 100 END AS change_pct "
        f"FROM cur_audio ca, prev_audio pa"
        for c in feats
    )
    wx_rows = "\nUNION ALL\n".join(
        f"SELECT 'weather', '{m}', cw.{m}, pw.{m}, CAST(NULL AS DOUBLE) FROM cur_wx cw, prev_wx pw" for m, _ in weather
    )
    return with_fixture(f"""
, latest AS (
  SELECT max(t.date) AS d FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id WHERE f.country = '{country}'),
{audio('cur_audio', '(SELECT d FROM latest)')},
{audio('prev_audio', '(SELECT d FROM latest) - 7')},
uniq AS (
  SELECT count(DISTINCT k.track_id) AS n FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id
  JOIN dim_time t ON f.date_id = t.date_id
  WHERE t.date IN ((SELECT d FROM latest), (SELECT d FROM latest) - 7) AND f.country = '{country}'
    AND k.valence IS NOT NULL),
{wx('cur_wx', '(SELECT d FROM latest) - 6', '(SELECT d FROM latest)')},
{wx('prev_wx', '(SELECT d FROM latest) - 13', '(SELECT d FROM latest) - 7')},
rows AS (
{feat_rows}
UNION ALL
{wx_rows})
SELECT (SELECT d FROM latest) AS chart_date,
       CAST((SELECT d FROM latest) - 7 AS DATE) AS previous_chart_date,
       strftime((SELECT d FROM latest) - 6, '%d.%m') || ' - ' || strftime((SELECT d FROM latest), '%d.%m.%Y')
         AS weather_period_current,
       strftime((SELECT d FROM latest) - 13, '%d.%m') || ' - ' || strftime((SELECT d FROM latest) - 7, '%d.%m.%Y')
         AS weather_period_previous,
       (SELECT n FROM uniq) AS unique_songs,
       metric_kind, metric,
       round(current, 6) AS current, round(previous, 6) AS previous,
       round(current - previous, 6) AS change, round(change_pct, 6) AS change_pct
FROM rows
WHERE (SELECT d FROM latest) IS NOT NULL
""")


SEASON_FEATURES = ["danceability", "energy", "instrumentalness", "loudness", "valence", "tempo", "acousticness"]


def audio_features_by_season(country: str | None = "de") -> str:
    cols = ", ".join(f"round(avg(k.{c}), 6) AS {c}" for c in SEASON_FEATURES)
    return with_fixture(f"""
SELECT t.season, {cols}, count(f.fact_id) AS chart_entries, count(DISTINCT k.track_id) AS unique_tracks
FROM dim_track k
JOIN fact_track_chart f ON k.track_id = f.track_id
JOIN dim_time t ON f.date_id = t.date_id
WHERE k.danceability IS NOT NULL {_ctry('f', country)}
GROUP BY t.season
""")


def audio_features_by_weather(country: str | None = "de") -> str:
    feats = ", ".join(f"round(avg(k.{c}), 6) AS {c}" for c in SEASON_FEATURES)
    return with_fixture(f"""
, chart_dates AS (
  SELECT DISTINCT t.date AS chart_date FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id
  WHERE 1=1 {_ctry('f', country)}),
week_wx AS (
  SELECT c.chart_date,
         avg(w.temperature_avg) AS avg_temperature,
         avg(w.precipitation_mm) AS avg_precipitation,
         avg(w.sunshine_hours) AS avg_sunshine
  FROM chart_dates c
  JOIN dim_time t ON t.date BETWEEN c.chart_date - 6 AND c.chart_date
  JOIN dim_weather w ON w.date_id = t.date_id
  GROUP BY c.chart_date),
categorised AS (
  SELECT *, CASE WHEN avg_precipitation > 5 THEN 'Rainy (>5mm)'
                 WHEN avg_sunshine > 12 THEN 'Very sunny (>12h)'
                 WHEN avg_sunshine > 8 THEN 'Sunny (8-12h)' END AS weather_category
  FROM week_wx WHERE avg_sunshine IS NOT NULL)
SELECT c.weather_category,
       round(avg(c.avg_sunshine), 6) AS avg_sunshine,
       round(avg(coalesce(c.avg_precipitation, 0)), 6) AS avg_precipitation,
       round(avg(coalesce(c.avg_temperature, 0)), 6) AS avg_temperature,
       {feats},
       count(*) AS chart_entries,
       count(DISTINCT k.track_id) AS unique_tracks
FROM categorised c
JOIN dim_time t ON t.date = c.chart_date
JOIN fact_track_chart f ON f.date_id = t.date_id
JOIN dim_track k ON k.track_id = f.track_id
WHERE c.weather_category IS NOT NULL AND k.danceability IS NOT NULL {_ctry('f', country)}
GROUP BY c.weather_category
""")


def danceability_by_sunshine(country: str | None = "de", min_count: int = 20, null_bucket: str | None = None) -> str:
    null_case = f"WHEN w.sunshine_hours IS NULL THEN '{null_bucket}'" if null_bucket else ""
    return with_fixture(f"""
SELECT CASE {null_case} WHEN w.sunshine_hours = 0 THEN '0h'
            WHEN w.sunshine_hours < 4 THEN '1-4h'
            WHEN w.sunshine_hours < 8 THEN '4-8h'
            WHEN w.sunshine_hours < 12 THEN '8-12h'
            ELSE '12h+' END AS sunshine_hours,
       round(avg(w.sunshine_hours), 6) AS exact_sunshine,
       round(avg(k.danceability), 6) AS avg_danceability,
       round(avg(k.valence), 6) AS avg_valence
FROM dim_track k
JOIN fact_track_chart f ON k.track_id = f.track_id
JOIN dim_weather w ON f.weather_id = w.weather_id
WHERE k.danceability IS NOT NULL AND k.valence IS NOT NULL {_ctry('f', country)}
GROUP BY 1
HAVING count(f.fact_id) > {min_count}
""")


def seasonal_streaming_trends(country: str | None = None) -> str:
    return with_fixture(f"""
SELECT t.season, t.month, CAST(sum(f.stream_count) AS BIGINT) AS total_streams
FROM dim_time t JOIN fact_track_chart f ON t.date_id = f.date_id
WHERE 1=1 {_ctry('f', country)}
GROUP BY t.season, t.month
ORDER BY t.month
""")


def acoustic_vs_electronic(country: str | None = None, min_count: int = 10) -> str:
    return with_fixture(f"""
SELECT CASE WHEN k.acousticness > 0.7 THEN 'Acoustic' WHEN k.acousticness < 0.3 THEN 'Electronic'
            ELSE 'Hybrid' END AS track_type,
       CASE WHEN w.precipitation_mm > 5 THEN 'Rain' WHEN w.sunshine_hours > 8 THEN 'Sun' END AS weather,
       round(avg(f.stream_count), 6) AS avg_streams,
       count(f.fact_id) AS sample_size
FROM dim_track k
JOIN fact_track_chart f ON k.track_id = f.track_id
JOIN dim_weather w ON f.weather_id = w.weather_id
WHERE k.acousticness IS NOT NULL {_ctry('f', country)}
GROUP BY 1, 2
HAVING count(f.fact_id) > {min_count}
""")


def chart_seasonal_bars(country: str | None = None) -> str:
    return f"""
SELECT season, month, total_streams, format('{{:,.0f}}', total_streams::double) AS bar_label,
       round(total_streams::double / sum(total_streams) OVER (PARTITION BY season), 6) AS season_share,
       row_number() OVER (ORDER BY month, season)::int AS bar_order
FROM ({seasonal_streaming_trends(country)})
"""


def chart_acoustic_bars(country: str | None = None, min_count: int = 10) -> str:
    return f"""
SELECT weather, track_type, avg_streams, sample_size, format('{{:,.1f}}', avg_streams) AS bar_label,
       dense_rank() OVER (ORDER BY weather IS NULL, highest DESC NULLS LAST, weather)::int AS group_order,
       row_number() OVER (PARTITION BY weather ORDER BY track_type)::int AS bar_order
FROM (SELECT *, max(avg_streams) OVER (PARTITION BY weather) AS highest FROM ({acoustic_vs_electronic(country, min_count)}))
"""


def key_distribution(country: str | None = None) -> str:
    return with_fixture(f"""
, per_key AS (
  SELECT k.key, k.mode, t.season, count(f.fact_id) AS track_count
  FROM dim_track k
  JOIN fact_track_chart f ON k.track_id = f.track_id
  JOIN dim_time t ON f.date_id = t.date_id
  WHERE k.key IS NOT NULL AND k.mode IS NOT NULL AND k.key BETWEEN 0 AND 11 {_ctry('f', country)}
  GROUP BY k.key, k.mode, t.season)
SELECT (['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'])[key + 1]
         || coalesce(CASE mode WHEN 0 THEN 'm' WHEN 1 THEN '' END, '') AS key_name,
       season,
       CAST(sum(track_count) AS BIGINT) AS track_count
FROM per_key
GROUP BY 1, 2
""")


def period_comparison(country: str | None = "de") -> str:
    def side(alias: str, pred: str) -> str:
        return f"""{alias} AS (
  SELECT avg(k.valence) AS v, avg(k.energy) AS e, avg(k.danceability) AS d, count(f.fact_id) AS n
  FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_time t ON f.date_id = t.date_id
  WHERE {pred} AND k.valence IS NOT NULL AND k.energy IS NOT NULL AND k.danceability IS NOT NULL
  {_ctry('f', country)})"""

    rows = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS feature, ev.{c} AS period_avg, bl.{c} AS baseline_avg, ev.n AS period_sample, "
        f"bl.n AS baseline_sample FROM ev, bl"
        for name, c in (("Valence", "v"), ("Energy", "e"), ("Danceability", "d"))
    )
    return with_fixture(f"""
, {side('ev', PERIOD_PRED)},
{side('bl', BASELINE_PRED)},
rows AS ({rows})
SELECT feature, round(period_avg, 6) AS period_avg, round(baseline_avg, 6) AS baseline_avg,
       round(baseline_avg - period_avg, 6) AS difference,
       round(CASE WHEN period_avg = 0 THEN NULL ELSE (baseline_avg - period_avg) / period_avg * 100 END, 6) AS diff_pct,
       period_sample, baseline_sample
FROM rows
""")


# --- windows over dates ----------------------------------------------------------------

def trailing_weather(country: str | None = None) -> str:
    return with_fixture(f"""
, chart_dates AS (
  SELECT DISTINCT t.date AS chart_date FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id
  WHERE 1=1 {_ctry('f', country)})
SELECT c.chart_date,
       round(avg(w.temperature_avg), 6) AS avg_temperature,
       round(avg(w.precipitation_mm), 6) AS avg_precipitation,
       round(avg(w.sunshine_hours), 6) AS avg_sunshine,
       round(avg(w.wind_speed_kmh), 6) AS avg_wind_speed
FROM chart_dates c
JOIN dim_time t ON t.date BETWEEN c.chart_date - 6 AND c.chart_date
JOIN dim_weather w ON w.date_id = t.date_id
GROUP BY c.chart_date
""")


def weekly_change_history(country: str = "de") -> str:
    feats = ["valence", "danceability", "energy", "tempo", "acousticness"]
    cols = ", ".join(f"avg(k.{c}) AS {c}" for c in feats)
    rows = "\nUNION ALL\n".join(
        f"SELECT c.date AS chart_date, '{m}' AS metric, c.{m} AS current, p.{m} AS previous "
        f"FROM per_date c LEFT JOIN per_date p ON p.date = c.date - 7"
        for m in feats
    )
    return with_fixture(f"""
, per_date AS (
  SELECT t.date, {cols}
  FROM fact_track_chart f JOIN dim_time t ON f.date_id = t.date_id JOIN dim_track k ON k.track_id = f.track_id
  WHERE k.valence IS NOT NULL AND f.country = '{country}'
  GROUP BY t.date),
rows AS ({rows})
SELECT chart_date, metric, round(current, 6) AS current, round(previous, 6) AS previous,
       round(current - previous, 6) AS change,
       round(CASE WHEN previous IS NULL THEN NULL WHEN previous = 0 THEN 0
                  ELSE (current - previous) / previous * 100 END, 6) AS change_pct
FROM rows
""")


# --- calendar ------------------------------------------------------------------------------

DIM_TIME_BUILD = with_fixture("SELECT date_id, date, month, season FROM dim_time")

DIM_TIME_EXTEND = with_fixture(
    "SELECT date_id, date, month, season FROM dim_time WHERE date > (SELECT last_ship FROM bounds)"
)

SUNDAY_BOUNDS = with_fixture("""
, m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, min(date) AS first_day, max(date) AS last_day
        FROM dim_time GROUP BY 1)
SELECT month_start,
       first_day + CAST((7 - isodow(first_day)) % 7 AS INTEGER) AS first_sunday,
       last_day - CAST(isodow(last_day) % 7 AS INTEGER) AS last_sunday
FROM m
""")

CALENDAR_SPAN = with_fixture("""
SELECT first_ship, last_ship,
       CAST(datediff('day', first_ship, last_ship) + 1 AS INTEGER) AS expected_days,
       CAST(y.year AS INTEGER) AS year
FROM bounds, unnest(generate_series(year(first_ship), year(last_ship))) AS y(year)
""")

DATE_LABELS = with_fixture("""
SELECT DISTINCT t.date,
       strftime(t.date, '%Y-%m-%d') AS iso,
       strftime(t.date, '%d.%m') AS day_month,
       strftime(t.date, '%d.%m.%Y') AS day_month_year,
       strftime(t.date, '%Y-%m-%d') || 'T12:00:00+00:00' AS api_date,
       isodow(t.date) = 7 AS is_sunday
FROM fact_track_chart f JOIN dim_time t ON t.date_id = f.date_id
""")

# --- loaders -------------------------------------------------------------------------------

DAILY_WEATHER = with_fixture("""
SELECT date, round(temperature_avg, 6) AS temperature_avg, round(precipitation_mm, 6) AS precipitation_mm,
       round(wind_speed_kmh, 6) AS wind_speed_kmh, round(sunshine_hours, 6) AS sunshine_hours
FROM daily_weather
""")

DIM_WEATHER = with_fixture("""
SELECT weather_id, date_id, round(temperature_avg, 6) AS temperature_avg, round(precipitation_mm, 6) AS precipitation_mm,
       round(wind_speed_kmh, 6) AS wind_speed_kmh, round(sunshine_hours, 6) AS sunshine_hours
FROM dim_weather
""")

_GENRE_ROOT = """CASE WHEN {g} IS NOT NULL AND json_valid({g}) AND json_array_length({g}) > 0
            THEN coalesce(json_extract_string({g}, '$[0].root'), '') END"""

DIM_TRACK_LOAD = with_fixture(f"""
SELECT song_uuid AS track_id,
       coalesce(song_name, 'Unknown') AS track_name,
       coalesce(artist_name, 'Unknown') AS artist_names,
       {_GENRE_ROOT.format(g='genres')} AS genre,
       CAST(trunc(duration * 1000) AS INTEGER) AS duration_ms,
       release_date, language_code, image_url,
       round(danceability, 6) AS danceability, round(energy, 6) AS energy, round(valence, 6) AS valence,
       round(tempo, 6) AS tempo, round(loudness, 6) AS loudness, round(speechiness, 6) AS speechiness,
       round(acousticness, 6) AS acousticness, round(instrumentalness, 6) AS instrumentalness,
       round(liveness, 6) AS liveness,
       CAST(key AS INTEGER) AS key, CAST(mode AS INTEGER) AS mode, CAST(time_signature AS INTEGER) AS time_signature
FROM features_all WHERE song_uuid IS NOT NULL
""")

FACT_LOAD = with_fixture("SELECT * FROM fact_track_chart")

FACT_LOAD_PARTIAL = with_fixture("SELECT * FROM fact_track_chart WHERE date_id < 20010101")

FACT_LOAD_SKIPPED = with_fixture("SELECT count(*) AS skipped FROM chart_raw WHERE chart_date >= DATE '2001-01-01'")

_ENTRIES = """, entries AS (
  SELECT chart_date, country, position, streams, song_uuid,
         'Title ' || song_uuid AS song_name,
         CASE WHEN position % 7 = 0 THEN NULL ELSE 'Artist ' || song_uuid END AS artist_name,
         'cover/' || song_uuid || '.jpg' AS image_url
  FROM chart_raw)
"""

_KNOWN = """(SELECT track_id FROM dim_track
   WHERE track_id IN (SELECT song_uuid FROM chart_raw WHERE chart_date < DATE '1995-07-01'))"""

_FIRSTS = _ENTRIES + f"""
, known AS {_KNOWN},
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY song_uuid ORDER BY chart_date, position) AS rn
  FROM entries WHERE song_uuid NOT IN (SELECT track_id FROM known))
"""
_PLACEHOLDERS = """SELECT song_uuid AS track_id, coalesce(song_name, 'Unknown') AS track_name,
       coalesce(artist_name, 'Unknown') AS artist_names,
       CAST(NULL AS VARCHAR) AS genre, CAST(NULL AS INTEGER) AS duration_ms, CAST(NULL AS VARCHAR) AS release_date,
       CAST(NULL AS VARCHAR) AS language_code, image_url,
       CAST(NULL AS DOUBLE) AS danceability, CAST(NULL AS DOUBLE) AS energy, CAST(NULL AS DOUBLE) AS valence,
       CAST(NULL AS DOUBLE) AS tempo, CAST(NULL AS DOUBLE) AS loudness, CAST(NULL AS DOUBLE) AS speechiness,
       CAST(NULL AS DOUBLE) AS acousticness, CAST(NULL AS DOUBLE) AS instrumentalness, CAST(NULL AS DOUBLE) AS liveness,
       CAST(NULL AS INTEGER) AS key, CAST(NULL AS INTEGER) AS mode, CAST(NULL AS INTEGER) AS time_signature
FROM firsts WHERE rn = 1
"""
PLACEHOLDER_TRACKS = with_fixture(_FIRSTS + _PLACEHOLDERS)

INCREMENTAL_CHART_LOAD = with_fixture("SELECT * FROM fact_track_chart WHERE date_id >= 20010901")

_HIT = "s.song_uuid IS NOT NULL"
_MERGE_SELECT = f"""
SELECT k.track_id,
       coalesce(s.song_name, k.track_name) AS track_name,
       coalesce(s.artist_name, k.artist_names) AS artist_names,
       CASE WHEN {_HIT} AND s.genres IS NOT NULL AND json_valid(s.genres) AND json_array_length(s.genres) > 0
            THEN coalesce(json_extract_string(s.genres, '$[0].root'), '') ELSE k.genre END AS genre,
       CASE WHEN {_HIT} THEN CAST(trunc(s.duration * 1000) AS INTEGER) ELSE k.duration_ms END AS duration_ms,
       CASE WHEN {_HIT} THEN s.release_date ELSE k.release_date END AS release_date,
       CASE WHEN {_HIT} THEN s.language_code ELSE k.language_code END AS language_code,
       CASE WHEN {_HIT} THEN s.image_url ELSE k.image_url END AS image_url,
       {', '.join(f"round(CASE WHEN {_HIT} THEN s.{c} ELSE k.{c} END, 6) AS {c}" for c in
                  ['danceability', 'energy', 'valence', 'tempo', 'loudness', 'speechiness', 'acousticness',
                   'instrumentalness', 'liveness'])},
       {', '.join(f"CAST(CASE WHEN {_HIT} THEN s.{c} ELSE k.{c} END AS INTEGER) AS {c}" for c in
                  ['key', 'mode', 'time_signature'])}
"""
TRACK_FEATURE_MERGE = with_fixture(_MERGE_SELECT + "FROM dim_track k LEFT JOIN features_staged s ON s.song_uuid = k.track_id")

UPDATED_TRACK_COUNT = with_fixture(
    "SELECT count(*) AS updated FROM dim_track WHERE track_id IN (SELECT song_uuid FROM features_staged)"
)

# --- incremental ------------------------------------------------------------------------------

_LATEST_FACT = "(SELECT max(t.date) FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id)"
_LATEST_WEATHER = "(SELECT max(t.date) FROM dim_time t JOIN dim_weather w ON w.date_id = t.date_id)"

MISSING_CHART_SUNDAYS = with_fixture(f"""
SELECT date, strftime(date, '%Y-%m-%d') || 'T12:00:00+00:00' AS api_date
FROM dim_time WHERE date > {_LATEST_FACT} AND isodow(date) = 7
""")

MISSING_WEATHER_DATES = with_fixture(f"SELECT date FROM dim_time WHERE date > {_LATEST_WEATHER}")

MISSING_FEATURES = with_fixture(
    "SELECT track_id FROM dim_track WHERE danceability IS NULL"
)

WEATHER_GAP_RANGES = with_fixture("""
, d AS (SELECT date FROM dim_time WHERE date_id NOT IN (SELECT date_id FROM dim_weather)),
g AS (SELECT date, date - CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS grp FROM d)
SELECT min(date) AS start, max(date) AS "end", count(*) AS days FROM g GROUP BY grp
""")

_BACKLOG = """, backlog AS (
  SELECT song_uuid, max(chart_date) AS latest_chart_date, min(position) AS best_position,
         CAST(sum(streams) AS BIGINT) AS total_streams
  FROM chart_raw WHERE song_uuid NOT IN (SELECT song_uuid FROM features_staged)
  GROUP BY song_uuid)
"""

FEATURE_BACKLOG = with_fixture(_BACKLOG + "SELECT * FROM backlog")

FEATURE_BACKLOG_HEAD = with_fixture(_BACKLOG + """
SELECT * FROM backlog ORDER BY latest_chart_date DESC, best_position, song_uuid LIMIT 50
""")

BACKLOG_BATCHES = with_fixture(_BACKLOG + """
, numbered AS (
  SELECT *, row_number() OVER (ORDER BY latest_chart_date DESC, best_position, song_uuid) - 1 AS pos
  FROM backlog)
SELECT song_uuid, latest_chart_date, best_position, total_streams, CAST(pos AS BIGINT) AS position_in_backlog,
       CAST(pos // 50 AS BIGINT) AS batch FROM numbered
""")

REMAINING_DATES = with_fixture("""
, available AS (SELECT strftime(chart_date, '%Y-%m-%d') || 'T12:00:00+00:00' AS api_date FROM chart_raw),
parsed AS (SELECT CAST(substr(api_date, 1, 10) AS DATE) AS chart_date, api_date FROM available),
landed AS (SELECT DISTINCT chart_date FROM chart_raw WHERE chart_date < DATE '1998-01-01')
SELECT chart_date, min(api_date) AS api_date FROM parsed
WHERE chart_date BETWEEN DATE '1996-01-07' AND DATE '2000-12-31'
  AND chart_date NOT IN (SELECT chart_date FROM landed)
GROUP BY chart_date
""")

LANDED_DATES = with_fixture("SELECT DISTINCT chart_date FROM chart_raw")

INCREMENTAL_PLAN = with_fixture(f"""
, c AS (
  SELECT (SELECT count(*) FROM dim_time WHERE date > {_LATEST_WEATHER}) AS missing_weather_dates,
         (SELECT count(*) FROM dim_time WHERE date > {_LATEST_FACT} AND isodow(date) = 7) AS missing_chart_sundays,
         (SELECT count(*) FROM dim_track WHERE danceability IS NULL) AS missing_features)
SELECT *, missing_weather_dates + missing_chart_sundays + missing_features = 0 AS up_to_date FROM c
""")

# --- sources and sinks ---------------------------------------------------------------------------

CHART_TOP_N = with_fixture("""
SELECT chart_date, country, CAST(CASE WHEN position % 6 = 0 THEN NULL WHEN position % 5 = 0 THEN position - 1 ELSE position END AS INTEGER) AS position, song_uuid, streams
FROM chart_raw WHERE position <= 50
""")

FLATTEN_CHART_ITEMS = with_fixture("""
SELECT strftime(chart_date, '%Y-%m-%d') || 'T00:00:00+00:00' AS chart_date,
       position,
       CASE WHEN position % 5 = 0 THEN NULL ELSE position + 1 END AS old_position,
       CASE WHEN position % 5 = 0 THEN NULL ELSE 1 END AS position_change,
       streams,
       CASE WHEN position <= 10 THEN 'UP' ELSE 'STABLE' END AS entry_state,
       strftime(chart_date - CAST((position % 4) * 7 AS INTEGER), '%Y-%m-%d') AS entry_date,
       strftime(chart_date, '%Y-%m-%d') AS rank_date,
       CAST(position % 9 + 1 AS INTEGER) AS weeks_on_chart,
       'week' AS time_unit,
       CASE WHEN position % 50 = 0 THEN NULL ELSE song_uuid END AS song_uuid,
       CASE WHEN position % 50 = 0 THEN NULL ELSE 'Title ' || song_uuid END AS song_name,
       CASE WHEN position % 50 = 0 OR position % 7 = 0 THEN NULL ELSE 'Artist ' || song_uuid END AS artist_name,
       CASE WHEN position % 50 = 0 THEN NULL ELSE 'cover/' || song_uuid || '.jpg' END AS image_url,
       '{"position":' || position
         || CASE WHEN position % 5 = 0 THEN '' ELSE ',"oldPosition":' || (position + 1) || ',"positionEvolution":1' END
         || ',"metric":' || streams || ',"entryState":"' || CASE WHEN position <= 10 THEN 'UP' ELSE 'STABLE' END
         || '","entryDate":"' || strftime(chart_date - CAST((position % 4) * 7 AS INTEGER), '%Y-%m-%d')
         || '","rankDate":"' || strftime(chart_date, '%Y-%m-%d') || '","timeOnChart":' || (position % 9 + 1)
         || ',"timeOnChartUnit":"week"'
         || CASE WHEN position % 50 = 0 THEN '' ELSE ',"song":{"uuid":"' || song_uuid || '","name":"Title ' || song_uuid || '"'
              || CASE WHEN position % 7 = 0 THEN '' ELSE ',"creditName":"Artist ' || song_uuid || '"' END
              || ',"imageUrl":"cover/' || song_uuid || '.jpg"}' END
         || ',"label":{"id":' || (position % 3) || '}}' AS raw_json,
       country
FROM chart_raw
""")


def _ratio(expr: str, mult: int) -> str:
    return f"CAST(({expr} * {mult}) % 1000 AS DOUBLE) / 1000"


FLATTEN_SONG_FEATURES = with_fixture(f"""
SELECT CAST(p_partkey AS VARCHAR) AS song_uuid,
       p_name AS song_name, p_brand AS artist_name,
       CASE WHEN p_partkey % 2 = 0 THEN 'ISRC' || CAST(p_partkey AS VARCHAR) END AS isrc,
       '199' || CAST(p_partkey % 10 AS VARCHAR) || '-01-01' AS release_date,
       CAST(p_size * 1.5 AS DOUBLE) AS duration,
       p_partkey % 2 = 1 AS explicit,
       'en' AS language_code,
       round({_ratio('p_partkey', 23)}, 6) AS acousticness,
       round({_ratio('p_partkey', 29)}, 6) AS danceability,
       round({_ratio('p_partkey', 31)}, 6) AS energy,
       round({_ratio('p_partkey', 41)}, 6) AS instrumentalness,
       CAST(p_partkey % 12 AS INTEGER) AS key,
       round({_ratio('p_partkey', 43)}, 6) AS liveness,
       round(CAST(0 - (p_partkey * 7) % 600 AS DOUBLE) / 10, 6) AS loudness,
       CAST((p_partkey + 1) % 2 AS INTEGER) AS mode,
       round({_ratio('p_partkey', 47)}, 6) AS speechiness,
       CAST(70 + (p_partkey * 3) % 120 AS DOUBLE) AS tempo,
       4 AS time_signature,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE round({_ratio('p_partkey', 59)}, 6) END AS valence,
       'cover/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
       CASE p_partkey % 4
         WHEN 0 THEN '[{{"root":"' || p_type || '","sub":["sub a"]}}]'
         WHEN 3 THEN '[{{"root":"' || p_type || '","sub":["sub a"]}},{{"root":"pop","sub":["sub b"]}}]'
         ELSE '[]' END AS genres,
       p_brand || ' records' AS copyright
FROM part
WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0
""")

EXPLODE_WEATHER_ARRAYS = with_fixture("""
SELECT date, location,
       round(temperature_2m_mean, 6) AS temperature_avg,
       round(precipitation_sum, 6) AS precipitation_mm,
       round(windspeed_10m_max, 6) AS wind_speed_kmh,
       round(nullif(sunshine_duration, 0) / 3600.0, 6) AS sunshine_hours
FROM weather_raw
""")

DIM_LOCATION = """SELECT n_nationkey AS location_id, n_name AS location, CAST((n_nationkey * 7) % 180 - 90 AS DOUBLE) AS lat,
       CAST((n_nationkey * 13) % 360 - 180 AS DOUBLE) AS lon FROM nation"""

SRC_CHART_CSV = with_fixture(_ENTRIES + """
SELECT chart_date, position, CAST(NULL AS INTEGER) AS old_position, CAST(NULL AS INTEGER) AS position_change,
       streams, 'STABLE' AS entry_state, CAST(NULL AS VARCHAR) AS entry_date, CAST(NULL AS VARCHAR) AS rank_date,
       CAST(NULL AS INTEGER) AS weeks_on_chart, 'week' AS time_unit,
       song_uuid, 'The "' || song_name || '", part' || chr(10) || 'one' AS song_name, artist_name, image_url
FROM entries
""")

SRC_FEATURE_CSV = with_fixture("""
SELECT song_uuid, song_name || ', "live"' || chr(10) || 'take 2' AS song_name, artist_name, isrc, release_date, round(duration, 6) AS duration, explicit,
       language_code, round(acousticness, 6) AS acousticness, round(danceability, 6) AS danceability,
       round(energy, 6) AS energy, round(instrumentalness, 6) AS instrumentalness, key,
       round(liveness, 6) AS liveness, round(loudness, 6) AS loudness, mode, round(speechiness, 6) AS speechiness,
       round(tempo, 6) AS tempo, CAST(time_signature AS INTEGER) AS time_signature, round(valence, 6) AS valence,
       image_url, genres, copyright
FROM features_all
""")

STAGING_UNION_SORTED = with_fixture("""
SELECT strftime(chart_date, '%Y-%m-%d') AS chart_date, country, position, song_uuid, streams FROM chart_raw
""")

STAGING_UNION_DEDUP = with_fixture("""
SELECT song_uuid, song_name, artist_name, duration, round(danceability, 6) AS danceability, genres
FROM features_all
UNION ALL
SELECT 'b' || CAST(p_partkey AS VARCHAR), 'New ' || p_name, p_brand, CAST(p_size * 2.0 AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR)
FROM part
""")

# --- quality ----------------------------------------------------------------------------------------

_COUNTS = """, cnt AS (
  SELECT (SELECT count(*) FROM dim_time) AS time_rows,
         (SELECT count(*) FROM dim_weather) AS weather_rows,
         (SELECT count(*) FROM dim_track) AS track_rows,
         (SELECT count(danceability) FROM dim_track) AS tracks_with_features,
         (SELECT count(*) FROM fact_track_chart) AS fact_rows,
         (SELECT count(weather_id) FROM fact_track_chart) AS facts_with_weather,
         (SELECT datediff('day', first_ship, last_ship + 28) + 1 FROM bounds) AS expected_days)
"""

_RULES = _COUNTS + """
, rules AS (
  SELECT 'time_rows_expected' AS rule, 'error' AS severity, CAST(time_rows AS DOUBLE) AS actual,
         CAST(expected_days AS DOUBLE) AS threshold, time_rows = expected_days AS passed FROM cnt
  UNION ALL SELECT 'weather_rows_min', 'error', weather_rows, 300, weather_rows >= 300 FROM cnt
  UNION ALL SELECT 'fact_rows_nonzero', 'error', fact_rows, 0, fact_rows > 0 FROM cnt
  UNION ALL SELECT 'track_rows_min', 'warning', track_rows, 3000, track_rows >= 3000 FROM cnt
  UNION ALL SELECT 'feature_coverage_min', 'warning', round(tracks_with_features / track_rows, 6), 0.9,
                   coalesce(tracks_with_features / track_rows >= 0.9, false) FROM cnt
  UNION ALL SELECT 'weather_linkage_min', 'warning', round(facts_with_weather / fact_rows, 6), 0.99,
                   coalesce(facts_with_weather / fact_rows >= 0.99, false) FROM cnt)
"""

DQ_REPORT = with_fixture(_RULES + "SELECT rule, severity, actual, threshold, passed FROM rules")

# a full load whose tracks come from the staged features
DQ_BUILD = with_fixture((_RULES + "SELECT rule, severity, actual, threshold, passed FROM rules").replace("dim_track", "features_all"))

DQ_PASSED = with_fixture(_RULES + """
SELECT coalesce(bool_and(passed OR severity <> 'error'), true) AS passed,
       count(*) FILTER (WHERE NOT passed AND severity = 'error') AS errors,
       count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings
FROM rules
""")

LOAD_SUMMARY = with_fixture(_COUNTS + """
SELECT track_rows AS tracks, tracks_with_features,
       round(tracks_with_features * 100.0 / track_rows, 6) AS feature_pct,
       fact_rows AS facts, facts_with_weather,
       round(facts_with_weather * 100.0 / fact_rows, 6) AS weather_pct
FROM cnt
""")

STAGING_SUMMARY = with_fixture("""
SELECT count(*) AS chart_rows, min(chart_date) AS first_chart_date, max(chart_date) AS last_chart_date,
       count(DISTINCT chart_date) AS chart_weeks, count(DISTINCT song_uuid) AS distinct_songs,
       (SELECT count(*) FROM features_all) AS feature_rows,
       (SELECT count(DISTINCT song_uuid) FROM features_all) AS feature_songs
FROM chart_raw
""")

# --- chart-ready tables ----------------------------------------------------------------------

CHART_TOP_CARDS = with_fixture("""
, latest AS (SELECT max(t.date) AS d FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id
             WHERE f.country = 'de')
SELECT f.chart_position AS rank, k.track_name AS title, k.artist_names AS artist, k.image_url,
       f.stream_count AS streams, CAST(CAST(trunc(f.stream_count / 1000.0) AS BIGINT) AS VARCHAR) || 'K' AS streams_label,
       t.date AS chart_date
FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_time t ON f.date_id = t.date_id
WHERE t.date = (SELECT d FROM latest) AND f.country = 'de'
ORDER BY f.chart_position NULLS FIRST, k.track_id
LIMIT 3
""")


def _weekly_core(country: str = "de") -> str:
    """Unrounded rows of the weekly comparison (metric_kind, metric, current, previous)."""
    feats = ["valence", "danceability", "energy", "tempo", "acousticness"]
    weather = [("temperature", "temperature_avg"), ("sunshine", "sunshine_hours"), ("precipitation", "precipitation_mm")]
    audio_cols = ", ".join(
        f"avg(CASE WHEN t.date = l.d THEN k.{c} END) AS c_{c}, avg(CASE WHEN t.date = l.d - 7 THEN k.{c} END) AS p_{c}"
        for c in feats
    )
    wx_cols = ", ".join(
        f"avg(CASE WHEN t.date >= l.d - 6 THEN w.{s} END) AS c_{m}, avg(CASE WHEN t.date <= l.d - 7 THEN w.{s} END) AS p_{m}"
        for m, s in weather
    )
    rows = "\nUNION ALL\n".join(
        [f"SELECT 'feature' AS metric_kind, '{c}' AS metric, c_{c} AS current, p_{c} AS previous FROM a" for c in feats]
        + [f"SELECT 'weather', '{m}', c_{m}, p_{m} FROM wx" for m, _ in weather]
    )
    return f"""
, l AS (SELECT max(t.date) AS d FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id
        WHERE f.country = '{country}'),
a AS (SELECT {audio_cols} FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id
      JOIN dim_time t ON f.date_id = t.date_id, l
      WHERE t.date IN (l.d, l.d - 7) AND f.country = '{country}' AND k.valence IS NOT NULL),
wx AS (SELECT {wx_cols} FROM dim_weather w JOIN dim_time t ON w.date_id = t.date_id, l
       WHERE t.date BETWEEN l.d - 13 AND l.d),
wk AS ({rows})
"""


WEEKLY_TREND_LABELS = with_fixture(_weekly_core("de") + """
SELECT metric_kind, metric, round(current, 6) AS current, round(previous, 6) AS previous,
       round(current - previous, 6) AS change,
       round(CASE WHEN metric_kind = 'weather' THEN NULL
                  WHEN coalesce(previous, 0) = 0 THEN 0 ELSE (current - previous) / previous * 100 END, 6) AS change_pct,
       round(abs(current - previous), 6) AS abs_change,
       CASE WHEN abs(current - previous) < (CASE WHEN metric_kind = 'weather' THEN 0.5 ELSE 0.005 END) THEN 'flat'
            WHEN current - previous > 0 THEN 'up'
            WHEN current - previous IS NOT NULL THEN 'down' END AS trend
FROM wk
""")

_SEASON_CORE = """
, q4 AS (
  SELECT t.season, avg(k.danceability) AS danceability, avg(k.energy) AS energy,
         avg(k.instrumentalness) AS instrumentalness, avg(k.loudness) AS loudness, avg(k.valence) AS valence,
         avg(k.tempo) AS tempo, avg(k.acousticness) AS acousticness,
         count(f.fact_id) AS chart_entries, count(DISTINCT k.track_id) AS unique_tracks
  FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_time t ON f.date_id = t.date_id
  WHERE k.danceability IS NOT NULL AND f.country = 'de'
  GROUP BY t.season)
"""

CHART_SEASON_SERIES = with_fixture(_SEASON_CORE + "\n".join([""] + [
    ("UNION ALL " if i else "")
    + f"SELECT CASE season WHEN 'Spring' THEN 0 WHEN 'Summer' THEN 1 WHEN 'Autumn' THEN 2 WHEN 'Winter' THEN 3 ELSE 4 END"
    f" AS season_order, season, '{c}' AS feature, round({c}, 6) AS value, chart_entries, unique_tracks FROM q4"
    for i, c in enumerate(SEASON_FEATURES)
]))

CHART_SEASON_TOTALS = with_fixture(_SEASON_CORE + """
SELECT CAST(sum(chart_entries) AS BIGINT) AS total_entries, CAST(sum(unique_tracks) AS BIGINT) AS total_unique FROM q4
""")

CHART_AXIS_RANGES = with_fixture(_SEASON_CORE + """
SELECT round(min(tempo) * 0.95, 6) AS tempo_lo, round(max(tempo) * 1.05, 6) AS tempo_hi,
       round(min(loudness) * 1.1, 6) AS loudness_lo, round(max(loudness) * 0.9, 6) AS loudness_hi
FROM q4
""")

_WEATHER_CORE = """
, chart_dates AS (
  SELECT DISTINCT t.date AS chart_date FROM dim_time t JOIN fact_track_chart f ON f.date_id = t.date_id
  WHERE f.country = 'de'),
week_wx AS (
  SELECT c.chart_date, avg(w.temperature_avg) AS avg_temperature, avg(w.precipitation_mm) AS avg_precipitation,
         avg(w.sunshine_hours) AS avg_sunshine
  FROM chart_dates c JOIN dim_time t ON t.date BETWEEN c.chart_date - 6 AND c.chart_date
  JOIN dim_weather w ON w.date_id = t.date_id GROUP BY c.chart_date),
cat AS (
  SELECT *, CASE WHEN avg_precipitation > 5 THEN 'Rainy (>5mm)' WHEN avg_sunshine > 12 THEN 'Very sunny (>12h)'
                 WHEN avg_sunshine > 8 THEN 'Sunny (8-12h)' END AS weather_category
  FROM week_wx WHERE avg_sunshine IS NOT NULL),
q5 AS (
  SELECT c.weather_category, avg(c.avg_sunshine) AS avg_sunshine, avg(coalesce(c.avg_precipitation, 0)) AS avg_precipitation,
         avg(coalesce(c.avg_temperature, 0)) AS avg_temperature,
         avg(k.danceability) AS danceability, avg(k.energy) AS energy, avg(k.instrumentalness) AS instrumentalness,
         avg(k.loudness) AS loudness, avg(k.valence) AS valence, avg(k.tempo) AS tempo, avg(k.acousticness) AS acousticness,
         count(*) AS chart_entries, count(DISTINCT k.track_id) AS unique_tracks
  FROM cat c JOIN dim_time t ON t.date = c.chart_date JOIN fact_track_chart f ON f.date_id = t.date_id
  JOIN dim_track k ON k.track_id = f.track_id
  WHERE c.weather_category IS NOT NULL AND k.danceability IS NOT NULL AND f.country = 'de'
  GROUP BY c.weather_category)
"""

CHART_WEATHER_SERIES = with_fixture(_WEATHER_CORE + "\n".join([""] + [
    ("UNION ALL " if i else "")
    + "SELECT weather_category, round(avg_sunshine, 6) AS avg_sunshine, round(avg_precipitation, 6) AS avg_precipitation,"
    " round(avg_temperature, 6) AS avg_temperature, chart_entries, unique_tracks,"
    f" '{c}' AS feature, round({c}, 6) AS value,"
    " CASE weather_category WHEN 'Rainy (>5mm)' THEN 0 WHEN 'Sunny (8-12h)' THEN 1 WHEN 'Very sunny (>12h)' THEN 2"
    " ELSE 3 END AS category_order FROM q5"
    for i, c in enumerate(SEASON_FEATURES)
]))

CHART_TOP_KEYS = with_fixture("""
, per_key AS (
  SELECT (['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'])[k.key + 1]
           || coalesce(CASE k.mode WHEN 0 THEN 'm' WHEN 1 THEN '' END, '') AS key_name,
         t.season, count(f.fact_id) AS track_count
  FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_time t ON f.date_id = t.date_id
  WHERE k.key IS NOT NULL AND k.mode IS NOT NULL AND k.key BETWEEN 0 AND 11
  GROUP BY 1, 2),
best AS (SELECT key_name FROM per_key GROUP BY key_name ORDER BY sum(track_count) DESC, key_name LIMIT 10)
SELECT key_name, season, track_count FROM per_key WHERE key_name IN (SELECT key_name FROM best)
""")

CHART_SUNSHINE_SERIES = with_fixture("""
, q6 AS (
  SELECT CASE WHEN w.sunshine_hours = 0 THEN '0h' WHEN w.sunshine_hours < 4 THEN '1-4h'
              WHEN w.sunshine_hours < 8 THEN '4-8h' WHEN w.sunshine_hours < 12 THEN '8-12h' ELSE '12h+' END
           AS sunshine_hours,
         avg(w.sunshine_hours) AS exact_sunshine, avg(k.danceability) AS d, avg(k.valence) AS v
  FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_weather w ON f.weather_id = w.weather_id
  WHERE k.danceability IS NOT NULL AND k.valence IS NOT NULL AND f.country = 'de'
  GROUP BY 1 HAVING count(f.fact_id) > 20)
SELECT sunshine_hours, round(exact_sunshine, 6) AS exact_sunshine, round(d * 100, 6) AS danceability_pct,
       round(v * 100, 6) AS valence_pct,
       CAST(row_number() OVER (ORDER BY exact_sunshine NULLS FIRST, sunshine_hours) AS INTEGER) AS point_order
FROM q6
""")

CHART_PERIOD_BARS = with_fixture(f"""
, ev AS (
  SELECT avg(k.valence) AS v, avg(k.energy) AS e, avg(k.danceability) AS d, count(f.fact_id) AS n
  FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_time t ON f.date_id = t.date_id
  WHERE {PERIOD_PRED} AND k.valence IS NOT NULL AND k.energy IS NOT NULL AND k.danceability IS NOT NULL
    AND f.country = 'de'),
bl AS (
  SELECT avg(k.valence) AS v, avg(k.energy) AS e, avg(k.danceability) AS d, count(f.fact_id) AS n
  FROM dim_track k JOIN fact_track_chart f ON k.track_id = f.track_id JOIN dim_time t ON f.date_id = t.date_id
  WHERE {BASELINE_PRED} AND k.valence IS NOT NULL AND k.energy IS NOT NULL AND k.danceability IS NOT NULL
    AND f.country = 'de'),
r AS (
  SELECT 'Valence' AS feature, ev.v AS pa, bl.v AS ba, ev.n AS period_sample, bl.n AS baseline_sample FROM ev, bl
  UNION ALL SELECT 'Energy', ev.e, bl.e, ev.n, bl.n FROM ev, bl
  UNION ALL SELECT 'Danceability', ev.d, bl.d, ev.n, bl.n FROM ev, bl)
SELECT feature, round(pa, 6) AS period_avg, round(ba, 6) AS baseline_avg, round(ba - pa, 6) AS difference,
       round((ba - pa) / pa * 100, 6) AS diff_pct, period_sample, baseline_sample,
       CAST(row_number() OVER (ORDER BY abs((ba - pa) / pa * 100) DESC NULLS LAST, feature) AS INTEGER) AS bar_order
FROM r
""")


# --- warehouse loads and the stream ---------------------------------------------------------

WAREHOUSE_ROW_COUNTS = with_fixture("""
SELECT 'dim_time' AS "table", count(*) AS rows FROM dim_time
UNION ALL SELECT 'dim_track', count(*) FROM dim_track
UNION ALL SELECT 'dim_weather', count(*) FROM dim_weather
UNION ALL SELECT 'fact_track_chart', count(*) FROM fact_track_chart
""")

WAREHOUSE_CREATE = f"""
SELECT "table", CAST(0 AS BIGINT) AS rows_created, rows, true AS created, false AS created_again FROM ({WAREHOUSE_ROW_COUNTS})
"""

WAREHOUSE_VERSIONS = with_fixture("""
, v(version) AS (VALUES (1), (2))
SELECT version, 'dim_time' AS "table", (SELECT count(*) FROM dim_time) AS rows FROM v
UNION ALL SELECT version, 'dim_track', (SELECT count(*) FROM dim_track) FROM v
UNION ALL SELECT version, 'dim_weather', (SELECT count(*) FROM dim_weather WHERE version = 2 OR date_id < 20010901) FROM v
UNION ALL SELECT version, 'fact_track_chart', (SELECT count(*) FROM fact_track_chart WHERE version = 2 OR date_id < 20010901) FROM v
""")

UNIQUE_TRACKS_SKETCH = with_fixture("""
SELECT f.country, CAST(year(t.date) AS INTEGER) AS year, CAST(quarter(t.date) AS INTEGER) AS quarter, count(*) AS entries,
       count(DISTINCT f.track_id) AS unique_tracks, true AS within_3_percent
FROM fact_track_chart f JOIN dim_time t ON f.date_id = t.date_id GROUP BY ALL
""")

WAREHOUSE_REFRESH = with_fixture("""
SELECT 'dim_time' AS "table", count(*) AS rows FROM dim_time
UNION ALL SELECT 'dim_track', (SELECT count(DISTINCT song_uuid) FROM chart_raw)
UNION ALL SELECT 'dim_weather', count(*) FROM dim_weather
UNION ALL SELECT 'fact_track_chart', count(*) FROM fact_track_chart
""")

WAREHOUSE_REFRESH_TRACKS = with_fixture(_FIRSTS + f"""
, base AS (SELECT * FROM dim_track WHERE track_id IN (SELECT track_id FROM known)
           UNION ALL BY NAME ({_PLACEHOLDERS}))
""" + _MERGE_SELECT + "FROM base k LEFT JOIN features_staged s ON s.song_uuid = k.track_id AND k.danceability IS NULL")

INCREMENTAL_STREAM = with_fixture("""
SELECT * FROM fact_track_chart WHERE date_id < 20010901 OR chart_position % 50 <> 0
""")


# --- key sets and ranges --------------------------------------------------------------------

NEW_TRACKS = with_fixture(f"""
SELECT DISTINCT song_uuid AS track_id FROM chart_raw WHERE song_uuid NOT IN {_KNOWN}
""")

KNOWN_TRACKS = with_fixture(f"""
SELECT DISTINCT song_uuid AS track_id FROM chart_raw WHERE song_uuid IN {_KNOWN}
""")

DATE_RANGES = with_fixture(f"""
, d AS (SELECT date FROM dim_time WHERE date > {_LATEST_WEATHER}),
g AS (SELECT date, date - CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS grp FROM d)
SELECT min(date) AS start, max(date) AS "end", count(*) AS days FROM g GROUP BY grp
""")


# --- small operators on their own -----------------------------------------------------------

PARSE_API_DATES = with_fixture("""
SELECT DISTINCT strftime(chart_date, '%Y-%m-%d') || 'T12:00:00+00:00' AS api_date, chart_date FROM chart_raw
""")

GENRE_ROOT = with_fixture(f"""
SELECT song_uuid, genres, {_GENRE_ROOT.format(g='genres')} AS genre_root,
       CASE WHEN json_valid(genres) THEN json_array_length(genres) > 0 ELSE false END AS has_genre
FROM features_all
""")

FEATURE_COVERAGE = f"SELECT unique_tracks, tracks_with_features, feature_coverage_pct FROM ({kpis('de')})"

CHART_DATES = with_fixture("""
SELECT DISTINCT t.date AS chart_date, f.country FROM fact_track_chart f JOIN dim_time t ON t.date_id = f.date_id
""")
