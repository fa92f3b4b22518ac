"""DuckDB SQL twins of ``runway.catalog.QUERIES`` (the correctness oracle).

Each query is written independently of the Spark code, on the driver's
pre-registered views.  Roles are common table expressions; every query
pulls in the ones it needs, in dependency order.
"""

from __future__ import annotations

import re

# -- roles ---------------------------------------------------------------------

_CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    _CTE[name] = (deps, sql)


_cte("trips", """
SELECT s.s_nationkey AS origin, c.c_nationkey AS dest, o.o_orderpriority AS carrier,
       l.l_orderkey AS flight, CAST(o.o_orderdate AS DATE) AS date,
       CAST(year(o.o_orderdate) AS INTEGER) AS year,
       CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE)
         * 1440.0 AS dep_delay
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey""")

_cte("ev_minutes", """
SELECT event_id, ts, user_id, event_type, value, sd,
       least(greatest(sd + event_id % 61 - 15, 1), 1440) AS dm,
       least(sd + 30 + event_id % 151, 1440) AS sa
FROM (SELECT *, hour(ts) * 60 + minute(ts) AS sd FROM events)""")

_cte("raw_flights", """
SELECT strftime(ts, '%-m/%-d/%Y') AS date,
       CAST((sd // 60) * 100 + sd % 60 AS INTEGER) AS sched_dep_time,
       CASE WHEN event_id % 13 <> 0 THEN CAST((dm // 60) * 100 + dm % 60 AS INTEGER) END AS dep_time,
       CAST((sa // 60) * 100 + sa % 60 AS INTEGER) AS sched_arr_time,
       CASE WHEN event_id % 17 <> 0 THEN CAST((am // 60) * 100 + am % 60 AS INTEGER) END AS arr_time,
       event_type AS carrier,
       event_id AS flight,
       CASE WHEN event_id % 11 <> 0 THEN 'N' || CAST(user_id AS VARCHAR) END AS tailnum,
       CAST(user_id % 3 AS VARCHAR) AS origin,
       CAST(user_id % 5 AS VARCHAR) AS dest,
       CASE WHEN event_id % 7 <> 0 THEN sqrt(value) * 10 END AS air_time
FROM (SELECT *, least(greatest(sa + event_id % 37 - 8, 1), 1440) AS am FROM ev_minutes)""",
     "ev_minutes")

_cte("kept_flights", """
SELECT * FROM raw_flights
WHERE dep_time IS NOT NULL AND arr_time IS NOT NULL AND tailnum IS NOT NULL""", "raw_flights")

_cte("clean_flights", """
SELECT k.date, k.sched_dep_time, k.dep_time, k.sched_arr_time, k.arr_time, k.carrier,
       k.flight, k.tailnum, k.origin, k.dest, coalesce(k.air_time, m.mean_air) AS air_time
FROM kept_flights k
LEFT JOIN (SELECT carrier, origin, dest, avg(air_time) AS mean_air
           FROM kept_flights GROUP BY carrier, origin, dest) m
  ON k.carrier = m.carrier AND k.origin = m.origin AND k.dest = m.dest""", "kept_flights")


def _flights_sql(shift: int, rounded: bool) -> str:
    def ts(col: str, s: int) -> str:
        return (f"CAST(d AS TIMESTAMP) + to_seconds((({col} // 100) * 60 + {col} % 100) * 60 - {s})")

    def delay(a: str, p: str) -> str:
        e = f"date_diff('second', {p}, {a}) / 60.0"
        return f"round({e}, 0)" if rounded else e

    return f"""
SELECT d AS date, sched_dep_time, dep_time, sched_arr_time, arr_time, carrier, flight, tailnum,
       origin, dest, air_time,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, dayname(d) AS day,
       sched_dep_ts, dep_ts, sched_arr_ts, arr_ts,
       {delay('dep_ts', 'sched_dep_ts')} AS dep_delay,
       {delay('arr_ts', 'sched_arr_ts')} AS arr_delay,
       CAST(hour(sched_dep_ts) AS INTEGER) AS hour
FROM (SELECT *, {ts('sched_dep_time', 0)} AS sched_dep_ts, {ts('dep_time', shift)} AS dep_ts,
             {ts('sched_arr_time', 0)} AS sched_arr_ts, {ts('arr_time', shift)} AS arr_ts
      FROM (SELECT *, CAST(strptime(date, '%m/%d/%Y') AS DATE) AS d FROM clean_flights))"""


_cte("flights", _flights_sql(1, False), "clean_flights")
_cte("flights_minute", _flights_sql(60, True), "clean_flights")

_cte("raw_weather", """
SELECT origin, strftime(day, '%-m-%-d-%Y') AS date,
       strftime(day, '%Y-%m-%d') || ' ' || lpad(CAST(hr AS VARCHAR), 2, '0') || ':00:00'
         AS hour_sched_dep,
       CASE WHEN hr % 6 <> 0 THEN mean * 10 END AS temp,
       CASE WHEN hr % 8 <> 5 THEN sqrt(lo) * 10 END AS dewp,
       CASE WHEN hr % 7 <> 3 THEN sqrt(hi) * 10 END AS humid,
       CAST(n * 10 AS DOUBLE) AS wind_dir,
       CASE WHEN hr % 9 <> 4 THEN CAST(floor(hi) % 25 AS DOUBLE) END AS wind_speed,
       CASE WHEN hr % 4 <> 1 THEN sqrt(hi - lo) * 10 END AS wind_gust,
       CASE WHEN hr % 5 <> 2 THEN sqrt(tot) + 1000 END AS pressure,
       CAST(least(n, 10) AS DOUBLE) AS visib
FROM (SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hr,
             CAST(user_id % 3 AS VARCHAR) AS origin,
             count(*) AS n, avg(sqrt(value)) AS mean, min(value) AS lo, max(value) AS hi,
             sum(value) AS tot
      FROM events
      GROUP BY CAST(ts AS DATE), CAST(hour(ts) AS INTEGER), CAST(user_id % 3 AS VARCHAR))""")

_WEATHER_FILL = ("temp", "dewp", "humid", "wind_dir", "wind_speed", "wind_gust", "pressure")

_cte("weather", f"""
SELECT w.origin, w.date, w.hour_sched_dep,
       {', '.join(f'coalesce(w.{c}, m.{c}) AS {c}' for c in _WEATHER_FILL)}, w.visib
FROM raw_weather w
LEFT JOIN (SELECT origin, date, {', '.join(f'avg({c}) AS {c}' for c in _WEATHER_FILL)}
           FROM raw_weather GROUP BY origin, date) m
  ON w.origin = m.origin AND w.date = m.date""", "raw_weather")

_cte("weather_temp_only", """
SELECT w.origin, w.date, w.hour_sched_dep, coalesce(w.temp, m.temp) AS temp, w.dewp, w.humid,
       w.wind_dir, w.wind_speed, w.wind_gust, w.pressure, w.visib
FROM raw_weather w
LEFT JOIN (SELECT origin, date, avg(temp) AS temp FROM raw_weather GROUP BY origin, date) m
  ON w.origin = m.origin AND w.date = m.date""", "raw_weather")

_cte("weather_prep", """
SELECT CAST(strptime(date, '%m-%d-%Y') AS DATE) AS date,
       CAST(hour(CAST(hour_sched_dep AS TIMESTAMP)) AS INTEGER) AS hour,
       origin, hour_sched_dep, temp, dewp, humid, wind_dir, wind_speed, wind_gust, pressure, visib
FROM weather""", "weather")

_JOIN_BODY = """
SELECT f.month, f.date, f.origin, f.hour, f.flight, f.dep_delay, f.arr_delay,
       w.temp, w.wind_dir, w.wind_speed, w.pressure, w.visib
FROM flights f JOIN weather_prep w
  ON f.date = w.date AND f.origin = w.origin AND f.hour = w.hour"""
_cte("joined", _JOIN_BODY, "flights", "weather_prep")
_cte("joined_delayed", _JOIN_BODY + " WHERE f.arr_delay > 0", "flights", "weather_prep")

#: The same roles with the events spread over twelve months.
_YEAR = "(SELECT * REPLACE (ts + to_months(CAST(event_id % 12 AS INTEGER)) AS ts) FROM events)"
_SPREAD = {"ev_minutes", "raw_flights", "kept_flights", "clean_flights", "flights", "raw_weather", "weather",
           "weather_prep", "joined", "joined_delayed"}
for _name in [n for n in _CTE if n in _SPREAD]:
    _deps, _sql = _CTE[_name]
    for _n in sorted(_SPREAD, key=len, reverse=True):
        _sql = re.sub(rf"\b(FROM|JOIN) {_n}\b", rf"\1 {_n}_year", _sql)
    _sql = re.sub(r"\bFROM events\b", f"FROM {_YEAR} e", _sql)
    _cte(f"{_name}_year", _sql, *[f"{n}_year" for n in _deps])

_cte("reports", """
SELECT day AS date, CAST(hr AS INTEGER) AS hour, origin,
       strftime(day, '%Y-%m-%d') || ' ' || lpad(CAST(hr AS VARCHAR), 2, '0') || ':00:00' AS hour_sched_dep,
       station, reported, sqrt(lo) * 10 AS temp, CAST(n * 10 AS DOUBLE) AS wind_dir,
       CASE WHEN hr % 9 <> 4 THEN CAST(floor(hi) % 25 AS DOUBLE) END AS wind_speed,
       sqrt(hi) + 1000 AS pressure, CAST(least(n, 10) AS DOUBLE) AS visib
FROM (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hr, CAST(user_id % 3 AS VARCHAR) AS origin, event_type AS station,
             count(*) AS n, min(value) AS lo, max(value) AS hi, max(event_id) AS reported
      FROM events GROUP BY ALL)""")
_cte("latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date, origin, hour ORDER BY reported DESC) AS rn FROM reports)
WHERE rn = 1""", "reports")
_cte("csv_lines", """
SELECT *, CASE WHEN flight % 29 = 0 THEN 'n/a' ELSE CAST(dep_time AS VARCHAR) END AS dep_text,
       CASE WHEN flight % 43 = 0 THEN '12:30' ELSE CAST(sched_arr_time AS VARCHAR) END AS arr_text
FROM raw_flights""", "raw_flights")

_cte("raw_planes", """
SELECT 'N' || CAST(p_partkey AS VARCHAR) AS tailnum,
       CAST(p_partkey % 57 + 1956 AS INTEGER) AS manufacturing_year,
       p_type AS type, p_size % 4 + 1 AS engines,
       CASE WHEN p_partkey % 13 <> 0 THEN p_size END AS seats,
       p_brand AS engine, sqrt(p_retailprice) * 10 AS fuel_cc,
       CASE WHEN p_partkey % 10 = 0 THEN p_size * 10 END AS speed
FROM part""")

_PLANE_COLS = ("tailnum", "manufacturing_year", "type", "engines", "seats", "engine", "fuel_cc")
_cte("planes", f"""
SELECT {', '.join(_PLANE_COLS)} FROM raw_planes
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _PLANE_COLS)} AND NOT isnan(fuel_cc)""",
     "raw_planes")

_cte("plane_traits_raw", """
SELECT type, engines, seats, engine, avg(fuel_cc) AS avg_fuel_cc,
       type || ' ' || CAST(engines AS VARCHAR) || ' ' || CAST(seats AS VARCHAR) || ' ' || engine
         AS parameters
FROM planes GROUP BY type, engines, seats, engine""", "planes")

_cte("plane_traits", """
SELECT type, engines, seats, engine, round(avg_fuel_cc, 4) AS avg_fuel_cc, parameters
FROM plane_traits_raw""", "plane_traits_raw")


def _with(body: str, *names: str, extra: str = "") -> str:
    """``WITH`` the named roles (and their dependencies, in order), then any
    ``extra`` query-local CTEs, then ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _CTE[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_CTE[n][1]}\n)" for n in order)
    if extra:
        ctes += ",\n" + extra
    return f"WITH {ctes}\n{body}"


def _r(e: str, alias: str) -> str:
    return f"round({e}, 4) AS {alias}"


# -- queries -------------------------------------------------------------------

_FLIGHT_COLS = ("date", "sched_dep_time", "dep_time", "sched_arr_time", "arr_time", "carrier",
                "flight", "tailnum", "origin", "dest", "air_time")
_WEATHER_COLS = ("origin", "date", "hour_sched_dep", "temp", "dewp", "humid", "wind_dir",
                 "wind_speed", "wind_gust", "pressure", "visib")
_RAW_PLANE_COLS = _PLANE_COLS + ("speed",)
_DOUBLE_FLIGHT = {"air_time"}


def _null_counts(cols, doubles=()) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c in doubles else ''}) AS {c}"
        for c in cols)


def _select_r4(cols, doubles) -> str:
    return ", ".join(_r(c, c) if c in doubles else c for c in cols)


def _top_routes(src: str, k: int, where: str = "") -> str:
    return (f"SELECT origin, dest, count(*) AS route_freq FROM {src} {where} "
            f"GROUP BY origin, dest ORDER BY route_freq DESC, origin, dest LIMIT {k}")


_CARRIERS_TOP5 = """
SELECT t.origin, t.dest, t.carrier, count(*) AS count
FROM trips t JOIN (""" + _top_routes("trips", 5) + """) r
  ON t.origin = r.origin AND t.dest = r.dest
GROUP BY t.origin, t.dest, t.carrier"""

_ENRICHED_DOUBLES = {"air_time", "dep_delay", "arr_delay"}
_ENRICHED_COLS = _FLIGHT_COLS + ("year", "month", "day", "sched_dep_ts", "dep_ts",
                                 "sched_arr_ts", "arr_ts", "dep_delay", "arr_delay", "hour")


_CARRIERS_TOP5_OF_YEAR = _CARRIERS_TOP5.replace(
    _top_routes("trips", 5), _top_routes("trips", 5, "WHERE year = 1997"))


def _weather_join(source: str) -> str:
    return f"""
SELECT f.month, f.date, f.origin, f.hour, f.flight, round(f.dep_delay, 4) AS dep_delay,
       round(f.arr_delay, 4) AS arr_delay, round(w.temp, 4) AS temp, round(w.wind_dir, 4) AS wind_dir,
       round(w.wind_speed, 4) AS wind_speed, round(w.pressure, 4) AS pressure, round(w.visib, 4) AS visib
FROM flights f JOIN {source} w ON f.date = w.date AND f.origin = w.origin AND f.hour = w.hour"""


_MONTH_MEANS = ("dep_delay", "temp", "wind_dir", "wind_speed", "pressure", "visib")


def _monthly(source: str) -> str:
    return ("SELECT month, " + ", ".join(_r(f"avg({c})", f"avg_{c}") for c in _MONTH_MEANS)
            + f" FROM {source} GROUP BY month")


_MONTHLY_SCOPES = f"""
SELECT month, count(*) AS trips, {', '.join(_r(f"avg({c})", f"avg_{c}") for c in _MONTH_MEANS)},
       count(*) FILTER (WHERE arr_delay > 0) AS late_trips,
       {', '.join(_r(f"avg({c}) FILTER (WHERE arr_delay > 0)", f"late_{c}") for c in _MONTH_MEANS)}
FROM joined_year GROUP BY month"""


def _busiest_hour(by: str) -> str:
    return _with(f"""
SELECT {by}, hour, count FROM (
  SELECT {by}, hour, count,
         row_number() OVER (PARTITION BY {by} ORDER BY count DESC, hour) AS rn
  FROM (SELECT {by}, hour, count(*) AS count FROM flights GROUP BY {by}, hour))
WHERE rn = 1""", "flights")


def _busiest_hour_cw(by: str) -> str:
    return _with(f"""
SELECT {by}, max(hour) AS max_hour, max(count) AS max_count
FROM (SELECT {by}, hour, count(*) AS count FROM flights GROUP BY {by}, hour)
GROUP BY {by}""", "flights")


def _share(src: str, origin) -> str:
    return f"""
SELECT count(*) AS total, count(*) FILTER (WHERE dep_delay > 0) AS delayed,
       round(CASE WHEN count(*) = 0 THEN NULL
                  ELSE CAST(count(*) FILTER (WHERE dep_delay > 0) AS DOUBLE) * 100.0 / count(*)
             END, 4) AS delayed_pct
FROM {src} WHERE origin = {origin}"""


def _delayed_counts(src: str, key: str, asc: bool) -> str:
    order = f"count {'ASC' if asc else 'DESC'}, {key}"
    return (f"SELECT {key}, count(*) AS count FROM {src} WHERE dep_delay > 0 "
            f"GROUP BY {key} ORDER BY {order} LIMIT 1")


def _fuel_by(trait: str) -> str:
    return _with(f"SELECT {trait}, round(avg(fuel_cc), 4) AS avg_fuel_cc FROM planes "
                 f"GROUP BY {trait}", "planes")


_PAIRS = (("engines", "seats"), ("engines", "avg_fuel_cc"), ("seats", "avg_fuel_cc"))
_PAIR_COLS = ("engines", "seats", "avg_fuel_cc")


def _binned() -> str:
    parts = []
    for c in _PAIR_COLS:
        lo, hi = f"(SELECT lo_{c} FROM b)", f"(SELECT hi_{c} FROM b)"
        b = (f"CASE WHEN {c} IS NULL THEN NULL WHEN {hi} = {lo} THEN 1 ELSE "
             f"CAST(least(floor((CAST({c} AS DOUBLE) - {lo}) * 10.0 / ({hi} - {lo})) + 1, 10)"
             f" AS INTEGER) END")
        parts.append(f"SELECT '{c}' AS col, {b} AS bin FROM pt")
    bounds = ", ".join(f"CAST(min({c}) AS DOUBLE) AS lo_{c}, CAST(max({c}) AS DOUBLE) AS hi_{c}"
                       for c in _PAIR_COLS)
    extra = (f"pt AS (SELECT engines, seats, avg_fuel_cc FROM plane_traits_raw),\n"
             f"b AS (SELECT {bounds} FROM pt)")
    body = (f"SELECT col, bin, count(*) AS count FROM ({' UNION ALL '.join(parts)}) "
            f"GROUP BY col, bin")
    return _with(body, "plane_traits_raw", extra=extra)


_PROFILE_TYPES = {"date": "string", "sched_dep_time": "int", "dep_time": "int",
                  "sched_arr_time": "int", "arr_time": "int", "carrier": "string",
                  "flight": "bigint", "tailnum": "string", "origin": "string", "dest": "string",
                  "air_time": "double"}

_WEATHER_DOUBLES = set(_WEATHER_COLS[3:])

QUERIES: dict[str, str] = {
    "busiest_route": _with(_top_routes("trips", 1), "trips"),
    "top5_routes": _with(_top_routes("trips", 5), "trips"),
    "busiest_route_one_year": _with(_top_routes("trips", 1, "WHERE year = 1997"), "trips"),
    "top5_routes_sql": _with(_top_routes("trips", 5), "trips"),
    "carriers_on_top_routes": _with(_CARRIERS_TOP5, "trips"),
    "carrier_totals": _with("SELECT carrier, count(*) AS count2 FROM trips GROUP BY carrier",
                            "trips"),
    "carrier_route_vs_total": _with(f"""
SELECT a.carrier, a.origin, a.dest, a.count, b.count2
FROM ({_CARRIERS_TOP5}) a
JOIN (SELECT carrier, count(*) AS count2 FROM trips GROUP BY carrier) b ON a.carrier = b.carrier""",
                                    "trips"),
    "least_delayed_origin": _with(_delayed_counts("trips", "origin", True), "trips"),
    "most_delayed_dest": _with(_delayed_counts("trips", "dest", False), "trips"),
    "delayed_share_trips": _with(_share("trips", 0), "trips"),
    "null_counts": _with(f"SELECT {_null_counts(_FLIGHT_COLS, _DOUBLE_FLIGHT)} FROM raw_flights",
                         "raw_flights"),
    "column_profile": _with(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM raw_flights"
        for c, t in _PROFILE_TYPES.items()), "raw_flights"),
    "preview": _with(f"SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)} FROM raw_flights ORDER BY flight LIMIT 5",
                     "raw_flights"),
    "drop_named_columns": _with(
        "SELECT " + _select_r4([c for c in _ENRICHED_COLS if not (c.endswith("_time") and c != "air_time")], _ENRICHED_DOUBLES)
        + " FROM flights", "flights"),
    "drop_null_rows_subset": _with(
        f"SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)} FROM kept_flights", "kept_flights"),
    "fill_group_mean": _with(f"""
SELECT {', '.join(c for c in _FLIGHT_COLS if c != 'air_time')},
       round(coalesce(air_time, avg(air_time) OVER (PARTITION BY carrier, origin, dest)), 4)
         AS air_time
FROM raw_flights""", "raw_flights"),
    "group_mean_kept_on_rows": _with(f"""
SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)},
       round(avg(air_time) OVER (PARTITION BY carrier, origin, dest), 4) AS mean_air_time
FROM raw_flights""", "raw_flights"),
    "fill_mean": _with(f"""
SELECT {', '.join(c for c in _FLIGHT_COLS if c != 'air_time')},
       round(coalesce(air_time, (SELECT avg(air_time) FROM raw_flights)), 4) AS air_time
FROM raw_flights""", "raw_flights"),
    "clean_flights": _with(f"SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)} FROM clean_flights",
                           "clean_flights"),
    "enrich_flights": _with(f"SELECT {_select_r4(_ENRICHED_COLS, _ENRICHED_DOUBLES)} FROM flights",
                            "flights"),
    "enrich_flights_minute_shift": _with(
        f"SELECT {_select_r4(_ENRICHED_COLS, _ENRICHED_DOUBLES)} FROM flights_minute",
        "flights_minute"),
    "clock_text_decode": _with("""
SELECT flight, sched_dep_time, dep_time,
       CAST((sched_dep_time // 100) * 60 + sched_dep_time % 100 AS INTEGER) AS sched_dep_min,
       CAST((sched_dep_time // 100) * 60 + sched_dep_time % 100 AS INTEGER) AS sched_dep_min_text,
       CAST((dep_time // 100) * 60 + dep_time % 100 AS INTEGER) AS dep_min,
       CAST((dep_time // 100) * 60 + dep_time % 100 AS INTEGER) AS dep_min_text
FROM raw_flights""", "raw_flights"),
    "day_of_month": _with(
        "SELECT flight, date, CAST(day(date) AS INTEGER) AS day_of_month, day FROM flights",
        "flights"),
    "spot_check_filter": _with("""
SELECT date, sched_dep_time, dep_time, carrier, origin, dest, round(air_time, 4) AS air_time, flight
FROM flights
WHERE carrier = 'purchase' AND origin = '2' AND dest = '4' AND hour = 17 AND tailnum IS NOT NULL""",
                               "flights"),
    "busiest_hour_by_carrier": _busiest_hour("carrier"),
    "busiest_hour_by_carrier_columnwise": _busiest_hour_cw("carrier"),
    "busiest_hour_by_origin": _busiest_hour("origin"),
    "busiest_hour_by_origin_columnwise": _busiest_hour_cw("origin"),
    "delayed_share": _with(_share("flights", "'1'"), "flights"),
    "delayed_share_minute_shift": _with(_share("flights_minute", "'1'"), "flights_minute"),
    "least_delayed_origin_flights": _with(_delayed_counts("flights", "origin", True), "flights"),
    "most_delayed_dest_flights": _with(_delayed_counts("flights", "dest", False), "flights"),
    "delay_by_hour": _with("""
SELECT hour, round(avg(dep_delay), 4) AS avg_delay FROM flights
WHERE dep_delay > 0 AND arr_delay > 0 GROUP BY hour""", "flights"),
    "csv_roundtrip": _with(f"SELECT {', '.join(_FLIGHT_COLS)} FROM raw_flights", "raw_flights"),
    "csv_reordered": _with(f"SELECT {', '.join(_FLIGHT_COLS)} FROM raw_flights", "raw_flights"),
    "sentinel_counts": _with("SELECT " + ", ".join(
        f"count(*) FILTER (WHERE coalesce(CAST({c} AS VARCHAR), 'NA') = 'NA') AS {c}"
        for c in _WEATHER_COLS) + " FROM raw_weather", "raw_weather"),
    "null_counts_weather": _with(
        f"SELECT {_null_counts(_WEATHER_COLS, _WEATHER_DOUBLES)} FROM raw_weather", "raw_weather"),
    "fill_weather_daily_mean": _with(
        f"SELECT {_select_r4(_WEATHER_COLS, _WEATHER_DOUBLES)} FROM weather", "weather"),
    "fill_weather_temp_only": _with(
        f"SELECT {_select_r4(_WEATHER_COLS, _WEATHER_DOUBLES)} FROM weather_temp_only",
        "weather_temp_only"),
    "distinct_values": _with("""
SELECT origin, round(pressure, 4) AS pressure, round(humid, 4) AS humid,
       round(wind_dir, 4) AS wind_dir
FROM (SELECT DISTINCT origin, pressure, humid, wind_dir
      FROM weather WHERE origin = '0' AND wind_speed = 3.0)""", "weather"),
    "weather_duplicate_keys": _with("""
SELECT date, origin, hour, count(*) AS n FROM reports
GROUP BY date, origin, hour HAVING count(*) > 1""", "reports"),
    "weather_latest_report": _with("""
SELECT date, hour, origin, hour_sched_dep, station, reported, round(temp, 4) AS temp, round(wind_dir, 4) AS wind_dir,
       round(wind_speed, 4) AS wind_speed, round(pressure, 4) AS pressure, round(visib, 4) AS visib FROM latest""",
                                   "latest"),
    "join_weather_reports": _with(_weather_join("reports"), "flights", "reports"),
    "join_weather_latest_report": _with(_weather_join("latest"), "flights", "latest"),
    "join_weather_stored": _with(_weather_join("weather_prep"), "flights", "weather_prep"),
    "monthly_weather_delay_year": _with(_monthly("joined_year"), "joined_year"),
    "monthly_weather_delay_late": _with(_monthly("joined_delayed_year"), "joined_delayed_year"),
    "monthly_weather_delay_scopes": _with(_MONTHLY_SCOPES, "joined_year"),
    "carriers_on_top_routes_of_year": _with(_CARRIERS_TOP5_OF_YEAR, "trips"),
    "carrier_route_vs_total_of_year": _with(f"""
SELECT a.carrier, a.origin, a.dest, a.count, b.count2
FROM ({_CARRIERS_TOP5_OF_YEAR}) a
JOIN (SELECT carrier, count(*) AS count2 FROM trips GROUP BY carrier) b ON a.carrier = b.carrier""", "trips"),
    "csv_checked_rows": _with(f"""
SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)} FROM csv_lines
WHERE flight % 29 <> 0 AND flight % 43 <> 0""", "csv_lines"),
    "csv_rejects": _with("""
SELECT array_to_string([date, CAST(sched_dep_time AS VARCHAR), coalesce(dep_text, 'NA'), coalesce(arr_text, 'NA'),
         coalesce(CAST(arr_time AS VARCHAR), 'NA'), carrier, CAST(flight AS VARCHAR), coalesce(tailnum, 'NA'), origin,
         dest], ',') AS row_text, b.c AS "column", b.t AS cell
FROM csv_lines, LATERAL (SELECT 'dep_time' AS c, dep_text AS t WHERE flight % 29 = 0
                         UNION ALL SELECT 'sched_arr_time', arr_text WHERE flight % 43 = 0) b""", "csv_lines"),
    "fill_group_mean_from_states": _with(
        f"SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)} FROM clean_flights", "clean_flights"),
    "group_mean_without_a_day": _with("""
SELECT carrier, origin, dest, round(avg(air_time), 4) AS mean_air_time, count(air_time) AS n FROM kept_flights
WHERE date <> '1/3/2024' GROUP BY carrier, origin, dest HAVING count(air_time) > 0""", "kept_flights"),
    "cleaning_difference": _with(f"""
SELECT {', '.join(_FLIGHT_COLS)}, CAST(sum(sign) AS BIGINT) AS times
FROM (SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)}, 1 AS sign FROM raw_flights
      UNION ALL SELECT {_select_r4(_FLIGHT_COLS, _DOUBLE_FLIGHT)}, -1 FROM clean_flights)
GROUP BY {', '.join(_FLIGHT_COLS)} HAVING sum(sign) <> 0""", "raw_flights", "clean_flights"),
    "join_weather": _with(
        "SELECT month, date, origin, hour, flight, round(dep_delay, 4) AS dep_delay, "
        "round(arr_delay, 4) AS arr_delay, round(temp, 4) AS temp, round(wind_dir, 4) AS wind_dir, "
        "round(wind_speed, 4) AS wind_speed, round(pressure, 4) AS pressure, "
        "round(visib, 4) AS visib FROM joined", "joined"),
    "join_weather_delayed_only": _with(
        "SELECT month, date, origin, hour, flight, round(dep_delay, 4) AS dep_delay, "
        "round(arr_delay, 4) AS arr_delay, round(temp, 4) AS temp, round(wind_dir, 4) AS wind_dir, "
        "round(wind_speed, 4) AS wind_speed, round(pressure, 4) AS pressure, "
        "round(visib, 4) AS visib FROM joined_delayed", "joined_delayed"),
    "join_weather_csv_roundtrip": _with(
        "SELECT month, date, origin, hour, flight, round(dep_delay, 4) AS dep_delay, "
        "round(arr_delay, 4) AS arr_delay, round(temp, 4) AS temp, round(wind_dir, 4) AS wind_dir, "
        "round(wind_speed, 4) AS wind_speed, round(pressure, 4) AS pressure, "
        "round(visib, 4) AS visib FROM joined", "joined"),
    "monthly_weather_delay": _with(
        "SELECT month, " + ", ".join(
            _r(f"avg({c})", f"avg_{c}")
            for c in ("dep_delay", "temp", "wind_dir", "wind_speed", "pressure", "visib"))
        + " FROM joined GROUP BY month", "joined"),
    "delay_by_wind_speed": _with(
        "SELECT round(wind_speed, 4) AS wind_speed, round(avg(arr_delay), 4) AS avg_arr_delay "
        "FROM joined_delayed GROUP BY wind_speed", "joined_delayed"),
    "monthly_weather_delay_preaggregated": _with(
        "SELECT month, " + ", ".join(
            _r(f"avg({c})", f"avg_{c}")
            for c in ("dep_delay", "temp", "wind_dir", "wind_speed", "pressure", "visib"))
        + " FROM joined GROUP BY month", "joined"),
    "delay_by_wind_speed_preaggregated": _with(
        "SELECT round(wind_speed, 4) AS wind_speed, round(avg(arr_delay), 4) AS avg_arr_delay "
        "FROM joined_delayed GROUP BY wind_speed", "joined_delayed"),
    "null_counts_planes": _with(
        f"SELECT {_null_counts(_RAW_PLANE_COLS, {'fuel_cc'})} FROM raw_planes", "raw_planes"),
    "null_pct": _with("SELECT " + ", ".join(
        f"round(CAST(count(*) FILTER (WHERE {c} IS NULL{' OR isnan(fuel_cc)' if c == 'fuel_cc' else ''})"
        f" AS DOUBLE) * 100.0 / count(*), 4) AS {c}"
        for c in _RAW_PLANE_COLS) + " FROM raw_planes", "raw_planes"),
    "drop_sparse_columns": _with(f"SELECT {', '.join(_PLANE_COLS)} FROM raw_planes",
                                 "raw_planes"),
    "drop_null_rows_any": _with(
        f"SELECT {', '.join(_RAW_PLANE_COLS)} FROM raw_planes WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in _RAW_PLANE_COLS), "raw_planes"),
    "clean_planes": _with(f"SELECT {', '.join(_PLANE_COLS)} FROM planes", "planes"),
    "fuel_by_year": _fuel_by("manufacturing_year"),
    "fuel_by_plane_traits": _with("SELECT * FROM plane_traits", "plane_traits"),
    "fuel_by_type": _fuel_by("type"),
    "fuel_by_engines": _fuel_by("engines"),
    "fuel_by_seats": _fuel_by("seats"),
    "fuel_by_engine": _fuel_by("engine"),
    "fuel_by_each_trait": _with(" UNION ALL ".join(
        f"SELECT '{t}' AS trait, CAST({t} AS VARCHAR) AS value, "
        f"round(avg(fuel_cc), 4) AS avg_fuel_cc FROM planes GROUP BY {t}"
        for t in ("type", "engines", "seats", "engine")), "planes"),
    "chart_series": _fuel_by("manufacturing_year"),
    "pairwise_corr": _with(" UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
        f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 4) AS corr FROM plane_traits_raw"
        for a, b in _PAIRS), "plane_traits_raw"),
    "binned_counts": _binned(),
}
