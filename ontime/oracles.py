"""The same results in SQL over the order tables, for checking the registered queries."""

from __future__ import annotations

_FLOWN = """
booked AS (
  SELECT o.o_orderkey, c.c_nationkey, substr(o.o_orderpriority, 1, 1) AS cause
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
legs AS (
  SELECT l.*, s.s_suppkey, s.s_name, s.s_nationkey, b.c_nationkey, b.cause,
         l.l_returnflag = 'R' AND l.l_linenumber = 7 AS canc,
         l.l_returnflag = 'A' AND l.l_linenumber = 6 AS diverted
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN booked b ON l.l_orderkey = b.o_orderkey
),
flown AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, cause, diverted,
    CAST(year(l_shipdate) AS INTEGER) AS year,
    CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(day(l_shipdate) AS INTEGER) AS day,
    CAST(CASE WHEN NOT canc THEN (l_orderkey % 24) * 100 + l_partkey * 7 % 60 END AS INTEGER) AS dep_time,
    CAST((l_orderkey % 24) * 100 + l_partkey * 7 % 60 AS INTEGER) AS sched_dep_time,
    CAST(CASE WHEN NOT canc THEN l_quantity - 20 END AS INTEGER) AS dep_delay,
    CAST(NULL AS INTEGER) AS arr_time,
    CAST(NULL AS INTEGER) AS sched_arr_time,
    CAST(CASE WHEN NOT canc THEN l_partkey % 60 - 25 END AS INTEGER) AS arr_delay,
    'C' || lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS carrier,
    CAST(l_orderkey % 9000 AS INTEGER) AS flight,
    CASE WHEN l_tax <> 0.08 THEN 'N' || CAST(l_partkey AS VARCHAR) END AS tailnum,
    'A' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS origin,
    'A' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS dest,
    CAST(CASE WHEN NOT canc THEN 30 + 12 * abs(s_nationkey - c_nationkey) END AS INTEGER) AS air_time,
    CAST(100 + 100 * abs(s_nationkey - c_nationkey) AS INTEGER) AS distance,
    CAST(l_orderkey % 24 AS INTEGER) AS hour,
    CAST(l_partkey * 7 % 60 AS INTEGER) AS minute,
    CAST(NULL AS VARCHAR) AS time_hour,
    s_name AS name
  FROM legs
)"""

_FLIGHT_INTS = (
    "year month day dep_time sched_dep_time dep_delay arr_time sched_arr_time arr_delay "
    "flight air_time distance hour minute"
).split()
_FLIGHT_TEXTS = "carrier tailnum origin dest time_hour name".split()
_FLIGHT_COLUMNS = (
    "year month day dep_time sched_dep_time dep_delay arr_time sched_arr_time arr_delay carrier "
    "flight tailnum origin dest air_time distance hour minute time_hour name"
).split()

_NORMAL = f"""
normal AS (
  SELECT {", ".join(f"coalesce({c}, 0) AS {c}" for c in _FLIGHT_INTS)},
         {", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in _FLIGHT_TEXTS)}
  FROM flown
)"""

_CAUSES = """
caused AS (
  SELECT year, month, carrier, min(name) AS carrier_name, dest AS airport,
    count(*) AS flights, count(*) FILTER (WHERE arr_delay > 15) AS late,
    count(*) FILTER (WHERE arr_delay > 15 AND cause = '1') AS c1,
    count(*) FILTER (WHERE arr_delay > 15 AND cause = '2') AS c2,
    count(*) FILTER (WHERE arr_delay > 15 AND cause = '3') AS c3,
    count(*) FILTER (WHERE arr_delay > 15 AND cause = '4') AS c4,
    count(*) FILTER (WHERE arr_delay > 15 AND cause = '5') AS c5,
    count(*) FILTER (WHERE arr_delay IS NULL) AS cancelled,
    count(*) FILTER (WHERE diverted) AS diverted,
    dest = 'A23' OR (month = 2 AND carrier LIKE '%7') AS unreported
  FROM flown GROUP BY year, month, carrier, dest
),
delay_cause AS (
  SELECT year, month, carrier, carrier_name, airport, 'Unknown' AS airport_name,
    CAST(flights AS FLOAT) AS arr_flights,
    CAST(CASE WHEN NOT unreported THEN late END AS FLOAT) AS arr_del15,
    CAST(CASE WHEN NOT unreported THEN c1 END AS FLOAT) AS carrier_ct,
    CAST(CASE WHEN NOT unreported THEN c2 END AS FLOAT) AS weather_ct,
    CAST(CASE WHEN NOT unreported THEN c3 END AS FLOAT) AS nas_ct,
    CAST(CASE WHEN NOT unreported THEN c4 END AS FLOAT) AS security_ct,
    CAST(CASE WHEN NOT unreported THEN c5 END AS FLOAT) AS late_aircraft_ct,
    CAST(cancelled AS FLOAT) AS arr_cancelled,
    CAST(diverted AS FLOAT) AS arr_diverted,
    CAST(NULL AS FLOAT) AS arr_delay, CAST(NULL AS FLOAT) AS carrier_delay,
    CAST(NULL AS FLOAT) AS weather_delay, CAST(NULL AS FLOAT) AS nas_delay,
    CAST(NULL AS FLOAT) AS security_delay, CAST(NULL AS FLOAT) AS late_aircraft_delay
  FROM caused
),
delay_reasons AS (
  SELECT year, month, carrier AS carrier_code, airport AS airport_code,
    arr_flights AS total_arrivals, arr_del15 AS total_delays, carrier_ct AS carrier_cause_delay,
    weather_ct AS weather_cause_delay, nas_ct AS nas_cause_delay, security_ct AS security_cause_delay,
    late_aircraft_ct AS late_aircraft_cause_delay, arr_cancelled AS total_cancellations,
    arr_diverted AS total_diversions
  FROM delay_cause
)"""


def _star(sep: str) -> str:
    return f"""
dim_carrier AS (SELECT DISTINCT carrier AS carrier_code, name AS carrier_name FROM normal),
dim_airport AS (
  SELECT DISTINCT 'A' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS airport_code, n.n_name AS airport_name,
    r.r_name AS country, n.n_name || ' City' AS city
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey <> 24
),
dim_date AS (
  SELECT year, month, day, make_date(year, month, day) AS date,
    sha256(concat_ws('{sep}', year, month, day)) AS date_code,
    strftime(make_date(year, month, day), '%A') AS day_of_week,
    day AS day_of_month,
    CAST(dayofyear(make_date(year, month, day)) AS VARCHAR) AS day_of_year,
    strftime(make_date(year, month, day), '%B') AS month_name,
    CAST(quarter(make_date(year, month, day)) AS VARCHAR) AS quarter,
    dayofweek(make_date(year, month, day)) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT year, month, day FROM normal)
),
dim_route AS (
  SELECT DISTINCT origin, dest AS destination, distance,
    sha256(concat_ws('{sep}', origin, dest, distance)) AS route_key
  FROM normal
),
dim_time AS (
  SELECT DISTINCT hour, minute, hour * 60 + minute AS time_id,
    CASE WHEN hour BETWEEN 5 AND 11 THEN 'Morning' WHEN hour BETWEEN 12 AND 16 THEN 'Afternoon'
         WHEN hour BETWEEN 17 AND 20 THEN 'Evening' ELSE 'Night' END AS time_of_day,
    printf('%02d:%02d', hour, minute) AS formatted_time
  FROM normal
),
fact_flights AS (
  SELECT tailnum AS tail_number, carrier AS carrier_code, flight AS flight_number, air_time,
    sha256(concat_ws('{sep}', origin, dest, distance)) AS route_key,
    sha256(concat_ws('{sep}', year, month, day)) AS date_code,
    hour * 60 + minute AS time_id,
    dep_delay > 15 AS is_departure_delayed, arr_delay > 15 AS is_arrival_delayed
  FROM normal
)"""


_ENRICHED = """
enriched AS (
  SELECT f.*, d.year, d.month, d.day, d.date, d.day_of_week, d.day_of_month, d.day_of_year, d.month_name,
    d.quarter, d.is_weekend, r.origin, r.destination, r.distance, t.hour, t.minute, t.time_of_day, t.formatted_time
  FROM fact_flights f
  LEFT JOIN dim_date d ON f.date_code = d.date_code
  LEFT JOIN dim_route r ON f.route_key = r.route_key
  LEFT JOIN dim_time t ON f.time_id = t.time_id
),
model_rows AS (
  SELECT carrier_code, origin, destination, distance, air_time, day_of_week,
    CAST(is_weekend AS DOUBLE) AS is_weekend, day_of_month, month, time_of_day,
    CAST(is_arrival_delayed AS DOUBLE) AS is_arrival_delayed,
    CAST(is_departure_delayed AS DOUBLE) AS is_departure_delayed
  FROM enriched
  WHERE carrier_code IS NOT NULL AND origin IS NOT NULL AND destination IS NOT NULL AND distance IS NOT NULL
    AND air_time IS NOT NULL AND day_of_week IS NOT NULL AND is_weekend IS NOT NULL
    AND day_of_month IS NOT NULL AND month IS NOT NULL AND time_of_day IS NOT NULL
)"""


def _sql(body: str, sep: str = "-") -> str:
    return "WITH " + ",".join([_FLOWN, _NORMAL, _CAUSES, _star(sep), _ENRICHED]) + "\n" + body


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# -- sources and quality

_FLIGHTS_TEXT = ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NA') AS {c}" for c in _FLIGHT_COLUMNS)
_TEXT_AS_READ = ", ".join(f"coalesce({c}, 'NA') AS {c}" for c in _FLIGHT_TEXTS)
_CONFORMED = f"SELECT {', '.join(_FLIGHT_INTS)}, {_TEXT_AS_READ} FROM flown"
_NORMAL_FROM_CSV = (
    f"SELECT {', '.join(f'coalesce({c}, 0) AS {c}' for c in _FLIGHT_INTS)}, {_TEXT_AS_READ} FROM flown"
)
_PROFILE = _union(
    [
        f"SELECT {i} AS position, '{c}' AS column_name, '{'int' if c in _FLIGHT_INTS else 'string'}' AS data_type, "
        f"count(*) AS n_rows, count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct FROM flown"
        for i, c in enumerate(_FLIGHT_COLUMNS, start=1)
    ]
)
# A file of text has text columns.
_CSV_PROFILE = _PROFILE.replace("'int' AS data_type", "'string' AS data_type")
_SAMPLE = (
    f"SELECT {', '.join(_FLIGHT_COLUMNS)} FROM normal "
    f"ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _FLIGHT_COLUMNS)} LIMIT 5"
)

_DIMENSION_KEYS = {
    "dim_carrier": "carrier_code", "dim_airport": "airport_code", "dim_date": "date_code",
    "dim_route": "route_key", "dim_time": "time_id",
}
_UNIQUENESS = _union(
    [
        f"SELECT '{t}' AS table_name, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_repeated_keys, "
        f"max(n) AS max_rows_per_key FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})"
        for t, k in _DIMENSION_KEYS.items()
    ]
)
_ORPHANS = _union(
    [
        f"SELECT '{k}' AS reference, count(DISTINCT f.{k}) AS n_orphan_keys, count(*) AS n_orphan_facts "
        f"FROM fact_flights f WHERE f.{k} NOT IN (SELECT {k} FROM {t})"
        for t, k in _DIMENSION_KEYS.items()
        if k != "airport_code"
    ]
    + [
        f"SELECT '{role}' AS reference, count(DISTINCT r.{role}) AS n_orphan_keys, count(*) AS n_orphan_facts "
        f"FROM fact_flights f JOIN dim_route r ON f.route_key = r.route_key "
        f"WHERE r.{role} NOT IN (SELECT airport_code FROM dim_airport)"
        for role in ("origin", "destination")
    ]
)

# -- star schema and sinks

_KEYS = """
SELECT 'date' AS kind, concat_ws('|', year, month, day) AS parts,
  sha256(concat_ws('-', year, month, day)) AS safe_key, sha256(concat_ws('', year, month, day)) AS packed_key
FROM (SELECT DISTINCT year, month, day FROM normal)
UNION ALL
SELECT 'route', concat_ws('|', origin, dest, distance),
  sha256(concat_ws('-', origin, dest, distance)), sha256(concat_ws('', origin, dest, distance))
FROM (SELECT DISTINCT origin, dest, distance FROM normal)
"""

_TABLE_COLUMNS = {
    "dim_carrier": "carrier_code carrier_name",
    "dim_airport": "airport_code airport_name city country",
    "dim_date": "date date_code day day_of_month day_of_week day_of_year is_weekend month month_name quarter year",
    "dim_route": "destination distance origin route_key",
    "dim_time": "formatted_time hour minute time_id time_of_day",
    "fact_flights": "air_time carrier_code date_code flight_number is_arrival_delayed is_departure_delayed "
    "route_key tail_number time_id",
    "delay_reasons": "airport_code carrier_cause_delay carrier_code late_aircraft_cause_delay month nas_cause_delay "
    "security_cause_delay total_arrivals total_cancellations total_delays total_diversions weather_cause_delay year",
}


def _digest(table: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in _TABLE_COLUMNS[table].split())
    return (
        f"SELECT '{table}' AS table_name, count(*) AS n_rows, "
        f"CAST(sum(CAST('0x' || substr(sha256(concat_ws('|', {text})), 1, 8) AS BIGINT)) AS BIGINT) AS checksum "
        f"FROM {table}"
    )


# -- reports


def _pct(part: str, whole: str) -> str:
    # Whole numbers only: halves go up, and no fraction is ever stored.
    return f"CAST((20000 * CAST({part} AS HUGEINT) + {whole}) // nullif(2 * {whole}, 0) AS DOUBLE) / 100"


_COUNTS = """count(*) AS total_flights,
  CAST(count_if(is_departure_delayed) AS BIGINT) AS departure_delayed_flights,
  CAST(count_if(is_arrival_delayed) AS BIGINT) AS arrival_delayed_flights"""
_PERCENTAGES = (
    f"{_pct('departure_delayed_flights', 'total_flights')} AS departure_delay_percentage, "
    f"{_pct('arrival_delayed_flights', 'total_flights')} AS arrival_delay_percentage"
)


def _airport_report(role: str, movement: str, flag: str) -> str:
    return f"""
SELECT airport_code, airport_name, city, country, total_{movement}s, delayed_{movement}s,
  {_pct(f"delayed_{movement}s", f"total_{movement}s")} AS {movement}_delay_percentage
FROM (
  SELECT {role} AS airport_code, count(*) AS total_{movement}s, CAST(count_if({flag}) AS BIGINT) AS delayed_{movement}s
  FROM fact_flights JOIN dim_route USING (route_key) GROUP BY {role}
) JOIN dim_airport USING (airport_code)"""


_TOTALS = {
    "total_flights": "total_arrivals", "total_delayed_flights": "total_delays",
    "total_cancelled_flights": "total_cancellations", "total_diverted_flights": "total_diversions",
    "total_carrier_delays": "carrier_cause_delay", "total_weather_delays": "weather_cause_delay",
    "total_nas_delays": "nas_cause_delay", "total_security_delays": "security_cause_delay",
    "total_late_aircraft_delays": "late_aircraft_cause_delay",
}


def _cause_report(keys: str, source: str) -> str:
    sums = ", ".join(f"sum(CAST({m} AS DOUBLE)) AS {t}" for t, m in _TOTALS.items())

    def share(part: str, whole: str) -> str:
        # Through text: a double is rounded from its shortest decimal form, as Spark does it.
        ratio = f"CAST({part} / nullif({whole}, 0) * 100 AS VARCHAR)"
        return f"CAST(TRY_CAST({ratio} AS DECIMAL(38, 2)) AS DOUBLE)"

    shares = [f"{share('total_delayed_flights', 'total_flights')} AS delay_percentage"] + [
        f"{share(f'total_{c}_delays', 'total_delayed_flights')} AS {c}_delay_percentage"
        for c in ("carrier", "weather", "nas", "security", "late_aircraft")
    ]
    return f"SELECT *, {', '.join(shares)} FROM (SELECT {keys}, {sums} FROM {source} GROUP BY {keys})"


_REPORTS = {
    "flights_summary": """
SELECT flight_number, tail_number, carrier_code, carrier_name, date, day_of_week, month, year, quarter,
  origin, destination, distance, formatted_time, time_of_day, is_departure_delayed, is_arrival_delayed
FROM fact_flights JOIN dim_carrier USING (carrier_code) JOIN dim_date USING (date_code)
  JOIN dim_route USING (route_key) JOIN dim_time USING (time_id)""",
    "rp_airport_depart_delays": _airport_report("origin", "departure", "is_departure_delayed"),
    "rp_airport_arrival_delays": _airport_report("destination", "arrival", "is_arrival_delayed"),
    "rp_carrier_delays": f"""
SELECT *, {_PERCENTAGES} FROM (
  SELECT carrier_code, carrier_name, {_COUNTS}
  FROM fact_flights JOIN dim_carrier USING (carrier_code) GROUP BY carrier_code, carrier_name)
ORDER BY carrier_name DESC NULLS FIRST""",
    "rp_monthly_delays": f"""
SELECT *, {_PERCENTAGES} FROM (
  SELECT year, month, {_COUNTS} FROM fact_flights JOIN dim_date USING (date_code) GROUP BY year, month)
ORDER BY year NULLS LAST, month NULLS LAST""",
    "rp_routes_by_delay": f"""
SELECT origin_airport_name, destination_airport_name, total_flights, departure_delayed_flights,
  arrival_delayed_flights, {_PERCENTAGES} FROM (
  SELECT route_key, o.airport_name AS origin_airport_name, d.airport_name AS destination_airport_name, {_COUNTS}
  FROM fact_flights JOIN dim_route USING (route_key)
  JOIN dim_airport o ON o.airport_code = origin JOIN dim_airport d ON d.airport_code = destination
  GROUP BY route_key, o.airport_name, d.airport_name)""",
    "rp_delay_reasons_by_time": _cause_report("year, month", "delay_reasons")
    + " ORDER BY year NULLS LAST, month NULLS LAST",
    "rp_delay_reasons_by_airport": _cause_report(
        "airport_code, airport_name", "delay_reasons JOIN dim_airport USING (airport_code)"
    )
    + " ORDER BY total_delayed_flights DESC NULLS FIRST",
    "delay_reason_summary": """
SELECT delay_reasons.*, carrier_name, airport_name, city, country
FROM delay_reasons JOIN dim_carrier USING (carrier_code) JOIN dim_airport USING (airport_code)""",
}

# -- model inputs

_FEATURES = (
    "carrier_code, origin, destination, distance, air_time, day_of_week, is_weekend, day_of_month, month, time_of_day"
)
_CATEGORIES = "carrier_code origin destination day_of_week month time_of_day".split()
_NUMBERS = "distance air_time day_of_month is_weekend".split()



def _bucket(label: str) -> str:
    return (
        f"CAST(CAST('0x' || substr(sha256(concat_ws('-', {_FEATURES}, {label})), 1, 8) AS BIGINT) % 100 AS INTEGER)"
    )


_LONG_HAUL = "(SELECT *, CAST(distance > 1000 AS DOUBLE) AS is_long_haul FROM model_rows)"
_LABELS = {"arrival": "is_arrival_delayed", "departure": "is_departure_delayed"}


def _trained(model: str, trees: int) -> str:
    """The rows a fit sees and is tried on. A vector has a slot for each value in the training rows, and one per number."""
    return _union(
        [
            f"""
SELECT '{target}' AS target, '{model}' AS model, CAST(count_if(b < 80) AS BIGINT) AS fit_rows, CAST(count_if(b >= 80) AS BIGINT) AS test_rows,
  CAST({' + '.join(f'count(DISTINCT {c}) FILTER (b < 80)' for c in _CATEGORIES)} + {len(_NUMBERS)} AS INTEGER) AS width,
  {trees} AS trees, CAST(0 AS BIGINT) AS n_changed_by_nodes
FROM (SELECT *, {_bucket(label)} AS b FROM model_rows)"""
            for target, label in _LABELS.items()
        ]
    )


# Depths and numbers of trees of the two learners' grids.
_GRIDS = _union(
    [
        f"SELECT '{target}' AS target, '{model}' AS model, {depth} AS max_depth, {trees} AS trees, "
        "true AS auc_valid, true AS best_refitted"
        for target in _LABELS
        for model, sizes in (("RandomForest", (50, 100)), ("GBT", (20, 50)))
        for depth in (5, 10)
        for trees in sizes
    ]
)

_INDEXES = ",".join(
    f"""
i_{c} AS (
  SELECT value, n, row_number() OVER (ORDER BY n DESC, value) - 1 AS idx, count(*) OVER () AS width
  FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n FROM model_rows GROUP BY 1))"""
    for c in _CATEGORIES
)
_WITH_INDEXES = "FROM model_rows m " + " ".join(
    f"JOIN i_{c} ON CAST(m.{c} AS VARCHAR) = i_{c}.value" for c in _CATEGORIES
)


def _with_tables(tables: str, body: str) -> str:
    return _sql("").rstrip() + "," + tables + "\n" + body


def _slots() -> str:
    """One row per vector slot: the categories' values in turn, then the numbers."""
    parts, offset = [], "0"
    for c in _CATEGORIES:
        parts.append(
            f"SELECT CAST({offset} + idx AS INTEGER) AS slot, CAST(n AS DOUBLE) AS total, n AS n_nonzero FROM i_{c}"
        )
        offset += f" + (SELECT count(*) FROM i_{c})"
    for i, name in enumerate(_NUMBERS):
        parts.append(
            f"SELECT CAST({offset} + {i} AS INTEGER), CAST(sum({name}) AS DOUBLE), "
            f"count(*) FILTER (WHERE {name} <> 0) FROM model_rows"
        )
    return _union(parts)


# -- metrics of the rule scores

_RULES = {
    "arrival": [("flown_time", "air_time", 60), ("hour_of_day", "hour", 16),
                ("left_late", "CAST(is_departure_delayed AS INTEGER)", 0)],
    "departure": [("flown_time", "air_time", 60), ("hour_of_day", "hour", 16),
                  ("came_late", "CAST(is_arrival_delayed AS INTEGER)", 0)],
}
_RULE_TABLES = (
    "\nruled AS ("
    + _union(
        [
            f"SELECT '{target}' AS target, '{name}' AS model, {position} AS position, "
            f"is_{target}_delayed AS label, CAST({score} AS DOUBLE) AS score, {score} > {limit} AS called FROM enriched"
            for target, rules in _RULES.items()
            for position, (name, score, limit) in enumerate(rules)
        ]
    )
    + """),
cells AS (
  SELECT target, model, min(position) AS position,
    count(*) FILTER (WHERE label AND called) AS tp, count(*) FILTER (WHERE NOT label AND called) AS fp,
    count(*) FILTER (WHERE NOT label AND NOT called) AS tn, count(*) FILTER (WHERE label AND NOT called) AS fn
  FROM ruled GROUP BY target, model
),
by_class AS (
  SELECT *, CAST(tp + fp + tn + fn AS DOUBLE) AS total,
    coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0,
    coalesce(tp / nullif(tp + fn, 0), 0) AS r1, coalesce(tn / nullif(tn + fp, 0), 0) AS r0
  FROM cells
),
classed AS (
  SELECT target, model, position, tp, fp, tn, fn, (tp + tn) / total AS accuracy,
    (p1 * (tp + fn) + p0 * (tn + fp)) / total AS precision,
    (r1 * (tp + fn) + r0 * (tn + fp)) / total AS recall,
    (coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) * (tp + fn)
      + coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) * (tn + fp)) / total AS f1
  FROM by_class
),
ranked AS (
  SELECT target, model, label, avg(place) OVER (PARTITION BY target, model, score) AS mean_place
  FROM (SELECT *, row_number() OVER (PARTITION BY target, model ORDER BY score) AS place FROM ruled)
),
curves AS (
  SELECT target, model,
    (sum(mean_place) FILTER (WHERE label) - CAST(count(*) FILTER (WHERE label) AS DOUBLE)
      * (count(*) FILTER (WHERE label) + 1) / 2)
      / (CAST(count(*) FILTER (WHERE label) AS DOUBLE) * count(*) FILTER (WHERE NOT label)) AS auc
  FROM ranked GROUP BY target, model
),
measured AS (SELECT * FROM classed JOIN curves USING (target, model))"""
)


def _ruled(body: str) -> str:
    return _with_tables(_RULE_TABLES, body)


_METRICS = ["auc", "accuracy", "precision", "recall", "f1"]


def oracle_sql() -> dict[str, str]:
    """SQL per registered query. For training runs it states what was fitted and tried, not the learner's answers."""
    return {
        "scan_csv": _sql(f"SELECT {_FLIGHTS_TEXT} FROM flown"),
        "conform_schema": _sql(_CONFORMED),
        "null_fill": _sql("SELECT * FROM normal"),
        "normalize_flights": _sql(_NORMAL_FROM_CSV),
        "normalize_delays": _sql("SELECT * FROM delay_cause"),
        "table_profile": _sql(_PROFILE),
        "csv_profile": _sql(_CSV_PROFILE),
        "sample_rows": _sql(_SAMPLE),
        "key_uniqueness": _sql(_UNIQUENESS),
        "key_uniqueness_packed_key": _sql(_UNIQUENESS, sep=""),
        "orphan_facts": _sql(_ORPHANS),
        "surrogate_keys": _sql(_KEYS),
        **{table: _sql(f"SELECT * FROM {table}") for table in _TABLE_COLUMNS},
        "sink_star_roundtrip": _sql(_union([_digest(t) for t in _TABLE_COLUMNS if t != "delay_reasons"])),
        "sink_delays_roundtrip": _sql(_digest("delay_reasons")),
        "report_views": _sql(
            _union([f"SELECT '{n}' AS view_name, count(*) AS n_rows FROM ({q})" for n, q in _REPORTS.items()])
        ),
        **{name: _sql(body) for name, body in _REPORTS.items()},
        "rp_monthly_delays_packed_key": _sql(_REPORTS["rp_monthly_delays"], sep=""),
        "enriched_flights": _sql("SELECT * FROM enriched"),
        "features_arrival": _sql(f"SELECT {_FEATURES}, is_arrival_delayed FROM model_rows"),
        "features_departure": _sql(f"SELECT {_FEATURES}, is_departure_delayed FROM model_rows"),
        "model_row_counts": _sql(
            "SELECT 'arrival' AS target, count(*) AS n_rows FROM model_rows "
            "UNION ALL SELECT 'departure', count(*) FROM model_rows"
        ),
        "split_hash": _sql(
            f"SELECT {_FEATURES}, is_arrival_delayed, {_bucket('is_arrival_delayed')} < 80 AS in_train FROM model_rows"
        ),
        "feature_splits": _sql(
            f"SELECT {_FEATURES}, " + ", ".join(f"{l}, {_bucket(l)} AS {l}_bucket" for l in [*_LABELS.values(), "is_long_haul"])
            + f" FROM {_LONG_HAUL}"
        ),
        "training_frames": _sql(
            _union([
                f"SELECT '{target}' AS target, count(*) AS n_rows, 4 AS n_partitions, true AS held, true AS released "
                f"FROM model_rows WHERE {_bucket(label)} < 80"
                for target, label in _LABELS.items()
            ])
        ),
        "train_rf": _sql(_trained("RandomForest", 100)),
        "train_gbt": _sql(_trained("GBT", 50)),
        "cv_grid": _GRIDS,
        "string_index": _with_tables(
            _INDEXES,
            "SELECT " + ", ".join(f"m.{c}, CAST(i_{c}.idx AS DOUBLE) AS {c}_idx" for c in _CATEGORIES)
            + " " + _WITH_INDEXES,
        ),
        "string_index_tables": _with_tables(
            _INDEXES,
            "SELECT " + ", ".join(f"m.{c}, CAST(i_{c}.idx AS DOUBLE) AS {c}_idx" for c in _CATEGORIES)
            + " " + _WITH_INDEXES,
        ),
        "one_hot": _with_tables(
            _INDEXES,
            "SELECT "
            + ", ".join(
                f"m.{c}, CAST(i_{c}.width AS INTEGER) AS {c}_width, i_{c}.idx AS {c}_slot" for c in _CATEGORIES
            )
            + " " + _WITH_INDEXES,
        ),
        "feature_vector": _with_tables(_INDEXES, _slots()),
        "score_batch": _sql(
            f"SELECT {_FEATURES}, CAST(distance > 1000 AS DOUBLE) AS is_long_haul, "
            "CAST(distance > 1000 AS DOUBLE) AS prediction FROM model_rows"
        ),
        "model_roundtrip": _sql("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM model_rows"),
        "eval_confusion_metrics": _ruled(
            "SELECT target, model, tp, fp, tn, fn, "
            + ", ".join(f"round({m}, 9) AS {m}" for m in _METRICS[1:]) + " FROM measured"
        ),
        "eval_auc": _ruled("SELECT target, model, round(auc, 9) AS auc FROM measured"),
        "eval_planted_model": _sql(
            "SELECT count(*) AS rows, " + ", ".join(f"CAST(1 AS DOUBLE) AS {m}" for m in _METRICS) + " FROM model_rows"
        ),
        "best_model": _ruled(
            "SELECT target, model, round(auc, 9) AS auc FROM (SELECT *, row_number() OVER "
            "(PARTITION BY target ORDER BY auc DESC, position) AS place FROM measured) WHERE place = 1"
        ),
        "metrics_long": _ruled(
            _union([f"SELECT target, model, '{m}' AS metric, round({m}, 9) AS value FROM measured" for m in _METRICS])
        ),
        "run_metrics_json": _ruled(
            "SELECT target, model, " + ", ".join(f"round({m}, 9) AS {m}" for m in _METRICS) + " FROM measured"
        ),
    }
