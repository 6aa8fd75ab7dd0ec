"""The queries of ``catalog`` as SQL for an independent engine, over the same tables.

Where the library reduces before it joins or searches, the SQL here states the
question in its plainest form instead: all pairs of legs, all pairs of values.
"""

from __future__ import annotations

FLIGHTS = """
WITH flights AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS varchar) AS flight_num,
         lpad(CAST(l_partkey % 25 AS varchar), 2, '0') AS carrier,
         concat('N', lpad(CAST(s_nationkey AS varchar), 2, '0')) AS origin,
         concat('N', lpad(CAST(c_nationkey AS varchar), 2, '0')) AS dest,
         CAST(l_shipdate AS date) AS flight_day,
         CAST(CAST(l_shipdate AS date) AS varchar) AS flight_date,
         lpad(CAST((l_partkey % 24) * 100 AS varchar), 4, '0') AS dep_time,
         CASE WHEN l_partkey % 24 < 12 THEN 'AM' ELSE 'PM' END AS half_day,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL
              ELSE CAST(CAST(l_quantity AS int) - 20 AS double) END AS dep_delay,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN NULL
              ELSE CAST(CAST(l_quantity AS int) - 20 + CAST(round(l_tax * 100) AS int)
                   - CAST(round(l_discount * 100) AS int) AS double) END AS arr_delay
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
)"""

EVENTS = """
WITH flights AS (
  SELECT CAST(event_id AS varchar) AS flight_num,
         upper(substr(event_type, 1, 2)) AS carrier,
         concat('E', lpad(CAST(user_id % 20 AS varchar), 2, '0')) AS origin,
         concat('E', lpad(CAST(event_id % 20 AS varchar), 2, '0')) AS dest,
         CAST(ts AS date) AS flight_day,
         CAST(CAST(ts AS date) AS varchar) AS flight_date,
         strftime(ts, '%H%M') AS dep_time,
         CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS half_day,
         date_trunc('minute', ts) AS departed,
         CASE WHEN event_id % 40 <> 0 THEN CAST(floor(value) - 20 AS double) END AS dep_delay,
         CASE WHEN event_id % 40 <> 0
              THEN CAST(floor(value) - 25 + event_id % 11 AS double) END AS arr_delay
  FROM events
)"""

MOVEMENTS = """,
counts AS (
  SELECT airport, count(*) AS n
  FROM (SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights) GROUP BY airport
)"""

BEST = """,
best AS (
  SELECT * EXCLUDE place FROM (
    SELECT *, row_number() OVER (PARTITION BY origin, dest, flight_date, half_day
                                 ORDER BY arr_delay, carrier, flight_num, dep_time) AS place
    FROM flights WHERE arr_delay IS NOT NULL)
  WHERE place = 1
)"""

PARTS = "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey"


def _means(keys: str, metric: str) -> str:
    return f"SELECT {keys}, avg({metric}) AS mean_delay FROM flights WHERE {metric} IS NOT NULL"


def _top(base: str, keys: str, metric: str, where: str = "", order: str = "ASC") -> str:
    entity = keys.split(", ")[-1]
    return (
        f"{base} {_means(keys, metric)} {where} GROUP BY {keys} "
        f"ORDER BY mean_delay {order}, {entity} LIMIT 10"
    )


def _top_all(base: str, by: str, entity: str, metric: str) -> str:
    return f"""{base}, means AS ({_means(f"{by}, {entity}", metric)} GROUP BY {by}, {entity})
SELECT {by}, {entity}, mean_delay, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY mean_delay, {entity}) AS rank FROM means)
WHERE rank <= 10"""


def _trips(base: str, closed: str = "") -> str:
    """All pairs of legs of each trip, then the best one."""
    return f"""{base}
SELECT origin, stop, dest, flight_date,
       leg1_arr_delay, leg1_carrier, leg1_flight_num, leg1_dep_time,
       leg2_arr_delay, leg2_carrier, leg2_flight_num, leg2_dep_time, total_delay
FROM (
  SELECT *, row_number() OVER (
      PARTITION BY origin, stop, dest, flight_date
      ORDER BY total_delay, leg1_arr_delay, leg1_carrier, leg1_flight_num, leg1_dep_time,
               leg2_carrier, leg2_flight_num, leg2_dep_time) AS place
  FROM (
    SELECT a.origin, a.dest AS stop, b.dest, a.flight_date,
           a.arr_delay AS leg1_arr_delay, a.carrier AS leg1_carrier,
           a.flight_num AS leg1_flight_num, a.dep_time AS leg1_dep_time,
           b.arr_delay AS leg2_arr_delay, b.carrier AS leg2_carrier,
           b.flight_num AS leg2_flight_num, b.dep_time AS leg2_dep_time,
           a.arr_delay + b.arr_delay AS total_delay
    FROM flights a JOIN flights b ON a.dest = b.origin AND b.flight_day = a.flight_day + 2
    WHERE a.half_day = 'AM' AND b.half_day = 'PM'
      AND a.arr_delay IS NOT NULL AND b.arr_delay IS NOT NULL {closed}))
WHERE place = 1"""


def _legs(delay: str) -> str:
    columns = "origin, dest, flight_date, dep_time, carrier, flight_num"
    return f"""{FLIGHTS}, legs AS (
  SELECT CAST(1 AS bigint) AS leg, {columns}, {delay} AS arr_delay FROM flights
  WHERE origin = 'N06' AND dest = 'N09' AND flight_day = DATE '1995-10-06'
  UNION ALL
  SELECT CAST(2 AS bigint) AS leg, {columns}, {delay} AS arr_delay FROM flights
  WHERE origin = 'N09' AND dest = 'N04' AND flight_day = DATE '1995-10-08')
SELECT * FROM legs WHERE arr_delay IS NOT NULL"""


def _number_text(column: str) -> str:
    return f"concat(CAST(CAST({column} AS bigint) AS varchar), '.0')"


def _decimal_text(column: str, halvings: int) -> str:
    """``column`` / 2**halvings written out: 10**halvings times it is whole."""
    digits = f"lpad(CAST(CAST(abs({column}) AS hugeint) * {5 ** halvings} AS varchar), {halvings + 12}, '0')"
    whole = f"CAST(CAST(substr({digits}, 1, 12) AS bigint) AS varchar)"
    rest = f"regexp_replace(substr({digits}, 13), '(.)0+$', '\\1')"
    return f"CASE WHEN {column} = 0 THEN '0.0' ELSE concat(CASE WHEN {column} < 0 THEN '-' ELSE '' END, {whole}, '.', {rest}) END"


def _fit(samples: str) -> str:
    """The best power law of the column ``n`` of ``samples``, as the table ``fit``."""
    return f"""WITH RECURSIVE samples AS ({samples}),
v AS (SELECT CAST(n AS double) AS x, count(*) AS n FROM samples GROUP BY samples.n),
c AS (
  SELECT m.x AS m, sum(t.n) AS n_tail, sum(t.n * ln(t.x / m.x)) AS s
  FROM v m JOIN v t ON t.x >= m.x WHERE m.x < (SELECT max(x) FROM v) GROUP BY m.x),
a AS (SELECT m, n_tail, 1 + n_tail / s AS alpha FROM c),
below AS (SELECT x, sum(n) OVER (ORDER BY x) - n AS b FROM v),
d AS (
  SELECT a.m, max(abs((t.b - o.b) / n_tail - (1 - pow(t.x / a.m, 1 - alpha)))) AS d
  FROM a JOIN below o ON o.x = a.m JOIN below t ON t.x >= a.m GROUP BY a.m),
fit AS (
  SELECT a.m AS xmin, CAST(n_tail AS bigint) AS n_tail, alpha, d
  FROM a JOIN d ON a.m = d.m ORDER BY d.d, a.m LIMIT 1)"""


def _upper(z: str) -> str:
    """The share of a standard normal above ``z``, by the series of erf, whose terms have one sign."""
    x = f"(abs({z}) / sqrt(2.0))"
    # The logarithm of term k; for k = 0 the inner list is empty and its sum NULL.
    odd = "coalesce(list_sum(list_transform(range(1, k + 1), lambda i: ln(2 * i + 1.0))), 0)"
    term = f"exp(k * ln(2 * {x} * {x} + 1e-300) - {odd})"
    series = f"list_sum(list_transform(range(0, 150), lambda k: {term}))"
    return f"(0.5 * (1 - sign({z}) * 2 / sqrt(pi()) * exp(-{x} * {x}) * {x} * {series}))"


def _lognormal(samples: str) -> str:
    """Power law against lognormal: the cut normal's moments are met by bisection."""
    hazard = f"(exp(-0.5 * a * a) / sqrt(2 * pi()) / {_upper('a')})"
    return f"""{_fit(samples)},
tail AS (SELECT v.n, ln(v.x / xmin) AS y FROM v, fit WHERE v.x >= xmin),
moments AS (SELECT sum(n * y) / sum(n) AS m1, sum(n * y * y) / sum(n) AS m2 FROM tail),
search(step, low, high) AS (
  SELECT 0, CAST(-6 AS double), CAST(4 AS double)
  UNION ALL
  SELECT step + 1,
         CASE WHEN (1 - a * (h - a)) / ((h - a) * (h - a)) < m2 / (m1 * m1) THEN a ELSE low END,
         CASE WHEN (1 - a * (h - a)) / ((h - a) * (h - a)) < m2 / (m1 * m1) THEN high ELSE a END
  FROM (SELECT *, {hazard} AS h FROM (SELECT *, (low + high) / 2 AS a FROM search WHERE step < 52)), moments),
cut AS (
  SELECT -a * m1 / (h - a) AS mu, m1 / (h - a) AS sigma, ln({_upper('a')}) AS ln_c
  FROM (SELECT *, {hazard} AS h FROM (SELECT low AS a FROM search WHERE step = 52)), moments),
gaps AS (
  SELECT tail.n, ln(alpha - 1) - (alpha - 1) * y
         + ln(sigma) + 0.5 * ln(2 * pi()) + pow((y - mu) / sigma, 2) / 2 + ln_c AS gap
  FROM tail, fit, cut),
total AS (SELECT sum(n * gap) AS t, sum(n * gap) / sum(n) AS mean FROM gaps),
tested AS (SELECT any_value(t) / sqrt(sum(n * pow(gap - mean, 2))) AS ratio FROM gaps, total)
SELECT xmin, n_tail, round(alpha, 6) AS alpha, round(d, 6) AS d, round(mu + ln(xmin), 6) AS mu,
       round(sigma, 6) AS sigma, round(ratio, 6) AS ratio,
       round(2 * {_upper('abs(ratio)')}, 6) AS p_value,
       CASE WHEN ratio < 0 THEN 'lognormal' WHEN ratio > 0 THEN 'power_law' ELSE 'neither' END AS favoured
FROM fit, cut, tested"""


# The parts of a feed: six days each.
BATCHES = """, parts AS (SELECT *, CAST((day(flight_day) - 1) // 6 AS bigint) AS batch_id FROM flights)"""

# A broken CSV: the lines, and what is wrong with each.
BROKEN = """, numbered AS (SELECT *, CAST(flight_num AS bigint) AS i FROM flights),
shown AS (
  SELECT *, CASE WHEN i % 17 = 0 THEN '2008-13-45' ELSE flight_date END AS day_text,
         CASE WHEN i % 23 = 0 THEN concat(carrier, ',?') ELSE carrier END AS carrier_text,
         CASE WHEN i % 19 = 0 THEN '2575' ELSE dep_time END AS time_text,
         CASE WHEN i % 13 = 0 THEN 'abc' ELSE coalesce(CAST(dep_delay AS varchar), '') END AS delay_text
  FROM numbered)"""


def _per_batch(sql: str) -> str:
    return f"SELECT *, CAST(0 AS bigint) AS batch_id FROM ({sql})"


ORACLES: dict[str, str] = {
    "airport_popularity": f"""{FLIGHTS}{MOVEMENTS}
SELECT airport, n FROM counts ORDER BY n DESC, airport LIMIT 10""",
    "popularity_full_ranking": f"""{FLIGHTS}{MOVEMENTS}
SELECT airport, n, {_number_text('n')} AS n_text FROM counts""",
    "carrier_arrival_topk": _top(FLIGHTS, "carrier", "arr_delay"),
    "carrier_arrival_bottomk": _top(FLIGHTS, "carrier", "arr_delay", order="DESC"),
    "carrier_arrival_parity": _top(
        FLIGHTS, "carrier", "arr_delay", "AND length(CAST(CAST(arr_delay AS int) AS varchar)) > 1"
    ),
    "origin_carrier_topk": f"""SELECT carrier, mean_delay, origin FROM
({_top(FLIGHTS, "origin, carrier", "dep_delay", "AND origin = 'N09'")})""",
    "origin_carrier_topk_all": _top_all(FLIGHTS, "origin", "carrier", "dep_delay"),
    "origin_dest_topk": _top(FLIGHTS, "origin, dest", "dep_delay", "AND origin = 'N09'"),
    "origin_dest_topk_all": _top_all(FLIGHTS, "origin", "dest", "dep_delay"),
    "route_carrier_topk": _top(
        FLIGHTS, "origin, dest, carrier", "arr_delay", "AND origin = 'N09' AND dest = 'N11'"
    ),
    "route_carrier_topk_all": _top_all(FLIGHTS, "origin, dest", "carrier", "arr_delay"),
    "route_carrier_topk_departure": _top_all(FLIGHTS, "origin, dest", "carrier", "dep_delay"),
    "route_carrier_malformed_codes": f"""{FLIGHTS}, coded AS (
  SELECT * EXCLUDE (carrier, origin),
         CASE WHEN CAST(flight_num AS bigint) % 7 = 0 THEN substr(carrier, 1, 1) ELSE carrier END AS carrier,
         CASE WHEN CAST(flight_num AS bigint) % 11 = 0 THEN concat(origin, 'X') ELSE origin END AS origin
  FROM flights),
means AS (
  SELECT origin, dest, carrier, avg(arr_delay) AS mean_delay FROM coded
  WHERE arr_delay IS NOT NULL AND length(carrier) = 2 AND length(origin) = 3
  GROUP BY origin, dest, carrier)
SELECT origin, dest, carrier, mean_delay, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY origin, dest ORDER BY mean_delay, carrier) AS rank FROM means)
WHERE rank <= 10""",
    "popularity_short_lines": f"""{FLIGHTS}
SELECT airport, count(*) AS n FROM (
  SELECT origin AS airport, flight_num FROM flights UNION ALL SELECT dest, flight_num FROM flights)
WHERE CAST(flight_num AS bigint) % 4 <> 0 GROUP BY airport""",
    "odd_departure_times": f"""{FLIGHTS}, given AS (
  SELECT flight_num, flight_day, CAST(flight_num AS bigint) % 10 AS d, dep_time FROM flights),
timed AS (
  SELECT *, CASE d WHEN 0 THEN '2400' WHEN 1 THEN '2460' WHEN 2 THEN '1275' WHEN 3 THEN '9999'
                   WHEN 4 THEN '5' ELSE dep_time END AS text FROM given),
kept AS (SELECT *, CASE WHEN d IN (1, 2, 3) THEN NULL ELSE lpad(text, 4, '0') END AS t FROM timed)
SELECT flight_num, text, t AS dep_time,
       CASE WHEN t < '1200' THEN 'AM' WHEN t IS NOT NULL THEN 'PM' END AS half_day,
       strftime(flight_day + to_hours(CAST(substr(t, 1, 2) AS int)) + to_minutes(CAST(substr(t, 3, 2) AS int)),
                '%Y-%m-%d %H:%M:%S') AS departed
FROM kept""",
    "mean_texts": f"""{FLIGHTS}, means AS ({_means("origin, carrier", "arr_delay")} GROUP BY origin, carrier),
scaled AS (SELECT origin, carrier, floor(mean_delay * 64) AS s FROM means)
SELECT origin, carrier, {_decimal_text('s', 6)} AS mean_text, {_decimal_text('s', 16)} AS small_text,
       concat(CAST(CAST(s * 262144 AS bigint) AS varchar), '.0') AS large_text FROM scaled""",
    "fractional_mean_delay": f"""{FLIGHTS}
SELECT origin, carrier, mean_delay AS mean_by_number, mean_delay AS mean_by_day FROM (
  SELECT origin, carrier,
         CAST(sum(CAST((arr_delay * 100 + CAST(flight_num AS bigint) % 100) / 100 AS decimal(18, 2))) AS double)
           / count(*) AS mean_delay
  FROM flights WHERE arr_delay IS NOT NULL GROUP BY origin, carrier)""",
    "carrier_places": f"""{FLIGHTS}, means AS (
  {_means("origin, dest, carrier", "arr_delay")} GROUP BY origin, dest, carrier)
SELECT *, row_number() OVER (ORDER BY mean_delay, origin, dest, carrier) AS place,
       rank() OVER (ORDER BY mean_delay) AS tied_place FROM means""",
    "airport_places": f"""{FLIGHTS}{MOVEMENTS}
SELECT airport, n, row_number() OVER (ORDER BY n DESC, airport) AS place, rank() OVER (ORDER BY n DESC) AS tied_place
FROM counts""",
    "one_trip": f"""SELECT * FROM ({_trips(FLIGHTS, "AND a.origin = 'N06' AND a.dest = 'N09' AND b.dest = 'N04' AND a.flight_date = '1995-10-06'")})""",
    "result_messages_all": f"""SELECT carrier AS key, mean_delay AS metric, 'carriers' AS question
FROM ({_top(FLIGHTS, "carrier", "arr_delay")})
UNION ALL SELECT carrier, mean_delay, 'carriers_from'
FROM ({_top(FLIGHTS, "origin, carrier", "dep_delay", "AND origin = 'N09'")})
UNION ALL SELECT concat(origin, ' ', carrier), mean_delay, 'carriers_from_all'
FROM ({_top_all(FLIGHTS, "origin", "carrier", "dep_delay")})
UNION ALL SELECT dest, mean_delay, 'destinations_from'
FROM ({_top(FLIGHTS, "origin, dest", "dep_delay", "AND origin = 'N09'")})
UNION ALL SELECT concat(origin, ' ', dest), mean_delay, 'destinations_from_all'
FROM ({_top_all(FLIGHTS, "origin", "dest", "dep_delay")})
UNION ALL SELECT carrier, mean_delay, 'carriers_on_route'
FROM ({_top(FLIGHTS, "origin, dest, carrier", "arr_delay", "AND origin = 'N09' AND dest = 'N11'")})
UNION ALL SELECT concat(origin, ' ', dest, ' ', carrier), mean_delay, 'carriers_on_route_all'
FROM ({_top_all(FLIGHTS, "origin, dest", "carrier", "arr_delay")})""",
    "latest_through_store": """SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) WHERE place = 1""",
    "latest_through_store_daily": """SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) WHERE place = 1""",
    "route_mean_delay": f"""{FLIGHTS} {_means("origin, dest", "arr_delay")} GROUP BY origin, dest""",
    "best_flight_on_date": f"""{FLIGHTS}{BEST}
SELECT origin, dest, flight_date, half_day, arr_delay, carrier, flight_num, dep_time FROM best""",
    "best_flight_on_route_date": f"""{FLIGHTS}
SELECT origin, dest, flight_date, half_day, carrier, flight_num, dep_time, arr_delay FROM flights
WHERE origin = 'N06' AND dest = 'N09' AND flight_day = DATE '1995-10-06' AND half_day = 'AM'
  AND arr_delay IS NOT NULL""",
    "leg_search": _legs("arr_delay"),
    "leg_search_blank_as_zero": _legs("coalesce(arr_delay, 0.0)"),
    "two_leg_best": _trips(FLIGHTS),
    "date_shift": """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS travel_text,
  strftime(o_orderdate, '%Y-%m-%d') AS travel_date,
  strftime(o_orderdate + INTERVAL 2 DAY, '%Y-%m-%d') AS second_leg_date FROM orders""",
    "parse_flight_csv": f"""{FLIGHTS}
SELECT flight_num, carrier, origin, dest, flight_date, dep_time, dep_delay, arr_delay FROM flights""",
    "parse_flight_rejects": f"""{FLIGHTS}
SELECT flight_num, CAST(40 AS bigint) AS n_fields FROM flights WHERE arr_delay IS NULL""",
    "parse_key_metric_tsv": f"""{FLIGHTS}{MOVEMENTS}
SELECT airport AS key, CAST(n AS double) AS metric FROM counts""",
    "parse_composite_tsv": f"""{FLIGHTS} {_means("origin, carrier", "dep_delay")}
GROUP BY origin, carrier""",
    "parse_best_flight_tsv": f"""{FLIGHTS}{BEST}
SELECT origin, dest, flight_date, half_day, carrier, CAST(flight_num AS double) AS flight_num,
       dep_time, arr_delay AS mean_delay FROM best""",
    "result_records": f"""SELECT origin AS origin_airport, dest AS dest_airport,
  mean_delay AS average_arrival_delay FROM ({_top_all(FLIGHTS, "origin", "dest", "dep_delay")})""",
    "result_records_carriers": f"""SELECT origin AS origin_airport, carrier,
  mean_delay AS average_arrival_delay FROM ({_top_all(FLIGHTS, "origin", "carrier", "dep_delay")})""",
    "result_records_best_flight": f"""{FLIGHTS}{BEST}
SELECT origin AS origin_airport, dest AS dest_airport, flight_date AS date, half_day AS am_pm,
  carrier, flight_num AS flight_number, dep_time AS time, arr_delay AS average_departure_delay
FROM best""",
    "result_records_delays": f"""{FLIGHTS}
SELECT dest AS airport, carrier, avg(arr_delay) AS average_departure_delay FROM flights
WHERE arr_delay IS NOT NULL GROUP BY dest, carrier""",
    "result_message_roundtrip": f"""SELECT concat(origin, ' ', carrier) AS key, mean_delay AS metric
FROM ({_top_all(FLIGHTS, "origin", "carrier", "dep_delay")})""",
    "latest_result_upsert": """SELECT user_id, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) WHERE place = 1""",
    "flight_report_lines": f"""{FLIGHTS}{BEST}
SELECT concat(origin, ' -> ', dest, ' on ', flight_date, ': Flight: ', carrier, ' ', flight_num,
  ' at ', dep_time, '. Arrival Delay: ', {_number_text('arr_delay')}) AS line FROM best""",
    "popularity_ccdf": f"""WITH parts AS ({PARTS}),
v AS (SELECT CAST(n AS double) AS x, count(*) AS n FROM parts GROUP BY parts.n)
SELECT x, n, CAST(sum(n) OVER (ORDER BY x DESC) AS double)
  / CAST((SELECT sum(n) FROM v) AS double) AS p_ge FROM v""",
    "powerlaw_alpha": f"""WITH parts AS ({PARTS})
SELECT CAST(m AS double) AS xmin, n_tail, round(1 + n_tail / (s - n_tail * ln(m)), 6) AS alpha
FROM (SELECT min(n) AS m, count(*) AS n_tail, sum(ln(n)) AS s FROM parts)""",
    "powerlaw_fit": f"""WITH parts AS ({PARTS}),
v AS (SELECT CAST(n AS double) AS x, count(*) AS n FROM parts GROUP BY parts.n),
c AS (
  SELECT m.x AS m, sum(t.n) AS n_tail, sum(t.n * ln(t.x / m.x)) AS s
  FROM v m JOIN v t ON t.x >= m.x WHERE m.x < (SELECT max(x) FROM v) GROUP BY m.x),
a AS (SELECT m, n_tail, 1 + n_tail / s AS alpha FROM c),
seen AS (
  SELECT a.m, t.x, (SELECT coalesce(sum(u.n), 0) FROM v u WHERE u.x >= a.m AND u.x < t.x) / n_tail AS f
  FROM a JOIN v t ON t.x >= a.m),
d AS (
  SELECT a.m, max(abs(f - (1 - pow(seen.x / a.m, 1 - alpha)))) AS d
  FROM a JOIN seen ON a.m = seen.m GROUP BY a.m)
SELECT a.m AS xmin, CAST(n_tail AS bigint) AS n_tail, round(alpha, 6) AS alpha, round(d, 6) AS d
FROM a JOIN d ON a.m = d.m ORDER BY d.d, a.m LIMIT 1""",
    # Sums over tails by a window; the distances of all pairs of values as they are.
    "powerlaw_fit_prices": """WITH v AS (SELECT l_extendedprice + 1 AS x, count(*) AS n FROM lineitem GROUP BY ALL),
c AS (
  SELECT x AS m, n, CAST(sum(n) OVER up AS bigint) AS n_tail, sum(n * ln(x)) OVER up AS s,
         CAST(sum(n) OVER (ORDER BY x) AS bigint) - n AS below
  FROM v WINDOW up AS (ORDER BY x DESC)),
a AS (SELECT *, s - n_tail * ln(m) AS excess FROM c WHERE m < (SELECT max(x) FROM v)),
d AS (
  SELECT a.m, any_value(a.n_tail) AS n_tail, any_value(a.n_tail / a.excess) AS beta,
         max(abs(CAST(t.below - a.below AS double) / a.n_tail - 1 + pow(t.m / a.m, -a.n_tail / a.excess))) AS d
  FROM a JOIN c t ON t.m >= a.m WHERE a.excess > 0 GROUP BY a.m)
SELECT m AS xmin, n_tail, round(1 + beta, 6) AS alpha, round(d, 6) AS d FROM d ORDER BY d.d, m LIMIT 1""",
    "lognormal_fit_orders": _lognormal("SELECT floor(o_totalprice / 1000) + 1 AS n FROM orders"),
    "stream_popularity_running": f"""{EVENTS}{MOVEMENTS}
SELECT airport, n FROM counts ORDER BY n DESC, airport LIMIT 10""",
    "stream_carrier_running": _top(EVENTS, "carrier", "arr_delay"),
    "stream_popularity_tumbling": f"""{EVENTS}, ends AS (
  SELECT date_trunc('hour', departed) AS h, origin AS airport FROM flights
  UNION ALL SELECT date_trunc('hour', departed), dest FROM flights)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS window_start, airport, count(*) AS n FROM ends
GROUP BY h, airport""",
    "stream_batch_rank": _per_batch(f"""{EVENTS}{MOVEMENTS}
SELECT airport, n FROM counts ORDER BY n DESC, airport LIMIT 10"""),
    "stream_origin_carrier": _per_batch(_top_all(EVENTS, "origin", "carrier", "dep_delay")),
    "stream_origin_dest": _per_batch(_top_all(EVENTS, "origin", "dest", "dep_delay")),
    "stream_route_carrier": _per_batch(_top_all(EVENTS, "origin, dest", "carrier", "arr_delay")),
    "stream_two_leg": _trips(EVENTS),
    "stream_rate_limited": f"""{EVENTS}{BATCHES}, means AS (
  SELECT batch_id, origin, carrier, avg(dep_delay) AS mean_delay FROM parts
  WHERE dep_delay IS NOT NULL GROUP BY batch_id, origin, carrier)
SELECT batch_id, origin, carrier, mean_delay, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id, origin ORDER BY mean_delay, carrier) AS rank FROM means)
WHERE rank <= 10""",
    "stream_trips_in_batches": _trips(EVENTS),
    "stream_messages_sent_twice": f"""{EVENTS}{BATCHES}, means AS (
  SELECT batch_id, carrier, avg(arr_delay) AS mean_delay FROM parts WHERE arr_delay IS NOT NULL GROUP BY batch_id, carrier)
SELECT batch_id, carrier AS key, mean_delay AS metric FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY mean_delay, carrier) AS place FROM means)
WHERE place <= 10""",
    "stream_windows_and_late_rows": f"""{EVENTS}{BATCHES}, ends AS (
  SELECT xor(batch_id, 1) AS batch_id, flight_day, departed, origin AS airport FROM parts
  UNION ALL SELECT xor(batch_id, 1), flight_day, departed, dest FROM parts),
latest AS (SELECT batch_id, max(departed) AS latest FROM ends GROUP BY batch_id),
limits AS (
  SELECT batch_id, max(latest) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - INTERVAL 2 DAY AS late_before FROM latest)
SELECT strftime(flight_day, '%Y-%m-%d 00:00:00') AS window_start, airport,
       count(*) FILTER (WHERE NOT coalesce(flight_day + INTERVAL 1 DAY <= late_before, false)) AS n_in_time,
       count(*) FILTER (WHERE flight_day + INTERVAL 1 DAY <= late_before) AS n_late
FROM ends JOIN limits USING (batch_id) GROUP BY flight_day, airport""",
    "csv_usable_rows": f"""{FLIGHTS}{BROKEN}
SELECT flight_num, carrier, origin, dest, flight_date, dep_time, dep_delay, arr_delay FROM shown
WHERE i % 13 <> 0 AND i % 17 <> 0 AND i % 19 <> 0 AND i % 23 <> 0""",
    "csv_rejected_rows": f"""{FLIGHTS}{BROKEN}
SELECT concat_ws(',', day_text, carrier_text, flight_num, origin, dest, time_text, delay_text,
                 coalesce(CAST(arr_delay AS varchar), '')) AS record,
       CASE WHEN i % 23 = 0 THEN 'number of fields' ELSE concat_ws('; ',
         CASE WHEN i % 17 = 0 THEN 'flight_date: 2008-13-45' END, CASE WHEN i % 19 = 0 THEN 'dep_time: 2575' END,
         CASE WHEN i % 13 = 0 THEN 'dep_delay: abc' END) END AS problems
FROM shown WHERE i % 13 = 0 OR i % 17 = 0 OR i % 19 = 0 OR i % 23 = 0""",
    "stream_latest_in_batches": f"""{EVENTS}, parts AS (
  SELECT *, CAST((day(flight_day) - 1) // 8 AS bigint) AS batch_id FROM flights WHERE arr_delay IS NOT NULL),
means AS (SELECT batch_id, carrier, avg(arr_delay) AS mean_delay FROM parts GROUP BY batch_id, carrier),
best AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY mean_delay, carrier) AS place FROM means)
SELECT carrier, mean_delay FROM (
  SELECT *, row_number() OVER (PARTITION BY carrier ORDER BY batch_id DESC) AS latest FROM best WHERE place <= 10)
WHERE latest = 1""",
    "stream_windows_in_batches": f"""{EVENTS}, ends AS (
  SELECT date_trunc('hour', departed) AS h, origin AS airport FROM flights
  UNION ALL SELECT date_trunc('hour', departed), dest FROM flights)
SELECT strftime(h, '%Y-%m-%d %H:%M:%S') AS window_start, airport, count(*) AS n FROM ends
GROUP BY h, airport""",
    "stream_latest_results": _per_batch(_top(EVENTS, "carrier", "arr_delay")),
}
