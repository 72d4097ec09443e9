"""DuckDB statements that compute each registered query on the same tables.

Shared sub-results are named once in ``_PARTS``; a statement carries the ones
it mentions as common table expressions.
"""

from __future__ import annotations

import re

_PARTS: dict[str, str] = {}


def _part(name: str, body: str) -> None:
    _PARTS[name] = body.strip()


# The bound feeds ------------------------------------------------------------------------

_part("numbered_lines", """
SELECT lineitem.*, o_custkey, o_orderdate, o_orderstatus,
       row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
                          l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                          l_shipdate) AS booking_id
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")

_part("bookings", """
SELECT booking_id, o_custkey AS passenger_id, l_partkey AS flight_id,
       o_orderdate::DATE AS booking_date, l_shipdate::DATE AS travel_date,
       CASE l_linenumber WHEN 5 THEN 'Premium Economy' WHEN 6 THEN 'Business'
            WHEN 7 THEN 'First' ELSE 'Economy' END AS fare_class,
       l_extendedprice::DECIMAL(12,2) AS fare_amount,
       (l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(4,2))::DECIMAL(12,2) AS tax_amount,
       CASE o_orderstatus WHEN 'F' THEN 'Confirmed' WHEN 'O' THEN 'Cancelled'
            ELSE 'NoShow' END AS booking_status,
       l_quantity::INTEGER AS miles_earned
FROM numbered_lines""")

_part("flights", """
SELECT p_partkey AS flight_id, 'F' || (p_partkey % 100000000) AS flight_number,
       DATE '1995-01-01' + p_size AS flight_date,
       'A' || lpad((p_partkey % 25)::VARCHAR, 2, '0') AS origin_airport_code,
       'A' || lpad(((p_partkey + p_size) % 25)::VARCHAR, 2, '0') AS dest_airport_code,
       p_brand AS aircraft_code
FROM part""")

_part("aircraft", """
SELECT p_brand AS aircraft_code, p_brand AS model, min(p_type) AS manufacturer,
       max(p_size) AS seat_capacity
FROM part GROUP BY p_brand""")

_part("passengers", """
SELECT c_custkey AS passenger_id, c_name AS passenger_name,
       'A' || lpad((c_nationkey % 25)::VARCHAR, 2, '0') AS home_airport_code,
       c_mktsegment AS frequent_flyer_tier,
       DATE '1995-01-01' + (c_custkey % 1000)::INTEGER AS signup_date
FROM customer""")

_part("airports", """
SELECT 'A' || lpad((n_nationkey % 25)::VARCHAR, 2, '0') AS airport_code, n_name AS airport_name,
       'CITY_' || r_regionkey || '_' || (n_nationkey % 10) AS city, r_name AS country,
       CASE WHEN r_regionkey < 2 THEN 'WEST' ELSE 'EAST' END AS region
FROM nation JOIN region ON r_regionkey = n_regionkey""")

_part("staged", """
SELECT passenger_id, passenger_name,
       CASE WHEN passenger_id % 11 = 0 
            THEN 'A' || lpad(((home_airport_code[2:]::INTEGER + 1) % 25)::VARCHAR, 2, '0')
            ELSE home_airport_code END AS home_airport_code,
       CASE WHEN passenger_id % 7 = 0 THEN frequent_flyer_tier || '_PLUS'
            ELSE frequent_flyer_tier END AS frequent_flyer_tier
FROM passengers
WHERE passenger_id % 7 = 0 OR passenger_id % 11 = 0 OR passenger_id % 13 = 0
UNION ALL
SELECT passenger_id + 900000000000, passenger_name, home_airport_code, frequent_flyer_tier
FROM passengers WHERE passenger_id % 30 = 0""")

# Dimensions ------------------------------------------------------------------------------

_part("days", """
SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31',
                              INTERVAL 1 DAY))::DATE AS d""")

_part("dates", """
SELECT strftime(d, '%Y%m%d')::INTEGER AS date_key, d AS full_date, year(d)::INTEGER AS year,
       quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month, monthname(d) AS month_name,
       day(d)::INTEGER AS day_of_month, isodow(d)::INTEGER AS day_of_week,
       dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend,
       strftime(d, '%Y%m')::INTEGER AS month_key
FROM days""")

_part("flat_airports", """
SELECT row_number() OVER (ORDER BY airport_code)::INTEGER AS airport_key, *
FROM airports""")

_part("keyed_aircraft", """
SELECT row_number() OVER (ORDER BY aircraft_code)::INTEGER AS aircraft_key, *
FROM aircraft""")

_part("keyed_flights", """
SELECT row_number() OVER (ORDER BY flight_id)::INTEGER AS flight_key, flight_id, flight_number,
       flight_date
FROM flights""")

_part("first_versions", """
SELECT row_number() OVER (ORDER BY passenger_id)::INTEGER AS passenger_key, passengers.*,
       DATE '1900-01-01' AS effective_from, DATE '9999-12-31' AS effective_to,
       TRUE AS is_current
FROM passengers""")

_part("countries", """
SELECT row_number() OVER (ORDER BY country_name)::INTEGER AS country_key, country_name, region
FROM (SELECT DISTINCT country AS country_name, region FROM airports)""")

_part("cities", """
SELECT row_number() OVER (ORDER BY country_key, city_name)::INTEGER AS city_key, city_name,
       country_key
FROM (SELECT DISTINCT city AS city_name, country_key
      FROM airports JOIN countries ON country_name = country)""")

_part("geo", """
SELECT airport_key, airport_code, airport_name, city_key, city_name, country_name,
       countries.region
FROM flat_airports
JOIN countries ON country_name = flat_airports.country
JOIN cities ON cities.country_key = countries.country_key AND city_name = flat_airports.city""")

# Fact ------------------------------------------------------------------------------------

_part("sales", """
SELECT b.date_key AS booking_date_key, t.date_key AS travel_date_key, passenger_key, flight_key,
       o.airport_key AS origin_airport_key, a.airport_key AS dest_airport_key, aircraft_key,
       booking_id, fare_class, booking_status, fare_amount, tax_amount, miles_earned,
       1 AS booking_count, t.month_key AS travel_month
FROM bookings
JOIN first_versions USING (passenger_id)
JOIN flights USING (flight_id)
JOIN keyed_flights USING (flight_id)
JOIN keyed_aircraft USING (aircraft_code)
JOIN flat_airports AS o ON o.airport_code = origin_airport_code
JOIN flat_airports AS a ON a.airport_code = dest_airport_code
JOIN dates AS b ON b.full_date = booking_date
JOIN dates AS t ON t.full_date = travel_date""")

# History ---------------------------------------------------------------------------------

_part("changed_ids", """
SELECT passenger_id
FROM first_versions AS old JOIN staged AS new USING (passenger_id)
WHERE old.frequent_flyer_tier <> new.frequent_flyer_tier
   OR old.home_airport_code <> new.home_airport_code""")

_part("after_expiry", """
SELECT passenger_key, first_versions.passenger_id, passenger_name, home_airport_code,
       frequent_flyer_tier, signup_date, effective_from,
       CASE WHEN c.passenger_id IS NULL THEN effective_to ELSE DATE '1998-06-30' END
           AS effective_to,
       c.passenger_id IS NULL AS is_current
FROM first_versions LEFT JOIN changed_ids AS c USING (passenger_id)""")

_part("opened", """
SELECT (base + row_number() OVER (ORDER BY passenger_id))::INTEGER AS passenger_key,
       passenger_id, staged.passenger_name, staged.home_airport_code,
       staged.frequent_flyer_tier, old.signup_date,
       DATE '1998-07-01' AS effective_from, DATE '9999-12-31' AS effective_to,
       TRUE AS is_current
FROM staged
LEFT JOIN first_versions AS old USING (passenger_id)
CROSS JOIN (SELECT max(passenger_key) AS base FROM first_versions)
WHERE old.passenger_id IS NULL OR passenger_id IN (SELECT passenger_id FROM changed_ids)""")

_part("versions", "SELECT * FROM after_expiry UNION ALL SELECT * FROM opened")

_part("month_reloaded", """
SELECT sales.* REPLACE (CASE WHEN travel_month = 199703 THEN v.passenger_key
                             ELSE sales.passenger_key END AS passenger_key)
FROM sales JOIN bookings USING (booking_id)
JOIN versions AS v ON v.passenger_id = bookings.passenger_id
                  AND booking_date BETWEEN effective_from AND effective_to""")

_part("arrivals", """
SELECT user_id, ts::DATE AS delivery_date, count(*) AS deliveries, min(ts) AS first_arrival
FROM events GROUP BY ALL""")

_part("arrival_status", """
SELECT user_id, delivery_date, deliveries,
       CASE WHEN first_arrival <= delivery_date + INTERVAL 6 HOUR THEN 'on_time'
            WHEN first_arrival <= delivery_date + INTERVAL 8 HOUR THEN 'past_due'
            ELSE 'late' END AS status
FROM arrivals""")


def _with_parts(statement: str) -> str:
    """Prefix the statement by the parts it mentions, in definition order."""
    needed: set[str] = set()

    def mark(text: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                mark(_PARTS[name])

    mark(statement)
    if not needed:
        return statement.strip()
    ctes = ",\n".join(f"{n} AS (\n{_PARTS[n]}\n)" for n in _PARTS if n in needed)
    return f"WITH {ctes}\n{statement.strip()}"


_VERSION_COLUMNS = """passenger_key, passenger_id, passenger_name, home_airport_code,
       frequent_flyer_tier, signup_date, effective_from, effective_to, is_current"""


def _count(name: str, layer: str, source: str, where: str = "") -> str:
    return (f"SELECT '{name}' AS table_name, '{layer}' AS layer, count(*) AS row_count "
            f"FROM {source} {where}")


def _rule(name: str, predicate: str, source: str = "bookings") -> str:
    return f"SELECT '{name}' AS rule, count_if({predicate})::BIGINT AS violations FROM {source}"


def _table_rule(table: str, rule: str, select: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, "
            f"coalesce(({select}), 0)::BIGINT AS violations")


def _twice(source: str, key: str) -> str:
    return (f"SELECT sum(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY {key} "
            f"HAVING count(*) > 1)")


def _lost(child: str, column: str, parent: str, key: str) -> str:
    return f"SELECT count(*) FROM {child} WHERE {column} NOT IN (SELECT {key} FROM {parent})"


_CONTRACT_RULES = [
    *[_rule(f"null_{c}", f"{c} IS NULL") for c in (
        "booking_id", "passenger_id", "flight_id", "booking_date", "travel_date", "fare_class",
        "fare_amount", "tax_amount", "booking_status", "miles_earned")],
    _rule("fare_class_not_allowed",
          "fare_class NOT IN ('Economy', 'Premium Economy', 'Business', 'First')"),
    _rule("booking_status_not_allowed",
          "booking_status NOT IN ('Confirmed', 'Cancelled', 'NoShow')"),
    _rule("fare_not_positive", "fare_amount <= 0"),
    _rule("tax_negative", "tax_amount < 0"),
    _rule("miles_negative", "miles_earned < 0"),
    _rule("fare_finer_than_cents", "fare_amount <> round(fare_amount, 2)"),
    _rule("tax_finer_than_cents", "tax_amount <> round(tax_amount, 2)"),
    _rule("booked_after_travel", "booking_date > travel_date"),
    _rule("unknown_flight", "flight_id NOT IN (SELECT flight_id FROM flights)"),
    _rule("travel_not_flight_date", "travel_date <> flight_date",
          "bookings JOIN flights USING (flight_id)"),
    _rule("unknown_passenger", "passenger_id NOT IN (SELECT passenger_id FROM passengers)"),
    """SELECT 'repeated_booking_id' AS rule,
              (count(*) - count(DISTINCT booking_id))::BIGINT AS violations FROM bookings""",
]

_TABLE_RULES = [
    *[_table_rule(t, "not null", f"SELECT count(*) FROM {source} WHERE {test}")
      for t, source, test in (
          ("dim_date", "dates", "date_key IS NULL OR full_date IS NULL"),
          ("dim_country", "countries", "country_name IS NULL"),
          ("dim_city", "cities", "city_name IS NULL OR country_key IS NULL"),
          ("dim_airport", "geo", "airport_code IS NULL OR airport_name IS NULL OR city_key IS NULL"),
          ("dim_aircraft", "keyed_aircraft", "aircraft_code IS NULL OR model IS NULL"),
          ("dim_flight", "keyed_flights",
           "flight_id IS NULL OR flight_number IS NULL OR flight_date IS NULL"),
          ("dim_passenger", "first_versions", "passenger_id IS NULL OR passenger_name IS NULL"),
          ("fact_ticket_sales", "sales", "fare_amount IS NULL OR tax_amount IS NULL"),
          ("airport_geo", "geo", "city_name IS NULL OR country_name IS NULL"))],
    *[_table_rule(t, "length", "SELECT " + " + ".join(
        f"count_if(length({c}) > {n})" for c, n in limits.items()) + f" FROM {source}")
      for t, source, limits in (
          ("dim_date", "dates", {"month_name": 12, "day_name": 12}),
          ("dim_country", "countries", {"country_name": 60, "region": 40}),
          ("dim_city", "cities", {"city_name": 60}),
          ("dim_airport", "geo", {"airport_name": 100}),
          ("dim_aircraft", "keyed_aircraft",
           {"aircraft_code": 10, "model": 50, "manufacturer": 50}),
          ("dim_flight", "keyed_flights", {"flight_number": 10}),
          ("dim_passenger", "first_versions", {"passenger_name": 100, "frequent_flyer_tier": 20}),
          ("fact_ticket_sales", "sales", {"fare_class": 20, "booking_status": 20}),
          ("airport_geo", "geo",
           {"airport_name": 100, "city_name": 60, "country_name": 60, "region": 40}))],
    _table_rule("fact_ticket_sales", "allowed values", """
        SELECT count_if(fare_class NOT IN ('Economy', 'Premium Economy', 'Business', 'First'))
             + count_if(booking_status NOT IN ('Confirmed', 'Cancelled', 'NoShow'))
             + count_if(booking_count <> 1) FROM sales"""),
    *[_table_rule(t, f"unique {key}", _twice(source, key))
      for t, source, key in (
          ("dim_date", "dates", "date_key"), ("dim_date", "dates", "full_date"),
          ("dim_country", "countries", "country_key"),
          ("dim_country", "countries", "country_name"),
          ("dim_city", "cities", "city_key"), ("dim_city", "cities", "city_name, country_key"),
          ("dim_airport", "geo", "airport_key"), ("dim_airport", "geo", "airport_code"),
          ("dim_aircraft", "keyed_aircraft", "aircraft_key"),
          ("dim_aircraft", "keyed_aircraft", "aircraft_code"),
          ("dim_flight", "keyed_flights", "flight_key"),
          ("dim_flight", "keyed_flights", "flight_id"),
          ("dim_passenger", "first_versions", "passenger_key"),
          ("dim_passenger", "first_versions", "passenger_id, effective_from"),
          ("fact_ticket_sales", "sales", "booking_id"), ("airport_geo", "geo", "airport_key"))],
    _table_rule("fact_ticket_sales", "unique ticket_sales_key", _twice("sales", "booking_id")),
    _table_rule("dim_city", "country_key in dim_country",
                _lost("cities", "country_key", "countries", "country_key")),
    _table_rule("dim_airport", "city_key in dim_city", _lost("geo", "city_key", "cities", "city_key")),
    *[_table_rule("fact_ticket_sales", f"{column} in {parent}", _lost("sales", column, source, key))
      for column, parent, source, key in (
          ("booking_date_key", "dim_date", "dates", "date_key"),
          ("travel_date_key", "dim_date", "dates", "date_key"),
          ("passenger_key", "dim_passenger", "first_versions", "passenger_key"),
          ("flight_key", "dim_flight", "keyed_flights", "flight_key"),
          ("origin_airport_key", "dim_airport", "flat_airports", "airport_key"),
          ("dest_airport_key", "dim_airport", "flat_airports", "airport_key"),
          ("aircraft_key", "dim_aircraft", "keyed_aircraft", "aircraft_key"))],
]

_STATEMENTS = {
    "revenue_by_route_month_tier": """
SELECT o.country_name AS origin_country, d.country_name AS dest_country, travel_month,
       frequent_flyer_tier, sum(fare_amount)::DECIMAL(38,2) AS revenue, count(*) AS bookings
FROM sales
JOIN first_versions USING (passenger_key)
JOIN geo AS o ON o.airport_key = origin_airport_key
JOIN geo AS d ON d.airport_key = dest_airport_key
WHERE booking_status = 'Confirmed'
GROUP BY ALL""",
    "revenue_by_airport_route": """
SELECT origin_airport_code, dest_airport_code,
       (year(travel_date) * 100 + month(travel_date))::INTEGER AS travel_month,
       sum(fare_amount)::DECIMAL(38,2) AS revenue, count(*) AS bookings
FROM bookings JOIN flights USING (flight_id) JOIN passengers USING (passenger_id)
WHERE booking_status = 'Confirmed'
GROUP BY ALL""",
    "tax_share_by_class": """
SELECT fare_class, sum(fare_amount)::DECIMAL(38,2) AS fare,
       sum(tax_amount)::DECIMAL(38,2) AS tax,
       sum(tax_amount)::DECIMAL(38,2)::DOUBLE / sum(fare_amount)::DECIMAL(38,2)::DOUBLE
           AS tax_share
FROM sales WHERE booking_status = 'Confirmed' GROUP BY fare_class""",
    "average_fare_by_class": """
SELECT fare_class, sum(fare_amount)::DECIMAL(38,2) AS fare, count(*) AS bookings,
       sum(fare_amount)::DECIMAL(38,2)::DOUBLE / count(*) AS average_fare
FROM sales WHERE booking_status = 'Confirmed' GROUP BY fare_class""",
    "revenue_as_was_as_is": """
SELECT was.frequent_flyer_tier AS tier_as_was, now.frequent_flyer_tier AS tier_as_is,
       sum(fare_amount)::DECIMAL(38,2) AS revenue, count(*) AS bookings
FROM sales
JOIN versions AS was ON was.passenger_key = sales.passenger_key
JOIN versions AS now ON now.passenger_id = was.passenger_id AND now.is_current
WHERE booking_status = 'Confirmed'
GROUP BY ALL""",
    "bronze_bookings": "SELECT * FROM bookings",
    "booking_flight_join": """
SELECT bookings.*, flight_number, flight_date, origin_airport_code, dest_airport_code,
       aircraft_code
FROM bookings LEFT JOIN flights USING (flight_id)""",
    "dim_date": "SELECT * FROM dates",
    "dim_airport": "SELECT * FROM flat_airports",
    "dim_aircraft": "SELECT * FROM keyed_aircraft",
    "dim_flight": "SELECT * FROM keyed_flights",
    "dim_passenger_initial": f"SELECT {_VERSION_COLUMNS} FROM first_versions",
    "dim_passenger_from_signup": f"""
SELECT {_VERSION_COLUMNS.replace("effective_from", "signup_date AS effective_from")}
FROM first_versions""",
    "dim_country": "SELECT * FROM countries",
    "dim_city": "SELECT * FROM cities",
    "dim_airport_snowflaked": "SELECT airport_key, airport_code, airport_name, city_key FROM geo",
    "airport_geo_view": """
SELECT airport_key, airport_code, airport_name, city_name, country_name, region FROM geo""",
    "fact_ticket_sales": """
SELECT row_number() OVER (ORDER BY travel_date_key, booking_id) AS ticket_sales_key, * FROM sales""",
    "asof_many_versions": """
WITH placed AS (
    SELECT o_orderkey AS booking_id, c_nationkey AS passenger_id, o_orderdate::DATE AS day
    FROM orders JOIN customer ON c_custkey = o_custkey),
starts AS (SELECT DISTINCT passenger_id, day AS opened FROM placed)
SELECT booking_id, p.passenger_id, p.day + 2 AS booking_date,
       p.passenger_id * 100000 + max(opened - DATE '1990-01-01') AS passenger_key
FROM placed p JOIN starts o ON o.passenger_id = p.passenger_id AND opened <= p.day + 2
GROUP BY booking_id, p.passenger_id, p.day""",
    "load_gates": f"""
SELECT gate, given AS input, code::INTEGER AS code,
       CASE WHEN refused THEN 'refused' ELSE 'passed' END AS outcome
FROM (
  SELECT 'row_counts' AS gate, 'sound' AS given, NULL AS code, FALSE AS refused
  UNION ALL SELECT 'row_counts', 'planted', 50001, count_if(booking_id % 50 = 0) > 0 FROM bookings
  UNION ALL SELECT 'resolution', 'sound', NULL, count(*) <> (SELECT count(*) FROM bookings) FROM sales
  UNION ALL SELECT 'resolution', 'planted', 50002,
                   count_if(greatest(booking_date, travel_date) > DATE '2001-06-30') > 0 FROM bookings
  UNION ALL SELECT 'contract', 'sound', NULL, count_if(fare_amount <= 0 OR tax_amount < 0) > 0 FROM bookings
  UNION ALL SELECT 'contract', 'planted', NULL, count_if(booking_date > travel_date) > 0 FROM bookings
  UNION ALL SELECT 'feed_rules', 'sound', NULL, count_if(passenger_name IS NULL) > 0 FROM staged
  UNION ALL SELECT 'feed_rules', 'planted', NULL, count(*) > 0 FROM staged)""",
    "scd2_feed_rules": """
SELECT 'not null' AS rule, 'passenger_id' AS column_name,
       count_if(passenger_id % 5 = 0)::BIGINT AS violations FROM staged
UNION ALL SELECT 'not null', 'passenger_name', count_if(passenger_id % 3 = 0)::BIGINT FROM staged
UNION ALL SELECT 'length', 'passenger_name', 0::BIGINT
UNION ALL SELECT 'length', 'home_airport_code', count_if(passenger_id % 4 = 0)::BIGINT FROM staged
UNION ALL SELECT 'length', 'frequent_flyer_tier',
       count_if(passenger_id % 2 = 0 AND length(frequent_flyer_tier) * 9 > 20)::BIGINT FROM staged""",
    "months_read": """
SELECT 'partition_key_filter' AS query, count(DISTINCT travel_month) AS months
FROM sales WHERE travel_month = 199703
UNION ALL SELECT 'nonpartition_filter', count(DISTINCT travel_month) FROM sales
UNION ALL SELECT 'quarter_by_calendar', count(DISTINCT travel_month) FROM sales
WHERE travel_month BETWEEN 199701 AND 199703""",
    "month_totals_by_sql": """
SELECT year(travel_date)::INTEGER AS year, month(travel_date)::INTEGER AS month,
       count(*) AS bookings, sum(fare_amount)::DECIMAL(38,2) AS fare
FROM bookings GROUP BY ALL""",
    "planted_values": """
WITH planted AS (
    SELECT CASE booking_id % 100 WHEN 1 THEN ' ' || booking_status
                WHEN 2 THEN upper(booking_status) WHEN 3 THEN 'Waitlisted'
                ELSE booking_status END AS value,
           CASE booking_id % 100 WHEN 1 THEN 'padded' WHEN 2 THEN 'case' WHEN 3 THEN 'new' END AS kind
    FROM bookings)
SELECT 'booking_status' AS column_name, value, kind, count(*) AS row_count
FROM planted WHERE kind IS NOT NULL GROUP BY value, kind""",
    "csv_feed_report": """
SELECT 'missing' AS finding, 'tax_amount' AS column_name, 1::BIGINT AS n, TRUE AS breaking
UNION ALL SELECT 'added', 'source_system', 1::BIGINT, FALSE
UNION ALL SELECT 'renamed', 'booking_status -> state', 1::BIGINT, TRUE
UNION ALL SELECT 'retyped', 'flight_id', count(*), TRUE FROM bookings
UNION ALL SELECT 'not parsed', 'miles_earned', count_if(booking_id % 40 = 0)::BIGINT, TRUE FROM bookings
UNION ALL SELECT 'finer than a cent', 'fare_amount', count_if(booking_id % 50 = 0)::BIGINT, TRUE
FROM bookings""",
    "contract_measured_landing": "\nUNION ALL\n".join(_CONTRACT_RULES),
    "column_types": "\nUNION ALL\n".join(
        f"SELECT '{feed}' AS feed, '{column}' AS column_name, count({column}) AS n_values, "
        f"'{kind}' AS narrowest FROM {feed}"
        for feed, kinds in (
            ("bookings", {"booking_id": "int", "passenger_id": "int", "flight_id": "int",
                          "booking_date": "date", "travel_date": "date", "fare_class": "string",
                          "fare_amount": "decimal(38,10)", "tax_amount": "decimal(38,10)",
                          "booking_status": "string", "miles_earned": "int"}),
            ("events", {"event_id": "int", "ts": "timestamp_ntz", "user_id": "int",
                        "event_type": "string", "value": "decimal(38,10)", "props": "string"}))
        for column, kind in kinds.items()),
    "csv_feed_read": """
SELECT booking_id::BIGINT AS booking_id, passenger_id::INTEGER AS passenger_id,
       flight_id::INTEGER AS flight_id, booking_date, travel_date, fare_class, fare_amount,
       tax_amount, booking_status, miles_earned FROM bookings""",
    "fact_gated_load": """
SELECT row_number() OVER (ORDER BY travel_date_key, booking_id) AS ticket_sales_key,
       sales.* REPLACE (
           dense_rank() OVER (ORDER BY flight_id * 100000 + (travel_date - DATE '1990-01-01'))::INTEGER
               AS flight_key,
           least(booking_date_key, travel_date_key) AS booking_date_key)
FROM sales JOIN bookings USING (booking_id)""",
    "fact_key_range": """
SELECT count(*) AS row_count, least(1, count(*)) AS first_key, count(*) AS last_key,
       count(DISTINCT booking_id) AS distinct_keys
FROM sales""",
    "fact_loaded_as_of": """
SELECT sales.* REPLACE (v.passenger_key AS passenger_key)
FROM sales JOIN bookings USING (booking_id)
JOIN versions AS v ON v.passenger_id = bookings.passenger_id
                  AND booking_date BETWEEN effective_from AND effective_to""",
    "fact_reloaded": """
SELECT row_number() OVER (ORDER BY travel_date_key, booking_id) AS ticket_sales_key,
       sales.* REPLACE (v.passenger_key AS passenger_key)
FROM sales JOIN bookings USING (booking_id)
JOIN versions AS v ON v.passenger_id = bookings.passenger_id
                  AND booking_date BETWEEN effective_from AND effective_to""",
    "fact_month_reloaded": """
SELECT row_number() OVER (ORDER BY travel_date_key, booking_id) AS ticket_sales_key, *
FROM month_reloaded""",
    "revenue_kept_summary": """
SELECT o.country_name AS origin_country, d.country_name AS dest_country, travel_month,
       frequent_flyer_tier, sum(fare_amount)::DECIMAL(38,2) AS revenue, count(*) AS bookings
FROM month_reloaded
JOIN versions USING (passenger_key)
JOIN geo AS o ON o.airport_key = origin_airport_key
JOIN geo AS d ON d.airport_key = dest_airport_key
WHERE booking_status = 'Confirmed'
GROUP BY ALL""",
    "summary_rows": """
SELECT origin_airport_key, dest_airport_key, passenger_key, booking_status, travel_month,
       sum(fare_amount)::DECIMAL(38,2) AS fare_amount, sum(tax_amount)::DECIMAL(38,2) AS tax_amount,
       sum(miles_earned)::BIGINT AS miles_earned, count(*) AS booking_count
FROM month_reloaded GROUP BY ALL""",
    "reference_resolution": "\nUNION ALL\n".join(
        f"""SELECT '{column} in {parent}' AS rule, count(*) AS fact_rows,
       count_if({test})::BIGINT AS resolved_rows FROM sales""" for column, parent, test in (
            ("booking_date_key", "dim_date", "booking_date_key <= 20010630"),
            ("travel_date_key", "dim_date", "travel_date_key <= 20010630"),
            ("passenger_key", "dim_passenger", "passenger_key IN (SELECT passenger_key FROM first_versions)"),
            ("flight_key", "dim_flight", "flight_key IN (SELECT flight_key FROM keyed_flights)"),
            ("origin_airport_key", "dim_airport", "origin_airport_key IN (SELECT airport_key FROM geo)"),
            ("dest_airport_key", "dim_airport", "dest_airport_key IN (SELECT airport_key FROM geo)"),
            ("aircraft_key", "dim_aircraft", "aircraft_key IN (SELECT aircraft_key FROM keyed_aircraft)"))),
    "scd2_second_feed": f"""
WITH again AS (SELECT * FROM passengers WHERE passenger_id % 50 = 0)
SELECT passenger_key, v.passenger_id, v.passenger_name, v.home_airport_code, v.frequent_flyer_tier,
       v.signup_date, effective_from,
       CASE WHEN is_current AND a.passenger_id IS NOT NULL THEN DATE '1998-12-31'
            ELSE effective_to END AS effective_to,
       is_current AND a.passenger_id IS NULL AS is_current
FROM versions AS v LEFT JOIN again AS a ON a.passenger_id = v.passenger_id
UNION ALL
SELECT ((SELECT max(passenger_key) FROM versions)
        + row_number() OVER (ORDER BY passenger_id))::INTEGER, passenger_id, passenger_name,
       home_airport_code, frequent_flyer_tier || '_2', signup_date, DATE '1999-01-01',
       DATE '9999-12-31', TRUE
FROM again""",
    "asof_passenger_lookup": """
SELECT booking_id, bookings.passenger_id, booking_date, passenger_key
FROM bookings JOIN versions ON versions.passenger_id = bookings.passenger_id
     AND booking_date BETWEEN effective_from AND effective_to""",
    "load_row_counts": "\nUNION ALL\n".join([
        _count("bronze_bookings", "bronze", "bookings"),
        _count("bronze_flights", "bronze", "flights"),
        _count("bronze_passengers", "bronze", "passengers"),
        _count("bronze_airports", "bronze", "airports"),
        _count("bronze_aircraft", "bronze", "aircraft"),
        _count("stg_passenger_updates", "bronze", "staged"),
        _count("dim_date", "silver", "dates"),
        _count("dim_passenger", "silver", "first_versions"),
        _count("dim_country", "silver", "countries"),
        _count("dim_city", "silver", "cities"),
        _count("dim_airport", "silver", "flat_airports"),
        _count("dim_aircraft", "silver", "keyed_aircraft"),
        _count("dim_flight", "silver", "keyed_flights"),
        _count("fact_ticket_sales", "gold", "sales"),
        _count("airport_geo", "gold", "geo"),
    ]),
    "fact_resolution": """
SELECT (SELECT count(*) FROM sales) AS fact_rows, count(*) AS resolved_rows
FROM sales
JOIN dates AS b ON b.date_key = booking_date_key
JOIN dates AS t ON t.date_key = travel_date_key
JOIN first_versions USING (passenger_key)
JOIN keyed_flights USING (flight_key)
JOIN geo AS o ON o.airport_key = origin_airport_key
JOIN geo AS a ON a.airport_key = dest_airport_key
JOIN keyed_aircraft USING (aircraft_key)""",
    "unloaded_bookings": """
SELECT booking_id FROM bookings
EXCEPT
SELECT booking_id FROM sales WHERE greatest(booking_date_key, travel_date_key) <= 20010630""",
    "measure_reconciliation": "\nUNION ALL\n".join(
        f"""SELECT '{src}' AS src, sum(fare_amount)::DECIMAL(38,2) AS fare,
       sum(tax_amount)::DECIMAL(38,2) AS tax, sum(miles_earned)::BIGINT AS miles
FROM {source}""" for src, source in (("bronze", "bookings"), ("fact", "sales"))),
    "key_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "table_rule_violations": "\nUNION ALL\n".join(_TABLE_RULES),
    "orphan_flights": """
SELECT flight_id, count(*) AS row_count FROM bookings
WHERE flight_id NOT IN (SELECT flight_id FROM flights WHERE flight_id % 50 <> 0)
GROUP BY flight_id""",
    "orphan_passengers": """
SELECT passenger_id, count(*) AS row_count FROM bookings
WHERE passenger_id NOT IN (SELECT passenger_id FROM passengers WHERE passenger_id % 50 <> 0)
GROUP BY passenger_id""",
    "fd_violations": """
SELECT p_name AS determinant, count(DISTINCT p_brand) AS distinct_values FROM part
GROUP BY p_name HAVING count(DISTINCT p_brand) > 1
UNION ALL
SELECT country, count(DISTINCT region) FROM airports
GROUP BY country HAVING count(DISTINCT region) > 1""",
    "booking_flight_fan_out": """
SELECT (SELECT count(*) FROM bookings) AS bookings, count(*) AS joined_rows,
       count_if(flights.flight_id IS NULL)::BIGINT AS without_flight
FROM bookings LEFT JOIN flights ON flights.flight_id = bookings.flight_id""",
    "repeat_passenger_flight": """
SELECT passenger_id, flight_id, count(*) AS row_count FROM bookings
GROUP BY ALL HAVING count(*) > 1""",
    "bookings_before_signup": """
SELECT count(*) AS bookings, count_if(booking_date < signup_date)::BIGINT AS before_signup
FROM bookings JOIN passengers USING (passenger_id)""",
    "scd2_adopted": f"SELECT {_VERSION_COLUMNS} FROM first_versions",
    "scd2_passenger": "SELECT * FROM versions",
    "scd2_streamed": "SELECT * FROM versions",
    "scd2_expire_step": "SELECT * FROM after_expiry",
    "scd2_insert_step": "SELECT * FROM opened",
    "scd2_totals": """
SELECT count(*) AS total_rows, count_if(is_current)::BIGINT AS current_rows,
       count_if(NOT is_current)::BIGINT AS expired_rows
FROM versions""",
    "scd2_changed_versions": """
SELECT passenger_key, passenger_id, frequent_flyer_tier, home_airport_code, effective_from,
       effective_to, is_current
FROM versions
QUALIFY count(*) OVER (PARTITION BY passenger_id) = 2
ORDER BY passenger_id, effective_from LIMIT 6""",
    "scd2_new_members": """
SELECT passenger_id, count(*) AS versions, max(is_current::INTEGER) AS is_current
FROM versions AS v WHERE passenger_id >= 900000000000 GROUP BY passenger_id""",
    "scd2_change_breakdown": """
SELECT count_if(tier AND NOT home)::BIGINT AS tier_only,
       count_if(home AND NOT tier)::BIGINT AS home_only,
       count_if(tier AND home)::BIGINT AS both_changed
FROM (SELECT old.frequent_flyer_tier <> new.frequent_flyer_tier AS tier,
             old.home_airport_code <> new.home_airport_code AS home
      FROM first_versions AS old JOIN staged AS new USING (passenger_id))""",
    "scd2_feed_problems": """
SELECT 'staged_twice' AS problem, count(*) AS passengers
FROM (SELECT passenger_id FROM staged GROUP BY passenger_id HAVING count(*) > 1)
UNION ALL
SELECT 'already_loaded', count(DISTINCT passenger_id)
FROM staged JOIN versions USING (passenger_id)
WHERE is_current AND effective_from >= DATE '1998-07-01'
  AND (staged.frequent_flyer_tier || '_2' <> versions.frequent_flyer_tier
       OR staged.home_airport_code <> versions.home_airport_code)""",
    "scd2_planted_invariants": """
WITH moved AS (
    SELECT passenger_id,
           CASE WHEN NOT is_current THEN effective_from
                WHEN passenger_id % 17 = 0 THEN effective_from + 5
                WHEN passenger_id % 19 = 0 THEN effective_from - 5
                ELSE effective_from END AS effective_from,
           CASE WHEN passenger_id % 23 = 0 THEN DATE '1850-01-01' ELSE effective_to END
               AS effective_to,
           is_current OR passenger_id % 29 = 0 AS is_current
    FROM versions),
broken AS (SELECT * FROM moved UNION ALL SELECT * FROM moved WHERE passenger_id % 31 = 0),
starts AS (SELECT passenger_id, effective_from, max(effective_to) AS effective_to
           FROM broken GROUP BY passenger_id, effective_from),
spans AS (
    SELECT *, lead(effective_from) OVER (PARTITION BY passenger_id
                                         ORDER BY effective_from) AS following
    FROM starts),
owners AS (SELECT passenger_id, count_if(is_current) AS n FROM broken GROUP BY passenger_id)
SELECT 'same_start' AS rule, (count(*) - count(DISTINCT (passenger_id, effective_from)))::BIGINT
           AS violations FROM broken
UNION ALL
SELECT 'ends_before_start', count_if(effective_to < effective_from)::BIGINT FROM broken
UNION ALL SELECT 'overlap', count_if(following <= effective_to)::BIGINT FROM spans
UNION ALL SELECT 'gap', count_if(following - effective_to > 1)::BIGINT FROM spans
UNION ALL SELECT 'not_one_current', count_if(n <> 1)::BIGINT FROM owners
UNION ALL
SELECT 'flag_and_end_disagree',
       count_if(is_current <> (effective_to = DATE '9999-12-31'))::BIGINT FROM broken""",
    "scd2_invariants": """
WITH spans AS (
    SELECT *, lead(effective_from) OVER (PARTITION BY passenger_id
                                         ORDER BY effective_from) AS following
    FROM versions),
owners AS (SELECT passenger_id, count_if(is_current) AS n FROM versions GROUP BY passenger_id)
SELECT 'same_start' AS rule, (count(*) - count(DISTINCT (passenger_id, effective_from)))::BIGINT
           AS violations FROM versions
UNION ALL
SELECT 'ends_before_start', count_if(effective_to < effective_from)::BIGINT FROM versions
UNION ALL SELECT 'overlap', count_if(following <= effective_to)::BIGINT FROM spans
UNION ALL SELECT 'gap', count_if(following - effective_to > 1)::BIGINT FROM spans
UNION ALL SELECT 'not_one_current', count_if(n <> 1)::BIGINT FROM owners
UNION ALL
SELECT 'flag_and_end_disagree',
       count_if(is_current <> (effective_to = DATE '9999-12-31'))::BIGINT FROM versions""",
    "partition_row_counts": """
SELECT (travel_month // 100 * 12 + travel_month % 100 - 1995 * 12)::INTEGER AS partition_number,
       count(*) AS row_count
FROM sales GROUP BY ALL""",
    "partition_row_counts_with_empty": """
SELECT number::INTEGER AS partition_number, count(booking_id) AS row_count
FROM range(1, 85) AS r(number)
LEFT JOIN sales ON travel_month // 100 * 12 + travel_month % 100 - 1995 * 12 = number
GROUP BY number""",
    "partition_key_filter": """
SELECT count(*) AS bookings, sum(fare_amount)::DECIMAL(38,2) AS fare
FROM sales WHERE travel_month = 199703""",
    "nonpartition_filter": """
SELECT count(*) AS bookings, sum(fare_amount)::DECIMAL(38,2) AS fare
FROM bookings WHERE fare_class = 'Business'""",
    "quarter_by_calendar": """
SELECT count(*) AS bookings, sum(fare_amount)::DECIMAL(38,2) AS fare
FROM sales JOIN dates ON date_key = travel_date_key WHERE year = 1997 AND quarter = 1""",
    "contract_violations": "\nUNION ALL\n".join(_CONTRACT_RULES),
    "amounts_finer_than_cents": """
SELECT count_if(l_extendedprice::DECIMAL(38,10) <> round(l_extendedprice::DECIMAL(38,10), 2))
           ::BIGINT AS fare,
       count_if((l_extendedprice::DECIMAL(12,2) * l_tax::DECIMAL(4,2)) * 100 % 1 <> 0)::BIGINT
           AS tax
FROM lineitem""",
    "unexpected_values": """
SELECT 'fare_class' AS column_name, fare_class AS value, 'new' AS kind, count(*) AS row_count
FROM bookings WHERE fare_class NOT IN ('Economy', 'Premium Economy', 'Business')
GROUP BY fare_class""",
    "late_deliveries": "SELECT * FROM arrival_status",
    "delivery_summary": """
SELECT status, count(*) AS feed_days, count_if(deliveries > 1)::BIGINT AS more_than_one_file
FROM arrival_status GROUP BY status""",
    "missed_delivery_days": """
SELECT user_id, min(delivery_date) AS first_day, max(delivery_date) AS last_day,
       count(*) AS days_delivered,
       (max(delivery_date) - min(delivery_date) + 1 - count(*))::BIGINT AS days_missed
FROM arrivals GROUP BY user_id
HAVING max(delivery_date) - min(delivery_date) + 1 > count(*)""",
}


def statements() -> dict[str, str]:
    found = {}
    for name, text in _STATEMENTS.items():
        own = text.strip()
        if own.startswith("WITH "):  # join the statement's own expressions to the shared ones
            shared = _with_parts(own[len("WITH "):])
            found[name] = shared.replace("\n)\n" + own[5:], "\n),\n" + own[5:], 1)
        else:
            found[name] = _with_parts(own)
    return found
