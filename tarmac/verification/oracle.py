"""The expected result of each query in DuckDB SQL.

Written from the definitions of the reports, with plain joins and windows over the full tables;
nothing here shares an algorithm with the Spark plans.
"""

from __future__ import annotations

from tarmac import constants as C
from tarmac.roles import BOOKINGS_SQL, PASSENGERS_SQL, PAYMENT_ORDER, PAYMENTS_SQL, TEST_SALT, UNTIDY_ROWS

BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _strip(c: str) -> str:
    return f"trim({c}, {BLANKS})"


def _text(c: str, token: str) -> str:
    return f"coalesce(cast({c} AS varchar), '{token}')"


def _upper(c: str) -> str:
    return f"upper({_strip(_text(c, 'NAN'))})"


def _lower(c: str) -> str:
    return f"lower({_strip(_text(c, 'nan'))})"


def _stripped(c: str) -> str:
    return _strip(_text(c, "nan"))


def _values(pairs: dict[str, str], c: str, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {c} {whens} ELSE {default} END"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _impute(carrier: str, flight_id: str) -> str:
    found = _values(C.CARRIER_BY_PREFIX, f"substr({flight_id}, 1, 2)", "'UNKNOWN'")
    return f"CASE WHEN {carrier} = 'UNKNOWN' THEN {found} ELSE {carrier} END"


def _impute_report(carrier: str, flight_id: str) -> str:
    found = _values(C.CARRIER_BY_PREFIX, f"upper(substr({flight_id}, 1, 2))", carrier)
    return f"CASE WHEN {carrier} IN {_in(C.CARRIER_UNRESOLVED_IN_REPORTS)} THEN {found} ELSE {carrier} END"


def _slot(ts: str, plain: bool = False) -> str:
    slots, night = (C.SLOTS_PLAIN, C.NIGHT_PLAIN) if plain else (C.SLOTS_WITH_HOURS, C.NIGHT_WITH_HOURS)
    whens = " ".join(f"WHEN hour({ts}) >= {a} AND hour({ts}) < {b} THEN '{n}'" for n, a, b in slots)
    return f"CASE WHEN {ts} IS NULL THEN 'Unknown' {whens} ELSE '{night}' END"


def _age_group(age: str) -> str:
    return (
        f"CASE WHEN {age} IS NULL THEN 'Unknown' WHEN {age} < 18 THEN 'Under 18' WHEN {age} <= 30 THEN '18-30'"
        f" WHEN {age} <= 45 THEN '31-45' WHEN {age} <= 60 THEN '46-60' ELSE '60+' END"
    )


def _minutes(start: str, end: str) -> str:
    return f"round_even(date_diff('microsecond', {start}, {end}) / 6e7, 2)"


def _sum(c: str) -> str:
    return f"coalesce(cast(sum(cast({c} AS decimal(18,2))) AS double), 0.0)"


def _mean(c: str) -> str:
    return f"cast(sum(cast({c} AS decimal(18,2))) AS double) / count({c})"


def _round2(c: str) -> str:
    return f"round_even({c}, 2)"


def _hash_last(c: str) -> str:
    value = _strip(_text(c, ""))
    return (
        f"CASE WHEN upper({value}) IN ('', 'NAN', 'NONE') THEN 'HASH_MISSING'"
        f" ELSE sha256({value} || '{TEST_SALT}') END"
    )


def _hash_first(c: str) -> str:
    value = _text(c, "")
    return f"CASE WHEN {_strip(value)} NOT IN ('', 'nan', 'None') THEN sha256('{TEST_SALT}:' || {value}) END"


def _initial(c: str) -> str:
    value = _stripped(c)
    return f"CASE WHEN {value} = '' THEN 'N***' ELSE substr({value}, 1, 1) || '***' END"


def _initial_raw(c: str) -> str:
    return f"substr({_text(c, '')}, 1, 1) || '***'"


def _clean(variant: str) -> str:
    """The clean tables as common table expressions."""
    script = variant == "script"
    clean_id = _upper if script else _stripped
    placeholder = f"WHERE carrier NOT IN {_in(C.CARRIER_PLACEHOLDERS)}" if script else ""
    gender = f"CASE WHEN {_upper('gender')} = 'F' THEN 'F' ELSE 'M' END" if script else _upper("gender")
    first_booking = "QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY booking_date, passenger_id, status, seat_number) = 1"
    first_payment = f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {', '.join(PAYMENT_ORDER)}) = 1"
    dob = "try_cast(date_of_birth AS timestamp)"
    year = f"coalesce(year({dob}), 0)" if script else f"year({dob})"
    date_columns = (
        ""
        if script
        else ", cast(departure_time AS date) AS departure_date, cast(arrival_time AS date) AS arrival_date,"
        " hour(departure_time) AS departure_hour"
    )
    return f"""
raw_flights AS (
  SELECT event_id AS flight_id, upper(event_type) AS airline, event_type AS source,
    lead(event_type) OVER w AS destination, ts AS departure_time, lead(ts) OVER w AS arrival_time
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
raw_bookings AS (SELECT {', '.join(BOOKINGS_SQL)} FROM orders),
raw_passengers AS (SELECT {', '.join(PASSENGERS_SQL)} FROM customer),
raw_payments AS (SELECT {', '.join(PAYMENTS_SQL)}, {', '.join(PAYMENT_ORDER)} FROM lineitem),
normal_flights AS (
  SELECT {_upper('flight_id')} AS flight_id, {_upper('airline')} AS airline, {_upper('source')} AS source,
    {_upper('destination')} AS destination, departure_time, arrival_time FROM raw_flights),
one_flight AS (
  SELECT * FROM normal_flights WHERE departure_time IS NOT NULL AND arrival_time IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY flight_id
    ORDER BY airline, source, destination, departure_time, arrival_time) = 1),
forward_flights AS (
  SELECT *, {_impute('airline', 'flight_id')} AS carrier, {_minutes('departure_time', 'arrival_time')} AS duration_mins
  FROM one_flight WHERE arrival_time > departure_time),
kept_flights AS (
  SELECT flight_id, carrier AS airline, source, destination, departure_time, arrival_time, duration_mins,
    source || ' to ' || destination AS route
  FROM (SELECT * FROM forward_flights {placeholder}) WHERE duration_mins > 0 AND duration_mins <= 1440),
flights AS (
  SELECT *, cast(cast(arrival_time AS date) > cast(departure_time AS date) AS int) AS is_overnight,
    cast(cast(trunc(duration_mins) AS int) // 60 AS varchar) || 'h '
      || cast(cast(trunc(duration_mins) AS int) % 60 AS varchar) || 'm' AS duration_hhmm,
    {_slot('departure_time', not script)} AS departure_slot{date_columns},
    cast(duration_mins > (cast(sum(cast(duration_mins AS decimal(18,2))) OVER r AS double) / count(*) OVER r) * 1.30
      AS int) AS is_delayed
  FROM kept_flights WINDOW r AS (PARTITION BY route)),
bookings AS (
  SELECT {'DISTINCT' if not script else ''} {clean_id('booking_id')} AS booking_id,
    {clean_id('passenger_id')} AS passenger_id, {_upper('flight_id')} AS flight_id, booking_date,
    {_upper('status')} AS status, passport_number, {_upper('seat_number') if script else 'seat_number'} AS seat_number,
    emergency_contact_name, emergency_contact_phone
  FROM raw_bookings {first_booking if script else ''}),
passengers AS (
  SELECT {'DISTINCT' if not script else ''} {clean_id('passenger_id')} AS passenger_id, first_name, last_name,
    cast(age AS double) AS age, {gender} AS gender, {'email' if script else _lower('email')} AS email, phone, aadhaar_id,
    {_age_group('age')} AS age_group, {year} AS birth_year
  FROM raw_passengers),
payments AS (
  SELECT {'DISTINCT' if not script else ''} {clean_id('payment_id')} AS payment_id,
    {clean_id('booking_id')} AS booking_id, amount, {_upper('payment_method')} AS payment_method
  FROM raw_payments WHERE amount IS NOT NULL {first_payment if script else ''}),
master AS (
  SELECT b.*, f.* EXCLUDE (flight_id), y.payment_id, y.amount, y.payment_method, p.age, p.age_group, p.gender,
    p.birth_year, p.first_name, p.last_name
  FROM bookings b LEFT JOIN flights f ON b.flight_id = f.flight_id
    LEFT JOIN payments y ON b.booking_id = y.booking_id
    LEFT JOIN passengers p ON b.passenger_id = p.passenger_id)"""


SCRIPT, NOTEBOOK = _clean("script"), _clean("notebook")
ORACLE_SQL: dict[str, str] = {}


def plain(name: str, sql: str) -> None:
    ORACLE_SQL[name] = sql


def script(name: str, sql: str) -> None:
    ORACLE_SQL[name] = f"WITH {SCRIPT} {sql}"


def notebook(name: str, sql: str) -> None:
    ORACLE_SQL[name] = f"WITH {NOTEBOOK} {sql}"


def _counts(names: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in names.items())


# ---------------------------------------------------------------- reading and writing

plain("src_first_available", "SELECT event_id, user_id, event_type FROM events")
plain("src_multi_table", _counts({t: t for t in ("events", "orders", "customer", "lineitem")}))
plain("src_required_tables", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1")
plain("src_drop_junk_columns", "SELECT event_id, event_type FROM events")
plain(
    "src_check_columns",
    "SELECT 'flights' AS table_name, 'airline,arrival_time,destination,flight_id,source' AS missing_columns,"
    " count(*) AS row_count FROM events"
    " UNION ALL SELECT 'bookings', 'seat_number,status', count(*) FROM orders"
    " UNION ALL SELECT 'passengers', '', count(*) FROM customer"
    " UNION ALL SELECT 'payments', '', count(*) FROM lineitem",
)
plain(
    "src_empty_check",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) = 0 AS is_empty FROM {t}" for t in ("events", "orders", "customer", "lineitem")
    )
    + " UNION ALL SELECT 'negative_balances', count(*) = 0 FROM customer WHERE c_acctbal < -1e9",
)
plain(
    "src_positional_rename",
    "SELECT c_custkey AS passenger_id, c_name AS full_name, c_nationkey AS region_code, c_acctbal AS balance,"
    " c_mktsegment AS segment FROM customer",
)
plain("src_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
CLEANED = {
    "cleaned_flights": "flights",
    "cleaned_bookings_masked": "bookings",
    "cleaned_passengers_masked": "passengers",
    "cleaned_payments": "payments",
    "master_dataset": "master",
}
script("sink_tables", _counts(CLEANED))
script(
    "audit_row_counts",
    f"""
, steps AS (SELECT
  (SELECT count(*) FROM normal_flights) AS a,
  (SELECT count(*) FROM normal_flights WHERE departure_time IS NOT NULL AND arrival_time IS NOT NULL) AS b,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM normal_flights
    WHERE departure_time IS NOT NULL AND arrival_time IS NOT NULL)) AS c,
  (SELECT count(*) FROM one_flight) AS d,
  (SELECT count(*) FROM forward_flights) AS e,
  (SELECT count(*) FROM forward_flights WHERE carrier NOT IN {_in(C.CARRIER_PLACEHOLDERS)}) AS f,
  (SELECT count(*) FROM flights) AS g)
SELECT 1 AS position, 'null_times' AS step, a AS rows_in, a - b AS dropped FROM steps
UNION ALL SELECT 2, 'duplicate_rows', b, b - c FROM steps
UNION ALL SELECT 3, 'duplicate_ids', c, c - d FROM steps
UNION ALL SELECT 4, 'invalid_interval', d, d - e FROM steps
UNION ALL SELECT 5, 'unresolved_carrier', e, e - f FROM steps
UNION ALL SELECT 6, 'duration_range', f, f - g FROM steps""",
)


def _untidy_rows(name: str, columns: list[str]) -> str:
    """The raw table with the rows that the audit adds."""
    parts = [f"SELECT {', '.join(columns)} FROM raw_{name}"]
    for condition, changes in UNTIDY_ROWS[name]:
        changed = ", ".join(f"{changes[c]} AS {c}" if c in changes else c for c in columns)
        parts.append(f"SELECT {changed} FROM raw_{name} WHERE {condition}")
    return " UNION ALL ".join(parts)


def _audit(name: str, key: str, normal: str, variant: str, valid: str = "", missing: str = "") -> str:
    """Steps of a table: missing values, equal rows and, in the script variant, equal ids. `normal` is its form in which rows
    are compared."""
    columns = {"bookings": BOOKINGS_SQL, "passengers": PASSENGERS_SQL, "payments": [*PAYMENTS_SQL, *PAYMENT_ORDER]}[name]
    names = [c.rsplit(" AS ", 1)[-1] for c in columns]
    steps = [("rows_in", f"(SELECT count(*) FROM t_{name})")]
    where = f" WHERE {valid}" if valid else ""
    if valid:
        steps.append((missing, f"(SELECT count(*) FROM n_{name}{where})"))
    steps.append(("duplicate_rows", f"(SELECT count(*) FROM (SELECT DISTINCT * FROM n_{name}{where}))"))
    if variant == "script":
        steps.append(("duplicate_ids", f"(SELECT count(DISTINCT {key}) FROM n_{name}{where})"))
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{step}' AS step, {steps[i - 1][1]} AS rows_in, {steps[i - 1][1]} - {left} AS dropped"
        for i, (step, left) in enumerate(steps[1:], 1)
    )
    return (
        f", t_{name} AS ({_untidy_rows(name, names)}), n_{name} AS (SELECT {normal} FROM t_{name})",
        rows,
    )


def _audit_flights(variant: str) -> tuple[str, str]:
    names = ["flight_id", "airline", "source", "destination", "departure_time", "arrival_time"]
    complete = "departure_time IS NOT NULL AND arrival_time IS NOT NULL"
    tables = f"""
, t_flights AS ({_untidy_rows('flights', names)}),
n_flights AS (SELECT {', '.join(f"{_upper(c)} AS {c}" for c in names[:4])}, departure_time, arrival_time FROM t_flights),
one_untidy AS (SELECT * FROM n_flights WHERE {complete} QUALIFY row_number() OVER (PARTITION BY flight_id
  ORDER BY airline, source, destination, departure_time, arrival_time) = 1),
forward_untidy AS (SELECT *, {_impute('airline', 'flight_id')} AS carrier,
  {_minutes('departure_time', 'arrival_time')} AS m FROM one_untidy WHERE arrival_time > departure_time),
named_untidy AS (SELECT * FROM forward_untidy
  {f"WHERE carrier NOT IN {_in(C.CARRIER_PLACEHOLDERS)}" if variant == "script" else ""})"""
    left = [
        ("rows_in", "(SELECT count(*) FROM t_flights)"),
        ("null_times", f"(SELECT count(*) FROM n_flights WHERE {complete})"),
        ("duplicate_rows", f"(SELECT count(*) FROM (SELECT DISTINCT * FROM n_flights WHERE {complete}))"),
        ("duplicate_ids", "(SELECT count(*) FROM one_untidy)"),
        ("invalid_interval", "(SELECT count(*) FROM forward_untidy)"),
        ("unresolved_carrier", "(SELECT count(*) FROM named_untidy)"),
        ("duration_range", "(SELECT count(*) FROM named_untidy WHERE m > 0 AND m <= 1440)"),
    ]
    if variant != "script":
        del left[5]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS position, '{step}' AS step, {left[i - 1][1]} AS rows_in, {left[i - 1][1]} - {n} AS dropped"
        for i, (step, n) in enumerate(left[1:], 1)
    )
    return tables, rows


_PAX_NB = f"{_stripped('passenger_id')}, first_name, last_name, age, {_upper('gender')}, {_lower('email')}, phone, aadhaar_id, try_cast(date_of_birth AS timestamp)"
_PAX = (
    f"{_upper('passenger_id')} AS passenger_id, first_name, last_name, age, {_upper('gender')} = 'F', email, phone,"
    " aadhaar_id, try_cast(date_of_birth AS timestamp)"
)
_BOOKED = f"{_upper('booking_id')} AS booking_id, * EXCLUDE (booking_id)"
_BOOKED_NB = (
    f"{_stripped('booking_id')}, {_stripped('passenger_id')}, {_upper('flight_id')}, booking_date, {_upper('status')},"
    " passport_number, seat_number, emergency_contact_name, emergency_contact_phone"
)
_PAID = f"{_upper('payment_id')} AS payment_id, booking_id, amount, payment_method"
_PAID_NB = f"{_stripped('payment_id')}, {_stripped('booking_id')}, amount, {_upper('payment_method')}"
AUDITED = {
    "script": {
        "flights": _audit_flights("script"),
        "bookings": _audit("bookings", "booking_id", _BOOKED, "script"),
        "passengers": _audit("passengers", "passenger_id", _PAX, "script"),
        "payments": _audit("payments", "payment_id", _PAID, "script", "amount IS NOT NULL", "null_amount"),
    },
    "notebook": {
        "flights": _audit_flights("notebook"),
        "bookings": _audit("bookings", "booking_id", _BOOKED_NB, "notebook"),
        "passengers": _audit("passengers", "passenger_id", _PAX_NB, "notebook"),
        "payments": _audit("payments", "payment_id", _PAID_NB, "notebook", "amount IS NOT NULL", "null_amount"),
    },
}
for _name, (_tables, _rows) in AUDITED["script"].items():
    script(f"audit_{_name}", f"{_tables} {_rows}")
notebook(
    "audit_nb",
    "".join(tables for tables, _ in AUDITED["notebook"].values())
    + " UNION ALL ".join(f" SELECT '{name}' AS table_name, * FROM ({rows})" for name, (_, rows) in AUDITED["notebook"].items()),
)
script(
    "audit_clean_bookings",
    AUDITED["script"]["bookings"][0]
    + f" SELECT booking_id, {_upper('passenger_id')} AS passenger_id, {_upper('status')} AS status,"
    f" {_upper('seat_number')} AS seat_number FROM n_bookings"
    " QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY booking_date, n_bookings.passenger_id, n_bookings.status,"
    " n_bookings.seat_number) = 1",
)
script(
    "audit_raw_and_clean",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM raw_{t}) AS raw_rows, (SELECT count(*) FROM {t}) AS clean_rows"
        for t in ("flights", "bookings", "passengers", "payments")
    ),
)
script(
    "sink_typed_export",
    "SELECT booking_id, cast(booking_date AS varchar) AS booking_date, status, amount, payment_id, duration_mins,"
    " cast(is_delayed AS bigint) AS is_delayed, cast(is_overnight AS bigint) AS is_overnight,"
    " cast(age AS bigint) AS age FROM master",
)
script(
    "sink_model_types",
    "SELECT booking_id, payment_id, cast(booking_date AS date) AS booking_date, amount, duration_mins,"
    " cast(is_overnight AS bigint) AS is_overnight, cast(age AS bigint) AS age, gender FROM master",
)
script(
    "check_outputs",
    "SELECT table_name, table_name <> 'cleaned_payments' AND row_count > 0 AS ok, row_count"
    f" FROM ({_counts(CLEANED)}) UNION ALL SELECT 'kpi_route_traffic', false, 0",
)

# ---------------------------------------------------------------- projections, filters, nulls

script("project_columns", "SELECT flight_id, route, duration_mins FROM flights")
script("project_present", "SELECT passenger_id, age, age_group, gender FROM passengers")
plain("drop_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
script("drop_null_critical", "SELECT * FROM raw_flights WHERE destination IS NOT NULL AND arrival_time IS NOT NULL")
script(
    "filter_valid_interval",
    "SELECT flight_id, departure_time, arrival_time FROM raw_flights WHERE arrival_time > departure_time",
)
script(
    "filter_duration_range",
    f"SELECT * FROM (SELECT flight_id, {_minutes('departure_time', 'arrival_time')} AS duration_mins FROM raw_flights)"
    " WHERE duration_mins > 0 AND duration_mins <= 1440",
)
CARRIERS = """carriers AS (SELECT event_id,
  CASE event_type WHEN 'view' THEN 'UNKNOWN' WHEN 'click' THEN 'INDIGO' WHEN 'error' THEN 'NAN' WHEN 'signup' THEN ''
    ELSE 'UNKNOWN' END AS airline,
  CASE user_id % 7 WHEN 0 THEN 'AI' WHEN 1 THEN 'SJ' WHEN 2 THEN '6F' WHEN 3 THEN 'UK' WHEN 4 THEN 'G8'
    WHEN 5 THEN 'ai' ELSE 'XX' END || cast(event_id AS varchar) AS flight_id FROM events)"""
plain(
    "filter_not_in",
    f"WITH {CARRIERS} SELECT event_id, {_upper('airline')} AS airline, flight_id FROM carriers"
    f" WHERE {_upper('airline')} NOT IN {_in(C.CARRIER_PLACEHOLDERS)}",
)
plain("filter_not_equal", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
script(
    "filter_slicers",
    "SELECT flight_id, airline, route, departure_slot, cast(departure_time AS date) AS departure_date FROM flights"
    " WHERE airline IN ('CLICK', 'VIEW') AND departure_slot = 'Morning (09-12)'"
    " AND cast(departure_time AS date) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'",
)
script("detail_delayed", "SELECT flight_id, airline, route, duration_mins FROM flights WHERE is_delayed = 1")
script(
    "fill_null_constants",
    "SELECT p.passenger_id, coalesce(p.age, 0) AS age, coalesce(b.booking_id, -1) AS booking_id,"
    " coalesce(b.emergency_contact_name, 'Unknown') AS emergency_contact_name"
    " FROM raw_passengers p LEFT JOIN raw_bookings b ON p.passenger_id = b.passenger_id",
)
UNTIDY = """untidy AS (SELECT event_id, ts,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 5 = 0 THEN ''
    WHEN event_id % 3 = 0 THEN chr(9) || ' ' || event_type || ' ' || chr(10) ELSE upper(event_type) END AS raw,
  CASE WHEN event_id % 7 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL
    ELSE event_id + 0.25 END AS number,
  CASE WHEN event_id % 9 = 0 THEN 'soon' WHEN event_id % 10 = 0 THEN NULL
    ELSE cast(cast(ts AS date) AS varchar) || ' 07:30:00' END AS raw_time FROM events)"""


def untidy(name: str, columns: str) -> None:
    plain(name, f"WITH {UNTIDY} SELECT event_id, {columns} FROM untidy")


untidy(
    "fill_all_strings",
    f"{_strip(_text('raw', 'Unknown'))} AS raw, coalesce(raw_time, 'Unknown') AS raw_time",
)
script(
    "preview_head",
    "SELECT flight_id, route, duration_hhmm FROM flights ORDER BY departure_time, flight_id LIMIT 10",
)

# ---------------------------------------------------------------- duplicates

plain("dedup_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_quantity FROM lineitem")
FIRST_PAYMENT = f"QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY {', '.join(PAYMENT_ORDER)}) = 1"
script("dedup_first_by_key", f"SELECT payment_id, amount, payment_method FROM raw_payments {FIRST_PAYMENT}")
script(
    "dedup_valid_then_first",
    f"SELECT payment_id, amount, payment_method FROM raw_payments WHERE l_quantity >= 5 {FIRST_PAYMENT}",
)
script(
    "dedup_rows_then_valid",
    "SELECT DISTINCT booking_id, amount, payment_method FROM raw_payments WHERE l_quantity >= 5",
)
plain(
    "count_duplicate_rows",
    "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM"
    " (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)) AS duplicate_rows",
)

# ---------------------------------------------------------------- column functions

untidy("fn_norm_upper", f"{_upper('raw')} AS value")
untidy("fn_norm_lower", f"{_lower('raw')} AS value")
untidy("fn_strip", f"{_stripped('raw')} AS value")
untidy("fn_try_timestamp", "try_cast(raw_time AS timestamp) AS value")
untidy("fn_try_double", "cast(number AS double) AS value")
untidy(
    "fn_safe_numeric_fill",
    "coalesce(cast(number AS double), 0.0) AS value, cast(trunc(coalesce(number, 0)) AS int) AS whole",
)
untidy(
    "fn_time_slot",
    f"{_slot('ts')} AS value, {_slot('ts', True)} AS plain, {_slot('try_cast(raw_time AS timestamp)')} AS unsure",
)
plain(
    "fn_prefix_impute",
    f"WITH {CARRIERS} SELECT event_id, {_impute('airline', 'flight_id')} AS value FROM carriers",
)
plain(
    "fn_prefix_impute_bi",
    f"WITH {CARRIERS} SELECT event_id, {_impute_report('airline', 'flight_id')} AS value FROM carriers",
)
script(
    "fn_map_values",
    f", {CARRIERS} SELECT payment_id, {_values(C.PAYMENT_LABEL, 'upper(trim(payment_method))', 'upper(trim(payment_method))')}"
    f" AS value FROM raw_payments UNION ALL SELECT flight_id, {_values(C.CARRIER_SPELLING, 'airline', 'airline')} FROM carriers",
)
script(
    "fn_collapse_status",
    f"SELECT booking_id, CASE WHEN {_upper('status')} IN ('CONFIRMED', 'CANCELLED') THEN {_upper('status')}"
    " ELSE 'CONFIRMED' END AS value FROM raw_bookings",
)
script(
    "fn_binary_gender",
    f"SELECT passenger_id, CASE WHEN {_upper('gender')} = 'F' THEN 'F' ELSE 'M' END AS value FROM raw_passengers",
)
script("fn_age_group", f"SELECT passenger_id, {_age_group('age')} AS value FROM raw_passengers")
plain("fn_hour", "SELECT event_id, hour(ts) AS value FROM events")
plain("fn_date", "SELECT event_id, cast(ts AS date) AS value FROM events")
script(
    "fn_year",
    "SELECT passenger_id, coalesce(year(try_cast(date_of_birth AS timestamp)), 0) AS value,"
    " year(try_cast(date_of_birth AS timestamp)) AS nullable FROM raw_passengers",
)
script("fn_duration_minutes", f"SELECT flight_id, {_minutes('departure_time', 'arrival_time')} AS value FROM raw_flights")
script(
    "fn_overnight_flag",
    "SELECT flight_id, cast(cast(arrival_time AS date) > cast(departure_time AS date) AS int) AS value FROM raw_flights",
)
script("fn_duration_hhmm", "SELECT flight_id, duration_hhmm AS value FROM flights")
script("fn_route", "SELECT flight_id, source || ' to ' || destination AS value FROM raw_flights")
script("mask_hash_suffix", f"SELECT booking_id, {_hash_last('passport_number')} AS value FROM raw_bookings")
script("mask_hash_prefix", f"SELECT booking_id, {_hash_first('passport_number')} AS value FROM raw_bookings")
script("mask_name", f"SELECT booking_id, {_initial('emergency_contact_name')} AS value FROM raw_bookings")
script("mask_name_nb", f"SELECT booking_id, {_initial_raw('emergency_contact_name')} AS value FROM raw_bookings")
script(
    "generalise_dob",
    f"SELECT passenger_id, {_initial('first_name')} AS first_name, {_initial('last_name')} AS last_name, age, gender,"
    f" {_hash_last('email')} AS email, {_hash_last('phone')} AS phone, {_hash_last('aadhaar_id')} AS aadhaar_id,"
    " birth_year, age_group FROM passengers",
)
notebook(
    "generalise_dob_nb",
    f"SELECT passenger_id, age, gender, age_group, {_hash_first('aadhaar_id')} AS aadhaar_id_hash,"
    f" {_hash_first('email')} AS email_hash, {_hash_first('phone')} AS phone_hash,"
    f" {_initial_raw('first_name')} AS first_name_masked, {_initial_raw('last_name')} AS last_name_masked,"
    " birth_year FROM passengers",
)
script(
    "mask_bookings",
    f"SELECT booking_id, passenger_id, flight_id, booking_date, status, {_hash_last('passport_number')} AS passport_number,"
    f" seat_number, {_initial('emergency_contact_name')} AS emergency_contact_name,"
    f" {_hash_last('emergency_contact_phone')} AS emergency_contact_phone FROM bookings",
)
notebook(
    "mask_bookings_nb",
    f"SELECT booking_id, passenger_id, flight_id, booking_date, status, seat_number,"
    f" {_hash_first('passport_number')} AS passport_hash, {_hash_first('emergency_contact_phone')} AS emg_phone_hash,"
    f" {_initial_raw('emergency_contact_name')} AS emg_name_masked FROM bookings",
)
LINE_ID = "l_orderkey, l_linenumber, l_partkey"
plain(
    "fn_round_half_even",
    f"SELECT {LINE_ID}, {_round2('l_extendedprice * l_discount')} AS value, {_round2('l_quantity / 8')} AS eighths FROM lineitem",
)
plain("fn_percent", f"SELECT {LINE_ID}, CASE WHEN l_tax <> 0 THEN l_discount / l_tax * 100 END AS value FROM lineitem")
plain("fn_divide_default", f"SELECT {LINE_ID}, CASE WHEN l_tax <> 0 THEN l_discount / l_tax ELSE 0.0 END AS value FROM lineitem")
plain("fn_flag_to_int", "SELECT o_orderkey, cast(o_totalprice > 250000 AS int) AS value FROM orders")
plain(
    "fn_unit_scale_format",
    "SELECT o_orderkey, o_totalprice / 1e6 AS millions, cast(o_custkey AS double) / 60 AS hours,"
    " format('{:,}', o_custkey * 1000) AS display FROM orders",
)

# ---------------------------------------------------------------- joins

script(
    "join_booking_flight",
    "SELECT b.booking_id, b.flight_id, f.route, f.duration_mins FROM bookings b LEFT JOIN flights f ON b.flight_id = f.flight_id",
)
script(
    "join_fanout_payment",
    "SELECT b.booking_id, b.status, y.payment_id, y.amount, y.payment_method"
    " FROM bookings b LEFT JOIN payments y ON b.booking_id = y.booking_id",
)
script(
    "join_passenger_subset",
    "SELECT b.passenger_id, b.booking_id, b.status AS gender, p.age, p.age_group, p.gender AS gender_pax, p.birth_year,"
    f" {_initial('p.first_name')} AS first_name, {_initial('p.last_name')} AS last_name"
    " FROM bookings b LEFT JOIN passengers p ON b.passenger_id = p.passenger_id",
)
script(
    "master_4way",
    "SELECT booking_id, passenger_id, flight_id, status, route, duration_mins, is_overnight, is_delayed, payment_id,"
    f" amount, payment_method, age, age_group, gender, {_initial('first_name')} AS first_name FROM master",
)
notebook(
    "master_4way_nb",
    "SELECT booking_id, passenger_id, status, route, is_delayed, departure_hour, amount, payment_method, age_group,"
    f" gender, birth_year, {_initial_raw('first_name')} AS first_name_masked FROM master",
)
script(
    "join_inner_paid",
    "SELECT b.booking_id, b.flight_id, y.payment_id, y.amount, y.payment_method"
    " FROM bookings b JOIN payments y ON b.booking_id = y.booking_id",
)
script(
    "join_carrier_lookup",
    "SELECT b.flight_id, b.booking_id, f.airline, f.route FROM bookings b LEFT JOIN flights f ON b.flight_id = f.flight_id",
)
script(
    "join_pax_revenue",
    "SELECT b.booking_id, p.passenger_id, p.gender, p.age_group, y.amount FROM passengers p"
    " LEFT JOIN bookings b ON p.passenger_id = b.passenger_id LEFT JOIN payments y ON b.booking_id = y.booking_id",
)
script(
    "join_booking_pax_revenue",
    "SELECT booking_id, passenger_id, status, age, age_group, gender, payment_id, amount, payment_method FROM master",
)
script(
    "join_revenue_pax",
    "SELECT booking_id, passenger_id, flight_id, airline, route, gender, age_group, payment_id, amount, payment_method FROM master",
)

# ---------------------------------------------------------------- window operators

script(
    "win_group_mean",
    "SELECT flight_id, f.route, duration_mins, route_mean FROM flights f JOIN"
    f" (SELECT route, {_mean('duration_mins')} AS route_mean FROM flights GROUP BY route) m ON f.route = m.route",
)
script("win_delay_flag", "SELECT flight_id, route, duration_mins, is_delayed FROM flights")
plain(
    "win_share_of_total",
    f"SELECT o_orderpriority, count(*) AS n, {_round2('count(*) * 1.0::double / (SELECT count(*) FROM orders) * 100')} AS share_pct"
    " FROM orders GROUP BY 1",
)

# ---------------------------------------------------------------- KPI tables


def _pct(part: str, whole: str) -> str:
    return f"cast({part} AS double) / cast({whole} AS double) * 100"


KPI = {
    "kpi_route_traffic": f"SELECT route, count(*) AS flight_count, {_mean('duration_mins')} AS avg_duration_mins,"
    f" {_round2('cast(sum(is_delayed) AS double) / count(*) * 100')} AS delay_rate_pct FROM flights GROUP BY route",
    "kpi_avg_duration_by_airline": f"SELECT airline, {_mean('duration_mins')} AS avg_duration_mins,"
    " min(duration_mins) AS min_duration_mins, max(duration_mins) AS max_duration_mins FROM flights GROUP BY airline",
    "kpi_avg_duration_by_route": f"SELECT route, {_mean('duration_mins')} AS avg_duration_mins FROM flights GROUP BY route",
    "kpi_airline_distribution": "SELECT airline, count(*) AS flight_count,"
    f" {_round2(_pct('count(*)', '(SELECT count(*) FROM flights)'))} AS market_share_pct FROM flights GROUP BY airline",
    "kpi_delay_summary": "SELECT airline, count(*) AS total_flights, cast(sum(is_delayed) AS bigint) AS delayed_flights,"
    " cast(sum(is_overnight) AS bigint) AS overnight_flights,"
    f" {_round2(_pct('sum(is_delayed)', 'count(*)'))} AS delay_rate_pct FROM flights GROUP BY airline",
    "kpi_revenue_by_airline": f"SELECT airline, {_sum('amount')} AS total_revenue, count(b.booking_id) AS total_bookings,"
    f" {_mean('amount')} AS avg_ticket_value FROM bookings b JOIN payments y ON b.booking_id = y.booking_id"
    " LEFT JOIN flights f ON b.flight_id = f.flight_id WHERE airline IS NOT NULL GROUP BY airline",
    "kpi_departure_slots": "SELECT departure_slot, count(*) AS flight_count, cast(sum(is_delayed) AS bigint) AS delayed_flights,"
    f" {_round2(_pct('sum(is_delayed)', 'count(*)'))} AS delay_rate_pct FROM flights GROUP BY departure_slot",
    "kpi_booking_status": "SELECT status, count(*) AS booking_count,"
    f" {_round2(_pct('count(*)', '(SELECT count(*) FROM bookings)'))} AS percentage FROM bookings GROUP BY status",
    "kpi_payment_methods": "SELECT payment_method, count(payment_id) AS transaction_count,"
    f" {_sum('amount')} AS total_amount, {_mean('amount')} AS avg_amount FROM payments GROUP BY payment_method",
    "kpi_passenger_demographics": "SELECT gender, age_group, count(DISTINCT p.passenger_id) AS passenger_count,"
    f" count(b.booking_id) AS total_bookings, {_sum('amount')} AS total_spend FROM passengers p"
    " LEFT JOIN bookings b ON p.passenger_id = b.passenger_id LEFT JOIN payments y ON b.booking_id = y.booking_id"
    " GROUP BY gender, age_group",
    "kpi_frequent_flyers": f"SELECT p.passenger_id, {_initial('first_name')} AS first_name,"
    f" {_initial('last_name')} AS last_name, age_group, count(b.booking_id) AS total_bookings,"
    f" {_sum('amount')} AS total_spend FROM passengers p LEFT JOIN bookings b ON p.passenger_id = b.passenger_id"
    " LEFT JOIN payments y ON b.booking_id = y.booking_id GROUP BY ALL"
    " ORDER BY total_bookings DESC, total_spend DESC, p.passenger_id LIMIT 20",
    "kpi_airline_passenger_demographics": "SELECT airline, gender, age_group,"
    f" count(DISTINCT passenger_id) AS passenger_count, {_sum('amount')} AS revenue FROM master"
    " WHERE airline IS NOT NULL AND gender IS NOT NULL AND age_group IS NOT NULL GROUP BY ALL",
}
for _name, _sql in KPI.items():
    script(_name, _sql)
script("sink_kpis", _counts({name: f"({sql})" for name, sql in KPI.items()}))

# ---------------------------------------------------------------- extended reports

notebook(
    "nb_avg_by_airline",
    f"SELECT airline, {_round2(_mean('duration_mins'))} AS avg_duration_mins, min(duration_mins) AS min_duration_mins,"
    " max(duration_mins) AS max_duration_mins, count(*) AS flight_count FROM flights GROUP BY airline",
)
NB_ROUTE = f"SELECT route, {_round2(_mean('duration_mins'))} AS avg_duration_mins, count(*) AS flight_count FROM flights GROUP BY route"
notebook("nb_avg_by_route", NB_ROUTE)
DELAYS = (
    "cast(sum(is_delayed) AS bigint) AS delayed_flights, cast(sum(is_overnight) AS bigint) AS {night},"
    f' {_round2(_pct("sum(is_delayed)", "count(*)"))} AS "delay_rate_%" FROM flights GROUP BY '
)
notebook(
    "nb_route_traffic",
    f"SELECT route, count(*) AS flight_count, {_round2(_mean('duration_mins'))} AS avg_duration,"
    f" {DELAYS.format(night='overnight_flights')} route",
)
notebook("nb_delay_summary", f"SELECT airline, count(*) AS total_flights, {DELAYS.format(night='overnight_count')} airline")
notebook(
    "nb_airline_dist",
    f"SELECT airline, count(*) AS flight_count, {_round2(_mean('duration_mins'))} AS avg_duration_mins,"
    " min(duration_mins) AS min_duration_mins, max(duration_mins) AS max_duration_mins,"
    f" {_round2(_pct('count(*)', '(SELECT count(*) FROM flights)'))} AS \"market_share_%\" FROM flights GROUP BY airline",
)
notebook(
    "nb_revenue_by_airline",
    f"SELECT airline, {_round2(_sum('amount'))} AS total_revenue, {_round2(_mean('amount'))} AS avg_ticket_price,"
    " count(amount) AS bookings_with_payment FROM master WHERE airline IS NOT NULL GROUP BY airline",
)
notebook("nb_slot_traffic", "SELECT departure_slot, count(flight_id) AS flight_count FROM flights GROUP BY 1")
notebook("nb_booking_status", "SELECT status, count(booking_id) AS count FROM bookings GROUP BY 1")
notebook(
    "nb_payment_method",
    f"SELECT payment_method, count(amount) AS count, {_round2(_sum('amount'))} AS sum FROM payments GROUP BY 1",
)
notebook(
    "nb_passenger_demographics",
    "SELECT gender, age_group, count(DISTINCT passenger_id) AS total_passengers, count(booking_id) AS total_bookings,"
    f" {_round2(_sum('amount'))} AS total_revenue, {_round2(_mean('amount'))} AS avg_spend FROM master"
    " WHERE gender IS NOT NULL AND age_group IS NOT NULL GROUP BY 1, 2",
)
notebook(
    "nb_frequent_flyers",
    "SELECT passenger_id, gender, age_group, count(booking_id) AS total_bookings,"
    " count(*) FILTER (WHERE status = 'CONFIRMED') AS confirmed_bookings,"
    f" {_round2(_sum('amount'))} AS total_spend, {_round2(_mean('amount'))} AS avg_spend_per_booking FROM master"
    " WHERE gender IS NOT NULL AND age_group IS NOT NULL GROUP BY 1, 2, 3",
)
notebook(
    "nb_airline_pax_demographics",
    "SELECT airline, gender, age_group, count(booking_id) AS booking_count, count(DISTINCT passenger_id) AS passenger_count,"
    f" {_round2(_sum('amount'))} AS total_revenue, {_round2(_mean('amount'))} AS avg_revenue FROM master"
    " WHERE airline IS NOT NULL AND gender IS NOT NULL AND age_group IS NOT NULL GROUP BY 1, 2, 3",
)
notebook(
    "global_kpis",
    f"SELECT {_mean('duration_mins')} AS avg_duration_mins, {_mean('duration_mins')} / 60 AS avg_duration_hours,"
    " cast(sum(is_delayed) AS bigint) AS total_delayed, cast(sum(is_overnight) AS bigint) AS total_overnight,"
    f" {_pct('sum(is_delayed)', 'count(*)')} AS delay_rate_pct, count(DISTINCT route) AS unique_routes,"
    " count(DISTINCT airline) AS active_airlines FROM flights",
)
script("median_duration", f"SELECT median(duration_mins) AS median, {_mean('duration_mins')} AS mean FROM flights")
script(
    "histogram_duration",
    ", edges AS (SELECT min(duration_mins) AS low, max(duration_mins) AS high FROM flights),"
    " placed AS (SELECT least(cast(floor((duration_mins - low) / ((high - low) / 40)) AS int) + 1, 40) AS bin FROM flights, edges)"
    " SELECT cast(b.bin AS int) AS bin, count(placed.bin) AS count FROM range(1, 41) b(bin)"
    " LEFT JOIN placed ON placed.bin = b.bin GROUP BY 1",
)
EVENT_TYPES = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
script(
    "pivot_route_matrix",
    "SELECT source, "
    + ", ".join(f'count(*) FILTER (WHERE destination = \'{t}\') AS "{t}"' for t in EVENT_TYPES)
    + f', count(*) FILTER (WHERE destination NOT IN {_in(EVENT_TYPES)}) AS "OTHER"'
    + " FROM flights GROUP BY source",
)
script("pair_route_counts", "SELECT source, destination, count(*) AS count FROM flights GROUP BY ALL")
script(
    "histogram_constant",
    "SELECT cast(b.bin AS int) AS bin, CASE b.bin WHEN 21 THEN (SELECT count(*) FROM flights) ELSE 0 END AS count"
    " FROM range(1, 41) b(bin)",
)
CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}
plain(
    "profile_table",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count(*) - count({c}) AS null_count,"
        f" {_round2(_pct(f'count(*) - count({c})', 'count(*)'))} AS null_pct, count(DISTINCT {c}) AS unique_count,"
        f" coalesce(arg_min(cast({c} AS varchar), c_custkey) FILTER (WHERE {c} IS NOT NULL), 'N/A') AS sample FROM customer"
        for c, t in CUSTOMER_TYPES.items()
    ),
)
script("value_counts", "SELECT departure_slot, count(*) AS flight_count FROM flights GROUP BY 1")
script(
    "value_counts_map",
    "SELECT '{' || string_agg('\"' || k || '\":' || n, ',' ORDER BY k) || '}' AS counts"
    " FROM (SELECT departure_slot AS k, count(*) AS n FROM flights GROUP BY 1)",
)
SLOT_ROWS = ", ".join(f"({i}, '{s}')" for i, s in enumerate([*C.SLOT_ORDER_WITH_HOURS, "Unknown"]))
script(
    "count_over_fixed_categories",
    f"SELECT position, c.departure_slot, coalesce(n, 0) AS count, n AS count_or_null FROM (VALUES {SLOT_ROWS}) c(position, departure_slot)"
    " LEFT JOIN (SELECT departure_slot, count(*) AS n FROM flights GROUP BY 1) f ON c.departure_slot = f.departure_slot",
)

# ---------------------------------------------------------------- report measures

MEASURE = {
    "total_flights": "count(DISTINCT flight_id)",
    "total_bookings": "count(*)",
    "total_revenue": _sum("amount"),
    "avg_duration": _mean("duration_mins"),
    "avg_duration_zero_filled": _mean("coalesce(duration_mins, 0)"),
    "delayed_flights": "count(*) FILTER (WHERE is_delayed = 1)",
    "overnight_flights": "count(*) FILTER (WHERE is_overnight = 1)",
    "unique_passengers": "count(DISTINCT passenger_id)",
    "avg_age": _mean("age"),
    "avg_age_zero_filled": _mean("coalesce(age, 0)"),
    "delay_rate": _pct("count(*) FILTER (WHERE is_delayed = 1)", "count(*)"),
    "overnight_pct": _pct("count(*) FILTER (WHERE is_overnight = 1)", "count(*)"),
    "spend_per_passenger": f"{_sum('amount')} / count(DISTINCT passenger_id)",
    "confirmation_rate": _pct("count(*) FILTER (WHERE status = 'CONFIRMED')", "count(*)"),
}
SPELLED_AIRLINE = "CASE WHEN airline IS NULL THEN 'Unknown' ELSE " + _values(C.CARRIER_SPELLING, "airline", "airline") + " END"
REPORT_AIRLINE = _impute_report(f"({SPELLED_AIRLINE})", "flight_id")
REPORT_STATUS = (
    f"CASE WHEN {_upper('status')} IN ('CONFIRMED', 'CANCELLED') THEN {_upper('status')} ELSE 'CONFIRMED' END"
)
REPORT_METHOD = _values(C.PAYMENT_LABEL, "coalesce(payment_method, 'UPI')", "payment_method")


def _measures(names: list[str], by: str = "", label: str = "") -> str:
    values = ", ".join(f"{MEASURE[n]} AS {n}" for n in names)
    return f"SELECT {label} AS {by}, {values} FROM master GROUP BY 1" if by else f"SELECT {values} FROM master"


script(
    "m_total_flights",
    "SELECT count(DISTINCT flight_id) AS total_flights, (SELECT count(*) FROM flights) AS clean_flights FROM master",
)
script("m_avg_duration", _measures(["avg_duration", "avg_duration_zero_filled"]))
script("m_avg_age", _measures(["avg_age", "avg_age_zero_filled"]))
for _name in (
    "total_bookings", "total_revenue", "delayed_flights", "overnight_flights", "unique_passengers", "delay_rate",
    "overnight_pct", "spend_per_passenger", "confirmation_rate",
):
    script(f"m_{_name}", _measures([_name]))
script(
    "measures_by_dimension",
    _measures(
        ["total_flights", "total_bookings", "total_revenue", "delayed_flights", "unique_passengers"], "airline", REPORT_AIRLINE
    ),
)
script("measures_by_delayed", _measures(["total_bookings", "delayed_flights"], "is_delayed", "coalesce(cast(is_delayed AS varchar), 'Unknown')"))
script("measures_by_status", _measures(["total_bookings", "confirmation_rate"], "status", REPORT_STATUS))
script("measures_by_route", _measures(["delayed_flights", "delay_rate"], "route", "coalesce(route, 'Unknown')"))
script("measures_by_payment_method", _measures(["total_revenue", "total_bookings"], "payment_method", REPORT_METHOD))
script(
    "measures_by_age_group",
    _measures(["unique_passengers", "spend_per_passenger"], "age_group", "coalesce(age_group, 'Unknown')"),
)
_DISTINCT = ["total_flights", "unique_passengers"]
_VALUE_SQL = {
    "airline": REPORT_AIRLINE,
    "route": "coalesce(route, 'Unknown')",
    "status": REPORT_STATUS,
    "age_group": "coalesce(age_group, 'Unknown')",
    "gender": "coalesce(gender, 'Unknown')",
}
script(
    "distinct_from_sets",
    " UNION ALL ".join(
        [f"SELECT '{c}' AS \"by\", * FROM ({_measures(_DISTINCT, 'value', sql)})" for c, sql in _VALUE_SQL.items()]
        + [f"SELECT 'everything' AS \"by\", 'everything' AS value, * FROM ({_measures(_DISTINCT)})"]
    ),
)
script(
    "measures_from_sets",
    _measures(
        ["total_flights", "total_bookings", "total_revenue", "unique_passengers", "spend_per_passenger"], "airline", REPORT_AIRLINE
    ),
)
SLICED_ROWS = {
    "route": "route IN ('VIEW to CLICK', 'CLICK to VIEW')",
    "status": "status = 'CONFIRMED'",
    "age_group": "age_group IN ('18-30', '60+')",
    "dates": "departure_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'",
    "delayed": "is_delayed = 1",
    "method": "payment_method = 'UPI'",
    "page": "status IN ('CONFIRMED', 'CANCELLED') AND age_group IN ('18-30', '31-45', '46-60', '60+')"
    " AND departure_time BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-25' AND payment_method IN ('CARD', 'UPI')",
}
_SLICED = ["total_flights", "total_bookings", "total_revenue", "delayed_flights", "unique_passengers"]
script(
    "measures_with_slicers",
    " UNION ALL ".join(
        _measures(_SLICED, "airline", f"'{name}' AS slicers, {REPORT_AIRLINE}").replace("GROUP BY 1", f"WHERE {rows} GROUP BY 1, 2")
        for name, rows in SLICED_ROWS.items()
    ),
)
script(
    "daily_volume", "SELECT cast(departure_time AS date) AS departure_date, count(*) AS flight_count FROM flights GROUP BY 1"
)
script(
    "top_routes",
    "SELECT coalesce(route, 'Unknown') AS route, count(*) AS row_count FROM master GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
script("revenue_by_airline_bi", _measures(["total_revenue"], "airline", REPORT_AIRLINE))
script(
    "payment_split",
    f", split AS (SELECT {REPORT_METHOD} AS payment_method, count(*) AS row_count, {_sum('amount')} AS total_revenue"
    " FROM master GROUP BY 1) SELECT payment_method, row_count, total_revenue,"
    f" {_round2(_pct('row_count', '(SELECT count(*) FROM master)'))} AS row_share_pct,"
    f" {_round2(_pct('total_revenue', '(SELECT sum(cast(amount AS decimal(18,2))) FROM master)'))} AS revenue_share_pct FROM split",
)
script(
    "delayed_vs_ontime",
    "SELECT airline, count(*) FILTER (WHERE is_delayed = 1) AS delayed_flights,"
    " count(*) FILTER (WHERE is_delayed = 0) AS on_time_flights FROM flights GROUP BY 1",
)
script("overnight_by_airline", "SELECT airline, cast(sum(is_overnight) AS bigint) AS overnight_flights FROM flights GROUP BY 1")
script(
    "worst_route",
    f"SELECT route, flight_count, delay_rate_pct FROM ({KPI['kpi_route_traffic']}) ORDER BY delay_rate_pct DESC, route LIMIT 1",
)
AGE_ROWS = ", ".join(f"({i}, '{g}')" for i, g in enumerate(C.AGE_GROUPS))
script(
    "age_group_revenue",
    f"SELECT position, a.age_group, count(b.booking_id) AS total_bookings, {_sum('y.amount')} AS total_revenue"
    f" FROM (VALUES {AGE_ROWS}) a(position, age_group) LEFT JOIN passengers p ON a.age_group = p.age_group"
    " LEFT JOIN bookings b ON p.passenger_id = b.passenger_id LEFT JOIN payments y ON b.booking_id = y.booking_id GROUP BY 1, 2",
)
script(
    "gender_split",
    f"SELECT gender, count(*) AS passenger_count, {_round2(_pct('count(*)', '(SELECT count(*) FROM passengers)'))} AS share_pct"
    " FROM passengers GROUP BY 1",
)
script(
    "bi_normalised_master",
    f"SELECT booking_id, flight_id, {REPORT_AIRLINE} AS airline,"
    " CASE WHEN status IN ('CONFIRMED', 'CANCELLED') THEN status ELSE 'CONFIRMED' END AS status,"
    f" coalesce(payment_id, 'Unknown') AS payment_id, {REPORT_METHOD} AS payment_method, coalesce(amount, 0.0) AS amount,"
    " coalesce(duration_mins, 0.0) AS duration_mins, coalesce(is_delayed, 0) AS is_delayed,"
    " coalesce(is_overnight, 0) AS is_overnight, cast(coalesce(age, 0) AS int) AS age,"
    " coalesce(route, 'Unknown') AS route, coalesce(departure_slot, 'Unknown') AS departure_slot,"
    " coalesce(gender, 'Unknown') AS gender, coalesce(age_group, 'Unknown') AS age_group FROM master",
)

# ---------------------------------------------------------------- sorting and top rows

plain("sort_single", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
plain("sort_multi", "SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders ORDER BY 1, 2, 3")
plain("sort_stored", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders")
plain(
    "sort_stored_multi",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority,"
    " row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, o_orderkey) AS position FROM orders",
)
plain(
    "sort_order_report",
    " UNION ALL ".join(
        f"SELECT '{name}' AS sorted_by, count(*) AS row_count, 0::BIGINT AS rows_out_of_order, 0::BIGINT AS files_out_of_order,"
        " 0::BIGINT AS changed_files FROM orders"
        for name in ("single", "multi")
    ),
)
plain("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
script("bottom_up_order", f"{NB_ROUTE} ORDER BY avg_duration_mins DESC, route LIMIT 15")
