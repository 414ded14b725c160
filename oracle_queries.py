"""The expected results as DuckDB SQL, written apart from the Spark code.

All queries share one prefix: the source relations derived from the order
tables, BR-21 as a recursive query over the events themselves (it knows nothing
of the distinct-slot reduction), and the seven tables.
"""

from __future__ import annotations

SOURCES = """
fx_groups AS (
  SELECT c_custkey // 5 AS number, min(c_mktsegment) AS model, min(c_nationkey) AS nation FROM customer GROUP BY 1
),
fx_numbers AS (
  SELECT number, 'XY-' || number AS registration, model,
         CASE WHEN number % 4 = 0 THEN 'Embraer' WHEN nation % 4 = 0 THEN 'Boeing' ELSE 'Airbus' END AS manufacturer
  FROM fx_groups WHERE number % 7 <> 0
),
fx_aircraft AS (
  SELECT registration, model, manufacturer FROM fx_numbers
  UNION ALL SELECT registration, model, manufacturer FROM fx_numbers WHERE number % 13 = 0
  UNION ALL SELECT registration, 'GLIDER', 'Boeing' FROM fx_numbers WHERE number % 11 = 0
  UNION ALL SELECT NULL, model, manufacturer FROM fx_numbers WHERE number % 50 = 0
),
fx_known AS (SELECT DISTINCT registration FROM fx_aircraft WHERE registration IS NOT NULL),
fx_ops AS (
  SELECT 'XY-' || (o_custkey // 5) AS reg, o_orderkey AS k, o_orderstatus AS st,
         make_timestamp(year(o_orderdate),
                        CASE WHEN o_orderkey % 4 = 0 THEN 1 + (o_orderkey // 4) % 12 ELSE 1 + 10 * (o_orderkey % 2) END,
                        CASE WHEN o_orderkey % 4 = 0 THEN 1 + (o_orderkey // 48) % 28 ELSE 9 + (o_orderkey // 2) % 2 END,
                        (o_orderkey * 7) % 22, (o_orderkey * 13) % 60, 0) AS sd,
         to_hours(1 + o_orderkey % 5) AS dur, to_minutes((o_orderkey * 11) % 45 - 10) AS late
  FROM orders
),
fx_flights AS (
  SELECT reg, k, sd, sd + dur AS sa,
         CASE WHEN k % 37 = 0 THEN sd + late + dur ELSE sd + late END AS ad,
         CASE WHEN k % 31 = 0 THEN NULL WHEN k % 37 = 0 THEN sd + late ELSE sd + late + dur END AS aa,
         CASE WHEN k % 23 <> 0 THEN k % 29 = 0 END AS flag, k % 23 <> 0 AND k % 29 = 0 AS cancelled
  FROM fx_ops WHERE st <> 'P'
),
fx_maint AS (
  SELECT reg, k, sd, sd + dur AS sa, CASE WHEN k % 17 <> 0 THEN k % 3 <> 0 END AS flag,
         k % 17 <> 0 AND k % 3 <> 0 AS programmed
  FROM fx_ops WHERE st = 'P'
),
fx_reports AS (
  SELECT CASE WHEN l_partkey % 97 <> 0 THEN 'XY-' || (l_partkey // 6) END AS reg, l_shipdate AS rd,
         CASE WHEN l_orderkey % 41 <> 0 THEN l_suppkey END AS rid,
         CASE WHEN l_linenumber = 7 THEN 'CABIN' WHEN l_orderkey % 53 = 0 THEN NULL
              WHEN l_returnflag = 'N' THEN 'PIREP' WHEN l_returnflag IN ('A', 'R') THEN 'MAREP' END AS cls
  FROM lineitem
),
fx_personnel AS (
  SELECT CASE WHEN s_suppkey % 3 = 0 THEN ' ' || s_suppkey || '  ' ELSE CAST(s_suppkey AS VARCHAR) END AS rid,
         upper(substr(n_name, 1, 3)) AS airport
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 10 <> 0
)"""

# Aircraft that the lookup does not know, a missing one included.
FOREIGN = "(reg IS NULL OR reg NOT IN (SELECT registration FROM fx_known))"


def _day_id(ts: str) -> str:
    return f"(year({ts}) || '-' || month({ts}) || '-' || day({ts}))"


def _month_id(ts: str) -> str:
    return f"(year({ts}) || lpad(CAST(month({ts}) AS VARCHAR), 2, '0'))"


def _us(a: str, b: str) -> str:
    """Microseconds from a to b."""
    return f"(epoch_us({b}) - epoch_us({a}))"


def _hundredths(us: str, unit: str) -> str:
    """Exact microseconds to hundredths of a unit, half away from zero, as DECIMAL."""
    return (
        f"CAST(CAST(sign({us}) * ((200 * abs({us}) + {unit}) // (2 * {unit})) AS DECIMAL(18,0)) / 100 AS DECIMAL(10,2))"
    )


HOUR, DAY, MINUTE = "3600000000", "86400000000", "60000000"

# One row per event that takes a slot, numbered in processing order.
EVENTS = """
ev AS (
  SELECT 0 AS act, reg, k, sd, ad AS t0, aa AS t1, hour(ad) AS s, hour(aa) AS e, CAST(NULL AS BOOLEAN) AS programmed
  FROM fx_flights WHERE NOT cancelled AND ad IS NOT NULL AND aa IS NOT NULL
  UNION ALL
  SELECT 1, reg, k, sd, sd, sa, hour(sd), hour(sa), programmed FROM fx_maint
),
ranked AS (
  SELECT *, CAST(sd AS DATE) AS d,
         row_number() OVER (PARTITION BY reg, CAST(sd AS DATE) ORDER BY act, t0, k) AS rn FROM ev
),
walk AS (
  SELECT reg, d, rn, act, k, true AS ok, [{'s': s, 'e': e}] AS slots, CAST([] AS STRUCT(s BIGINT, e BIGINT)[]) AS prior
  FROM ranked WHERE rn = 1
  UNION ALL
  SELECT r.reg, r.d, r.rn, r.act, r.k,
         len(list_filter(w.slots, lambda z: r.s < z.e AND z.s < r.e)) = 0,
         CASE WHEN len(list_filter(w.slots, lambda z: r.s < z.e AND z.s < r.e)) = 0
              THEN list_append(w.slots, {'s': r.s, 'e': r.e}) ELSE w.slots END,
         w.slots
  FROM walk w JOIN ranked r ON r.reg = w.reg AND r.d = w.d AND r.rn = w.rn + 1
),
decided AS (
  SELECT r.*, w.ok, w.prior FROM ranked r JOIN walk w ON r.reg = w.reg AND r.d = w.d AND r.rn = w.rn
)"""

NO_RULES_EVENTS = """
ev AS (
  SELECT 0 AS act, reg, k, sd, ad AS t0, aa AS t1, CAST(NULL AS BOOLEAN) AS programmed
  FROM fx_flights WHERE NOT cancelled AND ad IS NOT NULL AND aa IS NOT NULL
  UNION ALL
  SELECT 1, reg, k, sd, sd, sa, programmed FROM fx_maint
),
decided AS (SELECT *, true AS ok FROM ev)"""


def _tables(rules: bool) -> str:
    start, end = ("least(t0, t1)", "greatest(t0, t1)") if rules else ("t0", "t1")
    return f"""
flown AS (
  SELECT reg, sd, {_us(start, end)} AS fus, {_us("sd", start)} AS dus FROM decided WHERE act = 0 AND ok
),
dead AS (
  SELECT reg, sd FROM fx_flights WHERE cancelled OR ad IS NULL OR aa IS NULL
),
out_of_service AS (
  SELECT reg, sd, {_us("t0", "t1")} AS mus, programmed FROM decided WHERE act = 1 AND ok
),
t_days AS (
  SELECT DISTINCT {_day_id("sd")} AS day_id, CAST(day(sd) AS INTEGER) AS day, {_month_id("sd")} AS month_id FROM fx_flights
),
t_months AS (
  SELECT DISTINCT {_month_id("d")} AS month_id, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year
  FROM (SELECT sd AS d FROM fx_flights UNION ALL SELECT sd FROM fx_maint
        UNION ALL SELECT rd FROM fx_reports WHERE reg IN (SELECT registration FROM fx_known))
),
t_aircrafts AS (
  SELECT registration, model, manufacturer FROM fx_aircraft WHERE registration IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY registration ORDER BY model DESC, manufacturer DESC) = 1
),
kept AS (
  SELECT reg, rd, coalesce(CAST(rid AS VARCHAR), 'None') AS rid, cls
  FROM fx_reports WHERE reg IN (SELECT registration FROM fx_known)
),
roles AS (
  SELECT rid, cls FROM (
    SELECT rid, cls, row_number() OVER (PARTITION BY rid ORDER BY rd DESC, cls DESC NULLS LAST) AS rn FROM kept) WHERE rn = 1
),
t_reporteurs AS (
  SELECT coalesce(trim(p.rid), r.rid) AS reporteur_uid, p.airport, r.cls AS role
  FROM fx_personnel p FULL OUTER JOIN roles r ON trim(p.rid) = r.rid
),
daily_rows AS (SELECT DISTINCT reg, {_day_id("sd")} AS day_id FROM fx_flights),
daily_flown AS (SELECT reg, {_day_id("sd")} AS day_id, sum(fus) AS fus, count(*) AS n FROM flown GROUP BY ALL),
daily_dead AS (SELECT reg, {_day_id("sd")} AS day_id, count(*) AS n FROM dead GROUP BY ALL),
t_daily AS (
  SELECT r.reg AS registration, r.day_id, {_hundredths("coalesce(f.fus, 0)", HOUR)} AS fh,
         CAST(coalesce(f.n, 0) AS INTEGER) AS tos, CAST(coalesce(f.n, 0) + coalesce(c.n, 0) AS INTEGER) AS sto
  FROM daily_rows r LEFT JOIN daily_flown f USING (reg, day_id) LEFT JOIN daily_dead c USING (reg, day_id)
),
monthly_rows AS (
  SELECT reg, {_month_id("sd")} AS month_id FROM fx_flights UNION SELECT reg, {_month_id("sd")} FROM out_of_service
),
monthly_flown AS (
  SELECT reg, {_month_id("sd")} AS month_id, count(*) AS dy, sum(dus) AS dus FROM flown WHERE dus > 900000000 GROUP BY ALL
),
monthly_dead AS (SELECT reg, {_month_id("sd")} AS month_id, count(*) AS cn FROM dead GROUP BY ALL),
monthly_out AS (
  SELECT reg, {_month_id("sd")} AS month_id, sum(mus) AS mus,
         sum(CASE WHEN programmed THEN mus ELSE 0 END) AS pus, sum(CASE WHEN programmed THEN 0 ELSE mus END) AS uus
  FROM out_of_service GROUP BY ALL
),
t_monthly AS (
  SELECT r.reg AS registration, r.month_id, CAST(coalesce(f.dy, 0) AS INTEGER) AS dy, CAST(coalesce(c.cn, 0) AS INTEGER) AS cn,
         {_hundredths("coalesce(f.dus, 0)", HOUR)} AS dh,
         {_hundredths("coalesce(m.mus, 0)", DAY)} AS ados,
         {_hundredths("coalesce(m.pus, 0)", DAY)} AS adoss,
         {_hundredths("coalesce(m.uus, 0)", DAY)} AS adosu,
         {_hundredths("(2629800000000 - coalesce(m.mus, 0))", DAY)} AS adis
  FROM monthly_rows r LEFT JOIN monthly_flown f USING (reg, month_id)
       LEFT JOIN monthly_dead c USING (reg, month_id) LEFT JOIN monthly_out m USING (reg, month_id)
),
t_reportage AS (
  SELECT reg AS registration, {_month_id("rd")} AS month_id, rid AS reporteur_uid, CAST(count(*) AS INTEGER) AS reps,
         CAST(count(*) FILTER (WHERE cls = 'MAREP') AS INTEGER) AS mareps,
         CAST(count(*) FILTER (WHERE cls = 'PIREP') AS INTEGER) AS pireps
  FROM kept GROUP BY ALL
)"""


DAILY, MONTHLY = ("fh", "tos", "sto"), ("ados", "adoss", "adosu", "adis", "dh", "dy", "cn")
REPORTED = ("reps", "mareps", "pireps")


def _named(measures: tuple[str, ...], kind: str) -> str:
    """A list of (measure, value) for UNNEST."""
    return "[" + ", ".join(f"{{'measure': '{m}', 'value': CAST({m} AS {kind})}}" for m in measures) + "]"


def _wide(measures: tuple[str, ...]) -> str:
    return ", ".join(f"sum(x.value) FILTER (x.measure = '{m}') AS {m}" for m in measures)


def _yearly() -> str:
    """KPIs from one long table of measures per aircraft and year, laid out once per group."""
    day_months = "(SELECT u.*, d.month_id FROM t_daily u JOIN t_days d ON d.day_id = u.day_id)"
    facts = ((day_months, DAILY), ("t_monthly", MONTHLY), ("t_reportage", REPORTED))
    longs = " UNION ALL ".join(
        f"SELECT registration, month_id, unnest({_named(measures, 'DECIMAL(28,2)')}) AS x FROM {fact}" for fact, measures in facts
    )
    return f"""
measures AS ({longs}),
per_group AS (
  SELECT a.manufacturer, m.year, {_wide(DAILY + MONTHLY + REPORTED)},
         count(DISTINCT a.registration) FILTER (x.measure = 'fh') AS aircraft
  FROM measures JOIN t_months m ON m.month_id = measures.month_id
       JOIN t_aircrafts a ON a.registration = measures.registration
  GROUP BY a.manufacturer, m.year
),
q_utilization AS (
  SELECT manufacturer, year,
         {", ".join(f"round({m} / aircraft, 2) AS {m}" for m in ("fh", "tos", "adoss", "adosu", "ados", "adis"))},
         round(fh / nullif(24 * adis, 0), 2) AS du, round(tos / nullif(adis, 0), 2) AS dc,
         round(100 * dy / nullif(sto, 0), 2) AS dyr, round(100 * cn / nullif(tos, 0), 2) AS cnr,
         round(100 * (1 - (dy + cn) / nullif(sto, 0)), 2) AS tdr, round(6000 * dh / nullif(dy, 0), 2) AS "add"
  FROM per_group WHERE aircraft > 0 AND adis IS NOT NULL
),
reported AS (
  SELECT manufacturer, year, fh, tos, unnest({_named(REPORTED, "DECIMAL(28,2)")}) AS x
  FROM per_group WHERE aircraft > 0 AND reps IS NOT NULL
),
rates AS (
  SELECT manufacturer, year, x.measure AS counted,
         1000 * round(x.value / nullif(fh, 0), 3) AS rrh, 100 * round(x.value / nullif(tos, 0), 2) AS rrc
  FROM reported
),
q_reporting AS (SELECT manufacturer, year, rrh, rrc FROM rates WHERE counted = 'reps'),
q_per_role AS (
  SELECT manufacturer, year, upper(rtrim(counted, 's')) AS role, rrh, rrc FROM rates WHERE counted <> 'reps'
)"""


YEARLY = _yearly()


def _maker(reg: str) -> str:
    return (
        f"CASE WHEN {reg} IN (SELECT registration FROM fx_aircraft WHERE manufacturer = 'Airbus') THEN 'Airbus' "
        f"WHEN {reg} IN (SELECT registration FROM fx_aircraft WHERE manufacturer = 'Boeing') THEN 'Boeing' ELSE {reg} END"
    )


def _exact(num: str, den: str, scale: int) -> str:
    """Integer ratio rounded half away from zero, in units of 1/scale."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d}) * "
        f"((2 * {scale} * abs({n}) + abs({d})) // (2 * abs({d}))) END)"
    )


RAW_FLIGHT = ("flight_us", "cycles", "cancellations", "delays", "delay_us")
RAW_OUT = ("programmed_us", "unprogrammed_us")
LATE = f"(NOT cancelled AND {_us('sa', 'aa')} > 900000000)"

RAW = f"""
raw_flights AS (
  SELECT reg, CAST(year(sd) AS VARCHAR) AS year, CASE WHEN cancelled THEN 0 ELSE {_us("ad", "aa")} END AS flight_us,
         CAST(NOT cancelled AS INTEGER) AS cycles, CAST(cancelled AS INTEGER) AS cancellations,
         CAST(coalesce({LATE}, false) AS INTEGER) AS delays, CASE WHEN {LATE} THEN {_us("sa", "aa")} ELSE 0 END AS delay_us
  FROM fx_flights
),
raw_out AS (
  SELECT reg, CAST(year(sd) AS VARCHAR) AS year, CASE WHEN programmed THEN {_us("sd", "sa")} ELSE 0 END AS programmed_us,
         CASE WHEN programmed THEN 0 ELSE {_us("sd", "sa")} END AS unprogrammed_us
  FROM fx_maint
),
raw_measures AS (
  SELECT reg, year, unnest({_named(RAW_FLIGHT, "BIGINT")}) AS x FROM raw_flights
  UNION ALL SELECT reg, year, unnest({_named(RAW_OUT, "BIGINT")}) FROM raw_out
),
raw_groups AS (
  SELECT {_maker("reg")} AS manufacturer, year, count(DISTINCT reg) AS n, {_wide(RAW_FLIGHT + RAW_OUT)}
  FROM raw_measures GROUP BY 1, 2
),
raw_units AS (
  SELECT manufacturer, year, coalesce(cycles, 0) AS cycles, coalesce(cancellations, 0) AS cancellations,
         coalesce(delays, 0) AS delays, coalesce(delay_us, 0) AS delay_us,
         {_exact("coalesce(flight_us, CASE WHEN programmed_us IS NOT NULL THEN 0 END)", f"n * {HOUR}", 100)} AS fh,
         {_exact("coalesce(cycles, 0)", "n", 100)} AS tos,
         {_exact("coalesce(programmed_us, 0)", f"n * {DAY}", 100)} AS adoss,
         {_exact("coalesce(unprogrammed_us, 0)", f"n * {DAY}", 100)} AS adosu,
         {_exact("(coalesce(programmed_us, 0) + coalesce(unprogrammed_us, 0))", f"n * {DAY}", 100)} AS ados
  FROM raw_groups
),
r_utilization AS (
  SELECT manufacturer, year, {", ".join(f"CAST({m} AS DOUBLE) / 100 AS {m}" for m in ("fh", "tos", "adoss", "adosu", "ados"))},
         CAST(36500 - ados AS DOUBLE) / 100 AS adis,
         CAST({_exact("fh", "(36500 - ados) * 24", 100)} AS DOUBLE) / 100 AS du,
         CAST({_exact("tos", "(36500 - ados)", 100)} AS DOUBLE) / 100 AS dc,
         CAST({_exact("delays", "cycles", 10000)} AS DOUBLE) / 100 AS dyr,
         CAST({_exact("cancellations", "cycles", 10000)} AS DOUBLE) / 100 AS cnr,
         CAST(100 - (100 * (delays + cancellations)) // nullif(cycles, 0) AS DOUBLE) AS tdr,
         CAST({_exact("delay_us", f"delays * {MINUTE}", 100)} AS DOUBLE) AS "add"
  FROM raw_units
),
raw_rates AS (
  SELECT p.manufacturer, p.year, p.role, p.whole, CAST({_exact(f"p.reports * {HOUR}", "g.flight_us", 1000)} AS DOUBLE) AS rrh,
         CAST({_exact("p.reports", "g.cycles", 100)} AS DOUBLE) AS rrc
  FROM (SELECT {_maker("reg")} AS manufacturer, CAST(year(rd) AS VARCHAR) AS year, cls AS role, grouping(cls) AS whole,
               count(*) AS reports
        FROM fx_reports GROUP BY GROUPING SETS ((1, 2, 3), (1, 2))) p
  JOIN raw_groups g ON g.manufacturer = p.manufacturer AND g.year = p.year AND g.cycles IS NOT NULL
),
r_reporting AS (SELECT manufacturer, year, rrh, rrc FROM raw_rates WHERE whole = 1),
r_per_role AS (SELECT manufacturer, year, role, rrh, rrc FROM raw_rates WHERE whole = 0)"""


def _query(select: str, *parts: str) -> str:
    return "WITH RECURSIVE " + ",".join((SOURCES, *parts)) + "\n" + select


def _ruled(select: str, *parts: str) -> str:
    return _query(select, EVENTS, _tables(True), *parts)


def _unruled(select: str, *parts: str) -> str:
    return _query(select, NO_RULES_EVENTS, _tables(False), *parts)


def _reconcile(dw: str, raw: str, measures: list[str], keys: list[str]) -> str:
    on = " AND ".join(f"CAST(d.{k} AS VARCHAR) = r.{k}" for k in keys)
    columns = ", ".join(
        f'd."{m}" AS "{m}_dw", r."{m}" AS "{m}_raw", d."{m}" - r."{m}" AS "{m}_delta"' for m in measures
    )
    names = ", ".join(f"coalesce(CAST(d.{k} AS VARCHAR), r.{k}) AS {k}" for k in keys)
    return (
        f"SELECT {names}, CASE WHEN r.manufacturer IS NULL THEN 'only_dw' WHEN d.manufacturer IS NULL THEN 'only_raw' "
        f"ELSE 'both' END AS status, {columns} FROM {dw} d FULL OUTER JOIN {raw} r ON {on}"
    )


def _slot_text(slots: str) -> str:
    return f"array_to_string(list_transform({slots}, lambda z: z.s || '-' || z.e), ',')"


def _orphans(table: str, columns: str, *fks: tuple[str, str, str]) -> str:
    tests = [
        f"SELECT {columns}, '{col}' AS missing FROM {table} WHERE {col} IS NOT NULL "
        f"AND {col} NOT IN (SELECT {key} FROM {dim})"
        for col, dim, key in fks
    ]
    return " UNION ALL ".join(tests)


# Reports per aircraft, month and reporter, those on foreign aircraft included.
ALL_REPORTED = f"""
all_reported AS (
  SELECT DISTINCT reg AS registration, {_month_id("rd")} AS month_id, coalesce(CAST(rid AS VARCHAR), 'None') AS reporteur_uid
  FROM fx_reports
)"""


def _load_counts(aircraft: str) -> str:
    """Rows written and set aside; of the lookup's different rows one for each key is written."""
    known = "(SELECT registration FROM t_aircrafts)"
    written = f"(SELECT count(DISTINCT registration) FROM ({aircraft}))"
    rows = [f"SELECT 'aircrafts' AS table_name, {written} AS written, (SELECT count(*) FROM (SELECT DISTINCT * FROM ({aircraft}))) - {written} AS rejected"]
    rows += [f"SELECT '{name}', (SELECT count(*) FROM {t}), 0" for name, t in _DIMS.items() if name != "aircrafts"]
    rows += [
        f"SELECT '{name}', (SELECT count(*) FROM {t} WHERE registration IN {known}), "
        f"(SELECT count(*) FROM {t} WHERE registration NOT IN {known})"
        for name, t in _FACTS.items()
    ]
    return " UNION ALL ".join(rows)


def _over_loads() -> str:
    """Cases of commits 1 and 3, with the rules, and 2, without."""
    on_events = (
        "SELECT 'BR-21' AS rule_id, CASE act WHEN 0 THEN 'flight' ELSE 'maintenance' END AS source, count(*) AS cases "
        "FROM decided WHERE NOT ok GROUP BY ALL "
        "UNION ALL SELECT 'BR-23', 'flight', count(*) FROM decided WHERE act = 0 AND ok AND t1 < t0 HAVING count(*) > 0"
    )
    foreign = f"SELECT 'FOREIGN-AIRCRAFT' AS rule_id, 'report' AS source, count(*) AS cases FROM fx_reports WHERE {FOREIGN} HAVING count(*) > 0"
    return (
        f"SELECT commit, e.* FROM ({on_events}) e, (VALUES (1), (3)) AS c(commit) "
        f"UNION ALL SELECT commit, f.* FROM ({foreign}) f, (VALUES (1), (2), (3)) AS c(commit)"
    )


def _stage_rows() -> str:
    """Rows of each stage of a load; slots are whole hours of an aircraft and day, cancelled flights share one without hours."""
    slots = (
        "SELECT DISTINCT reg, CAST(sd AS DATE) AS d, CASE WHEN NOT gone THEN hour(ad) END AS s, CASE WHEN NOT gone THEN hour(aa) END AS e "
        "FROM (SELECT reg, sd, ad, aa, cancelled OR ad IS NULL OR aa IS NULL AS gone FROM fx_flights "
        "UNION ALL SELECT reg, sd, sd, sa, false FROM fx_maint)"
    )
    rows = {
        ("read", "flights"): "fx_flights",
        ("read", "maintenance"): "fx_maint",
        ("read", "reports"): "fx_reports",
        ("staged", "slots"): f"({slots})",
        ("staged", "usage"): "(SELECT DISTINCT reg, CAST(sd AS DATE) FROM (SELECT reg, sd FROM fx_flights UNION ALL SELECT reg, sd FROM fx_maint))",
        ("staged", "report_counts"): "(SELECT DISTINCT reg, year(rd), month(rd), rid FROM fx_reports)",
    }
    counted = [f"SELECT '{stage}' AS stage, '{name}' AS name, count(*) AS rows FROM {of}" for (stage, name), of in rows.items()]
    counts = _load_counts("SELECT * FROM fx_aircraft")
    counted += [f"SELECT '{stage}', table_name, {column} FROM ({counts})" for stage, column in (("written", "written"), ("set_aside", "rejected"))]
    return f"SELECT *, rows AS observed FROM ({' UNION ALL '.join(counted)})"


# Lines that are none, beside each sound one by its number: too short, too long, not closed.
BROKEN_LINES = """
aircraft_lines AS (
  SELECT coalesce(registration, '') || ',MSN,' || model || ',' || manufacturer AS line, registration AS key,
         CAST(substr(registration, 4) AS BIGINT) AS number, 'aircraft-manufacturerinfo-lookup.csv' AS file FROM fx_aircraft
),
person_lines AS (
  SELECT rid || ',' || airport AS line, rid AS key, CAST(trim(rid) AS BIGINT) AS number, 'maintenance_personnel.csv' AS file
  FROM fx_personnel
),
all_lines AS (SELECT * FROM aircraft_lines UNION ALL SELECT * FROM person_lines)"""

UTILIZATION = ["fh", "tos", "adoss", "adosu", "ados", "adis", "du", "dc", "dyr", "cnr", "tdr", "add"]
GROUP = ["manufacturer", "year"]
_FACTS = {"daily_usage": "t_daily", "monthly_usage": "t_monthly", "reportage_usage": "t_reportage"}
_DIMS = {"days": "t_days", "months": "t_months", "aircrafts": "t_aircrafts", "reporteurs": "t_reporteurs"}


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {
        "source_flights": _query(
            "SELECT reg AS aircraftregistration, sd AS scheduleddeparture, sa AS scheduledarrival, ad AS actualdeparture, "
            "aa AS actualarrival, flag AS cancelled, k AS row_key FROM fx_flights"
        ),
        "source_maintenance": _query(
            "SELECT reg AS aircraftregistration, sd AS scheduleddeparture, sa AS scheduledarrival, flag AS programmed, "
            "k AS row_key FROM fx_maint"
        ),
        "source_reports": _query(
            "SELECT reg AS aircraftregistration, rd AS reportingdate, rid AS reporteurid, cls AS reporteurclass FROM fx_reports"
        ),
        "source_lookup_aircrafts": _query(
            "SELECT coalesce(registration, '') AS registration, model, manufacturer FROM fx_aircraft"
        ),
        "source_lookup_personnel": _query("SELECT rid AS reporteurid, airport FROM fx_personnel"),
        "date_codes": _query(
            f"SELECT k AS row_key, {_day_id('sd')} AS day_id, CAST(day(sd) AS INTEGER) AS day, {_month_id('sd')} AS month_id, "
            "CAST(month(sd) AS INTEGER) AS month, CAST(year(sd) AS INTEGER) AS year FROM fx_flights"
        ),
        "hour_code": _query(
            "SELECT k AS row_key, coalesce(strftime(ad, '%H:%M:%S'), '[invalid date]') AS departure_code, "
            "coalesce(strftime(aa, '%H:%M:%S'), '[invalid date]') AS arrival_code, "
            "CAST(hour(ad) AS INTEGER) AS departure_hour FROM fx_flights"
        ),
        "time_differences": _query(
            f"SELECT k AS row_key, CAST({_us('ad', 'aa')} AS DOUBLE) / 1000000 AS seconds, "
            f"CAST({_us('ad', 'aa')} AS DOUBLE) / 1000000 / 3600 AS hours FROM fx_flights"
        ),
        "effective_cancellation": _query(
            "SELECT k AS row_key, flag AS flagged, cancelled OR ad IS NULL OR aa IS NULL AS effectively_cancelled "
            "FROM fx_flights"
        ),
        "delay_flags": _query(
            f"SELECT k AS row_key, CAST({_us('sd', 'ad')} AS DOUBLE) / 1000000 AS delay_s, "
            f"{_us('sd', 'ad')} > 900000000 AS delayed, "
            f"CASE WHEN {_us('sd', 'ad')} > 900000000 THEN CAST({_us('sd', 'ad')} AS DOUBLE) / 1000000 / 3600 ELSE 0 END "
            "AS delay_hours FROM fx_flights"
        ),
        "maintenance_split": _query(
            f"SELECT k AS row_key, CAST({_us('sd', 'sa')} AS DOUBLE) / 1000000 / 86400 AS days, "
            f"CASE WHEN programmed THEN CAST({_us('sd', 'sa')} AS DOUBLE) / 1000000 / 86400 ELSE 0 END AS scheduled_days, "
            f"CASE WHEN programmed THEN 0 ELSE CAST({_us('sd', 'sa')} AS DOUBLE) / 1000000 / 86400 END AS unscheduled_days "
            "FROM fx_maint"
        ),
        "report_classes": _query(
            "SELECT coalesce(CAST(rid AS VARCHAR), 'None') AS reporteur_uid, count(*) FILTER (WHERE cls = 'MAREP') AS mareps, "
            "count(*) FILTER (WHERE cls = 'PIREP') AS pireps, "
            "count(*) FILTER (WHERE cls IS NULL OR cls NOT IN ('MAREP', 'PIREP')) AS others FROM fx_reports GROUP BY ALL"
        ),
        "manufacturer_lookup": _query(
            f"SELECT reg AS registration, {_maker('reg')} AS manufacturer, count(*) AS flights FROM fx_flights GROUP BY ALL"
        ),
        "aircraft_by_manufacturer": _query("SELECT manufacturer, registration FROM fx_aircraft"),
        "br21_decisions": _query(
            "SELECT k AS row_key, CASE act WHEN 0 THEN 'flight' ELSE 'maintenance' END AS source, ok AS accepted FROM decided",
            EVENTS,
        ),
        "br23_swapped": _query(
            f"SELECT k AS row_key, reg AS registration, {_day_id('sd')} AS day_id, CAST({_us('t1', 't0')} AS DOUBLE) / 1000000 "
            "AS seconds FROM decided WHERE act = 0 AND ok AND t1 < t0",
            EVENTS,
        ),
        "rule_violations": _query(
            f"SELECT 'BR-21' AS rule_id, reg AS registration, {_day_id('sd')} AS day_id, "
            "CASE act WHEN 0 THEN 'flight' ELSE 'maintenance' END AS source, s || '-' || e AS slot, "
            f"{_slot_text('list_filter(prior, lambda z, i: list_position(prior, z) = i)')} AS existing_slots, t0 AS ts "
            "FROM decided WHERE NOT ok "
            f"UNION ALL SELECT 'BR-23', reg, {_day_id('sd')}, 'flight', s || '-' || e, NULL, t0 "
            "FROM decided WHERE act = 0 AND ok AND t1 < t0 "
            f"UNION ALL SELECT 'FOREIGN-AIRCRAFT', reg, {_day_id('rd')}, 'report', NULL, NULL, rd FROM fx_reports "
            f"WHERE {FOREIGN}",
            EVENTS,
        ),
        "reports_foreign": _query(
            "SELECT reg AS registration, count(*) AS reports FROM fx_reports "
            f"WHERE {FOREIGN} GROUP BY ALL"
        ),
        "rule_summary": _query(
            "SELECT 'BR-21' AS rule_id, 'flight' AS source, (SELECT count(*) FROM decided WHERE act = 0 AND NOT ok) AS hits, "
            "(SELECT count(*) FROM fx_flights) AS rows_checked "
            "UNION ALL SELECT 'BR-21', 'maintenance', (SELECT count(*) FROM decided WHERE act = 1 AND NOT ok), "
            "(SELECT count(*) FROM fx_maint) "
            "UNION ALL SELECT 'BR-23', 'flight', (SELECT count(*) FROM decided WHERE act = 0 AND ok AND t1 < t0), "
            "(SELECT count(*) FROM fx_flights) "
            "UNION ALL SELECT 'FOREIGN-AIRCRAFT', 'report', "
            f"(SELECT count(*) FROM fx_reports WHERE {FOREIGN}), "
            "(SELECT count(*) FROM fx_reports)",
            EVENTS,
        ),
        "pk_violations": _ruled(
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS row_count, count(DISTINCT {key}) AS key_count, "
                f"(SELECT count(*) FROM (SELECT {key} FROM {t} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)) "
                f"AS duplicate_keys, count(*) FILTER (WHERE {key} IS NULL) AS null_keys FROM {t}"
                for name, t, key in (
                    ("days", "t_days", "day_id"),
                    ("months", "t_months", "month_id"),
                    ("aircrafts", "(SELECT DISTINCT * FROM fx_aircraft)", "registration"),
                    ("reporteurs", "t_reporteurs", "reporteur_uid"),
                )
            )
        ),
        "fk_orphans_daily": _ruled(
            _orphans(
                "t_daily",
                "registration, day_id",
                ("registration", "t_aircrafts", "registration"),
                ("day_id", "t_days", "day_id"),
            )
        ),
        "fk_orphans_monthly": _ruled(
            _orphans(
                "t_monthly",
                "registration, month_id",
                ("registration", "t_aircrafts", "registration"),
                ("month_id", "t_months", "month_id"),
            )
        ),
        "fk_orphans_reportage": _ruled(
            _orphans(
                "all_reported",
                "registration, month_id, reporteur_uid",
                ("registration", "t_aircrafts", "registration"),
                ("month_id", "t_months", "month_id"),
                ("reporteur_uid", "t_reporteurs", "reporteur_uid"),
            ),
            ALL_REPORTED,
        ),
        "lookup_rivals": _ruled(
            "SELECT *, CASE WHEN registration IS NULL THEN 'null_key:registration' ELSE 'duplicate_key:registration' END AS reason "
            "FROM (SELECT * FROM fx_aircraft EXCEPT SELECT * FROM t_aircrafts)"
        ),
        "logged_violations": _ruled(
            "SELECT 'BR-21' AS rule_id, CASE act WHEN 0 THEN 'flight' ELSE 'maintenance' END AS source, count(*) AS cases "
            "FROM decided WHERE NOT ok GROUP BY ALL "
            "UNION ALL SELECT 'BR-23', 'flight', count(*) FROM decided WHERE act = 0 AND ok AND t1 < t0 HAVING count(*) > 0 "
            f"UNION ALL SELECT 'FOREIGN-AIRCRAFT', 'report', count(*) FROM fx_reports WHERE {FOREIGN} HAVING count(*) > 0"
        ),
        "warehouse_load": _ruled(_load_counts("SELECT * FROM fx_aircraft")),
        # A missing registration is read from a file as an empty one, which is a key.
        "etl_from_files": _ruled(
            _load_counts("SELECT coalesce(registration, '') AS registration, model, manufacturer FROM fx_aircraft")
        ),
        "warehouse_broken_lines": _query(
            "SELECT file, line, reason, count(*) AS copies FROM ("
            "SELECT file, key AS line, 'number of values' AS reason FROM all_lines WHERE number % 5 = 0 "
            "UNION ALL SELECT file, line || ',\"more, and\",more', 'number of values' FROM all_lines WHERE number % 9 = 0 "
            "UNION ALL SELECT file, line || '\"', 'unclosed quote' FROM all_lines WHERE number % 8 = 0) GROUP BY ALL",
            BROKEN_LINES,
        ),
        # Commits are those of a new warehouse and of two loads.
        "warehouse_stored_runs": _ruled(
            "SELECT commit, kind, table_name, CASE kind WHEN 'load' THEN written ELSE 0 END AS written "
            f"FROM ({_load_counts('SELECT * FROM fx_aircraft')}) l, "
            "(VALUES (1, 'restart'), (2, 'load'), (3, 'load')) AS c(commit, kind)"
        ),
        "warehouse_by_name": _ruled("SELECT * FROM q_reporting", YEARLY),
        "warehouse_one_year": _ruled(
            "SELECT * FROM q_utilization WHERE year = (SELECT max(year) FROM t_months)", YEARLY
        ),
        "warehouse_log_over_loads": _ruled(_over_loads()),
        "warehouse_stage_counts": _ruled(_stage_rows()),
        "warehouse_restarted": _ruled(
            f"SELECT table_name, written AS loaded, 0 AS rows FROM ({_load_counts('SELECT * FROM fx_aircraft')})"
        ),
        "warehouse_failed_load": _unruled(
            f"SELECT *, true AS second_load_failed FROM ({_load_counts('SELECT * FROM fx_aircraft')})"
        ),
        "kpi_utilization_positions": _ruled(
            "SELECT *, row_number() OVER (ORDER BY manufacturer NULLS LAST, year NULLS LAST) AS position FROM q_utilization", YEARLY
        ),
        "kpi_reporting_per_role_positions": _ruled(
            "SELECT *, row_number() OVER (ORDER BY manufacturer NULLS LAST, year NULLS LAST, role) AS position FROM q_per_role", YEARLY
        ),
        "kpi_utilization": _ruled("SELECT * FROM q_utilization", YEARLY),
        "kpi_utilization_norules": _unruled("SELECT * FROM q_utilization", YEARLY),
        "kpi_reporting": _ruled("SELECT * FROM q_reporting", YEARLY),
        "kpi_reporting_per_role": _ruled("SELECT * FROM q_per_role", YEARLY),
        "raw_utilization": _query("SELECT * FROM r_utilization", RAW),
        "raw_reporting": _query("SELECT * FROM r_reporting", RAW),
        "raw_reporting_per_role": _query("SELECT * FROM r_per_role", RAW),
        "reconcile_utilization": _ruled(_reconcile("q_utilization", "r_utilization", UTILIZATION, GROUP), YEARLY, RAW),
        "reconcile_reporting": _ruled(_reconcile("q_reporting", "r_reporting", ["rrh", "rrc"], GROUP), YEARLY, RAW),
        "reconcile_reporting_per_role": _ruled(
            _reconcile("q_per_role", "r_per_role", ["rrh", "rrc"], [*GROUP, "role"]), YEARLY, RAW
        ),
    }
    q["warehouse_with_broken_lines"] = q["etl_from_files"]
    q["source_files_flights"], q["source_files_maintenance"] = q["source_flights"], q["source_maintenance"]
    for name, t in _DIMS.items():
        q[f"dim_{name}"] = _ruled(f"SELECT * FROM {t}")
    for name, t in _FACTS.items():
        q[f"fact_{name}"] = _ruled(f"SELECT * FROM {t}")
        q[f"fact_{name}_norules"] = _unruled(f"SELECT * FROM {t}")
    return q
