"""DuckDB SQL for every registered query, written independently of the Spark
plans: the calendar is a ``generate_series`` grid left-joined to the readings,
the gap month a self-join on shifted time, the repairs nested ``lag`` CTEs.
Column names equal the Spark outputs.
"""

from __future__ import annotations

# --- fixed values, stated here a second time: the SQL takes nothing from the package ---
KEY, TIME, CAP = "inverter_serial_no", "date_time", "battery_capacity_percentage"
COUNTERS = [
    "on_grid_total_yield_kwh",
    "total_feed_in_energy_kwh",
    "total_consume_energy_from_grid_kwh",
    "pv_total_power_generation_kwh",
    "total_battery_charge_kwh",
    "total_battery_discharge_kwh",
]
INSTANT = {c: "Instantaneous_" + c for c in COUNTERS}
DELTAS = list(INSTANT.values())
HOUSE = "Total_power_used_in_house"
OUTLIER_COLUMNS = ["total_battery_charge_kwh", "total_battery_discharge_kwh"]
SEASONS = [("Spring", "3, 4, 5"), ("Summer", "6, 7, 8"), ("Autumn", "9, 10, 11"), ("Winter", "12, 1, 2")]
DAYLIGHT = [("Spring", 7, 19), ("Summer", 5, 21), ("Autumn", 7, 19), ("Winter", 8, 17)]
MESSAGES = [
    "On Grid Total Cannot be Negative",
    "Feed in energy Cannot be Negative",
    "Feed in cannot happen if battery % is less than 10",
    "Feed in and consumption can not happen same time",
    "Consumption from grid cannot be negative",
    "Battery capacity should be within the range",
    "Battery charge and discharge cannot happen at same time",
    "Battery charge be negative",
    "Battery discharge cannot be negative",
    "Battery discharge can not have any value if there is no consumption and feed in to grid",
    "PV Power generation can not be negative",
    "PV value can not be at night",
    "Cannot consume from grid, if no usage",
]
TEL_START, TEL_END = "2024-01-01 00:00:00", "2024-12-31 00:00:00"
SUP_START, SUP_END = "1995-01-01 00:00:00", "2001-11-05 00:00:00"  # 2500 days


def with_(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ctes)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- fixture: telemetry from events ----------------------------------------------------------
_RUN_TYPES = {
    "on_grid_total_yield_kwh": ("view", "signup"),
    "total_feed_in_energy_kwh": ("error",),
    "total_consume_energy_from_grid_kwh": ("signup", "purchase"),
    "pv_total_power_generation_kwh": ("view", "click"),
    "total_battery_charge_kwh": ("click", "purchase"),
    "total_battery_discharge_kwh": ("purchase", "click"),
}


def telemetry_ctes() -> list[tuple[str, str]]:
    runs = ",\n".join(
        f"  sum(CASE WHEN event_type IN ({', '.join(q(t) for t in types)}) THEN cents ELSE 0 END) OVER w AS run_{i}"
        for i, types in enumerate(_RUN_TYPES.values())
    )
    cols = []
    for i, name in enumerate(_RUN_TYPES):
        if i == 0:
            cut = "CASE WHEN event_type = 'signup' AND event_id % 3 = 0 THEN 2 * cents WHEN event_id % 37 = 1 THEN 50000 ELSE 0 END"
        else:
            cut = f"CASE WHEN event_id % 37 = {i + 1} THEN 50000 ELSE 0 END"
        cols.append(f"  CAST(run_{i} - ({cut}) AS DOUBLE) AS {name}")
    return [
        ("tm_base", "SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events"),
        (
            "tm_run",
            f"SELECT *,\n{runs}\nFROM tm_base\n"
            "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        ),
        (
            "telemetry",
            "SELECT 'INV-' || CAST(user_id AS VARCHAR) AS inverter_serial_no,\n"
            "  ts + to_days(CAST((user_id % 12) * 30 AS INTEGER)) AS date_time,\n"
            "  'SITE-' || CAST(user_id % 7 AS VARCHAR) AS site_name,\n"
            "  'REG-' || CAST(user_id AS VARCHAR) AS registration_no,\n"
            "  event_id AS file_id,\n" + ",\n".join(cols) + ",\n"
            "  CAST((event_id * 7) % 120 - 10 AS DOUBLE) AS battery_capacity_percentage\nFROM tm_run",
        ),
    ]


def supply_ctes() -> list[tuple[str, str]]:
    return [
        (
            "sup_daily",
            "SELECT l_suppkey, l_shipdate AS day, sum(l_quantity) AS v1, CAST(count(*) AS DOUBLE) AS v2\n"
            "FROM lineitem GROUP BY l_suppkey, l_shipdate",
        ),
        (
            "supply",
            "SELECT l_suppkey, day,\n"
            "  CASE WHEN year(day) = 1995 AND month(day) = 2 + l_suppkey % 10 THEN NULL ELSE v1 END AS v1,\n"
            "  CASE WHEN year(day) = 1995 AND month(day) = 2 + l_suppkey % 10 THEN NULL ELSE v2 END AS v2\n"
            "FROM sup_daily",
        ),
    ]


# ---- calendar pieces -------------------------------------------------------------------------
def floor_sql(t: str, step_minutes: int) -> str:
    return (
        f"(date_trunc('day', {t}) + to_minutes(CAST(((hour({t}) * 60 + minute({t})) // {step_minutes}) "
        f"* {step_minutes} AS BIGINT)))"
    )


def dedup_ctes(src, out, k, t, tie, cols, step) -> list[tuple[str, str]]:
    order = f"__orig, {tie}" if tie else "__orig"
    other = ", ".join(cols)
    return [
        (
            f"{out}_slot",
            f"SELECT {k}, {floor_sql(t, step)} AS {t}, {t} AS __orig, {other} FROM {src}",
        ),
        (
            out,
            f"SELECT {k}, {t}, {other} FROM (\n"
            f"  SELECT *, row_number() OVER (PARTITION BY {k}, {t} ORDER BY {order}) AS __rn FROM {out}_slot\n"
            ") WHERE __rn = 1",
        ),
    ]


def calendar_ctes(src, out, k, t, tie, cols, start, end, step) -> list[tuple[str, str]]:
    dedup = dedup_ctes(src, f"{out}_dd", k, t, tie, cols, step)
    sel = ", ".join(f"d.{c}" for c in cols)
    return dedup + [
        (
            f"{out}_grid",
            f"SELECT {k}, unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{end}', INTERVAL {step} MINUTE)) AS {t}\n"
            f"FROM (SELECT DISTINCT {k} FROM {src})",
        ),
        (
            out,
            f"SELECT g.{k}, g.{t}, {sel} FROM {out}_grid g\n"
            f"LEFT JOIN {out}_dd d ON g.{k} = d.{k} AND g.{t} = d.{t}",
        ),
    ]


def following(k, t):
    return f"(PARTITION BY {k} ORDER BY {t} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def bfill_cte(src, out, k, t, cols) -> tuple[str, str]:
    rep = ", ".join(f"first_value({c} IGNORE NULLS) OVER wf AS {c}" for c in cols)
    return out, f"SELECT * REPLACE ({rep}) FROM {src}\nWINDOW wf AS {following(k, t)}"


def first_null_cte(src, out, k, t, values, start) -> tuple[str, str]:
    test = " AND ".join(f"{c} IS NULL" for c in values)
    return out, f"SELECT {k}, ({test}) AS first_record_null FROM {src} WHERE {t} = TIMESTAMP '{start}'"


def seasonal_ctes(src, out, k, t, values, start) -> list[tuple[str, str]]:
    fn = first_null_cte(src, f"{out}_fn", k, t, values, start)
    rep = ", ".join(
        f"CASE WHEN f.first_record_null THEN first_value(s.{c} IGNORE NULLS) OVER ws ELSE s.{c} END AS {c}"
        for c in values
    )
    win = (
        f"(PARTITION BY s.{k}, isodow(s.{t}), hour(s.{t}), minute(s.{t}), date_trunc('month', s.{t}) "
        f"ORDER BY s.{t} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    )
    return [fn, (out, f"SELECT s.* REPLACE ({rep}) FROM {src} s JOIN {out}_fn f ON s.{k} = f.{k}\nWINDOW ws AS {win}")]


def gap_ctes(src, out, k, t, values) -> list[tuple[str, str]]:
    anyv = " OR ".join(f"{c} IS NOT NULL" for c in values)
    return [
        (
            f"{out}_m",
            f"SELECT {k}, CAST(date_trunc('month', {t}) AS DATE) AS ym, bool_or({anyv}) AS anyv FROM {src} GROUP BY {k}, ym",
        ),
        (out, f"SELECT {k}, min(ym) FILTER (WHERE NOT anyv) AS gap_month FROM {out}_m GROUP BY {k}"),
    ]


def fill_gap_ctes(src, out, k, t, copied, values) -> list[tuple[str, str]]:
    gap = gap_ctes(src, f"{out}_gap", k, t, values)
    sel = ",\n  ".join(
        f"CASE WHEN g.gap_month = CAST(date_trunc('month', s.{t}) AS DATE) THEN "
        f"(CASE WHEN day(s.{t}) <= 14 THEN b.{c} ELSE a.{c} END) ELSE s.{c} END AS {c}"
        for c in copied
    )
    return gap + [
        (
            out,
            f"SELECT s.{k}, s.{t},\n  {sel}\nFROM {src} s\n"
            f"JOIN {out}_gap g ON s.{k} = g.{k}\n"
            f"LEFT JOIN {src} b ON b.{k} = s.{k} AND b.{t} = s.{t} - INTERVAL 14 DAY\n"
            f"LEFT JOIN {src} a ON a.{k} = s.{k} AND a.{t} = s.{t} + INTERVAL 21 DAY",
        )
    ]


# ---- derivation, rules, repairs on telemetry-shaped tables --------------------------------
W_DEV = f"WINDOW w AS (PARTITION BY {KEY} ORDER BY {TIME})"


def derive_ctes(src) -> list[tuple[str, str]]:
    deltas = ",\n  ".join(f"coalesce({c} - lag({c}) OVER w, 0) AS {d}" for c, d in zip(COUNTERS, DELTAS))
    i = INSTANT
    season_cases = " ".join(
        f"WHEN month IN ({months}) THEN {q(name)}" for name, months in SEASONS
    )
    tod_cases = " ".join(
        f"WHEN Season = {q(name)} THEN CASE WHEN hour({TIME}) BETWEEN {a} AND {b} THEN 'Day' ELSE 'Night' END"
        for name, a, b in DAYLIGHT
    )
    return [
        (
            "dv_delta",
            f"SELECT {KEY}, {TIME}, {', '.join(COUNTERS)}, {CAP},\n  {deltas}\nFROM {src}\n{W_DEV}",
        ),
        (
            "dv_label",
            "SELECT *,\n"
            f"  CASE WHEN {i['pv_total_power_generation_kwh']} > 0 AND {i['total_battery_charge_kwh']} > 0 THEN 'Solar Charging'\n"
            f"       WHEN {i['total_consume_energy_from_grid_kwh']} > 0 AND {i['total_battery_charge_kwh']} > 0 THEN 'Grid Charging'\n"
            f"       WHEN {i['total_battery_discharge_kwh']} > 0 THEN 'Discharging' ELSE 'Other' END AS BatteryBehaviour,\n"
            f"  {i['on_grid_total_yield_kwh']} + {i['total_consume_energy_from_grid_kwh']} + {i['total_feed_in_energy_kwh']}"
            " AS Total_power_used_in_house,\n"
            f"  CAST(month({TIME}) AS INTEGER) AS month\nFROM dv_delta",
        ),
        ("dv_season", f"SELECT *, CASE {season_cases} ELSE 'Unknown' END AS Season FROM dv_label"),
        ("derived", f"SELECT *, CASE {tod_cases} WHEN Season = 'Unknown' THEN 'Unknown' END AS TimeofDay FROM dv_season"),
    ]


def _rule_sql() -> list[tuple[str, str]]:
    i = INSTANT
    cons = "total_consume_energy_from_grid_kwh"
    house = HOUSE
    preds = [
        f"{i['on_grid_total_yield_kwh']} < 0",
        f"{i['total_feed_in_energy_kwh']} < 0",
        f"{CAP} < 10 AND {i['total_feed_in_energy_kwh']} > 0",
        f"{i['total_feed_in_energy_kwh']} > 0 AND {cons} > 0",
        f"{cons} < 0",
        f"{CAP} < 0 OR {CAP} > 100",
        f"{i['total_battery_charge_kwh']} > 0 AND {i['total_battery_discharge_kwh']} > 0",
        f"{i['total_battery_charge_kwh']} < 0",
        f"{i['total_battery_discharge_kwh']} < 0",
        f"{house} = 0 AND {i['total_feed_in_energy_kwh']} = 0 AND {i['total_battery_discharge_kwh']} > 0",
        f"{i['pv_total_power_generation_kwh']} < 0",
        f"TimeofDay = 'Night' AND {i['pv_total_power_generation_kwh']} <> 0",
        f"{i[cons]} > 0 AND {house} = 0",
    ]
    return list(zip(preds, MESSAGES, strict=True))


def validate_ctes(src) -> list[tuple[str, str]]:
    parts = ", ".join(f"CASE WHEN {p} THEN {q(m)} END" for p, m in _rule_sql())
    return [
        ("vl_errs", f"SELECT *, concat_ws(', ', {parts}) AS __errs FROM {src}"),
        (
            "validated",
            "SELECT * EXCLUDE (__errs), (__errs = '') AS is_valid,\n"
            "  CASE WHEN __errs = '' THEN 'Valid' ELSE __errs END AS error_message FROM vl_errs",
        ),
    ]


def _has(msg):
    return f"coalesce(contains(error_message, {q(msg)}), false)"


def repair_steps() -> dict[str, list[str]]:
    """Per step, the REPLACE expressions (reading the step's input)."""
    i = INSTANT
    steps = {}
    steps["fix_negative"] = [
        *[f"CASE WHEN {i[c]} < 0 THEN lag({c}) OVER w ELSE {c} END AS {c}" for c in COUNTERS],
    ]

    def rep(cond, counter, zero=True):
        out = [f"CASE WHEN {cond} THEN lag({counter}) OVER w ELSE {counter} END AS {counter}"]
        if zero:
            out.append(f"CASE WHEN {cond} THEN 0 ELSE {i[counter]} END AS {i[counter]}")
        return out

    steps["fix_pv_night"] = rep(_has(MESSAGES[11]), "pv_total_power_generation_kwh")
    steps["fix_feed_in"] = rep(_has(MESSAGES[3]), "total_feed_in_energy_kwh")
    cap = _has(MESSAGES[5])
    steps["fix_capacity"] = [f"CASE WHEN {cap} THEN lag({CAP}) OVER w ELSE {CAP} END AS {CAP}"]
    night = f"({_has(MESSAGES[6])} AND TimeofDay = 'Night')"
    day = f"({_has(MESSAGES[6])} AND TimeofDay = 'Day')"
    steps["fix_charge_discharge"] = rep(night, "total_battery_charge_kwh") + rep(day, "total_battery_discharge_kwh")
    steps["fix_discharge"] = rep(_has(MESSAGES[9]), "total_battery_discharge_kwh")
    steps["fix_grid_use"] = rep(_has(MESSAGES[12]), "total_consume_energy_from_grid_kwh")
    return steps


def repair_cte(src, out, name) -> list[tuple[str, str]]:
    exprs = repair_steps()[name]
    ctes = [(out + ("_a" if name == "fix_negative" else ""), f"SELECT * REPLACE ({', '.join(exprs)}) FROM {src}\n{W_DEV}")]
    if name == "fix_negative":
        zero = ", ".join(f"CASE WHEN {d} < 0 THEN 0 ELSE {d} END AS {d}" for d in DELTAS)
        ctes.append((out, f"SELECT * REPLACE ({zero}) FROM {out}_a"))
    return ctes


REPAIR_ORDER = [
    "fix_negative",
    "fix_pv_night",
    "fix_feed_in",
    "fix_capacity",
    "fix_charge_discharge",
    "fix_discharge",
    "fix_grid_use",
]


def repair_chain_ctes(src) -> tuple[list[tuple[str, str]], str]:
    ctes, cur = [], src
    for n, name in enumerate(REPAIR_ORDER):
        out = f"rp{n}"
        ctes += repair_cte(cur, out, name)
        cur = out
    return ctes, cur


def outlier_ctes(src, out, cols, partition, order) -> list[tuple[str, str]]:
    fence = ", ".join(f"quantile_disc({c}, 0.25) AS {c}_q1, quantile_disc({c}, 0.75) AS {c}_q3" for c in cols)
    win = f"(PARTITION BY {partition} ORDER BY {order})" if partition else f"(ORDER BY {order})"

    def cond(c):
        q1, q3 = f"(SELECT {c}_q1 FROM {out}_f)", f"(SELECT {c}_q3 FROM {out}_f)"
        return f"{c} < {q1} - 1.5 * ({q3} - {q1}) OR {c} > {q3} + 1.5 * ({q3} - {q1})"

    rep = ", ".join(f"CASE WHEN {cond(c)} THEN lag({c}) OVER wo ELSE {c} END AS {c}" for c in cols)
    return [(f"{out}_f", f"SELECT {fence} FROM {src}"), (out, f"SELECT * REPLACE ({rep}) FROM {src}\nWINDOW wo AS {win}")]


def report_select(src) -> str:
    rules = ",\n  ".join(f"count(*) FILTER (WHERE {_has(m)}) AS rule_{k:02d}" for k, m in enumerate(MESSAGES, start=1))
    sums = ",\n  ".join([f"sum({c}) AS sum_{c}" for c in COUNTERS] + [f"sum({d}) AS sum_{d}" for d in DELTAS])
    return (
        "SELECT Season, count(*) AS n_rows, count(*) FILTER (WHERE is_valid) AS n_valid,\n"
        f"  {rules},\n  {sums}\nFROM {src} GROUP BY Season"
    )


# ---- the registered queries ------------------------------------------------------------------
EV_COLS = ["event_id", "event_type", "value", "props"]
TEL_VALUES = ["file_id", *COUNTERS, CAP]
TEL_COLS = ["site_name", "registration_no", *TEL_VALUES]


def _sql_all() -> dict[str, str]:
    s: dict[str, str] = {}
    tel = telemetry_ctes()
    sup = supply_ctes()
    s["csv_load"] = "SELECT event_id, date_trunc('minute', ts) AS ts, user_id, event_type, value, props FROM events"
    s["preview_head"] = "SELECT * FROM events ORDER BY event_id LIMIT 5"
    s["empty_like"] = "SELECT * FROM events WHERE false"
    s["append"] = (
        "SELECT *, 'first' AS batch FROM events WHERE coalesce(event_type IN ('view', 'click'), false)\n"
        "UNION ALL BY NAME\n"
        "SELECT * FROM events WHERE NOT coalesce(event_type IN ('view', 'click'), false)"
    )
    s["project_sorted"] = with_(*tel) + f"\nSELECT {KEY}, {TIME}, {', '.join(COUNTERS)}, {CAP} FROM telemetry"
    s["calendar_parts"] = (
        "SELECT event_id, ts, CAST(isodow(ts) - 1 AS INTEGER) AS dayOfWeek, CAST(hour(ts) AS INTEGER) AS hour,\n"
        "  CAST(minute(ts) AS INTEGER) AS minute, CAST(weekofyear(ts) AS INTEGER) AS weekOfYear,\n"
        "  CAST(date_trunc('month', ts) AS DATE) AS yearMonth, CAST(month(ts) AS INTEGER) AS month FROM events"
    )
    s["calendar_parts_dropped"] = "SELECT event_id, ts FROM events"
    s["csv_any"] = (
        "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"
    )
    damaged = (
        "WITH e AS (SELECT *, event_id % 50 AS kind, CAST(round(value * 100) AS BIGINT) AS cents,\n"
        "  CASE WHEN event_id % 50 = 3 THEN 'yesterday' ELSE strftime(ts, '%d/%m/%Y %H:%M') END AS day,\n"
        "  CASE WHEN event_id % 50 = 2 THEN 'n/a' ELSE CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS amount FROM events),\n"
        "l AS (SELECT *, event_id || ',' || day || ',' || coalesce(CAST(user_id AS VARCHAR), '') || ',' || coalesce(event_type, '')\n"
        "  || ',' || amount AS whole FROM e)\n"
    )
    s["csv_kept"] = damaged + (
        "SELECT event_id, date_trunc('minute', ts) AS ts, user_id, event_type, cents FROM l WHERE kind > 3"
    )
    s["csv_malformed"] = damaged + (
        "SELECT CASE kind WHEN 0 THEN event_id || ',' || day WHEN 1 THEN whole || ',extra' ELSE whole END AS line,\n"
        "  CASE kind WHEN 3 THEN 'unreadable time' ELSE 'malformed line' END AS quarantine_reason FROM l WHERE kind <= 3"
    )
    s["bfill_device"] = (
        "SELECT event_id, user_id, ts, first_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS) OVER (\n"
        "  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS value\n"
        "FROM events"
    )
    s["quarantine"] = (
        "WITH e AS (SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,\n"
        "  CASE WHEN value < 400 THEN ts END AS ts, value FROM events)\n"
        "SELECT *, concat_ws(', ', CASE WHEN user_id IS NULL THEN 'no user_id' END, CASE WHEN ts IS NULL THEN 'no ts' END)\n"
        "  AS quarantine_reason FROM e WHERE user_id IS NULL OR ts IS NULL"
    )
    s["thin_devices"] = (
        "WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) < 66)\n"
        "SELECT e.*, c.n AS device_row_count,\n"
        "  CAST(CASE WHEN c.n > 0 THEN 1 ELSE 0 END AS BIGINT) AS Is_Rejected\n"
        "FROM events e LEFT JOIN c ON e.user_id = c.user_id"
    )
    s["duplicate_keys"] = (
        "WITH d AS (SELECT l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_shipdate HAVING count(*) > 1)\n"
        "SELECT l.*, d.n AS duplicate_count, CAST(CASE WHEN d.n > 0 THEN 1 ELSE 0 END AS BIGINT) AS Is_Duplicate\n"
        "FROM lineitem l LEFT JOIN d ON l.l_suppkey = d.l_suppkey AND l.l_shipdate = d.l_shipdate"
    )
    flags = (
        "WITH dev AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey),\n"
        "dup AS (SELECT l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY l_suppkey, l_shipdate),\n"
        "flagged AS (\n"
        "SELECT l.*, CASE WHEN dev.n < 600 THEN dev.n END AS device_row_count,\n"
        "  CAST(CASE WHEN dev.n < 600 THEN 1 ELSE 0 END AS BIGINT) AS Is_Rejected,\n"
        "  CASE WHEN dup.n > 1 THEN dup.n END AS duplicate_count,\n"
        "  CAST(CASE WHEN dup.n > 1 THEN 1 ELSE 0 END AS BIGINT) AS Is_Duplicate\n"
        "FROM lineitem l LEFT JOIN dev ON l.l_suppkey = dev.l_suppkey\n"
        "LEFT JOIN dup ON l.l_suppkey = dup.l_suppkey AND l.l_shipdate = dup.l_shipdate)\n"
    )
    s["generic_flags"] = flags + "SELECT * FROM flagged"
    s["generic_valid"] = (
        flags + "SELECT * EXCLUDE (device_row_count, Is_Rejected, duplicate_count, Is_Duplicate) FROM flagged\n"
        "WHERE Is_Rejected = 0 AND Is_Duplicate = 0"
    )
    s["generic_failed"] = flags + "SELECT * FROM flagged WHERE Is_Rejected = 1 OR Is_Duplicate = 1"
    s["device_list"] = "SELECT DISTINCT user_id FROM events"
    s["half_hour_slots"] = (
        with_(*dedup_ctes("events", "hh", "user_id", "ts", "event_id", EV_COLS, 30))
        + "\nSELECT event_id, ts, user_id, event_type, value, props FROM hh"
    )
    s["calendar_complete"] = (
        with_(*calendar_ctes("events", "cal", "user_id", "ts", "event_id", EV_COLS, "2024-01-01 00:00:00", "2024-01-31 00:00:00", 30))
        + "\nSELECT * FROM cal"
    )
    tel_cal = calendar_ctes("telemetry", "tcal", KEY, TIME, "file_id", TEL_COLS, TEL_START, TEL_END, 30)
    s["attribute_bfill"] = (
        with_(*tel, *tel_cal, bfill_cte("tcal", "attr", KEY, TIME, ["site_name", "registration_no"]))
        + f"\nSELECT {KEY}, {TIME}, site_name, registration_no, file_id FROM attr"
    )
    day = 24 * 60
    sup_cal = calendar_ctes("supply", "scal", "l_suppkey", "day", None, ["v1", "v2"], SUP_START, SUP_END, day)
    s["bfill"] = with_(*sup, *sup_cal, bfill_cte("scal", "sb", "l_suppkey", "day", ["v1", "v2"])) + "\nSELECT * FROM sb"
    s["first_record_null"] = (
        with_(*sup, *sup_cal, first_null_cte("scal", "fn", "l_suppkey", "day", ["v1", "v2"], SUP_START))
        + "\nSELECT * FROM fn"
    )
    seas = seasonal_ctes("scal", "sseas", "l_suppkey", "day", ["v1", "v2"], SUP_START)
    s["seasonal_bfill"] = with_(*sup, *sup_cal, *seas) + "\nSELECT * FROM sseas"
    s["gap_month"] = with_(*sup, *sup_cal, *seas, *gap_ctes("sseas", "gm", "l_suppkey", "day", ["v1", "v2"])) + "\nSELECT * FROM gm"
    fill = fill_gap_ctes("sseas", "sfill", "l_suppkey", "day", ["v1", "v2"], ["v1", "v2"])
    s["fill_gap_month"] = with_(*sup, *sup_cal, *seas, *fill) + "\nSELECT * FROM sfill"
    s["make_full"] = (
        with_(*sup, *sup_cal, *seas, *fill, bfill_cte("sfill", "sfull", "l_suppkey", "day", ["v1", "v2"]))
        + "\nSELECT * FROM sfull"
    )
    der = derive_ctes("telemetry")
    s["counter_delta"] = with_(*tel, *der) + f"\nSELECT {KEY}, {TIME}, {', '.join(COUNTERS)}, {CAP}, {', '.join(DELTAS)} FROM dv_delta"
    for name, col in [
        ("battery_behaviour", "BatteryBehaviour"),
        ("house_power", HOUSE),
        ("season", "Season"),
        ("time_of_day", "TimeofDay"),
    ]:
        s[name] = with_(*tel, *der) + f"\nSELECT {KEY}, {TIME}, {col} FROM derived"
    s["derive_all"] = with_(*tel, *der) + "\nSELECT * FROM derived"
    val = validate_ctes("derived")
    s["validate_rows"] = with_(*tel, *der, *val) + "\nSELECT * FROM validated"
    s["season_rule_counts"] = with_(*tel, *der, *val) + "\n" + report_select("validated")
    s["custom_rules"] = (
        "WITH e AS (SELECT l_orderkey, l_linenumber, concat_ws(', ',\n"
        "  CASE WHEN l_discount > 0.08 THEN 'Discount above eight percent' END,\n"
        "  CASE WHEN l_quantity > 45 THEN 'Quantity above forty five' END,\n"
        "  CASE WHEN l_returnflag = 'R' AND l_tax > 0 THEN 'Returned with tax' END) AS errs FROM lineitem)\n"
        "SELECT l_orderkey, l_linenumber, (errs = '') AS is_valid,\n"
        "  CASE WHEN errs = '' THEN 'Valid' ELSE errs END AS error_message FROM e"
    )
    s["batch_rules"] = (
        "WITH e AS (SELECT l_orderkey, l_linenumber, concat_ws(', ',\n"
        "  CASE WHEN l_discount > 0.08 THEN 'Discount above eight percent' END,\n"
        "  CASE WHEN floor(l_quantity / l_linenumber) * l_linenumber = l_quantity THEN 'Even split' END,\n"
        "  CASE WHEN l_quantity > 45 THEN 'Quantity above forty five' END,\n"
        "  CASE WHEN l_partkey % 8 = l_suppkey % 8 THEN 'Same low key bits' END) AS errs FROM lineitem)\n"
        "SELECT l_orderkey, l_linenumber, (errs = '') AS is_valid,\n"
        "  CASE WHEN errs = '' THEN 'Valid' ELSE errs END AS error_message FROM e"
    )
    keep = f"{KEY}, {TIME}, {', '.join(COUNTERS)}, {CAP}, {', '.join(DELTAS)}"
    for name in REPAIR_ORDER:
        s[name] = with_(*tel, *der, *val, *repair_cte("validated", "rp", name)) + f"\nSELECT {keep} FROM rp"
    s["iqr_fences"] = (
        "WITH f AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events)\n"
        "SELECT 'value' AS \"column\", q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM f"
    )
    s["outlier_previous"] = (
        with_(*outlier_ctes("events", "op", ["value"], "user_id", "ts, event_id"))
        + "\nSELECT event_id, user_id, ts, value FROM op"
    )
    s["outlier_previous_global"] = (
        with_(*outlier_ctes("events", "og", ["value"], None, "ts, user_id, event_id"))
        + "\nSELECT event_id, user_id, ts, value FROM og"
    )
    rchain, last = repair_chain_ctes("validated")
    oc = outlier_ctes(last, "oc", OUTLIER_COLUMNS, KEY, TIME)
    s["clean_all"] = with_(*tel, *der, *val, *rchain, *oc) + "\nSELECT * FROM oc"
    # flagship: generic checks (min 66 rows) -> calendar -> fills -> derive -> rules -> repairs -> outliers
    gen = [
        ("gv_dev", f"SELECT {KEY}, count(*) AS n FROM telemetry GROUP BY {KEY}"),
        ("gv_dup", f"SELECT {KEY}, {TIME}, count(*) AS n FROM telemetry GROUP BY {KEY}, {TIME}"),
        (
            "accepted",
            f"SELECT t.* FROM telemetry t JOIN gv_dev d ON t.{KEY} = d.{KEY}\n"
            f"JOIN gv_dup u ON t.{KEY} = u.{KEY} AND t.{TIME} = u.{TIME} WHERE d.n >= 66 AND u.n = 1",
        ),
    ]
    fcal = calendar_ctes("accepted", "fcal", KEY, TIME, "file_id", TEL_COLS, TEL_START, TEL_END, 30)
    fattr = bfill_cte("fcal", "fattr", KEY, TIME, ["site_name", "registration_no"])
    fseas = seasonal_ctes("fattr", "fseas", KEY, TIME, TEL_VALUES, TEL_START)
    ffill = fill_gap_ctes("fseas", "ffill", KEY, TIME, TEL_COLS, TEL_VALUES)
    ffull = bfill_cte("ffill", "ffull", KEY, TIME, [*COUNTERS, CAP])
    fder = derive_ctes("ffull")
    fval = validate_ctes("derived")
    frep, flast = repair_chain_ctes("validated")
    foc = outlier_ctes(flast, "foc", OUTLIER_COLUMNS, KEY, TIME)
    s["season_rule_report"] = (
        with_(*tel, *gen, *fcal, fattr, *fseas, *ffill, ffull, *fder, *fval, *frep, *foc) + "\n" + report_select("foc")
    )
    return s


SQL = _sql_all()
