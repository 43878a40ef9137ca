"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The tables ``events``, ``customer`` and ``part`` are views in the DuckDB
session. Each statement re-derives the visit log with the adapter rules and
computes the same columns, with the same names and types, as the Spark
query of the same name in ``plans.catalog``.
"""

from __future__ import annotations

from clickpath.operators.filters import SessionFilter
from clickpath.plans import catalog as C
from clickpath.schemas import STEP_LENGTH_BUCKETS, VISIT_LENGTH_BUCKETS

TIME_FMT = "'%Y-%m-%d %H:%M:%S'"


def _actions_cte(start: str | None = None, end: str | None = None) -> str:
    where = []
    if start:
        where.append(f"ts >= TIMESTAMP '{start} 00:00:00'")
    if end:
        where.append(f"ts < TIMESTAMP '{end} 00:00:00' + INTERVAL 1 DAY")
    where_sql = ("WHERE " + " AND ".join(where)) if where else ""
    return f"""actions AS (
  SELECT
    strftime(ts, '%Y-%m-%d') AS date,
    user_id,
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
    event_id % 10 AS page_id,
    date_trunc('second', ts) AS action_time,
    CASE WHEN event_type = 'view' THEN 'kw' || CAST(event_id % 10 AS VARCHAR) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id % 2000 END AS click_product_id,
    CASE WHEN event_type = 'signup'
         THEN concat_ws(',', CAST(k AS VARCHAR), CAST((k + 7) % 100 AS VARCHAR)) END AS order_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(event_id % 2000 AS VARCHAR) END AS order_product_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id % 2000 AS VARCHAR) END AS pay_product_ids,
    event_id % 100 AS city_id
  FROM (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  {where_sql}
)"""


USERS_CTE = """users AS (
  SELECT c_custkey AS user_id, c_name AS user_name, c_name AS name,
         c_custkey * 7 % 61 AS age, c_custkey % 100 AS professional,
         CAST(c_nationkey AS BIGINT) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
)"""


def _sessions_cte(name: str = "sessions", source: str = "actions") -> str:
    return f"""{name} AS (
  SELECT session_id,
    (min({{'t': action_time, 'u': user_id}}) FILTER (WHERE action_time IS NOT NULL AND user_id IS NOT NULL)).u
      AS user_id,
    min(action_time) AS start_time,
    max(action_time) AS end_time,
    date_diff('second', min(action_time), max(action_time)) AS visit_length,
    count(*) AS step_length,
    coalesce(list_sort(list(DISTINCT search_keyword) FILTER (WHERE search_keyword <> '')), []::VARCHAR[]) AS keywords,
    coalesce(list_sort(list(DISTINCT click_category_id) FILTER (WHERE click_category_id IS NOT NULL)), []::BIGINT[])
      AS click_categories
  FROM {source} GROUP BY session_id
)"""


FULL_CTE = """session_full AS (
  SELECT s.session_id, s.user_id, s.start_time, s.end_time, s.visit_length, s.step_length,
         s.keywords, s.click_categories, u.age, u.professional, u.city, u.sex
  FROM sessions s JOIN users u ON s.user_id = u.user_id
)"""

DETAILS_CTE = """details AS (
  SELECT a.* FROM actions a
  JOIN (SELECT session_id FROM session_full WHERE age BETWEEN 0 AND 100) f ON a.session_id = f.session_id
)"""

ITEMS_CTE = """items AS (
  SELECT session_id, click_category_id AS category_id, 'click' AS kind FROM details
  WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT session_id, TRY_CAST(x AS BIGINT) AS category_id, 'order' AS kind
  FROM (SELECT session_id, unnest(string_split(order_category_ids, ',')) AS x FROM details
        WHERE order_category_ids IS NOT NULL)
  WHERE TRY_CAST(x AS BIGINT) IS NOT NULL
  UNION ALL
  SELECT session_id, TRY_CAST(x AS BIGINT) AS category_id, 'pay' AS kind
  FROM (SELECT session_id, unnest(string_split(pay_category_ids, ',')) AS x FROM details
        WHERE pay_category_ids IS NOT NULL)
  WHERE TRY_CAST(x AS BIGINT) IS NOT NULL
)"""

COUNTS_CTE = """counts AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM items GROUP BY category_id
)"""

TOP_CTE = f"""top AS (
  SELECT * FROM counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id ASC
  LIMIT {C.TOP_K}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = (_actions_cte(), USERS_CTE, _sessions_cte(), FULL_CTE)


def _t(col: str) -> str:
    return f"strftime({col}, {TIME_FMT})"


def _render(src: str, extra: str = "") -> str:
    cols = [
        "session_id",
        "user_id",
        f"{_t('start_time')} AS start_time",
        f"{_t('end_time')} AS end_time",
        "visit_length",
        "step_length",
        "array_to_string(keywords, ',') AS search_keywords",
        "array_to_string(click_categories, ',') AS click_category_ids",
    ]
    if extra:
        cols.append(extra)
    return f"SELECT {', '.join(cols)} FROM {src}"


FULL_RENDER_EXTRA = "age, professional, city, sex"

ACTION_RENDER = (
    "date, user_id, session_id, page_id, "
    + _t("action_time")
    + " AS action_time, search_keyword, click_category_id, click_product_id, "
    "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids, city_id"
)

DETAIL_RENDER = (
    "user_id, session_id, page_id, "
    + _t("action_time")
    + " AS action_time, search_keyword, click_category_id, click_product_id, "
    "order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"
)


def _ratio(n: str, t: str) -> str:
    return f"CASE WHEN {t} > 0 THEN ((200 * {n} + {t}) // (2 * {t})) / 100.0 END"


def _in_bucket(v: str, lo: int, hi: int | None) -> str:
    return f"{v} >= {lo}" if hi is None else f"{v} BETWEEN {lo} AND {hi}"


def _histogram(src: str, value: str, buckets) -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE {_in_bucket(value, lo, hi)}) AS b{i}" for i, (_, lo, hi) in enumerate(buckets)
    )
    rows = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS bucket, b{i} AS sessions, {_ratio(f'b{i}', 'session_count')} AS ratio FROM c"
        for i, (name, _, _) in enumerate(buckets)
    )
    return f", c AS (SELECT count(*) AS session_count, {counts} FROM {src})\n{rows}"


def _counters(src: str) -> str:
    parts = ["count(*) AS session_count"]
    parts += [
        f"count(*) FILTER (WHERE {_in_bucket('visit_length', lo, hi)}) AS v_{n}" for n, lo, hi in VISIT_LENGTH_BUCKETS
    ]
    parts += [
        f"count(*) FILTER (WHERE {_in_bucket('step_length', lo, hi)}) AS s_{n}" for n, lo, hi in STEP_LENGTH_BUCKETS
    ]
    return f"SELECT {', '.join(parts)} FROM {src}"


def _aggr_stat(src: str) -> str:
    parts = ["count(*) AS session_count"]
    parts += [
        f"count(*) FILTER (WHERE {_in_bucket('visit_length', lo, hi)}) AS v_{n}" for n, lo, hi in VISIT_LENGTH_BUCKETS
    ]
    parts += [
        f"count(*) FILTER (WHERE {_in_bucket('step_length', lo, hi)}) AS s_{n}" for n, lo, hi in STEP_LENGTH_BUCKETS
    ]
    out = ["session_count"]
    out += [f"{_ratio(f'v_{n}', 'session_count')} AS visit_length_{n}_ratio" for n, _, _ in VISIT_LENGTH_BUCKETS]
    out += [f"{_ratio(f's_{n}', 'session_count')} AS step_length_{n}_ratio" for n, _, _ in STEP_LENGTH_BUCKETS]
    return f", c AS (SELECT {', '.join(parts)} FROM {src})\nSELECT {', '.join(out)} FROM c"


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _filter_sql(flt) -> str:
    conds = []
    if flt.start_age is not None and flt.end_age is not None:
        conds.append(f"age BETWEEN {flt.start_age} AND {flt.end_age}")
    if flt.professionals:
        conds.append(f"professional IN ({_sql_list(flt.professionals)})")
    if flt.cities:
        conds.append(f"city IN ({_sql_list(flt.cities)})")
    if flt.sex:
        conds.append(f"sex = '{flt.sex}'")
    if flt.keywords:
        conds.append(f"list_has_any(keywords, [{_sql_list(flt.keywords)}])")
    if flt.category_ids:
        conds.append(f"list_has_any(click_categories, [{_sql_list(flt.category_ids)}]::BIGINT[])")
    return " AND ".join(conds) if conds else "TRUE"


def _quota_ctes(total: int) -> str:
    return f""", hc AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour, count(*) AS sessions
  FROM session_full GROUP BY 1, 2
), q AS (
  SELECT date, hour, sessions,
         CAST(sum(sessions) OVER (PARTITION BY date) AS BIGINT) AS day_sessions,
         (SELECT count(DISTINCT date) FROM hc) AS days
  FROM hc
), quotas AS (
  SELECT date, hour, sessions, day_sessions, days, {total} // days AS day_quota,
         least(sessions, (sessions * ({total} // days)) // day_sessions) AS hour_quota
  FROM q
)"""


def _sample_ctes() -> str:
    return (
        _quota_ctes(C.SAMPLE_TOTAL)
        + f""", keyed AS (
  SELECT *, strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour FROM session_full
), ranked AS (
  SELECT k.*, q.hour_quota,
         row_number() OVER (PARTITION BY k.date, k.hour
                            ORDER BY md5(k.session_id || ':' || '{C.SAMPLE_SEED}'), k.session_id) AS draw_rank
  FROM keyed k JOIN quotas q ON k.date = q.date AND k.hour = q.hour
  WHERE q.hour_quota > 0
), sample AS (
  SELECT * FROM ranked WHERE draw_rank <= hour_quota AND draw_rank <= {C.SAMPLE_TOTAL}
)"""
    )


def _ranked_ctes() -> str:
    return f""", csc AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM details
  WHERE click_category_id IN (SELECT category_id FROM top)
  GROUP BY 1, 2
), ranked AS (
  SELECT * FROM (
    SELECT category_id, session_id, click_count,
           CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id ASC) AS INTEGER)
             AS rank
    FROM csc
  ) WHERE rank <= {C.TOP_N}
)"""


def _record_cte() -> str:
    parts = []
    for name, col in C.RECORD_FIELDS:
        if col == "search_keywords":
            expr = "array_to_string(keywords, ',')"
        elif col == "click_category_ids":
            expr = "array_to_string(click_categories, ',')"
        elif col == "start_time":
            expr = _t("start_time")
        else:
            expr = f"CAST({col} AS VARCHAR)"
        parts.append(f"'{name}=' || {expr}")
    return f", rec AS (SELECT session_id, visit_length, concat_ws('|', {', '.join(parts)}) AS record FROM session_full)"


def _java_split(rec: str) -> str:
    stripped = f"regexp_replace({rec}, '(?:\\|)+$', '')"
    return f"(CASE WHEN length({rec}) > 0 AND {stripped} = '' THEN []::VARCHAR[] ELSE string_split({stripped}, '|') END)"


def _kv_get(rec: str, field: str) -> str:
    frags = _java_split(rec)
    pairs = f"list_transform({frags}, lambda f: string_split(regexp_replace(f, '=+$', ''), '='))"
    hits = f"list_filter({pairs}, lambda p: len(p) = 2 AND p[1] = '{field}')"
    return f"{hits}[1][2]"


def _kv_set(rec: str, field: str, value: str) -> str:
    frags = _java_split(rec)
    pos = f"list_position(list_transform({frags}, lambda f: split_part(f, '=', 1)), '{field}')"
    return (
        f"array_to_string(list_transform({frags}, lambda f, i: CASE WHEN i = {pos} "
        f"THEN '{field}=' || {value} ELSE f END), '|')"
    )


def _parse(c: str, fmt: str = TIME_FMT) -> str:
    return f"try_strptime({c}, {fmt})"


def _format_double(x: str, scale: int) -> str:
    unit = 10**scale
    a = f"abs({x})"
    q = f"CAST(53 - floor(log2({a})) AS INTEGER)"
    m = f"CAST(CAST({a} * pow(2, {q}) AS BIGINT) AS HUGEINT)"
    n = f"(({m} * {2 * unit} + (1::HUGEINT << {q})) // (1::HUGEINT << ({q} + 1)))"
    return (
        f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {x} "
        f"WHEN {a} * {float(unit)} >= {float(2**53)} THEN {x} "
        f"WHEN {a} * {float(unit)} < 0.25 THEN 0.0 "
        f"ELSE sign({x}) * (CAST({n} AS DOUBLE) / {float(unit)}) END"
    )


def _pad(c: str) -> str:
    return f"CASE WHEN length({c}) = 2 THEN {c} ELSE '0' || {c} END"


def build() -> dict[str, str]:
    base = _with(*BASE)
    det = _with(*BASE, DETAILS_CTE)
    cat = _with(*BASE, DETAILS_CTE, ITEMS_CTE, COUNTS_CTE)
    sql: dict[str, str] = {}

    sql["actions"] = _with(_actions_cte()) + f"SELECT {ACTION_RENDER} FROM actions"
    sql["action_range"] = (
        _with(_actions_cte(C.RANGE_START, C.RANGE_END))
        + f"SELECT {ACTION_RENDER} FROM actions WHERE date BETWEEN '{C.RANGE_START}' AND '{C.RANGE_END}'"
    )
    sql["users"] = _with(USERS_CTE) + "SELECT * FROM users"
    sql["products"] = (
        "SELECT p_partkey AS product_id, p_name AS product_name, "
        "CAST(p_size % 2 + 1 AS VARCHAR) AS extend_info FROM part"
    )
    sql["session_agg"] = _with(_actions_cte(), _sessions_cte()) + _render("sessions")
    sql["session_full"] = base + _render("session_full", FULL_RENDER_EXTRA)
    for name, flt in C.FILTERS.items():
        sql[name] = base + _render(f"(SELECT * FROM session_full WHERE {_filter_sql(flt)})", FULL_RENDER_EXTRA)

    sql["filter_all_semi"] = sql["filter_all"]
    ranged = _with(
        _actions_cte(),
        f"ranged AS (SELECT * FROM actions WHERE date BETWEEN '{C.RANGE_START}' AND '{C.RANGE_END}')",
        USERS_CTE,
        _sessions_cte("sessions", "ranged"),
        FULL_CTE,
    )
    sql["filter_params"] = ranged + (
        f"SELECT session_id, user_id, {_t('start_time')} AS start_time, {_t('end_time')} AS end_time, visit_length, step_length, "
        f"{FULL_RENDER_EXTRA} FROM session_full WHERE {_filter_sql(SessionFilter.from_params(C.PARAMS))}"
    )
    sql["relative_dates"] = base + (
        "SELECT session_id, current_date AS today, current_date - 1 AS yesterday, "
        "date_diff('day', current_date - 1, current_date) AS gap, "
        "date_diff('day', CAST(start_time AS DATE), current_date) AS days_ago FROM session_full"
    )
    sql["visit_length_hist"] = base[:-1] + _histogram("session_full", "visit_length", VISIT_LENGTH_BUCKETS)
    sql["visit_length_hist_scaled"] = base[:-1] + _histogram(
        "session_full", f"floor(visit_length / {C.SCALED_VISIT_DIVISOR})", VISIT_LENGTH_BUCKETS
    )
    sql["step_length_hist"] = base[:-1] + _histogram("session_full", "step_length", STEP_LENGTH_BUCKETS)
    by_user = _with(
        _actions_cte(),
        "actions_u AS (SELECT * REPLACE (CAST(user_id AS VARCHAR) AS session_id) FROM actions)",
        USERS_CTE,
        _sessions_cte("sessions", "actions_u"),
        FULL_CTE,
    )
    sql["step_length_hist_by_user"] = by_user[:-1] + _histogram("session_full", "step_length", STEP_LENGTH_BUCKETS)
    sql["aggr_stat_all"] = base[:-1] + _aggr_stat("session_full")
    sql["aggr_stat_filtered"] = base[:-1] + _aggr_stat(
        f"(SELECT * FROM session_full WHERE {_filter_sql(C.STAT_FILTER)})"
    )

    sql["session_full_deduped"] = (
        base[:-1]
        + """, listed AS (SELECT * FROM users UNION ALL SELECT * REPLACE (age + 1 AS age) FROM users WHERE user_id % 3 = 0),
one AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY user_name, name, age, professional, city, sex) = 1)
"""
        + f"SELECT session_id, s.user_id, {_t('start_time')} AS start_time, {_t('end_time')} AS end_time, visit_length, step_length, "
        "age, professional, city, sex FROM sessions s JOIN one ON s.user_id = one.user_id"
    )
    sql["session_counters"] = base + _counters("session_full")
    sql["incremental_counters"] = (
        base[:-1]
        + f""", bounds AS (SELECT date_trunc('day', min(action_time)) AS d0 FROM actions),
timed AS (
  SELECT user_id, action_time, lag(action_time) OVER (PARTITION BY user_id ORDER BY action_time) AS previous,
         d0 + to_days(CAST({C.PERIOD_DAYS} * (date_diff('day', d0, date_trunc('day', action_time)) // {C.PERIOD_DAYS}) AS INTEGER)) AS period_start
  FROM actions, bounds),
parted AS (
  SELECT *, sum(CASE WHEN previous < period_start - to_days({C.IDLE_DAYS}) THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY action_time RANGE UNBOUNDED PRECEDING) AS part
  FROM timed),
parts AS (
  SELECT user_id, date_diff('second', min(action_time), max(action_time)) AS visit_length, count(*) AS step_length
  FROM parted GROUP BY user_id, part),
parts_full AS (SELECT parts.* FROM parts JOIN users USING (user_id))
"""
        + _counters("parts_full")
    )
    sql["hour_counts"] = base[:-1] + _quota_ctes(C.SAMPLE_TOTAL) + "\nSELECT date, hour, sessions FROM hc"
    sql["sample_quota"] = base[:-1] + _quota_ctes(C.SAMPLE_TOTAL) + "\nSELECT * FROM quotas"
    sql["sample_sessions"] = (
        base[:-1]
        + _sample_ctes()
        + f"\nSELECT session_id, user_id, {_t('start_time')} AS start_time, "
        "array_to_string(keywords, ',') AS search_keywords, "
        "array_to_string(click_categories, ',') AS click_category_ids, date, hour, "
        "CAST(draw_rank AS INTEGER) AS draw_rank FROM sample"
    )
    # inner join keeps one action row per matching sample row
    sql["sample_details"] = (
        base[:-1]
        + _sample_ctes()
        + f"\nSELECT {DETAIL_RENDER.replace('session_id', 'a.session_id', 1)} FROM actions a "
        "JOIN (SELECT session_id FROM sample) s ON a.session_id = s.session_id"
    )

    sql["action_days"] = (
        _with(_actions_cte())[:-1]
        + """, per_day AS (SELECT date, count(pay_category_ids) AS n FROM actions GROUP BY date)
"""
        + f"SELECT {ACTION_RENDER} FROM actions WHERE date IN (SELECT date FROM per_day WHERE n > (SELECT avg(n) FROM per_day))"
    )
    sql["session_details_bucketed"] = det + f"SELECT {DETAIL_RENDER} FROM details"
    sql["session_details"] = det + f"SELECT {DETAIL_RENDER} FROM details"
    sql["category_ids"] = cat + "SELECT DISTINCT category_id FROM items"
    sql["click_counts"] = (
        det + "SELECT click_category_id AS category_id, count(*) AS click_count FROM details "
        "WHERE click_category_id IS NOT NULL GROUP BY 1"
    )
    sql["order_counts"] = cat + "SELECT category_id, count(*) AS order_count FROM items WHERE kind = 'order' GROUP BY 1"
    sql["pay_counts"] = cat + "SELECT category_id, count(*) AS pay_count FROM items WHERE kind = 'pay' GROUP BY 1"
    sql["category_counts"] = cat + "SELECT * FROM counts"
    sql["category_counts_joined"] = sql["category_counts"]
    sql["top_categories"] = _with(*BASE, DETAILS_CTE, ITEMS_CTE, COUNTS_CTE, TOP_CTE) + "SELECT * FROM top"
    sql["category_session_clicks"] = (
        det + "SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM details "
        "WHERE click_category_id IS NOT NULL GROUP BY 1, 2"
    )
    ranked = _with(*BASE, DETAILS_CTE, ITEMS_CTE, COUNTS_CTE, TOP_CTE)[:-1] + _ranked_ctes()
    sql["top_sessions"] = ranked + "\nSELECT category_id, session_id, click_count, rank FROM ranked"
    sql["top_session_details"] = (
        ranked
        + f"\nSELECT r.category_id, {DETAIL_RENDER.replace('session_id', 'd.session_id', 1)} "
        "FROM details d JOIN ranked r ON d.session_id = r.session_id"
    )

    rec = base[:-1] + _record_cte()
    sql["kv_get"] = (
        rec
        + f"\nSELECT session_id, {_kv_get('record', 'visitLength')} AS visit_length_text, "
        f"{_kv_get('record', 'searchKeywords')} AS keywords_text, "
        f"{_kv_get('record', 'startTime')} AS start_text, "
        f"{_kv_get('record', 'sex')} AS sex_text, "
        f"{_kv_get('record', 'noSuchField')} AS missing_text FROM rec"
    )
    sql["kv_set"] = (
        rec
        + f"\nSELECT session_id, {_kv_set('record', 'visitLength', 'CAST(visit_length * 2 AS VARCHAR)')} AS doubled, "
        f"{_kv_set('record', 'noSuchField', chr(39) + 'x' + chr(39))} AS unchanged FROM rec"
    )
    trim = "regexp_replace({}, '^,|,$', '', 'g')"
    sql["trim_comma"] = (
        _with(_actions_cte())
        + f"SELECT session_id, {_t('action_time')} AS action_time, "
        f"{trim.format('order_category_ids')} AS order_trimmed, "
        f"{trim.format(chr(39) + ',' + chr(39) + ' || order_category_ids || ' + chr(39) + ',' + chr(39))} "
        "AS wrapped_trimmed, "
        f"{trim.format('pay_category_ids || ' + chr(39) + ',' + chr(39))} AS pay_trimmed FROM actions"
    )
    sql["pad_two"] = (
        _with(_actions_cte())
        + f"SELECT {_pad('CAST(hour(action_time) AS VARCHAR)')} AS hour_text, "
        f"{_pad('CAST(page_id AS VARCHAR)')} AS page_text, count(*) AS n FROM actions GROUP BY 1, 2"
    )
    sql["string_empty"] = (
        _with(_actions_cte())
        + "SELECT (search_keyword IS NULL OR search_keyword = '') AS keyword_empty, "
        "(search_keyword IS NOT NULL AND search_keyword <> '') AS keyword_present, "
        "(order_category_ids IS NULL OR order_category_ids = '') AS order_empty, count(*) AS n "
        "FROM actions GROUP BY 1, 2, 3"
    )
    at = _t("action_time")
    pivot = f"date || '{C.PIVOT_TIME}'"
    sql["time_compare"] = (
        _with(_actions_cte())
        + f"SELECT coalesce({_parse(at)} < {_parse(pivot)}, false) AS is_before, "
        f"coalesce({_parse(at)} > {_parse(pivot)}, false) AS is_after, "
        f"coalesce({_parse('search_keyword')} < {_parse(at)}, false) AS bad_before, count(*) AS n "
        "FROM actions GROUP BY 1, 2, 3"
    )

    def _minus(t1: str, t2: str) -> str:
        return f"coalesce(date_diff('second', {_parse(t2)}, {_parse(t1)}), 0)"

    sql["time_minus"] = (
        base[:-1]
        + ", r AS (" + _render("session_full") + ")\n"
        + f"SELECT session_id, visit_length, {_minus('end_time', 'start_time')} AS minus_forward, "
        f"{_minus('start_time', 'end_time')} AS minus_backward, "
        f"{_minus('search_keywords', 'start_time')} AS minus_bad FROM r"
    )
    sql["date_keys"] = (
        base
        + "SELECT session_id, strftime(start_time, '%Y-%m-%d') AS start_date, "
        f"{_t('start_time')} AS start_text, strftime(start_time, '%Y%m%d') AS date_key, "
        "CAST(try_strptime(strftime(start_time, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed_date, "
        "CAST(try_strptime(session_id, '%Y%m%d') AS DATE) AS bad_date, "
        "strftime(start_time, '%Y%m%d%H%M') AS time_minute, "
        "strftime(start_time, '%Y-%m-%d_%H') AS date_hour, "
        f"split_part({_t('start_time')}, ' ', 1) || '_' || split_part(split_part({_t('start_time')}, ' ', 2), ':', 1) "
        "AS date_hour_text FROM session_full"
    )
    sql["parse_times"] = (
        _with(_actions_cte())
        + f"SELECT coalesce({_parse(at)} = action_time, false) AS round_trip, "
        f"({_parse('date')} IS NULL) AS date_only_null, "
        f"({_parse("date || ' 25:00:00'")} IS NULL) AS bad_hour_null, count(*) AS n "
        "FROM actions GROUP BY 1, 2, 3"
    )
    sql["format_double"] = (
        "SELECT event_id, value, "
        f"{_format_double('value', 1)} AS value_1dp, "
        f"{_format_double('(value / 8)', 2)} AS eighth_2dp, "
        f"{_format_double('(-value)', 1)} AS negated_1dp, "
        f"{_format_double('value', 0)} AS value_0dp FROM events"
    )
    return sql


ORACLE_SQL: dict[str, str] = build()
