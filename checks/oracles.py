"""The same results as ``checks.queries`` in DuckDB SQL over the same tables."""

from checks.inputs import END, SPLIT, START
from checks.queries import AR, AR1, HMM, HOURLY_AR, HOURLY_AR1, ONE_GAP_AR

ORACLES: dict[str, str] = {}


# -- fragments ------------------------------------------------------------------------------------


def r6(expr: str, name: str | None = None) -> str:
    """Six places without negative zero."""
    body = f"CASE WHEN round({expr}, 6) = 0 THEN 0.0 ELSE round({expr}, 6) END"
    return f"CAST({body} AS DOUBLE) AS {name or expr}"


def floor0(expr: str) -> str:
    return f"CASE WHEN {expr} < 0 THEN 0.0 ELSE {expr} END"


def iso(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d') AS {name or expr}"


def week_starting(d: str) -> str:
    return f"({d} - CAST(dayofweek({d}) AS INTEGER))"


def week_ending(d: str) -> str:
    return f"({d} + CAST((7 - dayofweek({d})) % 7 AS INTEGER))"


def epi_year(d: str) -> str:
    return f"CAST(year({week_starting(d)} + 3) AS INTEGER)"


def epi_week(d: str) -> str:
    return f"CAST((dayofyear({week_starting(d)} + 3) - 1) // 7 + 1 AS INTEGER)"


def in_session(d: str) -> str:
    return (
        f"CASE WHEN (month({d}) > 6 AND month({d}) < 8) OR (month({d}) = 6 AND day({d}) >= 20) "
        f"OR (month({d}) = 8 AND day({d}) <= 31) THEN 0 ELSE 1 END"
    )


def since_school(d: str) -> str:
    opening = f"make_date(CAST(year({d}) AS BIGINT), 9, 1)"
    before = f"make_date(CAST(year({d}) - 1 AS BIGINT), 9, 1)"
    return f"({d} - CASE WHEN {d} < {opening} THEN {before} ELSE {opening} END) / 7.0"


def covid(d: str) -> str:
    return f"CASE WHEN {d} BETWEEN DATE '1998-03-01' AND DATE '1999-06-30' THEN 1 ELSE 0 END"


def post_covid(d: str) -> str:
    return f"CASE WHEN {d} > DATE '1999-06-30' THEN 1 ELSE 0 END"


DAY = "CAST(o_orderdate AS DATE)"
WEEKS = (
    f"(SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 7 DAY)) AS DATE) AS week_start)"
)
FACTS = f"facts AS (SELECT o_orderpriority AS series_id, {week_starting(DAY)} AS week_start, 1.0 AS value FROM orders)"
FINE_FACTS = (
    "facts AS (SELECT o_orderpriority || '/' || o_orderstatus AS series_id, "
    f"{week_starting(DAY)} AS week_start, 1.0 AS value, "
    "CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS finished_price FROM orders)"
)
UP = "PARTITION BY series_id ORDER BY week_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
DOWN = "PARTITION BY series_id ORDER BY week_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
W = "PARTITION BY series_id ORDER BY week_start"


def panel_ctes(prefix: str = "") -> str:
    """weekly sums, grid and panel after a ``facts`` table."""
    f = prefix
    return f"""
    {f}wk AS (SELECT series_id, week_start, CAST(sum(value) AS DOUBLE) AS y FROM {f}facts GROUP BY ALL),
    {f}grid AS (SELECT k.series_id, w.week_start FROM (SELECT DISTINCT series_id FROM {f}facts) k CROSS JOIN {WEEKS} w),
    {f}panel AS (SELECT g.series_id, g.week_start, k.y, {epi_year('g.week_start')} AS year,
        {epi_week('g.week_start')} AS week, row_number() OVER (PARTITION BY g.series_id ORDER BY g.week_start) AS i
        FROM {f}grid g LEFT JOIN {f}wk k ON k.series_id = g.series_id AND k.week_start = g.week_start)"""


def interpolate_ctes(prefix: str = "") -> str:
    f = prefix
    return f"""
    {f}known AS (SELECT *,
        last_value(y IGNORE NULLS) OVER ({UP}) AS pv,
        last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER ({UP}) AS pi,
        first_value(y IGNORE NULLS) OVER ({DOWN}) AS nv,
        first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER ({DOWN}) AS ni FROM {f}panel),
    {f}interp AS (SELECT series_id, week_start, year, week, i, CASE WHEN y IS NOT NULL THEN y WHEN nv IS NULL THEN pv
        ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END AS y FROM {f}known)"""


def fill(column: str) -> str:
    return (
        f"coalesce({column}, first_value({column} IGNORE NULLS) OVER ({DOWN}), "
        f"last_value({column} IGNORE NULLS) OVER ({UP}))"
    )


TARGET = f"""{panel_ctes()}, {interpolate_ctes()},
    target AS (SELECT series_id, week_start, year, week, i, y, ln(1 + y) AS log_y,
        CASE WHEN week_start <= DATE '{SPLIT}' THEN 'train' ELSE 'test' END AS part
        FROM (SELECT * REPLACE ({fill('y')} AS y) FROM interp))"""
LEAD = f"""
    lead_facts AS (SELECT 'LOW' AS series_id, week_start, value FROM fine WHERE series_id = '5-LOW/F'),
    {panel_ctes('lead_')}, {interpolate_ctes('lead_')},
    lead_raw AS (SELECT series_id, week_start, coalesce(y, 0.0) AS y FROM lead_interp),
    lead_lagged AS (SELECT series_id, week_start, y, lag(y) OVER ({W}) AS lag1, y - lag(y) OVER ({W}) AS delta FROM lead_raw),
    lead AS (SELECT week_start, y AS LOW_ILI_CASE, {fill('lag1')} AS LOW_ILI_LAG1, {fill('delta')} AS LOW_delta_1w
        FROM lead_lagged)"""
WEATHER = f"""
    daily AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS tmax, min(l_quantity) AS tmin
        FROM lineitem GROUP BY ALL),
    weekly_t AS (SELECT {week_ending('date')} AS week_start, avg((tmax + tmin) / 2) AS tmean_c FROM daily GROUP BY ALL),
    grid_t AS (SELECT 'all' AS series_id, w.week_start, t.tmean_c FROM {WEEKS} w LEFT JOIN weekly_t t USING (week_start)),
    lagged_t AS (SELECT *, lag(tmean_c, 1) OVER ({W}) AS tmean_lag1, lag(tmean_c, 2) OVER ({W}) AS tmean_lag2 FROM grid_t),
    weather AS (SELECT week_start, {fill('tmean_c')} AS tmean_c, {fill('tmean_lag1')} AS tmean_lag1,
        {fill('tmean_lag2')} AS tmean_lag2 FROM lagged_t)"""
FINE_PANEL = f"{FINE_FACTS}, {panel_ctes()}"
FINE = FINE_FACTS.replace("facts AS", "fine AS")
MATRIX = f"""{FACTS}, {FINE}, {TARGET}, {LEAD}, {WEATHER},
    matrix AS (SELECT * FROM target JOIN lead USING (week_start) JOIN weather USING (week_start))"""

FLAGGED = f"""{FACTS}, {TARGET},
    flagged AS (SELECT *, CASE WHEN y > avg(y) OVER (PARTITION BY series_id) THEN 1 ELSE 0 END AS is_season FROM target)"""
BASE = f"""{FLAGGED},
    means AS (SELECT series_id, week, avg(y) AS weekly_mean, median(y) AS weekly_median FROM target
        WHERE part = 'train' GROUP BY ALL),
    naive AS (SELECT *, lag(y) OVER ({W}) AS naive FROM flagged),
    wide AS (SELECT t.series_id, t.week_start, t.is_season, t.y, t.naive,
        coalesce(p.y, m.weekly_mean) AS seasonal_naive, m.weekly_mean, m.weekly_median
        FROM naive t LEFT JOIN means m ON m.series_id = t.series_id AND m.week = t.week
        LEFT JOIN target p ON p.series_id = t.series_id AND p.week = t.week AND p.year = t.year - 1 AND p.part = 'train'
        WHERE t.part = 'test')"""
PRED = f"""{BASE},
    pred AS (SELECT series_id, week_start, is_season, y, 'Naive (last week)' AS model, naive AS y_hat FROM wide
        UNION ALL SELECT series_id, week_start, is_season, y, 'Seasonal Naive (ly)', seasonal_naive FROM wide
        UNION ALL SELECT series_id, week_start, is_season, y, 'Weekly Mean', weekly_mean FROM wide
        UNION ALL SELECT series_id, week_start, is_season, y, 'Weekly Median', weekly_median FROM wide),
    scorable AS (SELECT * FROM pred WHERE y IS NOT NULL AND y_hat IS NOT NULL)"""
METRICS = """avg(abs(y - y_hat)) AS mae, sqrt(avg((y - y_hat) * (y - y_hat))) AS rmse,
    avg(CASE WHEN y <> 0 THEN abs((y - y_hat) / y) END) * 100 AS mape,
    avg(CASE WHEN abs(y) + abs(y_hat) = 0 THEN 0 ELSE 2 * abs(y - y_hat) / (abs(y) + abs(y_hat)) END) * 100 AS smape,
    CASE WHEN count(*) < 2 THEN NULL WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - y_hat) * (y - y_hat)) = 0 THEN 1.0 ELSE 0.0 END
        ELSE 1 - sum((y - y_hat) * (y - y_hat)) / (count(*) * var_pop(y)) END AS r2"""


def within(band: int) -> str:
    hit = f"CASE WHEN round(abs((y - y_hat) / y) * 100, 9) <= {band} THEN 1.0 ELSE 0.0 END"
    return f"avg(CASE WHEN y <> 0 THEN {hit} END) * 100 AS within_{band}pct"


BAND_LIST = ", ".join(within(b) for b in (20, 30, 50))
BAND_NAMES = ["within_20pct", "within_30pct", "within_50pct"]
FULL_NAMES = ["mae", "rmse", "mape", "smape", "r2", "directional_accuracy", *BAND_NAMES]


def turn(value: str, w: str) -> str:
    """Sign of a change; values that agree to nine digits are equal."""
    before = f"lag({value}) OVER {w}"
    return f"(CASE WHEN abs({value} - {before}) <= 1e-9 * greatest(abs({value}), abs({before})) THEN 0 ELSE sign({value} - {before}) END)"


def direction_of(group: str) -> str:
    """Equal sign of change within the group."""
    w = f"(PARTITION BY {group} ORDER BY week_start)"
    return (
        f"CASE WHEN lag(y) OVER {w} IS NOT NULL THEN CASE WHEN {turn('y', w)} = {turn('y_hat', w)} "
        "THEN 1.0 ELSE 0.0 END END AS hit"
    )


FULL = f"""{PRED},
    sections AS (SELECT *, 'overall' AS section FROM scorable
        UNION ALL SELECT *, CASE WHEN is_season = 1 THEN 'in_season' ELSE 'off_season' END FROM scorable),
    moves AS (SELECT *, {direction_of('series_id, model, section')} FROM sections),
    scores AS (SELECT series_id, model, section, {METRICS}, avg(hit) * 100 AS directional_accuracy, {BAND_LIST}
        FROM moves GROUP BY ALL)"""
COMPARE = f"""{PRED},
    moves AS (SELECT *, {direction_of('series_id, model')} FROM scorable),
    scores AS (SELECT series_id, model, {METRICS}, avg(hit) * 100 AS dir_accuracy,
        avg(CASE WHEN is_season = 1 THEN abs(y - y_hat) END) AS mae_season,
        sqrt(avg(CASE WHEN is_season = 1 THEN (y - y_hat) * (y - y_hat) END)) AS rmse_season
        FROM moves GROUP BY ALL)"""


def block_ctes(source: str, out: str) -> str:
    return f"""
    {out}_c AS (SELECT *, CASE WHEN lag(is_season) OVER ({W}) IS NOT DISTINCT FROM is_season THEN 0 ELSE 1 END AS changed
        FROM {source}),
    {out} AS (SELECT * EXCLUDE (changed), sum(changed) OVER ({UP}) AS block FROM {out}_c)"""


def short_ctes(min_weeks: int) -> str:
    return f"""{block_ctes('flagged', 'b1')},
    kept AS (SELECT * EXCLUDE (is_season, block), CASE WHEN is_season = 1
        AND count(*) OVER (PARTITION BY series_id, block) >= {min_weeks} THEN 1 ELSE 0 END AS is_season FROM b1)"""


# The labelling oracle walks through the blocks one by one and takes the first free year.
LABEL = f"""{block_ctes('kept', 'b2')},
    votes AS (SELECT series_id, block, year(week_start) AS yr, count(*) AS n FROM b2
        WHERE is_season = 1 AND month(week_start) IN (1, 2) GROUP BY ALL),
    winner AS (SELECT series_id, block, arg_max(yr, n * 100000 - yr) AS yr FROM votes GROUP BY ALL),
    cand AS (SELECT b.series_id, b.block, coalesce(max(v.yr), year(min(b.week_start)) + 1) AS cand,
        row_number() OVER (PARTITION BY b.series_id ORDER BY b.block) AS j
        FROM b2 b LEFT JOIN winner v ON v.series_id = b.series_id AND v.block = b.block
        WHERE b.is_season = 1 GROUP BY b.series_id, b.block),
    taken AS (
        SELECT series_id, block, j, CAST(cand AS BIGINT) AS label, [CAST(cand AS BIGINT)] AS used FROM cand WHERE j = 1
        UNION ALL
        SELECT c.series_id, c.block, c.j, x.label, list_append(t.used, x.label)
        FROM taken t JOIN cand c ON c.series_id = t.series_id AND c.j = t.j + 1,
        LATERAL (SELECT list_min(list_filter(generate_series(CAST(c.cand AS BIGINT), CAST(c.cand AS BIGINT) + 400),
            lambda z: NOT list_contains(t.used, z))) AS label) x),
    labelled AS (SELECT b.*, CAST(t.label AS INTEGER) AS season_label FROM b2 b
        LEFT JOIN taken t ON t.series_id = b.series_id AND t.block = b.block)"""
SHORT = f"{FLAGGED}, {short_ctes(2)}"
LABELLED = f"{SHORT}, {LABEL}"
STATS = f"""{LABELLED},
    stats AS (SELECT series_id, season_label, min(week_start) AS onset_date, max(week_start) AS end_date,
        count(*) AS duration_weeks, sum(y) AS total_ili_burden, max(y) AS peak_ili,
        min(CASE WHEN y = top THEN week_start END) AS peak_date FROM (
            SELECT *, max(y) OVER (PARTITION BY series_id, season_label) AS top FROM labelled WHERE season_label IS NOT NULL)
        GROUP BY ALL),
    season_stats AS (SELECT series_id, season_label, onset_date, CAST(weekofyear(onset_date) AS INTEGER) AS onset_week,
        peak_date, CAST(weekofyear(peak_date) AS INTEGER) AS peak_week, end_date,
        CAST(weekofyear(end_date) AS INTEGER) AS end_week, duration_weeks, peak_ili, total_ili_burden FROM stats)"""
STAND_IN = """stand_in AS (SELECT series_id, week_start, weekly_mean AS y_hat, weekly_mean * 0.5 AS ci_lower,
        weekly_mean * 3 AS ci_upper FROM wide)"""


def sql(name: str, ctes: str, select: str, recursive: bool = False) -> None:
    head = f"WITH {'RECURSIVE ' if recursive else ''}{ctes} " if ctes else ""
    ORACLES[name] = head + select


def columns(names) -> str:
    return ", ".join(r6(n) for n in names)


# -- sources and sinks ----------------------------------------------------------------------------

sql("s1_csv_facts", "", f"""SELECT o_orderpriority AS series_id, {iso(week_starting(DAY), 'week_start')},
    {r6('sum(o_totalprice)', 'y')} FROM orders GROUP BY o_orderpriority, {week_starting(DAY)}""")
sql("s2_lenient_numbers", "", f"""SELECT o_orderkey,
    {r6("CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END", 'price')} FROM orders""")
sql("s3_lenient_dates", "", f"""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime({DAY}, '%Y-%m-%d') END AS day
    FROM orders""")
sql("s4_weather_csv", WEATHER, f"SELECT 'all' AS station, {iso('week_start')}, {r6('tmean_c')} FROM weekly_t")
sql("s4_weather_stations", f"""
    daily AS (SELECT l_returnflag AS station, CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS tmax, min(l_quantity) AS tmin
        FROM lineitem GROUP BY ALL)""",
    f"""SELECT station, {iso(week_ending('date'), 'week_start')}, {r6('avg((tmax + tmin) / 2)', 'tmean_c')} FROM daily GROUP BY ALL""")
sql("s5_p2_holiday_csv", "", f"""SELECT {iso(DAY, 'ds')}, o_orderpriority AS name, count(*) AS n FROM orders
    GROUP BY {DAY}, o_orderpriority""")
sql("s7_feature_matrix_parquet", MATRIX,
    f"SELECT series_id, {iso('week_start')}, {r6('y')}, {r6('LOW_ILI_LAG1')}, {r6('tmean_lag2')} FROM matrix")
COMPARE_NAMES = ["mae", "rmse", "mape", "smape", "r2", "dir_accuracy", "mae_season", "rmse_season"]
sql("s8_comparison_csv", COMPARE, f"SELECT series_id, model, {columns(COMPARE_NAMES)} FROM scores")
sql("e8_compare_models", COMPARE, f"SELECT series_id, model, {columns(COMPARE_NAMES)} FROM scores")

# -- projection, filter, scalar functions ---------------------------------------------------------

sql("p1_series_filter", "", """SELECT o_orderpriority AS series_id, count(*) AS n FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY ALL""")
sql("p3_drop_null_rows", FINE_FACTS,
    "SELECT series_id, count(*) AS n FROM facts WHERE finished_price IS NOT NULL GROUP BY ALL")
sql("p4_daily_mean_temperature", WEATHER, f"SELECT {iso('date')}, {r6('(tmax + tmin) / 2', 'tmean')} FROM daily")
sql("p5_log_round_trip", FINE_PANEL, f"""SELECT series_id, {iso('week_start')}, {r6('ln(1 + y)', 'log_y')},
    {r6('y', 'back')}, {r6(floor0('exp(ln(1 + y) - 2) - 1'), 'clipped')} FROM panel""")
DAYS = f"days AS (SELECT DISTINCT {DAY} AS d FROM orders)"
sql("p6_epi_calendar", DAYS, f"SELECT {iso('d')}, {epi_year('d')} AS year, {epi_week('d')} AS week FROM days")
sql("p7_iso_week", DAYS, f"SELECT {iso('d')}, CAST(weekofyear(d) AS INTEGER) AS week FROM days")
sql("p8_period_flags", DAYS, f"SELECT {iso('d')}, {covid('d')} AS is_covid, {post_covid('d')} AS post_covid FROM days")
sql("p9_school_in_session", DAYS, f"SELECT {iso('d')}, {in_session('d')} AS school_in_session FROM days")
sql("p10_weeks_since_school", DAYS, f"SELECT {iso('d')}, {r6(since_school('d'), 'weeks_since_school')} FROM days")
sql("p11_clean_names", "", "SELECT lower(o_orderpriority) AS name, count(*) AS n FROM orders GROUP BY ALL")
GROUP_OF = """CASE name WHEN '1-urgent' THEN 'urgent' WHEN '2-high' THEN 'high' WHEN 'high' THEN 'high'
    WHEN '5-low' THEN 'low' ELSE 'other' END"""
sql("p12_p13_holiday_groups", "", f"""SELECT {GROUP_OF} AS holiday, 0 AS lower_window,
    CASE WHEN {GROUP_OF} = 'high' THEN 14 ELSE 7 END AS upper_window, count(*) AS n
    FROM (SELECT lower(o_orderpriority) AS name FROM orders) GROUP BY ALL""")
STACKED = f"""stacked AS (SELECT {DAY} AS ds, lower(o_orderpriority) AS name, 0 AS source, o_orderkey AS seq FROM orders
    UNION ALL SELECT CAST(l_shipdate AS DATE), 'high', 1, l_orderkey FROM lineitem)"""
ONE = f"""{STACKED},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY source, seq, name) AS r,
        count(*) OVER (PARTITION BY ds) AS n FROM stacked),
    one AS (SELECT ds, name, n - 1 AS n_dropped FROM ranked WHERE r = 1)"""
sql("s6_u1_two_sources", STACKED, "SELECT source, name, count(*) AS n FROM stacked GROUP BY ALL")
sql("t2_one_per_date", ONE, f"SELECT {iso('ds')}, name, n_dropped FROM one")
sql("a5_first_per_year", "", f"""SELECT CAST(year({DAY}) AS INTEGER) AS year, o_orderpriority AS holiday,
    {iso(f'min({DAY})', 'ds')} FROM orders GROUP BY year({DAY}), o_orderpriority""")
sql("p14_holiday_table", f"""{ONE},
    firsts AS (SELECT {GROUP_OF} AS holiday, year(ds) AS yr, min(ds) AS ds FROM one GROUP BY ALL)""",
    f"""SELECT holiday, {iso('ds')}, 0 AS lower_window, CASE WHEN holiday = 'high' THEN 14 ELSE 7 END AS upper_window
    FROM firsts WHERE ds BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""")
sql("p15_split", f"{FACTS}, {TARGET}", f"""SELECT series_id, part, count(*) AS n, {iso('min(week_start)', 'first_week')},
    {iso('max(week_start)', 'last_week')} FROM target GROUP BY series_id, part""")
FUTURE = f"""future AS (SELECT s.series_id, CAST(k AS INTEGER) AS step, DATE '{END}' + CAST(7 * k AS INTEGER) AS week_start,
    {epi_week(f"(DATE '{END}' + CAST(7 * k AS INTEGER))")} AS week
    FROM (SELECT DISTINCT o_orderpriority AS series_id FROM orders) s, (SELECT unnest(generate_series(1, 35)) AS k))"""
sql("p16_horizon", FUTURE, f"SELECT series_id, step, {iso('week_start')}, week FROM future")
sql("p17_j7_future_regressors", f"""{MATRIX}, {FUTURE},
    by_week AS (SELECT series_id, week, median(tmean_c) AS t, median(LOW_ILI_LAG1) AS l FROM matrix GROUP BY ALL),
    overall AS (SELECT series_id, median(tmean_c) AS t, median(LOW_ILI_LAG1) AS l FROM matrix GROUP BY ALL)""",
    f"""SELECT f.series_id, f.step, {iso('f.week_start', 'week_start')}, f.week,
    {in_session('f.week_start')} AS school_in_session, {r6(since_school('f.week_start'), 'weeks_since_school')},
    0 AS is_covid, {post_covid('f.week_start')} AS post_covid,
    {r6('CASE WHEN w.week IS NOT NULL THEN w.t ELSE o.t END', 'tmean_c')},
    {r6('CASE WHEN w.week IS NOT NULL THEN w.l ELSE o.l END', 'LOW_ILI_LAG1')}, CAST(0.0 AS DOUBLE) AS unknown
    FROM future f LEFT JOIN by_week w ON w.series_id = f.series_id AND w.week = f.week
    LEFT JOIN overall o ON o.series_id = f.series_id""")

# -- joins and aggregates -------------------------------------------------------------------------

for _name in ("j1_grid_left_join", "j1_a1_weekly_panel"):
    sql(_name, FINE_PANEL, f"SELECT series_id, {iso('week_start')}, year, week, {r6('y')} FROM panel")
SUPPLIER_FACTS = (
    f"facts AS (SELECT s_suppkey AS series_id, {week_starting('CAST(l_shipdate AS DATE)')} AS week_start, "
    "CASE WHEN l_shipdate IS NOT NULL THEN 1.0 END AS value FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey)"
)
sql("j1_a1_supplier_panel", f"{SUPPLIER_FACTS}, {panel_ctes()}",
    f"SELECT series_id, {iso('week_start')}, year, week, {r6('y')} FROM panel")
sql("e7_supplier_evaluation", FULL.replace(FACTS, SUPPLIER_FACTS),
    f"SELECT series_id, model, section, {columns(FULL_NAMES)} FROM scores")
sql("a1_weekly_store", FINE_PANEL, f"""SELECT series_id, {iso('week_start')}, year, week, {r6('y')} FROM panel
    WHERE week_start BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'""")
sql("j2_leading_series_join", MATRIX, f"""SELECT series_id, {iso('week_start')}, {r6('y')}, {r6('LOW_ILI_CASE')},
    {r6('LOW_ILI_LAG1')}, {r6('LOW_delta_1w')} FROM matrix""")
sql("j3_temperature_join", MATRIX, f"""SELECT series_id, {iso('week_start')}, {r6('tmean_c')}, {r6('tmean_lag1')},
    {r6('tmean_lag2')} FROM matrix""")
sql("j4_wide_by_code", f"""{FINE_FACTS},
    wk AS (SELECT series_id, week_start, CAST(sum(value) AS DOUBLE) AS y FROM facts
        WHERE series_id IN ('1-URGENT/F', '5-LOW/O') GROUP BY ALL)""",
    f"""SELECT {iso('coalesce(a.week_start, b.week_start)', 'week_start')}, {r6('a.y', '"1-URGENT/F_ILI_CASE"')},
    {r6('b.y', '"5-LOW/O_ILI_CASE"')} FROM (SELECT * FROM wk WHERE series_id = '1-URGENT/F') a
    FULL JOIN (SELECT * FROM wk WHERE series_id = '5-LOW/O') b ON a.week_start = b.week_start""")
sql("a1_weekly_sum", FINE_FACTS, f"""SELECT series_id, {iso('week_start')}, {r6('coalesce(sum(finished_price), 0.0)', 'y')}
    FROM facts GROUP BY series_id, week_start""")
sql("a2_weekly_mean_temperature", WEATHER, f"SELECT 'all' AS station, {iso('week_start')}, {r6('tmean_c')} FROM weekly_t")
sql("a3_week_means", f"{FACTS}, {TARGET}", f"""SELECT series_id, week, {r6('avg(y)', 'mean_y')} FROM target
    WHERE part = 'train' GROUP BY series_id, week""")
sql("a4_week_medians", f"{FACTS}, {TARGET}, o AS (SELECT series_id, median(y) AS m FROM target GROUP BY ALL)",
    f"""SELECT t.series_id, t.week, {r6('median(t.y)', 'week_median')}, {r6('any_value(o.m)', 'overall_median')}
    FROM target t JOIN o ON o.series_id = t.series_id GROUP BY t.series_id, t.week""")
sql("a6_season_stats", STATS, f"""SELECT series_id, season_label, {iso('onset_date')}, onset_week, {iso('peak_date')},
    peak_week, {iso('end_date')}, end_week, duration_weeks, {r6('peak_ili')}, {r6('total_ili_burden')} FROM season_stats""",
    recursive=True)
SUMMARY = ("duration_weeks", "onset_week", "peak_week", "peak_ili", "total_ili_burden")
FUNCTIONS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
sql("a7_cross_season_summary", STATS, " UNION ALL ".join(
    f"SELECT series_id, '{c}' AS metric, '{s}' AS statistic, {r6(f'{f}(CAST({c} AS DOUBLE))', 'value')} "
    "FROM season_stats GROUP BY series_id"
    for c in SUMMARY for s, f in FUNCTIONS.items()), recursive=True)
sql("a9_season_count", LABELLED, "SELECT series_id, count(DISTINCT season_label) AS n_seasons FROM labelled GROUP BY ALL",
    recursive=True)
sql("a10_null_audit", f"{FINE_PANEL}, lagged AS (SELECT *, lag(y) OVER ({W}) AS y_lag1 FROM panel)", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null, count(*) AS n_rows, "
    f"{r6(f'(count(*) - count({c})) / count(*) * 100', 'pct_null')} FROM lagged"
    for c in ("y", "y_lag1", "week")))
PEAK = """peaks AS (SELECT series_id, min(week_start) AS first_week, max(week_start) AS last_week, sum(y_hat) AS total,
        max(y_hat) AS peak_value, min(CASE WHEN y_hat = top THEN week_start END) AS peak_date
        FROM (SELECT *, max(y_hat) OVER (PARTITION BY series_id) AS top FROM stand_in) GROUP BY ALL)"""
sql("a11_projection_totals", f"{BASE}, {STAND_IN}, {PEAK}", f"""SELECT p.series_id, {iso('p.first_week', 'first_week')},
    {iso('p.last_week', 'last_week')}, {r6('p.total', 'total')}, {r6('p.peak_value', 'peak_value')},
    {iso('p.peak_date', 'peak_date')}, {r6('s.ci_lower', 'peak_lower')}, {r6('s.ci_upper', 'peak_upper')}
    FROM peaks p JOIN stand_in s ON s.series_id = p.series_id AND s.week_start = p.peak_date""")

# -- ordered operators ----------------------------------------------------------------------------

sql("w1_lags", FINE_PANEL, f"""SELECT series_id, {iso('week_start')}, {r6(f'lag(y, 1) OVER ({W})', 'y_lag1')},
    {r6(f'lag(y, 2) OVER ({W})', 'y_lag2')} FROM panel""")
sql("w2_first_difference", FINE_PANEL,
    f"SELECT series_id, {iso('week_start')}, {r6(f'y - lag(y) OVER ({W})', 'delta')} FROM panel")
sql("w3_next_week_target", f"{FACTS}, {TARGET}, nxt AS (SELECT *, lead(log_y) OVER ({W}) AS target FROM target)",
    f"SELECT series_id, {iso('week_start')}, {r6('target')} FROM nxt WHERE target IS NOT NULL")
FINE_INTERP = f"{FINE_PANEL}, {interpolate_ctes()}"
sql("w4_interpolate", FINE_INTERP, f"SELECT series_id, {iso('week_start')}, {r6('y')} FROM interp")
sql("w5_interpolate_zero", FINE_INTERP, f"SELECT series_id, {iso('week_start')}, {r6('coalesce(y, 0.0)', 'y')} FROM interp")
sql("w6_back_then_forward_fill", f"{FINE_PANEL}, lagged AS (SELECT *, lag(y) OVER ({W}) AS y_lag1 FROM panel)",
    f"""SELECT series_id, {iso('week_start')}, {r6('y')}, {r6('y_lag1')}
    FROM (SELECT series_id, week_start, {fill('y')} AS y, {fill('y_lag1')} AS y_lag1 FROM lagged)""")
sql("w7_target_fill", f"{FINE_FACTS}, {TARGET}",
    f"SELECT series_id, {iso('week_start')}, year, week, {r6('y')}, {r6('log_y')} FROM target")
sql("w8_safe_fill", f"{FINE_PANEL}, lagged AS (SELECT *, lag(y) OVER ({W}) AS l1, lag(y, 3) OVER ({W}) AS l3 FROM panel)",
    f"""SELECT series_id, {iso('week_start')}, {r6('y', 'X_ILI_CASE')}, {r6('l1', 'X_ILI_LAG1')}, {r6('l3', 'other_lag3')}
    FROM (SELECT series_id, week_start, {fill('y')} AS y, {fill('l1')} AS l1, l3 FROM lagged)""")
sql("w9_blocks", f"{FLAGGED}, {block_ctes('flagged', 'b1')}", """SELECT series_id, CAST(min(i) - 1 AS INTEGER) AS start,
    CAST(max(i) - 1 AS INTEGER) AS "end", count(*) AS length FROM b1 WHERE is_season = 1 GROUP BY series_id, block""")
sql("w10_drop_short_blocks", SHORT, f"SELECT series_id, {iso('week_start')}, is_season FROM kept")
sql("w11_season_labels", LABELLED, f"SELECT series_id, {iso('week_start')}, is_season, season_label FROM labelled",
    recursive=True)
sql("w12_direction", f"{FACTS}, {TARGET}",
    f"SELECT series_id, {iso('week_start')}, CAST(CASE WHEN lag(y) OVER ({W}) IS NOT NULL THEN {turn('y', f'({W})')} END AS DOUBLE) AS change FROM target")
RECENT4 = f"""{LABELLED},
    ranked_s AS (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY season_label DESC) AS r FROM labelled
        WHERE season_label IS NOT NULL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY series_id, season_label ORDER BY week_start) AS n,
        max(y) OVER (PARTITION BY series_id, season_label) AS top FROM ranked_s WHERE r <= 4),
    aligned AS (SELECT series_id, season_label, week_start, y,
        CAST(n - min(CASE WHEN y = top THEN n END) OVER (PARTITION BY series_id, season_label) AS INTEGER) AS week_index
        FROM placed)"""
sql("w12_direction_small", f"{FACTS}, {TARGET}",
    f"SELECT series_id, {iso('week_start')}, CAST(CASE WHEN lag(y) OVER ({W}) IS NOT NULL THEN {turn('y', f'({W})')} END AS DOUBLE) AS change FROM target")
RECENT4 = f"""{LABELLED},
    ranked_s AS (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY season_label DESC) AS r FROM labelled
        WHERE season_label IS NOT NULL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY series_id, season_label ORDER BY week_start) AS n,
        max(y) OVER (PARTITION BY series_id, season_label) AS top FROM ranked_s WHERE r <= 4),
    aligned AS (SELECT series_id, season_label, week_start, y,
        CAST(n - min(CASE WHEN y = top THEN n END) OVER (PARTITION BY series_id, season_label) AS INTEGER) AS week_index
        FROM placed)"""
sql("a10_off_grid_facts", """raw AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS d FROM orders)""",
    """SELECT series_id, CASE WHEN d IS NULL THEN 'no date' WHEN d NOT BETWEEN DATE '1996-01-07' AND DATE '2000-12-31'
        THEN 'outside the grid' ELSE 'not a Sunday' END AS reason, count(*) AS n_facts FROM raw
    WHERE d IS NULL OR d NOT BETWEEN DATE '1996-01-07' AND DATE '2000-12-31' OR dayofweek(d) <> 0 GROUP BY ALL""")
sql("w13_weeks_from_peak", RECENT4, f"SELECT series_id, season_label, {iso('week_start')}, week_index FROM aligned",
    recursive=True)
sql("t1_sorted_positions", f"{FACTS}, {panel_ctes()}",
    f"SELECT series_id, CAST(i - 1 AS INTEGER) AS position, {iso('week_start')} FROM panel ORDER BY 1, 2")
sql("t3_peak_week", f"{FACTS}, {TARGET}", f"""SELECT series_id, {r6('max(y)', 'peak_value')},
    {iso('min(CASE WHEN y = top THEN week_start END)', 'peak_week')}
    FROM (SELECT *, max(y) OVER (PARTITION BY series_id) AS top FROM target) GROUP BY series_id""")
sql("t4_m12_recent_seasons", f"""{LABELLED},
    per AS (SELECT series_id, season_label, max(y) AS peak, sum(y) AS total, count(*) AS n_weeks, max(week_start) AS last
        FROM labelled WHERE season_label IS NOT NULL GROUP BY ALL),
    ends AS (SELECT series_id, max(week_start) AS last_day FROM labelled GROUP BY ALL),
    whole_s AS (SELECT p.* FROM per p JOIN ends e ON e.series_id = p.series_id WHERE NOT (p.last >= e.last_day AND p.n_weeks < 10
        AND p.season_label = (SELECT max(q.season_label) FROM per q WHERE q.series_id = p.series_id))),
    ranked_s AS (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY season_label DESC) AS r FROM whole_s)""",
    f"SELECT series_id, season_label, {r6('peak')}, {r6('total')}, n_weeks FROM ranked_s WHERE r <= 3", recursive=True)
sql("t5_last_60_weeks", f"{FACTS}, {TARGET}",
    f"SELECT series_id, {iso('week_start')}, {r6('y')} FROM target WHERE week_start >= DATE '{END}' - 420")
sql("t6_rank_by_aic", f"""{PRED},
    scored AS (SELECT series_id, model AS features, count(*) * ln(avg((y - y_hat) * (y - y_hat))) + 2 AS aic
        FROM pred GROUP BY ALL)""", f"""SELECT series_id, features, {r6('aic')},
    CAST(row_number() OVER (PARTITION BY series_id ORDER BY aic, features) AS INTEGER) AS rank FROM scored""")

# -- baselines and evaluation ---------------------------------------------------------------------

for _name, _column in (
    ("b1_w14_naive", "naive"), ("b2_j5_seasonal_naive", "seasonal_naive"),
    ("b3_j6_weekly_mean", "weekly_mean"), ("b4_weekly_median", "weekly_median"),
):
    sql(_name, BASE, f"SELECT series_id, {iso('week_start')}, {r6(_column)} FROM wide")
sql("b5_all_baselines", PRED,
    f"SELECT series_id, {iso('week_start')}, is_season, {r6('y')}, model, {r6('y_hat')} FROM pred")
for _name, _columns in {
    "e1_mae_rmse": ["mae", "rmse"], "e2_mape": ["mape"], "e3_smape": ["smape"], "e4_r2": ["r2"],
    "e5_directional_accuracy": ["directional_accuracy"], "e6_band_accuracy": BAND_NAMES,
}.items():
    sql(_name, FULL, f"SELECT series_id, model, {columns(_columns)} FROM scores WHERE section = 'overall'")
sql("e7_full_evaluation", FULL, f"SELECT series_id, model, section, {columns(FULL_NAMES)} FROM scores")
sql("a8_metric_rows", FULL, " UNION ALL ".join(
    f"SELECT series_id, model, section, '{m}' AS metric, {r6(m, 'value')} FROM scores" for m in FULL_NAMES))

# -- models with given parameters -----------------------------------------------------------------


def poly(plain, seasonal, s, d):
    """Lag -> coefficient of the autoregressive side."""
    out = {0: 1.0}

    def times(a, b):
        r = {}
        for i, x in a.items():
            for j, y in b.items():
                r[i + j] = r.get(i + j, 0.0) + x * y
        return r

    out = times({0: 1.0} | {i + 1: -v for i, v in enumerate(plain)}, {0: 1.0} | {(j + 1) * s: -v for j, v in enumerate(seasonal)})
    for _ in range(d):
        out = times(out, {0: 1.0, 1: -1.0})
    return out


def interval_columns(log_hat: str, sigma: float) -> str:
    z = 1.959963984540054 * sigma
    return ", ".join(
        r6(floor0(f"exp({e}) - 1"), n)
        for n, e in (("y_hat", log_hat), ("ci_lower", f"{log_hat} - {z}"), ("ci_upper", f"{log_hat} + {z}"))
    )


def walk(model, order_by, exog):
    terms = poly(model["ar"], model["sar"], model["seasonal"][3], model["order"][1])
    parts = " ".join(
        f"- ({c!r}) * lag(u, {k}) OVER (PARTITION BY series_id ORDER BY {order_by})" for k, c in terms.items() if k
    )
    return f"SELECT *, {exog} {parts} AS log_hat FROM disturbance"


SIGMA = AR["sigma2"] ** 0.5
WALK = f"""{FACTS}, {TARGET},
    disturbance AS (SELECT *, {AR['beta'][0]} * ({in_session('week_start')}) AS effect,
        log_y - {AR['beta'][0]} * ({in_session('week_start')}) AS u FROM target),
    ahead AS ({walk(AR, 'week_start', 'effect')})"""
for _name in ("m8_walk_forward_given", "m8_walk_forward_by_lags", "s9_saved_models"):
    sql(_name, WALK, f"""SELECT series_id, {iso('week_start')}, {r6('log_y')}, {r6('log_hat')}, {r6(repr(SIGMA), 'sigma')},
        {interval_columns('log_hat', SIGMA)} FROM ahead WHERE part = 'test'""")

PHI, B1 = AR1["ar"][0], AR1["beta"][0]
PATH = """
    path AS (SELECT series_id, CAST(0 AS BIGINT) AS step, u1 AS u, u2 AS before FROM origin
        UNION ALL SELECT series_id, step + 1, {a} * u - {b} * before, u FROM path WHERE step < {n})"""


def origin(where: str) -> str:
    return f"""disturbance AS (SELECT *, log_y - {B1} * ({in_session('week_start')}) AS u FROM target WHERE {where}),
    origin AS (SELECT series_id, arg_max(u, week_start) AS u1, arg_max(before, week_start) AS u2 FROM
        (SELECT *, lag(u) OVER ({W}) AS before FROM disturbance) GROUP BY ALL)"""


def path(n):
    return PATH.format(a=1 + PHI, b=PHI, n=n)


sql("m7_multistep_given", f"""{FACTS}, {TARGET}, {origin("part = 'train'")}, {path(82)},
    steps AS (SELECT series_id, week_start, log_y, row_number() OVER ({W}) AS step FROM target WHERE part = 'test'),
    ahead AS (SELECT s.*, p.u + {B1} * ({in_session('s.week_start')}) AS log_hat FROM steps s JOIN path p
        ON p.series_id = s.series_id AND p.step = s.step)""",
    f"""SELECT series_id, {iso('week_start')}, {r6('log_y')}, {r6('log_hat')},
    {r6(floor0('exp(log_hat) - 1'), 'y_hat')} FROM ahead""", recursive=True)
sql("m11_projection_given", f"""{FACTS}, {TARGET}, {origin('TRUE')}, {path(35)}, {FUTURE},
    ahead AS (SELECT f.*, p.u + {B1} * ({in_session('f.week_start')}) AS log_hat FROM future f JOIN path p
        ON p.series_id = f.series_id AND p.step = f.step)""",
    f"""SELECT series_id, {iso('week_start')}, {r6('log_hat')}, {interval_columns('log_hat', AR1['sigma2'] ** 0.5)}, week
    FROM ahead""", recursive=True)


def interval_of(log_hat: str, sigma: str) -> str:
    """Forecast and limits from a column of its own standard deviations."""
    z = f"1.959963984540054 * ({sigma})"
    named = (("y_hat", log_hat), ("ci_lower", f"({log_hat} - {z})"), ("ci_upper", f"({log_hat} + {z})"))
    return ", ".join(r6(floor0(f"exp({e}) - 1"), n) for n, e in named)


# One lag and one difference: the weight of an innovation j steps back is (1 - phi^(j+1)) / (1 - phi).
sql("m11_horizon_interval_given", f"""{FACTS}, {TARGET}, {origin('TRUE')}, {path(35)}, {FUTURE},
    widths AS (SELECT h, sqrt({AR1['sigma2']} * list_sum(list_transform(range(h), lambda j:
        pow((1 - pow({PHI}, j + 1)) / (1 - ({PHI})), 2)))) AS sigma FROM (SELECT unnest(range(1, 36)) AS h)),
    ahead AS (SELECT f.*, p.u + {B1} * ({in_session('f.week_start')}) AS log_hat, w.sigma FROM future f JOIN path p
        ON p.series_id = f.series_id AND p.step = f.step JOIN widths w ON w.h = f.step)""",
    f"""SELECT series_id, {iso('week_start')}, {r6('log_hat')}, {interval_of('log_hat', 'sigma')}, week
    FROM ahead""", recursive=True)

# A panel with gaps, and closed forms on it: a random walk, a mean, one lag over a gap of any length.
_GB, _GPHI, _GS2 = ONE_GAP_AR["beta"][0], ONE_GAP_AR["ar"][0], ONE_GAP_AR["sigma2"]
GAPPED = f"""{FINE_PANEL},
    gapped AS (SELECT *, ln(1 + y) AS log_y, {in_session('week_start')} AS x,
        CASE WHEN week_start <= DATE '{SPLIT}' THEN 'train' ELSE 'test' END AS part FROM panel)"""
sql("m6_exact_random_walk", f"""{GAPPED},
    moves AS (SELECT series_id, log_y - lag(log_y) OVER ({W}) AS move, i - lag(i) OVER ({W}) AS weeks FROM gapped
        WHERE part = 'train' AND log_y IS NOT NULL),
    fitted AS (SELECT series_id, count(move) AS n, sum(move * move / weeks) / count(move) AS s2, sum(ln(weeks)) AS stretch
        FROM moves GROUP BY ALL),
    scored AS (SELECT *, -0.5 * (n * (ln(2 * pi() * s2) + 1) + stretch) AS ll FROM fitted)""",
    f"""SELECT series_id, {r6('s2', 'sigma2')}, {r6('ll', 'log_likelihood')}, {r6('2 - 2 * ll', 'aic')}, n AS nobs,
    CAST(NULL AS VARCHAR) AS message FROM scored""")
sql("m6_exact_regressor", f"""{GAPPED},
    seen AS (SELECT * FROM gapped WHERE part = 'train' AND log_y IS NOT NULL),
    beta AS (SELECT series_id, sum(x * log_y) / sum(x * x) AS b FROM seen GROUP BY ALL),
    fitted AS (SELECT s.series_id, any_value(b) AS b, count(*) AS n, avg(pow(log_y - b * x, 2)) AS s2
        FROM seen s JOIN beta USING (series_id) GROUP BY ALL),
    scored AS (SELECT *, -0.5 * n * (ln(2 * pi() * s2) + 1) AS ll FROM fitted)""",
    f"""SELECT series_id, {r6('b', 'beta')}, {r6('s2', 'sigma2')}, {r6('ll', 'log_likelihood')}, {r6('4 - 2 * ll', 'aic')},
    n AS nobs FROM scored""")


def over_gaps(known: str) -> str:
    """Forecast and standard deviation of each week from the last one before it that ``known`` admits."""
    earlier = f"OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""{GAPPED},
    u AS (SELECT *, CASE WHEN {known} THEN log_y - {_GB} * x END AS u FROM gapped),
    back AS (SELECT *, last_value(u IGNORE NULLS) {earlier} AS last_u,
        i - last_value(CASE WHEN u IS NOT NULL THEN i END IGNORE NULLS) {earlier} AS h FROM u),
    ahead AS (SELECT *, {_GB} * x + coalesce(pow({_GPHI}, h) * last_u, 0) AS log_hat,
        sqrt({_GS2} * (1 - coalesce(pow({_GPHI}, 2 * h), 0)) / (1 - {_GPHI * _GPHI})) AS sigma FROM back)"""


sql("m8_exact_walk_forward_given", over_gaps("TRUE"), f"""SELECT series_id, {iso('week_start')}, {r6('log_y')}, {r6('log_hat')},
    {r6('sigma')}, {interval_of('log_hat', 'sigma')} FROM ahead WHERE part = 'test'""")
sql("m7_exact_multistep_given", over_gaps("part = 'train'"), f"""SELECT series_id, {iso('week_start')}, {r6('log_y')},
    {r6('log_hat')}, {r6(floor0('exp(log_hat) - 1'), 'y_hat')} FROM ahead WHERE part = 'test'""")
sql("m11_exact_horizon_given", f"""{GAPPED},
    last_seen AS (SELECT series_id, arg_max(log_y - {_GB} * x, i) FILTER (log_y IS NOT NULL) AS u,
        max(i) - max(i) FILTER (log_y IS NOT NULL) AS ago, max(week_start) AS last_week FROM gapped GROUP BY ALL),
    steps AS (SELECT *, CAST(last_week + 7 * step AS DATE) AS week_start, step + ago AS h
        FROM last_seen, (SELECT CAST(unnest(range(1, 36)) AS INTEGER) AS step)),
    ahead AS (SELECT *, {_GB} * ({in_session('week_start')}) + pow({_GPHI}, h) * u AS log_hat,
        sqrt({_GS2} * (1 - pow({_GPHI}, 2 * h)) / (1 - {_GPHI * _GPHI})) AS sigma FROM steps)""",
    f"""SELECT series_id, {iso('week_start')}, {r6('log_hat')}, {interval_of('log_hat', 'sigma')}, {epi_week('week_start')} AS week
    FROM ahead""")


def density(y: str, mean: float, var: float) -> str:
    return f"(-0.5 * (ln(2 * pi() * {var}) + ({y} - {mean}) * ({y} - {mean}) / {var}))"


(_S0, _S1), ((_T00, _T01), (_T10, _T11)) = HMM["startprob"], HMM["transmat"]
HMM_SQL = f"""{FACTS}, {TARGET},
    obs AS (SELECT series_id, i, week_start, {density('y', 7.0, 6.0)} AS b0, {density('y', 11.0, 9.0)} AS b1 FROM target),
    vit AS (SELECT series_id, i, ln({_S0}) + b0 AS v0, ln({_S1}) + b1 AS v1, 0 AS f0, 0 AS f1 FROM obs WHERE i = 1
        UNION ALL SELECT o.series_id, o.i,
            greatest(v.v0 + ln({_T00}), v.v1 + ln({_T10})) + o.b0, greatest(v.v0 + ln({_T01}), v.v1 + ln({_T11})) + o.b1,
            CASE WHEN v.v1 + ln({_T10}) > v.v0 + ln({_T00}) THEN 1 ELSE 0 END,
            CASE WHEN v.v1 + ln({_T11}) > v.v0 + ln({_T01}) THEN 1 ELSE 0 END
        FROM vit v JOIN obs o ON o.series_id = v.series_id AND o.i = v.i + 1),
    n AS (SELECT max(i) AS n FROM obs),
    route AS (SELECT v.series_id, v.i, CASE WHEN v.v1 > v.v0 THEN 1 ELSE 0 END AS s, v.f0, v.f1 FROM vit v, n WHERE v.i = n.n
        UNION ALL SELECT v.series_id, v.i, CASE WHEN r.s = 1 THEN r.f1 ELSE r.f0 END, v.f0, v.f1
        FROM route r JOIN vit v ON v.series_id = r.series_id AND v.i = r.i - 1),
    fwd AS (SELECT series_id, i, {_S0} * exp(b0) / ({_S0} * exp(b0) + {_S1} * exp(b1)) AS a0 FROM obs WHERE i = 1
        UNION ALL SELECT o.series_id, o.i,
            (f.a0 * {_T00} + (1 - f.a0) * {_T10}) * exp(o.b0) / ((f.a0 * {_T00} + (1 - f.a0) * {_T10}) * exp(o.b0)
            + (f.a0 * {_T01} + (1 - f.a0) * {_T11}) * exp(o.b1))
        FROM fwd f JOIN obs o ON o.series_id = f.series_id AND o.i = f.i + 1),
    bwd AS (SELECT o.series_id, o.i, CAST(0.5 AS DOUBLE) AS c0 FROM obs o, n WHERE o.i = n.n
        UNION ALL SELECT q.series_id, q.i, ({_T00} * exp(o.b0) * w.c0 + {_T01} * exp(o.b1) * (1 - w.c0))
            / ({_T00} * exp(o.b0) * w.c0 + {_T01} * exp(o.b1) * (1 - w.c0)
            + {_T10} * exp(o.b0) * w.c0 + {_T11} * exp(o.b1) * (1 - w.c0))
        FROM bwd w JOIN obs o ON o.series_id = w.series_id AND o.i = w.i
        JOIN obs q ON q.series_id = w.series_id AND q.i = w.i - 1),
    decoded AS (SELECT o.series_id, o.week_start, r.s AS hmm_state,
        (1 - f.a0) * (1 - w.c0) / (f.a0 * w.c0 + (1 - f.a0) * (1 - w.c0)) AS season_prob
        FROM obs o JOIN route r ON r.series_id = o.series_id AND r.i = o.i
        JOIN fwd f ON f.series_id = o.series_id AND f.i = o.i JOIN bwd w ON w.series_id = o.series_id AND w.i = o.i)"""
sql("m2_m3_hmm_decode", HMM_SQL, f"""SELECT series_id, {iso('week_start')}, hmm_state, {r6('season_prob')},
    CASE WHEN hmm_state = 1 THEN 1 ELSE 0 END AS is_season FROM decoded""", recursive=True)
sql("d8_probability_line", HMM_SQL, f"""SELECT series_id, {iso('week_start')}, {r6('season_prob')},
    CAST(0.5 AS DOUBLE) AS threshold FROM decoded""", recursive=True)

sql("m4_hmm_seasons_given", f"""{HMM_SQL},
    flagged AS (SELECT t.*, d.hmm_state, d.season_prob, d.hmm_state AS is_season FROM target t
        JOIN decoded d ON d.series_id = t.series_id AND d.week_start = t.week_start), {short_ctes(4)}, {LABEL}""",
    f"""SELECT series_id, {iso('week_start')}, hmm_state, {r6('season_prob')}, is_season, season_label FROM labelled""",
    recursive=True)
LIKELIHOOD = f"""{HMM_SQL},
    parts AS (SELECT o.series_id, o.i, o.b0, o.b1, coalesce(lag(f.a0) OVER (PARTITION BY o.series_id ORDER BY o.i), -1) AS a0
        FROM obs o JOIN fwd f ON f.series_id = o.series_id AND f.i = o.i),
    total AS (SELECT series_id, count(*) AS n, sum(CASE WHEN a0 < 0 THEN ln({_S0} * exp(b0) + {_S1} * exp(b1))
        ELSE ln((a0 * {_T00} + (1 - a0) * {_T10}) * exp(b0) + (a0 * {_T01} + (1 - a0) * {_T11}) * exp(b1)) END) AS ll
        FROM parts GROUP BY ALL)"""
sql("m5_hmm_quality_given", LIKELIHOOD, f"""SELECT series_id, {r6('ll', 'log_likelihood')}, {r6('-2 * ll + 12', 'aic')},
    {r6('-2 * ll + 6 * ln(n)', 'bic')}, {r6('7.0', 'state_means_0')}, {r6('11.0', 'state_means_1')},
    {r6('6.0', 'state_covariances_0')}, {r6('9.0', 'state_covariances_1')}, {r6(str(_T00), 'move_00')}, {r6(str(_T01), 'move_01')},
    {r6(str(_T10), 'move_10')}, {r6(str(_T11), 'move_11')} FROM total""", recursive=True)


def r4(expr: str, name: str) -> str:
    return r6(f"round({expr}, 4)", name)


def aic(n: str, sigma2: str, free: int) -> str:
    return f"{n} * ln(2 * pi() * {sigma2}) + {n} + {2 * free}"


ONE_LAG = f"""{FACTS}, {TARGET},
    steps AS (SELECT *, lag(log_y) OVER ({W}) AS before, {in_session('week_start')} AS x FROM target),
    usable AS (SELECT * FROM steps WHERE part = 'train' AND before IS NOT NULL),
    phi AS (SELECT series_id, sum(log_y * before) / sum(before * before) AS phi, sum(log_y * x) / sum(x * x) AS beta0 FROM usable GROUP BY ALL),
    error AS (SELECT u.series_id, any_value(p.phi) AS phi, count(*) AS n, avg(pow(u.log_y - p.phi * u.before, 2)) AS lag_s2,
        avg(u.log_y * u.log_y) AS zero_s2, avg(pow(u.log_y - p.beta0 * u.x, 2)) AS reg_s2, any_value(p.beta0) AS beta
        FROM usable u JOIN phi p ON p.series_id = u.series_id GROUP BY u.series_id)"""
sql("m6_fit_one_lag", ONE_LAG, f"""SELECT series_id, {r4('phi', 'ar')}, {r4('lag_s2', 'sigma2')},
    {r4(aic('n', 'lag_s2', 2), 'aic')}, n AS nobs FROM error""")
sql("m9_order_one_lag", ONE_LAG, f"""SELECT series_id, CASE WHEN {aic('n', 'lag_s2', 2)} < {aic('n', 'zero_s2', 1)} THEN 1 ELSE 0 END AS p,
    {r4(f"least({aic('n', 'lag_s2', 2)}, {aic('n', 'zero_s2', 1)})", 'aic')} FROM error""")
sql("m9_order_short_series", ONE_LAG, f"""SELECT series_id, CASE WHEN {aic('n', 'lag_s2', 2)} < {aic('n', 'zero_s2', 1)} THEN 1 ELSE 0 END AS p,
    {r4(f"least({aic('n', 'lag_s2', 2)}, {aic('n', 'zero_s2', 1)})", 'aic')} FROM error""")
sql("m10_t6_search_closed_form", f"""{ONE_LAG},
    origin AS (SELECT series_id, arg_max(log_y, week_start) AS y0 FROM target WHERE part = 'train' GROUP BY ALL),
    ahead AS (SELECT t.series_id, exp(t.log_y) - 1 AS y, row_number() OVER ({W}) AS h, {in_session('t.week_start')} AS x
        FROM target t WHERE part = 'test'),
    candidates AS (
        SELECT a.series_id, 'lag' AS features, a.y, exp(pow(e.phi, a.h) * o.y0) - 1 AS y_hat, {aic('e.n', 'e.lag_s2', 2)} AS aic
        FROM ahead a JOIN error e ON e.series_id = a.series_id JOIN origin o ON o.series_id = a.series_id
        UNION ALL SELECT a.series_id, 'regressor', a.y, exp(e.beta * a.x) - 1, {aic('e.n', 'e.reg_s2', 2)}
        FROM ahead a JOIN error e ON e.series_id = a.series_id),
    scored AS (SELECT series_id, features, any_value(aic) AS aic, avg(abs(y - y_hat)) AS mae, sqrt(avg(pow(y - y_hat, 2))) AS rmse
        FROM candidates GROUP BY ALL)""",
    f"""SELECT series_id, features, CAST(row_number() OVER (PARTITION BY series_id ORDER BY aic, features) AS INTEGER) AS rank,
    {r4('aic', 'aic')}, {r4('mae', 'mae')}, {r4('rmse', 'rmse')} FROM scored""")
sql("m12_m13_next_season_given", f"""{FACTS}, {TARGET}, {origin('TRUE')}, {path(35)}, {FUTURE},
    ahead AS (SELECT f.series_id, f.week_start, p.u + {B1} * ({in_session('f.week_start')}) AS log_hat FROM future f
        JOIN path p ON p.series_id = f.series_id AND p.step = f.step),
    stand_in AS (SELECT series_id, week_start, log_hat, {floor0('exp(log_hat) - 1')} AS y_hat FROM ahead), {PEAK}""",
    f"""SELECT p.series_id, {iso('p.first_week', 'first_week')}, {iso('p.last_week', 'last_week')}, {r6('p.total', 'total')},
    {r6('p.peak_value', 'peak_value')}, {iso('p.peak_date', 'peak_date')},
    {r6(floor0(f"exp(s.log_hat - {1.959963984540054 * AR1['sigma2'] ** 0.5}) - 1"), 'peak_lower')},
    {r6(floor0(f"exp(s.log_hat + {1.959963984540054 * AR1['sigma2'] ** 0.5}) - 1"), 'peak_upper')}
    FROM peaks p JOIN stand_in s ON s.series_id = p.series_id AND s.week_start = p.peak_date""", recursive=True)

# Two states that do not overlap: the fit ends at their moments (with the variance prior) and at counted moves.
WINTER = f"""{FACTS}, {TARGET},
    planted AS (SELECT * REPLACE (y + 1000 * winter AS y), winter AS is_season FROM (
        SELECT *, CASE WHEN month(week_start) IN (11, 12, 1, 2, 3) THEN 1 ELSE 0 END AS winter FROM target))"""
PLANTED = f"""{WINTER},
    steps AS (SELECT *, lag(winter) OVER ({W}) AS before FROM planted),
    state AS (SELECT series_id, winter AS s, avg(y) AS mu, (0.01 + count(*) * var_pop(y)) / count(*) AS v FROM planted GROUP BY ALL),
    moves AS (SELECT series_id, before AS s, avg(winter) AS up FROM steps WHERE before IS NOT NULL GROUP BY ALL),
    scored AS (SELECT t.series_id, count(*) AS n, sum(-0.5 * (ln(2 * pi() * v) + (y - mu) * (y - mu) / v)
            + CASE WHEN before IS NULL THEN 0 ELSE ln(CASE WHEN winter = 1 THEN m.up ELSE 1 - m.up END) END) AS ll,
            arg_min(winter, week_start) AS first
        FROM steps t JOIN state s ON s.series_id = t.series_id AND s.s = winter
        LEFT JOIN moves m ON m.series_id = t.series_id AND m.s = before GROUP BY ALL),
    fitted AS (SELECT c.*, a.mu AS mu0, b.mu AS mu1, a.v AS v0, b.v AS v1, p.up AS up0, q.up AS up1 FROM scored c
        JOIN state a ON a.series_id = c.series_id AND a.s = 0 JOIN state b ON b.series_id = c.series_id AND b.s = 1
        JOIN moves p ON p.series_id = c.series_id AND p.s = 0 JOIN moves q ON q.series_id = c.series_id AND q.s = 1)"""
_FLAT = f"""{r6('ll', 'log_likelihood')}, {r6('mu0', 'state_means_0')}, {r6('mu1', 'state_means_1')},
    {r6('v0', 'state_covariances_0')}, {r6('v1', 'state_covariances_1')}, {r6('1 - up0', 'move_00')}, {r6('up0', 'move_01')},
    {r6('1 - up1', 'move_10')}, {r6('up1', 'move_11')}"""
sql("m1_hmm_fit_planted", PLANTED, f"""SELECT series_id, CAST(1 - first AS DOUBLE) AS start_0, CAST(first AS DOUBLE) AS start_1,
    TRUE AS converged, 1 AS season_state, {_FLAT} FROM fitted""")
sql("m5_hmm_quality_planted", PLANTED, f"""SELECT series_id, {r6('12 - 2 * ll', 'aic')}, {r6('6 * ln(n) - 2 * ll', 'bic')}, {_FLAT}
    FROM fitted""")
sql("m4_hmm_seasons_planted", f"{WINTER}, {short_ctes(4).replace('FROM flagged', 'FROM planted')}, {LABEL}",
    f"""SELECT series_id, {iso('week_start')}, winter AS hmm_state, CAST(winter AS DOUBLE) AS season_prob, is_season, season_label
    FROM labelled""", recursive=True)

# Two lags, and two regressors: normal equations of two unknowns.
NORMAL = """
    sums AS (SELECT series_id, count(*) AS n, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * z) AS az, sum(b * z) AS bz
        FROM usable GROUP BY ALL),
    solved AS (SELECT *, (az * bb - bz * ab) / (aa * bb - ab * ab) AS c1, (bz * aa - az * ab) / (aa * bb - ab * ab) AS c2 FROM sums),
    error AS (SELECT u.series_id, any_value(c1) AS c1, any_value(c2) AS c2, count(*) AS n, avg(pow(z - c1 * a - c2 * b, 2)) AS s2
        FROM usable u JOIN solved s ON s.series_id = u.series_id GROUP BY u.series_id)"""
for _name, _column, _a, _b in (
    ("m6_fit_two_lags", "ar", f"lag(log_y, 1) OVER ({W})", f"lag(log_y, 2) OVER ({W})"),
    ("m6_fit_two_regressors", "beta", f"CAST({in_session('week_start')} AS DOUBLE)", since_school("week_start")),
):
    sql(_name, f"""{FACTS}, {TARGET},
    terms AS (SELECT series_id, part, log_y AS z, {_a} AS a, {_b} AS b FROM target),
    usable AS (SELECT * FROM terms WHERE part = 'train' AND a IS NOT NULL AND b IS NOT NULL), {NORMAL}""",
    f"""SELECT series_id, {r4('c1', f'{_column}_1')}, {r4('c2', f'{_column}_2')}, {r4('s2', 'sigma2')},
    {r4(aic('n', 's2', 3), 'aic')}, n AS nobs FROM error""")
sql("s7_m6_bucketed_suppliers", ONE_LAG.replace(FACTS, SUPPLIER_FACTS), f"""SELECT series_id,
    {r6('round(phi, 3)', 'ar')}, {r6('round(lag_s2, 3)', 'sigma2')}, n AS nobs FROM error""")

# -- diagnostic tables ----------------------------------------------------------------------------

sql("d1_forecast_frame", BASE, f"""SELECT t.series_id, {iso('t.week_start', 'week_start')}, t.part, {r6('t.y', 'actual')},
    {r6('w.weekly_mean', 'y_hat')}, {r6('w.weekly_mean * 0.8', 'ci_lower')}, {r6('w.weekly_mean * 1.2', 'ci_upper')}
    FROM target t LEFT JOIN wide w ON w.series_id = t.series_id AND w.week_start = t.week_start""")
sql("d2_actual_vs_predicted", PRED, f"""SELECT series_id, model, {iso('week_start')}, {r6('y')}, {r6('y_hat')},
    {r6('max(greatest(y, y_hat)) OVER (PARTITION BY series_id, model)', 'axis_max')} FROM pred""")
sql("d3_model_lines", PRED, f"""SELECT series_id, model, {iso('week_start')}, {r6('y_hat', 'value')} FROM pred
    UNION ALL SELECT series_id, 'Actual', {iso('week_start')}, {r6('y', 'value')} FROM wide""")
RESID = f"""{PRED},
    resid AS (SELECT series_id, model, week_start, y - y_hat AS residual FROM scorable)"""
sql("d4_residuals", RESID, f"SELECT series_id, model, {iso('week_start')}, {r6('residual')} FROM resid")
sql("d4_residual_histogram", f"""{RESID},
    edges AS (SELECT series_id, model, min(residual) AS lo, max(residual) AS hi FROM resid GROUP BY ALL),
    placed AS (SELECT r.series_id, r.model,
        CAST(least(floor(round((residual - lo) / (hi - lo) * 30, 9)), 29) + 1 AS INTEGER) AS bin
        FROM resid r JOIN edges e ON e.series_id = r.series_id AND e.model = r.model),
    counts AS (SELECT series_id, model, bin, count(*) AS n FROM placed GROUP BY ALL),
    bins AS (SELECT CAST(unnest(generate_series(1, 30)) AS INTEGER) AS bin)""",
    f"""SELECT e.series_id, e.model, b.bin, {r6('lo + (hi - lo) / 30 * (b.bin - 1)', 'left_edge')},
    coalesce(c.n, 0) AS n FROM edges e CROSS JOIN bins b
    LEFT JOIN counts c ON c.series_id = e.series_id AND c.model = e.model AND c.bin = b.bin""")
ACF = f"""{RESID},
    centred AS (SELECT series_id, model, row_number() OVER (PARTITION BY series_id, model ORDER BY week_start) AS i,
        residual - avg(residual) OVER (PARTITION BY series_id, model) AS x FROM resid),
    total AS (SELECT series_id, model, sum(x * x) AS s, count(*) AS n FROM centred GROUP BY ALL),
    lags AS (SELECT CAST(unnest(generate_series(0, 40)) AS INTEGER) AS lag),
    acf AS (SELECT a.series_id, a.model, l.lag, sum(a.x * b.x) / any_value(t.s) AS acf, any_value(t.n) AS n
        FROM lags l CROSS JOIN centred a
        JOIN centred b ON b.series_id = a.series_id AND b.model = a.model AND b.i = a.i + l.lag
        JOIN total t ON t.series_id = a.series_id AND t.model = a.model GROUP BY a.series_id, a.model, l.lag)"""
sql("d5_autocorrelation", ACF, f"""SELECT series_id, model, lag, {r6('acf')},
    {r6('''1.959963984540054 * CASE WHEN lag = 0 THEN 0 ELSE sqrt((1 + 2 * coalesce(sum(CASE WHEN lag >= 1 THEN acf * acf END)
    OVER (PARTITION BY series_id, model ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END''',
    'half_width')} FROM acf""")
sql("d6_partial_autocorrelation", f"""{ACF},
    listed AS (SELECT series_id, model, any_value(n) AS n, list(acf ORDER BY lag) AS r FROM acf GROUP BY ALL),
    dl AS (SELECT series_id, model, n, r, 0 AS k, CAST([] AS DOUBLE[]) AS phi, CAST(1.0 AS DOUBLE) AS v,
            CAST(1.0 AS DOUBLE) AS pacf FROM listed
        UNION ALL SELECT series_id, model, n, r, k + 1,
            list_append(list_transform(generate_series(1, k), lambda j: phi[j] - p * phi[k + 1 - j]), p), v * (1 - p * p), p
        FROM (SELECT *, (r[k + 2] - coalesce(list_sum(list_transform(generate_series(1, k), lambda j: phi[j] * r[k + 2 - j])), 0)) / v AS p
            FROM dl WHERE k < 40))""",
    f"""SELECT series_id, model, CAST(k AS INTEGER) AS lag, {r6('pacf')},
    {r6('CASE WHEN k = 0 THEN 0 ELSE 1.959963984540054 / sqrt(n) END', 'half_width')} FROM dl""", recursive=True)
sql("d7_season_panels", f"{LABELLED}, {WEATHER}", f"""SELECT l.series_id, l.season_label, {iso('l.week_start', 'week_start')},
    {r6('l.y', 'y')}, {r6('w.tmean_c', 'tmean_c')} FROM labelled l JOIN weather w ON w.week_start = l.week_start
    WHERE l.season_label IS NOT NULL""", recursive=True)
sql("d8_season_spans", STATS, f"""SELECT series_id, season_label, {iso('onset_date', 'start_date')}, {iso('end_date')},
    {iso('peak_date')}, {r6('peak_ili', 'peak_value')},
    season_label || ' W' || onset_week || '-W' || end_week || ' peak W' || peak_week AS annotation FROM season_stats""",
    recursive=True)
sql("d9_next_season_frame", f"""{BASE}, {STAND_IN},
    line AS (SELECT series_id, week_start, 'history' AS kind, y AS value, NULL AS ci_lower, NULL AS ci_upper
        FROM target WHERE part = 'train'
        UNION ALL SELECT series_id, week_start, 'forecast', y_hat, ci_lower, ci_upper FROM stand_in),
    capped AS (SELECT *, max(value) OVER (PARTITION BY series_id) * 1.3 AS y_cap,
        max(CASE WHEN kind = 'history' THEN week_start END) OVER (PARTITION BY series_id) AS last FROM line)""",
    f"""SELECT series_id, {iso('week_start')}, kind, {r6('value')}, {r6('ci_lower')},
    {r6('CASE WHEN ci_upper IS NOT NULL THEN least(ci_upper, y_cap) END', 'ci_upper')}, {r6('y_cap')},
    week_start >= last - 420 AS recent FROM capped""")
sql("d9_peak_aligned", f"""{RECENT4},
    means AS (SELECT series_id, week, avg(y) AS y_hat FROM target WHERE part = 'train' GROUP BY ALL),
    ahead AS (SELECT t.series_id, m.y_hat, row_number() OVER (PARTITION BY t.series_id ORDER BY t.week_start) AS n
        FROM target t LEFT JOIN means m ON m.series_id = t.series_id AND m.week = t.week WHERE t.part = 'test'),
    top AS (SELECT *, max(y_hat) OVER (PARTITION BY series_id) AS top FROM ahead)""",
    f"""SELECT series_id, CAST(season_label AS VARCHAR) AS season, week_index, {r6('y', 'value')} FROM aligned
    UNION ALL SELECT series_id, 'next', CAST(n - min(CASE WHEN y_hat = top THEN n END) OVER (PARTITION BY series_id) AS INTEGER),
    {r6('y_hat', 'value')} FROM top""", recursive=True)

# -- plans and streaming --------------------------------------------------------------------------

sql("feature_matrix", MATRIX, f"""SELECT {iso('week_start')}, series_id, {r6('y')}, year, week, {r6('log_y')},
    {r6('LOW_ILI_CASE')}, {r6('LOW_ILI_LAG1')}, {r6('LOW_delta_1w')}, {r6('tmean_c')}, {r6('tmean_lag1')}, {r6('tmean_lag2')},
    {covid('week_start')} AS is_covid, {post_covid('week_start')} AS post_covid, {in_session('week_start')} AS school_in_session,
    {r6(since_school('week_start'), 'weeks_since_school')} FROM matrix""")
HSIGMA = HOURLY_AR["sigma2"] ** 0.5
_reach = max(poly(HOURLY_AR["ar"], HOURLY_AR["sar"], 24, 0))
HOURLY = """
    counts AS (SELECT event_type AS series_id, datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS tick,
        count(*) AS n FROM events GROUP BY ALL),
    disturbance AS (SELECT k.series_id, g.tick, ln(1 + coalesce(c.n, 0)) AS log_y, ln(1 + coalesce(c.n, 0)) AS u
        FROM (SELECT DISTINCT event_type AS series_id FROM events) k
        CROSS JOIN (SELECT unnest(generate_series(0, (SELECT max(tick) FROM counts))) AS tick) g
        LEFT JOIN counts c ON c.series_id = k.series_id AND c.tick = g.tick)"""
sql("st1_stream_walk_forward", f"""{HOURLY},
    ahead AS ({walk(HOURLY_AR, 'tick', '0.0')}),
    known AS (SELECT series_id, tick, log_y, CASE WHEN tick >= {_reach} THEN log_hat END AS log_hat FROM ahead)""",
    f"""SELECT series_id, tick, {r6('log_y')}, {r6('log_hat')}, {r6(repr(HSIGMA), 'sigma')},
    {interval_columns('log_hat', HSIGMA)}, 'scored' AS status FROM known""")
# A tick given up moves the state to its forecast, so over a gap the last known value decays by the lag coefficient.
_HPHI = HOURLY_AR1["ar"][0]
sql("st1_stream_lost_and_late", f"""{HOURLY},
    kinds AS (SELECT *, CASE WHEN tick <= max(tick) OVER (PARTITION BY series_id) - 40 AND tick % 97 IN (10, 50)
        THEN tick % 97 END AS away FROM disturbance),
    back AS (SELECT *, last_value(CASE WHEN away IS NULL THEN u END IGNORE NULLS) OVER earlier AS last_u,
        tick - last_value(CASE WHEN away IS NULL THEN tick END IGNORE NULLS) OVER earlier AS h FROM kinds
        WINDOW earlier AS (PARTITION BY series_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    told AS (
        SELECT series_id, tick, log_y, pow({_HPHI}, h) * last_u AS log_hat, {HSIGMA} AS sigma, 'scored' AS status FROM back WHERE away IS NULL
        UNION ALL SELECT series_id, tick, NULL, NULL, {HSIGMA}, 'missing' FROM back WHERE away IS NOT NULL
        UNION ALL SELECT series_id, tick, log_y, NULL, NULL, 'late' FROM back WHERE away = 10)""",
    f"""SELECT series_id, tick, {r6('log_y')}, {r6('log_hat')}, {r6('sigma')}, {interval_of('log_hat', 'sigma')}, status FROM told""")
