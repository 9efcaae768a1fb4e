"""The SQL (DuckDB dialect) that the registered queries must equal.

Written from the definitions, not from the Spark code: common table
expressions for the panel and what is derived from it, then one SELECT per
query.  Queries whose result depends on 200 fitted trees have none.
"""

from __future__ import annotations

LAGS = (1, 2, 3, 4, 5, 6, 7, 8, 52)
WINDOWS = (2, 4, 8, 12)


def r6(expression: str, name: str | None = None) -> str:
    near = f"round({expression}, 6)"
    return f"CASE WHEN {near} = 0 THEN 0.0 ELSE {near} END AS {name or expression}"


def text(expression: str, name: str | None = None) -> str:
    return f"({expression})::VARCHAR AS {name or expression}"


DAY = text("week_start")
MADE = "strftime(generated_at, '%Y-%m-%d %H:%M:%S') AS generated_at"
BASE = f"series, {DAY}, week, ilitotal, total_patients, " + r6("percent_ili")

PANEL = """
p AS (
  SELECT series, week_start,
         (year(week_start) * 100 + (dayofyear(week_start) - 1) // 7 + 1)::INT AS week,
         ilitotal, total_patients, 100 * ilitotal / total_patients AS percent_ili
  FROM (
    SELECT n_name || '-' || c_mktsegment AS series,
           o_orderdate::DATE - dayofweek(o_orderdate)::INT AS week_start,
           (count(*) FILTER (WHERE o_orderpriority = '1-URGENT'))::DOUBLE AS ilitotal,
           count(*)::DOUBLE AS total_patients
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2
  )
)"""

# Some weeks lack a value.
GAPPY = PANEL.replace("p AS (", "p0 AS (", 1) + """,
p AS (
  SELECT * EXCLUDE (rr)
         REPLACE (CASE WHEN week % 20 <> 0 AND NOT (series LIKE '%-AUTOMOBILE' AND rr = 2) THEN ilitotal END AS ilitotal)
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_start DESC) AS rr FROM p0)
)"""

LAG_SQL = [f"lag(ilitotal, {k}) OVER w AS lag_{k}" for k in LAGS]
TREND_SQL = "lag(ilitotal, 1) OVER w - lag(ilitotal, 5) OVER w AS trend_4w"
ROLL_SQL = [
    f"CASE WHEN count(ilitotal) OVER (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) = {k} "
    f"THEN {fn}(ilitotal) OVER (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING) END AS roll_{name}_{k}"
    for k in WINDOWS
    for name, fn in (("mean", "avg"), ("std", "stddev_samp"))
]
ROLL_NAMES = [f"roll_{name}_{k}" for k in WINDOWS for name in ("mean", "std")]
LAG_NAMES = [f"lag_{k}" for k in LAGS]
FEATURES = [*LAG_NAMES[:8], *ROLL_NAMES, "week_sin", "week_cos", "lag_52", "trend_4w"]
SEASON_SQL = "sin(2 * pi() * week / 52) AS week_sin, cos(2 * pi() * week / 52) AS week_cos"

WINDOW = "WINDOW w AS (PARTITION BY series ORDER BY week_start)"


def features(panel: str, window: str) -> str:
    complete = " AND ".join(
        f"{c} IS NOT NULL" for c in ["week", "ilitotal", "total_patients", "percent_ili", *FEATURES]
    )
    return f"""
f AS (
  SELECT * FROM (
    SELECT *, {", ".join([*LAG_SQL, *ROLL_SQL])}, {TREND_SQL}, {SEASON_SQL}
    FROM {panel} {window}
  ) WHERE {complete}
)"""


FRAME = features("p", WINDOW)
FRAME_OUT = ", ".join([BASE, *[r6(c) for c in FEATURES]])

# The newest 53 rows of a series folded into one; r = 1 is the newest.
RANKED = """
n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_start DESC) AS r FROM p)"""


def point(mode: str, strict: bool = False) -> str:
    made = [f"max(ilitotal) FILTER (WHERE r = {k}) AS lag_{k}" for k in LAGS]
    for k in WINDOWS:
        inside = f"FILTER (WHERE r BETWEEN {2 if mode == 'parity' else 1} AND {k + (mode == 'parity')})"
        made.append(
            f"CASE WHEN count(ilitotal) {inside} = {k} THEN avg(ilitotal) {inside} END AS roll_mean_{k}"
        )
        if mode == "parity":
            made.append(
                f"CASE WHEN count(*) {inside} < 2 THEN 0.0 WHEN count(*) {inside} = count(ilitotal) {inside} "
                f"THEN stddev_pop(ilitotal) {inside} END AS roll_std_{k}"
            )
        else:
            made.append(
                f"CASE WHEN count(ilitotal) {inside} = {k} THEN stddev_samp(ilitotal) {inside} END AS roll_std_{k}"
            )
    made.append(
        "max(ilitotal) FILTER (WHERE r = 1) - max(ilitotal) FILTER (WHERE r = 5) AS trend_4w"
    )
    if strict:
        # No 53-week year ends in the data, so the last week of a year is 52.
        following = "CASE WHEN last_week % 100 >= 52 THEN 1 ELSE last_week % 100 + 1 END"
    else:
        following = "CASE WHEN last_week >= 52 THEN 1 ELSE last_week + 1 END"
    return f"""
c AS (
  SELECT *, sin(2 * pi() * next_week / 52) AS week_sin, cos(2 * pi() * next_week / 52) AS week_cos
  FROM (
    SELECT *, {following} AS next_week
    FROM (
      SELECT series, max(week_start) + 7 AS week_start, max(week) FILTER (WHERE r = 1) AS last_week,
             {", ".join(made)}
      FROM n WHERE r <= 53 GROUP BY series
    )
  )
)"""


POINT_OUT = f"series, {DAY}, " + ", ".join(r6(c) for c in FEATURES)

SPLIT = """
d AS (
  SELECT *, CASE WHEN 5 * row_number() OVER (PARTITION BY series ORDER BY week_start)
                      <= 4 * count(*) OVER (PARTITION BY series)
                 THEN 'train' ELSE 'validation' END AS split
  FROM f
)"""

# Residuals of the four-week mean over the newest 30 complete rows.
SPANS = """
s AS (
  SELECT series, quantile_cont(ilitotal - roll_mean_4, 0.025) AS lo,
         quantile_cont(ilitotal - roll_mean_4, 0.975) AS hi
  FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week_start DESC) AS rr FROM f)
  WHERE rr <= 30 GROUP BY series
)"""


def bounded(points: str) -> str:
    return f"""
  SELECT series, week_start, predicted_ili,
         CASE WHEN lo IS NOT NULL THEN greatest(0.0, predicted_ili + lo) END AS ci_lower, predicted_ili + hi AS ci_upper,
         CASE WHEN lo IS NOT NULL
              THEN predicted_ili BETWEEN greatest(0.0, predicted_ili + lo) AND predicted_ili + hi END AS interval_ok
  FROM ({points}) LEFT JOIN s USING (series)"""


BASELINE = (
    f"{PANEL},{FRAME},{RANKED},{point('parity')},{SPANS}, b AS ("
    + bounded("SELECT series, week_start, roll_mean_4 AS predicted_ili FROM c")
    + ")"
)

LEDGER = """
q AS (
  SELECT *, max(week_start) OVER (PARTITION BY series) AS last_start
  FROM (
    SELECT series, week_start,
           count(ilitotal) OVER x AS k, avg(ilitotal) OVER x AS m, stddev_samp(ilitotal) OVER x AS sd
    FROM p WINDOW x AS (PARTITION BY series ORDER BY week_start ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)
  ) WHERE k = 4 AND series NOT LIKE '%-MACHINERY'
),
l AS (
  SELECT series, week_start, m AS predicted_ili, greatest(0.0, m - 2 * sd) AS ci_lower,
         m + 2 * sd AS ci_upper, (week_start - 1)::TIMESTAMP AS generated_at
  FROM q
  UNION ALL
  SELECT series, week_start + 7, m, CASE WHEN series LIKE '%-FURNITURE' THEN greatest(0.0, m - 2 * sd) END,
         m + 2 * sd, (week_start + 6)::TIMESTAMP
  FROM q WHERE week_start = last_start AND (series LIKE '%-FURNITURE' OR series LIKE '%-BUILDING')
  UNION ALL
  SELECT 'MOON', week_start, m, greatest(0.0, m - 2 * sd), m + 2 * sd, (week_start - 1)::TIMESTAMP
  FROM q WHERE series = 'NATION_1-HOUSEHOLD'
),
v AS (
  SELECT * EXCLUDE (g) FROM (
    SELECT *, row_number() OVER (PARTITION BY series ORDER BY generated_at DESC NULLS LAST) AS g FROM l
  ) WHERE g = 1 AND week_start IS NOT NULL AND predicted_ili IS NOT NULL
      AND ci_lower IS NOT NULL AND ci_upper IS NOT NULL
)"""


def lookup(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {source}.*, p.ilitotal AS actual_ili,
         CASE WHEN p.series IS NULL THEN 'pending' WHEN p.ilitotal IS NULL THEN 'null_actual'
              ELSE 'matched' END AS status
  FROM {source} LEFT JOIN p ON p.series = {source}.series AND p.week_start = {source}.week_start
)"""


def accuracy(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT *, abs(predicted_ili - actual_ili) AS abs_deviation,
         CASE WHEN actual_ili <> 0 THEN abs(predicted_ili - actual_ili) / actual_ili * 100 END AS deviation_pct,
         actual_ili >= ci_lower AND actual_ili <= ci_upper AS in_interval,
         CASE WHEN predicted_ili > actual_ili THEN 'over-predicted' ELSE 'under-predicted' END AS direction,
         CASE WHEN actual_ili = 0 THEN 'undefined' ELSE 'ok' END AS accuracy
  FROM {source} WHERE status = 'matched'
)"""


def residual_spans(frame: str, fitted: str) -> str:
    """Quantiles of the fit's errors over the newest 30 rows of each series."""
    return f"""
s AS (
  SELECT series, quantile_cont(ilitotal - fitted, 0.025) AS lo, quantile_cont(ilitotal - fitted, 0.975) AS hi
  FROM (SELECT *, {fitted} AS fitted, row_number() OVER (PARTITION BY series ORDER BY week_start DESC) AS rr
        FROM {frame})
  WHERE rr <= 30 GROUP BY series
)"""


def forecast(points: str) -> str:
    """``points``: series, week_start, n (rows of the series), value, missing (a feature)."""
    usable = "n > 52 AND lo IS NOT NULL AND value IS NOT NULL"
    low = "greatest(0.0, greatest(0.0, value) + lo)"
    return f"""
z AS (
  SELECT series, week_start,
         CASE WHEN {usable} THEN greatest(0.0, value) END AS predicted_ili,
         CASE WHEN {usable} THEN {low} END AS ci_lower,
         CASE WHEN {usable} THEN greatest(0.0, value) + hi END AS ci_upper,
         CASE WHEN {usable} THEN greatest(0.0, value) BETWEEN {low} AND greatest(0.0, value) + hi END AS interval_ok,
         CASE WHEN NOT ({usable}) THEN 'insufficient_history' WHEN missing THEN 'missing_feature' ELSE 'ok' END AS status
  FROM ({points}) LEFT JOIN s USING (series)
)"""


COUNTED = "SELECT series, max(week_start) AS last_start, count(*) AS n FROM p GROUP BY series"
LACKING = " OR ".join(f"{c} IS NULL" for c in FEATURES)


def mean_forecast(frame: str, due: str = "true") -> str:
    """The mean of all training rows as the forecast of every series."""
    return f"""
mu AS (SELECT avg(ilitotal) AS mean FROM {frame}),
{residual_spans(frame, "(SELECT mean FROM mu)")},
{forecast(f"""
  SELECT series, last_start + 7 AS week_start, n, (SELECT mean FROM mu) AS value, false AS missing
  FROM ({COUNTED}) WHERE {due}""")}"""


def gappy_forecast(strict: bool) -> str:
    value = f"CASE WHEN NOT ({LACKING}) THEN (SELECT mean FROM mu) END" if strict else "(SELECT mean FROM mu)"
    return f"""WITH {GAPPY},{FRAME},{RANKED},{point('parity')},
mu AS (SELECT avg(ilitotal) AS mean FROM f),
{residual_spans('f', '(SELECT mean FROM mu)')},
{forecast(f"SELECT c.series, c.week_start, t.n, {value} AS value, ({LACKING}) AS missing FROM c JOIN ({COUNTED}) t USING (series)")}
SELECT {FORECAST_OUT}, interval_ok, status FROM z"""


STUMP_FEATURES = ", ".join(LAG_NAMES)
STUMP_NAMES = ", ".join(f"'{name}'" for name in LAG_NAMES)


def stump(name: str, frame: str, y: str) -> str:
    """The cut with the least squared error: both sides hold 30 rows or more."""
    return f"""
{name} AS (
  SELECT place, threshold, ls / ln AS low, (ts - ls) / (tn - ln) AS high
  FROM (
    SELECT place, (x + lead(x) OVER o) / 2 AS threshold, sum(s) OVER o AS ls, sum(n) OVER o AS ln,
           sum(s) OVER (PARTITION BY place) AS ts, sum(n) OVER (PARTITION BY place) AS tn
    FROM (
      SELECT place, x, sum(y) AS s, count(*) AS n
      FROM (SELECT unnest(range(1, {len(LAG_NAMES) + 1})) AS place, unnest([{STUMP_FEATURES}]) AS x, {y} AS y FROM {frame})
      GROUP BY place, x
    )
    WINDOW o AS (PARTITION BY place ORDER BY x)
  )
  WHERE threshold IS NOT NULL AND ln >= 30 AND tn - ln >= 30
  ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, place, threshold LIMIT 1
)"""


def leaf(name: str) -> str:
    side = f"[{STUMP_FEATURES}][(SELECT place FROM {name})] <= (SELECT threshold FROM {name})"
    return f"(CASE WHEN {side} THEN (SELECT low FROM {name}) ELSE (SELECT high FROM {name}) END)"


def stumps(frame: str) -> str:
    """Two trees: the second is fitted to what the first leaves."""
    return stump("t1", frame, "ilitotal") + "," + stump("t2", frame, f"ilitotal - {leaf('t1')}")


STUMPED = f"({leaf('t1')} + 0.05 * {leaf('t2')})"


# Bins, residuals in whole units and best-first trees.
UNIT = "1048576.0"
PLACES = range(1, len(LAG_NAMES) + 1)
SHARES = "[" + ", ".join(f"{k}.0 / 16" for k in range(1, 16)) + "]"


def units(expression: str) -> str:
    return f"floor(({expression}) * {UNIT} + 0.5)::BIGINT"


def binned(name: str, frame: str, by: str = "") -> str:
    """``frame`` with ``bins``: of every feature the number of edges below it,
    where edges are the distinct values at sixteenths of the training rows."""
    keys = f"{by}, " if by else ""
    cut = ", ".join(f"list_sort(list_distinct(quantile_disc({c}, {SHARES}))) AS e{i}" for i, c in zip(PLACES, LAG_NAMES))
    place = ", ".join(f"len(list_filter(e{i}, lambda x: x < {c}))" for i, c in zip(PLACES, LAG_NAMES))
    edges = f"{name}e AS (SELECT {keys}{cut} FROM f {f'GROUP BY {by}' if by else ''})"
    joined = f"JOIN {name}e USING ({by})" if by else f"CROSS JOIN {name}e"
    return f"""
{edges},
{name} AS (SELECT * EXCLUDE ({", ".join(f"e{i}" for i in PLACES)}), [{place}] AS bins FROM {frame} {joined})"""


def edge(name: str) -> str:
    return f"[{', '.join(f'e{i}' for i in PLACES)}][place][bin + 1]"


def best_cut(name: str, rows: str, least: int, by: str = "") -> str:
    """The cut with the highest gain among ``rows`` with ``bins`` and ``r``; of each ``by``."""
    keys, part = (f"{by}, ", f"{by}, ") if by else ("", "")
    return f"""
{name} AS (
  SELECT *, moved * moved / ln * tn / (tn - ln) AS gain FROM (
    SELECT *, ls::DOUBLE - ts::DOUBLE * ln / tn AS moved FROM (
      SELECT {keys}place, bin, sum(n) OVER o AS ln, sum(s) OVER o AS ls,
             sum(n) OVER (PARTITION BY {part}place) AS tn, sum(s) OVER (PARTITION BY {part}place) AS ts
      FROM (
        SELECT {keys}place, bin, sum(r) AS s, count(*) AS n
        FROM (SELECT {keys}unnest(range(1, {len(LAG_NAMES) + 1})) AS place, unnest(bins) AS bin, r FROM {rows})
        GROUP BY {keys}place, bin
      )
      WINDOW o AS (PARTITION BY {part}place ORDER BY bin)
    )
  )
  WHERE ln >= {least} AND tn - ln >= {least} AND abs(moved) >= 1
  QUALIFY row_number() OVER ({f'PARTITION BY {by} ' if by else ''}ORDER BY gain DESC, place, bin) = 1
)"""


def value(total: str, rows: str) -> str:
    return f"0.05 * (({total})::DOUBLE / ({rows})) / {UNIT}"


def left_of(cut: str) -> str:
    return f"bins[(SELECT place FROM {cut})] <= (SELECT bin FROM {cut})"


def three_leaves(t: str, rows: str) -> str:
    """A tree: the first cut, the better of the cuts of its sides, and the nodes."""
    chosen = f"(SELECT node FROM {t}c)"
    return f"""{best_cut(f'{t}r', rows, 30)},{best_cut(f'{t}a', f"(SELECT * FROM {rows} WHERE {left_of(f'{t}r')})", 30)},
{best_cut(f'{t}b', f"(SELECT * FROM {rows} WHERE NOT {left_of(f'{t}r')})", 30)},
{t}c AS (
  SELECT CASE WHEN a IS NULL AND b IS NULL THEN 0 WHEN b IS NULL OR a >= b THEN 2 ELSE 3 END AS node
  FROM (SELECT (SELECT gain FROM {t}a) AS a, (SELECT gain FROM {t}b) AS b)
),
{t}s AS (SELECT * FROM {t}a WHERE {chosen} = 2 UNION ALL SELECT * FROM {t}b WHERE {chosen} = 3),
{t}n AS (
  SELECT 1 AS node, place, bin, NULL::DOUBLE AS value FROM {t}r
  UNION ALL SELECT 2, NULL, NULL, {value('ls', 'ln')} FROM {t}r WHERE {chosen} <> 2
  UNION ALL SELECT 3, NULL, NULL, {value('ts - ls', 'tn - ln')} FROM {t}r WHERE {chosen} <> 3
  UNION ALL SELECT {chosen}, place, bin, NULL FROM {t}s
  UNION ALL SELECT 2 * {chosen}, NULL, NULL, {value('ls', 'ln')} FROM {t}s
  UNION ALL SELECT 2 * {chosen} + 1, NULL, NULL, {value('ts - ls', 'tn - ln')} FROM {t}s
)"""


def leaf_value(t: str) -> str:
    """What a tree adds for a row with ``bins``."""
    side = f"(CASE WHEN {left_of(f'{t}r')} THEN 2 ELSE 3 END)"
    below = f"2 * {side} + CASE WHEN {left_of(f'{t}s')} THEN 0 ELSE 1 END"
    node = f"CASE WHEN {side} <> (SELECT node FROM {t}c) THEN {side} ELSE {below} END"
    return f"(SELECT value FROM {t}n WHERE node = {node})"


BASE_VALUE = f"(sum({units('ilitotal')}))::DOUBLE / count(*) / {UNIT}"
LEAFWISE = f"""{binned('b0', 'f')},
mean AS (SELECT {BASE_VALUE} AS base FROM f),
w1 AS (SELECT b0.*, base, {units('ilitotal - base')} AS r FROM b0, mean),{three_leaves('t1', 'w1')},
w2 AS (SELECT * REPLACE ({units(f"ilitotal - (base + {leaf_value('t1')})")} AS r) FROM w1),{three_leaves('t2', 'w2')}"""
LEAFWISE_VALUE = f"((SELECT base FROM mean) + {leaf_value('t1')} + {leaf_value('t2')})"

OWN_ADDS = f"CASE WHEN bins[place] <= bin THEN {value('ls', 'ln')} ELSE {value('ts - ls', 'tn - ln')} END"
PER_SERIES = f"""{binned('b0', 'f', 'series')},
mean AS (SELECT series, {BASE_VALUE} AS base FROM f GROUP BY series),
w1 AS (SELECT b0.*, base, {units('ilitotal - base')} AS r FROM b0 JOIN mean USING (series)),{best_cut('t1', 'w1', 10, 'series')},
w2 AS (
  SELECT * EXCLUDE (place, bin, ln, ls, tn, ts, moved, gain)
         REPLACE ({units(f"ilitotal - (base + {OWN_ADDS})")} AS r, base + {OWN_ADDS} AS base)
  FROM w1 JOIN t1 USING (series)
),{best_cut('t2', 'w2', 10, 'series')}"""


FORECAST_OUT = f"series, {DAY}, " + ", ".join(r6(c) for c in ("predicted_ili", "ci_lower", "ci_upper"))
LOOKED_OUT = f"{FORECAST_OUT}, {MADE}, actual_ili, status"
ACCURACY_OUT = f"{LOOKED_OUT}, {r6('abs_deviation')}, {r6('deviation_pct')}, in_interval, direction, accuracy"
ALL_ACCURACY = f"{LEDGER},{lookup('k', 'l')},{accuracy('a', 'k')}"
NEWEST_ACCURACY = f"{LEDGER},{lookup('k', 'v')},{accuracy('a', 'k')}"

GATE = """
g AS (
  SELECT series, CASE WHEN reason IN ('cold_start', 'matched') THEN 'retrain' ELSE 'skip' END AS action, reason
  FROM (
    SELECT coalesce(t.series, k.series) AS series,
           CASE WHEN t.series IS NULL THEN 'no_data' ELSE coalesce(k.status, 'cold_start') END AS reason
    FROM (SELECT DISTINCT series FROM p) t FULL JOIN k ON k.series = t.series
  )
)"""

EVENTS = """
e AS (
  SELECT event_id, event_type, value, json_extract(props, '$.k')::INT AS k,
         ts::DATE - dayofweek(ts)::INT AS sunday
  FROM events
),
y AS (
  SELECT *, year(first_day + 3) AS wy
  FROM (
    SELECT e.*, sunday + shift::INT AS first_day, factor
    FROM e CROSS JOIN (VALUES (0, 1), (7, 2)) AS t(shift, factor)
    WHERE event_type <> 'error' AND value >= 1
  )
),
x AS (
  SELECT event_id AS payload_id, event_type AS series, first_day,
         CASE WHEN event_type <> 'view' THEN strftime(first_day, '%Y-%m-%d') END AS week_start,
         (wy * 100 + (first_day - (make_date(wy, 1, 4) - dayofweek(make_date(wy, 1, 4))::INT)) // 7 + 1)::INT AS epiweek,
         CASE WHEN k > 95 THEN 'n/a' ELSE k::VARCHAR END AS num_ili,
         k * 20 * factor AS num_patients, value
  FROM y
)"""

FAULTY = """
bad AS (
  SELECT *, CASE WHEN week IS NULL THEN 'not an epiweek: null'
                 WHEN try_cast(week AS INT) IS NULL OR contains(week, '.') THEN 'not an epiweek: ' || week
                 WHEN week_start = '2024-02-30' THEN 'not a date: ' || week_start END AS error
  FROM (
    SELECT * REPLACE (CASE WHEN series = 'purchase' AND payload_id % 50 = 11 THEN '2024-02-30' ELSE week_start END AS week_start),
           CASE WHEN series = 'click' AND payload_id % 50 = 7 THEN NULL
                WHEN series = 'click' AND payload_id % 50 = 8 THEN epiweek || '.5'
                WHEN series = 'click' AND payload_id % 50 = 9 THEN 'week ' || epiweek
                ELSE epiweek::VARCHAR END AS week,
           epiweek // 100 - 1 AS py, make_date(epiweek // 100 - 1, 1, 1) AS prior
    FROM x
  )
)"""

ORDER_WEEKS = """
o AS (
  SELECT o_orderkey,
         (wy * 100 + (sunday - (make_date(wy, 1, 4) - dayofweek(make_date(wy, 1, 4))::INT)) // 7 + 1)::INT AS epiweek
  FROM (
    SELECT *, year(sunday + 3) AS wy
    FROM (SELECT o_orderkey, o_orderdate::DATE - dayofweek(o_orderdate)::INT AS sunday FROM orders)
  )
),
j AS (
  SELECT o_orderkey, epiweek, epiweek % 100 AS number,
         make_date(epiweek // 100, 1, 4) AS jan4, make_date(epiweek // 100 - 1, 1, 1) AS prior,
         epiweek // 100 - 1 AS py
  FROM o
)"""

MMWR = "jan4 - dayofweek(jan4)::INT + ((number - 1) * 7)::INT"
SHIFT = (
    "CASE WHEN dayofweek(prior) = 0 OR (dayofweek(prior) = 6 AND "
    "((py % 4 = 0 AND py % 100 <> 0) OR py % 400 = 0)) THEN 7 ELSE 0 END"
)

SOUND = f"""
SELECT payload_id, series, {text(f"first_day + CASE WHEN week_start IS NULL THEN {SHIFT} ELSE 0 END", 'week_start')},
       epiweek AS week, try_cast(num_ili AS DOUBLE) AS ilitotal,
       num_patients::DOUBLE AS total_patients, {r6('value', 'percent_ili')}
FROM bad"""

REGIONS = """
raw AS (
  SELECT c_custkey,
         CASE c_mktsegment WHEN 'BUILDING' THEN '  ' || n_name || chr(9)
                           WHEN 'MACHINERY' THEN 'N' || n_nationkey || ' '
                           WHEN 'FURNITURE' THEN 'No ' || n_name
                           ELSE n_name END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
names AS (
  SELECT lower(n_name) AS name, 'n' || n_nationkey AS code FROM nation
  UNION ALL SELECT 'n' || n_nationkey, 'n' || n_nationkey FROM nation
)"""

REPEATING = """
h AS (
  SELECT series, week_start,
         (wy * 100 + (week_start - (make_date(wy, 1, 4) - dayofweek(make_date(wy, 1, 4))::INT)) // 7 + 1)::INT AS week,
         ilitotal, ilitotal * 20 AS total_patients, 5.0::DOUBLE AS percent_ili
  FROM (
    SELECT r_name AS series, o_orderdate::DATE - dayofweek(o_orderdate)::INT AS week_start,
           year(o_orderdate::DATE - dayofweek(o_orderdate)::INT + 3) AS wy, count(*)::DOUBLE AS ilitotal
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3, o_orderpriority, c_mktsegment
  )
)"""
FULL_ORDER = "PARTITION BY series ORDER BY week_start, week, ilitotal, total_patients, percent_ili"

SUMMARY = """
SELECT series, (row_number() OVER (PARTITION BY series ORDER BY n) - 1)::INT AS line_no, line
FROM (
  SELECT b.series, unnest(range(14)) AS n, unnest([
    'Weekly Forecast Summary',
    'Generated: 2001-08-06 16:00:00 UTC',
    'State: ' || b.series,
    '',
    CASE WHEN a.series IS NOT NULL THEN 'Prior Prediction Comparison:' END,
    '  Week: ' || strftime(a.week_start, '%Y-%m-%d'),
    '  Predicted: ' || format('{:.0f}', a.predicted_ili),
    '  Actual:    ' || format('{:.0f}', a.actual_ili),
    CASE WHEN a.series IS NOT NULL
         THEN '  Deviation: ' || coalesce(format('{:.1f}', a.deviation_pct) || '%', 'undefined') END,
    CASE WHEN a.series IS NOT NULL THEN '' END,
    'Next Week Prediction:',
    '  Week Starting: ' || strftime(b.week_start, '%Y-%m-%d'),
    '  Predicted ILI: ' || format('{:.0f}', b.predicted_ili),
    '  95% PI: [' || format('{:.0f}', b.ci_lower) || ', ' || format('{:.0f}', b.ci_upper) || ']'
  ]) AS line
  FROM b LEFT JOIN a ON a.series = b.series
) WHERE line IS NOT NULL"""

CHART = f"""
SELECT series, layer, {DAY}, {r6('value')}, {r6('lo')}, {r6('hi')} FROM (
  SELECT series, 'forecast' AS layer, week_start, predicted_ili AS value, ci_lower AS lo, ci_upper AS hi FROM b
  UNION ALL SELECT series, 'history', week_start, ilitotal, NULL, NULL FROM n WHERE r <= 52
  UNION ALL SELECT series, 'prior_forecast', week_start, predicted_ili, NULL, NULL FROM a
  UNION ALL SELECT series, 'actual', week_start, actual_ili, NULL, NULL FROM a
  UNION ALL SELECT series, 'difference', week_start, actual_ili - predicted_ili,
                   least(actual_ili, predicted_ili), greatest(actual_ili, predicted_ili) FROM a
)"""

OUTPUTS = f"""
SELECT series, {DAY}, unnest(keys) AS key, unnest(vals) AS value FROM (
  SELECT series, week_start,
    CASE WHEN deviation_pct IS NULL THEN
      ['comparison_alert', 'comparison_week', 'comparison_predicted', 'comparison_actual']
    WHEN deviation_pct > 20 THEN
      ['comparison_alert', 'comparison_week', 'comparison_predicted', 'comparison_actual', 'comparison_deviation_pct']
    ELSE ['comparison_alert', 'comparison_deviation_pct'] END AS keys,
    CASE WHEN deviation_pct IS NULL THEN
      ['undefined', strftime(week_start, '%Y-%m-%d'), format('{{:.0f}}', predicted_ili),
       format('{{:.0f}}', actual_ili)]
    WHEN deviation_pct > 20 THEN
      ['true', strftime(week_start, '%Y-%m-%d'), format('{{:.0f}}', predicted_ili),
       format('{{:.0f}}', actual_ili), format('{{:.1f}}', deviation_pct)]
    ELSE ['false', format('{{:.1f}}', deviation_pct)] END AS vals
  FROM a
)"""

ALERTS = f"""
SELECT a.series, {text('a.week_start', 'week_start')}, {r6('a.predicted_ili', 'predicted_ili')}, {r6('a.ci_lower', 'ci_lower')},
       {r6('a.ci_upper', 'ci_upper')}, a.actual_ili, {r6('a.abs_deviation', 'abs_deviation')},
       {r6('a.deviation_pct', 'deviation_pct')}, a.direction,
       CASE a.direction WHEN 'over-predicted' THEN 'Over Predicted' ELSE 'Under Predicted' END AS direction_label,
       a.in_interval,
       CASE WHEN a.in_interval THEN 'Yes — actual fell within the 95% PI'
            ELSE 'No — actual was outside the 95% PI' END AS interval_status,
       'Prediction Accuracy — ' || a.series || ': ' || a.direction || ' by '
         || format('{{:.0f}}', a.deviation_pct) || '%' AS subject,
       20.0::DOUBLE AS threshold_pct,
       {text('b.week_start', 'next_week_start')}, {r6('b.predicted_ili', 'next_predicted_ili')},
       {r6('b.ci_lower', 'next_ci_lower')}, {r6('b.ci_upper', 'next_ci_upper')}
FROM a LEFT JOIN b ON a.series = b.series WHERE a.deviation_pct > 20"""

APPENDED = f"""
WITH {BASELINE}
SELECT {FORECAST_OUT}, generated_at
FROM b CROSS JOIN (VALUES ('2001-08-06 16:00:00'), ('2001-08-13 16:00:00')) AS t(generated_at)"""

SPLIT_FRAME = f"""WITH {REPEATING},{features('h', f'WINDOW w AS ({FULL_ORDER})')}
SELECT {FRAME_OUT}, CASE WHEN 5 * row_number() OVER ({FULL_ORDER}, {", ".join(FEATURES)}) <= 4 * count(*) OVER (PARTITION BY series)
                         THEN 'train' ELSE 'validation' END AS split FROM f"""

DUE = "series IN (SELECT series FROM g WHERE action = 'retrain')"


def run_status(made: str) -> str:
    """Gate, comparison and forecast of a run; ``made`` ends in the forecasts ``z``."""
    return f"""WITH {PANEL},{NEWEST_ACCURACY},{GATE},{FRAME},
due AS (SELECT f.* FROM f JOIN g USING (series) WHERE g.action = 'retrain'),
{made}
SELECT g.series, g.action, g.reason, {text('z.week_start', 'next_week')},
       {r6('z.predicted_ili', 'predicted_ili')}, {r6('z.ci_lower', 'ci_lower')}, {r6('z.ci_upper', 'ci_upper')}, z.status,
       a.week_start::VARCHAR AS prior_week, a.actual_ili, {r6('a.deviation_pct', 'deviation_pct')},
       CASE WHEN g.action = 'skip' THEN v.week_start::VARCHAR END AS standing_week
FROM g LEFT JOIN z ON z.series = g.series LEFT JOIN a ON a.series = g.series
LEFT JOIN v ON v.series = g.series"""


ORACLES: dict[str, str] = {
    "payload_rows": f"""WITH {EVENTS}
SELECT payload_id, series, week_start, epiweek::VARCHAR AS epiweek, num_ili,
       num_patients::VARCHAR AS num_patients, value::VARCHAR AS ili FROM x""",
    "payload_errors": """
SELECT event_id AS payload_id,
       CASE WHEN event_type <> 'error' THEN 'No data returned'
            WHEN value >= 10 THEN 'bad request' ELSE 'unknown error' END AS error
FROM events WHERE event_type = 'error' OR value < 1""",
    "normalize_region": f"""WITH {REGIONS}
SELECT c_custkey, code AS region_code
FROM raw LEFT JOIN names ON name = lower(trim(region, ' ' || chr(9)))""",
    "normalize_region_trusted": f"WITH {REGIONS} SELECT c_custkey, lower(region) AS region_code FROM raw",
    "observations": f"""WITH {EVENTS}
SELECT series, {text(f"first_day + CASE WHEN week_start IS NULL THEN {SHIFT} ELSE 0 END", 'week_start')},
       epiweek AS week, try_cast(num_ili AS DOUBLE) AS ilitotal,
       num_patients::DOUBLE AS total_patients, {r6('value', 'percent_ili')}
FROM (SELECT *, epiweek // 100 - 1 AS py, make_date(epiweek // 100 - 1, 1, 1) AS prior FROM x)""",
    "observation_errors": f"""WITH {EVENTS},{FAULTY}
SELECT series, payload_id, error,
       '{{"week_start":' || coalesce('"' || week_start || '"', 'null') || ',"epiweek":' || coalesce('"' || week || '"', 'null')
       || ',"num_ili":"' || num_ili || '","num_patients":"' || num_patients || '","ili":"' || value::VARCHAR || '"}}' AS record
FROM bad WHERE error IS NOT NULL""",
    "sound_observations": f"WITH {EVENTS},{FAULTY} {SOUND} WHERE error IS NULL",
    "sound_observations_series": f"""WITH {EVENTS},{FAULTY} {SOUND}
WHERE series NOT IN (SELECT series FROM bad WHERE error IS NOT NULL)""",
    "epiweek_to_date": f"""WITH {ORDER_WEEKS}
SELECT o_orderkey, epiweek, {text(f'{MMWR} + {SHIFT}', 'week_start')} FROM j""",
    "mmwr_week_start": f"""WITH {ORDER_WEEKS}
SELECT o_orderkey, epiweek, {text(MMWR, 'week_start')} FROM j""",
    "scope_filter": f"""WITH {PANEL} SELECT {BASE} FROM p
WHERE series IN ('NATION_1-BUILDING', 'NATION_2-MACHINERY') AND week BETWEEN 199101 AND 200052""",
    "coverage_stats": f"""WITH {PANEL}
SELECT series, count(*)::BIGINT AS n_rows, min(week_start)::VARCHAR AS first_week, max(week_start)::VARCHAR AS last_week,
       ((max(week_start) - min(week_start)) // 7 + 1 - count(DISTINCT week_start))::BIGINT AS missing_weeks,
       (count(*) - count(DISTINCT week_start))::BIGINT AS repeated_rows,
       (max(week_start) - min(week_start)) // 7 + 1 > count(DISTINCT week_start) AS is_gap
FROM p GROUP BY series""",
    "lag_features": f"WITH {PANEL} SELECT {BASE}, {', '.join(LAG_SQL)} FROM p {WINDOW}",
    "rolling_features": f"""WITH {PANEL}
SELECT {BASE}, {', '.join(r6(c) for c in ROLL_NAMES)}
FROM (SELECT *, {', '.join(ROLL_SQL)} FROM p {WINDOW})""",
    "seasonal_features": f"""WITH {PANEL}
SELECT {BASE}, {r6('week_sin')}, {r6('week_cos')} FROM (SELECT *, {SEASON_SQL} FROM p)""",
    "seasonal_features_strict": f"""WITH {PANEL}
SELECT {BASE}, {r6('sin(2 * pi() * (week % 100) / 52)', 'week_sin')},
       {r6('cos(2 * pi() * (week % 100) / 52)', 'week_cos')} FROM p""",
    "trend_feature": f"WITH {PANEL} SELECT {BASE}, {TREND_SQL} FROM p {WINDOW}",
    "training_frame": f"WITH {PANEL},{FRAME} SELECT {FRAME_OUT} FROM f",
    "training_frame_blocks": f"""WITH {REPEATING},{features('h', f'WINDOW w AS ({FULL_ORDER})')}
SELECT {FRAME_OUT} FROM f""",
    "forecast_point_features": f"WITH {PANEL},{RANKED},{point('parity')} SELECT {POINT_OUT} FROM c",
    "forecast_point_features_consistent": f"""WITH {PANEL},{RANKED},{point('consistent')}
SELECT {POINT_OUT} FROM c""",
    "forecast_point_features_strict": f"""WITH {PANEL},{RANKED},{point('consistent', strict=True)}
SELECT {POINT_OUT} FROM c""",
    "chronological_split": f"WITH {PANEL},{FRAME},{SPLIT} SELECT {BASE}, split FROM d",
    "chronological_split_global": f"""WITH {PANEL},{FRAME},
u AS (SELECT week_start, row_number() OVER (ORDER BY week_start) AS i, count(*) OVER () AS m
      FROM (SELECT DISTINCT week_start FROM f))
SELECT {BASE}, CASE WHEN 5 * i <= 4 * m THEN 'train' ELSE 'validation' END AS split
FROM f JOIN u USING (week_start)""",
    "chronological_split_blocks": f"""WITH {REPEATING}
SELECT {BASE}, CASE WHEN 5 * row_number() OVER ({FULL_ORDER}) <= 4 * count(*) OVER (PARTITION BY series)
                    THEN 'train' ELSE 'validation' END AS split FROM h""",
    "regression_metrics": f"""WITH {PANEL},{FRAME},{SPLIT}
SELECT series, split, {r6('sqrt(avg((ilitotal - roll_mean_12) ** 2))', 'rmse')},
       {r6('1 - sum((ilitotal - roll_mean_12) ** 2) / nullif(var_pop(ilitotal) * count(*), 0)', 'r2')},
       count(*)::BIGINT AS n
FROM d GROUP BY series, split""",
    "chronological_split_frame": SPLIT_FRAME,
    "chronological_split_frame_blocks": SPLIT_FRAME,
    "chronological_split_frame_auto": SPLIT_FRAME,
    "fit_forecaster_stumps": f"""WITH {PANEL},{FRAME},{stumps('f')}
SELECT 1::INT AS tree, [{STUMP_NAMES}][place] AS feature, {r6('threshold')}, {r6('low')}, {r6('high')} FROM t1
UNION ALL SELECT 2, [{STUMP_NAMES}][place], {r6('threshold')}, {r6('0.05 * low', 'low')}, {r6('0.05 * high', 'high')} FROM t2""",
    "fit_forecaster_leafwise": f"""WITH {PANEL},{FRAME},{LEAFWISE}
SELECT 'all' AS model, tree::INT AS tree, node::INT AS node, [{STUMP_NAMES}][place] AS feature,
       {r6(edge('b0e'), 'threshold')}, {r6('value')}
FROM (SELECT 1 AS tree, * FROM t1n UNION ALL SELECT 2, * FROM t2n), b0e""",
    "fit_forecaster_per_series": f"""WITH {PANEL},{FRAME},{PER_SERIES}
SELECT series AS model, tree::INT AS tree, node::INT AS node, CASE WHEN node = 1 THEN [{STUMP_NAMES}][place] END AS feature,
       CASE WHEN node = 1 THEN round({edge('b0e')}, 6) END AS threshold,
       CASE node WHEN 2 THEN round({value('ls', 'ln')}, 6) WHEN 3 THEN round({value('ts - ls', 'tn - ln')}, 6) END AS value
FROM (SELECT 1 AS tree, * FROM t1 UNION ALL SELECT 2, * FROM t2) JOIN b0e USING (series), (VALUES (1), (2), (3)) AS k(node)""",
    "score_compiled": f"""WITH {PANEL},{FRAME},{stumps('f')}
SELECT series, {DAY}, ilitotal, {r6(STUMPED, 'prediction')} FROM f""",
    "score_leafwise": f"""WITH {PANEL},{FRAME},{LEAFWISE}
SELECT series, {DAY}, ilitotal, {r6(LEAFWISE_VALUE, 'prediction')}, 'ok' AS status FROM b0""",
    "score_per_series": f"""WITH {PANEL},{FRAME},{PER_SERIES}
SELECT series, {DAY}, ilitotal,
       {r6(f"base + coalesce((SELECT {OWN_ADDS} FROM t1 WHERE t1.series = w.series), 0) + coalesce((SELECT {OWN_ADDS} FROM t2 WHERE t2.series = w.series), 0)", 'prediction')},
       'ok' AS status
FROM w1 AS w""",
    "score_stumps": f"""WITH {PANEL},{FRAME},{stumps('f')}
SELECT series, {DAY}, ilitotal, {r6(STUMPED, 'prediction')}, 'ok' AS status FROM f""",
    "backtest_stumps": f"""WITH {PANEL},{FRAME},{SPLIT},
early AS (SELECT * FROM d WHERE split = 'train'),{stumps('early')}
SELECT split, {r6('sqrt(avg((ilitotal - fitted) ** 2))', 'rmse')},
       {r6('1 - sum((ilitotal - fitted) ** 2) / nullif(var_pop(ilitotal) * count(*), 0)', 'r2')},
       count(*)::BIGINT AS n
FROM (SELECT *, {STUMPED} AS fitted FROM d) GROUP BY split""",
    "next_forecast_stumps": f"""WITH {PANEL},{FRAME},{RANKED},{point('parity')},{stumps('f')},
{residual_spans('f', STUMPED)},
{forecast(f"SELECT c.series, c.week_start, t.n, {STUMPED} AS value, false AS missing FROM c JOIN ({COUNTED}) t USING (series)")}
SELECT {FORECAST_OUT}, interval_ok, status FROM z""",
    "next_forecast_leafwise": f"""WITH {PANEL},{FRAME},{RANKED},{point('parity')},{LEAFWISE},
d0 AS (SELECT * EXCLUDE ({", ".join(f"e{i}" for i in PLACES)}), [{", ".join(f"len(list_filter(e{i}, lambda x: x < {c}))" for i, c in zip(PLACES, LAG_NAMES))}] AS bins FROM c CROSS JOIN b0e),
{residual_spans('b0', LEAFWISE_VALUE)},
{forecast(f"SELECT d0.series, d0.week_start, t.n, {LEAFWISE_VALUE} AS value, false AS missing FROM d0 JOIN ({COUNTED}) t USING (series)")}
SELECT {FORECAST_OUT}, interval_ok, status FROM z""",
    "backtest_mean_model": f"""WITH {PANEL},{FRAME},{SPLIT},
mu AS (SELECT avg(ilitotal) AS mean FROM d WHERE split = 'train')
SELECT split, {r6('sqrt(avg((ilitotal - mean) ** 2))', 'rmse')},
       {r6('1 - sum((ilitotal - mean) ** 2) / nullif(var_pop(ilitotal) * count(*), 0)', 'r2')},
       count(*)::BIGINT AS n
FROM d, mu GROUP BY split""",
    "next_forecast_mean_model": f"""WITH {PANEL},{FRAME},{mean_forecast('f')}
SELECT {FORECAST_OUT}, interval_ok, status FROM z""",
    "next_forecast_missing": gappy_forecast(strict=False),
    "next_forecast_missing_strict": gappy_forecast(strict=True),
    "residual_interval": f"""WITH {PANEL},{FRAME},{SPANS}
SELECT {FORECAST_OUT}, interval_ok FROM ({
        bounded('SELECT series, max(week_start) + 7 AS week_start, avg(ilitotal) AS predicted_ili FROM p GROUP BY series')
    })""",
    "ledger_append": APPENDED,
    "ledger_append_json": APPENDED,
    "ledger_latest_valid": f"""WITH {PANEL},{LEDGER}
SELECT {FORECAST_OUT}, {MADE} FROM v""",
    "ledger_snapshot": f"""WITH {PANEL},{LEDGER}
SELECT {FORECAST_OUT}, {MADE} FROM v""",
    "ledger_errors": f"""WITH {PANEL},{LEDGER}
SELECT series, {MADE}, 'missing: ci_lower' AS error,
       '{{"series":"' || series || '","week_start":"' || week_start::VARCHAR || '","predicted_ili":' || predicted_ili::VARCHAR
       || ',"ci_lower":null,"ci_upper":' || ci_upper::VARCHAR
       || ',"generated_at":"' || strftime(generated_at, '%Y-%m-%dT%H:%M:%S.000Z') || '"}}' AS record
FROM l WHERE ci_lower IS NULL""",
    "forecast_actual_lookup": f"WITH {PANEL},{LEDGER},{lookup('k', 'l')} SELECT {LOOKED_OUT} FROM k",
    "forecast_accuracy": f"WITH {PANEL},{ALL_ACCURACY} SELECT {ACCURACY_OUT} FROM a",
    "deviation_alerts": f"WITH {BASELINE},{ALL_ACCURACY} {ALERTS}",
    "refresh_gate": f"WITH {PANEL},{LEDGER},{lookup('k', 'v')},{GATE} SELECT * FROM g",
    "forecast_csv": f"WITH {BASELINE} SELECT {FORECAST_OUT} FROM b",
    "summary_lines": f"WITH {BASELINE},{NEWEST_ACCURACY} {SUMMARY}",
    "chart_frame": f"WITH {BASELINE},{NEWEST_ACCURACY} {CHART}",
    "alert_outputs": f"WITH {PANEL},{ALL_ACCURACY} {OUTPUTS}",
    "weekly_run_status": run_status(mean_forecast("due", DUE)),
    "weekly_run_published": run_status(mean_forecast("due", DUE)),
    "weekly_run_stumps": run_status(f"""{RANKED},{point('parity')},{stumps('due')},
{residual_spans('due', STUMPED)},
{forecast(f"SELECT c.series, c.week_start, t.n, {STUMPED} AS value, false AS missing FROM c JOIN ({COUNTED}) t USING (series) WHERE {DUE}")}"""),
}
