"""The SQL that the queries of ``analyses`` are checked against."""

from __future__ import annotations

from barloom.queries.oracle import BARS, ITEMS, ORACLE, SERIES, SUPPLIERS, over

ASKED = """asked(asked, a, b) AS (VALUES
  ('all', DATE '1990-01-01', DATE '2000-12-31'), ('one year', DATE '1995-01-01', DATE '1995-12-31'),
  ('odd days', DATE '1993-02-17', DATE '1997-11-05'), ('two weeks', DATE '1996-03-04', DATE '1996-03-17'),
  ('across one border', DATE '1994-06-20', DATE '1994-07-25'), ('one day', DATE '1994-06-20', DATE '1994-06-20'),
  ('turned', DATE '1995-02-01', DATE '1995-01-01'), ('before all', DATE '1980-01-01', DATE '1981-01-01'))"""

# Straight from the bars of each range: ordered lists, the peak of each place from the list before it.
PERFORMANCE = """ranged AS (SELECT asked, s.* FROM asked JOIN silver s ON s.trade_date BETWEEN a AND b),
all_days AS (
  SELECT asked, ticker, list(trade_date ORDER BY trade_date) AS d, list(adjclose ORDER BY trade_date) AS p FROM ranged GROUP BY ALL),
peaks AS (
  SELECT asked, ticker, trade_date, adjclose, max(adjclose) OVER w AS peak
  FROM ranged WINDOW w AS (PARTITION BY asked, ticker ORDER BY trade_date)),
falls AS (SELECT asked, ticker, list(adjclose / peak - 1 ORDER BY trade_date) AS f FROM peaks GROUP BY ALL),
steps AS (
  SELECT asked, ticker, adjclose / lag(adjclose) OVER (PARTITION BY asked, ticker ORDER BY trade_date) - 1 AS r
  FROM ranged WHERE volume_status = 'normal'),
spread AS (SELECT asked, ticker, count(r) AS n, stddev_samp(r) * sqrt(252) AS vol FROM steps GROUP BY ALL)
SELECT asked, ticker, d[1] AS first_date, d[-1] AS last_date, CAST(len(d) AS BIGINT) AS n_sessions, CAST(coalesce(n, 0) AS BIGINT) AS n_returns,
  round(p[-1] / p[1] - 1, 6) AS total_return, round(vol, 6) AS vol_ann, round(list_min(f), 6) AS max_drawdown,
  d[list_position(p, list_max(p[1:list_position(f, list_min(f))]))] AS peak_date, d[list_position(f, list_min(f))] AS trough_date,
  round(f[-1], 6) AS current_drawdown
FROM all_days JOIN falls USING (asked, ticker) LEFT JOIN spread USING (asked, ticker)"""

# A day opens a stretch if no earlier price is higher; the stretch ends where the next one of these days is.
EPISODES = """tops AS (
  SELECT ticker, trade_date, adjclose, coalesce(adjclose >= max(adjclose) OVER w, TRUE) AS top FROM silver
  WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
stretches AS (
  SELECT ticker, trade_date AS peak_date, adjclose AS peak_price,
    lead(trade_date) OVER (PARTITION BY ticker ORDER BY trade_date) AS recovery_date
  FROM tops WHERE top),
under AS (
  SELECT s.ticker, peak_date, peak_price, recovery_date, count(*) AS n, min((t.adjclose, t.trade_date)) AS low
  FROM stretches s JOIN tops t ON t.ticker = s.ticker AND t.trade_date > peak_date AND t.trade_date < coalesce(recovery_date, DATE '9999-01-01')
  GROUP BY ALL)
SELECT ticker, peak_date, low[2] AS trough_date, recovery_date, peak_price, low[1] AS trough_price, round(low[1] / peak_price - 1, 6) AS max_drawdown,
  n AS n_sessions_below, CAST(low[2] - peak_date AS INTEGER) AS days_to_trough, CAST(recovery_date - peak_date AS INTEGER) AS days_to_recovery
FROM under"""

# Every day's own label instead of a join on ranges.
DIFFERENCES = """labelled AS (SELECT *, {label} AS label FROM bars),
made AS (
  SELECT ticker, label, count(*) AS n_sessions, arg_min(open, trade_date) AS open, max(high) AS high, min(low) AS low,
    arg_max(close, trade_date) AS close, CAST(sum(volume) AS BIGINT) AS volume, (label - DATE '1970-01-01') + length(ticker) + ascii(ticker) AS k
  FROM labelled GROUP BY ticker, label),
compared AS (
  SELECT ticker, label, n_sessions, k % 13 = 0 AS o, k % 11 = 0 AS h, k % 7 = 0 AS c FROM made WHERE k % 5 <> 0 AND k % 17 <> 0),
lost AS (SELECT ticker, sum(n_sessions) AS n_sessions FROM made WHERE k % 5 = 0 OR k % 17 = 0 GROUP BY ticker)
SELECT ticker, label, n_sessions, o AS open_differs, h AS high_differs, FALSE AS low_differs, c AS close_differs, h AS volume_differs,
  concat_ws(',', CASE WHEN o THEN 'open' END, CASE WHEN h THEN 'high' END, CASE WHEN c THEN 'close' END, CASE WHEN h THEN 'volume' END) AS difference
FROM compared
UNION ALL SELECT ticker, CAST(label + 20000 AS DATE), 0, FALSE, FALSE, FALSE, FALSE, FALSE, 'no daily bars' FROM made WHERE k % 5 <> 0 AND k % 17 = 0
UNION ALL SELECT ticker, NULL, n_sessions, FALSE, FALSE, FALSE, FALSE, FALSE, 'no label' FROM lost"""

RESCUED = """SELECT CAST(event_id AS VARCHAR) AS event, CASE WHEN n <> 6 THEN '10' END AS open, CASE WHEN n <> 6 THEN '10.5' END AS adjclose,
  CASE n WHEN 2 THEN NULL WHEN 6 THEN NULL WHEN 3 THEN user_id || ',5' ELSE CAST(user_id AS VARCHAR) END AS volume,
  CASE WHEN n NOT IN (2, 6) THEN 'noon' END AS ingested_at_utc,
  CASE n WHEN 1 THEN '{"8":"x' || event_id || '"}' WHEN 2 THEN '{"6":null,"7":null}' WHEN 4 THEN '{"8":"a,' || event_id || '","9":""}'
    WHEN 5 THEN '{"8":"p","9":"q","10":"r"}' WHEN 6 THEN '{"1":null,"2":null,"3":null,"4":null,"5":null,"6":null,"7":null}'
    WHEN 7 THEN '{"8":"say \\"hi\\" ' || event_id || '"}' END AS _rescued_data,
  'folder=' || event_type AS folder
FROM (SELECT *, event_id % 9 AS n FROM events)"""

# The documents as text, opened by SQL's own JSON functions.
DOCUMENTS = """counted AS (
  SELECT ticker, CAST(ticker AS BIGINT) AS k, CAST(count(*) AS VARCHAR) AS n, strftime(max(trade_date), '%Y-%m-%d') AS last FROM bars GROUP BY ticker),
parts AS (
  SELECT *, '{"date_max":"' || last || '","duplicate_dates":0,"rows":' AS head, CASE WHEN k % 7 = 0 THEN '"' || n || '"' ELSE n END AS daily FROM counted),
documents_ AS (
  SELECT ticker, k, CASE WHEN k % 17 <> 0 THEN CAST('{"ticker":"' || ticker || '","stock":"S","intervals":' || CASE WHEN k % 13 = 0 THEN '"none"' ELSE
      '{"1d":' || head || daily || '},"1wk":' || CASE WHEN k % 11 = 0 THEN 'null' ELSE head || n || '}' END || ',"1mo":' || head || n || '}}' END
    || CASE WHEN k % 5 = 0 THEN '' ELSE ',"run_id":"r"' END
    || CASE WHEN k % 3 = 0 THEN ',"vendor":{"name":"v' || ticker || '","ids":[1,"x"]}' ELSE '' END || '}' AS JSON) END AS document
  FROM parts),
opened AS (
  SELECT ticker, replace(regexp_replace(t.fullkey[3:], '\\[[0-9]+\\]', '[]', 'g'), '"', '') AS path,
    CASE t.type WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN 'VOID' ELSE t.type END AS kind
  FROM documents_, json_tree(document) t WHERE document IS NOT NULL AND t.parent IS NOT NULL),
paths AS (SELECT ticker, path, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kind FROM opened GROUP BY ticker, path)"""
DRIFT = """declared(path, declared) AS (
  SELECT * FROM (VALUES ('ticker', 'STRING'), ('stock', 'STRING'), ('run_id', 'STRING'), ('intervals', 'OBJECT'))
  UNION ALL SELECT 'intervals.' || i || f, t FROM (VALUES ('1d'), ('1wk'), ('1mo')) a(i),
    (VALUES ('', 'OBJECT'), ('.date_max', 'STRING'), ('.duplicate_dates', 'BIGINT'), ('.rows', 'BIGINT')) b(f, t)),
owed AS (SELECT ticker, path, declared FROM documents_, declared WHERE document IS NOT NULL)
SELECT ticker, path, CASE WHEN declared IS NULL THEN 'added' WHEN kind IS NULL THEN 'missing' ELSE 'retyped' END AS change, declared, kind AS found
FROM owed FULL JOIN paths USING (ticker, path) WHERE declared IS DISTINCT FROM kind AND coalesce(kind, '') <> 'VOID'
UNION ALL SELECT ticker, '', 'not JSON', NULL, NULL FROM documents_ WHERE document IS NULL"""

# Every version's rows with their number of copies, and for each content the list of versions that hold it so.
VERSIONS = """second AS (
  SELECT ticker, trade_date, close, CASE WHEN year(trade_date) = 1995 THEN adjclose + 0.25 ELSE adjclose END AS adjclose, volume FROM bars),
thin AS (SELECT * FROM second WHERE volume <= 45),
stacked AS (
  SELECT 0 AS version, ticker, trade_date, close, adjclose, volume FROM bars WHERE trade_date < DATE '1998-01-01'
  UNION ALL SELECT v, s.* FROM second s, (VALUES (1), (2), (4)) t(v)
  UNION ALL SELECT 3, * FROM thin UNION ALL SELECT 3, * FROM thin WHERE ticker = '1'),
counted AS (SELECT version, ticker, trade_date, close, adjclose, volume, count(*) AS copies FROM stacked GROUP BY ALL),
held AS (SELECT * EXCLUDE (version), list(version ORDER BY version) AS v FROM counted GROUP BY ALL)"""
HISTORY = """SELECT * EXCLUDE (v, starts, s), CAST(s AS INTEGER) AS valid_from,
  CAST(nullif(list_min(list_filter(range(s, 6), lambda x: NOT list_contains(v, x))), 5) AS INTEGER) AS valid_to
FROM (SELECT *, unnest(starts) AS s FROM (SELECT *, list_filter(v, lambda x: NOT list_contains(v, x - 1)) AS starts FROM held))"""
RESTATED = """SELECT ticker, trade_date, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed' ELSE 'changed' END AS change,
  CASE WHEN a.n IS NULL OR b.n IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.close IS DISTINCT FROM b.close THEN 'close' END,
    CASE WHEN a.adjclose IS DISTINCT FROM b.adjclose THEN 'adjclose' END, CASE WHEN a.volume IS DISTINCT FROM b.volume THEN 'volume' END,
    CASE WHEN a.n <> b.n THEN 'copies' END) END AS columns
FROM (SELECT *, copies AS n FROM counted WHERE version = 0) a FULL JOIN (SELECT *, copies AS n FROM counted WHERE version = 3) b USING (ticker, trade_date)
WHERE (a.close, a.adjclose, a.volume, a.n) IS DISTINCT FROM (b.close, b.adjclose, b.volume, b.n)"""
PER_VERSION = """SELECT CAST(v AS INTEGER) AS version, count(*) FILTER (WHERE now IS NOT NULL AND was IS NULL) AS n_added,
  count(*) FILTER (WHERE now IS NULL AND was IS NOT NULL) AS n_removed, count(*) FILTER (WHERE now <> was) AS n_changed
FROM range(1, 5) r(v) LEFT JOIN (
  SELECT w.v AS at, ticker, trade_date, max((close, adjclose, volume, copies)) FILTER (WHERE version = w.v) AS now,
    max((close, adjclose, volume, copies)) FILTER (WHERE version = w.v - 1) AS was
  FROM counted JOIN range(1, 5) w(v) ON version IN (w.v, w.v - 1) GROUP BY ALL) c ON c.at = v
GROUP BY v"""

# One run after the other.
ALERTS = """counts AS (
  SELECT event_type AS check_name, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_id % 7 = 0) AS n FROM events GROUP BY ALL),
history AS (
  SELECT check_name, day, CAST(n + CASE WHEN check_name = 'purchase' AND dayofmonth(day) >= 20 THEN greatest(n // 3, 50) ELSE 0 END AS DOUBLE) AS x,
    row_number() OVER (PARTITION BY check_name ORDER BY day) AS k FROM counts),
runs(check_name, day, x, k, n, mean, squares, s_up, s_down, level, spread, up, down, alert) AS (
  SELECT check_name, day, x, k, 1.0::DOUBLE, x, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::VARCHAR
  FROM history WHERE k = 1
  UNION ALL
  SELECT check_name, day, x, k, CASE WHEN a IS NULL THEN n + 1 ELSE 1 END, CASE WHEN a IS NULL THEN later ELSE x END,
    CASE WHEN a IS NULL THEN squares + (x - mean) * (x - later) ELSE 0 END, CASE WHEN a IS NULL THEN u ELSE 0 END, CASE WHEN a IS NULL THEN d ELSE 0 END,
    CASE WHEN n >= 8 THEN mean END, CASE WHEN n >= 8 THEN sd END, u, d, a
  FROM (SELECT *, CASE WHEN u > 6 THEN 'up' WHEN d > 6 THEN 'down' END AS a FROM (
    SELECT *, CASE WHEN n >= 8 THEN greatest(s_up + (x - mean) / sd - 1, 0) ELSE 0 END AS u,
      CASE WHEN n >= 8 THEN greatest(s_down - (x - mean) / sd - 1, 0) ELSE 0 END AS d, mean + (x - mean) / (n + 1) AS later FROM (
      SELECT h.check_name, h.day, h.x, h.k, r.n, r.mean, r.squares, r.s_up, r.s_down, greatest(sqrt(r.squares / greatest(r.n - 1, 1)), 1) AS sd
      FROM runs r JOIN history h ON h.check_name = r.check_name AND h.k = r.k + 1))))
SELECT check_name, day AS checked_at, x AS failing_count, round(level, 6) AS level, round(spread, 6) AS spread, round(up, 6) AS up, round(down, 6) AS down, alert
FROM runs"""
STEPS = """SELECT * FROM (VALUES (0, 'set up', 4, 0), (1, 'filled', 4, 1), (2, 'set up again', 4, 1), (3, 'wrong word', 4, 1), (4, 'right word', 0, 0),
  (5, 'set up at last', 4, 0)) t(place, step, n_tables, n_rows)"""


def after(ctes: list[str], rest: str) -> str:
    """``rest`` has tables of its own before its SELECT."""
    return f"WITH RECURSIVE {', '.join(ctes)}, {rest}"


SUPPLIER_BARS = [ITEMS.format(entity="l_suppkey"), BARS]
MONDAY_BEFORE = "CAST(trade_date - CAST(isodow(trade_date - 1) AS INTEGER) AS DATE)"
MONTH_BEFORE = "CAST(CAST(date_trunc('month', trade_date) AS DATE) - 1 AS DATE)"

ORACLE.update(
    {
        "rescued_fields": RESCUED,
        "exact_rerun_report": ORACLE["rerun_report"],
        "check_level_alerts": "WITH RECURSIVE " + ALERTS,
        "bucketed_daily_dataset": ORACLE["daily_dataset"].replace("SELECT ticker, trade_date, volume_status,", "SELECT ticker, lower(ticker) AS short_name, trade_date, volume_status,"),
        "set_up_and_reset": STEPS.replace("SELECT *", "SELECT place, step, n_tables, n_rows * (SELECT count(*) FROM supplier) AS n_rows", 1),
        "snapshot_history": after(SUPPLIER_BARS, VERSIONS + " " + HISTORY),
        "snapshot_as_of": after(SUPPLIER_BARS, VERSIONS + " SELECT ticker, trade_date, close, adjclose, volume FROM stacked WHERE version = 3"),
        "restated_keys": after(SUPPLIER_BARS, VERSIONS + " " + RESTATED),
        "restatements_per_version": after(SUPPLIER_BARS, VERSIONS + " " + PER_VERSION),
        "two_stage_diff_cases": ORACLE["snapshot_diff_cases"],
        "summary_drift": after([*SUPPLIER_BARS, DOCUMENTS], DRIFT),
        "summary_structure": over([*SUPPLIER_BARS, DOCUMENTS], "SELECT path, kind, count(*) AS n_documents FROM paths GROUP BY path, kind"),
        "window_performance_ranges": after([*SERIES, ASKED], PERFORMANCE),
        "supplier_window_performance": after([*SUPPLIERS, ASKED], PERFORMANCE),
        "drawdown_episode_list": after(SERIES, EPISODES),
        "supplier_drawdown_episodes": after(SUPPLIERS, EPISODES),
        "weekly_bar_differences": after(SUPPLIER_BARS, DIFFERENCES.format(label=MONDAY_BEFORE)),
        "monthly_bar_differences": after(SUPPLIER_BARS, DIFFERENCES.format(label=MONTH_BEFORE)),
    }
)
