"""The same results in plain SQL, for the correctness check in DuckDB on the same tables."""

from __future__ import annotations

ASSETS = ("click", "error", "purchase", "signup", "view")

EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"

CALENDAR = """CAST(year({0}) AS INT) AS "year", CAST(month({0}) AS INT) AS "month", CAST(day({0}) AS INT) AS "day",
    CAST(hour({0}) AS INT) AS "hour", CAST(minute({0}) AS INT) AS "minute\""""

GAPPY = """gappy AS (
    SELECT *, CASE WHEN value < 5 THEN NULL WHEN value > 150 THEN CAST('NaN' AS DOUBLE) ELSE value END AS v
    FROM events)"""

TICKS = "ticks AS (SELECT event_id, ts, event_type AS asset, value AS price FROM events)"


def bars(name: str, grain: str) -> str:
    return f"""{name} AS (
    SELECT asset, date_trunc('{grain}', ts) AS bucket,
        first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low,
        last(price ORDER BY ts, event_id) AS close, sum(price) AS volume, count(*) AS n_rows
    FROM ticks GROUP BY asset, date_trunc('{grain}', ts))"""


HOUR_BARS = f"WITH {TICKS}, {bars('hours', 'hour')}"

HOURLY_CLOSES = f"""{HOUR_BARS}, closes AS (
    SELECT a.bucket, a.close AS click_close, b.close AS view_close
    FROM (SELECT * FROM hours WHERE asset = 'click') a JOIN (SELECT * FROM hours WHERE asset = 'view') b
    ON a.bucket = b.bucket)"""

HOURLY_RETURNS = f"""{HOURLY_CLOSES}, returns AS (
    SELECT bucket, click_close / nullif(lag(click_close) OVER (ORDER BY bucket), 0) - 1 AS ra,
        view_close / nullif(lag(view_close) OVER (ORDER BY bucket), 0) - 1 AS rb
    FROM closes)"""


def asset_minutes(name: str, event_type: str, prefix: str) -> str:
    return f"""{name} AS (
    SELECT DISTINCT {CALENDAR.format('ts')}, value AS {prefix}_open
    FROM events WHERE event_type = '{event_type}')"""


AB_MINUTES = f"WITH {asset_minutes('a', 'click', 'a')}, {asset_minutes('b', 'view', 'b')}"

# The raw feeds of the job: minute bars, those of A with a high above 150 have no usable prices.
JOB = f"""WITH {TICKS}, {bars('minutes', 'minute')},
    a AS (SELECT bucket, open AS a_open, high AS a_high, low AS a_low, close AS a_close,
            CAST(n_rows AS DOUBLE) AS a_volume FROM minutes WHERE asset = 'click' AND high <= 150),
    b AS (SELECT bucket, open AS b_open, high AS b_high, low AS b_low, close AS b_close,
            CAST(n_rows AS DOUBLE) AS b_volume FROM minutes WHERE asset = 'view')"""

COMBINED_DEFAULT = f"""{JOB} SELECT {CALENDAR.format('a.bucket')}, a.bucket AS timestamp, a_open, a_high, a_low,
    a_close, a_volume, b_open, b_high, b_low, b_close, b_volume FROM a JOIN b ON a.bucket = b.bucket"""

# A return after a price of zero is undefined, so null.
SIMPLE_RETURNS = f"""WITH {TICKS} SELECT event_id, ts, asset, price,
    round(price / nullif(lag(price) OVER (PARTITION BY asset ORDER BY ts, event_id), 0) - 1, 6) AS price_return
    FROM ticks"""

MOVING_AVERAGE = f"""WITH {TICKS} SELECT event_id, ts, asset, price,
    round(avg(price) OVER (PARTITION BY asset ORDER BY ts, event_id ROWS 4 PRECEDING), 6) AS moving_avg FROM ticks"""

ORDERS_WITH_YEAR = "SELECT *, CAST(year(o_orderdate) AS INT) AS \"year\" FROM orders"


def _profile(column: str, nan: str = "0") -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS n,
        count(*) FILTER (WHERE {column} IS NULL) AS n_null, {nan} AS n_nan FROM gappy"""


def _check(table: str, key: str, missing: str = "") -> str:
    condition = f"{key} IS NULL{missing}"
    name = "events_gappy" if table == "gappy" else table
    return f"""SELECT '{name}' AS "table", '{key}' AS "key", count(*) AS n_rows,
        count(*) FILTER (WHERE {condition}) AS n_missing,
        count(*) > 0 AND count(*) FILTER (WHERE {condition}) = 0 AS passed FROM {table}"""


def _listing(position: int, column: str, data_type: str) -> str:
    return f"""SELECT '{column}' AS "column", {position} AS position, '{data_type}' AS data_type,
        true AS nullable, count({column}) AS n_values FROM events"""


def _job_check(table: str, key: str, source: str, bad_lines="false", bad_times="false", incomplete="false") -> str:
    return f"""SELECT '{table}' AS "table", '{key}' AS "key", count(*) AS n_rows, 0 AS n_missing,
        count(*) FILTER (WHERE {bad_lines}) AS n_bad_lines, count(*) FILTER (WHERE {bad_times}) AS n_bad_times,
        count(*) FILTER (WHERE {incomplete}) AS n_incomplete,
        count(*) > 0 AND count(*) FILTER (WHERE {bad_lines} OR {bad_times}) = 0 AS passed FROM {source}"""


def _contract(table: str, source: str) -> str:
    return f"""SELECT '{table}' AS "table", count(*) AS n_rows, 0 AS n_missing_fields, 0 AS n_duplicates, 0 AS n_odd_years,
        true AS passed FROM {source}"""


AB_JOIN = "(SELECT a.bucket FROM a JOIN b ON a.bucket = b.bucket)"
MINUTES_A = "(SELECT * FROM minutes WHERE asset = 'click')"

LAGS = f"""{HOUR_BARS}, lags AS (
        SELECT asset, bucket, close AS y, lag(close, 1) OVER w AS x1, lag(close, 2) OVER w AS x2
        FROM hours WINDOW w AS (PARTITION BY asset ORDER BY bucket)),
        s AS (SELECT asset, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, covar_pop(x1, x1) AS s11,
            covar_pop(x2, x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1y, covar_pop(x2, y) AS s2y
            FROM lags WHERE x1 IS NOT NULL AND x2 IS NOT NULL GROUP BY asset),
        b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
            (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)"""


# Per asset and day, the sums over all earlier days, and the fit that they give.
WALK_FORWARD = f"""{HOUR_BARS}, lags AS (
        SELECT asset, bucket, close AS y, lag(close, 1) OVER w AS x1, lag(close, 2) OVER w AS x2, date_trunc('day', bucket) AS d
        FROM hours WINDOW w AS (PARTITION BY asset ORDER BY bucket)),
        day_sums AS (SELECT asset, d, count(y) FILTER (WHERE x2 IS NOT NULL) AS n, sum(y) FILTER (WHERE x2 IS NOT NULL) AS y,
            sum(x1) FILTER (WHERE x2 IS NOT NULL) AS a, sum(x2) AS b, sum(x1 * x1) FILTER (WHERE x2 IS NOT NULL) AS aa, sum(x2 * x2) AS bb,
            sum(x1 * x2) AS ab, sum(x1 * y) FILTER (WHERE x2 IS NOT NULL) AS ay, sum(x2 * y) AS b_y FROM lags GROUP BY ALL),
        earlier AS (SELECT asset, d, sum(n) OVER w AS n, sum(y) OVER w AS y, sum(a) OVER w AS a, sum(b) OVER w AS b, sum(aa) OVER w AS aa,
            sum(bb) OVER w AS bb, sum(ab) OVER w AS ab, sum(ay) OVER w AS ay, sum(b_y) OVER w AS b_y
            FROM day_sums WINDOW w AS (PARTITION BY asset ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        cov AS (SELECT asset, d, n, y / n AS my, a / n AS m1, b / n AS m2, aa - a * a / n AS s11, bb - b * b / n AS s22, ab - a * b / n AS s12,
            ay - a * y / n AS s1y, b_y - b * y / n AS s2y FROM earlier WHERE n >= 10),
        fit AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM cov),
        ahead AS (SELECT asset, bucket, lags.y AS close, x1, my - b1 * m1 - b2 * m2 + b1 * x1 + b2 * x2 AS predicted,
            coalesce(fit.n, 0)::BIGINT AS n_fitted FROM lags LEFT JOIN fit USING (asset, d))"""

LEAD_LAG = f"""{HOUR_BARS}, long AS (SELECT asset, bucket, close FROM (SELECT DISTINCT bucket FROM hours)
            CROSS JOIN (SELECT DISTINCT asset FROM hours) LEFT JOIN hours USING (asset, bucket)),
        returns AS (SELECT asset, bucket, close / nullif(lag(close) OVER (PARTITION BY asset ORDER BY bucket), 0) - 1 AS r FROM long),
        shifted AS (SELECT asset, bucket, k, lag(r, k) OVER (PARTITION BY asset, k ORDER BY bucket) AS x FROM returns, range(4) t(k))"""


def _size_bars(bar: str) -> str:
    """Bars of ticks by their number `bar` in the order of time."""
    return f"""WITH {TICKS}, summed AS (SELECT *, row_number() OVER w AS i, sum(CAST(price AS DECIMAL(28,9))) OVER w AS s
        FROM ticks WINDOW w AS (PARTITION BY asset ORDER BY ts, event_id))
        SELECT asset, {bar} AS bar, min(ts) AS start, max(ts) AS "end", first(price ORDER BY ts, event_id) AS open, max(price) AS high,
        min(price) AS low, last(price ORDER BY ts, event_id) AS close, round(sum(price), 4) AS volume, count(*) AS n_rows FROM summed GROUP BY ALL"""


def _averages(source: str, columns: dict[str, tuple[str, str]]) -> str:
    """Rows of `source` (asset, i, ...) with exponential averages (column, weight) that begin with the first value, by recursion."""
    first = ", ".join(f"{x} AS {name}" for name, (x, _) in columns.items())
    step = ", ".join(f"coalesce({w} * s.{x} + (1 - {w}) * e.{name}, e.{name}, s.{x})" for name, (x, w) in columns.items())
    return f"""SELECT *, {first} FROM {source} WHERE i = 1
        UNION ALL SELECT s.*, {step} FROM e JOIN {source} s ON s.asset = e.asset AND s.i = e.i + 1"""


NUMBERED = f"""WITH RECURSIVE {HOUR_BARS.removeprefix('WITH ')}, closes AS MATERIALIZED (
        SELECT asset, bucket, close, row_number() OVER w AS i, close - lag(close) OVER w AS m FROM hours WINDOW w AS (PARTITION BY asset ORDER BY bucket)),
        moves AS MATERIALIZED (SELECT *, greatest(m, 0) AS up, greatest(-m, 0) AS down FROM closes WHERE m IS NOT NULL
            UNION ALL SELECT *, NULL, NULL FROM closes WHERE m IS NULL)"""


EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}

ORACLES = {
    "csv_scan": EVENTS,
    "csv_bad_rows": """SELECT * REPLACE (CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value),
        event_type = 'error' AS is_bad, CASE WHEN event_type = 'error' THEN event_id || ',' ||
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || ',' || user_id || ',error,n/a,"' || replace(props, '"', '""') || '"' END AS bad_row
        FROM (SELECT event_id, ts, user_id, event_type, value, props FROM events)""",
    "csv_multi_file_union": """SELECT event_id, event_type, CASE WHEN event_type NOT IN ('view', 'signup') THEN value END AS value
        FROM events""",
    "parquet_scan": "SELECT * FROM orders",
    "parquet_roundtrip": "SELECT * FROM orders",
    "partitioned_roundtrip": f"SELECT * FROM ({ORDERS_WITH_YEAR}) WHERE \"year\" = 1996",
    "partitioned_time_range": f"""SELECT * FROM ({ORDERS_WITH_YEAR})
        WHERE o_orderdate BETWEEN TIMESTAMP '1996-11-01' AND TIMESTAMP '1997-02-01'""",
    "sql_view_select": f"SELECT DISTINCT {CALENDAR.format('ts')}, event_type FROM events",
    "preview_topk": f"{EVENTS} ORDER BY ts, event_id LIMIT 5",
    "schema_listing": " UNION ALL ".join(
        _listing(i, column, data_type) for i, (column, data_type) in enumerate(EVENT_TYPES.items(), start=1)
    ),
    "rename_columns": "SELECT event_id, ts AS timestamp, user_id, event_type, value AS volume_btc, props FROM events",
    "conform_columns": """SELECT event_type AS asset, ts AS timestamp, value AS a_open, value AS a_high, value AS a_low,
        value AS a_volume FROM events""",
    "calendar_parts": f"SELECT event_id, ts, {CALENDAR.format('ts')} FROM events",
    "epoch_to_timestamp": """SELECT event_id, date_trunc('second', ts) AS from_s, date_trunc('millisecond', ts) AS from_ms,
        ts AS from_us, ts AS from_ns, date_trunc('second', ts) AS from_text, date_trunc('millisecond', ts) AS mixed_ms,
        date_trunc('second', ts) AS mixed_text,
        TIMESTAMP '1970-01-01' - (date_trunc('second', ts) - TIMESTAMP '1970-01-01') AS negative,
        date_trunc('second', ts) + INTERVAL 500 MILLISECONDS AS fraction, CAST(NULL AS TIMESTAMP) AS no_number,
        CAST(NULL AS TIMESTAMP) AS no_time, CAST(NULL AS TIMESTAMP) AS slashes, CAST(NULL AS TIMESTAMP) AS too_large,
        CAST(NULL AS TIMESTAMP) AS overflow FROM events""",
    "drop_incomplete_rows": f"WITH {GAPPY} SELECT * FROM gappy WHERE v IS NOT NULL AND NOT isnan(v)",
    "distinct_series": f"SELECT DISTINCT {CALENDAR.format('ts')}, event_type AS asset, value AS open FROM events",
    "align_join_minute": f"""WITH {TICKS}, {bars('minutes', 'minute')}
        SELECT {CALENDAR.format('a.bucket')}, a.close AS a_open, b.close AS b_open
        FROM (SELECT * FROM minutes WHERE asset = 'click') a JOIN (SELECT * FROM minutes WHERE asset = 'view') b
        ON a.bucket = b.bucket""",
    "align_fan_out": f"""{AB_MINUTES} SELECT CAST(count(*) AS DOUBLE) AS n_rows FROM a JOIN b ON a."year" = b."year"
        AND a."month" = b."month" AND a."day" = b."day" AND a."hour" = b."hour" AND a."minute" = b."minute\"""",
    "align_latest_minute": f"""WITH {TICKS}, {bars('minutes', 'minute')}
        SELECT a.bucket, a.close AS click_price, b.close AS view_price
        FROM (SELECT * FROM minutes WHERE asset = 'click') a JOIN (SELECT * FROM minutes WHERE asset = 'view') b
        ON a.bucket = b.bucket""",
    "multi_asset_minutes": f"""WITH {TICKS}, {bars('minutes', 'minute')} SELECT bucket, """
    + ", ".join(f"max(close) FILTER (WHERE asset = '{a}') AS {a}_price" for a in ASSETS)
    + " FROM minutes GROUP BY bucket",
    "union_all_series": EVENTS,
    "row_count": "SELECT count(*) AS n_rows, 6 AS n_columns FROM events",
    "non_null_count": f"WITH {GAPPY} SELECT count(v) AS n_non_null FROM gappy",
    "null_key_count": f"WITH {GAPPY} SELECT count(*) FILTER (WHERE v IS NULL) AS n_missing FROM gappy",
    "null_or_nan_count": f"WITH {GAPPY} SELECT count(*) FILTER (WHERE v IS NULL OR isnan(v)) AS n_missing FROM gappy",
    "null_profile": f"WITH {GAPPY} "
    + " UNION ALL ".join(
        [
            _profile("event_id"),
            _profile("ts"),
            _profile("user_id"),
            _profile("event_type"),
            _profile("value", "count(*) FILTER (WHERE isnan(value))"),
            _profile("props"),
            _profile("v", "count(*) FILTER (WHERE isnan(v))"),
        ]
    ),
    "quality_report": f"WITH {GAPPY} "
    + " UNION ALL ".join(
        [
            _check("orders", "o_orderkey"),
            _check("lineitem", "l_orderkey"),
            _check("customer", "c_custkey"),
            _check("documents", "doc_id"),
            _check("gappy", "v", " OR isnan(v)"),
        ]
    ),
    "year_range_check": """SELECT 'right' AS unit, count(*) FILTER (WHERE year(ts) NOT BETWEEN 2009 AND 2100) AS n_out_of_range
        FROM events UNION ALL SELECT 'wrong', count(*) FROM events""",
    "duplicate_keys": """SELECT date_trunc('minute', ts) AS bucket, event_type AS asset, count(*) AS n_rows FROM events
        GROUP BY date_trunc('minute', ts), event_type HAVING count(*) > 1""",
    "missing_buckets": """SELECT DISTINCT date_trunc('minute', ts) AS bucket FROM events WHERE event_type = 'click'
        AND date_trunc('minute', ts) NOT IN (SELECT date_trunc('minute', ts) FROM events WHERE event_type = 'view')""",
    "staged_feed": f"""WITH {TICKS}, {bars('minutes', 'minute')}, m AS (
        SELECT *, CASE WHEN high > 150 THEN CAST('NaN' AS DOUBLE) END AS gap FROM minutes WHERE asset = 'click')
        SELECT CAST(epoch(bucket) AS BIGINT) AS "Timestamp", coalesce(gap, open) AS "Open", coalesce(gap, high) AS "High",
        coalesce(gap, low) AS "Low", coalesce(gap, close) AS "Close", CAST(n_rows AS DOUBLE) AS "Volume_BTC",
        CAST(2 * n_rows AS DOUBLE) AS "Volume_Currency", coalesce(gap, close) AS "Weighted_Price" FROM m""",
    "series_parity": f"""{JOB} SELECT CAST(epoch(bucket) AS BIGINT) AS timestamp, {CALENDAR.format('bucket')},
        a_open, a_high, a_low, a_volume FROM a""",
    "staged_feed_b": f"""WITH {TICKS}, {bars('minutes', 'minute')} SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS timestamp,
        open, high, low, close, CAST(n_rows AS DOUBLE) AS volume, CAST(epoch_ms(bucket) + 59999 AS BIGINT) AS close_time,
        close AS quote_av, n_rows AS trades, CAST(n_rows AS DOUBLE) AS tb_base_av, CAST(n_rows AS DOUBLE) AS tb_quote_av,
        CAST(n_rows AS DOUBLE) AS "ignore" FROM minutes WHERE asset = 'view'""",
    "series_parity_b": f"""{JOB} SELECT bucket AS timestamp, {CALENDAR.format('bucket')}, b_open, b_high, b_low, b_volume FROM b""",
    "combined_parity": f"""{JOB} SELECT {CALENDAR.format('a.bucket')}, a_open, a_high, a_low, a_volume,
        b_open, b_high, b_low, b_volume FROM a JOIN b ON a.bucket = b.bucket""",
    "combined_default": COMBINED_DEFAULT,
    "incremental_job": COMBINED_DEFAULT,
    "load_history": f"""{JOB}, feeds AS (SELECT 'a' AS feed, bucket, high <= 150 AS used FROM minutes WHERE asset = 'click'
            UNION ALL SELECT 'b', bucket, true FROM minutes WHERE asset = 'view'),
        loads(load, low, high, known) AS (VALUES ('first', TIMESTAMP '2000-01-01', TIMESTAMP '2024-01-10', TIMESTAMP '2000-01-01'),
            ('wrong', TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-20', TIMESTAMP '2000-01-01'),
            ('second', TIMESTAMP '2024-01-10', TIMESTAMP '2100-01-01', TIMESTAMP '2024-01-20'))
        SELECT load, feed, count(*) AS n_rows, count(*) FILTER (WHERE NOT used) AS n_unused, 0::BIGINT AS n_copies,
            count(*) FILTER (WHERE used AND bucket >= known) AS n_inserted, count(*) FILTER (WHERE used AND bucket < known AND feed = 'b') AS n_corrected,
            count(*) FILTER (WHERE used AND bucket < known AND feed = 'a') AS n_unchanged, count(*) AS n_kept
        FROM feeds JOIN loads ON bucket >= low AND bucket < loads.high GROUP BY load, feed""",
    "stream_job": COMBINED_DEFAULT,
    "rollup_increments": " UNION ALL ".join(
        f"""(SELECT * FROM ({JOB} SELECT '{grain}' AS grain, date_trunc('{grain}', bucket) AS timestamp, first(a_open ORDER BY bucket) AS open, max(a_high) AS high,
            min(a_low) AS low, last(a_close ORDER BY bucket) AS close, sum(a_volume) AS volume, count(*) AS n_minutes FROM a GROUP BY ALL))"""
        for grain in ("hour", "day")
    ),
    "job_quality": f"{JOB} "
    + " UNION ALL ".join(
        [
            _job_check("staging_a", "Timestamp", MINUTES_A, incomplete="high > 150"),
            _job_check("a_timeseries", "timestamp", "a"),
            _job_check("staging_b", "timestamp", "b"),
            _job_check("b_timeseries", "timestamp", "b"),
            _job_check("combined_timeseries", "year", AB_JOIN),
        ]
    ),
    "job_quality_bad_rows": f"{JOB} "
    + " UNION ALL ".join(
        [
            _job_check(
                "staging_a", "Timestamp", MINUTES_A, "minute(bucket) = 7", incomplete="high > 150 AND minute(bucket) <> 7"
            ),
            _job_check("a_timeseries", "timestamp", "a WHERE minute(bucket) <> 7"),
            _job_check("staging_b", "timestamp", "b", bad_times="minute(bucket) = 9"),
            _job_check("b_timeseries", "timestamp", "b WHERE minute(bucket) <> 9"),
            _job_check("combined_timeseries", "year", f"{AB_JOIN} WHERE minute(bucket) NOT IN (7, 9)"),
        ]
    ),
    "contract_report": f"""{JOB}, {GAPPY}, t AS (
        SELECT *, ts + CASE WHEN value > 140 THEN INTERVAL 100 YEARS ELSE INTERVAL 0 YEARS END AS t FROM gappy)
        {_contract("a_timeseries", "a")} UNION ALL {_contract("b_timeseries", "b")}
        UNION ALL {_contract("combined_timeseries", AB_JOIN)}
        UNION ALL SELECT 'ticks', count(*), count(*) FILTER (WHERE v IS NULL OR isnan(v)),
        count(*) - count(DISTINCT (date_trunc('minute', t), event_type)), count(*) FILTER (WHERE year(t) NOT BETWEEN 2009 AND 2100),
        false FROM t""",
    "ohlc_resample": f"""{HOUR_BARS} SELECT asset, bucket, open, high, low, close, round(volume, 6) AS volume, n_rows
        FROM hours""",
    "ohlc_rollup": f"""WITH {TICKS} SELECT asset, date_trunc('day', ts) AS bucket,
        first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low,
        last(price ORDER BY ts, event_id) AS close, round(sum(price), 6) AS volume,
        count(DISTINCT date_trunc('hour', ts)) AS n_hours FROM ticks GROUP BY asset, date_trunc('day', ts)""",
    "align_with_close": f"""{HOUR_BARS} SELECT a.bucket AS timestamp, {CALENDAR.format('a.bucket')},
        a.open AS click_open, a.high AS click_high, a.low AS click_low, a.close AS click_close,
        round(a.volume, 6) AS click_volume, b.open AS view_open, b.high AS view_high, b.low AS view_low,
        b.close AS view_close, round(b.volume, 6) AS view_volume
        FROM (SELECT * FROM hours WHERE asset = 'click') a JOIN (SELECT * FROM hours WHERE asset = 'view') b
        ON a.bucket = b.bucket""",
    "align_all_hours": f"""{HOUR_BARS} SELECT coalesce(a.bucket, b.bucket) AS bucket,
        a.close AS click_close, b.close AS view_close
        FROM (SELECT * FROM hours WHERE asset = 'click') a FULL JOIN (SELECT * FROM hours WHERE asset = 'view') b
        ON a.bucket = b.bucket""",
    "multi_asset_pivot": "SELECT date_trunc('day', ts) AS bucket, "
    + ", ".join(
        f"count(*) FILTER (WHERE event_type = '{a}') AS {a}" for a in ASSETS
    )
    + " FROM events GROUP BY date_trunc('day', ts)",
    "simple_returns": SIMPLE_RETURNS,
    "simple_returns_split": SIMPLE_RETURNS,
    "moving_average": MOVING_AVERAGE,
    "moving_average_split": MOVING_AVERAGE,
    "rolling_stddev": f"""WITH {TICKS} SELECT event_id, ts, asset, price,
        CASE WHEN row_number() OVER (PARTITION BY asset ORDER BY ts, event_id) >= 20 THEN round(stddev_samp(price) OVER (
            PARTITION BY asset ORDER BY ts, event_id ROWS 19 PRECEDING), 6) END AS rolling_stddev FROM ticks""",
    "return_correlation": f"""{HOURLY_RETURNS} SELECT count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL) AS n_pairs,
        round(corr(ra, rb), 6) AS corr FROM returns""",
    "return_correlation_daily": f"""{HOURLY_RETURNS}, days AS (
        SELECT date_trunc('day', bucket) AS "day", count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL) AS n_pairs,
        round(corr(ra, rb), 6) AS c FROM returns GROUP BY date_trunc('day', bucket))
        SELECT "day", n_pairs, CASE WHEN n_pairs > 1 THEN c END AS corr FROM days""",
    "rolling_correlation": f"""{HOURLY_CLOSES}, rolling AS (
        SELECT bucket, row_number() OVER (ORDER BY bucket) AS i,
        corr(click_close, view_close) OVER (ORDER BY bucket ROWS 23 PRECEDING) AS c FROM closes)
        SELECT bucket, round(c, 6) AS rolling_corr FROM rolling WHERE i >= 24""",
    "trend_regression": f"""{HOUR_BARS}, points AS (
        SELECT asset, close, epoch(bucket) / 86400.0 - 19700 AS x FROM hours)
        SELECT asset, count(*) AS n_rows, round(regr_slope(close, x), 6) AS slope,
        round(regr_intercept(close, x), 6) AS intercept, round(regr_r2(close, x), 6) AS r2 FROM points GROUP BY asset""",
    "lag_regression": f"""{LAGS} SELECT asset, n AS n_rows, round(my - b1 * m1 - b2 * m2, 6) AS intercept,
        round(b1, 6) AS coef_lag_1, round(b2, 6) AS coef_lag_2 FROM b""",
    "lag_prediction": f"""{LAGS} SELECT asset, bucket, y AS close,
        round(my - b1 * m1 - b2 * m2 + b1 * x1 + b2 * x2, 4) AS predicted FROM lags LEFT JOIN b USING (asset)""",
    "walk_forward": f"""{WALK_FORWARD} SELECT asset, bucket, close, round(predicted, 4) AS predicted, n_fitted FROM ahead""",
    "walk_forward_errors": f"""{WALK_FORWARD} SELECT asset, count(*) AS n, round(avg(abs(predicted - close)), 4) AS mean_abs_error,
        round(sqrt(avg((predicted - close) ** 2)), 4) AS rmse, round(avg(abs(x1 - close)), 4) AS naive_mean_abs_error,
        round(sqrt(avg((x1 - close) ** 2)), 4) AS naive_rmse FROM ahead WHERE predicted IS NOT NULL GROUP BY asset""",
    "next_hour_forecast": f"""{LAGS} SELECT asset, bucket + INTERVAL 1 HOUR AS bucket, round(my - b1 * m1 - b2 * m2 + b1 * y + b2 * x1, 4) AS predicted
        FROM lags JOIN b USING (asset) WHERE x1 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY asset ORDER BY bucket DESC) = 1""",
    "lead_lag_correlation": f"""{LEAD_LAG} SELECT s.asset AS leader, r.asset AS follower, CAST(k AS INT) AS lag, count(x + r) AS n_pairs,
        round(CASE WHEN count(x + r) > 1 THEN corr(x, r) END, 6) AS corr FROM shifted s JOIN returns r USING (bucket) GROUP BY ALL""",
    "align_last_known": f"""WITH {TICKS}, a AS (SELECT * FROM ticks WHERE asset = 'click'
            QUALIFY row_number() OVER (PARTITION BY date_trunc('minute', ts) ORDER BY ts DESC, event_id DESC) = 1),
        b AS (SELECT ts AS b_ts, price AS b_price FROM ticks WHERE asset = 'view' QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id DESC) = 1),
        j AS (SELECT a.event_id, a.ts, a.price, b_price, b_ts, a.ts - b_ts <= INTERVAL 10 MINUTES AS fresh FROM a ASOF LEFT JOIN b ON a.ts >= b.b_ts)
        SELECT event_id, ts, price, CASE WHEN fresh THEN b_price END AS b_price, CASE WHEN fresh THEN b_ts END AS b_ts FROM j""",
    "align_last_known_assets": """WITH b AS (SELECT user_id, ts, event_id AS purchase_id, value AS paid FROM events WHERE event_type = 'purchase'
            QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
        SELECT e.event_id, e.ts, e.user_id, paid, purchase_id FROM (SELECT * FROM events WHERE event_type <> 'purchase') e
        ASOF LEFT JOIN b ON e.user_id = b.user_id AND e.ts >= b.ts""",
    "volume_bars": _size_bars("CAST(floor((s - CAST(price AS DECIMAL(28,9))) / 1000) AS BIGINT)"),
    "row_bars": _size_bars("(i - 1) // 50"),
    "gap_intervals": f"""WITH {TICKS}, seen AS (SELECT DISTINCT asset, date_trunc('minute', ts) AS m FROM ticks),
        pairs AS (SELECT asset, m, lag(m) OVER (PARTITION BY asset ORDER BY m) AS p FROM seen)
        SELECT asset, p + INTERVAL 1 MINUTE AS start, m - INTERVAL 1 MINUTE AS "end", date_diff('minute', p, m) - 1 AS n_missing
        FROM pairs WHERE date_diff('minute', p, m) - 1 >= 15""",
    "rolling_statistics": f"""WITH {TICKS}, r AS (SELECT *, row_number() OVER o AS i, avg(price) OVER w AS a, stddev_samp(price) OVER w AS s,
            min(price) OVER w AS l, max(price) OVER w AS h
            FROM ticks WINDOW o AS (PARTITION BY asset ORDER BY ts, event_id), w AS (PARTITION BY asset ORDER BY ts, event_id ROWS 199 PRECEDING))
        SELECT event_id, ts, asset, price, CASE WHEN i >= 200 THEN round(a, 6) END AS rolling_avg, CASE WHEN i >= 200 THEN round(s, 6) END AS rolling_stddev,
        CASE WHEN i >= 200 THEN l END AS rolling_min, CASE WHEN i >= 200 THEN h END AS rolling_max FROM r""",
    "exponential_averages": f"""{NUMBERED}, e AS ({_averages('closes', {'e10': ('close', '(2 / 11.0)::DOUBLE'), 'e50': ('close', '(2 / 51.0)::DOUBLE')})})
        SELECT asset, bucket, close, round(e10, 6) AS ema_10, round(e50, 6) AS ema_50 FROM e""",
    "macd": f"""{NUMBERED}, e AS ({_averages('closes', {'e12': ('close', '(2 / 13.0)::DOUBLE'), 'e26': ('close', '(2 / 27.0)::DOUBLE')})}),
        line AS MATERIALIZED (SELECT asset, bucket, close, i, e12 - e26 AS macd FROM e),
        g AS ({_averages('line', {'sig': ('macd', '0.2::DOUBLE')}).replace('FROM e JOIN', 'FROM g AS e JOIN')})
        SELECT asset, bucket, close, round(macd, 6) AS macd, round(sig, 6) AS macd_signal FROM g""",
    "relative_strength": f"""{NUMBERED}, e AS ({_averages('moves', {'u': ('up', '(1 / 14.0)::DOUBLE'), 'd': ('down', '(1 / 14.0)::DOUBLE')})})
        SELECT asset, bucket, close, round(100 * u / nullif(u + d, 0), 5) AS rsi FROM e""",
    "incremental_append": f"""WITH {TICKS} SELECT event_id, ts, asset, price, CAST(year(ts) AS INT) AS "year" FROM ticks""",
    "stream_tumbling_ohlc": f"""{HOUR_BARS} SELECT asset, bucket, open, high, low, close, round(volume, 6) AS volume, n_rows
        FROM hours WHERE bucket + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_feed_bars": f"""{JOB} SELECT 'a' AS asset, date_trunc('hour', bucket) AS bucket,
        first(a_open ORDER BY bucket) AS open, max(a_high) AS high, min(a_low) AS low,
        last(a_close ORDER BY bucket) AS close, sum(a_volume) AS volume, count(*) AS n_rows FROM a
        GROUP BY date_trunc('hour', bucket)
        HAVING date_trunc('hour', bucket) + INTERVAL 2 HOURS <= (SELECT max(bucket) FROM a)""",
    "stream_last_windows": f"""{HOUR_BARS} SELECT asset, bucket, open, high, low, close, round(volume, 6) AS volume, n_rows FROM hours""",
    "stream_join": f"""WITH {TICKS}, {bars('minutes', 'minute')}
        SELECT bucket, a.close AS click_close, b.close AS view_close
        FROM (SELECT * FROM minutes WHERE asset = 'click') a FULL JOIN (SELECT * FROM minutes WHERE asset = 'view') b USING (bucket)""",
    "stream_silent_feeds": f"""WITH {TICKS}, active AS (
            SELECT DISTINCT asset, date_trunc('minute', ts) AS m, true AS seen FROM ticks
            UNION ALL SELECT asset, date_trunc('minute', min(ts)), false FROM events, (SELECT unnest({[*ASSETS, 'refund']}) AS asset) GROUP BY asset),
        minutes AS (SELECT asset, m, bool_or(seen) AS seen FROM active GROUP BY asset, m),
        spans AS (SELECT *, lead(m) OVER (PARTITION BY asset ORDER BY m) AS n FROM minutes)
        SELECT asset, m + INTERVAL 1 MINUTE AS silent_from, seen FROM spans WHERE n IS NULL OR n - m >= INTERVAL 31 MINUTES""",
    "stream_align": f"""WITH {TICKS}, {bars('minutes', 'minute')}
        SELECT a.bucket, a.close AS click_close, b.close AS view_close
        FROM (SELECT * FROM minutes WHERE asset = 'click') a JOIN (SELECT * FROM minutes WHERE asset = 'view') b
        ON a.bucket = b.bucket
        WHERE a.bucket + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_drop_copies": EVENTS,
    "stream_incremental_append": f"""WITH {TICKS}
        SELECT event_id, ts, asset, price, CAST(year(ts) AS INT) AS "year" FROM ticks""",
}
