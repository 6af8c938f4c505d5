"""SQL of the service figure queries: every window is spelled out row by row."""

from mensura.plans import monitoring

_log = """r AS (SELECT ts, event_type AS endpoint, CAST(user_id AS VARCHAR) AS instance, value AS latency,
    CASE event_type WHEN 'error' THEN '500' WHEN 'signup' THEN '403' ELSE '200' END AS status_code,
    length(props) AS bytes FROM events)"""
_INF = "CAST('Infinity' AS DOUBLE)"
_EPOCH = "TIMESTAMP '1970-01-01'"


def _windows(source: str, hours: int, name: str = "w") -> str:
    """Each row once per window of that many hours, hourly slide, that holds it."""
    return f"""{name} AS (SELECT s.*, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS window_start,
        date_trunc('hour', ts) - k * INTERVAL 1 HOUR + INTERVAL {hours} HOUR AS window_end
        FROM {source} s, range({hours}) h(k))"""


def _with(body: str, *ctes: str) -> str:
    return f"WITH {', '.join((_log, *ctes))} {body}"


def _counters(by: str, amount: str) -> str:
    return f"""c AS (SELECT {by}, ts, CAST(sum(n) OVER (PARTITION BY {by}, CAST(ts AS DATE) ORDER BY ts) AS DOUBLE) AS value
        FROM (SELECT {by}, date_trunc('hour', ts) AS ts, sum({amount}) AS n FROM r GROUP BY ALL))"""


def _growth(by: str) -> str:
    """Growth per series and window, from each pair of neighbouring samples inside the window."""
    return f"""g AS (SELECT {by}, window_start, window_end, sum(CASE WHEN before IS NULL THEN 0
            WHEN value >= before THEN value - before ELSE value END) AS increase
        FROM (SELECT *, lag(value) OVER (PARTITION BY {by}, window_start ORDER BY ts, value) AS before FROM w)
        GROUP BY ALL)"""


def _rate(by: str, amount: str, out: str) -> str:
    group = f"{out}, " if out else ""
    return _with(
        f"SELECT {group}window_start, window_end, round(sum(increase) / 21600, 6) AS rate FROM g GROUP BY ALL",
        _counters(by, amount), _windows("c", 6), _growth(by),
    )


def _buckets(bounds, hours: int) -> str:
    parts = [f"SELECT endpoint, b, CAST({x} AS DOUBLE) AS le, count(*) FILTER (WHERE latency <= {x}) AS bucket FROM t GROUP BY ALL" for x in bounds]
    parts.append(f"SELECT endpoint, b, {_INF}, count(latency) FROM t GROUP BY ALL")
    return f"""SELECT endpoint, b AS window_start, b + INTERVAL {hours} HOUR AS window_end, le, bucket FROM (
        WITH t AS (SELECT *, time_bucket(INTERVAL {hours} HOUR, ts, {_EPOCH}) AS b FROM r) {' UNION ALL '.join(parts)})"""


_ratios = """h AS (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts,
    count(*) FILTER (WHERE status_code = '500') / count(*) AS e, count(*) FILTER (WHERE status_code = '403') / count(*) AS a
    FROM r GROUP BY 1)"""


def _states(where: str = "TRUE") -> str:
    """Islands of true hours by numbering all hours and the true ones."""
    return f"""f AS (SELECT 'ErrorRateAlto' AS alert, 'warning' AS severity, ts, e AS figure, 7200 AS hold FROM h WHERE {where}
        UNION ALL SELECT 'TasaAutenticacionFallida', 'warning', ts, a, 3600 FROM h WHERE {where}),
    i AS (SELECT *, figure > 0.2 AS t, epoch(ts) / 3600 - row_number() OVER (PARTITION BY alert, figure > 0.2 ORDER BY ts) AS island FROM f),
    s AS (SELECT alert, severity, ts, figure, CASE WHEN t THEN min(ts) OVER (PARTITION BY alert, t, island) END AS active_since,
        CASE WHEN NOT t THEN 'inactive' WHEN epoch(ts) - epoch(min(ts) OVER (PARTITION BY alert, t, island)) >= hold
             THEN 'firing' ELSE 'pending' END AS state FROM i)"""


def _keyed_states(where: str = "TRUE") -> tuple[str, ...]:
    """States of the error rule over all requests and of the latency rule for each endpoint."""
    return (
        _ratios,
        """l AS (SELECT endpoint, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, count(*) FILTER (WHERE latency > 30) / count(*) AS g FROM r GROUP BY ALL)""",
        f"""f AS (SELECT 'ErrorRateAlto' AS alert, 'warning' AS severity, 'all' AS series, ts, e AS figure, 0.2 AS threshold, 7200 AS hold FROM h WHERE {where}
            UNION ALL SELECT 'LatenciaForecastAlta', 'warning', endpoint, ts, g, 0.4, 3600 FROM l WHERE {where})""",
        """i AS (SELECT *, figure > threshold AS t, epoch(ts) / 3600 - row_number() OVER (PARTITION BY alert, series, figure > threshold ORDER BY ts) AS island FROM f)""",
        """s AS (SELECT alert, severity, series, ts, figure, CASE WHEN t THEN min(ts) OVER (PARTITION BY alert, series, t, island) END AS active_since,
            CASE WHEN NOT t THEN 'inactive' WHEN epoch(ts) - epoch(min(ts) OVER (PARTITION BY alert, series, t, island)) >= hold
                 THEN 'firing' ELSE 'pending' END AS state FROM i)""",
    )


_closed = "window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


def metrics() -> dict[str, str]:
    span = "window_start, window_end"
    error = "count(*) FILTER (WHERE status_code = '500')"
    latency = _buckets(monitoring.LATENCY_BOUNDS, 6)
    days = _buckets(monitoring.RANGE_DAYS_BOUNDS, 24)
    rate3 = f"SELECT endpoint, {span}, round(count(*) / 10800, 6) AS rate FROM w GROUP BY ALL"
    changes = """d AS (SELECT endpoint, date_trunc('second', ts) AS ts, 1 AS d FROM r
        UNION ALL SELECT endpoint, date_trunc('second', ts + to_microseconds(CAST(round(latency * 1000000) AS BIGINT))), -1 FROM r)"""
    return {
        "ts_counter_rate": _rate("endpoint, instance", "1", "endpoint"),
        "ts_byte_throughput": _rate("endpoint", "bytes", ""),
        "ts_rate_by_label": _with(rate3, _windows("r", 3)),
        "ts_error_ratio": _with(
            f"SELECT {span}, {error} AS errores, count(*) AS total, round({error} / count(*), 6) AS ratio FROM w GROUP BY ALL",
            _windows("r", 6),
        ),
        "ts_histogram_buckets": _with(
            f"SELECT *, 'latency' AS metric FROM ({latency}) UNION ALL SELECT *, 'range_days' FROM ({days})"
        ),
        "ts_histogram_quantile": _with(
            f"""SELECT endpoint, {span}, q, round(CASE WHEN le = {_INF} THEN under
                    ELSE under + (le - under) * (q * total - before) / (bucket - before) END, 6) AS quantile
                FROM (SELECT *, lag(le, 1, 0) OVER g AS under, lag(bucket, 1, 0) OVER g AS before,
                          max(bucket) OVER (PARTITION BY endpoint, window_start) AS total
                      FROM b WINDOW g AS (PARTITION BY endpoint, window_start ORDER BY le)), (VALUES (0.5), (0.95), (0.99)) v(q0),
                     LATERAL (SELECT CAST(q0 AS DOUBLE) AS q)
                WHERE bucket >= q * total AND before < q * total""",
            f"b AS ({_buckets(monitoring.LATENCY_BOUNDS, 24)})",
        ),
        "ts_sla_share": _with(
            f"SELECT endpoint, {span}, round(count(*) FILTER (WHERE latency <= 5) / count(*) * 100, 6) AS sla_pct FROM w GROUP BY ALL",
            _windows("r", 6),
        ),
        "ts_uptime": _with(
            f"SELECT {span}, round(avg(CASE WHEN status_code <> '500' THEN 1.0 ELSE 0.0 END) * 100, 6) AS uptime_pct FROM w GROUP BY ALL",
            _windows("r", 24),
        ),
        "ts_gauge_sum": _with(
            """SELECT endpoint, round(sum(latency), 6) AS total, count(*) AS series FROM (
                SELECT endpoint, latency FROM r
                QUALIFY row_number() OVER (PARTITION BY endpoint, instance ORDER BY ts DESC, latency DESC) = 1)
               GROUP BY endpoint"""
        ),
        "ts_complement_pct": _with(
            f"SELECT endpoint AS instance, {span}, round(100 - avg(increase / 21600) * 100, 6) AS figure FROM g GROUP BY ALL",
            _counters("endpoint, instance", "latency"), _windows("c", 6), _growth("endpoint, instance"),
        ),
        "ts_alert_sustained": _with(
            "SELECT alert, severity, ts, round(figure, 6) AS figure, state, active_since FROM s", _ratios, _states()
        ),
        "ts_alert_episodes": _with(
            """SELECT alert, severity, min(ts) AS started_at, max(ts) AS ended_at,
                   CASE WHEN count(next) = count(*) THEN max(next) END AS resolved_at,
                   1 + CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 3600) AS BIGINT) AS notices
               FROM (SELECT *, lead(ts) OVER (PARTITION BY alert ORDER BY ts) AS next FROM s)
               WHERE state = 'firing' GROUP BY alert, severity, active_since""",
            _ratios, _states(),
        ),
        "ts_in_progress": _with(
            """SELECT endpoint, ts, CAST(sum(d) OVER (PARTITION BY endpoint ORDER BY ts) AS BIGINT) AS in_progress
               FROM (SELECT endpoint, ts, sum(d) AS d FROM d GROUP BY ALL)""",
            changes,
        ),
        "ts_counter_error_ratio": _with(
            """SELECT window_start, window_end, round(sum(CASE WHEN status_code = '500' THEN increase ELSE 0 END) / nullif(sum(increase), 0), 6) AS figure
               FROM g GROUP BY ALL""",
            _counters("status_code, endpoint, instance", "1"), _windows("c", 6), _growth("status_code, endpoint, instance"),
        ),
        "ts_counter_quantile": _with(
            f"""SELECT window_start, window_end, round(min_by(CASE WHEN le = {_INF} THEN under
                    ELSE under + (le - under) * (0.95 * total - before) / (bucket - before) END, le) FILTER (WHERE bucket >= 0.95 * total AND total > 0), 6) AS figure
                FROM (SELECT *, lag(le, 1, 0) OVER o AS under, lag(bucket, 1, 0) OVER o AS before, max(bucket) OVER (PARTITION BY window_start) AS total
                      FROM (SELECT window_start, window_end, le, sum(increase) AS bucket FROM g GROUP BY ALL)
                      WINDOW o AS (PARTITION BY window_start ORDER BY le))
                GROUP BY ALL""",
            f"""c AS (SELECT le, endpoint, ts, CAST(sum(n) OVER (PARTITION BY le, endpoint, CAST(ts AS DATE) ORDER BY ts) AS DOUBLE) AS value
                FROM (SELECT le, endpoint, date_trunc('hour', ts) AS ts, count(*) FILTER (WHERE latency <= le) AS n
                      FROM r, (SELECT unnest([5, 25, 50, 100, 200, {_INF}]) AS le) GROUP BY ALL))""",
            _windows("c", 6), _growth("le, endpoint"),
        ),
        "ts_memory_pct": _with(
            """SELECT endpoint AS instance, date_trunc('hour', ts) AS ts, min(latency) AS free, round(sum(latency), 6) AS whole,
                   round((1 - min(latency) / nullif(sum(latency), 0)) * 100, 6) AS figure FROM r GROUP BY ALL"""
        ),
        "stream_counter_rate": _rate("endpoint, instance", "1", "endpoint").replace(
            "FROM g GROUP BY ALL", "FROM g WHERE window_end <= (SELECT max(ts) FROM c) GROUP BY ALL"
        ),
        "stream_rate_by_label": _with(f"SELECT * FROM ({rate3}) WHERE {_closed}", _windows("r", 3)),
        "stream_error_ratio": _with(
            f"""SELECT * FROM (SELECT {span}, {error} AS errores, count(*) AS total, round({error} / count(*), 6) AS ratio
                FROM w GROUP BY ALL) WHERE {_closed}""",
            _windows("r", 1),
        ),
        "stream_uptime": _with(
            f"""SELECT * FROM (SELECT {span}, round((count(*) - {error}) / count(*) * 100, 6) AS uptime_pct
                FROM w GROUP BY ALL) WHERE {_closed}""",
            _windows("r", 1),
        ),
        "stream_alert_sustained": _with(
            "SELECT alert, severity, series, ts, round(figure, 6) AS figure, state, active_since FROM s",
            *_keyed_states("ts <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"),
        ),
        "stream_alert_episodes": _with(
            "SELECT * FROM e WHERE resolved_at IS NOT NULL",
            *_keyed_states("ts <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"),
            """a AS (SELECT alert, severity, ts, max(state = 'firing') AS f FROM s GROUP BY ALL)""",
            """n AS (SELECT *, lead(ts) OVER w AS next, CASE WHEN NOT f OR ts - lag(ts) OVER w > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS b
                FROM a WINDOW w AS (PARTITION BY alert ORDER BY ts))""",
            "k AS (SELECT *, sum(b) OVER (PARTITION BY alert ORDER BY ts) AS island FROM n)",
            """e AS (SELECT alert, severity, min(ts) AS started_at, max(ts) AS ended_at, arg_max_null(next, ts) AS resolved_at,
                1 + CAST(floor((epoch(max(ts)) - epoch(min(ts))) / 3600) AS BIGINT) AS notices FROM k WHERE f GROUP BY alert, severity, island)""",
        ),
        "ts_alert_states_by_endpoint": _with(
            "SELECT alert, severity, series, ts, round(figure, 6) AS figure, state, active_since FROM s WHERE alert = 'LatenciaForecastAlta'",
            *_keyed_states(),
        ),
    }
