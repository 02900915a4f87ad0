"""SQL that computes the registered queries from the raw tables, for an independent check.

Each text builds on the raw tables only, never on anything the library stored. Rounding is
spelled out on decimals, because engines disagree on doubles that sit exactly half way.
"""

from __future__ import annotations

from tickloom.operators.nearest import BITS, STEPS, TABLES, hash_planes
from tickloom.operators.retrieval import CONTEXT_SEPARATOR, HITS, NO_DATA_TEXT, SYSTEM_TEXT


def _r(x: str, n: int) -> str:
    """``x`` rounded half away from zero to ``n`` decimals, as a double.

    The decimal comes from the printed number, so a double just below a tie stays below it.
    """
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def _windows_of(ticks: str, width: str) -> str:
    return f"""
        SELECT symbol,
               time_bucket(INTERVAL {width}, ts) AS window_start,
               time_bucket(INTERVAL {width}, ts) + INTERVAL {width} AS window_end,
               {_r("CASE WHEN sum(size) = 0 THEN 0 ELSE sum(price * size) / sum(size) END", 4)} AS vwap,
               {_r("min(price)", 4)} AS min_price,
               {_r("max(price)", 4)} AS max_price,
               {_r("stddev_pop(price)", 6)} AS volatility,
               {_r("max(price) - min(price)", 4)} AS price_range,
               count(*) AS trade_count,
               {_r("sum(size)", 2)} AS total_volume
        FROM {ticks} GROUP BY ALL"""


def _facts_of(windows: str) -> str:
    return f"""
        SELECT *,
               {_r("(session_high - vwap) / nullif(session_high, 0) * 100", 4)} AS drawdown_pct
        FROM (
            SELECT w.*,
                   max(max_price) OVER earlier AS session_high,
                   rank() OVER (PARTITION BY window_start ORDER BY volatility DESC NULLS LAST)
                       AS volatility_rank
            FROM {windows} w
            WINDOW earlier AS (PARTITION BY symbol ORDER BY window_start
                               ROWS UNBOUNDED PRECEDING)
        )"""


def _latest_of(facts: str) -> str:
    return f"""
        SELECT * FROM {facts} f
        WHERE window_start = (SELECT max(g.window_start) FROM {facts} g WHERE g.symbol = f.symbol)"""


def _alerts_of(latest: str, threshold: float) -> str:
    return f"""
        SELECT symbol, window_end AS alert_time, vwap AS current_vwap, session_high,
               {_r("drawdown_pct", 2)} AS drawdown_pct, {_r("volatility", 6)} AS volatility,
               volatility_rank,
               CASE WHEN drawdown_pct > {threshold} THEN 'DRAWDOWN'
                    WHEN volatility_rank = 1 THEN 'HIGHEST_VOL' ELSE 'WATCH' END AS alert_type
        FROM {latest} WHERE drawdown_pct > {threshold} OR volatility_rank <= 3"""


_CTES = {
    "ticks": """
        SELECT event_id, event_type AS symbol, value AS price,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS size, ts
        FROM events""",
    "windows": _windows_of("ticks", "5 MINUTES"),
    "hourly": _windows_of("ticks", "1 HOUR"),
    "lines": """
        SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts, l_quantity AS size,
               l_extendedprice AS price
        FROM lineitem""",
    "daily": _windows_of("lines", "1 DAY"),
    "fragments": """
        SELECT * FROM windows
        UNION ALL
        SELECT * REPLACE (window_end - INTERVAL 1 MINUTE AS window_end,
                          trade_count - 1 AS trade_count)
        FROM windows WHERE trade_count > 1""",
    "damaged": """
        SELECT * REPLACE (CASE WHEN total_volume <> 0 THEN symbol END AS symbol,
                          CASE WHEN trade_count <= 1 THEN vwap END AS vwap,
                          -volatility AS volatility)
        FROM fragments""",
    "facts": _facts_of("windows"),
    "daily_facts": _facts_of("daily"),
    "summary": f"""
        SELECT *, CASE WHEN avg_volatility > 0.05 THEN 'HIGH'
                       WHEN avg_volatility > 0.015 THEN 'MEDIUM' ELSE 'LOW' END
                  AS volatility_regime
        FROM (
            SELECT symbol, count(*) AS total_windows,
                   {_r("avg(vwap)", 2)} AS avg_vwap,
                   {_r("min(min_price)", 2)} AS session_low,
                   {_r("max(max_price)", 2)} AS session_high,
                   {_r("max(max_price) - min(min_price)", 2)} AS session_range,
                   {_r("avg(volatility)", 6)} AS avg_volatility,
                   {_r("max(volatility)", 6)} AS peak_volatility,
                   CAST(sum(trade_count) AS BIGINT) AS total_trades,
                   {_r("sum(total_volume)", 0)} AS total_volume,
                   {_r("max(drawdown_pct)", 2)} AS max_drawdown_pct,
                   min(window_start) AS session_start, max(window_end) AS last_updated
            FROM facts GROUP BY symbol
        )""",
    "latest": _latest_of("facts"),
    "daily_latest": _latest_of("daily_facts"),
    "alerts": _alerts_of("latest", 3),
    "daily_alerts": _alerts_of("daily_latest", 90),
    "tracked": f"""
        SELECT * EXCLUDE (high),
               CASE WHEN (high - vwap) / high > 0.03 THEN 'DRAWDOWN' END AS alert_type,
               CASE WHEN (high - vwap) / high > 0.03 THEN high END AS session_high,
               CASE WHEN (high - vwap) / high > 0.03
                    THEN {_r("(high - vwap) / high * 100", 2)} END AS drawdown_pct
        FROM (
            SELECT *, nullif(max(vwap) OVER (PARTITION BY symbol ORDER BY window_start
                                             ROWS UNBOUNDED PRECEDING), 0) AS high
            FROM windows
        )""",
    "closed": """
        SELECT * FROM tracked
        WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM ticks)""",
    "series": f"""
        SELECT 'T-' || (age - 1) AS point, symbol,
               {_r("(vwap - mid) / nullif(mid, 0) * 100", 4)} AS pct_from_mid
        FROM (
            SELECT f.symbol, f.vwap, (s.session_low + s.session_high) / 2 AS mid,
                   row_number() OVER (PARTITION BY f.symbol ORDER BY f.window_end DESC) AS age
            FROM facts f JOIN summary s ON s.symbol = f.symbol
        ) WHERE age <= 12""",
    "trades": """
        SELECT CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS event_type,
               l_partkey AS symbol, CAST(l_quantity AS BIGINT) AS shares,
               CAST(l_suppkey AS VARCHAR) AS portfolio_id, l_shipdate AS ts,
               l_extendedprice / nullif(l_quantity, 0) AS unit
        FROM lineitem""",
    "pnl": f"""
        SELECT event_type, symbol, shares, portfolio_id, ts,
               {_r("unit", 2)} AS price, {_r("shares * unit", 2)} AS notional,
               p_retailprice AS avg_cost, CAST(p_size AS BIGINT) AS total_shares,
               {_r("(unit - p_retailprice) * p_size", 2)} AS unrealized_pnl,
               {_r("(unit / nullif(p_retailprice, 0) - 1) * 100", 2)} AS pnl_pct
        FROM trades LEFT JOIN part ON p_partkey = symbol""",
    "messages": """
        SELECT event_id,
               CASE WHEN kind = 3 THEN 'not json' ELSE
                   '{"symbol":"' || event_type || '","price":'
                   || CASE kind WHEN 0 THEN '"' || value || '"' WHEN 2 THEN '"abc"'
                                WHEN 4 THEN 'null' WHEN 5 THEN '"NaN"' ELSE '' || value END
                   || CASE kind WHEN 1 THEN ''
                                ELSE ',"size":' || json_extract_string(props, '$.k') END
                   || CASE kind WHEN 6 THEN ''
                                ELSE ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                                     || '"' END
                   || '}' END AS body
        FROM (SELECT *, CAST(floor(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10)
                             AS INTEGER) AS kind FROM events)""",
    "decoded": """
        SELECT event_id, symbol,
               CASE WHEN isfinite(price) THEN price END AS price, size, ts, exchange,
               CASE WHEN NOT valid THEN 'not json'
                    WHEN price_text IS NULL THEN 'no price'
                    WHEN size IS NULL THEN 'no size'
                    WHEN price IS NULL OR NOT isfinite(price) THEN 'bad price'
                    WHEN ts IS NULL THEN 'bad timestamp' END AS reject_reason
        FROM (
            SELECT event_id, json_valid(body) AS valid,
                   j ->> 'symbol' AS symbol, j ->> 'price' AS price_text,
                   TRY_CAST(j ->> 'price' AS DOUBLE) AS price,
                   TRY_CAST(j ->> 'size' AS DOUBLE) AS size,
                   TRY_CAST(j ->> 'timestamp' AS TIMESTAMP) AS ts, 'unknown' AS exchange
            FROM (SELECT *, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j
                  FROM messages)
        )""",
    "usable": "SELECT symbol, price, size, ts FROM decoded WHERE reject_reason IS NULL",
    "rebuilt": _windows_of("usable", "5 MINUTES"),
    "docs": """
        SELECT 'summary_' || symbol AS id,
               'Symbol: ' || symbol || chr(10) || 'Volatility Regime: ' || volatility_regime
               || chr(10) || 'Average VWAP: $' || avg_vwap
               || chr(10) || 'Session Low: $' || session_low || ' | Session High: $' || session_high
               || chr(10) || 'Session Range: $' || session_range
               || chr(10) || 'Average Volatility: ' || CAST(avg_volatility AS DECIMAL(18,6))
               || chr(10) || 'Peak Volatility: ' || CAST(peak_volatility AS DECIMAL(18,6))
               || chr(10) || 'Max Drawdown: ' || max_drawdown_pct || '%'
               || chr(10) || 'Total Trades: ' || total_trades
               || chr(10) || 'Total Volume: $' || format('{:,}', CAST(total_volume AS BIGINT))
               || chr(10) || 'Session Start: ' || session_start
               || chr(10) || 'Last Updated: ' || last_updated AS text,
               symbol, 'portfolio_summary' AS type
        FROM summary
        UNION ALL
        SELECT 'alert_' || symbol,
               'ALERT — Symbol: ' || symbol || chr(10) || 'Alert Type: ' || alert_type
               || chr(10) || 'Current VWAP: $' || round(CAST(current_vwap AS DECIMAL(18,4)), 2)
               || chr(10) || 'Session High: $' || round(CAST(session_high AS DECIMAL(18,4)), 2)
               || chr(10) || 'Drawdown: ' || drawdown_pct || '%'
               || chr(10) || 'Volatility: ' || CAST(volatility AS DECIMAL(18,6))
               || chr(10) || 'Volatility Rank: #' || volatility_rank || ' across portfolio'
               || chr(10) || 'Alert Time: ' || alert_time,
               symbol, 'volatility_alert'
        FROM alerts
        UNION ALL
        SELECT 'latest_' || symbol,
               'Latest 5-min Window — Symbol: ' || symbol
               || chr(10) || 'VWAP: $' || CAST(vwap AS DECIMAL(18,4))
               || chr(10) || 'Volatility: ' || CAST(volatility AS DECIMAL(18,6))
               || chr(10) || 'Drawdown from session high: ' || CAST(drawdown_pct AS DECIMAL(18,4))
               || '%'
               || chr(10) || 'Session High: $' || round(CAST(session_high AS DECIMAL(18,4)), 2)
               || chr(10) || 'Window: ' || window_start || ' → ' || window_end,
               symbol, 'latest_window'
        FROM latest""",
    "centers": """
        SELECT label, list(x ORDER BY dim) AS center
        FROM (
            SELECT label, dim, avg(CAST(embedding[dim] AS DOUBLE)) AS x
            FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS dim
                  FROM embeddings)
            GROUP BY label, dim
        ) GROUP BY label""",
}

# Which named parts each part is built from.
_NEEDS = {
    "windows": ("ticks",),
    "hourly": ("ticks",),
    "daily": ("lines",),
    "daily_facts": ("daily",),
    "daily_latest": ("daily_facts",),
    "daily_alerts": ("daily_latest",),
    "fragments": ("windows",),
    "damaged": ("fragments",),
    "facts": ("windows",),
    "summary": ("facts",),
    "latest": ("facts",),
    "alerts": ("latest",),
    "tracked": ("windows",),
    "closed": ("tracked",),
    "series": ("summary",),
    "pnl": ("trades",),
    "decoded": ("messages",),
    "usable": ("decoded",),
    "rebuilt": ("usable",),
    "docs": ("summary", "alerts"),
}


def _with(final: str, *parts: str) -> str:
    """``final`` with the named parts and everything they need in front."""
    needed: list[str] = []

    def add(name: str) -> None:
        for below in _NEEDS.get(name, ()):
            add(below)
        if name not in needed:
            needed.append(name)

    for part in parts:
        add(part)
    ctes = ",\n".join(f"{name} AS ({_CTES[name]})" for name in needed)
    return f"WITH {ctes}\n{final}" if ctes else final


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _near_vectors(width: int = 64) -> str:
    """The same planes, buckets and probes; every query of the given vectors meets ``HITS`` at least."""
    planes = hash_planes(width).tolist()
    return f"""
        WITH planes AS (
            SELECT i // {BITS} AS tab, i % {BITS} AS bit, CAST(plane AS DOUBLE[]) AS plane
            FROM (SELECT unnest(range({TABLES * BITS})) AS i, unnest({planes}) AS plane)
        ), v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
                   [floor(CAST(c AS DOUBLE) * {STEPS}) FOR c IN embedding] AS x
            FROM embeddings
        ), codes AS (
            SELECT vec_id, tab,
                   CAST(sum(CASE WHEN list_dot_product(x, plane) >= 0 THEN 1 << bit ELSE 0 END) AS BIGINT) AS code
            FROM v, planes GROUP BY vec_id, tab
        ), asked AS (SELECT * FROM codes WHERE vec_id % 50 = 0),
        probes AS (
            SELECT vec_id, tab, code FROM asked
            UNION ALL
            SELECT vec_id, tab, xor(code, CAST(1 AS BIGINT) << b)
            FROM asked, (SELECT unnest(range({BITS}))::INTEGER AS b)
        ), pairs AS (
            SELECT DISTINCT p.vec_id AS query_id, c.vec_id AS doc_id
            FROM probes p JOIN codes c ON c.tab = p.tab AND c.code = p.code
        ), scored AS (
            SELECT query_id, doc_id, round(list_cosine_similarity(q.e, d.e), 9) AS score
            FROM pairs JOIN v q ON q.vec_id = query_id JOIN v d ON d.vec_id = doc_id
        )
        SELECT query_id, doc_id, round(score, 6) AS score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
        FROM scored QUALIFY rank <= {HITS}"""


_WINDOW_COLUMNS = (
    "symbol, window_start, window_end, vwap, min_price, max_price, volatility, price_range, "
    "trade_count, total_volume"
)

_TOKENS = """
    SELECT {id}, position, token,
           CASE WHEN token[1] = '$' THEN 'money' WHEN token[1] = '#' THEN 'rank'
                WHEN token IN ('HIGH', 'HIGHEST_VOL', 'DRAWDOWN') THEN 'red'
                WHEN token IN ('WATCH', 'MEDIUM') THEN 'amber'
                WHEN token = 'LOW' THEN 'green' ELSE 'number' END AS kind
    FROM (
        SELECT {id}, unnest(found) AS token, CAST(unnest(range(len(found))) AS INTEGER) AS position
        FROM (
            SELECT {id}, regexp_extract_all(text, '(\\$[\\d,.]+|\\d+\\.\\d+%?|#\\d+|\\bHIGH\\b|\\bMEDIUM\\b|\\bLOW\\b|\\bHIGHEST_VOL\\b|\\bWATCH\\b|\\bDRAWDOWN\\b)', 1) AS found
            FROM {source}
        )
    )"""


def _session_summary() -> str:
    return f"""
        SELECT symbol, count(*) AS windows, {_r("avg(vwap)", 2)} AS avg_vwap,
               {_r("min(min_price)", 2)} AS session_low, {_r("max(max_price)", 2)} AS session_high,
               {_r("avg(volatility)", 6)} AS avg_volatility,
               {_r("max(max_price) / nullif(min(min_price), 0) - 1", 4)} AS session_range_pct,
               CAST(sum(trade_count) AS BIGINT) AS total_trades,
               {_r("sum(total_volume)", 0)} AS total_volume
        FROM windows GROUP BY symbol"""


def _scan_summary() -> str:
    return f"""
        SELECT symbol, count(*) AS windows, {_r("avg(vwap)", 2)} AS avg_vwap,
               {_r("avg(volatility)", 6)} AS avg_volatility,
               CAST(sum(trade_count) AS BIGINT) AS total_trades
        FROM windows GROUP BY symbol"""


def _dq_rows() -> str:
    def failing(relation: str, check: str, column: str, source: str, test: str) -> str:
        return (
            f"SELECT '{relation}' AS relation, '{check}' AS \"check\", "
            f"'{column}' AS column_name, count(*) FILTER (WHERE {test}) AS failures FROM {source}"
        )

    rows = [
        failing("ticks", "not_null", c, "ticks", f"{c} IS NULL")
        for c in ("symbol", "price", "size", "ts")
    ]
    rows.append(failing("ticks", "not_null", "source", "ticks", "false"))
    rows += [
        failing("stg_windows", "not_null", c, "windows", f"{c} IS NULL")
        for c in ("symbol", "window_start", "vwap", "trade_count")
    ]
    rows += [
        failing("vwap_facts", "not_null", c, "facts", f"{c} IS NULL")
        for c in ("symbol", "vwap", "session_high")
    ]
    rows.append(failing("portfolio_summary", "not_null", "symbol", "summary", "symbol IS NULL"))
    rows.append(failing("volatility_alerts", "not_null", "symbol", "alerts", "symbol IS NULL"))
    rows.append(
        failing(
            "portfolio_summary",
            "unique",
            "symbol",
            "(SELECT symbol, count(*) AS n FROM summary GROUP BY symbol)",
            "n > 1",
        )
    )
    vwap = ("vwap_positive", "vwap", "vwap <= 0")
    volatility = ("volatility_not_negative", "volatility", "volatility < 0")
    drawdown = ("drawdown_not_negative", "drawdown_pct", "drawdown_pct < 0")
    for relation, source, rules in (
        ("stg_windows", "windows", (vwap, volatility)),
        ("vwap_facts", "facts", (vwap, volatility, drawdown)),
        ("volatility_alerts", "alerts", (volatility, drawdown)),
    ):
        rows += [failing(relation, check, column, source, bad) for check, column, bad in rules]
    return "\nUNION ALL\n".join(rows)


def _damaged_rows() -> str:
    tests = [
        ("not_null", c, f"{c} IS NULL") for c in ("symbol", "window_start", "vwap", "trade_count")
    ]
    tests += [("vwap_positive", "vwap", "vwap <= 0"), ("volatility_not_negative", "volatility", "volatility < 0")]
    rows = [
        f"SELECT 'damaged_windows' AS relation, '{check}' AS \"check\", '{column}' AS column_name, "
        f"count(*) FILTER (WHERE {bad}) AS failures FROM damaged"
        for check, column, bad in tests
    ]
    rows.append(
        "SELECT 'damaged_windows', 'unique', 'symbol,window_start', count(*) FROM "
        "(SELECT symbol, window_start FROM damaged GROUP BY ALL HAVING count(*) > 1)"
    )
    return "\nUNION ALL\n".join(rows)


def _contract_rows() -> str:
    text, number, whole, time = "string", "double", "bigint", "timestamp"
    promised = {
        ("vwap_facts", "facts", ("symbol", "window_start", "vwap", "session_high")): {
            "symbol": text,
            "window_start": time,
            "window_end": time,
            "vwap": number,
            "min_price": number,
            "max_price": number,
            "volatility": number,
            "price_range": number,
            "trade_count": whole,
            "total_volume": number,
            "session_high": number,
            "drawdown_pct": number,
            "volatility_rank": whole,
        },
        ("portfolio_summary", "summary", ("symbol", "volatility_regime")): {
            "symbol": text,
            "total_windows": whole,
            "avg_vwap": number,
            "session_low": number,
            "session_high": number,
            "session_range": number,
            "avg_volatility": number,
            "peak_volatility": number,
            "total_trades": whole,
            "total_volume": number,
            "max_drawdown_pct": number,
            "session_start": time,
            "last_updated": time,
            "volatility_regime": text,
        },
        ("volatility_alerts", "alerts", ("symbol", "alert_type")): {
            "symbol": text,
            "alert_time": time,
            "current_vwap": number,
            "session_high": number,
            "drawdown_pct": number,
            "volatility": number,
            "volatility_rank": whole,
            "alert_type": text,
        },
    }
    rows = []
    for (relation, source, required), columns in promised.items():
        for name, kind in columns.items():
            nulls = f"count(*) FILTER (WHERE {name} IS NULL)" if name in required else "0"
            duck = f"lower(any_value(typeof({name})))"
            actual = f"CASE {duck} WHEN 'varchar' THEN 'string' ELSE {duck} END"
            rows.append(
                f"SELECT '{relation}' AS relation, '{name}' AS column_name, "
                f"'{kind}' AS promised_type, {actual} AS actual_type, "
                f"{str(name in required).lower()} AS required, "
                f"CAST({nulls} AS BIGINT) AS null_rows FROM {source}"
            )
    return (
        "SELECT *, promised_type = actual_type AND null_rows = 0 AS ok FROM ("
        + "\nUNION ALL\n".join(rows)
        + ")"
    )


def oracles() -> dict[str, str]:
    w = _WINDOW_COLUMNS
    iso = "strftime({}, '%Y-%m-%dT%H:%M:%S+00:00') AS {}"
    metrics = "vwap, min_price, max_price, volatility, price_range, trade_count, total_volume"
    return {
        "vwap_windows": _with(f"SELECT {w} FROM windows", "windows"),
        "vwap_windows_hourly": _with(f"SELECT {w} FROM hourly", "hourly"),
        "window_open_close": _with(
            """SELECT *, CASE WHEN close_price >= open_price THEN 'UP' ELSE 'DOWN' END AS direction
               FROM (SELECT symbol, time_bucket(INTERVAL 5 MINUTES, ts) AS window_start,
                            first(price ORDER BY ts, price) AS open_price,
                            last(price ORDER BY ts, price) AS close_price
                     FROM ticks GROUP BY ALL)""",
            "ticks",
        ),
        "lake_scan": _with(
            f"SELECT {w}, strftime(window_start, '%Y-%m-%d') AS date FROM windows", "windows"
        ),
        "lake_union": _with(f"SELECT {w} FROM fragments", "fragments"),
        "full_scan_count": _with("SELECT count(*) AS row_count FROM windows", "windows"),
        "windows_per_symbol": _with(
            "SELECT symbol, count(*) AS windows FROM windows GROUP BY symbol", "windows"
        ),
        "symbol_filter": _with(f"SELECT {w} FROM windows WHERE symbol = 'purchase'", "windows"),
        "stg_windows": _with(
            f"""SELECT {w} FROM fragments
                QUALIFY row_number() OVER (
                    PARTITION BY symbol, window_start
                    ORDER BY window_end DESC, trade_count DESC, vwap DESC) = 1""",
            "fragments",
        ),
        "vwap_facts": _with(
            f"SELECT {w}, session_high, drawdown_pct, volatility_rank FROM facts", "facts"
        ),
        "supplier_windows": _with(f"SELECT {w} FROM daily", "daily"),
        "supplier_facts": _with(
            f"SELECT {w}, session_high, drawdown_pct, volatility_rank FROM daily_facts",
            "daily_facts",
        ),
        "supplier_alerts": _with("SELECT * FROM daily_alerts", "daily_alerts"),
        "portfolio_summary": _with("SELECT * FROM summary", "summary"),
        "volatility_alerts": _with("SELECT * FROM alerts", "alerts"),
        "volatility_regime": _with("SELECT symbol, volatility_regime FROM summary", "summary"),
        "session_summary": _with(_session_summary(), "windows"),
        "scan_summary": _with(_scan_summary(), "windows"),
        "latest_window": _with(
            f"""SELECT symbol, window_end, {_r("vwap", 2)} AS vwap,
                       {_r("volatility", 6)} AS volatility, trade_count,
                       {_r("total_volume", 0)} AS total_volume
                FROM windows QUALIFY window_end = max(window_end) OVER (PARTITION BY symbol)""",
            "windows",
        ),
        "latest_facts": _with(
            """SELECT symbol, window_start, window_end, vwap, volatility, drawdown_pct, session_high
               FROM latest""",
            "latest",
        ),
        "latest_scan": _with(
            """SELECT symbol, arg_max(vwap, window_end) AS vwap,
                      arg_max(volatility, window_end) AS volatility
               FROM windows GROUP BY symbol""",
            "windows",
        ),
        "drawdown_vs_session": _with(
            f"""SELECT symbol, {_r("vwap", 2)} AS current_vwap, {_r("high", 2)} AS session_high,
                       {_r("(high - vwap) / high * 100", 2)} AS drawdown_pct, window_end
                FROM (SELECT *, max(max_price) OVER (PARTITION BY symbol) AS high,
                             max(window_end) OVER (PARTITION BY symbol) AS last_end
                      FROM windows)
                WHERE window_end = last_end AND (high - vwap) / nullif(high, 0) > 0.03""",
            "windows",
        ),
        "volatility_trend": _with(
            f"""SELECT symbol, window_start, {_r("vwap", 2)} AS vwap,
                       {_r("volatility", 6)} AS volatility, trade_count FROM windows""",
            "windows",
        ),
        "stream_drawdown": _with(
            f"SELECT {w}, alert_type, session_high, drawdown_pct FROM tracked", "tracked"
        ),
        "kpi_totals": _with(
            f"""SELECT CAST(sum(total_trades) AS BIGINT) AS total_trades,
                       {_r("sum(total_volume) / 1e6", 2)} AS total_volume_millions,
                       count(*) AS symbols,
                       count(*) FILTER (WHERE volatility_regime = 'HIGH') AS high_regime,
                       count(*) FILTER (WHERE volatility_regime = 'MEDIUM') AS medium_regime,
                       (SELECT count(*) FROM alerts) AS active_alerts
                FROM summary""",
            "summary",
            "alerts",
        ),
        "ticker_strip": _with(
            f"""SELECT symbol, {_r("avg_vwap", 2)} AS price,
                       {_r("(session_high - session_low) / nullif(session_low, 0) * 100", 2)}
                           AS change_pct,
                       CASE WHEN avg_vwap > (session_low + session_high) / 2
                            THEN 'UP' ELSE 'DOWN' END AS direction,
                       volatility_regime
                FROM summary""",
            "summary",
        ),
        "portfolio_table": _with(
            f"""SELECT symbol, avg_vwap AS vwap, session_low, session_high,
                       {_r("avg_volatility", 4)} AS volatility, volatility_regime,
                       max_drawdown_pct AS drawdown_pct, total_trades FROM summary""",
            "summary",
        ),
        "alerts_feed": _with(
            f"""SELECT symbol, replace(alert_type, '_', ' ') AS label,
                       CASE alert_type WHEN 'WATCH' THEN 'amber' ELSE 'red' END AS colour,
                       {_r("current_vwap", 2)} AS vwap, {_r("volatility", 4)} AS volatility,
                       volatility_rank, drawdown_pct FROM alerts""",
            "alerts",
        ),
        "midpoint_series": _with("SELECT * FROM series", "series"),
        "midpoint_wide": _with(
            "SELECT point, "
            + ", ".join(
                f"max(pct_from_mid) FILTER (WHERE symbol = '{s}') AS {s}"
                for s in ("click", "error", "purchase", "signup", "view")
            )
            + " FROM series GROUP BY point",
            "series",
        ),
        "value_percentiles": _with(
            f"""SELECT symbol, count(*) AS row_count,
                       {_r("quantile_cont(price, 0.5)", 6)} AS p50,
                       {_r("quantile_cont(price, 0.95)", 6)} AS p95,
                       {_r("quantile_cont(price, 0.99)", 6)} AS p99
                FROM ticks GROUP BY symbol""",
            "ticks",
        ),
        "stored_percentiles": _with(
            f"""SELECT symbol, count(*) AS row_count,
                       {_r("quantile_cont(price, 0.5)", 6)} AS p50,
                       {_r("quantile_cont(price, 0.95)", 6)} AS p95,
                       {_r("quantile_cont(price, 0.99)", 6)} AS p99
                FROM ticks GROUP BY symbol""",
            "ticks",
        ),
        "position_pnl": _with("SELECT * FROM pnl", "pnl"),
        "portfolio_value": _with(
            f"""SELECT count(*) AS positions,
                       {_r("sum(coalesce(last_unit, p_retailprice) * p_size)", 2)} AS market_value
                FROM part LEFT JOIN (
                    SELECT symbol, last(unit ORDER BY ts, unit) AS last_unit
                    FROM trades GROUP BY symbol
                ) ON symbol = p_partkey""",
            "trades",
        ),
        "live_pnl": _with("SELECT * FROM pnl", "pnl"),
        "live_portfolio_value": _with(
            f"""SELECT count(*) AS positions,
                       {_r("sum(coalesce(last_unit, p_retailprice) * p_size)", 2)} AS market_value
                FROM part LEFT JOIN (
                    SELECT symbol, last(unit ORDER BY ts, unit) AS last_unit
                    FROM trades GROUP BY symbol
                ) ON symbol = p_partkey""",
            "trades",
        ),
        "decode_ticks": _with("SELECT * FROM decoded", "decoded"),
        "quarantined_ticks": _with(
            """SELECT reject_reason, count(*) AS messages FROM decoded
               WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
            "decoded",
        ),
        "decode_events": _with("SELECT CAST(symbol AS VARCHAR) AS key, "
                               "* REPLACE (CAST(symbol AS VARCHAR) AS symbol) FROM pnl", "pnl"),
        "encode_ticks": _with(
            """SELECT symbol AS key, symbol, price, size, ts, 'events' AS source,
                      'unknown' AS exchange FROM ticks""",
            "ticks",
        ),
        "normalize_ticks": _with(
            """SELECT symbol, price, size, ts - INTERVAL 2 HOURS AS ts, 'events' AS source,
                      'unknown' AS exchange, CAST(0 AS INTEGER) AS conditions FROM ticks""",
            "ticks",
        ),
        "alert_messages": _with(
            f"""SELECT symbol AS key, symbol, {iso.format("window_start", "window_start")},
                       {iso.format("window_end", "window_end")}, {metrics},
                       alert_type, session_high, drawdown_pct FROM tracked""",
            "tracked",
        ),
        "dq_damaged": _with(_damaged_rows(), "damaged"),
        "window_regimes": _with(
            """SELECT symbol, CASE WHEN volatility / 1000 > 0.05 THEN 'HIGH'
                                   WHEN volatility / 1000 > 0.015 THEN 'MEDIUM' ELSE 'LOW' END
                              AS volatility_regime, count(*) AS windows
               FROM windows GROUP BY ALL""",
            "windows",
        ),
        "dq_report": _with(_dq_rows(), "ticks", "summary", "alerts"),
        "contract_check": _with(_contract_rows(), "summary", "alerts"),
        "mirror_refresh": _with("SELECT count(*) AS row_count FROM windows", "windows"),
        "mirror_scan": _with(_scan_summary(), "windows"),
        "mirror_parity": _with(
            """SELECT 'mirrored' AS lake, 0 AS only_in_lake, 0 AS only_in_mirror
               UNION ALL
               SELECT 'grown', (SELECT count(*) FROM (FROM fragments EXCEPT ALL FROM windows)),
                      (SELECT count(*) FROM (FROM windows EXCEPT ALL FROM fragments))""",
            "fragments",
        ),
        "render_docs": _with("SELECT * FROM docs", "docs"),
        "ingest_docs": _with(
            "SELECT *, 384 AS dimensions, CAST(1 AS DOUBLE) AS norm FROM docs", "docs"
        ),
        "serve_portfolio": _with(
            """SELECT 'portfolio' AS section,
                      * REPLACE (CAST(total_windows AS DOUBLE) AS total_windows,
                                 CAST(total_trades AS DOUBLE) AS total_trades)
               FROM summary
               UNION ALL BY NAME
               SELECT 'alerts' AS section,
                      * REPLACE (CAST(volatility_rank AS DOUBLE) AS volatility_rank)
               FROM alerts""",
            "summary",
            "alerts",
        ),
        "serve_in_order": _with(
            """SELECT 'portfolio' AS section, symbol,
                      row_number() OVER (ORDER BY avg_volatility DESC NULLS LAST, symbol) AS position
               FROM summary
               UNION ALL
               SELECT 'alerts', symbol, row_number() OVER (
                   ORDER BY drawdown_pct DESC NULLS LAST, volatility DESC NULLS LAST, symbol) FROM alerts""",
            "summary",
            "alerts",
        ),
        "supplier_order": _with(
            """SELECT symbol, alert_time, drawdown_pct, volatility, row_number() OVER (
                   ORDER BY drawdown_pct DESC NULLS LAST, volatility DESC NULLS LAST, symbol) AS position
               FROM daily_alerts""",
            "daily_alerts",
        ),
        "topk_cosine": _with(
            """SELECT query_id, doc_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank
               FROM (
                   SELECT c.label AS query_id, e.vec_id AS doc_id,
                          list_cosine_similarity(c.center, CAST(e.embedding AS DOUBLE[])) AS score,
                          row_number() OVER (
                              PARTITION BY c.label
                              ORDER BY list_cosine_similarity(
                                  c.center, CAST(e.embedding AS DOUBLE[])) DESC, e.vec_id
                          ) AS rank
                   FROM centers c, embeddings e
               ) WHERE rank <= 5""",
            "centers",
        ),
        "approximate_topk": _near_vectors(),
        "prompt_texts": _with(
            f"""SELECT query_id, question,
                       CASE WHEN context IS NOT NULL THEN {_text(SYSTEM_TEXT)} END AS system_text,
                       {_text("Documents:" + chr(10) * 2)} || context
                       || {_text(chr(10) * 2 + "Question: ")} || question AS user_text,
                       CASE WHEN context IS NULL THEN {_text(NO_DATA_TEXT)} END AS fallback
                FROM (VALUES (1, 'click'), (2, 'no such symbol'), (3, '   '), (4, 'purchase')) q(query_id, question)
                LEFT JOIN (
                    SELECT symbol, string_agg(text, {_text(CONTEXT_SEPARATOR)} ORDER BY id) AS context
                    FROM docs GROUP BY symbol
                ) ON symbol = question
                WHERE trim(question) <> ''""",
            "docs",
        ),
        "tag_risk_tokens": _TOKENS.format(id="doc_id", source="documents"),
        "tag_document_tokens": _with(_TOKENS.format(id="id", source="docs"), "docs"),
        "stream_quarantine": _with(
            """SELECT reject_reason, count(*) AS messages FROM decoded
               WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
            "decoded",
        ),
        "rejected_messages": _with(
            r"""SELECT event_id, reject_reason, CASE WHEN body = 'not json' THEN body ELSE
                    replace(regexp_replace(body, '("timestamp":"[^"]*)"', '\1+00:00"'),
                            '}', ',"source":"events"}') END AS value
               FROM decoded JOIN messages USING (event_id) WHERE reject_reason IS NOT NULL""",
            "decoded",
        ),
        "rebuilt_windows": _with(f"SELECT {w} FROM rebuilt", "rebuilt"),
        "stream_windows": _with(f"SELECT {w} FROM closed", "closed"),
        "stream_silent_windows": _with(f"SELECT {w} FROM windows", "windows"),
        "stream_lake": _with(
            f"SELECT {w}, strftime(window_start, '%Y-%m-%d') AS date FROM closed", "closed"
        ),
        "stored_highs": _with("SELECT symbol, max(vwap) AS vwap_high FROM windows GROUP BY symbol", "windows"),
        "mart_tables": _with("SELECT * FROM facts", "facts"),
        "table_lake": _with(_scan_summary(), "windows"),
        "stream_alerts": _with(
            f"SELECT {w}, alert_type, session_high, drawdown_pct FROM closed", "closed"
        ),
    }
