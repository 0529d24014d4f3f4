"""The queries of the catalog as plain SQL over the same tables.

Written from the definitions, not from the DataFrame code: windows come from a range per
event, percentiles from sorted lists, trees from one step per level.
"""

from __future__ import annotations

from pulsegrid.operators.boundary import CELLS, DAYS
from pulsegrid.operators.features import FEATURES
from pulsegrid.operators.forest import EULER_GAMMA, ForestParams, height_limit
from pulsegrid.operators.inject import BURST_CODES, UNUSUAL_CODES
from pulsegrid.operators.windows import Sliding
from pulsegrid.plans.catalog import (
    ANY_SPANS,
    DELAY_SECONDS,
    DRIFT_SIGMAS,
    GAP,
    LATE_BEFORE,
    RANGE,
    REPLICATES,
    RETENTION_SECONDS,
    RULE,
    SEED,
    SHORT_WINDOWS,
    SPANS,
    VERSIONS,
    WINDOWS,
)
from pulsegrid.plans.reports import POISSON
from pulsegrid.plans.training import N_SAMPLES
from pulsegrid.sources.schema import SERVICE_PROFILES

W, S = WINDOWS.width, WINDOWS.slide
PARAMS = ForestParams()
DEPTH = height_limit(PARAMS.sample_size)


def _u(*tag: object) -> str:
    text = f"concat_ws('|', {', '.join(str(t) for t in tag)})"
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE)"


def _r(value: str, digits: int = 6) -> str:
    return f"(round_even(({value})::DOUBLE, {digits}) + 0.0::DOUBLE)"


LOGS = """logs AS MATERIALIZED (
  SELECT event_id, ts, epoch_us(ts) AS us,
    CASE user_id % 3 WHEN 0 THEN 'auth-service' WHEN 1 THEN 'payments-service'
      ELSE 'inventory-service' END AS service_name,
    CASE user_id % 3 WHEN 0 THEN 'us-east-1' WHEN 1 THEN 'eu-west-1'
      ELSE 'ap-southeast-1' END AS region,
    (CASE event_type WHEN 'error' THEN (CASE event_id % 4 WHEN 0 THEN 500 WHEN 1 THEN 502
        WHEN 2 THEN 404 ELSE 400 END)
      WHEN 'signup' THEN 201 WHEN 'click' THEN 204 ELSE 200 END)::INTEGER AS status_code,
    greatest(1::DOUBLE, value) AS latency_ms,
    props AS message,
    'normal' AS anomaly_mode
  FROM events)"""


def _windows(logs: str, name: str, windows: Sliding = WINDOWS) -> str:
    width, slide = windows.width, windows.slide
    return f"""{name} AS MATERIALIZED (
  SELECT * FROM (
    SELECT l.*, ((us + {slide - 1}) // {slide}) * {slide} + i * {slide} AS e
    FROM {logs} l, range(0, {width // slide + 1}) t(i))
  WHERE e - {width} <= us)"""


def _closed(wins: str, windows: Sliding) -> str:
    """Ends the watermark has passed when all events are read."""
    held_back = windows.width + DELAY_SECONDS * 1_000_000
    return f"(SELECT max(e) - {held_back} FROM {wins})"


def _in_time(cte: str) -> str:
    """The same without the events that come too late."""
    late = f"event_id % 50 = 0 AND ts < TIMESTAMP '{LATE_BEFORE}'"
    return cte.replace("FROM events", f"FROM events WHERE NOT ({late})")


def _without_gap(cte: str) -> str:
    """The same without the days in which a service sent nothing."""
    service, start, stop = GAP
    assert service == "payments-service"
    gap = f"user_id % 3 = 1 AND ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{stop}'"
    return cte.replace("FROM events", f"FROM events WHERE NOT ({gap})")


#: Ends that the one live stream has closed when all events are read.
RUN_TO = f"(SELECT ((max(us) - {DELAY_SECONDS * 1_000_000}) // {S}) * {S} FROM logs)"


def _features(wins: str, name: str) -> str:
    def pct(p: int) -> str:
        rank = f"greatest(1, ceil({p / 100}::DOUBLE * count(*)))::BIGINT"
        return f"(list_sort(list(latency_ms)))[{rank}] AS p{p}_latency_ms"

    return f"""{name}_codes AS (
  SELECT service_name, e, status_code, count(*) AS c FROM {wins} GROUP BY ALL),
{name}_entropy AS (
  SELECT service_name, e,
    abs({_r('ln(sum(c)) - sum(c * ln(c)) / sum(c)', 9)}) AS status_entropy
  FROM {name}_codes GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT w.service_name, w.e, count(*)::DOUBLE AS request_count,
    {_r('sum((status_code >= 500)::INT)::DOUBLE / count(*)', 9)} AS error_rate,
    {pct(50)}, {pct(95)}, {pct(99)}, any_value(status_entropy) AS status_entropy
  FROM {wins} w JOIN {name}_entropy h ON w.service_name = h.service_name AND w.e = h.e
  GROUP BY w.service_name, w.e)"""


def _spine(logs: str, feats: str, name: str) -> str:
    filled = ", ".join(f"coalesce(f.{c}, 0) AS {c}" for c in FEATURES)
    return f"""{name}_ends AS (
  SELECT service_name, unnest(generate_series(
      ((min(us) + {S - 1}) // {S}) * {S},
      (((SELECT max(us) FROM {logs}) + {S - 1}) // {S}) * {S}, {S})) AS e
  FROM {logs} GROUP BY service_name),
{name} AS MATERIALIZED (
  SELECT s.service_name, s.e, {filled}
  FROM {name}_ends s LEFT JOIN {feats} f ON s.service_name = f.service_name AND s.e = f.e)"""


def _corpus() -> str:
    return f"""warm AS (
  SELECT * FROM spinef QUALIFY e >= min(e) OVER (PARTITION BY service_name) + {(W // S - 1) * S}),
sizes AS (SELECT service_name, count(*) AS size FROM warm GROUP BY ALL),
quota AS (SELECT ceil({N_SAMPLES} / count(*)) AS quota FROM sizes),
corpus AS MATERIALIZED (
  SELECT * FROM warm
  QUALIFY row_number() OVER (PARTITION BY service_name
    ORDER BY {_u(PARAMS.seed, "'corpus'", 'service_name', 'e')}, e) <= (SELECT quota FROM quota))"""


def _forest() -> str:
    seed, trees, psi = PARAMS.seed, PARAMS.trees, PARAMS.sample_size
    xs = ", ".join(FEATURES)
    parts = [
        f"""shape AS (
  SELECT count(*) AS n, least({psi}, count(*)) AS wanted,
    {trees} * (4 * least({psi}, count(*)) + 64) AS offers FROM corpus),
offer AS (SELECT *, least({trees}, ceil(offers / n)) AS each FROM shape),
offered AS (
  SELECT DISTINCT c.*, CASE WHEN 2 * each >= {trees} THEN j
      ELSE floor({_u(seed, "'tree'", 'j', 'service_name', 'e')} * {trees})::INT END AS tree
  FROM corpus c, offer, range(0, {trees}) t(j)
  WHERE (2 * each >= {trees} OR j < ceil(ln(1 - each / {trees}) / ln(1 - 1 / {trees})))
    AND (offers >= n OR {_u(seed, "'pool'", 'service_name', 'e')} < offers / n)),
sample AS MATERIALIZED (
  SELECT * FROM offered
  QUALIFY row_number() OVER (PARTITION BY tree
    ORDER BY {_u(seed, "'draw'", 'tree', 'service_name', 'e')}, service_name, e)
    <= (SELECT wanted FROM shape)),
l0 AS MATERIALIZED (SELECT tree::INTEGER AS tree, 1::BIGINT AS node, [{xs}] AS x FROM sample)"""
    ]
    ranges = ", ".join(
        f"{{'f': {i}, 'lo': min(x[{i + 1}]) OVER w, 'hi': max(x[{i + 1}]) OVER w}}"
        for i in range(len(FEATURES))
    )
    for d in range(DEPTH):
        parts.append(
            f"""r{d} AS (
  SELECT tree, node, x, count(*) OVER w AS size,
    list_filter([{ranges}], lambda r: r.hi > r.lo) AS varied
  FROM l{d} WINDOW w AS (PARTITION BY tree, node)),
p{d} AS (
  SELECT tree, node, x, size,
    varied[floor({_u(seed, "'feature'", 'tree', 'node')} * len(varied))::INT + 1] AS p
  FROM r{d}),
s{d} AS MATERIALIZED (
  SELECT tree, node, x, size, p.f::INTEGER AS feature,
    p.lo + {_u(seed, "'cut'", 'tree', 'node')} * (p.hi - p.lo) AS cut
  FROM p{d}),
l{d + 1} AS MATERIALIZED (
  SELECT tree, CASE WHEN feature IS NULL THEN node
      ELSE 2 * node + (x[feature + 1] >= cut)::BIGINT END AS node, x
  FROM s{d})"""
        )
    visits = " UNION ALL ".join(
        f"SELECT tree, node, size, feature, cut FROM s{d}" for d in range(DEPTH)
    )
    parts.append(
        f"""nodes AS MATERIALIZED (
  SELECT tree, node, max(size)::BIGINT AS size, max(feature) AS feature, max(cut) AS cut
  FROM ({visits} UNION ALL
    SELECT tree, node, count(*), NULL, NULL FROM l{DEPTH} GROUP BY tree, node)
  GROUP BY tree, node)"""
    )
    return ",\n".join(parts)


def _c(n: str) -> str:
    return (
        f"CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1::DOUBLE ELSE "
        f"2::DOUBLE * (ln(({n})::DOUBLE - 1) + {EULER_GAMMA}::DOUBLE) "
        f"- 2::DOUBLE * (({n})::DOUBLE - 1) / ({n})::DOUBLE END"
    )


def _paths(feats: str, name: str) -> str:
    xs = ", ".join(FEATURES)
    parts = [
        f"{name}0 AS (SELECT service_name, e, tree::INTEGER AS tree, 1::BIGINT AS node, "
        f"[{xs}] AS x FROM {feats}, range(0, {PARAMS.trees}) t(tree))"
    ]
    for d in range(DEPTH):
        parts.append(
            f"""{name}{d + 1} AS (
  SELECT service_name, e, q.tree, CASE WHEN feature IS NULL THEN q.node
      ELSE 2 * q.node + (x[feature + 1] >= cut)::BIGINT END AS node, x
  FROM {name}{d} q JOIN nodes n ON q.tree = n.tree AND q.node = n.node)"""
        )
    parts.append(
        f"""{name} AS MATERIALIZED (
  SELECT service_name, e, q.tree, length(bin(q.node)) - 1 + {_c('size')} AS path_length
  FROM {name}{DEPTH} q JOIN nodes n ON q.tree = n.tree AND q.node = n.node)"""
    )
    return ",\n".join(parts)


def _raw(paths: str, name: str) -> str:
    scale = f"(SELECT {_c('wanted')} FROM shape)"
    return f"""{name} AS MATERIALIZED (
  SELECT service_name, e, {_r(f'-pow(2::DOUBLE, -avg(path_length) / {scale})', 9)} AS raw
  FROM {paths} GROUP BY ALL)"""


def _scores(feats: str, raw: str, name: str) -> str:
    exact = _r("raw - threshold", 9)
    return f"""{name} AS (
  SELECT f.*, {_r(exact)} AS anomaly_score, {exact} < 0 AS is_anomalous
  FROM {feats} f JOIN {raw} r ON f.service_name = r.service_name AND f.e = r.e, boundary)"""


def _inject(mode: str) -> str:
    """Columns of a log row after injection; ``mode`` is an SQL expression."""
    hit, pick = _u(SEED, "event_id", 1), _u(SEED, "event_id", 2)

    def one_of(codes: tuple[int, ...]) -> str:
        return f"({list(codes)})[floor({pick} * {len(codes)})::INT + 1]"

    status = (
        f"(CASE {mode} WHEN 'error_burst' THEN CASE WHEN {hit} < 0.8::DOUBLE "
        f"THEN {one_of(BURST_CODES)} ELSE 200 END WHEN 'unusual_status' THEN CASE WHEN {hit} "
        f"< 0.7::DOUBLE THEN {one_of(UNUSUAL_CODES)} ELSE status_code END "
        f"ELSE status_code END)::INTEGER"
    )
    latency = (
        f"CASE {mode} WHEN 'latency_spike' THEN "
        f"{_r(f'latency_ms * (20::DOUBLE + 20::DOUBLE * {hit})', 3)} ELSE latency_ms END"
    )
    return f"{status} AS status_code, {latency} AS latency_ms, {mode} AS anomaly_mode"


SPAN_ROWS = ", ".join(
    f"('{service}', TIMESTAMP '{start}', TIMESTAMP '{stop}', '{mode}')"
    for service, start, stop, mode in SPANS
)
INJECTED = f"""spans(service_name, start, stop, mode) AS (VALUES {SPAN_ROWS}),
hits AS (
  SELECT l.event_id, l.ts, l.us, l.service_name, l.status_code, l.latency_ms,
    coalesce(s.mode, l.anomaly_mode) AS mode
  FROM logs l LEFT JOIN spans s
    ON l.service_name = s.service_name AND l.ts >= s.start AND l.ts < s.stop),
logs2 AS MATERIALIZED (SELECT event_id, ts, us, service_name, {_inject('mode')} FROM hits)"""

_ANY_ROWS = ", ".join(
    f"('{service}', TIMESTAMP '{start}', TIMESTAMP '{stop}', '{mode}')" for service, start, stop, mode in ANY_SPANS
)
ANY_INJECTED = f"""spans(service_name, start, stop, mode) AS (VALUES {_ANY_ROWS}),
hits AS (
  SELECT l.event_id, l.ts, l.us, l.service_name, l.status_code, l.latency_ms,
    coalesce(s.mode, l.anomaly_mode) AS mode
  FROM logs l LEFT JOIN spans s
    ON l.service_name = s.service_name AND l.ts >= s.start AND l.ts < s.stop
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY s.start DESC, s.stop, s.mode DESC) = 1),
logs2 AS MATERIALIZED (SELECT event_id, ts, us, service_name, {_inject('mode')} FROM hits)"""

_FEATURED = [LOGS, _windows("logs", "wins"), _features("wins", "feats")]
_SPINED = [*_FEATURED, _spine("logs", "feats", "spinef")]
_SAMPLED = [*_SPINED, _corpus()]
_GROWN = [*_SAMPLED, _forest()]
_BOUNDED = [
    *_GROWN,
    _paths("corpus", "tp"),
    _raw("tp", "traw"),
    f"boundary AS (SELECT {_r(f'quantile_cont(raw, {PARAMS.contamination})', 9)} AS threshold "
    "FROM traw)",
]
_SCORED = [*_BOUNDED, _paths("spinef", "pl"), _raw("pl", "rawf"), _scores("spinef", "rawf", "sc")]
_INJECTED_SCORES = [
    *_BOUNDED,
    INJECTED,
    _windows("logs2", "wins2"),
    _features("wins2", "feats2"),
    _spine("logs2", "feats2", "spinef2"),
    _paths("spinef2", "pl2"),
    _raw("pl2", "rawf2"),
    _scores("spinef2", "rawf2", "sc2"),
]

KEY = "service_name, make_timestamp(e) AS window_end"
ROUNDED = ", ".join(f"{_r(c)} AS {c}" for c in FEATURES)


def _live_boundaries() -> list[str]:
    """Boundaries of each day from the scores of the days before."""
    share = PARAMS.contamination
    by_day = "PARTITION BY service_name, date"
    error = f"sqrt(windows * {share * (1 - share) * (W / S)!r}::DOUBLE)"
    drift = _r(f"(flagged - windows * {share}::DOUBLE) / {error}")
    return [
        "sd AS (SELECT service_name, make_timestamp(e)::DATE AS date, anomaly_score, "
        f"floor(anomaly_score * {CELLS})::INTEGER AS cell FROM sc2)",
        "cells AS (SELECT service_name, date, cell, count(*) AS n FROM sd GROUP BY ALL)",
        "tr AS (SELECT d.service_name, d.date, c.cell, sum(c.n) AS n "
        "FROM (SELECT DISTINCT service_name, date FROM cells) d JOIN cells c "
        f"ON c.service_name = d.service_name AND c.date < d.date AND c.date >= d.date - {DAYS} GROUP BY ALL)",
        f"cum AS (SELECT *, sum(n) OVER ({by_day} ORDER BY cell) AS upto, sum(n) OVER ({by_day}) AS windows FROM tr)",
        "lb AS (SELECT service_name, date, max(windows)::BIGINT AS windows, "
        "coalesce(sum(n) FILTER (cell < 0), 0)::BIGINT AS flagged, "
        f"min(cell) FILTER (upto > windows * {share}::DOUBLE) AS edge FROM cum GROUP BY service_name, date)",
        f"dr AS (SELECT *, {drift} AS drift FROM lb)",
        f"bo AS (SELECT *, abs(drift) > {DRIFT_SIGMAS} AS drifted, CASE WHEN abs(drift) > {DRIFT_SIGMAS} "
        f"THEN edge / {CELLS}::DOUBLE ELSE 0::DOUBLE END AS boundary FROM dr)",
    ]


def _sql(parts: list[str], select: str) -> str:
    return f"WITH {',\n'.join(parts)}\n{select}"


def _feature(*names: str) -> str:
    columns = ", ".join(f"{_r(n)} AS {n}" for n in names)
    return _sql(_FEATURED, f"SELECT {KEY}, {columns} FROM feats")


def _share(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) > 0 THEN {_r(f'({part})::DOUBLE / ({whole})')} END"


def _bootstrap() -> list[str]:
    """Rates per model, service and replicate, from the labelled windows."""
    u = _u(SEED, "'weight'", "service_name", "e", "r")
    weight = " + ".join(f"(u >= {p!r}::DOUBLE)::INT" for p in POISSON)
    of = lambda condition: f"sum(CASE WHEN {condition} THEN w ELSE 0 END)"
    return [
        "judged AS (SELECT 'forest' AS model_version, service_name, e, injected, is_anomalous FROM labelled "
        f"UNION ALL SELECT 'rule', service_name, e, injected, error_rate >= {RULE}::DOUBLE FROM labelled)",
        f"drawn AS (SELECT *, {u} AS u FROM judged, range(0, {REPLICATES + 1}) t(r))",
        f"weighed AS (SELECT *, CASE WHEN r = 0 THEN 1 ELSE {weight} END AS w FROM drawn)",
        f"rates AS (SELECT model_version, service_name, r, "
        f"{_share(of('injected AND is_anomalous'), of('injected'))} AS recall, "
        f"{_share(of('NOT injected AND is_anomalous'), of('NOT injected'))} AS false_positive_rate "
        "FROM weighed GROUP BY ALL)",
    ]


def all_sql() -> dict[str, str]:
    event = "event_id, service_name, status_code, latency_ms, anomaly_mode"
    modes = ("normal", "latency_spike", "error_burst", "unusual_status")
    union = " UNION ALL ".join(
        f"SELECT event_id, service_name, {_inject(repr(m))} FROM logs" for m in modes
    )
    low, high = (f"TIMESTAMP '{t}'" for t in RANGE)
    profiles = ", ".join(f"('{name}', {rate}::DOUBLE)" for name, _, rate in SERVICE_PROFILES)
    labels = """modes2 AS (
  SELECT service_name, e, max(nullif(anomaly_mode, 'normal')) AS mode FROM wins2 GROUP BY ALL),
labelled AS (
  SELECT s.*, m.mode IS NOT NULL AS injected
  FROM sc2 s LEFT JOIN modes2 m ON s.service_name = m.service_name AND s.e = m.e),
tallies AS (
  SELECT service_name,
    count(*) FILTER (injected AND is_anomalous) AS true_positives,
    count(*) FILTER (injected AND NOT is_anomalous) AS false_negatives,
    count(*) FILTER (NOT injected AND is_anomalous) AS false_positives,
    count(*) FILTER (NOT injected AND NOT is_anomalous) AS true_negatives
  FROM labelled GROUP BY service_name)"""
    score = f"SELECT {KEY}, anomaly_score, is_anomalous FROM sc"
    return {
        "s1_decode_events": _sql(
            [LOGS],
            """SELECT event_id, event_id % 50 > 6 AS usable,
  CASE WHEN event_id % 50 > 6 THEN ts END AS ts,
  CASE WHEN event_id % 50 = 7 THEN 'unknown' WHEN event_id % 50 > 6 THEN service_name END
    AS service_name,
  CASE WHEN event_id % 50 > 6 THEN status_code END AS status_code,
  CASE WHEN event_id % 50 > 6 THEN latency_ms END AS latency_ms
FROM logs""",
        ),
        "s3_encode_events": _sql(
            [LOGS],
            "SELECT service_name AS key, ts, service_name, status_code, latency_ms, message, "
            "region, anomaly_mode FROM logs",
        ),
        "s4_score_json": _sql(
            _SCORED,
            "SELECT strftime(make_timestamp(e), '%Y-%m-%dT%H:%M:%SZ') AS timestamp, "
            "service_name, anomaly_score, is_anomalous FROM sc",
        ),
        "s5_model_store": _sql(_SCORED, score),
        "s6_archive_daily": _sql(
            [LOGS],
            "SELECT ts::DATE AS date, service_name, count(*) AS n, max(event_id) AS last_event "
            "FROM logs GROUP BY ALL",
        ),
        "s7_metrics_table": _sql(
            _SPINED, f"SELECT {KEY}, {ROUNDED}, make_timestamp(e)::DATE AS date FROM spinef"
        ),
        "s8_anomalies_table": _sql(
            _SCORED,
            f"SELECT {KEY}, anomaly_score, make_timestamp(e)::DATE AS date FROM sc "
            "WHERE is_anomalous",
        ),
        "s9_retention": _sql(
            [LOGS],
            "SELECT event_id, ts, service_name FROM logs WHERE us >= (SELECT max(us) FROM logs) "
            f"- {RETENTION_SECONDS * 1_000_000}",
        ),
        "s9_expire": _sql(
            [LOGS],
            "SELECT strftime(ts::DATE, '%Y-%m-%d') AS day, count(*) AS n, min(event_id) AS first_event "
            f"FROM logs WHERE ts::DATE >= make_timestamp((SELECT max(us) FROM logs) - {RETENTION_SECONDS * 1_000_000})::DATE "
            "GROUP BY ALL",
        ),
        "p1_normalise": _sql(
            [LOGS],
            "SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'unknown' ELSE service_name END "
            "AS service_name, greatest(1::DOUBLE, latency_ms / 10::DOUBLE) AS latency_ms, "
            "'normal' AS anomaly_mode, ts FROM logs",
        ),
        "p3_errors": _sql(
            [LOGS],
            "SELECT event_id, service_name, status_code FROM logs WHERE status_code >= 500",
        ),
        "p4_latest_window": _sql(
            [LOGS],
            f"SELECT event_id, ts, service_name FROM logs WHERE us >= "
            f"(SELECT ((max(us) + {S - 1}) // {S}) * {S} - {W} FROM logs)",
        ),
        "p6_model_vector": _sql(
            _FEATURED,
            f"SELECT {KEY}, "
            + ", ".join(f"{_r(c)} AS x{i}" for i, c in enumerate(FEATURES))
            + " FROM feats",
        ),
        "p7_iso_stamp": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events",
        "p9_label": "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'latency_spike' "
        "ELSE 'normal' END AS label FROM events",
        "w1_window_counts": _sql(
            _FEATURED[:2], f"SELECT {KEY}, count(*) AS n FROM wins GROUP BY service_name, e"
        ),
        "w3_window_grid": _sql(_SPINED, f"SELECT {KEY} FROM spinef_ends"),
        "w4_spine_features": _sql(_SPINED, f"SELECT {KEY}, {ROUNDED} FROM spinef"),
        "w4_stream_silence": _sql(
            [
                LOGS,
                _windows("logs", "short", SHORT_WINDOWS),
                "ends AS (SELECT service_name, unnest(generate_series(min(e), "
                f"{_closed('short', SHORT_WINDOWS)}, {SHORT_WINDOWS.slide})) AS e "
                "FROM short GROUP BY service_name)",
            ],
            f"SELECT {KEY}, "
            + ", ".join(f"0::DOUBLE AS {c}" for c in FEATURES)
            + " FROM ends WHERE (service_name, e) NOT IN (SELECT (service_name, e) FROM short)",
        ),
        "w5_stream_parity": _sql(
            _FEATURED,
            f"SELECT {KEY}, {ROUNDED} FROM feats WHERE e <= {_closed('wins', WINDOWS)}",
        ),
        "w4_live_spine": _sql(
            [_without_gap(cte) for cte in _SPINED], f"SELECT {KEY}, {ROUNDED} FROM spinef WHERE e <= {RUN_TO}"
        ),
        "w5_pane_state": _sql(
            [LOGS, f"panes AS (SELECT *, ((us + {S - 1}) // {S}) * {S} AS pe FROM logs)"],
            f"SELECT service_name, make_timestamp(pe) AS pane_end, ((us + {W} - pe) // {S})::INTEGER AS reach, "
            "count(*)::BIGINT AS n FROM panes GROUP BY ALL",
        ),
        "w6_late_kept": _sql(
            [LOGS],
            "SELECT event_id, ts, service_name, latency_ms FROM logs WHERE event_id % 50 = 0 "
            f"AND ts < TIMESTAMP '{LATE_BEFORE}' AND ((us + {S - 1}) // {S}) * {S} <= {RUN_TO}",
        ),
        "w6_late_corrected": _sql(_SPINED, f"SELECT {KEY}, {ROUNDED} FROM spinef WHERE e <= {RUN_TO}"),
        "w6_late_rows": _sql(
            [_in_time(cte) for cte in _FEATURED],
            f"SELECT {KEY}, {ROUNDED} FROM feats WHERE e <= {_closed('wins', WINDOWS)}",
        ),
        "w7_restart": _sql(
            _FEATURED,
            f"SELECT {KEY}, {ROUNDED} FROM feats WHERE e <= {_closed('wins', WINDOWS)}",
        ),
        "w9_pane_counts": _sql(
            _FEATURED[:2],
            f"SELECT {KEY}, count(*) AS n, count(*) FILTER (status_code >= 500) AS errors "
            "FROM wins GROUP BY service_name, e",
        ),
        "a1_request_count": _feature("request_count"),
        "a2_error_rate": _feature("error_rate"),
        "a3_latency_percentiles": _feature("p50_latency_ms", "p95_latency_ms", "p99_latency_ms"),
        "a3_sketch_ranks": _sql(
            _FEATURED[:2],
            f"SELECT {KEY}, count(*) AS n, true AS p50_near, true AS p95_near, true AS p99_near "
            "FROM wins GROUP BY service_name, e",
        ),
        "a4_status_histogram": _sql(
            _FEATURED, f"SELECT {KEY}, status_code, c AS n FROM feats_codes"
        ),
        "a5_status_entropy": _feature("status_entropy"),
        "a6_window_features": _feature(*FEATURES),
        "a8_corpus_means": _sql(
            _SAMPLED,
            "SELECT count(*) AS windows, "
            + ", ".join(f"{_r(f'avg({c})')} AS {c}" for c in FEATURES)
            + " FROM corpus",
        ),
        "m1_balanced_corpus": _sql(_SAMPLED, f"SELECT {KEY}, {ROUNDED} FROM corpus"),
        "m2_subsample": _sql(_GROWN, f"SELECT tree::INTEGER AS tree, {KEY} FROM sample"),
        "m3_forest_nodes": _sql(
            _GROWN, f"SELECT tree, node, size, feature, {_r('cut')} AS cut FROM nodes"
        ),
        "m8_same_seed": _sql(
            _GROWN, f"SELECT tree, node, size, feature, {_r('cut')} AS cut FROM nodes"
        ),
        "m5_path_length": _sql(
            [*_GROWN, _paths("spinef", "pl")],
            f"SELECT {KEY}, tree, {_r('path_length')} AS path_length FROM pl",
        ),
        "m6_threshold": _sql(
            _BOUNDED,
            f"SELECT count(*) AS windows, count(*) FILTER ({_r('raw - threshold', 9)} < 0) "
            f"AS flagged, {_r('any_value(threshold)')} AS threshold FROM traw, boundary",
        ),
        "m6_live_boundary": _sql(
            [*_INJECTED_SCORES, *_live_boundaries()],
            "SELECT service_name, date, windows, flagged, drift, drifted, boundary, "
            "count(*) FILTER (anomaly_score < boundary) AS flagged_live "
            "FROM bo JOIN sd USING (service_name, date) GROUP BY ALL",
        ),
        "m7_scores": _sql(_SCORED, score),
        "m7_versions": _sql(
            [
                *_BOUNDED,
                _paths("spinef", "pl"),
                _raw("pl", "rawf"),
                "versions(model_version, valid_from, threshold) AS (VALUES "
                + ", ".join(
                    f"('{name}', epoch_us(TIMESTAMP '{start}'), "
                    f"(SELECT {_r(f'quantile_cont(raw, {share})', 9)} FROM traw))"
                    for name, start, share in VERSIONS
                )
                + ")",
            ],
            f"SELECT {KEY}, model_version, {_r(_r('raw - threshold', 9))} AS anomaly_score, "
            f"{_r('raw - threshold', 9)} < 0 AS is_anomalous "
            "FROM rawf ASOF LEFT JOIN versions ON rawf.e >= versions.valid_from",
        ),
        "m10_recall_bounds": _sql(
            [*_INJECTED_SCORES, labels, *_bootstrap()],
            f"SELECT model_version, service_name, "
            + ", ".join(
                f"max({c}) FILTER (r = 0) AS {c}, quantile_disc({c}, 0.025) FILTER (r > 0) AS {c}_low, "
                f"quantile_disc({c}, 0.975) FILTER (r > 0) AS {c}_high"
                for c in ("recall", "false_positive_rate")
            )
            + " FROM rates GROUP BY ALL",
        ),
        "i1_latency_spike": _sql(
            [LOGS], f"SELECT event_id, service_name, {_inject(repr('latency_spike'))} FROM logs"
        ),
        "i2_error_burst": _sql(
            [LOGS], f"SELECT event_id, service_name, {_inject(repr('error_burst'))} FROM logs"
        ),
        "i3_unusual_status": _sql(
            [LOGS], f"SELECT event_id, service_name, {_inject(repr('unusual_status'))} FROM logs"
        ),
        "i4_scoped_injection": _sql([LOGS, INJECTED], f"SELECT {event} FROM logs2"),
        "i4_any_spans": _sql([LOGS, ANY_INJECTED], f"SELECT {event} FROM logs2"),
        "i5_labelled_union": _sql(
            [LOGS],
            "SELECT anomaly_mode, service_name, status_code, count(*) AS n, "
            f"max(latency_ms) AS max_latency_ms FROM ({union}) "
            "GROUP BY anomaly_mode, service_name, status_code",
        ),
        "d1_rate_panel": _sql(
            _FEATURED[:2],
            f"SELECT {KEY}, {_r(_r(f'count(*) / {WINDOWS.width_seconds}::DOUBLE', 9))} "
            "AS requests_per_second, "
            f"{_r(_r('count(*) FILTER (status_code >= 500)::DOUBLE / count(*)', 9))} "
            "AS error_rate FROM wins GROUP BY service_name, e ORDER BY ALL",
        ),
        "d2_latency_panel": _sql(
            _FEATURED,
            f"SELECT {KEY}, p50_latency_ms, p95_latency_ms, p99_latency_ms FROM feats "
            "ORDER BY 1, 2",
        ),
        "d3_score_panel": _sql(
            _SCORED,
            f"SELECT {KEY}, anomaly_score, CASE WHEN is_anomalous THEN anomaly_score END "
            "AS flagged_score FROM sc ORDER BY 1, 2",
        ),
        "d4_alert_edges": _sql(
            [
                *_SCORED,
                "lagged AS (SELECT *, lag(is_anomalous) OVER (PARTITION BY service_name "
                "ORDER BY e) AS before FROM sc)",
            ],
            f"SELECT {KEY}, anomaly_score FROM lagged "
            "WHERE is_anomalous AND NOT coalesce(before, false)",
        ),
        "d4_stream_alerts": _sql(
            [
                *_SCORED,
                "lagged AS (SELECT *, lag(is_anomalous) OVER (PARTITION BY service_name "
                "ORDER BY e) AS before FROM sc)",
            ],
            f"SELECT {KEY}, anomaly_score FROM lagged "
            "WHERE is_anomalous AND NOT coalesce(before, false)",
        ),
        "d5_region_rollup": _sql(
            [LOGS],
            "SELECT region, service_name, count(*) AS requests, "
            f"{_r('count(*) FILTER (status_code >= 500)::DOUBLE / count(*)')} AS error_rate, "
            "max(latency_ms) AS max_latency_ms FROM logs "
            "GROUP BY ROLLUP (region, service_name)",
        ),
        "d6_detection_delay": _sql(
            _INJECTED_SCORES,
            f"""SELECT s.service_name, s.mode, s.start,
  (min(e) - epoch_us(s.start))::DOUBLE / 1000000::DOUBLE AS delay_seconds
FROM spans s LEFT JOIN sc2 ON s.service_name = sc2.service_name AND is_anomalous
  AND e >= epoch_us(s.start) AND e < epoch_us(s.stop) + {W}
GROUP BY s.service_name, s.mode, s.start""",
        ),
        "d7_confusion": _sql(
            [*_INJECTED_SCORES, labels],
            f"""SELECT *, {_share('true_positives', 'true_positives + false_negatives')} AS recall,
  {_share('false_positives', 'false_positives + true_negatives')} AS false_positive_rate
FROM tallies""",
        ),
        "d8_profile_drift": _sql(
            [
                LOGS,
                f"profiles(service_name, rate) AS (VALUES {profiles})",
                "observed AS (SELECT service_name, count(*) AS events, count(*)::DOUBLE / "
                "((SELECT max(us) - min(us) FROM logs)::DOUBLE / 1000000::DOUBLE) AS seen "
                "FROM logs GROUP BY ALL)",
            ],
            f"SELECT service_name, events, {_r('seen', 9)} AS observed_per_second, "
            f"rate AS profile_per_second, {_r('seen / rate', 9)} AS drift "
            "FROM observed FULL JOIN profiles USING (service_name)",
        ),
        "d9_time_range": _sql(
            [LOGS],
            "SELECT event_id, ts, service_name, latency_ms FROM logs "
            f"WHERE ts >= {low} AND ts < {high}",
        ),
    }
