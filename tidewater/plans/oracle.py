"""DuckDB reference SQL for the registered queries (the correctness oracle).

Written independently of the Spark operators, in DuckDB's dialect: ordered
picks are window ``row_number``s, the scorecard keeps its three CTEs and joins,
rule outputs are a ``UNION ALL``.  Shared CTEs are assembled per query, so each
string is self-contained and runs on the pre-registered table views.
"""

from __future__ import annotations

from tidewater import config
from tidewater.functions.timefmt import asof_seconds
from tidewater.sources import feeds

ASOF_S = asof_seconds(feeds.DEFAULT_ASOF)


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _case(expr: str, mapping: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return f"CASE {expr} {arms} ELSE {default} END"


def _wire(sec: str) -> str:
    ts = f"make_timestamp(({sec}) * 1000000)"
    return (f"CASE ts_format WHEN 'iso8601' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%SZ') "
            f"WHEN 'epoch_ms' THEN CAST(({sec}) * 1000 AS VARCHAR) "
            f"WHEN 'eu_slash' THEN strftime({ts}, '%d/%m/%Y %H:%M') END")


def _parse(text: str) -> str:
    ms = f"try_cast({text} AS BIGINT)"
    return (f"CASE ts_fmt WHEN 'iso8601' THEN try_strptime({text}, '%Y-%m-%dT%H:%M:%SZ') "
            f"WHEN 'epoch_ms' THEN CASE WHEN {ms} BETWEEN -62135596800000 AND 253402300799999 "
            f"THEN make_timestamp(CAST(floor({ms} / 1000) AS BIGINT) * 1000000) END "
            f"WHEN 'eu_slash' THEN try_strptime({text}, '%d/%m/%Y %H:%M') END")


def _h1(sec: str) -> str:
    """Hours to one decimal, half away from zero, from exact seconds."""
    return f"(sign({sec}) * floor((abs({sec}) * 10 + 1800) / 3600.0) / 10.0)"


def _h0text(sec: str) -> str:
    return f"CAST(CAST(round_even(({sec}) / 3600.0, 0) AS BIGINT) AS VARCHAR)"


def _ratio(num: str, den: str, scale: int) -> str:
    f = 10 ** scale
    return f"(sign({num}) * floor((abs({num}) * {2 * f} + ({den})) / (2.0 * ({den}))) / {float(f)})"


def _iso(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%dT%H:%M:%SZ')"


CARRIER_ORDER = feeds.FEED_CARRIERS
FMT = {c: fmt for c, _, _, fmt in config.CARRIERS}

FEED = f"""
feed_j AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_shipdate, o.o_custkey,
         CASE WHEN l.l_linenumber = 7 AND l.l_returnflag = 'R' THEN 8 ELSE l.l_linenumber END AS ms,
         CAST(l.l_orderkey % 5 AS INTEGER) AS k,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS od_s
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
feed_p AS (
  SELECT *, od_s + {_lst(feeds.FEED_PLANNED_OFFSET_H)}[ms] * 3600 AS planned_s FROM feed_j
),
feed_a AS (
  SELECT *, planned_s + CAST(round(l_quantity * 3600) AS BIGINT) + (l_suppkey % 60) * 60 - 7200 AS actual_s
  FROM feed_p
),
feed_c AS (
  SELECT *,
    {_lst(CARRIER_ORDER)}[k + 1] AS carrier,
    {_lst([feeds.FEED_REF_PREFIX[c][0] for c in CARRIER_ORDER])}[k + 1]
      || lpad(CAST(l_orderkey AS VARCHAR), {_lst([feeds.FEED_REF_PREFIX[c][1] for c in CARRIER_ORDER])}[k + 1], '0')
      AS clean_ref,
    {_lst([FMT[c] for c in CARRIER_ORDER])}[k + 1] AS ts_format,
    {_lst(feeds.FEED_PORTS)}[(o_custkey % 8) + 1] AS origin,
    {_lst(feeds.FEED_PORTS)}[((o_custkey % 8) + 1 + (o_custkey // 8) % 7) % 8 + 1] AS dest,
    CAST(110000 + (l_orderkey * 37 + l_partkey) % 780000 AS VARCHAR) AS pin
  FROM feed_a
),
feed_d AS (
  SELECT *,
    ms = 7 AND dest IN ('INNSA', 'INMUN') AS has_addr,
    CASE l_partkey % 5
      WHEN 0 THEN pin
      WHEN 1 THEN substr(pin, 1, 3) || ' ' || substr(pin, 4, 3)
      WHEN 2 THEN 'PIN-' || pin
      WHEN 3 THEN substr(pin, 1, 3) || '-' || substr(pin, 4, 3)
      ELSE replace(pin, '0', 'O') END AS styled_pin
  FROM feed_c
),
feed AS (
  SELECT
    substr(sha1(clean_ref || '|' || CAST(ms AS VARCHAR)), 1, 16) AS event_id,
    carrier,
    CASE WHEN l_partkey % 101 = 0 THEN 'XXXX' || substr(clean_ref, 5) ELSE clean_ref END AS ref,
    CASE WHEN l_partkey % 103 = 0 THEN 'STATUS_' || CAST(l_suppkey AS VARCHAR)
         ELSE {_lst(list(config.STATUS_MAP.keys()))}[ms] END AS status,
    CASE WHEN l_partkey % 107 = 0 THEN 'not-a-time' ELSE {_wire('actual_s')} END AS "timestamp",
    {_wire('planned_s')} AS planned,
    origin, dest,
    CASE WHEN ms IN (3, 4, 5) THEN CAST(o_custkey % 75 AS VARCHAR) END AS vessel_mmsi,
    CASE WHEN has_addr THEN 'Unit ' || CAST(l_linenumber AS VARCHAR) || ', Dock Road '
         || CAST(l_suppkey % 90 + 10 AS VARCHAR) || ', '
         || CASE WHEN dest = 'INNSA' THEN 'Navi Mumbai' ELSE 'Kutch' END
         || CASE WHEN l_partkey % 20 = 0 THEN '' ELSE ' ' || styled_pin END END
      AS delivery_address,
    CASE WHEN has_addr THEN 'EWB' || CAST(l_orderkey AS VARCHAR) END AS eway_bill_no,
    CASE WHEN has_addr THEN {_wire(f"actual_s + {_lst(feeds.FEED_EWAY_VALID_H)}[l_partkey % 3 + 1] * 3600")}
      END AS eway_valid_until,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice
  FROM feed_d
)"""

_REF_OK = " ".join(f"WHEN '{c}' THEN regexp_matches(coalesce(ref, ''), '{pat}')"
                   for c, _, pat, _ in config.CARRIERS)
_STATUS = _case("status", {k: f"'{v}'" for k, v in config.STATUS_MAP.items()})
_MSIDX = _case("event_type", {m: str(i) for m, i in config.MILESTONE_INDEX.items()})

CLASSIFY = f"""
cls_a AS (
  SELECT *, {_case('carrier', {c: f"'{f}'" for c, f in FMT.items()})} AS ts_fmt,
         coalesce(CASE carrier {_REF_OK} END, false) AS ref_ok,
         {_STATUS} AS event_type
  FROM feed
),
cls_b AS (
  SELECT *, {_parse('"timestamp"')} AS actual, {_parse('planned')} AS planned_t,
         {_parse('eway_valid_until')} AS eway_t
  FROM cls_a
),
classified AS (
  SELECT *,
    CASE WHEN event_id IS NULL THEN 'malformed_record'
         WHEN NOT ref_ok THEN 'unmapped_ref'
         WHEN event_type IS NULL THEN 'unknown_status'
         WHEN actual IS NULL OR planned_t IS NULL THEN 'unparseable_time' END AS reason,
    {_MSIDX} AS ms_idx
  FROM cls_b
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_orderkey, l_linenumber, l_partkey,
            l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS rn
  FROM classified WHERE reason IS NULL
),
dedup AS (SELECT * FROM ranked WHERE rn = 1),
silver AS (
  SELECT event_id, ref AS shipment_id, carrier, event_type, planned_t AS planned_ts, actual AS actual_ts,
         nullif(origin, '') AS origin, nullif(dest, '') AS dest, nullif(vessel_mmsi, '') AS vessel_mmsi,
         ms_idx, CAST(epoch(actual) AS BIGINT) AS actual_s, CAST(epoch(planned_t) AS BIGINT) AS planned_s
  FROM dedup
),
silver_asof AS (SELECT * FROM silver WHERE actual_s <= __ASOF__),
last_mile AS (
  SELECT ref AS shipment_id, delivery_address AS address_raw,
    nullif(regexp_replace(
      regexp_extract(translate(delivery_address, '{config.PIN_CONFUSABLES_FROM}', '{config.PIN_CONFUSABLES_TO}'),
        '^.*(^|[^0-9])([1-8][0-9]{{2}}\\s*[- ]?\\s*[0-9]{{3}})([^0-9].*)?$', 2),
      '[^0-9]', '', 'g'), '') AS pincode,
    eway_bill_no, eway_t AS eway_valid_until, CAST(epoch(actual) AS BIGINT) AS actual_s,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice
  FROM dedup WHERE length(delivery_address) > 0
),
lm_latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY shipment_id ORDER BY l_orderkey DESC, l_linenumber DESC,
              l_partkey DESC, l_suppkey DESC, l_shipdate DESC, l_quantity DESC, l_extendedprice DESC) AS rn
    FROM last_mile WHERE actual_s <= __ASOF__) WHERE rn = 1
)"""

STATE = """
s_rows AS (
  SELECT *,
    row_number() OVER (PARTITION BY shipment_id ORDER BY ms_idx DESC, actual_s DESC, event_id DESC) AS rn_last,
    row_number() OVER (PARTITION BY shipment_id ORDER BY ms_idx, actual_s, event_id) AS rn_first,
    row_number() OVER (PARTITION BY shipment_id ORDER BY actual_s DESC, event_id DESC) AS rn_latest,
    row_number() OVER (PARTITION BY shipment_id, event_type ORDER BY actual_s DESC, event_id DESC) AS rn_tl,
    row_number() OVER (PARTITION BY shipment_id, event_type ORDER BY actual_s, event_id) AS rn_tf,
    row_number() OVER (PARTITION BY shipment_id, vessel_mmsi IS NULL ORDER BY actual_s, event_id) AS rn_v
  FROM silver
),
st AS (
  SELECT shipment_id, count(*) AS n_events,
    max(CASE WHEN rn_last = 1 THEN event_type END) AS last_type,
    max(CASE WHEN rn_last = 1 THEN carrier END) AS last_carrier,
    max(CASE WHEN rn_last = 1 THEN actual_s END) AS last_actual_s,
    max(CASE WHEN rn_last = 1 THEN planned_s END) AS last_planned_s,
    max(CASE WHEN rn_last = 1 THEN origin END) AS last_origin,
    max(CASE WHEN rn_last = 1 THEN dest END) AS last_dest,
    max(CASE WHEN rn_first = 1 THEN planned_s END) AS first_planned_s,
    max(CASE WHEN rn_latest = 1 THEN dest END) AS latest_dest,
    max(CASE WHEN rn_v = 1 AND vessel_mmsi IS NOT NULL THEN vessel_mmsi END) AS fv_mmsi,
    max(CASE WHEN rn_v = 1 AND vessel_mmsi IS NOT NULL THEN origin END) AS fv_origin,
    max(CASE WHEN rn_v = 1 AND vessel_mmsi IS NOT NULL THEN dest END) AS fv_dest,
    bool_or(vessel_mmsi IS NOT NULL) AS has_vessel,
    max(CASE WHEN event_type = 'vessel_departed' AND rn_tf = 1 THEN planned_s END) AS first_dep_planned_s,
    bool_or(event_type = 'vessel_departed') AS has_dep,
    max(CASE WHEN event_type = 'vessel_departed' AND rn_tl = 1 THEN actual_s END) AS dep_actual_s,
    max(CASE WHEN event_type = 'vessel_departed' AND rn_tl = 1 THEN planned_s END) AS dep_planned_s,
    max(CASE WHEN event_type = 'vessel_departed' AND rn_tl = 1 THEN vessel_mmsi END) AS dep_mmsi,
    bool_or(event_type = 'vessel_arrived') AS has_arr,
    max(CASE WHEN event_type = 'vessel_arrived' AND rn_tl = 1 THEN actual_s END) AS arr_actual_s,
    bool_or(event_type = 'customs_release') AS has_customs,
    bool_or(event_type = 'delivered') AS has_delivered,
    max(CASE WHEN event_type = 'delivered' AND rn_tl = 1 THEN actual_s END) AS del_actual_s
  FROM s_rows GROUP BY shipment_id
)"""

_BOX_CASE = "CASE " + " ".join(
    f"WHEN lat BETWEEN {lo[0]} AND {hi[0]} AND lon BETWEEN {lo[1]} AND {hi[1]} THEN '{name}'"
    for name, _, lo, hi in config.AIS_BOXES) + " END"

AIS = f"""
pos AS (
  SELECT CAST(user_id % 75 AS VARCHAR) AS mmsi, ts AS received_at,
    CAST({_lst([p[0] for p in feeds.AIS_POINTS])}[event_id % 4 + 1] AS DOUBLE) AS lat,
    CAST({_lst([p[1] for p in feeds.AIS_POINTS])}[event_id % 4 + 1] AS DOUBLE) AS lon,
    value / 100 AS sog
  FROM events
),
anch AS (
  SELECT mmsi, {_BOX_CASE} AS box, received_at FROM pos
  WHERE lat IS NOT NULL AND lon IS NOT NULL AND sog IS NOT NULL AND sog < {config.SOG_ANCHOR_KN}
    AND mmsi IS NOT NULL AND mmsi <> ''
),
dwell AS (
  SELECT mmsi, CAST(received_at AS DATE) AS date, box,
         CAST(count(DISTINCT date_trunc('hour', received_at)) AS BIGINT) AS anchor_hours
  FROM anch WHERE box IS NOT NULL GROUP BY ALL
),
congestion AS (
  SELECT box AS port, date, CAST(count(*) AS BIGINT) AS vessels_at_anchor,
         {_ratio('sum(anchor_hours)', 'count(*)', 1)} AS avg_dwell_h
  FROM dwell GROUP BY box, date
),
totals AS (SELECT mmsi, CAST(sum(anchor_hours) AS DOUBLE) AS anchor_hours FROM dwell GROUP BY mmsi),
statics AS (
  SELECT mmsi, imo, name, type, observed_at FROM (
    SELECT CAST(user_id % 75 AS VARCHAR) AS mmsi, CAST(9000000 + user_id AS VARCHAR) AS imo,
      trim(' VESSEL ' || CAST(user_id % 75 AS VARCHAR) || ' ' || upper(json_extract_string(props, '$.k')) || '  ')
        AS name,
      CAST(70 + event_id % 10 AS VARCHAR) AS type, ts AS observed_at,
      row_number() OVER (PARTITION BY user_id % 75 ORDER BY ts DESC, event_id ASC) AS rn
    FROM events WHERE event_type = 'signup') WHERE rn = 1
)"""

_PORT_BOX = ", ".join(
    f"('{p}', " + (f"'{b}'" if b else "NULL") + ")"
    for p in config.PORT_CODES
    for b in [next((name for name, ports, _, _ in config.AIS_BOXES if p in ports), None)])

CONDITIONS = f"""
obs AS (
  SELECT {_lst(feeds.FEED_PORTS)}[s_suppkey % 8 + 1] AS port,
    DATE '1998-06-01' + CAST(s_suppkey % 45 AS INTEGER) AS date,
    CASE WHEN s_suppkey % 11 = 0 THEN 1 ELSE 0 END AS weather_alerts,
    CAST(s_suppkey % 4 AS VARCHAR) AS weather_code,
    abs(s_acctbal) % 100 AS wind_max_kmh,
    (s_suppkey % 13) / 2.0 AS precip_mm,
    CASE WHEN s_suppkey % 13 = 0 THEN 1 ELSE 0 END AS disruption_news
  FROM supplier
),
conditions AS (
  SELECT port, date, CAST(sum(weather_alerts) AS BIGINT) AS weather_alerts, max(weather_code) AS weather_code,
    max(wind_max_kmh) AS wind_max_kmh, sum(precip_mm) AS precip_mm,
    CAST(sum(disruption_news) AS BIGINT) AS disruption_news
  FROM obs GROUP BY port, date
),
cond_latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY port ORDER BY date DESC) AS rn FROM conditions)
  WHERE rn = 1
),
cong_latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY port ORDER BY date DESC) AS rn FROM congestion)
  WHERE rn = 1
),
port_box AS (SELECT * FROM (VALUES {_PORT_BOX}) t(port, box)),
causes AS (
  SELECT pb.port,
    CASE WHEN coalesce(c.weather_alerts, 0) > 0 OR coalesce(c.wind_max_kmh >= {config.WEATHER_WIND_KMH}, false)
           THEN 'weather'
         WHEN coalesce(c.disruption_news, 0) > 0 THEN 'disruption'
         WHEN coalesce(g.vessels_at_anchor, 0) >= {config.CONGESTED_VESSELS_MIN} THEN 'congestion'
         ELSE 'unknown' END AS probable_cause
  FROM port_box pb LEFT JOIN cond_latest c ON c.port = pb.port LEFT JOIN cong_latest g ON g.port = pb.box
)"""

_GAP = _case("last_type", {m: str(g * 3600) for m, g in config.MAX_GAP_H.items() if g is not None})

RULES = f"""
st2 AS (
  SELECT st.*, {_GAP} AS gap_s, __ASOF__ - last_actual_s AS silence_s,
    coalesce(t.anchor_hours, 0.0) AS anchored, lm.eway_bill_no, CAST(epoch(lm.eway_valid_until) AS BIGINT) AS eway_s
  FROM a_st st LEFT JOIN totals t ON t.mmsi = st.dep_mmsi LEFT JOIN lm_latest lm ON lm.shipment_id = st.shipment_id
),
exc_raw AS (
  SELECT shipment_id, last_carrier, latest_dest, 'MISSED_MILESTONE' AS exception_type,
         CAST(silence_s - gap_s AS DOUBLE) AS age_s,
         'no event for ' || {_h0text('silence_s')} || 'h after ' || last_type || ' (max normal '
           || CAST(gap_s // 3600 AS VARCHAR) || 'h)' AS detail
  FROM st2 WHERE gap_s IS NOT NULL AND silence_s > gap_s
  UNION ALL
  SELECT shipment_id, last_carrier, latest_dest, 'LATE_DEPARTURE', CAST(__ASOF__ - dep_actual_s AS DOUBLE),
         'departed ' || {_h0text('dep_actual_s - dep_planned_s')} || 'h after plan'
  FROM st2 WHERE has_dep AND dep_actual_s - dep_planned_s > {config.LATE_DEPARTURE_H * 3600}
  UNION ALL
  SELECT shipment_id, last_carrier, latest_dest, 'CUSTOMS_DWELL',
         CAST(__ASOF__ - arr_actual_s - {config.CUSTOMS_DWELL_H * 3600} AS DOUBLE),
         'in customs ' || {_h0text(f'__ASOF__ - arr_actual_s')} || 'h with no release'
  FROM st2 WHERE has_arr AND NOT has_customs AND __ASOF__ - arr_actual_s > {config.CUSTOMS_DWELL_H * 3600}
  UNION ALL
  SELECT shipment_id, last_carrier, latest_dest, 'VESSEL_STALLED', (anchored - {config.VESSEL_STALLED_H}) * 3600,
         'vessel ' || dep_mmsi || ' at anchor ' || CAST(CAST(round_even(anchored, 0) AS BIGINT) AS VARCHAR)
           || 'h mid-voyage'
  FROM st2 WHERE has_dep AND NOT has_arr AND length(dep_mmsi) > 0 AND anchored > {config.VESSEL_STALLED_H}
  UNION ALL
  SELECT shipment_id, last_carrier, latest_dest, 'EWAY_BILL_EXPIRED', CAST(__ASOF__ - eway_s AS DOUBLE),
         'e-way bill ' || coalesce(eway_bill_no, '') || ' expired ' || {_h0text(f'__ASOF__ - eway_s')} || 'h ago'
  FROM st2 WHERE eway_s IS NOT NULL AND NOT has_delivered AND eway_s < __ASOF__
),
queue AS (
  SELECT substr(sha1(e.shipment_id || '|' || e.exception_type), 1, 16) AS exception_id,
    e.shipment_id, e.last_carrier AS carrier, e.exception_type,
    make_timestamp(__ASOF__::BIGINT * 1000000) AS detected_at,
    {_h1('e.age_s')} AS age_hours, e.detail, coalesce(c.probable_cause, 'unknown') AS probable_cause
  FROM exc_raw e LEFT JOIN causes c ON c.port = e.latest_dest
)"""

def _name_of(col: str, names: dict) -> str:
    return _case(col, {code: f"'{name}'" for code, name in names.items()})


_CARRIER_NAMES = {c[0]: c[1] for c in config.CARRIERS}
_PORT_NAME_OF = {p[0]: p[1] for p in config.PORTS}

# One pass over each shipment's events on a lane gives all that the scorecard counts.
GOLD = f"""
fct AS (
  SELECT *, delay_min / 60.0 AS delay_hours, origin || '-' || dest AS lane,
    {_name_of('carrier', _CARRIER_NAMES)} AS carrier_name,
    {_name_of('origin', _PORT_NAME_OF)} AS origin_name, {_name_of('dest', _PORT_NAME_OF)} AS dest_name
  FROM (SELECT *, date_diff('minute', planned_ts, actual_ts) AS delay_min FROM silver)
),
per_shipment AS (
  SELECT carrier, lane, shipment_id,
    bool_or(delay_min <= 24 * 60) FILTER (WHERE event_type = 'delivered' AND lane IS NOT NULL) AS on_time,
    date_diff('minute', max(actual_ts) FILTER (WHERE event_type = 'vessel_arrived' AND lane IS NOT NULL),
              max(actual_ts) FILTER (WHERE event_type = 'customs_release')) AS customs_min
  FROM fct GROUP BY carrier, lane, shipment_id
),
rated AS (
  SELECT *, shipment_id IN (SELECT shipment_id FROM queue WHERE exception_type = 'MISSED_MILESTONE') AS dark
  FROM per_shipment
),
counted AS (
  SELECT carrier, lane, count(*) AS n, count_if(dark) AS n_dark, count(on_time) AS n_done, count_if(on_time) AS n_on_time,
    count(customs_min) AS n_customs, sum(customs_min) AS customs_sum
  FROM rated GROUP BY carrier, lane
),
scorecard AS (
  SELECT carrier, lane, CAST(n AS BIGINT) AS shipments,
    CASE WHEN n_done > 0 THEN {_ratio('100 * n_on_time', 'n_done', 1)} END AS on_time_pct,
    {_ratio('100 * n_dark', 'n', 1)} AS mis_scan_rate,
    CASE WHEN n_customs > 0 THEN {_ratio('customs_sum', '60 * n_customs', 1)} END AS avg_customs_dwell_h
  FROM counted
),
eta_baseline AS (
  SELECT carrier, lane, event_type, CAST(count(delay_min) AS BIGINT) AS observations,
    {_ratio('CAST(round(2 * quantile_cont(delay_min, 0.5)) AS BIGINT)', '120', 2)} AS median_offset_h
  FROM fct GROUP BY ALL
)"""


def with_ctes(*blocks: str, asof_s: int = ASOF_S) -> str:
    return ("WITH " + ",".join(b.strip().rstrip(",") for b in blocks)).replace("__ASOF__", str(asof_s))


def queue_at(asof_s: int) -> str:
    """The exception queue at another instant, as a self-contained subquery."""
    return "(" + with_ctes(*FULL, asof_s=asof_s) + "\nSELECT * FROM queue)"


BASE = (FEED, CLASSIFY)
STATE_ASOF = (STATE.replace("FROM silver", "FROM silver_asof").replace("s_rows", "a_rows")
              .replace("\nst AS (", "\na_st AS ("))
FULL = (FEED, CLASSIFY, STATE, STATE_ASOF, AIS, CONDITIONS, RULES)
ALL = FULL + (GOLD,)


def sql(blocks, select: str, asof_s: int = ASOF_S) -> str:
    return with_ctes(*blocks, asof_s=asof_s) + "\n" + select.replace("__ASOF__", str(asof_s))


def _q(select: str, blocks=FULL) -> str:
    return sql(blocks, select)


_QUEUE_COLS = (f"exception_id, shipment_id, carrier, exception_type, {_iso('detected_at')} AS detected_at, "
               "age_hours, detail, probable_cause")

ORACLE: dict[str, str] = {
    "quarantine_counts": _q("SELECT reason, CAST(count(*) AS BIGINT) AS rows FROM classified "
                            "WHERE reason IS NOT NULL GROUP BY reason", BASE),
    "normalized_events": _q(f"SELECT event_id, shipment_id, carrier, event_type, {_iso('planned_ts')} AS planned_ts, "
                            f"{_iso('actual_ts')} AS actual_ts, origin, dest, vessel_mmsi FROM silver", BASE),
    "dedup_first_wins": _q(
        "SELECT c.event_id, c.copies, d.ref AS shipment_id, d.event_type, "
        f"{_iso('d.actual')} AS actual_ts, d.l_orderkey AS kept_orderkey, d.l_linenumber AS kept_linenumber, "
        "d.l_partkey AS kept_partkey, d.l_suppkey AS kept_suppkey "
        "FROM (SELECT event_id, CAST(count(*) AS BIGINT) AS copies FROM classified WHERE reason IS NULL "
        "GROUP BY event_id HAVING count(*) > 1) c JOIN dedup d ON d.event_id = c.event_id", BASE),
    "run_counters": _q(
        "SELECT CAST(count(*) AS BIGINT) AS events_read, "
        "CAST(count(DISTINCT CASE WHEN reason IS NULL THEN event_id END) AS BIGINT) AS events_processed, "
        "CAST(count(*) FILTER (WHERE reason IS NULL) - count(DISTINCT CASE WHEN reason IS NULL THEN event_id END) "
        "AS BIGINT) AS duplicates, "
        "CAST(count(*) FILTER (WHERE reason IS NOT NULL) AS BIGINT) AS quarantined_total, "
        + ", ".join(f"CAST(count(*) FILTER (WHERE reason = '{r}') AS BIGINT) AS quarantined_{r}"
                    for r in config.QUARANTINE_REASONS)
        + " FROM classified", BASE),
    "shipment_state": _q(
        "SELECT shipment_id, CAST(n_events AS BIGINT) AS n_events, last_type AS last_event_type, "
        "last_carrier AS carrier, "
        f"{_iso('make_timestamp(last_actual_s * 1000000)')} AS last_actual_ts, "
        f"{_iso('make_timestamp(first_planned_s * 1000000)')} AS first_planned_ts, latest_dest, "
        f"{_iso('make_timestamp(dep_actual_s * 1000000)')} AS departed_ts, dep_mmsi AS departed_mmsi, "
        f"{_iso('make_timestamp(arr_actual_s * 1000000)')} AS arrived_ts, has_customs AS has_customs_release, "
        f"{_iso('make_timestamp(del_actual_s * 1000000)')} AS delivered_ts FROM st",
        (FEED, CLASSIFY, STATE)),
    "exception_queue": _q(f"SELECT {_QUEUE_COLS} FROM queue"),
    "probable_cause": _q("SELECT exception_type, probable_cause, CAST(count(*) AS BIGINT) AS exceptions "
                         "FROM queue GROUP BY 1, 2"),
    "shipment_legs": _q("SELECT shipment_id, 1 AS leg_seq, 'ocean' AS mode, fv_mmsi AS vessel_mmsi, "
                        "fv_origin AS origin, fv_dest AS dest FROM st WHERE has_vessel", (FEED, CLASSIFY, STATE)),
    "last_mile_pins": _q(f"SELECT shipment_id, address_raw, pincode, eway_bill_no, "
                         f"{_iso('eway_valid_until')} AS eway_valid_until FROM last_mile", BASE),
    "anchor_hours": _q("SELECT mmsi, strftime(date, '%Y-%m-%d') AS date, box, anchor_hours FROM dwell", (AIS,)),
    "port_congestion": _q("SELECT port, strftime(date, '%Y-%m-%d') AS date, vessels_at_anchor, avg_dwell_h "
                          "FROM congestion", (AIS,)),
    "vessel_static": _q(f"SELECT mmsi, imo, name, type, {_iso('observed_at')} AS observed_at FROM statics", (AIS,)),
    "dim_vessel_full_outer": _q(
        "SELECT coalesce(o.mmsi, c.mmsi) AS mmsi, o.imo, coalesce(nullif(o.name, ''), c.name) AS vessel_name, "
        f"o.type AS ship_type, {_iso('o.observed_at')} AS observed_at "
        "FROM (VALUES " + ", ".join(f"('{m}', '{n}')" for m, n in config.VESSELS) + ") c(mmsi, name) "
        "FULL OUTER JOIN statics o ON o.mmsi = c.mmsi", (AIS,)),
    "port_conditions": _q("SELECT port, strftime(date, '%Y-%m-%d') AS date, weather_alerts, weather_code, "
                          "wind_max_kmh, precip_mm, disruption_news FROM conditions", (CONDITIONS.split("cond_latest")[0]
                                                                                        .rstrip().rstrip(","),)),
    "fct_shipment_events": _q(
        f"SELECT event_id, shipment_id, carrier, carrier_name, event_type, {_iso('planned_ts')} AS planned_ts, "
        f"{_iso('actual_ts')} AS actual_ts, delay_hours, origin, origin_name, dest, dest_name, lane, vessel_mmsi "
        "FROM fct", ALL),
    "carrier_scorecard": _q("SELECT * FROM scorecard", ALL),
    "eta_baseline": _q("SELECT * FROM eta_baseline", ALL),
    "exception_mart": _q(
        "SELECT exception_type, probable_cause, carrier, CAST(count(*) AS BIGINT) AS open_exceptions, "
        "sum(CAST(round(age_hours * 10) AS BIGINT)) / count(*) / 10.0 AS avg_age_h, max(age_hours) AS max_age_h, "
        f"CAST(count(*) FILTER (WHERE age_hours >= {config.BANDS_H[1]}) AS BIGINT) AS band2_escalations "
        "FROM queue GROUP BY 1, 2, 3"),
}

for _name, _type in [("exc_missed_milestone", "MISSED_MILESTONE"), ("exc_late_departure", "LATE_DEPARTURE"),
                     ("exc_customs_dwell", "CUSTOMS_DWELL"), ("exc_vessel_stalled", "VESSEL_STALLED"),
                     ("exc_eway_expired", "EWAY_BILL_EXPIRED")]:
    ORACLE[_name] = _q(f"SELECT {_QUEUE_COLS} FROM queue WHERE exception_type = '{_type}'")


# ---- ETA ---------------------------------------------------------------------

def _state_block(src: str, p: str) -> str:
    """The STATE block over another silver-shaped source, with prefixed names."""
    return (STATE.replace("FROM silver", f"FROM {src}").replace("s_rows", f"{p}_rows")
            .replace("\nst AS (", f"\n{p}st AS ("))


def _features(st: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT shipment_id, last_carrier AS carrier,
    coalesce(last_origin, '') || '-' || coalesce(last_dest, '') AS lane,
    last_type AS last_event_type, last_type = 'delivered' AS completed,
    first_planned_s, last_planned_s, last_actual_s, first_dep_planned_s, dep_planned_s, dep_actual_s
  FROM {st}
)"""


def _model(src: str, where: str, p: str) -> str:
    return f"""
{p}rows AS (
  SELECT carrier, lane, CAST(last_planned_s - first_planned_s AS DOUBLE) AS span_s,
    CAST(last_actual_s - last_planned_s
         - CASE WHEN dep_actual_s - dep_planned_s > 3600 THEN dep_actual_s - dep_planned_s ELSE 0 END AS DOUBLE) AS off_s,
    CASE WHEN first_dep_planned_s - first_planned_s > 0 AND last_planned_s - first_planned_s > 0
         THEN CAST(last_planned_s - first_planned_s AS DOUBLE) / (first_dep_planned_s - first_planned_s) END AS ratio
  FROM {src} WHERE {where}
),
{p}lane AS (
  SELECT carrier, lane, median(span_s) AS lane_span_s, median(off_s) AS lane_off_s FROM {p}rows GROUP BY 1, 2
),
{p}glob AS (
  SELECT coalesce(median(span_s), 0.0) AS global_span_s, coalesce(median(off_s), 0.0) AS global_off_s,
         median(ratio) AS departed_ratio, CAST(count(*) AS BIGINT) AS trained_on FROM {p}rows
)"""


ADJ = f"""
adj AS (
  SELECT shipment_id,
    sum(CASE WHEN exception_type = 'VESSEL_STALLED' THEN {config.STALL_ADJ_H * 3600}
             WHEN probable_cause = 'congestion' THEN {config.CONGESTION_ADJ_H * 3600} END) AS exc_adj_s,
    string_agg(CASE WHEN exception_type = 'VESSEL_STALLED' THEN 'vessel_stalled(+{config.STALL_ADJ_H}h)'
                    ELSE 'congestion(+{config.CONGESTION_ADJ_H}h)' END, ';' ORDER BY exception_id) AS exc_reasons
  FROM queue WHERE exception_type = 'VESSEL_STALLED' OR probable_cause = 'congestion'
  GROUP BY shipment_id
)"""


def _predict(feat: str, p: str, mart: bool, name: str) -> str:
    mart_join = ("LEFT JOIN (SELECT carrier, lane, median_offset_h * 3600 AS mart_off_s FROM eta_baseline "
                 "WHERE event_type = 'delivered') m ON m.carrier = f.carrier AND m.lane = f.lane"
                 if mart else "")
    mart_col = "m.mart_off_s" if mart else "CAST(NULL AS DOUBLE)"
    return f"""
{name}_a AS (
  SELECT f.*, g.global_span_s, g.global_off_s, g.departed_ratio, l.lane_span_s, l.lane_off_s,
         {mart_col} AS mart_off_s, a.exc_adj_s, a.exc_reasons,
         f.dep_planned_s - f.first_planned_s AS gap,
         f.dep_planned_s IS NOT NULL AND g.departed_ratio IS NOT NULL AND g.departed_ratio <> 0
           AND f.dep_planned_s - f.first_planned_s > 0 AS use_ratio,
         f.dep_actual_s - f.dep_planned_s AS dep_delay
  FROM {feat} f CROSS JOIN {p}glob g
  LEFT JOIN {p}lane l ON l.carrier = f.carrier AND l.lane = f.lane
  {mart_join}
  LEFT JOIN adj a ON a.shipment_id = f.shipment_id
),
{name}_b AS (
  SELECT *,
    CASE WHEN use_ratio THEN gap * departed_ratio WHEN lane_span_s IS NOT NULL THEN lane_span_s
         ELSE global_span_s END AS span_x,
    CASE WHEN use_ratio THEN 'planned_ratio(x' || printf('%.2f', departed_ratio) || ')'
         WHEN lane_span_s IS NOT NULL THEN 'lane_median(' || lane || ')' ELSE 'global_median' END AS span_source,
    coalesce(mart_off_s, lane_off_s, global_off_s) AS off_x,
    CASE WHEN mart_off_s IS NOT NULL THEN 'eta_baseline_mart'
         WHEN lane_off_s IS NOT NULL THEN 'lane_median(' || lane || ')' ELSE 'global_median' END AS offset_source,
    CASE WHEN dep_delay > 3600 THEN dep_delay ELSE 0 END + coalesce(exc_adj_s, 0.0) AS adj_x,
    coalesce(nullif(concat_ws(';',
      CASE WHEN dep_delay > 3600 THEN 'observed_departure_delay(+' || printf('%.1f', CAST(dep_delay AS DOUBLE) / 3600) || 'h)' END,
      exc_reasons), ''), 'none') AS adjustment_reason
  FROM {name}_a
),
{name} AS (
  SELECT shipment_id, carrier, lane, last_event_type,
    first_planned_s + CAST(floor(round_even((span_x + off_x + adj_x) * 1e6, 0) / 1e6) AS BIGINT) AS pred_s,
    first_planned_s, {_h1('span_x')} AS planned_span_h, span_source, {_h1('off_x')} AS median_offset_h,
    offset_source, {_h1('adj_x')} AS live_adjustment_h, adjustment_reason
  FROM {name}_b
)"""


_TRAIN = "substr(sha1(shipment_id), 40, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e')"
ETA_BLOCKS = ALL + (_features("a_st", "feat"), _model("feat", "completed", "m_"), ADJ,
                    _predict("(SELECT * FROM feat WHERE NOT completed)", "m_", True, "eta"))
ORACLE["shipment_eta"] = _q(
    "SELECT shipment_id, carrier, lane, last_event_type, "
    f"{_iso('make_timestamp(pred_s * 1000000)')} AS predicted_delivery_ts, "
    f"{_iso('make_timestamp(first_planned_s * 1000000)')} AS planned_anchor_ts, planned_span_h, span_source, "
    "median_offset_h, offset_source, live_adjustment_h, adjustment_reason FROM eta", ETA_BLOCKS)

MAE_BLOCKS = FULL + (
    _features("st", "feat"),
    _model("feat", f"completed AND {_TRAIN}", "t_"),
    "test_ids AS (SELECT shipment_id, last_actual_s AS actual_s FROM feat WHERE completed AND NOT " + _TRAIN + ")",
    "vis_silver AS (SELECT * FROM silver WHERE shipment_id IN (SELECT shipment_id FROM test_ids) "
    f"AND ms_idx <= {config.MILESTONE_INDEX['vessel_departed']})",
    _state_block("vis_silver", "v"),
    _features("vst", "vfeat"),
    ADJ,
    _predict("vfeat", "t_", False, "vpred"),
)
ORACLE["eta_mae"] = _q(
    "SELECT CAST(count(*) AS BIGINT) AS test_shipments, (SELECT trained_on FROM t_glob) AS train_shipments, "
    f"CASE WHEN count(*) > 0 THEN {_ratio('sum(abs(p.pred_s - t.actual_s))', '3600 * count(*)', 2)} END AS mae_hours "
    "FROM vpred p JOIN test_ids t ON t.shipment_id = p.shipment_id", MAE_BLOCKS)


# ---- alerts ------------------------------------------------------------------

PRIOR_S = ASOF_S - 72 * 3600
_BAND = " + ".join(f"CASE WHEN {{a}} >= {b} THEN 1 ELSE 0 END" for b in config.BANDS_H)


def _band(col: str) -> str:
    return "(" + _BAND.format(a=col) + ")"


_DECIDE = f"""
prior AS MATERIALIZED (SELECT exception_id, exception_type AS type, {_band('age_hours')} AS band FROM {queue_at(PRIOR_S)}),
decided AS MATERIALIZED (
  SELECT q.exception_id, q.shipment_id, q.carrier, q.exception_type, q.age_hours, q.detail,
    {_band('q.age_hours')} AS band, p.band AS prior_band,
    CASE WHEN p.band IS NULL THEN 'new' WHEN {_band('q.age_hours')} > p.band THEN 'escalated'
         ELSE 'suppressed' END AS decision
  FROM queue q LEFT JOIN prior p ON p.exception_id = q.exception_id
)"""

ORACLE["alert_decisions"] = _q(
    "SELECT exception_id, shipment_id, carrier, exception_type, age_hours, band, prior_band, decision, "
    "CASE WHEN decision <> 'suppressed' THEN "
    "CASE WHEN decision = 'escalated' THEN ':rotating_light: ESCALATION' ELSE ':package: New exception' END "
    "|| ' [' || exception_type || '] shipment ' || shipment_id || ' (' || carrier || ') — ' || detail "
    "|| ' — age ' || CAST(age_hours AS VARCHAR) || 'h' END AS message FROM decided", FULL + (_DECIDE,))

ORACLE["alert_state_next"] = _q(
    f"SELECT exception_id, type, band, {_iso(f'make_timestamp({PRIOR_S}::BIGINT * 1000000)')} AS alerted_at "
    "FROM prior ANTI JOIN (SELECT exception_id FROM decided WHERE decision <> 'suppressed') USING (exception_id) "
    "UNION ALL SELECT exception_id, exception_type AS type, band, "
    f"{_iso('make_timestamp(__ASOF__::BIGINT * 1000000)')} AS alerted_at FROM decided "
    "WHERE decision <> 'suppressed'", FULL + (_DECIDE,))

ORACLE["quarantine_spike"] = _q(
    "SELECT CAST(count(*) AS BIGINT) AS events_read, CAST(count(reason) AS BIGINT) AS quarantined_total, "
    "CASE WHEN count(*) > 0 THEN count(reason) * 100.0 / count(*) ELSE 0.0 END AS quarantine_pct, "
    f"CASE WHEN count(reason) * 100.0 / count(*) > {config.QUARANTINE_SPIKE_PCT} "
    "THEN 'ops:quarantine_spike:' || strftime(make_timestamp(__ASOF__::BIGINT * 1000000), '%Y-%m-%d') END "
    "AS exception_id, "
    f"CASE WHEN count(reason) * 100.0 / count(*) > {config.QUARANTINE_SPIKE_PCT} "
    "THEN ':warning: QUARANTINE SPIKE — ' || CAST(count(reason) AS VARCHAR) || '/' || CAST(count(*) AS VARCHAR) "
    "|| ' events (' || printf('%.1f', count(reason) * 100.0 / count(*)) || '%) quarantined this run' END AS message "
    "FROM classified", BASE)


# ---- quality -----------------------------------------------------------------

def _t_unique(tbl, col, name):
    return (f"SELECT '{name}' AS test_name, CAST(count(*) AS BIGINT) AS failures FROM "
            f"(SELECT {col} FROM {tbl} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")


def _t_not_null(tbl, col, name):
    return f"SELECT '{name}' AS test_name, CAST(count(*) AS BIGINT) AS failures FROM {tbl} WHERE {col} IS NULL"


def _t_accepted(tbl, col, values, name):
    vals = ", ".join(f"'{v}'" for v in values)
    return (f"SELECT '{name}' AS test_name, CAST(count(*) AS BIGINT) AS failures FROM "
            f"(SELECT {col} FROM {tbl} WHERE {col} NOT IN ({vals}) GROUP BY {col})")


_LEGS = ("legs AS (SELECT shipment_id FROM st WHERE has_vessel)")
ORACLE["quality_checks"] = _q(" UNION ALL ".join([
    _t_unique("fct", "event_id", "unique_fct_shipment_events_event_id"),
    _t_not_null("fct", "event_id", "not_null_fct_shipment_events_event_id"),
    _t_accepted("fct", "event_type", config.MILESTONES, "accepted_values_fct_shipment_events_event_type"),
    _t_unique("queue", "exception_id", "unique_stg_exception_queue_exception_id"),
    _t_not_null("queue", "exception_id", "not_null_stg_exception_queue_exception_id"),
    _t_accepted("queue", "probable_cause", config.PROBABLE_CAUSES,
                "accepted_values_stg_exception_queue_probable_cause"),
    _t_unique("legs", "shipment_id", "unique_fct_shipment_legs_shipment_id"),
    _t_not_null("legs", "shipment_id", "not_null_fct_shipment_legs_shipment_id"),
    _t_not_null("scorecard", "carrier", "not_null_carrier_scorecard_carrier"),
    "SELECT 'fct_events_reconcile_silver' AS test_name, CAST(CASE WHEN (SELECT count(*) FROM fct) <> "
    "(SELECT count(*) FROM silver) THEN 1 ELSE 0 END AS BIGINT) AS failures",
]), ALL + (_LEGS,))


# ---- metrics -------------------------------------------------------------------

ORACLE["run_metrics"] = _q(
    "SELECT metric, label, value FROM (" + " UNION ALL ".join(
        [f"SELECT 'events_read' AS metric, '' AS label, CAST(count(*) AS BIGINT) AS value FROM classified",
         "SELECT 'events_processed', '', CAST(count(DISTINCT event_id) FILTER (WHERE reason IS NULL) AS BIGINT) "
         "FROM classified",
         "SELECT 'duplicates', '', CAST(count(*) FILTER (WHERE reason IS NULL) - count(DISTINCT event_id) "
         "FILTER (WHERE reason IS NULL) AS BIGINT) FROM classified"]
        + [f"SELECT 'quarantined', 'reason=\"{r}\"', CAST(count(*) FILTER (WHERE reason = '{r}') AS BIGINT) "
           "FROM classified" for r in config.QUARANTINE_REASONS]
        + ["SELECT 'exceptions_by_type', 'type=\"' || exception_type || '\"', CAST(count(*) AS BIGINT) "
           "FROM queue GROUP BY exception_type",
           "SELECT 'exceptions', '', CAST(count(*) AS BIGINT) FROM queue"]) + ")")

ORACLE["slo_freshness"] = _q(
    "SELECT s.slo, __ASOF__ - max(actual_s) AS lag_s, s.target_s, __ASOF__ - max(actual_s) < s.target_s AS ok "
    "FROM silver_asof, (VALUES ('normalize_freshness', "
    f"{config.SLO_NORMALIZE_FRESHNESS_S}::BIGINT), ('feed_silence', {int(config.FEED_SILENCE_MAX_H * 3600)}::BIGINT))"
    " s(slo, target_s) GROUP BY s.slo, s.target_s", BASE)


_MROWS = "carrier_scorecard AS (SELECT * FROM scorecard), mrows AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS metric, carrier, lane, CAST({col} AS DOUBLE) AS value, "
    + (f"CAST({w} AS DOUBLE)" if w else "CAST(NULL AS DOUBLE)") + f" AS weight FROM {mart}"
    for name, (mart, col, _a, w, _u, _s) in config.METRICS.items()) + ")"
_PORTS_V = ", ".join(f"('{p}')" for p in config.PORT_CODES)
_MCOMBO = f"""
mcombo AS (
  SELECT r.*, cf.carrier_filter, pf.port_filter
  FROM mrows r
  CROSS JOIN LATERAL (SELECT NULL AS carrier_filter UNION ALL SELECT r.carrier) cf
  CROSS JOIN LATERAL (SELECT NULL AS port_filter UNION ALL
                      SELECT p FROM (VALUES {_PORTS_V}) v(p) WHERE contains(coalesce(r.lane, ''), p)) pf
)"""


def _mvalue(group_extra: str = "") -> str:
    t = "CAST(round(value * 100) AS BIGINT)"
    w = "CASE WHEN value IS NOT NULL THEN weight END"
    arms = {
        "sum": "CASE WHEN count(value) > 0 THEN sum(value) END",
        "avg": f"CASE WHEN count(value) > 0 THEN {_ratio(f'sum({t})', 'count(value) * 100', 2)} END",
        "weighted_avg": f"CASE WHEN count(value) > 0 AND sum({w}) <> 0 THEN "
                        f"{_ratio(f'sum({t} * {w})', f'round(sum({w}) * 100)', 2)} END",
        "median_of_medians": f"CASE WHEN count(value) > 0 THEN "
                             f"{_ratio(f'round(median({t}) * 2)', '200', 2)} END",
    }
    return "CASE metric " + " ".join(f"WHEN '{n}' THEN {arms[m[2]]}" for n, m in config.METRICS.items()) + " END"


_META = ", ".join(f"('{n}', '{m[0]}', '{m[1]}', '{m[2]}')" for n, m in config.METRICS.items())
_GOV = f"""
gov AS (
  SELECT g.*, md.mart, md.column_name, md.aggregation FROM (
    SELECT metric, carrier_filter, port_filter, {_mvalue()} AS value, CAST(count(*) AS BIGINT) AS rows_used
    FROM mcombo GROUP BY 1, 2, 3) g
  JOIN (VALUES {_META}) md(metric, mart, column_name, aggregation) ON md.metric = g.metric
)"""
ORACLE["governed_metric"] = _q("SELECT * FROM gov", ALL + (_MROWS, _MCOMBO, _GOV))

_LOWER = ", ".join(f"'{m}'" for m in config.LOWER_IS_BETTER)
_SUP = f"""
per_carrier AS (
  SELECT * FROM (SELECT metric, carrier_filter, port_filter, carrier, {_mvalue()} AS value
                 FROM mcombo GROUP BY 1, 2, 3, 4) WHERE value IS NOT NULL
),
ranked_c AS (
  SELECT *, row_number() OVER (PARTITION BY metric, carrier_filter, port_filter ORDER BY value, carrier) AS r_lo,
            row_number() OVER (PARTITION BY metric, carrier_filter, port_filter ORDER BY value DESC, carrier) AS r_hi
  FROM per_carrier
),
sup AS (
  SELECT metric, carrier_filter, port_filter,
    max(CASE WHEN r_lo = 1 THEN carrier END) AS lo_c, max(CASE WHEN r_lo = 1 THEN value END) AS lo_v,
    max(CASE WHEN r_hi = 1 THEN carrier END) AS hi_c, max(CASE WHEN r_hi = 1 THEN value END) AS hi_v
  FROM ranked_c GROUP BY 1, 2, 3
)"""

_PHRASES = []
_i = 0
for _n, _m in config.METRICS.items():
    for _p in [_n.replace("_", " ")] + _m[5]:
        _PHRASES.append(("metric", _n, _p, _i))
        _i += 1
for _dim, _vals in config.DIMENSION_PHRASES.items():
    for _p, _code in _vals.items():
        _PHRASES.append((_dim, _code, _p, _i))
        _i += 1
_PH_V = ", ".join(f"('{k}', '{key}', '{p}', {len(p)}, {i})" for k, key, p, i in _PHRASES)
_BEST = " OR ".join(f"contains(ql, '{w}')" for w in config.SUPERLATIVE_BEST)
_WORST = " OR ".join(f"contains(ql, '{w}')" for w in config.SUPERLATIVE_WORST)
_QUESTIONS = f"""
qs AS (
  SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS question_id, lower(text) AS ql
  FROM conversations WHERE role = 'user'
),
ph AS (SELECT * FROM (VALUES {_PH_V}) t(kind, key, phrase, plen, ord)),
hits AS (
  SELECT q.question_id, ph.kind, ph.key,
    row_number() OVER (PARTITION BY q.question_id, ph.kind ORDER BY ph.plen DESC, ph.ord) AS rn
  FROM qs q JOIN ph ON contains(q.ql, ph.phrase)
),
res AS (
  SELECT q.question_id,
    CASE WHEN {_BEST} THEN 'best' WHEN {_WORST} THEN 'worst' END AS superlative,
    max(CASE WHEN h.kind = 'metric' THEN h.key END) AS metric,
    max(CASE WHEN h.kind = 'carrier' THEN h.key END) AS carrier_filter,
    max(CASE WHEN h.kind = 'port' THEN h.key END) AS port_filter
  FROM qs q LEFT JOIN (SELECT * FROM hits WHERE rn = 1) h ON h.question_id = q.question_id
  GROUP BY q.question_id, q.ql
),
ans AS (
  SELECT r.*, g.value, g.rows_used,
    CASE WHEN r.superlative = 'best' THEN CASE WHEN r.metric IN ({_LOWER}) THEN s.lo_c ELSE s.hi_c END
         WHEN r.superlative = 'worst' THEN CASE WHEN r.metric IN ({_LOWER}) THEN s.hi_c ELSE s.lo_c END END AS sup_c,
    CASE WHEN r.superlative = 'best' THEN CASE WHEN r.metric IN ({_LOWER}) THEN s.lo_v ELSE s.hi_v END
         WHEN r.superlative = 'worst' THEN CASE WHEN r.metric IN ({_LOWER}) THEN s.hi_v ELSE s.lo_v END END AS sup_v
  FROM res r
  LEFT JOIN gov g ON g.metric IS NOT DISTINCT FROM r.metric AND g.carrier_filter IS NOT DISTINCT FROM r.carrier_filter
                 AND g.port_filter IS NOT DISTINCT FROM r.port_filter
  LEFT JOIN sup s ON s.metric IS NOT DISTINCT FROM r.metric AND s.carrier_filter IS NOT DISTINCT FROM r.carrier_filter
                 AND s.port_filter IS NOT DISTINCT FROM r.port_filter
)"""
ORACLE["question_table"] = _q(
    "SELECT question_id, metric, carrier_filter, port_filter, "
    "CASE WHEN metric IS NOT NULL AND sup_c IS NOT NULL THEN 'superlative' "
    "WHEN metric IS NOT NULL AND value IS NOT NULL THEN 'value' ELSE 'refusal' END AS kind, "
    "CASE WHEN metric IS NOT NULL AND sup_c IS NOT NULL THEN sup_c END AS entity, "
    "CASE WHEN metric IS NOT NULL AND sup_c IS NOT NULL THEN sup_v WHEN metric IS NOT NULL THEN value END AS value, "
    "CASE WHEN metric IS NOT NULL AND (sup_c IS NOT NULL OR value IS NOT NULL) THEN rows_used "
    "WHEN metric IS NOT NULL THEN 0 END AS rows_used FROM ans",
    ALL + (_MROWS, _MCOMBO, _GOV, _SUP, _QUESTIONS))

_CITED_V = ", ".join(f"('{n}', '{m[0]}', '{m[1]}', '{m[2]}', '{m[4]}', '{config.METRIC_DEFINITIONS[n]}')"
                     for n, m in config.METRICS.items())


def _num(v: str) -> str:
    return f"regexp_replace(printf('%.2f', {v}), '0$', '')"


ORACLE["question_answers"] = _q(f"""
  SELECT a.question_id, a.metric, a.carrier_filter, a.port_filter, a.kind,
    CASE WHEN a.kind = 'superlative' THEN a.sup_c END AS entity,
    CASE a.kind WHEN 'superlative' THEN a.sup_v WHEN 'value' THEN a.value END AS value,
    CASE WHEN a.kind <> 'refusal' THEN a.rows_used WHEN a.metric IS NOT NULL THEN 0 END AS rows_used,
    CASE WHEN a.kind = 'superlative' THEN lst.all_values END AS all_values,
    c.mart, c.column_name, c.aggregation, c.unit, c.definition,
    CASE WHEN a.metric IS NOT NULL THEN
      concat_ws(', ', 'carrier=' || a.carrier_filter, 'port=' || a.port_filter) END AS filters,
    CASE a.kind WHEN 'superlative' THEN a.sup_c || ': ' || {_num('a.sup_v')} || c.unit
                WHEN 'value' THEN {_num('a.value')} || c.unit END AS answer,
    CASE WHEN a.kind = 'refusal' THEN CASE WHEN a.metric IS NULL
        THEN 'only governed metrics are answered: {", ".join(config.METRICS)}'
        ELSE 'no rows of ' || c.mart || ' match the filters: '
             || concat_ws(', ', 'carrier=' || a.carrier_filter, 'port=' || a.port_filter) END END AS refusal
  FROM (SELECT *, CASE WHEN metric IS NOT NULL AND sup_c IS NOT NULL THEN 'superlative'
                       WHEN metric IS NOT NULL AND value IS NOT NULL THEN 'value' ELSE 'refusal' END AS kind FROM ans) a
  LEFT JOIN (VALUES {_CITED_V}) c(metric, mart, column_name, aggregation, unit, definition) ON c.metric = a.metric
  LEFT JOIN (SELECT metric, carrier_filter, port_filter,
               string_agg(carrier || '=' || {_num('value')}, ';' ORDER BY carrier) AS all_values
             FROM per_carrier GROUP BY 1, 2, 3) lst
    ON lst.metric = a.metric AND lst.carrier_filter IS NOT DISTINCT FROM a.carrier_filter
   AND lst.port_filter IS NOT DISTINCT FROM a.port_filter""",
    ALL + (_MROWS, _MCOMBO, _GOV, _SUP, _QUESTIONS))


# ---- keyed upsert and snapshots --------------------------------------------------

def _statics(where: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT mmsi, imo, name, type, observed_at FROM (
    SELECT CAST(user_id % 75 AS VARCHAR) AS mmsi, CAST(9000000 + user_id AS VARCHAR) AS imo,
      trim(' VESSEL ' || CAST(user_id % 75 AS VARCHAR) || ' ' || upper(json_extract_string(props, '$.k')) || '  ')
        AS name,
      CAST(70 + event_id % 10 AS VARCHAR) AS type, ts AS observed_at,
      row_number() OVER (PARTITION BY user_id % 75 ORDER BY ts DESC, event_id ASC) AS rn
    FROM events WHERE event_type = 'signup' AND {where}) WHERE rn = 1
)"""


_SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
ORACLE["upsert_by_key"] = sql(
    (_statics(f"ts < {_SPLIT}", "old_v"), _statics(f"ts >= {_SPLIT}", "new_v")),
    f"SELECT mmsi, imo, name, type, {_iso('observed_at')} AS observed_at FROM old_v "
    "WHERE mmsi NOT IN (SELECT mmsi FROM new_v) "
    f"UNION ALL SELECT mmsi, imo, name, type, {_iso('observed_at')} AS observed_at FROM new_v")

ORACLE["snapshot_asof"] = (
    f"SELECT exception_id, shipment_id, carrier, exception_type, {_iso('detected_at')} AS detected_at, age_hours, "
    f"detail, probable_cause, {_iso('detected_at')} AS snapshot_ts FROM {queue_at(ASOF_S - 24 * 3600)}")

ORACLE["fct_shipment_legs"] = _q(
    "SELECT l.shipment_id, 1 AS leg_seq, 'ocean' AS mode, l.fv_mmsi AS vessel_mmsi, v.vessel_name, "
    "l.fv_origin AS origin, l.fv_dest AS dest, l.fv_origin || '-' || l.fv_dest AS lane "
    "FROM st l LEFT JOIN (SELECT coalesce(o.mmsi, c.mmsi) AS mmsi, coalesce(nullif(o.name, ''), c.name) AS vessel_name "
    "FROM (VALUES " + ", ".join(f"('{m}', '{n}')" for m, n in config.VESSELS) + ") c(mmsi, name) "
    "FULL OUTER JOIN statics o ON o.mmsi = c.mmsi) v ON v.mmsi = l.fv_mmsi WHERE l.has_vessel",
    (FEED, CLASSIFY, STATE, AIS))


ORACLE["vessel_dwell_totals"] = _q("SELECT mmsi, anchor_hours FROM totals", (AIS,))
_BOXES_V = ", ".join(f"('{b[0]}', {i})" for i, b in enumerate(config.AIS_BOXES))
ORACLE["box_counts"] = _q(
    "SELECT strftime(d.date, '%Y-%m-%d') AS date, b.box, b.ord, "
    "CAST(count(w.mmsi) AS BIGINT) AS vessels "
    f"FROM (SELECT DISTINCT date FROM dwell) d CROSS JOIN (VALUES {_BOXES_V}) b(box, ord) "
    "LEFT JOIN dwell w ON w.date = d.date AND w.box = b.box GROUP BY d.date, b.box, b.ord", (AIS,))
ORACLE["port_causes"] = _q("SELECT port, probable_cause FROM causes", (AIS, CONDITIONS))
ORACLE["metric_exposition"] = (
    "SELECT 'tidewater_' || metric || CASE WHEN label <> '' THEN '{' || label || '}' ELSE '' END || ' ' "
    "|| CAST(value AS VARCHAR) AS line FROM (" + ORACLE["run_metrics"] + ")")

ORACLE["ais_run_summary"] = _q(
    "SELECT (SELECT CAST(count(*) AS BIGINT) FROM pos) AS position_reports, "
    "(SELECT CAST(count(*) FILTER (WHERE mmsi IS NULL OR mmsi = '') AS BIGINT) FROM pos) AS missing_mmsi, "
    "(SELECT CAST(count(*) AS BIGINT) FROM anch WHERE box IS NOT NULL) AS anchored_reports, "
    "(SELECT CAST(count(DISTINCT mmsi) AS BIGINT) FROM anch WHERE box IS NOT NULL) AS vessels_at_anchor, "
    "(SELECT CAST(count(*) AS BIGINT) FROM events WHERE event_type = 'signup') AS static_reports", (AIS,))
ORACLE["eta_run_summary"] = _q(
    "SELECT CAST(count(*) FILTER (WHERE NOT completed) AS BIGINT) AS inflight, "
    "CAST(count(*) FILTER (WHERE completed) AS BIGINT) AS completed_trained_on, "
    "(SELECT CAST(count(*) AS BIGINT) FROM eta_baseline WHERE event_type = 'delivered') AS mart_offsets_used "
    "FROM feat", ALL + (_features("st", "feat"),))

_PORT_NAMES = ", ".join(f"('{p[0]}', '{p[1].lower()}')" for p in config.PORTS)
ORACLE["document_port_mentions"] = (
    "SELECT p.port, CAST(count(d.text) AS BIGINT) AS disruption_news "
    f"FROM (VALUES {_PORT_NAMES}) p(port, needle) LEFT JOIN documents d ON contains(lower(d.text), p.needle) "
    "GROUP BY p.port")
