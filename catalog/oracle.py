"""The same queries in SQL (DuckDB) over the same tables, written from the operators' definitions."""

from __future__ import annotations

T = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


def _t(column: str) -> str:
    return T.format(column)


# events_norm, see FIXTURES.md
EV = """ev0 AS (
  SELECT event_id AS id, ts AS event_time, user_id, event_type AS kind,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
ev1 AS (
  SELECT id, event_time, k,
    ['windows_auth', 'linux_ssh', 'firewall', 'web_server'][k % 4 + 1] AS source_type,
    'host' || (k % 7) AS host,
    CASE WHEN k >= 5 THEN 'user' || user_id END AS username,
    CASE WHEN k % 10 <> 9 THEN ['10.0.0.', '192.168.1.', '203.0.113.', '198.51.100.', '185.220.101.', '45.155.204.',
         '103.21.244.', '172.16.0.', '8.8.8.'][k % 10 + 1] || (user_id % 5) END AS src_ip,
    CASE kind WHEN 'error' THEN CASE WHEN k % 4 = 3 THEN 'http_auth_failure' ELSE 'login_failure' END
              WHEN 'signup' THEN 'login_success'
              WHEN 'view' THEN CASE WHEN k % 5 = 0 THEN 'http_suspicious_request' ELSE 'http_request' END
              WHEN 'click' THEN CASE WHEN k % 3 = 0 THEN 'conn_denied' ELSE 'conn_allowed' END
              WHEN 'purchase' THEN 'privilege_escalation' END AS event_type
  FROM ev0),
ev AS (
  SELECT *, CASE WHEN event_type IN ('login_success', 'conn_allowed', 'http_request') THEN 'low'
                 WHEN event_type IN ('login_failure', 'conn_denied', 'http_auth_failure') THEN 'medium' ELSE 'high' END AS severity
  FROM ev1)"""

FEED = r"""feed AS (
  SELECT src_ip AS ip, 'seen_in_' || min(source_type) AS category, max(k) AS confidence, 'events' AS source
  FROM ev WHERE regexp_matches(src_ip, '^(203\.0\.113|185\.220\.101|45\.155\.204)\.[13]$') GROUP BY src_ip)"""

LINES = """ln AS (
  SELECT id, source_type, CASE WHEN k = 98 THEN 'broken ' || host
    WHEN source_type = 'windows_auth' THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') || ' EventID=' ||
      CASE event_type WHEN 'login_success' THEN '4624' WHEN 'login_failure' THEN '4625' WHEN 'privilege_escalation' THEN '4672'
        WHEN 'conn_denied' THEN '4720' WHEN 'http_suspicious_request' THEN '4728' ELSE '9999' END
      || ' Account=' || coalesce(username, '-') || ' LogonType=3 SourceIP=' || coalesce(src_ip, '-') || ' Workstation=' || host || ' Status=done'
    WHEN source_type = 'linux_ssh' THEN strftime(event_time, '%b ') || lpad(day(event_time)::VARCHAR, 2, ' ') || strftime(event_time, ' %H:%M:%S ') || host ||
      CASE event_type WHEN 'login_failure' THEN ' sshd[7]: Failed password for invalid user ' || coalesce(username, '-') || ' from ' || coalesce(src_ip, '-') || ' port 22 ssh2'
        WHEN 'privilege_escalation' THEN ' sudo: ' || coalesce(username, '-') || ' : TTY=pts/0 ; PWD=/ ; USER=' || CASE WHEN k % 8 = 1 THEN 'root' ELSE 'www' END || ' ; COMMAND=/bin/sh -c k' || k
        WHEN 'login_success' THEN ' sshd[7]: Accepted publickey for ' || coalesce(username, '-') || ' from ' || coalesce(src_ip, '-') || ' port 22 ssh2'
        ELSE ' kernel: nothing of note' END
    WHEN source_type = 'firewall' THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ') || ',' || host || ',' ||
      CASE event_type WHEN 'conn_denied' THEN 'block' WHEN 'conn_allowed' THEN 'ALLOW' WHEN 'login_failure' THEN 'DROP' ELSE 'REJECT' END
      || ',TCP,' || coalesce(src_ip, '-') || ',10.0.0.10,' || (k + 1000)
    ELSE coalesce(src_ip, '-') || ' - ' || coalesce(username, '-') || strftime(event_time, ' [%d/%b/%Y:%H:%M:%S') || ' +0000] "GET ' ||
      CASE WHEN event_type = 'http_suspicious_request' THEN '/app/.ENV' ELSE '/home' END || ' HTTP/1.1" ' ||
      CASE WHEN event_type = 'http_auth_failure' THEN CASE WHEN k % 2 = 0 THEN '401' ELSE '403' END ELSE '200' END || ' 512 "-" "agent/' || k || '"'
    END AS raw_message
  FROM ev)"""

# What parsing those lines must give, straight from the events they were written from.
PARSED = """parsed AS (
  SELECT id, k, source_type, date_trunc('second', event_time) AS event_time,
    CASE WHEN source_type <> 'web_server' THEN host END AS host,
    CASE source_type WHEN 'firewall' THEN NULL WHEN 'web_server' THEN username ELSE coalesce(username, '-') END AS username,
    CASE WHEN source_type = 'windows_auth' THEN src_ip
         WHEN source_type = 'linux_ssh' AND event_type = 'privilege_escalation' THEN NULL
         ELSE coalesce(src_ip, '-') END AS src_ip,
    CASE WHEN source_type = 'firewall' THEN '10.0.0.10' END AS dst_ip,
    CASE WHEN source_type = 'firewall' THEN k + 1000 END AS dst_port,
    CASE source_type
      WHEN 'windows_auth' THEN CASE WHEN event_type IN ('login_success', 'login_failure', 'privilege_escalation') THEN event_type
        WHEN event_type = 'conn_denied' THEN 'account_created' WHEN event_type = 'http_suspicious_request' THEN 'group_membership_change'
        ELSE 'unknown_event' END
      WHEN 'linux_ssh' THEN event_type
      WHEN 'firewall' THEN CASE WHEN event_type IN ('conn_denied', 'login_failure') THEN 'conn_denied'
        WHEN event_type = 'conn_allowed' THEN 'conn_allowed' ELSE 'unknown_action' END
      ELSE CASE WHEN event_type IN ('http_auth_failure', 'http_suspicious_request') THEN event_type ELSE 'http_request' END END AS event_type,
    CASE source_type
      WHEN 'windows_auth' THEN CASE event_type WHEN 'login_failure' THEN 'medium' WHEN 'privilege_escalation' THEN 'high'
        WHEN 'conn_denied' THEN 'medium' WHEN 'http_suspicious_request' THEN 'high' ELSE 'low' END
      WHEN 'linux_ssh' THEN CASE WHEN event_type = 'login_failure' THEN 'medium' WHEN event_type = 'login_success' THEN 'low'
        WHEN k % 8 = 1 THEN 'high' ELSE 'medium' END
      WHEN 'firewall' THEN CASE WHEN event_type IN ('conn_denied', 'login_failure') THEN 'medium' ELSE 'low' END
      ELSE CASE event_type WHEN 'http_auth_failure' THEN 'medium' WHEN 'http_suspicious_request' THEN 'high' ELSE 'low' END END AS severity,
    CASE WHEN source_type = 'web_server' THEN CASE WHEN event_type = 'http_auth_failure' THEN 403 ELSE 200 END END AS status_code,
    event_type AS was
  FROM ev
  WHERE k <> 98 AND (source_type <> 'linux_ssh' OR event_type IN ('login_failure', 'login_success', 'privilege_escalation'))),
stored AS (SELECT * FROM parsed WHERE src_ip IS DISTINCT FROM '-')"""

GEO = r"""geo AS (
  SELECT * FROM (VALUES ('10.0.0.', 'US', 'Baltimore (Corporate HQ)', 39.2904::DOUBLE, -76.6122::DOUBLE),
    ('192.168.1.', 'US', 'Baltimore (Corporate HQ)', 39.2904, -76.6122), ('203.0.113.', 'RU', 'Moscow', 55.7558, 37.6173),
    ('198.51.100.', 'CN', 'Beijing', 39.9042, 116.4074), ('185.220.101.', 'DE', 'Frankfurt (Known Tor Exit)', 50.1109, 8.6821),
    ('45.155.204.', 'NL', 'Amsterdam', 52.3676, 4.9041), ('103.21.244.', 'IN', 'Mumbai', 19.0760, 72.8777),
    ('172.16.0.', 'US', 'Baltimore (Corporate HQ)', 39.2904, -76.6122)) g(net, country, city, lat, lon)),
located AS (SELECT ev.*, country, city, lat, lon FROM ev LEFT JOIN geo ON net = regexp_replace(src_ip, '[0-9]+$', ''))"""

PAIRS = GEO + """,
chain AS (
  SELECT id, username, event_time, src_ip, city, lat, lon,
    lag(id) OVER w AS previous_id, lag(event_time) OVER w AS previous_time, lag(city) OVER w AS previous_city,
    lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0
  FROM located WHERE event_type = 'login_success' AND src_ip IS NOT NULL AND username IS NOT NULL
  WINDOW w AS (PARTITION BY username ORDER BY event_time, id)),
arc AS (
  SELECT *, (epoch_us(event_time) - epoch_us(previous_time)) / 1e6 AS seconds,
    least(greatest(power(sin((radians(lat) - radians(lat0)) / 2), 2)
      + cos(radians(lat0)) * cos(radians(lat)) * power(sin((radians(lon) - radians(lon0)) / 2), 2), 0), 1) AS a
  FROM chain WHERE previous_id IS NOT NULL),
pairs AS (
  SELECT *, 12742.0::DOUBLE * atan2(sqrt(a), sqrt(1 - a)) AS distance_km,
    CASE WHEN seconds <= 0 THEN 'inf'::DOUBLE ELSE 12742.0::DOUBLE * atan2(sqrt(a), sqrt(1 - a)) / (seconds / 3600) END AS speed_kmh
  FROM arc)"""


def _windows(name: str, key: str, where: str, k: int, hours: int) -> str:
    """Greedy threshold windows: candidates by lag, then a walk along the next allowed candidate."""
    return f"""{name}_f AS (
  SELECT {key} AS key, event_time, id, username, src_ip, source_type, epoch_us(event_time) AS at_us,
    row_number() OVER (PARTITION BY {key} ORDER BY event_time, id) AS rn
  FROM ev WHERE {where} AND {key} IS NOT NULL),
{name}_lag AS (SELECT key, rn, at_us - lag(at_us, {k - 1}) OVER (PARTITION BY key ORDER BY rn) AS took FROM {name}_f),
{name}_next AS (
  SELECT key, rn, min(rn) OVER (PARTITION BY key ORDER BY rn RANGE BETWEEN {k} FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
  FROM {name}_lag WHERE took <= {hours} * 3600000000),
{name}_pick AS (
  SELECT key, min(rn) AS rn FROM {name}_next GROUP BY key
  UNION ALL
  SELECT n.key, n.nxt FROM {name}_pick p JOIN {name}_next n ON n.key = p.key AND n.rn = p.rn WHERE n.nxt IS NOT NULL),
{name} AS (
  SELECT p.key, p.rn, string_agg(f.id::VARCHAR, ',' ORDER BY f.rn) AS ids, max(f.event_time) AS event_time,
    last(f.id ORDER BY f.rn) AS id, last(f.username ORDER BY f.rn) AS username, last(f.src_ip ORDER BY f.rn) AS src_ip,
    '[' || coalesce(string_agg(DISTINCT '''' || f.username || '''', ', ' ORDER BY '''' || f.username || ''''), '') || ']' AS users,
    '[' || string_agg(DISTINCT '''' || f.source_type || '''', ', ' ORDER BY '''' || f.source_type || '''') || ']' AS sources
  FROM {name}_pick p JOIN {name}_f f ON f.key = p.key AND f.rn BETWEEN p.rn - {k - 1} AND p.rn
  GROUP BY p.key, p.rn)"""


BRUTE = _windows("bf", "src_ip", "event_type = 'login_failure'", 5, 24)
MULTI = _windows("mf", "username", "event_type IN ('login_failure', 'http_auth_failure')", 3, 24)
SMOKE = _windows("sm", "src_ip", "event_type = 'login_failure'", 3, 168)

D1 = """SELECT 'brute_force_login' AS rule_name, 'high' AS severity, key AS src_ip, username,
  'Brute-force login attempts from ' || key AS title,
  '5 failed login attempts from ' || key || ' within 1440 minutes (targeting user(s): ' || users || ').' AS description,
  60.0::DOUBLE AS risk_score, 5::BIGINT AS n_events, ids AS event_ids, event_time AS detected_at, 'open' AS status FROM bf"""
D2 = """SELECT 'impossible_travel', 'critical', src_ip, username, 'Impossible travel detected for user ' || username, NULL,
  90.0::DOUBLE, 2::BIGINT, previous_id || ',' || id, event_time, 'open' FROM pairs
  WHERE city <> previous_city AND speed_kmh > 900"""
D3 = """SELECT 'suspicious_ip_threat_intel', 'high', src_ip, first(username ORDER BY event_time, id) FILTER (WHERE username IS NOT NULL),
  'Traffic from known-malicious IP ' || src_ip,
  count(*) || ' event(s) observed from ' || src_ip || ', which matches a known-bad indicator in the threat intelligence feed.',
  round(least(60 * least(count(*)::DOUBLE / 3, 2), 100), 2)::DOUBLE, count(*), string_agg(id::VARCHAR, ',' ORDER BY event_time, id),
  max(event_time), 'open' FROM ev WHERE src_ip IN (SELECT ip FROM feed) GROUP BY src_ip"""
D4 = """SELECT 'privilege_escalation', 'high', first(src_ip ORDER BY event_time, id) FILTER (WHERE src_ip IS NOT NULL), username,
  'Privilege escalation activity by ' || username || ' on ' || host,
  count(*) || ' privilege-escalation event(s) (sudo/admin-token) by ' || username || ' on ' || host || '.',
  least(60.0 * least(count(*), 3), 100)::DOUBLE, count(*), string_agg(id::VARCHAR, ',' ORDER BY event_time, id), max(event_time), 'open'
  FROM ev WHERE event_type = 'privilege_escalation' AND username IS NOT NULL AND host IS NOT NULL GROUP BY username, host"""
D5 = """SELECT 'unusual_login_hours', 'medium', src_ip, username, 'Off-hours login by ' || coalesce(username, 'None'),
  coalesce(username, 'None') || ' logged in at ' || strftime(event_time, '%H:%M') || ' UTC, outside the configured business-hours window (6:00-22:00).',
  30.0::DOUBLE, 1::BIGINT, id::VARCHAR, event_time, 'open' FROM ev WHERE event_type = 'login_success' AND (hour(event_time) < 6 OR hour(event_time) >= 22)"""
D6 = """SELECT 'multiple_failed_auth', 'high', src_ip, key, 'Repeated failed authentication for ' || key,
  '3 failed authentication events for user ' || key || ' across sources ' || sources || ' within 1440 minutes.',
  60.0::DOUBLE, 3::BIGINT, ids, event_time, 'open' FROM mf"""

_NAMES = "(rule_name, severity, src_ip, username, title, description, risk_score, n_events, event_ids, detected_at, status)"
_CTES = {"D1": [BRUTE], "D2": [PAIRS], "D3": [FEED], "D4": [], "D5": [], "D6": [MULTI]}
_RULES = {"D1": D1, "D2": D2, "D3": D3, "D4": D4, "D5": D5, "D6": D6}


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _al(*rules: str, ev: str = EV) -> str:
    ctes = [ev] + [c for r in rules for c in _CTES[r]]
    return _with(*ctes, f"al{_NAMES} AS (" + "\nUNION ALL\n".join(_RULES[r] for r in rules) + ")")


ALL = _al("D1", "D2", "D3", "D4", "D5", "D6")


# The two rules that report a whole group keep their ids in the evidence table (d8_evidence) only.
_IDS = "CASE WHEN rule_name NOT IN ('suspicious_ip_threat_intel', 'privilege_escalation') THEN event_ids END"


def _alert_cols(description: bool = True) -> str:
    return ("rule_name, severity, src_ip, username, title, " + ("description, " if description else "")
            + f"risk_score, n_events, {_IDS} AS event_ids, " + _t("detected_at") + " AS detected_at, status")


_EVENT_COLS = ("source_type, " + _t("event_time") + " AS event_time, host, username, src_ip, dst_ip, dst_port::VARCHAR AS dst_port, "
               "event_type, severity, status_code::VARCHAR AS status_code")
_P = _with(EV, PARSED)
_FEATURES = """hist AS (
  SELECT id, username, event_time, src_ip, event_type, epoch_us(event_time) AS at_us FROM ev
  WHERE event_type IN ('login_success', 'login_failure') AND username IS NOT NULL),
lg AS (SELECT *, row_number() OVER (PARTITION BY username, src_ip ORDER BY event_time, id) AS nth_from_ip FROM hist WHERE event_type = 'login_success'),
feats AS (
  SELECT id, username, event_time, src_ip, hour(event_time)::INTEGER AS hour_of_day, (isodow(event_time) - 1)::INTEGER AS day_of_week,
    (nth_from_ip = 1)::INTEGER AS is_new_source_ip,
    (SELECT count(*) FROM hist f WHERE f.event_type = 'login_failure' AND f.username = lg.username
       AND f.at_us <= lg.at_us AND f.at_us > lg.at_us - 3600000000)::INTEGER AS failed_attempts_1h,
    (SELECT count(*) FROM lg p WHERE p.username = lg.username AND p.at_us > lg.at_us - 86400000000
       AND (p.at_us < lg.at_us OR (p.at_us = lg.at_us AND p.id < lg.id)))::INTEGER AS logins_last_24h,
    (hour(event_time) < 6 OR hour(event_time) >= 22)::INTEGER AS is_off_hours
  FROM lg)"""
_F = _with(EV, _FEATURES)
_FEATURE_COLS = "hour_of_day, day_of_week, is_new_source_ip, failed_attempts_1h, logins_last_24h, is_off_hours"
_NEWEST = "detected_at DESC, rule_name NULLS FIRST, username NULLS FIRST, src_ip NULLS FIRST"
_EPOCH = "({0} // 1000000)::VARCHAR || '.' || lpad(({0} % 1000000)::VARCHAR, 6, '0')"
_HOURS = """hr AS (SELECT unnest(generate_series((SELECT min(date_trunc('hour', detected_at)) FROM al),
  (SELECT max(date_trunc('hour', detected_at)) FROM al), INTERVAL 1 HOUR)) AS hour)"""
_CUT = "TIMESTAMP '2024-01-20 00:00:00'"
_AS_OF = "TIMESTAMP '2024-01-20 10:30:00'"


def _in_range(hours: int) -> str:
    return f"detected_at >= date_trunc('hour', {_AS_OF} - INTERVAL {hours} HOUR) AND detected_at <= {_AS_OF}"


_BUCKETS = """SELECT src_ip, time_bucket(INTERVAL 5 MINUTE, event_time) AS bucket, count(*) AS count FROM ev
  WHERE source_type IN ('windows_auth', 'linux_ssh') AND event_type = 'login_failure' AND src_ip IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 2"""
_GROUP_FEED = """SELECT src_ip AS ip, 'seen_in_' || min(source_type) AS category, max(k) AS confidence, 'events' AS source
  FROM ev WHERE regexp_matches(src_ip, '^(203\\.0\\.113|185\\.220\\.101|45\\.155\\.204)\\.[13]$') AND event_time {0} GROUP BY src_ip"""
_OLD_KEYS = """old AS (
  SELECT 'privilege_escalation' AS rule_name, string_agg(id::VARCHAR, ',' ORDER BY event_time, id) AS ids FROM ev
  WHERE event_type = 'privilege_escalation' AND username IS NOT NULL AND event_time < {cut} GROUP BY username, host
  UNION ALL
  SELECT 'suspicious_ip_threat_intel', string_agg(id::VARCHAR, ',' ORDER BY event_time, id) FROM ev
  WHERE src_ip IN (SELECT ip FROM feed) AND event_time < {cut} GROUP BY src_ip
  UNION ALL
  SELECT 'unusual_login_hours', id::VARCHAR FROM ev
  WHERE event_type = 'login_success' AND (hour(event_time) < 6 OR hour(event_time) >= 22) AND event_time < {cut}
  UNION ALL
  SELECT rule_name, event_ids FROM al WHERE rule_name IN ('brute_force_login', 'impossible_travel', 'multiple_failed_auth')
  AND detected_at < {cut})""".format(cut=_CUT)
_FRESH = "NOT EXISTS (SELECT 1 FROM old WHERE old.rule_name = al.rule_name AND old.ids = al.event_ids)"
_ALL_PLUS = lambda cte: ALL.rstrip() + ",\n" + cte + "\n"

_HITS = "SELECT id, src_ip, event_type FROM ev WHERE src_ip IN (SELECT ip FROM feed)"
_D1_SQL = _al("D1") + f"SELECT {_alert_cols()} FROM al"
_D2_SQL = _al("D2") + f"SELECT {_alert_cols(False)} FROM al"
_D5_SQL = _al("D5") + f"SELECT {_alert_cols()} FROM al"
_W1_SQL = _with(EV, SMOKE) + f"SELECT key AS src_ip, {_t('event_time')} AS event_time, id, ids FROM sm"
_GEO_SQL = _with(EV, GEO) + "SELECT id, src_ip, country, city, lat, lon FROM located"
_M1_SQL = _F + f"SELECT id, username, {_t('event_time')} AS event_time, src_ip, {_FEATURE_COLS} FROM feats"
# A score for every login by a rule on its id, as the catalogue makes it.
_SCORES = """sc AS (SELECT id, username, event_time, ((id * 7919) % 10000) / 10000.0 AS anomaly_score FROM ev
  WHERE event_type = 'login_success' AND username IS NOT NULL)"""


def _score_laws(table: str) -> str:
    """What any run of the model must show; ids, ends of the scale and the flagged share do not depend on the seed."""
    return f"""SELECT count(*) AS logins_scored, count(*) AS ids, 0::DOUBLE AS lowest, 1::DOUBLE AS highest, true AS flagged_within_share,
        true AS flagged_are_highest, count(*) AS scored_alike FROM {table} WHERE event_type = 'login_success' AND username IS NOT NULL"""


# The rules over what is stored: ev is what the parsed lines left, under the names of the events.
_STORED_AS_EV = EV.replace("ev AS (", "ev_in AS (") + ",\n" + PARSED.replace("FROM ev\n", "FROM ev_in\n") + ",\nev AS (SELECT * FROM stored)"
_FEED_IN = FEED.replace("FROM ev WHERE", "FROM ev_in WHERE")



def _late_sql(rule: str, relevant: str, key: str) -> str:
    """All alerts, as if nothing had been late, and the rows that came after their hour had been closed for a day."""
    return _al(rule).rstrip() + f""",
  lim AS (SELECT floor(epoch(min(event_time))) AS lo, floor(epoch(max(event_time))) AS hi FROM ev),
  arr AS (SELECT id, {key} AS key, event_time, epoch_ms(event_time) AS ms, least(floor((floor(epoch(event_time))
      + CASE WHEN id % 7 = 0 THEN 691200 ELSE 0 END - lo) * 3 / (hi + 1 - lo)), 3) AS part FROM ev, lim WHERE {relevant}),
  clk AS (SELECT p.part, max(a.ms) AS newest FROM (SELECT DISTINCT part FROM arr) p JOIN arr a ON a.part < p.part GROUP BY p.part)
  SELECT 'alert' AS what, {key} AS key, {_t('detected_at')} AS at, event_ids AS ids FROM al
  UNION ALL
  SELECT 'late', key, {_t('event_time')}, id::VARCHAR FROM arr JOIN clk USING (part)
  WHERE (floor(ms / 3600000.0) + 1) * 3600000 + 86400000 <= newest"""


ORACLES = {
    "s1_raw_scan": _with(EV, LINES) + "SELECT source_type, raw_message FROM ln WHERE source_type = 'windows_auth'",
    "s2_all_sources_scan": _with(EV, LINES) + """SELECT source_type, count(*) AS n, sum(length(raw_message))::BIGINT AS chars
        FROM ln GROUP BY source_type""",
    "s3_raw_audit": _with(EV, PARSED) + """SELECT source_type, id IN (SELECT id FROM parsed) AS processed, count(*) AS n, count(*) AS ids
        FROM ev GROUP BY ALL""",
    "s4_event_sink": _P + f"SELECT {_EVENT_COLS} FROM stored",
    "s5_rejects": _P + """SELECT source_type, CASE WHEN id IN (SELECT id FROM parsed) THEN 'src_ip is not an address' ELSE 'unparsed' END AS reason,
        count(*) AS n FROM ev WHERE id NOT IN (SELECT id FROM stored) GROUP BY ALL""",
    "s6_events_since": _P + f"SELECT {_EVENT_COLS} FROM stored WHERE stored.event_time >= {_CUT}",
    "s7_feed_scan": _with(EV, FEED) + "SELECT ip, category, confidence, source FROM feed",
    "s8_feed_upsert": _with(EV, "a AS (" + _GROUP_FEED.format(f"< {_CUT}") + ")", "b AS (" + _GROUP_FEED.format(f">= {_CUT}") + ")")
        + """SELECT coalesce(b.ip, a.ip) AS ip, coalesce(b.category, a.category) AS category, coalesce(b.confidence, a.confidence) AS confidence,
        'events' AS source, CASE WHEN a.ip IS NULL THEN '2024-02-01 00:00:00.000000' ELSE '2024-01-01 00:00:00.000000' END AS added_at
        FROM a FULL JOIN b ON a.ip = b.ip""",
    "s9_known_bad_ips": _with(EV, FEED) + "SELECT ip AS src_ip FROM feed",
    "s10_alert_sink": ALL.rstrip() + ",\n" + _OLD_KEYS + f"""
        SELECT 'older events' AS run, count(*) AS written FROM old
        UNION ALL SELECT 'all events', count(*) FROM al WHERE {_FRESH}
        UNION ALL SELECT 'all events again', 0""",
    "s11_score_sink": _F + f"SELECT id, username, {_t('event_time')} AS event_time, {_FEATURE_COLS} FROM feats",
    "s12_event_export": _with(EV) + f"""SELECT {_EPOCH.format('epoch_us(event_time)')} AS time, 'siem:' || source_type AS sourcetype,
        'siem' AS index, id::VARCHAR AS id, username, src_ip, event_type FROM ev""",
    "s13_alert_export": ALL + f"""SELECT {_EPOCH.format('epoch_us(detected_at)')} AS time, 'siem:alert' AS sourcetype, 'siem' AS index, rule_name,
        risk_score::DECIMAL(5, 2)::VARCHAR AS risk_score, '[' || replace({_IDS}, ',', ', ') || ']' AS event_ids, title FROM al""",
    "s13_alert_evidence": ALL.rstrip() + """,
        ids AS (SELECT rule_name, title, CAST(unnest(string_split(event_ids, ',')) AS BIGINT) AS id FROM al)
        SELECT 'siem:alert:evidence' AS sourcetype, rule_name, title, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum, min(id) AS first_id
        FROM ids GROUP BY rule_name, title""",
    "s14_dashboard_scan": ALL + f"SELECT rule_name, title, {_t('detected_at')} AS detected_at, status FROM al",

    "n1_windows": _P + f"""SELECT {_EVENT_COLS}, id, CASE was WHEN 'login_success' THEN '4624' WHEN 'login_failure' THEN '4625'
        WHEN 'privilege_escalation' THEN '4672' WHEN 'conn_denied' THEN '4720' WHEN 'http_suspicious_request' THEN '4728' ELSE '9999' END AS event_id,
        '3' AS logon_type, 'done' AS status FROM parsed WHERE source_type = 'windows_auth'""",
    "n2_event_id_map": _P + """SELECT CASE was WHEN 'login_success' THEN '4624' WHEN 'login_failure' THEN '4625'
        WHEN 'privilege_escalation' THEN '4672' WHEN 'conn_denied' THEN '4720' WHEN 'http_suspicious_request' THEN '4728' ELSE '9999' END AS event_id,
        event_type, severity, count(*) AS n FROM parsed WHERE source_type = 'windows_auth' GROUP BY ALL""",
    "n3_syslog_prefix": _P + f"SELECT id, {_t('event_time')} AS event_time, host FROM parsed WHERE source_type = 'linux_ssh'",
    "n4_sshd": _P + f"""SELECT {_EVENT_COLS}, id, '22' AS port, CASE WHEN event_type = 'login_failure' THEN 'password' END AS auth_method
        FROM parsed WHERE source_type = 'linux_ssh' AND event_type LIKE 'login%'""",
    "n5_sudo": _P + f"""SELECT {_EVENT_COLS}, id, CASE WHEN k % 8 = 1 THEN 'root' ELSE 'www' END AS target_user, '/bin/sh -c k' || k AS command
        FROM parsed WHERE source_type = 'linux_ssh' AND event_type = 'privilege_escalation'""",
    "n6_firewall": _P + f"""SELECT {_EVENT_COLS}, id, 'TCP' AS protocol, CASE was WHEN 'conn_denied' THEN 'BLOCK' WHEN 'conn_allowed' THEN 'ALLOW'
        WHEN 'login_failure' THEN 'DROP' ELSE 'REJECT' END AS action FROM parsed WHERE source_type = 'firewall'""",
    "n7_web": _P + f"""SELECT {_EVENT_COLS}, id, 'GET' AS method, CASE WHEN was = 'http_suspicious_request' THEN '/app/.ENV' ELSE '/home' END AS path,
        'agent/' || k AS user_agent FROM parsed WHERE source_type = 'web_server'""",
    "n8_http_classes": _P + """SELECT status_code::INTEGER AS status_code, CASE WHEN was = 'http_suspicious_request' THEN '/app/.ENV' ELSE '/home' END AS path,
        event_type, severity, count(*) AS n FROM parsed WHERE source_type = 'web_server' GROUP BY ALL""",
    "n9_line_stream": _P + "SELECT id, source_type, event_type FROM parsed",
    "n10_event_json": _with(EV) + """SELECT id::VARCHAR AS id, strftime(event_time, '%Y-%m-%dT%H:%M:%S') ||
        CASE WHEN epoch_us(event_time) % 1000000 > 0 THEN strftime(event_time, '.%f') ELSE '' END || '+00:00' AS event_time,
        source_type, username, src_ip FROM ev""",
    "n11_dispatch": _P + """SELECT ev.source_type, parsed.event_type, parsed.severity, count(*) AS n
        FROM ev LEFT JOIN parsed USING (id) GROUP BY ALL""",

    "j1_intel_semi_join": _with(EV, FEED) + _HITS,
    "j2_geo_lookup": _GEO_SQL,
    "j2_geo_inline": _GEO_SQL,
    "j3_login_pairs": _with(EV, PAIRS) + """SELECT id, previous_id, username, round(seconds, 6) AS seconds, city, previous_city,
        round(distance_km, 6) AS distance_km, CASE WHEN seconds <= 0 THEN 'inf'::DOUBLE ELSE round(speed_kmh, 6) END AS speed_kmh FROM pairs""",
    "j4_failures_before_login": _F + "SELECT id, username, failed_attempts_1h FROM feats",
    "j5_new_alerts": _ALL_PLUS(_OLD_KEYS) + f"SELECT {_alert_cols(False)} FROM al WHERE {_FRESH}",
    "j6_raw_line": _with(EV, LINES) + "SELECT id, source_type, length(raw_message)::INTEGER AS line_length FROM ln",
    "j7_intel_enrichment": _with(EV, FEED) + """SELECT id, src_ip, category AS intel_category, confidence::VARCHAR AS intel_confidence
        FROM ev LEFT JOIN feed ON ip = src_ip""",

    "a0_risk": _with(EV) + """SELECT id, round(least(10 * CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 3 WHEN 'high' THEN 6 WHEN 'critical' THEN 9 ELSE 1 END
        * (k::DOUBLE / 7), 100), 2)::DOUBLE AS risk FROM ev""",
    "w1_threshold_windows": _W1_SQL,
    "w1_split_hot_keys": _W1_SQL,
    "d1_brute_force": _D1_SQL,
    "d2_impossible_travel": _D2_SQL,
    "d3_suspicious_ip": _al("D3") + f"SELECT {_alert_cols()} FROM al",
    "d4_privilege_escalation": _al("D4") + f"SELECT {_alert_cols()} FROM al",
    "d5_unusual_hours": _D5_SQL,
    "d6_multiple_failed_auth": _al("D6") + f"SELECT {_alert_cols()} FROM al",
    "d7_all_rules": ALL + f"SELECT {_alert_cols(False)} FROM al",
    "d8_evidence": _with(EV, FEED) + """SELECT 'suspicious_ip_threat_intel' AS rule_name, 'Traffic from known-malicious IP ' || src_ip AS title, id AS event_id
        FROM ev WHERE src_ip IN (SELECT ip FROM feed)
        UNION ALL SELECT 'privilege_escalation', 'Privilege escalation activity by ' || username || ' on ' || host, id FROM ev WHERE event_type = 'privilege_escalation' AND username IS NOT NULL AND host IS NOT NULL""",

    "a1_kpis": ALL + """SELECT (SELECT count(*) FROM ev) AS total_events, count(*) FILTER (WHERE status = 'open') AS open_alerts,
        count(*) FILTER (WHERE severity = 'critical') AS critical_alerts, round(coalesce(avg(risk_score), 0), 6) AS avg_risk,
        (SELECT count(*) FROM ev WHERE event_type = 'login_success' AND username IS NOT NULL AND (id * 7919) % 10000 >= 9500) AS anomalies FROM al""",
    "a9_anomaly_summary": _with(EV, _SCORES) + "SELECT count(*) AS logins_scored, count(*) FILTER (WHERE anomaly_score >= 0.95) AS flagged FROM sc",
    "a10_flagged_logins": _with(EV, _SCORES) + f"""SELECT id, username, {_t('event_time')} AS event_time, anomaly_score::DOUBLE AS anomaly_score,
        true AS is_anomaly FROM sc WHERE anomaly_score >= 0.95""",
    "m2_score_laws": _with(EV) + _score_laws("ev"),
    "m3_score_laws": _P + _score_laws("stored"),
    "a2_alert_filter": ALL + f"""SELECT {_alert_cols(False)} FROM al WHERE severity IN ('critical', 'medium')
        AND rule_name IN ('impossible_travel', 'unusual_login_hours', 'brute_force_login')""",
    "a2_rule_options": ALL + "SELECT DISTINCT rule_name FROM al",
    "a3_hourly_trend": _ALL_PLUS(_HOURS) + f"""SELECT {_t('hour')} AS hour, count(al.rule_name) AS alert_count
        FROM hr LEFT JOIN al ON date_trunc('hour', detected_at) = hour GROUP BY hr.hour""",
    "a4_by_severity": ALL + "SELECT severity, count(*) AS count FROM al GROUP BY severity",
    "a5_top_ips": ALL + """SELECT src_ip, count(*) AS alerts, max(risk_score) AS max_risk FROM al WHERE src_ip IS NOT NULL
        GROUP BY src_ip ORDER BY alerts DESC, src_ip LIMIT 10""",
    "a6_by_rule": ALL + "SELECT rule_name, count(*) AS count FROM al GROUP BY rule_name",
    "a7_risk_by_user": ALL + "SELECT username, round(sum(risk_score), 6) AS risk_score FROM al WHERE username IS NOT NULL GROUP BY username",
    "a8_login_heatmap": _with(EV) + """SELECT strftime(event_time, '%Y-%m-%d') AS date, hour(event_time)::INTEGER AS hour, count(*) AS logins
        FROM ev WHERE event_type = 'login_success' GROUP BY ALL""",
    "a10_alert_table": ALL + f"SELECT {_t('detected_at')} AS detected_at, rule_name, severity, title, username, src_ip, risk_score, status FROM al",

    "q1_failure_buckets": _with(EV, f"b AS ({_BUCKETS})") + f"SELECT src_ip, {_t('bucket')} AS bucket, count FROM b",
    "q2_top_attackers": _with(EV) + """SELECT src_ip, count(*) AS attempts, count(DISTINCT event_type) AS distinct_event_types FROM ev
        WHERE event_type IN ('login_failure', 'conn_denied', 'http_suspicious_request') AND src_ip IS NOT NULL
        GROUP BY src_ip ORDER BY attempts DESC, src_ip LIMIT 10""",
    "q3_privilege_activity": ALL + f"""SELECT {_t('detected_at')} AS detected_at, username, NULL::VARCHAR AS host, description, risk_score
        FROM al WHERE rule_name = 'privilege_escalation'""",
    "q4_off_hours": _with(EV) + f"""SELECT {_t('event_time')} AS event_time, username, src_ip, host FROM ev
        WHERE event_type = 'login_success' AND (hour(ev.event_time) < 6 OR hour(ev.event_time) >= 22)""",
    "q5_severity_chart": _ALL_PLUS(_HOURS) + f"""SELECT {_t('hour')} AS hour, count(*) FILTER (WHERE severity = 'low') AS low,
        count(*) FILTER (WHERE severity = 'medium') AS medium, count(*) FILTER (WHERE severity = 'high') AS high,
        count(*) FILTER (WHERE severity = 'critical') AS critical
        FROM hr LEFT JOIN al ON date_trunc('hour', detected_at) = hour GROUP BY hr.hour""",
    "q6_intel_alerts": ALL + f"""SELECT {_t('detected_at')} AS detected_at, src_ip, username, description, risk_score
        FROM al WHERE rule_name = 'suspicious_ip_threat_intel'""",
    "q7_risk_leaderboard": ALL + """SELECT username, round(sum(risk_score), 6) AS total_risk, count(*) AS alert_count
        FROM al WHERE username IS NOT NULL GROUP BY username""",
    "q8_travel_alerts": ALL + f"SELECT {_t('detected_at')} AS detected_at, username, risk_score FROM al WHERE rule_name = 'impossible_travel'",
    "q9_web_surface": _with(EV) + """SELECT src_ip, event_type, count(*) AS count FROM ev WHERE source_type = 'web_server'
        AND event_type IN ('http_suspicious_request', 'http_auth_failure') AND src_ip IS NOT NULL GROUP BY ALL""",
    "q10_multi_source_ips": _with(EV) + """SELECT src_ip, count(DISTINCT source_type) AS source_count,
        string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS sources FROM ev WHERE src_ip IS NOT NULL
        GROUP BY src_ip HAVING count(DISTINCT source_type) >= 2""",
    "q11_time_range": ALL + f"SELECT {_alert_cols(False)} FROM al WHERE {_in_range(24).replace('detected_at', 'al.detected_at')}",
    "q12_alert_summary": ALL + """SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'critical') AS critical,
        count(DISTINCT src_ip) AS distinct_ips, round(avg(risk_score), 1) AS avg_risk FROM al""",
    "q13_panels": ALL + f"""SELECT username, round(sum(risk_score), 6) AS total_risk, count(*) AS alert_count
        FROM al WHERE username IS NOT NULL AND {_in_range(24 * 7)} GROUP BY username""",
    "q13_severity_panel": ALL + f"SELECT severity, count(*) AS count FROM al WHERE {_in_range(24 * 7)} GROUP BY severity",
    "q13_summary_panel": ALL + f"""SELECT count(*) AS total, count(*) FILTER (WHERE severity = 'critical') AS critical,
        count(DISTINCT src_ip) AS distinct_ips, round(avg(risk_score), 1) AS avg_risk FROM al WHERE {_in_range(24 * 7)}""",
    "q13_recent_panel": _ALL_PLUS(f"top AS (SELECT * FROM al WHERE {_in_range(24 * 7)} ORDER BY {_NEWEST} LIMIT 50)")
        + f"SELECT {_t('detected_at')} AS detected_at, rule_name, severity, username, src_ip, title, risk_score FROM top",
    "q13_rule_panel": ALL + f"SELECT rule_name, count(*) AS count FROM al WHERE {_in_range(24 * 7)} GROUP BY rule_name",
    "q13_top_ips_panel": ALL + f"""SELECT src_ip, count(*) AS alerts, max(risk_score) AS max_risk FROM al WHERE src_ip IS NOT NULL AND {_in_range(24 * 7)}
        GROUP BY src_ip ORDER BY alerts DESC, src_ip LIMIT 10""",
    "q13_hour_severity_panel": ALL.rstrip() + f""",
        wk AS (SELECT * FROM al WHERE {_in_range(24 * 7)}),
        hr AS (SELECT unnest(generate_series((SELECT date_trunc('hour', min(detected_at)) FROM wk), (SELECT date_trunc('hour', max(detected_at)) FROM wk),
               INTERVAL 1 HOUR)) AS hour)
        SELECT {_t('hour')} AS hour, count(*) FILTER (WHERE severity = 'low') AS low, count(*) FILTER (WHERE severity = 'medium') AS medium,
        count(*) FILTER (WHERE severity = 'high') AS high, count(*) FILTER (WHERE severity = 'critical') AS critical
        FROM hr LEFT JOIN wk ON date_trunc('hour', detected_at) = hour GROUP BY hr.hour""",
    "q14_recent_alerts": _ALL_PLUS(f"top AS (SELECT * FROM al ORDER BY {_NEWEST} LIMIT 50)")
        + f"SELECT {_t('detected_at')} AS detected_at, rule_name, severity, username, src_ip, title, risk_score FROM top",

    "w2_previous_login": _with(EV, PAIRS) + "SELECT id, previous_id FROM pairs",
    "w3_first_sighting": _F + "SELECT id, username, src_ip FROM feats WHERE is_new_source_ip = 1",
    "w4_logins_last_day": _F + "SELECT id, username, logins_last_24h FROM feats",
    "w5_split_hot_users": _M1_SQL,
    "w6_first_last_value": _al("D3") + f"SELECT src_ip, username, {_t('detected_at')} AS detected_at FROM al",
    "u2_distinct_sources": _with(EV) + "SELECT DISTINCT username, source_type FROM ev",
    "m1_features": _M1_SQL,

    "t1_stream_normalise": _P + f"SELECT {_EVENT_COLS} FROM stored",
    "t2_stream_failure_counts": _with(EV, f"b AS ({_BUCKETS})") + f"SELECT src_ip, {_t('bucket')} AS bucket, count FROM b",
    "t3_stream_brute_force": _D1_SQL,
    "t4_stream_off_hours": _D5_SQL,
    "t4_stream_intel_match": _with(EV, FEED) + _HITS,
    "t5_stream_alert_sink": _D5_SQL,
    "t6_stream_travel": _D2_SQL,
    "t7_late_data": _late_sql("D1", "event_type = 'login_failure' AND src_ip IS NOT NULL", "src_ip"),
    "t7_late_travel": _late_sql("D2", "event_type = 'login_success' AND src_ip IS NOT NULL AND username IS NOT NULL", "username"),
    # two ticks: an address or account that was active in both has an alert of each
    "t8_scheduled_refresh": (_al("D1", "D2", "D3", "D4", "D5", "D6", ev=_STORED_AS_EV).rstrip() + ",\n" + _OLD_KEYS).replace(FEED, _FEED_IN) + f"""
        SELECT rule_name, count(*) AS n, sum(n_events)::BIGINT AS n_events FROM (
            SELECT rule_name, n_events FROM al UNION ALL
            SELECT rule_name, len(string_split(ids, ',')) FROM old WHERE ids NOT IN (SELECT event_ids FROM al WHERE al.rule_name = old.rule_name))
        GROUP BY rule_name""",
}

# what a mart gives is what its panel gives on all events and alerts
ORACLES |= {mart: ORACLES[panel] for mart, panel in {
    "a1_mart_kpis": "a1_kpis", "a3_mart_hourly_trend": "a3_hourly_trend", "a4_mart_by_severity": "a4_by_severity", "a5_mart_top_ips": "a5_top_ips",
    "a6_mart_by_rule": "a6_by_rule", "a7_mart_risk_by_user": "a7_risk_by_user", "a8_mart_login_heatmap": "a8_login_heatmap",
    "q2_mart_top_attackers": "q2_top_attackers"}.items()}
