"""Lines of each source, in the shapes real exports have, and what must come of them."""

from datetime import datetime

import pytest

from duskwatch.operators import normalize as nz


def parse(spark, source, *lines, year=2026):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "n long, value string")
    rows = nz.normalize_source(df, source, year).orderBy("n").collect()
    return rows


WIN = "2026-07-01T11:42:07Z EventID={} Account=moreno LogonType=3 SourceIP={} Workstation=HQ-AD7 Status=success"


@pytest.mark.parametrize("code,event_type,severity", [
    ("4624", "login_success", "low"), ("4625", "login_failure", "medium"),
    ("4672", "privilege_escalation", "high"), ("4720", "account_created", "medium"),
    ("4728", "group_membership_change", "high"), ("9", "unknown_event", "low")])
def test_windows_event_ids(spark, code, event_type, severity):
    (row,) = parse(spark, "windows_auth", WIN.format(code, "172.20.4.9") + " trailing text")
    assert (row.event_type, row.severity) == (event_type, severity)
    assert row.event_time == datetime(2026, 7, 1, 11, 42, 7)
    assert (row.username, row.src_ip, row.host) == ("moreno", "172.20.4.9", "HQ-AD7")
    assert row.additional_data == {"event_id": code, "logon_type": "3", "status": "success"}


def test_windows_edges(spark):
    dash, bad_time, junk, unpadded, sep = parse(
        spark, "windows_auth", "  " + WIN.format("4624", "-") + "\t",
        WIN.format("4624", "1.2.3.4").replace("11:42:07Z", "11:42"), "??? nothing to read here",
        WIN.format("4624", "1.2.3.4").replace("07-01T11", "7-1T11"),
        WIN.format("4624", "1.2.3.4").replace("moreno", "mo\x01reno"))
    assert dash.src_ip is None and dash.event_type == "login_success"
    assert bad_time.event_type is None and bad_time.additional_data is None
    assert junk.event_time is None
    assert unpadded.event_time == datetime(2026, 7, 1, 11, 42, 7)
    assert sep.username == "mo\x01reno" and sep.additional_data["status"] == "success"


def test_linux(spark):
    rows = parse(
        spark, "linux_ssh",
        "Jul  1 11:42:07 edge3 sshd[881]: Failed password for invalid user guest from 198.18.7.31 port 40917 ssh2",
        "Jul 1 08:16:01 edge3 sshd[882]: Accepted publickey for moreno from 172.20.4.9 port 40988 ssh2",
        "Jul  1 09:00:00 edge3 sudo: okoye : TTY=pts/0 ; PWD=/home/okoye ; USER=root ; COMMAND=/bin/cat /etc/a b",
        "Jul  1 09:00:00 edge3 sudo: okoye : TTY=pts/0 ; PWD=/home/okoye ; USER=www ; COMMAND=/bin/bash",
        "Jul  1 09:00:00 edge3 sshd[1]: Connection closed",
        "Jul  1 09:00:00 edge3 cron[1]: Accepted password for x from 1.2.3.4 port 1",
        "=== rotated ===",
        "Feb 29 09:00:00 edge3 sshd[1]: Accepted password for x from 1.2.3.4 port 1",
        "jul 1 09:00:00 edge3 sshd[1]: Failed password for a from 1.1.1.1 port 5; Accepted password for b from 2.2.2.2 port 6")
    failed, ok, root, www, other, cron, junk, leap, both = rows
    assert (failed.event_type, failed.username, failed.src_ip, failed.host, failed.severity) == (
        "login_failure", "guest", "198.18.7.31", "edge3", "medium")
    assert failed.event_time == datetime(2026, 7, 1, 11, 42, 7)
    assert failed.additional_data == {"port": "40917", "auth_method": "password"}
    assert (ok.event_type, ok.username, ok.severity, ok.additional_data) == (
        "login_success", "moreno", "low", {"port": "40988"})
    assert (root.event_type, root.username, root.severity, root.src_ip) == (
        "privilege_escalation", "okoye", "high", None)
    assert root.additional_data == {"target_user": "root", "command": "/bin/cat /etc/a b"}
    assert www.severity == "medium"
    assert all(r.event_type is None and r.event_time is None for r in (other, cron, junk, leap))
    assert (both.event_type, both.username) == ("login_failure", "a")


def test_linux_leap_year(spark):
    (row,) = parse(spark, "linux_ssh",
                   "Feb 29 09:00:00 edge3 sshd[1]: Accepted password for x from 1.2.3.4 port 1", year=2024)
    assert row.event_time == datetime(2024, 2, 29, 9)


def test_firewall(spark):
    rows = parse(
        spark, "firewall", "2026-07-01T11:42:07Z,gate2,BLOCK,TCP,198.18.7.31,172.20.9.1,443",
        "2026-07-01T08:15:40Z, gate2 ,allow,TCP,172.20.4.9,172.20.9.1, 22", "2026-07-01T08:15:40Z,gate2,drop,UDP,1.1.1.1,2.2.2.2,1",
        "2026-07-01T08:15:40Z,gate2,REJECT,UDP,1.1.1.1,2.2.2.2,1", "a,b,c",
        "2026-07-01T08:15:40Z,gate2,ALLOW,UDP,1.1.1.1,2.2.2.2,http", "2026-07-01T08:15:40Z,gate2,ALLOW,UDP,1.1.1.1,2.2.2.2,1,",
        "2026-07-01,gate2,ALLOW,UDP,1.1.1.1,2.2.2.2,1")
    block, allow, drop, other, *bad = rows
    assert (block.event_type, block.dst_port, block.severity, block.dst_ip) == ("conn_denied", 443, "medium", "172.20.9.1")
    assert (allow.event_type, allow.severity, allow.host, allow.dst_port) == ("conn_allowed", "low", "gate2", 22)
    assert allow.additional_data == {"protocol": "TCP", "action": "ALLOW"}
    assert drop.event_type == "conn_denied" and (other.event_type, other.severity) == ("unknown_action", "low")
    assert all(r.event_time is None and r.dst_port is None for r in bad)


def test_web(spark):
    rows = parse(
        spark, "web_server",
        '172.20.4.9 - moreno [01/Jul/2026:08:06:00 +0000] "GET /reports HTTP/1.1" 200 777 "-" "Reader/2.1 (A; B)"',
        '198.18.7.31 - - [01/Jul/2026:08:15:33 +0200] "POST /wp-login.php HTTP/1.1" 401 300 "-" "curl/7.68.0"',
        '45.155.204.9 - - [01/Jul/2026:02:00:00 +00:00] "GET /ETC/passwd HTTP/1.1" 404 210 "-" "curl"',
        '1.1.1.1 - - [01/Jul/2026:02:00:00 Z] "GET /x HTTP/1.1" 403 210 "-" ""', "-- end of file --")
    ok, refused, probing, zulu, junk = rows
    assert (ok.event_type, ok.status_code, ok.username, ok.severity, ok.host) == ("http_request", 200, "moreno", "low", None)
    assert ok.additional_data == {"method": "GET", "path": "/reports", "user_agent": "Reader/2.1 (A; B)"}
    assert (refused.event_type, refused.username, refused.severity) == ("http_auth_failure", None, "medium")
    assert refused.event_time == datetime(2026, 7, 1, 6, 15, 33)
    assert (probing.event_type, probing.severity) == ("http_suspicious_request", "high")
    assert (zulu.event_type, zulu.event_time) == ("http_auth_failure", datetime(2026, 7, 1, 2))
    assert junk.event_time is None


def test_mixed_sources_and_rejects(spark):
    raw = spark.createDataFrame([
        (1, "windows_auth", WIN.format("4624", "172.20.4.9")), (2, "firewall", "2026-07-01T11:42:07Z,gate2,BLOCK,TCP,host.name,172.20.9.1,443"),
        (3, "web_server", "junk"), (4, "firewall", " \t "),
        (5, "firewall", "2026-07-01T11:42:07Z,gate2,BLOCK,TCP,::1,172.20.9.1,443")], "raw_id long, source_type string, raw_message string")
    out = nz.normalize(raw)
    assert {r.raw_id for r in nz.events_of(out).collect()} == {1, 5}
    assert {(r.raw_id, r.reason) for r in nz.rejects_of(out).collect()} == {
        (2, "src_ip is not an address"), (3, "unparsed")}
    with pytest.raises(ValueError):
        nz.normalize(raw, sources=["mainframe"])


def test_event_json(spark):
    import json
    (row,) = nz.to_event_json(nz.normalize_source(
        spark.createDataFrame([(WIN.format("4624", "-"),)], "value string"), "windows_auth")).collect()
    body = json.loads(row.value)
    assert body["event_time"] == "2026-07-01T11:42:07+00:00" and body["src_ip"] is None
