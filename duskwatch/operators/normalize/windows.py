"""Windows security events: ``ts EventID= Account= LogonType= SourceIP= Workstation= Status=``."""

from pyspark.sql import functions as F

from duskwatch.operators.normalize.base import Normalizer, pack, parse_utc_z, unpack, when_in

# Line shape and the meaning of each event id.
PATTERN = (r"(\S+)\s+EventID=(\d+)\s+Account=(\S+)\s+LogonType=(\d+)\s+SourceIP=(\S+)\s+"
           r"Workstation=(\S+)\s+Status=(\S+).*$")
EVENT_TYPES = {
    "4624": "login_success",
    "4625": "login_failure",
    "4672": "privilege_escalation",
    "4720": "account_created",
    "4728": "group_membership_change",
}
SEVERITIES = {"4624": "low", "4625": "medium", "4672": "high", "4720": "medium", "4728": "high"}


def _fields(c, _details, _year):
    stamp, event_id, account, logon_type, src_ip, workstation, status = (c[i] for i in range(7))
    return {
        "event_time": parse_utc_z(stamp),
        "event_type": when_in(event_id, EVENT_TYPES, "unknown_event"),
        "severity": when_in(event_id, SEVERITIES, "low"),
        "host": workstation,
        "username": account,
        "src_ip": F.nullif(src_ip, F.lit("-")),
        "additional_data": F.create_map(F.lit("event_id"), event_id, F.lit("logon_type"), logon_type,
                                        F.lit("status"), status),
    }


NORMALIZER = Normalizer("windows_auth", lambda line: pack(line, PATTERN, 7),
                        lambda packed: unpack(packed, 7), _fields)
