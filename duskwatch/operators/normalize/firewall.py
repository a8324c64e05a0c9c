"""Firewall CSV: ``ts,host,action,protocol,src_ip,dst_ip,dst_port``."""

from pyspark.sql import functions as F

from duskwatch.operators.normalize.base import Normalizer, parse_utc_z, stripped, when_in

# What each action means.
EVENT_TYPES = {"BLOCK": "conn_denied", "DROP": "conn_denied", "ALLOW": "conn_allowed"}
SEVERITIES = {"BLOCK": "medium", "DROP": "medium", "ALLOW": "low"}


def _captures(line):
    parts = F.split(line, ",", -1)
    spaced = line.rlike(r"(?U)[\s\x1c-\x1f]")  # most lines hold no blank at all
    return F.when(F.size(parts) == 7, F.when(spaced, F.transform(parts, stripped)).otherwise(parts))


def _fields(c, _details, _year):
    action = F.upper(c[2])
    port = F.when(c[6].rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"),
                  F.regexp_replace(c[6], "_", "").try_cast("int"))
    return {
        # without a port number the line is malformed as a whole
        "event_time": F.when(port.isNotNull(), parse_utc_z(c[0])),
        "event_type": F.when(c.isNotNull(), when_in(action, EVENT_TYPES, "unknown_action")),
        "severity": when_in(action, SEVERITIES, "low"),
        "host": c[1],
        "src_ip": c[4],
        "dst_ip": c[5],
        "dst_port": port,
        "additional_data": F.create_map(F.lit("protocol"), c[3], F.lit("action"), action),
    }


NORMALIZER = Normalizer("firewall", lambda line: line, _captures, _fields)
