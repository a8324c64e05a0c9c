"""Combined access log lines."""

from pyspark.sql import functions as F

from duskwatch.operators.normalize.base import Normalizer, pack, unpack

# Line shape (referer and sizes are matched, not kept) and path markers of probing.
PATTERN = (r'(\S+)\s+\S+\s+(\S+)\s+\[([^\]]+)\]\s+"(\S+)\s+(\S+)\s+[^"]+"\s+'
           r'(\d{3})\s+\S+\s+"[^"]*"\s+"([^"]*)".*$')
SUSPICIOUS_PATHS = ["wp-login.php", "/admin", "phpmyadmin", "../", "etc/passwd", "select%20",
                    "union%20select", ".env", "wp-admin"]


def is_suspicious_path(path):
    lowered = F.lower(path)
    hit = F.lit(False)
    for marker in SUSPICIOUS_PATHS:
        hit = hit | lowered.contains(marker)
    return hit


def classify(status, path):
    """An authentication refusal outranks a suspicious path."""
    refused = status.isin(401, 403)
    probing = is_suspicious_path(path)
    event_type = (F.when(refused, F.lit("http_auth_failure"))
                  .when(probing, F.lit("http_suspicious_request")).otherwise(F.lit("http_request")))
    severity = F.when(refused, F.lit("medium")).when(probing, F.lit("high")).otherwise(F.lit("low"))
    return event_type, severity


def _fields(c, _details, _year):
    ip, user, stamp, method, path, status_text, agent = (c[i] for i in range(7))
    status = status_text.try_cast("int")
    event_type, severity = classify(status, path)
    parsed = [F.try_to_timestamp(stamp, F.lit(f"d/MMM/yyyy:H:m:s {zone}")) for zone in ("XX", "XXX")]
    return {
        "event_time": F.coalesce(*parsed),
        "event_type": event_type,
        "severity": severity,
        "username": F.nullif(user, F.lit("-")),
        "src_ip": ip,
        "status_code": status,
        "additional_data": F.create_map(F.lit("method"), method, F.lit("path"), path,
                                        F.lit("user_agent"), agent),
    }


NORMALIZER = Normalizer("web_server", lambda line: pack(line, PATTERN, 7),
                        lambda packed: unpack(packed, 7), _fields)
