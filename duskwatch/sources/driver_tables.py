"""The test tables' ``events`` seen as normalised security events, and written back as log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping (see FIXTURES.md).
NETWORKS = ["10.0.0.", "192.168.1.", "203.0.113.", "198.51.100.", "185.220.101.", "45.155.204.",
            "103.21.244.", "172.16.0.", "8.8.8."]
SOURCES = ["windows_auth", "linux_ssh", "firewall", "web_server"]
SEVERITY_OF = {
    "login_success": "low", "login_failure": "medium", "privilege_escalation": "high",
    "conn_allowed": "low", "conn_denied": "medium", "http_request": "low",
    "http_auth_failure": "medium", "http_suspicious_request": "high",
}


def events_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.read.parquet(f"{sf_dir}/events.parquet")
    return map_events(raw)


def map_events(raw: DataFrame) -> DataFrame:
    # A one-element explode keeps k a column: inlined, the JSON would be parsed once per use.
    raw = raw.select("event_id", "ts", "user_id", "event_type",
                     F.explode(F.array(F.get_json_object("props", "$.k").cast("int"))).alias("k"))
    k = F.col("k")
    kind = F.col("event_type")
    pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), i + 1)
    event_type = (
        F.when(kind == "error", F.when(k % 4 == 3, "http_auth_failure").otherwise("login_failure"))
        .when(kind == "signup", "login_success")
        .when(kind == "view", F.when(k % 5 == 0, "http_suspicious_request").otherwise("http_request"))
        .when(kind == "click", F.when(k % 3 == 0, "conn_denied").otherwise("conn_allowed"))
        .when(kind == "purchase", "privilege_escalation"))
    severity = F.lit("low")
    for name, value in SEVERITY_OF.items():
        severity = F.when(F.col("event_type") == name, F.lit(value)).otherwise(severity)
    return raw.select(
        F.col("event_id").alias("id"), F.col("event_id").alias("raw_log_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        pick(SOURCES, k % 4).alias("source_type"),
        F.concat(F.lit("host"), (k % 7).cast("string")).alias("host"),
        F.when(k >= 5, F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("username"),
        F.when(k % 10 != 9, F.concat(pick(NETWORKS, F.least(k % 10, F.lit(8))),
                                     (F.col("user_id") % 5).cast("string"))).alias("src_ip"),
        event_type.alias("event_type"), k.alias("k"),
    ).withColumn("severity", severity)


# Event id written for each event type; the rest become an id nobody knows (9999).
WINDOWS_IDS = {"login_success": "4624", "login_failure": "4625", "privilege_escalation": "4672",
               "conn_denied": "4720", "http_suspicious_request": "4728"}


def as_lines(events: DataFrame) -> DataFrame:
    """(id, source_type, raw_message): each event written in its source's format.

    Lines with k = 98 are broken on purpose, so that rejects exist.
    """
    ip, user = F.coalesce("src_ip", F.lit("-")), F.coalesce("username", F.lit("-"))
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    event_id = F.lit("9999")
    for name, value in WINDOWS_IDS.items():
        event_id = F.when(F.col("event_type") == name, F.lit(value)).otherwise(event_id)
    windows = F.concat(stamp, F.lit(" EventID="), event_id, F.lit(" Account="), user, F.lit(" LogonType=3 SourceIP="), ip,
                       F.lit(" Workstation="), F.col("host"), F.lit(" Status=done"))
    prefix = F.concat(F.date_format("event_time", "MMM "), F.lpad(F.dayofmonth("event_time").cast("string"), 2, " "),
                      F.date_format("event_time", " HH:mm:ss "), F.col("host"))
    linux = (F.when(F.col("event_type") == "login_failure", F.concat(
                 prefix, F.lit(" sshd[7]: Failed password for invalid user "), user, F.lit(" from "), ip, F.lit(" port 22 ssh2")))
             .when(F.col("event_type") == "privilege_escalation", F.concat(
                 prefix, F.lit(" sudo: "), user, F.lit(" : TTY=pts/0 ; PWD=/ ; USER="),
                 F.when(F.col("k") % 8 == 1, "root").otherwise("www"), F.lit(" ; COMMAND=/bin/sh -c k"), F.col("k").cast("string")))
             .when(F.col("event_type") == "login_success", F.concat(
                 prefix, F.lit(" sshd[7]: Accepted publickey for "), user, F.lit(" from "), ip, F.lit(" port 22 ssh2")))
             .otherwise(F.concat(prefix, F.lit(" kernel: nothing of note"))))
    action = F.when(F.col("event_type") == "conn_denied", "block").when(
        F.col("event_type") == "conn_allowed", "ALLOW").when(F.col("event_type") == "login_failure", "DROP").otherwise("REJECT")
    firewall = F.concat_ws(",", stamp, F.col("host"), action, F.lit("TCP"), ip, F.lit("10.0.0.10"),
                           (F.col("k") + 1000).cast("string"))
    path = F.when(F.col("event_type") == "http_suspicious_request", "/app/.ENV").otherwise("/home")
    status = F.when(F.col("event_type") == "http_auth_failure", F.when(F.col("k") % 2 == 0, "401").otherwise("403")).otherwise("200")
    web = F.concat(ip, F.lit(" - "), user, F.date_format("event_time", " '['dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET '), path,
                   F.lit(' HTTP/1.1" '), status, F.lit(' 512 "-" "agent/'), F.col("k").cast("string"), F.lit('"'))
    line = (F.when(F.col("k") == 98, F.concat(F.lit("broken "), F.col("host")))
            .when(F.col("source_type") == "windows_auth", windows).when(F.col("source_type") == "linux_ssh", linux)
            .when(F.col("source_type") == "firewall", firewall).otherwise(web))
    return events.select("id", "source_type", line.alias("raw_message"))


def feed_from_events(raw: DataFrame) -> DataFrame:
    """A threat feed drawn from the events: the odd last octets of three networks.

    (ip, category, confidence, source), confidence the largest ``k`` seen.
    """
    norm = map_events(raw)
    return (norm.filter(F.col("src_ip").rlike(r"^(203\.0\.113|185\.220\.101|45\.155\.204)\.[13]$"))
            .groupBy(F.col("src_ip").alias("ip"))
            .agg(F.concat(F.lit("seen_in_"), F.min("source_type")).alias("category"),
                 F.max("k").alias("confidence"), F.lit("events").alias("source")))
