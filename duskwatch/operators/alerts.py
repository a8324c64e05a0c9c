"""The alert contract, evidence of any size, and dedup against stored alerts.

Every detector returns ``ALERT_COLUMNS``. Rules whose evidence is bounded (k
failures, two logins, one login) carry ``event_ids`` themselves. The two rules
that report a whole group (known-bad address, privilege use per account and
host) may have a third of the table as evidence: their ids live one per row in
the evidence table, for groups of every size, and ``event_ids`` is NULL. Count
and identity are exact for every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.scoring import alert_id, ids_hashes, risk_score
from duskwatch.schemas import ALERTS

ALERT_COLUMNS = [f.name for f in ALERTS]


def alert_rows(df: DataFrame, *, rule: str, severity: str, title: Column, description: Column,
               detected_at: Column, src_ip: Column, username: Column, event_ids: Column | None = None,
               n_events: Column | None = None, hashes: tuple[Column, Column] | None = None,
               multiplier: Column | float = 1.0, extra: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to the contract; ``extra`` columns of ``df`` are kept behind it.

    Group rules give ``n_events`` and ``hashes`` in place of ``event_ids``.
    """
    n = F.size(event_ids).cast("bigint") if n_events is None else n_events
    h1, h2 = ids_hashes(event_ids) if hashes is None else hashes
    values = {
        "alert_id": alert_id(F.lit(rule), n, h1, h2),
        "rule_name": F.lit(rule),
        "severity": F.lit(severity),
        "src_ip": src_ip,
        "username": username,
        "host": F.lit(None),
        "title": title,
        "description": description,
        "risk_score": risk_score(severity, multiplier),
        "n_events": n,
        "event_ids": F.lit(None) if event_ids is None else event_ids,
        "detected_at": detected_at,
        "status": F.lit("open"),
    }
    return df.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in ALERTS], *extra)


def alert_evidence(alerts: DataFrame, groups: DataFrame) -> DataFrame:
    """Every alert's event ids, one per row (``alert_id``, ``rule_name``, ``event_id``).

    Bounded evidence is unfolded from the alert row; the ids of group alerts come from the
    evidence rows ``groups``. Rows of alerts that are not among ``alerts`` are left out.
    """
    inline = alerts.select("alert_id", "rule_name", F.explode("event_ids").alias("event_id"))
    grouped = alerts.filter("event_ids IS NULL").select("alert_id")
    return inline.unionByName(groups.join(grouped, "alert_id", "left_semi").select("alert_id", "rule_name", "event_id"))


def first_new(candidates: DataFrame) -> DataFrame:
    """One row per identity. Rows of one identity rest on the same evidence of the same rule."""
    return candidates.dropDuplicates(["alert_id"])


def not_stored(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Alerts whose (rule, set of event ids) is not stored yet, each once."""
    return first_new(candidates).join(stored.select("alert_id"), "alert_id", "left_anti").select(*ALERT_COLUMNS)
