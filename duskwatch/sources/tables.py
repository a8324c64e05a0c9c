"""The stored tables: Parquet folders under one root.

Plain Parquet has no transactions, so each kind of change has its own layout:

* append by batch (raw lines, events, rejects): one folder per batch. A batch
  that is run again overwrites only its own folder, so a retry adds nothing.
* append if new (alerts): anti-joined with what is stored, single writer.
* replace (threat feed, scores): each run writes a new version folder; readers
  take the newest complete one. A failed run leaves the old version in force.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskwatch import schemas
from duskwatch.operators.alerts import ALERT_COLUMNS, alert_evidence, not_stored
from duskwatch.operators.detect import HIT_COLUMNS
from duskwatch.operators.intel import upsert
from duskwatch.session import delete_path, materialize


_EVIDENCE = "rule_name string, group_key string, src_ip string, username string, host string, event_time timestamp, id bigint, run bigint"
_MARKS = "alert_id string, rule_name string, group_key string, run bigint"


class VersionedTable:
    """A table replaced as a whole, as numbered folders ``v=<n>``."""

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def versions(self, label: str = "v") -> list[int]:
        """Complete versions, ascending."""
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{label}=*/_SUCCESS")
        fs = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = fs.globStatus(pattern) or []
        return sorted(int(s.getPath().getParent().getName().partition("=")[2]) for s in found)

    def read(self, version: int | None = None) -> DataFrame:
        if version is None:
            known = self.versions()
            version = known[-1] if known else None
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version:012d}")

    def replace(self, df: DataFrame, version: int | None = None) -> int:
        if version is None:
            known = self.versions()
            version = known[-1] + 1 if known else 0
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]
        df.select(*columns).write.mode("overwrite").parquet(f"{self.path}/v={version:012d}")
        return version

    def prune(self, keep: int = 10) -> None:
        """Delete all but the newest ``keep`` versions."""
        for version in self.versions()[:-keep]:
            delete_path(self.spark, f"{self.path}/v={version:012d}")


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.intel = VersionedTable(spark, f"{self.root}/threat_intel_ips", schemas.INTEL_TABLE)
        self.scores = VersionedTable(spark, f"{self.root}/ml_anomaly_scores", schemas.SCORES)
        self.id_ranges = VersionedTable(spark, f"{self.root}/id_ranges", T.StructType(
            [T.StructField(name, T.LongType()) for name in ("ingest_batch", "first", "n")]))
        # what a run of detection on changes has seen: ingest batches and addresses of the feed
        self.seen_batches = VersionedTable(spark, f"{self.root}/seen_batches", T.StructType([T.StructField("ingest_batch", T.LongType())]))
        self.seen_ips = VersionedTable(spark, f"{self.root}/seen_ips", T.StructType([T.StructField("src_ip", T.StringType())]))

    def _read(self, table: str, schema, partitions: str) -> DataFrame:
        full = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", " + partitions
        path = f"{self.root}/{table}"
        if not self._exists(path):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(path)

    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    # ---- raw lines, events, rejects: append by batch

    def raw_logs(self) -> DataFrame:
        columns = [f.name for f in schemas.RAW_LOGS]
        return (self._read("raw_logs", [f for f in schemas.RAW_LOGS if f.name != "source_type"], "ingest_batch bigint, source_type string")
                .select(*columns, "ingest_batch"))

    def events(self, since: datetime | None = None) -> DataFrame:
        """Normalised events; ``since`` prunes day folders and is pushed into the scan."""
        df = self._read("normalized_events", schemas.EVENTS, "ingest_batch bigint, event_date date")
        if since is not None:
            at = F.lit(since).cast("timestamp")
            df = df.filter((F.col("event_date") >= F.to_date(at)) & (F.col("event_time") >= at))
        return df

    def rejects(self) -> DataFrame:
        full = "raw_id bigint, source_type string, raw_message string, path string, reason string, ingest_batch bigint"
        path = f"{self.root}/rejects"
        return self.spark.read.schema(full).parquet(path) if self._exists(path) else self.spark.createDataFrame([], full)

    def reserve_ids(self, batch: int, n: int) -> int:
        """First of ``n`` ids kept for a batch, past those of all others. A batch that is run again keeps its ids unless it has grown.

        The ranges are a table of one row per batch; of raw lines nothing is read, but for a store that has lines and no ranges yet.
        """
        ranges = self.id_ranges.read()
        own = ranges.where(F.col("ingest_batch") == batch).first()
        if own and own["n"] >= n:
            return own["first"]
        top = ranges.agg(F.max(F.col("first") + F.col("n"))).first()[0]
        if top is None:
            last = self.raw_logs().agg(F.max("raw_id")).first()[0]
            top = 0 if last is None else last + 1
        row = self.spark.createDataFrame([(batch, top, n)], self.id_ranges.schema)
        self.id_ranges.replace(ranges.where(F.col("ingest_batch") != batch).unionByName(row))
        self.id_ranges.prune(3)
        return top

    def write_batch(self, table: str, df: DataFrame, batch: int, by: str | None = None, rebalance: bool = False) -> None:
        if rebalance:
            # Keeps files few and even: AQE splits a crowded partition, merges thin ones.
            df = df.hint("rebalance", by)
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{table}/ingest_batch={batch}")

    # ---- threat feed: upsert by address

    def upsert_intel(self, feed: DataFrame, added_at: datetime | None = None) -> int:
        """Insert or update the feed's rows in order; returns how many rows the feed had.

        A feed read ``with_place`` is ordered by file name, then by place in the file; of any other the row order counts.
        """
        stamp = F.lit(added_at).cast("timestamp") if added_at else F.current_timestamp()
        placed = "feed_file" in feed.columns
        place = [F.col("feed_file"), F.col("feed_block")] if placed else [F.lit("").alias("feed_file"), F.lit(0).cast("bigint").alias("feed_block")]
        incoming = (feed.select("ip", "category", "confidence", "source", stamp.alias("added_at"), *place)
                    .withColumn("pos", F.struct("feed_file", "feed_block", F.monotonically_increasing_id().alias("row")))
                    .drop("feed_file", "feed_block"))
        incoming = materialize(incoming, "feed")
        self.intel.replace(upsert(self.intel.read(), incoming))
        return incoming.count()

    # ---- days whose alerts change, noted before they do

    def day_marks(self) -> list[int]:
        return VersionedTable(self.spark, f"{self.root}/alert_days", None).versions("mark")

    def marked_days(self) -> DataFrame:
        return self._log("alert_days", "detected_date date, mark bigint")

    def _mark_days(self, alerts: DataFrame) -> None:
        marks = self.day_marks()
        path = f"{self.root}/alert_days/mark={(marks[-1] + 1 if marks else 0):012d}"
        alerts.select(F.to_date("detected_at").alias("detected_date")).distinct().coalesce(1).write.mode("overwrite").parquet(path)

    # ---- alerts: append if new

    def _stored_alerts(self) -> DataFrame:
        return self._read("alerts", schemas.ALERTS, "detected_date date").select(*ALERT_COLUMNS, "detected_date")

    def alerts(self) -> DataFrame:
        """Stored alerts, without those that later data withdrew."""
        stored, path = self._stored_alerts(), f"{self.root}/alert_changes"
        if not self._exists(path):
            return stored
        return stored.join(self._withdrawn(), "alert_id", "left_anti").select(*stored.columns)

    def _withdrawn(self) -> DataFrame:
        changes = self.spark.read.schema("alert_id string, withdrawn boolean, change bigint").parquet(f"{self.root}/alert_changes")
        return changes.groupBy("alert_id").agg(F.max_by("withdrawn", "change").alias("withdrawn")).where("withdrawn").select("alert_id")

    def change_alerts(self, ids: DataFrame, withdrawn: bool) -> int:
        """Withdraw the alerts of ``ids`` (alert_id), or let withdrawn ones hold again; returns how many. The newest change counts."""
        staged = materialize(ids.select("alert_id").distinct(), "alert-changes")
        n = staged.count()
        if n:
            known = VersionedTable(self.spark, f"{self.root}/alert_changes", None).versions("change")
            self._mark_days(self._stored_alerts().join(staged, "alert_id", "left_semi"))
            path = f"{self.root}/alert_changes/change={(known[-1] + 1 if known else 0):012d}"
            staged.withColumn("withdrawn", F.lit(withdrawn)).write.mode("overwrite").parquet(path)
        return n

    def persist_alerts(self, alerts: DataFrame) -> int:
        """Store alerts whose (rule, set of event ids) is new; returns how many were stored."""
        staged = materialize(alerts.select(*ALERT_COLUMNS), "alerts-staged")
        days = staged.agg(F.min(F.to_date("detected_at")).alias("lo"), F.max(F.to_date("detected_at")).alias("hi")).first()
        if days.lo is None:
            return 0
        # The same evidence gives the same detected_at, so only its days can hold a duplicate.
        stored = self._stored_alerts().filter(F.col("detected_date").between(F.lit(days.lo), F.lit(days.hi)))
        if self._exists(f"{self.root}/alert_changes"):
            self.change_alerts(staged.join(self._withdrawn(), "alert_id", "left_semi"), withdrawn=False)
        new = materialize(not_stored(staged, stored), "alerts-new")
        written = new.count()
        if written:
            self._mark_days(new)
            (new.withColumn("detected_date", F.to_date("detected_at")).hint("rebalance", "detected_date")
             .write.mode("append").partitionBy("detected_date").parquet(f"{self.root}/alerts"))
        return written

    # ---- evidence of group alerts: a log that grows by what is new

    def _log(self, table: str, schema: str) -> DataFrame:
        path = f"{self.root}/{table}"
        return self.spark.read.schema(schema).parquet(path) if self._exists(path) else self.spark.createDataFrame([], schema)

    def evidence(self) -> DataFrame:
        """Every event a group rule ever rested on, once: ``HIT_COLUMNS`` and the ``run`` that logged it."""
        return self._log("alert_evidence", _EVIDENCE)

    def evidence_runs(self) -> list[int]:
        return VersionedTable(self.spark, f"{self.root}/alert_evidence", None).versions("run")

    def log_evidence(self, hits: DataFrame) -> int:
        """Append the rows of ``group_hits`` that are not logged yet; returns the number of the newest run.

        A group's evidence at a run is what was logged for it up to that run, so an alert needs no copy of its rows: it is
        marked with the run. A run that died is taken up by the next one, which finds its rows logged.
        """
        known = self.evidence_runs()
        new = hits.join(self.evidence().select("rule_name", "id"), ["rule_name", "id"], "left_anti") if known else hits
        staged = materialize(new.select(*HIT_COLUMNS), "evidence")
        run = known[-1] if known else -1
        if not staged.isEmpty():
            run += 1
            staged.write.mode("overwrite").parquet(f"{self.root}/alert_evidence/run={run:012d}")
        return run

    def marks(self) -> DataFrame:
        """The group and the newest evidence run of every group alert."""
        return self._log("alert_marks", _MARKS)

    def mark_alerts(self, ids: DataFrame, run: int) -> None:
        """Record which evidence the group alerts ``ids`` (alert_id, rule_name, group_key) rest on; written before the alerts themselves."""
        new = materialize(ids.join(self.marks().select("alert_id"), "alert_id", "left_anti").withColumn("run", F.lit(run).cast("bigint")), "marks")
        if not new.isEmpty():
            new.write.mode("append").parquet(f"{self.root}/alert_marks")

    def batches(self) -> list[int]:
        """Ingest batches whose events are stored."""
        return VersionedTable(self.spark, f"{self.root}/normalized_events", None).versions("ingest_batch")

    def alert_events(self) -> DataFrame:
        """The event ids of every stored alert, one per row: (alert_id, rule_name, event_id)."""
        marks = self.marks().withColumnRenamed("run", "upto")
        groups = self.evidence().join(marks, ["rule_name", "group_key"]).where("run <= upto").select(
            "alert_id", "rule_name", "event_time", F.col("id").alias("event_id"))
        return alert_evidence(self.alerts(), groups)
