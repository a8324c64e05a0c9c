"""Physical plans: how often rows are shuffled, and what reaches the scan."""

import re

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import detect
from duskwatch.operators.features import build_features
from duskwatch.plans import dashboard, searches
from duskwatch.schemas import EVENTS, INTEL
from duskwatch.settings import Settings


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events")) + "/t"
    null = lambda f: F.lit(None).cast(f.dataType).alias(f.name)
    known = {"id": F.col("id"), "event_time": F.timestamp_seconds(F.col("id") * 60 + 1_767_225_600),
             "src_ip": F.concat(F.lit("10.0.0."), F.col("id") % 9), "username": F.concat(F.lit("u"), F.col("id") % 7),
             "event_type": F.when(F.col("id") % 2 == 0, "login_failure").otherwise("login_success"),
             "source_type": F.lit("linux_ssh"), "host": F.lit("h"), "severity": F.lit("low")}
    (spark.range(3000).select(*[known[f.name].cast(f.dataType).alias(f.name) if f.name in known else null(f) for f in EVENTS])
     .write.parquet(path))
    return spark.read.schema(EVENTS).parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|Single|RoundRobin)\w*partitioning|Exchange SinglePartition", plan(df)))


def test_threshold_windows_shuffle_once(events):
    assert shuffles(detect.detect_brute_force(events)) == 1
    assert shuffles(detect.detect_multiple_failed_auth(events)) == 1


def test_threshold_windows_of_whole_keys_stay_native(events):
    for rule in (detect.detect_brute_force, detect.detect_multiple_failed_auth):
        text = plan(rule(events))
        assert "Arrow" not in text and "Python" not in text and "Pandas" not in text


def test_cut_threshold_windows_read_the_events_a_few_times(events):
    text = plan(detect.detect_brute_force(events, Settings(max_rows_per_task=50)))
    assert len(re.findall(r"FileScan parquet \[[^\]]*event_type", text)) <= 1  # whole keys; cut ones are read from what was written
    assert len(re.findall("FileScan", text)) <= 5


def test_travel_and_features_shuffle_once(events):
    assert shuffles(detect.detect_impossible_travel(events)) == 1
    assert shuffles(build_features(events)) == 1


def test_stateless_rules_do_not_shuffle(spark, events):
    assert shuffles(detect.detect_unusual_login_hours(events)) == 0
    intel = spark.createDataFrame([("10.0.0.1", "x", 1, "y")], INTEL)
    hits = plan(detect.intel_hits(events, intel))
    assert "BroadcastHashJoin" in hits and "SortMergeJoin" not in hits
    large = plan(detect.intel_hits(events, intel, Settings(max_broadcast_rows=0)))
    assert "ResolvedHint" not in large and "strategy=broadcast" not in large


def test_group_rules_aggregate_before_the_shuffle(events):
    text = plan(dashboard.login_heatmap(events))
    assert "partial_count" in text and shuffles(dashboard.login_heatmap(events)) == 1
    # the aggregation of a group rule, which the rule itself writes out before it gathers small groups' ids
    groups = plan(detect._summed(detect.privilege_events(events), ["username", "host"], "src_ip"))
    for name in ("partial_count", "partial_max", "partial_min_by", "partial_bit_xor"):
        assert name in groups.replace("minby", "min_by").replace("bitxor", "bit_xor"), name


def test_filters_and_columns_reach_the_scan(events):
    text = plan(detect.detect_brute_force(events))
    assert "EqualTo(event_type,login_failure)" in text and "IsNotNull(src_ip)" in text
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"id", "event_time", "username", "src_ip", "event_type"}
    text = plan(searches.top_attackers(events))
    columns = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {"src_ip", "event_type"}


def test_top_k_is_not_a_full_sort(events):
    assert "TakeOrderedAndProject" in plan(searches.top_attackers(events))
