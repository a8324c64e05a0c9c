"""Feeds of several files: the later file wins, whichever is larger."""

import pytest

from duskwatch.sources.feed import read_feed
from duskwatch.sources.tables import Store


@pytest.mark.parametrize("larger", ["2026-01.csv", "2026-02.csv"])
def test_later_file_wins(spark, tmp_path, larger):
    folder = tmp_path / "feeds"
    folder.mkdir()
    for name, category in (("2026-01.csv", "old"), ("2026-02.csv", "new")):
        more = "".join(f"10.1.{i // 250}.{i % 250},bulk,1,s\n" for i in range(5000 if name == larger else 0))
        (folder / name).write_text(f"ip,category,confidence,source\n{more}192.0.2.7,{category},5,s\n192.0.2.8,{category}-a,5,s\n192.0.2.8,{category}-b,6,s\n")
    store = Store(spark, str(tmp_path / "store"))
    assert store.upsert_intel(read_feed(spark, str(folder), with_place=True)) == 5006
    got = {r["ip"]: (r["category"], r["confidence"]) for r in store.intel.read().where("ip like '192.%'").collect()}
    assert got == {"192.0.2.7": ("new", 5), "192.0.2.8": ("new-b", 6)}
    one = spark.createDataFrame([("192.0.2.7", "newest", 1, "s")], read_feed(spark, str(folder)).schema)
    store.upsert_intel(one)
    assert {r["category"] for r in store.intel.read().where("ip in ('192.0.2.7')").collect()} == {"newest"}
    assert store.intel.read().count() == 5002
