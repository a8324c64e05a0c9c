"""Where an address is: first matching range in table order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.net import cidr_bounds, ipv4_number
from duskwatch.operators.intel import hint_if_small
from duskwatch.schemas import GEO
from duskwatch.session import materialize

# Sample ranges (cidr, country, city, latitude, longitude), in order of precedence.
SAMPLE_RANGES = [
    ("10.0.0.0/8", "US", "Baltimore (Corporate HQ)", 39.2904, -76.6122),
    ("192.168.0.0/16", "US", "Baltimore (Corporate HQ)", 39.2904, -76.6122),
    ("203.0.113.0/24", "RU", "Moscow", 55.7558, 37.6173),
    ("198.51.100.0/24", "CN", "Beijing", 39.9042, 116.4074),
    ("185.220.101.0/24", "DE", "Frankfurt (Known Tor Exit)", 50.1109, 8.6821),
    ("45.155.204.0/24", "NL", "Amsterdam", 52.3676, 4.9041),
    ("103.21.244.0/24", "IN", "Mumbai", 19.0760, 72.8777),
    ("172.16.0.0/12", "US", "Baltimore (Corporate HQ)", 39.2904, -76.6122),
]
# A configured list up to this long becomes a CASE expression; longer feeds are joined.
INLINE_RANGES = 64

POINT = "struct<country:string,city:string,lat:double,lon:double>"


def sample_ranges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *row) for i, row in enumerate(SAMPLE_RANGES)], GEO)


def locate(df: DataFrame, ranges=SAMPLE_RANGES, ip: str = "src_ip") -> DataFrame:
    """Add ``geo`` from a configured list, of any length; longer ones are joined as a feed is.

    A short list is a CASE over the address number, no join, no shuffle. The number is a column of its own so
    that it is parsed once a row, not once a range.
    """
    if len(ranges) > INLINE_RANGES:
        feed = df.sparkSession.createDataFrame([(i, *row) for i, row in enumerate(ranges)], GEO)
        found = locate_distinct(df.filter(F.col(ip).isNotNull()), feed, ip)
        return df.join(found, ip, "left").select(*[df[c] for c in df.columns], "geo")
    found = None
    for cidr, country, city, lat, lon in ranges:
        lo, hi, _ = cidr_bounds(cidr)
        point = F.struct(F.lit(country).alias("country"), F.lit(city).alias("city"),
                         F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))
        inside = F.col("_ip_number").between(lo, hi)
        found = F.when(inside, point) if found is None else found.when(inside, point)
    geo = F.lit(None).cast(POINT) if found is None else found
    return df.withColumn("_ip_number", ipv4_number(F.col(ip))).withColumn("geo", geo).drop("_ip_number")


def locate_distinct(ips: DataFrame, ranges: DataFrame, ip: str = "src_ip") -> DataFrame:
    """(ip, geo) for each distinct address found in a geo feed of any size.

    An address lies in a CIDR block iff its leading bits equal the block's, so this is
    an equi-join on (prefix length, leading bits): at most 33 probes an address, one
    per length in use, and never a range or cross join.
    """
    prefix = F.split("cidr", "/")[1].cast("int")
    start = ipv4_number(F.split("cidr", "/")[0])
    host_bits = F.lit(32) - prefix
    blocks = ranges.select(
        prefix.alias("_len"), F.call_function("shiftright", start, host_bits).alias("_net"), "priority",
        F.struct("country", "city", "lat", "lon").alias("geo")).filter("_net IS NOT NULL")
    lengths = F.array(*[F.lit(i) for i in range(33)])
    probes = (ips.select(ip).distinct().withColumn("_n", ipv4_number(F.col(ip)))
              .withColumn("_len", F.explode(lengths))
              .withColumn("_net", F.call_function("shiftright", F.col("_n"), F.lit(32) - F.col("_len"))))
    used = blocks.select("_len").distinct()  # at most 33 rows
    probes = probes.join(F.broadcast(used), "_len", "left_semi")
    return (probes.join(blocks, ["_len", "_net"])
            .groupBy(ip).agg(F.min_by("geo", "priority").alias("geo")))


def locate_all(df: DataFrame, ranges: DataFrame, ip: str = "src_ip", max_broadcast_rows: int = 200_000) -> DataFrame:
    """Add ``geo`` (NULL where unknown); the feed is searched once per distinct address."""
    found = materialize(locate_distinct(df.filter(F.col(ip).isNotNull()), ranges, ip), "located")
    # One row per address: broadcast when counted small, else AQE splits the side of a hot address.
    return df.join(hint_if_small(found, max_broadcast_rows), ip, "left")
