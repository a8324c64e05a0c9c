"""IPv4 text as numbers, CIDR ranges, and great-circle travel, all as Column expressions."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_QUAD = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
IPV4 = rf"^{_OCTET}(\.{_OCTET}){{3}}$"
_HEX = "[0-9A-Fa-f]"
# Eight groups, or fewer around one "::"; the last two may be a dotted quad; a zone may follow.
IPV6 = (r"^(?!.*::.*::)(?!.*:::)(?!:[^:])(?!.*[^:]:(?:%|$))(?:"
        rf"(?:{_HEX}{{1,4}}:){{7}}{_HEX}{{1,4}}|(?:{_HEX}{{1,4}}:){{6}}{_QUAD}|"
        rf"(?=.*::)(?:{_HEX}{{0,4}}:){{2,7}}(?:{_HEX}{{0,4}}|{_QUAD}))(?:%[0-9A-Za-z]+)?$")

EARTH_RADIUS_KM = 6371.0  # fixed value


def is_ipv4(ip: Column) -> Column:
    return ip.rlike(IPV4)


def looks_like_ip(ip: Column) -> Column:
    """An IPv4 or IPv6 address."""
    return is_ipv4(ip) | ip.rlike(IPV6)


def ipv4_number(ip: Column) -> Column:
    """Dotted quad to BIGINT; NULL for anything that is not a valid IPv4 address."""
    part = F.split(ip, r"\.")
    number = sum((part[i].cast("bigint") * (1 << (24 - 8 * i)) for i in range(4)), F.lit(0).cast("bigint"))
    return F.when(is_ipv4(ip), number)


def strip_mask(ip: Column) -> Column:
    return F.split(ip, "/")[0]


def cidr_bounds(cidr: str) -> tuple[int, int, int]:
    """(first address, last address, prefix length) of a CIDR block given in configuration."""
    net = ipaddress.IPv4Network(cidr)
    return int(net.network_address), int(net.broadcast_address), net.prefixlen


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dlat = (phi2 - phi1) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    a = F.pow(F.sin(half_dlat), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlon), 2)
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def speed_kmh(distance_km: Column, seconds: Column) -> Column:
    """Implied speed; no elapsed time means infinite speed."""
    return F.when(seconds <= 0, F.lit(float("inf"))).otherwise(
        distance_km / (F.when(seconds > 0, seconds) / 3600))
