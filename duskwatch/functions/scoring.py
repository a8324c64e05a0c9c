"""Risk score and evidence identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of each severity; anything else weighs 1.
SEVERITY_WEIGHT = {"low": 1, "medium": 3, "high": 6, "critical": 9}


def severity_weight(severity: Column) -> Column:
    weight = F.lit(1)
    for name, value in SEVERITY_WEIGHT.items():
        weight = F.when(severity == name, F.lit(value)).otherwise(weight)
    return weight


def risk_score(severity: Column | str, multiplier: Column | float = 1.0) -> Column:
    """``10 x weight x multiplier``, at most 100, two decimals."""
    if isinstance(severity, str):
        weight = F.lit(SEVERITY_WEIGHT.get(severity, 1))
    else:
        weight = severity_weight(severity)
    if not isinstance(multiplier, Column):
        multiplier = F.lit(float(multiplier))
    return F.round(F.least(weight * 10 * multiplier.cast("double"), F.lit(100.0)), 2)


# An alert's identity is its rule plus the *set* of its event ids. The set is
# reduced to a count and two independent 64-bit XOR hashes: order does not
# matter, and every part is a partial aggregate, so the identity of a group of
# any size is built map-side without gathering its ids anywhere.

_SECOND = 7


def ids_hashes(ids: Column) -> tuple[Column, Column]:
    zero = F.lit(0).cast("bigint")
    return (
        F.aggregate(ids, zero, lambda acc, x: acc.bitwiseXOR(F.xxhash64(x))),
        F.aggregate(ids, zero, lambda acc, x: acc.bitwiseXOR(F.xxhash64(x, F.lit(_SECOND)))),
    )


def group_hashes(event_id: Column) -> tuple[Column, Column]:
    return F.bit_xor(F.xxhash64(event_id)), F.bit_xor(F.xxhash64(event_id, F.lit(_SECOND)))


def alert_id(rule: Column, n: Column, h1: Column, h2: Column) -> Column:
    return F.concat_ws("-", rule, n.cast("string"), F.lower(F.hex(h1)), F.lower(F.hex(h2)))
