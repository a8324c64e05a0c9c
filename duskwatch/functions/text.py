"""Display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted_list(values: Column) -> Column:
    """``['a', 'b']`` from an array of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", "), F.lit("]"))


def or_none(value: Column) -> Column:
    return F.coalesce(value, F.lit("None"))


def micros_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with offset; the fraction is printed only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micro = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(
        whole,
        F.when(micro > 0, F.concat(F.lit("."), F.lpad(micro.cast("string"), 6, "0"))).otherwise(F.lit("")),
        F.lit("+00:00"),
    )
