from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskwatch.functions.net import looks_like_ip
from duskwatch.functions.text import iso_utc
from duskwatch.schemas import EVENTS, PARSED_COLUMNS

TEXT_ARRAY = T.ArrayType(T.StringType())
# The characters a Unicode-aware strip removes.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 " + "".join(
    chr(c) for c in range(0x2000, 0x200B)) + "    　"

_SEPARATOR, _ESCAPE = "\x01", "\x02"


@dataclass(frozen=True)
class Normalizer:
    """How one source's lines become events.

    ``pack(line)`` is the one regex pass (or the line itself), ``captures`` turns
    its result into an array of fields or NULL; ``details(captures)`` takes a
    nested message apart (NULL-able, optional); ``fields(captures, details,
    year)`` maps to event columns. A line whose ``event_time`` or ``event_type``
    comes out NULL is a reject.
    """

    source_type: str
    pack: Callable[[Column], Column]
    captures: Callable[[Column], Column]
    fields: Callable[[Column, Column, int], dict[str, Column]]
    details: Callable[[Column], Column] | None = None


NORMALIZERS: dict[str, Normalizer] = {}


def register(normalizer: Normalizer) -> None:
    NORMALIZERS[normalizer.source_type] = normalizer


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def blank(text: Column) -> Column:
    return F.coalesce(~text.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(True))


def pack(text: Column, pattern: str, n: int) -> Column:
    """The match rewritten to its ``n`` groups, each behind a separator: one regex pass.

    ``pattern`` starts at the first character that is not blank. Text that holds the separator itself has it escaped first and restored by ``unpack``.
    """
    whole = f"(?Us)^[\\s\\x1c-\\x1f]*{pattern}"
    safe = F.when(text.contains(_SEPARATOR) | text.contains(_ESCAPE),
                  F.replace(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "e")),
                            F.lit(_SEPARATOR), F.lit(_ESCAPE + "s"))).otherwise(text)
    return F.regexp_replace(safe, whole, "".join(f"{_SEPARATOR}${i}" for i in range(1, n + 1)))


def unpack(packed: Column, n: int) -> Column:
    """The groups as an array; NULL where the pattern did not match."""
    parts = F.slice(F.split(packed, _SEPARATOR, -1), 2, n)
    restored = F.transform(parts, lambda x: F.replace(F.replace(
        x, F.lit(_ESCAPE + "s"), F.lit(_SEPARATOR)), F.lit(_ESCAPE + "e"), F.lit(_ESCAPE)))
    return F.when(packed.startswith(_SEPARATOR), F.when(packed.contains(_ESCAPE), restored).otherwise(parts))


def groups(text: Column, pattern: str, n: int) -> Column:
    return unpack(pack(text, pattern, n), n)


def when_in(key: Column, table: dict[str, str], default: str) -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(key == name, F.lit(value)).otherwise(out)
    return out


def parse_utc_z(text: Column) -> Column:
    """``2026-07-01T08:15:32Z``, one-digit parts allowed."""
    return F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m:s'Z'"))


def _by_source(source: Column, pieces: dict[str, Column]) -> Column:
    if len(pieces) == 1:
        ((name, piece),) = pieces.items()
        return F.when(source == name, piece)
    out = None
    for name, piece in pieces.items():
        out = F.when(source == name, piece) if out is None else out.when(source == name, piece)
    return out


def normalize(raw: DataFrame, year: int | None = None, sources: list[str] | None = None,
              by_source: bool = False) -> DataFrame:
    """Add the event columns to rows of (``source_type``, ``raw_message``, ...).

    Blank lines are dropped. Lines that do not parse keep NULL event columns, so
    nothing is lost and nothing fails: split them off with ``rejects_of``.
    ``year`` completes syslog stamps, which carry none (default: this UTC year).

    ``by_source`` plans one small projection per source instead of one large CASE.
    Use it where the input is laid out by source (one read per source, or a table
    partitioned by ``source_type``): each branch then reads only its own files.
    """
    year = year or datetime.now(timezone.utc).year
    names = sources or list(NORMALIZERS)
    unknown = [n for n in names if n not in NORMALIZERS]
    if unknown:
        raise ValueError(f"unknown source_type {unknown}; options: {sorted(NORMALIZERS)}")
    if by_source and len(names) > 1:
        parts = [_project(raw.filter(F.col("source_type") == n), year, [n]) for n in names]
        others = raw.filter(~F.coalesce(F.col("source_type").isin(*names), F.lit(False)))
        return reduce(DataFrame.unionByName, [*parts, _project(others, year, names[:1])])
    return _project(raw, year, names)


def _project(raw: DataFrame, year: int, names: list[str]) -> DataFrame:
    used = {n: NORMALIZERS[n] for n in names}
    source, line = F.col("source_type"), F.col("raw_message")

    kept = [c for c in raw.columns if c not in PARSED_COLUMNS or c == "source_type"]
    df = raw.select(*kept).filter(~blank(F.col("raw_message")))
    df = df.withColumn("_p", _by_source(source, {n: z.pack(line) for n, z in used.items()}))
    df = df.withColumn("_c", _by_source(source, {n: z.captures(F.col("_p")) for n, z in used.items()}))
    nested = {n: z.details(F.col("_c")) for n, z in used.items() if z.details}
    df = df.withColumn("_d", _by_source(source, nested) if nested else F.lit(None).cast(TEXT_ARRAY))

    mapped = {n: z.fields(F.col("_c"), F.col("_d"), year) for n, z in used.items()}
    types = {f.name: f.dataType for f in EVENTS}
    out = []
    for name in PARSED_COLUMNS:
        if name == "source_type":
            continue
        pieces = {n: m[name].cast(types[name]) for n, m in mapped.items() if name in m}
        value = _by_source(source, pieces) if pieces else F.lit(None).cast(types[name])
        out.append(value.alias(name))
    # One-element inline(): later filters on event columns stop above it. As a plain projection
    # Catalyst would push them through and re-evaluate the whole parse inside the filter.
    df = df.select(*kept, F.inline(F.array(F.struct(*out))))
    # A line counts as an event only as a whole.
    good = F.col("event_time").isNotNull() & F.col("event_type").isNotNull()
    return df.select(*kept, *[F.when(good, F.col(n)).alias(n) for n in PARSED_COLUMNS if n != "source_type"])


def normalize_source(lines: DataFrame, source_type: str, year: int | None = None,
                     column: str = "value") -> DataFrame:
    """``normalize`` for a frame of lines that all come from one source."""
    raw = lines.withColumnRenamed(column, "raw_message").withColumn("source_type", F.lit(source_type))
    return normalize(raw, year, [source_type])


def reject_reason() -> Column:
    """NULL for a good event. Addresses must be IPs, as the event table's column demands."""
    bad = lambda c: F.col(c).isNotNull() & ~looks_like_ip(F.col(c))
    return (F.when(F.col("event_time").isNull(), F.lit("unparsed"))
            .when(bad("src_ip"), F.lit("src_ip is not an address"))
            .when(bad("dst_ip"), F.lit("dst_ip is not an address")))


def events_of(normalized: DataFrame) -> DataFrame:
    return normalized.filter(reject_reason().isNull())


def rejects_of(normalized: DataFrame) -> DataFrame:
    kept = [c for c in normalized.columns if c not in PARSED_COLUMNS or c == "source_type"]
    return normalized.withColumn("reason", reject_reason()).filter("reason IS NOT NULL").select(*kept, "reason")


def to_event_json(events: DataFrame) -> DataFrame:
    """One JSON text per event with an ISO-8601 ``event_time``; NULLs are kept."""
    fields = [iso_utc(F.col("event_time")).alias("event_time") if c == "event_time" else F.col(c)
              for c in events.columns]
    return events.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))
