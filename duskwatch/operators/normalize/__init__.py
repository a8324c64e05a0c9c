"""Raw log line -> event columns, one native projection for any mix of sources.

A line goes through at most two regex passes whatever its source: one that
takes the whole line apart into an array, and one on the message part where the
format nests (syslog). Everything after that is array indexing.
"""

from duskwatch.operators.normalize.base import (
    NORMALIZERS, Normalizer, blank, events_of, normalize, normalize_source, register, rejects_of,
    to_event_json,
)
from duskwatch.operators.normalize import firewall, linux, web, windows

for _module in (windows, linux, firewall, web):
    register(_module.NORMALIZER)

__all__ = ["NORMALIZERS", "Normalizer", "blank", "events_of", "normalize", "normalize_source",
           "register", "rejects_of", "to_event_json"]
