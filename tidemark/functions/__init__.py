"""Column expressions (all built-in, JVM-side, codegen friendly)."""

from tidemark.functions.domains import normalise_domain
from tidemark.functions.labels import namespace_label, user_type_label
from tidemark.functions.times import (
    epoch_seconds_to_text,
    parse_event_time,
    time_auto,
    to_ntz,
    to_utc_timestamp_type,
    unix_millis_of,
)

__all__ = [
    "epoch_seconds_to_text",
    "namespace_label",
    "normalise_domain",
    "parse_event_time",
    "time_auto",
    "to_ntz",
    "to_utc_timestamp_type",
    "unix_millis_of",
    "user_type_label",
]
