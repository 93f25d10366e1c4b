"""Column functions: variant fields, JSON text, calendar parts."""

from shelfwise.functions.calendar import calendar_parts, date_path, day_of_week, utc_today
from shelfwise.functions.events import (
    decode_text,
    encode_json,
    field,
    field_failed,
    field_or_null,
    has_field,
    is_json_object,
    iso_utc,
    one_line,
    parse_event,
)

__all__ = [
    "calendar_parts",
    "date_path",
    "day_of_week",
    "decode_text",
    "encode_json",
    "field",
    "field_failed",
    "field_or_null",
    "has_field",
    "is_json_object",
    "iso_utc",
    "one_line",
    "parse_event",
    "utc_today",
]
