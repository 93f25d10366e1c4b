"""Columns over raw event text and over the variant ``event`` column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.schema import EVENT_FIELDS

_JSON_SPACE = " \t\r\n"
_ISO_TYPES = ("date", "timestamp_ntz")
_FLAT_OBJECT = r"^[ \t\r\n]*\{[^{}\[\]]*\}[ \t\r\n]*$"
# A date, then perhaps a time, then perhaps an offset; the cast checks the numbers.
_ISO_TEXT = (
    r"^\s*\d{4}-\d{2}-\d{2}"
    r"([T ]\d{1,2}:\d{1,2}(:\d{1,2}([.]\d{1,9})?)?)?"
    r"\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)?\s*$"
)


def decode_text(value: Column) -> Column:
    """Message bytes (or text) as text; NULL when not valid UTF-8."""
    return F.try_validate_utf8(value.cast("binary").cast("string"))


def one_line(text: Column) -> Column:
    """A JSON document on one line.

    JSON allows a raw line break only between tokens, so turning breaks into
    blanks keeps the document.
    """
    has_break = F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    return F.when(has_break, F.translate(text, "\r\n", "  ")).otherwise(text)


def parse_event(line: Column) -> Column:
    """The line as a variant; NULL when it is not one valid JSON document.

    Spark's parser passes over whatever follows the first document. Nothing can follow an
    object without inner braces or brackets that spans the line. Any other line must also
    be valid as the one element of a list and as the one value of an object: what
    follows a document cannot go on both.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"line":'), line, F.lit("}")))
    alone = line.rlike(_FLAT_OBJECT) | (in_list.isNotNull() & in_object.isNotNull())
    return F.when(alone, F.try_parse_json(line))


def is_blank(line: Column) -> Column:
    return F.trim(line, F.lit(_JSON_SPACE)) == F.lit("")


def is_json_object(line: Column, event: Column) -> Column:
    """Whether the line parsed and its document is an object."""
    return event.isNotNull() & F.ltrim(line, F.lit(_JSON_SPACE)).startswith("{")


def _path(name: str) -> str:
    return f"$.{name}"


def field_text(name: str, event: str = "event") -> Column:
    """The field as text, whatever its type."""
    return F.try_variant_get(event, _path(name), "string")


def from_iso(text: Column, data_type: str) -> Column:
    """A date or time read from ISO text; NULL for any other text."""
    return F.when(text.rlike(_ISO_TEXT), text.try_cast(data_type))


def field(name: str, event: str = "event") -> Column:
    """A field of the event in its declared type; a value that cannot be cast fails.

    The scan extracts only text or the raw value, and the cast follows on the rows
    that are left. A strict typed extraction would run inside the Parquet reader
    for every row, also for those a filter drops, and so a bad value of an
    unrelated event would fail the query.
    """
    data_type = EVENT_FIELDS[name]
    if data_type == "string":
        column = F.variant_get(event, _path(name), "string")
    elif data_type in _ISO_TYPES:
        text = field_text(name, event)
        failure = F.raise_error(F.concat(F.lit(f"{name} is not a {data_type}: "), text))
        column = F.coalesce(
            from_iso(text, data_type), F.when(text.isNotNull(), failure.cast(data_type))
        )
    else:
        column = F.variant_get(F.variant_get(event, _path(name), "variant"), "$", data_type)
    return column.alias(name)


def field_or_null(name: str, event: str = "event") -> Column:
    """Like ``field`` but NULL where the value cannot be cast."""
    data_type = EVENT_FIELDS[name]
    if data_type in _ISO_TYPES:
        return from_iso(field_text(name, event), data_type).alias(name)
    return F.try_variant_get(event, _path(name), data_type).alias(name)


def field_failed(name: str, event: str = "event") -> Column:
    """Whether the field holds a value (other than JSON null) that cannot be cast."""
    return field_or_null(name, event).isNull() & field_text(name, event).isNotNull()


def any_field_failed(names: tuple[str, ...], event: str = "event") -> Column:
    """Whether one of the fields fails; text never does."""
    checked = [name for name in names if EVENT_FIELDS[name] != "string"]
    return reduce(Column.__or__, (field_failed(name, event) for name in checked))


def has_field(name: str, event: str = "event") -> Column:
    """Whether the event carries the field; a JSON null counts as carried."""
    return F.variant_get(event, _path(name), "variant").isNotNull()


def encode_json(*columns: str) -> Column:
    """The columns as one JSON object; NULL columns are left out."""
    return F.to_json(F.struct(*columns))


def iso_utc(time: Column) -> Column:
    """A zone-less UTC time as ISO-8601 text with microseconds and offset.

    Built from the plain text of the time: ``date_format`` would move it through
    the session time zone, which skips an hour a year.
    """
    text = time.cast("timestamp_ntz").cast("string")
    micros = F.rpad(F.substring(text, 21, 6), 6, "0")
    return F.concat(
        F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), micros, F.lit("+00:00")
    )
