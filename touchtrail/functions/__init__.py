"""Column functions: built-in Spark expressions only."""

from .ids import surrogate_key
from .keys import digits, email_key, is_blank, phone_from_digits, phone_key, strip
from .once import with_values
from .payload import JsonDocument, json_scalar, parse_json_document, tag_code
from .temporal import days_between, instant, local_date, wall_clock, wall_clock_from_text
from .weights import event_weight, weight_label

__all__ = [
    "JsonDocument",
    "days_between",
    "digits",
    "email_key",
    "event_weight",
    "instant",
    "is_blank",
    "json_scalar",
    "local_date",
    "parse_json_document",
    "phone_from_digits",
    "phone_key",
    "strip",
    "surrogate_key",
    "tag_code",
    "wall_clock",
    "wall_clock_from_text",
    "weight_label",
    "with_values",
]
