from starloom.functions.calendar import calendar_attributes, date_hour_key, flags_mask
from starloom.functions.clean import (
    clean_text,
    coalesce_default,
    crlf_to_lf,
    duration_minutes,
    full_name,
    hour_of_time,
    line_amount,
    minus_one_micro,
    null_if_token,
    parse_time_of_day,
    seconds_to_hms,
    strip,
    time_to_hms,
    to_boolean,
    to_date,
    to_decimal,
    to_timestamp_ntz,
)
from starloom.functions.hashing import canonical_text, hash_key, normalise, row_hash

__all__ = [
    "calendar_attributes", "date_hour_key", "flags_mask", "clean_text", "coalesce_default", "crlf_to_lf",
    "duration_minutes", "full_name", "hour_of_time", "line_amount", "minus_one_micro", "null_if_token",
    "parse_time_of_day", "seconds_to_hms", "strip", "time_to_hms", "to_boolean", "to_date", "to_decimal",
    "to_timestamp_ntz", "canonical_text", "hash_key", "normalise", "row_hash",
]
