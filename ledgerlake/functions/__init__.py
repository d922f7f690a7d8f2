"""Column-expression helpers."""

from ledgerlake.functions.columns import (  # noqa: F401
    any_true,
    blank_to_null,
    bucket_end,
    bucket_start,
    country_of,
    date_key,
    duration_micros,
    parse_event_time,
    reasons_of,
    to_amount,
)
