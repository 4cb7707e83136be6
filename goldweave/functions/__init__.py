from goldweave.functions.scalars import (
    blank_to_null,
    concat_text,
    is_bad_offset_date,
    next_sequence,
    parse_offset_ts,
    round_to_hour,
    stride_seconds,
    timestamp_text,
    try_parse_offset_ts,
)

__all__ = [
    "blank_to_null",
    "concat_text",
    "is_bad_offset_date",
    "next_sequence",
    "parse_offset_ts",
    "round_to_hour",
    "stride_seconds",
    "timestamp_text",
    "try_parse_offset_ts",
]
