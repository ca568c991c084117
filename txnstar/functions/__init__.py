from txnstar.functions.columns import (
    absolute,
    date_key,
    is_suspicious,
    parse_mixed,
    parse_timestamp,
    timestamp_text,
    to_double,
    to_int,
)

__all__ = [
    "absolute",
    "date_key",
    "is_suspicious",
    "parse_mixed",
    "parse_timestamp",
    "timestamp_text",
    "to_double",
    "to_int",
]
