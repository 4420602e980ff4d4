from candlekit.functions.expressions import (
    monday_of,
    number,
    parse_timestamp,
    percent_return,
    seconds_since_epoch,
    symbol,
    whole_number,
)

__all__ = [
    "monday_of",
    "number",
    "parse_timestamp",
    "percent_return",
    "seconds_since_epoch",
    "symbol",
    "whole_number",
]
