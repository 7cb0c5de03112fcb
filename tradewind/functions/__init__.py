from tradewind.functions.columns import (
    date_key,
    elapsed_days,
    month_key,
    parse_timestamp,
    ratio,
    share,
    strip,
    strip_upper,
    title_case,
)

__all__ = [
    "date_key",
    "elapsed_days",
    "month_key",
    "parse_timestamp",
    "ratio",
    "share",
    "strip",
    "strip_upper",
    "title_case",
]
