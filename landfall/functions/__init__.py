"""Column-level helpers, all built from Spark's own functions."""

from landfall.functions.columns import (
    code_key,
    day_number,
    day_number_to_date,
    days_between,
    missing,
    named,
    null_tokens,
    period_columns,
    us_state_code,
)

__all__ = [
    "code_key",
    "day_number",
    "day_number_to_date",
    "days_between",
    "missing",
    "named",
    "null_tokens",
    "period_columns",
    "us_state_code",
]
