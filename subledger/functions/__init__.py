from subledger.functions.scalars import (
    flag,
    iso_date,
    lower_trim,
    money,
    month_start,
    months_between_boundaries,
    multi_format_date,
    positive_money,
    text_to_bool,
    upper_trim,
    whole_number,
)

__all__ = [
    "flag",
    "iso_date",
    "lower_trim",
    "money",
    "month_start",
    "months_between_boundaries",
    "multi_format_date",
    "positive_money",
    "text_to_bool",
    "upper_trim",
    "whole_number",
]
