from posgraph.functions.columns import (
    birth_date, compact_datetime, flag, flat_names, flatten, joined_id, nest,
    parse_compact_datetime, parse_timestamp, try_cast,
)
from posgraph.functions.dates import date_bounds, day_bounds, day_list

__all__ = [
    "birth_date", "compact_datetime", "flag", "flat_names", "flatten", "joined_id", "nest",
    "parse_compact_datetime", "parse_timestamp", "try_cast",
    "date_bounds", "day_bounds", "day_list",
]
