from tillroll.functions.columns import (
    category_level,
    day_of,
    from_units,
    parse_time,
    ratio,
    table_name_for_file,
    to_units,
)

__all__ = [
    "category_level",
    "day_of",
    "from_units",
    "parse_time",
    "ratio",
    "table_name_for_file",
    "to_units",
]
