from strata.functions.columns import (  # noqa: F401
    MONEY_TYPE,
    TIMESTAMP_PATTERN,
    fill_null_with,
    money,
    money_sum,
    month_index,
    month_label,
    month_label_of,
    parse_dates,
    parse_timestamp,
    rename_strict,
    snake_name,
    to_snake_case,
    try_parse_timestamp,
    unparsable_dates,
    uppercase_columns,
)
from strata.functions.joins import (  # noqa: F401
    bounded_broadcast,
    fits_broadcast,
    flag_membership,
)
