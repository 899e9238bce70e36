from tidemart.functions.dates import (
    day_type,
    month_index,
    quarter_of,
    season_of_month,
    time_attributes,
    time_id_of,
    to_order_date,
    week_monday_first,
)
from tidemart.functions.measures import (
    as_double,
    parse_price,
    percent_change,
    ratio,
    sales_amount,
    zero_if_null,
)

__all__ = [
    "as_double", "day_type", "month_index", "parse_price",
    "percent_change", "quarter_of", "ratio", "sales_amount",
    "season_of_month", "time_attributes", "time_id_of", "to_order_date",
    "week_monday_first", "zero_if_null",
]
