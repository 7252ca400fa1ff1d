from ordertide.functions.scalars import (  # noqa: F401
    COUNTRY_BY_CURRENCY,
    DEFAULT_TZ,
    business_key,
    currency_to_country,
    date_shift,
    day_bounds,
    event_date,
    format_millis,
    now_millis,
    ntz_from_millis,
    ntz_literal,
    ntz_to_millis,
    processing_millis,
    salted_key,
    second_to_millisecond,
    timestamp_from_millis,
    to_millis,
    truncate_millis,
)
from ordertide.functions.sql import register_functions  # noqa: F401
