from clickmart.functions.scalars import (  # noqa: F401
    day_bucket,
    epoch_micros,
    floor_div,
    floor_seconds,
    hour_bucket,
    idiv,
    is_type,
    mean2,
    micros_between,
    ntz_lit,
    parse_event_time,
    pct2,
)
