from roadspeed.functions.numbers import finite_or_zero, is_finite, nan_to_null, z_score
from roadspeed.functions.stamps import (
    day_from_path,
    floor_div,
    micros,
    minute_of_day,
    pad_day,
    pad_time,
    parse_mixed_ts,
    parse_stamp,
    slot_start,
    trailing_range,
)

__all__ = [
    "day_from_path", "finite_or_zero", "floor_div", "is_finite", "micros", "minute_of_day", "nan_to_null",
    "pad_day", "pad_time", "parse_mixed_ts", "parse_stamp", "slot_start", "trailing_range", "z_score",
]
