"""Column expressions: time handling and predicates."""

from gridmart.functions.predicates import (any_null, count_nulls, exact_mean,
                                           first_non_null_by, not_in)
from gridmart.functions.timecols import (as_instant, between_closed, day_range,
                                         epoch_hour, feed_local_date,
                                         hour_key,
                                         instant_to_local_wall, local_date,
                                         local_hour, parse_offset_instant,
                                         parse_wall_ntz, to_local_wall,
                                         ts_literal, utc_literal,
                                         utc_wall)

__all__ = [
    "any_null", "count_nulls", "exact_mean", "first_non_null_by", "not_in",
    "as_instant", "between_closed", "day_range", "epoch_hour", "feed_local_date",
    "hour_key", "instant_to_local_wall", "local_date",
    "local_hour", "parse_offset_instant", "parse_wall_ntz", "to_local_wall",
    "ts_literal", "utc_literal", "utc_wall",
]
