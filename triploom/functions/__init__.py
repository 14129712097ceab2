"""Column expressions used by the operators. All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from triploom.functions.parsing import (  # noqa: F401
    parse_datetime, try_parse_datetime, point_x, point_y, strip_text,
    normalize_zero, POINT_PATTERN,
)
from triploom.functions.timeofday import (  # noqa: F401
    time_of_day, half_hour_bucket, time_range_label,
)
from triploom.functions.calendar import week_key, WEEK_KEYS  # noqa: F401
from triploom.functions.geo import Box, in_box  # noqa: F401
