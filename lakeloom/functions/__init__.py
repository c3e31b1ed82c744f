from lakeloom.functions.scalar import (  # noqa: F401
    avg_of, count_when, day_of_week, in_dates, net_of, ratio, sum2, sum4, sum_when,
)
from lakeloom.functions.normalize import normalized, row_hash  # noqa: F401
