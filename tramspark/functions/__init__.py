"""Column-expression helpers (all JVM-side, no UDFs)."""

from tramspark.functions.scalar import (  # noqa: F401
    METERS_PER_DEGREE,
    add_time_of_day,
    avg_of_scaled,
    code_label,
    day_of_week_sun0,
    duck_round,
    median_of_scaled,
    pct_where,
    planar_distance_m,
    seconds_between,
    time_bucket,
    to_second,
    try_date,
    try_double,
    try_int,
    try_timestamp,
)
