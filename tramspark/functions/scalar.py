"""Scalar expressions shared by the operators.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen.  Several exist only to pin numeric
behaviour: doubles are rounded by binary scaling, text is parsed with the
same acceptance rules everywhere, averages and medians of rounded values are
taken over exact integers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's results.
# Metres per degree of latitude in the equirectangular approximation.
METERS_PER_DEGREE = 111320.0

# Accepted date and timestamp text (ISO order, 4-digit year,
# ' ' or 'T' before the time; a DATE cast also takes a timestamp's text).
_DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
_DATE_TIME_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*$"
_TS_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
# Wider forms: slashes between the date parts; after the time a zone (which the
# cast to a zone-less timestamp ignores) and blanks.
_TS_WIDE = (r"^\s*(\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2})"
            r"([ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?"
            r"(?:(?<=:\d{2}|\.\d{1,9})(?:Z| ?[+-]\d{2}(?::?\d{2})?| [A-Za-z][A-Za-z0-9_/+-]*)?\s*)?$")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def duck_round(x, n: int = 0) -> Column:
    """Round half away from zero after binary scaling: round(x*10^n)/10^n.

    Spark's ``round`` rounds the decimal text of a double (1.005 -> 1.01); the
    analytics this library reproduces scale in binary first (1.005 -> 1.0).
    """
    x = _c(x).cast("double")
    if n == 0:
        r = F.round(x)
    else:
        scale = float(10 ** n)
        r = F.round(x * F.lit(scale)) / F.lit(scale)
    # A small negative value rounds to -0.0 under binary scaling; Spark's
    # decimal rounding drops the sign, so restore it (x * 0.0 keeps it).
    return F.when(r == F.lit(0.0), x * F.lit(0.0)).otherwise(r)


# Number text accepted by the lenient casts.  Digits may be
# grouped by single underscores ('1_000'); integers also accept 0x / 0b
# prefixes ('0x1f', '0b101').
_GROUPED_NUMBER = r"^\s*[+-]?[0-9]+(_[0-9]+)*(\.[0-9]*(_[0-9]+)*)?([eE][+-]?[0-9]+)?\s*$"
_HEX_INT = r"^\s*0[xX][0-9a-fA-F]+\s*$"
_BIN_INT = r"^\s*0[bB][01]+\s*$"


def try_double(x) -> Column:
    """Text to DOUBLE, NULL when unparsable ('1_000' -> 1000.0).

    The plain cast runs first; forms only Java's parser takes ('1d', '2.5F',
    hex floats) are rejected by cheap string tests, and the digit-group
    rule (a regex) runs only for text containing '_'.
    """
    x = _c(x)
    t = F.lower(F.trim(x))
    java_only = t.endswith("d") | (t.endswith("f") & ~t.endswith("inf")) | t.contains("0x")
    plain = F.when(~java_only, x.try_cast("double"))
    grouped = F.when(x.contains("_") & x.rlike(_GROUPED_NUMBER), F.regexp_replace(x, "_", "").try_cast("double"))
    return F.coalesce(plain, grouped)


def try_int(x) -> Column:
    """Text to INT the way a lenient SQL cast does it: '1.5' -> 2, '1e3' -> 1000,
    '0x10' -> 16, '0b101' -> 5; NULL when unparsable or out of range."""
    x = _c(x)
    t = F.trim(x)
    lt = F.lower(t)
    d = (F.when(lt.startswith("0x") & t.rlike(_HEX_INT), F.conv(F.substring(t, 3, 64), 16, 10).try_cast("double"))
         .when(lt.startswith("0b") & t.rlike(_BIN_INT), F.conv(F.substring(t, 3, 64), 2, 10).try_cast("double"))
         .otherwise(try_double(x)))
    # whole numbers take the first cast; what is out of range or no number at all gives NULL in the last one
    return F.coalesce(x.try_cast("int"), F.round(d).try_cast("int"))


def _wide_timestamp(x: Column) -> Column:
    """Date and time of the wider forms without zone and slashes, as TIMESTAMP_NTZ."""
    day = F.regexp_replace(F.regexp_extract(x, _TS_WIDE, 1), "/", "-")
    return F.concat(day, F.regexp_extract(x, _TS_WIDE, 2)).try_cast("timestamp_ntz")


def try_date(x) -> Column:
    """Text to DATE; needs a full ``YYYY-M-D`` or ``YYYY/M/D`` ('2026' is NULL); a valid time
    part may follow (an invalid one makes the value NULL)."""
    x = _c(x)
    return (F.when(x.rlike(_DATE_TEXT), F.trim(x).try_cast("date"))
            .when(x.rlike(_DATE_TIME_TEXT), F.trim(x).try_cast("timestamp_ntz").cast("date"))
            .when(x.rlike(_TS_WIDE), _wide_timestamp(x).cast("date")))


def try_timestamp(x) -> Column:
    """Text to TIMESTAMP_NTZ: a full date with '-' or '/', optionally a time after ' ' or 'T'.

    Blanks may lead; after a time a zone ('Z', '+02', '+02:30', ' UTC') and
    blanks may follow - the zone is not applied, as in the reference engine's
    cast to a zone-less timestamp.  The usual form is tested first.
    """
    x = _c(x)
    return (F.when(x.rlike(_TS_TEXT), F.trim(x).try_cast("timestamp_ntz"))
            .when(x.rlike(_TS_WIDE), _wide_timestamp(x)))


def to_second(ts) -> Column:
    """Truncate a TIMESTAMP_NTZ to whole seconds, staying TIMESTAMP_NTZ."""
    return F.date_trunc("second", _c(ts)).cast("timestamp_ntz")


def seconds_between(start, end) -> Column:
    """Whole-second boundaries crossed from ``start`` to ``end`` (BIGINT).

    ``unix_timestamp`` floors each side, so 0.9 s -> 1.1 s counts 1, the SQL
    ``date_diff('second', ...)`` convention.
    """
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))).cast("bigint")


def planar_distance_m(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular distance in metres, cosine taken at the first latitude."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dy = (lat1 - lat2) * F.lit(METERS_PER_DEGREE)
    dx = (lon1 - lon2) * F.lit(METERS_PER_DEGREE) * F.cos(F.radians(lat1))
    return F.sqrt(F.pow(dy, F.lit(2.0)) + F.pow(dx, F.lit(2.0)))


def add_time_of_day(day, hms_text) -> Column:
    """service day + 'H:M:S' where hours may pass 24 ('25:30:00' -> next 01:30).

    Any NULL or unparsable part yields NULL.
    """
    return add_hms(day, *hms_parts(hms_text))


def hms_parts(hms_text) -> list[Column]:
    """The texts of hours, minutes and seconds."""
    return [F.split_part(_c(hms_text), F.lit(":"), F.lit(k)) for k in (1, 2, 3)]


def add_hms(day, hours, minutes, seconds) -> Column:
    """service day + hours, minutes and seconds given as texts."""
    h, m, s = map(try_int, (hours, minutes, seconds))
    return _c(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), h, m, s.cast("decimal(18,6)"))


def generated(*columns: Column) -> Column:
    """The columns as a generated row: each is computed once, whoever reads it.

    A filter or column over a plain projection may be pushed below it and then
    computes the expression anew, and long expressions make code too long to be compiled.
    """
    return F.inline(F.array(F.struct(*columns)))


def time_bucket(ts, minutes: int) -> Column:
    """Floor a timestamp to a ``minutes``-wide bucket aligned to the epoch."""
    return F.window(_c(ts), f"{minutes} minutes").start


def day_of_week_sun0(d) -> Column:
    """Day of week with Sunday = 0 (BIGINT)."""
    return (F.dayofweek(_c(d)) - F.lit(1)).cast("bigint")


def code_label(x, labels: dict, default: str) -> Column:
    """Simple CASE: map codes to labels, ``default`` otherwise."""
    x = _c(x)
    expr = None
    for code, label in labels.items():
        expr = F.when(x == F.lit(code), F.lit(label)) if expr is None else expr.when(x == F.lit(code), F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def pct_where(cond: Column) -> Column:
    """100.0 * share of rows where ``cond`` holds, as DOUBLE (aggregate)."""
    hits = F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("double")
    return F.lit(100.0) * hits / F.count(F.lit(1)).cast("double")


def _scaled(x, scale: float) -> Column:
    return F.round(_c(x).cast("double") * F.lit(float(scale))).cast("bigint")


def avg_of_scaled(x, decimals: int | None = None, scale: float | None = None) -> Column:
    """Mean of values on a fixed grid (``decimals`` decimals, or steps of
    1/``scale``), summed as exact integers (aggregate).

    The same double comes out whatever the summation order, so results do not
    depend on partitioning.
    """
    k = float(scale if scale is not None else 10 ** decimals)
    return (F.sum(_scaled(x, k)).cast("double") / F.count(_c(x)).cast("double")) / F.lit(k)


def median_of_scaled(x, decimals: int | None = None, scale: float | None = None) -> Column:
    """Exact interpolated median of values on a fixed grid (aggregate).

    Spark's percentile buffer is a value->count map with a map-side partial
    step, so memory is bounded by the number of distinct grid values, not by
    the group size: a hot line or stop does not blow up one task.
    """
    k = float(scale if scale is not None else 10 ** decimals)
    return F.median(_scaled(x, k)) / F.lit(k)
