"""Calendar and duration attributes of a zone-less timestamp.

All functions work on TIMESTAMP_NTZ / DATE columns, so the session time zone
never moves a trip to another day or hour. Each takes column names or SQL
snippets and returns a Column; the ``*_sql`` forms return the SQL text.
"""

from pyspark.sql import Column

from rides.functions._util import as_sql, expr

# Business rules of the reports.
WEEKEND_DAYS = (0, 6)                     # Sunday = 0 ... Saturday = 6
SEASONS = (                               # month numbers -> label
    ((12, 1, 2), "Winter"),
    ((3, 4, 5), "Spring"),
    ((6, 7, 8), "Summer"),
    ((9, 10, 11), "Fall"),
)
RUSH_HOURS = ((7, 9), (16, 18))           # inclusive hour ranges
LATE_NIGHT_HOURS = ((0, 5), (22, 23))
TIME_OF_DAY_LABELS = ("Rush Hour", "Late Night", "Other")
WEEKDAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _in(values) -> str:
    return ", ".join(str(v) for v in values)


def trip_date_sql(ts) -> str:
    return f"to_date({as_sql(ts)})"


def start_hour_sql(ts) -> str:
    return f"cast(hour({as_sql(ts)}) as bigint)"


def weekday_num_sql(ts) -> str:
    """Sunday = 0 ... Saturday = 6."""
    return f"cast(dayofweek({as_sql(ts)}) - 1 as bigint)"


def weekday_type_sql(dow) -> str:
    return f"case when ({as_sql(dow)}) in ({_in(WEEKEND_DAYS)}) then 'weekend' else 'weekday' end"


def weekday_name_sql(d) -> str:
    """Full English day name ('Monday')."""
    return f"date_format({as_sql(d)}, 'EEEE')"


def weekday_order_sql(name) -> str:
    """Monday = 1 ... Sunday = 7 for sorting day names."""
    whens = " ".join(f"when '{n}' then {i}" for i, n in enumerate(WEEKDAY_NAMES, start=1))
    return f"case ({as_sql(name)}) {whens} end"


def season_sql(month) -> str:
    """Season of a month number; a value outside 1-12 gives NULL."""
    m = as_sql(month)
    whens = " ".join(f"when ({m}) in ({_in(ms)}) then '{label}'" for ms, label in SEASONS)
    return f"case {whens} end"


def _ranges(h: str, ranges) -> str:
    return " or ".join(f"({h}) between {lo} and {hi}" for lo, hi in ranges)


def time_of_day_sql(hour) -> str:
    h = as_sql(hour)
    return (f"case when {_ranges(h, RUSH_HOURS)} then '{TIME_OF_DAY_LABELS[0]}'"
            f" when {_ranges(h, LATE_NIGHT_HOURS)} then '{TIME_OF_DAY_LABELS[1]}'"
            f" else '{TIME_OF_DAY_LABELS[2]}' end")


def duration_micros_sql(start, end) -> str:
    """Exact microseconds from start to end, as BIGINT."""
    return f"timestampdiff(MICROSECOND, {as_sql(start)}, {as_sql(end)})"


def minutes_from_micros_sql(micros) -> str:
    """Microseconds -> fractional minutes (seconds, then / 60)."""
    return f"({as_sql(micros)}) / 1000000.0D / 60.0D"


def duration_minutes_sql(start, end) -> str:
    """Fractional minutes between two timestamps (epoch seconds of the
    difference, microseconds included, divided by 60)."""
    return minutes_from_micros_sql(duration_micros_sql(start, end))


def trip_date(ts) -> Column:
    return expr(trip_date_sql(ts))


def start_hour(ts) -> Column:
    return expr(start_hour_sql(ts))


def weekday_num(ts) -> Column:
    return expr(weekday_num_sql(ts))


def weekday_type(dow) -> Column:
    return expr(weekday_type_sql(dow))


def weekday_name(d) -> Column:
    return expr(weekday_name_sql(d))


def weekday_order(name) -> Column:
    return expr(weekday_order_sql(name))


def season(month) -> Column:
    return expr(season_sql(month))


def time_of_day(hour) -> Column:
    return expr(time_of_day_sql(hour))


def duration_micros(start, end) -> Column:
    return expr(duration_micros_sql(start, end))


def minutes_from_micros(micros) -> Column:
    return expr(minutes_from_micros_sql(micros))


def duration_minutes(start, end) -> Column:
    return expr(duration_minutes_sql(start, end))
