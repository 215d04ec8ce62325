"""Run time, publication dates and parts of dates."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodmart import fixed_values as V
from moodmart.functions.text import SPACE, once, trim_spaces

_MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
# hour:minute day month, once runs of spaces are single blanks and letters are small
_CLOCK_DAY_MONTH = r"^([01]?[0-9]|2[0-3]):[0-5]?[0-9] [0-9]{1,2} [a-z]+$"


def wall_clock(moment: Column, zone: str = V.RUN_TIME_ZONE) -> Column:
    """An instant as the clock on the wall in ``zone`` shows it, to the second, without a zone."""
    # From UTC, where no hour is repeated; through the session's zone two instants could become one
    micros = F.unix_micros(moment.cast("timestamp"))
    seconds = F.floor(micros / F.lit(1_000_000)).cast("long")
    in_utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), in_utc).cast("timestamp_ntz")


def run_timestamp(zone: str = V.RUN_TIME_ZONE) -> Column:
    """Default run time. Jobs take the run time as a parameter, so that a run can be repeated."""
    return wall_clock(F.current_timestamp(), zone)


def published_date(text: Column, extracted: Column, run_year: Column | None = None) -> Column:
    """``published at 22:46 2 October`` as a date; null for anything that is not clock, day and English month.

    The text has no year. It is the year the page was fetched, or the one before if that would put the article after
    its own fetch. ``run_year`` instead gives one year for all, which moves old pages into the year of the run. A day
    that its year does not have gives null.
    """
    bare = trim_spaces(F.replace(text, F.lit(V.DATE_LEAD_IN), F.lit("")))
    tidy = F.lower(F.regexp_replace(bare, f"(?U){SPACE}+", " "))

    def dated(clock_day_month: Column) -> Column:
        words = F.split(clock_day_month, " ")
        return once(F.struct(_month_number(words[2]).alias("month"), words[1].cast("int").alias("day")), in_year)

    def in_year(found: Column) -> Column:
        if run_year is None:
            fetched_on = F.to_date(extracted)
            later = found.month * 100 + found.day > F.month(fetched_on) * 100 + F.dayofmonth(fetched_on)
            year = F.year(fetched_on) - F.when(later, 1).otherwise(0)
        else:
            year = run_year
        parts = [part.cast("string") for part in (year, found.month, found.day)]
        return F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]).try_cast("date")

    return once(tidy, lambda line: F.when(line.rlike(_CLOCK_DAY_MONTH), dated(line)))


def _month_number(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(month) for month in _MONTHS]), name)


def iso_year(day: Column) -> Column:
    """The year an ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def date_parts(day: Column, week_year: bool = False) -> list[Column]:
    """Year, month, day and ISO week. The year is the calendar one unless ``week_year`` pairs it with the week."""
    return [
        (iso_year(day) if week_year else F.year(day)).cast("int").alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekofyear(day).alias("week_of_year"),
    ]
