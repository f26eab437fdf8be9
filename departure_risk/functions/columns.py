"""Scalar expressions. All of them are built-in JVM functions; none is a Python UDF."""

from pyspark.sql import Column, functions as F

from departure_risk.config import DAY_PARTS


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def text_to_double(text: Column) -> Column:
    """Text to double, anything unreadable to null.

    Spark also reads the Java type suffixes (`15d`, `2.0f`), which are not numbers in a data file.
    """
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def text_to_int(text: Column) -> Column:
    """Text to int by way of a whole decimal, so `1530.0` reads as 1530 and halves round away from zero."""
    return text.try_cast("decimal(20,0)").try_cast("int")


def hhmm_to_minutes(hhmm: Column) -> Column:
    """1530 -> 930 minutes after midnight; 2400 -> 1440."""
    hours = F.call_function("div", hhmm, F.lit(100))
    return (hours * 60 + hhmm % 100).cast("int")


def hhmm_to_hour(hhmm: Column) -> Column:
    """1530 -> 15; 2400 is midnight, hour 0."""
    return F.floor(hhmm / 100).cast("int") % 24


def ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def iso_weekday(date: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(date) + 1


def day_number(date: Column) -> Column:
    """Days as an integer, so window frames can count calendar days."""
    return F.unix_date(date)


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def day_part(hour: Column) -> Column:
    """Index into DAY_PARTS; the day starts at five in the morning."""
    since_five = F.pmod(hour - 5, F.lit(24))
    return (
        F.when(since_five <= 5, 0).when(since_five <= 10, 1).when(since_five <= 15, 2)
        .when(since_five <= 23, len(DAY_PARTS) - 1).cast("int")
    )


def percent(flag: Column) -> Column:
    return F.round(100 * F.avg(flag), 1)


def log_odds(p: Column, margin: float = 1e-6) -> Column:
    inside = F.greatest(F.least(p, F.lit(1 - margin)), F.lit(margin))
    return F.ln(inside / (1 - inside))


def from_log_odds(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
