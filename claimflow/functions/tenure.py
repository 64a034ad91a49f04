"""Durations between dates, as fractional days, with per-model clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0
DAYS_PER_UNIT = {"D": 1.0, "M": 365.2425 / 12, "Y": 365.2425}


def elapsed(start: Column, end: Column, unit: str = "D") -> Column:
    """(end - start) in fractional days, mean months or mean years."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    days = micros / F.lit(MICROS_PER_DAY)
    return days if unit == "D" else days / F.lit(DAYS_PER_UNIT[unit])


def positive(x: Column) -> Column:
    """Zero and below become NULL."""
    return F.when(x > 0, x)


def clamp_negative(x: Column, how: str) -> Column:
    """Values below zero: set to ``zero``, made ``null``, or ``keep`` as they are."""
    if how == "keep":
        return x
    if how == "zero":
        return F.when(x < 0, F.lit(0.0)).otherwise(x)
    if how == "null":
        return F.when(x >= 0, x)
    raise ValueError(f"unknown clamp {how!r}")


def emp_tenure(hired: Column, loss: Column, positive_only: bool = True) -> Column:
    days = elapsed(hired, loss)
    return positive(days) if positive_only else days


def policy_tenure(
    effective: Column, terminated: Column, received: Column, positive_only: bool = True
) -> Column:
    """To the termination date, or to the received date of a policy in force."""
    days = F.coalesce(elapsed(effective, terminated), elapsed(effective, received))
    return positive(days) if positive_only else days


def days_to_report(loss: Column, received: Column, negative: str = "zero") -> Column:
    return clamp_negative(elapsed(loss, received), negative)


def prognosis_days(loss: Column, duration: Column, months: Column) -> Column:
    """To the duration date if that lies ahead, else months of 30 days; > 0 or NULL."""
    return F.coalesce(positive(elapsed(loss, duration)), positive(months * 30))


def payment_lag(first_paid: Column, last_paid: Column) -> Column:
    return clamp_negative(elapsed(first_paid, last_paid), "null")


def days_to_first_payment(loss: Column, first_paid: Column) -> Column:
    return elapsed(loss, first_paid)


def initial_prognosis_days(loss: Column, first_duration: Column) -> Column:
    return positive(elapsed(loss, first_duration))


def event_lag(base: Column, event: Column) -> Column:
    """Whole days from the event to the base date; -1 where unknown or later."""
    days = F.date_diff(base.cast("date"), event.cast("date"))
    return F.coalesce(F.when(days >= 0, days), F.lit(-1))
