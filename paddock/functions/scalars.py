"""Scalar rules of the marts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_name(first: Column, last: Column) -> Column:
    """``first last`` where a missing part counts as empty text."""
    empty = F.lit("")
    return F.concat(F.coalesce(first, empty), F.lit(" "), F.coalesce(last, empty))


def at_most(value: Column, limit: int) -> Column:
    """True if ``value <= limit``; a missing value is False."""
    return F.coalesce(value <= limit, F.lit(False))


def equals(value: Column, wanted) -> Column:
    """True if equal; a missing value is False."""
    return F.coalesce(value == wanted, F.lit(False))


def did_not_finish(status: Column) -> Column:
    """Only ``Finished`` and lapped cars (``+1 Lap``) finished; missing is a retirement."""
    classified = (status == "Finished") | status.startswith("+")
    return ~F.coalesce(classified, F.lit(False))


def positions_gained(finish: Column, grid: Column) -> Column:
    """Finish minus grid: positive when places were lost, NULL if either is missing."""
    return finish - grid


def last_session_time(q1: Column, q2: Column, q3: Column) -> Column:
    """Time of the last session that has one (not the fastest)."""
    return F.coalesce(q3, q2, q1)


def ratio(part: Column, whole: Column, digits: int = 3) -> Column:
    """``part / whole`` of two counts, rounded half up in whole numbers.

    Rounding the quotient of integers in integer arithmetic has no ties that
    depend on binary fractions.  NULL where ``whole`` is zero or missing.
    """
    scale = 10**digits
    part, whole = part.cast("long"), whole.cast("long")
    half_up = F.call_function("div", part * (2 * scale) + whole, whole * 2)
    return F.when(whole > 0, half_up / F.lit(float(scale)))


def guarded_rate(part: Column, whole: Column, digits: int = 3) -> Column:
    """As ``ratio``, with 0.0 where there is nothing to divide by."""
    return F.coalesce(ratio(part, whole, digits), F.lit(0.0))


def as_number(flag: Column) -> Column:
    return flag.cast("int")


def mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count; NULL for an empty set."""
    return F.when(count > 0, total.cast("double") / count)


def summary_label(top_predicted: Column, dnf_predicted: Column) -> Column:
    """Label of the text summary: a predicted top finish wins over a retirement."""
    return (
        F.when(top_predicted, F.lit("TOP-10"))
        .when(dnf_predicted, F.lit("DNF"))
        .otherwise(F.lit("11th-20th"))
    )


def panel_label(top_probability: Column, dnf_probability: Column) -> Column:
    """Label of the race panel: a likely retirement wins over a top finish."""
    return (
        F.when(dnf_probability > 0.5, F.lit("DNF"))
        .when(top_probability > 0.5, F.lit("Top-10"))
        .otherwise(F.lit("Outside Top-10"))
    )


def split_of(year: Column, train_end: int, val_years, test_years) -> Column:
    """Name of the time split a year belongs to; NULL if none."""
    return (
        F.when(year <= train_end, F.lit("train"))
        .when(year.isin(list(val_years)), F.lit("val"))
        .when(year.isin(list(test_years)), F.lit("test"))
    )
