"""Scalar date operators. Shapes are tested first, casts never raise."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelake.functions.text import is_blank, strip_text

# Accepted date shapes. Day and month may have one digit, the
# separator is - or / throughout, and a clock time may follow.
_CLOCK = r"(\s+([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d)?"
YEAR_FIRST = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})" + _CLOCK + "$"
DAY_FIRST = r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})" + _CLOCK + "$"
STRICT_ISO = r"^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])\z"
ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"


def parse_date_multi(c: Column) -> Column:
    """DATE from any of the eight accepted layouts, else NULL.

    Text that is ISO already is cast as it is, other layouts are rewritten to
    ISO first; impossible days give NULL.
    """
    body = strip_text(c)
    iso = F.when(body.rlike(STRICT_ISO), body).when(body.rlike(YEAR_FIRST), F.regexp_replace(body, YEAR_FIRST, "$1-$3-$4")).when(
        body.rlike(DAY_FIRST), F.regexp_replace(body, DAY_FIRST, "$4-$3-$1")
    )
    return F.when(~iso.startswith("0000"), iso.try_cast("date"))


def canonical_date_text(c: Column) -> Column:
    """ISO text when parseable, the stripped text when not, '' when blank."""
    return F.when(is_blank(c), F.lit("")).otherwise(
        F.coalesce(F.date_format(parse_date_multi(c), "yyyy-MM-dd"), strip_text(c))
    )


def guarded_iso_date(c: Column) -> Column:
    """DATE when the untrimmed text is strict ISO and a real day, else NULL."""
    return F.when(c.rlike(STRICT_ISO), c.try_cast("date"))


def iso_prefix_date(c: Column) -> Column:
    """DATE when the text starts with an ISO day; what follows must still cast."""
    return F.when(c.rlike(ISO_PREFIX), F.trim(c).try_cast("date"))


def date_parts(d: Column) -> dict[str, Column]:
    """Calendar attributes of a day, named as in the date dimension."""
    return {
        "date_key": d,
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": F.date_format(d, "EEEE"),
        "quarter": F.quarter(d),
        "semester": F.when(F.month(d) <= 6, F.lit(1)).otherwise(F.lit(2)),
    }
