"""Business functions on single rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NEW = "NEW"
REPEAT = "REPEAT"

# Texts of the allergy flag.
ALLERGY_DETECTED = "allergy detected"
ALLERGY_NOT_DETECTED = "no allergy detected uptil now"


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def visit_type(visit, first, legacy: bool = False) -> Column:
    """NEW on the day of the first visit, REPEAT on any later one.

    ``legacy`` compares the day of the month only, so the same day number of
    another month counts as NEW.
    """
    day = F.dayofmonth if legacy else F.to_date
    same_day = day(_col(visit)) == day(_col(first))
    return F.when(same_day, F.lit(NEW)).when(~same_day, F.lit(REPEAT))


def sale_amount(unit_price, quantity) -> Column:
    """Price times quantity; the price is text, and text that is no number gives null."""
    return _col(unit_price).try_cast("double") * _col(quantity)


def new_flag(count) -> Column:
    return F.when(_col(count) == 1, F.lit(1)).when(_col(count).isNotNull(), F.lit(0))


def repeat_flag(count) -> Column:
    return F.when(_col(count) == 1, F.lit(0)).when(_col(count).isNotNull(), F.lit(1))


def allergy_flag(count) -> Column:
    return (
        F.when(_col(count) > 1, F.lit(ALLERGY_DETECTED))
        .when(_col(count).isNotNull(), F.lit(ALLERGY_NOT_DETECTED))
    )


def date_as_int(text) -> Column:
    """``2016-12-01 …`` as 20161201, null staying null."""
    text = _col(text)
    digits = F.replace(F.substring(text, 1, 10), F.lit("-"), F.lit(""))
    return F.when(text.isNull(), F.lit(None)).otherwise(digits.try_cast("int"))


def allergen_list(text) -> Column:
    """The parts of a comma-separated list, trailing empty parts left out."""
    text = _col(text)
    kept = F.rtrim(text, F.lit(","))
    only_commas = (kept == "") & (text != "")
    empty = F.array().cast("array<string>")
    return F.when(only_commas, empty).otherwise(F.split(kept, ","))
