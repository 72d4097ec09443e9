"""Exact numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finer_than(amount: Column, scale: int) -> Column:
    """True where a number, or its text, has a digit other than 0 beyond ``scale`` decimals.

    The number's own digits are judged, with no bound on how many there are; a
    text that is no number is not judged.
    """
    text = F.trim(amount.cast("string"))
    number = r"^[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?$"
    shift = F.coalesce(F.regexp_extract(text, number, 3).try_cast("int"), F.lit(0))
    # digits right of the point that stay after the exponent has moved it
    whole, part = F.regexp_extract(text, number, 1), F.regexp_extract(text, number, 2)
    place = F.greatest(F.char_length(whole) + shift + scale, F.lit(0))
    beyond = F.substring(F.concat(whole, part), place + 1, F.lit(2**31 - 1))
    plain = rf"^[+-]?\d*\.?\d{{0,{scale}}}\z"  # nearly every amount: no digit beyond, none to look for
    return F.when(text.rlike(plain), F.lit(False)).otherwise(text.rlike(number) & beyond.rlike("[1-9]"))
