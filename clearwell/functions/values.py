"""Result values: separators, non-detects, units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions.text import normalize, strip

NON_DETECT = "(?iU)" + fixed.NON_DETECT


def separated(c: Column) -> Column:
    """Without thousands separators, and with a decimal point for a decimal comma."""
    return F.regexp_replace(F.regexp_replace(c, r"(\d),(\d{3})(?!\d)", "$1$2"), r"(\d),(\d{1,2})(?!\d)", "$1.$2")


def is_non_detect(c: Column) -> Column:
    return F.coalesce(c.rlike(NON_DETECT), F.lit(False))


def number(c: Column, pattern: str) -> Column:
    return F.regexp_extract(c, pattern, 1).try_cast("double")


def derived_ppb(raw: Column, unit: Column) -> Column:
    """0 for a non-detect, else the value after a less-than sign, else the first number, scaled by a unit of a thousand; null if none."""
    text = separated(strip(raw))
    value = F.coalesce(number(text, fixed.LESS_THAN), number(text, fixed.PLAIN_NUMBER))
    scale = F.when(F.coalesce(normalize(unit).isin(*fixed.SCALED_UNITS), F.lit(False)), 1000.0).otherwise(1.0)
    return F.when(is_non_detect(text), 0.0).otherwise(value * scale)


def unit_kind(unit: Column) -> Column:
    """ppb, scaled, misread, none (null or blank) or unknown; signs at the end don't count here, though they do for the scale."""
    u = F.rtrim(normalize(unit), F.lit(".,;: "))
    return (
        F.when(unit.isNull() | (u == ""), "none").when(u.isin(*{x.replace("µ", "u") for x in fixed.PPB_UNITS}), "ppb")
        .when(u.isin(*fixed.SCALED_UNITS), "scaled").when(u.isin(*fixed.MISREAD_UNITS), "misread").otherwise("unknown")
    )


def exceeds(value: Column, level: Column) -> Column:
    return value > level
