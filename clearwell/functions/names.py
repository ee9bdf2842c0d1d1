"""Names: normal forms of schools and districts, school numbers, hints in paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions.text import any_of, filled, strip


def _tidy(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def normal_school(name: Column) -> Column:
    bare = F.regexp_replace(F.lower(name), any_of([fixed.SCHOOL_SUFFIXES]), " ")
    return F.coalesce(_tidy(F.regexp_replace(bare, any_of(fixed.SCHOOL_FILLERS), " ")), F.lit(""))


def normal_district(name: Column) -> Column:
    c = strip(F.lower(name))
    for short, long in fixed.DISTRICT_WORDS.items():
        c = F.regexp_replace(c, any_of([short]), long)
    c = _tidy(F.regexp_replace(c, any_of(fixed.DISTRICT_NOISE), " "))
    return F.coalesce(strip(F.regexp_replace(c, r"\s*#?\d+$", "")), F.lit(""))


def school_number(name: Column, patterns=fixed.NUMBERED) -> Column:
    """The number of a numbered school, by the first pattern that matches."""
    return F.coalesce(*(F.regexp_extract(name, f"(?iU){p}", 1).try_cast("int") for p in patterns))


def ingest_number(name: Column) -> Column:
    return school_number(name, fixed.NUMBERED[:2])


def _parts(path: Column) -> Column:
    return F.split(path, r"[/\\]")


def county(path: Column) -> Column:
    """Of the first folder that ends with the word county, in any case; only County and county are cut off."""
    found = F.get(F.filter(_parts(path), lambda p: F.lower(p).endswith(" county")), F.lit(0))
    return F.coalesce(strip(F.regexp_replace(found, " [Cc]ounty", "")), F.lit(""))


def hints(path: Column) -> Column:
    """A struct of county, district and lab: of the last folder that ends with county, the one below it, and the last that names a laboratory."""
    parts = _parts(path)
    at = F.array_max(F.filter(F.transform(parts, lambda p, i: F.when(F.lower(p).endswith(" county"), i)), lambda i: i.isNotNull()))
    known = [x.replace(" ", "") for x in fixed.LABORATORIES]
    lab = F.try_element_at(F.filter(parts, lambda p: F.regexp_replace(F.lower(p), "[- ]", "").isin(*known)), F.lit(-1))
    district = strip(F.regexp_replace(F.get(parts, at + 1), fixed.FOLDER_SUFFIX, ""))
    return F.struct(
        F.coalesce(strip(F.regexp_replace(F.get(parts, at), " [Cc]ounty", "")), F.lit("")).alias("county"),
        F.coalesce(district, F.lit("")).alias("district"), F.coalesce(strip(lab), F.lit("")).alias("lab"),
    )


def address(*parts: Column) -> Column:
    return F.concat_ws(", ", *(filled(F.trim(p)) for p in parts))


def coordinates(lat: Column, lon: Column) -> Column:
    """Both as text, or an empty string unless both are numbers."""
    x, y = lat.try_cast("double"), lon.try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.concat_ws(", ", x.cast("string"), y.cast("string"))).otherwise("")
