"""The validation gate: five checks a row, accepted or held with reasons, as codes and as sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell import fixed
from clearwell.functions.text import normalize, or_empty, python_float, significant, strip
from clearwell.functions.values import derived_ppb, is_non_detect, unit_kind


def _coded(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(code)) for c, code in checks)))


def structure() -> Column:
    nowhere = (or_empty(F.col("sample_id"), F.col("sample_location"))) == ""
    short = F.coalesce(F.length(strip(F.col("source_text"))), F.lit(0)) < fixed.SHORTEST_SOURCE
    return _coded((nowhere, "no_locator"), (short, "no_source"))


def range_codes() -> Column:
    value, level = F.col("result_ppb"), F.col("action_level_ppb")
    return _coded((value < fixed.LEAST_PPB, "negative"), (value > fixed.MOST_PPB, "too_large"), (~level.between(*fixed.ACTION_LEVELS), "action_level"))


def read(rows: DataFrame) -> DataFrame:
    """rows with _derived, _kind and _nd, which result_raw and unit_raw determine: read once for each distinct pair of them and joined back."""
    pairs = rows.select(F.col("result_raw").alias("_raw"), F.col("unit_raw").alias("_unit")).distinct()
    raw, unit = F.col("_raw"), F.col("_unit")
    pairs = pairs.select("_raw", "_unit", derived_ppb(raw, unit).alias("_derived"), unit_kind(unit).alias("_kind"), is_non_detect(raw).alias("_nd"))
    return rows.join(pairs, F.col("result_raw").eqNullSafe(raw) & F.col("unit_raw").eqNullSafe(unit), "left").drop("_raw", "_unit")


def unit_codes() -> Column:
    """Of rows that were read(): unknown unit; no number; or a number that differs, unless a non-detect comes with 0 or a reporting limit."""
    value, derived = F.col("result_ppb"), F.col("_derived")
    excused = F.col("_nd") & value.between(0.0, fixed.NON_DETECT_MOST)
    return _coded((F.col("_kind") == "unknown", "unit"), (derived.isNull(), "no_number"), (~excused & (F.abs(derived - value) > fixed.TOLERANCE), "mismatch"))


def _place() -> Column:
    return strip(or_empty(F.col("sample_location"), F.col("sample_id")))


def span_codes(text: Column) -> Column:
    """The value, and every significant token of the place, are substrings of the report's normalized text."""
    page, raw = normalize(text), normalize(F.col("result_raw"))
    return _coded(((raw != "") & ~F.contains(page, raw), "value_not_in_text"), (F.exists(significant(_place()), lambda t: ~F.contains(page, t)), "place_not_in_text"))


def confidence_codes(least: float = fixed.LEAST_CONFIDENCE) -> Column:
    return _coded((F.col("confidence") < least, "confidence"))


def gate(rows: DataFrame, text: Column | None = None, spanned: Column | None = None) -> DataFrame:
    """rows with reasons, in the order of the checks, and decision. spanned: whether the source-span check applies to a row."""
    nothing = F.array().cast("array<string>")
    spans = nothing if text is None else span_codes(text) if spanned is None else F.when(spanned, span_codes(text)).otherwise(nothing)
    reasons = F.concat(structure(), range_codes(), unit_codes(), spans, confidence_codes())
    return read(rows).withColumn("reasons", reasons).withColumn("decision", F.when(F.size("reasons") == 0, "accept").otherwise("review"))


def checkable(pages: DataFrame) -> DataFrame:
    """By document: whether its kept pages' text is long enough, and none is blank, for the source-span check."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_num", F.coalesce("raw_text", F.lit("")).alias("t")))), lambda x: x["t"]), "\n")
    return pages.groupBy("document_id").agg(text.alias("report_text"), F.bool_or(strip(F.coalesce("raw_text", F.lit(""))) == "").alias("_blank")).select(
        "document_id", "report_text", (~F.col("_blank") & (F.length(strip(F.col("report_text"))) >= fixed.SHORTEST_REPORT)).alias("spanned")
    )


def sentence(code: Column, text: Column | None = None) -> Column:
    """The sentence of a reason code of a row that was read(). text: the report's, for the words of a place that it lacks."""
    shown = lambda c: F.coalesce(c, F.lit("None"))
    number = lambda c: python_float(F.col(c))
    missing = F.lit("[]") if text is None else F.concat(F.lit("['"), F.array_join(F.filter(significant(_place()), lambda t: ~F.contains(normalize(text), t)), "', '"), F.lit("']"))
    of = {
        "result": number("result_ppb"), "level": number("action_level_ppb"), "derived": number("_derived"), "unit": shown(F.col("unit_raw")), "raw": shown(F.col("result_raw")),
        "place": _place(), "missing": missing, "confidence": F.format_string("%.2f", F.col("confidence")), "most": F.lit(f"{fixed.MOST_PPB:.0f}"), "least": F.lit(f"{fixed.LEAST_CONFIDENCE:.2f}"),
    }
    out = F.lit(None).cast("string")
    for name, words in fixed.REASONS.items():
        parts = [of[x] if i % 2 else F.lit(x) for i, x in enumerate(words.replace("}", "{").split("{")) if x]
        out = F.when(code == name, F.concat(*parts)).otherwise(out)
    return out


def held_text(rows: DataFrame, text: Column | None = None) -> DataFrame:
    """The rows that a gate holds, with detail: who, and the sentences of its reasons in their order."""
    who = F.coalesce(F.expr("nullif(sample_id, '')"), F.expr("nullif(sample_location, '')"), F.lit("unknown sample"))
    said = F.array_join(F.transform("reasons", lambda c: sentence(c, text)), "; ")
    return rows.where("decision = 'review'").withColumn("detail", F.concat(F.lit("Row held by validation ("), who, F.lit("): "), said))
