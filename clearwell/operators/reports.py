"""Reports: parsing recorded JSON, document status, the enriched export, unmatched schools, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearwell.functions.names import coordinates, county
from clearwell.functions.text import or_empty
from clearwell.operators.lookup import match

MEASUREMENT = """struct<sample_id:string, sample_location:string, fixture_type:string, draw_type:string, school_name:string, district:string,
 analyte:string, result_ppb:double, result_raw:string, unit_raw:string, action_level_ppb:double, sample_date:date, test_year:int, source_text:string, confidence:double>"""
REPORT = f"struct<school_name:string, district:string, lab_name:string, measurements:array<{MEASUREMENT}>>"


def parse(reports: DataFrame, *, strict_source: bool = True) -> DataFrame:
    """reports (document_id, report_json) with report and valid: all or nothing, one bad row rejects its report.

    A row needs result_ppb, result_raw, a confidence from 0 to 1, and with strict_source a source_text of 160 characters at most.
    """
    ok = "m.result_ppb is not null and m.result_raw is not null and m.confidence between 0 and 1"
    ok += " and m.source_text is not null and length(m.source_text) <= 160" if strict_source else " and coalesce(length(m.source_text), 0) <= 160"
    r = reports.withColumn("report", F.from_json("report_json", REPORT))
    return r.withColumn("valid", F.expr(f"report is not null and forall(coalesce(report.measurements, array()), m -> coalesce({ok}, false))"))


def exploded(parsed: DataFrame) -> DataFrame:
    """A row for each measurement of valid reports, in order, with the analyte in lower case and lead where it has none."""
    rows = parsed.where("valid").select("document_id", F.posexplode("report.measurements").alias("line_no", "m")).select("document_id", "line_no", "m.*")
    return rows.withColumn("analyte", F.lower(F.trim(F.coalesce(F.expr("nullif(analyte, '')"), F.lit("lead"))))).withColumn("action_level_ppb", F.coalesce("action_level_ppb", F.lit(15.0)))


def status(documents: DataFrame, gated: DataFrame) -> DataFrame:
    """documents (document_id, failed, school_name) with counts, issues and status: failed, partial or ok.

    no_school: no accepted row has a school and the report's is null (an empty one is none either, but raises no issue).
    """
    per = gated.groupBy("document_id").agg(F.count_if(F.col("decision") == "accept").alias("written"), F.count_if(F.col("decision") == "review").alias("held"),
                                           F.bool_or((F.col("decision") == "accept") & (F.coalesce(F.col("school_name"), F.lit("")) != "")).alias("_row_school"))
    d = documents.join(per, "document_id", "left").na.fill(0, ["written", "held"])
    d = d.withColumn("no_school", ~F.coalesce("_row_school", F.lit(False)) & F.col("school_name").isNull()).withColumn("no_measurements", (F.col("written") == 0) & (F.col("held") == 0))
    some = F.col("no_school") | F.col("no_measurements") | (F.col("held") > 0)
    return d.withColumn("status", F.when(F.col("failed"), "failed").when(some & (F.col("written") > 0), "partial").when(some, "failed").otherwise("ok")).drop("_row_school")


def joined(measurements: DataFrame, schools: DataFrame, documents: DataFrame) -> DataFrame:
    """Measurements with their document, and their school if they have one."""
    return measurements.join(schools, "school_key", "left").join(documents, "document_id")


def export(rows: DataFrame, found: DataFrame, on: tuple[str, ...] = ("school_name", "district")) -> DataFrame:
    """The 15 columns: rows (with school_name, district, file_path, ...) and the lookup row that was found for the values of on, if any."""
    own = {"name": "m_name", "district_name": "m_district", "county": "m_county", "address": "m_address"}
    f = found.select(*(F.col(k).alias(f"_{k}") for k in on), *(F.col(a).alias(b) for a, b in own.items()), "latitude", "longitude")
    condition = F.lit(True)
    for k in on:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    r = rows.join(f, condition, "left")
    return r.select(
        or_empty(F.col("m_county"), county(F.col("file_path"))).alias("county"), or_empty(F.col("m_district"), F.col("district")).alias("district"),
        or_empty(F.col("m_name"), F.col("school_name")).alias("school_name"), F.coalesce("m_address", F.lit("")).alias("address"),
        coordinates(F.col("latitude"), F.col("longitude")).alias("coordinates"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("sample_id", "sample_location", "fixture_type", "draw_type")),
        F.coalesce(F.date_format("sample_date", "yyyy-MM-dd"), F.lit("")).alias("sample_date"), year(F.col("test_year"), F.col("sample_date")).alias("year"),
        F.col("result_ppb").alias("lead_concentration_ppb"), "confidence", "source_page", F.col("file_name").alias("source_file"),
    )


def year(test_year: Column, date: Column) -> Column:
    return F.coalesce(test_year.cast("string"), F.year(date).cast("string"), F.lit(""))


def export_order(exported: DataFrame) -> DataFrame:
    return exported.orderBy("source_file", "sample_id")


def unmatched(rows: DataFrame, examples: int = 5) -> DataFrame:
    """By school and district without a match: measurements, and the first file names; most frequent first, then by name. Rows without a school have nothing to match.

    Counts by file come first, so a school's rows are partial sums before its files are numbered, and no more than examples names meet.
    """
    keys = ["school_name", "district"]
    per = rows.where("school_name is not null").withColumn("district", F.coalesce("district", F.lit(""))).groupBy(*keys, "file_name").agg(F.count("*").alias("n"))
    numbered = per.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy("file_name")))
    names = F.array_sort(F.collect_list(F.when(F.col("i") <= examples, F.col("file_name"))))
    return numbered.groupBy(*keys).agg(F.sum("n").alias("measurements"), F.array_join(names, "; ").alias("example_files")).orderBy(F.desc("measurements"), *keys)


def matched(rows: DataFrame, lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the 15 columns of every row with what the lookup has for its school, the tally of schools that it doesn't match): each distinct school and district is matched once."""
    found = match(rows, lookup)
    tried = rows.join(found.select("school_name", F.col("district").alias("_d"), F.lit(True).alias("_found")).withColumnRenamed("school_name", "_s"), F.col("school_name").eqNullSafe(F.col("_s")) & F.col("district").eqNullSafe(F.col("_d")), "left")
    return export(rows, found), unmatched(tried.where("_found is null").drop("_s", "_d", "_found"))


def recent(documents: DataFrame, n: int = 50) -> DataFrame:
    return documents.orderBy(F.desc("ingested_at"), "document_id").limit(n)
