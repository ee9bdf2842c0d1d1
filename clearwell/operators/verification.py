"""The verifier's findings: whether to ask for them, and what they change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell import fixed


def should_verify(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """By document of pages (document_id, kept_pages): reports without rows need none; those with a school a row always; short, sure ones none."""
    per = rows.groupBy("document_id").agg(F.count("*").alias("n_rows"), F.avg("confidence").alias("mean_confidence"), F.bool_or(F.coalesce(F.col("school_name"), F.lit("")) != "").alias("row_school"))
    p = pages.join(per, "document_id", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    sure = (F.col("kept_pages") <= fixed.FEW_PAGES) & (F.col("mean_confidence") >= fixed.SURE_CONFIDENCE) & (F.col("n_rows") <= fixed.FEW_ROWS)
    return p.withColumn("verify", F.when(F.col("n_rows") == 0, False).when(F.col("row_school"), True).otherwise(~sure))


def adjusted(rows: DataFrame, findings: DataFrame, flagged: DataFrame) -> DataFrame:
    """rows with confidence lowered: all of a report with wrong school attribution, flagged rows (a null sample_id flags null ones), all of a doubted report."""
    f = flagged.select("document_id", F.col("sample_id").alias("_s")).distinct()
    r = rows.join(findings, "document_id", "left")
    r = r.join(f.withColumnRenamed("document_id", "_d"), (F.col("document_id") == F.col("_d")) & F.col("sample_id").eqNullSafe(F.col("_s")), "left")
    none = F.lit(None).cast("double")
    wrong = F.coalesce(F.col("is_multi_school"), F.lit(False)) & ~F.coalesce(F.col("school_attribution_correct"), F.lit(True))
    overall = F.coalesce(F.col("overall_confidence").cast("double"), F.lit(1.0))
    low = F.least("confidence", F.when(wrong, fixed.DOUBTED).otherwise(none), F.when(F.col("_d").isNotNull(), fixed.DOUBTED).otherwise(none), F.when(overall < fixed.TRUSTED_OVERALL, overall).otherwise(none))
    return r.withColumn("adjusted_confidence", low).drop("_d", "_s")


def renamed(old: Column, correct: Column, suggested: Column) -> Column:
    """The suggestion, if the name is not marked correct and the suggestion has 3 to 60 characters."""
    s, (low, high) = F.trim(suggested), fixed.NAME_LENGTHS
    ok = ~F.coalesce(correct, F.lit(False)) & (F.length(s) > low) & (F.length(s) <= high)
    return F.when(F.coalesce(ok, F.lit(False)), s).otherwise(old)


def corrected(reports: DataFrame, findings: DataFrame) -> DataFrame:
    """reports (document_id, school_name, district) with the names that findings correct, and renames: a line for each that was, school first."""
    f = findings.select(F.col("document_id").alias("_d"), "school_name_correct", "school_name_suggested", "district_correct", "district_suggested")
    r = reports.join(f, F.col("document_id") == F.col("_d"), "left")
    lines = []
    for column, title in (("school_name", "School name"), ("district", "District")):
        new = renamed(F.lit(None).cast("string"), F.coalesce(F.col(f"{column}_correct"), F.col("_d").isNull()), F.col(f"{column}_suggested"))
        quoted = F.coalesce(F.concat(F.lit("'"), F.col(column), F.lit("'")), F.lit("'None'"))
        lines.append(F.when(new.isNotNull(), F.concat(F.lit(f"{title} corrected: "), quoted, F.lit(" -> '"), new, F.lit("'"))))
        r = r.withColumn(f"_{column}", new)
    r = r.withColumn("renames", F.array_compact(F.array(*lines)))
    return r.withColumns({c: F.coalesce(f"_{c}", c) for c in ("school_name", "district")}).drop(*f.columns, "_school_name", "_district")


def row_schools(rows: DataFrame) -> DataFrame:
    """document_id, unique_schools: the distinct schools of a report's rows in order, joined, or that they all are the report's."""
    names = F.sort_array(F.collect_set(F.expr("nullif(school_name, '')")))
    return rows.groupBy("document_id").agg(F.when(F.size(names) > 0, F.array_join(names, ", ")).otherwise(fixed.ONE_SCHOOL).alias("unique_schools"))


def issues(findings: DataFrame) -> DataFrame:
    """document_id, issue: wrong attribution, doubt, missed rows, each flagged row, in that order."""
    wrong = F.coalesce(F.col("is_multi_school") & ~F.col("school_attribution_correct"), F.lit(False))
    one = lambda c, text: F.when(F.coalesce(c, F.lit(False)), text)
    texts = F.array_compact(F.array(
        one(wrong, F.lit("Multi-school report with incorrect school attribution; all rows downgraded to 0.50 confidence")),
        one(F.col("overall_confidence") < fixed.TRUSTED_OVERALL, F.concat(F.lit("Verifier overall confidence low ("), F.format_string("%.2f", F.col("overall_confidence").cast("double")), F.lit("); all rows downgraded"))),
        one(F.col("missed_count") > 0, F.concat(F.lit("Verifier estimates "), F.col("missed_count").cast("string"), F.lit(" measurement(s) missed by extractor"))),
    ))
    return findings.withColumn("issues", F.concat(texts, F.transform(F.coalesce(F.col("flagged_rows"), F.array().cast("array<struct<sample_id:string,issue:string>>")), lambda r: F.concat(F.lit("Flagged row "), F.coalesce(r["sample_id"], F.lit("None")), F.lit(": "), F.coalesce(r["issue"], F.lit("unknown issue"))))))
